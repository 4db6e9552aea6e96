"""URL filter: rules by host and path, and a list of blocked URLs behind a blocked Bloom filter.

The list is compared by canonical URL. A Bloom filter of fixed size (``blocks`` blocks of four 64-bit words, each
URL sets ``BITS`` bits of one word) lets the pages through that can't be listed; only the possible hits
are shuffled to an exact join on the canonical URL, which removes the false positives. The filter has
32 bytes per block (512 KB by default), however long the list is: a longer list makes more
possible hits, never a wrong verdict. Only its bytes come to the driver, ``CHUNK`` 64-bit words in
a row, and it goes out as one scalar.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no rule and is not listed;
equal URLs are judged equally; an empty list blocks nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millwright.session import materialize

BITS = 6
CHUNK = 256  # words of the filter in a row sent to the driver

#: Fixed values: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Without scheme, ``www.``, default port, tracking parameters, fragment, ``.html`` and closing slash."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(\.html?|/+)$", "")
    query = F.regexp_replace(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), r"(^|&)(utm_[^&]*|ref=[^&]*)", "")
    query = F.regexp_replace(query, r"^&", "")
    full = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", full)


def fitting_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits (like ``net/``) and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def _word(url: Column, blocks: int) -> Column:
    """The 64-bit word of the filter a URL sets bits of."""
    return F.pmod(F.xxhash64(url, F.lit(1)), F.lit(4 * blocks)).cast("int")


def _mask(url: Column) -> Column:
    """The bits a URL sets in its word."""
    out = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(F.xxhash64(url), 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def table_bytes(values: DataFrame, size: int) -> bytearray:
    """A table of ``size`` longs, highest byte first, from rows (at, value); 0 where there is no row.

    It reaches the driver as rows of ``CHUNK`` longs, a few KB each, not as a row for each long.
    """
    each = F.transform(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda i: F.lpad(F.hex(F.coalesce(F.col("held")[i], F.lit(0).cast("long"))), 16, "0"))
    chunks = (values.groupBy(F.floor(F.col("at") / CHUNK).alias("chunk"))
              .agg(F.map_from_entries(F.collect_list(F.struct(F.col("at") % CHUNK, "value"))).alias("held"))
              .select("chunk", F.unhex(F.array_join(each, "")).alias("raw")))
    out = bytearray(-(-size // CHUNK) * 8 * CHUNK)
    for chunk, raw in chunks.collect():
        out[8 * CHUNK * chunk : 8 * CHUNK * (chunk + 1)] = raw
    return out[: 8 * size]


def bloom(listed: DataFrame, blocks: int, column: str = "canonical") -> Column:
    """The filter of the list as a scalar: the bytes of all words, highest byte first."""
    key = F.col(column)
    words = listed.where(key.isNotNull()).groupBy(_word(key, blocks).alias("at")).agg(F.bit_or(_mask(key)).alias("value"))
    out = table_bytes(words, 4 * blocks)
    return listed.sparkSession.createDataFrame([(out,)], "bits binary").scalar()


def may_hold(filter_bytes: Column, url: Column, blocks: int) -> Column:
    """Whether the filter has all bits of the URL: a possible hit.

    The filter stands in the expression once: each place it stood in would hold bytes of its own, in the driver and in every task.
    """
    word = F.conv(F.hex(F.substr(filter_bytes, _word(url, blocks) * 8 + 1, F.lit(8))), 16, -10).cast("long")
    return url.isNotNull() & (F.bitwise_not(word).bitwiseAND(_mask(url)) == 0)


def judge(pages: DataFrame, listed: DataFrame, id_column: str = "page_id", blocks: int = 16_384) -> DataFrame:
    """(id, host, path, rule, verdict) for every page; ``listed`` has a column ``url``."""
    known = listed.select(canonical(F.col("url").cast("string")).alias("canonical")).where("canonical is not null").distinct()
    known = materialize(known, "url-list")
    url = F.col("url").cast("string")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"))
    # written once, as it is read by both ways below
    judged = materialize(
        pages.select(F.col(id_column), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
        .withColumn("rule", rule).withColumn("_verdict", verdict), "url-rules")
    held = may_hold(bloom(known, blocks), F.col("canonical"), blocks)
    open_ = judged.withColumn("_maybe", F.col("rule").isNull() & held)
    hits = (open_.where("_maybe").join(known.withColumn("_listed", F.lit(True)), "canonical", "left")
            .select(id_column, "host", "path", "rule", F.when(F.col("_listed"), "block").otherwise("allow").alias("verdict")))
    others = open_.where("not _maybe").select(
        id_column, "host", "path", "rule", F.coalesce("_verdict", F.lit("allow")).alias("verdict"))
    return others.unionByName(hits)


#: Names of hosts whose pages make the list of the registered query.
SPAM_HOSTS = r"(^|\.)(cheap-pills|spam-farm|casino-win|ads-track|adult-x|free-bets)\."


def spam_pages(pages: DataFrame) -> DataFrame:
    """URLs of pages on hosts known for spam."""
    return pages.where(host_of(F.col("url").cast("string")).rlike(SPAM_HOSTS)).select("url")
