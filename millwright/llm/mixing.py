"""Mix sources to target weights: equal blocks of words, apportioned by Sainte-Lague, then chosen by a seed.

1. Targets. Sources share ``share`` times all words by weight; no target exceeds ``most`` times
   the source's words, and the excess is shared again by weight. That is min(cap, weight * level)
   with one level for all: sources sorted by cap / weight fill up one after the other.
2. Quotas. The mix has round(total target / block) blocks of ``block`` words. They go to sources by the
   highest quotients target / 1, target / 3, target / 5, ... A divisor of one block gives each source
   all but a few of its seats at once; only quotients near the last seat are ranked. The seats
   of a source go to its shards (hashed groups of its documents, of about ``shard_words`` words) in
   the same way, by the words of the shard.
3. Blocks. A shard's documents, in seeded order, form one run of words, cut into blocks. A quota of q of
   n blocks takes each block q div n times, and q mod n of them once more: those whose place in a
   seeded permutation (b -> (b * prime + offset) mod n) is below q mod n. No document takes part
   in full more often than its blocks.

A hot source is split into as many shards as its size asks for, so no window holds a source. Only
one row per shard or source meets in one task for the sums over all sources.

Defined results: null or wordless texts have size 0 and take 0 words; the null source is one source, the last;
repeated rows count each, equal ids are ordered by text; if no document has a word all targets are 0; an empty
table gives no row; other columns are not read. Hashes are MD5, so plain SQL gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.session import materialize

WEIGHTS = (5, 2, 1)
SPACE = " \t\n\x0b\f\r"
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)


def n_words(text: Column) -> Column:
    """Number of runs of characters that are not white space (ASCII)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hashed(*parts: Column | str) -> Column:
    """31 bits of the MD5 of the parts, joined by a bar."""
    text = F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("-")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % (1 << 31)


def targets(sizes: DataFrame, share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(in_order) - 1) % len(WEIGHTS) + 1)
    weighed = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    filled = (weighed
              .withColumn("before", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .withColumn("all", F.lit(share) * F.sum("source_size").over(everything)))
    # the level if this source and all after it are open; it holds for the first source whose cap is not below it, and is highest there
    level = (F.col("all") - F.col("before")) / F.col("open")
    one = F.max(F.when(level * F.col("weight") <= F.col("cap"), level)).over(everything)
    return filled.select("source", "source_size", F.least(F.col("cap"), F.coalesce(one * F.col("weight"), F.col("cap"))).alias("target"))


def apportion(votes: DataFrame, groups: list[str], key: list[str], seats: str, out: str) -> DataFrame:
    """Sainte-Lague seats for each row of ``votes`` (columns: groups, key, votes, ``seats`` of the group).

    With divisor votes / seats a row gets round(its votes / divisor) seats, and the sum misses the number of seats
    by at most half the rows. A row can be off by its part of that and one more; the quotients of only these
    seats are ranked.
    """
    group = Window.partitionBy(*groups)
    divisor = F.col("_all") / F.col(seats)
    counted = (votes.withColumn("_all", F.sum("votes").over(group)).withColumn("_rows", F.count(F.lit(1)).over(group))
               .withColumn("_first", F.when((F.col("votes") > 0) & (F.col(seats) > 0),
                                            F.floor(F.col("votes") / divisor + 0.5)).otherwise(0).cast("long"))
               .withColumn("_reach", (F.ceil(F.col("_rows") * F.col("votes") / F.greatest(F.col("_all"), F.lit(1))) + 2).cast("long"))
               .withColumn("_sure", F.greatest(F.col("_first") - F.col("_reach"), F.lit(0))))
    doubtful = F.when((F.col("votes") > 0) & (F.col(seats) > 0), F.sequence(F.col("_sure") + 1, F.col("_first") + F.col("_reach")))
    ranked = (counted.withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
              .withColumn("_seat", F.explode_outer(doubtful))
              .withColumn("_quotient", F.col("votes") / (2 * F.col("_seat") - 1))
              .withColumn("_rank", F.row_number().over(group.orderBy(
                  F.col("_quotient").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in key], "_seat"))))
    won = F.col("_quotient").isNotNull() & (F.col("_rank") <= F.col("_left"))
    return ranked.groupBy(*votes.columns).agg((F.first("_sure") + F.sum(won.cast("long"))).alias(out))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, block: int = 32, shard_words: int = 1 << 18,
        seed: int = 7, id_column: str = "doc_id", row: str | None = None) -> DataFrame:
    """Per document: id, source, size, source_size, target, and its blocks of the mix.

    The run of words of a document starts ``start`` words into its shard, which has ``n_blocks`` blocks and a quota.
    ``row`` names a column that is carried along; a key to join texts by, rather than texts.
    """
    sized = docs.select(F.col(id_column), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"),
                        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_text"), *([row] if row else []))
    sized = materialize(sized, "mix-sizes")
    wanted = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, most)
    wanted = materialize(wanted, "mix-targets")
    quotas = wanted.withColumnRenamed("target", "votes")
    quotas = quotas.withColumn("_seats", F.round(F.sum("votes").over(Window.partitionBy()) / block).cast("long"))
    quotas = apportion(quotas.select("source", "votes", "_seats"), [], ["source"], "_seats", "source_blocks")
    per_source = (wanted.alias("w").join(quotas.alias("q"), F.expr("w.source <=> q.source"))
                  .select("w.source", "source_size", "target", "source_blocks"))
    per_source = materialize(per_source, "mix-quotas")

    n_shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    in_shards = (sized.alias("d").join(per_source.alias("s"), F.expr("d.source <=> s.source"))
                 .select("d.*", "s.source_size", "s.target", "s.source_blocks")
                 .withColumn("shard", hashed(F.lit(str(seed)), F.lit("shard"), id_column) % n_shards))
    votes = in_shards.groupBy("source", "source_blocks", "shard").agg(F.sum("size").alias("votes"))
    shards = apportion(votes, ["source", "source_blocks"], ["shard"], "source_blocks", "quota")
    run = Window.partitionBy("source", "shard").orderBy(
        hashed(F.lit(str(seed)), F.lit("place"), id_column), F.col(id_column), "_text").rowsBetween(Window.unboundedPreceding, -1)
    placed = in_shards.withColumn("start", F.coalesce(F.sum("size").over(run), F.lit(0)))
    joined = placed.alias("d").join(
        shards.alias("s"), F.expr("d.source <=> s.source and d.shard = s.shard")
    ).select("d.*", F.col("s.votes").alias("shard_size"), "s.quota")
    blocks = F.greatest(F.ceil(F.col("shard_size") / block), F.lit(1)).cast("long")
    # rounding may give a shard a block more than its documents may be taken
    quota = F.least(F.col("quota"), F.floor(F.lit(most) * F.col("n_blocks")))
    return joined.withColumn("n_blocks", blocks).withColumn("quota", quota).withColumn(
        "offset", hashed(F.lit(str(seed)), F.lit("offset"), "source", "shard") % F.col("n_blocks")).drop("source_blocks")


def chosen(b: Column, seed: int) -> Column:
    """Whether block ``b`` of the shard is taken once more than the others."""
    place = (b * F.lit(PRIMES[seed % len(PRIMES)]) + F.col("offset")) % F.col("n_blocks")
    return place < F.col("quota") % F.col("n_blocks")


def taken(mixed: DataFrame, block: int = 32, seed: int = 7) -> DataFrame:
    """Adds ``taken``: words of the document in the mix, repeats counted."""
    first, stop = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    inside = lambda b: F.least((b + 1) * block, F.col("start") + F.col("size")) - F.greatest(b * block, F.col("start"))
    more = F.aggregate(F.filter(F.sequence(first, stop), lambda b: chosen(b, seed)), F.lit(0).cast("long"), lambda n, b: n + inside(b))
    whole = F.floor(F.col("quota") / F.col("n_blocks")) * F.col("size")
    return mixed.withColumn("taken", F.when(F.col("size") > 0, whole + more).otherwise(0).cast("long"))


def mixed_rows(docs: DataFrame, columns: list[str], block: int = 32, seed: int = 7) -> DataFrame:
    """The mix of ``docs`` as rows of the same columns, see ``mixed_texts``. Only keys and sizes are mixed; texts are shuffled once, to join them.

    ``docs`` is a stored table: its rows are numbered by their place in the files, alike in both reads.
    """
    placed = docs.select(*columns, F.monotonically_increasing_id().alias("_row"))
    mixed = mix(placed, block=block, seed=seed, row="_row").where("quota > 0 and size > 0")
    rows = mixed.select("_row", "start", "size", "quota", "n_blocks", "offset").join(placed.select("_row", F.struct(*columns).alias("row")), "_row")
    return mixed_texts(rows, "row", block, seed).select(*columns)


def mixed_texts(mixed: DataFrame, row: str, block: int = 32, seed: int = 7) -> DataFrame:
    """Rows of the mix: ``row`` (a struct with text and n_chars) for each pass over the document, with the words of that pass.

    Every block counts floor(quota / blocks) times; one pass more has the chosen blocks only. Words keep the white
    space behind them. A document of which nothing is taken gives no row.
    """
    words = F.regexp_extract_all(F.col(f"{row}.text"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    some = F.array_join(F.filter(words, lambda w, i: chosen(F.floor((F.col("start") + i) / block), seed)), "")
    times = F.floor(F.col("quota") / F.col("n_blocks")).cast("int")
    passes = F.concat(F.array_repeat(F.col(f"{row}.text"), times), F.array(F.when(F.col("quota") % F.col("n_blocks") > 0, some)))
    texts = mixed.where("size > 0").select(row, F.explode(passes).alias("_pass")).where("length(_pass) > 0")
    return texts.select(F.col(row).withField("text", F.col("_pass")).withField(
        "n_chars", F.length("_pass").cast("long")).alias(row)).select(f"{row}.*")
