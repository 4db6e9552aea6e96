"""Quality rules: counts of each text, and a log-likelihood ratio of hashed n-grams.

Words and word pairs are hashed into ``buckets``. Two multinomials are counted over all documents: the raw corpus,
and the trusted target (the documents ``trusted`` names). The score of a document is the mean, over its
n-grams, of log((target + smooth) / (raw * target size / raw size + smooth)): an n-gram no one has seen
often says nothing. A document is kept if it passes the base rules and its score is at least ``least``.
Every document is judged by the same fixed threshold, so reruns agree.

Counting explodes n-grams into a map-side aggregate of at most ``buckets`` rows per task; the tables of both
multinomials have ``buckets`` rows, whatever the corpus. They reach the scoring as one scalar array.

Defined results: null or wordless texts have 0 in all counts and fail the base rules; the score of a text without
n-grams is 0; without trusted documents every score is 0; repeated rows count each; an empty table gives no
row; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

def words(text: Column) -> Column:
    """Maximal runs of characters that are not white space (ASCII)."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def neighbours(hashes: Column, apart: int) -> Column:
    """Hash of each element with the one ``apart`` places on; the last ``apart`` results mean nothing."""
    return F.zip_with(hashes, F.slice(hashes, F.lit(apart + 1), F.size(hashes)), lambda x, y: F.xxhash64(x, y))


def first(values: Column, n: Column) -> Column:
    return F.slice(values, F.lit(1), F.greatest(n, F.lit(0)))


def repeated_words(pairs: Column) -> Column:
    """Words in windows of 8 found twice or more, by ``neighbours`` of all words; windows are hashed by doubling."""
    width, n = 8, F.size(pairs) - 7
    windows = let(neighbours(pairs, 2), lambda fours: first(neighbours(fours, 4), F.size(fours) - 7))

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda p, k: F.when(
            k + 1 < F.size(starts), F.least(F.lit(width), F.get(starts, k + 1) - p)).otherwise(width))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    def count(seen: Column) -> Column:
        # windows sorted by hash: equal neighbours are the repeated ones; their starts, in order, cover words
        repeated = lambda s: F.filter(s, lambda x, k: (
            F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        in_order = F.array_sort(F.transform(seen, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = F.array_sort(F.transform(let(in_order, repeated), lambda x: x["i"]))
        return F.when(F.size(F.array_distinct(seen)) == F.size(seen), 0).otherwise(let(starts, covered))

    return F.when(n < 2, 0).otherwise(let(windows, count)).cast("long")


def ngrams(hashes: Column, pairs: Column) -> Column:
    """Hashes of all words and all pairs of neighbours."""
    return F.concat(hashes, first(pairs, F.size(hashes) - 1))


def bucket(h: Column, buckets: int) -> Column:
    """The lowest bits; ``buckets`` is a power of two."""
    return h.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")


def _texts(docs: DataFrame, id_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int, smooth: float, id_column: str = "doc_id") -> list[float]:
    """The log ratio of each bucket. ``trusted`` has the ids of the target; ids are compared, not texts.

    Both corpora are counted in one pass: at most ``buckets`` rows per task, and for the driver. The texts are dealt by id
    once, whatever the size of ``trusted``, so that work and disk grow as the input does."""
    ids = trusted.select(F.col(id_column).alias("_id")).where("_id is not null").distinct().withColumn("_trusted", F.lit(1))
    grams = (_texts(docs, id_column).join(ids.hint("merge"), "_id", "left")
             .select("_trusted", F.explode(let(_hashes(words(F.col("_t"))), lambda h: ngrams(h, neighbours(h, 1)))).alias("h"))
             .select("_trusted", bucket(F.col("h"), buckets).alias("b")))
    raw, target = [0] * buckets, [0] * buckets
    for b, n, m in grams.groupBy("b").agg(F.count(F.lit(1)), F.count("_trusted")).collect():
        raw[b], target[b] = n, m
    scale = sum(target) / max(1, sum(raw))
    return [math.log((m + smooth) / (n * scale + smooth)) for n, m in zip(raw, target)]


def judge(docs: DataFrame, trusted: DataFrame, buckets: int = 1 << 16, smooth: float = 5.0, least: float = -0.25,
          id_column: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    ``keep`` names further columns to pass through.
    """
    table = ratios(docs, trusted, buckets, smooth, id_column)
    ratio = F.col("_ratio")
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    score = lambda g: F.aggregate(
        g, F.lit(0.0), lambda s, x: s + F.get(ratio, bucket(x, buckets)), lambda s: F.when(F.size(g) > 0, s / F.size(g)).otherwise(0.0))
    measures = lambda w: let(_hashes(w), lambda h: let(neighbours(h, 1), lambda p: F.struct(
        F.size(h).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeated_words(p).alias("n_repeat_words"),
        let(ngrams(h, p), score).alias("score"))))
    measured = (
        docs.select(F.col(id_column).alias("_id"), *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"),
                    docs.sparkSession.createDataFrame([(table,)], "r array<double>").scalar().alias("_ratio"))
        # generated, so that no filter on the verdict is pushed below and has all measures taken once more
        .withColumn("_m", F.explode(F.array(let(words(F.col("_t")), measures)))))
    n, repeats = F.col("_m.n_words").cast("long"), F.col("_m.n_repeat_words")
    failed = (n < 20) | (100 * repeats > 30 * n)
    return measured.select(
        F.col("_id").alias(id_column), n.alias("n_words"), F.col("_m.word_chars").cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"), failed.alias("base_failed"), F.col("_m.score").alias("score"),
        (~failed & (F.col("_m.score") >= least)).alias("kept"), *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)])
