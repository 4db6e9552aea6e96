"""SpotSigs: documents as sets of spot signatures, compared by Jaccard.

A spot is a common word (anchor) in the text; its signature is the anchor and a chain of the ``CHAIN`` content words
that follow it. Boiler-plate has few anchors in running text, so its share in the set is small. The fingerprint of a
text is the sorted set of 32-bit hashes of its signatures, in hexadecimal; a text with words but without a
whole chain has one signature of all its words, so different texts have different fingerprints.

``likeness`` compares two fingerprints. ``near_pairs`` finds all pairs above a threshold: sets are partitioned by length, only
partitions whose lengths can reach the threshold meet, and in them only sets that share one of their first hashes.

``edited_pairs`` takes each document with the one that follows in descending order of id. Documents are dealt out by
ranges of ids; each range also gets the first document of the range below it, so every text is shuffled once.

Defined results: null and empty texts have the empty fingerprint; two empty ones are alike (1), an empty and another one are not
(0); null ids come last; equal ids are ordered by text; a single document follows itself; an empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millwright.llm.arrow import decoded, pa_schema
from millwright.session import materialize

CHAIN = 2

#: Anchors, and further common words that are no content, in four languages.
ANCHORS = "a an the is was to / le la les un une est / der die das ein eine ist / el los las una es".replace("/", "").split()
COMMON = ("and of in on it that this for with as at by be are or from not he she they you we / et de des du en que qui dans pour par pas "
          "avec au aux elle / und von mit den dem im als auch nicht zu für sich / y del en que por con para se al lo su").replace("/", "").split()
SIGNS = b".,;:!?\"'()[]{}<>|*#$%&-_/\\"

_ANCHOR = {w.encode(): i + 1 for i, w in enumerate(dict.fromkeys(ANCHORS))}
_COMMON = {w.encode() for w in COMMON} - _ANCHOR.keys()
_KIND = dict.fromkeys(_COMMON, -1) | _ANCHOR
M1, M2, M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * M1
    return (h ^ (h >> np.uint64(27))) * M2


def signatures(text: str) -> np.ndarray:
    """Sorted 32-bit hashes of all spot signatures."""
    words = [w for w in (x.strip(SIGNS) for x in text.encode("utf-8", "replace").lower().split()) if w] if text else []
    kinds = np.fromiter((_KIND.get(w, 0) for w in words), np.int32, len(words))
    content = np.flatnonzero(kinds == 0)
    hashes = np.fromiter((xxhash.xxh64_intdigest(words[i]) for i in content.tolist()), np.uint64, len(content))
    spots = np.flatnonzero(kinds > 0)
    begin = np.searchsorted(content, spots)
    spots, begin = spots[begin + CHAIN <= len(content)], begin[begin + CHAIN <= len(content)]
    if not len(spots):
        if not text:
            return np.empty(0, np.uint32)
        return np.array([xxhash.xxh32_intdigest(text.encode("utf-8", "replace"))], np.uint32)
    out = kinds[spots].astype(np.uint64)
    for j in range(CHAIN):
        out = _mix(out * M3 + hashes[begin + j])
    return np.unique((out >> np.uint64(32)).astype(np.uint32))


def as_text(signature_set: np.ndarray) -> str:
    return signature_set.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 without looking inside where the lengths alone keep it below ``least``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    both = np.count_nonzero(np.isin(a, b, assume_unique=True)) if len(a) < len(b) else np.count_nonzero(np.isin(b, a, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


PAIR_SCHEMA = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")


def edited_pairs(docs: DataFrame, id_column: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = -(1 << 63)  # the place of null ids
    keyed = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(id_column).cast("long"), F.lit(last)).alias("key"),
                        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"))
    cuts = sorted(set(keyed.where("id is not null").approxQuantile("id", [i / parts for i in range(1, parts)], 0.2 / parts)))
    part = F.aggregate(F.array(*[F.lit(int(c)) for c in cuts]), F.lit(0), lambda n, c: n + (c <= F.col("key")).cast("int")) if cuts else F.lit(0)
    ranges = sorted((r["part"], r["top"]) for r in keyed.select(part.alias("part"), "key").groupBy("part").agg(F.max("key").alias("top")).collect())
    # the first document of the range below; below the lowest range comes the highest
    borrowed = [(ranges[i - 1][1], p) for i, (p, _) in enumerate(ranges)]
    lenders = F.filter(F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(p).alias("p")) for k, p in borrowed]), lambda x: x["k"] == F.col("key")) if borrowed else None
    own = F.array(F.struct(part.alias("part"), F.lit(0).alias("lent")))
    seats = F.concat(own, F.transform(lenders, lambda x: F.struct(x["p"].alias("part"), F.lit(1).alias("lent")))) if borrowed else own
    dealt = (keyed.withColumn("seat", F.explode(seats)).select("seat.part", "seat.lent", "id", "key", "raw")
             .repartition(parts, "part").sortWithinPartitions("part", "lent", F.desc("key"), "raw"))
    kind = pa_schema(docs, PAIR_SCHEMA)

    def row(one, two):
        text, prints = one[1], one[2]
        changed = edited(text, two[1])
        after = signatures(changed)
        return {"id": one[0], "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                "fingerprint": as_text(prints), "edited_fingerprint": as_text(after),
                "near_edited": likeness(prints, after), "near_next": likeness(prints, two[2])}

    def run(batches):
        before, at = None, None  # the document that waits for its next one; the range
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                out = []
                for r in batch.slice(start, 200).to_pylist():
                    if r["part"] != at:
                        at, before = r["part"], None
                    if r["lent"] and before is None:
                        continue  # the range has its next document already
                    text = decoded(r["raw"])
                    now = (r["id"], text, signatures(text))
                    if before is not None:
                        out.append(row(before, now))
                    before = None if r["lent"] else now
                yield pa.RecordBatch.from_pylist(out, schema=kind)

    return dealt.mapInArrow(run, PAIR_SCHEMA).withColumnRenamed("id", id_column)


def fingerprints(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, n, signatures): the sorted hashes of every text."""
    schema = "id long, n int, signatures array<long>"
    kind = pa_schema(docs, schema)

    def run(batches):
        for batch in batches:
            sets = [signatures(decoded(raw.as_py())) for raw in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int32()),
                                              pa.array([s.astype(np.int64) for s in sets], kind.field(2).type)], schema=kind)

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("binary").alias("raw"))
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def near_pairs(prints: DataFrame, least: float = 0.44, id_column: str = "doc_id") -> DataFrame:
    """(a, b, likeness) of all pairs of different sets at least ``least`` alike, between the smallest ids of equal sets.

    Lengths are partitioned in steps of 1 / least; a set meets its own partition and the one above.
    """
    first = prints.where("n > 0").groupBy("signatures", "n").agg(F.min(id_column).alias("id"))
    first = materialize(first, "spot-sets")
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / least))).cast("int")
    need = F.ceil(F.lit(least) * F.col("n") - F.lit(1e-9))
    posted = first.select("id", "n", step.alias("step"), F.explode(F.slice("signatures", F.lit(1), (F.col("n") - need + 1).cast("int"))).alias("h"))
    left, right = posted.withColumn("meet", F.explode(F.array("step", F.col("step") + 1))).alias("l"), posted.alias("r")
    met = left.join(right, F.expr("l.h = r.h and l.meet = r.step and (l.step < r.step or l.id < r.id)")
                    & (F.least("l.n", "r.n") >= least * F.greatest("l.n", "r.n"))).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()
    sets = first.select("id", "signatures")
    both = (met.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        (shared / (F.size("sa") + F.size("sb") - shared)).alias("likeness")).where(F.col("likeness") >= least))
