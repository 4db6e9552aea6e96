"""Near-duplicate documents by one-permutation MinHash, with links confirmed on full shingle sets.

1. Each document's shingles are hashed once and dealt into BANDS * ROWS bins; the least hash of a bin is its value. An empty
   bin takes the value of another one by optimal densification: the first non-empty bin in a fixed random
   order of its own. Six bins form a band; at a similarity of 0.8 two sets share none of the 50 bands with
   a chance of 3e-7.
2. Documents with equal sets are one class. Classes that share a band are candidates; a bucket links its members to one
   hub only (a star), the member that shares most buckets with others, so a bucket of m makes m - 1
   pairs. Pairs are confirmed on full sets, and components are grown over the links.
3. A star can miss a link between two members that are both unlike the hub. Where the members of a bucket are in
   more than one component, they are compared again by an exact rule: two sets that are similar enough share one
   of their rarest shingles (prefix filter), and only pairs of different components are confirmed.

All counts use map-side combine; the frequencies that order the shingles of step 3 are a table of fixed size, and
any order is exact.

Defined results: null, empty and wordless texts have an empty set, are linked with nothing and kept; rows that repeat an
id get one result each; of rows without an id, none names a component unless all its members lack one; an empty
table gives no row; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millwright.llm.arrow import pa_schema
from millwright.llm.url_filter import bloom, may_hold, table_bytes
from millwright.session import materialize

BANDS, ROWS = 50, 6
BINS = BANDS * ROWS
FREQUENCIES, FILTER = 1 << 18, 1 << 15  # sizes of the table of step 3 and of the filter of documents
M1, M2, M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def shingle_set(raw: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of all distinct shingles. Words are cut at ASCII white space, A-Z lower-cased."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    n = len(words)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    width = min(n, width)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out = mix(out * M3 + hashes[j : n - width + 1 + j])
    return np.unique(out)


@lru_cache(maxsize=1)
def _orders() -> tuple[np.ndarray, np.ndarray]:
    """For each bin a random order of all bins, and the place of each bin in it."""
    rng = np.random.default_rng(20)
    order = np.argsort(rng.random((BINS, BINS)), axis=1)
    return order, np.argsort(order, axis=1)


def bands(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the bands of a non-empty set."""
    bins = (hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    held = bins[first].astype(np.int64)
    values = np.zeros(BINS, np.uint64)
    values[held] = hashes[first]
    if len(held) < BINS:
        full = np.zeros(BINS, bool)
        full[held] = True
        empty, donor = np.flatnonzero(~full), None
        order, place = _orders()
        donor = np.empty(len(empty), np.int64)
        open_ = np.arange(len(empty))
        for attempt in range(12):
            lender = order[empty[open_], attempt]
            hit = full[lender]
            donor[open_[hit]] = lender[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        if len(open_):
            donor[open_] = held[np.argmin(place[np.ix_(empty[open_], held)], axis=1)]
        values[empty] = values[donor]
    out = np.arange(BANDS, dtype=np.uint64)
    for row in values.reshape(BANDS, ROWS).T:
        out = mix(out * M3 + row)
    return out


def set_key(hashes: np.ndarray) -> int:
    """64 bits that stand for the whole set."""
    sums = np.array([hashes.sum()], np.uint64) * M3 ^ np.array([mix(hashes ^ M1).sum()], np.uint64) + np.uint64(len(hashes))
    return int(mix(sums).view(np.int64)[0])


def _signatures(docs: DataFrame, id_column: str, width: int) -> DataFrame:
    schema = "id long, n_shingles long, cid long, bands array<long>"
    kind = pa_schema(docs, schema)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                sizes, keys, rows = [], [], []
                for raw in part.column(1).to_pylist():
                    hashes = shingle_set(raw, width)
                    sizes.append(len(hashes))
                    keys.append(set_key(hashes) if len(hashes) else None)
                    rows.append(bands(hashes).view(np.int64) if len(hashes) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(rows, kind.field(3).type)], schema=kind)

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("binary").alias("raw")).mapInArrow(run, schema)


def _sets(docs: DataFrame, id_column: str, width: int, wanted: DataFrame) -> DataFrame:
    """(cid, n, hashes) of the wanted classes, from one document of each; only these documents are shuffled."""
    schema = "cid long, n long, hashes array<long>"
    kind = pa_schema(docs, schema)
    bits = bloom(wanted.select("label"), FILTER, "label")
    some = (docs.select(F.col(id_column).cast("long").alias("label"), F.col("text").cast("binary").alias("raw"))
            .where(F.col("label").isNull() | may_hold(bits, F.col("label"), FILTER)))
    some = some.alias("d").join(wanted.alias("w"), F.expr("d.label <=> w.label")).select("raw", "w.cid")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                out = []
                for row in batch.slice(start, 500).to_pylist():
                    hashes = shingle_set(row["raw"], width)
                    if len(hashes) and set_key(hashes) == row["cid"]:  # an id may have several texts
                        out.append({"cid": row["cid"], "n": len(hashes), "hashes": hashes.view(np.int64)})
                yield pa.RecordBatch.from_pylist(out, schema=kind)

    return some.mapInArrow(run, schema).dropDuplicates(["cid"])


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough."""
    one = pairs.join(sets.select(F.col("cid").alias("a"), F.col("hashes").alias("ha")), "a")
    two = one.join(sets.select(F.col("cid").alias("b"), F.col("hashes").alias("hb")), "b")
    both = F.size(F.array_intersect("ha", "hb"))
    # sets are distinct, so the union has size(ha) + size(hb) - both
    return two.where(100 * both >= percent * (F.size("ha") + F.size("hb") - both)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(cid, comp): the least class reachable. Labels sink along links and jump to their label's label."""
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("comp")).withColumnRenamed("a", "cid"), "labels")
    while True:
        near = (both.join(labels.select(F.col("cid").alias("b"), F.col("comp").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
                .withColumnRenamed("a", "cid"))
        sunk = labels.join(near, "cid").select("cid", F.col("comp").alias("old"), F.least("comp", "c").alias("comp"))
        jump = labels.select(F.col("cid").alias("comp"), F.col("comp").alias("far"))
        new = materialize(sunk.join(jump, "comp", "left").select(
            "cid", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp")), "labels")
        labels = new.select("cid", "comp")
        if new.where("comp != old").isEmpty():
            return labels


def link(docs: DataFrame, id_column: str = "doc_id", width: int = 4, percent: int = 80) -> DataFrame:
    """Per document: id, n_shingles, component_id (least id reachable), kept (id = component_id)."""
    signed = materialize(_signatures(docs, id_column, width), "minhash")
    classes = (signed.where("n_shingles > 0").groupBy("cid")
               .agg(F.min("id").alias("label"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    spread = classes.select("cid", "label", "n", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = materialize(spread.join(shared, "bucket"), "minhash-buckets")

    wanted = members.groupBy("cid").agg(F.first("label").alias("label"), F.first("n").alias("n"), F.sum("members").alias("known"))
    wanted = materialize(wanted, "minhash-wanted")
    sets = materialize(_sets(docs, id_column, width, wanted), "minhash-sets")
    hubs = (members.select("bucket", "cid").join(wanted.select("cid", "n", "known"), "cid")
            .groupBy("bucket").agg(F.max(F.struct("known", F.col("cid").alias("hub"), F.col("n").alias("hub_n"))).alias("h")).select("bucket", "h.*"))
    star = (members.join(hubs, "bucket").where(F.expr("cid != hub") & _sizes_allow("n", "hub_n", percent))
            .select(F.col("cid").alias("a"), F.col("hub").alias("b")).distinct())
    links = materialize(_confirmed(star, sets, percent), "minhash-links")
    comps = components(links)

    in_comps = members.select("bucket", "cid").join(comps, "cid", "left").select("bucket", "cid", F.coalesce("comp", "cid").alias("comp"))
    split = in_comps.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 != c1").select("bucket")
    rest = materialize(in_comps.join(split, "bucket", "left_semi").select("cid", "comp").distinct(), "minhash-rest")
    more = _prefix_links(rest.join(sets, "cid"), sets, percent)
    more = materialize(more, "minhash-links")
    if not more.isEmpty():
        comps = components(links.unionByName(more))

    final = (classes.select("cid", "label").join(comps, "cid", "left").select("cid", "label", F.coalesce("comp", "cid").alias("comp")))
    named = comps.join(wanted.select("cid", "label"), "cid").groupBy("comp").agg(F.min("label").alias("component"))
    result = final.join(named, "comp", "left").select("cid", F.coalesce("component", "label").alias("component"))
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))
    return (signed.select("id", "n_shingles", "cid").join(result, "cid", "left")
            .select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id"))))


def _prefix_links(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of ``rest`` (cid, comp, n, hashes), by shared rare shingles."""
    rest = materialize(rest, "minhash-rest-sets")
    place = lambda h: F.pmod(h, F.lit(FREQUENCIES)).cast("int")
    found = rest.select(F.explode("hashes").alias("h")).select(place(F.col("h")).alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("value"))
    counts = np.frombuffer(table_bytes(found, FREQUENCIES), ">i8").tolist()
    frequency = F.col("frequency")
    rest = rest.withColumn("frequency", rest.sparkSession.createDataFrame([(counts,)], "f array<int>").scalar())
    ranked = F.array_sort(F.transform("hashes", lambda h: F.struct(F.element_at(frequency, place(h) + 1).alias("f"), h.alias("h"))))
    length = F.expr(f"n - cast(ceil({percent} * n / 100.0) as bigint) + 1").cast("int")
    prefix = rest.select("cid", "comp", "n", F.posexplode(F.slice(ranked, F.lit(1), length)).alias("at", "r")).select("cid", "comp", "n", "at", "r.h")
    prefix = materialize(prefix, "minhash-prefix")
    # of each shingle the largest component is the one the others are compared with; pairs inside it are never made
    by_comp = prefix.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = by_comp.groupBy("h").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("c", "comp"))["comp"].alias("main")).where("comps > 1")
    posted = materialize(prefix.join(main.select("h", "main"), "h"), "minhash-posted")
    left, right = posted.where("comp != main").alias("l"), posted.alias("r")
    # at their first shared shingle, two sets can share no more than what follows it in either
    reach = F.expr(f"(100 + {percent}) * least(l.n - l.at, r.n - r.at) >= {percent} * (l.n + r.n)")
    pairs = left.join(right, F.expr("l.h = r.h and l.comp != r.comp and (r.comp = r.main or l.cid < r.cid)")
                      & _sizes_allow("l.n", "r.n", percent) & reach)
    pairs = pairs.select(F.least("l.cid", "r.cid").alias("a"), F.greatest("l.cid", "r.cid").alias("b")).distinct()
    return _confirmed(pairs, sets, percent)
