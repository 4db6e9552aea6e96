"""Filter interaction audit: what each of five filters removes, alone and in every order of the five.

Filters A to D judge a text by itself. Filter E fails a text that equals the text of a smaller id anywhere in the table; it
is decided by compressed tries over whole texts:

1. Input tasks measure each text (a mask of the filters it fails) and insert it into a radix trie whose terminals hold the
   minimum id. After ``trie_bytes`` of text the trie is traversed and a new one begun. An id above the minimum of its own
   trie is a copy and goes on without its text, equal rows of a trie go on as one row with a count; so a text that a third of
   all rows share is sent once per trie.
2. Those rows are dealt to ranges by adaptive text prefixes: of a sample of the texts, cut to prefixes that grow only where
   they leave too many texts together, the boundaries are the shortest prefixes that part neighbours. The sample decides
   where a text goes, never the result; equal texts always go to one range.
3. A range is sorted by text (Spark spills) and inserted into tries again, each begun between two different texts after
   ``trie_bytes``, so memory is bounded however large a range is. Traversal yields the minimum id of each text.
4. Masks are reduced to counts by part and mask, 32 at most for a part. The orders are counted from these alone.

Texts are shuffled once, and nothing but the sample is written: lost tasks are repeated from the table.

Defined results: null texts are empty, and equal to each other; of equal texts all but those of the least id fail E, so repeated
rows of the least id pass; a null id counts as larger than all others; a null source is the part ""; a document is good or
toxic if any of its label rows says so; without labels it is neither; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import permutations
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millwright.llm.arrow import pa_schema, text_bytes
from millwright.session import materialize

FILTERS = "ABCDE"
COPY = 1 << 4
_MARKS = re.compile(rb"[#$%&*|]")
_NO_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_FOLLOWING = bytes(range(0x80, 0xC0))
NO_ID = 1 << 63  # above every id


class Trie:
    """A radix trie over byte strings: edges hold runs of bytes, terminals the least id of a text."""

    def __init__(self):
        self.root: list = [None, {}]  # [least id or None, {first byte: [edge, node]}]
        self.n_bytes = 0

    def insert(self, text: bytes, i: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            way = node[1].get(text[at])
            if way is None:
                node[1][text[at]] = [text[at:], [i, {}]]
                self.n_bytes += len(text) - at + 200
                return
            edge = way[0]
            if not text.startswith(edge, at):
                shared = len(commonprefix([edge, text[at : at + len(edge)]])) if len(edge) < 64 else _shared(edge, text[at : at + len(edge)])
                way[0], way[1] = edge[:shared], [None, {edge[shared]: [edge[shared:], way[1]]}]
                self.n_bytes += 200
                edge = way[0]
            node, at = way[1], at + len(edge)
        if node[0] is None or i < node[0]:
            node[0] = i

    def least(self, text: bytes) -> int:
        """The least id of a text that was inserted."""
        node, at = self.root, 0
        while at < len(text):
            edge, node = node[1][text[at]]
            at += len(edge)
        return node[0]


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def mask(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()  # bytes split at ASCII white space only
    capitals = len(raw) - len(raw.translate(None, _NO_CAPITALS))
    points = len(raw.translate(None, _FOLLOWING))
    return ((len(words) < 50) | (100 * len(set(words)) < 65 * len(words)) << 1 | (100 * capitals > 5 * points) << 2
            | (_MARKS.search(raw) is not None) << 3)


def boundaries(texts: DataFrame, n_ranges: int, share: float, probe: int = 32) -> list[bytes]:
    """Up to ``n_ranges`` - 1 shortest prefixes that part the texts into ranges of about as many different sampled texts.

    Prefixes of ``probe`` bytes are collected with their counts; texts under one that holds more than half a range are read
    with twice the length, until no such prefix is left or its texts end. ``share`` of the texts is sampled.
    """
    if n_ranges < 2:
        return []
    sample = texts.sample(share, seed=11) if share < 1 else texts
    sample = materialize(sample.groupBy("raw").agg(F.octet_length("raw").alias("n")), "audit-sample")
    done: dict[bytes, int] = {}
    length, open_ = probe, None
    while True:
        cut = sample.select(F.substring("raw", 1, length).alias("p"), (F.col("n") > length).alias("more"))
        if open_ is not None:
            cut = cut.where(F.substring("p", 1, length // 2).isin(open_))
        found = cut.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.max("more").alias("more")).collect()
        limit = max(1, sum(done.values()) + sum(r["n"] for r in found)) / n_ranges / 2
        open_ = [bytes(r["p"]) for r in found if r["more"] and r["n"] > max(limit, 1)]
        heavy = set(open_)
        done |= {bytes(r["p"]): r["n"] for r in found if bytes(r["p"]) not in heavy}
        if not open_:
            break
        length *= 2
    in_order = sorted(done.items())
    target, held, cuts = sum(done.values()) / n_ranges, 0, []
    for (a, n), (b, _) in zip(in_order, in_order[1:]):
        held += n
        if held >= target * (len(cuts) + 1):
            cuts.append(b[: _shared(a, b) + 1])
    return sorted(set(cuts))


def measure(docs: DataFrame, cuts: list[bytes], trie_bytes: int = 32 << 20, id_column: str = "doc_id") -> DataFrame:
    """(i, part, mask, n, range, raw): the first tries. raw is set on the rows of the least id of a text, the others are copies."""
    schema = "i long, part string, mask int, n long, `range` int, raw binary"
    source = docs.select(F.col(id_column).cast("long").alias("i"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                         F.coalesce(text_bytes(), F.lit(b"")).alias("raw"))
    kind = pa_schema(docs, schema)

    def flushed(trie: Trie, rows: Counter) -> Iterator[pa.RecordBatch]:
        out = []
        for k, ((i, part, bits, raw), n) in enumerate(rows.items()):
            if trie.least(raw) == (NO_ID if i is None else i):
                out.append((i, part, bits, n, bisect_right(cuts, raw), raw))
            else:
                out.append((i, part, bits | COPY, n, k % (len(cuts) + 1), None))
        for k in range(0, len(out), 500):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 500]), kind.types)], schema=kind)

    def run(batches):
        trie, rows, held = Trie(), Counter(), 0
        for batch in batches:
            for i, part, raw in zip(*(batch.column(c).to_pylist() for c in range(3))):
                trie.insert(raw, NO_ID if i is None else i)
                rows[i, part, mask(raw), raw] += 1
                held += len(raw) + 200
                if held >= trie_bytes:
                    yield from flushed(trie, rows)
                    trie, rows, held = Trie(), Counter(), 0
        yield from flushed(trie, rows)

    return source.mapInArrow(run, schema)


def decide(measured: DataFrame, n_ranges: int, trie_bytes: int = 32 << 20) -> DataFrame:
    """(i, part, mask, n) with E decided: the tries of the ranges. Rows without a text are decided already."""
    schema = "i long, part string, mask int, n long"
    kind = pa_schema(measured, schema)

    def flushed(trie: Trie, rows: list) -> Iterator[pa.RecordBatch]:
        out = [(i, part, bits | COPY if raw is not None and trie.least(raw) < (NO_ID if i is None else i) else bits, n)
               for i, part, bits, n, raw in rows]
        for k in range(0, len(out), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 10_000]), kind.types)], schema=kind)

    def run(batches):
        trie, rows, last = Trie(), [], None
        for batch in batches:
            for i, part, bits, n, raw in zip(*(batch.column(c).to_pylist() for c in range(5))):
                # equal texts stand side by side
                if raw != last and (trie.n_bytes >= trie_bytes or len(rows) >= 100_000):
                    yield from flushed(trie, rows)
                    trie, rows = Trie(), []
                elif raw is None and len(rows) >= 100_000:
                    yield from flushed(trie, rows)
                    rows = []
                last = raw = last if raw == last else raw
                if raw is not None:
                    trie.insert(raw, NO_ID if i is None else i)
                rows.append((i, part, bits, n, raw))
        yield from flushed(trie, rows)

    dealt = measured.repartitionById(n_ranges, F.col("range")).sortWithinPartitions("raw")
    return dealt.select("i", "part", "mask", "n", "raw").mapInArrow(run, schema)


def flags(docs: DataFrame, trie_bytes: int = 32 << 20, range_bytes: int = 32 << 20, per_range: int = 16, most_sampled: int = 1 << 17,
          id_column: str = "doc_id") -> DataFrame:
    """(i, part, mask, n): n rows each; bit k of mask is set if they fail filter k of ABCDE.

    There is a range for each ``range_bytes`` of text, and a sample of ``per_range`` texts for each, ``most_sampled`` at most.
    """
    raw = docs.select(F.coalesce(text_bytes(), F.lit(b"")).alias("raw"))
    n_texts, n_bytes = raw.agg(F.count(F.lit(1)), F.sum(F.octet_length("raw"))).first()
    n_ranges = -(-(n_bytes or 0) // range_bytes)
    cuts = boundaries(raw, n_ranges, min(1.0, per_range * n_ranges / max(1, n_texts), most_sampled / max(1, n_texts)))
    return decide(measure(docs, cuts, trie_bytes, id_column), len(cuts) + 1, trie_bytes)


def reduced(flagged: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, and those labelled so."""
    known = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("i")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    counted = flagged.groupBy("i", "part", "mask").agg(F.sum("n").alias("n"))  # an id of many rows is few rows from here
    joined = counted.join(known.select(F.col("i").alias("li"), "good", "toxic"), F.expr("i = li"), "left")
    some = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), some("good"), some("toxic"))


def orders(n: int = len(FILTERS)) -> list[dict]:
    """Order, step, bits of the filters before and bit of the filter at this step, of all orders."""
    return [{"o": "".join(FILTERS[k] for k in order), "s": s + 1, "before": sum(1 << k for k in order[:s]), "own": 1 << order[s]}
            for order in permutations(range(n)) for s in range(n)]


def audit(masks: DataFrame) -> DataFrame:
    """One row per part, order and step from ``reduced``. All counts come from the masks of a part, 32 at most."""
    per_part = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = F.from_json(F.lit(json.dumps(orders())), "array<struct<o:string,s:int,before:int,own:int>>")
    per_step = per_part.withColumn("step", F.explode(steps)).select("part", "masks", "step.*")
    has = lambda m, bits: m["mask"].bitwiseAND(bits) != 0
    total = lambda keep, value: F.aggregate(
        F.filter("masks", keep), F.lit(0).cast("long"), lambda s, m: s + value(m))
    before, own = F.col("before"), F.col("own")
    removed = lambda m: has(m, own) & ~has(m, before)
    count = lambda m: m["n"]
    # over all orders a filter comes first of the k filters a document fails in 120 / k
    share = lambda m: m["n"] * F.element_at(F.array(*[F.lit(120 // k) for k in range(1, 6)]), F.bit_count(m["mask"]))
    return per_step.select(
        "part", F.col("o").alias("filter_order"), F.col("s").cast("int").alias("step"),
        total(lambda m: ~has(m, before) & ~has(m, own), count).alias("kept"), total(removed, count).alias("removed"),
        total(lambda m: has(m, own) & has(m, before), count).alias("redundant"),
        total(lambda m: m["mask"] == own, count).alias("unique_fails"),
        total(removed, lambda m: m["good"]).alias("good_lost"), total(removed, lambda m: m["toxic"]).alias("toxic_lost"),
        total(lambda m: has(m, own), share).alias("shapley"))
