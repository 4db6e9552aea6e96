"""Spelling variant grouping: words of the corpus at one edit from each other, and the form each goes back to.

1. Count. Tasks find the runs of letters of whole texts and add them up in a table of at most ``at_once`` words before the
   shuffle, so a very frequent word is a few rows per task. Words below the least length or count are no vocabulary.
2. Groups. Two words of c and c, or c and c + 1, code points at one edit are equal before and after the edit. Each word is entered
   under the lengths c and c - 1, once for an edit in the first half of the shorter word and once for the second half: the
   group is (c, window of the edit, text before it, text after it), and only the middle is compared. A group of more than ``most``
   words has its window halved, round by round; a window of one place leaves at most the alphabet (and its square for the
   longer words), so no group grows with the vocabulary. A pair belongs to the window that holds the end of its common
   prefix, and so is found once.
3. Scan. Groups are sorted and scanned with the edit matrix, three cells wide. Words that share a prefix stand side by side; the rows
   of all asked words for a prefix are computed once, from those of the prefix one shorter, and hold for every neighbour with
   that common prefix. A prefix that no asked word is within one edit of is left out with all the words that share it.
4. Forms. The near word of largest count, by an aggregation without a join; roots by doubling the chains, at most log2 of their
   length rounds, each written to the shared folder. Counts grow along a chain by ``times``, so chains are short and end.

Defined results: null and empty texts have no words; a null id is empty text in what is hashed; repeated rows count each; ties go
to the smaller word by code points; very long words are words; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millwright.llm.arrow import pa_schema, text_bytes
from millwright.session import materialize

_RUNS = re.compile("[a-zÀ-ÿ]+")
#: First bytes of code points from U+0080 on that are no letters here; 0xC3 is that of U+00C0 to U+00FF.
_LEADS = bytes(b for b in range(0xC0, 0x100) if b != 0xC3)
_LETTERS = bytes(b if ord("a") <= b <= ord("z") or b >= 0x80 else ord(" ") for b in range(256))
GROUP = ["c", "low", "high", "before", "after"]


def altered(run: bytes, h: int) -> bytes:
    """The run without its code point at ``h`` modulo its length."""
    run = run.decode()
    k = h % len(run)
    return (run[:k] + run[k + 1 :]).encode()


def runs(raw: bytes) -> list[bytes]:
    """The runs of letters, lower-cased in A-Z."""
    raw = raw.lower()  # bytes: A-Z only
    if not raw.isascii():
        raw = raw.decode("utf-8", "replace").encode()
    if len(raw.translate(None, _LEADS)) < len(raw):
        return [r.encode() for r in _RUNS.findall(raw.decode())]
    return raw.translate(_LETTERS).split()  # no other code point than U+00C0 to U+00FF has more than one byte here


def vocabulary(docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int = 199, at_once: int = 200_000,
               id_column: str = "doc_id") -> DataFrame:
    """(word, n): words of at least ``least_length`` code points that occur ``least_count`` times or more."""
    schema = "word string, n long"
    kind = pa_schema(docs, schema)

    def flushed(held: Counter) -> Iterator[pa.RecordBatch]:
        words = [w for w in held if len(w) >= 2 * least_length or len(w.decode()) >= least_length]
        for k in range(0, len(words), 50_000):
            part = words[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in part], pa.string()), pa.array([held[w] for w in part], pa.int64())],
                                             schema=kind)

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode()))
                # a run of fewer bytes than that has fewer code points, and no word of it is long enough
                for word, n in Counter([r for r in runs(raw or b"") if len(r) >= least_length]).items():
                    h = zlib.crc32(word, start)
                    held[altered(word, h) if h % every == 0 else word] += n
                if len(held) >= at_once:
                    yield from flushed(held)
                    held = Counter()
        yield from flushed(held)

    counted = docs.select(F.col(id_column), text_bytes().alias("raw")).mapInArrow(run, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _entries(words: DataFrame, c: Column, low: Column, high: Column) -> DataFrame:
    """One row per word and window: the group, the middle that is compared, and whether the word is the longer one."""
    length = F.char_length("word")
    n_after = F.greatest(F.col("c") - F.col("high"), F.lit(0))
    return (words.withColumn("c", c).withColumn("low", low).withColumn("high", high)
            .withColumn("before", F.substr("word", F.lit(1), F.col("low")))
            .withColumn("after", F.substr("word", length - n_after + 1, n_after))
            .withColumn("middle", F.substr("word", F.col("low") + 1, length - F.col("low") - n_after)))


def grouped(words: DataFrame, least_length: int = 6, most: int = 1000) -> DataFrame:
    """(c, low, high, before, after, middle, word, n): entries of groups of at most ``most`` words, or of one place."""
    length = F.char_length("word")
    classes = F.filter(F.array(length, length - 1), lambda c: c >= least_length)
    ends = words.withColumn("c", F.explode(classes)).withColumn("half", F.floor(F.col("c") / 2).cast("int"))
    windows = F.array(F.struct(F.lit(0).alias("low"), F.col("half").alias("high")),
                      F.struct(F.col("half").alias("low"), (F.col("c") + 1).alias("high")))
    open_ = ends.withColumn("w", F.explode(windows)).select("word", "n", "c", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    done = None
    while True:
        entries = _entries(open_, F.col("c"), F.col("low"), F.col("high"))
        sizes = entries.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("size")).where(
            (F.col("size") > most) & (F.col("high") - F.col("low") > 1))
        sizes = materialize(sizes, "spelling-large")
        if sizes.isEmpty():
            return entries if done is None else done.unionByName(entries)
        fits = materialize(entries.join(sizes, GROUP, "left_anti"), "spelling-groups")
        done = fits if done is None else done.unionByName(fits)
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
        open_ = materialize(entries.join(sizes, GROUP, "left_semi").withColumn("w", F.explode(halves)).select(
            "word", "n", "c", F.col("w.low").alias("low"), F.col("w.high").alias("high")), "spelling-halves")


def scan(middles: list[str], group: np.ndarray, short: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of pairs at one edit in the sorted list: a has ``short`` code points, b as many or one more.

    ``group``, ``short`` and ``window`` are given for each place. Only pairs of one group whose common prefix ends within the
    window; pairs of equal length come in both orders. Neighbours with a common prefix of d code points share a node at depth d;
    the rows of a node are computed once, from those of the node above.
    """
    length = np.array([len(m) for m in middles])
    codes = np.frombuffer("".join(f"\0{m}\0\0" for m in middles).encode("utf-32-le"), np.int32)
    start = np.cumsum(length + 3) - length - 2
    node_of = np.cumsum(np.diff(group, prepend=group[:1] - 1) != 0) - 1  # at depth 0 a node is a group
    query = np.flatnonzero(length == short)
    node, prefix = node_of[query], np.zeros(len(query), np.int32)
    # the cells of a row at depth d: of d - 1, d and d + 1 code points of the query
    cells = [np.full(len(query), x, np.int8) for x in (2, 0, 1)]
    alive, found, depth = np.arange(len(middles)), [], 0
    while len(query):
        used = np.zeros(node_of.max() + 1, bool)
        used[node] = True
        alive = alive[(length[alive] > depth) & used[node_of[alive]]]  # the rest ends here, or is more than one edit from all
        above, point = node_of[alive], codes[start[alive] + depth]
        begins = np.ones(len(alive), bool)
        begins[1:] = (above[1:] != above[:-1]) | (point[1:] != point[:-1])
        first, above, point = alive[begins], above[begins], point[begins]
        node_of[alive] = np.cumsum(begins) - 1
        low = np.searchsorted(above, node)
        n = np.searchsorted(above, node, "right") - low
        parent = np.repeat(np.arange(len(query)), n)
        node = np.arange(len(parent)) + np.repeat(low - np.cumsum(n) + n, n)
        query, prefix = query[parent], prefix[parent]
        before, same, behind = (c[parent] for c in cells)
        at, point = start[query] + depth, point[node]
        before = np.minimum(before + (codes[at - 1] != point), same + 1)
        same = np.minimum(np.minimum(same + (codes[at] != point), behind + 1), before + 1)
        behind = np.minimum(np.minimum(behind + (codes[at + 1] != point), same + 1), 2)
        near = np.flatnonzero((before <= 1) | (same <= 1) | (behind <= 1))
        node, query, cells = node[near], query[near], [np.minimum(c[near], 2) for c in (before, same, behind)]
        depth += 1
        prefix = np.where(cells[1] == 0, depth, prefix[near])
        word = first[node]  # a word that ends at this depth is the first of its node
        edits = np.where(length[query] == depth, cells[1], cells[0])
        hit = (length[word] == depth) & (edits == 1) & (prefix < window[query])
        found.append((query[hit], word[hit]))
    a, b = zip(*found) if found else ([np.zeros(0, int)], [np.zeros(0, int)])
    return np.concatenate(a), np.concatenate(b)


def near_pairs(words: DataFrame, least_length: int = 6, most: int = 1000, at_once: int = 20_000) -> DataFrame:
    """(word, near, near_n): every pair of words at exactly one edit, in both directions. A scan takes ``at_once`` entries or one group."""
    schema = "word string, near string, near_n long"
    kind = pa_schema(words, schema)
    entries = grouped(words, least_length, most)

    def pairs_of(rows: list) -> pa.RecordBatch:
        keys, middles, words, counts = zip(*[(r[:5], *r[5:]) for r in rows])
        group = np.cumsum([k != last for k, last in zip(keys, (None, *keys))])
        short = np.array([c - low - max(c - high, 0) for c, low, high, *_ in keys])
        a, b = scan(middles, group, short, np.array([high - low for _, low, high, *_ in keys]))
        longer = np.array([len(m) for m in middles])[b] > short[b]
        u, w = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
        words, counts = pa.array(words, pa.string()), pa.array(counts, pa.int64())
        return pa.RecordBatch.from_arrays([words.take(u), words.take(w), counts.take(w)], schema=kind)

    def run(batches):
        rows: list = []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(8))):
                if len(rows) >= at_once and row[:5] != rows[-1][:5]:
                    yield pairs_of(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield pairs_of(rows)

    # the scan is long for its bytes: as many tasks as the session deals to, none merged
    n_tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = entries.repartition(n_tasks, *GROUP).sortWithinPartitions(*GROUP, "middle")
    return dealt.select(*GROUP, "middle", "word", "n").mapInArrow(run, schema)


def forms(words: DataFrame, pairs: DataFrame, times: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n): a word's form is its near word of largest n, if that is ``times`` its own or more."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    by_word = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(by_word, "word", "left")
    large = -F.col("best.less") >= times * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """Adds ``root``: the last word of the chain of forms from a word, itself if it has none."""
    chain = materialize(formed.where("form is not null").select("word", F.col("form").alias("root")), "spelling-chains")
    while True:
        further = chain.alias("a").join(chain.alias("b"), F.expr("a.root = b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved"))
        further = materialize(further, "spelling-chains")
        chain = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    return formed.join(chain, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group(docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int = 199, times: int = 5, most: int = 1000,
          id_column: str = "doc_id") -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = materialize(vocabulary(docs, least_length, least_count, every, id_column=id_column), "spelling-words")
    formed = materialize(forms(words, near_pairs(words, least_length, most), times), "spelling-forms")
    return roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
