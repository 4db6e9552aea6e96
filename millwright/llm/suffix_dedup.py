"""Exact substring dedup: find every ``WIDTH``-byte string that starts at two or more places, and cut the bytes it covers.

The sorted order of suffixes and their common prefixes are built column by column: each round puts one symbol in
front of every string of a collection, the symbols in the order of the round before are one column of
the collection's Burrows-Wheeler transform, a stable sort by them gives the new order, and the
common prefix of two neighbours is one more than the least common prefix between their places in the
round before (``repeated_columns``). A window repeats if its neighbour's common prefix reaches WIDTH.

Whole documents would need as many rounds as the longest one has bytes, each over all files. So strings
are cut first, at places their content chooses:

1. The anchor of a window is the place of the least hash of a 32-byte string in it, the leftmost of equals. Equal
   windows have equal anchors at equal offsets. Windows that start side by side and share an anchor form one
   stretch of at most 2 * WIDTH - 32 bytes. (One pass, about one row per 85 bytes.)
2. Only anchors found twice or more go on. Stretches that are equal as a whole repeat as a whole: they are counted, not compared.
3. Of an anchor with different stretches, one copy of each stretch is a string of the collection, laid out so that anchors
   share a column; then only windows of one column can be equal, and the construction needs 2 * WIDTH - 32 rounds.
4. An anchor with more than ``hot`` strings is split by the bytes beside it, so no collection is unbounded: windows with
   the anchor in one half of their columns all hold the same bytes around it, so strings meet again only where these are
   equal (``halved``). Parts that are equal as a whole are counted, parts alone are done, and groups still too large are
   halved again; after eight rounds a part is one window. A string gives two rows a round, not one per window.

Stretches, documents and groups are told apart by 64-bit hashes; strings and their parts are compared by their bytes.

The columns of a round are kept in memory, as a collection is bounded (``at_once`` strings), instead of in local files,
which a lost executor would take along. Texts are shuffled only where a Bloom filter of fixed size says that a
document is concerned.

Defined results: null and empty texts have no byte and no run; texts shorter than WIDTH lose nothing; rows that repeat an
id and text are two documents, so both lose all that WIDTH-byte strings cover; an empty table gives no row;
other columns are not read unless ``keep`` names them. Cut text may end within a character: ``kept`` is bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millwright.llm.arrow import pa_schema
from millwright.llm.url_filter import bloom, may_hold
from millwright.session import materialize

WIDTH, GRAM = 200, 32
SIDE = WIDTH - GRAM  # most bytes of a window in front of its anchor, and behind it
ONE = np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 20
FILTER = 1 << 15  # blocks of the filter of concerned documents, 1 MB


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place, by doubling."""
    h, width, by = data.astype(np.uint64) + np.uint64(1), 1, int(ONE)
    while width < GRAM:
        h = h[:-width] * np.uint64(by) + h[width:]
        width, by = 2 * width, by * by & 0xFFFFFFFFFFFFFFFF
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` neighbours from each place, by doubling."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    more = width - have
    return np.minimum(values[:-more], values[more:]) if more else values


def stretches(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first start, last start, anchor, anchor hash) of all stretches; ``ends`` are the documents' ends in ``data``.

    Long data goes piece by piece; a stretch cut there is two stretches."""
    out = []
    for begin in range(0, max(0, len(data) - WIDTH + 1), PIECE):
        part = data[begin : begin + PIECE + WIDTH - 1]
        if len(part) < WIDTH:
            break
        hashes = _gram_hashes(part)
        places = np.arange(len(hashes), dtype=np.uint64)
        anchor = (_least(hashes >> np.uint64(32) << np.uint64(32) | places, SIDE + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.arange(len(anchor))
        doc = np.searchsorted(ends, begin + start, side="right")
        inside = begin + start + WIDTH <= ends[doc]
        new = np.empty(len(anchor), bool)
        new[0] = True
        new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] & ~inside[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new & inside)
        # a stretch ends before the next one begins, or where windows would leave the document
        breaks = np.flatnonzero(new | ~inside)
        after = np.append(breaks, len(anchor))[np.searchsorted(breaks, first, side="right")]
        out.append((begin + first, begin + after - 1, begin + anchor[first], hashes[anchor[first]]))
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    return tuple(np.concatenate(column) for column in zip(*out))


def repeated_columns(strings: np.ndarray) -> np.ndarray:
    """Which windows repeat. ``strings``: one per row, anchors in one column, symbols 0 to 255, else -1.

    Result: (string, column) -> whether the WIDTH symbols from this column are those of another string.
    """
    n, columns = strings.shape
    order, common = np.arange(n), np.zeros(n, np.int32)  # common[i]: of the strings at places i - 1 and i
    repeated = np.zeros((n, max(0, columns - WIDTH + 1)), bool)
    for column in range(columns - 1, -1, -1):
        transform = strings[order, column]  # symbols in front of the sorted suffixes
        by_symbol = np.argsort(transform, kind="stable")
        symbols = transform[by_symbol]
        grown = np.zeros(n, np.int32)
        same = np.flatnonzero((symbols[1:] == symbols[:-1]) & (symbols[1:] >= 0)) + 1
        if len(same):
            # least of common over (place of the one before, own place]
            bounds = np.empty(2 * len(same), np.int64)
            bounds[::2], bounds[1::2] = by_symbol[same - 1] + 1, by_symbol[same] + 1
            padded = np.append(common, 0)
            grown[same] = np.minimum.reduceat(padded, bounds)[::2] + 1
        order, common = order[by_symbol], grown
        if column < repeated.shape[1]:
            long = common >= WIDTH
            repeated[order[long], column] = True
            repeated[order[np.flatnonzero(long) - 1], column] = True
    return repeated


def lay_out(strings: list[bytes], anchors: list[int]) -> np.ndarray:
    """Strings as rows with their anchors (offsets) in column SIDE."""
    out = np.full((len(strings), SIDE + WIDTH), -1, np.int16)
    for row, string, anchor in zip(out, strings, anchors):
        row[SIDE - anchor : SIDE - anchor + len(string)] = np.frombuffer(string, np.uint8)
    return out


def runs(places: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of neighbours in ascending places."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.append(0, cuts + 1)].tolist(), places[np.append(cuts, len(places) - 1)].tolist()))


def cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """Bytes outside the spans, number of bytes inside, number of maximal runs."""
    kept, at, n_runs, last = [], 0, 0, -1
    for start, end in sorted(spans):
        if start > last:
            n_runs += 1
        if start > at:
            kept.append(raw[at:start])
        at = max(at, end)
        last = max(last, end)
    kept.append(raw[at:])
    rest = b"".join(kept)
    return rest, len(raw) - len(rest), n_runs


def _row_key(id_column: str, text: str) -> Column:
    """A document is its id and text; rows that repeat both have one key and one result."""
    return F.xxhash64(F.col(id_column), F.col(text).cast("binary"))


def _all_stretches(docs: DataFrame) -> DataFrame:
    schema = "rid long, lo int, span short, off short, a long, x long"
    kind = pa_schema(docs, schema)

    def run(batches):
        for batch in batches:
            rids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (size == 0 or size + len(texts[stop]) <= PIECE):
                    size += len(texts[stop])
                    stop += 1
                raw = b"".join(texts[at:stop])
                ends = np.cumsum([len(t) for t in texts[at:stop]])
                first, last, anchor, a = stretches(np.frombuffer(raw, np.uint8), ends)
                doc = np.searchsorted(ends, first, side="right")
                begins = np.append(0, ends[:-1])[doc]
                x = np.fromiter((xxhash.xxh3_64_intdigest(raw[i : j + WIDTH]) for i, j in zip(first.tolist(), last.tolist())),
                                np.uint64, len(first))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(rids[at:stop], np.int64)[doc]), pa.array((first - begins).astype(np.int32)),
                    pa.array((last - first).astype(np.int16)), pa.array((anchor - first).astype(np.int16)),
                    pa.array(a.view(np.int64)), pa.array(x.view(np.int64))], schema=kind)
                at = stop

    return docs.select("rid", "raw").where(F.octet_length("raw") >= WIDTH).mapInArrow(run, schema)


def _concerned(docs: DataFrame, per_doc: DataFrame) -> DataFrame:
    """Documents joined with what ``per_doc`` has for them; only rows the filter lets through are shuffled."""
    return docs.where(may_hold(bloom(per_doc, FILTER, "rid"), F.col("rid"), FILTER)).join(per_doc, "rid")


def _strings(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Adds the bytes of each chosen stretch."""
    listed = chosen.groupBy("rid").agg(F.collect_list(F.struct("g", "n", "size", "lo", "span", "off")).alias("list"))
    # the list is cut out of the text by Spark itself
    each = _concerned(docs, materialize(listed, "dedup-wanted")).dropDuplicates(["rid"]).select("rid", "raw", F.explode("list").alias("s"))
    return each.select("rid", "s.*", F.substr("raw", F.col("s.lo") + 1, F.col("s.span") + WIDTH).alias("string"))


def halved(strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round of splitting groups: the strings of the smaller groups, and the spans found on the way.

    ``u`` and ``v`` are the least and the greatest offset of the anchor in the windows of a group; each half of them is a
    group for every sequence of bytes that its windows share around the anchor.
    """
    middle = F.expr("int(floor((u + v) / 2))")
    both = F.array(F.struct(F.col("u").alias("from"), middle.alias("to")), F.struct((middle + 1).alias("from"), F.col("v").alias("to")))
    parts = (strings.select("g", "n", "rid", "lo", "span", "off", "string", F.explode(both).alias("h"))
             .withColumn("least", F.greatest(F.col("off") - F.col("span"), F.col("h.from")))
             .withColumn("most", F.least(F.col("off").cast("int"), F.col("h.to"))).where("least <= most"))
    shared = F.substr("string", F.col("off") - F.col("h.from") + 1, F.col("h.from") + WIDTH - F.col("h.to"))
    parts = materialize(parts.select(
        F.xxhash64("g", "h.from", "h.to", shared).alias("g"), F.col("h.from").alias("u"), F.col("h.to").alias("v"), "n", "rid",
        (F.col("lo") + F.col("off") - F.col("most")).alias("lo"), (F.col("most") - F.col("least")).alias("span"), F.col("most").alias("off"),
        F.substr("string", F.col("off") - F.col("most") + 1, F.col("most") - F.col("least") + WIDTH).alias("string")), "dedup-parts")
    kinds = materialize(parts.groupBy("g", "u", "v", "string").agg(
        F.sum("n").alias("n"), F.min(F.struct("rid", "lo", "span", "off")).alias("one")), "dedup-part-kinds")
    found = (parts.where("n = 1").join(kinds.where("n > 1").select("g", "string"), ["g", "string"], "left_semi")
             .select("rid", F.col("lo").alias("s"), (F.col("lo") + F.col("span") + WIDTH).alias("e")))
    sizes = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return materialize(kinds.join(sizes, "g").select("g", "u", "v", "n", "size", "one.*", "string"), "dedup-halved"), found


def _by_columns(strings: DataFrame, at_once: int) -> DataFrame:
    """Spans of repeated windows by the column-wise construction, for stretches that occur once."""
    schema = "rid long, s int, e int"
    kind = pa_schema(strings, schema)
    strings = strings.select("g", "n", "rid", "lo", "off", "string")

    def solve(rows: list[dict]) -> pa.RecordBatch:
        found = repeated_columns(lay_out([r["string"] for r in rows], [r["off"] for r in rows]))
        out = []
        for row, hit in zip(rows, found):
            if row["n"] == 1:
                shift = row["lo"] + row["off"] - SIDE
                out += [{"rid": row["rid"], "s": i + shift, "e": j + shift + WIDTH} for i, j in runs(np.flatnonzero(hit))]
        return pa.RecordBatch.from_pylist(out, schema=kind)

    def run(batches):
        waiting, last = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if len(waiting) >= at_once and row["g"] != last:
                    yield solve(waiting)
                    waiting = []
                waiting.append(row)
                last = row["g"]
        if waiting:
            yield solve(waiting)

    return strings.repartition("g").sortWithinPartitions("g").mapInArrow(run, schema)


def spans(keyed: DataFrame, hot: int = 4096, at_once: int = 8192) -> DataFrame:
    """(rid, spans) for every document with a repeated string; ``keyed`` has rid and raw."""
    every = materialize(_all_stretches(keyed), "dedup-stretches")
    shared = (every.groupBy("a").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("x0"), F.max("x").alias("x1"))
              .where("c > 1").select("a", (F.col("x0") != F.col("x1")).alias("mixed")))
    found = materialize(every.join(shared, "a"), "dedup-shared")
    as_span = [F.col("lo").alias("s"), (F.col("lo") + F.col("span") + WIDTH).alias("e")]
    kinds = materialize(
        found.where("mixed").groupBy("a", "x").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "lo", "span", "off")).alias("one")),
        "dedup-kinds")
    whole = found.where("not mixed").select("rid", *as_span).unionByName(
        found.where("mixed").join(kinds.where("n > 1").select("a", "x"), ["a", "x"], "left_semi").select("rid", *as_span))
    per_anchor = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("size"))
    chosen = kinds.join(per_anchor, "a").select(F.col("a").alias("g"), "n", "size", "one.*")
    strings = materialize(_strings(keyed, chosen), "dedup-strings").withColumns({"u": F.lit(0), "v": F.lit(SIDE)})
    parts, large = whole, (F.col("size") > hot) & (F.col("u") < F.col("v"))
    bounded = strings.where(~large)
    while not strings.where(large).isEmpty():  # eight rounds at most
        strings, certain = halved(strings.where(large))
        parts, bounded = parts.unionByName(certain), bounded.unionByName(strings.where(~large), allowMissingColumns=True)
    parts = parts.unionByName(_by_columns(bounded, at_once))
    return materialize(parts.groupBy("rid").agg(F.collect_list(F.struct("s", "e")).alias("spans")), "dedup-spans")


def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), hot: int = 4096,
          at_once: int = 8192) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept (bytes), and the columns named by ``keep``."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    carried = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    keyed = docs.select(F.col(id_column).alias("id"), _row_key(id_column, text).alias("rid"), raw.alias("raw"), *carried)
    per_doc = spans(keyed, hot, at_once)
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    names = [f"keep_{i}" for i in range(len(keep))]
    maybe = may_hold(bloom(per_doc, FILTER, "rid"), F.col("rid"), FILTER)
    plain = [F.col("id").cast("long").alias("id"), F.octet_length("raw").cast("long").alias("n_bytes"),
             F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("raw").alias("kept")]
    clean = keyed.where(~maybe).select(*plain, *names)
    concerned = keyed.where(maybe).join(per_doc, "rid", "left").select(F.col("id").cast("long"), "raw", "spans", *names)
    kept_types = ", ".join(f"{n} {t}" for n, t in keyed.dtypes if n in names)
    schema = ", ".join(filter(None, [schema, kept_types]))
    kind = pa_schema(docs, schema)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids, raws, lists = (part.column(i).to_pylist() for i in range(3))
                done = [cut(r, [(p["s"], p["e"]) for p in l or ()]) for r, l in zip(raws, lists)]
                columns = [ids, [len(r) for r in raws], [d[1] for d in done], [d[2] for d in done], [d[0] for d in done]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, kind)] + [part.column(3 + i) for i in range(len(keep))], schema=kind)

    out = clean.unionByName(concerned.mapInArrow(run, schema))
    return out.select(F.col("id").alias(id_column), "n_bytes", "n_removed", "n_spans", "kept",
                      *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)])
