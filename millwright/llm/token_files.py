"""Token ids in files of length-delimited binary records, with an offset index beside each file.

A record is framed as: length (unsigned 64 bit), masked CRC-32C of these 8 bytes, the data,
masked CRC-32C of the data; all little-endian. The data is a header (document id, whether
there is one, bytes per id) and the ids. The index file has one entry of three 64-bit
integers per record: offset, length with framing, document id, so that a reader can seek to
records in any order.

Writing: one range shuffle by document id puts the texts in order; each task encodes its range
and writes files of about ``file_bytes``. Files are named by task and number, so their names
sort as the documents do. Encoding works on the distinct words of some megabytes of text, each
behind its space, which pieces of the pre-tokenizer never cross; these are cut as a byte-level
pre-tokenizer cuts them, and each distinct piece goes through the tokenizer once while it is kept.

Defined results: null and empty texts give a record of the end id alone; equal document ids
keep both records, in order of text; null ids come first; an empty table gives no file and no
row; a text that holds a special token's string goes through the tokenizer as a whole; other
columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from functools import lru_cache
from itertools import groupby
from unicodedata import category

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millwright.llm import shared_files
from millwright.llm.arrow import decoded, map_rows, text_bytes
from millwright.llm.byte_bpe import UNSAFE, apart
from millwright.session import materialize

HEADER = struct.Struct("<qBB")
LENGTH, CHECK, ENTRY = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<QQq")
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8  # fixed values: CRC-32C reflected, and the mask of record files
BLOCK = 256
FIRST = np.arange(BLOCK) * 256  # of each place's row in the table
LATIN = bytes(range(0xCA))  # bytes of characters below U+0280, all assigned
WHITE = {"", *filter(str.isspace, map(chr, range(0x10000)))}


class BadRecord(ValueError):
    """A frame whose length or checksum is wrong."""


@lru_cache(maxsize=1)
def _tables() -> tuple[list[int], np.ndarray, list[list[int]]]:
    """By one byte; by (place in a block, byte); and moving a state on by one block, by each of its bytes."""
    one = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (POLYNOMIAL if value & 1 else 0)
        one.append(value)
    step = np.array(one, np.uint32)
    places = np.empty((BLOCK, 256), np.uint32)
    places[-1] = step
    for i in range(BLOCK - 2, -1, -1):
        places[i] = step[places[i + 1] & 255] ^ (places[i + 1] >> 8)
    # a state acts like its four bytes laid over the next four data bytes
    return one, places, [places[i].tolist() for i in range(4)]


def crc32c(data: bytes) -> int:
    one, places, (t0, t1, t2, t3) = _tables()
    state = 0xFFFFFFFF
    if len(data) < 64:
        for byte in data:
            state = state >> 8 ^ one[(state ^ byte) & 255]
        return state ^ 0xFFFFFFFF
    front = -len(data) % BLOCK
    padded = np.zeros(front + len(data), np.uint8)
    padded[front:] = np.frombuffer(data, np.uint8)
    padded[front : front + 4] ^= 255  # the starting state, laid over the first four bytes
    blocks = padded.reshape(-1, BLOCK)
    state = 0
    for start in range(0, len(blocks), 512):
        for block in np.bitwise_xor.reduce(places.take(blocks[start : start + 512] + FIRST), axis=1).tolist():
            state = t0[state & 255] ^ t1[state >> 8 & 255] ^ t2[state >> 16 & 255] ^ t3[state >> 24] ^ block
    return state ^ 0xFFFFFFFF


def masked(data: bytes) -> bytes:
    crc = crc32c(data)
    return CHECK.pack(((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF)


def frame(data: bytes) -> bytes:
    length = LENGTH.pack(len(data))
    return b"".join((length, masked(length), data, masked(data)))


def unframe(content: memoryview | bytes, at: int) -> tuple[bytes, int]:
    """Data of the record at ``at``, and where the next one starts."""
    length = bytes(content[at : at + 8])
    if len(length) < 8 or bytes(content[at + 8 : at + 12]) != masked(length):
        raise BadRecord(f"length at {at}")
    size = LENGTH.unpack(length)[0]
    data = bytes(content[at + 12 : at + 12 + size])
    if len(data) < size or bytes(content[at + 12 + size : at + 16 + size]) != masked(data):
        raise BadRecord(f"data at {at}")
    return data, at + 16 + size


def record(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return frame(HEADER.pack(doc_id or 0, doc_id is not None, width) + ids)


def entry(at: int, data: bytes, doc_id: int | None) -> bytes:
    return ENTRY.pack(at, len(data), doc_id or 0)


def parse(data: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, known, width = HEADER.unpack_from(data)
    return doc_id if known else None, np.frombuffer(data, f"<u{width}", offset=HEADER.size)


def indexed_bytes(index: bytes) -> int:
    """Bytes of all records an index names."""
    return sum(n for _, n, _ in ENTRY.iter_unpack(index))


def records(folder: str, name: str, order: list[int] | None = None):
    """Records of one file by its index, in file order or in a given order of entries."""
    system, path = shared_files.opened(folder)
    with system.open_input_file(f"{path}/{name.removesuffix('.rec')}.idx") as f:
        entries = list(ENTRY.iter_unpack(f.read()))
    with system.open_input_file(f"{path}/{name}") as f:
        for k in range(len(entries)) if order is None else order:
            f.seek(entries[k][0])
            yield parse(unframe(f.read(entries[k][1]), 0)[0])


@lru_cache(maxsize=1)
def _pattern() -> tuple[re.Pattern, re.Pattern]:
    """The pattern of a byte-level pre-tokenizer (letters first, its alternatives exclude each other), and characters that go by the library alone."""
    kinds = [category(chr(c)) for c in range(0x1FA00)]

    def ranges(wanted) -> str:
        found = (list(run) for good, run in groupby(range(len(kinds)), lambda c: wanted(c, kinds[c])) if good)
        return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in found)

    letter, number = (ranges(lambda c, kind, first=first: kind[0] == first and c < 0x10000) for first in "LN")
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    # not assigned yet, so the library may know a later Unicode; and beyond the first plane all but pictographs
    unsure = ranges(lambda c, kind: kind in ("Cn", "Cs") or 0x10000 <= c < 0x1F300 or c >= 0x10000 and kind[0] in "LN")
    return (re.compile(f" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"),
            re.compile(f"[{unsure}\\U0001fa00-\\U0010ffff]"))


class Encoder:
    """A tokenizer with a bounded cache of the ids of pieces."""

    def __init__(self, definition: str, end_id: int, most: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_padding(), self.tokenizer.no_truncation()
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 65_536 else 4
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a byte-level vocabulary spells each byte as one character, so a token's length is that of its bytes
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.size = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for token, number in vocabulary.items():
            self.size[number] = len(token)
        self.end = np.array([end_id], f"<u{self.width}").tobytes()
        before = self.tokenizer.pre_tokenizer
        kind = json.loads(before.__getstate__()) if before is not None else {}
        self.known = (self.tokenizer.normalizer is None and kind.get("type") == "ByteLevel"
                      and kind["use_regex"] and not kind["add_prefix_space"])
        # two generations of ``most`` pieces: the older one goes when the younger is full, and what is met again moves on
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.most = most

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, f"<u{self.width}").tobytes() for ids in self.ids(texts)]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def together(self, words: list[str]) -> list[bytes]:
        """Ids of words, each behind a space, from one text of them all; a token belongs to the word its bytes lie in."""
        found = np.array(self.ids(["".join([" " + w for w in words])])[0], np.int64)
        ids = found.astype(f"<u{self.width}").tobytes()
        behind = np.cumsum(self.size[found])
        ends = ((np.searchsorted(behind, np.cumsum([len(w.encode()) + 1 for w in words])) + 1) * self.width).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def by_word(self, text: str) -> bool:
        return not (UNSAFE.search(text) or any(s in text for s in self.special))

    def learn(self, pieces: set[str]) -> None:
        """Have the ids of all pieces in the younger generation."""
        if len(self.pieces) >= self.most:
            self.older, self.pieces = self.pieces, {}
        new = pieces.difference(self.pieces)
        met = [p for p in new if p in self.older]  # an intersection would go through all that is kept
        self.pieces.update(zip(met, map(self.older.__getitem__, met)))
        new.difference_update(met)
        words, alone = apart({p[1:] for p in new if p[0] == " "})
        alone = [" " + w for w in alone] + [p for p in new if p[0] != " "]
        for start in range(0, len(words), 200):
            some = words[start : start + 200]
            self.pieces.update(zip([" " + w for w in some], self.together(some)))
        self.pieces.update(zip(alone, self.whole(alone)))

    def strings(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of strings from those of their pieces: all ids in a row, and where the ids of each string start and how many they are."""
        pattern, unsure = _pattern()
        plain = np.full(len(strings), self.known)
        # first by the bytes that open characters, as most text is of the Latin letters
        if self.known and (joined := "".join(strings)).encode().translate(None, LATIN) and unsure.search(joined):
            plain[:] = [not unsure.search(s) for s in strings]
        # a space before anything but white space opens a piece, whatever stands before it
        joint = plain & np.array([s[:1] == " " and s[1:2] not in WHITE for s in strings], bool)
        order = np.argsort(~joint, kind="stable")
        ordered, n = [strings[i] for i in order.tolist()], int(joint.sum())
        pieces = pattern.findall("".join(ordered[:n]))
        for s, follows in zip(ordered[n:], plain[order[n:]].tolist()):
            pieces += pattern.findall(s) if follows else [s] if s else []
        self.learn(set(pieces))
        found = list(map(self.pieces.__getitem__, pieces))
        behind_piece = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        ids_behind = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // self.width
        last = np.searchsorted(np.append(0, behind_piece), np.cumsum([len(s) for s in ordered], dtype=np.int64))
        stop = np.append(0, ids_behind)[last]
        start, size = np.empty(len(strings), np.int64), np.empty(len(strings), np.int64)
        size[order] = np.diff(stop, prepend=0)
        start[order] = stop - size[order]
        return np.frombuffer(b"".join(found), f"<u{self.width}"), start, size

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, with the end id behind: those of its distinct words, gathered."""
        import pyarrow as pa
        import pyarrow.compute as pc

        cut = [t.partition(" ") if self.by_word(t) else None for t in texts]
        fronts = [c[0] for c in cut if c]
        behind = pc.split_pattern(pa.array([c[2] if c[1] else None for c in cut if c], pa.large_string()), " ")
        words = behind.flatten().dictionary_encode()
        n_words = pc.fill_null(pc.list_value_length(behind), 0).to_numpy().astype(np.int64)
        distinct = [" " + w for w in words.dictionary.to_numpy(zero_copy_only=False)]
        flat, start, size = self.strings(distinct + fronts)
        each = np.insert(words.indices.to_numpy(), np.cumsum(n_words) - n_words, np.arange(len(fronts)) + len(distinct))
        sizes = size[each]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(start[each] - ends + sizes, sizes) + np.arange(sizes.sum())].tobytes()
        stops = (np.append(0, ends)[np.cumsum(n_words + 1)] * self.width).tolist()
        found, left = (ids[a:b] for a, b in zip([0, *stops], stops)), iter(self.whole([t for t, c in zip(texts, cut) if not c]))
        return [next(found if c else left) + self.end for c in cut]


def portions(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Slices of rows in order, each of at most ``most`` bytes or of one row."""
    cuts, held = [0], 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            cuts.append(i)
            held = 0
        held += size
    return list(zip(cuts, [*cuts[1:], len(sizes)])) if sizes else []


@lru_cache(maxsize=2)
def _encoder(definition: str, end_id: int, most: int) -> Encoder:
    return Encoder(definition, end_id, most)


def write(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = 0, id_column: str = "doc_id",
          text: str = "text", file_bytes: int = 8 << 20, cached_words: int = 300_000, text_bytes_at_once: int = 8 << 20) -> DataFrame:
    """Write all documents in ascending order of id; returns the list of files (name, n_docs, n_tokens), stored."""
    shared_files.make_folder(folder)
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    ordered = (docs.select(F.col(id_column).cast("long").alias("id"), text_bytes(text).alias("text"))
               .repartitionByRange("id").sortWithinPartitions("id", "text"))

    def run(batches):
        import pyarrow as pa

        encoder, task = _encoder(definition.value, end_id, cached_words), TaskContext.get().partitionId()
        pieces, index, files = [], [], []
        at = tokens = 0

        def close():
            nonlocal at, tokens
            name = f"{task:06d}-{len(files):06d}"
            shared_files.put(folder, f"{name}.idx", b"".join(index))
            files.append({"name": shared_files.put(folder, f"{name}.rec", pieces), "n_docs": len(index), "n_tokens": tokens})
            pieces.clear(), index.clear()
            at = tokens = 0

        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            for a, b in portions([len(t or b"") for t in texts], text_bytes_at_once):
                for doc_id, found in zip(ids[a:b], encoder.encode([decoded(t) for t in texts[a:b]])):
                    data = record(doc_id, found, encoder.width)
                    index.append(entry(at, data, doc_id))
                    pieces.append(data)
                    at, tokens = at + len(data), tokens + len(found) // encoder.width
                    if at >= file_bytes:
                        close()
        if index:
            close()
        yield pa.RecordBatch.from_pylist(files, pa.schema({"name": pa.string(), "n_docs": pa.int64(), "n_tokens": pa.int64()}))

    return materialize(ordered.mapInArrow(run, "name string, n_docs long, n_tokens long"), "token-files")


def read(spark: SparkSession, folder: str, id_column: str = "doc_id") -> DataFrame:
    """Per record: id, start (tokens of all records before), n_tokens, ids_crc32 of the ids as 32-bit integers.

    Everything is taken from the files: records are read in the order of their index, and the start of a file is a running
    sum over one row per file, in the order of names. A bad frame, a record file without an index or an index without
    one, and bytes the index does not name raise: there is no silent gap.
    """
    listed = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length"))
    stem = F.regexp_extract("file", r"^(.*)\.(rec|idx)$", 1).alias("name")
    record_files = listed.where(F.col("file").endswith(".rec")).select(stem, "length")
    indexes = (spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").load(folder)
               .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").select(stem, "content"))
    paired = record_files.join(indexes, "name", "full").select("name", "length", "content", F.assert_true(
        F.col("length").isNotNull() & F.col("content").isNotNull(), F.concat(F.lit("record file or index missing: "), "name")).alias("_whole"))

    def rows(batch):
        for row in batch:
            before = 0
            if indexed_bytes(row["content"]) != row["length"]:
                raise BadRecord(f"{row['name']}: the index names other bytes than the file has")
            for doc_id, ids in records(folder, f"{row['name']}.rec"):
                yield {"name": row["name"], "id": doc_id, "before": before, "n_tokens": len(ids),
                       "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
                before += len(ids)

    found = map_rows(paired.where("_whole is null"), rows, "name string, id long, before long, n_tokens long, ids_crc32 long", at_once=1)
    found = materialize(found, "token-records")
    behind = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    per_file = found.groupBy("name").agg(F.sum("n_tokens").alias("n_tokens"))
    starts = per_file.select("name", F.coalesce(F.sum("n_tokens").over(behind), F.lit(0)).alias("file_start"))
    return found.join(starts, "name").select(
        F.col("id").alias(id_column), (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
