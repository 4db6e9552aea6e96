"""Byte-level BPE: encode texts to ids by merge ranks, and decode ids to bytes.

Text is cut by the pattern of the vocabulary, and each piece is folded: of all neighbouring
byte strings that a rank joins, the lowest rank merges first, the leftmost of equals.
The fold runs on byte arrays of the distinct words of an Arrow batch, all of them together,
one merge per piece and round; bounded caches hold the ids of words met before. Decoding
gathers the bytes of each id and concatenates them.

The rank file is broadcast as bytes; its size is fixed by the vocabulary (under 1 MB for
50,256 ranks), not by the data.

Defined results: null and empty texts have no ids and decode to no bytes; repeated rows are
encoded each; long pieces are folded with a heap, in O(n log n); text that is not valid
UTF-8 is encoded with U+FFFD in place of broken bytes; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import re
from functools import lru_cache
from hashlib import sha256

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from millwright.llm.arrow import decoded, map_rows, text_bytes

#: A space with white space (or nothing) after and white space before it: only there does cutting at spaces
#: differ from the pattern. Python's \s holds all white space of the pattern and four control characters more.
UNSAFE = re.compile(r"\s (?:\s|\Z)")
NONE = 1 << 60
SHORT = 48


@lru_cache(maxsize=4)
def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


def fold(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if len(piece) > SHORT:
        return _fold_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(parts[i] + parts[i + 1], NONE) for i in range(len(parts) - 1)]
    while pairs and (low := min(pairs)) != NONE:
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NONE)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NONE)
    return [ranks[p] for p in parts]


def _fold_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same fold with a heap of joinable neighbours; parts are linked by their start bytes."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\1" * n)
    while heap:
        _, i, stop = heapq.heappop(heap)
        # still the same two neighbours: i lives, its part ends inside, and the next one ends at stop
        if not alive[i] or end[i] >= stop or end[end[i]] != stop:
            continue
        alive[end[i]] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (j := before[i]) >= 0 and (r := ranks.get(piece[j:stop])) is not None:
            heapq.heappush(heap, (r, j, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def apart(words: set[str]) -> tuple[list[str], list[str]]:
    """Words that may stand in one text behind any others, and those that may not: empty ones, and ones that open with white space."""
    spaced = [w for w in words if not w or w[0].isspace()]
    return list(words.difference(spaced)), spaced


class Merges:
    """Every pair of neighbours that a rank joins, for folding many pieces at once, one merge per piece and round."""

    def __init__(self, ranks: dict[bytes, int], bits: int = 20):
        self.ranks, self.bits = ranks, bits
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        joined = [(left << 32 | right, rank) for token, rank in ranks.items() for k in range(1, len(token))
                  if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None]
        keys, values = np.array(sorted(joined), np.int64).reshape(-1, 2).T
        # a table by hash; pairs that share a place with a later one are few, and are searched for
        slot = self.slot(keys)
        self.table, self.ranked = np.full(1 << self.bits, -1), np.empty(1 << self.bits, np.int64)
        self.table[slot], self.ranked[slot] = keys, values
        lost = self.table[slot] != keys
        self.keys, self.values = np.append(keys[lost], NONE), np.append(values[lost], NONE)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank that joins each pair of neighbours, or NONE."""
        wanted = left << 32 | right
        slot = self.slot(wanted)
        there = self.table[slot]
        out = np.where(there == wanted, self.ranked[slot], NONE)
        other = np.flatnonzero((there != wanted) & (there >= 0))
        at = np.searchsorted(self.keys, wanted[other])
        out[other] = np.where(self.keys[at] == wanted[other], self.values[at], NONE)
        return out

    def fold(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (4 bytes each) of distinct pieces: short ones together, long ones one by one."""
        out: list[bytes | None] = [None] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if len(piece) <= SHORT and piece not in self.ranks:
                short.append(i)
            else:
                out[i] = np.array(fold(piece, self.ranks), "<u4").tobytes()
        if short:
            for i, ids in zip(short, self._together([pieces[i] for i in short])):
                out[i] = ids
        return out

    def _together(self, pieces: list[bytes]) -> list[bytes]:
        ids = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        own = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        rank = np.full(len(ids), NONE)
        rank[:-1] = np.where(own[:-1] == own[1:], self.of(ids[:-1], ids[1:]), NONE)
        done = []
        while len(own):
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(own)))
            live = low != NONE
            done.append((own[~live], ids[~live]))
            own, ids, rank, low = own[live], ids[live], rank[live], low[live]
            at = np.flatnonzero(rank == low)
            at = at[np.diff(own[at], prepend=-1) != 0]  # the leftmost of equals
            ids[at] = rank[at]
            keep = np.ones(len(own), bool)
            keep[at + 1] = False
            own, ids, rank = own[keep], ids[keep], rank[keep]
            at -= np.arange(len(at))
            rank[at] = NONE
            for left in (at[at + 1 < len(own)], at[at > 0] - 1):
                left = left[own[left] == own[left + 1]]
                rank[left] = self.of(ids[left], ids[left + 1])
        own, ids = (np.concatenate(parts) for parts in zip(*done))
        flat = ids[np.argsort(own, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(own, minlength=len(pieces)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Folds the distinct words of a batch of texts together; bounded caches hold the ids of words and pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int):
        self.merges, self.cut, self.most = Merges(ranks), regex.compile(pattern), most
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def strings(self, strings: list[str]) -> list[bytes]:
        """Ids of each string, cut by the pattern on its own."""
        cut = [self.cut.findall(s) for s in strings]
        self._fold(piece for pieces in cut for piece in pieces)
        look = self.pieces.__getitem__
        return [b"".join(map(look, pieces)) for pieces in cut]

    def behind_space(self, words: list[str]) -> list[bytes]:
        """Ids of words as they stand behind a space: cut as one text of them all, since no piece crosses such a space."""
        cut = self.cut.findall("".join([" " + w for w in words]))
        self._fold(cut)
        found = list(map(self.pieces.__getitem__, cut))
        ids = b"".join(found)
        # where words end, in characters; pieces end there too
        ends, behind = (np.cumsum(np.fromiter(map(len, parts), np.int64, len(cut))) for parts in (cut, found))
        last = np.searchsorted(ends, np.cumsum([len(w) + 1 for w in words]))
        bounds = behind[last].tolist()
        return [ids[a:b] for a, b in zip([0, *bounds], bounds)]

    def _fold(self, pieces) -> None:
        if len(self.pieces) >= self.most:
            self.pieces.clear()
        new = list(set(pieces).difference(self.pieces))
        self.pieces.update(zip(new, self.merges.fold([p.encode() for p in new])))

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts. Cut before single spaces, where no piece of the pattern can cross."""
        cut = [[t] if UNSAFE.search(t) else t.split(" ") for t in texts]
        fronts, behind = [parts[0] for parts in cut], [parts[1:] for parts in cut]
        if len(self.words) >= self.most:
            self.words.clear()
        new, spaced = apart(set().union(*behind).difference(self.words))
        for start in range(0, len(new), 20_000):
            some = new[start : start + 20_000]
            self.words.update(zip(some, self.behind_space(some)))
        self.words.update(zip(spaced, self.strings([" " + w for w in spaced])))
        look = self.words.__getitem__
        return [front + b"".join(map(look, words)) for front, words in zip(self.strings(fronts), behind)]


class Decoder:
    """Bytes of ids: slices of all tokens laid in a row, gathered together."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def bytes_of(self, ids: bytes, at_once: int = 1 << 16) -> bytes:
        """Concatenated bytes; an id without a token raises IndexError."""
        out, every = [], np.frombuffer(ids, "<u4")
        for i in range(0, len(every), at_once):
            some = every[i : i + at_once]
            size = self.size[some]
            ends = np.cumsum(size)
            place = np.arange(ends[-1]) + np.repeat(self.start[some] - ends + size, size)
            out.append(self.flat[place].tobytes())
        return b"".join(out)


@lru_cache(maxsize=4)
def _encoder(raw: bytes, pattern: str, most: int) -> Encoder:
    """Ranks and caches of this worker process; they outlive a task."""
    return Encoder(parse_ranks(raw), pattern, most)


@lru_cache(maxsize=4)
def _decoder(raw: bytes) -> Decoder:
    return Decoder(parse_ranks(raw))


def _ranks(docs: DataFrame, ranks_file: str):
    with open(ranks_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _source(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("id"), text_bytes(text).alias("text"))


def encode(docs: DataFrame, ranks_file: str, pattern: str, id_column: str = "doc_id", text: str = "text",
           cached_words: int = 300_000) -> DataFrame:
    """(id, n_tokens, ids): ids as little-endian unsigned 32-bit integers, one row per input row."""
    raw = _ranks(docs, ranks_file)

    def rows(batch):
        for row, ids in zip(batch, _encoder(raw.value, pattern, cached_words).texts([decoded(r["text"]) for r in batch])):
            yield {"id": row["id"], "n_tokens": len(ids) // 4, "ids": ids}

    return map_rows(_source(docs, id_column, text), rows, "id long, n_tokens long, ids binary").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, ranks_file: str) -> DataFrame:
    """Adds ``decoded``: the bytes of the ids, concatenated. Other columns: the key in front, n_tokens and ids."""
    raw = _ranks(encoded, ranks_file)
    key = encoded.columns[0]

    def rows(batch):
        look = _decoder(raw.value)
        for row in batch:
            yield {**row, "decoded": look.bytes_of(row["ids"])}

    source = encoded.select(F.col(key).alias("id"), "n_tokens", "ids")
    return map_rows(source, rows, "id long, n_tokens long, ids binary, decoded binary").withColumnRenamed("id", key)


def digests(docs: DataFrame, ranks_file: str, pattern: str, id_column: str = "doc_id", text: str = "text",
            cached_words: int = 300_000) -> DataFrame:
    """Encode, decode the ids, and digest both, in one pass: the columns of the registered query."""
    raw = _ranks(docs, ranks_file)

    def rows(batch):
        look = _decoder(raw.value)
        for row, ids in zip(batch, _encoder(raw.value, pattern, cached_words).texts([decoded(r["text"]) for r in batch])):
            yield {"id": row["id"], "n_tokens": len(ids) // 4, "ids_sha256": sha256(ids).hexdigest(),
                   "decoded_sha256": sha256(look.bytes_of(ids)).hexdigest()}

    done = map_rows(_source(docs, id_column, text), rows, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return done.withColumnRenamed("id", id_column)
