"""Plain versions of the operators' results, over lists of rows, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def bpe(docs):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for doc_id, text in docs:
        ids = own.encode_ordinary(text or "")
        yield (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
               hashlib.sha256((text or "").encode()).hexdigest())


def repeated_strings(docs, width=200):
    seen = Counter()
    for _, text in docs:
        raw = (text or "").encode()
        seen.update(raw[i : i + width] for i in range(len(raw) - width + 1))
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 2, np.int32)
        for i in range(len(raw) - width + 1):
            if seen[raw[i : i + width]] > 1:
                gone[i + 1] += 1
                gone[i + 1 + width] -= 1
        covered = np.cumsum(gone)[1 : len(raw) + 1] > 0
        runs = int(np.sum(np.diff(np.append(0, covered.astype(int))) == 1))
        kept = bytes(np.frombuffer(raw, np.uint8)[~covered])
        yield doc_id, len(raw), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()


def token_files(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, (d[1] is not None, (d[1] or "").encode()))):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def shingles(text, width):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))} if found else set()


def near(docs, width=4, percent=80):
    sets = [shingles(text, width) for _, text in docs]
    top = list(range(len(docs)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x] if j < i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                top[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    for i, (doc_id, _) in enumerate(docs):
        component = least.get(root(i)) if sets[i] else doc_id
        yield doc_id, len(sets[i]), component, component == doc_id


def warc(pages):
    largest = {}
    for page_id, html in pages:
        key = html or ""
        largest[key] = max(largest.get(key, page_id), page_id, key=lambda x: (x is not None, x or 0))
    for page_id, html in pages:
        raw, top = (html or "").encode(), largest[html or ""]
        revisit = top is not None and top != page_id
        yield (page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
               "revisit" if revisit else "response", top if revisit else None)


def base_rules(docs):
    for doc_id, text in docs:
        text = text or ""
        found = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
        count, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            if count[w] > 1:
                covered.update(range(i, i + 8))
        n = len(found)
        yield (doc_id, n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
               n < 20 or 100 * len(covered) > 30 * n)


def mean_ratio(docs, trusted, smooth):
    """The score without hashing: ratios of n-grams themselves."""
    grams = [words(t) + list(zip(words(t), words(t)[1:])) for _, t in docs]
    raw, target = Counter(), Counter()
    for (doc_id, _), g in zip(docs, grams):
        raw.update(g)
        if doc_id in trusted:
            target.update(g)
    scale = sum(target.values()) / max(1, sum(raw.values()))
    ratio = {x: math.log((target[x] + smooth) / (raw[x] * scale + smooth)) for x in raw}
    return [sum(ratio[x] for x in g) / len(g) if g else 0.0 for g in grams]


def fill(caps, weights, total):
    """Targets by sharing the excess again and again."""
    out, open_ = [0.0] * len(caps), set(range(len(caps)))
    while open_:
        level = (total - sum(out[i] for i in range(len(caps)) if i not in open_)) / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * level > caps[i]}
        if not over:
            for i in open_:
                out[i] = weights[i] * level
            break
        for i in over:
            out[i] = caps[i]
        open_ -= over
    return out


def seats(votes, n):
    """Sainte-Lague one seat at a time."""
    out = [0] * len(votes)
    for _ in range(n):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * out[i] + 1), -i))
        out[best] += 1
    return out


def mixing_targets(docs, share=1.5, most=2.0):
    sizes = defaultdict(int)
    for _, source, text in docs:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = [(5, 2, 1)[i % 3] for i in range(len(order))]
    return dict(zip(order, fill([most * sizes[s] for s in order], weights, share * sum(sizes.values())))), dict(sizes)


def spot_pairs(docs):
    """(id, n_chars, sha256 of the edited text) in descending order of id."""
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), (d[1] or "").encode()))
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        yield doc_id, len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()
