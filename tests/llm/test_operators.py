"""Operators against plain versions: a small table with every odd case, empty tables, and the given tables."""

import gzip
import os
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millwright.llm import (
    byte_bpe, minhash, mixing, quality_model, quality_rules, queries, shared_files, spot_signatures, suffix_dedup, token_files, url_filter, warc)
from millwright.session import new_table_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, ids binary, n_tokens long, rid long, a long, raw string, "
          "cid long, label string, part int, `key` string, size long, shard long, target double, score double, kept string")
NAMES = [c.split()[0].strip("`") for c in SCHEMA.split(", ")]


def _texts():
    rng = random.Random(5)
    words = ["the", "of", "la", "und", "Éclat", "naïve", "don't", "x1", "***", "日本", "a" * 70] + [
        "".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    base, passage = rng.choices(words, k=120), text(60)
    near = [" ".join(base[:i] + ["changed"] + base[i + 1 :]) for i in (3, 60, 118)]
    return [
        None, "", " ", "\n\t ", "one", "Two words", "a b c d", "A B\tC  D", "  lead   and \n trail  ", "tab\t\ttab\r\nline nbsp\x1cfs",
        "<|endoftext|> as text <|endoftext|>", "z" * 5000, "ab " * 900, "\U0001f600" * 300, " ".join(base), " ".join(base), *near,
        passage + "\n" + text(50), text(40) + " " + passage, passage * 2, text(30_000), text(200) + "\n\n" + text(30), "same line\nsame line\nsame line\nother",
        "i " * 30, text(25), text(19), "word " * 8, "x" * 199, "y" * 200, "y" * 201]


def _rows():
    out = [(i * 3, t) for i, t in enumerate(_texts())]
    return out + [out[14], (None, "no id here, " * 30), (None, None), (15, "another text with an id that is taken")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", s, len(t or "")) for (i, t), s in zip(_rows(), [None, "b", "a", "é", ""] * 20)]
    return spark.createDataFrame([(*r, *([None] * (len(NAMES) - 5))) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, columns, expected):
    key = lambda r: tuple((v is not None, v) if not isinstance(v, str) else (True, v) for v in r)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted(expected, key=key)


def test_byte_bpe(odd, none):
    run = lambda d: byte_bpe.digests(d, queries.RANKS, public_tokenizers.PATTERN)
    same(run(odd), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], brute.bpe(_rows()))
    assert run(none).count() == 0


def test_long_pieces_fold_alike():
    with open(queries.RANKS, "rb") as f:
        ranks = byte_bpe.parse_ranks(f.read())
    rng = random.Random(1)
    for n in (5, 20, 47, 48):
        piece = bytes(rng.choices(b"abcdehilnorst ", k=n))
        assert byte_bpe._fold_long(piece, ranks) == byte_bpe.fold(piece, ranks)


@pytest.mark.parametrize("hot", [256, 2, 0])
def test_suffix_dedup(odd, none, hot):
    """No group is halved, those of over two strings are, and every group is down to single windows."""
    run = lambda d: suffix_dedup.dedup(d, keep=("source",), hot=hot, at_once=7).withColumn("sha", F.sha2("kept", 256))
    same(run(odd), ["doc_id", "n_bytes", "n_removed", "n_spans", "sha"], brute.repeated_strings(_rows()))
    assert run(none).count() == 0


def test_a_hot_anchor_is_halved_by_two_rows_a_string(spark):
    """Copies of one passage between texts of their own: a round has at most two parts per string, and no window is lost."""
    rng = random.Random(9)
    passage = "".join(rng.choices("abcdefgh ", k=330))
    rows = [(i, "".join(rng.choices("ijklmnop ", k=90)) + passage + "".join(rng.choices("qrstuvwx ", k=90))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    run = suffix_dedup.dedup(docs, hot=8, at_once=16).withColumn("sha", F.sha2("kept", 256))
    same(run, ["doc_id", "n_bytes", "n_removed", "n_spans", "sha"], brute.repeated_strings(rows))
    strings = [(1, 0, suffix_dedup.SIDE, 1, 60, i, 0, 168, 168, t[50:418].encode()) for i, t in rows]
    strings = spark.createDataFrame(strings, "g long, u int, v int, n long, size long, rid long, lo int, span int, off int, string binary")
    found = set()
    for _ in range(8):
        before = strings.count()
        strings, certain = suffix_dedup.halved(strings)
        certain = certain.collect()
        assert strings.count() <= 2 * before and len(certain) <= 2 * before
        found |= {(r["rid"], p) for r in certain for p in range(r["s"], r["e"])}
    assert strings.isEmpty()
    windows = [t[50:418][i : i + 200] for _, t in rows for i in range(169)]
    shared = {w for w in windows if windows.count(w) > 1}
    assert found == {(i, p) for i, t in rows for s in range(169) if t[50:418][s : s + 200] in shared for p in range(s, s + 200)}


def test_stretches_of_a_text_in_pieces(monkeypatch):
    raw = np.frombuffer(bytes(random.Random(2).choices(b"abc ", k=3000)), np.uint8)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    first, last, anchor, _ = suffix_dedup.stretches(raw, np.array([1200, 3000]))
    starts = np.concatenate([np.arange(i, j + 1) for i, j in zip(first, last)])
    assert sorted(starts.tolist()) == [*range(1001), *range(1200, 2801)]
    assert np.all((anchor >= last) & (anchor <= first + suffix_dedup.SIDE))


def test_token_files(spark, odd, none):
    folder = new_table_path(spark, "tokens")
    files = token_files.write(odd, folder, queries.TOKENIZER, file_bytes=5000)
    same(token_files.read(spark, folder), ["doc_id", "start", "n_tokens", "ids_crc32"], brute.token_files(_rows()))
    name = files.orderBy(F.desc("n_docs")).first()["name"]
    in_order = list(token_files.records(folder, name))
    shuffled = list(token_files.records(folder, name, list(range(len(in_order)))[::-1]))
    assert [i for i, _ in shuffled] == [i for i, _ in in_order][::-1]
    empty = new_table_path(spark, "tokens")
    assert token_files.write(none, empty, queries.TOKENIZER).count() == 0 and token_files.read(spark, empty).count() == 0


def test_token_files_that_do_not_fit_their_index(spark, none, odd):
    """A record file or an index that is missing, and bytes behind the last record of the index, raise."""
    for change in ("rec", "idx", "more"):
        folder = new_table_path(spark, "tokens")
        token_files.write(odd, folder, queries.TOKENIZER, file_bytes=5000)
        path = folder.removeprefix("file:")
        name = sorted(f for f in os.listdir(path) if f.endswith("idx" if change == "idx" else "rec"))[1]
        if change == "more":
            with open(f"{path}/{name}", "ab") as f:
                f.write(b"rest")
        else:
            os.remove(f"{path}/{name}")
        with pytest.raises(Exception, match="missing|other bytes"):
            token_files.read(spark, folder).count()


def test_words_are_encoded_together_as_apart():
    with open(queries.TOKENIZER, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read(), 0, 100)
    words = ["plain", "don't", "x1,2", "Éclat", "日本語", "\U0001f600\U0001f600!", "tab\tinside", "end\n\n", "a" * 300, "..."] * 2
    assert encoder.together(words) == encoder.whole([" " + w for w in words])
    texts = ["One, two, One. two! Éclat? naïve; don't, x1, 日本, ab", "two two, ,, . a.b, two..", "mo²re, ªb, ab:"]
    for _ in range(2):
        assert encoder.encode(texts) == [ids + encoder.end for ids in encoder.whole(texts)]


def test_each_distinct_piece_goes_through_the_tokenizer_once(monkeypatch):
    """Words that differ, made of few pieces: the library gets each piece once, and the ids are those of whole texts."""
    with open(queries.TOKENIZER, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read(), 0, 1000)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    texts = [" ".join(f"{a},{b}." for b in syllables) for a in syllables]
    expected = [ids + encoder.end for ids in encoder.whole(texts)]
    given, ids = [], encoder.ids
    monkeypatch.setattr(encoder, "ids", lambda some: given.extend(some) or ids(some))
    assert encoder.encode(texts) == expected and encoder.encode(texts[::-1]) == expected[::-1]
    assert sum(map(len, given)) < 1000 < sum(map(len, texts))


def test_texts_are_cut_as_the_pre_tokenizer_cuts_them():
    """Every character that the pattern is trusted with, and all others by way of the tokenizer."""
    with open(queries.TOKENIZER, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read(), 0, 500)
    pattern, unsure = token_files._pattern()
    sure = [c for c in map(chr, range(0x110000)) if not unsure.match(c) and not "\ud800" <= c <= "\udfff"]
    assert len(sure) > 60_000 and "\U0001f600" in sure
    for start in range(0, len(sure), 4096):
        text = "".join(f"x{c}1{c}!{c} {c}'{c}\n" for c in sure[start : start + 4096])
        assert pattern.findall(text) == [text[a:b] for _, (a, b) in encoder.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    draw = random.Random(8)
    some = [" ", " ", "\n", "\xa0", "\x85", "\u3000", "\x1c", "a", "é", "日", "1", "²", ".", "'re", "'", "\U0001f600", "\U00020000", "\u1c89", "zq", "<|endoftext|>"]
    texts = ["".join(draw.choices(some, [9] * 19 + [1], k=draw.randrange(30))) for _ in range(3000)]
    assert encoder.encode(texts) == [ids + encoder.end for ids in encoder.whole(texts)]
    assert [t for start in range(0, 3000, 70) for t in encoder.encode(texts[start : start + 70])] == encoder.encode(texts)
    assert len(encoder.older) > 0 and encoder.encode([]) == [] and encoder.encode(["", " "]) == [ids + encoder.end for ids in encoder.whole(["", " "])]
    assert token_files.portions([3, 3, 9, 0, 1], 6) == [(0, 2), (2, 3), (3, 5)] and token_files.portions([], 6) == []


def test_very_long_headers_are_read(spark):
    """A header block of a megabyte is a record like any other; a damaged archive makes the round trip fail."""
    pages = spark.createDataFrame([(1, "http://a/", "x"), (2, "http://a/?" + "q" * 1_000_000, "y"), (3, "http://b/?" + "r" * 70_000, "x")],
                                  "page_id long, url string, html string")
    folder = new_table_path(spark, "warc")
    warc.write(pages, folder)
    read = warc.read(spark, folder)
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.page_records(warc.without_gaps(read)).collect()) == [
        (1, "revisit", 3), (2, "response", None), (3, "response", None)]
    assert max(len(r["target_uri"]) for r in read.collect()) > 1_000_000
    path = folder.removeprefix("file:")
    name = next(f for f in os.listdir(path) if f.endswith(".gz"))
    with open(f"{path}/{name}", "r+b") as f:
        f.seek(30)
        f.write(b"\0\0\0\0")
    with pytest.raises(Exception, match="gap in"):
        warc.without_gaps(warc.read(spark, folder)).count()


def test_record_frames():
    assert token_files.crc32c(b"123456789") == 0xE3069283  # the published check value
    data = bytes(random.Random(3).randbytes(3000))
    slow = 0xFFFFFFFF
    for byte in data:
        slow = slow >> 8 ^ token_files._tables()[0][(slow ^ byte) & 255]
    assert token_files.crc32c(data) == slow ^ 0xFFFFFFFF
    framed = bytearray(token_files.frame(data))
    assert token_files.unframe(bytes(framed), 0) == (data, len(framed))
    framed[100] ^= 1
    with pytest.raises(token_files.BadRecord):
        token_files.unframe(bytes(framed), 0)


def test_minhash(odd, none):
    same(minhash.link(odd), ["doc_id", "n_shingles", "component_id", "kept"], brute.near(_rows()))
    assert minhash.link(none).count() == 0


def test_minhash_chain_beside_a_hub(spark):
    """A link between two documents that are both unlike the hub of their buckets."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    docs = [(100 + i, " ".join(base[:k] + [f"e{rng.random()}"] + base[k + 1 :])) for i, k in enumerate(rng.sample(range(200), 12))]
    far = base[:60] + [f"f{i}" for i in range(20)] + base[80:]
    docs += [(1, " ".join(far)), (2, " ".join(far[:-1] + ["end"]))]
    same(minhash.link(spark.createDataFrame(docs, "doc_id long, text string")), ["doc_id", "n_shingles", "component_id", "kept"], brute.near(docs))


PAGES = [(1, "http://a.org/x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b.com/\r\nX", "<p>one</p>"), (4, "x", ""), (5, "y", None),
         (None, "z", "<p>two</p>"), (None, "z", "<p>two</p>"), (7, "w", "\r\n\r\nWARC/1.1\r\n" * 3), (8, "v", "é" * 100_000), (9, "u", "<p>two</p>")]


def test_warc(spark):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, payload string, bytes int")
    folder = new_table_path(spark, "warc")
    warc.write(pages, folder, file_bytes=300)
    read = warc.read(spark, folder)
    assert read.where("kind = 'gap'").count() == 0
    same(warc.page_records(read), ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], brute.warc([(i, h) for i, _, h in PAGES]))
    empty = new_table_path(spark, "warc")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def test_salvage():
    records = [warc.record(i, f"http://a/{i}", b"payload %d " % i * 50, None, "2000-01-01T00:00:00Z") for i in range(6)]
    ids = lambda found: [r[3]["warc-record-id"] for r in found if r[0] == "record"]
    gaps = lambda found: [r[1:3] for r in found if r[0] == "gap"]
    whole = [f"<urn:page:{i}>" for i in range(6)]
    members = [warc.member(r) for r in records]
    starts = np.cumsum([0] + [len(m) for m in members]).tolist()
    for damage in (2, 0, 5):  # a member in the middle, the first and the last
        bad = bytearray(b"".join(members))
        bad[starts[damage] + 40] ^= 255
        found = list(warc.salvage(bytes(bad)))
        assert ids(found) == whole[:damage] + whole[damage + 1 :]
        assert gaps(found) == [(starts[damage], len(members[damage]))]
    assert ids(warc.salvage(b"".join(members)[:-7])) == whole[:-1]
    plain = records[0] + b"junk\r\n" + records[1] + records[2][:-30] + records[3]
    found = list(warc.salvage(plain))
    assert ids(found) == [whole[0], whole[1], whole[3]]
    assert gaps(found) == [(len(records[0]), 6), (len(records[0] + records[1]) + 6, len(records[2]) - 30)]
    inside = gzip.compress(records[0] + records[1].replace(b"payload", b"PAYLOAD", 1) + records[4])
    assert ids(warc.salvage(inside)) == [whole[0], whole[4]]
    assert list(warc.salvage(b"")) == []


def test_quality_rules(spark, odd, none):
    trusted = spark.createDataFrame([(42,), (54,), (54,), (None,)], "doc_id long")
    out = quality_rules.judge(odd, trusted, buckets=1 << 20, keep=("source", "score"))
    same(out.drop("score"), ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"], brute.base_rules(_rows()))
    judged = quality_rules.judge(odd, trusted, buckets=1 << 20)
    expected = sorted(round(x, 2) for x in brute.mean_ratio(_rows(), {42, 54}, 5.0))
    assert np.allclose(sorted(r["score"] for r in judged.collect()), expected, atol=0.02)
    assert quality_rules.judge(none, trusted).count() == 0
    assert not any(r["score"] for r in quality_rules.judge(odd, trusted.limit(0)).collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_spot_signatures(odd, none):
    out = spot_signatures.edited_pairs(odd, parts=5)
    same(out, ["doc_id", "n_chars", "edited_sha256"], brute.spot_pairs(_rows()))
    rows = out.collect()
    texts = {}
    for doc_id, text in _rows():
        texts.setdefault(doc_id, set()).add(spot_signatures.as_text(spot_signatures.signatures(text or "")))
    assert all(r["fingerprint"] in texts[r["doc_id"]] and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert spot_signatures.edited_pairs(none).count() == 0
    one = spot_signatures.edited_pairs(odd.where("doc_id = 12")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_spot_pairs(spark, odd):
    prints = spot_signatures.fingerprints(odd.where("doc_id is not null").dropDuplicates(["doc_id"]))
    sets = {r["doc_id"]: np.array(r["signatures"]) for r in prints.where("n > 0").collect()}
    first = {}
    for i in sorted(sets):
        first.setdefault(tuple(sets[i]), i)
    ids = sorted(first.values())
    expected = {(a, b) for a in ids for b in ids if a < b and spot_signatures.likeness(sets[a], sets[b]) >= 0.44}
    assert {(r["a"], r["b"]) for r in spot_signatures.near_pairs(prints).collect()} == expected


def test_mixing(odd, none):
    docs = [(r["doc_id"], r["source"], r["text"]) for r in odd.select("doc_id", "source", "text").collect()]
    wanted, sizes = brute.mixing_targets(docs)
    rows = mixing.taken(mixing.mix(odd)).collect()
    assert len(rows) == len(docs)
    total = dict.fromkeys(wanted, 0)
    for r in rows:
        assert r["target"] == pytest.approx(wanted[r["source"]]) and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
        total[r["source"]] += r["taken"]
    assert all(abs(total[s] - wanted[s]) <= 64 for s in wanted)
    again = mixing.taken(mixing.mix(odd.repartition(2))).collect()
    pick = lambda x: sorted(((r["doc_id"] or -1, r["size"], r["taken"]) for r in x))
    assert pick(rows) == pick(again)
    assert mixing.mix(none).count() == 0


def test_mixed_texts_hold_the_words_taken(odd):
    rows = odd.select("doc_id", "source", "text", F.struct("doc_id", "text", "lang", "source", "n_chars").alias("row"))
    mixed = mixing.mix(rows, row="row")
    texts = mixing.mixed_texts(mixed, "row")
    words = texts.select(mixing.n_words(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    assert words == mixing.taken(mixed).agg(F.sum("taken")).first()[0]


def test_seats(spark):
    rng = random.Random(4)
    for n_rows, seats in ((1, 7), (5, 3), (8, 1000), (30, 17)):
        votes = [rng.randint(0, 1000) for _ in range(n_rows - 1)] + [5]
        df = spark.createDataFrame([(0, i, v, seats) for i, v in enumerate(votes)], "g int, k int, votes long, seats long")
        out = mixing.apportion(df, ["g"], ["k"], "seats", "won").orderBy("k").collect()
        assert [r["won"] for r in out] == brute.seats(votes, seats)


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.org", "http://a.org/", "HTTP://X.Example.ORG/es/1?q=://b", "http://example.org/en/12#x", "https://b.com/fr/",
            "https://b.com/de/x?y", "http://www.bad.net/p.html?utm_source=a&ref=b", "http://bad.net/p", "http://bad.net/other", "http://notexample.org.net/es/",
            "http://bad.net/p", "http://xcom/fr/", "http://e.net/a\nb"]
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, canonical string")
    listed = spark.createDataFrame([("https://bad.net/p/",), (None,), ("junk",)], "url string")
    for blocks in (16_384, 1):  # a full filter lets everything pass, and the join decides
        rows = {r["page_id"]: r for r in url_filter.judge(pages, listed, blocks=blocks).collect()}
        assert [rows[i]["rule"] for i in range(16)] == [
            None, None, None, None, "org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/", None, None, None, None, None, None, None]
        assert [i for i in range(16) if rows[i]["verdict"] == "block"] == [5, 6, 8, 9, 10, 13]
        assert rows[5]["host"] == "x.example.org" and rows[5]["path"] == "/es/1" and rows[2]["host"] == "" and rows[15]["path"] == "/a\nb"
    assert url_filter.judge(pages.limit(0), listed).count() == 0
    assert url_filter.judge(pages, listed.limit(0)).where("verdict = 'block'").count() == 3


def test_filter_stands_in_a_plan_once(spark):
    """Each place it stands in takes memory of the driver, for the value and in the tasks of its stage."""
    keys = spark.range(4000).select((F.col("id") * 7919 - 10**6).alias("k")).unionByName(spark.sql("select cast(null as bigint) as k"))
    listed = keys.where("k % 2 = 0")
    for blocks, most in ((1 << 12, 20), (1, 2000)):
        hits = keys.where(url_filter.may_hold(url_filter.bloom(listed, blocks, "k"), F.col("k"), blocks))
        assert hits._jdf.queryExecution().optimizedPlan().toString().count("scalar-subquery") == 1
        found = {r["k"] for r in hits.collect()}
        assert None not in found and {r["k"] for r in listed.collect()} <= found and len(found) <= 2000 + most


def test_table_bytes(spark):
    """The table comes in rows of many longs; places no row names are 0."""
    held = {0: 1, 3: -1, 255: 1 << 40, 256: -(1 << 63), 599: 7}
    raw = url_filter.table_bytes(spark.createDataFrame(list(held.items()), "at int, value long"), 600)
    assert np.frombuffer(raw, ">i8").tolist() == [held.get(i, 0) for i in range(600)]
    assert not any(url_filter.table_bytes(spark.createDataFrame([], "at int, value long"), 5))


def test_quality_model(spark, odd, none):
    rng = random.Random(6)
    good = [" ".join(rng.choices(["river", "stone", "of", "the", "light"], k=40)) for _ in range(60)]
    bad = [" ".join(rng.choices(["BUY", "now!!", "$$$", "win", "the"], k=40)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(5, None), (None, 1)], "doc_id long, quality int")
    model = quality_model.fit(docs, labels.where(~quality_model.held_out(F.col("doc_id"))))
    scores = {r["doc_id"]: r["score"] for r in quality_model.score(docs, model).collect()}
    assert np.mean([(scores[i] >= 0.5) == (i < 60) for i in range(120)]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in quality_model.score(odd, model).collect())
    assert quality_model.score(none, model).count() == 0
    untrained = quality_model.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality_model.score(docs.limit(3), untrained).collect()} == {0.5}


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    spark.createDataFrame([(42, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == corpus_pipeline.COLUMNS
    assert docs.count() > 0 and corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")
class TestGivenTables:
    docs = property(lambda self: [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()])

    def test_bpe(self, spark):
        same(queries.op2_byte_bpe(spark, SF), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], brute.bpe(self.docs))

    def test_substrings(self, spark):
        same(queries.op3_suffix_dedup(spark, SF), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.repeated_strings(self.docs))

    def test_token_files(self, spark):
        same(queries.op4_token_files(spark, SF), ["doc_id", "start", "n_tokens", "ids_crc32"], brute.token_files(self.docs))

    def test_near(self, spark):
        same(queries.op5_minhash(spark, SF), ["doc_id", "n_shingles", "component_id", "kept"], brute.near(self.docs))

    def test_pages(self, spark):
        pages = [(r["page_id"], r["html"]) for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()]
        same(queries.op6_warc(spark, SF), ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], brute.warc(pages))

    def test_held_out_accuracy(self, spark):
        quality = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
        held = [r for r in queries.op1_quality_model(spark, SF).collect() if r["held_out"] and r["doc_id"] in quality]
        assert np.mean([r["predicted"] == quality[r["doc_id"]] for r in held]) > 0.9


def test_words_beside_white_space_keep_their_ids():
    """Words are encoded beside words they do not stand beside in the text; line breaks at their ends must not join."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(queries.RANKS, "rb") as f:
        ranks = byte_bpe.parse_ranks(f.read())
    with open(queries.TOKENIZER, encoding="utf-8") as f:
        definition = f.read()
    draw = random.Random(5)
    texts = ["".join(draw.choice([" ", "\n", "\t", "\r", "a", "the", "é", "1", ".", "'s", "zq"]) for _ in range(draw.randrange(25))) for _ in range(3000)]
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, 1000).texts(texts) == [np.array(plain.encode_ordinary(t), "<u4").tobytes() for t in texts]
    whole = Tokenizer.from_str(definition)
    found = token_files.Encoder(definition, 0, 1000).encode(texts)
    assert found == [np.array(whole.encode(t, add_special_tokens=False).ids + [0], "<u2").tobytes() for t in texts]
