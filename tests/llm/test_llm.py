"""Every operator against a plain version, on texts chosen to be awkward."""

import base64
import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

pytest.importorskip("txrisk.llm")
tokenizers = pytest.importorskip("tokenizers")

from txrisk.llm import bpe, exact, licenses, neardup, packing, parsing, pii, repair, toxicity, warc  # noqa: E402
from txrisk.llm.queries import tokenizer_path  # noqa: E402
from txrisk.session import new_path  # noqa: E402

PATH = tokenizer_path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, key string, kind int"


def made():
    rnd = random.Random(3)
    bits = ["0123", ".", "-", "+", "@", " ", "(", "a", "b", "a.b", "@x.y", ".1", "4111 1111 1111 1111", "1.2.3.4", "🙂", "\n", " MIT License", "cc by"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    base = [rnd.choice(["the", "ing", "an", "Tion", "é"]) + str(rnd.randint(0, 99)) for _ in range(120)]
    for k in range(40):  # copies that differ by a few words
        words = list(base)
        for _ in range(k % 9):
            words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 10**6)}"
        texts.append(" ".join(words))
    long = " ".join(rnd.choice(base) for _ in range(20_000))
    odd = [None, "", " ", "one", "one", "One \t\n", "a" * 9000, "ab" * 7000, "1." * 5000, "a@b" + ".c" * 5000, "my ip 1.2.3.4 " * 900]
    odd += ["iban GB29NWBK60161331926819", "ssn 123-45-6789 and 123-45-6789", "<|endoftext|> İΣ ſ 中文 a ́b it's", "the gnu general public license", long]
    return texts + odd + texts[:20]


TEXTS = made()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, "extra", "k", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def ids():
    tk = tokenizers.Tokenizer.from_file(PATH)
    return [tk.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_shards_give_the_ids_back(spark, docs, empty, ids):
    path = new_path(spark, "shards")
    repair.write(docs, PATH, path, shard_ids=5000)
    got, start = by_id(repair.read(spark, path)), 0
    for i, own in enumerate(ids):
        assert (got[i].start, bytes(got[i].ids)) == (start, np.asarray([*own, 2], "<u4").tobytes())
        start += len(own) + 1
    assert spark.read.parquet(path).where("length(rules) > 0").count() > 0
    path = new_path(spark, "shards")
    repair.write(empty, PATH, path)
    assert repair.read(spark, path).count() == 0


def test_ranges_of_a_store(spark, docs, ids):
    """Ranges within and over shards, asked many times of one shard, and beyond the end."""
    path = new_path(spark, "shards")
    repair.write(docs, PATH, path, shard_ids=3000)
    whole = np.array([x for own in ids for x in [*own, 2]])
    rnd = random.Random(2)
    asked = [(i, rnd.randrange(len(whole)), rnd.choice([1, 50, 7000])) for i in range(60)] + [(7, 3, 5), (100, 0, len(whole)), (101, len(whole), 9), (102, 5, 0)]
    found = repair.read_ranges(spark, path, spark.createDataFrame(asked, "request long, start long, length long")).collect()
    assert sorted((r.request, r.start, r.length) for r in found) == sorted(a for a in asked if a[2])
    for r in found:
        assert (np.frombuffer(r.ids, "<u4") == whole[r.start : r.start + r.length]).all() and len(r.ids) == 4 * min(r.length, len(whole) - r.start)


def test_rounds_go_on_while_they_save():
    passage = np.random.default_rng(1).integers(0, 40_000, 2000)
    grammar = repair.compress(np.tile(passage, 130))
    assert len(grammar.sequence) <= 200 and (repair.expand(grammar) == np.tile(passage, 130)).all()


def test_ranges_are_expanded_alone(ids):
    whole = np.array([x for own in ids for x in own])
    grammar = repair.compress(whole)
    assert len(grammar.left) and (repair.expand(grammar) == whole).all()
    for start, n in ((0, 1), (7, 100), (len(whole) - 5, 5), (1000, 3000)):
        assert (repair.expand_range(grammar, start, n) == whole[start : start + n]).all()
    assert len(repair.expand(repair.compress(np.array([], int)))) == 0


def packed(pieces, ids, end):
    sequences = {}
    for doc_id, own in enumerate(ids):
        at = 0
        for p in sorted((p for p in pieces if p.doc_id == doc_id), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(own) + 1
            assert bytes(p.ids) == np.asarray([*own, end][at : at + p.length], "<u4").tobytes()
            at += p.length
            sequences.setdefault(p.sequence_id, []).append(p)
        assert at == len(own) + 1
    return sequences


def test_packing_keeps_every_id_within_the_limits(docs, empty, ids):
    limits = packing.Limits(tokens=512, segments=6, loss_tokens=400)
    pieces = packing.pack(docs.withColumn("prompt", F.lit(40)), PATH, limits=limits, prompt_chars="prompt").collect()
    for s in packed(pieces, ids, 1).values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == list(np.cumsum([0, *(p.length for p in s[:-1])]))
        assert sum(p.length for p in s) <= 512 and len(s) <= 6 and sum(p.loss_tokens for p in s) <= 400
    plain = packed(packing.pack(docs, PATH).collect(), ids, 1)
    lengths = [sum(p.length for p in s) for s in plain.values()]
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)
    assert packing.pack(empty, PATH).count() == 0


def test_streamed_codes_are_the_librarys(docs, empty, ids):
    tk = tokenizers.Tokenizer.from_file(PATH)
    got = by_id(bpe.encode_decode(docs, PATH))
    for i, own in enumerate(ids):
        told = " ".join(map(str, own)), tk.decode(own, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(own), *(hashlib.sha256(t.encode()).hexdigest() for t in told))
    assert bpe.encode_decode(empty, PATH).count() == 0


def test_the_lookahead_is_enough():
    v = bpe.vocabulary(PATH)
    look, rnd = v.lookahead(), random.Random(8)
    for _ in range(3):
        word = "".join(rnd.choice(["the", "ing", "an", "tion", "a", "er", "ha"]) for _ in range(9000))
        whole = v.merge([*word[:-1], word[-1] + v.suffix])
        t = bpe.Transducer(v, look)
        streamed = [x for at in range(0, len(word), 1000) for x in t.push(word[at : at + 1000])]
        assert streamed and streamed + list(t.finish()) == whole
        assert len(t.held) <= 3 * t.keep + 1000
    d = bpe.TextDecoder(v)
    assert "".join(map(d.push, bpe.coder(PATH, look).ids("Café 中🙂 ok"))) + d.finish() == "café 中 🙂 ok "


def test_fingerprints(docs, empty):
    got = by_id(parsing.fingerprints(docs))
    n = len(TEXTS)
    for i, t in enumerate(TEXTS):
        edited = parsing.edited(t or "", TEXTS[(i + 1) % n] or "")
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t or ""), hashlib.sha256(edited.encode()).hexdigest())
        alone = parsing.fingerprint_text(parsing.sketches([parsing.points(t or "")])[0])
        assert got[i].fingerprint == alone
        assert got[i].near_edited == parsing.likeness(alone, got[i].edited_fingerprint)
        assert got[i].near_next == parsing.likeness(alone, got[(i + 1) % n].fingerprint)
    assert parsing.fingerprints(empty).count() == 0
    text = " ".join(f"w{i * i % 977}" for i in range(2000))
    shifted = parsing.sketches([parsing.points(text), parsing.points("some words in front " + text), parsing.points("other " * 700)])
    assert (shifted[0] == shifted[1]).mean() > 0.9 > 0.1 > (shifted[0] == shifted[2]).mean()


@pytest.mark.parametrize(("words", "percent"), [(2, 80), (5, 80)])
def test_near_duplicates_against_all_pairs(docs, words, percent):
    want, sizes = brute.components(dict(enumerate(TEXTS)), words, percent)
    got = by_id(neardup.near_duplicates(docs, neardup.Params(words=words, percent=percent)))
    assert {i: (r.component_id, r.n_shingles, r.kept) for i, r in got.items()} == {i: (want[i], sizes[i], want[i] == i) for i in want}


def test_near_duplicates_of_odd_rows(spark, empty):
    assert neardup.near_duplicates(empty).count() == 0
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c d e f"), (None, "x"), (7, None)]
    df = spark.createDataFrame([(*r, "en", "s", 0, "", "", 0) for r in rows], SCHEMA)
    kept = neardup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("4", "a b c d e f"), ("7", None), ("None", "a b c d e f"), ("None", "x")]


def test_near_duplicates_of_texts_that_share_an_id(spark):
    """Each text of an id brings its own likenesses, and a row without an id joins those it is like."""
    one, other = ([f"{p}{i}" for i in range(60)] for p in "az")
    near = lambda words, by: " ".join([*words[:-1], by])
    texts = [(4, " ".join(one)), (4, " ".join(other)), (5, near(one, "x")), (6, near(other, "y")), (None, near(other, "v")), (8, "alone")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect())))
    assert got == sorted(map(str, [(4, 4, True), (4, 4, True), (5, 4, False), (6, 4, False), (None, 4, True), (8, 8, True)]))


def test_licenses(docs, empty, spark):
    for i, r in by_id(licenses.scan(docs)).items():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(TEXTS[i])
    assert licenses.scan(empty).count() == 0
    notice = "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files"
    rows = [(1, notice), (1, notice), (2, "permission is granted"), (None, "cc by cc-by")]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_base, r.labels, r.score > 0.6) for r in found) == [
        ("1", 0, "mit", True), ("1", 0, "mit", True), ("2", 0, "", False), ("None", 2, "cc-by", True),
    ]


def test_notices_are_aligned(spark):
    rnd = random.Random(9)
    mit, isc, cc = (dict((n[0], n[1]) for n in licenses.NOTICES)[x] for x in ("mit", "isc", "cc-by"))
    texts = ["free of charge " * 6, "free of charge " * 10, f"{mit} {mit}", f"{isc}. {mit}\n{isc}", " ".join(reversed(mit.split())), None, mit * 50]
    texts += [mit[60:] + " " + mit[:60], "permission is hereby granted " * 40, f"a {cc} b " * 12]
    for _ in range(150):  # words added, left out, exchanged, said again
        words = rnd.choice([mit, isc, cc, f"{cc} x {cc}", f"{mit} {isc}", f"x y {mit} z"]).split()
        for _ in range(rnd.randrange(9)):
            at = rnd.randrange(len(words))
            words[at : at + rnd.randrange(3)] = rnd.choice([[], ["and"], ["to", "any"], ["is", "hereby"], words[at : at + 4] * 2, ["of"] * 4])
            words = words or ["of"]
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = by_id(licenses.scan(df))
    seen = 0
    for i, text in enumerate(texts):
        want = brute.notices(text, licenses.NOTICES, licenses.WIDTH, licenses.LEAST_SHARE)
        assert sorted(tuple(n) for n in found[i].notices) == want, text
        seen += len(want)
        told = {n[0] for n in want} | set(filter(None, brute.licenses(text)[4].split(",")))
        assert found[i].labels == ",".join(sorted(told))
        assert found[i].score == (1.0 if found[i].n_base else max((n[2] for n in want), default=0.0))
    assert (found[0].labels, found[0].score, found[1].labels) == ("", 0.0, "") and len(found[2].notices) == 2 and seen > 100


def test_exact_copies(docs, empty):
    groups = {}
    for i, t in enumerate(TEXTS):
        groups.setdefault(brute.normalised(t), []).append(i)
    for i, r in by_id(exact.copies(docs)).items():
        n = brute.normalised(TEXTS[i])
        assert tuple(r) == (i, groups[n][0], len(groups[n]), i == groups[n][0], hashlib.sha256(n.encode()).hexdigest())
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(g[0] for g in groups.values())
    assert exact.copies(empty).count() == exact.drop_copies(empty).count() == 0


def test_texts_that_share_a_hash_are_not_copies(docs, monkeypatch):
    monkeypatch.setattr(exact, "content_hash", lambda text: F.lit("same").cast("binary"))
    assert exact.copies(docs).where("kept").count() == len({brute.normalised(t) for t in TEXTS})


def test_personal_data(docs, empty):
    found = by_id(pii.find(docs))
    for i, r in found.items():
        assert tuple(r)[1:6] == brute.personal(TEXTS[i]), TEXTS[i]
    at = {t: i for i, t in enumerate(TEXTS)}
    assert found[at["iban GB29NWBK60161331926819"]].spans == "iban:5:27"
    assert found[at["ssn 123-45-6789 and 123-45-6789"]].spans == "ssn:4:15,ssn:20:31"
    masked = pii.mask(docs)
    assert masked.columns == docs.columns
    for i, r in by_id(masked).items():
        text, out, end = TEXTS[i], [], 0
        merged = []
        for s in filter(None, found[i].spans.split(",")):
            kind, a, b = s.split(":")
            if merged and int(a) < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], int(b))
            else:
                merged.append([int(a), int(b), kind])
        for a, b, kind in merged:
            out += [text[end:a], f"[{kind.upper()}]"]
            end = b
        assert r.text == ("".join([*out, text[end:]]) if merged else text)
    assert pii.find(empty).count() == pii.mask(empty).count() == 0


def test_numbers_of_a_list_share_their_context(spark):
    many = "Social Security\n" + "\n".join(f"123-45-{i:04}" for i in range(60))
    texts = ["ssn 123-45-6789 and 987-65-4321", "123-45-6789 (social security number)", many, "ssn 123-45-6789 " + "x " * 30 + "987-65-4321"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = ["ssn:4:15,ssn:20:31", "ssn:0:11", ",".join(f"ssn:{16 + 12 * i}:{27 + 12 * i}" for i in range(60)), "ssn:4:15"]
    assert [r.spans for r in pii.find(df).orderBy("doc_id").collect()] == want
    assert "-45-" not in pii.mask(df).where("doc_id < 3").toPandas().text.str.cat()


def test_account_numbers_whatever_follows(spark):
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "NO9386011117947"
    after = ["", " BIC COBADEFFXXX", " Bic", " 12", ".", " A B C 1 2 3", " DE89", " " + gb]
    texts = [f"é {n}{x}" for n in (de, gb, no) for x in after] + [f"REF RF13 ABCD 1234 5678 IBAN {de}", de + "1", gb + "a", "x" + gb]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [r.spans for r in pii.find(df).orderBy("doc_id").collect()]
    for text, told in zip(texts[: 3 * len(after)], found):
        spans_ = {(2, 2 + len(n)) for n in (de, gb, no) if text[2:].startswith(n)}
        if text.endswith(" " + gb):
            spans_.add((len(text) - len(gb), len(text)))
        assert [x for x in told.split(",") if x.startswith("iban")] == [f"iban:{a}:{b}" for a, b in sorted(spans_)], text
    told = [[x for x in f.split(",") if x.startswith("iban")] for f in found[3 * len(after) :]]
    assert told == [["iban:29:56"], [], [], []]


def test_toxicity_learns_from_document_labels(spark, sf_dir, docs, empty):
    rnd = random.Random(2)
    plain = [f"word{i}" for i in range(300)]

    def text(toxic):
        s = [" ".join(rnd.choice(plain) for _ in range(9)) for _ in range(6)]
        if toxic:
            s[rnd.randrange(6)] += " " + rnd.choice(["awful", "rotten", "vile"])
        return ". ".join(s)

    rows = [(i, text(i % 5 == 0)) for i in range(900)]
    made_docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(900)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(made_docs, labels)
    got = by_id(toxicity.score(made_docs, model))
    texts = dict(rows)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == (i % 5 == 0)
        if r.predicted:
            assert any(w in texts[i][r.worst_start : r.worst_end] for w in ("awful", "rotten", "vile"))
            assert (r.worst_start, r.worst_end) in [(x.start, x.end) for x in r.offending]
    assert toxicity.drop_toxic(made_docs, model).count() == 720
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(empty, model).count() == 0 and toxicity.drop_toxic(empty, model).columns == empty.columns
    assert toxicity.fit(empty, labels).weights == {}


def test_all_sentences_that_offend(spark):
    weights = {toxicity.slot(w): x for w, x in (("vile", 4.5), ("rotten", 3.0), ("kind", -2.0), ("awf-", 1.0), ("awfu-", 3.0))}
    model = toxicity.Model(weights, -4.0)
    texts = ["vile. fine! rotten kind\nvile rotten? awful awfully", "é🙂 vile.. VILE", None, "", "kind. " * 500, "fine. " * 60, "x vile " * 3000, "vile. " * 400]
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)] + [(None, texts[0], "e"), (0, texts[0], "e")], "doc_id long, text string, `a.b` string")
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        score, each = brute.noisy_or(texts[r.doc_id or 0], weights, -4.0, toxicity.slots)
        assert abs(r.score - score) < 1e-12 and r.predicted == (score >= 0.3) and r.n_sentences == len(each)
        assert [tuple(x)[:2] for x in r.offending] == [x[:2] for x in each if x[2] >= 0.3]
        assert all(abs(x.score - y[2]) < 1e-12 for x, y in zip(r.offending, [x for x in each if x[2] >= 0.3]))
    assert len(by_id(toxicity.score(df, model))[7].offending) == 400
    clean = toxicity.drop_toxic(df, model)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in rows if not r.predicted}
    kept = neardup.drop_near_duplicates(df.where("doc_id > 0"))
    assert kept.columns == df.columns and kept.count() == len(texts) - 1


def test_slopes_against_differences():
    rng = np.random.default_rng(4)
    docs, n_sentences, n_words = 12, 40, 9
    doc_of_sentence = np.sort(rng.integers(0, docs, n_sentences))
    words, sentence = rng.integers(0, n_words, 160), rng.integers(0, n_sentences, 160)
    y, share, w = rng.integers(0, 2, docs).astype(float), rng.random(docs), rng.normal(size=n_words + 1)
    y[[d for d in range(docs) if d not in doc_of_sentence]] = 0  # without a sentence a document is clean

    def likelihood(w):
        total = -0.01 / 2 * sum(x * x for x in w[:-1])
        for d in range(docs):
            clean = 1.0
            for s in np.flatnonzero(doc_of_sentence == d):
                clean *= 1 - 1 / (1 + np.exp(-w[-1] - sum(w[k] for k, at in zip(words, sentence) if at == s)))
            total += share[d] * np.log(1 - clean if y[d] else clean)
        return total

    got = toxicity.slopes(w, words, sentence, doc_of_sentence, y, share, 0.01)
    for k in range(n_words + 1):
        step = np.zeros(n_words + 1)
        step[k] = 1e-5
        assert abs((likelihood(w + step) - likelihood(w - step)) / 2e-5 - got[k]) < 1e-6


def test_captures(spark):
    rows = [(1, "http://a", "x"), (2, None, "x"), (3, "http://c\r\n", None), (4, "u", ""), (5, "u", "y" * 200_000), (6, "u", "WARC/1.1\r\n\r\n\r\nz é"), (2, None, "x"), (None, "u", "x")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, sha1 int")
    path = new_path(spark, "warc")
    warc.write(pages, path)
    captures = warc.assemble(warc.read(spark, path)).collect()
    assert len(captures) == len(rows) and all(c.requests and c.metadata for c in captures)
    got = sorted((c.response.type, c.response.payload_bytes, c.response.payload_digest) for c in captures)
    keep = {}
    for i, _, html in rows:
        keep[html or ""] = max(keep.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        kind = "response" if i == keep[html or ""] else "revisit"
        want.append((kind, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()))
    assert got == sorted(want)
    assert {bytes(c.response.payload) for c in captures if c.response.type == "response"} == {(h or "").encode() for _, _, h in rows}
    path = new_path(spark, "warc")
    warc.write(pages, path, least_bytes=2)
    assert {r.type for r in warc.read(spark, path).where("type in ('response', 'revisit')").collect()} == {"response"}
    path = new_path(spark, "warc")
    warc.write(pages.limit(0), path)
    assert warc.assemble(warc.read(spark, path)).count() == 0


def test_records_tied_in_either_direction(spark):
    ties = [
        ("r1", "response", ["q1"]), ("q1", "request", []), ("m1", "metadata", ["q1"]), ("m2", "metadata", ["r1"]), ("m3", "metadata", ["m1"]),
        ("m4", "metadata", ["m3"]), ("m5", "metadata", ["m4"]), ("r2", "response", ["q2"]), ("q2", "request", ["r2"]), ("q3", "request", ["r2"]),
        ("m6", "metadata", []), ("m7", "metadata", ["m8"]), ("m8", "metadata", []), ("m9", "metadata", ["gone"]), ("r3", "revisit", []),
    ]
    records = spark.createDataFrame([(*t, "") for t in ties], "record_id string, type string, concurrent_to array<string>, fields string")
    ids_of = lambda rows: tuple(r.record_id for r in rows)
    got = {(c.response and c.response.record_id, ids_of(c.requests), ids_of(c.metadata)) for c in warc.assemble(records).collect()}
    assert got == {
        ("r1", ("q1",), ("m1", "m2", "m3", "m4", "m5")), ("r2", ("q2", "q3"), ()), ("r3", (), ()),
        (None, (), ("m6",)), (None, (), ("m7", "m8")), (None, (), ("m9",)),
    }


def test_bad_records_do_not_end_reading():
    one = warc._record("resource", "<a>", [("Content-Type", "text/plain")], "hello") + "\r\n\r\n"
    bad = "WARC/1.1\r\nWARC-Record-ID: <b>\r\nContent-Length: x\r\n\r\nWARC/ in a line\r\n\r\n"
    cut = warc._record("resource", "<c>", [], "hello").encode()[:-2]
    found = [(r[0], r[6], r[-2], r[-1]) for r in warc.parse((one + bad + one).encode() + cut)]
    whole = ("<a>", 5, b"hello", None)
    assert found[0] == whole and found[1] == ("<b>", None, None, "length is no number")
    assert found[-2:] == [whole, ("<c>", 3, b"hel", "cut short")]
    assert [r[-1] for r in warc.parse(b"WARC/1.1\r\nWARC-Type: x")] == ["no end of header"]


def test_pipeline_against_its_parts(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rejected = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    left = {}
    for i in sorted(set(texts) - rejected):
        left.setdefault(brute.normalised(texts[i]), i)
    component, _ = brute.components({i: texts[i] for i in left.values()}, 5, 80)
    want = {i for i, c in component.items() if i == c}
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == want
    tk = tokenizers.Tokenizer.from_file(PATH)
    clean = docs.where(F.col("doc_id").isin([i for i in want if not any(brute.personal(texts[i])[:4])]))
    lengths = {r.doc_id: r.doc_tokens for r in pieces.collect()}
    assert all(lengths[r.doc_id] == len(tk.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in clean.collect())


def test_texts_to_pack_are_encoded_together(monkeypatch):
    """Slices hold every row once, in order, and end with the text that fills them."""
    from txrisk.llm import packing

    monkeypatch.setattr(packing, "SLICE_CHARS", 10)
    rows = [(1, "abc", 0), (2, None, 0), (3, "x" * 30, 2), (4, "", 0), (5, "y" * 10, 0), (None, "z", 0)]
    slices = list(packing._slices(iter(rows)))
    assert [[r[0] for r in s] for s in slices] == [[1, 2, 3], [4, 5], [None]]
    assert [r for s in slices for r in s] == rows
    assert list(packing._slices(iter([]))) == []
