"""Fingerprints, language, toxicity and byte-level BPE against plain versions, with the edge cases of each."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from sightline.llm import blocks, bpe, fingerprints, language, toxicity
from sightline.llm.queries import RANKS

SF = "/root/testdata/sf0.01"
ODD = [None, "", " ", "\n\n", "ab", "ab", "é" * 30, "😀 a\x00b" * 9, "word " * 400, "1234 5678"]


def frame_of(spark, texts):
    return spark.createDataFrame([(i, t, f"x{i}") for i, t in enumerate(texts)], "doc_id long, text string, score string").repartition(3)


def prose(seed, n=200):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


# fingerprints


def plain_syncmers(text):
    """Places of closed syncmers by definition, with the hashes of the operator."""
    units = blocks.code_points(text).astype(np.uint64)
    smer = []
    for i in range(len(units) - fingerprints.INNER + 1):
        h = units[i : i + 1].copy()
        for j in range(1, fingerprints.INNER):
            h = h * np.uint64(0x100000001B3) + units[i + j]
        smer.append(int(blocks.mix(h)[0]))
    found = []
    for i in range(len(units) - fingerprints.KMER + 1):
        inner = smer[i : i + fingerprints.WINDOW]
        if min(inner) in (inner[0], inner[-1]):
            found.append(i)
    return found


def test_anchors_are_closed_syncmers():
    texts = [prose(1, 40), "short", prose(2, 30), ""]
    text, place, _ = fingerprints._anchors(texts)
    for i, t in enumerate(texts):
        assert sorted(place[text == i]) == plain_syncmers(t)


def test_fingerprint_of_long_text_does_not_depend_on_blocks(monkeypatch):
    text = prose(3, 3000)
    whole = fingerprints.fingerprints([text, "x", text])
    monkeypatch.setattr(fingerprints, "BLOCK", 1000)
    assert fingerprints.fingerprints([text]) == whole[:1] == whole[2:]


def test_likeness():
    a, b = prose(4), prose(5)
    half = a[: len(a) // 2] + b[: len(a) // 2]
    f, g, h = fingerprints.fingerprints([a, b, half])
    assert fingerprints.likeness(f, f) == 1 and fingerprints.likeness("", "") == 1 and fingerprints.likeness(f, "") == 0
    assert fingerprints.likeness(f, g) < 0.1 < 0.25 < fingerprints.likeness(f, h) < 0.75


def test_fingerprint_holds_every_anchor_with_its_place():
    text = prose(6, 3000)
    middle = len(text) // 2
    changed = text[:middle] + prose(7, 20) + text[middle:]
    f, g = fingerprints.fingerprints([text, changed])
    assert fingerprints.anchors(f)[0].tolist() == plain_syncmers(text)
    assert fingerprints.anchors(g)[0].tolist() == plain_syncmers(changed)
    assert 0.95 < fingerprints.likeness(f, g) < 1


def test_matching_equals_the_plain_longest_common_subsequence(monkeypatch):
    rng = np.random.default_rng(2)
    for kinds in (2, 3, 40, 400):
        for masks in (1 << 26, 4):
            monkeypatch.setattr(fingerprints, "_MASK_BYTES", masks)
            a, b = rng.integers(0, kinds, 150), rng.integers(0, kinds, 120)
            b[20:60] = a[30:70]
            row = [0] * (len(b) + 1)
            for x in a:
                before = list(row)
                for j, y in enumerate(b):
                    row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
            assert fingerprints._in_order(a, b) == fingerprints._in_order(b, a) == row[-1]


@pytest.mark.parametrize("ids", [range(10), [0, 0, 5, 5, 5, None, None, 7, -3, 9], [4] * 10])
def test_compared_pairs_each_document_with_the_next(spark, ids):
    rows = list(zip(ids, ODD, strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = fingerprints.compared(docs).collect()
    assert len(got) == len(rows)
    if len(set(ids)) == len(rows):
        texts = {i: t or "" for i, t in rows}
        order = sorted(texts, reverse=True)
        for r in got:
            t, after = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
            edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            f, g, h = fingerprints.fingerprints([t, edited, after])
            assert (r.fingerprint, r.edited_fingerprint) == (f, g)
            assert (r.near_edited, r.near_next) == (fingerprints.likeness(f, g), fingerprints.likeness(f, h))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_compared_on_empty_and_single(spark):
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    assert fingerprints.compared(docs.limit(0)).count() == 0
    assert fingerprints.compared(docs).first().edited_sha256 == hashlib.sha256(b"aa").hexdigest()


# language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language.fit(docs.where(~held))
    rows = language.identify(docs.where(held).select("lang", "text"), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.lang_score <= 1 for r in rows)


def test_language_edge_cases(spark):
    train = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 3 + [(None, "en"), ("abc", None)])], "doc_id long, text string, lang string")
    model = language.fit(train)
    assert model.languages == ["de", "en"]
    texts = [*ODD, "The dog", "die katzen", "漢字", "9.5 %"]
    rows = {r.doc_id: r for r in language.identify(frame_of(spark, texts), model).collect()}
    assert [rows[i].lang_pred for i in range(4)] == ["und"] * 4 and rows[13].lang_pred == "und" and rows[13].lang_score == 0
    assert rows[10].lang_pred == "en" and rows[11].lang_pred == "de" and rows[12].lang_pred in ("de", "en")
    assert rows[4].score == "x4"  # an extra column with a result's name of the query stays
    none = language.fit(train.limit(0))
    assert {r.lang_pred for r in language.identify(frame_of(spark, texts), none).collect()} == {"und"}


def test_small_languages_keep_their_words(spark):
    rng = random.Random(11)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    rows = [(" ".join(word("abcdefghijklm") for _ in range(60)), "big") for _ in range(900)]
    small = [word("abcdefghijklm") for _ in range(40)]
    rows += [(" ".join(rng.sample(small, 20)), "small") for _ in range(4)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(model.tables[0][0]) == len({w for t, _ in rows for w in t.split()})  # tens of thousands of words
    assert language.predict(model, [" ".join(small[:20])])[0] == ["small"]
    sampled = language.fit(docs, rows=10)  # a language without a row by an even share
    assert sampled.languages == ["big", "small"] and language.predict(sampled, [" ".join(small[:20])])[0] == ["small"]
    seen = rows[0][0]
    assert language.predict(model, [seen])[0] == ["big"]  # words seen once in a large sample, never in a small one


def test_word_first_then_shorter_grams():
    model = language.LanguageModel(["a", "b"], {n: (np.zeros(0, np.uint64), np.zeros((0, 2), np.float32)) for n in (0, *language.ORDERS)})
    units, starts, ends, _ = language.words_of(["cat"])
    h3, _ = language.grams(units, starts, ends, 3)
    model.tables[3] = np.sort(h3[:1]), np.array([[-1, -2]], np.float32)
    h1, _ = language.grams(units, starts, ends, 1)
    model.tables[1] = np.sort(h1), np.full((len(h1), 2), -9, np.float32)
    hashes = blocks.span_hashes(units, starts, ends)
    assert language.word_scores(model, hashes, units, starts, ends).tolist() == [[-1, -2]]  # the longest known order decides
    model.tables[0] = hashes, np.array([[-3, -4]], np.float32)
    assert language.word_scores(model, hashes, units, starts, ends).tolist() == [[-3, -4]]


# toxicity


def labelled(spark, n=400):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        parts = [prose(1000 + 7 * i + j, 8) + "." for j in range(rng.randint(1, 6))]
        if i % 4 == 0:
            parts[rng.randrange(len(parts))] = f"you {rng.choice(['scumbag', 'scummy', 'moron'])} there."
        rows.append((i, " ".join(parts), int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)


def test_toxicity_learns_sentences_from_document_labels(spark):
    docs = labelled(spark)
    train, rest = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    model = toxicity.fit(docs, train.select("doc_id", "toxic"))
    rows = toxicity.score(rest, model).collect()
    assert np.mean([(r.toxicity >= toxicity.THRESHOLD) == bool(r.toxic) for r in rows]) >= 0.95
    for r in rows:
        if r.toxic and r.offending:
            worst = max(r.offending, key=lambda s: s.score)
            assert any(w in r.text[worst.start : worst.end] for w in ("scum", "moron"))


def test_toxicity_edge_cases(spark):
    docs = frame_of(spark, ODD)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    for own in (labels, labels.where("toxic = 0"), labels.limit(0)):
        rows = toxicity.score(docs, toxicity.fit(docs, own)).collect()
        assert len(rows) == len(ODD) and all(0 <= r.toxicity <= 1 for r in rows)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_toxicity_score_is_the_noisy_or(spark):
    units = blocks.code_points("bad")
    word = blocks.span_hashes(units, np.array([0]), np.array([3]))
    model = toxicity.ToxicityModel(word, np.array([3.0]), -2.0)
    score, spans = toxicity.judge(model, ["bad. fine here! Bad bad", None])
    p = lambda z: 1 / (1 + np.exp(-z))
    assert score[0] == pytest.approx(1 - (1 - p(1)) * (1 - p(-2)) * (1 - p(4))) and score[1] == pytest.approx(p(-2))
    assert [(s["start"], s["end"]) for s in spans[0]] == [(0, 3), (16, 23)]


def test_toxicity_fit_is_a_maximum(spark, monkeypatch):
    """The fitted weights against the likelihood by loops: no single weight can be moved to a better place."""
    monkeypatch.setattr(toxicity, "STEPS", 4_000)
    texts = ["bad day. fine day", "bad bad word here", "good day. kind word", "kind day", "fine word", "bad kind day", "so so", ""]
    y = [1, 1, 0, 0, 0, 1, 0, 0]
    w = [1.0, 1.0, 2.0, 2.0, 2.0, 1.0, 2.0, 2.0]
    seen = []
    for text in texts:
        sentences = [s.split() for s in text.replace(".", "\n").split("\n")]
        seen.append([[word for word in s] + [word[:4] + "~" for word in s if len(word) > 4] for s in sentences])
    names = sorted({f for doc in seen for s in doc for f in s})
    at = {f: i for i, f in enumerate(names)}
    spoken = [[s for s in doc if s] for doc in seen]
    word = np.array([at[f] for doc in spoken for s in doc for f in s], np.int32)
    sizes = np.array([len(s) for doc in spoken for s in doc], np.int32)
    n = np.array([len(doc) for doc in spoken])
    model = toxicity._solve(np.arange(len(names)).astype(np.uint64), np.array(y, float), n, word, sizes, np.array(w))

    part = sum(y) / len(y)
    trust = []
    for f in names:
        have = [i for i, doc in enumerate(seen) if any(f in s for s in doc)]
        gain = (sum(y[i] for i in have) - len(have) * part) / (len(have) * part * (1 - part) + 1) ** 0.5
        trust.append(min(1, abs(gain) / toxicity.SURE) ** toxicity.POWER)

    def value(theta):
        total = -toxicity.PENALTY / 2 * sum(t * t for t in theta[:-1])
        for doc, mark, share in zip(seen, y, w, strict=True):
            calm = 1.0
            for s in [s for s in doc if s] or [[]]:
                calm *= 1 - 1 / (1 + np.exp(-theta[-1] - sum(trust[at[f]] * theta[at[f]] for f in s)))
            total += share / sum(w) * np.log(1 - calm if mark else calm)
        return total

    theta = np.array([*(model.weights / np.array(trust)), model.bias])
    best = value(theta)
    for i in range(len(theta)):
        for step in (-0.5, 0.5):
            moved = theta.copy()
            moved[i] += step
            if moved[-1] <= -4:
                assert value(moved) < best + 1e-6
    assert (model.weights < 0).any() and (model.weights > 0).any()


def test_toxicity_sample_takes_both_labels(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 100 == 0).cast("int").alias("toxic"))
    rows = toxicity._sampled(docs, labels, "text", "doc_id", "toxic", 400).groupBy("y").agg(F.count("*").alias("n"), F.sum("w").alias("w")).collect()
    found = {r.y: (r.n, r.w) for r in rows}
    assert found[1] == (40, 40.0) and 150 < found[0][0] < 250 and 3000 < found[0][1] < 5000


# byte-level BPE


def test_bpe_equals_the_library_and_round_trips(spark, monkeypatch):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    assert isinstance(enc, tiktoken.Encoding)
    rng = random.Random(2)
    texts = [*ODD, "".join(rng.choice("ab 's\n\té漢,.") for _ in range(4000)), prose(8, 2000)]
    docs = frame_of(spark, texts)
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()}
    digests = {r.doc_id: r for r in bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        want = enc.encode_ordinary(t or "")
        assert rows[i].ids == want and bytes(rows[i].bytes) == (t or "").encode()
        d = digests[i]
        assert d.n_tokens == len(want) and d.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert d.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    monkeypatch.setattr(bpe, "BLOCK", 50)
    for t in texts:
        parts = list(bpe.safe_pieces(t or "", 50))
        assert "".join(parts) == (t or "") and [x for p in parts for x in enc.encode_ordinary(p)] == enc.encode_ordinary(t or "")
    assert bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_runs_of_white_space(monkeypatch):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for run in (" " * 2_000_000, "\n" * 2_000_000, "\t " * 1_000_000):
        for text in (run, run + "a", "a" + run + " b"):
            ids = bpe.encode_text(enc, text)
            assert enc.decode_bytes(ids) == text.encode()
    monkeypatch.setattr(bpe, "_RUN", 3)
    rnd = random.Random(8)
    for _ in range(3000):
        text = "".join(rnd.choice([" ", "  ", "\n", "\t", "\xa0", "\u3000", "\x1c", "\x85", "a", "1", "!", "'s", "é"]) for _ in range(rnd.randint(0, 25)))
        assert bpe.encode_text(enc, text) == enc.encode_ordinary(text), repr(text)
