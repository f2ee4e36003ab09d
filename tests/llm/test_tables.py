"""Near copies, personal data, dialogues, search, packing, URL filters and the pipeline against plain versions."""

import hashlib
import itertools
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import TABLES, rows_of
from sightline.llm import dialogues, nearcopies, packing, personal, search, urls
from sightline.llm.queries import END_ID, RULES, TOKENIZER

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_near_copies", "op5_perspectives", "op6_top_k"])
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries()[name](spark, SF)
    cursor = db.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


# near copies


def plain_sets(rows, words):
    out = defaultdict(set)
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        out[key] |= {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    return out


def plain_components(sets, percent):
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]) and find(a) != find(b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in sets}


def families():
    """Groups of copies with few to many edits, a passage that a third of all texts share, and odd texts."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    rows = []
    for size, length in ((160, 120), (60, 30), (40, 400), (5, 8)):
        base = [word() for _ in range(length)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own).upper() if rng.random() < 0.2 else "\t".join(own))
    for _ in range(150):
        rows.append(" ".join([*passage, *(word() for _ in range(rng.randint(3, 60)))]))
    rows += [None, "", " \n", "one", "one", "ONE", "two words", "two  words", "É a b c d e", "é a b c d e", "w " * 5000]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, words, percent):
    rows = families()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).repartition(5)
    got = nearcopies.linked(docs, words=words, percent=percent).collect()
    sets = plain_sets(rows, words)
    assert {r.doc_id: r.n_shingles for r in got} == {k: len(s) for k, s in sets.items()}
    assert {r.doc_id: r.component_id for r in got} == plain_components(sets, percent)
    if percent == 80:
        kept = nearcopies.first_of_each(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain_components(sets, percent).values()))


@pytest.mark.parametrize("words, percent, chunk", [(4, 85, nearcopies.CHUNK), (5, 80, 5000)])
def test_link_counts_equal_brute_force(spark, monkeypatch, words, percent, chunk):
    monkeypatch.setattr(nearcopies, "CHUNK", chunk)
    rows = families()
    got = nearcopies.link_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), words=words, percent=percent).collect()
    sets = plain_sets(rows, words)
    links, same = Counter(), {k: k for k in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            links.update((a, b))
            if sets[a] == sets[b]:
                same[b] = min(same[b], a)
    assert sorted((r.doc_id, r.n_shingles, r.class_id, r.n_links) for r in got) == sorted((k, len(s), same[k], links[k]) for k, s in sets.items())
    assert max(links.values()) > 30


def test_link_counts_of_repeated_and_null_keys(spark):
    rows = [(1, "a b c d e f"), (1, "x y z u v w"), (1, "x y z u v w"), (2, "x y z u v w"), (3, "a b c d e f"), (None, "a b c d e f"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in nearcopies.link_counts(docs).collect())
    assert got == Counter([(1, 1, 1), (1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 1, 1), (None, None, None), (4, 4, 0)])
    assert nearcopies.link_counts(docs.limit(0)).count() == 0


def test_link_counts_against_sql(spark):
    test_query_against_sql(spark, "op3_near_copy_links")


def test_repeated_and_null_keys(spark):
    rows = [(1, "a b c d e f"), (1, "x y z u v w"), (2, "x y z u v w"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nearcopies.linked(docs).collect()
    assert {r.component_id for r in got if r.doc_id} == {1} and sum(r.doc_id is None for r in got) == 2
    assert nearcopies.linked(docs.limit(0)).count() == 0 and nearcopies.first_of_each(docs.limit(0)).count() == 0


def test_a_key_whose_texts_lie_in_two_classes_joins_them(spark):
    one, two = "a b c d e f", "x y z u v w"
    docs = spark.createDataFrame([(3, one, 1), (5, one, 2), (5, two, 3), (4, two, 4), (None, one, 5), (7, "k l m n o p", 6)], "doc_id long, text string, _kept int")
    got = Counter((r.doc_id, r.component_id) for r in nearcopies.linked(docs).collect())
    assert got == Counter([(3, 3), (5, 3), (5, 3), (4, 3), (None, None), (7, 7)])
    assert sorted((r.doc_id, r._kept) for r in nearcopies.first_of_each(docs).collect()) == [(3, 1), (7, 6)]


def test_one_row_of_repeated_rows_and_of_rows_without_a_key_stays(spark):
    one, two = "a b c d e f", "x y z u v w"
    docs = spark.createDataFrame([(1, one), (1, one), (2, one), (None, one), (None, two), (None, two), (None, None), (8, "")], "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in nearcopies.first_of_each(docs).collect())
    assert kept == Counter([(1, one), (None, two), (None, None), (8, "")])


@pytest.mark.parametrize("percent", [85, 80])
def test_linked_sets_share_a_kept_signature(percent):
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = a[rng.permutation(len(a))[: max(1, int(len(a) * rng.uniform(0.8, 1)))]]
        b = np.unique(np.append(b, rng.integers(0, 2**63, int(rng.integers(0, 3))).astype(np.uint64)))
        shared = len(np.intersect1d(a, b))
        if 100 * shared < percent * len(np.union1d(a, b)) or shared == len(a) == len(b):
            continue
        sig, tag, count = nearcopies.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), percent)
        one, two = (list(zip(s.tolist(), (t // nearcopies._TAG).tolist(), strict=True)) for s, t in ((sig[: count[0]], tag[: count[0]]), (sig[count[0] :], tag[count[0] :])))
        common = set(one) & set(two)
        room = {(x // nearcopies._TAG): x % nearcopies._TAG for x in tag.tolist()}
        assert any(len([c for c in common if c[1] == band]) > 0 for band in room)
        assert nearcopies._distance(nearcopies._sketch(a), nearcopies._sketch(b)) <= len(np.setxor1d(a, b))


# personal data


def plain_spans(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m, d: 12 <= len(d) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
    ]
    found = []
    for k, (name, pattern, valid) in enumerate(rules):
        found += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text) if valid(m[0], re.sub("[^0-9]", "", m[0]))]
    return [(s, e, name) for s, _, e, name in sorted(found)]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    bits = [*"a.b@-_+1 (4)é9,", "1.2.3.4", "@x.yy", "4111 1111 1111 1111", "+49 30 123456", "0001.255.256.9", "DE89370400440532013000", " card ", "😀"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + [None, "", "a@b.cc " * 700, "1" * 3000, "'\\"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1)).repartition(8)
    for r in personal.find_spans(docs).collect():
        assert [(s.start, s.end, s.kind) for s in r.spans if s.kind in personal.BASE] == plain_spans(texts[r.doc_id] or "")
        assert list(r.spans) == sorted(r.spans, key=lambda s: s.start)


def test_long_runs_take_time_in_proportion(spark):
    docs = spark.createDataFrame([(0, "a" * 300_000), (1, "a.b@" + "x." * 100_000), (2, "9" * 300_000), (3, "+" * 100_000)], "doc_id long, text string")
    assert [len(r.spans) for r in personal.find_spans(docs).orderBy("doc_id").collect()] == [0, 1, 0, 0]


def test_checksums_context_and_redaction(spark):
    texts = ["pay DE89 3704 0044 0532 0130 00 now", "iban DE89370400440532013000", "DE88370400440532013000", "call +1 (269) 555-3296 4524132264652876 ok", "ssn 123-45-6789", "no 123-45-6789", "clean text 2024-01-02", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in personal.find_spans(docs).collect()}
    assert kinds == {0: ["iban"], 1: ["iban"], 2: [], 3: ["phone_group", "card_group"], 4: ["tax_id"], 5: [], 6: [], 7: []}
    done = {r.doc_id: r.text for r in personal.redact(docs).collect()}
    assert done[0] == "pay [IBAN] now" and done[3] == "call [PHONE_GROUP] [CARD_GROUP] ok" and done[6] == texts[6] and done[7] is None


def test_columns_with_working_names_come_back_unchanged(spark):
    names = ["_t", "_text", "_base", "_more", "_row", "_k_email", "_h_email", "_m_email", "a.b", "spans"]
    raw = "mail bob@example.com now"
    docs = spark.createDataFrame([(1, raw, *(f"own {c}" for c in names))], ["doc_id", "text", *names])
    row = personal.redact(docs).first()
    assert row.text == "mail [EMAIL] now" and [row[c] for c in names] == [f"own {c}" for c in names]
    found = personal.find_spans(docs).first()
    assert [s.kind for s in found.spans] == ["email"] and [found[c] for c in names[:-1]] == [f"own {c}" for c in names[:-1]]


# dialogues


TURNS = "conv_id long, turn long, role string, text string"


def plain_perspectives(rows, part):
    """(dialogue, speaker, part): start, lead, number of turns, text, masks; by walking each dialogue once per speaker."""
    want = {}
    for conv in {r[0] for r in rows}:
        digest = lambda r: hashlib.md5((r[3] or "").encode()).hexdigest()
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", digest(r)))
        shown = lambda r, speaker: "assistant" if r[2] == speaker else "system" if r[2] == "system" else f"user name={r[2]}" if r[2] is not None else "user"
        written = lambda r, speaker: f"<|im_start|>{shown(r, speaker)}\n{r[3] or ''}<|im_end|>\n"
        sizes = [len(written(r, object())) for r in own]
        places = [sum(sizes[:i]) // part if sum(sizes) > part else 0 for i in range(len(own))]
        opening = list(itertools.takewhile(lambda x: x[0][2] == "system" and x[1] == 0, zip(own, places, strict=True)))
        for speaker in {r[2] for r in own} - {None, "system"}:
            done = 0
            for p in sorted(set(places)):
                turns = [r for r, q in zip(own, places, strict=True) if q == p]
                text = "".join(written(r, speaker) for r, _ in opening) if p else ""
                lead, masks = len(text), []
                for r in turns:
                    said = written(r, speaker)
                    if r[2] == speaker:
                        masks.append((len(text) + said.index("\n") + 1, len(text) + len(said) - 1))
                    text += said
                if masks:
                    want[conv, speaker, p] = done, lead, len(turns), text, masks
                done += len(text) - lead
    return want


def perspectives_of(spark, rows, part=dialogues.PART):
    got = dialogues.perspectives(spark.createDataFrame(rows, TURNS).repartition(3), part=part).collect()
    found = {(r.conv_id, r.speaker, r.part): (r.start, r.lead, r.n_turns, r.rendered, [tuple(m) for m in r.masks]) for r in got}
    assert len(found) == len(got)
    return found


ODD_TURNS = [(1, 0, "system", "be kind"), (1, 1, "user", "hi é"), (1, 2, "assistant", "hello"), (1, 2, "assistant", "hello"), (1, 300, "ann", None)]
ODD_TURNS += [(2, 0, "system", "x"), (3, None, None, "?"), (3, 1, "bob", "ok"), (None, 0, "ann", "n"), (None, 10**12, "", "no name"), (4, 5, None, None)]


@pytest.mark.parametrize("part", [dialogues.PART, 200, 60, 1])
def test_perspectives_against_plain_version(spark, part):
    assert perspectives_of(spark, ODD_TURNS, part) == plain_perspectives(ODD_TURNS, part)
    assert perspectives_of(spark, [], part) == {}


def test_a_long_dialogue_is_whole(spark):
    rows = [(7, 1000 * i, ("system", "bob", "assistant")[min(i, 1 + i % 2)], f"turn {i}") for i in range(1000)] + [(7, 999_500, "carol", "late")]
    got = perspectives_of(spark, rows)
    assert got == plain_perspectives(rows, dialogues.PART)
    assert {k: len(v[4]) for k, v in got.items()} == {(7, "bob", 0): 500, (7, "assistant", 0): 499, (7, "carol", 0): 1}  # bob has turn 1 too


def test_parts_of_a_hot_dialogue(spark):
    rng = random.Random(4)
    rows = [(None, 0, "system", "rules"), (None, 0, "system", "more rules"), (None, 5000, "carol", "late")]
    rows += [(None, rng.randrange(400) if i % 3 else None, rng.choice(["ann", "bob", None, "system"]), "é" * rng.randrange(20)) for i in range(700)]
    rows += [(None, 77, "ann", "the same")] * 300 + [(i, 1, "ann", "short") for i in range(40)]
    got = perspectives_of(spark, rows, 2_000)
    assert got == plain_perspectives(rows, 2_000)
    assert max(k[2] for k in got) > 10 and sum(k[1] == "carol" for k in got) == 1
    leads = [(None, -1, "system", "rules"), *((None, i, "ann", "x" * 50) for i in range(100))]
    got = perspectives_of(spark, leads, 500)
    assert got == plain_perspectives(leads, 500) and {v[1] > 0 for k, v in got.items() if k[2]} == {True}


def test_the_longest_dialogue_is_one_row_as_in_the_sql(spark, tmp_path):
    rows = [(1, i, ("system", "ann", "bob", None)[min(i, 1 + i % 3)], f"{i} " + "é-" * 3000) for i in range(250)] + [(2, 0, "ann", "short")]
    spark.createDataFrame(rows, TURNS).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    df = queries()["op5_perspectives"](spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = db.execute(oracle_sql()["op5_perspectives"])
    got = df.collect()
    assert rows_of(df.columns, got) == rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert max(len(r.rendered) for r in got) > dialogues.PART and [r.part for r in got] == [0, 0, 0]


@pytest.mark.parametrize("most", [0, 100, 10**9])
def test_whole_dialogues_are_the_same_however_they_are_placed(spark, monkeypatch, most):
    monkeypatch.setattr(dialogues, "PART", most)
    assert perspectives_of(spark, ODD_TURNS, None) == plain_perspectives(ODD_TURNS, 10**9)
    assert perspectives_of(spark, ODD_TURNS, 60) == plain_perspectives(ODD_TURNS, 60)


# search


def plain_top(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok[i] = [int(np.floor(64 * float(np.float32(x)))) for x in v]
    out = []
    for q in sorted(ok):
        if q % 20 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(ok[q], v, strict=True)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize("n, block", [(300, 2048), (300, 4), (9, 2048), (0, 2048)])
def test_top_k_equals_brute_force(spark, monkeypatch, n, block):
    monkeypatch.setattr(search, "QUERY_BLOCK", block)
    rng = random.Random(n)
    rows = [(i, [rng.choice([-0.5, 0.1, 0.25, rng.random()]) for _ in range(6)]) for i in range(n)]
    rows += [(i, rows[7][1]) for i in range(1000, 1000 + n // 6)]  # ties
    rows += [(2000, None), (2020, [1.0, None, 0, 0, 0, 0]), (2040, [float("nan")] * 6), (2060, [float("inf")] * 6), (2080, []), (None, [1.0] * 6)] if n > 9 else []
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(4)
    got = search.search(vectors, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain_top(rows, search.K)


# packing


def test_split_and_ids_equal_the_tokenizer():
    tokenizer, ids = Tokenizer.from_file(TOKENIZER), packing.Ids(TOKENIZER)
    rng = random.Random(3)
    bits = [*"ab'stremvlld  \n\t!?.,é1２中́ 　", "'s", "'re", "'ll", " '", "\x1c", "͸", "\x00", "S"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", " ", "a" * 3000]
    for _ in range(2):  # with and without remembered pieces
        for t, got in zip(texts, ids.of(texts), strict=True):
            assert got.tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_pieces_go_to_the_model_alone_and_equal_the_tokenizer():
    tokenizer, ids = Tokenizer.from_file(TOKENIZER), packing.Ids(TOKENIZER)
    known = "".join(chr(c) for c in np.flatnonzero(packing.classes()[:0x110000] != packing._UNKNOWN) if not 0xD800 <= c < 0xE000)
    seen = []
    ids.tokenizer = type("Watched", (), {"model": tokenizer.model, "encode_batch_fast": lambda self, x, **_: seen.append(x)})()
    for first in range(0, len(known), 4096):  # one sets a class apart from the other two by its neighbours
        text = "".join(f"a{c}1{c}!{c}" for c in known[first : first + 4096])
        assert ids.of([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert not seen


@pytest.mark.parametrize("change", [{"add_prefix_space": True}, {"use_regex": False}])
def test_other_tokenizers_encode_the_pieces_themselves(tmp_path, change):
    steps = json.loads(Tokenizer.from_file(TOKENIZER).to_str())
    steps["pre_tokenizer"] |= change
    path = tmp_path / "other.json"
    path.write_text(json.dumps(steps))
    assert not packing.Ids(str(path))._only_bytes() and packing.Ids(TOKENIZER)._only_bytes()


def test_added_tokens_equal_the_tokenizer(spark):
    tokenizer, ids = Tokenizer.from_file(TOKENIZER), packing.Ids(TOKENIZER)
    rng = random.Random(5)
    texts = ["one<|endoftext|>two", "<|endoftext|>", "a" + "<|endoftext|>" * 3 + " b's", "<|endoftext|", "x y " * 300_000 + "<|endoftext|> z"]
    texts += ["".join(rng.choice(["<|endoftext|>", "<|", "ab", " ", "'s", "\n", "͸"]) for _ in range(12)) for _ in range(300)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [505, 50256, 11545]
    assert [got.tolist() for got in ids.of(texts)] == want
    docs = spark.createDataFrame(list(enumerate(texts[:5])), "doc_id long, text string")
    got = defaultdict(list)
    for r in sorted(packing.pieces(docs, TOKENIZER, END_ID, ids=True).collect(), key=lambda r: r.piece):
        got[r.doc_id] += r.ids
    assert [got[i] for i in range(5)] == [[*x, END_ID] for x in want[:5]]


def test_plan_uses_every_piece_once():
    rng = random.Random(1)
    for _ in range(150):
        counts = {rng.randint(1, 64): rng.randint(1, rng.choice([2, 50, 1000])) for _ in range(rng.randint(0, 40))}
        used, plan = Counter(), packing.plan(counts, 64)
        for lengths, times in plan:
            assert times > 0 and sum(lengths) <= 64
            for x in lengths:
                used[x] += times
        assert used == Counter(counts)
        least = -(-sum(k * n for k, n in counts.items()) // 64)
        assert sum(t for _, t in plan) <= 2 * least + 1


def test_packed_documents(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["ab", "é", "word", "x1", "\n"]) for _ in range(rng.choice([0, 3, 40, 200, 1023, 5000])))) for i in range(120)]
    rows += [(200, None), (201, ""), (7, rows[7][1]), (None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("offset", F.lit("x")).repartition(4)
    got = packing.packed(docs, TOKENIZER, END_ID, ids=True).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for n, (a, b) in enumerate(itertools.pairwise(edges)):
            want[key, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert all(len(r.ids) == r.length for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.1 * -(-sum(r.length for r in got) // 1024) + 1
    assert packing.packed(docs.limit(0), TOKENIZER, END_ID).count() == 0


# URL filters


def plain_url(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


def test_url_rules_and_trees(spark):
    rng = random.Random(8)
    texts = [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'a.', 'M.'])}{rng.choice(['example.net', 'Example.COM', 'x.org', 'net', 'planet', 'b.io'])}{rng.choice(['', '/', '/en/', '/de/1', '/fr/x?y=1&z', '?/en/', '#a/de/', '/EN/'])}" for _ in range(400)]
    texts += [None, "", "no scheme", "://", "a://net/", "http://é.net/%20?q", "http://x.org/" + "a" * 5000]
    pages = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "page_id long, url string, host string").repartition(4)
    got = {r.page_id: r for r in urls.judge(pages, RULES, keep=["page_id"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        host, path, rule, verdict = plain_url(t)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block") and 0 <= got[i].score <= 1
    only = urls.judge(pages.where("url like '%.org/fr/%'").union(pages.where("url is null")), RULES)
    assert {r.verdict for r in only.collect()} == {"allow"}
    assert urls.judge(pages.limit(0), RULES).count() == 0


def test_trees_learn_from_labelled_urls(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.org/{'fr/' if i % 2 == 0 else ''}{'?a=1&b=2&c=3' if i % 2 else 'p'}{i}") for i in range(200)], "page_id long, url string")
    rules = [urls.Rule("bad.org", "/", "block"), urls.Rule("org", "/fr/", "allow")]
    more = spark.createDataFrame([(1000, "http://new.com/?a=1&b=2&c=77"), (1001, "http://new.com/fr/p8")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(pages.union(more), rules).where("rule is null").collect()}
    assert got == {1000: "block", 1001: "allow"}


def test_block_rates_count_every_suffix_of_the_table(spark):
    row = "http://www.{}{:03}.com/{}/p"
    rules = [urls.Rule("com", "/x/", "block"), urls.Rule("com", "/y/", "allow")]
    names = [(rng.choice("abcdefgh"), i) for rng in [random.Random(9)] for i in range(600)]
    blocked = {i: random.Random(i).random() < 0.5 for _, i in names}
    texts = [row.format(c, i, "x" if blocked[i] else "y") for c, i in names for _ in range(3)] + [row.format(c, i, "z") for c, i in names]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    for rows in (urls.TRAIN_ROWS, 400):
        got = {r.page_id: r.verdict for r in urls.judge(pages, rules, rows=rows).where("rule is null").collect()}
        assert got == {1800 + i: "block" if blocked[i] else "allow" for i in range(600)}


def test_a_rare_verdict_and_one_hot_url_are_learned(spark):
    texts = ["http://hot.com/y/"] * 3000 + [f"http://bad{i}.com/x/" for i in range(5)] + ["http://bad1.com/z/", "http://hot.com/z/"]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    rules = [urls.Rule("com", "/x/", "block"), urls.Rule("com", "/y/", "allow")]
    got = {r.page_id: r.verdict for r in urls.judge(pages, rules, rows=300).where("rule is null").collect()}
    assert got == {3005: "block", 3006: "allow"}


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == names and 0 < docs.count() <= before, name
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == before
    assert personal.find_spans(docs).where("size(spans) > 0").count() == 0


def test_pipeline_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
