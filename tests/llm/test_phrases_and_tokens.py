"""Phrases, alignment and windows against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from check import TABLES, rows_of
from sightline.llm import alignment, memory, phrases, windows
from sightline.llm.queries import LOWER_WORDS, PIECES, TOKENIZER

SF = "/root/testdata/sf0.001"
ALPHABET = ["a", "b", " ", " ", " ", "  ", "\t", "\n", "é", "É", "ß", "漢", "🙂", "́", "'s", "'LL", "<s>", "<|endoftext|>", "the", "Ing ", ".", "23", "\x00", "͸", "\x85", "\x1c", "İ", "Σ"]


def odd_texts(n, seed, more=()):
    rnd = random.Random(seed)
    return ["".join(rnd.choice([*ALPHABET, *more]) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_words_are_cut_where_no_token_spans():
    texts = ["", "a b  c d", " a", "a ", "a  b", "x\ny z"]
    spans = memory.Spans(texts, memory.word_starts)
    assert [spans.joined[a:b] for a, b in zip(spans.starts, spans.ends, strict=True)] == ["a", " b  c", " d", " a", "a ", "a  b", "x\ny", " z"]


def test_memory_forgets_and_gives_the_same_ids():
    seen = []
    small = memory.Memory(lambda words: seen.append(len(words)) or [[len(w), ord(w[-1])] for w in words], kept=3)
    for _ in range(3):
        for texts in (["a bb ccc", "dddd a"], ["e f g h"], ["a a"]):
            ids, bound = memory.Spans(texts, memory.word_starts).ids(small)
            want = [[x for w in re.split("(?= )", t) for x in (len(w), ord(w[-1]))] for t in texts]
            assert [ids[a:b].tolist() for a, b in zip(bound[:-1], bound[1:], strict=True)] == want
    assert sum(seen) > 8  # more than the distinct words


# phrases


def plain_phrases(rows, least, share=80, first=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            w = [x for x in re.split("[ \t]", piece) if x]
            total[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in counts.items():
        found = []
        for p, a in count.items():
            if len(p) < 2 or a < least:
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in count.items() if len(q) > len(p) and b >= least and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= share * a for b in longer):
                found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, total[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(found)[:first], 1)]
    return sorted(out)


def test_phrases_against_sql(spark):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries()["op11_phrases"](spark, SF)
    cursor = db.execute(oracle_sql()["op11_phrases"])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_phrases_against_loops(spark, monkeypatch):
    rnd = random.Random(4)
    words = ["a", "B", "b", "é", "É", "漢字", "x\x00", "c d", "\x01"]
    blanks = [" ", "\t", "  ", ". ", "\n", ", ", " \x0b"]
    texts = ["".join(rnd.choice(words) + rnd.choice(blanks[: rnd.choice([2, 7])]) for _ in range(rnd.randint(0, 30))) for _ in range(150)]
    texts += [None, "", "  .,", "a b " * 700, "a" * 500, texts[0], texts[0]]
    rows = [(rnd.choice(["en", "de", None, "und", "漢"]), t) for t in texts]
    docs = spark.createDataFrame([(i, None, *r) for i, r in enumerate(rows)], "doc_id long, n int, lang string, text string").repartition(3)
    monkeypatch.setattr(phrases, "FLUSH", 50)
    got = phrases.best_collocations(docs, least=6)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, 6)
    got = phrases.best_collocations(docs, first=3, least=6)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, 6, first=3)
    assert phrases.best_collocations(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 7, 40, 1000])
def test_parts_of_long_texts_own_every_phrase_once(size):
    text = " ".join(random.Random(1).choice(["a", "bb", "c.", "dddddddd", "e\n"]) for _ in range(200)).encode()
    got = Counter()
    for part in phrases.parts(text, size):
        words = phrases.Words([part], "en")
        for k in range(1, 5):
            at = [i for i in np.flatnonzero(words.own) if i + k <= len(words.own) and words.joined[i : i + k - 1].all()]
            got.update(words.phrases(np.array(at, np.int64), k).to_pylist())
    want = Counter(" ".join(w[i : i + k]) for p in re.split("[.\n]", text.decode()) for w in [p.split()] for k in range(1, 5) for i in range(len(w) - k + 1))
    assert got == want


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 10**16
    counts = [("en", 0, "", 9 * big), ("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big + 1), ("en", 2, "a b", 2 * big)]
    monkeypatch.setattr(phrases, "phrase_counts", lambda *_: spark.createDataFrame(counts, "lang string, words int, phrase string, n long"))
    row = phrases.collocations(spark.range(1)).collect()[0]
    assert (row.a, row.l, row.r, row.n, row.score) == (2 * big, 3 * big, 2 * big + 1, 9 * big, 2_000_000 * 2 * big // (5 * big + 1))


# alignment


def plain_alignment(texts):
    a, b = Tokenizer.from_file(TOKENIZER), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    pair, docs, count = alignment.Pair(TOKENIZER, PIECES), [], Counter()
    for t in texts:
        ids = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        raw = [pair.bytes_a[i] for i in ids[0]], [pair.bytes_b[i] for i in ids[1]]
        if not t or any(b"".join(x) != (" " + t).encode() for x in raw):
            docs.append(None)
            continue
        ends = [np.cumsum([len(x) for x in r]).tolist() for r in raw]
        begins = [[0, *e[:-1]] for e in ends]
        links, j = [], 0
        for i in range(len(ends[0])):
            while ends[1][j] <= begins[0][i]:
                j += 1
            k = j
            while k < len(ends[1]) and begins[1][k] < ends[0][i]:
                links.append((ids[0][i], ids[1][k]))
                k += 1
        groups, x, y = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(cut, x) + 1, ends[1].index(cut, y) + 1
            groups.append(",".join(map(str, ids[0][x:p])) + "|" + ",".join(map(str, ids[1][y:q])))
            x, y = p, q
        docs.append((len(ids[0]), len(ids[1]), len(groups), links, ";".join(groups)))
        count.update(links)
    best = Counter()
    for (_, b_id), n in count.items():
        best[b_id] = max(best[b_id], n)
    plain = lambda d: (*d[:3], len(d[3]), sum(count[x] == best[x[1]] for x in d[3]), sum(count[x] for x in d[3]), hashlib.sha256(d[4].encode()).hexdigest(), d[4])
    return [plain(d) if d else (0, 0, 0, 0, 0, 0, "", None) for d in docs]


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


def test_alignment_against_loops(spark, monkeypatch):
    texts = odd_texts(400, 1) + odd_texts(100, 2, ["▁"]) + ["", None, " ", "   ", "a", "word " * 3000, "x" * 9000, " " * 2000 + "b", "ab\n" * 2000]
    monkeypatch.setattr(alignment, "NUMBERED", 40)  # many books
    docs = spark.createDataFrame([(i, t, "n", 7) for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string, n string, book int").repartition(3)
    want = plain_alignment([*texts, texts[3]])
    got = {r.doc_id: tuple(r[c] for c in NUMBERS) for r in alignment.align(docs, TOKENIZER, PIECES, groups=True).collect()}
    assert got == dict(enumerate(want))
    assert alignment.align(docs.limit(0), TOKENIZER, PIECES).count() == 0


def test_alignment_of_long_texts_in_pieces(monkeypatch):
    pair = alignment.Pair(TOKENIZER, PIECES)
    text = "Some words, é漢字 and\n\nmore <s>  of them 12345 " * 60
    update = alignment.Numbers().of
    whole = alignment._aligned([text], pair, True, update)
    assert len(whole[0][5]) > 1000
    monkeypatch.setattr(alignment, "BLOCK", 300)
    assert alignment._aligned([text], pair, True, update) == whole
    assert alignment._aligned([text + "▁"], pair, True, update) == [(0, 0, 0, 0, "", None, b"", b"")]


@pytest.mark.parametrize("lane", [1, 3, 1024])
def test_lockstep_of_any_lane(lane):
    rnd = random.Random(lane)
    for _ in range(30):
        sizes = [rnd.randint(1, 30) for _ in range(rnd.randint(1, 6))]
        starts = np.append(0, np.cumsum(sizes))
        cut = [np.array(sorted({*starts[1:].tolist(), *rnd.sample(range(1, starts[-1] + 1), rnd.randint(0, starts[-1]))})) for _ in range(2)]
        begin = [np.append(0, c[:-1]) for c in cut]
        want = [(i, j) for i in range(len(cut[0])) for j in range(len(cut[1])) if begin[0][i] < cut[1][j] and begin[1][j] < cut[0][i]]
        a, b, cuts = alignment.lockstep(cut[0], cut[1], starts, lane)
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == want
        assert cuts.tolist() == sorted({*cut[0].tolist()} & {*cut[1].tolist()})


def test_steps_keep_large_gaps_and_counts():
    number, times = np.array([0, 3, 70_000, 300_000, 300_001]), np.array([1, 700, 2, 255, 256])
    steps, counts = alignment._steps(number, times)
    total = Counter()
    for n, t in zip(np.cumsum(np.frombuffer(steps, "<u2"), dtype=np.int64).tolist(), np.frombuffer(counts, np.uint8).tolist(), strict=True):
        total[n] += t
    assert +total == dict(zip(number.tolist(), times.tolist(), strict=True))


# windows


def test_differencing_gives_near_equal_windows():
    rnd = random.Random(2)
    for _ in range(30):
        lengths = [rnd.randint(1, 400) for _ in range(rnd.randint(1, 150))]
        m = rnd.randint(1, 12)
        found = windows.differenced(lengths, m)
        assert len(found) == m and sorted(i for w in found for i in w) == list(range(len(lengths)))
        sums = [sum(lengths[i] for i in w) for w in found]
        if len(lengths) > 12 * m:
            assert max(sums) - min(sums) < 20
    assert sorted(map(sum, ([(8, 7, 6, 5, 4)[i] for i in w] for w in windows.differenced([8, 7, 6, 5, 4], 2)))) == [14, 16]


def test_balanced_takes_one_window_more_until_all_fit():
    assert len(windows.balanced([6, 6, 6], 10)) == 3  # two windows would exceed the capacity
    assert len(windows.balanced([5, 5, 5, 5], 10)) == 2
    assert windows.balanced([], 10) == []
    found = windows.balanced([4, 4, 4, 4, 4], 10)
    assert len(found) == 3 and max(len(w) for w in found) == 2


@pytest.mark.parametrize("capacity", [8, 64])
def test_filled_sequences_hold_every_token_once(capacity):
    rnd = random.Random(capacity)
    for _ in range(60):
        lengths = [rnd.choice([1, 2, capacity, rnd.randint(1, 3 * capacity)]) for _ in range(rnd.randint(0, 40))]
        used, rest = Counter(), []
        for sequence in windows.filled(lengths, capacity):
            size = sum(n for *_, n in sequence)
            rest += [size] * (size != capacity)
            used.update((i, x) for i, start, n in sequence for x in range(start, start + n))
        assert used == Counter((i, x) for i, n in enumerate(lengths) for x in range(n))
        assert sum(rest) == sum(lengths) % capacity and len(set(rest)) == len(rest) and all(n.bit_count() == 1 for n in rest)


def test_windows_against_the_tokenizer(spark):
    texts = odd_texts(400, 5, ["<|startoftext|>"]) + odd_texts(600, 6, ["T", "̈", "AB", "x,", "I", "̇", "'", "?!"]) + ["<|ENDOFTEXT|> A", "A <|endoftext|>,b", "", None, " ", "word " * 9000, "x" * 5000, " " * 3000 + "b", "ab\n" * 3000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int").repartition(3)
    got = windows.pack(docs, LOWER_WORDS, 2, capacity=64, group=8, ids=True).collect()
    tokenizer, of, sequences = Tokenizer.from_file(LOWER_WORDS), defaultdict(list), defaultdict(list)
    for r in got:
        of[r.doc_id].append(r), sequences[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids, rows = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], sorted(of[i], key=lambda r: r.start)
        assert [x for r in rows for x in r.ids] == ids and {r.doc_tokens for r in rows} == {len(ids)}
        assert [r.start for r in rows] == np.cumsum([0, *(r.length for r in rows)])[:-1].tolist()
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in rows)
    total = sum(r.length for r in got)
    sizes = [sum(r.length for r in rows) for rows in sequences.values()]
    assert sorted(s for s in sizes if s != 64) == [1 << k for k in range(6) if total % 64 >> k & 1]
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0, *(r.length for r in rows)])[:-1].tolist()
    assert windows.pack(docs.limit(0), LOWER_WORDS, 2).count() == 0


def test_windows_of_repeated_rows_and_null_keys(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "d"), (None, None)], "doc_id long, text string")
    rows = windows.pack(docs, LOWER_WORDS, 2).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {(r.doc_id, r.n) for r in rows} == {(1, 8), (None, 3)}
