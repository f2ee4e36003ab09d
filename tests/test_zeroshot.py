import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.functions import vectors
from sightline.operators import numeric, zeroshot


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    images = rng.normal(size=(60, 12)).astype(np.float32)
    images[7] = 0
    prompts = rng.normal(size=(9, 3, 12)).astype(np.float32)
    prompts /= np.linalg.norm(prompts, axis=2, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(images)], "vec_id int, embedding array<float>")
    bank = spark.createDataFrame(
        [(c, t, prompts[c, t].tolist()) for c in range(9) for t in range(3)],
        "category_idx int, template_idx int, vec array<float>",
    )
    return images, prompts, df, bank


def expected_scores(images, prompts):
    with np.errstate(invalid="ignore"):
        unit = images.astype(float) / np.linalg.norm(images.astype(float), axis=1, keepdims=True)
    return np.einsum("nd,ctd->nct", unit, prompts.astype(float)).max(axis=2)


def test_scores_equal_a_plain_product(data):
    images, prompts, df, bank = data
    want = expected_scores(images, prompts)
    got = {r.vec_id: r.scores for r in zeroshot.score_prompts(df, zeroshot.load_bank(bank)).collect()}
    assert got[7] is None
    for i in range(60):
        if i != 7:
            assert got[i] == pytest.approx(want[i])
    scaled = zeroshot.score_prompts(df, zeroshot.load_bank(bank), logit_scale=2.0).filter("vec_id = 3").first().scores
    assert scaled == pytest.approx(want[3] * np.exp(2.0))


@pytest.mark.parametrize("slice_bytes", [1 << 20, 500, 100])
def test_top_k_of_any_slices(data, slice_bytes):
    images, prompts, df, bank = data
    assert len(zeroshot.load_bank(bank, slice_bytes).slices) == 1 or slice_bytes < 1 << 20
    want = expected_scores(images, prompts)
    for k in (1, 3, 20):
        out = zeroshot.topk_categories(df, bank, k=k, slice_bytes=slice_bytes).collect()
        got = {(r.vec_id, r.rank): (r.category_idx, r.score) for r in out}
        assert len(got) == 59 * min(k, 9) == len(out)
        for i in set(range(60)) - {7}:
            for rank, category in enumerate(np.argsort(-want[i], kind="stable")[:k], 1):
                assert got[(i, rank)] == (category, pytest.approx(want[i, category]))


def test_scores_of_any_slices_and_an_index_without_prompts(data):
    images, prompts, df, bank = data
    want = expected_scores(images, prompts)
    some = bank.filter("category_idx NOT IN (0, 4)")
    for slice_bytes in (1 << 20, 300):
        scored = zeroshot.score_prompts(df, zeroshot.load_bank(some, slice_bytes)).filter("vec_id < 7").collect()
        for r in scored:
            assert [x is None for x in r.scores] == [c in (0, 4) for c in range(9)]
            assert [x for x in r.scores if x is not None] == pytest.approx([x for c, x in enumerate(want[r.vec_id]) if c not in (0, 4)])
        best = zeroshot.topk_categories(df, some, k=9, slice_bytes=slice_bytes)
        assert {r.category_idx for r in best.collect()} == set(range(9)) - {0, 4}


def test_merged_top_counts_a_category_once():
    idx, top = numeric.merged_top(np.array([[3, 1]]), np.array([[0.9, 0.5]]), np.array([[1, 2]]), np.array([[0.7, 0.7]]), 3)
    assert idx.tolist() == [[3, 1, 2]] and top.tolist() == [[0.9, 0.7, 0.7]]
    idx, top = numeric.merged_top(np.array([[1]]), np.array([[0.5]]), np.array([[1]]), np.array([[0.4]]), 3)
    assert idx.tolist() == [[1]] and top.tolist() == [[0.5]]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 20])
def test_ties_go_by_category(frame, slice_bytes):
    bank = frame([(c, 0, [1.0, 0.0]) for c in (2, 0, 1)], "category_idx int, template_idx int, vec array<float>")
    df = frame([(1, [3.0, 4.0])], "vec_id int, embedding array<float>")
    out = zeroshot.topk_categories(df, bank, k=2, slice_bytes=slice_bytes).orderBy("rank").collect()
    assert [r.category_idx for r in out] == [0, 1]
    top = df.select(vectors.top_k(F.array(F.lit(0.1), F.lit(0.5), F.lit(0.5)), 2).alias("t")).first().t
    assert [(t.idx, t.score) for t in top] == [(1, 0.5), (2, 0.5)]


def test_no_shuffle_of_images(data):
    _, _, df, bank = data
    plan = zeroshot.topk_arrays(df, zeroshot.load_bank(bank, 300))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_unusable_vectors(frame, data):
    bank = zeroshot.load_bank(data[3])
    rows = [(1, None), (2, [1.0] * 5), (3, [None] + [1.0] * 11), (4, [1.0] * 12)]
    out = zeroshot.score_prompts(frame(rows, "vec_id int, embedding array<float>"), bank).collect()
    assert [r.vec_id for r in out if r.scores is not None] == [4]


def test_bad_banks(frame):
    schema = "category_idx int, template_idx int, vec array<float>"
    with pytest.raises(ValueError):
        zeroshot.load_bank(frame([(0, 0, [1.0]), (1, 0, [1.0, 2.0])], schema))
    with pytest.raises(ValueError):
        zeroshot.load_bank(frame([], schema))


def test_expand_prompts(frame):
    out = zeroshot.expand_prompts(frame([(0, "Light Bulb"), (1, "Nut")], "category_idx int, category string"), ["a {}", "{} here"])
    assert {(r.category_idx, r.template_idx): r.prompt for r in out.collect()} == {
        (0, 0): "a light bulb", (0, 1): "light bulb here", (1, 0): "a nut", (1, 1): "nut here",
    }


def test_best_template(frame):
    scored = frame([(1, 0, 0, 0.1), (1, 0, 1, 0.7), (1, 1, 0, -0.2)], "vec_id int, category_idx int, template_idx int, score double")
    assert {(r.vec_id, r.category_idx): r.score for r in zeroshot.best_template(scored).collect()} == {(1, 0): 0.7, (1, 1): -0.2}


def test_vector_functions(frame):
    df = frame([([1.0, -2.0, 2.0],)], "v array<float>")
    v = F.col("v")
    row = df.select(
        vectors.l2_norm(v).alias("n"), vectors.l2_normalize(v).alias("u"), vectors.dot(v, v).alias("d"),
        vectors.softmax(v).alias("s"), vectors.log_softmax(v).alias("l"), vectors.argmax(v).alias("a"),
        vectors.l2_normalize(F.array(F.lit(0.0), F.lit(0.0))).alias("z"),
    ).first()
    assert (row.n, row.d, row.a, row.z) == (3.0, 9.0, 2, None)
    assert row.u == pytest.approx([1 / 3, -2 / 3, 2 / 3])
    want = np.exp([1, -2, 2]) / np.exp([1, -2, 2]).sum()
    assert row.s == pytest.approx(want) and sum(row.s) == pytest.approx(1, abs=1e-5)
    assert row.l == pytest.approx(np.log(want))


def test_softmax_of_large_logits(frame):
    out = frame([([1000.0, 1000.0, -1000.0],)], "v array<double>").select(vectors.softmax(F.col("v")).alias("s")).first().s
    assert out == pytest.approx([0.5, 0.5, 0.0])


def test_erf():
    import math

    x = np.concatenate([np.linspace(-8, 8, 4001), [0.0, 1e-12]])
    assert np.abs(numeric.Erf()(x) - [math.erf(v) for v in x]).max() < 1e-12


def test_slices_do_not_change_scores(monkeypatch):
    rng = np.random.default_rng(1)
    unit, prompts, owner = rng.normal(size=(50, 6)), rng.normal(size=(12, 6)), np.repeat(np.arange(4), 3)
    whole = numeric.best_prompt_scores(unit, prompts, owner, 4)
    top = numeric.top_categories(unit, prompts, owner, 4, 2)
    monkeypatch.setattr(numeric, "SLICE_CELLS", 40)
    assert np.array_equal(whole, numeric.best_prompt_scores(unit, prompts, owner, 4))
    assert all(np.array_equal(a, b) for a, b in zip(top, numeric.top_categories(unit, prompts, owner, 4, 2)))
