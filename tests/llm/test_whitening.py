"""Whitening against a dense eigensolver, exact integers and odd rows."""

import numpy as np
import pytest

from corvane.llm import queries, whitening

FOLDER = "/root/testdata/sf0.001"


def plain(rows, k=16):
    """``{key: (deviation, whitened)}`` lists, variances over trace, by numpy on all rows at once."""
    good = [(key, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for key, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in good}), dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = ((n * x - s) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    keep = values > 1e-10 * max(values[0], 1e-300)
    values, vectors = values[keep], vectors[:, keep]
    out = []
    for key, v in good:
        shifted = n * np.array(v, dtype=object) - s
        out.append((key, int((shifted**2).sum()), (shifted / n).astype(float) @ vectors / np.sqrt(values)))
    return n, values / (centred**2).sum() * n, out


def check(found, rows, tolerance=1e-8):
    n, explained, want = plain(rows)
    by_key = {}
    for r in found:
        by_key.setdefault(r.vec_id, []).append(r)
    assert {k: len(v) for k, v in by_key.items()} == {k: len(explained) * sum(w[0] == k for w in want) for k in {w[0] for w in want}}
    signs = np.ones(len(explained))
    for key, deviation, white in want:
        got = sorted(by_key[key], key=lambda r: r.component)
        assert {r.deviation for r in got} == {deviation} and {r.n for r in got} == {n}
        assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
        np.testing.assert_allclose([r.explained for r in got][:: len(got) // len(explained)], explained, rtol=1e-9)
        mine = np.array([r.whitened for r in got][:: len(got) // len(explained)])
        if key == want[0][0]:
            signs = np.where(mine * white < 0, -1.0, 1.0)
        np.testing.assert_allclose(mine * signs, white, atol=tolerance)


def test_query_against_a_dense_solver(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(queries.op12_embedding_whitening(spark, FOLDER).collect(), rows)


@pytest.fixture()
def made(spark, tmp_path):
    def build(rows, kind="double"):
        folder = str(tmp_path / f"t{len(rows)}")
        df = spark.createDataFrame([(k, v, 1, "c") for k, v in rows], f"vec_id bigint, embedding array<{kind}>, key int, x string")
        df.write.parquet(f"{folder}/embeddings.parquet")
        return queries.op12_embedding_whitening(spark, folder).collect()

    return build


def test_odd_rows(made):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 5).tolist()) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (7, rows[7][1]), (102, None), (103, []), (104, [1.0, None, 1.0, 1.0, 1.0])]
    rows += [(105, [1.0, float("nan"), 1.0, 1.0, 1.0]), (106, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (None, rng.normal(0, 1, 5).tolist())]
    check(made(rows), rows)
    assert {r.vec_id for r in made(rows + [(200, [1.0, 2.0]), (201, [3.0])])} == set(range(60)) | {100, 101, None}


def test_rank_of_two(made):
    rng = np.random.default_rng(6)
    rows = [(i, [float(a), float(b), float(a + b), 0.0]) for i, (a, b) in enumerate(rng.integers(-50, 50, (40, 2)))]
    assert {r.component for r in made(rows)} == {1, 2}
    check(made(rows + [(99, [1.0, 1.0, 2.0, 0.0])]), rows + [(99, [1.0, 1.0, 2.0, 0.0])])


def test_no_rows_one_point_equal_points(made):
    assert made([]) == [] and made([(1, [1.0, 2.0])]) == [] and made([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)]) == []


def test_far_from_the_origin_and_beyond_64_bits(made):
    rows = [(i, [2.0**40 + i, -(2.0**40) + i * i, 5.0]) for i in range(20)]
    check(made(rows), rows)
    with pytest.raises(Exception, match="beyond 64 bits"):
        made([(1, [2.0**45, 0.0]), (2, [-(2.0**45), 0.0]), (3, [0.0, 1.0])])


def test_partial_sums_in_two_levels(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = spark.createDataFrame([(i, rng.integers(-99, 99, 6).tolist()) for i in range(300)], "key bigint, x array<bigint>").repartition(7)
    one = whitening.fit_whitening(rows, 3)
    points = whitening.Points(rows)
    points.parts = whitening.DIRECT + 1
    block = rng.normal(0, 1, (6, 2))
    np.testing.assert_allclose(points.product(block), one.points.product(block), rtol=1e-12)


@pytest.mark.parametrize("d, k, shape", [(1, 16, "plain"), (40, 16, "plain"), (300, 16, "plain"), (64, 16, "equal"), (200, 8, "decay"), (64, 16, "low"), (400, 30, "plain")])
def test_solver(d, k, shape):
    rng = np.random.default_rng(d)
    m = rng.standard_normal((3 * d, d))
    if shape == "low":
        m = m[:, :5] @ rng.standard_normal((5, d))
    m = {"equal": np.eye(d), "decay": m * 0.9 ** np.arange(d)}.get(shape, m)
    a = m.T @ m / len(m)
    values, vectors, residuals, _, _ = whitening.leading_pairs(lambda b: a @ b, d, k)
    want = np.linalg.eigvalsh(a)[::-1][: min(k, d)]
    np.testing.assert_allclose(values, want, atol=1e-12 * want[0])
    assert residuals.max() <= 1e-11 * want[0] and np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_minres_shares_products():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    shifts = np.array([0.5, 3.0])
    right = rng.standard_normal((30, 2))
    x = whitening.minres(lambda b: a @ b - b * shifts, right, 90, 1e-12)
    np.testing.assert_allclose(a @ x - x * shifts, right, atol=1e-6)
