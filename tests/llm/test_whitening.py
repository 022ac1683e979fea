import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import whitening
from tidegate.llm.queries import op13_embedding_whitening
from tidegate.llm.whitening import Centre, fit, jacobi_davidson, minres


def plain(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    once = np.unique(x, axis=0)
    n, s = len(once), once.sum(axis=0)
    y = once - s / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    return n, ((n * x.astype(object) - s) ** 2).sum(axis=1).tolist(), values[::-1], (x - s / n) @ axes[:, ::-1], (y * y).sum() / n


def test_against_dense(spark, tmp_path):
    rng = np.random.default_rng(3)
    v = (rng.standard_normal((400, 40)) * np.linspace(0.3, 2, 40)).astype(np.float32)
    rows = [(k, r.tolist()) for k, r in enumerate(v)] + [(1000 + k, v[0].tolist()) for k in range(200)]
    bad = [(5, None), (6, [float("nan")] * 40), (7, [float("inf")] * 40), (8, [None] * 40), (9, [1.0]), (10, [])]
    spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {(r["vec_id"], r["component"]): r for r in op13_embedding_whitening(spark, str(tmp_path)).collect()}
    n, deviation, values, projected, trace = plain([r[1] for r in rows])
    assert n == 400 and len(got) == 600 * 16
    for c in range(16):
        white = np.array([got[k, c + 1]["whitened"] for k, _ in rows])
        want = projected[:, c] / np.sqrt(values[c])
        assert min(np.abs(white - want).max(), np.abs(white + want).max()) < 1e-9
        assert abs(got[0, c + 1]["explained"] / (values[c] / trace) - 1) < 1e-12
    assert [got[k, 1]["deviation"] for k, _ in rows] == deviation
    assert {r["n"] for r in got.values()} == {400} and max(r["identity_error"] for r in got.values()) < 1e-10


def test_solver_on_close_and_equal_values():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((150, 150)))
    values = np.concatenate([[9, 9, 9, 5, 5 - 1e-9], np.linspace(4, 0.1, 145)])
    a = (q * values) @ q.T
    passes = []
    found, vectors = jacobi_davidson(lambda b: passes.append(b.shape[1]) or a @ b, 150, 16)
    assert np.abs(found - values[:16]).max() < 1e-12 and np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-11
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13 and len(passes) < 100


def test_solver_cuts_its_search_space_back():
    a = np.diag(np.linspace(1, 2, 400))
    found, _ = jacobi_davidson(lambda b: a @ b, 400, 6, block=4, most_search=24)
    assert np.abs(found - np.linspace(1, 2, 400)[::-1][:6]).max() < 1e-12


def test_minres_solves():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a, right, shifts = a + a.T, rng.standard_normal((30, 3)), np.array([0.1, 2.0, -3.0])
    t = minres(lambda b: a @ b, shifts, lambda x: x, right, 60)
    assert np.abs(a @ t - t * shifts - right).max() < 1e-6


def test_centre_is_exact():
    x = np.array([[10**6 + 1, 10**6], [10**6, 10**6], [10**6, 5 + 10**6]])
    c = Centre(3, x.sum(axis=0).tolist())
    assert c.deviations(x).to_pylist() == [4 + 25, 1 + 25, 1 + 100]
    wide = np.array([[3 * 10**18], [-3 * 10**18], [7], [10**9]])
    c = Centre(4, [sum(wide[:, 0].tolist())])
    assert c.deviations(wide).to_pylist() == [None, None, (4 * 7 - 10**9 - 7) ** 2, (3 * 10**9 - 7) ** 2]


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_nothing_to_learn(spark, vectors):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    model = fit(df)
    rows = model.apply(df).collect()
    assert len(model.values) == 0 and all(r["whitened"] == [] and r["deviation"] == 0 for r in rows)
    assert len(rows) == sum(v is not None and len(v) > 0 for v in vectors)


def test_columns_and_huge_entries(spark):
    rows = [(1, [0.0, 1e17]), (2, [1.0, 4e16]), (2, [2.0, -4e16]), (None, [5.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"row": F.lit("r"), "X": F.lit("x"), "N": F.lit("n"), "Whitened": F.lit("w")})
    model = fit(df)
    got = model.apply(df).collect()
    assert [r["vec_id"] for r in got] == [2, 2, None] and all(r["row"] == "r" and r["X"] == "x" and r["n"] == 3 for r in got)
    assert model.centre.n == 3 and got[0]["deviation"] is None and whitening.COMPONENTS == 16
