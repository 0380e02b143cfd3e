import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import vector_search as V

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score string"


def make(spark, seed, n=900, d=16):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, d))
    x = centre[rng.integers(0, 12, n)] + 0.5 * rng.normal(size=(n, d))
    x[n // 2 : n // 2 + 80] = x[0]  # many equal vectors
    rows = [(i, [float(np.float32(c)) for c in x[i]], 0, "v", "s") for i in range(n)]
    odd = [(n, None, 0, "", ""), (n + 1, [None] * d, 0, "", ""), (n + 2, [float("nan")] * d, 0, "", ""), (n + 3, [float("inf")] * d, 0, "", ""), (n + 4, [1.0], 0, "", ""), (None, [1.0] * d, 0, "", ""), (20 * n, [0.0] * d, 0, "", "")]
    return spark.createDataFrame(rows + odd, SCHEMA), rows, odd


def brute(rows, whole, k=20):
    ids = np.array([r[0] for r in rows])
    size = max(len(r[1]) for r in rows)
    x = np.array([[*r[1], *[0.0] * (size - len(r[1]))] for r in rows])
    x = np.floor(64 * x) if whole else x
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[ids == ids[i]] = -np.inf
        order = np.lexsort((ids, -s))[:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order if np.isfinite(s[j])]
    return out


def collected(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], float(r["score"])))
    return {q: [(i, s) for _, i, s in sorted(found)] for q, found in out.items()}


@pytest.fixture(params=[4096, 60])
def small_blocks(request, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", request.param)
    monkeypatch.setattr(V, "BATCH", 17)


def test_mtree_is_exact(spark, small_blocks):
    table, rows, odd = make(spark, 1)
    want = brute([*rows, odd[4], odd[-1]], True)
    assert collected(V.mtree_search(table, F.col("vec_id") % 20 == 0)) == want


def test_stable_projections_recall(spark, small_blocks):
    table, rows, odd = make(spark, 2)
    want, found = brute([*rows, odd[4]], False), collected(V.stable_projection_search(table, F.col("vec_id") % 20 == 0))
    assert found.keys() == want.keys() and all(len(f) == 20 for f in found.values())
    score = lambda q: [s for _, s in want[q]]
    recall = np.mean([sum(s >= score(q)[-1] - 1e-9 for _, s in found[q]) / 20 for q in want])
    assert recall >= 0.95
    for q in want:
        assert [s for _, s in found[q]] == sorted((s for _, s in found[q]), reverse=True)


def test_few_and_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [0.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for search in (V.mtree_search, V.stable_projection_search):
        found = collected(search(table, F.col("vec_id") % 20 == 0))
        assert [i for i, _ in found[0]] == [1, 2, 20] and len(found[20]) == 4
        assert search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_quantile_of_chi_square():
    assert V.chi_square_quantile(0.95, 2) == pytest.approx(5.9915, abs=1e-3)
    assert V.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_large_norms_lengths_and_vectors_of_one_id(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=6) * 1e200]) for i in range(60)] + [(i, [float(c) for c in rng.normal(size=4)]) for i in range(60, 120)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    scaled = brute([(i, [c * 1e-100 for c in v]) for i, v in rows], False)
    found = collected(V.stable_projection_search(table, F.col("vec_id") % 20 == 0))
    assert {q: [i for i, _ in f] for q, f in found.items()} == {q: [i for i, _ in f] for q, f in scaled.items()}
    assert found[0][0][1] == float("inf") and all(np.isfinite(s) for _, s in found[60])
    exact = collected(V.mtree_search(table, F.col("vec_id") % 20 == 0))
    assert len(exact) == 6 and all(len(f) == 20 for f in exact.values()) and exact[0][0][1] == float((1 << 63) - 1)

    twice = [(0, [1.0, 0.0]), (0, [-1.0, 0.0]), (1, [5.0, 0.0]), (2, [-5.0, 0.0]), (3, []), (4, [2.0])]
    for order in (twice, twice[::-1]):
        table = spark.createDataFrame(order, "vec_id long, embedding array<double>")
        assert collected(V.stable_projection_search(table, F.col("vec_id") % 20 == 0)) == {0: [(2, 5.0), (4, -2.0), (1, -5.0)]}
        assert collected(V.mtree_search(table, F.col("vec_id") % 20 == 0, scale=1)) == {0: [(2, 5.0), (3, 0.0), (4, -2.0), (1, -5.0)]}
    empty = spark.createDataFrame([(0, []), (1, [])], "vec_id long, embedding array<double>")
    assert V.stable_projection_search(empty, F.col("vec_id") % 20 == 0).count() == 0
    assert collected(V.mtree_search(empty, F.col("vec_id") % 20 == 0)) == {0: [(1, 0.0)]}


def test_queries_visit_a_page_of_an_m_tree_together(monkeypatch):
    """Where bounds spare little, a page is read a few times for all queries, not for a few queries at a time; results are exact."""
    rng = np.random.default_rng(5)
    x, ids = np.floor(rng.normal(size=(2000, 16)) * 64), np.arange(2000)
    calls = []
    verify = V.verify

    def counted(best, rows, *rest):
        calls.append(len(rows))
        verify(best, rows, *rest)

    monkeypatch.setattr(V, "verify", counted)
    search = V.MTree(V.Space(float((x * x).sum(1).max())), page=64).index(x, ids)
    asked = np.arange(0, 2000, 4)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    want = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=-1)[:, :10]
    known = np.take_along_axis(scores, want, 1)
    for bound in (np.full(len(asked), -np.inf), known[:, -1].copy()):
        calls.clear()
        found = search(x[asked], asked, bound, 10)
        assert (found.ids == want).all() and (found.scores == known).all()
        assert len(calls) < 500


def test_best_of_many_ties():
    rng = np.random.default_rng(6)
    scores = rng.integers(0, 4, (50, 300)).astype(float)
    ids = rng.permutation(300)
    best = V.Best(50, 7)
    for part in np.array_split(np.arange(300), 9):
        best.update(np.arange(50), scores[:, part], ids[part])
    want = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=-1)[:, :7]
    assert (best.ids == ids[want]).all() and (best.scores == np.take_along_axis(scores, want, 1)).all()
