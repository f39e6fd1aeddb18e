import numpy as np
import pytest
from pyspark.sql import functions as F

from rowgate.llm import nn_descent as n

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, queries, top):
    ids = sorted(vectors)
    matrix = np.array([vectors[i] for i in ids], np.float64)
    out = {}
    for q in queries:
        scores = [float(sum(x * y for x, y in zip(row, vectors[q], strict=True))) for row in matrix]
        order = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != q)
        out[q] = [(i, -s) for s, i in order[:top]]
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 24))
    rows = []
    for i in range(3000):
        v = centres[i % 6] + rng.normal(size=24) * (0.3 if i % 2 else 1.0)
        rows.append((i, [float(np.float32(x)) for x in v * rng.uniform(0.8, 1.2)], 0))
    found = n.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    vectors = {r[0]: r[1] for r in rows}
    truth = brute(vectors, range(0, 3000, 50), n.TOP)
    mine = {}
    for r in found:
        mine.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q, own in truth.items():
        got = sorted(mine[q])
        assert [g[0] for g in got] == list(range(1, n.TOP + 1))
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        for _, i, score in got:
            assert abs(score - float(np.dot(vectors[i], vectors[q]))) < 1e-9
        hits += len({g[1] for g in got} & {i for i, _ in own})
    assert hits / (n.TOP * len(truth)) >= 0.9


def test_few_vectors_ties_copies_and_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 0) for i in range(40)] + [
        (40, [2.0, 0.0], 0), (41, None, 0), (42, [0.0, 0.0], 0), (43, [1.0, nan], 0), (44, [inf, 1.0], 0),
        (45, [1.0, None], 0), (None, [1.0, 1.0], 0), (46, [3.0], 0), (0, [1.0, 0.0], 0), (60, [0.0, -1.0], 0),
    ]
    found = n.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, top=5).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got[0] == [(46, 3.0), (40, 2.0), (1, 1.0), (2, 1.0), (3, 1.0)]
    assert got[20] == [(46, 3.0), (40, 2.0), (0, 1.0), (1, 1.0), (2, 1.0)]
    assert got[40] == [(46, 6.0), (0, 2.0), (1, 2.0), (2, 2.0), (3, 2.0)]
    assert got[60] == [(i, 0.0) for i in range(5)]


def test_fewer_candidates_than_asked_for_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0), (20, [0.5, 0.5], 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = n.nearest(frame, F.col("vec_id") % 20 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found.collect()) == [
        (0, 1, 1), (0, 2, 20), (20, 1, 0), (20, 2, 1),
    ]
    assert n.nearest(frame.limit(1), F.lit(True)).collect() == []
    assert n.nearest(frame.limit(0), F.lit(True)).collect() == []


def test_descent_reaches_the_recall_from_small_random_blocks(spark, monkeypatch):
    """Blocks of 64 of 2,000 vectors hold a few per cent of the neighbours; rounds find the rest."""
    monkeypatch.setattr(n, "BLOCK", 64)
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=12)], 0) for i in range(2000)]
    found = n.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    vectors = {r[0]: r[1] for r in rows}
    truth = brute(vectors, range(0, 2000, 50), n.TOP)
    mine = {}
    for r in found:
        mine.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(mine[q] & {i for i, _ in own}) for q, own in truth.items())
    assert hits / (n.TOP * len(truth)) >= 0.9


@pytest.mark.parametrize("kind", ["lengths", "one long vector"])
def test_recall_on_vectors_of_unlike_lengths(spark, kind):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(3000, 64))
    if kind == "lengths":
        matrix *= np.exp(rng.normal(size=(3000, 1)))
    else:
        matrix[7] *= 1e6
    matrix = matrix.astype(np.float32).astype(np.float64)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(matrix)], SCHEMA)
    mine = {}
    for r in n.nearest(frame, F.col("vec_id") % 60 == 0).collect():
        mine.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 60):
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        hits += len(mine[q] & set(np.argsort(-scores)[: n.TOP].tolist()))
    assert hits / (n.TOP * 50) >= 0.95


def test_a_query_scores_only_what_its_own_pool_leads_to(spark):
    """The same vectors are asked for whether a query searches alone or with all others."""
    rng = np.random.default_rng(9)
    matrix = rng.normal(size=(3000, 32)).astype(np.float32)
    matrix /= 1.001 * np.linalg.norm(matrix, axis=1).max()
    near = np.argsort(-(matrix @ matrix.T), axis=1)[:, 1 : n.NEIGHBOURS + 1]
    nodes = spark.createDataFrame(
        [(i, v.tobytes(), float(np.linalg.norm(v))) for i, v in enumerate(matrix)], "node long, vec binary, length double"
    )
    links = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(near)], "node long, others array<long>")
    queries = nodes.selectExpr("node as query", "node as home", "vec")

    def asked(some):
        rows = n.asked_of(n.first_pools(nodes, some), links, 3).collect()
        out = {}
        for r in rows:
            assert (n.cell_of(np.array(r.nodes), 3) == r.cell).all()
            out.setdefault(r.query, set()).update(r.nodes)
        return out

    alone, together = asked(queries.filter("query = 20")), asked(queries.filter("query % 20 = 0"))
    assert len(together) == 150 and together[20] == alone[20]
    assert max(map(len, together.values())) <= n.EXPANDED * n.NEIGHBOURS
