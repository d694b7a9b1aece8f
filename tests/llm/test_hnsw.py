import numpy as np
import pytest

from siteatlas.llm import hnsw
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, rank string"


def exact(rows, queries, k):
    out = {}
    for q, x in queries:
        near = sorted((float(np.sqrt(((np.float32(y).astype(float) - np.float32(x).astype(float)) ** 2).sum())), i) for i, y in rows if i != q and len(y) == len(x))
        out[q] = near[:k]
    return out


def run(spark, rows, queries, **options):
    make = lambda v: spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], "r") for i, x in v], SCHEMA)
    graphs = hnsw.index(make(rows), **options)
    out = {}
    for r in hnsw.nearest(graphs, make(queries)).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("shard", [100, 4096])
def test_recall(spark, shard):
    rng = np.random.default_rng(shard)
    centers = rng.normal(size=(12, 24))
    rows = [(i, centers[i % 12] + 0.3 * rng.normal(size=24)) for i in range(1500)]
    queries = rows[::25]
    found, want = run(spark, rows, queries, shard=shard), exact(rows, queries, 10)
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, near in found.items():
        assert near == sorted(near) and len(near) == 10
        true = dict(exact(rows, [(q, dict(rows)[q])], 1500)[q][::-1] and [(i, s) for s, i in exact(rows, [(q, dict(rows)[q])], 1500)[q]])
        assert all(s == pytest.approx(true[i], abs=1e-12) for s, i in near)


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect() if r.embedding is not None]
    queries = [r for r in rows if r[0] % 100 == 0]
    want = exact(rows, queries, 10)
    found = {}
    for r in hnsw.nearest(hnsw.index(vectors), vectors.filter("vec_id % 100 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[q] & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0]), (2, [1, 0]), (3, [0, 1]), (3, [0, 1]), (4, None), (5, [0, 0]), (6, [nan, 1]), (7, [inf, 1]), (8, [None, 1]), (9, [1, 2, 3]), (None, [1, 1]), (10, [])]
    queries = [(1, [1, 0]), (4, None), (5, [0, 0]), (3, [0, 1]), (9, [1, 2, 3])]
    found = run(spark, rows, queries)
    assert found == {1: [(0.0, 2), (pytest.approx(2**0.5), 3)], 3: [(pytest.approx(2**0.5), 1), (pytest.approx(2**0.5), 2)]}
    assert run(spark, [], queries) == {} and run(spark, rows, []) == {}


def test_equal_vectors_go_by_id(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(700)] + [(i, rng.normal(size=3)) for i in range(700, 1000)]
    found = run(spark, rows, [(0, [1.0, 2.0, 3.0]), (500, [1.0, 2.0, 3.0])], shard=200)
    assert [i for _, i in found[0]] == list(range(1, 11)) and [i for _, i in found[500]] == list(range(10))


def test_an_id_of_many_rows_is_one_before_shards_are_dealt(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3)) for i in range(300)]
    rows += [(7, np.array([9.0, 9.0, float(i)])) for i in range(600)]
    rows[7] = (7, np.array([-9.0, 9.0, 0.0]))  # the smallest by its components counts
    made = spark.createDataFrame([(i, [float(c) for c in x], "r") for i, x in rows], SCHEMA)
    dealt = hnsw._vectors(made, "vec_id", "embedding")
    assert dealt.count() == 300
    once = [r for r in rows[:300]]
    found, want = run(spark, rows, [once[7], once[8]], shard=5000), exact(once, [once[7], once[8]], 10)
    assert {q: [i for _, i in near] for q, near in found.items()} == {q: [i for _, i in near] for q, near in want.items()}


def test_no_neighbour_in_another_shard_is_missed(spark):
    rng = np.random.default_rng(8)
    rows = [(i, 100 + rng.normal(size=64)) for i in range(1500)] + [(i, 100 + np.ones(64)) for i in range(1500, 1550)]
    rows += [(i, rng.normal(size=7)) for i in range(1550, 1600)]
    queries = [(-i, 100 + rng.normal(size=64)) for i in range(1, 61)] + [(1500, 100 + np.ones(64)), (1550, rows[1550][1]), (-100, rng.normal(size=7)), (-101, rng.normal(size=5))]
    make = lambda v: spark.createDataFrame([(i, [float(c) for c in x], "r") for i, x in v], SCHEMA)
    graphs = hnsw.index(make(rows), shard=160)
    shards = 10
    home = {r.id: r.home for r in make(rows + queries).selectExpr("vec_id AS id", f"pmod(xxhash64(vec_id), {shards}) AS home").collect()}
    want = {q: [i for _, i in near] for q, near in exact(rows, queries, 10).items() if near}
    found = {}
    for r in hnsw.nearest(graphs, make(queries), ef=12).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == set(want)
    for q, near in want.items():
        assert len(found[q]) == len(near) and not [i for i in near if home[i] != home[q] and i not in found[q]]


def shuffled(df):
    """Bytes of all exchanges of the plan that ran."""

    def of(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return of(plan.executedPlan())
        if kind in ("ShuffleQueryStageExec", "ResultQueryStageExec"):
            return of(plan.plan())
        own = plan.metrics().apply("dataSize").value() if kind == "ShuffleExchangeExec" else 0
        return own + sum(of(plan.children().apply(i)) for i in range(plan.children().size()))

    df.collect()
    return of(df._jdf.queryExecution().executedPlan())


def test_what_is_shuffled_does_not_grow_with_the_square(spark):
    rng = np.random.default_rng(9)
    moved = []
    for n in (2000, 4000):
        made = spark.createDataFrame([(i, x.tolist(), "r") for i, x in enumerate(rng.normal(size=(n, 32)))], SCHEMA)
        moved.append(shuffled(hnsw.nearest(hnsw.index(made, shard=40), made.filter("vec_id % 2 = 0"))))
    assert 0 < moved[1] < 2.5 * moved[0]
