import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sendgate.llm.ann import Index, _survivors, nearest_neighbours
from sendgate.llm.queries import QUERIES



def exact(ids, vectors, k=20):
    """Per query row its k nearest as (id, score), by brute force."""
    x = np.array(vectors, float)
    found = {}
    for i, query in enumerate(ids):
        if query is not None and query % 20 == 0:
            scores = x @ x[i]
            order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-scores[j], ids[j]))
            found.setdefault(query, []).append([(ids[j], scores[j]) for j in order[:k]])
    return found


def recall(rows, expected, k=20):
    got = {}
    for row in rows:
        got.setdefault(row.query_id, []).append(row)
    hits = wanted = 0
    assert set(got) == set(expected)
    for query, (best,) in expected.items():
        mine = sorted(got[query], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(best) + 1))
        keys = [(-r.score, r.vec_id) for r in mine]
        assert keys == sorted(keys)
        hits += len({r.vec_id for r in mine} & {i for i, _ in best})
        wanted += len(best)
    return hits / wanted


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_of_query(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = QUERIES["op2_ann"](spark, sf_dir).collect()
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table}
    for row in rows:
        assert row.query_id != row.vec_id
        assert math.isclose(
            row.score, vectors[row.query_id] @ vectors[row.vec_id], rel_tol=1e-12, abs_tol=1e-15
        )
    expected = exact([r.vec_id for r in table], [r.embedding for r in table])
    assert recall(rows, expected) >= 0.9


def run(spark, rows, kind="double", **options):
    df = spark.createDataFrame(
        rows, f"vec_id long, embedding array<{kind}>, row string, score string"
    ).repartition(3)
    return nearest_neighbours(df, F.col("vec_id") % 20 == 0, **options).collect()


def test_inner_products_of_uneven_lengths(spark):
    """Large groups of near copies and vectors of very different lengths; small chunks."""
    draw = np.random.default_rng(1)
    x = draw.normal(size=(900, 10))
    x[:300] = x[0] + 0.01 * draw.normal(size=(300, 10))
    x *= draw.uniform(0.01, 5, size=(900, 1))
    ids = list(range(900))
    rows = [(i, v, "a", "b") for i, v in zip(ids, x.tolist(), strict=True)]
    found = run(spark, rows, index=Index(chunk=64, queries=16, columns=4))
    assert recall(found, exact(ids, x)) >= 0.9


def test_every_length_and_any_size_of_components(spark):
    """Two embedding lengths, components whose squares overflow or vanish, ids beyond 2**53."""
    draw = np.random.default_rng(2)
    few = Index(share=1.0)
    for size in (1.0, 1e25, 1e-30):
        small, large = size * draw.normal(size=(120, 6)), size * draw.normal(size=(80, 9))
        ids = list(range(200))
        rows = [(i, v, "a", "b") for i, v in zip(ids, [*small.tolist(), *large.tolist()], strict=True)]
        found = run(spark, rows, index=few)
        for part, first in ((small, 0), (large, 120)):
            names = ids[first : first + len(part)]
            own = [r for r in found if r.query_id in names]
            assert {r.vec_id for r in own} <= set(names)
            assert recall(own, exact(names, part)) >= 0.9
    base = 20 * 2**54
    rows = [(base, [1.0, 0.0], "a", "b")]
    rows += [(base + i, [1.0, 1.0], "a", "b") for i in (7, 3, 5, 1)]
    found = run(spark, rows, k=2)
    assert [(r.rank, r.vec_id - base) for r in sorted(found, key=lambda r: r.rank)] == [(1, 1), (2, 3)]


def test_all_candidates_if_fewer(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (0, [3.0, 0.0])]
    bad = [(40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [None, 1.0]), (120, [1.0])]
    rows += [*bad, (None, [0.5, 0.5])]
    found = run(spark, [(*r, "a", None) for r in rows])
    by_query = {}
    for row in found:
        by_query.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    assert sorted(by_query) == [0, 20]  # 120 is the only one of its length
    assert sorted(by_query[20]) == [(1, 1, 1.0), (2, 2, 1.0), (3, None, 0.5), (4, 0, 0.0), (5, 0, 0.0)]
    assert len(by_query[0]) == 10
    assert sum(score == 3.0 for _, _, score in by_query[0]) == 4


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], "a", "b"), (None, [2.0], "a", "b")]) == []
    assert run(spark, [(20, [1.0], "a", "b")]) == []


def test_tests_rarely_abandon_near_vectors():
    draw = np.random.default_rng(2)
    queries, candidates = draw.normal(size=(50, 64)), draw.normal(size=(500, 64))
    far = ((queries[:, None] - candidates[None]) ** 2).sum(-1)
    bounds = np.sort(far, axis=1)[:, 20]
    one, two = _survivors(queries.astype("f4"), bounds, candidates.astype("f4"), Index())
    kept = set(zip(one.tolist(), two.tolist(), strict=True))
    near = set(map(tuple, np.argwhere(far <= bounds[:, None])))
    assert kept <= near and len(kept) >= 0.97 * len(near)
