import math

import numpy as np
import pytest

from sendgate.llm.components import components
from sendgate.llm.embedding_dedup import Grid, _spanning, near_duplicates
from sendgate.llm.queries import QUERIES

SMALL = Grid(block=16, leaf=4, spread=64, sample=50)


def roots(n, pairs):
    at = list(range(n))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(ids, vectors, threshold=0.9):
    links = [0] * len(ids)
    pairs = []
    good = [
        i
        for i, v in enumerate(vectors)
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    if good:
        x = np.array([vectors[i] for i in good], float)
        norm = np.linalg.norm(x, axis=1)
        similar = (x @ x.T) / np.outer(norm, norm) >= threshold
        np.fill_diagonal(similar, False)
        for i, n in zip(good, similar.sum(axis=1), strict=True):
            links[i] = int(n)
        pairs = [(good[a], good[b]) for a, b in np.argwhere(similar)]
    root = roots(len(ids), pairs)
    least = {r: min(ids[i] for i in range(len(ids)) if root[i] == r) for r in set(root)}
    return sorted(
        (ids[i], links[i], least[root[i]], ids[i] == least[root[i]]) for i in range(len(ids))
    )


def run(spark, ids, vectors, **options):
    kind = options.pop("kind", "float")
    df = spark.createDataFrame(
        [(i, v, "x") for i, v in zip(ids, vectors, strict=True)],
        f"vec_id long, embedding array<{kind}>, Kept string",
    ).repartition(4)
    found = near_duplicates(df, **options)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("grid", [SMALL, None])
def test_clusters_against_brute_force(spark, grid):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(40, 12))
    rows = np.concatenate(
        [
            centres[draw.integers(0, 40, 200)] + 0.25 * draw.normal(size=(200, 12)),
            centres[0] + 0.1 * draw.normal(size=(120, 12)),
            draw.normal(size=(80, 12)),
        ]
    ).astype(np.float32)
    rows *= draw.uniform(0.1, 9, size=(400, 1)).astype(np.float32)
    ids = draw.permutation(400).tolist()
    vectors = rows.tolist()
    assert run(spark, ids, vectors, grid=grid) == brute(ids, vectors)


def test_invalid_and_repeated(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [1.0, 0.0]]
    vectors += [[2.0, 0.0], [-1.0, 0.0], [1e200, 1e190], [1e-200, 0.0]]
    ids = [9, 8, 7, 6, 5, 4, 4, 3, 2, 1, 0]
    got = run(spark, ids, vectors, kind="double")
    link = {1, 3, 4, 0}
    for i, n, component, kept in got:
        assert (n, component) == ((4, 0) if i in link else (0, i))
        assert kept == (i == component)
    assert len(got) == len(ids)
    # Vectors link with those of their own length.
    got = run(spark, [1, 2, 3, 4, 5], [[1.0, 0.0], [1.0, 0.1], [1.0], [1.0], [2.0, 0.0]])
    assert [row[1] for row in got] == [2, 2, 1, 1, 2]


def test_every_length_against_brute_force(spark):
    draw = np.random.default_rng(3)
    ids = draw.permutation(240).tolist()
    vectors: list = [None] * 240
    expected = []
    for places, length in ((range(0, 100), 6), (range(100, 180), 9), (range(180, 240), 1)):
        centres = draw.normal(size=(8, length))
        rows = centres[draw.integers(0, 8, len(places))] + 0.2 * draw.normal(size=(len(places), length))
        rows = rows.astype(np.float32).tolist()
        for place, row in zip(places, rows, strict=True):
            vectors[place] = row
        expected += brute([ids[place] for place in places], rows)
    assert run(spark, ids, vectors, grid=SMALL) == sorted(expected)


def test_threshold_is_exact(spark):
    vectors = [[1.0, 0.0], [0.9, math.sqrt(1 - 0.81) - 1e-12], [0.9, math.sqrt(1 - 0.81) + 1e-9]]
    got = run(spark, [1, 2, 3], vectors, kind="double")
    assert [row[1] for row in got] == [1, 2, 1]


def test_empty(spark):
    assert run(spark, [], []) == []
    assert run(spark, [1, 2], [None, None]) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = sorted(map(tuple, QUERIES["op9_embedding_dedup"](spark, sf_dir).collect()))
    assert got == brute([r.vec_id for r in table], [r.embedding for r in table])


def test_spanning():
    draw = np.random.default_rng(2)
    linked = draw.random((30, 20)) < 0.05
    rows, columns = _spanning(linked)
    expected = roots(50, [(a, 30 + b) for a, b in np.argwhere(linked)])
    assert rows.tolist() == expected[:30]
    assert [c if c < 30 else None for c in columns] == [
        e if e < 30 else None for e in expected[30:]
    ]


def test_components(spark):
    draw = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 300, (200, 2))]
    pairs += [(i, i + 1) for i in range(300, 400)] + [(500, i) for i in range(501, 700)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    expected = roots(700, pairs)
    linked = {i for pair in pairs if pair[0] != pair[1] for i in pair}
    assert got == {i: expected[i] for i in linked}
    assert components(df.limit(0)).count() == 0
