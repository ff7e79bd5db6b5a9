from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sendgate.llm.mixing import Mix, _draw, budgets, mix_sources
from sendgate.llm.queries import QUERIES, source_mix, source_tree, text_tokens
from sendgate.session import keep

SF_DIR = "/root/testdata/sf0.01"


def test_budgets_follow_weights():
    tokens = {("a", "x"): 1000, ("a", "y"): 1000, ("b", "x"): 1000, ("b", "y"): 1000}
    mix = Mix(weights={("a",): 3, ("b",): 1, ("a", "x"): 2}, share=0.25)
    assert budgets(tokens, mix) == {
        ("a", "x"): 500, ("a", "y"): 250, ("b", "x"): 125, ("b", "y"): 125
    }


def test_shortages_go_to_siblings_first():
    tokens = {("a", "x"): 10, ("a", "y"): 500, ("b", "x"): 1000}
    # a has 300 of 600: x can give 10, so y gives 290, and b is left alone.
    mix = Mix(share=600 / 1510)
    assert budgets(tokens, mix) == {("a", "x"): 10, ("a", "y"): 290, ("b", "x"): 300}
    # All of a is too little for its 500; the rest goes up, to b.
    tokens = {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 1000}
    assert budgets(tokens, Mix(share=1000 / 1110))[("b", "x")] == 890


def test_epochs_zero_weights_and_errors():
    tokens = {("a", "x"): 10, ("b", "x"): 30}
    assert budgets(tokens, Mix(epochs=3)) == {("a", "x"): 20, ("b", "x"): 20}
    assert budgets(tokens, Mix(weights={("a",): 0})) == {("a", "x"): 0, ("b", "x"): 30}
    assert budgets({}, Mix()) == {}
    for bad in (-1, float("inf"), None, float("nan")):
        with pytest.raises(ValueError, match="weight"):
            budgets(tokens, Mix(weights={("a",): bad}))


def test_rounding_leaves_nobody_short():
    # 19.2, 6.4 and 6.4 of 32: with 7, a weight of 1 would have more than a third of 20.
    tokens = {("a", "a"): 175, ("a", "b"): 38, ("a", "c"): 107}
    mix = Mix(weights={("a", "a"): 3}, share=0.1)
    assert budgets(tokens, mix) == {("a", "a"): 20, ("a", "b"): 6, ("a", "c"): 6}


paths = st.tuples(*[st.sampled_from("abc")] * 3)


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(paths, st.integers(1, 1000), min_size=1),
    st.dictionaries(st.lists(st.sampled_from("abc"), min_size=1, max_size=3).map(tuple), st.integers(0, 5)),
    st.integers(0, 30),
    st.integers(1, 3),
)
def test_budgets_add_up(tokens, weights, share, epochs):
    mix = Mix(weights=weights, share=share / 10, epochs=epochs)
    found = budgets(tokens, mix)
    assert found.keys() == tokens.keys()
    assert all(0 <= found[leaf] <= tokens[leaf] * epochs for leaf in tokens)
    allowed = {
        leaf for leaf in tokens if all(weights.get(leaf[:i], 1) > 0 for i in range(1, len(leaf) + 1))
    }
    most = sum(tokens[leaf] * epochs for leaf in allowed)
    assert sum(found.values()) == min(most, sum(tokens.values()) * share // 10)
    # Nobody is short while a sibling has more than its share: of open siblings, weights decide.
    for parent in {leaf[:2] for leaf in tokens}:
        leaves = [l for l in tokens if l[:2] == parent and weights.get(l, 1) > 0]
        open_ = [l for l in leaves if found[l] < tokens[l] * epochs]
        for l in open_:
            for other in leaves:
                scaled = found[other] * weights.get(l, 1)
                assert scaled <= (found[l] + 1) * weights.get(other, 1)


def brute(rows, mix):
    """Rows as (path, tokens, number, draws per epoch) -> Counter of (number, epoch)."""
    tokens = defaultdict(int)
    for path, n, _, _ in rows:
        if n:
            tokens[path] += n
    chosen = Counter()
    for path, budget in budgets(tokens, mix).items():
        left = budget
        for epoch in range(mix.epochs):
            for _, n, number, draws in sorted(
                (r for r in rows if r[0] == path and r[1]), key=lambda r: r[3][epoch]
            ):
                if left <= 0:
                    break
                chosen[number, epoch] += 1
                left -= n
    return chosen


def test_no_python_worker_for_the_plan(spark, monkeypatch):
    df = keep(spark.createDataFrame([("a", "some text")] * 20, "lang string, text string"), "docs")

    def refuse(*args, **kwargs):
        raise AssertionError("rows of Python objects are read by Python workers, which then stay")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    found = mix_sources(df, [F.col("lang")], F.length("text"), Mix(share=0.5))
    assert found.count() == 10


@pytest.mark.parametrize("rows_per_bucket", [100_000, 3])
def test_against_brute_force(spark, rows_per_bucket):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    mix = source_mix(1.0, 3)
    found = mix_sources(docs, source_tree(), text_tokens(), mix, rows_per_bucket=rows_per_bucket)
    assert found.columns == [*docs.columns, "epoch", "leaf_budget", "mix_tokens"]
    got = Counter((r.doc_id, r.epoch) for r in found.select("doc_id", "epoch").collect())
    content = F.xxhash64(*docs.columns).alias("content")
    drawn = docs.select("*", content).select(
        F.array(*source_tree()).alias("path"),
        text_tokens().alias("n"),
        "doc_id",
        F.array(*[_draw(mix.seed, F.lit(e), ["content"]) for e in range(3)]).alias("draws"),
    )
    rows = [(tuple(r.path), r.n, r.doc_id, r.draws) for r in drawn.collect()]
    assert got == brute(rows, mix)
    assert {epoch for _, epoch in got} == {0, 1, 2}


def test_query(spark):
    rows = QUERIES["op8_mixing"](spark, SF_DIR).collect()
    given_ = defaultdict(int)
    budget = {}
    for r in rows:
        given_[r.lang, r.source] += r.mix_tokens
        budget[r.lang, r.source] = r.leaf_budget
    for leaf, tokens in given_.items():
        assert tokens >= budget[leaf]
    assert max(Counter((r.doc_id, r.epoch) for r in rows).values()) == 1


def test_nulls_ties_and_clashing_names(spark):
    rows = [("a", None, "same text", 1)] * 9 + [(None, "s", "other text", 2), ("", "s", "third", 3)]
    rows += [("a", "s", None, 4), ("a", "s", "", 5)]
    df = spark.createDataFrame(rows, "lang string, source string, text string, Epoch int").coalesce(2)
    tree = [F.col("lang"), F.col("source")]
    found = mix_sources(df, tree, F.length("text"), Mix(share=1.0)).collect()
    assert len(found) == 11 and {r.epoch for r in found} == {0}
    half = mix_sources(df, tree, F.length("text"), Mix(share=0.4)).collect()
    texts = Counter(r.text for r in half)
    assert 1 <= texts["same text"] < 9 and set(texts) <= {"same text", "other text", "third"}
    assert mix_sources(df.limit(0), tree, F.length("text"), Mix()).count() == 0
    none = mix_sources(df, tree, F.length("text"), Mix(share=0.0))
    assert none.count() == 0
