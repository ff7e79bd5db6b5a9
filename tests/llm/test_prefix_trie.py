"""The prefix trie against plain Python over rebuilt conversations."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sendgate.llm import prefix_trie as P, scans

TURNS = "conv_id long, turn long, role string, text string"
RECIPES = "conv_id long, base_id long, head long"


def brute(turns, recipes):
    stored = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            key = (turn is not None, turn or 0)
            stored[conv].append((key, role or "", text or ""))
    stored = {conv: [x[1:] for x in sorted(rows)] for conv, rows in stored.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for conv, base, head in recipes:
        if conv is None:
            continue
        head = max(head or 0, 0)
        rebuilt = tuple(stored.get(base, [])[:head] + stored.get(conv, [])[head:])
        for depth in range(len(rebuilt) + 1):
            members[rebuilt[:depth]].append(conv)
        ends[rebuilt].append(conv)
    found = {}
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        parent = min(members[node[:-1]]) if node else None
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        digest = hashlib.sha256(listed.encode()).hexdigest()
        found[min(convs), len(node)] = (parent, len(convs), len(children), len(leaves), saved, digest)
    return found


def built(spark, turns, recipes, **options):
    trie = P.prefix_trie(
        spark.createDataFrame(turns, TURNS), spark.createDataFrame(recipes, RECIPES), **options
    )
    nodes = trie.nodes.join(P.ends_digest(trie.ends), ["conv_id", "depth"], "left").collect()
    empty = hashlib.sha256().hexdigest()
    found = {
        (r.conv_id, r.depth): (
            r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_bytes, r.ends_sha256 or empty,
        )
        for r in nodes
    }
    assert len(found) == len(nodes)
    return found, nodes


def small_case(seed, convs=40, longest=12):
    draw = random.Random(seed)
    turns = []
    for conv in range(-3, convs):
        for turn in range(draw.randrange(longest)):
            text = draw.choice(["", None, "a", "b", "é" * 3, "long " * 50])
            turns.append((conv, draw.choice([turn, turn, None, 2]), draw.choice(["user", "bot", None]), text))
    recipes = [(c, draw.choice([c, c - c % 5, 1, 999, None]), draw.choice([0, 1, 3, 8, None, -2, 100]))
               for c in range(-5, convs + 5)]
    draw.shuffle(turns)
    return turns, recipes


@pytest.mark.parametrize("seed", [1, 2])
def test_random_recipes(spark, seed):
    turns, recipes = small_case(seed)
    turns += [(None, 0, "user", "nobody")]
    recipes += [(None, 1, 2)]
    assert built(spark, turns, recipes)[0] == brute(turns, recipes)


def test_equal_conversations_and_deep_chains(spark):
    turns = [(c, t, "user", f"{t}") for c in range(60) for t in range(5)]
    # Each one leaves the path of the one before it a turn later.
    turns += [(1000 + c, t, "bot", f"{min(t, c) if t <= c else -c}") for c in range(20) for t in range(25)]
    recipes = [(c, None, 0) for c in [*range(60), *range(1000, 1020)]]
    found, nodes = built(spark, turns, recipes)
    assert found == brute(turns, recipes)
    ends = next(r for r in nodes if (r.conv_id, r.depth) == (0, 5))
    assert (ends.turn_conv_id, ends.turn_place) == (0, 5)


def test_long_conversation_spans_blocks(spark, monkeypatch):
    monkeypatch.setattr(scans, "ROWS_PER_BLOCK", 7)
    turns = [(1, t, "user", f"x{t % 3}") for t in range(150)] + [(2, t, "user", f"x{t % 3}") for t in range(90)]
    recipes = [(1, 2, 30), (2, 1, 120), (3, 1, 1000), (4, 1, 149)]
    assert built(spark, turns, recipes)[0] == brute(turns, recipes)


def test_empty_tables(spark):
    assert built(spark, [], [])[0] == {}
    assert built(spark, [], [(7, 5, 3), (5, 5, 0)])[0] == brute([], [(7, 5, 3), (5, 5, 0)])
    assert built(spark, [(1, 0, "a", "b")], [])[0] == {}


def test_collisions_are_found_and_mended(spark, monkeypatch):
    """Powers of one tell no order apart; another seed is taken as soon as two prefixes collide."""
    turns = [(c, t, "user", text) for c, texts in ((1, "ab"), (2, "ba"), (3, "abc")) for t, text in enumerate(texts)]
    recipes = [(1, 1, 0), (2, 2, 0), (3, 1, 2)]
    bases, seeds = P._bases, []
    monkeypatch.setattr(P, "_bases", lambda seed: seeds.append(seed) or (bases(seed) if seed else [1, 1, 1]))
    assert built(spark, turns, recipes)[0] == brute(turns, recipes)
    assert set(seeds) == {0, 1}


def test_extra_columns(spark):
    turns = spark.createDataFrame([(1, 0, "a", "b")], TURNS).withColumns(
        {"pos": F.lit("x"), "f0": F.lit(None), "depth": F.lit(-1), "_block": F.lit(3)}
    )
    recipes = spark.createDataFrame([(1, 1, 0)], RECIPES).withColumns({"n": F.lit(9), "k": F.lit(1)})
    assert [r.depth for r in P.prefix_trie(turns, recipes).nodes.orderBy("depth").collect()] == [0, 1]
