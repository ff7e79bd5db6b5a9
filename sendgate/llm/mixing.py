"""Mixing sources to target weights: hierarchical budgets and seeded token prefixes.

Leaves are paths in a tree of domain, language and source. Target weights propagate from the
root: a node's budget is divided among its children by their weights. A leaf can give at most
its tokens times the number of epochs allowed. What a child cannot take goes to its siblings
first, in proportion to their weights, and only what they cannot take either goes up to the
parent's siblings. What rounding down leaves goes to whoever stays furthest behind its weight with
one more token, so integer budgets add up exactly, and none is a token short beside a sibling.

A leaf that has to give more than all of its tokens gives whole epochs and a prefix of one more.
In each epoch its documents come in an order drawn by seed, epoch and content; the prefix holds
the documents that start before the leaf's budget ends. Prefix sums are taken over many buckets
of the drawn order first, so that a leaf with a third of all documents is never in one task;
only the bucket where the budget ends is put in order. What comes out is a row per leaf and
epoch, the last place that is selected, and every document is compared with it where it lies.

Defined results:

* A document of no tokens (null or empty text) is never selected.
* Null labels are a label of their own, written ``""`` in paths; so is an empty one.
* Weights name leaves, or nodes whose children share equally; what has no weight counts as 1
  beside its siblings. A weight of 0 takes a subtree out; negative or null ones are errors.
* Repeated rows are rows of their own: ties in the drawn order are broken by row number. The
  table has to be a scan or a written table, whose rows keep their places.
* A share of more than all leaves can give is reduced to that. An empty table stays empty.
* Every column of the input stays, except those named like an output column.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sendgate.llm.common import fresh
from sendgate.session import broadcast_if_small, keep

Path = tuple[str, ...]

# The drawn order of a leaf is cut into this many buckets and one more for every so many rows.
LEAST_BUCKETS = 64
ROWS_PER_BUCKET = 100_000

# A row per leaf and epoch: tokens to give in it and in all, and the leaf's buckets.
_PLAN = pa.schema(
    [
        ("leaf", pa.list_(pa.string())),
        ("epoch", pa.int32()),
        ("prefix", pa.int64()),
        ("leaf_budget", pa.int64()),
        ("buckets", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Mix:
    """Weights by path, and how the selection is drawn."""

    weights: Mapping[Path, float] = field(default_factory=dict)
    share: float = 1.0  # tokens to select, as a share of those that there are
    epochs: int = 1  # how often a document may be selected
    seed: int = 0


def _shared(budget: int, wants: Sequence[tuple[Path, Fraction, int]]) -> dict[Path, int]:
    """Divide a budget among (path, weight, most); what one cannot take goes to the others.

    The result adds up to the budget, or to all that there is with a weight.
    """
    given = {path: 0 for path, _, _ in wants}
    open_ = {path: (weight, most) for path, weight, most in wants if weight > 0 and most > 0}
    left = min(budget, sum(most for _, most in open_.values()))
    while left > 0:
        total = sum(weight for weight, _ in open_.values())
        full = [p for p, (weight, most) in open_.items() if left * weight >= most * total]
        if full:
            # These get all they can take; the others divide the rest anew.
            for path in full:
                given[path] = open_.pop(path)[1]
                left -= given[path]
            continue
        for path, (weight, _) in open_.items():
            given[path] = int(left * weight / total)
        # What rounding leaves goes, token by token, to the one that stays furthest behind with it.
        behind = [((given[path] + 1) / weight, path) for path, (weight, _) in open_.items()]
        heapq.heapify(behind)
        for _ in range(left - sum(given[path] for path in open_)):
            path = heapq.heappop(behind)[1]
            given[path] += 1
            weight, most = open_[path]
            if given[path] < most:
                heapq.heappush(behind, ((given[path] + 1) / weight, path))
        break
    return given


def budgets(tokens: Mapping[Path, int], mix: Mix) -> dict[Path, int]:
    """How many tokens each leaf is to give; ``tokens`` is what the leaves have.

    The tree has a node per label, not per document, so it is held on the driver.
    """
    for path, weight in mix.weights.items():
        if weight is None or not 0 <= weight < float("inf"):
            raise ValueError(f"the weight of {path} is {weight}")
    if not tokens:
        return {}
    depth = len(next(iter(tokens)))
    most: dict[Path, int] = {}
    children: dict[Path, set[Path]] = {}
    for leaf, n in tokens.items():
        for level in range(depth + 1):
            node = leaf[:level]
            if level:
                children.setdefault(node[:-1], set()).add(node)
            most[node] = most.get(node, 0) + n * mix.epochs

    weight_of = {path: Fraction(value) for path, value in mix.weights.items()}

    def reachable(node: Path) -> int:
        """What a subtree can give: nothing under a weight of 0."""
        if weight_of.get(node, 1) == 0:
            return 0
        if len(node) == depth:
            return most[node]
        return sum(reachable(child) for child in children[node])

    capacity = {node: reachable(node) for node in most}
    found: dict[Path, int] = {}
    wanted = int(sum(tokens.values()) * Fraction(mix.share).limit_denominator(1_000_000))
    pending = [((), min(wanted, capacity[()]))]
    while pending:
        node, budget = pending.pop()
        if len(node) == depth:
            found[node] = budget
            continue
        wants = [
            (child, weight_of.get(child, Fraction(1)), capacity[child])
            for child in sorted(children[node])
        ]
        pending.extend(_shared(budget, wants).items())
    return found


def _draw(seed: int, epoch: Column, columns: Sequence[str]) -> Column:
    return F.xxhash64(F.lit(seed), epoch, *columns)


def mix_sources(
    df: DataFrame,
    tree: Sequence[Column],
    tokens: Column,
    mix: Mix,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The selected rows of ``df``, once per epoch they are selected in.

    ``tree`` has the labels of each row from the root to its leaf, ``tokens`` their numbers.
    The columns epoch (from 0), leaf_budget and mix_tokens are added.
    """
    output = ("epoch", "leaf_budget", "mix_tokens")
    others = [c for c in df.columns if c.lower() not in output]
    leaf, row, size, content, end = (
        fresh([*others, *output], name)
        for name in ("_leaf", "_row", "_size", "_content", "_end")
    )
    labels = F.array(*[F.coalesce(label.cast("string"), F.lit("")) for label in tree])
    marked = df.select(
        *others,
        labels.alias(leaf),
        F.coalesce(tokens.cast("long"), F.lit(0)).alias(size),
        F.xxhash64(*others).alias(content),
        F.monotonically_increasing_id().alias(row),
    )
    small = keep(
        marked.where(F.col(size) > 0).select(
            F.col(leaf).alias("leaf"),
            F.col(row).alias("row"),
            F.col(size).alias("size"),
            F.col(content).alias("content"),
        ),
        "sizes",
    )
    # A row per leaf.
    held = {
        tuple(r["leaf"]): r
        for r in small.groupBy("leaf")
        .agg(F.sum("size").alias("tokens"), F.count("*").alias("n"))
        .collect()
    }
    budget = budgets({path: r["tokens"] for path, r in held.items()}, mix)
    plan = []
    for path, wanted in budget.items():
        have = held[path]["tokens"]
        whole, rest = divmod(wanted, have)
        buckets = LEAST_BUCKETS + held[path]["n"] // rows_per_bucket
        plan += [(list(path), epoch, have, wanted, buckets) for epoch in range(whole)]
        if rest:
            plan.append((list(path), whole, rest, wanted, buckets))
    # From an Arrow table, no executor starts Python for it.
    wishes = df.sparkSession.createDataFrame(
        pa.Table.from_pylist([dict(zip(_PLAN.names, line, strict=True)) for line in plan], _PLAN)
    )
    drawn = (
        small.join(broadcast_if_small(keep(wishes, "wishes")), "leaf")
        .withColumn("draw", _draw(mix.seed, F.col("epoch"), ["content"]))
        # High bits in order: bucket numbers grow with the draw.
        .withColumn(
            "bucket", F.floor((F.shiftright("draw", 32) + (1 << 31)) * F.col("buckets") / (1 << 32))
        )
    )
    # Whole epochs need no order; of the others, a sum per bucket says where the prefix ends.
    sums = drawn.groupBy("leaf", "epoch", "bucket").agg(
        F.sum("size").alias("in_bucket"), F.first("prefix").alias("prefix")
    )
    before = Window.partitionBy("leaf", "epoch").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = keep(
        sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
        .where("before < prefix")
        .select("leaf", "epoch", "bucket", "before", "in_bucket"),
        "buckets",
    )
    reached = drawn.join(broadcast_if_small(sums), ["leaf", "epoch", "bucket"])
    inside = F.col("before") + F.col("in_bucket") <= F.col("prefix")
    place = F.struct("draw", "content", "row")
    within = Window.partitionBy("leaf", "epoch", "bucket").orderBy("draw", "content", "row")
    last = (
        reached.where(~inside)
        .withColumn("_up_to", F.col("before") + F.sum("size").over(within) - F.col("size"))
        .where(F.col("_up_to") < F.col("prefix"))
    )
    columns = ["leaf", "epoch", "leaf_budget", place.alias("place")]
    ends = (
        reached.where(inside)
        .select(*columns)
        .unionAll(last.select(*columns))
        .groupBy("leaf", "epoch")
        .agg(F.max("place").alias("end"), F.first("leaf_budget").alias("leaf_budget"))
    )
    ends = broadcast_if_small(keep(ends, "ends").withColumnsRenamed({"leaf": leaf, "end": end}))
    own = F.struct(
        _draw(mix.seed, F.col("epoch"), [content]).alias("draw"),
        F.col(content).alias("content"),
        F.col(row).alias("row"),
    )
    return (
        marked.where(F.col(size) > 0)
        .join(ends, leaf)
        .where(own <= F.col(end))
        .select(*others, "epoch", "leaf_budget", F.col(size).alias("mix_tokens"))
    )
