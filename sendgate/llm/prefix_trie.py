"""Trie of conversation prefixes, from fingerprints that are combined and never rebuilt.

A conversation is rebuilt by a recipe: the first turns of a base conversation, then its own turns
after its first ones. The rebuilt turns are never put together:

1. A turn is hashed to residues of three primes. The fingerprint of a sequence is the polynomial
   with these as coefficients. Fingerprints are a monoid: a sequence after another adds its own,
   times the power of the base for the length before it. So prefixes of every stored
   conversation come from one scan over sorted blocks, whose totals are combined alike.
2. A recipe is a symbol, an offset and a factor per prime: base head plus shifted own suffix,
   less the own head. Applied to the stored prefixes of the own suffix, it gives the rebuilt ones.
   Heads are not repeated per recipe: recipes are counted by base and length, and the stored
   prefixes of a base stand for all of them.
3. Prefixes of one depth and fingerprint are a node. Each row refers to the stored turn it ends
   with, equal turns to the same one (the hashes of turns are compared with their texts); a group
   is one node only if all of its rows end with the same stored turn and have the same prefix
   before it. If that fails anywhere, all is done again with other primes' bases, so the
   result is exact.
4. A node is known by its smallest member and its depth. The nodes of one smallest member are a
   chain, whose top hangs on another chain. Sums over subtrees are added up from chain to chain
   by pointer doubling (rounds: the logarithm of the longest way from chain to chain), then
   along each chain.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sendgate.llm.scans import BLOCK, PLACE, before, in_blocks, inside, running, spanning
from sendgate.session import broadcast_if_small, keep

# The three largest primes below 2^31, so that products fit into 63 bits.
PRIMES = (2147483647, 2147483629, 2147483587)
LANES = range(len(PRIMES))
_DIGIT_BITS = 6
_DIGITS = 6  # powers up to 2^36


@dataclass(frozen=True)
class Trie:
    """``nodes``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes,
    turn_conv_id and turn_place (the stored turn it ends with). ``ends``: conv_id, depth and
    member, a row per rebuilt conversation with the node it ends at."""

    nodes: DataFrame
    ends: DataFrame


def _lanes(name: str) -> list[str]:
    return [f"{name}{j}" for j in LANES]


def _power(exponent: Column, base: int, prime: int) -> Column:
    """base ** exponent modulo prime, digit by digit from small tables."""
    result = None
    for digit in range(_DIGITS):
        step = pow(base, 1 << (digit * _DIGIT_BITS), prime)
        table = ", ".join(f"{pow(step, x, prime)}L" for x in range(1 << _DIGIT_BITS))
        place = F.shiftright(exponent, digit * _DIGIT_BITS).bitwiseAND((1 << _DIGIT_BITS) - 1)
        factor = F.get(F.expr(f"array({table})"), place.cast("int"))
        result = factor if result is None else result * factor % prime
    return result


def _stored(turns: DataFrame, seed: int) -> DataFrame | None:
    """The prefixes of every stored conversation, or none if two turns share their hash.

    A row per turn: conv_id, pos (from 1), ref (least equal stored turn), bytes, fingerprints up
    to this turn (f) and before it (e).
    """
    hashes = [
        F.pmod(F.xxhash64(F.lit(2 * len(PRIMES) * seed + j), "role", "text"), F.lit(PRIMES[j])).alias(f"h{j}")
        for j in LANES
    ]
    turns = turns.select("conv_id", "turn", "role", "text", *hashes)
    # Turns of one place in a conversation are put in order by role and text; only theirs are sorted.
    tied = turns.groupBy("conv_id", "turn").count().where("count > 1")
    tied = broadcast_if_small(keep(tied.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t")), "tied"))
    marked = turns.join(tied, (F.col("conv_id") == F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")), "left")
    several = F.col("_c").isNotNull()
    marked = marked.select(
        "conv_id",
        "turn",
        F.when(several, F.col("role")).alias("_role"),
        F.when(several, F.col("text")).alias("_text"),
        F.octet_length("text").cast("long").alias("bytes"),
        *_lanes("h"),
    )
    placed = in_blocks(
        marked, "conv_id", ["turn", "_role", "_text"], ["conv_id", "bytes", *_lanes("h")], turns.count()
    )

    texts = turns.select("role", "text", *_lanes("h")).distinct()
    if not texts.groupBy(*_lanes("h")).count().where("count > 1").isEmpty():
        return None
    least = keep(placed.groupBy(*_lanes("h")).agg(F.min(PLACE).alias("ref")), "turn-refs")
    # From a written table, so that Spark can split the rows of a turn that many conversations have.
    placed = placed.join(least, _lanes("h"))

    here = inside("conv_id")
    rows = placed.withColumn("q", F.count("*").over(here) - 1)
    bases = _bases(seed)
    terms = [(F.col(f"h{j}") * _power(F.col("q"), bases[j], PRIMES[j]) % PRIMES[j]).alias(f"g{j}") for j in LANES]
    rows = rows.select("conv_id", BLOCK, PLACE, "ref", "bytes", "q", *terms)
    rows = keep(
        rows.select("*", *[(F.sum(f"g{j}").over(here) % PRIMES[j]).alias(f"f{j}") for j in LANES]),
        "prefixes-in-blocks",
    )
    # What earlier blocks of a conversation put before a block: their number and fingerprint.
    parts = rows.groupBy(BLOCK, "conv_id").agg(
        F.count("*").alias("n"), *[(F.sum(f"g{j}") % PRIMES[j]).alias(f"g{j}") for j in LANES]
    )
    long = spanning(parts, "conv_id")
    shift = F.coalesce(F.sum("n").over(before("conv_id")), F.lit(0))
    shifted = long.withColumn("_shift", shift)
    moved = [
        (F.col(f"g{j}") * _power(F.col("_shift"), bases[j], PRIMES[j]) % PRIMES[j]).alias(f"_g{j}") for j in LANES
    ]
    shifted = shifted.select(BLOCK, "conv_id", "_shift", *moved)
    shifted = shifted.select(
        BLOCK,
        "conv_id",
        "_shift",
        *[F.coalesce(F.sum(f"_g{j}").over(before("conv_id")), F.lit(0)).alias(f"_f{j}") for j in LANES],
    )
    joined = rows.join(F.broadcast(shifted), [BLOCK, "conv_id"], "left").withColumn(
        "_shift", F.coalesce("_shift", F.lit(0))
    )

    def combined(j: int, local: Column) -> Column:
        scaled = local * _power(F.col("_shift"), bases[j], PRIMES[j])
        return (F.coalesce(F.col(f"_f{j}"), F.lit(0)) + scaled) % PRIMES[j]

    up_to = [combined(j, F.col(f"f{j}")).alias(f"f{j}") for j in LANES]
    until = [combined(j, F.pmod(F.col(f"f{j}") - F.col(f"g{j}"), F.lit(PRIMES[j]))).alias(f"e{j}") for j in LANES]
    return joined.select(
        "conv_id",
        (F.col("_shift") + F.col("q") + 1).alias("pos"),
        F.col(PLACE).alias("place"),
        "ref",
        "bytes",
        *up_to,
        *until,
    )


def _bases(seed: int) -> list[int]:
    draw = random.Random(seed)
    return [draw.randrange(1 << 20, prime - 1) for prime in PRIMES]


def _symbols(recipes: DataFrame, prefixes: DataFrame, seed: int) -> DataFrame:
    """Each recipe as lengths, the fingerprint of its head, and offset and factor for its suffix."""
    lengths = keep(prefixes.groupBy("conv_id").agg(F.max("pos").alias("n")), "lengths")
    base = lengths.select(F.col("conv_id").alias("base_id"), F.col("n").alias("n_base"))
    known = recipes.join(base, "base_id", "left").join(lengths, "conv_id", "left")
    head = F.greatest(F.coalesce(F.col("head").cast("long"), F.lit(0)), F.lit(0))
    known = known.select(
        "conv_id",
        "base_id",
        F.least(head, F.coalesce("n_base", F.lit(0))).alias("k"),
        F.least(head, F.coalesce("n", F.lit(0))).alias("skip"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    known = known.withColumn("tail", F.col("n") - F.col("skip"))

    def at(conv: str, pos: str, name: str) -> DataFrame:
        ends = [F.col(f"f{j}").alias(f"{name}{j}") for j in LANES]
        return prefixes.select(F.col("conv_id").alias(conv), F.col("pos").alias(pos), *ends)

    known = known.join(at("base_id", "k", "a"), ["base_id", "k"], "left")
    known = known.join(at("conv_id", "skip", "b"), ["conv_id", "skip"], "left")
    bases = _bases(seed)
    back = F.greatest(F.when(F.col("tail") > 0, F.col("skip") - F.col("k")).otherwise(0), F.lit(0))
    factors, offsets, heads = [], [], []
    for j in LANES:
        inverse = pow(bases[j], -1, PRIMES[j])
        a, b = (F.coalesce(F.col(f"{name}{j}"), F.lit(0)) for name in "ab")
        factor = _power(back, inverse, PRIMES[j])
        factors.append(factor.alias(f"s{j}"))
        offsets.append(F.pmod(a - factor * b % PRIMES[j], F.lit(PRIMES[j])).alias(f"o{j}"))
        heads.append(a.alias(f"a{j}"))
    return keep(known.select("conv_id", "base_id", "k", "skip", "n", "tail", *heads, *factors, *offsets), "recipes")


def _rows(symbols: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix rows, a head's once for all of its recipes; and the fingerprint each recipe ends with."""
    heads = symbols.where("k > 0").groupBy("base_id", "k").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least")
    )
    heads = keep(heads, "heads")
    longest = heads.groupBy("base_id").agg(F.max("k").alias("longest"))
    asked = prefixes.join(longest, F.col("conv_id") == F.col("base_id")).where("pos <= longest")
    counted = asked.drop("base_id", "longest").join(
        heads, (F.col("conv_id") == F.col("base_id")) & (F.col("pos") == F.col("k")), "left"
    )
    counted = keep(counted.select(*prefixes.columns, F.coalesce("n", F.lit(0)).alias("n"), "least"), "heads")
    counted = running(counted, "conv_id", [F.desc("pos")], sums=["n"], mins=["least"])
    columns = ["depth", *_lanes("f"), *_lanes("e"), "ref", "bytes", "n", "least"]
    head_rows = counted.withColumn("depth", F.col("pos")).select(*columns)

    own = symbols.where("tail > 0").select(
        "conv_id", "k", "skip", F.col("n").alias("n_own"), *_lanes("s"), *_lanes("o")
    )
    suffix = prefixes.join(own, "conv_id").where("pos > skip")

    def applied(name: str, j: int) -> Column:
        return ((F.col(f"o{j}") + F.col(f"s{j}") * F.col(f"{name}{j}")) % PRIMES[j]).alias(f"{name}{j}")

    suffix = suffix.select(
        (F.col("k") + F.col("pos") - F.col("skip")).alias("depth"),
        *[applied("f", j) for j in LANES],
        *[applied("e", j) for j in LANES],
        "ref",
        "bytes",
        F.lit(1).cast("long").alias("n"),
        F.col("conv_id").alias("least"),
        (F.col("pos") == F.col("n_own")).alias("last"),
    )
    suffix = keep(suffix, "suffixes")
    ends = suffix.where("last").select("depth", *_lanes("f"), F.col("least").alias("member"))
    short = symbols.where("tail = 0").select(
        F.col("k").alias("depth"),
        *[F.col(f"a{j}").alias(f"f{j}") for j in LANES],
        F.col("conv_id").alias("member"),
    )
    return head_rows.unionByName(suffix.select(*columns)), ends.unionByName(short)


def _nodes(rows: DataFrame, symbols: DataFrame) -> DataFrame | None:
    """A row per node, or none if rows of one fingerprint are not equal."""
    same = [*_lanes("e"), "ref"]
    grouped = rows.groupBy("depth", *_lanes("f")).agg(
        F.sum("n").alias("n_convs"),
        F.min("least").alias("conv_id"),
        F.min("bytes").alias("bytes"),
        *[F.min(c).alias(c) for c in same],
        *[F.max(c).alias(f"_{c}") for c in same],
    )
    root = symbols.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", *_lanes("f"))]
    root = root.select(
        *zero,
        "n_convs",
        "conv_id",
        F.lit(0).cast("long").alias("bytes"),
        *[F.lit(None).cast("long").alias(c) for c in (*same, *[f"_{c}" for c in same])],
    )
    nodes = keep(grouped.unionByName(root), "nodes")
    equal = " and ".join(f"{c} = _{c}" for c in same)
    if not nodes.where(f"depth > 0 and not ({equal})").isEmpty():
        return None
    return nodes.drop(*[f"_{c}" for c in same])


def _linked(nodes: DataFrame) -> DataFrame:
    """The nodes with their parents' smallest members and their numbers of children."""
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        *[F.col(f"f{j}").alias(f"e{j}") for j in LANES],
        F.col("conv_id").alias("parent_conv_id"),
    )
    linked = keep(nodes.join(parents, ["depth", *_lanes("e")], "left"), "nodes")
    children = linked.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    )
    children = keep(children.agg(F.count("*").alias("n_children")), "children")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "bytes", "ref", *_lanes("f")]
    joined = linked.join(children, ["conv_id", "depth"], "left")
    return keep(joined.select(*columns, F.coalesce("n_children", F.lit(0)).alias("n_children")), "nodes")


def _chain_totals(chains: DataFrame) -> DataFrame:
    """Sums over each chain and all that hang on it, by pointer doubling over written rounds."""
    state = chains
    while not state.where("up is not null").isEmpty():
        added = state.where("up is not null").groupBy(F.col("up").alias("conv_id")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_bytes").alias("_saved")
        )
        above = state.where("up is not null").select(F.col("conv_id").alias("up"), F.col("up").alias("_up"))
        joined = state.join(keep(added, "added"), "conv_id", "left").join(above, "up", "left")
        state = keep(
            joined.select(
                "conv_id",
                F.col("_up").alias("up"),
                (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_bytes") + F.coalesce("_saved", F.lit(0))).alias("saved_bytes"),
            ),
            "chains",
        )
    return state.drop("up")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    leaf = (F.col("n_children") == 0).cast("long")
    own = nodes.select(
        *nodes.columns,
        leaf.alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_bytes"),
    )
    top = F.col("parent_conv_id") != F.col("conv_id")
    chains = own.groupBy("conv_id").agg(
        F.max(F.when(top, F.col("parent_conv_id"))).alias("up"),
        (F.min("depth") - 1).alias("up_depth"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_bytes").alias("saved_bytes"),
    )
    chains = keep(chains, "chains")
    totals = _chain_totals(chains.drop("up_depth"))
    places = chains.where("up is not null").select("conv_id", "up", "up_depth")
    hanging = places.join(totals, "conv_id").groupBy(
        F.col("up").alias("conv_id"), F.col("up_depth").alias("depth")
    )
    hanging = hanging.agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_bytes").alias("_saved"))
    joined = own.join(keep(hanging, "hanging"), ["conv_id", "depth"], "left")
    with_others = joined.select(
        *nodes.columns,
        (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved_bytes") + F.coalesce("_saved", F.lit(0))).alias("saved_bytes"),
    )
    return running(keep(with_others, "nodes"), "conv_id", [F.desc("depth")], ["n_leaves", "saved_bytes"])


def prefix_trie(turns: DataFrame, recipes: DataFrame, seed: int = 0) -> Trie:
    """All different prefixes of the conversations that ``recipes`` rebuild from ``turns``.

    ``turns`` has conv_id (bigint), turn, role and text; other columns are not looked at. Turns
    are ordered by turn, null first, then by role and text; null role or text is empty. Rows
    without conv_id belong to no conversation. Repeated rows are turns of their own.
    ``recipes`` has conv_id, base_id and head, one row per conversation: the first ``head`` turns
    of ``base_id`` (all if fewer; none if it is null or has none), then the own turns after the
    first ``head`` ones. A null or negative head is 0; recipes without conv_id are left out.
    A rebuilt conversation without turns is a member of the root alone. Without recipes there is
    no node, not even a root.
    """
    turns = turns.where("conv_id is not null").select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    recipes = recipes.where("conv_id is not null").select("conv_id", "base_id", "head")
    while True:
        prefixes = _stored(turns, seed)
        if prefixes is not None:
            prefixes = keep(prefixes, "prefixes")
            symbols = _symbols(recipes, prefixes, seed)
            rows, ends = _rows(symbols, prefixes)
            nodes = _nodes(rows, symbols)
            if nodes is not None:
                break
        seed += 1  # two different turns or prefixes had one fingerprint
    nodes = _linked(nodes)
    ends = ends.join(nodes.select("depth", *_lanes("f"), "conv_id"), ["depth", *_lanes("f")])
    ends = keep(ends.select("conv_id", "depth", "member"), "ends")
    summed = _subtree_sums(nodes.drop(*_lanes("f")))
    stored = prefixes.select(
        F.col("place").alias("ref"), F.col("conv_id").alias("turn_conv_id"), F.col("pos").alias("turn_place")
    )
    nodes = keep(summed.join(stored, "ref", "left").drop("ref", "bytes"), "nodes")
    return Trie(nodes, ends)


def ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined members that end at each node, in ascending order.

    The members are sorted over all tasks and joined to texts of a batch at most; only these
    go to the one task that hashes a node, which reads them in order and holds one at a time.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, depths, members = (batch[name].to_pylist() for name in ("conv_id", "depth", "member"))
            out: list[tuple[int, int, int, str]] = []
            start = 0
            for i in range(1, len(members) + 1):
                if i == len(members) or convs[i] != convs[start] or depths[i] != depths[start]:
                    out.append((convs[start], depths[start], members[start], ",".join(map(str, members[start:i]))))
                    start = i
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_pydict(dict(zip(("conv_id", "depth", "first", "members"), map(list, columns))))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            columns = (batch[name].to_pylist() for name in ("conv_id", "depth", "members"))
            for conv, depth, members in zip(*columns, strict=True):
                if (conv, depth) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256()
                state.update(members.encode())
            yield _digests(done)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    sort = ["conv_id", "depth", "member"]
    blocks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.repartitionByRange(blocks, *sort).sortWithinPartitions(*sort)
    joined = ranged.mapInArrow(join, "conv_id long, depth long, first long, members string")
    dealt = joined.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return dealt.mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.string()),
        ],
        ["conv_id", "depth", "ends_sha256"],
    )
