"""Line dedup: recurring line templates, found by a log-template tree of fixed depth.

A line's words lead down the tree: the number of words, then its first words, then a leaf with
all lines that share these. Words with digits are variable fields from the start. Inside a leaf,
a word that many texts have at one place is constant there, any other is a variable field; what
is constant in a line is its template. A template that many different texts hold is boilerplate
or a repeated passage, and its lines are dropped, whatever their fields say.

Copies of a whole document are another matter: nearly all of their lines recur, and dropping
these would empty them. So a recurring line is dropped

* everywhere, if its template stands alone in most of its texts, and in enough: other recurring
  lines make up at most half of the rest of their words; else
* from a text of which recurring lines make up at most half of the words.

With ``exact`` set, every line is also a template of its own, as it stands, whatever share of its
words holds digits. A line of fewer than ``least_words`` words takes as many more texts as it is
shorter. With ``passage_words`` set, ``passage_texts`` different texts make a line of that many
words or more recurring as it stands. ``WHOLE`` has both, and is the rule of op6_line_dedup and of the
pipeline; the default has neither.

Blocks that recur together, as a header and a footer do, are not alone. With ``copied`` set, as in
``WHOLE``, a template also goes everywhere if most of its texts, and ``texts`` at least, have a rest
of their own: recurring lines make up less than ``copied`` of their words. Texts beyond that are
near copies of each other.

All counts are of different texts, over all documents. Only DataFrame functions are used.

Defined results:

* A null text stays null, an empty one empty. A text whose lines all go is empty.
* Lines end with a line feed only. Lines of fewer than ``least_words`` words are
  dropped only with ``exact``, and lines without words never.
* Repeated rows, and rows with equal texts, are treated alike and all kept.
* Every column of the input stays; the text is replaced. The columns n_lines and dropped (places
  of the dropped lines, from 0) are added and take the place of columns so named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sendgate.llm.common import fresh
from sendgate.session import broadcast_if_small, keep

# White space, and the mark of a variable field.
SPACE = r"[\x20\x09-\x0D]+"
FIELD = "<*>"

# Dropped places of all texts together are broadcast up to this many, four bytes each.
BROADCAST_PLACES = 4_000_000


@dataclass(frozen=True)
class Tree:
    depth: int = 3  # first words that lead to a leaf, at most a third of the line's
    texts: int = 5  # different texts that make a word constant and a template recurring
    least_words: int = 3
    similarity: float = 0.7  # share of a line's words that have to be constant
    alone: float = 0.5  # share of a text's words, at most, that recurring lines make up
    mostly: float = 0.5  # share of a template's texts that it has to be alone in
    passage_words: int | None = None  # lines of so many words are passages; None: no line is
    passage_texts: int = 2  # different texts that make a passage recurring
    exact: bool = False  # any line is also a template as it stands, with its digits
    copied: float | None = None  # above this share of recurring words a text is a copy

    def exact_floor(self, n: Column) -> Column:
        """Different texts that make a line of ``n`` words recurring as it stands; null: none."""
        floor = F.lit(None).cast("int")
        if self.exact:
            # The fewer words a line has, the more texts it takes.
            short = F.ceil(F.lit(self.texts * self.least_words) / n).cast("int")
            floor = F.when(n < self.least_words, short).otherwise(F.lit(self.texts))
        if self.passage_words is not None:
            floor = F.when(n >= self.passage_words, F.lit(self.passage_texts)).otherwise(floor)
        return floor

    @property
    def fewest_words(self) -> int:
        """Words of the shortest lines that may be dropped."""
        return 1 if self.exact else self.least_words


# Also what few texts share, if it is long, what recurs as it stands, whatever its words are, and
# blocks that recur together. Two texts of one length that share 6/7 have a Jaccard index of 0.75.
WHOLE = Tree(passage_words=50, exact=True, copied=6 / 7)


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, SPACE), "")


def _masked(words: Column) -> Column:
    return F.transform(words, lambda w: F.when(w.rlike("[0-9]"), FIELD).otherwise(w))


def _lines(texts: DataFrame, tree: Tree) -> DataFrame:
    """A row per line that may be dropped: text, place, leaf, and the line."""
    rows = texts.select("key", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    rows = rows.withColumn("words", _words(F.col("line"))).withColumn("n", F.size("words"))
    first = F.slice("words", F.lit(1), F.least(F.lit(tree.depth), F.floor(F.col("n") / 3)).cast("int"))
    return rows.where(F.col("n") >= tree.fewest_words).select(
        "key",
        "place",
        "line",
        "n",
        F.xxhash64("line").alias("line_hash"),
        F.xxhash64("n", _masked(first)).alias("leaf"),
    )


def _repeats(known: DataFrame, tree: Tree) -> DataFrame:
    """Lines that enough texts hold as they stand, each line a template of its own."""
    asked = known.withColumn("floor", tree.exact_floor(F.col("n"))).where("floor is not null")
    repeated = (
        asked.select("line_hash", "key", "floor")
        .distinct()
        .groupBy("line_hash", "floor")
        .agg(F.count("*").alias("texts"))
        .where(F.col("texts") >= F.col("floor"))
        .select("line_hash")
    )
    repeated = broadcast_if_small(keep(repeated, "repeats"))
    return (
        asked.join(repeated, "line_hash", "left_semi")
        .select("key", "place", "n", F.xxhash64("line_hash", "n").alias("template"), "floor")
        .distinct()
    )


def recurring_lines(texts: DataFrame, tree: Tree) -> DataFrame:
    """The lines to drop: key of the text and place of the line.

    ``texts`` has the columns key and text, copies of a text with equal keys.
    """
    known = keep(
        _lines(texts, tree).select("key", "place", "leaf", "line_hash", "n"), "lines"
    )
    masked = known.where(F.col("n") >= tree.least_words)
    leaves = (
        masked.select("leaf", "key").distinct().groupBy("leaf").agg(F.count("*").alias("texts"))
    )
    leaves = broadcast_if_small(
        keep(leaves.where(F.col("texts") >= tree.texts).select("leaf"), "leaves")
    )
    # In how many texts is each line of these leaves? A row per different line.
    counted = (
        masked.join(leaves, "leaf", "left_semi")
        .select("leaf", "line_hash", "key")
        .distinct()
        .groupBy("leaf", "line_hash")
        .agg(F.count("*").alias("texts"))
    )
    words = (
        _lines(texts, tree)
        .join(leaves, "leaf", "left_semi")
        .groupBy("leaf", "line_hash")
        .agg(F.first("line").alias("line"))
    )
    different = keep(words.join(counted, ["leaf", "line_hash"]), "different-lines")
    placed = different.select(
        "leaf", "line_hash", "texts", F.posexplode(_words(F.col("line"))).alias("at", "word")
    ).where(~F.col("word").rlike("[0-9]"))
    constant = (
        placed.groupBy("leaf", "at", "word")
        .agg(F.sum("texts").alias("texts"))
        .where(F.col("texts") >= tree.texts)
        .drop("texts")
    )
    templates = (
        placed.join(constant, ["leaf", "at", "word"])
        .groupBy("leaf", "line_hash")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("fixed"))
        .select(
            "leaf",
            "line_hash",
            F.size("fixed").alias("n_fixed"),
            F.xxhash64("leaf", "fixed").alias("template"),
        )
    )
    in_template = masked.join(broadcast_if_small(keep(templates, "templates")), ["leaf", "line_hash"])
    in_template = keep(
        in_template.where(F.col("n_fixed") >= F.col("n") * tree.similarity)
        .select("key", "place", "n", "template")
        .distinct(),  # copies of a text have the same rows
        "templated-lines",
    )
    recurring = (
        in_template.select("template", "key")
        .distinct()
        .groupBy("template")
        .agg(F.count("*").alias("texts"))
        .where(F.col("texts") >= tree.texts)
        .select("template")
    )
    recurring = broadcast_if_small(keep(recurring, "recurring"))
    found = in_template.join(recurring, "template", "left_semi").withColumn(
        "floor", F.lit(tree.texts)
    )
    if tree.exact or tree.passage_words is not None:
        found = keep(found, "templated-lines")
        found = found.unionByName(
            _repeats(known, tree).join(found.select("key", "place"), ["key", "place"], "left_anti")
        )
    found = keep(found, "recurring-lines")
    sizes = known.select("key", "place", "n").distinct().groupBy("key").agg(F.sum("n").alias("all"))
    held = found.groupBy("key").agg(F.sum("n").alias("repeated"))
    held = held.join(sizes, "key")
    if tree.copied is None:
        own_rest = F.lit(False)
    else:
        own_rest = F.col("repeated") < F.col("all") * tree.copied
    held = keep(held.withColumn("differs", own_rest), "repeated")
    rest = F.col("all") - F.col("own")
    alone = (
        found.groupBy("template", "key")
        .agg(F.sum("n").alias("own"), F.first("floor").alias("floor"))
        .join(held, "key")
        .groupBy("template")
        .agg(
            F.first("floor").alias("floor"),
            F.count("*").alias("texts"),
            F.count_if((rest > 0) & (F.col("repeated") - F.col("own") <= rest * tree.alone)).alias(
                "alone"
            ),
            F.count_if("differs").alias("differ"),
        )
        .where(
            ((F.col("alone") >= F.col("floor")) & (F.col("alone") >= F.col("texts") * tree.mostly))
            # What few texts share together may be most of a document, which none would keep.
            | ((F.col("differ") >= tree.texts) & (F.col("differ") >= F.col("texts") * tree.mostly))
        )
        .select("template", F.lit(True).alias("everywhere"))
    )
    alone = broadcast_if_small(keep(alone, "alone"))
    minor = held.where(F.col("repeated") <= F.col("all") * tree.alone).select(
        "key", F.lit(True).alias("minor")
    )
    return (
        found.join(alone, "template", "left")
        .join(minor, "key", "left")
        .where(F.coalesce("everywhere", "minor", F.lit(False)))
        .select("key", "place")
    )


def drop_recurring_lines(
    df: DataFrame, text: str = "text", tree: Tree | None = None
) -> DataFrame:
    """``df`` with its texts less their recurring lines, n_lines and the places dropped."""
    tree = tree or Tree()
    others = [c for c in df.columns if c.lower() not in ("n_lines", "dropped")]
    key, places = fresh(others, "_key"), fresh(others, "_places")
    keyed = F.xxhash64(text, F.length(text))
    texts = df.where(F.col(text).isNotNull()).select(keyed.alias("key"), F.col(text).alias("text"))
    drops = (
        recurring_lines(texts, tree)
        .groupBy(F.col("key").alias(key))
        .agg(F.sort_array(F.collect_list("place")).alias(places))
    )
    drops = keep(drops, "dropped")
    if (drops.agg(F.sum(F.size(places) + 16)).first()[0] or 0) <= BROADCAST_PLACES:
        drops = F.broadcast(drops)
    lines = F.split(text, "\n", -1)
    left = F.filter(lines, lambda line, i: ~F.array_contains(places, i))
    shorter = F.when(F.col(places).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return (
        df.withColumn(key, F.when(F.col(text).isNotNull(), keyed))
        .join(drops, key, "left")
        .select(
            *[shorter.alias(text) if c == text else F.col(c) for c in others],
            F.when(F.col(text).isNotNull(), F.size(lines)).alias("n_lines"),
            F.coalesce(places, F.array().cast("array<int>")).alias("dropped"),
        )
    )
