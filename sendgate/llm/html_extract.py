"""HTML extraction: the main text of pages, without what a site repeats on its pages.

Every page is read into elements twice. The first pass hashes the subtree of every element that
has text; Spark counts, per host, the different pages that hold each hash. The second pass
deletes subtrees that recur across many pages of the host, besides menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and comments that are marked as such by tag,
role, class or id, and puts the rest of the article together block by block.

"Different" pages differ in their main text: copies of one page count once, or a much-copied
article would pass for a template. For the same reason a subtree inside the article has to be
on more pages than one outside.

A number of different pages that does not grow with the host makes a subtree a template: 20
outside of the article, 100 inside. On smaller hosts a share of the pages is enough, 5 % or 30 %,
of 4 or 10 pages at least; and what all pages of a host of 4 to 9 have inside is a template, too.

Only what stands by itself is a template: no heading, list item, table cell, row or inline element
(but for links outside of the article), and inside an article no block of under 40 letters, unless
the article ends with it. So a heading or a value that thousands of articles share stays in each.

Defined results:

* A null or empty html has an empty text.
* A null url, or one without host, is on a host of its own: nothing recurs there.
* Pages without an article, main part or the like give all of their body that is left.
* Broken markup is read as far as it goes; a text without markup is its own text.
* Repeated rows are counted once and all kept. Every column of the input stays, except the html
  and those named like an output column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from sendgate.llm.common import fresh
from sendgate.llm.html_page import Page
from sendgate.llm.url_filter import host_and_path
from sendgate.session import broadcast_if_small, keep

# Templates of all hosts together are broadcast up to this many hashes, eight bytes each.
BROADCAST_HASHES = 1_000_000
# Every page of a host gets all templates of the host up to this many, else those on the page.
HOST_HASHES = 4_096


@dataclass(frozen=True)
class Recurring:
    """How many different pages of a host make a subtree a template.

    A share of the host's pages is enough on small hosts, of ``pages`` at least; ``most`` pages
    are enough on any.
    """

    pages: int = 4
    share: float = 0.05
    pages_inside: int = 10
    share_inside: float = 0.3
    most: int = 20
    most_inside: int = 100

    def least(self, within: Column, all_pages: Column) -> Column:
        outside = F.greatest(F.lit(float(self.pages)), all_pages * self.share)
        inside = F.greatest(F.lit(float(self.pages_inside)), all_pages * self.share_inside)
        # All pages of a host with few.
        few = F.greatest(F.lit(float(self.pages)), all_pages.cast("double"))
        return F.when(within, F.least(inside, F.lit(float(self.most_inside)), few)).otherwise(
            F.least(outside, F.lit(float(self.most)))
        )


_FOUND = StructType(
    [
        StructField("page", LongType()),
        StructField("inside", ArrayType(LongType())),
        StructField("outside", ArrayType(LongType())),
    ]
)


@F.pandas_udf(_FOUND)
def _subtrees(sources: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in sources:
        rows = [Page(source or "").subtrees() for source in batch]
        yield pd.DataFrame(rows, columns=["page", "inside", "outside"])


@F.pandas_udf(StringType())
def _text(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for sources, inside, outside in batches:
        cached: dict[tuple, tuple[frozenset, frozenset]] = {}
        texts = []
        for source, *templates in zip(sources, inside, outside, strict=True):
            hashes = []
            for template in templates:
                found = () if template is None else tuple(template)
                if found not in cached:
                    cached[found] = frozenset(found)
                hashes.append(cached[found])
            texts.append(Page(source).text(*hashes) if source else "")
        yield pd.Series(texts, dtype="object")


def _found(pages: DataFrame, html: str, url: str) -> DataFrame:
    """Per page with a host and an html: host, key of its html, and hashes of its subtrees."""
    host, _ = host_and_path(F.col(url))
    found = (
        pages.select(host.alias("host"), F.col(html).alias("html"))
        .where((F.col("host") != "") & (F.length("html") > 0))
        .select("host", _key("html").alias("key"), _subtrees("html").alias("found"))
        .select("host", "key", "found.*")
    )
    return keep(found, "subtrees")


def _key(html: str) -> Column:
    return F.xxhash64(html, F.length(html))


def _sides(found: DataFrame, *columns: str) -> DataFrame:
    sides = F.array(
        F.struct(F.lit(True).alias("within"), F.col("inside").alias("hashes")),
        F.struct(F.lit(False).alias("within"), F.col("outside").alias("hashes")),
    )
    return found.select("host", *columns, F.explode(sides).alias("side")).select(
        "host", *columns, "side.within", F.explode("side.hashes").alias("hash")
    )


def _templates(found: DataFrame, recurring: Recurring) -> DataFrame:
    each = (
        _sides(found, "page")
        .distinct()
        .groupBy("host", "within", "hash")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min(recurring.pages, recurring.pages_inside))
    )
    hosts = (
        found.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("all_pages"))
    )
    least = recurring.least(F.col("within"), F.col("all_pages"))
    return each.join(hosts, "host").where(F.col("n") >= least).select("host", "within", "hash")


def site_templates(
    pages: DataFrame, recurring: Recurring, html: str = "html", url: str = "url"
) -> DataFrame:
    """Hashes of the subtrees that recur on each host: host, hash and whether inside articles."""
    return _templates(_found(pages, html, url), recurring)


def _lists(found: DataFrame, *keys: str) -> DataFrame:
    return found.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("within"), F.col("hash"))).alias("inside"),
        F.collect_list(F.when(~F.col("within"), F.col("hash"))).alias("outside"),
    )


def extract_text(
    pages: DataFrame,
    recurring: Recurring | None = None,
    html: str = "html",
    url: str = "url",
    text: str = "text",
) -> DataFrame:
    """``pages`` with the main text in place of the html."""
    found = _found(pages, html, url)
    templates = keep(_templates(found, recurring or Recurring()), "templates")
    host_name, key, inside, outside, own_inside, own_outside = (
        fresh(pages.columns, name)
        for name in ("_host", "_key", "_inside", "_outside", "_own_inside", "_own_outside")
    )
    # A hot host can have any number of templates; its pages get those that they hold.
    large = templates.groupBy("host").count().where(F.col("count") > HOST_HASHES).select("host")
    large = broadcast_if_small(keep(large, "hosts"))
    lists = _lists(templates.join(large, "host", "left_anti"), "host").toDF(
        host_name, inside, outside
    )
    if templates.count() <= BROADCAST_HASHES:
        lists = F.broadcast(lists)
    host, _ = host_and_path(F.col(url))
    others = [c for c in pages.columns if c != html and c.lower() != text.lower()]
    marked = pages.withColumn(host_name, host).join(lists, host_name, "left")
    if not large.isEmpty():
        held = _sides(found.join(large, "host", "left_semi"), "key").distinct()
        held = held.join(broadcast_if_small(templates, BROADCAST_HASHES), ["host", "within", "hash"])
        own = _lists(held, "host", "key").toDF(host_name, key, own_inside, own_outside)
        marked = (
            marked.withColumn(key, _key(html))
            .join(keep(own, "own-templates"), [host_name, key], "left")
            .withColumns(
                {
                    inside: F.coalesce(own_inside, inside),
                    outside: F.coalesce(own_outside, outside),
                }
            )
        )
    return marked.select(*others, _text(F.col(html), F.col(inside), F.col(outside)).alias(text))
