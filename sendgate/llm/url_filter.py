"""URL filters: a sort-merge range join of urls with nested allow and block rules.

A rule names a host and a path prefix. It fits its host and every subdomain, for urls whose
path starts with the rule's; of several, the longest wins. Hosts are compared by their labels
in reverse (``com.example.www``). Under one reversed host, a path prefix is an interval of the
sorted paths, so the rules of a host are nested intervals. Each url asks once per level of its
host (``com``, ``com.example``, ...). Rules and urls of a level are sorted together by path and
swept: an opening rule goes on a stack, a closing one comes off, and a url takes the top.

Defined results:

* A null url, or one without ``://``, has an empty host and path, and no rule.
* Hosts are lower-cased in A-Z only; ports, user names and dots stay part of the host.
* Repeated rows are judged alike and all kept; every column of the input stays.
* Of rules with the same host and path, a block wins. A null in a rule makes it void.
* Equal lengths cannot occur between different fitting rules of one host; between levels the
  longer text of host and path wins, then the longer host.
* Without rules, or where none fits, the verdict is ``default``.
* Helper columns start with ``_uf_``, a prefix the input must not use; a clash of the input's
  own column names with the output columns is resolved for the output: the input's goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sendgate.session import broadcast_if_small, keep

ALLOW, BLOCK = "allow", "block"
OUTPUT = ("host", "path", "rule", "verdict")
# Urls of one host level are dealt to this many sweeps and one more for every so many urls,
# each with all of the level's rules.
LEAST_SPREAD = 64
URLS_PER_SWEEP = 250_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    cut = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 0)
    host = F.regexp_extract(cut, r"^[^/]*", 0)
    path = F.substr(cut, F.length(host) + 1)
    empty = F.lit("")
    return (
        F.coalesce(F.translate(host, _UPPER, _LOWER), empty),
        F.coalesce(path, empty),
    )


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _levels(host: Column) -> Column:
    """``com``, ``com.example``, ``com.example.www`` of ``www.example.com``."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, 1, n), ".")
    )


def nested_rules(rules: DataFrame) -> DataFrame:
    """One row per rule with the verdict and length of itself and of the rule around it.

    ``rules`` has the columns host, path and verdict. The enclosing rule is found by an equality
    join of every proper prefix of a rule's path with the paths of the same host.
    """
    lower = F.translate("host", _UPPER, _LOWER)
    plain = (
        rules.where(
            F.col("host").isNotNull()
            & F.col("path").isNotNull()
            & F.col("verdict").isin(ALLOW, BLOCK)
        )
        .groupBy(lower.alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))  # "block" sorts after "allow"
    )
    own = F.struct(
        (F.length("host") + F.length("path")).alias("length"),
        F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    plain = plain.select(
        reversed_host(F.col("host")).alias("_uf_level"),
        F.col("path").alias("_uf_path"),
        own.alias("_uf_own"),
    )
    prefixes = plain.where(F.length("_uf_path") > 0).select(
        F.col("_uf_level"),
        F.col("_uf_path").alias("_uf_of"),
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.length("_uf_path") - 1),
                lambda n: F.substr("_uf_path", F.lit(1), n),
            )
        ).alias("_uf_path"),
    )
    around = (
        prefixes.join(plain, ["_uf_level", "_uf_path"])
        .groupBy("_uf_level", F.col("_uf_of").alias("_uf_path"))
        .agg(F.max_by("_uf_own", F.length("_uf_path")).alias("_uf_around"))
    )
    return plain.join(around, ["_uf_level", "_uf_path"], "left")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = ALLOW,
    spread: int | None = None,
) -> DataFrame:
    """``pages`` with host, path, the rule that decides (or null) and its verdict."""
    host, path = host_and_path(F.col(url))
    others = [c for c in pages.columns if c.lower() not in OUTPUT]
    # Written once, so that the row numbers are the same wherever the rows are read again.
    base = keep(
        pages.select(
            F.monotonically_increasing_id().alias("_uf_row"),
            *others,
            host.alias("host"),
            path.alias("path"),
        ),
        "urls",
    )
    if spread is None:
        spread = LEAST_SPREAD + base.count() // URLS_PER_SWEEP
    nested = keep(nested_rules(rules), "rules")
    levels = broadcast_if_small(keep(nested.select("_uf_level").distinct(), "rule-levels"))

    asking = (
        base.where(F.col("host") != "")
        .select("_uf_row", F.explode(_levels(F.col("host"))).alias("_uf_level"), "path")
        .join(levels, "_uf_level", "left_semi")
        .select(
            "_uf_level",
            F.pmod(F.xxhash64("_uf_row"), F.lit(spread)).alias("_uf_part"),
            F.to_binary("path", F.lit("utf-8")).alias("_uf_at"),
            F.lit(1).alias("_uf_kind"),
            "_uf_row",
        )
    )
    # No byte of UTF-8 is 0xFF, so this ends behind every path with the prefix.
    start = F.to_binary("_uf_path", F.lit("utf-8"))
    end = F.concat(start, F.to_binary(F.lit("FF"), F.lit("hex")))
    edges = nested.select(
        "_uf_level",
        F.explode(
            F.array(
                F.struct(start.alias("at"), F.lit(0).alias("kind"), F.col("_uf_own").alias("top")),
                F.struct(end.alias("at"), F.lit(2).alias("kind"), F.col("_uf_around").alias("top")),
            )
        ).alias("_uf_edge"),
    ).select(
        "_uf_level",
        F.explode(F.expr(f"sequence(0L, {spread - 1}L)")).alias("_uf_part"),
        F.col("_uf_edge.at").alias("_uf_at"),
        F.col("_uf_edge.kind").alias("_uf_kind"),
        # A struct around the top, so that "nothing is open" is not skipped as a null.
        F.struct(F.col("_uf_edge.top").alias("rule")).alias("_uf_top"),
    )
    # At an equal place, an outer rule closes after an inner one: the shorter path ends in FF
    # earlier in the text, so it sorts later.
    sweep = Window.partitionBy("_uf_level", "_uf_part").orderBy("_uf_at", "_uf_kind")
    swept = (
        asking.unionByName(edges, allowMissingColumns=True)
        .withColumn("_uf_open", F.last("_uf_top", ignorenulls=True).over(sweep))
        .where((F.col("_uf_kind") == 1) & F.col("_uf_open.rule").isNotNull())
    )
    best = swept.groupBy("_uf_row").agg(F.max("_uf_open.rule").alias("_uf_best"))
    return base.join(best, "_uf_row", "left").select(
        *others,
        "host",
        "path",
        F.col("_uf_best.rule").alias("rule"),
        F.coalesce(F.col("_uf_best.verdict"), F.lit(default)).alias("verdict"),
    )
