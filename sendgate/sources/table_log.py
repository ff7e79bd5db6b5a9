"""Snapshots of a table that keeps a log of its files, in the public Delta log format.

The log folder ``_delta_log`` holds numbered commits (JSON, an action per line) and checkpoints
(Parquet, all actions up to a version). A snapshot is what they add up to: the latest action of
every path decides whether its file is live. The actions are a DataFrame and stay one until the
files to scan are known, so a log of millions of actions is replayed by all executors; files that
the partition values or the minima and maxima in the log rule out are never opened.

Tables that need more of a reader (deletion vectors, column mapping, checkpoints with
sidecars) are refused, never read wrongly.
"""

from __future__ import annotations

import json
import operator
import re
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType, TimestampType

from sendgate.session import broadcast_if_small, keep

# Names and fields of the log format.
LOG_FOLDER = "_delta_log"
ACTIONS = (
    "add struct<path string, partitionValues map<string, string>, stats string,"
    " deletionVector struct<storageType string>>, remove struct<path string>,"
    " metaData struct<schemaString string, partitionColumns array<string>>,"
    " protocol struct<minReaderVersion int, readerFeatures array<string>>"
)
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# End of the fixed values.

_READABLE = {"timestampNtz"}
_COMMIT = re.compile(r"(\d{20})\.json")
_CHECKPOINT = re.compile(r"(\d{20})\.checkpoint(?:\.(\d{10})\.(\d{10}))?\.parquet")
# A reader takes its paths as patterns, so characters of patterns are escaped.
_PATTERN = r"([{}\[\]*?\\])"
_OPERATORS = {
    "=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}

# One condition on a column of the table: name, operator, value.
Condition = tuple[str, str, Any]


@dataclass(frozen=True)
class LogFiles:
    """The files that make up one version: a checkpoint, if there is one, and later commits."""

    version: int
    checkpoint: list[str]
    commits: list[str]


@dataclass(frozen=True)
class Snapshot:
    """A version of the table: its schema, and a row per live file.

    ``files`` has ``key`` (the path without scheme, decoded), ``file`` (what to open), ``values``
    (partition values as text) and ``stats`` (JSON).
    """

    root: str
    version: int
    schema: StructType
    partitions: list[str]
    files: DataFrame

    @property
    def data_schema(self) -> StructType:
        return StructType([f for f in self.schema if f.name not in self.partitions])


def _root(spark: SparkSession, root: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(folder)


def log_files(spark: SparkSession, root: str, version: int | None = None) -> LogFiles:
    """Pick the newest complete checkpoint up to ``version`` and the commits after it.

    Only names are listed; the writers of a table bound their number by dropping commits that a
    checkpoint covers. A commit that is missing in between is an error.
    """
    files, folder = _root(spark, root)
    log = spark._jvm.org.apache.hadoop.fs.Path(folder, LOG_FOLDER)
    if not files.exists(log):
        raise FileNotFoundError(f"no table log in {root}")
    commits: dict[int, str] = {}
    parts: dict[tuple[int, int], list[str]] = {}
    for status in files.listStatus(log):
        name = status.getPath().getName()
        path = re.sub(_PATTERN, r"\\\1", status.getPath().toString())
        if found := _COMMIT.fullmatch(name):
            commits[int(found[1])] = path
        elif found := _CHECKPOINT.fullmatch(name):
            parts.setdefault((int(found[1]), int(found[3] or 1)), []).append(path)
    whole = {at: paths for (at, of), paths in parts.items() if len(paths) == of}
    last = max([*commits, *whole], default=-1) if version is None else version
    start = max((at for at in whole if at <= last), default=-1)
    wanted = range(start + 1, last + 1)
    missing = [at for at in wanted if at not in commits]
    if last < 0 or missing:
        raise ValueError(f"the log of {root} does not lead to version {last}: no commits {missing[:5]}")
    return LogFiles(last, whole.get(start, []), [commits[at] for at in wanted])


def read_actions(spark: SparkSession, found: LogFiles) -> DataFrame:
    """All actions of these log files, with the version that each is of."""
    readers = []
    if found.checkpoint:
        readers.append(spark.read.schema(ACTIONS).parquet(*found.checkpoint))
    if found.commits:
        # A line that is cut off must not be lost in silence.
        readers.append(spark.read.schema(ACTIONS).option("mode", "FAILFAST").json(found.commits))
    at = F.substring(F.col("_metadata.file_name"), 1, 20).cast("long").alias("version")
    both = [actions.select("*", at) for actions in readers]
    return both[0].unionByName(both[1]) if len(both) > 1 else both[0]


def _decoded(path: Column) -> Column:
    """A path out of its URI form; unlike in a query string, a plus is a plus."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _key(uri: Column) -> Column:
    return _decoded(F.regexp_replace(uri, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", ""))


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """Replay the log up to ``version``, or to its end."""
    found = log_files(spark, root, version)
    actions = read_actions(spark, found)

    def last(name: str) -> Column:
        held = F.when(F.col(name).isNotNull(), F.col("version"))
        return F.max_by(name, held).alias(name)

    head = actions.agg(last("metaData"), last("protocol")).first()
    if head["metaData"] is None or head["protocol"] is None:
        raise ValueError(f"the log of {root} tells no schema or no protocol")
    needed = set(head["protocol"]["readerFeatures"] or []) - _READABLE
    reader = head["protocol"]["minReaderVersion"]
    if reader == 2 or reader > 3 or needed:
        raise ValueError(f"{root} needs reader version {reader} with {sorted(needed)}")

    _, folder = _root(spark, root)
    base, base_key = folder.toString().rstrip("/"), folder.toUri().getPath().rstrip("/")
    added = F.col("add").isNotNull()
    uri = F.coalesce("add.path", "remove.path")
    whole = uri.rlike("^[A-Za-z][A-Za-z0-9+.-]*:/") | uri.startswith("/")
    path = F.when(whole, _decoded(uri)).otherwise(F.concat(F.lit(base + "/"), _decoded(uri)))
    files = (
        actions.where(added | F.col("remove").isNotNull())
        .select(
            F.when(whole, _key(uri)).otherwise(F.concat(F.lit(base_key + "/"), _decoded(uri))).alias("key"),
            F.regexp_replace(path, _PATTERN, r"\\$1").alias("file"),
            F.struct(F.col("version").alias("version"), added.alias("added")).alias("at"),
            F.struct(
                F.col("add.partitionValues").alias("values"), F.col("add.stats").alias("stats")
            ).alias("held"),
        )
        .groupBy("key")
        .agg(F.max("at").alias("at"), F.max_by(F.struct("file", "held"), "at").alias("last"))
        .where("at.added")
        .select("key", "last.file", "last.held.values", "last.held.stats")
    )
    meta = head["metaData"]
    schema = StructType.fromJson(json.loads(meta["schemaString"]))
    return Snapshot(base_key, found.version, schema, list(meta["partitionColumns"] or []), files)


def _value_of(field: StructField) -> Column:
    """The partition value of a file; an empty text stands for null."""
    text = F.col("values")[field.name]
    return F.when(text != "", text).cast(field.dataType)


def _field(schema: StructType, condition: Condition) -> StructField:
    name, op, _ = condition
    if name not in schema.names or op not in _OPERATORS:
        raise ValueError(f"no condition on the table: {condition}")
    return schema[name]


def live_files(snapshot: Snapshot, where: Sequence[Condition] = ()) -> DataFrame:
    """The files that may hold rows for which all conditions are true.

    Partition values decide by themselves. Of other columns a file stays unless its minimum,
    maximum or number of nulls in the log rules it out; one without statistics stays. Timestamps
    are cut to milliseconds in the log, so their maximum counts as a millisecond later.
    """
    fields = [_field(snapshot.schema, c) for c in where]
    files = snapshot.files
    judged = [f for f in dict.fromkeys(fields) if f.name not in snapshot.partitions]
    if judged:
        bounds = StructType(judged)
        stats = (
            StructType()
            .add("numRecords", "long")
            .add("minValues", bounds)
            .add("maxValues", bounds)
            .add("nullCount", StructType([StructField(f.name, LongType()) for f in judged]))
        )
        files = files.withColumn("_stats", F.from_json("stats", stats))
    for field, (name, op, value) in zip(fields, where):
        test = _OPERATORS[op]
        if name in snapshot.partitions:
            files = files.where(test(_value_of(field), F.lit(value)))
            continue
        held = F.col("_stats")
        low, high = held["minValues"][name], held["maxValues"][name]
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            high = high + F.expr("interval 1 millisecond")
        if op == "=":
            may = (low <= F.lit(value)) & (high >= F.lit(value))
        else:
            may = test(low if op.startswith("<") else high, F.lit(value))
        only_nulls = held["nullCount"][name] == held["numRecords"]
        files = files.where(F.coalesce(may, F.lit(True)) & ~F.coalesce(only_nulls, F.lit(False)))
    return files.select("key", "file", "values", "stats")


def _in_folders(snapshot: Snapshot) -> Column:
    """Whether the folders from the root to a file are its partition values, as ``name=value``."""
    names = snapshot.partitions
    folders = F.split(F.col("key"), "/")
    told = F.size(folders) == snapshot.root.count("/") + len(names) + 2
    told = told & F.col("key").startswith(snapshot.root + "/")
    for i, name in enumerate(names):
        segment = F.try_element_at(folders, F.lit(i - len(names) - 1))
        text = F.col("values")[name]
        value = F.when(text != "", text).otherwise(F.lit(NO_PARTITION))
        plain = F.try_url_decode(F.replace(segment, F.lit("+"), F.lit("%2B")))
        told = told & F.coalesce(plain == F.concat(F.lit(f"{name}="), value), F.lit(False))
    return told


def read_logged_table(
    spark: SparkSession, root: str, version: int | None = None, where: Sequence[Condition] = ()
) -> DataFrame:
    """The rows of a version for which all conditions of ``where`` are true.

    Conditions drop files by the log first, then row groups and rows by the scan. The driver holds
    the paths of the files that are left, as it does for any scan, and nothing else of the log. Where
    the folders tell the partition values they are read from there; else each row takes them
    from the log's row of its file.
    """
    snapshot = read_snapshot(spark, root, version)
    files = live_files(snapshot, where)
    if snapshot.partitions:
        files = keep(files.select("key", "file", "values", _in_folders(snapshot).alias("told")), "files")
    listed = files.select("file", *(["told"] if snapshot.partitions else [])).collect()
    names = snapshot.schema.names
    if not listed:
        return spark.createDataFrame([], snapshot.schema)
    paths = [row["file"] for row in listed]
    if not snapshot.partitions:
        rows = spark.read.schema(snapshot.schema).parquet(*paths)
    elif all(row["told"] for row in listed):
        base = _root(spark, root)[1].toString()
        rows = spark.read.schema(snapshot.schema).option("basePath", base).parquet(*paths).select(*names)
    else:
        values = [_value_of(snapshot.schema[n]).alias(n) for n in snapshot.partitions]
        key = "_" * max(map(len, names)) + "key"  # longer than any column's name
        known = broadcast_if_small(keep(files.select(F.col("key").alias(key), *values), "values"))
        scan = spark.read.schema(snapshot.data_schema).parquet(*paths)
        keyed = scan.select("*", _key(F.col("_metadata.file_path")).alias(key))
        rows = keyed.join(known, key).select(*names)
    for name, op, value in where:
        rows = rows.where(_OPERATORS[op](F.col(f"`{name}`"), F.lit(value)))
    return rows
