"""The published sends of a day, compacted and laid out by key for the joins of the runs to come.

The day's batches lie in a folder per run, in the order of their batches, so each run would shuffle
all of them by key. A compaction holds them as of a version of the day's log, a row per key,
business and transaction, bucketed and sorted by key: a join or an aggregation by key reads bucket
after bucket without an exchange. What was committed later is read beside it. A key has at
most a row per run of the day, however often a run sent to it, so no bucket is filled by one key.

A compaction is a folder whose name tells its version and buckets, put in place by a rename; the
session's catalog only says that it is bucketed, and any session can say so anew.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sendgate import schemas as S
from sendgate.session import drop, keep
from sendgate.sources import commits as C

_NAME = re.compile(r"v(\d{12})-b(\d+)")
_ROWS_A_BUCKET = 2_000_000


def _folder(base: str, run_date: dt.date) -> str:
    return f"{base.rstrip('/')}/compacted/run_date={run_date.isoformat()}"


def compactions(spark: SparkSession, base: str, run_date: dt.date) -> list[tuple[int, int, str]]:
    """Version, number of buckets and path of each compaction of the day, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(base, run_date))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = []
    for status in files.listStatus(path):
        if name := _NAME.fullmatch(status.getPath().getName()):
            found.append((int(name[1]), int(name[2]), status.getPath().toString()))
    return sorted(found)


def _bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The folder as a bucketed table; the catalog's entry owns none of the files."""
    # A path is never written twice, so its entry is right for as long as the session lives.
    name = f"sendgate_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.SENT)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table if not exists {name} ({columns}) using parquet"
        f" clustered by ({S.IMEI}) sorted by ({S.IMEI}) into {buckets} buckets location '{place}'"
    )
    return spark.table(name)


def sent_rows(batches: DataFrame) -> DataFrame:
    """A row per key, business and transaction, with the number of rows sent; null keys go."""
    keys = [S.IMEI, "business", "transaction_id"]
    return batches.where(F.col(S.IMEI).isNotNull()).groupBy(*keys).agg(F.count("*").alias("sent"))


def history_parts(
    spark: SparkSession,
    base: str,
    run_date: dt.date,
    version: int | None = None,
    exclude: str | None = None,
) -> list[DataFrame]:
    """The day's sends up to ``version``: the newest compaction, then what was committed after it.

    No transaction is in both: one that was committed again is left out of the compaction. Rows
    are as in ``schemas.SENT``; those of transaction ``exclude`` are left out.
    """
    known = [c for c in compactions(spark, base, run_date) if version is None or c[0] <= version]
    current = C.current_commits(spark, base, run_date, version)
    other = ~F.col("transaction_id").eqNullSafe(F.lit(exclude))
    start, buckets, path = known[-1] if known else (0, 0, "")
    later = current.where(F.col("version") > start)
    tail = C.read_snapshots(spark, later, base, "batches", S.BATCHES).where(other)
    parts = [sent_rows(tail)]
    if known:
        # A row per run since the compaction.
        again = [row[0] for row in later.select("transaction_id").collect()]
        parts.insert(0, _bucketed(spark, path, buckets).where(other & ~F.col("transaction_id").isin(again)))
    return parts


def _put(spark: SparkSession, pending: str, final: str) -> None:
    """Rename the folder, unless another compaction of this version, which is as good, was first."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (pending, final))
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target) or not files.rename(source, target):
        drop(spark, pending)
    # Onto a folder that has just come, a rename may move into it.
    drop(spark, f"{final}/{source.getName()}")


def compact_day(
    spark: SparkSession, base: str, run_date: dt.date, buckets: int | None = None
) -> tuple[int, DataFrame]:
    """Compact the day as its log is now; the version that this covers, and its rows.

    The last compaction is read instead of the runs that it covers. There are as many buckets as
    shuffle partitions, so that Spark has no reason to deal the rows anew, or more if a bucket
    would hold over two million rows. Readers may go on with older compactions, which stay.
    """
    version = C.latest_version(spark, base, run_date)
    known = compactions(spark, base, run_date)
    if known and known[-1][0] == version:
        return version, _bucketed(spark, known[-1][2], known[-1][1])
    parts = history_parts(spark, base, run_date, version)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = keep(rows.select(*S.SENT.names), "sent")
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // _ROWS_A_BUCKET))
    folder = _folder(base, run_date)
    pending, final = (f"{folder}/{name}" for name in (f"pending-{uuid.uuid4().hex}", f"v{version:012d}-b{buckets}"))
    name = f"sendgate_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, S.IMEI)
    writer = dealt.write.format("parquet").bucketBy(buckets, S.IMEI).sortBy(S.IMEI)
    writer.option("path", pending).saveAsTable(name)
    spark.sql(f"drop table {name}")  # the entry alone, as the files have a place of their own
    _put(spark, pending, final)
    drop(spark, rows._kept_at)
    at, buckets, path = next(c for c in compactions(spark, base, run_date) if c[0] == version)
    return at, _bucketed(spark, path, buckets)
