"""The table roles, derived by Spark from a star schema: orders, lineitem and events."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sendgate import schemas as S
from sendgate.session import new_path
from sendgate.sources.table_log import ACTIONS, LOG_FOLDER

RUN_DATE = dt.date(2024, 1, 2)
BUSINESS = "purchase"
RUN_ID = "RUN-1"
FILE_NAME = "CUSTOMERS_purchase_20240102.csv"
STAMP = "20240102093000"
STEP = 500


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def due(self) -> DataFrame:
        """Orders as candidates; some without a device, most devices with many orders."""
        device = F.when(F.col("o_custkey") % 10 != 0, (F.col("o_custkey") % 300).cast("string"))
        return self.table("orders").select(
            F.col("o_orderkey").alias(S.APPL_ID),
            device.alias(S.IMEI),
            F.col("o_orderpriority").alias(S.CODE),
        )

    @property
    def due_raw(self) -> DataFrame:
        """The candidates as an arriving file has them: text, padded and with a ``.0``."""
        return self.due.select(
            F.concat(F.lit(" "), F.col(S.APPL_ID)).alias("LOAN_OVERVIEW_APPL_ID"),
            F.concat(F.lit("00"), F.col(S.IMEI), F.lit(".0")).alias("LOAN_OVERVIEW_IMEI"),
            F.col(S.CODE).alias(S.CODE),
            F.lit("unused").alias("OTHER"),
        )

    @property
    def loans(self) -> DataFrame:
        """Order lines as loan records: returned lines over a quantity of 40 are overdue."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias(S.APPL_ID),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("BUCKET"),
            (F.col("l_quantity") - 40).alias("INSTALLMENT_OVERDUE"),
        )

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    @property
    def history(self) -> DataFrame:
        """Events as sent rows: the user is the device, the event type the business."""
        return self.events.select(
            F.col("user_id").cast("string").alias(S.IMEI),
            F.col("event_type").alias("business"),
            F.lit(RUN_DATE).alias("run_date"),
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("ts"),
        ).where(
            (F.col("ts") >= F.lit(RUN_DATE).cast("timestamp_ntz"))
            & (F.col("ts") < F.lit(RUN_DATE + dt.timedelta(days=1)).cast("timestamp_ntz"))
        )

    @property
    def no_history(self) -> DataFrame:
        """History of another day: nothing of it counts on the run date."""
        return self.history.withColumn("run_date", F.lit(RUN_DATE - dt.timedelta(days=1)))

    @property
    def attempts(self) -> DataFrame:
        """Events as send attempts: the user is the file, the event type the answer."""
        code = (
            F.when(F.col("event_type") == "view", 200)
            .when(F.col("event_type") == "purchase", 201)
            .when(F.col("event_type") == "click", 302)
            .when(F.col("event_type") == "signup", 401)
            .when(F.col("event_type") == "error", 500)
        )
        return self.events.select(
            F.concat(F.lit("user_"), F.col("user_id")).alias("filename"),
            "ts",
            "event_id",
            code.alias("code"),
            F.when(F.col("event_type") == "click", F.lit("moved"))
            .otherwise(F.col("props"))
            .alias("api_response"),
        )

    @property
    def run_log(self) -> DataFrame:
        failed = F.col("event_type") == "error"
        return self.events.select(
            F.concat(F.lit("/runs/"), F.col("event_id")).alias("path"),
            F.when(failed, F.concat(F.lit("ERROR: "), F.col("event_type")))
            .otherwise(F.lit("ok"))
            .alias("result"),
            F.when(failed, 1).otherwise(0).alias("retries"),
        )


class LoggedLoans:
    """The loans as a table with a log of versions, partitioned by ``BUCKET``.

    Version 0 has all loans; in 1 those of status A are paid, in 2 those of status N become due, and
    3 takes the payment of version 1 back: its files go and those of version 0 are live again. A
    checkpoint covers version 1, and the commits before it are gone.
    """

    def __init__(self, r: Roles):
        self.spark = r.spark
        self.root = new_path(r.spark, "logged-loans")
        self._known: set[str] = set()
        lines = r.table("lineitem").select(
            F.col("l_orderkey").alias(S.APPL_ID),
            (F.col("l_quantity") - 40).cast("double").alias("INSTALLMENT_OVERDUE"),
            F.col("l_returnflag").alias("status"),
        )
        bucket = F.when(F.col("status") == "R", 1).when(F.col("status") == "A", 2).otherwise(0)
        of = {flag: lines.where(F.col("status") == flag) for flag in "RAN"}
        first = {flag: self._write(rows.withColumn("BUCKET", bucket)) for flag, rows in of.items()}
        schema = self.spark.read.parquet(self.root).schema
        head = [
            {"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}},
            {"metaData": {"schemaString": schema.json(), "partitionColumns": ["BUCKET"]}},
        ]
        paid = self._write(of["A"].withColumn("BUCKET", F.lit(0)))
        due = self._write(of["N"].withColumn("BUCKET", F.lit(3)))
        self._checkpoint(1, [*head, *first["R"], *first["N"], *paid, *_removed(first["A"])])
        self._commit(2, [*_removed(first["N"]), *due])
        self._commit(3, [*_removed(paid), *first["A"]])

    def _write(self, rows: DataFrame) -> list[dict]:
        """Append rows in files that each hold a range of amounts; what the log tells of them."""
        value = "INSTALLMENT_OVERDUE"
        rows = rows.drop("status").repartitionByRange(4, value)
        rows.write.mode("append").partitionBy("BUCKET").parquet(self.root)
        columns = [S.APPL_ID, value]

        def each(of) -> Column:
            return F.struct(*[of(c).alias(c) for c in columns])

        stats = F.struct(
            F.count("*").alias("numRecords"),
            each(F.min).alias("minValues"),
            each(F.max).alias("maxValues"),
            each(lambda c: F.count_if(F.col(c).isNull())).alias("nullCount"),
        )
        table = self.spark.read.parquet(self.root)
        files = table.groupBy("_metadata.file_path", "BUCKET").agg(F.to_json(stats).alias("stats"))
        added = []
        for row in files.collect():  # a row per file
            path = row["file_path"].rsplit("/", 2)
            if row["file_path"] not in self._known:
                self._known.add(row["file_path"])
                held = {"BUCKET": str(row["BUCKET"])}
                add = {"path": "/".join(path[1:]), "partitionValues": held, "stats": row["stats"]}
                added.append({"add": add})
        return added

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{LOG_FOLDER}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commit(self, version: int, actions: list[dict]) -> None:
        path, files = self._path(f"{version:020d}.json")
        out = files.create(path, False)
        out.write(bytearray("\n".join(map(json.dumps, actions)).encode()))
        out.close()

    def _checkpoint(self, version: int, actions: list[dict]) -> None:
        lines = self.spark.createDataFrame([(json.dumps(a),) for a in actions], "line string")
        table = lines.select(F.from_json("line", ACTIONS).alias("a")).select("a.*")
        written = new_path(self.spark, "checkpoint")
        table.coalesce(1).write.parquet(written)
        path, files = self._path(f"{version:020d}.checkpoint.parquet")
        files.mkdirs(path.getParent())
        part = next(
            s.getPath() for s in files.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(written))
            if s.getPath().getName().startswith("part-")
        )
        files.rename(part, path)


def _removed(added: list[dict]) -> list[dict]:
    return [{"remove": {"path": a["add"]["path"]}} for a in added]
