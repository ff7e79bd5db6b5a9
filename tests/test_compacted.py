"""Compacted days: the same rows as the published runs, and joins that read them as they lie."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sendgate import schemas as S
from sendgate.operators.status import cascade_over_parts, eligibility_cascade
from sendgate.sources import commits as C
from sendgate.sources import compacted as K

DAY = dt.date(2024, 1, 2)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "published's")


def publish(spark, base, business, transaction, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "IMEI string")
    owned = ("run_date", "business", "transaction_id", "IMEI")
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.BATCHES if f.name not in owned]
    return C.publish(spark, base, DAY, business, transaction, {"batches": rows.select("IMEI", *rest)})


def sent(parts):
    found = Counter()
    for part in parts:
        for r in part.collect():
            assert (r.IMEI, r.business, r.transaction_id) not in found
            found[r.IMEI, r.business, r.transaction_id] = r.sent
    return found


def published(spark, base, version=None):
    rows = C.read_published(spark, base, "batches", S.BATCHES, DAY, version).where("IMEI is not null")
    return Counter((r.IMEI, r.business, r.transaction_id) for r in rows.collect())


def test_parts_are_the_published_rows(spark, base):
    assert sent(K.history_parts(spark, base, DAY)) == {}
    publish(spark, base, "AB", "T1", ["1", "1", "2", None])
    publish(spark, base, "CD", "T2", ["1", "3"])
    version, rows = K.compact_day(spark, base, DAY)
    assert version == 2 and sent([rows]) == published(spark, base)
    publish(spark, base, "AB", "T1", ["2", "4"])  # again, with other keys
    publish(spark, base, "EF", "T3", ["1"])
    assert sent(K.history_parts(spark, base, DAY)) == published(spark, base)
    assert sent(K.history_parts(spark, base, DAY, version=3)) == published(spark, base, 3)
    assert sent(K.history_parts(spark, base, DAY, version=1)) == published(spark, base, 1)
    own = {k: n for k, n in published(spark, base).items() if k[2] != "T2"}
    assert sent(K.history_parts(spark, base, DAY, exclude="T2")) == own
    version, rows = K.compact_day(spark, base, DAY)
    assert version == 4 and sent([rows]) == published(spark, base)
    assert K.compact_day(spark, base, DAY)[0] == 4
    assert [c[0] for c in K.compactions(spark, base, DAY)] == [2, 4]


def test_another_session_reads_the_buckets(spark, base):
    publish(spark, base, "AB", "T1", [str(i) for i in range(50)])
    K.compact_day(spark, base, DAY, buckets=9)
    other = spark.newSession()
    for table in other.catalog.listTables():
        if table.name.startswith("sendgate_"):
            other.sql(f"drop table {table.name}")
    bucketed, _ = K.history_parts(other, base, DAY)
    assert bucketed.count() == 50
    assert "Bucketed: true" in plan(bucketed.groupBy("IMEI").count())


def test_an_empty_day(spark, base):
    publish(spark, base, "AB", "T1", [])
    version, rows = K.compact_day(spark, base, DAY)
    assert version == 1 and rows.count() == 0
    assert sent(K.history_parts(spark, base, DAY)) == {}


def test_a_killed_compaction_is_not_seen(spark, base, monkeypatch):
    publish(spark, base, "AB", "T1", ["1"])

    def die(*_):
        raise InterruptedError

    with monkeypatch.context() as m:
        m.setattr(K, "_put", die)
        with pytest.raises(InterruptedError):
            K.compact_day(spark, base, DAY)
    assert K.compactions(spark, base, DAY) == []
    assert sent(K.history_parts(spark, base, DAY)) == published(spark, base)
    assert K.compact_day(spark, base, DAY)[0] == 1
    # One that comes second leaves the first as it is.
    (path,) = [c[2] for c in K.compactions(spark, base, DAY)]
    K._put(spark, C.snapshot_folder(base, "batches", DAY, "AB", "T1", "none"), path)
    assert sent(K.history_parts(spark, base, DAY)) == published(spark, base)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("many", [False, True])
def test_the_history_is_not_exchanged(spark, base, many):
    """Cut down to the keys asked for and aggregated: the only exchange is that of the keys."""
    publish(spark, base, "AB", "T1", [str(i % 700) for i in range(3000)])
    publish(spark, base, "CD", "T2", [str(i) for i in range(500)])
    _, rows = K.compact_day(spark, base, DAY)
    assert rows.where("IMEI = '5'").count() == 2  # copies in a run are one row
    part, _ = K.history_parts(spark, base, DAY)
    from sendgate.session import keep

    asked = keep(spark.range(400).select(F.col("id").cast("string").alias("IMEI")), "asked")
    asked = asked if many else F.broadcast(asked)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        per_key = part.join(asked, "IMEI", "left_semi").groupBy("IMEI").agg(F.sum("sent").alias("n"))
        text = plan(per_key)
        assert "Bucketed: true" in text
        assert text.count("Exchange hashpartitioning") == int(many), text
        assert {r.IMEI: r.n for r in per_key.collect()}["5"] == 6 - (5 + 700 * 4 >= 3000)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 0}])
def test_the_cascade_is_that_of_the_plain_history(spark, base, options):
    publish(spark, base, "AB", "T1", ["1", "2", "3", None])
    publish(spark, base, "CD", "T2", ["2", "3", "4", "4"])
    K.compact_day(spark, base, DAY)
    publish(spark, base, "EF", "T3", ["4", "2", "5"])
    publish(spark, base, "AB", "T1", ["1", "6", "6", "6", "5"])
    due = spark.createDataFrame(
        [(i, str(i % 9) if i % 7 else None, "N") for i in range(40)], "APPL_ID long, IMEI string, Notification_Code string"
    )
    overdue = spark.createDataFrame([(3,), (3,), (14,)], "APPL_ID long")
    from sendgate.session import keep

    due = keep(due, "due")
    history = C.read_published(spark, base, "batches", S.BATCHES, DAY)
    for business in ("AB", "CD", "ZZ"):
        plain = eligibility_cascade(due, overdue, history, DAY, business, **options)
        parts = K.history_parts(spark, base, DAY)
        found = cascade_over_parts(due, overdue, parts, business, **options)
        assert found.columns == plain.columns
        assert Counter(map(str, found.collect())) == Counter(map(str, plain.collect()))
