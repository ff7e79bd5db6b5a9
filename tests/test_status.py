import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as h

from sendgate import schemas as S
from sendgate.operators import funnel, status as st
from tests import brute

DAY = dt.date(2024, 1, 2)
DUE = "APPL_ID bigint, IMEI string, Notification_Code string"
HISTORY = "IMEI string, business string, run_date date, transaction_id string"

GOLDEN_DUE = [
    (1, None, "N1"), (2, "102", "N1"), (3, "103", "N1"), (4, "104", "N2"), (5, "105", "N2"),
    (6, "106", "N2"), (None, "107", "N1"), (8, "108", "N1"), (8, "108", "N1"), (9, "109", "N1"),
]
GOLDEN_LOANS = [(1, 1, 10.0), (2, 1, 10.0), (2, 2, 20.0), (9, 1, 0.0), (None, 1, 5.0)]
GOLDEN_HISTORY = (
    [("103", "CD")] + [("104", "AB")] * 3 + [("105", "AB")] * 2 + [("106", "CD")] + [("106", "AB")] * 3
)
GOLDEN_STATUS = [
    S.NULL, S.DELINQUENT, S.DUPLICATE_BIZ, S.DUPLICATE_GLOBAL, S.UNIQUE_GLOBAL,
    S.DUPLICATE_BIZ, S.UNIQUE_GLOBAL, S.UNIQUE_GLOBAL, S.UNIQUE_GLOBAL, S.UNIQUE_GLOBAL,
]


def tables(spark, due, loans, history, day=DAY):
    return (
        spark.createDataFrame(due, DUE),
        st.overdue_keys(
            spark.createDataFrame(loans, "APPL_ID bigint, BUCKET int, INSTALLMENT_OVERDUE double")
        ),
        spark.createDataFrame([(i, b, day, f"t{n}") for n, (i, b) in enumerate(history)], HISTORY),
    )


@pytest.fixture
def golden(spark):
    return tables(spark, GOLDEN_DUE, GOLDEN_LOANS, GOLDEN_HISTORY)


def bag(frame):
    return Counter(tuple(row) for row in frame.select(*frame.columns).collect())


def expected_golden():
    return Counter((*row, status) for row, status in zip(GOLDEN_DUE, GOLDEN_STATUS))


def test_golden_cascade(golden):
    due, overdue, history = golden
    got = st.eligibility_cascade(due, overdue, history, DAY, "CD")
    assert got.columns == ["APPL_ID", "IMEI", "Notification_Code", "FILTER_STATUS"]
    assert bag(got) == expected_golden()


def test_golden_steps_with_one_shared_history(golden):
    due, overdue, history = golden
    got = (
        due.transform(st.flag_null_key)
        .transform(st.step_overdue, overdue)
        .transform(st.step_business, history, DAY, "CD")
        .transform(st.step_global_cap, history, DAY)
    )
    assert bag(got) == expected_golden()


def test_golden_steps_shuffled(golden):
    due, overdue, history = golden
    join = {"max_broadcast": 0}
    got = (
        due.transform(st.flag_null_key)
        .transform(st.step_overdue, overdue, **join)
        .transform(st.step_business, history, DAY, "CD", **join)
        .transform(st.step_global_cap, history, DAY, **join)
    )
    assert bag(got) == expected_golden()


def test_golden_eligible_only(golden):
    due, overdue, history = golden
    status = st.eligibility_cascade(due, overdue, history, DAY, "CD")
    only = st.eligible_only(due, overdue, history, DAY, "CD")
    assert bag(st.eligible(status)) == bag(only)


def test_golden_fanout_counts_one_more_row(golden):
    due, overdue, history = golden
    got = st.eligibility_cascade(due, overdue, history, DAY, "CD", dedupe_keys=False)
    copies = {(*row, 2 if row[0] == 2 else 1) for row in expected_golden()}
    assert set(bag(got)) == copies and got.count() == 10
    totals = funnel.funnel_conservation(due, got).first()
    assert (totals["rows_in"], totals["rows_labelled"], totals["conserved"]) == (10, 11, False)


def test_golden_funnel_json(golden):
    due, overdue, history = golden
    got = funnel.funnel_totals(st.eligibility_cascade(due, overdue, history, DAY, "CD")).first()
    assert got["CG_COUNT"] == 10 and got["ELIGIBLE_COUNT"] == 5
    assert got["TRANSFORMATIONS"] == (
        '{"DELINQUENT":1,"DUPLICATE_BIZ":2,"DUPLICATE_GLOBAL":1,"NULL":1,"UNIQUE_GLOBAL":5}'
    )


def test_history_of_another_day_or_of_the_run_itself(spark, golden):
    due, overdue, history = golden
    other = DAY + dt.timedelta(days=1)
    got = st.eligibility_cascade(due, overdue, history, other, "CD")
    assert {row[3] for row in got.collect()} == {S.NULL, S.DELINQUENT, S.UNIQUE_GLOBAL}
    own = spark.createDataFrame([("103", "CD", DAY, "mine")], HISTORY)
    kept = st.eligibility_cascade(due, overdue, own, DAY, "CD", exclude="mine")
    assert S.DUPLICATE_BIZ not in {row[3] for row in kept.collect()}


def test_audit_rows_count_towards_the_cap(spark, golden):
    due, overdue, history = golden
    plain = st.eligibility_cascade(due, overdue, history, DAY, "CD")
    compat = st.eligibility_cascade(due, overdue, history, DAY, "CD", include_audit=history)
    changed = {row[1] for row in (bag(compat) - bag(plain))}
    assert changed == {"105"}  # sent twice, counted four times
    stepwise = st.capped_keys(history, DAY, include_audit=history)
    assert bag(stepwise) == Counter({("104", 6): 1, ("105", 4): 1, ("106", 8): 1})


def test_missing_status_is_left_alone(spark):
    frame = spark.createDataFrame([(1, None), (2, "NOT_NULL")], "k bigint, FILTER_STATUS string")
    keys = spark.createDataFrame([(1,), (2,)], "k bigint")
    got = st.status_step(frame, keys, "k", "HIT", "MISS", ["NULL"])
    assert bag(got) == Counter({(1, None): 1, (2, "HIT"): 1})


def test_normalise(spark):
    raw = spark.createDataFrame(
        [
            (" 0356.0 ", "0356", "1"), ("7", "3.56789E14", "N"), ("x", "nan", None),
            ("9223372036854775808", "35678901234567890", "N"), (None, None, "N"), ("", " ", ""),
            ("7.9", "-3.9", "N"),
        ],
        "LOAN_OVERVIEW_APPL_ID string, LOAN_OVERVIEW_IMEI string, Notification_Code string",
    )
    assert [tuple(row) for row in st.normalise_due(raw).collect()] == [
        (356, "356", "1"), (7, "356789000000000", "N"), (None, None, None),
        (None, "35678901234567890", "N"), (None, None, "N"), (None, None, ""),
        (7, "-3", "N"),
    ]


imeis = h.one_of(h.none(), h.sampled_from(["1", "2", "3", "4", "5"]))
loan_ids = h.one_of(h.none(), h.integers(1, 6))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    due=h.lists(h.tuples(loan_ids, imeis, h.sampled_from(["A", "B"])), min_size=1, max_size=30),
    loans=h.lists(h.tuples(loan_ids, h.integers(0, 1), h.sampled_from([0.0, 5.0])), max_size=10),
    history=h.lists(h.tuples(imeis, h.sampled_from(["CD", "AB"])), max_size=15),
    max_broadcast=h.sampled_from([-1, 2, 1_000]),
)
def test_cascade_equals_brute_force(spark, due, loans, history, max_broadcast):
    frames = tables(spark, due, loans, history)
    limits = {"max_broadcast": max_broadcast}
    expected = Counter(brute.status_of(due, brute.overdue_ids(loans), history, "CD"))
    assert bag(st.eligibility_cascade(*frames, DAY, "CD", **limits)) == expected
    kept = Counter(row[:3] for row in expected.elements() if row[3] == S.UNIQUE_GLOBAL)
    assert bag(st.eligible_only(*frames, DAY, "CD", **limits)) == kept
