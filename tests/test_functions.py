"""Golden values of column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewright.functions import checks, cleaning
from tablewright.operators import incremental, measures, stages


def values(spark, function, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_decimals(spark):
    assert [None if v is None else str(v) for v in values(spark, cleaning.clean_decimal, ["1,234,567.89", "£1,234.56", "-3,000.00", "n/a", "1-2", None])] == ["1234567.89", "1234.56", "-3000.00", None, None, None]


def test_postcodes(spark):
    assert values(spark, cleaning.clean_uk_postcode, ["ab12cd", "SW1A1AA", "  m1  1ae  ", None]) == ["AB1 2CD", "SW1A 1AA", "M1 1AE", None]


def test_emails(spark):
    assert values(spark, cleaning.mask_email, ["john.doe@example.com", "none", None]) == ["j***@example.com", "none", None]


def test_dates(spark):
    d = dt.date
    got = values(spark, cleaning.parse_mixed_date, ["46024", "46024.75", "2024-02-29", "2024-02-29 10:00:00.123", "31/12/2023 01:02:03", "31/12/2023", "01/02/24", "2024/03/04", "31/02/2024", "x", None])
    assert got == [d(2026, 1, 2), d(2026, 1, 2), d(2024, 2, 29), d(2024, 2, 29), d(2023, 12, 31), d(2023, 12, 31), d(2024, 2, 1), d(2024, 3, 4), None, None, None]


def test_names(spark):
    assert values(spark, cleaning.clean_contact_name, ["Smith, Jane", "Acme - Dr. John  Doe", "Ms Ann Lee"]) == ["Jane Smith", "John Doe", "Ann Lee"]
    assert values(spark, cleaning.clean_company_name, [" big  co & sons ltd", "Acme Limited", "X, Inc."]) == ["BIG CO AND SONS", "ACME", "X,"]
    assert values(spark, cleaning.sanitize_name, [" A b-C ", "--", None]) == ["a_b_c", None, None]


@pytest.mark.parametrize(
    ("name", "period"),
    [("sales_20240105.csv", "240105"), ("sales-240105.csv", "240105"), ("x 240105 y.csv", "240105"), ("x_240105_y.csv", None), ("sept 2024.csv", "240901"), ("20241399.csv", None), ("march-2024.csv", "240301"), ("2024 Mar.csv", "240301"), ("rep 2412.csv", "241201"), ("rep 2413.csv", None), ("none.csv", None), ("may-2024.csv", "240501")],
)
def test_periods(spark, name, period):
    assert values(spark, cleaning.extract_period, [name]) == [period]


def test_excluded(spark):
    df = spark.createDataFrame([("a_draft.csv", "draft, old"), ("a.csv", "draft,"), ("a.csv", "")], "n string, p string")
    assert [r.y for r in df.select(cleaning.excluded(F.col("n"), F.col("p")).alias("y")).collect()] == [True, False, False]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "k int, s string")
    out, bad = checks.in_set(df, "s", ["a"])
    assert sorted(r.k for r in out.collect()) == [1, 2] and [r.k for r in bad.collect()] == [3]
    out, bad = checks.not_null(df, "s", "fill", "?")
    assert sorted(r.s for r in out.collect()) == ["?", "a", "z"]
    assert checks.violations(bad, ["k"], "s", "not_null").collect()[0].asDict() == {"k": 2, "column_name": "s", "rule_name": "not_null", "value_s": None}


def test_delta_load(spark):
    rows = [("A", "2024-01-01"), ("A", "2024-01-05"), ("A", "2024-01-10"), ("B", "2024-01-02"), ("B", "2024-01-08"), ("C", "2024-01-15")]
    out = stages.delta_load(spark.createDataFrame(rows, "k string, d string"), ["k"], "d", "2024-01-02")
    assert sorted(map(tuple, out.collect())) == [("A", "2024-01-10"), ("B", "2024-01-08"), ("C", "2024-01-15")]


def test_flow(spark):
    rows = [("a", 1, 10), ("a", 3, 5), (None, 1, 7), ("b", 4, 0)]
    out = stages.previous_period(spark.createDataFrame(rows, "k string, p int, v int"), ["k"], "p", "v")
    got = sorted(((r.k or "~", r.p, r.v, r.previous_amount, r.is_lost_key) for r in out.collect()))
    assert got == [("a", 1, 10, None, False), ("a", 3, 5, 10, False), ("a", 4, 0, 5, True), ("b", 4, 0, None, False), ("~", 1, 7, None, False), ("~", 3, 0, 7, True)]


def test_prior_month_runs_over(spark):
    day = F.lit("2001-03-31").cast("date")
    test = measures.WINDOWS["pmtd"].test
    got = spark.range(1).select(*[test(F.lit(d).cast("date"), day).alias(d) for d in ("2001-02-01", "2001-03-03", "2001-03-04")]).collect()[0]
    assert list(got) == [True, True, False]


def test_marks():
    assert incremental.chosen_mark(dt.date(2024, 5, 1), None, dt.date(2024, 4, 1)) == dt.date(2024, 4, 1)
    assert incremental.chosen_mark(dt.date(2024, 5, 1), None, dt.date(2024, 6, 1)) == dt.date(2024, 5, 1)
    assert incremental.chosen_mark(None, "2024-01-02") == dt.date(2024, 1, 2)
