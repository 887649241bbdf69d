import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediatide.functions import dates, metrics, numbers, text


def python_float(value):
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


TEXTS = [
    "12.7", "", "abc", "nan", "NaN", "inf", "-Infinity", "1_000", "1__0", "_1", "1_", "1.5d", "1.5f", "0x1p3", "0x10",
    " 12 ", "\t3\n", "+4", "-.5", "5.", ".", "1e5", "1E-3", "1e", "1_0.0_1", "--1", "1,5", "True", "１２", None,
    "123456789012", "1e400", " 7 ",
]


def test_texts_are_numbers_when_python_says_so(spark, rows):
    # Digits of other scripts are the one exception: they are read by Python only.
    cases = [t for t in TEXTS if t != "１２"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(cases)], "n int, t string")
    got = {r["n"]: r for r in rows(df.select("n", numbers.parse_double(F.col("t")).alias("v"),
                                             numbers.truncate_long(numbers.parse_double(F.col("t"))).alias("i")))}
    for n, case in enumerate(cases):
        wanted = python_float(case)
        value = got[n]["v"]
        if wanted is not None and math.isnan(wanted):
            assert math.isnan(value), case
        else:
            assert value == wanted, case
        finite = wanted is not None and math.isfinite(wanted)
        assert got[n]["i"] == (int(wanted) if finite else None), case


def test_whole_number_text(spark, rows):
    cases = ["12", " -3 ", "1.5", "1_0", "", None, "x", "12d"]
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = [r["v"] for r in rows(df.select(numbers.parse_integer(F.col("t")).alias("v")))]
    assert got == [12, -3, None, 10, None, None, None, None]


@pytest.mark.parametrize("digits", [1, 2, 4, 5, 6])
def test_rounding_against_python_and_numpy(spark, digits):
    rng = random.Random(digits)
    values = [rng.uniform(-1000, 1000) for _ in range(3000)]
    values += [k / 160 for k in range(-400, 2000)] + [k / 1000 for k in range(3000)] + [k / 8 for k in range(500)]
    values += [(2 * k + 1) / (2 * 10**digits) for k in range(3000)] + [0.15, 2.675, 1.005, 0.12345]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v",
        numbers.round_exact(F.col("v"), digits).alias("exact"),
        numbers.round_frame(F.col("v"), digits).alias("frame"),
    )
    for v, exact, frame in got.collect():
        assert exact == round(v, digits), v
        assert frame == np.round(v, digits), v


def test_ratio_kinds(spark, rows):
    df = spark.createDataFrame([(6, 3), (6, 0), (0, 0), (None, 2)], "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    got = rows(df.select(numbers.ratio(a, b).alias("n"), numbers.ratio_or_zero(a, b).alias("z"),
                         numbers.ratio_floor_one(a, b).alias("o")))
    assert [(r["n"], r["z"], r["o"]) for r in got] == [(2.0, 2.0, 2.0), (None, 0.0, 6.0), (None, 0.0, 0.0), (None, 0.0, None)]


def test_money_total_is_the_same_for_every_order(spark):
    amounts = [round(random.Random(5).uniform(0, 500), 2) for _ in range(1)] + [n / 100 for n in range(20000)]
    totals = set()
    for parts in (1, 3, 8, 32):
        df = spark.createDataFrame([(a,) for a in amounts], "v double").repartition(parts)
        totals.add(df.agg(numbers.money_sum(F.col("v"))).first()[0])
    assert totals == {round(sum(round(a * 100) for a in amounts) / 100, 2)}
    odd = spark.createDataFrame([(4e-7,)] * 1000 + [(float("nan"),), (None,), (1e13,), (-9.2e12,)], "v double")
    assert odd.agg(numbers.money_sum(F.col("v"))).first()[0] == 8e11 + 4e-4
    assert odd.where("v IS NULL").agg(numbers.money_sum(F.col("v"))).first()[0] is None
    with pytest.raises(Exception, match="money out of range"):
        spark.createDataFrame([(1.0,), (float("inf"),)], "v double").agg(numbers.money_sum(F.col("v"))).collect()


def test_flags(spark, rows):
    cases = ["true", " TRUE ", "1", "yes", "no", "", None, "false"]
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    t = F.col("t")
    got = rows(df.select(text.says_yes(t).alias("y"), text.is_exactly_true(t).alias("e"), text.has_text(t).alias("h")))
    assert [r["y"] for r in got] == [True, True, True, True, False, False, None, False]
    assert [r["e"] for r in got] == [True] + [False] * 7
    assert [r["h"] for r in got] == [True, True, True, True, True, False, False, True]


def test_trim_takes_all_white_space(spark):
    df = spark.createDataFrame([("\t x \n",), (" ",)], "t string")
    got = [r[0] for r in df.select(text.null_if_blank(F.col("t"))).collect()]
    assert got == ["x", None]


def test_json(spark, rows):
    cases = ['{"a": 1}', '{"a": "x", "b": null}', "bad{", "", None, "[1]", '{"a": 1', "{'a': 1}", '{"a": 1} tail', '{"a": {"c": 2}}']
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = [r["j"]["a"] for r in rows(df.select(F.coalesce(text.json_fields(F.col("t"), ["a", "b"]), F.struct(
        F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))).alias("j")))]
    assert got == ["1", "x", None, None, None, None, None, None, None, '{"c":2}']


def test_first_action_value(spark):
    cases = ["[]", '[{"value":"1.23"},{"value":"9"}]', '[{"action_type":"x"}]', "0.5", "abc", None]
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert [r[0] for r in df.select(text.first_action_value(F.col("t"))).collect()] == [0.0, 1.23, 0.0, 0.5, 0.0, 0.0]


def test_days(spark, rows):
    df = spark.createDataFrame([("2025-01-05T23:59:59Z", 1736121599), ("", -1), ("2025-13-01", 0), (None, None)], "t string, s bigint")
    got = rows(df.select(dates.iso_day(F.col("t")).alias("d"), dates.unix_day(F.col("s")).alias("u")))
    assert [r["d"] for r in got] == [dt.date(2025, 1, 5), None, None, None]
    assert [r["u"] for r in got] == [dt.date(2025, 1, 5), dt.date(1969, 12, 31), dt.date(1970, 1, 1), None]
    weeks = spark.sql("SELECT DATE '2025-01-05' AS sunday, DATE '2025-01-06' AS monday").select(
        dates.week_start(F.col("sunday")), dates.week_start(F.col("monday")), dates.months_back(F.col("sunday"), 2))
    assert list(weeks.first()) == [dt.date(2024, 12, 30), dt.date(2025, 1, 6), dt.date(2024, 11, 1)]


def test_days_do_not_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = spark.sql("SELECT 1736121600L AS s").select(dates.unix_day(F.col("s"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.date(2025, 1, 6)


def test_status_and_action(spark):
    df = spark.createDataFrame([(0.05, 1), (0.04996, 500), (0.03, 1), (0.029, 99), (0.029, 100), (None, 100)], "r double, n bigint")
    status = metrics.funnel_status(F.col("r"))
    got = [tuple(r) for r in df.select(status, metrics.action_required(status, F.col("n"))).collect()]
    alert = "ALERT: High volume, low CVR"
    assert got == [("healthy", "OK"), ("watch", "Monitor"), ("watch", "Monitor"), ("at_risk", "OK"), ("at_risk", alert), ("at_risk", alert)]
