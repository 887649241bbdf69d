"""Queries of the column functions over texts and numbers derived from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.oracle import exact, frame, month, status, week
from checks.registry import Inputs, query
from mediatide.functions import dates, metrics, numbers, text
from mediatide.operators.attribution import channel_of
from mediatide.operators.fields import Feed

_KEYS = "l_orderkey, l_linenumber"
_CASE = "(l_orderkey + l_linenumber) % 10"

# One kind of text per remainder.
_NUMBER_TEXT = f"""
SELECT {_KEYS}, CASE {_CASE} WHEN 0 THEN CAST(l_linenumber AS STRING) || '.75' WHEN 1 THEN '' WHEN 2 THEN 'abc'
  WHEN 3 THEN 'nan' WHEN 4 THEN '-inf' WHEN 5 THEN CAST(l_linenumber AS STRING) || '_000' WHEN 6 THEN '1.5d'
  WHEN 7 THEN ' -12.5 ' WHEN 8 THEN NULL ELSE CAST(l_partkey AS STRING) END AS v FROM lineitem"""


@query(
    "C6 C7 C8",
    f"""SELECT {_KEYS}, {_CASE} = 3 AS is_nan,
  CAST(CASE {_CASE} WHEN 0 THEN l_linenumber + 0.75 WHEN 5 THEN l_linenumber * 1000 WHEN 7 THEN -12.5 WHEN 9 THEN l_partkey
    ELSE 0 END AS DOUBLE) AS as_double,
  CAST(CASE {_CASE} WHEN 0 THEN l_linenumber WHEN 5 THEN l_linenumber * 1000 WHEN 7 THEN -12 WHEN 9 THEN l_partkey
    ELSE 0 END AS BIGINT) AS as_long,
  CAST(CASE {_CASE} WHEN 0 THEN l_linenumber WHEN 5 THEN l_linenumber * 1000 WHEN 7 THEN -12 WHEN 9 THEN l_partkey
    END AS BIGINT) AS long_or_null,
  CAST(CASE {_CASE} WHEN 5 THEN l_linenumber * 1000 WHEN 9 THEN l_partkey END AS BIGINT) AS whole_number
FROM lineitem""",
)
def scalar_numbers(i: Inputs) -> DataFrame:
    rows = i.raw(_NUMBER_TEXT)
    f = Feed(rows)
    value = f.double("v")
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        F.isnan(value).alias("is_nan"),
        F.when(odd, 0.0).otherwise(value).alias("as_double"),
        f.long("v").alias("as_long"),
        f.long_or_null("v").alias("long_or_null"),
        numbers.parse_integer(F.col("v")).alias("whole_number"),
    )


_FLAG_TEXT = f"""
SELECT {_KEYS}, CASE {_CASE} WHEN 0 THEN 'true' WHEN 1 THEN ' TRUE ' WHEN 2 THEN '1' WHEN 3 THEN 'Yes' WHEN 4 THEN 'no'
  WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'false' ELSE CAST(l_partkey AS STRING) END AS v FROM lineitem"""


@query(
    "C9 C10 C11 C12",
    f"""SELECT {_KEYS}, {_CASE} <= 3 OR ({_CASE} >= 8 AND l_partkey = 1) AS yes, {_CASE} = 0 AS exactly_true,
  {_CASE} NOT IN (5, 6) AS has_text, l_partkey % 2 = 1 AS truth FROM lineitem""",
)
def scalar_flags(i: Inputs) -> DataFrame:
    rows = i.raw(_FLAG_TEXT.replace(" FROM lineitem", ", l_partkey % 2 = 1 AS odd FROM lineitem"))
    f = Feed(rows)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        text.says_yes(f.text("v", default="false")).alias("yes"),
        text.is_exactly_true(F.col("v")).alias("exactly_true"),
        text.has_text(F.col("v")).alias("has_text"),
        f.flag("odd").alias("truth"),
    )


_PADDED = f"""
SELECT {_KEYS}, CASE {_CASE} WHEN 0 THEN '  ' || l_returnflag || ' x ' WHEN 1 THEN '   ' WHEN 2 THEN ''
  WHEN 3 THEN NULL ELSE l_returnflag || 'b' || CAST(l_partkey AS STRING) || ' ' END AS v,
  CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T10:00:00Z' AS at_text FROM lineitem"""


@query(
    "C15 C17 C18 C19 C20",
    f"""SELECT {_KEYS}, TRIM(v) AS trimmed, NULLIF(TRIM(v), '') AS blank_to_null, LOWER(TRIM(v)) AS lowered,
  UPPER(TRIM(v)) AS raised, substring(at_text, 1, 10) AS day_text, TRIM(v) || '_organic_api' AS built
FROM ({_PADDED}) AS padded""",
)
def scalar_text(i: Inputs) -> DataFrame:
    v = F.col("v")
    return i.raw(_PADDED).select(
        "l_orderkey",
        "l_linenumber",
        numbers.trimmed(v).alias("trimmed"),
        text.null_if_blank(v).alias("blank_to_null"),
        text.lower_trimmed(v).alias("lowered"),
        text.upper_trimmed(v).alias("raised"),
        F.substring("at_text", 1, 10).alias("day_text"),
        F.concat(numbers.trimmed(v), F.lit("_organic_api")).alias("built"),
    )


@query(
    "C1 C2 C3 C5 C16",
    f"""SELECT {_KEYS}, l_quantity / NULLIF(l_linenumber - 3, 0) AS or_null,
  COALESCE(l_quantity / NULLIF(l_linenumber - 3, 0), 0) AS or_zero,
  l_quantity / CASE WHEN l_linenumber = 3 THEN 1 ELSE l_linenumber - 3 END AS floor_one,
  COALESCE(CAST(l_orderkey AS DOUBLE) / NULLIF(l_linenumber - 1, 0), 0) AS whole_numbers FROM lineitem""",
    "or_null or_zero floor_one whole_numbers",
)
def scalar_ratios(i: Inputs) -> DataFrame:
    c = F.col
    a, b = c("l_quantity"), c("l_linenumber") - 3
    return i.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.ratio(a, b).alias("or_null"),
        numbers.ratio_or_zero(a, b).alias("or_zero"),
        numbers.ratio_floor_one(a, b).alias("floor_one"),
        numbers.ratio_or_zero(c("l_orderkey"), c("l_linenumber") - 1).alias("whole_numbers"),
    )


# Eighths give true ties at two digits; a quotient by 160 gives apparent ones at four.
_EIGHTHS = "CAST(l_orderkey % 1000 AS DOUBLE) / CAST(8 AS DOUBLE)"
_APPARENT = "CAST(l_partkey % 1000 AS DOUBLE) / CAST(160 AS DOUBLE)"


@query(
    "C22 C23",
    f"""SELECT {_KEYS}, ROUND({_EIGHTHS}, 2) AS half_up, {frame(_EIGHTHS, 2)} AS tie_even,
  {frame(_APPARENT, 4)} AS scaled_even, {exact(_APPARENT, 4)} AS exact_even,
  {exact('l_extendedprice / l_quantity / 7', 5)} AS exact_quotient FROM lineitem""",
    "half_up tie_even scaled_even exact_even exact_quotient",
)
def scalar_rounding(i: Inputs) -> DataFrame:
    c = F.col
    eighths = (c("l_orderkey") % 1000).cast("double") / 8
    apparent = (c("l_partkey") % 1000).cast("double") / 160
    quotient = c("l_extendedprice") / c("l_quantity") / 7
    return i.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.round_half_up(eighths, 2).alias("half_up"),
        numbers.round_frame(eighths, 2).alias("tie_even"),
        numbers.round_frame(apparent, 4).alias("scaled_even"),
        numbers.round_exact(apparent, 4).alias("exact_even"),
        numbers.round_exact(quotient, 5).alias("exact_quotient"),
    )


_DAYS = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN NULL
  ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:00:00' END AS day_text, o_orderkey * 86399 - 40000000 AS seconds
FROM orders"""


@query(
    "C28 C29 C30 C31 C32",
    f"""SELECT o_orderkey, {month('day')} AS month, {week('day')} AS week,
  CAST(date_trunc('month', day - INTERVAL 2 MONTH) AS DATE) AS two_months_back,
  CASE WHEN o_orderkey % 5 >= 3 THEN day END AS parsed, CAST(make_timestamp(seconds * 1000000) AS DATE) AS unix_day
FROM ({_DAYS}) AS days""",
)
def scalar_dates(i: Inputs) -> DataFrame:
    day = F.col("day")
    rows = i.raw(_DAYS)
    return rows.select(
        "o_orderkey",
        dates.month_start(day).alias("month"),
        dates.week_start(day).alias("week"),
        dates.months_back(day, 2).alias("two_months_back"),
        dates.iso_day(F.col("day_text")).alias("parsed"),
        dates.unix_day(F.col("seconds")).alias("unix_day"),
    )


_PAYLOADS = """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'bad{' WHEN 1 THEN '' WHEN 2 THEN NULL
  WHEN 3 THEN '{"value_usd": ' || CAST(event_id AS STRING) || ', "revenue": 1}'
  WHEN 4 THEN '{"revenue": "' || CAST(event_id AS STRING) || '.5"}' WHEN 5 THEN '[1, 2]' ELSE props END AS v,
  CASE event_id % 4 WHEN 0 THEN '[]' WHEN 1 THEN '[{"value":"' || CAST(event_id AS STRING) || '.25"}]'
  WHEN 2 THEN CAST(event_id AS STRING) || '.5' ELSE NULL END AS actions,
  CASE event_id % 3 WHEN 0 THEN 'apple_search_ads' WHEN 1 THEN 'googleadwords_int' ELSE event_type END AS source
FROM events"""


@query(
    "C33 C34 C35 C36",
    f"""SELECT event_id, CASE event_id % 7 WHEN 3 THEN CAST(event_id AS STRING) WHEN 4 THEN CAST(event_id AS STRING) || '.5' END AS first_of_two,
  CASE event_id % 7 WHEN 6 THEN json_extract_string(v, '$.k') END AS k,
  CAST(CASE event_id % 4 WHEN 1 THEN event_id + 0.25 WHEN 2 THEN event_id + 0.5 ELSE 0 END AS DOUBLE) AS action_value,
  CASE event_id % 3 WHEN 0 THEN 'Apple Search Ads' WHEN 1 THEN 'Google UAC' ELSE source END AS channel
FROM ({_PAYLOADS}) AS payloads""",
    "action_value",
)
def scalar_json(i: Inputs) -> DataFrame:
    parsed = text.json_fields(F.col("v"), ["value_usd", "revenue", "k"])
    rows = i.raw(_PAYLOADS).withColumn("_j", parsed)
    j = lambda name: F.col("_j").getField(name)
    return rows.select(
        "event_id",
        F.coalesce(j("value_usd"), j("revenue")).alias("first_of_two"),
        j("k").alias("k"),
        text.first_action_value(F.col("actions")).alias("action_value"),
        channel_of(F.col("source")).alias("channel"),
    )


_RATE = "CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(l_orderkey % 9 AS DOUBLE) / CAST(100 AS DOUBLE) END"


@query(
    "C26 C27 C38",
    f"""SELECT {_KEYS}, funnel_status, CASE WHEN funnel_status = 'at_risk' AND l_partkey >= 100 THEN 'ALERT: High volume, low CVR'
  WHEN funnel_status = 'watch' THEN 'Monitor' ELSE 'OK' END AS action, l_returnflag IN ('A', 'R') AS returned
FROM (SELECT *, {status(_RATE)} AS funnel_status FROM lineitem)""",
)
def scalar_case(i: Inputs) -> DataFrame:
    remainder = F.col("l_orderkey") % 9
    rate: Column = F.when(remainder != 0, remainder.cast("double") / 100)
    rows = i.table("lineitem").withColumn("funnel_status", metrics.funnel_status(rate))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "funnel_status",
        metrics.action_required(F.col("funnel_status"), F.col("l_partkey")).alias("action"),
        F.col("l_returnflag").isin("A", "R").alias("returned"),
    )


_GAPS = f"""
SELECT {_KEYS}, CASE WHEN {_CASE} < 3 THEN l_partkey END AS a, CASE WHEN {_CASE} < 6 THEN l_suppkey END AS b,
  CASE WHEN {_CASE} < 5 THEN l_orderkey % 7 - 3 END AS score FROM lineitem"""


@query(
    "C13 C14 C25",
    f"""SELECT {_KEYS}, COALESCE(a, b, 0) AS chained, COALESCE(CAST(a AS STRING), 'Post') AS with_default,
  COALESCE(b, greatest(COALESCE(score, 0) * 4, 1)) AS reach, CAST(0 AS BIGINT) AS absent FROM ({_GAPS}) AS gaps""",
)
def scalar_defaults(i: Inputs) -> DataFrame:
    rows = i.raw(_GAPS)
    f = Feed(rows)
    estimated = F.greatest(f.long("score") * 4, F.lit(1).cast("bigint"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        f.long("a", "b").alias("chained"),
        f.text("a", default="Post").alias("with_default"),
        f.long("b", default=estimated).alias("reach"),
        f.long("not_there").alias("absent"),
    )
