"""Joins of attribution with spend and with in-app events.

No join here pairs two raw row sets.  Spend meets installs after both are aggregated to the
join's grain.  Events meet installs either as they are against one install per user (the
result has the size of the events, and a heavy user is split by AQE), or reduced to
one row per user and day first, so a user holding a third of all events contributes at most
one row per day.  Rows without a user id are dropped before any shuffle: the blank id would
be the heaviest key of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediatide.functions.dates import month_start
from mediatide.functions.numbers import money_sum, ratio
from mediatide.functions.text import lookup, null_if_blank

# The attribution channel of each ad platform.
CHANNEL_OF_PLATFORM = {
    "tiktok": "TikTok Ads",
    "instagram_meta": "Meta Ads",
    "reddit": "Reddit Ads",
}
REVENUE_DAYS = (30, 60, 90)
RETENTION_DAYS = (30, 90)
# Months that one payment of a plan covers; other plans count as paid by the month.
PLAN_MONTHS = {"annual": 12, "family": 12}
STARTED, RENEWED, CANCELLED = "subscription_started", "subscription_renewed", "subscription_cancelled"
INVITED = "friend_invited"


def _user() -> Column:
    return null_if_blank(F.col("customer_user_id"))


def ltv_to_cac(cohorts: DataFrame, performance: DataFrame) -> DataFrame:
    """Value per install over spend per attributed install, by month and channel.

    Installs are those of the attribution feed; a channel without spend has no ratio.
    """
    c = F.col
    value = cohorts.groupBy("cohort_month", "channel").agg(
        F.sum("installs").alias("installs"), money_sum(c("cohort_revenue_usd")).alias("revenue_usd")
    )
    spend = performance.groupBy(
        month_start(c("date")).alias("cohort_month"),
        lookup(CHANNEL_OF_PLATFORM, c("platform")).alias("channel"),
    ).agg(money_sum(F.col("cost_usd")).alias("spend_usd"))
    joined = value.join(spend, ["cohort_month", "channel"], "left")
    return joined.select(
        "*",
        ratio(c("revenue_usd"), c("installs")).alias("ltv_per_install"),
        ratio(c("spend_usd"), c("installs")).alias("cac"),
    ).withColumn("ltv_to_cac", ratio(c("ltv_per_install"), c("cac")))


def campaign_acquisition(staged_installs: DataFrame, staged_paid: DataFrame) -> DataFrame:
    """Attributed installs and value next to what the platforms report, per campaign id."""
    attributed = staged_installs.groupBy("campaign_id").agg(
        F.count("*").alias("attributed_installs"),
        F.count_if("subscribed").alias("subscriptions"),
        money_sum(F.col("subscription_value_usd")).alias("revenue_usd"),
    )
    reported = staged_paid.groupBy("campaign_id").agg(
        money_sum(F.col("cost_usd")).alias("spend_usd"),
        F.sum("clicks").alias("clicks"),
        F.sum("installs").alias("reported_installs"),
    )
    return attributed.join(reported, "campaign_id", "left").withColumn(
        "cost_per_attributed_install", ratio(F.col("spend_usd"), F.col("attributed_installs"))
    )


def joinable_installs(installs: DataFrame) -> DataFrame:
    """Installs that may be matched to events: no SKAN rows, and a user id is known."""
    user = _user()
    return installs.where(~F.col("is_skan") & user.isNotNull()).withColumn("customer_user_id", user)


def first_installs(installs: DataFrame) -> DataFrame:
    """Each user's first install (by day, then id) of those whose day is known.

    The day is found by a hash aggregation over all installs; a text cannot be in one, so the
    tie among a user's installs of that day is settled over those rows only.
    """
    known = joinable_installs(installs).where("install_date IS NOT NULL")
    days = known.groupBy("customer_user_id").agg(F.min("install_date").alias("_first"))
    rows = known.select("customer_user_id", "install_date", "appsflyer_id", "channel")
    same_day = _join_users(rows, days, "inner").where("install_date = _first")
    first = F.min(F.struct("install_date", "appsflyer_id", "channel")).alias("first")
    return same_day.groupBy("customer_user_id").agg(first).select("customer_user_id", "first.*")


def _join_users(rows: DataFrame, users: DataFrame, how: str) -> DataFrame:
    """Joins rows with one row per user, so that a user with a third of all rows is split.

    AQE splits a heavy partition only where both inputs of a join come straight from a
    shuffle.  `users` comes from an aggregation by the same key and would be joined in place,
    with a heavy user's rows in one task.  A key that is computed makes Spark shuffle the
    small side once more.
    """
    key = F.concat(F.col("customer_user_id"), F.lit("/"))
    keyed = users.withColumn("_user", key).drop("customer_user_id")
    return rows.withColumn("_user", key).join(keyed, "_user", how).drop("_user")


def attributed_events(events: DataFrame, installs: DataFrame) -> DataFrame:
    """Every event of a user with a joinable install, with the day and channel of that install."""
    users = first_installs(installs).select(
        "customer_user_id", "install_date", F.col("channel").alias("install_channel")
    )
    known = events.withColumn("customer_user_id", _user()).where("customer_user_id IS NOT NULL")
    return _join_users(known, users, "inner")


def installs_with_events(installs: DataFrame, events: DataFrame) -> DataFrame:
    """Joinable installs whose user has any event."""
    users = events.select(_user().alias("customer_user_id")).dropna().distinct()
    return _join_users(joinable_installs(installs), users, "left_semi")


def _user_days(events: DataFrame) -> DataFrame:
    """One row per user and day with that day's revenue."""
    return (
        events.select(_user().alias("customer_user_id"), "event_date", "revenue_usd")
        .dropna(subset=["customer_user_id", "event_date"])
        .groupBy("customer_user_id", "event_date")
        .agg(money_sum(F.col("revenue_usd")).alias("revenue_usd"))
    )


def _user_ages(installs: DataFrame, events: DataFrame) -> DataFrame:
    """Users with their cohort, and the age in days of each of their active days."""
    users = first_installs(installs).withColumn("cohort_month", month_start(F.col("install_date")))
    joined = users.join(_user_days(events), "customer_user_id", "left")
    return joined.withColumn("age", F.datediff("event_date", "install_date"))


def cohort_revenue(installs: DataFrame, events: DataFrame) -> DataFrame:
    """Event revenue within 30, 60 and 90 days of the first install, by cohort and channel."""
    age = F.col("age")
    names = [f"revenue_{n}d" for n in REVENUE_DAYS]
    windows = [
        money_sum(F.when((age >= 0) & (age <= n), F.col("revenue_usd"))).alias(name)
        for n, name in zip(REVENUE_DAYS, names)
    ]
    # Same key as the join, so this step needs no shuffle of its own.
    per_user = _user_ages(installs, events).groupBy("customer_user_id", "cohort_month", "channel").agg(*windows)
    return per_user.groupBy("cohort_month", "channel").agg(
        F.count("*").alias("users"), *(F.coalesce(money_sum(F.col(n)), F.lit(0.0)).alias(n) for n in names)
    )


def retention(installs: DataFrame, events: DataFrame) -> DataFrame:
    """Share of a cohort's users with an event exactly 30 and 90 days after the first install."""
    marks = [F.max(F.col("age") == n).alias(f"d{n}") for n in RETENTION_DAYS]
    per_user = _user_ages(installs, events).groupBy("customer_user_id", "cohort_month", "channel").agg(*marks)
    counts = per_user.groupBy("cohort_month", "channel").agg(
        F.count("*").alias("users"),
        *(F.count_if(f"d{n}").alias(f"retained_d{n}") for n in RETENTION_DAYS),
    )
    rates = (ratio(F.col(f"retained_d{n}"), F.col("users")).alias(f"d{n}_retention") for n in RETENTION_DAYS)
    return counts.select("*", *rates)


def subscription_months(events: DataFrame) -> DataFrame:
    """Recurring revenue, churn and win-backs per month.

    A user counts as subscribed after a month whose last subscription event is a start or a
    renewal.  Churned: subscribed before the month, not after it.  Won back: the reverse, for
    a user seen before.  The churn rate is over the users subscribed when the month began.
    The state is kept per user and month, so a user's window has one row per month.
    """
    c = F.col
    subs = events.where(c("event_name").isin(STARTED, RENEWED, CANCELLED)).select(
        _user().alias("user"),
        month_start(c("event_date")).alias("month"),
        F.coalesce(c("event_timestamp").try_cast("timestamp"), c("event_date").cast("timestamp")).alias("time"),
        "event_name",
        "revenue_usd",
        "subscription_plan",
    )
    subs = subs.where("month IS NOT NULL")
    months_paid = F.lit(1.0)
    for plan, months in PLAN_MONTHS.items():
        months_paid = F.when(c("subscription_plan") == plan, F.lit(float(months))).otherwise(months_paid)
    paid = c("event_name") != CANCELLED
    revenue = subs.groupBy("month").agg(
        F.count_if(c("event_name") == STARTED).alias("started"),
        F.count_if(c("event_name") == RENEWED).alias("renewed"),
        F.count_if(c("event_name") == CANCELLED).alias("cancelled"),
        F.coalesce(money_sum(F.when(paid, c("revenue_usd") / months_paid)), F.lit(0.0)).alias("mrr_usd"),
    )

    # The last event by its time, at equal times by its name, as one number: a hash aggregation holds it.
    names = sorted((STARTED, RENEWED, CANCELLED))
    code = F.lit(0)
    for place, name in enumerate(names):
        code = F.when(c("event_name") == name, F.lit(place)).otherwise(code)
    last = F.max(F.unix_micros("time") * 4 + code)
    active = F.pmod(last, F.lit(4)) != names.index(CANCELLED)
    states = subs.where("user IS NOT NULL").groupBy("user", "month").agg(active.alias("active"))
    before = F.lag("active").over(Window.partitionBy("user").orderBy("month"))
    changes = states.withColumn("before", before).groupBy("month").agg(
        F.count_if(c("active") & c("before").isNull()).alias("new_subscribers"),
        F.count_if(c("active") & ~c("before")).alias("won_back"),
        F.count_if(~c("active") & c("before")).alias("churned"),
    )
    # One row per month by now, so an ungrouped window is small whatever the input.
    joined = revenue.join(changes, "month", "left").fillna(0, ["new_subscribers", "won_back", "churned"])
    earlier = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    gained = c("new_subscribers") + c("won_back") - c("churned")
    opened = F.coalesce(F.sum(gained).over(earlier), F.lit(0)).alias("subscribers_at_start")
    return joined.select("*", opened).withColumn(
        "churn_rate", ratio(c("churned"), c("subscribers_at_start"))
    )


def user_months(events: DataFrame) -> DataFrame:
    """user, month, days: the days of the month on which the user was active, as bits of one number (the first day is bit 0).

    One number a user and month combines before the shuffle, whatever the number of events.
    """
    day = F.col("event_date")
    rows = events.select(
        _user().alias("user"), month_start(day).alias("month"), F.expr("shiftleft(1, dayofmonth(event_date) - 1)").alias("bit")
    ).dropna()
    return rows.groupBy("user", "month").agg(F.bit_or("bit").alias("days"))


def active_users(events: DataFrame) -> DataFrame:
    """Daily and monthly active users and their ratio, per day."""
    on_day = [F.count_if(F.col("days").bitwiseAND(F.lit(1 << d)) != 0) for d in range(31)]
    monthly = user_months(events).groupBy("month").agg(F.count("*").alias("mau"), F.array(*on_day).alias("counts"))
    daily = monthly.select("mau", F.posexplode("counts").alias("day", "dau"), "month").where("dau > 0")
    return daily.select(
        F.date_add("month", F.col("day")).alias("date"), "dau", "mau", ratio(F.col("dau"), F.col("mau")).alias("dau_over_mau")
    )


def _monthly_users(events: DataFrame) -> DataFrame:
    pairs = events.select(_user().alias("user"), month_start(F.col("event_date")).alias("month")).dropna().distinct()
    return pairs.groupBy("month").agg(F.count("*").alias("mau"))


def viral_coefficient(events: DataFrame) -> DataFrame:
    """Invitations sent per active user, by month."""
    c = F.col
    invites = (
        events.where((c("event_name") == INVITED) & c("event_date").isNotNull())
        .groupBy(month_start(c("event_date")).alias("month"))
        .agg(F.count("*").alias("invites"))
    )
    joined = _monthly_users(events).join(invites, "month", "left").fillna(0, ["invites"])
    return joined.withColumn("viral_coefficient", ratio(c("invites"), c("mau")))
