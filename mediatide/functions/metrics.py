"""Business metrics.  `div` picks what a zero denominator gives: `ratio` or `ratio_or_zero`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mediatide.functions.numbers import ratio

Divide = Callable[[Column, Column], Column]


def cost_per_mille(cost: Column, impressions: Column, div: Divide = ratio) -> Column:
    return div(cost, impressions) * 1000


def paid_efficiency(cost: str, value: str, div: Divide = ratio) -> list[Column]:
    """cpm, cpc, ctr, cpi, cps and roas from a row's or group's own totals."""
    c = F.col
    return [
        cost_per_mille(c(cost), c("impressions"), div).alias("cpm"),
        div(c(cost), c("clicks")).alias("cpc"),
        div(c("clicks"), c("impressions")).alias("ctr"),
        div(c(cost), c("installs")).alias("cpi"),
        div(c(cost), c("conversions")).alias("cps"),
        div(c(value), c(cost)).alias("roas"),
    ]


# Share of subscriptions per install at which a channel counts as healthy or to be watched.
HEALTHY_FROM = 0.05
WATCH_FROM = 0.03
# Installs from which an at-risk channel raises an alert.
ALERT_INSTALLS = 100


def funnel_status(rate: Column) -> Column:
    """NULL rates (nothing to divide by) count as at risk."""
    return (
        F.when(rate >= HEALTHY_FROM, "healthy").when(rate >= WATCH_FROM, "watch").otherwise("at_risk")
    )


def action_required(status: Column, installs: Column) -> Column:
    return (
        F.when((status == "at_risk") & (installs >= ALERT_INSTALLS), "ALERT: High volume, low CVR")
        .when(status == "watch", "Monitor")
        .otherwise("OK")
    )
