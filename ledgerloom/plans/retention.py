"""Cohort retention: logos and revenue by months since signup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_start, months_crossed
from ledgerloom.functions.numbers import as_double, cents, dollars


def _cohorts(accounts: DataFrame) -> DataFrame:
    return accounts.select("account_id", month_start(F.col("signup_date")).alias("cohort_month"))


def _paid(subscriptions: DataFrame) -> DataFrame:
    """Months that were paid: (account_id, billing_month, mrr in cents)."""
    return subscriptions.where((F.col("mrr_amount") > 0) & (F.col("billing_status") == "Paid")).select(
        "account_id", "billing_month", cents(F.col("mrr_amount")).alias("mrr")
    )


def _month_number() -> Column:
    return months_crossed(F.col("cohort_month"), F.col("billing_month"))


def _cohort_activity(accounts: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Active accounts and paid cents per (cohort, month number).

    The panel is shuffled once, by account for the join. The fold to one row per account and month needs no
    further shuffle, and counting its rows is counting distinct accounts. An account holds one row per billed
    month; should one break that grain, adaptive execution splits its share of the join.
    """
    return (
        _paid(subscriptions).join(_cohorts(accounts), "account_id")
        .where(F.col("cohort_month").isNotNull())
        .groupBy("account_id", "cohort_month", _month_number().alias("month_number"))
        .agg(F.sum("mrr").alias("mrr"))
        .groupBy("cohort_month", "month_number")
        .agg(F.count(F.lit(1)).alias("active_accounts"), F.sum("mrr").alias("retained"))
    )


def cohort_retention(accounts: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Logo and net-revenue retention against the accounts that paid in month 0.

    A cohort nobody of which paid in its signup month does not appear.
    """
    cohort = Window.partitionBy("cohort_month")  # a few hundred aggregated rows, one per month number
    at_signup = lambda column: F.max(F.when(F.col("month_number") == 0, F.col(column))).over(cohort)
    percent = lambda part, whole: F.round(as_double(part) * 100.0 / as_double(whole), 2)
    return (
        _cohort_activity(accounts, subscriptions)
        .withColumns({"cohort_total_accounts": at_signup("active_accounts"), "starting": at_signup("retained")})
        .where(F.col("starting").isNotNull())
        .select(
            "cohort_month",
            "cohort_total_accounts",
            F.round(dollars(F.col("starting")), 2).alias("cohort_starting_mrr"),
            "month_number",
            "active_accounts",
            F.round(dollars(F.col("retained")), 2).alias("retained_mrr"),
            percent(F.col("active_accounts"), F.col("cohort_total_accounts")).alias("logo_retention_pct"),
            percent(dollars(F.col("retained")), dollars(F.col("starting"))).alias("net_revenue_retention_pct"),
        )
        .orderBy("cohort_month", "month_number")
    )


def cohort_logo_retention(accounts: DataFrame, subscriptions: DataFrame, last_month: int = 12) -> DataFrame:
    """Share of all signed-up accounts that paid, for the first months after signup.

    Accounts are read once: each brings its paid months and one row without a month, which counts the signups.
    """
    first_months = F.when(_month_number() <= last_month, _month_number())
    months = (
        _cohorts(accounts).where(F.col("cohort_month").isNotNull())
        .join(_paid(subscriptions), "account_id", "left")
        .groupBy("account_id", "cohort_month")
        .agg(F.collect_set(first_months).alias("months"))
        .select("cohort_month", F.explode(F.concat(F.array(F.lit(None).cast("int")), "months")).alias("month_idx"))
        .groupBy("cohort_month", "month_idx")
        .agg(F.count(F.lit(1)).alias("accounts"))
    )
    cohort = Window.partitionBy("cohort_month")  # one row for each month number
    signed_up = F.max(F.when(F.col("month_idx").isNull(), F.col("accounts"))).over(cohort)
    share = F.round(as_double(F.col("accounts")) * 100.0 / F.col("signed_up"), 1)
    return (
        months.withColumn("signed_up", signed_up)
        .where(F.col("month_idx").isNotNull())
        .select(
            F.date_format("cohort_month", "yyyy-MM-dd").alias("cohort_month"), "month_idx", share.alias("retention_pct")
        )
        .orderBy("cohort_month", "month_idx")
    )


def cohort_retention_matrix(accounts: DataFrame, subscriptions: DataFrame, last_month: int = 12) -> DataFrame:
    """The same shares, one row per cohort and one column per month since signup.

    The column list is given, so the pivot needs no extra pass to find it.
    """
    months = list(range(last_month + 1))
    wide = (
        cohort_logo_retention(accounts, subscriptions, last_month)
        .groupBy("cohort_month")
        .pivot("month_idx", months)
        .agg(F.first("retention_pct"))
    )
    return wide.select("cohort_month", *(F.col(str(m)).alias(f"month_{m}") for m in months)).orderBy("cohort_month")
