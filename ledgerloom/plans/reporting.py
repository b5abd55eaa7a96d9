"""Reports over the facts and over scored accounts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import as_double, cents, cents_of_double, dollars, mean_of, sum_when
from ledgerloom.operators.tiers import at_risk
from ledgerloom.schemas import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES

# The columns of the rescue list.
RESCUE_COLUMNS = (
    "account_id", "company_name", "industry", "company_size", "country", "plan_name", "current_mrr",
    "churn_probability", "risk_tier", "predicted_12m_clv_usd", "primary_churn_driver", "recommended_action",
)


def payment_rail_summary(transactions: DataFrame) -> DataFrame:
    """Counts, failures, failure rate and volume per payment method, over all time."""
    total, failed = F.sum("total_tx_count"), F.sum("failed_tx_count")
    rate = F.when(total != 0, F.round(as_double(failed) * 100.0 / as_double(total), 2))
    return transactions.groupBy("payment_method").agg(
        total.alias("total_transactions"),
        failed.alias("total_failures"),
        rate.alias("failure_rate_pct"),
        dollars(F.sum(cents(F.col("gross_payment_volume_usd")))).alias("total_volume_usd"),
    )


def _history(facts: DataFrame, day: str, columns: Sequence[str], account_id: str | None) -> DataFrame:
    """Rows of one account, or of all, in time order. On a bucketed table a lookup reads one bucket of each month; the sort is
    distributed by ranges of (account, day)."""
    if account_id is not None:
        return facts.where(F.col("account_id") == F.lit(account_id)).select(day, *columns).orderBy(day)
    return facts.select("account_id", day, *columns).orderBy("account_id", day)


def balance_history(balances: DataFrame, account_id: str | None = None) -> DataFrame:
    return _history(balances, "balance_date", ["closing_balance_usd"], account_id)


def transaction_history(transactions: DataFrame, account_id: str | None = None) -> DataFrame:
    columns = ["gross_payment_volume_usd", "failed_tx_count", "total_tx_count"]
    return _history(transactions, "transaction_date", columns, account_id)


def account_demographics(accounts: DataFrame, plans: DataFrame) -> DataFrame:
    """Every account with its plan and churn flag."""
    terms = plans.select(F.col("plan_id").alias("current_plan_id"), "plan_name", F.col("monthly_fee").alias("mrr"))
    return accounts.join(terms, "current_plan_id").select(
        "account_id", "industry", "company_size", "country", "plan_name",
        as_double(F.col("mrr")).alias("mrr"),
        "is_churned",
        as_double(F.col("initial_deposit_usd")).alias("initial_deposit_usd"),
    )


def overall_churn(accounts: DataFrame) -> DataFrame:
    return accounts.agg(
        F.count(F.lit(1)).alias("accounts"),
        F.avg("is_churned").alias("churn_rate"),
    )


def churn_rate_by(accounts: DataFrame, *segments: str) -> DataFrame:
    """Churn rate with its 95% interval, per value of each segment column, in one aggregation.

    Every account is expanded to one row per segment column; the counts are folded before the shuffle.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(s).alias("segment"), F.col(s).alias("value")) for s in segments)))
    rate = F.col("churned") / F.col("accounts")
    half = F.sqrt(F.col("churn_rate") * (1 - F.col("churn_rate")) / F.col("accounts")) * 1.96
    return (
        accounts.select(pairs.alias("pair"), "is_churned")
        .groupBy("pair.segment", "pair.value")
        .agg(F.count(F.lit(1)).alias("accounts"), F.sum("is_churned").alias("churned"))
        .withColumn("churn_rate", rate)
        .withColumn("ci_low", F.round(F.greatest(F.col("churn_rate") - half, F.lit(0.0)), 6))
        .withColumn("ci_high", F.round(F.least(F.col("churn_rate") + half, F.lit(1.0)), 6))
    )


# Replicates that one digest gives, 16 bits each.
PER_DIGEST = 8


def poisson_steps(bits: int = 16) -> list[int]:
    """Where a uniform number of so many bits passes from one count of a Poisson draw with mean 1 to the next."""
    steps, total, term = [], 0.0, math.exp(-1.0)
    for count in range(1, 20):
        total += term
        if int(total * (1 << bits)) >= (1 << bits) - 1:
            break
        steps.append(int(total * (1 << bits)))
        term /= count
    return steps


def bootstrap_churn_rate(accounts: DataFrame, *segments: str, replicates: int = 200, seed: int = 42) -> DataFrame:
    """Churn rate with its bootstrap interval (2.5th and 97.5th percentile) per value of each segment column.

    Poisson bootstrap: in each replicate an account counts as often as a Poisson draw with mean 1 says, which is a function of account,
    replicate and seed. So nothing is resampled: rows are folded to segment value and replicate before the shuffle, every run draws
    the same, and a lost task draws again what it drew before. ``replicates`` is rounded up to a multiple of 8.
    """
    digest = F.md5(F.concat("account_id", F.lit(f":{seed}:"), F.col("_block").cast("string")))
    draw = F.conv(F.expr("substring(_digest, _slot * 4 + 1, 4)"), 16, 10).cast("int")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(-(-replicates // PER_DIGEST) - 1)))
    pairs = F.explode(F.array(*(F.struct(F.lit(s).alias("segment"), F.col(s).alias("value")) for s in segments)))
    drawn = (
        accounts.select("account_id", "is_churned", *segments, blocks.alias("_block"))
        .select("is_churned", *segments, "_block", digest.alias("_digest"))
        .select("is_churned", *segments, "_block", "_digest", F.explode(F.sequence(F.lit(0), F.lit(PER_DIGEST - 1))).alias("_slot"))
        .select("is_churned", *segments, "_block", "_slot", draw.alias("_draw"))
    )
    times = reduce(Column.__add__, ((F.col("_draw") >= step).cast("int") for step in poisson_steps()))
    rates = (
        drawn.withColumn("_times", times)
        .where("_times > 0")
        .select(pairs.alias("pair"), "is_churned", "_block", "_slot", "_times")
        .groupBy("pair.segment", "pair.value", "_block", "_slot")
        .agg(F.sum("_times").alias("n"), F.sum(F.col("_times") * F.col("is_churned")).alias("churned"))
        .groupBy("segment", "value")
        .agg(
            F.round(F.percentile(F.col("churned") / F.col("n"), F.lit(0.025)), 6).alias("boot_low"),
            F.round(F.percentile(F.col("churned") / F.col("n"), F.lit(0.975)), 6).alias("boot_high"),
        )
    )
    known = churn_rate_by(accounts, *segments).select("segment", "value", "accounts", "churn_rate")
    same = (F.col("k.segment") == F.col("r.segment")) & F.col("k.value").eqNullSafe(F.col("r.value"))
    return known.alias("k").join(rates.alias("r"), same, "left").select("k.*", "boot_low", "boot_high")


def feature_label_correlation(features: DataFrame) -> DataFrame:
    """Pearson correlation of every numeric feature and category dummy with the label, ascending.

    Every account is expanded to one row per numeric feature, and the moments are folded before the shuffle, one row a feature and
    task; dummies need only counts per category. The first category in alphabetical order is the base level and has no dummy.
    A constant column has no correlation (NULL).
    """
    values = ", ".join(f"named_struct('feature', '{n}', 'x', double({n}))" for n in NUMERIC_FEATURES)
    numeric = (
        features.selectExpr(f"double({LABEL}) AS y", f"inline(array({values}))")
        .groupBy("feature")
        .agg(F.covar_pop("x", "y").alias("c"), (F.stddev_pop("x") * F.stddev_pop("y")).alias("spread"))
        .selectExpr("feature", "if(spread > 0, c / spread, NULL) AS corr")
    )
    return numeric.unionByName(_dummy_correlation(features)).selectExpr(
        "feature", "round(corr, 4) AS corr"
    ).orderBy("corr", "feature")


def _dummy_correlation(features: DataFrame) -> DataFrame:
    """Phi coefficient of each category level with the label, from whole-number counts."""
    levels = (
        _levels(features, LABEL)
        .groupBy("name", "level")
        .agg(F.expr("count(1) AS n1"), F.expr(f"sum({LABEL}) AS n11"))
    )
    # Levels are few, so their totals and the base level come from a second small aggregation.
    totals = levels.groupBy("name").agg(
        F.expr("double(sum(n1)) AS n"), F.expr("double(sum(n11)) AS y1"), F.expr("min(level) AS base")
    )
    return (
        levels.join(totals, "name")
        .where("level <> base")
        .selectExpr(
            "concat(name, '_', level) AS feature",
            "n * n11 - n1 * y1 AS c",
            "sqrt(n1 * (n - n1)) * sqrt(y1 * (n - y1)) AS spread",
        )
        .selectExpr("feature", "if(spread > 0, c / spread, NULL) AS corr")
    )


def _levels(features: DataFrame, *keep: str) -> DataFrame:
    """One row per account and category column: its name and level."""
    pairs = ", ".join(f"named_struct('name', '{c}', 'level', {c})" for c in CATEGORICAL_FEATURES)
    return features.selectExpr(*keep, f"inline(array({pairs}))")


def one_hot_categories(features: DataFrame) -> DataFrame:
    """Each account's non-base categories as dummy names, long form: (account_id, dummy)."""
    long = _levels(features, "account_id")
    # One row per category column.
    bases = long.groupBy("name").agg(F.min("level").alias("base"))
    return (
        long.join(F.broadcast(bases), "name")
        .where(F.col("level") != F.col("base"))
        .select("account_id", F.concat_ws("_", "name", "level").alias("dummy"))
    )


def scored_accounts_enriched(scores: DataFrame, accounts: DataFrame, plans: DataFrame) -> DataFrame:
    """All score columns plus company, segment and plan."""
    company = accounts.select("account_id", "company_name", "industry", "company_size", "country", "current_plan_id")
    terms = plans.select(
        F.col("plan_id").alias("current_plan_id"), "plan_name", as_double(F.col("monthly_fee")).alias("current_mrr")
    )
    return (
        scores.alias("s")
        .join(company.alias("a"), "account_id")
        .join(terms.alias("p"), "current_plan_id")
        .select("s.*", "company_name", "industry", "company_size", "country", "plan_name", "current_mrr")
    )


def executive_kpis(enriched: DataFrame) -> DataFrame:
    """Total MRR, annual revenue at risk, critical and at-risk counts, accounts and mean predicted value."""
    mrr, value = cents_of_double(F.col("current_mrr")), cents_of_double(F.col("predicted_12m_clv_usd"))
    risky = at_risk(F.col("risk_tier"))
    return enriched.agg(
        dollars(F.sum(mrr)).alias("total_mrr"),
        (dollars(sum_when(risky, mrr)) * 12.0).alias("at_risk_arr"),
        F.count_if(F.col("risk_tier") == "Critical").alias("critical_accounts"),
        F.count_if(risky).alias("at_risk_accounts"),
        F.count(F.lit(1)).alias("total_accounts"),
        mean_of(F.sum(value), F.count(value)).alias("avg_predicted_12m_clv"),
    )


def tier_distribution(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("account_count"))


def at_risk_summary(enriched: DataFrame) -> DataFrame:
    """One row: accounts scored, accounts per tier, monthly MRR at risk."""
    tier = F.col("risk_tier")
    mrr = cents_of_double(F.col("current_mrr"))
    return enriched.agg(
        F.count(F.lit(1)).alias("total_accounts"),
        *(F.count_if(tier == t).alias(f"{t.lower()}_accounts") for t in ("Critical", "High", "Medium", "Low")),
        dollars(sum_when(at_risk(tier), mrr)).alias("at_risk_mrr"),
    )


def rescue_list(enriched: DataFrame) -> DataFrame:
    """Accounts by falling churn probability; the account id settles ties."""
    return enriched.select(*RESCUE_COLUMNS).orderBy(F.desc("churn_probability"), "account_id")
