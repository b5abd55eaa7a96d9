"""The registered queries once more, as DuckDB SQL over the sample tables.

Each text is written for its own sake (self-joins on row numbers, cross joins over the threshold grid, rank
sums) and shares no code with the Spark side.
"""

from __future__ import annotations

from itertools import combinations
from math import factorial

# The star schema over the sample tables; the three plans are fixed values.
VIEWS = {
    "dim_plans": """
        SELECT * FROM (VALUES
            (1, 'Starter', CAST(99 AS DECIMAL(10,2)), CAST(0.019 AS DECIMAL(6,4)), 5, 120),
            (2, 'Growth', CAST(499 AS DECIMAL(10,2)), CAST(0.015 AS DECIMAL(6,4)), 25, 600),
            (3, 'Enterprise', CAST(1999 AS DECIMAL(10,2)), CAST(0.011 AS DECIMAL(6,4)), 100, 3000)
        ) AS p(plan_id, plan_name, monthly_fee, take_rate_pct, included_seats, api_rate_limit_per_min)""",
    "fact_subscriptions": """
        SELECT 'ACC-' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS account_id,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS billing_month,
               CAST(1 + o_custkey % 3 AS INTEGER) AS plan_id,
               CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END)
                    AS DECIMAL(18,2)) AS mrr_amount,
               CASE WHEN max(o_orderstatus) = 'F' THEN 'Churned'
                    WHEN min(o_orderstatus) = 'P' THEN 'Failed' ELSE 'Paid' END AS billing_status
        FROM orders GROUP BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE)""",
    "dim_accounts": """
        SELECT 'ACC-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS account_id,
               c_name AS company_name, c_mktsegment AS industry,
               CASE WHEN c_acctbal < 2500 THEN 'Small (1-20)' WHEN c_acctbal < 5000 THEN 'Mid-Market (21-100)'
                    WHEN c_acctbal < 7500 THEN 'Enterprise (101-500)' ELSE 'Large Enterprise (500+)' END
                    AS company_size,
               n_name AS country,
               CAST(1 + c_custkey % 3 AS INTEGER) AS initial_plan_id,
               CAST(1 + c_custkey % 3 AS INTEGER) AS current_plan_id,
               f.signup_date, CAST(c_acctbal AS DECIMAL(18,2)) AS initial_deposit_usd,
               x.churn_date, CAST(CASE WHEN x.churn_date IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_churned
        FROM customer
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS signup_date
                   FROM orders GROUP BY o_custkey) f ON f.o_custkey = c_custkey
        LEFT JOIN (SELECT account_id, min(billing_month) AS churn_date FROM fact_subscriptions
                   WHERE billing_status = 'Churned' GROUP BY account_id) x
               ON x.account_id = 'ACC-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')""",
    "fact_transactions": """
        SELECT account_id, transaction_date, payment_method, total_tx_count,
               total_tx_count - failed_tx_count AS successful_tx_count, failed_tx_count,
               gross_payment_volume_usd,
               CAST(round(gross_payment_volume_usd * take_rate_pct, 2) AS DECIMAL(18,2)) AS fees_collected_usd
        FROM (SELECT 'ACC-' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS account_id,
                     CAST(l_shipdate AS DATE) AS transaction_date,
                     CASE l_returnflag WHEN 'A' THEN 'Credit Card' WHEN 'N' THEN 'ACH Direct Debit'
                                       WHEN 'R' THEN 'Wire Transfer' END AS payment_method,
                     CAST(1 + o_custkey % 3 AS INTEGER) AS plan_id,
                     CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS total_tx_count,
                     CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(floor(l_quantity * l_discount) AS INTEGER)
                                   ELSE 0 END) AS INTEGER) AS failed_tx_count,
                     CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2))
                         AS gross_payment_volume_usd
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) b
        JOIN dim_plans USING (plan_id)""",
    "event_days": """
        SELECT 'ACC-' || lpad(CAST(user_id * 10 + event_id % 10 AS VARCHAR), 9, '0') AS account_id,
               CAST(DATE '1996-08-05' + CAST(3 * date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER)
                    AS DATE) AS day,
               event_id, event_type, value
        FROM events""",
    "fact_daily_balances": """
        SELECT account_id, day AS balance_date,
               CAST(max_by(value, event_id) AS DECIMAL(18,2)) AS closing_balance_usd
        FROM event_days GROUP BY account_id, day""",
    "fact_telemetry": """
        SELECT account_id, day AS log_date,
               CAST(count(*) FILTER (event_type IN ('click', 'view')) AS INTEGER) AS api_call_count,
               CAST(count(*) FILTER (event_type = 'signup') AS INTEGER) AS dashboard_logins,
               CAST(count(*) FILTER (event_type = 'purchase') AS INTEGER) AS exports_count
        FROM event_days GROUP BY account_id, day""",
}

# Steps shared by several queries: the movement panel, cohort activity, the feature store and what follows it.
CUTOFF = "DATE '1996-10-31'"


def _transaction_features(cutoff: str, source: str = "fact_transactions", key: str = "account_id") -> str:
    day = f"transaction_date BETWEEN {cutoff} - 30 AND {cutoff}"
    rails = ",\n".join(
        f"""CAST(coalesce(sum(gross_payment_volume_usd) FILTER ({day} AND payment_method = '{rail}'), 0) AS DOUBLE)
                AS {p}_vol_30d,
            CAST(coalesce(sum(failed_tx_count) FILTER ({day} AND payment_method = '{rail}'), 0) AS BIGINT)
                AS {p}_failed_30d,
            CAST(coalesce(sum(total_tx_count) FILTER ({day} AND payment_method = '{rail}'), 0) AS BIGINT)
                AS {p}_total_30d"""
        for p, rail in (("card", "Credit Card"), ("ach", "ACH Direct Debit"), ("wire", "Wire Transfer"))
    )
    return f"""
        SELECT {key},
            CAST(coalesce(sum(gross_payment_volume_usd) FILTER ({day}), 0) AS DOUBLE) AS tx_volume_30d,
            CAST(coalesce(sum(total_tx_count) FILTER ({day}), 0) AS BIGINT) AS tx_count_30d,
            CAST(coalesce(sum(failed_tx_count) FILTER ({day}), 0) AS BIGINT) AS failed_tx_count_30d,
            CAST(coalesce(sum(fees_collected_usd) FILTER ({day}), 0) AS DOUBLE) AS fees_collected_30d,
            CAST(sum(gross_payment_volume_usd) AS DOUBLE) AS tx_volume_90d,
            CAST(sum(total_tx_count) AS BIGINT) AS tx_count_90d,
            CAST(sum(failed_tx_count) AS BIGINT) AS failed_tx_count_90d,
            CAST(sum(fees_collected_usd) AS DOUBLE) AS fees_collected_90d,
            {rails}
        FROM {source} WHERE transaction_date BETWEEN {cutoff} - 90 AND {cutoff} GROUP BY {key}"""


def _balance_features(cutoff: str, source: str = "fact_daily_balances", key: str = "account_id") -> str:
    recent = f"balance_date >= {cutoff} - 30"
    return f"""
        SELECT {key},
            CAST(max(closing_balance_usd) FILTER (balance_date = {cutoff}) AS DOUBLE) AS current_balance_usd,
            CAST(sum(closing_balance_usd) FILTER ({recent}) AS DOUBLE) / count(*) FILTER ({recent})
                AS avg_balance_30d,
            stddev_samp(CAST(closing_balance_usd AS DOUBLE)) FILTER ({recent}) AS balance_volatility_30d,
            CAST(sum(closing_balance_usd) AS DOUBLE) / count(*) AS avg_balance_90d
        FROM {source} WHERE balance_date BETWEEN {cutoff} - 90 AND {cutoff} GROUP BY {key}"""


def _telemetry_features(cutoff: str, source: str = "fact_telemetry", key: str = "account_id") -> str:
    recent = f"log_date >= {cutoff} - 30"
    return f"""
        SELECT {key},
            CAST(coalesce(sum(api_call_count) FILTER ({recent}), 0) AS BIGINT) AS api_calls_30d,
            CAST(coalesce(sum(dashboard_logins) FILTER ({recent}), 0) AS BIGINT) AS logins_30d,
            CAST(coalesce(sum(exports_count) FILTER ({recent}), 0) AS BIGINT) AS exports_30d,
            CAST(sum(api_call_count) AS BIGINT) AS api_calls_90d,
            CAST(sum(dashboard_logins) AS BIGINT) AS logins_90d,
            CAST(min(date_diff('day', log_date, {cutoff})) FILTER (api_call_count > 0) AS INTEGER)
                AS days_since_last_api_call,
            CAST(min(date_diff('day', log_date, {cutoff})) FILTER (dashboard_logins > 0) AS INTEGER)
                AS days_since_last_login
        FROM {source} WHERE log_date BETWEEN {cutoff} - 90 AND {cutoff} GROUP BY {key}"""


def _active(cutoff: str, extra: str = "", source: str = "dim_accounts") -> str:
    return f"""
        SELECT {extra} account_id, industry, company_size, country, current_plan_id,
               CAST(monthly_fee AS DOUBLE) AS current_mrr, CAST(take_rate_pct AS DOUBLE) AS take_rate_pct,
               signup_date, CAST(initial_deposit_usd AS DOUBLE) AS initial_deposit_usd, churn_date,
               CAST(date_diff('day', signup_date, {cutoff}) AS INTEGER) AS tenure_days,
               CAST(CASE WHEN churn_date BETWEEN {cutoff} + 1 AND {cutoff} + 60 THEN 1 ELSE 0 END AS INTEGER)
                   AS churn_next_60d
        FROM {source} JOIN dim_plans ON plan_id = current_plan_id
        WHERE signup_date <= {cutoff} AND (churn_date IS NULL OR churn_date > {cutoff})"""


def _store(key: str, spine: str, tx: str, bal: str, tel: str) -> str:
    shares = ",\n".join(
        f"""CASE WHEN tx_volume_30d > 0 THEN round({p}_vol_30d / tx_volume_30d, 4) ELSE 0.0::DOUBLE END
                AS {p}_vol_share_30d,
            CASE WHEN {p}_total_30d > 0 THEN round({p}_failed_30d::DOUBLE / {p}_total_30d::DOUBLE, 4)
                 ELSE 0.0::DOUBLE END AS {p}_failure_rate_30d"""
        for p in ("card", "ach", "wire")
    )
    return f"""
        SELECT {key}, industry, company_size, country, tenure_days, current_plan_id, current_mrr, take_rate_pct,
            initial_deposit_usd,
            coalesce(tx_volume_30d, 0.0::DOUBLE) AS tx_volume_30d,
            coalesce(tx_volume_90d, 0.0::DOUBLE) AS tx_volume_90d,
            coalesce(tx_count_30d, 0) AS tx_count_30d, coalesce(tx_count_90d, 0) AS tx_count_90d,
            coalesce(fees_collected_30d, 0.0::DOUBLE) AS fees_collected_30d,
            coalesce(fees_collected_90d, 0.0::DOUBLE) AS fees_collected_90d,
            CASE WHEN tx_volume_90d > 0 THEN round(tx_volume_30d / (tx_volume_90d / 3.0::DOUBLE), 4)
                 ELSE 1.0::DOUBLE END AS tx_volume_velocity_ratio,
            CASE WHEN tx_count_30d > 0 THEN round(failed_tx_count_30d::DOUBLE / tx_count_30d::DOUBLE, 4)
                 ELSE 0.0::DOUBLE END AS failed_tx_rate_30d,
            {shares},
            coalesce(current_balance_usd, initial_deposit_usd) AS current_balance_usd,
            coalesce(avg_balance_30d, initial_deposit_usd) AS avg_balance_30d,
            coalesce(avg_balance_90d, initial_deposit_usd) AS avg_balance_90d,
            round(coalesce(balance_volatility_30d, 0.0::DOUBLE), 4) AS balance_volatility_30d,
            CASE WHEN avg_balance_90d > 0
                 THEN round((coalesce(avg_balance_30d, 0.0::DOUBLE) - avg_balance_90d) / avg_balance_90d, 4)
                 ELSE 0.0::DOUBLE END AS balance_decay_pct,
            coalesce(api_calls_30d, 0) AS api_calls_30d, coalesce(api_calls_90d, 0) AS api_calls_90d,
            coalesce(logins_30d, 0) AS logins_30d, coalesce(logins_90d, 0) AS logins_90d,
            coalesce(exports_30d, 0) AS exports_30d,
            coalesce(days_since_last_api_call, 90) AS days_since_last_api_call,
            coalesce(days_since_last_login, 90) AS days_since_last_login,
            CASE WHEN api_calls_90d > 0 THEN round(api_calls_30d::DOUBLE / (api_calls_90d::DOUBLE / 3.0::DOUBLE), 4)
                 ELSE 1.0::DOUBLE END AS telemetry_velocity_ratio,
            churn_next_60d
        FROM {spine} LEFT JOIN {tx} USING ({key}) LEFT JOIN {bal} USING ({key}) LEFT JOIN {tel} USING ({key})"""


STEPS = VIEWS | {
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY billing_month) AS n
        FROM fact_subscriptions""",
    # The previous row by a self-join on row numbers.
    "movements": """
        SELECT c.account_id, c.billing_month, c.mrr_amount AS cur, c.billing_status AS status,
               CASE WHEN c.n = 1 THEN 0 ELSE p.mrr_amount END AS prev,
               CASE WHEN c.n = 1 THEN 'None' ELSE p.billing_status END AS prev_status
        FROM numbered c LEFT JOIN numbered p ON p.account_id = c.account_id AND p.n = c.n - 1""",
    "buckets": """
        SELECT *, CASE WHEN prev = 0 AND cur > 0 THEN cur ELSE 0 END AS new_mrr,
               CASE WHEN prev > 0 AND cur > prev THEN cur - prev ELSE 0 END AS expansion_mrr,
               CASE WHEN prev > 0 AND cur > 0 AND cur < prev THEN prev - cur ELSE 0 END AS contraction_mrr,
               CASE WHEN prev > 0 AND (cur = 0 OR status = 'Churned') THEN prev ELSE 0 END AS churned_mrr
        FROM movements""",
    "monthly": """
        SELECT billing_month, sum(new_mrr) AS a, sum(expansion_mrr) AS b, sum(contraction_mrr) AS c,
               sum(churned_mrr) AS d, sum(cur) AS e
        FROM buckets GROUP BY billing_month""",
    "cohort_rows": """
        SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month, s.account_id, s.mrr_amount,
               CAST(date_diff('month', CAST(date_trunc('month', signup_date) AS DATE), billing_month) AS INTEGER)
                   AS month_number
        FROM dim_accounts a JOIN fact_subscriptions s ON a.account_id = s.account_id
        WHERE mrr_amount > 0 AND billing_status = 'Paid'""",
    "logo_shares": """
        SELECT strftime(cohort_month, '%Y-%m-%d') AS cohort_month, month_number AS month_idx,
               round(CAST(count(DISTINCT account_id) AS DOUBLE) * 100.0::DOUBLE / signed_up, 1) AS retention_pct
        FROM cohort_rows JOIN (
            SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month, count(*) AS signed_up
            FROM dim_accounts GROUP BY 1) USING (cohort_month)
        WHERE month_number <= 12 GROUP BY cohort_month, month_number, signed_up""",
    "active": _active(CUTOFF),
    "tx": _transaction_features(CUTOFF),
    "bal": _balance_features(CUTOFF),
    "tel": _telemetry_features(CUTOFF),
    "store": _store("account_id", "active", "tx", "bal", "tel"),
    "cutoffs": """
        SELECT * FROM (VALUES (DATE '1996-08-31'), (DATE '1996-09-30'), (DATE '1996-10-31')) AS v(cutoff_date)""",
    "weeks": "SELECT CAST(unnest(generate_series(DATE '1996-05-03', DATE '1996-05-03' + 25 * 7, INTERVAL 7 DAY)) AS DATE) AS cutoff_date",
    "active_w": _active("cutoff_date", "cutoff_date,", "weeks CROSS JOIN dim_accounts"),
    "tx_w": _transaction_features("cutoff_date", "fact_transactions CROSS JOIN weeks", "account_id, cutoff_date"),
    "bal_w": _balance_features("cutoff_date", "fact_daily_balances CROSS JOIN weeks", "account_id, cutoff_date"),
    "tel_w": _telemetry_features("cutoff_date", "fact_telemetry CROSS JOIN weeks", "account_id, cutoff_date"),
    "active_p": _active("cutoff_date", "cutoff_date,", "cutoffs CROSS JOIN dim_accounts"),
    "tx_p": _transaction_features("cutoff_date", "fact_transactions CROSS JOIN cutoffs", "account_id, cutoff_date"),
    "bal_p": _balance_features("cutoff_date", "fact_daily_balances CROSS JOIN cutoffs", "account_id, cutoff_date"),
    "tel_p": _telemetry_features("cutoff_date", "fact_telemetry CROSS JOIN cutoffs", "account_id, cutoff_date"),
    "valued": """
        SELECT *, CAST(greatest(round(
                CAST(current_mrr AS DECIMAL(10,2)) * 12
                + CAST(tx_volume_90d AS DECIMAL(18,2)) * CAST(4 * take_rate_pct_d * velocity AS DECIMAL(14,8)), 2),
                CAST(100 AS DECIMAL(10,2))) AS DOUBLE) AS value_12m
        FROM (SELECT *, CAST(take_rate_pct AS DECIMAL(6,4)) AS take_rate_pct_d,
                     CAST(greatest(least(tx_volume_velocity_ratio, 2.5), 0.1) AS DECIMAL(5,4)) AS velocity
              FROM store) x""",
    "parts": """
        SELECT account_id, CAST(failed_tx_rate_30d AS DECIMAL(6,4)) * CAST(1.5 AS DECIMAL(6,4)) AS p1,
               (1 - least(CAST(tx_volume_velocity_ratio AS DECIMAL(18,4)), CAST(1 AS DECIMAL(18,4))))
                   * CAST(0.3 AS DECIMAL(6,4)) AS p2,
               CAST(days_since_last_login AS DECIMAL(6,0)) * CAST(0.003 AS DECIMAL(6,4)) AS p3,
               CAST(greatest(365 - tenure_days, 0) AS DECIMAL(6,0)) * CAST(0.0001 AS DECIMAL(6,4)) AS p4
        FROM store""",
    "scored": """
        SELECT v.*, CAST(round(least(CAST(0.05 AS DECIMAL(6,4)) + p1 + p2 + p3 + p4, 1), 4) AS DOUBLE)
                   AS churn_probability
        FROM valued v JOIN parts USING (account_id)""",
    # Every row against every threshold of the grid.
    "sweep": """
        SELECT threshold, CAST(count(*) FILTER (churn_probability >= threshold) AS BIGINT) AS hits,
               CAST(count(*) FILTER (churn_probability >= threshold AND churn_next_60d = 1) AS BIGINT) AS tp,
               CAST(coalesce(sum(CAST(current_mrr AS DECIMAL(18,2)))
                    FILTER (churn_probability >= threshold AND churn_next_60d = 1), 0) AS DOUBLE)
                   * 12.0::DOUBLE * 0.40::DOUBLE
               - CAST(count(*) FILTER (churn_probability >= threshold) AS DOUBLE) * 350.0::DOUBLE AS net
        FROM scored CROSS JOIN (SELECT k / 100.0::DOUBLE AS threshold FROM range(5, 91) g(k)) t
        GROUP BY threshold""",
    "best": "SELECT * FROM sweep ORDER BY net DESC, threshold LIMIT 1",
    "tiered": """
        SELECT s.*, CASE WHEN churn_probability >= 0.65::DOUBLE
                           OR (churn_probability >= 0.24::DOUBLE AND current_plan_id = 3) THEN 'Critical'
                         WHEN churn_probability >= 0.24::DOUBLE THEN 'High'
                         WHEN churn_probability >= 0.15::DOUBLE THEN 'Medium' ELSE 'Low' END AS risk_tier
        FROM scored s""",
    "drivers": """
        SELECT account_id, max(feature) FILTER (place = 1 AND part > 0) AS first_driver,
               max(feature) FILTER (place = 2 AND part > 0) AS second_driver
        FROM (SELECT account_id, feature, part,
                     row_number() OVER (PARTITION BY account_id ORDER BY part DESC, pos) AS place
              FROM (SELECT account_id, 1 AS pos, 'failed_tx_rate_30d' AS feature, p1 AS part FROM parts
                    UNION ALL SELECT account_id, 2, 'tx_volume_velocity_ratio', p2 FROM parts
                    UNION ALL SELECT account_id, 3, 'days_since_last_login', p3 FROM parts
                    UNION ALL SELECT account_id, 4, 'tenure_days', p4 FROM parts) u) r
        GROUP BY account_id""",
    "words": """
        SELECT account_id,
               CASE first_driver WHEN 'failed_tx_rate_30d' THEN 'Elevated Payment Failure / Decline Rate'
                   WHEN 'tx_volume_velocity_ratio' THEN 'Sharp Drop in Payment Processing Volume'
                   WHEN 'days_since_last_login' THEN 'Extended Portal Inactivity'
                   ELSE 'Elevated ' || coalesce(first_driver, 'general_behavior') END AS primary_churn_driver,
               CASE second_driver WHEN 'failed_tx_rate_30d' THEN 'Elevated Payment Failure / Decline Rate'
                   WHEN 'tx_volume_velocity_ratio' THEN 'Sharp Drop in Payment Processing Volume'
                   WHEN 'days_since_last_login' THEN 'Extended Portal Inactivity'
                   ELSE 'Fluctuations in ' || coalesce(second_driver, 'stable_metrics') END
                   AS secondary_churn_driver,
               CASE first_driver WHEN 'failed_tx_rate_30d'
                   THEN 'Urgent review with Payment Operations to resolve card/ACH processing declines.'
                   WHEN 'tx_volume_velocity_ratio'
                   THEN 'Investigate if merchant is diverting transaction flow to a competing processor.'
                   WHEN 'days_since_last_login'
                   THEN 'Send proactive engagement email highlighting under-utilized analytics features.'
                   ELSE 'Conduct general Customer Success quarterly business review.' END AS recommended_action
        FROM drivers""",
    "served": """
        SELECT account_id, TIMESTAMP '1996-10-31 00:00:00' AS score_timestamp, churn_probability, risk_tier,
               greatest(value_12m, 50.0::DOUBLE) AS predicted_12m_clv_usd,
               CASE WHEN risk_tier IN ('Critical', 'High') THEN primary_churn_driver
                    ELSE 'Stable Usage Patterns' END AS primary_churn_driver,
               CASE WHEN risk_tier IN ('Critical', 'High') THEN secondary_churn_driver
                    ELSE 'Healthy Financial Metrics' END AS secondary_churn_driver,
               CASE WHEN risk_tier IN ('Critical', 'High') THEN recommended_action
                    ELSE 'Routine automated nurture communications.' END AS recommended_action
        FROM tiered JOIN words USING (account_id)""",
    "enriched": """
        SELECT s.*, company_name, industry, company_size, country, plan_name,
               CAST(monthly_fee AS DOUBLE) AS current_mrr
        FROM served s JOIN dim_accounts a ON a.account_id = s.account_id
        JOIN dim_plans ON plan_id = current_plan_id""",
    "hashed": """
        SELECT account_id, churn_next_60d,
               CAST(CAST('0x' || substr(md5(account_id || '42'), 1, 8) AS BIGINT) % 10000 AS INTEGER) AS bucket
        FROM active""",
    "stratified": """
        SELECT account_id, churn_next_60d,
               count(*) OVER (PARTITION BY churn_next_60d ORDER BY bucket)
                   <= round(count(*) OVER (PARTITION BY churn_next_60d) * 0.25::DOUBLE) AS is_test
        FROM hashed""",
    "c_subscriptions": """
        SELECT 'SUB-' || account_id || '-' || strftime(m.billing_month, '%Y%m') AS subscription_id, m.account_id,
               m.billing_month, s.plan_id, cur AS mrr_amount, status AS billing_status,
               CASE WHEN new_mrr > 0 THEN 'New' WHEN expansion_mrr > 0 THEN 'Expansion'
                    WHEN contraction_mrr > 0 THEN 'Contraction' WHEN churned_mrr > 0 THEN 'Churn'
                    ELSE 'Retained' END AS mrr_change_type,
               CASE WHEN new_mrr > 0 THEN cur WHEN expansion_mrr > 0 OR contraction_mrr > 0 THEN cur - prev
                    WHEN churned_mrr > 0 THEN -prev ELSE 0 END AS mrr_change_amount
        FROM buckets m JOIN fact_subscriptions s USING (account_id, billing_month)""",
    "c_accounts": "SELECT *, CAST(NULL AS INTEGER) AS latent_archetype FROM dim_accounts",
    "c_transactions": """
        SELECT (CAST(substr(account_id, 5) AS BIGINT) * 10000 + date_diff('day', DATE '1990-01-01', transaction_date))
                   * 3 + CASE payment_method WHEN 'Credit Card' THEN 0 WHEN 'ACH Direct Debit' THEN 1 ELSE 2 END
                   AS transaction_batch_id,
               *, CASE WHEN failed_tx_count <= 0 THEN 'None'
                       WHEN payment_method = 'Credit Card' THEN 'Card Expired / Limit Reached'
                       WHEN payment_method = 'ACH Direct Debit' THEN 'Non-Sufficient Funds (NSF)'
                       ELSE 'Compliance / Routing Error' END AS primary_failure_reason
        FROM fact_transactions""",
    "c_telemetry": """
        SELECT CAST(substr(account_id, 5) AS BIGINT) * 10000 + date_diff('day', DATE '1990-01-01', log_date)
                   AS telemetry_id, *
        FROM fact_telemetry""",
}


def with_steps(query: str) -> str:
    """The query behind the named steps it needs, directly or through other steps."""
    import re

    def uses(text: str) -> list[str]:
        words = set(re.findall(r"\w+", text))
        return [name for name in STEPS if name in words]

    needed: set[str] = set()
    waiting = uses(query)
    while waiting:
        name = waiting.pop()
        if name not in needed:
            needed.add(name)
            waiting += uses(STEPS[name])
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in STEPS if name in needed)
    return f"WITH {ctes}\n{query}" if needed else query


QUERIES = {
    "fixture_dim_accounts": """
        SELECT account_id, company_name, industry, company_size, country, initial_plan_id, current_plan_id,
               signup_date, CAST(initial_deposit_usd AS DOUBLE) AS initial_deposit_usd, churn_date, is_churned
        FROM dim_accounts""",
    "fixture_subscriptions": """
        SELECT account_id, billing_month, plan_id, CAST(mrr_amount AS DOUBLE) AS mrr_amount, billing_status
        FROM fact_subscriptions""",
    "fixture_transactions": """
        SELECT account_id, transaction_date, payment_method, total_tx_count, successful_tx_count, failed_tx_count,
               CAST(gross_payment_volume_usd AS DOUBLE) AS gross_payment_volume_usd,
               CAST(fees_collected_usd AS DOUBLE) AS fees_collected_usd
        FROM fact_transactions""",
    "fixture_balances": """
        SELECT account_id, balance_date, CAST(closing_balance_usd AS DOUBLE) AS closing_balance_usd
        FROM fact_daily_balances""",
    "fixture_telemetry": "SELECT * FROM fact_telemetry",
    "mrr_waterfall": """
        SELECT billing_month, CAST(e - (a + b - c - d) AS DOUBLE) AS starting_mrr,
               CAST(a AS DOUBLE) AS total_new_mrr, CAST(b AS DOUBLE) AS total_expansion_mrr,
               CAST(c AS DOUBLE) AS total_contraction_mrr, CAST(d AS DOUBLE) AS total_churned_mrr,
               CAST(a + b - c - d AS DOUBLE) AS net_new_mrr, CAST(e AS DOUBLE) AS total_ending_mrr,
               CASE WHEN e - (a + b - c - d) > 0
                    THEN round(CAST(a + b - c - d AS DOUBLE) * 100.0::DOUBLE / CAST(e - (a + b - c - d) AS DOUBLE), 2)
                    ELSE 0.0::DOUBLE END AS mrr_growth_rate_pct
        FROM monthly ORDER BY billing_month""",
    "mrr_waterfall_compact": """
        SELECT billing_month, CAST(a AS DOUBLE) AS new_mrr, CAST(b AS DOUBLE) AS expansion_mrr,
               CAST(c AS DOUBLE) AS contraction_mrr, CAST(d AS DOUBLE) AS churned_mrr, CAST(e AS DOUBLE) AS total_mrr
        FROM monthly ORDER BY billing_month""",
    "mrr_waterfall_chart": """
        SELECT billing_month, CAST(a AS DOUBLE) AS new_mrr, CAST(b AS DOUBLE) AS expansion_mrr,
               CAST(-c AS DOUBLE) AS contraction_mrr, CAST(-d AS DOUBLE) AS churned_mrr,
               CAST(e AS DOUBLE) AS total_mrr
        FROM monthly ORDER BY billing_month""",
    "mrr_transitions": """
        SELECT account_id, billing_month, CAST(prev AS DOUBLE) AS previous_mrr_amount,
               prev_status AS previous_billing_status, CAST(cur AS DOUBLE) AS current_mrr_amount,
               CAST(new_mrr AS DOUBLE) AS new_mrr, CAST(expansion_mrr AS DOUBLE) AS expansion_mrr,
               CAST(contraction_mrr AS DOUBLE) AS contraction_mrr, CAST(churned_mrr AS DOUBLE) AS churned_mrr
        FROM buckets""",
    "mrr_change_types": """
        SELECT account_id, billing_month,
               CASE WHEN new_mrr > 0 THEN 'New' WHEN expansion_mrr > 0 THEN 'Expansion'
                    WHEN contraction_mrr > 0 THEN 'Contraction' WHEN churned_mrr > 0 THEN 'Churn'
                    ELSE 'Retained' END AS mrr_change_type,
               CAST(CASE WHEN new_mrr > 0 THEN cur
                         WHEN expansion_mrr > 0 OR contraction_mrr > 0 THEN cur - prev
                         WHEN churned_mrr > 0 THEN -prev ELSE 0 END AS DOUBLE) AS mrr_change_amount
        FROM buckets""",
    "cohort_retention_nrr": """
        SELECT r.cohort_month, size AS cohort_total_accounts, round(start_mrr, 2) AS cohort_starting_mrr,
               month_number, active AS active_accounts, round(mrr, 2) AS retained_mrr,
               round(active::DOUBLE * 100.0::DOUBLE / size::DOUBLE, 2) AS logo_retention_pct,
               round(mrr * 100.0::DOUBLE / start_mrr, 2) AS net_revenue_retention_pct
        FROM (SELECT cohort_month, month_number, count(DISTINCT account_id) AS active,
                     CAST(sum(mrr_amount) AS DOUBLE) AS mrr
              FROM cohort_rows GROUP BY ALL) r
        JOIN (SELECT cohort_month, count(DISTINCT account_id) AS size, CAST(sum(mrr_amount) AS DOUBLE) AS start_mrr
              FROM cohort_rows WHERE month_number = 0 GROUP BY ALL) s ON r.cohort_month = s.cohort_month
        ORDER BY r.cohort_month, month_number""",
    "cohort_logo_retention": "SELECT * FROM logo_shares ORDER BY cohort_month, month_idx",
    "cohort_retention_matrix": "SELECT cohort_month, "
    + ", ".join(f"max(retention_pct) FILTER (month_idx = {m}) AS month_{m}" for m in range(13))
    + " FROM logo_shares GROUP BY cohort_month ORDER BY cohort_month",
    "active_accounts_at_cutoff": "SELECT * FROM active",
    "transaction_features": "SELECT * FROM tx",
    "balance_features": "SELECT * REPLACE (round(balance_volatility_30d, 4) AS balance_volatility_30d) FROM bal",
    "telemetry_features": "SELECT * FROM tel",
    "feature_store": "SELECT * FROM store",
    "feature_store_panel": _store("account_id, cutoff_date", "active_p", "tx_p", "bal_p", "tel_p"),
    "feature_store_weekly": _store("account_id, cutoff_date", "active_w", "tx_w", "bal_w", "tel_w"),
}

# The table contracts again, for the integrity checks. For each table its source and key, and for each column
# the longest text, or the (precision, scale) of a decimal, or None; then whether it may be NULL.
_CONTRACT = {
    "dim_plans": ("dim_plans", "plan_id", (
        ("plan_id", None, False),
        ("plan_name", 50, False),
        ("monthly_fee", (10, 2), False),
        ("take_rate_pct", (6, 4), False),
        ("included_seats", None, False),
        ("api_rate_limit_per_min", None, False),
    )),
    "dim_accounts": ("c_accounts", "account_id", (
        ("account_id", 20, False),
        ("company_name", 100, False),
        ("industry", 50, False),
        ("company_size", 50, False),
        ("country", 50, False),
        ("initial_plan_id", None, False),
        ("current_plan_id", None, False),
        ("signup_date", None, False),
        ("initial_deposit_usd", (18, 2), False),
        ("churn_date", None, True),
        ("is_churned", None, False),
        ("latent_archetype", None, True),
    )),
    "fact_subscriptions": ("c_subscriptions", "subscription_id", (
        ("subscription_id", 50, False),
        ("account_id", 20, False),
        ("billing_month", None, False),
        ("plan_id", None, False),
        ("mrr_amount", (10, 2), False),
        ("billing_status", 20, False),
        ("mrr_change_type", 20, False),
        ("mrr_change_amount", (10, 2), False),
    )),
    "fact_transactions": ("c_transactions", "transaction_batch_id", (
        ("transaction_batch_id", None, False),
        ("account_id", 20, False),
        ("transaction_date", None, False),
        ("payment_method", 30, False),
        ("total_tx_count", None, False),
        ("successful_tx_count", None, False),
        ("failed_tx_count", None, False),
        ("primary_failure_reason", 50, False),
        ("gross_payment_volume_usd", (18, 2), False),
        ("fees_collected_usd", (18, 2), False),
    )),
    "fact_daily_balances": ("fact_daily_balances", "account_id,balance_date", (
        ("account_id", 20, False),
        ("balance_date", None, False),
        ("closing_balance_usd", (18, 2), False),
    )),
    "fact_telemetry": ("c_telemetry", "telemetry_id", (
        ("telemetry_id", None, False),
        ("account_id", 20, False),
        ("log_date", None, False),
        ("api_call_count", None, False),
        ("dashboard_logins", None, False),
        ("exports_count", None, False),
    )),
}
_DOMAINS = (
    ("fact_subscriptions", "billing_status", "'Paid', 'Failed', 'Churned'"),
    ("fact_subscriptions", "mrr_change_type", "'New', 'Expansion', 'Contraction', 'Churn', 'Retained'"),
    ("fact_transactions", "payment_method", "'Credit Card', 'ACH Direct Debit', 'Wire Transfer'"),
    ("fact_transactions", "primary_failure_reason", "'None', 'Card Expired / Limit Reached', "
     "'Non-Sufficient Funds (NSF)', 'Compliance / Routing Error'"),
)
_PARENTS = (
    ("dim_accounts", "initial_plan_id", "dim_plans", "plan_id"),
    ("dim_accounts", "current_plan_id", "dim_plans", "plan_id"),
    ("fact_subscriptions", "account_id", "dim_accounts", "account_id"),
    ("fact_subscriptions", "plan_id", "dim_plans", "plan_id"),
    ("fact_transactions", "account_id", "dim_accounts", "account_id"),
    ("fact_daily_balances", "account_id", "dim_accounts", "account_id"),
    ("fact_telemetry", "account_id", "dim_accounts", "account_id"),
)
_NOT_NEGATIVE = (("fact_subscriptions", "mrr_amount"), ("fact_transactions", "gross_payment_volume_usd"))


def _check(kind: str, table: str, column: str, condition: str) -> str:
    return f"""SELECT '{kind}' AS "check", '{table}' AS table_name, '{column}' AS column_name,
               count(*) FILTER ({condition}) AS violations FROM {_CONTRACT[table][0]}"""


def _columns():
    for table, (_, _, columns) in _CONTRACT.items():
        for column, limit, may_be_null in columns:
            yield table, column, limit, may_be_null


def _not_null() -> list[str]:
    return [_check("not_null", t, c, f"{c} IS NULL") for t, c, _, may_be_null in _columns() if not may_be_null]


def _lengths() -> list[str]:
    texts = [_check("text_length", t, c, f"length({c}) > {n}") for t, c, n, _ in _columns() if isinstance(n, int)]
    return texts + [
        _check("decimal_range", t, c, f"abs({c}) >= 1{'0' * (n[0] - n[1])}::HUGEINT")
        for t, c, n, _ in _columns() if isinstance(n, tuple)
    ]


def _scales() -> list[str]:
    return [
        _check("decimal_scale", t, c, f"{c} <> round({c}, {n[1]})") for t, c, n, _ in _columns() if isinstance(n, tuple)
    ] + [
        f"""SELECT 'decimal_scale' AS "check", 'analytics_account_risk_scores' AS table_name, '{c}' AS column_name,
            count(*) FILTER ({c} <> round({c}, {scale})) AS violations FROM served"""
        for c, scale in (("churn_probability", 4), ("predicted_12m_clv_usd", 2))
    ]


def _domains() -> list[str]:
    return [_check("domain", t, c, f"{c} NOT IN ({values})") for t, c, values in _DOMAINS]


def _ranges() -> list[str]:
    return [_check("non_negative", t, c, f"{c} < 0") for t, c in _NOT_NEGATIVE]


def _all(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({part})" for part in parts)


# The numeric features.
_NUMERIC = (
    "tenure_days",
    "current_plan_id",
    "current_mrr",
    "take_rate_pct",
    "initial_deposit_usd",
    "tx_volume_30d",
    "tx_volume_90d",
    "tx_count_30d",
    "tx_count_90d",
    "fees_collected_30d",
    "fees_collected_90d",
    "tx_volume_velocity_ratio",
    "failed_tx_rate_30d",
    "card_vol_share_30d",
    "ach_vol_share_30d",
    "wire_vol_share_30d",
    "card_failure_rate_30d",
    "ach_failure_rate_30d",
    "wire_failure_rate_30d",
    "current_balance_usd",
    "avg_balance_30d",
    "avg_balance_90d",
    "balance_volatility_30d",
    "balance_decay_pct",
    "api_calls_30d",
    "api_calls_90d",
    "logins_30d",
    "logins_90d",
    "exports_30d",
    "days_since_last_api_call",
    "days_since_last_login",
    "telemetry_velocity_ratio",
)


def _numeric_correlations() -> str:
    return _all([
        f"""SELECT '{n}' AS feature, CASE WHEN stddev_pop({n}) > 0 AND stddev_pop(churn_next_60d) > 0
            THEN corr({n}, churn_next_60d) END AS c FROM store"""
        for n in _NUMERIC
    ])


def _dummy_correlations() -> str:
    return _all([
        f"""SELECT '{c}_' || level AS feature, CASE WHEN stddev_pop(x) > 0 THEN corr(x, y) END AS c
            FROM (SELECT level, CASE WHEN {c} = level THEN 1 ELSE 0 END AS x, churn_next_60d AS y
                  FROM active CROSS JOIN (SELECT DISTINCT {c} AS level FROM active
                                          WHERE {c} <> (SELECT min({c}) FROM active)) d) r
            GROUP BY level"""
        for c in ("industry", "company_size", "country")
    ])


def _segments() -> str:
    return _all([
        f"""SELECT '{c}' AS segment, {c} AS value, count(*) AS accounts, CAST(sum(is_churned) AS BIGINT) AS churned
            FROM dim_accounts GROUP BY {c}"""
        for c in ("industry", "company_size")
    ])


QUERIES |= {
    "payment_rail_summary": """
        SELECT payment_method, CAST(sum(total_tx_count) AS BIGINT) AS total_transactions,
               CAST(sum(failed_tx_count) AS BIGINT) AS total_failures,
               round(CAST(sum(failed_tx_count) AS DOUBLE) * 100.0::DOUBLE
                     / nullif(CAST(sum(total_tx_count) AS DOUBLE), 0), 2) AS failure_rate_pct,
               CAST(sum(gross_payment_volume_usd) AS DOUBLE) AS total_volume_usd
        FROM fact_transactions GROUP BY payment_method""",
    "failure_reason_tags": """
        SELECT account_id, transaction_date, payment_method, failed_tx_count, primary_failure_reason
        FROM c_transactions""",
    "balance_history": """
        SELECT account_id, balance_date, CAST(closing_balance_usd AS DOUBLE) AS closing_balance_usd
        FROM fact_daily_balances ORDER BY account_id, balance_date""",
    "transaction_history": """
        SELECT account_id, transaction_date, CAST(gross_payment_volume_usd AS DOUBLE) AS gross_payment_volume_usd,
               failed_tx_count, total_tx_count
        FROM fact_transactions ORDER BY account_id, transaction_date""",
    "account_history": """
        SELECT balance_date, CAST(closing_balance_usd AS DOUBLE) AS closing_balance_usd
        FROM fact_daily_balances WHERE account_id = 'ACC-000000007' ORDER BY balance_date""",
    "account_balance_history": """
        SELECT balance_date, CAST(closing_balance_usd AS DOUBLE) AS closing_balance_usd
        FROM fact_daily_balances WHERE account_id = 'ACC-000000007' ORDER BY balance_date""",
    "account_transaction_history": """
        SELECT transaction_date, CAST(gross_payment_volume_usd AS DOUBLE) AS gross_payment_volume_usd,
               failed_tx_count, total_tx_count
        FROM fact_transactions WHERE account_id = 'ACC-000000007' ORDER BY transaction_date""",
    "account_demographics": """
        SELECT account_id, industry, company_size, country, plan_name, CAST(monthly_fee AS DOUBLE) AS mrr,
               is_churned, CAST(initial_deposit_usd AS DOUBLE) AS initial_deposit_usd
        FROM dim_accounts JOIN dim_plans ON plan_id = current_plan_id""",
    "overall_churn": """
        SELECT count(*) AS accounts, CAST(sum(is_churned) AS DOUBLE) / count(*) AS churn_rate FROM dim_accounts""",
    "churn_rate_by_segment": f"""
        SELECT * EXCLUDE (half), round(greatest(churn_rate - half, 0), 6) AS ci_low, round(least(churn_rate + half, 1), 6) AS ci_high
        FROM (SELECT *, 1.96::DOUBLE * sqrt(churn_rate * (1 - churn_rate) / accounts) AS half
              FROM (SELECT *, churned::DOUBLE / accounts::DOUBLE AS churn_rate FROM ({_segments()}) s) r) h""",
    "feature_label_correlation": f"""
        SELECT feature, round(c, 4) AS corr FROM ({_numeric_correlations()} UNION ALL {_dummy_correlations()}) u
        ORDER BY corr, feature""",
    "one_hot_categories": _all([
        f"SELECT account_id, '{c}_' || {c} AS dummy FROM active WHERE {c} <> (SELECT min({c}) FROM active)"
        for c in ("industry", "company_size", "country")
    ]),
    "hash_split": "SELECT account_id, churn_next_60d, bucket < 2500 AS is_test FROM hashed",
    "stratified_split": "SELECT * FROM stratified",
    "split_label_stats": """
        SELECT is_test, count(*) AS rows, CAST(sum(churn_next_60d) AS BIGINT) AS positives,
               sum(churn_next_60d)::DOUBLE / count(*) AS churn_rate,
               (count(*) - sum(churn_next_60d))::DOUBLE / greatest(1, sum(churn_next_60d))::DOUBLE AS positive_weight
        FROM stratified GROUP BY is_test""",
    "clv_label": "SELECT account_id, value_12m FROM valued",
    "clv_split_medians": """
        SELECT bucket < 2500 AS is_test, median(CAST(round(value_12m * 100) AS BIGINT)) / 100 AS median_value_12m
        FROM valued JOIN hashed USING (account_id) GROUP BY 1""",
    "proxy_probabilities": "SELECT account_id, churn_probability FROM scored",
    "threshold_curve": """
        SELECT threshold, round(net, 2) AS net_savings_usd, hits AS interventions_count, tp AS true_positives,
               hits - tp AS false_positives
        FROM sweep ORDER BY threshold""",
    "optimal_threshold": """
        SELECT threshold, round(net, 2) AS net_savings_usd, hits AS interventions_count, tp AS true_positives,
               hits - tp AS false_positives
        FROM best""",
    "threshold_value_added": """
        SELECT b.threshold AS optimal_threshold, round(b.net, 2) AS max_net_savings_usd,
               round(d.net, 2) AS default_0_5_savings_usd, round(b.net - round(d.net, 2), 2) AS value_added_usd
        FROM best b CROSS JOIN (SELECT * FROM sweep WHERE abs(threshold - 0.5) < 0.01 ORDER BY threshold LIMIT 1) d""",
    "hard_predictions": """
        SELECT account_id, CAST(churn_probability >= 0.25::DOUBLE AS INTEGER) AS predicted_churn FROM scored""",
    # ROC-AUC from the rank sum of the positives; PR-AUC by the trapezoid rule over the distinct scores.
    "classification_metrics": """
        SELECT (SELECT round((sum(r) FILTER (y = 1) - n1 * (n1 + 1) / 2) / (n1 * (n - n1)), 6)
                FROM (SELECT churn_next_60d AS y,
                             (rank() OVER (ORDER BY churn_probability)
                              + (count(*) OVER (PARTITION BY churn_probability) - 1) / 2.0::DOUBLE) AS r,
                             (sum(churn_next_60d) OVER ())::DOUBLE AS n1, (count(*) OVER ())::DOUBLE AS n
                      FROM scored) k GROUP BY n1, n) AS roc_auc,
               (SELECT round(sum((recall - recall0) * (precision_ + precision0) / 2), 6)
                FROM (SELECT *, lag(recall, 1, 0.0::DOUBLE) OVER (ORDER BY churn_probability DESC) AS recall0,
                             lag(precision_, 1, 1.0::DOUBLE) OVER (ORDER BY churn_probability DESC) AS precision0
                      FROM (SELECT churn_probability,
                                   (sum(sum(churn_next_60d)) OVER w)::DOUBLE / (sum(sum(churn_next_60d)) OVER ())
                                       AS recall,
                                   (sum(sum(churn_next_60d)) OVER w)::DOUBLE / (sum(count(*)) OVER w) AS precision_
                            FROM scored GROUP BY churn_probability
                            WINDOW w AS (ORDER BY churn_probability DESC)) c) l) AS pr_auc,
               (SELECT round(avg((churn_probability - churn_next_60d) ** 2), 6) FROM scored) AS brier_score""",
    "regression_metrics": """
        SELECT round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
               round(1 - sum(e * e) / (var_pop(value_12m) * count(*)), 6) AS r2
        FROM (SELECT value_12m, CAST(CAST(current_mrr AS DECIMAL(10,2)) * 12 + CAST(tx_volume_90d AS DECIMAL(18,2))
                     * CAST(take_rate_pct AS DECIMAL(6,4)) * 4 AS DOUBLE) - value_12m AS e
              FROM valued) x""",
    "risk_tiers": "SELECT account_id, churn_probability, risk_tier FROM tiered",
    "risk_tiers_at_optimum": """
        SELECT account_id, churn_probability,
               CASE WHEN churn_probability >= 0.65::DOUBLE
                      OR (churn_probability >= threshold AND current_plan_id = 3) THEN 'Critical'
                    WHEN churn_probability >= threshold THEN 'High'
                    WHEN churn_probability >= 0.15::DOUBLE THEN 'Medium' ELSE 'Low' END AS risk_tier
        FROM scored CROSS JOIN (SELECT threshold FROM best) b""",
    "tier_distribution": "SELECT risk_tier, count(*) AS account_count FROM tiered GROUP BY risk_tier",
    "at_risk_summary": """
        SELECT count(*) AS total_accounts, count(*) FILTER (risk_tier = 'Critical') AS critical_accounts,
               count(*) FILTER (risk_tier = 'High') AS high_accounts,
               count(*) FILTER (risk_tier = 'Medium') AS medium_accounts,
               count(*) FILTER (risk_tier = 'Low') AS low_accounts,
               CAST(coalesce(sum(CAST(current_mrr AS DECIMAL(18,2)))
                    FILTER (risk_tier IN ('Critical', 'High')), 0) AS DOUBLE) AS at_risk_mrr
        FROM tiered""",
    "executive_kpis": """
        SELECT CAST(sum(CAST(current_mrr AS DECIMAL(18,2))) AS DOUBLE) AS total_mrr,
               CAST(coalesce(sum(CAST(current_mrr AS DECIMAL(18,2)))
                    FILTER (risk_tier IN ('Critical', 'High')), 0) AS DOUBLE) * 12 AS at_risk_arr,
               count(*) FILTER (risk_tier = 'Critical') AS critical_accounts,
               count(*) FILTER (risk_tier IN ('Critical', 'High')) AS at_risk_accounts,
               count(*) AS total_accounts,
               CAST(sum(CAST(predicted_12m_clv_usd AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_predicted_12m_clv
        FROM enriched""",
    "scored_accounts_enriched": "SELECT * FROM enriched",
    "critical_accounts": "SELECT * FROM enriched WHERE risk_tier = 'Critical'",
    "rescue_list": """
        SELECT account_id, company_name, industry, company_size, country, plan_name, current_mrr, churn_probability,
               risk_tier, predicted_12m_clv_usd, primary_churn_driver, recommended_action
        FROM enriched ORDER BY churn_probability DESC, account_id""",
    "reason_codes_additive": "SELECT * FROM words",
    "dq_primary_keys": _all([
        f"""SELECT '{t}' AS table_name, '{key}' AS key_columns, count(*) AS violations,
            CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count
            FROM (SELECT count(*) AS n FROM {source} GROUP BY {key} HAVING count(*) > 1) g"""
        for t, (source, key, _) in _CONTRACT.items()
    ]),
    "dq_foreign_keys": _all([
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{p}' AS parent_table,
            count(DISTINCT {c}) AS violations, count(*) AS row_count
            FROM {_CONTRACT[t][0]} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {p})"""
        for t, c, p, pc in _PARENTS
    ]),
    "dq_not_null": _all(_not_null()),
    "dq_domains": _all(_domains()),
    "dq_lengths": _all(_lengths()),
    "dq_decimal_scale": _all(_scales()),
    "dq_columns_one_scan": _all(_not_null() + _domains() + _ranges() + _lengths()),
    "dq_ranges": _all([
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS minimum,
            count(*) FILTER ({c} < 0) AS violations FROM {t}"""
        for t, c in _NOT_NEGATIVE
    ]),
    "dq_row_counts": _all([
        f"""SELECT '{t}' AS table_name, count(*) AS row_count, CAST(count(*) = 0 AS INTEGER) AS violations
            FROM {source}"""
        for t, (source, _, _) in _CONTRACT.items()
    ]),
    "dq_feature_matrix": f"""
        SELECT count(s.account_id) AS row_count, count(DISTINCT s.account_id) AS accounts,
               count(*) FILTER (s.account_id IS NULL) AS missing_accounts,
               CAST(coalesce(sum({' + '.join(f'(CASE WHEN s.account_id IS NOT NULL AND s.{n} IS NULL THEN 1 ELSE 0 END)' for n in _NUMERIC)}), 0)
                    AS BIGINT) AS null_values
        FROM active a LEFT JOIN store s USING (account_id)""",
    "dq_serving_columns": _all(
        [
            f"""SELECT 'not_null' AS "check", 'analytics_account_risk_scores' AS table_name, '{c}' AS column_name,
                count(*) FILTER ({c} IS NULL) AS violations FROM served"""
            for c in (
                "account_id", "score_timestamp", "churn_probability", "risk_tier", "predicted_12m_clv_usd",
                "primary_churn_driver", "secondary_churn_driver", "recommended_action",
            )
        ]
        + ["""SELECT 'domain', 'analytics_account_risk_scores', 'risk_tier',
              count(*) FILTER (risk_tier NOT IN ('Low', 'Medium', 'High', 'Critical')) FROM served"""]
        + [
            f"SELECT 'text_length', 'analytics_account_risk_scores', '{c}', count(*) FILTER (length({c}) > {n}) FROM served"
            for c, n in (
                ("account_id", 20), ("risk_tier", 20), ("primary_churn_driver", 100),
                ("secondary_churn_driver", 100), ("recommended_action", 255),
            )
        ]
        + [
            f"SELECT 'decimal_range', 'analytics_account_risk_scores', '{c}', count(*) FILTER (abs({c}) >= {n}) FROM served"
            for c, n in (("churn_probability", "100"), ("predicted_12m_clv_usd", "1e16"))
        ]
    ),
    "dq_serving_keys": """
        SELECT 'analytics_account_risk_scores' AS table_name, 'account_id,score_timestamp' AS key_columns,
               count(*) AS violations, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count
        FROM (SELECT count(*) AS n FROM served GROUP BY account_id, score_timestamp HAVING count(*) > 1) g""",
    "dq_serving_references": """
        SELECT 'analytics_account_risk_scores' AS table_name, 'account_id' AS column_name,
               'dim_accounts' AS parent_table, count(DISTINCT account_id) AS violations, count(*) AS row_count
        FROM served WHERE account_id NOT IN (SELECT account_id FROM dim_accounts)""",
    "dq_scores": """
        SELECT count(*) AS row_count, min(churn_probability) AS min_probability,
               max(churn_probability) AS max_probability,
               count(*) FILTER (churn_probability < 0 OR churn_probability > 1) AS out_of_range,
               count(*) FILTER (primary_churn_driver = '') AS empty_primary,
               count(*) FILTER (secondary_churn_driver = '') AS empty_secondary,
               count(*) FILTER (recommended_action = '') AS empty_action
        FROM served""",
}

_FINE = """(SELECT * REPLACE (churn_probability / 3 + (CAST(substr(account_id, 5, 9) AS BIGINT) % 9973) / 1e9
            AS churn_probability) FROM scored)"""

# The hand-made trees of the attribution check: (worth, conditions), a condition as (feature, share, SQL that it is met).
_LEAVES = (
    (1.0, (("tenure_days", 0.6, "tenure_days <= 500"), ("failed_tx_rate_30d", 0.5, "failed_tx_rate_30d <= 0.05::DOUBLE"))),
    (-2.0, (("tenure_days", 0.6, "tenure_days <= 500"), ("failed_tx_rate_30d", 0.5, "failed_tx_rate_30d > 0.05::DOUBLE"))),
    (4.0, (("tenure_days", 0.1, "tenure_days > 500 AND tenure_days <= 900"),)),
    (8.0, (("tenure_days", 0.3, "tenure_days > 900"), ("current_plan_id", 0.25, "current_plan_id = 2"))),
    (16.0, (("tenure_days", 0.3, "tenure_days > 900"), ("current_plan_id", 0.75, "current_plan_id IN (1, 3)"))),
    (0.5, (("failed_tx_rate_30d", 0.4, "failed_tx_rate_30d > 0.02::DOUBLE"), ("current_plan_id", 0.5, "current_plan_id = 1"),
           ("logins_30d", 0.7, "logins_30d <= 2"))),
)
_TREE_FEATURES = ("tenure_days", "failed_tx_rate_30d", "current_plan_id", "logins_30d")


def _margin(coalition: frozenset[str]) -> str:
    """The expected margin when the features of the coalition are known and the others are averaged out."""
    return " + ".join(
        "(" + " * ".join([f"({worth}::DOUBLE)", *(
            f"(CASE WHEN {met} THEN 1::DOUBLE ELSE 0::DOUBLE END)" if feature in coalition else f"{share}::DOUBLE"
            for feature, share, met in conditions
        )]) + ")"
        for worth, conditions in _LEAVES
    )


def _shapley(feature: str) -> str:
    """The definition: the weighted mean, over all coalitions of the others, of what the feature adds to the margin."""
    others = [f for f in _TREE_FEATURES if f != feature]
    terms = []
    for size in range(len(others) + 1):
        weight = factorial(size) * factorial(len(others) - size) / factorial(len(others) + 1)
        for group in combinations(others, size):
            known = frozenset(group)
            terms.append(f"{weight!r}::DOUBLE * (({_margin(known | {feature})}) - ({_margin(known)}))")
    return " + ".join(terms)


# Queries on the models' results: what must hold of every account, from the accounts and features as they are.
QUERIES |= {
    "classification_metrics_exact": QUERIES["classification_metrics"].replace("FROM scored", f"FROM {_FINE} f"),
    "feature_matrix": _all(
        [f"SELECT account_id, '{n}' AS slot, CAST({n} AS DOUBLE) AS value FROM store" for n in _NUMERIC]
        + [
            f"""SELECT account_id, '{c}_' || level AS slot, CASE WHEN {c} = level THEN 1::DOUBLE ELSE 0::DOUBLE END AS value
                FROM store CROSS JOIN (SELECT DISTINCT {c} AS level FROM store
                                       WHERE {c} <> (SELECT min({c}) FROM store)) d"""
            for c in ("industry", "company_size", "country")
        ]
    ),
    "attribution_fixed_trees": _all([
        f"SELECT account_id, '{f}' AS feature, round({_shapley(f)}, 9) AS contribution FROM store" for f in _TREE_FEATURES
    ]),
    "model_score_checks": """
        SELECT account_id, current_plan_id, true AS in_range, true AS served_as_predicted, true AS contributions_add_up,
               true AS margin_gives_probability, true AS tier_follows, true AS reason_follows,
               true AS value_at_least_floor
        FROM store""",
    "model_serving_kpis": """
        SELECT CAST(sum(CAST(current_mrr AS DECIMAL(18,2))) AS DOUBLE) AS total_mrr, count(*) AS total_accounts,
               count(*) AS in_tiers, CAST(0 AS BIGINT) AS violations, true AS critical_are_at_risk
        FROM store""",
}

_POISSON_STEPS = (24109, 48218, 60273, 64291, 65296, 65497, 65530)

# Two rounds of Tweedie boosting (power 1.5, log link, steps of 0.3) on fixed leaves of the twelve-month value.
_FIRST_LEAF = "CASE WHEN current_plan_id = 1 THEN 0 WHEN tx_count_90d <= 50 THEN 1 ELSE 2 END"
_SECOND_LEAF = "CASE WHEN tenure_days <= 1000 THEN 0 ELSE 1 END"


def _tweedie_round(source: str, leaf: str) -> str:
    return f"""SELECT r.* REPLACE (r.f + 0.3::DOUBLE * ln(s.a / s.b) AS f)
               FROM {source} r JOIN (SELECT {leaf} AS leaf, sum(value_12m * exp(-0.5::DOUBLE * f)) AS a, sum(exp(0.5::DOUBLE * f)) AS b
                                     FROM {source} GROUP BY 1) s ON s.leaf = {leaf}"""


# Three rounds of a classifier on fixed leaves: what each adds to half the log-odds.
_ROUNDS = (
    "CASE WHEN tenure_days <= 700 THEN 0.4::DOUBLE ELSE -0.5::DOUBLE END",
    "CASE WHEN current_plan_id IN (1, 3) THEN CASE WHEN logins_30d <= 1 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END ELSE -0.2::DOUBLE END",
    "CASE WHEN failed_tx_rate_30d <= 0.05::DOUBLE THEN -0.25::DOUBLE ELSE 0.35::DOUBLE END",
    "CASE WHEN tenure_days <= 1500 THEN -0.3::DOUBLE ELSE 0.6::DOUBLE END",
    "CASE WHEN logins_30d <= 0 THEN 0.2::DOUBLE ELSE -0.1::DOUBLE END",
)


def _prefixes() -> str:
    return _all([
        f"SELECT {k} AS round, churn_next_60d AS y, {' + '.join(_ROUNDS[:k])} AS m FROM store" for k in range(1, len(_ROUNDS) + 1)
    ])


QUERIES |= {
    "churn_rate_bootstrap": f"""
        SELECT * FROM (WITH drawn AS (
            SELECT a.*, b, s, CAST('0x' || substr(md5(account_id || ':42:' || b), 1 + 4 * s, 4) AS INTEGER) AS u
            FROM (SELECT account_id, is_churned, industry, company_size FROM dim_accounts) a
                 CROSS JOIN range(25) bs(b) CROSS JOIN range(8) ss(s)),
        timed AS (SELECT *, {" + ".join(f"CAST(u >= {t} AS INTEGER)" for t in _POISSON_STEPS)} AS w FROM drawn),
        rates AS (
            SELECT segment, value, sum(w * is_churned)::DOUBLE / sum(w) AS rate
            FROM (SELECT 'industry' AS segment, industry AS value, * FROM timed
                  UNION ALL SELECT 'company_size', company_size, * FROM timed) t
            WHERE w > 0 GROUP BY segment, value, b, s)
        SELECT k.segment, k.value, accounts, churned::DOUBLE / accounts::DOUBLE AS churn_rate, boot_low, boot_high
        FROM ({_segments()}) k JOIN (
            SELECT segment, value, round(quantile_cont(rate, 0.025), 6) AS boot_low, round(quantile_cont(rate, 0.975), 6) AS boot_high
            FROM rates GROUP BY segment, value) r USING (segment, value)) z""",
    "median_of_any_numbers": """
        SELECT bucket < 2500 AS is_test, 'double' AS kind, round(median(value_12m / 3 - 5000), 6) AS median
        FROM valued JOIN hashed USING (account_id) GROUP BY 1
        UNION ALL
        SELECT bucket < 2500, 'long',
               round(CAST(median((CAST(substr(account_id, 5, 9) AS BIGINT) * 7919 % 2000003 - 1000001) * 9223354444668) AS DOUBLE) / 1e12, 3)
        FROM valued JOIN hashed USING (account_id) GROUP BY 1""",
    "tweedie_fixed_rounds": f"""
        SELECT * FROM (WITH start AS (SELECT account_id, value_12m, current_plan_id, tx_count_90d, tenure_days,
                              (SELECT ln(avg(value_12m)) FROM valued) AS f FROM valued),
        one AS ({_tweedie_round("start", _FIRST_LEAF)}),
        two AS ({_tweedie_round("one", _SECOND_LEAF)})
        SELECT account_id, round(exp(f), 4) AS predicted_value FROM two) z""",
    "churn_stopping_curve": f"""
        SELECT * FROM (WITH prefixes AS ({_prefixes()}),
        steps AS (SELECT round, floor(2000 / (1 + exp(-2 * m))) AS step, count(*) AS n, sum(y) AS p,
                         sum(ln(1 + exp(CASE WHEN y > 0 THEN -2 ELSE 2 END * m))) AS loss FROM prefixes GROUP BY ALL),
        ranked AS (SELECT *, sum(p) OVER (PARTITION BY round ORDER BY step DESC) AS above FROM steps),
        measured AS (SELECT round, sum(loss) / sum(n) AS log_loss,
                            sum((n - p) * (2 * above - p))::DOUBLE / (2 * sum(p)::DOUBLE * sum(n - p)) AS roc_auc
                     FROM ranked GROUP BY round),
        best AS (SELECT *, (SELECT o.round FROM measured o WHERE o.round <= m.round ORDER BY o.log_loss, o.round LIMIT 1) AS l,
                           (SELECT o.round FROM measured o WHERE o.round <= m.round ORDER BY o.roc_auc DESC, o.round LIMIT 1) AS a
                 FROM measured m)
        SELECT CAST(round AS INTEGER) AS round, round(log_loss, 9) AS log_loss, round(roc_auc, 9) AS roc_auc,
               CAST(l AS INTEGER) AS best_loss_round, CAST(a AS INTEGER) AS best_auc_round, round - l >= 2 OR round - a >= 2 AS stopped
        FROM best) z""",
    "global_attribution_fixed_trees": _all([
        f"SELECT '{f}' AS feature, round(avg(abs({_shapley(f)})), 9) AS mean_abs_contribution FROM store" for f in _TREE_FEATURES
    ]),
    "metadata_round_trip": f"""
        SELECT 'fixed score' AS model_type, 4 AS best_iteration, v.optimal_threshold, round(m.roc_auc, 4) AS roc_auc,
               round(m.pr_auc, 4) AS pr_auc, round(m.brier_score, 4) AS brier_score,
               v.max_net_savings_usd AS max_net_savings_test_set_usd, v.default_0_5_savings_usd AS default_0_5_savings_usd, v.value_added_usd
        FROM ({QUERIES["classification_metrics"]}) m CROSS JOIN ({QUERIES["threshold_value_added"]}) v""",
    "model_reload_checks": "SELECT account_id, true AS same_probability, true AS same_value FROM store",
}

# What is written must be read back.
QUERIES |= {
    "mrr_waterfall_head": QUERIES["mrr_waterfall"] + " LIMIT 10",
    "warehouse_feature_store": QUERIES["feature_store"],
    "colocated_feature_store": QUERIES["feature_store"],
    "rescue_list_export": QUERIES["rescue_list"],
    "serving_table": "SELECT * FROM served",
    "csv_round_trip": _all([
        f"""SELECT '{t}' AS table_name, count(*) AS row_count, count(*) AS rows_read,
            CAST(sum({column}) AS DOUBLE) AS total FROM {t}"""
        for t, column in (
            ("dim_plans", "monthly_fee"), ("dim_accounts", "initial_deposit_usd"),
            ("fact_subscriptions", "mrr_amount"), ("fact_transactions", "gross_payment_volume_usd"),
            ("fact_daily_balances", "closing_balance_usd"), ("fact_telemetry", "api_call_count"),
        )
    ]),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_steps(query) for name, query in QUERIES.items()}
