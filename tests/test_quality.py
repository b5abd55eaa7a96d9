from decimal import Decimal

from frames import by, day, money

from ledgerloom import schemas
from ledgerloom.operators import quality


def _frame(spark, table, rows):
    nullable = [f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields]
    return spark.createDataFrame(rows, ", ".join(nullable))


def _tables(spark):
    plan = (1, "Starter", money(99), Decimal("0.0190"), 5, 120)
    account = lambda a, p: (a, "Corp", "X", "Y", "Z", p, 1, day("2024-01-01"), money(-5), None, 0, None)
    sub = lambda i, a, amount, status: (i, a, day("2024-01-01"), 1, money(amount), status, "New", money(amount))
    return {
        "dim_plans": _frame(spark, schemas.DIM_PLANS, [plan]),
        "dim_accounts": _frame(spark, schemas.DIM_ACCOUNTS, [account("a", 1), account("b", 9), account("a", 1)]),
        "fact_subscriptions": _frame(spark, schemas.FACT_SUBSCRIPTIONS, [
            sub("s1", "a", 10, "Paid"), sub("s1", "ghost", -1, "Lost"), sub("s" * 51, "ghost", 10**9, None),
        ]),
    }


def test_repeated_keys(spark):
    rows = by(quality.primary_keys(_tables(spark)), "table_name")
    assert (rows["dim_accounts"].violations, rows["dim_accounts"].row_count) == (1, 2)
    assert rows["fact_subscriptions"].violations == 1 and rows["dim_plans"].violations == 0


def test_orphans(spark):
    rows = by(quality.foreign_keys(_tables(spark)), "table_name", "column_name")
    assert rows["dim_accounts", "initial_plan_id"].violations == 1
    ghost = rows["fact_subscriptions", "account_id"]
    assert (ghost.violations, ghost.row_count) == (1, 2)
    assert rows["fact_subscriptions", "plan_id"].violations == 0


def test_column_checks_in_one_scan(spark):
    rows = by(quality.column_checks(_tables(spark)), "check", "table_name", "column_name")
    bad = {k: r.violations for k, r in rows.items() if r.violations}
    fact = "fact_subscriptions"
    assert bad == {
        ("not_null", fact, "billing_status"): 1,
        ("domain", fact, "billing_status"): 1,
        ("non_negative", fact, "mrr_amount"): 1,
        ("text_length", fact, "subscription_id"): 1,
        ("decimal_range", fact, "mrr_amount"): 1,
        ("decimal_range", fact, "mrr_change_amount"): 1,
    }
    assert ("not_null", "dim_accounts", "churn_date") not in rows


def test_minimum_and_row_counts(spark):
    tables = _tables(spark)
    low = by(quality.minimum_values(tables), "table_name")["fact_subscriptions"]
    assert (low.minimum, low.violations) == (-1.0, 1)
    empty = tables | {"dim_plans": tables["dim_plans"].limit(0)}
    counts = by(quality.row_counts(empty), "table_name")
    assert (counts["dim_plans"].row_count, counts["dim_plans"].violations) == (0, 1)
    assert (counts["dim_accounts"].row_count, counts["dim_accounts"].violations) == (3, 0)


def test_feature_matrix(spark):
    active = spark.createDataFrame([("a",), ("b",), ("c",)], "account_id string")
    matrix = spark.createDataFrame([("a", 1.0, None), ("a", 1.0, 1.0), ("b", None, None)], "account_id string, x double, y double")
    row = quality.feature_matrix(matrix, active, ["x", "y"]).first()
    assert tuple(row) == (3, 2, 1, 3)


def test_scores(spark):
    df = spark.createDataFrame(
        [(0.0, "a", "b", "c"), (1.2, "", "b", None), (None, "a", "b", "c")],
        "churn_probability double, primary_churn_driver string, secondary_churn_driver string, recommended_action string")
    row = quality.scores(df).first()
    assert (row.row_count, row.out_of_range, row.empty_primary, row.empty_secondary, row.empty_action) == (3, 2, 1, 0, 1)
