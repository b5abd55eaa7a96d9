from frames import by, day, subscriptions

from ledgerloom.operators.movements import with_churn_status
from ledgerloom.plans import revenue


def test_each_movement_in_turn(spark):
    amounts = [0, 99, 499, 99, 0, 99]
    subs = subscriptions(spark, [("a", f"2024-0{i + 1}", v, "Paid") for i, v in enumerate(amounts)])
    rows = by(revenue.mrr_change_types(subs), "billing_month")
    found = [rows[d] for d in sorted(rows)]
    assert [r.mrr_change_type for r in found] == ["Retained", "New", "Expansion", "Contraction", "Churn", "New"]
    assert [r.mrr_change_amount for r in found] == [0, 99, 400, -400, -99, 99]


def test_churned_status_with_a_smaller_amount_is_counted_twice(spark):
    subs = subscriptions(spark, [("a", "2024-01", 500, "Paid"), ("a", "2024-02", 200, "Churned")])
    second = by(revenue.mrr_transitions(subs), "billing_month")[day("2024-02-01")]
    assert (second.contraction_mrr, second.churned_mrr) == (300, 500)
    assert by(revenue.mrr_change_types(subs), "billing_month")[day("2024-02-01")].mrr_change_type == "Contraction"


def test_gap_month_takes_the_previous_row(spark):
    subs = subscriptions(spark, [("a", "2024-01", 100, "Paid"), ("a", "2024-04", 150, "Failed")])
    later = by(revenue.mrr_transitions(subs), "billing_month")[day("2024-04-01")]
    assert (later.previous_mrr_amount, later.previous_billing_status, later.expansion_mrr) == (100, "Paid", 50)


def test_null_amount_is_not_replaced_by_the_default(spark):
    subs = subscriptions(spark, [("a", "2024-01", None, "Paid"), ("a", "2024-02", 100, "Paid")])
    rows = by(revenue.mrr_transitions(subs), "billing_month")
    first, second = rows[day("2024-01-01")], rows[day("2024-02-01")]
    assert first.previous_mrr_amount == 0 and first.previous_billing_status == "None"
    assert second.previous_mrr_amount is None
    assert second.new_mrr == second.expansion_mrr == second.contraction_mrr == second.churned_mrr == 0


def test_waterfall_balances_and_guards_an_empty_start(spark):
    subs = subscriptions(spark, [
        ("a", "2024-01", 100, "Paid"), ("a", "2024-02", 150, "Paid"), ("a", "2024-03", 0, "Churned"),
        ("b", "2024-02", 70, "Paid"), ("b", "2024-03", 50, "Paid"),
    ])
    rows = revenue.mrr_waterfall(subs).collect()
    assert [str(r.billing_month) for r in rows] == ["2024-01-01", "2024-02-01", "2024-03-01"]
    for r in rows:
        assert r.starting_mrr + r.net_new_mrr == r.total_ending_mrr
        gains = r.total_new_mrr + r.total_expansion_mrr
        assert r.net_new_mrr == gains - r.total_contraction_mrr - r.total_churned_mrr
    assert rows[0].starting_mrr == 0 and rows[0].mrr_growth_rate_pct == 0
    assert rows[1].mrr_growth_rate_pct == 120.0
    chart = revenue.mrr_waterfall_compact(subs, signed=True).collect()
    assert (chart[2].contraction_mrr, chart[2].churned_mrr, chart[2].total_mrr) == (-20, -150, 50)


def test_churn_status_is_the_first_churned_month(spark):
    subs = subscriptions(spark, [("a", "2024-05", 0, "Churned"), ("a", "2024-03", 0, "Churned"), ("b", "2024-01", 1, "Paid")])
    found = by(with_churn_status(spark.createDataFrame([("a",), ("b",)], "account_id string"), subs), "account_id")
    assert (str(found["a"].churn_date), found["a"].is_churned) == ("2024-03-01", 1)
    assert (found["b"].churn_date, found["b"].is_churned) == (None, 0)
