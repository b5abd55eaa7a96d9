"""Generated cases against plain Python."""

from collections import defaultdict

from frames import subscriptions
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.plans import retention, revenue

MONTHS = [f"2024-{m:02d}" for m in range(1, 13)]
ROWS = st.dictionaries(
    st.tuples(st.sampled_from("abc"), st.sampled_from(MONTHS)),
    st.tuples(st.sampled_from([0, 50, 99, 499]), st.sampled_from(["Paid", "Failed", "Churned"])),
    min_size=1, max_size=25,
)
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@QUICK
@given(rows=ROWS)
def test_waterfall(spark, rows):
    expected = defaultdict(lambda: [0, 0, 0, 0, 0])
    previous = {}
    for (account, month), (amount, status) in sorted(rows.items()):
        before, sums = previous.get(account, 0), expected[month]
        if before == 0 and amount > 0:
            sums[0] += amount
        if before > 0 and amount > before:
            sums[1] += amount - before
        if before > 0 and 0 < amount < before:
            sums[2] += before - amount
        if before > 0 and (amount == 0 or status == "Churned"):
            sums[3] += before
        sums[4] += amount
        previous[account] = amount
    df = subscriptions(spark, [(a, m, v, s) for (a, m), (v, s) in rows.items()])
    found = {
        str(r.billing_month)[:7]: [r.new_mrr, r.expansion_mrr, r.contraction_mrr, r.churned_mrr, r.total_mrr]
        for r in revenue.mrr_waterfall_compact(df).collect()
    }
    assert found == dict(expected)


@QUICK
@given(rows=ROWS)
def test_cohorts(spark, rows):
    from frames import accounts

    signup = {a: min(m for b, m in rows if b == a) for a, _ in rows}
    who = accounts(spark, [(a, f"{m}-15", None, 1) for a, m in signup.items()])
    active, mrr = defaultdict(set), defaultdict(int)
    for (account, month), (amount, status) in rows.items():
        if amount > 0 and status == "Paid":
            key = signup[account], int(month[5:]) - int(signup[account][5:])
            active[key].add(account)
            mrr[key] += amount
    expected = {
        (c, n): (len(active[c, 0]), len(members), round(len(members) * 100.0 / len(active[c, 0]), 2), mrr[c, n])
        for (c, n), members in list(active.items()) if (c, 0) in active
    }
    df = subscriptions(spark, [(a, m, v, s) for (a, m), (v, s) in rows.items()])
    found = {
        (str(r.cohort_month)[:7], r.month_number):
            (r.cohort_total_accounts, r.active_accounts, r.logo_retention_pct, r.retained_mrr)
        for r in retention.cohort_retention(who, df).collect()
    }
    assert found == expected
