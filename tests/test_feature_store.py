import statistics

import pytest
from frames import accounts, balances, by, plan_of, plans, telemetry, transactions

from ledgerloom.operators import snapshots
from ledgerloom.plans.feature_store import feature_store
from ledgerloom.schemas import NUMERIC_FEATURES

CUTOFF = "2025-10-31"  # 30 days back: 2025-10-01; 90 days back: 2025-08-02
CARD, ACH, WIRE = "Credit Card", "ACH Direct Debit", "Wire Transfer"


def test_activity_and_label_at_the_edges(spark):
    who = accounts(spark, [
        ("on", "2025-01-01", "2025-10-31", 1), ("next", "2025-01-01", "2025-11-01", 1),
        ("last", "2025-01-01", "2025-12-30", 1), ("after", "2025-01-01", "2025-12-31", 1),
        ("never", "2025-10-31", None, 1), ("later", "2025-11-01", None, 1),
    ])
    rows = by(snapshots.active_accounts(who, plans(spark), CUTOFF), "account_id")
    assert {a: r.churn_next_60d for a, r in rows.items()} == {"next": 1, "last": 1, "after": 0, "never": 0}
    assert rows["never"].tenure_days == 0 and rows["next"].tenure_days == 303


def test_windows_are_inclusive_at_both_ends(spark):
    days = ["2025-08-01", "2025-08-02", "2025-09-30", "2025-10-01", "2025-10-31", "2025-11-01"]
    facts = transactions(spark, [("a", d, CARD, 2**i, 0, 10**i) for i, d in enumerate(days)])
    row = snapshots.transaction_features(facts, CUTOFF).first()
    assert (row.tx_count_90d, row.tx_count_30d) == (2 + 4 + 8 + 16, 8 + 16)
    assert (row.tx_volume_90d, row.tx_volume_30d) == (11110.0, 11000.0)


def test_rails_are_kept_apart(spark):
    facts = transactions(spark, [
        ("a", "2025-10-10", CARD, 10, 2, 100), ("a", "2025-10-11", ACH, 20, 5, 300),
        ("a", "2025-10-12", WIRE, 5, 0, 600), ("a", "2025-09-01", WIRE, 50, 50, 900),
    ])
    row = snapshots.transaction_features(facts, CUTOFF).first()
    assert (row.card_vol_30d, row.ach_vol_30d, row.wire_vol_30d) == (100, 300, 600)
    assert (row.card_failed_30d, row.ach_failed_30d, row.wire_failed_30d) == (2, 5, 0)
    assert (row.failed_tx_count_30d, row.failed_tx_count_90d) == (7, 57)


def test_balances(spark):
    values = [100, 150, 50]
    facts = balances(spark, [
        ("a", "2025-10-29", values[0]), ("a", "2025-10-30", values[1]), ("a", "2025-10-31", values[2]),
        ("a", "2025-08-02", 700), ("one", "2025-10-31", 5), ("old", "2025-08-10", 40),
    ])
    rows = by(snapshots.balance_features(facts, CUTOFF), "account_id")
    assert (rows["a"].current_balance_usd, rows["a"].avg_balance_30d, rows["a"].avg_balance_90d) == (50, 100, 250)
    assert rows["a"].balance_volatility_30d == pytest.approx(statistics.stdev(values))
    assert rows["one"].balance_volatility_30d is None
    assert (rows["old"].avg_balance_30d, rows["old"].current_balance_usd) == (None, None)


def test_recency_counts_active_days_only(spark):
    facts = telemetry(spark, [("a", "2025-10-01", 3, 0, 1), ("a", "2025-10-20", 0, 0, 0), ("a", "2025-09-30", 4, 2, 1)])
    row = snapshots.telemetry_features(facts, CUTOFF).first()
    assert (row.days_since_last_api_call, row.days_since_last_login) == (30, 31)
    assert (row.api_calls_30d, row.api_calls_90d, row.logins_30d, row.exports_30d) == (3, 7, 0, 1)


def _store(spark, cutoffs=CUTOFF):
    return feature_store(
        accounts(spark, [("a", "2025-01-01", None, 77), ("bare", "2025-01-01", "2025-12-01", 88),
                         ("old", "2025-01-01", None, 99)]),
        plans(spark),
        transactions(spark, [("a", "2025-10-10", CARD, 10, 2, 100), ("a", "2025-09-01", ACH, 30, 3, 200)]),
        balances(spark, [("a", "2025-10-31", 10), ("a", "2025-09-01", 30), ("old", "2025-08-20", 40)]),
        telemetry(spark, [("a", "2025-10-30", 6, 1, 0), ("a", "2025-09-01", 12, 0, 0)]),
        cutoffs,
    )


def test_defaults_without_any_facts(spark):
    bare = by(_store(spark), "account_id")["bare"]
    assert bare.tx_volume_30d == bare.tx_count_90d == bare.fees_collected_90d == bare.api_calls_30d == 0
    assert bare.tx_volume_velocity_ratio == bare.telemetry_velocity_ratio == 1
    assert bare.failed_tx_rate_30d == bare.card_vol_share_30d == bare.wire_failure_rate_30d == 0
    assert bare.current_balance_usd == bare.avg_balance_30d == bare.avg_balance_90d == 88
    assert bare.balance_volatility_30d == bare.balance_decay_pct == 0
    assert bare.days_since_last_api_call == bare.days_since_last_login == 90
    assert bare.churn_next_60d == 1


def test_ratios(spark):
    rows = by(_store(spark), "account_id")
    a = rows["a"]
    assert a.tx_volume_velocity_ratio == 1.0 and a.failed_tx_rate_30d == 0.2
    assert (a.card_vol_share_30d, a.ach_vol_share_30d, a.card_failure_rate_30d) == (1.0, 0.0, 0.2)
    assert a.balance_decay_pct == -0.5 and a.telemetry_velocity_ratio == 1.0
    assert rows["old"].avg_balance_30d == 99 and rows["old"].balance_decay_pct == -1.0


def test_shape(spark):
    store = _store(spark)
    assert len(store.columns) == 37 and len(NUMERIC_FEATURES) == 32
    assert store.count() == 3


def test_panel_equals_single_snapshots(spark):
    cutoffs = ["2025-09-15", "2025-10-31"]
    panel = _store(spark, cutoffs)
    for c in cutoffs:
        one = sorted(map(tuple, panel.where(f"cutoff_date = '{c}'").drop("cutoff_date").collect()))
        assert one == sorted(map(tuple, _store(spark, c).collect()))


def test_plan_aggregates_before_the_shuffle_and_needs_no_python(spark):
    text = plan_of(_store(spark))
    assert "partial_sum" in text and "CartesianProduct" not in text and "Python" not in text
    assert "BroadcastNestedLoopJoin" not in plan_of(_store(spark, ["2025-09-15", "2025-10-31"]))


def test_many_cutoffs_equal_single_snapshots(spark):
    """Sixty weekly cutoffs from one fold, with gaps, a hot account and values at the edges of the windows."""
    from datetime import date, timedelta

    cutoffs = [date(2025, 1, 3) + timedelta(weeks=k) for k in range(60)]
    day = lambda k: str(date(2024, 9, 1) + timedelta(days=k))
    rails = (CARD, ACH, WIRE)
    rows = [("hot", day(k), rails[k % 3], k % 7, k % 2, k) for k in range(600)]
    rows += [(f"a{k % 9}", day((k * 37) % 640), rails[k % 3], k % 5, k % 3, k * 3) for k in range(200)]
    rows += [("edge", str(cutoffs[9] + timedelta(days=d)), CARD, 1, 0, 10) for d in (-91, -90, -31, -30, 0, 1)]
    tx = transactions(spark, rows)
    bal = balances(spark, sorted({(a, d): (a, d, v % 97) for a, d, *_, v in rows}.values()))
    use = telemetry(spark, sorted({(a, d): (a, d, n % 3, f, n) for a, d, _, n, f, _ in rows}.values()))
    for build, facts in ((snapshots.transaction_features, tx), (snapshots.balance_features, bal), (snapshots.telemetry_features, use)):
        panel = {(r.account_id, r.cutoff_date): r for r in build(facts, cutoffs).collect()}
        count = 0
        for c in (*cutoffs[:12:3], cutoffs[13], cutoffs[31], *cutoffs[-9::4]):
            single = build(facts, c).collect()
            for r in single:
                found, count = panel[r.account_id, c], count + 1
                for name in r.asDict():
                    assert getattr(found, name) == pytest.approx(getattr(r, name), abs=1e-9), (name, r, found)
            assert sum(1 for _, x in panel if x == c) == len(single)
        assert count > 40


def test_the_panel_reads_and_folds_facts_once(spark):
    from datetime import date, timedelta

    facts = transactions(spark, [("a", "2025-10-10", CARD, 10, 2, 100)])
    physical = lambda n: plan_of(
        snapshots.transaction_features(facts, [date(2025, 1, 3) + timedelta(weeks=k) for k in range(n)])
    ).split("== Physical Plan ==")[1]
    text = physical(60)
    assert text.count("Generate inline") == 1 and text.count("Scan") == 1
    assert len(physical(5).splitlines()) == len(text.splitlines())
    assert text.index("Window") < text.index("partial_sum")  # windows run over folded rows
