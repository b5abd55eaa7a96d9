"""One order, one customer and one user hold a third of all rows."""

import duckdb
import pytest
from frames import plan_of

import __spark_entry__ as contract
from ledgerloom.catalogue.views import SampleWarehouse
from oracle import TABLES, connect, differences

NAMES = [
    "mrr_waterfall", "mrr_transitions", "cohort_retention_nrr", "transaction_features", "balance_features",
    "telemetry_features", "feature_store", "payment_rail_summary", "failure_reason_tags", "dq_primary_keys",
    "dq_foreign_keys", "threshold_curve", "rescue_list",
]


@pytest.fixture(scope="module")
def skewed(sample, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    hot = {
        "orders": "SELECT o_orderkey + 10000000 + 1000000 * k AS o_orderkey, 7 AS o_custkey, "
                  "* EXCLUDE (o_orderkey, o_custkey) FROM {t} CROSS JOIN range(1) r(k) WHERE o_orderkey % 2 = 0",
        "lineitem": "SELECT 42 AS l_orderkey, * EXCLUDE (l_orderkey) FROM {t} WHERE l_partkey % 2 = 0",
        "events": "SELECT event_id * 10 + 10000000 AS event_id, ts, 3 AS user_id, * EXCLUDE (event_id, ts, user_id) "
                  "FROM {t} WHERE event_id % 2 = 0",
    }
    for name in TABLES:
        source = f"read_parquet('{sample}/{name}.parquet')"
        more = f" UNION ALL BY NAME ({hot[name].format(t=source)})" if name in hot else ""
        con.execute(f"COPY (SELECT * FROM {source}{more}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_results_stay_whole(spark, skewed, name):
    assert differences(contract.queries()[name](spark, skewed), connect(skewed), contract.oracle_sql()[name]) == []


def test_hot_join_key_is_split(spark, skewed):
    """Without broadcasts and with small limits, the join of the lines splits the hot order's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.files.maxPartitionBytes": "64KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        w = SampleWarehouse(spark, skewed)
        # Several map outputs, as on a cluster: a partition is split along them.
        lines = spark.read.parquet(f"{skewed}/lineitem.parquet").repartition(16)
        w._read = lambda name: lines if name == "lineitem" else spark.read.parquet(f"{skewed}/{name}.parquet")
        df = w.transactions
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_one_row_per_account_reaches_the_shuffle(spark, skewed):
    """Rows are folded before every shuffle of the look-back features."""
    text = plan_of(contract.queries()["transaction_features"](spark, skewed))
    exchange = text.index("Exchange hashpartitioning(account_id")
    assert "partial_sum" in text[exchange:exchange + 400]
