import re
import time

import pytest
from frames import plan_of
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.catalogue.views import SampleWarehouse
from ledgerloom.operators import daily
from ledgerloom.session import materialise, scratch_path, shared_folder
from ledgerloom.sources import readers, sinks


@pytest.fixture(scope="module")
def csv_folder(spark, sample, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("csv"))
    sinks.write_base_csv(SampleWarehouse(spark, sample).contract_tables(), folder)
    return folder


@pytest.fixture(scope="module")
def warehouse(spark, csv_folder, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    return folder, sinks.ingest_csv(spark, csv_folder, folder)


def test_ingestion_keeps_every_value(spark, sample, warehouse):
    folder, counts = warehouse
    written = {r.table_name: r.row_count for r in counts.collect()}
    read = readers.load_tables(spark, folder)
    for name, df in SampleWarehouse(spark, sample).contract_tables().items():
        assert [(f.name, f.dataType) for f in read[name].schema] == [
            (f.name, f.dataType) for f in schemas.TABLES[name].schema
        ]
        assert written[name] == df.count() == read[name].count()
        assert df.exceptAll(read[name]).count() == 0


def test_second_ingestion_replaces(spark, csv_folder, warehouse):
    folder, _ = warehouse
    before = readers.table(spark, folder, "fact_telemetry").count()
    sinks.ingest_csv(spark, csv_folder, folder)
    assert readers.table(spark, folder, "fact_telemetry").count() == before


def test_missing_table_is_named(spark, tmp_path):
    with pytest.raises(readers.MissingTable, match="dim_plans"):
        readers.load_tables(spark, str(tmp_path), "csv")
    with pytest.raises(FileNotFoundError):
        readers.table(spark, str(tmp_path), "fact_telemetry")


def test_value_of_the_wrong_type_stops_the_job(spark, tmp_path):
    (tmp_path / "fact_telemetry.csv").write_text(
        "telemetry_id,account_id,log_date,api_call_count,dashboard_logins,exports_count\n1,a,2024-01-01,many,1,1\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        readers.read_csv(spark, str(tmp_path), schemas.FACT_TELEMETRY).collect()


def test_header_must_name_the_columns(spark, tmp_path):
    (tmp_path / "fact_daily_balances.csv").write_text("account_id,day,closing_balance_usd\na,2024-01-01,1.00\n")
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path), schemas.FACT_DAILY_BALANCES).collect()


def test_bounds_prune_months_and_reach_the_scan(spark, warehouse):
    from datetime import date

    folder, _ = warehouse
    df = readers.read_parquet(
        spark, folder, schemas.FACT_TRANSACTIONS, date(1996, 8, 2), date(1996, 10, 31)
    ).select("account_id", "transaction_date")
    text = plan_of(df)
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line)
    assert "month" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(transaction_date,1996-08-02)" in scan
    assert "gross_payment_volume_usd" not in scan  # unread columns are pruned
    assert df.where("transaction_date < '1996-08-02' or transaction_date > '1996-10-31'").count() == 0


def test_facts_are_rebalanced_by_size_not_by_a_sampled_range(spark, sample):
    laid_out = sinks._laid_out(SampleWarehouse(spark, sample).balances, schemas.FACT_DAILY_BALANCES)
    text = plan_of(laid_out)
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "rangepartitioning" not in text


def test_account_lookup_is_pushed_down(spark, warehouse):
    from ledgerloom.plans.reporting import balance_history

    folder, _ = warehouse
    text = plan_of(balance_history(readers.table(spark, folder, "fact_daily_balances"), "ACC-000000007"))
    assert "EqualTo(account_id,ACC-000000007)" in text


def test_export_keeps_the_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 7 as k").orderBy("k", "id")
    sinks.write_csv(df, str(tmp_path / "out"))
    lines = []
    for part in sorted((tmp_path / "out").glob("part-*.csv")):
        header, *body = part.read_text().splitlines()
        assert header == "id,k"
        lines += [tuple(map(int, line.split(","))) for line in body]
    assert lines == [tuple(r) for r in df.collect()]


def test_shared_folder_is_the_sessions(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(folder)
    kept = materialise(spark.range(5), "five")
    assert kept.count() == 5 and folder in kept.inputFiles()[0]


def test_a_written_table_leaves_no_shuffle_files(spark):
    """They would wait for the driver's garbage collection, and on large tables fill the disk."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        files = blocks.getAllFiles().iterator()
        found = set()
        while files.hasNext():
            name = files.next().getName()
            if name.startswith("shuffle_"):
                found.add(name)
        return found

    before, counted = shuffle_files(), spark.range(1000).groupBy(F.col("id") % 7).count()
    written = materialise(counted.withColumnRenamed("(id % 7)", "k").repartition("k"), "counted")
    deadline = time.monotonic() + 20
    while shuffle_files() - before and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not shuffle_files() - before
    assert written.count() == 7 and counted.count() == 7 and counted.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_jdbc_options():
    """No database may be started here, so only the shape of the call is checked."""
    calls = {}

    class Writer:
        def format(self, name):
            calls["format"] = name
            return self

        def options(self, **options):
            calls.update(options)
            return self

        def mode(self, mode):
            calls["mode"] = mode
            return self

        def save(self):
            calls["saved"] = True

    class Frame:
        columns = list(schemas.DIM_PLANS.schema.names)
        write = Writer()

        def select(self, *names):
            calls["columns"] = list(names)
            return self

    sinks.write_jdbc(Frame(), "jdbc:some:url", schemas.DIM_PLANS, user="u")
    assert calls == {
        "format": "jdbc", "url": "jdbc:some:url", "dbtable": "dim_plans", "batchsize": "10000", "user": "u",
        "mode": "overwrite", "saved": True, "columns": Frame.columns,
    }


def test_look_back_reaches_the_event_scan(spark, sample):
    from ledgerloom.catalogue import registry

    for name in ("balance_features", "telemetry_features", "feature_store", "feature_store_panel"):
        scans = [x for x in plan_of(registry.QUERIES[name](spark, sample)).splitlines() if "FileScan" in x and "ts#" in x]
        assert scans and all("GreaterThanOrEqual(ts," in x and "LessThan(ts," in x for x in scans), name


def test_bounded_event_views_equal_filtered_ones(spark, sample):
    from datetime import date, timedelta

    w = SampleWarehouse(spark, sample)
    for shift in range(5):  # every remainder of the day formula
        since, until = date(1996, 8, 10) + timedelta(days=shift), date(1996, 10, 20) + timedelta(days=shift)
        for bounded, whole, day in (
            (w.balances_between(since, until), w.balances, "balance_date"),
            (w.telemetry_between(since, until), w.telemetry, "log_date"),
        ):
            kept = whole.where(f"{day} BETWEEN DATE'{since}' AND DATE'{until}'")
            inside = bounded.where(f"{day} BETWEEN DATE'{since}' AND DATE'{until}'")
            assert sorted(map(tuple, inside.collect())) == sorted(map(tuple, kept.collect()))


def test_account_lookups_are_pushed_to_the_scan(spark, sample):
    from ledgerloom.catalogue import registry

    for name in ("account_balance_history", "account_transaction_history"):
        text = plan_of(registry.QUERIES[name](spark, sample))
        assert "EqualTo(account_id,ACC-000000007)" in text, name


def test_folder_without_a_setting_lies_in_the_warehouse(spark, monkeypatch):
    from ledgerloom import session

    class Settings:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return "already set"

    class Session:
        conf, sparkContext = Settings(), Context()

    assert session.shared_folder(Session()) == "hdfs://shared/warehouse/checkpoints"
    Settings.get = lambda self, key, default=None: {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}.get(key, default)
    for master, allowed in (("local[8]", True), ("local", True), ("local-cluster[3,2,1000]", False), ("yarn", False)):
        Context.master = master
        if allowed:
            assert session.shared_folder(Session()).endswith("/checkpoints")
        else:
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                session.shared_folder(Session())


def test_a_writer_that_dies_leaves_the_old_table(spark, tmp_path):
    """A job that fails half-way, with some files written, changes nothing; the next one replaces and cleans up."""
    folder, table = str(tmp_path), schemas.FACT_DAILY_BALANCES
    made = lambda n: spark.range(n).selectExpr(
        "concat('ACC-', id % 50) AS account_id", "date_add(DATE'2024-01-01', int(id % 300)) AS balance_date",
        "CAST(id AS DECIMAL(18,2)) AS closing_balance_usd")
    sinks.write_parquet(made(1000), folder, table)
    old = readers.table(spark, folder, table.name)
    balance = F.col("closing_balance_usd")
    dies = F.when(balance > 4900, F.raise_error("killed").cast("decimal(18,2)")).otherwise(balance)
    broken = made(5000).withColumn("closing_balance_usd", dies)
    with pytest.raises(Exception, match="killed"):
        sinks.write_parquet(broken, folder, table)
    assert readers.table(spark, folder, table.name).count() == 1000
    for n in (2000, 3000):
        sinks.write_parquet(made(n), folder, table)
        assert readers.table(spark, folder, table.name).count() == n
    versions = [p.name for p in (tmp_path / table.name).iterdir() if p.name.startswith("version-")]
    assert len(versions) == 2  # the current one and the one before
    with pytest.raises(Exception):
        old.count()  # two versions later


def test_a_reader_keeps_its_version(spark, tmp_path):
    folder, table = str(tmp_path), schemas.DIM_PLANS
    plans = SampleWarehouse(spark, "/root/testdata/sf0.001").plans
    sinks.write_parquet(plans, folder, table)
    reader = readers.table(spark, folder, table.name)
    sinks.write_parquet(plans.limit(1), folder, table)
    assert reader.count() == 3 and readers.table(spark, folder, table.name).count() == 1


@pytest.fixture(scope="module")
def bucketed(spark, sample, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bucketed"))
    tables = SampleWarehouse(spark, sample).contract_tables()
    for name in ("dim_plans", "dim_accounts", "fact_transactions", "fact_daily_balances"):
        sinks.write_parquet(tables[name], folder, schemas.TABLES[name], 8)
    for daily_table, name in ((daily.DAILY_TRANSACTIONS, "fact_transactions"), (daily.DAILY_TELEMETRY, "fact_telemetry")):
        sinks.write_parquet(daily.folded(tables[name], daily_table), folder, daily_table, 8)
    return folder


def test_a_lookup_reads_one_bucket(spark, sample, bucketed):
    facts = readers.table(spark, bucketed, "fact_transactions")
    found = facts.where("account_id = 'ACC-000000007'")
    scan = next(x for x in plan_of(found).splitlines() if "FileScan" in x)
    assert "EqualTo(account_id,ACC-000000007)" in scan
    whole = SampleWarehouse(spark, sample).contract_tables()["fact_transactions"].where("account_id = 'ACC-000000007'")
    assert found.exceptAll(whole).count() == 0 and found.count() == whole.count() > 0


def test_a_lookup_opens_no_other_file(spark, sample, tmp_path):
    """Files of other buckets are spoilt; only a scan that leaves them alone gives the account's rows."""
    facts = SampleWarehouse(spark, sample).contract_tables()["fact_transactions"].where("transaction_date >= DATE'1997-06-01'")
    sinks.write_parquet(facts, str(tmp_path), schemas.FACT_TRANSACTIONS, 8)
    account = "ACC-000000007"
    wanted = sorted(map(tuple, facts.where(F.col("account_id") == account).collect()))
    own = spark.range(1).select(F.pmod(F.hash(F.lit(account)), F.lit(8))).first()[0]
    files = [f for f in (tmp_path / "fact_transactions").rglob("part-*.parquet")]
    others = [f for f in files if not f.name.split(".")[0].endswith(f"_{own:05d}")]
    assert wanted and 0 < len(others) < len(files) and len(files) - len(others) < len(files) / 4
    for f in others:
        f.write_bytes(b"spoilt")
    read = readers.table(spark, str(tmp_path), "fact_transactions")
    assert sorted(map(tuple, read.where(F.col("account_id") == account).collect())) == wanted
    with pytest.raises(Exception):
        read.count() if read.select("fees_collected_usd").collect() else None


def test_another_session_finds_the_buckets(spark, sample, bucketed):
    place = lambda name: spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first().data_type
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("fact_daily_balances_")]
    name = next(n for n in names if bucketed in place(n))
    before = readers.table(spark, bucketed, "fact_daily_balances").count()
    spark.sql(f"DROP TABLE {name}")  # the files of an external table stay
    again = readers.table(spark, bucketed, "fact_daily_balances")
    assert again.count() == before > 0 and spark.catalog.tableExists(name)


def test_colocated_store_shuffles_no_fact(spark, sample, bucketed):
    """Facts, features and accounts share their buckets: neither folding nor joining moves them."""
    from datetime import date

    from ledgerloom.plans.feature_store import feature_store

    fact = lambda table: readers.read_parquet(spark, bucketed, table, date(1996, 8, 2), date(1996, 10, 31))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        built = feature_store(
            readers.table(spark, bucketed, "dim_accounts"), readers.table(spark, bucketed, "dim_plans").hint("broadcast"),
            fact(daily.DAILY_TRANSACTIONS), fact(daily.DAILY_BALANCES), fact(daily.DAILY_TELEMETRY), "1996-10-31")
        text = plan_of(built)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Exchange hashpartitioning" not in text and text.count("Bucketed: true") == 4
    assert built.count() == SampleWarehouse(spark, sample).accounts.where(
        "signup_date <= DATE'1996-10-31' AND (churn_date IS NULL OR churn_date > DATE'1996-10-31')").count()


def test_a_hot_account_has_a_row_a_day(spark):
    facts = spark.range(30_000).selectExpr(
        "id AS telemetry_id", "if(id % 3 = 0, 'hot', concat('a', id % 997)) AS account_id", "date_add(DATE'2024-01-01', int(id % 30)) AS log_date",
        "1 AS api_call_count", "1 AS dashboard_logins", "0 AS exports_count")
    folded = daily.folded(facts, daily.DAILY_TELEMETRY)
    assert folded.where("account_id = 'hot'").count() == 10 and folded.agg(F.sum("api_call_count")).first()[0] == 30_000


def test_cleared_scratch_leaves_no_table_in_the_catalog(spark, sample):
    """In a session of its own application id, so the other tests keep their tables."""
    from ledgerloom import session

    path = scratch_path(spark, "kept")
    facts = SampleWarehouse(spark, sample).contract_tables()["fact_daily_balances"].limit(10)
    sinks.write_parquet(facts, path, schemas.FACT_DAILY_BALANCES, 2)
    names = {t.name for t in spark.catalog.listTables() if t.tableType == "EXTERNAL"}
    assert any(n.startswith("fact_daily_balances_") for n in names)
    removed = []

    class Context:
        applicationId = path.rsplit("/ledgerloom/", 1)[1].split("/")[0]
        _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

    class Catalog:
        listTables = staticmethod(lambda: [t for t in spark.catalog.listTables() if t.name.startswith("fact_daily_balances_")])

    class Session:
        sparkContext, catalog, conf = Context(), Catalog(), spark.conf

        def sql(self, text):
            if text.startswith("DROP"):
                removed.append(text)
            return spark.sql(text)

    monkey = session._scratch_folder
    try:
        session._scratch_folder = lambda _: path  # only this table's folder goes
        session.clear_scratch(Session())
    finally:
        session._scratch_folder = monkey
    assert removed and not any(t.name == removed[0].split()[-1] for t in spark.catalog.listTables())


def test_a_stored_query_writes_only_what_it_reads(spark, sample, monkeypatch):
    from ledgerloom.catalogue import registry

    names, write = [], sinks.write_parquet
    monkeypatch.setattr(registry, "_folders", {})
    monkeypatch.setattr(registry, "_written", set())
    monkeypatch.setattr(sinks, "write_parquet", lambda df, folder, table, *rest: names.append(table.name) or write(df, folder, table, *rest))
    for name in ("account_balance_history", "account_transaction_history", "colocated_feature_store"):
        names.append(name)
        assert registry.QUERIES[name](spark, sample).count() > 0
    assert names == [
        "account_balance_history", "fact_daily_balances", "account_transaction_history", "fact_transactions",
        "colocated_feature_store", "dim_plans", "dim_accounts", "daily_transactions", "daily_telemetry",
    ]


def test_bucketed_rows_are_sorted_once(spark, sample, monkeypatch):
    """By the writer; every file holds its accounts and days in order."""
    from pyspark.sql import DataFrameWriter

    plans, save = [], DataFrameWriter.saveAsTable
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", lambda self, *args: plans.append(plan_of(self._df)) or save(self, *args))
    facts = SampleWarehouse(spark, sample).contract_tables()["fact_telemetry"]
    folder = scratch_path(spark, "sorted")
    sinks.write_parquet(facts, folder, schemas.FACT_TELEMETRY, 4)
    assert len(plans) == 1 and "Sort [" not in plans[0].split("Exchange")[0]
    read = spark.read.parquet(readers.storage.current(spark, f"{folder}/fact_telemetry"))
    rows = read.select(F.input_file_name().alias("f"), "account_id", "log_date").collect()
    files = {r.f: [(x.account_id, x.log_date) for x in rows if x.f == r.f] for r in {r.f: r for r in rows}.values()}
    assert len(files) > 4 and all(own == sorted(own) for own in files.values())


def test_round_trip_goes_through_compressed_files(spark, sample, monkeypatch, tmp_path):
    from ledgerloom.catalogue import registry

    monkeypatch.setattr(registry, "scratch_path", lambda _, name: str(tmp_path / name))
    rows = {r.table_name: r for r in registry.QUERIES["csv_round_trip"](spark, sample).collect()}
    assert len(rows) == 6 and all(r.row_count == r.rows_read for r in rows.values())
    for table in schemas.BASE_TABLES:
        parts = list((tmp_path / "csv" / f"{table.name}.csv").glob("part-*"))
        assert parts and all(p.name.endswith(".csv.gz") for p in parts)


def test_warehouse_store_ingests_the_tables_it_reads(spark, sample, monkeypatch):
    from ledgerloom.catalogue import registry

    names, write = [], sinks.write_parquet
    monkeypatch.setattr(sinks, "write_parquet", lambda df, folder, table, *rest: names.append(table.name) or write(df, folder, table, *rest))
    assert registry.QUERIES["warehouse_feature_store"](spark, sample).count() > 0
    assert sorted(names) == ["dim_accounts", "dim_plans", "fact_daily_balances", "fact_telemetry", "fact_transactions"]
