import math

import pytest
from frames import by
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from ledgerloom.catalogue import registry
from ledgerloom.catalogue.views import CUTOFF, SampleWarehouse
from ledgerloom.operators import ensembles, metrics, models, splits, tweedie
from ledgerloom.operators.value import with_twelve_month_value
from ledgerloom.plans import jobs
from ledgerloom.schemas import NUMERIC_FEATURES, RISK_SCORES
from ledgerloom.session import materialise, scratch_path
from pyspark.sql import functions as F

SETTINGS = models.ChurnSettings(rounds=6, depth=3, learning_rate=0.3, min_leaf=5)


@pytest.fixture(scope="module")
def snapshot(spark):
    """Real features with a planted label: slow payments or a long absence."""
    store = registry.store(SampleWarehouse(spark, "/root/testdata/sf0.01"))
    planted = (F.col("tx_volume_velocity_ratio") < 0.3) & (F.col("tenure_days") < 500)
    return materialise(store.withColumn("churn_next_60d", planted.cast("int")), "planted")


@pytest.fixture(scope="module")
def churn(snapshot):
    return jobs.train_churn(snapshot, SETTINGS)


@pytest.fixture(scope="module")
def value(snapshot):
    return jobs.train_value(snapshot, fit=models.fit_value_model)


def test_boosting_stops_and_keeps_the_first_rounds(spark, snapshot):
    """A label without a signal ends the boosting early; what is kept equals a fit of that many rounds."""
    noise = snapshot.withColumn("churn_next_60d", (F.crc32(F.col("account_id")) % 3 == 0).cast("int"))
    settings = models.ChurnSettings(rounds=60, patience=4, depth=3, learning_rate=0.5, min_leaf=5)
    stopped = models.fit_churn_model(noise, settings)
    kept = stopped.stages[-1].getNumTrees
    assert kept < 14
    whole = models.ChurnSettings(rounds=kept, patience=99, depth=3, learning_rate=0.5, min_leaf=5)
    held = splits.hash_bucket(F.col("account_id"), models.VALIDATION_SEED) < 1500
    counts = noise.agg(F.sum("churn_next_60d").alias("p"), F.count(F.lit(1)).alias("n")).first()
    weight = (counts.n - counts.p) / counts.p
    rows = models.transformed(PipelineModel(stopped.stages[:-1]), noise).where(~held).withColumns({
        "label": F.col("churn_next_60d").cast("double"), "weight": F.when(F.col("churn_next_60d") == 1, weight).otherwise(1.0),
    })
    shorter = PipelineModel([*stopped.stages[:-1], models.fit_rounds(rows, whole, kept)])
    pick = lambda m: {r.account_id: r.churn_probability for r in models.churn_predictions(m, snapshot).select("account_id", "churn_probability").collect()}
    assert pick(shorter) == pytest.approx(pick(stopped))


def test_copies_of_an_account_do_not_delay_the_stop(spark, snapshot):
    """With copies of its accounts on both sides a model would learn the held-back labels by heart, and boosting would go on."""
    noise = snapshot.withColumn("churn_next_60d", (F.crc32(F.col("account_id")) % 3 == 0).cast("int"))
    copies = noise.crossJoin(spark.range(5)).withColumn("account_id", F.concat("account_id", F.lit("-"), "id")).drop("id")
    settings = models.ChurnSettings(rounds=40, patience=4, depth=3, learning_rate=0.5, min_leaf=5)
    assert models.fit_churn_model(materialise(copies, "copies"), settings).stages[-1].getNumTrees < 20


def test_prefix_measures_are_those_of_the_prefixes(spark, snapshot):
    """Loss and area of every prefix, measured at once, equal those of the truncated models."""
    ready = snapshot.withColumns({"label": F.col("churn_next_60d").cast("double"), "weight": F.lit(1.0)})
    encoder = Pipeline(stages=models.feature_stages()).fit(ready)
    rows = materialise(encoder.transform(ready).select(models.FEATURES, "label", "weight"), "rows")
    fitted = models.fit_rounds(rows, SETTINGS, 5)
    found = {r["round"]: r for r in models.ensemble_measures(fitted, rows).collect()}
    assert sorted(found) == [1, 2, 3, 4, 5]
    for k in (1, 3, 5):
        shorter = ensembles.first_rounds(fitted, k, spark)
        assert shorter.getNumTrees == k
        scored = [(r.label, r.probability[1]) for r in shorter.transform(rows).select("label", "probability").collect()]
        loss = -sum(math.log(p if y else 1 - p) for y, p in scored) / len(scored)
        ups, downs = [p for y, p in scored if y], [p for y, p in scored if not y]
        area = sum((u > d) + (u == d) / 2 for u in ups for d in downs) / (len(ups) * len(downs))
        assert found[k].log_loss == pytest.approx(loss, abs=1e-9)
        assert found[k].roc_auc == pytest.approx(area, abs=2e-3)


def test_patience_is_a_number_of_rounds(spark):
    losses = [0.9, 0.8, 0.85, 0.86, 0.7, 0.71, 0.72, 0.73]
    areas = [0.5, 0.6, 0.6, 0.61, 0.62, 0.5, 0.5, 0.63]
    rows = spark.createDataFrame(list(zip(range(1, 9), losses, areas)), "round int, log_loss double, roc_auc double")
    kept = lambda patience: ensembles.best_round(ensembles.stopping_curve(rows, patience), patience)
    assert kept(2) == (2, True)  # the loss of round 4 is two rounds behind that of round 2
    assert kept(3) == (5, True)
    assert kept(4) == (8, False)
    nothing = rows.withColumn("roc_auc", F.lit(None).cast("double"))
    assert ensembles.best_round(ensembles.stopping_curve(nothing, 4), 4) == (5, False)


TWEEDIE = tweedie.TweedieSettings(rounds=6, learning_rate=0.5, depth=3, min_leaf=5, patience=2)


@pytest.fixture(scope="module")
def forecast(snapshot):
    return jobs.train_value(snapshot, fit=lambda rows: models.fit_tweedie_value_model(rows, settings=TWEEDIE))


def test_boosted_tweedie_lowers_the_deviance(spark, snapshot):
    """The deviance of the fitted rows falls in every round, and is what the model's own forecasts give."""
    rows = with_twelve_month_value(snapshot)
    encoded = Pipeline(stages=models.feature_stages(output=models.VALUE_FEATURES, log_scale=True)).fit(models.log_scaled(rows))
    ready = encoded.transform(models.log_scaled(rows)).select(models.VALUE_FEATURES, "value_12m", F.lit(False).alias("held_back"))
    fitted = tweedie.fit(materialise(ready, "ready"), models.VALUE_FEATURES, "value_12m", "held_back", "f", TWEEDIE)
    own = [d for d, held in fitted.deviances if held is None]
    assert len(own) == 6 and all(a > b for a, b in zip(own, own[1:]))
    y, mu = F.col("value_12m"), F.exp("f")
    row = 2 * (F.pow(y, 0.5) / -0.25 + y * F.pow(mu, -0.5) / 0.5 + F.pow(mu, 0.5) / 0.5)
    assert fitted.model.transform(ready).agg(F.avg(row)).first()[0] == pytest.approx(own[-1], rel=1e-9)


def test_boosted_tweedie_is_a_model_like_the_others(spark, snapshot, forecast):
    pairs = forecast.tested.collect()
    assert all(r.predicted_value >= 50 for r in pairs)
    mean = sum(r.value_12m for r in pairs) / len(pairs)
    spread = sum((r.value_12m - mean) ** 2 for r in pairs)
    assert sum((r.value_12m - r.predicted_value) ** 2 for r in pairs) < 0.2 * spread
    path = scratch_path(spark, "tweedie-model")
    models.save_model(forecast.model, path)
    pick = lambda m: {r.account_id: r.predicted_value for r in models.value_predictions(m, snapshot).select("account_id", "predicted_value").collect()}
    assert pick(models.load_model(path)) == pick(forecast.model)


def test_tweedie_handles_zeros_and_refuses_negative_values(spark):
    rows = spark.range(60).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("x"), F.lit(False).alias("held"),
                                  F.when(F.col("id") < 30, 0.0).otherwise(F.col("id").cast("double")).alias("y"))
    fitted = tweedie.fit(rows, "x", "y", "held", "f", tweedie.TweedieSettings(rounds=3, learning_rate=0.9, depth=2, min_leaf=5))
    means = fitted.model.transform(rows).groupBy(F.col("y") > 0).agg(F.avg(F.exp("f")).alias("m")).orderBy("m")
    low, high = (r.m for r in means.collect())
    assert low < 1 < 20 < high
    with pytest.raises(ValueError):
        tweedie.fit(rows.withColumn("y", F.lit(-1.0)), "x", "y", "held", "f", tweedie.TweedieSettings())


def test_classifier_finds_the_planted_signal(churn):
    found = churn.metadata.first()
    assert found.metrics.roc_auc > 0.9
    assert 1 <= found.best_iteration <= SETTINGS.rounds
    assert found.financial_optimization.max_net_savings_test_set_usd >= found.financial_optimization.default_0_5_savings_usd
    ps = churn.tested.agg(F.min("churn_probability").alias("low"), F.max("churn_probability").alias("high")).first()
    assert 0 <= ps.low <= ps.high <= 1


def test_slots_are_numeric_then_dummies_without_the_base_level(snapshot, churn):
    names = churn.metadata.first().feature_names
    levels = {c: sorted(r[0] for r in snapshot.select(c).distinct().collect()) for c in ("industry", "company_size", "country")}
    assert names[:32] == list(NUMERIC_FEATURES)
    assert set(names[32:]) == {f"{c}_{v}" for c, vs in levels.items() for v in vs[1:]}


def test_model_and_metadata_survive_saving(spark, snapshot, churn):
    path, notes = scratch_path(spark, "model"), scratch_path(spark, "notes")
    models.save_model(churn.model, path)
    models.save_metadata(churn.metadata, notes)
    loaded = models.load_model(path)
    pick = lambda m: sorted(map(tuple, models.churn_predictions(m, snapshot).select("account_id", "churn_probability").collect()))
    assert pick(loaded) == pick(churn.model)
    assert models.load_threshold(spark, notes) == churn.metadata.first().financial_optimization.optimal_threshold


def test_unseen_category_is_reported(snapshot, churn):
    odd = snapshot.withColumn("industry", F.when(F.col("account_id") < "ACC-000000100", "SPACE").otherwise(F.col("industry")))
    rows = models.unseen_levels(churn.model, odd).collect()
    assert [(r.name, r.level) for r in rows] == [("industry", "SPACE")]
    assert rows[0].accounts == odd.where("industry = 'SPACE'").count()
    assert models.unseen_levels(churn.model, snapshot).count() == 0


def test_value_model(value):
    found = metrics.regression_metrics(value.tested, "value_12m", "predicted_value").first()
    assert found.r2 > 0.3
    assert value.tested.agg(F.min("predicted_value")).first()[0] >= 50.0


def test_boosted_value_model(snapshot, value):
    boosted = jobs.train_value(snapshot, fit=lambda rows: models.fit_boosted_value_model(rows, settings=SETTINGS))
    found = metrics.regression_metrics(boosted.tested, "value_12m", "predicted_value").first()
    assert found.r2 > 0.1 and boosted.tested.agg(F.min("predicted_value")).first()[0] >= 50.0
    held = lambda t: sorted(r.account_id for r in t.tested.select("account_id").collect())
    assert held(boosted) == held(value)


def test_new_category_scores_as_the_base_level(snapshot, churn, value):
    base = churn.model.stages[0].labelsArray[0][-1]
    name = churn.model.stages[0].getInputCols()[0]
    score = lambda level: models.churn_predictions(churn.model, snapshot.limit(20).withColumn(name, F.lit(level))).select("account_id", name, "churn_probability").collect()
    new, old = score("NOBODY KNOWS"), score(base)
    assert {r.account_id: r.churn_probability for r in new} == {r.account_id: r.churn_probability for r in old}
    assert {r[name] for r in new} == {"NOBODY KNOWS"}


def test_batch_scores(spark, snapshot, churn, value):
    scored = jobs.batch_scores(snapshot, churn.model, value.model, 0.3, f"{CUTOFF} 00:00:00")
    assert scored.columns == RISK_SCORES.schema.names
    rows = by(scored, "account_id")
    assert len(rows) == snapshot.count()
    plans = {r.account_id: r.current_plan_id for r in snapshot.select("account_id", "current_plan_id").collect()}
    tiers = set()
    for account, r in rows.items():
        tiers.add(r.risk_tier)
        if r.churn_probability >= 0.651 or (r.churn_probability >= 0.301 and plans[account] == 3):
            assert r.risk_tier == "Critical"
        assert r.primary_churn_driver and r.secondary_churn_driver and r.recommended_action
        calm = r.primary_churn_driver == "Stable Usage Patterns"
        assert calm == (r.risk_tier in ("Low", "Medium"))
        assert r.predicted_12m_clv_usd >= 50
    assert "Critical" in tiers and "Low" in tiers
    at_risk = [r for r in rows.values() if r.risk_tier == "Critical"]
    signal = ("Sharp Drop in Payment Processing Volume", "Elevated tenure_days")
    assert sum(r.primary_churn_driver in signal for r in at_risk) > len(at_risk) / 2


def test_scoring_needs_no_shuffle(snapshot, churn, value):
    from frames import plan_of

    assert "Exchange" not in plan_of(jobs.batch_scores(snapshot, churn.model, value.model, 0.3, f"{CUTOFF} 00:00:00"))


def test_value_models_train_no_churn_model(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a churn model was trained")

    monkeypatch.setattr(registry, "_trained", {})
    monkeypatch.setattr(registry.jobs, "train_churn", refuse)
    monkeypatch.setattr(registry.jobs, "train_value", lambda features, fit: features.columns)
    w = SampleWarehouse(spark, "/root/testdata/sf0.001")
    assert "account_id" in registry.trained_value(w)


def test_registered_churn_model_trains_in_full(spark, monkeypatch):
    """With a short patience boosting ends after a few trees."""
    monkeypatch.setattr(registry, "_trained", {})
    monkeypatch.setattr(registry.jobs, "train_churn", lambda features, settings=models.ChurnSettings(): settings)
    used = registry.trained(SampleWarehouse(spark, "/root/testdata/sf0.001"))[1]
    assert used == models.ChurnSettings() and (used.rounds, used.patience, used.learning_rate, used.depth) == (500, 30, 0.05, 6)


def test_registered_value_model_trains_in_full(monkeypatch):
    """Five large steps leave the forecast well short of what boosting reaches."""
    monkeypatch.setattr(models, "fit_tweedie_value_model", lambda train, settings: settings)
    used = registry.fit_tweedie(None)
    assert used == tweedie.TweedieSettings() and (used.rounds, used.patience, used.learning_rate, used.depth) == (400, 30, 0.05, 6)


def test_batch_scores_come_from_models_trained_in_full(spark, monkeypatch, churn, value):
    """Both models of the registered scores have the limits of real training."""
    used = {}

    def train_churn(features, settings=models.ChurnSettings()):
        used["churn"] = settings
        return churn

    def train_value(features, noise_seed=None, fit=models.fit_tweedie_value_model):
        fit(features)
        return value

    monkeypatch.setattr(registry, "_trained", {})
    monkeypatch.setattr(registry.jobs, "train_churn", train_churn)
    monkeypatch.setattr(registry.jobs, "train_value", train_value)
    monkeypatch.setattr(models, "fit_tweedie_value_model", lambda train, settings: used.update(value=settings))
    scored = registry.batch_risk_scores(SampleWarehouse(spark, "/root/testdata/sf0.01"))
    assert scored.columns == RISK_SCORES.schema.names
    assert used == {"churn": models.ChurnSettings(), "value": tweedie.TweedieSettings()}


def test_trees_saved_together_are_the_fitted_ones(spark):
    rows = spark.range(80).select(
        array_to_vector(F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double"))).alias("x"), F.sin("id").alias("y")
    )
    fit = lambda depth: RandomForestRegressor(numTrees=1, bootstrap=False, featuresCol="x", labelCol="y", maxDepth=depth, seed=1).fit(rows)
    forests = [fit(depth) for depth in (3, 0, 5)]
    trees = ensembles.fitted_trees(forests, spark)
    assert [len(nodes) for _, nodes in trees] == [f.totalNumNodes for f in forests] and len(trees[1][1]) == 1
    model = ensembles.boosted_regression(spark, GBTRegressor(featuresCol="x", predictionCol="f"), trees, 2)
    for row in model.transform(rows).collect():
        assert row.f == pytest.approx(sum(f.predict(row.x) for f in forests))


def test_tables_of_all_accounts_are_not_broadcast(spark):
    few = spark.createDataFrame([("a", 1)], "account_id string, x int")
    joined = registry.beside(few, few.withColumnRenamed("x", "y"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and joined.collect() == [("a", 1, 1)]
