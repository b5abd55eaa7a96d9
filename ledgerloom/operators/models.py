"""The models on Spark ML: a boosted-tree churn classifier, and value regressors (Tweedie boosting, Tweedie regression, boosted logs)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import ensembles, tweedie
from ledgerloom.operators.ensembles import best_round, stopping_curve
from ledgerloom.operators.metrics import classification_metrics
from ledgerloom.operators.splits import positive_weight, with_held_back
from ledgerloom.operators.threshold import threshold_value_added
from ledgerloom.operators.value import PREDICTION_FLOOR
from ledgerloom.schemas import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from ledgerloom.session import materialise, use_checkpoints
from ledgerloom.sources.sinks import write_json

FEATURES = "features"
VALUE_FEATURES = "value_features"
VALIDATION_SEED = 43
# Rounds of the first churn fit beyond the patience.
FIRST_ROUNDS = 4


@dataclass(frozen=True)
class ChurnSettings:
    """Boosting parameters; the share of features applies to every split.

    ``rounds`` is an upper limit: boosting ends at the first round where the logarithmic loss or the area under ROC of the validation
    share has not improved for ``patience`` rounds, and the rounds up to that measure's best one stay. ``validation_share`` of the
    training accounts, chosen by hash, only decides that and is not fitted, nor is any account with the features of one of them;
    without it all rounds stay.
    """

    rounds: int = 500
    depth: int = 6
    learning_rate: float = 0.05
    min_leaf: int = 20
    max_bins: int = 32
    row_share: float = 1.0
    feature_share: float = 0.8
    validation_share: float = 0.15
    patience: int = 30
    seed: int = 42


def feature_stages(unseen: str = "error", output: str = FEATURES, log_scale: bool = False) -> list:
    """Category codes, dummies and the assembled vector.

    Categories are coded in descending order and the last code is dropped, so the base level is the
    alphabetically first. ``unseen="keep"`` admits new levels at scoring time as a level of their own.
    Column names carry the output's name, so that two models can run over the same rows.
    """
    codes = [f"{output}_{c}_code" for c in CATEGORICAL_FEATURES]
    vectors = [f"{output}_{c}" for c in CATEGORICAL_FEATURES]
    numeric = [f"log_{n}" if log_scale else n for n in NUMERIC_FEATURES]
    return [
        StringIndexer(
            inputCols=list(CATEGORICAL_FEATURES), outputCols=codes, stringOrderType="alphabetDesc",
            handleInvalid=unseen,
        ),
        OneHotEncoder(inputCols=codes, outputCols=vectors, dropLast=True, handleInvalid=unseen),
        VectorAssembler(inputCols=[*numeric, *vectors], outputCol=output),
    ]


def feature_names(assembled: DataFrame, column: str = FEATURES) -> list[str]:
    """Slot names of an assembled vector, in slot order, with dummies as ``column_level``."""
    groups = assembled.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((slot["idx"], slot["name"]) for group in groups for slot in group)
    return [name.removeprefix(f"{column}_") for _, name in slots]


def unseen_levels(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Category values the encoder was not fitted on, with their account counts."""
    indexer = model.stages[0]
    pairs = F.explode(F.array(*(
        F.struct(F.lit(c).alias("name"), F.col(c).alias("level"), F.col(c).isin(*labels).alias("known"))
        for c, labels in zip(indexer.getInputCols(), indexer.labelsArray)
    )))
    return (
        features.select(pairs.alias("p")).where(~F.coalesce("p.known", F.lit(False)))
        .groupBy("p.name", "p.level").agg(F.count(F.lit(1)).alias("accounts"))
    )


def with_validation(train: DataFrame, share: float) -> DataFrame:
    """Add ``held_back``, the accounts that only decide when boosting ends; accounts of equal features lie on one side."""
    return with_held_back(train, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES], share, VALIDATION_SEED)


def positive_probability(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def fit_churn_model(train: DataFrame, settings: ChurnSettings = ChurnSettings(), unseen: str = "error") -> PipelineModel:
    """Fit encoder and classifier. Positives are weighted up to balance the classes.

    A fit of few rounds is measured at every prefix in one pass; if patience has not run out it is made anew with twice the rounds. The
    seed fixes the trees, so a longer fit begins with the shorter one, and all fits together cost less than twice the last.
    """
    spark = train.sparkSession
    counts = train.agg(F.sum(LABEL).alias("p"), F.count(F.lit(1)).alias("n"))
    weight = counts.select(positive_weight(F.col("p"), F.col("n"))).first()[0]  # one number
    ready = train.withColumns({
        "label": F.col(LABEL).cast("double"),
        "weight": F.when(F.col(LABEL) == 1, float(weight)).otherwise(1.0),
    })
    encoder = Pipeline(stages=feature_stages(unseen)).fit(ready)
    watchful = with_validation(ready, settings.validation_share)
    assembled = encoder.transform(watchful).select(FEATURES, "label", "weight", "held_back")
    assembled = materialise(assembled, "assembled")  # read by every fit and by the measures
    watched = assembled.where("held_back")
    rounds = settings.rounds if watched.isEmpty() else min(settings.rounds, settings.patience + FIRST_ROUNDS)
    while True:
        classifier = fit_rounds(assembled.where("NOT held_back"), settings, rounds)
        if watched.isEmpty():
            break
        curve = stopping_curve(ensemble_measures(classifier, watched), settings.patience)
        best, ended = best_round(curve, settings.patience)
        if ended or rounds >= settings.rounds:
            classifier = ensembles.first_rounds(classifier, best, spark)
            break
        rounds = min(settings.rounds, 2 * rounds)
    return PipelineModel(stages=[*encoder.stages, classifier])


def fit_rounds(rows: DataFrame, settings: ChurnSettings, rounds: int) -> GBTClassificationModel:
    """The classifier with exactly ``rounds`` trees."""
    use_checkpoints(rows.sparkSession)  # boosting cuts its lineage there every few rounds
    return GBTClassifier(
        featuresCol=FEATURES,
        labelCol="label",
        weightCol="weight",
        maxIter=rounds,
        maxDepth=settings.depth,
        maxBins=settings.max_bins,
        stepSize=settings.learning_rate,
        minInstancesPerNode=settings.min_leaf,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=str(settings.feature_share),
        seed=settings.seed,
        checkpointInterval=10,
    ).fit(rows)


def ensemble_measures(classifier: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """Loss and area under ROC of the first k rounds, for every k: (round, log_loss, roc_auc)."""
    trees = ensembles.tree_tables(classifier, rows.sparkSession)
    return ensembles.prefix_measures(ensembles.prefix_counts(rows, trees, FEATURES, "label"))


def transformed(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Run a fitted pipeline; a category it was not fitted on counts as the base level, which has no dummy.

    ``unseen_levels`` lists such categories. The category columns themselves stay as they are.
    """
    indexer = model.stages[0]
    known = {
        c: F.when(F.col(c).isin(*labels), F.col(c)).otherwise(labels[-1])
        for c, labels in zip(indexer.getInputCols(), indexer.labelsArray)
    }
    own = {f"_own_{c}": F.col(c) for c in known}
    result = model.transform(features.withColumns(own).withColumns(known))
    return result.withColumns({c: F.col(f"_own_{c}") for c in known}).drop(*own)


def churn_predictions(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The features with the assembled vector and ``churn_probability``."""
    return transformed(model, features).withColumn("churn_probability", positive_probability())


def log_scaled(features: DataFrame) -> DataFrame:
    """Add ``log_<name>`` = sign(x) * log(1 + |x|) for every numeric feature."""
    amounts = {n: F.col(n).cast("double") for n in NUMERIC_FEATURES}
    return features.withColumns({f"log_{n}": F.signum(x) * F.log1p(F.abs(x)) for n, x in amounts.items()})


def fit_value_model(train: DataFrame, target: str = "value_12m", unseen: str = "error") -> PipelineModel:
    """A Tweedie regression (variance power 1.5, log link) on standardised logarithmic inputs.

    The logarithm keeps the exponential link in range.
    """
    stages = feature_stages(unseen, VALUE_FEATURES, log_scale=True)
    scaler = StandardScaler(inputCol=VALUE_FEATURES, outputCol="value_scaled", withMean=True, withStd=True)
    regression = GeneralizedLinearRegression(
        featuresCol="value_scaled", labelCol=target, predictionCol="value_forecast",
        family="tweedie", variancePower=1.5, linkPower=0.0, regParam=0.01, maxIter=50,
    )
    return Pipeline(stages=[*stages, scaler, regression]).fit(log_scaled(train))


LOG_FORECAST = "log_value_forecast"
LOG_MEAN = "log_mean_forecast"


def fit_boosted_value_model(
    train: DataFrame, target: str = "value_12m", settings: ChurnSettings = ChurnSettings(), unseen: str = "error"
) -> PipelineModel:
    """Boosted trees on log(1 + value), with the churn model's parameters; they end at the first round that lowers no loss."""
    watchful = with_validation(train, settings.validation_share).withColumn("log_value", F.log1p(F.col(target)))
    needed = (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, "log_value", "held_back")
    ready = log_scaled(materialise(watchful.select(*needed), "watched"))  # every round reads it
    use_checkpoints(train.sparkSession)
    regressor = GBTRegressor(
        featuresCol=VALUE_FEATURES,
        labelCol="log_value",
        predictionCol=LOG_FORECAST,
        validationIndicatorCol="held_back",
        validationTol=0.0,
        maxIter=settings.rounds,
        maxDepth=settings.depth,
        maxBins=settings.max_bins,
        stepSize=settings.learning_rate,
        minInstancesPerNode=settings.min_leaf,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=str(settings.feature_share),
        seed=settings.seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[*feature_stages(unseen, VALUE_FEATURES, log_scale=True), regressor]).fit(ready)


def fit_tweedie_value_model(
    train: DataFrame,
    target: str = "value_12m",
    settings: tweedie.TweedieSettings = tweedie.TweedieSettings(),
    unseen: str = "error",
    validation_share: float = 0.15,
) -> PipelineModel:
    """Boosted trees on the Tweedie deviance (variance power 1.5, log link), stopped by a hash-chosen share of the accounts."""
    encoder = Pipeline(stages=feature_stages(unseen, VALUE_FEATURES, log_scale=True)).fit(log_scaled(train))
    watchful = log_scaled(with_validation(train, validation_share))
    rows = materialise(encoder.transform(watchful).select(VALUE_FEATURES, target, "held_back"), "watched")
    fitted = tweedie.fit(rows, VALUE_FEATURES, target, "held_back", LOG_MEAN, settings)
    return PipelineModel(stages=[*encoder.stages, fitted.model])


def value_predictions(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The rows with ``predicted_value``: the forecast of any of the value models, at least the floor."""
    forecast = transformed(model, log_scaled(features))
    scratch = [c for c in forecast.columns if c not in features.columns]
    scales = {LOG_FORECAST: F.expm1(F.col(LOG_FORECAST)), LOG_MEAN: F.exp(F.col(LOG_MEAN)), "value_forecast": F.col("value_forecast")}
    value = next(scale for name, scale in scales.items() if name in forecast.columns)
    return forecast.withColumn("predicted_value", F.greatest(value, F.lit(PREDICTION_FLOOR))).drop(*scratch)


# The fields of a model's notes.
METADATA_SCHEMA = T.StructType([
    T.StructField("model_type", T.StringType()),
    T.StructField("best_iteration", T.IntegerType()),
    T.StructField("optimal_threshold", T.DoubleType()),
    T.StructField("metrics", T.StructType([
        T.StructField(n, T.DoubleType()) for n in ("roc_auc", "pr_auc", "brier_score")
    ])),
    T.StructField("financial_optimization", T.StructType([
        T.StructField(n, T.DoubleType())
        for n in (
            "optimal_threshold", "max_net_savings_test_set_usd", "default_0_5_savings_usd", "value_added_usd",
        )
    ])),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
])


def metadata_of(tested: DataFrame, model_type: str, rounds: int, names: list[str]) -> DataFrame:
    """One row on a scored hold-out: metrics, the best threshold and its worth."""
    read = materialise(tested.select(LABEL, "churn_probability", "current_mrr"), "tested")
    quality = classification_metrics(read, LABEL, "churn_probability").first()
    money = threshold_value_added(read, "churn_probability", LABEL, "current_mrr").first()
    metrics = tuple(None if m is None else round(m, 4) for m in quality)
    row = (model_type, rounds, money["optimal_threshold"], metrics, tuple(money), names)
    return tested.sparkSession.createDataFrame([row], METADATA_SCHEMA)


def churn_metadata(model: PipelineModel, tested: DataFrame) -> DataFrame:
    """One row on a fitted classifier: rounds, hold-out metrics, the best threshold and its worth, slot names."""
    return metadata_of(tested, "Gradient-boosted tree classifier", model.stages[-1].getNumTrees, feature_names(tested))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_metadata(metadata: DataFrame, path: str) -> None:
    write_json(metadata, path)


def load_threshold(spark: SparkSession, path: str) -> float:
    """The best threshold a saved metadata row carries."""
    row = spark.read.schema(METADATA_SCHEMA).json(path).select("financial_optimization.optimal_threshold").first()
    return row[0]
