"""Grouped model evaluation on MLlib."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import boosting as leafwise, forest as bagged
from trackmetrics.operators.ranks import average_rank, value_ranks
from trackmetrics.operators.skew import attach
from trackmetrics.session import materialise

FOLDS = 5
SEED = 42
# Models fitted, or columns permuted, at a time.
SIDE_BY_SIDE = 4


class Setting(NamedTuple):
    """Boosting setting of :mod:`trackmetrics.operators.boosting`."""

    step: float
    leaves: int
    leaf_rows: int
    rounds: int


# The eight boosting settings compared.
BOOSTING = (
    Setting(step=0.05, leaves=31, leaf_rows=20, rounds=400), Setting(step=0.05, leaves=63, leaf_rows=40, rounds=400),
    Setting(step=0.05, leaves=15, leaf_rows=20, rounds=600), Setting(step=0.10, leaves=31, leaf_rows=20, rounds=300),
    Setting(step=0.10, leaves=63, leaf_rows=40, rounds=200), Setting(step=0.10, leaves=15, leaf_rows=50, rounds=400),
    Setting(step=0.03, leaves=31, leaf_rows=30, rounds=800), Setting(step=0.15, leaves=31, leaf_rows=20, rounds=200),
)


# -- splits --------------------------------------------------------------------------


def bucket(group: Column, seed: int, n: int) -> Column:
    return F.pmod(F.xxhash64(group, F.lit(seed)), F.lit(n)).cast("int")


def group_holdout(df: DataFrame, group: str, test_pct: int = 20, seed: int = SEED) -> DataFrame:
    """``is_test`` decided by the group, so no group lies on both sides."""
    return df.withColumn("is_test", bucket(F.col(group), seed, 100) < test_pct)


def group_folds(df: DataFrame, group: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """``fold`` per row: whole groups, folds of similar size.

    Groups are ranked by size, equal sizes by a hash, and dealt in a snake: 0 to folds - 1, then back.  The ranks are exact and
    distributed, so one rule holds for any number of groups and any group size.
    """
    sizes = df.groupBy(group).agg(n_rows().alias("__n"))
    # one number per group: size above, hash below; groups that agree in both share a fold
    keyed = sizes.withColumn("__place", -(F.col("__n") * F.lit(1 << 31)) + F.pmod(F.xxhash64(group, F.lit(seed)), F.lit(1 << 31)))
    ranks = value_ranks(keyed, "__place").select(F.col("value").alias("__place"), (F.col("upto") - 1).alias("__r"))
    turn = F.pmod(F.col("__r"), F.lit(2 * folds))
    fold = F.when(turn < folds, turn).otherwise(F.lit(2 * folds - 1) - turn).cast("int")
    dealt = keyed.join(ranks, "__place").select(group, "__n", fold.alias("fold"))
    return attach(df, dealt, [group], "__n", df.columns).drop("__n")


# -- models -----------------------------------------------------------------------------


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights: rows / (2 x rows of the class), from one scalar subquery."""
    share = df.agg(F.avg(F.col(target).cast("double"))).scalar()
    return df.withColumn("weight", F.when(F.col(target) == 1, F.lit(0.5) / share).otherwise(F.lit(0.5) / (F.lit(1.0) - share)))


def forest(features: Sequence[str], target: str, trees: int = 300, depth: int = 30) -> Estimator:
    return Pipeline(stages=[bagged.Forest(features, target, trees, depth, leaf_rows=5, seed=SEED)])


def logistic(features: Sequence[str], target: str, indicators: Sequence[str] = ()) -> Estimator:
    """Median imputation of the raw nulls, scaling and regression; all fitted inside the fold."""
    filled = [f"{c}_filled" for c in features]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(features), outputCols=filled, relativeError=0.001),
        VectorAssembler(inputCols=[*filled, *indicators], outputCol="raw_x"),
        StandardScaler(inputCol="raw_x", outputCol="x", withMean=True),
        LogisticRegression(featuresCol="x", labelCol=target, weightCol="weight", maxIter=100),
    ])


def fitted(make: Callable[[], Estimator], train: DataFrame, target: str) -> PipelineModel:
    """A model of ``train`` with balanced weights, without its training summary.

    Scoring sends the model to the tasks.  The summary holds the session, which cannot be sent once any query was observed in it.
    """
    model = make().fit(class_weights(train, target))
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return model


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with ``score``; a forest gives the label and the score alone."""
    if isinstance(model.stages[-1], bagged.ForestModel):
        return model.transform(df)
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


# -- metrics ------------------------------------------------------------------------------


def metrics(scored: DataFrame, target: str, p: str = "score", cut: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 and the confusion counts at one threshold."""
    yes, hit = F.col(target) == 1, F.col(p) >= cut
    c = scored.agg(
        F.count_if(yes & hit).alias("tp"), F.count_if(~yes & hit).alias("fp"), F.count_if(yes & ~hit).alias("fn"), F.count_if(~yes & ~hit).alias("tn"),
    )
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision, recall = zero(F.col("tp"), F.col("tp") + F.col("fp")), zero(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(
        "tp", "fp", "fn", "tn",
        F.round(zero(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")), 4).alias("accuracy"),
        F.round(precision, 4).alias("precision"), F.round(recall, 4).alias("recall"),
        F.round(zero(F.lit(2.0) * precision * recall, precision + recall), 4).alias("f1"),
    )


def auc(scored: DataFrame, target: str, p: str = "score") -> DataFrame:
    """Exact area under the ROC curve from average ranks, as the Mann-Whitney statistic."""
    ranked = value_ranks(scored, p, carry={"pos": (F.col(target) == 1).cast("long")})
    rank_sum = F.sum(F.col("pos") * average_rank())
    pos, n = F.sum("pos"), F.sum("n")
    u = rank_sum - pos * (pos + 1) / 2
    return ranked.agg(n.alias("n"), pos.alias("positives"), F.round(F.try_divide(u, pos * (n - pos)), 6).alias("auc"))


def average_precision(scored: DataFrame, target: str, p: str = "score") -> DataFrame:
    """Exact area under the precision-recall curve: precision at each distinct score, weighted by the recall it adds."""
    flipped = scored.withColumn("__down", -F.col(p).cast("double"))
    ranked = value_ranks(flipped, "__down", carry={"pos": (F.col(target) == 1).cast("long")})
    area = F.sum(F.col("pos") * F.col("pos_upto") / F.col("upto"))
    return ranked.agg(F.round(F.try_divide(area, F.sum("pos")), 6).alias("auc_pr"))


def precision_at_recall(scored: DataFrame, target: str, p: str = "score", recall: float = 0.75) -> DataFrame:
    """The highest threshold whose recall reaches the level, with its precision and recall.

    Cumulative counts per distinct score; equal scores share one threshold.
    """
    flipped = scored.withColumn("__down", -F.col(p).cast("double"))
    ranked = value_ranks(flipped, "__down", carry={"pos": (F.col(target) == 1).cast("long")})
    total = ranked.agg(F.sum("pos")).scalar()
    reached = ranked.where(F.col("pos_upto") >= F.lit(recall) * total)
    best = reached.agg(F.min(F.struct("value", "upto", "pos_upto")).alias("b"))
    return best.select(
        (-F.col("b.value")).alias("threshold"), F.round(F.col("b.pos_upto") / F.col("b.upto"), 6).alias("precision"),
        F.round(F.col("b.pos_upto") / total, 6).alias("recall"),
    )


# -- protocols ----------------------------------------------------------------------------


def side_by_side(job: Callable, of: Iterable) -> list:
    """Results of independent jobs, in order; the driver only submits them, and a few run at a time.

    Most levels of a deep forest give the cluster one small stage, so one model after another leaves most cores idle.
    """
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return list(pool.map(job, of))


def held_out(train: DataFrame, test: DataFrame, target: str, make: Callable[[], Estimator], name: str) -> DataFrame:
    """Stored scores of ``test`` by a model that saw only ``train``, its class weights included."""
    estimator = make().getStages()[-1]
    if isinstance(estimator, bagged.Forest):
        return materialise(estimator.held_out(train, test), f"scored-{name}")
    model = fitted(make, train, target)
    return materialise(score(model, test).select(target, "score"), f"scored-{name}")


def cross_validate(df: DataFrame, target: str, make: Callable[[], Estimator], name: str) -> list[tuple]:
    """(name, fold, rows, AUC, AUC-PR, threshold at the recall level) per fold; ``df`` has a ``fold`` column."""
    def run(fold: int) -> tuple:
        scored = held_out(df.where(F.col("fold") != fold), df.where(F.col("fold") == fold), target, make, name)
        return fold_result(scored, target, name, fold)

    return side_by_side(run, folds_of(df))


def folds_of(df: DataFrame) -> list[int]:
    return [r["fold"] for r in df.select("fold").distinct().orderBy("fold").collect()]  # a handful of folds


def fold_result(scored: DataFrame, target: str, name: str, fold: int) -> tuple:
    roc, area, cut = auc(scored, target).first(), average_precision(scored, target).first(), precision_at_recall(scored, target).first()
    return name, fold, roc["n"], roc["auc"], area["auc_pr"], cut["threshold"]


def cross_validate_boosting(df: DataFrame, features: Sequence[str], target: str, key: str, setting: Setting, name: str) -> list[tuple]:
    """As :func:`cross_validate`, for the leaf-wise trees: the models of all folds are fitted side by side."""
    folds = folds_of(df)
    models = leafwise.load(leafwise.fit(df, features, target, key, {f: leafwise.Task(setting, F.col("fold") != f) for f in folds}))

    def run(fold: int) -> tuple:
        scored = leafwise.score(df.where(F.col("fold") == fold), features, models.get(fold)).select(target, "score")
        return fold_result(materialise(scored, f"scored-{name}"), target, name, fold)

    return side_by_side(run, folds)


def mean_auc(results: DataFrame) -> DataFrame:
    return results.groupBy("model").agg(
        n_rows().alias("folds"), F.avg("threshold").alias("threshold"), F.round(F.avg("auc"), 4).alias("mean_auc"), F.round(F.stddev_pop("auc"), 4).alias("std_auc")
    )


def holdout_auc(df: DataFrame, target: str, make: Callable[[], Estimator], is_test: Column) -> float:
    return auc(held_out(df.where(~is_test), df.where(is_test), target, make, "holdout"), target).first()["auc"]


def impurity_ranking(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Impurity importance of each feature; one number per column of the model."""
    values = model.stages[-1].featureImportances.toArray()
    return sorted(((f, float(v)) for f, v in zip(features, values)), key=lambda x: (-x[1], x[0]))


def with_donor(df: DataFrame, columns: Sequence[str], row: str, seed: int = SEED) -> DataFrame:
    """Each row with a struct ``donor``: the columns of the row a third of the table further in a hash order.

    Ranks come from :func:`value_ranks` on a row hash, so the shuffle of the rows
    is exact, repeatable and distributed, and one join serves all columns.
    """
    keyed = df.withColumn("__h", F.xxhash64(row, F.lit(seed)))
    ranks = value_ranks(keyed, "__h").select(F.col("value").alias("__h"), F.col("upto").alias("__r"), "total")
    placed = keyed.join(ranks, "__h")
    shift = F.floor(F.col("total") / 3)
    giver = placed.select(F.pmod(F.col("__r") + shift, F.col("total")).alias("__slot"), F.struct(*columns).alias("donor"))
    taker = placed.withColumn("__slot", F.pmod(F.col("__r"), F.col("total")))
    return taker.join(giver, "__slot").drop("__slot", "__h", "__r", "total")


def permutation_ranking(model: PipelineModel, paired: DataFrame, target: str, features: Sequence[str]) -> list[tuple[str, float]]:
    """Loss of AUC when one feature of a forest comes from the donor row; ``paired`` is a stored :func:`with_donor`."""
    scored = materialise(model.stages[-1].permuted(paired), "permuted")
    exact = lambda i: auc(scored.select(target, F.col("scores")[i].alias("score")), target).first()["auc"]
    base, *permuted = side_by_side(exact, range(len(features) + 1))
    drops = [(f, round(base - a, 6)) for f, a in zip(features, permuted)]
    return sorted(drops, key=lambda x: (-x[1], x[0]))


def publish(model: PipelineModel | DataFrame, path: str, metadata: Mapping[str, object]) -> None:
    """Write the model (a pipeline, or a table of trees) and a JSON document with its features, threshold and score."""
    if isinstance(model, DataFrame):
        model.write.mode("overwrite").parquet(f"{path}/model")
    elif isinstance(model.stages[-1], bagged.ForestModel):
        model.stages[-1].save(f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(dict(metadata), sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def published(spark: SparkSession, path: str, name: str) -> PipelineModel:
    """The pipeline that :func:`publish` wrote; ``name`` tells a forest from one of MLlib."""
    return PipelineModel([bagged.load(spark, f"{path}/model")]) if name == "forest" else PipelineModel.load(f"{path}/model")
