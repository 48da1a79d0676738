"""What MLlib's tree ensembles lack: patience, out-of-bag votes, random thresholds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark import SparkContext
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, RandomForestClassificationModel,
    RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from featherloom.functions.columns import key_digest, unit_interval
from featherloom.naming import quoted
from featherloom.parallel import run_parallel

#: Rounds of a first fit with patience, at least.
FIRST_ROUNDS = 8
#: Random thresholds of a feature in one tree.
THRESHOLDS = 16


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(round of least loss, from 1; whether ``patience`` rounds without gain followed it).

    Rounds after the stop do not count, even where they are better. Ties go to the earlier round; a
    loss that is not a number is no gain.
    """
    best, least = 1, float("inf")
    for i, loss in enumerate(losses, 1):
        if loss < least:
            best, least = i, loss
        elif i - best >= patience:
            return best, True
    return best, False


def boost_with_patience(estimator: GBTClassifier, train: DataFrame, held: DataFrame,
                        patience: int) -> tuple[GBTClassificationModel, int, list[float]]:
    """(model cut to its best round, that round, held-out loss of every round looked at).

    Rounds follow from the rows and the seed alone, so a longer fit begins with the shorter one. Fits
    double their rounds until the patience runs out or all rounds are done; the loss of every
    round comes from one pass over the held-out rows. Without held-out rows all rounds stay.
    """
    most = estimator.getMaxIter()
    rounds = min(most, max(FIRST_ROUNDS, 2 * patience))
    if held.isEmpty():
        return estimator.fit(train), most, []
    while True:
        model = estimator.copy({estimator.maxIter: rounds}).fit(train)
        losses = list(model.evaluateEachIteration(held))
        best, stopped = best_round(losses, patience)
        if stopped or rounds == most:
            break
        rounds = min(most, 2 * rounds)
    seen = losses[:best + patience] if stopped else losses
    return _first_rounds(model, best), best, seen


def _java_array(items: Sequence, kind: Callable) -> object:
    context = SparkContext._active_spark_context
    out = context._gateway.new_array(kind(context._jvm), len(items))
    for i, item in enumerate(items):
        out[i] = item
    return out


def _first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    java = model._java_obj
    trees = _java_array(list(java.trees())[:rounds], lambda jvm: jvm.org.apache.spark.ml.regression
                        .DecisionTreeRegressionModel)
    shares = _java_array(list(java.treeWeights())[:rounds], lambda jvm: jvm.double)
    out = GBTClassificationModel(SparkContext._active_spark_context._jvm.org.apache.spark.ml
                                 .classification.GBTClassificationModel(java.uid(), trees, shares))
    model._copyValues(out)
    return out


def poisson_count(u: Column, mean: float) -> Column:
    """Inverse distribution function of a Poisson count, as far as doubles tell it from 1."""
    mass, cumulated = np.exp(-mean), 0.0
    steps = []
    while cumulated + mass > cumulated or len(steps) <= mean:
        cumulated += mass
        steps.append((len(steps), cumulated))
        mass *= mean / len(steps)
    count = F.lit(len(steps))
    for i, limit in reversed(steps):
        count = F.when(u < F.lit(float(limit)), F.lit(i)).otherwise(count)
    return count


def draws(key: Column, tree: int, seed: int, share: float = 1.0) -> Column:
    """How often a tree draws a row: a Poisson count from a digest of key and seed + tree."""
    return poisson_count(unit_interval(key_digest(key, seed + tree)), share)


def fit_forest(estimator: RandomForestClassifier, train: DataFrame, key: str,
               weight: str | None = None, parallelism: int = 4
               ) -> tuple[RandomForestClassificationModel, Callable[[DataFrame, str], DataFrame]]:
    """(forest, function that adds the out-of-bag votes to the rows it was fitted on).

    Each tree has its own bag: ``draws`` of the row's key, as a row weight. The function adds
    ``<name>_trees``, the number of trees that did not draw the row, and ``name``, their mean
    probability of class 1; null if every tree drew the row. Rows of one key share their draws.
    """
    trees, seed = estimator.getNumTrees(), estimator.getSeed()
    share = estimator.getSubsamplingRate()

    def one(i: int) -> Callable[[], RandomForestClassificationModel]:
        def run() -> RandomForestClassificationModel:
            times = draws(quoted(key), i, seed, share).cast("double")
            rows = train.withColumn("__times", times).filter("__times > 0")
            if weight:
                rows = rows.withColumn("__times", F.col("__times") * quoted(weight))
            single = estimator.copy({
                estimator.numTrees: 1, estimator.bootstrap: False, estimator.seed: seed + i,
                estimator.subsamplingRate: 1.0})
            return single.setWeightCol("__times").fit(rows)
        return run

    members = run_parallel([one(i) for i in range(trees)], parallelism)
    first = members[0]
    array = _java_array([m._java_obj.trees()[0] for m in members], lambda jvm: jvm.org.apache.spark
                        .ml.classification.DecisionTreeClassificationModel)
    forest = RandomForestClassificationModel(
        SparkContext._active_spark_context._jvm.org.apache.spark.ml.classification
        .RandomForestClassificationModel(first._java_obj.uid(), array, first.numFeatures,
                                         first.numClasses))
    first._copyValues(forest, {first.numTrees: trees})

    def out_of_bag(df: DataFrame, name: str) -> DataFrame:
        columns = df.columns
        scored, votes = df, []
        for i, member in enumerate(members):
            raw, vec, hard = f"__raw{i}", f"__prob{i}", f"__hard{i}"
            scored = member.copy({member.rawPredictionCol: raw, member.probabilityCol: vec,
                                  member.predictionCol: hard}).transform(scored).drop(raw, hard)
            votes.append(F.when(draws(quoted(key), i, seed, share) == 0, vector_to_array(vec)[1]))
        votes = F.array_compact(F.array(*votes))
        total = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v)
        return scored.select(*map(quoted, columns), F.size(votes).alias(f"{name}_trees"),
                             (total / F.nullif(F.size(votes), F.lit(0))).alias(name))

    return forest, out_of_bag


def random_thresholds(df: DataFrame, features: str, trees: int, seed: int,
                      count: int = THRESHOLDS) -> DataFrame:
    """(tree, feature, number, cut): seeded random cut points between each feature's ends.

    A cut is low + u * (high - low), u from the digest of ``feature|tree|number`` and the seed. A
    feature of one value has equal cuts; an empty table has none.
    """
    x = df.select(F.posexplode(vector_to_array(quoted(features))).alias("feature", "value"))
    ends = x.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    numbered = (ends.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
                .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))))
    u = unit_interval(key_digest(F.concat_ws("|", "feature", "tree", "number"), seed))
    return numbered.select("tree", "feature", "number",
                           (F.col("low") + u * (F.col("high") - F.col("low"))).alias("cut"))


def fit_extra_trees(estimator: RandomForestClassifier, train: DataFrame, features: str,
                    weight: str | None = None, parallelism: int = 4, count: int = THRESHOLDS
                    ) -> tuple[Callable[[DataFrame, str], DataFrame], list[float]]:
    """(prediction, importances) of trees on all rows that split at random thresholds only.

    Every tree sees, for each feature, the number of its ``random_thresholds`` that the value
    reaches, so its splits are the best ones among them and a random subset of the features.
    """
    trees, seed = estimator.getNumTrees(), estimator.getSeed()
    table: dict[int, dict[int, list[float]]] = {}
    for r in random_thresholds(train, features, trees, seed, count).collect():
        table.setdefault(r["tree"], {}).setdefault(r["feature"], []).append(r["cut"])

    def reached(tree: int) -> Column:
        cuts = table.get(tree, {})
        levels = F.array(*[F.array(*[F.lit(float(c)) for c in sorted(cuts[j])])
                           for j in sorted(cuts)])
        return array_to_vector(F.transform(vector_to_array(quoted(features)), lambda v, j: F.size(
            F.filter(F.get(levels, j), lambda c: c <= v)).cast("double")))

    def one(i: int) -> Callable[[], RandomForestClassificationModel]:
        def run() -> RandomForestClassificationModel:
            single = estimator.copy({
                estimator.numTrees: 1, estimator.bootstrap: False, estimator.seed: seed + i,
                estimator.maxBins: max(2, count + 1), estimator.featuresCol: f"__cut{i}"})
            if weight:
                single.setWeightCol(weight)
            return single.fit(train.withColumn(f"__cut{i}", reached(i)))
        return run

    members = run_parallel([one(i) for i in range(trees)], parallelism)

    def predict(df: DataFrame, name: str) -> DataFrame:
        columns, scored = df.columns, df
        for i, member in enumerate(members):
            raw, vec, hard = f"__raw{i}", f"__prob{i}", f"__hard{i}"
            scored = member.copy({
                member.rawPredictionCol: raw, member.probabilityCol: vec, member.predictionCol: hard
            }).transform(scored.withColumn(f"__cut{i}", reached(i))).drop(raw, hard, f"__cut{i}")
        mean = sum((vector_to_array(f"__prob{i}")[1] for i in range(trees)), F.lit(0.0)) / trees
        return scored.select(*map(quoted, columns), mean.alias(name))

    shares = [m.featureImportances.toArray() for m in members]
    return predict, (sum(shares) / trees).tolist()
