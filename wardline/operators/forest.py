"""A class-balanced random forest with selected features and searched parameters, scored out of fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.saved import saved
from wardline.operators.stats import class_weights, k_fold


def fit_forest(train: DataFrame, *, y: str, features: Sequence[str], select: int, depths: Sequence[int], trees: Sequence[int], inner_folds: int = 2, seed: int = 1) -> CrossValidatorModel:
    """Imputation, univariate selection and a forest, all fitted anew on each inner fold for each choice of parameters; the best by area under the curve.

    Rows weigh by the inverse share of their class in ``train``. Inner folds come from the column ``inner``, so they do not depend on how rows are dealt.
    """
    weighted = train.join(F.broadcast(class_weights(train, y)), y)  # two classes
    filled = [f"{f}_filled" for f in features]
    forest = RandomForestClassifier(labelCol=y, featuresCol="chosen", weightCol="weight", seed=seed)
    selector = UnivariateFeatureSelector(featuresCol="all", outputCol="chosen", labelCol=y, selectionMode="numTopFeatures").setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(select)
    steps = Pipeline(stages=[Imputer(inputCols=list(features), outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="all"), selector, forest])
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).addGrid(forest.numTrees, list(trees)).build()
    search = CrossValidator(estimator=steps, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=y), numFolds=inner_folds, foldCol="inner", seed=seed, parallelism=2)
    return search.fit(weighted)


def out_of_fold_scores(rows: DataFrame, *, key: str, y: str, features: Sequence[str], select: int, folds: int = 5, depths: Sequence[int] = (5, 10), trees: Sequence[int] = (50,), inner_folds: int = 2, seed: int = 1) -> DataFrame:
    """Each row with its ``fold`` and the ``score`` of a model that has seen no row of that fold: not in its selection, its weights, its search or its trees.

    Folds are hashes of the key. Rows without a label are scored, and no model learns from them.
    """
    # written, as each step of each fit reads the rows again, and a lookup among them would pass the driver each time
    dealt = saved(k_fold(rows, key, folds, seed=seed).withColumn("inner", F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(inner_folds)).cast("int")))
    out = None
    for fold in range(folds):
        model = fit_forest(dealt.where((F.col("fold") != fold) & F.col(y).isNotNull()), y=y, features=features, select=select, depths=depths, trees=trees, inner_folds=inner_folds, seed=seed)
        scored = model.transform(dealt.where(F.col("fold") == fold)).select(*rows.columns, "fold", vector_to_array("probability")[1].alias("score"))
        out = scored if out is None else out.union(scored)
    return out
