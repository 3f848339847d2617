"""Seeded Spark ML estimators, scoring and model inspection.

Every estimator that samples takes a mandatory ``seed``. Results also depend on the input
partitioning, so fits run on a materialised (checkpointed) frame whose partitioning is fixed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo import schemas as S
from relevo.models.vectors import TableWord2Vec, bounded
from relevo.session import shared_table


#: Training tasks of Word2Vec (and partitions of its input), whatever the machine.
W2V_PARTITIONS = 8


def dense_features(*cols: str, out: str = "features") -> Column:
    """A dense vector from numeric columns, as a built-in expression (no Python per row)."""
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in cols])).alias(out)


def assembler(input_cols: Sequence[str], output_col: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col)


def linear(features_col: str = "features", label_col: str = S.LABEL, max_iter: int = 10,
           reg_param: float = 0.0, elastic_net: float = 0.8, tol: float = 1e-6) -> LinearRegression:
    """Linear regression; with ``reg_param=0`` it is ordinary least squares (normal equations)."""
    return LinearRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter,
                            regParam=reg_param, elasticNetParam=elastic_net, tol=tol)


def logistic(features_col: str = "features", label_col: str = "label", max_iter: int = 10,
             reg_param: float = 0.3, elastic_net: float = 0.8) -> LogisticRegression:
    """Logistic regression. Integer labels 1..k give k + 1 classes (class 0 unused)."""
    return LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter,
                              regParam=reg_param, elasticNetParam=elastic_net)


def forest(*, seed: int, features_col: str = "features", label_col: str = S.LABEL,
           num_trees: int = 20, max_depth: int = 5, bootstrap: bool = True) -> RandomForestRegressor:
    """A random forest; ``bootstrap=False`` with one tree is a plain regression tree on all rows."""
    return RandomForestRegressor(featuresCol=features_col, labelCol=label_col, numTrees=num_trees,
                                 maxDepth=max_depth, seed=seed, bootstrap=bootstrap)


def root_split(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """(feature, threshold, left, right) of a forest's first tree: the split of its root, and the
    predictions of the two children. No row if the tree is a single leaf."""
    root = model.trees[0]._java_obj.rootNode()
    rows = []
    if root.subtreeDepth() > 0:
        split = root.split()
        rows = [(names[split.featureIndex()], split.threshold(), root.leftChild().prediction(), root.rightChild().prediction())]
    return spark.createDataFrame(rows, "feature string, threshold double, left double, right double")


def word2vec(*, seed: int, input_col: str, output_col: str, vector_size: int = 3,
             min_count: int = 5, num_partitions: int = W2V_PARTITIONS, max_iter: int = 1) -> Word2Vec:
    """Word2Vec in ``num_partitions`` training tasks.

    The number is part of the model, not of the machine: vectors depend on it, so it is a fixed
    default and never taken from the cores at hand. The vocabulary and vectors are tables; every training
    task holds them (vocabulary x vector_size numbers, twice), which bounds the vocabulary a corpus may
    have; ``min_count`` is the knob.
    """
    return TableWord2Vec(vectorSize=vector_size, minCount=min_count, inputCol=input_col,
                    outputCol=output_col, seed=seed, numPartitions=num_partitions, maxIter=max_iter)


def checked_vocabulary(tokens: DataFrame, col: str, estimator: Word2Vec, most: int | None = None) -> int:
    """The number of words a Word2Vec fit on these token rows keeps; an error if they are too many.

    Every training task holds all vectors. Counting the words first, as a fit does, turns a late out-of-memory
    failure into an early error that names the bound.
    """
    n = tokens.select(F.explode(col).alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= estimator.getMinCount()).count()
    return bounded(n, estimator.getVectorSize(), most)


def word_vectors(model) -> DataFrame:
    """(word, vector) of a Word2Vec model as a table in the shared folder, vectors as arrays."""
    return shared_table(model.getVectors().select("word", vector_to_array("vector").alias("vector")), "word-vectors")


def mean_vectors(df: DataFrame, text_col: str, tokens: Column, vectors: DataFrame, size: int, out: str = "vec") -> DataFrame:
    """``df`` with the mean word vector of each text, words outside the vocabulary counting as zeros.

    What a Word2Vec model's transform computes, as joins: each distinct text is split (``tokens``, over ``text_col``)
    and meets the vectors table once, and rows get their text's mean. Nothing that grows with
    the vocabulary is broadcast or sent with a closure. A text without words, or a NULL one, gives zeros.
    """
    texts = shared_table(df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("_text")).distinct(), "texts")
    words = texts.withColumnRenamed("_text", text_col).select(F.col(text_col).alias("_text"), F.explode(tokens).alias("word"))
    sums = [F.sum(F.coalesce(F.col("vector")[i], F.lit(0.0))).alias(f"_s{i}") for i in range(size)]
    means = words.join(vectors, "word", "left").groupBy("_text").agg(F.count("*").alias("_n"), *sums)
    means = shared_table(means.select("_text", F.array(*[F.col(f"_s{i}") / F.col("_n") for i in range(size)]).alias("_mean")), "mean-vectors")
    zeros = F.array(*[F.lit(0.0)] * size)
    joined = df.join(means, F.col(text_col) == F.col("_text"), "left")
    return joined.withColumn(out, array_to_vector(F.coalesce("_mean", zeros))).drop("_text", "_mean")


def vector_indexer(input_col: str, output_col: str, max_categories: int = 20) -> VectorIndexer:
    """Columns of few distinct values become categories; a value not seen in training is one more."""
    return VectorIndexer(inputCol=input_col, outputCol=output_col, maxCategories=max_categories,
                         handleInvalid="keep")


def pipeline(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))


def grid(estimator_param, values: Sequence) -> list:
    """A parameter grid over one parameter (``ParamGridBuilder().addGrid(p, values).build()``)."""
    return ParamGridBuilder().addGrid(estimator_param, list(values)).build()


def train_validation(estimator, param_grid: list, *, seed: int, label_col: str = S.LABEL,
                     train_ratio: float = 0.8, parallelism: int = 1) -> TrainValidationSplit:
    """One random train/validation split, best grid point by RMSE, refit on all rows."""
    return TrainValidationSplit(estimator=estimator, estimatorParamMaps=param_grid,
                                evaluator=RegressionEvaluator(labelCol=label_col, metricName="rmse"),
                                trainRatio=train_ratio, seed=seed, parallelism=parallelism)


def hashed_fold(id_col: str = S.ID, digits: str = "012") -> Column:
    """Rows held out by a hash: the first hexadecimal digit of the id's MD5 is one of ``digits``."""
    first = F.substring(F.md5(F.col(id_col).cast("string").cast("binary")), 1, 1)
    return first.isin(*digits)


def hashed_search(estimator, param_grid: list, df: DataFrame, held_out: Column, label_col: str = S.LABEL):
    """(model, metrics): a grid search on a stated split instead of a random one.

    Every grid point is fitted on the rows that are not held out and measured by RMSE on the held-out
    ones; the best (the first of equals) is fitted again on all rows. ``metrics`` has a list (parameter map, RMSE) in
    grid order. The same rows are held out on every run and every cluster.
    """
    kept, rest = df.where(~held_out), df.where(held_out)
    metrics = [(params, rmse(estimator.fit(kept, params).transform(rest), label_col).first()["rmse"]) for params in param_grid]
    best = min(metrics, key=lambda x: x[1])[0]
    return estimator.fit(df, best), metrics


def optimality(df: DataFrame, model, reg_param: float, elastic_net: float, features_col: str = "features", label_col: str = S.LABEL,
               tolerance: float = 1e-4) -> DataFrame:
    """(feature, coefficient, slope, optimal): whether a linear model solves its elastic-net problem.

    The problem is strictly convex in standardised features and label, so a point is the solution exactly if, for
    every feature, the correlation of the residual with it (``slope``) equals the L2 pull of its
    coefficient plus the L1 pull: of the coefficient's sign, or anything up to it for a zero coefficient.
    A feature that is constant has slope 0 and must have no coefficient. All moments are one aggregate over
    the rows the model was fitted on.
    """
    lin = model.stages[-1] if isinstance(model, PipelineModel) else model
    beta = [float(v) for v in lin.coefficients.toArray()]
    x = vector_to_array(F.col(features_col))
    rows = lin.transform(df.select(features_col, F.col(label_col).cast("double").alias(label_col)))
    rows = rows.select(F.col(label_col).alias("y"), (F.col(label_col) - F.col("prediction")).alias("r"), F.posexplode(x).alias("feature", "x"))
    sums = rows.groupBy("feature").agg(F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy"), F.covar_pop("x", "r").alias("c"))
    own = F.element_at(F.array(*[F.lit(b) for b in beta]), F.col("feature") + 1)
    scaled = sums.select("feature", own.alias("coefficient"), F.coalesce(F.try_divide("c", F.col("sx") * F.col("sy")), F.lit(0.0)).alias("slope"),
                         F.when(F.col("sx") > 0, F.try_divide(own * F.col("sx"), "sy")).otherwise(own).alias("b"), F.try_divide(F.lit(reg_param), "sy").alias("reg"))
    gap = F.when(F.col("b") == 0, F.greatest(F.abs("slope") - elastic_net * F.col("reg"), F.lit(0.0))).otherwise(
        F.abs(F.col("slope") - (1 - elastic_net) * F.col("reg") * F.col("b") - elastic_net * F.col("reg") * F.signum("b")))
    return scaled.select("feature", "coefficient", "slope", (gap <= tolerance).alias("optimal"))


def score(model, df: DataFrame, id_col: str = S.ID) -> DataFrame:
    """Submission rows: (id, relevance) where relevance is the model's prediction."""
    return model.transform(df).select(id_col, F.col("prediction").alias(S.LABEL))


def coefficients(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """A linear model's coefficients and intercept as rows (term, value).

    The model is a handful of numbers on the driver (that is where Spark ML keeps it); this only
    turns them into a small table.
    """
    lin = model.stages[-1] if isinstance(model, PipelineModel) else model
    values = [float(v) for v in lin.coefficients.toArray()]
    rows = list(zip(list(names), values)) + [("intercept", float(lin.intercept))]
    return spark.createDataFrame(rows, "term string, value double")


def rmse(df: DataFrame, label_col: str = S.LABEL, prediction_col: str = "prediction") -> DataFrame:
    """Root mean squared error as a one-row aggregate (partial sums per task, one final merge)."""
    err = F.col(label_col).cast("double") - F.col(prediction_col)
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def probabilities(prob_col: str = "probability", out: str = "prob") -> Column:
    """The probability vector as an array (exportable, comparable)."""
    return vector_to_array(F.col(prob_col)).alias(out)
