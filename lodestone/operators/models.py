"""Feature pipelines, clustering, classification and regression on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (IDF, PCA, CountVectorizer, ElementwiseProduct, IndexToString,
                                Normalizer, OneHotEncoder, RegexTokenizer, StandardScaler,
                                StopWordsRemover, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import english_stop_words
from lodestone.operators.aggregate import class_means
from lodestone.operators.metrics import regression_metrics
from lodestone.operators.svm import one_against_rest
from lodestone.session import cut_lineage, dealt

MIN_ROWS = 50


def stable_split(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``is_train``, decided by a hash of key and seed: the same under any partitioning and
    on every re-run, so a lost task cannot move a row to the other side."""
    return df.withColumn("is_train", _hashed(key, seed) % 10_000 < int(round(train * 10_000)))


def _hashed(key: str, seed: int) -> Column:
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def halves(df: DataFrame, key: str, train: float = 0.8, seed: int = 42):
    marked = stable_split(df, key, train, seed)
    return (marked.filter("is_train").drop("is_train"),
            marked.filter(~F.col("is_train")).drop("is_train"))


# Features ---------------------------------------------------------------------------------


def scaled_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                    out: str = "features") -> tuple[DataFrame, PipelineModel]:
    """Alphabetical codes for categories, then one standardised vector."""
    coded = [f"{c}_code" for c in categorical]
    stages = [StringIndexer(inputCols=list(categorical), outputCols=coded,
                            stringOrderType="alphabetAsc", handleInvalid="keep")] if coded else []
    stages += [VectorAssembler(inputCols=[*numeric, *coded], outputCol="_raw",
                               handleInvalid="error"),
               StandardScaler(inputCol="_raw", outputCol=out, withMean=True, withStd=True)]
    model = Pipeline(stages=stages).fit(df)
    return model.transform(df).drop("_raw"), model


def target_means(df: DataFrame, key: str, category: str, target: str, folds: int = 5,
                 weight: float = 10.0, seed: int = 42, name: str = "target_mean") -> DataFrame:
    """Add ``name``, a number for a category of any width: the mean target of its rows in the other
    folds, drawn towards the mean of all rows by ``weight`` rows.

    A row's own fold (a hash of its key) takes no part, so its target does not leak into it; a
    category that no other fold holds gets the overall mean, and so do rows without one. Sums are made
    per category and fold in the tasks; categories never meet on the driver or in one array.
    """
    marked = df.withColumn("_fold", (_hashed(key, seed) % folds).cast("int"))
    sums = marked.filter(F.col(category).isNotNull()).groupBy(
        F.col(category).alias("_c"), F.col("_fold").alias("_f")).agg(
        F.sum(target).alias("_s"), F.count(target).alias("_n"))
    whole = Window.partitionBy("_c")  # one row for each fold
    others = sums.select("_c", "_f", (F.sum("_s").over(whole) - F.coalesce("_s", F.lit(0.0))).alias("_s"),
                         (F.sum("_n").over(whole) - F.col("_n")).alias("_n"))
    overall = df.agg(F.avg(target)).scalar()
    same = (F.col(category) == F.col("_c")) & (F.col("_fold") == F.col("_f"))
    mean = ((F.coalesce("_s", F.lit(0.0)) + weight * overall) / (F.coalesce("_n", F.lit(0)) + weight))
    return marked.join(others, same, "left").withColumn(name, mean).drop("_fold", "_c", "_f", "_s", "_n")


def fit_counts(df: DataFrame, text: str, vocab: int, out: str, pattern: str = r"[\p{L}\p{N}_]{2,}",
               stop: Sequence[str] | None = None) -> PipelineModel:
    """Word counts ``_{out}_c`` over the ``vocab`` commonest words of the rows given (training rows)."""
    stop = english_stop_words() if stop is None else list(stop)
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol=f"_{out}_w", pattern=pattern, gaps=False,
                       toLowercase=True, minTokenLength=1),
        StopWordsRemover(inputCol=f"_{out}_w", outputCol=f"_{out}_k", stopWords=stop),
        CountVectorizer(inputCol=f"_{out}_k", outputCol=f"_{out}_c", vocabSize=vocab),
    ]).fit(df)


def fit_weights(counted: DataFrame, out: str) -> PipelineModel:
    """Counts ``_{out}_c`` times (ln((1+N)/(1+df)) + 1) at unit length, fitted on the rows given."""
    idf = IDF(inputCol=f"_{out}_c", outputCol="_idf").fit(counted)
    weights = Vectors.dense([float(x) + 1.0 for x in idf.idf.toArray()])
    return PipelineModel(stages=[
        ElementwiseProduct(scalingVec=weights, inputCol=f"_{out}_c", outputCol=f"_{out}_t"),
        Normalizer(inputCol=f"_{out}_t", outputCol=out, p=2.0),
    ])


def fit_tfidf(df: DataFrame, text: str, vocab: int, out: str, pattern: str = r"[\p{L}\p{N}_]{2,}",
              stop: Sequence[str] | None = None) -> PipelineModel:
    """tf * (ln((1+N)/(1+df)) + 1) at unit length, fitted on the rows given (training rows)."""
    counting = fit_counts(df, text, vocab, out, pattern, stop)
    return PipelineModel(stages=[*counting.stages, *fit_weights(counting.transform(df), out).stages])


def pca_2d(df: DataFrame, features: str = "features") -> tuple[DataFrame, list[float]]:
    """First two principal components of centred features, and their share of the variance."""
    model = PCA(k=2, inputCol=features, outputCol="_pc").fit(df)
    xy = vector_to_array("_pc")
    out = model.transform(df).withColumns({"pc1": xy[0], "pc2": xy[1]}).drop("_pc")
    return out, [float(x) for x in model.explainedVariance]


# Clusters ---------------------------------------------------------------------------------


def elbow(df: DataFrame, ks: Sequence[int] = range(2, 11), features: str = "features",
          seed: int = 42) -> DataFrame:
    """Within-cluster sum of squares per k. Equal vectors are folded into one with their number as its
    weight, which is the same sum. They are persisted over the sweep; memory and disk, so nothing is
    recomputed when they do not fit."""
    folded = df.groupBy(features).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    held = dealt(folded, features).persist()
    try:
        rows = [(k, float(KMeans(k=k, seed=seed, featuresCol=features, weightCol="_n").fit(held)
                          .summary.trainingCost)) for k in ks]
    finally:
        held.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def kmeans(df: DataFrame, k: int = 4, features: str = "features", seed: int = 42,
           name: str = "cluster"):
    """(rows with their cluster, fitted model)."""
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol=name).fit(df)
    return model.transform(df), model


def silhouette(df: DataFrame, features: str = "features", name: str = "cluster") -> float:
    """Mean silhouette (squared Euclidean; linear in the rows)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=name).evaluate(df)


def scaled_centres(model, names: Sequence[str], spark) -> DataFrame:
    """Cluster centres with every feature scaled to 0..1 over the clusters."""
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centres = spark.createDataFrame(rows, ["cluster", *names])
    whole = Window.partitionBy(F.lit(1))
    def unit(c):
        low, high = F.min(c).over(whole), F.max(c).over(whole)
        return F.coalesce(F.try_divide(F.col(c) - low, high - low), F.lit(0.0)).alias(c)
    return centres.select(F.col("cluster").cast("int"), *[unit(c) for c in names])


def difficulty(df: DataFrame, columns: Sequence[str],
               labels: Sequence[str] = ("1 - Basic", "2 - Intermediate", "3 - Advanced"),
               seed: int = 42) -> DataFrame:
    """Clusters of the standardised columns, ordered by the sum of their raw means and named
    from easy to hard in ``level``."""
    scaled, _ = scaled_features(df, columns)
    rows, _ = kmeans(scaled, len(labels), seed=seed)
    means = class_means(rows, "cluster", columns, digits=10)
    total = sum((F.col(f"avg_{c}") for c in columns), F.lit(0.0))
    place = F.row_number().over(Window.orderBy(total, F.col("cluster")))  # one row per cluster
    names = means.select("cluster", F.get(F.array(*[F.lit(x) for x in labels]),
                                          place - 1).alias("level"))
    return rows.join(names, "cluster").drop("features")


# Classifiers ------------------------------------------------------------------------------


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add n / (classes * n_class). The counts, one row for each class, are broadcast: an exchange
    by class would send all rows of a class, texts included, to one task."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    whole = counts.agg(F.struct(F.sum("_n").alias("n"),
                                F.count(F.lit(1)).alias("k")).alias("w")).scalar()
    return (df.join(F.broadcast(counts), label).withColumn("_w", whole)
            .withColumn(name, F.col("_w.n") / (F.col("_w.k") * F.col("_n"))).drop("_n", "_w"))


def _enough(df: DataFrame, least: int = MIN_ROWS) -> None:
    """Raise if there are fewer than ``least`` rows to learn from."""
    if df.limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows to learn from")


def _named(df: DataFrame, indexer) -> DataFrame:
    return IndexToString(inputCol="_p", outputCol="prediction",
                         labels=indexer.labels).transform(df)


def _counted_halves(df: DataFrame, key: str, text: str, vocab: int, columns: Sequence[str], seed: int):
    """Training and held-out rows with the counts of their words (:func:`fit_counts` on the training
    rows) in place of the text. They are stored: the text is read twice, once for the vocabulary and
    once for the counts, and not again by each fit and by the prediction."""
    counting = fit_counts(halves(df, key, seed=seed)[0], text, vocab, "_text")
    kept = dict.fromkeys([key, *columns, "__text_c"])  # a number may be the key itself
    return halves(cut_lineage(counting.transform(df).select(*kept)), key, seed=seed)


def classify_forest(df: DataFrame, key: str, label: str, text: str, numeric: Sequence[str],
                    vocab: int = 1000, trees: int = 100, seed: int = 42) -> DataFrame:
    """Random forest on tf-idf text and numbers with balanced weights: the held-out fifth with
    its ``prediction``."""
    _enough(df)
    train, test = _counted_halves(df, key, text, vocab, [label, *numeric], seed)
    indexer = StringIndexer(inputCol=label, outputCol="_label", handleInvalid="keep",
                            stringOrderType="alphabetAsc").fit(df)
    assembler = VectorAssembler(inputCols=[*numeric, "_text"], outputCol="_x")
    prepare = PipelineModel(stages=[fit_weights(train, "_text"), indexer, assembler])
    forest = RandomForestClassifier(featuresCol="_x", labelCol="_label", predictionCol="_p",
                                    weightCol="weight", numTrees=trees, maxDepth=10, seed=seed)
    shaped = prepare.transform(balanced_weights(train, label)).select(key, "_x", "_label", "weight")
    model = forest.fit(dealt(shaped, key))
    return _named(model.transform(prepare.transform(test)), indexer).select(
        key, label, "prediction")


def classify_svm(df: DataFrame, key: str, label: str, text: str, vocab: int = 3000,
                 seed: int = 42, rounds: int = 20) -> DataFrame:
    """One-against-rest linear SVM on tf-idf text with balanced weights, vocabulary from the
    training rows only: the held-out fifth with its ``prediction``."""
    _enough(df)
    train, test = _counted_halves(df, key, text, vocab, [label], seed)
    indexer = StringIndexer(inputCol=label, outputCol="_label",
                            stringOrderType="alphabetAsc").fit(df)
    prepare = PipelineModel(stages=[fit_weights(train, "_text"), indexer])
    shaped = (prepare.transform(balanced_weights(train, label))
              .select(key, "_text", "_label", "weight"))
    machines = one_against_rest(shaped, key, "_text", "_label", "weight", len(indexer.labels), rounds, 0.01)
    return _named(_strongest(machines, prepare.transform(test)), indexer).select(
        key, label, "prediction")


def _strongest(machines: Sequence, df: DataFrame) -> DataFrame:
    """Add ``_p``, the number of the machine with the largest margin, the first of equal ones. The
    margins stay in the JVM; the model's own transform sends them through Python once for each class."""
    for i, machine in enumerate(machines):
        df = (machine.setFeaturesCol("_text").setPredictionCol("").setRawPredictionCol(f"_raw{i}")
              .transform(df))
    margins = F.array(*[vector_to_array(f"_raw{i}")[1] for i in range(len(machines))])
    df = df.withColumn("_margins", margins)
    return df.withColumn("_p", (F.array_position("_margins", F.array_max("_margins")) - 1).cast("double"))


# Regression -------------------------------------------------------------------------------


class RegressionBakeOff:
    """Linear, forest and boosted-tree regression on numbers, categories and token text; the
    model with the best R² on the held-out fifth wins."""

    def __init__(self, df: DataFrame, key: str, target: str, numeric: Sequence[str],
                 categorical: Sequence[str], text: str, vocab: int = 20, trees: int = 100,
                 seed: int = 42):
        train, test = halves(df.filter(F.col(target) > 0), key, seed=seed)
        codes = [f"_{c}_code" for c in categorical]
        hots = [f"_{c}_hot" for c in categorical]
        self.prepare = PipelineModel(stages=[
            StringIndexer(inputCols=list(categorical), outputCols=codes,
                          handleInvalid="keep").fit(train),
            fit_tfidf(train, text, vocab, "_text", stop=[]),
        ])
        encoder = OneHotEncoder(inputCols=codes, outputCols=hots, dropLast=False,
                                handleInvalid="keep").fit(self.prepare.transform(train))
        assembler = VectorAssembler(inputCols=[*numeric, *hots, "_text"], outputCol="features")
        self.prepare = PipelineModel(stages=[self.prepare, encoder, assembler])
        self.target = target
        shaped = self.prepare.transform(train).select(key, "features", target)
        shaped = dealt(shaped, key).drop(key).persist()
        held = self.prepare.transform(test).select(key, "features", target)
        try:
            self.models = {
                "linear": LinearRegression(labelCol=target).fit(shaped),
                "forest": RandomForestRegressor(labelCol=target, numTrees=trees, maxDepth=8,
                                                seed=seed).fit(shaped),
                "boosted": GBTRegressor(labelCol=target, maxIter=max(1, trees // 5),
                                        seed=seed).fit(shaped),
            }
            self.names = self._feature_names(shaped)
        finally:
            shaped.unpersist()
        scores = None
        for name, model in self.models.items():
            row = regression_metrics(model.transform(held), target, "prediction").withColumn(
                "model", F.lit(name))
            scores = row if scores is None else scores.unionByName(row)
        self.scores = scores
        self.held = held

    @staticmethod
    def _feature_names(shaped: DataFrame) -> list[str]:
        attrs = shaped.schema["features"].metadata["ml_attr"]["attrs"]
        flat = [a for group in attrs.values() for a in group]
        return [a["name"] for a in sorted(flat, key=lambda a: a["idx"])]

    def best(self) -> str:
        return self.scores.orderBy(F.desc("r2"), F.asc("model")).first()["model"]

    def importances(self, model: str = "forest", k: int = 20) -> DataFrame:
        """The ``k`` most important features of a tree model."""
        weights = self.models[model].featureImportances.toArray()
        rows = [(n, float(w)) for n, w in zip(self.names, weights, strict=True)]
        frame = self.held.sparkSession.createDataFrame(rows, "feature string, importance double")
        return frame.orderBy(F.desc("importance"), F.asc("feature")).limit(k)

