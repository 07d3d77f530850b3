"""Model metrics as plain aggregates over (label, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.aggregate import pivot_counts


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """One row: rows, MAE, RMSE and R²."""
    y = F.col(label).cast("double")
    gap = y - F.col(prediction).cast("double")
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(gap)).alias("_mae"),
                  F.avg(gap * gap).alias("_mse"), F.var_pop(y).alias("_var"))
    return sums.select("n", F.round("_mae", digits).alias("mae"),
                       F.round(F.sqrt("_mse"), digits).alias("rmse"),
                       F.round(1 - F.try_divide(F.col("_mse"), F.col("_var")), digits).alias("r2"))


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Long confusion matrix: ``label``, ``prediction``, ``n``."""
    return (df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Rows are true classes, columns predicted ones."""
    return pivot_counts(df, label, prediction, classes)


def class_report(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    Division by zero counts as 0. Everything after the first aggregate runs on one row per
    (label, prediction) pair.
    """
    cells = confusion_counts(df, label, prediction)
    sides = (cells.select("label", "prediction", "n",
                          F.explode(F.array(F.struct(F.col("label").alias("c"),
                                                     F.lit(True).alias("is_true")),
                                            F.struct(F.col("prediction").alias("c"),
                                                     F.lit(False).alias("is_true")))).alias("_s"))
             .select(F.col("_s.c").cast("string").alias("class"), F.col("_s.is_true").alias("_t"),
                     "n", (F.col("label") == F.col("prediction")).alias("_ok")))
    per = sides.groupBy("class").agg(
        F.sum(F.when(F.col("_t"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("_t"), F.col("n")).otherwise(0)).alias("_predicted"),
        F.sum(F.when(F.col("_t") & F.col("_ok"), F.col("n")).otherwise(0)).alias("_hits"))
    per = (per.withColumn("precision", _ratio(F.col("_hits"), F.col("_predicted")))
           .withColumn("recall", _ratio(F.col("_hits"), F.col("support")))
           .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"),
                                    F.col("precision") + F.col("recall"))))
    measures = ["precision", "recall", "f1"]
    weights = F.sum("support")
    accuracy = F.sum("_hits") / weights
    totals = per.agg(F.array(
        F.struct(F.lit("accuracy").alias("class"), *[accuracy.alias(m) for m in measures],
                 weights.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures],
                 weights.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"),
                 *[(F.sum(F.col(m) * F.col("support")) / weights).alias(m) for m in measures],
                 weights.alias("support"))).alias("_rows"))
    tail = totals.select(F.explode("_rows").alias("_r")).select("_r.*")
    out = per.select("class", *measures, "support").unionByName(tail)
    return out.select("class", *[F.round(m, digits).alias(m) for m in measures], "support")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
