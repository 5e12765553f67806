"""Classification scores from counts of (label, prediction)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def class_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a ratio has no base.

    One pass counts (label, prediction); a class is then a label or a prediction.
    """
    cells = df.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).alias("support"), F.col("n").alias("predicted")),
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    counts = (
        cells.select(hit.alias("hit"), F.posexplode(sides).alias("side", "s"))
        .groupBy(F.col("s.class").alias("class"))
        .agg(
            F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"),
            F.sum(F.when(F.col("side") == 0, F.col("hit")).otherwise(0)).alias("hits"),
        )
    )
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    f1 = F.when(F.col("hits") > 0, 2 * F.col("hits") / (F.col("predicted") + F.col("support"))).otherwise(0.0)
    return counts.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def weighted_prf(df: DataFrame) -> DataFrame:
    """One row of precision, recall and F1, weighted by class support."""

    def weighted(name: str):
        return (F.sum(F.col(name) * F.col("support")) / F.sum("support")).alias(name)

    return class_report(df).agg(weighted("precision"), weighted("recall"), weighted("f1"))


def confusion(df: DataFrame, classes: list) -> DataFrame:
    """True classes as rows, predicted ones as columns."""
    return df.groupBy("label").pivot("prediction", classes).agg(F.count(F.lit(1))).na.fill(0)


def f1_board(scores: DataFrame, classifiers: list[str]) -> DataFrame:
    """One row per data set, one F1 column per classifier, by name."""
    return scores.groupBy(F.col("dataset").alias("data_type")).pivot("clf", classifiers).agg(F.first("f1_scores"))


def rank_classifiers(scores: DataFrame) -> DataFrame:
    """Rank of each classifier by F1 within its data set."""
    return scores.withColumn("rank", F.rank().over(Window.partitionBy("dataset").orderBy(F.desc("f1_scores"))))


def tuning_table(results: DataFrame) -> DataFrame:
    """Scores before and after tuning, by tuned F1."""
    return results.select(
        "clf", "ori_precision", "ori_recall", "ori_f1", "opt_precision", "opt_recall", "opt_f1"
    ).orderBy("opt_f1", "clf")
