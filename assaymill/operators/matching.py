"""Pairing control with perturbed clusters and writing the pairs down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assaymill.functions.similarity import jaro_winkler
from assaymill.functions.text import time_value
from assaymill.operators.ordering import numbered

CHUNK = 4096


def sample_position(df: DataFrame) -> DataFrame:
    """0-based position of each sample within its series, by sample id."""
    placed = numbered(df, ["gse"], [F.col("gsm")], name="position", total="_n")
    return placed.withColumn("position", F.col("position") - 1).drop("_n")


def cluster_groups(clustered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(control groups, perturbed groups) with the text of their first sample.

    Whatever is not ``ctrl`` is perturbed; perturbed groups need two samples.
    """
    role = F.when(F.col("type") == "ctrl", "ctrl").otherwise("pert")
    groups = clustered.groupBy("gse", role.alias("role"), "cluster").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("text", F.col("gsm")).alias("text")
    )
    control = groups.filter("role = 'ctrl'").selectExpr("gse", "cluster ctrl_cluster", "text ctrl_text")
    perturbed = groups.filter("role = 'pert' and n > 1").selectExpr("gse", "cluster pert_cluster", "text pert_text")
    return control, perturbed


def cross_clusters(control: DataFrame, perturbed: DataFrame, per_task: int = 2000) -> DataFrame:
    """Every control group with every perturbed group of its series.

    A series with many perturbed groups is split over salted tasks.
    """
    salts = perturbed.groupBy("gse").agg(F.ceil(F.count(F.lit(1)) / per_task).cast("int").alias("salts"))
    left = control.join(salts, "gse").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    right = perturbed.join(salts, "gse").withColumn(
        "salt", F.pmod(F.col("pert_cluster"), F.col("salts")).cast("int")
    )
    return left.drop("salts").join(right.drop("salts"), ["gse", "salt"]).drop("salt")


def gather_candidates(control: DataFrame, perturbed: DataFrame) -> DataFrame:
    """What the choice among a control group's candidates needs, summed up per series before the control groups get it."""
    time = time_value(F.col("pert_text"))
    series = perturbed.groupBy("gse").agg(
        F.count(F.lit(1)).alias("n_pert"),
        F.min("pert_cluster").alias("first_pert"),
        F.bool_or(time.isNotNull()).alias("any_time"),
        F.max(time).alias("max_time"),
    )
    return control.join(series, "gse").select(
        "gse", "ctrl_cluster", "ctrl_text", "n_pert", "first_pert", "any_time", "max_time"
    )


def best_match(control: DataFrame, perturbed: DataFrame) -> DataFrame:
    """The perturbed group of each control group: (gse, ctrl_cluster, pert_cluster, diff, score).

    If any perturbed text of the series has a time token, the largest non-negative
    difference to the control's time wins, and there is no row without one. The largest
    difference is the series' latest time, so one row per series answers all its control
    groups. Only series without times compare texts pairwise; the best score is folded
    before the shuffle. The lowest cluster wins a tie.
    """
    timed = perturbed.withColumn("time", time_value(F.col("pert_text")))
    latest = (
        timed.filter("time is not null")
        .groupBy("gse")
        .agg(F.max(F.struct("time", (-F.col("pert_cluster")).alias("c"))).alias("m"))
        .select("gse", F.col("m.time").alias("time"), (-F.col("m.c")).alias("pert_cluster"))
    )
    own = F.coalesce(time_value(F.col("ctrl_text")), F.lit(0))
    by_time = (
        control.join(latest, "gse")
        .select("gse", "ctrl_cluster", "pert_cluster", (F.col("time") - own).alias("diff"))
        .filter("diff >= 0")
        .withColumn("score", F.lit(None).cast("double"))
    )
    rest = perturbed.join(latest.select("gse"), "gse", "left_anti")
    scored = cross_clusters(control, rest).withColumn("score", jaro_winkler(F.col("ctrl_text"), F.col("pert_text")))
    by_text = (
        scored.groupBy("gse", "ctrl_cluster")
        .agg(F.max(F.struct("score", (-F.col("pert_cluster")).alias("c"))).alias("m"))
        .select(
            "gse", "ctrl_cluster", (-F.col("m.c")).alias("pert_cluster"), F.lit(None).cast("bigint").alias("diff"),
            F.col("m.score").alias("score"),
        )
    )
    return by_time.unionByName(by_text)


def grouping_string(clustered: DataFrame, matches: DataFrame) -> DataFrame:
    """Per match the sample ids of both sides and a code per sample of the series.

    ``0`` is control, ``1`` perturbed, ``X`` unused, in order of sample id. Samples are
    gathered in chunks of positions before they meet the matches, so a long series is not
    sorted in one task and a match costs a row per chunk, not per sample.
    """
    placed = sample_position(clustered.select("gse", "gsm", "type", "cluster")).select(
        "gse", F.floor(F.col("position") / CHUNK).alias("chunk"), "position", F.col("gsm").cast("string").alias("gsm"),
        F.col("type").eqNullSafe("ctrl").alias("control"), "cluster",
    )
    gathered = placed.groupBy("gse", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("position", "gsm", "control", "cluster"))).alias("rows")
    )

    def is_control(r: Column) -> Column:
        return r["control"] & (r["cluster"] == F.col("ctrl_cluster"))

    def is_perturbed(r: Column) -> Column:
        return ~r["control"] & (r["cluster"] == F.col("pert_cluster"))

    def ids(wanted) -> Column:
        return F.nullif(F.array_join(F.transform(F.filter("rows", wanted), lambda r: r["gsm"]), "|"), F.lit(""))

    def code(r: Column) -> Column:
        return F.when(is_control(r), "0").when(is_perturbed(r), "1").otherwise("X")

    chunks = gathered.join(matches.select("gse", "ctrl_cluster", "pert_cluster"), "gse").select(
        "gse", "ctrl_cluster", "pert_cluster", "chunk", F.array_join(F.transform("rows", code), "").alias("codes"),
        ids(is_control).alias("ctrl"), ids(is_perturbed).alias("pert"),
    )
    joined = chunks.groupBy("gse", "ctrl_cluster", "pert_cluster").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "codes", "ctrl", "pert"))).alias("c")
    )

    def glue(field: str, mark: str):
        return F.array_join(F.transform("c", lambda x: x[field]), mark)

    return joined.select(
        "gse", "ctrl_cluster", "pert_cluster", glue("ctrl", "|").alias("ctrl_gsm_ids"),
        glue("pert", "|").alias("pert_gsm_ids"), glue("codes", "").alias("microarray_grouping"),
    )


def attach_verdict(pairs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Pairs of series that have a verdict, one verdict to many pairs."""
    return pairs.join(verdicts, "gse")


def finish_pairs(df: DataFrame) -> DataFrame:
    """The columns of a classified pair, by name."""
    return df.select(
        F.col("gse").cast("string").alias("gse_id"), "pert_agent", "ctrl_gsm_ids", "pert_gsm_ids",
        "microarray_grouping", "is_pert_title", "is_pert_summary", "organism", "direction",
    )
