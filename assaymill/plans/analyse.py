"""Classified pairs to gene tables, one frame per route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assaymill.operators import diffexp
from assaymill.operators.agents import filter_agent, filter_flags
from assaymill.operators.lookups import platform_of, split_ids
from assaymill.operators.routing import (
    all_present, pair_id, pair_samples, route, runs_of, sequencing_grouping,
)
from assaymill.session import cut, kept
from assaymill.sources.catalog import Catalog

NOTES = ["gse_id", "pert_agent", "organism", "direction"]


def failing(pairs: DataFrame) -> Column:
    """Why a pair cannot be tested, NULL when it can."""
    n_ctrl, n_pert = F.size(split_ids("ctrl_gsm_ids")), F.size(split_ids("pert_gsm_ids"))
    return (
        F.when(F.col("technology").isNull(), "no platform for the first control sample")
        .when(F.coalesce("ctrl_gsm_ids", F.lit("")) == "", "no control sample")
        .when(F.coalesce("pert_gsm_ids", F.lit("")) == "", "no perturbed sample")
        .when(n_ctrl + n_pert < 3, "fewer than three samples")
    )


def route_pairs(pairs: DataFrame, catalog: Catalog, matrix: DataFrame) -> DataFrame:
    """Pairs with technology, organism and ``route``; untestable ones go to ``error`` with a ``command``."""
    known = platform_of(pairs, catalog)
    checked = known.withColumn("command", failing(known))
    present = all_present(checked, matrix)
    chosen = F.when(F.col("command").isNotNull(), "error").otherwise(route(F.col("technology"), F.col("in_matrix")))
    return present.withColumn("route", chosen).withColumn("pair", pair_id())


def annotate(genes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Gene rows with the notes of their pair."""
    return genes.join(pairs.select("pair", *NOTES), "pair")


def sequencing_genes(pairs: DataFrame, matrix: DataFrame, mode: str) -> DataFrame:
    groups = pair_samples(pairs, []).select("pair", "sample", "grp")
    # Written, as it is read several times and the matrix holds many more samples.
    values = kept(diffexp.select_groups(
        matrix.select("gene", "sample", F.col("count").alias("value")), groups, ["sample"]
    ), "values")
    counted = kept(diffexp.drop_low_counts(values), "counted")
    logged = diffexp.log_cpm(counted, diffexp.tmm_factors(counted))
    fit = diffexp.contrast(diffexp.fit_two_groups(logged), mode)
    table = annotate(diffexp.gene_table(diffexp.moderated_t(fit, trend=True), "sequencing"), pairs)
    return table.select(
        F.col("gene").alias("Gene"), F.col("log_fc").alias("logFC"), F.col("ave_expr").alias("AveExpr"), "t",
        F.col("p_value").alias("P.Value"), F.col("adj_p_value").alias("adj.P.Val"), F.col("b").alias("B"), *NOTES,
    )


def array_genes(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """``arrays`` holds (probe, sample, value, symbol). Pairs without array values give no rows.

    A probe's symbol is the one its own samples carry, as platforms share probe ids.
    """
    groups = pair_samples(pairs, []).select("pair", "sample", "grp")
    values = kept(diffexp.select_groups(
        arrays.select(F.col("probe").alias("gene"), "sample", F.col("value").cast("double").alias("value"), "symbol"),
        groups, ["sample"],
    ), "values")
    fit = diffexp.contrast(diffexp.fit_two_groups(diffexp.auto_log2(values.drop("symbol"))))
    symbols = values.groupBy("pair", F.col("gene").alias("probe")).agg(F.min("symbol").alias("symbol"))
    tested = (
        diffexp.moderated_t(fit).withColumnRenamed("gene", "probe").join(symbols, ["pair", "probe"])
        .withColumn("gene", F.col("probe"))
    )
    table = annotate(diffexp.gene_table(tested, "array"), pairs)
    return table.select(
        F.col("adj_p_value").alias("adj.P.Val"), F.col("p_value").alias("P.Value"), "t", F.col("b").alias("B"),
        F.col("log_fc").alias("logFC"), F.col("symbol").alias("Gene.symbol"), *NOTES,
    )


def analyse(
    pairs: DataFrame,
    catalog: Catalog,
    matrix: DataFrame,
    runs: DataFrame,
    arrays: DataFrame,
    use_flags: bool = True,
    strict: bool = False,
    agent: str | None = None,
    mode: str = "difference",
) -> dict[str, DataFrame]:
    """Frames of the five routes: gene rows, runs to count, unknown technologies and errors.

    ``matrix`` is (gene, sample, count, organism); ``runs`` is (sample, run).
    """
    if use_flags:
        pairs = filter_flags(pairs, strict)
    if agent is not None:
        pairs = filter_agent(pairs, agent)
    routed = cut(route_pairs(pairs, catalog, matrix))

    def only(name: str) -> DataFrame:
        return routed.filter(F.col("route") == name)

    falco = runs_of(only("falco"), runs).select(
        "gse_id", "pert_agent", "sra_ids", sequencing_grouping("ctrl_gsm_ids", "pert_gsm_ids").alias("grouping"),
        "organism",
    )
    return {
        "microarray": array_genes(only("microarray"), arrays),
        "rna_seq": sequencing_genes(only("rna_seq"), matrix, mode),
        "falco": falco,
        "unknown": only("unknown").select("gse_id", "technology"),
        "error": only("error").select("gse_id", "command"),
    }
