"""Archive to classified pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from assaymill.functions.text import greek_to_words
from assaymill.operators.agents import resolve_agent
from assaymill.operators.clustering import cluster_samples, with_both_types
from assaymill.operators.lookups import keyword_fallback, organism_is, sample_text, series_text
from assaymill.operators.matching import (
    attach_verdict, best_match, cluster_groups, finish_pairs, grouping_string,
)
from assaymill.operators.models import predict, verdict
from assaymill.session import cut
from assaymill.sources.catalog import Catalog


@dataclass(frozen=True)
class Models:
    """Text models over a column ``text``; prediction 1 is a perturbation, 0 is not."""

    title: PipelineModel
    summary: PipelineModel
    sample: PipelineModel


def select_samples(
    catalog: Catalog, organism: str | None, and_keywords: list[str], or_keywords: list[str]
) -> DataFrame:
    """Samples in use as (gse, gsm, title, text): repaired text next to the raw title."""
    samples = organism_is(catalog.gsm, organism)
    links = catalog.gse_gsm
    if and_keywords or or_keywords:
        links = keyword_fallback(samples, catalog.gse, links, and_keywords, or_keywords)
    return links.join(sample_text(samples).select("gsm", "title", "text"), "gsm")


def classify(
    catalog: Catalog,
    models: Models,
    terms: DataFrame,
    aliases: DataFrame,
    ids: DataFrame | None = None,
    organism: str | None = None,
    and_keywords: list[str] = [],
    or_keywords: list[str] = [],
    max_n: int | None = None,
) -> DataFrame:
    """Classified pairs of the series in ``ids`` (all without), one row per control cluster.

    Agents are dictionary terms of up to ``max_n`` words, of any length if not given.
    """
    if ids is not None:
        wanted = ids.select("gse").distinct()
        catalog = Catalog(
            catalog.gse.join(wanted, "gse", "left_semi"), catalog.gsm,
            catalog.gse_gsm.join(wanted, "gse", "left_semi"), catalog.gpl, catalog.gse_gpl,
        )
    verdicts = verdict(series_text(catalog, organism), models.title, models.summary, 1.0).select(
        "gse", "is_pert_title", "is_pert_summary", "organism", "direction"
    )
    samples = select_samples(catalog, organism, and_keywords, or_keywords)
    # Types come from distinct samples, so one in several series is predicted once.
    titles = samples.select("gsm", F.coalesce("title", F.lit("")).alias("_title")).distinct()
    types = predict(titles.withColumnRenamed("_title", "text"), models.sample, "_type").select(
        "gsm", F.when(F.col("_type") == 1, "pert").otherwise("ctrl").alias("type")
    )
    typed = with_both_types(cut(samples.select("gse", "gsm", "text").join(types, "gsm")))
    clustered = cut(cluster_samples(typed))
    control, perturbed = cluster_groups(clustered)
    matches = cut(best_match(control, perturbed).select("gse", "ctrl_cluster", "pert_cluster"))
    titled = catalog.gse.select("gse", greek_to_words(F.coalesce("title", F.lit(""))).alias("title"))
    texts = (
        matches.select("gse", "pert_cluster").distinct()
        .join(perturbed, ["gse", "pert_cluster"])
        .join(titled, "gse")
        .select("gse", "pert_cluster", F.col("pert_text").alias("text"), "title")
    )
    agents = resolve_agent(texts, terms, aliases, ["gse", "pert_cluster"], max_n)
    pairs = grouping_string(clustered, matches).join(agents, ["gse", "pert_cluster"])
    return finish_pairs(attach_verdict(pairs, verdicts))
