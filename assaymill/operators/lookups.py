"""Joins and filters over the metadata catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assaymill.functions.text import assemble, direction, greek_to_words, keyword_rule
from assaymill.operators.ordering import first_by
from assaymill.sources.catalog import Catalog

SAMPLE_TEXT_COLUMNS = [
    "title", "source_name_ch1", "description", "characteristics_ch1", "treatment_protocol_ch1",
    "extract_protocol_ch1",
]


def organism_is(df: DataFrame, organism: str | None) -> DataFrame:
    """Rows of one organism, ignoring case; every row when none is named."""
    return df if organism is None else df.filter(F.lower("organism_ch1") == organism.lower())


def match_keywords(df: DataFrame, columns: list[str], and_keywords: list[str], or_keywords: list[str]) -> DataFrame:
    return df.filter(keyword_rule([F.col(c) for c in columns], and_keywords, or_keywords))


def keyword_fallback(
    samples: DataFrame, series: DataFrame, links: DataFrame, and_keywords: list[str], or_keywords: list[str]
) -> DataFrame:
    """(gse, gsm) of samples that hit, or of a whole series that hits when none of its samples does.

    Series without a hit are found by an anti-join against the series that have one.
    """
    hits = links.join(match_keywords(samples, SAMPLE_TEXT_COLUMNS, and_keywords, or_keywords).select("gsm"), "gsm")
    named = match_keywords(series, ["title", "summary"], and_keywords, or_keywords).select("gse")
    missed = named.join(hits.select("gse").distinct(), "gse", "left_anti")
    fallback = links.join(missed, "gse").join(samples.select("gsm"), "gsm")
    return hits.select("gse", "gsm").unionByName(fallback.select("gse", "gsm"))


def series_samples(catalog: Catalog) -> DataFrame:
    """Series, its samples and their organism."""
    organisms = catalog.gsm.select("gsm", "organism_ch1")
    return catalog.gse.join(catalog.gse_gsm.join(organisms, "gsm"), "gse")


def linked_samples(catalog: Catalog) -> DataFrame:
    return catalog.gse_gsm.join(catalog.gsm, "gsm")


def linked_samples_with_series(catalog: Catalog) -> DataFrame:
    series = catalog.gse.select("gse", F.col("title").alias("series_title"), F.col("summary").alias("series_summary"))
    return catalog.gse_gsm.join(catalog.gsm, "gsm").join(series, "gse")


def series_text(catalog: Catalog, organism: str | None = None) -> DataFrame:
    """Each series with the organism of its first sample, its text and direction.

    The first sample is found on (gse, gsm, organism) only; texts join once per series.
    """
    organisms = organism_is(catalog.gsm.select("gsm", "organism_ch1"), organism)
    first = first_by(catalog.gse_gsm.join(organisms, "gsm").select("gse", "gsm", "organism_ch1"), ["gse"], ["gsm"])
    text = assemble(F.col("title"), F.col("summary"), F.col("overall_design"))
    return (
        catalog.gse.join(first, "gse")
        .withColumnRenamed("organism_ch1", "organism")
        .withColumn("text", text)
        .withColumn("direction", direction(F.col("text")))
    )


def sample_text(samples: DataFrame) -> DataFrame:
    """Repaired title followed by each non-empty source and description."""
    text = assemble(greek_to_words(F.col("title")), F.col("source_name_ch1"), F.col("description"))
    return samples.withColumn("text", text)


def platform_of(pairs: DataFrame, catalog: Catalog) -> DataFrame:
    """Technology and organism of the first control sample, and the lowest platform of the series."""
    sample = catalog.gsm.select("gsm", F.col("gpl").alias("sample_gpl"), F.col("organism_ch1").alias("organism"))
    technology = catalog.gpl.select(F.col("gpl").alias("sample_gpl"), "technology")
    series = catalog.gse_gpl.groupBy(F.col("gse").alias("gse_id")).agg(F.min("gpl").alias("gpl"))
    return (
        pairs.drop("organism")
        .withColumn("gsm", F.split_part("ctrl_gsm_ids", F.lit("|"), F.lit(1)))
        .join(sample, "gsm", "left")
        .join(technology, "sample_gpl", "left")
        .join(series, "gse_id", "left")
        .drop("gsm", "sample_gpl")
    )


def lookup(ids: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Metadata of the distinct ids."""
    return meta.join(ids.select(key).distinct(), key)


def split_ids(column: str) -> Column:
    return F.split(column, "\\|")


def explode_pairs(df: DataFrame) -> DataFrame:
    """Pairs in the analysis shape: id lists as arrays, fields by name."""
    return df.select(
        "gse_id", "organism", "direction", "pert_agent",
        split_ids("ctrl_gsm_ids").alias("ctrl_gsm_ids"), split_ids("pert_gsm_ids").alias("pert_gsm_ids"),
        F.col("microarray_grouping").alias("grouping"),
    )


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)
