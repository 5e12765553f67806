"""Per-sample counts to a gene x sample matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assaymill.operators.ordering import quantiles


def sum_counts(df: DataFrame) -> DataFrame:
    """Counts per (sample, gene) over all parts; summed before the shuffle."""
    return df.groupBy("sample", "gene").agg(F.sum("count").alias("count"))


def pivot_counts(df: DataFrame, samples: list[str]) -> DataFrame:
    """One row per gene, one column per named sample; NULL where a sample lacks the gene.

    Sums parts on the way, so no separate ``sum_counts`` is needed before it. The list
    sets the width of the result; work on the long form when it is not small.
    """
    return df.groupBy("gene").pivot("sample", samples).agg(F.sum("count"))


def split_qc(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(genes, quality rows); quality rows carry the prefix ``QC_``."""
    quality = F.startswith("gene", F.lit("QC_"))
    return df.filter(~quality), df.filter(quality)


def sort_genes(df: DataFrame) -> DataFrame:
    return df.orderBy("gene")


def library_cpm(df: DataFrame, by: list[str] = ["sample"]) -> DataFrame:
    """Library size of each sample and counts per million.

    The sums are aggregated and joined back, so no sample is gathered in one task.
    """
    sizes = df.groupBy(*by).agg(F.sum("count").alias("lib_size"))
    return df.join(sizes, by).withColumn("cpm", F.col("count") / F.col("lib_size") * 1e6)


def value_quantiles(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """0, .25, .5, .75, .99 and 1 quantiles with linear interpolation, ignoring NULLs."""
    names = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99, "q100": 1.0}
    return quantiles(df, by, value, names)


def slice_matrix(matrix: DataFrame, samples: DataFrame) -> DataFrame:
    """Matrix rows of the wanted samples with the columns of ``samples`` attached by sample id."""
    return matrix.join(samples, "sample")


def count_matrix(counts: DataFrame, samples: list[str]) -> tuple[DataFrame, DataFrame]:
    """(gene matrix, quality matrix) of parts of per-sample counts."""
    genes, quality = split_qc(pivot_counts(counts, samples))
    return sort_genes(genes), sort_genes(quality)
