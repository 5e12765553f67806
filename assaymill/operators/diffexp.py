"""Differential expression per pair and gene on long matrices.

Frames are (pair, gene, sample, grp, value); ``grp`` is 0 for control and 1 for
perturbed. A zero count is a row; an absent row is a missing value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from assaymill.functions.special import (
    digamma_of, t_for_two_sided_of, trigamma_inverse_of, trigamma_of, two_sided_t_of,
)
from assaymill.operators.counts import value_quantiles
from assaymill.operators.ordering import (
    average_rank, first_by, numbered, quantiles, running_min_from_end, value_spans,
)
from assaymill.operators.splines import fit_spline, spline_at
from assaymill.session import cut


def select_groups(matrix: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    """Matrix rows of the samples in use with their group; samples marked X are dropped."""
    used = groups.filter("grp <> 'X'").withColumn("grp", F.col("grp").cast("int"))
    return matrix.join(used, on)


def auto_log2(df: DataFrame, by: list[str] = ["pair"]) -> DataFrame:
    """log2 of the values of a pair when their quantiles look unlogged; then values <= 0 are NULL."""
    q = value_quantiles(df, by, "value")
    unlogged = (
        (F.col("q99") > 100)
        | ((F.col("q100") - F.col("q0") > 50) & (F.col("q25") > 0))
        | ((F.col("q25") > 0) & (F.col("q25") < 1) & (F.col("q75") > 1) & (F.col("q75") < 2))
    )
    logged = F.when(F.col("value") > 0, F.log2(F.col("value")))
    flags = q.select(*by, unlogged.alias("_log"))
    return df.join(flags, by).withColumn("value", F.when(F.col("_log"), logged).otherwise(F.col("value"))).drop("_log")


def library_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("pair", "sample").agg(F.sum("value").alias("lib_size"))


def drop_low_counts(
    df: DataFrame, min_count: float = 10, min_total: float = 15, large_n: int = 10, min_prop: float = 0.7
) -> DataFrame:
    """Genes with enough counts in as many samples as the smaller group has.

    The cut is ``min_count`` at the median library size, as counts per million; from
    ``large_n`` samples on only ``min_prop`` of the further ones must reach it.
    """
    sizes = df.groupBy("pair", "sample", "grp").agg(F.sum("value").alias("lib_size"))
    groups = sizes.groupBy("pair", "grp").count().groupBy("pair").agg(F.min("count").alias("n"))
    cuts = (
        sizes.groupBy("pair").agg((F.lit(min_count) / F.median("lib_size") * 1e6).alias("cutoff"))
        .join(groups, "pair")
        .select(
            "pair", "cutoff",
            F.when(F.col("n") > large_n, large_n + (F.col("n") - large_n) * min_prop).otherwise(F.col("n")).alias("need"),
        )
    )
    per_million = F.col("value") / F.col("lib_size") * 1e6
    kept = (
        df.join(sizes.drop("grp"), ["pair", "sample"])
        .join(cuts, "pair")
        .groupBy("pair", "gene", "need")
        .agg(F.count_if(per_million >= F.col("cutoff")).alias("hits"), F.sum("value").alias("total"))
        .filter((F.col("hits") >= F.col("need") - 1e-14) & (F.col("total") >= min_total - 1e-14))
    )
    return df.join(kept.select("pair", "gene"), ["pair", "gene"], "left_semi")


def tmm_factors(df: DataFrame, trim_m: float = 0.3, trim_a: float = 0.05) -> DataFrame:
    """(pair, sample, lib_size, factor): trimmed mean of log ratios to a reference sample.

    Pass a frame that is cheap to read again (written or cut): it is read several times.
    The reference sample has the upper quartile nearest to the mean one. Ratios are
    ranked to ten places, so that equal ones tie however they were computed.
    """
    sizes = library_sizes(df)
    quartiles = (
        quantiles(df, ["pair", "sample"], "value", {"q75": 0.75})
        .join(sizes, ["pair", "sample"])
        .withColumn("f75", F.col("q75") / F.col("lib_size"))
    )
    means = quartiles.groupBy("pair").agg(F.avg("f75").alias("mean"))
    nearest = (
        quartiles.join(means, "pair")
        .withColumn("off", F.round(F.abs(F.col("f75") - F.col("mean")), 15))
        .groupBy("pair")
        .agg(F.min_by(F.struct("sample", "lib_size"), F.struct("off", "sample")).alias("r"))
        .select("pair", F.col("r.sample").alias("sample"), F.col("r.lib_size").alias("ref_lib"))
    )
    reference = df.join(nearest, ["pair", "sample"]).select("pair", "gene", F.col("value").alias("ref"), "ref_lib")
    share, ref_share = F.col("value") / F.col("lib_size"), F.col("ref") / F.col("ref_lib")
    ratios = cut(
        df.join(sizes, ["pair", "sample"])
        .join(reference, ["pair", "gene"])
        .filter("value > 0 and ref > 0")
        .select(
            "pair", "sample",
            F.round(F.log2(share / ref_share), 10).alias("m"),
            F.round((F.log2(share) + F.log2(ref_share)) / 2, 10).alias("a"),
            (
                (F.col("lib_size") - F.col("value")) / F.col("lib_size") / F.col("value")
                + (F.col("ref_lib") - F.col("ref")) / F.col("ref_lib") / F.col("ref")
            ).alias("v"),
        )
    )
    keys = ["pair", "sample"]
    ranked = average_rank(average_rank(ratios, keys, "m", "rank_m"), keys, "a", "rank_a")
    counts = ratios.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("m")).alias("most"))

    def inside(rank: str, share: float) -> Column:
        low = F.floor(F.col("n") * share) + 1
        return (F.col(rank) >= low) & (F.col(rank) <= F.col("n") + 1 - low)

    trimmed = (
        ranked.join(counts, keys)
        .filter(inside("rank_m", trim_m) & inside("rank_a", trim_a))
        .groupBy(*keys)
        .agg((F.sum(F.col("m") / F.col("v")) / F.sum(1 / F.col("v"))).alias("log_factor"), F.max("most").alias("most"))
    )
    raw = sizes.join(trimmed, keys, "left").withColumn(
        "log_factor", F.when(F.col("most") >= 1e-6, F.col("log_factor")).otherwise(F.lit(0.0))
    )
    centre = raw.groupBy("pair").agg(F.avg("log_factor").alias("centre"))
    # One row per sample, used more than once by what follows.
    return cut(
        raw.join(centre, "pair").select(
            *keys, "lib_size", F.pow(F.lit(2.0), F.col("log_factor") - F.col("centre")).alias("factor")
        )
    )


def log_cpm(df: DataFrame, factors: DataFrame, prior: float = 3) -> DataFrame:
    """log2 counts per million with a prior count scaled by the effective library size."""
    effective = factors.select("pair", "sample", (F.col("lib_size") * F.col("factor")).alias("lib"))
    means = effective.groupBy("pair").agg(F.avg("lib").alias("mean_lib"))
    scaled = effective.join(means, "pair").select(
        "pair", "sample", "lib", (F.col("lib") / F.col("mean_lib") * prior).alias("prior")
    )
    value = F.log2((F.col("value") + F.col("prior")) / (F.col("lib") + 2 * F.col("prior")) * 1e6)
    return df.join(scaled, ["pair", "sample"]).withColumn("value", value).drop("lib", "prior")


def fit_two_groups(df: DataFrame) -> DataFrame:
    """Means, sizes and pooled residual variance of both groups per (pair, gene)."""

    def of(group: int) -> Column:
        return F.when(F.col("grp") == group, F.col("value"))

    fit = df.groupBy("pair", "gene").agg(
        F.count(of(0)).alias("n_ctrl"), F.count(of(1)).alias("n_pert"),
        F.avg(of(0)).alias("mean_ctrl"), F.avg(of(1)).alias("mean_pert"),
        F.avg("value").alias("ave_expr"),
        F.var_pop(of(0)).alias("_v0"), F.var_pop(of(1)).alias("_v1"),
    )
    freedom = F.col("n_ctrl") + F.col("n_pert") - 2
    spread = F.coalesce(F.col("_v0") * F.col("n_ctrl"), F.lit(0.0)) + F.coalesce(F.col("_v1") * F.col("n_pert"), F.lit(0.0))
    return fit.withColumn("df", freedom).withColumn("s2", F.when(freedom > 0, spread / freedom)).drop("_v0", "_v1")


def contrast(df: DataFrame, mode: str = "difference") -> DataFrame:
    """``log_fc`` and its unscaled deviation: perturbed minus control, or the perturbed mean (``coef``)."""
    if mode == "coef":
        return df.withColumns({"log_fc": F.col("mean_pert"), "unscaled": F.sqrt(1 / F.col("n_pert"))})
    return df.withColumns(
        {
            "log_fc": F.col("mean_pert") - F.col("mean_ctrl"),
            "unscaled": F.sqrt(1 / F.col("n_pert") + 1 / F.col("n_ctrl")),
        }
    )


def variance_priors(df: DataFrame, trend: bool) -> DataFrame:
    """Per pair the prior degrees of freedom ``d0``, what the prior variance is made of, and the pooled freedom.

    Log variances, less what their freedom adds, have a mean, or with ``trend`` a natural
    spline in the mean expression; their spread beyond that of their freedom gives ``d0``.
    Variances of zero are set off from zero by a share of the pair's median.
    """
    half = F.col("df") / 2
    usable = df.filter("df > 0 and s2 is not null and ave_expr is not null")
    floors = quantiles(usable, ["pair"], "s2", {"mid": 0.5})
    floors = floors.select("pair", (F.when(F.col("mid") > 0, F.col("mid")).otherwise(F.lit(1.0)) * 1e-5).alias("_floor"))
    logs = usable.join(floors, "pair").withColumn("_x", F.greatest("s2", "_floor"))
    logs = cut(logs.select("pair", "ave_expr", "_x", (F.log("_x") - digamma_of(half) + F.log(half)).alias("_e"), trigamma_of(half).alias("_bend")))
    means = logs.groupBy("pair").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("_bend").alias("_bend"), F.avg("_x").alias("mean_x"), F.avg("_e").alias("mean_e"),
        F.var_samp("_e").alias("_spread"),
    )
    if trend:
        means = means.join(fit_spline(logs, ["pair"], "ave_expr", "_e").drop("n"), "pair")
        means = means.withColumn("_spread", F.when(F.col("width") > 1, F.col("noise")).otherwise(F.col("_spread")))
    else:
        means = means.withColumn("width", F.lit(1))
    d0 = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(2 * trigamma_inverse_of(F.col("_spread") - F.col("_bend")))
    finite = F.col("d0").between(1e-300, 1e10)
    lift = F.when(finite, digamma_of(F.col("d0") / 2) - F.log(F.col("d0") / 2)).otherwise(F.lit(0.0))
    pooled = df.groupBy("pair").agg(F.sum(F.greatest("df", F.lit(0))).alias("df_pooled"))
    return means.withColumn("d0", d0).withColumn("lift", lift).drop("_n", "_bend", "_spread", "noise").join(pooled, "pair")


def moderated_t(df: DataFrame, trend: bool = False, proportion: float = 0.01) -> DataFrame:
    """Moderated ``t``, ``p_value`` and log odds ``b`` per (pair, gene).

    Gene variances shrink to a common prior (or trend). The prior variance of the
    contrast behind ``b`` comes from the leading genes of each pair, as published.
    """
    df = cut(df)
    endless = F.col("d0") >= 1e10
    level = F.when(endless & (F.col("width") == 1), F.col("mean_x")).otherwise(F.exp(F.col("mean_e") + F.col("lift")))
    prior = F.when(F.col("width") > 1, F.exp(spline_at("ave_expr") + F.col("lift"))).otherwise(level) if trend else level
    weight = F.col("d0") / (F.col("d0") + F.col("df"))
    posterior = F.when(endless, F.col("s2_prior")).otherwise(weight * F.col("s2_prior") + (1 - weight) * F.col("s2"))
    rated = df.filter("s2 is not null and log_fc is not null").join(variance_priors(df, trend), "pair")
    scored = (
        rated.withColumn("s2_prior", prior)
        .withColumn("s2_post", posterior)
        .withColumn("df_total", F.least(F.col("df") + F.col("d0"), F.col("df_pooled")))
        .withColumn("t", F.col("log_fc") / (F.col("unscaled") * F.sqrt("s2_post")))
        .withColumn("p_value", two_sided_t_of(F.col("t"), F.col("df_total").cast("double")))
        .select(*df.columns, "d0", "s2_prior", "s2_post", "df_total", "t", "p_value")
    )
    scored = cut(scored)
    priors = contrast_priors(scored, proportion)
    ratio = (F.col("unscaled") ** 2 + F.col("v0")) / F.col("unscaled") ** 2
    square, freedom = F.col("t") * F.col("t"), F.col("df_total")
    kernel = F.when(F.col("d0") > 1e6, square * (1 - 1 / ratio) / 2).otherwise(
        (1 + freedom) / 2 * F.log((square + freedom) / (square / ratio + freedom))
    )
    odds = math.log(proportion / (1 - proportion)) - F.log(ratio) / 2 + kernel
    return scored.join(priors, "pair").withColumn("b", odds).drop("v0", "s2_prior")


def contrast_priors(df: DataFrame, proportion: float, low: float = 0.1, high: float = 4.0) -> DataFrame:
    """(pair, v0): prior variance of the contrast, a mean over the leading genes by |t|."""
    counts = df.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.max("df_total").alias("top_df"))
    counts = counts.join(quantiles(df, ["pair"], "s2_prior", {"s2_prior": 0.5}), "pair")
    size = F.ceil(F.lit(proportion / 2) * F.col("n"))
    on_top_df = t_for_two_sided_of(F.greatest(F.col("p_value"), F.lit(1e-300)), F.col("top_df").cast("double"))
    values = df.select("pair", "gene", "t", "p_value", "unscaled", "df_total").join(counts, "pair")
    # Only genes with fewer degrees of freedom than the pair's most need the inverse, which is costly.
    even = values.filter(F.col("df_total") >= F.col("top_df")).withColumn("t_even", F.abs("t"))
    values = even.unionByName(values.filter(F.col("df_total") < F.col("top_df")).withColumn("t_even", on_top_df))
    leading = (
        numbered(values, ["pair"], [F.desc("t_even"), F.col("gene")], total="_n")
        .filter(F.col("rn") <= size)
        .withColumn("p", F.greatest(size / F.col("n"), F.lit(proportion)))
    )
    target = ((F.col("rn") - 0.5) / F.col("n") - (1 - F.col("p")) * F.col("p_value")) / F.col("p")
    expected = t_for_two_sided_of(F.greatest(F.col("target"), F.lit(1e-300)), F.col("top_df").cast("double"))
    raw = F.when(
        F.col("target") > F.col("p_value"),
        F.col("unscaled") ** 2 * ((F.col("t_even") / F.col("expected")) ** 2 - 1),
    ).otherwise(F.lit(0.0))
    bounded = F.least(F.greatest(raw, low**2 / F.col("s2_prior")), high**2 / F.col("s2_prior"))
    return (
        leading.withColumn("target", target)
        .withColumn("expected", expected)
        .groupBy("pair")
        .agg(F.avg(bounded).alias("v0"))
    )


def best_probe(df: DataFrame, by: list[str]) -> DataFrame:
    """Per gene symbol the probe with the highest mean; blank symbols and NULL means are dropped."""
    known = df.filter("symbol <> '' and ave_expr is not null").withColumn("_order", -F.col("ave_expr"))
    return first_by(known, [*by, "symbol"], ["_order", "probe"]).select(*df.columns)


def upper_two_thirds(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose mean is strictly above the value at rank floor(n/3); NULL means are dropped."""
    rank = F.floor(F.col("total") / 3)
    spans = value_spans(df, by, "ave_expr")
    inside = (F.col("before") < rank) & (rank <= F.col("before") + F.col("size"))
    cuts = spans.groupBy(*by).agg(F.max(F.when(inside, F.col("ave_expr"))).alias("_cut"))
    above = F.col("_cut").isNull() | (F.col("ave_expr") > F.col("_cut"))
    return df.filter("ave_expr is not null").join(cuts, by).filter(above).drop("_cut")


def top_genes(df: DataFrame, by: list[str], order: list[Column], n: int = 250) -> DataFrame:
    """The first ``n`` rows per key. Spark keeps n per task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rn", place).filter(F.col("_rn") <= n).drop("_rn")


def bh_adjust(df: DataFrame, by: list[str], p: str = "p_value", name: str = "adj_p_value") -> DataFrame:
    """Benjamini-Hochberg adjusted p-values per key; computed once per distinct p-value."""
    spans = value_spans(df, by, p)
    scaled = spans.withColumn("_q", F.col(p) * F.col("total") / (F.col("before") + F.col("size")))
    lowest = running_min_from_end(scaled, by, "_q", p, "_low")
    adjusted = lowest.select(*by, p, F.least("_low", F.lit(1.0)).alias(name))
    return df.join(adjusted, [*by, p], "left")


def gene_table(df: DataFrame, platform: str, n: int = 250) -> DataFrame:
    """The result table of a moderated fit.

    ``sequencing``: the first ``n`` genes of each pair by log odds, adjusted over all
    genes. ``array``: expects ``probe`` and ``symbol``; keeps named genes in the upper
    two thirds of means with their best probe, all judged on the full table, and adjusts
    over what is left.
    """
    if platform == "sequencing":
        return top_genes(bh_adjust(df, ["pair"]), ["pair"], [F.desc("b"), F.col("gene")], n)
    high = upper_two_thirds(df, ["pair"]).filter("symbol <> ''")
    best = best_probe(df, ["pair"]).select("pair", "probe")
    kept = high.join(best, ["pair", "probe"], "left_semi")
    return bh_adjust(kept, ["pair"])
