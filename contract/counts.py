"""Counts, matrices and their files."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions.text import sample_from_path
from assaymill.operators import counts as ops
from assaymill.session import scratch_folder
from assaymill.sources import files, sinks
from contract.registry import big, query, r6
from contract.standins import Tables

SAMPLES = [f"s{i:02d}" for i in range(12)]
PIVOT = ", ".join(f"cast(sum(c) filter (where sample = '{s}') as bigint) as {s}" for s in SAMPLES)
INTEGERS = "(select sample, part, gene, cast(trunc(est_counts) as bigint) c from px_counts)"


def counted(t: Tables):
    return t.counts.select("sample", "gene", F.col("est_counts").cast("bigint").alias("count"))


@query("whole_file_scan", """
    select sample, part, count(*) n_lines, cast(sum(length(gene || chr(9) || cast(trunc(est_counts) as bigint))) as bigint) n_chars
    from px_counts group by all""")
def whole_file_scan(t: Tables):
    path = scratch_folder(t.spark, "whole-files")
    t.counts.selectExpr(
        "concat(sample, '_part', part) run", "concat_ws('\t', gene, cast(est_counts as bigint)) line"
    ).write.partitionBy("run").text(path)
    run = files.folder_name(F.col("path"))
    return (
        files.read_lines(t.spark, path)
        .groupBy(
            sample_from_path(run).alias("sample"), F.regexp_extract(run, "_part([0-9]+)", 1).cast("int").alias("part")
        )
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))
    )


@query("abundance_scan", "select sample, gene, cast(trunc(est_counts) as bigint) count from px_counts")
def abundance_scan(t: Tables):
    path = scratch_folder(t.spark, "abundance")
    t.counts.selectExpr(
        "concat(sample, '_part', part) run", "gene target_id", "'100' length", "'90' eff_length",
        "est_counts + 0.25 est_counts", "'0' tpm",
    ).write.partitionBy("run").csv(path, sep="\t", header=True)
    return files.read_abundance(t.spark, path)


@query("sample_from_path", """
    select sample, count(*) n_paths, count(distinct part) n_parts from px_counts group by sample""")
def sample_of_path(t: Tables):
    paths = t.counts.selectExpr("part", "concat('/in/', gene, '/', sample, '_part', part, '_1.fastq.gz') path")
    return (
        paths.groupBy(sample_from_path(F.col("path")).alias("sample"))
        .agg(F.count(F.lit(1)).alias("n_paths"), F.countDistinct("part").alias("n_parts"))
    )


@query("metrics_block_scan", """
    select sample, 'QC_picard_' || name gene, value count from (
        select sample, cast(sum(est_counts) as bigint) pf_bases, max(part) coding_bases, count(*) ignored_reads
        from px_counts group by sample)
    unpivot (value for name in (pf_bases, coding_bases, ignored_reads))""")
def metrics_block_scan(t: Tables):
    path = scratch_folder(t.spark, "metrics")
    reports = t.counts.groupBy("sample").agg(
        F.sum("est_counts").alias("bases"), F.max("part").alias("coding"), F.count(F.lit(1)).alias("ignored")
    )
    reports.selectExpr(
        "sample run",
        "concat('# job\n\n## METRICS CLASS\trna\nPF_BASES\tCODING_BASES\tUTR_BASES\tIGNORED_READS\tMEDIAN\n',"
        " concat_ws('\t', bases, coding, '', ignored, 0.5), '\n\n## HISTOGRAM\n') report",
    ).write.partitionBy("run").text(path)
    return files.read_metrics(t.spark, path)


@query("qc_gene_split", """
    select sample, starts_with(gene, 'QC_') is_qc, count(*) n, cast(sum(est_counts) as bigint) total
    from px_counts group by all""")
def qc_gene_split(t: Tables):
    genes, quality = ops.split_qc(counted(t))
    both = genes.withColumn("is_qc", F.lit(False)).unionByName(quality.withColumn("is_qc", F.lit(True)))
    return both.groupBy("sample", "is_qc").agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("total"))


@query("gene_count_sum", f"select sample, gene, cast(sum(c) as bigint) count from {INTEGERS} group by all")
def gene_count_sum(t: Tables):
    return ops.sum_counts(counted(t))


@query("gene_sample_pivot", f"select gene, {PIVOT} from {INTEGERS} group by gene")
def gene_sample_pivot(t: Tables):
    return ops.pivot_counts(counted(t), SAMPLES)


@query("sorted_matrix", f"""
    select gene, {PIVOT} from {INTEGERS} where not starts_with(gene, 'QC_') group by gene order by gene""")
def sorted_matrix(t: Tables):
    genes, _ = ops.count_matrix(counted(t), SAMPLES)
    return genes


@query("matrix_sink", f"""
    select starts_with(gene, 'QC_') is_qc, gene, {PIVOT} from {INTEGERS} group by gene""")
def matrix_sink(t: Tables):
    path = scratch_folder(t.spark, "matrix")
    sinks.write_matrix(counted(t), SAMPLES, path)
    schema = "gene string, " + ", ".join(f"{s} bigint" for s in SAMPLES)

    def back(name: str, flag: bool):
        return t.spark.read.csv(f"{path}/{name}", schema=schema, header=True).withColumn("is_qc", F.lit(flag))

    return back("samples_expression", False).unionByName(back("samples_qc_report", True))


@query("library_cpm", f"""
    with s as (select sample, gene, cast(sum(c) as bigint) count from {INTEGERS} group by all)
    select sample, gene, count, cast(sum(count) over (partition by sample) as bigint) lib_size,
           round(count / sum(count) over (partition by sample) * 1e6, 6) + 0.0 cpm from s""")
def library_cpm(t: Tables):
    return ops.library_cpm(ops.sum_counts(counted(t))).withColumn("cpm", r6("cpm"))


@query("value_quantiles", """
    select part, round(quantile_cont(est_counts, 0.0), 6) + 0.0 q0, round(quantile_cont(est_counts, 0.25), 6) + 0.0 q25,
           round(quantile_cont(est_counts, 0.5), 6) + 0.0 q50, round(quantile_cont(est_counts, 0.75), 6) + 0.0 q75,
           round(quantile_cont(est_counts, 0.99), 6) + 0.0 q99, round(quantile_cont(est_counts, 1.0), 6) + 0.0 q100
    from px_counts group by part""")
def value_quantiles(t: Tables):
    quantiles = ops.value_quantiles(t.counts, ["part"], "est_counts")
    return quantiles.select("part", *[r6(c).alias(c) for c in quantiles.columns[1:]])


@query("matrix_scan", """
    select gene, sample, count, lower(organism_ch1) organism
    from px_matrix join px_sample on gsm = sample where lower(organism_ch1) = 'homo sapiens'""")
def matrix_scan(t: Tables):
    path = scratch_folder(t.spark, "long-matrix")
    organisms = t.samples.select(F.col("gsm").alias("sample"), F.lower("organism_ch1").alias("organism"))
    sinks.write_long_matrix(t.matrix.join(organisms, "sample"), path)
    return files.read_matrix(t.spark, path, "Homo sapiens").select("gene", "sample", "count", "organism")


@query("matrix_sample_slice", """
    select gse, gene, sample, count from px_matrix join px_link on gsm = sample""")
def matrix_sample_slice(t: Tables):
    wanted = t.links.select("gse", F.col("gsm").alias("sample"))
    return ops.slice_matrix(t.matrix, wanted).select("gse", "gene", "sample", "count")
