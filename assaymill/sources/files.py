"""Readers for the text files the pipeline exchanges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from assaymill.functions.text import sample_from_path

PAIR_SCHEMA = (
    "gse_id string, pert_agent string, ctrl_gsm_ids string, pert_gsm_ids string, microarray_grouping string, "
    "is_pert_title boolean, is_pert_summary boolean, organism string, direction string"
)
CURATED_SCHEMA = "geo_id string, ctrl_ids string, pert_ids string"
HIT_SCHEMA = "document string, position string, mention string, concept string, semantic_types string"
SCORE_SCHEMA = "clf string, f1_scores double, precisions double, recalls double"

# The metrics kept from a metrics block.
METRICS = [
    "pf_bases", "pf_aligned_bases", "ribosomal_bases", "coding_bases", "utr_bases", "intronic_bases",
    "intergenic_bases", "ignored_reads", "correct_strand_reads", "incorrect_strand_reads",
]

CSV = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def scan_id_list(spark: SparkSession, path: str, partitions: int) -> DataFrame:
    """One series id per line, in at least ``partitions`` splits; blank lines are dropped."""
    ids = spark.read.text(path).select(F.trim("value").alias("gse")).filter("gse <> ''")
    return ids.repartition(partitions)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Classified pairs by column name; a blank line gives no row, a missing agent or id list is blank."""
    pairs = spark.read.csv(path, schema=PAIR_SCHEMA, **(CSV | {"multiLine": False})).filter("gse_id is not null")
    return pairs.fillna("", ["pert_agent", "ctrl_gsm_ids", "pert_gsm_ids"])


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=CURATED_SCHEMA, header=True).filter("geo_id is not null")


def file_path() -> Column:
    return F.col("_metadata.file_path")


def folder_name(path: Column) -> Column:
    """Name of the folder a file lies in, without a ``key=`` in front."""
    # Only the end of a long path is searched.
    return F.regexp_extract(F.substring_index(path, "/", -2), r"([^/=]*)/[^/]*$", 1)


#: Spark's setting of the most tasks that list folders; by default each of up to 10,000 folders is a task.
LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def text_below(spark: SparkSession, path: str, schema: str = "value string", **options) -> DataFrame:
    """``spark.read.text`` of very many folders, which four tasks a core list."""
    before = spark.conf.get(LISTERS)
    spark.conf.set(LISTERS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        return spark.read.schema(schema).options(**options).text(path)
    finally:
        spark.conf.set(LISTERS, before)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file below ``path`` with the path it came from."""
    lines = spark.read.text(path, recursiveFileLookup=True)
    return lines.select(file_path().alias("path"), "value")


def read_abundance(spark: SparkSession, path: str) -> DataFrame:
    """(sample, gene, count) from per-sample abundance tables, one folder per sample or part.

    Counts are cut to whole numbers.
    """
    rows = spark.read.csv(
        path,
        schema="target_id string, length string, eff_length string, est_counts double, tpm string",
        sep="\t",
        header=True,
        recursiveFileLookup=True,
    )
    return rows.select(
        sample_from_path(folder_name(file_path())).alias("sample"),
        F.col("target_id").alias("gene"),
        F.col("est_counts").cast("bigint").alias("count"),
    )


def read_metrics(spark: SparkSession, path: str, keep: list[str] = METRICS) -> DataFrame:
    """The kept, non-empty metrics of each file's metrics block as (sample, gene, count).

    The files are reports of a few lines, so each is read as one value.
    """
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    lines = F.split("value", "\n")
    start = F.expr("array_position(transform(lines, x -> startswith(x, '## METRICS CLASS')), true)").cast("int")
    cells = (
        text.select(sample_from_path(folder_name(file_path())).alias("sample"), lines.alias("lines"))
        .withColumn("start", start)
        .filter("start > 0 and size(lines) >= start + 2")
        .select(
            "sample",
            F.explode(
                F.arrays_zip(
                    F.split(F.lower(F.expr("lines[start]")), "\t").alias("name"),
                    F.split(F.expr("lines[start + 1]"), "\t").alias("value"),
                )
            ).alias("cell"),
        )
        .select("sample", "cell.name", "cell.value")
    )
    return cells.filter(F.col("name").isin(keep) & (F.trim("value") != "")).select(
        "sample",
        F.concat(F.lit("QC_picard_"), "name").alias("gene"),
        F.col("value").cast("double").cast("bigint").alias("count"),
    )


def read_concept_hits(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Concept hits of a terminology matcher; ``position`` keeps the file order, and is NULL where it is no number."""
    hits = spark.read.csv(path, schema=HIT_SCHEMA, sep="\t", header=header, enforceSchema=True)
    return hits.withColumn("position", F.expr("try_cast(position as bigint)")).filter("concept is not null")


def read_matrix(spark: SparkSession, path: str, organism: str | None = None) -> DataFrame:
    """Long (gene, sample, count) matrix partitioned by organism; other organisms are not read."""
    matrix = spark.read.parquet(path)
    return matrix if organism is None else matrix.filter(F.col("organism") == organism.lower())


def read_one_line(spark: SparkSession, path: str) -> DataFrame:
    """One read or pair per line, split into its tab-separated fields, with the source file."""
    lines = text_below(spark, path, recursiveFileLookup=True)
    return lines.select(
        folder_name(file_path()).alias("file"), "value", F.split("value", "\t").alias("fields")
    )


def read_four_line(spark: SparkSession, path: str) -> DataFrame:
    """Records of four lines each, numbered per file.

    Lines of one file arrive in order and a file's splits have rising offsets, so
    the line number is the row number over (split start, row within the split).
    Split-local numbers are shifted by the line counts of the splits before.
    """
    lines = text_below(spark, path, recursiveFileLookup=True).select(
        file_path().alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    blocks = lines.groupBy("path", "block").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select(
        "path", "block", (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_low")).alias("_shift")
    )
    line_no = F.col("_id") + F.col("_shift")
    slot = F.pmod("line_no", F.lit(4))

    def line(number: int) -> Column:
        return F.max(F.when(slot == number, F.col("value")))

    return (
        lines.join(shifts, ["path", "block"])
        .withColumn("line_no", line_no)
        .groupBy("path", F.floor(F.col("line_no") / 4).alias("record_no"))
        .agg(line(0).alias("id"), line(1).alias("seq"), line(2).alias("plus"), line(3).alias("qual"))
        .select(folder_name(F.col("path")).alias("file"), "record_no", "id", "seq", "plus", "qual")
    )


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """All score files below ``path`` with the data set their name carries.

    ``gse_train_title_clf_score.csv`` is data set ``title``.
    """
    rows = spark.read.csv(path, schema=SCORE_SCHEMA, header=True, recursiveFileLookup=True)
    name = F.regexp_extract(file_path(), r"train_([^/]*)_clf", 1)
    return rows.select(name.alias("dataset"), "clf", "f1_scores", "precisions", "recalls")


def read_training_lines(spark: SparkSession, path: str) -> DataFrame:
    """(text, label, dataset) of ``write_training_lines``; large files are read by several tasks."""
    return spark.read.schema("text string, label string, dataset string").json(path)
