"""Which analysis a pair goes to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assaymill.operators.lookups import split_ids

# Technologies of the array route, and the one of the sequencing routes.
ARRAY_TECHNOLOGIES = [
    "in situ oligonucleotide", "oligonucleotide beads", "spotted DNA/cDNA", "spotted oligonucleotide",
    "mixed spotted oligonucleotide/cDNA",
]
SEQUENCING = "high-throughput sequencing"
PAIR_KEY = ["gse_id", "ctrl_gsm_ids", "pert_gsm_ids"]


def pair_id() -> Column:
    """A pair's identity: its series and both id lists, where a missing list is a blank one."""
    return F.md5(F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in PAIR_KEY]))


def route(technology: Column, in_matrix: Column) -> Column:
    return (
        F.when(technology.isin(ARRAY_TECHNOLOGIES), "microarray")
        .when((technology == SEQUENCING) & in_matrix, "rna_seq")
        .when(technology == SEQUENCING, "falco")
        .otherwise("unknown")
    )


def matrix_organism(organism: Column) -> Column:
    """The matrix that holds an organism, NULL when there is none."""
    name = F.lower(organism)
    return F.when(name == "homo sapiens", "human").when(name == "mus musculus", "mouse")


def sequencing_grouping(ctrl: Column, pert: Column) -> Column:
    """``0`` per control sample, then ``1`` per perturbed sample."""
    return F.concat(F.repeat(F.lit("0"), F.size(split_ids(ctrl))), F.repeat(F.lit("1"), F.size(split_ids(pert))))


def pair_samples(pairs: DataFrame, columns: list[str]) -> DataFrame:
    """One row per sample of a pair: its ``pair`` id, ``columns``, order, sample and group.

    Rows with one pair id give their samples once. A missing or blank id list gives no rows, so
    results that go back to the pairs are left-joined.
    """
    sides = F.array(
        F.struct(F.lit("0").alias("grp"), F.when(F.col("ctrl_gsm_ids") != "", split_ids("ctrl_gsm_ids")).alias("ids")),
        F.struct(F.lit("1").alias("grp"), F.when(F.col("pert_gsm_ids") != "", split_ids("pert_gsm_ids")).alias("ids")),
    )
    return (
        pairs.select(pair_id().alias("pair"), *columns, "ctrl_gsm_ids", "pert_gsm_ids").dropDuplicates(["pair"])
        .select("pair", *columns, F.explode(sides).alias("s"))
        .select("pair", *columns, F.col("s.grp").alias("grp"), F.posexplode("s.ids").alias("pos", "sample"))
    )


def all_present(pairs: DataFrame, matrix: DataFrame) -> DataFrame:
    """Pairs with ``in_matrix``: whether every sample is in the matrix of the pair's organism.

    ``matrix`` holds (sample, organism, ...); only its distinct samples take part.
    """
    known = matrix.select("sample", matrix_organism(F.col("organism")).alias("held")).distinct()
    wanted = pair_samples(pairs, ["organism"]).withColumn("held", matrix_organism(F.col("organism")))
    found = (
        wanted.join(known.withColumn("found", F.lit(True)), ["sample", "held"], "left")
        .groupBy("pair")
        .agg(F.bool_and(F.coalesce("found", F.lit(False))).alias("in_matrix"))
    )
    return with_result(pairs, found).withColumn("in_matrix", F.coalesce("in_matrix", F.lit(False)))


def with_result(pairs: DataFrame, result: DataFrame) -> DataFrame:
    """``pairs``, all of them, with the columns of ``result`` by ``pair`` id."""
    named = result.withColumnRenamed("pair", "_pair")
    return pairs.withColumn("_key", pair_id()).join(named, F.col("_key") == F.col("_pair"), "left").drop("_key", "_pair")


def runs_of(pairs: DataFrame, runs: DataFrame) -> DataFrame:
    """Pairs with ``sra_ids``: the runs of their samples in sample order, joined by a bar."""
    listed = (
        pair_samples(pairs, [])
        .join(runs, "sample", "left")
        .groupBy("pair")
        .agg(F.array_sort(F.collect_list(F.when(F.col("run").isNotNull(), F.struct("grp", "pos", "run")))).alias("r"))
    )
    ids = listed.select("pair", F.array_join(F.transform("r", lambda x: x["run"]), "|").alias("sra_ids"))
    return with_result(pairs, ids).withColumn("sra_ids", F.coalesce("sra_ids", F.lit("")))


def union_routes(*frames: DataFrame) -> DataFrame:
    """Frames of one route, by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
