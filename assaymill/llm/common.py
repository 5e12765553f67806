"""What several operators share: input columns and written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assaymill.session import scratch_folder

#: ASCII white space, the only characters that separate words here.
SPACE = " \t\n\x0b\x0c\r"


def plain(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; a null text is an empty one.

    Any other column is left behind, so no name can clash with the columns added.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting that removes the shuffle files of a query when it ends, and not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_alone(df: DataFrame, name: str) -> DataFrame:
    """``written``, for a large ``df`` that is not used again: its shuffle files go as soon as it is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)
