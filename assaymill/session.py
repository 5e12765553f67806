"""Session settings, lineage cuts and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Paths that ``scratch_folder`` has given out.
_made: list[str] = []


def build_session(app: str = "assaymill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts are left to adaptive execution: set
    ``spark.sql.shuffle.partitions`` to about three times the cores of the
    cluster and let it coalesce.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session without the setting uses a folder of the warehouse, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root, until ``clear_scratch``."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove the folders made so far, once no frame that reads them is needed any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and drop its lineage."""
    context = df.sparkSession.sparkContext
    root = scratch_root(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """As ``cut``, in compressed columns: for large frames that are read in part, or several times."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is shuffled, never broadcast.

    Spark takes the size of a cut, and of what is exploded or collected, from the
    estimate of its source, which can be a hundredth of the rows' true size.
    """
    return df.hint("merge")
