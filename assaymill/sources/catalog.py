"""The archive's metadata catalog as five DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

GSE_COLUMNS = ["gse", "title", "summary", "overall_design"]
GSM_COLUMNS = [
    "gsm", "gpl", "title", "source_name_ch1", "description", "characteristics_ch1", "treatment_protocol_ch1",
    "extract_protocol_ch1", "organism_ch1",
]


@dataclass(frozen=True)
class Catalog:
    gse: DataFrame
    gsm: DataFrame
    gse_gsm: DataFrame
    gpl: DataFrame
    gse_gpl: DataFrame


def scan_catalog(spark: SparkSession, path: str) -> Catalog:
    """One Parquet folder per table below ``path``; only the columns in use are read."""

    def table(name: str, columns: list[str]) -> DataFrame:
        return spark.read.parquet(f"{path.rstrip('/')}/{name}").select(*columns)

    return Catalog(
        gse=table("gse", GSE_COLUMNS),
        gsm=table("gsm", GSM_COLUMNS),
        gse_gsm=table("gse_gsm", ["gse", "gsm"]),
        gpl=table("gpl", ["gpl", "technology"]),
        gse_gpl=table("gse_gpl", ["gse", "gpl"]),
    )


def scan_catalog_jdbc(spark: SparkSession, url: str, partitions: int, max_rowid: int, driver: str) -> Catalog:
    """The same tables over JDBC, read in ``partitions`` row-id ranges. Needs a driver jar."""

    def table(name: str, columns: list[str]) -> DataFrame:
        wanted = ", ".join(columns)
        return (
            spark.read.format("jdbc")
            .options(
                url=url, driver=driver, dbtable=f"(select rowid as row_no, {wanted} from {name}) t",
                partitionColumn="row_no", lowerBound=1, upperBound=max_rowid, numPartitions=partitions,
            )
            .load()
            .select(*columns)
        )

    return Catalog(
        gse=table("gse", GSE_COLUMNS),
        gsm=table("gsm", GSM_COLUMNS),
        gse_gsm=table("gse_gsm", ["gse", "gsm"]),
        gpl=table("gpl", ["gpl", "technology"]),
        gse_gpl=table("gse_gpl", ["gse", "gpl"]),
    )


def write_catalog(catalog: Catalog, path: str) -> None:
    for name in ("gse", "gsm", "gse_gsm", "gpl", "gse_gpl"):
        getattr(catalog, name).write.mode("overwrite").parquet(f"{path}/{name}")


def scan_all_series(catalog: Catalog) -> DataFrame:
    return catalog.gse.select("gse")
