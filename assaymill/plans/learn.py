"""Training sets and the classifier bench."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from assaymill.operators import models
from assaymill.operators.features import chi2_slicer, fit_features, hashed_features
from assaymill.operators.training_sets import combination_sets, exact_split, sample_training_sets, series_training_sets
from assaymill.session import cut
from assaymill.sources.catalog import Catalog


def build_training_sets(
    series_ids: DataFrame, labels: dict[str, str], sample_ids: DataFrame, catalog: Catalog
) -> DataFrame:
    """(dataset, text, label): series titles, summaries and both, and the 15 sample sets."""
    series = series_training_sets(series_ids, catalog.gse, labels)
    samples = combination_sets(sample_training_sets(sample_ids, catalog.gsm))
    return series.selectExpr("concat('gse_', dataset) dataset", "text", "label").unionByName(
        samples.selectExpr("concat('gsm_', dataset) dataset", "text", "label")
    )


def benchmark(
    dataset: DataFrame,
    key: str | None = None,
    chosen: dict[str, Callable] | None = None,
    chi2_k: int | None = None,
    hash_buckets: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Scores and times of the classifiers on the seeded 80/20 split of (key, text, label).

    Labels that are text become class numbers by their order. Rows without a key get one.
    """
    dataset = cut(dataset if key else dataset.withColumn("_row", F.monotonically_increasing_id()))
    key = key or "_row"
    if dict(dataset.dtypes)["label"] == "string":
        dataset = models.index_labels(dataset).transform(dataset).drop("label").withColumnRenamed("label_no", "label")
    train, test = exact_split(dataset, key, 0.8, seed)
    ready = hashed_features(n=hash_buckets) if hash_buckets else fit_features(train, max_df=0.5, sublinear=True)
    column = "features"
    if chi2_k and not hash_buckets:
        ready = PipelineModel([*ready.stages, chi2_slicer(train, ready, key, chi2_k)])
        column = "selected"

    def vectors(df: DataFrame) -> DataFrame:
        return ready.transform(df).select("label", column).withColumnRenamed(column, "features")

    return models.bench(vectors(train), vectors(test), chosen or models.classifiers())
