"""Read preparation as a list of DataFrame steps."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from assaymill.operators import reads
from assaymill.session import kept

Step = Callable[[DataFrame], DataFrame]


def prepare_reads(df: DataFrame, steps: list[Step]) -> DataFrame:
    """Apply each step in turn; any function from reads to reads is a step."""
    return reduce(lambda frame, step: frame.transform(step), steps, df)


def window_recipe() -> list[Step]:
    """Adapters, low ends, a four-base window, 36 bases at least."""
    return [reads.clip_adapters, reads.quality_trim, reads.min_length]


def entropy_recipe() -> list[Step]:
    """Fixed left cut, right quality, complexity, then adapters within an error rate."""
    return [
        reads.trim_ends,
        lambda df: reads.min_length(df, 30),
        reads.drop_low_complexity,
        lambda df: reads.clip_adapters(df, error_rate=0.15, min_overlap=1),
        lambda df: reads.min_length(df, 30),
    ]


def both_mates(df: DataFrame, steps: list[Step]) -> DataFrame:
    """Prepare the two sides of (file, record_no, id, seq, plus, qual, mate) and re-join what is left.

    The pairs are written once, as finding them for each side would take every read four times.
    """
    df = kept(df.select("file", "record_no", *reads.FIELDS, "mate"), "pairs")
    first = prepare_reads(df.drop("mate"), steps)
    second = prepare_reads(
        df.select("file", "record_no", *[F.col(f"mate.{c}").alias(c) for c in reads.FIELDS]), steps
    )
    return reads.rejoin_mates(first, second)
