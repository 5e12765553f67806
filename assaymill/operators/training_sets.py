"""Labelled text sets from curated id lists."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from assaymill.operators.lookups import lookup, split_ids

TEXT_TYPES = {
    "title": "title",
    "desc": "description",
    "charcs": "characteristics_ch1",
    "source": "source_name_ch1",
}


def series_training_sets(curated: DataFrame, series: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(dataset, text, label) for titles, summaries and both, duplicates kept.

    ``curated`` holds (file, geo_id); ``labels`` names the label of each curated file.
    """
    label = F.create_map(*[F.lit(x) for item in labels.items() for x in item])[F.col("file")]
    ids = curated.select("file", F.col("geo_id").alias("gse")).distinct()
    texts = F.array(
        *[
            F.struct(F.lit(dataset).alias("dataset"), F.col(column).alias("text"))
            for dataset, column in (("title", "title"), ("summary", "summary"), ("all", "title"), ("all", "summary"))
        ]
    )
    return (
        series.join(ids, "gse")
        .select(F.explode(texts).alias("t"), label.alias("label"))
        .select("t.dataset", "t.text", "label")
        .filter("text is not null and label is not null")
    )


def sample_training_sets(curated: DataFrame, samples: DataFrame) -> DataFrame:
    """Distinct (type, text, label) of the curated control and perturbed samples."""
    lists = F.array(
        F.struct(F.lit("ctrl").alias("label"), split_ids("ctrl_ids").alias("ids")),
        F.struct(F.lit("pert").alias("label"), split_ids("pert_ids").alias("ids")),
    )
    labels = (
        curated.select(F.explode(lists).alias("l"))
        .select("l.label", F.explode("l.ids").alias("gsm"))
        .distinct()
    )
    texts = F.array(
        *[F.struct(F.lit(name).alias("type"), F.col(column).alias("text")) for name, column in TEXT_TYPES.items()]
    )
    return (
        lookup(labels, samples, "gsm")
        .join(labels, "gsm")
        .select("label", F.explode(texts).alias("t"))
        .select("t.type", "t.text", "label")
        .filter("text <> ''")
        .distinct()
    )


def combination_names(types: list[str]) -> dict[str, list[str]]:
    """The 15 data sets of four types: each type, every two and three of them, and all."""
    names = {}
    for size in range(1, len(types)):
        for chosen in combinations(sorted(types), size):
            names["_".join(chosen)] = list(chosen)
    names["all"] = sorted(types)
    return names


def combination_sets(df: DataFrame, types: list[str] = list(TEXT_TYPES)) -> DataFrame:
    """Distinct (dataset, text, label) of every combination of text types.

    One shuffle serves all sets: each (text, label) gathers a bit per type it occurs
    in and then goes to every set that shares a bit with it.
    """
    bits = {name: 1 << i for i, name in enumerate(sorted(types))}
    bit = F.create_map(*[F.lit(x) for item in bits.items() for x in item])[F.col("type")]
    seen = df.groupBy("text", "label").agg(F.bit_or(bit).alias("seen"))
    sets = F.array(
        *[
            F.struct(F.lit(name).alias("dataset"), F.lit(sum(bits[c] for c in chosen)).alias("mask"))
            for name, chosen in combination_names(types).items()
        ]
    )
    shared = F.filter(sets, lambda s: s["mask"].bitwiseAND(F.col("seen")) != 0)
    return seen.select(F.explode(shared).alias("s"), "text", "label").select("s.dataset", "text", "label")


def exact_split(df: DataFrame, key: str, fraction: float = 0.8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``floor(fraction * n)`` training rows, shuffled by a seeded hash.

    ``key`` is unique. Rows are ordered by (hash, key); a histogram of 65,536 hash
    ranges finds the range of the cut and only that range is sorted. Both sides are
    then plain filters, and no row of ``df`` is shuffled.
    """
    hashed = df.select(F.xxhash64(F.lit(seed), F.col(key)).alias("_hash"), F.col(key).alias("_key"))
    slot = F.shiftright(F.col("_hash"), 48)
    histogram = hashed.groupBy(slot.alias("slot")).count().orderBy("slot").collect()
    wanted = int(fraction * sum(row["count"] for row in histogram) + 1e-9)
    position = F.struct(F.xxhash64(F.lit(seed), F.col(key)).alias("h"), F.col(key).alias("k"))
    rest = wanted
    for row in histogram:
        if rest <= row["count"]:
            break
        rest -= row["count"]
    if wanted == 0:
        return df.filter(F.lit(False)), df
    last = (
        hashed.filter(slot == row["slot"]).orderBy("_hash", "_key").limit(rest)
        .agg(F.max(F.struct("_hash", "_key")).alias("m")).first()["m"]
    )
    edge = F.struct(F.lit(last["_hash"]).alias("h"), F.lit(last["_key"]).cast(df.schema[key].dataType).alias("k"))
    return df.filter(position <= edge), df.filter(position > edge)
