"""Density clustering of each series' samples by their text.

With two samples enough for a dense point, clusters are the connected components
of the graph "distance <= eps" and isolated samples are noise. Nothing below holds
a series in one task:

* samples with the same words are one node, so copies never form pairs;
* eps rises in bands: a series that has its split is out of all later bands, so the wide
  distances, which most pairs meet, are looked for only where nothing closer splits;
* pairs come from a prefix filter: with words ordered from rare to common, two vectors at
  cosine >= t share a word within prefixes whose rest has a norm below t. Products of the
  shared prefix words are summed per pair, before the shuffle where they meet, and a pair
  goes on to its full product only if the norms of what is left can bring it to t;
* a word shared by many nodes is split over salted blocks;
* of the pairs of two blocks of nodes only a spanning forest by level is kept, which has
  the same components at every eps; what is searched for components is about as many
  edges as nodes, not all pairs once for each eps;
* components spread by smallest-label propagation with pointer jumping, one
  written cut per round.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from assaymill.functions.text import STOP_WORDS, words
from assaymill.operators.ordering import numbered
from assaymill.session import cut, shuffled

#: Nodes of a salted block of a word, nodes of a block of a series whose pairs meet in one task.
BLOCK, FOREST = 2000, 1000
#: What a prefix leaves has a norm below this share of the least cosine; lower means longer prefixes and fewer full products.
REACH = 0.8
BANDS = 3


def with_both_types(df: DataFrame) -> DataFrame:
    """Rows of series that have a control and a perturbed sample."""
    kinds = df.groupBy("gse").agg(
        F.bool_or(F.col("type") == "ctrl").alias("ctrl"), F.bool_or(F.col("type") == "pert").alias("pert")
    )
    return df.join(shuffled(kinds.filter("ctrl and pert").select("gse")), "gse", "left_semi")


def word_bags(df: DataFrame, stop: list[str]) -> DataFrame:
    bag = F.array_sort(words(F.col("text"), stop))
    return df.withColumn("tokens", bag).withColumn("bag", F.md5(F.concat_ws(" ", "tokens")))


def sample_nodes(bags: DataFrame) -> DataFrame:
    """One node per distinct word bag of a series, named by its first sample."""
    return bags.groupBy("gse", "bag").agg(
        F.min("gsm").alias("node"),
        F.count_if(F.col("type") == "ctrl").alias("n_ctrl"),
        F.count_if(~F.col("type").eqNullSafe("ctrl")).alias("n_pert"),
        F.any_value("tokens").alias("tokens"),
    )


def node_vectors(nodes: DataFrame) -> DataFrame:
    """Unit TF-IDF vector of each node, from its rarest word to its most common one."""
    size = F.col("n_ctrl") + F.col("n_pert")
    terms = (
        nodes.select("gse", "node", size.alias("size"), F.explode("tokens").alias("token"))
        .groupBy("gse", "node", "size", "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    spread = terms.groupBy("gse", "token").agg(F.sum("size").alias("df"))
    totals = nodes.groupBy("gse").agg(F.sum(size).alias("n"))
    weight = F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)
    return (
        terms.join(shuffled(spread), ["gse", "token"])
        .join(shuffled(totals), "gse")
        .groupBy("gse", "node")
        .agg(F.array_sort(F.collect_list(F.struct("df", F.xxhash64("token").alias("id"), weight.alias("w")))).alias("v"))
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"])))
        .select(
            "gse",
            "node",
            F.transform("v", lambda x: x["id"]).alias("ids"),
            F.transform("v", lambda x: x["w"] / F.col("norm")).alias("weights"),
        )
    )


def prefixes(vectors: DataFrame, least_cosine: float) -> DataFrame:
    """(gse, id, node, w, tail): the rarest words of each vector and the norm of what they leave."""
    rest = F.aggregate(
        F.reverse("weights"),
        F.struct(F.lit(0.0).alias("mass"), F.lit(0.0).alias("tail"), F.lit(0).alias("dropped")),
        lambda acc, w: F.struct(
            (acc["mass"] + w * w).alias("mass"),
            F.when(acc["mass"] + w * w < (REACH * least_cosine) ** 2, acc["mass"] + w * w).otherwise(acc["tail"]).alias("tail"),
            (acc["dropped"] + F.when(acc["mass"] + w * w < (REACH * least_cosine) ** 2, 1).otherwise(0)).alias("dropped"),
        ),
    )
    ended = vectors.select("gse", "node", "ids", "weights", rest.alias("_r"))
    head = F.slice(F.arrays_zip("ids", "weights"), F.lit(1), F.size("ids") - F.col("_r.dropped"))
    found = ended.select("gse", "node", F.sqrt("_r.tail").alias("tail"), F.explode(head).alias("_e"))
    return found.select("gse", F.col("_e.ids").alias("id"), "node", F.col("_e.weights").alias("w"), "tail")


def candidate_pairs(vectors: DataFrame, least_cosine: float) -> DataFrame:
    """Distinct (gse, a, b) whose shared prefix words, with the norms of the rest, allow ``least_cosine``."""
    entries = prefixes(vectors, least_cosine)
    blocks = (
        entries.groupBy("gse", "id").count().filter("count > 1")
        .select("gse", "id", F.ceil(F.col("count") / BLOCK).cast("int").alias("salts"))
    )
    placed = entries.join(shuffled(blocks), ["gse", "id"])
    left = placed.select(
        "gse", "id", F.col("node").alias("a"), F.col("w").alias("wa"), F.col("tail").alias("ta"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    right = placed.select(
        "gse", "id", F.col("node").alias("b"), F.col("w").alias("wb"), F.col("tail").alias("tb"),
        F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"),
    )
    sums = (
        left.join(shuffled(right), ["gse", "id", "salt"]).filter("a < b").groupBy("gse", "a", "b").agg(
            F.sum(F.col("wa") * F.col("wb")).alias("met"), F.sum(F.col("wa") * F.col("wa")).alias("ma"),
            F.sum(F.col("wb") * F.col("wb")).alias("mb"), F.max("ta").alias("ta"), F.max("tb").alias("tb"),
        )
    )
    # Beyond the prefix that ends first, one side has its tail and the other at most what it did not meet with.
    left_of = lambda mass: F.sqrt(F.greatest(1 - F.col(mass), F.lit(0.0)))
    most = F.col("met") + F.greatest(F.col("ta") * left_of("mb"), F.col("tb") * left_of("ma"))
    return sums.filter(most > least_cosine - 1e-9).select("gse", "a", "b")


def close_pairs(vectors: DataFrame, eps_from: float, last: int, step: float) -> DataFrame:
    """(gse, a, b, level): the first of the eps values, counted from 0, that joins a pair, up to level ``last``."""
    widest = eps_from + last * step

    def side(name: str) -> DataFrame:
        return vectors.select("gse", F.col("node").alias(name), F.map_from_arrays("ids", "weights").alias(f"v_{name}"))

    products = F.map_zip_with("v_a", "v_b", lambda _, x, y: x * y)
    dot = F.aggregate(F.map_values(products), F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
    distance = F.round(F.sqrt(F.greatest(2 - 2 * dot, F.lit(0.0))), 9)
    level = F.greatest(F.ceil(F.round((F.col("d") - eps_from) / step, 7)).cast("int"), F.lit(0))
    return (
        candidate_pairs(vectors, 1 - widest**2 / 2 - 1e-6)
        .join(shuffled(side("a")), ["gse", "a"])
        .join(shuffled(side("b")), ["gse", "b"])
        .select("gse", "a", "b", distance.alias("d"))
        .select("gse", "a", "b", level.alias("level"))
        .filter(F.col("level") <= last)
    )


def spanning_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the components of all of ``edges`` (gse, a, b, level) at every level.

    The nodes of a series lie in blocks; of the edges between two blocks a minimum
    spanning forest is kept. An edge that is the last of a cycle of edges of no higher
    level joins nothing, so what a forest leaves out is needed at no level.
    """
    sizes = nodes.groupBy("gse").agg(F.ceil(F.count(F.lit(1)) / FOREST).cast("int").alias("_blocks"))
    block = lambda name: F.pmod(F.xxhash64(name), F.col("_blocks")).cast("int")
    placed = edges.join(shuffled(sizes), "gse").withColumns({"_i": block("a"), "_j": block("b")})
    placed = placed.select("gse", "a", "b", "level", F.least("_i", "_j").alias("_low"), F.greatest("_i", "_j").alias("_high"))

    def forest(key, frame):
        frame = frame.sort_values("level", kind="stable")
        parent: dict = {}

        def root(n):
            while (up := parent.setdefault(n, n)) != n:
                parent[n] = n = parent.setdefault(up, up)
            return n

        keep = []
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
            ra, rb = root(a), root(b)
            keep.append(ra != rb)
            parent[ra] = rb
        return frame.loc[pd.Series(keep, index=frame.index, dtype=bool), ["gse", "a", "b", "level"]]

    return placed.groupBy("gse", "_low", "_high").applyInPandas(forest, edges.schema)


def components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, node, label) with the smallest node of its component for every node of ``edges`` (a, b)."""
    both = cut(
        edges.select(*keys, "a", "b").unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
    )
    labels = cut(
        both.groupBy(*keys, F.col("a").alias("node"))
        .agg(F.min("b").alias("label"))
        .withColumn("label", F.least("node", "label"))
    )
    while True:
        around = (
            both.join(shuffled(labels.withColumnRenamed("node", "b")), [*keys, "b"])
            .groupBy(*keys, F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(shuffled(around), [*keys, "node"]).select(
            *keys, "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        parents = lower.select(*keys, F.col("node").alias("label"), F.col("label").alias("parent"))
        jumped = cut(
            lower.join(shuffled(parents), [*keys, "label"], "left")
            .select(*keys, "node", "old", F.coalesce("parent", "label").alias("label"))
        )
        moved = jumped.filter("label <> old").limit(1).count()
        labels = jumped.drop("old")
        if not moved:
            return labels


def cluster_samples(
    df: DataFrame, eps_from: float = 0.1, eps_to: float = 0.9, step: float = 0.1, stop: list[str] = STOP_WORDS
) -> DataFrame:
    """Samples of accepted series with their cluster: (gse, gsm, text, type, cluster, eps).

    eps rises until a series has two clusters and an accepted split: its lowest control
    cluster has two control samples, or some cluster has two perturbed ones. Noise is
    cluster -1, is no cluster for the count of two, but counts as a group on either side.
    Clusters are numbered by their first sample. Series without a split give no rows.
    """
    steps = round((eps_to - eps_from) / step) + 1
    bags = word_bags(df.select("gse", "gsm", "text", "type"), stop)
    nodes = cut(sample_nodes(bags))
    vectors = cut(node_vectors(nodes))
    ends = sorted({round(steps * (k + 1) / BANDS) - 1 for k in range(BANDS)} - {-1})
    chosen, first = None, 0
    for last in ends:
        if chosen is not None:
            nodes_left = cut(nodes_left.join(shuffled(chosen.select("gse").distinct()), "gse", "left_anti"))
            vectors = vectors.join(shuffled(chosen.select("gse").distinct()), "gse", "left_anti")
            if nodes_left.isEmpty():
                break
        else:
            nodes_left = nodes
        found = split_series(nodes_left, vectors, eps_from, first, last, step)
        chosen = found if chosen is None else cut(chosen.unionByName(found))
        first = last + 1
    names = numbered(
        chosen.filter("label is not null").select("gse", "label").distinct(), ["gse"], [F.col("label")]
    ).select("gse", "label", (F.col("rn") - 1).alias("cluster"))
    node_clusters = chosen.join(shuffled(names), ["gse", "label"], "left").select(
        "gse", "node", F.coalesce("cluster", F.lit(-1)).cast("int").alias("cluster"),
        F.round(eps_from + F.col("level") * step, 9).alias("eps"),
    )
    bag_clusters = nodes.select("gse", "bag", "node").join(shuffled(node_clusters), ["gse", "node"]).drop("node")
    return bags.join(shuffled(bag_clusters), ["gse", "bag"]).select("gse", "gsm", "text", "type", "cluster", "eps")


def split_series(nodes: DataFrame, vectors: DataFrame, eps_from: float, first: int, last: int, step: float) -> DataFrame:
    """(gse, level, node, label) of the series with an accepted split at a level from ``first`` to ``last``, at the lowest such."""
    edges = spanning_edges(close_pairs(vectors, eps_from, last, step), nodes)
    edges = edges.withColumn("level", F.explode(F.sequence(F.greatest("level", F.lit(first)), F.lit(last))))
    labels = components(edges, ["gse", "level"])
    alone = F.when(F.col("n_ctrl") + F.col("n_pert") > 1, F.col("node"))
    levels = nodes.select("gse", "node", "n_ctrl", "n_pert", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("level"))
    labelled = levels.join(shuffled(labels), ["gse", "level", "node"], "left").withColumn("label", F.coalesce("label", alone))
    clusters = labelled.groupBy("gse", "level", "label").agg(
        F.sum("n_ctrl").alias("n_ctrl"), F.sum("n_pert").alias("n_pert")
    )
    order = F.struct(F.col("label").isNotNull().alias("cluster"), F.col("label"))
    lowest_control = F.min_by(F.when(F.col("n_ctrl") > 0, F.col("n_ctrl")), F.when(F.col("n_ctrl") > 0, order))
    accepted = (
        clusters.groupBy("gse", "level")
        .agg(F.count("label").alias("n_clusters"), lowest_control.alias("low"), F.max("n_pert").alias("high"))
        .filter("n_clusters > 1 and (low > 1 or high > 1)")
        .groupBy("gse")
        .agg(F.min("level").alias("level"))
    )
    return cut(labelled.join(shuffled(accepted), ["gse", "level"]).select("gse", "level", "node", "label"))
