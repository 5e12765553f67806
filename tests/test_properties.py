"""Brute force, hot keys and independence of the partitioning."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from assaymill.functions import special
from assaymill.functions.text import STOP_WORDS
from assaymill.operators import diffexp, models
from assaymill.operators.clustering import cluster_samples, components
from assaymill.operators.ordering import average_rank, numbered, quantiles, running_total
from assaymill.operators.training_sets import exact_split

SMALL = "/root/testdata/sf0.001"


def hot_rows(n=400):
    """One key with most of the rows, one value with most of those."""
    rng = random.Random(3)
    return [("hot" if rng.random() < 0.8 else f"k{i % 5}", 7 if rng.random() < 0.5 else rng.randint(0, 40), i)
            for i in range(n)]


def test_numbered_and_totals(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, v int, id int")
    order = [F.col("v"), F.col("id")]
    got = {r["id"]: (r["rn"], r["n"]) for r in numbered(df, ["k"], order).collect()}
    sums = {r["id"]: r["s"] for r in running_total(df, ["k"], order, "v", "s").collect()}
    for key in {k for k, _, _ in rows}:
        total = 0
        mine = sorted((v, i) for k, v, i in rows if k == key)
        for place, (v, i) in enumerate(mine, 1):
            assert got[i] == (place, len(mine)) and sums[i] == total
            total += v


def test_quantiles_and_ranks(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, v int, id int")
    found = {r["k"]: r for r in quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.99}).collect()}
    ranks = {r["id"]: r["r"] for r in average_rank(df, ["k"], "v", "r").collect()}
    for key, row in found.items():
        values = [v for k, v, _ in rows if k == key]
        assert math.isclose(row["a"], np.quantile(values, 0.25)) and math.isclose(row["b"], np.quantile(values, 0.99))
        for k, v, i in rows:
            if k == key:
                assert ranks[i] == sum(x < v for x in values) + (values.count(v) + 1) / 2


def test_long_path_is_one_component(spark):
    edges = spark.createDataFrame([("g", i, i + 1) for i in range(60)] + [("g", 100, 101)], "gse string, a int, b int")
    labels = {r["node"]: r["label"] for r in components(edges, ["gse"]).collect()}
    assert {labels[i] for i in range(61)} == {0} and labels[101] == 100


def brute_clusters(samples):
    """The search of one series, pair by pair."""
    docs = [[w for w in text.lower().split() if len(w) > 1 and w not in STOP_WORDS] for _, text, _ in samples]
    n = len(docs)
    df = {w: sum(w in d for d in docs) for d in docs for w in d}
    vectors = []
    for d in docs:
        v = {w: d.count(w) * (math.log((1 + n) / (1 + df[w])) + 1) for w in d}
        length = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({w: x / length for w, x in v.items()})
    distance = [[round(math.sqrt(max(0, 2 - 2 * sum(x * b.get(w, 0) for w, x in a.items()))), 9) for b in vectors]
                for a in vectors]
    for k in range(1, 10):
        root = list(range(n))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i in range(n):
            for j in range(i):
                if distance[i][j] <= k / 10:
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
        roots = [find(i) for i in range(n)]
        names = {r: c for c, r in enumerate(sorted({r for r in roots if roots.count(r) > 1}))}
        labels = [names.get(r, -1) for r in roots]
        control = [l for l, s in zip(labels, samples) if s[2] == "ctrl"]
        perturbed = [l for l, s in zip(labels, samples) if s[2] != "ctrl"]
        if len(names) > 1 and (control.count(min(control)) > 1 or any(perturbed.count(l) > 1 for l in perturbed)):
            return {(s[0], label, k / 10) for s, label in zip(samples, labels)}
    return set()


def test_clusters_match_brute_force(spark):
    rng = random.Random(11)
    vocabulary = ["liver", "brain", "wild", "type", "knock", "day", "line", "cell", "heart", "mouse", "treated", "mock"]
    series = {}
    for g in range(12):
        size = 60 if g == 0 else rng.randint(4, 14)
        series[f"g{g}"] = [
            (100 * g + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 6))),
             "ctrl" if i % 3 == 0 else "pert") for i in range(size)]
    rows = [(g, *s) for g, samples in series.items() for s in samples]
    df = spark.createDataFrame(rows, "gse string, gsm int, text string, type string")
    got = {(r["gse"], r["gsm"], r["cluster"], r["eps"]) for r in cluster_samples(df).collect()}
    expected = {(g, *c) for g, samples in series.items() for c in brute_clusters(samples)}
    assert got == expected


@pytest.mark.parametrize("name", ["best_match", "grouping_string", "sized_parts", "bh_adjust", "resolve_agent", "tmm_factors"])
def test_partitions_do_not_matter(spark, partitions, name):
    query = entry_module.queries()[name]
    partitions(3)
    few = sorted(map(str, query(spark, SMALL).collect()))
    partitions(11)
    assert few == sorted(map(str, query(spark, SMALL).collect()))


def test_exact_split(spark):
    df = spark.range(1003).withColumnRenamed("id", "key")
    train, test = exact_split(df, "key", 0.8, 0)
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert len(a) == 802 and len(b) == 201 and not a & b


def test_special_functions():
    assert math.isclose(special.digamma(np.array([1.0]))[0], -0.5772156649015329, rel_tol=1e-10)
    assert math.isclose(special.trigamma(np.array([1.0]))[0], math.pi**2 / 6, rel_tol=1e-10)
    y = np.array([0.01, 0.7, 5.0, 900.0])
    assert np.allclose(special.trigamma(special.trigamma_inverse(y)), y, rtol=1e-8)
    p = special.two_sided_t(np.array([2.228138852, 12.7062047, 1.959963985, 0.0]), np.array([10, 1, np.inf, 4]))
    assert np.allclose(p, [0.05, 0.05, 0.05, 1.0], atol=1e-7)
    assert np.allclose(special.t_for_two_sided(np.array([0.05]), np.array([10.0])), [2.228138852], atol=1e-7)


def test_moderated_t_against_plain_arithmetic(spark):
    rng = np.random.default_rng(5)
    rows, spread = [], rng.gamma(3, 1, 40)
    for g in range(40):
        for s in range(8):
            rows.append(("p", f"g{g:02d}", f"s{s}", s // 4, float(rng.normal(5 + (g < 4) * (s // 4) * 3, spread[g]))))
    df = spark.createDataFrame(rows, "pair string, gene string, sample string, grp int, value double")
    fit = diffexp.contrast(diffexp.fit_two_groups(df))
    got = {r["gene"]: r for r in diffexp.moderated_t(fit).collect()}
    values = np.array([r[4] for r in rows]).reshape(40, 2, 4)
    s2 = values.var(axis=2, ddof=1).mean(axis=1)
    e = np.log(s2) - special.digamma(np.array([3.0])) + math.log(3)
    excess = e.var(ddof=1) - special.trigamma(np.array([3.0]))[0]
    d0 = 2 * special.trigamma_inverse(np.array([excess]))[0]
    prior = math.exp(e.mean() + special.digamma(np.array([d0 / 2]))[0] - math.log(d0 / 2))
    post = (d0 * prior + 6 * s2) / (d0 + 6)
    t = (values[:, 1].mean(axis=1) - values[:, 0].mean(axis=1)) / np.sqrt(post / 2)
    for g in range(40):
        row = got[f"g{g:02d}"]
        assert math.isclose(row["t"], t[g], rel_tol=1e-8)
        assert math.isclose(row["p_value"], special.two_sided_t(t[g:g + 1], np.array([d0 + 6]))[0], rel_tol=1e-8)
    by_b = sorted(got.values(), key=lambda r: -r["b"])
    assert [r["gene"] for r in by_b] == [r["gene"] for r in sorted(got.values(), key=lambda r: -abs(r["t"]))]


def vectors(spark, rows):
    from pyspark.ml.linalg import Vectors

    return spark.createDataFrame([(Vectors.dense(x), float(y)) for x, y in rows], ["features", "label"])


def test_neighbours_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(models, "BLOCK", 16)
    rng = np.random.default_rng(2)
    train = [(rng.normal(size=3) + 1.5 * (i % 3), i % 3) for i in range(60)]
    test = [(rng.normal(size=3) + 1.5 * (i % 3), i % 3) for i in range(40)]
    predicted = models.nearest_neighbours(5)(vectors(spark, train))(vectors(spark, test))
    for row in predicted.collect():
        near = sorted((round(float(((row["features"].toArray() - x) ** 2).sum()), 9), y) for x, y in train)[:5]
        votes = [y for _, y in near]
        assert row["prediction"] == min(set(votes), key=lambda y: (-votes.count(y), y))


def test_classifiers_separate_two_clouds(spark):
    rng = np.random.default_rng(4)
    sides = np.array([[0, 0, 1, 1], [1, 1, 0, 0]])
    rows = [(np.abs(rng.normal(size=4) * 0.2 + sides[i % 2]), i % 2) for i in range(60)]
    clouds, switches = vectors(spark, rows), vectors(spark, [(np.where(x > 0.5, x, 0.0), y) for x, y in rows])
    for name, fit in models.classifiers(trees=5, boosts=2, rounds=5).items():
        frame = switches if name == "BernoulliNB" else clouds
        assert models.score(fit(frame)(frame))["f1"] > 0.9, name


def test_options_without_a_spark_form_fail(spark):
    for name, point in (("svc", {"loss": "squared_hinge"}), ("sgd", {"loss": "perceptron"}), ("bnb", {"fit_prior": False})):
        with pytest.raises(ValueError):
            models.TUNABLE[name](point)
