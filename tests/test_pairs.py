"""Pairs with missing ids, twins, blanks in agents; hits with a header; text labels."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assaymill.operators import agents, features, models, routing
from assaymill.plans.analyse import array_genes, route_pairs
from assaymill.plans.learn import benchmark
from assaymill.sources import files, sinks
from assaymill.sources.catalog import GSM_COLUMNS, Catalog

PAIR = "gse_id string, pert_agent string, ctrl_gsm_ids string, pert_gsm_ids string, organism string, direction string"


@pytest.fixture(scope="module")
def catalog(spark):
    gsm = spark.createDataFrame([(f"S{i}", "P1") for i in range(6)], "gsm string, gpl string")
    for column in GSM_COLUMNS[2:]:
        gsm = gsm.withColumn(column, F.lit("Homo sapiens" if column == "organism_ch1" else None).cast("string"))
    return Catalog(
        spark.createDataFrame([("G1", "t", "s", "d")], "gse string, title string, summary string, overall_design string"),
        gsm,
        spark.createDataFrame([("G1", f"S{i}") for i in range(6)], "gse string, gsm string"),
        spark.createDataFrame([("P1", "high-throughput sequencing")], "gpl string, technology string"),
        spark.createDataFrame([("G1", "P1")], "gse string, gpl string"),
    )


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(
        [
            ("G1", "a", "S0|S1", "S2", "Homo sapiens", "+"), ("G1", "b", "S0|S1", "S3|S5", "Homo sapiens", "-"),
            ("G1", "c", None, "S2", "Homo sapiens", "+"), ("G1", "d", "S0|S1", None, "Homo sapiens", "+"),
            ("G1", "e", "", "S2", "Homo sapiens", "+"), ("G1", "f", "S0", "", "Homo sapiens", "+"),
        ],
        PAIR,
    )


def test_every_pair_gets_one_route(spark, catalog, pairs):
    matrix = spark.createDataFrame([("g", f"S{i}", 5, "Homo sapiens") for i in range(5)], "gene string, sample string, count bigint, organism string")
    got = {r["pert_agent"]: (r["route"], r["command"], r["in_matrix"]) for r in route_pairs(pairs, catalog, matrix).collect()}
    assert got == {
        "a": ("rna_seq", None, True), "b": ("falco", None, False),
        "c": ("error", "no platform for the first control sample", False), "d": ("error", "no perturbed sample", True),
        "e": ("error", "no platform for the first control sample", False), "f": ("error", "no perturbed sample", True),
    }


def test_runs_of_twins_and_missing_ids(spark, pairs):
    runs = spark.createDataFrame([(f"S{i}", f"R{i}") for i in range(6)], "sample string, run string")
    got = {r["pert_agent"]: r["sra_ids"] for r in routing.runs_of(pairs, runs).collect()}
    assert got == {"a": "R0|R1|R2", "b": "R0|R1|R3|R5", "c": "R2", "d": "R0|R1", "e": "R2", "f": "R0"}


def test_pairs_survive_a_round_trip(spark, pairs, tmp_path):
    full = pairs.withColumn("pert_agent", F.concat(F.lit(' "'), "pert_agent", F.lit(" "))).withColumns({
        "microarray_grouping": F.lit("01X"), "is_pert_title": F.lit(True), "is_pert_summary": F.lit(False)})
    sinks.write_pairs(full, str(tmp_path / "pairs"))
    back = files.read_pairs(spark, str(tmp_path / "pairs"))
    expected = full.fillna("", ["ctrl_gsm_ids", "pert_gsm_ids"]).select(*back.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, expected.collect()))


def test_probes_keep_the_symbol_of_their_own_array(spark):
    pairs = spark.createDataFrame([("G1", "a", "A0|A1", "A2|A3", "h", "+"), ("G2", "b", "B0|B1", "B2|B3", "h", "+")], PAIR)
    pairs = pairs.withColumn("pair", routing.pair_id())
    values = [
        (probe, f"{array}{i}", 100.0 + 7 * i + 13 * n + (i * n) % 5, f"{array}{probe}")
        for array in "AB" for i in range(4) for n, probe in enumerate(["1", "2", "3", "4", "5", "6"])
    ]
    genes = array_genes(pairs, spark.createDataFrame(values, "probe string, sample string, value double, symbol string")).collect()
    assert genes and all(r["Gene.symbol"].startswith("A" if r["gse_id"] == "G1" else "B") for r in genes)


def test_concept_hits_with_a_header(spark, tmp_path):
    (tmp_path / "hits.tsv").write_text("document\tposition\tmention\tconcept\tsemantic_types\nd1\t3\tp53\tP53\tAmino Acid\nd1\tx\tm\tC\tFinding\n")
    got = [tuple(r)[:2] for r in files.read_concept_hits(spark, str(tmp_path / "hits.tsv")).orderBy("concept").collect()]
    assert got == [("d1", None), ("d1", 3)]


def test_agents_of_any_length(spark):
    terms = spark.createDataFrame(
        [("tumor necrosis factor", "TNF", "Amino Acid"), ("tumor", "TUMOR", "Amino Acid")], "term string, concept string, semantic_types string")
    rows = spark.createDataFrame([("G", "loss of Tumor Necrosis  Factor", "t")], "gse string, text string, title string")
    aliases = spark.createDataFrame([], "alias string, symbol string, hit int")
    assert agents.resolve_agent(rows, terms, aliases, ["gse"]).first()["pert_agent"] == "TNF"
    assert agents.resolve_agent(rows, terms, aliases, ["gse"], max_n=1).first()["pert_agent"] == "TUMOR"


def test_benchmark_takes_text_labels_without_keys(spark):
    rows = [([["blue", "stone"], ["red", "apple"]][i % 2][i // 2 % 2] + f" item{i % 7}", "pert" if i % 2 else "non_pert") for i in range(80)]
    data = spark.createDataFrame(rows, "text string, label string")
    chosen = {n: f for n, f in models.classifiers().items() if n in ("MultinomialNB", "LinearSVC")}
    got = benchmark(data, chosen=chosen).collect()
    assert {r["clf"] for r in got} == set(chosen) and all(r["f1_scores"] > 0.9 for r in got)


def test_selection_without_a_feature_is_an_error(spark):
    data = spark.createDataFrame([(f"w{i}", float(i % 2)) for i in range(6)], "text string, label double")
    rows = features.fit_features(data).transform(data).select("features", "label")
    with pytest.raises(ValueError):
        features.l1_select(rows, C=1e-6)
