"""Hand-computed corner cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assaymill.functions import text
from assaymill.functions.similarity import jaro_winkler_score
from assaymill.operators import agents, counts, diffexp, lookups, matching, reads, routing, scores, training_sets
from assaymill.operators.clustering import cluster_samples, with_both_types
from assaymill.operators.ordering import first_by
from assaymill.sources import files, sinks


def value(spark, column, **fields):
    return spark.createDataFrame([tuple(fields.values())], list(fields)).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("given, expected", [
    ("TGFβ 2", "TGF beta 2"), ("IL1  ALPHA", "IL1 ALPHA"), ("γ", " gamma"), ("plain", "plain"),
])
def test_greek(spark, given, expected):
    assert value(spark, text.greek_to_words(F.col("t")), t=given) == expected


@pytest.mark.parametrize("given, expected", [
    ("knockout of the transgenic tg line", "-"), ("increased cream", "-"), ("overexpressed transgenic tg", "+"),
    ("nothing", "-"), ("+/- mice", "-"),
])
def test_direction(spark, given, expected):
    assert value(spark, text.direction(F.col("t")), t=given) == expected


@pytest.mark.parametrize("given, expected", [("24 hrs", 24), ("3Days", 3), ("10 human", 10), ("none", None), ("7", None)])
def test_time(spark, given, expected):
    assert value(spark, text.time_value(F.col("t")), t=given) == expected


@pytest.mark.parametrize("given, expected", [
    ("SRR197454", "SRR197"), ("SRR1974543", "SRR197/003"), ("SRR19745431", "SRR197/031"),
    ("SRR197454312", "SRR197/312"), ("SRR1974543120", None),
])
def test_accession(spark, given, expected):
    assert value(spark, text.accession_path(F.col("t")), t=given) == expected


def test_sample_from_path(spark):
    assert value(spark, text.sample_from_path(F.col("t")), t="/in/SRR1_1_part0.fastq.gz") == "SRR1_1"


def test_assemble_and_agent(spark):
    column = text.assemble(F.col("a"), F.col("b"), F.lit(None).cast("string"), F.lit(""))
    assert value(spark, column, a="x", b="y") == "x y"
    assert value(spark, text.clean_agent(F.col("a")), a="p53(h) Superfamily") == "p53 h  "


def test_keywords_are_literal_and_skip_nulls(spark):
    df = spark.createDataFrame([("50% dose", None), ("50x dose", None), (None, "a_b")], "a string, b string")
    hit = lookups.match_keywords(df, ["a", "b"], [], ["50% D", "A_B"])
    assert {tuple(r) for r in hit.collect()} == {("50% dose", None), (None, "a_b")}


def test_keyword_fallback(spark):
    samples = spark.createDataFrame([("s1", "liver"), ("s2", "brain"), ("s3", "brain")], "gsm string, title string")
    for name in lookups.SAMPLE_TEXT_COLUMNS[1:]:
        samples = samples.withColumn(name, F.lit(None).cast("string"))
    series = spark.createDataFrame([("g1", "liver", ""), ("g2", "liver atlas", ""), ("g3", "x", "y")],
                                   "gse string, title string, summary string")
    links = spark.createDataFrame([("g1", "s1"), ("g1", "s2"), ("g2", "s2"), ("g2", "s3"), ("g3", "s3")],
                                  "gse string, gsm string")
    got = lookups.keyword_fallback(samples, series, links, ["liver"], [])
    assert {tuple(r) for r in got.collect()} == {("g1", "s1"), ("g2", "s2"), ("g2", "s3")}


def test_blank_agent_passes(spark):
    df = spark.createDataFrame([("",), ("p53",), ("TP53 gene",), ("BRCA1",)], ["pert_agent"])
    assert {r[0] for r in agents.filter_agent(df, "TP53").collect()} == {"", "p53", "TP53 gene"}
    assert {r[0] for r in agents.filter_agent(df, "TP53", keep_blank=False).collect()} == {"p53", "TP53 gene"}


def test_longer_phrase_wins_at_its_place(spark):
    df = spark.createDataFrame([("g", "with tumor protein and insulin", "t")], "gse string, text string, title string")
    kinds = "Amino Acid, Peptide, or Protein"
    terms = spark.createDataFrame(
        [("tumor", "Tumor", kinds), ("tumor protein", "TP", kinds), ("insulin", "INS", kinds)],
        "term string, concept string, semantic_types string")
    aliases = spark.createDataFrame([("TP", "TP53", 1), ("TP", "X", 2)], "alias string, symbol string, hit int")
    assert agents.resolve_agent(df, terms, aliases, ["gse"], max_n=2).first()["pert_agent"] == "TP53"


def test_both_types(spark):
    df = spark.createDataFrame([("a", 1, "ctrl"), ("a", 2, "other"), ("b", 3, "ctrl"), ("b", 4, "pert")],
                               "gse string, gsm int, type string")
    assert {r["gse"] for r in with_both_types(df).collect()} == {"b"}


def match(spark, rows):
    clustered = spark.createDataFrame(rows, "gse string, gsm int, text string, type string, cluster int")
    return matching.best_match(*matching.cluster_groups(clustered))


def group(first, label, text_, kind):
    return [("g", first, text_, kind, label), ("g", first + 1, text_, kind, label)]


def test_latest_time_wins(spark):
    rows = group(1, 0, "0 h", "ctrl") + group(3, 1, "6 h", "pert") + group(5, 2, "24 h", "pert") + group(7, 3, "x", "pert")
    assert [(r["pert_cluster"], r["diff"]) for r in match(spark, rows).collect()] == [(2, 24)]


def test_no_later_time_drops_the_row(spark):
    assert match(spark, group(1, 0, "48 h", "ctrl") + group(3, 1, "24 h", "pert")).collect() == []


def test_similarity_and_tie(spark):
    rows = group(1, 0, "abc", "ctrl") + group(3, 1, "abd", "pert") + group(5, 2, "abd", "pert") + group(7, 3, "z", "pert")
    assert [r["pert_cluster"] for r in match(spark, rows).collect()] == [1]


def test_jaro_winkler_known_values():
    assert round(jaro_winkler_score("MARTHA", "MARHTA"), 4) == 0.9611
    assert round(jaro_winkler_score("DIXON", "DICKSONX"), 4) == 0.8133
    assert jaro_winkler_score("abc", "xyz") == 0.0


def test_grouping_string(spark):
    clustered = spark.createDataFrame(
        [("g", 1, "ctrl", 0), ("g", 2, "pert", 5), ("g", 3, "ctrl", 0), ("g", 4, "pert", 1), ("g", 5, "ctrl", 7)],
        "gse string, gsm int, type string, cluster int")
    matches = spark.createDataFrame([("g", 0, 1)], "gse string, ctrl_cluster int, pert_cluster int")
    row = matching.grouping_string(clustered, matches).first()
    assert (row["microarray_grouping"], row["ctrl_gsm_ids"], row["pert_gsm_ids"]) == ("0X01X", "1|3", "4")


@pytest.mark.parametrize("types, accepted", [("ccpp", True), ("ccpc", False)])
def test_two_pairs_of_texts(spark, types, accepted):
    kinds = {"c": "ctrl", "p": "pert"}
    rows = [("g", i, "alpha beta" if i < 2 else "gamma delta", kinds[t]) for i, t in enumerate(types)]
    got = cluster_samples(spark.createDataFrame(rows, "gse string, gsm int, text string, type string"))
    assert {r["cluster"] for r in got.collect()} == {0, 1} and {r["eps"] for r in got.collect()} == {0.1}
    control, perturbed = matching.cluster_groups(got)
    assert (perturbed.count() > 0) == accepted


def test_count_pivot_and_truncation(spark):
    df = spark.createDataFrame([("s1", "g1", 2), ("s1", "g1", 3), ("s2", "g2", 1)], "sample string, gene string, count long")
    assert {tuple(r) for r in counts.pivot_counts(df, ["s1", "s2"]).collect()} == {("g1", 5, None), ("g2", None, 1)}


def test_abundance_truncates(spark, tmp_path):
    folder = tmp_path / "in" / "s1_part0"
    folder.mkdir(parents=True)
    (folder / "abundance.tsv").write_text("target_id\tlength\teff_length\test_counts\ttpm\ng1\t1\t1\t3.99\t0\n")
    assert [tuple(r) for r in files.read_abundance(spark, str(tmp_path / "in")).collect()] == [("s1", "g1", 3)]


def test_pair_csv_blank_line(spark, tmp_path):
    path = tmp_path / "pairs.csv"
    path.write_text("gse_id,pert_agent,ctrl_gsm_ids,pert_gsm_ids,microarray_grouping,is_pert_title,is_pert_summary,"
                    "organism,direction\n\n")
    assert files.read_pairs(spark, str(path)).count() == 0


def test_empty_pairs_keep_their_header(spark, tmp_path):
    empty = spark.createDataFrame([], files.PAIR_SCHEMA)
    sinks.write_pairs(empty, str(tmp_path / "none"))
    assert files.read_pairs(spark, str(tmp_path / "none")).columns == sinks.PAIR_COLUMNS
    assert sinks.sibling_path("s3://bucket/a/ids.txt", "out") == "s3://bucket/a/out"


def test_upper_two_thirds(spark):
    df = spark.createDataFrame([("p", i, float(i)) for i in range(1, 7)], "pair string, probe int, ave_expr double")
    assert sorted(r["ave_expr"] for r in diffexp.upper_two_thirds(df, ["pair"]).collect()) == [3, 4, 5, 6]


def test_bh(spark):
    df = spark.createDataFrame([("p", p) for p in (0.01, 0.03, 0.04, 0.5)], "pair string, p_value double")
    got = sorted((r["p_value"], round(r["adj_p_value"], 4)) for r in diffexp.bh_adjust(df, ["pair"]).collect())
    assert [a for _, a in got] == [0.04, 0.0533, 0.0533, 0.5]


def test_fifteen_sets():
    names = training_sets.combination_names(list(training_sets.TEXT_TYPES))
    assert len(names) == 15 and names["all"] == ["charcs", "desc", "source", "title"]


def test_rejoin_mates(spark):
    schema = "file string, record_no int, id string, seq string, plus string, qual string"
    r1 = spark.createDataFrame([("f", i, f"{n} 1", n.upper(), "+", "I") for i, n in enumerate(["a", "b", "c", "b"])], schema)
    r2 = spark.createDataFrame([("f", i, f"{n} 2", "", "+", "I") for i, n in enumerate("bcd")], schema)
    got = reads.rejoin_mates(r1, r2).orderBy("record_no").collect()
    assert [r["id"] for r in got] == ["b 1", "c 1"]


def test_quality_trim(spark):
    qual = "".join(chr(33 + q) for q in (30, 30, 30, 30, 2, 2))
    df = spark.createDataFrame([("ACGTAC", qual)], "seq string, qual string")
    assert reads.quality_trim(df).first()["seq"] == "ACGT"


def test_window_cut(spark):
    qual = "".join(chr(33 + q) for q in (2, 30, 30, 30, 30, 5, 5, 5, 5, 30))
    df = spark.createDataFrame([("ACGTACGTAC", qual)], "seq string, qual string")
    # Windows from the second base on: sums 120, 95, 70, 45; the fourth window starts at the fifth base.
    assert reads.quality_trim(df).first()["seq"] == "CGT"


def test_adapter_clip(spark):
    adapter = reads.ADAPTERS[0]
    changed = "TT" + adapter[2:]
    rows = [("ACGT" * 3 + adapter + "CC",), ("AC" + changed,), ("C" * 40,), ("GGGG" + adapter[:5],)]
    df = spark.createDataFrame([(s, "I" * len(s)) for (s,) in rows], "seq string, qual string")
    assert [len(r["seq"]) for r in reads.clip_adapters(df).collect()] == [12, 2, 40, 9]
    assert [len(r["qual"]) for r in reads.clip_adapters(df, error_rate=0.15, min_overlap=3).collect()] == [12, 2, 40, 4]


def test_complexity(spark):
    df = spark.createDataFrame([("A" * 64, ""), ("ACGTTGCAGTCATGACCGTAGGCTAAC", "")], "seq string, qual string")
    low, high = [r["complexity"] for r in reads.with_complexity(df).collect()]
    assert low == 0 and high > 90


def test_interleave_round_trip(spark):
    row = spark.createDataFrame([("f", "a", "AC", "+", "II", ("b", "GT", "+", "JJ"))],
                                "file string, id string, seq string, plus string, qual string, "
                                "mate struct<id string, seq string, plus string, qual string>")
    back = reads.deinterleave(reads.interleave(row)).orderBy("mate_no").collect()
    assert [(r["mate_no"], r["id"], r["seq"]) for r in back] == [(1, "a", "AC"), (2, "b", "GT")]


def test_read_parts_lose_nothing(spark, tmp_path):
    df = spark.createDataFrame([("f", i, "x" * 9) for i in range(25)], "file string, read_no int, line string")
    sinks.write_read_parts(df, str(tmp_path / "parts"), 45)
    back = spark.read.schema("value string, file string, part int").text(str(tmp_path / "parts"))
    assert back.count() == 25
    assert {r["part"]: r["count"] for r in back.groupBy("part").count().collect()} == {
        0: 5, 1: 4, 2: 5, 3: 4, 4: 5, 5: 2}


def test_first_by(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, o int, v string")
    assert {tuple(r) for r in first_by(df, ["k"], ["o"]).collect()} == {("a", 1, "y"), ("b", 3, "z")}


def test_routes(spark):
    rows = [("in situ oligonucleotide", True), ("high-throughput sequencing", True), ("high-throughput sequencing", False),
            (None, False), ("other", True)]
    df = spark.createDataFrame(rows, "t string, m boolean")
    got = [r["r"] for r in df.select(routing.route(F.col("t"), F.col("m")).alias("r")).collect()]
    assert got == ["microarray", "rna_seq", "falco", "unknown", "unknown"]


def test_scores(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "label int, prediction int")
    report = {r["class"]: r for r in scores.class_report(df).collect()}
    assert report[2]["f1"] == 0 and report[1]["recall"] == 1 and report[0]["support"] == 2
    assert round(scores.weighted_prf(df).first()["precision"], 6) == round((0.5 * 2 + 2 / 3 * 2) / 5, 6)
