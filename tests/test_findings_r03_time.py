"""Tests of the findings of round 3 on time: what is evaluated how often, and that the results are the plain ones."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

from assaymill.operators import features, reads
from assaymill.operators.routing import pair_id
from assaymill.plans import analyse
from assaymill.plans.prepare import both_mates, window_recipe
from assaymill.sources import files, sinks


def optimized(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def random_reads(spark, n: int = 300):
    draw = np.random.default_rng(5)
    rows = []
    for k in range(n):
        size = int(draw.integers(0, 90))
        seq = "".join(draw.choice(list("ACGT"), size))
        if k % 3 == 0:
            adapter, at = reads.ADAPTERS[k % 6], int(draw.integers(0, 90))
            seq = (seq[:at] + adapter)[:90]
        qual = "".join(chr(33 + q) for q in draw.choice([2, 5, 12, 14, 15, 16, 20, 40], len(seq)))
        rows.append((k, seq, qual))
    rows += [(n, "ACGTNNACGTé" * 7, "é5" * 38 + "I"), (n + 1, None, None), (n + 2, "ACG", "II#")]
    return spark.createDataFrame(rows, "read_no long, seq string, qual string"), rows


def test_four_lines_are_read_without_a_search_of_the_path_per_line(spark, tmp_path):
    rows = [(f"run{k % 3}", k, f"@{k}\n{'ACGT' * (k % 5)}\n+\n{'IIII' * (k % 5)}") for k in range(50)]
    df = spark.createDataFrame(rows, "run string, k long, line string")
    path = str(tmp_path / "a=b" / "lines")
    df.repartition(2, "run").sortWithinPartitions("run", "k").select("run", "line").write.partitionBy("run").text(path)
    before = spark.conf.get(files.LISTERS)
    back = files.read_four_line(spark, path)
    assert spark.conf.get(files.LISTERS) == before
    found = sorted((r["file"], r["record_no"], r["id"], r["seq"], r["plus"], r["qual"]) for r in back.collect())
    assert found == sorted((run, k // 3, *line.split("\n")) for run, k, line in rows)
    plan = optimized(back)
    assert [i for i, x in enumerate(plan) if "regexp_extract" in x] == [0] and "Aggregate" in plan[0]


def test_parts_are_dealt_to_as_many_tasks_as_are_set(spark, tmp_path):
    rows = [(f"f{k % 4}", k, "x" * 30) for k in range(200)]
    df = spark.createDataFrame(rows, "file string, read_no long, line string")
    sinks.write_read_parts(df, str(tmp_path / "parts"), 100)
    back = spark.read.schema("value string, file string, part long").text(str(tmp_path / "parts"))
    assert {(r["file"], r["part"]): r["count"] for r in back.groupBy("file", "part").count().collect()} == Counter(
        (f"f{k % 4}", (k // 4) * 31 // 100) for k in range(200))


def test_windows_of_low_quality_are_the_plain_ones(spark):
    df, rows = random_reads(spark)
    trimmed = reads.quality_trim(df)
    assert not any("transform(" in line for line in optimized(trimmed))
    for r, (_, seq, qual) in zip(trimmed.orderBy("read_no").collect(), rows):
        if seq is None:
            assert r["seq"] is None and r["qual"] is None
            continue
        led = qual.lstrip(reads.below(3))
        end = led.rstrip(reads.below(3))
        seq = seq[len(qual) - len(led):][:len(end)]
        bad = next((i for i in range(len(end) - 3) if sum(ord(c) - 33 for c in end[i:i + 4]) < 60), len(end))
        assert (r["seq"], r["qual"]) == (seq[:bad], end[:bad])


def test_adapters_and_complexity_are_the_plain_ones(spark):
    df, rows = random_reads(spark)

    def first(seq: str, rate: float | None) -> int | None:
        for i in range(len(seq)):
            for a in reads.ADAPTERS:
                n = min(len(a), len(seq) - i)
                if (rate is not None or n == len(a)) and sum(x != y for x, y in zip(a, seq[i:])) <= (2 if rate is None else int(n * rate)):
                    return i
        return None

    for rate, overlap in ((None, None), (0.15, 1)):
        clipped = reads.clip_adapters(df, error_rate=rate, min_overlap=overlap).orderBy("read_no").collect()
        for r, (_, seq, _) in zip(clipped, rows):
            assert r["seq"] == (seq if seq is None else seq[:first(seq, rate)])

    def entropy(piece: str) -> float:
        words = Counter(piece[i:i + 3] for i in range(len(piece) - 2))
        n = sum(words.values())
        return 0.0 if n < 2 else -sum(c / n * math.log(c / n) for c in words.values()) / math.log(min(64, n)) * 100

    for r, (_, seq, _) in zip(reads.with_complexity(df).orderBy("read_no").collect(), rows):
        seq = seq or ""
        starts = range(0, max((len(seq) - 33) // 32, 0) * 32 + 1, 32)
        assert abs(r["complexity"] - sum(entropy(seq[s:s + 64]) for s in starts) / len(starts)) < 1e-9


def test_pairs_are_found_once_for_both_sides(spark):
    rows = [("f", k, f"@{k} 1", "ACGT" * 20, "+", "I" * 80, (f"@{k} 2", "TTGA" * 20, "+", "I" * (80 - k))) for k in range(80)]
    fields = "id string, seq string, plus string, qual string"
    pairs = spark.createDataFrame(rows, f"file string, record_no long, {fields}, mate struct<{fields}>")
    pairs = pairs.join(spark.range(60).withColumnRenamed("id", "record_no"), "record_no")
    prepared = both_mates(pairs, window_recipe())
    assert sum("Join" in line for line in optimized(prepared)) == 1
    assert sorted(r["record_no"] for r in prepared.collect()) == list(range(45))


def test_terms_are_counted_once(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, [])], "k long, tokens array<string>")
    weights = features.tfidf(df, "k", norm=None, use_idf=False)
    assert not any("Generate" in line for line in optimized(weights))
    assert sorted(map(tuple, weights.collect())) == [(1, "a", 2.0), (1, "b", 1.0), (2, "b", 1.0), (2, "c", 1.0)]


def test_the_matrices_are_read_once(spark):
    """F11 analyse_pairs: each route reads its matrix, which holds all samples, one time."""
    pairs = spark.createDataFrame(
        [("GSE1", "A", "Homo sapiens", "+", "S0|S1|S2", "S3|S4|S5")],
        "gse_id string, pert_agent string, organism string, direction string, ctrl_gsm_ids string, pert_gsm_ids string",
    ).withColumn("pair", pair_id())
    draw = np.random.default_rng(6)
    rows = [(f"g{g}", f"S{s}", int(n)) for g in range(30) for s, n in enumerate(draw.integers(50, 900, 9))]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    schema = "gene string, sample string, count bigint"
    matrix = spark.createDataFrame(rows, schema).mapInArrow(counted, schema)
    assert analyse.sequencing_genes(pairs, matrix, "difference").count() == 30
    assert read.value == len(rows)
    arrays = matrix.selectExpr("gene probe", "sample", "count value", "concat('SYM', gene) symbol")
    table = analyse.array_genes(pairs, arrays).collect()
    assert len({r["Gene.symbol"] for r in table}) == len(table) > 10
    assert read.value == 2 * len(rows)
