"""Tests of the findings of round 3."""

from __future__ import annotations

import numpy as np
import pytest

from assaymill.llm import quality, repeats
from assaymill.operators import clustering, reads
from assaymill.session import cut
from contract.standins import Tables


def tables(spark, tmp_path, texts: list[str]) -> Tables:
    rows = [(k, text, "en", f"src{k % 2}", len(text or "")) for k, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    return Tables(spark, str(tmp_path))


def test_a_read_does_not_carry_its_document(spark, tmp_path):
    texts = ["Ab cd! " * 90, "", None, "x" * 80, "123", "é" * 5 + "z" * 161]
    t = tables(spark, tmp_path, texts)
    found = {(r["file"], r["read_no"]): len(r["seq"]) for r in t.reads.collect()}
    sizes = {k: sum("a" <= c <= "z" for c in (text or "").lower()) for k, text in enumerate(texts)}
    assert found == {(f"src{k % 2}", k * 10000 + i): min(80, n - 80 * i) for k, n in sizes.items() for i in range(-(-n // 80))}
    plan = reads.with_complexity(t.reads).select("read_no", "complexity")._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "Generate" in line]
    assert len(made) == 1 and "regexp_extract_all" in made[0]  # the letters of the document end here
    assert not any(" s#" in line.split("Generate")[0] for line in plan.splitlines()[: plan.splitlines().index(made[0])])


def test_words_of_a_read_are_counted_as_by_pairs():
    codes = np.random.default_rng(0).integers(0, 1 << 24, size=(300, 9))
    codes[:, 3] = codes[:, 0]
    codes[7] = 5
    assert (reads.same_in_row(codes) == (codes[:, :, None] == codes[:, None, :]).sum(axis=2)).all()


def test_clustering_broadcasts_no_vectors(spark):
    rows = [(k % 2, k, ["a", "b", f"w{k % 5}"], 1, 1) for k in range(40)]
    nodes = spark.createDataFrame(rows, "gse int, node int, tokens array<string>, n_ctrl long, n_pert long")
    pairs = clustering.close_pairs(cut(clustering.node_vectors(cut(nodes))), 0.1, 8, 0.1)
    assert pairs.filter("level = 0").count() == 2 * sum(1 for a in range(0, 40, 2) for b in range(0, a, 2) if a % 5 == b % 5)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_the_threshold_comes_from_all_labelled_rows(spark):
    draw = np.random.default_rng(8)
    good = np.abs(draw.normal(0.0, [0.01, 0.02, 0.02, 0.1], size=(600, 4))).round(3)
    bad = good[:80] + [0.5, 0.3, 0.3, 0.9]
    shares = np.concatenate([good, bad])
    rows = [(k, 100, 0, *map(float, x)) for k, x in enumerate(shares)]
    stats = spark.createDataFrame(rows, f"doc_id long, n_words long, n_repeat_words long, {', '.join(f'{c} double' for c in quality.SHARES)}")
    labels = spark.createDataFrame([(k, int(k < 600)) for k in range(len(rows))], "doc_id long, quality int")
    marks = np.arange(len(rows)) < 600
    for most in (100, 20000):
        forest, threshold = quality.fit(stats, labels, most, 0.3)
        assert len(forest.trees) == quality.TREES
        assert threshold == pytest.approx(quality.calibrate(forest.score(shares), marks, 0.3), abs=1e-12) and threshold < 1
    assert quality.fit(stats, labels.filter("quality = 1"), 100)[1] == float("inf")


def test_repeats_settled_in_small_groups_of_windows(spark, monkeypatch):
    shared = "".join(chr(97 + i) for i in np.random.default_rng(1).integers(0, 26, 600))
    texts = [f"{k}" * 30 + shared[k * 7 : k * 7 + 300] + f"{k + 1}" * 30 for k in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(map(tuple, repeats.remove_repeats(docs).collect()))
    monkeypatch.setattr(repeats, "WINDOWS", 40)
    assert sorted(map(tuple, repeats.remove_repeats(docs).collect())) == whole
    assert sum(r[2] for r in whole) > 2000


def test_windows_looked_at_in_rounds_are_all_windows_once(spark):
    shared = "".join(chr(97 + i) for i in np.random.default_rng(2).integers(0, 26, 600))
    texts = [f"{k}" * 30 + shared[k * 9 : k * 9 + 200 + k] + f"{k + 1}" * 30 for k in range(8)]
    rows = spark.createDataFrame([(k, k, text) for k, text in enumerate(texts)], "doc_id long, row long, text string")
    replies = cut(repeats.settle_runs(repeats.anchored(rows, 4), 4))
    dealt = repeats.compressed(rows).selectExpr("*", "pmod(row, 4L) to")

    def windows(*turn):
        found = repeats.looked_at(dealt, replies, 4, *turn).filter("kind = 0").toPandas()
        _, w, _, row, start, _ = repeats.unpack(found)
        return list(zip(w.tolist(), row.tolist(), start.tolist()))

    parts = [windows(turn, 3) for turn in range(3)]
    assert sorted(sum(parts, [])) == sorted(windows())
    assert sum(map(bool, parts)) > 1 and not set.intersection(*({w for w, _, _ in part} for part in parts[:2]))


def test_settled_runs_do_not_multiply_with_the_buckets(spark, monkeypatch):
    """op10_repeats: a settled run is one row, however many buckets there are; pieces and single windows give the same."""
    draw = np.random.default_rng(4)
    letters = ["".join(chr(97 + i) for i in draw.integers(0, 26, 200)) for _ in range(31)]
    texts = [a + letters[0][:70] + b for a, b in zip(letters[1:16], letters[16:])]
    rows = spark.createDataFrame([(k, k, text) for k, text in enumerate(texts)], "doc_id long, row long, text string")
    few, many = (repeats.settle_runs(repeats.anchored(rows, n), n).filter("kind = 0").count() for n in (3, 101))
    assert few == many > 15
    whole = sorted(map(tuple, repeats.remove_repeats(rows).collect()))
    assert 14 * 70 <= sum(r[2] for r in whole) <= 14 * 74
    monkeypatch.setattr(repeats, "HEAVY", 5)
    assert sorted(map(tuple, repeats.remove_repeats(rows).collect())) == whole


def test_periodic_text_is_looked_at_in_few_bytes(spark):
    """op10_repeats: where a text repeats itself the anchor moves with each window, and yet the bytes travel once."""
    texts = ["a" * 2000 + "b", "c" + "a" * 1500 + "d", "xyz" * 300 + "a" * 70 + "d", "xyz" * 200 + "q"]
    rows = spark.createDataFrame([(k, k, text) for k, text in enumerate(texts)] + [(1, 1, texts[1])], "doc_id long, row long, text string")
    replies = cut(repeats.settle_runs(repeats.anchored(rows, 4), 4)).filter("kind = 0")
    found = repeats.pieces(repeats.compressed(rows).selectExpr("*", "pmod(row, 4L) to"), replies, 4).collect()
    assert 1500 < sum(len(r["piece"]) for r in found) < 3 * sum(map(len, texts))
    first: dict[str, int] = {}
    for k, text in enumerate(texts):
        for i in range(len(text) - 49):
            first.setdefault(text[i : i + 50], k)
    for r in repeats.remove_repeats(rows).collect():
        text = texts[r["doc_id"]]
        covered = {j for i in range(len(text) - 49) if first[text[i : i + 50]] < r["doc_id"] for j in range(i, i + 50)}
        assert r["n_removed"] == len(covered)
        assert bytes(r["kept"]).decode() == "".join(c for i, c in enumerate(text) if i not in covered)
