"""The stages of the pipeline on the small table, and against plain Python."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.llm.test_corpus import docs, empty, rows, slow_fingerprint, slow_statistics, squeeze, roots  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def staged(spark, df, name, folder):
    path = f"{folder}/{name.replace(' ', '_')}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, docs, tmp_path):  # noqa: F811
    """Stage by stage: columns stay, decisions take effect, and each is what plain Python says of its own input."""
    now, inputs = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = now.collect()
        now = staged(spark, stage(spark, now, FOLDER), name, tmp_path)
        if name != "encoding":
            assert now.columns == docs.columns
    good = {r["doc_id"] for r in inputs["exact dedup"]}
    for r in inputs["quality rules"]:
        n, _, _, _, repeated = slow_statistics(r["text"])
        failed = n < 50 or (repeated is not None and 100 * len(repeated) > 50 * n)
        if failed and r["doc_id"] is not None:
            assert r["doc_id"] not in good
    assert len(inputs["exact dedup"]) > 20
    groups: dict = {}
    for r in inputs["exact dedup"]:
        groups.setdefault(squeeze(r["text"]), []).append((-len(r["text"]), float("inf") if r["doc_id"] is None else r["doc_id"]))
    expected = {min(g)[1] for g in groups.values()} - {float("inf")}
    assert {r["doc_id"] for r in inputs["near dedup"] if r["doc_id"] is not None} == expected
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in inputs["near dedup"] if r["doc_id"] is not None}
    found = roots(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least: dict = {}
    for i in sorted(prints):
        least.setdefault(found[prints[i]], i)
    assert {r["doc_id"] for r in inputs["mixing"] if r["doc_id"] is not None} == set(least.values())
    coded = now.collect()
    assert Counter(r["doc_id"] for r in coded) == Counter(r["doc_id"] for r in inputs["encoding"])
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in coded)


def test_empty(spark, empty, tmp_path):  # noqa: F811
    now = empty
    for name, stage in corpus_pipeline.STAGES:
        now = staged(spark, stage(spark, now, FOLDER), name, tmp_path)
        assert now.count() == 0


def test_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert 0 < got.count() <= spark.read.parquet(f"{FOLDER}/documents.parquet").count()
