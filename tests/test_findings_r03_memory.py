"""What single tasks and the driver hold, for findings of the third round."""

import tracemalloc

import numpy as np
from pyspark.ml.feature import NGram
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from assaymill.llm import common, repeats
from assaymill.operators import features, linear, models


def test_a_slice_of_text_is_anchored_in_little_memory():
    """op10_repeats: the arrays of one slice, which each Python worker holds at once."""
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", dtype=np.uint8)
    text = letters[np.random.default_rng(0).integers(0, len(letters), 4096)].tobytes()
    texts = [text] * 2048
    begin, end = next(repeats.slices(np.array([len(t) for t in texts])))
    tracemalloc.start()
    text, start, count, anchor, content = repeats.runs(texts[begin:end])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count.sum() == (end - begin) * (4096 - repeats.LENGTH + 1)
    assert peak < 96 << 20


def sparse_rows(spark, n: int = 400, width: int = 600):
    """Rows of few features, of which the first ones tell the classes apart, more of class 1."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(n):
        label = float(rng.random() < 0.7)
        mine = np.unique(np.append(rng.integers(40, width, 8), rng.integers(0, 20, 2) + (20 if label else 0)))
        values = rng.random(len(mine)) + 0.2
        rows.append((Vectors.sparse(width, mine.tolist(), (values / np.linalg.norm(values)).tolist()), label))
    return spark.createDataFrame(rows, ["features", "label"])


def test_screened_fit_is_the_whole_fit_and_sends_no_wide_gradient(spark, monkeypatch):
    """l1_select, default_training: features of weight zero are not brought to the driver on each pass."""
    blocks = linear.sparse_blocks(sparse_rows(spark))
    specs = [linear.Spec("squared_hinge", l1=1 / 400, target=t, penalised=True) for t in (1.0, 0.0)]
    whole = linear.fit_many(blocks, specs, 1e-5)
    monkeypatch.setattr(linear, "DENSE", 0)
    monkeypatch.setattr(linear, "JOIN", 48)
    evaluate, widths = linear.evaluate, []
    monkeypatch.setattr(linear, "evaluate", lambda blocks, *rest: (widths.append(blocks.width), evaluate(blocks, *rest))[1])
    kept, found = linear.fit_sparse(blocks, specs, 1e-5)
    assert max(widths) < blocks.width / 2
    for a, b in zip(whole, found):
        wide = np.zeros(blocks.width + 1)
        wide[kept], wide[-1] = b[:-1], b[-1]
        # Weights of up to 3, of fits that end where no step lowers the objective noticeably.
        assert np.abs(a - wide).max() < 0.02
        assert (np.flatnonzero(np.abs(a) > 0.02) == np.flatnonzero(np.abs(wide) > 0.02)).all()


def test_screened_fit_starts_from_the_intercept(spark, monkeypatch):
    monkeypatch.setattr(linear, "DENSE", 0)
    blocks = linear.sparse_blocks(sparse_rows(spark, 40))
    kept, (point,) = linear.fit_sparse(blocks, [linear.Spec("squared_hinge", l1=0.9, target=1.0, penalised=False)], 1e-6)
    assert len(kept) == 0 and point[0] > 0


def test_words_are_not_joined_to_runs_of_one():
    assert not [s for s in features.token_stages("text", [], (1, 1)) if isinstance(s, NGram)]
    assert [s.getN() for s in features.token_stages("text", [], (1, 3)) if isinstance(s, NGram)] == [2, 3]


def test_bench_side_by_side_gives_the_same_scores(spark):
    rows = sparse_rows(spark, 80, 60)
    chosen = {"svc": models.linear_svc(), "centroid": models.nearest_centroid, "bayes": models.naive_bayes("bernoulli")}
    alone, together = ([r[:4] for r in models.bench(rows, rows, chosen, n).collect()] for n in (1, 3))
    assert alone == together and [r[0] for r in alone] == list(chosen)


def test_screened_fit_ends_no_farther_from_the_least_than_the_whole_fit(spark, monkeypatch):
    rows, spec, tol = sparse_rows(spark), linear.Spec("squared_hinge", l1=1 / 400, target=1.0, penalised=True), 1e-2
    blocks = linear.sparse_blocks(rows)
    monkeypatch.setattr(linear, "DENSE", 0)
    monkeypatch.setattr(linear, "JOIN", 48)
    kept, (point,) = linear.fit_sparse(blocks, [spec], tol)
    wide = np.zeros(blocks.width + 1)
    wide[kept], wide[-1] = point[:-1], point[-1]

    def left(w):
        g = linear.evaluate(blocks, [spec], [w])[0][1]
        return np.where(w != 0, np.abs(g + spec.l1 * np.sign(w)), np.maximum(np.abs(g) - spec.l1, 0)).sum()

    assert left(wide) <= tol * left(np.zeros(len(wide)))


def test_shuffle_files_go_when_the_rows_are_written(spark):
    """op10_repeats: the runs are not on disk while the windows are."""
    before = spark.conf.get(common.CLEANUP, None)
    spark.conf.set(common.CLEANUP, "false")
    rows = common.written_alone(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "alone")
    assert spark.conf.get(common.CLEANUP) == "false" and rows.count() == 7
    spark.conf.unset(common.CLEANUP) if before is None else spark.conf.set(common.CLEANUP, before)
