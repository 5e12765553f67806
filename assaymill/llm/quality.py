"""Quality rules with an isolation forest over their statistics.

Rule statistics are taken from every whole text. Random trees, each of ``SAMPLE`` rows as
the method has it, isolate the good labelled rows; a document that fewer splits isolate is
unlike them. Where a path counts as too short is calibrated on all good and poor rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assaymill.llm.common import plain, written
from assaymill.operators.ordering import numbered, running_total

SYMBOLS = set("#*$%&|<>")
_DROP = {c: None for c in map(ord, SYMBOLS)}
_WORD = re.compile("[^ \t\n\x0b\x0c\r]+")

#: Whole numbers that the contract names, then the shares the forest sees.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["symbol_share", "dup_line_share", "repeat_share", "letter_share"]

TREES, SAMPLE, LABELLED = 100, 256, 20000
FLOOR = 0.001
#: Rows worked on at once.
ROWS = 256


def repeat_words(words: list[str]) -> int:
    """Words in three-word windows that the text holds twice or more, the first included."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    hit = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def statistics(text: str) -> tuple:
    words = _WORD.findall(text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = len(text) - len(text.translate(_DROP))
    seen, duplicates, lines = set(), 0, 0
    for line in text.split("\n"):
        if _WORD.search(line):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    repeated = repeat_words(words)
    letters = sum(map(str.isalpha, text))
    shares = (symbols / max(len(text), 1), duplicates / max(lines, 1), repeated / max(n, 1), letters / max(chars, 1))
    return (n, chars, symbols, duplicates, repeated, *shares)


def _table(texts: list[str]) -> list[np.ndarray]:
    rows = np.array([statistics(t) for t in texts], dtype=np.float64).reshape(-1, len(COUNTS) + len(SHARES))
    return list(rows.T)


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the shares of each row of ``docs``."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                columns = _table(part.column("text").to_pylist())
                arrays = [pa.array(c.astype(np.int64)) for c in columns[: len(COUNTS)]] + [pa.array(c) for c in columns[len(COUNTS) :]]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], ["doc_id", *COUNTS, *SHARES])

    schema = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in COUNTS], *[f"{c} double" for c in SHARES]])
    return docs.mapInArrow(run, schema)


def failed_base():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(rows: np.ndarray, rng: np.random.Generator, depth: int) -> tuple:
    """A tree: (column, value, low side, high side), or the path length that a leaf adds."""
    spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
    if not depth or not len(spread):
        return (average_path(len(rows)),)
    column = int(rng.choice(spread))
    value = float(rng.uniform(rows[:, column].min(), rows[:, column].max()))
    low = rows[:, column] < value
    return column, value, grow(rows[low], rng, depth - 1), grow(rows[~low], rng, depth - 1)


def path_lengths(tree: tuple, rows: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows))

    def go(node, index, depth):
        if len(node) == 1:
            out[index] = depth + node[0]
        elif len(index):
            low = rows[index, node[0]] < node[1]
            go(node[2], index[low], depth + 1)
            go(node[3], index[~low], depth + 1)

    go(tree, np.arange(len(rows)), 0)
    return out


class Forest:
    """An isolation forest: ``score`` is 0.5 for ordinary rows and nears 1 for rows that few splits isolate.

    Shares are mostly near zero, so they are split on a logarithmic scale. ``drawn``: the
    places in ``rows`` of the rows of each tree, where they were drawn from more than ``rows``.
    """

    def __init__(self, rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 5, drawn: list[np.ndarray] | None = None):
        rows = np.log(rows + FLOOR)
        rng = np.random.default_rng(seed)
        size = min(sample, len(rows)) if drawn is None else len(drawn[0])
        depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
        self.scale = average_path(size) or 1.0
        draws = iter(drawn) if drawn is not None else (rng.permutation(len(rows))[:size] for _ in range(trees))
        self.trees = [grow(rows[at], rng, depth) for at in draws] if size else []

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(rows), 0.5)
        rows = np.log(rows + FLOOR)
        return 2.0 ** (-np.mean([path_lengths(t, rows) for t in self.trees], axis=0) / self.scale)


def calibrate(scores: np.ndarray, good: np.ndarray, spare: float) -> float:
    """The lowest score above which at most a share ``spare`` of the good rows and more bad than good rows lie.

    Without labelled rows of both kinds nothing is rejected.
    """
    if not good.any() or good.all():
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    ranked, kept = scores[order], good[order]
    lost, caught = np.cumsum(kept), np.cumsum(~kept)
    last = np.append(ranked[1:] != ranked[:-1], True)
    fine = last & (lost <= spare * good.sum()) & (caught > lost)
    if not fine.any():
        return float("inf")
    at = np.flatnonzero(fine)[-1]
    below = ranked[at + 1] if at + 1 < len(ranked) else ranked[at] - 1
    return float((ranked[at] + below) / 2)


def fit(stats: DataFrame, labels: DataFrame, labelled: int = LABELLED, spare: float = 0.005) -> tuple[Forest, float]:
    """Forest and threshold from all labelled rows; up to ``labelled`` of them on the driver, more in Spark.

    ``labels``: doc_id and quality, 1 for good rows. Rows without a quality are left out.
    """
    known = labels.filter("quality is not null").select(F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("good"))
    rows = stats.join(known, F.col("doc_id") == F.col("_id")).filter(~failed_base())
    rows = written(rows.select(F.xxhash64("doc_id", F.lit(3)).alias("hash"), "doc_id", "good", *SHARES), "labelled")
    count, n_good = rows.agg(F.count(F.lit(1)), F.count_if("good")).first()
    if count > labelled:
        forest = grown(rows.filter("good"), n_good)
        return forest, calibrated(rows, n_good, count, forest, spare)
    whole = rows.orderBy("hash", "doc_id", "good").select("good", *SHARES).toPandas()
    values = whole[SHARES].to_numpy(dtype=np.float64)
    good = whole["good"].to_numpy(dtype=bool)
    forest = Forest(values[good])
    return forest, calibrate(forest.score(values), good, spare)


def grown(good: DataFrame, count: int, seed: int = 5) -> Forest:
    """Forest whose trees draw their rows from all ``count`` rows of ``good``; only drawn rows are fetched."""
    rng = np.random.default_rng(seed)
    drawn = [rng.choice(count, min(SAMPLE, count), replace=False) for _ in range(TREES)]
    wanted = np.unique(np.concatenate(drawn))
    placed = numbered(good, [], [F.col(c) for c in ("hash", "doc_id", *SHARES)])
    asked = good.sparkSession.createDataFrame(pd.DataFrame({"rn": wanted + 1}))
    rows = placed.join(F.broadcast(asked), "rn").select("rn", *SHARES).toPandas().sort_values("rn")
    return Forest(rows[SHARES].to_numpy(dtype=np.float64), drawn=[np.searchsorted(wanted, at) for at in drawn])


def calibrated(rows: DataFrame, n_good: int, count: int, forest: Forest, spare: float) -> float:
    """As ``calibrate`` on the scores of ``rows``, with running counts over ranges of scores."""
    if n_good in (0, count):
        return float("inf")
    cells = rows.select("good", anomaly(forest).alias("score")).groupBy("score").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    ranked = cells
    for kind, above in (("good", "lost"), ("bad", "caught")):
        ranked = running_total(ranked, [], [F.desc("score")], kind, above).drop("_part", "_total")
    lost, caught = F.col("lost") + F.col("good"), F.col("caught") + F.col("bad")
    lowest = ranked.filter((lost <= spare * n_good) & (caught > lost)).agg(F.min("score")).first()[0]
    if lowest is None:
        return float("inf")
    below = cells.filter(F.col("score") < lowest).agg(F.max("score")).first()[0]
    return (lowest + (lowest - 1 if below is None else below)) / 2


def anomaly(forest: Forest):
    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])))

    return score(*SHARES)


def judged(stats: DataFrame, forest: Forest, threshold: float) -> DataFrame:
    scored = stats.withColumn("anomaly", anomaly(forest)).withColumn("base_failed", failed_base())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= threshold))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, the four counts, base_failed, kept, anomaly for each row of ``docs``.

    A null or empty text has no words and fails the base rules. Rows that repeat a doc_id
    are judged one by one, and rows with a null doc_id like any other; neither has a part
    in the fit unless ``labels`` names it. Without usable labels only the base rules reject.
    """
    stats = written(rule_statistics(plain(docs)), "statistics")
    forest, threshold = fit(stats, labels)
    return judged(stats, forest, threshold).select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules and the forest keep, judged in place: no text is moved."""
    forest, threshold = fit(written(rule_statistics(plain(docs)), "statistics"), labels)

    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        columns = _table(texts.tolist())
        words, repeated = columns[0], columns[4]
        base = (words < 50) | (100 * repeated > 50 * words)
        return pd.Series(~base & (forest.score(np.column_stack(columns[len(COUNTS) :])) <= threshold))

    return docs.filter(keep(F.coalesce(docs["text"], F.lit(""))))
