"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for each piece of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, found by the forward
algorithm; a text's is the product over its words. The piece probabilities come from
expectation-maximisation over the words of a bounded labelled sample.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from assaymill.llm.common import plain, written
from assaymill.llm.pieces import Pieces

LETTERS = re.compile(r"[^\W\d_]+")
#: Labelled documents of each language, rounds of estimation, weight given to each piece beforehand.
LABELLED, ROUNDS, PRIOR = 1500, 3, 0.05
#: Words of more bytes are scored one by one with rescaling, and learned from in logarithms, about ``CELLS`` bytes at once.
SHORT, CELLS = 40, 50_000
KNOWN = 400_000
#: Rows worked on at once.
ROWS = 256


def words(text: str) -> list[str]:
    """Runs of letters; the pattern lets numbers such as one half pass, which part words like any other character."""
    found = LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for f in found for w in "".join(c if c.isalpha() else " " for c in f).split()]


def held_out():
    """Documents never learned from: crc32 of doc_id as text is 1 modulo 3. A null doc_id counts as not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def summed(word: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, which stand together, and the sums of their rows."""
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return word[first], np.add.reduceat(values, first, axis=0)


def edge_table(found: list[list[int]]) -> np.ndarray:
    """(end, start, piece, word) of all edges, word by word."""
    flat = np.fromiter(chain.from_iterable(found), dtype=np.int64).reshape(-1, 3)
    return np.column_stack([flat, np.repeat(np.arange(len(found)), [len(e) // 3 for e in found])])


def forward(table: np.ndarray, size: int, probability: np.ndarray) -> np.ndarray:
    """Forward sums of ``size`` words of at most ``SHORT`` bytes: alpha[word, end, language]."""
    table = table[np.argsort(table[:, 0], kind="stable")]
    alpha = np.zeros((size, SHORT + 1, probability.shape[1]))
    alpha[:, 0] = 1.0
    ends = np.searchsorted(table[:, 0], np.arange(1, SHORT + 2))
    for end in range(1, SHORT + 1):
        part = table[ends[end - 1] : ends[end]]
        if len(part):
            word, sums = summed(part[:, 3], alpha[part[:, 3], part[:, 1]] * probability[part[:, 2]])
            alpha[word, end] = sums
    return alpha


def long_word(edges: list[int], size: int, probability: np.ndarray) -> np.ndarray:
    """Log forward sum of one word of any length; sums are rescaled as they go along."""
    logs = np.zeros((size + 1, probability.shape[1]))
    by_end: dict[int, list] = {}
    for end, start, piece in zip(edges[::3], edges[1::3], edges[2::3]):
        by_end.setdefault(end, []).append((start, piece))
    for end in range(1, size + 1):
        terms = by_end[end]
        starts = np.array([s for s, _ in terms])
        base = logs[starts].max(axis=0)
        logs[end] = base + np.log((np.exp(logs[starts] - base) * probability[[p for _, p in terms]]).sum(axis=0))
    return logs[size]


def word_scores(found: list[str], pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Log probability of each word under each language."""
    out = np.zeros((len(found), probability.shape[1]))
    coded = [b" " + w.encode() for w in found]
    sizes = np.array([len(w) for w in coded])
    short = np.flatnonzero(sizes <= SHORT)
    for start in range(0, len(short), 4096):
        part = short[start : start + 4096]
        alpha = forward(edge_table([pieces.edges(coded[i]) for i in part]), len(part), probability)
        out[part] = np.log(alpha[np.arange(len(part)), sizes[part]])
    for i in np.flatnonzero(sizes > SHORT):
        out[i] = long_word(pieces.edges(coded[i]), int(sizes[i]), probability)
    return out


def log_sums(values: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, which stand together, and the logarithms of the sums of their rows."""
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return word[first], np.logaddexp.reduceat(values, first, axis=0)


def expected_long(coded: list[bytes], counts: np.ndarray, pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """As ``expected``, for words of any length: forward and backward sums are kept as logarithms."""
    table, sizes = edge_table([pieces.edges(w) for w in coded]), np.array([len(w) for w in coded])
    n, width = len(coded), int(sizes.max())
    logs = np.log(probability)
    alpha = np.full((n, width + 1, probability.shape[1]), -np.inf)
    beta = alpha.copy()
    alpha[:, 0] = 0.0
    beta[np.arange(n), sizes] = 0.0
    table = table[np.argsort(table[:, 0], kind="stable")]
    edges = np.searchsorted(table[:, 0], np.arange(width + 2))
    for end in range(1, width + 1):
        rows = table[edges[end] : edges[end + 1]]
        if len(rows):
            word, sums = log_sums(alpha[rows[:, 3], rows[:, 1]] + logs[rows[:, 2]], rows[:, 3])
            alpha[word, end] = sums
    table = table[np.lexsort((table[:, 3], table[:, 1]))]
    edges = np.searchsorted(table[:, 1], np.arange(width + 2))
    whole = alpha[np.arange(n), sizes]
    flows = np.zeros((len(table), probability.shape[1]))
    for begin in range(width - 1, -1, -1):
        a, b = edges[begin], edges[begin + 1]
        rows = table[a:b]
        if len(rows):
            flow = logs[rows[:, 2]] + beta[rows[:, 3], rows[:, 0]]
            flows[a:b] = np.exp(alpha[rows[:, 3], rows[:, 1]] + flow - whole[rows[:, 3]]) * counts[rows[:, 3]]
            word, sums = log_sums(flow, rows[:, 3])
            beta[word, begin] = sums
    return np.column_stack([np.bincount(table[:, 2], weights=flows[:, k], minlength=len(probability)) for k in range(flows.shape[1])])


def expected(found: list[str], counts: np.ndarray, pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Expected number of each piece, over all segmentations of each word.

    ``counts``: how often each language has each word.
    """
    total = np.zeros_like(probability)
    coded = [b" " + w.encode() for w in found]
    part: list[int] = []
    for i in sorted((i for i, w in enumerate(coded) if len(w) > SHORT), key=lambda i: len(coded[i])):
        if part and (len(part) + 1) * len(coded[i]) > CELLS:
            total += expected_long([coded[j] for j in part], counts[part], pieces, probability)
            part = []
        part.append(i)
    if part:
        total += expected_long([coded[j] for j in part], counts[part], pieces, probability)
    keep = [i for i, w in enumerate(coded) if len(w) <= SHORT]
    for start in range(0, len(keep), 4096):
        part = keep[start : start + 4096]
        sizes = np.array([len(coded[i]) for i in part])
        table = edge_table([pieces.edges(coded[i]) for i in part])
        alpha = forward(table, len(part), probability)
        table = table[np.argsort(table[:, 1], kind="stable")]
        beta = np.zeros_like(alpha)
        beta[np.arange(len(part)), sizes] = counts[part] / alpha[np.arange(len(part)), sizes]
        begins = np.searchsorted(table[:, 1], np.arange(SHORT + 1))
        flows = np.zeros((len(table), probability.shape[1]))
        for begin in range(SHORT - 1, -1, -1):
            rows = table[begins[begin] : begins[begin + 1]]
            if len(rows):
                flow = probability[rows[:, 2]] * beta[rows[:, 3], rows[:, 0]]
                flows[begins[begin] : begins[begin + 1]] = alpha[rows[:, 3], rows[:, 1]] * flow
                word, sums = summed(rows[:, 3], flow)
                beta[word, begin] = sums
        for k in range(total.shape[1]):
            total[:, k] += np.bincount(table[:, 2], weights=flows[:, k], minlength=len(total))
    return total


def labelled_words(docs: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(lang, word, n) over at most ``labelled`` documents of each language, those with the smallest hash of doc_id."""
    usable = docs.filter("lang is not null and doc_id is not null and text is not null").filter(~held_out())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= labelled)
    chosen = chosen.select(F.col("doc_id").alias("_id")).distinct()
    known = usable.join(chosen, F.col("doc_id") == F.col("_id"), "left_semi").select("lang", "text")

    def count(batches):
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            sums = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                sums.update((lang, w) for w in words(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string()), pa.array(list(sums.values()), pa.int64())],
                ["lang", "word", "n"],
            )

    each = known.mapInArrow(count, "lang string, word string, n bigint")
    return each.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, vocabulary: list[bytes], labelled: int = LABELLED) -> tuple[list[str], np.ndarray]:
    """Languages and the probability of each piece under each: as many rows as the vocabulary has pieces."""
    counts = written(labelled_words(docs, labelled), "words")
    languages = [r["lang"] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    probability = np.full((len(vocabulary), len(languages)), 1.0 / len(vocabulary))
    if not languages:
        return languages, probability
    for _ in range(ROUNDS):
        now = probability

        def sums(batches):
            pieces = Pieces(vocabulary)
            total = np.zeros_like(now)
            for batch in batches:
                found = batch.column("word").to_pylist()
                weights = np.zeros((len(found), len(languages)))
                weights[np.arange(len(found)), [languages.index(x) for x in batch.column("lang").to_pylist()]] = batch.column("n").to_numpy()
                total += expected(found, weights, pieces, now)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], ["piece", "lang", "n"]
            )

        summed = counts.mapInArrow(sums, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        total = np.full(probability.shape, PRIOR)
        total[summed["piece"].to_numpy(), summed["lang"].to_numpy()] += summed["n"].to_numpy()
        probability = total / total.sum(axis=0)
    return languages, probability


def identify(docs: DataFrame, vocabulary: list[bytes], labelled: int = LABELLED) -> DataFrame:
    """doc_id, held_out, lang_pred and score for each row of ``docs``.

    score is the probability of lang_pred if all learned languages are equally likely.
    A text that is null or has no letter is ``und`` with score 0, as is every text if
    nothing can be learned. An empty table gives no rows. Rows that repeat a doc_id are judged one by one. Words are
    runs of letters in lower case; texts are read whole.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    languages, probability = fit(docs, vocabulary, labelled)

    def judge(batches):
        pieces = Pieces(vocabulary)
        known: dict[str, int] = {}
        scores = np.zeros((0, len(languages)))
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            texts = [words(t or "") if languages else [] for t in batch.column("text").to_pylist()]
            if len(known) > KNOWN:
                known, scores = {}, scores[:0]
            new = list({w for text in texts for w in text if w not in known})
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new))))
                scores = np.concatenate([scores, word_scores(new, pieces, probability)])
            names, values = [], []
            for text in texts:
                if not text:
                    names.append("und")
                    values.append(0.0)
                    continue
                total = scores[[known[w] for w in text]].sum(axis=0)
                best = int(total.argmax())
                names.append(languages[best])
                values.append(float(1.0 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(values)], ["doc_id", "lang_pred", "score"])

    judged = docs.select("doc_id", "text").mapInArrow(judge, "doc_id bigint, lang_pred string, score double")
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
