"""Exact duplicates by content-defined chunk recipes.

A text without its white space is cut into chunks where a rolling hash of the last
32 bytes says so, so that equal texts are cut alike. Each distinct chunk crosses the
network once, to make sure that its identifier stands for one content only. Texts are
then compared by their ordered lists of identifiers, which are short.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from assaymill.llm.common import SPACE, plain, written

WINDOW = 32
LEAST, AVERAGE_BITS, MOST = 2048, 13, 65536


def gear() -> np.ndarray:
    """A 32-bit value for each byte, from a fixed rule."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], dtype=np.uint32)


def rolling(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each byte, sum of table[b_(i-j)] * 2^j over the last 32 bytes, modulo 2^32."""
    h = table[data]
    step = 1
    while step < WINDOW:
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step)
        h = h + shifted
        step *= 2
    return h


def cut_points(data: bytes, table: np.ndarray) -> list[int]:
    """Ends of the chunks: at a hash of ``AVERAGE_BITS`` high zeros, ``LEAST`` to ``MOST`` bytes after the last."""
    n = len(data)
    if n <= LEAST:
        return [n]
    h = rolling(np.frombuffer(data, dtype=np.uint8), table)
    wanted = np.flatnonzero(h >> np.uint32(32 - AVERAGE_BITS) == 0) + 1
    ends, start = [], 0
    while n - start > LEAST:
        at = np.searchsorted(wanted, start + LEAST)
        end = int(wanted[at]) if at < len(wanted) else n
        end = min(end, start + MOST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def _chunks(text: str, table: np.ndarray) -> tuple[bytes, list[tuple[int, bytes]]]:
    data = text.encode().translate(None, SPACE.encode())
    parts, start = [], 0
    for end in cut_points(data, table):
        part = data[start:end]
        parts.append((xxhash.xxh3_64_intdigest(part) - (1 << 63), part))
        start = end
    return data, parts


def distinct_chunks(docs: DataFrame) -> DataFrame:
    """(digest, content) once per distinct chunk of the texts."""

    def run(batches):
        table = gear()
        for batch in batches:
            seen: dict[bytes, int] = {}
            for text in batch.column("text"):
                for digest, part in _chunks(text.as_py(), table)[1]:
                    seen[part] = digest
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen.values()), pa.int64()), pa.array(list(seen), pa.binary())], ["digest", "content"]
            )

    return docs.select("text").mapInArrow(run, "digest bigint, content binary").distinct()


def recipes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, code points of the text, digest list and SHA-256 of the text without white space."""

    def run(batches):
        table = gear()
        for batch in batches:
            sizes, shas, lists = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                data, parts = _chunks(text, table)
                sizes.append(len(text))
                shas.append(hashlib.sha256(data).hexdigest())
                lists.append([digest for digest, _ in parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(shas), pa.array(lists, pa.list_(pa.int64()))],
                ["doc_id", "n_points", "text_sha256", "recipe"],
            )

    return docs.mapInArrow(run, "doc_id bigint, n_points bigint, text_sha256 string, recipe array<bigint>")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``.

    Texts are equal when they are without ASCII white space. Of equal ones, the row
    with the most code points, then the smallest doc_id stays. A null text is empty, so
    all empty and null texts are one group. Rows that repeat a doc_id and a text count
    as rows of the group and share its fate; a null doc_id loses every tie and gets a
    null keep_id only where nothing else can stay. An empty table gives no rows.
    """
    docs = plain(docs)
    lists = written(recipes(docs), "recipes")
    # A digest with two contents is no identifier; texts that hold one are told apart by SHA-256 as well.
    unsafe = distinct_chunks(docs).groupBy("digest").count().filter("count > 1").select("digest")
    doubtful = (
        lists.select("text_sha256", F.explode("recipe").alias("digest"))
        .join(unsafe, "digest", "left_semi")
        .select("text_sha256", F.lit(True).alias("doubtful"))
        .distinct()
    )
    # Equal recipes are summed up before they meet; the row count of a group never matters.
    keyed = lists.join(doubtful, "text_sha256", "left").withColumn(
        "key", F.struct("recipe", F.when(F.col("doubtful"), F.col("text_sha256")).alias("more"))
    )
    best = keyed.groupBy("key").agg(
        F.max(F.struct("n_points", (-F.col("doc_id")).alias("rank"))).alias("best"), F.count("*").alias("group_size")
    )
    best = best.select("key", (-F.col("best.rank")).alias("keep_id"), "group_size")
    return keyed.join(best, "key").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    gone = exact_groups(docs).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
