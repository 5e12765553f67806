"""Later copies of long byte strings, by longest-previous-factor arrays over anchored suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document
with a smaller doc_id. In the suffix order of all texts, suffixes that share their first
``LENGTH`` bytes stand together, and the previous and next one of a smaller document
give a suffix its longest earlier match. Such an order over every position would move
each text fifty times, so suffixes are gathered by anchors: a window of ``LENGTH`` bytes
is anchored at its least 16-byte gram, which equal windows share. Windows in a row with
one anchor are one run.

1. Runs are sorted by anchor and content, then document. A run with an equal one in an
   earlier document goes whole. Where an anchor has runs of different content, matches
   begin or end nearby, and the runs' windows are looked at one by one.
2. Those windows, as suffixes cut after ``LENGTH`` bytes, are sorted by content, then
   document: the longest previous factor of one reaches ``LENGTH`` if a smaller document
   stands before it among its equals. The bytes of a run travel to the bucket of its
   anchor, where its windows are made; the windows of an anchor of more than ``HEAVY``
   runs travel by their own content instead, in up to ``ROUNDS`` by anchor.

Runs travel packed, many to a row, keyed by a bucket of their hash; buckets are as many
as keep one to about ``BUCKET`` bytes of text. Equal runs of one batch are settled there
and travel once, so a passage of very many documents makes a row part per batch and not
per document. What is settled is a row for each run, so that no step makes a row for
every two buckets. Equality is that of hashes of 96 bits and more.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from assaymill.llm.common import plain, written_alone

LENGTH, GRAM = 50, 16
BUCKET = 1 << 22
#: Bytes of text worked on at once, and settled together before they travel; single windows settled together.
SLICE, GROUP, WINDOWS = 1 << 19, 1 << 23, 1 << 19
#: Runs of one anchor that are looked at in one bucket. Windows of anchors with more go by content, in so many
#: rounds by anchor at most, as all of them at once might not fit the disk.
HEAVY, ROUNDS = 1 << 16, 4

U = np.uint64
_OFFSETS = [*range(0, LENGTH - 7, 8), LENGTH - 8]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def eights(data: np.ndarray) -> np.ndarray:
    """For each position, its eight bytes as one number; zeros follow the end."""
    x = data.astype(U)
    for step in (1, 2, 4):
        y = x.copy()
        y[:-step] |= x[step:] << U(8 * step)
        x = y
    return x


def window_hash(x: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the ``LENGTH`` bytes that begin at each position of ``at``."""
    h = np.full(len(at), seed, dtype=U)
    for offset in _OFFSETS:
        h = mix((h ^ x[at + offset]) + U(0x9E3779B97F4A7C15))
    return h


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Anchored runs of windows: text number, start, windows, anchor hash and content hash of each."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.array([], dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(U), none.astype(U)
    sizes = np.array([len(t) for t in texts])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    x = eights(data)
    grams = len(data) - GRAM + 1
    g = mix(x[:grams] ^ mix(x[8 : 8 + grams] + U(0x9E3779B97F4A7C15)))
    low = (g & U(0xFFFFFFFF00000000)) | np.arange(grams, dtype=U)
    span = 1
    reach = LENGTH - GRAM + 1
    while span * 2 <= reach:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: len(low) - (reach - span)], low[reach - span :]) if reach > span else low
    inside = np.flatnonzero(owner[: len(data) - LENGTH + 1] == owner[LENGTH - 1 :])
    if not len(inside):
        return none, none, none, none.astype(U), none.astype(U)
    anchor = (low[inside] & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(first, len(inside)))
    start = inside[first]
    content = mix(window_hash(x, start, 1) ^ mix(window_hash(x, start + count - 1, 2) + count.astype(U)))
    text = owner[start].astype(np.int64)
    return text, start - begins[text], count, g[anchor[first]], content


def firsts(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order by ``keys`` then ``doc``: the order, where each block of equal keys begins, and each one's smallest doc."""
    order = np.lexsort((doc, *keys[::-1]))
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = False
        for key in keys:
            sorted_key = key[order]
            new[1:] |= sorted_key[1:] != sorted_key[:-1]
    block = np.cumsum(new) - 1
    return order, block, doc[order][np.flatnonzero(new)][block] if len(order) else doc


def merged(row: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one text that follow on each other as one."""
    order = np.lexsort((start, row))
    row, start, count = row[order], start[order], count[order]
    if not len(row):
        return row, start, count
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + count[:-1])])
    at = np.flatnonzero(new)
    return row[at], start[at], np.add.reduceat(count, at)


#: A packed table: bytes of each column. ``kind`` 1: windows that go; 0: windows to be looked at.
PACKED = "bucket bigint, kind int, h binary, c binary, doc binary, row binary, n binary, start binary, size binary"
NAMES = ["bucket", "kind", "h", "c", "doc", "row", "n", "start", "size"]


def pack(bucket: np.ndarray, kind: int, h, c, doc, row, start, count) -> list[tuple]:
    """A packed row for each bucket; documents are written once with their number of entries, starts as differences."""
    out = []
    order = np.lexsort((start, row, doc, bucket))
    bucket, h, c, doc, row, start, count = (v[order] for v in (bucket, h, c, doc, row, start, count))
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    for a, b in zip(edges, [*edges[1:], len(bucket)]):
        d, r = doc[a:b], row[a:b]
        at = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (r[1:] != r[:-1])]))
        out.append((
            int(bucket[a]), kind, h[a:b].astype(np.uint32).tobytes(), c[a:b].tobytes(), d[at].tobytes(), r[at].tobytes(),
            np.diff(np.append(at, b - a)).astype(np.uint32).tobytes(), np.diff(start[a:b], prepend=0).astype(np.uint32).tobytes(),
            count[a:b].astype(np.uint32).tobytes(),
        ))
    return out


def unpack(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """h, c, doc, row, start, size of all packed rows."""

    def column(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(rows[name]), dtype=kind)

    n = column("n", np.uint32)
    return (
        column("h", np.uint32), column("c", U), np.repeat(column("doc", np.int64), n), np.repeat(column("row", np.int64), n),
        np.concatenate([np.cumsum(np.frombuffer(b, dtype=np.uint32), dtype=np.uint32) for b in rows["start"]]).astype(np.int64),
        column("size", np.uint32).astype(np.int64),
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=NAMES)


def passing(kind: int, h: np.ndarray, row: np.ndarray, start: np.ndarray, count: np.ndarray, buckets: int) -> list[tuple]:
    """Runs that pass a reducer by, as one packed row; a bucket below zero marks them."""
    if kind:
        row, start, count = merged(row, start, count)
        h = np.zeros(len(row), dtype=np.uint32)
    bucket = np.full(len(row), -1 - int(row[0]) % buckets if len(row) else 0, dtype=np.int64)
    return pack(bucket, kind, h, np.zeros(len(row), dtype=U), row, row, start, count)


#: Runs that are settled, one to a row, for the bucket of their text; ``kind`` as above.
SPANS = "to bigint, kind int, h bigint, row bigint, start bigint, n bigint"


def spans(kind: int, h: np.ndarray, row: np.ndarray, start: np.ndarray, count: np.ndarray, buckets: int) -> pd.DataFrame:
    if kind:
        row, start, count = merged(row, start, count)
        h = np.zeros(len(row), dtype=np.int64)
    return pd.DataFrame({
        "to": np.mod(row, buckets), "kind": np.full(len(row), kind, dtype=np.int32), "h": h.astype(np.int64), "row": row, "start": start, "n": count,
    })


def passed(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Packed runs that passed a reducer by, one to a row."""
    parts = []
    for kind, part in rows.groupby("kind"):
        h, _, _, row, start, count = unpack(part)
        parts.append(spans(kind, h, row, start, count, buckets))
    return pd.concat(parts)


def by_row(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """row, start, n and h of ``SPANS``, in the order of their rows."""
    order = np.argsort(rows["row"].to_numpy(), kind="stable")
    return tuple(rows[c].to_numpy()[order] for c in ["row", "start", "n", "h"])


def slices(sizes: np.ndarray):
    """(first, last) of stretches of texts of about ``SLICE`` bytes."""
    begin, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size >= SLICE:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def anchored(texts: DataFrame, buckets: int) -> DataFrame:
    """Packed runs of (doc_id, row, text), about ``GROUP`` bytes of text at a time.

    An equal run in a smaller document of the group settles a run here. An anchor with
    different runs in the group is known to be shared: its runs pass the reducer by, and
    one of them goes there to tell the other groups.
    """

    def run(batches):
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            parts, held = [], 0
            for a, b in slices(sizes):
                found = runs([t.encode() for t in batch.column("text").slice(a, b - a).to_pylist()])
                parts.append((found[0] + a, *found[1:]))
                held += int(sizes[a:b].sum())
                if held >= GROUP:
                    yield settled(batch, parts)
                    parts, held = [], 0
            if parts:
                yield settled(batch, parts)

    def settled(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
        ids, rows = batch.column("doc_id").to_numpy(), batch.column("row").to_numpy()
        text, start, count, h, c = (np.concatenate(v) for v in zip(*parts))
        doc, row = ids[text], rows[text]
        order, _, least = firsts([h, c], doc)
        gone = doc[order] > least
        at = order[gone]
        out = passing(1, h[at], row[at], start[at], count[at], buckets)
        at = order[~gone]
        doc, row, start, count, h, c = (v[at] for v in (doc, row, start, count, h, c))
        # In anchor order: does the anchor have runs of two documents here?
        new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.array([], dtype=bool)
        begin = np.flatnonzero(new)
        shared = np.zeros(len(h), dtype=bool)
        if len(h):
            block = np.cumsum(new) - 1
            shared = (np.minimum.reduceat(doc, begin) != np.maximum.reduceat(doc, begin))[block]
        s = shared
        out += passing(0, h[s] & U(0xFFFFFFFF), row[s], start[s], count[s], buckets)
        told = np.where(shared, U(0), c)  # no run has content 0 but by a chance of 2^-64, which only costs a look
        send = ~shared | new
        to = ((h >> U(32)) % U(buckets)).astype(np.int64)[send]
        out += pack(to, 0, (h & U(0xFFFFFFFF))[send], told[send], doc[send], row[send], start[send], count[send])
        return pa.RecordBatch.from_pandas(_frame(out).astype({"bucket": "int64", "kind": "int32"}), schema=_SCHEMA, preserve_index=False)

    return texts.select("doc_id", "row", "text").mapInArrow(run, PACKED)


_SCHEMA = pa.schema([
    ("bucket", pa.int64()), ("kind", pa.int32()), *[(n, pa.binary()) for n in ["h", "c", "doc", "row", "n", "start", "size"]],
])


def settle_runs(packed: DataFrame, buckets: int) -> DataFrame:
    """``SPANS`` of windows that go and of windows to be looked at."""

    def settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            return passed(rows, buckets)
        h, c, doc, row, start, count = unpack(rows)
        order, _, least = firsts([h, c], doc)
        h, c, doc, row, start, count = (v[order] for v in (h, c, doc, row, start, count))
        gone = (doc > least) & (c != 0)
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        block = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(h))))
        # Content 0 stands for runs looked at anyway; with it or with another content the anchor is shared.
        several = (np.minimum.reduceat(c, begin) != np.maximum.reduceat(c, begin))[block]
        look = several & ~gone & (c != 0)
        return pd.concat([spans(kind, h[v], row[v], start[v], count[v], buckets) for kind, v in ((1, gone), (0, look))])

    return packed.groupBy("bucket").applyInPandas(settle, SPANS)


def joined(row: np.ndarray, start: np.ndarray, count: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs that follow on each other under one anchor hash as one: in periodic text the anchor moves with each window."""
    order = np.lexsort((start, row))
    order = order[np.concatenate([[True], (np.diff(row[order]) != 0) | (np.diff(start[order]) != 0)])[: len(order)]]
    row, start, count, h = (v[order] for v in (row, start, count, h))
    if not len(row):
        return row, start, count, h
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1]) | (start[1:] != start[:-1] + count[:-1])])
    at = np.flatnonzero(new)
    return row[at], start[at], np.add.reduceat(count, at), h[at]


#: Bytes of runs to be looked at, for the bucket of their anchor.
PIECES = "bucket bigint, h bigint, doc bigint, row bigint, start bigint, piece binary"


def pieces(texts: DataFrame, replies: DataFrame, buckets: int) -> DataFrame:
    """The bytes under the windows of each run to be looked at."""

    def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
        row, start, count, h = joined(*(rows.column(c).to_numpy() for c in ["row", "start", "n", "h"]))
        size = count + LENGTH - 1
        large = zstandard.ZstdDecompressor()
        data, at, docs, seen = [], [], [], set()
        for doc, address, text in zip(*(texts.column(c).to_pylist() for c in ["doc_id", "row", "data"])):
            a, b = np.searchsorted(row, address), np.searchsorted(row, address, side="right")
            if a == b or address in seen:
                continue
            seen.add(address)
            n = size[a:b]
            data.append(np.frombuffer(large.decompress(text), dtype=np.uint8)[np.repeat(start[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
            at.append(np.arange(a, b))
            docs.append(np.full(b - a, doc))
        at = np.concatenate([np.array([], dtype=np.int64), *at])
        ends = np.concatenate([[0], np.cumsum(size[at])]).astype(np.int32)
        found = pa.py_buffer(np.concatenate([np.array([], dtype=np.uint8), *data]).tobytes())
        return pa.table({
            "bucket": h[at] % buckets, "h": h[at], "doc": np.concatenate([np.array([], dtype=np.int64), *docs]), "row": row[at],
            "start": start[at], "piece": pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.tobytes()), found]),
        })

    return texts.groupBy("to").cogroup(replies.groupBy("to")).applyInArrow(run, PIECES)


def settle_pieces(found: DataFrame, buckets: int) -> DataFrame:
    """``SPANS`` of the windows of ``PIECES`` whose longest previous factor reaches ``LENGTH``."""

    def windows(piece: pa.Array) -> tuple[np.ndarray, ...]:
        """Hash of each window, its piece and its place there, ``SLICE`` bytes at a time."""
        parts = []
        for a, b in slices(pc.binary_length(piece).to_numpy(zero_copy_only=False)):
            texts = piece.slice(a, b - a).to_pylist()
            size = np.array([len(t) for t in texts])
            n = size - (LENGTH - 1)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(np.cumsum(size) - size, n) + place
            parts.append((window_hash(eights(np.frombuffer(b"".join(texts), dtype=np.uint8)), at, 3), np.repeat(np.arange(a, b), n), place))
        return tuple(np.concatenate(v) for v in zip(*parts))

    def settle(table: pa.Table) -> pa.Table:
        h, doc, row, start = (table.column(c).to_numpy() for c in ["h", "doc", "row", "start"])
        w, of, place = windows(table.column("piece").cast(pa.large_binary()).combine_chunks())
        order, _, least = firsts([w, h[of].astype(np.uint32)], doc[of])
        at = order[doc[of[order]] > least]
        gone = spans(1, h[:0], row[of[at]], start[of[at]] + place[at], np.ones(len(at), dtype=np.int64), buckets)
        return pa.Table.from_pandas(gone, preserve_index=False)

    return found.groupBy("bucket").applyInArrow(settle, SPANS)


def window_bucket(content: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of single windows, from the hash of their own ``LENGTH`` bytes."""
    return ((content >> U(32)) % U(buckets)).astype(np.int64)


def looked_at(texts: DataFrame, replies: DataFrame, buckets: int, turn: int = 0, rounds: int = 1) -> DataFrame:
    """Packed windows of runs to be looked at, by the hash of their content, with their anchor.

    Of ``rounds`` by anchor, only those of one ``turn``: equal windows share their anchor,
    and windows that follow on each other mostly do.
    """

    def look(texts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["kind"] == 0]
        if not len(rows) or not len(texts):
            return _frame([])
        row, start, count, h = by_row(rows[rows["h"] % rounds == turn])
        out, parts, held = [], [], 0
        large = zstandard.ZstdDecompressor()
        for doc, address, data in zip(*(texts.drop_duplicates("row")[c] for c in ["doc_id", "row", "data"])):
            a, b = np.searchsorted(row, address), np.searchsorted(row, address, side="right")
            if a == b:
                continue
            x = eights(np.frombuffer(large.decompress(data), dtype=np.uint8))
            n = count[a:b]
            at, first = np.unique(np.repeat(start[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum()), return_index=True)
            # A document's ids are written once for all of its windows until these are settled.
            parts.append((window_hash(x, at, 3), np.repeat(h[a:b], n)[first], at.astype(np.uint32), doc, address))
            held += len(at)
            if held >= WINDOWS:
                out += settled(parts)
                parts, held = [], 0
        return _frame(out + settled(parts) if parts else out)

    def settled(parts: list[tuple]) -> list[tuple]:
        w, h, at = (np.concatenate([p[k] for p in parts]) for k in range(3))
        doc, row = (np.repeat(np.array([p[k] for p in parts], dtype=np.int64), [len(p[0]) for p in parts]) for k in (3, 4))
        parts.clear()
        order, _, least = firsts([w, h], doc)
        gone = doc[order] > least
        done = order[gone]
        out = passing(1, h[done], row[done], at[done].astype(np.int64), np.ones(len(done), dtype=np.int64), buckets)
        kept = order[~gone]
        # By content and not by anchor: equal windows meet, and an anchor of many different ones spreads.
        return out + pack(window_bucket(w[kept], buckets), 0, h[kept], w[kept], doc[kept], row[kept], at[kept], np.ones(len(kept), dtype=np.int64))

    return texts.groupBy("to").cogroup(replies.groupBy("to")).applyInPandas(look, PACKED)


def settle_windows(packed: DataFrame, buckets: int) -> DataFrame:
    """``SPANS`` of packed windows whose longest previous factor reaches ``LENGTH``."""

    def settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            return passed(rows, buckets)
        h, w, doc, row, start, count = unpack(rows)
        order, _, least = firsts([w, h], doc)
        at = order[doc[order] > least]
        return spans(1, h[:0], row[at], start[at], count[at], buckets)

    return packed.groupBy("bucket").applyInPandas(settle, SPANS)


def compressed(rows: DataFrame) -> DataFrame:
    """(doc_id, row, data): the bytes of the texts, compressed, as two steps move them."""

    def run(batches):
        small = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data = pa.array([small.compress(t.as_py().encode()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), data], ["doc_id", "row", "data"])

    return rows.select("doc_id", "row", "text").mapInArrow(run, "doc_id bigint, row bigint, data binary")


def without(text: bytes, start: np.ndarray, count: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes that stay, the number of those that go, and of their maximal runs, for windows that go."""
    change = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + count + LENGTH - 1, -1)
    covered = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8)])) == 1)
    return np.frombuffer(text, dtype=np.uint8)[~covered].tobytes(), int(covered.sum()), len(edges)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary: the bytes that stay) for each row of ``docs``.

    A null or empty text has no bytes. Rows that repeat a doc_id are one document: they
    remove nothing from one another, and each loses what smaller documents hold. Rows
    without a doc_id are neither searched nor changed. An empty table gives no rows.
    """
    every = plain(docs)
    rows = every.filter("doc_id is not null").withColumn("row", F.xxhash64("doc_id", "text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET + 1)
    replies = written_alone(settle_runs(anchored(rows, buckets), buckets), "replies")
    texts = compressed(rows).withColumn("to", F.pmod("row", F.lit(buckets)))
    look = replies.filter("kind = 0")
    counts = look.groupBy("h").count().filter(F.col("count") > HEAVY).select("h")
    many = [r["h"] for r in written_alone(counts, "many").collect()]
    # Written before the texts are dealt out again, so that these and the windows are not on disk twice.
    goes = replies.filter("kind = 1").unionByName(
        written_alone(settle_pieces(pieces(texts, look.filter(~F.col("h").isin(many)), buckets), buckets), "found"))
    rounds = min(ROUNDS, len(many))
    for turn in range(rounds):
        looked = looked_at(texts, look.filter(F.col("h").isin(many)), buckets, turn, rounds)
        goes = goes.unionByName(written_alone(settle_windows(looked, buckets), "found"))

    def apply(texts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        row, start, count, _ = by_row(rows)
        out = []
        large = zstandard.ZstdDecompressor()
        for doc_id, address, data in zip(texts["doc_id"], texts["row"], texts["data"]):
            data = large.decompress(data)
            a, b = np.searchsorted(row, address), np.searchsorted(row, address, side="right")
            kept, removed, spans = without(data, start[a:b], count[a:b]) if b > a else (data, 0, 0)
            out.append((doc_id, len(data), removed, spans, kept))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    done = texts.groupBy("to").cogroup(goes.groupBy("to")).applyInPandas(apply, schema)
    loose = every.filter("doc_id is null").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.encode("text", "utf-8").alias("kept"),
    )
    return done.unionByName(loose)
