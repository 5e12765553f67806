"""Byte-level BPE of whole texts, long unsplit ones by tree concatenation.

The vocabulary file is a parameter, in the format of the tokenizers library. Where a
space or newline follows another character the pre-tokenizer always splits, so texts
are encoded between such places and repeated words are looked up. A stretch without
such a place may be as long as the text. It is halved into leaves, the leaves are
encoded as rows of their own, and neighbours are joined: a window around the join is
encoded again and grows until it agrees with both sides.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from assaymill.llm.common import plain

LEAF = 16384
#: Tokens on either side of a window that must come out as before.
AGREE = 4
#: Rows worked on at once.
ROWS = 256
#: Words an encoder gathers before it forgets those not met since the last time.
KNOWN = 100_000

_SPLIT = re.compile(r"(?<=\S)(?=[ \n])")


def byte_table() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Encoder:
    """Encodes and decodes as the tokenizers library does, without truncation, padding or added tokens."""

    def __init__(self, vocabulary: str, leaf: int = LEAF):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf = leaf
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        chars = byte_table()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes: list[bytes] = [b""] * size
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = token.encode() if i in added else bytes(chars[c] for c in token)
        self.sizes = np.array([len(b) for b in self.bytes])

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; stretches beyond a leaf are joined here as well."""
        split = [_SPLIT.split(t) for t in texts]
        if len(self.known) > KNOWN:
            self.older, self.known = self.known, {"": b""}
        known, new = self.known, []
        for word in {w for words in split for w in words}.difference(known):
            before = self.older.get(word)
            if before is None:
                new.append(word)
            else:
                known[word] = before
        short = [w for w in new if len(w) <= self.leaf and w[0] in " \n" and not w[-1].isspace()]
        for start in range(0, len(short), 2048):
            self.learn(short[start : start + 2048])
        for word in new:
            if len(word) > self.leaf:
                known[word] = self.joined([self.plain(h) for h in self.halves(word)]).tobytes()
            elif word not in known:
                known[word] = self.plain(word).tobytes()
        return [np.frombuffer(b"".join([known[w] for w in words]), dtype=np.int32) for words in split]

    def learn(self, words: list[str]) -> None:
        """Ids of words that begin with a space or newline and end otherwise: such a word ends where the next begins, so all are one text."""
        ids = self.plain("".join(words))
        ends = np.cumsum(self.sizes[ids])
        last = np.searchsorted(ends, np.cumsum([len(w.encode()) for w in words])) + 1
        for word, a, b in zip(words, [0, *last[:-1]], last):
            self.known[word] = ids[a:b].tobytes()

    def halves(self, text: str) -> list[str]:
        """Leaves of ``text`` in order; no special token is cut."""
        if len(text) <= self.leaf:
            return [text]
        middle = len(text) // 2
        for token in self.special:
            at = text.rfind(token, max(0, middle - len(token) + 1), middle + len(token) - 1)
            if at >= 0 and at < middle < at + len(token):
                middle = at + len(token) if at + len(token) < len(text) else at
        return self.halves(text[:middle]) + self.halves(text[middle:]) if middle else [text]

    def decode_bytes(self, ids) -> bytes:
        table = self.bytes
        return b"".join([table[i] for i in ids])

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def joined(self, parts: list[np.ndarray]) -> np.ndarray:
        """Neighbours joined level by level."""
        while len(parts) > 1:
            pairs = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(pairs) * 2 :]
        return parts[0]

    def open_edge(self, ids: np.ndarray, at: int) -> bool:
        """Could the text be split otherwise next to this place if it began or ended here?

        So it could inside a character, and beside white space or an apostrophe, which
        the pre-tokenizer reads together with what follows.
        """
        if at in (0, len(ids)):
            return False
        if self.bytes[ids[at]][0] & 0xC0 == 0x80:
            return True
        before = self.decode_bytes(ids[max(0, at - 8) : at]).decode(errors="ignore")[-1:]
        after = self.decode_bytes(ids[at : at + 8]).decode(errors="ignore")[:1]
        return any(not c or c.isspace() or c == "'" for c in (before, after))

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the concatenated texts of ``left`` and ``right``.

        Tokens are those of the whole text if each neighbouring two are tokens of their
        own text, and no split depends on what lies beyond a window's end. Inside a side
        and inside the window that holds; it holds across the window's ends too when the
        window gives the same tokens there as the side does. A window of both whole sides
        is right in any case.
        """
        width = 4 * AGREE
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            while self.open_edge(left, a):
                a -= 1
            while self.open_edge(right, b):
                b += 1
            window = self.plain(self.decode(left[a:]) + self.decode(right[:b]))
            head = a == 0 or np.array_equal(window[:AGREE], left[a : a + AGREE])
            tail = b == len(right) or np.array_equal(window[-AGREE:], right[b - AGREE : b])
            if head and tail and (len(window) >= 2 * AGREE or a == 0 and b == len(right)):
                return np.concatenate([left[:a], window, right[b:]])
            width *= 2


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.array([], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def read_vocabulary(path: str) -> str:
    """The vocabulary file, read by the driver and sent along with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, leaf: int = LEAF, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) for each row of ``docs``: the ids of the whole text; with ``decoded`` also their text.

    A null or empty text has no ids; rows that repeat a doc_id each get theirs, and a
    null doc_id stays null.
    """
    vocabulary = read_vocabulary(path)
    rows = plain(docs)
    names = ["doc_id", "ids", "text"][: 2 + decoded]
    schema = ", ".join(["doc_id bigint", "ids array<int>", "text string"][: 2 + decoded])
    unsplit = (F.length("text") > leaf) & F.exists(F.split("text", "[ \n]"), lambda w: F.length(w) > leaf)

    def whole(batches):
        encoder = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                encoder = encoder or Encoder(vocabulary, leaf)
                part = batch.slice(start, ROWS)
                ids = encoder.encode_batch(part.column("text").to_pylist())
                columns = [part.column("doc_id"), _lists(ids)]
                if decoded:
                    columns.append(pa.array([encoder.decode(i.tolist()) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    def leaves(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(vocabulary, leaf)
            for doc_id, digest, copies, text in zip(*(batch.column(c).to_pylist() for c in ["doc_id", "digest", "copies", "text"])):
                out = []
                for stretch, word in enumerate(_SPLIT.split(text)):
                    if len(word) > leaf:
                        out += [(stretch, h) for h in encoder.halves(word)]
                    else:
                        out.append((stretch, word))
                # Short stretches in a row are one leaf.
                run = []
                for stretch, word in out:
                    if run and len(word) < leaf // 2 and len(run[-1][1]) < leaf // 2 and run[-1][0] != stretch:
                        run[-1] = (stretch, run[-1][1] + word)
                    else:
                        run.append((stretch, word))
                n = len(run)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id] * n, pa.int64()), pa.array([digest] * n), pa.array([copies] * n, pa.int64()),
                        pa.array(range(n), pa.int32()), pa.array([s for s, _ in run], pa.int32()), pa.array([w for _, w in run]),
                    ],
                    ["doc_id", "digest", "copies", "place", "stretch", "text"],
                )

    def encode_leaves(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(vocabulary, leaf)
            ids = encoder.encode_batch(batch.column("text").to_pylist())
            columns = [batch.column(c) for c in ["doc_id", "digest", "copies", "place", "stretch"]]
            yield pa.RecordBatch.from_arrays([*columns, _lists(ids)], ["doc_id", "digest", "copies", "place", "stretch", "ids"])

    def concatenated(rows: pd.DataFrame) -> pd.DataFrame:
        encoder = Encoder(vocabulary, leaf)
        rows = rows.sort_values("place")
        parts: list[list[np.ndarray]] = []
        last = None
        for stretch, ids in zip(rows["stretch"], rows["ids"]):
            if stretch != last:
                parts.append([])
            parts[-1].append(np.asarray(ids, dtype=np.int32))
            last = stretch
        ids = np.concatenate([encoder.joined(p) for p in parts])
        return pd.DataFrame({"doc_id": rows["doc_id"].iloc[:1].astype("Int64"), "copies": rows["copies"].iloc[:1], "ids": [ids]})

    kind = "doc_id bigint, digest string, copies bigint, place int, stretch int"
    long = (
        rows.filter(unsplit)
        .groupBy("doc_id", "text")
        .agg(F.count("*").alias("copies"))
        .withColumn("digest", F.sha2("text", 256))
        .mapInArrow(leaves, f"{kind}, text string")
        .repartition("digest", "doc_id", "place")
        .mapInArrow(encode_leaves, f"{kind}, ids array<int>")
        .groupBy("doc_id", "digest")
        .applyInPandas(concatenated, "doc_id bigint, copies bigint, ids array<int>")
        .selectExpr("doc_id", "explode(array_repeat(ids, cast(copies as int))) ids")
    )
    return rows.filter(~unsplit).mapInArrow(whole, schema).union(decode(long, path) if decoded else long)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """Adds ``text``, the decoded ``ids``, to (doc_id, ids)."""
    vocabulary = read_vocabulary(path)

    def run(batches):
        encoder = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                encoder = encoder or Encoder(vocabulary)
                part = batch.slice(start, ROWS)
                lists = part.column("ids")
                texts = [encoder.decode(ids.values.to_numpy(zero_copy_only=False).tolist()) for ids in lists]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")
