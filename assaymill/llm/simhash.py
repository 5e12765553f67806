"""Near duplicates by SimHash, with tables of distances to reference fingerprints.

Each fingerprint gets a table row: the Hamming distances of its four quarters to
``REFERENCES`` fixed reference fingerprints. Two fingerprints that differ in at most
two bits agree in two quarters at least, so their table rows are equal there and
differ by no more than two anywhere else. Rows meet where they are equal in two
quarters, pairs with a larger coordinate difference are discarded, and the survivors
are verified on the fingerprints themselves.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from assaymill.llm.common import plain, written
from assaymill.llm.components import components

REFERENCES = 12
NEAR = 2
#: A meeting of more rows than this makes no pairs; its members are linked through midpoints.
MEETING = 64

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str) -> int:
    """SimHash of the three-word shingles of a text, as an unsigned number."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    spaced = b" ".join(words)
    if len(words) <= 3:
        hashes = [xxhash.xxh64_intdigest(spaced, 42)]
    else:
        ends, at = [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        digest = xxhash.xxh64_intdigest
        hashes = [digest(spaced[a:b], 42) for a, b in zip([0, *[e + 1 for e in ends[:-3]]], ends[2:])]
    ones = np.zeros(64, dtype=np.int64)
    values = np.array(hashes, dtype=">u8")
    for start in range(0, len(values), 4096):
        block = values[start : start + 4096]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(values)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; fp is the fingerprint as a signed number."""

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id bigint, fp bigint")


def references() -> list[list[int]]:
    """``REFERENCES`` values of 16 bits for each quarter, from a fixed rule."""
    return [[xxhash.xxh32_intdigest(bytes([q, k]), 11) & 0xFFFF for k in range(REFERENCES)] for q in range(4)]


def quarter(fp: Column, q: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF))


def distance_table(fps: DataFrame) -> DataFrame:
    """Adds q0 to q3: the distances of each quarter to its references, an array of small numbers."""
    return fps.select(
        "fp",
        *[
            F.array(*[F.bit_count(quarter(F.col("fp"), q).bitwiseXOR(F.lit(r))).cast("tinyint") for r in row]).alias(f"q{q}")
            for q, row in enumerate(references())
        ],
    )


def meetings(table: DataFrame) -> DataFrame:
    """A row per fingerprint and pair of quarters: key of the equal coordinates, and the rest to be compared."""
    rows = []
    for n, (i, j) in enumerate(combinations(range(4), 2)):
        k, m = [q for q in range(4) if q not in (i, j)]
        rows.append(
            F.struct(
                F.lit(n).cast("tinyint").alias("slot"),
                F.xxhash64(F.lit(n), f"q{i}", f"q{j}").alias("key"),
                F.concat(f"q{k}", f"q{m}").alias("rest"),
            )
        )
    return table.select("fp", F.explode(F.array(*rows)).alias("x")).select("fp", "x.*")


def near_edges(fps: DataFrame) -> DataFrame:
    """(a, b): fingerprints linked to one another so that chains of links are those of all near pairs.

    ``fps``: distinct fingerprints. In a meeting of up to ``MEETING`` rows every near
    pair is a link. Elsewhere each fingerprint is written under itself and its 64
    neighbours; two of them within two bits share one of these midpoints, and at most
    65 rows share one, so the links grow with the members and not with their pairs.
    """
    met = meetings(distance_table(fps))
    sizes = met.groupBy("key").count().filter("count > 1")
    met = written(met.join(sizes, "key"), "meetings")
    small = met.filter(F.col("count") <= MEETING)
    left = small.select("key", F.col("fp").alias("a"), F.col("rest").alias("rest_a"))
    right = small.select("key", F.col("fp").alias("b"), F.col("rest").alias("rest_b"))
    pairs = (
        left.join(right, "key")
        .filter("a < b")
        .filter(f"forall(zip_with(rest_a, rest_b, (x, y) -> abs(x - y) <= {NEAR}), x -> x)")
        .filter(f"bit_count(a ^ b) <= {NEAR}")
        .select("a", "b")
    )
    crowded = met.filter(F.col("count") > MEETING).select("fp").distinct()
    flips = F.array(F.lit(0), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)])
    around = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    least = around.groupBy("mid").agg(F.min("fp").alias("least"), F.count("*").alias("n")).filter("n > 1")
    chained = around.join(least, "mid").filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return pairs.union(chained)


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for each row of ``docs``.

    Texts without a word, and null ones, have fingerprint zero and are linked like any
    other. component_id is the smallest doc_id reached over fingerprints that differ in
    at most two bits; null doc_ids are no candidates for it, so a component of only
    such rows has none. Rows that repeat a doc_id are linked like any others.
    """
    each = written(fingerprints(plain(docs)), "fingerprints")
    fps = written(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(near_edges(fps.select("fp")))
    rooted = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return each.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest doc_id of each component, and rows without a doc_id."""
    gone = near_groups(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
