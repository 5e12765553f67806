"""Divergence of sources within a language, from run-length columns.

The kept terms of a language get an order in which equal counts stand together. Each
source is then a column of counts along that order and is held as runs of equal
probability; a pair of columns is compared by cutting the order where either one's runs
begin, and each piece counts its value times its length. The order is cut into blocks and
the sources into tiles, so that a task holds two tiles of one block, whatever the size of
the vocabulary or the number of sources.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from assaymill.llm.common import written
from assaymill.operators.ordering import numbered

#: Letters A-Z become small, bytes beyond ASCII stay, any other byte separates terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: A term is kept if so many documents of its language have it.
LEAST_DOCS = 10
#: Positions of a block, sources of a tile, sources whose counts the order goes by one after the other.
BLOCK, TILE, LEADING = 8192, 32, 8
#: Rows worked on at once, bytes of a text split at once, counts held before they are handed on.
ROWS, SLICE, HELD = 256, 1 << 20, 200_000
SCALE = 1_000_000_000


def terms(text: str):
    """The terms of ``text`` as bytes, in lists of bounded size."""
    data = text.encode().translate(_TERM_BYTES)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + SLICE) if len(data) - start > SLICE else -1
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def group_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences, and documents with the term, of each group; summed within a task first."""

    def count(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def out():
            columns = [[], [], [], [], []]
            for (lang, source), (n, d) in held.items():
                columns[0] += [lang] * len(n)
                columns[1] += [source] * len(n)
                columns[2] += [t.decode() for t in n]
                columns[3] += n.values()
                columns[4] += [d[t] for t in n]
            held.clear()
            types = [pa.string()] * 3 + [pa.int64()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["lang", "source", "term", "n", "d"])

        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                seen: set[bytes] = set()
                for part in terms(text):
                    n.update(part)
                    seen.update(part)
                d.update(seen)
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield out()
        yield out()

    each = docs.mapInArrow(count, "lang string, source string, term string, n bigint, d bigint")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def probability(n: str, whole: str, v: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (whole + 2 * v)), exact beyond 64 bits; NULL without kept terms."""
    return F.expr(f"1 + (cast({n} + 2 as decimal(20, 0)) * cast({SCALE} as decimal(10, 0))) div nullif(cast({whole} + 2 * {v} as decimal(20, 0)), 0)")


def gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)); both are at most SCALE + 1, so the square fits 64 bits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def ordered_terms(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, term, n_all, pos, v) of the kept terms: pos from 1 in an order in which equal counts stand together.

    Terms go by their counts in the largest sources, one after the other, then by a
    signature of all their counts: terms with the same count in every source adjoin.
    """
    placed = counts.join(groups.select("lang", "source", "place"), ["lang", "source"])
    leading = [F.coalesce(F.sum(F.when(F.col("place") == k, F.col("n"))), F.lit(0)).alias(f"o{k}") for k in range(1, LEADING + 1)]
    kept = placed.groupBy("lang", "term").agg(
        F.sum("n").alias("n_all"), F.sum("d").alias("d"), *leading, F.bit_xor(F.xxhash64("source", "n")).alias("signature")
    )
    kept = kept.filter(F.col("d") >= LEAST_DOCS)
    order = [*[F.col(f"o{k}").desc() for k in range(1, LEADING + 1)], F.col("n_all").desc(), F.col("signature"), F.col("term")]
    return numbered(kept, ["lang"], order, "pos", "v").select("lang", "term", "n_all", "pos", "v")


def runs(cells: DataFrame) -> DataFrame:
    """(lang, source, block, start, length, p): runs of one probability along the order, without those of absent terms."""
    placed = cells.withColumn("block", F.expr(f"(pos - 1) div {BLOCK}")).withColumn("at", F.expr(f"cast((pos - 1) % {BLOCK} as int)"))
    same = Window.partitionBy("lang", "source", "block", "p").orderBy("at")
    numbered_ = placed.withColumn("run", F.col("at") - F.row_number().over(same))
    return numbered_.groupBy("lang", "source", "block", "p", "run").agg(F.min("at").alias("start"), F.count(F.lit(1)).cast("int").alias("length"))


def column_of(starts: np.ndarray, lengths: np.ndarray, p: np.ndarray, size: int, absent: int) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and values of the runs that cover [0, size): gaps hold the probability of absent terms."""
    order = np.argsort(starts)
    starts, ends, p = starts[order], starts[order] + lengths[order], p[order]
    gaps = np.concatenate([[0], ends])
    open_ = gaps < np.concatenate([starts, [size]])
    begin = np.concatenate([starts, gaps[open_]])
    value = np.concatenate([p, np.full(int(open_.sum()), absent, dtype=np.int64)])
    order = np.argsort(begin)
    return begin[order], value[order]


def compare(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int) -> int:
    """Sum over [0, size) of floor((p - q)^2 / (p + q)) of two columns of runs."""
    if not size:
        return 0
    begin = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], begin, "right") - 1]
    q = b[1][np.searchsorted(b[0], begin, "right") - 1]
    length = np.diff(np.append(begin, size))
    return int(((p - q) ** 2 // (p + q) * length).sum())


def pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of each unordered pair of sources of a language."""
    spread = groups.withColumn("block", F.explode(F.expr(f"sequence(0L, greatest((v - 1) div {BLOCK}, 0L))")))
    base = spread.select(
        "lang", "block", "source", F.lit(-1).alias("start"), F.lit(0).alias("length"), F.coalesce("p0", F.lit(1)).alias("p"),
        F.expr(f"cast(least({BLOCK}, v - block * {BLOCK}) as int)").alias("size"), "tile", "tiles",
    )
    found = runs(cells).join(groups.select("lang", "source", "tile", "tiles"), ["lang", "source"])
    rows = base.unionByName(found.select("lang", "block", "source", "start", "length", "p", F.lit(0).alias("size"), "tile", "tiles"))
    other = F.explode(F.expr("sequence(0, tiles - 1)"))
    rows = rows.filter("tiles > 0").withColumn("other", other).select(
        "lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "source", "start", "length", "p", "size"
    )

    def kernel(key, frame):
        lang, _, low, high = key
        size = int(frame["size"].max())
        columns, tiles = {}, {}
        for source, part in frame.groupby("source", sort=False):
            start = part["start"].to_numpy()
            head = start < 0
            values = part["p"].to_numpy()
            real = ~head
            columns[source] = column_of(start[real].astype(np.int64), part["length"].to_numpy()[real].astype(np.int64), values[real], size, int(values[head][0]))
            tiles[source] = int(part["tile"].iloc[0])
        out = []
        lows = [s for s in columns if tiles[s] == low]
        for i, a in enumerate(lows):
            for b in lows[i + 1 :] if low == high else [s for s in columns if tiles[s] == high]:
                out.append((lang, min(a, b), max(a, b), compare(columns[a], columns[b], size)))
        return pd.DataFrame(out, columns=["lang", "a", "b", "part"])

    parts = rows.groupBy("lang", "block", "low", "high").applyInPandas(kernel, "lang string, a string, b string, part bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))


def divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: how far the sources of a language differ.

    Part ``pair``: every other source of the language with the summed gap of all kept
    terms. Part ``term``: the ten terms whose share in the source most exceeds that in
    the language. A null text, lang or source is ''. A language without kept terms has
    pairs of value 0 and no terms; a language with one source has no pairs. Rows that
    repeat a doc_id, or have none, are documents like any other; ties go by the item's
    bytes. Texts of any length are read whole, in slices. An empty table gives no rows.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = written(group_counts(docs), "counts")
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    every = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc_nulls_last("words"), "source"))
    placed = written(every.select("lang", "source", place.alias("place")), "groups")
    columns = written(ordered_terms(counts, placed), "terms")
    cells = written(counts.drop("d").join(columns, ["lang", "term"]), "cells")

    whole = cells.groupBy("lang", "source").agg(F.sum("n").alias("whole"))
    langs = columns.groupBy("lang").agg(F.max("v").alias("v"), F.sum("n_all").alias("lang_whole"))
    tiles = placed.groupBy("lang").agg(F.expr(f"cast((max(place) + {TILE - 1}) div {TILE} as int)").alias("tiles"))
    groups = placed.join(whole, ["lang", "source"], "left").join(langs, "lang", "left").join(tiles, "lang")
    groups = groups.fillna(0, ["whole", "v", "lang_whole"]).withColumn("tile", F.expr(f"cast((place - 1) div {TILE} as int)"))
    groups = written(groups.withColumn("p0", probability("0", "whole", "v")), "columns")

    known = groups.select("lang", "source", "whole", "lang_whole")
    rated = cells.join(known, ["lang", "source"]).withColumn("p", probability("n", "whole", "v")).withColumn("q", probability("n_all", "lang_whole", "v"))

    pairs = pair_values(rated, groups)
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("_r"), "value")
    both = both.select("lang", "_r.source", F.lit("pair").alias("part"), "_r.item", "value")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = rated.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap("p", "q").alias("value"))
    top = above.withColumn("rank", F.row_number().over(best)).filter("rank <= 10")
    return both.withColumn("rank", F.row_number().over(best)).unionByName(top).select("lang", "source", "part", "item", "value", "rank")
