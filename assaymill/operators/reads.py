"""Sequencing reads: layout, mates, trimming and size-bounded parts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from assaymill.operators.ordering import running_total

FIELDS = ["id", "seq", "plus", "qual"]

# The adapter file of the trimming recipe.
ADAPTERS = [
    "AGATGTGTATAAGAGACAG",
    "AGATGTGTATAAGAGACAG",
    "TCGTCGGCAGCGTCAGATGTGTATAAGAGACAG",
    "CTGTCTCTTATACACATCTGACGCTGCCGACGA",
    "GTCTCGTGGGCTCGGAGATGTGTATAAGAGACAG",
    "CTGTCTCTTATACACATCTCCGAGCCCACGAGAC",
]


def read_layout(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of one-line reads (file, line_no, fields).

    The first line of a file decides: 8 fields are paired, 4 single. Lines of another
    width are rejected, and so is a whole file that starts with neither.
    """
    width = F.size("fields")
    layouts = df.groupBy("file").agg(F.min_by(width, F.col("line_no")).alias("width"))
    known = df.join(layouts, "file").withColumn(
        "layout", F.when(F.col("width") == 8, "paired").when(F.col("width") == 4, "single")
    )
    good = F.col("layout").isNotNull() & (width == F.col("width"))
    return known.filter(good).drop("width"), known.filter(~good).drop("width")


def zip_mates(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Record i of the first file with record i of the second."""
    second = r2.select("file", "record_no", F.struct(*FIELDS).alias("mate"))
    return r1.join(second, ["file", "record_no"])


def read_key(name: Column) -> Column:
    return F.split_part(name, F.lit(" "), F.lit(1))


def rejoin_mates(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Pairs whose id up to the first blank is on both sides, in the second side's order.

    The last of several first-side records with one id is kept, as an aggregate.
    """
    kept = (
        r1.groupBy("file", read_key(F.col("id")).alias("key"))
        .agg(F.max_by(F.struct(*FIELDS), F.col("record_no")).alias("first"))
    )
    second = r2.select("file", read_key(F.col("id")).alias("key"), "record_no", F.struct(*FIELDS).alias("mate"))
    return second.join(kept, ["file", "key"]).select("file", "record_no", "first.*", "mate")


def interleave(df: DataFrame) -> DataFrame:
    """Records, with or without a ``mate``, as one tab-separated line each."""
    fields = [F.col(c) for c in FIELDS]
    if "mate" in df.columns:
        fields += [F.col("mate")[c] for c in FIELDS]
    return df.withColumn("line", F.concat_ws("\t", *fields)).drop(*FIELDS, "mate")


def deinterleave(df: DataFrame) -> DataFrame:
    """One-line reads back to records; ``mate_no`` tells the sides of a pair apart."""
    parts = F.split("line", "\t")
    sides = F.transform(F.sequence(F.lit(0), (F.size(parts) / 4).cast("int") - 1),
                        lambda i: F.slice(parts, i * 4 + 1, F.lit(4)))
    rows = df.select(*[c for c in df.columns if c != "line"], F.posexplode(sides).alias("side", "f"))
    return rows.select(
        *[c for c in df.columns if c != "line"], (F.col("side") + 1).alias("mate_no"),
        *[F.col("f")[i].alias(name) for i, name in enumerate(FIELDS)],
    )


def below(quality: int) -> str:
    """The phred+33 characters below ``quality``."""
    return "".join(chr(33 + q) for q in range(quality))


def keep_span(df: DataFrame, start: Column, length: Column) -> DataFrame:
    """Cut ``seq`` and ``qual`` alike; ``start`` is 1-based."""
    return df.withColumns({c: F.substr(F.col(c), start, length) for c in ("seq", "qual")})


def trim_ends(df: DataFrame, left: int = 10, right_quality: int = 25) -> DataFrame:
    """Drop ``left`` bases, then trailing bases below ``right_quality``."""
    cut = F.substr("qual", F.lit(left + 1))
    return keep_span(df, F.lit(left + 1), F.length(F.rtrim(cut, F.lit(below(right_quality)))))


def low_window(window: int, min_mean: int):
    """Arrow function: 1-based first window with a mean quality below ``min_mean``, 0 for none."""

    @F.pandas_udf("int")
    def position(qual: pd.Series) -> pd.Series:
        result = np.zeros(len(qual), dtype=np.int32)
        for rows, letters in same_length(qual.fillna("").to_numpy(dtype=object), "utf-32-le", np.uint32):
            starts = letters.shape[1] - window + 1
            if starts < 1:
                continue
            scores = letters.astype(np.int32) - 33
            low = sum(scores[:, k:k + starts] for k in range(window)) < window * min_mean
            result[rows] = np.where(low.any(axis=1), low.argmax(axis=1) + 1, 0)
        return pd.Series(result)

    # Otherwise a filter on the length would be pushed down and look at every read twice.
    return position.asNondeterministic()


def quality_trim(df: DataFrame, lead: int = 3, trail: int = 3, window: int = 4, min_mean: int = 15) -> DataFrame:
    """Cut low ends, then everything from the first window with a mean below ``min_mean``.

    Ends are cut by trimming the characters of low qualities; the windows of many reads
    are summed at once.
    """
    qual = F.col("qual")
    led = F.ltrim(qual, F.lit(below(lead)))
    ends = keep_span(
        df, F.length(qual) - F.length(led) + 1, F.length(F.rtrim(led, F.lit(below(trail))))
    )
    position = low_window(window, min_mean)(F.col("qual"))
    length = F.when(F.col("_bad") > 0, F.col("_bad") - 1).otherwise(F.length("qual")).cast("int")
    return keep_span(ends.withColumn("_bad", position).withColumn("_keep", length), F.lit(1), F.col("_keep")).drop(
        "_bad", "_keep"
    )


def min_length(df: DataFrame, n: int = 36) -> DataFrame:
    """Reads of at least ``n`` bases; a pair needs both."""
    long = F.length("seq") >= n
    if "mate" in df.columns:
        long = long & (F.length(F.col("mate.seq")) >= n)
    return df.filter(long)


def same_length(texts: np.ndarray, encoding: str = "ascii", kind: type = np.uint8):
    """(rows, matrix of letters) for each length among ``texts``; no read is padded to the longest one."""
    lengths = np.array([len(s) for s in texts], dtype=np.int64)
    for width in np.unique(lengths):
        rows = np.flatnonzero(lengths == width)
        letters = np.frombuffer("".join(texts[rows]).encode(encoding, "replace"), dtype=kind)
        yield rows, letters.reshape(len(rows), width)


#: Reads whose words are counted at once, letters in which adapters are looked for at once, and the most words counted in a table of all.
ROWS, LETTERS, WORDS = 256, 1 << 19, 1 << 10


def same_in_row(codes: np.ndarray) -> np.ndarray:
    """For each place of a matrix, how often its value is in its row; each row is counted in a table of the values seen."""
    size, at = int(codes.max(initial=0)) + 1, codes
    if size > WORDS:
        values, at = np.unique(codes, return_inverse=True)
        size, at = len(values), at.reshape(codes.shape)
    cells = np.arange(len(codes))[:, None] * size + at
    return np.bincount(cells.ravel(), minlength=len(codes) * size)[cells]


def complexity_score(window: int, step: int, word: int):
    """Arrow function: entropy of the words of a read, 0 to 100, averaged over windows.

    A new window starts every ``step`` bases while more than ``step`` are left. The
    entropy of a window of n words is taken to base min(4^word, n), so it is 100 when
    all words differ. With c the count of the word at each place, it is
    the mean of -ln(c / n).
    """

    @F.pandas_udf("double")
    def score(seq: pd.Series) -> pd.Series:
        result = np.zeros(len(seq))
        for rows, bases in same_length(seq.fillna("").to_numpy(dtype=object)):
            width = bases.shape[1]
            # The letters that occur are numbered, so that few letters make small numbers of words.
            seen, number = np.bincount(bases.ravel(), minlength=256) > 0, np.zeros(256, dtype=np.int64)
            number[seen] = np.arange(seen.sum())
            starts = range(0, max((width - step - 1) // step, 0) * step + 1, step)
            for start in starts:
                piece = number[bases[:, start:start + window]]
                n = piece.shape[1] - word + 1
                if n < 2:
                    continue
                codes = sum(piece[:, k:k + n] * int(seen.sum()) ** k for k in range(word))
                counts = np.concatenate([same_in_row(codes[k:k + ROWS]) for k in range(0, len(codes), ROWS)])
                entropy = -np.log(np.arange(1, n + 1) / n)[counts - 1].mean(axis=1)
                result[rows] += entropy / np.log(min(4**word, n)) * 100 / len(starts)
        return pd.Series(result)

    # Otherwise a filter on the score would be pushed down and score every read twice.
    return score.asNondeterministic()


def with_complexity(df: DataFrame, window: int = 64, step: int = 32, word: int = 3) -> DataFrame:
    return df.withColumn("complexity", complexity_score(window, step, word)(F.col("seq")))


def drop_low_complexity(df: DataFrame, threshold: float = 65) -> DataFrame:
    return with_complexity(df).filter(F.round("complexity", 9) >= threshold).drop("complexity")


def adapter_position(adapters: list[str], mismatches: int, error_rate: float | None, min_overlap: int | None):
    """Arrow function: 0-based first position of any adapter in a read, -1 for none.

    A whole adapter may differ in ``mismatches`` bases (or ``error_rate`` of its length).
    With ``min_overlap`` an adapter may also run over the read's end by any amount
    that leaves that many bases.
    """
    codes = [np.frombuffer(a.encode(), dtype=np.uint8) for a in dict.fromkeys(adapters)]
    letters = np.unique(np.concatenate(codes)).tolist()

    def allowed(overlap: int) -> int:
        return mismatches if error_rate is None else int(overlap * error_rate)

    @F.pandas_udf("int")
    def position(seq: pd.Series) -> pd.Series:
        best = np.full(len(seq), np.iinfo(np.int32).max, dtype=np.int64)
        for rows, bases in same_length(seq.fillna("").to_numpy(dtype=object)):
            width = bases.shape[1]
            many = max(LETTERS // max(width, 1), 1)
            for k in range(0, len(rows), many):
                some, columns = rows[k:k + many], np.ascontiguousarray(bases[k:k + many].T)
                other = {letter: (columns != letter).view(np.uint8) for letter in letters}
                for code in codes:
                    shortest = len(code) if min_overlap is None else min(min_overlap, len(code))
                    starts = width - shortest + 1
                    if starts < 1:
                        continue
                    # For each start and read; a base of the adapter beyond the read's end differs from none.
                    differing = np.zeros((starts, len(some)), dtype=np.uint8 if len(code) < 256 else np.int32)
                    for i, letter in enumerate(code.tolist()):
                        last = min(starts, width - i)
                        if last > 0:
                            differing[:last] += other[letter][i:i + last]
                    most = [allowed(min(len(code), width - start)) for start in range(starts)]
                    hit = differing <= np.array(most)[:, None]
                    best[some] = np.minimum(best[some], np.where(hit.any(axis=0), hit.argmax(axis=0), best[some]))
        return pd.Series(np.where(best == np.iinfo(np.int32).max, -1, best).astype("int32"))

    return position.asNondeterministic()


def clip_adapters(
    df: DataFrame,
    adapters: list[str] = ADAPTERS,
    mismatches: int = 2,
    error_rate: float | None = None,
    min_overlap: int | None = None,
) -> DataFrame:
    """Cut each read where the first adapter begins."""
    find = adapter_position(adapters, mismatches, error_rate, min_overlap)
    placed = df.withColumn("_at", find(F.col("seq")))
    length = F.when(F.col("_at") >= 0, F.col("_at")).otherwise(F.length("qual")).alias("length")
    return keep_span(placed.withColumn("_keep", length), F.lit(1), F.col("_keep")).drop("_at", "_keep")


def part_numbers(df: DataFrame, max_bytes: int) -> DataFrame:
    """Part of each one-line read (file, read_no, line): the bytes before it over ``max_bytes``.

    A part therefore closes with the first record that passes a multiple of the
    bound and exceeds it by less than a record. The running sum is taken over range
    partitions, so one huge file is not gathered.
    """
    sized = df.withColumn("_bytes", F.octet_length("line") + 1)
    summed = running_total(sized, ["file"], [F.col("read_no")], "_bytes", "_before")
    part = F.floor(F.col("_before") / max_bytes).alias("part")
    return summed.select(*df.columns, part)
