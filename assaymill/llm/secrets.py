"""Secrets by character Markov models, with SQL functions only.

Patterns find the strict spans. Any other long token is judged by two models of
character pairs, one of random strings and one of ordinary identifiers; their
log-likelihood ratio per pair, against a threshold set on labelled samples, decides.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from assaymill.llm.common import plain, written
from assaymill.llm.spans import joined, with_matches

KINDS = ["assign", "access", "hex"]
#: \x22 and \x27 are the two quotation marks.
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*+[:=]\x20*+[\x22\x27]?([A-Za-z0-9+/_.=-]++)"
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]++", "hex": "(?<![0-9a-f])[0-9a-f]{32,}+"}
GUARDS = {
    "assign": "rlike(text, '(?i:passw|secret|token|key)')",
    "access": "contains(text, 'AKIA')",
    "hex": "rlike(text, '[0-9a-f]{32}')",
}
VALID = {
    "assign": f"length(regexp_extract(x.value, r'{ASSIGN}', 1)) >= 8",
    "access": "length(x.value) >= 16",
    "hex": "length(x.value) >= 32",
}
#: Candidates: tokens of the characters that keys are written in.
TOKEN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Documents whose words are the labelled ordinary sample, and as many random strings of each form.
LABELLED = 1000
#: Part of the ordinary sample that may lie above the threshold.
SPARE = 0.0005


def pairs(text: str) -> str:
    """SQL for the numbers, from 0, of the character pairs of ``text`` over ``ALPHABET``."""
    chars, most = f"split({text}, '')", f"length({text}) - 1"
    number = f"(instr('{ALPHABET}', a) - 1) * {len(ALPHABET)} + instr('{ALPHABET}', b) - 1"
    return f"zip_with(slice({chars}, 1, {most}), slice({chars}, 2, {most}), (a, b) -> {number})"


def samples(docs: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(token, random): strings known to be random, and ordinary identifiers made of the documents' words.

    The documents are those with the smallest hashes of doc_id. Their words of letters,
    alone and in pairs as snake case, camel case and paths, are the ordinary side. Digests
    of their ids, written in hexadecimal, base 64 and capitals with digits, are the random one.
    """
    rows = plain(docs).filter("doc_id is not null")
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id").limit(labelled)
    known = rows.join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id")).drop("_id")
    words = known.select(F.expr("regexp_extract_all(text, '[A-Za-z]{2,}', 0)").alias("w"))
    ordinary = words.select(
        F.explode(
            F.expr(
                """flatten(array(filter(w, x -> length(x) >= 8),
                    flatten(transform(sequence(1, greatest(1, size(w) - 2)), i -> case i % 4
                        when 0 then array(concat(get(w, i), '_', get(w, i + 1), '_', get(w, i - 1)))
                        when 1 then array(concat(lower(get(w, i)), initcap(get(w, i + 1)), initcap(get(w, i - 1))))
                        when 2 then array(concat(get(w, i), '/', get(w, i + 1), '/', get(w, i - 1)))
                        else array(concat(upper(get(w, i)), '-', get(w, i + 1), get(w, i - 1))) end))))"""
            )
        ).alias("token")
    )
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    random = chosen.select(
        F.explode(
            F.array(
                F.substr(digest, F.lit(1), F.lit(40)),
                F.rtrim(F.base64(F.unhex(digest)), F.lit("=")),
                F.translate(F.upper(F.translate(F.rtrim(F.base64(F.unhex(digest)), F.lit("=")), "+/", "xy")), "189", "PQR"),
                F.substr(F.base64(F.encode(F.substr(digest, F.lit(1), F.lit(24)), "utf-8")), F.lit(1), F.lit(32)),
            )
        ).alias("token")
    )
    return ordinary.filter("length(token) >= 8").select("token", F.lit(False).alias("random")).union(random.select("token", F.lit(True)))


def train(sample: DataFrame, spare: float = SPARE) -> tuple[list[float], float]:
    """Log-likelihood ratio of each character pair, and the threshold on the mean ratio of a token.

    Pairs are summed up before they reach the driver: at most two counts for each.
    """
    n = len(ALPHABET)
    counts = np.full((2, n, n), 0.5)
    found = sample.select("random", F.explode(F.expr(pairs("token"))).alias("pair")).groupBy("random", "pair").count()
    for row in found.collect():
        counts[int(row["random"]), row["pair"] // n, row["pair"] % n] += row["count"]
    likely = counts / counts.sum(axis=2, keepdims=True)
    ratios = [round(float(x), 6) for x in np.log(likely[1] / likely[0]).ravel()]
    scored = sample.filter("not random").select(mean_ratio("token", ratios).alias("score"))
    limit = scored.agg(F.percentile_approx("score", F.lit(1 - spare), F.lit(10000))).first()[0]
    return ratios, max(0.0, limit if limit is not None else math.inf)


def mean_ratio(text: str, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the character pairs of the SQL expression ``text``, of two characters at least."""
    table = f"array({', '.join(f'{r}D' for r in ratios)})"
    return F.expr(f"aggregate({pairs(text)}, 0D, (s, p) -> s + get({table}, cast(p as int))) / (length({text}) - 1)")


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the strict spans of each kind (ok_<kind>) and those the models add, for each row of ``docs``.

    Added spans overlap no strict one. A null or empty text has none. Rows that repeat a
    doc_id, or have none, get their own spans; an empty table gives no rows.
    """
    df = plain(docs)
    for kind, pattern in PATTERNS.items():
        df = with_matches(df, kind, pattern, F.expr(GUARDS[kind]))
    for kind in KINDS:
        df = df.withColumn(f"ok_{kind}", F.expr(f"filter({kind}, x -> {VALID[kind]})"))
    df = with_matches(df, "tokens", TOKEN, F.expr("rlike(text, '[A-Za-z0-9+/_=-]{16}')"))
    strict = ", ".join(f"ok_{k}" for k in KINDS)
    # A token of digits and marks only is a number or a line, whatever its pairs say.
    clear = f"filter(tokens, x -> rlike(x.value, '[A-Za-z]') and not exists(concat({strict}), y -> y.start < x.stop and x.start < y.stop))"
    found = written(df.select("doc_id", *[f"ok_{k}" for k in KINDS], F.expr(clear).alias("tokens")).withColumn("row", F.monotonically_increasing_id()), "tokens")
    ratios, limit = train(written(samples(docs), "sample"))
    if limit == math.inf:
        return found.select("doc_id", *[f"ok_{k}" for k in KINDS], F.expr("filter(tokens, x -> false)").alias("added"))
    # Judged as rows, so that the table of ratios is looked up by compiled code.
    judged = found.select("row", F.explode("tokens").alias("x")).filter(mean_ratio("x.value", ratios) > limit)
    added = judged.groupBy("row").agg(F.collect_list("x").alias("more"))
    return found.join(added, "row", "left").select(
        "doc_id", *[f"ok_{k}" for k in KINDS], F.coalesce("more", F.expr("filter(tokens, x -> false)")).alias("added")
    )


def digest(found: DataFrame) -> DataFrame:
    """The spans of ``secret_spans`` as counts and strings."""
    strict = [f"ok_{k}" for k in KINDS]
    return found.select(
        "doc_id",
        *[F.size(f"ok_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(KINDS, strict), 256).alias("base_sha256"),
        joined([*KINDS, "random"], [*strict, "added"]).alias("spans"),
    )
