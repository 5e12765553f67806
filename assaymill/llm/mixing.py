"""Mixing documents to target token weights with soft domain memberships.

A classifier fitted on a labelled table gives each document a probability per domain.
Nonnegative document rates are then fitted so that the expected tokens of each domain,
sum of rate * tokens * probability, come to the targets: projected, scaled gradient steps
on the least squares, each one sum over all documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from assaymill.llm.common import plain, written

DOMAINS = ["good", "poor", "toxic"]
#: Hashed words of the classifier and labelled rows it is fitted on.
WIDTH, LABELLED = 1 << 15, 8000
#: A domain's tokens may be off by this part of their target.
TOLERANCE = 1e-6
#: Targets are out of reach if a step lowers the squared misses by less than these parts of the present and of the first ones.
STILL, STILL_FIRST = 1e-4, 1e-8
#: Rounds without a smaller miss before all documents measure the steps; steps before rates are written.
PATIENCE, STRETCH = 8, 12


def words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[^ \\t\\n\\x0B\\f\\r]+"), F.lit(0))


def featured(docs: DataFrame) -> DataFrame:
    """Adds n_tokens, the words of the text, and the hashed set of them."""
    split = docs.withColumn("words", words("text"))
    hashed = HashingTF(numFeatures=WIDTH, binary=True, inputCol="words", outputCol="features").transform(split)
    return hashed.withColumn("n_tokens", F.size("words").cast("bigint")).drop("text", "words")


def domain(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of the labelled table: toxic rows, then good and poor ones; rows without both marks are left out."""
    marks = labels.filter("quality is not null and toxic is not null and doc_id is not null")
    return marks.groupBy("doc_id").agg(
        F.when(F.max("toxic") == 1, 2.0).when(F.min("quality") == 1, 0.0).otherwise(1.0).alias("label")
    )


def fit_domains(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> LogisticRegressionModel | None:
    """The classifier, from at most ``labelled`` labelled rows (those with the smallest hash of doc_id).

    None where no labelled document exists; every domain is then equally likely.
    """
    chosen = domain(labels).orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(labelled)
    known = plain(docs).join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
    sample = written(featured(known.drop("_id")).select("features", "label"), "labelled")
    if sample.isEmpty():
        return None
    # Rows of every domain with no feature keep the number of classes.
    return LogisticRegression(maxIter=60, regParam=0.002, family="multinomial", standardization=False).fit(sample)


def posteriors(docs: DataFrame, model: LogisticRegressionModel | None) -> DataFrame:
    """doc_id, n_tokens and p, a probability for each of ``DOMAINS``."""
    rows = featured(plain(docs))
    k = len(DOMAINS)
    if model is None:
        return rows.select("doc_id", "n_tokens", F.array(*[F.lit(1.0 / k)] * k).alias("p"))
    scored = model.setFeaturesCol("features").transform(rows)
    p = vector_to_array("probability")
    # A domain beyond the labels that the fit has seen is impossible.
    return scored.select("doc_id", "n_tokens", F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.coalesce(F.try_element_at(p, i), F.lit(0.0))).alias("p"))


def rate(steps: list[list[float]], first: Column | None = None) -> Column:
    """A document's rate after projected steps from ``first``, else 1: each adds p . step and cuts off below zero."""
    value = F.lit(1.0) if first is None else first
    if not steps:
        return value
    moves = F.array(*[F.array(*map(F.lit, s)) for s in steps])
    return F.aggregate(moves, value, lambda r, s: F.greatest(F.lit(0.0), r + dot(F.col("p"), s)))


def dot(a: Column, b: Column) -> Column:
    k = len(DOMAINS)
    total = F.get(a, 0) * F.get(b, 0)
    for i in range(1, k):
        total = total + F.get(a, i) * F.get(b, i)
    return total


def descend(look, goal: np.ndarray) -> list[list[float]]:
    """Projected steps that bring the domain tokens to ``goal``.

    ``look(steps)``: the tokens of each domain after ``steps``, the sum of tokens * p p'
    over the documents whose rates are then above zero, and how far the last step moved
    the rates (sum of tokens * squared change).

    A step is the gradient of the squared misses, measured by the inverse of that sum over
    the open documents: on those alone it would meet the targets at once. It is halved
    until the misses shrink by a fair part of what the rates moved. Where the open
    documents cannot tell the domains apart, or misses have not shrunk for ``PATIENCE``
    rounds, all documents measure it, which always shrinks them, and it begins at twice
    the length of the one before. Ends when each domain is within ``TOLERANCE`` of its
    target (of its first tokens if that is zero), or when a step measured by all documents
    no longer lowers the squared misses: they are then about the least that rates can reach.
    """
    now, whole, _ = look([])
    start = now
    scale = np.where(goal > 0, goal, np.where(now > 0, now, 1.0))
    # Small domains count like large ones in what is singular.
    unit = 1.0 / np.sqrt(np.where(np.diag(whole) > 0, np.diag(whole), 1.0))
    unit = np.outer(unit, unit)
    rank = np.linalg.matrix_rank(whole * unit, tol=1e-9, hermitian=True)
    open_, steps, best, since, fixed, far = whole, [], np.inf, 0, False, 0.5
    while True:
        miss = goal - now
        off = float((np.abs(miss) / scale).max())
        if off <= TOLERANCE:
            return steps
        since = 0 if off < best * 0.999 else since + 1
        best = min(best, off)
        fixed = fixed or since >= PATIENCE
        all_ = fixed or np.linalg.matrix_rank(open_ * unit, tol=1e-9, hermitian=True) < rank
        metric = np.linalg.pinv((whole if all_ else open_) * unit, rcond=1e-9, hermitian=True) * unit
        step = metric @ miss
        worth = float(miss @ step)
        length = far = 2 * far if all_ else 1.0
        while True:
            new, opened, moved = look([*steps, [float(x) for x in length * step]])
            left = goal - new
            if worth - float(left @ metric @ left) >= 0.2 * moved / length or length < 1e-9:
                break
            length /= 2
        first = float((goal - start) @ metric @ (goal - start))
        if worth - float(left @ metric @ left) <= max(STILL * worth, STILL_FIRST * first if all_ else 0.0):
            if all_:
                return steps
            fixed = True
            continue
        far = length if all_ else far
        steps.append([float(x) for x in length * step])
        now, open_ = new, opened


def fit_rates(members: DataFrame, targets: dict[str, float]) -> list[list[float]]:
    """Steps of ``rate`` that bring the expected domain tokens to ``targets``, see ``descend``.

    Each look is one sum over all documents; rates are written every ``STRETCH`` steps,
    so that a look costs the same however many steps there are.
    """
    k = len(DOMAINS)
    at, base = 0, members.select("n_tokens", "p", F.lit(1.0).alias("r"))

    def look(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray, float]:
        nonlocal at, base
        if len(steps) - 1 - at >= STRETCH:
            base = written(base.select("n_tokens", "p", rate(steps[at:-1], F.col("r")).alias("r")), "rates")
            at = len(steps) - 1
        before = base.select("n_tokens", "p", rate(steps[at:-1], F.col("r")).alias("before"))
        rated = before.select(F.col("n_tokens").cast("double").alias("n"), "p", "before", rate(steps[-1:], F.col("before")).alias("r"))
        now = [F.sum(F.col("n") * F.get("p", i) * F.col("r")) for i in range(k)]
        open_ = F.when(F.col("r") > 0, F.col("n")).otherwise(0.0)
        products = [F.sum(open_ * F.get("p", i) * F.get("p", j)) for i in range(k) for j in range(k)]
        change = F.col("r") - F.col("before")
        found = np.array([x or 0.0 for x in rated.agg(*now, *products, F.sum(F.col("n") * change * change)).first()], dtype=np.float64)
        return found[:k], found[k:-1].reshape(k, k), float(found[-1])

    return descend(look, np.array([targets[d] for d in DOMAINS], dtype=np.float64))


def totals(members: DataFrame) -> dict[str, float]:
    found = members.agg(*[F.sum(F.col("n_tokens") * F.get("p", i)) for i in range(len(DOMAINS))]).first()
    return dict(zip(DOMAINS, [x or 0.0 for x in found]))


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float], total: float | None = None) -> DataFrame:
    """doc_id, n_tokens, p_<domain> and rate for each row of ``docs``.

    ``weights``: the share of each domain in the mixed tokens; ``total``: the mixed
    tokens, as many as the documents have if not given. A null or empty text has no
    tokens and a rate, but no part in the totals. Rows that repeat a doc_id, or have
    none, are rated one by one. An empty table gives no rows.
    """
    members = written(posteriors(docs, fit_domains(docs, labels)), "members")
    now = totals(members)
    whole = sum(weights.values())
    tokens = total if total is not None else sum(now.values())
    steps = fit_rates(members, {d: tokens * weights[d] / whole for d in DOMAINS})
    return members.select(
        "doc_id", "n_tokens", *[F.get("p", i).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], rate(steps).alias("rate")
    )


def thin(docs: DataFrame, labels: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The rows of ``docs`` drawn at their rates, each once at most.

    ``shares``: the part of each domain's tokens to keep; the target weights follow from
    it and the present totals. Rows are drawn by a hash of doc_id, so a run repeats.
    """
    members = written(posteriors(docs, fit_domains(docs, labels)), "members")
    now = totals(members)
    steps = fit_rates(members, {d: now[d] * shares[d] for d in DOMAINS})
    lot = F.pmod(F.xxhash64("doc_id", F.lit(21)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    gone = members.filter(rate(steps) + lot < 1).select(F.col("doc_id").alias("_gone")).filter("_gone is not null").distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
