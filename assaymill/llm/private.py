"""Personal data by weak supervision, with SQL functions only.

Patterns find candidate spans. Labelers - the strict pattern, a checksum or shape test,
gazetteers, and the words around - vote on each. Expectation-maximisation over the
counts of equal votes estimates how reliable each labeler is, and its posteriors train a
naive Bayes classifier on the spans' features. Spans of the strict patterns always stay;
the classifier decides on the others.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from assaymill.llm.common import plain, written
from assaymill.llm.spans import joined, with_matches

KINDS = ["email", "ip", "card", "phone"]

_LOCAL = "[A-Za-z0-9._%+-]"
#: The strict patterns, written so that no start is tried twice and no step is taken back:
#: a run of characters is entered at its first one, or where the last match has ended.
STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Forms that the strict patterns leave out.
LOOSE = {
    "email_loose": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)++",
    "phone_loose": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "id_loose": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban_loose": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
GUARDS = {
    "email": "contains(text, '@')",
    "ip": "rlike(text, '[0-9][.][0-9]')",
    "card": "rlike(text, '[0-9][0-9 -]{10,}[0-9]')",
    "phone": "contains(text, '+')",
    "email_loose": "contains(text, ' dot ') or contains(text, '(dot)') or contains(text, '[dot]')",
    "phone_loose": "rlike(text, '[0-9]{3}[ .-][0-9]{4}')",
    "id_loose": "rlike(text, '[0-9]-[0-9]{2}-[0-9]')",
    "iban_loose": "rlike(text, '[A-Z]{2}[0-9]{2}')",
}
VALID = {
    "email": "true",
    "ip": """forall(split(x.value, '[.]'), p -> length(trim(leading '0' from p)) <= 3
             and coalesce(try_cast(trim(leading '0' from p) as int), 0) <= 255)""",
    "card": """length(translate(x.value, ' -', '')) between 12 and 19
               and aggregate(sequence(1, length(translate(x.value, ' -', ''))), 0, (s, i) -> s
                   + cast(substr(translate(x.value, ' -', ''), -i, 1) as int) * (2 - i % 2)
                   - if(i % 2 = 0 and substr(translate(x.value, ' -', ''), -i, 1) > '4', 9, 0)) % 10 = 0""",
    "phone": "length(translate(x.value, '+ ().-', '')) between 9 and 15",
}
#: What each labeler looks for: 1, -1 or 0 (no vote) for a candidate x.
GAZETTEER = "com|org|net|edu|gov|io|de|fr|es|info"
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
NEAR = "(?i)mail|contact|phone|tel[.:]|call|fax|mobile|card|visa|account|iban|ssn|server|host|login|address|addr"
FAR = "(?i)version|release|page|isbn|order|figure|section|table|chapter|[$€£#=/]"
LABELERS = {
    "strict": "if(x.strict, 1, if(x.form in ('email', 'ip', 'card', 'phone'), -1, 0))",
    "shape": """case when x.form like 'email%' then if(length(x.value) <= 254, 1, -1)
                when x.form = 'ip' then if(rlike(x.value, '(^|[.])0[0-9]'), -1, 1)
                when x.form = 'iban_loose' then if(rlike(x.value, '[0-9]{6}'), 1, -1)
                else if(rlike(x.value, '([0-9])(?:[ .-]?\\\\1){6}'), -1, if(length(x.value) > 40, -1, 1)) end""",
    "gazetteer": f"""case when x.form like 'email%' then if(rlike(lower(x.value), '(?:[.]| dot |.dot. ?)(?:{GAZETTEER})$'), 1, -1)
                when x.form = 'card' then if(rlike(x.value, '{ISSUERS}'), 1, -1)
                when x.form = 'ip' then if(rlike(x.value, '^(?:0|127|255)[.]'), -1, 1) else 0 end""",
    "near": f"if(rlike(x.before, '{NEAR}'), 1, 0)",
    "far": f"if(rlike(right(x.before, 16), '{FAR}'), -1, 0)",
}
#: Features of the final classifier, each with few values.
FEATURES = {
    "form": "x.form",
    "length": "cast(least(length(x.value) div 6, 6) as string)",
    "digits": "cast(10 * length(translate(x.value, translate(x.value, '0123456789', ''), '')) div length(x.value) as string)",
    "left": "case when x.before = '' then 'edge' when rlike(x.before, '[ \\\\n]$') then 'space' when rlike(x.before, '[A-Za-z0-9]$') then 'word' else 'mark' end",
    "right": "case when x.after = '' then 'edge' when rlike(x.after, '^[ \\\\n]') then 'space' when rlike(x.after, '^[A-Za-z0-9]') then 'word' else 'mark' end",
    "near": f"if(rlike(x.before, '{NEAR}'), 'yes', 'no')",
}
#: Rounds of expectation-maximisation end when no posterior moves by more.
TOLERANCE = 1e-6


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, the strict spans of each kind, and the other candidates of each row of ``docs``."""
    df = plain(docs)
    for form, pattern in [*STRICT.items(), *LOOSE.items()]:
        df = with_matches(df, form, pattern, F.expr(GUARDS[form]))
    for kind in KINDS:
        df = df.withColumn(f"ok_{kind}", F.expr(f"filter({kind}, x -> {VALID[kind]})"))
    parts = []
    for form in [*STRICT, *LOOSE]:
        strict = f"exists(ok_{form}, y -> y.start = x.start)" if form in STRICT else "false"
        parts.append(
            f"""transform({form}, x -> named_struct('form', '{form}', 'start', x.start, 'stop', x.stop, 'value', x.value,
                'strict', {strict}, 'before', substr(text, greatest(1, x.start - 39), least(40, x.start)),
                'after', substr(text, x.stop + 1, 10)))"""
        )
    # Single numbers are no candidates: a card form needs as many digits as the shortest card or phone.
    every = f"filter(concat({', '.join(parts)}), x -> x.strict or x.form <> 'card' or length(translate(x.value, ' -', '')) between 9 and 24)"
    return df.withColumn("every", F.expr(every)).select("doc_id", *[f"ok_{k}" for k in KINDS], "every")


def voted(found: DataFrame) -> DataFrame:
    """A row per candidate: doc_id, place, votes and features."""
    rows = found.select("doc_id", F.posexplode("every").alias("place", "x"))
    votes = F.array(*[F.expr(f"cast({v} as int)") for v in LABELERS.values()])
    features = F.array(*[F.expr(f) for f in FEATURES.values()])
    return rows.select("doc_id", "x.strict", "x.form", "x.start", "x.stop", votes.alias("votes"), features.alias("features"))


def reliabilities(patterns: dict[tuple, float]) -> tuple[dict[tuple, float], list[dict]]:
    """Posterior of each vote pattern and, per labeler, P(vote | personal) and P(vote | not).

    ``patterns``: number of candidates with each tuple of votes, at most 3 to the power of the labelers.
    """
    post = {}
    for votes in patterns:
        sides = [v for v in votes if v]
        post[votes] = (1 + sum(v > 0 for v in sides)) / (2 + len(sides))
    total = sum(patterns.values())
    tables: list[dict] = []
    while patterns:
        mass = {1: 1.0, 0: 1.0}
        for votes, n in patterns.items():
            mass[1] += n * post[votes]
            mass[0] += n * (1 - post[votes])
        tables = []
        for k in range(len(LABELERS)):
            counts = {(y, v): 1.0 for y in (0, 1) for v in (-1, 0, 1)}
            for votes, n in patterns.items():
                counts[1, votes[k]] += n * post[votes]
                counts[0, votes[k]] += n * (1 - post[votes])
            tables.append({(y, v): c / sum(counts[y, w] for w in (-1, 0, 1)) for (y, v), c in counts.items()})
        moved = 0.0
        for votes in patterns:
            odds = math.log(mass[1] / mass[0]) + sum(math.log(t[1, v] / t[0, v]) for t, v in zip(tables, votes))
            new = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
            moved, post[votes] = max(moved, abs(new - post[votes])), new
        if moved < TOLERANCE or not total:
            break
    return post, tables


def train(rows: DataFrame) -> tuple[float, list[dict[str, float]]]:
    """Prior log odds and, per feature, the log odds of its values.

    The candidates are summed up by votes and features, which take a fixed number of
    values, so what the driver sees doesn't grow with the documents.
    """
    counts = rows.groupBy("votes", "features").count().collect()
    patterns: dict[tuple, float] = defaultdict(float)
    for row in counts:
        patterns[tuple(row["votes"])] += row["count"]
    post, _ = reliabilities(dict(patterns))
    mass = [1.0, 1.0]
    sums: list[dict] = [defaultdict(lambda: [0.5, 0.5]) for _ in FEATURES]
    for row in counts:
        p = post[tuple(row["votes"])]
        for y, share in ((1, p), (0, 1 - p)):
            mass[y] += row["count"] * share
            for table, value in zip(sums, row["features"]):
                table[value][y] += row["count"] * share
    weights = [{v: math.log(c[1] / mass[1]) - math.log(c[0] / mass[0]) for v, c in t.items()} for t in sums]
    return math.log(mass[1] / mass[0]), weights


def log_odds(prior: float, weights: list[dict[str, float]]) -> Column:
    total = F.lit(prior)
    for n, table in enumerate(weights):
        if table:
            lookup = F.create_map(*[F.lit(x) for v, w in sorted(table.items()) for x in (v, w)])
            total = total + F.coalesce(F.try_element_at(lookup, F.get("features", n)), F.lit(0.0))
    return total


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the strict spans of each kind (ok_<kind>) and those the classifier adds, for each row of ``docs``.

    Added spans overlap no strict one. A null or empty text has no spans. Rows that repeat
    a doc_id, or have none, get their own spans; an empty table gives no rows.
    """
    found = written(candidates(docs).withColumn("row", F.monotonically_increasing_id()), "candidates")
    rows = voted(found.withColumn("doc_id", F.col("row")))
    prior, weights = train(rows)
    # A loose form is what other forms say about it: each kind's own prior is in the feature "form".
    chosen = rows.filter(~F.col("strict")).filter(log_odds(prior, weights) > 0)
    added = chosen.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop", "form")).alias("more")).withColumnRenamed("doc_id", "row")
    out = found.join(added, "row", "left")
    strict = ", ".join(f"ok_{k}" for k in KINDS)
    return out.selectExpr(
        "doc_id",
        *[f"ok_{k}" for k in KINDS],
        f"""filter(transform(coalesce(more, array()), x -> named_struct('start', x.start, 'stop', x.stop, 'kind', split_part(x.form, '_', 1))),
                x -> not exists(concat({strict}), y -> y.start < x.stop and x.start < y.stop)) added""",
    )


def digest(found: DataFrame) -> DataFrame:
    """The spans of ``personal_spans`` as counts and strings."""
    kinds = [*KINDS, "id", "iban"]
    for kind in kinds:
        found = found.withColumn(f"add_{kind}", F.expr(f"filter(added, x -> x.kind = '{kind}')"))
    strict = [f"ok_{k}" for k in KINDS]
    return found.select(
        "doc_id",
        *[F.size(f"ok_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(KINDS, strict), 256).alias("base_sha256"),
        joined([*KINDS, *kinds], [*strict, *[f"add_{k}" for k in kinds]]).alias("spans"),
    )
