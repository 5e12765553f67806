"""Finding the perturbing agent of a text with a term dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assaymill.functions.text import clean_agent

HAS, LACKS = "Amino Acid", "Pharmacologic Substance"
ANY_WORD = r"[\p{L}\p{N}_]+"


def match_concepts(df: DataFrame, text: str, terms: DataFrame, max_n: int = 1) -> DataFrame:
    """Dictionary hits of every row: its other columns, then position, n_words, concept, semantic_types.

    ``terms`` holds (term, concept, semantic_types), terms in lower case with single
    blanks, each of at most ``max_n`` words. Word runs join the dictionary on equality;
    Spark broadcasts the dictionary when its measured size allows and shuffles otherwise.
    """
    keys = [c for c in df.columns if c != text]
    tokens = F.regexp_extract_all(F.lower(F.col(text)), F.lit(ANY_WORD), F.lit(0))
    placed = df.select(*keys, tokens.alias("w"))
    if max_n == 1:
        runs = placed.select(*keys, F.posexplode("w").alias("position", "term")).withColumn("n_words", F.lit(1))
    else:
        sizes = F.sequence(F.lit(1), F.least(F.size("w"), F.lit(max_n)))
        spans = placed.filter(F.size("w") > 0).select(*keys, "w", F.explode(sizes).alias("n_words"))
        starts = F.sequence(F.lit(0), F.size("w") - F.col("n_words"))
        runs = spans.select(*keys, "w", "n_words", F.explode(starts).alias("position")).select(
            *keys, "n_words", "position",
            F.array_join(F.slice("w", F.col("position") + 1, F.col("n_words")), " ").alias("term"),
        )
    return runs.join(terms, "term").select(*keys, "position", "n_words", "concept", "semantic_types")


def first_hit(df: DataFrame, keys: list[str], order: list[str], has: str = HAS, lacks: str = LACKS) -> DataFrame:
    """The first concept per key whose semantic types contain ``has`` and not ``lacks``."""
    types = F.col("semantic_types")
    fit = df.filter(F.contains(types, F.lit(has)) & ~F.contains(types, F.lit(lacks)))
    return fit.groupBy(*keys).agg(F.min_by("concept", F.struct(*order, "concept")).alias("concept"))


def first_symbols(aliases: DataFrame) -> DataFrame:
    """The best-ranked symbol of each alias (alias, symbol, hit)."""
    return aliases.groupBy("alias").agg(F.min_by("symbol", F.struct("hit", "symbol")).alias("symbol"))


def resolve_agent(df: DataFrame, terms: DataFrame, aliases: DataFrame, keys: list[str], max_n: int | None = None) -> DataFrame:
    """(keys, pert_agent) for rows of (keys, text, title).

    The first protein concept of the text, else of the title, is cleaned and replaced
    by its gene symbol when the alias table knows one. Both texts are searched in one
    pass; rows without a concept keep a NULL agent. Terms of up to ``max_n`` words are
    looked for, those as long as the longest of the dictionary if it is not given.
    """
    if max_n is None:
        max_n = terms.agg(F.max(F.size(F.split("term", " ")))).first()[0] or 1
    sources = F.array(
        F.struct(F.lit(0).alias("source"), F.col("text").alias("t")),
        F.struct(F.lit(1).alias("source"), F.col("title").alias("t")),
    )
    texts = df.select(*keys, F.explode(sources).alias("s")).select(*keys, "s.source", "s.t")
    longest_first = F.col("n_words") * -1
    hits = match_concepts(texts, "t", terms, max_n).withColumn("rank", longest_first)
    found = first_hit(hits, keys, ["source", "position", "rank"]).withColumn("alias", clean_agent(F.col("concept")))
    named = found.join(first_symbols(aliases), "alias", "left")
    agents = named.select(*keys, F.coalesce("symbol", "alias").alias("pert_agent"))
    return df.select(*keys).join(agents, keys, "left")


def filter_agent(df: DataFrame, target: str, keep_blank: bool = True) -> DataFrame:
    """Agents that contain the target or are contained in it, ignoring case.

    A blank agent is contained in any target and passes unless ``keep_blank`` is off.
    """
    agent = F.lower(F.coalesce("pert_agent", F.lit("")))
    wanted = F.lit(target.lower())
    rule = F.contains(agent, wanted) | F.contains(wanted, agent)
    return df.filter(rule if keep_blank else rule & (agent != ""))


def filter_flags(df: DataFrame, strict: bool) -> DataFrame:
    """Pairs whose title and summary (strict), or either, tell of a perturbation."""
    title, summary = F.col("is_pert_title"), F.col("is_pert_summary")
    return df.filter(title & summary if strict else title | summary)
