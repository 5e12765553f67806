"""Concepts, agents and pair filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions.text import clean_agent
from assaymill.operators import agents as ops
from assaymill.session import scratch_folder
from assaymill.sources import files
from contract.registry import query
from contract.standins import Tables

FIT = "contains(semantic_types, 'Amino Acid') and not contains(semantic_types, 'Pharmacologic Substance')"
HITS_SQL = r"""
    tok as (select gse, unnest(ws) term, unnest(range(len(ws))) as position
            from (select gse, regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}_]+') ws from px_series)),
    {name} as (select gse, cast(position as int) as position, 1 n_words, concept, semantic_types from tok join px_terms using (term))"""


@query("concept_match", "with " + HITS_SQL.format(column="summary", name="hits") + " select * from hits")
def concept_match(t: Tables):
    return ops.match_concepts(t.series.select("gse", "summary"), "summary", t.terms)


def phrases(t: Tables):
    """All runs of two words in the benchmark texts."""
    w = F.regexp_extract_all(F.lower("text"), F.lit(ops.ANY_WORD), F.lit(0))
    pairs = t.table("benchmark").select(w.alias("w")).filter("size(w) > 1").selectExpr(
        "explode(transform(sequence(0, size(w) - 2), i -> concat(w[i], ' ', w[i + 1]))) term")
    return pairs.distinct()


@query("concept_phrases", r"""
    with ws as (select gse, regexp_extract_all(lower(summary), '[\p{L}\p{N}_]+') ws from px_series),
    p as (select distinct unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) term from (
              select regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') w from benchmark))
    select gse, cast(i as int) as position, 'C ' || term concept from (
        select gse, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) term,
               unnest(range(0, len(ws) - 1)) i from ws) join p using (term)""")
def concept_phrases(t: Tables):
    terms = phrases(t).selectExpr("term", "concat('C ', term) concept", "'Finding' semantic_types")
    return ops.match_concepts(t.series.select("gse", "summary"), "summary", terms, max_n=2).select(
        "gse", "position", "concept")


@query("concept_hits", "with " + HITS_SQL.format(column="summary", name="hits") + """
    select gse as document, cast(position as bigint) as position, lower(concept) mention, concept, semantic_types from hits""")
def concept_hits(t: Tables):
    path = scratch_folder(t.spark, "hits")
    hits = concept_match(t).selectExpr("gse document", "position", "lower(concept) mention", "concept", "semantic_types")
    hits.write.csv(path, sep="\t", header=True)
    return files.read_concept_hits(t.spark, path)


@query("first_protein_concept", "with " + HITS_SQL.format(column="summary", name="hits") + f"""
    select gse, min_by(concept, position) concept from hits where {FIT} group by gse""")
def first_protein_concept(t: Tables):
    return ops.first_hit(concept_match(t), ["gse"], ["position"])


@query("clean_agent", r"""
    select doc_id, md5(replace(regexp_replace(text || ' Superfamily (p53) [a,b]', '[!#$&''()*+,/:;=?@\[\]]', ' ', 'g'),
                               'Superfamily', '')) cleaned from documents""")
def cleaned_agents(t: Tables):
    text = F.concat("text", F.lit(" Superfamily (p53) [a,b]"))
    return t.table("documents").select("doc_id", F.md5(clean_agent(text)).alias("cleaned"))


@query("resolve_agent", "with " + HITS_SQL.format(column="summary", name="in_text") + ","
       + HITS_SQL.format(column="title", name="in_title").replace("tok as", "tok2 as").replace("from tok ", "from tok2 ") + f"""
    , a as (select gse, min_by(concept, position) concept from in_text where {FIT} group by gse),
    b as (select gse, min_by(concept, position) concept from in_title where {FIT} group by gse),
    sym as (select alias, min_by(symbol, hit) symbol from px_alias group by alias)
    select gse, coalesce(symbol, concept) pert_agent
    from (select gse, coalesce(a.concept, b.concept) concept from px_series left join a using (gse) left join b using (gse))
    left join sym on alias = concept""")
def resolve_agent(t: Tables):
    texts = t.series.selectExpr("gse", "summary text", "title")
    return ops.resolve_agent(texts, t.terms, t.aliases, ["gse"])


PHRASE_HITS = r"""
    {name} as (select gse, i as position, n, upper(term) concept from (
        select gse, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) term,
               unnest(range(0, len(ws) - 1)) i, 2 n from {name}_ws
        union all select gse, unnest(ws), unnest(range(len(ws))), 1 from {name}_ws)
        where term in (select term from dict))"""
PHRASE_WORDS = r"{name}_ws as (select gse, regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}_]+') ws from px_series)"


@query("resolve_phrases", r"""
    with dict as (select distinct unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) term from (
              select regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') w from benchmark) union select term from px_terms), """
       + ", ".join(PHRASE_WORDS.format(name=n, column=c) + "," + PHRASE_HITS.format(name=n) for n, c in (("a", "summary"), ("b", "title")))
       + """
    , fa as (select gse, min_by(concept, (position, -n)) concept from a group by gse),
    fb as (select gse, min_by(concept, (position, -n)) concept from b group by gse),
    sym as (select alias, min_by(symbol, hit) symbol from px_alias group by alias)
    select gse, coalesce(symbol, concept) pert_agent
    from (select gse, coalesce(fa.concept, fb.concept) concept from px_series left join fa using (gse) left join fb using (gse))
    left join sym on alias = concept""")
def resolve_phrases(t: Tables):
    """Agents from a dictionary of single words and runs of two, the longer one first where both begin."""
    terms = phrases(t).union(t.terms.select("term")).distinct().selectExpr(
        "term", "upper(term) concept", "'Amino Acid, Peptide, or Protein' semantic_types")
    texts = t.series.selectExpr("gse", "summary text", "title")
    return ops.resolve_agent(texts, terms, t.aliases, ["gse"])


@query("agent_filter", "select gse_id, pert_agent from px_pairs where contains('gene3x', lower(pert_agent)) or contains(lower(pert_agent), 'gene3x')")
def agent_filter(t: Tables):
    return ops.filter_agent(t.pairs, "GENE3x").select("gse_id", "pert_agent")


@query("flag_filter", """
    select gse_id, is_pert_title and is_pert_summary strict from px_pairs where is_pert_title or is_pert_summary""")
def flag_filter(t: Tables):
    strict = ops.filter_flags(t.pairs, True).select("gse_id", F.lit(True).alias("strict"))
    loose = ops.filter_flags(t.pairs, False).select("gse_id")
    return loose.join(strict, "gse_id", "left").select("gse_id", F.coalesce("strict", F.lit(False)).alias("strict"))
