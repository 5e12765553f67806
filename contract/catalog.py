"""Catalog scans, lookups, text predicates and id files."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions.text import assemble, direction, greek_to_words
from assaymill.operators import lookups as ops
from assaymill.operators.ordering import first_by
from assaymill.session import scratch_folder
from assaymill.sources import catalog as sources
from assaymill.sources import files, sinks
from contract.registry import query
from contract.standins import Tables

UP_SQL = " + ".join(
    f"len(regexp_extract_all(t, '(?i){p}'))" for p in ["overexp", "express", "transgen", "expos", "tg", "induc"]
)
DOWN_SQL = " + ".join(
    f"len(regexp_extract_all(t, '(?i){p}'))"
    for p in ["knock", "null", "ko", "s[hi]rna", "delet", "reduc", r"\-\/", r"\/\-", r"\+\/", r"\/\+", "cre", "flox",
              "mut", "defici"]
)
GREEK_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(replace(replace(replace({c}, 'α', 'alpha'), 'β', 'beta'), 'γ',"
    r" 'gamma'), '(?i)\s*(alpha)', ' \1', 'g'), '(?i)\s*(beta)', ' \1', 'g'), '(?i)\s*(gamma)', ' \1', 'g')"
)
SAMPLE_COLUMNS = ops.SAMPLE_TEXT_COLUMNS


def catalog_of(t: Tables) -> sources.Catalog:
    return sources.Catalog(t.series, t.samples, t.links, t.platforms, t.series_platforms)


def hit_sql(columns: list[str], keyword: str) -> str:
    return "(" + " or ".join(f"coalesce(contains(lower({c}), '{keyword}'), false)" for c in columns) + ")"


@query("scan_id_list", "select gse from px_series")
def scan_id_list(t: Tables):
    path = scratch_folder(t.spark, "ids")
    t.series.select("gse").write.text(path)
    return files.scan_id_list(t.spark, path, 8)


@query("scan_all_series", "select gse from px_series")
def scan_all_series(t: Tables):
    return sources.scan_all_series(catalog_of(t))


@query("scan_catalog", """
    select 'gse' name, count(*) n, count(distinct gse) n_keys, cast(sum(length(summary)) as bigint) chars from px_series
    union all select 'gsm', count(*), count(distinct gsm), cast(sum(length(title)) as bigint) from px_sample
    union all select 'gse_gsm', count(*), count(distinct gse), cast(sum(length(gsm)) as bigint) from px_link
    union all select 'gpl', count(*), count(distinct gpl), cast(sum(length(technology)) as bigint) from px_platform
    union all select 'gse_gpl', count(*), count(distinct gse), cast(sum(length(gpl)) as bigint) from px_series_platform""")
def scan_catalog(t: Tables):
    path = scratch_folder(t.spark, "catalog")
    sources.write_catalog(catalog_of(t), path)
    tables = sources.scan_catalog(t.spark, path)
    shape = [("gse", "gse", "summary"), ("gsm", "gsm", "title"), ("gse_gsm", "gse", "gsm"),
             ("gpl", "gpl", "technology"), ("gse_gpl", "gse", "gpl")]
    parts = [
        getattr(tables, name).agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("n_keys"),
            F.sum(F.length(text)).alias("chars"),
        )
        for name, key, text in shape
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("classified_csv_roundtrip", "select * from px_pairs")
def classified_csv_roundtrip(t: Tables):
    path = scratch_folder(t.spark, "pairs")
    t.pairs.write.csv(path, header=True)
    return files.read_pairs(t.spark, path)


@query("classified_sink", """
    select * from px_pairs union all select * from px_pairs where false""")
def classified_sink(t: Tables):
    path, empty = scratch_folder(t.spark, "classified"), scratch_folder(t.spark, "none")
    sinks.write_pairs(t.pairs, path)
    sinks.write_pairs(t.pairs.filter("direction = 'none'"), empty)
    return files.read_pairs(t.spark, path).unionByName(files.read_pairs(t.spark, empty))


@query("curated_label_scan", "select * from px_curated")
def curated_label_scan(t: Tables):
    path = scratch_folder(t.spark, "curated")
    t.curated.write.csv(path, header=True)
    return files.read_curated(t.spark, path)


@query("organism_filter", """
    select gsm, organism_ch1, md5(coalesce(description, '')) description_md5 from px_sample
    where lower(organism_ch1) = 'mus musculus'""")
def organism_filter(t: Tables):
    kept = ops.organism_is(t.samples, "MUS musculus")
    return kept.select("gsm", "organism_ch1", F.md5(F.coalesce("description", F.lit(""))).alias("description_md5"))


@query("keyword_filter", f"""
    select gsm from px_sample where {hit_sql(SAMPLE_COLUMNS, 'lang: en')}
    and ({hit_sql(SAMPLE_COLUMNS, 'ation')} or {hit_sql(SAMPLE_COLUMNS, 'src1')})""")
def keyword_filter(t: Tables):
    return ops.match_keywords(t.samples, SAMPLE_COLUMNS, ["lang: EN"], ["ation", "SRC1"]).select("gsm")


FALLBACK = f"""
    with h as (select gse, gsm from px_link join px_sample using (gsm)
               where {hit_sql(SAMPLE_COLUMNS, 'overexp')} or {hit_sql(SAMPLE_COLUMNS, 'src3')}),
         f as (select gse, gsm from px_link join px_series using (gse)
               where ({hit_sql(['px_series.title', 'summary'], 'overexp')} or {hit_sql(['px_series.title', 'summary'], 'src3')})
                 and gse not in (select gse from h))
    select gse, gsm from h union all select gse, gsm from f"""


@query("keyword_fallback", FALLBACK)
def keyword_fallback(t: Tables):
    return ops.keyword_fallback(t.samples, t.series, t.links, [], ["overexp", "src3"])


@query("greek_repair", f"""
    select gse, {GREEK_SQL.format(c='title')} title, md5({GREEK_SQL.format(c='summary')}) summary_md5 from px_series""")
def greek_repair(t: Tables):
    return t.series.select(
        "gse", greek_to_words(F.col("title")).alias("title"),
        F.md5(greek_to_words(F.col("summary"))).alias("summary_md5"),
    )


@query("assemble_text", """
    select gse, md5(title || ' ' || summary || coalesce(' ' || overall_design, '')) text_md5,
           length(title || ' ' || summary || coalesce(' ' || overall_design, '')) chars from px_series""")
def assemble_text(t: Tables):
    text = assemble(F.col("title"), F.col("summary"), F.col("overall_design"))
    return t.series.select("gse", F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("chars"))


@query("direction_vote", f"""
    select gse, case when {UP_SQL} > {DOWN_SQL} then '+' else '-' end direction
    from (select gse, title || ' ' || summary || coalesce(' ' || overall_design, '') t from px_series)""")
def direction_vote(t: Tables):
    text = assemble(F.col("title"), F.col("summary"), F.col("overall_design"))
    return t.series.select("gse", text.alias("text")).select("gse", direction(F.col("text")).alias("direction"))


@query("pair_reshape", """
    select gse_id, organism, direction, pert_agent, microarray_grouping as grouping,
           len(string_split(ctrl_gsm_ids, '|')) n_ctrl, len(string_split(pert_gsm_ids, '|')) n_pert,
           split_part(ctrl_gsm_ids, '|', 1) first_ctrl, split_part(pert_gsm_ids, '|', -1) last_pert from px_pairs""")
def pair_reshape(t: Tables):
    return ops.explode_pairs(t.pairs).select(
        "gse_id", "organism", "direction", "pert_agent", "grouping",
        F.size("ctrl_gsm_ids").cast("bigint").alias("n_ctrl"), F.size("pert_gsm_ids").cast("bigint").alias("n_pert"),
        F.col("ctrl_gsm_ids")[0].alias("first_ctrl"), F.element_at("pert_gsm_ids", -1).alias("last_pert"),
    )


@query("drop_missing", """
    select gsm, description is null no_description, length(treatment_protocol_ch1) chars
    from px_sample where gsm is not null and treatment_protocol_ch1 is not null""")
def drop_missing(t: Tables):
    kept = ops.drop_missing(t.samples, ["gsm", "treatment_protocol_ch1"])
    return kept.select("gsm", F.col("description").isNull().alias("no_description"),
                       F.length("treatment_protocol_ch1").cast("bigint").alias("chars"))


@query("series_sample_join", """
    select gse, gsm, organism_ch1, md5(s.summary) summary_md5
    from px_series s join px_link using (gse) join px_sample using (gsm)""")
def series_sample_join(t: Tables):
    joined = ops.series_samples(catalog_of(t))
    return joined.select("gse", "gsm", "organism_ch1", F.md5("summary").alias("summary_md5"))


@query("link_sample_join", """
    select gse, gsm, gpl, title, md5(coalesce(description, '')) description_md5 from px_link join px_sample using (gsm)""")
def link_sample_join(t: Tables):
    return ops.linked_samples(catalog_of(t)).select(
        "gse", "gsm", "gpl", "title", F.md5(F.coalesce("description", F.lit(""))).alias("description_md5"))


@query("link_sample_series_join", """
    select gse, gsm, x.title, s.title series_title, md5(s.summary) summary_md5
    from px_link join px_sample x using (gsm) join px_series s using (gse)""")
def link_sample_series_join(t: Tables):
    joined = ops.linked_samples_with_series(catalog_of(t))
    return joined.select("gse", "gsm", "title", "series_title", F.md5("series_summary").alias("summary_md5"))


@query("platform_lookup", """
    select p.gse_id, x.organism_ch1 organism, technology,
           (select min(gpl) from px_series_platform sp where sp.gse = p.gse_id) gpl
    from px_pairs p join px_sample x on x.gsm = split_part(p.ctrl_gsm_ids, '|', 1) join px_platform using (gpl)""")
def platform_lookup(t: Tables):
    return ops.platform_of(t.pairs, catalog_of(t)).select("gse_id", "organism", "technology", "gpl")


@query("first_row", """
    select gse, gsm, organism_ch1 from (
        select gse, gsm, organism_ch1, row_number() over (partition by gse order by gsm) r
        from px_link join px_sample using (gsm)) where r = 1""")
def first_row(t: Tables):
    rows = t.links.join(t.samples.select("gsm", "organism_ch1"), "gsm")
    return first_by(rows.select("gse", "gsm", "organism_ch1"), ["gse"], ["gsm"])


@query("curated_lookup", """
    select gsm, title, source_name_ch1 from px_sample where gsm in (
        select unnest(string_split(ctrl_ids, '|')) from px_curated
        union all select unnest(string_split(pert_ids, '|')) from px_curated)""")
def curated_lookup(t: Tables):
    ids = t.curated.select(F.explode(F.split(F.concat_ws("|", "ctrl_ids", "pert_ids"), "\\|")).alias("gsm"))
    return ops.lookup(ids, t.samples, "gsm").select("gsm", "title", "source_name_ch1")


@query("series_text", f"""
    select gse, organism, md5(t) text_md5, case when {UP_SQL} > {DOWN_SQL} then '+' else '-' end direction from (
        select gse, organism_ch1 organism, title || ' ' || summary || coalesce(' ' || overall_design, '') t
        from px_series join (
            select gse, organism_ch1, row_number() over (partition by gse order by gsm) r
            from px_link join px_sample using (gsm)) using (gse) where r = 1)""")
def series_text(t: Tables):
    return ops.series_text(catalog_of(t)).select("gse", "organism", F.md5("text").alias("text_md5"), "direction")
