"""Training sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.operators import training_sets as ops
from assaymill.session import scratch_folder
from assaymill.sources import files, sinks
from contract.registry import query
from contract.standins import Tables

LABELS = {"file0": "pert", "file1": "pert", "file2": "non_pert"}
SERIES_SQL = """
    with c as (select 'file' || (cast(substr(geo_id, 4) as int) // 10 % 3) file, geo_id from px_curated),
         s as (select case file when 'file2' then 'non_pert' else 'pert' end label, title, summary
               from c join px_series on gse = geo_id)
    select dataset, md5(txt) text_md5, label from (
        select 'title' dataset, title txt, label from s union all select 'summary', summary, label from s
        union all select 'all', title, label from s union all select 'all', summary, label from s)"""
SAMPLE_SQL = """
    with ids as (select distinct 'ctrl' as label, unnest(string_split(ctrl_ids, '|')) gsm from px_curated
                 union select 'pert', unnest(string_split(pert_ids, '|')) from px_curated),
         x as (select label, title, description, characteristics_ch1, source_name_ch1 from ids join px_sample using (gsm)),
         u as (select distinct * from (
             select 'title' as type, title txt, label from x union all select 'desc', description, label from x
             union all select 'charcs', characteristics_ch1, label from x
             union all select 'source', source_name_ch1, label from x) where txt <> '')"""
COMBINATION_ROWS = ", ".join(
    f"('{name}', '{kind}')"
    for name, kinds in {
        "title": ["title"], "desc": ["desc"], "charcs": ["charcs"], "source": ["source"],
        "charcs_desc": ["charcs", "desc"], "charcs_source": ["charcs", "source"],
        "charcs_title": ["charcs", "title"], "desc_source": ["desc", "source"], "desc_title": ["desc", "title"],
        "source_title": ["source", "title"], "charcs_desc_source": ["charcs", "desc", "source"],
        "charcs_desc_title": ["charcs", "desc", "title"], "charcs_source_title": ["charcs", "source", "title"],
        "desc_source_title": ["desc", "source", "title"], "all": ["title", "desc", "charcs", "source"],
    }.items()
    for kind in kinds
)
COMBINATION_SQL = f"""{SAMPLE_SQL}, k as (select * from (values {COMBINATION_ROWS}) v(dataset, type)),
    d as (select distinct dataset, txt, label from u join k using (type))"""


def curated_files(t: Tables):
    return t.curated.selectExpr("concat('file', cast(substr(geo_id, 4) as int) div 10 % 3) file", "geo_id")


def samples_of(t: Tables):
    return ops.sample_training_sets(t.curated, t.samples)


@query("series_training_sets", SERIES_SQL)
def series_training_sets(t: Tables):
    sets = ops.series_training_sets(curated_files(t), t.series, LABELS)
    return sets.select("dataset", F.md5("text").alias("text_md5"), "label")


@query("sample_training_sets", SAMPLE_SQL + "select type, md5(txt) text_md5, label from u")
def sample_training_sets(t: Tables):
    return samples_of(t).select("type", F.md5("text").alias("text_md5"), "label")


@query("combination_sets", COMBINATION_SQL + "select dataset, md5(txt) text_md5, label from d")
def combination_sets(t: Tables):
    return ops.combination_sets(samples_of(t)).select("dataset", F.md5("text").alias("text_md5"), "label")


@query("training_sink", COMBINATION_SQL + "select dataset, md5(txt) text_md5, label from d")
def training_sink(t: Tables):
    path = scratch_folder(t.spark, "training")
    sinks.write_training_sets(ops.combination_sets(samples_of(t)), path)
    back = t.spark.read.csv(path, schema="text string, label string, dataset string", **files.CSV)
    return back.select("dataset", F.md5("text").alias("text_md5"), "label")


@query("training_lines", COMBINATION_SQL + "select dataset, md5(txt) text_md5, label from d")
def training_lines(t: Tables):
    path = scratch_folder(t.spark, "training-lines")
    sinks.write_training_lines(ops.combination_sets(samples_of(t)), path)
    return files.read_training_lines(t.spark, path).select("dataset", F.md5("text").alias("text_md5"), "label")


@query("exact_split", """
    select cast(floor(0.8 * count(*)) as bigint) n_train, cast(count(*) - floor(0.8 * count(*)) as bigint) n_test,
           cast(0 as bigint) n_shared, cast(sum(length(text)) as bigint) chars from px_labelled""")
def exact_split(t: Tables):
    train, test = ops.exact_split(t.labelled, "doc_id", 0.8, 0)
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    per_document = sides.groupBy("doc_id").agg(
        F.sum(F.expr("int(side = 'train')")).alias("train"), F.sum(F.expr("int(side = 'test')")).alias("test"),
        F.sum(F.length("text")).alias("chars"),
    )
    return per_document.agg(
        F.sum("train").alias("n_train"), F.sum("test").alias("n_test"),
        F.sum(F.expr("bigint(train > 0 and test > 0)")).alias("n_shared"), F.sum("chars").alias("chars"),
    )
