"""Routing pairs to their analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from assaymill.operators import lookups, routing as ops
from assaymill.plans.analyse import analyse, route_pairs
from assaymill.session import cut, kept, scratch_folder
from assaymill.sources import sinks
from contract.catalog import catalog_of
from contract.registry import query
from contract.standins import Tables

ROUTED_SQL = """
    plat as (select p.* replace (x.organism_ch1 as organism), technology from px_pairs p
             join px_sample x on x.gsm = split_part(p.ctrl_gsm_ids, '|', 1) join px_platform using (gpl)),
    org as (select *, case lower(organism) when 'homo sapiens' then 'human' when 'mus musculus' then 'mouse' end held from plat),
    wanted as (select gse_id, held, unnest(string_split(ctrl_gsm_ids || '|' || pert_gsm_ids, '|')) sample,
                      unnest(range(len(string_split(ctrl_gsm_ids || '|' || pert_gsm_ids, '|')))) pos from org),
    have as (select distinct sample, case lower(organism_ch1) when 'homo sapiens' then 'human'
                    when 'mus musculus' then 'mouse' end held from px_matrix join px_sample on gsm = sample),
    present as (select gse_id, bool_and(coalesce(h.sample is not null, false)) in_matrix
                from wanted w left join have h on h.sample = w.sample and h.held = w.held group by gse_id),
    runs as (select gse_id, coalesce(string_agg(run, '|' order by pos), '') sra_ids
             from wanted left join px_runs using (sample) group by gse_id),
    routed as (select *, case when technology in ('in situ oligonucleotide', 'oligonucleotide beads', 'spotted DNA/cDNA',
                      'spotted oligonucleotide', 'mixed spotted oligonucleotide/cDNA') then 'microarray'
                      when technology = 'high-throughput sequencing' and in_matrix then 'rna_seq'
                      when technology = 'high-throughput sequencing' then 'falco' else 'unknown' end route
               from org join present using (gse_id) join runs using (gse_id))"""


def with_organism(t: Tables, matrix: DataFrame):
    return matrix.join(t.samples.selectExpr("gsm sample", "organism_ch1 organism"), "sample")


def matrix_with_organism(t: Tables):
    return with_organism(t, t.matrix)


def routed(t: Tables):
    pairs = lookups.platform_of(t.pairs, catalog_of(t))
    present = ops.all_present(pairs, matrix_with_organism(t))
    return present.withColumn("route", ops.route(F.col("technology"), F.col("in_matrix")))


@query("technology_route", "with " + ROUTED_SQL + " select gse_id, technology, route from routed")
def technology_route(t: Tables):
    return routed(t).select("gse_id", "technology", "route")


@query("organism_matrix", """
    select gsm, case lower(organism_ch1) when 'homo sapiens' then 'human' when 'mus musculus' then 'mouse' end matrix
    from px_sample""")
def organism_matrix(t: Tables):
    return t.samples.select("gsm", ops.matrix_organism(F.col("organism_ch1")).alias("matrix"))


@query("all_samples_present", "with " + ROUTED_SQL + " select gse_id, in_matrix from routed")
def all_samples_present(t: Tables):
    return routed(t).select("gse_id", "in_matrix")


@query("run_lookup", "with " + ROUTED_SQL + " select gse_id, sra_ids from routed")
def run_lookup(t: Tables):
    return ops.runs_of(t.pairs, t.runs).select("gse_id", "sra_ids")


def route_frames(t: Tables) -> dict:
    pairs = cut(routed(t))
    falco = ops.runs_of(pairs.filter("route = 'falco'"), t.runs).withColumn(
        "grouping", ops.sequencing_grouping("ctrl_gsm_ids", "pert_gsm_ids"))
    return {
        "microarray": pairs.filter("route = 'microarray'").select("gse_id", "pert_agent", "organism", "direction"),
        "rna_seq": pairs.filter("route = 'rna_seq'").select("gse_id", "pert_agent", "organism", "direction"),
        "falco": falco.select("gse_id", "pert_agent", "sra_ids", "grouping", "organism"),
        "unknown": pairs.filter("route = 'unknown'").select("gse_id", "technology"),
    }


UNION_SQL = """
    select gse_id, route, case when route <> 'unknown' then {blank} end pert_agent,
           case when route <> 'unknown' then organism end organism,
           case when route in ('microarray', 'rna_seq') then direction end direction,
           case when route = 'falco' then {runs} end sra_ids,
           case when route = 'falco' then regexp_replace(ctrl_gsm_ids, 'GSM[0-9]+', '0', 'g').replace('|', '') ||
                regexp_replace(pert_gsm_ids, 'GSM[0-9]+', '1', 'g').replace('|', '') end as grouping,
           case when route = 'unknown' then technology end technology from routed"""


@query("route_union", "with " + ROUTED_SQL + UNION_SQL.format(blank="pert_agent", runs="sra_ids"))
def route_union(t: Tables):
    frames = [df.withColumn("route", F.lit(name)) for name, df in route_frames(t).items()]
    return ops.union_routes(*frames)


@query("routed_sink", "with " + ROUTED_SQL + UNION_SQL.format(
    blank="nullif(pert_agent, '')", runs="nullif(sra_ids, '')"))
def routed_sink(t: Tables):
    path = scratch_folder(t.spark, "routes")
    frames = route_frames(t)
    sinks.write_routes(frames, path)
    back = [
        t.spark.read.csv(f"{path}/{name}", schema=df.schema, **sinks.QUOTED).withColumn("route", F.lit(name))
        for name, df in frames.items()
    ]
    return ops.union_routes(*back)


def with_faulty(t: Tables):
    """The pairs, and as many again whose perturbed list is blank, is missing, or whose control list is missing."""
    missing = F.lit(None).cast("string")
    pairs = kept(t.pairs, "pairs")
    faulty = [
        pairs.withColumn(column, value).withColumn("gse_id", F.concat(F.col("gse_id"), F.lit(mark)))
        for column, value, mark in (("pert_gsm_ids", F.lit(""), "E"), ("pert_gsm_ids", missing, "N"), ("ctrl_gsm_ids", missing, "C"))
    ]
    return reduce(lambda a, b: a.unionByName(b), [pairs, *faulty])


@query("route_annotate", "with " + ROUTED_SQL + """
    select gse_id, pert_agent, organism, direction, route, cast(null as varchar) command from routed
    union all select gse_id || unnest(['E', 'N']), pert_agent, organism, direction, 'error', 'no perturbed sample' from routed
    union all select gse_id || 'C', pert_agent, null, direction, 'error', 'no platform for the first control sample' from routed""")
def route_annotate(t: Tables):
    routed_pairs = route_pairs(with_faulty(t), catalog_of(t), matrix_with_organism(t))
    return routed_pairs.select("gse_id", "pert_agent", "organism", "direction", "route", "command")


@query("analyse_pairs")
def analyse_pairs(t: Tables):
    # Written once: every use would sum all line items anew.
    matrix = kept(t.matrix, "matrix")
    arrays = matrix.selectExpr("gene probe", "sample", "count value", "concat('SYM', cast(substr(gene, 2) as int) div 2) symbol")
    frames = analyse(with_faulty(t), catalog_of(t), with_organism(t, matrix), t.runs, arrays, use_flags=False)
    return ops.union_routes(*[
        df.selectExpr("gse_id").groupBy("gse_id").agg(F.count(F.lit(1)).alias("n")).withColumn("route", F.lit(name))
        for name, df in frames.items()])
