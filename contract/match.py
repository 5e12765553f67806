"""Clustering and pairing on the study stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions.similarity import jaro_winkler
from assaymill.functions.text import STOP_WORDS, time_value
from assaymill.operators import clustering, matching as ops
from assaymill.session import scratch_folder
from assaymill.sources import files, sinks
from contract.registry import query, r6
from contract.standins import Tables

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
TIME_SQL = (
    r"try_cast(regexp_extract(regexp_extract({c}, '(?i)[0-9]+\s*(d(ays?)?|h((ours?)|(r|rs)?))'), '[0-9]+') as bigint)"
)
GROUPS_SQL = """
    grp as (select gse, case when type = 'ctrl' then 'ctrl' else 'pert' end as role, cluster, count(*) n,
                   min_by(text, gsm) txt from {source} group by all),
    pairs as (select c.gse, c.cluster ctrl_cluster, c.txt ctrl_text, p.cluster pert_cluster, p.txt pert_text
              from grp c join grp p on p.gse = c.gse and c.role = 'ctrl' and p.role = 'pert' and p.n > 1)"""
BEST_SQL = f"""
    timed as (select *, {TIME_SQL.format(c='pert_text')} pt, coalesce({TIME_SQL.format(c='ctrl_text')}, 0) ct,
                     round(jaro_winkler_similarity(ctrl_text, pert_text), 9) jw,
                     max({TIME_SQL.format(c='pert_text')} is not null) over (partition by gse) has_time from pairs),
    ranked as (select gse, ctrl_cluster, pert_cluster, case when has_time then pt - ct end diff,
                      case when not has_time then jw end score,
                      row_number() over (partition by gse, ctrl_cluster
                          order by case when has_time then pt - ct else jw end desc, pert_cluster) r
               from timed where not has_time or pt - ct >= 0),
    best as (select gse, ctrl_cluster, pert_cluster, diff, score from ranked where r = 1)"""
CLUSTER_SQL = rf"""
    with recursive both_types as (select gse from px_study group by gse
                                  having bool_or(type = 'ctrl') and bool_or(type = 'pert')),
    s as (select * from px_study where gse in (select gse from both_types)),
    tok as (select gse, gsm, unnest(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'),
                                                lambda w: not list_contains({STOP_SQL}, w))) token from s),
    tf as (select gse, gsm, token, count(*) tf from tok group by all),
    ns as (select gse, count(*) n from s group by gse),
    dfs as (select gse, token, count(*) df from tf group by all),
    w as (select gse, gsm, token, tf * (ln((1.0 + n) / (1 + df)) + 1) w
          from tf join dfs using (gse, token) join ns using (gse)),
    u as (select gse, gsm, token, w / sqrt(sum(w * w) over (partition by gse, gsm)) w from w),
    near as (select a.gse, a.gsm x, b.gsm y, round(sqrt(greatest(2 - 2 * sum(a.w * b.w), 0)), 9) d
             from u a join u b on a.gse = b.gse and a.token = b.token and a.gsm <> b.gsm group by all),
    edges as (select gse, k, x, y from near, range(1, 10) t(k) where d <= k / 10.0),
    reach(gse, k, root, node) as (
        select distinct gse, k, x, x from edges
        union
        select r.gse, r.k, r.root, e.y from reach r join edges e on e.gse = r.gse and e.k = r.k and e.x = r.node),
    lab as (select gse, k, node gsm, min(root) label from reach group by all),
    placed as (select s.gse, s.gsm, s.text, s.type, t.k, label from s cross join range(1, 10) t(k)
               left join lab on lab.gse = s.gse and lab.gsm = s.gsm and lab.k = t.k),
    named as (select *, case when label is null then -1
                             else dense_rank() over (partition by gse, k order by label nulls last) - 1 end cluster from placed),
    sizes as (select gse, k, cluster, count(*) filter (where type = 'ctrl') nc,
                     count(*) filter (where type <> 'ctrl') np from named group by all),
    ok as (select gse, k from sizes group by all
           having count(*) filter (where cluster >= 0) > 1
              and (min_by(nc, cluster) filter (where nc > 0) > 1 or max(np) > 1)),
    first_ok as (select gse, min(k) k from ok group by gse),
    clustered as (select gse, gsm, text, type, cast(cluster as int) cluster, k / 10.0::double eps
                  from named join first_ok using (gse, k))"""


@query("time_token", f"select gse, gsm, {TIME_SQL.format(c='text')} t from px_study")
def time_token(t: Tables):
    return t.study.select("gse", "gsm", time_value(F.col("text")).alias("t"))


@query("text_similarity", """
    select a.gse, a.gsm, round(jaro_winkler_similarity(a.text, b.text), 6) + 0.0 score
    from px_study a join (select gse, min_by(text, gsm) as text from px_study where type = 'ctrl' group by gse) b using (gse)""")
def text_similarity(t: Tables):
    first = t.study.filter("type = 'ctrl'").groupBy("gse").agg(F.min_by("text", F.col("gsm")).alias("first"))
    rows = t.study.join(first, "gse")
    return rows.select("gse", "gsm", r6(jaro_winkler(F.col("text"), F.col("first"))).alias("score"))


@query("both_classes", """
    select gse, gsm from px_study where gse in (
        select gse from px_study group by gse having bool_or(type = 'ctrl') and bool_or(type = 'pert'))""")
def both_classes(t: Tables):
    return clustering.with_both_types(t.study).select("gse", "gsm")


@query("sample_position", "select gse, gsm, row_number() over (partition by gse order by gsm) - 1 as position from px_link")
def sample_position(t: Tables):
    return ops.sample_position(t.links)


@query("cluster_samples", CLUSTER_SQL + " select gse, gsm, type, cluster, eps from clustered")
def cluster_samples(t: Tables):
    clustered = clustering.cluster_samples(clustering.with_both_types(t.study))
    return clustered.select("gse", "gsm", "type", "cluster", "eps")


@query("cluster_cross", "with " + GROUPS_SQL.format(source="px_grouped") + " select * from pairs")
def cluster_cross(t: Tables):
    return ops.cross_clusters(*ops.cluster_groups(t.grouped))


@query("candidate_gather", "with " + GROUPS_SQL.format(source="px_grouped") + f"""
    select gse, ctrl_cluster, ctrl_text, count(*) n_pert, min(pert_cluster) first_pert,
           bool_or({TIME_SQL.format(c='pert_text')} is not null) any_time, max({TIME_SQL.format(c='pert_text')}) max_time
    from pairs group by all""")
def candidate_gather(t: Tables):
    return ops.gather_candidates(*ops.cluster_groups(t.grouped))


@query("best_match", "with " + GROUPS_SQL.format(source="px_grouped") + "," + BEST_SQL + """
    select gse, ctrl_cluster, pert_cluster, diff, round(score, 6) score from best""")
def best_match(t: Tables):
    return ops.best_match(*ops.cluster_groups(t.grouped)).withColumn("score", F.round("score", 6))


CODES_SQL = """
    codes as (select gse, ctrl_cluster, pert_cluster, gsm,
                     case when type = 'ctrl' and cluster = ctrl_cluster then '0'
                          when type <> 'ctrl' and cluster = pert_cluster then '1' else 'X' end code
              from {source} join best using (gse)),
    strings as (select gse, ctrl_cluster, pert_cluster,
                       string_agg(cast(gsm as varchar), '|' order by gsm) filter (where code = '0') ctrl_gsm_ids,
                       string_agg(cast(gsm as varchar), '|' order by gsm) filter (where code = '1') pert_gsm_ids,
                       string_agg(code, '' order by gsm) microarray_grouping from codes group by all)"""


@query("grouping_string", "with " + GROUPS_SQL.format(source="px_grouped") + "," + BEST_SQL + ","
       + CODES_SQL.format(source="px_grouped") + " select * from strings")
def grouping_string(t: Tables):
    best = ops.best_match(*ops.cluster_groups(t.grouped)).select("gse", "ctrl_cluster", "pert_cluster")
    return ops.grouping_string(t.grouped, best)


def verdicts(t: Tables):
    return t.table("part").selectExpr("p_partkey gse", "p_size > 25 is_pert_title", "p_size > 10 is_pert_summary",
                                      "p_brand organism", "case when p_size > 30 then '+' else '-' end direction")


@query("verdict_join", """
    select gse, gsm, p_size > 25 is_pert_title, p_size > 10 is_pert_summary, p_brand organism
    from px_study join part on p_partkey = gse""")
def verdict_join(t: Tables):
    return ops.attach_verdict(t.study, verdicts(t)).select("gse", "gsm", "is_pert_title", "is_pert_summary", "organism")


FINISH_SQL = """ select cast(gse as varchar) gse_id, cast(null as varchar) pert_agent, ctrl_gsm_ids, pert_gsm_ids,
    microarray_grouping, p_size > 25 is_pert_title, p_size > 10 is_pert_summary, p_brand organism,
    case when p_size > 30 then '+' else '-' end direction from strings join part on p_partkey = gse"""


@query("result_union", "with " + GROUPS_SQL.format(source="px_grouped") + "," + BEST_SQL + ","
       + CODES_SQL.format(source="px_grouped") + FINISH_SQL)
def result_union(t: Tables):
    pairs = grouping_string(t).withColumn("pert_agent", F.lit(None).cast("string"))
    return ops.finish_pairs(ops.attach_verdict(pairs, verdicts(t)))


@query("path_destination", "with " + GROUPS_SQL.format(source="px_grouped") + "," + BEST_SQL + ","
       + CODES_SQL.format(source="px_grouped") + FINISH_SQL.replace("cast(null as varchar) pert_agent", "'' pert_agent"))
def path_destination(t: Tables):
    source = scratch_folder(t.spark, "ids") + "/ids.txt"
    target = sinks.sibling_path(source, "gse_classified_results")
    sinks.write_pairs(result_union(t), target)
    return files.read_pairs(t.spark, target)


@query("classified_studies", CLUSTER_SQL + "," + GROUPS_SQL.format(source="clustered") + "," + BEST_SQL + ","
       + CODES_SQL.format(source="clustered") + " select * from strings")
def classified_studies(t: Tables):
    clustered = clustering.cluster_samples(clustering.with_both_types(t.study))
    best = ops.best_match(*ops.cluster_groups(clustered)).select("gse", "ctrl_cluster", "pert_cluster")
    return ops.grouping_string(clustered, best)
