"""Differential expression."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.operators import diffexp as ops
from assaymill.session import cut
from contract.registry import query, r6
from contract.standins import Tables

SELECTED_SQL = """
    sel as (select e.pair, gene, e.sample, cast(grp as int) grp, count as value
            from px_expression e join px_design d on d.pair = e.pair and d.sample = e.sample where grp <> 'X')"""
LIBS_SQL = "libs as (select pair, sample, any_value(grp) grp, sum(value) lib_size from {source} group by all)"
KEPT_SQL = f"""{SELECTED_SQL}, {LIBS_SQL.format(source='sel')},
    cuts as (select pair, 10 / median(lib_size) * 1e6 cutoff from libs group by pair),
    need as (select pair, min(n) need from (select pair, grp, count(*) n from libs group by all) group by pair),
    good as (select s.pair, gene from sel s join libs using (pair, sample) join cuts using (pair) join need using (pair)
             group by s.pair, gene, need having count(*) filter (where value / lib_size * 1e6 >= cutoff) >= need
                                            and sum(value) >= 15),
    kept as (select sel.* from sel join good using (pair, gene))"""
TMM_SQL = f"""{KEPT_SQL},
    klibs as (select pair, sample, sum(value) lib_size from kept group by all),
    up as (select pair, sample, quantile_cont(value, 0.75) / any_value(lib_size) f75 from kept join klibs using (pair, sample) group by all),
    ref as (select pair, min_by(sample, row(off, sample)) ref from (
                select pair, sample, round(abs(f75 - avg(f75) over (partition by pair)), 15) off from up) group by pair),
    rv as (select k.pair, gene, value ref_value, lib_size ref_lib from kept k join ref on ref.pair = k.pair and ref.ref = k.sample
           join klibs l on l.pair = k.pair and l.sample = k.sample),
    mv as (select k.pair, k.sample, round(log2((value / lib_size) / (ref_value / ref_lib)), 10) m,
                  round((log2(value / lib_size) + log2(ref_value / ref_lib)) / 2, 10) a,
                  (lib_size - value) / lib_size / value + (ref_lib - ref_value) / ref_lib / ref_value v
           from kept k join klibs using (pair, sample) join rv on rv.pair = k.pair and rv.gene = k.gene
           where value > 0 and ref_value > 0),
    rk as (select *, count(*) over (partition by pair, sample) n, max(abs(m)) over (partition by pair, sample) most,
                  rank() over (partition by pair, sample order by m) + (count(*) over (partition by pair, sample, m) - 1) / 2 rm,
                  rank() over (partition by pair, sample order by a) + (count(*) over (partition by pair, sample, a) - 1) / 2 ra
           from mv),
    tr as (select pair, sample, case when max(most) >= 1e-6 then sum(m / v) / sum(1 / v) else 0 end lf from rk
           where rm between floor(n * 0.3) + 1 and n - floor(n * 0.3) and ra between floor(n * 0.05) + 1 and n - floor(n * 0.05)
           group by all),
    fac as (select pair, sample, lib_size, pow(2, coalesce(lf, 0) - avg(coalesce(lf, 0)) over (partition by pair)) factor
            from klibs left join tr using (pair, sample))"""
CPM_SQL = f"""{TMM_SQL},
    eff as (select pair, sample, lib_size * factor lib, lib_size * factor / avg(lib_size * factor) over (partition by pair) * 3 prior from fac),
    lc as (select k.pair, gene, k.sample, grp, log2((value + prior) / (lib + 2 * prior) * 1e6) as value
           from kept k join eff using (pair, sample))"""
FIT_SQL = f"""{CPM_SQL},
    fit as (select pair, gene, count(*) filter (where grp = 0) n_ctrl, count(*) filter (where grp = 1) n_pert,
                   avg(value) filter (where grp = 0) mean_ctrl, avg(value) filter (where grp = 1) mean_pert, avg(value) ave_expr,
                   count(*) - 2 df,
                   (coalesce(var_pop(value) filter (where grp = 0) * count(*) filter (where grp = 0), 0) +
                    coalesce(var_pop(value) filter (where grp = 1) * count(*) filter (where grp = 1), 0)) / (count(*) - 2) s2
            from lc group by all)"""


def selected(t: Tables):
    return ops.select_groups(t.expression.withColumnRenamed("count", "value"), t.design, ["pair", "sample"])


def normalised(t: Tables):
    kept = cut(ops.drop_low_counts(selected(t)))
    return ops.log_cpm(kept, ops.tmm_factors(kept))


def fitted(t: Tables):
    return ops.contrast(ops.fit_two_groups(normalised(t)))


@query("group_select", f"with {SELECTED_SQL} select * from sel")
def group_select(t: Tables):
    return selected(t)


@query("auto_log2", f"""
    with {SELECTED_SQL}, q as (select pair, quantile_cont(value, 0.0) q0, quantile_cont(value, 0.25) q25,
        quantile_cont(value, 0.75) q75, quantile_cont(value, 0.99) q99, quantile_cont(value, 1.0) q100 from sel group by pair)
    select pair, gene, sample, round(case when q99 > 100 or (q100 - q0 > 50 and q25 > 0)
        or (q25 > 0 and q25 < 1 and q75 > 1 and q75 < 2) then case when value > 0 then log2(value) end
        else value end, 6) + 0.0 as value from sel join q using (pair)""")
def auto_log2(t: Tables):
    values = selected(t).withColumn("value", F.col("value").cast("double"))
    return ops.auto_log2(values).select("pair", "gene", "sample", r6("value").alias("value"))


@query("low_count_filter", f"with {KEPT_SQL} select pair, gene, sample, value from kept")
def low_count_filter(t: Tables):
    return ops.drop_low_counts(selected(t)).select("pair", "gene", "sample", "value")


@query("tmm_factors", f"with {TMM_SQL} select pair, sample, cast(lib_size as bigint) lib_size, round(factor, 6) + 0.0 factor from fac")
def tmm_factors(t: Tables):
    factors = ops.tmm_factors(cut(ops.drop_low_counts(selected(t))))
    return factors.withColumn("factor", r6("factor"))


@query("log_cpm", f"with {CPM_SQL} select pair, gene, sample, round(value, 6) + 0.0 as value from lc")
def log_cpm(t: Tables):
    return normalised(t).select("pair", "gene", "sample", r6("value").alias("value"))


@query("two_group_fit", f"""
    with {FIT_SQL} select pair, gene, n_ctrl, n_pert, df, round(mean_ctrl, 6) + 0.0 mean_ctrl, round(mean_pert, 6) + 0.0 mean_pert,
           round(ave_expr, 6) + 0.0 ave_expr, round(s2, 6) + 0.0 s2 from fit""")
def two_group_fit(t: Tables):
    fit = ops.fit_two_groups(normalised(t))
    return fit.select("pair", "gene", "n_ctrl", "n_pert", "df", *[r6(c).alias(c) for c in
                      ("mean_ctrl", "mean_pert", "ave_expr", "s2")])


@query("contrast", f"""
    with {FIT_SQL} select pair, gene, round(mean_pert - mean_ctrl, 6) + 0.0 log_fc,
        round(sqrt(1 / n_pert + 1 / n_ctrl), 6) + 0.0 unscaled, round(mean_pert, 6) + 0.0 coef from fit""")
def contrast(t: Tables):
    fit = ops.fit_two_groups(normalised(t))
    coefficient = ops.contrast(fit, "coef").withColumnRenamed("log_fc", "coef").drop("unscaled")
    return ops.contrast(coefficient).select("pair", "gene", *[r6(c).alias(c) for c in ("log_fc", "unscaled", "coef")])


def digamma_sql(x: str) -> str:
    y = f"({x} + 8)"
    inv = f"(1.0 / ({y} * {y}))"
    steps = " ".join(f"- 1.0 / ({x} + {k})" for k in range(8))
    return f"(ln({y}) - 0.5 / {y} - {inv} * (1 / 12.0 - {inv} * (1 / 120.0 - {inv} * (1 / 252.0 - {inv} * (1 / 240.0 - {inv} / 132)))) {steps})"


def trigamma_sql(x: str) -> str:
    y = f"({x} + 8)"
    inv = f"(1.0 / ({y} * {y}))"
    steps = " ".join(f"+ 1.0 / (({x} + {k}) * ({x} + {k}))" for k in range(8))
    return f"(1.0 / {y} + {inv} / 2 + {inv} / {y} * (1 / 6.0 - {inv} * (1 / 30.0 - {inv} * (1 / 42.0 - {inv} * (1 / 30.0 - {inv} * 5 / 66)))) {steps})"


def simpson(value: str, n: int) -> str:
    """Simpson's rule over [0, 1] in n even steps; ``value`` is in terms of v."""
    points = f"list_transform(range(0, {n + 1}), lambda i: i / {float(n)})"
    weights = f"(case when i in (1, {n + 1}) then 1 when i % 2 = 0 then 4 else 2 end)"
    return f"(list_sum(list_transform({points}, lambda v, i: {weights} * ({value}))) / {3.0 * n})"


def two_sided_sql(t: str, df: str) -> str:
    """P(|T| > t): one less an integral of cos^(df - 1) for small t, an integral of its tail for large t."""
    full = f"(0.5 * sqrt(pi()) * exp(lgamma({df} / 2.0) - lgamma(({df} + 1) / 2.0)))"
    angle = f"atan(abs({t}) / sqrt({df}))"
    centre = simpson(f"pow(cos({angle} * v), {df} - 1)", 1000)
    cosine = f"({df} / ({df} + {t} * {t}))"
    tail = simpson(f"case when v = 0 then 0.0 else 8 * pow(v, 7) / sqrt(1 - {cosine} * pow(v, 16.0 / {df})) end", 4000)
    return f"(case when abs({t}) < 2 then 1 - {angle} * {centre} / {full} else exp({df} / 2.0 * ln({cosine})) / {df} * {tail} / {full} end)"


def moderated_sql(fit: str, trend: bool) -> str:
    """CTEs on ``fit`` up to ``mod`` with t, p_value and b: the moderated fit in SQL."""
    by = "(partition by pair)"
    spline = f"""
    knots as (select pair, count(*) n, min(ave_expr) lo, max(ave_expr) hi, quantile_cont(ave_expr, 1 / 3.0) q1, quantile_cont(ave_expr, 0.5) q2,
                     quantile_cont(ave_expr, 2 / 3.0) q3, count(distinct ave_expr) u from logs group by pair),
    knot as (select pair, lo, hi, least(u, 1 + (n >= 3)::int + (n >= 6)::int + (n >= 30)::int) width,
                    [0.0, case when n >= 30 then (q1 - lo) / (hi - lo) else (q2 - lo) / (hi - lo) end, (q3 - lo) / (hi - lo)] k from knots),
    every as (select f.pair, f.gene, width, k, (f.ave_expr - lo) / (hi - lo) x, e from fit f join knot using (pair) left join logs l on l.pair = f.pair and l.gene = f.gene),
    bent as (select *, list_transform(k, lambda c: case when c < 1 then (pow(greatest(x - c, 0), 3) - pow(greatest(x - 1, 0), 3)) / (1 - c) else 0 end) d from every),
    b0 as (select pair, gene, width, e, case when width >= 2 then x else 0 end f1, case when width = 3 then d[1] - d[2] when width = 4 then d[1] - d[3] else 0 end f2,
                  case when width = 4 then d[2] - d[3] else 0 end f3 from bent),
    b1 as (select pair, gene, width, e, avg(e) over {by} m, f1 - avg(f1) filter (where e is not null) over {by} f1, f2 - avg(f2) filter (where e is not null) over {by} f2,
                  f3 - avg(f3) filter (where e is not null) over {by} f3 from b0),
    b2 as (select pair, gene, width, e, m, f1, sum(f1 * f1) filter (where e is not null) over {by} s1, sum(f1 * e) over {by} / nullif(sum(f1 * f1) filter (where e is not null) over {by}, 0) c1,
                  f2 - f1 * coalesce(sum(f1 * f2) filter (where e is not null) over {by} / nullif(sum(f1 * f1) filter (where e is not null) over {by}, 0), 0) f2,
                  f3 - f1 * coalesce(sum(f1 * f3) filter (where e is not null) over {by} / nullif(sum(f1 * f1) filter (where e is not null) over {by}, 0), 0) f3 from b1),
    b3 as (select pair, gene, width, e, m, f1, c1, f2, sum(f2 * e) over {by} / nullif(sum(f2 * f2) filter (where e is not null) over {by}, 0) c2,
                  f3 - f2 * coalesce(sum(f2 * f3) filter (where e is not null) over {by} / nullif(sum(f2 * f2) filter (where e is not null) over {by}, 0), 0) f3 from b2),
    b4 as (select *, sum(f3 * e) over {by} / nullif(sum(f3 * f3) filter (where e is not null) over {by}, 0) c3 from b3),
    mean as (select pair, gene, e, width, m + f1 * coalesce(c1, 0) + f2 * coalesce(c2, 0) + f3 * coalesce(c3, 0) level from b4),
    var as (select pair, any_value(width) width, sum((e - level) * (e - level)) / (count(e) - any_value(width)) spread from mean where e is not null group by pair)"""
    flat = """
    mean as (select f.pair, f.gene, 1 width, avg(e) over (partition by f.pair) level from fit f left join logs l on l.pair = f.pair and l.gene = f.gene),
    var as (select pair, 1 width, var_samp(e) spread from logs group by pair)"""
    total = "least(df + d0, pooled)"
    return f"""{fit},
    usable as (select pair, gene, df, s2, ave_expr, quantile_cont(s2, 0.5) over (partition by pair) mid from fit where df > 0 and s2 is not null and ave_expr is not null),
    logs as materialized (
        select pair, gene, ave_expr, greatest(s2, 1e-5 * case when mid > 0 then mid else 1 end) x,
               ln(greatest(s2, 1e-5 * case when mid > 0 then mid else 1 end)) - {digamma_sql('(df / 2.0)')} + ln(df / 2.0) e, {trigamma_sql('(df / 2.0)')} bend
        from usable), {spline if trend else flat},
    excess as materialized (
        select pair, width, spread - (select avg(bend) from logs l where l.pair = var.pair) y, (select avg(x) from logs l where l.pair = var.pair) mean_x from var),
    search as (
        select pair, y, 0 as step, ln(least(1 / sqrt(y), 1 / y)) - 1 low, ln(1 / y + 1 / sqrt(y)) + 1 high from excess where y > 0
        union all
        select pair, y, step + 1, case when {trigamma_sql('exp((low + high) / 2)')} > y then (low + high) / 2 else low end,
               case when {trigamma_sql('exp((low + high) / 2)')} > y then high else (low + high) / 2 end from search where step < 80),
    prior as materialized (
        select e.pair, width, mean_x, coalesce(2 * exp((low + high) / 2), 'infinity'::double) d0, (select sum(greatest(df, 0)) from fit f where f.pair = e.pair) pooled
        from excess e left join search s on s.pair = e.pair and step = 80),
    scaled as materialized (
        select f.*, d0, {total} total,
               case when d0 < 1e10 then exp(level + {digamma_sql('(d0 / 2.0)')} - ln(d0 / 2.0)) when prior.width = 1 then mean_x else exp(level) end s2_prior
        from fit f join prior using (pair) join mean using (pair, gene) where s2 is not null and log_fc is not null),
    post as materialized (
        select *, log_fc / (unscaled * sqrt(s2_post)) t from (
            select *, case when d0 < 1e10 then d0 / (d0 + df) * s2_prior + df / (d0 + df) * s2 else s2_prior end s2_post from scaled)),
    rated as materialized (
        select *, {two_sided_sql('t', 'total')} p_value, count(*) over {by} n, max(total) over {by} top, quantile_cont(s2_prior, 0.5) over {by} middle from post),
    -- t on the most degrees of freedom of the pair with the same p-value, then the expected t of the leading ranks.
    even_search as (
        select pair, gene, p_value p, top, 0 as step, 0::double low, 1e4::double high from rated where total < top
        union all
        select pair, gene, p, top, step + 1, case when {two_sided_sql('((low + high) / 2)', 'top')} > p then (low + high) / 2 else low end,
               case when {two_sided_sql('((low + high) / 2)', 'top')} > p then high else (low + high) / 2 end from even_search where step < 56),
    even as (select r.pair, r.gene, case when total < r.top then (low + high) / 2 else abs(t) end even, unscaled, r.p_value, n, r.top, middle
             from rated r left join even_search s on s.pair = r.pair and s.gene = r.gene and step = 56),
    ahead as materialized (
        select *, ((place - 0.5) / n - (1 - share) * p_value) / share target from (
            select *, row_number() over (partition by pair order by even desc, gene) place, greatest(ceil(0.005 * n) / n, 0.01) share from even)
        where place <= ceil(0.005 * n)),
    wanted as (
        select pair, gene, target p, top, 0 as step, 0::double low, 1e4::double high from ahead where target > p_value
        union all
        select pair, gene, p, top, step + 1, case when {two_sided_sql('((low + high) / 2)', 'top')} > p then (low + high) / 2 else low end,
               case when {two_sided_sql('((low + high) / 2)', 'top')} > p then high else (low + high) / 2 end from wanted where step < 56),
    v as (select pair, avg(least(greatest(coalesce(unscaled * unscaled * (pow(even / ((low + high) / 2), 2) - 1), 0), 0.01 / middle), 16 / middle)) v0
          from ahead left join (select * from wanted where step = 56) w using (pair, gene) group by pair),
    mod as materialized (
        select r.*, ln(0.01 / 0.99) - ln(ratio) / 2 + case when d0 > 1e6 then t * t * (1 - 1 / ratio) / 2
                    else (1 + total) / 2 * ln((t * t + total) / (t * t / ratio + total)) end b
        from (select rated.*, (unscaled * unscaled + v0) / (unscaled * unscaled) ratio from rated join v using (pair)) r)"""


CONTRASTED_SQL = FIT_SQL.replace("fit as (", "fit0 as (") + """,
    fit as materialized (select *, mean_pert - mean_ctrl log_fc, sqrt(1.0 / n_pert + 1.0 / n_ctrl) unscaled from fit0)"""
ADJUSTED_SQL = """least(1, min(p_value * n_ / place) over (partition by pair order by p_value desc, place desc rows unbounded preceding))"""
ARRAY_FIT_SQL = f"""{SELECTED_SQL},
    q as (select pair, quantile_cont(value, 0.0) q0, quantile_cont(value, 0.25) q25, quantile_cont(value, 0.75) q75, quantile_cont(value, 0.99) q99,
                 quantile_cont(value, 1.0) q100 from sel group by pair),
    lc as (select pair, gene, sample, grp, case when q99 > 100 or (q100 - q0 > 50 and q25 > 0) or (q25 > 0 and q25 < 1 and q75 > 1 and q75 < 2)
                  then case when value > 0 then log2(value) end else value end as value from sel join q using (pair)),
    fit0 as (select pair, gene, count(value) filter (where grp = 0) n_ctrl, count(value) filter (where grp = 1) n_pert,
                    avg(value) filter (where grp = 0) mean_ctrl, avg(value) filter (where grp = 1) mean_pert, avg(value) ave_expr, count(value) - 2 df,
                    case when count(value) > 2 then (coalesce(var_pop(value) filter (where grp = 0) * count(value) filter (where grp = 0), 0) +
                    coalesce(var_pop(value) filter (where grp = 1) * count(value) filter (where grp = 1), 0)) / (count(value) - 2) end s2 from lc group by all),
    fit as materialized (select *, mean_pert - mean_ctrl log_fc, case when n_ctrl > 0 and n_pert > 0 then sqrt(1.0 / n_pert + 1.0 / n_ctrl) end unscaled from fit0)"""


def recursive(sql: str) -> str:
    return f"with recursive {sql.strip()}"


@query("moderated_t", recursive(f"""
    {moderated_sql(CONTRASTED_SQL, False)}
    select pair, gene, round(log_fc, 6) + 0.0 log_fc, round(t, 6) + 0.0 t, round(p_value, 6) + 0.0 p_value, round(b, 6) + 0.0 b, round(s2_post, 6) + 0.0 s2_post from mod"""))
def moderated_t(t: Tables):
    result = ops.moderated_t(fitted(t))
    return result.select("pair", "gene", *[r6(c).alias(c) for c in ("log_fc", "t", "p_value", "b", "s2_post")])


@query("gene_table", recursive(f"""
    {moderated_sql(CONTRASTED_SQL, True)},
    place as (select *, row_number() over (partition by pair order by p_value) place, count(*) over (partition by pair) n_ from mod),
    adj as (select *, {ADJUSTED_SQL} adj_p_value from place),
    top as (select *, row_number() over (partition by pair order by b desc, gene) r from adj)
    select pair, gene, round(log_fc, 6) + 0.0 log_fc, round(ave_expr, 6) + 0.0 ave_expr, round(t, 6) + 0.0 t, round(p_value, 6) + 0.0 p_value,
           round(adj_p_value, 6) + 0.0 adj_p_value, round(b, 6) + 0.0 b from top where r <= 250"""))
def gene_table(t: Tables):
    result = ops.gene_table(ops.moderated_t(fitted(t), trend=True), "sequencing")
    return result.select("pair", "gene", *[r6(c).alias(c) for c in ("log_fc", "ave_expr", "t", "p_value", "adj_p_value", "b")])


@query("array_gene_table", recursive(f"""
    {moderated_sql(ARRAY_FIT_SQL, False)},
    named as (select *, case when cast(substr(gene, 2) as bigint) % 17 = 0 then '' else 'SYM' || (cast(substr(gene, 2) as bigint) // 3) end symbol from mod),
    by_mean as (select pair, ave_expr, row_number() over (partition by pair order by ave_expr) r, count(*) over (partition by pair) c from named where ave_expr is not null),
    low as (select pair, max(ave_expr) low from by_mean where r = c // 3 group by pair),
    best as (select pair, gene from named where symbol <> '' and ave_expr is not null qualify row_number() over (partition by pair, symbol order by ave_expr desc, gene) = 1),
    kept as (select n.* from named n join best using (pair, gene) left join low using (pair) where symbol <> '' and (low is null or ave_expr > low)),
    place as (select *, row_number() over (partition by pair order by p_value) place, count(*) over (partition by pair) n_ from kept)
    select pair, gene probe, symbol, round({ADJUSTED_SQL}, 6) + 0.0 adj_p_value, round(p_value, 6) + 0.0 p_value, round(t, 6) + 0.0 t, round(b, 6) + 0.0 b,
           round(log_fc, 6) + 0.0 log_fc from place"""))
def array_gene_table(t: Tables):
    """Probes are genes named by every third probe's neighbour, so symbols repeat and some are blank."""
    values = ops.auto_log2(selected(t).withColumn("value", F.col("value").cast("double")))
    result = ops.moderated_t(ops.contrast(ops.fit_two_groups(values)))
    number = F.substring("gene", 2, 12).cast("bigint")
    symbol = F.when(number % 17 == 0, "").otherwise(F.concat(F.lit("SYM"), F.floor(number / 3)))
    table = ops.gene_table(result.withColumnRenamed("gene", "probe").withColumn("gene", F.col("probe"))
                           .withColumn("symbol", symbol), "array")
    return table.select("pair", "probe", "symbol", *[r6(c).alias(c) for c in ("adj_p_value", "p_value", "t", "b", "log_fc")])


@query("best_probe", """
    select study, symbol, probe, ave_expr from (
        select *, row_number() over (partition by study, symbol order by ave_expr desc, probe) r
        from px_probe where symbol <> '' and ave_expr is not null) where r = 1""")
def best_probe(t: Tables):
    return ops.best_probe(t.probes, ["study"]).select("study", "symbol", "probe", "ave_expr")


@query("upper_two_thirds", """
    with r as (select *, row_number() over (partition by study order by ave_expr) r, count(*) over (partition by study) n
               from px_probe where ave_expr is not null),
         c as (select study, max(ave_expr) c from r where r = n // 3 group by study)
    select study, probe, ave_expr from r join c using (study) where ave_expr > c""")
def upper_two_thirds(t: Tables):
    return ops.upper_two_thirds(t.probes, ["study"]).select("study", "probe", "ave_expr")


@query("top_genes", """
    select study, probe, p_value from (select *, row_number() over (partition by study order by p_value, probe) r from px_probe)
    where r <= 250""")
def top_genes(t: Tables):
    return ops.top_genes(t.probes, ["study"], [F.col("p_value"), F.col("probe")]).select(
        "study", "probe", "p_value")


@query("bh_adjust", """
    with r as (select *, row_number() over (partition by study order by p_value) r, count(*) over (partition by study) n from px_probe)
    select study, probe, round(least(1, min(p_value * n / r) over (
        partition by study order by p_value desc, r desc rows unbounded preceding)), 6) + 0.0 adj_p_value from r""")
def bh_adjust(t: Tables):
    return ops.bh_adjust(t.probes, ["study"]).select("study", "probe", r6("adj_p_value").alias("adj_p_value"))
