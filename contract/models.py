"""Features, classifiers and scores on the labelled texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from assaymill.functions.text import STOP_WORDS
from assaymill.operators import features, models, scores
from assaymill.operators.training_sets import exact_split, series_training_sets
from assaymill.plans.classify import Models, classify
from assaymill.session import cut, scratch_folder
from assaymill.sources.catalog import GSM_COLUMNS, Catalog
from assaymill.sources import files, sinks
from contract.registry import big, query, r6
from contract.standins import Tables
from contract.training import LABELS, curated_files

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
WORDS_SQL = rf"""
    ws as (select doc_id, quality, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'),
                  lambda w: not list_contains({STOP_SQL}, w)) w from px_labelled)"""
TFIDF_SQL = f"""{WORDS_SQL},
    tf as (select doc_id, token, count(*) tf from (select doc_id, unnest(w) token from ws) group by all),
    df as (select token, count(*) df from tf group by token having count(*) <= (select count(*) from ws) * 0.5),
    wt as (select doc_id, token, (1 + ln(tf)) * (ln((1.0 + (select count(*) from ws)) / (1 + df)) + 1) w from tf join df using (token)),
    tfidf as (select doc_id, token, w / sqrt(sum(w * w) over (partition by doc_id)) weight from wt)"""
# Multinomial naive Bayes with add-one smoothing over unit tf-idf vectors, and its class for each row of a source.
BAYES_SQL = f"""{WORDS_SQL},
    b_tf as (select doc_id, token, count(*) tf from (select doc_id, unnest(w) token from ws) group by all),
    b_df as (select token, count(*) df from b_tf group by token having count(*) <= (select count(*) from ws) * 0.5),
    b_idf as (select token, ln((1.0 + (select count(*) from ws)) / (1 + df)) + 1 idf from b_df),
    b_w as (select doc_id, token, tf * idf w from b_tf join b_idf using (token)),
    b_n as (select doc_id, token, w / sqrt(sum(w * w) over (partition by doc_id)) w from b_w),
    b_s as (select quality c, token, sum(b_n.w) s from b_n join ws using (doc_id) group by all),
    b_t as (select c, sum(s) t from b_s group by c),
    theta as (select c, token, ln((coalesce(s, 0) + 1) / (t + (select count(*) from b_idf))) th
              from b_idf cross join b_t left join b_s using (c, token)),
    prior as (select quality c, ln((count(*) + 1.0) / ((select count(*) from ws) + 2)) p from ws group by quality)"""


def bayes_sql(name: str, source: str) -> str:
    """``name`` (k, c): the class of each row (k, text) of ``source``."""
    return rf"""
    {name}_w as (select k, unnest(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'),
                     lambda w: not list_contains({STOP_SQL}, w))) token from ({source})),
    {name}_v as (select k, token, count(*) * any_value(idf) w from {name}_w join b_idf using (token) group by all),
    {name}_n as (select k, token, w / sqrt(sum(w * w) over (partition by k)) w from {name}_v),
    {name}_s as (select k, c, sum(w * th) s from {name}_n join theta using (token) group by all),
    {name} as (select k, arg_max(c, p + coalesce(s, 0)) c from ({source}) cross join prior left join {name}_s using (k, c) group by k)"""


CLASSIFIERS = [f"clf{i}" for i in range(5)]
BOARD = ", ".join(f"round(max(f1_scores) filter (where clf = '{c}'), 6) + 0.0 {c}" for c in CLASSIFIERS)


def labelled(t: Tables):
    return t.labelled.select("doc_id", "text", F.col("quality").cast("double").alias("label"))


def tokenised(t: Tables):
    return t.labelled.select("doc_id", features.tokens(F.col("text")).alias("tokens"))


def weights(t: Tables):
    return features.tfidf(tokenised(t), "doc_id", sublinear=True, max_df=0.5)


def sides(t: Tables):
    return exact_split(cut(labelled(t)), "doc_id", 0.8, 0)


@query("tokens", f"""with {WORDS_SQL}
    select doc_id, len(w) n_words, greatest(len(w) - 1, 0) n_pairs, md5(array_to_string(w, ' ')) words_md5,
           md5(array_to_string(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), ',')) pairs_md5 from ws""")
def tokens(t: Tables):
    words, pairs = features.tokens(F.col("text")), features.tokens(F.col("text"), ngrams=(2, 2))
    rows = t.labelled.select("doc_id", words.alias("w"), pairs.alias("p"))
    return rows.select("doc_id", big(F.size("w")).alias("n_words"), big(F.size("p")).alias("n_pairs"),
                       F.md5(F.array_join("w", " ")).alias("words_md5"), F.md5(F.array_join("p", ",")).alias("pairs_md5"))


@query("tfidf", f"with {TFIDF_SQL} select doc_id, token, round(weight, 6) + 0.0 weight from tfidf")
def tfidf(t: Tables):
    return weights(t).withColumn("weight", r6("weight"))


@query("chi2_top_k", f"""with {TFIDF_SQL},
    sh as (select quality, count(*) / sum(count(*)) over () share from ws group by quality),
    o as (select token, quality, sum(weight) o from tfidf join ws using (doc_id) group by all),
    tot as (select token, sum(weight) total from tfidf group by token),
    x as (select token, sum(power(coalesce(o, 0) - share * total, 2) / (share * total)) chi2
          from tot cross join sh left join o using (token, quality) group by token)
    select token, round(chi2, 6) + 0.0 chi2 from x order by round(chi2, 9) desc, token limit 100""")
def chi2_top_k(t: Tables):
    labels = labelled(t).select("doc_id", "label")
    return features.chi2_top_k(weights(t), labels, "doc_id", 100).withColumn("chi2", r6("chi2"))


def murmur_sql(token: str, n: int) -> str:
    """Bucket of a token: its 32-bit murmur3 hash with seed 42, modulo n, a power of two."""
    mask = "4294967295::hugeint"
    turn = lambda x, k: f"((({x} << {k}) | ({x} >> {32 - k})) & {mask})"
    mix = lambda k: turn_of(f"({k} * 3432918353::hugeint) & {mask}")

    def turn_of(product: str) -> str:
        return f"(list_transform([{product}], lambda p: ({turn('p', 15)} * 461845907::hugeint) & {mask})[1])"

    code, size = f"hex(encode({token}))", f"(length(hex(encode({token}))) // 2)"
    byte = lambda at: f"coalesce(try_cast('0x' || substr({code}, 2 * ({at}) + 1, 2) as int), 0)::hugeint"
    word = lambda at: f"({byte(at)} + ({byte(f'{at} + 1')} << 8) + ({byte(f'{at} + 2')} << 16) + ({byte(f'{at} + 3')} << 24))"
    words = f"list_transform(range(0, {size} // 4), lambda i: {word('4 * i')})"
    body = f"list_reduce(list_prepend(42::hugeint, {words}), lambda h, k: list_transform([xor(h, {mix('k')})], lambda x: ({turn('x', 13)} * 5 + 3864292196::hugeint) & {mask})[1])"
    last = f"xor({body}, case when {size} % 4 > 0 then {mix(word(f'4 * ({size} // 4)'))} else 0::hugeint end)"
    steps = [
        f"xor({last}, {size}::hugeint)", f"(xor(@, @ >> 16) * 2246822507::hugeint) & {mask}",
        f"(xor(@, @ >> 13) * 3266489909::hugeint) & {mask}", "xor(@, @ >> 16)",
    ]
    value = steps[0]
    for step in steps[1:]:
        value = f"list_transform([{value}], lambda y: {step.replace('@', 'y')})[1]"
    return f"({value} % {n})::int"


@query("hashed", f"""with {WORDS_SQL},
    words as (select distinct unnest(w) token from ws), buckets as materialized (select token, {murmur_sql('token', 1 << 16)} bucket from words),
    tf as (select doc_id, bucket, count(*) tf from (select doc_id, unnest(w) token from ws) join buckets using (token) group by all)
    select doc_id, bucket, round(tf / sqrt(sum(tf * tf) over (partition by doc_id)), 6) + 0.0 weight from tf""")
def hashed(t: Tables):
    rows = features.hashed_features().transform(labelled(t)).select("doc_id", "features")

    def entries(batches):
        for batch in batches:
            v = batch.column("features")
            sizes = [len(x) for x in v.field("indices").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("doc_id").to_numpy(), sizes)), v.field("indices").flatten(), v.field("values").flatten()],
                ["doc_id", "bucket", "weight"],
            )

    return rows.mapInArrow(entries, "doc_id bigint, bucket int, weight double").withColumn("weight", r6("weight"))


@query("l1_select")
def l1_select(t: Tables):
    """The terms that the L1 model keeps."""
    fitted, rows = features.fit_vectors(labelled(t), ["label"], max_df=0.5, sublinear=True)
    chosen = features.l1_select(rows)
    vocabulary = [s for s in fitted.stages if hasattr(s, "vocabulary")][0].vocabulary
    return t.spark.createDataFrame([(vocabulary[i],) for i in chosen.getIndices()], "term string")


@query("classifier_bench")
def classifier_bench(t: Tables):
    """All classifiers at their published sizes, on the terms that the L1 model keeps."""
    train, test = sides(t)
    fitted, rows = features.fit_vectors(train, ["label"], max_df=0.5, sublinear=True)
    slicer = features.l1_select(rows)

    def selected(df):
        return slicer.transform(df).select(F.col("selected").alias("features"), "label")

    # Most passes have fewer tasks than there are cores; the times are not part of the result.
    result = models.bench(selected(rows), selected(fitted.transform(test)), models.classifiers(), parallelism=5)
    return result.select("clf", *[r6(c).alias(c) for c in ("f1_scores", "precisions", "recalls")])


@query("grid_search")
def grid_search(t: Tables):
    train, test = sides(t)
    grid = {"use_idf": [True, False], "alpha": [0.1, 1.0]}
    found = models.grid_search(train, test, "bnb", grid, "doc_id", folds=3, parallelism=4)
    return scores.tuning_table(models.tuning_rows(t.spark, [found]))


@query("default_training")
def default_training(t: Tables):
    train, test = sides(t)
    _, predict = models.train_default(train, "ridge")
    report = scores.class_report(predict(test).select("label", "prediction"))
    return report.select("class", *[F.round(c, 3).alias(c) for c in ("precision", "recall", "f1")], "support")


def text_model(train) -> PipelineModel:
    fitted = features.fit_features(train, max_df=0.5)
    model = NaiveBayes(smoothing=1.0).fit(fitted.transform(train).select("features", "label"))
    return PipelineModel([*fitted.stages, model])


@query("model_roundtrip", f"with {BAYES_SQL}," + bayes_sql("own", "select doc_id k, text from px_labelled") + """
    select k doc_id, cast(c as double) "before", cast(c as double) "after" from own""")
def model_roundtrip(t: Tables):
    path = scratch_folder(t.spark, "model")
    rows = cut(labelled(t))
    model = text_model(rows)
    sinks.save_model(model, path)
    before = models.predict(rows, model, "before")
    after = models.predict(rows, sinks.load_model(path), "after").select("doc_id", "after")
    return before.join(after, "doc_id").select("doc_id", "before", "after")


@query("predict_types", f"with {BAYES_SQL}," + bayes_sql("own", "select gsm k, title as text from px_sample") + """
    select k gsm, case c when 1 then 'pert' else 'ctrl' end as type from own""")
def predict_types(t: Tables):
    model = text_model(cut(labelled(t)))
    samples = t.samples.select("gsm", F.col("title").alias("text"))
    named = F.when(F.col("prediction") == 1, "pert").otherwise("ctrl")
    return models.predict(samples, model).select("gsm", named.alias("type"))


@query("verdict_flags", f"with {BAYES_SQL}," + bayes_sql("t", "select gse k, title as text from px_series") + ","
       + bayes_sql("s", "select gse k, summary as text from px_series") + """
    select t.k gse, t.c = 1 is_pert_title, s.c = 1 is_pert_summary from t join s using (k)""")
def verdict_flags(t: Tables):
    rows = cut(labelled(t))
    model = text_model(rows)
    return models.verdict(t.series, model, model, 1.0).select("gse", "is_pert_title", "is_pert_summary")


@query("top_terms", f"""with {BAYES_SQL}
    select c::bigint as class, r::int as rank, token term, round(th, 6) + 0.0 coefficient
    from (select *, row_number() over (partition by c order by round(th, 9) desc, token) r from theta) where r <= 10""")
def top_terms(t: Tables):
    weights = features.tfidf(tokenised(t), "doc_id", max_df=0.5)
    found = models.multinomial_coefficients(weights, labelled(t).select("doc_id", "label"), "doc_id")
    best = models.top_terms(found.withColumn("coefficient", F.round("coefficient", 9)))
    return best.select("class", "rank", "term", r6("coefficient").alias("coefficient"))


@query("trained_classify", r"""
    with c as (select 'file' || (cast(substr(geo_id, 4) as int) // 10 % 3) file, geo_id from px_curated),
    ws as (select case file when 'file2' then 'non_pert' else 'pert' end c, list_distinct(regexp_extract_all(lower(title), '[\p{L}\p{N}_]{2,}')) w
           from c join px_series on gse = geo_id),
    n as (select c, count(*) n, sum(count(*)) over () total, count(*) over () k from ws group by c),
    tc as (select c, token, count(*) k from (select c, unnest(w) token from ws) group by all),
    theta as (select v.token, n.c, (coalesce(tc.k, 0) + 1) / (n.n + 2.0) p from (select distinct token from tc) v cross join n left join tc on tc.token = v.token and tc.c = n.c),
    base as (select c, ln((any_value(n) + 1) / (any_value(total) + any_value(n.k))) + sum(ln(1 - p)) s from theta join n using (c) group by c),
    x as (select gse, unnest(list_distinct(regexp_extract_all(lower(title), '[\p{L}\p{N}_]{2,}'))) token from px_series),
    met as (select gse, c, sum(ln(p) - ln(1 - p)) s from x join theta using (token) group by all)
    select gse, arg_max(c, base.s + coalesce(met.s, 0)) label_name from px_series cross join base left join met using (gse, c) group by gse""")
def trained_classify(t: Tables):
    """From curated ids to a saved model that names the class of every series."""
    path = scratch_folder(t.spark, "trained")
    sets = series_training_sets(curated_files(t), t.series, LABELS)
    model = models.train_classifier(sets.filter("dataset = 'title'").select("text", "label"), "bnb", select=False)
    sinks.save_model(model, path)
    series = t.series.select("gse", F.col("title").alias("text"))
    return models.predict(series, sinks.load_model(path), column="label_name").select("gse", F.col("prediction").alias("label_name"))


CELLS_SQL = """
    c as (select class, count(*) filter (where quality = class) support, count(*) filter (where toxic = class) predicted,
                 count(*) filter (where quality = class and toxic = class) hits
          from px_labelled cross join (select distinct quality as class from px_labelled union select distinct toxic from px_labelled) group by class),
    rep as (select class, case when predicted > 0 then hits / predicted else 0 end as precision,
                   case when support > 0 then hits / support else 0 end recall,
                   case when hits > 0 then 2 * hits / (predicted + support) else 0 end f1, support from c)"""


def judged(t: Tables):
    return t.labelled.select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


@query("class_report", f"""with {CELLS_SQL}
    select class, round(precision, 6) + 0.0 as precision, round(recall, 6) + 0.0 recall, round(f1, 6) + 0.0 f1, support from rep""")
def class_report(t: Tables):
    return scores.class_report(judged(t)).select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("weighted_prf", f"""with {CELLS_SQL}
    select round(sum(precision * support) / sum(support), 6) + 0.0 as precision, round(sum(recall * support) / sum(support), 6) + 0.0 recall,
           round(sum(f1 * support) / sum(support), 6) + 0.0 f1 from rep""")
def weighted_prf(t: Tables):
    return scores.weighted_prf(judged(t)).select(*[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("confusion", """
    select quality as label, count(*) filter (where toxic = 0) as "0", count(*) filter (where toxic = 1) as "1" from px_labelled group by quality""")
def confusion(t: Tables):
    return scores.confusion(judged(t), [0, 1])


@query("f1_board", f"select dataset data_type, {BOARD} from px_scores group by dataset")
def f1_board(t: Tables):
    return scores.f1_board(t.scores, CLASSIFIERS).select("data_type", *[r6(c).alias(c) for c in CLASSIFIERS])


@query("bench_scan", """
    select dataset, clf, round(f1_scores, 6) + 0.0 f1_scores, round(f1_scores / 2, 6) + 0.0 precisions from px_scores""")
def bench_scan(t: Tables):
    path = scratch_folder(t.spark, "scores")
    rows = t.scores.selectExpr(
        "concat('gse_train_', dataset, '_clf_score') run", "clf", "f1_scores", "f1_scores / 2 precisions", "f1_scores recalls")
    rows.write.partitionBy("run").csv(path, header=True)
    back = files.read_scores(t.spark, path)
    return back.select("dataset", "clf", r6("f1_scores").alias("f1_scores"), r6("precisions").alias("precisions"))


@query("score_sink", """
    with s as (select clf, avg(f1_scores) f1 from px_scores group by clf)
    select 'score' kind, clf, round(f1, 6) + 0.0 as value from s union all select 'time', clf, round(f1 * 2, 6) + 0.0 from s""")
def score_sink(t: Tables):
    path = scratch_folder(t.spark, "bench")
    rows = t.scores.groupBy("clf").agg(F.avg("f1_scores").alias("f1_scores")).selectExpr(
        "clf", "f1_scores", "f1_scores precisions", "f1_scores recalls", "f1_scores * 2 training", "f1_scores testing")
    sinks.write_scores(rows, path)
    score = t.spark.read.csv(f"{path}/clf_score", header=True, schema=files.SCORE_SCHEMA)
    time = t.spark.read.csv(f"{path}/clf_time", header=True, schema="clf string, testing double, training double")
    return score.select(F.lit("score").alias("kind"), "clf", r6("f1_scores").alias("value")).unionByName(
        time.select(F.lit("time").alias("kind"), "clf", r6("training").alias("value")))


@query("classifier_rank", """
    select dataset, clf, round(f1_scores, 6) + 0.0 f1_scores, cast(rank() over (partition by dataset order by f1_scores desc) as int) as rank from px_scores""")
def classifier_rank(t: Tables):
    return scores.rank_classifiers(t.scores).withColumn("f1_scores", r6("f1_scores"))


@query("tuning_table", """
    select clf, round(min(f1_scores) / 2, 6) + 0.0 ori_precision, round(min(f1_scores) / 4, 6) + 0.0 ori_recall, round(min(f1_scores), 6) + 0.0 ori_f1,
           round(max(f1_scores) / 2, 6) + 0.0 opt_precision, round(max(f1_scores) / 4, 6) + 0.0 opt_recall, round(max(f1_scores), 6) + 0.0 opt_f1
    from px_scores group by clf""")
def tuning_table(t: Tables):
    low, high = F.min("f1_scores"), F.max("f1_scores")
    rows = t.scores.groupBy("clf").agg(
        r6(low / 2).alias("ori_precision"), r6(low / 4).alias("ori_recall"), r6(low).alias("ori_f1"),
        r6(high / 2).alias("opt_precision"), r6(high / 4).alias("opt_recall"), r6(high).alias("opt_f1"))
    return scores.tuning_table(rows)


def study_catalog(t: Tables) -> Catalog:
    """The parts as an archive: twenty samples a series, their names as titles."""
    part = t.table("part")
    ids = part.selectExpr("concat('GSE', p_partkey div 20) gse", "concat('GSM', p_partkey) gsm", "p_name")
    series = ids.groupBy("gse").agg(F.min("p_name").alias("title"), F.max("p_name").alias("summary"))
    nothing = F.lit(None).cast("string")
    samples = t.study.select(F.concat(F.lit("GSM"), "gsm").alias("gsm"), F.lit("GPL1").alias("gpl"), F.col("text").alias("title"))
    for column in GSM_COLUMNS[3:-1]:
        samples = samples.withColumn(column, nothing)
    return Catalog(
        series.withColumn("overall_design", F.lit("overexpressed transgenic")),
        samples.withColumn("organism_ch1", F.lit("Homo sapiens")),
        ids.select("gse", "gsm"),
        t.spark.range(1).select(F.lit("GPL1").alias("gpl"), F.lit("other").alias("technology")),
        ids.select("gse", F.lit("GPL1").alias("gpl")).distinct(),
    )


@query("classify_archive")
def classify_archive(t: Tables):
    """The whole first job on the parts: one model, which calls economy parts controls, in all three roles."""
    catalog = study_catalog(t)
    texts = t.table("part").selectExpr("concat(p_name, ' ', lower(p_type)) text", "double(p_type <> 'ECONOMY') label")
    words = F.explode(F.split("p_name", " "))
    terms = t.table("part").select(words.alias("term")).distinct().selectExpr(
        "term", "upper(term) concept", "'Amino Acid, Peptide, or Protein' semantic_types")
    model = text_model(cut(texts))
    aliases = terms.selectExpr("concept alias", "substr(concept, 1, 3) symbol", "1 hit")
    return classify(catalog, Models(model, model, model), terms, aliases, organism="homo sapiens")
