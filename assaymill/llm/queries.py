"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from assaymill.llm import bpe, counts, divergence, exact, language, mixing, passages, phrases, private, quality, repeats, secrets, simhash
from assaymill.llm.pieces import read_pieces

#: Folder of the public vocabulary files.
VOCABULARIES = os.environ.get("VOCABULARY_DIR", "/opt/tokenizers")
#: Shares of the mixed tokens.
MIX = {"good": 0.9, "poor": 0.08, "toxic": 0.02}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_private_spans(spark: SparkSession, folder: str) -> DataFrame:
    return private.digest(private.personal_spans(table(spark, folder, "documents")))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{VOCABULARIES}/byte_bpe_50k.json"
    coded = bpe.encode(table(spark, folder, "documents"), path, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.token_counts(table(spark, folder, "documents"), read_pieces(f"{VOCABULARIES}/byte_bpe_50k.tiktoken"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"), read_pieces(f"{VOCABULARIES}/byte_bpe_multi_50k.tiktoken"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.secret_spans(table(spark, folder, "documents")))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"), table(spark, folder, "labels"), MIX)


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    done = repeats.remove_repeats(table(spark, folder, "documents"))
    return done.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op11_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES = {
    "op1_private_spans": op1_private_spans,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_bpe": op5_bpe,
    "op6_token_counts": op6_token_counts,
    "op7_language": op7_language,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op10_repeats": op10_repeats,
    "op11_passages": op11_passages,
    "op12_divergence": op12_divergence,
    "op13_phrases": op13_phrases,
}

SQL = {
    "op4_exact_dedup": r"""
        with t as (
            select doc_id, length(coalesce(text, '')) n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) text_sha256
            from documents)
        select doc_id, first_value(doc_id) over w keep_id, count(*) over (partition by text_sha256) group_size,
               doc_id = first_value(doc_id) over w kept, text_sha256
        from t window w as (partition by text_sha256 order by n desc, doc_id)""",
    "op12_divergence": r"""
        with d as materialized (
            select row_number() over () as r, coalesce(lang, '') lang, coalesce(source, '') source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
            from documents),
        w as (select r, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
        c as materialized (select lang, source, term, count(*) n, count(distinct r) k from w group by all),
        kept as materialized (select lang, term, sum(n)::hugeint n from c group by all having sum(k) >= 10),
        v as (select lang, count(*)::hugeint v, sum(n)::hugeint total from kept group by all),
        g as materialized (select lang, source, coalesce(v, 0)::hugeint v, coalesce(total, 0)::hugeint total
                           from (select distinct lang, source from d) left join v using (lang)),
        size as (select lang, source, sum(c.n)::hugeint total from c join kept using (lang, term) group by all),
        cell as materialized (
            select g.lang, g.source, kept.term, coalesce(c.n, 0) n,
                   1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(size.total, 0) + 2 * g.v) p,
                   1 + (1000000000::hugeint * (kept.n + 2)) // (g.total + 2 * g.v) q
            from g join kept using (lang) left join size using (lang, source) left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
        total as (
            select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) s
            from cell a join cell b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        pairs as (
            select a.lang, a.source, 'pair' part, b.source item, coalesce(s, 0) value_
            from g a join g b on a.lang = b.lang and a.source <> b.source
            left join total t on t.lang = a.lang and t.source = a.source and t.item = b.source),
        words as (select lang, source, 'term' part, term item, (p - q) * (p - q) // (p + q) value_ from cell where n > 0 and p > q),
        ranked as (
            select *, row_number() over (partition by lang, source, part order by value_ desc, encode(item)) place
            from (select * from pairs union all select * from words))
        select lang, source, part, item, value_::bigint as "value", place::int as "rank"
        from ranked where part = 'pair' or place <= 10""",
    "op13_phrases": r"""
        with d as (
            select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
            from documents),
        piece as (select lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) as piece from d),
        w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from piece),
        size as (select unnest(range(1, 5)) as k),
        gram as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) as phrase from w, size),
        f as materialized (select lang, k, phrase, count(*) f from gram group by all having count(*) >= 30),
        n as (select lang, sum(len(w))::bigint n from w group by lang),
        cut as (
            select c.lang, c.phrase, c.f a, unnest(range(1, c.k)) as j, string_split(c.phrase, ' ') as parts from f c where k > 1),
        score as (
            select c.lang, c.phrase, c.a, c.j, x.f l, y.f r, (2000000::hugeint * c.a) // (x.f + y.f) s
            from cut c join f x on x.lang = c.lang and x.phrase = array_to_string(c.parts[1:j], ' ')
            join f y on y.lang = c.lang and y.phrase = array_to_string(c.parts[j+1:], ' ')),
        best as (select * from score qualify row_number() over (partition by lang, phrase order by s, j) = 1),
        kept as (
            select * from best b
            where not exists (
                select 1 from f where f.lang = b.lang and f.k > len(string_split(b.phrase, ' ')) and f.f * 100 >= b.a * 80
                and contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' '))),
        ranked as (select *, row_number() over (partition by lang order by s desc, a desc, encode(phrase)) place from kept)
        select lang, place::bigint as "rank", phrase, a, l, r, n, s::bigint as score from ranked join n using (lang) where place <= 2000""",
}
