"""Read files, mates and trimming."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assaymill.functions.text import accession_path
from assaymill.operators import reads as ops
from assaymill.plans.prepare import both_mates, entropy_recipe, prepare_reads, window_recipe
from assaymill.session import scratch_folder
from assaymill.sources import files, sinks
from contract.registry import big, query, r6
from contract.standins import Tables

LOW3, LOW25 = "'!\"#'", "'" + "".join(chr(33 + q) for q in range(25)).replace("'", "''") + "'"
LETTERS = "".join(chr(97 + i) for i in range(26))
LINE = "id || chr(9) || seq || chr(9) || '+' || chr(9) || qual"


def records(t: Tables) -> DataFrame:
    return t.reads.select("file", "read_no", "id", "seq", F.lit("+").alias("plus"), "qual")


def mate(t: Tables, side: int, key: str) -> DataFrame:
    """Even reads are the first mates, odd ones the second; ids carry a comment after a blank."""
    rows = records(t).filter(F.col("read_no") % 2 == side - 1)
    return rows.selectExpr(
        "file", "read_no div 2 record_no", f"concat('@', file, '.', {key}, ' {side}:N') id", "seq", "plus", "qual")


PAIRED_SQL = """
    select a.file, a.read_no // 2 record_no, '@' || a.file || '.' || (a.read_no // 2) || ' 1:N' id, a.seq, a.qual,
           '@' || b.file || '.' || (b.read_no // 2) || ' 2:N' mate_id, b.seq mate_seq, b.qual mate_qual
    from px_reads a join px_reads b on b.file = a.file and b.read_no = a.read_no + 1 and a.read_no % 2 = 0"""


def flat(df: DataFrame) -> DataFrame:
    return df.select("file", "record_no", "id", "seq", "qual", F.col("mate.id").alias("mate_id"),
                     F.col("mate.seq").alias("mate_seq"), F.col("mate.qual").alias("mate_qual"))


def written_lines(t: Tables) -> DataFrame:
    """Sources with an even number hold single reads, the others pairs; every tenth read lost a field."""
    pairs = ops.interleave(ops.zip_mates(mate(t, 1, "read_no div 2"), mate(t, 2, "read_no div 2")))
    single = ops.interleave(records(t)).filter("cast(substr(file, 4) as int) % 2 = 0")
    paired = pairs.filter("cast(substr(file, 4) as int) % 2 = 1").withColumnRenamed("record_no", "read_no")
    lines = single.select("file", "read_no", "line").unionByName(paired.select("file", "read_no", "line"))
    broken = (F.col("read_no") % 10 == 7)
    return lines.withColumn("line", F.when(broken, F.regexp_replace("line", "\t[^\t]*$", "")).otherwise(F.col("line")))


WIDTHS_SQL = f"""
    with p as ({PAIRED_SQL}),
         l as (select file, read_no, 4 w, length({LINE}) chars, length(qual) + 1 lost from px_reads
               where cast(substr(file, 4) as int) % 2 = 0
               union all select file, record_no, 8, length(id || seq || qual || mate_id || mate_seq || mate_qual) + 9,
                                length(mate_qual) + 1 from p where cast(substr(file, 4) as int) % 2 = 1),
         c as (select file, read_no, case when read_no % 10 = 7 then w - 1 else w end n_fields, w,
                      case when read_no % 10 = 7 then chars - lost else chars end chars from l)"""


@query("one_line_reads", WIDTHS_SQL + """
    select file, n_fields, count(*) n, cast(sum(chars) as bigint) chars from c group by all""")
def one_line_reads(t: Tables):
    path = scratch_folder(t.spark, "one-line")
    written_lines(t).select(F.col("file").alias("run"), "line").write.partitionBy("run").text(path, compression="gzip")
    lines = files.read_one_line(t.spark, path)
    return (
        lines.groupBy("file", big(F.size("fields")).alias("n_fields"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars"))
    )


@query("read_layout", WIDTHS_SQL + """
    select file, case w when 8 then 'paired' else 'single' end layout, n_fields = w good, count(*) n from c group by all""")
def read_layout(t: Tables):
    lines = written_lines(t).select("file", F.col("read_no").alias("line_no"), F.split("line", "\t").alias("fields"))
    good, rejects = ops.read_layout(lines)
    both = good.withColumn("good", F.lit(True)).unionByName(rejects.withColumn("good", F.lit(False)))
    return both.groupBy("file", "layout", "good").agg(F.count(F.lit(1)).alias("n"))


@query("four_line_reads", """
    select file, read_no // 1000000 part, row_number() over (partition by file, read_no // 1000000 order by read_no) - 1 record_no,
           id, seq, '+' plus, qual from px_reads""")
def four_line_reads(t: Tables):
    path = scratch_folder(t.spark, "four-line")
    run = F.concat("file", F.lit("_part"), F.expr("read_no div 1000000"))
    # A record becomes four lines where they are written; a task costs by its files and not by its bytes, so none are put together.
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    lines = (
        records(t).select(run.alias("run"), "read_no", *ops.FIELDS).repartition(tasks, "run")
        .select("run", "read_no", F.posexplode(F.array(*ops.FIELDS)).alias("slot", "line"))
    )
    (
        lines.sortWithinPartitions("run", "read_no", "slot")
        .select("run", "line").write.partitionBy("run").text(path)
    )
    back = files.read_four_line(t.spark, path)
    return back.select(
        F.regexp_extract("file", "^(.*)_part", 1).alias("file"),
        big(F.regexp_extract("file", "_part([0-9]+)$", 1)).alias("part"), "record_no", *ops.FIELDS)


@query("mate_zip", PAIRED_SQL)
def mate_zip(t: Tables):
    return flat(ops.zip_mates(mate(t, 1, "read_no div 2"), mate(t, 2, "read_no div 2")))


@query("mate_rejoin", """
    with r1 as (select file, read_no // 4 k, max_by(seq, read_no) seq, max_by(qual, read_no) qual
                from px_reads where read_no % 2 = 0 group by all)
    select r1.file, b.read_no // 2 record_no, '@' || r1.file || '.' || k || ' 1:N' id, r1.seq, r1.qual,
           '@' || r1.file || '.' || k || ' 2:N' mate_id, b.seq mate_seq, b.qual mate_qual
    from px_reads b join r1 on r1.file = b.file and r1.k = b.read_no // 4 where b.read_no % 2 = 1""")
def mate_rejoin(t: Tables):
    return flat(ops.rejoin_mates(mate(t, 1, "read_no div 4"), mate(t, 2, "read_no div 4")))


@query("interleave", f"""
    with p as ({PAIRED_SQL})
    select file, record_no, 1 mate_no, md5(id || seq || qual) rec_md5 from p
    union all select file, record_no, 2, md5(mate_id || mate_seq || mate_qual) from p""")
def interleave(t: Tables):
    lines = ops.interleave(ops.zip_mates(mate(t, 1, "read_no div 2"), mate(t, 2, "read_no div 2")))
    back = ops.deinterleave(lines)
    return back.select("file", "record_no", "mate_no", F.md5(F.concat("id", "seq", "qual")).alias("rec_md5"))


@query("sized_parts", f"""
    select file, read_no, cast(floor(coalesce(sum(strlen({LINE}) + 1) over (
        partition by file order by read_no rows between unbounded preceding and 1 preceding), 0) / 4000) as bigint) part
    from px_reads""")
def sized_parts(t: Tables):
    return ops.part_numbers(ops.interleave(records(t)), 4000).select("file", "read_no", "part")


@query("read_part_sink", f"""
    with p as (select file, cast(floor(coalesce(sum(strlen({LINE}) + 1) over (
        partition by file order by read_no rows between unbounded preceding and 1 preceding), 0) / 100000) as bigint) part,
        strlen({LINE}) + 1 b from px_reads)
    select file, part, count(*) n, cast(sum(b) as bigint) bytes from p group by all""")
def read_part_sink(t: Tables):
    path = scratch_folder(t.spark, "read-parts")
    sinks.write_read_parts(ops.interleave(records(t)), path, 100_000)
    back = files.text_below(t.spark, path, "value string, file string, part bigint")
    return back.groupBy("file", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 1).alias("bytes"))


@query("accession_path", """
    select o_orderkey, case when n <= 6 then substr(a, 1, 6)
           when n <= 9 then substr(a, 1, 6) || '/' || lpad(substr(d, 7), 3, '0') end path
    from (select o_orderkey, 'SRR' || d a, d, length(d) n
          from (select o_orderkey, cast(o_orderkey * o_custkey * 37 + 100 as varchar) d from orders))""")
def accession_paths(t: Tables):
    accession = F.expr("concat('SRR', o_orderkey * o_custkey * 37 + 100)")
    return t.table("orders").select("o_orderkey", accession_path(accession).alias("path"))


TRIM_SQL = f"""
    with a as (select file, read_no, seq, qual, ltrim(qual, {LOW3}) led from px_reads),
         e as (select file, read_no, rtrim(led, {LOW3}) q, length(qual) - length(led) skip, seq from a),
         w as (select file, read_no, q, substr(seq, skip + 1, length(q)) s,
                      list_filter(range(1, length(q) - 2), lambda i: ascii(substr(q, i, 1)) + ascii(substr(q, i + 1, 1))
                          + ascii(substr(q, i + 2, 1)) + ascii(substr(q, i + 3, 1)) - 132 < 60)[1] bad from e),
         trimmed as (select file, read_no, case when bad is null then s else substr(s, 1, bad - 1) end seq,
                            case when bad is null then q else substr(q, 1, bad - 1) end qual from w)"""


@query("quality_trim", TRIM_SQL + " select * from trimmed")
def quality_trim(t: Tables):
    return ops.quality_trim(t.reads.drop("id"))


@query("end_trim", f"""
    select file, read_no, substr(seq, 11, length(q)) seq, q qual
    from (select *, rtrim(substr(qual, 11), {LOW25}) q from px_reads)""")
def end_trim(t: Tables):
    return ops.trim_ends(t.reads.drop("id"))


@query("length_filter", f"""
    with p as ({PAIRED_SQL})
    select file, record_no, length(seq) n1, length(mate_seq) n2 from p where length(seq) >= 36 and length(mate_seq) >= 36""")
def length_filter(t: Tables):
    pairs = ops.zip_mates(mate(t, 1, "read_no div 2"), mate(t, 2, "read_no div 2"))
    kept = ops.min_length(pairs, 36)
    return kept.select("file", "record_no", big(F.length("seq")).alias("n1"), big(F.length("mate.seq")).alias("n2"))


ADAPTERS = ("AGATGTGTATAAGAGACAG", "TCGTCGGCAGCGTCAGATGTGTATAAGAGACAG", "CTGTCTCTTATACACATCTGACGCTGCCGACGA",
            "GTCTCGTGGGCTCGGAGATGTGTATAAGAGACAG", "CTGTCTCTTATACACATCTCCGAGCCCACGAGAC")


def whole_clips(source: str, mismatches: int) -> str:
    """First place of each whole adapter that differs in at most ``mismatches`` bases."""
    return " union all ".join(
        f"select file, read_no, list_filter(range(1, length(seq) - {len(a) - 2}),"
        f" lambda i: hamming(substr(seq, i, {len(a)}), '{a}') <= {mismatches})[1] cut_at from {source} where length(seq) >= {len(a)}"
        for a in ADAPTERS)


def partial_clips(source: str, rate: float) -> str:
    """First place of each adapter, which may run over the end, that differs in at most ``rate`` of its bases."""
    return " union all ".join(
        f"select file, read_no, list_filter(range(1, length(seq) + 1), lambda i: hamming(substr(seq, i, {len(a)}),"
        f" substr('{a}', 1, least({len(a)}, length(seq) - i + 1))) <= floor(least({len(a)}, length(seq) - i + 1) * {rate}::double))[1] cut_at"
        f" from {source} where length(seq) > 0"
        for a in ADAPTERS)


def clipped_sql(source: str, clips: str) -> str:
    """Rows of ``source`` cut before the first of ``clips``."""
    return f"""select file, read_no, case when cut_at is null then seq else substr(seq, 1, cut_at - 1) end seq,
           case when cut_at is null then qual else substr(qual, 1, cut_at - 1) end qual
    from {source} left join (select file, read_no, min(cut_at) cut_at from ({clips}) group by all) using (file, read_no)"""


COMPLEXITY_SQL = """
    w as (select file, read_no, s, substr(seq, s * 32 + 1, 64) piece
               from (select *, unnest(range(greatest(floor((length(seq) - 33) / 32.0), 0)::int + 1)) s from {source})),
         k as (select file, read_no, s, kmer, count(*) c, any_value(greatest(length(piece) - 2, 1)) n
               from (select *, unnest(list_transform(range(1, greatest(length(piece) - 2, 1) + 1), lambda i: substr(piece, i, 3))) kmer
                     from w) group by all),
         e as (select file, read_no, s, case when any_value(n) > 1
                      then -sum((c / n) * ln(c / n)) / ln(least(64, any_value(n))) * 100 else 0.0 end h
               from k group by all)"""


@query("complexity_filter", f"""with {COMPLEXITY_SQL.format(source='px_reads')}
    select file, read_no, round(avg(h), 6) + 0.0 score from e group by all having round(avg(h), 9) >= 65""")
def complexity_filter(t: Tables):
    kept = ops.with_complexity(t.reads).filter(F.round("complexity", 9) >= 65)
    return kept.select("file", "read_no", r6("complexity").alias("score"))


@query("adapter_clip", clipped_sql("px_reads", whole_clips("px_reads", 9)))
def adapter_clip(t: Tables):
    return ops.clip_adapters(t.reads.drop("id"), mismatches=9)


@query("adapter_clip_partial", clipped_sql("px_reads", partial_clips("px_reads", 0.15)))
def adapter_clip_partial(t: Tables):
    return ops.clip_adapters(t.reads.drop("id"), error_rate=0.15, min_overlap=1)


@query("prepared_reads", f"""
    with clipped as ({clipped_sql("px_reads", whole_clips("px_reads", 2))}), {TRIM_SQL.replace("from px_reads", "from clipped").strip().removeprefix("with ")},
         kept as (select *, read_no // 2 k from trimmed where length(seq) >= 36)
    select a.file, a.k record_no, '@' || a.file || '.' || a.k || ' 1:N' id, a.seq, a.qual,
           '@' || a.file || '.' || a.k || ' 2:N' mate_id, b.seq mate_seq, b.qual mate_qual
    from kept a join kept b on b.file = a.file and b.k = a.k where a.read_no % 2 = 0 and b.read_no % 2 = 1""")
def prepared_reads(t: Tables):
    """Both sides of each pair through the window recipe, then re-joined."""
    pairs = ops.zip_mates(mate(t, 1, "read_no div 2"), mate(t, 2, "read_no div 2"))
    return flat(both_mates(pairs, window_recipe()))


@query("entropy_prepared_reads", f"""
    with ended as (select file, read_no, id, substr(seq, 11, length(q)) seq, q qual from (select *, rtrim(substr(qual, 11), {LOW25}) q from px_reads)),
         long as (select * from ended where length(seq) >= 30), {COMPLEXITY_SQL.format(source='long').strip()},
         rich as (select long.* from long join (select file, read_no from e group by all having round(avg(h), 9) >= 65) using (file, read_no)),
         cut as ({clipped_sql("rich", partial_clips("rich", 0.15))})
    select file, read_no, id, cut.seq, cut.qual from cut join rich using (file, read_no) where length(cut.seq) >= 30""")
def entropy_prepared_reads(t: Tables):
    return prepare_reads(t.reads, entropy_recipe())
