"""Archive-shaped views over the test tables, defined alike for Spark and SQL.

Every view covers its whole table: a document is a series and a sample, a line
item is a count, a part is a study sample or a probe.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

VIEWS: dict[str, str] = {
    "px_series": """
        select 'GSE' || doc_id gse,
               replace(replace(split_part(text, chr(10), 1), 'é', 'α'), 'ç', 'β') title,
               text || case doc_id % 3 when 0 then ' overexpressed transgenic'
                                       when 1 then ' knockout deletion mutant' else '' end summary,
               case when doc_id % 2 = 0 then source end overall_design
        from documents""",
    "px_sample": """
        select 'GSM' || doc_id gsm, 'GPL' || ((doc_id // 10 + doc_id % 3) % 20) gpl,
               split_part(text, chr(10), 1) title, source source_name_ch1,
               case when doc_id % 4 <> 0 then text end description,
               'lang: ' || lang characteristics_ch1,
               case when doc_id % 4 = 0 then text when doc_id % 7 = 0 then 'dose ' || n_chars end
                   treatment_protocol_ch1,
               cast(null as varchar) extract_protocol_ch1,
               case lang when 'en' then 'Homo sapiens' when 'fr' then 'Mus musculus'
                         else 'Rattus norvegicus' end organism_ch1
        from documents""",
    "px_link": """
        select 'GSE' || s gse, 'GSM' || doc_id gsm
        from (select doc_id, unnest(list_distinct([doc_id, doc_id - doc_id % 10])) s from documents)""",
    "px_platform": """
        select distinct 'GPL' || n gpl,
               case n % 4 when 0 then 'in situ oligonucleotide' when 1 then 'high-throughput sequencing'
                   when 2 then 'oligonucleotide beads' else 'other' end technology
        from (select (doc_id // 10 + doc_id % 3) % 20 n from documents)""",
    "px_series_platform": """
        select distinct l.gse, s.gpl from px_link l join px_sample s using (gsm)""",
    "px_curated": """
        select gse geo_id,
               string_agg(gsm, '|' order by gsm)
                   filter (where cast(substr(gsm, 4) as int) % 10 in (0, 2, 4)) ctrl_ids,
               string_agg(gsm, '|' order by gsm)
                   filter (where cast(substr(gsm, 4) as int) % 10 in (1, 3, 5)) pert_ids
        from px_link group by gse""",
    "px_pairs": """
        select geo_id gse_id,
               case when n % 7 = 0 then '' else 'GENE' || (n % 7) end pert_agent,
               ctrl_ids ctrl_gsm_ids, pert_ids pert_gsm_ids, microarray_grouping,
               n % 2 = 0 is_pert_title, n % 3 = 0 is_pert_summary,
               organism_ch1 organism, case when n % 5 < 2 then '+' else '-' end direction
        from (select *, cast(substr(geo_id, 4) as int) // 10 n from px_curated
              where ctrl_ids is not null and pert_ids is not null) c
        join (select gse, min(gsm) gsm,
                     string_agg(case when cast(substr(gsm, 4) as int) % 10 in (0, 2, 4) then '0'
                                     when cast(substr(gsm, 4) as int) % 10 in (1, 3, 5) then '1'
                                     else 'X' end, '' order by gsm) microarray_grouping
              from px_link group by gse) g on g.gse = c.geo_id
        join px_sample using (gsm)""",
    "px_study": """
        select p_partkey // 20 gse, p_partkey gsm,
               p_name || ' ' || lower(p_type) ||
               case when (p_partkey // 20) % 2 = 0 then ' ' || cast(p_size % 4 as varchar) || ' h'
                    else '' end as text,
               case when p_partkey % 3 = 0 then 'ctrl' else 'pert' end as type
        from part""",
    "px_grouped": """
        select gse, gsm, text, type, p_size % 4 - 1 cluster
        from px_study join part on p_partkey = gsm""",
    "px_counts": """
        select 's' || lpad(cast(l_suppkey % 12 as varchar), 2, '0') sample, l_linenumber part,
               case when l_partkey % 50 = 0 then 'QC_g' || l_partkey else 'g' || l_partkey end gene,
               l_quantity as est_counts
        from lineitem""",
    "px_expression": """
        select 'pair_' || l_returnflag pair, 's' || lpad(cast(l_suppkey % 12 as varchar), 2, '0') sample,
               'g' || (l_partkey // 10) gene, cast(sum(l_quantity) as bigint) count
        from lineitem group by all""",
    "px_design": """
        select pair, sample,
               case when cast(substr(sample, 2) as int) in (5, 11) then 'X'
                    when cast(substr(sample, 2) as int) < 5 then '0' else '1' end grp
        from (select distinct 'pair_' || l_returnflag pair,
                     's' || lpad(cast(l_suppkey % 12 as varchar), 2, '0') sample from lineitem)""",
    "px_matrix": """
        select 'g' || (l_partkey % 100) gene, 'GSM' || l_suppkey sample,
               cast(sum(l_quantity) as bigint) count
        from lineitem group by all""",
    "px_runs": """
        select distinct 'GSM' || (s_suppkey * 3) sample, 'SRR' || (1000000 + s_suppkey) run from supplier""",
    "px_terms": """
        select distinct w term, upper(w) concept,
               case length(w) % 3 when 0 then 'Amino Acid, Peptide, or Protein'
                    when 1 then 'Amino Acid; Pharmacologic Substance' else 'Finding' end semantic_types
        from (select unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) w from benchmark)""",
    "px_alias": """
        select concept alias, substr(concept, 1, 4) symbol, 1 as hit
        from px_terms where length(concept) % 2 = 0
        union all
        select concept, substr(concept, 1, 3), 2 from px_terms""",
    "px_letters": """
        select doc_id, source, regexp_replace(lower(text), '[^a-z]', '', 'g') s from documents""",
    "px_reads": """
        select source file, doc_id * 10000 + i read_no,
               '@' || source || '.' || (doc_id * 10000 + i) id,
               translate(substr(s, i * 80 + 1, 80), 'abcdefghijklmnopqrstuvwxyz',
                         'ACGTACGTACGTACGTACGTACGTAC') seq,
               translate(substr(s, i * 80 + 1, 80), 'abcdefghijklmnopqrstuvwxyz',
                         '#%+05:?DIIIIII5?IIIIIII+#%') qual
        from (select doc_id, source, s, unnest(range((length(s) + 79) // 80)) i from px_letters)""",
    "px_labelled": """
        select doc_id, text, quality, toxic from labels join documents using (doc_id)""",
    "px_scores": """
        select event_type dataset, 'clf' || (user_id % 5) clf, avg(value) f1_scores
        from events group by all""",
    "px_probe": """
        select p_partkey probe, 'study' || (p_partkey % 3) study,
               case when p_partkey % 17 = 0 then '' else p_brand end symbol,
               case when p_partkey % 19 <> 0 then p_retailprice + p_size end ave_expr,
               (p_partkey * 7919 % 10007) / 10007.0 p_value
        from part""",
}


class Tables:
    """The driver's tables of one scale factor and the views above as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        """The documents, dealt out by id, as a file may hold very long ones side by side."""
        return self.table("documents").repartition("doc_id")

    @cached_property
    def series(self) -> DataFrame:
        return self.documents.selectExpr(
            "concat('GSE', doc_id) gse",
            "translate(split_part(text, '\n', 1), 'éç', 'αβ') title",
            "concat(text, case doc_id % 3 when 0 then ' overexpressed transgenic'"
            " when 1 then ' knockout deletion mutant' else '' end) summary",
            "case when doc_id % 2 = 0 then source end overall_design",
        )

    @cached_property
    def samples(self) -> DataFrame:
        return self.documents.selectExpr(
            "concat('GSM', doc_id) gsm",
            "concat('GPL', (doc_id div 10 + doc_id % 3) % 20) gpl",
            "split_part(text, '\n', 1) title",
            "source source_name_ch1",
            "case when doc_id % 4 <> 0 then text end description",
            "concat('lang: ', lang) characteristics_ch1",
            "case when doc_id % 4 = 0 then text when doc_id % 7 = 0 then concat('dose ', n_chars) end"
            " treatment_protocol_ch1",
            "cast(null as string) extract_protocol_ch1",
            "case lang when 'en' then 'Homo sapiens' when 'fr' then 'Mus musculus'"
            " else 'Rattus norvegicus' end organism_ch1",
        )

    @cached_property
    def links(self) -> DataFrame:
        return (
            self.table("documents")
            .selectExpr("doc_id", "explode(array_distinct(array(doc_id, doc_id - doc_id % 10))) s")
            .selectExpr("concat('GSE', s) gse", "concat('GSM', doc_id) gsm")
        )

    @cached_property
    def platforms(self) -> DataFrame:
        return (
            self.table("documents")
            .selectExpr("(doc_id div 10 + doc_id % 3) % 20 n")
            .distinct()
            .selectExpr(
                "concat('GPL', n) gpl",
                "case n % 4 when 0 then 'in situ oligonucleotide'"
                " when 1 then 'high-throughput sequencing' when 2 then 'oligonucleotide beads'"
                " else 'other' end technology",
            )
        )

    @cached_property
    def series_platforms(self) -> DataFrame:
        return self.links.join(self.samples.select("gsm", "gpl"), "gsm").select("gse", "gpl").distinct()

    @cached_property
    def curated(self) -> DataFrame:
        digit = F.substring("gsm", -1, 1)

        def joined(digits):
            ids = F.sort_array(F.collect_list(F.when(digit.isin(digits), F.col("gsm"))))
            return F.nullif(F.array_join(ids, "|"), F.lit(""))

        return (
            self.links.groupBy(F.col("gse").alias("geo_id"))
            .agg(joined(["0", "2", "4"]).alias("ctrl_ids"), joined(["1", "3", "5"]).alias("pert_ids"))
        )

    @cached_property
    def pairs(self) -> DataFrame:
        digit = F.substring("gsm", -1, 1)
        code = F.when(digit.isin("0", "2", "4"), "0").when(digit.isin("1", "3", "5"), "1").otherwise("X")
        grouping = (
            self.links.groupBy("gse")
            .agg(
                F.min("gsm").alias("gsm"),
                F.array_join(
                    F.transform(F.sort_array(F.collect_list(F.struct("gsm", code.alias("c")))), lambda x: x["c"]), ""
                ).alias("microarray_grouping"),
            )
        )
        return (
            self.curated.filter("ctrl_ids is not null and pert_ids is not null")
            .withColumn("n", F.expr("cast(substr(geo_id, 4) as int) div 10"))
            .withColumnRenamed("geo_id", "gse")
            .join(grouping, "gse")
            .join(self.samples.select("gsm", "organism_ch1"), "gsm")
            .selectExpr(
                "gse gse_id",
                "case when n % 7 = 0 then '' else concat('GENE', n % 7) end pert_agent",
                "ctrl_ids ctrl_gsm_ids",
                "pert_ids pert_gsm_ids",
                "microarray_grouping",
                "n % 2 = 0 is_pert_title",
                "n % 3 = 0 is_pert_summary",
                "organism_ch1 organism",
                "case when n % 5 < 2 then '+' else '-' end direction",
            )
        )

    @cached_property
    def study(self) -> DataFrame:
        return self._study().drop("cluster")

    @cached_property
    def grouped(self) -> DataFrame:
        return self._study()

    def _study(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey div 20 gse",
            "p_partkey gsm",
            "concat(p_name, ' ', lower(p_type), case when (p_partkey div 20) % 2 = 0"
            " then concat(' ', p_size % 4, ' h') else '' end) text",
            "case when p_partkey % 3 = 0 then 'ctrl' else 'pert' end type",
            "p_size % 4 - 1 cluster",
        )

    @cached_property
    def counts(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('s', lpad(l_suppkey % 12, 2, '0')) sample",
            "l_linenumber part",
            "case when l_partkey % 50 = 0 then concat('QC_g', l_partkey) else concat('g', l_partkey) end gene",
            "l_quantity est_counts",
        )

    @property
    def count_samples(self) -> list[str]:
        return [f"s{i:02d}" for i in range(12)]

    @cached_property
    def expression(self) -> DataFrame:
        return (
            self.table("lineitem")
            .selectExpr(
                "concat('pair_', l_returnflag) pair",
                "concat('s', lpad(l_suppkey % 12, 2, '0')) sample",
                "concat('g', l_partkey div 10) gene",
                "l_quantity",
            )
            .groupBy("pair", "sample", "gene")
            .agg(F.sum("l_quantity").cast("bigint").alias("count"))
        )

    @cached_property
    def design(self) -> DataFrame:
        return (
            self.table("lineitem")
            .selectExpr("concat('pair_', l_returnflag) pair", "concat('s', lpad(l_suppkey % 12, 2, '0')) sample")
            .distinct()
            .selectExpr(
                "pair",
                "sample",
                "case when cast(substr(sample, 2) as int) in (5, 11) then 'X'"
                " when cast(substr(sample, 2) as int) < 5 then '0' else '1' end grp",
            )
        )

    @cached_property
    def matrix(self) -> DataFrame:
        return (
            self.table("lineitem")
            .selectExpr("concat('g', l_partkey % 100) gene", "concat('GSM', l_suppkey) sample", "l_quantity")
            .groupBy("gene", "sample")
            .agg(F.sum("l_quantity").cast("bigint").alias("count"))
        )

    @cached_property
    def runs(self) -> DataFrame:
        return (
            self.table("supplier")
            .selectExpr("concat('GSM', s_suppkey * 3) sample", "concat('SRR', 1000000 + s_suppkey) run")
            .distinct()
        )

    @cached_property
    def terms(self) -> DataFrame:
        return (
            self.table("benchmark")
            .selectExpr("explode(regexp_extract_all(lower(text), '[a-z]{6,}', 0)) term")
            .distinct()
            .selectExpr(
                "term",
                "upper(term) concept",
                "case length(term) % 3 when 0 then 'Amino Acid, Peptide, or Protein'"
                " when 1 then 'Amino Acid; Pharmacologic Substance' else 'Finding' end semantic_types",
            )
        )

    @cached_property
    def aliases(self) -> DataFrame:
        even = self.terms.filter("length(concept) % 2 = 0").selectExpr(
            "concept alias", "substr(concept, 1, 4) symbol", "1 hit"
        )
        return even.unionByName(self.terms.selectExpr("concept alias", "substr(concept, 1, 3) symbol", "2 hit"))

    @cached_property
    def reads(self) -> DataFrame:
        letters, bases = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"
        scores = "#%+05:?DIIIIII5?IIIIIII+#%"
        return (
            self.documents
            .selectExpr("doc_id", "source", "regexp_replace(lower(text), '[^a-z]', '') s")
            # Cut in one go: a row for each read holds its own letters, not those of its whole document.
            .selectExpr("doc_id", "source", "posexplode(regexp_extract_all(s, '.{1,80}', 0)) as (i, w)")
            .selectExpr("source file", "doc_id * 10000 + i read_no", "w")
            .selectExpr(
                "file",
                "read_no",
                "concat('@', file, '.', read_no) id",
                f"translate(w, '{letters}', '{bases}') seq",
                f"translate(w, '{letters}', '{scores}') qual",
            )
        )

    @cached_property
    def labelled(self) -> DataFrame:
        return self.documents.select("doc_id", "text").join(self.table("labels"), "doc_id")

    @cached_property
    def scores(self) -> DataFrame:
        return (
            self.table("events")
            .groupBy(F.col("event_type").alias("dataset"), F.expr("concat('clf', user_id % 5)").alias("clf"))
            .agg(F.avg("value").alias("f1_scores"))
        )

    @cached_property
    def probes(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey probe",
            "concat('study', p_partkey % 3) study",
            "case when p_partkey % 17 = 0 then '' else p_brand end symbol",
            "case when p_partkey % 19 <> 0 then p_retailprice + p_size end ave_expr",
            "(p_partkey * 7919 % 10007) / 10007.0D p_value",
        )
