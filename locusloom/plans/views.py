"""Fixture views: the pipeline's inputs expressed over the driver tables.

The text is plain SQL that Spark and DuckDB read alike. ``{name}`` stands for a base
table or another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_variants": """
select 'S'||lpad(cast(l_suppkey % 12 as string),2,'0') as sample_id,
  'chr'||cast(l_partkey % 5 + 1 as string) as chrom,
  cast(floor(l_partkey/5) as bigint)*10+1 as pos,
  substr('ACGT', cast(l_partkey % 4 + 1 as int), 1) as ref,
  substr('ACGT', cast((l_partkey + 1 + l_linenumber % 3) % 4 + 1 as int), 1)
    || case when l_linenumber = 7 then 'T' else '' end as alt,
  l_discount*10 as af, l_quantity as qd, l_tax*500 as fs, l_quantity+20 as mq,
  l_discount*40 as sor, l_orderkey % 64 as cell,
  (l_orderkey*8 + l_linenumber)*100 + cast(round(l_discount*100) as bigint) as rec_order
from {lineitem}""",
    "fx_genes": """
select 'chr'||cast(p_partkey % 5 + 1 as string) as chrom,
  cast(floor(p_partkey/5) as bigint)*10 - p_size*3 as g_start,
  cast(floor(p_partkey/5) as bigint)*10 + p_size*3 as g_end,
  case when p_size % 2 = 0 then '+' else '-' end as strand,
  'G'||cast(p_partkey as string) as gene_id, p_brand as gene_name
from {part}""",
    "fx_samples": """
select distinct 'S'||lpad(cast(k as string),2,'0') as sample_id,
  case when k % 2 = 0 then 'disease' else 'control' end as condition,
  'R'||cast(k as string) as run_id,
  'GSM'||cast(cast(floor(k/4) as int)*2 + k % 2 as string) as gsm
from (select cast(s_suppkey % 12 as int) as k from {supplier}) q""",
    "fx_customers": """
select c_custkey as sample_id, c_mktsegment as label, 'N'||cast(c_nationkey as string) as gsm from {customer}""",
    "fx_cells": """
select distinct sample_id, cell,
  substr('ACGT',cast(floor(cell/16) % 4 + 1 as int),1)||substr('ACGT',cast(floor(cell/4) % 4 + 1 as int),1)
  ||substr('ACGT',cast(cell % 4 + 1 as int),1)||'ACGTACGTACGTA' as barcode
from {fx_variants}""",
    "fx_all_clusters": """
select sample_id||'_'||barcode||'-1' as cell_id, sample_id as sample,
  'c'||cast(cell % 5 as string) as cluster, cell from {fx_cells}""",
    # Cells without a cluster are part of what cluster sums are about.
    "fx_cluster_map": """
select cell_id, sample, cluster from {fx_all_clusters} where cell % 7 <> 0""",
    "fx_observed": """
select v.sample_id, c.barcode||'-1' as barcode, v.chrom, v.pos,
  case when v.rec_order % 3 = 0 then v.ref when v.rec_order % 11 = 5 then 'N' else substr(v.alt,1,1) end as base
from {fx_variants} v join {fx_cells} c on v.sample_id = c.sample_id and v.cell = c.cell""",
    "fx_sites": """
select distinct chrom, pos, ref, alt from {fx_variants} where length(alt) = 1""",
    "fx_files": """
select k, p as path from (
  select k, 'vcf/S'||lpad(cast(k as string),2,'0')||'.filtered.vcf' as p from (select distinct cast(s_suppkey % 12 as int) as k from {supplier}) a where k % 3 <> 0
  union all select k, 'vcf/S'||lpad(cast(k as string),2,'0')||'Aligned.sortedByCoord.out.raw.vcf.gz' from (select distinct cast(s_suppkey % 12 as int) as k from {supplier}) b
  union all select k, 'vcf/S'||lpad(cast(k as string),2,'0')||'.filtered.with_filters.vcf' from (select distinct cast(s_suppkey % 12 as int) as k from {supplier}) c
  union all select k, 'fastq/S'||lpad(cast(k as string),2,'0')||'_R1.fastq.gz' from (select distinct cast(s_suppkey % 12 as int) as k from {supplier}) d
  union all select k, 'fastq/S'||lpad(cast(k as string),2,'0')||'_r2_001.fq' from (select distinct cast(s_suppkey % 12 as int) as k from {supplier}) e
  union all select k, 'fastq/S'||lpad(cast(k as string),2,'0')||'_R3.fastq' from (select distinct cast(s_suppkey % 12 as int) as k from {supplier}) f where k % 4 = 0
  union all select k, 'fastq/notes_'||cast(k as string)||'.txt' from (select distinct cast(s_suppkey % 12 as int) as k from {supplier}) g) u""",
    "fx_format_strings": """
select l_orderkey, l_linenumber,
 case l_linenumber % 4 when 0 then 'GT:AF:AD' when 1 then 'GT:AD' when 2 then 'GT:AF:AD' else 'GT' end as fmt,
 case l_linenumber % 4 when 0 then '0/1:'||cast(l_discount as string)||',0.5:3,4'
   when 1 then '0/1:'||cast(cast(l_quantity as int) % 7 as string)||','||cast(l_orderkey % 5 as string)
   when 2 then '0/1:.:5,'||cast(l_partkey % 9 as string) else '0/1' end as smp
from {lineitem}""",
    "fx_reads": """
select 'S'||lpad(cast(o_custkey % 12 as string),2,'0') as sample_id, r.rd as read, o_orderkey as record_idx,
 case when r.rd='R2' then translate(substr(md5(cast(o_orderkey as string)),1,16),'0123456789abcdef','ACGTACGTACGTACGT')
      else translate(substr(md5(cast(o_orderkey as string)),17,10),'0123456789abcdef','ACGTACGTACGTACGT') end as seq,
 case when r.rd='R2' then 'IIIIIIIIIIIIIIII' else 'FFFFFFFFFF' end as qual
from {orders} cross join (select 'R2' as rd union all select 'R3') r""",
    "fx_stage_events": """
select 'stage_'||lpad(cast(user_id % 12 + 1 as string),2,'0') as stage,
 case event_type when 'click' then 'start' when 'purchase' then 'finish' when 'error' then 'error' when 'view' then 'scan' else 'event' end as type,
 ts, event_id, (user_id % 12 + 1) * 60.0e0 as estimate_seconds from {events}""",
    "fx_log_lines": """
select 'S'||lpad(cast(user_id % 12 as string),2,'0') as sample_id, event_id as line_no,
 case event_type when 'click' then 'CMD: gatk HaplotypeCaller -I x.bam'
  when 'purchase' then '[d] org.tool.HaplotypeCaller done. Elapsed time: '||cast(value as string)||' minutes.'
  when 'error' then '[d] org.tool.SelectVariants done. Elapsed time: '||cast(value as string)||' minutes.'
  when 'view' then 'INFO ProgressMeter - chr'||cast(user_id % 5 + 1 as string)||':'||cast(event_id as string)||' 1.5'
  else 'INFO other' end as line from {events}""",
    "fx_scores": """
select d.doc_id, l.quality as y, cast(d.n_chars as double) as score, d.n_chars / (d.n_chars + 900.0e0) as prob,
 case when d.n_chars >= 900 then 1 else 0 end as pred, d.source as grp, d.lang as title, l.toxic as toxic
from {labels} l join {documents} d on l.doc_id = d.doc_id""",
    "fx_pvalues": """
select event_id, cast(cast(floor(value * 7) as bigint) % 1000 as double) / 1000.0e0 as p from {events}""",
    "fx_gene_sets": """
select p_type as term, 'G'||cast(p_partkey as string) as gene from {part}""",
    "fx_vcf_lines": """
select 'vcf/'||sample_id||'Aligned.sortedByCoord.out.filtered.vcf' as file_path,
 case when rec_order % 97 = 0 then '##header' when rec_order % 89 = 0 then chrom||'\t'||cast(pos as string) else
  chrom||'\t'||cast(pos as string)||'\t.\t'||ref||'\t'||alt||case when rec_order % 5 = 0 then ',G' else '' end
  ||'\t50\t.\tQD='||cast(qd as string)||';FS='||cast(fs as string)||';QD='||cast(qd+1 as string)
  ||'\tGT:AF\t0/1:'||cast(af as string) end as value, rec_order
from {fx_variants}""",
    "fx_gtf_lines": """
select chrom||'\thavana\tgene\t'||cast(g_start + 1000 as string)||'\t'||cast(g_end + 1000 as string)||'\t.\t'||strand
 ||'\t.\tgene_id "'||gene_id||'"; gene_version "1";'||case when g_end % 3 = 0 then '' else ' gene_name "'||gene_name||'";' end as value,
 g_start as line_order
from {fx_genes}""",
}


def _needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


_KNOWN: dict[tuple[str, str, str], DataFrame] = {}


def view(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """A base table or fixture view as a DataFrame; each is analysed once per application.

    ``given`` has views that were written already, for what is made from them.
    """
    if given is not None:
        if name in given:
            return given[name]
        if name in VIEWS:
            return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n, given) for n in _needs(VIEWS[name])})
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KNOWN:
        if name not in VIEWS:
            _KNOWN[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            text = VIEWS[name]
            _KNOWN[key] = spark.sql(text, **{n: view(spark, sf_dir, n) for n in _needs(text)})
    return _KNOWN[key]


def with_views(*names: str) -> str:
    """``with`` clause that defines the named views for a SQL query."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for n in _needs(VIEWS[name]):
                add(n)
            ordered.append(name)

    for n in names:
        add(n)
    parts = [f"{n} as ({re.sub(r'[{](\w+)[}]', r'\1', VIEWS[n])})" for n in ordered]
    return "with " + ",\n".join(parts)
