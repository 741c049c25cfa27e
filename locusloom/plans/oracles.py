"""DuckDB SQL with the same result as the registered queries, over the same tables."""

from __future__ import annotations

from locusloom.plans.views import with_views

ORACLES: dict[str, str] = {}

LOCI = """
first_calls as (
  select * from (select *, row_number() over (partition by chrom, pos, ref, alt, sample_id order by rec_order) as rn
                 from fx_variants) q where rn = 1),
loci as (
  select chrom, pos, ref, alt, count(*) as cohort_count, greatest(max(af), 0.0) as max_af
  from first_calls group by chrom, pos, ref, alt having count(*) >= 4 and max(af) >= 0.05)"""
ANNOTATED = (
    LOCI
    + """,
annotated as (
  select l.chrom, l.pos, l.ref, split_part(l.alt, ',', 1) as alt, g.gene_id, g.gene_name, g.strand
  from loci l join fx_genes g on l.chrom = g.chrom and l.pos between g.g_start and g.g_end)"""
)
BURDEN = (
    ANNOTATED
    + """,
burden as (
  select a.gene_id, a.gene_name, v.sample_id, count(*) as n
  from (select distinct chrom, pos, ref, alt, sample_id from fx_variants) v
  join (select distinct chrom, pos, ref, alt, gene_id, gene_name from annotated) a using (chrom, pos, ref, alt)
  group by all)"""
)
CELLS = """
cell_counts as (
  select o.sample_id, regexp_extract(o.barcode, '([ACGT]{16,})', 1) as barcode, s.chrom, s.pos, s.ref, s.alt,
    count(*) filter (where o.base = s.alt) as ad, count(*) filter (where o.base in (s.ref, s.alt)) as dp
  from fx_observed o join fx_sites s on o.chrom = s.chrom and o.pos = s.pos group by all),
lookup as (
  select sample as sample_id, regexp_extract(cell_id, '([ACGT]{16,})', 1) as barcode, max(cluster) as cluster
  from fx_cluster_map group by all),
all_sums as (
  select c.sample_id, c.chrom, c.pos, c.ref, c.alt, l.cluster, cast(sum(c.ad) as bigint) as alt_sum,
    cast(sum(c.dp) as bigint) as depth_sum,
    case when sum(c.dp) > 0 then round(sum(c.ad) / sum(c.dp), 6) else 0.0 end as vaf
  from cell_counts c join lookup l using (sample_id, barcode) group by all),
sums as (select * from all_sums where alt_sum >= 3)"""
CLASSED = """
classed as (
  select sample_id, length(ref) = 1 and length(split_part(alt, ',', 1)) = 1 as snv,
    ref || '>' || split_part(alt, ',', 1) as channel from fx_variants)"""
INTEGRATED = (
    BURDEN
    + ","
    + CELLS
    + ","
    + CLASSED
    + """,
b as (select sample_id, cast(sum(n) as double) as gene_burden_total, count(*) filter (where n > 0) as burdened_gene_count
      from burden group by 1),
m as (select sample_id, count(*) as mutation_variant_count, count(*) filter (where snv) as mutation_snv_count,
      count(*) filter (where not snv) as mutation_indel_count from classed group by 1),
s as (select sample_id, count(*) filter (where snv) as signature_total,
      count(distinct case when snv then channel end) as signature_channels_nonzero from classed group by 1),
c as (select sample_id, count(*) as cluster_variant_rows, cast(sum(alt_sum) as double) as cluster_alt_sum_total,
      cast(sum(depth_sum) as double) as cluster_depth_sum_total,
      sum(alt_sum) / sum(depth_sum) as cluster_mean_vaf, count(distinct cluster) as cluster_count from sums group by 1),
d as (select sample_id, count(distinct cell) as starsolo_detected_cells from fx_variants group by 1),
integrated as (
  select sample_id, b.* exclude (sample_id), m.* exclude (sample_id), s.* exclude (sample_id), c.* exclude (sample_id),
    d.starsolo_detected_cells, f.condition, f.run_id, f.gsm
  from b full outer join m using (sample_id) left join s using (sample_id) left join c using (sample_id)
  left join d using (sample_id) left join fx_samples f using (sample_id))"""
)
INTEGRATED_VIEWS = ("fx_variants", "fx_genes", "fx_observed", "fx_sites", "fx_cluster_map", "fx_samples")
METRIC_LIST = [
    "gene_burden_total",
    "burdened_gene_count",
    "mutation_variant_count",
    "mutation_snv_count",
    "mutation_indel_count",
    "signature_total",
    "cluster_variant_rows",
    "cluster_alt_sum_total",
    "cluster_depth_sum_total",
    "cluster_mean_vaf",
    "starsolo_detected_cells",
]


def _pairs(wide: str, metrics: list[str]) -> str:
    """Pairwise-complete Spearman over a wide table, by the textbook: one row per pair and sample."""
    rows = " union all ".join(
        f"select sample_id, '{m}' as metric, {i} as ord, cast({m} as double) as v from {wide} where {m} is not null"
        for i, m in enumerate(metrics)
    )
    return f"""
long as ({rows}),
pairs as (select a.metric as metric_x, b.metric as metric_y, a.v as vx, b.v as vy
          from long a join long b on a.sample_id = b.sample_id and a.ord < b.ord),
ranked as (select *, rank() over (partition by metric_x, metric_y order by vx)
             + (count(*) over (partition by metric_x, metric_y, vx) - 1) / 2.0 as rx,
           rank() over (partition by metric_x, metric_y order by vy)
             + (count(*) over (partition by metric_x, metric_y, vy) - 1) / 2.0 as ry from pairs),
rho as (select metric_x, metric_y, count(*) as n_samples, corr(rx, ry) as spearman_rho from ranked
        group by 1, 2 having count(*) >= 3 and count(distinct vx) >= 2 and count(distinct vy) >= 2)"""


def oracle(name: str, views: tuple[str, ...], body: str, ctes: str = "") -> None:
    head = with_views(*views) if views else "with nothing as (select 1)"
    ORACLES[name] = head + ("," + ctes if ctes else "") + "\n" + body


V, G = ("fx_variants",), ("fx_variants", "fx_genes")

oracle(
    "cohort_common_variants",
    V,
    """select l.chrom, l.pos, l.ref, l.alt, l.cohort_count, round(l.max_af, 6) as max_af, f.cell,
       f.sample_id as first_unit, f.rec_order as first_order
     from loci l join (select *, row_number() over (partition by chrom, pos, ref, alt order by sample_id, rec_order) as k
                       from first_calls) f on f.k = 1 and l.chrom = f.chrom and l.pos = f.pos and l.ref = f.ref and l.alt = f.alt""",
    LOCI,
)
oracle(
    "cohort_records",
    V,
    """select l.chrom, l.pos, '.' as id, l.ref, l.alt, '50' as qual, 'PASS' as filter,
       case when f.cell % 3 = 0 then '' else 'CELL=' || cast(f.cell as string) || ';' end
       || 'COHORT_COUNT=' || cast(l.cohort_count as string) || ';MAX_AF=' || format('{:.6f}', l.max_af) as info
     from loci l join (select *, row_number() over (partition by chrom, pos, ref, alt order by sample_id, rec_order) as k
                       from first_calls) f on f.k = 1 and l.chrom = f.chrom and l.pos = f.pos and l.ref = f.ref and l.alt = f.alt""",
    LOCI,
)
oracle("variant_to_gene", G, "select * from annotated", ANNOTATED)
oracle("gene_burden_long", G, "select * from burden", BURDEN)
oracle(
    "gene_burden_wide",
    G,
    "select g.gene_id, g.gene_name, "
    + ", ".join(
        f"cast(coalesce(sum(b.n) filter (where b.sample_id = 'S{i:02d}'), 0) as bigint) as \"S{i:02d}\"" for i in range(12)
    )
    + """ from (select distinct gene_id, gene_name from annotated) g
      left join burden b on g.gene_id = b.gene_id and g.gene_name = b.gene_name group by 1, 2""",
    BURDEN,
)
oracle(
    "gene_burden_totals",
    G,
    """select sample_id, cast(sum(n) as double) as gene_burden_total, count(*) filter (where n > 0) as burdened_gene_count
     from burden group by 1""",
    BURDEN,
)
oracle(
    "top_burdened_genes",
    G,
    """select gene_id, gene_name, cast(sum(n) as bigint) as total, count(*) as n_samples from burden group by 1, 2
     order by total desc, gene_id limit 20""",
    BURDEN,
)
TAGGED = """
tagged as (select *, concat_ws(';', case when qd < 2.0 then 'LowQD' end, case when fs > 30.0 then 'HighFS' end,
  case when mq < 40.0 then 'LowMQ' end, case when sor > 3.0 then 'HighSOR' end) as t from fx_variants)"""
oracle(
    "hard_filter_tags",
    V,
    "select sample_id, chrom, pos, ref, alt, rec_order, case when t = '' then 'PASS' else t end as filter from tagged",
    TAGGED,
)
oracle("hard_filter_pass", V, "select sample_id, count(*) as passing from tagged where t = '' group by 1", TAGGED)
oracle(
    "vcf_scan",
    ("fx_variants",),
    """select sample_id, chrom, pos, alt || case when rec_order % 5 = 0 then ',G' else '' end as alt,
       chrom || ':' || cast(pos as string) || ':' || ref || ':' || alt as key, qd + 1 as qd, fs, round(af, 6) as af
     from fx_variants where rec_order % 97 <> 0 and rec_order % 89 <> 0""",
)
oracle(
    "records_per_file",
    ("fx_variants",),
    """select 'vcf/' || sample_id || 'Aligned.sortedByCoord.out.filtered.vcf' as file_path, count(*) as records
     from fx_variants where rec_order % 97 <> 0 and rec_order % 89 <> 0 group by 1""",
)
oracle(
    "gtf_scan",
    ("fx_genes",),
    """select chrom, g_start + 1000 as start, g_end + 1000 as "end", strand, gene_id,
       case when g_end % 3 = 0 then gene_id else gene_name end as gene_name from fx_genes""",
)
oracle(
    "mutation_burden",
    V,
    """select sample_id, count(*) as variant_count, count(*) filter (where snv) as snv_count,
     count(*) filter (where not snv) as indel_count from classed group by 1""",
    CLASSED,
)
oracle("substitution_spectrum_long", V, "select sample_id, channel, count(*) as n from classed where snv group by 1, 2", CLASSED)
oracle(
    "substitution_spectrum",
    V,
    "select sample_id, "
    + ", ".join(
        f"count(*) filter (where snv and channel = '{a}>{b}') as \"{a}>{b}\"" for a in "ACGT" for b in "ACGT" if a != b
    )
    + " from classed group by 1",
    CLASSED,
)
oracle(
    "spectrum_totals",
    V,
    """select sample_id, count(*) filter (where snv) as signature_total,
     count(distinct case when snv then channel end) as signature_channels_nonzero from classed group by 1""",
    CLASSED,
)
oracle(
    "strict_variant_classes",
    V,
    """select sample_id, case when length(ref) = 1 and length(alt) = 1 then 'snv' when length(ref) = length(alt) then 'mnv'
     else 'indel' end as kind, count(*) as n from fx_variants group by 1, 2""",
)
oracle(
    "driver_hits",
    G,
    """select b.sample_id, cast(coalesce(sum(b.n) filter (where d.p_brand is not null), 0) as bigint) as driver_hits,
       count(distinct d.p_brand) as driver_genes
     from burden b left join (select distinct p_brand from part where p_retailprice < 950 and p_size < 10) d
       on b.gene_name = d.p_brand group by 1""",
    BURDEN,
)
oracle(
    "pathway_ora",
    ("fx_variants", "fx_genes", "fx_gene_sets"),
    """select term, set_size, overlap, universe, n_hits, round(p, 6) as p_value,
       round(least(1.0, min(p * m / r) over (order by p desc, r desc rows between unbounded preceding and current row)), 6) as fdr_bh
     from (select *, count(*) over () as m, row_number() over (order by p, term) as r from tails) q""",
    BURDEN
    + """,
known as (select distinct gene_id as gene from fx_genes),
hits as (select gene_id as gene from burden group by 1 having sum(n) >= 60),
counts as (select s.term, count(*) as set_size, count(h.gene) as overlap,
             (select count(*) from known) as universe, (select count(*) from hits) as n_hits
           from (select distinct term, gene from fx_gene_sets) s join known k on s.gene = k.gene left join hits h on s.gene = h.gene
           group by 1),
tails as (select term, set_size, overlap, universe, n_hits, least(1.0, sum(exp(
    lgamma(set_size + 1.0) - lgamma(x + 1.0) - lgamma(set_size - x + 1.0)
    + lgamma(universe - set_size + 1.0) - lgamma(n_hits - x + 1.0) - lgamma(universe - set_size - n_hits + x + 1.0)
    - lgamma(universe + 1.0) + lgamma(n_hits + 1.0) + lgamma(universe - n_hits + 1.0)))) as p
  from (select *, unnest(generate_series(greatest(overlap, n_hits + set_size - universe, 0), least(set_size, n_hits))) as x from counts) c
  group by all)""",
)
oracle(
    "allele_fractions",
    ("fx_format_strings",),
    """select l_orderkey, l_linenumber, smp, round(case
    when list_contains(string_split(fmt, ':'), 'AF') and try_cast(split_part(split_part(smp, ':', 2), ',', 1) as double) is not null
      then try_cast(split_part(split_part(smp, ':', 2), ',', 1) as double)
    when fmt = 'GT:AF:AD' then cast(split_part(split_part(smp, ':', 3), ',', 2) as double)
      / (cast(split_part(split_part(smp, ':', 3), ',', 1) as double) + cast(split_part(split_part(smp, ':', 3), ',', 2) as double))
    when fmt = 'GT:AD' and cast(split_part(split_part(smp, ':', 2), ',', 1) as double) + cast(split_part(split_part(smp, ':', 2), ',', 2) as double) > 0
      then cast(split_part(split_part(smp, ':', 2), ',', 2) as double)
      / (cast(split_part(split_part(smp, ':', 2), ',', 1) as double) + cast(split_part(split_part(smp, ':', 2), ',', 2) as double))
    else 1.0 end, 6) as af
from fx_format_strings""",
)

_BURDEN_END = "([.]filtered[.]annotated[.]vcf[.]gz|[.]filtered[.]annotated[.]vcf|[.]filtered[.]vcf[.]gz|[.]filtered[.]vcf|[.]raw[.]vcf[.]gz|[.]raw[.]vcf|[.]vcf[.]gz|[.]vcf)$"
_ALL_END = "([.]filtered[.](annotated|with_filters)[.]vcf([.]gz)?|[.]filtered[.]vcf([.]gz)?|[.]raw[.]vcf([.]gz)?|[.]vcf([.]gz)?|[.]bam)$"


def _norm(name: str, ending: str) -> str:
    return f"replace(regexp_replace({name}, '{ending}', ''), 'Aligned.sortedByCoord.out', '')"


_NAME = "split_part(path, '/', -1)"
F = ("fx_files",)
oracle(
    "sample_id_normalize",
    F,
    f"select path, {_norm(_NAME, _BURDEN_END)} as burden_id, {_norm(_NAME, _ALL_END)} as integration_id from fx_files",
)
oracle(
    "best_vcf_per_sample",
    F,
    f"""select sample_id, path, rank from (select *, row_number() over (partition by sample_id order by rank, path) as k from (
      select {_norm(_NAME, _ALL_END)} as sample_id, path, cast(case when path like '%.filtered.vcf' then 0
        when path like '%.filtered.vcf.gz' then 1 when path like '%.filtered.annotated.vcf' then 2
        when path like '%.filtered.annotated.vcf.gz' then 3 when path like '%.raw.vcf' then 4 when path like '%.raw.vcf.gz' then 5
        when path like '%.vcf' then 6 when path like '%.vcf.gz' then 7 end as integer) as rank from fx_files) q where rank is not null) r where k = 1""",
)
oracle(
    "best_burden_vcf",
    F,
    f"""select sample_id, path, rank from (select *, row_number() over (partition by sample_id order by rank, path) as k from (
      select {_norm(_NAME, _BURDEN_END)} as sample_id, path, cast(case when path like '%.filtered.vcf.gz' then 0
        when path like '%.filtered.vcf' then 1 end as integer) as rank from fx_files) q where rank is not null) r where k = 1""",
)
READS = """
reads as (select path, regexp_extract(split_part(path, '/', -1), '^(.+?)_([rR][123])(_[0-9]+)?[.]f(ast)?q([.]gz)?$', 1) as sample_id,
  upper(regexp_extract(split_part(path, '/', -1), '^(.+?)_([rR][123])(_[0-9]+)?[.]f(ast)?q([.]gz)?$', 2)) as read from fx_files),
found as (select * from reads where sample_id <> '')"""
FS = ("fx_files", "fx_samples")
oracle(
    "metadata_fastq_check",
    FS,
    "select sample_id, "
    + ", ".join(
        f"exists (select 1 from found f where f.sample_id = s.sample_id and f.read = 'R{i}') as \"has_R{i}\"" for i in (1, 2, 3)
    )
    + " from fx_samples s",
    READS,
)
oracle(
    "input_overview",
    FS,
    """select 'n_samples' as metric, count(*) as value from fx_samples union all
     select 'n_samples_with_R3', count(*) from fx_samples where sample_id in (select sample_id from found where read = 'R3')""",
    READS,
)
oracle(
    "samples_without_third_read",
    FS,
    "select sample_id from fx_samples where sample_id not in (select sample_id from found where read = 'R3')",
    READS,
)
oracle(
    "read_path",
    FS,
    """select sample_id, read, path from (select *, row_number() over (partition by sample_id, read order by
       case when path like '%.fastq.gz' then 0 when path like '%.fq.gz' then 1 when path like '%.fastq' then 2 else 3 end, path) as k
     from found) q where k = 1""",
    READS,
)
oracle(
    "natural_sort",
    (),
    """select name, row_number() over (order by regexp_replace(name, '[0-9]+', '', 'g'),
       cast(regexp_extract_all(name, '[0-9]+') as hugeint[]), name) as position
     from (select distinct p_name || '_' || cast(p_partkey as string) as name from part) q""",
)
OBS = ("fx_observed", "fx_sites", "fx_cluster_map")
oracle("cell_allele_counts", OBS, "select * from cell_counts", CELLS)
oracle("cell_cluster_lookup", OBS, "select * from lookup", CELLS)
oracle("cluster_allele_sums", OBS, "select * from sums", CELLS)
oracle("matrix_cluster_sums", OBS, "select * from all_sums where alt_sum >= 2", CELLS)
oracle(
    "cluster_metrics",
    OBS,
    """select a.sample_id, count(s.alt_sum) as cluster_variant_rows, coalesce(cast(sum(s.alt_sum) as double), 0) as cluster_alt_sum_total,
       coalesce(cast(sum(s.depth_sum) as double), 0) as cluster_depth_sum_total,
       round(coalesce(sum(s.alt_sum) / sum(s.depth_sum), 0), 6) as cluster_mean_vaf, count(distinct s.cluster) as cluster_count
     from (select distinct sample_id from fx_variants) a left join sums s using (sample_id) group by 1""",
    CELLS,
)
oracle("barcode_cores", ("fx_all_clusters",), "select cell_id, split_part(split_part(cell_id, '_', 2), '-', 1) as barcode from fx_all_clusters")
oracle(
    "sample_contains",
    ("fx_all_clusters",),
    "select sample, count(*) as cells from fx_all_clusters where contains(sample, 'S0') group by 1",
)
MERGED = """
merged as (select a.sample_id, a.record_idx, '@r' || cast(a.record_idx as string) || '/R2' as header, a.seq || b.seq as seq,
  '+' as plus, a.qual || b.qual as qual
  from fx_reads a join fx_reads b on a.sample_id = b.sample_id and a.record_idx = b.record_idx and a.read = 'R2' and b.read = 'R3')"""
R = ("fx_reads",)
oracle("fastq_merge_r2_r3", R, "select * from merged", MERGED)
oracle("cb_umi_split", R, "select sample_id, record_idx, substr(seq, 1, 16) as cb, substr(seq, 17, 10) as umi from merged", MERGED)
oracle(
    "whitelist_barcodes",
    R,
    """select sample_id, record_idx, substr(seq, 1, 16) as cb from merged
     where substr(seq, 1, 16) in (select seq from fx_reads where read = 'R2' and sample_id < 'S08')""",
    MERGED,
)

oracle(
    "sample_integration",
    INTEGRATED_VIEWS,
    """select * replace (round(cluster_mean_vaf, 6) as cluster_mean_vaf, cast(cluster_variant_rows as double) as cluster_variant_rows,
       cast(cluster_count as double) as cluster_count) from integrated""",
    INTEGRATED,
)
oracle(
    "condition_summary",
    INTEGRATED_VIEWS,
    "select condition, count(*) as sample_count, "
    + ", ".join(f"round(avg({m}), 6) as {m}" for m in METRIC_LIST)
    + " from integrated group by 1",
    INTEGRATED,
)
RHO = INTEGRATED + "," + _pairs("integrated", METRIC_LIST)
oracle(
    "spearman_pairs",
    INTEGRATED_VIEWS,
    "select metric_x, metric_y, n_samples, round(spearman_rho, 6) + 0.0 as spearman_rho from rho",
    RHO,
)
# Two-sided t tail as a finite sum, for up to 10 degrees of freedom (12 samples).
oracle(
    "spearman_tests",
    INTEGRATED_VIEWS,
    """select metric_x, metric_y, n_samples, round(p, 5) as p_value,
       round(least(1.0, min(p * m / r) over (order by p desc, r desc rows between unbounded preceding and current row)), 5) as fdr_bh
     from (select *, count(*) over () as m, row_number() over (order by p, metric_x, metric_y) as r from tested) q""",
    RHO
    + """,
angles as (select *, n_samples - 2 as df, atan(abs(spearman_rho) / sqrt(greatest(1 - spearman_rho * spearman_rho, 1e-18))) as a,
  1 - spearman_rho * spearman_rho as c2 from rho),
terms as (select *, case when df % 2 = 0
    then sin(a) * (1 + case when df > 2 then c2 / 2 else 0 end + case when df > 4 then 3 * pow(c2, 2) / 8 else 0 end
      + case when df > 6 then 5 * pow(c2, 3) / 16 else 0 end + case when df > 8 then 35 * pow(c2, 4) / 128 else 0 end)
    else 2 / pi() * (a + case when df > 1 then sin(a) * sqrt(c2) * (1 + case when df > 3 then 2 * c2 / 3 else 0 end
      + case when df > 5 then 8 * pow(c2, 2) / 15 else 0 end + case when df > 7 then 16 * pow(c2, 3) / 35 else 0 end) else 0 end) end as inside from angles),
tested as (select metric_x, metric_y, n_samples, case when c2 < 1e-14 then 0.0 else greatest(0.0, 1 - inside) end as p from terms)""",
)
oracle(
    "correlation_matrix",
    INTEGRATED_VIEWS,
    "select a.metric, "
    + ", ".join(
        f"case when a.metric = '{m}' then 1.0 else round(max(case when b.other = '{m}' then b.r end), 6) + 0.0 end as {m}" for m in METRIC_LIST
    )
    + " from (select unnest(["
    + ", ".join(f"'{m}'" for m in METRIC_LIST)
    + """]) as metric) a left join (select metric_x as metric, metric_y as other, spearman_rho as r from rho
      union all select metric_y, metric_x, spearman_rho from rho) b on a.metric = b.metric group by a.metric""",
    RHO,
)
oracle(
    "top_associations",
    INTEGRATED_VIEWS,
    """select metric_x, metric_y, n_samples, round(spearman_rho, 6) as spearman_rho from rho
     order by round(abs(spearman_rho), 9) desc, metric_x, metric_y limit 10""",
    RHO,
)
oracle(
    "spearman_with_gaps",
    (),
    "select metric_x, metric_y, n_samples, round(spearman_rho, 6) + 0.0 as spearman_rho from rho",
    """
wide as (select c.c_custkey as sample_id, c.c_acctbal, cast(c.c_nationkey as double) as nation, o.n_orders,
  case when c.c_custkey % 3 <> 0 then o.largest end as largest
  from customer c left join (select o_custkey, count(*) as n_orders, round(max(o_totalprice), 2) as largest from orders group by 1) o
  on c.c_custkey = o.o_custkey),"""
    + _pairs("wide", ["c_acctbal", "nation", "n_orders", "largest"]),
)
oracle(
    "bh_fdr",
    ("fx_pvalues",),
    """select event_id, p, round(least(1.0, min(p * m / r) over (order by p desc, event_id desc
         rows between unbounded preceding and current row)), 6) as fdr_bh
     from (select *, count(*) over () as m, row_number() over (order by p, event_id) as r from fx_pvalues) q""",
)
oracle(
    "average_ranks",
    (),
    """select event_id, event_type, value, rank() over (partition by event_type order by value)
       + (count(*) over (partition by event_type, value) - 1) / 2.0e0 as rank from events""",
)
oracle(
    "group_medians",
    (),
    "select event_type, count(*) as n, min(value) as min, median(value) as median, max(value) as max from events group by 1",
)
SC = ("fx_scores",)
AUC = """(sum(rk) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2.0)
       / (count(*) filter (where y = 1) * count(*) filter (where y = 0))"""
oracle(
    "roc_auc",
    SC,
    f"""select grp, case when count(distinct y) = 2 then round({AUC}, 6) end as roc_auc
     from (select *, rank() over (partition by grp order by score) + (count(*) over (partition by grp, score) - 1) / 2.0 as rk
           from fx_scores) q group by 1""",
)
oracle(
    "classification_metrics",
    SC,
    f"""select n, round((tp + tn) / n, 6) as accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) as balanced_accuracy,
       round(2 * tp / (2 * tp + fp + fn), 6) as f1_positive, round(auc, 6) as roc_auc from (
     select count(*) as n, count(*) filter (where y = 1 and pred = 1) as tp, count(*) filter (where y = 0 and pred = 1) as fp,
       count(*) filter (where y = 1 and pred = 0) as fn, count(*) filter (where y = 0 and pred = 0) as tn, {AUC} as auc
     from (select *, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as rk from fx_scores) r) q""",
)
oracle(
    "confusion_matrix",
    SC,
    """select 'documents' as analysis, case y when 1 then 'high' else 'low' end as true_condition,
       count(*) filter (where pred = 0) as pred_low, count(*) filter (where pred = 1) as pred_high from fx_scores group by y""",
)
oracle(
    "group_predictions",
    SC,
    """select grp, n_runs, true_label, group_title, round(mp, 6) as mean_prob_positive, round(ms, 6) as mean_decision_score,
       cast(mp >= 0.5 as integer) as predicted_label, true_label = cast(mp >= 0.5 as integer) as correct
     from (select grp, count(*) as n_runs, max(y) as true_label, avg(prob) as mp, avg(score) as ms,
       array_to_string(list_sort(list(distinct title)), ';') as group_title from fx_scores group by 1) q""",
)
FOLDS = """
folds as (select repeat, cast((row_number() over (partition by repeat, label order by
    md5('42|' || cast(repeat as string) || '|' || cast(sample_id as string))) - 1) % 5 as integer) as fold, sample_id, label, gsm
  from fx_customers cross join (select unnest([1, 2, 3]) as repeat) r)"""
OVERLAP = (
    FOLDS
    + """,
overlap as (select repeat, fold, count(*) as n_test, count(*) filter (where seen) as seen, count(*) filter (where seen) / count(*) as rate
  from (select f.*, exists (select 1 from folds o where o.repeat = f.repeat and o.gsm = f.gsm and o.fold <> f.fold) as seen from folds f) q
  group by 1, 2)"""
)
C = ("fx_customers",)
oracle("stratified_folds", C, "select repeat, fold, sample_id, label from folds", FOLDS)
oracle(
    "logo_folds",
    C,
    """select cast(row_number() over (order by gsm) as integer) as fold, gsm as heldout_group,
       cast(sum(n) over () - n as bigint) as n_train, n as n_test from (select gsm, count(*) as n from fx_customers group by 1) q""",
)
oracle(
    "fold_group_overlap",
    C,
    """select repeat, fold, n_test, seen as test_observations_with_group_seen_in_train,
       round(rate, 6) as test_group_overlap_rate from overlap""",
    OVERLAP,
)
oracle(
    "fold_summary",
    C,
    """select count(*) as n_folds, round(avg(n_test / 7.0e0), 6) as share_mean, round(stddev_samp(n_test / 7.0e0), 6) as share_sd,
       round(avg(rate), 6) as test_group_overlap_rate_mean, round(median(rate), 6) as test_group_overlap_rate_median from overlap""",
    OVERLAP,
)
oracle(
    "group_label_check",
    C,
    """select gsm, min(label) as first_label, max(label) as last_label, count(*) as n from fx_customers group by 1
     having count(distinct label) > 1""",
)
oracle("class_size_check", C, "select label, count(*) as n from fx_customers group by 1")
# Six groups with three positive ones at every scale, so the sets are triples.
TRIPLES = """
g as (select distinct gsm from fx_samples),
triples as (select a.gsm || ';' || b.gsm || ';' || c.gsm as positive_groups, [a.gsm, b.gsm, c.gsm] as members
  from g a join g b on a.gsm < b.gsm join g c on b.gsm < c.gsm),
sets as (select row_number() over (order by members) as permutation_id, positive_groups, members from triples)"""
S = ("fx_samples",)
oracle(
    "group_labelings",
    S,
    """select permutation_id, positive_groups, positive_groups = (select string_agg(gsm, ';' order by gsm) from
       (select distinct gsm from fx_samples where condition = 'disease') d) as is_observed_labeling from sets""",
    TRIPLES,
)
oracle(
    "relabeled_samples",
    S,
    "select t.permutation_id, s.sample_id, s.gsm from sets t join fx_samples s on list_contains(t.members, s.gsm)",
    TRIPLES,
)
oracle(
    "permuted_labels",
    C,
    """select permutation_id, sample_id, cast(row_number() over (partition by permutation_id order by
         md5('perm42|' || cast(permutation_id as string) || '|' || cast(sample_id as string)))
         <= (select count(*) from fx_customers where label = 'BUILDING') as integer) as y
     from fx_customers cross join (select unnest([1, 2, 3, 4, 5]) as permutation_id) p""",
)
_METHOD = """select '{m}' as metric, (select {m} from obs) as observed_value, count(*) as n_labelings_including_observed,
  count(*) filter (where {m} >= (select {m} from obs)) as n_labelings_ge_observed"""
oracle(
    "permutation_pvalue",
    (),
    """select metric, observed_value, n_labelings_including_observed, n_labelings_ge_observed, method,
       round(case method when 'exact' then n_labelings_ge_observed / n_labelings_including_observed
         else (n_labelings_ge_observed + 1) / (n_labelings_including_observed + 1) end, 6) as p_value
     from counts cross join (select unnest(['exact', 'random']) as method) m""",
    f"""
scores as (select event_id, round(value % 1, 2) as a, round((value * 3) % 1, 2) as b from events),
obs as (select a, b from scores where event_id = 17),
counts as ({_METHOD.format(m='a')} from scores union all {_METHOD.format(m='b')} from scores)""",
)

E = ("fx_stage_events",)
STATE = """
marks as (select stage, estimate_seconds, type, ts, event_id from fx_stage_events),
latest as (select stage, max(estimate_seconds) as est,
  max(event_id) filter (where type = 'start') as s, max(event_id) filter (where type = 'finish') as f, max(event_id) filter (where type = 'error') as e
  from marks group by 1),
state as (select l.stage, est, case when coalesce(e, -1) > greatest(coalesce(s, -1), coalesce(f, -1)) then 'error'
    when coalesce(f, -1) > coalesce(s, -1) then 'finished' when s is null then 'idle' else 'running' end as last_status,
  a.ts as last_start_ts, case when coalesce(f, -1) > coalesce(s, -1) then b.ts end as last_end_ts,
  case when f > s then epoch_us(b.ts) / 1e6 - epoch_us(a.ts) / 1e6 end as dur,
  case when coalesce(e, -1) > greatest(coalesce(s, -1), coalesce(f, -1)) then c.ts end as last_error_ts
  from latest l left join marks a on l.s = a.event_id left join marks b on l.f = b.event_id left join marks c on l.e = c.event_id)"""
oracle(
    "stage_status",
    E,
    """select stage, last_status, last_start_ts, last_end_ts, round(dur, 3) as last_duration,
       round(dur - est, 3) as last_estimate_error, last_error_ts from state""",
    STATE,
)
oracle(
    "stage_durations",
    E,
    """select stage, event_id, start_ts, ts as end_ts, round(epoch_us(ts) / 1e6 - epoch_us(start_ts) / 1e6, 3) as duration,
       round(epoch_us(ts) / 1e6 - epoch_us(start_ts) / 1e6 - estimate_seconds, 3) as estimate_error
     from (select *, last_value(case when type = 'start' then ts end ignore nulls) over (partition by stage order by event_id
       rows between unbounded preceding and 1 preceding) as start_ts from fx_stage_events) q where type = 'finish' and start_ts is not null""",
)
oracle(
    "stage_anomalies",
    E,
    """select stage, last_status, last_status = 'finished' and coalesce(max(cast(last_status <> 'finished' as int)) over (order by stage
         rows between unbounded preceding and 1 preceding), 0) = 1 as out_of_order_finished,
       last_status = 'running' and coalesce(count(*) filter (where last_status = 'running') over (order by stage
         rows between unbounded preceding and 1 preceding), 0) > 0 as multiple_running,
       coalesce(last_status = 'running' and epoch_us((select max(ts) from fx_stage_events)) / 1e6 - epoch_us(last_start_ts) / 1e6
         > greatest(2 * est, 1800), false) as overdue from state""",
    STATE,
)
oracle("status_counts", E, "select last_status as status, count(*) as n from state group by 1", STATE)
oracle(
    "changed_stages",
    E,
    """select s.stage, s.last_status, n.change_note is not null as changed, coalesce(n.change_note, '') as change_note
     from state s left join (select 'stage_' || lpad(cast(user_id % 17 + 1 as string), 2, '0') as stage,
       'changed by ' || cast(min(event_id) as string) as change_note from events where event_type = 'signup' group by 1) n
     on s.stage = n.stage""",
    STATE,
)
oracle(
    "latest_events",
    E,
    "select stage, type, ts, event_id from fx_stage_events where stage = 'stage_05' order by ts desc, event_id desc limit 25",
)
L = ("fx_log_lines",)
DONE = """
done as (select sample_id, line_no, regexp_extract(line, 'tool[.]([A-Za-z]+) done', 1) as step,
  cast(regexp_extract(line, 'Elapsed time: ([0-9.]+) minutes', 1) as double) as m from fx_log_lines where contains(line, ' done. Elapsed'))"""
oracle(
    "log_done_steps",
    L,
    "select sample_id, step, round(arg_max(m, line_no), 6) as elapsed_minutes, count(*) as reports from done group by 1, 2",
    DONE,
)
oracle(
    "log_step_stats",
    L,
    """select step, count(*) as n, round(case when count(*) = 1 then greatest(0.1, min(m) * 0.8) else min(m) end, 6) as min_minutes,
       round(median(m), 6) as expected_minutes, round(case when count(*) = 1 then max(m) * 1.3 else max(m) end, 6) as max_minutes
     from done where m > 0 group by 1""",
    DONE,
)
SIZES = ", sizes as (select sample_id, count(*) / 100 as gb from fx_log_lines group by 1)"
oracle(
    "size_duration_model",
    L,
    """select step, count(*) as n, round(median(m / gb) * 0.9, 6) as min_per_gb, round(median(m / gb), 6) as expected_per_gb,
       round(median(m / gb) * 1.15, 6) as max_per_gb from done join sizes using (sample_id) where m > 0 group by 1""",
    DONE + SIZES,
)
oracle(
    "sample_duration_model",
    L,
    """select 'sample' as scope, count(*) as n, round(median(t / gb) * 0.9, 6) as min_per_gb, round(median(t / gb), 6) as expected_per_gb,
       round(median(t / gb) * 1.2, 6) as max_per_gb
     from (select sample_id, round(sum(m), 3) as t from done group by 1) q join sizes using (sample_id) where t > 0""",
    DONE + SIZES,
)
oracle(
    "last_log_commands",
    L,
    """select sample_id, arg_max(line, line_no) as last_cmd, max(line_no) as last_cmd_line, 'HaplotypeCaller' as last_step
     from fx_log_lines where line like 'CMD:%' group by 1""",
)
PROGRESS = """
progress as (select sample_id, regexp_extract(line, '(chr[0-9]+):([0-9]+)', 1) as contig,
  cast(regexp_extract(line, '(chr[0-9]+):([0-9]+)', 2) as bigint) as position, 1.5e0 as elapsed_minutes
  from (select *, row_number() over (partition by sample_id order by line_no desc) as k from fx_log_lines where contains(line, 'ProgressMeter')) q
  where k = 1)"""
CONTIGS = """
contigs as (select chrom as contig, n as length, cast(coalesce(sum(n) over (order by chrom rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset",
  cast(sum(n) over () as bigint) as total from (select chrom, max(pos) as n from fx_variants group by 1) q)"""
oracle("last_log_progress", L, "select * from progress", PROGRESS)
oracle("contig_offsets", V, "select * from contigs", CONTIGS)
oracle(
    "log_progress_fraction",
    ("fx_log_lines", "fx_variants"),
    """select sample_id, contig, position, round(least(0.999, greatest(0.001, ("offset" + least(greatest(position, 0), length)) / total)), 6) as fraction
     from progress join contigs using (contig)""",
    PROGRESS + "," + CONTIGS,
)
oracle(
    "log_tails",
    L,
    """select sample_id, line_no, line from (select *, row_number() over (partition by sample_id order by line_no desc) as k
     from fx_log_lines where contains(line, ' done. Elapsed time:')) q where k <= 6""",
)
LISTED = """
listed as (select 'stage_' || cast(page_id % 4 as string) as stage,
  'out/File_' || cast(page_id as string) || ['.tsv', '.PNG', '.md', '.tsv.gz', '.csv', '.json'][page_id % 6 + 1] as path,
  length(html) as size_bytes from pages)"""
oracle(
    "file_summary",
    (),
    """select stage, case when path like '%.PNG' then 'figure' when path like '%.tsv' or path like '%.csv' then 'table'
       when path like '%.md' then 'report' else 'other' end as kind, count(*) as n_files, cast(sum(size_bytes) as bigint) as bytes
     from listed group by 1, 2""",
    LISTED,
)
oracle(
    "report_manifest",
    (),
    """select stage, path as source, 'for_report/' || stage || '_' || cast(row_number() over (partition by stage order by lower(path)) as string)
       || '_' || case when path like '%.tsv.gz' then replace(split_part(path, '/', 2), '.gz', '') || '.tsv.gz' else split_part(path, '/', 2) end as target
     from listed""",
    LISTED,
)
# The streams read all input at once, so their final state is the batch result.
ORACLES["stream_stage_status"] = ORACLES["stage_status"]
# A window is final once the watermark (latest event time less ten minutes) has passed its end.
oracle(
    "stream_event_windows",
    E,
    """select window_start, window_start + interval 1 hour as window_end, type, n
     from (select date_trunc('hour', ts) as window_start, type, count(*) as n from fx_stage_events group by 1, 2) q
     where window_start + interval 1 hour <= (select max(ts) - interval 10 minute from fx_stage_events)""",
)
# A start is overdue when the stage's next start, finish or error comes after its limit, or never does
# and the watermark has passed the limit.
oracle(
    "stream_overdue_alerts",
    E,
    """select stage, make_timestamp(s * 1000) as start_ts, lim / 1000 as threshold_seconds, make_timestamp((s + lim) * 1000) as alert_ts from (
       select stage, type, epoch_us(ts) // 1000 as s, cast(greatest(2 * estimate_seconds, 1800) * 1000 as bigint) as lim,
         lead(epoch_us(ts) // 1000) over (partition by stage order by ts, event_id) as nxt,
         lead(type) over (partition by stage order by ts, event_id) as nxt_type,
         (select epoch_us(max(ts)) // 1000 from fx_stage_events where type in ('start', 'finish', 'error')) - 600000 as mark
       from fx_stage_events where type in ('start', 'finish', 'error')) q
     where type = 'start' and (nxt > s + lim or (nxt is null and mark > s + lim))""",
)
oracle(
    "stream_cohort_counts",
    V,
    """select chrom, pos, ref, alt, count(distinct sample_id) as cohort_count, round(max(af), 6) as max_af from fx_variants
     group by 1, 2, 3, 4 having count(distinct sample_id) >= 4 and max(af) >= 0.05""",
)

# Both deliveries together are all calls; a sample's fraction at a locus is that of its first record.
oracle(
    "stream_cohort_versions",
    V,
    """select chrom, pos, ref, alt, count(*) as cohort_count, round(greatest(0, max(af)), 6) as max_af from (
       select chrom, pos, ref, alt, sample_id, arg_min(af, rec_order) as af from fx_variants group by all) q
     group by all having count(*) >= 4 and max(af) >= 0.05""",
)
oracle(
    "stream_stage_errors",
    E,
    """select stage, last_status, last_start_ts, last_end_ts,
       case when last_error_ts is not null then 'failed at ' || cast(e as string) end as last_error, last_error_ts
     from state join (select stage, e from latest) l using (stage)""",
    STATE,
)
# A start comes out once the watermark has passed half an hour after it, the largest limit.
oracle(
    "stream_unmet_starts",
    E,
    """select stage, ts as start_ts, lim / 1000 as threshold_seconds, make_timestamp((s + lim) * 1000) as alert_ts from (
       select stage, type, ts, epoch_us(ts) // 1000 as s, cast(greatest(2 * estimate_seconds, 1800) * 1000 as bigint) as lim,
         lead(epoch_us(ts) // 1000) over (partition by stage order by ts, event_id) as nxt,
         (select epoch_us(max(ts)) // 1000 from fx_stage_events where type in ('start', 'finish', 'error')) - 600000 as mark
       from fx_stage_events where type in ('start', 'finish', 'error')) q
     where type = 'start' and coalesce(nxt > s + lim, true) and s + 1800000 <= mark""",
)

oracle(
    "display_text",
    (),
    """select event_id, printf('%.3f', mean / 1000) || case when event_id % 2 = 0 then ' +/- ' || printf('%.3f', sd / 1000) else '' end as mean_sd,
       minutes, case when value >= 50 then '+' else '-' end || signed as signed_minutes
     from (select *, case when m < 1 then printf('%.1f', round_even(m, 1)) || ' min' when m < 90 then cast(cast(round_even(m, 0) as bigint) as string) || ' min'
         else cast(cast(floor(m / 60) as bigint) + cast(r = 60 as int) as string) || ' h ' || cast(case when r = 60 then 0 else r end as string) || ' min' end as minutes,
         case when n < 1 then printf('%.1f', round_even(n, 1)) || ' min' when n < 90 then cast(cast(round_even(n, 0) as bigint) as string) || ' min'
         else cast(cast(floor(n / 60) as bigint) + cast(s = 60 as int) as string) || ' h ' || cast(case when s = 60 then 0 else s end as string) || ' min' end as signed
       from (select event_id, value, m, n, mean, sd, cast(round_even(m - floor(m / 60) * 60, 0) as bigint) as r, cast(round_even(n - floor(n / 60) * 60, 0) as bigint) as s
             from (select event_id, value, greatest(value, 0.0e0) as m, abs(value - 50) as n, c * 5 // 4 + case when c * 5 % 4 = 2 then c * 5 // 4 % 2 else cast(c * 5 % 4 > 2 as int) end as mean,
               c * 5 // 8 + case when c * 5 % 8 = 4 then c * 5 // 8 % 2 else cast(c * 5 % 8 > 4 as int) end as sd
             from (select *, cast(round(value * 100) as bigint) as c from events) q0) q1) q2) q3""",
)
