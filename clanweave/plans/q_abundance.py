"""Queries for abundance and markers."""

from pyspark.sql import functions as F

from clanweave.operators import abundance as B
from clanweave.operators import markers as M
from clanweave.plans.catalog import query
from clanweave.plans.q_similarity import GREEDY, levels

READS = """reads as (select sample, count(distinct read_id) as reads from marker_hits group by 1)"""
VALID = f"""{READS}, valid as (select h.*, m.family, m.type, m.marker_len from marker_hits h join markers m on m.marker = h.marker
    where read_len > 0 and alen >= least(marker_len, floor(read_len * 0.95::double / 3)) and read_len >= 90 and pid / 100 >= 0.95::double)"""
COUNTS = f"""{VALID}, spaced as (select *, case when marker_len * 3 > read_len * 0.95::double then marker_len * 3 + (1.0::double - 0.95::double) * 2.0::double * read_len - read_len + 1
    else (read_len - marker_len * 3 - 1)::double end as space from valid),
    counts as (select c.*, share / (reads / 1e9) as norm from (select sample, marker, family, type, marker_len, count(*) as hits, sum(case when space = 0 then 0.0::double else 1.0::double / space end) as share
    from spaced group by all) c join reads r on r.sample = c.sample)"""
FULL = f"""{COUNTS}, grid as (select s.sample, m.family, m.marker, m.marker_len, coalesce(c.norm, 0) as norm, coalesce(c.hits, 0) as hits from (select distinct sample, family from counts) s
    join markers m on m.family = s.family left join counts c on c.sample = s.sample and c.marker = m.marker),
    fam as (select sample, family, median(norm) as median, avg(norm) as mean, sum(hits)::bigint as hits, sum(marker_len)::bigint as marker_length from grid group by 1, 2)"""
CMAP = """cmap as (select 'A' || (1000000 + p_partkey) as protein, p_size::varchar as cluster from part where p_size <= 40)"""
FACTOR = 1_000_000


def reads(v):
    return v.marker_hits.groupBy("sample").agg(F.countDistinct("read_id").alias("reads"))


def counts(v):
    return B.marker_counts(B.valid_hits(v.marker_hits, v.markers), reads(v))


def cluster_map(v):
    from clanweave.plans.views import acc

    return v.table("part").where("p_size <= 40").select(acc("p_partkey").alias("protein"), F.col("p_size").cast("string").alias("cluster"))


def cdhit(v):
    return B.cdhit_table(v.members, cluster_map(v))


@query("ab01_valid_hits", f"with {VALID} select sample, read_id, marker, family, alen from valid")
def _(v):
    return B.valid_hits(v.marker_hits, v.markers).select("sample", "read_id", "marker", "family", "alen")


@query("ab02_marker_counts", f"with {COUNTS} select sample, marker, hits, round(norm, 4) as norm from counts")
def _(v):
    return counts(v).select("sample", "marker", "hits", F.round("norm", 4).alias("norm"))


@query(
    "ab02_full_length_counts",
    f"""with {READS}, f as (select h.sample, h.marker, marker_len, count(*) as hits from marker_hits h join markers m on m.marker = h.marker where alen >= 30 and pid / 100 >= 0.95::double group by all)
    select f.sample, marker, hits, round(hits / (marker_len * 3 / 1000.0::double) / (reads / 1e9), 4) as norm from f join reads r on r.sample = f.sample""",
)
def _(v):
    c = B.marker_counts(B.full_length_hits(v.marker_hits, v.markers), reads(v), full_length=True)
    return c.select("sample", "marker", "hits", F.round("norm", 4).alias("norm"))


@query("ab03_family_abundance", f"with {FULL} select sample, family, round(median, 4) as median, round(mean, 4) as mean, hits, marker_length from fam")
def _(v):
    out = B.family_abundance(counts(v), v.markers)
    return out.withColumn("median", F.round("median", 4)).withColumn("mean", F.round("mean", 4))


ORF = """m as (select family, count(*) as n from markers group by 1), h as ({h} select read_id as orf, marker from marker_hits),
    k as (select orf, regexp_extract(marker, '^(.*)_[TJQ]M.*', 1) as family, count(*) as k from h group by 1, 2),
    s as (select orf, k.family, case when k / n < 0.1 then 0 else k / n end as score from k join m on m.family = k.family)"""


@query(
    "ab04_genome_family_scores",
    f"""with {ORF.format(h='select distinct orf, marker from (').replace('from marker_hits)', 'from marker_hits))')}, t as (select *, sum(score) over (partition by orf) as total from s),
    f as (select family, sum(score * score / total) as score from t where total > 0 and score / total >= 0.1 group by 1) select m.family, round(coalesce(score, 0), 6) as score from m left join f on f.family = m.family""",
)
def _(v):
    h = v.marker_hits.select(F.col("read_id").alias("orf"), "marker")
    return B.genome_family_scores(h, v.markers).withColumn("score", F.round("score", 6))


@query("ab04_genome_family_scores_unannotated", f"with {ORF.format(h='')}, f as (select family, sum(score) as score from s group by 1) select m.family, round(coalesce(score, 0), 6) as score from m left join f on f.family = m.family")
def _(v):
    h = v.marker_hits.select(F.col("read_id").alias("orf"), "marker")
    return B.genome_family_scores(h, v.markers, annotated=False).withColumn("score", F.round("score", 6))


@query("ab05_read_totals", "select sample, count(*) as reads, round(avg(read_len), 6) as mean_len, min(read_len) as min_len from marker_hits group by 1")
def _(v):
    return B.read_totals(v.marker_hits.select("sample", F.col("read_len").alias("len"))).withColumn("mean_len", F.round("mean_len", 6))


MERGED = f"{CMAP}, merged as (select a.sample, coalesce(c.cluster, '#N/A') as cluster, a.protein, a.value from abundance a left join cmap c on c.protein = a.protein)"


def merged(v):
    raw = v.abundance.select("sample", F.concat(F.lit("tr|"), "protein", F.lit("|X")).alias("family"), "value")
    return B.merge_samples(raw, cluster_map(v))


@query("ab06_merge_samples", f"with {MERGED} select sample, cluster, protein, value from merged")
def _(v):
    return merged(v)


@query(
    "ab07_genome_size_normalize",
    f"""with {MERGED} select m.sample, cluster, protein, round(value * case when m.sample = 'AF' then 5e6 else s.size end * 1e-9, 9) as value from merged m
    left join (select l_returnflag || l_linestatus as sample, 1e6 + count(*) as size from lineitem where l_returnflag || l_linestatus <> 'AF' group by 1) s on s.sample = m.sample""",
)
def _(v):
    s = v.table("lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("sample")).where("sample <> 'AF'").groupBy("sample").agg((F.count(F.lit(1)) + 1e6).alias("size"))
    return B.genome_size_normalize(merged(v), s).withColumn("value", F.round("value", 9))


@query("ab08_sum_normalize", "select sample, cluster, protein, round(value / sum(value) over (partition by sample), 12) as value from abundance")
def _(v):
    return B.sum_normalize(v.abundance).withColumn("value", F.round("value", 12))


@query("ab09_cluster_abundance", f"with {MERGED} select sample, cluster, sum(value) as value from merged group by 1, 2")
def _(v):
    return B.cluster_abundance(merged(v))


@query(
    "ab10_merge_runs",
    """select sample, cluster, protein, arg_max(value, run) as value from (select l_linenumber as run, l_linenumber <> 7 or false as completed, l_returnflag || l_linestatus as sample,
    (1 + l_partkey % 25)::varchar as cluster, 'A' || (1000000 + l_partkey) as protein, sum(l_quantity) as value from lineitem group by all) where completed group by 1, 2, 3""",
)
def _(v):
    from clanweave.plans.views import acc

    runs = v.table("lineitem").groupBy(
        F.col("l_linenumber").alias("run"), F.concat("l_returnflag", "l_linestatus").alias("sample"),
        (F.lit(1) + F.col("l_partkey") % 25).cast("string").alias("cluster"), acc("l_partkey").alias("protein"),
    ).agg(F.sum("l_quantity").alias("value")).withColumn("completed", F.col("run") != 7)
    return B.merge_runs(runs, ["cluster", "protein"])


SEEN = f"""{CMAP}, cd as (select coalesce(c.cluster, 'N/A') as cluster, rep as seed, member as protein from members left join cmap c on c.protein = member),
    site as (select distinct l_returnflag || l_linestatus as sample, case when l_returnflag = 'N' then 'gut' else '' end as bodysite, case when l_linestatus = 'O' then 'female' else '' end as gender from lineitem),
    seen as (select protein as seed, protein || ' - ' || coalesce(nullif(bodysite, ''), a.sample) || case when gender <> '' then ', ' || gender else '' end as value from abundance a join site s on s.sample = a.sample where value > 0)"""


@query(
    "ab11_network_abundance",
    f"""with {SEEN} select node_id, 'Metagenomes Identified by Markers' as name, 'string' as type, value from metanode join (select distinct seed from cd) d on d.seed = member join seen s on s.seed = d.seed
    union all select node_id, 'Metagenomes Identified by CD-HIT Family', 'string', value from metanode join cd on cd.protein = member join seen s on s.seed = cd.seed""",
)
def _(v):
    samples = v.table("lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("sample"), F.when(F.col("l_returnflag") == "N", "gut").otherwise("").alias("bodysite"),
        F.when(F.col("l_linestatus") == "O", "female").otherwise("").alias("gender"),
    ).distinct()
    return B.annotate_network_abundance(v.metanode, v.abundance, cdhit(v), samples)


BAYES = f"""{FULL}, kinds as (select 'A' || (1000000 + p_partkey) as family, case p_partkey % 3 when 0 then 'QM' when 1 then 'TM' else 'JM' end as type from part),
    over_ as (select distinct marker, family from (select marker, family from markers where type = 'QM' union all
    select marker, 'A' || (substr(family, 2)::bigint + 1) from markers where type = 'QM')),
    sub as (select f.sample, marker, coalesce(sum(median) filter (k.type in ('TM', 'JM')), 0) as sub, max(case when k.type = 'QM' then o.family end) as family from over_ o join kinds k on k.family = o.family
    join fam f on f.family = o.family group by 1, 2), new as (select s.sample, s.family, max(greatest(0, norm - sub)) as n from counts c join sub s on s.marker = c.marker and s.sample = c.sample
    where s.family is not null and c.type = 'QM' group by 1, 2)"""


@query("ab12_bayes_adjust", f"with {BAYES} select o.sample, o.family, round(coalesce(n, median), 4) as count from fam o left join new on new.family = o.family and new.sample = o.sample")
def _(v):
    from clanweave.plans.views import acc

    c = counts(v)
    k = F.col("p_partkey") % 3
    kinds = v.table("part").select(acc("p_partkey").alias("family"), F.when(k == 0, "QM").when(k == 1, "TM").otherwise("JM").alias("type"))
    q = v.markers.where("type = 'QM'")
    nxt = F.concat(F.lit("A"), (F.substring("family", 2, 20).cast("long") + 1).cast("string"))
    over = q.select("marker", "family").unionByName(q.select("marker", nxt.alias("family"))).distinct()
    return B.bayes_adjust(c.where("type = 'QM'"), B.family_abundance(c, v.markers), over, kinds).withColumn("count", F.round("count", 4))


@query("ag14_order_cluster_sizes", f"with {CMAP} select cluster, count(*) as size, row_number() over (order by count(*) desc, cluster) as position from cmap group by 1")
def _(v):
    return B.order_cluster_sizes(B.cluster_sizes(cluster_map(v)))


@query(
    "jn17_marker_cluster_join",
    f"""with {SEEN} select node_id, 'Marker Types' as name, 'string' as type, 'Junction' as value from metanode where member in (select family from markers)
    union all select node_id, 'Number of Markers', 'integer', n::varchar from metanode join (select family, count(*) as n from markers group by 1) on family = member
    union all select distinct node_id, 'Seed Sequence(s)', 'string', member from metanode where member in (select seed from cd)
    union all select distinct node_id, 'Seed Sequence Cluster(s)', 'string', seed from metanode join cd on protein = member""",
)
def _(v):
    return B.marker_cluster_join(v.metanode, v.markers, cdhit(v))


@query(
    "jn19_cdhit_table",
    f"""with {SEEN}, r as (select seed, row_number() over (order by seed) as k from (select distinct seed from cd)) select cd.cluster, cd.seed, cd.protein, coalesce(color, '') as color from cd join r on r.seed = cd.seed left join palette p on p.cluster = r.k""",
)
def _(v):
    return B.cdhit_table(v.members, cluster_map(v), v.palette)


@query(
    "ag24_identify_metadata",
    """with f as (select * from sequences where seq_len >= 100), n(name, count) as (select 'num_metanodes', count(*) from comp union all select 'num_clusters', count(*) filter (seq_count > 1) from numbered union all
    select 'num_singletons', count(*) filter (seq_count < 2) from numbered union all select 'num_raw_sequences', count(*) from sequences union all select 'num_filtered_sequences', count(*) from f union all
    select 'num_unique_sequences', count(distinct seq) from f union all select 'num_cdhit_clusters', count(distinct rep) from members union all select 'num_markers', count(*) from markers) select name, count from n""",
)
def _(v):
    return B.identify_metadata(v.comp, v.numbered, v.sequences, cdhit(v), v.markers, min_len=100)


@query("ag24_quantify_metadata", "select count(*) as count from (select protein from abundance group by 1 having sum(value) > 0)")
def _(v):
    return B.quantify_metadata(v.abundance, "protein")


# ---- markers --------------------------------------------------------------------------------------
OVER = """cov as (select query as family, unnest(range(qstart, qend + 1)) as pos from self_hits where query <> subject and pid / 100 >= 0.90::double and alen >= 10 and alen / qlen <= 1.0::double
    union all select query, unnest(range(qstart, qend + 1)) from self_hits where query <> subject and pid / 100 >= 0.95::double and alen >= 10 and alen / qlen <= 0.15::double),
    allpos as (select family, seq, unnest(range(1, length(seq) + 1)) as pos from consensus),
    over_ as (select a.family, a.pos, coalesce(n, 0) as n, substr(a.seq, a.pos, 1) as residue from allpos a left join (select family, pos, count(*) as n from cov group by 1, 2) c on c.family = a.family and c.pos = a.pos)"""


def overlap(v, spans=False):
    return M.overlap_counts(v.consensus, [(v.self_hits, 0.90, 10, 1.0), (v.self_hits, 0.95, 10, 0.15)], spans)


@query("mk01_overlap_counts", f"with {OVER} select family, pos::int as pos, n from over_")
def _(v):
    return overlap(v)


@query("mk02_mask_ambiguous", f"with {OVER} select family, pos::int as pos, n + case when residue in ('X', 'x') then 9999999 else 0 end as n from over_")
def _(v):
    return M.mask_ambiguous(overlap(v), v.consensus)


ISLANDS = f"""{OVER}, z as (select family, pos, pos - row_number() over (partition by family order by pos) as g from over_ where n = 0),
    runs as (select family, min(pos) as start, count(*) as len from z group by family, g having count(*) >= 4),
    cum as (select *, coalesce(sum(len) over (partition by family order by start rows between unbounded preceding and 1 preceding), 0) as before from runs),
    tm as (select family, start, least(len, 60 - before)::bigint as len from cum where 60 - before >= 4)"""


@query(
    "mk03_true_markers",
    f"""with {ISLANDS} select t.family, t.start::int as start, (t.start + t.len - 1)::int as "end", substr(seq, t.start, t.len) as seq, row_number() over (partition by t.family order by t.start)::int as ordinal
    from tm t join consensus c on c.family = t.family""",
)
def _(v):
    return M.true_markers(overlap(v, spans=True), v.consensus, min_len=4, max_total=60)


@query("mk04_junction_markers")
def _(v):
    return M.junction_markers(v.consensus, v.self_hits, x_limit=1)


@query(
    "mk05_quasi_markers",
    f"""with {OVER}, t as (select family, pos, sum(round(pow(n::double, 0.25) * 1000000)::bigint) over (partition by family order by pos)::bigint as t from over_ union all select distinct family, 0, 0 from over_),
    size as (select family, seq, length(seq) as len from consensus where length(seq) > 0),
    win as (select s.family, x.pos as a, y.t - x.t as w from size s join t x on x.family = s.family and x.pos <= greatest(len - 33, 0) join t y on y.family = s.family and y.pos = least(x.pos + 33, len)),
    best as (select s.*, a, a + 33 as b0, greatest(least(len - 1, case when len - a < 60 then len - 1 else a + 59 end), a + 33) as most
        from size s join (select family, min_by(a, (w, a)) as a from win group by family) using (family)),
    ends as (select b.family, count(e.pos) as more from best b join t x on x.family = b.family and x.pos = a left join t e on e.family = b.family and e.pos > b0 and e.pos <= most and e.t - x.t <= 40000000 group by b.family),
    wide as (select b.*, b0 + more as b from best b join ends using (family)),
    firsts as (select w.family, count(f.pos) as more from wide w join t y on y.family = w.family and y.pos = least(b, len)
        left join t f on f.family = w.family and b = most and f.pos >= greatest(least(b, len) + 1 - 60, 0) and f.pos < a and y.t - f.t <= 40000000 group by w.family),
    done as (select w.family, seq, len, a - more as a, b from wide w join firsts using (family))
    select d.family, (a + 1)::int as start, least(b, len)::int as "end", substr(seq, (a + 1)::bigint, (b - a)::bigint) as seq, ((y.t - x.t) // 1000000)::int as quasi
    from done d join t x on x.family = d.family and x.pos = a join t y on y.family = d.family and y.pos = least(b, len)""",
)
def _(v):
    return M.quasi_markers(overlap(v, spans=True), v.consensus, window=33, threshold=40.0, max_total=60)


@query(
    "mk06_marker_weights",
    f"""with {ISLANDS}, mk as (select family, start, start + len - 1 as "end", family || '_' || start as marker, len from tm),
    ov as (select m.marker, h.subject, least(h.qend, m."end") - greatest(h.qstart, m.start) + 1 as overlap, m.len from mk m join self_hits h on h.query = m.family and h.qstart <= m."end" and h.qend >= m.start and h.query <> h.subject),
    rows as (select marker, subject, overlap from ov union all select marker, family, len from mk)
    select marker, subject, overlap::int as overlap, round(overlap::double / sum(overlap) over (partition by marker), 6) as weight from rows""",
)
def _(v):
    tm = M.true_markers(overlap(v, spans=True), v.consensus, min_len=4, max_total=60)
    mk = tm.select(F.concat_ws("_", "family", "start").alias("marker"), "family", "start", "end")
    hits = v.self_hits.where("query <> subject")
    return M.marker_weights(mk, hits).withColumn("weight", F.round("weight", 6))


@query(
    "mk07_cluster_markers",
    f"""with {ISLANDS}, mk as (select t.family, family || '_' || t.start as marker, substr(seq, t.start, t.len) as seq from tm t join consensus using (family)) select min(marker) over (partition by seq) as rep, marker from mk""",
)
def _(v):
    tm = M.true_markers(overlap(v, spans=True), v.consensus, min_len=4, max_total=60)
    mk = tm.select(F.concat_ws("_", "family", "start").alias("marker"), "seq")
    return M.cluster_markers(mk, identity=1.0)


@query(
    "mk07_cluster_markers_near",
    f"""with recursive {ISLANDS}, mk as (select t.family, t.family || '_' || t.start as marker, substr(seq, t.start, t.len) as seq from tm t join consensus using (family)),
    one as materialized (select min(marker) as id, seq, length(seq) as len from mk group by seq), {levels([(90, 1.0)])},
    gr_pairs as materialized (select 90.0::double as identity, a.id as hi, b.id as lo, a.len as hi_len, b.len as lo_len from one a join one b on a.len = b.len and a.id < b.id where (a.len - hamming(a.seq, b.seq)) * 100.0::double / a.len >= 90),
    {GREEDY} select coalesce(t.top, o.id) as rep, marker from mk join one o on o.seq = mk.seq left join gr_top t on t.id = o.id""",
)
def _(v):
    tm = M.true_markers(overlap(v, spans=True), v.consensus, min_len=4, max_total=60)
    return M.cluster_markers(tm.select(F.concat_ws("_", "family", "start").alias("marker"), "seq"), identity=0.90)


@query(
    "mk08_validate_marker_ids",
    r"""select id, string_agg(reason, ',' order by reason) as reason from (select id, 'bad character' as reason from (select distinct p_brand || case when p_size % 2 = 0 then ':x' else '' end || p_partkey % 300 as id from part)
    where regexp_matches(id, '[\\/*=:''\[\].;,]') union all select id, 'duplicate' from (select p_brand || case when p_size % 2 = 0 then ':x' else '' end || p_partkey % 300 as id from part) group by id having count(*) > 1) group by id""",
)
def _(v):
    ids = v.table("part").select(F.concat("p_brand", F.when(F.col("p_size") % 2 == 0, ":x").otherwise(""), (F.col("p_partkey") % 300).cast("string")).alias("id"))
    return M.validate_marker_ids(ids)


@query(
    "mk09_off_target_markers",
    """select distinct marker from (select 'A' || (1000000 + l_partkey) || '_TM_#0' || l_linenumber as marker, 'A' || (1000000 + l_partkey) as fam, 'A' || (1000000 + l_suppkey * 20 + l_orderkey % 20) as subject,
    90 + l_quantity % 11 as pid, l_quantity as alen, 3 * (8 + l_partkey % 33) as qlen from lineitem) h join (select 'A' || (1000000 + p_partkey) as member, 'A' || (1000000 + p_partkey - p_partkey % 3) as family from part) f
    on f.member = subject where pid / 100 >= 0.95::double and alen >= least(qlen / 3, 32) and family <> fam""",
)
def _(v):
    from clanweave.plans.views import acc

    h = v.table("lineitem").select(
        F.concat(acc("l_partkey"), F.lit("_TM_#0"), F.col("l_linenumber").cast("string")).alias("marker"), acc(F.col("l_suppkey") * 20 + F.col("l_orderkey") % 20).alias("subject"),
        (F.lit(90) + F.col("l_quantity") % 11).alias("pid"), F.col("l_quantity").alias("alen"), (3 * (8 + F.col("l_partkey") % 33)).alias("qlen"),
    )
    fam = v.members.select(F.col("rep").alias("family"), F.col("member").alias("subject"))
    return M.off_target_markers(h, fam)
