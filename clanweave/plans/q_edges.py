"""Queries for similarity edges."""

from pyspark.sql import functions as F

from clanweave.operators import edges as E
from clanweave.operators import graph as G
from clanweave.plans.catalog import query

Q_BOX = "quantile_cont({v}, 0.0) as low, quantile_cont({v}, 0.25) as q1, quantile_cont({v}, 0.5) as median, quantile_cont({v}, 0.75) as q3, quantile_cont({v}, 1.0) as high"
SIZES = "sizes as (select rep, count(*) as n from members group by rep)"
PAIRED = f"""{SIZES}, paired as (select e.*, case when e.src = e.dst then a.n * (a.n - 1) // 2 else a.n * b.n end as n_pairs
    from canon e join sizes a on a.rep = e.src join sizes b on b.rep = e.dst)"""


@query("wn01_canonicalize_edges", "select src, dst, pid, alen, bitscore, src_len, dst_len from canon")
def _(v):
    return E.canonicalize_edges(v.hits)


@query("wn02_best_edge_per_pair", "select src, dst, pid, alen, bitscore, src_len, dst_len from edges")
def _(v):
    return v.edges


@query(
    "jn10_attach_lengths",
    """select h.src, h.dst, h.bitscore, a."Sequence_Length" as src_len, b."Sequence_Length" as dst_len from hits h
    left join annotations a on a.accession = h.src left join annotations b on b.accession = h.dst""",
)
def _(v):
    seqs = v.annotations.select(F.col("accession").alias("id"), F.col("Sequence_Length").alias("seq_len"))
    return E.attach_lengths(v.hits.select("src", "dst", "bitscore"), seqs).select("src", "dst", "bitscore", "src_len", "dst_len")


@query(
    "jn11_edges_within_clusters",
    """select 'UP' || e.src as src, 'UP' || e.dst as dst, e.bitscore from edges e join uniref a on a.accession = e.src join uniref b on b.accession = e.dst
    where a.uniref50_seed = b.uniref50_seed and length(e.src) in (4, 8) and length(e.dst) in (4, 8)""",
)
def _(v):
    long = lambda c: F.concat(F.lit("UP"), c).alias(c)
    c = v.uniref.select(F.concat(F.lit("UP"), "accession").alias("id"), F.col("uniref50_seed").alias("cluster"))
    return E.edges_within_clusters(v.edges.select(long("src"), long("dst"), "bitscore"), c)


@query("jn12_edges_between_representatives", "select src, dst, bitscore from edges where src in (select rep from members) and dst in (select rep from members)")
def _(v):
    return E.edges_between_representatives(v.edges, v.members).select("src", "dst", "bitscore")


@query("jn13_demultiplex", f"with {PAIRED} select src, dst, bitscore, n_pairs from paired")
def _(v):
    return E.demultiplex_counts(E.canonicalize_edges(v.hits), v.members).select("src", "dst", "bitscore", "n_pairs")


@query(
    "jn13_demultiplex_degrees",
    f"""with {SIZES}, best as (select src, dst from canon group by 1, 2), around as (select a as rep, sum(n) as d from (select src as a, dst as b from best where src <> dst
    union all select dst, src from best where src <> dst) join sizes on rep = b group by 1),
    own as (select src as rep, n - 1 as d from best join sizes on rep = src where src = dst)
    select m.member, (coalesce(a.d, 0) + coalesce(o.d, 0))::bigint as degree from members m left join around a on a.rep = m.rep left join own o on o.rep = m.rep
    where true""".replace("where true", ""),
)
def _(v):
    reps = v.members.select("rep").distinct()
    pairs = E.canonicalize_edges(v.hits).select("src", "dst").distinct()
    pairs = pairs.join(reps.withColumnRenamed("rep", "src"), "src", "left_semi").join(reps.withColumnRenamed("rep", "dst"), "dst", "left_semi")
    return E.demultiplex_degrees(pairs, v.members)


@query(
    "ag07_convergence_ratio",
    "select (select count(*) from edges) as edge_count, (select count(*) from nodes) as unique_seq, round(2.0 * (select count(*) from edges) / ((select count(*) from nodes)::double * ((select count(*) from nodes) - 1)), 9) as ratio",
)
def _(v):
    return E.convergence_ratio(v.edges, v.nodes).withColumn("ratio", F.round("ratio", 9))


@query(
    "ag07_convergence_ratio_demultiplexed",
    f"""with {PAIRED}, n as (select count(*) as n from members) select (select sum(n_pairs)::bigint from paired) as edge_count, n as unique_seq,
    round(2.0 * (select sum(n_pairs) from paired)::double / (n::double * (n - 1)), 9) as ratio from n""",
)
def _(v):
    pairs = E.demultiplex_counts(E.canonicalize_edges(v.hits), v.members)
    return E.convergence_ratio(pairs, v.members, weight="n_pairs").withColumn("ratio", F.round("ratio", 9))


@query(
    "ag10_score_histogram",
    """with c as (select score, count(*) as edges from scored group by 1), m as (select *, row_number() over (order by score) - 1 as i, count(*) over () as n,
    sum((edges >= 300)::int) over (order by score) as lead_run, sum((edges >= 300)::int) over (order by score desc) as trail_run from c),
    h as (select *, lead_run = 0 and n - i > 5 as gone from m), t as (select *, sum(gone::int) over () as nh from h)
    select score, edges from t where not gone and not (trail_run = 0 and i - 2 * nh > 5)""",
)
def _(v):
    return E.score_histogram(v.edges, min_edges=300, min_scores=5)


@query("ag11_score_cumulative", "select score, edges, sum(edges) over (order by score desc)::bigint as at_least from (select score, count(*) as edges from scored group by 1)")
def _(v):
    return E.score_cumulative(v.edges)


@query("ag12_score_quartiles_alen", f"select score, {Q_BOX.format(v='alen::double')} from scored group by score")
def _(v):
    return E.score_quartiles(v.edges, "alen")


@query("ag12_score_quartiles_pid", f"select score, {Q_BOX.format(v='pid')} from scored group by score")
def _(v):
    return E.score_quartiles(v.edges, "pid")


@query("ag17_node_degree", "select a as node, count(*) as degree from (select src as a from edges union all select dst from edges) group by 1")
def _(v):
    return E.node_degree(v.edges)


CONNECTIVITY = """with ends as (select src as node, dst as other from {0} union all select dst, src from {0}), degree as (select node, count(*) as degree from ends group by 1)
    select e.node, count(*) as degree, (sum(d.degree)::bigint * 100 // count(*)) / 100.0::double as connectivity from ends e join degree d on d.node = e.other group by 1"""


@query("gr15_neighborhood_connectivity", CONNECTIVITY.format("edges"))
def _(v):
    return E.neighborhood_connectivity(v.edges)


@query("gr15_neighborhood_connectivity_raw", CONNECTIVITY.format("canon"))
def _(v):
    """Over the rows of the search as they came, with repeated pairs and self hits."""
    return E.neighborhood_connectivity(v.hits)


@query("ag22_member_lists", "select distinct rep, member, count(*) over (partition by rep) as n from members")
def _(v):
    return G.member_lists(v.members)


@query("ag23_cluster_count", "select count(distinct rep) as clusters from members")
def _(v):
    return G.cluster_count(v.members)
