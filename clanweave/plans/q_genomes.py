"""Queries for gene neighbourhoods."""

from pyspark.sql import functions as F

from clanweave.operators import neighborhood as N
from clanweave.plans.catalog import query
from clanweave.plans.views import WINDOW

SHOWN = ["query", "neighbor", "num", "distance", "direction", "contig"]
CLUSTERED = "cl as (select uniref50_seed as cluster, accession as query from uniref), rows as (select n.*, cl.cluster from neighbors n join cl on cl.query = n.query)"
COOC = f"""{CLUSTERED}, qn as (select cluster, count(distinct query) as queryable from rows group by 1 having count(distinct query) > 1),
    cooc as (select cluster, family, queries, queryable, (queries * 100 // queryable) / 100.0::double as ratio from
    (select cluster, family, count(distinct query) as queries from rows group by 1, 2) join qn using (cluster))"""
SPOKES = f"""{COOC}, sizes as (select cluster, count(*) as size from cl group by 1), spokes as (select c.*, n.neighbors, s.size,
    floor(n.a * 100 + 1e-9) / 100 as avg_distance, floor(n.m * 100 + 1e-9) / 100 as median_distance, c.queries || '/' || c.queryable as ratio_text from cooc c
    join (select cluster, family, count(*) as neighbors, avg(abs(distance)) as a, median(abs(distance)) as m from rows group by 1, 2) n
    on n.cluster = c.cluster and n.family = c.family join sizes s on s.cluster = c.cluster)"""


def clusters(v):
    return v.uniref.select(F.col("uniref50_seed").alias("cluster"), F.col("accession").alias("query"))


def rows(v):
    return N.clustered(v.neighbors, clusters(v))


def sizes(v):
    return clusters(v).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def colors(v):
    return clusters(v).select("cluster").distinct().withColumn("color", F.concat(F.lit("#"), F.substring("cluster", 2, 6)))


@query("gnn01_choose_genome", "select query, contig, type, max_num, num as query_num, direction as query_direction, start as query_start, stop as query_stop from chosen")
def _(v):
    return N.choose_genome(v.gene_queries, v.genes).drop("last_stop")


@query("jn14_genes_in_window", "select query, neighbor, num, distance, contig from near")
def _(v):
    return N.genes_in_window(N.choose_genome(v.gene_queries, v.genes), v.genes, WINDOW).select("query", "neighbor", "num", "distance", "contig")


@query(
    "gnn02_find_neighbors",
    f"""select query, neighbor, n.num, n.distance, direction, contig, n.start + case when query_num + distance < 1 then -l.stop when query_num + distance > max_num then l.stop else 0 end - q.start as rel_start,
    case when query_num - {WINDOW} < 1 then 1 else 0 end + case when query_num + {WINDOW} > max_num then 2 else 0 end as is_bound from neighbors n
    join (select "ID", "NUM", stop from genes) l on l."ID" = n.contig and l."NUM" = n.max_num join (select "ID", "NUM", start from genes) q on q."ID" = n.contig and q."NUM" = n.query_num""",
)
def _(v):
    return N.find_neighbors(v.gene_queries, v.genes, WINDOW).select(*SHOWN, "rel_start", "is_bound")


@query(
    "gnn03_neighbor_status",
    """select q.query, c.contig as genome, case when c.contig is null then 'nomatch' when n.k is null then 'noneighbor' else 'neighbors' end as status from
    (select distinct 'A' || (1000000 + o_custkey * 2) as query from orders) q left join chosen c on c.query = q.query left join (select query, count(*) as k from neighbors group by 1) n on n.query = q.query""",
)
def _(v):
    from clanweave.plans.views import acc

    q = v.table("orders").select(acc(F.col("o_custkey") * 2).alias("query"))
    return N.neighbor_status(q, N.choose_genome(q, v.genes), v.neighbors)


@query("gnn04_fuse_families", "select accession, family from fused")
def _(v):
    return N.fuse_families(v.gene_matches)


@query("gnn05_restrict_window", "select query, neighbor, distance from neighbors where abs(distance) <= 3")
def _(v):
    return N.restrict_window(v.neighbors, 3).select("query", "neighbor", "distance")


@query("gnn06_cooccurrence", f"with {COOC} select cluster, family, queries, queryable, ratio from cooc")
def gnn06(v):
    return N.cooccurrence(rows(v))


@query(
    "gnn07_cooccurrence_table",
    f"""with {COOC}, parts as (select cluster, unnest(string_split(family, '-')) as family, round(ratio * 100)::bigint as h from cooc where family <> 'none')
    select family, cluster, sum(h)::double / 100 as ratio from parts group by 1, 2""",
)
def _(v):
    return N.cooccurrence_table(N.cooccurrence(rows(v)))


@query(
    "gnn08_cluster_hub_spokes",
    f"with {SPOKES} select cluster, family, queries, neighbors, size, queryable, avg_distance, median_distance, ratio, ratio_text from spokes",
)
def _(v):
    return N.spokes(rows(v), sizes(v))


@query("gnn08_cluster_hub_edges", f"with {COOC} select cluster as source, cluster || ':' || family as target from cooc where ratio >= 0.2")
def _(v):
    return N.cluster_hub_network(rows(v), sizes(v), v.annotations, v.family_names, colors(v), 0.2)[1]


@query(
    "gnn08_cluster_hub_nodes",
    f"""with {SPOKES} select cluster as node_id, 'Hub Average and Median Distance' as name, 'list' as type, printf('%s:%s:%.2f:%.2f', cluster, family, avg_distance, median_distance) as value from spokes where ratio > 0.2
    union all select cluster, '# of Sequences in SSN Cluster with Neighbors', 'integer', queryable::varchar from qn
    union all select cluster || ':' || family, '# of Pfam Neighbors', 'integer', neighbors::varchar from spokes where ratio >= 0.2
    union all select r.cluster || ':' || r.family, 'Query-Neighbor Arrangement', 'list', r.family || ':' || r.query || ':' || case when query_direction = 0 then 'complement' else 'normal' end || ':' || neighbor || ':'
    || case when direction = 0 then 'complement' else 'normal' end || ':' || distance from rows r join spokes s on s.cluster = r.cluster and s.family = r.family and s.ratio >= 0.2""",
)
def _(v):
    nodes = N.cluster_hub_network(rows(v), sizes(v), v.annotations, v.family_names, colors(v), 0.2)[0]
    spoke = F.col("node_id").contains(":")
    size = (F.col("name") == "# of Sequences in SSN Cluster with Neighbors") & ~spoke
    return nodes.where(size | F.col("name").isin("Hub Average and Median Distance", "# of Pfam Neighbors", "Query-Neighbor Arrangement"))


@query(
    "gnn09_family_hubs",
    f"""with {SPOKES} select family, sum(size)::bigint as size, sum(queryable)::bigint as queryable, sum(queries)::bigint as queries, sum(neighbors)::bigint as neighbors, count(*) as clusters
    from spokes where ratio >= 0.2 group by 1""",
)
def _(v):
    return N.family_hubs(N.spokes(rows(v), sizes(v)).where("ratio >= 0.2"))


@query("gnn09_family_hub_edges", f"with {COOC} select family as source, family || ':' || cluster as target from cooc where ratio >= 0.2")
def _(v):
    return N.family_hub_network(rows(v), sizes(v), v.annotations, v.family_names, colors(v), 0.2)[1]


@query("gnn10_median_distance", f"with {CLUSTERED} select cluster, family, median(abs(distance)) as median from rows group by 1, 2")
def _(v):
    return N.median(rows(v).withColumn("d", F.abs("distance")), ["cluster", "family"], "d")


@query(
    "gnn11_node_shape",
    f"""with {CLUSTERED} select cluster, family, case when p and r then 'diamond' when p then 'square' when r then 'triangle' else 'circle' end as shape from
    (select cluster, family, coalesce(bool_or("PDB" is not null), false) as p, coalesce(bool_or("STATUS" = 'Reviewed'), false) as r from rows left join annotations on accession = neighbor group by 1, 2)""",
)
def _(v):
    return N.node_shape(rows(v), v.annotations, ["cluster", "family"])


LONG = """query, neighbor, {f} as family, cluster, '#' || substr(cluster, 2, 6) as color, printf('%02d', abs(distance)) as distance,
    case when query_direction = 0 then 'complement' else 'normal' end || '-' || case when direction = 0 then 'complement' else 'normal' end as directions"""


@query("gnn12_neighbor_long", f"with {CLUSTERED} select {LONG.format(f='family')} from rows")
def _(v):
    return N.neighbor_long(rows(v), colors(v))


@query(
    "gnn12_neighbor_long_split",
    f"with {COOC} select distinct {LONG.format(f='f')} from (select r.*, unnest(string_split(r.family, '-')) as f from rows r join cooc c on c.cluster = r.cluster and c.family = r.family and c.ratio >= 0.3)",
)
def _(v):
    return N.neighbor_long(rows(v), colors(v), 0.3, split=True)


@query("gnn13_hub_counts", f"with {CLUSTERED} select cl.cluster, count(distinct n.query) as queryable, count(distinct cl.query) as total from cl left join neighbors n on n.query = cl.query group by 1")
def _(v):
    return N.hub_counts(rows(v), sizes(v))


@query(
    "gnn14_network_neighbor_families",
    """select distinct m.node_id, 'Neighbor Pfam Families' as name, 'list' as type, value from metanode m join (select query, unnest(string_split(family, '-')) as value from neighbors) on query = m.member
    where value <> 'none' union all select node_id, 'Present in ENA Database?', 'list', case when c.query is null then 'false' else 'true' end from metanode left join chosen c on c.query = member""",
)
def _(v):
    status = N.neighbor_status(v.gene_queries, N.choose_genome(v.gene_queries, v.genes), v.neighbors)
    fam = v.neighbors.select("query", F.lit("Neighbor Pfam Families").alias("name"), "family")
    return N.annotate_network_neighbors(v.metanode, status, fam).where(F.col("name").isin("Neighbor Pfam Families", "Present in ENA Database?"))


IFUSED = "ifused as (select accession, string_agg(id, '-' order by id) as family from (select distinct accession, id from interpro_match) group by accession)"


@query(
    "gnn14_network_neighbor_interpro",
    f"""with {IFUSED}, ip as (select query, unnest(string_split(ifused.family, '-')) as value from neighbors join ifused on accession = neighbor)
    select distinct m.node_id, 'Neighbor InterPro Families' as name, 'list' as type, value from metanode m join ip on query = m.member""",
)
def _(v):
    status = N.neighbor_status(v.gene_queries, N.choose_genome(v.gene_queries, v.genes), v.neighbors)
    ipro = N.attach_gene_families(v.neighbors.select("query", "neighbor"), N.fuse_families(v.interpro_match))
    fam = ipro.select("query", F.lit("Neighbor InterPro Families").alias("name"), "family")
    return N.annotate_network_neighbors(v.metanode, status, fam).where("name = 'Neighbor InterPro Families'")


@query("st04_no_family_neighbors", f"with {CLUSTERED} select distinct cluster, neighbor from rows where family = 'none'")
def _(v):
    return N.no_family_neighbors(rows(v))


# ---- diagrams -------------------------------------------------------------------------------------
NUMBERED = """dq as (select c.*, substr(u.uniref50_seed, 2)::int as cluster_num from chosen c join uniref u on u.accession = c.query),
    attr as (select *, row_number() over (order by cluster_num, query) as sort_key from dq)"""


def diagrams(v):
    cl = clusters(v).select("query", F.substring("cluster", 2, 20).cast("int").alias("cluster"))
    return N.neighborhood_diagrams(v.placed, v.neighbors, v.annotations, cl, n=WINDOW)


@query("wn08_cluster_index", f"with {NUMBERED} select query as accession, cluster_num, sort_key - 1 as cluster_index from attr")
def _(v):
    return diagrams(v)["attributes"].select("accession", "cluster_num", "cluster_index")


@query("wn08_cluster_extents", f"with {NUMBERED} select cluster_num, min(sort_key) - 1 as start_index, max(sort_key) - 1 as end_index from attr group by 1")
def _(v):
    return diagrams(v)["cluster_index"]


@query(
    "wn09_order_by_clan",
    """with r as (select uniref50_seed as cluster, accession, case when "Taxonomy_ID" > 5 then "Taxonomy_ID" % 7 end as clan, "Taxonomy_ID" % 3 as fam from uniref join annotations using (accession)),
    s as (select *, count(*) over (partition by cluster, clan) as size from r where clan is not null), o as (select *, row_number() over (partition by cluster order by size desc, clan, fam, accession) - 1 as sort_order from s)
    select cluster, accession, clan, fam, sort_order, 'SSN' || cluster || '-CL' || clan || '-FAM' || fam || '-' || sort_order as uid from o union all
    select cluster, accession, clan, fam, 999999, null from r where clan is null""",
)
def _(v):
    t = F.col("Taxonomy_ID")
    r = v.uniref.join(v.annotations, "accession").select(F.col("uniref50_seed").alias("cluster"), "accession", F.when(t > 5, t % 7).alias("clan"), (t % 3).alias("fam"))
    return N.order_by_clan(r)


@query(
    "gnn15_diagram_neighbors",
    f"""with {NUMBERED} select a.sort_key as gene_key, n.neighbor as accession, n.num, n.family, n.distance, i."Taxonomy_ID" as taxon_id, case when lower(i."STATUS") = 'reviewed' then 'SwissProt' else 'TrEMBL' end as anno_status
    from neighbors n join attr a on a.query = n.query left join annotations i on i.accession = n.neighbor""",
)
def _(v):
    return diagrams(v)["neighbors"].select("gene_key", "accession", "num", "family", "distance", "taxon_id", "anno_status")


NAMED = """named as (select f, string_agg(coalesce(short_name, part), '-' order by pos) as short from (select family as f, unnest(string_split(family, '-')) as part, unnest(range(0, len(string_split(family, '-')))) as pos
    from (select family from fused union select family from ifused union select 'none')) left join family_names on family_names.family = part group by f)"""


def full_diagrams(v):
    cl = clusters(v).select("query", F.substring("cluster", 2, 20).cast("int").alias("cluster"))
    ipro = N.fuse_families(v.interpro_match)
    return N.neighborhood_diagrams(v.placed, v.neighbors, v.annotations, cl, n=WINDOW, pfam=N.fuse_families(v.gene_matches), interpro=ipro, family_info=v.family_names, kind="gnn", cooccurrence=0.2)


@query(
    "gnn15_diagram_families",
    f"""with {NUMBERED}, {IFUSED}, {NAMED}, genes_ as (select 'query' as side, sort_key as gene_key, query as accession from attr union all select 'neighbor', a.sort_key, n.neighbor from neighbors n join attr a on a.query = n.query)
    select side, gene_key, g.accession, coalesce(f.family, 'none') as family, p.short as family_desc, coalesce(i.family, 'none') as ipro_family, q.short as ipro_family_desc
    from genes_ g left join fused f on f.accession = g.accession left join ifused i on i.accession = g.accession join named p on p.f = coalesce(f.family, 'none') join named q on q.f = coalesce(i.family, 'none')""",
)
def _(v):
    d = full_diagrams(v)
    cols = ("accession", "family", "family_desc", "ipro_family", "ipro_family_desc")
    own = d["attributes"].select(F.lit("query").alias("side"), F.col("sort_key").alias("gene_key"), *cols)
    return own.unionByName(d["neighbors"].select(F.lit("neighbor").alias("side"), "gene_key", *cols))


@query("gnn15_diagram_metadata", f"select count(*)::bigint as clusters, 0.2::double as cooccurrence, {WINDOW}::int as neighborhood_size, 'gnn' as type from (select distinct uniref50_seed from uniref join chosen on query = accession)")
def _(v):
    d = full_diagrams(v)
    n = d["cluster_index"].agg(F.count(F.lit(1)).alias("clusters"))
    meta = d["metadata"].select("cooccurrence", "neighborhood_size", "type").first()
    return n.select("clusters", F.lit(meta[0]).alias("cooccurrence"), F.lit(meta[1]).alias("neighborhood_size"), F.lit(meta[2]).alias("type"))


WINDOWS = f"""{NUMBERED}, big as (select cluster_num from dq group by 1 having count(*) >= 3),
    wnear as (select n.*, a.cluster_num, a.num as q_num from neighbors n join attr a on a.query = n.query where abs(n.num - a.num) <= 4 and a.cluster_num in (select cluster_num from big)),
    wlist as (select cluster_num, query, num, neighbor as accession, neighbor || '_ORF' || num || ':gid:' || contig || ':pid:' || query || ':loc:' || start || ':' || stop || ':strand:' || case when direction = 1 then '+' else '-' end as header from wnear
    union all select cluster_num, query, num, query, query || '_ORF' || num || ':gid:' || contig || ':pid:' || query || ':loc:' || start || ':' || stop || ':strand:' || case when direction = 1 then '+' else '-' end from attr
    where query in (select query from wnear where num > q_num))"""


def windows(v):
    d = diagrams(v)
    return N.export_neighborhood_windows(d["attributes"], d["neighbors"], 4)


@query("gnn16_export_windows", f"with {WINDOWS} select cluster_num, query, num, accession, header from wlist")
def _(v):
    return windows(v)[1]


@query(
    "gnn17_validate_windows",
    f"""with {WINDOWS}, fa as (select w.query, s.id as accession, s.seq from (select distinct query, accession from wlist) w join sequences s on s.id = w.accession)
    select query, sum(length(seq))::bigint as total_length, count(*) as records from fa group by 1 having count(*) > 2""",
)
def _(v):
    meta, lists = windows(v)
    fa = lists.select("query", "accession").distinct().join(v.sequences.select(F.col("id").alias("accession"), "seq"), "accession")
    return N.validate_windows(meta, lists, fa).select("query", "total_length", "records")
