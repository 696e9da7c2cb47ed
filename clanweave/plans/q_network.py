"""Queries for components, numbering, colouring and networks."""

from pyspark.sql import functions as F

from clanweave.operators import edges as E
from clanweave.operators import graph as G
from clanweave.plans.catalog import query

ALL_IDS = "ids as (select distinct c.component, m.member as id from comp c join metanode m on m.node_id = c.node)"
DEGREE = "deg as (select a as node, count(*) as degree from (select src as a from kept union all select dst from kept) group by 1)"
PAL = """left join palette a on a.cluster = n.{c} left join palette b on b.cluster = n.{c} % (select count(*) from palette) + 1"""
ATTS = """atts as (select accession as node_id, 'Organism' as name, "Organism" as value from annotations union all
    select accession, 'PDB', "PDB" from annotations union all select accession, 'Sequence_Length', "Sequence_Length"::varchar from annotations)"""


def attributes(v):
    a = v.annotations
    return (
        a.select(F.col("accession").alias("node_id"), F.lit("Organism").alias("name"), F.col("Organism").alias("value"))
        .unionByName(a.select(F.col("accession").alias("node_id"), F.lit("PDB").alias("name"), F.col("PDB").alias("value")))
        .unionByName(a.select(F.col("accession").alias("node_id"), F.lit("Sequence_Length").alias("name"), F.col("Sequence_Length").cast("string").alias("value")))
    )


@query("gr01_connected_components", "select node, component from comp")
def gr01(v):
    return G.connected_components(v.nodes, v.kept)


@query("wn06_number_clusters", "select component, node_count, seq_count, min_id, seq_number, node_number, singleton_number from numbered")
def wn06(v):
    return G.number_clusters(v.comp, v.metanode)


@query("wn07_number_singletons", "select component, singleton_number from numbered where singleton_number is not null")
def _(v):
    return G.number_singletons(v.numbered)


@query("gr02_expand_metanodes", "select node_id, member from metanode")
def _(v):
    return v.metanode


@query("gr03_cluster_members", f"with {ALL_IDS} select component, id from ids")
def _(v):
    return G.cluster_members(v.comp, v.metanode)


@query(
    "gr04_color_network",
    f"""with s as (select n.component, coalesce(a.color, b.color) as c from numbered n {PAL.format(c='seq_number')}),
    d as (select n.component, coalesce(a.color, b.color) as c from numbered n {PAL.format(c='node_number')})
    select p.node, case when seq_count > 1 then seq_number end as seq_cluster, case when seq_count > 1 then node_number end as node_cluster, singleton_number,
    seq_count, node_count, case when seq_count > 1 then s.c end as seq_color, case when node_count > 1 then d.c end as node_color
    from comp p join numbered n on n.component = p.component join s on s.component = p.component join d on d.component = p.component""",
)
def gr04(v):
    return G.color_network(v.comp, v.numbered, v.palette)


@query(
    "gr05_cluster_id_map",
    f"""with {ALL_IDS} select i.id, n.seq_number as cluster, coalesce(a.color, b.color) as color, t."Taxonomy_ID", t."Organism" from ids i
    join (select * from numbered where seq_count > 1) n on n.component = i.component {PAL.format(c='seq_number')} left join annotations t on t.accession = i.id""",
)
def _(v):
    return G.cluster_id_map(v.comp, v.numbered, v.metanode, v.annotations, v.palette)


@query("gr06_cluster_number_map", "select seq_number, node_number, seq_count, node_count from numbered where seq_count > 1")
def _(v):
    return G.cluster_number_map(v.numbered)


@query(
    "ag08_network_stats",
    """select component as network, count(*) filter (kind = 'node') as nodes, count(*) filter (kind = 'edge') as edges, sum(bytes)::bigint as bytes from (
    select component, 'node' as kind, length(node) as bytes from comp union all select component, 'edge', length(src) + length(dst) from kept join comp on node = src) group by 1""",
)
def _(v):
    n = v.comp.select(F.col("component").alias("network"), F.lit("node").alias("kind"), F.length("node").alias("bytes"))
    e = v.kept.join(v.comp.withColumnRenamed("node", "src"), "src")
    e = e.select(F.col("component").alias("network"), F.lit("edge").alias("kind"), (F.length("src") + F.length("dst")).alias("bytes"))
    return G.network_stats(n.unionByName(e))


@query(
    "ag15_network_summary",
    """select count(*) filter (seq_count > 1) as num_clusters, count(*) filter (seq_count < 2) as num_singletons, 'UniRef90' as source,
    sum(node_count)::bigint as num_metanodes, sum(seq_count)::bigint as num_accessions from numbered""",
)
def _(v):
    return G.network_summary(v.comp, v.numbered, "UniRef90")


@query(
    "ag15_swissprot_by_cluster",
    f"""with {ALL_IDS} select distinct seq_number, singleton_number, "SwissProt_Description" from ids join annotations on accession = id
    join numbered n on n.component = ids.component where "SwissProt_Description" is not null""",
)
def _(v):
    return G.swissprot_by_cluster(v.comp, v.numbered, v.annotations, v.metanode)


BY_SOURCE = f"""{ALL_IDS}, numbered_ids as (select n.seq_number as cluster, id from ids join numbered n on n.component = ids.component where seq_count > 1),
    seeded as (select cluster, id, uniref50_seed, uniref90_seed from numbered_ids left join uniref on accession = id),
    sourced as (select distinct cluster, 'UniProt' as source, id from seeded union select cluster, 'UniRef90', uniref90_seed from seeded where uniref90_seed is not null
    union select cluster, 'UniRef50', uniref50_seed from seeded where uniref50_seed is not null)"""


@query("jn16_cluster_ids_by_source", f"with {BY_SOURCE} select cluster, source, id from sourced")
def _(v):
    return G.cluster_ids_by_source(v.comp, v.numbered, v.metanode, v.uniref)


@query(
    "ag16_cluster_size_by_source",
    f"""with {BY_SOURCE} select cluster, count(*) filter (source = 'UniProt') as uniprot, count(*) filter (source = 'UniRef90') as uniref90,
    count(*) filter (source = 'UniRef50') as uniref50 from sourced group by 1""",
)
def _(v):
    return G.cluster_size_by_source(G.cluster_ids_by_source(v.comp, v.numbered, v.metanode, v.uniref))


@query(
    "ag18_cluster_center",
    f"""with {DEGREE} select component, node as center, degree from (select component, c.node, coalesce(degree, 0) as degree, row_number() over
    (partition by component order by coalesce(degree, 0) desc, c.node) as rn from comp c left join deg on deg.node = c.node) where rn = 1""",
)
def _(v):
    return G.cluster_center(v.comp, E.node_degree(v.kept))


@query("ag14_cluster_sizes", "select component as cluster, count(*) as size from comp group by 1")
def _(v):
    from clanweave.operators.abundance import cluster_sizes

    return cluster_sizes(v.comp.select(F.col("component").alias("cluster"), F.col("node").alias("protein")))


REPS = f"""{ATTS}, rows as (select rep, name, value from atts join members on member = node_id),
    reps as (select distinct rep, name, value from rows where value is not null union all
    select distinct rep, name, null from rows r where value is null and not exists (select 1 from rows s where s.rep = r.rep and s.name = r.name and s.value is not null)
    union all select rep, 'ACC', member from members union all select rep, 'Cluster Size', count(*)::varchar from members group by rep)"""


@query("ag21_representative_nodes", f"with {REPS} select rep, name, value from reps")
def _(v):
    return G.representative_nodes(v.members, attributes(v))


@query(
    "gr07_full_network_nodes",
    f"""with {ATTS} select accession || ':' || start || ':' || "end" as node_id, name, case when name = 'Sequence_Length' then ("end" - start + 1)::varchar else value end as value
    from (select distinct accession, start, "end" from family_match) f join atts on node_id = accession""",
)
def _(v):
    from clanweave.functions.scalar import domain_id

    seqs = v.family_match.select(domain_id("accession", "start", "end").alias("id")).distinct().withColumn("seq", F.lit(None).cast("string"))
    return G.build_full_network(seqs, v.kept, attributes(v))[0]


@query("gr07_full_network_edges", """select src || ',' || dst as label, src as source, dst as target, pid as "%id", score as alignment_score, alen as alignment_len from scored""")
def _(v):
    return G.network_edges(v.edges)


@query(
    "gr08_representative_network_edges",
    """select src || ',' || dst as label, src as source, dst as target, pid as "%id", score as alignment_score, alen as alignment_len from scored
    where src in (select rep from members) and dst in (select rep from members)""",
)
def _(v):
    return G.build_representative_network(v.members, v.edges, attributes(v))[1]


@query("gr09_split_network", "select node_number as cluster, src, dst from kept join comp on comp.node = src join numbered n on n.component = comp.component")
def _(v):
    return G.split_network(v.comp, v.numbered, v.kept)[1].select("cluster", "src", "dst")


@query(
    "gr10_annotate_network",
    f"""with {ATTS} select node_id, name, 'string' as type, value from atts where name <> 'PDB' or node_id not in (select accession from annotations where "STATUS" = 'Reviewed')
    union all select accession, 'PDB', 'string', "Taxonomy_ID"::varchar from annotations where "STATUS" = 'Reviewed'
    union all select accession, 'node.fillColor', 'string', '#00FF00' from annotations where "STATUS" = 'Reviewed'""",
)
def _(v):
    mapping = v.annotations.where("STATUS = 'Reviewed'").select(
        F.col("accession").alias("node_id"), F.col("Taxonomy_ID").alias("PDB"), F.lit("#00FF00").alias("node.fillColor")
    )
    return G.annotate_network(attributes(v).withColumn("type", F.lit("string")), mapping)


@query(
    "gr11_cluster_assignments",
    f"""select distinct case when p_size > 45 then (1000 + p_size)::varchar when n.singleton_number is not null then 'S' || n.singleton_number else n.seq_number::varchar end as cluster,
    m.member as id from comp c join numbered n on n.component = c.component join metanode m on m.node_id = c.node join part on c.node = 'A' || (1000000 + p_partkey)""",
)
def _(v):
    from clanweave.plans.views import acc

    own = v.table("part").where("p_size > 45").select(acc("p_partkey").alias("node"), (F.col("p_size") + 1000).alias("cluster"))
    return G.read_cluster_assignments(v.comp, v.numbered, own, v.metanode)


@query("gr12_network_kind", r"""select case when bool_or(name like 'UniRef50%') then 'UniRef50' when bool_or(name like 'UniRef90%') then 'UniRef90' else 'UniProt' end as source,
    (select bool_or(regexp_matches(node, ':\d+:\d+$')) from nodes) as has_domain from node_atts""")
def _(v):
    return G.network_kind(v.node_atts, v.nodes)


@query("gr13_remove_filtered_nodes", f"with {ATTS} select node_id, name, value from atts where node_id in (select rep from members)")
def _(v):
    return G.remove_filtered_nodes(attributes(v), v.members)


@query("gr14_induced_subnetwork", "select src, dst, bitscore from edges where src in (select m.member from metanode m join members on rep = node_id) and dst in (select m.member from metanode m join members on rep = node_id)")
def _(v):
    ids = v.metanode.join(v.members.select(F.col("rep").alias("node_id")).distinct(), "node_id", "left_semi")
    return G.induced_subnetwork(v.edges, attributes(v), ids.select(F.col("member").alias("id")))[0].select("src", "dst", "bitscore")
