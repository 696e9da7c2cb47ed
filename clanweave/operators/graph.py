"""Networks: components, numbering, colouring, metanodes, representative and split networks.

Node attributes are kept long, ``(node_id, name, type, value)`` with one row per list element, so a node
that stands for a very large group never becomes one very large row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clanweave.functions import scalar as S
from clanweave.functions.ordered import ordered_scan, rank_all
from clanweave.operators.edges import edges_between_representatives, with_score
from clanweave.session import by_key, materialize

# Attributes whose list members are sequences of their own.
EXPANDABLE = (
    "ACC", "List of IDs in Rep Node", "ACC_CDHIT", "CD-HIT IDs", "UniRef50_IDs", "UniRef50 Cluster IDs",
    "UniRef90_IDs", "UniRef90 Cluster IDs", "UniRef100_IDs", "UniRef100 Cluster IDs",
)
# Attributes that colouring replaces.
COLOR_FIELDS = (
    "Sequence Count Cluster Number", "Node Count Cluster Number", "node.fillColor", "Node Count Fill Color",
    "Cluster Sequence Count", "Cluster Node Count", "Singleton Number", "Neighbor Families",
)


def connected_components(
    nodes: DataFrame, edges: DataFrame, include_singletons: bool = True
) -> DataFrame:
    """``(node, component)``; a component is named after its smallest node ID.

    Alternating large-star / small-star (Kiveris et al. 2014). A round is two aggregations with map-side
    ```min`` and two equi-joins against one row per node, so a hub is never gathered in one place (the hub's
    rows are the streamed side that adaptive execution splits). Every second round is written to the shared
    scratch area; the loop ends once the links form stars, O(log² n) rounds.
    """
    links = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    links = materialize(links.distinct(), "links")
    while _has_chain(links):
        links = materialize(_star_round(_star_round(links)), "links")
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = found.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    if not include_singletons:
        return found
    alone = nodes.select("node").distinct().join(found.select("node"), "node", "left_anti")
    return found.unionByName(alone.select("node", F.col("node").alias("component")))


def _star_round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links ``u > v``."""
    both = _pairs(links, ("u", "v"), ("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("_low")).select("u", F.least("u", "_low").alias("low"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")
    low2 = large.groupBy("u").agg(F.min("v").alias("low"))
    return _pairs(large.join(low2, "u"), ("u", "low"), ("v", "low")).where("u <> v").distinct()


def _pairs(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Several (u, v) rows from each row, in one pass over the input."""
    return df.select(F.explode(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])).alias("p")).select("p.u", "p.v")


def _has_chain(links: DataFrame) -> bool:
    """True while some node has two parents or is both a parent and a child."""
    pair = F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("child")), F.struct(F.col("v").alias("n"), F.lit(0).alias("child"))))
    ends = links.select(pair.alias("p")).select("p.n", "p.child")
    per = ends.groupBy("n").agg(F.sum("child").alias("up"), F.min("child").alias("lowest"))
    return not per.where("up > 1 or (up = 1 and lowest = 0)").isEmpty()


def expand_metanodes(nodes: DataFrame, node_atts: DataFrame) -> DataFrame:
    """``(node_id, member)``: the node itself and the members of its expandable list attributes."""
    own = nodes.select(F.col("node").alias("node_id"), F.col("node").alias("member"))
    listed = node_atts.where(F.col("name").isin(*EXPANDABLE)).select("node_id", F.col("value").alias("member"))
    listed = listed.where("member <> node_id").distinct()
    return own.unionByName(listed)


def cluster_members(components: DataFrame, metanode: DataFrame, mode: str = "all") -> DataFrame:
    """IDs per cluster: ``all`` sequences, ``metanode`` labels only, or ``no_domain`` (domain suffix removed)."""
    if mode == "metanode":
        return components.select("component", F.col("node").alias("id"))
    joined = components.join(by_key(metanode), components.node == metanode.node_id).select("component", F.col("member").alias("id"))
    if mode == "no_domain":
        joined = joined.select("component", S.strip_domain("id").alias("id"))
    return joined.distinct()


def cluster_counts(components: DataFrame, metanode: DataFrame) -> DataFrame:
    """Per component: node count, sequence count and smallest node."""
    per_node = metanode.groupBy(F.col("node_id").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    return (
        components.join(by_key(per_node), "node", "left")
        .groupBy("component")
        .agg(F.count(F.lit(1)).alias("node_count"), F.sum(F.coalesce("n", F.lit(1))).alias("seq_count"), F.min("node").alias("min_id"))
    )


def number_clusters(components: DataFrame, metanode: DataFrame) -> DataFrame:
    """Number clusters by sequence count and by node count, largest first; ties by smallest member ID.

    Clusters of a single sequence also get a singleton number of their own, in ID order.
    """
    counts = cluster_counts(components, metanode)
    by_seq = ordered_scan(
        counts, [], [F.desc("seq_count"), F.asc("min_id")], rank="seq_number",
        totals={"_multi": (F.col("seq_count") > 1).cast("long")},
    )
    by_node = rank_all(by_seq, [F.desc("node_count"), F.asc("min_id")], "node_number")
    single = F.when(F.col("seq_count") < 2, F.col("seq_number") - F.col("_multi"))
    return by_node.select("component", "node_count", "seq_count", "min_id", "seq_number", "node_number", single.alias("singleton_number"))


def number_singletons(numbered: DataFrame) -> DataFrame:
    return numbered.where(F.col("singleton_number").isNotNull()).select("component", "singleton_number")


def cluster_color(clusters: DataFrame, number: str, palette: DataFrame, name: str = "color") -> DataFrame:
    """Add the colour of cluster ``number``: its own palette entry, else entry ``number mod size + 1``."""
    pal = palette.select(F.col("cluster").alias("_slot"), F.col("color").alias(name))
    direct = pal.select(F.col("_slot").alias("_direct"), F.col(name).alias("_own"))
    n = palette.count()
    out = clusters.join(direct, clusters[number] == F.col("_direct"), "left")
    out = out.withColumn("_slot", F.pmod(F.col(number), F.lit(n)) + 1).join(pal, "_slot", "left")
    return out.select(*clusters.columns, F.coalesce("_own", name).alias(name))


def family_color(families: DataFrame, palette: DataFrame) -> DataFrame:
    """``(family, part, color)``: colours dealt round-robin over the sorted families; fused names get one per part.

    The family vocabulary is a dictionary (a few ten thousand entries), so its ranks come from one window.
    """
    parts = families.select("family", F.posexplode(F.split("family", "-")).alias("pos", "part"))
    words = parts.select("part").distinct().withColumn("_r", F.dense_rank().over(Window.orderBy("part")) - 1)
    n = palette.count()
    slots = palette.select(F.col("color"), (F.row_number().over(Window.orderBy("cluster")) - 1).alias("_k"))
    named = words.withColumn("_k", F.pmod("_r", F.lit(n))).join(slots, "_k").select("part", "color")
    return parts.join(named, "part").select("family", F.col("pos").alias("pos"), "part", "color").distinct()


def color_network(components: DataFrame, numbered: DataFrame, palette: DataFrame) -> DataFrame:
    """Per node: cluster numbers, counts and both fill colours (only for clusters above size 1)."""
    c = cluster_color(numbered, "seq_number", palette, "_seq_color")
    c = cluster_color(c, "node_number", palette, "_node_color")
    single = F.col("seq_count") < 2
    fields = c.select(
        "component",
        F.when(~single, F.col("seq_number")).alias("seq_cluster"),
        F.when(~single, F.col("node_number")).alias("node_cluster"),
        "singleton_number", "seq_count", "node_count",
        F.when(F.col("seq_count") > 1, F.col("_seq_color")).alias("seq_color"),
        F.when(F.col("node_count") > 1, F.col("_node_color")).alias("node_color"),
    )
    return components.join(by_key(fields), "component").drop("component")


def colored_attributes(node_atts: DataFrame, colored: DataFrame) -> DataFrame:
    """Attribute rows of a coloured network: old colour fields replaced by the new ones."""
    new = {
        "Sequence Count Cluster Number": ("integer", "seq_cluster"), "Node Count Cluster Number": ("integer", "node_cluster"),
        "Singleton Number": ("integer", "singleton_number"), "Cluster Sequence Count": ("integer", "seq_count"),
        "Cluster Node Count": ("integer", "node_count"), "node.fillColor": ("string", "seq_color"),
        "Node Count Fill Color": ("string", "node_color"),
    }
    made = colored.select(
        F.col("node").alias("node_id"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.col(c).cast("string").alias("value")) for n, (t, c) in new.items()])).alias("a"),
    ).select("node_id", "a.name", "a.type", "a.value").where(F.col("value").isNotNull())
    kept = node_atts.where(~F.col("name").isin(*COLOR_FIELDS))
    return kept.select("node_id", "name", "type", "value").unionByName(made)


def cluster_id_map(
    components: DataFrame, numbered: DataFrame, metanode: DataFrame, annotations: DataFrame, palette: DataFrame, domain: bool = False
) -> DataFrame:
    """UniProt ID, cluster number, colour, taxonomy ID and organism for clusters of at least 2.

    Rows are not sorted here; the writer sorts by (cluster, id). The domain variant lists node labels.
    """
    ids = cluster_members(components, metanode, "metanode" if domain else "no_domain")
    c = cluster_color(numbered.where("seq_count > 1"), "seq_number", palette)
    rows = ids.join(by_key(c.select("component", F.col("seq_number").alias("cluster"), "color")), "component")
    rows = rows.withColumn("_acc", S.strip_domain("id"))
    info = annotations.select(F.col("accession").alias("_acc"), "Taxonomy_ID", "Organism")
    return rows.join(by_key(info), "_acc", "left").select("id", "cluster", "color", "Taxonomy_ID", "Organism")


def cluster_number_map(numbered: DataFrame) -> DataFrame:
    return numbered.where("seq_count > 1").select("seq_number", "node_number", "seq_count", "node_count")


def network_summary(components: DataFrame, numbered: DataFrame, source: str = "UniProt") -> DataFrame:
    """One row: clusters above size 1, singletons, source, nodes, sequences."""
    multi = F.col("seq_count") > 1
    return numbered.agg(
        F.count_if(multi).alias("num_clusters"), F.count_if(~multi).alias("num_singletons"),
        F.lit(source).alias("source"), F.sum("node_count").alias("num_metanodes"), F.sum("seq_count").alias("num_accessions"),
    )


def swissprot_by_cluster(components: DataFrame, numbered: DataFrame, annotations: DataFrame, metanode: DataFrame) -> DataFrame:
    """Distinct SwissProt descriptions per cluster (or singleton), one row each."""
    ids = cluster_members(components, metanode, "no_domain")
    desc = annotations.where(F.col("SwissProt_Description").isNotNull() & (F.col("SwissProt_Description") != "NA"))
    rows = ids.join(by_key(desc.select(F.col("accession").alias("id"), "SwissProt_Description")), "id")
    rows = rows.join(by_key(numbered.select("component", "seq_number", "singleton_number")), "component")
    return rows.select("seq_number", "singleton_number", "SwissProt_Description").distinct()


def cluster_ids_by_source(components: DataFrame, numbered: DataFrame, metanode: DataFrame, uniref: DataFrame, source: int = 0) -> DataFrame:
    """Long ``(cluster, source, id)`` over clusters above size 1.

    ``source`` is the network's own level: 0 UniProt, 90, 50. UniRef50 seeds are listed unless the network is
    UniRef90, UniRef90 seeds always; domain node labels appear as source ``domain``.
    """
    number = numbered.where("seq_count > 1").select("component", F.col("seq_number").alias("cluster"))
    ids = cluster_members(components, metanode, "no_domain").join(by_key(number), "component")
    with_seeds = ids.join(by_key(uniref.select(F.col("accession").alias("id"), "uniref50_seed", "uniref90_seed")), "id", "left")
    kinds = [("UniProt", "id"), ("UniRef90", "uniref90_seed")]
    if source < 90:
        kinds.append(("UniRef50", "uniref50_seed"))
    long = with_seeds.select("cluster", F.explode(F.array(*[F.struct(F.lit(k).alias("source"), F.col(c).alias("id")) for k, c in kinds])).alias("r"))
    rows = long.select("cluster", "r.source", "r.id").where("id is not null")
    dom = components.where(F.col("node").rlike(S.DOMAIN_SUFFIX)).join(by_key(number), "component")
    return rows.distinct().unionByName(dom.select("cluster", F.lit("domain").alias("source"), F.col("node").alias("id")))


def cluster_size_by_source(ids: DataFrame) -> DataFrame:
    """UniProt / UniRef90 / UniRef50 sizes per cluster in one aggregation (no pivot pass)."""
    return ids.groupBy("cluster").agg(*[F.count_if(F.col("source") == s).alias(s.lower()) for s in ("UniProt", "UniRef90", "UniRef50")])


def cluster_center(components: DataFrame, degree: DataFrame) -> DataFrame:
    """Member with the most edges per cluster; ties by smallest ID (a struct minimum, no sort)."""
    d = components.join(degree, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)).cast("long"))
    best = F.min(F.struct((-F.col("degree")).alias("d"), F.col("node").alias("node"))).alias("b")
    return d.groupBy("component").agg(best).select("component", F.col("b.node").alias("center"), (-F.col("b.d")).alias("degree"))


def network_stats(networks: DataFrame) -> DataFrame:
    """Nodes, edges and bytes per network from long rows ``(network, kind, bytes)``."""
    return networks.groupBy("network").agg(
        F.count_if(F.col("kind") == "node").alias("nodes"), F.count_if(F.col("kind") == "edge").alias("edges"), F.sum("bytes").alias("bytes")
    )


def representative_nodes(members: DataFrame, attributes: DataFrame) -> DataFrame:
    """Attribute rows of representative nodes, long ``(rep, name, value)``.

    The member list is the attribute ``ACC``, its size ``Cluster Size``; every other attribute is the distinct
    union over the members, without empty values where others exist. ``Sequence`` and ``UniRef90_Cluster_Size``
    keep repeated values.
    """
    keep_all = F.col("name").isin("Sequence", "Sequence_Source", "UniRef90_Cluster_Size")
    rows = attributes.join(members, attributes.node_id == members.member).select("rep", "member", "name", "value")
    empty = F.col("value").isNull() | F.col("value").isin("None", "")
    distinct = rows.where(~keep_all & ~empty).select("rep", "name", "value").distinct()
    repeated = rows.where(keep_all & ~empty).select("rep", "name", "value")
    filled = distinct.unionByName(repeated)
    none = rows.where(empty).select("rep", "name").distinct().join(filled.select("rep", "name").distinct(), ["rep", "name"], "left_anti")
    acc = members.select("rep", F.lit("ACC").alias("name"), F.col("member").alias("value"))
    size = members.groupBy("rep").agg(F.count(F.lit(1)).cast("string").alias("value")).select("rep", F.lit("Cluster Size").alias("name"), "value")
    return filled.unionByName(none.withColumn("value", F.lit(None).cast("string"))).unionByName(acc).unionByName(size)


def check_edge_limit(edges: DataFrame, max_edges: int | None = None) -> None:
    """Refuse a network above a limit that the caller sets; without one nothing is counted."""
    if max_edges is None:
        return
    n = edges.limit(max_edges + 1).count()
    if n > max_edges:
        raise ValueError(f"more than {max_edges} edges, no network")


def network_edges(edges: DataFrame) -> DataFrame:
    """Edge rows of a network: label, identity, alignment score and length."""
    return with_score(edges).select(
        F.concat_ws(",", "src", "dst").alias("label"), F.col("src").alias("source"), F.col("dst").alias("target"),
        F.col("pid").alias("%id"), F.col("score").alias("alignment_score"), F.col("alen").alias("alignment_len"),
    )


def build_full_network(
    seqs: DataFrame, edges: DataFrame, attributes: DataFrame, max_edges: int | None = None, sequences: str = "none"
) -> tuple[DataFrame, DataFrame]:
    """``(node attribute rows, edge rows)``; ``sequences`` adds residues for ``all`` or only ``unmatched`` (``z…``) nodes."""
    check_edge_limit(edges, max_edges)
    ids = seqs.select(F.col("id").alias("node_id"))
    base = F.when(F.col("node_id").rlike(S.DOMAIN_SUFFIX), S.strip_domain("node_id")).otherwise(F.col("node_id"))
    att = attributes.select(F.col("node_id").alias("_base"), "name", "value")
    rows = ids.withColumn("_base", base).join(att, "_base").drop("_base")
    span = S.parse_domain("node_id")
    domain_len = F.when((F.col("name") == "Sequence_Length") & span["start"].isNotNull(), (span["end"] - span["start"] + 1).cast("string"))
    rows = rows.withColumn("value", F.coalesce(domain_len, "value"))
    if sequences != "none":
        add = seqs.where(F.lit(sequences == "all") | F.col("id").startswith("z"))
        rows = rows.unionByName(add.select(F.col("id").alias("node_id"), F.lit("Sequence").alias("name"), F.col("seq").alias("value")))
    return rows, network_edges(edges)


def build_representative_network(members: DataFrame, edges: DataFrame, attributes: DataFrame) -> tuple[DataFrame, DataFrame]:
    reps = members.select("rep").distinct()
    return representative_nodes(members, attributes), network_edges(edges_between_representatives(edges, reps))


def split_network(components: DataFrame, numbered: DataFrame, edges: DataFrame, mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges with the (node-count) cluster they belong to; an edge goes with its source.

    ``mapping(node_number, new_number)`` renumbers and selects clusters. Writers partition by ``cluster``.
    """
    number = numbered.select("component", F.col("node_number").alias("cluster"))
    if mapping is not None:
        m = mapping.select(F.col("node_number").alias("cluster"), F.col("new_number"))
        number = number.join(m, "cluster").select("component", F.col("new_number").alias("cluster"))
    nodes = components.join(number, "component").select("cluster", "node")
    return nodes, edges.join(nodes.withColumnRenamed("node", "src"), "src")


def annotate_network(node_atts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add user columns (``mapping(node_id, …)``, e.g. a fill colour) to the mapped nodes as attribute rows."""
    extra = [c for c in mapping.columns if c != "node_id"]
    rows = mapping.select("node_id", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.lit("string").alias("type"), F.col(f"`{c}`").cast("string").alias("value")) for c in extra])).alias("a"))
    known = node_atts.select("node_id").distinct()
    new = rows.select("node_id", "a.name", "a.type", "a.value").where("value is not null").join(known, "node_id", "left_semi")
    old = node_atts.join(new.select("node_id", "name").distinct(), ["node_id", "name"], "left_anti")
    return old.select("node_id", "name", "type", "value").unionByName(new)


def read_cluster_assignments(components: DataFrame, numbered: DataFrame, existing: DataFrame, metanode: DataFrame) -> DataFrame:
    """``(cluster, id)`` as text: an existing number wins, ``S<n>`` for singletons, else the computed rank."""
    own = components.join(existing.select("node", F.col("cluster").cast("string").alias("_own")), "node", "left")
    c = numbered.select(
        "component",
        F.when(F.col("singleton_number").isNotNull(), F.concat(F.lit("S"), "singleton_number")).otherwise(F.col("seq_number").cast("string")).alias("_new"),
    )
    named = own.join(c, "component").select("node", F.coalesce("_own", "_new").alias("cluster"))
    return named.join(metanode, named.node == metanode.node_id).select("cluster", S.strip_domain("member").alias("id")).distinct()


def network_kind(node_atts: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: ``UniProt`` / ``UniRef90`` / ``UniRef50`` by attribute names, and whether labels carry domains."""
    a = node_atts.select(F.col("name").startswith("UniRef50").cast("int").alias("u50"), F.col("name").startswith("UniRef90").cast("int").alias("u90"), F.lit(0).alias("dom"))
    n = nodes.select(F.lit(0).alias("u50"), F.lit(0).alias("u90"), F.col("node").rlike(S.DOMAIN_SUFFIX).cast("int").alias("dom"))
    flags = a.unionByName(n).agg(F.max("u50").alias("u50"), F.max("u90").alias("u90"), F.max("dom").alias("dom"))
    return flags.select(
        F.when(F.col("u50") == 1, "UniRef50").when(F.col("u90") == 1, "UniRef90").otherwise("UniProt").alias("source"), (F.col("dom") == 1).alias("has_domain")
    )


def remove_filtered_nodes(struct_rows: DataFrame, members: DataFrame) -> DataFrame:
    """Keep attribute rows of representatives only."""
    return struct_rows.join(members.select(F.col("rep").alias("node_id")).distinct(), "node_id", "left_semi")


def induced_subnetwork(edges: DataFrame, struct_rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges with both ends, and attribute rows, whose ID occurs in ``ids(id)``."""
    keep = ids.select("id").distinct()
    for side in ("src", "dst"):
        edges = edges.join(keep.withColumnRenamed("id", side), side, "left_semi")
    return edges, struct_rows.join(keep.withColumnRenamed("id", "node_id"), "node_id", "left_semi")


def member_lists(members: DataFrame) -> DataFrame:
    """Distinct members per representative with the group's size on every row (long form of a list attribute)."""
    rows = members.select("rep", "member").distinct()
    size = rows.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(size, "rep")


def cluster_count(members: DataFrame, max_clusters: int | None = None) -> DataFrame:
    """Number of clusters; an error when above ``max_clusters``."""
    out = members.agg(F.countDistinct("rep").alias("clusters"))
    if max_clusters is not None and out.first()[0] > max_clusters:
        raise ValueError(f"more than {max_clusters} clusters")
    return out
