"""Gene neighbourhoods on linear and circular genomes, and family co-occurrence per cluster.

``genes(ID, AC, NUM, TYPE, DIRECTION, start, stop)``: contig, accession, ordinal on the contig, 0 circular /
1 linear, 0 complement / 1 normal. The window around a query is an equi-join on (contig, ordinal div n): n genes on
either side lie in three neighbouring blocks of n, so no range join is needed, queries are not multiplied by the window,
and a long contig stays spread out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clanweave.functions import scalar as S
from clanweave.functions.ordered import bounded_quantiles, ordered_scan, rank_within
from clanweave.operators.annotate import family_names
from clanweave.session import by_key, materialize

WIDE_WINDOW = 20  # genes on either side of the window that networks store beside the one asked for


def fuse_families(matches: DataFrame) -> DataFrame:
    """Distinct families of a gene joined with ``-``, sorted. Deduplicated before being gathered."""
    d = matches.select("accession", "id").distinct()
    return d.groupBy("accession").agg(F.array_join(F.sort_array(F.collect_set("id")), "-").alias("family"))


def choose_genome(queries: DataFrame, genes: DataFrame) -> DataFrame:
    """One contig and position per query.

    A circular contig wins, the one with most genes first; among linear ones: more than 10 genes from the left
    end, then from the right end, then nearest to the middle. Last tie by contig ID. On a contig that holds the
    accession several times its first position counts. Circular contigs winning, linear ones beside them are left out before the lengths are looked up.
    """
    genes = genes.where("ID is not null")
    contigs = genes.groupBy("ID").agg(F.max("NUM").alias("max_num"), F.max(F.struct("NUM", "stop"))["stop"].alias("last_stop"))
    wanted = queries.select(F.col("query").alias("AC")).distinct()
    held = (
        genes.join(wanted, "AC", "left_semi")
        .groupBy("AC", "ID")
        .agg(F.max("TYPE").alias("type"), F.min(F.struct("NUM", "DIRECTION", "start", "stop")).alias("g"))
    )
    least = F.min("type").over(Window.partitionBy("AC"))
    held = held.withColumn("_least", least).where("type is null or type = _least").drop("_least")
    placed = held.join(contigs, "ID")
    circular, num, top = F.col("type") == 0, F.col("g.NUM"), F.col("max_num")
    order = F.struct(
        F.col("type"),
        F.when(circular, -top).otherwise(0),
        F.when(~circular & (num > 10), 0).otherwise(1),
        F.when(~circular & (num < top - 10), 0).otherwise(1),
        F.when(circular, 0.0).otherwise(F.abs(num.cast("double") / top - 0.5)),
        F.col("ID"),
    )
    best = F.min_by(F.struct("ID", "type", "g", "max_num", "last_stop"), order).alias("b")
    return placed.groupBy("AC").agg(best).select(
        F.col("AC").alias("query"), F.col("b.ID").alias("contig"), F.col("b.type").alias("type"), F.col("b.max_num").alias("max_num"),
        F.col("b.last_stop").alias("last_stop"), F.col("b.g.NUM").alias("query_num"), F.col("b.g.DIRECTION").alias("query_direction"),
        F.col("b.g.start").alias("query_start"), F.col("b.g.stop").alias("query_stop"),
    )


def genes_in_window(placed: DataFrame, genes: DataFrame, n: int, circular: bool = True, wrap_all: bool = False) -> DataFrame:
    """Genes at distance 1…n on either side; circular contigs longer than n wrap around (``wrap_all``: those of any length).

    On a circular contig the query stands at its own place and at those one turn before and after, as far as the window reaches.
    """
    if n < 1:
        raise ValueError("a window holds at least one gene")
    top = F.col("max_num")
    wraps = F.lit(circular) & (F.col("type") == 0) & (F.lit(wrap_all) | (F.lit(n) < top))
    turns = F.when(wraps, F.greatest(F.lit(1), F.ceil(n / top)).cast("int")).otherwise(0)
    wide = placed.withColumn("_turn", F.explode(F.sequence(-turns, turns)))
    wide = wide.withColumn("_at", F.col("query_num") + F.col("_turn") * top)
    wide = wide.where((F.col("_at") + n >= 1) & (F.col("_at") - n <= top))
    block = lambda c: F.floor(c / n)
    wide = wide.withColumn("_block", F.explode(F.sequence(block(F.col("_at")) - 1, block(F.col("_at")) + 1)))
    g = genes.select(F.col("ID").alias("contig"), F.col("NUM").cast("long").alias("num"), F.col("AC").alias("neighbor"), F.col("DIRECTION").alias("direction"), "start", "stop")
    found = by_key(wide).join(g.withColumn("_block", block(F.col("num"))), ["contig", "_block"])
    found = found.withColumn("distance", (F.col("num") - F.col("_at")).cast("long"))
    return found.where((F.col("distance") != 0) & (F.abs("distance") <= n)).drop("_turn", "_at", "_block")


def find_neighbors(
    queries: DataFrame, genes: DataFrame, n: int, circular: bool = True, wrap_all: bool = False, placed: DataFrame | None = None
) -> DataFrame:
    """Neighbouring genes with signed distance; one row per (query, neighbour accession), the nearest.

    With ``wrap_all`` (a window to be stored and cut down later) all places at which a neighbour is met on a circular contig are kept.
    ``is_bound``: 1 when the window passes the left end of the contig, 2 the right end. ``placed`` is the stored ``choose_genome`` of the same queries, if known.
    """
    # Only what tells the genes of a window apart is moved and sorted, dealt by query once; what a query's rows share is joined again.
    placed = materialize(choose_genome(queries, genes), "placed") if placed is None else placed
    at = placed.select("query", "contig", "type", "max_num", "query_num")
    found = genes_in_window(at, genes, n, circular, wrap_all).where(F.col("neighbor") != F.col("query"))
    place = F.col("distance") if wrap_all else F.lit(0)
    gene = F.struct(F.abs("distance").alias("_d"), "num", "direction", "start", "stop", "distance")
    found = found.select("query", "neighbor", place.alias("_place"), gene.alias("_r")).repartition("query")
    nearest = found.groupBy("query", "neighbor", "_place").agg(F.min("_r").alias("r"))
    rows = nearest.select("query", "neighbor", *[F.col(f"r.{c}").alias(c) for c in ("num", "direction", "start", "stop", "distance")])
    rows = rows.join(by_key(placed.drop("query_stop")), "query")
    flat = F.col("query_num") + F.col("distance")
    shift = F.when(flat < 1, -F.col("last_stop")).when(flat > F.col("max_num"), F.col("last_stop")).otherwise(0)
    rel = F.col("start") + shift - F.col("query_start")
    bound = F.when(F.col("query_num") - n < 1, 1).otherwise(0) + F.when(F.col("query_num") + n > F.col("max_num"), 2).otherwise(0)
    return rows.select(
        "query", "neighbor", "contig", "type", "query_num", "num", "max_num", "distance", "query_direction", "direction", "start", "stop",
        rel.alias("rel_start"), (rel + F.abs(F.col("stop") - F.col("start"))).alias("rel_stop"),
        S.gene_length_aa("start", "stop").alias("seq_len"), bound.alias("is_bound"),
    )


def attach_gene_families(neighbors: DataFrame, fused: DataFrame, name: str = "family") -> DataFrame:
    """Fused family of each neighbour, ``none`` if it has no match."""
    fam = fused.select(F.col("accession").alias("neighbor"), F.col("family").alias(name))
    return neighbors.join(fam, "neighbor", "left").withColumn(name, F.coalesce(name, F.lit("none")))


def neighbor_status(queries: DataFrame, placed: DataFrame, neighbors: DataFrame) -> DataFrame:
    """``nomatch`` / ``noneighbor`` / ``neighbors`` and the genome per query."""
    n = neighbors.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
    j = queries.select("query").distinct().join(placed.select("query", "contig"), "query", "left").join(n, "query", "left")
    status = F.when(F.col("contig").isNull(), "nomatch").when(F.coalesce("n", F.lit(0)) == 0, "noneighbor").otherwise("neighbors")
    return j.select("query", F.col("contig").alias("genome"), status.alias("status"))


def restrict_window(neighbors: DataFrame, n: int) -> DataFrame:
    """Cut a stored window down to n genes; a contig that a window of n does not go around loses its wrapped genes.

    Exact for a stored window made with ``wrap_all``: only that has the wrapped genes of contigs shorter than itself.
    """
    flat = F.col("query_num") + F.col("distance")
    inside = (flat >= 1) & (flat <= F.col("max_num"))
    bound = F.when(F.col("query_num") - n < 1, 1).otherwise(0) + F.when(F.col("query_num") + n > F.col("max_num"), 2).otherwise(0)
    kept = neighbors.where((F.abs("distance") <= n) & (inside | (F.lit(n) < F.col("max_num"))))
    fields = [c for c in kept.columns if c not in ("query", "neighbor")]
    nearest = kept.groupBy("query", "neighbor").agg(F.min(F.struct(F.abs("distance").alias("_d"), F.col("num").alias("_n"), *fields)).alias("r"))
    return nearest.select("query", "neighbor", *[F.col(f"r.{c}").alias(c) for c in fields]).withColumn("is_bound", bound)


def clustered(neighbors: DataFrame, clusters: DataFrame) -> DataFrame:
    """Attach ``clusters(cluster, query)`` to neighbour rows."""
    return neighbors.join(clusters.select("cluster", "query"), "query")


def queryable(rows: DataFrame) -> DataFrame:
    """Queries with neighbours per cluster; clusters with fewer than two are left out."""
    return rows.groupBy("cluster").agg(F.countDistinct("query").alias("queryable")).where("queryable > 1")


def cooccurrence(rows: DataFrame) -> DataFrame:
    """Share of a cluster's queries that have a neighbour of the family, cut to two decimals."""
    once = rows.select("cluster", "family", "query").distinct()
    per = once.groupBy("cluster", "family").agg(F.count("query").alias("queries"))
    return per.join(queryable(once), "cluster").withColumn("ratio", S.trunc2_ratio("queries", "queryable"))


def cooccurrence_table(cooc: DataFrame) -> DataFrame:
    """Long ``(family, cluster, ratio)``: fused families split, their ratios summed, ``none`` left out.

    Ratios are summed as hundredths, so the total is exact. ``cooccurrence_matrix`` spreads the clusters.
    """
    parts = cooc.where("family <> 'none'").select("cluster", F.explode(F.split("family", "-")).alias("family"), F.round(F.col("ratio") * 100).cast("long").alias("h"))
    return parts.groupBy("family", "cluster").agg((F.sum("h") / 100.0).alias("ratio"))


def cooccurrence_matrix(table: DataFrame, clusters: list[int]) -> DataFrame:
    """Family × cluster matrix for the given cluster numbers, missing 0."""
    return table.groupBy("family").pivot("cluster", clusters).agg(F.first("ratio")).na.fill(0.0)


def median(rows: DataFrame, by: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact median of a value with few levels (gene distances)."""
    return bounded_quantiles(rows, by, value, {name: 0.5})


def spokes(rows: DataFrame, cluster_sizes: DataFrame) -> DataFrame:
    """Per (cluster, family): queries, neighbours, sizes, mean and median distance, ratio and its text."""
    d = rows.withColumn("_d", F.abs("distance"))
    # One pre-aggregation on (cluster, family, query, neighbour, distance) levels would not help here: counts are
    # already combined map-side; distances have at most 20 levels.
    agg = d.groupBy("cluster", "family").agg(
        F.countDistinct("query").alias("queries"), F.count(F.lit(1)).alias("neighbors"), F.avg("_d").alias("_avg")
    )
    med = median(d, ["cluster", "family"], "_d", "_med")
    out = agg.join(med, ["cluster", "family"]).join(queryable(rows), "cluster").join(cluster_sizes.select("cluster", "size"), "cluster", "left")
    return out.select(
        "cluster", "family", "queries", "neighbors", "size", "queryable",
        S.trunc2("_avg").alias("avg_distance"), S.trunc2("_med").alias("median_distance"),
        S.trunc2_ratio("queries", "queryable").alias("ratio"),
        F.concat_ws("/", F.col("queries").cast("string"), F.col("queryable").cast("string")).alias("ratio_text"),
    )


def node_shape(rows: DataFrame, annotations: DataFrame, by: list[str]) -> DataFrame:
    """diamond (structure and reviewed), square (structure), triangle (reviewed) or circle per group of neighbours."""
    a = annotations.select(
        F.col("accession").alias("neighbor"), (F.col("PDB").isNotNull() & ~F.col("PDB").isin("", "None")).alias("_pdb"), (F.col("STATUS") == "Reviewed").alias("_rev")
    )
    flags = rows.select(*by, "neighbor").join(a, "neighbor", "left").groupBy(*by).agg(
        F.coalesce(F.bool_or("_pdb"), F.lit(False)).alias("pdb"), F.coalesce(F.bool_or("_rev"), F.lit(False)).alias("rev")
    )
    shape = F.when(F.col("pdb") & F.col("rev"), "diamond").when(F.col("pdb"), "square").when(F.col("rev"), "triangle").otherwise("circle")
    return flags.select(*by, shape.alias("shape"))


def neighbor_text(annotations: DataFrame) -> DataFrame:
    """``EC:PDB:None:None:status`` of each accession, as listed next to a neighbour."""
    text = F.concat_ws(":", F.coalesce("EC", F.lit("")), F.coalesce("PDB", F.lit("")), F.lit("None"), F.lit("None"), S.status_label("STATUS"))
    return annotations.select(F.col("accession").alias("neighbor"), text.alias("text"))


def direction_name(c: str) -> Column:
    return F.when(F.col(c) == 0, "complement").otherwise("normal")


def _node_rows(df: DataFrame, fields: dict[str, tuple[str, Column]]) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), c.cast("string").alias("value")) for n, (t, c) in fields.items()]
    return df.select("node_id", F.explode(F.array(*pairs)).alias("a")).select("node_id", "a.name", "a.type", "a.value")


def cluster_hub_network(
    rows: DataFrame, cluster_sizes: DataFrame, annotations: DataFrame, info: DataFrame, colors: DataFrame, threshold: float = 0.20
) -> tuple[DataFrame, DataFrame]:
    """Hub = cluster, spokes = families with ratio ≥ threshold (a hub lists families strictly above it).

    Returns long node rows ``(node_id, name, type, value)`` and edges ``(source, target)``. Query and neighbour
    lists are rows, never arrays.
    """
    from clanweave.operators.annotate import family_names

    s = spokes(rows, cluster_sizes)
    kept = s.where(F.col("ratio") >= threshold)
    names = family_names(kept.select("family").distinct(), info)
    shaped = kept.join(names, "family", "left").join(node_shape(rows, annotations, ["cluster", "family"]), ["cluster", "family"])
    shaped = shaped.withColumn("node_id", F.concat_ws(":", "cluster", "family"))
    size = F.greatest(F.lit(1), F.floor(F.col("ratio") * 100 + 1e-9))
    nodes = _node_rows(
        shaped,
        {
            "SSN Cluster Number": ("integer", F.col("cluster")), "Pfam": ("string", F.col("family")), "Pfam Short Name": ("string", F.col("short")),
            "Pfam Description": ("string", F.col("long")), "# of Queries with Pfam Neighbors": ("integer", F.col("queries")),
            "# of Pfam Neighbors": ("integer", F.col("neighbors")), "# of Sequences in SSN Cluster": ("integer", F.col("size")),
            "# of Sequences in SSN Cluster with Neighbors": ("integer", F.col("queryable")),
            "Average Distance": ("real", F.format_string("%.2f", "avg_distance")), "Median Distance": ("real", F.format_string("%.2f", "median_distance")),
            "Co-occurrence": ("real", F.format_string("%.2f", "ratio")), "Co-occurrence Ratio": ("string", F.col("ratio_text")),
            "node.fillColor": ("string", F.lit("#EEEEEE")), "node.shape": ("string", F.col("shape")), "node.size": ("string", size),
        },
    )
    member = rows.join(kept.select("cluster", "family"), ["cluster", "family"], "left_semi").join(neighbor_text(annotations), "neighbor", "left")
    member = member.withColumn("node_id", F.concat_ws(":", "cluster", "family"))
    pair = F.concat_ws(":", "family", "query", "neighbor", "text")
    arrange = F.concat_ws(":", "family", "query", direction_name("query_direction"), "neighbor", direction_name("direction"), "distance")
    lists = member.select("node_id", F.lit("Query Accessions").alias("name"), F.lit("list").alias("type"), F.col("query").alias("value")).distinct()
    lists = lists.unionByName(member.select("node_id", F.lit("Query-Neighbor Accessions").alias("name"), F.lit("list").alias("type"), pair.alias("value")))
    lists = lists.unionByName(member.select("node_id", F.lit("Query-Neighbor Arrangement").alias("name"), F.lit("list").alias("type"), arrange.alias("value")))
    hubs = queryable(rows).join(cluster_sizes.select("cluster", "size"), "cluster", "left").join(colors.select("cluster", "color"), "cluster", "left")
    hub_nodes = _node_rows(
        hubs.withColumn("node_id", F.col("cluster").cast("string")),
        {
            "SSN Cluster Number": ("integer", F.col("cluster")), "# of Sequences in SSN Cluster": ("integer", F.col("size")),
            "# of Sequences in SSN Cluster with Neighbors": ("integer", F.col("queryable")), "node.fillColor": ("string", F.col("color")),
            "node.shape": ("string", F.lit("hexagon")), "node.size": ("string", F.lit("70.0")),
        },
    )
    above = s.where(F.col("ratio") > threshold).withColumn("node_id", F.col("cluster").cast("string"))
    two = lambda c: F.format_string("%.2f", c)
    hub_lists = _node_rows(
        above,
        {
            "Hub Queries with Pfam Neighbors": ("list", F.concat_ws(":", "cluster", "family", "queries")),
            "Hub Pfam Neighbors": ("list", F.concat_ws(":", "cluster", "family", "neighbors")),
            "Hub Average and Median Distance": ("list", F.concat_ws(":", F.col("cluster"), F.col("family"), two("avg_distance"), two("median_distance"))),
            "Hub Co-occurrence and Ratio": ("list", F.concat_ws(":", F.col("cluster"), F.col("family"), two("ratio"), F.col("ratio_text"))),
        },
    )
    edges = kept.select(F.col("cluster").cast("string").alias("source"), F.concat_ws(":", "cluster", "family").alias("target"))
    return nodes.unionByName(lists).unionByName(hub_nodes).unionByName(hub_lists), edges


def family_hub_network(
    rows: DataFrame, cluster_sizes: DataFrame, annotations: DataFrame, info: DataFrame, colors: DataFrame, threshold: float = 0.20
) -> tuple[DataFrame, DataFrame]:
    """The same table the other way round: hub = family, spokes = clusters with ratio ≥ threshold."""
    from clanweave.operators.annotate import family_names

    kept = spokes(rows, cluster_sizes).where(F.col("ratio") >= threshold)
    shaped = kept.join(node_shape(rows, annotations, ["cluster", "family"]), ["cluster", "family"]).join(colors.select("cluster", "color"), "cluster", "left")
    shaped = shaped.withColumn("node_id", F.concat_ws(":", "family", "cluster"))
    two = lambda c: F.format_string("%.2f", c)
    nodes = _node_rows(
        shaped,
        {
            "Cluster Number": ("integer", F.col("cluster")), "# of Sequences in SSN Cluster": ("integer", F.col("size")),
            "# of Sequences in SSN Cluster with Neighbors": ("integer", F.col("queryable")),
            "# of Queries with Pfam Neighbors": ("integer", F.col("queries")), "# of Pfam Neighbors": ("integer", F.col("neighbors")),
            "Average Distance": ("real", two("avg_distance")), "Median Distance": ("real", two("median_distance")),
            "Co-occurrence": ("real", two("ratio")), "Co-occurrence Ratio": ("string", F.col("ratio_text")),
            "node.fillColor": ("string", F.col("color")), "node.shape": ("string", F.col("shape")),
            "node.size": ("string", F.greatest(F.lit(1), F.floor(F.col("ratio") * 100 + 1e-9))),
        },
    )
    member = rows.join(kept.select("cluster", "family"), ["cluster", "family"], "left_semi").join(neighbor_text(annotations), "neighbor", "left")
    member = member.withColumn("node_id", F.concat_ws(":", "family", "cluster"))
    arrange = F.concat_ws(":", "query", direction_name("query_direction"), "neighbor", direction_name("direction"), "distance")
    lists = member.select("node_id", F.lit("Query Accessions").alias("name"), F.lit("list").alias("type"), F.col("query").alias("value")).distinct()
    lists = lists.unionByName(member.select("node_id", F.lit("Query-Neighbor Accessions").alias("name"), F.lit("list").alias("type"), F.concat_ws(":", "query", "neighbor", "text").alias("value")))
    lists = lists.unionByName(member.select("node_id", F.lit("Query-Neighbor Arrangement").alias("name"), F.lit("list").alias("type"), arrange.alias("value")))
    hub = family_hubs(kept)
    named = hub.join(family_names(hub.select("family"), info), "family", "left").withColumn("node_id", F.col("family"))
    hub_nodes = _node_rows(
        named,
        {
            "Pfam": ("string", F.col("family")), "Pfam Short Name": ("string", F.col("short")), "Pfam Description": ("string", F.col("long")),
            "# of Sequences in SSN Cluster": ("integer", F.col("size")), "# of Sequences in SSN Cluster with Neighbors": ("integer", F.col("queryable")),
            "# of Queries with Pfam Neighbors": ("integer", F.col("queries")), "# of Pfam Neighbors": ("integer", F.col("neighbors")),
            "node.fillColor": ("string", F.lit("#EEEEEE")), "node.shape": ("string", F.lit("hexagon")), "node.size": ("string", F.lit("70.0")),
        },
    )
    hub_lists = _node_rows(
        kept.withColumn("node_id", F.col("family")),
        {
            "Hub Average and Median Distances": ("list", F.concat_ws(":", F.col("cluster"), two("avg_distance"), two("median_distance"))),
            "Hub Co-occurrence and Ratio": ("list", F.concat_ws(":", F.col("cluster"), F.col("ratio").cast("string"), F.col("ratio_text"))),
        },
    )
    edges = kept.select(F.col("family").alias("source"), F.concat_ws(":", "family", "cluster").alias("target"))
    return nodes.unionByName(lists).unionByName(hub_nodes).unionByName(hub_lists), edges


def family_hubs(kept: DataFrame) -> DataFrame:
    """Sums of a family's kept clusters."""
    return kept.groupBy("family").agg(*[F.sum(c).alias(c) for c in ("size", "queryable", "queries", "neighbors")], F.count(F.lit(1)).alias("clusters"))


def neighbor_long(rows: DataFrame, colors: DataFrame, threshold: float | None = None, split: bool = False) -> DataFrame:
    """Query, neighbour, family, cluster, colour, distance (two digits) and ``dir-dir`` per neighbour.

    ``threshold`` keeps families whose ratio in the cluster reaches it; ``split`` gives one row per fused part.
    """
    out = rows
    if threshold is not None:
        ok = cooccurrence(rows).where(F.col("ratio") >= threshold).select("cluster", "family")
        out = out.join(ok, ["cluster", "family"], "left_semi")
    keys = ["query", "neighbor", "cluster", "distance", "query_direction", "direction"]
    out = out.select(*keys, "family")
    if split:  # rows are made distinct before they are multiplied; a neighbour has few families
        parts = F.flatten(F.transform(F.collect_set("family"), lambda f: F.split(f, "-")))
        out = out.groupBy(*keys).agg(parts.alias("_parts")).select(*keys, F.explode(F.array_distinct("_parts")).alias("family"))
    return out.join(colors.select("cluster", "color"), "cluster", "left").select(
        "query", "neighbor", "family", "cluster", "color", F.format_string("%02d", F.abs("distance")).alias("distance"),
        F.concat_ws("-", direction_name("query_direction"), direction_name("direction")).alias("directions"),
    )


def hub_counts(rows: DataFrame, cluster_sizes: DataFrame) -> DataFrame:
    """Queryable and total sequences per cluster."""
    n = rows.groupBy("cluster").agg(F.countDistinct("query").alias("queryable"))
    return cluster_sizes.select("cluster", "size").join(n, "cluster", "left").select("cluster", F.coalesce("queryable", F.lit(0)).alias("queryable"), F.col("size").alias("total"))


def no_family_neighbors(rows: DataFrame) -> DataFrame:
    return rows.where("family = 'none'").select("cluster", "neighbor").distinct()


def annotate_network_neighbors(metanode: DataFrame, status: DataFrame, families: DataFrame) -> DataFrame:
    """Long node rows: presence in the genome table, neighbours, genome and distinct neighbour families.

    ``families(query, name, family)`` carries neighbour families by attribute name (fused ones are split here).
    """
    s = metanode.select("node_id", S.strip_domain("member").alias("query")).distinct().join(status, "query", "left")
    rows = _node_rows(
        s,
        {
            "Present in ENA Database?": ("list", F.when(F.col("status").isNull() | (F.col("status") == "nomatch"), "false").otherwise("true")),
            "Genome Neighbors in ENA Database?": ("list", F.when(F.col("status") == "neighbors", "true").when(F.col("status") == "nomatch", "n/a").otherwise("false")),
            "ENA Database Genome ID": ("list", F.col("genome")),
        },
    )
    f = families.select("query", "name", F.explode(F.split("family", "-")).alias("value")).where("value <> 'none'").distinct()
    fam = s.select("node_id", "query").join(f, "query").select("node_id", "name", F.lit("list").alias("type"), "value").distinct()
    return rows.unionByName(fam)


# ---- diagrams -------------------------------------------------------------------------------------
def cluster_index(rows: DataFrame) -> DataFrame:
    """Global 0-based index by (cluster, e-value, accession), without a single-task sort."""
    order = ["cluster_num"] + (["evalue"] if "evalue" in rows.columns else []) + ["accession"]
    ranked = ordered_scan(rows, [], order, rank="_r")
    return ranked.withColumn("cluster_index", F.col("_r") - 1).drop("_r")


def cluster_extents(indexed: DataFrame) -> DataFrame:
    return indexed.groupBy("cluster_num").agg(F.min("cluster_index").alias("start_index"), F.max("cluster_index").alias("end_index"))


def order_by_clan(rows: DataFrame) -> DataFrame:
    """Order ``(cluster, accession, clan, fam)`` within a cluster: clan size, clan number, family number.

    Rows without a clan come last (sort order 999999, no ID).
    """
    listed = rows.where("clan is not null")
    sized = listed.join(listed.groupBy("cluster", "clan").agg(F.count(F.lit(1)).alias("_size")), ["cluster", "clan"])
    ranked = rank_within(sized, ["cluster"], [F.desc("_size"), F.asc("clan"), F.asc("fam"), F.asc("accession")], "_r")
    pos = (F.col("_r") - 1).alias("sort_order")
    uid = F.concat(F.lit("SSN"), "cluster", F.lit("-CL"), "clan", F.lit("-FAM"), "fam", F.lit("-"), F.col("_r") - 1).alias("uid")
    done = ranked.select("cluster", "accession", "clan", "fam", pos, uid)
    last = rows.where("clan is null").select("cluster", "accession", "clan", "fam", F.lit(999999).cast("long").alias("sort_order"), F.lit(None).cast("string").alias("uid"))
    return done.unionByName(last)


def neighborhood_diagrams(
    placed: DataFrame, neighbors: DataFrame, annotations: DataFrame, clusters: DataFrame | None = None, evalues: DataFrame | None = None,
    centers: DataFrame | None = None, title: str = "", n: int = 10, pfam: DataFrame | None = None, interpro: DataFrame | None = None,
    family_info: DataFrame | None = None, matched: DataFrame | None = None, unmatched: DataFrame | None = None,
    cooccurrence: float | None = None, kind: str = "", sequence: str | None = None,
) -> dict[str, DataFrame]:
    """The diagram tables: attributes, neighbors, families, cluster_degree, metadata, cluster_index, matched, unmatched.

    ``neighbors`` carries ``family``. With ``pfam`` and ``interpro`` (accession, family; fused) queries get their families and both sides their
    InterPro families, with ``family_info`` also the names of both kinds; a gene without one has ``none``. ID tables come from ID mapping.
    """
    none = F.lit("none")

    def with_families(genes: DataFrame, has: DataFrame | None = None) -> DataFrame:
        for column, fused in (("family", pfam if has is None else None), ("ipro_family", interpro)):
            if fused is not None:
                genes = genes.join(fused.select("accession", F.col("family").alias(column)), "accession", "left").withColumn(column, F.coalesce(column, none))
            if column in genes.columns and family_info is not None:
                # Named are the families of the table they come from: the rows of genes need not be made twice for that.
                listed = (fused if fused is not None else has).select("family")
                listed = listed.unionByName(listed.sparkSession.range(1).select(none.alias("family"))).distinct()
                names = family_names(listed, family_info)
                genes = genes.join(names.select(F.col("family").alias(column), F.col("short").alias(f"{column}_desc")), column, "left")
        return genes

    info = annotations.select(F.col("accession"), F.col("Taxonomy_ID").alias("taxon_id"), S.status_label("STATUS").alias("anno_status"), F.col("Description").alias("desc"), F.col("Organism").alias("organism"))
    attr = placed.select(
        F.col("query").alias("accession"), F.col("contig").alias("id"), F.col("query_num").alias("num"), F.col("query_start").alias("start"), F.col("query_stop").alias("stop"),
        F.lit(0).cast("long").alias("rel_start"), (F.col("query_stop") - F.col("query_start")).alias("rel_stop"), direction_name("query_direction").alias("direction"),
        F.when(F.col("type") == 0, "circular").otherwise("linear").alias("type"), S.gene_length_aa("query_start", "query_stop").alias("seq_len"),
        (F.when(F.col("query_num") - n < 1, 1).otherwise(0) + F.when(F.col("query_num") + n > F.col("max_num"), 2).otherwise(0)).alias("is_bound"),
    ).join(info, "accession", "left")
    if clusters is None:
        attr = attr.withColumn("cluster_num", F.lit(0))
    else:
        attr = attr.join(clusters.select(F.col("query").alias("accession"), F.col("cluster").alias("cluster_num")), "accession")
    if evalues is not None:
        attr = attr.join(evalues.select(F.col("id").alias("accession"), "evalue"), "accession", "left")
    attr = with_families(attr)
    attr = cluster_index(attr).withColumn("sort_key", F.col("cluster_index") + 1)
    keys = attr.select(F.col("accession").alias("query"), F.col("sort_key").alias("gene_key"))
    nb = neighbors.join(keys, "query").select(
        "gene_key", F.col("neighbor").alias("accession"), F.col("contig").alias("id"), "num", "family", "start", "stop", "rel_start", "rel_stop",
        "direction", "type", "seq_len", "distance",
    ).join(info.drop("organism"), "accession", "left")
    nb = nb.withColumns({"direction": direction_name("direction"), "type": F.when(F.col("type") == 0, "circular").otherwise("linear")})
    nb = with_families(nb, neighbors)
    out = {"attributes": attr, "neighbors": nb, "families": nb.select("family").distinct(), "cluster_index": cluster_extents(attr)}
    if centers is not None:
        out["cluster_degree"] = centers
    meta = "cooccurrence double, name string, neighborhood_size int, type string, sequence string"
    out["metadata"] = placed.sparkSession.createDataFrame([(cooccurrence, title, n, kind, sequence)], meta)
    if matched is not None:
        out["matched"] = matched
    if unmatched is not None:
        out["unmatched"] = unmatched
    return out


def export_neighborhood_windows(attributes: DataFrame, neighbors: DataFrame, window: int, min_queries: int = 3) -> tuple[DataFrame, DataFrame]:
    """``(metadata rows, list rows)`` for clusters with at least three queries.

    List rows are the query and its neighbours within ±window by ordinal, in gene order, each with its header
    ``acc_ORFn:gid:…:pid:query:loc:start:stop:strand:±``; a query is listed only where some gene follows it.
    """
    big = attributes.groupBy("cluster_num").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_queries).select("cluster_num")
    q = attributes.join(big, "cluster_num", "left_semi").select("cluster_num", F.col("accession").alias("query"), F.col("id").alias("q_id"), F.col("num").alias("q_num"), F.col("start").alias("q_start"), F.col("stop").alias("q_stop"), F.col("direction").alias("q_dir"), F.col("seq_len").alias("q_len"), "organism", "sort_key")
    strand = lambda c: F.when(F.col(c) == "normal", "+").otherwise("-")
    near = neighbors.join(q, neighbors.gene_key == q.sort_key).where(F.abs(F.col("num") - F.col("q_num")) <= window)
    head = lambda a, n, g, s, e, d: F.concat(F.col(a), F.lit("_ORF"), F.concat_ws(":", F.col(n).cast("string"), F.lit("gid"), F.col(g), F.lit("pid"), F.col("query"), F.lit("loc"), F.col(s).cast("string"), F.col(e).cast("string"), F.lit("strand"), strand(d)))
    rows = near.select("cluster_num", "query", F.col("num").alias("num"), "accession", head("accession", "num", "id", "start", "stop", "direction").alias("header"))
    followed = near.where(F.col("num") > F.col("q_num")).select("query").distinct()
    own = q.join(followed, "query", "left_semi").select("cluster_num", "query", F.col("q_num").alias("num"), F.col("query").alias("accession"), head("query", "q_num", "q_id", "q_start", "q_stop", "q_dir").alias("header"))
    lists = rows.unionByName(own)
    listed = lists.select("query").distinct()
    meta = q.join(listed, "query", "left_semi").select("cluster_num", "query", F.col("q_id").alias("gene_id"), F.col("q_len").alias("seq_len"), "organism", F.lit(0).alias("contig_edge"))
    return meta, lists


def validate_windows(meta: DataFrame, lists: DataFrame, fasta: DataFrame) -> DataFrame:
    """Keep queries with more than two listed IDs found; add total residues and record count.

    ``fasta(query, accession, seq)`` holds the records retrieved for each query's window.
    """
    ids = lists.select("query", "accession").distinct().withColumn("_listed", F.lit(1))
    found = fasta.join(ids, ["query", "accession"], "left").groupBy("query").agg(
        F.sum(F.coalesce("_listed", F.lit(0))).alias("_found"), F.sum(F.length("seq")).alias("total_length"), F.count(F.lit(1)).alias("records")
    )
    return meta.join(found.where(F.col("_found") > 2), "query").drop("_found")
