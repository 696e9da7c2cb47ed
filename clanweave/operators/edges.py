"""Similarity edges: ``(src, dst, pid, alen, bitscore, src_len, dst_len)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clanweave.functions import scalar as S
from clanweave.functions.ordered import bounded_quantiles


def canonicalize_edges(edges: DataFrame) -> DataFrame:
    """Order the endpoints by string comparison and swap the lengths with them. Narrow, no shuffle."""
    swap = F.col("src") > F.col("dst")
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    return edges.select(
        pick("src", "dst").alias("src"),
        pick("dst", "src").alias("dst"),
        *[c for c in edges.columns if c not in ("src", "dst", "src_len", "dst_len")],
        pick("src_len", "dst_len").alias("src_len"),
        pick("dst_len", "src_len").alias("dst_len"),
    )


def best_edge_per_pair(edges: DataFrame) -> DataFrame:
    """Highest bitscore per (src, dst); ties by identity, then alignment length.

    One shuffle with map-side combining: ``max`` over a struct instead of a sort per pair.
    """
    rest = [c for c in edges.columns if c not in ("src", "dst", "bitscore", "pid", "alen")]
    best = F.max(F.struct("bitscore", "pid", "alen", *rest)).alias("b")
    return edges.groupBy("src", "dst").agg(best).select(
        "src", "dst", *[F.col(f"b.{c}").alias(c) for c in edges.columns if c not in ("src", "dst")]
    )


def drop_self_edges(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src") != F.col("dst"))


def with_score(edges: DataFrame) -> DataFrame:
    return edges.withColumn("score", S.alignment_score("src_len", "dst_len", "bitscore"))


def filter_edges(edges: DataFrame, by: str = "eval", min_value: float = 0, min_len: int = 0, max_len: int = 0) -> DataFrame:
    """Score (``eval``), bitscore (``bit``) or identity (``pid``) at least ``min_value``; both lengths in bounds.

    ``max_len=0`` means no upper bound. A plain predicate, so it reaches the Parquet scan.
    """
    value = {
        "eval": S.alignment_score("src_len", "dst_len", "bitscore"),
        "bit": F.col("bitscore"),
        "pid": F.col("pid"),
    }[by]
    keep = value >= min_value
    for c in ("src_len", "dst_len"):
        if min_len:
            keep &= F.col(c) >= min_len
        if max_len:
            keep &= F.col(c) <= max_len
    return edges.where(keep)


def attach_lengths(edges: DataFrame, seqs: DataFrame) -> DataFrame:
    """Add ``src_len`` and ``dst_len`` from ``seqs(id, seq_len)``."""
    for side in ("src", "dst"):
        lens = seqs.select(F.col("id").alias(side), F.col("seq_len").cast("int").alias(f"{side}_len"))
        edges = edges.join(lens, side, "left")
    return edges


def edges_within_clusters(edges: DataFrame, id_cluster: DataFrame) -> DataFrame:
    """Keep edges whose endpoints carry the same custom cluster; ``id_cluster(id, cluster)`` has one row per ID.

    Only IDs of 6 or 10 characters count, as in the custom cluster files; ``other_cluster_ids`` returns the rest.
    """
    ok = id_cluster.where(F.length("id").isin(6, 10)).dropDuplicates(["id", "cluster"])
    a = ok.select(F.col("id").alias("src"), F.col("cluster").alias("_a"))
    b = ok.select(F.col("id").alias("dst"), F.col("cluster").alias("_b"))
    return edges.join(a, "src").join(b, "dst").where("_a = _b").select(*edges.columns)


def other_cluster_ids(id_cluster: DataFrame) -> DataFrame:
    """The rows of a custom cluster file that do not count because of the length of their ID, such as domain nodes."""
    return id_cluster.where(F.col("id").isNull() | ~F.length("id").isin(6, 10)).distinct()


def edges_between_representatives(edges: DataFrame, reps: DataFrame) -> DataFrame:
    """Both endpoints are in ``reps(rep)``."""
    for side in ("src", "dst"):
        edges = edges.join(reps.select(F.col("rep").alias(side)), side, "left_semi")
    return edges


def demultiplex_counts(edges: DataFrame, members: DataFrame) -> DataFrame:
    """The network before representatives were taken, in compressed form.

    Every edge between representatives stands for ``n_pairs`` member pairs: ``|R|·(|R|-1)/2`` for a self row,
    ``|R|·|S|`` otherwise. All sums over the expanded network follow from it without listing a pair, so the
    cost stays linear however large a group of copies is. Edges of unknown representatives are dropped.
    """
    size = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    a = size.select(F.col("rep").alias("src"), F.col("n").alias("_na"))
    b = size.select(F.col("rep").alias("dst"), F.col("n").alias("_nb"))
    own = F.expr("_na * (_na - 1) div 2")
    pairs = F.when(F.col("src") == F.col("dst"), own).otherwise(F.col("_na") * F.col("_nb"))
    return edges.join(a, "src").join(b, "dst").withColumn("n_pairs", pairs).drop("_na", "_nb")


def demultiplex(edges: DataFrame, members: DataFrame, reps: DataFrame) -> DataFrame:
    """List the member pairs behind the edges between the named ``reps(rep)``; self rows give each unordered pair once.

    A listing is as large as the product of the groups, so it is made for what a caller asks to see;
    ``demultiplex_counts`` holds the same information for the whole network.
    """
    edges = edges_between_representatives(edges, reps.select("rep").distinct())
    a = members.select(F.col("rep").alias("src"), F.col("member").alias("_a"))
    b = members.select(F.col("rep").alias("dst"), F.col("member").alias("_b"))
    both = edges.join(a, "src").join(b, "dst").where((F.col("src") != F.col("dst")) | (F.col("_a") < F.col("_b")))
    return both.select(F.col("_a").alias("src"), F.col("_b").alias("dst"), *[c for c in edges.columns if c not in ("src", "dst")])


def demultiplex_degrees(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Degree of every member in the expanded network, again without listing it."""
    size = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    around = edges.where("src <> dst").select(F.col("src").alias("rep"), F.col("dst").alias("o")).unionByName(
        edges.where("src <> dst").select(F.col("dst").alias("rep"), F.col("src").alias("o"))
    )
    other = around.join(size.withColumnRenamed("rep", "o"), "o").groupBy("rep").agg(F.sum("n").alias("d"))
    own = edges.where("src = dst").select(F.col("src").alias("rep")).join(size, "rep").groupBy("rep").agg(F.sum(F.col("n") - 1).alias("d"))
    total = other.unionByName(own).groupBy("rep").agg(F.sum("d").alias("degree"))
    return members.join(total, "rep", "left").select("member", F.coalesce("degree", F.lit(0)).alias("degree"))


def convergence_ratio(edges: DataFrame, seqs: DataFrame, weight: str | None = None) -> DataFrame:
    """``2E / (n(n-1))``, 1 when the denominator is 0. ``weight`` counts compressed edges.

    Both counts come out of one union, so no one-row frames are crossed.
    """
    e = edges.select((F.col(weight) if weight else F.lit(1)).cast("long").alias("e"), F.lit(0).cast("long").alias("n"))
    n = seqs.select(F.lit(0).cast("long").alias("e"), F.lit(1).cast("long").alias("n"))
    both = e.unionByName(n).agg(F.coalesce(F.sum("e"), F.lit(0)).alias("edge_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("unique_seq"))
    den = F.col("unique_seq").cast("double") * (F.col("unique_seq") - 1)
    return both.withColumn("ratio", F.when(den == 0, 1.0).otherwise(2.0 * F.col("edge_count") / den))


def score_histogram(edges: DataFrame, min_edges: int = 10, min_scores: int = 30) -> DataFrame:
    """Edges per alignment score, trimmed at both ends.

    Leading scores with fewer than ``min_edges`` edges go while at least ``min_scores`` scores remain; then
    trailing ones likewise, where each removed score counts twice against the number remaining, as two
    value files per score are dropped. The ordered part runs on one row per integer score.
    """
    counts = with_score(edges).groupBy("score").agg(F.count(F.lit(1)).alias("edges"))
    up, down, everything = Window.orderBy("score"), Window.orderBy(F.desc("score")), Window.partitionBy(F.lit(1))
    enough = (F.col("edges") >= min_edges).cast("int")
    marked = counts.select(
        "score", "edges",
        (F.row_number().over(up) - 1).alias("_i"),
        F.count(F.lit(1)).over(everything).alias("_n"),
        F.sum(enough).over(up).alias("_lead"),
        F.sum(enough).over(down).alias("_trail"),
    )
    head = (F.col("_lead") == 0) & (F.col("_n") - F.col("_i") > min_scores)
    marked = marked.withColumn("_head", head).withColumn("_h", F.sum(F.col("_head").cast("int")).over(everything))
    tail = (F.col("_trail") == 0) & (F.col("_i") - 2 * F.col("_h") > min_scores)
    return marked.where(~F.col("_head") & ~tail).select("score", "edges")


def score_cumulative(edges: DataFrame) -> DataFrame:
    """score, edges, edges at this score or better. The window sees one row per integer score."""
    counts = with_score(edges).groupBy("score").agg(F.count(F.lit(1)).alias("edges"))
    return counts.withColumn("at_least", F.sum("edges").over(Window.orderBy(F.desc("score"))))


def score_quartiles(edges: DataFrame, value: str = "alen") -> DataFrame:
    """Box statistics of ``alen`` or ``pid`` per score; both have few levels, which are counted first."""
    points = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return bounded_quantiles(with_score(edges), ["score"], value, points)


def node_degree(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def neighborhood_connectivity(edges: DataFrame) -> DataFrame:
    """``(node, degree, connectivity)``: mean degree of a node's neighbours, cut to hundredths.

    Every row of ``edges`` counts, repeated ones as often as they are there; a self edge is two ends of its node. Degrees are summed map-side
    and sent along the edges once per end; a hub is one row of the degrees, so the long side of that join may be split, and what its
    neighbours send back is summed map-side again. Edges with a missing end take no part.
    """
    known = edges.where("src is not null and dst is not null")
    ends = F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("node"), F.col("src").alias("other"))))
    # repeated pairs become one row with a count before anything is joined
    around = known.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")).select(ends.alias("e"), "n").select("e.node", "e.other", "n")
    degree = around.groupBy("node").agg(F.sum("n").alias("degree"))
    sent = around.join(degree.select(F.col("node").alias("other"), F.col("degree").alias("_d")), "other")
    total = sent.groupBy("node").agg(F.sum(F.col("n") * F.col("_d")).alias("_t"), F.sum("n").alias("degree"))
    return total.select("node", "degree", (F.expr("_t * 100 div degree") / 100.0).alias("connectivity"))
