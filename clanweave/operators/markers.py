"""Marker regions of protein families: overlap counts, true, junction and quasi markers, weights, checks.

Everything per family is bounded by the length of its consensus: hits are first reduced to counts or interval
ends per position, so a family with very many hits is no larger than any other when it is put together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clanweave.functions import scalar as S

MASK = 9_999_999  # fixed value: overlap added at an ambiguous residue
RESERVED = r"_TM|_JM|_QM|w="  # fixed values: text reserved for marker names
BAD_CHARACTERS = r"[\\/*=:'\[\].;,]"


def usable_hits(hits: DataFrame, min_id: float, min_len: int, max_frac: float) -> DataFrame:
    frac = F.col("alen") / F.col("qlen")
    return hits.where((F.col("query") != F.col("subject")) & (F.col("pid") / 100 >= min_id) & (F.col("alen") >= min_len) & (frac <= max_frac))


def overlap_counts(seqs: DataFrame, sources: Sequence[tuple[DataFrame, float, int, float]], spans: bool = False) -> DataFrame:
    """``(family, pos, n)`` for every position: number of usable hits over all sources that cover it.

    With ``spans`` one row ``(family, pos, next, n)`` stands for the positions from ``pos`` up to ``next`` that have the same number.
    Each hit is two events (+1 at its start, −1 after its end), summed map-side; the running sum then sees at
    most one row per position of a family.
    """
    n = F.length("seq")
    events = seqs.select(F.col("family"), F.explode(F.array(F.lit(1), n + 1)).alias("pos"), F.lit(0).cast("long").alias("d"))
    for hits, min_id, min_len, max_frac in sources:
        ends = F.explode(F.array(F.struct(F.col("qstart").alias("pos"), F.lit(1).cast("long").alias("d")), F.struct((F.col("qend") + 1).alias("pos"), F.lit(-1).cast("long").alias("d"))))
        e = usable_hits(hits, min_id, min_len, max_frac).select(F.col("query").alias("family"), ends.alias("e")).select("family", "e.pos", "e.d")
        events = events.unionByName(e.join(seqs.select("family"), "family", "left_semi"))
    steps = events.groupBy("family", "pos").agg(F.sum("d").alias("d"))
    w = Window.partitionBy("family").orderBy("pos")
    runs = steps.select("family", "pos", F.lead("pos").over(w).alias("next"), F.sum("d").over(w).alias("n")).where("next is not null")
    if spans:
        return runs.where("pos is not null")
    return runs.select("family", F.explode(F.sequence(F.col("pos"), F.col("next") - 1)).alias("pos"), "n")


def mask_ambiguous(counts: DataFrame, seqs: DataFrame) -> DataFrame:
    x = seqs.select("family", F.posexplode(F.split("seq", "")).alias("_p", "_c")).where(F.lower("_c") == "x")
    x = x.select("family", (F.col("_p") + 1).alias("pos"), F.lit(MASK).alias("_m"))
    return counts.join(x, ["family", "pos"], "left").select("family", "pos", (F.col("n") + F.coalesce("_m", F.lit(0))).alias("n"))


def true_markers(counts: DataFrame, seqs: DataFrame, min_len: int = 8, max_total: int = 300) -> DataFrame:
    """Runs without overlap of at least ``min_len``, numbered from the left; a family's total is cut to ``max_total``. ``counts`` by position or by span."""
    w = Window.partitionBy("family").orderBy("pos")
    if "next" in counts.columns:
        zero = counts.where("n = 0").withColumn("_l", F.col("next") - F.col("pos")).withColumn("_g", F.col("next") - F.sum("_l").over(w))
    else:
        zero = counts.where("n = 0").withColumn("_l", F.lit(1)).withColumn("_g", F.col("pos") - F.row_number().over(w))
    runs = zero.groupBy("family", "_g").agg(F.min("pos").alias("start"), F.sum("_l").alias("_len")).where(F.col("_len") >= min_len)
    ws = Window.partitionBy("family").orderBy("start")
    before = F.coalesce(F.sum("_len").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("_room", F.lit(max_total) - before).where(F.col("_room") >= min_len)
    runs = runs.withColumn("end", (F.col("start") + F.least("_len", "_room") - 1).cast("int")).withColumn("ordinal", F.row_number().over(ws))
    return runs.join(seqs.select("family", F.col("seq").alias("_s")), "family").select("family", "start", "end", S.subsequence("_s", "start", "end").alias("seq"), "ordinal")


def junction_windows(residues: np.ndarray, reach: np.ndarray, marker_len: int, short: int, x_limit: int) -> np.ndarray:
    """All junction windows of one sequence as rows (first, last), 1-based, from left to right.

    A seed is a stretch of ``short`` residues with at most ``x_limit`` ambiguous ones that no single hit covers, even if it is moved by
    one residue to the left (from the third residue on) or made one longer. ``reach[p]`` is the furthest end of the hits that start at p or before.
    Seeds are taken from the left, each at least ``marker_len`` after the first residue of the window before it. A window extends its seed to the right
    and, if it is still short, to the left: at most ``marker_len`` residues away, within the sequence, and no further than the residue
    with which the window holds ``x_limit`` ambiguous ones.
    """
    n = len(residues)
    first = np.arange(1, max(n - short, 0) + 1)
    last = first + short - 1
    ambiguous = np.flatnonzero(residues) + 1
    upto = np.concatenate([[0], np.cumsum(residues)])
    covered = (reach[first] >= last) | ((first > 2) & (reach[first - 1] >= last - 1)) | (reach[first] >= last + 1)
    seeds = first[~covered & (upto[last] - upto[first - 1] <= x_limit)]
    found, at = [], 0
    while n >= marker_len and at < len(seeds):
        left, right = int(seeds[at]), int(seeds[at]) + short - 1
        # the ambiguous residue that fills the window, counted from its left end, then from its right end
        full = int(upto[left - 1]) + x_limit - 1
        stop = ambiguous[full] if full < len(ambiguous) else n
        right = int(min(left + marker_len, n, max(right, stop)))
        if right - left + 1 < marker_len:
            full = int(upto[right]) - x_limit
            stop = ambiguous[full] if full >= 0 else 1
            left = int(max(right - marker_len, 1, min(left, stop)))
        found.append((left, right))
        at = int(np.searchsorted(seeds, left + marker_len))
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def junction_markers(seqs: DataFrame, hits: DataFrame, marker_len: int = 33, short: int | None = None, x_limit: int = 1, keep: int = 3) -> DataFrame:
    """The ``keep`` longest junction windows of each family (see ``junction_windows``); ``keep`` is part of what the operator reports.

    Only the furthest end per start position of the hits matters for "inside a hit", so at most one row per position reaches a family.
    """
    short = int(0.40 * marker_len) if short is None else short
    far = hits.groupBy(F.col("query").alias("family"), "qstart").agg(F.max("qend").alias("qend"))
    spans = far.groupBy("family").agg(F.collect_list(F.struct("qstart", "qend")).alias("spans"))
    rows = seqs.select("family", "seq").join(spans, "family", "left")

    def windows(seq: str, spans) -> np.ndarray:
        reach = np.zeros(len(seq) + 2, dtype=np.int64)
        if spans is not None and len(spans):
            np.maximum.at(reach, np.minimum([s["qstart"] for s in spans], len(seq) + 1), [s["qend"] for s in spans])
        residues = np.frombuffer(seq.encode("ascii", "replace"), dtype="S1") == b"X"
        found = junction_windows(residues, np.maximum.accumulate(reach), marker_len, short, x_limit)
        size = found[:, 1] - found[:, 0] + 1
        best = np.argsort(-size, kind="stable")[:keep]
        return found[best[size[best] >= short * 1.1]]

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for fam, seq, spans_ in zip(pdf["family"], pdf["seq"], pdf["spans"]):
                out += [(fam, a, b, seq[a - 1 : b], i + 1) for i, (a, b) in enumerate(windows(seq, spans_).tolist())]
            yield pd.DataFrame(out, columns=["family", "start", "end", "seq", "ordinal"])

    return rows.mapInPandas(grow, "family string, start int, end int, seq string, ordinal int")


def quasi_markers(counts: DataFrame, seqs: DataFrame, window: int = 33, threshold: float = 60.0, max_total: int = 300) -> DataFrame:
    """The stretch of least overlap of each family, widened as far as the threshold allows; columns only.

    ``counts`` has a row per position or per span of positions (``overlap_counts``); spans keep the rows that are sorted and gathered few.

    With T(i) the sum of overlap^¼ over the first i positions: the stretch begins as the window of ``window`` (12 at least) positions with the least T(end) − T(start),
    the leftmost of equals. Its end moves to the last position, short of the sequence's last residue and of ``max_total``, at which the sum is within
    the threshold. If the end was not held back by the threshold, the start moves likewise to the first such position.
    """
    size = max(window, 12)
    w = Window.partitionBy("family").orderBy("pos")
    # whole millionths: sums do not depend on their order, and equal the threshold where they should
    root = F.round(F.pow(F.col("n").cast("double"), F.lit(0.25)) * 1_000_000).cast("long")
    length = F.col("next") - F.col("pos") if "next" in counts.columns else F.lit(1)
    running = counts.select("family", "pos", F.sum(root * length).over(w).alias("t"), root.alias("root"), length.alias("more"))
    limit = F.lit(round(threshold * 1_000_000))
    # the sum at a span's last position is known; at those before it, it is less by the root for each
    sums = lambda x: F.transform(F.sequence(x["more"] - 1, F.lit(0), F.lit(-1)), lambda k: x["t"] - x["root"] * k)
    listed = running.groupBy("family").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t", "root", "more"))), sums)).alias("t"))
    d = seqs.select("family", "seq").join(listed, "family").withColumn("t", F.concat(F.array(F.lit(0).cast("long")), "t"))
    d = d.withColumn("len", F.size("t") - 1)
    at = lambda i: F.element_at("t", F.least(i, F.col("len")) + 1)
    starts = F.sequence(F.lit(0), F.greatest(F.col("len") - size, F.lit(0)))
    d = d.withColumn("a", F.array_min(F.transform(starts, lambda i: F.struct((at(i + size) - at(i)).alias("s"), i.alias("i"))))["i"])
    d = d.withColumn("b", F.col("a") + size)
    # the end may reach ``most``; sums rise with it, so the admissible ends come first
    most = F.greatest(F.least(F.length("seq") - 1, F.when(F.col("len") - F.col("a") < max_total, F.length("seq") - 1).otherwise(F.col("a") + max_total - 1)), F.col("b"))
    d = d.withColumn("most", most)
    ends = F.when(F.col("most") > F.col("b"), F.sequence(F.col("b") + 1, F.col("most"))).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("b", F.col("b") + F.size(F.filter(ends, lambda e: at(e) - at(F.col("a")) <= limit)))
    least = F.greatest(F.least("b", "len") + 1 - max_total, F.lit(0))
    firsts = F.when((F.col("b") == F.col("most")) & (least < F.col("a")), F.sequence(least, F.col("a") - 1)).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("a", F.col("a") - F.size(F.filter(firsts, lambda i: at(F.col("b")) - at(i) <= limit)))
    quasi = F.floor((at(F.col("b")) - at(F.col("a"))) / 1_000_000).cast("int").alias("quasi")
    return d.select("family", (F.col("a") + 1).alias("start"), F.least("b", "len").alias("end"), F.substring("seq", F.col("a") + 1, F.col("b") - F.col("a")).alias("seq"), quasi)


def marker_weights(markers: DataFrame, hits: DataFrame) -> DataFrame:
    """Share of each overlapping hit, and of the marker itself, in the total overlap of ``markers(marker, family, start, end)``.

    An equi-join on the family with an interval test; a family has a handful of markers.
    """
    m = markers.select("marker", "family", F.col("start").alias("_s"), F.col("end").alias("_e"))
    over = m.join(hits.select(F.col("query").alias("family"), "subject", "qstart", "qend"), "family").where((F.col("qstart") <= F.col("_e")) & (F.col("qend") >= F.col("_s")))
    rows = over.select("marker", "subject", (F.least("qend", "_e") - F.greatest("qstart", "_s") + 1).cast("int").alias("overlap"))
    rows = rows.unionByName(m.select("marker", F.col("family").alias("subject"), (F.col("_e") - F.col("_s") + 1).cast("int").alias("overlap")))
    total = rows.groupBy("marker").agg(F.sum("overlap").alias("_t"))
    return rows.join(total, "marker").select("marker", "subject", "overlap", (F.col("overlap") / F.col("_t")).alias("weight"))


def cluster_markers(markers: DataFrame, identity: float = 0.90) -> DataFrame:
    """``(rep, marker)`` of near-identical marker sequences of equal length, over the whole length; the smallest ID of those that stand first is ``rep``.

    Close markers are found by their segments (``segment_links``), so none is missed.
    """
    from clanweave.operators.similarity import representatives, segment_links

    seqs = markers.select(F.col("marker").alias("id"), "seq")
    links = segment_links(seqs, identity) if identity < 1.0 else None
    return representatives(seqs, identity, 1.0, links).select("rep", F.col("member").alias("marker"))


def remap_families(families: DataFrame, clusters: DataFrame) -> DataFrame:
    """Family map ``(family, member)`` after quasi markers were merged; ``clusters(rep, marker)`` name families."""
    c = clusters.select(F.col("marker").alias("family"), F.col("rep").alias("_rep"))
    return families.join(c, "family", "left").select(F.coalesce("_rep", "family").alias("family"), "member")


def validate_marker_ids(ids: DataFrame) -> DataFrame:
    """One row per offending ID with its reasons."""
    counted = ids.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    why = F.array_compact(F.array(
        F.when(F.col("id").rlike(BAD_CHARACTERS), F.lit("bad character")), F.when(F.col("_n") > 1, F.lit("duplicate")), F.when(F.col("id").rlike(RESERVED), F.lit("reserved"))
    ))
    return counted.select("id", F.array_join(why, ",").alias("reason")).where("reason <> ''")


def off_target_markers(hits: DataFrame, families: DataFrame, min_id: float = 0.95, read_len: int = 32) -> DataFrame:
    """Markers with a significant hit on a member of another family; ``qlen`` is in nucleotides."""
    own = F.regexp_extract("marker", r"(.*)_.M[0-9]*_#[0-9]*", 1)
    j = hits.where((F.col("pid") / 100 >= min_id) & (F.col("alen") >= F.least(F.col("qlen") / 3, F.lit(read_len)))).join(families, "subject")
    return j.where(F.col("family") != own).select("marker").distinct()
