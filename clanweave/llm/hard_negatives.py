"""Hard negatives with bounds along a spanning tree of the anchors.

The score of a row is its inner product with an anchor. If an anchor lies at distance d from its parent in the tree, a row of norm n scores within
d n of what it scores at the parent. Where that range misses every score that is asked for, the row is not scored at the child; the range is
handed on, widened, to the child's children. Anchors are dealt into blocks of near ones (by the signs of fixed projections); each block has its own
minimum spanning tree and is walked from its root.

Rows are dealt into blocks that one task holds (``ROWS`` at most); all anchor blocks are sent past every one of them. What is asked for is first each
anchor's best rows of its label, later rows of other labels within windows below the positives' scores: a task reports its own best ones and Spark takes
the best of all. Nothing is paired but anchors with rows, nothing is broadcast and nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clanweave.llm.common import map_arrow, mix
from clanweave.session import materialize

#: Rows of a block that a task holds, anchors of a tree.
ROWS, TREE = 1 << 15, 512
#: Components are multiplied by this and rounded down.
SCALE = 256
_ROW = "vec_id long, label long, key long, vector array<double>"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector (whole numbers as doubles) and key (a hash of these) of the rows that take part, once each."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(finite)
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("double"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("vector")).distinct().select("vec_id", "label", F.xxhash64("vec_id", "label", "vector").alias("key"), "vector")


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as rows of equal width; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max([*sizes.tolist(), width or 0, 1])
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree, each node followed by its subtree: indices, position of the parent in that order (root: -1), length of the edge."""
    n = len(points)
    near, by, children = np.full(n, np.inf), np.full(n, -1), [[] for _ in range(n)]
    done, now = np.zeros(n, bool), 0
    near[0] = 0.0
    for _ in range(n - 1):
        done[now] = True
        away = np.sqrt(((points - points[now]) ** 2).sum(axis=1))
        closer = (away < near) & ~done
        near[closer], by[closer] = away[closer], now
        now = int(np.argmin(np.where(done, np.inf, near)))
        children[by[now]].append(now)
    order, place, open_ = [], np.full(n, -1), [0]
    while open_:
        now = open_.pop()
        place[now] = len(order)
        order.append(now)
        open_ += children[now]
    order = np.array(order)
    return order, np.where(by[order] < 0, -1, place[by[order]]), near[order]


def _signs(vectors: np.ndarray) -> np.ndarray:
    """A number made of the signs of eight fixed projections, of neighbouring codes where vectors are near."""
    dims = np.arange(vectors.shape[1])
    out = np.zeros(len(vectors), np.int64)
    for k in range(8):
        weights = mix(dims, seed=k).view(np.int64) / 2.0**63
        out = out * 2 + (vectors @ weights > 0)
    return out


_TREE = {"tree": "long", "vec_id": "array<long>", "label": "array<long>", "key": "array<long>", "parent": "array<long>", "edge": "array<double>", "width": "long", "vector": "array<double>"}


def anchor_trees(anchors: DataFrame, most: int = TREE) -> DataFrame:
    """One row per tree of at most ``most`` near anchors: anchors in the order of the tree, parents' positions and edge lengths."""
    kind = ", ".join(f"{n} {t}" for n, t in _TREE.items())

    def keyed(batches) -> Iterator[dict]:
        for batch in batches:
            code = _signs(_matrix(batch.column("vector")))
            yield {"code": code, **{n: batch.column(n) for n in ("vec_id", "label", "key", "vector")}}

    def grow(batches) -> Iterator[dict]:
        held, size, made = [], 0, 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= most:
                every = pa.Table.from_batches(held)
                yield tree(every.slice(0, most), made)
                held, size, made = every.slice(most).to_batches(), size - most, made + 1
        if size:
            yield tree(pa.Table.from_batches(held), made)

    def tree(rows: pa.Table, number: int) -> dict:
        points = _matrix(rows.column("vector"))
        order, parent, length = spanning_tree(points)
        one = {n: rows.column(n).to_numpy()[order] for n in ("vec_id", "label", "key")} | {"parent": parent, "edge": length, "vector": points[order].ravel()}
        return {"tree": [number], "width": [points.shape[1]]} | {n: [x] for n, x in one.items()}

    placed = map_arrow(anchors, "code long, " + _ROW, keyed)
    placed = placed.repartitionByRange(F.col("code"), F.col("vec_id")).sortWithinPartitions("code", "vec_id").select("vec_id", "label", "key", "vector")
    return map_arrow(placed, kind, grow).withColumn("tree", F.col("tree") + F.shiftleft(F.spark_partition_id().cast("long"), 32))


class Block:
    """Rows that a task holds, walked past by trees of anchors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.norms = np.sqrt((vectors**2).sum(axis=1))
        self.scored = 0

    def scores(self, tree: dict, asked) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor of the tree: its position, the rows whose score may be asked for, and their scores.

        ``asked(position)`` gives the candidate rows (mask) and the range of scores that are asked for. Rows out of range are not scored.
        """
        points = tree["points"]
        self.vectors, points = _same_width(self.vectors, points)
        last = {}  # position: (centre of the range, half its width), of those that have children to come
        waiting = np.bincount(tree["parent"][tree["parent"] >= 0], minlength=len(points))
        for k, parent in enumerate(tree["parent"]):
            mine, low, high = asked(k)
            if parent < 0:
                centre, half = np.zeros(len(self.ids)), np.full(len(self.ids), np.inf)
            else:
                centre, half = last[parent]
                waiting[parent] -= 1
                if not waiting[parent]:
                    del last[parent]
                # A part in 2^40 more than the bound covers the rounding of norms, distances and sums.
                half = half + (tree["edge"][k] * self.norms) * (1 + 2.0**-40) + 2.0**-20
                centre = centre.copy()
            if parent < 0:
                near = np.flatnonzero(mine) if not waiting[k] else np.arange(len(self.ids))
            else:
                near = np.flatnonzero(mine & (centre + half >= low) & (centre - half <= high))
            exact = self.vectors[near] @ points[k] if len(near) < len(self.ids) else self.vectors @ points[k]
            centre[near], half[near] = exact, 0.0
            self.scored += len(near)
            if waiting[k]:
                last[k] = centre, half
            yield k, near, exact


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` highest scores, ties by smaller id."""
    if len(scores) > 4 * most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        few = np.flatnonzero(scores >= least)
        return few[np.lexsort((ids[few], -scores[few]))[:most]]
    return np.lexsort((ids, -scores))[:most]


def _walk(rows: DataFrame, trees: DataFrame, kind: str, visit) -> DataFrame:
    """``visit(block, tree)`` for every block of rows and every tree, in the task that holds the block."""
    spark = rows.sparkSession
    blocks = max(1, -(-rows.count() // ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = _TREE | {n: "array<array<double>>" for n in trees.columns if n not in _TREE}
    held = rows.select(F.pmod("key", F.lit(blocks)).alias("block"), F.lit(0).alias("sent"), F.array("vec_id").alias("vec_id"), F.array("label").alias("label"), "vector")
    held = held.select("block", "sent", *[F.col(n) if n in held.columns else F.lit(None).cast(t).alias(n) for n, t in columns.items()])
    sent = trees.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("sent"), *columns)
    dealt = held.unionByName(sent).repartition(blocks, "block").sortWithinPartitions("block", "sent")

    def run(batches) -> Iterator[dict]:
        at, parts, block = None, [], None
        for batch in batches:
            of, passing = batch.column("block").to_numpy(), batch.column("sent").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (passing[1:] != passing[:-1])])
            for start, end in zip(cuts, [*cuts[1:], len(of)], strict=True):
                part = batch.slice(start, end - start)
                if of[start] != at:
                    at, parts, block = of[start], [], None
                if not passing[start]:
                    parts.append((part.column("vec_id").flatten(), part.column("label").flatten(), part.column("vector")))
                    continue
                if block is None and parts:
                    width = max(_matrix(v).shape[1] for _, _, v in parts)
                    vectors = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (_matrix(v) for _, _, v in parts)])
                    block = Block(np.concatenate([i.to_numpy() for i, _, _ in parts]), np.concatenate([x.to_numpy() for _, x, _ in parts]), vectors)
                    parts = []
                if block is not None:
                    for row in part.to_pylist():
                        tree = {n: np.array(row[n]) for n in ("vec_id", "label", "key", "parent", "edge")}
                        tree["points"] = np.array(row["vector"]).reshape(len(tree["vec_id"]), row["width"])
                        yield visit(block, tree | {n: row[n] for n in columns if n not in tree and n != "vector"})

    return map_arrow(dealt, kind, run)


def positives(rows: DataFrame, trees: DataFrame, most: int = 5) -> DataFrame:
    """anchor (its key), anchor_id, positive_id, positive_score: the ``most`` highest-scoring other rows of each anchor's label."""

    def visit(block: Block, tree: dict) -> dict:
        out = ([], [], [], [])

        def asked(k: int):
            return (block.labels == tree["label"][k]) & (block.ids != tree["vec_id"][k]), best[k], np.inf

        # The lowest score that counts is known in advance from as many rows of the label as are asked for, whichever they are.
        best = np.full(len(tree["label"]), -np.inf)
        for label in np.unique(tree["label"]):
            some = np.flatnonzero(block.labels == label)[: 8 * most]
            own = np.flatnonzero(tree["label"] == label)
            a, b = _same_width(block.vectors[some], tree["points"][own])
            known = np.where(block.ids[some][:, None] == tree["vec_id"][own][None, :], -np.inf, a @ b.T)
            if len(some) >= most:
                best[own] = np.sort(known, axis=0)[len(some) - most]
        for k, near, scores in block.scores(tree, asked):
            mine = (block.labels[near] == tree["label"][k]) & (block.ids[near] != tree["vec_id"][k])
            near, scores = near[mine], scores[mine]
            top = _best(scores, block.ids[near], most)
            out[0].append(np.full(len(top), tree["key"][k]))
            out[1].append(np.full(len(top), tree["vec_id"][k]))
            out[2].append(block.ids[near[top]])
            out[3].append(scores[top].astype(np.int64))
        return dict(zip(("anchor", "anchor_id", "positive_id", "positive_score"), map(np.concatenate, out), strict=True))

    found = _walk(rows, trees, "anchor long, anchor_id long, positive_id long, positive_score long", visit)
    return _first(found, ["anchor", "anchor_id"], "positive_score", "positive_id", most).select("anchor", "anchor_id", F.inline("first"))


def _first(found: DataFrame, by: list[str], score: str, name: str, most: int) -> DataFrame:
    """Per key the ``most`` first rows by descending score and ascending name; blocks have kept as many at most."""
    listed = found.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("s"), F.col(name).alias("n")))).alias("l"))
    first = F.transform(F.slice("l", 1, most), lambda x: F.struct(x["n"].alias(name), (-x["s"]).alias(score)))
    return listed.select(*by, first.alias("first"))


def negatives(rows: DataFrame, trees: DataFrame, found: DataFrame, most: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """To each positive the ``most`` first rows of another label whose score is low to high per cent of the positive's, as ``first``."""
    windows = found.groupBy("anchor").agg(F.sort_array(F.collect_set(F.col("positive_score").cast("double"))).alias("s"))  # as few as positives
    of = trees.select("tree", F.posexplode("key").alias("at", "anchor")).join(windows, "anchor", "left")
    of = of.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("s", F.array().cast("array<double>")).alias("s")))).alias("w"))
    asked_trees = materialize(trees.join(of.select("tree", F.col("w.s").alias("windows")), "tree"), "windows")

    def visit(block: Block, tree: dict) -> dict:
        out, limits = ([], [], [], []), []
        for scores in tree["windows"]:
            # Whole scores n with low p <= 100 n <= high p; none if p is negative.
            limits.append([(p, -(-low * int(p) // 100), high * int(p) // 100) for p in scores])

        def asked(k: int):
            spans = [(a, b) for _, a, b in limits[k] if a <= b]
            if not spans:
                return np.zeros(len(block.ids), bool), np.inf, -np.inf
            return block.labels != tree["label"][k], min(a for a, _ in spans), max(b for _, b in spans)

        for k, near, scores in block.scores(tree, asked):
            other = block.labels[near] != tree["label"][k]
            near, scores = near[other], scores[other]
            for p, a, b in limits[k]:
                within = np.flatnonzero((scores >= a) & (scores <= b))
                top = within[_best(scores[within], block.ids[near[within]], most)]
                out[0].append(np.full(len(top), tree["key"][k]))
                out[1].append(np.full(len(top), int(p)))
                out[2].append(block.ids[near[top]])
                out[3].append(scores[top].astype(np.int64))
        names = ("anchor", "positive_score", "negative_id", "negative_score")
        return dict(zip(names, [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out], strict=True))

    mined = _walk(rows, asked_trees, "anchor long, positive_score long, negative_id long, negative_score long", visit)
    first = _first(mined, ["anchor", "positive_score"], "negative_score", "negative_id", most)
    return found.join(first, ["anchor", "positive_score"])


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, tree: int = TREE) -> DataFrame:
    """Hard negatives of the rows (vec_id, label, embedding) for which ``is_anchor`` holds.

    Rows with a null vec_id, label, vector or component or a non-finite component take no part. A component x counts as floor(256 x); a row's score is
    its inner product with the anchor (a shorter vector ends in zeros; sums must stay below 2^53). Higher scores come first, ties by smaller vec_id.
    Positives of an anchor are its first ``n_positives`` rows of the same label and another vec_id; for each of them the first ``n_negatives`` rows of
    another label with a score of ``low`` to ``high`` per cent of the positive's are returned: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score. A negative positive score has an empty range. Rows that repeat in whole count once; of rows that share a vec_id but
    differ, each is a row (and an anchor) of its own. No row, no anchor or no candidate: no result. Other columns are not read.
    """
    every = materialize(usable(rows), "vectors")
    trees = materialize(anchor_trees(every.where(is_anchor), tree), "trees")
    found = materialize(positives(every, trees, n_positives), "positives")
    done = negatives(every, trees, found, n_negatives, low, high)
    listed = done.select("anchor_id", "positive_id", "positive_score", F.posexplode("first").alias("at", "f"))
    return listed.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.negative_id").alias("negative_id"), "positive_score", F.col("f.negative_score").alias("negative_score"))
