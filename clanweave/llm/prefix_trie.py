"""Prefix trie of conversations, built as a z-fast trie.

A conversation is a sequence of turns; the key of a prefix is a 128-bit sum of hashes of its turns and their places, so that keys are running sums. A
compacted node stands for an edge (a, b]: the depths after its parent's, up to its own. It is filed under the key at its handle, the
2-fattest depth of the edge (that divisible by the largest power of two). A conversation finds the deepest node whose handle is one of
its prefixes by fat binary search: it probes the 2-fattest depth of the range that is left and goes on behind the node's edge if it is there and before
that depth if not, at most log2(longest) + 1 probes, each an equi-join. Nodes are also filed under their first depth, where
the edge is found that is left before its handle. The exact depth of exit follows from comparing keys along that edge.

Conversations are inserted in batches. In each round all conversations that are not in the trie yet are located; of those that leave it at one place
with the same next turn one, drawn by hash, is inserted with all its turns as one path, the edge that it leaves is split, and conversations that end
within the trie are noted there. As a path is drawn at random, every round leaves half of a subtree or less on average: O(log n) rounds. At the end edges are
expanded: each depth of a path is a node. Figures of subtrees are added up from the paths of the last round to those of the first and then
along each path (``ordered_scan``: a path of any length is worked on by many tasks).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clanweave.functions.ordered import ordered_scan, rank_within
from clanweave.llm.common import map_arrow
from clanweave.session import materialize

#: Ids that are written into one piece of a list before pieces are put together.
PIECE = 1 << 16
_LOW = (1 << 32) - 1


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), two hashes of role and text, and bytes of the text; texts themselves are not shuffled.

    Turns are in order of ``turn`` (null first), those of one number in order of their hashes.
    """
    role, text = (F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(text, role, F.lit(1)).alias("b"), F.octet_length(text).cast("long").alias("bytes"),
    )
    placed = rank_within(turns, ["conv_id"], [F.asc_nulls_first("turn"), "a", "b"], "place")
    return placed.select("conv_id", "place", "a", "b", "bytes")


def with_shared_starts(turns: DataFrame, base: Column, held: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``held`` (at most ``most``) turns of another one (``base``) and go on after as many of their own.

    ``base`` and ``held`` are made of conv_id. Returns (conv_id) and (conv_id, depth, a, b, bytes).
    """
    lengths = materialize(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "lengths")
    known = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = lengths.select("conv_id", base.alias("base"), held.alias("held")).join(known, "base", "left")
    convs = convs.withColumn("given", F.least("held", F.coalesce("base_n", F.lit(0)))).select("conv_id", "base", "held", "given")
    starts = turns.where(F.col("place") <= most).withColumnRenamed("conv_id", "base").join(convs, "base").where(F.col("place") <= F.col("held"))
    own = turns.join(convs, "conv_id").where(F.col("place") > F.col("held"))
    rebuilt = starts.select("conv_id", F.col("place").alias("depth"), "a", "b", "bytes")
    rebuilt = rebuilt.unionByName(own.select("conv_id", (F.col("given") + F.col("place") - F.col("held")).alias("depth"), "a", "b", "bytes"))
    return lengths.select("conv_id"), rebuilt


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, key (k1, k2) of the prefix of that depth, bytes of its last text and of all its texts."""
    first, second = F.xxhash64("a", "depth"), F.xxhash64("b", "depth", F.lit(1))
    # Parts of 32 bits, whose sums hold 2^31 turns.
    parts = {"s0": first.bitwiseAND(F.lit(_LOW)), "s1": F.shiftrightunsigned(first, 32), "s2": second.bitwiseAND(F.lit(_LOW)), "s3": F.shiftrightunsigned(second, 32)}
    summed = ordered_scan(turns, ["conv_id"], ["depth"], sums=parts | {"upto": F.col("bytes")})
    return summed.select("conv_id", "depth", F.xxhash64("s0", "s1").alias("k1"), F.xxhash64("s2", "s3").alias("k2"), "bytes", "upto")


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the largest power of two divides."""
    return F.expr(f"shiftleft(-1L, length(bin({low} ^ {high})) - 1) & {high}")


def _edges(points: DataFrame) -> DataFrame:
    """Compacted nodes (rep, a, b) between the points of each path."""
    after = F.lead("depth").over(Window.partitionBy("rep").orderBy("depth"))
    return points.distinct().select("rep", F.col("depth").alias("a"), after.alias("b")).where("b is not null")


def _filed(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """The dictionary: key of the handle and of the first depth of each edge -> the edge."""
    depths = F.array_distinct(F.array(fattest("a", "b"), F.col("a") + 1))
    listed = edges.select(F.col("rep").alias("conv"), "a", "b", F.explode(depths).alias("depth"))
    found = listed.join(keys, ["conv", "depth"])
    return found.select("depth", "k1", "k2", F.col("conv").alias("e_rep"), F.col("a").alias("e_a"), F.col("b").alias("e_b"))


def _probe(state: DataFrame, at: Column, keys: DataFrame, filed: DataFrame) -> DataFrame:
    """``state`` with the edge (e_rep, e_a, e_b; null if there is none) filed under each conversation's prefix of depth ``at``."""
    asked = state.withColumn("depth", at).join(keys, ["conv", "depth"], "left")
    # Those that ask for nothing get keys of their own, so that they are not dealt to one task.
    asked = asked.withColumn("k1", F.coalesce("k1", F.col("conv"))).withColumn("k2", F.coalesce("k2", F.lit(0))).withColumn("depth", F.coalesce("depth", F.lit(0)))
    return asked.join(filed, ["depth", "k1", "k2"], "left").drop("k1", "k2")


def locate(active: DataFrame, filed: DataFrame, keys: DataFrame, longest: int) -> DataFrame:
    """(conv, length, rep, x): the path on which a conversation leaves the trie, and the depth up to which it is in the trie.

    ``active`` has (conv, length, low); the conversation is known to reach ``low``, the end of a node.
    """
    none = F.lit(None).cast("long")
    state = active.select("conv", "length", F.col("low").alias("lo"), F.col("length").alias("hi"), none.alias("rep"), none.alias("b"), F.col("low").alias("matched"))
    for _ in range(int(longest).bit_length() + 1):
        state = _probe(state, F.when(F.col("lo") < F.col("hi"), fattest("lo", "hi")), keys, filed)
        hit, asked = F.col("e_rep").isNotNull(), F.col("lo") < F.col("hi")
        state = state.select(
            "conv", "length",
            F.when(hit, F.least("e_b", "hi")).otherwise(F.col("lo")).alias("lo"), F.when(asked & ~hit, F.col("depth") - 1).otherwise(F.col("hi")).alias("hi"),
            F.coalesce("e_rep", "rep").alias("rep"), F.coalesce("e_b", "b").alias("b"), F.when(hit, F.col("depth")).otherwise(F.col("matched")).alias("matched"),
        )
    # The edge may be left before its handle: it is found by its first depth.
    state = _probe(state, F.when(F.col("lo") < F.col("length"), F.col("lo") + 1), keys, filed)
    hit = F.col("e_rep").isNotNull()
    state = state.select(
        "conv", "length", F.coalesce("e_rep", "rep").alias("rep"), F.least(F.coalesce("e_b", "b"), "length").alias("end"),
        F.when(hit, F.greatest("depth", "matched")).otherwise(F.col("matched")).alias("matched"),
    )
    state = materialize(state, "exits")
    open_ = state.where("matched < end")
    mine = open_.join(keys, "conv").where("depth > matched and depth <= end").select("conv", F.col("rep"), "depth", "k1", "k2")
    theirs = keys.select(F.col("conv").alias("rep"), "depth", F.col("k1").alias("r1"), F.col("k2").alias("r2"))
    shared = mine.join(theirs, ["rep", "depth"]).where("k1 = r1 and k2 = r2").groupBy("conv").agg(F.max("depth").alias("shared"))
    return state.join(shared, "conv", "left").select("conv", "length", "rep", F.coalesce("shared", "matched").alias("x"))


class Trie:
    """``rounds``: the paths (conv, length, rep, x) inserted in each round; ``ends``: (conv, rep, depth) of every distinct conversation."""

    def __init__(self, lengths: DataFrame, keys: DataFrame):
        """``lengths``: (conv, length) of the distinct conversations with turns; ``keys``: (conv, depth, k1, k2) of their prefixes."""
        longest = lengths.agg(F.max("length")).first()[0] or 0
        active = lengths.select("conv", "length", F.lit(0).cast("long").alias("low"))
        self.rounds, points, ends = [], [], []
        while not active.isEmpty():
            if points:
                filed = materialize(_filed(_edges(reduce(DataFrame.unionByName, points)), keys), "filed")
                found = materialize(locate(active, filed, keys, longest), "located")
            else:
                found = active.select("conv", "length", F.lit(None).cast("long").alias("rep"), F.col("low").alias("x"))
            here = found.where("x = length")
            ends.append(here.select("conv", "rep", F.col("x").alias("depth")))
            on = found.where("x < length")
            # (a conversation's hash draws it; its next turn is part of the key at x + 1)
            asked = on.withColumn("depth", F.col("x") + 1).join(keys, ["conv", "depth"])
            drawn = asked.groupBy("depth", "k1", "k2").agg(F.min(F.struct(F.xxhash64("conv").alias("h"), "conv", "length", "rep", "x")).alias("d"))
            paths = materialize(drawn.select("d.conv", "d.length", "d.rep", "d.x"), "paths")
            self.rounds.append(paths)
            ends.append(paths.select("conv", F.col("conv").alias("rep"), F.col("length").alias("depth")))
            own = paths.select(F.col("conv").alias("rep"), F.explode(F.array("x", "length")).alias("depth"))
            points += [own, found.where("rep is not null").select("rep", F.col("x").alias("depth")).distinct()]
            active = materialize(on.join(paths.select("conv"), "conv", "left_anti").select("conv", "length", F.col("x").alias("low")), "active")
        self.ends = reduce(DataFrame.unionByName, ends) if ends else None


def _id_lists(rows: DataFrame) -> DataFrame:
    """rep, depth and the SHA-256 of the ids (conv_id, ascending, comma-joined) of each; ids are joined before the shuffle, a list is never held as rows."""

    def pieces(batches) -> Iterator[dict]:
        at, ids = None, []

        def piece() -> dict:
            return {"rep": [at[0]], "depth": [at[1]], "first": [ids[0]], "ids": [",".join(map(str, ids))]}

        for batch in batches:
            for rep, depth, conv in zip(*(batch.column(n).to_pylist() for n in ("rep", "depth", "conv_id")), strict=True):
                if at != (rep, depth) or len(ids) == PIECE:
                    if ids:
                        yield piece()
                    at, ids = (rep, depth), []
                ids.append(conv)
        if ids:
            yield piece()

    def digest(batches) -> Iterator[dict]:
        at, state = None, None
        for batch in batches:
            done = ([], [], [])
            for rep, depth, text in zip(*(batch.column(n).to_pylist() for n in ("rep", "depth", "ids")), strict=True):
                if at != (rep, depth):
                    if at is not None:
                        for out, x in zip(done, (*at, state.hexdigest()), strict=True):
                            out.append(x)
                    at, state = (rep, depth), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield dict(zip(("rep", "depth", "sha"), done, strict=True))
        if at is not None:
            yield {"rep": [at[0]], "depth": [at[1]], "sha": [state.hexdigest()]}

    placed = rows.repartitionByRange("rep", "depth", "conv_id").sortWithinPartitions("rep", "depth", "conv_id")
    joined = map_arrow(placed, "rep long, depth long, first long, ids string", pieces)
    dealt = joined.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first")
    return map_arrow(dealt, "rep long, depth long, sha string", digest)


def _upward(trie: Trie, ends: DataFrame, upto: DataFrame) -> DataFrame:
    """What is hung on each place (rep, depth): n, least and total of members, leaves and bytes (of nodes) of subtrees, number of subtrees.

    ``ends`` has (rep, depth, n, least, total) and ``upto`` (conv, depth, upto). Places on the root have a null rep.
    """
    hung = [ends.select("rep", "depth", "n", "least", "total", *[F.lit(0).cast("long").alias(c) for c in ("leaves", "bytes", "subtrees")])]
    for paths in reversed(trie.rounds):
        on = reduce(DataFrame.unionByName, hung).join(paths.select(F.col("conv").alias("rep"), "length", F.col("rep").alias("up"), "x"), "rep")
        grouped = on.groupBy("rep", "length", "up", "x").agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("total").alias("total"), F.sum("leaves").alias("leaves"), F.sum("bytes").alias("bytes"),
            F.max(((F.col("depth") == F.col("length")) & (F.col("subtrees") > 0)).cast("long")).alias("goes_on"),
        )
        at = lambda c, n: upto.select(F.col("conv").alias("rep"), F.col("depth").alias(c), F.col("upto").alias(n))
        sized = grouped.join(at("length", "all"), ["rep", "length"]).join(at("x", "above"), ["rep", "x"], "left")
        own = sized.select(
            F.col("up").alias("rep"), F.col("x").alias("depth"), "n", "least", "total", (F.col("leaves") + 1 - F.col("goes_on")).alias("leaves"),
            (F.col("bytes") + F.col("all") - F.coalesce("above", F.lit(0))).alias("bytes"), F.lit(1).cast("long").alias("subtrees"),
        )
        own = own.groupBy("rep", "depth").agg(*[(F.min if c == "least" else F.sum)(c).alias(c) for c in ("n", "least", "total", "leaves", "bytes", "subtrees")])
        hung.append(materialize(own, "hung"))
    every = reduce(DataFrame.unionByName, hung)
    return every.groupBy("rep", "depth").agg(*[(F.min if c == "least" else F.sum)(c).alias(c) for c in ("n", "least", "total", "leaves", "bytes", "subtrees")])


def nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Every node of the trie of the conversations ``convs`` (conv_id) with turns (conv_id, depth from 1 without gaps, a, b, bytes).

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256; the root has depth 0
    and no parent. A node's members are the conversations that begin with its turns. ``saved_tokens`` is the sum over a node's subtree, itself
    included, of members but one times the bytes of the last text. ``ends_sha256`` is that of the members that end there, as decimal ids,
    ascending, comma-joined. Without conversations there is no node. Ids are not null and distinct.
    """
    every = materialize(prefixes(turns), "prefixes")
    last = every.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2", "upto")).alias("l")).select("conv_id", "l.*")
    last = materialize(last, "last")
    # Equal conversations are one path, named by the smallest id.
    same = materialize(last.groupBy("depth", "k1", "k2", "upto").agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n")), "distinct")
    own = materialize(every.withColumnRenamed("conv_id", "conv").join(same.select("conv"), "conv", "left_semi"), "paths-keys")
    trie = Trie(same.select("conv", F.col("depth").alias("length")), own.select("conv", "depth", "k1", "k2"))
    turnless = convs.join(last.select("conv_id"), "conv_id", "left_anti")
    at_root = _id_lists(turnless.select(F.lit(0).cast("long").alias("rep"), F.lit(0).cast("long").alias("depth"), "conv_id")).select("depth", "sha")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    long = lambda x: F.lit(x).cast("long")
    if trie.ends is None:
        out = root.select("conv_id", long(0).alias("depth"), "n_convs", long(0).alias("n_children"), long(1).alias("n_leaves"), long(0).alias("saved_tokens")).join(at_root, "depth", "left")
        return out.select("conv_id", "depth", long(None).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", empty).alias("ends_sha256"))
    ends = materialize(trie.ends.join(same.select("conv", "n", "upto", "depth").withColumnRenamed("depth", "length"), "conv"), "ends")
    placed = ends.groupBy("rep", "depth").agg(F.sum("n").alias("n"), F.min("conv").alias("least"), F.sum(F.col("n") * F.col("upto")).alias("total"))
    hung = materialize(_upward(trie, placed, own.select("conv", "depth", "upto")), "hung-all")

    # Edges are expanded: every depth of a path beyond its start is a node.
    paths = reduce(DataFrame.unionByName, trie.rounds).withColumnRenamed("rep", "up")
    sized = paths.join(same.select("conv", "upto").withColumnRenamed("upto", "all"), "conv")
    node = own.select("conv", "depth", "bytes", "upto").join(sized, "conv").where("depth > x").withColumnRenamed("conv", "rep")
    own_hung = hung.where("rep is not null").withColumnRenamed("bytes", "below")
    node = node.join(own_hung, ["rep", "depth"], "left")
    children = F.coalesce("subtrees", long(0)) + (F.col("depth") < F.col("length")).cast("long")
    leaf = (children == 0).cast("long")
    scanned = ordered_scan(
        node.withColumn("n_children", children), ["rep"], [F.desc("depth")],
        sums={"n_convs": F.coalesce("n", long(0)), "sum": F.coalesce("total", long(0)), "n_leaves": F.coalesce("leaves", long(0)) + leaf, "hung": F.coalesce("below", long(0))},
        mins={"conv_id": F.col("least")},
    )
    before = F.col("upto") - F.col("bytes")
    saved = (F.col("sum") - F.col("n_convs") * before) - (F.col("all") - before + F.col("hung"))
    starts = F.col("depth") == F.col("x") + 1
    scanned = scanned.select(
        "rep", "depth", "conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
        F.when(starts, F.col("up")).otherwise(F.col("rep")).alias("above"), (F.col("depth") - 1).alias("above_depth"),
    )
    scanned = materialize(scanned, "nodes")
    members = last.join(same.select("conv", "depth", "k1", "k2"), ["depth", "k1", "k2"]).select("conv", "conv_id")
    lists = _id_lists(members.join(ends.select("conv", "rep", "depth"), "conv").select("rep", "depth", "conv_id"))
    parents = scanned.select(F.col("rep").alias("above"), F.col("depth").alias("above_depth"), F.col("conv_id").alias("parent_conv_id"))
    out = scanned.join(parents, ["above", "above_depth"], "left").join(lists, ["rep", "depth"], "left")
    # A node of depth 1 hangs on the root, whose smallest member is that of all.
    least = convs.agg(F.min("conv_id")).first()[0]
    parent = F.when(F.col("depth") == 1, F.lit(least).cast("long")).otherwise(F.col("parent_conv_id"))
    out = out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", empty).alias("ends_sha256"))
    on_root = hung.where("rep is null").agg(F.sum("subtrees").alias("n_children"), F.sum("leaves").alias("n_leaves"), (F.sum("total") - F.sum("bytes")).alias("saved_tokens"))
    top = root.join(on_root, F.lit(True)).withColumn("depth", long(0)).join(at_root, "depth", "left")
    top = top.select("conv_id", "depth", long(None).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", empty).alias("ends_sha256"))
    return out.unionByName(top)


def rebuilt_trie(conversations: DataFrame, group: int = 5, starts: int = 9) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: each one's first h turns are those of the first of its ``group`` ids, h = crc32(decimal id) mod ``starts``.

    A null role or text is empty; rows without a conv_id take no part; turns of one number are in the order of their hashes; repeated rows are turns of
    their own. Other columns are not read. A missing or shorter conversation gives the turns it has.
    """
    c = F.col("conv_id")
    turns = materialize(ordered_turns(conversations), "turns")
    held = F.crc32(c.cast("string").cast("binary")) % starts
    convs, rebuilt = with_shared_starts(turns, c - c % group, held, starts - 1)
    return nodes(convs, rebuilt)
