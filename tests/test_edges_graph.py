import random

import pytest
from pyspark.sql import functions as F

from clanweave.operators import edges as E
from clanweave.operators import graph as G

EDGE = "src string, dst string, pid double, alen int, bitscore double, src_len int, dst_len int"


def test_canonical_and_best(spark, rows):
    e = spark.createDataFrame([("B", "A", 1.0, 1, 50.0, 7, 9), ("A", "B", 1.0, 1, 60.0, 9, 7), ("A", "A", 1.0, 1, 5.0, 9, 9)], EDGE)
    best = E.best_edge_per_pair(E.canonicalize_edges(e))
    assert rows(best, "src", "dst", "bitscore", "src_len", "dst_len") == [("A", "A", 5.0, 9, 9), ("A", "B", 60.0, 9, 7)]
    assert E.drop_self_edges(best).count() == 1
    again = E.canonicalize_edges(E.canonicalize_edges(e))
    assert rows(again) == rows(E.canonicalize_edges(e))


def test_demultiplex(spark, rows):
    e = spark.createDataFrame([("R", "R", 1.0, 1, 5.0, 1, 1), ("R", "S", 1.0, 1, 6.0, 1, 1), ("R", "Q", 1.0, 1, 6.0, 1, 1)], EDGE)
    m = spark.createDataFrame([("R", "R"), ("R", "x"), ("R", "y"), ("S", "S")], "rep string, member string")
    want = [("R", "S"), ("R", "x"), ("R", "y"), ("x", "S"), ("x", "y"), ("y", "S")]
    assert rows(E.demultiplex(e, m, m), "src", "dst") == want
    assert E.demultiplex_counts(e, m).agg(F.sum("n_pairs")).first()[0] == len(want)
    degrees = dict(rows(E.demultiplex_degrees(e, m)))
    count = {}
    for a, b in want:
        count[a] = count.get(a, 0) + 1
        count[b] = count.get(b, 0) + 1
    assert degrees == count
    only = spark.createDataFrame([("R",), ("R",)], "rep string")
    assert rows(E.demultiplex(e, m, only), "src", "dst") == [("R", "x"), ("R", "y"), ("x", "y")]
    ids = spark.createDataFrame([("ABCDEF", "c"), ("ABCDEF:1:2", "c"), ("ABCDEF:10:20", "c"), (None, "c")], "id string, cluster string")
    assert rows(E.other_cluster_ids(ids), "id") == [("ABCDEF:10:20",), (None,)]


def test_convergence(spark):
    s = lambda n: spark.range(n)
    none = spark.createDataFrame([], EDGE)
    three = spark.createDataFrame([("A", "B", 1.0, 1, 1.0, 1, 1)] * 3, EDGE)
    assert E.convergence_ratio(three, s(3)).first()["ratio"] == 1.0
    assert E.convergence_ratio(none, s(1)).first()["ratio"] == 1.0
    assert E.convergence_ratio(none, s(4)).first()["ratio"] == 0.0


def test_neighborhood_connectivity(spark, rows):
    rng = random.Random(4)
    pairs = [(rng.choice("ABCDEFGH"), rng.choice("ABCDEFGHIJK")) for _ in range(40)] + [("A", "A"), ("Z", "A"), ("Z", "A")]
    around = {}
    for a, b in pairs:
        around.setdefault(a, []).append(b)
        around.setdefault(b, []).append(a)
    want = [(n, len(o), sum(len(around[x]) for x in o) * 100 // len(o) / 100) for n, o in sorted(around.items())]
    e = spark.createDataFrame(pairs + [(None, "A"), ("B", None)], "src string, dst string")
    assert rows(E.neighborhood_connectivity(e)) == want
    assert E.neighborhood_connectivity(e.limit(0)).count() == 0


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["random", "chain", "hub", "none"])
def test_components(spark, rows, shape):
    rng = random.Random(1)
    nodes = [f"n{i:03d}" for i in range(120)]
    pairs = {
        "random": [tuple(rng.sample(nodes, 2)) for _ in range(70)],
        "chain": list(zip(nodes[:60], nodes[1:61])),
        "hub": [(nodes[77], n) for n in nodes[:100] if n != nodes[77]],
        "none": [],
    }[shape]
    e = spark.createDataFrame([(a, b, 1.0, 1, 1.0, 1, 1) for a, b in pairs] + [(nodes[0], nodes[0], 1.0, 1, 1.0, 1, 1)], EDGE)
    n = spark.createDataFrame([(x,) for x in nodes], "node string")
    assert dict(rows(G.connected_components(n, e))) == union_find(nodes, pairs)
    linked = {x for p in pairs for x in p}
    assert {r[0] for r in rows(G.connected_components(n, e, include_singletons=False), "node")} == linked


def test_numbering_and_colors(spark, rows):
    comp = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("d", "c"), ("f", "f"), ("g", "g")], "node string, component string")
    meta = spark.createDataFrame([(x, x) for x in "abcdfg"] + [("g", "g1"), ("g", "g2")], "node_id string, member string")
    got = rows(G.number_clusters(comp, meta), "component", "seq_number", "node_number", "singleton_number")
    assert got == [("a", 2, 1, None), ("c", 3, 2, None), ("f", 4, 3, 1), ("g", 1, 4, None)]
    pal = spark.createDataFrame([(1, "#1"), (2, "#2"), (3, "#3")], "cluster int, color string")
    c = G.cluster_color(spark.createDataFrame([(2,), (3,), (4,), (8,)], "n int"), "n", pal)
    assert rows(c) == [(2, "#2"), (3, "#3"), (4, "#2"), (8, "#3")]


def test_representative_nodes(spark, rows):
    m = spark.createDataFrame([("R", "R"), ("R", "x")], "rep string, member string")
    a = spark.createDataFrame([("R", "EC", "None"), ("x", "EC", "1.1"), ("R", "GN", "None"), ("x", "GN", "None"), ("R", "O", "q"), ("x", "O", "q")], "node_id string, name string, value string")
    got = rows(G.representative_nodes(m, a))
    assert got == [("R", "ACC", "R"), ("R", "ACC", "x"), ("R", "Cluster Size", "2"), ("R", "EC", "1.1"), ("R", "GN", None), ("R", "O", "q")]


def test_guards(spark):
    e = spark.createDataFrame([("a", "b", 1.0, 1, 1.0, 1, 1)] * 3, EDGE)
    G.check_edge_limit(e)
    G.check_edge_limit(e, 3)
    with pytest.raises(ValueError):
        G.check_edge_limit(e, 2)
    with pytest.raises(ValueError):
        G.cluster_count(spark.createDataFrame([("a", "a"), ("b", "b")], "rep string, member string"), 1)


def test_family_colors_are_deterministic(spark, rows):
    f = spark.createDataFrame([("PF2-PF1",), ("PF3",)], "family string")
    pal = spark.createDataFrame([(1, "#1"), (2, "#2")], "cluster int, color string")
    assert rows(G.family_color(f, pal), "family", "part", "color") == [("PF2-PF1", "PF1", "#1"), ("PF2-PF1", "PF2", "#2"), ("PF3", "PF3", "#1")]
