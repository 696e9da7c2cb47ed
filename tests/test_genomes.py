import random

import pytest
from pyspark.sql import functions as F

from clanweave.operators import neighborhood as N

GENES = "ID string, AC string, NUM long, TYPE int, DIRECTION int, start long, stop long"


def contig(name, n, kind, prefix=None):
    return [(name, f"{prefix or name}_{i}", i, kind, i % 2, 1000 * i, 1000 * i + 300) for i in range(1, n + 1)]


def query(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "query string")


def test_circular_wraps(spark, rows):
    g = spark.createDataFrame(contig("C", 10, 0), GENES)
    got = rows(N.find_neighbors(query(spark, "C_1"), g, 2), "num", "distance", "is_bound")
    assert got == [(2, 1, 1), (3, 2, 1), (9, -2, 1), (10, -1, 1)]
    rel = {r["num"]: r["rel_start"] for r in N.find_neighbors(query(spark, "C_1"), g, 2).collect()}
    assert rel[2] == 1000 and rel[10] == 10000 - 10300 - 1000


def test_linear_stops(spark, rows):
    g = spark.createDataFrame(contig("L", 10, 1), GENES)
    assert rows(N.find_neighbors(query(spark, "L_9"), g, 2), "num", "distance", "is_bound") == [(7, -2, 2), (8, -1, 2), (10, 1, 2)]


def test_short_circular_does_not_wrap(spark, rows):
    g = spark.createDataFrame(contig("C", 5, 0), GENES)
    assert rows(N.find_neighbors(query(spark, "C_1"), g, 5), "num") == [(2,), (3,), (4,), (5,)]


def test_circular_gene_seen_twice_keeps_the_nearest(spark, rows):
    g = spark.createDataFrame(contig("C", 6, 0), GENES)
    got = rows(N.find_neighbors(query(spark, "C_1"), g, 4), "num", "distance")
    assert [n for n, _ in got] == [2, 3, 4, 5, 6] and all(abs(d) <= 3 for _, d in got)


def test_genome_choice(spark, rows):
    g = contig("C", 10, 0) + contig("D", 30, 0) + contig("L", 40, 1)
    g += [("C", "Q", 11, 0, 1, 0, 9), ("D", "Q", 31, 0, 1, 0, 9), ("L", "Q", 41, 1, 1, 0, 9), ("L", "R", 42, 1, 1, 0, 9)]
    g += [(f"M{i}", "R", 20, 1, 1, 0, 9) for i in (1, 2)] + contig("M1", 19, 1) + contig("M2", 60, 1)[20:]
    df = spark.createDataFrame(g, GENES)
    got = rows(N.choose_genome(query(spark, "Q", "R"), df), "query", "contig")
    assert got == [("Q", "D"), ("R", "M2")]


def test_window_matches_range_predicate(spark, rows):
    rng = random.Random(3)
    g = []
    for c, (n, kind) in {"A": (25, 0), "B": (18, 1), "E": (7, 0)}.items():
        g += contig(c, n, kind)
    df = spark.createDataFrame(g, GENES)
    names = [r[1] for r in rng.sample(g, 15)]
    size = {"A": 25, "B": 18, "E": 7}
    for n in (3, 8):
        want = set()
        for q in names:
            c, i = q.split("_")
            for j in range(1, size[c] + 1):
                d = j - int(i)
                if c != "B" and n < size[c]:
                    d = min((d, d - size[c], d + size[c]), key=abs)
                if d and abs(d) <= n:
                    want.add((q, f"{c}_{j}", abs(d)))
        got = {(a, b, abs(d)) for a, b, d in rows(N.find_neighbors(query(spark, *names), df, n), "query", "neighbor", "distance")}
        assert got == want


def test_wide_windows(spark, rows):
    g = spark.createDataFrame(contig("L", 90, 1), GENES)
    assert [n for (n,) in rows(N.find_neighbors(query(spark, "L_45"), g, 30), "num")] == [n for n in range(15, 76) if n != 45]
    with pytest.raises(ValueError):
        N.find_neighbors(query(spark, "L_1"), g, 0)


@pytest.mark.parametrize("size", [4, 5, 11, 15, 20, 21])
def test_restricted_window_equals_direct(spark, rows, size):
    """A wide stored window of a small circular contig, cut down, is the window that was asked for."""
    g = spark.createDataFrame(contig("C", size, 0) + contig("L", size, 1), GENES)
    q = query(spark, "C_1", f"C_{size}", "C_3", "L_2")
    stored = N.find_neighbors(q, g, 20, wrap_all=True)
    for n in (2, 5, 10):
        assert rows(N.restrict_window(stored, n)) == rows(N.find_neighbors(q, g, n))


def test_cooccurrence(spark, rows):
    r = spark.createDataFrame(
        [(1, "q1", "n1", "F-G", 1), (1, "q2", "n2", "F", -2), (1, "q2", "n5", "F", 4), (1, "q3", "n3", "none", 1), (2, "q4", "n4", "F", 1)],
        "cluster int, query string, neighbor string, family string, distance long",
    )
    c = N.cooccurrence(r)
    assert rows(c, "family", "queries", "queryable", "ratio") == [("F", 1, 3, 0.33), ("F-G", 1, 3, 0.33), ("none", 1, 3, 0.33)]
    assert rows(N.cooccurrence_table(c)) == [("F", 1, 0.66), ("G", 1, 0.33)]
    fused = c.withColumn("ratio", F.when(F.col("family") == "F", 0.5).otherwise(F.col("ratio")))
    assert rows(N.cooccurrence_table(fused)) == [("F", 1, 0.83), ("G", 1, 0.33)]
    m = N.cooccurrence_matrix(N.cooccurrence_table(c), [1, 2])
    assert rows(m) == [("F", 0.66, 0.0), ("G", 0.33, 0.0)]
    sizes = spark.createDataFrame([(1, 7)], "cluster int, size long")
    s = {x["family"]: x for x in N.spokes(r, sizes).collect()}
    assert (s["F"]["avg_distance"], s["F"]["median_distance"], s["F"]["ratio_text"]) == (3.0, 3.0, "1/3")


def test_shapes(spark, rows):
    a = spark.createDataFrame([("p", "1ABC", "x"), ("r", None, "Reviewed"), ("e", "", "x")], "accession string, PDB string, STATUS string")
    r = spark.createDataFrame([("A", "p"), ("A", "r"), ("B", "p"), ("C", "r"), ("D", "e")], "k string, neighbor string")
    assert rows(N.node_shape(r, a, ["k"])) == [("A", "diamond"), ("B", "square"), ("C", "triangle"), ("D", "circle")]


def test_clan_order(spark, rows):
    d = spark.createDataFrame([(1, "a", 5, 1), (1, "b", 5, 0), (1, "c", 2, 9), (1, "d", None, None)], "cluster int, accession string, clan int, fam int")
    got = rows(N.order_by_clan(d), "sort_order", "accession", "uid")
    assert got == [(0, "b", "SSN1-CL5-FAM0-0"), (1, "a", "SSN1-CL5-FAM1-1"), (2, "c", "SSN1-CL2-FAM9-2"), (999999, "d", None)]


def test_window_rows_are_narrow_and_dealt_by_query_once(spark):
    """What all rows of a query share is not in the rows that are dealt and sorted; of rows that repeat an ordinal the least one stays."""
    from clanweave.operators import neighborhood as N

    genes = [("C1", f"A{i}", i, 1, i % 2, 1000 * i, 1000 * i + 90) for i in range(1, 30)]
    genes += [("C1", "A7", 7, 1, 0, 6000, 6090), ("C1", "A7", 9, 1, 0, 9500, 9590), ("C1", "A8", 8, 1, 1, 8000, 8090)]
    genes = spark.createDataFrame(genes, "ID string, AC string, NUM long, TYPE int, DIRECTION int, start long, stop long")
    queries = spark.createDataFrame([("A5",), ("A8",), ("A20",)], "query string")
    found = N.find_neighbors(queries, genes, 4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan.split("RepartitionByExpression")[1]
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert "last_stop" not in dealt.split("Join")[0] and "query_start" not in dealt.split("Join")[0]
    least = {}
    for r in N.genes_in_window(N.choose_genome(queries, genes), genes, 4).where("neighbor <> query").collect():
        key, value = (r.query, r.neighbor), (abs(r.distance), r.num, r.direction, r.start, r.stop, r.distance)
        least[key] = min(least.get(key, value), value)
    got = {(r.query, r.neighbor): (abs(r.distance), r.num, r.direction, r.start, r.stop, r.distance) for r in found.collect()}
    assert got == least and got["A5", "A7"] == (2, 7, 0, 6000, 6090, 2)


def long_rows(spark):
    rows = [(1, "q1", "n1", 1, "PF1-PF2"), (1, "q1", "n1", 1, "PF1-PF2"), (1, "q1", "n1", 1, "PF2-PF3"), (1, "q2", "n1", -2, "PF1-PF2"), (2, "q3", "n2", 2, "none"), (2, "q3", "n3", 3, None), (2, "q4", "n2", 2, "none")]
    return spark.createDataFrame(rows, "cluster int, query string, neighbor string, distance long, family string").withColumns({"query_direction": F.lit(0), "direction": F.lit(1)})


def test_split_families_are_made_distinct_before_they_are_multiplied(spark, rows):
    colors = spark.createDataFrame([(1, "#1")], "cluster int, color string")
    got = N.neighbor_long(long_rows(spark), colors, split=True)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # below it in the plan
    want = [("q1", "n1", f, "01") for f in ("PF1", "PF2", "PF3")] + [("q2", "n1", f, "02") for f in ("PF1", "PF2")] + [(q, "n2", "none", "02") for q in ("q3", "q4")]
    assert rows(got, "query", "neighbor", "family", "distance") == sorted(want)


def test_neighbor_files_are_compressed_and_made_once(spark, rows, tmp_path, monkeypatch):
    from clanweave.sources import writers as X

    made = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda v: made.add(1) or v, "string").asNondeterministic()
    colors = spark.createDataFrame([(1, "#1")], "cluster int, color string")
    long = N.neighbor_long(long_rows(spark).where("family is not null"), colors, split=True).withColumn("query", counted("query")).localCheckpoint()
    n = made.value
    X.write_pfam_neighbor_files({"any": long}, str(tmp_path / "f"))
    assert n == 7 and not [*tmp_path.glob("f/any/*/part-*.txt")]
    each = spark.read.text(str(tmp_path / "f/any"))
    assert rows(each.select("family").distinct()) == [(f,) for f in ("PF1", "PF2", "PF3", "none")]
    assert ("PF3", "q1\tn1\tPF3\t1\t#1\t01\tcomplement-normal") in rows(each, "family", "value")
    parts = sorted(tmp_path.glob("f/any_ALL_PFAM/part-*.gz"))
    import gzip

    lines = "".join(gzip.open(p, "rt").read() for p in parts).splitlines()
    assert lines[0].startswith("Query ID\tNeighbor ID") and lines[1:] == [r[1] for r in sorted(rows(each, "family", "value"))]


def test_linear_contigs_beside_circular_ones_are_left_out_early(spark, rows):
    wide = [(f"C{c}", f"A{a}", n, t, 1, 10 * n, 10 * n + 5) for c, t in ((1, 0), (2, 0), (3, 1), (4, 1), (5, None)) for n, a in enumerate(range(c, 12 + 3 * c), 1)]
    genes = spark.createDataFrame([*wide, (None, "A3", 1, 0, 1, 1, 2), ("C9", None, 1, 0, 1, 1, 2)], "ID string, AC string, NUM int, TYPE int, DIRECTION int, start int, stop int")
    asked = spark.createDataFrame([(f"A{a}",) for a in range(30)] + [("A3",), (None,)], "query string")
    got = {r["query"]: r["contig"] for r in N.choose_genome(asked, genes).collect()}
    assert got["A5"] == "C5" and got["A1"] == "C1" and got["A2"] == "C2" and got["A3"] == "C2" and len(got) == 26
    assert "Window" in N.choose_genome(asked, genes)._jdf.queryExecution().optimizedPlan().toString()
