from pyspark.sql import functions as F

from clanweave.operators import annotate as A
from clanweave.operators import sequences as Q
from clanweave.operators import tables as T


def test_domain_regions(spark, rows):
    p = spark.createDataFrame([("a", 10, 20, 60), ("a", 40, 50, 60), ("b", 1, 60, 60)], "id string, start int, end int, full_len int")
    assert rows(Q.domain_region(p, "cterminal"), "id", "start", "end") == [("a", 21, 39), ("a", 51, 60)]
    assert rows(Q.domain_region(p, "nterminal"), "id", "start", "end") == [("a", 1, 9), ("a", 21, 39)]


def test_sample_fraction(spark, rows):
    d = spark.createDataFrame([(f"p{i:02d}", f"s{i // 3}", "Reviewed" if i == 1 else "x") for i in range(12)], "accession string, seed string, STATUS string")
    assert [r[0] for r in rows(Q.sample_fraction(d, 4, ["accession"]))] == ["p01", "p03", "p07", "p11"]
    # counter with seeds: 1 for the first row, then 1 + number of seeds met before
    count, seen, keep = 1, set(), []
    for i in range(12):
        if i == 1 or count % 4 == 0:
            keep.append(f"p{i:02d}")
        if f"s{i // 3}" not in seen:
            seen.add(f"s{i // 3}")
            count += 1
    assert [r[0] for r in rows(Q.sample_fraction(d, 4, ["accession"], seed="seed"))] == keep


def test_top_hits(spark):
    h = spark.createDataFrame([("q", "sp|AAA|x", 5.0), ("q", "AAA", 9.0), ("q", "BBB", 7.0), ("q", "CCC", 1.0)], "src string, dst string, bitscore double")
    assert [tuple(r) for r in Q.top_hits(h, 2).collect()] == [("AAA", 9.0), ("BBB", 7.0)]


def test_reverse_mapping(spark, rows):
    m = spark.createDataFrame([("P00001", "GI", "77"), ("P00000", "gi", "77"), ("P00002", "refseq", "WP_1.1")], "uniprot_id string, foreign_id_type string, foreign_id string")
    ids = spark.createDataFrame([("gi|77|x",), ("WP_1.1",), ("Q12345.2",), ("??",), ("88",)], "id string")
    ok, no = A.reverse_map_ids(ids, m)
    assert rows(ok) == [("P00000", "77"), ("P00002", "WP_1.1"), ("Q12345", "Q12345.2")]
    assert rows(no) == [("88",)]
    ok, no = A.reverse_map_ids(ids, m, type_hint="GI")
    assert ("P00000", "77") in rows(ok)
    ok, no = A.reverse_map_ids(ids, m, check=True)
    assert ("Q12345.2",) in rows(no)


def test_merge(spark, rows):
    fam = spark.createDataFrame([("F1",), ("S1",)], "id string")
    user = spark.createDataFrame([("F1",), ("M1",), ("U1",)], "id string")
    umap = spark.createDataFrame([("M1", "S1")], "member string, seed string")
    assert rows(Q.merge_ids(fam, user, umap)) == [("F1",), ("S1",), ("U1",)]
    meta = Q.merge_metadata(fam, user, umap)
    assert rows(meta.where("field = 'Sequence_Source'"), "id", "value") == [("F1", "FAMILY+USER"), ("S1", "FAMILY+USER"), ("U1", "USER")]
    assert rows(meta.where("field = 'User_IDs_in_Cluster'"), "id", "value") == [("F1", "F1"), ("S1", "M1")]
    s = Q.sequence_set_stats(meta).first()
    assert (s["Total"], s["Family"], s["FamilyOverlap"], s["UniRefOverlap"], s["User"]) == (3, 2, 2, 2, 1)


def test_family_selection(spark, rows):
    pf = spark.createDataFrame([("PF1", "A-1", 1, 9), ("PF1", "A", 20, 30), ("PF2", "B", 5, 9), ("PF3", "C", 1, 2)], "id string, accession string, start int, end int")
    clans = spark.createDataFrame([("PF2", "CL1")], "pfam_id string, clan_id string")
    anno = spark.createDataFrame([("A", "Reviewed", False, 60), ("B", "x", True, 50)], "accession string, STATUS string, Fragment boolean, Sequence_Length int")
    uni = spark.createDataFrame([("A", "A", "A"), ("B", "A", "A")], "accession string, uniref50_seed string, uniref90_seed string")
    s = Q.select_family(["PF1", "CL1"], {"pfam": pf}, clans, anno)
    assert rows(s.pieces) == [("A",), ("B",)]
    assert s.full_size.first()[0] == 2
    s = Q.select_family(["PF1", "CL1"], {"pfam": pf}, clans, anno, no_fragments=True, domain=True, region="cterminal")
    assert rows(s.pieces, "id", "start", "end") == [("A", 10, 19), ("A", 31, 60)]
    s = Q.select_family(["PF1", "CL1"], {"pfam": pf}, clans, anno, uni, "90")
    assert rows(s.pieces) == [("A",)] and rows(s.uniref_map) == [("B", "A")] and rows(s.uniref_members) == [("A", "A"), ("A", "B")]


def test_length_histogram(spark, rows):
    d = spark.createDataFrame([(5,), (5,), (7,)], "len int")
    got = rows(T.length_histogram(d, 1.0))
    assert [g[0] for g in got] == list(range(0, 9))
    assert {a: b for a, b in got if b} == {5: 2, 7: 1}


def test_fetch(spark, rows):
    seqs = spark.createDataFrame([("A", "ABCDEFGHIJ"), ("B", "KLM")], "id string, seq string")
    pieces = spark.createDataFrame([("A", 2, 4), ("A", None, 3)], "id string, start int, end int")
    ids = seqs.select("id")
    assert rows(Q.fetch_sequences(ids, seqs, pieces)) == [("A:1:3", "ABC"), ("A:2:4", "BCD"), ("B", "KLM")]


def test_overlap(spark, rows):
    m = spark.createDataFrame([("F", "a", 1, 2), ("F", "b", 1, 2), ("F", "c", 1, 2), ("G", "a", 1, 2)], "id string, accession string, start int, end int")
    assert rows(T.family_overlap(m)) == [("F", 33.333), ("G", 100.0)]
    assert T.family_counts(m, spark.createDataFrame([], "accession string, uniref50_seed string, uniref90_seed string"), spark.createDataFrame([], "pfam_id string, clan_id string")).where(F.col("family") == "F").first()["total"] == 3
