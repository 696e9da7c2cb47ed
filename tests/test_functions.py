from pyspark.sql import functions as F

from clanweave.functions import scalar as S


def one(spark, col, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(col).first()[0]


def test_alignment_score(spark):
    assert one(spark, S.alignment_score("q", "s", "b"), q=100, s=200, b=100.0) == 25
    assert one(spark, S.alignment_score("q", "s", "b"), q=100_000, s=100_000, b=1.0) == -9  # truncated toward zero, no overflow


def test_id_types(spark):
    want = {"123": "gi", "ABC12345.1": "embl-cds", "WP_0123.1": "refseq", "A0A075WIR0": "uniprot", "1ABC": "pdb", "??": "unknown"}
    d = spark.createDataFrame([(k,) for k in want], "id string").select("id", S.id_type("id").alias("t"))
    assert {r["id"]: r["t"] for r in d.collect()} == want


def test_trunc2(spark):
    assert one(spark, S.trunc2_ratio("a", "b"), a=29, b=100) == 0.29
    assert one(spark, S.trunc2_ratio("a", "b"), a=1, b=3) == 0.33
    assert one(spark, S.trunc2(F.col("x")), x=0.29) == 0.29
    assert one(spark, S.trunc2(F.col("x")), x=2.999) == 2.99


def test_domains_and_suffixes(spark):
    p = one(spark, S.parse_domain("x"), x="A0A0:12:40")
    assert (p["acc"], p["start"], p["end"]) == ("A0A0", 12, 40)
    assert one(spark, S.parse_domain("x"), x="A0A0")["start"] is None
    assert one(spark, S.strip_isoform("x"), x="P12345-2") == "P12345"
    assert one(spark, S.strip_version("x"), x="CAA1.12") == "CAA1"


def test_descriptions(spark):
    de = "RecName: Full=Alpha & beta {ECO:1}Flags: Fragment"
    assert one(spark, S.clean_description("x"), x=de) == "Alpha and beta"
    assert one(spark, S.is_fragment("x"), x=de) is True
    assert one(spark, S.clean_organism("x"), x="Homo sapiens (Human)") == "Homo sapiens "
    assert one(spark, S.clean_organism("x"), x="E. coli (strain K12) (x)") == "E. coli  (strain K12)"


def test_sequences(spark):
    assert one(spark, S.subsequence("s", F.lit(2), F.lit(4)), s="ABCDE") == "BCD"
    assert one(spark, S.subsequence_guarded("s", F.lit(2), F.lit(9)), s="ABCDE") == "ABCDE"
    assert one(spark, S.gene_length_aa(F.lit(400), F.lit(100)), s="") == 99


def test_markers_and_headers(spark):
    m = one(spark, S.marker_parse("h"), h="FAM_1_QM12_#03__[FAM_1_w=0.5,B_w=0.25]")
    assert (m["family"], m["type"], m["quasi"], m["ordinal"]) == ("FAM_1", "QM", 12, 3)
    assert [(w["family"], w["w"]) for w in m["weights"]] == [("FAM_1", 0.5), ("B", 0.25)]
    assert one(spark, S.header_ids("h"), h=">sp|P12345|NAME_X Some text>gi|9 |ABCDEF x") == ["P12345", "NAME_X", "ABCDEF"]
    assert one(spark, S.clean_accession("h"), h="tr|A0A1|X") == "A0A1"
