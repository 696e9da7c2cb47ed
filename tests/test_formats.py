import pytest
from pyspark.sql import functions as F

from clanweave.operators import tables as T
from clanweave.sources import readers as R
from clanweave.sources import writers as X


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_bytes(text.encode())
    return str(p)


def test_fasta(spark, rows, tmp_path):
    p = put(tmp_path, "a.fa", ">A one\nABC\nDEF\n>B\nGH\r\nI\n")
    assert rows(R.read_fasta(spark, p)) == [("A", "A one", "ABCDEF", 6), ("B", "B", "GHI", 3)]


def test_fasta_marks_inside_headers(spark, rows, tmp_path):
    p = put(tmp_path, "m.fa", "\n>sp|P12345|X desc >gi|99999 other\nMKV\r\nLLA\r\n>B >C\n>D\nAA\n")
    assert rows(R.read_fasta(spark, p), "id", "seq") == [("B", ""), ("D", "AA"), ("sp|P12345|X", "MKVLLA")]
    got = rows(R.read_fasta_multi_header(spark, p), "ord", "pos", "header", "seq")
    assert got == [(0, 0, "sp|P12345|X desc >gi|99999 other", "MKVLLA"), (1, 0, "B >C", "AA"), (1, 1, "D", "AA")]


def test_fastq_with_empty_reads(spark, rows, tmp_path):
    p = put(tmp_path, "e.fastq", "@r1\nACGT\n+\nIIII\n@r2\n\n+\n\n@r3\nGG\n+\n@@\n@r4\nT\n+\nI\n\n\n")
    assert rows(R.read_metagenome_reads(spark, p), "read_id", "seq", "len") == [("r1", "ACGT", 4), ("r2", "", 0), ("r3", "GG", 2), ("r4", "T", 1)]


def test_fasta_multi_header(spark, rows, tmp_path):
    p = put(tmp_path, "a.fa", ">x\n>y\n>z w\nABC\n>q\nDE\n")
    got = rows(R.read_fasta_multi_header(spark, p), "id", "pos", "header", "seq")
    assert got == [("zzzzzz0", 0, "x", "ABC"), ("zzzzzz0", 1, "y", "ABC"), ("zzzzzz0", 2, "z w", "ABC"), ("zzzzzz1", 0, "q", "DE")]


def test_order_survives_splits(spark, rows, tmp_path):
    p = put(tmp_path, "big.struct", "".join(f"ID{i:04d}\n" + "".join(f"\tF{j}\tv{i}_{j}\n" for j in range(i % 4)) for i in range(800)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = R.read_struct(spark, p)
        assert got.count() == sum(i % 4 for i in range(800))
        assert got.where("value not like concat('v', cast(substring(id, 3, 4) as int), '\\_%')").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cdhit_and_lists(spark, rows, tmp_path):
    p = put(tmp_path, "a.clstr", ">Cluster 0\n0\t10aa, >AAAAAA:1:9... at 99%\n1\t20aa, >BBBBBB... *\n>Cluster 1\n0\t9aa, >CCCCCC... *\n")
    assert rows(R.read_cdhit_clusters(spark, p)) == [("BBBBBB", "AAAAAA:1:9"), ("BBBBBB", "BBBBBB"), ("CCCCCC", "CCCCCC")]
    p = put(tmp_path, "ids.txt", "A,B\rC  D\r\n\nA\n")
    assert rows(R.read_id_list(spark, p)) == [("A",), ("B",), ("C",), ("D",)]
    p = put(tmp_path, "ev.txt", "Q1|1e-5,Q2|2,Q3")
    assert rows(R.read_id_evalue_list(spark, p).orderBy("ord"), "ord", "id", "evalue") == [(0, "Q1", 1e-5), (1, "Q2", 2.0), (2, "Q3", None)]


def test_xgmml(spark, rows, tmp_path):
    doc = (
        '<?xml version="1.0"?>\n<graph label="N"><node id="1" label="A"><att name="x" type="string" value="v"/></node>'
        '<node id="2" label="B"><att type="list" name="ACC"><att type="string" name="ACC" value="B"/><att type="string" name="ACC" value="C"/></att></node>'
        '<edge source="1" target="2" label="e"/></graph>'
    )
    n = R.read_xgmml(spark, put(tmp_path, "a.xgmml", doc))
    assert rows(n["edges"]) == [("A", "B")]
    assert rows(n["node_atts"]) == [("A", "x", "string", "v"), ("B", "ACC", "list", "B"), ("B", "ACC", "list", "C")]
    assert rows(n["graph"]) == [("N",)]
    with pytest.raises(ValueError):
        R.read_xgmml(spark, put(tmp_path, "b.xgmml", doc.replace('target="2"', 'target="9"')))


def test_xgmml_parts_form_one_document(spark, tmp_path):
    import xml.etree.ElementTree as ET

    nodes = spark.createDataFrame([("A", "A"), ("B", "B\x01")], "node_id string, label string")
    atts = spark.createDataFrame([("A", "PFAM", "string", "PF2"), ("A", "PFAM", "string", "PF1"), ("A", "Sequence_Length", "integer", "None"), ("B", "q", "string", "<&>")], "node_id string, name string, type string, value string")
    edges = spark.createDataFrame([("A", "B", 9)], "source string, target string, alignment_len int")
    out = tmp_path / "net"
    X.write_xgmml(nodes, atts, edges, str(out), 'T "1"')
    text = "".join(p.read_text() for p in sorted(out.glob("part-*")))
    root = ET.fromstring(text.encode())
    ns = "{http://www.cs.rpi.edu/XGMML}"
    a, b = root.findall(f"{ns}node")
    assert [x.get("value") for x in a.find(f"{ns}att").findall(f"{ns}att")] == ["PF1", "PF2"] and len(a) == 1
    assert b.find(f"{ns}att").get("value") == "<&>" and b.get("label") == "B" and root.get("label") == 'T "1"'
    assert root.find(f"{ns}edge").find(f"{ns}att").get("value") == "9"


def test_short_numbers(spark):
    want = {0.0: "0", 0.5: "0.5", 1e6: "1e+06", 123456.0: "123456", 1234567.0: "1.23457e+06", 1e-5: "1e-05", 0.1 + 0.2: "0.3", 100.0: "100", -2.5: "-2.5"}
    d = spark.createDataFrame([(k,) for k in want], "x double").select("x", X.short_number(F.col("x")).alias("s"))
    assert {r["x"]: r["s"] for r in d.collect()} == {k: "%.6g" % k for k in want} == want


def test_matrix(spark, tmp_path):
    d = spark.createDataFrame([("s2", "10", "P", 1.0), ("s1", "9", "P", 0.25), ("s1", "S1", "Q", 3.0), ("s1", "#N/A", "R", 2.0)], "sample string, cluster string, protein string, value double")
    X.write_matrix(d, str(tmp_path / "m"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*")))
    assert text.splitlines() == ["Feature \\ Sample\ts1\ts2", "#N/A|R\t2\t0", "9|P\t0.25\t0", "10|P\t0\t1", "S1|Q\t3\t0"]
    from_file = put(tmp_path, "m.tsv", "F\ts1\ts2\n9|ABCDEF\t1\n8|x\t\t2\n")
    got = sorted(tuple(r) for r in R.read_abundance(spark, from_file).collect())
    assert got == [("8|x", "8", "s1", 0.0), ("8|x", "8", "s2", 2.0), ("ABCDEF", "9", "s1", 1.0), ("ABCDEF", "9", "s2", 0.0)]


def test_matrix_of_many_samples(spark, tmp_path):
    names = 5000
    d = spark.range(3 * names).selectExpr(f"concat('s', lpad(id % {names}, 5, '0')) as sample", f"cast(id div {names} as string) as cluster", "'P' as protein", "cast(id % 3 as double) as value")
    d = d.where("cluster <> '1' or value > 1.5").unionByName(d.where("cluster = '0'"))  # gaps in one line, two values a cell in another
    X.write_matrix(d, str(tmp_path / "m"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*"))).splitlines()
    assert lines[0].split("\t")[1:] == [f"s{i:05d}" for i in range(names)]
    value = lambda c, i: (c * names + i) % 3
    cell = [lambda i: 2 * value(0, i), lambda i: value(1, i) if value(1, i) == 2 else 0, lambda i: value(2, i)]
    assert [r.split("\t") for r in lines[1:]] == [[f"{c}|P", *[str(cell[c](i)) for i in range(names)]] for c in range(3)]


def test_empty_matrix(spark, tmp_path):
    X.write_matrix(spark.createDataFrame([], "sample string, cluster string, protein string, value double"), str(tmp_path / "m"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*"))) == "Feature \\ Sample\n"


def test_reads(spark, rows, tmp_path):
    put(tmp_path, "one.fastq", "@r1 x\nACGT\n+\n@@@@\n@r2\nAC\n+\nII\n")
    put(tmp_path, "two.fa", ">q1\nAC\nGT\n>q2\nA\n")
    got = rows(R.read_metagenome_reads(spark, str(tmp_path)))
    assert got == [("one", "r1", "ACGT", 4), ("one", "r2", "AC", 2), ("two", "q1", "ACGT", 4), ("two", "q2", "A", 1)]


def test_tree_and_embl(spark, rows, tmp_path):
    p = put(tmp_path, "tree.txt", "IPR1::a::\n--IPR2::b::\n----IPR3::c::\n--IPR4::d::\nIPR5::e::\n")
    assert rows(T.build_interpro_tree(spark, p)) == [("IPR1", None, False), ("IPR2", "IPR1", False), ("IPR3", "IPR2", True), ("IPR4", "IPR1", True), ("IPR5", None, True)]
    embl = (
        "ID   CX1; SV 1; circular; genomic DNA; STD; PRO; 9 BP.\nFT   CDS             1..>90\nFT                   /db_xref=\"UniProtKB/TrEMBL:A0A1\"\nFT                   /translation=\"M\"\n"
        "FT   tRNA            95..99\nFT                   /db_xref=\"UniProtKB/TrEMBL:NOPE\"\nFT   CDS             complement(100..200)\nFT                   /protein_id=\"CAA1.1\"\nFT                   /translation=\"M\"\n"
        "FT   CDS             300..400\nFT                   /pseudo\n//\n"
    )
    m = spark.createDataFrame([("P9", "EMBL-CDS", "CAA1.1")], "uniprot_id string, foreign_id_type string, foreign_id string")
    got = rows(T.build_gene_positions(R.read_embl(spark, put(tmp_path, "c.embl", embl)), m))
    assert got == [("CX1", "A0A1", 1, 0, 1, 1, 90), ("CX1", "P9", 2, 0, 0, 100, 200)]


def test_fastq_records_cut_by_blocks_are_put_together(spark, tmp_path):
    """Blocks of 40 bytes cut records between and inside lines; only the cut records are dealt by key, and no line is ranked by a sort."""
    from clanweave.sources import readers as R

    want = []
    for name, n in (("a.fastq", 60), ("b.fq", 25)):
        reads = [(f"{name[0]}{i}", "" if i % 9 == 5 else "ACGT" * (1 + i % 4)) for i in range(n)]
        (tmp_path / name).write_text("".join(f"@{i} x\n{s}\n+\n@{'I' * len(s)}\n" for i, s in reads))
        want += [(name[0], i, s, len(s)) for i, s in reads]
    (tmp_path / "c.fastq").write_text("@last\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = R.read_metagenome_reads(spark, str(tmp_path))
        assert "Window" not in got.where("read_id like 'a%'")._jdf.queryExecution().optimizedPlan().toString().split("Union")[1].split("_no")[0]
        found = sorted(tuple(r) for r in got.collect() if r.seq is not None)
        assert [r.read_id for r in got.where("seq is null").collect()] == ["last"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was[0])
        spark.conf.set("spark.sql.files.openCostInBytes", was[1])
    assert found == sorted(want)


def test_many_short_files_are_opened_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "FILES_PER_TASK", 20)
    ids = spark.createDataFrame([(i % 120, f"A{i:04d}", i % 120 >= 100) for i in range(360)], "cluster int, id string, single boolean")
    X.write_id_lists_per_cluster(ids, str(tmp_path / "lists"), "X")
    named = {(p.parent.name.removeprefix("file="), line) for p in tmp_path.glob("lists/file=*/part-*") for line in p.read_text().split()}
    want = {("singleton_X_IDs" if r.single else f"cluster_X_IDs_{r.cluster}", r.id) for r in ids.collect()}
    assert named == want | {("cluster_All_X_IDs", r.id) for r in ids.collect() if not r.single}
    files = {}
    for p in tmp_path.glob("lists/file=*/part-*"):
        files.setdefault(p.name[:10], set()).add(p.parent.name)
    assert len(files) >= 5 and max(map(len, files.values())) <= 60


def test_id_lists_are_written_and_read_without_a_scan_per_folder(spark, rows, tmp_path, monkeypatch):
    from clanweave.sources import folders as D

    ids = spark.createDataFrame([(1, "A1", False), (1, None, False), (1, "A1", False), (None, "A2", False), (2, "x y", False), (3, "A3", True), (4, "A\u00e94", None)], "cluster int, id string, single boolean")
    X.write_id_lists_per_cluster(ids, str(tmp_path / "a"), "U/1")
    got = R.read_id_lists(spark, f"file://{tmp_path}/a")
    assert "FileScan text" not in got._jdf.queryExecution().toString()
    want = spark.read.text(str(tmp_path / "a")).select("file", "value")
    assert want.columns == ["file", "value"] and rows(got) == rows(want)
    part = "cluster_U/1_IDs_"
    key = lambda r: (str(r[0]), r[1])
    lists = [(part + "1", "A1"), (part + "1", ""), (part + "1", "A1"), (None, "A2"), (part + "2", "x y"), ("singleton_U/1_IDs", "A3"), (part + "4", "A\u00e94")]
    every = [("cluster_All_U/1_IDs", i) for i in ("A1", "", "A1", "A2", "x y")]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(lists + every, key=key)
    with pytest.raises(FileExistsError):
        X.write_id_lists_per_cluster(ids, str(tmp_path / "a"), "U/1")
    # many short lists: tasks by the number of files, and the reader starts no task for a file or two
    monkeypatch.setattr(X, "FILES_PER_TASK", 50)
    monkeypatch.setattr(D, "FILES_PER_TASK", 50)
    many = spark.createDataFrame([(i % 400, f"A{i:04d}", False) for i in range(800)], "cluster int, id string, single boolean")
    X.write_id_lists_per_cluster(many, str(tmp_path / "b"), "X")
    got = R.read_id_lists(spark, str(tmp_path / "b"))
    assert got.count() == 1600 and got.rdd.getNumPartitions() <= 10 < spark.read.text(str(tmp_path / "b")).rdd.getNumPartitions()
    put(tmp_path, "b/file=cluster_X_IDs_0/part-more.txt", "one\r\ntwo\rthree\n\nlast")
    assert {r.id for r in R.read_id_lists(spark, str(tmp_path / "b")).collect()} >= {"one", "two", "three", "", "last"}
    X.write_id_lists_per_cluster(ids.limit(0), str(tmp_path / "c"), "X")
    assert R.read_id_lists(spark, str(tmp_path / "c")).count() == 0
