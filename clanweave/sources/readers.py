"""Readers of the text and XML formats; every reader returns a typed DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clanweave import schemas
from clanweave.functions import scalar as S
from clanweave.functions.ordered import ordered_scan
from clanweave.session import materialize
from clanweave.sources.archives import archive_lines, archive_of, member_of
from clanweave.sources.folders import read_folders
from clanweave.sources.ordered import ORDER, first_lines, records, under_heads

LARGE_READ = 50_000
_ATT = "array<struct<_name:string,_type:string,_value:string,att:array<struct<_name:string,_type:string,_value:string>>>>"


def xml_elements(spark: SparkSession, path: str, tag: str, schema: str, nested: bool = False) -> DataFrame:
    """One row per ``<tag>`` element, parsed by ``schema``.

    Text is cut at the start tag, so a single large document is read by many tasks. ``nested`` elements, which
    hold empty elements of the same name, are cut at the end tag instead.
    """
    start, end = f"<{tag}", f"</{tag}>"
    if nested:
        text = spark.read.option("lineSep", end).text(path)
        text = text.select(F.regexp_extract("value", rf"(?s)({start}[\s>].*)$", 1).alias("x")).where("x <> ''")
        xml = F.concat("x", F.lit(end))
    else:
        text = spark.read.option("lineSep", start).text(path).where(F.col("value").rlike(r"^[\s>/]"))
        empty = F.regexp_extract("value", r"(?s)^([^>]*/>)", 1)
        full = F.concat(F.substring_index("value", end, 1), F.lit(end))
        xml = F.concat(F.lit(start), F.when(empty != "", empty).otherwise(full))
    return text.select(F.from_xml(xml, schema).alias("e")).select("e.*")


# ---- sequences ------------------------------------------------------------------------------------
def _split_record(value) -> tuple:
    header = F.regexp_extract(value, r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace(value, r"^[^\r\n]*", ""), r"\s", "")
    return header, body


def _unmarked(value: str):
    """A record without its mark; only the first one of a file still has it."""
    return F.regexp_replace(value, r"^\s*>", "").alias("value")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(id, header, seq, seq_len)``; a record begins with ``>`` at the start of a line, so files split anywhere."""
    rec = spark.read.option("lineSep", "\n>").text(path).select(_unmarked("value")).where(F.trim("value") != "")
    header, body = _split_record(F.col("value"))
    return rec.select(F.regexp_extract(header, r"^\s*(\S+)", 1).alias("id"), F.rtrim(header).alias("header"), body.alias("seq"), F.length(body).alias("seq_len"))


def read_fasta_multi_header(spark: SparkSession, path: str) -> DataFrame:
    """Records with several header lines: ``(ord, id, pos, header, seq, seq_len)``, one row per header line.

    IDs are the 0-based ordinal of the sequence, padded with ``z`` to width 7.
    """
    header, body = _split_record(F.col("value"))
    rec = records(spark, path, "\n>").select(*ORDER, _unmarked("value")).where(F.trim("value") != "").select(*ORDER, F.rtrim(header).alias("header"), body.alias("seq"))
    placed = ordered_scan(rec, [], ORDER, rank="_r", sums={"_done": (F.col("seq") != "").cast("long")})
    placed = placed.withColumn("ord", F.col("_done") - (F.col("seq") != "").cast("long"))
    first = placed.groupBy("ord").agg(F.min("_r").alias("_first"), F.max("seq").alias("_seq"))
    rows = placed.drop("seq").join(first.where("_seq <> ''"), "ord")
    return rows.select("ord", sequence_id("ord").alias("id"), (F.col("_r") - F.col("_first")).alias("pos"), "header", F.col("_seq").alias("seq"), F.length("_seq").alias("seq_len"))


def sequence_id(ordinal: str):
    """``zzzzzz0`` for 0; longer numbers are kept whole."""
    n = F.col(ordinal).cast("string")
    return F.when(F.length(n) < 7, F.lpad(n, 7, "z")).otherwise(n)


def read_metagenome_reads(spark: SparkSession, path: str, skip_long: bool = False) -> DataFrame:
    """``(sample, read_id, seq, len)`` of FASTA or FASTQ files (plain, gz, bz2), by file name."""
    lines = materialize(records(spark, path).withColumn("_kind", _kind(F.col("_file"))), "lines")
    return _reads(lines, F.regexp_extract("_file", r"([^/.]+)\.[^/]*$", 1), skip_long)


def read_archived_reads(spark: SparkSession, path: str | DataFrame, skip_long: bool = False) -> DataFrame:
    """``(sample, read_id, seq, len)`` of the FASTA or FASTQ members of tar archives (plain, gz, bz2, xz); see ``archive_lines``.

    An archive holds the files of one sample and names it; a member's name tells its format.
    """
    lines = archive_lines(spark, path).withColumn("_kind", _kind(member_of()))
    return _reads(lines, F.regexp_extract(archive_of(), r"([^/.]+)[^/]*$", 1), skip_long)


def _kind(name: Column) -> Column:
    return F.when(F.lower(name).rlike(r"\.(fastq|fq)([./]|$)"), "fastq").otherwise("fasta")


def _reads(lines: DataFrame, sample: Column, skip_long: bool) -> DataFrame:
    fastq = first_lines(lines.where("_kind = 'fastq'"), 4)
    # every line counts, so a read without residues keeps its place; blank lines at the end make no record
    fastq = fastq.where(F.col("h").startswith("@")).select("_file", F.regexp_extract("h", r"^@(\S+)", 1).alias("read_id"), "seq")
    is_head = F.col("value").startswith(">")
    fa = under_heads(lines.where("_kind = 'fasta' and value <> ''"), is_head, F.regexp_extract("value", r"^>\s*(\S+)", 1))
    # A read's lines are put together in order; a read is short, a contig at most one line per 80 bases.
    fasta = fa.groupBy("_file", "_no").agg(F.max("head").alias("read_id"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_row", "value"))), lambda s: s["value"]), "").alias("seq"))
    out = fastq.unionByName(fasta.select("_file", "read_id", "seq")).select(sample.alias("sample"), "read_id", F.regexp_replace("seq", r"\s", "").alias("seq"))
    out = out.withColumn("len", F.length("seq"))
    return out.where(F.col("len") < LARGE_READ) if skip_long else out


# ---- small text formats ---------------------------------------------------------------------------
def read_struct(spark: SparkSession, path: str) -> DataFrame:
    """``(id, field, value)``: an unindented line is an ID, tab-indented lines belong to the last one."""
    lines = records(spark, path).where("value <> ''")
    rows = under_heads(lines, ~F.col("value").startswith("\t"), F.col("value"))
    part = F.split("value", "\t", 3)
    return rows.select(F.col("head").alias("id"), part[1].alias("field"), part[2].alias("value"))


def read_blast_tab(spark: SparkSession, path: str) -> DataFrame:
    """Edges of a 12-column hit table; ``#`` lines are dropped. Lengths are not in the file."""
    cols = "q string, s string, pid double, alen int, mism int, gap int, qs int, qe int, ss int, se int, ev double, bits double"
    d = spark.read.csv(path, sep="\t", comment="#", schema=cols)
    return d.select(F.col("q").alias("src"), F.col("s").alias("dst"), "pid", "alen", F.col("bits").alias("bitscore"))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """The seven-column edge table."""
    return spark.read.csv(path, sep="\t", schema="src string, dst string, pid double, alen int, bitscore double, src_len int, dst_len int")


def read_cdhit_clusters(spark: SparkSession, path: str) -> DataFrame:
    """``(rep, member)`` of a ``.clstr`` file; the representative is its own member."""
    lines = records(spark, path).where(F.trim("value") != "")
    rows = under_heads(lines, F.col("value").startswith(">Cluster"), F.col("value"))
    m = rows.select("_file", "_no", F.regexp_extract("value", r">(\w{6,10}(:\d+:\d+)?)\.\.\.", 1).alias("member"), F.col("value").rlike(r"\.\.\.\s*\*\s*$").alias("_rep"))
    m = m.where("member <> ''")
    reps = m.where("_rep").select("_file", "_no", F.col("member").alias("rep"))
    return m.join(reps, ["_file", "_no"]).select("rep", "member")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct IDs separated by line ends of any kind, blanks or commas."""
    return spark.read.text(path).select(F.explode(F.split("value", r"[\r\n\s,]+")).alias("id")).where("id <> ''").distinct()


def read_id_lists(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, id)`` of the lists that ``write_id_lists_per_cluster`` has written."""
    return read_folders(spark, folder, "file").select("file", F.col("value").alias("id"))


def read_id_evalue_list(spark: SparkSession, path: str) -> DataFrame:
    """``(id, evalue, ord)`` of a ``id|evalue`` list separated by commas or line ends; ``ord`` is the 0-based position."""
    items = records(spark, path).select(*ORDER, F.posexplode(F.split("value", r"[\r\n,]+")).alias("_pos", "item")).where(F.trim("item") != "")
    parts = F.split("item", r"\|")
    placed = ordered_scan(items, [], [*ORDER, "_pos"], rank="_r")
    return placed.select(F.trim(parts[0]).alias("id"), F.get(parts, F.lit(1)).try_cast("double").alias("evalue"), (F.col("_r") - 1).alias("ord"))


def read_abundance(spark: SparkSession, path: str, merged: bool = False) -> DataFrame:
    """``(feature, cluster, sample, value)`` of a feature × sample table; short rows are filled with 0.

    ``merged`` files have separate cluster and protein columns; others a ``cluster|protein`` key whose protein is
    taken when it looks like an accession.
    """
    d = spark.read.csv(path, sep="\t", header=True)
    keys = d.columns[: 2 if merged else 1]
    samples = d.columns[len(keys):]
    long = d.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.explode(F.array(*[F.struct(F.lit(s).alias("sample"), F.col(f"`{s}`").alias("value")) for s in samples])).alias("c"))
    value = F.coalesce(F.col("c.value").try_cast("double"), F.lit(0.0)).alias("value")
    if merged:
        return long.select(F.col("_k1").alias("feature"), F.col("_k0").alias("cluster"), "c.sample", value)
    part = F.split("_k0", r"\|")
    protein = F.get(part, F.lit(1))
    feature = F.when(protein.rlike("^[A-Z0-9]{6,10}$"), protein).otherwise(F.col("_k0"))
    return long.select(feature.alias("feature"), part[0].alias("cluster"), "c.sample", value)


def read_sample_catalog(spark: SparkSession, path: str) -> DataFrame:
    """``(sample, bodysite, gender, file_path)``; relative files are resolved against the catalogue's folder."""
    folder = path.rsplit("/", 1)[0]
    d = spark.read.csv(path, sep="\t", comment="#", schema="sample string, name string, gender string, file string")
    site = F.when(F.col("name").contains("-"), F.trim(F.split("name", "-")[1])).otherwise(F.col("name"))
    where = (
        F.when(~F.col("file").contains("/"), F.concat(F.lit(folder + "/"), "sample", F.lit("/"), "file"))
        .when(~F.col("file").startswith("/"), F.concat(F.lit(folder + "/"), "file")).otherwise(F.col("file"))
    )
    return d.select("sample", site.alias("bodysite"), "gender", where.alias("file_path"))


def read_bodysites(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema="bodysite string, color string, position int")


def read_cluster_map(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.csv(path, sep="\t", schema="cluster string, protein string")
    return d.where("protein is not null and protein <> ''").select(F.coalesce(F.nullif("cluster", F.lit("")), F.lit("N/A")).alias("cluster"), "protein")


def read_annotation_tables(spark: SparkSession, folder: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """Typed base tables from ``<folder>/<name>.tab``; placeholders become NULL, comma lists become arrays."""
    out = {}
    for name in tables or list(schemas.BASE_TABLES):
        d = spark.read.csv(f"{folder}/{name}.tab", sep="\t", schema=schemas.BASE_TABLES[name], nullValue="None")
        for c in schemas.LIST_COLUMNS.get(name, []):
            d = d.withColumn(c, F.when(~F.col(c).isin(*schemas.EMPTY_VALUES), F.split(c, ",")))
        if name == "annotations":
            d = d.withColumn("Fragment", F.col("Fragment") == 1)
        out[name] = d
    return out


# ---- networks -------------------------------------------------------------------------------------
def _attributes(df: DataFrame, key: str) -> DataFrame:
    a = df.select(key, F.explode("att").alias("a"))
    own = a.where(F.col("a.att").isNull()).select(key, F.col("a._name").alias("name"), F.col("a._type").alias("type"), F.col("a._value").alias("value"))
    listed = a.where(F.col("a.att").isNotNull()).select(key, F.col("a._name").alias("name"), F.explode("a.att").alias("e"))
    return own.unionByName(listed.select(key, "name", F.lit("list").alias("type"), F.col("e._value").alias("value")))


def read_xgmml(spark: SparkSession, path: str, check: bool = True) -> dict[str, DataFrame]:
    """``nodes(node_id, node)``, ``node_atts``, ``edges(src, dst)``, ``edge_atts``; the label is the node's identity.

    Edges refer to XML IDs, which a viewer may have replaced by numbers; they are resolved to labels. An edge to
    an unknown ID is an error.
    """
    raw = xml_elements(spark, path, "node", f"_id string, _label string, att {_ATT}")
    raw = raw.withColumn("node", F.coalesce("_label", "_id"))
    edges = xml_elements(spark, path, "edge", f"_source string, _target string, _label string, att {_ATT}")
    ids = raw.select("_id", "node")
    named = edges.join(ids.select(F.col("_id").alias("_source"), F.col("node").alias("src")), "_source", "left")
    named = named.join(ids.select(F.col("_id").alias("_target"), F.col("node").alias("dst")), "_target", "left")
    if check and not named.where("src is null or dst is null").isEmpty():
        raise ValueError("the network has an edge to an unknown node")
    named = named.withColumn("edge_id", F.concat_ws(",", "src", "dst"))
    return {
        "graph": spark.read.text(path).where(F.col("value").contains("<graph ")).select(F.regexp_extract("value", r'<graph [^>]*label="([^"]*)"', 1).alias("title")),
        "nodes": raw.select(F.col("_id").alias("node_id"), "node"),
        "node_atts": _attributes(raw.withColumnRenamed("node", "_n").select(F.col("_n").alias("node_id"), "att"), "node_id"),
        "edges": named.select("src", "dst"),
        "edge_atts": _attributes(named.select("edge_id", "att"), "edge_id"),
    }


# ---- reference-table dumps ------------------------------------------------------------------------
def read_uniprot_dat(spark: SparkSession, path: str) -> DataFrame:
    """Flat-file records, one row each: ``(record)`` with ``&`` spelled out."""
    r = spark.read.option("lineSep", "\n//").text(path).where(F.trim("value").rlike(r"^\s*ID\s"))
    return r.select(F.regexp_replace(F.regexp_replace("value", r"^\s+", ""), "&", "and").alias("record"))


def read_interpro_xml(spark: SparkSession, path: str) -> DataFrame:
    """``(accession, dbname, match_id, ipr_id, loc, start, end)``, one row per location."""
    schema = "_id string, match array<struct<_id:string,_dbname:string,lcn:array<struct<_start:int,_end:int>>,ipr:struct<_id:string>>>"
    p = xml_elements(spark, path, "protein", schema)
    m = p.select(F.col("_id").alias("accession"), F.explode("match").alias("m"))
    return m.select("accession", F.col("m._dbname").alias("dbname"), F.col("m._id").alias("match_id"), F.col("m.ipr._id").alias("ipr_id"), F.posexplode("m.lcn").alias("loc", "l")).select(
        "accession", "dbname", "match_id", "ipr_id", "loc", F.col("l._start").alias("start"), F.col("l._end").alias("end")
    )


def read_uniref_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(seed, member)`` rows (the seed is its own member) and ``(seed, seq)``."""
    prop = "array<struct<_type:string,_value:string>>"
    ref = f"struct<_type:string,_id:string,property:{prop}>"
    schema = f"_id string, representativeMember struct<dbReference:{ref},sequence:struct<_VALUE:string,_length:int>>, member array<struct<dbReference:{ref}>>"
    e = xml_elements(spark, path, "entry", schema)
    accession = lambda c: F.get(F.filter(c, lambda p: p["_type"] == "UniProtKB accession"), F.lit(0))["_value"]
    e = e.withColumn("seed", S.strip_isoform(accession(F.col("representativeMember.dbReference.property")))).where("seed is not null")
    m = e.select("seed", F.explode("member.dbReference").alias("d")).where(F.col("d._type") == "UniProtKB ID")
    members = m.select("seed", accession(F.col("d.property")).alias("member")).unionByName(e.select("seed", F.col("seed").alias("member")))
    seqs = e.select("seed", F.regexp_replace("representativeMember.sequence._VALUE", r"\s", "").alias("seq")).where("seq is not null")
    return members.where("member is not null"), seqs


def read_taxonomy_xml(spark: SparkSession, path: str) -> DataFrame:
    """Top-level taxa with their lineage and children as arrays."""
    t = "array<struct<_taxId:int,_rank:string,_scientificName:string>>"
    schema = f"_taxId int, _rank string, _scientificName string, lineage struct<taxon:{t}>, children struct<taxon:{t}>"
    r = xml_elements(spark, path, "taxon", schema, nested=True)
    return r.select(F.col("_taxId").alias("tax_id"), F.col("_rank").alias("rank"), F.col("_scientificName").alias("name"), F.col("lineage.taxon").alias("lineage"), F.col("children.taxon").alias("children"))


def read_embl(spark: SparkSession, path: str) -> DataFrame:
    """Flat-file contigs, one row each: ``(contig, type, blocks)``; a block is the text of one coding feature."""
    r = spark.read.option("lineSep", "\n//").text(path)
    r = r.withColumn("contig", F.regexp_extract("value", r"(?m)^ID\s+(\w+);\s\w\w\s\w;\s(\w+);\s", 1)).where("contig <> ''")
    shape = F.regexp_extract("value", r"(?m)^ID\s+(\w+);\s\w\w\s\w;\s(\w+);\s", 2)
    kind = F.when(shape == "linear", 1).when(shape == "circular", 0).otherwise(F.raise_error(F.concat(F.lit("unknown chromosome type "), shape)))
    blocks = F.split("value", r"\nFT   CDS")
    return r.select("contig", kind.cast("int").alias("type"), F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0))).alias("blocks"))
