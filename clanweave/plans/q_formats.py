"""Queries for readers and writers: data derived from the driver tables is written and read back."""

from pyspark.sql import functions as F

from clanweave.operators import annotate as A
from clanweave.operators import graph as G
from clanweave.operators import neighborhood as N
from clanweave.plans.catalog import query
from clanweave.plans.q_abundance import merged
from clanweave.plans.q_genomes import COOC, CLUSTERED, colors, diagrams, rows
from clanweave.plans.q_network import ATTS, attributes
from clanweave.plans.views import SQL_LETTERS, acc, letters_of
from clanweave.session import scratch_path
from clanweave.sources import readers as R
from clanweave.sources import writers as X
from clanweave.sources.archives import scratch_archives

LINES = "unnest(string_split(rtrim(t, chr(10)), chr(10)))"


def stored(v, df, tag):
    path = scratch_path(v.spark, tag)
    df.write.text(path)
    return path


@query("src01_read_fasta", "select id, id as header, seq, seq_len from sequences")
def _(v):
    path = scratch_path(v.spark, "fasta")
    X.write_fasta(v.sequences, path)
    return R.read_fasta(v.spark, path)


@query("snk01_write_fasta", "with w as (select seq_len, (seq_len + 79) // 80 as n from sequences) select count(*) + sum(greatest(n, 1))::bigint as lines, max(least(seq_len, 80)) as widest from w")
def _(v):
    path = scratch_path(v.spark, "fasta")
    X.write_fasta(v.sequences, path)
    seq = ~F.col("value").startswith(">")
    return v.spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"), F.max(F.when(seq, F.length("value"))).cast("long").alias("widest"))


@query(
    "snk01_fasta_lines",
    "select '>' || id as line from sequences union all select substr(seq, 80 * k + 1, 80) from (select seq, unnest(range(greatest(1, (seq_len + 79) // 80))) as k from sequences)",
)
def _(v):
    path = scratch_path(v.spark, "fasta")
    X.write_fasta(v.sequences, path)
    return v.spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "src02_read_fasta_multi_header",
    """with d as (select doc_id, coalesce(nullif(@LETTERS@, ''), 'X') as seq, row_number() over (order by doc_id) - 1 as ord from documents)
    select ord, case when ord < 10000000 then lpad(ord::varchar, 7, 'z') else ord::varchar end as id, pos, case pos when 0 then 'd' || doc_id else 'alt ' || doc_id end as header, length(seq)::int as seq_len
    from d, (values (0::bigint), (1::bigint)) p(pos)""".replace("@LETTERS@", SQL_LETTERS),
)
def _(v):
    seq = letters_of("text")
    rec = F.concat(F.lit(">d"), F.col("doc_id").cast("string"), F.lit("\n>alt "), F.col("doc_id").cast("string"), F.lit("\n"), F.when(seq == "", "X").otherwise(seq))
    ordered = v.table("documents").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").select(rec.alias("value"))
    return R.read_fasta_multi_header(v.spark, stored(v, ordered, "multi")).drop("seq")


def struct_rows(v):
    return attributes(v).where("value is not null").select(F.col("node_id").alias("id"), F.col("name").alias("field"), "value")


@query("src03_read_struct", f"with {ATTS} select node_id as id, name as field, value from atts where value is not null")
def _(v):
    path = scratch_path(v.spark, "struct")
    X.write_struct(struct_rows(v), path)
    return R.read_struct(v.spark, path)


@query("snk05_write_struct", f"with {ATTS}, a as (select * from atts where value is not null) select (select count(distinct node_id) from a) as ids, (select count(*) from a) as fields")
def _(v):
    path = scratch_path(v.spark, "struct")
    X.write_struct(struct_rows(v), path)
    return v.spark.read.text(path).agg(F.count_if(~F.col("value").startswith("\t")).alias("ids"), F.count_if(F.col("value").startswith("\t")).alias("fields"))


@query("snk05_struct_lines", f"with {ATTS}, a as (select * from atts where value is not null) select distinct node_id as line from a union all select chr(9) || name || chr(9) || value from a")
def _(v):
    path = scratch_path(v.spark, "struct")
    X.write_struct(struct_rows(v), path)
    return v.spark.read.text(path).withColumnRenamed("value", "line")


@query("src04_read_blast_tab", "select src, dst, pid, alen, bitscore from hits")
def _(v):
    h = v.hits
    zero = F.lit("0")
    line = F.concat_ws("\t", "src", "dst", "pid", "alen", zero, zero, zero, zero, zero, zero, F.lit("1e-9"), "bitscore")
    notes = h.select(F.concat(F.lit("# Query: "), "src").alias("value"))
    return R.read_blast_tab(v.spark, stored(v, h.select(line.alias("value")).unionByName(notes), "blast"))


@query("src04_read_edges", "select src, dst, pid, alen, bitscore, src_len, dst_len from edges")
def _(v):
    path = scratch_path(v.spark, "edges")
    v.edges.select("src", "dst", "pid", "alen", "bitscore", "src_len", "dst_len").write.csv(path, sep="\t")
    return R.read_edges(v.spark, path)


@query("src05_read_cdhit_clusters", "select rep, member from members")
def _(v):
    m = v.members
    line = F.concat(F.lit("0\t100aa, >"), "member", F.when(F.col("rep") == F.col("member"), "... *").otherwise("... at 95.00%"))
    rows = m.select("rep", F.lit(1).alias("k"), line.alias("value")).unionByName(m.select("rep").distinct().select("rep", F.lit(0).alias("k"), F.concat(F.lit(">Cluster "), "rep").alias("value")))
    placed = rows.repartitionByRange(4, "rep").sortWithinPartitions("rep", "k", "value")
    return R.read_cdhit_clusters(v.spark, stored(v, placed.select("value"), "clstr"))


def xgmml_path(v):
    path = scratch_path(v.spark, "xgmml")
    label = v.nodes.select(F.col("node").alias("node_id"), F.col("node").alias("label"))
    atts = v.annotations.select(F.col("accession").alias("node_id"), F.lit("Organism").alias("name"), F.lit("string").alias("type"), F.concat(F.lit("<a&b> "), "Organism").alias("value"))
    atts = atts.unionByName(v.node_atts.select("node_id", "name", F.lit("list").alias("type"), "value"))
    X.write_xgmml(label, atts, G.network_edges(v.kept).drop("label"), path, "Test")
    return path


@query("src06_read_xgmml_edges", "select src, dst from kept")
def _(v):
    return R.read_xgmml(v.spark, xgmml_path(v))["edges"]


@query(
    "src06_read_xgmml_attributes",
    """select accession as node_id, 'Organism' as name, '<a&b> ' || "Organism" as value, 'string' as type from annotations union all select node_id, name, value, 'list' from node_atts""",
)
def _(v):
    return R.read_xgmml(v.spark, xgmml_path(v))["node_atts"]


@query(
    "snk04_write_xgmml",
    """select (select count(*) from nodes) as nodes, (select count(*) from kept) as edges, (select count(*) from annotations) + (select count(*) from node_atts) as atts, (select count(distinct node_id) from node_atts) as lists""",
)
def _(v):
    lines = v.spark.read.text(xgmml_path(v))
    n = lambda p: F.count_if(F.col("value").startswith(p))
    return lines.agg(n("<node ").alias("nodes"), n("<edge ").alias("edges"), n("<att name=").alias("atts"), n('<att type="list"').alias("lists"))


XML_TEXT = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query(
    "snk04_xgmml_lines",
    f"""with a as (select accession as node_id, 'Organism' as name, '<a&b> ' || "Organism" as value, false as listed from annotations union all select node_id, name, value, true from node_atts)
    select '<att name="' || {XML_TEXT.format('name')} || '" type="string" value="' || {XML_TEXT.format("coalesce(value, '')")} || '" />' as line from a
    union all select '<att type="list" name="' || {XML_TEXT.format('name')} || '">' from (select distinct node_id, name from a where listed) union all select '</att>' from (select distinct node_id, name from a where listed)
    union all select '<node id="' || {XML_TEXT.format('node')} || '" label="' || {XML_TEXT.format('node')} || '">' from nodes union all select '</node>' from nodes""",
)
def _(v):
    """All lines about nodes; the edges are compared by ``src06_read_xgmml_edges``."""
    return v.spark.read.text(xgmml_path(v)).withColumnRenamed("value", "line").where("line like '<att%' or line like '</att%' or line like '<node%' or line like '</node%'")


@query("src07_read_id_list", "select distinct id from (select 'A' || (1000000 + o_custkey) as id from orders union all select 'B' || o_custkey from orders)")
def _(v):
    line = F.concat(acc("o_custkey"), F.lit(",, B"), F.col("o_custkey").cast("string"), F.lit("\r"))
    return R.read_id_list(v.spark, stored(v, v.table("orders").select(line.alias("value")), "ids"))


@query("src08_read_id_evalue_list", "select 'A' || (1000000 + p_partkey) as id, p_size / 4.0::double as evalue, row_number() over (order by p_partkey) - 1 as ord from part")
def _(v):
    item = F.concat(acc("p_partkey"), F.lit("|"), (F.col("p_size") / 4.0).cast("string"), F.lit(","))
    lines = v.table("part").repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").select(item.alias("value"))
    return R.read_id_evalue_list(v.spark, stored(v, lines, "evalues"))


def matrix_path(v):
    path = scratch_path(v.spark, "matrix")
    X.write_matrix(merged(v), path)
    return path


def one_header(v, path):
    """The matrix in one piece per part, each under the header line, as a merged run folder would hold it."""
    lines = v.spark.read.text(path)
    head = lines.where(F.col("value").startswith("Feature")).first()[0]
    out = scratch_path(v.spark, "csv")
    names = head.split("\t")
    body = lines.where(~F.col("value").startswith("Feature"))
    part = F.split("value", "\t")
    body.select(*[part[i].alias(n) for i, n in enumerate(names)]).write.csv(out, sep="\t", header=True)
    return out


CELLS = """cmap as (select 'A' || (1000000 + p_partkey) as protein, p_size::varchar as cluster from part where p_size <= 40),
    merged as (select a.sample, coalesce(c.cluster, '#N/A') as cluster, a.protein, a.value from abundance a left join cmap c on c.protein = a.protein),
    cells as (select f.cluster, f.protein, s.sample, coalesce(m.value, 0) as value from (select distinct cluster, protein from merged) f, (select distinct sample from merged) s left join merged m on m.cluster = f.cluster and m.protein = f.protein and m.sample = s.sample)"""
CELLS = CELLS.replace("(select distinct cluster, protein from merged) f, (select distinct sample from merged) s left join", "(select distinct cluster, protein from merged) f cross join (select distinct sample from merged) s left join")


@query("src09_read_abundance", f"with {CELLS} select protein as feature, cluster, sample, value from cells")
def _(v):
    return R.read_abundance(v.spark, one_header(v, matrix_path(v)))


@query(
    "snk07_write_matrix",
    f"with {CELLS} select cluster || '|' || protein || chr(9) || string_agg(value::bigint::varchar, chr(9) order by sample) as line from cells group by cluster, protein union all select 'Feature \\ Sample' || chr(9) || string_agg(sample, chr(9) order by sample) from (select distinct sample from merged)",
)
def _(v):
    return v.spark.read.text(matrix_path(v)).withColumnRenamed("value", "line")


@query(
    "src10_read_sample_catalog",
    "select 'S' || s_suppkey as sample, case when s_suppkey % 3 = 0 then 'gut' else 'oral' end as bodysite, case when s_suppkey % 2 = 0 then 'male' else 'female' end as gender, '/data/S' || s_suppkey || '.fa' as file_path from supplier",
)
def _(v):
    s = F.col("s_suppkey")
    name = F.when(s % 3 == 0, "x1 - gut ").otherwise("oral")
    line = F.concat_ws("\t", F.concat(F.lit("S"), s), name, F.when(s % 2 == 0, "male").otherwise("female"), F.concat(F.lit("/data/S"), s, F.lit(".fa")))
    notes = v.table("supplier").select(F.concat(F.lit("# "), "s_name").alias("value"))
    return R.read_sample_catalog(v.spark, stored(v, v.table("supplier").select(line.alias("value")).unionByName(notes), "catalog"))


@query("src10_read_bodysites", "select distinct c_mktsegment as bodysite, '#' || length(c_mktsegment) as color, length(c_mktsegment)::int as position from customer")
def _(v):
    c = v.table("customer").select("c_mktsegment").distinct()
    line = F.concat_ws("\t", "c_mktsegment", F.concat(F.lit("#"), F.length("c_mktsegment")), F.length("c_mktsegment"))
    return R.read_bodysites(v.spark, stored(v, c.select(line.alias("value")), "sites"))


@query("src11_read_cluster_map", "select case when p_size % 4 = 0 then 'N/A' else p_size::varchar end as cluster, 'A' || (1000000 + p_partkey) as protein from part")
def _(v):
    line = F.concat(F.when(F.col("p_size") % 4 == 0, "").otherwise(F.col("p_size").cast("string")), F.lit("\t"), acc("p_partkey"))
    return R.read_cluster_map(v.spark, stored(v, v.table("part").select(line.alias("value")), "cmap"))


@query("src17_read_fastq", "select l_orderkey || '_' || l_linenumber as read_id, repeat('ACGT', l_quantity::int) as seq, (4 * l_quantity)::int as len from lineitem")
def _(v):
    rid = F.concat(F.lit("@"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"), F.lit(" x"))
    seq = F.repeat(F.lit("ACGT"), F.col("l_quantity").cast("int"))
    rec = F.concat_ws("\n", rid, seq, F.lit("+"), F.repeat(F.lit("@III"), F.col("l_quantity").cast("int")))
    path = scratch_path(v.spark, "reads") + ".fastq"
    v.table("lineitem").select(rec.alias("value")).write.text(path)
    return R.read_metagenome_reads(v.spark, path).drop("sample")


@query("src17_read_archived_reads", "select l_orderkey || '_' || l_linenumber as read_id, repeat('ACGT', l_quantity::int) as seq, (4 * l_quantity)::int as len from lineitem")
def _(v):
    """Members are dealt over compressed archives, each written and read back by a task."""
    rid = F.concat(F.lit("@"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"))
    rec = F.concat_ws("\n", rid, F.repeat(F.lit("ACGT"), F.col("l_quantity").cast("int")), F.lit("+"), F.repeat(F.lit("IIII"), F.col("l_quantity").cast("int")))
    return R.read_archived_reads(v.spark, scratch_archives(v.table("lineitem").select(rec.alias("value")), "fastq")).drop("sample")


@query("src17_read_archived_fasta", "select id as read_id, seq_len as len from sequences where seq_len > 0")
def _(v):
    """Plain archives, whose members are read in pieces."""
    rec = X.fasta_record(F.col("id"), F.col("seq")).alias("value")
    return R.read_archived_reads(v.spark, scratch_archives(v.sequences.where("seq_len > 0").select(rec), "fasta", kind="")).select("read_id", "len")


@query("src17_read_fasta_reads", "select id as read_id, seq_len as len from sequences where seq_len > 0")
def _(v):
    path = scratch_path(v.spark, "reads") + ".fa"
    X.write_fasta(v.sequences.where("seq_len > 0"), path)
    return R.read_metagenome_reads(v.spark, path).select("read_id", "len")


@query("src17_read_short_fasta_reads", "select id as read_id, seq_len as len from sequences where seq_len > 0 and seq_len < 50000")
def _(v):
    path = scratch_path(v.spark, "reads") + ".fa"
    X.write_fasta(v.sequences.where("seq_len > 0"), path)
    return R.read_metagenome_reads(v.spark, path, skip_long=True).select("read_id", "len")


@query(
    "src18_read_annotation_tables",
    """select 'A' || (1000000 + p_partkey) as accession, case when p_size > 40 then 'Reviewed' else 'Unreviewed' end as "STATUS", p_size as "Taxonomy_ID", p_size % 7 = 0 as "Fragment", case when p_size % 5 = 0 then 2 end as structures from part""",
)
def _(v):
    folder = scratch_path(v.spark, "tables")
    a = v.annotations
    pdb = F.when(F.col("PDB").isNotNull(), F.concat("PDB", F.lit(",2XYZ"))).otherwise("None")
    none = F.lit("None")
    line = F.concat_ws("\t", "accession", none, "STATUS", "Sequence_Length", "Taxonomy_ID", none, "Description", none, "Organism", none, pdb, *[none] * 8, F.coalesce("EC", none), none, F.col("Fragment").cast("int"), none)
    a.select(line.alias("value")).write.text(f"{folder}/annotations.tab")
    t = R.read_annotation_tables(v.spark, folder, ["annotations"])["annotations"]
    return t.select("accession", "STATUS", "Taxonomy_ID", "Fragment", F.when(F.col("pdb").isNotNull(), F.size("pdb")).alias("structures"))


@query(
    "snk02_write_fasta_per_cluster",
    """select 'file=cluster_' || a."Taxonomy_ID" as file, '>' || s.id || ' ' || a."Taxonomy_ID" || '|' || a."Organism" || '|' || coalesce(p.l, 'Unknown') as header from sequences s join annotations a on a.accession = s.id
    left join (select accession, string_agg(id, ',' order by id) as l from (select distinct accession, id from family_match) group by 1) p on p.accession = s.id""",
)
def _(v):
    folder = scratch_path(v.spark, "clusters")
    seqs = v.sequences.join(v.annotations.select(F.col("accession").alias("id"), F.col("Taxonomy_ID").alias("cluster")), "id").select("id", "cluster", "seq")
    X.write_fasta_per_cluster(X.fasta_per_cluster(seqs, v.annotations, A.family_lists(v.family_match, "PFAM")), folder)
    lines = v.spark.read.text(f"{folder}/per_cluster").where(F.col("value").startswith(">"))
    return lines.select(F.concat(F.lit("file="), "file").alias("file"), F.col("value").alias("header"))


IDS = """ids as (select distinct n.seq_number as cluster, m.member as id, n.singleton_number is not null as single from comp c join metanode m on m.node_id = c.node join numbered n on n.component = c.component)"""


def cluster_ids(v):
    ids = G.cluster_members(v.comp, v.metanode).join(v.numbered, "component")
    return ids.select(F.col("seq_number").alias("cluster"), "id", F.col("singleton_number").isNotNull().alias("single"))


@query(
    "snk03_write_id_lists",
    f"""with {IDS} select case when single then 'singleton_UniProt_IDs' else 'cluster_UniProt_IDs_' || cluster end as file, id from ids union all select 'cluster_All_UniProt_IDs', id from ids where not single""",
)
def _(v):
    folder = scratch_path(v.spark, "idlists")
    X.write_id_lists_per_cluster(cluster_ids(v), folder, "UniProt")
    return R.read_id_lists(v.spark, folder)


@query("snk06_write_neighborhood_tables", "select (select count(*) from chosen) as attributes, (select count(*) from neighbors) as neighbors, (select count(distinct family) from neighbors) as families, (select count(distinct uniref50_seed) from uniref join chosen on query = accession) as clusters")
def _(v):
    folder = scratch_path(v.spark, "diagram")
    X.write_neighborhood_tables(diagrams(v), folder)
    out = None
    for name, col in (("attributes", "attributes"), ("neighbors", "neighbors"), ("families", "families"), ("cluster_index", "clusters")):
        n = v.spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n"))
        row = n.select(*[F.col("n").alias(c) if c == col else F.lit(0).cast("long").alias(c) for c in ("attributes", "neighbors", "families", "clusters")])
        out = row if out is None else out.unionByName(row)
    return out.agg(*[F.sum(c).alias(c) for c in ("attributes", "neighbors", "families", "clusters")])


@query(
    "snk08_write_pfam_neighbor_files",
    f"""with {COOC}, l as (select query, neighbor, r.family, r.cluster, '#' || substr(r.cluster, 2, 6) as color, printf('%02d', abs(distance)) as distance,
    case when query_direction = 0 then 'complement' else 'normal' end || '-' || case when direction = 0 then 'complement' else 'normal' end as directions, ratio
    from rows r join cooc c on c.cluster = r.cluster and c.family = r.family)
    select 'any' as variant, family, concat_ws(chr(9), query, neighbor, family, cluster, color, distance, directions) as line from l
    union all select distinct 'threshold_split', f, concat_ws(chr(9), query, neighbor, f, cluster, color, distance, directions) from (select *, unnest(string_split(family, '-')) as f from l where ratio >= 0.3)""",
)
def _(v):
    folder = scratch_path(v.spark, "pfam")
    r, c = rows(v), colors(v)
    X.write_pfam_neighbor_files({"any": N.neighbor_long(r, c), "threshold_split": N.neighbor_long(r, c, 0.3, split=True)}, folder)
    read = lambda n: v.spark.read.text(f"{folder}/{n}").select(F.lit(n).alias("variant"), "family", F.col("value").alias("line"))
    return read("any").unionByName(read("threshold_split"))


@query(
    "wn10_order_attributes",
    f"""with {ATTS} select distinct name, case name when 'Organism' then 5 when 'Sequence_Length' then 10 when 'PDB' then 25 else 999 end as position from atts union all select distinct "Organism", 999 from annotations""",
)
def _(v):
    names = attributes(v).select("name").unionByName(v.annotations.select(F.col("Organism").alias("name")))
    return X.order_attributes(names)
