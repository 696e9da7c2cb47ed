"""Protein-shaped views over the driver's star schema.

Each view is one pass over a whole driver table (no row subsets) and comes in two forms: a DataFrame and
the SQL text of the same relation, so a query and its SQL check start from identical input.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clanweave.functions import scalar as S
from clanweave.functions.ordered import rank_within
from clanweave.operators import edges as E
from clanweave.operators import graph as G
from clanweave.session import materialize

MIN_SCORE = 26
WINDOW = 10


# Letters with marks stand for the plain ones, so that texts of all languages keep their letters as residues.
MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝßàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
UNMARKED = "AAAAAACEEEEIIIINOOOOOOUUUUYsaaaaaaceeeeiiiinoooooouuuuyy"
SQL_LETTERS = f"upper(regexp_replace(translate(text, '{MARKED}', '{UNMARKED}'), '[^A-Za-z]', '', 'g'))"


def letters_of(text: str):
    """The letters of a text in upper case, as a sequence of residues."""
    return F.upper(F.regexp_replace(F.translate(text, MARKED, UNMARKED), "[^A-Za-z]", ""))


def acc(key):
    """Accession of a numeric key: ``A`` + 7 or more digits."""
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("A"), (key + 1_000_000).cast("string"))


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- similarity ------------------------------------------------------------------------------
    @property
    def hits(self) -> DataFrame:
        a = F.col("l_partkey")
        b = F.col("l_suppkey") * 20 + F.col("l_orderkey") % 20
        return self.table("lineitem").select(
            acc(a).alias("src"),
            acc(b).alias("dst"),
            (F.lit(30.0) + (F.col("l_quantity") + 3 * F.col("l_linenumber")) % 70).alias("pid"),
            (F.lit(20) + (a * F.col("l_suppkey")) % 80).cast("int").alias("alen"),
            (F.col("l_quantity") * 2 + F.col("l_linenumber")).alias("bitscore"),
            (F.lit(100) + a % 500).cast("int").alias("src_len"),
            (F.lit(100) + b % 500).cast("int").alias("dst_len"),
        )

    @property
    def edges(self) -> DataFrame:
        return E.best_edge_per_pair(E.drop_self_edges(E.canonicalize_edges(self.hits)))

    @property
    def kept(self) -> DataFrame:
        """Edges at or above the score: for one pair the score rises with the bitscore, so filtering first is the same."""
        passing = E.filter_edges(E.drop_self_edges(E.canonicalize_edges(self.hits)), by="eval", min_value=MIN_SCORE)
        return E.best_edge_per_pair(passing)

    @property
    def nodes(self) -> DataFrame:
        return self.table("part").select(acc("p_partkey").alias("node"))

    @cached_property
    def comp(self) -> DataFrame:
        return materialize(G.connected_components(self.nodes, self.kept), "comp")

    @property
    def members(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(acc(k - k % 3).alias("rep"), acc(k).alias("member"))

    @property
    def node_atts(self) -> DataFrame:
        """List attribute rows: every node names itself and up to two more IDs."""
        extra = F.explode(F.sequence(F.lit(0), F.col("p_size") % 3))
        return self.table("part").select(acc("p_partkey").alias("node_id"), extra.alias("i")).select(
            "node_id",
            F.lit("UniRef90 Cluster IDs").alias("name"),
            F.lit("list").alias("type"),
            F.when(F.col("i") == 0, F.col("node_id")).otherwise(F.concat("node_id", F.lit("V"), "i")).alias("value"),
        )

    @property
    def metanode(self) -> DataFrame:
        return G.expand_metanodes(self.nodes, self.node_atts)

    @cached_property
    def numbered(self) -> DataFrame:
        return materialize(G.number_clusters(self.comp, self.metanode), "numbered")

    @property
    def palette(self) -> DataFrame:
        return self.table("part").select(F.col("p_size").alias("cluster")).distinct().select(
            "cluster", F.concat(F.lit("#"), F.lpad((F.col("cluster") * 12345).cast("string"), 6, "0")).alias("color")
        )

    # ---- annotation ------------------------------------------------------------------------------
    @property
    def annotations(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        reviewed = size > 40
        return self.table("part").select(
            acc(k).alias("accession"),
            F.when(reviewed, "Reviewed").otherwise("Unreviewed").alias("STATUS"),
            (F.lit(100) + k % 500).cast("int").alias("Sequence_Length"),
            size.alias("Taxonomy_ID"),
            F.col("p_type").alias("Organism"),
            F.col("p_name").alias("Description"),
            F.when(reviewed, F.col("p_name")).alias("SwissProt_Description"),
            F.when(size % 5 == 0, F.concat(F.lit("1"), F.substring(F.col("p_type"), 1, 3))).alias("PDB"),
            (size % 7 == 0).alias("Fragment"),
            F.when(size % 4 == 0, F.concat(F.lit("1.1.1."), size.cast("string"))).alias("EC"),
        )

    @property
    def taxonomy(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("Taxonomy_ID"), F.col("r_name").alias("Domain"), F.col("n_name").alias("Species")
        )

    @property
    def family_match(self) -> DataFrame:
        k, ln = F.col("l_partkey"), F.col("l_linenumber")
        return self.table("lineitem").select(
            F.concat(F.lit("PF"), (F.lit(10000) + (k + ln % 2) % 40).cast("string")).alias("id"),
            acc(k).alias("accession"),
            (100 * ln).alias("start"),
            (100 * ln + F.col("l_quantity")).cast("int").alias("end"),
        )

    @property
    def gene_matches(self) -> DataFrame:
        """The matches that name a gene's family."""
        return self.family_match

    @property
    def interpro_match(self) -> DataFrame:
        k, ln = F.col("l_partkey"), F.col("l_linenumber")
        kind = (k + ln) % 4
        return self.table("lineitem").select(
            F.concat(F.lit("IPR"), (F.lit(100000) + (k * 7 + ln) % 60).cast("string")).alias("id"),
            acc(k).alias("accession"),
            (100 * ln).alias("start"),
            (100 * ln + F.col("l_quantity")).cast("int").alias("end"),
            F.when(kind == 0, "Domain").when(kind == 1, "Family").when(kind == 2, "Homologous_superfamily").otherwise("Repeat").alias("family_type"),
        )

    @property
    def clans(self) -> DataFrame:
        """Clan of each Pfam family that occurs."""
        n = F.substring("id", 3, 9).cast("int")
        return self.family_match.select("id").distinct().select(
            F.col("id").alias("pfam_id"), F.concat(F.lit("CL"), (n % 6).cast("string")).alias("clan_id")
        )

    @property
    def uniref(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            acc(k).alias("accession"), acc(k - k % 20).alias("uniref50_seed"), acc(k - k % 5).alias("uniref90_seed")
        )

    @property
    def family_names(self) -> DataFrame:
        n = F.substring("id", 3, 9).cast("int")
        return self.family_match.select("id").distinct().select(
            F.col("id").alias("family"),
            F.when(n % 3 != 0, F.concat(F.lit("fam"), n.cast("string"))).alias("short_name"),
            F.when(n % 5 != 0, F.concat(F.lit("long family "), n.cast("string"))).alias("long_name"),
        )

    @property
    def idmapping(self) -> DataFrame:
        k = F.col("p_partkey")
        kind = k % 3
        return self.table("part").select(
            acc(k).alias("uniprot_id"),
            F.when(kind == 0, "gi").when(kind == 1, "refseq").otherwise("embl-cds").alias("foreign_id_type"),
            F.when(kind == 0, (k + 500000).cast("string"))
            .when(kind == 1, F.concat(F.lit("WP_"), (k + 500000).cast("string")))
            .otherwise(F.concat(F.lit("CAA"), F.lpad((k % 100000).cast("string"), 5, "0")))
            .alias("foreign_id"),
        )

    @property
    def query_ids(self) -> DataFrame:
        """A mixed list of identifiers, one per order: foreign, UniProt, prefixed and unusable ones."""
        k = F.col("o_custkey")
        kind = F.col("o_orderkey") % 5
        return self.table("orders").select(
            F.when(kind == 0, (k + 500000).cast("string"))
            .when(kind == 1, F.concat(F.lit("WP_"), (k + 500000).cast("string")))
            .when(kind == 2, F.concat(F.lit("tr|"), acc(k)))
            .when(kind == 3, acc(k * 3))
            .otherwise(F.concat(F.lit("??"), k.cast("string")))
            .alias("id")
        )

    # ---- sequences -------------------------------------------------------------------------------
    @property
    def sequences(self) -> DataFrame:
        seq = letters_of("text")
        return self.table("documents").select(
            acc("doc_id").alias("id"),
            F.concat(acc("doc_id"), F.lit(" "), "source").alias("header"),
            seq.alias("seq"),
            F.length(seq).alias("seq_len"),
        )

    # ---- genomes ---------------------------------------------------------------------------------
    @cached_property
    def genes(self) -> DataFrame:
        # Numbers are dealt and sorted, names are made of them afterwards.
        raw = self.table("lineitem").select(
            "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("qty"),
            F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("DIRECTION"),
        )
        placed = rank_within(raw, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "qty", "DIRECTION"], "NUM")
        return materialize(
            placed.select(
                F.concat(F.lit("CT"), F.col("l_suppkey").cast("string")).alias("ID"), acc("l_partkey").alias("AC"), "NUM",
                (F.col("l_suppkey") % 2).cast("int").alias("TYPE"), "DIRECTION",
                (1000 * F.col("NUM")).alias("start"),
                (1000 * F.col("NUM") + 30 * F.col("qty")).alias("stop"),
            ),
            "genes",
        )

    @property
    def gene_queries(self) -> DataFrame:
        return self.nodes.select(F.col("node").alias("query"))

    @cached_property
    def placed(self) -> DataFrame:
        from clanweave.operators import neighborhood as N

        return materialize(N.choose_genome(self.gene_queries, self.genes), "placed")

    @cached_property
    def neighbors(self) -> DataFrame:
        from clanweave.operators import neighborhood as N

        found = N.find_neighbors(self.gene_queries, self.genes, WINDOW, placed=self.placed)
        return materialize(N.attach_gene_families(found, N.fuse_families(self.gene_matches), "family"), "neighbors")

    # ---- abundance -------------------------------------------------------------------------------
    @property
    def abundance(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy(
                F.concat("l_returnflag", "l_linestatus").alias("sample"),
                F.concat(F.lit(""), (F.lit(1) + F.col("l_partkey") % 25).cast("string")).alias("cluster"),
                acc("l_partkey").alias("protein"),
            )
            .agg(F.sum("l_quantity").alias("value"))
        )

    @property
    def marker_hits(self) -> DataFrame:
        ln = F.col("l_linenumber")
        kind = F.when(ln <= 3, "TM").when(ln <= 5, "JM").otherwise("QM")
        return self.table("lineitem").select(
            F.concat("l_returnflag", "l_linestatus").alias("sample"),
            F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("read_id"),
            F.concat(acc("l_partkey"), F.lit("_"), kind, F.lit("_#0"), ln.cast("string")).alias("marker"),
            (F.lit(90.0) + F.col("l_quantity") % 11).alias("pid"),
            F.col("l_quantity").cast("int").alias("alen"),
            (F.lit(80) + 10 * (F.col("l_orderkey") % 7)).cast("int").alias("read_len"),
        )

    @property
    def markers(self) -> DataFrame:
        """The marker catalogue: seven markers per family."""
        ln = F.explode(F.sequence(F.lit(1), F.lit(7)))
        rows = self.table("part").select("p_partkey", ln.alias("ln"))
        kind = F.when(F.col("ln") <= 3, "TM").when(F.col("ln") <= 5, "JM").otherwise("QM")
        return rows.select(
            F.concat(acc("p_partkey"), F.lit("_"), kind, F.lit("_#0"), F.col("ln").cast("string")).alias("marker"),
            acc("p_partkey").alias("family"),
            kind.alias("type"),
            (F.lit(8) + (F.col("p_partkey") + F.col("ln")) % 33).cast("int").alias("marker_len"),
        )

    @property
    def self_hits(self) -> DataFrame:
        """Local alignments between consensus sequences: interval on the query, whole query length."""
        ln, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
        k = F.col("l_partkey")
        start = (F.lit(1) + (F.col("l_orderkey") * 13) % 150).cast("int")
        return self.table("lineitem").select(
            acc(k).alias("query"),
            acc(F.col("l_suppkey") * 20 + F.col("l_orderkey") % 20).alias("subject"),
            (F.lit(85.0) + (q + ln) % 16).alias("pid"),
            q.alias("alen"),
            start.alias("qstart"),
            F.least(start + q - 1, F.lit(200)).cast("int").alias("qend"),
            F.lit(200).alias("qlen"),
        )

    @property
    def consensus(self) -> DataFrame:
        """One 200-residue consensus per part, built by repeating its name."""
        letters = F.upper(F.regexp_replace(F.concat("p_name", "p_type"), "[^A-Za-z]", ""))
        return self.table("part").select(
            acc("p_partkey").alias("family"), F.substring(F.repeat(letters, 40), 1, 200).alias("seq")
        )


# The same relations as SQL text, in dependency order.
SQL_VIEWS = {
    "hits": """select 'A' || (1000000 + a) as src, 'A' || (1000000 + b) as dst,
        30.0::double + (l_quantity + 3 * l_linenumber) % 70 as pid, (20 + (a * l_suppkey) % 80)::int as alen,
        l_quantity * 2 + l_linenumber as bitscore, (100 + a % 500)::int as src_len, (100 + b % 500)::int as dst_len
        from (select *, l_partkey as a, l_suppkey * 20 + l_orderkey % 20 as b from lineitem)""",
    "canon": """select case when src <= dst then src else dst end as src, case when src <= dst then dst else src end as dst,
        pid, alen, bitscore, case when src <= dst then src_len else dst_len end as src_len,
        case when src <= dst then dst_len else src_len end as dst_len from hits""",
    "edges": """select src, dst, pid, alen, bitscore, src_len, dst_len from (select *, row_number() over
        (partition by src, dst order by bitscore desc, pid desc, alen desc) as rn from canon where src <> dst) where rn = 1""",
    "scored": """select *, trunc(-log10(src_len::double * dst_len::double) + bitscore * log10(2.0::double))::int as score from edges""",
    "kept": f"select src, dst, pid, alen, bitscore, src_len, dst_len from scored where score >= {MIN_SCORE}",
    "nodes": "select 'A' || (1000000 + p_partkey) as node from part",
    "und": "select src as a, dst as b from kept union select dst, src from kept",
    "reach(a, l)": "select a, a from und union select u.b, r.l from reach r join und u on u.a = r.a",
    "comp": """select n.node, coalesce(min(r.l), n.node) as component from nodes n left join reach r on r.a = n.node group by n.node""",
    "members": "select 'A' || (1000000 + p_partkey - p_partkey % 3) as rep, 'A' || (1000000 + p_partkey) as member from part",
    "node_atts": """select node_id, 'UniRef90 Cluster IDs' as name, case when i = 0 then node_id else node_id || 'V' || i end as value
        from (select 'A' || (1000000 + p_partkey) as node_id, unnest(range(0, p_size % 3 + 1)) as i from part)""",
    "metanode": "select node as node_id, node as member from nodes union select node_id, value from node_atts",
    "csize": """select component, count(*) as node_count, sum(n)::bigint as seq_count, min(node) as min_id from comp join
        (select node_id, count(*) as n from metanode group by node_id) m on m.node_id = comp.node group by component""",
    "numbered": """select component, node_count, seq_count, min_id, row_number() over (order by seq_count desc, min_id) as seq_number,
        row_number() over (order by node_count desc, min_id) as node_number,
        case when seq_count < 2 then row_number() over (partition by seq_count < 2 order by min_id) end as singleton_number
        from csize""",
    "palette": "select distinct p_size as cluster, '#' || lpad((p_size * 12345)::varchar, 6, '0') as color from part",
    "annotations": """select 'A' || (1000000 + p_partkey) as accession, case when p_size > 40 then 'Reviewed' else 'Unreviewed' end as "STATUS",
        (100 + p_partkey % 500)::int as "Sequence_Length", p_size as "Taxonomy_ID", p_type as "Organism", p_name as "Description",
        case when p_size > 40 then p_name end as "SwissProt_Description",
        case when p_size % 5 = 0 then '1' || substr(p_type, 1, 3) end as "PDB", p_size % 7 = 0 as "Fragment",
        case when p_size % 4 = 0 then '1.1.1.' || p_size end as "EC" from part""",
    "taxonomy": """select n_nationkey as "Taxonomy_ID", r_name as "Domain", n_name as "Species" from nation join region on n_regionkey = r_regionkey""",
    "family_match": """select 'PF' || (10000 + (l_partkey + l_linenumber % 2) % 40) as id, 'A' || (1000000 + l_partkey) as accession,
        100 * l_linenumber as start, (100 * l_linenumber + l_quantity)::int as "end" from lineitem""",
    "interpro_match": """select 'IPR' || (100000 + (l_partkey * 7 + l_linenumber) % 60) as id, 'A' || (1000000 + l_partkey) as accession,
        100 * l_linenumber as start, (100 * l_linenumber + l_quantity)::int as "end",
        case (l_partkey + l_linenumber) % 4 when 0 then 'Domain' when 1 then 'Family' when 2 then 'Homologous_superfamily' else 'Repeat' end as family_type
        from lineitem""",
    "clans": "select distinct id as pfam_id, 'CL' || (substr(id, 3)::int % 6) as clan_id from family_match",
    "uniref": """select 'A' || (1000000 + p_partkey) as accession, 'A' || (1000000 + p_partkey - p_partkey % 20) as uniref50_seed,
        'A' || (1000000 + p_partkey - p_partkey % 5) as uniref90_seed from part""",
    "family_names": """select distinct id as family, case when substr(id, 3)::int % 3 <> 0 then 'fam' || substr(id, 3)::int end as short_name,
        case when substr(id, 3)::int % 5 <> 0 then 'long family ' || substr(id, 3)::int end as long_name from family_match""",
    "idmapping": """select 'A' || (1000000 + p_partkey) as uniprot_id,
        case p_partkey % 3 when 0 then 'gi' when 1 then 'refseq' else 'embl-cds' end as foreign_id_type,
        case p_partkey % 3 when 0 then (p_partkey + 500000)::varchar when 1 then 'WP_' || (p_partkey + 500000)
        else 'CAA' || lpad((p_partkey % 100000)::varchar, 5, '0') end as foreign_id from part""",
    "query_ids": """select case o_orderkey % 5 when 0 then (o_custkey + 500000)::varchar when 1 then 'WP_' || (o_custkey + 500000)
        when 2 then 'tr|A' || (1000000 + o_custkey) when 3 then 'A' || (1000000 + o_custkey * 3) else '??' || o_custkey end as id from orders""",
    "sequences": """select 'A' || (1000000 + doc_id) as id, 'A' || (1000000 + doc_id) || ' ' || source as header,
        @LETTERS@ as seq, length(@LETTERS@)::int as seq_len from documents""".replace("@LETTERS@", SQL_LETTERS),
    "genes": """select "ID", "AC", "NUM", "TYPE", "DIRECTION", 1000 * "NUM" as start, 1000 * "NUM" + 30 * qty as stop from (
        select 'CT' || l_suppkey as "ID", 'A' || (1000000 + l_partkey) as "AC", (l_suppkey % 2)::int as "TYPE",
        case when l_returnflag = 'N' then 1 else 0 end as "DIRECTION", l_quantity::int as qty,
        row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_quantity,
            case when l_returnflag = 'N' then 1 else 0 end) as "NUM" from lineitem)""",
    "contigs": 'select "ID", max("NUM") as max_num, max("TYPE") as type from genes group by "ID"',
    "placed": """select "AC" as query, "ID" as contig, max("TYPE") as type, min("NUM") as num, arg_min("DIRECTION", "NUM") as direction,
        min(start) as start, arg_min(stop, "NUM") as stop from genes where "AC" in (select node from nodes) group by 1, 2""",
    "chosen": """select query, contig, type, max_num, num, direction, start, stop from (select p.*, c.max_num,
        row_number() over (partition by query order by p.type, case when p.type = 0 then -c.max_num else 0 end,
        case when p.type = 1 and num > 10 then 0 else 1 end, case when p.type = 1 and num < c.max_num - 10 then 0 else 1 end,
        case when p.type = 1 then abs(num::double / c.max_num - 0.5) else 0 end, contig) as rn
        from placed p join contigs c on c."ID" = p.contig) where rn = 1""",
    "near": f"""select c.query, g."AC" as neighbor, g."NUM" as num, g."DIRECTION" as direction, c.contig, c.type, c.num as query_num, c.max_num,
        c.direction as query_direction, g.start, g.stop, o.off as distance from chosen c join (select unnest(range(-{WINDOW}, {WINDOW + 1}))::bigint as off) o on o.off <> 0
        join genes g on g."ID" = c.contig and g."NUM" = case when c.type = 0 and {WINDOW} < c.max_num
        then (c.num - 1 + o.off + c.max_num) % c.max_num + 1 else c.num + o.off end""",
    "fused": """select accession, string_agg(id, '-' order by id) as family from (select distinct accession, id from family_match) group by accession""",
    "neighbors": """select query, neighbor, num, direction, contig, type, query_num, max_num, query_direction, start, stop, distance,
        coalesce(family, 'none') as family from (select *, row_number() over (partition by query, neighbor order by abs(distance), num) as rn from near where neighbor <> query)
        left join fused on accession = neighbor where rn = 1""",
    "abundance": """select l_returnflag || l_linestatus as sample, (1 + l_partkey % 25)::varchar as cluster, 'A' || (1000000 + l_partkey) as protein,
        sum(l_quantity) as value from lineitem group by all""",
    "marker_hits": """select l_returnflag || l_linestatus as sample, 'R' || l_orderkey as read_id,
        'A' || (1000000 + l_partkey) || '_' || case when l_linenumber <= 3 then 'TM' when l_linenumber <= 5 then 'JM' else 'QM' end || '_#0' || l_linenumber as marker,
        90.0::double + l_quantity % 11 as pid, l_quantity::int as alen, (80 + 10 * (l_orderkey % 7))::int as read_len from lineitem""",
    "markers": """select 'A' || (1000000 + p_partkey) || '_' || type || '_#0' || ln as marker, 'A' || (1000000 + p_partkey) as family, type,
        (8 + (p_partkey + ln) % 33)::int as marker_len from (select p_partkey, ln, case when ln <= 3 then 'TM' when ln <= 5 then 'JM' else 'QM' end as type
        from (select p_partkey, unnest(range(1, 8)) as ln from part))""",
    "self_hits": """select 'A' || (1000000 + l_partkey) as query, 'A' || (1000000 + l_suppkey * 20 + l_orderkey % 20) as subject,
        85.0::double + (l_quantity::int + l_linenumber) % 16 as pid, l_quantity::int as alen, (1 + (l_orderkey * 13) % 150)::int as qstart,
        least((1 + (l_orderkey * 13) % 150)::int + l_quantity::int - 1, 200)::int as qend, 200 as qlen from lineitem""",
    "consensus": """select 'A' || (1000000 + p_partkey) as family, substr(repeat(upper(regexp_replace(p_name || p_type, '[^A-Za-z]', '', 'g')), 40), 1, 200) as seq from part""",
}

MATERIALIZED = {"hits", "edges", "scored", "kept", "und", "comp", "metanode", "numbered", "genes", "chosen", "near", "neighbors", "abundance", "fused"}


def with_views(body: str) -> str:
    """Prefix ``body`` with the views it uses (directly or through other views)."""
    import re

    def named(text: str) -> set[str]:
        return {v for v in SQL_VIEWS if re.search(rf"\b{v.split('(')[0]}\b", text)}

    todo, used = named(body), set()
    while todo:
        v = todo.pop()
        if v not in used:
            used.add(v)
            todo |= named(SQL_VIEWS[v]) - used
    if not used:
        return body
    parts = [
        f"{v} as {'materialized ' if v in MATERIALIZED else ''}({text})" for v, text in SQL_VIEWS.items() if v in used
    ]
    body = body.strip()
    if body.lower().startswith("with recursive "):
        body, recursive = "with " + body[15:], True
    else:
        recursive = any("reach" in v for v in used)
    head = "with recursive " if recursive else "with "
    glue = ",\n" if body.lower().startswith("with ") else "\n"
    if body.lower().startswith("with "):
        body = body[5:]
    return head + ",\n".join(parts) + glue + body
