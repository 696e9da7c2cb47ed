"""Queries for scalar functions and filters."""

from pyspark.sql import functions as F

from clanweave.functions import scalar as S
from clanweave.operators import edges as E
from clanweave.operators import graph as G
from clanweave.operators import sequences as Q
from clanweave.plans.catalog import query

SCORE = "trunc(-log10(src_len::double * dst_len::double) + bitscore * log10(2.0::double))::int"


@query("fn01_alignment_score", f"select src, dst, bitscore, {SCORE} as score from hits")
def _(v):
    return v.hits.select("src", "dst", "bitscore", S.alignment_score("src_len", "dst_len", "bitscore").alias("score"))


@query(
    "fn02_id_type",
    r"""select id, case when regexp_matches(id, '^\d+$') then 'gi' when regexp_matches(id, '^[A-Za-z]{3}\d{5}(\.\d+)?$') then 'embl-cds'
    when regexp_matches(id, '^[A-Za-z]{2}_\d+(\.\d+)?$') then 'refseq' when regexp_matches(id, '^[A-Za-z]\d[A-Za-z0-9]{3,8}(\.\d+)?$') then 'uniprot'
    when regexp_matches(id, '^[A-Za-z0-9]{4}$') then 'pdb' else 'unknown' end as kind from (select id from query_ids union all select foreign_id from idmapping)""",
)
def _(v):
    ids = v.query_ids.unionByName(v.idmapping.select(F.col("foreign_id").alias("id")))
    return ids.select("id", S.id_type("id").alias("kind"))


@query("fn03_sanitize_id", "select p_partkey, regexp_replace(p_name || '|' || p_brand, '[^A-Za-z0-9]', '_', 'g') as safe from part")
def _(v):
    return v.table("part").select("p_partkey", S.sanitize_id(F.concat("p_name", F.lit("|"), "p_brand")).alias("safe"))


@query(
    "fn04_domain_parts",
    """select node_id, accession as acc, start, "end", accession as stripped from (select accession || ':' || start || ':' || "end" as node_id, * from family_match)""",
)
def _(v):
    d = v.family_match.select(S.domain_id("accession", "start", "end").alias("node_id"))
    p = S.parse_domain("node_id")
    return d.select("node_id", p["acc"].alias("acc"), p["start"].alias("start"), p["end"].alias("end"), S.strip_domain("node_id").alias("stripped"))


@query("fn05_strip_suffixes", "select l_orderkey, l_linenumber, l_partkey, 'A' || l_partkey as acc, 'WP_' || l_orderkey as ref from lineitem")
def _(v):
    d = v.table("lineitem").withColumn("iso", F.concat(F.lit("A"), "l_partkey", F.lit("-"), "l_linenumber"))
    d = d.withColumn("ver", F.concat(F.lit("WP_"), "l_orderkey", F.lit("."), "l_linenumber"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", S.strip_isoform("iso").alias("acc"), S.strip_version("ver").alias("ref"))


@query(
    "fn06_header_ids",
    """select id, pos, token from (select id, unnest(range(1, len(t) + 1)) as pos, unnest(t) as token from (select id, list_filter(list_transform(
    string_split_regex('sp|' || id || '|' || source || ' x>gi|' || doc || ' y|ab', '[>|]'), lambda x: regexp_extract(x, '^\\s*(\\S*)', 1)), lambda x: length(x) >= 5) as t
    from (select 'A' || (1000000 + doc_id) as id, source, 100000 + doc_id as doc from documents)))""".replace("\\\\", "\\"),
)
def _(v):
    from clanweave.plans.views import acc

    d = v.table("documents").select(acc("doc_id").alias("id"), "source", (F.col("doc_id") + 100000).cast("string").alias("doc"))
    h = F.concat(F.lit("sp|"), "id", F.lit("|"), "source", F.lit(" x>gi|"), "doc", F.lit(" y|ab"))
    return d.select("id", F.posexplode(S.header_ids(h)).alias("pos", "token")).select("id", (F.col("pos") + 1).cast("long").alias("pos"), "token")


@query("fn07_status_label", """select accession, case when lower("STATUS") = 'reviewed' then 'SwissProt' else 'TrEMBL' end as label from annotations""")
def _(v):
    return v.annotations.select("accession", S.status_label("STATUS").alias("label"))


@query("fn08_fragment_label", """select accession, case when "Fragment" then 'fragment' else 'complete' end as label from annotations""")
def _(v):
    return v.annotations.select("accession", S.fragment_label("Fragment").alias("label"))


@query(
    "fn09_clean_description",
    "select p_partkey, trim(p_name || ' and co ') as name, p_size > 25 as fragment from part",
)
def _(v):
    de = F.concat(
        F.lit("RecName: Full="), "p_name", F.lit("  & co {ECO:1|x};"),
        F.when(F.col("p_size") > 25, " Flags: Fragment;").otherwise(" AltName: Full=other;"),
    )
    d = v.table("part").select("p_partkey", F.regexp_replace(de, r"\};", "}").alias("de"))
    return d.select("p_partkey", S.clean_description("de").alias("name"), S.is_fragment("de").alias("fragment"))


@query(
    "fn10_clean_organism",
    "select p_partkey, case when p_size % 2 = 0 then p_type || ' ' || ' (strain ' || p_brand || ')' else p_type || ' ' end as organism from part",
)
def _(v):
    os = F.concat("p_type", F.lit(" "), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("(strain "), "p_brand", F.lit(") (x)"))).otherwise("(common name)"))
    return v.table("part").select("p_partkey", S.clean_organism(os).alias("organism"))


@query(
    "fn11_cluster_color",
    """select n.seq_number, coalesce(a.color, b.color) as color from numbered n left join palette a on a.cluster = n.seq_number
    left join palette b on b.cluster = n.seq_number % (select count(*) from palette) + 1""",
)
def _(v):
    return G.cluster_color(v.numbered.select("seq_number"), "seq_number", v.palette)


@query(
    "fn12_family_color",
    """with fam as (select distinct family from fused), parts as (select family, unnest(string_split(family, '-')) as part, unnest(range(0, len(string_split(family, '-')))) as pos from fam),
    words as (select part, row_number() over (order by part) - 1 as r from (select distinct part from parts)),
    slots as (select color, row_number() over (order by cluster) - 1 as k from palette)
    select family, pos, parts.part, color from parts join words using (part) join slots on k = r % (select count(*) from palette)""",
)
def _(v):
    from clanweave.operators import neighborhood as N

    fam = N.fuse_families(v.gene_matches).select("family").distinct()
    return G.family_color(fam, v.palette).withColumn("pos", F.col("pos").cast("long"))


@query(
    "fn13_trunc2",
    "select l_partkey, a, b, (a * 100 // b) / 100.0::double as ratio from (select l_partkey, count(*) filter (l_quantity > 25) as a, count(*) as b from lineitem group by 1)",
)
def _(v):
    d = v.table("lineitem").groupBy("l_partkey").agg(F.count_if(F.col("l_quantity") > 25).alias("a"), F.count(F.lit(1)).alias("b"))
    return d.select("l_partkey", "a", "b", S.trunc2_ratio("a", "b").alias("ratio"))


@query("fn14_subsequence", "select id, substr(seq, 5, greatest(seq_len - 9, 0)) as piece from sequences")
def _(v):
    return v.sequences.select("id", S.subsequence("seq", F.lit(5), F.col("seq_len") - 5).alias("piece"))


@query(
    "fn15_subsequence_guarded",
    "select id, case when 20 < seq_len and 400 <= seq_len then substr(seq, 20, 381) else seq end as piece from sequences",
)
def _(v):
    return v.sequences.select("id", S.subsequence_guarded("seq", F.lit(20), F.lit(400)).alias("piece"))


@query("fn16_gene_length", 'select "ID", "NUM", trunc(abs(stop - start) / 3.0::double - 1)::int as aa from genes')
def _(v):
    return v.genes.select("ID", "NUM", S.gene_length_aa("start", "stop").alias("aa"))


@query(
    "fn17_marker_parse",
    """select marker, 'A' || (1000000 + p_partkey) as family, type, case when type = 'QM' then p_size end as quasi, ln::int as ordinal, 0.25::double as w1, p_brand as f2
    from (select p_partkey, p_size, p_brand, ln, case when ln <= 3 then 'TM' when ln <= 5 then 'JM' else 'QM' end as type,
    'A' || (1000000 + p_partkey) || '_' || case when ln <= 3 then 'TM' when ln <= 5 then 'JM' else 'QM' || p_size end || '_#0' || ln as marker
    from (select *, unnest(range(1, 8)) as ln from part))""",
)
def _(v):
    from clanweave.plans.views import acc

    d = v.table("part").select("*", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("ln"))
    kind = F.when(F.col("ln") <= 3, F.lit("TM")).when(F.col("ln") <= 5, F.lit("JM")).otherwise(F.concat(F.lit("QM"), F.col("p_size").cast("string")))
    d = d.withColumn("marker", F.concat(acc("p_partkey"), F.lit("_"), kind, F.lit("_#0"), F.col("ln").cast("string")))
    m = S.marker_parse(F.concat("marker", F.lit("__["), acc("p_partkey"), F.lit("_w=0.25,"), "p_brand", F.lit("_w=0.5]")))
    return d.select("marker", m.alias("m")).select(
        "marker", "m.family", "m.type", "m.quasi", "m.ordinal", F.col("m.weights")[0]["w"].alias("w1"), F.col("m.weights")[1]["family"].alias("f2")
    )


@query("fn18_clean_accession", "select p_partkey, case when p_size % 2 = 0 then 'A' || p_partkey else 'B' || p_partkey end as acc from part")
def _(v):
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("tr|A"), F.col("p_partkey"), F.lit("|X_Y"))).otherwise(F.concat(F.lit("B"), F.col("p_partkey")))
    return v.table("part").select("p_partkey", S.clean_accession(raw).alias("acc"))


@query("flt01_filter_edges", "select src, dst, bitscore, pid from scored where score >= 20 and src_len >= 150 and dst_len >= 150 and src_len <= 500 and dst_len <= 500")
def _(v):
    return E.filter_edges(v.edges, "eval", 20, 150, 500).select("src", "dst", "bitscore", "pid")


@query("flt01_filter_edges_bit", "select src, dst, bitscore from hits where bitscore >= 60 and src_len <= 400 and dst_len <= 400")
def _(v):
    return E.filter_edges(v.hits, "bit", 60, 0, 400).select("src", "dst", "bitscore")


@query("flt01_filter_edges_pid", "select src, dst, pid from hits where pid >= 70")
def _(v):
    return E.filter_edges(v.hits, "pid", 70).select("src", "dst", "pid")


@query("flt02_filter_sequences", "select id, seq_len from sequences where seq_len >= 100 and seq_len <= 2000")
def _(v):
    return Q.filter_sequences_by_length(v.sequences, 100, 2000).select("id", "seq_len")


@query("flt03_exclude_fragments", 'select node as id from nodes where node in (select accession from annotations where not "Fragment")')
def _(v):
    return Q.exclude_fragments(v.nodes.withColumnRenamed("node", "id"), v.annotations)


@query("flt04_remove_ids", """select id, seq_len from sequences where id not in (select accession from annotations where "STATUS" = 'Reviewed')""")
def _(v):
    gone = v.annotations.where("STATUS = 'Reviewed'").select(F.col("accession").alias("id"))
    return Q.remove_ids(v.sequences, gone, "id").select("id", "seq_len")


@query("flt05_drop_self_edges", "select src, dst, bitscore from hits where src <> dst")
def _(v):
    return E.drop_self_edges(v.hits).select("src", "dst", "bitscore")


@query("flt06_filter_attributes", 'select accession, "STATUS", "Sequence_Length", "EC" from annotations')
def _(v):
    return Q.filter_attributes(v.annotations, ["EC"])


@query("flt07_foreign_id_filter", "select uniprot_id, foreign_id_type, foreign_id from idmapping where foreign_id_type in ('gi', 'refseq')")
def _(v):
    up = v.idmapping.withColumn("foreign_id_type", F.upper("foreign_id_type"))
    return Q.foreign_id_filter(up, ["gi", "refseq"])
