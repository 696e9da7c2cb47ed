"""Queries for family counts, length histograms and the reference-table build."""

from pyspark.sql import functions as F

from clanweave.operators import tables as T
from clanweave.plans.catalog import query
from clanweave.plans.views import acc
from clanweave.session import scratch_path
from clanweave.sources import readers as R

COUNTED = """j as (select f.id as family, f.accession, uniref50_seed as s50, uniref90_seed as s90 from family_match f left join uniref u on u.accession = f.accession),
    counted as (select 'FAMILY' as type, family, {total} as total, {u50} as uniref50, {u90} as uniref90 from j group by family
    union all select 'CLAN', clan_id, count(distinct accession), count(distinct s50), count(distinct s90) from j join clans on pfam_id = family group by clan_id)"""
MERGED = COUNTED.format(total="count(distinct accession)", u50="count(distinct s50)", u90="count(distinct s90)")
OWN = COUNTED.format(
    total="count(*)", u50="count(distinct s50) filter (exists (select 1 from pairs p where p.family = j.family and p.accession = j.s50))",
    u90="count(distinct s90) filter (exists (select 1 from pairs p where p.family = j.family and p.accession = j.s90))",
)
INFO = f"""{MERGED}, info as (select coalesce(n.family, c.family) as family, case when n.family is null then c.family else coalesce(short_name, '') end as short_name,
    case when n.family is null then c.family else coalesce(long_name, '') end as long_name, coalesce(total, 0) as num_members, coalesce(uniref50, 0) as num_uniref50_members,
    coalesce(uniref90, 0) as num_uniref90_members from family_names n full join counted c on c.family = n.family)"""


@query("ag01_family_counts", f"with {MERGED} select type, family, total, uniref50, uniref90 from counted")
def _(v):
    return T.family_counts(v.family_match, v.uniref, v.clans)


@query(
    "ag01_family_counts_own_seeds",
    """with j as (select f.id as family, f.accession, uniref50_seed as s50, uniref90_seed as s90 from family_match f left join uniref u on u.accession = f.accession),
    pairs as (select distinct id as family, accession from family_match), a as (select family, count(*) as total from j group by 1),
    b as (select j.family, count(distinct s50) as n from j join pairs p on p.family = j.family and p.accession = j.s50 group by 1),
    c as (select j.family, count(distinct s90) as n from j join pairs p on p.family = j.family and p.accession = j.s90 group by 1)
    select 'FAMILY' as type, a.family, total, coalesce(b.n, 0) as uniref50, coalesce(c.n, 0) as uniref90 from a left join b on b.family = a.family left join c on c.family = a.family
    union all select 'CLAN', clan_id, count(distinct accession), count(distinct s50), count(distinct s90) from j join clans on pfam_id = family group by clan_id""",
)
def _(v):
    return T.family_counts(v.family_match, v.uniref, v.clans, merge_domain=False, own_seeds=True)


@query("ag02_family_info", f"with {INFO} select * from info")
def _(v):
    return T.family_info(T.family_counts(v.family_match, v.uniref, v.clans), v.family_names)


@query(
    "ag03_family_size",
    f"""with {INFO} select family, sum(num_members)::bigint as num_members, sum(num_uniref50_members)::bigint as num_uniref50_members, sum(num_uniref90_members)::bigint as num_uniref90_members
    from info where family in ('PF10001', 'PF10007', 'CL3') group by rollup (family)""",
)
def _(v):
    info = T.family_info(T.family_counts(v.family_match, v.uniref, v.clans), v.family_names)
    return T.family_size(["PF10001", "PF10007", "CL3"], info)


@query(
    "ag04_distinct_member_count",
    "select f.id as family, count(distinct f.accession) as accessions, count(distinct uniref50_seed) as uniref50, count(distinct uniref90_seed) as uniref90 from family_match f left join uniref u on u.accession = f.accession group by 1",
)
def _(v):
    return T.distinct_member_count(v.family_match, v.uniref)


@query(
    "ag05_family_overlap",
    """with d as (select distinct id as family, accession from family_match), s as (select accession, count(*) > 1 as shared from d group by 1)
    select family, floor(100000.0::double * count(*) filter (shared) / count(*) + 0.5) / 1000 as percent from d join s using (accession) group by 1""",
)
def _(v):
    return T.family_overlap(v.family_match)


HIST = """grid as (select unnest(range(0, (select max(len) from c) + 2)) as length), f as (select g.length, coalesce(n, 0) as count, sum(coalesce(n, 0)) over (order by g.length) as cum from grid g left join c on len = g.length),
    p as (select (select sum(n) from c) as total, floor((select sum(n) from c) * (1 - {f}::double) / 2) as t, (select max(len) from c) as m),
    k as (select count(*) filter (length <= m and cum < t) as lo, count(*) filter (length <= m and cum - count <= total - t) as hi from f, p)
    select length::int as length, count from f, k where length between lo and hi"""


@query("ag09_length_histogram", f"with c as (select seq_len as len, count(*) as n from sequences group by 1), {HIST.format(f='0.99')}")
def _(v):
    return T.length_histogram(v.sequences.select(F.col("seq_len").alias("len")))


@query("ag09_domain_length_histogram", f"""with c as (select "end" - start as len, count(*) as n from family_match group by 1), {HIST.format(f='1.0')}""")
def _(v):
    return T.length_histogram(T.domain_histogram_lengths(v.family_match), 1.0)


@query(
    "ag09_expanded_length_histogram",
    f"""with e as (select a."Sequence_Length" as len from nodes n join uniref u on u.uniref90_seed = n.node join annotations a on a.accession = u.accession
    union all select "Sequence_Length" from nodes n join annotations a on a.accession = n.node where n.node not in (select uniref90_seed from uniref)), c as (select len, count(*) as n from e group by 1), {HIST.format(f='0.99')}""",
)
def _(v):
    meta = v.uniref.select(F.col("uniref90_seed").alias("id"), F.lit("UniRef90_IDs").alias("field"), F.col("accession").alias("value"))
    return T.length_histogram(T.set_lengths(v.nodes.withColumnRenamed("node", "id"), v.annotations, meta, expand=True))


# ---- reference-table build over dumps written from the driver tables ------------------------------
def dat_records(v):
    """UniProt-like flat-file text, one record per part."""
    a = lambda *c: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in c])
    k, size = F.col("p_partkey"), F.col("p_size")
    some = lambda cond, text: F.when(cond, text).otherwise(F.lit(""))
    return v.table("part").select(
        a(
            "ID   N", k.cast("string"), "_X   ", F.when(size > 40, "Reviewed").otherwise("Unreviewed"), ";   ", (F.lit(100) + k % 500).cast("string"), " AA.\n",
            "AC   ", acc(k), "; Q00000;\nAC   P99999;\nDE   RecName: Full=", F.col("p_name"), " & more {ECO:1};\n", some(size % 4 == 0, a("DE            EC=1.1.1.", size.cast("string"), ";\n")),
            some(size % 7 == 0, F.lit("DE   Flags: Fragment;\n")), "GN   Name=g", size.cast("string"), "x;\nOS   ", F.col("p_type"), " (strain ", F.col("p_brand"), ") (x).\n",
            "OX   NCBI_TaxID=", size.cast("string"), ";\n", some(size % 5 == 0, a("DR   PDB; 1ABC; X-ray;\nDR   PDB; 2X", size.cast("string"), "; NMR;\n")),
            some(size % 3 == 0, a("DR   GO; GO:000", size.cast("string"), "; F:binding, odd; IEA:X.\nDR   GO; GO:111; C:cell; IEA:X.\n")),
            some(size % 6 == 0, F.lit("KW   Reference proteome {ECO:2}.\n")), "SQ   SEQUENCE\n     MKV\n//",
        ).alias("value")
    )


@query(
    "etl01_build_annotations",
    """select 'A' || (1000000 + p_partkey) as accession, 'N' || p_partkey || '_X' as "Uniprot_ID", case when p_size > 40 then 'Reviewed' else 'Unreviewed' end as "STATUS",
    (100 + p_partkey % 500)::int as "Sequence_Length", p_size as "Taxonomy_ID", p_name || ' and more' as "Description", p_type || '  (strain ' || p_brand || ')' as "Organism",
    'g' || p_size || 'x' as "GN", case when p_size % 5 = 0 then '1ABC,2X' || p_size end as pdb, case when p_size % 3 = 0 then '000' || p_size || ' binding  odd' end as "GO",
    case when p_size % 4 = 0 then '1.1.1.' || p_size end as "EC", p_size % 7 = 0 as "Fragment", case when p_size % 6 = 0 then 'ECO:2' end as "Ref_Proteome", p_size in (select n_nationkey from nation) as "GDNA" from part""",
)
def _(v):
    path = scratch_path(v.spark, "dat")
    dat_records(v).write.text(path)
    gdna = v.table("nation").select(F.col("n_nationkey").alias("Taxonomy_ID"))
    out = T.build_annotations(R.read_uniprot_dat(v.spark, path), gdna)
    cols = ["accession", "Uniprot_ID", "STATUS", "Sequence_Length", "Taxonomy_ID", "Description", "Organism", "GN", "EC", "Fragment", "Ref_Proteome", "GDNA"]
    return out.select(*cols, F.array_join("pdb", ",").alias("pdb"), F.array_join("GO", ",").alias("GO"))


@query("src12_read_uniprot_dat", "select count(*) as records from part")
def _(v):
    path = scratch_path(v.spark, "dat")
    dat_records(v).write.text(path)
    return R.read_uniprot_dat(v.spark, path).agg(F.count(F.lit(1)).alias("records"))


@query(
    "etl02_build_hmp_lookup",
    """with s as (select distinct p_size as t, case when p_size % 9 = 0 then 'Not Specified' else p_type end as v from part union select distinct p_size, 'gut' from part where p_size % 9 <> 0), o as (select distinct p_size as t, p_brand as v from part)
    select s.t as "Taxonomy_ID", s.l as sites, o.l as oxygen from (select t, string_agg(v, ',' order by v) as l from s group by 1) s join (select t, string_agg(v, ',' order by v) as l from o group by 1) o on o.t = s.t""",
)
def _(v):
    h = v.table("part").select(F.col("p_size").alias("Taxonomy_ID"), F.when(F.col("p_size") % 9 == 0, "").otherwise(F.concat("p_type", F.lit(", gut"))).alias("site"), F.col("p_brand").alias("oxygen"))
    return T.build_hmp_lookup(h).select("Taxonomy_ID", F.array_join("sites", ",").alias("sites"), F.array_join("oxygen", ",").alias("oxygen"))


def interpro_xml(v):
    """One protein element per part, with two or three matches of two locations each."""
    loc = lambda i: f'<lcn start="{i}" end="'
    k, size = F.col("p_partkey"), F.col("p_size")
    match = lambda db, mid, ipr: F.concat(F.lit(f'<match dbname="{db}" id="'), mid, F.lit('">' + loc(5)), (size + 10).cast("string"), F.lit('"/>' + loc(90)), (size + 100).cast("string"), F.lit('"/>'), ipr, F.lit("</match>"))
    ipr = F.concat(F.lit('<ipr id="IPR'), (k % 30 + 100).cast("string"), F.lit('"/>'))
    body = F.concat(
        match("PFAM", F.concat(F.lit("PF"), (k % 20).cast("string")), ipr), match("SSF", F.concat(F.lit("SSF"), (k % 7).cast("string")), F.lit("")),
        F.when(size % 2 == 0, match("PANTHER", F.concat(F.lit("PTHR"), k.cast("string")), ipr)).otherwise(F.lit("")),
    )
    return v.table("part").select(F.concat(F.lit('<protein id="'), acc(k), F.lit('" name="x">'), body, F.lit("</protein>")).alias("value"))


LCN = """lcn as (select 'A' || (1000000 + p_partkey) as accession, 'PF' || p_partkey % 20 as pf, 'SSF' || p_partkey % 7 as ssf, 'IPR' || (p_partkey % 30 + 100) as ipr, p_size, s as start, s + p_size + case when s = 5 then 5 else 10 end as "end"
    from part, (values (5), (90)) t(s))"""


def interpro(v):
    path = scratch_path(v.spark, "interpro")
    interpro_xml(v).write.text(path)
    return R.read_interpro_xml(v.spark, path)


@query(
    "src13_read_interpro_xml",
    f"""with {LCN} select accession, 'PFAM' as dbname, pf as match_id, ipr as ipr_id, start, "end" from lcn union all select accession, 'SSF', ssf, null, start, "end" from lcn
    union all select accession, 'PANTHER', 'PTHR' || (substr(accession, 2)::bigint - 1000000), ipr, start, "end" from lcn where p_size % 2 = 0""",
)
def _(v):
    return interpro(v).drop("loc")


@query(
    "etl03_build_interpro_table",
    f"""with {LCN} select ipr as id, accession, start, "end", case when substr(ipr, 4)::int % 2 = 0 then 'Domain' end as family_type, null::varchar as parent, true as is_leaf from lcn
    union all select ipr, accession, start, "end", case when substr(ipr, 4)::int % 2 = 0 then 'Domain' end, null, true from lcn where p_size % 2 = 0""",
)
def _(v):
    m = interpro(v)
    types = m.select(F.col("ipr_id").alias("family")).where("family is not null and cast(substring(family, 4) as int) % 2 = 0").distinct().withColumn("family_type", F.lit("Domain"))
    tree = v.spark.createDataFrame([], "family string, parent string, is_leaf boolean")
    return T.build_family_tables(m, types, tree)["INTERPRO"]


@query("etl03_build_family_tables_last_location", f"""with {LCN} select pf as id, accession, start, "end" from lcn where start = 90""")
def _(v):
    m = interpro(v)
    none = v.spark.createDataFrame([], "family string, family_type string, parent string, is_leaf boolean")
    return T.build_family_tables(m, none, none, last_location_only=True)["PFAM"]


@query(
    "etl04_build_interpro_tree",
    """select 'IPR' || (1000 + p_partkey) as family, case when p_partkey % 5 <> 0 then 'IPR' || (1000 + case when p_partkey % 5 in (1, 3) then p_partkey - p_partkey % 5 else p_partkey - 1 end) end as parent,
    not (p_partkey % 5 in (0, 1, 3)) as is_leaf from part""",
)
def _(v):
    path = scratch_path(v.spark, "tree")
    n = F.col("p_partkey")
    dashes = F.when(n % 5 == 0, "").when((n % 5).isin(1, 3), "--").otherwise("----")
    lines = v.table("part").repartitionByRange(4, n).sortWithinPartitions(n)
    lines.select(F.concat(dashes, F.lit("IPR"), (n + 1000).cast("string"), F.lit("::x::")).alias("value")).write.text(path)
    return T.build_interpro_tree(v.spark, path)


def embl_records(v):
    """One contig per 100 orders with one coding feature per order line; every third names no accession."""
    g = v.table("lineitem").select(F.expr("l_orderkey div 100").alias("c"), F.col("l_partkey").alias("k"), "l_orderkey", "l_linenumber", "l_quantity").withColumn("o", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    where = F.concat((F.col("o") * 3).cast("string"), F.lit(".."), (F.col("o") * 3 + F.col("l_quantity").cast("int")).cast("string"))
    place = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("complement("), where, F.lit(")"))).otherwise(where)
    named = F.when(F.col("k") % 3 != 2, F.concat(F.lit('\nFT                   /db_xref="UniProtKB/TrEMBL:'), acc("k"), F.lit('"'))).otherwise("")
    prot = F.concat(F.lit('\nFT                   /protein_id="CAA'), F.lpad((F.col("k") % 100000).cast("string"), 5, "0"), F.lit('"'))
    feature = F.concat(F.lit("FT   CDS             "), place, prot, named, F.lit('\nFT                   /translation="MK"'))
    # A contig is one record of the format; a hundred orders have some hundred lines.
    per = g.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("o", "k", "l_quantity", feature.alias("f")))).alias("fs"))
    kind = F.when(F.col("c") % 2 == 0, "circular").otherwise("linear")
    return per.select(F.concat(F.lit("ID   CT"), F.col("c").cast("string"), F.lit("; SV 1; "), kind, F.lit("; genomic DNA; STD; PRO; 10 BP.\nXX\n"), F.array_join(F.transform("fs", lambda x: x["f"]), "\n"), F.lit("\n//")).alias("value"))


@query(
    "etl05_build_gene_positions",
    """with g as (select *, l_orderkey // 100 as c, l_orderkey * 10 + l_linenumber as o from lineitem), n as (select *, row_number() over (partition by c order by o, l_partkey, l_quantity) as num from g)
    select 'CT' || c as "ID", case when l_partkey % 3 <> 2 then 'A' || (1000000 + l_partkey) else m.u end as "AC", num::int as "NUM", (c % 2)::int as "TYPE", case when l_linenumber % 2 = 0 then 0 else 1 end as "DIRECTION",
    (o * 3)::int as start, (o * 3 + l_quantity)::int as stop from n left join (select foreign_id, min(uniprot_id) as u from idmapping where foreign_id_type = 'embl-cds' group by 1) m on m.foreign_id = 'CAA' || lpad((l_partkey % 100000)::varchar, 5, '0')
    where l_partkey % 3 <> 2 or m.u is not null""",
)
def _(v):
    path = scratch_path(v.spark, "embl")
    embl_records(v).write.text(path)
    return T.build_gene_positions(R.read_embl(v.spark, path), v.idmapping)


@query("src16_read_embl", "select 'CT' || (l_orderkey // 100) as contig, ((l_orderkey // 100) % 2)::int as type, count(*)::int as features from lineitem group by 1, 2")
def _(v):
    path = scratch_path(v.spark, "embl")
    embl_records(v).write.text(path)
    return R.read_embl(v.spark, path).select("contig", "type", F.size("blocks").alias("features"))


def taxon_xml(v):
    """One taxon element per part: its brand as superkingdom, an unranked lineage step and one unranked child."""
    k = F.col("p_partkey")
    body = F.concat(
        F.lit('<taxon taxId="'), (k + 1000).cast("string"), F.lit('" rank="genus" scientificName="'), F.col("p_name"), F.lit('"><lineage><taxon taxId="'), (F.col("p_size") + 10).cast("string"),
        F.lit('" rank="superkingdom" scientificName="'), F.col("p_brand"), F.lit('"/><taxon taxId="99" scientificName="none"/></lineage><children><taxon taxId="'), (k + 50_000_000).cast("string"), F.lit('" scientificName="sp '), F.col("p_name"), F.lit('"/></children></taxon>'),
    )
    return v.table("part").select(body.alias("value"))


def taxa(v):
    path = scratch_path(v.spark, "taxa")
    taxon_xml(v).write.text(path)
    return R.read_taxonomy_xml(v.spark, path)


@query("src15_read_taxonomy_xml", "select (p_partkey + 1000)::int as tax_id, 'genus' as rank, p_name as name, 2 as steps, 1 as kids from part")
def _(v):
    return taxa(v).select("tax_id", "rank", "name", F.size("lineage").alias("steps"), F.size("children").alias("kids"))


@query(
    "etl06_build_taxonomy",
    """select (p_partkey + 1000)::int as "Taxonomy_ID", p_brand as "Domain", 'NA' as "Genus", p_name as "Species" from part
    union all select (p_partkey + 50000000)::int, 'NA', 'NA', 'sp ' || p_name from part""",
)
def _(v):
    return T.build_taxonomy(taxa(v)).select("Taxonomy_ID", "Domain", "Genus", "Species")


def uniref_members(v, width: int):
    """``(seed, member)`` read back from cluster entries written for groups of ``width`` parts."""
    path = scratch_path(v.spark, "uniref")
    k = F.col("p_partkey")
    prop = lambda a: F.concat(F.lit('<property type="UniProtKB accession" value="'), a, F.lit('"/>'))
    ref = lambda a, kind: F.concat(F.lit(f'<dbReference type="{kind}" id="x">'), prop(a), F.lit("</dbReference>"))
    parts = v.table("part").select((k - k % width).alias("seed"), k.alias("k"))
    inner = F.concat(F.lit("<member>"), ref(acc("k"), "UniProtKB ID"), F.lit("</member>"), F.lit("<member>"), ref(F.lit("UPI1"), "UniParc ID"), F.lit("</member>"))
    entry = parts.groupBy("seed").agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") != F.col("seed"), inner))), "").alias("m"))
    entry.select(F.concat(F.lit('<entry id="U"><representativeMember>'), ref(F.concat(acc("seed"), F.lit("-1")), "UniProtKB ID"), F.lit("<sequence length=\"3\">MKV</sequence></representativeMember>"), F.col("m"), F.lit("</entry>")).alias("value")).write.text(path)
    return R.read_uniref_xml(v.spark, path)


@query("src14_read_uniref_xml", "select uniref90_seed as seed, accession as member from uniref")
def _(v):
    return uniref_members(v, 5)[0]


@query("src14_read_uniref_sequences", "select distinct uniref90_seed as seed, 'MKV' as seq from uniref")
def _(v):
    return uniref_members(v, 5)[1]


@query("etl07_build_uniref", "select accession, uniref50_seed, uniref90_seed from uniref")
def _(v):
    return T.build_uniref(uniref_members(v, 20)[0], uniref_members(v, 5)[0])


@query("etl08_build_idmapping", "select uniprot_id, foreign_id_type, foreign_id from idmapping where foreign_id_type <> 'gi'")
def _(v):
    path = scratch_path(v.spark, "idmapping")
    v.idmapping.select("uniprot_id", F.initcap("foreign_id_type"), "foreign_id").write.csv(path, sep="\t")
    rows = v.spark.read.csv(path, sep="\t", schema="uniprot_id string, foreign_id_type string, foreign_id string")
    return T.build_idmapping(rows, ["refseq", "embl-cds"])


@query("etl09_build_pdb_hits", """select 'A' || (1000000 + l_partkey) as "ACC", 'PX' || l_suppkey as "PDB", l_linenumber::varchar as e from lineitem""")
def _(v):
    h = v.table("lineitem").select(
        F.concat(F.lit("tr|"), acc("l_partkey"), F.lit("|N_X")).alias("query"), F.concat(F.lit("gi|1|pdb|PX"), F.col("l_suppkey"), F.lit("|A")).alias("subject"), F.col("l_linenumber").cast("string").alias("evalue")
    )
    return T.build_pdb_hits(h)


@query("etl10_family_counts_info", f"with {INFO} select i.*, case when substr(i.family, 1, 2) = 'PF' then 'Domain' end as family_type from info i")
def _(v):
    types = v.clans.select(F.col("pfam_id").alias("family"), F.lit("Domain").alias("family_type"))
    return T.family_info(T.family_counts(v.family_match, v.uniref, v.clans), v.family_names, types=types)


@query(
    "etl11_drop_fragments",
    """with f as (select accession from annotations where "Fragment") select 'all' as set_name, id from sequences where id not in (from f) union all
    select distinct 'uniref90', uniref90_seed from uniref where uniref90_seed not in (from f)""",
)
def _(v):
    out = T.drop_fragments({"all": v.sequences.select("id"), "uniref90": v.uniref.select(F.col("uniref90_seed").alias("id")).distinct()}, v.annotations)
    return out["all"].select(F.lit("all").alias("set_name"), "id").unionByName(out["uniref90"].select(F.lit("uniref90").alias("set_name"), "id"))
