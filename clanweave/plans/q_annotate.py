"""Queries for annotation joins, ID mapping and sequence-set selection."""

from pyspark.sql import functions as F

from clanweave.functions import scalar as S
from clanweave.operators import annotate as A
from clanweave.operators import sequences as Q
from clanweave.plans.catalog import query
from clanweave.plans.views import acc

KIND = r"""case when regexp_matches({c}, '^\d+$') then 'gi' when regexp_matches({c}, '^[A-Za-z]{{3}}\d{{5}}(\.\d+)?$') then 'embl-cds'
    when regexp_matches({c}, '^[A-Za-z]{{2}}_\d+(\.\d+)?$') then 'refseq' when regexp_matches({c}, '^[A-Za-z]\d[A-Za-z0-9]{{3,8}}(\.\d+)?$') then 'uniprot'
    when regexp_matches({c}, '^[A-Za-z0-9]{{4}}$') then 'pdb' else 'unknown' end"""
MAPPED = rf"""q as (select distinct regexp_replace(id, '^\s*([^|]*\|)?([^\s|]+).*$', '\2') as query_id from query_ids), k as (select query_id, {KIND.format(c='query_id')} as kind from q),
    looked as (select k.query_id, case when k.kind = 'uniprot' then regexp_replace(k.query_id, '\.\d+$', '') else m.u end as uniprot_id from k left join
    (select foreign_id, foreign_id_type, min(uniprot_id) as u from idmapping group by 1, 2) m on m.foreign_id = k.query_id and m.foreign_id_type = k.kind where k.kind <> 'unknown')"""
LISTS = """pf as (select accession, string_agg(id, ',' order by id) as l from (select distinct accession, id from family_match) group by 1),
    ip as (select accession, string_agg(id, ',' order by id) as l from (select distinct accession, id from interpro_match) group by 1)"""
FAMS = ["PF10003", "PF10007", "CL2"]
PLAIN = "fam as (select 'PF10003' as f union select 'PF10007' union select pfam_id from clans where clan_id = 'CL2')"


def families(v):
    """Every family and clan that occurs."""
    c = v.clans
    return c.select(F.col("pfam_id").alias("family")).unionByName(c.select(F.col("clan_id").alias("family")).distinct())


@query(
    "jn01_annotate",
    f"""with {LISTS} select a.accession, a."STATUS", a."Organism", t."Domain", t."Species", pf.l as "PFAM", ip.l as "INTERPRO" from nodes n join annotations a on a.accession = n.node
    left join taxonomy t on t."Taxonomy_ID" = a."Taxonomy_ID" left join pf on pf.accession = a.accession left join ip on ip.accession = a.accession""",
)
def _(v):
    out = A.annotate(v.nodes.withColumnRenamed("node", "id"), v.annotations, v.taxonomy, v.family_match, v.interpro_match)
    return out.select("accession", "STATUS", "Organism", "Domain", "Species", "PFAM", "INTERPRO")


@query(
    "jn02_family_members",
    """select f.id, f.accession, f.start, f."end", u.uniref50_seed, a."STATUS" from family_match f left join uniref u on u.accession = f.accession
    left join annotations a on a.accession = f.accession where f.id in (select pfam_id from clans where clan_id in ('CL1', 'CL4'))""",
)
def _(v):
    fams = v.clans.where(F.col("clan_id").isin("CL1", "CL4")).select(F.col("pfam_id").alias("family"))
    out = Q.family_members(fams, v.family_match, v.uniref, v.annotations)
    return out.select("id", "accession", "start", "end", "uniref50_seed", "STATUS")


@query(
    "jn03_expand_clans",
    """select distinct family from (select pfam_id as family from clans union all select pfam_id from clans)""",
)
def _(v):
    return Q.expand_clans(families(v), v.clans)


@query("jn04_reverse_map_matched", f"with {MAPPED} select query_id, uniprot_id from looked where uniprot_id is not null")
def _(v):
    return A.reverse_map_ids(v.query_ids, v.idmapping)[0].select("query_id", "uniprot_id")


@query("jn04_reverse_map_unmatched", f"with {MAPPED} select query_id from looked where uniprot_id is null")
def _(v):
    return A.reverse_map_ids(v.query_ids, v.idmapping)[1]


@query("jn05_forward_map", "select uniprot_id as accession, upper(foreign_id_type) || ':' || foreign_id as ncbi_id from idmapping where uniprot_id in (select node from nodes)")
def _(v):
    return A.forward_map_ids(v.nodes.withColumnRenamed("node", "id"), v.idmapping)


HEADER = "'tr|A' || (1000000 + o_custkey) || '|' || (o_custkey + 500000) || ' some text>WP_' || (o_orderkey % 3000 + 500000)"
TOKENS = rf"""tok as (select ord, unnest(t) as token from (select o_orderkey as ord, list_filter(list_transform(string_split_regex({HEADER}, '[>|]'),
    lambda x: regexp_extract(x, '^\s*(\S*)', 1)), lambda x: length(x) >= 5) as t from orders)),
    typed as (select *, {KIND.format(c='token')} as kind from tok),
    cand as (select ord, token, case when kind = 'uniprot' then regexp_replace(token, '\..+$', '') else u end as c from typed left join
    (select foreign_id, foreign_id_type, min(uniprot_id) as u from idmapping group by 1, 2) m on m.foreign_id = token and m.foreign_id_type = kind where kind <> 'unknown'),
    named as (select ord, token, a.accession as uniprot_id from cand left join annotations a on a.accession = c)"""


def headers(v):
    o = v.table("orders")
    h = F.concat(F.lit("tr|"), acc("o_custkey"), F.lit("|"), (F.col("o_custkey") + 500000).cast("string"), F.lit(" some text>WP_"), (F.col("o_orderkey") % 3000 + 500000).cast("string"))
    return o.select(F.col("o_orderkey").alias("ord"), h.alias("header"))


@query("jn06_match_headers", f"with {TOKENS} select ord, token, uniprot_id from named")
def _(v):
    return A.match_headers(headers(v), v.idmapping, v.annotations).select("ord", "token", "uniprot_id")


@query(
    "jn06_header_stats",
    f"""with {TOKENS}, per as (select distinct ord, uniprot_id from named where uniprot_id is not null), s as (select (select count(*) from orders) as sequences,
    (select coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from per group by ord)) as multi_id, (select count(distinct uniprot_id) from per) as matched)
    select *, sequences + multi_id - matched as unmatched from s""",
)
def _(v):
    h = headers(v)
    return A.header_match_stats(h, A.match_headers(h, v.idmapping, v.annotations))


@query(
    "jn07_uniref_members",
    """select uniref90_seed as seed, accession as member from uniref where uniref90_seed in (select node from nodes) and accession in (select accession from annotations where not "Fragment")""",
)
def _(v):
    return A.uniref_members(v.nodes.withColumnRenamed("node", "seed"), v.uniref, "90", v.annotations)


@query("jn08_uniref_seeds", "select accession, uniref90_seed, uniref50_seed from uniref where uniref50_seed in (select 'A' || (1000000 + o_custkey) from orders)")
def _(v):
    ids = v.table("orders").select(F.concat(acc("o_custkey"), F.lit("|x")).alias("id"))
    return A.uniref_seeds(ids, v.uniref, "50")


@query("jn09_domain_pieces", """select f.accession as id, f.start, f."end", a."Sequence_Length" as full_len from family_match f join annotations a on a.accession = f.accession where f.id = 'PF10005'""")
def _(v):
    return A.domain_pieces(v.nodes.withColumnRenamed("node", "id"), "PF10005", v.family_match, v.annotations)


@query(
    "jn15_family_names",
    """with p as (select family as f, unnest(string_split(family, '-')) as part, unnest(range(0, len(string_split(family, '-')))) as pos from (select distinct family from fused)),
    n as (select f, pos, coalesce(short_name, part) as s, coalesce(long_name, short_name, part) as l from p left join family_names on family_names.family = part)
    select f as family, string_agg(s, '-' order by pos) as short, string_agg(l, '-' order by pos) as long from n group by f""",
)
def _(v):
    from clanweave.operators.neighborhood import fuse_families

    return A.family_names(fuse_families(v.gene_matches).select("family"), v.family_names)


@query(
    "jn18_merge_uniref",
    """select coalesce(a.accession, b.accession) as accession, coalesce(a.uniref50_seed, '') as uniref50_seed, coalesce(b.uniref90_seed, '') as uniref90_seed from
    (select accession, uniref50_seed from uniref where accession <> uniref90_seed) a full join (select accession, uniref90_seed from uniref where accession <> uniref50_seed) b on a.accession = b.accession""",
)
def _(v):
    a = v.uniref.where("accession <> uniref90_seed").select("accession", F.col("uniref50_seed").alias("seed"))
    b = v.uniref.where("accession <> uniref50_seed").select("accession", F.col("uniref90_seed").alias("seed"))
    return A.merge_uniref(a, b)


@query(
    "ag19_merge_annotation_rows",
    """select uniref50_seed as seed, u.accession as member, 'Organism' as field, "Organism" as value from uniref u join annotations a on a.accession = u.accession
    union all select uniref50_seed, u.accession, 'PDB', "PDB" from uniref u join annotations a on a.accession = u.accession where "PDB" is not null""",
)
def _(v):
    return A.merge_annotation_rows(v.uniref.select(F.col("uniref50_seed").alias("seed"), F.col("accession").alias("member")), v.annotations, ["Organism", "PDB"])


@query(
    "ag20_classify_interpro",
    """with d as (select distinct accession, id, family_type as t from interpro_match) select accession,
    coalesce(string_agg(id, ',' order by id) filter (t = 'Domain'), '') as "IPRO_DOM", coalesce(string_agg(id, ',' order by id) filter (t = 'Family'), '') as "IPRO_FAM",
    coalesce(string_agg(id, ',' order by id) filter (t = 'Homologous_superfamily'), '') as "IPRO_SUP", coalesce(string_agg(id, ',' order by id) filter (t = 'Repeat'), '') as "IPRO"
    from d group by 1""",
)
def _(v):
    return A.classify_interpro(v.interpro_match)


# ---- windows over pieces --------------------------------------------------------------------------
PIECES = """pieces as (select distinct accession as id, start, "end", 1000 as full_len from family_match)"""


def pieces(v):
    return v.family_match.select(F.col("accession").alias("id"), "start", "end", F.lit(1000).alias("full_len")).distinct()


@query(
    "wn03_domain_region_cterminal",
    f"""with {PIECES} select id, s as start, e as "end" from (select id, "end" + 1 as s, coalesce(lead(start) over (partition by id order by start, "end") - 1, full_len) as e from pieces) where e - s > 0""",
)
def _(v):
    return Q.domain_region(pieces(v), "cterminal").select("id", "start", "end")


@query(
    "wn03_domain_region_nterminal",
    f"""with {PIECES} select id, s as start, e as "end" from (select id, coalesce(lag("end") over (partition by id order by start, "end"), 0) + 1 as s, start - 1 as e from pieces) where e - s > 0""",
)
def _(v):
    return Q.domain_region(pieces(v), "nterminal").select("id", "start", "end")


SAMPLE = """rows as (select distinct f.id, f.accession, f.start, f."end", a."STATUS", u.uniref50_seed from family_match f join annotations a on a.accession = f.accession join uniref u on u.accession = f.accession)"""


def sample_rows(v):
    a, u = v.annotations.select("accession", "STATUS"), v.uniref.select("accession", "uniref50_seed")
    return v.family_match.distinct().join(a, "accession").join(u, "accession")


@query(
    "wn04_sample_fraction",
    f"""with {SAMPLE} select id, accession, start, "end" from (select *, row_number() over (order by id, accession, start, "end") as rn from rows) where rn % 5 = 0 or "STATUS" = 'Reviewed'""",
)
def _(v):
    return Q.sample_fraction(sample_rows(v), 5, ["id", "accession", "start", "end"]).select("id", "accession", "start", "end")


@query(
    "wn04_sample_fraction_uniref",
    f"""with {SAMPLE}, o as (select *, row_number() over (order by id, accession, start, "end") as rn from rows),
    f as (select *, (rn = min(rn) over (partition by uniref50_seed))::int as first from o), c as (select *, sum(first) over (order by rn) - first + 1 as n from f)
    select id, accession, start, "end" from c where n % 5 = 0 or "STATUS" = 'Reviewed'""",
)
def _(v):
    return Q.sample_fraction(sample_rows(v), 5, ["id", "accession", "start", "end"], seed="uniref50_seed").select("id", "accession", "start", "end")


@query("wn05_top_hits", "select dst as id, max(bitscore) as bitscore from hits group by 1 order by 2 desc, 1 limit 100")
def _(v):
    return Q.top_hits(v.hits.withColumn("dst", F.concat(F.lit("sp|"), "dst", F.lit("|X"))), 100)


@query(
    "wn11_isoform_dedup",
    """select accession, id, start, "end" from (select *, row_number() over (partition by accession order by id, start, "end") as rn from family_match) where rn = 1""",
)
def _(v):
    iso = v.family_match.withColumn("accession", F.concat("accession", F.lit("-"), (F.col("start") / 100).cast("int").cast("string")))
    return Q.isoform_dedup(iso, ["id", "start", "end"]).select("accession", "id", "start", "end")


# ---- merging --------------------------------------------------------------------------------------
SETS = """fam as (select distinct uniref90_seed as id from uniref join annotations using (accession) where "Taxonomy_ID" > 20),
    usr as (select distinct 'A' || (1000000 + o_custkey * 2) as id from orders),
    umap as (select accession as member, uniref90_seed as seed from uniref where uniref90_seed in (select id from fam) and accession <> uniref90_seed)"""


def sets(v):
    fam = v.uniref.join(v.annotations.where("Taxonomy_ID > 20"), "accession").select(F.col("uniref90_seed").alias("id")).distinct()
    usr = v.table("orders").select(acc(F.col("o_custkey") * 2).alias("id")).distinct()
    umap = v.uniref.join(fam.withColumnRenamed("id", "uniref90_seed"), "uniref90_seed", "left_semi").where("accession <> uniref90_seed")
    return fam, usr, umap.select(F.col("accession").alias("member"), F.col("uniref90_seed").alias("seed"))


MERGED = f"""{SETS}, shown as (select coalesce(seed, id) as id from usr left join umap on member = id),
    lab as (select id, case when max(f) = 1 and max(u) = 1 then 'FAMILY+USER' when max(f) = 1 then 'FAMILY' else 'USER' end as source from
    (select id, 1 as f, 0 as u from fam union all select id, 0, 1 from shown) group by id),
    meta as (select id, 'Sequence_Source' as field, source as value from lab union all select seed, 'User_IDs_in_Cluster', id from usr join umap on member = id
    union all select id, 'User_IDs_in_Cluster', id from usr where id in (select id from fam) and id not in (select member from umap)
    union all select seed, 'UniRef90_IDs', member from umap union all select seed, 'UniRef90_Cluster_Size', count(*)::varchar from umap group by seed)"""


def merged(v):
    fam, usr, umap = sets(v)
    lists = umap.select(F.col("seed").alias("id"), F.lit("UniRef90_IDs").alias("field"), F.col("member").alias("value"))
    return Q.merge_metadata(fam, usr, umap, family_lists=lists)


@query("st01_merge_ids", f"with {SETS} select id from fam union select id from usr where id not in (select member from umap)")
def _(v):
    return Q.merge_ids(*sets(v))


@query("st02_merge_metadata", f"with {MERGED} select id, field, value from meta")
def _(v):
    return merged(v)


@query(
    "ag13_sequence_set_stats",
    f"""with {MERGED} select count(*) filter (field = 'Sequence_Source') as "Total", count(*) filter (field = 'Sequence_Source' and value <> 'USER') as "Family",
    count(*) filter (value = 'FAMILY+USER') as "FamilyOverlap", count(*) filter (field = 'User_IDs_in_Cluster') as "UniRefOverlap",
    count(*) filter (value = 'USER') as "User", 0::bigint as "UserMatched", 0::bigint as "UserUnmatched" from meta""",
)
def _(v):
    return Q.sequence_set_stats(merged(v))


@query(
    "st03_merge_annotations_meta",
    f"""with {MERGED}, kept_m as (select m.seed as id, m.member as value from umap m join annotations a on a.accession = m.member where a."Sequence_Length" between 150 and 500),
    seeds as (select distinct seed as id from umap), listed as (select * from kept_m union all select id, id from seeds)
    select accession as id, 'Organism' as field, "Organism" as value from annotations union all select id, field, value from meta where field not in ('UniRef90_IDs', 'UniRef90_Cluster_Size')
    union all select id, 'UniRef90_IDs', value from listed union all select id, 'UniRef90_Cluster_Size', count(*)::varchar from listed group by id
    union all select id, 'Cluster_ID_Sequence_Length', "Sequence_Length"::varchar from seeds join annotations on accession = id""",
)
def _(v):
    anno = v.annotations.select(F.col("accession").alias("id"), F.lit("Organism").alias("field"), F.col("Organism").alias("value"))
    return Q.merge_annotations_meta(anno, merged(v), v.annotations, "90", 150, 500)


@query("st05_matched_unmatched", f"with {MAPPED} select uniprot_id, query_id, uniprot_id is not null as matched from looked")
def _(v):
    m, u = A.reverse_map_ids(v.query_ids, v.idmapping)
    return m.withColumn("matched", F.lit(True)).unionByName(u.select(F.lit(None).cast("string").alias("uniprot_id"), "query_id", F.lit(False).alias("matched")))


# ---- selection ------------------------------------------------------------------------------------
@query("sq01_select_family", f"with {PLAIN} select distinct accession as id from family_match where id in (select f from fam)")
def _(v):
    return Q.select_family(FAMS, {"pfam": v.family_match}, v.clans, v.annotations).pieces


@query(
    "sq01_select_family_uniref_domain",
    f"""with {PLAIN} select f.accession as id, f.start, f."end" from family_match f join uniref u on u.accession = f.accession join annotations a on a.accession = f.accession
    where f.id in (select f from fam) and not a."Fragment" and u.uniref90_seed = f.accession""",
)
def _(v):
    s = Q.select_family(FAMS, {"pfam": v.family_match}, v.clans, v.annotations, v.uniref, "90", no_fragments=True, domain=True)
    return s.pieces.select("id", "start", "end")


@query(
    "sq02_select_accessions",
    f"""with {MAPPED} select distinct uniprot_id as id from looked where uniprot_id in (select accession from annotations where not "Fragment")""",
)
def _(v):
    return Q.select_accessions(v.query_ids, v.idmapping, v.annotations, no_fragments=True)["ids"]


@query("sq03_select_fasta", f"with {TOKENS} select distinct uniprot_id as id from named where uniprot_id is not null")
def _(v):
    h = headers(v).withColumn("id", F.concat(F.lit("z"), "ord")).withColumn("seq", F.lit(""))
    return Q.select_fasta(h, True, v.idmapping, v.annotations)["ids"]


@query("sq04_select_blast_hits", "select dst as id from (select dst, max(bitscore) as b from hits group by 1 order by 2 desc, 1 limit 500) union all select 'zINPUTSEQ'")
def _(v):
    return Q.select_blast_hits(v.hits, "MKV LLA", 500)[0]


@query("sq05_select_taxonomy", 'select accession, "Organism", "Taxonomy_ID" from annotations where "Taxonomy_ID" in (3, 7, 11, 42)')
def _(v):
    return Q.select_taxonomy([3, 7, 11, 42], v.annotations).select("accession", "Organism", "Taxonomy_ID")


@query(
    "sq06_fetch_sequences",
    """select case when p.id is null then s.id else s.id || ':' || p.start || ':' || p."end" end as id, case when p.id is null then seq else substr(seq, p.start, p."end" - p.start + 1) end as seq
    from sequences s left join (select distinct accession as id, start, "end" from family_match) p on p.id = s.id""",
)
def _(v):
    return Q.fetch_sequences(v.sequences.select("id"), v.sequences, pieces(v))


@query("sq07_extract_header_ids", f"with {TOKENS} select distinct token as id from cand")
def _(v):
    return Q.extract_header_ids(headers(v))


@query("ag06_set_compare", """select id, count(*) filter (s = 'a') as in_a, count(*) filter (s = 'b') as in_b from (select 'A' || (1000000 + o_custkey * 2) as id, 'a' as s from orders union all select node, 'b' from nodes) group by id""")
def _(v):
    return Q.set_compare(v.table("orders").select(acc(F.col("o_custkey") * 2).alias("id")), v.nodes.withColumnRenamed("node", "id"))
