"""Building the reference tables from their dumps, family counts and length histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clanweave import schemas
from clanweave.functions import scalar as S
from clanweave.functions.ordered import ordered_scan
from clanweave.operators.sequences import foreign_id_filter, remove_ids
from clanweave.sources.ordered import ORDER, records


# Lines of the flat file.
LINE = {
    "description": r"^DE   (?!\s*EC=)(.*);",
    "organism": r"^OS   (.*)$",
    "go": r"^DR   GO; GO:(\d+); F:(.*);",
    "brenda": r"^DR   BRENDA; (\S+); (\S+)",
    "gene": r"^GN   \w+=(\w+)",
    "pdb": r"^DR   PDB; (\w+);",
    "kegg": r"^DR   KEGG; (\S+); \S+",
    "string": r"^DR   STRING; (\S+); \S+",
    "patric": r"^DR   PATRIC; (\S+); \S+",
    "ec": r"^DE\s+EC=(.*);",
    "cazy": r"^DR\s+CAZy; (\w+);",
    "taxon": r"(?m)^OX   NCBI_TaxID=(\d+)",
    "accession": r"(?m)^AC\s+(\w+);",
    "proteome": r"(?m)^KW\s+Reference proteome(\s+\{([^\}]+)\})?",
    "head": r"(?m)^ID\s+(\w+)\s+(\w+);\s+(\d+)",
}


# ---- annotations ----------------------------------------------------------------------------------
def _lines(record: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(record, F.lit("(?m)" + pattern), F.lit(group))


def _last(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.element_at(values, -1))


def _listed(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def build_annotations(
    records: DataFrame, gdna: DataFrame | None = None, hmp: DataFrame | None = None, targets: DataFrame | None = None
) -> DataFrame:
    """One annotation row per flat-file record; lists stay arrays and "no value" is NULL.

    ``gdna(Taxonomy_ID)``, ``hmp(Taxonomy_ID, sites, oxygen)`` and ``targets(accession, Target_ID)`` are optional
    side tables.
    """
    r = F.col("record")
    de = F.array_join(_lines(r, LINE["description"]), "")
    os = F.array_join(_lines(r, LINE["organism"]), "")
    tax = F.regexp_extract(r, LINE["taxon"], 1)
    go = F.zip_with(_lines(r, LINE["go"], 1), _lines(r, LINE["go"], 2), lambda a, b: F.replace(F.concat_ws(" ", a, b), F.lit(","), F.lit(" ")))
    brenda = F.zip_with(_lines(r, LINE["brenda"], 1), _lines(r, LINE["brenda"], 2), lambda a, b: F.concat_ws(" ", a, b))
    kw = LINE["proteome"]
    head = LINE["head"]
    status = F.regexp_extract(r, head, 2)
    desc = S.clean_description(de)
    out = records.select(
        F.regexp_extract(r, LINE["accession"], 1).alias("accession"), F.regexp_extract(r, head, 1).alias("Uniprot_ID"), status.alias("STATUS"),
        F.regexp_extract(r, head, 3).cast("int").alias("Sequence_Length"), F.nullif(tax, F.lit("")).cast("int").alias("Taxonomy_ID"),
        desc.alias("Description"), F.when(status == "Reviewed", desc).alias("SwissProt_Description"), S.clean_organism(os).alias("Organism"),
        _last(_lines(r, LINE["gene"])).alias("GN"), _listed(_lines(r, LINE["pdb"])).alias("pdb"), _listed(go).alias("GO"),
        _listed(_lines(r, LINE["kegg"])).alias("KEGG"), _listed(_lines(r, LINE["string"])).alias("STRING"), _listed(brenda).alias("BRENDA"),
        _listed(_lines(r, LINE["patric"])).alias("PATRIC"), _last(_lines(r, LINE["ec"])).alias("EC"),
        _listed(_lines(r, LINE["cazy"])).alias("Cazy"), S.is_fragment(de).alias("Fragment"),
        F.when(r.rlike(kw), F.when(F.regexp_extract(r, kw, 2) != "", F.regexp_extract(r, kw, 2)).otherwise("1")).alias("Ref_Proteome"),
    )
    if gdna is not None:
        known = gdna.select("Taxonomy_ID").distinct().withColumn("_g", F.lit(True))
        out = out.join(known, "Taxonomy_ID", "left").withColumn("GDNA", F.coalesce("_g", F.lit(False))).drop("_g")
    if hmp is not None:
        out = out.join(hmp.select("Taxonomy_ID", F.col("sites").alias("HMP_Body_Site"), F.col("oxygen").alias("HMP_Oxygen")), "Taxonomy_ID", "left")
    if targets is not None:
        out = out.join(targets.select("accession", "Target_ID"), "accession", "left")
    return out


def build_hmp_lookup(hmp: DataFrame) -> DataFrame:
    """Distinct body sites and oxygen demands per taxon from ``(Taxonomy_ID, site, oxygen)``; empty → ``Not Specified``.

    Both are small vocabularies, deduplicated before they are gathered.
    """
    def distinct(col: str, name: str) -> DataFrame:
        text = F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit("Not Specified"))
        v = hmp.select("Taxonomy_ID", F.explode(F.split(text, r",\s*")).alias("v")).distinct()
        return v.groupBy("Taxonomy_ID").agg(F.sort_array(F.collect_set("v")).alias(name))

    return distinct("site", "sites").join(distinct("oxygen", "oxygen"), "Taxonomy_ID")


# ---- families -------------------------------------------------------------------------------------
def build_family_tables(matches: DataFrame, types: DataFrame, tree: DataFrame, last_location_only: bool = False) -> dict[str, DataFrame]:
    """Family tables from match locations: one per source database, and INTERPRO with type, parent and leaf flag."""
    m = matches
    if last_location_only:
        m = m.groupBy("accession", "dbname", "match_id", "ipr_id").agg(F.max(F.struct("loc", "start", "end")).alias("l")).select("accession", "dbname", "match_id", "ipr_id", "l.start", "l.end")
    ipr = m.where("ipr_id is not null").select(F.col("ipr_id").alias("id"), "accession", "start", "end")
    t = types.select(F.col("family").alias("id"), "family_type")
    h = tree.select(F.col("family").alias("id"), "parent", "is_leaf")
    ipr = ipr.join(t, "id", "left").join(h, "id", "left").withColumn("is_leaf", F.coalesce("is_leaf", F.lit(True)))
    sources = {"PFAM": ["PFAM"], "GENE3D": ["GENE3D", "CATHGENE3D"], "SSF": ["SSF"], "TIGRFAMs": ["TIGRFAMs"]}
    out = {n: m.where(F.col("dbname").isin(*dbs)).select(F.col("match_id").alias("id"), "accession", "start", "end") for n, dbs in sources.items()}
    out["INTERPRO"] = ipr
    return out


def build_interpro_tree(spark: SparkSession, path: str) -> DataFrame:
    """``(family, parent, is_leaf)`` from the indented tree (two dashes a level).

    The parent is the last line of the level above that precedes a line. Per level, the lines above are counted
    along the file order; a line's count names its parent, which is then an equi-join.
    """
    lines = records(spark, path)
    fam = F.regexp_extract("value", r"^-*(IPR\d+)", 1)
    depth = F.expr("length(regexp_extract(value, '^(-*)', 1)) div 2")
    rows = lines.select(*ORDER, fam.alias("family"), depth.alias("depth")).where("family <> ''")
    role = F.explode(F.array(F.struct(F.col("depth").alias("level"), F.lit(0).cast("long").alias("above")), F.struct((F.col("depth") + 1).alias("level"), F.lit(1).cast("long").alias("above"))))
    both = rows.select(*ORDER, "family", role.alias("r")).select(*ORDER, "family", "r.level", "r.above")
    counted = ordered_scan(both, ["level"], [*ORDER, "above"], sums={"_k": F.col("above")})
    parents = counted.where("above = 1").select("level", "_k", F.col("family").alias("parent"))
    tree = counted.where("above = 0").join(parents, ["level", "_k"], "left").groupBy("family").agg(F.max("parent").alias("parent"))
    inner = tree.where("parent is not null").select(F.col("parent").alias("family")).distinct().withColumn("_inner", F.lit(True))
    return tree.join(inner, "family", "left").select("family", "parent", F.col("_inner").isNull().alias("is_leaf"))


def family_counts(matches: DataFrame, uniref: DataFrame, clans: DataFrame, merge_domain: bool = True, own_seeds: bool = False) -> DataFrame:
    """``(type, family, total, uniref50, uniref90)`` for families and clans.

    ``merge_domain`` counts an accession once per family; ``own_seeds`` counts only seeds that are in the family
    themselves. Every distinct count runs over deduplicated pairs.
    """
    j = matches.select(F.col("id").alias("family"), "accession").join(uniref, "accession", "left")
    total = F.countDistinct("accession") if merge_domain else F.count(F.lit(1))
    fam = j.groupBy("family").agg(total.alias("total"))
    seeds = lambda kind: j.select("family", F.col(f"{kind}_seed").alias("accession")).distinct()
    members = matches.select(F.col("id").alias("family"), "accession").distinct()
    for kind in ("uniref50", "uniref90"):
        s = seeds(kind).where("accession is not null")
        if own_seeds:
            s = s.join(members, ["family", "accession"], "left_semi")
        fam = fam.join(s.groupBy("family").agg(F.count(F.lit(1)).alias(kind)), "family", "left")
    fam = fam.select(F.lit("FAMILY").alias("type"), "family", "total", F.coalesce("uniref50", F.lit(0)).alias("uniref50"), F.coalesce("uniref90", F.lit(0)).alias("uniref90"))
    c = j.join(clans.select(F.col("pfam_id").alias("family"), "clan_id"), "family").groupBy("clan_id").agg(
        F.countDistinct("accession").alias("total"), F.countDistinct("uniref50_seed").alias("uniref50"), F.countDistinct("uniref90_seed").alias("uniref90")
    )
    return fam.unionByName(c.select(F.lit("CLAN").alias("type"), F.col("clan_id").alias("family"), "total", "uniref50", "uniref90"))


def family_info(counts: DataFrame, names: DataFrame, clan_names: DataFrame | None = None, types: DataFrame | None = None, tree: DataFrame | None = None) -> DataFrame:
    """Names, sizes, type and parent per family; sizes default to 0, families without a name are called by ID."""
    named = names.select("family", F.coalesce("short_name", F.lit("")).alias("short_name"), F.coalesce("long_name", F.lit("")).alias("long_name"))
    if clan_names is not None:
        named = named.unionByName(clan_names.select("family", "short_name", F.lit("").alias("long_name")))
    sizes = counts.select("family", F.col("total").alias("num_members"), F.col("uniref50").alias("num_uniref50_members"), F.col("uniref90").alias("num_uniref90_members"))
    j = named.join(sizes, "family", "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = j.select("family", F.coalesce("short_name", "family").alias("short_name"), F.coalesce("long_name", "family").alias("long_name"), *[zero(c) for c in ("num_members", "num_uniref50_members", "num_uniref90_members")])
    if types is not None:
        out = out.join(types.select("family", "family_type"), "family", "left")
    if tree is not None:
        out = out.join(tree.select("family", "parent"), "family", "left")
    return out


def family_size(families: list[str], info: DataFrame) -> DataFrame:
    """Sizes per listed family and their total (``family`` is NULL)."""
    cols = ["num_members", "num_uniref50_members", "num_uniref90_members"]
    return info.where(F.col("family").isin(*families)).rollup("family").agg(*[F.sum(c).alias(c) for c in cols])


def distinct_member_count(matches: DataFrame, uniref: DataFrame) -> DataFrame:
    j = matches.select(F.col("id").alias("family"), "accession").join(uniref, "accession", "left")
    return j.groupBy("family").agg(F.countDistinct("accession").alias("accessions"), F.countDistinct("uniref50_seed").alias("uniref50"), F.countDistinct("uniref90_seed").alias("uniref90"))


def family_overlap(matches: DataFrame, families: list[str] | None = None) -> DataFrame:
    """Percentage (three decimals) of a family's IDs that are also in another listed family."""
    d = matches if families is None else matches.where(F.col("id").isin(*families))
    d = d.select(F.col("id").alias("family"), "accession").distinct()
    shared = d.groupBy("accession").agg((F.count(F.lit(1)) > 1).alias("_shared"))
    c = d.join(shared, "accession").groupBy("family").agg(F.count_if("_shared").alias("_x"), F.count(F.lit(1)).alias("_n"))
    return c.select("family", (F.floor(F.lit(100000) * F.col("_x") / F.col("_n") + 0.5) / 1000).alias("percent"))


# ---- lengths --------------------------------------------------------------------------------------
def length_histogram(lengths: DataFrame, incfrac: float = 0.99) -> DataFrame:
    """``(length, count)``: sequences per length, both tails trimmed, zero-filled.

    The ordered part has one row per length, bounded by the longest sequence.
    """
    counts = lengths.groupBy(F.col("len").cast("int").alias("length")).agg(F.count(F.lit(1)).alias("count"))
    span = counts.agg(F.max("length").alias("m"), F.sum("count").alias("_total"))
    grid = span.select("_total", F.explode(F.sequence(F.lit(0), F.col("m") + 1)).alias("length"), "m")
    t = F.floor(F.col("_total") * (1 - F.lit(incfrac)) / 2)
    w = Window.orderBy("length")
    filled = grid.join(counts, "length", "left").withColumn("count", F.coalesce("count", F.lit(0))).withColumn("_cum", F.sum("count").over(w))
    real = F.col("length") <= F.col("m")
    limits = filled.withColumn("_lo", F.count_if(real & (F.col("_cum") < t)).over(Window.partitionBy(F.lit(1))))
    limits = limits.withColumn("_hi", F.count_if(real & (F.col("_cum") - F.col("count") <= F.col("_total") - t)).over(Window.partitionBy(F.lit(1))))
    return limits.where("length between _lo and _hi").select("length", "count")


def domain_histogram_lengths(pieces: DataFrame) -> DataFrame:
    """Domain lengths as the histogram counts them: end − start."""
    return pieces.select((F.col("end") - F.col("start")).alias("len"))


def set_lengths(ids: DataFrame, annotations: DataFrame, meta: DataFrame, expand: bool = False) -> DataFrame:
    """Lengths of a set: annotated sequences (or, expanded, all members of their UniRef lists) and unmatched ``z…`` records."""
    known = ids.where(~F.col("id").startswith("z")).select("id")
    if expand:
        lists = meta.where(F.col("field").isin("UniRef90_IDs", "UniRef50_IDs")).join(known, "id", "left_semi")
        best = lists.groupBy("id").agg(F.max("field").alias("field"))
        members = lists.join(best, ["id", "field"]).select(F.col("value").alias("id"), F.col("id").alias("_owner"))
        rest = known.join(members.select(F.col("_owner").alias("id")).distinct(), "id", "left_anti")
        known = members.select("id").unionByName(rest)
    lens = known.join(annotations.select(F.col("accession").alias("id"), F.col("Sequence_Length").alias("len")), "id").select("len")
    own = meta.where((F.col("field") == "Sequence_Length") & F.col("id").startswith("z")).select(F.col("value").cast("int").alias("len"))
    return lens.unionByName(own)


# ---- genomes, taxonomy, mappings ------------------------------------------------------------------
def build_gene_positions(contigs: DataFrame, idmapping: DataFrame | None = None, allowed: DataFrame | None = None) -> DataFrame:
    """Gene rows from coding features: ordinal on the contig, strand, ends and every UniProt accession.

    A feature without an accession is looked up by its protein IDs.
    """
    b = contigs.select(F.col("contig").alias("ID"), F.col("type").alias("TYPE"), F.posexplode("blocks").alias("_i", "_b")).where(F.col("_b").contains("/translation="))
    first = F.regexp_extract("_b", r"^([^\n]*)", 1)
    text = F.regexp_extract("_b", r"(?s)^(.*?)/translation=", 1)
    ends = r"(\d+)\..*\.>?(\d+)"
    g = b.select(
        "ID", "TYPE", (F.col("_i") + 1).alias("NUM"), F.when(F.trim(first).startswith("complement"), 0).otherwise(1).alias("DIRECTION"),
        F.regexp_extract(first, ends, 1).try_cast("int").alias("start"), F.regexp_extract(first, ends, 2).try_cast("int").alias("stop"),
        F.array_distinct(F.regexp_extract_all(text, F.lit(r'/db_xref="UniProtKB/[a-zA-Z0-9-]+:(\w+)"'), F.lit(1))).alias("_acc"),
        F.regexp_extract_all(text, F.lit(r'/protein_id="([a-zA-Z0-9.]+)"'), F.lit(1)).alias("_prot"),
    )
    cols = ["ID", "AC", "NUM", "TYPE", "DIRECTION", "start", "stop"]
    out = g.withColumn("AC", F.explode("_acc")).select(*cols)
    if idmapping is not None:
        table = idmapping.where(F.lower("foreign_id_type") == "embl-cds").groupBy(F.col("foreign_id").alias("_p")).agg(F.min("uniprot_id").alias("AC"))
        out = out.unionByName(g.where(F.size("_acc") == 0).withColumn("_p", F.explode("_prot")).join(table, "_p").select(*cols))
    return out if allowed is None else out.join(allowed.select(F.col("id").alias("AC")), "AC", "left_semi")


_BELOW = {"genus": "species", "family": "genus", "order": "family", "class": "order", "phylum": "class", "kingdom": "phylum", "superkingdom": "kingdom"}
_RANK_COLUMNS = {"Domain": "superkingdom", "Kingdom": "kingdom", "Phylum": "phylum", "Class": "class", "TaxOrder": "order", "Family": "family", "Genus": "genus"}


def build_taxonomy(taxa: DataFrame) -> DataFrame:
    """One row per taxon with a name per rank, ``NA`` where missing; children without a rank get the next one below."""
    below = F.coalesce(*[F.when(F.col("rank") == a, F.lit(b)) for a, b in _BELOW.items()], F.col("rank"))
    own = taxa.select("tax_id", "rank", "name", F.lit(1).alias("_own"))
    kids = taxa.select(below.alias("_below"), F.explode("children").alias("c")).select(F.col("c._taxId").alias("tax_id"), F.coalesce("c._rank", "_below").alias("rank"), F.col("c._scientificName").alias("name"), F.lit(0).alias("_own"))
    nodes = own.unionByName(kids).groupBy("tax_id").agg(F.max_by("rank", F.when(F.col("rank").isNotNull(), F.col("_own"))).alias("rank"), F.max_by("name", F.when(F.col("name").isNotNull(), F.col("_own"))).alias("name"))
    line = taxa.select("tax_id", F.explode("lineage").alias("l")).select("tax_id", F.col("l._taxId").alias("_up"), F.col("l._rank").alias("_rank"), F.col("l._scientificName").alias("_name"))
    ranks = nodes.select(F.col("tax_id").alias("_up"), F.col("rank").alias("_known"))
    line = line.join(ranks, "_up", "left").withColumn("_rank", F.coalesce("_rank", "_known"))
    wide = line.groupBy("tax_id").agg(*[F.max(F.when(F.col("_rank") == r, F.col("_name"))).alias(c) for c, r in _RANK_COLUMNS.items()])
    na = lambda c: F.coalesce(c, F.lit("NA")).alias(c)
    out = nodes.withColumnRenamed("tax_id", "Taxonomy_ID").withColumnRenamed("name", "Species").join(wide.withColumnRenamed("tax_id", "Taxonomy_ID"), "Taxonomy_ID", "left")
    return out.select("Taxonomy_ID", *[na(c) for c in schemas.TAXON_RANKS], na("Species"))


def build_uniref(members50: DataFrame, members90: DataFrame) -> DataFrame:
    from clanweave.operators.annotate import merge_uniref

    shape = lambda m: m.select(F.col("member").alias("accession"), "seed")
    return merge_uniref(shape(members50), shape(members90))


def build_idmapping(rows: DataFrame, types: list[str]) -> DataFrame:
    return foreign_id_filter(rows, types)


def build_pdb_hits(hits: DataFrame) -> DataFrame:
    """``(ACC, PDB, e)`` from hit rows ``(query, subject, evalue)`` named ``x|ACC|y`` and ``x|y|z|PDB|c``."""
    acc, pdb = F.regexp_extract("query", r"\w+\|(\w+)\|\w+", 1), F.regexp_extract("subject", r"\w+\|\w+\|\w+\|(\w+)\|\w+", 1)
    return hits.select(acc.alias("ACC"), pdb.alias("PDB"), F.col("evalue").alias("e")).where("ACC <> ''")


def drop_fragments(tables: dict[str, DataFrame], annotations: DataFrame, key: str = "id") -> dict[str, DataFrame]:
    """The sequence sets without fragment IDs."""
    gone = annotations.where("Fragment").select(F.col("accession").alias("id"))
    return {n: remove_ids(df, gone, key) for n, df in tables.items()}

