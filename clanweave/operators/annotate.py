"""Annotation joins and identifier mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clanweave.functions import scalar as S


def family_lists(matches: DataFrame, name: str) -> DataFrame:
    """Distinct families per accession as one comma-separated column.

    Deduplicated before it is gathered, so a list is at most as long as the family dictionary, however many
    match rows one accession has.
    """
    d = matches.select("accession", "id").distinct()
    return d.groupBy("accession").agg(F.array_join(F.sort_array(F.collect_set("id")), ",").alias(name))


def annotate(ids: DataFrame, annotations: DataFrame, taxonomy: DataFrame, pfam: DataFrame, interpro: DataFrame) -> DataFrame:
    """Annotations, taxonomy and family lists per ID; lists are built per accession before joining."""
    out = ids.select(F.col("id").alias("accession")).join(annotations, "accession").join(taxonomy, "Taxonomy_ID", "left")
    return out.join(family_lists(pfam, "PFAM"), "accession", "left").join(family_lists(interpro, "INTERPRO"), "accession", "left")


def classify_interpro(matches: DataFrame) -> DataFrame:
    """Distinct families per accession, split by type into four comma-separated lists."""
    d = matches.select("accession", "id", "family_type").distinct()
    named = {"IPRO_DOM": "Domain", "IPRO_FAM": "Family", "IPRO_SUP": "Homologous_superfamily"}
    lists = [F.array_join(F.sort_array(F.collect_set(F.when(F.col("family_type") == t, F.col("id")))), ",").alias(n) for n, t in named.items()]
    rest = F.array_join(F.sort_array(F.collect_set(F.when(~F.col("family_type").isin(*named.values()), F.col("id")))), ",").alias("IPRO")
    return d.groupBy("accession").agg(*lists, rest)


def merge_annotation_rows(members: DataFrame, annotations: DataFrame, fields: list[str]) -> DataFrame:
    """Values of all members of a seed as rows ``(seed, member, field, value)``.

    The text form joins the values of one field with ``^``; the rows are its unbounded equivalent.
    """
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
    long = annotations.select(F.col("accession").alias("member"), F.explode(F.array(*pairs)).alias("a"))
    return members.select("seed", "member").join(long, "member").select("seed", "member", "a.field", "a.value").where("value is not null")


def reverse_map_ids(ids: DataFrame, idmapping: DataFrame, type_hint: str = "auto", check: bool = False) -> tuple[DataFrame, DataFrame]:
    """``matched(uniprot_id, query_id)`` and ``unmatched(query_id)``.

    A ``xx|`` prefix is dropped; unknown types are in neither list; several accessions for one foreign ID give
    the smallest. ``check`` requires UniProt IDs to occur in the mapping.
    """
    q = ids.select(F.regexp_replace("id", r"^\s*([^|]*\|)?([^\s|]+).*$", "$2").alias("query_id")).distinct()
    kind = S.id_type("query_id") if type_hint.lower() == "auto" else F.lit(type_hint.lower())
    q = q.withColumn("kind", kind).where("kind <> 'unknown'")
    own = q.where("kind = 'uniprot'")
    foreign = q.where("kind <> 'uniprot'")
    table = idmapping.groupBy(F.col("foreign_id").alias("query_id"), F.lower("foreign_id_type").alias("kind")).agg(F.min("uniprot_id").alias("uniprot_id"))
    looked = foreign.join(table, ["query_id", "kind"], "left").select("query_id", "uniprot_id")
    if check:
        known = idmapping.select(F.col("uniprot_id").alias("query_id")).distinct().withColumn("uniprot_id", F.col("query_id"))
        direct = own.join(known, "query_id", "left").select("query_id", "uniprot_id")
    else:
        direct = own.select("query_id", S.strip_version("query_id").alias("uniprot_id"))
    every = looked.unionByName(direct)
    return every.where("uniprot_id is not null").select("uniprot_id", "query_id"), every.where("uniprot_id is null").select("query_id")


def forward_map_ids(accs: DataFrame, idmapping: DataFrame) -> DataFrame:
    """``(accession, ncbi_id)`` rows such as ``GI:123`` for the three NCBI types."""
    kinds = F.lower("foreign_id_type")
    rows = idmapping.where(kinds.isin("gi", "refseq", "embl-cds")).select(
        F.col("uniprot_id").alias("accession"), F.concat_ws(":", F.upper("foreign_id_type"), "foreign_id").alias("ncbi_id")
    )
    return rows.join(accs.select(F.col("id").alias("accession")).distinct(), "accession", "left_semi")


def match_headers(fasta: DataFrame, idmapping: DataFrame, annotations: DataFrame) -> DataFrame:
    """Header tokens of known type, ``(ord, pos, token, uniprot_id)``; ``uniprot_id`` is NULL for other IDs."""
    tokens = fasta.select("ord", F.posexplode(S.header_ids("header")).alias("pos", "token")).withColumn("kind", S.id_type("token"))
    tokens = tokens.where("kind <> 'unknown'")
    table = idmapping.groupBy(F.col("foreign_id").alias("token"), F.lower("foreign_id_type").alias("kind")).agg(F.min("uniprot_id").alias("mapped"))
    looked = tokens.join(table, ["token", "kind"], "left")
    cand = F.when(F.col("kind") == "uniprot", F.regexp_replace("token", r"\..+$", "")).otherwise(F.col("mapped"))
    known = annotations.select(F.col("accession").alias("cand"), F.lit(True).alias("known"))
    return (
        looked.withColumn("cand", cand).join(known, "cand", "left")
        .select("ord", "pos", "token", F.when(F.col("known"), F.col("cand")).alias("uniprot_id"))
    )


def header_match_stats(fasta: DataFrame, tokens: DataFrame, headers: int | None = None) -> DataFrame:
    """One row: sequences, sequences' surplus IDs, matched and unmatched IDs."""
    per = tokens.where("uniprot_id is not null").select("ord", "uniprot_id").distinct()
    multi = per.groupBy("ord").agg((F.count(F.lit(1)) - 1).alias("x")).agg(F.coalesce(F.sum("x"), F.lit(0)).alias("multi_id"))
    seqs = fasta.agg(F.count(F.lit(1)).alias("sequences"))
    hit = per.agg(F.countDistinct("uniprot_id").alias("matched"))
    names = ["sequences", "multi_id", "matched"]
    # Three one-row aggregates stacked into one row by a union, not by a cross join.
    stacked = None
    for df, own in zip((seqs, multi, hit), names):
        row = df.select(*[F.col(n) if n == own else F.lit(0).cast("long").alias(n) for n in names])
        stacked = row if stacked is None else stacked.unionByName(row)
    return stacked.agg(*[F.sum(n).alias(n) for n in names]).withColumn("unmatched", F.expr("sequences + multi_id - matched"))


def uniref_members(seeds: DataFrame, uniref: DataFrame, version: str, annotations: DataFrame | None = None) -> DataFrame:
    """``(seed, member)``; pass ``annotations`` to leave fragments out."""
    col = f"uniref{version}_seed"
    rows = uniref.join(seeds.select(F.col("seed").alias(col)).distinct(), col, "left_semi")
    rows = rows.select(F.col(col).alias("seed"), F.col("accession").alias("member"))
    if annotations is not None:
        rows = rows.join(annotations.where(~F.col("Fragment")).select(F.col("accession").alias("member")), "member", "left_semi")
    return rows


def uniref_seeds(ids: DataFrame, uniref: DataFrame, version: str = "") -> DataFrame:
    """Mapping rows whose accession (or seed, by ``version``) is listed; ``id|x`` counts as ``id``."""
    col = f"uniref{version}_seed" if version else "accession"
    q = ids.select(F.element_at(F.split("id", r"\|"), 1).alias(col)).distinct()
    return uniref.join(q, col, "left_semi").select("accession", "uniref90_seed", "uniref50_seed")


def domain_pieces(ids: DataFrame, family: str, matches: DataFrame, annotations: DataFrame | None = None) -> DataFrame:
    """``(id, start, end[, full_len])`` of one family's matches on the listed IDs."""
    rows = matches.where(F.col("id") == family).select(F.col("accession").alias("id"), "start", "end")
    rows = rows.join(ids.select("id").distinct(), "id", "left_semi")
    if annotations is not None:
        rows = rows.join(annotations.select(F.col("accession").alias("id"), F.col("Sequence_Length").alias("full_len")), "id", "left")
    return rows


def family_names(families: DataFrame, info: DataFrame) -> DataFrame:
    """Short and long names of (possibly fused) families; short falls back to the ID, long to short."""
    parts = families.select("family", F.posexplode(F.split("family", "-")).alias("pos", "part")).distinct()
    named = parts.join(info.select(F.col("family").alias("part"), "short_name", "long_name"), "part", "left")
    short = F.coalesce(F.nullif("short_name", F.lit("")), "part")
    long = F.coalesce(F.nullif("long_name", F.lit("")), short)
    listed = named.groupBy("family").agg(F.sort_array(F.collect_list(F.struct("pos", short.alias("s"), long.alias("l")))).alias("n"))
    return listed.select("family", F.array_join(F.col("n.s"), "-").alias("short"), F.array_join(F.col("n.l"), "-").alias("long"))


def merge_uniref(ur50: DataFrame, ur90: DataFrame) -> DataFrame:
    """Outer join of two ``(accession, seed)`` tables; a missing seed is the empty string."""
    a = ur50.select("accession", F.col("seed").alias("uniref50_seed"))
    b = ur90.select("accession", F.col("seed").alias("uniref90_seed"))
    empty = F.lit("")
    return a.join(b, "accession", "full").select("accession", F.coalesce("uniref50_seed", empty).alias("uniref50_seed"), F.coalesce("uniref90_seed", empty).alias("uniref90_seed"))
