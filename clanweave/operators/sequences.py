"""Sequence sets: family, accession, FASTA, search-hit and taxonomy selection; pieces of domains; merging.

Sets are long: pieces are rows ``(id, start, end[, full_len])`` and list-valued metadata are rows
``(id, field, value)``, so nothing grows with the number of members of one group.
"""

from __future__ import annotations

from collections.abc import Sequence as Seq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clanweave.functions import scalar as S
from clanweave.functions.ordered import ordered_scan, rank_all

# Source labels of a merged set.
FAMILY, USER, BOTH = "FAMILY", "USER", "FAMILY+USER"
BLAST_HIT, BLAST_BOTH, INPUT = "BLASTHIT", "FAMILY+BLASTHIT", "INPUT"
INPUT_ID = "zINPUTSEQ"


# ---- filters --------------------------------------------------------------------------------------
def filter_sequences_by_length(seqs: DataFrame, min_len: int = 0, max_len: int = 0, col: str = "seq_len") -> DataFrame:
    keep = F.lit(True)
    if min_len:
        keep &= F.col(col) >= min_len
    if max_len:
        keep &= F.col(col) <= max_len
    return seqs.where(keep)


def domain_lengths(seqs: DataFrame) -> DataFrame:
    """``Cluster_ID_Domain_Length`` rows of domain nodes, from the residues present."""
    return seqs.where(F.col("id").rlike(S.DOMAIN_SUFFIX)).select(
        "id", F.lit("Cluster_ID_Domain_Length").alias("field"), F.col("seq_len").cast("string").alias("value")
    )


def exclude_fragments(ids: DataFrame, annotations: DataFrame) -> DataFrame:
    whole = annotations.where(~F.col("Fragment")).select(F.col("accession").alias("id"))
    return ids.join(whole, "id", "left_semi")


def remove_ids(df: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    return df.join(ids.select(F.col("id").alias(col)), col, "left_anti")


def filter_attributes(df: DataFrame, spec: Seq[str]) -> DataFrame:
    """Only the listed attributes; status and length always stay."""
    keep = {"accession", "STATUS", "Sequence_Length", *spec}
    return df.select(*[c for c in df.columns if c in keep])


def foreign_id_filter(idmap: DataFrame, types: Seq[str]) -> DataFrame:
    kind = F.lower("foreign_id_type")
    return idmap.where(kind.isin(*types)).withColumn("foreign_id_type", kind)


# ---- families -------------------------------------------------------------------------------------
def expand_clans(families: DataFrame, clans: DataFrame) -> DataFrame:
    """``CL…`` entries become their families; all others pass through."""
    is_clan = F.lower("family").startswith("cl")
    hit = families.where(is_clan).join(clans, F.col("family") == F.col("clan_id")).select(F.col("pfam_id").alias("family"))
    return families.where(~is_clan).select("family").unionByName(hit).distinct()


def family_members(families: DataFrame, matches: DataFrame, uniref: DataFrame | None = None, annotations: DataFrame | None = None) -> DataFrame:
    """Match rows of the listed families; seeds and annotations are joined only when given."""
    out = matches.join(families.select(F.col("family").alias("id")).distinct(), "id", "left_semi")
    if uniref is not None:
        out = out.join(uniref, "accession", "left")
    if annotations is not None:
        info = annotations.select("accession", "STATUS", "Fragment", F.col("Sequence_Length").alias("full_len"))
        out = out.join(info, "accession", "left")
    return out


def isoform_dedup(rows: DataFrame, order: Seq[str]) -> DataFrame:
    """First row per accession (isoform suffix removed) in ``order``; a struct minimum, combined map-side."""
    rest = [c for c in rows.columns if c not in order and c != "accession"]
    keyed = rows.withColumn("_acc", S.strip_isoform("accession"))
    first = keyed.groupBy("_acc").agg(F.min(F.struct(*order, *[c for c in rest])).alias("f"))
    return first.select(F.col("_acc").alias("accession"), *[F.col(f"f.{c}").alias(c) for c in rows.columns if c != "accession"])


def sample_fraction(rows: DataFrame, n: int, order: Seq[str], seed: str | None = None, keep_reviewed: bool = True) -> DataFrame:
    """Every n-th row in ``order`` (counter from 1) and every reviewed one.

    With ``seed`` the counter moves on when a seed is met for the first time, otherwise with each row.
    """
    if n < 2:
        return rows
    placed = rank_all(rows, list(order), "_rn")
    if seed is None:
        placed = placed.withColumn("_count", F.col("_rn"))
    else:
        first = placed.groupBy(seed).agg(F.min("_rn").alias("_rn")).select("_rn", F.lit(1).cast("long").alias("_new"))
        flagged = placed.join(first, "_rn", "left").withColumn("_new", F.coalesce("_new", F.lit(0).cast("long")))
        placed = ordered_scan(flagged, [], ["_rn"], sums={"_seen": F.col("_new")}).withColumn("_count", F.col("_seen") - F.col("_new") + 1)
    keep = F.col("_count") % n == 0
    if keep_reviewed:
        keep |= F.col("STATUS") == "Reviewed"
    return placed.where(keep).select(*rows.columns)


def domain_region(pieces: DataFrame, region: str) -> DataFrame:
    """Replace the pieces of each ID by the stretches before (``nterminal``) or after (``cterminal``) them."""
    if region == "cterminal":
        near = ordered_scan(pieces, ["id"], ["start", "end"], leads={"_next": F.col("start")})
        start, end = F.col("end") + 1, F.coalesce(F.col("_next") - 1, F.col("full_len"))
    elif region == "nterminal":
        near = ordered_scan(pieces, ["id"], ["start", "end"], lags={"_prev": F.col("end")})
        start, end = F.coalesce("_prev", F.lit(0)) + 1, F.col("start") - 1
    else:
        raise ValueError(region)
    rest = [c for c in pieces.columns if c not in ("id", "start", "end")]
    return near.select("id", start.alias("start"), end.alias("end"), *rest).where(F.col("end") - F.col("start") > 0)


@dataclass
class FamilySelection:
    """``pieces(id, start, end[, full_len])``, ``uniref_map(member, seed)``, ``uniref_members(seed, member)``, ``full_size`` (one row)."""

    pieces: DataFrame
    uniref_map: DataFrame | None
    uniref_members: DataFrame | None
    full_size: DataFrame


def select_family(
    families: Seq[str],
    tables: dict[str, DataFrame],
    clans: DataFrame,
    annotations: DataFrame,
    uniref: DataFrame | None = None,
    uniref_version: str = "",
    fraction: int = 1,
    no_fragments: bool = False,
    domain: bool = False,
    region: str = "",
) -> FamilySelection:
    """Members of the listed families over several match tables (``pfam``, ``interpro``, ``gene3d``, ``ssf``).

    Matches of an isoform count for its protein, so the suffix goes before anything is joined.
    """
    spark = clans.sparkSession
    listed = spark.createDataFrame([(f, i) for i, f in enumerate(families)], "family string, pos int")
    plain = expand_clans(listed, clans)
    seed = f"uniref{uniref_version}_seed" if uniref_version else None
    need_info = fraction > 1 or no_fragments or region == "cterminal"
    parts, size = [], None
    for matches in tables.values():
        clean = matches.select("id", S.strip_isoform("accession").alias("accession"), "start", "end")
        got = family_members(plain, clean, uniref if seed else None, annotations if need_info else None)
        if no_fragments:
            got = got.where(~F.col("Fragment"))
        order = ["id", "accession", "start", "end"]
        if not domain:
            got = isoform_dedup(got, ["id", "start", "end"])
        every = got
        got = sample_fraction(got, fraction, order, seed)
        parts.append((every, got))
    every = parts[0][0]
    got = parts[0][1]
    for e, g in parts[1:]:
        every, got = every.unionByName(e), got.unionByName(g)
    size = every.agg(F.countDistinct("accession").alias("full_size"))
    cols = [F.col("accession").alias("id"), "start", "end"] + (["full_len"] if need_info else [])
    if not seed:
        pieces, umap, members = got.select(*cols), None, None
    else:
        pieces = got.where(F.col(seed) == F.col("accession")).select(*cols)
        umap = got.where(F.col(seed) != F.col("accession")).select(F.col("accession").alias("member"), F.col(seed).alias("seed")).distinct()
        members = every.select(F.col(seed).alias("seed"), F.col("accession").alias("member")).distinct()
    if not domain:
        pieces = pieces.select("id").distinct()
    elif region:
        pieces = domain_region(pieces, region)
    return FamilySelection(pieces, umap, members, size)


# ---- hits -----------------------------------------------------------------------------------------
def top_hits(hits: DataFrame, max_results: int) -> DataFrame:
    """Best ``max_results`` distinct subjects by bitscore (a top-k report); ``a|ID|b`` counts as ``ID``."""
    sid = F.when(F.col("dst").rlike(r"^.*\|\w+\|.*$"), F.regexp_extract("dst", r"^.*\|(\w+)\|.*$", 1)).otherwise(F.col("dst"))
    best = hits.groupBy(sid.alias("id")).agg(F.max("bitscore").alias("bitscore"))
    return best.orderBy(F.desc("bitscore"), F.asc("id")).limit(max_results)


def select_blast_hits(hits: DataFrame, query_seq: str, max_results: int, uniref: DataFrame | None = None, version: str = "") -> tuple[DataFrame, DataFrame]:
    """``(ids, metadata rows)``: the best hits and the query itself as ``zINPUTSEQ``."""
    top = top_hits(hits, max_results).select("id")
    spark = hits.sparkSession
    length = len("".join(query_seq.split()))
    own = spark.createDataFrame([(INPUT_ID, "Description", "Input Sequence"), (INPUT_ID, "Sequence_Length", str(length))], "id string, field string, value string")
    meta = own
    if uniref is not None:
        seed = f"uniref{version}_seed"
        lists = uniref.join(top.withColumnRenamed("id", seed), seed, "left_semi")
        meta = meta.unionByName(lists.select(F.col(seed).alias("id"), F.lit(f"UniRef{version}_IDs").alias("field"), F.col("accession").alias("value")))
    ids = top.unionByName(spark.createDataFrame([(INPUT_ID,)], "id string"))
    return ids, meta


def select_taxonomy(tax_ids: Seq[int], annotations: DataFrame) -> DataFrame:
    return annotations.where(F.col("Taxonomy_ID").isin(*tax_ids))


def select_accessions(
    ids: DataFrame,
    idmapping: DataFrame,
    annotations: DataFrame,
    uniref: DataFrame | None = None,
    uniref_version: str = "",
    no_fragments: bool = False,
    family_matches: DataFrame | None = None,
    family: str = "",
    region: str = "",
) -> dict[str, DataFrame]:
    """Map a user ID list; optionally drop fragments, list UniRef members and cut to one family's domains."""
    from clanweave.operators.annotate import domain_pieces, reverse_map_ids, uniref_members

    matched, unmatched = reverse_map_ids(ids, idmapping)
    acc = matched.select(F.col("uniprot_id").alias("id")).distinct()
    if no_fragments:
        acc = exclude_fragments(acc, annotations)
    out = {"matched": matched, "unmatched": unmatched, "ids": acc}
    if uniref is not None:
        out["uniref_members"] = uniref_members(acc.withColumnRenamed("id", "seed"), uniref, uniref_version)
    if family:
        pieces = domain_pieces(acc, family, family_matches, annotations)
        out["pieces"] = domain_region(pieces, region) if region else pieces
    return out


def select_fasta(fasta: DataFrame, use_headers: bool, idmapping: DataFrame | None = None, annotations: DataFrame | None = None) -> dict[str, DataFrame]:
    """``sequences`` keeps user records under ``z`` IDs; with headers, matched records become accessions."""
    if not use_headers:
        return {"sequences": fasta.select("id", "seq"), "ids": fasta.select("id").where("false")}
    from clanweave.operators.annotate import match_headers

    tokens = match_headers(fasta, idmapping, annotations)
    hit = tokens.where("uniprot_id is not null")
    own = fasta.join(hit.select("ord").distinct(), "ord", "left_anti")
    return {"sequences": own.select("id", "seq"), "ids": hit.select(F.col("uniprot_id").alias("id")).distinct(), "tokens": tokens}


def fetch_sequences(ids: DataFrame, seqs: DataFrame, pieces: DataFrame | None = None, user: DataFrame | None = None) -> DataFrame:
    """Residues per ID, cut per piece (``ACC:start:end``; missing start → 1, end → length); user records appended."""
    if pieces is None:
        out = seqs.join(ids.select("id").distinct(), "id", "left_semi").select("id", "seq")
    else:
        cut = ids.select("id").distinct().join(pieces.select("id", "start", "end"), "id", "left").join(seqs.select("id", "seq"), "id")
        start, end = F.coalesce("start", F.lit(1)), F.coalesce("end", F.length("seq"))
        whole = F.col("start").isNull() & F.col("end").isNull()
        out = cut.select(
            F.when(whole, F.col("id")).otherwise(S.domain_id("id", start, end)).alias("id"),
            F.when(whole, F.col("seq")).otherwise(S.subsequence("seq", start, end)).alias("seq"),
        )
    return out if user is None else out.unionByName(user.select("id", "seq"))


def extract_header_ids(fasta: DataFrame) -> DataFrame:
    """IDs of a known type that occur in headers."""
    tokens = fasta.select(F.explode(S.header_ids("header")).alias("id"))
    return tokens.where(S.id_type("id") != "unknown").distinct()


# ---- merging --------------------------------------------------------------------------------------
def merge_ids(family: DataFrame, user: DataFrame, uniref_map: DataFrame) -> DataFrame:
    """family ∪ (user − family − members that a seed already stands for)."""
    extra = user.select("id").distinct().join(family.select("id"), "id", "left_anti")
    extra = extra.join(uniref_map.select(F.col("member").alias("id")), "id", "left_anti")
    return family.select("id").distinct().unionByName(extra)


def source_labels(family: DataFrame, user: DataFrame, uniref_map: DataFrame, special: DataFrame | None = None, blast: bool = False) -> DataFrame:
    """``(id, source)`` of the merged set; ``special(id, source)`` overrides."""
    both, mine = (BLAST_BOTH, BLAST_HIT) if blast else (BOTH, USER)
    f = family.select("id", F.lit(1).alias("f"), F.lit(0).alias("u")).distinct()
    u = user.select("id").distinct()
    shown = u.join(uniref_map.select(F.col("member").alias("id"), "seed"), "id", "left")
    shown = shown.select(F.coalesce("seed", "id").alias("id"), F.lit(0).alias("f"), F.lit(1).alias("u"))
    merged = f.unionByName(shown).groupBy("id").agg(F.max("f").alias("f"), F.max("u").alias("u"))
    label = F.when((F.col("f") == 1) & (F.col("u") == 1), both).when(F.col("f") == 1, FAMILY).otherwise(mine)
    if special is None:
        return merged.select("id", label.alias("source"))
    s = special.select("id", F.col("source").alias("_special"))
    return merged.join(s, "id", "left").select("id", F.coalesce("_special", label).alias("source"))


def merge_metadata(
    family: DataFrame, user: DataFrame, uniref_map: DataFrame, user_rows: DataFrame | None = None,
    family_lists: DataFrame | None = None, special: DataFrame | None = None, blast: bool = False,
) -> DataFrame:
    """Metadata rows ``(id, field, value)`` of a family merged with user IDs.

    User IDs that are in the family, or belong to a family seed, are attached as ``User_IDs_in_Cluster``.
    ``family_lists(id, field, value)`` are UniRef member rows, whose sizes are added; ``user_rows`` carry the
    user's descriptions, query and other IDs, lengths.
    """
    labels = source_labels(family, user, uniref_map, special, blast)
    rows = labels.select("id", F.lit("Sequence_Source").alias("field"), F.col("source").alias("value"))
    u = user.select("id").distinct()
    via_seed = u.join(uniref_map.select(F.col("member").alias("id"), "seed"), "id").select(F.col("seed").alias("owner"), "id")
    own = u.join(family.select("id").distinct(), "id", "left_semi").join(uniref_map.select(F.col("member").alias("id")), "id", "left_anti")
    attached = via_seed.unionByName(own.select(F.col("id").alias("owner"), "id"))
    rows = rows.unionByName(attached.select(F.col("owner").alias("id"), F.lit("User_IDs_in_Cluster").alias("field"), F.col("id").alias("value")))
    if user_rows is not None:
        shown = user_rows.join(uniref_map.select(F.col("member").alias("id")), "id", "left_anti")
        rows = rows.unionByName(shown.select("id", "field", F.col("value").cast("string").alias("value")))
    if family_lists is not None:
        sizes = family_lists.groupBy("id", "field").agg(F.count(F.lit(1)).cast("string").alias("value"))
        sizes = sizes.withColumn("field", F.regexp_replace("field", "_IDs$", "_Cluster_Size"))
        rows = rows.unionByName(family_lists.select("id", "field", "value")).unionByName(sizes.select("id", "field", "value"))
    return rows


def sequence_set_stats(meta: DataFrame, user_matched: int = 0, user_unmatched: int = 0) -> DataFrame:
    """One row of counts over merged metadata rows."""
    is_src = F.col("field") == "Sequence_Source"
    label = lambda *v: F.count_if(is_src & F.col("value").isin(*v))
    overlap = F.count_if(is_src & ~F.col("value").isin(FAMILY, USER, INPUT))
    c = meta.agg(
        label(FAMILY).alias("fam"), label(USER, INPUT).alias("User"), overlap.alias("FamilyOverlap"),
        F.count_if(F.col("field") == "User_IDs_in_Cluster").alias("UniRefOverlap"),
    )
    return c.select(
        (F.col("fam") + F.col("FamilyOverlap") + F.col("User")).alias("Total"), (F.col("fam") + F.col("FamilyOverlap")).alias("Family"),
        "FamilyOverlap", "UniRefOverlap", "User",
        F.lit(user_matched).cast("long").alias("UserMatched"), F.lit(user_unmatched).cast("long").alias("UserUnmatched"),
    )


def merge_annotations_meta(annotation_rows: DataFrame, meta: DataFrame, annotations: DataFrame, version: str = "", min_len: int = 0, max_len: int = 0) -> DataFrame:
    """Annotation rows plus metadata rows; UniRef member lists are rebuilt from the members within the bounds."""
    if not version:
        return annotation_rows.unionByName(meta)
    list_field, size_field = f"UniRef{version}_IDs", f"UniRef{version}_Cluster_Size"
    members = meta.where(F.col("field") == list_field)
    lens = annotations.select(F.col("accession").alias("value"), F.col("Sequence_Length").alias("seq_len"))
    others = filter_sequences_by_length(members.where("id <> value").join(lens, "value"), min_len, max_len)
    seeds = members.select("id").distinct()
    listed = others.select("id", "field", "value").unionByName(seeds.select("id", F.lit(list_field).alias("field"), F.col("id").alias("value")))
    sizes = listed.groupBy("id").agg(F.count(F.lit(1)).cast("string").alias("value")).select("id", F.lit(size_field).alias("field"), "value")
    seed_len = seeds.join(lens.withColumnRenamed("value", "id"), "id").select("id", F.lit("Cluster_ID_Sequence_Length").alias("field"), F.col("seq_len").cast("string").alias("value"))
    rest = meta.where(~F.col("field").isin(list_field, size_field))
    return annotation_rows.unionByName(rest).unionByName(listed).unionByName(sizes).unionByName(seed_len)


def set_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(id, in_a, in_b)`` with the number of occurrences on each side."""
    rows = a.select("id", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select("id", F.lit(0).alias("a"), F.lit(1).alias("b")))
    return rows.groupBy("id").agg(F.sum("a").alias("in_a"), F.sum("b").alias("in_b"))
