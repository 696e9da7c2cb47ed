"""Column → Column functions (no Python UDFs, so they stay inside generated code)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ordered patterns that decide the type of a foreign identifier.
ID_TYPE_PATTERNS = (
    (r"^\d+$", "gi"),
    (r"^[A-Za-z]{3}\d{5}(\.\d+)?$", "embl-cds"),
    (r"^[A-Za-z]{2}_\d+(\.\d+)?$", "refseq"),
    (r"^[A-Za-z]\d[A-Za-z0-9]{3,8}(\.\d+)?$", "uniprot"),
    (r"^[A-Za-z0-9]{4}$", "pdb"),
)
DOMAIN_SUFFIX = r":\d+:\d+$"
MARKER_PATTERN = r"^(.*)_([TJQ]M)(\d*)_#(\d*)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def alignment_score(src_len, dst_len, bitscore) -> Column:
    """``-log10(|q|·|s|) + bits·log10 2``, truncated toward zero; the product is taken as double."""
    area = _c(src_len).cast("double") * _c(dst_len).cast("double")
    return (-F.log10(area) + _c(bitscore) * F.log10(F.lit(2.0))).cast("int")


def id_type(c) -> Column:
    out = None
    for pattern, label in ID_TYPE_PATTERNS:
        test = _c(c).rlike(pattern)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise("unknown")


def sanitize_id(c) -> Column:
    return F.regexp_replace(_c(c), r"[^A-Za-z0-9]", "_")


def strip_domain(c) -> Column:
    return F.regexp_replace(_c(c), DOMAIN_SUFFIX, "")


def parse_domain(c) -> Column:
    """``struct(acc, start, end)``; start and end are NULL for a whole-protein node."""
    c = _c(c)
    part = lambda g: F.when(c.rlike(DOMAIN_SUFFIX), F.regexp_extract(c, r":(\d+):(\d+)$", g).cast("int"))
    return F.struct(strip_domain(c).alias("acc"), part(1).alias("start"), part(2).alias("end"))


def domain_id(acc, start, end) -> Column:
    return F.concat_ws(":", _c(acc), _c(start).cast("string"), _c(end).cast("string"))


def strip_isoform(c) -> Column:
    return F.regexp_replace(_c(c), r"-\d+$", "")


def strip_version(c) -> Column:
    return F.regexp_replace(_c(c), r"\.\d+$", "")


def header_ids(header) -> Column:
    """First words between ``>`` / ``|`` separators, at least 5 characters long."""
    words = F.transform(F.split(_c(header), r"[>|]"), lambda t: F.regexp_extract(t, r"^\s*(\S*)", 1))
    return F.filter(words, lambda t: F.length(t) >= 5)


def status_label(c) -> Column:
    return F.when(F.lower(_c(c)) == "reviewed", "SwissProt").otherwise("TrEMBL")


def fragment_label(c) -> Column:
    return F.when(_c(c).cast("int") == 1, "fragment").otherwise("complete")


def is_fragment(de) -> Column:
    return _c(de).rlike(r"Flags:.*Fragment")


# The names that head a description block, and the words that end a name in it.
NAME_KEYS, PART_KEYS = ("RecName", "SubName"), ("RecName:", "SubName:", "AltName:", "Short:", "Flags:")


def clean_description(de) -> Column:
    """Readable name out of a ``RecName: Full=…`` / ``SubName: Full=…`` description block.

    The block is read as parts, each from one key to the next; the name is the first part's value without evidence in braces.
    A text that is no such block is its own name.
    """
    text = F.replace(F.regexp_replace(F.translate(_c(de), "<>", ""), r"\s+", " "), F.lit("&"), F.lit("and"))
    key = rf"^\s*(?:{'|'.join(NAME_KEYS)}):\s*Full="
    parts = F.split(F.regexp_replace(text, key, ""), "|".join(PART_KEYS))
    name = F.replace(F.regexp_replace(parts[0], r"\{.*\}|\{[^{}]*$", ""), F.lit("="), F.lit(""))
    return F.trim(F.when(text.rlike(key), name).otherwise(F.regexp_replace(text, r"\{[^}]*\}", "")))


def clean_organism(os) -> Column:
    os = _c(os)
    strain = F.regexp_extract(os, r"(\(strain.*?\))", 1)
    base = F.regexp_extract(os, r"^(.*?)\(", 1)
    return F.when(~os.contains("("), os).when(strain != "", F.concat(base, F.lit(" "), strain)).otherwise(base)


def trunc2_ratio(num, den) -> Column:
    """Two-decimal truncation of a ratio of counts, by integer arithmetic (29/100 is 0.29)."""
    num, den = _c(num).cast("long"), _c(den).cast("long")
    return F.when(den == 0, None).otherwise(F.floor((num * 100 - F.pmod(num * 100, den)) / den) / 100.0)


def trunc2(x) -> Column:
    """Two-decimal truncation toward zero; the tiny nudge undoes binary representation error."""
    x = _c(x).cast("double")
    return (F.signum(x) * F.floor(F.abs(x) * 100 + F.lit(1e-9))) / 100.0


def subsequence(seq, start, end) -> Column:
    """1-based, both ends included."""
    return F.substr(_c(seq), _c(start).cast("int"), (_c(end) - _c(start) + 1).cast("int"))


def subsequence_guarded(seq, start, end) -> Column:
    seq, start, end = _c(seq), _c(start), _c(end)
    n = F.length(seq)
    ok = (start >= 0) & (start < n) & (end >= 0) & (end <= n)
    return F.when(ok, subsequence(seq, F.greatest(start, F.lit(1)), end)).otherwise(seq)


def gene_length_aa(start, stop) -> Column:
    return (F.abs(_c(stop) - _c(start)) / 3 - 1).cast("int")


def marker_parse(header) -> Column:
    """``struct(family, type, quasi, ordinal, weights)`` of a marker header."""
    h = _c(header)
    g = lambda i: F.regexp_extract(h, MARKER_PATTERN, i)
    listed = F.regexp_extract(h, r"__\[(.*)\]", 1)
    weights = F.transform(
        F.filter(F.split(listed, ","), lambda t: t.contains("_w=")),
        lambda t: F.struct(
            F.regexp_extract(t, r"^(.*)_w=", 1).alias("family"),
            F.regexp_extract(t, r"_w=(.*)$", 1).cast("double").alias("w"),
        ),
    )
    num = lambda c: F.when(c != "", c.cast("int"))
    return F.struct(
        g(1).alias("family"), g(2).alias("type"), num(g(3)).alias("quasi"), num(g(4)).alias("ordinal"), weights.alias("weights")
    )


def clean_accession(c) -> Column:
    """``xx|ACC|…`` → ``ACC``; anything else is kept."""
    c = _c(c)
    return F.when(c.rlike(r"^[^|]*\|[^|]+"), F.regexp_extract(c, r"^[^|]*\|([^|]+)", 1)).otherwise(c)
