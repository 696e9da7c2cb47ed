"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings. Columns only, no Python on rows.

A pattern's matches are set off with a mark that no text keeps, and the text is split at the marks; running sums of the parts' lengths
give the positions. The entropy of a candidate is that of its most mixed window of ``WINDOW`` characters. The sum over characters of
c log c is kept while the window slides: each step changes the counts of the character that leaves and of the one that enters. Limits depend on the
candidate's character class; what matches an allow pattern is not reported.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clanweave.llm.common import id_text

# The base kinds in their order, with the least length of the named group.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so that shorter ones need not be matched
)
#: Candidates, characters of a window, and the least bits per character of a window, by class. A limit lies where a random key of 20
#: characters of the smallest alphabet of its class still comes with 99 of 100 (digits 2.49, lower-case letters 3.24 bits).
CANDIDATE, WINDOW = r"[A-Za-z0-9+/_-]{20,}={0,2}", 20
CLASSES = (("digits", r"^[0-9]+$", 2.3), ("hexadecimal", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0), ("letters", r"^[A-Za-z+/_-]+={0,2}$", 3.2), ("mixed", r"", 3.5))
#: Pairs of letters that are common in words of English, German and French. Letters (joined by marks) are words if five uncommon pairs never
#: follow each other; pairs across marks don't count.
PAIRS = (
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si "
    "om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so rs un lo ge ie wh ee wi em ad ol rt po na ul ni ts mo ow pa im mi "
    "ai sh ir su id os am ci vi pl ig ev mp bl ab op ex ke fr oo av ag if ap gr od bo sp do uc ei qu ue au cu sc da cl du ph up"
)
_UNCOMMON = f"(?!{PAIRS.replace(' ', '|')})[a-z](?=[a-z])(?:[a-z][+/_-]+)?"
#: Candidates that match one of these are no secrets: repeated characters, words (joined by marks), UUIDs, placeholders.
ALLOW = (r"^(.)\1*$", rf"^(?i:(?!.*(?:{_UNCOMMON}){{5}})[a-z+/_-]+={{0,2}})$", r"^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$", r"(?i:example|placeholder|changeme|xxxx)")
#: Sums of c log2 c are held as whole numbers of this unit, so that they do not depend on the order of steps.
UNIT = 1 << 30
#: A non-character sets matches off (one that a text holds is read as the replacement character); lengths are summed by blocks.
MARK, STAND_IN, BLOCK, PIECE = "\ufdd0", "\ufffd", 128, 108


def parts_of(text: Column, pattern: str) -> Column:
    """Text before the first match, first match, text in between, second match, ..., text after the last match."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)


def _add(total: Column, x: Column) -> Column:
    return total + x


def with_matches(df: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Add ``name``: array of (start, end, found), in code points, end exclusive."""
    lit, p, b, s = F.lit, f"{name}_parts", f"{name}_blocks", f"{name}_sums"
    df = df.withColumn(p, parts_of(F.col(text), pattern))
    df = df.withColumn(p, F.when(F.size(p) > 1, F.col(p)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(b, F.transform(p, lambda x: F.length(x)))
    cut = F.transform(F.sequence(lit(0), F.floor((F.size(b) - 1) / BLOCK).cast("int")), lambda k: F.slice(b, k * BLOCK + 1, lit(BLOCK)))
    df = df.withColumn(b, F.when(F.size(b) > 0, cut).otherwise(F.array().cast("array<array<int>>")))
    df = df.withColumn(s, F.transform(b, lambda x: F.aggregate(x, lit(0), _add)))
    df = df.withColumn(s, F.transform(s, lambda x, k: F.aggregate(F.slice(s, lit(1), k), lit(0), _add)))
    inside = F.zip_with(b, s, lambda x, before: F.transform(x, lambda y, k: before + F.aggregate(F.slice(x, lit(1), k), lit(0), _add)))
    df = df.withColumn(s, F.flatten(inside))
    spans = F.zip_with(p, s, lambda x, at: F.struct(at.alias("start"), (at + F.length(x)).alias("end"), x.alias("found")))
    return df.withColumn(name, F.filter(spans, lambda x, k: k % 2 == 1)).drop(p, b, s)


def entropy_sum(found: Column) -> Column:
    """The least sum of c log2 c, in units, over all windows of ``WINDOW`` characters of ``found``.

    Characters are looked up by their place, which walks through a string; so ``found`` is cut into pieces of ``PIECE`` characters first, each
    followed by the beginning of the next, and the cost is that of its length.
    """
    pieces = F.regexp_extract_all(found, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    pieces = F.transform(pieces, lambda x, k: F.struct(x.alias("x"), k.alias("k")))
    least = F.get(F.transform(F.array(pieces), lambda p: F.transform(p, lambda y: F.concat(y["x"], F.coalesce(F.substring(F.get(p["x"], y["k"] + 1), 1, WINDOW - 1), F.lit(""))))), 0)
    # The last piece may be shorter than a window, all of which is in the piece before.
    least = F.filter(least, lambda x: F.length(x) >= WINDOW)
    return F.array_min(F.transform(least, _piece_sum))


def _piece_sum(found: Column) -> Column:
    table = F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0).cast("long") for c in range(WINDOW + 2)])
    weight = lambda c: F.element_at(table, c + 1)
    times = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    first = F.substring(found, 1, WINDOW)
    begun = F.aggregate(F.array_distinct(F.split(first, "")), F.lit(0).cast("long"), lambda t, c: t + weight(times(first, c)))
    steps = F.when(F.length(found) > WINDOW, F.sequence(F.lit(1), F.length(found) - WINDOW)).otherwise(F.array().cast("array<int>"))

    def slide(state: Column, i: Column) -> Column:
        stay = F.substring(found, i + 1, F.lit(WINDOW - 1))  # in both windows
        gone, come = F.substring(found, i, F.lit(1)), F.substring(found, i + WINDOW, F.lit(1))
        out, new = times(stay, gone), times(stay, come)
        now = state["now"] - weight(out + 1) + weight(out) - weight(new) + weight(new + 1)
        return F.struct(now.alias("now"), F.least(state["least"], now).alias("least"))

    return F.aggregate(steps, F.struct(begun.alias("now"), begun.alias("least")), slide, lambda s: s["least"])


def _base_spans(matches: str, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    def long_enough(x: Column) -> Column:
        return F.length(F.regexp_extract(x["found"], pattern, group)) >= least

    return F.transform(F.filter(matches, long_enough), lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def scan(docs: DataFrame, window_bits: dict[str, float] | None = None, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Secrets of every whole text.

    Returns per row doc_id, base and spans: arrays of (start, rank, kind, end) in order of start and kind, in code points, end exclusive. ``base``
    has the kinds assign, access and hex; ``spans`` also ``entropy``: candidates outside base spans whose most mixed window reaches the
    limit of their class. A null text is empty; repeated rows and null doc_ids are kept; columns other than doc_id and text are not read.
    """
    limits = {n: bits for n, _, bits in CLASSES} | (window_bits or {})
    df = id_text(docs).withColumn("text", F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(STAND_IN)))
    kinds = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        df = with_matches(df, "text", f"m_{kind}", pattern)
        kinds.append(_base_spans(f"m_{kind}", rank, kind, pattern, group, least))
    df = with_matches(df, "text", "m_candidate", CANDIDATE).drop("text")
    df = df.withColumn("base", F.sort_array(F.concat(*kinds))).drop(*[f"m_{k}" for k, *_ in BASE])

    # Base spans by blocks: only blocks that begin before a candidate and reach its end are looked through.
    numbers = F.when(F.size("base") > 0, F.sequence(F.lit(0), F.floor((F.size("base") - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("blocks", F.transform(numbers, lambda k: F.slice("base", k * BLOCK + 1, F.lit(BLOCK))))
    reach = F.transform("blocks", lambda x: F.struct(F.get(x["start"], 0).alias("start"), F.array_max(x["end"]).alias("end"), x.alias("spans")))
    df = df.withColumn("blocks", reach)

    def is_open(x: Column) -> Column:
        covers = lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"])
        inside = F.exists("blocks", lambda b: F.when(covers(b), F.exists(b["spans"], covers)).otherwise(False))
        allowed = F.lit(False)
        for pattern in allow:
            allowed = allowed | x["found"].rlike(pattern)
        return ~inside & ~allowed

    def mixed(x: Column) -> Column:
        bits = F.lit(float(limits[CLASSES[-1][0]]))
        for name, pattern, _ in reversed(CLASSES[:-1]):
            bits = F.when(x["found"].rlike(pattern), float(limits[name])).otherwise(bits)
        most = F.lit(math.log2(WINDOW)) - entropy_sum(x["found"]) / (WINDOW * UNIT)
        return most >= bits

    df = df.withColumn("m_candidate", F.filter("m_candidate", is_open))
    df = df.withColumn("m_candidate", F.filter("m_candidate", mixed))
    extra = F.transform("m_candidate", lambda x: F.struct(x["start"].alias("start"), F.lit(len(BASE)).alias("rank"), F.lit("entropy").alias("kind"), x["end"].alias("end")))
    return df.select("doc_id", "base", F.sort_array(F.concat("base", extra)).alias("spans"))


def _is(kind: str):
    return lambda x: x["kind"] == kind


def shown(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    counts = [F.size(F.filter("base", _is(kind))).cast("long").alias(f"n_{kind}") for kind, *_ in BASE]
    return scan(docs).select("doc_id", *counts, F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"))
