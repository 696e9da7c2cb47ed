"""Document fingerprints: SimHash with permuted block tables. Columns only, no Python on rows.

The terms of a text are its distinct shingles of ``WIDTH`` words. A text of fewer than ``FEW`` words, or of words that are longer than ``LONG`` code points
on average (scripts without spaces, encoded data), has shingles of ``LETTERS`` code points instead. A term's 64-bit hash votes on each bit, for one
where the bit is set and against it otherwise, with the term's weight: its length in code points (at most ``HEAVIEST``), as longer terms are
rarer. A bit of the fingerprint is one where the votes for it outweigh those against. The votes of two bits are summed in the
halves of one long, so that 64 sums are 32 columns of an aggregation that is combined before the shuffle.

Two fingerprints within r bits agree in all but r of any b blocks of bits. There is one table for every choice of b - r blocks, in which these blocks
stand first; fingerprints that agree on them meet in an equi-join, and the others' bits decide. b grows with the number of
fingerprints until the leading blocks tell most of them apart, so that a bucket stays small at every size.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clanweave.functions.ordered import ordered_scan
from clanweave.llm.common import id_text
from clanweave.session import materialize

WIDTH, LETTERS, FEW, LONG, HEAVIEST = 3, 5, 12, 24, 63
#: Bits of the leading blocks beyond those that tell all fingerprints apart.
SPARE = 4
_HALVES = (1 << 32) | 1


def terms(text: Column) -> Column:
    """Array of the distinct terms of a text, as longs: a hash whose last six bits are the weight; no word: an empty array."""

    def bound(value: Column, use) -> Column:  # evaluates ``value`` once
        return F.get(F.transform(F.array(value), use), 0)

    def shingles(units: Column, width: int) -> Column:
        def term(i: Column) -> Column:
            parts = [F.get(units, i + k) for k in range(width)]  # beyond the last unit: null, which neither hashes nor weighs
            size = sum((F.coalesce(F.length(p), F.lit(0)) for p in parts[1:]), F.length(parts[0]))
            return F.xxhash64(*parts).bitwiseAND(F.lit(-1 - HEAVIEST)).bitwiseOR(F.least(size, F.lit(HEAVIEST)).cast("long"))

        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(units) - width, F.lit(0))), term))

    def of_words(w: Column) -> Column:
        unspaced = (F.size(w) < FEW) | (F.length(text) > LONG * F.size(w))
        letters = bound(F.split(F.array_join(w, " "), ""), lambda c: shingles(c, LETTERS))
        return F.when(F.size(w) > 0, F.when(unspaced, letters).otherwise(shingles(w, WIDTH)))

    return bound(F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), ""), of_words)


def with_votes(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys`` and the fingerprint (a long) of the text of each; rows of equal keys must have equal texts. No word: 0."""
    voters = rows.select(*keys, F.explode_outer(terms(F.col(text))).alias("t"))
    # Hashed again, as the term's last bits are its weight.
    voters = voters.select(*keys, F.xxhash64("t").alias("h"), F.coalesce(F.col("t").bitwiseAND(F.lit(HEAVIEST)), F.lit(0)).alias("w"))
    pair = lambda k: (F.shiftright("h", k).bitwiseAND(F.lit(_HALVES)) * F.col("w"))
    summed = voters.groupBy(*keys).agg(F.sum("w").alias("all"), *[F.sum(pair(k)).alias(f"v{k}") for k in range(32)])
    low, high = (1 << 32) - 1, 32
    value = F.lit(0).cast("long")
    for k in range(32):
        for half, bit in ((F.col(f"v{k}").bitwiseAND(F.lit(low)), k), (F.shiftrightunsigned(f"v{k}", high), k + 32)):
            mask = 1 << bit if bit < 63 else -(1 << 63)
            value = value.bitwiseOR(F.when(half * 2 > F.col("all"), F.lit(mask)).otherwise(F.lit(0)).cast("long"))
    return summed.select(*keys, value.alias("fingerprint"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (hash of the text) and fingerprint of the distinct rows (doc_id, text). A null text is empty."""
    keyed = _keyed(docs)
    named = F.when(F.col("text_key").bitwiseAND(F.lit(1)) == 0, F.col("id"))
    return with_votes(keyed, "text", ["id", "text_key"]).select(named.alias("doc_id"), "text_key", "fingerprint")


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts without nulls, named by (id, text_key); the lowest bit of the key tells whether the id is missing."""
    text = F.coalesce("text", F.lit(""))
    key = F.shiftleft(F.xxhash64(text), 1).bitwiseOR(F.col("doc_id").isNull().cast("long"))
    return id_text(docs).select(F.coalesce("doc_id", F.lit(0)).alias("id"), key.alias("text_key"), text.alias("text"))


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def likeness(a: str, b: str) -> Column:
    """The cosine that the differing bits stand for (each differs with the probability angle / pi), 0 where it would be negative."""
    return F.greatest(F.lit(0.0), F.round(F.cos(differing(a, b) * F.lit(math.pi / 64)), 12))


def edits(docs: DataFrame) -> DataFrame:
    """Every distinct row (doc_id, text) beside the next document, and with its last third replaced by the beginning of that one.

    The order is by descending doc_id (null last), rows of one id by the hash of their text; after the last comes the first. Returns id, text_key,
    next_id, next_key, times (number of such rows), n_chars, text, edited. Texts are shuffled once; the neighbours are found on keys alone.
    """
    keyed = _keyed(docs)
    named = keyed.groupBy("id", "text_key").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("text")).cast("long").alias("n_chars"))
    missing = F.col("text_key").bitwiseAND(F.lit(1))
    order = [missing.asc(), F.desc("id"), F.asc("text_key")]
    named = materialize(named, "named")
    first = named.orderBy(*order).select("id", "text_key").first()
    if first is None:
        first = (0, 0)
    following = ordered_scan(named, [], order, leads={"next": F.struct("id", "text_key")})
    after = F.coalesce("next", F.struct(F.lit(first[0]).cast("long").alias("id"), F.lit(first[1]).cast("long").alias("text_key")))
    # Of n equal rows all but the last are followed by their like.
    like = F.struct(F.struct("id", "text_key").alias("next"), (F.col("n") - 1).alias("times"))
    last = F.struct(after.alias("next"), F.lit(1).cast("long").alias("times"))
    both = F.filter(F.array(like, last), lambda x: x["times"] > 0)
    pairs = following.select("id", "text_key", "n_chars", F.explode(both).alias("f"))
    pairs = materialize(pairs.select("id", "text_key", "n_chars", F.col("f.next.id").alias("next_id"), F.col("f.next.text_key").alias("next_key"), "f.times"), "pairs")
    texts = keyed.groupBy("id", "text_key").agg(F.first("text").alias("text"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    other = texts.select(F.col("id").alias("next_id"), F.col("text_key").alias("next_key"), F.col("text").alias("other"))
    begun = pairs.join(other, ["next_id", "next_key"]).withColumn("other", F.substring("other", F.lit(1), third))
    joined = begun.join(texts, ["id", "text_key"])
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")), F.col("other"))
    return joined.withColumn("edited", edited).drop("other")


def block_tables(distinct: int, bits: int = 64, radius: int = 3) -> list[int]:
    """Masks of the leading blocks of each table. Of a number of distinct fingerprints fewer than one in 2^SPARE meets another by chance in a table."""
    for blocks in range(radius + 1, 2 * radius + 6):
        edges = [round(k * bits / blocks) for k in range(blocks + 1)]
        if edges[blocks - radius] >= math.log2(max(2, distinct)) + SPARE:
            break
    own = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(kept) for kept in combinations(own, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def search(queries: DataFrame, prints: DataFrame, radius: int = 3, tables: list[int] | None = None) -> DataFrame:
    """(query, found) of all fingerprints of ``prints`` within ``radius`` bits of those of ``queries``; each a column ``fingerprint``.

    Distinct fingerprints only; a query meets itself if it is in ``prints``. A pair is reported by the first table in which it meets.
    """
    wanted, held = queries.select("fingerprint").distinct(), prints.select("fingerprint").distinct()
    masks = [_signed(m) for m in (tables or block_tables(held.count(), radius=radius))]

    def dealt(df: DataFrame, name: str) -> DataFrame:
        entry = [F.struct(F.lit(k).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("lead")) for k, m in enumerate(masks)]
        return df.select(F.col("fingerprint").alias(name), F.explode(F.array(*entry)).alias("e")).select(name, "e.*")

    met = dealt(wanted, "query").join(dealt(held, "found"), ["table", "lead"]).where(differing("query", "found") <= radius)
    apart = F.col("query").bitwiseXOR(F.col("found"))
    first = F.array_position(F.array(*[apart.bitwiseAND(F.lit(m)) == 0 for m in masks]), True) - 1
    return met.where(first == F.col("table")).select("query", "found")


def shown(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def fingerprint_documents(docs: DataFrame, radius: int = 3, every: int = 20) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint (hexadecimal), near_edited, near_next, n_near, near_id.

    ``edits`` tells what the next document and the edited text are. ``near_edited`` and ``near_next`` are the likeness of the fingerprint to that of the
    edited text and of the next document. Documents whose id is divisible by ``every`` are searched for among all: ``n_near`` other rows
    lie within ``radius`` bits, ``near_id`` is the least id within it (its own included); both are null for others. A null text
    is empty; a text without words has fingerprint 0 and likeness 1 to its like; null and repeated doc_ids are kept, row for row. An only
    document is followed by itself. Columns other than doc_id and text are not read. A text may have up to 2^26 words.
    """
    keys = ["id", "text_key", "next_id", "next_key", "times", "n_chars"]
    sha = [f"sha{k}" for k in range(4)]
    both = edits(docs)
    # The digest travels as four longs: keys of fixed width stay in the fast hash map.
    both = both.withColumn("sha", F.sha2("edited", 256)).withColumns({s: F.conv(F.substring("sha", 16 * k + 1, 16), 16, -10).cast("long") for k, s in enumerate(sha)})
    each = F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("t")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("t"))))
    voted = with_votes(both.select(*keys, *sha, each.alias("e")).select(*keys, *sha, "e.*"), "t", [*keys, *sha, "is_edited"])
    pick = lambda edited: F.max(F.when(F.col("is_edited") == edited, F.col("fingerprint")))
    prints = materialize(voted.groupBy(*keys, *sha).agg(pick(False).alias("fingerprint"), pick(True).alias("edited")), "prints")
    following = prints.groupBy(F.col("id").alias("next_id"), F.col("text_key").alias("next_key")).agg(F.first("fingerprint").alias("following"))
    out = prints.join(following, ["next_id", "next_key"])
    named = F.col("text_key").bitwiseAND(F.lit(1)) == 0
    counted = prints.groupBy("fingerprint").agg(F.sum("times").alias("n"), F.min(F.when(named, F.col("id"))).alias("least"))
    queries = prints.where(named & (F.col("id") % every == 0))
    found = search(queries, counted, radius).join(counted.withColumnRenamed("fingerprint", "found"), "found")
    found = found.groupBy(F.col("query").alias("fingerprint")).agg(F.sum("n").alias("held"), F.min("least").alias("near_id"))
    out = out.join(found, "fingerprint", "left")
    asked = named & (F.col("id") % every == 0)
    digest = F.concat(*[F.lpad(F.lower(F.hex(s)), 16, "0") for s in sha])
    return out.select(
        F.when(named, F.col("id")).alias("doc_id"), "n_chars", digest.alias("edited_sha256"), shown("fingerprint").alias("fingerprint"), shown("edited").alias("edited_fingerprint"),
        likeness("fingerprint", "edited").alias("near_edited"), likeness("fingerprint", "following").alias("near_next"),
        F.when(asked, F.col("held") - 1).alias("n_near"), F.when(asked, F.col("near_id")).alias("near_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_copy"),
    ).drop("_copy")
