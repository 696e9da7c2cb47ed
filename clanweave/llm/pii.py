"""Personal data: fixed patterns, and information-theoretic sanitisation of the terms around them.

Entities (e-mail and network addresses, card and phone numbers) are protected. Terms that stand within ``REACH`` words of an entity may reveal it.
The corpus tells how strongly: with n(t) occurrences of a term, n(t, e) of them beside entity e, the pointwise mutual
information log2 p(t, e) / (p(t) p(e)) reaches the information -log2 p(e) of the entity itself, less d bits, exactly if
n(t, e) / n(t) >= 2^-d. A term for which d is at most ``REMOVE_BITS`` is removed, at most ``GENERAL_BITS`` is generalised.
Copies of a context are no new evidence: a share that rests on c < ``SUPPORT`` different contexts is smoothed to c / (c n(t) / n(t, e) + ``PRIOR``).

Most entities stand in one document only. Terms are therefore judged in the same way against the class of all entities of a kind and
against the class of all entities (named by the kind, and ``any``): such a term discloses that an entity is there. A class is judged
from ``SUPPORT`` different pairs of context and entity on, and if a term stands beside two of its entities at least.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clanweave.llm.common import Memo, fresh, id_text, map_arrow, octets
from clanweave.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity, contexts from which on a share isn't smoothed, what smoothing adds, bits of the two thresholds.
REACH, SUPPORT, PRIOR, REMOVE_BITS, GENERAL_BITS = 8, 3, 2.0, 0.15, 1.0
#: Terms on either side of an entity that are near it, at most.
CLOSEST = 24
#: The class of all entities.
ANY = "any"
#: Bits of the broadcast filter of terms worth counting; it bounds the broadcast, not the terms.
FILTER_BITS = 1 << 22
# The base patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match can only begin where a number does
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = bytes(b for b in range(256) if not 48 <= b <= 57)
_TERM = re.compile(r"[^\W\d_]{3,}")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TERM_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(256))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, in order of start and kind."""
    at_sign, digits = b"@" in raw, raw.translate(None, _NOT_DIGITS)
    if not at_sign and not digits:
        return []
    text, out = raw.decode(), []
    if at_sign:
        after = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > after and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                after = m.end()
    if len(digits) >= 4:
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
    if len(digits) >= 9:
        for m in _CARD.finditer(text):
            own = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(own) <= 19 and luhn(own):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def contexts(raw: bytes, spans: list[tuple[int, int, int]], reach: int) -> list[tuple[str, str, int, int, int, int]]:
    """(entity, term, start, end, context, first) of the terms near each span; the context is a hash of all terms near it.

    Near are the terms within ``reach`` words on either side, in words without spaces the ``CLOSEST`` ones of a side. ``first`` has bit 1 where the text has
    this occurrence of the term beside this entity for the first time, bit 2 beside one of the kind, bit 4 beside any, so that no occurrence counts
    twice. Words, terms and spans are found once and looked up by bisection, so that a text of many entities costs their number.
    """
    text, out, seen = raw.decode(), [], set()
    starts, ends = zip(*(m.span() for m in _WORD.finditer(text)), strict=True)
    covered = []  # the union of the spans
    for a, _, b in spans:
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(b, covered[-1][1])
        else:
            covered.append([a, b])
    openings = [a for a, _ in covered]

    def is_open(m: re.Match) -> bool:
        k = bisect_left(openings, m.end())
        return k == 0 or covered[k - 1][1] <= m.start()

    terms = [m for m in _TERM.finditer(text) if is_open(m)]
    places = [m.start() for m in terms]
    for start, kind, end in spans:
        left, right = bisect_left(starts, start), bisect_right(ends, end)
        low = bisect_left(places, starts[max(0, left - reach)])
        high = bisect_left(places, ends[min(len(ends), right + reach) - 1])
        at = bisect_left(places, start)  # open terms lie before or behind the entity
        near = terms[max(low, at - CLOSEST) : min(high, at + CLOSEST)]
        words = [fold(m[0]) for m in near]
        own = xxhash.xxh64_intdigest(" ".join(words).encode()) >> 1
        entity = f"{KINDS[kind]}:{fold(text[start:end])}"
        for term, m in zip(words, near, strict=True):
            first = 0
            for bit, group in ((1, entity), (2, KINDS[kind]), (4, ANY)):
                first |= bit * ((group, m.start()) not in seen)
                seen.add((group, m.start()))
            out.append((entity, term, m.start(), m.end(), own, first))
    return out


def term_words(raw: bytes) -> list[bytes]:
    """All terms of a text, cut and folded as those near entities are; a byte table does it for ASCII."""
    if raw.isascii():
        return [w for w in raw.translate(_TERM_TABLE).split() if len(w) > 2]
    return [w.encode().lower() for w in _TERM.findall(raw.decode())]


def fold(term: str) -> str:
    """A-Z lower-cased, as the counting of terms does it."""
    return term.encode().lower().decode()


def find(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per row: doc_id, text_key (hash of the text), base (spans) and near (terms in reach of an entity)."""
    kind = "doc_id long, text_key long, base array<struct<start:long,kind:int,end:long>>, near array<struct<entity:string,term:string,start:long,end:long,context:long,first:int>>"
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    near_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("context", pa.int64()), ("first", pa.int32())]))

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            base, near, keys = [], [], []
            for raw in octets(batch):
                spans = base_spans(raw)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                near.append([dict(zip(("entity", "term", "start", "end", "context", "first"), x, strict=True)) for x in contexts(raw, spans, reach)] if spans else [])
                keys.append(xxhash.xxh64_intdigest(raw) >> 1)
            yield {"doc_id": batch.column("doc_id"), "text_key": keys, "base": pa.array(base, base_type), "near": pa.array(near, near_type)}

    return materialize(map_arrow(id_text(docs), kind, run), "private")


def groups_of(entity: str) -> Column:
    """What a term beside ``entity`` is judged against, in the order of the bits of ``first``: the entity, its kind, the class of all."""
    return F.array(F.col(entity), F.substring_index(entity, ":", 1), F.lit(ANY))


def disclosures(docs: DataFrame, found: DataFrame, support: int = SUPPORT, remove_bits: float = REMOVE_BITS, general_bits: float = GENERAL_BITS, prior: float = PRIOR) -> DataFrame:
    """(entity, term, short, removed): the terms that reveal an entity; ``short`` is what their mutual information lacks, in bits.

    ``entity`` is an entity, a kind or ``any``; the latter two only where the term stands beside more than one of their entities.
    """
    near = found.select(F.explode("near").alias("x")).select("x.*")
    near = near.select("entity", "term", "context", "first", F.posexplode(groups_of("entity")).alias("bit", "group"))
    near = near.where(F.expr("shiftright(first, bit) & 1 = 1"))
    per_context = near.groupBy("group", "bit", "term", "entity", "context").agg(F.count(F.lit(1)).alias("n"))
    per_entity = per_context.groupBy("group", "bit", "term", "entity").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("together"))
    pairs = per_entity.groupBy("group", "bit", "term").agg(F.sum("contexts").alias("contexts"), F.sum("together").alias("together"), F.count(F.lit(1)).alias("entities"))
    lacks = F.when(F.col("contexts") >= support, 0.0).otherwise(prior / F.col("contexts"))  # of 1 / share
    may = F.when(F.col("bit") == 0, F.log2(1 + lacks) <= general_bits).otherwise((F.col("contexts") >= support) & (F.col("entities") > 1))
    pairs = materialize(pairs.where(may).select(F.col("group").alias("entity"), "term", "together", lacks.alias("lacks")), "private-pairs")
    counts = term_counts(docs, pairs.select("term").distinct())
    short = F.log2(F.col("n") / F.col("together") + F.col("lacks"))
    return pairs.join(counts, "term").select("entity", "term", short.alias("short"), (short <= remove_bits).alias("removed")).where(F.col("short") <= general_bits)


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): occurrences over all whole texts of each of the ``terms``."""
    spot = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS)) + 1  # bitmaps count from 1
    parts = terms.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect()
    flags = np.zeros(FILTER_BITS, bool)  # from at most FILTER_BITS / 32768 rows
    for row in parts:
        bits = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
        flags[(row["part"] - 1) * 32768 : row["part"] * 32768] = bits
    worth = docs.sparkSession.sparkContext.broadcast(np.packbits(flags).tobytes())

    def run(batches) -> Iterator[dict]:
        flat = np.frombuffer(worth.value, np.uint8)
        mask = FILTER_BITS - 1

        def judge(words: list[bytes]) -> list[bool]:
            spots = [xxhash.xxh64_intdigest(w, seed=42) & mask for w in words]
            return [bool(flat[s >> 3] >> (7 - (s & 7)) & 1) for s in spots]

        memo, totals = Memo(400_000), {}
        for batch in batches:
            words = [w for raw in octets(batch) for w in term_words(raw)]
            known = memo.values(words, judge)
            for word in (w for w, k in zip(words, known, strict=True) if k):
                totals[word] = totals.get(word, 0) + 1
            if len(totals) > 200_000:
                yield {"term": pa.array(list(totals), pa.binary()), "n": list(totals.values())}
                totals = {}
        if totals:
            yield {"term": pa.array(list(totals), pa.binary()), "n": list(totals.values())}

    counted = map_arrow(id_text(docs), "term string, n long", run) if parts else docs.sparkSession.createDataFrame([], "term string, n long")
    return counted.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))


def spans_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Per row of ``found``: doc_id, text_key, base and terms (spans with kind 4: removed, 5: generalised)."""
    told = materialize(disclosures(docs, found), "private-terms")
    near = found.select("doc_id", "text_key", F.explode("near").alias("x")).select("doc_id", "text_key", "x.term", "x.start", "x.end", groups_of("x.entity").alias("groups"))
    near = near.select("doc_id", "text_key", "term", "start", "end", F.explode("groups").alias("entity"))
    hits = near.join(told, ["entity", "term"]).groupBy("doc_id", "text_key", "start", "end").agg(F.max("removed").alias("removed"))
    kind = F.when(F.col("removed"), 4).otherwise(5).alias("kind")
    terms = hits.select("doc_id", "text_key", F.struct("start", kind, "end").alias("t")).groupBy("doc_id", "text_key").agg(F.collect_list("t").alias("terms"))
    terms = terms.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "terms")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return found.join(terms, same, "left").select("doc_id", "text_key", "base", F.coalesce("terms", F.array().cast("array<struct<start:long,kind:int,end:long>>")).alias("terms"))


NAMES = (*KINDS, "removed", "general")


def sanitise(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with entities and revealing terms taken out of ``text``, and ``spans`` (underscores in front if taken).

    Entities become ``[email]``, ``[ip]``, ``[card]``, ``[phone]``; terms that reveal one are left out or become ``[term]``. A null text stays null and
    has no spans; rows that repeat a doc_id are told apart by their text; a null doc_id is an id like any other here. Spans that
    overlap are replaced together, as the kind of the first.
    """
    found = spans_of(docs, find(docs))
    name, key, other, own = fresh(docs, "spans"), fresh(docs, "_text_key"), fresh(docs, "_id"), fresh(docs, "_own_key")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def keyed(batches) -> Iterator[dict]:
        for batch in batches:
            yield {n: batch.column(k) for k, n in enumerate(batch.schema.names)} | {own: [xxhash.xxh64_intdigest(r) >> 1 for r in octets(batch)]}

    spans = F.sort_array(F.concat("base", "terms"))
    small = found.select(F.col("doc_id").alias(other), F.col("text_key").alias(key), spans.alias(name)).dropDuplicates([other, key])
    both = map_arrow(docs, f"{schema}, `{own}` long", keyed)
    both = both.join(small, F.col("doc_id").eqNullSafe(F.col(other)) & (F.col(own) == F.col(key))).drop(other, key, own)

    def rewrite(batches) -> Iterator[dict]:
        for batch in batches:
            columns = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            texts = []
            for raw, known, own_spans in zip(octets(batch), columns["text"].is_valid().to_pylist(), columns[name].to_pylist(), strict=True):
                text, out, at = raw.decode(), [], 0
                for s in own_spans:
                    if s["start"] >= at:
                        out += [text[at : s["start"]], ("[email]", "[ip]", "[card]", "[phone]", "", "[term]")[s["kind"]]]
                    at = max(at, s["end"])
                texts.append("".join([*out, text[at:]]) if known else None)
            yield columns | {"text": texts}

    return map_arrow(both, f"{schema}, `{name}` array<struct<start:long,kind:int,end:long>>", rewrite)


def _is(kind: int):
    return lambda x: x["kind"] == kind


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_terms."""
    found = spans_of(docs, find(docs))

    def shown(spans: str | Column) -> Column:
        def name(x: Column) -> Column:
            return F.element_at(F.array(*map(F.lit, NAMES)), x["kind"] + 1)

        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")

    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    every = found.withColumn("every", F.sort_array(F.concat("base", "terms")))
    return every.select("doc_id", *counts, F.sha2(shown("base"), 256).alias("base_sha256"), shown("every").alias("spans"), F.size("terms").cast("long").alias("n_terms"))
