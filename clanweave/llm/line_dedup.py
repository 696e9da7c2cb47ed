"""Line deduplication with two Bloom filters.

The hashes of line keys are dealt into slices. Each slice streams its hashes through a filter of those seen once; a hash
that the filter already knows enters the filter of those seen twice. Only lines whose hash is in the second filter leave their
document: their exact keys are counted, and all but the last document that holds a frequent key lose it.

The first filter never leaves its slice. The second is broadcast; its size has a fixed bound (``MOST_BITS``), beyond which
more lines are suspected in vain but the result stays the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clanweave.llm.common import fresh, id_text, map_arrow, mix, octets
from clanweave.session import materialize

#: White space that is stripped, probes of a filter, bits per key, bits of one slice at most, bits broadcast at most.
BLANK, PROBES, BITS_PER_KEY, SLICE_BITS, MOST_BITS = b" \t\n\x0b\x0c\r", 4, 16, 1 << 24, 1 << 30
#: Hashes a task gathers before it hands them on; each leaves at most two copies.
GATHER = 1 << 20


def line_keys(lines: list[bytes], min_chars: int) -> list[bytes | None]:
    """The key of each line, or None where it is shorter than ``min_chars`` code points."""
    out = []
    for line in lines:
        key = None
        if len(line) >= min_chars:
            key = line.strip(BLANK).lower()
            if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
                key = None
        out.append(key)
    return out


def _keyed(batch: pa.RecordBatch, min_chars: int) -> Iterator[tuple[int, list[bytes]]]:
    """(doc_id, distinct keys) of the rows that have an id and a key."""
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), octets(batch), strict=True):
        if doc_id is not None:
            keys = {k for k in line_keys(text.split(b"\n"), min_chars) if k is not None}
            if keys:
                yield doc_id, list(keys)


class Bloom:
    """A filter over 2^k bits, one byte per bit while it is built."""

    def __init__(self, bits: int):
        self.mask, self.set = np.uint64(bits - 1), np.zeros(bits, bool)

    @staticmethod
    def spots(hashes: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
        a, b = mix(hashes, 1), mix(hashes, 2) | np.uint64(1)
        with np.errstate(over="ignore"):
            return [((a + np.uint64(k) * b) & mask).astype(np.int64) for k in range(PROBES)]

    def add(self, hashes: np.ndarray) -> None:
        for at in self.spots(hashes, self.mask):
            self.set[at] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([self.set[at] for at in self.spots(hashes, self.mask)])


class TwiceSeen:
    """The broadcast filter: the slices' filters of hashes seen twice, packed."""

    def __init__(self, slices: int, bits: int, packed: bytes):
        self.slices, self.bits, self.packed = slices, bits, packed

    def has(self, hashes: np.ndarray) -> np.ndarray:
        flat = np.frombuffer(self.packed, np.uint8)
        start = slice_of(hashes, self.slices) * self.bits
        ok = np.ones(len(hashes), bool)
        for at in Bloom.spots(hashes, np.uint64(self.bits - 1)):
            at = at + start
            ok &= flat[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 > 0
        return ok


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return (mix(hashes, 7) % np.uint64(slices)).astype(np.int64)


def _power(n: float) -> int:
    return 1 << max(6, int(np.ceil(np.log2(max(n, 1)))))


def twice_seen(docs: DataFrame, min_chars: int) -> TwiceSeen:
    """Stream the key hashes of all documents through the two filters."""
    def gather(batches) -> Iterator[dict]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            for _, keys in _keyed(batch, min_chars):
                held.append(np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys)))
                n += len(keys)
            if n >= GATHER:
                yield _thinned(held)
                held, n = [], 0
        if held:
            yield _thinned(held)

    hashes = materialize(map_arrow(id_text(docs), "part int, n long, hashes binary", gather), "line-hashes")
    n = hashes.agg(F.sum("n")).first()[0] or 0
    slices = max(256, -(-n * BITS_PER_KEY // SLICE_BITS))
    once_bits = min(SLICE_BITS, _power(n * BITS_PER_KEY / slices))
    twice_bits = max(64, min(once_bits // 2, _power(MOST_BITS / slices) // 2))

    def deal(batches) -> Iterator[dict]:
        for batch in batches:
            for raw in batch.column("hashes").to_pylist():
                h = np.frombuffer(raw, np.uint64)
                own = slice_of(h, slices)
                order = np.argsort(own, kind="stable")
                ends = np.searchsorted(own[order], np.arange(slices + 1))
                parts = [(s, h[order[a:b]].tobytes()) for s, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
                yield {"slice": [s for s, _ in parts], "hashes": [x for _, x in parts]}

    def filters(batches) -> Iterator[dict]:
        own, once, twice = -1, None, None
        for batch in batches:
            for s, raw in zip(batch.column("slice").to_pylist(), batch.column("hashes").to_pylist(), strict=True):
                if s != own:
                    if twice is not None:
                        yield {"slice": [own], "bits": [np.packbits(twice.set).tobytes()]}
                    own, once, twice = s, Bloom(once_bits), Bloom(twice_bits)
                h, times = np.unique(np.frombuffer(raw, np.uint64), return_counts=True)
                twice.add(h[(times > 1) | once.has(h)])
                once.add(h)
        if twice is not None:
            yield {"slice": [own], "bits": [np.packbits(twice.set).tobytes()]}

    dealt = map_arrow(hashes.select("hashes"), "slice long, hashes binary", deal).repartition(F.col("slice")).sortWithinPartitions("slice")
    found = {r["slice"]: r["bits"] for r in map_arrow(dealt, "slice long, bits binary", filters).collect()}  # bounded by MOST_BITS
    empty = bytes(twice_bits // 8)
    return TwiceSeen(slices, twice_bits, b"".join(found.get(s, empty) for s in range(slices)))


def _thinned(held: list[np.ndarray]) -> dict:
    h, times = np.unique(np.concatenate(held), return_counts=True)
    h = np.concatenate([h, h[times > 1]])
    return {"part": [0], "n": [len(h)], "hashes": [h.tobytes()]}


def lost_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The keys each document loses: (doc_id, hashes), only documents that lose one. Rows without an id take no part."""
    seen = docs.sparkSession.sparkContext.broadcast(twice_seen(docs, min_chars))

    def suspects(batches) -> Iterator[dict]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, own in _keyed(batch, min_chars):
                ids += [doc_id] * len(own)
                keys += own
            h = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
            at = np.flatnonzero(seen.value.has(h)).tolist()
            yield {"doc_id": [ids[k] for k in at], "key": [keys[k] for k in at], "hash": h[at].view(np.int64)}

    found = materialize(map_arrow(id_text(docs), "doc_id long, key binary, hash long", suspects), "line-suspects")
    held = found.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("stays"))
    frequent = materialize(held.where(F.col("n") >= min_docs).select("key", "stays"), "line-frequent")
    lost = found.join(frequent, "key").where("doc_id <> stays")
    return lost.groupBy("doc_id").agg(F.collect_set("hash").alias("hashes"))


def without_lines(docs: DataFrame, lost: DataFrame, min_chars: int = 40) -> DataFrame:
    """``docs`` with the lost lines taken out of ``text``, and the columns n_lines and n_dropped in front (see ``fresh``)."""
    note, key = fresh(docs, "_lost"), fresh(docs, "_id")
    n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    small = lost.select(F.col("doc_id").alias(key), F.col("hashes").alias(note)).hint("shuffle_hash")
    both = docs.join(small, F.col("doc_id") == F.col(key), "left").drop(key)
    schema = f"`{n_lines}` long, `{n_dropped}` long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            out = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names if n != note}
            texts, total, dropped = [], [], []
            for text, gone, known in zip(octets(batch), batch.column(note).to_pylist(), out["text"].is_valid().to_pylist(), strict=True):
                lines = text.split(b"\n")
                total.append(len(lines))
                kept = lines
                if gone:
                    gone = set(gone)
                    keys = line_keys(lines, min_chars)
                    h = np.array([xxhash.xxh64_intdigest(k) if k is not None else 0 for k in keys], np.uint64).view(np.int64).tolist()
                    kept = [x for x, k, v in zip(lines, keys, h, strict=True) if k is None or v not in gone]
                dropped.append(len(lines) - len(kept))
                texts.append((b"\n".join(kept) if gone else text) if known else None)
            yield out | {n_lines: total, n_dropped: dropped, "text": pa.array(texts, pa.binary())}

    return map_arrow(both, schema, run)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Take lines that many documents share out of all documents but one.

    A line's key is the line without white space at both ends, A-Z lower-cased. A key of at least ``min_chars`` code points that is
    held by at least ``min_docs`` different doc_ids loses its lines in all documents except the one with the largest doc_id.
    Returns the columns of ``docs`` with the new text, and n_lines, n_dropped. Null texts stay null and count as one empty line;
    rows without a doc_id keep all lines and are not counted; rows that repeat a doc_id count as one document. A column of ``docs``
    named like an added one keeps its name, the added one gets an underscore in front.
    """
    return without_lines(docs, lost_lines(docs, min_chars, min_docs), min_chars)


def digests(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept lines."""
    kept = dedup_lines(id_text(docs), min_chars, min_docs)

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            yield {n: batch.column(n) for n in ("doc_id", "n_lines", "n_dropped")} | {"kept_sha256": [hashlib.sha256(t).hexdigest() for t in octets(batch)]}

    return map_arrow(kept, "doc_id long, n_lines long, n_dropped long, kept_sha256 string", run)
