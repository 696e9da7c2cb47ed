"""Substring deduplication by Rabin-Karp hashes of every fixed-length token window.

Every window of ``width`` tokens gets a polynomial hash. A task gathers the windows of many documents; where one hash lies in several
of them, all but the document with the smallest id know at once that they repeat it, and one entry goes on. Buckets of hashes
are then compared in Spark: an entry whose hash has a smaller doc_id repeats. Repeated windows go back to
their documents and merge into maximal intervals of tokens, which are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clanweave.llm.common import fresh, id_text, map_arrow, mix, octets
from clanweave.session import materialize

#: Odd base of the polynomial; windows a task gathers; bytes of text for one bucket and for one group of documents; bytes of a hash that are kept.
BASE, GATHER, BUCKET_TEXT, GROUP_TEXT, KEY = np.uint64(0x5851F42D4C957F2D), 1 << 20, 12 << 20, 64 << 20, 7
#: Known repeats a bucket holds before it sends them back.
FLUSH = 1 << 22


def window_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Rabin-Karp hashes modulo 2^64 of all windows, mixed, with the highest byte cleared (the bucket stands for it)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    token = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, np.uint64)
        for k in range(width):
            rolled = rolled * BASE + token[k : k + n]
    return mix(rolled, 3)


def _short(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY].tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // KEY, 8), np.uint8)
    out[:, :KEY] = np.frombuffer(raw, np.uint8).reshape(-1, KEY)
    return out.view("<u8").ravel()


_LOW = np.uint64((1 << 8 * KEY) - 1)


def _runs(docs: np.ndarray, hashes: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Entries in runs of one document: ids, lengths, hashes."""
    first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
    return docs[first].astype("<i8").tobytes(), np.diff(np.r_[first, len(docs)]).astype("<u4").tobytes(), _short(hashes)


def repeats(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which entries have the same hash in an entry with a smaller document id."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    least = np.minimum.reduceat(docs[order], first)
    out = np.zeros(len(docs), bool)
    out[order] = docs[order] > np.repeat(least, np.diff(np.r_[first, len(h)]))
    return out


def repeated_windows(docs: DataFrame, width: int = 13) -> DataFrame:
    """(doc_id, hashes): the window hashes of each document that also start in one with a smaller doc_id, one row per document.

    What a bucket finds goes back packed by groups of documents, so that no row is made per document and bucket.
    """
    spark = docs.sparkSession
    texts = id_text(docs).where("doc_id is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    at_once = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, groups = max(at_once, -(-size // BUCKET_TEXT)), max(at_once, -(-size // GROUP_TEXT))

    def gather(batches) -> Iterator[dict]:
        ids, held, n = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), octets(batch), strict=True):
                h = np.unique(window_hashes(text.split(), width))
                if len(h):
                    ids.append(doc_id)
                    held.append(h)
                    n += len(h)
                if n >= GATHER:
                    yield _dealt(ids, held, buckets)
                    ids, held, n = [], [], 0
        if n:
            yield _dealt(ids, held, buckets)

    def compare(batches) -> Iterator[dict]:
        own, open_, known = -1, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != own:
                    yield from _found(open_, known, groups)
                    own, open_, known = row["bucket"], [], []
                open_.append(_entries(row["docs"], row["times"], row["hashes"]))
                known.append(_entries(row["known_docs"], row["known_times"], row["known"]))
                if sum(len(docs) for docs, _ in known) > FLUSH:
                    yield _packed(*_joined(known), "group", groups)
                    known = []
        yield from _found(open_, known, groups)

    def merge(batches) -> Iterator[dict]:
        own, held = -1, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != own:
                    yield from _by_document(held)
                    own, held = row["group"], []
                held.append(_entries(row["docs"], row["times"], row["hashes"]))
        yield from _by_document(held)

    entry = "bucket long, docs binary, times binary, hashes binary, known_docs binary, known_times binary, known binary"
    dealt = map_arrow(texts, entry, gather).repartition(F.col("bucket")).sortWithinPartitions("bucket")
    back = map_arrow(dealt, "group long, docs binary, times binary, hashes binary", compare).repartition(F.col("group")).sortWithinPartitions("group")
    return materialize(map_arrow(back, "doc_id long, hashes binary", merge), "window-repeats")


def _entries(docs: bytes, times: bytes, hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.frombuffer(docs, "<i8"), np.frombuffer(times, "<u4")), _long(hashes)


def _packed(docs: np.ndarray, hashes: np.ndarray, name: str, groups: int) -> dict:
    """Entries as one row per group of documents."""
    group = (mix(docs, 8) % np.uint64(groups)).astype(np.int64)
    order = np.lexsort((docs, group))
    docs, hashes, group = docs[order], hashes[order], group[order]
    ends = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)] if len(group) else [0]
    parts = [(int(group[a]), *_runs(docs[a:b], hashes[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return {key: [part[k] for part in parts] for k, key in enumerate((name, "docs", "times", "hashes"))}


def _dealt(ids: list[int], held: list[np.ndarray], buckets: int) -> dict:
    docs = np.repeat(np.array(ids, np.int64), [len(h) for h in held])
    hashes = np.concatenate(held)
    bucket = (mix(hashes, 4) % np.uint64(buckets)).astype(np.int64)
    known = repeats(docs, hashes)
    out: dict[str, list] = {k: [] for k in ("bucket", "docs", "times", "hashes", "known_docs", "known_times", "known")}
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.unique(bucket).tolist():
        at = order[ends[b] : ends[b + 1]]
        out["bucket"].append(b)
        for names, part in ((("docs", "times", "hashes"), at[~known[at]]), (("known_docs", "known_times", "known"), at[known[at]])):
            for name, raw in zip(names, _runs(docs[part], hashes[part]), strict=True):
                out[name].append(raw)
    return out


def _joined(entries: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([d for d, _ in entries] or [np.zeros(0, np.int64)]), np.concatenate([h for _, h in entries] or [np.zeros(0, np.uint64)])


def _found(open_: list, known: list, groups: int) -> Iterator[dict]:
    """What a bucket finds, and what was known of it before."""
    docs, hashes = _joined(open_)
    if len(docs):
        hit = repeats(docs, hashes)
        known = [*known, (docs[hit], hashes[hit])]
    yield _packed(*_joined(known), "group", groups)


def _by_document(held: list) -> Iterator[dict]:
    docs, hashes = _joined(held)
    order = np.argsort(docs, kind="stable")
    own, times, short = _runs(docs[order], hashes[order])
    ends = KEY * np.cumsum(np.r_[0, np.frombuffer(times, "<u4")])
    yield {"doc_id": np.frombuffer(own, "<i8"), "hashes": [short[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]}


def intervals(hit: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal token intervals covered by windows that start where ``hit`` is set."""
    edge = np.zeros(len(hit) + width, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    covered = np.r_[False, np.cumsum(edge) > 0, False]
    turn = np.flatnonzero(covered[1:] != covered[:-1])
    return list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))


def remove_repeats(docs: DataFrame, width: int = 13) -> DataFrame:
    """Remove each word that a repeated window covers.

    Words are runs of characters other than ASCII white space. A window of ``width`` consecutive words repeats if the same words
    also start in a document with a smaller doc_id; windows are judged on the input, not on what is left. Returns per row doc_id, n_words,
    n_removed, spans (array of first and last + 1 word of each maximal removed interval) and kept (the other words joined by a space).
    A null text has no words. Rows without a doc_id lose nothing and take nothing from others; rows with one doc_id count as one document.
    Columns other than doc_id and text are not read. Two windows are taken as equal if 56 bits of hash and the bucket agree.
    """
    texts = id_text(docs)
    found = repeated_windows(docs, width)
    note, key = fresh(texts, "_hashes"), fresh(texts, "_id")
    small = found.select(F.col("doc_id").alias(key), F.col("hashes").alias(note)).hint("shuffle_hash")
    both = texts.join(small, F.col("doc_id") == F.col(key), "left").drop(key)

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "spans", "kept")}
            for text, raw in zip(octets(batch), batch.column(note).to_pylist(), strict=True):
                words, spans = text.split(), []
                if raw:
                    spans = intervals(np.isin(window_hashes(words, width) & _LOW, _long(raw)), width)
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["kept"].append(b" ".join(kept))
            yield out | {"doc_id": batch.column("doc_id"), "kept": pa.array(out["kept"], pa.binary())}

    return map_arrow(both, "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string", run)


def digests(docs: DataFrame, width: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words."""
    return remove_repeats(docs, width).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
