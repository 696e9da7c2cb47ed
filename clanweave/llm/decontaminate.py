"""Benchmark decontamination by size-partitioned MinHash containment search.

Containment of a short item in a long document says nothing about their Jaccard similarity, so items are searched by the smallest
hashes of their own shingles. Items are partitioned by size (number of distinct shingles, by powers of two). If at least
``threshold`` of an item's n shingles lie in a document, at most m = floor((1 - threshold) n) are missing, so one of the m + 1 smallest
hashes of the item (its MinHash sketch) must be there: no contained item is missed. A partition's largest sketch hash is the
limit below which hashes of a document belong to its sketch for that partition. Items that share a sketch hash with a
document are candidates; they are verified by the exact share of their shingles.

Documents are read once and not shuffled. Items are handled in blocks of bounded size (``BLOCK`` shingles), each broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clanweave.llm.common import fresh, map_arrow, mix, octets
from clanweave.session import materialize

#: Shingles of one block of items at most (an item is never cut), and bits of the first test of a hash.
BLOCK, TEST_BITS = 1 << 20, 20
# ASCII punctuation and white space separate words, A-Z are lower-cased.
SEPARATORS = bytes([*range(9, 14), *range(32, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
_TABLE = bytes(32 if b in SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = np.uint64(0x5851F42D4C957F2D)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """A 64-bit hash of every shingle; a text of fewer words is one shingle, one without words has none."""
    if not words:
        return np.zeros(0, np.uint64)
    token = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    rolled = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(width, len(words))):
            rolled = rolled * _BASE + token[k : k + n]
    return mix(rolled, 11 if len(words) >= width else 100 + len(words))


def shingles_of(words: list[bytes], width: int) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}


class Block:
    """Items with their sketches: what is broadcast."""

    def __init__(self, items: list[tuple[int, bytes]], width: int, threshold: float):
        self.width, self.threshold = width, threshold
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        hashes = [np.unique(shingle_hashes(w, width)) for w in self.words]
        self.need = [int(np.ceil(threshold * len(h) - 1e-9)) for h in hashes]
        sketch = [h[: len(h) - n + 1] for h, n in zip(hashes, self.need, strict=True)]
        # A partition is the items of one size class; its limit is its largest sketch hash.
        self.parts = []
        classes = np.array([len(h).bit_length() for h in hashes])
        for size in np.unique(classes[classes > 0]).tolist():
            own = np.flatnonzero(classes == size).tolist()
            keys = np.unique(np.concatenate([sketch[k] for k in own]))
            self.parts.append((keys[-1], keys, self._test(keys)))
        self.key, self.item = self._table(sketch)
        self.every, self.holder = self._table(hashes)

    @staticmethod
    def _test(keys: np.ndarray) -> np.ndarray:
        test = np.zeros(1 << TEST_BITS, bool)
        test[(mix(keys, 6) >> np.uint64(64 - TEST_BITS)).astype(np.int64)] = True
        return test

    @staticmethod
    def _table(per_item: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.concatenate([*per_item, np.zeros(0, np.uint64)])
        items = np.repeat(np.arange(len(per_item)), [len(h) for h in per_item])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], items[order]

    def contained(self, text: bytes) -> list[tuple[int, float]]:
        """(item, containment) of the items of which at least the threshold lies in ``text``."""
        words = words_of(text)
        own = shingle_hashes(words, self.width)
        found = []
        for limit, keys, test in self.parts:
            near = own[own <= limit]
            near = near[test[(mix(near, 6) >> np.uint64(64 - TEST_BITS)).astype(np.int64)]]
            if len(near):
                at = np.minimum(np.searchsorted(keys, near), len(keys) - 1)
                found.append(near[keys[at] == near])
        hit = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]))
        if not len(hit):
            return []
        candidates = np.unique(_of(self.key, self.item, hit))
        times = np.bincount(_of(self.every, self.holder, np.unique(own)), minlength=len(self.ids))
        out, exact = [], None
        for k in candidates.tolist():
            if times[k] >= self.need[k]:
                exact = exact if exact is not None else shingles_of(words, self.width)
                wanted = shingles_of(self.words[k], self.width)
                share = len(wanted & exact) / len(wanted)
                if share >= self.threshold:
                    out.append((self.ids[k], share))
        return sorted(out)


def _of(keys: np.ndarray, items: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Items of all entries whose key is in ``wanted``."""
    a, b = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
    n = b - a
    return items[np.repeat(a - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]


def _blocks(items: DataFrame, width: int, threshold: float) -> Iterator[Block]:
    """The items with an id and a word, in blocks of at most ``BLOCK`` shingles (or one item)."""
    held, n = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna().toLocalIterator():
        size = len(words_of(row["text"].encode()))
        if held and n + size > BLOCK:
            yield Block(held, width, threshold)
            held, n = [], 0
        if size:
            held.append((row["item_id"], row["text"].encode()))
            n += size
    if held:
        yield Block(held, width, threshold)


def find_items(docs: DataFrame, items: DataFrame, name: str = "leaks", width: int = 5, threshold: float = 0.8) -> DataFrame:
    """Find the ``items`` (item_id, text) that lie in each document.

    Words are runs of characters other than ASCII white space and punctuation, A-Z lower-cased; a shingle is ``width`` words in a row (a text
    of fewer words is one shingle, equal only to a text of the same words). An item is found if at least ``threshold`` of its
    distinct shingles are in the document. Returns all columns of ``docs`` and ``name`` (with underscores in front if taken): an array of
    (item_id, containment) in order of item_id, empty if none. Null and empty texts hold nothing; items without an id or a word are not
    searched; rows and items that repeat are each answered.
    """
    name = fresh(docs, name)
    kind = "array<struct<item_id:long,containment:double>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{name}` {kind}"
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("containment", pa.float64())]))

    def search(block):
        def run(batches) -> Iterator[dict]:
            for batch in batches:
                columns = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
                before = columns[name].to_pylist()
                found = [[{"item_id": i, "containment": c} for i, c in block.value.contained(t)] for t in octets(batch)]
                yield columns | {name: pa.array([sorted(a + b, key=lambda x: x["item_id"]) for a, b in zip(before, found, strict=True)], arrow)}

        return run

    out = docs.withColumn(name, F.array().cast(kind))
    for k, block in enumerate(_blocks(items, width, threshold)):
        # One block is held by the executors at a time: a further one reads what the last one wrote.
        out = map_arrow(materialize(out, "leaks") if k else out, schema, search(docs.sparkSession.sparkContext.broadcast(block)))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` in which no item is found (see ``find_items``), with the same columns."""
    name = fresh(docs, "leaks")
    return find_items(docs, items, name, width, threshold).where(F.size(name) == 0).drop(name)
