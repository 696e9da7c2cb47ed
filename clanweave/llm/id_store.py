"""Token ids as raw binary shards with a minimal perfect hash index.

A store is a folder with

* ``shard-<n>.bin``: the ids of the documents in ascending key order as little-endian unsigned integers of 16 or 32 bits,
  nothing else; shards follow each other in key order;
* ``index-<n>.mph``: for the keys of one hash bucket a minimal perfect hash (levels of bit arrays; a key's slot is the rank of
  its bit) and, in slot order, a fingerprint of the key, the shard, the first id and the number of ids;
* ``totals`` (Parquet): ids per shard, from which global positions follow.

Any key is found with one index file, a few bit tests, and one range read of a shard.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clanweave.llm.common import Memo, held_by_worker, id_text, map_arrow, mix, octets
from clanweave.session import materialize, scratch_path

#: Distinct words, and pieces of words, whose ids a Python worker remembers; words that are encoded in one call; keys of one index bucket;
#: bytes of one range read.
MEMO, PIECES, JOINED, BUCKET, READ = 400_000, 300_000, 4096, 1 << 16, 8 << 20
_ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("first", "<u8"), ("count", "<u4")])
_MAGIC = b"CWMPH01\n"


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, chunks) -> None:
    """Write under a name of this attempt, then rename: a lost or repeated attempt leaves no half file behind the name."""
    system, root = _file_system(folder)
    system.create_dir(root, recursive=True)
    own = f"{root}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(own, f"{root}/{name}")


# --- encoding -----------------------------------------------------------------------------------------------------------


#: Letters and digits of plain texts, which hold nothing else beyond ASCII: composed already, and lower-cased one by one.
LETTERS, DIGITS = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9"


def plain_pieces(spec: dict) -> tuple[re.Pattern, bool] | None:
    """How a plain text falls into the pieces that the model sees, and whether it is lower-cased before; None if the tokenizer isn't known to treat it so.

    The pattern is the tokenizer's own, with the letters and digits of plain texts for those of Unicode; composition and the joining of white space do not change the pieces.
    """
    norm = (spec["normalizer"] or {"normalizers": []}).get("normalizers", [spec["normalizer"]])
    split, *rest = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    space = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if any(n["type"] not in ("NFC", "Lowercase") and n != space for n in norm) or spec["model"]["type"] != "BPE" or spec["model"]["dropout"]:
        return None
    if (split.get("type"), split.get("behavior"), split.get("invert")) != ("Split", "Removed", True) or "Regex" not in split["pattern"]:
        return None
    if [(r["type"], r.get("add_prefix_space"), r.get("use_regex")) for r in rest] != [("ByteLevel", False, False)]:
        return None
    pattern = re.sub(r"\[\^?(\\s|\\p\{[LN]\})+\]", lambda m: m[0].replace(r"\p{L}", LETTERS).replace(r"\p{N}", DIGITS), split["pattern"]["Regex"])
    return None if r"\p" in pattern else (re.compile(pattern), any(n["type"] == "Lowercase" for n in norm))


class _Pieces(dict):
    """The ids of pieces, encoded when first asked for unless the generation before holds them."""

    def __init__(self, compute, old: dict):
        self.compute, self.old = compute, dict(old)

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.old.get(piece) or self.compute(piece)
        return ids


class WordEncoder:
    """The library's ids of a text, word by word: in the supported tokenizers no token lies across white space."""

    OTHER = re.compile(rf"[^\t-\r -~{LETTERS}]").search

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        if not spec["model"].get("end_of_word_suffix") or any(t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("the tokenizer must drop white space between words")
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.memo, self.parts = Memo(MEMO), _Pieces(self._merged, {})
        self.pieces = plain_pieces(spec)
        self.added = [t["content"].lower() for t in spec["added_tokens"]]

    def _merged(self, piece: str) -> bytes:
        """The ids of a piece. The library spells bytes beyond ASCII with other letters; a piece of ASCII is spelled as it is."""
        if not piece.isascii():
            piece = "".join(x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(piece))
        return b"".join([t.id.to_bytes(self.kind.itemsize, "little") for t in self.library.model.tokenize(piece)])

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word. Words are encoded as one text, since a call costs more than a word; tokens are dealt to words by where they start."""
        out = []
        for k in range(0, len(words), JOINED):
            part = [w.decode() for w in words[k : k + JOINED]]
            found = self.library.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, self.kind)
            starts = np.cumsum([0, *(len(w) + 1 for w in part)])
            cuts = np.searchsorted(np.array([a for a, _ in found.offsets], np.int64), starts).tolist()
            out += [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def encode(self, text: bytes) -> bytes:
        """The ids of a text. Many words hold the same pieces, and the library's own splitting costs more than its merges, so plain texts are split first."""
        whole = text.decode()
        if self.pieces is not None and self.OTHER(whole) is None:
            split, lower = self.pieces
            small = whole.lower()
            if not any(t in small for t in self.added):
                if len(self.parts) > PIECES:
                    self.parts = _Pieces(self._merged, self.parts)
                return b"".join(map(self.parts.__getitem__, split.findall(small if lower else whole)))
        return b"".join(self.memo.values(text.split(), self._encode))


_LOADED: dict[str, WordEncoder] = held_by_worker("ids")


def word_encoder(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


# --- minimal perfect hash -----------------------------------------------------------------------------------------------


class PerfectHash:
    """Slots 0..n-1 for n distinct 64-bit key hashes: keys alone on their bit of a level are placed, the others go to the next."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        placed = [int(level.sum()) for level in levels]
        self.base = np.cumsum([0, *placed])
        self.ranks = [np.cumsum(level, dtype=np.int64) - level for level in levels]

    @classmethod
    def build(cls, hashes: np.ndarray, gamma: float = 2.0, most: int = 48) -> PerfectHash:
        levels, left = [], hashes
        while len(left) and len(levels) < most:
            size = max(8, int(gamma * len(left)) // 8 * 8)
            at = (mix(left, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels, np.sort(left))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 where it surely is not a key."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for k, (level, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mix(hashes[open_], k + 1) % np.uint64(len(level))).astype(np.int64)
            hit = level[at]
            out[open_[hit]] = self.base[k] + rank[at[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, hashes[open_]), len(self.rest) - 1)
            hit = self.rest[at] == hashes[open_]
            out[open_[hit]] = self.base[-1] + at[hit]
        return out

    def chunks(self) -> Iterator[bytes]:
        yield np.array([len(self.levels), len(self.rest), *map(len, self.levels)], "<u8").tobytes()
        for level in self.levels:
            yield np.packbits(level).tobytes()
        yield self.rest.astype("<u8").tobytes()

    @classmethod
    def read(cls, raw: bytes) -> tuple[PerfectHash, int]:
        n, rest = np.frombuffer(raw, "<u8", 2).astype(int)
        sizes = np.frombuffer(raw, "<u8", n, 16).astype(int)
        at, levels = 16 + 8 * n, []
        for size in sizes:
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, size // 8, at)).astype(bool))
            at += size // 8
        return cls(levels, np.frombuffer(raw, "<u8", rest, at)), at + 8 * rest


def key_hash(keys: np.ndarray, absent: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Hash of a key: a document id (or its absence) and the number of the copy. Different first copies never collide."""
    h = mix(keys.view(np.uint64))
    return np.where((copies == 0) & ~absent, h, mix(h + copies.astype(np.uint64) * np.uint64(2) + absent.astype(np.uint64), 77))


def key_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(hashes, 5) % np.uint64(buckets)).astype(np.int64)


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes, 9) >> np.uint64(32)).astype("<u4")


class IndexFile:
    def __init__(self, raw: bytes):
        assert raw[: len(_MAGIC)] == _MAGIC
        self.hash, at = PerfectHash.read(raw[len(_MAGIC) :])
        self.entries = np.frombuffer(raw, _ENTRY, offset=len(_MAGIC) + at)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are keys (by fingerprint), and the entries of those."""
        slots = self.hash.slots(hashes)
        known = (slots >= 0) & (slots < len(self.entries))
        known[known] = self.entries["print"][slots[known]] == _prints(hashes[known])
        return known, self.entries[slots[known]]


# --- store --------------------------------------------------------------------------------------------------------------


class IdStore:
    """A written store: ``keys`` has (doc_id, copy), ``totals`` the ids per shard; ``fetch`` reads ids by key."""

    def __init__(self, spark: SparkSession, folder: str, kind: str, keys: DataFrame, totals: DataFrame, buckets: int):
        self.spark, self.folder, self.kind, self.keys, self.totals, self.buckets = spark, folder, kind, keys, totals, buckets

    def locate(self, keys: DataFrame) -> DataFrame:
        """Rows (doc_id, copy, shard, first, count) of those ``keys`` (doc_id, copy) that the index knows."""
        folder, buckets = self.folder, self.buckets

        def run(batches) -> Iterator[dict]:
            system, root = _file_system(folder)
            loaded: tuple[int, IndexFile | None] = (-1, None)
            for batch in batches:
                ids, absent, copies = _keys(batch)
                hashes = key_hash(ids, absent, copies)
                own = batch.column("_bucket").to_numpy(zero_copy_only=False)
                for b in np.unique(own).tolist():
                    if loaded[0] != b:
                        with system.open_input_file(f"{root}/index-{b:06d}.mph") as f:
                            loaded = b, IndexFile(f.read())
                    at = np.flatnonzero(own == b)
                    known, entry = loaded[1].find(hashes[at])
                    at = at[known]
                    yield {"doc_id": batch.column("doc_id").take(pa.array(at)), "copy": copies[at]} | {k: entry[k].astype(np.int64) for k in ("shard", "first", "count")}

        dealt = with_bucket(keys, buckets).repartition(F.col("_bucket")).sortWithinPartitions("_bucket")
        return map_arrow(dealt, "doc_id long, copy long, shard long, first long, count long", run)

    def fetch(self, keys: DataFrame) -> DataFrame:
        """Read the ids of ``keys``: doc_id, copy, start (ids of all documents before it), n_tokens, ids_crc32 and ids (binary)."""
        folder, kind = self.folder, np.dtype(self.kind)
        base = self.totals.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
        # One shard's ranges are read by one task in rising order, so that reads are sequential.
        found = self.locate(keys).join(base, F.col("shard") == F.col("_shard"))
        dealt = found.repartition(F.col("shard")).sortWithinPartitions("shard", "first")

        def run(batches) -> Iterator[dict]:
            system, root = _file_system(folder)
            at, file = -1, None
            for batch in batches:
                col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("shard", "first", "count", "_base")}
                ids = []
                for shard, first, count in zip(col["shard"].tolist(), col["first"].tolist(), col["count"].tolist(), strict=True):
                    if shard != at:
                        at, file = shard, _Reader(system.open_input_file(f"{root}/shard-{shard:06d}.bin"))
                    ids.append(file.read(first * kind.itemsize, count * kind.itemsize))
                wide = [np.frombuffer(x, kind).astype("<u4") for x in ids]
                yield {
                    "doc_id": batch.column("doc_id"), "copy": batch.column("copy"), "start": col["_base"] + col["first"], "n_tokens": col["count"],
                    "ids_crc32": [zlib.crc32(x) for x in wide], "ids": [x.tobytes() for x in wide],
                }

        return map_arrow(dealt, "doc_id long, copy long, start long, n_tokens long, ids_crc32 long, ids binary", run)


class _Reader:
    """Range reads of one file through a window, for ranges that mostly rise."""

    def __init__(self, file):
        self.file, self.at, self.held = file, 0, b""

    def read(self, at: int, size: int) -> bytes:
        if at < self.at or at + size > self.at + len(self.held):
            self.at, self.held = at, self.file.read_at(max(size, READ), at)
        return self.held[at - self.at : at - self.at + size]


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("doc_id")
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False), batch.column("copy").to_numpy(zero_copy_only=False)


def with_bucket(keys: DataFrame, buckets: int) -> DataFrame:
    names = [f"{n} {t}" for n, t in keys.dtypes if n != "_bucket"]

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            yield {n: batch.column(n) for n in batch.schema.names if n != "_bucket"} | {"_bucket": key_bucket(key_hash(*_keys(batch)), buckets)}

    return map_arrow(keys, ", ".join([*names, "_bucket long"]), run)


def write_store(docs: DataFrame, tokenizer_file: str, end_id: int = 1, folder: str | None = None) -> IdStore:
    """Encode every whole text, append ``end_id``, and write shards and index.

    Documents are dealt by range of doc_id (nulls first), equal ids by a hash of their text, so that one id may hold any
    share of the rows. A repeated doc_id gets the copies 0, 1, ... in that order; the key of a row is (doc_id, copy). Null and empty
    texts hold the end id alone. Columns other than doc_id and text are not read; an empty table makes an empty store.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "ids")

    def write(batches) -> Iterator[dict]:
        model = word_encoder(tokenizer_file)
        end = np.array([end_id], model.kind).tobytes()
        shard, width, first, rows = TaskContext.get().partitionId(), model.kind.itemsize, 0, []

        def chunks():
            nonlocal first
            before, copy = object(), 0
            for batch in batches:
                for key, text in zip(batch.column("doc_id").to_pylist(), octets(batch), strict=True):
                    ids = model.encode(text) + end
                    copy = copy + 1 if key == before else 0
                    before = key
                    rows.append((key, copy, first, len(ids) // width))
                    first += len(ids) // width
                    yield ids

        start = next(batches, None)
        if start is None:
            return
        batches = _again(start, batches)
        write_file(folder, f"shard-{shard:06d}.bin", chunks())
        ids, copies, firsts, counts = zip(*rows, strict=True)
        edge = np.array([k == ids[0] or k == ids[-1] for k in ids])
        yield {"doc_id": list(ids), "copy": list(copies), "shard": [shard] * len(ids), "first": list(firsts), "count": list(counts), "edge": edge}

    ranged = id_text(docs).repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    rows = materialize(map_arrow(ranged, "doc_id long, copy long, shard long, first long, count long, edge boolean", write, keeps="ids"), "ids-rows")
    totals = materialize(rows.groupBy("shard").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("rows")), "ids-totals")

    # Copies of an id that lies on both sides of a shard's edge go on counting; at most two ids of a shard do.
    same = Window.partitionBy("doc_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.where("edge").groupBy("doc_id", "shard").count().withColumn("_before", F.sum("count").over(same))
    before = before.where("_before is not null").select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), "_before")
    placed = rows.join(before, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("shard") == F.col("_shard")), "left")
    placed = placed.select("doc_id", (F.col("copy") + F.coalesce("_before", F.lit(0))).alias("copy"), "shard", "first", "count")

    n = totals.agg(F.sum("rows")).first()[0] or 0
    at_once = int(spark.conf.get("spark.sql.shuffle.partitions"))  # small stores still give every task a bucket
    buckets = max(1, -(-n // BUCKET), min(at_once, n // 64))
    width = word_encoder(tokenizer_file).kind.str

    def build(batches) -> Iterator[dict]:
        held: list = []
        own = -1
        for batch in batches:
            part = batch.column("_bucket").to_numpy(zero_copy_only=False)
            for b in np.unique(part).tolist():
                if b != own and held:
                    yield _write_index(folder, own, held)
                    held = []
                own = b
                held.append(batch.filter(pa.array(part == b)))
        if held:
            yield _write_index(folder, own, held)

    dealt = with_bucket(placed, buckets).repartition(F.col("_bucket")).sortWithinPartitions("_bucket")
    written = materialize(map_arrow(dealt, "bucket long, keys long", build), "ids-index")
    assert (written.agg(F.sum("keys")).first()[0] or 0) == n
    return IdStore(spark, folder, width, placed.select("doc_id", "copy"), totals, buckets)


def _again(first, rest):
    yield first
    yield from rest


def _write_index(folder: str, bucket: int, held: list[pa.RecordBatch]) -> dict:
    keys = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    hashes = key_hash(*_keys(keys))
    perfect = PerfectHash.build(hashes)
    entries = np.zeros(len(hashes), _ENTRY)
    slots = perfect.slots(hashes)
    for name in ("shard", "first", "count"):
        entries[name][slots] = keys.column(name).to_numpy(zero_copy_only=False)
    entries["print"][slots] = _prints(hashes)
    write_file(folder, f"index-{bucket:06d}.mph", [_MAGIC, *perfect.chunks(), entries.tobytes()])
    return {"bucket": [bucket], "keys": [len(hashes)]}


def store_digests(docs: DataFrame, tokenizer_file: str, end_id: int = 1) -> DataFrame:
    """Write a store of ``docs`` and read every document back by its key: doc_id, start, n_tokens, ids_crc32."""
    store = write_store(docs, tokenizer_file, end_id)
    return store.fetch(store.keys).select("doc_id", "start", "n_tokens", "ids_crc32")
