"""SimHash near-duplicates by ball hashing that meets in the middle.

Two fingerprints that differ in at most 2r bits have a common variant: a number within r bits of both. Every fingerprint
therefore emits all its variants within r bits, variants meet in a shuffle, and fingerprints that share a variant are linked after
their distance is checked.

A variant is emitted in two steps, so that the shuffle does not carry thousands of rows per fingerprint: the variants of the first
``b`` bits choose the bucket and are shuffled with the fingerprint; the variants of the other bits are made inside the bucket, in
parts of bounded size. All fingerprints that share a variant lie within 2r bits of each other, so linking each with the smallest
gives the same components as linking all pairs.

``keep_one`` takes near-duplicates by the share of common word shingles instead: fingerprints within four bits find about half of the pairs that share 0.8 of
their five-word shingles, so least-hash keys propose further candidates and every link is verified on the whole texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clanweave.llm.common import fresh, id_text, map_arrow, mix, octets
from clanweave.operators.graph import connected_components
from clanweave.session import materialize

#: Variants that are held at a time, variants of one bucket (on average), shingles whose bits are counted at a time.
HELD, BUCKET, SHINGLES = 1 << 19, 1 << 22, 1 << 14


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """The SimHash of the ``width``-word shingles (with repeats) of the lower-cased text; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    hashes = np.fromiter(map(functools.partial(xxhash.xxh64_intdigest, seed=seed), shingles), ">u8", n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, SHINGLES):
        bits = np.unpackbits(hashes[k : k + SHINGLES].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a long)."""

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            prints = np.array([fingerprint(t, width, seed) for t in octets(batch)], np.uint64)
            yield {"doc_id": batch.column("doc_id"), "fingerprint": prints.view(np.int64)}

    return map_arrow(id_text(docs), "doc_id long, fingerprint long", run)


def flips(bits: int, most: int) -> list[np.ndarray]:
    """For each k up to ``most``: all numbers of ``bits`` bits of which exactly k are set."""
    return [np.array([sum(1 << i for i in c) for c in combinations(range(bits), k)], np.uint64) for k in range(most + 1)]


def _links(prints: np.ndarray, budget: np.ndarray, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indices of fingerprints that share a variant of their low ``bits`` bits, each flipping at most ``budget`` of them.

    If there are too many variants to hold, the next bits are fixed to each value in turn, as buckets do with the first bits.
    """
    sizes = np.cumsum([len(x) for x in flips(min(bits, 64), radius)])
    total = int(sizes[budget].sum())
    if total > HELD and bits > 8 and len(prints) > 1:
        step = 4
        low = np.uint64((1 << (bits - step)) - 1)
        head = (prints >> np.uint64(bits - step)) & np.uint64((1 << step) - 1)
        found = []
        for value in range(1 << step):
            used = np.bitwise_count(head ^ np.uint64(value)).astype(np.int64)
            own = np.flatnonzero(used <= budget)
            if len(own) > 1:
                a, b = _links(prints[own] & low, budget[own] - used[own], bits - step, radius)
                found.append((own[a], own[b]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])
    masks = flips(bits, radius)
    low = np.uint64((1 << bits) - 1) if bits < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)
    variants, owners = [], []
    for k in range(radius + 1):
        own = np.flatnonzero(budget == k)
        mask = np.concatenate(masks[: k + 1])
        if len(own):
            variants.append(((prints[own] & low)[:, None] ^ mask[None, :]).ravel())
            owners.append((own, len(mask)))
    every = np.concatenate(variants)
    ordered = np.sort(every)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spot = np.searchsorted(shared, every)
    spot[spot == len(shared)] = 0
    hit = np.flatnonzero(shared[spot] == every)
    owner = np.concatenate([np.repeat(own, n) for own, n in owners])[hit]
    group = spot[hit]
    order = np.lexsort((owner, group))
    owner, group = owner[order], group[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    lead = np.repeat(owner[first], np.diff(np.r_[first, len(group)]))
    pair = np.unique((lead * len(prints) + owner)[lead != owner])
    return pair // len(prints), pair % len(prints)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` indices is linked with."""
    root = np.arange(n)
    while True:
        before = root
        root = root.copy()
        low = np.minimum(before[a], before[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            return root


def near_links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links (src, dst) that connect the distinct fingerprints within ``distance`` bits, directly or through others."""
    spark = prints.sparkSession
    radius = distance // 2
    distinct = prints.select("fingerprint").distinct()
    n = distinct.count()
    variants = n * sum(len(x) for x in flips(64, radius))
    at_once = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(2, int(np.ceil(np.log2(max(1, variants / BUCKET, at_once)))))

    def emit(batches) -> Iterator[dict]:
        heads = np.concatenate(flips(bits, radius))
        for batch in batches:
            own = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            bucket = ((own >> np.uint64(64 - bits))[:, None] ^ heads[None, :]).ravel().astype(np.int64)
            yield {"bucket": bucket, "fingerprint": np.repeat(own, len(heads)).view(np.int64)}

    def meet(batches) -> Iterator[dict]:
        own, held = -1, []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
            found = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            for b in np.unique(bucket).tolist():
                if b != own:
                    yield from linked(own, held)
                    own, held = b, []
                held.append(found[bucket == b])
        yield from linked(own, held)

    def linked(bucket: int, held: list[np.ndarray]) -> Iterator[dict]:
        if not held:
            return
        own = np.unique(np.concatenate(held))
        budget = radius - np.bitwise_count((own >> np.uint64(64 - bits)) ^ np.uint64(bucket)).astype(np.int64)
        a, b = _links(own, budget, 64 - bits, radius)
        near = np.bitwise_count(own[a] ^ own[b]) <= distance
        root = _roots(len(own), a[near], b[near])
        other = np.flatnonzero(root != np.arange(len(own)))
        if len(other):
            yield {"src": own[other].view(np.int64), "dst": own[root[other]].view(np.int64)}

    dealt = map_arrow(distinct, "bucket long, fingerprint long", emit).repartition(F.col("bucket")).sortWithinPartitions("bucket")
    return map_arrow(dealt, "src long, dst long", meet)


def near_duplicates(docs: DataFrame, distance: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """Components of documents whose fingerprints are linked by steps of at most ``distance`` (an even number of) bits.

    Returns per row doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id of the component. Null and empty texts
    have fingerprint 0 and link like any other. A component of rows without a doc_id alone has a null component_id. Repeated rows are
    kept. Columns other than doc_id and text are not read. Equal fingerprints are never paired: components are found on distinct ones.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    prints = materialize(fingerprints(docs, width, seed), "fingerprints")
    # Links repeat across buckets; they are made once and stored.
    links = materialize(near_links(prints, distance), "near-links")
    joined = connected_components(links, links, include_singletons=False).select(F.col("node").alias("fingerprint"), "component")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    group = least.join(joined, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    named = group.groupBy("component").agg(F.min("least").alias("component_id"))
    names = materialize(group.select("fingerprint", "component").join(named, "component").select("fingerprint", "component_id"), "near-names")
    out = prints.join(names, "fingerprint")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: Words of the shingles, share of common shingles and sketch of verified near-duplicates: ``BANDS`` keys of ``PER_BAND`` least hashes each. A pair at
#: exactly 0.8 has a common key with 0.986, one at 0.9 with 0.99999; stages of near-duplicates are held to a recall of 0.9 by their tests.
WORDS, SHARE, BANDS, PER_BAND = 5, 0.8, 14, 6
#: Texts that are compared with one text by one task, on average.
COMPARED = 1000


def shingle_set(text: bytes, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of the lower-cased text; fewer words: of the whole sequence; none: empty."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles), np.uint64, max(1, len(words) - width + 1)))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of the bands of a set: hashes of its least elements in fixed orders (products with odd numbers)."""
    if not len(hashes):
        return np.zeros(BANDS, np.int64)
    factors = mix(np.arange(BANDS * PER_BAND), 7) | np.uint64(1)
    with np.errstate(over="ignore"):
        parts = [(hashes[k : k + SHINGLES // 4] * factors[:, None]).min(axis=1) for k in range(0, len(hashes), SHINGLES // 4)]
        least = np.minimum.reduce(parts).reshape(BANDS, PER_BAND)
        out = np.arange(BANDS, dtype=np.uint64)
        for k in range(PER_BAND):
            out = mix(out ^ least[:, k], k)
    return out.view(np.int64)


def text_key(text: str = "text") -> Column:
    """128 bits of a digest, as a string, that name a text; null is empty."""
    return F.substring(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256), 1, 32)


def similar(pairs: DataFrame, texts: DataFrame, share: float = SHARE) -> DataFrame:
    """``pairs`` (node, lead) with ``near``: whether the texts share so much of their shingles (common ones of all).

    ``texts`` has (node, text). A lead's text is sent once for every ``COMPARED`` of its nodes, a node's text once for each pair; one pair is held at a time.
    """
    groups = pairs.groupBy("lead").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / COMPARED)).cast("long").alias("parts"))
    leads = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).join(texts.withColumnRenamed("node", "lead"), "lead")
    asked = pairs.join(groups, "lead").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).join(texts, "node")
    rows = leads.select("lead", "part", F.lit(None).cast("string").alias("node"), "text").unionByName(asked.select("lead", "part", "node", "text"))
    rows = rows.repartition("lead", "part").sortWithinPartitions("lead", "part", F.asc_nulls_first("node"))

    def run(batches) -> Iterator[dict]:
        held = None
        for batch in batches:
            out = ([], [], [])
            for lead, node, text in zip(batch.column("lead").to_pylist(), batch.column("node").to_pylist(), octets(batch), strict=True):
                own = shingle_set(text)
                if node is None:
                    held = own
                    continue
                common = len(np.intersect1d(own, held, assume_unique=True))
                every = len(own) + len(held) - common
                for column, value in zip(out, (node, lead, common >= share * every - 1e-9), strict=True):
                    column.append(value)
            yield dict(zip(("node", "lead", "near"), out, strict=True))

    return map_arrow(rows, "node string, lead string, near boolean", run)


def near_classes(docs: DataFrame, distance: int = 4, share: float = SHARE) -> DataFrame:
    """Classes of texts that are linked by steps of verified likeness: at least ``share`` of their five-word shingles in common.

    Returns (node, class, least): ``node`` names a distinct text (``text_key``), ``class`` the class, ``least`` is the smallest doc_id with that text (null
    if none has one). Candidates are texts whose fingerprints are linked within ``distance`` bits, and texts that share a key of a band: of those
    that share one all are compared with the first of them; those unlike it share the next band's key too or are compared no more for it. So groups of any
    size cost their size. A null text is empty; texts without words are one class.
    """
    rows = id_text(docs, text_key().alias("node"))

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            texts = octets(batch)
            prints = np.array([fingerprint(t) for t in texts], np.uint64)
            bands = [band_keys(shingle_set(t)) for t in texts]
            yield {"doc_id": batch.column("doc_id"), "node": batch.column("node"), "fingerprint": prints.view(np.int64), "bands": bands}

    sketched = materialize(map_arrow(rows, "doc_id long, node string, fingerprint long, bands array<long>", run), "sketches")
    nodes = materialize(sketched.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("fingerprint").alias("fingerprint"), F.first("bands").alias("bands")), "texts")
    held = nodes.groupBy("fingerprint").agg(F.min("node").alias("lead"))
    near = materialize(near_links(nodes, distance), "near-links")
    across = near.join(held.select(F.col("fingerprint").alias("src"), F.col("lead").alias("node")), "src").join(held.withColumnRenamed("fingerprint", "dst"), "dst")
    alike = nodes.join(held, "fingerprint").where("node <> lead").select("node", "lead").unionByName(across.select("node", "lead"))
    links, after = [], alike
    met = nodes.select("node", "bands", F.posexplode("bands").alias("band", "key"))
    for step in range(BANDS + 1):
        if step:  # all that is left of a bucket agrees on one more band
            met = left.withColumn("key", F.xxhash64("key", F.get("bands", (F.col("band") + step) % BANDS)))  # noqa: F821
        buckets = met.groupBy("band", "key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last").select("band", "key", "lead")
        stars = materialize(met.join(buckets, ["band", "key"]).where("node <> lead"), "stars")
        pairs = stars.select("node", "lead")
        if step == 0:
            pairs = pairs.unionByName(after)
            # Later rounds compare some of the same texts: those of candidates are stored once, and no round moves the others.
            wanted = materialize(pairs.select(F.explode(F.array("node", "lead")).alias("node")).distinct(), "wanted")
            texts = materialize(rows.select("node", "text").join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "candidates")
        elif stars.isEmpty():
            break
        judged = materialize(similar(pairs.distinct(), texts, share), "judged")
        links.append(judged.where("near").select(F.col("node").alias("src"), F.col("lead").alias("dst")))
        left = materialize(stars.join(judged.where("not near").select("node", "lead"), ["node", "lead"], "left_semi").select("node", "bands", "band", "key"), "left")
    found = functools.reduce(DataFrame.unionByName, links)
    joined = connected_components(found, found, include_singletons=False).select("node", F.col("component").alias("class"))
    return nodes.select("node", "least").join(joined, "node", "left").select("node", F.coalesce("class", "node").alias("class"), "least")


def keep_one(docs: DataFrame, distance: int = 4, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class of ``near_classes`` the row with the smallest doc_id stays.

    Rows are told apart by their texts: rows of one doc_id with unlike texts are in classes of their own and don't go for each other. Of rows of one class
    that share the smallest doc_id the one with the least text key stays, of rows equal in both the least (in the order of the columns, which must be
    orderable). A class of rows without a doc_id keeps one row alike. A null text is empty. All columns are returned, whatever their names.
    """
    classes = near_classes(docs, distance, share)
    stays = classes.groupBy("class").agg(F.min(F.struct(F.col("least").isNull().alias("z"), "least", "node")).alias("s")).select("s.least", "s.node")
    node, least, row = fresh(docs, "_node"), fresh(docs, "_least"), fresh(docs, "_row")
    stays = materialize(stays.select(F.col("node").alias(node), F.col("least").alias(least)), "stays").hint("shuffle_hash")
    named = docs.withColumn(node, text_key()).join(stays, node).where(F.col("doc_id").cast("long").eqNullSafe(F.col(least)))
    return named.groupBy(node).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(row)).select(f"{row}.*")
