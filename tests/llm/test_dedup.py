"""op1, op6, op8 and op10 against brute force on small tables."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from clanweave.llm import decontaminate, line_dedup, simhash, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture
def rows():
    """Copies, near copies, shared passages and lines, empty and long texts, repeated and missing ids."""
    r = random.Random(5)
    passage, line = prose(r, 60), "This line is common to many documents, more than forty characters."
    out = [(k, prose(r, r.randint(0, 90))) for k in range(40)]
    out += [(k, out[3][1] + " " + passage) for k in range(40, 48)]
    out += [(k, f"{prose(r, 12)}\n  {line.upper()} \n{passage}\n{line}\n\n{prose(r, 5)}") for k in range(48, 60)]
    long = prose(r, 5000)
    out += [(60, long), (61, long.replace("w7 ", "w8 ", 3)), (62, long), (63, ""), (64, None), (65, " \n\t "), (66, "x" * 20000)]
    out += [(3, out[3][1]), (3, "a different text of a repeated id " + passage), (None, passage), (None, None), (70, passage.replace(" ", "\n"))]
    return out


def test_substring(docs, rows):
    named = [(k, WORD.findall(t or "")) for k, t in rows]
    least = {}
    for k, w in named:
        for i in range(len(w) - 12):
            if k is not None:
                least[tuple(w[i : i + 13])] = min(k, least.get(tuple(w[i : i + 13]), k))
    want = []
    for k, w in named:
        gone = {j for i in range(len(w) - 12) if k is not None and least[tuple(w[i : i + 13])] < k for j in range(i, i + 13)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((str(k), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(docs(rows, extra=True)).collect()]
    assert sorted(got) == sorted(want) and sum(x[2] for x in got) > 1000
    spans = substring_dedup.remove_repeats(docs(rows)).where("doc_id = 62").first().spans
    assert [(s.start, s.end) for s in spans] == [(0, 5000)]


def test_lines(docs, rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()

    holders = {}
    for k, t in rows:
        for line in (t or "").split("\n"):
            if k is not None and len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(k)
    want = []
    for k, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if k is None or len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == k]
        want.append((str(k), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digests(docs(rows, extra=True)).collect()]
    assert sorted(got) == sorted(want) and sum(x[2] for x in got) > 10
    clash = line_dedup.dedup_lines(docs(rows, extra=True))
    assert clash.select("_n_lines", "n_lines").where("n_lines = 'clash'").count() == len(rows)
    assert clash.where("text is null").count() == sum(t is None for _, t in rows)


def test_bloom_has_no_false_negatives():
    h = np.random.default_rng(2).integers(0, 1 << 63, 4000).astype(np.uint64)
    bloom = line_dedup.Bloom(1 << 16)
    bloom.add(h[:2000])
    assert bloom.has(h[:2000]).all() and bloom.has(h[2000:]).mean() < 0.05


def slow_print(text):
    words = [w.lower() for w in WORD.findall((text or ""))]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints, distance=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    return [find(x) for x in range(len(prints))]


def test_simhash(docs, rows):
    prints = [slow_print(t) for _, t in rows]
    group, least = slow_components(prints), {}
    for (k, _), g in zip(rows, group, strict=True):
        if k is not None:
            least[g] = min(k, least.get(g, k))
    want = sorted((str(k), f"{p:016x}", str(least.get(g))) for (k, _), p, g in zip(rows, prints, group, strict=True))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs(rows, extra=True)).collect())
    assert got == want


def five(text):
    w = [x.encode().lower().decode() for x in WORD.findall(text or "")]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return a == b if not a or not b else len(a & b) >= 0.8 * len(a | b) - 1e-9


def slow_classes(texts):
    """Smallest index of each text's class, by all pairs; and the pairs."""
    sets, root = [five(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [(a, b) for a in range(len(texts)) for b in range(a) if alike(sets[a], sets[b])]
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(texts))], links


def test_keep_one(docs, rows):
    rows = rows + [(5, rows[20][1]), (5, rows[1][1]), (0, "unlike " + prose(random.Random(1), 30))]  # copies and other texts of known ids
    group, _ = slow_classes([t for _, t in rows])
    best = {}
    for (k, t), g in zip(rows, group, strict=True):
        name = (k is None, k or 0, hashlib.sha256((t or "").encode()).hexdigest(), t is not None)
        if g not in best or name < best[g][0]:
            best[g] = (name, (str(k), t))
    kept = simhash.keep_one(docs(rows, extra=True))
    assert sorted(((str(r.doc_id), r.text) for r in kept.collect()), key=str) == sorted((x for _, x in best.values()), key=str)
    assert kept.columns == docs(rows, extra=True).columns


def test_recall_of_near_copies(docs):
    """Copies with every rate of changed words: at least 0.9 of the pairs at 0.8 or more are in one class, and no class is made by others."""
    r = random.Random(13)
    rows = []
    for group in range(60):
        base = prose(r, r.choice([15, 40, 120, 400]), 3000).split()
        for _ in range(r.randint(2, 6)):
            rate = r.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05])
            rows.append((len(rows), " ".join(f"n{r.randrange(10**6)}" if r.random() < rate else w for w in base)))
    large = prose(r, 150, 3000).split()
    rows += [(len(rows) + k, " ".join(large[:k] + [f"c{k}"] + large[k + 1 :])) for k in range(150)]
    texts = [t for _, t in rows]
    group, links = slow_classes(texts)
    name = {hashlib.sha256(t.encode()).hexdigest()[:32]: k for k, t in enumerate(texts)}
    found = {r.node: getattr(r, "class") for r in simhash.near_classes(docs(rows)).collect()}
    own = [found[hashlib.sha256(t.encode()).hexdigest()[:32]] for t in texts]
    caught = sum(own[a] == own[b] for a, b in links) / len(links)
    assert caught >= 0.98, caught
    assert all(group[name[node]] == group[name[c]] for node, c in found.items())
    assert len(simhash.keep_one(docs(rows)).collect()) <= 1.05 * len(set(group))


def test_ball_links_equal_all_pairs(spark):
    """Chains and clouds of fingerprints at distances around the limit."""
    r = random.Random(9)
    prints = {0, (1 << 64) - 1}
    for _ in range(30):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            prints.add(x)
            for b in r.sample(range(64), r.randint(1, 6)):
                x ^= 1 << b
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fingerprint long")
    links = [(np.int64(a).view(np.uint64).item(), np.int64(b).view(np.uint64).item()) for a, b in simhash.near_links(df).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    at = {p: k for k, p in enumerate(prints)}
    root = simhash._roots(len(prints), np.array([at[a] for a, _ in links]), np.array([at[b] for _, b in links]))
    want = slow_components(prints)
    assert len(set(zip(root.tolist(), want, strict=True))) == len(set(want)) == len(set(root.tolist()))


def test_links_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "HELD", 5000)
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, 20).astype(np.uint64)
    near = np.unique(np.concatenate([base, base ^ np.uint64(0b1011), base ^ np.uint64(1 << 50 | 1 << 3)]))
    a, b = simhash._links(near, np.full(len(near), 2), 64, 2)
    root = simhash._roots(len(near), a, b).tolist()
    want = slow_components([int(x) for x in near])
    assert len(set(zip(root, want, strict=True))) == len(set(want)) == len(set(root))


def test_decontamination(spark, docs, rows):
    r = random.Random(11)
    texts = [prose(r, n) for n in (3, 5, 6, 20, 35, 80, 300)]
    items = [(k, t) for k, t in enumerate(texts)] + [(7, None), (8, ""), (9, "..."), (None, "w1 w2 w3 w4 w5"), (10, texts[3].upper()), (11, rows[45][1])]
    held = rows + [(100 + k, f"{prose(r, 50)}, {t.title()}! {prose(r, 50)}") for k, t in enumerate(texts)]
    words = texts[4].split()
    held += [(200, " ".join(words[:31])), (201, " ".join(words[:29])), (202, texts[0]), (203, prose(r, 9000) + " " + texts[6])]

    def shingles(t):
        w = re.sub(r"[\x00-\x20!-/:-@\[-`{-~]+", " ", (t or "")).encode().lower().decode().split(" ")
        w = [x for x in w if x]
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    want = set()
    for n, (k, t) in enumerate(held):
        own = shingles(t)
        want |= {(n, str(k), i) for i, x in items if i is not None and shingles(x) and len(shingles(x) & own) >= 0.8 * len(shingles(x)) - 1e-9}
    df = docs(held, extra=True)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = [(str(x.doc_id), i.item_id) for x in decontaminate.find_items(df, table, "leaks").collect() for i in x._leaks]
    assert sorted(got) == sorted((k, i) for _, k, i in want) and len(got) > 10
    left = decontaminate.decontaminate(df, table)
    assert left.count() == len(held) - len({n for n, _, _ in want}) and left.columns == df.columns


def test_decontamination_in_blocks(spark, docs, monkeypatch):
    r = random.Random(2)
    items = [(k, prose(r, 30)) for k in range(9)]
    df = docs([(k, t + " " + prose(r, 40)) for k, t in items])
    monkeypatch.setattr(decontaminate, "BLOCK", 70)
    got = decontaminate.find_items(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((x.doc_id, [i.item_id for i in x.leaks]) for x in got) == [(k, [k]) for k in range(9)]


def test_empty(spark, docs):
    none, items = docs([]), spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.digests(none).count() == line_dedup.digests(none).count() == simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == decontaminate.decontaminate(none, items).count() == 0
    assert decontaminate.decontaminate(docs([(1, "a b c d e f")]), items).count() == 1


def test_variants_of_a_bucket_take_little_memory():
    """2,000 fingerprints with 3.4 million variants took 94 MB at a time before."""
    import tracemalloc

    own = np.unique(np.random.default_rng(1).integers(0, 2**63, 2000, dtype=np.uint64))
    own = np.unique(np.concatenate([own, own[:50] ^ np.uint64(5)]))
    tracemalloc.start()
    a, b = simhash._links(own, np.full(len(own), 2), 58, 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    near = {(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if int(own[i] ^ own[j]).bit_count() <= 4}
    assert len(near) >= 50 and most < 60 << 20
