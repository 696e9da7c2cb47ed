"""op11 against a straight restatement on small tables."""

import hashlib
import math
import random
import re

import xxhash

from clanweave.llm import fingerprints as P


def chained(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed=seed)
    return seed


def slow_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    units, width = words, 3
    if words and (len(words) < 12 or len(text) > 24 * len(words)):
        units, width = list(" ".join(words)), 5
    found = {}
    for i in range(max(len(units) - width, 0) + 1 if units else 0):
        term = units[i : i + width]
        weight = min(63, sum(map(len, term)))
        packed = chained([t.encode() for t in term]) & ~63 | weight
        found[packed] = weight
    votes, every = [0] * 64, sum(found.values())
    for packed, weight in found.items():
        h = xxhash.xxh64_intdigest(packed.to_bytes(8, "little"), seed=42)
        for b in range(64):
            votes[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > every)


def key(text):
    h = (xxhash.xxh64_intdigest(text.encode(), seed=42) << 1) & (1 << 64) - 1
    return h - (1 << 64) if h >> 63 else h


def test_documents(docs):
    r = random.Random(3)
    prose = lambda n: " ".join(f"w{r.randrange(300)}" for _ in range(n))
    rows = [(k, prose(r.randint(0, 60))) for k in range(50)]
    base = prose(80)
    rows += [(k, base) for k in range(50, 56)] + [(60, base + " tail"), (61, base.replace("w1", "w2", 1)), (80, base.upper())]
    rows += [(62, ""), (63, None), (64, " \n\t"), (65, "x" * 5000), (66, prose(6000)), (67, "Ünï çödé 漢字" * 3), (68, "one"), (-20, "negative id " + base)]
    rows += [(7, "another text of a repeated id"), (7, rows[7][1]), (7, rows[7][1]), (None, base), (None, None), (None, None)]
    full = [(k, t or "") for k, t in rows]
    ordered = sorted(full, key=lambda x: (x[0] is None, -(x[0] or 0), key(x[1]) | (x[0] is None)))
    prints = [slow_print(t) for _, t in ordered]
    like = lambda a, b: max(0.0, round(math.cos((a ^ b).bit_count() * math.pi / 64), 12))
    want = []
    for i, (k, t) in enumerate(ordered):
        j = (i + 1) % len(ordered)
        third = len(t) // 3
        edited = t[: len(t) - third] + ordered[j][1][:third]
        near = [ordered[m][0] for m in range(len(ordered)) if (prints[m] ^ prints[i]).bit_count() <= 3]
        asked = k is not None and k % 20 == 0
        e = slow_print(edited)
        want.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{prints[i]:016x}", f"{e:016x}", like(prints[i], e), like(prints[i], prints[j]),
                     len(near) - 1 if asked else None, min(x for x in near if x is not None) if asked else None))
    got = [tuple(x) for x in P.fingerprint_documents(docs(rows, extra=True)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and max(x[7] or 0 for x in got) >= 7


def test_tables_find_all(spark):
    """Every pair within the radius meets, at several numbers of blocks; pairs are reported once."""
    r = random.Random(8)
    held = {0, (1 << 64) - 1}
    for _ in range(60):
        x = r.getrandbits(64)
        held.add(x)
        for _ in range(6):
            y = x
            for b in r.sample(range(64), r.randint(1, 5)):
                y ^= 1 << b
            held.add(y)
    held = sorted(held)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints = spark.createDataFrame([(signed(x),) for x in held], "fingerprint long")
    queries = spark.createDataFrame([(signed(x),) for x in held[::3]], "fingerprint long")
    for n in (1, 1 << 20, 1 << 30, 1 << 40):
        tables = P.block_tables(n)
        assert len(tables) == len(set(tables)) and min(t.bit_count() for t in tables) >= min(math.log2(max(2, n)), 16) - 1
        got = sorted((x.query, x.found) for x in P.search(queries, prints, 3, tables).collect())
        assert got == sorted((signed(a), signed(b)) for a in held[::3] for b in held if (a ^ b).bit_count() <= 3)
    assert len(got) > len(held[::3])


def test_few_rows(docs):
    assert P.fingerprint_documents(docs([])).count() == 0
    only = P.fingerprint_documents(docs([(4, "a b c d e f g h i j k l m n o p")])).first()
    assert only.near_next == 1.0 and only.n_near is None
    assert P.fingerprints(docs([(1, "a"), (1, "a"), (None, "a")])).select("fingerprint").distinct().count() == 1
