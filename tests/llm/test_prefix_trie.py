"""op12 against a straight restatement on small tables."""

import collections
import hashlib
import random
import zlib

from pyspark.sql import functions as F

from clanweave.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth string, rep string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def nodes_of(sequences):
    """Rows of every node, from the sequence of turns (role, text) of each conversation."""
    members = collections.defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append((c, len(seq) == d))
    children = collections.Counter(p[:-1] for p in members if p)
    saved, leaves = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for k in range(len(p) + 1):
            saved[p[:k]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:k]] += p not in children
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c, end in m if end)))
        parent = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(m)[0], len(p), parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in by.items()}
    held = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: held[c]] + seq[held[c] :] for c, seq in own.items()}


def test_rebuilt(spark):
    r = random.Random(4)
    rows = []
    for c in r.sample(range(60), 45):
        rows += [(c, t if t else None, "user" if t % 2 == 0 else "assistant", f"hello é {r.randrange(2)}" if t < 3 else f"t{r.randrange(9)}") for t in range(r.randint(1, 12))]
    rows += [(70, None, None, None), (71, 5, None, "x"), (None, 1, "user", "no id"), (72, 1, "user", ""), (73, 1, "user", "same"), (73, 1, "user", "same")]
    rows += [(k, t, "user", "copy") for k in range(75, 95, 5) for t in range(4)]
    got = sorted((tuple(x) for x in T.rebuilt_trie(table_of(spark, rows)).collect()), key=str)
    assert got == nodes_of(rebuilt(rows))


def test_shapes(spark):
    """Growing copies of one conversation, a comb, a long one that many share the start of, equal ones, ends inside edges."""
    r = random.Random(7)
    long = [("u", f"turn {k}") for k in range(200)]
    seqs = {k: long[:k] for k in range(0, 40, 3)}
    seqs |= {100 + k: [*long[: 5 * k], ("u", "off"), ("u", f"tail {k % 3}")] for k in range(20)}
    seqs |= {200 + k: long for k in range(5)} | {300 + k: [("u", str(r.randrange(3))) for _ in range(r.randint(0, 9))] for k in range(60)}
    seqs |= {400: [("u", "ab")], 401: [("ua", "b")], 402: [("u", "a"), ("", "b")]}
    turns = [(c, d + 1, *x) for c, seq in seqs.items() for d, x in enumerate(seq)]
    df = spark.createDataFrame(turns, "conv_id long, depth long, role string, text string").repartition(4)
    df = df.select("conv_id", "depth", F.xxhash64("role", "text").alias("a"), F.xxhash64("text", "role", F.lit(1)).alias("b"), F.octet_length("text").cast("long").alias("bytes"))
    convs = spark.createDataFrame([(c,) for c in seqs], "conv_id long")
    got = sorted((tuple(x) for x in T.nodes(convs, df).collect()), key=str)
    assert got == nodes_of(seqs)


def test_no_turns(spark):
    assert T.rebuilt_trie(table_of(spark, [])).count() == 0
    alone = T.rebuilt_trie(table_of(spark, [(1, 0, "user", "h is 4 and there is no conversation 0")]))
    assert [tuple(x) for x in alone.collect()] == nodes_of({1: []}) == nodes_of(rebuilt([(1, 0, "user", "x")]))


def test_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "lo long, hi long").select("lo", "hi", T.fattest("lo", "hi").alias("f"))
    assert all(x.f == max(range(x.lo + 1, x.hi + 1), key=lambda n: n & -n) for x in df.collect())


def test_id_lists_in_pieces(spark):
    rows = [(7, 2, k) for k in range(T.PIECE + 10)] + [(7, 3, 5), (8, 2, -1), (8, 2, 10)]
    got = {(x.rep, x.depth): x.sha for x in T._id_lists(spark.createDataFrame(rows, "rep long, depth long, conv_id long").repartition(5)).collect()}
    want = collections.defaultdict(list)
    for rep, depth, c in rows:
        want[rep, depth].append(str(c))
    assert got == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}
