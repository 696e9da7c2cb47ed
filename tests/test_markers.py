import math
import random

import pytest
from pyspark.sql import functions as F

from clanweave.operators import abundance as B
from clanweave.operators import markers as M
from clanweave.operators import similarity as Y

HIT = "query string, subject string, pid double, alen int, qstart int, qend int, qlen int"


def test_counts_and_true_markers(spark, rows):
    seqs = spark.createDataFrame([("F", "ABCDEFGHIXKLMNOP"), ("G", "ABCDEFGH")], "family string, seq string")
    hits = spark.createDataFrame([("F", "G", 95.0, 3, 4, 6, 16), ("F", "G", 95.0, 3, 5, 7, 16), ("F", "F", 99.0, 3, 1, 3, 16), ("F", "G", 80.0, 3, 1, 3, 16), ("F", "H", 95.0, 16, 1, 16, 16)], HIT)
    c = M.overlap_counts(seqs, [(hits, 0.9, 3, 0.9)])
    assert [n for _, _, n in rows(c.where("family = 'F'"))] == [0, 0, 0, 1, 2, 2, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    assert [n for _, _, n in rows(c.where("family = 'G'"))] == [0] * 8
    masked = M.mask_ambiguous(c, seqs)
    assert masked.where("family = 'F' and pos = 10").first()["n"] == M.MASK
    tm = M.true_markers(masked, seqs, min_len=3, max_total=8)
    assert rows(tm, "family", "ordinal", "start", "end", "seq") == [("F", 1, 1, 3, "ABC"), ("F", 2, 11, 15, "KLMNO"), ("G", 1, 1, 8, "ABCDEFGH")]


def junction(seq, hits, m, short, limit):
    """Straight restatement: residues are 1-based, a hit blocks a window that lies inside it, also shifted by one."""
    n, start, out = len(seq), 1, []
    if n < m:
        return out
    within = lambda a, b: any(s <= a and b <= e for s, e in hits)
    while start + short - 1 < n:
        end = start + short - 1
        bad = seq[start - 1 : end].count("X") > limit or within(start, end) or (start > 2 and within(start - 1, end - 1)) or (end + 1 <= n and within(start, end + 1))
        if bad:
            start += 1
            continue
        a, b = start, end
        grew = 0
        while b < n and b - a + 1 <= m and seq[a - 1 : b].count("X") < limit:
            b += 1
            grew += 1
        if b - a + 1 < m:
            while a > 1 and b - a + 1 <= m and seq[a - 1 : b].count("X") < limit:
                a -= 1
        out.append((a, b))
        start = a + m
    best = sorted(out, key=lambda t: t[0] - t[1])[:3]
    return [t for t in best if t[1] - t[0] + 1 >= short * 1.1]


@pytest.mark.parametrize("seed", range(3))
def test_junction_markers_brute_force(spark, seed):
    rng = random.Random(seed)
    seqs, hits, want = [], [], {}
    for i in range(12):
        seq = "".join(rng.choice("ACDEFGHIKX") for _ in range(rng.randrange(15, 80)))
        spans = [(s, min(s + rng.randrange(3, 25), len(seq))) for s in (rng.randrange(1, len(seq)) for _ in range(rng.randrange(0, 8)))]
        seqs.append((f"F{i}", seq))
        hits += [(f"F{i}", "S", 99.0, 9, a, b, len(seq)) for a, b in spans]
        want[f"F{i}"] = junction(seq, spans, 20, 8, 3)
    s = spark.createDataFrame(seqs, "family string, seq string")
    h = spark.createDataFrame(hits, HIT)
    got = {}
    for r in M.junction_markers(s, h, marker_len=20, short=8, x_limit=3).orderBy("family", "ordinal").collect():
        got.setdefault(r["family"], []).append((r["start"], r["end"]))
    assert got == {k: v for k, v in want.items() if v}


def test_quasi_markers(spark):
    n = [16, 16, 16, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 16, 81, 81, 81, 81]
    seq = "ACDEFGHIKLMNPQRSTVWY"
    c = spark.createDataFrame([("F", i + 1, x) for i, x in enumerate(n)], "family string, pos int, n long")
    s = spark.createDataFrame([("F", seq)], "family string, seq string")
    r = M.quasi_markers(c, s, window=12, threshold=5.0, max_total=15).first()
    # best window is positions 4-15 (sum 1); growing right takes 16 (sum 3), 17 would give 6; left takes nothing once stopped
    assert (r["start"], r["end"], r["seq"], r["quasi"]) == (4, 16, seq[3:16], 3)


def test_quasi_markers_of_spans(spark, rows):
    """Spans give what positions give, and no row per position is gathered."""
    rng = random.Random(9)
    seqs = spark.createDataFrame([(f"F{i}", "".join(rng.choice("ACDEFGHIK") for _ in range(rng.randrange(1, 90)))) for i in range(40)] + [("E", ""), ("N", None)], "family string, seq string")
    some = lambda: (f"F{rng.randrange(40)}", "S", 95.0, 12, rng.randrange(1, 60), rng.randrange(40, 110), 90)
    hits = spark.createDataFrame([h for h in (some() for _ in range(400)) if h[4] <= h[5]] + [("F1", "S", 95.0, 12, None, 9, 90)], HIT)
    sources = [(hits, 0.9, 10, 1.0)]
    spans = M.overlap_counts(seqs, sources, spans=True)
    each = M.overlap_counts(seqs, sources)
    assert rows(M.quasi_markers(spans, seqs, 14, 20.5, 25)) == rows(M.quasi_markers(each, seqs, 14, 20.5, 25))
    assert rows(M.true_markers(spans, seqs, 3, 20)) == rows(M.true_markers(each, seqs, 3, 20))
    assert "Generate explode(sequence" not in M.quasi_markers(spans, seqs)._jdf.queryExecution().executedPlan().toString()
    long = spark.createDataFrame([("L", "A" * 5000)], "family string, seq string")
    assert M.overlap_counts(long, sources, spans=True).count() == 1


def quasi(n, seq, size, threshold, most):
    """Straight restatement: widen by single residues."""
    root = [x ** 0.25 for x in n]
    length = len(n)
    a = min(range(max(length - size, 0) + 1), key=lambda i: (round(sum(root[i : i + size]), 9), i))
    b = a + size
    held = False
    for e in range(b + 1, len(seq)):
        if min(e, length) - a >= most:
            break
        if sum(root[a:e]) > threshold:
            held = True
            break
        b = e
    if not held:
        for i in range(a - 1, -1, -1):
            if min(b, length) - i > most or sum(root[i:b]) > threshold:
                break
            a = i
    return a + 1, min(b, length), int(sum(root[a:b]) + 1e-9)


def test_quasi_markers_brute_force(spark):
    rng = random.Random(4)
    seqs, counts, want = [], [], {}
    for i in range(60):
        seq = "".join(rng.choice("ACDEFGHIK") for _ in range(rng.randrange(5, 60)))
        n = [rng.choice([0, 0, 1, 16, 81, 256, 625]) for _ in seq]
        seqs.append((f"F{i}", seq))
        counts += [(f"F{i}", k + 1, x) for k, x in enumerate(n)]
        want[f"F{i}"] = quasi(n, seq, 14, 20.5, 25)
    c, s = spark.createDataFrame(counts, "family string, pos int, n long"), spark.createDataFrame(seqs, "family string, seq string")
    got = {r["family"]: (r["start"], r["end"], r["quasi"]) for r in M.quasi_markers(c, s, window=14, threshold=20.5, max_total=25).collect()}
    assert got == want


def test_weights_and_checks(spark, rows):
    mk = spark.createDataFrame([("m", "F", 5, 14)], "marker string, family string, start int, end int")
    h = spark.createDataFrame([("F", "a", 1.0, 9, 1, 6, 20), ("F", "b", 1.0, 9, 1, 20, 20), ("F", "c", 1.0, 9, 15, 20, 20)], HIT)
    w = {r["subject"]: (r["overlap"], round(r["weight"], 4)) for r in M.marker_weights(mk, h).collect()}
    assert w == {"a": (2, round(2 / 22, 4)), "b": (10, round(10 / 22, 4)), "F": (10, round(10 / 22, 4))}
    ids = spark.createDataFrame([("ok",), ("a:b",), ("dup",), ("dup",), ("x_TM",)], "id string")
    assert rows(M.validate_marker_ids(ids)) == [("a:b", "bad character"), ("dup", "duplicate"), ("x_TM", "reserved")]


def test_hit_rules(spark, rows):
    markers = spark.createDataFrame([("F_TM_#01", "F", "TM", 10), ("F_TM_#02", "F", "TM", 10), ("F_TM_#03", "F", "TM", 10)], "marker string, family string, type string, marker_len int")
    hits = spark.createDataFrame(
        [("s", "r1", "F_TM_#01", 96.0, 10, 100), ("s", "r2", "F_TM_#01", 96.0, 9, 100), ("s", "r3", "F_TM_#02", 96.0, 10, 100), ("s", "r4", "F_TM_#02", 90.0, 10, 100), ("s", "r5", "F_TM_#02", 99.0, 10, 0)],
        "sample string, read_id string, marker string, pid double, alen int, read_len int",
    )
    v = B.valid_hits(hits, markers)
    assert rows(v, "read_id") == [("r1",), ("r3",)]
    totals = spark.createDataFrame([("s", 1000)], "sample string, reads long")
    c = B.marker_counts(v, totals)
    assert all(math.isclose(r["norm"], 1 / 69 / (1000 / 1e9)) for r in c.collect())
    f = B.family_abundance(c, markers).first()
    assert math.isclose(f["median"], 1 / 69 * 1e6) and math.isclose(f["mean"], 2 / 69 / 3 * 1e6)
    one = B.family_abundance(c.where("marker = 'F_TM_#01'"), markers).first()
    assert one["median"] == 0.0 and one["hits"] == 1 and one["marker_length"] == 30


def test_normalisation(spark, rows):
    d = spark.createDataFrame([("s", "1", "P", 0.0), ("s", "1", "Q", 0.0), ("t", "1", "P", 3.0), ("t", "2", "Q", 1.0)], "sample string, cluster string, protein string, value double")
    assert rows(B.sum_normalize(d), "sample", "protein", "value") == [("s", "P", 0.0), ("s", "Q", 0.0), ("t", "P", 0.75), ("t", "Q", 0.25)]
    size = spark.createDataFrame([("t", 2e6)], "sample string, size double")
    assert [round(x[0], 9) for x in rows(B.genome_size_normalize(d, size).where("protein = 'P'"), "value")] == [0.0, 0.006]
    assert rows(B.samples_without_size(d, size)) == [("s",)]
    runs = spark.createDataFrame([(1, True, "s", "P", 1.0), (2, True, "s", "P", 2.0), (3, False, "s", "P", 3.0)], "run int, completed boolean, sample string, protein string, value double")
    assert rows(B.merge_runs(runs, ["protein"])) == [("s", "P", 2.0)]
    assert rows(B.merge_runs(runs, ["protein"], force=[3])) == [("s", "P", 3.0)]


def greedy(lens, edges):
    order = sorted(lens, key=lambda i: (-lens[i], i))
    reps, owner = [], {}
    for i in order:
        hit = [r for r in reps if (r, i) in edges or (i, r) in edges]
        if hit:
            owner[i] = hit[0]
        else:
            reps.append(i)
            owner[i] = i
    return owner


@pytest.mark.parametrize("seed", range(3))
def test_representatives_equal_sequential_greedy(spark, seed):
    rng = random.Random(seed)
    lens = {f"s{i:02d}": rng.randrange(20, 40) for i in range(40)}
    seqs = {i: "".join(rng.choice("ACDE") for _ in range(n)) for i, n in lens.items()}
    pairs = {tuple(sorted(rng.sample(sorted(lens), 2))) for _ in range(50)}
    e = spark.createDataFrame([(a, b, 95.0, min(lens[a], lens[b]), lens[a], lens[b]) for a, b in pairs], "src string, dst string, pid double, alen int, src_len int, dst_len int")
    s = spark.createDataFrame(list(seqs.items()) + [("zz", seqs["s07"])], "id string, seq string")
    want = greedy(lens, pairs)
    want["zz"] = want["s07"]
    got = {r["member"]: r["rep"] for r in Y.representatives(s, 0.9, 0.0, e).collect()}
    assert got == want


def test_thresholds_share_rounds_and_equal_single_ones(spark):
    rng = random.Random(11)
    lens = {f"s{i:02d}": rng.randrange(20, 40) for i in range(40)}
    seqs = {i: "".join(rng.choice("ACDE") for _ in range(n)) for i, n in lens.items()}
    pairs = {tuple(sorted(rng.sample(sorted(lens), 2))): rng.choice([40.0, 55.0, 70.0, 95.0]) for _ in range(80)}
    e = spark.createDataFrame([(a, b, p, min(lens[a], lens[b]), lens[a], lens[b]) for (a, b), p in pairs.items()], "src string, dst string, pid double, alen int, src_len int, dst_len int")
    s = spark.createDataFrame(list(seqs.items()) + [("zz", seqs["s07"])], "id string, seq string")
    got = {}
    for r in Y.representatives_at(s, [(p, 1.0 if p == 100 else 0.0) for p in range(40, 101, 5)], e).collect():
        got.setdefault(r["identity"], {})[r["member"]] = r["rep"]
    assert sorted(got) == [float(p) for p in range(40, 101, 5)]
    for p, owners in got.items():
        want = greedy(lens, {pair for pair, pid in pairs.items() if pid >= p})
        want["zz"] = want["s07"]
        assert owners == want
    assert Y.representatives_at(s.limit(0), [(50, 0.0), (90, 0.0)], e.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [3, 1024])
def test_segment_links_equal_all_pairs(spark, monkeypatch, cell):
    """Copies, ties, short, empty and null sequences; a segment that many hold is split into cells."""
    monkeypatch.setattr(Y, "CELL", cell)
    rng = random.Random(5)

    def change(seq, n):
        at = rng.sample(range(len(seq)), min(n, len(seq)))
        return "".join(rng.choice("ACDEéX") if i in at else c for i, c in enumerate(seq))

    roots = ["".join(rng.choice("ACDE") for _ in range(n)) for n in (1, 4, 9, 10, 11, 20, 33, 33, 60)]
    seqs = [(f"m{i:03d}", change(rng.choice(roots), rng.randrange(7))) for i in range(150)] + [("n", None), ("o", ""), ("p", "")]
    df = spark.createDataFrame(seqs, "id string, seq string").repartition(3)
    unique = {seq: min(n for n, other in seqs if other == seq) for _, seq in seqs if seq}
    lens = {name: len(seq) for seq, name in unique.items()}
    for identity in (0.9, 0.8, 0.5):
        want = {}
        for x, a in unique.items():
            for y, b in unique.items():
                same = sum(c == d for c, d in zip(x, y))
                if a < b and len(x) == len(y) and same * 100.0 / len(x) >= identity * 100:
                    want[a, b] = same
        links = Y.segment_links(df, identity)
        assert {(r["src"], r["dst"]): r["matches"] for r in links.collect()} == want and len(want) > 20
    markers = df.where("seq <> ''").withColumnRenamed("id", "marker")
    near = {pair for pair, same in want.items() if same * 100.0 / lens[pair[0]] >= 90.0}
    owner = greedy(lens, near)
    got = {r["marker"]: r["rep"] for r in M.cluster_markers(markers, 0.9).collect()}
    assert got == {n: owner[unique[seq]] for n, seq in seqs if seq}


def test_search_links_copies(spark):
    rng = random.Random(2)
    base = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(200))
    near = base[:50] + "W" + base[51:]
    other = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(180))
    s = spark.createDataFrame([("a", base), ("b", near), ("c", base), ("d", other), ("e", base[20:150])], "id string, seq string")
    e = {(r["src"], r["dst"]): r for r in Y.pairwise_similarity(s, 6, 3).collect()}
    assert set(e) == {("b", "a"), ("e", "a"), ("e", "b")}
    assert e[("e", "a")]["pid"] == 100.0 and e[("e", "a")]["alen"] == 130
    assert e[("b", "a")]["alen"] == 200 and 99.0 < e[("b", "a")]["pid"] < 100.0
    q = spark.createDataFrame([("q", base[10:60])], "id string, seq string")
    assert {r["dst"] for r in Y.search_query(q, s, 6, 3).collect()} == {"a", "b", "c", "e"}


def test_small_families_are_complete(spark):
    """A sequence and its prefixes share k-mers pairwise."""
    rng = random.Random(6)
    base = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(200))
    s = spark.createDataFrame([(f"p{n}", base[:n]) for n in (200, 199, 198, 197)], "id string, seq string")
    assert Y.pairwise_similarity(s, 8, 2).count() == 6


def pairs_by_diagonal(seqs, k, least):
    """Every pair that shares enough k-mers on a diagonal: (shared, diagonal) of the best one, by all pairs of holders of each k-mer."""
    places, votes, best = {}, {}, {}
    for name, seq in seqs:
        first = {}
        for p in range(len(seq) - k + 1):
            first.setdefault(seq[p : p + k], p)
        for word, p in first.items():
            places.setdefault(word, []).append((name, p))
    for held in places.values():
        for i, (a, p) in enumerate(held):
            for b, q in held[:i]:
                key = (a, b, p - q) if a < b else (b, a, q - p)
                votes[key] = votes.get(key, 0) + 1
    for (a, b, _), n in votes.items():
        if n >= least:
            best[a, b] = max(n, best.get((a, b), 0))
    return best


@pytest.mark.parametrize(("least", "cell"), [(1, 1024), (4, 3), (12, 1024)])
def test_search_is_exact(spark, monkeypatch, least, cell):
    """Common words, passages that many hold, nested and shifted copies; blocks of many sequences are split into cells."""
    monkeypatch.setattr(Y, "CELL", cell)
    rng = random.Random(least)
    letters = lambda n: "".join(rng.choice("ACDE") for _ in range(n))
    passages = [letters(n) for n in (8, 15, 40)]
    seqs = [(f"s{i:02d}", "".join(rng.choice([letters(rng.randrange(12)), rng.choice(passages)]) for _ in range(rng.randrange(1, 7)))) for i in range(60)]
    seqs += [(f"t{i:02d}", seqs[7][1][i:] + letters(5)) for i in range(6)] + [("u", seqs[3][1]), ("v", ""), ("w", "AC")]
    df = spark.createDataFrame(seqs, "id string, seq string").repartition(3)
    got = {tuple(sorted((r["src"], r["dst"]))): r["shared"] for r in Y.pairwise_similarity(df, 6, least).collect()}
    unique = [(min(n for n, other in seqs if other == seq), seq) for seq in {seq for _, seq in seqs}]
    assert got == pairs_by_diagonal(unique, 6, least) and len(got) > 50


def test_search_finds_all_pairs_of_the_documents(spark):
    seqs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").cast("string").alias("id"), F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"))
    found = {tuple(sorted((r["src"], r["dst"]))): r["shared"] for r in Y.pairwise_similarity(seqs, 12, 4).select("src", "dst", "shared").collect()}
    assert found == pairs_by_diagonal([(r["id"], r["seq"]) for r in Y.unique_sequences(seqs).collect()], 12, 4)


def test_best_hits(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("ACDEFGHIKL") for _ in range(300))
    s = spark.createDataFrame([(f"s{i:02d}", base[i : i + 100]) for i in range(40)], "id string, seq string")
    q = spark.createDataFrame([("a", base[10:60]), ("b", base[80:120]), ("c", "W" * 30)], "id string, seq string")
    every = [tuple(r) for r in Y.search_queries(q, s, 6, 2).select("src", "dst", "bitscore").collect()]
    want = sorted((src, dst) for name in "abc" for src, dst, _ in sorted((h for h in every if h[0] == name), key=lambda h: (-h[2], h[1]))[:4])
    assert sorted((r["src"], r["dst"]) for r in Y.search_queries(q, s, 6, 2, max_hits=4).collect()) == want and len(want) == 8


def test_consensus(spark, rows):
    a = spark.createDataFrame([("F", "ABC"), ("F", "ABD"), ("F", "ABE")], "family string, seq string")
    assert rows(Y.consensus(a, 0.95)) == [("F", "ABX")]
    assert a.agg(F.count("seq")).first()[0] == 3


def test_letters_of_any_width_are_compared(spark, rows):
    word = "ACDEFGHIKLMNPQRSTVWY" * 2
    seqs = [("a", word + "\u0394" * 6), ("b", word + "\u0394" * 5 + "\u0395"), ("c", "MM" + word + "\u00e9"), ("d", word)]
    got = rows(Y.pairwise_similarity(spark.createDataFrame(seqs, "id string, seq string"), 8, 4), "src", "dst", "alen", "pid")
    close = lambda a, b: [x[:3] for x in a] == [x[:3] for x in b] and all(abs(x[3] - y[3]) < 1e-9 for x, y in zip(a, b))
    assert close(got, sorted([("b", "a", 46, 4500 / 46), ("c", "a", 41, 4000 / 41), ("c", "b", 41, 4000 / 41), ("d", "a", 40, 100.0), ("d", "b", 40, 100.0), ("d", "c", 40, 100.0)]))
    assert Y._points(word).nbytes == 40 and Y._points(word + "\u0394").nbytes == 164
