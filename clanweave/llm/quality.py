"""Quality rules: hashed n-gram log-likelihood ratio between trusted target and raw corpus. Columns only, no Python on rows.

Words and pairs of neighbouring words are hashed into ``buckets``. Two multinomials are estimated: one from all documents
(raw), one from at most ``TRUSTED`` of those that are labelled good (target; its counts stop growing there). A document's score is the sum over its n-grams of log(target / raw), divided by the
number of n-grams; a document is kept if it fails no base rule and its score reaches the threshold. Raw counts and verdicts cover all documents.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clanweave.llm.common import fresh

#: Hash buckets of the multinomials (bounds what is broadcast), counts added to each, least mean log-ratio that is kept.
#: Documents the target is fitted on at most; words of a window of the repetition rule.
BUCKETS, PRIOR, THRESHOLD, TRUSTED, WIDTH = 10_000, 1.0, -0.2, 20_000, 8
BLANKS = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def lowered(words: str) -> Column:
    """Hashes of the words, letter case ignored."""
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def grams_of(hashes: str, buckets: int) -> Column:
    """Bucket of every word and of every pair of neighbours."""
    ones = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    n = F.greatest(F.size(hashes) - 1, F.lit(0))
    twos = F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(2), n), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
    return F.concat(ones, twos)


def with_base_counts(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` and, in columns whose names start with ``_q_``, the counts of the base rules.

    Intermediate arrays are columns of their own, so that each is computed once.
    """
    size, lit = F.size, F.lit
    out = docs.withColumn("_q_text", F.coalesce(text, lit("")))
    out = out.withColumns({"_q_w": words_of(F.col("_q_text")), "_q_l": F.filter(F.split("_q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    out = out.withColumns({
        "_q_n_words": size("_q_w").cast("long"),
        "_q_word_chars": F.length(F.array_join("_q_w", "")).cast("long"),
        "_q_n_symbols": F.length(F.regexp_replace("_q_text", r"[^#*$%&|<>]+", "")).cast("long"),
        "_q_n_dup_lines": (size("_q_l") - size(F.array_distinct("_q_l"))).cast("long"),
        "_q_h": F.transform("_q_w", lambda w: F.xxhash64(w)),
    }).drop("_q_l")
    starts = F.when(size("_q_h") >= WIDTH, F.sequence(lit(1), size("_q_h") - (WIDTH - 1))).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("_q_win", F.transform(starts, lambda i: F.xxhash64(F.slice("_q_h", i, lit(WIDTH))))).drop("_q_h")
    # Only texts in which a window repeats go on: sorted by hash, a repeated window stands beside an equal one.
    some = F.when(size(F.array_distinct("_q_win")) < size("_q_win"), F.col("_q_win"))
    out = out.withColumn("_q_at", F.sort_array(F.transform(some, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).drop("_q_win")
    beside = F.zip_with(F.slice("_q_at", lit(1), size("_q_at") - 1), F.slice("_q_at", lit(2), size("_q_at") - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    out = out.withColumn("_q_at", F.sort_array(F.array_distinct(F.flatten(F.filter(beside, lambda x: x.isNotNull())))))
    # Each start covers as many words as lie before the next start, WIDTH at most.
    gaps = F.zip_with(F.slice("_q_at", lit(1), size("_q_at") - 1), F.slice("_q_at", lit(2), size("_q_at") - 1), lambda a, b: F.least(b - a, lit(WIDTH)))
    return out.withColumn("_q_n_repeat_words", F.coalesce(F.aggregate(gaps, lit(WIDTH), lambda s, x: s + x), lit(0)).cast("long")).drop("_q_at")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR, trusted: int = TRUSTED) -> list[float]:
    """log(target / raw) of every bucket. Raw counts are those of all documents; the target is fitted on at most ``trusted`` documents
    that are labelled quality 1 and not toxic, chosen by a hash of their id."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("_good")).dropna().distinct()
    good = good.orderBy(F.xxhash64("_good"), "_good").limit(trusted)  # bounded, so it may be broadcast
    words = docs.select(F.col("doc_id").cast("long").alias("_id"), words_of(F.col("text").cast("string")).alias("_w"))
    hashed = words.select("_id", lowered("_w").alias("_h")).select("_id", grams_of("_h", buckets).alias("_g"))
    marked = hashed.join(F.broadcast(good), F.col("_id") == F.col("_good"), "left").select(F.col("_good").isNotNull().alias("trusted"), F.explode("_g").alias("gram"))
    counts = marked.groupBy("gram").agg(F.count(F.lit(1)).alias("raw"), F.count_if("trusted").alias("target"))
    held = {r["gram"]: (r["raw"], r["target"]) for r in counts.collect()}  # at most ``buckets`` rows
    raw = sum(r for r, _ in held.values()) + prior * buckets
    target = sum(t for _, t in held.values()) + prior * buckets
    pairs = (held.get(b, (0, 0)) for b in range(buckets))
    return [math.log((t + prior) / target) - math.log((r + prior) / raw) for r, t in pairs]


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR, threshold: float = THRESHOLD, trusted: int = TRUSTED) -> DataFrame:
    """All columns of ``docs`` and a struct ``verdict`` (with underscores in front if taken).

    verdict: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept. ``base_failed`` is n_words < 20 or
    100 n_repeat_words > 30 n_words. The score of a text without words is null (it has failed anyway). Without a trusted document
    all scores follow from the prior alone. Repeated rows are judged each; a null doc_id is never trusted; null texts have no words.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    ratios = F.from_json(F.lit(json.dumps(log_ratios(docs, labels, buckets, prior, trusted))), "array<double>")
    row = fresh(docs, "verdict")
    held = docs.select(F.struct(*columns).alias("_q_row"))
    out = with_base_counts(held, F.col("_q_row.text").cast("string"))
    out = out.withColumn("_q_g", lowered("_q_w")).drop("_q_w").withColumn("_q_g", grams_of("_q_g", buckets))
    total = F.aggregate("_q_g", F.lit(0.0), lambda s, g: s + F.element_at(ratios, g + 1))
    out = out.withColumn("_q_score", F.when(F.size("_q_g") > 0, total / F.size("_q_g")))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = (F.col("_q_n_words") < 20) | (100 * F.col("_q_n_repeat_words") > 30 * F.col("_q_n_words"))
    out = out.withColumn("_q_failed", failed)
    kept = ~F.col("_q_failed") & (F.coalesce("_q_score", F.lit(float("-inf"))) >= threshold)
    verdict = F.struct(*[F.col(f"_q_{n}").alias(n) for n in counts], F.col("_q_failed").alias("base_failed"), F.col("_q_score").alias("score"), kept.alias("kept"))
    # The generator keeps a later filter on the verdict from being pushed below, where every count would be computed again.
    return out.select(F.explode(F.array(F.struct("_q_row", verdict.alias("_q_verdict")))).alias("_q")).select("_q._q_row.*", F.col("_q._q_verdict").alias(row))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept (see ``judge``), with the same columns."""
    row = fresh(docs, "verdict")
    return judge(docs, labels, **options).where(F.col(f"{row}.kept")).drop(row)
