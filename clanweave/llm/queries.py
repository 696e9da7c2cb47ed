"""The registered queries of this subpackage: thin forms over the whole tables, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clanweave.llm import counts, decontaminate, fingerprints, hard_negatives, id_store, line_dedup, pii, prefix_trie, quality, secrets, simhash, spm, substring_dedup
from clanweave.llm.common import table

QUERIES, ORACLE = {}, {}


def tokenizer(name: str) -> str:
    """A public vocabulary file; the folder may be set by ``CLANWEAVE_TOKENIZERS``."""
    folder = os.environ.get("CLANWEAVE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PUNCT = "regexp_replace({}, '[\\x09-\\x0D\\x20-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]+', ' ', 'g')"
WORDS = "list_filter(string_split_regex(coalesce({}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "op1_benchmark_decontamination",
    f"""
    with words as (
      select 0 as side, doc_id as id, {WORDS.format(PUNCT.format(LOWER.format("text")))} as w from documents
      union all select 1, item_id, {WORDS.format(PUNCT.format(LOWER.format("text")))} from benchmark),
    shingles as (
      select distinct side, id, array_to_string(w[i : i + 4], ' ') as s
      from (select side, id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0)),
    sizes as (select id, count(*) as n from shingles where side = 1 group by id),
    found as (
      select d.id as doc_id, i.id as item_id, count(*) as k
      from shingles d join shingles i on d.side = 0 and i.side = 1 and d.s = i.s group by d.id, i.id),
    leaks as (select doc_id, item_id, k::double / n as containment from found join sizes on item_id = sizes.id where k >= 0.8 * n)
    select doc_id, item_id, containment from leaks""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("leaks"))


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    wanted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    return judged.select("doc_id", *[F.col(f"verdict.{n}").alias(n) for n in wanted])


@query("op3_private_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


@query("op4_id_store")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_store.store_digests(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)


@query("op5_sentencepiece")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode_documents(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), with_ids=False)


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), distance=4, width=4)


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


@query(
    "op8_substring_dedup",
    f"""
    with words as (select doc_id, {WORDS.format("text")} as w from documents),
    windows as (
      select doc_id, i, array_to_string(w[i : i + 12], ' ') as s
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) as i from words)),
    first as (select s, min(doc_id) as least from windows group by s having min(doc_id) <> max(doc_id)),
    hits as (select distinct doc_id, unnest(range(i, i + 13)) as i from windows join first using (s) where doc_id > least),
    placed as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words),
    kept as (
      select placed.doc_id, string_agg(word, ' ' order by placed.i) as t, count(*) as n
      from placed left join hits on placed.doc_id = hits.doc_id and placed.i = hits.i where hits.i is null group by placed.doc_id)
    select words.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
    from words left join kept on words.doc_id = kept.doc_id""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"), width=13)


@query(
    "op10_line_dedup",
    f"""
    with lines as (
      select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
      from documents),
    keyed as (select *, {LOWER.format(f"trim(line, {BLANK})")} as key from lines),
    frequent as (select key, max(doc_id) as stays from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
    judged as (select keyed.*, frequent.key is not null and doc_id <> stays as gone from keyed left join frequent using (key))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
    from judged group by doc_id""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)


@query("op11_document_fingerprints")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"), radius=3, every=20)


#: CRC-32 of an ASCII string, one bit a step.
_BYTE = "xor(crc, case when i % 8 = 0 then ascii(substr({0}, i // 8 + 1, 1)) else 0 end)"
CRC = f"xor(list_reduce(range(8 * length({{0}})), lambda crc, i: xor({_BYTE} >> 1, ({_BYTE} & 1) * 3988292384), 4294967295::bigint), 4294967295::bigint)"


@query(
    "op12_conversation_trie",
    f"""
    with own as (
      select conv_id as c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first) as l
      from conversations where conv_id is not null group by 1),
    held as (select c, l, {CRC.format("c::varchar")} % 9 as h from own),
    rebuilt as (
      select held.c, list_concat(coalesce(list_slice(base.l, 1, h), []), coalesce(list_slice(held.l, h + 1, len(held.l)), [])) as l
      from held left join own base on base.c = held.c - held.c % 5),
    places as (select c, l, unnest(range(0, len(l) + 1)) as d from rebuilt),
    node as (
      select list_slice(l, 1, d) as p, d, min(c) as conv_id, count(*) as n, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (len(l) = d), '')) as ends
      from places group by 1, 2),
    kids as (select list_slice(p, 1, d - 1) as p, d - 1 as d, count(*) as k from node where d > 0 group by 1, 2),
    sized as (select node.*, coalesce(k, 0) as k, case when d = 0 then 0 else (n - 1) * strlen(p[d].t) end as saved from node left join kids using (p, d)),
    upward as (select list_slice(p, 1, a) as p, a as d, sum((k = 0)::int) as leaves, sum(saved) as saved from (select *, unnest(range(0, d + 1)) as a from sized) group by 1, 2)
    select s.conv_id, s.d::bigint as depth, up.conv_id as parent_conv_id, s.n::bigint as n_convs, s.k::bigint as n_children, leaves::bigint as n_leaves,
      upward.saved::bigint as saved_tokens, s.ends as ends_sha256
    from sized s join upward using (p, d) left join node up on up.d = s.d - 1 and up.p = list_slice(s.p, 1, s.d - 1)""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


@query(
    "op13_hard_negatives",
    """
    with rows as (
      select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
      from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scores as (
      select a.vec_id as anchor_id, c.vec_id as id, a.label = c.label as same, list_inner_product(a.v, c.v)::bigint as score
      from rows a join rows c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id),
    positives as (
      select anchor_id, id as positive_id, score as positive_score
      from (select *, row_number() over (partition by anchor_id order by score desc, id) as r from scores where same) where r <= 5),
    negatives as (
      select p.*, s.id as negative_id, s.score as negative_score, row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.id) as rank
      from positives p join scores s on s.anchor_id = p.anchor_id and not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
    select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from negatives where rank <= 3""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 50 == 0)
