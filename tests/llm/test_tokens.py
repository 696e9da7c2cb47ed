"""op4, op5 and op9 against their libraries."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clanweave.llm import counts, id_store, spm

ODD = ["", None, " ", "  \n\n ", "a", "don't I'LL\t<|endoftext|>x", "▁▁ ▁x", "漢字é\x00 ß\x1c\x85", "x" * 3000, " " * 70, "the 1,234.5!!! ##", "ẞİ ﬁ"]


def texts(seed=3):
    r = random.Random(seed)
    made = ["".join(r.choice("aehinorst .,\nÉñ3-") for _ in range(r.randint(0, 120))) for _ in range(60)]
    return ODD + made


@pytest.fixture
def table(docs):
    rows = list(enumerate(texts())) + [(None, "no id"), (None, None), (5, "again five"), (5, "again five")]
    return rows, docs(rows, extra=True)


def test_sentencepiece(table, pieces_file):
    rows, df = table
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in spm.encode_documents(df, pieces_file).collect())
    want = []
    for key, text in rows:
        ids = lib.encode(text or "", add_eos=True)
        want.append((str(key), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest(), tuple(ids)))
    assert got == sorted(want)


def test_backtracking_takes_entries_back(pieces_file):
    model, r = spm.Backtracker(pieces_file), random.Random(7)
    for _ in range(3000):
        text = "".join(r.choice("aehinrst▁") for _ in range(r.randint(1, 24)))
        assert model.pieces(text) == model.merge(text)


def test_counts(table, words_file):
    rows, df = table
    lib = Tokenizer.from_file(words_file)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in counts.count_tokens(df, words_file, limit=40).collect())
    want = []
    for key, text in rows:
        n = len(lib.encode(text or "", add_special_tokens=False).ids)
        want.append((str(key), len((text or "").encode()), n, n > 40))
    assert got == sorted(want)


def test_id_store(table, words_file):
    rows, df = table
    lib = Tokenizer.from_file(words_file)
    store = id_store.write_store(df, words_file)
    got = store.fetch(store.keys).collect()
    assert len(got) == len(rows) and len({(r.doc_id, r.copy) for r in got}) == len(rows)
    at, keys = 0, []
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        keys.append(-1 if r.doc_id is None else r.doc_id)
    assert keys == sorted(keys)
    want = sorted((str(k), zlib.crc32(np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())) for k, t in rows)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == want
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)


def test_unknown_keys_are_not_found(spark, docs, words_file):
    store = id_store.write_store(docs([(k, f"text {k}") for k in range(500)]), words_file)
    strange = spark.createDataFrame([(k, 0) for k in range(1000, 3000)] + [(7, 0), (7, 1)], "doc_id long, copy long")
    assert [(r.doc_id, r.copy) for r in store.fetch(strange).collect()] == [(7, 0)]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64))
    perfect = id_store.PerfectHash.build(keys)
    assert sorted(perfect.slots(keys).tolist()) == list(range(len(keys)))
    again, used = id_store.PerfectHash.read(raw := b"".join(perfect.chunks()))
    assert used == len(raw) and (again.slots(keys) == perfect.slots(keys)).all()


def test_one_id_over_many_shards(docs, words_file):
    store = id_store.write_store(docs([(1, f"word {k % 50}") for k in range(400)] + [(2, "x")]), words_file)
    assert sorted(r.copy for r in store.keys.where("doc_id = 1").collect()) == list(range(400))
    assert store.fetch(store.keys).count() == 401


def test_long_words(words_file):
    """Runs of one letter, random letters and unspaced scripts, around and far above the length that is merged in rounds."""
    r = random.Random(6)
    lib = Tokenizer.from_file(words_file)
    counter = counts.Counter(words_file)
    texts = [c * n for c in "a0é漢" for n in (1, 2, 3, 7, 511, 512, 513, 2000)]
    texts += ["".join(r.choices(letters, k=n)) for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "éàç", "漢字仮名交") for n in (30, 500, 520, 5000)]
    start = time.monotonic()
    texts.append("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)))
    assert counter.count([t.encode() for t in texts]) == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    assert time.monotonic() - start < 60


def test_empty(docs, words_file, pieces_file):
    none = docs([])
    assert id_store.store_digests(none, words_file).count() == 0
    assert counts.count_tokens(none, words_file).count() == 0
    assert spm.encode_documents(none, pieces_file).count() == 0


def test_words_are_encoded_together(monkeypatch):
    """One call of the library for many words, with each word's own ids; it was one entry a word before."""
    import numpy as np
    import public_tokenizers

    from clanweave.llm import id_store

    monkeypatch.setattr(id_store, "JOINED", 64)
    model = id_store.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["é", "́x", " ", " a", "\x1c", "x<|endoftext|>y", "it's9", "﻿", "中\U0001f600", "İ", "가"]
    words = [*(w.encode() for w in odd), *(f"word{k}".encode() for k in range(200))]
    asked = []

    class Library:
        def encode(self, text, **kwargs):
            asked.append(text)
            return library.encode(text, **kwargs)

        def encode_batch_fast(self, texts, **kwargs):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **kwargs)

    library, model.library = model.library, Library()
    found = model._encode(words)
    assert len(asked) == -(-len(words) // 64)
    assert found == [np.array(library.encode(w.decode(), add_special_tokens=False).ids, model.kind).tobytes() for w in words]


def test_plain_texts_are_encoded_by_pieces(words_file):
    model = id_store.WordEncoder(words_file)
    rng = random.Random(5)
    letters = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(0xC0, 0x100)]]
    texts = ["".join(rng.choices(letters, k=60)) for _ in range(300)] + ["Don't THEY'RE they're 'S ''s a1b22 É", "", " ", "it's<|endoftext|>x <|ENDOFTEXT|>", "a\x00b\x1cc\x7f", "éé ²½ ǅ İ  x y 東京", "ÀÉÎÕÜ ×÷ ß"]
    for text in texts:
        assert np.frombuffer(model.encode(text.encode()), model.kind).tolist() == model.library.encode(text, add_special_tokens=False).ids, text
    model.parts.clear()
    model.encode(b"Word, word. WORD!")
    assert sorted(model.parts) == ["!", ",", ".", "word"]  # each piece is encoded once, whatever words it stands in
