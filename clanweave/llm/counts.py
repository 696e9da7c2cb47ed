"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of many texts are held as one flat array of symbols with an array of sequence starts. In every round
each sequence applies its pair of lowest rank (all its occurrences, from the left), all sequences at once; sequences
without a mergeable pair leave the arrays. What is counted is the symbols that survive. A round costs all that is left, so sequences of more than
``LONGEST`` symbols, which could take as many rounds, are merged one by one with a heap of their pairs.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from clanweave.llm.common import Memo, held_by_worker, id_text, longs, map_arrow, octets

#: Distinct words whose count a Python worker remembers.
MEMO = 400_000
#: Symbols of a sequence that is merged in rounds.
LONGEST = 512
_NONE = np.int64(1 << 40)


class Merges:
    """Ranks of pairs as sorted arrays, and the merging of ragged sequences."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.size = np.int64(max(vocab.values()) + 1)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        self.pairs: dict[int, tuple[int, int]] = {}

    def merged(self, symbols: list[int]) -> int:
        """Number of symbols left of one long sequence: a linked list and a heap of (rank, place) of its pairs."""
        if not self.pairs:
            self.pairs.update(zip(self.key.tolist(), zip(self.rank.tolist(), self.made.tolist(), strict=True), strict=True))
        size, pairs, n = int(self.size), self.pairs, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i) for i in range(n - 1) if (found := pairs.get(symbols[i] * size + symbols[i + 1]))]
        heapq.heapify(heap)
        left = n
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            found = pairs.get(symbols[i] * size + symbols[j]) if symbols[i] >= 0 and j < n else None
            if not found or found[0] != rank:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = found[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (new := pairs.get(symbols[i] * size + symbols[after[i]])):
                    heapq.heappush(heap, (new[0], i))
            if before[i] >= 0 and (new := pairs.get(symbols[before[i]] * size + symbols[i])):
                heapq.heappush(heap, (new[0], before[i]))
            left -= 1
        return left

    def surviving(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of symbols left of each sequence."""
        left = lengths.copy()
        sym, own = symbols.astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)
        long = np.flatnonzero(lengths > LONGEST)
        if len(long):
            starts = np.cumsum(lengths) - lengths
            left[long] = [self.merged(sym[starts[k] : starts[k] + lengths[k]].tolist()) for k in long]
            short = np.repeat(lengths <= LONGEST, lengths)
            sym, own = sym[short], own[short]
        while len(sym) > 1:
            key = sym[:-1] * self.size + sym[1:]
            spot = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            rank = np.where((self.key[spot] == key) & (own[:-1] == own[1:]), self.rank[spot], _NONE)
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, _NONE], starts)
            sizes = np.diff(np.r_[starts, len(own)])
            active = lowest < _NONE
            hit = np.flatnonzero(np.r_[rank, _NONE] == np.repeat(np.where(active, lowest, -1), sizes))
            if not len(hit):
                break
            # Of occurrences that overlap (of a pair of equal symbols) every other one is taken.
            run = np.flatnonzero(np.r_[True, hit[1:] != hit[:-1] + 1])
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))) % 2 == 0]
            sym[hit] = self.made[spot[hit]]
            left -= np.bincount(own[hit], minlength=len(left))
            keep = np.repeat(active, sizes)
            keep[hit + 1] = False
            sym, own = sym[keep], own[keep]
        return left


class Counter:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("a plain merge model is needed")
        self.vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        from tokenizers.pre_tokenizers import ByteLevel

        if not {c + end for c in ByteLevel.alphabet() for end in ("", self.suffix)} <= self.vocab.keys():
            raise ValueError("a model of bytes, each with a token of its own, is needed")
        self.merges = Merges(self.vocab, model["merges"])
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.memo = Memo(MEMO)

    def _count(self, words: list[bytes]) -> list[int]:
        totals = np.zeros(len(words), np.int64)
        symbols, lengths, owner = [], [], []
        normal, split, vocab, suffix = self.library.normalizer, self.library.pre_tokenizer, self.vocab, self.suffix
        for k, word in enumerate(words):
            text = word.decode()
            pieces = [text]
            if self.added and self.added.search(text):
                totals[k] += len(self.added.findall(text))
                pieces = [p for p in self.added.split(text) if p]
            for piece in pieces:
                for token, _ in split.pre_tokenize_str(normal.normalize_str(piece)):
                    if token:
                        symbols += [vocab[c] for c in token[:-1]]
                        symbols.append(vocab[token[-1] + suffix])
                        lengths.append(len(token))
                        owner.append(k)
        if lengths:
            left = self.merges.surviving(np.array(symbols, np.int64), np.array(lengths, np.int64))
            np.add.at(totals, np.array(owner), left)
        return totals.tolist()

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text. White space never lies within a token, so texts are taken word by word."""
        words = [t.split() for t in texts]
        found = np.array(self.memo.values([w for ws in words for w in ws], self._count), np.int64)
        upto = np.r_[0, np.cumsum(found)]
        ends = np.cumsum([len(ws) for ws in words])
        return (upto[ends] - upto[np.r_[0, ends[:-1]]]).tolist()


_LOADED: dict[str, Counter] = held_by_worker("counts")


def counter(path: str) -> Counter:
    if path not in _LOADED:
        _LOADED[path] = Counter(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = 2048) -> DataFrame:
    """Tokens of every whole text.

    Returns one row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit). A null text counts as an
    empty one (0 bytes, 0 tokens); null and repeated doc_ids are kept; columns other than doc_id and text are not read.
    Begin, end and added special tokens are not added; their strings in a text count as one token each.
    """

    def run(batches) -> Iterator[dict]:
        tokens = counter(tokenizer_file)
        for batch in batches:
            texts = octets(batch)
            n = tokens.count(texts)
            yield {"doc_id": longs(batch), "n_bytes": [len(t) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_arrow(id_text(docs), "doc_id long, n_bytes long, n_tokens long, over_limit boolean", run, keeps="counts")
