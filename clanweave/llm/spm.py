"""SentencePiece (merge-type) encoding by backtracking, and decoding.

Instead of replaying merges over a text, each piece of text is covered from left to right by the longest
vocabulary entry (found with an Aho-Corasick automaton). An entry may follow its predecessor only if merging the
concatenation of the two gives exactly these two entries back; if that fails, the next shorter entry is tried,
and if none is left the last entry is taken back and its end is marked in a bit field, so that no position is tried
twice. A sequence in which all neighbours are compatible is the one that merging the whole text gives.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clanweave.llm.common import Memo, held_by_worker, id_text, longs, map_arrow, octets

SPACE = "▁"
LETTERS = "[A-Za-z0-9À-ÖØ-öø-ſ]"
#: Distinct stretches of text whose ids a Python worker remembers, and pairs whose compatibility it remembers.
MEMO, PAIRS = 350_000, 1_000_000


class Backtracker:
    """Encoder for a merge-type model with byte fallback and an identity normaliser."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        model = pb.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        normal = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("the model must be of merge type, with an identity normaliser")
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix, self.end = normal.add_dummy_prefix, self.library.eos_id()
        self.unknown, self.fallback = self.library.unk_id(), model.trainer_spec.byte_fallback
        self.score = {p.piece: p.score for p in model.pieces if p.type == 1}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if self.fallback else []
        self.stretch = self.cuts()
        # Only entries that merging gives back as one can be part of an encoding.
        stable = [p for p in self.ids if self.merge(p) == [p]]
        known = set(stable)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in known), None) for p in stable}
        self.automaton = ahocorasick.Automaton()
        for p in stable:
            if len(p) > 1:  # a single character needs no search
                self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        self.fits: dict[tuple[str, str], bool] = {}
        self.memo = Memo(MEMO)

    def cuts(self) -> re.Pattern:
        """Text may be cut where no entry lies across: before spaces, around line ends, and between a letter and those
        marks that follow a letter in no entry. The pattern matches the stretches between cuts."""
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in self.ids):
            return re.compile("(?s).+")
        follow = {p[k + 1] for p in self.ids for k in range(len(p) - 1) if re.match(LETTERS, p[k])}
        marks = "".join(c for c in string.punctuation if c not in follow)
        other = f"[^ \n{LETTERS[1:]}"
        before = f"(?![{re.escape(marks)}])" if marks else ""
        return re.compile(rf"\n| *+{other}*+(?:{LETTERS}++{before}{other}++)*+(?:{LETTERS}++)?+")

    def merge(self, text: str) -> list[str]:
        """Merging as the model defines it: highest score first, leftmost among equals. For short texts."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the concatenation of two entries gives these two; remembered in ``fits``."""
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        ok = self.fits[left, right] = self.merge(left + right) == [left, right]
        return ok

    def pieces(self, text: str) -> list[str]:
        """The entries (and single unknown characters) that cover ``text``."""
        n = len(text)
        longest = list(text)
        for end, (back, piece) in self.automaton.iter(text):  # ends ascend, so the longest of a start comes last
            longest[end - back] = piece
        fits, shorter, done = self.fits, self.shorter, []
        failed = bytearray(n // 8 + 1)  # a bit for each position from which the rest can't be covered
        at, piece, before = 0, longest[0] if n else None, None
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    ok = before is None or fits.get((before, piece))
                    if ok or ok is None and self.compatible(before, piece):
                        break
                piece = shorter.get(piece)
            if piece is None:
                if before is None:
                    raise AssertionError("a text has an encoding")
                failed[at >> 3] |= 1 << (at & 7)
                done.pop()
                at -= len(before)
                piece, before = before, done[-1] if done else None
                continue
            done.append(piece)
            at, before = end, piece
            if at < n:
                piece = longest[at]
        return done

    def encode_stretch(self, text: str) -> list[int]:
        pieces = self.pieces(text)
        out = list(map(self.ids.get, pieces))
        if None not in out:
            return out
        out = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            elif self.fallback:
                out += [self.byte_ids[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return out

    def _stretches(self, texts: list[str]) -> list[tuple[list[int], bytes]]:
        found = [self.encode_stretch(t.replace(" ", SPACE)) for t in texts]
        return [(ids, " ".join(map(str, ids)).encode()) for ids in found]

    def encode(self, text: bytes) -> tuple[list[int], bytes]:
        """Ids of a whole text with the end id, also as decimal text."""
        plain = text.decode().replace(SPACE, " ")
        parts = self.stretch.findall(" " + plain if plain and self.prefix else plain)
        found = self.memo.values(parts, self._stretches)
        ids = list(chain.from_iterable([own for own, _ in found]))
        ids.append(self.end)
        return ids, b" ".join([digits for _, digits in found if digits] + [b"%d" % self.end])


_LOADED: dict[str, Backtracker] = held_by_worker("spm")


def encoder(model_file: str) -> Backtracker:
    """One encoder per Python worker and model file."""
    if model_file not in _LOADED:
        _LOADED[model_file] = Backtracker(model_file)
    return _LOADED[model_file]


def encode_documents(docs: DataFrame, model_file: str, with_ids: bool = True, with_text: bool = False) -> DataFrame:
    """Encode every whole text with an end id and decode the ids again.

    Returns one row per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space),
    decoded_sha256 (of the decoded UTF-8), and on request ids (array<int>) and decoded. A null or empty text is encoded
    as the end id alone; null and repeated doc_ids are kept as they are; columns other than doc_id and text are not read.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded string" * with_text

    def run(batches) -> Iterator[dict]:
        model = encoder(model_file)
        for batch in batches:
            out = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
            for text in octets(batch):
                ids, shown = model.encode(text)
                decoded = model.library.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(shown).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    out["ids"].append(np.array(ids, np.int32))
                if with_text:
                    out["decoded"].append(decoded)
            if with_ids:
                ends = np.cumsum([0, *map(len, out["ids"])])
                out["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out["ids"])))
            yield out | {"doc_id": longs(batch)}

    return map_arrow(id_text(docs), schema, run, keeps="spm")
