"""SentencePiece encoding and decoding by a merge-type prefix table.

A merge-type encoding has one last token for each prefix of a text, and a sequence of tokens is an encoding when each of
its neighbouring pairs is. So an automaton over all tokens gives those that end at a place, a test whether such a token
may follow the last token of the prefix before it picks the one that does, and the ids are recovered backwards from the
end. The work is linear in the text, whatever its words are.

Texts are cut where no token of the vocabulary can cross, before white space say, and a worker keeps the ids of the cuts
it has met, up to a bound that changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytewords import tidy

#: The sign that stands for a blank in pieces.
BLANK = "▁"
#: Cuts of text that each of a worker's two generations of memory holds, and pairs of tokens before it starts anew.
CACHE, PAIRS = 250_000, 1_000_000
#: Types of pieces in the model's file.
_NORMAL, _USER_DEFINED, _BYTE = 1, 4, 6


class PieceCodec:
    """A merge-type model: ids of texts by the prefix table, and texts of ids.

    Models of another type, without byte fallback or with user-defined symbols are a ValueError.
    """

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != model.trainer_spec.BPE or not model.trainer_spec.byte_fallback or any(p.type == _USER_DEFINED for p in model.pieces):
            raise ValueError("a merge-type model with byte fallback and without user-defined symbols is needed")
        self.library = SentencePieceProcessor(model_file=path)
        self.bos, self.eos = self.library.bos_id(), self.library.eos_id()
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        # tokens that their own merges reach; single signs always are tokens, also those without a piece
        joined = {c for piece in self.ids if len(piece) > 1 for c in piece}
        tokens = sorted(joined | {piece for piece in self.ids if len(piece) == 1 or len(self.merged(piece)) == 1})
        self.tokens, self.coded = tokens, [self._code(t) for t in tokens]
        self.automaton = ahocorasick.Automaton()
        for k, token in enumerate(tokens):
            self.automaton.add_word(token, (k, len(token)))
        self.automaton.make_automaton()
        inner = any(BLANK in piece.lstrip(BLANK) for piece in self.ids)
        signs = "".join(re.escape(c) for c in sorted(joined - (set() if inner else {BLANK})))
        one = f"{BLANK}*[{signs}]+|{BLANK}+|." if signs and not inner else f"[{signs}]+|." if signs else "."
        self.cut = re.compile(one, re.DOTALL)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _code(self, token: str) -> bytes:
        ids = [self.ids[token]] if token in self.ids else [self.bytes[b] for b in token.encode()]
        return np.array(ids, "<u4").tobytes()

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text by merging itself: the pair of the best score first, of equal ones the leftmost."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: int, right: int) -> bool:
        """Whether token ``right`` may stand behind token ``left``: merging them together leaves both as they are."""
        key = left * len(self.tokens) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            a, b = self.tokens[left], self.tokens[right]
            known = self.pairs[key] = self.merged(a + b) == [a, b]
        return known

    def _table(self, text: str) -> bytes:
        """Ids of a text in which tokens may cross everywhere."""
        last, size = [-1] * len(text), [0] * len(text)
        pairs, follows, n = self.pairs, self.follows, len(self.tokens)
        for end, (token, length) in self.automaton.iter(text):
            if last[end] >= 0:
                continue
            start = end - length
            if start >= 0:
                before = last[start]
                fits = pairs.get(before * n + token)
                if fits is None:
                    fits = follows(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        out, at = [], len(text) - 1
        while at >= 0:
            out.append(self.coded[last[at]])
            at -= size[at]
        return b"".join(reversed(out))

    def encode(self, text: str) -> bytes:
        """Ids with those of begin and end, as little-endian unsigned 32-bit integers."""
        known, out = self.known, [self._edge(self.bos)]
        for part in self.cut.findall(self.library.normalize(text)):
            ids = known.get(part)
            if ids is None:
                ids = self.older.get(part)
                if ids is None:
                    ids = self._code(part) if len(part) == 1 else self._table(part)
                if len(part) <= 64:
                    if len(known) >= CACHE:
                        self.older, known = known, {}
                        self.known = known
                    known[part] = ids
            out.append(ids)
        out.append(self._edge(self.eos))
        return b"".join(out)

    @staticmethod
    def _edge(i: int) -> bytes:
        return np.array([i] if i >= 0 else [], "<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        """The library's text of the ids."""
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """A worker keeps its models and their memory between tasks."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def code(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded of each row of ``docs`` (doc_id, text), whole texts.

    ``ids``: those of the model at ``path`` with begin and end, as little-endian unsigned 32-bit integers in a binary;
    ``decoded``: the text that they decode to. A null text counts as empty and has begin and end alone; repeated rows and
    null doc_ids have a row each; other columns are left aside; no rows give no rows. A task holds one text's table of
    integers at a time.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(path)
        for batch in batches:
            first, texts = 0, batch.column(1)
            while first < batch.num_rows:  # results of a few million signs at a time
                ids, decoded, signs = [], [], 0
                while first + len(ids) < batch.num_rows and signs < 4_000_000:
                    text = texts[first + len(ids)].as_py() or ""
                    ids.append(of.encode(text))
                    decoded.append(of.decode(ids[-1]))
                    signs += len(text)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ids)), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])
                first += len(ids)

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(tidy(task), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")
