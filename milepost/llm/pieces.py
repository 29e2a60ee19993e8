"""SentencePiece ids by backtracking, and texts back from ids.

A model of the merge type joins neighbouring symbols, best score first, leftmost of equal scores, until no two neighbours
form a piece. What comes out is the only way to cut the text so that any two adjacent pieces, merged again from their
characters alone, give just these two: merges inside a span depend on the span only, and a merge across a border of the
cut would also cross it in the text of the two pieces beside it. So the cut can be searched instead of merged: the
longest piece first at every place (Aho-Corasick), a shorter one where the neighbours do not stand the check, one piece
back where none is left. As a prefix has one such cut only, a place that failed once fails for good.

Texts are taken apart where no piece of the model can cross, and the parts seen before come from a bounded memory.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = "▁"
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Ways to take a text apart, finest first. Whether a part ends between two characters depends on these two alone.
_PARTS = (
    rf"{_SPACE}+[^{_SPACE}{_LATIN}]*[{_LATIN}]*|[^{_SPACE}{_LATIN}]+[{_LATIN}]*|[{_LATIN}]+",
    rf"{_SPACE}+[^{_SPACE}]*|[^{_SPACE}]+",
)
#: Parts with more characters than this are not remembered.
_LONG = 100


def default_model() -> str:
    """Place of the byte-fallback merge model in the public tokenizer package."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Known(dict):
    """Values computed once by ``make``; emptied when ``most`` are held."""

    def __init__(self, make, most: int):
        super().__init__()
        self._make, self._most = make, most

    def __missing__(self, key):
        if len(self) >= self._most:
            self.clear()
        value = self[key] = self._make(key)
        return value


class PieceEncoder:
    """Ids of a text under a merge-type model without sampling, begin or end ids."""

    def __init__(self, model: str, parts: int = 500_000, pairs: int = 300_000):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.library = p = SentencePieceProcessor(model_file=model)
        ids = range(p.get_piece_size())
        if any(map(p.is_unused, ids)):
            raise ValueError("models with unused pieces are not supported")
        normal = [i for i in ids if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        self._id = {p.id_to_piece(i): i for i in normal}
        self._score = {p.id_to_piece(i): p.get_score(i) for i in normal}
        self._byte = {int(p.id_to_piece(i)[1:-1], 16): i for i in ids if p.is_byte(i)}
        self._unknown = p.unk_id()
        self._plain = p.normalize(f" a  Åﬁ{_SPACE}\n") == f"{_SPACE * 2}a{_SPACE * 2}Åﬁ{_SPACE}\n"
        self._longer = ahocorasick.Automaton()
        for piece in self._id:
            if len(piece) > 1:
                self._longer.add_word(piece, piece)
        self._longer.make_automaton()
        whole = lambda rule: all(len(rule.findall(piece)) == 1 for piece in self._id)
        rules = [rule for rule in map(re.compile, _PARTS) if whole(rule)]
        self._parts = rules[0].findall if rules else lambda text: [text]
        self._stands = _Known(lambda piece: self.merged(piece) == [piece], pairs)
        self._joins = _Known(lambda pair: self.merged(pair[0] + pair[1]) == [*pair], pairs)
        self._known = _Known(self._ids, parts)

    def merged(self, text: str) -> list[str]:
        """The model's own rule on a short text: join the best pair, leftmost of equal ones, until none is a piece."""
        symbols, score = list(text), self._score.get
        scores = [score(a + b) for a, b in zip(symbols, symbols[1:])]
        while found := [s for s in scores if s is not None]:
            at = scores.index(max(found))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(symbols[at - 1] + symbols[at])
            if at < len(scores):
                scores[at] = score(symbols[at] + symbols[at + 1])
        return symbols

    def cut(self, text: str) -> list[str]:
        """Pieces and unknown characters of a normalised text."""
        left = [[char] for char in text]  # what may start at each place, longest last
        if len(self._longer):
            for end, piece in self._longer.iter(text):
                left[end + 1 - len(piece)].append(piece)
        size, at, path = len(text), 0, []
        failed = bytearray(size // 8 + 1)
        while at < size:
            here = left[at]
            while here:
                piece = here.pop()
                end = at + len(piece)
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                if self._joins[path[-1], piece] if path else self._stands[piece]:
                    path.append(piece)
                    at = end
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(path.pop())
        return path

    def _ids(self, part: str) -> bytes:
        out = array("i")
        for piece in self.cut(part):
            if (known := self._id.get(piece)) is not None:
                out.append(known)
            elif self._byte:
                out.extend(self._byte[b] for b in piece.encode())
            else:
                out.append(self._unknown)
        return out.tobytes()

    def __call__(self, text: str) -> bytes:
        """Ids as native 32-bit integers."""
        if not text:
            return b""
        plain = _SPACE + text.replace(" ", _SPACE) if self._plain else self.library.normalize(text)
        parts = self._parts(plain)
        if max(map(len, parts)) > _LONG:
            return b"".join(self._ids(part) if len(part) > _LONG else self._known[part] for part in parts)
        return b"".join(map(self._known.__getitem__, parts))


@cache
def encoder(model: str) -> PieceEncoder:
    """One encoder per Python worker; workers are reused by later tasks."""
    return PieceEncoder(model)


def encode(
    docs: DataFrame, model: str | None = None, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids array) of every whole text, and with ``decoded`` the text that the model gives back for the ids.

    A null text is an empty one (no ids, empty text). Null ids, repeated rows and equal texts each keep their row; other
    columns are not read; an empty table gives no rows. A long text is never cut inside a piece.
    """
    path = model or default_model()

    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encode = encoder(path)
        for batch in batches:
            ids = [encode(text.as_py() or "") for text in batch.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in ids])]).astype("int32")
            flat = np.frombuffer(b"".join(ids), "int32")
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))]
            if decoded:
                columns.append(pa.array([encode.library.decode(array("i", b).tolist()) for b in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    few = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return few.mapInArrow(rows, "doc_id bigint, ids array<int>" + (", decoded string" if decoded else ""))


def decode(encoded: DataFrame, model: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of the ids; null ids give a null text, ids outside the model raise."""
    path = model or default_model()

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        library = encoder(path).library
        for batch in batches:
            texts = [None if ids is None else library.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    few = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return few.mapInArrow(rows, "doc_id bigint, text string")
