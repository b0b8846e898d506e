"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reads a text once.  At each position its output
links name every piece that ends there; each relaxes the best score of that position from the
position where it begins (Viterbi).  Characters that no piece covers fall back to byte pieces
at a penalty below all scores.  Decoding joins pieces and bytes.

Pieces with a space mark hold it at their start only, or are runs of marks; so the best
segmentation of a text is that of its units (a run of marks and what follows), and the units
of a worker's texts are remembered in a bounded table.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Recent

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 300_000
UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


class Pieces:
    """A vocabulary: its automaton, scores, byte pieces and the units seen so far."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: dict[int, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        self.of_byte: dict[int, int] = {}
        lowest = 0.0
        texts = []
        for index in range(model.get_piece_size()):
            piece = model.id_to_piece(index)
            self.bytes[index] = b""
            if model.is_byte(index):
                value = int(piece[3:5], 16)
                self.of_byte[value], self.bytes[index] = index, bytes([value])
            elif not (model.is_control(index) or model.is_unknown(index) or model.is_unused(index)):
                score = model.get_score(index)
                lowest = min(lowest, score)
                texts.append(piece)
                self.bytes[index] = piece.encode()
                self.automaton.add_word(piece, (len(piece), score, index))
        self.automaton.make_automaton()
        self.penalty = lowest - 10.0
        self.unknown = model.unk_id()
        marked = [p for p in texts if MARK in p[1:]]
        self.by_unit = all(set(p) == {MARK} for p in marked) and not any("\n" in p for p in texts)
        self.single = frozenset(p for p in texts if len(p) == 1)
        self.seen = Recent(self.unit, REMEMBERED)

    def best(self, unit: str) -> tuple[list[int], float]:
        """Ids of the best segmentation of a unit and its score."""
        size = len(unit)
        score = [float("-inf")] * (size + 1)
        score[0] = 0.0
        back: list[tuple[int, int] | None] = [None] * (size + 1)
        # A character without a piece of its own can be reached by bytes only; any other by its
        # own piece, which is worth more.
        bare = [] if self.single.issuperset(unit) else [n for n, c in enumerate(unit) if c not in self.single]
        bare.append(size)
        due = 0
        for end, (length, worth, index) in self.automaton.iter(unit):
            while bare[due] < end:
                self.by_bytes(bare[due], score, back)
                due += 1
            start = end + 1 - length
            worth += score[start]
            if worth > score[end + 1]:
                score[end + 1] = worth
                back[end + 1] = (start, index)
        for at in bare[due:-1]:
            self.by_bytes(at, score, back)
        ids: list[int] = []
        at = size
        while at:
            start, index = back[at]
            if index >= 0:
                ids.append(index)
            else:
                ids.extend(self.of_byte.get(b, self.unknown) for b in reversed(unit[start:at].encode()))
            at = start
        return ids[::-1], score[size]

    def by_bytes(self, at: int, score: list, back: list) -> None:
        if score[at] + self.penalty > score[at + 1]:
            score[at + 1], back[at + 1] = score[at] + self.penalty, (at, -1)

    def unit(self, unit: str) -> tuple[bytes, float]:
        ids, score = self.best(unit)
        return array("i", ids).tobytes(), score

    def encode(self, text: str) -> tuple[bytes, float]:
        """Ids (four bytes each) and score.  The empty text has no ids."""
        if not text:
            return b"", 0.0
        marked = MARK + text.replace(" ", MARK)
        parts = list(map(self.seen.__getitem__, UNITS.findall(marked) if self.by_unit else [marked]))
        return b"".join([p[0] for p in parts]), sum([p[1] for p in parts])

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, bytes read as UTF-8, the first mark dropped.  Ids
        of control pieces and ids out of range stand for nothing."""
        try:
            out = b"".join(map(self.bytes.__getitem__, ids))
        except KeyError:
            out = b"".join([self.bytes.get(i, b"") for i in ids])
        text = out.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids, score) per row: the ids of the best segmentation and its score.

    A null or empty text has no ids and score 0.  The space mark itself, met in a text, reads
    as a space.  Of equal scores the piece found first, the longest, wins.  Repeated rows and
    null keys are encoded like any other; other columns are not looked at.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                made = [model.encode(t.as_py() or "") for t in part.column(1)]
                ends = np.cumsum([0] + [len(ids) // 4 for ids, _ in made]).astype(np.int32)
                flat = np.frombuffer(b"".join([ids for ids, _ in made]), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, flat), pa.array([s for _, s in made], pa.float64())],
                    [key, "ids", "score"],
                )

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>, score double")


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """(key, text) per row.  Null ids give a null text, no ids the empty text."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [None if row is None else model.decode(row) for row in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, n_pieces, n_chars, score, text_sha256, decoded_sha256, ids) per row: each text
    encoded and decoded in one pass; the digests agree where the round trip is exact."""
    import hashlib

    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "ids", "n_chars", "score", "text_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t or "" for t in part.column(1).to_pylist()]
                made = [model.encode(t) for t in texts]
                arrays = [np.frombuffer(ids, "<i4") for ids, _ in made]
                ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(ends, np.concatenate(arrays) if arrays else np.empty(0, np.int32)),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([s for _, s in made], pa.float64()),
                        pa.array([digest(t) for t in texts], pa.string()),
                        pa.array([digest(model.decode(a.tolist())) for a in arrays], pa.string()),
                    ],
                    names,
                )

    made = docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, ids array<int>, n_chars long, score double, text_sha256 string, decoded_sha256 string"
    )
    return made.withColumn("n_pieces", F.size("ids").cast("long"))
