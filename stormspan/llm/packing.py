"""Packing documents into token windows by the online sum-of-squares rule.

Each input partition is a stream of its own: a document goes to the fill level (or to a new
window) that keeps the sum of the squared counts of partially filled windows smallest.  The
counts are kept in a level array, so a placement is one vector operation, whatever the number
of windows.  Documents longer than a window first give off full windows.  What is still open
at the end of a stream is poured together, cutting freely, so that a stream leaves less than
one window of padding.  There is no shuffle; a lost task is packed again from its own input.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .shared import Bounded, Recent

WINDOW = 2048
END = 1
VOCABULARY = "word_bpe_49k.json"
#: Bytes of each of the two tables of words that a task keeps, and words of each where the
#: tables outlive it.
REMEMBERED, LASTING = 32 << 20, 400_000

PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Words the quick way reads: letters up to U+024F, which no normal form and no case rule
#: changes in more than one sign, and no special token.
PLAIN = re.compile(r"(?!.*<\|)[!-~¡-įĲ-ɏ]+\Z")
SPLIT = re.compile(r"[ \t\n\r\f\v]+")


class Words:
    """Ids of white-space separated words as little-endian bytes, made when first asked for."""

    def __init__(self, path: str, lasting: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.pieces = Recent(self.piece, LASTING) if lasting else Bounded(self.piece, REMEMBERED)
        self.words = Recent(self.word, LASTING) if lasting else Bounded(self.word, REMEMBERED)
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        self.visible = {b: chr(b) for b in keep} | {b: chr(256 + n) for n, b in enumerate(rest)}

    def forget(self) -> None:
        self.pieces.clear()
        self.words.clear()

    def piece(self, text: str) -> bytes:
        shown = text.encode().decode("latin-1").translate(self.visible)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def word(self, word: str) -> bytes:
        if not PLAIN.match(word):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if word.isalpha():
            return self.pieces[word.lower()]
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return self.pieces[word[:-1].lower()] + self.pieces[word[-1]]
        return b"".join([self.pieces[p] for p in PIECES.findall(word.lower())])


@lru_cache
def word_ids(path: str, lasting: bool = False) -> Words:
    return Words(path, lasting)


def token_ids(text: str | None, path: str, lasting: bool = False) -> bytes:
    """Ids of a whole text, four bytes each; the tokenizer drops white space between words."""
    text = text or ""
    # str.split also parts at these four, which are no white space for the tokenizer.
    words = SPLIT.split(text.strip(" \t\n\r\f\v")) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
    return b"".join(map(word_ids(path, lasting).words.__getitem__, words))


class Windows:
    """Open windows of one stream.  A piece is [document, start, ids in bytes, tokens of the
    document]; closed windows are handed to ``close``."""

    def __init__(self, window: int, close: Callable[[list], None]):
        self.window, self.close = window, close
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = defaultdict(list)

    def place(self, piece: list, size: int) -> None:
        # One window moves from level h to h + size: the sum of squares changes by
        # (1 - 2 N[h]) + (1 + 2 N[h + size]); level 0 and the full level are not counted.
        counts = self.counts
        cost = 2 * (counts[size:] - counts[: self.window + 1 - size])
        cost[0] -= 1
        cost[-1] -= 1
        usable = counts[: self.window + 1 - size] > 0
        usable[0] = True
        cost[~usable] = np.iinfo(np.int64).max
        level = int(len(cost) - 1 - np.argmin(cost[::-1]))  # of equals, the fullest
        pieces = self.open[level].pop() if level else []
        if level:
            counts[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            self.close(pieces)
        else:
            counts[level + size] += 1
            self.open[level + size].append(pieces)

    def add(self, doc, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while total - at >= self.window:
            self.close([[doc, at, ids[4 * at : 4 * (at + self.window)], total]])
            at += self.window
        if at < total:
            self.place([doc, at, ids[4 * at :], total], total - at)

    def finish(self) -> None:
        """Pour the open windows, fullest first, into one another."""
        filled, room = [], self.window
        for level in sorted(self.open, reverse=True):
            for pieces in self.open[level]:
                for doc, start, ids, total in pieces:
                    while ids:
                        cut = ids[: 4 * room]
                        filled.append([doc, start, cut, total])
                        start, ids, room = start + len(cut) // 4, ids[len(cut) :], room - len(cut) // 4
                        if not room:
                            self.close(filled)
                            filled, room = [], self.window
        if filled:
            self.close(filled)
        self.open.clear()
        self.counts[:] = 0


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    vocabulary: str | None = None,
    end: int = END,
    lasting: bool = False,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text and the id ``end``; a null or empty text is that id
    alone.  Every row is packed, equal rows, null keys and repeated keys as well; other columns
    are not looked at.  ``sequence_id`` is the stream's number times 2**32 plus a count.  An
    empty table gives no rows.

    With ``lasting`` the tables of words stay in the workers after a task, a few hundred
    megabytes each, which halves the work where packing is all that a session does.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    tail = np.array([end], "<u4").tobytes()
    fields = [f.name for f in docs.select(key).schema]
    kind = docs.schema[key].dataType.simpleString()
    names = [*fields, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        stream = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        sequence = stream

        def close(pieces: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in pieces:
                length = len(ids) // 4
                out.append((doc, start, length, zlib.crc32(ids), total, sequence, offset))
                offset += length
            sequence += 1

        def flush(key_type: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[] for _ in names]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names
            )
            out.clear()
            return batch

        windows, key_type = Windows(window, close), None
        try:
            for batch in batches:
                key_type = batch.schema.field(0).type
                for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    windows.add(doc, token_ids(value.as_py(), path, lasting) + tail)
                yield flush(key_type)
            if key_type is not None:
                windows.finish()
                yield flush(key_type)
        finally:
            if not lasting:
                word_ids(path).forget()

    longs = ", ".join(f"{n} long" for n in names[1:])
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {longs}")
