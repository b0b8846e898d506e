"""Token counts without token ids.

A tokenizer cuts a text into pre-tokens and encodes each by itself, so a text has as many
tokens as the pieces of its pre-tokens, each taken as often as it occurs.  Texts are read once,
in blocks: a block lists its distinct pre-tokens and, per document, their places in that list
and their frequencies.  The lists of all blocks meet by pre-token, where the pieces of each
distinct one are counted once; the counts go back to their block, are joined to its documents'
frequencies, and are summed.  A pre-token is shuffled once per block that has it, not once per
document or occurrence, so a word that every document holds is no hot key.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import spill

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Bytes of text that share one list of pre-tokens; a longer text has a list of its own.  The
#: longer the block, the fewer blocks list a pre-token; a task holds about eight times as much.
BLOCK = 32 << 20

#: The pattern of the vocabulary whose pre-tokens are also found the quick way, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words for the quick way: letters up to U+024F, which no normal form and no case rule changes
#: in more than one sign, without the beginning of a special token.
PLAIN = re.compile(r"(?!.*<\|)[!-~¡-įĲ-ɏ]+\Z")


class PreTokens:
    """Pre-tokens as the vocabulary's library finds them, in the model's alphabet."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        special = sorted((t["content"] for t in made.get("added_tokens", [])), key=len, reverse=True)
        self.special = frozenset(special)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        first = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        #: White space parts words and belongs to none of them.
        self.by_word = first.get("pattern") == {"Regex": PATTERN} and first.get("behavior") == "Removed"
        self.pieces = regex.compile(PATTERN)
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        self.visible = {b: chr(b) for b in keep} | {b: chr(256 + n) for n, b in enumerate(rest)}

    def of(self, text: str) -> list[str]:
        """Of any stretch of text, special tokens as one pre-token each."""
        found = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                found.append(part)
            elif part:
                if self.tokenizer.normalizer:
                    part = self.tokenizer.normalizer.normalize_str(part)
                found += [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return found

    def of_word(self, word: bytes) -> list[str]:
        text = word.decode("utf-8", "replace")
        if not PLAIN.match(text):
            return self.of(text)
        found = self.pieces.findall(text.lower())
        if text.isascii():
            return found
        return [p.encode().decode("latin-1").translate(self.visible) for p in found]

    def count(self, token: str) -> int:
        return 1 if token in self.special else len(self.tokenizer.model.tokenize(token))


def packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2**32, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(3).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


@lru_cache(maxsize=1)
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


def frequencies(docs: DataFrame, key: str, text: str, path: str, block: int = BLOCK) -> DataFrame:
    """One row per block: its distinct pre-tokens, and of its documents the keys, the number of
    distinct pre-tokens, and their places (each as the distance from the last, anew for every
    document) and frequencies, packed."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = pre_tokens(path)
        name = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        places: dict[str, int] = {}
        known: dict[bytes, tuple] = {}
        keys, sizes, at, many = [], [], [], []
        read, key_type = 0, None

        def parts(data: bytes):
            if not cut.by_word:
                return ((places.setdefault(t, len(places)), n) for t, n in Counter(cut.of(data.decode("utf-8", "replace"))).items())
            out: dict[int, int] = {}
            for word, n in Counter(data.split()).items():
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = tuple([places.setdefault(t, len(places)) for t in cut.of_word(word)])
                for i in ids:
                    out[i] = out.get(i, 0) + n
            return out.items()

        def flush() -> pa.RecordBatch:
            def one(values: pa.Array) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            row = [
                pa.array([name]),
                one(pa.array(list(places), pa.string())),
                one(pa.array(keys, key_type)),
                one(pa.array(sizes, pa.int32())),
                pa.array([packed(np.concatenate(at))], pa.binary()),
                pa.array([packed(np.concatenate(many))], pa.binary()),
            ]
            for kept in (places, known, keys, sizes, at, many):
                kept.clear()
            return pa.RecordBatch.from_arrays(row, ["block", "tokens", "keys", "sizes", "places", "times"])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = value.as_py() or b""
                if read and read + len(data) > block:
                    yield flush()
                    name, read = name + 1, 0
                found = list(parts(data))
                pairs = np.array(found, np.uint32).reshape(-1, 2)
                pairs = pairs[np.argsort(pairs[:, 0])]
                keys.append(doc)
                sizes.append(len(found))
                at.append(np.diff(pairs[:, 0], prepend=np.uint32(0)))
                many.append(pairs[:, 1].copy())
                read += len(data) + 1
        if keys:
            yield flush()

    return docs.select(key, F.col(text).cast("binary")).mapInArrow(
        run,
        f"block long, tokens array<string>, keys array<{kind}>, sizes array<int>, places binary, times binary",
    )


def pieces(tokens: DataFrame, path: str) -> DataFrame:
    """(block, place, pieces) of (block, place, token): equal pre-tokens arrive together, and
    the pieces of each are counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = pre_tokens(path)
        last, n = None, 0
        for batch in batches:
            counts = np.empty(batch.num_rows, np.int32)
            for k, token in enumerate(batch.column(2).to_pylist()):
                if token != last:
                    last, n = token, cut.count(token)
                counts[k] = n
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(counts)], ["block", "place", "pieces"])

    met = tokens.select("block", "place", "token").repartition("token").sortWithinPartitions("token")
    return met.mapInArrow(run, "block long, place int, pieces int")


def count(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    limit: int = LIMIT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_tokens, over_limit (more than ``limit``).

    ``vocabulary`` is the path of a tokenizer file in JSON whose pre-tokens are encoded by
    themselves.  Special strings inside a text count as the library takes them, one token each.
    A null or empty text, or one of white space, has no token (null: no byte either).  Equal
    rows, repeated keys and null keys are rows like any other; other columns are not looked at.
    A text is held whole by one task, however long.  An empty table gives no rows.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = docs.schema[key].dataType.simpleString()
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = docs.select(F.struct(F.col(key).alias("key"), size.alias("n_bytes")).alias("doc"), F.col(text).alias("text"))
    made = spill(frequencies(rows, "doc", "text", path, block))
    tokens = made.select("block", F.posexplode("tokens").alias("place", "token"))
    counted = pieces(tokens, path).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "pieces"))).getField("pieces").alias("pieces")
    )
    joined = made.drop("tokens").join(counted, "block", "left").select("keys", "sizes", "places", "times", "pieces")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys, sizes, at, times, worth = (c[k] for c in batch.columns)
                sizes = np.asarray(sizes.values)
                ends = np.cumsum(sizes)
                at, times = np.cumsum(unpacked(at.as_py())), unpacked(times.as_py())
                # The distances of all documents are summed in one go; take off what came before.
                before = np.concatenate([[0], at])[ends - sizes]
                worth = np.asarray(worth.values) if worth.is_valid else np.empty(0, np.int32)
                sums = np.concatenate([[0], np.cumsum(worth[at - np.repeat(before, sizes)] * times)])
                counted_ = pa.array((sums[ends] - sums[ends - sizes]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*keys.values.flatten(), counted_], ["key", "n_bytes", "n_tokens"])

    summed = joined.mapInArrow(total, f"key {kind}, n_bytes long, n_tokens long")
    return summed.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
