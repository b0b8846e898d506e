"""Token counts against the tokenizer itself on whole texts."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stormspan.llm import queries, tokens

TEXTS = [
    "<|endoftext|>Hello<|startoftext|> İstanbul ΑΣΣ ΑΣ x", "日本語 テキスト", "á école   b\x1cc", "it's I'LL DON'T ''s 'S",
    "", None, " \n\t ", "ŉ Å é ß ẞ 12345 ½ x²", "<|endof text|> <|ENDOFTEXT|>", "😀😀 a😀b", "x" * 50_000, "ﬁ ʼn ǆ Ǆ a­b",
    "a b c\u0085d", "<|endoftext|><|endoftext|>", "word " * 60_000, "é ́e", "ẞͅ ᾳ", "\x00\x01 \x7f",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("block", [1, 100, 4 << 20])
def test_counts_equal_the_tokenizer(spark, name, block):
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r for r in tokens.count(docs, vocabulary=path, block=block).collect()}
    for k, text in enumerate(TEXTS):
        want = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert got[k].asDict() == {"doc_id": k, "n_bytes": len((text or "").encode()), "n_tokens": want, "over_limit": want > 2048}


def test_repeated_rows_null_keys_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a"), (None, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in tokens.count(docs).collect())
    assert got == [(0, 0, 0), (0, 1, 1), (1, 3, 2), (1, 3, 2)]
    assert tokens.count(docs.limit(0)).count() == 0
    assert tokens.count(docs.filter("text is null")).collect()[0]["n_tokens"] == 0
    assert tokens.count(docs, limit=1).filter("over_limit").count() == 2


def test_each_distinct_pre_token_is_counted_once(spark, monkeypatch):
    """Two blocks that share all their pre-tokens: the model is asked once for each."""
    docs = spark.createDataFrame([(k, "the thein inenan the") for k in range(4)], "doc_id long, text string").coalesce(1)
    made = tokens.frequencies(docs, "doc_id", "text", public_tokenizers.path(tokens.VOCABULARY), 1)
    assert made.count() == 4
    row = made.select("tokens", "sizes", "places", "times").distinct().collect()
    assert len(row) == 1 and list(row[0])[:2] == [["the", "thein", "inenan"], [3]]
    assert tokens.unpacked(row[0]["places"]).tolist() == [0, 1, 1] and tokens.unpacked(row[0]["times"]).tolist() == [2, 1, 1]


def test_query_equals_the_tokenizer(spark, folder):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op12_token_counts(spark, folder).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {
        k: len(tokenizer.encode(t, add_special_tokens=False).ids) for k, t in texts.items()
    }
    assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) for r in rows)
