from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelwright.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None, "", " \t\n", "The quick, brown fox's 12ab34 don't!", "a<|endoftext|>b <|startoftext|> c", "x\x1c!\x85y\xa0z! ?",
    "İÍ ÉÈ éa Σς ΑΣ.", "naïve​word ½ ㍱ \U0001f600\U0001f600 ́start", "x" * 5000,
    "same same same", "same same same", "long " * 30_000, "<|endoftext|>", "..,,!!??", "日本語 テキスト",
]


@pytest.mark.parametrize("at_once", [3, 2000])
def test_ids_and_text_are_the_librarys(spark, monkeypatch, at_once):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(None, "null id", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    whole = Tokenizer.from_file(PATH)
    got = bpe.encode(df, PATH)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    digests = {r["doc_id"]: r for r in bpe.encoded_documents(df).collect()}
    for r in got.collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == whole.decode(ids, skip_special_tokens=False)
        d = digests[r["doc_id"]]
        assert d["n_tokens"] == len(ids)
        assert d["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_no_documents(spark):
    assert bpe.encoded_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
