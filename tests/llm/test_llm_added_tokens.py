"""Strings of added tokens in texts: ids of the registered forms equal the plain call of tokenizers."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from corpusmill.llm import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["x <|endoftext|> y", "<|endoftext|>", "a\n<|endoftext|><|endoftext|>b c", "plain text, no token", "<|endoftext", ""]


def test_registered_queries_encode_like_a_plain_call(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    whole = Tokenizer.from_file(PATH)
    want = [whole.encode(t, add_special_tokens=False).ids for t in TEXTS]
    packed = {r.doc_id: r for r in queries.op8_packing(spark, str(tmp_path)).collect()}
    for i, ids in enumerate(want):
        assert packed[i].ids_crc32 == zlib.crc32(np.array([*ids, 1], np.uint32).tobytes())
    counted = {r.doc_id: r.doc_tokens for r in queries.op7_token_counts(spark, str(tmp_path)).collect()}
    assert counted == {i: len(ids) for i, ids in enumerate(want)}
