"""op7's ids against the tokenizers file with its default settings; chat keeps the added token's string as text."""

import zlib

import numpy as np
import pytest

from crawlspark.llm import chat
from crawlspark.llm import packing as P

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext| >", "a  <|endoftext|>  b ", "plain", None]


def default_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("text", TEXTS)
def test_ids(text):
    assert np.frombuffer(P.tokens(P.vocabulary_path(), text, end_of_text=True), "<u4").tolist() == default_ids(text)


def test_op7(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in P.op7_packing(spark, str(tmp_path)).collect()}
    for i, text in enumerate(TEXTS):
        ids = np.array(default_ids(text), "<u4")
        assert (rows[i]["length"], rows[i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


def test_chat_encodes_ordinary_text():
    ids = chat.encode("a <|endoftext|> b", P.vocabulary_path())
    assert P.END_OF_TEXT_ID not in ids.tolist() and P.encoder(P.vocabulary_path()).decode_bytes(ids.tolist()) == b"a <|endoftext|> b"
