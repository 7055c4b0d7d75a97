"""Byte-level BPE against the tiktoken library, on edge texts and long pieces."""

import random

import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

from skyledger.llm.bpe import encode_documents, load

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=load_tiktoken_bpe(PATH), special_tokens={})


def texts():
    draw = random.Random(2)
    out = ["", None, " ", "one", "Grüße, 世界! 🙂\n\n\ttabs  and   spaces", "<|endoftext|>", "a" * 5000]
    out += ["".join(draw.choice("abcde \n0é") for _ in range(draw.randrange(400))) for _ in range(150)]
    out += ["".join(draw.choice("abehinrst") for _ in range(n)) for n in (31, 32, 33, 64, 129, 700)]
    return out + [out[4], out[4]]


def test_documents_equal_the_library(spark, library):
    wanted = texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(wanted)], "doc_id BIGINT, text STRING, ids STRING")
    found = {r.doc_id: r for r in encode_documents(docs).collect()}
    assert len(found) == len(wanted)
    for i, text in enumerate(wanted):
        ids = library.encode(text or "", disallowed_special=())
        assert found[i].ids == " ".join(map(str, ids)) and found[i].n_tokens == len(ids)
        assert bytes(found[i].decoded) == (text or "").encode()
    assert encode_documents(docs.limit(0)).count() == 0


def test_pieces_joined_from_halves_equal_plain_merging():
    draw, tokenizer = random.Random(7), load(PATH, PATTERN)
    for _ in range(400):
        data = bytes(draw.choice(b"abeinrst \xc3\xa9") for _ in range(draw.randrange(1, 200)))
        assert tokenizer.encode_piece(data) == tokenizer.merge(data)
        assert tokenizer.decode(tokenizer.encode_piece(data)) == data
