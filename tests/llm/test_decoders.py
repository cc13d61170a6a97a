"""Decoding by the decoder that the tokenizer file names."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from guardlake.llm import bpe
from tokenizers import Tokenizer

from tests.llm.cases import AWKWARD, documents

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def test_byte_level_files_give_the_text_back(spark):
    docs, tokenizer = documents(spark, AWKWARD), Tokenizer.from_file(BYTE)
    encoded = bpe.encode_documents(docs, BYTE)
    shown = {r.doc_id: r.text for r in bpe.decode_documents(encoded, BYTE).collect()}
    for r in encoded.collect():
        assert shown[r.doc_id] == tokenizer.decode(r.ids, skip_special_tokens=False) == (AWKWARD[r.doc_id] or "")
    for r in bpe.digest_documents(docs, BYTE).collect():
        assert r.decoded_sha256 == hashlib.sha256(shown[r.doc_id].encode()).hexdigest()


def test_ids_in_any_order_decode_as_in_the_library():
    rng, tokenizer = random.Random(4), Tokenizer.from_file(BYTE)
    with open(BYTE, encoding="utf-8") as f:
        model = bpe.Bpe(f.read())
    for _ in range(3000):
        ids = [rng.choice((rng.randrange(256), rng.randrange(50257))) for _ in range(rng.randrange(9))]
        assert model.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)


def test_other_decoders_are_refused():
    with open(BYTE, encoding="utf-8") as f:
        spec = json.load(f)
    model = bpe.Bpe(json.dumps(spec | {"decoder": {"type": "Fuse"}}))
    assert model.encode(["a b"])[0].tolist() == Tokenizer.from_file(BYTE).encode("a b").ids
    with pytest.raises(ValueError):
        model.decode([1])
