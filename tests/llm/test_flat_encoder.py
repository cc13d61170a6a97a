"""The token files' encoder against the library, text by text."""

import random

import public_tokenizers
import pytest
from guardlake.llm import bpe, token_files
from tokenizers import Tokenizer

from tests.llm.cases import AWKWARD, prose


@pytest.mark.parametrize("name, end", [("byte_bpe_50k.json", 2), ("word_bpe_49k.json", 7)])
def test_same_as_the_library(monkeypatch, name, end):
    monkeypatch.setattr(token_files, "REMEMBERED", 300)
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        encoder = token_files.FlatEncoder(bpe.bpe(f.read(), by_library=True), end)
    rng = random.Random(41)
    texts = [t or "" for t in AWKWARD] + [prose(rng, rng.randint(0, 30)) for _ in range(200)]
    texts += ["".join(rng.choices(" \n\ta'sT9²é¹½ǅ_-<|", k=rng.randint(0, 60))) for _ in range(300)] + ["é'll " * 400]
    for a in range(0, len(texts), 13):
        some = texts[a : a + 13]
        ids, bounds = encoder.encode(some)
        assert bounds[0] == 0 and bounds[-1] == len(ids)
        for text, s, e in zip(some, bounds, bounds[1:]):
            assert ids[s:e].tolist() == [*library.encode(text, add_special_tokens=False).ids, end], text
    assert encoder.encode([])[1].tolist() == [0]
