"""BPE, token files and token counts against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from guardlake.llm import bpe, token_counts, token_files, words
from guardlake.llm import queries as llm
from tokenizers import Tokenizer

from tests.llm.cases import AWKWARD, documents, prose

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    parts = ["a", "B", "'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "1", "2", "!", "-", "é", "Σ", " ", "<|endoftext|>", "あ", "'d"]
    noise = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    return AWKWARD + noise + [prose(rng, n) for n in (3, 50, 4000)] + [prose(rng, 20)] * 5


def library(path, texts):
    return Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_every_assigned_character_is_cut_as_the_library_does(path):
    texts = [f"a{chr(c)}b" for c in range(1, words.LIMIT)] + [f"'{chr(c)} {chr(c)}s" for c in range(1, 0x500)]
    with open(path, encoding="utf-8") as f:
        ids, bounds = bpe.Bpe(f.read()).encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [e.ids for e in library(path, texts)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encode_and_decode(spark, texts, path):
    encoded = bpe.encode_documents(documents(spark, texts), path)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert [got[i] for i in range(len(texts))] == [e.ids for e in library(path, texts)]
    if path == WORD:
        shown = {r.doc_id: r.text for r in bpe.decode_documents(encoded, path).collect()}
        tokenizer = Tokenizer.from_file(path)
        assert all(shown[i] == tokenizer.decode(got[i], skip_special_tokens=False) for i in got)


def test_digests(spark, texts):
    tokenizer = Tokenizer.from_file(WORD)
    for r in bpe.digest_documents(documents(spark, texts), WORD).collect():
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_merges_of_one_pair_beside_each_other():
    ranks = {(1, 1): (0, 2), (2, 2): (1, 3), (2, 1): (2, 4)}
    assert bpe.merge_all([[1] * 7, [], [1], [2, 1, 1]], ranks) == [[3, 4], [], [1], [3]]


def test_merges_out_of_order_are_refused():
    text = '{"added_tokens": [], "normalizer": null, "model": {"vocab": {"a": 0, "b": 1, "ab": 2, "abb": 3}, "merges": ["ab b", "a b"]}}'
    with pytest.raises(ValueError):
        bpe.Bpe(text)


def test_token_files(spark, texts, tmp_path):
    docs = documents(spark, texts).repartition(5)
    docs = docs.unionByName(docs.where("doc_id = 30")).unionByName(docs.where("doc_id = 31").selectExpr("null doc_id", *docs.columns[1:]))
    folder = f"file://{tmp_path}/files"
    token_files.write_token_files(docs, BYTE, folder, end_id=2, partitions=4)
    rows = token_files.read_token_files(spark, folder).collect()
    want = [e.ids + [2] for e in library(BYTE, texts)]
    order = [*range(31), 30, *range(31, len(texts)), None]
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == order
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start and r.ids == want[31 if r.doc_id is None else r.doc_id]
        start += r.n_tokens
    sums = {r.start: r.ids_crc32 for r in token_files.digest_token_files(spark, folder).collect()}
    assert sums == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows}


def test_token_counts(spark, texts):
    got = {r.doc_id: r for r in token_counts.count_tokens(documents(spark, texts), WORD).collect()}
    for i, e in enumerate(library(WORD, texts)):
        assert got[i].n_tokens == len(e.ids) and got[i].n_bytes == len((texts[i] or "").encode())
        assert got[i].over_limit == (len(e.ids) > 2048)


def test_empty_tables(spark, tmp_path):
    docs = documents(spark, ["a"]).where("false")
    assert bpe.digest_documents(docs, WORD).count() == 0
    assert token_counts.count_tokens(docs, WORD).count() == 0
    token_files.write_token_files(docs, BYTE, f"file://{tmp_path}/none", end_id=2)
    assert token_files.read_token_files(spark, f"file://{tmp_path}/none").count() == 0


def test_queries_read_whole_tables(spark, sf_dir):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    words_of, bytes_of = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    counts = {r.doc_id: r.n_tokens for r in llm.op5_token_counts(spark, sf_dir).collect()}
    digests = {r.doc_id: r.n_tokens for r in llm.op3_bpe(spark, sf_dir).collect()}
    assert counts == digests == {i: len(words_of.encode(t, add_special_tokens=False).ids) for i, t in rows.items()}
    files = {r.doc_id: r for r in llm.op4_token_files(spark, sf_dir).collect()}
    start = 0
    for i in sorted(rows):
        ids = [*bytes_of.encode(rows[i], add_special_tokens=False).ids, 2]
        assert (files[i].start, files[i].n_tokens, files[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
