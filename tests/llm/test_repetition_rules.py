"""Repetition rules against brute force."""

import random
import re
from collections import Counter

import numpy as np
from guardlake.llm import queries as llm
from guardlake.llm import repetition_rules

from tests.llm.cases import AWKWARD, documents, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    chars = [len(w) for w in words]
    found = {"n_words": len(words), "word_chars": sum(chars), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    seen, lines = set(), []
    for line in text.split("\n"):
        bare = re.sub(r"[\x20\x09-\x0D]", "", line)
        if bare and line in seen:
            lines.append(len(bare))
        seen.add(line)
    found |= {"n_dup_lines": len(lines), "dup_line_chars": sum(lines)}
    for n in range(5, 11):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        times, before, again, two = Counter(grams), set(), set(), set()
        for i, g in enumerate(grams):
            again |= set(range(i, i + n)) if g in before else set()
            two |= set(range(i, i + n)) if times[g] > 1 else set()
            before.add(g)
        found[f"dup_{n}gram_chars"] = sum(chars[i] for i in again)
        if n == 8:
            found["n_repeat_words"] = len(two)
    found["base_failed"] = len(words) < 20 or 100 * found["n_repeat_words"] > 30 * len(words)
    limits = {"dup_line_chars": 20, **{f"dup_{n}gram_chars": 20 - n for n in range(5, 11)}}
    found["kept"] = not found["base_failed"] and all(100 * found[c] <= p * sum(chars) for c, p in limits.items())
    return found


def texts_with_repeats(seed, n):
    rng, texts = random.Random(seed), []
    for _ in range(n):
        lines = [prose(rng, rng.randint(0, 14)) for _ in range(rng.randint(0, 9))]
        lines += [rng.choice(lines) for _ in range(rng.randint(0, 4)) if lines]
        rng.shuffle(lines)
        text = rng.choice(["\n", " ", "\r\n", "\n\n"]).join(lines)
        if text and rng.random() < 0.5:
            a = rng.randrange(len(text))
            text += " " + text[a : a + rng.randint(1, 400)]
        texts.append(text)
    return texts


def same(found, texts):
    for i, text in enumerate(texts):
        want = brute(text)
        assert {c: int(found[c][i]) for c in found} == {c: want[c] for c in found}, text


def test_measures_of_texts():
    texts = texts_with_repeats(21, 300) + [t or "" for t in AWKWARD] + ["a " * 500, "1 2 3 4 5 6 7 8 9 " * 40]
    for step in (7, len(texts)):
        for i in range(0, len(texts), step):
            same(repetition_rules.measure_texts([t.encode() for t in texts[i : i + step]]), texts[i : i + step])
    assert all(len(v) == 0 for v in repetition_rules.measure_texts([]).values())


def test_equal_hashes_of_unequal_grams(monkeypatch):
    monkeypatch.setattr(repetition_rules, "mix", lambda x: x % np.uint64(2))
    texts = texts_with_repeats(22, 60)
    same(repetition_rules.measure_texts([t.encode() for t in texts]), texts)


def test_query_and_awkward_rows(spark, tmp_path):
    texts = AWKWARD + texts_with_repeats(23, 60) + ["x " * 3000, "long line " * 3000]
    docs = documents(spark, texts).withColumnRenamed("norm", "kept").withColumnRenamed("row", "n_words")
    docs = docs.union(docs.selectExpr("null", *[f"`{c}`" for c in docs.columns[1:]])).union(docs)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = llm.op12_repetition_rules(spark, str(tmp_path))
    want = [{"doc_id": r.doc_id, **brute(r.text)} for r in docs.collect()]
    assert set(found.columns) == set(want[0])
    rows = [tuple(r[c] for c in found.columns) for r in found.collect()]
    assert sorted(rows, key=str) == sorted((tuple(w[c] for c in found.columns) for w in want), key=str)
    assert repetition_rules.repetition(docs.where("false")).count() == 0


def test_other_rules(spark):
    docs = documents(spark, ["one two three four five six seven eight nine ten " * 3, prose(random.Random(3), 50)])
    loose = repetition_rules.repetition(docs, gram_percent={3: 100}, line_percent=100)
    assert "dup_3gram_chars" in loose.columns and "dup_5gram_chars" not in loose.columns
    assert [r.base_failed for r in loose.orderBy("doc_id").collect()] == [True, False]
