"""Quality rules on repetition: what share of a text lies in n-grams and lines that came before."""

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from guardlake.llm.hashing import blocks, groups, mix, utf8
from guardlake.llm.spans import covered

#: Bytes of text that are measured at once.
SLICE = 1 << 20
#: A text fails if more than this percentage of its word characters lies in n-grams of so many words that came before.
GRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: The same for lines that came before.
LINE_PERCENT = 20
#: Base rules: fewest words, and percentage of words in windows of ``WINDOW`` words found twice or more.
FEWEST_WORDS, WINDOW, WINDOW_PERCENT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """N-grams of many texts at once, by rolling hashes; equal hashes are compared word by word."""

    def __init__(self, words, owner):
        """Numbers of the words of all texts, and the text of each."""
        self.words, self.owner = words, owner
        self.values = mix(words.astype(np.uint64) + np.uint64(1))
        self.salt = mix(owner.astype(np.uint64) + np.uint64(1 << 40))
        # Every window begins as a candidate; a longer one can only repeat if both windows in it do.
        self.n, self.hash, self.repeated = 1, self.values, None

    def of(self, n):
        """(starts of the n-grams that occur twice or more in their text, which of them occurred earlier).

        Lengths have to ascend.
        """
        while self.n < n:
            self.hash = self.hash[:-1] * _BASE + self.values[self.n :] if len(self.hash) else self.hash
            self.n += 1
        total = len(self.hash)
        if self.repeated is None:
            at = np.flatnonzero(self.owner[:total] == self.owner[n - 1 :][:total])
        else:
            size, before = n - self.size, self.repeated
            known = np.zeros(len(self.words) + 1, bool)
            known[before] = True
            at = before[(before < total)]
            at = at[known[at + size] & (self.owner[at] == self.owner[at + n - 1])]
        order, firsts, _ = groups(self.hash[at] ^ self.salt[at])
        sizes = np.diff(np.append(firsts, len(order)))
        first_of = np.repeat(order[firsts], sizes)
        later = order != first_of
        a, b = at[order[later]], at[first_of[later]]
        if not self._same(a, b, n):  # equal hashes of unequal n-grams
            columns = [self.words[at + j] for j in range(n)]
            order, firsts, _ = groups(self.owner[at], *columns)
            sizes = np.diff(np.append(firsts, len(order)))
            first_of = np.repeat(order[firsts], sizes)
            later = order != first_of
        twice = np.repeat(sizes > 1, sizes)
        starts, again = at[order[twice]], later[twice]
        place = np.argsort(starts)
        self.repeated, self.size = starts[place], n
        return self.repeated, again[place]

    def _same(self, a, b, n):
        for j in range(n):
            if not np.array_equal(self.words[a + j], self.words[b + j]):
                return False
        return np.array_equal(self.owner[a], self.owner[b])


def _repeated_lines(text):
    """Lines with a word that are equal to an earlier line, and the word characters in them."""
    lines, chars, seen = 0, 0, set()
    for line in text.split(b"\n"):
        if line in seen:
            if words := line.split():
                lines += 1
                chars += len(b"".join(words).decode())
        else:
            seen.add(line)
    return lines, chars


def measure_texts(texts, lengths=tuple(GRAM_PERCENT)):
    """Measures of texts given as bytes, one array each: see :func:`repetition`."""
    number, documents = defaultdict(count().__next__), [t.split() for t in texts]
    sizes = np.array([len(d) for d in documents], np.int64)
    total, bounds = int(sizes.sum()), np.concatenate([[0], np.cumsum(sizes)])
    words = np.fromiter(map(number.__getitem__, (w for d in documents for w in d)), np.int64, total)
    chars = np.fromiter((len(w.decode()) for w in number), np.int64, len(number))[words]
    owner = np.repeat(np.arange(len(texts)), sizes)

    def per_text(values):
        return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])

    lines = np.array([_repeated_lines(t) for t in texts], np.int64).reshape(-1, 2)
    found = {
        "n_words": sizes,
        "word_chars": per_text(chars),
        "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": lines[:, 0],
        "dup_line_chars": lines[:, 1],
    }
    grams = Grams(words, owner)
    for n in sorted({*lengths, WINDOW}):
        starts, again = grams.of(n)
        if n == WINDOW:
            found["n_repeat_words"] = per_text(covered(total, starts, starts + n))
        if n in lengths:
            later = starts[again]
            found[f"dup_{n}gram_chars"] = per_text(np.where(covered(total, later, later + n), chars, 0))
    return found


def columns(lengths=tuple(GRAM_PERCENT)):
    return ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_{n}gram_chars" for n in lengths)]


def repetition(docs, gram_percent=None, line_percent=LINE_PERCENT, doc_id="doc_id", text="text"):
    """Repetition measures of each document and whether the rules keep it.

    Words are maximal stretches of bytes other than blank and 0x09-0x0D.  Returns
    doc_id, n_words, word_chars (code points in words), n_symbols (of ``SYMBOLS``),
    n_dup_lines (lines with a word, equal to an earlier line), n_repeat_words
    (words in 8-word windows found twice or more, the first included),
    dup_line_chars and dup_Ngram_chars (word characters in lines and in n-grams
    that came before; one in several n-grams counts once), base_failed (fewer than
    20 words, or more than 30 % repeat words) and kept: not base_failed, and no
    share of characters above its percentage (``gram_percent`` by number of words).

    A document is measured by itself in one task; nothing is shuffled.  Defined
    cases: a null text counts as empty, which has no words and fails; rows with
    equal or null ids are documents of their own; other columns are left out; the
    empty table gives no rows.  A task holds one slice of about 1 MiB of text, or
    one longer document, at some 150 bytes a word.
    """
    limits = dict(GRAM_PERCENT if gram_percent is None else gram_percent)
    lengths = tuple(sorted(limits))
    names = columns(lengths)
    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def measure(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets, SLICE, each=64):
                found = measure_texts([data[offsets[i] : offsets[i + 1]].tobytes() for i in range(a, b)], lengths)
                arrays = [batch.column("doc_id").slice(a, b - a), *(pa.array(found[c], pa.int64()) for c in names)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names])

    measured = slim.mapInArrow(measure, ", ".join(f"{c} long" for c in ["doc_id", *names]))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > WINDOW_PERCENT * F.col("n_words"))
    too_much = F.lit(False)
    for name, percent in [("dup_line_chars", line_percent), *((f"dup_{n}gram_chars", limits[n]) for n in lengths)]:
        too_much |= 100 * F.col(name) > percent * F.col("word_chars")
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~too_much)
