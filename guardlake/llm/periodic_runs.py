"""Periodic runs of words, found by catching squares while words are appended."""

from collections import defaultdict
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import functions as F

from guardlake.llm.hashing import blocks, ranges, utf8
from guardlake.llm.spans import covered

#: Bytes of text whose words form one stream, and words appended at a time.
SLICE, CHUNK = 1 << 20, 1 << 15
#: Word pairs compared at once when caught squares are checked.
CHECKED = 1 << 20

RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, strongest {RUN}, text string"


class _Grown:
    """Array that grows at its end."""

    def __init__(self, dtype):
        self._buffer, self.size = np.empty(1024, dtype), 0

    def append(self, values):
        need = self.size + len(values)
        if need > len(self._buffer):
            bigger = np.empty(max(need, 2 * len(self._buffer)), self._buffer.dtype)
            bigger[: self.size] = self.values
            self._buffer = bigger
        self._buffer[self.size : need] = values
        self.size = need

    @property
    def values(self):
        return self._buffer[: self.size]


def _blend(a, b):
    """32-bit print of two prints, one after the other."""
    x = a * np.uint32(0x9E3779B1) + b
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    x ^= x >> np.uint32(13)
    return x


class SquareCatcher:
    """Squares of a stream of word numbers, caught while words are appended.

    Level k has the completed blocks of 2^k words.  Each block is a catcher of the
    squares whose second half has it as its first whole block; their periods lie
    between 2^(k+1)-1 and 2^(k+2)-2.  It looks for itself at these distances;
    catchers in a row that hold at the same distance are one stretch.  An open
    stretch moves on with the words appended; when it ends, its suffixes beyond
    the blocks are compared by prints of halving lengths, and if it is as long as
    its period its squares, checked word by word, are one run.

    A word takes some 8 + 4 bytes a level.  ``longest`` is the longest period
    looked for.
    """

    def __init__(self, longest):
        self.longest = max(1, longest)
        self.levels = (self.longest + 1).bit_length() - 1
        self.pad = 1 << (self.levels + 2)
        self.words = _Grown(np.int64)
        self.prints = [_Grown(np.uint32) for _ in range(self.levels)]
        self.done = [self.pad >> k for k in range(self.levels)]
        none = np.zeros(0, np.int64)
        self.open = [(none, none) for _ in range(self.levels)]
        self.starts, self.ends, self.periods = none, none, none
        self._grow(-1 - np.arange(self.pad))  # words that equal no other

    def _grow(self, words):
        self.words.append(words)
        low = words.astype(np.uint32)
        self.prints[0].append(_blend(low, (words >> 32).astype(np.uint32)))
        for below, prints, half in zip(self.prints, self.prints[1:], (1 << t for t in range(self.levels))):
            new = below.values[prints.size :]
            if len(new) > half:
                prints.append(_blend(new[:-half], new[half:]))

    def append(self, words):
        """Take further words (numbers from 0, or -2^62 and below for separators that occur once)."""
        self._grow(np.asarray(words, np.int64))
        for k in range(self.levels):
            self._catch(k)

    def finish(self):
        """End the stream; returns start, length and period of every run (two periods at least), by start and period."""
        for k in range(self.levels):
            p, a = self.open[k]
            self._judge(k, p, a, np.full(len(p), self.done[k] << k))
        order = np.lexsort((self.periods, self.ends, self.starts))
        s, e, p = self.starts[order], self.ends[order], self.periods[order]
        # A stretch has its smallest period first; multiples of it give the same stretch.
        first = np.ones(len(s), bool)
        first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
        s, e, p = s[first], e[first], p[first]
        order = np.lexsort((p, s))
        return (s - self.pad)[order], (e - s)[order], p[order]

    def _catch(self, k):
        size, width = 1 << k, 2 << k
        first, last = self.done[k], self.words.size >> k
        if first == last:
            return
        prints = self.prints[k].values
        reach = 2 * width - 2
        step = prints.itemsize
        behind = as_strided(prints[first * size - reach :], (last - first, width), (size * step, step))
        hits = np.flatnonzero(behind == prints[first * size : last * size : size, None])
        block, p = hits // width + first, reach - hits % width
        use = p <= self.longest
        block, p = block[use], p[use]
        order = np.lexsort((block, p))
        block, p = block[order], p[order]
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1]) | (block[1:] != block[:-1] + 1)
        at = np.flatnonzero(new)
        a, b, p = block[at] * size, (block[np.append(at[1:] - 1, len(new) - 1)] + 1) * size if len(at) else block[at], p[at]
        open_p, open_a = self.open[k]
        place = np.minimum(np.searchsorted(open_p, p), max(0, len(open_p) - 1))
        goes_on = (a == first * size) & (open_p[place] == p) if len(open_p) else np.zeros(len(p), bool)
        a[goes_on] = open_a[place[goes_on]]
        ended = np.ones(len(open_p), bool)
        ended[place[goes_on]] = False
        still = b == last * size
        self.open[k] = (p[still], a[still])  # in the order of p
        self.done[k] = last
        self._judge(
            k,
            np.concatenate([open_p[ended], p[~still]]),
            np.concatenate([open_a[ended], a[~still]]),
            np.concatenate([np.full(ended.sum(), first * size), b[~still]]),
        )

    def _judge(self, k, p, a, b):
        """Stretches [a, b) of blocks that equal what lies p words before: keep those that hold a square."""
        if not len(p):
            return
        a, b = a.copy(), b.copy()
        for t in range(k - 1, -1, -1):  # less than a block remains on either side
            prints, half = self.prints[t].values, 1 << t
            a -= half * (prints[a - half] == prints[a - half - p])
            at = np.minimum(b, len(prints) - 1)
            b += half * ((b + half <= self.words.size) & (prints[at] == prints[at - p]))
        square = b - a >= p
        s, e, p = (a - p)[square], b[square], p[square]
        fresh = ~self._multiples(s, e, p)
        self._keep(s[fresh], e[fresh], p[fresh])

    def _multiples(self, s, e, p):
        """Which stretches lie in a run whose period divides theirs."""
        if not len(self.starts) or not len(s):
            return np.zeros(len(s), bool)
        order = np.lexsort((-self.periods, self.ends, self.starts))
        starts, ends, periods = self.starts[order], self.ends[order], self.periods[order]
        farthest = np.maximum.accumulate(ends)
        # The run that reaches farthest among those begun; two that both hold a stretch have one root.
        owner = np.maximum.accumulate(np.where(ends == farthest, np.arange(len(ends)), 0))
        place = np.searchsorted(starts, s, "right") - 1
        which = owner[np.maximum(place, 0)]
        return (place >= 0) & (ends[which] >= e) & (p % periods[which] == 0)

    def _keep(self, s, e, p):
        """Compare the words themselves and add what is equal throughout."""
        words, found = self.words.values, []
        lengths = e - s - p
        upto = np.cumsum(lengths)
        for part in np.split(np.arange(len(s)), np.flatnonzero(np.diff(upto // CHECKED)) + 1):
            if not len(part):
                continue
            at = ranges(s[part] + p[part], lengths[part])
            equal = words[at] == words[at - np.repeat(p[part], lengths[part])]
            begins = np.cumsum(lengths[part]) - lengths[part]
            whole = np.logical_and.reduceat(equal, begins)
            found.append(np.stack([s[part], e[part], p[part]])[:, whole])
            for i in np.flatnonzero(~whole):  # equal prints of unequal words
                own = equal[begins[i] : begins[i] + lengths[part][i]]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                for x, y in edges.reshape(-1, 2):
                    if y - x >= p[part][i]:
                        start = s[part][i]
                        found.append(np.array([[start + x], [start + p[part][i] + y], [p[part][i]]]))
        if found:
            s, e, p = np.concatenate([[self.starts, self.ends, self.periods], *found], axis=1)
            self.starts, self.ends, self.periods = s, e, p


def runs_of(documents, exponent=4, shortest=6):
    """Runs of documents given as lists of words: document, start, length, period (by document, start, period).

    The words of all are appended to one stream, a word that equals no other after each.
    """
    number = defaultdict(count().__next__)
    sizes = np.array([len(d) for d in documents], np.int64)
    total = int(sizes.sum())
    words = np.fromiter(map(number.__getitem__, (w for d in documents for w in d)), np.int64, total)
    stream = np.empty(total + len(sizes), np.int64)
    firsts = np.cumsum(sizes + 1) - sizes - 1
    stream[ranges(firsts, sizes)] = words
    stream[firsts + sizes] = -(1 << 62) - np.arange(len(sizes))
    catcher = SquareCatcher(int(sizes.max(initial=0)) // exponent)
    for at in range(0, len(stream), CHUNK):
        catcher.append(stream[at : at + CHUNK])
    start, length, period = catcher.finish()
    long = length >= np.maximum(shortest, exponent * period)
    start, length, period = start[long], length[long], period[long]
    owner = np.searchsorted(firsts, start, "right") - 1
    return owner, start - firsts[owner], length, period


def _struct(start, length, period):
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])


def _marked(doc_ids, texts, exponent, shortest):
    """Record batch by SCHEMA."""
    documents = [t.split() for t in texts]  # bytes split at blanks and 0x09-0x0D
    sizes = pa.array([len(d) for d in documents], pa.int64())
    owner, start, length, period = runs_of(documents, exponent, shortest)
    bounds = np.searchsorted(owner, np.arange(len(documents) + 1))
    best = [None] * len(documents)
    for d in np.unique(owner).tolist():
        own = slice(bounds[d], bounds[d + 1])
        triples = list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist()))
        s, n, p = max(triples, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
        best[d] = {"start": s, "length": n, "period": p}
        out = covered(len(documents[d]), start[own] + period[own], start[own] + length[own])
        documents[d] = [w for w, gone in zip(documents[d], out.tolist()) if not gone] if out.any() else documents[d]
    runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), _struct(start, length, period))
    text = pa.array([b" ".join(d) for d in documents], pa.binary()).cast(pa.string())
    columns = [doc_ids, sizes, runs, pa.array(best, _struct([], [], []).type), text]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "strongest", "text"])


def collapse_runs(docs, exponent=4, shortest=6, doc_id="doc_id", text="text"):
    """Periodic runs of words of each document, and its text with each run cut to one period.

    Words are maximal stretches of bytes other than blank and 0x09-0x0D.  A run is
    a stretch of words with smallest period q and at least ``max(shortest,
    exponent * q)`` words that no neighbouring word extends; ``exponent`` is 2 at
    least.  Returns doc_id, n_words, runs by start and period, ``strongest`` (the
    run of greatest length by period, then of smallest start, then of smallest
    period; null without a run), and text: the words left, joined by one blank,
    when those of every run after its first q words are taken out.

    A document is worked on by itself in one task, whatever keys repeat; nothing
    is shuffled.  Defined cases: a null text counts as empty (no words, empty
    text); rows with equal or null ids are documents of their own; other columns
    are left out; the empty table gives no rows.  A task holds one slice of about
    1 MiB of text, or one longer document, at some 100 bytes a word.
    """
    if exponent < 2:
        raise ValueError("exponent is 2 at least")
    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def mark(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets, SLICE, each=64):
                texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(a, b)]
                yield _marked(batch.column("doc_id").slice(a, b - a), texts, exponent, shortest)

    return slim.mapInArrow(mark, SCHEMA)
