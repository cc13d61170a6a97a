"""Cutting texts into pre-tokens and grouping equal ones, on arrays.

Two public patterns are known, by name.  ``word`` is lower-cased
``'s|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+`` with white space dropped;
``byte`` is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Assigned characters up to U+2FFF take the array path; a piece with others is cut by
the tokenizers library's own normalizer and pre-tokenizer.
"""

import re
import unicodedata
from functools import cache

import numpy as np
import regex

from guardlake.llm.hashing import PrefixHash, groups, ranges

LIMIT = 0x3000
SPACE, LETTER, NUMBER, OTHER = range(4)
APOSTROPHE = ord("'")


@cache
def classes():
    """Class of each character below the limit."""
    found = np.full(LIMIT, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        test = regex.compile(pattern)
        for c in range(LIMIT):
            if test.match(chr(c)):
                found[c] = kind
    return found


def lowered(piece):
    """The ``word`` normalisation but for white space, which is dropped anyway."""
    if not piece.isascii():
        # Letter by letter: a final capital sigma is no special case.
        piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
    return piece.lower()


@cache
def _odd():
    """Characters past the tables, or that not every version of Unicode knows."""
    new = [c for c in range(LIMIT) if unicodedata.category(chr(c)) == "Cn"]
    return re.compile("[" + "".join(map(chr, new)) + chr(LIMIT) + "-\U0010ffff]")


def plain(piece):
    """Whether the array path knows all characters."""
    return piece.isascii() or _odd().search(piece) is None


def _contractions(cps, kinds, candidates, ends):
    """Length of the contraction after each candidate apostrophe, 0 for none."""
    n = len(cps)
    one = np.where(candidates + 1 < ends, cps[np.minimum(candidates + 1, n - 1)], 0)
    two = np.where(candidates + 2 < ends, cps[np.minimum(candidates + 2, n - 1)], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(one), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    return np.where(short, 1, np.where(long, 2, 0))


def _runs(kinds, piece_starts, single_numbers):
    """Starts of the runs of one class within a piece."""
    new = np.ones(len(kinds), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    if single_numbers:
        new |= kinds == NUMBER
    new[piece_starts[piece_starts < len(kinds)]] = True
    return np.flatnonzero(new)


def cut_words(cps, bounds):
    """Starts and ends of the ``word`` pre-tokens of pieces [bounds[i], bounds[i + 1])."""
    kinds = classes()[cps]
    starts = _runs(kinds, bounds[:-1], True)
    ends = np.append(starts[1:], len(cps))
    kind = kinds[starts]
    lone = np.flatnonzero((kind == OTHER) & (ends - starts == 1) & (cps[starts] == APOSTROPHE))
    if len(lone):
        limits = bounds[np.searchsorted(bounds, starts[lone], "right")]
        more = _contractions(cps, kinds, starts[lone], limits)
        lone, more = lone[more > 0], more[more > 0]
        ends[lone] += more
        starts[lone + 1] += more
    keep = (kind != SPACE) & (ends > starts)
    return starts[keep], ends[keep]


def cut_bytes(cps, bounds):
    """Starts and ends of the ``byte`` pre-tokens of pieces [bounds[i], bounds[i + 1])."""
    kinds = classes()[cps]
    starts = _runs(kinds, bounds[:-1], False)
    ends = np.append(starts[1:], len(cps))
    kind = kinds[starts]
    limits = bounds[np.searchsorted(bounds, starts, "right")]
    # A run of white space gives its last character away: a blank goes to what
    # follows, another character stands alone.  At the end of a piece it stays whole.
    followed = np.flatnonzero((kind == SPACE) & (ends < limits))
    last = ends[followed] - 1
    blank = cps[last] == ord(" ")
    lent = np.zeros(len(starts), bool)
    lent[followed[blank] + 1] = True
    alone = followed[~blank & (ends[followed] - starts[followed] > 1)]
    lone = np.flatnonzero((kind == OTHER) & (ends - starts == 1) & (cps[starts] == APOSTROPHE) & ~lent)
    more = _contractions(cps, kinds, starts[lone], limits[lone]) if len(lone) else np.zeros(0, np.int64)
    lone, more = lone[more > 0], more[more > 0]
    shifted = starts.copy()
    shifted[lent] -= 1
    ends[followed] -= 1
    ends[followed[~blank & (ends[followed] == starts[followed])]] += 1
    ends[lone] += more
    shifted[lone + 1] += more
    keep = ends > shifted
    extra = last[np.isin(followed, alone)]
    starts = np.concatenate([shifted[keep], extra])
    ends = np.concatenate([ends[keep], extra + 1])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


@cache
def byte_pattern():
    """The ``byte`` pattern for plain pieces, its classes written out below the limit."""

    def members(kind):
        at = np.flatnonzero(classes() == kind)
        first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        last = np.append(first[1:], len(at)) - 1
        return "".join(f"\\u{at[a]:04x}-\\u{at[b]:04x}" for a, b in zip(first, last))

    space, letter, number = (members(k) for k in (SPACE, LETTER, NUMBER))
    # Contractions begin with an apostrophe and words do not, so words may be tried first.
    return re.compile(
        f" ?[{letter}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def decoded(cps, starts, ends):
    """The substrings as a list of str."""
    lengths = ends - starts
    text = cps[ranges(starts, lengths)].tobytes().decode("utf-32-le", "surrogatepass")
    stops = np.cumsum(lengths).tolist()
    return [text[a:b] for a, b in zip([0, *stops], stops)]


def distinct(cps, starts, ends):
    """Distinct substrings as str, and for each substring its number among them.

    Equal hashes are checked character by character; a hash that two strings
    share, however unlikely, is settled by comparing the strings themselves.
    """
    if not len(starts):
        return [], np.zeros(0, np.int64)
    order, firsts, group = groups(PrefixHash(cps).of(starts, ends))
    inverse = np.empty(len(order), np.int64)
    inverse[order] = group
    chosen = order[firsts]
    lengths = ends - starts
    same = lengths[chosen][inverse] == lengths
    if same.all():
        same = np.array_equal(cps[ranges(starts[chosen][inverse], lengths)], cps[ranges(starts, lengths)])
    else:
        same = False
    if same:
        return decoded(cps, starts[chosen], ends[chosen]), inverse
    numbers = {}
    inverse = np.array([numbers.setdefault(w, len(numbers)) for w in decoded(cps, starts, ends)])
    return list(numbers), inverse


def points(pieces):
    """Code points of the pieces and where each begins."""
    bounds = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)), out=bounds[1:])
    return np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32), bounds
