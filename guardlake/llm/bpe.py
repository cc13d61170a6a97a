"""BPE encoding and decoding with a pair occurrence index."""

import hashlib
import heapq
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from guardlake.llm import words as W

#: Characters of text that are cut and grouped at once, and pre-tokens a worker remembers.
SLICE, MEMORY = 1 << 20, 600_000
# Spark's tasks are the parallel part; the library's own threads would only contend.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def byte_letters():
    """Printable character that stands for each byte: a printable Latin-1 byte for itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


LETTERS = byte_letters()


def merge_all(sequences, ranks):
    """Apply the merges to all sequences of token ids; ``ranks`` maps a pair to (rank, merged id).

    The sequences lie in one array, linked left and right.  An index maps each
    pair to its positions; ranks are taken in ascending order, a pair's positions
    from left to right, and the pairs beside a merge are added to the index.  A
    merge can only make pairs of higher rank (checked when a tokenizer is read),
    so this gives what merging each sequence by itself gives.
    """
    ids, left, right = [], [], []
    for s in sequences:
        first = len(ids)
        ids.extend(s)
        left.extend(range(first - 1, first + len(s) - 1))
        right.extend(range(first + 1, first + len(s) + 1))
        if s:
            left[first] = right[-1] = -1
    index = {}
    for i, r in enumerate(right):
        if r >= 0 and (pair := (ids[i], ids[r])) in ranks:
            index.setdefault(pair, []).append(i)
    active = [(ranks[p][0], p) for p in index]
    heapq.heapify(active)
    while active:
        _, pair = heapq.heappop(active)
        a, b = pair
        merged = ranks[pair][1]
        for i in sorted(index.pop(pair)):
            r = right[i]
            if ids[i] != a or r < 0 or ids[r] != b:
                continue  # one of the two went into an earlier merge
            ids[i], ids[r] = merged, -1
            right[i] = after = right[r]
            if after >= 0:
                left[after] = i
            before = left[i]
            for at, new in ((before, (ids[before], merged) if before >= 0 else None), (i, (merged, ids[after]) if after >= 0 else None)):
                if new in ranks:
                    if new not in index:
                        index[new] = []
                        heapq.heappush(active, (ranks[new][0], new))
                    index[new].append(at)
    out, at = [], 0
    for s in sequences:
        out.append([x for x in ids[at : at + len(s)] if x >= 0])
        at += len(s)
    return out


class Bpe:
    """A tokenizer file of the tokenizers library with byte-level letters, read as data.

    Pre-tokens are merged here by the pair index or, ``by_library``, by the library.
    """

    def __init__(self, text, by_library=False):
        spec = json.loads(text)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.names = {i: t for t, i in [*self.vocab.items(), *self.specials.items()]}
        self.lower = spec["normalizer"] is not None
        self.ranks, made = {}, {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            merged = self.vocab[a + (b if not self.suffix or not a.endswith(self.suffix) else "")]
            if merged in made:
                raise ValueError("two merges make the same token")
            made[merged] = rank
            self.ranks[self.vocab[a], self.vocab[b]] = (rank, merged)
        if any(made.get(x, -1) >= rank for pair, (rank, _) in self.ranks.items() for x in pair):
            raise ValueError("merges are not in the order in which they were learned")
        self.decoder = (spec.get("decoder") or {}).get("type")
        self.library, self.by_library = Tokenizer.from_str(text), by_library
        self.known, self.before, self.raw = {}, {}, {}

    def symbols(self, word):
        """Ids of the single letters of a pre-token."""
        letters = [LETTERS[b] for b in word.encode("utf-8", "surrogatepass")]
        letters[-1] += self.suffix
        return [self.vocab[x] for x in letters]

    def encode_words(self, words):
        """Ids of each pre-token, from the worker's memory or by merging all new ones together.

        The memory has two halves; when the newer one is full, the older is forgotten,
        so pre-tokens in use stay.
        """
        if len(self.known) > MEMORY // 2:
            self.known, self.before = {}, self.known
        known, before, missing = self.known, self.before, []
        for w in words:
            if w not in known:
                if w in before:
                    known[w] = before[w]
                else:
                    missing.append(w)
        if self.by_library:
            new = [e.ids for e in self.library.encode_batch_fast(missing, add_special_tokens=False)]
        else:
            new = merge_all([self.symbols(w) for w in missing], self.ranks)
        known.update(zip(missing, new))
        return [known[w] for w in words]

    def library_ids(self, words):
        """Flat ids of pre-tokens as the library's model merges them, and how many each has; a tuple stands for itself."""
        tokenize, flat, counts = self.library.model.tokenize, [], []
        for w in words:
            if isinstance(w, tuple):
                ids = w
            else:
                # Bytes as the letters that stand for them.
                ids = [t.id for t in tokenize(w.encode("utf-8", "surrogatepass").decode("latin-1").translate(LETTERS))]
            flat += ids
            counts.append(len(ids))
        return np.array(flat, np.int64), np.array(counts, np.int64)

    def split_specials(self, text):
        """Pieces of text, and between them the ids of special strings."""
        pieces, found = [text], []
        if any(s in text for s in self.specials):
            pieces, at, plain = [], 0, 0
            by_length = sorted(self.specials, key=len, reverse=True)
            while (at := min((i for s in by_length if (i := text.find(s, at)) >= 0), default=-1)) >= 0:
                s = next(s for s in by_length if text.startswith(s, at))
                pieces.append(text[plain:at])
                found.append(self.specials[s])
                at = plain = at + len(s)
            pieces.append(text[plain:])
        return pieces, found

    def cut(self, texts):
        """Distinct pre-tokens of the texts, and per text the numbers of its pre-tokens.

        Returns (words, numbers, bounds, specials): text i has ``numbers[bounds[i]:bounds[i + 1]]``;
        a special string counts as a word ``(id,)`` of its own.
        """
        pieces, owners, odd, marks = [], [], [], []
        for i, text in enumerate(texts):
            parts, found = self.split_specials(text)
            for j, part in enumerate(parts):
                if part and W.plain(part):
                    pieces.append(W.lowered(part) if self.lower else part)
                    if not W.plain(pieces[-1]):
                        odd.append((i, 2 * j, part))
                        pieces.pop()
                    else:
                        owners.append((i, 2 * j))
                elif part:
                    odd.append((i, 2 * j, part))
                if j < len(found):
                    marks.append((i, 2 * j + 1, found[j]))
        cps, bounds = W.points(pieces)
        starts, ends = (W.cut_words if self.lower else W.cut_bytes)(cps, bounds) if len(cps) else (bounds[:0], bounds[:0])
        words, inverse = W.distinct(cps, starts, ends)
        piece = np.searchsorted(bounds, starts, "right") - 1
        owners = np.array(owners, np.int64).reshape(-1, 2)
        owner = owners[piece] if len(piece) else owners[:0]
        if odd or marks:
            number = {w: k for k, w in enumerate(words)}
            rows, more = [], []
            for i, j, part in odd:
                for w in self.odd_words(part):
                    rows.append((i, j))
                    more.append(number.setdefault(w, len(number)))
            for i, j, special in marks:
                rows.append((i, j))
                more.append(number.setdefault((special,), len(number)))
            words = list(number)
            owner = np.concatenate([owner, np.array(rows, np.int64).reshape(-1, 2)])
            inverse = np.concatenate([inverse, np.array(more, np.int64)])
            order = np.lexsort((owner[:, 1], owner[:, 0]))
            owner, inverse = owner[order], inverse[order]
        at = np.searchsorted(owner[:, 0], np.arange(len(texts) + 1)) if len(owner) else np.zeros(len(texts) + 1, np.int64)
        return words, inverse, at

    def odd_words(self, piece):
        """Pre-tokens of a piece with characters past the array tables, as the library cuts them."""
        if self.library.normalizer is not None:
            piece = self.library.normalizer.normalize_str(piece)
        back = {c: b for b, c in enumerate(LETTERS)}
        found = self.library.pre_tokenizer.pre_tokenize_str(piece)
        return [bytes(back[c] for c in w).decode("utf-8", "surrogatepass") for w, _ in found]

    def ids_of(self, words):
        """Ids of each word that :meth:`cut` gave; a tuple stands for itself."""
        if not any(isinstance(w, tuple) for w in words[-len(self.specials) :]):
            return self.encode_words(words)
        plain = [w for w in words if not isinstance(w, tuple)]
        known = dict(zip(plain, self.encode_words(plain)))
        return [list(w) if isinstance(w, tuple) else known[w] for w in words]

    def encode(self, texts):
        """Flat ids and offsets for the texts."""
        words, numbers, bounds = self.cut(texts)
        ids = self.ids_of(words)
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.array([x for one in ids for x in one], np.int64)
        begins = np.concatenate([[0], np.cumsum(lengths)])[:-1] if len(ids) else lengths
        per_word = lengths[numbers] if len(ids) else np.zeros(0, np.int64)
        out = flat[W.ranges(begins[numbers], per_word)] if len(ids) else flat
        upto = np.concatenate([[0], np.cumsum(per_word)])
        return out, upto[bounds]

    def shown(self, ids):
        """What the file's decoder makes of a run of ids, for :meth:`joined`.

        Without a decoder the library joins the tokens by blanks; the byte-level
        one maps letters back to bytes and leaves a token with other letters as it is.
        """
        if self.decoder is None:
            return " ".join([self.names[i] for i in ids])
        if self.decoder != "ByteLevel":
            raise ValueError(f"decoder {self.decoder} is not supported")
        if not self.raw:
            back = {c: b for b, c in enumerate(LETTERS)}
            self.raw = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for i, t in self.names.items()}
        return b"".join([self.raw[i] for i in ids])

    def joined(self, parts):
        """Text of consecutive runs; bytes that are no UTF-8 are replaced, as the library does."""
        return " ".join(parts) if self.decoder is None else b"".join(parts).decode("utf-8", "replace")

    def decode(self, ids):
        """Text of the ids."""
        return self.joined([self.shown(ids)])


_READ = {}


def bpe(text, by_library=False):
    """The tokenizer of that file text, built once per worker."""
    key = hashlib.sha256(text.encode()).hexdigest(), by_library
    if key not in _READ:
        _READ[key] = Bpe(text, by_library)
    return _READ[key]


def slices(texts, size=SLICE):
    """Runs of texts of about ``size`` characters."""
    first, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def shared_text(spark, path):
    """The tokenizer file, one or two MB, for all executors."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _selected(docs, doc_id, text):
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def encode_documents(docs, tokenizer_path, doc_id="doc_id", text="text"):
    """(doc_id, ids): the ids of every whole text, without added special tokens.

    A null text counts as empty and gets an empty list; rows with the same or a
    null id are encoded each for itself; other columns are left out.
    """
    spec = shared_text(docs.sparkSession, tokenizer_path)

    def encode(batches):
        model = bpe(spec.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                ids, bounds = model.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), lists], ["doc_id", "ids"])

    return _selected(docs, doc_id, text).mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded, tokenizer_path):
    """(doc_id, text) from (doc_id, ids), special tokens included; an empty or null list gives an empty text."""
    spec = shared_text(encoded.sparkSession, tokenizer_path)

    def decode(batches):
        model = bpe(spec.value)
        for batch in batches:
            texts = [model.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def digest_documents(docs, tokenizer_path, doc_id="doc_id", text="text"):
    """Encode and decode every document and return digests of both, without shuffling ids.

    n_tokens, ids_sha256 (decimal ids joined by a blank), decoded_sha256.  Cases as
    in :func:`encode_documents`.
    """
    spec = shared_text(docs.sparkSession, tokenizer_path)

    def digest(batches):
        model = bpe(spec.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                words, numbers, bounds = model.cut(texts[a:b])
                ids = model.ids_of(words)
                # A text's numerals and what it shows are the join of its words'.
                numerals = [" ".join(map(str, x)) for x in ids]
                shown = [model.shown(x) for x in ids]
                lengths = np.concatenate([[0], np.cumsum(np.array([len(x) for x in ids], np.int64)[numbers])]) if ids else np.zeros(1, np.int64)
                counts = np.diff(lengths[bounds])
                numbers = numbers.tolist()
                first, second = [], []
                for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = numbers[s:e]
                    first.append(hashlib.sha256(" ".join([numerals[k] for k in own]).encode()).hexdigest())
                    second.append(hashlib.sha256(model.joined([shown[k] for k in own]).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()), pa.array(first), pa.array(second)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return _selected(docs, doc_id, text).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
