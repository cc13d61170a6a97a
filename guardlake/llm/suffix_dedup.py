"""Suffix-array dedup: remove repeated strings of a fixed least length.

Sorting every suffix of a corpus would move many times its bytes, so the suffixes
are first placed: among the LENGTH bytes at any position the substring of K bytes
with the smallest hash is its anchor, and neighbouring positions with one anchor
form a run.  Equal strings have equal anchors equally far behind them.  A run
whose anchor and bytes (64 bits of hash each) occurred in an earlier document is repeated
as a whole, and an anchor that occurs in one surrounding only repeats nothing.
What is left, anchors in several surroundings, is decided by the suffix sort.
"""

import numpy as np
import pyarrow as pa
from guardlake.llm.chunk_dedup import later_than_first
from guardlake.llm.hashing import PrefixHash, blocks, groups, mix, ranges, utf8
from guardlake.llm.routing import as_bytes, counts, dealt, documents, from_bytes, grown, ids_as_bytes, ids_from_bytes, in_packed_batches, shrunk
from guardlake.llm.spans import SCHEMA, covered, without
from pyspark.sql import functions as F

#: Surroundings of an anchor that a batch sends, and that all batches may send together,
#: before the anchor's strings are dealt out by their own hashes instead.
MANY_HERE, MANY = 16, 4096
#: Strings that the suffix sort takes at a time, so that its arrays stay some tens of MB.
STRINGS = 1 << 18
#: Bits of an anchor's hash that go out besides its bucket.  Anchors that agree in them only share a segment of the
#: suffix sort; a bucket has about a million entries, so few do.
KEY_BITS = 32
_PLACES = np.uint64((1 << 32) - 1)
#: Answers about a run: nothing repeated, all repeated, ask the suffix sort, ask string by string.
NEW, REPEATED, SORT, SINGLE = range(4)


# -- suffix sort ------------------------------------------------------------


def common_extension(hashes, x, y, limit):
    """Length of the longest common prefix of suffixes x and y, up to ``limit``, by binary search over prefix hashes."""
    same = np.zeros(len(x), np.int64)
    step = 1 << (int(limit).bit_length() - 1)
    while step:
        tried = same + step
        fits = np.flatnonzero(tried <= limit)
        a, b = x[fits], y[fits]
        equal = hashes.raw(a, a + tried[fits]) == hashes.raw(b, b + tried[fits])
        same[fits[equal]] = tried[fits[equal]]
        step >>= 1
    return same


def _before(text, hashes, x, y, limit, ties):
    """Whether suffix x sorts before y; equal ones count as ``ties`` says."""
    same = common_extension(hashes, x, y, limit)
    end = same >= limit
    at = np.minimum(same, limit - 1)
    return np.where(end, ties, text[x + at] < text[y + at])


def sort_suffixes(text, starts, segments, limit):
    """Stable order of the suffixes within each segment (numbers in ascending order), by their first ``limit`` bytes.

    Bottom-up mergesort of all segments together: every element finds its place in
    its sibling run by binary search, comparing through prefix hashes.  The
    sorted neighbours are then compared byte by byte; a segment that a hash
    collision put out of order is sorted by its bytes.
    """
    n = len(starts)
    order = np.arange(n)
    if n == 0:
        return order, np.zeros(0, bool)
    hashes = PrefixHash(text)
    first = np.flatnonzero(np.concatenate([[True], segments[1:] != segments[:-1]]))
    size = np.diff(np.append(first, n))
    base, count = np.repeat(first, size), np.repeat(size, size)
    place = np.arange(n) - base
    broken, width = np.zeros(n, bool), 1
    while width < size.max():
        at = np.flatnonzero(count > width)
        p, c, b = place[at], count[at], base[at]
        block = p // (2 * width) * (2 * width)
        left = p - block < width
        low = np.where(left, np.minimum(block + width, c), block)
        high = np.where(left, np.minimum(block + 2 * width, c), block + width)
        begin, own = low.copy(), starts[order[at]]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            other = starts[order[b[open_] + middle]]
            # From the left run, go behind smaller ones; from the right, behind equal ones too.
            behind = _before(text, hashes, other, own[open_], limit, ~left[open_])
            low[open_[behind]] = middle[behind] + 1
            high[open_[~behind]] = middle[~behind]
        to = b + block + np.where(left, p - block, p - block - width) + (low - begin)
        moved = order.copy()
        moved[to] = order[at]
        # Collisions can make comparisons contradict each other, and two elements take one place.
        taken = np.bincount(to, minlength=n)
        clash = at[taken[at] != 1]
        if len(clash):
            clash = np.isin(segments, segments[clash])
            moved[clash] = np.flatnonzero(clash)
            broken |= clash
        order = moved
        width *= 2
    equal, wrong = _compare_neighbours(text, starts[order], segments, limit)
    wrong |= broken
    for s in np.unique(segments[wrong]):
        a, b = np.searchsorted(segments, [s, s + 1])
        members = sorted(range(a, b), key=lambda i: (text[starts[i] : starts[i] + limit].tobytes(), i))
        order[a:b] = members
    if wrong.any():
        equal, _ = _compare_neighbours(text, starts[order], segments, limit)
    return order, equal


def _compare_neighbours(text, starts, segments, limit):
    """For each suffix in order: whether it equals the one before in its segment, and whether it is smaller than it."""
    n = len(starts)
    equal, wrong = np.zeros(n, bool), np.zeros(n, bool)
    at = np.flatnonzero(segments[1:] == segments[:-1]) + 1
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray(len(text) + 1, ">u8", padded.data, strides=(1,))
    done = 0
    while done < limit and len(at):
        use = min(8, limit - done)
        shift = np.uint64(8 * (8 - use))
        x = words[starts[at - 1] + done].astype(np.uint64) >> shift
        y = words[starts[at] + done].astype(np.uint64) >> shift
        wrong[at[x > y]] = True
        at = at[x == y]
        done += use
    equal[at] = True
    return equal, wrong


def repeated_suffixes(text, starts, segments, ids, limit):
    """Whether the first ``limit`` bytes of each suffix also start a suffix of its segment with a smaller id."""
    order = np.lexsort((ids, segments))
    starts, segments, sorted_ids = starts[order], segments[order], ids[order]
    by_text, equal = sort_suffixes(text, starts, segments, limit)
    smallest = sorted_ids[by_text][np.maximum.accumulate(np.where(equal, 0, np.arange(len(equal))))]
    found = np.zeros(len(order), bool)
    found[order[by_text]] = sorted_ids[by_text] > smallest
    return found


# -- runs of positions with one anchor ----------------------------------------


def anchor_runs(data, offsets, length, k):
    """Runs of positions with one anchor: first position, number of positions, anchor's place, anchor's and run's hash."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = PrefixHash(data)
    pieces = mix(hashes.windows(k))
    # Smallest hash, leftmost if equal: places fill the low bits.
    best = (pieces & ~_PLACES) | np.arange(len(pieces), dtype=np.uint64)
    width, most = 1, length - k + 1
    while 2 * width <= most:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < most:
        best = np.minimum(best[: len(best) - (most - width)], best[most - width :])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = np.flatnonzero(owner[: len(data) - length + 1] == owner[length - 1 :])
    if not len(whole):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    anchor = (best[whole] & _PLACES).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1] + 1)]))
    number = np.diff(np.append(first, len(whole)))
    start, anchor = whole[first], anchor[first]
    return start, number, anchor, pieces[anchor], hashes.of(start, start + number - 1 + length)


class Batch:
    """A batch of documents in order, its runs, and what it sends about them."""

    def __init__(self, table, length, k, buckets, many_here, key_bits=KEY_BITS):
        self.table = table = table.sort_by([("id", "ascending"), ("text", "ascending")])
        self.ids = np.asarray(table.column("id"))
        self.data, self.offsets = utf8(table.column("text"))
        self.length, self.buckets = length, buckets
        parts = [[] for _ in range(5)]
        for a, b in blocks(self.offsets):
            begin = self.offsets[a]
            found = anchor_runs(self.data[begin : self.offsets[b]], self.offsets[a : b + 1] - begin, length, k)
            for out, x, shift in zip(parts, found, (begin, 0, begin, None, None)):
                out.append(x if shift is None else x + shift)
        kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
        self.start, self.number, self.anchor, key, content = (
            np.concatenate([np.zeros(0, t), *p]) for p, t in zip(parts, kinds)
        )
        self.id = self.ids[np.searchsorted(self.offsets, self.start, "right") - 1]
        # One entry per surrounding of an anchor, led by its first run; the others follow it.
        order, firsts, group = groups(key, content)
        self.lead = order[firsts] if len(order) else order
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = group
        lead_key = key[self.lead]
        self.follows = self.id > self.id[self.lead][self.entry]  # in a later document than the first
        new = np.concatenate([[True], lead_key[1:] != lead_key[:-1]]) if len(lead_key) else np.zeros(0, bool)
        anchor_of = np.cumsum(new) - 1
        crowded = np.bincount(anchor_of)[anchor_of] > many_here if len(new) else new
        # Of a crowded anchor one entry goes out, without surroundings.
        sent = np.flatnonzero(~crowded | new)
        speaks_for = np.searchsorted(sent, np.arange(len(new)), "right") - 1
        # Entries go out in the order of their runs, so that ids ascend.
        entry_at = np.full(len(order), -1)
        entry_at[self.lead[sent]] = np.arange(len(sent))
        by_run = entry_at[entry_at >= 0]
        number = np.empty(len(sent), np.int64)
        number[by_run] = np.arange(len(sent))
        self.sent, self.speaks_for = sent[by_run], number[speaks_for]
        self.content = np.where(crowded, 0, content[self.lead])[self.sent]
        self.crowded = crowded
        # Anchors by bucket and by a number within it.
        self.lead_bucket = (lead_key % np.uint64(buckets)).astype(np.int64)
        self.lead_key = (lead_key // np.uint64(buckets) & np.uint64((1 << key_bits) - 1)).astype("<u4")
        self.bucket = self.lead_bucket[self.sent]
        self.order = np.argsort(self.bucket, kind="stable")

    def entries(self):
        """(bucket, [key, content, id, crowded]) as bytes."""
        crowded = self.crowded[self.sent].astype(np.uint8)
        for b, (key, content, ids, flags) in dealt(self.bucket, [self.lead_key[self.sent], self.content, self.id[self.lead[self.sent]], crowded]):
            yield b, [key.tobytes(), content.tobytes(), ids_as_bytes(ids), flags.tobytes()]

    def answers(self, given):
        """Answer for each entry from the packed answers by bucket."""
        sizes = np.bincount(self.bucket, minlength=self.buckets)
        found = np.zeros(len(self.sent), np.uint8)
        found[self.order] = np.concatenate(
            [np.zeros(0, np.uint8), *(np.frombuffer(given[b], np.uint8) for b in np.flatnonzero(sizes))]
        )
        return found[self.speaks_for] if len(found) else found

    def to_sort(self, answer):
        """Leading runs whose strings the suffix sort has to decide: those told so, by bucket and then in their order."""
        runs = np.sort(self.lead[answer == SORT])
        bucket = self.lead_bucket[self.entry[runs]]
        return runs[np.argsort(bucket, kind="stable")], np.sort(bucket)

    def singles(self, answer):
        """Strings of the runs that are dealt out one by one: position, id, and the number of each among distinct ones."""
        runs = self.lead[answer == SINGLE]
        number = self.number[runs]
        position = ranges(self.start[runs], number)
        ids = np.repeat(self.id[runs], number)
        # Hashes of the runs' own bytes only; a batch has few such runs, as a rule none.
        lengths = number - 1 + self.length
        body = self.data[ranges(self.start[runs], lengths)]
        begin = ranges(np.cumsum(lengths) - lengths, number)
        h1, h2 = (PrefixHash(body, which).of(begin, begin + self.length) for which in (0, 1))
        order = np.lexsort((position, ids, h2, h1))
        h1, h2 = h1[order], h2[order]
        new = np.ones(len(order), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return position, ids, number, h1[new], h2[new], ids[order][new]


# -- the operator --------------------------------------------------------------


def decide_entries(key, content, ids, crowded, many_at_all):
    """Answer for every entry of a bucket."""
    order = np.lexsort((ids, content, key))
    k, c, i, w = key[order], content[order], ids[order], crowded[order].astype(bool)
    new_key = np.concatenate([[True], k[1:] != k[:-1]])
    new = new_key.copy()
    new[1:] |= c[1:] != c[:-1]
    number = np.cumsum(new_key) - 1
    contents = np.bincount(number, new)[number]
    many = (np.bincount(number, w)[number] > 0) | (contents > many_at_all)
    smallest = i[np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))]
    found = np.where(contents > 1, SORT, NEW)
    found = np.where(many, SINGLE, found)
    found = np.where((i > smallest) & ~w, REPEATED, found).astype(np.uint8)
    out = np.empty(len(order), np.uint8)
    out[order] = found
    return out


def remove_repeats(docs, length=50, doc_id="doc_id", text="text", many_here=MANY_HERE, many=MANY, key_bits=KEY_BITS):
    """Remove each byte inside a ``length``-byte string that also starts in a document with a smaller id.

    (doc_id, n_bytes, spans, kept) per row, by ``spans.SCHEMA``; ``kept`` are the remaining
    bytes, which may be parts of a character.  Texts are UTF-8 bytes; strings are
    judged on the input, overlaps count and matches do not cross documents.

    Work is dealt by anchors; a batch of documents sends one entry per anchor and
    surrounding, and anchors in very many surroundings are dealt out by the
    strings themselves, so no key gathers more than a few entries per batch.
    Documents, ids and runs move compressed, and of an anchor's hash only its
    bucket and ``key_bits`` (at most 32) go out.  Equal strings agree in these;
    where different anchors do, their strings are compared like others.

    Defined cases: a null text counts as empty; null ids come after all others;
    rows with the same id do not repeat each other; the empty table gives no rows.
    """
    if length < 8:
        raise ValueError("strings of less than 8 bytes are not worth removing")
    k = max(4, length * 2 // 5)
    batches, buckets = counts(docs.sparkSession)
    pieces = in_packed_batches(docs, batches, doc_id, text)

    def rows_of(kind, key, rows):
        columns = {"a": pa.binary(), "b": pa.binary(), "ids": pa.binary(), "extra": pa.binary(), "body": pa.binary()}
        return {
            "kind": [kind] * len(rows),
            "bucket": [b for b, _ in rows],
            "batch": [key[0].as_py()] * len(rows),
            **{c: [x[i] for _, x in rows] for i, c in enumerate(columns)},
        }

    sent_schema = pa.schema(
        [("kind", pa.int32()), ("bucket", pa.int32()), ("batch", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("ids", pa.binary()), ("extra", pa.binary()), ("body", pa.binary())]
    )
    sent_ddl = "kind int, bucket int, batch int, a binary, b binary, ids binary, extra binary, body binary"
    answer_ddl = "kind int, bucket int, batch int, answer binary"

    def send(key, table):
        rows = [(b, [*x, b""]) for b, x in Batch(documents(table), length, k, buckets, many_here, key_bits).entries()]
        return pa.Table.from_pydict(rows_of(NEW, key, rows), sent_schema)

    def joined(table, column, dtype, read=from_bytes):
        parts = [read(x, dtype) for x in table.column(column).to_pylist()]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def joined_ids(table):
        return np.concatenate([ids_from_bytes(x) for x in table.column("ids").to_pylist()])

    def answered(table, sizes, found):
        ends = np.cumsum(sizes)
        parts = [found[e - s : e].tobytes() for s, e in zip(sizes, ends)]
        return pa.table({**{c: table.column(c) for c in ("kind", "bucket", "batch")}, "answer": pa.array(parts, pa.binary())})

    def decide(table):
        keys, sizes = joined(table, "a", "<u4")
        contents, _ = joined(table, "b", "<u8")
        crowded, _ = joined(table, "extra", np.uint8)
        return answered(table, sizes, decide_entries(keys, contents, joined_ids(table), crowded, many))

    def by_kind(answers):
        found = {}
        for kind, bucket, answer in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "answer"))):
            found.setdefault(kind, {})[bucket] = answer
        return found

    def ask(key, table, answers):
        if not len(table):
            return sent_schema.empty_table()
        batch = Batch(documents(table), length, k, buckets, many_here, key_bits)
        answer = batch.answers(by_kind(answers).get(NEW, {}))
        runs, bucket = batch.to_sort(answer)
        body = ranges(batch.start[runs], batch.number[runs] - 1 + length)
        upto = np.concatenate([[0], np.cumsum(batch.number[runs] - 1 + length)])
        rows = []
        behind = (batch.anchor[runs] - batch.start[runs]).astype("<i8")
        keys = batch.lead_key[batch.entry[runs]]
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else bucket
        for a, b in zip(edges, np.append(edges[1:], len(bucket))):
            some = slice(a, b)
            number = batch.number[runs[some]].astype("<i8")
            bodies = shrunk(batch.data[body[upto[a] : upto[b]]].tobytes())
            rows.append((int(bucket[a]), [keys[some].tobytes(), as_bytes(behind[some]), ids_as_bytes(batch.id[runs[some]]), as_bytes(number), bodies]))
        first = pa.Table.from_pydict(rows_of(SORT, key, rows), sent_schema)
        _, _, _, h1, h2, ids = batch.singles(answer)
        rows = [
            (b, [x.tobytes(), y.tobytes(), ids_as_bytes(i), b"", b""])
            for b, (x, y, i) in dealt((h1 % np.uint64(buckets)).astype(np.int64), [h1, h2, ids])
        ]
        return pa.concat_tables([first, pa.Table.from_pydict(rows_of(SINGLE, key, rows), sent_schema)])

    def settle(key, table):
        ids = joined_ids(table)
        if key[0].as_py() == SINGLE:
            a, sizes = joined(table, "a", "<u8")
            b, _ = joined(table, "b", "<u8")
            return answered(table, sizes, later_than_first((a, b), ids).astype(np.uint8))
        a, sizes = joined(table, "a", "<u4")
        behind, _ = joined(table, "b", "<i8")
        number, _ = joined(table, "extra", "<i8")
        text, _ = joined(table, "body", np.uint8, lambda x, dtype: np.frombuffer(grown(x), dtype))
        lengths = number - 1 + length
        begin, first = np.cumsum(lengths) - lengths, np.cumsum(number) - number
        found = np.zeros(int(number.sum()), np.uint8)
        # Whole anchors, about STRINGS strings at a time.
        by_key, edges, _ = groups(a)
        edges = np.append(edges, len(a))
        for x, y in blocks(np.concatenate([[0], np.cumsum(number[by_key])])[edges], STRINGS):
            some = by_key[edges[x] : edges[y]]
            at = np.cumsum(lengths[some]) - lengths[some]
            run, step = np.repeat(np.arange(len(some)), number[some]), ranges(np.zeros(len(some), np.int64), number[some])
            # Only strings equally far before the same anchor can be equal.
            order, _, segment = groups(a[some][run], behind[some][run] - step)
            body = text[ranges(begin[some], lengths[some])]
            again = repeated_suffixes(body, (at[run] + step)[order], segment, ids[some][run][order], length)
            found[(first[some][run] + step)[order]] = again
        per_row = np.add.reduceat(number, np.cumsum(sizes) - sizes)
        return answered(table, per_row, found)

    def finish(key, table, answers):
        if not len(table):
            return without(table.column("doc_id"), np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool))
        batch = Batch(documents(table), length, k, buckets, many_here, key_bits)
        given = by_kind(answers)
        answer = batch.answers(given.get(NEW, {}))
        all_of = batch.follows | (answer == REPEATED)[batch.entry] if len(batch.start) else np.zeros(0, bool)
        starts = [batch.start[all_of]]
        ends = [(batch.start + batch.number - 1 + length)[all_of]]
        # Runs that share the leader's document share its strings' answers.
        runs, bucket = batch.to_sort(answer)
        sorted_ = given.get(SORT, {})
        found = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(sorted_[b], np.uint8) for b in np.unique(bucket))]).astype(bool)
        base = np.zeros(len(batch.lead), np.int64)
        base[batch.entry[runs]] = np.cumsum(batch.number[runs]) - batch.number[runs]
        same = np.flatnonzero(~batch.follows & (answer == SORT)[batch.entry]) if len(batch.start) else runs
        hit = found[ranges(base[batch.entry[same]], batch.number[same])]
        position = ranges(batch.start[same], batch.number[same])[hit]
        starts.append(position)
        ends.append(position + length)
        position, ids, number, h1, _, leaders = batch.singles(answer)
        if len(position):
            bucket = (h1 % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            single = given[SINGLE]
            later = np.zeros(len(h1), bool)
            later[order] = np.concatenate([np.frombuffer(single[b], np.uint8) for b in np.unique(bucket)]).astype(bool)
            hit = later[number] | (ids > leaders[number])
            # The leader's other runs of the same content hold the same strings.
            runs = batch.lead[answer == SINGLE]
            first = np.zeros(len(batch.lead), np.int64)
            first[batch.entry[runs]] = np.cumsum(batch.number[runs]) - batch.number[runs]
            same = np.flatnonzero(~batch.follows & (answer == SINGLE)[batch.entry])
            hit = hit[ranges(first[batch.entry[same]], batch.number[same])]
            position = ranges(batch.start[same], batch.number[same])[hit]
            starts.append(position)
            ends.append(position + length)
        taken = covered(len(batch.data), np.concatenate(starts), np.concatenate(ends))
        return without(batch.table.column("doc_id"), batch.data, batch.offsets, taken)

    sent = pieces.groupBy("batch").applyInArrow(send, sent_ddl)
    # Dealt by batch once, for the two steps that read them.
    decided = sent.groupBy("bucket").applyInArrow(decide, answer_ddl).repartition(F.col("batch"))
    asked = pieces.groupBy("batch").cogroup(decided.groupBy("batch")).applyInArrow(ask, sent_ddl)
    settled = asked.groupBy("kind", "bucket").applyInArrow(settle, answer_ddl)
    answers = decided.union(settled)
    return pieces.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, SCHEMA)
