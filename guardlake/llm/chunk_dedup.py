"""Substring dedup by content-defined chunks."""

import numpy as np
import pyarrow as pa
from guardlake.llm.hashing import PrefixHash, blocks, groups, mix, utf8
from guardlake.llm.routing import counts, from_bytes, in_batches, packed
from guardlake.llm.spans import SCHEMA, covered, without

#: Gear values of the bytes; a position is a candidate for a cut if the top CUT_BITS of its hash are zero.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
CUT_BITS, SHORTEST, LONGEST = 5, 16, 4096


def gear_hashes(data, offsets):
    """Gear rolling hash after each byte: every byte's value shifted by its distance, over the last 32 bytes of the document."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    h, width = GEAR[data], 1
    while width < 32:
        older = np.zeros_like(h)
        older[width:] = h[:-width] << np.uint32(width)
        older[place < width] = 0
        h = h + older
        width *= 2
    return h


def cut_chunks(data, offsets):
    """Starts and ends of the chunks, in order; they cover the documents and end between characters.

    A cut depends on the bytes before it and at the next place alone: an
    insertion moves the cuts behind it along and changes only those it touches.
    """
    h = gear_hashes(data, offsets)
    n = len(data)
    candidate = (h >> np.uint32(32 - CUT_BITS)) == 0
    candidate[:-1] &= (data[1:] & 0xC0) != 0x80
    at = np.flatnonzero(candidate) + 1
    # A candidate close behind another one in its document is none.
    own = np.searchsorted(offsets, at - 1, "right")
    far = np.ones(len(at), bool)
    far[1:] = (at[1:] - at[:-1] >= SHORTEST) | (own[1:] != own[:-1])
    cuts = np.unique(np.concatenate([at[far], offsets[1:], offsets[:1]]))
    cuts = cuts[cuts <= n]
    length = np.diff(cuts)
    long = np.flatnonzero(length > LONGEST)
    if len(long):
        more = [np.arange(cuts[i] + LONGEST, cuts[i + 1], LONGEST) for i in long]
        more = np.concatenate(more)
        for _ in range(3):
            more -= (data[more] & 0xC0) == 0x80
        cuts = np.unique(np.concatenate([cuts, more]))
    return cuts[:-1], cuts[1:]


def _batch(table):
    """Documents of a batch in order, their chunks, and the distinct chunks with the first document of each."""
    table = table.sort_by([("id", "ascending"), ("text", "ascending")])
    ids = np.asarray(table.column("id"))
    data, offsets = utf8(table.column("text"))
    found = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
    for a, b in blocks(offsets):
        part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if len(part):
            starts, ends = cut_chunks(part, bounds)
            for out, x in zip(found, (starts + offsets[a], ends + offsets[a], PrefixHash(part).of(starts, ends), PrefixHash(part, 1).of(starts, ends))):
                out.append(x)
    starts, ends, d1, d2 = map(np.concatenate, found)
    owner = np.searchsorted(offsets, starts, "right") - 1
    order, firsts, group = groups(d1, d2)
    group_of = np.empty(len(order), np.int64)
    group_of[order] = group
    lead = order[firsts] if len(order) else order
    return table, data, offsets, starts, ends, owner, group_of, lead, (d1[lead], d2[lead], ids[owner[lead]])


def _in_bucket_order(d1, n):
    """Order in which :func:`packed` sends the entries, and the bucket of each in it."""
    bucket = (d1 % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return bucket, order


def later_than_first(keys, ids):
    """Whether an entry's id is not the smallest among the entries with its key."""
    order = np.lexsort((ids, *keys[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    sorted_ids = ids[order]
    smallest = sorted_ids[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.empty(len(order), bool)
    later[order] = sorted_ids > smallest
    return later


def remove_repeats(docs, shortest_run=64, doc_id="doc_id", text="text", whole_documents=True):
    """Drop chunks that occurred before; (doc_id, n_bytes, spans, kept) per row, by ``spans.SCHEMA``.

    Chunks end where a gear rolling hash of the last 32 bytes says so, so equal
    passages are cut equally wherever they lie, from their second chunk on.  Of
    chunks with the same 128-bit digest the first stays: smallest id, then
    first in the text.  Later ones are removed where runs of them reach
    ``shortest_run`` bytes, so that chance repeats of a few words stay, and, unless
    ``whole_documents`` is false, where a run is all of its document, however short.
    ``kept`` is the UTF-8 text that is left.

    A batch of documents sends one entry per distinct chunk, so a very common
    chunk is one entry per batch.  Defined cases: a null text counts as empty;
    null ids come after all others; rows with the same id lie in one batch and are
    taken in the order of their texts; the empty table gives no rows.
    """
    batches, buckets = counts(docs.sparkSession)
    dealt = in_batches(docs, batches, doc_id, text)

    def send(key, table):
        *_, lead, (d1, d2, ids) = _batch(table)
        bucket, _ = _in_bucket_order(d1, buckets)
        rows = list(packed(bucket, [d1, d2, ids]))
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in rows], pa.int32()),
                "batch": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                **{c: pa.array([x[i] for _, x in rows], pa.binary()) for i, c in enumerate(("d1", "d2", "ids"))},
            }
        )

    def decide(key, table):
        d1, d2, ids = ([from_bytes(x, t) for x in table.column(c).to_pylist()] for c, t in (("d1", "<u8"), ("d2", "<u8"), ("ids", "<i8")))
        sizes = np.array([len(x) for x in d1])
        later = later_than_first((np.concatenate(d1), np.concatenate(d2)), np.concatenate(ids))
        ends = np.cumsum(sizes)
        bits = [np.packbits(later[e - s : e]).tobytes() for s, e in zip(sizes, ends)]
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "later": pa.array(bits, pa.binary())})

    def finish(key, table, answers):
        table, data, offsets, starts, ends, owner, group, lead, (d1, _, _) = _batch(table)
        bucket, order = _in_bucket_order(d1, buckets)
        size = np.bincount(bucket, minlength=buckets)
        given = dict(zip(answers.column("bucket").to_pylist(), answers.column("later").to_pylist()))
        later = np.zeros(len(lead), bool)
        later[order] = np.concatenate(
            [np.zeros(0, bool), *(np.unpackbits(np.frombuffer(given[b], np.uint8), count=size[b]).astype(bool) for b in np.flatnonzero(size))]
        )
        repeated = later[group]
        mine = np.zeros(len(starts), bool)
        mine[lead] = True
        repeated |= ~mine
        # Runs of repeated chunks within a document.
        new = np.ones(len(starts), bool)
        new[1:] = (repeated[1:] != repeated[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        if len(first):
            long = ends[last] - starts[first] >= shortest_run
            if whole_documents:
                long |= (starts[first] == offsets[owner[first]]) & (ends[last] == offsets[owner[first] + 1])
            long &= repeated[first]
            taken = covered(len(data), starts[first[long]], ends[last[long]])
        else:
            taken = np.zeros(len(data), bool)
        return without(table.column("doc_id"), data, offsets, taken)

    sent = dealt.groupBy("batch").applyInArrow(send, "bucket int, batch int, d1 binary, d2 binary, ids binary")
    decided = sent.groupBy("bucket").applyInArrow(decide, "batch int, bucket int, later binary")
    return dealt.groupBy("batch").cogroup(decided.groupBy("batch")).applyInArrow(finish, SCHEMA)
