"""Taking byte ranges out of documents."""

import numpy as np
import pyarrow as pa

SCHEMA = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def covered(size, starts, ends):
    """Which of ``size`` bytes lie in any of the ranges."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def without(doc_ids, data, offsets, taken):
    """Arrow table by SCHEMA: the maximal runs of taken bytes of each document, and what is left of it."""
    edge = np.zeros(len(data), bool)
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    first, last = taken.copy(), taken.copy()
    first[1:] &= ~taken[:-1] | edge[1:]
    last[:-1] &= ~taken[1:] | edge[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.searchsorted(starts, offsets)
    base = np.repeat(offsets[:-1], np.diff(at))
    pairs = pa.StructArray.from_arrays([pa.array(starts - base, pa.int64()), pa.array(ends - base, pa.int64())], ["start", "end"])
    left = data[~taken]
    upto = np.concatenate([[0], np.cumsum(~taken)])[offsets].astype(np.int64)
    kept = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(upto), pa.py_buffer(np.ascontiguousarray(left))])
    return pa.table(
        {
            "doc_id": doc_ids,
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "spans": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pairs),
            "kept": kept.cast(pa.binary()),
        }
    )
