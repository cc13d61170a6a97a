"""Greedy chains of sent requests on sorted arrays, inside tasks.

A stretch of a key's time, many times to live long, is one group.  Whatever was
sent before it, a group sends at most one request per time to live, so all groups
of a task advance together in a bounded number of rounds.
"""

import numpy as np
import pyarrow as pa


def complete_groups(batches, keys):
    """Tables of whole groups from sorted record batches; equal values of ``keys`` lie together."""
    waiting = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        cut = int(group_starts(batch, keys)[-1])
        if cut == 0:  # the batch may be of one group that goes on
            if len(waiting) > 1 and not _same(waiting[-2], -1, batch, 0, keys):
                yield pa.Table.from_batches(waiting[:-1]).combine_chunks()
                waiting = [batch]
            continue
        yield pa.Table.from_batches([*waiting[:-1], batch.slice(0, cut)]).combine_chunks()
        waiting = [batch.slice(cut)]
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _same(a, i, b, j, keys):
    i = i % a.num_rows
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)


def group_starts(table, keys):
    """Rows at which a new group begins."""
    n = table.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        column = table.column(k)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        codes = np.asarray(column.dictionary_encode().indices.fill_null(-1))
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


class Timeline:
    """Times of many groups on one ascending line, so that one search serves all groups."""

    def __init__(self, starts, us, ttl):
        self.starts, self.ttl = starts, ttl
        self.group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(us))))
        offset = us - us[starts][self.group]
        self.room = int(offset.max(initial=0)) + ttl + 1
        self.at = self.group * self.room + offset

    def first_after(self, rows, among):
        """For each row: the first of the rows ``among`` (ascending) of its group later than it by more than ttl, or -1."""
        place = np.searchsorted(self.at[among], self.at[rows] + self.ttl, "right")
        found = np.append(among, -1)[place]
        return np.where(self.group[found] == self.group[rows], found, -1) if len(among) else found


def bounded(starts, us, ttl):
    """Cut groups into runs whose line fits 64 bits: (first group, last group)."""
    if not len(starts):
        return
    last = np.append(starts[1:], len(us)) - 1
    room = int((us[last] - us[starts]).max(initial=0)) + ttl + 1
    step = max(1, (1 << 62) // room)
    for a in range(0, len(starts), step):
        yield a, min(a + step, len(starts))


def exits(starts, us, ttl):
    """What each group makes of the answer stored before it.

    Rows are those that store an answer.  Returns group, threshold and the last
    row sent: an answer that runs out at threshold or later, but before the next
    threshold of the group, leads to it; -1 stands for nothing sent.  The first
    threshold of a group is the smallest number, which also stands for no answer.
    """
    line = Timeline(starts, us, ttl)
    ends = np.append(starts[1:], len(us))
    every = np.arange(len(us))
    jump = line.first_after(every, every)
    # Answers from before run out by the group's first time plus ttl.
    entry = np.flatnonzero((us <= us[starts][line.group] + ttl) | (every == np.where(jump[starts] < 0, -1, jump[starts])[line.group]))
    exit_of = entry.copy()
    moving = np.arange(len(entry))
    while len(moving):
        further = jump[exit_of[moving]]
        moving = moving[further >= 0]
        exit_of[moving] = further[further >= 0]
    none = np.flatnonzero(jump[starts] < 0)  # an answer that outlasts all rows
    rows = np.concatenate([entry, ends[none]])
    exit_of = np.concatenate([exit_of, np.full(len(none), -1)])
    group = np.concatenate([line.group[entry], none])
    order = np.lexsort((rows, group))
    rows, exit_of, group = rows[order], exit_of[order], group[order]
    begins = np.ones(len(rows), bool)
    begins[1:] = group[1:] != group[:-1]
    fresh = begins.copy()
    fresh[1:] |= exit_of[1:] != exit_of[:-1]
    threshold = np.where(begins, np.iinfo(np.int64).min, us[np.maximum(rows - 1, 0)])
    return group[fresh], threshold[fresh], exit_of[fresh]


def answers(starts, us, stores, given, ttl):
    """(row whose answer serves each row or -1, rows sent) of groups in time order.

    ``stores`` are rows that would store an answer; ``given`` marks a group's first
    row if it stands for the answer stored before.
    """
    line = Timeline(starts, us, ttl)
    among = np.flatnonzero(stores)
    at = np.searchsorted(among, starts)
    head = np.append(among, -1)[at]
    ends = np.append(starts[1:], len(us))
    current = np.where(given[starts], starts, np.where(head < ends, head, -1))
    current = current[current >= 0]
    sent = np.zeros(len(us), bool)
    while len(current):
        sent[current] = True
        current = line.first_after(current, among)
        current = current[current >= 0]
    every = np.arange(len(us))
    latest = np.maximum.accumulate(np.where(sent, every, -1))
    served = (latest >= starts[line.group]) & (us <= us[latest] + ttl)
    return np.where(served, latest, -1), sent
