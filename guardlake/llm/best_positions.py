"""Ranked lexical search by the best position algorithm."""

import math
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from guardlake.llm.hashing import blocks, utf8
from guardlake.operators.lookups import lookup_join
from pyspark.sql import Window
from pyspark.sql import functions as F

#: Bytes of text in one index segment of a task, and of the query texts that one pass over the documents takes.
SEGMENT, QUERY_BYTES = 8 << 20, 4 << 20
#: Positions that the first round of sorted accesses takes from each list; every round takes twice as many.
FIRST_ROUND = 32
LAST = np.iinfo(np.int64).max

#: Bytes of terms (digits, letters, all beyond ASCII), A-Z lower-cased; others part them.
_TERM_BYTES = bytes(
    b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text):
    """Terms of a text given as bytes, in order."""
    return text.translate(_TERM_BYTES).split()


class ImpactLists:
    """A segment of documents as impact lists: for each term its documents, highest impact first.

    The lists can also be entered by document, which gives position and impact.
    """

    def __init__(self, owner, term, n_terms, norm):
        """Document and term of every occurrence, terms numbered below ``n_terms``; ``norm`` of every document."""
        self.n_documents = len(norm)
        key = np.sort(term * np.int64(max(1, len(norm))) + owner)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(key)))
        term, self.docs = np.divmod(key[at], max(1, len(norm)))
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * norm[self.docs])
        self.bounds = np.searchsorted(term, np.arange(n_terms + 1))
        order = np.lexsort((self.docs, -self.impact, term))
        self.sorted_docs, self.sorted_impact = self.docs[order], self.impact[order]
        self.position = np.empty(len(order), np.int64)
        self.position[order] = np.arange(len(order)) - self.bounds[term]


def best_positions(lists, terms, weights, k, floor=0):
    """(documents, scores) that hold all of the k best of a segment for a query; scores above 0, and ``floor`` at least.

    Rounds of sorted accesses go on from the first unseen position of each list.
    A document that turns up is looked up in all lists, which marks its position
    in each; the impacts at the first unseen positions then bound the score of any
    document not seen.  It ends when that bound is strictly below the kth score.
    """
    starts, ends = lists.bounds[terms], lists.bounds[terms + 1]
    some = (weights > 0) & (ends > starts)
    starts, ends, weights = starts[some], ends[some], weights[some]
    seen = [np.zeros(e - s + 1, bool) for s, e in zip(starts, ends)]  # the last stays unseen
    best = np.zeros(len(starts), np.int64)
    known = np.zeros(lists.n_documents, bool)
    found, scores, kth, step, scored = [], [], floor, FIRST_ROUND, 0
    while True:
        open_lists = best < ends - starts
        bound = (weights * np.append(lists.sorted_impact, 0)[starts + best])[open_lists].sum()
        if not open_lists.any() or bound < kth:
            break
        reach = [lists.sorted_docs[s + b : min(s + b + step, e)] for s, b, e in zip(starts, best, ends)]
        new = np.unique(np.concatenate(reach))
        new = new[~known[new]]
        known[new] = True
        total = np.zeros(len(new), np.int64)
        for i, (s, e) in enumerate(zip(starts, ends)):
            docs = lists.docs[s:e]
            place = np.searchsorted(docs, new)
            hit = np.flatnonzero(docs[np.minimum(place, e - s - 1)] == new)
            entry = s + place[hit]
            total[hit] += weights[i] * lists.impact[entry]
            seen[i][lists.position[entry]] = True
            best[i] += np.argmin(seen[i][best[i] :])
        found.append(new)
        scores.append(total)
        scored += len(new)
        if scored >= k:
            every = np.concatenate(scores)
            kth = max(kth, -np.partition(-every, k - 1)[k - 1])
            found, scores = [np.concatenate(found)[every >= kth]], [every[every >= kth]]
            scored = len(found[0])
        step *= 2
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, scores = np.concatenate(found), np.concatenate(scores)
    use = (scores >= kth) & (scores > 0)
    return found[use], scores[use]


class _Best:
    """The k best (score, id) of a query so far; equal scores by id, null last."""

    def __init__(self, k):
        self.k, self.scores = k, np.zeros(0, np.int64)
        self.ids, self.null = self.scores, np.zeros(0, bool)

    @property
    def floor(self):
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores, ids, null):
        scores, ids, null = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]


def _slim(docs, doc_id, text):
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def _texts(batch, size):
    """(first, last, texts as bytes) of slices of a batch."""
    data, offsets = utf8(batch.column("text"))
    for a, b in blocks(offsets, size, each=64):
        yield a, b, [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(a, b)]


def statistics(slim, vocabulary):
    """(documents with a term, terms of all documents, documents per term of the broadcast vocabulary)."""

    def measure(batches):
        documents, total = 0, 0
        holding = None
        for batch in batches:
            for _, _, texts in _texts(batch, 1 << 20):
                number = vocabulary.value
                holding = np.zeros(len(number), np.int64) if holding is None else holding
                for text in texts:
                    terms = terms_of(text)
                    documents += bool(terms)
                    total += len(terms)
                    present = number.keys() & terms
                    holding[[number[t] for t in present]] += 1
        if holding is not None:
            used = np.flatnonzero(holding)
            counts = np.concatenate([[documents, total], holding[used]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], used]), pa.int64()), pa.array(counts, pa.int64())], ["term", "n"])

    rows = slim.mapInArrow(measure, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = dict(rows.collect())  # the vocabulary's terms, which QUERY_BYTES bounds, and two numbers
    return counts.get(-1, 0), counts.get(-2, 0), np.array([counts.get(t, 0) for t in range(len(vocabulary.value))], np.int64)


def _search(slim, queries, k):
    """The k best of each task for each of the given (key, text) queries: key, doc_id, score."""
    context = slim.sparkSession.sparkContext
    number, asked = {}, []
    for key, text in queries:
        own = {number.setdefault(t, len(number)) for t in terms_of(text.encode())}
        asked.append((key, np.array(sorted(own), np.int64)))
    asked = [(key, own) for key, own in asked if len(own)]
    vocabulary = context.broadcast(number)
    documents, total, holding = statistics(slim, vocabulary)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.int64)
    plan = context.broadcast((asked, weights))

    def search(batches):
        number, (asked, weights) = vocabulary.value, plan.value
        best = [_Best(k) for _ in asked]
        for batch in batches:
            ids = batch.column("doc_id")
            null = np.asarray(ids.is_null())
            ids = np.asarray(ids.fill_null(LAST))
            for a, b, texts in _texts(batch, SEGMENT):
                found, sizes = [], []
                for text in texts:
                    terms = terms_of(text)
                    sizes.append(len(terms))
                    found.append(np.fromiter(map(number.get, terms, repeat(-1)), np.int64, len(terms)))
                sizes = np.array(sizes, np.int64)
                term, owner = np.concatenate(found), np.repeat(np.arange(len(texts)), sizes)
                owner, term = owner[term >= 0], term[term >= 0]
                norm = 10 + 90 * sizes * documents // max(total, 1)
                lists = ImpactLists(owner, term, len(number), norm)
                for (_, own), top in zip(asked, best):
                    docs, scores = best_positions(lists, own, weights[own], k, top.floor)
                    if len(docs):
                        top.add(scores, ids[a:b][docs], null[a:b][docs])
        keys = [key for (key, _), top in zip(asked, best) for _ in top.scores]
        if keys:
            ids, null, scores = (np.concatenate([getattr(top, c) for top in best]) for c in ("ids", "null", "scores"))
            arrays = [pa.array(keys, pa.string()), pa.array(ids, pa.int64(), mask=null), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "doc_id", "score"])

    return slim.mapInArrow(search, "key string, doc_id long, score long")


def rank_documents(docs, items, k=10, doc_id="doc_id", text="text", item_id="item_id", item_text="text"):
    """The k documents of highest score above 0 for each item, equal scores by ascending id.

    Scores are sums over the item's terms of term weight times an impact that
    falls with the document's length, in whole numbers.  Documents lie in
    segments inside their tasks; every segment is searched for every item by
    :func:`best_positions`, starting from the task's kth score so far, and a task
    hands on k rows an item.  Distinct item texts are taken in blocks of about
    ``QUERY_BYTES``, each of which is broadcast and takes two passes over the
    documents (counts, then search); there is one block unless the items are large.

    Returns item_id, rank (from 1), doc_id, score.  Defined cases: a null or empty
    text has no terms: such a document is never found, such an item finds
    nothing; rows with equal or null ids are documents and items of their own, null
    document ids come last among equal scores; other columns are left out.  A
    document is held as a whole, about 50 bytes a term, with its segment.
    """
    slim = _slim(docs, doc_id, text)
    asked = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    asked = asked.where(F.col("text").isNotNull()).withColumn("key", F.sha2("text", 256))
    distinct = asked.select("key", "text").distinct()
    size = distinct.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = math.ceil((size + 1) / QUERY_BYTES)
    block = F.pmod(F.xxhash64("key"), F.lit(n))
    found = reduce(
        lambda x, y: x.union(y),
        [_search(slim, [tuple(r) for r in distinct.where(block == i).collect()], k) for i in range(n)],
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("rank") <= k)
    best = ranked.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "doc_id", "score"))).alias("best"))
    # An item text may repeat very often; its rows are spread by id.
    joined = lookup_join(asked.drop("text"), best, ["key"], ["item_id"])
    return joined.select("item_id", F.inline("best"))
