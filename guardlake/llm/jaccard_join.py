"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from guardlake.llm.components import components
from guardlake.llm.hashing import PrefixHash, blocks, groups, mix, ranges, utf8
from guardlake.llm.routing import counts, packed
from guardlake.llm.tables import written
from guardlake.operators.lookups import lookup_join
from guardlake.session import scratch_folder
from pyspark.sql import functions as F

_K = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text whose shingles are worked out at once, at some 150 bytes each.
SLICE = 1 << 18
#: Words of 64 bits in a set's bitmap.
BITMAP = 8
#: Sets, and shingles of all of them, that one tile task should hold.
TILE_SETS, TILE_SHINGLES = 2048, 4_000_000


def lower_ascii(data):
    """Bytes with A-Z lower-cased."""
    data = data.copy()
    data[(data >= 65) & (data <= 90)] |= 32
    return data


def shingle_sets(data, offsets, width):
    """Sorted distinct shingle hashes of each document, one after another, and where each begins.

    Words are runs of bytes other than blank and 0x09-0x0D, A-Z lower-cased; a
    document of fewer than ``width`` words, but one at least, has the whole sequence
    as its one shingle.
    """
    n = len(offsets) - 1
    data = lower_ascii(data)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data), bool)
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts_new, stops_here = word.copy(), word.copy()
    starts_new[1:] &= ~word[:-1] | edge[1:]
    stops_here[:-1] &= ~word[1:] | edge[1:]
    starts, ends = np.flatnonzero(starts_new), np.flatnonzero(stops_here) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    of, hashes = owner[starts], PrefixHash(data).of(starts, ends)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    words = np.diff(np.append(first, len(of)))
    made = np.maximum(1, words - width + 1)
    at, shingle_of = ranges(first, made), np.repeat(of[first], made)
    last = np.repeat(first + words, made)
    total = np.zeros(len(at), np.uint64)
    for j in range(width):
        there = at + j < last
        step = hashes[np.minimum(at + j, len(of) - 1)]
        total = np.where(there, mix(total * _K + step + np.uint64(j + 1)), total)
    order, firsts, _ = groups(shingle_of, total)
    chosen = order[firsts]
    return total[chosen], np.searchsorted(shingle_of[chosen], np.arange(n + 1))


def set_digests(values, bounds):
    """128 bits of each set, as two arrays; an empty set has zeros."""
    found = []
    for salt in (np.uint64(0x51), np.uint64(0xA7)):
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ mix(salt)), dtype=np.uint64)])
        sums = upto[bounds[1:]] - upto[bounds[:-1]]
        found.append(np.where(np.diff(bounds) > 0, mix(sums + np.diff(bounds).astype(np.uint64)), np.uint64(0)))
    return found


@dataclass(frozen=True)
class Threshold:
    """Two sets link if 100 * intersection >= percent * union."""

    percent: int

    def difference(self, total):
        """Most elements in which linked sets, of ``total`` elements together, can differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def overlap(self, total):
        """Fewest elements linked sets have in common."""
        return -(-total * self.percent // (100 + self.percent))

    def partner(self, size):
        """Size of the largest set that can link to one of that size."""
        return size * 100 // self.percent


def tile_families(size, threshold):
    """For sets of these sizes: (rows, family) of their own band and of the borders they lie at.

    Bands double in size.  Linked sets lie in one band or on either side of a border
    within reach of it.
    """
    band = np.frexp(size.astype(np.float64))[1].astype(np.int64)  # 2^(band-1) <= size < 2^band
    below = (np.int64(1) << (band - 1)) - 1  # largest size of the band before
    above = (np.int64(1) << band) - 1
    yield np.arange(len(size)), band * 2
    at = np.flatnonzero((below > 0) & (size <= threshold.partner(below)))
    yield at, (band * 2 - 1)[at]
    at = np.flatnonzero(threshold.partner(size) > above)
    yield at, (band * 2 + 1)[at]


def tile_keys(values, bounds, rank, threshold):
    """(set, key) pairs such that linked sets share a key.

    ``rank`` says in how many sets an element occurs, coarsely but alike for
    equal elements; 1 stands for this set alone.  Of sets ordered by rank and
    element, linked ones share an element among the first that they can do
    without; elements of this set alone are no keys.  A key is a hash of the
    family and the element.
    """
    size = np.diff(bounds)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((values, rank, owner))
    place = np.arange(len(values)) - np.repeat(bounds[:-1], size)
    # A linked set has at least ``own`` elements of this one, so it has one of the others and one more.
    own = -(-size * threshold.percent // 100)
    first = order[place < (size - own + 1)[owner]]
    first = first[rank[first] > 1]
    owner, element = owner[first], values[first]
    family_of = np.zeros(len(size), np.int64)
    sets, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    full = np.flatnonzero(size > 0)
    for rows, family in tile_families(size[full], threshold):
        family_of[:] = -1
        family_of[full[rows]] = family
        use = family_of[owner] >= 0
        sets.append(owner[use])
        keys.append(mix(element[use] ^ mix(family_of[owner[use]].astype(np.uint64) * _K)))
    return np.concatenate(sets), np.concatenate(keys)


def link_classes(values, bounds, threshold, label):
    """Join the classes in ``label`` (the smallest row of each class so far) over all links of the sets.

    Sets are taken by size; a set is compared with those of no less and near
    enough size in other classes.  An element whose bit the other bitmap lacks is
    not in the other set, which bounds the overlap from above; only what passes
    is intersected.
    """
    size = np.diff(bounds)
    order = np.argsort(size, kind="stable")
    sorted_size = size[order]
    n = len(size)
    seen = np.zeros((n, BITMAP * 64), bool)
    seen[np.repeat(np.arange(n), size), (values % np.uint64(BITMAP * 64)).astype(np.int64)] = True
    bits = np.packbits(seen, axis=1).view(np.uint64)
    for place, i in enumerate(order):
        if not size[i]:
            continue
        end = np.searchsorted(sorted_size, threshold.partner(size[i]), "right")
        others = order[place + 1 : end]
        others = others[label[others] != label[i]]
        if not len(others):
            continue
        mine = size[i] - np.bitwise_count(bits[i] & ~bits[others]).sum(1)
        theirs = size[others] - np.bitwise_count(bits[others] & ~bits[i]).sum(1)
        others = others[np.minimum(mine, theirs) >= threshold.overlap(size[i] + size[others])]
        own = values[bounds[i] : bounds[i + 1]]
        for j in others:
            if label[i] == label[j]:
                continue
            other = values[bounds[j] : bounds[j + 1]]
            at = np.minimum(np.searchsorted(other, own), len(other) - 1)
            if (other[at] == own).sum() >= threshold.overlap(size[i] + size[j]):
                low, high = min(label[i], label[j]), max(label[i], label[j])
                label[label == high] = low
    return label


def _blocks_of_sets(column, width):
    data, offsets = utf8(column)
    for a, b in blocks(offsets, SLICE, each=64):
        values, bounds = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
        yield a, b, values, bounds


def _node(d1, d2):
    """16 bytes per set."""
    pairs = np.ascontiguousarray(np.stack([d1, d2], 1).astype("<u8"))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(pairs), [None, pa.py_buffer(pairs)]).cast(pa.binary())


def document_sets(docs, width, doc_id="doc_id", text="text"):
    """(doc_id, n_shingles, node): size and 128-bit digest of every document's set."""
    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def measure(batches):
        for batch in batches:
            for a, b, values, bounds in _blocks_of_sets(batch.column("text"), width):
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(bounds), pa.int64()), _node(*set_digests(values, bounds))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node"])

    return slim.mapInArrow(measure, "doc_id long, n_shingles long, node binary")


def _views(column, dtype):
    """Numbers of each entry of a binary column, without copying them."""
    return [np.frombuffer(x.as_buffer(), dtype) for x in column]


def _batch_sets(table, width):
    """Distinct sets of a batch in the order of their digests: digests, values, bounds."""
    digests, parts, sizes = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, values, bounds in _blocks_of_sets(table.column("text"), width):
        d = np.stack(set_digests(values, bounds), 1)
        order, firsts, _ = groups(d[:, 0], d[:, 1])
        chosen = order[firsts]
        chosen = chosen[np.diff(bounds)[chosen] > 0]
        digests.append(d[chosen])
        sizes.append(np.diff(bounds)[chosen])
        parts.append(values[ranges(bounds[chosen], sizes[-1])])
    d, size = np.concatenate(digests), np.concatenate(sizes)
    values, at = np.concatenate(parts), np.cumsum(size) - size
    order, firsts, _ = groups(d[:, 0], d[:, 1])
    chosen = order[firsts] if len(order) else order
    return d[chosen], values[ranges(at[chosen], size[chosen])], np.concatenate([[0], np.cumsum(size[chosen])])


#: Occurrences beyond this are told apart no further.
COMMON = 255


def candidate_edges(docs, width, threshold, text="text", doc_id="doc_id"):
    """(a, b) edges between nodes that connect all sets sharing a tile key.

    Documents are dealt into batches by a hash of id and text.  A batch sends each
    of its shingles once with the number of its sets that have it, and gets back how
    common the shingle is in all; then its sets' keys follow.  Of keys it sends one
    set each, with edges from it to its others, so that a key gets at most one
    entry from each batch, and a shingle too.
    """
    n, buckets = counts(docs.sparkSession)
    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    dealt = slim.select("text", F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int").alias("batch"))

    def send(key, table):
        _, values, _ = _batch_sets(table, width)
        shingles, times = np.unique(values, return_counts=True)
        times = np.minimum(times, COMMON).astype(np.uint8)
        rows = list(packed((shingles % np.uint64(buckets)).astype(np.int64), [shingles, times]))
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in rows], pa.int32()),
                "batch": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "shingles": pa.array([x[0] for _, x in rows], pa.binary()),
                "times": pa.array([x[1] for _, x in rows], pa.binary()),
            }
        )

    def count(table):
        shingles, times = (_views(table.column(c), t) for c, t in (("shingles", "<u8"), ("times", np.uint8)))
        sizes = [len(x) for x in shingles]
        every, times = np.concatenate(shingles), np.concatenate(times)
        order = np.argsort(every)
        every = every[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        total = np.minimum(np.add.reduceat(times[order].astype(np.int64), first), COMMON).astype(np.uint8)
        rank = np.empty(len(every), np.uint8)
        rank[order] = np.repeat(total, np.diff(np.append(first, len(every))))
        ends = np.cumsum(sizes)
        found = [rank[e - n : e].tobytes() for n, e in zip(sizes, ends)]
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "rank": pa.array(found, pa.binary())})

    def keyed(key, table, answers):
        if not table.num_rows:
            return pa.table({c: pa.array([], t) for c, t in _PACKED})
        nodes, values, bounds = _batch_sets(table, width)
        shingles = np.unique(values)
        bucket = (shingles % np.uint64(buckets)).astype(np.int64)
        given = dict(zip(answers.column("bucket").to_pylist(), answers.column("rank").to_pylist())) if len(values) else {}
        rank = np.zeros(len(shingles), np.uint8)
        rank[np.argsort(bucket, kind="stable")] = np.concatenate(
            [np.zeros(0, np.uint8), *(np.frombuffer(given[b], np.uint8) for b in np.unique(bucket))]
        )
        s, k = tile_keys(values, bounds, rank[np.searchsorted(shingles, values)], threshold)
        rows = list(_packed_edges(nodes, s, k, buckets, key[0].as_py()))
        return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(_PACKED)})

    def connect(table):
        rows = zip(*(table.column(c).to_pylist() for c in ("bucket", "key", "who", "nodes")))
        found, keys, whos = [], [], []
        for bucket, key, who, nodes in rows:
            nodes = np.frombuffer(nodes, "<u8").reshape(-1, 2)
            if bucket < 0:
                pairs = np.frombuffer(who, "<u4").reshape(-1, 2)
                found.append(np.hstack([nodes[pairs[:, 0]], nodes[pairs[:, 1]]]))
            else:
                keys.append(np.frombuffer(key, "<u8"))
                whos.append(nodes[np.frombuffer(who, "<u4")])
        if keys:
            k, w = np.concatenate(keys), np.concatenate(whos)
            order, _, _ = groups(k, w[:, 0], w[:, 1])
            k, w = k[order], w[order]
            new = np.concatenate([[True], k[1:] != k[:-1]])
            leader = w[np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))]
            differ = (leader != w).any(1)
            found.append(np.unique(np.hstack([leader[differ], w[differ]]), axis=0))
        e = np.concatenate([np.zeros((0, 4), np.uint64), *found])
        return pa.table({"a": _node(e[:, 0], e[:, 1]), "b": _node(e[:, 2], e[:, 3])})

    sent = dealt.groupBy("batch").applyInArrow(send, "bucket int, batch int, shingles binary, times binary")
    counted = sent.groupBy("bucket").applyInArrow(count, "batch int, bucket int, rank binary")
    rows = dealt.groupBy("batch").cogroup(counted.groupBy("batch")).applyInArrow(keyed, "bucket int, key binary, who binary, nodes binary")
    return rows.groupBy("bucket").applyInArrow(connect, "a binary, b binary")


_PACKED = [("bucket", pa.int32()), ("key", pa.binary()), ("who", pa.binary()), ("nodes", pa.binary())]


def _packed_edges(nodes, s, k, buckets, batch):
    """Rows of :func:`candidate_edges` for sets s with keys k; ``nodes`` are digests in ascending order."""
    order, _, _ = groups(k, s)
    s, k = s[order], k[order]
    if not len(k):
        return
    new = np.concatenate([[True], k[1:] != k[:-1]])
    leader = s[np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))]
    pairs = np.unique(np.stack([leader, s], 1)[leader != s], axis=0)
    if len(pairs):
        # Edges of this batch: a bucket of their own, below zero.
        used, pairs = np.unique(pairs, return_inverse=True)
        yield -1 - batch, b"", pairs.reshape(-1, 2).astype("<u4").tobytes(), nodes[used].astype("<u8").tobytes()
    bucket = (k[new] % np.uint64(buckets)).astype(np.int64)
    for b, (key, who) in packed(bucket, [k[new], s[new].astype("<u4")]):
        used, who = np.unique(np.frombuffer(who, "<u4"), return_inverse=True)
        yield b, key, who.astype("<u4").tobytes(), nodes[used].astype("<u8").tobytes()


LINKS = "a binary, b binary, leads boolean"


def _tile(width, threshold):
    """Task over the texts of a tile: an edge from each set to the smallest of its class."""

    def link(table):
        nodes = np.array(table.column("node").to_pylist(), dtype=object)
        lead = np.asarray(table.column("main"))
        data, offsets = utf8(table.column("text"))
        values, bounds = shingle_sets(data, offsets, width)
        actual = _node(*set_digests(values, bounds)).to_pylist()
        # Ids may repeat with other texts: only the text that has the node's set stands for it, once.
        first = {}
        for i, (have, want) in enumerate(zip(actual, nodes)):
            if have == want:
                first.setdefault(want, i)
        rows = np.array(sorted(first.values(), key=lambda i: nodes[i]), np.int64)
        if not len(rows):
            return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary()), "leads": pa.array([], pa.bool_())})
        sizes = np.diff(bounds)[rows]
        kept = values[ranges(bounds[rows], sizes)]
        label = np.arange(len(rows))
        main = np.flatnonzero(lead[rows])
        if len(main):
            label[main] = main[0]
        label = link_classes(kept, np.concatenate([[0], np.cumsum(sizes)]), threshold, label)
        with_main = label == label[main[0]] if len(main) else np.zeros(len(rows), bool)
        names = nodes[rows]
        return pa.table(
            {"a": pa.array(names, pa.binary()), "b": pa.array(names[label], pa.binary()), "leads": pa.array(with_main)}
        )

    return link


def link_documents(docs, width=5, percent=80, doc_id="doc_id", text="text"):
    """Classes of documents connected by links: 100 * intersection >= percent * union of their shingle sets.

    Returns doc_id, n_shingles and component_id, the smallest id of the class.
    Equal sets are one node.  Sets that share a tile key are candidates; the
    candidates' components, found by edges to one set per key, are cut into tiles
    of bounded size, and all links inside a tile are found exactly.  Where a
    component needs several tiles, each holds the component's first set too; only
    sets not in that set's class are then compared with the other tiles.

    Defined cases: texts that are null, empty or without words have no shingles
    and are linked with nothing (component_id is their own id); a null id has a
    null component_id unless the class has another id; rows with the same id are
    separate documents of that id; the empty table gives no rows.
    """
    spark = docs.sparkSession
    threshold = Threshold(percent)
    folder = scratch_folder(spark, "jaccard-join")
    sets = written(document_sets(docs, width, doc_id, text), f"{folder}/sets")
    reps = (
        sets.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size"), F.count("doc_id").alias("with_id"))
    )
    edges = candidate_edges(docs, width, threshold, text, doc_id)
    near = components(edges, f"{folder}/candidates").withColumnRenamed("label", "part").join(reps, "node")
    weights = near.groupBy("part").agg(F.count(F.lit(1)).alias("sets"), F.sum("size").alias("shingles"))
    tiles = F.ceil(F.greatest(F.col("sets") / TILE_SETS, F.col("shingles") / TILE_SHINGLES)).cast("int")
    weights = weights.select("part", tiles.alias("tiles"))
    # A component may be most of all nodes.
    near = written(lookup_join(near, weights, ["part"], ["node"]), f"{folder}/near")
    body = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Both sides by id at every size; Spark would broadcast the nodes of a small corpus and not those of a large one.
    texts = near.join(body.hint("merge"), near.rep.eqNullSafe(body.doc_id)).select("node", "part", "tiles", "text")
    texts = written(texts.withColumn("main", F.col("node") == F.col("part")), f"{folder}/texts")
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    dealt = texts.withColumn("tile", F.explode(F.when(F.col("main"), every).otherwise(F.array(tile))))
    links = written(dealt.groupBy("part", "tile").applyInArrow(_tile(width, threshold), LINKS), f"{folder}/links")
    # Sets of components with several tiles: those outside the first set's class meet every tile.
    several = texts.where("tiles > 1").join(
        links.groupBy(F.col("a").alias("node")).agg(F.max("leads").alias("leads")), "node"
    )
    strays = several.where("not leads and not main")
    stray_tiles = strays.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / TILE_SETS).cast("int").alias("stray_tiles"))
    strays = strays.join(stray_tiles, "part").withColumn("stray_tile", F.pmod(F.xxhash64("part", "node"), F.col("stray_tiles")).cast("int"))
    left = strays.withColumn("tile", F.explode(every)).select("part", "tile", "stray_tile", "node", "text", F.lit(False).alias("main"))
    right = several.join(stray_tiles, "part").withColumn("stray_tile", F.explode(F.sequence(F.lit(0), F.col("stray_tiles") - 1)))
    right = right.select("part", tile.alias("tile"), "stray_tile", "node", "text", F.col("leads").alias("main"))
    crossed = left.union(right).groupBy("part", "tile", "stray_tile").applyInArrow(_tile(width, threshold), LINKS)
    all_links = links.union(written(crossed, f"{folder}/crossed")).select("a", "b")
    classes = components(all_links, f"{folder}/classes")
    named = classes.join(reps, "node").select("node", "label", "rep")
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_node = named.join(smallest, "label").select(F.col("node").alias("of"), "component_id")
    resolved = reps.join(by_node, F.col("node") == F.col("of"), "left").select(
        "node", F.coalesce("component_id", "rep").alias("component_id")
    )
    # Equal sets may be very many; their rows are spread by id.
    classed = lookup_join(sets, resolved, ["node"], ["doc_id"])
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return classed.select("doc_id", "n_shingles", own.alias("component_id"))


def drop_near_copies(docs, width=5, percent=80, doc_id="doc_id", text="text"):
    """The rows of ``docs`` whose id is their class's ``component_id``, one document of each class.

    Rows with the same id, null included, stay or go together: they stay if one of them does.
    """
    linked = link_documents(docs, width, percent, doc_id, text)
    stays = linked.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id that stays")).distinct()
    return docs.hint("merge").join(stays, F.col(f"`{doc_id}`").eqNullSafe(F.col("`id that stays`")), "left_semi")
