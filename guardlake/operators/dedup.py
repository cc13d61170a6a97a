"""Reuse of stored answers: request keys and the time-to-live chain.

An answer stored at time t serves equal requests up to and including t + TTL; a
hit does not extend it.  So the requests of a key that are really sent form a
greedy chain: each is the first request later than the one before it plus TTL.
In a log of request times the answer counts as stored when it was requested.

A key's time is cut into chunks of ``SPAN`` times to live.  What a chunk makes of
an answer stored before it is a step function, worked out chunk by chunk; a scan
over the chunks of a key joins them, and hands each chunk the answer it begins
with.  Requests are then answered chunk by chunk.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from guardlake.functions.bands import let
from guardlake.operators import reuse_chain as chain
from guardlake.schemas import CACHE_TTL_SECONDS

#: Times to live in a chunk of a key's time; an answer reaches into the next chunk at most.
SPAN = 16
GROUP = ["_g", "_chunk"]


def request_key(endpoint, body):
    """Key of a request: endpoint and JSON body with the fields of its top level in name order.

    Nested objects keep the order they came in.  A body that is not a JSON object
    counts as it is.
    """
    endpoint = F.col(endpoint) if isinstance(endpoint, str) else endpoint
    body = F.col(body) if isinstance(body, str) else body
    typed = F.try_parse_json(body)
    kinds = F.when(F.schema_of_variant(typed).startswith("OBJECT"), typed.cast("map<string,variant>"))
    types = F.transform_values(kinds, lambda _, v: F.coalesce(F.schema_of_variant(v), F.lit("VOID")) == "STRING")
    parsed = F.struct(types.alias("texts"), F.from_json(body, "map<string,string>").alias("raw"))

    def field(name, fields):
        # A text is told from a number or object that looks the same.
        value = F.coalesce(F.try_element_at(fields["raw"], name), F.lit("null"))
        return F.to_json(F.struct(name.alias("n"), F.try_element_at(fields["texts"], name).alias("t"), value.alias("v")))

    def listed(fields):
        names = F.array_sort(F.map_keys(fields["texts"]))
        every = F.array_join(F.transform(names, lambda name: field(name, fields)), ",")
        return F.when(fields["texts"].isNotNull(), F.concat(F.lit("{"), every, F.lit("}")))

    # Bound once; inside a lambda an expression is worked out anew for each field.
    canonical = F.coalesce(let(parsed, listed), body, F.lit(""))
    return F.sha2(F.concat(endpoint, F.lit(":"), canonical), 256)


def flag(condition):
    """The condition, true where it is not given, false where it is null."""
    if condition is None:
        return F.lit(True)
    return F.coalesce(F.col(condition) if isinstance(condition, str) else condition, F.lit(False))


def key_digest(keys):
    """Binary digest of the key columns, null-safe."""
    fields = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    return F.unhex(F.sha2(F.to_json(fields), 256))


def dedup_requests(df, key_cols, *, ts="ts", id_col="request_id", ttl_seconds=CACHE_TTL_SECONDS, cacheable=None, ok=None):
    """Add ``answer_id`` (the request whose answer serves this one) and ``from_cache``.

    Only ``cacheable`` requests are served from stored answers, and only those that
    went ``ok`` store theirs (both conditions; all requests by default).  Other rows,
    and rows without a time, pass through as sent; a failed one has no answer.  Of
    several requests at one time the one of smallest id is sent.

    One plan for every key: digest, time, id and flag of the requests are dealt out
    by key and chunk of time, twice; the chunks' step functions by key; the answers
    join the rows by digest, time and id.  A task holds a chunk of a key, 16
    bytes a request, whatever share of the rows the key has.
    """
    ttl = int(ttl_seconds) * 1_000_000
    width = SPAN * ttl or 1
    good = flag(ok)
    known = df.withColumns({"_us": F.unix_micros(F.col(ts).cast("timestamp")), "_g": key_digest(key_cols)})
    asked = flag(cacheable) & F.col("_us").isNotNull()
    chunk = F.col("_us") - F.pmod("_us", F.lit(width))
    narrow = known.where(asked).select("_g", chunk.alias("_chunk"), "_us", F.col(id_col).alias("_id"), good.alias("_ok"))
    id_type = dict(df.dtypes)[id_col]
    begins = _entries(narrow.where("_ok").drop("_ok"), ttl, width, id_type)
    everything = narrow.withColumn("_given", F.lit(False)).unionByName(
        begins.withColumns({"_ok": F.lit(False), "_given": F.lit(True)})
    )
    answered = _in_groups(everything).mapInArrow(_answer(ttl), f"_g binary, _us long, _id {id_type}, _answer {id_type}, _hit boolean")
    answered = answered.select(F.col("_g").alias("_ag"), F.col("_us").alias("_at"), F.col("_id").alias("_aid"), "_answer", "_hit")
    match = (F.col("_g") == F.col("_ag")) & (F.col("_us") == F.col("_at")) & F.col(id_col).eqNullSafe(F.col("_aid"))
    out = known.join(answered, match, "left")
    return out.withColumns(
        {
            "answer_id": F.when(asked, F.col("_answer")).when(good, F.col(id_col)),
            "from_cache": asked & F.coalesce("_hit", F.lit(False)),
        }
    ).drop("_us", "_g", "_ag", "_at", "_aid", "_answer", "_hit")


def _in_groups(rows):
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "_us", "_id")


def _slices(batches, ttl):
    """(table of whole groups, where they begin, times), a line of 64 bits at a time."""
    for table in chain.complete_groups(batches, GROUP):
        starts, us = chain.group_starts(table, GROUP), np.asarray(table.column("_us"))
        for a, b in chain.bounded(starts, us, ttl):
            low, high = starts[a], starts[b] if b < len(starts) else len(us)
            yield table.slice(low, high - low).combine_chunks(), starts[a:b] - low, us[low:high]


def _entries(stored, ttl, width, id_type):
    """(digest, chunk, time, id) of the answer with which a chunk begins, where there is one."""

    def steps(batches):
        for table, starts, us in _slices(batches, ttl):
            group, threshold, sent = chain.exits(starts, us, ttl)
            bounds = np.searchsorted(group, np.arange(len(starts) + 1)).astype(np.int32)
            nothing = sent < 0
            row = pa.array(np.maximum(sent, 0), mask=nothing)
            columns = [table.column(c).take(pa.array(starts)).combine_chunks() for c in GROUP]
            for values in (pa.array(threshold), pa.array(us[np.maximum(sent, 0)], mask=nothing), table.column("_id").combine_chunks().take(row)):
                columns.append(pa.ListArray.from_arrays(pa.array(bounds), values))
            yield pa.RecordBatch.from_arrays(columns, [*GROUP, "upto", "sent_us", "sent_id"])

    def scan(batches):
        digest, at, expiry, least = None, None, None, np.iinfo(np.int64).min
        for batch in batches:
            found = []
            for g, chunk, upto, sent_us, sent_id in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                # An answer from an earlier chunk than the one before has run out.
                entering = expiry if g == digest and at == chunk else least
                step = np.searchsorted(np.array(upto, np.int64), max(entering, least), "right") - 1
                digest, at, expiry = g, chunk + width, None
                if sent_us[step] is not None and sent_us[step] + ttl >= at:
                    expiry = sent_us[step] + ttl
                    found.append((g, at, sent_us[step], sent_id[step]))
                expiry = least if expiry is None else expiry
            columns = list(zip(*found)) or [[]] * 4
            ids = batch.schema.field("sent_id").type.value_type
            arrays = [pa.array(list(c), t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), ids))]
            yield pa.RecordBatch.from_arrays(arrays, [*GROUP, "_us", "_id"])

    functions = _in_groups(stored).mapInArrow(steps, f"_g binary, _chunk long, upto array<long>, sent_us array<long>, sent_id array<{id_type}>")
    by_key = functions.repartition("_g").sortWithinPartitions(*GROUP)
    return by_key.mapInArrow(scan, f"_g binary, _chunk long, _us long, _id {id_type}")


def _answer(ttl):
    def answer(batches):
        for table, starts, us in _slices(batches, ttl):
            given, stores = (np.asarray(table.column(c).combine_chunks().fill_null(False)) for c in ("_given", "_ok"))
            serving, sent = chain.answers(starts, us, stores, given, ttl)
            ids = table.column("_id").combine_chunks()
            answer = ids.take(pa.array(np.maximum(serving, 0), mask=serving < 0))
            # Rows alike in key, time and id are one request.
            again = np.zeros(len(us), bool)
            codes = np.asarray(ids.dictionary_encode().indices.fill_null(-1))
            again[1:] = (us[1:] == us[:-1]) & (codes[1:] == codes[:-1])
            again[starts] = False
            keep = pa.array(np.flatnonzero(~given & ~again))
            columns = [table.column("_g").combine_chunks(), pa.array(us), ids, answer, pa.array((serving >= 0) & ~sent)]
            yield pa.RecordBatch.from_arrays([c.take(keep) for c in columns], ["_g", "_us", "_id", "_answer", "_hit"])

    return answer
