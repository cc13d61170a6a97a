"""Live state per key in Spark's own state store: agent sessions and stored answers.

Before rows are dealt out by key, each task packs its rows of a key into one row of
sorted arrays: a few bytes a row, and details only for as many rows as the rules can
look at.  A key with a third of a batch so reaches its state as a few rows.  State
lies in ``transformWithState``: only changed keys are written, a replayed batch begins
from the state before it, and event-time timers end what is silent.
"""

import json
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from guardlake.operators import reuse_chain as chain
from guardlake.operators.agent_sessions import SCORE_WORD, is_critical
from guardlake.operators.dedup import flag, key_digest
from guardlake.schemas import CACHE_TTL_SECONDS, DIM_COLUMNS, DIMENSIONS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Entries of an output row that lists calls or requests.
LISTED = 10_000
FLAGGED, CRITICAL = 1, 2


def start_stateful(spark, start):
    """``start()`` with the state store that ``transformWithState`` needs; a query keeps the setting it began with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def packed(rows, key, *, most=None, gap=None):
    """One row per key and task batch of ``rows(key, us, id, ...)``: ``seen`` (latest time) and lists by time and id.

    Of the column ``detail`` only the first ``most`` entries, and those after a
    pause longer than ``gap``, are kept; the others are null.
    """
    types = dict(rows.dtypes)
    lists = [c for c in rows.columns if c != key]
    schema = ", ".join([f"`{key}` {types[key]}", "seen timestamp", *(f"`{c}` array<{types[c]}>" for c in lists)])

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            order = pc.sort_indices(table.select([key, "us", "id"]), sort_keys=[(c, "ascending") for c in (key, "us", "id")])
            table = table.take(order).combine_chunks()
            starts = chain.group_starts(table, [key])
            ends = np.append(starts[1:], table.num_rows)
            seen = table.column("us").combine_chunks().take(pa.array(ends - 1)).cast(pa.timestamp("us", tz="UTC"))
            columns = [table.column(key).combine_chunks().take(pa.array(starts)), seen]
            for c in lists:
                values = table.column(c).combine_chunks()
                if c == "detail" and most is not None:
                    us, place = np.asarray(table.column("us")), np.arange(table.num_rows)
                    begins = np.zeros(len(us), bool)
                    begins[1:] = us[1:] - us[:-1] > (np.iinfo(np.int64).max if gap is None else gap)
                    begins[starts] = True
                    late = place - np.maximum.accumulate(np.where(begins, place, 0)) >= most
                    values = values.take(pa.array(place, mask=late))
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, table.num_rows).astype(np.int32)), values))
            yield pa.RecordBatch.from_arrays(columns, [key, "seen", *lists])

    return rows.mapInArrow(pack, schema)


def merged(rows, lists):
    """The packs of a key as one list per column, by time and id, and each entry's (pack, place)."""
    packs = list(rows)
    entries = [(us, i, p, n) for p, row in enumerate(packs) for n, (us, i) in enumerate(zip(row["us"], row["id"]))]
    if len(packs) > 1:
        entries.sort(key=lambda e: e[:2])
    return packs, entries, [[packs[p][c][n] for _, _, p, n in entries] for c in lists]


# --- stored answers ----------------------------------------------------------


class _Answers(StatefulProcessor):
    """State of a key: the request sent last, while its answer is valid."""

    def __init__(self, ttl, id_type):
        self.ttl, self.id_type = ttl, id_type

    def init(self, handle):
        self.handle = handle
        self.sent = handle.getValueState("sent", f"us long, id {self.id_type}")

    def handleInputRows(self, key, rows, timerValues):
        _, entries, (ok,) = merged(rows, ["ok"])
        us = np.array([e[0] for e in entries], np.int64)
        ids = [e[1] for e in entries]
        last = self.sent.get()
        # The stored answer serves whatever comes in before it runs out.
        fresh = np.arange(len(us)) if last is None else np.flatnonzero(us > last[0] + self.ttl)
        answer, hit = [None if last is None else last[1]] * len(us), np.ones(len(us), bool)
        hit[fresh] = False
        if len(fresh):
            stores = np.array(ok, bool)[fresh]
            serving, sent = chain.answers(np.zeros(1, np.int64), us[fresh], stores, np.zeros(len(fresh), bool), self.ttl)
            for place, by, new in zip(fresh.tolist(), serving.tolist(), sent.tolist()):
                answer[place] = None if by < 0 else ids[fresh[by]]
                hit[place] = by >= 0 and not new
            if sent.any():
                newest = int(fresh[np.flatnonzero(sent)[-1]])
                self.sent.update((int(us[newest]), ids[newest]))
                if last is None:
                    self.handle.registerTimer(int(us[newest] + self.ttl) // 1000 + 1)
        hit = hit.tolist()
        for a in range(0, len(ids), LISTED):
            b = a + LISTED
            yield Row(request_ids=ids[a:b], answer_ids=answer[a:b], hits=hit[a:b])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last = self.sent.get()
        if last is not None:
            ends = (last[0] + self.ttl) // 1000 + 1
            if ends <= expiredTimerInfo.getExpiryTimeInMs():
                self.sent.clear()
            else:
                self.handle.registerTimer(ends)
        return iter([])


def stream_request_reuse(
    requests, key_cols, *, ts="ts", id_col="request_id", ttl_seconds=CACHE_TTL_SECONDS, cacheable=None, ok=None, watermark="10 minutes"
):
    """Live :func:`~guardlake.operators.dedup.dedup_requests`: (id, ``answer_id``, ``from_cache``) of every request.

    Batches are taken in the order they come; inside a batch time and id order
    requests.  A key's state is its last sent request, until the watermark passes
    the end of its answer.  Rows of a task batch whose latest request is later than
    the watermark allows are left out and counted by Spark.
    """
    ttl, id_type, good = int(ttl_seconds) * 1_000_000, dict(requests.dtypes)[id_col], flag(ok)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    asked = flag(cacheable) & us.isNotNull()
    slim = requests.where(asked).select(key_digest(key_cols).alias("key"), us.alias("us"), F.col(id_col).alias("id"), good.alias("ok"))
    schema = f"request_ids array<{id_type}>, answer_ids array<{id_type}>, hits array<boolean>"
    live = packed(slim, "key").withWatermark("seen", watermark).groupBy("key")
    live = live.transformWithState(_Answers(ttl, id_type), schema, "Append", "EventTime")
    listed = live.select(F.inline(F.arrays_zip("request_ids", "answer_ids", "hits")).alias(id_col, "answer_id", "from_cache"))
    through = requests.where(~asked).select(id_col, F.when(good, F.col(id_col)).alias("answer_id"), F.lit(False).alias("from_cache"))
    return listed.unionByName(through)


# --- agent sessions ----------------------------------------------------------

_SUMS = "calls allowed flagged blocked drops pii_calls".split()
_HEAD = (
    "started long, attempts long, flag_run long, critical_at long, closed long, last long, "
    + ", ".join(f"{c} long" for c in _SUMS)
    + ", credits double, pii_first long, second long, critical_violations long, prev_score double, recent array<double>, has array<boolean>, "
    "early array<double>, early_n array<long>, late array<double>, late_n array<long>"
)
_NEW = {
    "started": None, "attempts": 0, "flag_run": 0, "critical_at": None, "closed": None, "last": None, **dict.fromkeys(_SUMS, 0),
    "credits": None, "pii_first": None, "second": None, "critical_violations": 0, "prev_score": None, "recent": (), "has": (),
    "early": (0.0,) * 8, "early_n": (0,) * 8, "late": (0.0,) * 8, "late_n": (0,) * 8,
}
REASONS = (None, "max_tool_calls", "ttl_expired", "critical_violation")
PATTERN = "struct<pattern:string,description:string,severity:string,first_us:long>"


def fixed(x, decimals=1):
    """Fixed-decimal text of the exact binary value, away from zero on a tie."""
    return str(Decimal(x).quantize(Decimal(1).scaleb(-decimals), ROUND_HALF_UP))


class _Sessions(StatefulProcessor):
    """State of a session: counters, first block by tool, distinct violations, calls of the second half."""

    def __init__(self, id_type, max_calls, ttl_us, block_after_critical, deep_every_n, escalate_after_flags, base_mode, forget_us, as_of, word):
        self.id_type, self.max_calls, self.ttl, self.block = id_type, max_calls, ttl_us, block_after_critical
        self.deep_every_n, self.escalate, self.base_mode = deep_every_n, escalate_after_flags, base_mode
        self.forget, self.as_of, self.word = forget_us, as_of, word

    def init(self, handle):
        self.handle = handle
        self.head = handle.getValueState("head", _HEAD)
        self.blocks = handle.getMapState("blocks", "tool string", "n long, retry long")
        self.violations = handle.getMapState("violations", "name string", "n long")
        self.second_half = handle.getListState("second_half", "us long, dims array<double>")

    def handleInputRows(self, key, rows, timerValues):
        packs, entries, (marks,) = merged(rows, ["marks"])
        us, marks = np.array([e[0] for e in entries], np.int64), np.array(marks, np.int64)
        stored = self.head.get()
        head = None if stored is None else dict(zip(_NEW, stored))
        parts = ({}, set(), []) if head is None else self._parts()
        if head is None:
            self.handle.registerTimer((int(us[-1]) + self.forget) // 1000 + 1)
        # Silence parts a session's calls, whatever the batches are.
        before = np.concatenate([us[:1] if head is None else [head["last"]], us[:-1]])
        cuts = np.flatnonzero(us - before > self.forget).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(us)]):
            if a in cuts and head is not None:
                yield self._summary(key, head, parts, True)
                self._forget()
                head = None
            if a == b:
                continue
            head, parts = (dict(_NEW), ({}, set(), [])) if head is None else (head, parts)
            reason, mode, attempt, run = self._judge(head, us[a:b], marks[a:b])
            accepted = [{**packs[p]["detail"][n], "us": t} for (t, _, p, n), r in zip(entries[a:b], reason.tolist()) if r == 0]
            if accepted:
                self._take(head, accepted, *parts)
            for i in range(a, b, LISTED):
                own = slice(i - a, min(i + LISTED, b) - a)
                yield self._row(
                    key,
                    call_ids=[e[1] for e in entries[i : min(i + LISTED, b)]],
                    reasons=[REASONS[r] for r in reason[own].tolist()],
                    modes=mode[own].tolist(),
                    attempts=attempt[own].tolist(),
                    flag_runs=run[own].tolist(),
                )
        self.head.update(tuple(list(head[c]) if isinstance(head[c], tuple) else head[c] for c in _NEW))
        yield self._summary(key, head, parts, False)

    def _forget(self):
        for state in (self.head, self.blocks, self.violations, self.second_half):
            state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        stored = self.head.get()
        if stored is None:
            return
        head = dict(zip(_NEW, stored))
        ends = (head["last"] + self.forget) // 1000 + 1
        if ends > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(ends)
            return
        yield self._summary(key, head, self._parts(), True)
        self._forget()

    def _judge(self, head, us, marks):
        """Reason, depth, number and run of flags before each of the new attempts; moves the counters on."""
        m, before = len(us), head["attempts"]
        place = np.arange(m)
        flagged, critical = (marks & FLAGGED) > 0, (marks & CRITICAL) > 0
        number = before + place + 1
        head["started"] = int(us[0]) if head["started"] is None else head["started"]
        expired = us >= head["started"] + self.ttl
        first = np.flatnonzero(critical)[:1]
        if head["critical_at"] is not None:
            critical_at = np.full(m, head["critical_at"])
        else:
            critical_at = np.where(place > first[0], before + first[0] + 1, 0) if len(first) else np.zeros(m, np.int64)
            head["critical_at"] = before + int(first[0]) + 1 if len(first) else None
        halted = (critical_at > 0) & self.block
        unblocked = ~halted | (critical_at >= self.max_calls)
        reason = np.where((number > self.max_calls) & unblocked, 1, np.where(expired, 2, np.where(halted, 3, 0)))
        clear = np.maximum.accumulate(np.where(flagged, -1, place))
        clear = np.concatenate([[-1], clear])  # latest call without a flag before each
        run = np.where(clear < 0, head["flag_run"] + np.arange(m + 1), np.arange(m + 1) - 1 - clear)
        deep = (run[:-1] >= self.escalate) if self.escalate > 0 else np.zeros(m, bool)
        if self.deep_every_n > 0:
            deep |= (number > 1) & ((number - 1) % self.deep_every_n == 0)
        mode = np.where(deep, "deep", np.array(self.base_mode, object)).astype(object)
        mode[reason > 0] = None
        closing = us[(reason == 1) | (reason == 2)]
        if head["closed"] is None and len(closing):
            head["closed"] = int(closing[0])
        head["attempts"], head["flag_run"] = before + m, int(run[-1])
        head["last"] = max(int(us.max()), head["last"] if head["last"] is not None else int(us.max()))
        return reason, mode, number, run[:-1]

    def _parts(self):
        blocks = {k[0]: tuple(v) for k, v in self.blocks.iterator()}
        return blocks, {k[0] for k in self.violations.keys()}, [(r[0], r[1]) for r in self.second_half.get()]

    def _take(self, head, calls, blocks, seen, half):
        """Fold the accepted calls into the counters, the tools' first blocks, the violations and the halves' sums."""
        head["recent"] = list(head["recent"])
        sums = {c: list(head[c]) for c in ("early", "early_n", "late", "late_n")}

        def move(dims, part, sign):
            for i, x in enumerate(dims):
                if x is not None:
                    sums[part][i] += sign * x
                    sums[f"{part}_n"][i] += sign

        for call in calls:
            head["calls"] += 1
            n, score, dims = head["calls"], call["score"], list(call["dims"])
            for decision, counter in (("ALLOW", "allowed"), ("FLAG", "flagged"), ("BLOCK", "blocked")):
                head[counter] += call["decision"] == decision
            if call["credits"] is not None:
                head["credits"] = (head["credits"] or 0.0) + call["credits"]
            head["critical_violations"] += call["criticals"]
            if call["pii"]:
                head["pii_calls"] += 1
                head["pii_first"] = call["us"] if head["pii_first"] is None else head["pii_first"]
            if score is not None and head["prev_score"] is not None and score < head["prev_score"]:
                head["drops"] += 1
            head["prev_score"] = score
            head["recent"] = [*head["recent"], score][-5:]
            if n == 1:
                head["has"] = [x is not None for x in dims]
            if n == 2:
                head["second"] = call["us"]
            tool = json.dumps(call["tool_name"])
            if tool in blocks:
                if blocks[tool][1] is None:
                    blocks[tool] = (blocks[tool][0], call["us"])
                    self.blocks.updateValue((tool,), blocks[tool])
            elif call["decision"] == "BLOCK":
                blocks[tool] = (n, None)
                self.blocks.updateValue((tool,), blocks[tool])
            for name in call["violated"]:
                if name not in seen:
                    seen.add(name)
                    self.violations.updateValue((name,), (n,))
            half.append((call["us"], dims))
            move(dims, "late", 1)
            while len(half) > n - n // 2:  # the first half has floor(n / 2) calls
                _, dims = half.pop(0)
                move(dims, "late", -1)
                move(dims, "early", 1)
        head.update(sums)
        self.second_half.put([(t, list(d)) for t, d in half])

    def _patterns(self, head, parts):
        blocks, seen, half = parts
        calls, found = head["calls"], []
        # The wording of the descriptions, but for the score's name.
        if head["pii_calls"] >= 3:
            found.append(("repeated_pii_access", f"Tool accessed PII fields in {head['pii_calls']} of {calls} calls", "high", head["pii_first"]))
        if calls >= 3 and head["drops"] >= 3:
            found.append(("escalating_risk_scores", f"{self.word} dropped in {head['drops']} consecutive calls", "high", head["second"]))
        for tool, (_, retry) in sorted(blocks.items(), key=lambda b: b[1][0]):
            if retry is not None:
                tool = json.loads(tool)
                text = None if tool is None else f'Tool "{tool}" was blocked and called again'
                found.append(("blocked_retry", text, "medium", retry))
        if len(seen) > 3:
            text = f"{len(seen)} distinct compliance violations accumulated across the session"
            found.append(("compliance_accumulation", text, "high", head["last"] if self.as_of is None else self.as_of))
        for i, d in enumerate(DIMENSIONS):
            if calls < 4 or not head["has"][i] or not head["early_n"][i] or not head["late_n"][i]:
                continue
            drop = round(head["early"][i] / head["early_n"][i] - head["late"][i] / head["late_n"][i], 9)
            if drop >= 2.0:
                found.append(("dimension_degradation", f"Average {d} score dropped {fixed(drop)} points over the session", "medium", half[0][0]))
        return found

    def _summary(self, key, head, parts, expired):
        recent = [s for s in head["recent"] if s is not None]
        last = list(head["recent"])[-3:]
        trend = "stable"
        if len(last) == 3:
            a, b, c = last
            if c is not None and c <= 3.0:
                trend = "critical"
            elif None not in last:
                trend = "escalating" if c < b < a else "improving" if c > b > a else "stable"
        return self._row(
            key,
            status="active" if head["closed"] is None else "closed",
            expired=expired,
            started_us=head["started"],
            closed_us=head["closed"],
            total_attempts=head["attempts"],
            total_tool_calls=head["calls"],
            allowed=head["allowed"],
            flagged=head["flagged"],
            blocked=head["blocked"],
            critical_violations=head["critical_violations"],
            distinct_violations=len(parts[1]),
            current_risk_score=sum(recent) / len(recent) if recent else 0.0,
            risk_trend=trend,
            total_credits=head["credits"],
            patterns=self._patterns(head, parts),
        )

    def _row(self, key, **values):
        return Row(**{c: values.get(c) for c in _COLUMNS} | {"session_id": key[0]})


_OUT = (
    "call_ids array<{id}>, reasons array<string>, modes array<string>, attempts array<long>, flag_runs array<long>, "
    "status string, expired boolean, started_us long, closed_us long, total_attempts long, total_tool_calls long, allowed long, flagged long, "
    "blocked long, critical_violations long, distinct_violations long, current_risk_score double, risk_trend string, total_credits double, "
    f"patterns array<{PATTERN}>"
)
_COLUMNS = ["session_id", *(c.strip().split(" ")[0] for c in _OUT.split(f", patterns array<{PATTERN}>")[0].split(", ")), "patterns"]


def stream_agent_sessions(
    calls,
    *,
    max_calls=100,
    ttl_minutes=720,
    block_after_critical=True,
    deep_every_n=0,
    escalate_after_flags=3,
    base_mode=None,
    forget_minutes=None,
    watermark="10 minutes",
    as_of=None,
    score_word=SCORE_WORD,
):
    """Live agent sessions: depth and acceptance of each call, and the session's figures and patterns after each batch.

    Rows either list calls (``call_ids`` and lists beside it) or sum a session up
    (``status`` and what follows); :func:`session_calls` and
    :func:`session_summaries` read them.  Batches are taken in the order they come.
    A session silent for more than ``forget_minutes`` (by default the time to live)
    comes out once more, ``expired``, and leaves the state once the watermark or its
    next call is past that; a later call with its id begins a new one.  ``as_of`` stands for the time of
    asking, by default that of the session's last call.

    Details of a call travel only if it can still be accepted, the first
    ``max_calls`` of a task batch; of others time, id and two marks do.
    """
    types = dict(calls.dtypes)
    names = F.transform("violations", lambda v: F.to_json(F.array(F.coalesce(v["framework"], F.lit("\0")), F.coalesce(v["article"], F.lit("\0")))))
    marks = F.when(F.col("decision") == "FLAG", FLAGGED).otherwise(0) + F.when(is_critical(), CRITICAL).otherwise(0)
    detail = F.struct(
        "tool_name",
        F.col("score").cast("double").alias("score"),
        "decision",
        (F.size("pii_fields") > 0).alias("pii"),
        F.coalesce(names, F.array().cast("array<string>")).alias("violated"),
        F.coalesce(F.size(F.filter("violations", lambda v: v["severity"] == "critical")), F.lit(0)).alias("criticals"),
        F.col("credits").cast("double").alias("credits"),
        F.array(*[F.col(c).cast("double") for c in DIM_COLUMNS]).alias("dims"),
    )
    slim = calls.select(
        "session_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        F.col("call_id").alias("id"),
        F.coalesce(marks, F.lit(0)).cast("tinyint").alias("marks"),
        detail.alias("detail"),
    ).where("us is not null")
    minute = 60_000_000
    processor = _Sessions(
        types["call_id"], max_calls, int(ttl_minutes * 60) * 1_000_000, block_after_critical, deep_every_n, escalate_after_flags, base_mode,
        int((ttl_minutes if forget_minutes is None else forget_minutes) * minute), as_of, score_word,
    )
    live = packed(slim, "session_id", most=max_calls, gap=processor.forget).withWatermark("seen", watermark).groupBy("session_id")
    return live.transformWithState(processor, f"session_id {types['session_id']}, " + _OUT.format(id=types["call_id"]), "Append", "EventTime")


def session_calls(spark, path):
    """(session_id, call_id, accepted, reject_reason, mode, attempt, flag_run) from a table of :func:`stream_agent_sessions`."""
    rows = spark.read.parquet(path).where("call_ids is not null")
    zipped = F.inline(F.arrays_zip("call_ids", "reasons", "modes", "attempts", "flag_runs"))
    rows = rows.select("batch_id", "session_id", zipped.alias("call_id", "reject_reason", "mode", "attempt", "flag_run"))
    return rows.withColumn("accepted", F.col("reject_reason").isNull())


def session_summaries(spark, path):
    """Latest figures of each session from a table of :func:`stream_agent_sessions`."""
    rows = spark.read.parquet(path).where("status is not null")
    fields = [c for c in _COLUMNS[_COLUMNS.index("status") :]]
    # Inside a batch a session that expired and began anew is summed up twice; the later start is the newer one.
    newest = F.max_by(F.struct(*fields), F.struct("batch_id", "started_us", "expired"))
    out = rows.groupBy("session_id").agg(newest.alias("r")).select("session_id", "r.*")
    at = {f"{c}_at": F.timestamp_micros(f"{c}_us").cast("timestamp_ntz") for c in ("started", "closed")}
    seen = lambda p: F.struct(p["pattern"], p["description"], p["severity"], F.timestamp_micros(p["first_us"]).cast("timestamp_ntz").alias("first_seen"))
    return out.withColumns(at | {"patterns": F.transform("patterns", seen)}).drop("started_us", "closed_us")
