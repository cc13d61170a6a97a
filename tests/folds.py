"""Plain folds over one session's calls, the yardstick for the session operators."""


def mode_of(past, deep_every_n, escalate_after_flags, base):
    run = 0
    for call in reversed(past):
        if call["decision"] != "FLAG":
            break
        run += 1
    if escalate_after_flags > 0 and run >= escalate_after_flags:
        return "deep"
    if deep_every_n > 0 and past and len(past) % deep_every_n == 0:
        return "deep"
    return base


def accept(calls, max_calls, ttl_us, block_after_critical, deep_every_n=0, escalate=3, base=None):
    """(accepted, reason, mode) per attempt, in order, and the time the session closed."""
    kept, closed_at, critical, out = [], None, False, []
    start = calls[0]["ts"] if calls else None
    for i, call in enumerate(calls):
        late = call["ts"] - start >= ttl_us
        if closed_at is None and (len(kept) >= max_calls or late):
            closed_at = call["ts"]
        blocked = block_after_critical and critical
        if closed_at is None and not blocked:
            out.append((True, None, mode_of(kept, deep_every_n, escalate, base)))
            kept.append(call)
            critical = critical or call["critical"]
            continue
        # The reason names the limit this very attempt runs into.
        if i >= max_calls and not (blocked and len(kept) < max_calls):
            reason = "max_tool_calls"
        else:
            reason = "ttl_expired" if late else "critical_violation"
        out.append((False, reason, None))
    return out, closed_at


def patterns(calls, as_of):
    """Set of (pattern, first_seen, key) found."""
    found = set()
    pii = [c for c in calls if c["pii"]]
    if len(pii) >= 3:
        found.add(("repeated_pii_access", pii[0]["ts"], len(pii)))
    drops = sum(1 for a, b in zip(calls, calls[1:]) if b["score"] < a["score"])
    if len(calls) >= 3 and drops >= 3:
        found.add(("escalating_risk_scores", calls[1]["ts"], drops))
    for tool in {c["tool"] for c in calls}:
        mine = [c for c in calls if c["tool"] == tool]
        first = next((i for i, c in enumerate(mine) if c["decision"] == "BLOCK"), None)
        if first is not None and len(mine) > first + 1:
            found.add(("blocked_retry", mine[first + 1]["ts"], tool))
    ids = {c["violation"] for c in calls if c["violation"]}
    if len(ids) > 3:
        found.add(("compliance_accumulation", as_of, len(ids)))
    half = len(calls) // 2
    if len(calls) >= 4:
        for dim in ("d_safety", "d_privacy"):
            if calls[0][dim] is None:
                continue
            early = [c[dim] for c in calls[:half] if c[dim] is not None]
            late = [c[dim] for c in calls[half:] if c[dim] is not None]
            if early and late and round(sum(early) / len(early) - sum(late) / len(late), 9) >= 2.0:
                found.add(("dimension_degradation", calls[half]["ts"], dim[2:]))
    return found


def trend(calls):
    if len(calls) < 3:
        return "stable"
    a, b, c = (x["score"] for x in calls[-3:])
    if c <= 3.0:
        return "critical"
    if c < b < a:
        return "escalating"
    if c > b > a:
        return "improving"
    return "stable"


def sent(times, ttl):
    """Distinct times at which a request is really sent."""
    out, last = [], None
    for t in sorted(set(times)):
        if last is None or t > last + ttl:
            out.append(t)
            last = t
    return out
