"""Row-by-row model of the rules in arrival order (test oracle only)."""

from __future__ import annotations

from collections import defaultdict


def window_rule(rows, key, threshold, size_ms=120_000):
    acc = {}
    for r in rows:                      # rows in arrival order
        k = (r[key], r["event_time"] // size_ms)
        n, _ = acc.get(k, (0, None))
        acc[k] = (n + 1, r)             # last-arrived row wins
    return sorted((k[0], n, last["transaction_id"]) for k, (n, last) in acc.items()
                  if n > threshold)


def high_amount(rows, history=20, min_history=5):
    hist = defaultdict(list)
    out = []
    for r in rows:
        h = hist[r["customer_id"]]
        cents = round(r["amount"] * 100)
        if len(h) >= min_history:
            s = sum(h)
            if cents * len(h) >= 3 * s and cents > 50000:
                out.append((r["customer_id"], r["transaction_id"], len(h), s))
        h.append(cents)
        del h[:-history]
    return sorted(out)


def impossible_travel(rows, max_gap=1_800_000):
    last = {}
    out = []
    for r in rows:
        p = last.get(r["card_id"])
        if p is not None and p[0] != r["country"] and r["event_time"] - p[1] < max_gap:
            gap = r["event_time"] - p[1]
            minutes = int(gap / 60_000)            # truncates toward zero
            out.append((r["card_id"], r["transaction_id"], p[0], minutes))
        last[r["card_id"]] = (r["country"], r["event_time"])
    return sorted(out)


def late_rows(rows, window_ms, lateness_ms, delay_ms=5_000):
    out = []
    mx = None
    for r in rows:
        et = r["event_time"]
        end = et - et % window_ms + window_ms
        if mx is not None and end + lateness_ms <= mx - delay_ms:
            out.append(r["transaction_id"])
        mx = et if mx is None else max(mx, et)
    return sorted(out)


def minute_emissions(rows, window_ms=60_000, lateness_ms=10_000, delay_ms=5_000):
    """Per-row watermark replay of metric 1: fire when the watermark passes a
    window, re-fire for each row accepted afterwards, flush at end of input."""
    mx = None
    state = {}                      # window end -> [n, cents, fired, re-emissions]
    out = []
    for r in rows:
        et = r["event_time"]
        e = et - et % window_ms + window_ms
        wm = None if mx is None else mx - delay_ms
        if wm is None or e + lateness_ms > wm:            # not late
            s = state.setdefault(e, [0, 0, False, 0])
            s[0] += 1
            s[1] += round(r["amount"] * 100)
            if wm is not None and wm >= e:                 # watermark already past
                s[2] = True
                s[3] += 1
                out.append((e, s[3], "late_row", s[0], s[1]))
        mx = et if mx is None else max(mx, et)
        for e2, s in state.items():
            if not s[2] and e2 + delay_ms <= mx:
                s[2] = True
                out.append((e2, 0, "watermark", s[0], s[1]))
    for e2, s in state.items():
        if not s[2]:
            out.append((e2, 0, "end_of_input", s[0], s[1]))
    return sorted(out)
