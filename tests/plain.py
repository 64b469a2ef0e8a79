"""Plain Python versions of the sequence operators, for comparison on small inputs."""

import pandas as pd


def local_maxima(group, skip=True):
    kept = [r for p, r in enumerate(group) if not (skip and p in (0, 3))]
    return [b for a, b, c in zip(kept, kept[1:], kept[2:]) if a["vSum"] < b["vSum"] > c["vSum"]]


def cycle_peaks(group, gap, skip=True):
    found, anchor = [], None
    for r in local_maxima(group, skip):
        anchor = r["timeMs"] if anchor is None else anchor
        if r["timeMs"] - anchor > gap:
            found.append(r)
            anchor = None
    return found


def throttled(group, gap):
    sent = []
    for r in group:
        if not sent or r["timeMs"] >= sent[-1]["timeMs"] + gap:
            sent.append(r)
    return sent


def segments(group, gap):
    where = [group.index(p) for p in cycle_peaks(group, gap)]
    return [group[a + 1 : b + 1] for a, b in zip(where, where[2:])]


def resampled(segment, axis):
    width = (segment[-1]["timeMs"] - segment[0]["timeMs"]) // 128
    series = pd.Series(
        [r[axis] for r in segment], index=pd.to_datetime([r["timeMs"] for r in segment], unit="ms"), dtype=float
    )
    return list(series.resample(f"{width}ms").mean().interpolate()[:128])


def grouped(rows, keys=("userID",)):
    groups = {}
    for r in sorted(rows, key=lambda r: (r["timeMs"], r["index"])):
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    return groups


def sessions(events):
    """Per event: session number, point counter, whether an inference is accepted, its position."""
    out = {}
    for group in grouped(events).values():
        session = counter = position = 0
        for e in group:
            if e["kind"] == "point":
                counter += 1
                out[e["index"]] = (session, counter)
            elif e["kind"] == "inference":
                position += counter > 0
                out[e["index"]] = (session, counter > 0, position if counter > 0 else None)
            elif e["kind"] == "stop":
                session, counter, position = session + 1, 0, 0
    return out
