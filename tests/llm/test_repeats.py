import hashlib

import numpy as np
import pytest
from llm_cases import edge_rows, frame, prose
from farebox.llm import repeats


def plain(rows, depth=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in texts:
        for j in range(len(b) - depth + 1):
            seen[b[j : j + depth]] = seen.get(b[j : j + depth], 0) + 1
    out = []
    for (doc, _), b in zip(rows, texts):
        gone = np.zeros(len(b) + 1, np.int64)
        for j in range(len(b) - depth + 1):
            if seen[b[j : j + depth]] > 1:
                gone[j] += 1
                gone[j + depth] -= 1
        gone = np.append(np.cumsum(gone)[:-1] > 0, False)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((doc, len(b), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple("" if x is None else str(x) for x in row)


def check(docs, rows, depth=200):
    got = [tuple(r) for r in repeats.digest(repeats.without_repeats(docs, depth)).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, depth), key=key)


def test_against_plain_code(edges):
    check(edges, edge_rows())


def test_other_depths_and_exact_lengths(spark):
    a, b = prose(31, 40)[:200], prose(32, 40)[:199]
    rows = [(1, "p" + a + "q"), (2, "r" + a + "s"), (3, "t" + b + "u"), (4, "v" + b + "w"), (5, a[100:] + a[:100]), (6, a)]
    check(frame(spark, rows), rows)
    check(frame(spark, rows), rows, 100)


def test_long_texts_in_runs_and_without_broadcast(edges, monkeypatch):
    monkeypatch.setattr(repeats, "sized", lambda df: df)
    check(edges, edge_rows())
    import farebox.llm.repeats as module

    data = np.frombuffer(prose(12, 30000).encode(), np.uint8)
    bounds = np.array([0, len(data)])
    whole = {(int(b) + i) for _, b, _, n, _, _ in [next(module._stretches(data, bounds, 200))] for b, n in zip(b, n) for i in range(n)}
    monkeypatch.setattr(module, "HELD", 5000)
    parts = [b + i for _, begins, _, counts, _, _ in module._stretches(data, bounds, 200) for b, n in zip(begins.tolist(), counts.tolist()) for i in range(n)]
    assert len(parts) == len(set(parts)) and set(parts) == whole


def test_empty_and_bounds(edges, empty):
    assert repeats.without_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        repeats.without_repeats(edges, 20)
