import re

import numpy as np
from llm_cases import edge_rows, frame, prose
from farebox.llm import jaccard
from farebox.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    linked = [[i != j and (a == b or bool(a | b) and 10 * len(a & b) >= 8 * len(a | b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *[label[j] for j in range(len(rows)) if linked[i][j]]]) for i in range(len(rows))]
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[label[i]] = min(ids.get(label[i], doc), doc)
    return [(doc, ids.get(label[i]), sum(linked[i])) for i, (doc, _) in enumerate(rows)]


def classes(rows):
    """The sets of texts that links connect."""
    named = plain([(i, t) for i, (_, t) in enumerate(rows)])
    return len({c for _, c, _ in named})


def key(row):
    return tuple("" if x is None else str(x) for x in row)


def varied(n, words=150):
    base, out = prose(77, words).split(), []
    for i in range(n):
        w = list(base)
        for k in range(i % 7):
            w[(i * 37 + k * 11) % len(w)] = f"edit{i}{k}"
        out.append(" ".join(w))
    return out


def check(docs, rows):
    got = [tuple(r) for r in jaccard.joined(docs).select("doc_id", "class_id", "n_links").collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_against_plain_code(edges):
    check(edges, edge_rows())


def test_group_of_near_copies_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    rows = list(enumerate(varied(90) + [prose(i) for i in range(30)]))
    check(frame(spark, rows), rows)


def test_one_row_of_each_class_stays(spark, edges, empty):
    kept = jaccard.one_of_each(edges)
    assert kept.schema == edges.schema
    got = [r.doc_id for r in kept.collect()]
    assert len(got) == classes(edge_rows())
    assert {d for d in got if d is not None} == {c for _, c, _ in plain(edge_rows()) if c is not None}
    assert jaccard.one_of_each(empty).count() == 0


def test_shuffled_joins_give_the_same(edges, monkeypatch):
    monkeypatch.setattr(jaccard, "sized", lambda df: df)
    check(edges, edge_rows())


def test_pruning_keeps_pairs_at_the_threshold():
    needed = jaccard.least_matches(0.8, 16, 128, 1e-7)
    assert list(needed) == sorted(needed) and needed[-1] < 0.8 * 128 and needed[-1] > 0.45 * 128
    rng = np.random.default_rng(1)
    sets, left, right = [], [], []
    for i in range(60):
        shared, own = rng.integers(0, 2**63, 80, dtype=np.uint64), rng.integers(0, 2**63, 20, dtype=np.uint64)
        sets += [np.unique(np.append(shared, own[:10])), np.unique(np.append(shared, own[10:]))]
        left.append(2 * i)
        right.append(2 * i + 1)
    assert jaccard.links(sets, np.array(left), np.array(right), 0.8).all()
    assert not jaccard.links(sets, np.array(left), np.array(right), 0.81).any()


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
