import zlib

import numpy as np
import pytest
from llm_cases import frame, prose
from farebox.llm import quality


def corpus():
    rows = []
    for i in range(160):
        text = prose(i, 60 + i % 90)
        if i % 3 == 0:
            text = [" ".join(w + "$$" for w in text.split()), " ".join(f"{w} {w} {w}" for w in text.split()[:30]), text.upper().replace(" ", "!! ")][i // 3 % 3]
        rows.append((i, text))
    return rows


def test_held_out_accuracy_and_fold(spark, edges):
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(160)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = quality.scored(frame(spark, corpus()), labels).collect()
    assert len(got) == 160
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 3 != 0) for r in held]) >= 0.9
    edge = quality.scored(edges, labels).collect()
    assert len(edge) == edges.count() and all(0 <= r.score <= 1 for r in edge)


def test_held_out_labels_teach_nothing(spark):
    rows = [(i, int(i % 3 != 0)) for i in range(160)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in rows]
    docs = frame(spark, corpus())
    scores = [{r.doc_id: r.score for r in quality.scored(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (rows, turned)]
    assert scores[0] == pytest.approx(scores[1])


def test_densities_match_plain_algebra(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (300, 3)), rng.normal(1, [1, 3, 0.2], (200, 3))])
    y = np.repeat([0, 1], [300, 200])
    names = ["x_a", "x_b", "x_c"]
    df = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], "x_a double, x_b double, x_c double, quality int")
    model = quality.fit(df, "quality", names)
    got = np.array([r[0] for r in df.select(quality.score(model, names)).collect()])
    scale = x.std(axis=0)
    logs = []
    both = sum(np.cov((x[y == c] / scale).T, bias=True) * (y == c).mean() for c in (0, 1))
    for c in (0, 1):
        z = x[y == c] / scale
        cov = (1 - quality.POOLED) * np.cov(z.T, bias=True) + quality.POOLED * both
        cov = (1 - quality.SHRINKAGE) * cov + (quality.SHRINKAGE * np.trace(cov) / 3 + quality.FLOOR) * np.eye(3)
        off = x / scale - z.mean(axis=0)
        logs.append(np.log((y == c).mean()) - np.linalg.slogdet(cov)[1] / 2 - np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off) / 2)
    assert got == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])), rel=1e-6)


def test_without_labels_or_rows(spark, edges, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.scored(edges, none).collect()} == {0.5}
    assert quality.scored(empty, none).count() == 0
