import itertools
import random

import numpy as np
import pytest

from farebox.llm import crf
from farebox.llm.language import _words, fitted, identified, predicted, spans
from farebox.llm.queries import op11_language
from llm_cases import SCHEMA, edge_rows

STOCK = {
    "nord": ["skjor", "fjell", "vinden", "bakke", "og", "huset", "gaten", "sommer", "kveld", "brygge"],
    "sud": ["palazzo", "cielo", "vento", "collina", "e", "casa", "strada", "estate", "sera", "ponte"],
    "ost": ["дорога", "небо", "ветер", "холм", "и", "дом", "улица", "лето", "вечер", "мост"],
}


def prose(lang, seed, words=60):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(STOCK[lang]) + rng.choice(["", "", "en", "a"]) for _ in range(words))


def frame(spark, rows):
    full = [(i, t, lang, "s", None if t is None else len(t), 7, "h", "t", 1, "p", "x") for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def corpus(n=90):
    langs = sorted(STOCK)
    return [(i, prose(langs[i % 3], i), langs[i % 3]) for i in range(n)]


@pytest.fixture(scope="module")
def field(spark):
    return fitted(frame(spark, corpus()))


def every_path(scores, moves):
    """Marginals by listing all label sequences."""
    n, k = scores.shape
    into = np.exp(moves).sum(axis=0) / k
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = into[path[0]] * np.exp(sum(scores[i, y] for i, y in enumerate(path)))
        weight *= np.exp(sum(moves[a, b] for a, b in zip(path, path[1:])))
        for i, y in enumerate(path):
            out[i, y] += weight
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_marginals_against_all_paths(block):
    rng = np.random.default_rng(block)
    lengths = np.array([1, 6, 2, 5, 7])
    scores, moves = rng.normal(0, 2, (lengths.sum(), 3)), rng.normal(0, 1, (3, 3))
    got = np.split(crf.marginals(scores, lengths, moves, block), np.cumsum(lengths)[:-1])
    for part, mine in zip(np.split(scores, np.cumsum(lengths)[:-1]), got):
        assert np.allclose(mine, every_path(part, moves))


def test_blocks_of_long_texts_do_not_show():
    rng = np.random.default_rng(1)
    lengths = np.array([700, 3, 1024, 1, 256, 257])
    scores, moves = rng.normal(0, 3, (lengths.sum(), 4)), rng.normal(0, 1, (4, 4))
    assert np.allclose(crf.marginals(scores, lengths, moves), crf.marginals(scores, lengths, moves, 10**6))


def test_gradient(monkeypatch):
    kept = {}
    monkeypatch.setattr(crf, "_minimum", lambda loss, x, steps: kept.update(loss=loss, n=len(x)) or x)
    sequences = [[("ab", 0), ("ba", 1), ("ab", 0)], [("c", 1), ("ab", 1)]]
    crf.fit(sequences, ["x", "y"], {"ab": [3.0, 1.0]}, np.array([5.0, 4.0]))
    rng = np.random.default_rng(2)
    x, way = rng.normal(0, 0.5, kept["n"]), rng.normal(0, 1, kept["n"])
    value = [kept["loss"](x + step * way)[0] for step in (-1e-5, 1e-5)]
    assert np.isclose((value[1] - value[0]) / 2e-5, kept["loss"](x)[1] @ way, rtol=1e-5)


def test_words():
    assert _words("Été 2nd, don't Öl³ x_y") == ["été", "nd", "don", "t", "öl", "x", "y"]
    assert [len(w) for w in _words("ж" * 60)] == [24, 24, 12] and _words("12 !? 3") == []


def test_switched_text(spark, field):
    text = prose("nord", 1000, 30) + ". " + prose("sud", 1001, 30) + "\n" + prose("ost", 1002, 30)
    docs = frame(spark, [(1, text, None)])
    found = [(r.lang, text[r.start : r.end]) for r in spans(docs, field).orderBy("start").collect()]
    assert [lang for lang, _ in found] == ["nord", "sud", "ost"]
    assert found[1][1] == prose("sud", 1001, 30)
    shares = predicted(docs, field).first().shares
    assert abs(sum(shares.values()) - 1) < 1e-9 and min(shares.values()) > 0.2


def test_transitions_favour_the_same_language(field):
    assert (np.diag(field.moves) > field.moves.max(axis=1) - 1e-12).all()


def test_edges(spark, field):
    rows = [(i, t, "nord") for i, t in edge_rows()]
    got = {}
    for r in identified(frame(spark, rows + [(100 + i, t, x) for i, t, x in corpus(30)])).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) + 30
    assert all(0 <= r.score <= 1 for rs in got.values() for r in rs)
    for i in (1, 2, 3):
        assert [(r.lang_pred, r.score) for r in got[i]] == [("und", 0.0)]
    assert len({(r.lang_pred, r.score) for r in got[6]}) <= 2 and len(got[6]) == 3
    assert sorted(r.lang_pred for r in got[None])[-1] == "und" and not any(r.held_out for r in got[None])
    assert all(got[100 + i][0].lang_pred == lang for i, _, lang in corpus(30))


def test_nothing_to_learn(spark, empty):
    assert identified(empty).count() == 0
    rows = [(1, "some words", None), (2, None, "nord"), (3, "12", "sud")]
    assert {(r.lang_pred, r.score) for r in identified(frame(spark, rows)).collect()} == {("und", 0.0)}
    assert spans(frame(spark, rows), None).count() == 0


def test_one_language(spark):
    rows = [(i, prose("sud", i), "sud") for i in range(20)]
    assert {r.lang_pred for r in identified(frame(spark, rows)).collect()} == {"sud"}


def test_same_result_however_the_table_is_dealt(spark):
    docs = frame(spark, corpus())
    first, second = (sorted(map(tuple, identified(d).collect())) for d in (docs.repartition(1), docs.repartition(7)))
    assert [r[:3] for r in first] == [r[:3] for r in second]
    assert np.allclose([r[3] for r in first], [r[3] for r in second])


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op11_language(spark, sf_dir).where("held_out").join(docs, "doc_id").where("lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) > 0
