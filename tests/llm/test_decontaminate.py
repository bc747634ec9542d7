import hashlib
import re

import pytest
from llm_cases import edge_rows, frame, prose
from farebox.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(rows, items, window=13):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(str(item if item is not None else ""))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def key(row):
    return tuple("" if x is None else str(x) for x in row)


@pytest.fixture(scope="module")
def items(spark):
    w = prose(6).split()
    rows = [(1, " ".join(w[10:40])), (2, " ".join(w[10:40])), (3, "TWO, Words!"), (4, None), (5, ""), (6, "?!")]
    rows += [(None, " ".join(prose(12, 30000).split()[500:530])), (7, "not in any text at all")]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def test_against_plain_code(edges, items):
    got = [tuple(r) for r in decontaminate.judged(edges, items[1]).collect()]
    assert sorted(got, key=key) == sorted(plain(edge_rows(), items[0]), key=key)


def test_shuffled_join_gives_the_same(edges, items, monkeypatch):
    monkeypatch.setattr(decontaminate, "sized", lambda df: df)
    got = [tuple(r) for r in decontaminate.judged(edges, items[1]).collect()]
    assert sorted(got, key=key) == sorted(plain(edge_rows(), items[0]), key=key)


def test_documents_go_or_lose_their_spans(edges, items):
    dirty = sorted(str(r[0]) for r in plain(edge_rows(), items[0]) if r[5])
    kept = decontaminate.clean(edges, items[1])
    assert kept.schema == edges.schema
    assert sorted(str(i) for i, _ in edge_rows()) == sorted([*dirty, *[str(r.doc_id) for r in kept.collect()]])
    cut = decontaminate.clean(edges, items[1], spans=True)
    assert cut.columns == edges.columns and cut.count() == edges.count()
    left = {(r.doc_id, r.text) for r in cut.collect()}
    for doc, text in edge_rows():
        if not any(r[2] for r in plain([(doc, text)], items[0])):
            assert (doc, text) in left
    assert (5, "") in left  # both its words were the item


def test_span_cut_keeps_what_surrounds_the_words(spark):
    docs = frame(spark, [(1, "-- Keep this, ONE two three four! and that.")])
    bench = spark.createDataFrame([(1, "one two, three four")], "item_id long, text string")
    assert decontaminate.clean(docs, bench, spans=True).first().text == "-- Keep this, and that."


def test_empty_tables(edges, empty, items, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.judged(empty, items[1]).count() == 0
    assert decontaminate.judged(edges, none).where("contaminated or n_hit > 0").count() == 0
    assert decontaminate.clean(edges, none).count() == edges.count()


def test_main_path_is_native(spark, sf_dir, items):
    plan = decontaminate.judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), items[1])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
