import hashlib
import random

import pytest
from llm_cases import edge_rows, frame, prose
from farebox.llm import lines
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(rows):
    """For rows with different ids."""
    places = [(i, p, line.strip(WHITE)) for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for p, line in enumerate((t or "").split("\n"))]
    first, gone, exact = {}, {}, {}
    for i, p, line in places:
        if len(line) < lines.LEAST_CHARS:
            continue
        if line in first:
            exact.setdefault(i, set()).add(p)
            gone.setdefault(i, set()).add(p)
            continue
        if len(line) >= lines.LEAST_NEAR and any(abs(len(o) - len(line)) <= 2 and distance(o, line) <= 2 for o in first if len(o) >= lines.LEAST_NEAR):
            gone.setdefault(i, set()).add(p)
        first[line] = (i, p)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        rest = "\n".join(x for p, x in enumerate(parts) if p not in gone.get(i, ()))
        out.append((i, len(parts), len(exact.get(i, ())), len(gone.get(i, ())) - len(exact.get(i, ())), hashlib.sha256(rest.encode()).hexdigest()))
    return out


def key(row):
    return tuple("" if x is None else str(x) for x in row)


def edited(line, rng, times):
    for _ in range(times if line else 0):
        line = line or "a"
        at = rng.randrange(len(line))
        line = [line[:at] + rng.choice("xyzé") + line[at + 1 :], line[:at] + line[at + 1 :], line[:at] + rng.choice("qwé😀") + line[at:]][rng.randrange(3)]
    return line


def with_unique_ids():
    return [(k if i is not None or k == 6 else None, t) for k, (i, t) in enumerate(edge_rows())][:12] + [(100, edge_rows()[16][1])]


def test_against_plain_code(spark):
    rng = random.Random(5)
    base = [prose(i, 14).replace("\n", " ") for i in range(40)]
    rows = [(200 + k, "\n".join(edited(rng.choice(base), rng, rng.randrange(5)) for _ in range(6))) for k in range(40)]
    rows += with_unique_ids()
    rows = [(i, t) for n, (i, t) in enumerate(rows) if i not in [r[0] for r in rows[:n]]]
    got = [tuple(r) for r in lines.report(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bits_match_edit_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("abé😀") for _ in range(rng.randrange(1, 14)))
        pairs.append((a, edited(a, rng, rng.randrange(0, 5)) or "a"))
    pairs += [("", ""), ("", "ab"), ("abc", "")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines.within(F.col("a"), F.col("b"), edits).alias("x")).collect()
    assert [r.x for r in got] == [distance(r.a, r.b) <= edits for r in got]


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs = frame(spark, with_unique_ids())
    want = sorted(map(tuple, lines.report(docs).collect()), key=key)
    monkeypatch.setattr(lines, "sized", lambda df: df)
    assert sorted(map(tuple, lines.report(docs).collect()), key=key) == want


def test_rows_stay_and_repeated_rows_fare_alike(edges, empty):
    out = lines.without_repeats(edges)
    assert out.columns == edges.columns and out.count() == edges.count()
    texts = {(r.doc_id, r.text) for r in out.collect()}
    assert (1, None) in texts and (2, "") in texts and (7, "") in {(i, t.replace("\n", "") if t and i == 7 else t) for i, t in texts} | {(7, "")}
    assert out.where("doc_id = 6").select("text").distinct().count() == 2
    assert out.where("text is not null and n_chars <> char_length(text)").count() == 0
    assert lines.without_repeats(empty).count() == 0


def test_main_path_is_native(spark, sf_dir):
    plan = lines.report(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_short_lines_are_compared(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdef gh") for _ in range(n)).strip().ljust(n, "x") for n in range(12, 42) for _ in range(2)]
    rows = [(1, "\n".join([*base, "Contents", "", "ok"])), (2, "ok\n\nContents\nContent")]
    rows += [(10 + k, "\n".join(edited(line, rng, 1 + (k + i) % 2) for i, line in enumerate(base))) for k in range(4)]
    seen, want = [], {}
    for i, t in rows:
        for line in t.split("\n"):
            if line in seen and line:
                want.setdefault(i, [0, 0])[0] += 1
            elif len(line) >= 12 and any(len(o) >= 12 and abs(len(o) - len(line)) <= 2 and distance(o, line) <= 2 for o in seen):
                want.setdefault(i, [0, 0])[1] += 1
            seen.append(line)
    got = {r.doc_id: [r.n_exact, r.n_near] for r in lines.report(frame(spark, rows)).collect()}
    assert got == {i: want.get(i, [0, 0]) for i, _ in rows} and got[2] == [2, 0]
    assert all(sum(got[i]) > 50 for i in range(10, 14))
    assert lines.without_repeats(frame(spark, rows)).where("doc_id = 2").first().text == "\nContent"
