import re
from collections import Counter

from llm_cases import edge_rows
from farebox.llm import rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    twice = {p for i, w in enumerate(windows) if times[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(twice) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice), failed)


def key(row):
    return tuple("" if x is None else str(x) for x in row)


def test_statistics_match_plain_code(edges):
    got = [tuple(r)[:7] for r in rules.judged(edges).collect()]
    assert sorted(got, key=key) == sorted([(i, *plain(t)) for i, t in edge_rows()], key=key)


def test_base_failures_are_never_kept_and_good_prose_is(edges):
    rows = rules.judged(edges).collect()
    assert not [r for r in rows if r.base_failed and r.kept]
    assert {6, 7, 8, 9, 14} <= {r.doc_id for r in rows if r.kept}


def test_each_rule_of_the_table_can_reject(spark):
    from llm_cases import frame, prose

    good = prose(1)
    bad = [
        " ".join(w + "###" for w in good.split()),
        " ".join(w + "!!" for w in good.split()),
        re.sub(r"\b(the|of|and|or)\b", "zz", good),
        " ".join("9" * 4 if i % 3 else w for i, w in enumerate(good.split())) + " " + " ".join(str(i) for i in range(99)),
    ]
    kept = {r.doc_id: r.kept for r in rules.judged(frame(spark, list(enumerate([good, *bad])))).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: False, 4: False}


def test_prose_of_other_languages_is_kept(spark):
    """The stop-word rule speaks of the languages it has words of, and of no other."""
    from llm_cases import frame

    lines = {
        "it": "Il fiume scende dalla montagna e attraversa la pianura che si apre davanti al paese",
        "pt": "O rio desce da montanha e atravessa uma planície que não fica longe da cidade antiga",
        "nl": "De rivier stroomt van het gebergte door een vlakte die niet ver van de stad ligt",
        "sv": "Floden rinner från berget och genom en dal som inte är långt från den gamla staden",
        "fi": "Joki virtaa vuorelta ja kulkee tasangon halki mutta se ei ole kaukana kaupungista joka on vanha",
        "id": "Sungai itu mengalir dari gunung dan melewati dataran yang tidak jauh dari kota tua ini",
        "pl": "Rzeka spływa z gór i płynie przez równinę, która leży niedaleko starego miasta, gdzie mieszkają ludzie",
        "ru": "Река течёт с горы и проходит через долину, которая лежит недалеко от старого города",
        "el": "Το ποτάμι κατεβαίνει από το βουνό και περνά μέσα από την πεδιάδα κοντά στην παλιά πόλη",
        "tr": "Nehir dağdan aşağı akar ve eski şehrin yakınındaki ovanın içinden geçerek denize ulaşır",
    }
    lines["junk"] = " ".join(f"xq{chr(97 + i % 26)}z brum{chr(97 + i % 19)}" for i in range(40))
    names = sorted(lines)
    docs = frame(spark, [(i, ". ".join(f"{lines[k]} {w}{n}" for n, w in enumerate("abcdefg"))) for i, k in enumerate(names)])
    held = docs.select("doc_id", rules.verdict(rules.statistics(docs["text"])).alias("held")).collect()
    assert {names[r.doc_id] for r in held if not r.held} == {"junk"}


def test_filter_keeps_rows_whole(edges, empty):
    kept = rules.keep_good(edges)
    assert kept.schema == edges.schema
    assert kept.count() == rules.judged(edges).where("kept").count()
    assert rules.keep_good(empty).count() == 0 and rules.judged(empty).count() == 0


def test_one_projection_without_python(spark, sf_dir):
    plan = rules.judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
