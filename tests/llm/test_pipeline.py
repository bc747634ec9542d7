import pytest
from llm_cases import edge_rows, frame, prose

import corpus_pipeline
from farebox.llm.common import stored


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    rows = edge_rows() + [(100 + i, prose(300 + i, 200)) for i in range(10)]
    rows += [(200, prose(300, 200)), (201, prose(301, 200).replace("the", "teh", 1)), (202, " ".join(prose(600, 60).split()))]
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    item = " ".join(prose(600, 60).split()[5:30])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_in_order_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, small))
        assert docs.columns == columns
        seen[name] = [r.doc_id for r in docs.select("doc_id").collect()]
    assert list(seen) == ["quality_rules", "line_dedup", "near_copies", "decontamination"]
    assert not {1, 2, 3, 4, 5, 10, 11, 13, 15} & set(seen["quality_rules"])
    assert sorted(map(str, seen["line_dedup"])) == sorted(map(str, seen["quality_rules"]))
    assert 202 in seen["near_copies"] and 202 not in seen["decontamination"]
    assert {100 + i for i in range(10)} <= set(seen["decontamination"])


def test_run_gives_pieces(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, 0)
        by_doc[r.doc_id] += r.length
    assert all(by_doc[r.doc_id] == r.doc_tokens for r in rows if r.doc_id is not None and r.doc_id >= 100)
    assert 202 not in by_doc and 105 in by_doc


def test_empty_tables(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
