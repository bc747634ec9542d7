import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import edge_rows, frame
from farebox.llm import packing
from tokenizers import Tokenizer


def plain():
    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*reader.encode(text or "", add_special_tokens=False).ids, 1]


def test_round_trip(edges):
    encode = plain()
    rows = packing.pack(edges).collect()
    texts = {}
    for r in rows:
        assert r.length <= 2048 and r.length & (r.length - 1) == 0 and r.offset == 0
        texts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids))
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc, text in edge_rows():
        ids = encode(text)
        held = sorted(texts[(doc, len(ids))])
        joined = {}
        for start, length, raw in held:
            joined.setdefault(start, set()).add(raw)
            assert length * 4 == len(raw)
        if [x[0] for x in edge_rows()].count(doc) == 1:
            assert np.frombuffer(b"".join(next(iter(joined[s])) for s in sorted(joined)), "<u4").tolist() == ids


def test_unusual_text_takes_the_other_reader(spark):
    texts = ["hi <|endoftext|> there", "<|endoftext|><|endoftext|>", "<|endoftext|", "<| endoftext |>", "ꟊ𞤀 ​ x", "a" * 3000, " " * 3000 + "b", "don't  stop\n\n\nnow", "naïve – “quoted” … €5"]
    encode = plain()
    got = {r.doc_id: r for r in packing.pack(frame(spark, list(enumerate(texts)))).where("start = 0").collect()}
    for i, text in enumerate(texts):
        ids = encode(text)
        assert got[i].doc_tokens == len(ids)
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids[: got[i].length]


def test_digest_and_empty(edges, empty):
    first = packing.digest(packing.pack(edges, stored=False)).where("doc_id = 5").collect()
    ids = np.array(plain()("two words"), "<u4")
    assert [(r.start, r.length, r.ids_crc32) for r in sorted(first)] == [
        (s, n, zlib.crc32(ids[s : s + n].tobytes())) for s, n in packing.binary_cut(len(ids), 2048)
    ]
    assert packing.pack(empty).count() == 0
    with pytest.raises(ValueError):
        packing.pack(edges, limit=1000)


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 10000])
def test_binary_cut(n):
    pieces = packing.binary_cut(n, 2048)
    assert sum(k for _, k in pieces) == n and [s for s, _ in pieces] == [sum(k for _, k in pieces[:i]) for i in range(len(pieces))]


def test_buckets_hold_equal_lengths(spark, edges, tmp_path):
    packing.write_buckets(packing.pack(edges), str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.where("octet_length(ids) <> length * 4").count() == 0


def test_sequences_of_one_length_have_a_range_of_ids(edges):
    rows = sorted((r.sequence_id, r.length) for r in packing.pack(edges).collect())
    assert [n for _, n in rows] == sorted(n for _, n in rows) and len({i for i, _ in rows}) == len(rows)


def test_an_added_token_is_its_own_id(spark):
    row = packing.pack(frame(spark, [(1, "hi <|endoftext|> there")])).orderBy("start").first()
    assert np.frombuffer(row.ids, "<u4").tolist() == [5303, 220, 50256, 612]
