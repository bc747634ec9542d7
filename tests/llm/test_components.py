import random

from pyspark.sql import functions as F

from farebox.llm import components as module
from farebox.llm.components import components


def roots(edges):
    least = {x: x for e in edges for x in e}
    while True:
        new = dict(least)
        for a, b in edges:
            new[a] = new[b] = min(new[a], new[b])
        if new == least:
            return least
        least = new


def edge_list():
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(0, 40)]
    hub = [(1000, 1001 + i) for i in range(60)]
    loose = [(2000 + rng.randrange(80), 2000 + rng.randrange(80)) for _ in range(60)]
    return [*chain, *hub, *[e for e in loose if e[0] != e[1]], (2000, 2001), (2000, 2001), (2001, 2000)]


def test_least_node_of_each(spark):
    edges = edge_list()
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == roots(edges) and len(got) == len(roots(edges))


def test_few_edges_make_few_files(spark, monkeypatch):
    """A round over a few edges does not make a file for every shuffle partition."""
    files = []

    def counted(df, keep=module.stored):
        out = keep(df)
        files.append(out.select(F.input_file_name()).distinct().count())
        return out

    monkeypatch.setattr(module, "stored", counted)
    width, joined = spark.conf.get("spark.sql.shuffle.partitions"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set(joined, "false")
    try:
        edges = edge_list()
        got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
        spark.conf.unset(joined)
    assert {r.node: r.root for r in got} == roots(edges)
    assert max(files[1:]) <= spark.sparkContext.defaultParallelism
