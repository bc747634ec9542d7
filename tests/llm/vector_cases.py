"""Small vector tables with every odd case in them."""

import random

SCHEMA = "vec_id long, embedding array<float>, x string, far int, w double, n string, component string"


def frame(spark, rows):
    """Vectors (vec_id, embedding) beside columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, "x", 1, 0.5, "n", "c") for i, v in rows], SCHEMA)


def vector(seed, dim=64, spread=0.2):
    rng = random.Random(seed)
    return [rng.gauss(0.1, spread) for _ in range(dim)]


def edge_rows(dim=64):
    """Nulls, missing and endless entries, other lengths, ties, repeated rows and ids, large entries."""
    rows = [(i, vector(i, dim)) for i in range(60)]
    rows += [(100, None), (101, []), (102, vector(1, dim)[:-1] + [None]), (103, vector(2, dim)[:-1] + [float("nan")])]
    rows += [(104, [float("inf")] + vector(3, dim)[1:]), (105, [float("-inf")] + vector(3, dim)[1:])]
    rows += [(106, vector(4, dim - 1)), (107, vector(5, dim + 1)), (108, [0.0] * dim), (109, [-0.0] * dim)]
    rows += [(7, vector(7, dim)), (7, vector(7, dim)), (8, vector(200, dim)), (None, vector(201, dim))]
    return [*rows, (110, [1e4 * x for x in vector(6, dim)])]
