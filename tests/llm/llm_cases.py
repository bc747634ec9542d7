"""Small document tables with every odd case in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, h string, t string, row int, places string, score string"


def frame(spark, rows):
    """Documents (doc_id, text) with the usual columns and some whose names the operators use inside."""
    full = [(i, t, "en", "s", None if t is None else len(t), 7, "h", "t", 1, "p", "x") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, words=120, vocabulary=400):
    rng = random.Random(seed)
    stock = ["".join(rng.choice(["ba", "the", "ing", "or", "té", "sk", "ul"]) for _ in range(rng.randint(1, 3))) for _ in range(vocabulary)]
    out = []
    for i in range(words):
        out.append(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else rng.choice(stock))
        out.append(".\n" if rng.random() < 0.06 else " ")
    return "".join(out).strip()


def edge_rows():
    """Nulls, empty and blank texts, short and very long ones, ties, repeated rows, shared passages."""
    passage = prose(99, 70)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b "),
        (4, "one"),
        (5, "two words"),
        (None, prose(5)),
        (None, None),
        (6, prose(6)),
        (6, prose(6)),
        (6, prose(7)),
        (7, prose(6)),
        (8, prose(8, 60) + "\n" + passage + "\n" + prose(9, 60)),
        (9, passage + " " + prose(10, 90)),
        (10, "x" * 5000),
        (11, "ab" * 3000 + "é" + "😀" * 40),
        (12, prose(12, 30000)),
        (13, "same line of more than twenty\n" * 40 + "\x01\x02 end"),
        (14, prose(6).replace("the", "thee", 1)),
        (15, "a\r\nb\x0cc\x00d\x7f"),
    ]
