"""Benchmark decontamination: a hash set of normalised test n-grams probed by every window of the text.

Windows are hashes of their words' hashes, so that no window's text is built before it is found. The set
is broadcast while its measured size is under a bound; beyond that both sides are shuffled. What it finds
is compared word by word, so a hit is verified.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import ascii_lower, keyed, let, rewritten, same_row, sized, stored, whole_text
from farebox.session import checkpointed

WINDOW = 13
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), GAP), "")


def _windows(w: Column, lengths: list[int], made: Callable[[Column], Column]) -> Column:
    """Array of (start, size, what ``made`` makes of the words) for every window of these lengths."""

    def of(size: int) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
        found = F.transform(
            places,
            lambda i: F.struct(i.alias("start"), F.lit(size).alias("size"), made(F.slice(w, i + 1, F.lit(size))).alias("gram")),
        )
        return F.when(F.size(w) >= size, found).otherwise(F.slice(found, 1, 0))

    return F.concat(*[of(n) for n in lengths])


def _text(words: Column) -> Column:
    return F.concat_ws(" ", words)


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def grams(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, size, gram, mark), each once: an item's windows, or its whole text where it has fewer words;
    ``mark`` is the window's hash."""
    items = benchmark.select(benchmark["item_id"], normal_words(whole_text(benchmark)).alias("w"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.size("w").alias("size"), _text(F.col("w")).alias("gram")))
    found = F.when(F.size("w") < window, whole).otherwise(_windows(F.col("w"), [window], _text))
    return (
        items.where(F.size("w") > 0)
        .select("item_id", F.explode(found).alias("g"))
        .select("item_id", "g.size", "g.gram", F.xxhash64(_hashes(F.split("g.gram", " "))).alias("mark"))
        .distinct()
    )


def _found(rows: DataFrame, index: DataFrame, lengths: list[int]) -> DataFrame:
    """(id, h, start, size, gram) of every window of the texts that is in the index."""
    marks = let(_hashes(normal_words(F.col("t"))), lambda w: _windows(w, lengths, F.xxhash64))
    probes = rows.select("id", "h", F.explode(marks).alias("p")).select("id", "h", "p.start", "p.size", F.col("p.gram").alias("mark"))
    likely = probes.join(sized(checkpointed(index.select("size", "mark").distinct())), ["size", "mark"], "left_semi")
    # Only texts with such a window are read again.
    spots = sized(stored(likely.groupBy("id", "h").agg(F.collect_set(F.struct("start", "size")).alias("spots"))))
    again = rows.alias("r").join(spots.alias("s"), F.expr("r.id <=> s.id and r.h = s.h"))
    read = let(
        F.struct(normal_words(F.col("t")).alias("w"), F.col("spots").alias("spots")),
        lambda x: F.transform(
            x["spots"],
            lambda y: F.struct(y["start"].alias("start"), y["size"].alias("size"), _text(F.slice(x["w"], y["start"] + 1, y["size"])).alias("gram")),
        ),
    )
    named = again.select("r.id", "r.h", F.explode(read).alias("p")).select("id", "h", "p.start", "p.size", "p.gram")
    return named.join(sized(checkpointed(index.select("size", "gram").distinct())), ["size", "gram"], "left_semi").distinct()


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document key with a hit: the hit words' places (ascending, each once), and the items found.

    Only the numbers 1 to ``window`` can be lengths of windows; those in use come to the driver.
    """
    index = checkpointed(grams(benchmark, window))
    lengths = sorted(r["size"] for r in index.select("size").distinct().collect())
    if not lengths:
        lengths = [window]
    rows = keyed(docs).select("id", "h", "t").where(F.col("t") != "")
    found = checkpointed(_found(rows, index, lengths))
    # A document's places are no more than its own words; its items no more than its windows' items.
    places = found.groupBy("id", "h").agg(
        F.array_sort(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.collect_set(F.struct("start", "size")),
                        lambda x: F.sequence(x["start"], x["start"] + x["size"] - 1),
                    )
                )
            )
        ).alias("places")
    )
    items = (
        found.select("id", "h", "size", "gram")
        .distinct()
        .join(index.select("item_id", "size", "gram"), ["size", "gram"])
        .groupBy("id", "h")
        .agg(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("items"))
    )
    return places.alias("a").join(items.alias("b"), F.expr("a.id <=> b.id and a.h = b.h")).select(
        "a.id", "a.h", "places", "items"
    )


def _n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[0-9A-Za-z\x80-\x{10FFFF}]+")).cast("long")


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, per: int = 20) -> DataFrame:
    """One row per row of ``docs``: words, hit words, items found, and whether one word in ``per`` is hit.

    Null and empty texts have no words and are clean. Repeated rows get equal results; a null item_id
    counts as the empty string; an empty benchmark leaves every document clean.
    """
    rows = keyed(docs).select(
        "id", "h", _n_words(F.col("t")).alias("n_words")
    )
    found = hits(docs, benchmark, window)
    n_hit = F.coalesce(F.size("places"), F.lit(0)).cast("long")
    return rows.join(found, same_row(rows, found), "left").select(
        rows["id"].alias("doc_id"),
        "n_words",
        F.greatest(n_hit, F.lit(0)).alias("n_hit"),
        F.greatest(F.coalesce(F.size("items"), F.lit(0)), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join(F.array_sort("items"), ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (per * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, per: int = 20, spans: bool = False) -> DataFrame:
    """Drops contaminated documents, or (``spans``) cuts the hit words out of every document with a hit.

    A cut word goes with the gap behind it. All columns come back as they were, but for text and n_chars.
    """
    rows = keyed(docs)
    found = sized(stored(hits(docs, benchmark, window)))
    joined = rows.join(found, same_row(rows, found), "left").select("row", "t", "places")
    if not spans:
        kept = joined.where(F.col("places").isNull() | (per * F.size("places") < _n_words(F.col("t"))))
        return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    # Each part is a word with the gap behind it; a gap that starts the text is a part of its own.
    parts = F.split(F.col("t"), r"(?<=[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])(?=[0-9A-Za-z\x80-\x{10FFFF}])")
    led = F.when(F.col("t").rlike(r"^[0-9A-Za-z\x80-\x{10FFFF}]"), F.lit(0)).otherwise(F.lit(1))
    cut = let(
        F.struct(parts.alias("parts"), led.alias("led"), F.col("places").alias("places")),
        lambda x: F.array_join(
            F.transform(
                F.array_except(
                    F.sequence(F.lit(0), F.size(x["parts"]) - 1),
                    F.transform(x["places"], lambda i: i + x["led"]),
                ),
                lambda i: x["parts"][i],
            ),
            "",
        ),
    )
    return rewritten(docs, joined, F.when(F.col("places").isNull(), F.col("row.text")).otherwise(cut))
