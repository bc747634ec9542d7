"""Places of pattern matches, with built-in functions only.

Matches are marked in the text, the text is split at the marks, and start places are running sums of
the parts' lengths. Only matches and a few characters around them leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import keyed

OPEN, SHUT = "\x01", "\x02"
AROUND = 64


def _parts(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, place, size, match, head, tail); part 0 is what lies before the first match."""
    marked = F.split(F.regexp_replace(text, pattern, f"{OPEN}$0{SHUT}"), OPEN)

    def part(seg: Column, place: Column) -> Column:
        match = F.when(place > 0, F.substring_index(seg, SHUT, 1)).otherwise("")
        size = F.length(seg) - F.when(place > 0, F.lit(1)).otherwise(0)
        rest = F.when(place > 0, F.substring_index(seg, SHUT, -1)).otherwise(seg)
        return F.struct(
            F.lit(kind).alias("kind"),
            place.alias("place"),
            size.cast("long").alias("size"),
            match.alias("match"),
            F.substring(rest, 1, AROUND).alias("head"),
            F.translate(F.right(seg, F.lit(AROUND)), SHUT, "").alias("tail"),
        )

    none = F.array().cast("array<struct<kind:string,place:int,size:bigint,match:string,head:string,tail:string>>")
    return F.when(text.rlike(pattern), F.transform(marked, part)).otherwise(none)


def matches(docs: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(id, h, kind, start, end, match, before, after): leftmost matches of each kind, not overlapping.

    Places count code points, ends are exclusive. Marks in the text itself are read as another control
    character, which no pattern may tell from them. Rows that repeat id and text count once. The result
    is partitioned by (id, h); a task holds the matches of one document at a time.
    """
    rows = keyed(docs).select("id", "h", F.translate("t", OPEN + SHUT, "\x03\x03").alias("t"))
    parts = rows.select(
        "id", "h", F.explode(F.concat(*[_parts(F.col("t"), k, p) for k, p in patterns.items()])).alias("p")
    ).select("id", "h", "p.*")
    parts = parts.repartition("id", "h").dropDuplicates(["id", "h", "kind", "place"])
    along = Window.partitionBy("id", "h", "kind").orderBy("place")
    placed = parts.select(
        "id",
        "h",
        "kind",
        "place",
        "match",
        F.coalesce(F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        F.lag("tail").over(along).alias("before"),
        F.col("head").alias("after"),
    )
    return placed.where("place > 0").select(
        "id",
        "h",
        "kind",
        "start",
        (F.col("start") + F.length("match")).alias("end"),
        "match",
        "before",
        "after",
    )


def clear_of(spans: DataFrame, strong: Column) -> DataFrame:
    """Drops a span that overlaps one with ``strong``; input partitioned by (id, h), no pairs.

    Two running values, one along the document and one against it: a frame that only grows costs a step a row.
    """
    of_text = Window.partitionBy("id", "h")
    so_far = of_text.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    from_end = of_text.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(strong, F.col("end"))).over(so_far)
    ahead = F.min(F.when(strong, F.col("start"))).over(from_end)
    marked = spans.withColumn("strong", strong).withColumn("reach", reach).withColumn("ahead", ahead)
    free = (F.coalesce(F.col("reach"), F.lit(0)) <= F.col("start")) & (
        F.col("ahead").isNull() | (F.col("ahead") >= F.col("end"))
    )
    return marked.where(F.col("strong") | free).drop("strong", "reach", "ahead")


def _joined(spans: Column) -> Column:
    texts = F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return F.array_join(texts, ",")


def report(docs: DataFrame, spans: DataFrame, base: list[str], more: list[str]) -> DataFrame:
    """One row per row of ``docs``: a count per base kind, a checksum of the base spans, and all spans.

    A document without spans, empty or null has zero counts and an empty string. A task gathers the
    spans of one document at a time.
    """
    order = F.array_position(F.array(*[F.lit(k) for k in [*base, *more]]), F.col("kind"))
    entry = F.struct("start", order.alias("rank"), F.col("kind"), "end")
    is_base = F.col("kind").isin(base)
    per_doc = spans.groupBy("id", "h").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in base],
        F.sha2(_joined(F.collect_list(F.when(is_base, entry))), 256).alias("base_sha256"),
        _joined(F.collect_list(entry)).alias("spans"),
    )
    rows = keyed(docs).select("id", "h")
    both = rows.alias("a").join(per_doc.alias("b"), F.expr("a.id <=> b.id and a.h = b.h"), "left")
    return both.select(
        F.col("a.id").alias("doc_id"),
        *[F.coalesce(F.col(f"n_{k}"), F.lit(0)).alias(f"n_{k}") for k in base],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
