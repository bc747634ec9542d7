"""Secrets, and weak parts of credentials that count only where complementary parts stand together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm import spans as S

SCOPE = 200

# The patterns of the report.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]+", "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+"}

_VALUE = r"""["']?\x20{0,8}[:=]\x20{0,8}["']?([A-Za-z0-9+/_.@=-]{3,})"""
#: Parts of a credential: who asks, what proves it, and where it is used.
PARTS = {
    "account": r"(?i:\b(?:user(?:name|_id)?|login|account|client_?id|access_?key(?:_?id)?))" + _VALUE,
    "key": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+",
    "endpoint": r"\b(?:https?|s3|jdbc:[a-z]{1,16}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+",
}


def _valid(kind: Column, match: Column) -> Column:
    """The checks behind each pattern; a match that fails is dropped and not tried again."""
    return (
        F.when(kind == "assign", F.length(F.regexp_extract(match, "^" + ASSIGN, 2)) >= 6)
        .when(kind == "access", F.length(match) >= 20)
        .when(
            kind == "key",
            match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]") & ~match.rlike("/.*/.*/"),
        )
        .otherwise(F.lit(True))
    )


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Keeps sure secrets, and the weak parts that a complementary part joins within ``scope`` characters.

    An account or endpoint needs a key or a sure secret near it, a key needs an account or endpoint.
    Only the nearest part of each sort on either side matters, so the interval join is two running
    values, one along a document and one against it, and makes no pairs.
    """
    places, of_text = ["start", "end", "kind"], Window.partitionBy("id", "h")
    behind = of_text.orderBy(*places).rowsBetween(Window.unboundedPreceding, -1)
    ahead = of_text.orderBy(*[F.desc(c) for c in places]).rowsBetween(Window.unboundedPreceding, -1)
    proves = F.col("kind").isin("key", *BASE)
    context = F.col("kind").isin("account", "endpoint", "access")

    def near(part: Column) -> Column:
        last = F.max(F.when(part, F.col("end"))).over(behind)
        following = F.min(F.when(part, F.col("start"))).over(ahead)
        return (F.coalesce(F.col("start") - last, F.lit(scope + 1)) <= scope) | (
            F.coalesce(following - F.col("end"), F.lit(scope + 1)) <= scope
        )

    marked = found.withColumn("by_proof", near(proves)).withColumn("by_context", near(context))
    joined = (
        F.when(F.col("kind").isin(*BASE), F.lit(True))
        .when(F.col("kind") == "key", F.col("by_context"))
        .otherwise(F.col("by_proof"))
    )
    return marked.where(joined).drop("by_proof", "by_context")


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(id, h, kind, start, end, match, before, after) of every secret and every linked part.

    Null and empty texts have none; repeated rows are searched once; ties in place go by end and kind.
    """
    found = S.matches(docs, {**BASE, **PARTS}).where(_valid(F.col("kind"), F.col("match")))
    return linked(S.clear_of(found, F.col("kind").isin(*BASE)), scope)


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs`` with the counts, the checksum and the spans of ``secrets``."""
    return S.report(docs, secrets(docs, scope), list(BASE), list(PARTS))
