"""Expressions and keys the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import shared_dir

WORD_GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words between runs of space and the controls 9 to 13."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def whole_text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def text_hash(docs: DataFrame) -> Column:
    """With doc_id, the key of a row: rows that share both get the same result anyway."""
    return F.xxhash64(whole_text(docs))


def keyed(docs: DataFrame) -> DataFrame:
    """The row as a struct, so that no column of it can clash, its key, and its whole text."""
    return docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs["doc_id"].alias("id"),
        text_hash(docs).alias("h"),
        whole_text(docs).alias("t"),
    )


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["h"] == b["h"])


def rewritten(docs: DataFrame, rows: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` out of ``rows.row``, with the new text and its length."""
    fresh = {"text": text}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[fresh.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def sized(df: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within the bound, else as it is.

    Call it on stored rows: it reads them once to add up row counts, string lengths and array sizes.
    """
    strings = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    arrays = [F.greatest(F.size(c), F.lit(0)) * 32 for c, kind in df.dtypes if kind.startswith("array")]
    row = sum(strings + arrays, F.lit(16 * len(df.columns) + 16))
    held = df.agg(F.sum(row.cast("long"))).first()[0] or 0
    return F.broadcast(df) if held <= most_bytes else df


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: computed once, compressed, without lineage."""
    path = shared_dir(df.sparkSession, "llm", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
