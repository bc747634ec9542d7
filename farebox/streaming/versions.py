"""Tables made of segments, and the manifest that says which segments count.

A segment is a directory that is written once. A new version of a table is one small file that lists its
segments; it counts from the moment it is renamed into place, so a reader sees all of it or nothing. Segments
that a version no longer lists stay until later versions have been committed, so a reader that has begun
keeps its files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from farebox.storage import delete, listed, read_text, write_text

#: Versions during which what an earlier one listed is kept for its readers.
KEEP = 1


@dataclass(frozen=True)
class Version:
    number: int = -1
    #: The last batch that the segments cover.
    upto: int = -1
    #: Each has a ``path`` under the table, and whatever its table wants to know of it.
    segments: list[dict] = field(default_factory=list)
    #: (number of the version that dropped it, path) of segments that still lie there.
    dropped: list[list] = field(default_factory=list)


def _manifest(path: str, number: int) -> str:
    return f"{path}/_versions/{number:09d}.json"


def current(spark: SparkSession, path: str) -> Version:
    found = listed(spark, f"{path}/_versions/[0-9]*.json")
    if not found:
        return Version()
    text = read_text(spark, f"{path}/_versions/{found[-1]}")
    # A manifest is deleted only after newer ones are there.
    return Version(**json.loads(text)) if text else current(spark, path)


def segment(name: str) -> str:
    """A path for a new segment, which no other attempt at the same version takes."""
    return f"{name}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, path: str, was: Version, upto: int, segments: list[dict], keep: int = KEEP) -> Version:
    """Make ``segments`` the version after ``was``; raises if another writer made one meanwhile.

    What earlier versions dropped is deleted once ``keep`` versions have followed.
    """
    number = was.number + 1
    live = {s["path"] for s in segments}
    dropped = was.dropped + [[number, s["path"]] for s in was.segments if s["path"] not in live]
    gone = [p for n, p in dropped if n <= number - keep]
    now = Version(number, upto, segments, [[n, p] for n, p in dropped if n > number - keep])
    if not write_text(spark, _manifest(path, number), json.dumps(now.__dict__)):
        raise RuntimeError(f"{path} already has a version {number}")
    held = {p.rsplit("/", 1)[0] for p in [*live, *[p for _, p in now.dropped]]}
    for old in gone:
        delete(spark, f"{path}/{old}")
    for parent in {p.rsplit("/", 1)[0] for p in gone if "/" in p} - held:
        delete(spark, f"{path}/{parent}")
    for name in listed(spark, f"{path}/_versions/[0-9]*.json"):
        if int(name.removesuffix(".json")) <= number - max(keep, 1) - 1:
            delete(spark, f"{path}/_versions/{name}")
    return now


def read(spark: SparkSession, path: str, segments: list[dict], schema: StructType) -> DataFrame:
    """The rows of some segments."""
    if not segments:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{s['path']}" for s in segments])


def keep_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Note the columns of a table beside it, once, so that reads need not look into its files."""
    if read_text(spark, f"{path}/_columns.json") is None:
        write_text(spark, f"{path}/_columns.json", schema.json())


def schema_of(spark: SparkSession, path: str) -> StructType:
    text = read_text(spark, f"{path}/_columns.json")
    if text is None:
        raise FileNotFoundError(f"nothing has been written to {path}")
    return StructType.fromJson(json.loads(text))
