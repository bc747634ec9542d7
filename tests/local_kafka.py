"""A stand-in for the Kafka connector in tests: a folder takes the place of the brokers.

It goes by the connector's options and columns, so the library's own Kafka code runs through it. A
topic is a folder of files, one per written task and topic partition; a small index gives each its first offset.
"""

import json
import os
import uuid
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

PARTITIONS = 3
COLUMNS = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"


def files_of(folder):
    """[(file, topic partition, first offset, messages)] of what has been committed, in order."""
    index = f"{folder}/index"
    return [json.loads(open(f"{index}/{n}").read()) for n in sorted(os.listdir(index))] if os.path.isdir(index) else []


def ends_of(folder):
    ends = {str(p): 0 for p in range(PARTITIONS)}
    for _, p, first, n in files_of(folder):
        ends[str(p)] = max(ends[str(p)], first + n)
    return ends


class Span(InputPartition):
    def __init__(self, file, partition, first, low, high):
        self.file, self.partition, self.first, self.low, self.high = file, partition, first, low, high


class Made(WriterCommitMessage):
    def __init__(self, files):
        self.files = files


class Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder = f"{options['kafka.bootstrap.servers']}/{options['subscribe']}"
        self.topic = options["subscribe"]
        self.starting = options.get("startingoffsets", options.get("startingOffsets", "latest"))
        self.most = options.get("maxoffsetspertrigger", options.get("maxOffsetsPerTrigger"))
        self.given = self.initialOffset()

    def initialOffset(self):
        return ends_of(self.folder) if self.starting == "latest" else {str(p): 0 for p in range(PARTITIONS)}

    def latestOffset(self):
        ends = ends_of(self.folder)
        if self.most:  # counted from the start of this run
            each = max(1, int(self.most) // PARTITIONS)
            ends = {p: min(end, self.given[p] + each) for p, end in ends.items()}
        self.given = ends
        return ends

    def partitions(self, start, end):
        spans = []
        for file, p, first, n in files_of(self.folder):
            low, high = max(first, start[str(p)]), min(first + n, end[str(p)])
            if low < high:
                spans.append(Span(file, p, first, low, high))
        return spans

    def read(self, span):
        table = pq.read_table(f"{self.folder}/{span.file}").slice(span.low - span.first, span.high - span.low)
        n = len(table)
        columns = [
            table["key"],
            table["value"],
            pa.array([self.topic] * n),
            pa.array([span.partition] * n, pa.int32()),
            pa.array(range(span.low, span.high), pa.int64()),
            table["timestamp"].cast(pa.timestamp("us", "UTC")),
            pa.array([0] * n, pa.int32()),
        ]
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        yield from pa.table(columns, names=names).to_batches()


class Writer(DataSourceArrowWriter):
    def __init__(self, options, names):
        self.folder, self.names = f"{options['kafka.bootstrap.servers']}/{options['topic']}", names

    def write(self, batches):
        batches = list(batches)
        table = pa.Table.from_batches(batches) if batches else None
        made = []
        if table is not None:
            os.makedirs(self.folder, exist_ok=True)
            keys = [zlib.crc32(k or b"") % PARTITIONS for k in table["key"].to_pylist()]
            stamps = pa.array([1_700_000_000_000_000] * len(table), pa.timestamp("us", "UTC"))
            stamps = table["timestamp"] if "timestamp" in table.column_names else stamps
            table = pa.table({"key": table["key"], "value": table["value"], "timestamp": stamps})
            for p in range(PARTITIONS):
                mine = table.filter(pa.array([k == p for k in keys], pa.bool_()))
                if len(mine):
                    made.append((f"{uuid.uuid4().hex}.parquet", p, len(mine)))
                    pq.write_table(mine, f"{self.folder}/{made[-1][0]}")
        return Made(made)

    def commit(self, messages):
        ends = ends_of(self.folder)
        os.makedirs(f"{self.folder}/index", exist_ok=True)
        at = len(files_of(self.folder))
        for file, p, n in [m for made in messages for m in made.files]:
            with open(f"{self.folder}/index/{at:06d}", "w") as out:
                out.write(json.dumps([file, p, ends[str(p)], n]))
            ends[str(p)], at = ends[str(p)] + n, at + 1


class LocalKafka(DataSource):
    @classmethod
    def name(cls):
        return "local_kafka"

    def schema(self):
        return COLUMNS

    def streamReader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options, schema.names)
