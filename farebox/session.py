"""Session set-up and the shared folder every stored table lives in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench. On a cluster, spark-submit sets these and names the shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("farebox")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    if "spark.checkpoint.dir" not in conf:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="farebox-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder all executors can reach, private to this application.

    The session names it in ``spark.checkpoint.dir``. A local session that does not gets a fresh
    temporary folder, since there is one machine; a cluster session is refused.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = tempfile.mkdtemp(prefix="farebox-")
            _local_roots[context.applicationId] = root
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return "/".join([root.rstrip("/"), "farebox", context.applicationId, *parts])


def compilable(spark: SparkSession) -> None:
    """Let no stage run in one generated method that is too long for the JVM to compile.

    The JVM interprets methods of more than 8,000 bytes for as long as they run, while Spark fuses a stage into one
    of up to 65,535. Beyond this limit a stage's operators run one by one, in short methods that are compiled. A limit
    that the session was given stays.
    """
    if spark.conf.get(_METHOD_LIMIT) == "65535":
        spark.conf.set(_METHOD_LIMIT, "8000")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder: a fixed order, and no lineage to run again."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: no lineage, and a size that the optimizer can go by."""
    path = shared_dir(df.sparkSession, "tables", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
