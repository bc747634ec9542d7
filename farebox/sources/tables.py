"""File scans with declared schemas: no inference pass, and Catalyst prunes what is not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.schemas import TRIP_FILE, WIRE
from farebox.session import checkpointed, written
from farebox.sources.topic import top_keys


def scan_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Every Parquet trip file in a folder."""
    return spark.read.schema(TRIP_FILE).option("pathGlobFilter", "*.parquet").parquet(folder)


def scan_json_arrays(spark: SparkSession, folder: str, schema: str = WIRE) -> DataFrame:
    """JSON files that each hold one array of records, typed.

    A file that does not decode gives no rows here; ``json_records`` reports it.
    """
    files = written(_layouts(_array_lines(spark, folder)).drop("plain"))
    cut = _named(files, "over_lines")
    rows = _array_lines(spark, folder, without=_named(files, "over_lines OR NOT closed"))
    found = rows.filter("bare <> ''").select(F.explode(_held(f"STRUCT<{schema}>")).alias("r"))
    if cut:
        over = _records_over_lines(_array_lines(spark, folder, only=cut))
        found = found.unionByName(over.filter("record IS NOT NULL").select(F.from_json("record", schema).alias("r")))
    return found.select("r.*")


def json_records(spark: SparkSession, folder: str, layout: str = "array") -> DataFrame:
    """The raw text of every record with the file it came from.

    ``record`` keeps the JSON as written, so a missing key can be told from a null one. A line that
    does not decode gives a row with a null ``record``. Layout ``array`` is one array a file, however it
    is broken into lines; a file whose array never closes has one more row with a null ``record``. Files
    with whole records on each line are read line by line, and where a line is one record, its text is taken
    as it stands; in the others records are cut out by their brackets, and if one of those does not decode,
    the file has rows with a null ``record`` only. All read a file in as many tasks as it has splits.
    """
    if layout == "lines":
        lines = spark.read.option("recursiveFileLookup", True).text(folder)
        return lines.select(
            F.col("_metadata.file_path").alias("file"),
            F.when(top_keys(F.col("value")).isNotNull(), F.col("value")).alias("record"),
        )
    files = written(_layouts(_array_lines(spark, folder)))
    cut, mixed = _named(files, "over_lines"), _named(files, "NOT over_lines AND NOT plain")
    rows = _array_lines(spark, folder, without=cut + mixed)
    found = rows.filter("bare <> ''").select("file", F.col("bare").alias("record"))
    if mixed:
        rows = _array_lines(spark, folder, only=mixed).filter("bare <> ''")
        found = found.unionByName(rows.select("file", F.explode_outer(_held("STRING")).alias("record")))
    if cut:
        found = found.unionByName(_records_over_lines(_array_lines(spark, folder, only=cut)))
    return found.unionByName(files.filter("NOT closed").select("file", F.lit(None).cast("string").alias("record")))


def _array_lines(
    spark: SparkSession, folder: str, only: list[str] | None = None, without: list[str] | None = None
) -> DataFrame:
    """Lines with their place: file, start of the split, number inside it; ``bare`` is without the array's own
    brackets and the comma at the end. Files that ``only`` does not name, or ``without`` does, are not opened."""
    lines = spark.read.option("recursiveFileLookup", True).text(folder)
    file = F.col("_metadata.file_path")
    if only:
        lines = lines.filter(file.isin(only))
    if without:
        lines = lines.filter(~file.isin(without))
    return lines.select(
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        F.btrim("value").alias("text"),
    ).withColumn("bare", _bare(F.col("text")))


def _bare(text: Column) -> Column:
    """The text without ``[`` in front and ``,`` or ``]`` at the end.

    Most lines are cut by bytes; the pattern, which costs more than decoding the line does, is for other ends.
    """
    front = text.startswith("[").cast("int")
    end = (text.endswith(",") | text.endswith("]")).cast("int")
    inner = F.substring(text.cast("binary"), front + 1, F.octet_length(text) - front - end).cast("string")
    usual = text.endswith(",") | text.endswith("]") | text.endswith("}")
    return F.when(usual, inner).otherwise(F.regexp_replace(text, r"^\[|[,\]]$", ""))


def _listed() -> Column:
    """A line as an array of its own."""
    return F.concat(F.lit("["), "bare", F.lit("]"))


def _held(element: str) -> Column:
    """The whole records of a line, null if it does not hold whole records."""
    return F.from_json(_listed(), f"ARRAY<{element}>")


def _layouts(lines: DataFrame) -> DataFrame:
    """(file, closed, over_lines, plain): whether its array closes, whether records span lines, and whether
    every line is one object or empty.

    Records are counted without being decoded; only lines that this does not read need the lenient parser. A
    line without ``]`` is an array up to its last character, so that nothing stands behind its object. Strings
    between single quotes, which the counting lets pass, are not plain.
    """
    counted = lines.select(
        "file",
        F.col("text").endswith("]").alias("closes"),
        "bare",
        F.when(F.col("bare") != "", F.json_array_length(_listed())).otherwise(0).alias("n"),
    )
    torn = F.col("n").isNull() & _held("STRING").isNull()
    bare = F.col("bare")
    strict = ~bare.contains("'") | F.try_parse_json(bare).isNotNull()
    one = (F.col("n") == 1) & bare.startswith("{") & bare.endswith("}") & ~bare.contains("]") & strict
    plain = (bare == "") | F.coalesce(one, F.lit(False))
    return counted.groupBy("file").agg(
        F.max("closes").alias("closed"), F.max(torn).alias("over_lines"), F.min(plain).alias("plain")
    )


def _named(files: DataFrame, which: str) -> list[str]:
    """Names of the files that a condition holds for. The listing of the folder is on the driver already."""
    return [r.file for r in files.filter(which).select("file").collect()]


def _pieces(line: Column) -> Column:
    """The line cut behind every comma outside strings, as (piece, turn): brackets opened less closed.

    A JSON string holds no line break, so every line starts outside one. Escaped backslashes and quotes
    stand as control characters meanwhile, which JSON text does not hold.
    """
    plain = F.translate(line, "\x01\x02\x03", "\x04\x04\x04")
    plain = F.replace(F.replace(plain, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    marked = F.transform(
        F.split(plain, '"'), lambda x, i: F.when(i % 2 == 0, F.replace(x, F.lit(","), F.lit(",\x03"))).otherwise(x)
    )

    def piece(x: Column) -> Column:
        outside = F.array_join(F.filter(F.split(x, '"'), lambda _, i: i % 2 == 0), "")
        turn = F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))
        back = F.replace(F.replace(x, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
        return F.struct(back.alias("piece"), turn.alias("turn"))

    return F.transform(F.split(F.concat(F.array_join(marked, '"'), F.lit("\n")), "\x03"), piece)


def _chunks(pieces: DataFrame) -> DataFrame:
    """(file, start, base, first, sound) per split: the depth and the number of records before it, and whether
    the file's brackets close.

    A split counts its turns and, for every depth as seen from its own start, the commas met at it; where the
    split before it ended says which of those depths is the array's. So the prefix sums over a file run over a
    row per split.
    """
    along = Window.partitionBy("file", "start").orderBy("line", "place")
    deep = pieces.select("file", "start", "turn", "comma", F.sum("turn").over(along).alias("depth"))
    met = deep.groupBy("file", "start", "depth").agg(F.sum("turn").alias("turn"), F.count_if("comma").alias("commas"))
    splits = met.groupBy("file", "start").agg(
        F.sum("turn").alias("turn"), F.map_from_entries(F.collect_list(F.struct("depth", "commas"))).alias("commas")
    )
    by_start = Window.partitionBy("file").orderBy("start")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    based = splits.select(
        "file",
        "start",
        "commas",
        F.coalesce(F.sum("turn").over(before), F.lit(0)).alias("base"),
        (F.sum("turn").over(Window.partitionBy("file")) == 0).alias("sound"),
    )
    ends = F.coalesce(F.try_element_at("commas", F.lit(1) - F.col("base")), F.lit(0))
    return based.select("file", "start", "base", F.coalesce(F.sum(ends).over(before), F.lit(0)).alias("first"), "sound")


def _records_over_lines(rows: DataFrame) -> DataFrame:
    """(file, record) of arrays whose records span lines: cut at the commas that only the array encloses.

    A file whose brackets do not close has one row with a null record.
    """
    cut = F.posexplode(_pieces(F.col("value"))).alias("place", "x")
    pieces = rows.select("file", "start", "line", cut).select("file", "start", "line", "place", "x.*")
    marks = pieces.select("file", "start", "line", "place", "turn", F.col("piece").endswith(",").alias("comma"))
    chunks = written(_chunks(marks))
    along = Window.partitionBy("file", "start").orderBy("line", "place")
    deep = pieces.join(chunks.filter("sound"), ["file", "start"]).withColumn("depth", F.col("base") + F.sum("turn").over(along))
    ends = ((F.col("depth") == 1) & F.col("piece").endswith(",")).cast("int")
    numbered = deep.select(
        "file", "start", "line", "place", "piece", ends.alias("ends"), (F.col("first") + F.sum(ends).over(along) - ends).alias("n")
    )
    in_order = F.array_sort(F.collect_list(F.struct("start", "line", "place", "piece")))
    whole = numbered.groupBy("file", "n").agg(
        F.array_join(F.transform(in_order, lambda x: x["piece"]), "").alias("text"), F.max("ends").alias("ends")
    )
    opened = (F.col("n") > 0) | F.col("text").rlike(r"^\s*\[")
    shut = (F.col("ends") == 1) | F.col("text").rlike(r"\]\s*$")
    bare = F.when(F.col("n") == 0, F.regexp_replace("text", r"^\s*\[", "")).otherwise(F.col("text"))
    bare = F.when(F.col("ends") == 1, F.regexp_replace(bare, ",$", "")).otherwise(F.regexp_replace(bare, r"\]\s*$", ""))
    # Inside an object, a bracket too many does not decode.
    held = F.from_json(F.concat(F.lit('{"r":'), bare, F.lit("}")), "map<string,string>")["r"]
    records = checkpointed(whole.select("file", F.when(opened & shut, held).alias("record")))
    failed = written(records.filter("record IS NULL").select("file", F.lit(True).alias("failed")).distinct())
    kept = records.join(failed, "file", "left").filter("failed IS NULL OR record IS NULL").select("file", "record")
    torn = chunks.filter("NOT sound").select("file").distinct()
    return kept.unionByName(torn.select("file", F.lit(None).cast("string").alias("record")))
