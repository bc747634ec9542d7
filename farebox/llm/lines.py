"""Line dedup by a segment-partition edit join over the distinct lines of all documents.

Lines within ``EDITS`` edits share at least one of EDITS + 1 segments, shifted by no more than the edits
allow. Segments and shifted substrings of each distinct line become keys of 64 bits; lines that meet in
a key and agree in length and letter counts are compared. Keys travel without texts; texts are fetched
for the lines whose key another line has, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import keyed, let, rewritten, sized, stored

#: Lines of fewer code points, without white space around them, are left alone: empty ones.
LEAST_CHARS = 1
#: Lines of fewer are compared whole only: in them two edits mostly make another word.
LEAST_NEAR = 12
EDITS = 2
#: Segments grow in steps of so many characters, so that lines of nearly equal length cut alike; shorter
#: ones grow by single characters.
STEP = 8
# Letters that are counted, eight in a number.
LETTERS = ("abcdefgh", "ijklmnop", "rstuvwyz")


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\f\r"))


def _lines(text: Column) -> Column:
    """(place, line) of the lines to compare, trimmed."""
    all_lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("place"), _trimmed(x).alias("line")))
    return F.filter(all_lines, lambda x: F.length(x["line"]) >= LEAST_CHARS)


def _counts(line: Column) -> list[Column]:
    """Length and letter counts, each modulo 128 in seven bits."""

    def packed(first: Column, letters: str) -> Column:
        out = first
        for letter in letters:
            held = F.length(line) - F.length(F.replace(line, F.lit(letter), F.lit("")))
            out = F.shiftleft(out, 7).bitwiseOR(held.cast("long").bitwiseAND(127))
        return out

    size = F.length(line).cast("long").bitwiseAND(127)
    return [packed(F.lit(0).cast("long"), x).alias(f"c{i}") for i, x in enumerate(LETTERS)] + [size.alias("size")]


def _alike(edits: int) -> Column:
    """Whether lengths and letter counts leave room for ``edits`` edits, the second line being no shorter.

    An edit changes the length by one at most, and the counts of two letters by one each. Differences
    are taken modulo 128, which can only make them smaller.
    """

    def apart(column: str, at: int) -> Column:
        left = F.shiftright(f"x.{column}", at) - F.shiftright(f"y.{column}", at)
        return F.abs((left + 64).bitwiseAND(127) - 64)

    total = F.lit(0).cast("long")
    for i, letters in enumerate(LETTERS):
        for j in range(len(letters)):
            total = total + apart(f"c{i}", 7 * j)
    longer = (F.col("y.size") - F.col("x.size")).bitwiseAND(127) <= edits
    return longer & (total <= 2 * edits)


def _keys(line: Column, n: Column, edits: int) -> Column:
    """Array of (key, own): a line's segments (own) and the places near them where those of others may lie.

    A line is cut at multiples of a size that follows its length in steps (``_size``): edits + 1 segments that do
    not overlap, the nearer ones counted from the front, the others from the end. Of two lines within
    ``edits`` edits, segment i of one lies in the other with a shift of less than i, and of less than its
    rank from the end. A line a few characters short of the next size looks there, too.
    """

    def cut(size: Column, n: Column) -> list[Column]:
        out = []
        for i in range(edits + 1):
            front, slack = i <= edits - i, min(i, edits - i)
            start = size * i + 1 if front else n - size * (edits + 1 - i) + 1
            for shift in range(-slack, slack + 1):
                key = F.xxhash64(size, F.lit(i), line.substr(start + shift, size))
                out.append(F.struct(key.alias("key"), F.lit(shift == 0).alias("own")))
        return out

    none = F.array().cast("array<struct<key:bigint,own:boolean>>")

    def of(g: Column) -> Column:
        near = F.when(g["above"] > g["size"], F.array(*cut(g["above"], g["n"]))).otherwise(none)
        return F.concat(F.array(*cut(g["size"], g["n"])), near)

    return let(F.struct(n.alias("n"), _size(n, edits).alias("size"), _size(n + edits, edits).alias("above")), of)


def _size(n: Column, edits: int) -> Column:
    """Length of the segments of a line of ``n`` characters; within ``edits`` more it grows once at most."""
    width = STEP * (edits + 1)
    return F.when(n < width, F.floor(n / (edits + 1))).otherwise(F.floor(n / width) * STEP).cast("int")


def within(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether two strings are within ``edits`` edits, by a band of 2 * edits + 1 diagonals in bits.

    Word e of the state has a bit for each diagonal that e edits reach. A character of ``a`` moves all
    diagonals at once: along matches, and from fewer edits by a change, a loss or a gain.
    """
    band = (1 << (2 * edits + 1)) - 1
    words = [f"r{e}" for e in range(edits + 1)]

    def characters(x: Column) -> Column:
        return F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))

    def run(pair: Column) -> Column:
        p, q = pair["p"], pair["q"]

        def step(state: Column, i: Column) -> Column:
            match = F.lit(0)
            for d in range(-edits, edits + 1):
                same = F.when((i + d >= 0) & (F.get(p, i) == F.get(q, i + d)), 1 << (d + edits)).otherwise(0)
                match = match + same

            def moved(m: Column) -> Column:
                new = [state["r0"].bitwiseAND(m)]
                for e in range(1, edits + 1):
                    fewer = state[f"r{e - 1}"]
                    along = state[f"r{e}"].bitwiseAND(m)
                    lost = F.shiftright(fewer, 1)
                    gained = F.shiftleft(new[e - 1], 1)
                    new.append(along.bitwiseOR(fewer).bitwiseOR(lost).bitwiseOR(gained).bitwiseAND(band))
                return F.struct(*[x.alias(w) for x, w in zip(new, words)])

            return let(match, moved)

        begin = F.struct(*[F.lit(((1 << (e + 1)) - 1) << edits).alias(w) for e, w in enumerate(words)])
        places = F.when(F.size(p) > 0, F.sequence(F.lit(0), F.size(p) - 1)).otherwise(F.array().cast("array<int>"))
        last = F.aggregate(places, begin, step)[words[-1]]
        return F.call_function("shiftright", last, F.size(q) - F.size(p) + edits).bitwiseAND(1) == 1

    close = F.abs(F.length(a) - F.length(b)) <= edits
    return F.when(close, let(F.struct(characters(a).alias("p"), characters(b).alias("q")), run)).otherwise(F.lit(False))


def repeated(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """(id, h, place, exact): the lines that repeat an earlier line, and whether letter by letter.

    Earlier is by doc_id (null first), then by the text's hash, then by place. The first of equal lines
    goes as well if another line within ``edits`` edits came before it. Rows that repeat id and text are
    one text here and fare alike.
    """
    rows = keyed(docs).select("id", "h", "t")
    line, n = F.col("x.line"), F.length("x.line")
    seen = rows.select("id", "h", F.explode(_lines(F.col("t"))).alias("x"))
    where = F.struct("id", "h", "place")
    met = stored(
        seen.select(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"), "id", "h", "x.place", (n >= LEAST_NEAR).alias("long"))
    )
    # Equal lines: a minimum each, summed before the shuffle.
    distinct = stored(met.groupBy("a", "b").agg(F.min(where).alias("first"), F.count("*").alias("n"), F.first("long").alias("long")))
    later = (
        met.join(distinct.where("n > 1").select("a", "b", "first"), ["a", "b"])
        .where(~where.eqNullSafe(F.col("first")))
        .select("id", "h", "place", F.lit(True).alias("exact"))
    )
    # Keys of each distinct line, from the text at its first place; most lines share none.
    listed = distinct.where("long").select("first.*")
    long_lines = _read(rows, listed.groupBy("id", "h").agg(F.collect_set("place").alias("places")))
    held = stored(
        long_lines.select(F.xxhash64("line").alias("a"), _keys(F.col("line"), F.length("line"), edits).alias("keys"))
        .select("a", F.explode("keys").alias("k"))
        .select("k.key", "a", "k.own")
    )
    shared = held.groupBy("key").agg(F.min("a").alias("least"), F.max("a").alias("most")).where("least <> most")
    live = stored(held.join(sized(stored(shared.select("key"))), "key", "left_semi"))
    # The texts of the lines that do, and the pairs their letters allow.
    named = stored(distinct.where("long").join(live.select("a").distinct(), "a").select("first.*"))
    texts = stored(
        _read(rows, sized(stored(named.groupBy("id", "h").agg(F.collect_set("place").alias("places")))))
        .select(F.struct("id", "h", "place").alias("first"), F.xxhash64("line").alias("a"), "line", *_counts(F.col("line")))
        .distinct()
    )
    known = stored(live.join(texts.drop("line", "first").distinct(), "a"))
    met_in = F.expr("x.key = y.key") & (F.col("x.a") != F.col("y.a")) & (F.col("x.own") | F.col("y.own"))
    pairs = stored(
        known.alias("x").join(known.alias("y"), met_in & _alike(edits)).select("x.a", F.col("y.a").alias("a2")).distinct()
    )
    texts = texts.select("a", "line", "first")
    other = texts.select(F.col("a").alias("a2"), F.col("line").alias("line2"), F.col("first").alias("first2"))
    close = pairs.join(texts, "a").join(other, "a2").where(within(F.col("line"), F.col("line2"), edits))
    near = close.select(F.greatest("first", "first2").alias("x")).select("x.*", F.lit(False).alias("exact")).distinct()
    return later.unionByName(near)


def _read(rows: DataFrame, places: DataFrame) -> DataFrame:
    """(id, h, place, line) at the listed places of the texts."""

    def at(s: Column) -> Column:
        return F.transform(s["places"], lambda i: F.struct(i.alias("place"), _trimmed(s["parts"][i]).alias("line")))

    joined = rows.alias("r").join(places.alias("p"), F.expr("r.id <=> p.id and r.h = p.h"))
    parts = F.struct(F.split("t", "\n").alias("parts"), F.col("places").alias("places"))
    return joined.select("r.id", "r.h", F.explode(let(parts, at)).alias("x")).select("id", "h", "x.place", "x.line")


def marked(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Rows of ``docs`` as (row, t, places, exact): the places of lines to remove, null where there are none."""
    rows = keyed(docs)
    places = repeated(docs, edits).groupBy("id", "h").agg(
        F.collect_set("place").alias("places"),
        F.collect_set(F.when(F.col("exact"), F.col("place"))).alias("exact"),
    )
    gone = places.alias("g")
    return rows.alias("r").join(gone, F.expr("r.id <=> g.id and r.h = g.h"), "left").select("row", "t", "places", "exact")


def _rest(text: Column, places: Column) -> Column:
    """The text without the lines at ``places``."""

    def left(s: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(s["parts"]) - 1), s["places"])
        return F.array_join(F.transform(kept, lambda i: s["parts"][i]), "\n")

    return F.when(places.isNull(), text).otherwise(let(F.struct(F.split(text, "\n").alias("parts"), places.alias("places")), left))


def without_repeats(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` without lines that repeat an earlier one; every row and column stays.

    A text all of whose lines go is empty afterwards; null stays null; n_chars follows the text.
    """
    rows = marked(docs, edits)
    return rewritten(docs, rows, F.when(F.col("places").isNull(), F.col("row.text")).otherwise(_rest(F.col("t"), F.col("places"))))


def report(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """One row per row of ``docs``: lines, lines removed as equal and as near, and a checksum of the rest."""
    count = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    return marked(docs, edits).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size(F.split("t", "\n")).cast("long").alias("n_lines"),
        count("exact").alias("n_exact"),
        (count("places") - count("exact")).alias("n_near"),
        F.sha2(_rest(F.col("t"), F.col("places")), 256).alias("kept_sha256"),
    )
