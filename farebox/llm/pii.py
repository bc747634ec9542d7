"""Personal data: sure patterns as seeds, contexts learned from them, and identifiers found by context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm import spans as S
from farebox.llm.common import let, sized, whole_text
from farebox.session import checkpointed

# The patterns of the report. Lookbehinds and possessive runs only keep them linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: A token that could be an identifier: it has a digit or an @.
TOKEN = r"(?<![0-9A-Za-z._%+@/-])[A-Za-z._%+/-]*+[0-9@][0-9A-Za-z._%+@/-]*+"

_LETTER, _OTHER = r"[0-9a-z\x80-\x{10FFFF}]", r"[^0-9a-z\x80-\x{10FFFF}]"

#: What stands between a word and a match announces nothing if it is only white space or the end of a
#: clause, or closes a bracket or quote behind the match.
_PLAIN = {"left": r"^[\s.,;!?]*$", "right": r"^[\s.,;!?\")]*$"}

#: Words of a pattern, at most.
WORDS = 3
LEAST_SEEDS = 3
LEAST_SCORE = 0.6
#: How much an identifier that nothing vouches for yet speaks against its patterns.
DOUBT = 0.15


def _luhn(digits: Column) -> Column:
    """True where the checksum holds; every second digit from the right counts double, 9 taken off over 9."""
    flipped = F.split(F.reverse(digits), "")

    def value(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = F.when(n > 4, n * 2 - 9).otherwise(n * 2)
        return F.when(i % 2 == 1, twice).otherwise(n)

    return F.aggregate(F.transform(flipped, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]+", "")
    return (
        F.when(kind == "ip", match.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"))
        .when(kind == "card", F.length(digits).between(14, 19) & F.when(F.length(digits) <= 19, _luhn(digits)))
        .when(kind == "phone", F.length(digits).between(10, 15))
        .otherwise(F.lit(True))
    )


def _fit(match: Column) -> Column:
    """Whether a token has the shape of an identifier."""
    digits = F.regexp_replace(match, "[^0-9]+", "")
    return F.length(match).between(7, 64) & ((F.length(digits) >= 6) | match.contains("@"))


def _between(gap: Column) -> Column:
    """The class of what stands between a word and a match: one sign for each run of space, quotes or brackets."""
    classed = F.regexp_replace(F.translate(gap, "\u201c\u201d`'", '""""'), r"\s+", " ")
    classed = F.regexp_replace(F.regexp_replace(classed, '"+', '"'), r"[(\[{<]+", "(")
    return F.substring(F.regexp_replace(classed, r"[)\]}>]+", ")"), 1, 8)


def _contexts() -> Column:
    """Lexical patterns of a match: the one to three words that stand before it or follow it, with the class
    of what stands between.

    Only whole words count: one cut off where the text around a match ends is left out.
    """

    def side(name: str, text: Column, gap: str, at_end: bool) -> Column:
        words = F.filter(F.split(text, f"{_OTHER}+"), lambda w: w != "")
        parts = F.struct(
            words.alias("words"),
            (F.size(words) - (F.length(text) >= S.AROUND).cast("int")).alias("whole"),
            _between(F.regexp_extract(text, gap, 1)).alias("gap"),
        )

        def patterns(x: Column) -> Column:
            def pattern(k: Column) -> Column:
                first = F.size(x["words"]) - k + 1 if at_end else F.lit(1)
                run = F.array_join(F.slice(x["words"], first, k), " ")
                return F.struct(F.lit(name).alias("side"), run.alias("words"), x["gap"].alias("gap"))

            return F.transform(F.filter(F.sequence(F.lit(1), F.lit(WORDS)), lambda k: k <= x["whole"]), pattern)

        return let(parts, patterns)

    left = side("left", F.coalesce(F.lower("before"), F.lit("")), f"({_OTHER}*)$", True)
    return F.concat(left, side("right", F.coalesce(F.lower("after"), F.lit("")), f"^({_OTHER}*)", False))


def _instance() -> Column:
    return F.regexp_replace(F.lower("match"), r"[^0-9a-z@]+", "")


def _uses(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(words, uses): how often the words of ``patterns`` stand one behind the other anywhere in the corpus."""
    wanted = checkpointed(patterns.select("words").distinct())
    sizes = [r[0] for r in wanted.select(F.size(F.split("words", " ")).alias("k")).distinct().collect()]
    if not sizes:
        return wanted.select("words", F.lit(0).cast("long").alias("uses"))
    tokens = F.filter(F.split(F.lower(whole_text(docs)), f"{_OTHER}+"), lambda w: w != "")

    def runs(w: Column, k: int) -> Column:
        if k == 1:
            return w
        places = F.sequence(F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1)))
        found = F.transform(places, lambda i: F.array_join(F.slice(w, i, k), " "))
        return F.when(F.size(w) >= k, found).otherwise(F.slice(found, 1, 0))

    all_runs = docs.select(F.explode(let(tokens, lambda w: F.concat(*[runs(w, k) for k in sizes]))).alias("words"))
    return all_runs.join(sized(wanted), "words", "left_semi").groupBy("words").agg(F.count("*").alias("uses"))


def learned(
    docs: DataFrame,
    found: DataFrame,
    least_seeds: int = LEAST_SEEDS,
    least_score: float = LEAST_SCORE,
    doubt: float = DOUBT,
) -> DataFrame:
    """(instance, score) of all instances known in the end: the seeds (1) and those that a trusted pattern meets.

    ``found`` has the matches of ``personal``. A pattern meets slots, the tokens that stand beside it. Slots
    with a known instance speak for it; slots of another shape than an identifier's speak against it, and
    where nothing that announces stands between (``_PLAIN``), so do all other uses of its words; an instance not
    known yet counts ``doubt`` of one against. A pattern is trusted if ``least_seeds`` different known
    instances back it and for / (for + against + 1) is ``least_score`` or more, and makes the instances it meets
    known. Instances only become known, so the rounds end at the first that adds none, and that is the
    one fixpoint. Slots are counted before any join, so a pattern or an instance with any number of
    occurrences is a row per neighbour; patterns that too few instances share are gone before the rounds.
    """
    key = ["side", "words", "gap"]
    slots = found.select(
        (F.col("kind") != "context").alias("seed"),
        F.when((F.col("kind") != "context") | _fit(F.col("match")), _instance()).alias("instance"),
        F.explode(_contexts()).alias("p"),
    )
    edges = checkpointed(slots.groupBy(*[f"p.{c}" for c in key], "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("n")))
    useful = (
        edges.groupBy(*key)
        .agg(
            F.count("instance").alias("instances"),
            F.min("seed").alias("all_seeds"),
            F.sum("n").alias("met"),
            F.sum(F.when(F.col("instance").isNull(), F.col("n")).otherwise(0)).alias("misfits"),
        )
        .where((F.col("instances") > least_seeds) & ~F.col("all_seeds"))
    )
    useful = checkpointed(useful)
    plainly = F.when(F.col("side") == "left", F.col("gap").rlike(_PLAIN["left"])).otherwise(F.col("gap").rlike(_PLAIN["right"]))
    plain = useful.where(plainly)
    against = F.when(plainly, F.greatest(F.col("uses") - F.col("met"), F.lit(0))).otherwise(0) + F.col("misfits")
    patterns = checkpointed(
        useful.join(_uses(docs, plain), "words", "left").select(*key, F.coalesce(against, F.lit(0)).alias("against"))
    )
    met = checkpointed(edges.where("instance IS NOT NULL").join(patterns, key).select(*key, "against", "instance", "n"))
    seeds = found.where("kind <> 'context'").select(_instance().alias("instance")).distinct()
    known = checkpointed(seeds.withColumn("score", F.lit(1.0)))
    before = -1
    while (now := known.count()) != before:
        before = now
        # Written down, so that the join to a pattern with very many instances can be split.
        trusted = checkpointed(
            met.join(known, "instance", "left")
            .groupBy(*key)
            .agg(
                F.sum(F.when(F.col("score").isNotNull(), F.col("n")).otherwise(0)).alias("good"),
                F.sum(F.when(F.col("score").isNull(), F.col("n")).otherwise(0)).alias("open"),
                F.count("score").alias("backed"),
                F.first("against").alias("against"),
            )
            .where(F.col("backed") >= least_seeds)
            .select(*key, (F.col("good") / (F.col("good") + F.col("against") + F.col("open") * doubt + 1)).alias("trust"))
            .where(F.col("trust") >= least_score)
        )
        reached = met.join(trusted, key).groupBy("instance").agg(F.max("trust").alias("score"))
        known = checkpointed(known.unionByName(reached.join(known.select("instance"), "instance", "left_anti")))
    return known


def personal(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """(id, h, kind, start, end, match, before, after): sure spans, and ``context`` spans: tokens
    that spell the identifier of a sure span in another form, and those found by context.

    Null and empty texts have none; repeated rows are searched once; an empty table learns nothing.
    """
    valid = S.matches(docs, {**BASE, "context": TOKEN}).where(_valid(F.col("kind"), F.col("match")))
    found = checkpointed(S.clear_of(valid, F.col("kind") != "context"))
    known = learned(docs, found, least_score=least_score).select("instance")
    tokens = found.where("kind = 'context'").where(_fit(F.col("match"))).withColumn("instance", _instance())
    return found.where("kind <> 'context'").unionByName(tokens.join(known, "instance", "left_semi").drop("instance"))


def report(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """One row per row of ``docs`` with the counts, the checksum and the spans of ``personal``."""
    return S.report(docs, personal(docs, least_score), list(BASE), ["context"])
