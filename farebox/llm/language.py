"""Language of words and texts by a linear-chain conditional random field, for texts that switch languages."""

from __future__ import annotations

import heapq
import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm import crf
from farebox.llm.common import keyed, stored
from farebox.llm.quality import held_out

#: A run of letters and their marks; longer runs are cut, so scripts without spaces make words as well.
WORD = r"\p{L}[\p{L}\p{M}]{0,23}"
NONE = "und"
#: Windows of training texts the field is fitted on, all languages together, and words of a window.
SAMPLE = 2000
WINDOW = 40
#: Words of the lexicon, all languages together: the most frequent ones of each.
LEXICON = 65536
#: Words whose forward-backward tables a task holds at once, and characters of text read for them.
HELD = 1 << 18


def _words(text: str) -> list[str]:
    """Words in lower case, in order."""
    import regex

    found = regex.findall(WORD, text)
    return "\n".join(found).lower().split("\n") if found else []


def _counts_and_windows(most_words: int = 1 << 18):
    """Per task: words counted per language, and the windows of each language with the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]):
        import xxhash

        kinds = {"lang": pa.string(), "word": pa.string(), "n": pa.int64(), "text": pa.string()}
        counts: dict[str, Counter] = {}
        heaps: dict[str, list[tuple[int, str]]] = {}
        seen: dict[str, set[int]] = {}

        def rows(lang, words, numbers, texts):
            columns = [[lang] * len(numbers), words, numbers, texts]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _words(text)
                counted = counts.setdefault(lang, Counter())
                for start in range(0, len(words), 1 << 16):
                    counted.update(words[start : start + (1 << 16)])
                    if len(counted) >= most_words:
                        yield rows(lang, list(counted), list(counted.values()), [None] * len(counted))
                        counted.clear()
                heap, held = heaps.setdefault(lang, []), seen.setdefault(lang, set())
                for start in range(0, len(words), WINDOW):
                    window = " ".join(words[start : start + WINDOW])
                    at = xxhash.xxh64_intdigest(window) >> 1
                    if at in held or (len(heap) == SAMPLE and at >= -heap[0][0]):
                        continue
                    held.add(at)
                    heapq.heappush(heap, (-at, window))
                    if len(heap) > SAMPLE:
                        held.discard(-heapq.heappop(heap)[0])
        for lang, counted in counts.items():
            if counted:
                yield rows(lang, list(counted), list(counted.values()), [None] * len(counted))
        for lang, heap in heaps.items():
            if heap:
                yield rows(lang, [None] * len(heap), [-at for at, _ in heap], [window for _, window in heap])

    return run


def _most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """Per language its most frequent words: as many whole classes of equal counts as make ``most`` words at most."""
    classes = counted.groupBy("lang", "n").agg(F.count("*").alias("words"))
    so_far = F.sum("words").over(Window.partitionBy("lang").orderBy(F.desc("n")))
    fits = classes.withColumn("so_far", so_far).where(F.col("so_far") <= most).groupBy("lang").agg(F.min("n").alias("least"))
    # A row per language.
    least = [F.when(F.col("lang") == r["lang"], F.col("n") >= r["least"]) for r in fits.collect()]
    return counted.where(F.coalesce(*least, F.lit(False)))


def _lowest(windows: DataFrame, most: int) -> DataFrame:
    """The ``most`` windows of each language with the lowest hashes; of 64 parts first, so that no task sorts a language."""
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("at"))
    few = windows.withColumn("part", F.col("at") % 64).withColumn("r", rank("lang", "part")).where(F.col("r") <= most)
    return few.withColumn("r", rank("lang")).where(F.col("r") <= most).select("lang", "at", "text")


def _switched(windows: list[tuple[list[str], int]]) -> list[list[tuple[str, int]]]:
    """Training sequences: every window as it is, and once more cut into runs that are dealt anew, so that
    neighbouring runs differ in language as in code-switched text."""
    rng = random.Random(11)
    whole = [[(w, y) for w in words] for words, y in windows]
    runs = []
    for words, y in windows:
        at = 0
        while at < len(words):
            size = min(1 + int(rng.expovariate(1 / 12)), len(words) - at)
            runs.append([(w, y) for w in words[at : at + size]])
            at += size
    rng.shuffle(runs)
    mixed: list[list[tuple[str, int]]] = [[]]
    for run in runs:
        if len(mixed[-1]) >= WINDOW:
            mixed.append([])
        mixed[-1] += run
    return whole + mixed


def fitted(texts: DataFrame) -> crf.Field | None:
    """A field learned from (lang, text); None without a labelled word.

    Word counts cover all texts. The weights are fitted on ``SAMPLE`` different windows of ``WINDOW`` words,
    equally many a language, those with the smallest hashes; the lexicon holds at most ``LEXICON`` words, the
    most frequent of each language, with all or none of equal frequency. Both reach the driver.
    """
    rows = stored(
        texts.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(
            _counts_and_windows(), "lang string, word string, n long, text string"
        )
    )
    counted = stored(rows.where("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    labels = sorted(totals)
    if not labels:
        return None
    lexicon: dict[str, list[float]] = {}
    for r in _most_frequent(counted, max(1, LEXICON // len(labels))).orderBy("word", "lang").collect():
        lexicon.setdefault(r["word"], [0.0] * len(labels))[labels.index(r["lang"])] = float(r["n"])
    windows = rows.where("text IS NOT NULL").groupBy("lang", F.col("n").alias("at")).agg(F.min("text").alias("text"))
    sample = _lowest(windows, max(1, SAMPLE // len(labels))).collect()
    dealt = [(r["text"].split(" "), labels.index(r["lang"])) for r in sorted(sample, key=lambda r: (r["at"], r["lang"]))]
    return crf.fit(_switched(dealt), labels, lexicon, np.array([float(totals[lang]) for lang in labels]))


def _groups(texts: list[str]) -> Iterator[list[int]]:
    """Runs of texts of at most ``HELD`` characters together; a longer text is a run of its own."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if group and size + len(text) > HELD:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(text)
    if group:
        yield group


def _labelled(texts: list[str | None], scorer: crf.Scorer) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(index, words, probability of each language at each word) of the texts that have words."""
    plain = [t or "" for t in texts]
    for group in _groups(plain):
        words = [(i, w) for i in group if (w := _words(plain[i]))]
        if not words:
            continue
        lengths = np.array([len(w) for _, w in words])
        scores = scorer.scores([x for _, w in words for x in w])
        found = crf.marginals(scores, lengths, scorer.field.moves)
        for (i, w), part in zip(words, np.split(found, np.cumsum(lengths)[:-1])):
            yield i, w, part


def predicted(docs: DataFrame, field: crf.Field | None) -> DataFrame:
    """(id, lang_pred, score, shares) of every row: the language with the largest share of the text, that
    share, and the share of every language. A word counts by its letters and the probability of each
    language at it, so a text in two languages shows both. Without a letter: ``und`` and 0.
    """
    rows = keyed(docs).select("id", F.col("t").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"id {kind}, lang_pred string, score double, shares map<string,double>"

    def run(batches: Iterator[pa.RecordBatch]):
        scorer = crf.Scorer(field) if field else None
        for batch in batches:
            lang, score, shares = [NONE] * len(batch), [0.0] * len(batch), [[] for _ in range(len(batch))]
            for i, words, found in _labelled(batch.column(1).to_pylist(), scorer) if scorer else ():
                weight = np.array([len(w) for w in words], dtype=np.float64)
                share = weight @ found / weight.sum()
                best = int(share.argmax())
                lang[i], score[i] = field.labels[best], min(1.0, float(share[best]))
                shares[i] = list(zip(field.labels, share.tolist()))
            columns = [batch.column(0), pa.array(lang), pa.array(score)]
            columns.append(pa.array(shares, pa.map_(pa.string(), pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score", "shares"])

    return rows.mapInArrow(run, shape)


def spans(docs: DataFrame, field: crf.Field | None) -> DataFrame:
    """(id, h, start, end, lang, score): maximal runs of words with the same likeliest language.

    Places count code points, ends are exclusive; the score is the mean probability over the run's words.
    """
    rows = keyed(docs).select("id", "h", F.col("t").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        import regex

        scorer = crf.Scorer(field) if field else None
        for batch in batches:
            ids, keys, texts = (batch.column(i) for i in range(3))
            texts = texts.to_pylist()
            for i, _, found in _labelled(texts, scorer) if scorer else ():
                places = [m.span() for m in regex.finditer(WORD, texts[i])]
                best = found.argmax(axis=1)
                cuts = np.flatnonzero(np.diff(best)) + 1
                firsts = np.concatenate([[0], cuts])
                lasts = np.concatenate([cuts, [len(best)]])
                sure = np.add.reduceat(found[np.arange(len(best)), best], firsts) / (lasts - firsts)
                one = pa.array([i] * len(firsts), pa.int64())
                columns = [
                    ids.take(one),
                    keys.take(one),
                    pa.array([places[a][0] for a in firsts], pa.int64()),
                    pa.array([places[b - 1][1] for b in lasts], pa.int64()),
                    pa.array([field.labels[best[a]] for a in firsts]),
                    pa.array(sure),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "h", "start", "end", "lang", "score"])

    return rows.mapInArrow(run, f"id {kind}, h long, start long, end long, lang string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns from text and lang of the documents that are not held out (crc32 of doc_id mod 5 is not 0; a null
    doc_id is not held out); a null lang or text teaches nothing. Equal texts get equal results, whatever
    their other columns. A table without a labelled word gives ``und`` everywhere.
    """
    field = fitted(docs.where(~held_out(docs["doc_id"])))
    return predicted(docs, field).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score"
    )
