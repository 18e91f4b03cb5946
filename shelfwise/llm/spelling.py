"""Spelling variants: frequent words that are one edit apart, found by permuterm rotations.

A word's rotations are those of the word with the terminator ``$`` behind it. The rotation
of ``x c y$`` that ends with the character ``c`` reads ``y$x c``; what stands before its last
character, ``y$x``, tells all of the word but ``c`` and where it stood. So among the sorted
rotations, those that only differ behind the prefix ``y$x`` are words that differ in one
character at one place, and a word whose whole rotation is ``y$x`` lacks that character.

Each rotation is therefore sent twice, as it is and without its last character. Both are
dealt by ranges and sorted, and one scan sees each prefix range as neighbouring rows. A
range has one row for each character of the alphabet, and one more, at most, so no range is
large, however frequent its words are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import id_text, named, stored

#: Words count from so many characters and occurrences; a form has so many times a word's occurrences.
LEAST_CHARS, LEAST_OCCURRENCES, FORM_RATIO = 6, 5, 5
#: One in so many words of a document is misspelt on purpose, if asked for.
MISSPELT = 199
TERMINATOR = "$"
_RUN = re.compile("[a-zÀ-ÿ]+")
#: Words that a task counts before it sends what it has.
HELD_WORDS = 400_000
_WHOLE, _FIRST_OF_ITS_KIND, _AGAIN = 0, 1, 2


def misspelt(word: str, seed: int) -> str:
    """The word, without one character if the hash of the document and the word says so."""
    h = zlib.crc32(word.encode(), seed)
    if h % MISSPELT:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def _counted(least_chars: int, planted: bool):
    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def shipped():
            words, counts = list(held), list(held.values())
            held.clear()
            for k in range(0, len(words), 50_000):
                columns = [pa.array(words[k : k + 50_000], pa.string()), pa.array(counts[k : k + 50_000], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in stream:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Counter(_RUN.findall((text or b"").lower().decode("utf-8", "replace")))
                seed = zlib.crc32(doc_id + b":")
                for word, n in own.items():
                    if len(word) >= least_chars:
                        word = misspelt(word, seed) if planted else word
                        if len(word) >= least_chars:
                            held[word] += n
                if len(held) > HELD_WORDS:
                    yield from shipped()
        yield from shipped()

    return task


def word_counts(docs: DataFrame, id_: Column, text: Column, least_chars: int = LEAST_CHARS, planted: bool = False) -> DataFrame:
    """(word, n): words of at least ``least_chars`` characters, counted within tasks first."""
    given = docs.select(id_text(id_).cast("binary").alias("id"), text.cast("binary").alias("text"))
    counted = given.mapInArrow(_counted(least_chars, planted), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _rotations(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, kind, word, n) for each rotation as it is, and without its last character.

    A character that follows its like is marked: without either of them a word reads the same,
    and one of both is enough to meet the shorter word.
    """
    for whole in stream:
        for k in range(0, whole.num_rows, 4000):
            batch = whole.slice(k, 4000)
            keys, kinds, words, counts = [], [], [], []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                m = len(word)
                around = word + TERMINATOR + word
                keys += [around[i : i + m + 1] for i in range(m + 1)]
                keys += [around[i + 1 : i + m + 1] for i in range(m)]
                kinds += [_WHOLE] * (m + 1)
                kinds += [_AGAIN if i and word[i] == word[i - 1] else _FIRST_OF_ITS_KIND for i in range(m)]
                words += [word] * (2 * m + 1)
                counts += [n] * (2 * m + 1)
            columns = [pa.array(keys, pa.string()), pa.array(kinds, pa.int32()), pa.array(words, pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "kind", "word", "n"])


def _near_in_range(members: list[tuple[int, int, str]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, count of the best one, the best one) for members (kind, -count, word) of one range."""
    edited = sorted(m[1:] for m in members if m[0] != _WHOLE)
    whole = next((m[1:] for m in members if m[0] == _WHOLE), None)
    firsts = sorted(m[1:] for m in members if m[0] == _FIRST_OF_ITS_KIND)
    for kind, count, word in members:
        if kind == _WHOLE:
            best, n = firsts[0] if firsts else None, len(firsts)
        else:
            best, n = next((m for m in edited[:2] if m[1] != word), None), len(edited) - 1
            if kind == _FIRST_OF_ITS_KIND and whole:
                best, n = min(best, whole) if best else whole, n + 1
        if best:
            yield word, n, -best[0], best[1]


def _scanned(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_near_in_range`` finds in the rows of equal keys, which follow each other."""

    def rows():
        for batch in stream:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    out: list[tuple[str, int, int, str]] = []

    def shipped():
        columns = list(zip(*out)) or [(), (), (), ()]
        out.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "n_near", "near_n", "near"])

    for _, group in groupby(rows(), key=lambda r: r[0]):
        members = [(kind, -n, word) for _, kind, word, n in group]
        if len(members) > 1:
            out.extend(_near_in_range(members))
            if len(out) > 50_000:
                yield shipped()
    yield shipped()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) for the distinct ``words(word, n)`` that are one edit from another.

    ``n_near`` counts the words that differ by one inserted, deleted or replaced character,
    ``near`` is the most frequent of them, by code points among equals.
    """
    spark = words.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rotations = words.select("word", "n").mapInArrow(_rotations, "key string, kind int, word string, n long")
    ranges = rotations.repartitionByRange(partitions, "key").sortWithinPartitions("key")
    found = ranges.mapInArrow(_scanned, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.word").alias("near")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms that begins at each word of ``forms(word, form)``.

    The chains must not be cyclic. Each round doubles the steps taken and is written to the
    shared folder.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = reached.select(F.col("word").alias("at"), F.col("root").alias("next")).hint("merge")
        longer = reached.hint("merge").join(onward, F.col("root") == F.col("at"), "left")
        longer = stored(longer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        reached = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return reached


def spelling_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_chars: int = LEAST_CHARS,
    least_occurrences: int = LEAST_OCCURRENCES,
    ratio: int = FORM_RATIO,
    planted: bool = False,
) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each frequent word of all texts.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, of at least
    ``least_chars`` characters and ``least_occurrences`` occurrences. Near words are one
    inserted, deleted or replaced character apart. A word's form is the most frequent near
    word (ties: the smallest by code points) if it has ``ratio`` (over 1) times the word's
    occurrences, else null; its root is where following forms ends, the word itself without one.

    Null and empty texts have no words. Texts are taken whole, and a repeated row counts
    again. Ids matter only with ``planted``, which misspells one in 199 words of a document; a
    null id then counts as the empty text. An empty table gives no rows. Further columns of
    ``docs`` don't matter, whatever their names.
    """
    if ratio <= 1:
        raise ValueError("a form must have more occurrences than the word")
    counts = word_counts(docs, named(id_column), named(text_column), least_chars, planted)
    words = stored(counts.where(F.col("n") >= least_occurrences), "words")
    near = stored(near_words(words), "near")
    frequent = F.col("near_n") >= ratio * F.col("n")
    joined = words.hint("merge").join(near.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("near")).alias("form"),
        F.when(frequent, F.col("near_n")).alias("form_n"),
    )
    joined = stored(joined, "variants")
    ends = roots(joined.where("form IS NOT NULL"))
    return joined.hint("merge").join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
