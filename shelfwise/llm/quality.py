"""Quality rules: how far a text's histograms lie from those of its language."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import field, named, stored, with_columns

#: Base rules.
LEAST_WORDS, REPEATED_PERCENT = 50, 50
#: A word is common if it is at least this share of its language's words: 1,000 words at most.
COMMON = 1 / 1000
#: Largest Jensen-Shannon distances (0 to 1) from the language's histograms.
CLASS_DISTANCE, WORD_DISTANCE = 0.3, 0.45
#: Texts of fewer characters or words have histograms too coarse to judge; a language needs so many words to be a reference.
CLASS_LEAST, WORD_LEAST, REFERENCE_LEAST = 200, 100, 2_000
#: Bytes of references that may be sent to tasks; more are joined by language.
REFERENCE_BYTES = 64 << 20

_SYMBOLS = b"#*$%&|<>"
_SPACES = bytes([32, *range(9, 14)])
_CONTINUED = bytes(range(128, 192))
CLASSES = ("lower", "upper", "letter", "mark", "digit", "space", "line", "stop", "symbol", "other")
#: Unicode categories, by their first letters.
_KINDS = {"Ll": "lower", "Lu": "upper", "Lt": "upper", "L": "letter", "M": "mark", "N": "digit", "Z": "space", "P": "stop", "S": "symbol"}


def class_of(char: str) -> str:
    """The class of a character, whatever its script."""
    if char in "\n\r":
        return "line"
    if char in "\t\v\f":
        return "space"
    if char in _SYMBOLS.decode():
        return "symbol"
    category = unicodedata.category(char)
    return _KINDS.get(category) or _KINDS.get(category[0], "other")


@cache
def _classes(size: int) -> np.ndarray:
    """The class numbers of all code points below ``size``."""
    place = {name: k for k, name in enumerate(CLASSES)}
    return np.fromiter((place[class_of(chr(c))] for c in range(size)), dtype=np.uint8, count=size)


def class_counts(text: bytes) -> np.ndarray:
    """Characters of each class."""
    if text.isascii():
        points, size = np.frombuffer(text, dtype=np.uint8), 128
    else:
        points, size = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4"), 0x110000
    return np.bincount(_classes(size)[points], minlength=len(CLASSES)).astype(float)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance with base 2 of two histograms; 0 if either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    half = [np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])) for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(half) / 2)))


def base_rules(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    chars = len(text.translate(None, _SPACES + _CONTINUED))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        counts, upto = Counter(triples), 0
        for k, triple in enumerate(triples):
            if counts[triple] > 1:
                repeated += k + 3 - max(k, upto)
                upto = k + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


_TALLY = "lang string, word binary, n long"


def _tallied(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language, and under a null word plus class number its characters."""
    words: Counter = Counter()

    def shipped():
        every = list(words.items())
        words.clear()
        for k in range(0, len(every), 50_000):
            part = every[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0] for key, _ in part], pa.string()), pa.array([key[1] for key, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())],
                names=["lang", "word", "n"],
            )

    for batch in stream:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            own: Counter = Counter()
            for text in texts:
                own.update(text.lower().split())
            for word, n in own.items():
                words[lang, word] += n
            classes = sum(class_counts(text) for text in texts)
            for k in np.flatnonzero(classes):
                words[lang, b" %d" % k] += int(classes[k])  # no word begins with a space
        if len(words) > 500_000:
            yield from shipped()
    yield from shipped()


def references(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text", common: float = COMMON, sent_bytes: int = REFERENCE_BYTES
) -> DataFrame:
    """(lang, word, n, total): classes as words " 0", " 1", …, and words that are common in a language."""
    lang = F.coalesce(named(lang_column).cast("string"), F.lit(""))
    given = docs.select(lang.alias("lang"), named(text_column).cast("binary").alias("text"))
    counted = stored(given.mapInArrow(_tallied, _TALLY).groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    is_class = F.col("word").startswith(F.lit(" ").cast("binary"))
    total = counted.where(~is_class).groupBy("lang").agg(F.sum("n").alias("total"))
    total = stored(total, "totals")
    size = total.agg(F.coalesce(F.sum(F.length("lang") + 100), F.lit(0))).first()[0]
    if size <= sent_bytes:
        joined = counted.join(F.broadcast(total), "lang", "left")
    else:  # two fresh shuffles, so that adaptive execution can split a language with a third of the words
        joined = counted.hint("merge").join(total.hint("merge"), "lang", "left")
    return joined.where(is_class | (F.col("n") >= common * F.col("total"))).select("lang", "word", "n", F.coalesce("total", F.lit(0)).alias("total"))


#: Class histogram, places of the common words, word histogram with the rest last, number of words.
Reference = tuple[np.ndarray, dict[bytes, int], np.ndarray | None, int]
_UNKNOWN: Reference = (np.zeros(len(CLASSES)), {}, None, 0)


def _reference_of(entries: Sequence[tuple[bytes, int]], total: int) -> Reference:
    """The reference of a language from its (word, n) in order."""
    classes, words, counts = np.zeros(len(CLASSES)), {}, []
    for word, n in entries:
        if word.startswith(b" "):
            classes[int(word)] = n
        else:
            words[word] = len(words)
            counts.append(n)
    return classes, words, np.array([*counts, total - sum(counts)], dtype=float), total


def _judge(text: bytes, reference: Reference) -> tuple:
    """The base counts of a text, and its distances from the reference."""
    base = base_rules(text)
    histogram, place, words, total = reference
    classes = by_word = 0.0
    if total >= REFERENCE_LEAST:
        own = class_counts(text)
        if own.sum() >= CLASS_LEAST:
            classes = distance(own, histogram)
        if base[0] >= WORD_LEAST:
            at = [place.get(w, len(place)) for w in text.lower().split()]
            by_word = distance(np.bincount(at, minlength=len(place) + 1).astype(float), words)
    return *base, classes, by_word


def quality(
    docs: DataFrame, id_column: str = "doc_id", lang_column: str = "lang", text_column: str = "text", sent_bytes: int = REFERENCE_BYTES
) -> DataFrame:
    """id, n_words, the base counts, class_distance, word_distance, base_failed, kept.

    A null text has no words; a null language is one of its own. A text under the least
    length, or of a language with too few words to be a reference, is judged by the base
    rules alone and has distance 0. Repeated rows are judged, and count for the references, each.
    An empty table gives no rows; further columns don't matter. The references of all languages
    go to every task if they have up to ``sent_bytes``, else each to its language's texts.
    """
    lang = F.coalesce(named(lang_column).cast("string"), F.lit(""))
    listed = stored(references(docs, lang_column, text_column, sent_bytes=sent_bytes), "references")
    entries = F.array_sort(F.collect_list(F.struct("word", "n"))).alias("entries")
    whole = listed.groupBy("lang").agg(entries, F.max("total").alias("total"))
    size = listed.agg(F.coalesce(F.sum(F.length("word") + 100), F.lit(0))).first()[0]
    given = docs.select(named(id_column).alias("id"), lang.alias("lang"), named(text_column).alias("text"))
    inputs = [F.col("lang"), F.col("text")]
    if size <= sent_bytes:
        sent = {r.lang: ([(bytes(e.word), e.n) for e in r.entries], r.total) for r in whole.collect()}
        shared = docs.sparkSession.sparkContext.broadcast(sent)
    else:
        shared = None
        given = given.hint("merge").join(stored(whole, "whole").hint("merge"), "lang", "left")
        inputs += [F.col("entries"), F.col("total")]

    def make():
        if shared is not None:
            known = {lang: _reference_of(*found) for lang, found in shared.value.items()}
            return lambda langs, texts: _columns([_judge(t or b"", known.get(lang.decode(), _UNKNOWN)) for lang, t in zip(langs, texts)])
        held: dict[bytes, Reference] = {}  # of the last language only

        def rows(langs, texts, entries, totals):
            out = []
            for lang, text, own, total in zip(langs, texts, entries, totals):
                if lang not in held:
                    held.clear()
                    held[lang] = _reference_of([(e["word"], e["n"]) for e in own], total) if own else _UNKNOWN
                out.append(_judge(text or b"", held[lang]))
            return _columns(out)

        return rows

    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    made = [*[field(c, "long") for c in longs], field("class_distance", "double"), field("word_distance", "double")]
    found = with_columns(given, inputs, made, make, ["id"]).withColumnRenamed("id", id_column)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    near = (F.col("class_distance") <= CLASS_DISTANCE) & (F.col("word_distance") <= WORD_DISTANCE)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & near)


def _columns(rows: Sequence[tuple]) -> list[list]:
    return [*map(list, zip(*rows))] if rows else [[]] * 7
