"""Benchmark decontamination by Wu-Manber search, with words as the symbols.

All windows of one length form one set of patterns. A shift table over blocks of two
words says how far the search may jump ahead; where it may not, the bucket of that last
block holds the windows that end so, and each of them is compared word by word.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import field, free_name, id_text, kept_in_worker, named, stored, with_columns

WINDOW = 13
SHARE = 20
#: Words of benchmark text searched in one pass; a larger benchmark takes more passes.
BLOCK_WORDS = 200_000
_PIECE = 4_096
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


class WuManber:
    """Search for windows of ``length`` words, each with the numbers of its items."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], frozenset[int]]):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[bytes, list]] = {}
        for window, items in windows.items():
            for j in range(self.block, length + 1):
                block = window[j - self.block : j]
                self.shift[block] = min(self.shift.get(block, self.far), length - j)
            starts = self.bucket.setdefault(window[length - self.block :], {})
            starts.setdefault(window[0], []).append((list(window), items))

    def search(self, words: list[bytes], marks: bytearray, found: set[int]) -> None:
        """Mark the words inside occurrences and gather the items that occur."""
        m, b, far, shift, bucket = self.length, self.block, self.far, self.shift, self.bucket
        hit, end, n = b"\x01" * m, m, len(words)
        while end <= n:
            block = tuple(words[end - b : end])
            step = shift.get(block, far)
            if step:
                end += step
                continue
            for window, items in bucket[block].get(words[end - m], ()):
                if words[end - m : end] == window:
                    marks[end - m : end] = hit
                    found |= items
            end += 1


def build(pieces: list[tuple[int, bytes]], size: int) -> list[WuManber]:
    """One search for each length of window; ``pieces`` are (item number, words joined by spaces)."""
    windows: dict[int, dict[tuple[bytes, ...], set[int]]] = {}
    for item, text in pieces:
        words = text.split()
        length = min(size, len(words))
        own = windows.setdefault(length, {})
        for k in range(len(words) - length + 1):
            own.setdefault(tuple(words[k : k + length]), set()).add(item)
    return [WuManber(n, {w: frozenset(i) for w, i in own.items()}) for n, own in sorted(windows.items()) if n]


def _built(data: bytes) -> tuple[list[str], list[WuManber]]:
    items, numbered, size = pickle.loads(data)
    return items, build(numbered, size)


def _pieces(size: int):
    """Item texts cut into overlapping pieces, so that a very long item spreads over blocks."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            ids, sizes, texts = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for k in range(0, max(1, len(words) - size + 1), _PIECE):
                    piece = words[k : k + _PIECE + size - 1]
                    if piece:
                        ids.append(item)
                        sizes.append(len(piece))
                        texts.append(b" ".join(piece))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(sizes, pa.int64()), pa.array(texts, pa.binary())],
                names=["item", "n", "words"],
            )

    return task


def _searched(docs: DataFrame, pieces: list[tuple[str, bytes]], size: int, keep: list[str]) -> DataFrame:
    """``docs`` with n_words, spans (hit words as [start, end) ) and items."""
    items = sorted({item for item, _ in pieces})
    number = {item: k for k, item in enumerate(items)}
    numbered = pickle.dumps((items, [(number[item], text) for item, text in pieces], size))
    shared = docs.sparkSession.sparkContext.broadcast(numbered)

    def make():
        items, searches = kept_in_worker("windows", shared.value, _built)

        def rows(texts):
            counts, spans, names = [], [], []
            for text in texts:
                words = words_of(text)
                marks, found = bytearray(len(words)), set()
                for search in searches:
                    search.search(words, marks, found)
                counts.append(len(words))
                spans.append([{"start": h.start(), "end": h.end()} for h in re.finditer(b"\x01+", marks)] if found else [])
                names.append([items[k] for k in sorted(found)])
            return [np.array(counts, dtype=np.int64), spans, names]

        return rows

    made = [field("n_words", "long"), field("spans", "array<struct<start:long,end:long>>"), field("items", "array<string>")]
    return with_columns(docs, [F.col("text")], made, make, keep)


#: Overlapping and touching spans of several passes as one.
_MERGED = (
    "aggregate(array_sort(flatten(s)), cast(array() as array<struct<start:bigint,end:bigint>>), (a, x) -> "
    "if(size(a) > 0 and element_at(a, -1).end >= x.start, concat(slice(a, 1, size(a) - 1), array(named_struct("
    "'start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end)))), concat(a, array(x))))"
)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (doc_id, if not given), n_words, n_hit, items (sorted), spans, contaminated.

    A document word inside an occurrence of a benchmark window is hit; the document is
    contaminated if some word and at least one in ``SHARE`` is. Null and empty texts have no
    words and are clean. An item without words never occurs; one without id counts as item
    "". Repeated items and documents each count. The benchmark is read in blocks of about
    ``block_words`` words, one pass over the documents for each, so no table outgrows a task.
    """
    keep = ["doc_id"] if keep is None else keep
    row = free_name(docs, "row")
    given = benchmark.select(id_text(named("item_id")).alias("item"), F.col("text").cast("binary").alias("text"))
    pieces = stored(given.mapInArrow(_pieces(size), "item string, n long, words binary").distinct(), "pieces")
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    passes = max(1, -(-total // block_words))
    if passes == 1:
        found = _searched(docs, pieces.select("item", "words").collect(), size, keep)
    else:
        pieces = stored(pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(passes))), "pieces")
        placed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "searched")
        each = [
            _searched(placed, pieces.where(F.col("block") == k).select("item", "words").collect(), size, [row])
            for k in range(passes)
        ]
        every = each[0]
        for one in each[1:]:
            every = every.unionByName(one)
        joined = every.groupBy(row).agg(
            F.max("n_words").alias("n_words"), F.collect_list("spans").alias("s"), F.collect_set("items").alias("i")
        )
        joined = joined.select(row, "n_words", F.expr(_MERGED).alias("spans"), F.array_sort(F.array_distinct(F.flatten("i"))).alias("items"))
        found = placed.select(*[named(c) for c in keep], row).join(joined, row).drop(row)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    found = found.withColumn("n_hit", n_hit)
    return found.select(
        *[named(c) for c in keep],
        "n_words",
        "n_hit",
        "items",
        "spans",
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated rows; other columns, of whatever name, stay."""
    kept = docs.columns
    plain = docs.select(*[named(c).alias(f"c{i}") for i, c in enumerate(kept)], named("text").alias("text"))
    found = contamination(plain, benchmark, size, keep=[f"c{i}" for i in range(len(kept))])
    return found.where("not contaminated").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)])
