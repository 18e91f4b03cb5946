"""Periodic runs of words by block convolution, and texts without their repetitions.

A run is a stretch of words that repeats with smallest period q, at least ``EXPONENT``
times and ``LEAST_LENGTH`` words long, and that can't be extended. Scale B = 1, 2, 4, …
takes care of the periods B <= q < 2B:

* The words are cut into aligned blocks of B. As a run of such a period holds more than
  3B positions whose word comes again q words later, some whole block comes again there.
* All occurrences of a block in the window that follows it are the zeros of
  ``sum (a[i] - w[i + d])**2``. Its mixed term is a convolution, computed by a number
  theoretic transform of length 2B; as many primes as exceed the largest possible sum
  make it exact, so a zero is an occurrence and nothing else.
* The distances of the zeros seed runs: blocks in a row with the same distance are
  extended by comparison to the run's ends.

Blocks that can't contribute are left out first: those with a word that doesn't come
again within reach, and those inside a run of a smaller period, where all occurrences
are multiples of that period.

The words of many texts are laid end to end with a different mark after each; no run
crosses a mark, as nothing equals it.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import field, id_text, named, with_columns

EXPONENT, LEAST_LENGTH = 4, 6
#: Primes with roots of unity of order 2**27, 2**26 and 2**25, and a generator each.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
#: Cells of one batch of transforms.
CELLS = 1 << 20


@cache
def _roots(size: int, prime: int, generator: int) -> list[np.ndarray]:
    """Powers of a root of unity for each step of a transform, longest step first."""
    steps = []
    while size > 1:
        root, powers = pow(generator, (prime - 1) // size, prime), np.ones(1, dtype=np.uint64)
        while len(powers) < size // 2:
            powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), prime)) % np.uint64(prime)])
        steps.append(powers[: size // 2])
        size //= 2
    return steps


def _forward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of every row, in bit-reversed order."""
    p, (count, size) = np.uint64(prime), rows.shape
    for roots in _roots(size, prime, generator):
        half = len(roots)
        rows = rows.reshape(-1, 2, half)
        low, high = rows[:, 0], rows[:, 1]
        rows = np.stack([(low + high) % p, (low + p - high) % p * roots % p], axis=1)
    return rows.reshape(count, size)


def _backward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """What ``_forward`` came from."""
    p, (count, size) = np.uint64(prime), rows.shape
    for roots in reversed(_roots(size, prime, pow(generator, -1, prime))):
        half = len(roots)
        rows = rows.reshape(-1, 2, half)
        low, high = rows[:, 0], rows[:, 1] * roots % p
        rows = np.stack([(low + high) % p, (low + p - high) % p], axis=1)
    return rows.reshape(count, size) * np.uint64(pow(size, -1, prime)) % p


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Where each block occurs in its window: ``out[r, d]`` for offsets d below the block's length.

    ``blocks`` are rows of B symbols, ``windows`` rows of 2B - 1.
    """
    count, b = blocks.shape
    both = np.concatenate([blocks, windows], axis=1)
    # Smaller numbers for the symbols, row by row, so that fewer primes do.
    span = int(both.max()) + 1
    _, local = np.unique(both + span * np.arange(count, dtype=np.int64)[:, None], return_inverse=True)
    local = local.reshape(both.shape)
    local = (local - local.min(axis=1, keepdims=True)).astype(np.uint64)
    largest, product, primes = b * int(local.max()) ** 2, 1, []
    for prime, generator in PRIMES:
        if product <= largest:
            primes.append((prime, generator))
            product *= prime
    if product <= largest:
        raise ValueError(f"blocks of {b} words are beyond the exact transform")
    zero = np.ones((count, b), dtype=bool)
    for prime, generator in primes:
        p = np.uint64(prime)
        a, w = np.zeros((count, 2 * b), dtype=np.uint64), np.zeros((count, 2 * b), dtype=np.uint64)
        a[:, :b] = local[:, :b][:, ::-1]
        w[:, : 2 * b - 1] = local[:, b:]
        a, w = a % p, w % p
        sums = np.zeros((count, 2 * b + 1), dtype=np.uint64)
        np.cumsum(w * w % p, axis=1, out=sums[:, 1:])  # below 2**31 * 2B
        mixed = _backward(_forward(a, prime, generator) * _forward(w, prime, generator) % p, prime, generator)[:, b - 1 : 2 * b - 1]
        squares = (a * a % p).sum(axis=1, keepdims=True) + (sums[:, b : 2 * b] - sums[:, :b])
        zero &= squares % p == 2 * mixed % p
    return zero


def _extended(words: np.ndarray, q: int, first: int, last: int) -> tuple[int, int]:
    """The largest [start, end) around [first, last) in which every word equals the one q later."""
    step = 16
    while first:
        low = max(0, first - step)
        other = np.flatnonzero(words[low:first] != words[low + q : first + q])
        if len(other):
            first = low + int(other[-1]) + 1
            break
        first, step = low, 2 * step
    step, most = 16, len(words) - q
    while last < most:
        high = min(most, last + step)
        other = np.flatnonzero(words[last:high] != words[last + q : high + q])
        if len(other):
            last += int(other[0])
            break
        last, step = high, 2 * step
    return first, last


def _seeds(words: np.ndarray, blocks: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of all occurrences of the blocks at distances b to 2b - 1."""
    padded = np.concatenate([words, np.full(4 * b, int(words.max()) + 1, dtype=np.int64)])
    found, step = [], max(1, CELLS // (4 * b))
    for k in range(0, len(blocks), step):
        part = blocks[k : k + step]
        zero = zero_mismatches(padded[part[:, None] * b + np.arange(b)], padded[part[:, None] * b + np.arange(b, 3 * b - 1)])
        row, offset = np.nonzero(zero)
        found.append((part[row], offset + b))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def runs(words: np.ndarray, longest: int | None = None) -> np.ndarray:
    """(start, length, period) of every run of the symbols, by start and period.

    ``longest`` says how long a run may get, if that is less than all.
    """
    n = len(words)
    most = (n if longest is None else longest) // EXPONENT
    found: list[tuple[int, int, int]] = []
    if most < 1:
        return np.zeros((0, 3), dtype=np.int64)
    order = np.argsort(words, kind="stable")
    reach = np.full(n, n + 1, dtype=np.int64)
    same = words[order[1:]] == words[order[:-1]]
    reach[order[:-1][same]] = (order[1:] - order[:-1])[same]
    b = 1
    while b <= most:
        # How far the words of each whole block are from their next occurrences, at most.
        blocks = np.flatnonzero(reach < 2 * b)
        if found and len(blocks):
            known = np.array(sorted(found), dtype=np.int64)
            ends = known[:, 0] + known[:, 1]
            best = np.maximum.accumulate(ends)
            at = np.searchsorted(known[:, 0], blocks * b, side="right") - 1
            end = np.where(at >= 0, best[at], 0)
            blocks, end = blocks[end < (blocks + 3) * b], end[end < (blocks + 3) * b]
        else:
            end = np.zeros(len(blocks), dtype=np.int64)
        if len(blocks):
            covered = dict(zip(blocks.tolist(), end.tolist()))
            block, q = _seeds(words, blocks, b)
            inside = np.array([covered[k] for k in block.tolist()], dtype=np.int64)
            new = (block + 1) * b + q > inside
            block, q = block[new], q[new]
            by = np.lexsort((block, q))
            block, q = block[by], q[by]
            heads = np.flatnonzero(np.concatenate([[True], (np.diff(q) != 0) | (np.diff(block) != 1)])) if len(q) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(heads, len(q)))
            # 3q repeated positions hold so many whole blocks at least.
            enough = sizes >= ((EXPONENT - 1) * q[heads] + 1) // b - 1
            for head, size in zip(heads[enough].tolist(), sizes[enough].tolist()):
                period, start = int(q[head]), int(block[head]) * b
                start, stop = _extended(words, period, start, start + size * b)
                length = stop - start + period
                if length >= max(LEAST_LENGTH, EXPONENT * period):
                    found.append((start, length, period))
        whole = len(reach) // 2 * 2
        reach = np.maximum(reach[0:whole:2], reach[1:whole:2])
        b *= 2
    return np.array(sorted(set(found)), dtype=np.int64).reshape(-1, 3)


def planted_repeat(words: list, doc_id: bytes) -> list:
    """The words with a repetition in the tail of every tenth document, by the hash of its id."""
    h, n = zlib.crc32(doc_id), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


class _Symbols(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each list of words."""
    symbols, sizes = _Symbols(), [len(words) for words in texts]
    laid = np.empty(sum(sizes) + len(texts), dtype=np.int64)
    starts = np.cumsum([0, *[size + 1 for size in sizes]])
    for start, words in zip(starts.tolist(), texts):
        laid[start : start + len(words)] = np.fromiter(map(symbols.__getitem__, words), dtype=np.int64, count=len(words))
    laid[starts[1:] - 1] = len(symbols) + np.arange(len(texts))
    every = runs(laid, max(sizes, default=0))
    cuts = np.searchsorted(every[:, 0], starts)
    return [every[i:j] - [start, 0, 0] for i, j, start in zip(cuts[:-1], cuts[1:], starts)]


def strongest(found: np.ndarray) -> tuple[int, int, int] | None:
    """The run of greatest length / period; ties by start, then period."""
    best = None
    for start, length, period in found.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words without what repeats the first period of a run."""
    if not len(found):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


#: The columns of a text, all long but the last two.
COLUMNS = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "listed", "collapsed")


def _rows(planted: bool):
    def make():
        def rows(texts, ids=None):
            split = [(text or b"").split() for text in texts]
            if planted:
                split = [planted_repeat(words, i) for words, i in zip(split, ids)]
            out = [[] for _ in COLUMNS]
            for words, found in zip(split, runs_of_texts(split)):
                best = strongest(found)
                milli = None if best is None else 1000 * best[1] // best[2]
                listed = "".join(f"{a},{n},{q}\n" for a, n, q in found.tolist())
                text = b" ".join(collapsed(words, found)).decode("utf-8", "replace")
                for column, value in zip(out, (len(words), len(found), *(best or (None,) * 3), milli, listed, text)):
                    column.append(value)
            return out

        return rows

    return make


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", planted: bool = False) -> DataFrame:
    """id, n_words, n_runs, start, length, period, exponent_milli, listed, collapsed.

    Words are what stands between ASCII white space, numbered from 0. ``start`` to
    ``exponent_milli`` tell of the run with the most repetitions (null without a run).
    ``listed`` has a line ``start,length,period`` for each run, by start, then period;
    ``collapsed`` the words that are left when every run keeps its first period only,
    joined by one space.

    Null and blank texts have no words and an empty ``collapsed``. Texts are taken whole,
    whatever their length; a null id counts as the empty text. Repeated rows are reported
    each. Further columns of ``docs`` don't matter, whatever their names. With ``planted``
    every tenth document, by the hash of its id, gets a repetition first.
    """
    return _made(docs, id_column, text_column, planted, _rows(planted), COLUMNS)


def run_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", planted: bool = True) -> DataFrame:
    """id, n_runs, the strongest run, and digests of the list of runs and of the collapsed text."""

    def make():
        inner = _rows(planted)()

        def rows(texts, ids=None):
            *numbers, listed, texts = inner(texts, ids)
            digest = lambda values: [hashlib.sha256(v.encode()).hexdigest() for v in values]
            return [*numbers[1:], digest(listed), digest(texts)]

        return rows

    return _made(docs, id_column, text_column, planted, make, (*COLUMNS[1:6], "runs_sha256", "collapsed_sha256"))


def _made(docs: DataFrame, id_column: str, text_column: str, planted: bool, make, names) -> DataFrame:
    given = docs.select(named(id_column).alias("id"), named(text_column).alias("text"))
    inputs = [F.col("text"), *([id_text(F.col("id"))] if planted else [])]
    fields = [field(name, "string" if name in names[-2:] else "long") for name in names]
    return with_columns(given, inputs, fields, make, ["id"]).withColumnRenamed("id", id_column)
