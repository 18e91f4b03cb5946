"""Language-model scores by context-tree weighting over bytes, with the tree as a table.

Each byte is eight binary decisions; each decision has a tree of contexts, the bytes
before it, of depth 0 to ``DEPTH``. A node holds the Krichevsky-Trofimov estimate of the
decisions seen in its context, and weighs it half and half against its children. No context
is left out or folded, however rare, and nothing of the tree is on the driver.

A row of the tree is a pair of a context and a byte that follows it somewhere, written as one
number: the nearest byte first, the symbol last. Pairs of texts that don't teach are rows with
a count of 0, so every pair that a text asks for is there, and what was never seen needs no case
of its own. The steps, with packed arrays as rows between them:

1. Texts are packed into slices. Each slice asks for its distinct pairs once, with its counts.
2. Pairs are dealt by the ``DEPTH - SPAN`` nearest bytes of their context. A task sums up the
   counts and resolves the ``SPAN`` farthest depths from the leaves up. So it goes on to the root,
   ``SPAN`` depths at a time: a group that must meet in a task has ``256 ** (SPAN + 1)`` pairs at
   most, whatever the corpus.
3. On the way back down each pair gets the mixture of all depths above it, and at the deepest
   one its probability, which goes back to the slices that asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, groupby
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.batches import batches, crc_fold, field, named, small_batches, stored
from shelfwise.session import collect_garbage, run_folder, scratch_path

#: Bytes of the longest context, and how many depths are resolved together; they divide.
DEPTH, SPAN = 6, 2
#: Bytes of a slice, bytes whose pairs are made at a time, and bytes of text for each bucket of pairs.
SLICE, WINDOW, BUCKET = 8 << 20, 1 << 20, 16 << 20
#: Bytes of text whose tokens are looked up at a time.
PART = 1 << 20
#: Bytes of packed rows that a task takes at a time.
ROWS_BYTES = 4 << 20
#: The most buckets, of leaves and above.
MOST_BUCKETS, MOST_UPPER = 1 << 16, 1 << 10
#: Tokens of at least this share of all are scored from a table sent along, the others by a join.
FREQUENT = 20
FOLDS, HELD_OUT = 5, 1
#: Before the first byte of a text, and after its last one; never part of UTF-8.
EDGE = 255
END = b"\n"


# --- packed arrays ---------------------------------------------------------------------


def packed(**columns) -> bytes:
    """Columns of one length as one compressed value."""
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(body: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(body).read_next_batch()


def _array(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _steps(code: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences, which compress better."""
    return np.diff(code, prepend=np.uint64(0))


def _eight(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    return {f"{name}{level}": values[:, level] for level in range(8)}


def _of_eight(parts: Sequence[pa.RecordBatch], name: str) -> np.ndarray:
    return np.stack([np.concatenate([_array(p, f"{name}{level}") for p in parts]) for level in range(8)], axis=1)


def _bytes_of(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Floats as columns of their first, second, … bytes, which compress better."""
    parts = np.ascontiguousarray(values, dtype=np.float32).view(np.uint8).reshape(-1, 4)
    return {f"{name}{k}": np.ascontiguousarray(parts[:, k]) for k in range(4)}


def _of_bytes(part: pa.RecordBatch, name: str) -> np.ndarray:
    return np.stack([_array(part, f"{name}{k}") for k in range(4)], axis=1).view(np.float32)[:, 0]


#: What goes from step to step; ``kind`` orders the rows of a key.
ROW = "key long, kind int, slice long, body binary"
_PAIRS, _BELOW, _ABOVE, _ASKED, _ANSWER = range(5)


def _rows(rows: Sequence[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "kind", "slice", "body"])


def _keyed(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """(key, its rows) of sorted rows, one row in memory at a time."""

    def rows():
        for batch in stream:
            for k in range(batch.num_rows):
                yield tuple(c[k].as_py() for c in batch.columns)

    return groupby(rows(), key=lambda r: r[0])


def _by_key(rows: DataFrame, task: Callable, schema: str | T.StructType = ROW) -> DataFrame:
    """``task`` over rows that are dealt by key and sorted by key and kind."""
    return rows.repartition("key").sortWithinPartitions("key", "kind").mapInArrow(task, schema)


def _bucket(contexts: np.ndarray, buckets: int) -> np.ndarray:
    mixed = contexts * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _dealt(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, places) for each distinct key, places ascending."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(order))):
        yield int(keys[order[a]]), order[a:b]


# --- slices and pairs -------------------------------------------------------------------


def _slices(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, body): rows of about ``SLICE`` bytes of text together; one long text forms a slice."""

    def closed(held, size):
        table = pa.Table.from_batches(held).sort_by("held_out").combine_chunks()
        body = packed(**{name: table.column(name).combine_chunks() for name in table.column_names})
        return pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), pa.array([body], pa.binary())], names=["size", "body"])

    held, size = [], 0
    for batch in stream:
        sizes = np.cumsum([len(t.as_buffer() or b"") + DEPTH + 1 for t in batch.column(1)])
        part, start = (size + sizes) // SLICE, 0
        for end in [*(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]:
            if end > start:
                held.append(batch.slice(start, end - start))
                size += int(sizes[end - 1] - (sizes[start - 1] if start else 0))
                start = end
                if size >= SLICE or end < batch.num_rows:
                    yield closed(held, size)
                    held, size = [], 0
    if held:
        yield closed(held, size)


class Laid:
    """Lower-cased texts end to end, each behind ``DEPTH`` edges and with one as its last symbol."""

    def __init__(self, texts: Sequence[bytes | None]):
        pad, edge = bytes([EDGE]) * DEPTH, bytes([EDGE])
        parts = [pad + (t or b"").lower() + edge for t in texts]
        #: Symbols of each text.
        self.sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) - DEPTH
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def windows(self, first: int, last: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(texts from, to, pairs of their symbols) for the texts from ``first`` to ``last``.

        A window has about ``WINDOW`` symbols; a longer text is spread over several.
        """
        ends = np.cumsum(self.sizes + DEPTH)
        starts = ends - self.sizes  # of the symbols
        at = first
        while at < last:
            upto = max(at + 1, int(np.searchsorted(ends, starts[at] + WINDOW, side="right")))
            upto = min(upto, last)
            for a in range(int(starts[at]), int(ends[upto - 1]), WINDOW) if upto == at + 1 else [int(starts[at])]:
                b = min(a + WINDOW, int(ends[at])) if upto == at + 1 else int(ends[upto - 1])
                code = self._pairs(a, b)
                if upto > at + 1:
                    symbol = np.ones(b - a, dtype=bool)
                    for k in range(1, DEPTH + 1):
                        symbol[starts[at + 1 : upto] - k - a] = False
                    code = code[symbol]
                yield at, upto, code
            at = upto

    def _pairs(self, a: int, b: int) -> np.ndarray:
        code = self.data[a:b].astype(np.uint64)
        for back in range(1, DEPTH + 1):
            code |= self.data[a - back : b - back].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - back))
        return code


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, ascending, and how often each occurs."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def _merged(code: np.ndarray, n: np.ndarray, more: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts of both, each by distinct ascending numbers."""
    every, total = np.concatenate([code, more]), np.concatenate([n, counts])
    order = np.argsort(every, kind="stable")  # two runs in order, which it merges
    every, total = every[order], total[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(total, first) if len(first) else total


def _union(codes: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The distinct numbers of both, ascending. By sorting, as ``np.union1d`` hashes, at ten times the time and memory."""
    return _counted(np.concatenate([codes, more]))[0]


def _distinct_pairs(texts: Sequence[bytes | None], taught: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of all texts, and how often each occurs in the first ``taught`` ones."""
    laid = Laid(texts)
    every, n = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    for first, last in ((0, taught), (taught, len(texts))):
        for _, _, code in laid.windows(first, last):
            seen, counts = _counted(code)
            every, n = _merged(every, n, seen, counts if first < taught else 0 * counts)
    return every, n


def tokens_of(text: bytes | None) -> list[bytes]:
    """The lower-cased words of a text and its end, which is a token too."""
    return [*(text or b"").lower().split(), END]


def _token_parts(texts: Sequence[bytes | None]) -> Iterator[tuple[int, int, list[int], pa.Array]]:
    """(texts from, to, the number of tokens of each, their tokens) for about ``PART`` bytes of text at a time."""
    part = np.cumsum([len(t or b"") + 1 for t in texts]) // PART
    for a, b in zip(first_of := np.flatnonzero(np.diff(part, prepend=-1)), np.append(first_of[1:], len(texts))):
        tokens = [tokens_of(t) for t in texts[a:b]]
        yield int(a), int(b), list(map(len, tokens)), pa.array(chain.from_iterable(tokens), pa.binary())


def _token_counts(texts: Sequence[bytes | None]) -> pa.Table:
    """(token, n) of all texts."""
    none = pa.table({"token": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    parts = [none, *(pa.table(tokens.value_counts().flatten(), names=["token", "n"]) for *_, tokens in _token_parts(texts))]
    return pa.concat_tables(parts).group_by("token").aggregate([("n", "sum")]).select(["token", "n_sum"])


_ASKING = "key long, kind int, slice long, body binary, token binary, n long"


def _asking(buckets: int) -> Callable:
    """For each slice the distinct pairs in every bucket, with their counts in training texts; and the counts of tokens."""

    kinds = {"key": pa.int64(), "kind": pa.int32(), "slice": pa.int64(), "body": pa.binary(), "token": pa.binary(), "n": pa.int64()}

    def made(size: int, **given) -> pa.RecordBatch:
        columns = [pa.array(given[c], k) if c in given else pa.nulls(size, k) for c, k in kinds.items()]
        return pa.RecordBatch.from_arrays(columns, names=list(kinds))

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = unpacked(body)
                texts, taught = rows.column("text").to_pylist(), int((~_array(rows, "held_out").astype(bool)).sum())
                every, counts = _distinct_pairs(texts, taught)  # those held out stand behind the others
                for key, at in _dealt(_bucket(every >> np.uint64(8 * SPAN + 8), buckets)):
                    yield made(1, key=[key], kind=[_ASKED], slice=[number], body=[packed(code=_steps(every[at]), n=counts[at])])
                del every, counts
                for part in _token_counts(texts[:taught]).to_batches(50_000):
                    yield made(part.num_rows, token=part.column(0), n=part.column(1))

    return task


# --- estimates ------------------------------------------------------------------------


def lgamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0, by Stirling's series from 8 on."""
    x = np.asarray(x, dtype=np.float64)
    low = np.where(x < 8, x, 8.0)
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(low + k)
    z = np.where(x < 8, x + 8, x)
    r = 1 / (z * z)
    out = (z - 0.5) * np.log(z) - z + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / z
    return np.where(x < 8, out - shift, out)


_SMALL = 1 << 14
_HALVES, _WHOLES = lgamma(np.arange(_SMALL) + 0.5), lgamma(np.arange(_SMALL) + 1.0)


def _looked_up(known: np.ndarray, counts: np.ndarray, plus: float) -> np.ndarray:
    """lgamma(counts + plus), from ``known`` for small counts."""
    out = known[np.minimum(counts, _SMALL - 1).astype(np.int64)]
    large = counts >= _SMALL
    out[large] = lgamma(counts[large] + plus)
    return out


def kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of any one sequence with these counts."""
    halves = _looked_up(_HALVES, zeros, 0.5) + _looked_up(_HALVES, ones, 0.5)
    return halves - _looked_up(_WHOLES, zeros + ones, 1.0) - 2 * 0.5723649429247001


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1.0)


# --- the tree -------------------------------------------------------------------------


@dataclass
class Pairs:
    """Distinct pairs of one depth, ascending, their counts, and each one's place among the pairs a byte shorter."""

    code: np.ndarray
    n: np.ndarray
    up: np.ndarray | None = None

    def decisions(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The decisions at this bit of the symbol: first pair of each, decision of each pair, zeros and ones."""
        key = self.code >> np.uint64(8 - level)
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first, bit = np.flatnonzero(new), ((self.code >> np.uint64(7 - level)) & np.uint64(1)).astype(np.float64)
        total, ones = np.add.reduceat(self.n, first), np.add.reduceat(self.n * bit, first)
        return first, np.cumsum(new) - 1, total - ones, ones


class Tier:
    """``SPAN`` depths of the tree below some nodes; with ``root`` the root's own depth too.

    ``below`` has for the deepest pairs, at each of the eight decisions of the symbol, the log
    probability that all subtrees under their context give to what was seen there; None for leaves.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray, below: np.ndarray | None = None, root: bool = False):
        self.below, self.root = below, root
        self.chain = [Pairs(code, n.astype(np.float64))]
        for _ in range(SPAN):
            last = self.chain[-1]
            shorter = ((last.code >> np.uint64(16)) << np.uint64(8)) | (last.code & np.uint64(255))
            code, last.up = np.unique(shorter, return_inverse=True)
            self.chain.append(Pairs(code, np.bincount(last.up, weights=last.n, minlength=len(code))))

    @property
    def top(self) -> Pairs:
        return self.chain[-1]

    def _climb(self, level: int) -> tuple[list[tuple], np.ndarray]:
        """What each depth keeps for the way down, deepest first; and what is below the top pairs."""
        split = [pairs.decisions(level) for pairs in self.chain]
        kept, below = [], None if self.below is None else self.below[split[0][0], level]
        for d, (pairs, (first, group, zeros, ones)) in enumerate(zip(self.chain, split)):
            if d == SPAN and not self.root:
                break
            own, stay = kt_log(zeros, ones), None
            whole = own
            if below is not None:
                stay = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
                whole = np.logaddexp(own, below) - np.log(2)
            kept.append((first, group, kt_one(zeros, ones), stay))
            if d < SPAN:
                above = split[d + 1][1]
                below = np.bincount(above[pairs.up[first]], weights=whole, minlength=above[-1] + 1)
        return kept, below if self.root else below[split[-1][1]]

    def climbed(self) -> np.ndarray:
        """What is below the top pairs, at each decision."""
        return np.stack([self._climb(level)[1] for level in range(8)], axis=1)

    def _descend(self, level: int, mixed: np.ndarray | None, left: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """For the deepest pairs: probability of a 1 that the depths so far settle, and the share that is left to deeper ones."""
        kept, _ = self._climb(level)
        for d in range(len(kept) - 1, -1, -1):
            first, group, one, stay = kept[d]
            if mixed is None:
                before, share = np.zeros(len(first)), np.ones(len(first))
            else:
                before, share = mixed[self.chain[d].up[first]], left[self.chain[d].up[first]]
            stays = share if stay is None else share * stay
            mixed, left = (before + stays * one)[group], (share - stays)[group]
        return mixed, left

    def descended(self, mixed: np.ndarray | None = None, left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The same for all eight decisions, from what the top pairs got; the root needs nothing."""
        each = [self._descend(k, *((None, None) if mixed is None else (mixed[:, k], left[:, k]))) for k in range(8)]
        return np.stack([m for m, _ in each], axis=1), np.stack([x for _, x in each], axis=1)

    def logs(self, mixed: np.ndarray, left: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol of each of the deepest pairs, which are leaves."""
        out = np.zeros(len(self.chain[0].code))
        for level in range(8):
            one, _ = self._descend(level, mixed[:, level], left[:, level])
            bit = (self.chain[0].code >> np.uint64(7 - level)) & np.uint64(1)
            out += np.log10(np.where(bit == 1, one, 1 - one))
        return out


def _summed(parts: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of all bodies and their total counts, merged as they come in."""
    code, n, held = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def merged():
        codes, counts = (np.concatenate(x) for x in zip((code, n), *held))
        distinct, place = np.unique(codes, return_inverse=True)
        return distinct, np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)

    waiting = 0
    for body in parts:
        rows = unpacked(body)
        held.append((np.cumsum(_array(rows, "code"), dtype=np.uint64), _array(rows, "n")))
        waiting += rows.num_rows
        if waiting > 500_000 + len(code):
            code, n = merged()
            held, waiting = [], 0
    return merged()


def _below_rows(tier: Tier, keys: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple]:
    below = tier.climbed()
    for key, at in _dealt(keys(tier.top.code)):
        yield key, _BELOW, None, packed(code=tier.top.code[at], n=tier.top.n[at], **_eight("below", below[at]))


def _above_rows(code: np.ndarray, mixed: np.ndarray, left: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
    for key, at in _dealt(keys):
        yield key, _ABOVE, None, packed(code=code[at], **_eight("mixed", mixed[at]), **_eight("left", left[at]))


def _tier_of(parts: Sequence[pa.RecordBatch], root: bool = False) -> Tier:
    code = np.concatenate([_array(p, "code") for p in parts])
    order = np.argsort(code)
    n, below = np.concatenate([_array(p, "n") for p in parts]), _of_eight(parts, "below")
    return Tier(code[order], n[order], below[order], root)


def _in_order(parts: Sequence[pa.RecordBatch], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the pairs above got, in the order of the pairs ``wanted``, all of which are there."""
    place = np.concatenate([_array(p, "code") for p in parts])
    order = np.argsort(place)[np.searchsorted(np.sort(place), wanted)]
    return _of_eight(parts, "mixed")[order], _of_eight(parts, "left")[order]


def _upper_keys(code: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """The task of pairs whose tier begins ``bits`` above the symbol."""
    return _bucket(code >> np.uint64(8 + bits), buckets)


def _leaves(depth: int, upper: int) -> Callable:
    """Sums up the pairs of a bucket, and resolves the deepest depths."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _keyed(stream):
            code, n = _summed(r[3] for r in rows)
            yield _rows([(key, _PAIRS, None, packed(code=_steps(code), n=n))])
            yield from _shipped(_below_rows(Tier(code, n), lambda c: _upper_keys(c, 8 * SPAN, upper) if depth > 2 * SPAN else np.zeros(len(c), np.int64)))

    return task


def _shipped(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield _rows([row])


def _climbing(last: bool, upper: int) -> Callable:
    """Resolves the depths of a middle tier; ``last``: the tier above is the root's."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _keyed(stream):
            tier = _tier_of([unpacked(r[3]) for r in rows])
            yield from _shipped(_below_rows(tier, lambda c: np.zeros(len(c), np.int64) if last else _upper_keys(c, 8 * SPAN, upper)))

    return task


def _root(keys: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """The first ``SPAN`` depths, at most ``256 ** (SPAN + 1)`` pairs, and on the way down to the tier below."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _keyed(stream):
            tier = _tier_of([unpacked(r[3]) for r in rows], root=True)
            code = tier.chain[0].code
            yield from _shipped(_above_rows(code, *tier.descended(), keys(code)))

    return task


def _descending(keys: Callable[[np.ndarray], np.ndarray]) -> Callable:
    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _keyed(stream):
            below, above = [], []
            for _, kind, _, body in rows:
                (below if kind == _BELOW else above).append(unpacked(body))
            tier = _tier_of(below)
            code = tier.chain[0].code
            yield from _shipped(_above_rows(code, *tier.descended(*_in_order(above, tier.top.code)), keys(code)))

    return task


def _answering(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each slice the log probabilities of the pairs it asked this bucket for, in their order."""
    for key, rows in _keyed(stream):
        tier, above, logs = None, [], None
        for _, kind, number, body in rows:
            part = unpacked(body)
            if kind == _PAIRS:
                tier = Tier(np.cumsum(_array(part, "code"), dtype=np.uint64), _array(part, "n"))
            elif kind == _ABOVE:
                above.append(part)
            else:
                if logs is None:
                    logs = tier.logs(*_in_order(above, tier.top.code)).astype(np.float32)
                asked = np.cumsum(_array(part, "code"), dtype=np.uint64)
                answer = packed(**_bytes_of("log", logs[np.searchsorted(tier.chain[0].code, asked)]))
                yield pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int64()), "bucket": pa.array([key], pa.int64()), "body": pa.array([answer], pa.binary())})


def pair_logs(asked: DataFrame, buckets: int) -> DataFrame:
    """(slice, bucket, body): the answers to ``asked``, rows of ``ROW`` with the pairs of each slice and bucket."""
    upper = min(buckets, MOST_UPPER)
    tiers = DEPTH // SPAN
    if tiers == 1:
        raise ValueError("the tree needs two tiers at least")
    leaves = stored(_by_key(asked, _leaves(DEPTH, upper)), "leaves")
    collect_garbage(asked.sparkSession)
    levels = [leaves.where(F.col("kind") == _BELOW)]
    for tier in range(tiers - 2, 0, -1):
        levels.append(stored(_by_key(levels[-1], _climbing(tier == 1, upper)), "climbed"))

    def keys(tier: int) -> Callable[[np.ndarray], np.ndarray]:
        """Where pairs at the deep end of this tier go on the way down."""
        if tier == tiers - 2:
            return lambda code: _bucket(code >> np.uint64(8), buckets)
        return lambda code: _bucket(code >> np.uint64(8), upper)

    above = stored(_by_key(levels[-1], _root(keys(0))), "descended")
    for tier in range(1, tiers - 1):
        above = stored(_by_key(levels[tiers - 2 - tier].unionByName(above), _descending(keys(tier))), "descended")
    rows = leaves.where(F.col("kind") == _PAIRS).unionByName(above).unionByName(asked)
    return _by_key(rows, _answering, "slice long, bucket long, body binary")


# --- the operator --------------------------------------------------------------------


def _rare(text: np.ndarray, token: np.ndarray, names: pa.Array, texts: int) -> pa.Array:
    """For each text its distinct tokens and how often it has them, from the texts and tokens of all places."""
    code, n = _counted(text * len(names) + token)
    first = np.searchsorted(code, np.arange(texts + 1) * len(names)).astype(np.int32)
    each = pa.StructArray.from_arrays([names.take(pa.array(code % len(names))), pa.array(n, pa.int64())], names=["token", "n"])
    return pa.ListArray.from_arrays(pa.array(first), each)


def _text_logs(texts: Sequence[bytes | None], answers: dict[int, np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The log probability and the number of symbols of each text, from the answers to what all texts asked."""
    laid = Laid(texts)
    windows, every = [], np.zeros(0, dtype=np.uint64)
    for first, last, code in laid.windows(0, len(texts)):
        order = np.argsort(code)
        code = code[order]
        new = np.concatenate([[True], code[1:] != code[:-1]])
        code = code[new]
        windows.append((first, last, order.astype(np.uint32), new, code))
        every = _union(every, code)
    values = np.empty(len(every), dtype=np.float32)
    for key, at in _dealt(_bucket(every >> np.uint64(8 * SPAN + 8), buckets)):
        values[at] = answers.pop(key)
    scores = np.zeros(len(texts))
    for first, last, order, new, distinct in windows:
        logs_of = np.empty(len(order))
        logs_of[order] = values[np.searchsorted(every, distinct)][np.cumsum(new) - 1]
        if last == first + 1:
            scores[first] += logs_of.sum()
        else:
            scores[first:last] = np.add.reduceat(logs_of, np.cumsum(laid.sizes[first:last]) - laid.sizes[first:last])
    return scores, laid.sizes


def _scored(buckets: int, shared, schema: T.StructType) -> Callable:
    """The rows of a slice, from its texts and the answers to what it asked. ``shared`` has the logs of frequent tokens."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for _, rows in _keyed(stream):
            slice_, answers = None, {}
            for _, kind, bucket, body in rows:
                if kind == _ANSWER:
                    answers[bucket] = _of_bytes(unpacked(body), "log")
                else:
                    slice_ = unpacked(body)
            texts = slice_.column("text").to_pylist()
            scores, sizes = _text_logs(texts, answers, buckets)
            for a, b, counts, tokens in _token_parts(texts):
                coded = tokens.dictionary_encode()
                names, place = coded.dictionary, coded.indices.to_numpy()
                log = np.array([logs.get(t, np.nan) for t in names.to_pylist()])[place]
                text, frequent = np.repeat(np.arange(b - a), counts), ~np.isnan(log)
                known, own = np.bincount(text[frequent], minlength=b - a), log[frequent]
                base = [float(np.sum(own[end - n : end])) for end, n in zip(np.cumsum(known), known)]
                rare = _rare(text[~frequent], place[~frequent], names, b - a)
                ids, held = (slice_.column(name).slice(a, b - a) for name in ("id", "held_out"))
                yield batches(schema, [ids, held, counts, known, base, scores[a:b], sizes[a:b], rare])

    return task


def _scored_slices(docs: DataFrame, id_: Column, text: Column) -> tuple[DataFrame, DataFrame, int, float]:
    """The rows with their scores, written; the counts of tokens, their sum, and the log of what divides them."""
    given = docs.select(id_.alias("id"), text.cast("binary").alias("text"), (crc_fold(id_, FOLDS) == HELD_OUT).alias("held_out"))
    schema = T.StructType([
        T.StructField("id", given.schema["id"].dataType), field("held_out", "boolean"), field("n_tokens", "long"), field("known", "long"),
        field("base", "double"), field("score", "double"), field("n_bytes", "long"), field("rare", "array<struct<token:binary,n:long>>"),
    ])
    spark = docs.sparkSession
    words_path, scored_path = scratch_path(spark, "tokens"), scratch_path(spark, "scored")
    with run_folder(spark):  # what is only needed on the way goes as soon as it isn't
        answers_path = scratch_path(spark, "answers")
        slices = given.mapInArrow(_slices, "size long, body binary").withColumn("slice", F.monotonically_increasing_id())
        slices = stored(slices, "slices")
        buckets = min(MOST_BUCKETS, max(1, ceil((slices.agg(F.sum("size")).first()[0] or 0) / BUCKET)))
        with run_folder(spark):
            asking = stored(slices.select("slice", "body").mapInArrow(_asking(buckets), _ASKING), "asked")
            words = stored(asking.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")), "tokens", words_path)
            answers = pair_logs(asking.where("body IS NOT NULL").select("key", "kind", "slice", "body"), buckets)
            answers = stored(answers, "answers", answers_path)
        total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
        scale = float(np.log10(total + 0.5 * (distinct + 1)))
        frequent = words.where(F.col("n") * 2**FREQUENT >= total).toArrow()  # 2 ** FREQUENT tokens at most
        logs = np.log10(frequent.column("n").to_numpy() + 0.5) - scale
        shared = spark.sparkContext.broadcast(dict(zip(frequent.column("token").to_pylist(), logs.tolist())))
        texts = slices.select(F.col("slice").alias("key"), F.lit(_PAIRS).alias("kind"), F.col("slice"), "body")
        texts = texts.unionByName(answers.select(F.col("slice").alias("key"), F.lit(_ANSWER).alias("kind"), F.col("bucket").alias("slice"), "body"))
        collect_garbage(spark)
        scored = _by_key(texts, _scored(buckets, shared, schema), schema)
        scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored", scored_path)
    collect_garbage(spark)
    return scored, words, total, scale


def language_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the texts outside the held-out fold and scores all. ``score`` is the log10
    probability of the lower-cased text and its end. Null texts count as empty, null ids as
    the empty text in the folds; repeated rows are scored each and learned from each.
    Without training texts every byte has probability 1 / 256. Texts are taken whole, each
    in one task. An empty table gives no rows; further columns don't matter.
    """
    with small_batches(docs.sparkSession, ROWS_BYTES):
        scored, words, total, scale = _scored_slices(docs, named(id_column), named(text_column))
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.token").alias("token"), F.col("r.n").alias("times"))
    log: Column = F.log10(F.coalesce("n", F.lit(0)) + 0.5) - F.lit(scale)
    seen = rare.join(words, "token", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"), F.sum(F.col("times") * log).alias("rare_base")
    )
    out = scored.drop("rare").join(seen, "row", "left")
    return out.select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
        (-F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
