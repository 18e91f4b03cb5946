"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; two link at 3 or fewer differing bits. Half of that radius
is one bit from the one side and two from the other, so two linked fingerprints share
a variant. Two counting arguments keep the balls small without losing a link:

* Parity. Fingerprints of unlike parity differ in 1 or 3 bits, those of like parity in
  2. Only even ones need to flip two bits; like ones meet with one flip each.
* Halves. Of three differing bits, two lie in the same half of the word, so the even
  side flips pairs within a half only (992 of 2,016 pairs).

Variants meet by a shuffle on a linear hash of the variant. As the hash of ``x ^ mask``
is ``hash(x) ^ hash(mask)``, a row need only say which fingerprint comes to which bucket:
the bucket makes the variants that belong to it itself. At one variant all fingerprints
within one bit are linked to each other, and those at two bits to them, so a star around
the least near one holds every link there is: no pairs within a group are written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import field, free_name, named, stored, with_columns
from shelfwise.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Variants that one bucket should hold, and their mean number for a fingerprint.
BUCKET_VARIANTS, MEAN_VARIANTS = 2_000_000, 561
#: There are two to this power buckets at least.
LEAST_WIDTH = 7
_CHUNK = 500_000


def _bits(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit, highest bit first."""
    return np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text, 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends.tolist()
    digest, last = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, last, _CHUNK):
        upto = min(last, k + _CHUNK)
        counts += _bits([digest(joined[a:b], SEED) for a, b in zip(starts[k:upto], ends[min(shingle, len(words)) - 1 + k :])])
    return int.from_bytes(np.packbits(2 * counts > last).tobytes(), "big")


def _fingerprints(shingle: int):
    def make():
        def rows(texts):
            return [np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)]

        return rows

    return make


# --- linear hash and masks -----------------------------------------------------------

_DRAWN = np.random.default_rng(7).integers(0, 1 << 31, size=64, dtype=np.uint64)
_TABLES = np.zeros((8, 256), dtype=np.uint64)
for _byte in range(8):
    for _bit in range(8):
        _TABLES[_byte, (np.arange(256) >> _bit) & 1 == 1] ^= _DRAWN[8 * _byte + _bit]


def linear_hash(x: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of a hash with hash(x ^ y) = hash(x) ^ hash(y)."""
    out = np.zeros(x.shape, dtype=np.uint64)
    for byte in range(8):
        out ^= _TABLES[byte, (x >> np.uint64(8 * byte)) & np.uint64(255)]
    return (out & np.uint64((1 << width) - 1)).astype(np.int64)


_ONE = np.array([1 << i for i in range(64)], dtype=np.uint64)
_TWO = np.array(
    [(1 << i) | (1 << j) for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)], dtype=np.uint64
)
#: Masks by parity of the fingerprint, and which of them lie two bits away.
MASKS = (np.concatenate([np.zeros(1, dtype=np.uint64), _ONE, _TWO]), _ONE)
FAR = (np.concatenate([np.zeros(65, dtype=bool), np.ones(len(_TWO), dtype=bool)]), np.zeros(64, dtype=bool))


def _parity(x: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(x) & 1).astype(np.int64)


def _to_buckets(width: int):
    """(bucket, fps): the fingerprints of a batch that have variants in a bucket, as one value.

    A fingerprint goes to as many buckets as there are, or as it has variants, if that is less.
    """
    steps = [np.unique(linear_hash(m, width)) for m in MASKS]

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for parity in (0, 1):
                own, step = every[_parity(every) == parity], steps[parity]
                for k in range(0, len(own), max(1, 2_000_000 // len(step))):
                    x = own[k : k + max(1, 2_000_000 // len(step))]
                    bucket = (linear_hash(x, width)[:, None] ^ step[None, :]).ravel()
                    order = np.argsort(bucket)
                    ids, sizes = np.unique(bucket, return_counts=True)
                    offsets = np.append(0, np.cumsum(sizes) * 8).astype(np.int32)
                    data = np.repeat(x, len(step))[order]
                    packed = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays([pa.array(ids), packed], names=["bucket", "fps"])

    return task


def _meet(width: int):
    """The links between the fingerprints whose variants meet in a bucket."""
    grouped = []
    for masks, far in zip(MASKS, FAR):
        h = linear_hash(masks, width)
        grouped.append({int(v): (masks[h == v], far[h == v]) for v in np.unique(h)})

    def group(key: tuple, rows: pa.Table) -> pa.Table:
        every = np.unique(np.frombuffer(b"".join(rows.column("fps").to_pylist()), dtype=np.uint64))
        wanted, parity = key[0].as_py() ^ linear_hash(every, width), _parity(every)
        variants, owners, fars = [], [], []
        for p in (0, 1):
            for value, (masks, far) in grouped[p].items():
                own = np.flatnonzero((parity == p) & (wanted == value))
                if len(own):
                    variants.append((every[own][:, None] ^ masks[None, :]).ravel())
                    owners.append(np.repeat(own.astype(np.int32), len(masks)))
                    fars.append(np.tile(far, len(own)))
        if not variants:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        v, owner, far = np.concatenate(variants), np.concatenate(owners), np.concatenate(fars)
        order = np.argsort(v)
        s = v[order]
        same = s[1:] == s[:-1]
        shared = np.zeros(len(s), dtype=bool)
        shared[1:] |= same
        shared[:-1] |= same
        s, owner, far = s[shared], owner[order[shared]], far[order[shared]]
        first = np.ones(len(s), dtype=bool)
        first[1:] = s[1:] != s[:-1]
        starts = np.flatnonzero(first)
        if not len(starts):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        # The centre of a run is its least near member; a run of far members only has no link of its own.
        centre = np.minimum.reduceat(np.where(far, len(every), owner), starts)[np.cumsum(first) - 1]
        linked = (centre < len(every)) & (centre != owner)
        a, b = every[centre[linked]], every[owner[linked]]
        near = np.bitwise_count(a ^ b) <= DISTANCE
        pairs = np.unique(np.stack([a[near], b[near]], axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0].view(np.int64)), "b": pa.array(pairs[:, 1].view(np.int64))})

    return group


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``prints(fp)`` that keep every component whole."""
    n = prints.count()
    width = min(31, max(LEAST_WIDTH, int(n * MEAN_VARIANTS / BUCKET_VARIANTS).bit_length()))
    met = prints.select("fp").mapInArrow(_to_buckets(width), "bucket long, fps binary")
    return met.groupBy("bucket").applyInArrow(_meet(width), "a long, b long")


def simhash_groups(docs: DataFrame, member: Column, text: Column, shingle: int = SHINGLE) -> DataFrame:
    """(member, fp, least): each row's fingerprint and the least member of its group.

    ``member`` is any orderable column. A null text has no words; texts without words have
    fingerprint 0 and link like any other. Repeated rows stay rows. A null member never is
    the least one unless all of a group are null. An empty table gives an empty result.
    """
    given = docs.select(member.alias("member"), text.alias("text"))
    prints = stored(with_columns(given, [F.col("text")], [field("fp", "long")], _fingerprints(shingle), ["member"]), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("member").alias("least")), "nodes")
    linked = components(links(nodes))
    rooted = stored(nodes.join(linked, nodes.fp == linked.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"), "rooted")
    best = rooted.groupBy("root").agg(F.min("least").alias("least"))
    labels = rooted.select("fp", "root").join(best, "root").select("fp", "least")
    return prints.join(labels, "fp").select("member", "fp", "least")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable).

    Null and blank texts have fingerprint 0; see ``simhash_groups`` for the other cases.
    """
    found = simhash_groups(docs, named(id_column), named(text_column))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("member").alias(id_column), digits.alias("fingerprint"), F.col("least").alias("component_id"))


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with only the row of the smallest id of each near-duplicate group.

    Of rows with the same id one stays; a null id counts as larger than any other. The rows are
    numbered and written once, so that they are told apart alike by all that reads them.
    """
    row = free_name(docs, "row")
    placed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    id_ = named(id_column)
    kept = simhash_groups(placed, F.struct(id_.isNull().alias("n"), id_.alias("i"), named(row).alias("r")), named(text_column))
    kept = kept.where("member = least").select(F.col("member.r").alias(row))
    return placed.join(stored(kept, "kept"), row, "left_semi").drop(row)
