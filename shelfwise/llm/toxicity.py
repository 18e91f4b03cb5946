"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import crc_fold, field, free_name, id_text, named, with_columns

WIDTH = 20
#: Labelled ids that teach, and the most features of a text that do.
SAMPLE, TAUGHT = 12_000, 1 << 17
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: FTRL-proximal: learning rate, its smoothing, L1, L2, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 6.0, 0.0, 6
#: Odd multipliers that tell unigrams, bigrams and one-word skips apart.
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_KEEP_WORDS = 1 << 18

_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class WordHashes(dict):
    """64-bit hashes of words, remembered for as many words as stay in bounds."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEEP_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def features(texts: Iterable[bytes | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the unigrams, bigrams and one-word skip-grams of texts, with repeats."""
    sizes, words = [], []
    for text in texts:
        own = (text or b"").translate(_TO_WORDS).split()
        sizes.append(len(own))
        words.append(np.fromiter(map(hashes.__getitem__, own), dtype=np.uint64, count=len(own)))
    h = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    found = [(row, h * _MIX[0])]
    for gap, mix in ((1, _MIX[1]), (2, _MIX[2])):
        same = row[gap:] == row[:-gap]
        found.append((row[gap:][same], ((h[:-gap] * _MIX[3] + h[gap:]) * mix)[same]))
    return np.concatenate([r for r, _ in found]), (np.concatenate([f for _, f in found]) >> np.uint64(64 - WIDTH)).astype(np.int64)


def _distinct(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort((row << WIDTH) | feature)
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key >> WIDTH, key & ((1 << WIDTH) - 1)


def _split(row: np.ndarray, feature: np.ndarray, n: int) -> list[np.ndarray]:
    return np.split(feature, np.searchsorted(row, np.arange(1, n)))


def _taught(feature: np.ndarray) -> np.ndarray:
    """The distinct features of a text, or ``TAUGHT`` of them in the order of a hash."""
    if len(feature) <= TAUGHT:
        return feature
    order = np.argsort(feature.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), kind="stable")
    return np.sort(feature[order[:TAUGHT]])


def _featurised():
    hashes = WordHashes()

    def rows(texts):
        row, feature = _distinct(*features(texts, hashes))
        return [[_taught(x).astype(np.int32) for x in _split(row, feature, len(texts))]]

    return rows


def ftrl(examples: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias from (features, label) in their order, PASSES times over.

    Each coordinate has its own rate, from the sum of its squared gradients; a weight stays
    at zero until its summed gradient exceeds L1. The bias is neither shrunk nor cut.
    """
    z, n = np.zeros(1 << WIDTH), np.zeros(1 << WIDTH)
    bias_z = bias_n = 0.0

    def weights(zs, ns):
        shrunk = np.sign(zs) * L1 - zs
        return np.where(np.abs(zs) <= L1, 0.0, shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(PASSES):
        for x, y in examples:
            zs, ns = z[x], n[x]
            w = weights(zs, ns)
            bias = -bias_z / ((BETA + bias_n**0.5) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - y
            rate = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[x] = zs + g - rate * w
            n[x] = ns + g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / ALPHA * bias
            bias_n += g * g
    return weights(z, n), -bias_z / ((BETA + bias_n**0.5) / ALPHA)


def _fit(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("at", "ascending"), ("id", "ascending"), ("label", "ascending")])
    flat = rows.column("features").combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    offsets, values = flat.offsets.to_numpy(), flat.values.to_numpy()
    labels = rows.column("label").to_pylist()
    w, bias = ftrl([(values[offsets[i] : offsets[i + 1]], y) for i, y in enumerate(labels)])
    used = np.flatnonzero(w)
    return pa.table({"feature": np.append(used, -1).astype(np.int64), "weight": np.append(w[used], bias)})


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(feature, weight) with the bias as feature -1, from labelled rows outside the held-out fold.

    At most ``sample`` labelled ids are used, the first in the order of a hash of the id, and
    one text of each, the first by its hash, so that one task can take them in turn. A text
    teaches up to ``TAUGHT`` features. An id labelled twice is toxic if any of its
    labels says so; a null label or id teaches nothing. Without examples the result is empty.
    """
    given = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_fold(F.col("doc_id"), folds) != held_out))
        .groupBy(F.col("doc_id").alias("id"))
        .agg((F.max("toxic") > 0).cast("int").alias("label"))
        .withColumn("at", F.xxhash64(id_text(F.col("id"))))
        .orderBy("at", "id")
        .limit(sample)
    )
    texts = docs.select(named("doc_id").alias("id"), named("text").alias("text"))
    taught = texts.join(F.broadcast(given), "id")  # ``sample`` ids at most, but each may stand in many rows
    first = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text")))
    taught = taught.groupBy("id", "at", "label").agg(first.alias("first")).select("id", "at", "label", F.col("first.text").alias("text"))
    made = with_columns(taught, [F.col("text")], [field("features", "array<int>")], _featurised, ["id", "at", "label"])
    return made.withColumn("model", F.lit(1)).groupBy("model").applyInArrow(_fit, "feature long, weight double")


def weights_of(model: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """The non-zero weights: 2 ** WIDTH at most, whatever the size of the corpus."""
    rows = model.toArrow().to_pandas().sort_values("feature")
    bias = rows.weight[rows.feature == -1].sum()
    rows = rows[rows.feature >= 0]
    return rows.feature.to_numpy(), rows.weight.to_numpy(), float(bias)


def scored(docs: DataFrame, model: DataFrame, score: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the probability that a text is toxic; a null text counts as empty."""
    at, weight, bias = weights_of(model)
    shared = docs.sparkSession.sparkContext.broadcast((at.astype(np.int64), weight, bias))

    def make():
        at, weight, bias = shared.value
        dense = np.zeros(1 << WIDTH)
        dense[at] = weight
        used = dense != 0
        hashes = WordHashes()

        def rows(texts):
            row, feature = features(texts, hashes)
            hit = used[feature]
            row, feature = _distinct(row[hit], feature[hit])
            total = np.bincount(row, weights=dense[feature], minlength=len(texts)) + bias
            return [1 / (1 + np.exp(-np.clip(total, -35, 35)))]

        return rows

    return with_columns(docs, [named("text")], [field(score, "double")], make, keep)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted: one row for every row of ``docs``.

    Empty and null texts get the score of the bias alone. Null ids count as the empty text
    in the folds. Without any label every score is 0.5.
    """
    out = scored(docs.select("doc_id", "text"), learn(docs, labels), "score", ["doc_id"])
    return out.select(
        "doc_id",
        (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold, whatever other columns there are."""
    score = free_name(docs, "score")
    return scored(docs, learn(docs, labels), score).where(F.col(score) < threshold).drop(score)
