"""Periodic runs against a plain search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from shelfwise.llm import repeats

DOC = "doc_id long, text string, listed string, id long, K0 string, n_runs string"


def plain_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found)


def with_repetitions(rng, n, kinds):
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 8:
            a = rng.randrange(n)
            p, e = 1 + rng.randrange(1 + (n - a) // 4), rng.randrange(a, n)
            for i in range(a, e + 1):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(1500):
        words = with_repetitions(rng, rng.randrange(1, 100), rng.choice([1, 2, 3, 6, 40]))
        assert [tuple(r) for r in repeats.runs(np.array(words)).tolist()] == plain_runs(words)


@pytest.mark.parametrize("size", [1, 2, 8, 64, 1024])
def test_transform_finds_each_occurrence_and_nothing_else(size):
    rng = np.random.default_rng(size)
    for kinds in (1, 2, 5, 1 << 40):
        blocks, windows = rng.integers(0, kinds, (6, size)), rng.integers(0, kinds, (6, 2 * size - 1))
        windows[3, size // 2 : size // 2 + size] = blocks[3]
        got = repeats.zero_mismatches(blocks, windows)
        for r in range(6):
            assert got[r].tolist() == [blocks[r].tolist() == windows[r, d : d + size].tolist() for d in range(size)]


def test_large_blocks_use_as_many_primes_as_their_sums_need():
    rng = np.random.default_rng(2)
    blocks = rng.permutation(1 << 12)[None, :]
    window = np.concatenate([rng.permutation(1 << 12), rng.permutation(1 << 12)[1:]])[None, :]
    window[0, 1000 : 1000 + 4096] = blocks[0]
    assert np.flatnonzero(repeats.zero_mismatches(blocks, window)[0]).tolist() == [1000]


def test_texts_side_by_side_stay_apart():
    rng = random.Random(8)
    texts = [[str(w).encode() for w in with_repetitions(rng, rng.randrange(40), 2)] for _ in range(200)]
    texts += [[b"a"] * 6, [b"a"] * 6, [], [b"a"]]
    for words, found in zip(texts, repeats.runs_of_texts(texts)):
        assert [tuple(r) for r in found.tolist()] == plain_runs(words)


def test_long_texts_of_one_word_and_of_a_long_period():
    assert repeats.runs(np.zeros(100_000, dtype=np.int64)).tolist() == [[0, 100_000, 1]]
    assert repeats.runs(np.arange(100_000) % 20_011).tolist() == [[0, 100_000, 20_011]]


def planted(words, doc_id):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(re.findall(r"[^\x20\x09-\x0D]+", text or ""), doc_id)
    found = plain_runs(words)
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        digest("".join("%d,%d,%d\n" % r for r in found)), digest(" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


def test_query_equals_a_plain_version(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["é", "a", "b", "日本"]) for _ in range(rng.randrange(120))) for _ in range(150)]
    texts += [None, "", " \n", "a " * 7, "x y " * 9 + "z " * 30, "q" * 20_000, "a\u00a0a " * 8]
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(k, t, "l", 5, "k", "n") for k, t in rows], DOC)
    got = repeats.run_digests(df.repartition(5)).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected(*r) for r in rows)


def test_operator_gives_the_runs_and_the_texts(spark, rows):
    df = spark.createDataFrame([(1, "go " * 8 + "now", "", 0, "", ""), (1, "go " * 8 + "now", "", 0, "", ""), (None, None, "", 0, "", "")], DOC)
    got = rows(repeats.periodic_runs(df), "doc_id")
    assert got == [(None, 0, 0, None, None, None, None, "", ""), *[(1, 9, 1, 0, 8, 1, 8000, "0,8,1\n", "go now")] * 2]
    assert repeats.run_digests(df.where("false")).collect() == []
