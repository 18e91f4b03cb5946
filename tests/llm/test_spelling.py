"""Spelling variants against a comparison of all words with all words."""

import random
import re
import zlib
from collections import Counter

from shelfwise.llm import spelling

DOC = "doc_id long, text string, word string, N long, form string, key string"


def plain_words(rows, planted=True):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 5 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, near, form_n))
    return sorted(rows)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "f", "k") for i, t in rows], DOC)


def check(spark, rows, **options):
    got = spelling.spelling_variants(frame(spark, rows).repartition(3), planted=True, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == plain_variants(plain_words(rows))


def test_repeated_letters_and_every_kind_of_edit(spark):
    words = ["aabbaa", "aaabbaa", "abbaaa", "aabbaaa", "aaaaaaa", "aaaaaa", "straße", "strasse", "strase", "ÀÉÎõü×", "àéîõü×", "letter", "lettre"]
    text = " ".join(w for k, w in enumerate(words) for _ in range(5 * (k + 1)))
    check(spark, [(1, text), (2, text.upper()), (None, text), (None, None), (3, ""), (3, "x" * 10_000)])


def test_random_words(spark):
    rng = random.Random(6)
    rows = []
    for doc in range(40):
        words = ["".join(rng.choice("aaeé") for _ in range(rng.randrange(5, 9))) for _ in range(400)]
        rows.append((doc, rng.choice([" ", "-", "1"]).join(words)))
    check(spark, rows)


def test_forms_are_followed_to_the_last(spark):
    chain = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125}
    text = " ".join(w for w, n in chain.items() for _ in range(n))
    got = {r.word: r.root for r in spelling.spelling_variants(frame(spark, [(1, text)])).collect()}
    assert got == dict.fromkeys(chain, "abjihg")


def test_a_document_repeated_many_times_and_empty_tables(spark):
    rows = [(7, "common commin")] * 300 + [(8, "common")] * 1300
    check(spark, rows)
    assert spelling.spelling_variants(frame(spark, [])).collect() == []
    assert spelling.spelling_variants(frame(spark, [(1, None)])).collect() == []


def test_a_pair_meets_in_one_range_only():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(6, 10))) for _ in range(200)})
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(words), pa.array([1] * len(words), pa.int64())], names=["word", "n"])
    table = pa.Table.from_batches(list(spelling._rotations(iter([batch])))).sort_by("key")
    found = Counter()
    for part in spelling._scanned(iter(table.to_batches())):
        for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            found[word] += n
    assert found == Counter({w: n for w in words if (n := sum(one_edit(w, v) for v in words))})
