"""Context-tree scores against the recursive definition of context-tree weighting."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from shelfwise.llm import scoring
from shelfwise.session import run_folder
from shelfwise.sources.folders import folder_names

DOC = "doc_id long, text string, score double, Slice long, body string"
EDGE = b"\xff"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 1


def decisions(text, depth):
    """(decision, contexts from the empty one to the longest, bit) of every bit of a text and its end."""
    data = EDGE * depth + text.lower() + EDGE
    for k in range(depth, len(data)):
        contexts = [data[k - d : k] for d in range(depth + 1)]
        for level in range(8):
            yield (level, data[k] >> (8 - level)), contexts, (data[k] >> (7 - level)) & 1


def kt(zeros, ones):
    half = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - 2 * math.lgamma(0.5)
    return half - math.lgamma(zeros + ones + 1)


class Weighted:
    """Sequence probabilities of all nodes: half the node's own estimate, half the product of its children's."""

    def __init__(self, training, depth):
        self.depth = depth
        self.seen = defaultdict(lambda: [0, 0])
        for text in training:
            for decision, contexts, bit in decisions(text, depth):
                for context in contexts:
                    self.seen[decision, context][bit] += 1
        self.below, self.whole = defaultdict(float), {}
        for key in sorted(self.seen, key=lambda key: -len(key[1])):
            decision, context = key
            self.whole[key] = self.mixed(key, self.seen[key], self.below[key])
            if context:
                self.below[decision, context[1:]] += self.whole[key]

    def mixed(self, key, counts, below):
        own = kt(*counts)
        return own if len(key[1]) == self.depth else np.logaddexp(own, below) - math.log(2)

    def log10(self, text):
        """What the tree gives to each bit after the training: the probability with it over the one without."""
        total = 0.0
        for decision, contexts, bit in decisions(text, self.depth):
            new = gain = 0.0
            for context in reversed(contexts):
                key = (decision, context)
                counts = list(self.seen.get(key, (0, 0)))
                counts[bit] += 1
                new = self.mixed(key, counts, self.below.get(key, 0.0) + gain)
                gain = new - self.whole.get(key, 0.0)
            total += gain
        return total / math.log(10)


def check(spark, texts):
    rows = [(k, t, 1.0, 7, "b") for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in scoring.language_scores(spark.createDataFrame(rows, DOC).repartition(3)).collect()}
    raw = [(t or "").encode() for t in texts]
    tree = Weighted([t for k, t in enumerate(raw) if not held_out(k)], scoring.DEPTH)
    for k, text in enumerate(raw):
        assert got[k].held_out == held_out(k)
        assert got[k].score == pytest.approx(tree.log10(text), rel=1e-5)
        assert got[k].bits_per_byte == pytest.approx(-got[k].score / math.log10(2) / (len(text) + 1))
    return raw


def test_scores_equal_the_definition_on_small_tables(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAB é") for _ in range(rng.randrange(60))) for _ in range(25)]
    check(spark, texts + [None, "", "zzz", "日本 日本", "a" * 700, "a" * 700, "abab" * 100 + "c"])


def test_scores_equal_the_definition_above_65536_training_bytes(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(20, 300))) for _ in range(110)]
    raw = check(spark, texts)
    assert sum(len(t) for k, t in enumerate(raw) if not held_out(k)) > 1 << 16


def test_buckets_and_slices_do_not_change_scores(spark, monkeypatch):
    rng = random.Random(3)
    texts = [(k, " ".join(rng.choice(["one", "two", "three", "för"]) for _ in range(rng.randrange(80))), 1.0, 1, "") for k in range(60)]
    df = spark.createDataFrame(texts, DOC)
    scores = lambda: {r.doc_id: r.score for r in scoring.language_scores(df).collect()}
    want = scores()
    monkeypatch.setattr(scoring, "BUCKET", 500)
    got = scores()
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)


def test_ids_of_other_types_and_repeats(spark):
    rows = [("a/1", "some text"), ("a/1", "some text"), (None, "other"), ("b", None)]
    got = scoring.language_scores(spark.createDataFrame(rows, "id string, words string"), "id", "words").collect()
    assert sorted((r.id or "", r.n_tokens) for r in got) == [("", 2), ("a/1", 3), ("a/1", 3), ("b", 1)]
    assert len({r.score for r in got if r.id == "a/1"}) == 1


def test_tiers_sum_probabilities_to_one():
    """The eight decisions of all bytes after one context are a distribution."""
    context = np.uint64(0x616263646566)
    codes = (np.repeat(context, 256) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    n = np.zeros(256, dtype=np.int64)
    n[[97, 98, 99]] = 5, 1, 1000
    leaf = scoring.Tier(codes, n)
    middle = scoring.Tier(leaf.top.code, leaf.top.n, leaf.climbed())
    root = scoring.Tier(middle.top.code, middle.top.n, middle.climbed(), root=True)
    logs = leaf.logs(*middle.descended(*root.descended()))
    assert (10.0**logs).sum() == pytest.approx(1, abs=1e-12) and logs.argmax() == 99


def test_windows_hold_every_symbol_once(monkeypatch):
    rng = random.Random(4)
    texts = [bytes(rng.randrange(97, 101) for _ in range(rng.choice([0, 3, 40, 700]))) for _ in range(40)] + [None]
    plain = []
    for text in texts:
        data = EDGE * scoring.DEPTH + (text or b"") + EDGE
        for k in range(scoring.DEPTH, len(data)):
            plain.append(int.from_bytes(bytes([*data[k - scoring.DEPTH : k][::-1], data[k]]), "big"))
    for size in (16, 100, 1 << 20):
        monkeypatch.setattr(scoring, "WINDOW", size)
        windows = list(scoring.Laid(texts).windows(0, len(texts)))
        assert np.concatenate([code for *_, code in windows]).tolist() == plain
        assert [w[0] for w in windows] == sorted(w[0] for w in windows)
        every, n = scoring._distinct_pairs(texts, len(texts))
        assert dict(zip(every.tolist(), n.tolist())) == {c: plain.count(c) for c in set(plain)}
        half = scoring._distinct_pairs(texts, 10)
        assert half[0].tolist() == every.tolist() and half[1].sum() == sum(len(t or b"") + 1 for t in texts[:10])


def test_only_scores_and_tokens_stay_in_the_shared_folder(spark):
    """Slices, pairs, answers and the tree are as large as the texts several times over."""
    rows = [(k, f"text {k} of some words", 1.0, 1, "") for k in range(20)]
    with run_folder(spark) as path:
        scored = scoring.language_scores(spark.createDataFrame(rows, DOC))
        assert sorted(name.split("-")[0] for name in folder_names(spark, path, "")) == ["scored", "tokens"]
        assert scored.count() == 20


def test_slices_of_several_parts_and_windows_score_alike(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["one", "two", "för", "four"]) for _ in range(rng.randrange(60))) for _ in range(50)] + [None]
    df = spark.createDataFrame([(k, t, 1.0, 1, "") for k, t in enumerate(texts)], DOC).coalesce(1)
    every = lambda: {r.doc_id: r for r in scoring.language_scores(df).collect()}
    want = every()
    monkeypatch.setattr(scoring, "WINDOW", 300)
    monkeypatch.setattr(scoring, "PART", 200)
    monkeypatch.setattr(scoring, "FREQUENT", 2)  # most tokens by the join
    got = every()
    seen = Counter(t for k, text in enumerate(texts) if not held_out(k) for t in scoring.tokens_of((text or "").encode()))
    for k, text in enumerate(texts):
        tokens = scoring.tokens_of((text or "").encode())
        base = sum(math.log10((seen[t] + 0.5) / (seen.total() + 0.5 * (len(seen) + 1))) for t in tokens)
        for r in (want[k], got[k]):
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(t in seen for t in tokens), seen.total())
            assert r.base_score == pytest.approx(base)
        assert got[k].score == pytest.approx(want[k].score, rel=1e-6)


def test_answers_come_back_as_they_were():
    values = np.array([-3.25, -1e-30, 0.0, -7.123456], dtype=np.float32)
    part = scoring.unpacked(scoring.packed(**scoring._bytes_of("log", values)))
    assert scoring._of_bytes(part, "log").tolist() == values.tolist()
    none = scoring.unpacked(scoring.packed(**scoring._bytes_of("log", values[:0])))
    assert len(scoring._of_bytes(none, "log")) == 0
