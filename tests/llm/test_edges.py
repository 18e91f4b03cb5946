"""Cases at the edges of the text operators, and their methods against plain versions."""

import hashlib
import math
import random
import re
import struct
import time
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
import xxhash
from shelfwise.llm import boilerplate, chat, decontamination, pieces, pipeline, quality, secrets, toxicity, wordpiece
from test_documents import MODEL, brute_components, brute_contamination, documents, plain_fingerprint

WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- 7: secrets ------------------------------------------------------------------------


def test_many_matches_in_one_text_take_linear_time(spark):
    spans = {}
    for n in (20_000, 200_000):
        df = spark.createDataFrame([(1, "0123456789abcdef " * n, "s")], "doc_id long, text string, source string")
        start = time.time()
        row = secrets.secret_scan(df).first()
        spans[n] = time.time() - start
        assert row.n_hex == n and row.spans.endswith(f"hex:{17 * (n - 1)}:{17 * n - 1}")
    assert spans[200_000] < 20 and spans[200_000] < 20 * max(1, spans[20_000])


def test_spans_across_runs_of_matches(spark):
    rng = random.Random(4)
    text = "".join("é" * rng.randrange(3) + "-" + "0123456789abcdef" * rng.randrange(1, 3) + "-" for _ in range(1000))
    row = secrets.secret_scan(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).first()
    want = [f"hex:{m.start()}:{m.end()}" for m in re.finditer("[0-9a-f]{16,}", text)]
    assert [s for s in row.spans.split(",") if s.startswith("hex")] == want


def test_a_value_that_all_documents_hold_can_be_split(spark):
    df = spark.createDataFrame([(k, "token=abcdefghijklmnop", f"o{k}") for k in range(50)], "doc_id long, text string, source string")
    text = secrets.secret_scan(df)._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") >= 1 and "Python" not in text and "Arrow" not in text


# --- 6: SentencePiece ------------------------------------------------------------------


def test_any_bytes_are_encoded_as_the_library_does():
    with open(MODEL, "rb") as f:
        data = f.read()
    model, library = pieces.Model(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(5)
    given = [b"a\xff\xfeb", b"\xf0\x9f\x98", b"\xed\xa0\x80", b"\xc0\xaf", b"\xe6\x97", b"x\x80", b"\xf4\x90\x80\x80"]
    parts = [b"word ", "日本".encode(), "😀".encode(), b"\xff", b"\x80", b"\xe6", b"\xf0\x9f", b" ", b"\n"]
    given += [b"".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    given += [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    for source in given:
        ids, begins, ends = model.encode(source)
        assert ids == library.encode(source)
        assert (begins <= ends).all() and (ends <= len(source)).all()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "identity"])
def test_malformed_bytes_are_replaced_one_by_one(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = dict(pieces._fields(dict(pieces._fields(library.serialized_model_proto()))[3]))
    model = object.__new__(pieces.Model)
    model.map, model.trim, model.dummy, model.escape = pieces.CharacterMap(spec.get(2, b"")), False, False, False
    for source, text in ((b"a\xff\xfeb", "a\ufffd\ufffdb"), (b"\xf0\x9f\x98", "\ufffd" * 3), (b"\xe6\x97x", "\ufffd\ufffdx")):
        got = model.normalise(source)
        assert got.text == text and len(got.starts) == len(text) + 1 and got.starts[-1] == len(source)


# --- 9: chat ---------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,0)"])
def test_conversation_ids_of_any_type(spark, kind):
    rows = [(k % 7, k // 7, ("user", "assistant")[k // 7 % 2], "hi" if k % 3 else "ho") for k in range(28)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(f"cast(conv_id as {kind}) conv_id", "turn", "role", "text")
    read = chat.read_back(chat.pack(given))
    assert read.schema["conv_id"].dataType == given.schema["conv_id"].dataType
    assert sorted(int(r.conv_id) for r in read.collect()) == list(range(7))


def test_token_positions_and_attention_equal_a_mask(spark):
    def letters():
        return lambda text: [ord(text[k]) * 1000 + len(text[k : k + 2]) for k in range(0, len(text), 2)]

    rng = random.Random(9)
    rows = []
    for conv in range(30):
        for turn in range(rng.randrange(1, 8)):
            rows.append((f"c{conv:02}", turn, ("user", "assistant")[turn % 2], rng.choice(["x", "yes no", "### z"]) if turn > conv % 4 else f"same {turn}"))
    given = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    cut, packs = letters(), defaultdict(list)
    for r in sorted(chat.pack(given.coalesce(1), letters).collect(), key=lambda r: (r.pack, r.at)):
        packs[r.pack].append(r)
    convs, nodes = defaultdict(list), 0
    for conv, _, role, text in sorted(rows):
        formatted, a, b = chat.format_turn(role, text)
        segments = [cut(formatted[:a]), cut(formatted[a:b]), cut(formatted[b:])]
        convs[conv].append((sum(segments, []), [False] * len(segments[0]) + [True] * len(segments[1]) + [False] * len(segments[2])))
    for rows_ in packs.values():
        tokens, positions, learned, may = [], [], [], []
        for r in rows_:
            if r.formatted is None:
                continue
            nodes += 1
            assert r.start == len(tokens)
            for k, token in enumerate(r.tokens):
                may.append({i for x in r.attends for i in range(x.start, x.end)} | set(range(r.start, r.start + k + 1)))
                tokens.append(token)
                positions.append(r.position + k)
                learned.append(r.loss_first <= k < r.loss_last)
        for r in rows_:
            if r.formatted is None:
                own = [i for x in r.attends for i in range(x.start, x.end)]
                want = convs.pop(r.conv_id)
                assert [tokens[i] for i in own] == sum((t for t, _ in want), [])
                assert [learned[i] for i in own] == sum((m for _, m in want), [])
                # every token of the conversation sees exactly the conversation up to itself
                assert all(may[i] == set(own[: k + 1]) and positions[i] == k for k, i in enumerate(own))
    assert not convs and nodes < len(rows)


# --- 10: toxicity ----------------------------------------------------------------------


def plain_features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()
    words = [xxhash.xxh64_intdigest(w) for w in re.findall(rb"[0-9a-z\x80-\xff]+", lower)]
    one, two, skip, left = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
    found = [w * one for w in words]
    found += [(a * left + b) * two for a, b in zip(words, words[1:])] + [(a * left + b) * skip for a, b in zip(words, words[2:])]
    return {f % (1 << 64) >> 44 for f in found}


def plain_scores(docs, labels):
    """FTRL-proximal over dictionaries, for one row a document id."""
    said = defaultdict(list)
    for doc_id, toxic in labels:
        if doc_id is not None and toxic is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            said[doc_id].append(toxic)
    order = sorted((struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(str(i).encode(), 42)))[0], i) for i in said)
    z, n, texts = defaultdict(float), defaultdict(float), dict(docs)
    weigh = lambda z, n, l1: 0.0 if abs(z) <= l1 else (math.copysign(l1, z) - z) / ((toxicity.BETA + math.sqrt(n)) / toxicity.ALPHA + toxicity.L2)
    chance = lambda x, l1: 1 / (1 + math.exp(-max(-35, min(35, sum(weigh(z[f], n[f], l1) for f in x) + weigh(z[-1], n[-1], 0)))))
    for _ in range(toxicity.PASSES):
        for _, i in order:
            if i not in texts:
                continue
            x = plain_features(texts[i])
            g = chance(x, toxicity.L1) - (max(said[i]) > 0)
            for f in [*x, -1]:
                w = weigh(z[f], n[f], 0 if f == -1 else toxicity.L1)
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / toxicity.ALPHA * w
                n[f] += g * g
    return {i: chance(plain_features(t), toxicity.L1) for i, t in docs}


def toxic_rows(n=160, seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    docs, labels = [], []
    for k in range(n):
        own = [rng.choice(words) for _ in range(60)]
        if k % 4 == 0:
            own[5] = own[30] = rng.choice(["Idiot", "scum"])
        docs.append((k, " ".join(own)))
        labels.append((k, int(k % 4 == 0)))
    return docs, labels


def test_scores_equal_plain_ftrl(spark):
    docs, labels = toxic_rows()
    docs += [(500, None), (501, ""), (502, "idiot " * 3)]
    want = plain_scores(docs, labels)
    given = spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(documents(spark, [t for _, t in docs], [i for i, _ in docs]), given).collect()
    assert {r.doc_id: pytest.approx(r.score, abs=1e-9) for r in got} == want


def test_the_sample_bounds_rows_and_not_ids_only(spark, monkeypatch):
    docs = documents(spark, ["good text", "bad text"] * 300, [1, 3] * 300)
    labels = spark.createDataFrame([(1, 0), (3, 1), (4, 1)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "with_columns", lambda df, *args: seen.append(df.count()) or _stop())
    with pytest.raises(StopIteration):
        toxicity.learn(docs, labels, sample=3)
    assert seen == [2]


def _stop():
    raise StopIteration


def test_a_text_teaches_a_bounded_number_of_features(monkeypatch):
    monkeypatch.setattr(toxicity, "TAUGHT", 10)
    every = np.arange(1000)
    got = toxicity._taught(every)
    assert len(got) == 10 and set(got) <= set(every) and (np.diff(got) > 0).all()
    assert toxicity._taught(every[:10]) is not None and len(toxicity._taught(every[:7])) == 7


# --- 5: quality ------------------------------------------------------------------------


def plain_class(c):
    if c in "\n\r":
        return "line"
    if c in " \t\v\f":
        return "space"
    if c in "#*$%&|<>":
        return "symbol"
    kind = unicodedata.category(c)
    names = {"Ll": "lower", "Lu": "upper", "Lt": "upper", "Lo": "letter", "Lm": "letter"}
    return names.get(kind) or {"M": "mark", "N": "digit", "Z": "space", "P": "stop", "S": "symbol"}.get(kind[0], "other")


def plain_distance(p, q):
    if not p or not q:
        return 0.0
    a, b = sum(p.values()), sum(q.values())
    total = 0.0
    for k in p.keys() | q.keys():
        x, y = p[k] / a, q[k] / b
        m = (x + y) / 2
        total += (x * math.log2(x / m) if x else 0) + (y * math.log2(y / m) if y else 0)
    return math.sqrt(max(0.0, total / 2))


def plain_quality(rows):
    classes, words = defaultdict(Counter), defaultdict(Counter)
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    for lang, text in rows:
        classes[lang or ""].update(map(plain_class, text or ""))
        words[lang or ""].update(split(lower(text or "")))
    out = []
    for lang, text in rows:
        lang, text = lang or "", text or ""
        total = sum(words[lang].values())
        common = {w for w, n in words[lang].items() if n >= total / 1000}
        fold = lambda counts: Counter({k: sum(n for w, n in counts.items() if (w if w in common else None) == k) for k in [*common, None]})
        by_class = plain_distance(Counter(map(plain_class, text)), classes[lang]) if total >= 2000 and len(text) >= 200 else 0.0
        by_word = plain_distance(fold(Counter(split(lower(text)))), fold(words[lang])) if total >= 2000 and len(split(text)) >= 100 else 0.0
        out.append((by_class, by_word))
    return out


@pytest.mark.parametrize("sent_bytes", [64 << 20, 0])
def test_distances_equal_plain_ones(spark, sent_bytes):
    rng = random.Random(2)
    latin = [f"wört{k}" for k in range(30)]
    han = ["的", "是", "不", "我們", "。", "，", "Word", "７"]
    rows = [("de", " ".join(rng.choice(latin[: rng.randrange(2, 30)]) for _ in range(rng.randrange(60, 160)))) for _ in range(30)]
    rows += [("zh", " ".join(rng.choice(han[: rng.randrange(2, 8)]) for _ in range(rng.randrange(60, 160)))) for _ in range(30)]
    rows += [("de", "12 34 #" * 80), ("zh", "plain words " * 70), ("xx", "too few words"), (None, None), ("de", None), ("zh", "字" * 199)]
    df = spark.createDataFrame([(k, t, lang, 1.0) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n_words double")
    got = {r.doc_id: r for r in quality.quality(df, sent_bytes=sent_bytes).collect()}
    for k, (by_class, by_word) in enumerate(plain_quality(rows)):
        assert (got[k].class_distance, got[k].word_distance) == (pytest.approx(by_class, abs=1e-9), pytest.approx(by_word, abs=1e-9))
        assert got[k].kept == (not got[k].base_failed and by_class <= quality.CLASS_DISTANCE and by_word <= quality.WORD_DISTANCE)
    assert any(r.class_distance > quality.CLASS_DISTANCE for r in got.values())


# --- 2: token counts -------------------------------------------------------------------


def test_token_counts_like_greedy_cutting(spark):
    with open(WORDS, "rb") as f:
        vocabulary = {bytes(p) if isinstance(p, bytes) else tuple(p) for p in wordpiece.load_vocabulary(f.read())}

    def cut(word):
        symbols, n = (*word.encode(), wordpiece.END), 0
        while symbols:
            size = next((k for k in range(len(symbols), 0, -1) if symbols[:k] in vocabulary), None)
            if size is None:
                return 1
            symbols, n = symbols[size:], n + 1
        return n

    rng = random.Random(7)
    texts = [None, "", "  ", "Hello, WORLD!! don't", "cafe\u0301 ＡＢＣ 12345", "日本語 😀", "x" * 500]
    texts += [" ".join("".join(rng.choice("abcdefghé'1,") for _ in range(rng.randrange(1, 14))) for _ in range(20)) for _ in range(40)]
    for r in wordpiece.token_counts(documents(spark, texts), WORDS).collect():
        words = regex.findall(wordpiece.WORD, unicodedata.normalize("NFC", texts[r.doc_id] or "").lower())
        assert (r.n_words, r.n_tokens) == (len(words), sum(map(cut, words)))


# --- the pipeline ----------------------------------------------------------------------


def plain_pipeline(docs, labels, items):
    scores = plain_scores([(i, t) for i, t, _ in docs], labels)
    docs = [d for d in docs if scores[d[0]] < toxicity.THRESHOLD]
    pages, holders = Counter(s for _, _, s in docs), Counter()
    for _, text, source in docs:
        holders.update({(source, line.strip()) for line in (text or "").split("\n") if line.strip()})
    gone = {k for k, n in holders.items() if pages[k[0]] >= boilerplate.LEAST_PAGES and n > boilerplate.RATIO * pages[k[0]]}
    kept = lambda t, s: None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip()) not in gone)
    docs = sorted((i, kept(t, s)) for i, t, s in docs)
    roots = brute_components([plain_fingerprint(t) for _, t in docs])
    docs = [d for k, d in enumerate(docs) if roots[k] == k]
    found = brute_contamination([t for _, t in docs], items, decontamination.WINDOW)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = {}
    for (i, text), (*_, contaminated) in zip(docs, found):
        if not contaminated:
            ids = library.encode(text or "")
            out[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    return out


def test_pipeline_equals_its_plain_version(spark, tmp_path):
    rng = random.Random(15)
    docs, labels = toxic_rows(200, 8)
    items = [(k, " ".join(f"bench{k}x{j}" for j in range(20))) for k in range(3)]
    rows = []
    for k, (i, text) in enumerate(docs):
        source = "big" if k % 2 else f"small{k % 5}"
        text = f"{text}\nread more\nend {i} {rng.random()}" if k % 2 else text
        rows.append((i, f"{text}\n{items[k % 3][1]}" if k % 11 == 1 else text, source))
    rows += [(900 + k, rows[k][1], rows[k][2]) for k in range(0, 60, 7)] + [(990, None, "big"), (991, "", None), (992, "short", "big")]
    made = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    made.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = pipeline.run(spark, str(tmp_path)).collect()
    want = plain_pipeline([(i, t, s or "") for i, t, s in rows], labels, items)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert 60 < len(want) < 190


def test_pipeline_stages_keep_their_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, Row long"
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "some item text")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, "a b c", "en", "s", 5, 1.0, 1), (1, "a b c", "en", "s", 5, 1.0, 1), (None, None, None, None, None, None, None)]
    for given in (rows, []):
        spark.createDataFrame(given, schema).write.mode("overwrite").parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == (docs.columns if name != "sentencepiece" else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"])
            assert out.count() <= len(given)


def test_new_columns_cannot_take_a_name(spark):
    docs = documents(spark, ["a"])
    with pytest.raises(ValueError, match="text"):
        boilerplate.drop_boilerplate(docs, docs.source, docs.text)
