"""URL filters: rules by hand, and scores against a plain model of the same characters."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from shelfwise.llm import urls
from shelfwise.llm.oracle import URL_FILTERS
from shelfwise.llm.queries import URL_RULES

PAGE = "page_id long, url string, html string, text string, score string, U long"
EDGE = "\x01"


def pages(spark, given):
    return spark.createDataFrame([(k, u, "h", "t", "s", 1) for k, u in enumerate(given)], PAGE)


def verdicts(spark, given, rules=URL_RULES):
    return {r.page_id: r for r in urls.url_verdicts(pages(spark, given), rules).collect()}


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://a.NET/x", "a.net", "/x", "net/", "block"),
        ("http://a.net", "a.net", "", None, None),
        ("http://net/", "net", "/", "net/", "block"),
        ("http://notnet/", "notnet", "/", None, None),
        ("https://w.Example.net/en/1?q=/en/", "w.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://w.example.net/EN/1", "w.example.net", "/EN/1", "net/", "block"),
        ("https://badexample.net/en/1", "badexample.net", "/en/1", "net/", "block"),
        ("//://m.example.com/de/#top", "m.example.com", "/de/", "example.com/de/", "block"),
        ("http://x.org/fr/a://y.net/", "x.org", "/fr/a://y.net/", "org/fr/", "allow"),
        ("http://É.org?/fr/", "É.org", "", None, None),
        ("x.net/", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("http://a\n.net/\n?", "a\n.net", "/\n", "net/", "block"),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule, verdict):
    got = verdicts(spark, [url])[0]
    assert (got.host, got.path, got.rule) == (host, path, rule)
    assert got.verdict == (verdict or "allow") and got.score == (None if verdict else 0.0)


def test_longest_rule_wins_and_equals_are_settled(spark):
    rules = [("allow", "b.c", "/"), ("block", "a.b.c", ""), ("allow", "c", "/xyz"), ("block", "c", "/xy")]
    got = verdicts(spark, ["h://a.b.c/xyz", "h://b.c/xyzz", "h://b.c/x", "h://c/xy"], rules)
    assert [(got[k].rule, got[k].verdict) for k in range(4)] == [("a.b.c", "block"), ("c/xyz", "allow"), ("b.c/", "allow"), ("c/xy", "block")]


def some_urls(n, seed=2):
    rng = random.Random(seed)
    name = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(3, 7)))
    made = []
    for _ in range(n):
        top = rng.choice(["net", "example.net", "example.com", "org", "com", "org"])
        made.append(f"{rng.choice(['http', 'https'])}://{name()}.{top}/{rng.choice(['en', 'de', 'fr'])}/{name()}{rng.choice(['', '?x=1', '#t', '/'])}")
    return made + ["x.net/en/", "HTTP://😀.com/日本", "", None, *made[:20], "http://a.com/" + "long/" * 4000]


def plain_scores(given):
    """What the module's text says, with dictionaries."""
    texts = defaultdict(set)
    for url in given:
        url = url or ""
        rest = url.partition("://")[2]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].partition("#")[0].partition("?")[0]
        fits = [(len(h + p), v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        texts[host + rest[cut:] if "://" in url else url].add(max(fits)[1] if fits else None)
    held = lambda t: zlib.crc32(t.encode()) % 5 == 0
    counts, totals, kinds = {}, {}, {}
    for side in ("allow", "block"):
        counts[side], totals[side], kinds[side] = Counter(), Counter(), Counter()
        for text, said in texts.items():
            if side in said and not held(text):
                framed = EDGE * 5 + text + EDGE
                counts[side].update(framed[i - k : i + 1] for i in range(5, len(framed)) for k in range(6))
        for gram, n in counts[side].items():
            totals[side][gram[:-1]] += n
            kinds[side][gram[:-1]] += 1

    def weight(gram):
        logs = []
        for side in ("allow", "block"):
            p = 1 / 256
            for k in range(1, 7):
                part = gram[-k:]
                if totals[side][part[:-1]]:
                    p = (counts[side][part] + kinds[side][part[:-1]] * p) / (totals[side][part[:-1]] + kinds[side][part[:-1]])
            logs.append(math.log(p))
        return logs[0] - logs[1]

    scores = {}
    for text in texts:
        framed = EDGE * 5 + text + EDGE
        scores[text] = sum(weight(framed[i - 5 : i + 1]) for i in range(5, len(framed))) / (len(text) + 1)
    judged = [(scores[t], next(iter(s))) for t, s in texts.items() if held(t) and s != {None}]
    sides = Counter(v for _, v in judged)
    gain = lambda b: sum((1 if v == "block" else -1) / sides[v] for s, v in judged if s * 1000 < b)
    bins = sorted({math.floor(s * 1000) for s, _ in judged})
    at = max(range(len(bins)), key=lambda k: round(gain(bins[k]), 12))
    return scores, (bins[max(at - 1, 0)] + (at > 0) + bins[at]) // 2


def test_scores_and_threshold_equal_a_plain_model(spark):
    given = some_urls(400)
    scores, least = plain_scores(given)
    got, checked = verdicts(spark, given), 0
    for k, url in enumerate(given):
        if got[k].rule is None:
            rest = (url or "").partition("://")
            text = got[k].host + rest[2][len(got[k].host) :] if rest[1] else url or ""
            assert got[k].score == pytest.approx(scores[text], abs=2e-6)
            assert got[k].verdict == ("block" if math.floor(got[k].score * 1000) < least else "allow")
            checked += 1
    assert checked > 100 and {r.verdict for r in got.values() if r.rule is None} == {"allow", "block"}


def test_sql_agrees_on_odd_urls(spark):
    given = some_urls(150, 9)[:-1]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(given)))
    want = sorted(con.execute(f"SELECT page_id, host, path, rule, verdict, score FROM ({URL_FILTERS})").fetchall(), key=lambda r: r[0])
    got = sorted((tuple(r) for r in urls.url_verdicts(pages(spark, given), URL_RULES).collect()), key=lambda r: r[0])
    assert got == want


def test_spam_words_are_learnt_and_no_python_runs(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["news", "garden", "music", "river"]) + str(rng.randrange(90))
    bad = lambda: rng.choice(["casino", "freebets", "pills"]) + str(rng.randrange(90))
    given = [f"http://{word()}.good/{word()}" for _ in range(150)] + [f"http://{bad()}.bad/{bad()}" for _ in range(150)]
    asked = [f"http://{word()}.com/{word()}" for _ in range(40)] + [f"http://{bad()}.com/{bad()}" for _ in range(40)]
    df = urls.url_verdicts(pages(spark, given + asked), [("allow", "good", ""), ("block", "bad", "")])
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    got = {r.page_id: r.verdict for r in df.collect()}
    assert [got[300 + k] for k in range(80)] == ["allow"] * 40 + ["block"] * 40


def test_one_url_in_most_rows_and_empty_tables(spark):
    given = ["http://same.com/en/1"] * 300 + some_urls(60)
    got = verdicts(spark, given)
    assert len(got) == len(given) and len({(got[k].verdict, got[k].score) for k in range(300)}) == 1
    assert urls.url_verdicts(pages(spark, []), URL_RULES).collect() == []
