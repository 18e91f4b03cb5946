"""URL filters: short rules first, then the ratio of two character models; DataFrame functions only.

URLs that a rule decides teach two variable-order Markov models, one of allowed and one of
blocked URLs. The probability of a character after a context of k characters is

    (n(context, character) + t(context) * p(character after the context of k - 1)) / (n(context) + t(context))

with t the number of different characters seen after the context, from a uniform start over
``ALPHABET``; a context that wasn't seen leaves the shorter one in force. Rows are distinct
grams, counted with map-side sums, so a host with a third of all URLs is no hot key, and a
URL is one row however often it occurs.

A URL's score is the difference of its two log probabilities, divided by its length. URLs
below the threshold are blocked. The threshold is calibrated on decided URLs that taught
nothing: it is the one that best separates them, as the mean of both rates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.batches import named, stored

ALLOW, BLOCK = "allow", "block"
#: (verdict, host, path): holds for the host and all its subdomains.
Rule = tuple[str, str, str]
#: Characters of a gram: the context and the character after it.
GRAM = 6
#: The start of the smoothing: each character has one over this.
ALPHABET = 256
#: One in so many decided URLs calibrates, by its hash; the others teach.
FOLDS = 5
#: Scores are sums of whole millionths, so that no order of adding changes them.
UNIT = 1_000_000
#: The threshold is a multiple of this many millionths.
STEP = 1_000
SIDES = (ALLOW, BLOCK)
_EDGE = "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, its A-Z in lower case, and path; both empty without ``://`` or URL."""
    part = lambda k: F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, k), F.lit(""))
    return lower_ascii(part(1)), part(2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null without one; of equals, the longer host, then ``block``."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != BLOCK, r[1:]))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in reversed(order):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        text, verdict = F.when(fits, F.lit(name + start)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _grams(text: Column) -> Column:
    """Every character with the ``GRAM - 1`` before it, the edges of the text marked; linear in its length."""
    framed = F.concat(F.lit(_EDGE * (GRAM - 1)), text, F.lit(_EDGE))
    return F.regexp_extract_all(framed, F.lit(f"(?s)(?=(.{{{GRAM}}}))."), F.lit(1))


def _suffixes(gram: Column) -> Column:
    """(k, gram) for the last k characters, k = 1 … GRAM."""
    return F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.substring(gram, GRAM + 1 - k, k).alias("gram")) for k in range(1, GRAM + 1)]))


def character_model(taught: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of ``taught(text, verdict)``: of grams, and of what follows their contexts.

    (gram, n for either side), and (context, for either side total and kinds), where
    ``total`` counts the characters after the context and ``kinds`` the different ones.
    """
    side = [F.count_if(F.col("verdict") == s).alias(f"n_{s}") for s in SIDES]
    longest = taught.select("verdict", F.explode(_grams(F.col("text"))).alias("gram")).groupBy("gram").agg(*side)
    pieces = longest.select(_suffixes(F.col("gram")).alias("s"), *[f"n_{s}" for s in SIDES])
    counts = stored(pieces.groupBy(F.col("s.gram").alias("gram")).agg(*[F.sum(f"n_{s}").alias(f"n_{s}") for s in SIDES]), "grams")
    totals = counts.groupBy(F.expr("substring(gram, 1, char_length(gram) - 1)").alias("context")).agg(
        *[F.sum(f"n_{s}").alias(f"total_{s}") for s in SIDES], *[F.count_if(F.col(f"n_{s}") > 0).alias(f"kinds_{s}") for s in SIDES]
    )
    return counts, stored(totals, "contexts")


def _probability(levels: Column, side: str) -> Column:
    """From the levels of a gram, shortest context first."""
    return F.aggregate(
        levels,
        F.lit(1.0 / ALPHABET),
        lambda p, x: F.when(x[f"total_{side}"] > 0, (x[f"n_{side}"] + x[f"kinds_{side}"] * p) / (x[f"total_{side}"] + x[f"kinds_{side}"])).otherwise(p),
    )


def gram_weights(grams: DataFrame, taught: DataFrame) -> DataFrame:
    """(gram, weight): for distinct ``grams(gram)``, log p(allowed) - log p(blocked) in millionths."""
    counts, contexts = character_model(taught)
    each = grams.select("gram", _suffixes(F.col("gram")).alias("s")).select("gram", F.col("s.k").alias("k"), F.col("s.gram").alias("part"))
    met = stored(each.hint("merge").join(counts.withColumnRenamed("gram", "part").hint("merge"), "part", "left"), "levels")
    met = met.withColumn("context", F.expr("substring(part, 1, k - 1)"))
    met = met.hint("merge").join(contexts.hint("merge"), "context", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    numbers = [f"{x}_{s}" for x in ("n", "total", "kinds") for s in SIDES]
    levels = F.array_sort(F.collect_list(F.struct("k", *[zero(c) for c in numbers])))
    whole = met.groupBy("gram").agg(levels.alias("levels"))
    ratio = F.log(_probability(F.col("levels"), ALLOW)) - F.log(_probability(F.col("levels"), BLOCK))
    return whole.select("gram", F.round(ratio * UNIT).cast("long").alias("weight"))


def _bin(score: Column) -> Column:
    return F.floor(score * (UNIT // STEP))


def threshold(scored: DataFrame) -> int:
    """The bin of the score that best separates ``scored(score, verdict)``; 0 unless both verdicts are there.

    It lies in the middle between two bins that have URLs. Ties go to the lowest. The window sees a row for each bin, however many URLs there are.
    """
    bins = scored.groupBy(_bin(F.col("score")).alias("bin")).agg(*[F.count_if(F.col("verdict") == s).alias(s) for s in SIDES])
    below = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("bin").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    share = {s: F.coalesce(F.sum(s).over(below), F.lit(0)) / F.nullif(F.sum(s).over(every), F.lit(0)) for s in SIDES}
    middle = F.floor((F.coalesce(F.lag("bin").over(W.orderBy("bin")) + 1, "bin") + F.col("bin")) / 2)
    best = bins.select(middle.alias("bin"), (share[BLOCK] - share[ALLOW]).alias("gain"))
    return best.where("gain IS NOT NULL").agg(F.coalesce(F.min_by("bin", F.struct(-F.col("gain"), "bin")), F.lit(0))).first()[0]


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, score: whether each page's URL is allowed.

    The longest rule that fits decides, else the character models taught by the URLs that
    rules decide; ``score`` is null where a rule decides. ``rules`` is a short list, as it
    becomes an expression. A null URL, or one without ``://``, has an empty host and path and
    is scored as it is (null: empty). Repeated URLs get the same verdict and teach once.
    Where rules decide no URL, or only to one side, no model can be had: the score is 0 and
    the verdict ``allow``. An empty table gives no rows; further columns don't matter.
    """
    url = named(url_column)
    host, path = url_parts(url)
    given = pages.select(named(id_column).alias("id"), host.alias("host"), path.alias("path"), F.coalesce(url, F.lit("")).alias("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rest = F.coalesce(F.regexp_extract("url", _AFTER_SCHEME, 3), F.lit(""))
    text = F.when(F.col("url").contains("://"), F.concat("host", "path", rest)).otherwise(F.col("url"))
    judged = given.withColumns({"rule": rule, "verdict": verdict}).withColumn("text", text)
    decided = judged.where("verdict IS NOT NULL").select("id", "host", "path", "rule", "verdict", F.lit(None).cast("double").alias("score"))
    undecided = judged.where("verdict IS NULL").drop("verdict")
    texts = judged.groupBy("text").agg(F.min("verdict").alias("verdict"), F.max(F.col("verdict").isNull()).alias("asked"))
    held = F.col("verdict").isNotNull() & (F.crc32(F.col("text").cast("binary")) % FOLDS == 0)
    texts = stored(texts.withColumns({"held": held, "u": F.monotonically_increasing_id()}), "urls")
    taught = texts.where("verdict IS NOT NULL AND NOT held")
    if taught.select("verdict").distinct().count() < len(SIDES):
        made = undecided.select("id", "host", "path", "rule", F.lit(ALLOW).alias("verdict"), F.lit(0.0).alias("score"))
    else:
        scored = stored(_scores(texts.where("asked OR held"), taught), "scores")
        least = threshold(scored.where("held"))
        own = F.when(_bin(F.col("score")) < least, BLOCK).otherwise(ALLOW)
        scores = scored.where("asked").select("text", "score")
        made = undecided.hint("merge").join(scores.hint("merge"), "text").select("id", "host", "path", "rule", own.alias("verdict"), "score")
    return decided.unionByName(made).withColumnRenamed("id", id_column)


def _scores(texts: DataFrame, taught: DataFrame) -> DataFrame:
    """``texts`` with the score: the mean weight of their grams."""
    grams = stored(texts.select("u", F.explode(_grams(F.col("text"))).alias("gram")), "steps")
    weights = stored(gram_weights(grams.select("gram").distinct(), taught), "weights")
    sums = grams.hint("merge").join(weights.hint("merge"), "gram").groupBy("u").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    return texts.join(sums.select("u", (F.col("weight") / F.col("n") / UNIT).alias("score")), "u")
