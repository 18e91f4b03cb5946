"""Secret scans weighed by how many owners hold the same value; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import named, stored

#: Kinds in the order of the report: pattern, and the group that holds the value.
#: A run of 16 is what is left of `[0-9a-f]+` once shorter runs are dropped; so for `AKIA…`.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
#: Opaque strings: spans only if they are mixed and few owners have them.
OPAQUE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "opaque")
ASSIGN_LEAST = 12
#: A value that so many owners have is an example; with fewer it looks live.
EXAMPLE_OWNERS = 3
#: Matches that are added up at a time.
RUN = 256

_SPAN = "struct<start:bigint,ord:int,end:bigint,value:string>"


def _spans(text: Column, order: int, pattern: str, group: int) -> Column:
    """All matches of ``pattern`` in order: start and end in code points, and the value.

    A start is the sum of the gaps and matches before it. These are added up in runs of
    ``RUN`` matches, then within each run, so the work stays linear in the matches of a text.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    found = F.struct(gaps.alias("gaps"), F.transform(whole, F.char_length).alias("sizes"), value.alias("values"))
    zero = F.lit(0).cast("long")

    def matches(run: Column, n: Column) -> Column:
        return F.sequence(run * RUN, F.least((run + 1) * RUN, n) - 1)

    def starts(hits: Column) -> Column:
        """Where each run of matches begins."""
        runs = F.sequence(F.lit(0), F.floor((F.size(hits["sizes"]) - 1) / RUN).cast("int"))
        total = lambda run: F.aggregate(matches(run, F.size(hits["sizes"])), zero, lambda at, k: at + hits["gaps"][k] + hits["sizes"][k])
        begin = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda done, size: F.struct((done["at"] + size).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out"))
        return F.aggregate(F.transform(runs, total), begin, step, lambda done: done["out"])

    def run_spans(hits: Column, run: Column, at: Column) -> Column:
        begin = F.struct(at.alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))

        def step(done: Column, k: Column) -> Column:
            first = done["at"] + hits["gaps"][k]
            last = first + hits["sizes"][k]
            span = F.struct(first.alias("start"), F.lit(order).alias("ord"), last.alias("end"), hits["values"][k].alias("value"))
            return F.struct(last.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

        return F.aggregate(matches(run, F.size(hits["sizes"])), begin, step, lambda done: done["out"])

    # One element, so that the matches are looked for once and not at every step.
    spans = F.transform(F.array(found), lambda hits: F.flatten(F.transform(starts(hits), lambda at, run: run_spans(hits, run, at))))[0]
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def _report(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", kinds[s["ord"]], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def candidates(docs: DataFrame, id_: Column, text: Column, repository: Column, owner: Column) -> DataFrame:
    """id, repository, owner, spans with hashed values: everything that may be a secret."""
    given = docs.select(id_.alias("id"), F.coalesce(text, F.lit("")).alias("text"), F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"))
    assign = F.filter(_spans(F.col("text"), 0, ASSIGN, 2), lambda s: F.char_length(s["value"]) >= ASSIGN_LEAST)
    opaque = F.filter(_spans(F.col("text"), 3, OPAQUE, 0), lambda s: _mixed(s["value"]))
    spans = F.concat(assign, _spans(F.col("text"), 1, ACCESS, 0), _spans(F.col("text"), 2, HEX, 0), opaque)
    hashed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash")))
    return given.select("id", "repository", "owner", hashed.alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_repositories, n_owners over all documents with the value."""
    each = found.select(F.explode("spans.hash").alias("hash"), "repository", "owner").distinct()
    owners = each.groupBy("hash", "owner").agg(F.count("repository").alias("n"))
    return owners.groupBy("hash").agg(F.sum("n").alias("n_repositories"), F.count("owner").alias("n_owners"))


def secret_scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    repository_column: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans, n_opaque, n_live, n_example.

    Positions are code points, ends exclusive. An owner is what stands before the first slash
    of the repository's name. A value with ``example_owners`` owners or more is an example;
    an opaque string counts as a span only below that. Null texts are empty, null repositories
    are one repository "". Repeated rows are reported each and count as one owner.
    """
    repository = named(repository_column)
    found = candidates(docs, named(id_column), named(text_column), repository, F.substring_index(repository.cast("string"), "/", 1))
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "candidates")
    owned = stored(ownership(found.where(F.size("spans") > 0)), "owners")
    each = found.where(F.size("spans") > 0).select("row", F.explode("spans").alias("s")).select("row", "s", F.col("s.hash").alias("hash"))
    # A merge join of two fresh shuffles, so that adaptive execution can split a value that a third of all documents hold.
    weighed = each.hint("merge").join(owned.hint("merge"), "hash").withColumn("example", F.col("n_owners") >= example_owners)
    kept = weighed.where((F.col("s.ord") < len(BASE)) | ~F.col("example"))
    per_row = kept.groupBy("row").agg(
        F.collect_list(F.struct("s.start", "s.ord", "s.end")).alias("all"),
        F.count_if("example").alias("n_example"),
        F.count_if(~F.col("example")).alias("n_live"),
    )
    base = F.transform(F.filter("spans", lambda s: s["ord"] < len(BASE)), lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end")))
    count = lambda k: F.size(F.filter("spans", lambda s: s["ord"] == k)).cast("long")
    plain = found.select("row", "id", *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE)], F.sha2(_report(base), 256).alias("base_sha256"))
    every = F.coalesce("all", F.array().cast("array<struct<start:bigint,ord:int,end:bigint>>"))
    return plain.join(per_row, "row", "left").select(
        F.col("id").alias(id_column),
        *[f"n_{name}" for name in BASE],
        "base_sha256",
        _report(every).alias("spans"),
        F.size(F.filter(every, lambda s: s["ord"] == len(BASE))).cast("long").alias("n_opaque"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )
