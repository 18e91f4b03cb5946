"""Line dedup by site-relative frequency: lines on too large a share of a host's pages go."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import field, free_name, named, stored, with_columns

#: A line on more than this share of a host's pages is boilerplate; smaller hosts are left alone.
RATIO = 0.1
LEAST_PAGES = 20
#: Boilerplate lines of all hosts that may be sent to tasks; more are joined by host.
SENT_BYTES = 64 << 20

_HIDDEN = re.compile(rb"(?is)<script\b.*?(?:</script\s*>|\Z)|<style\b.*?(?:</style\s*>|\Z)|<!--.*?(?:-->|\Z)")
_BREAK = re.compile(
    rb"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>"
)
_TAG = re.compile(rb"<[^<>]*>")
_ENTITIES = ((b"&lt;", b"<"), (b"&gt;", b">"), (b"&quot;", b'"'), (b"&#39;", b"'"), (b"&nbsp;", b" "), (b"&amp;", b"&"))


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without port; "" if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), "^[a-z][a-z0-9+.-]*://([^/?#:]*)", 1), F.lit(""))


def lines_of_html(html: bytes | None) -> bytes:
    """The visible text of a page, a line for each block."""
    text = _TAG.sub(b"", _BREAK.sub(b"\n", _HIDDEN.sub(b"", html or b"")))
    for name, char in _ENTITIES:
        text = text.replace(name, char)
    return b"\n".join(line for line in map(bytes.strip, text.split(b"\n")) if line)


def _key(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(line)


def _tallied(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of each host with each line, counted within the task."""
    counts: Counter = Counter()

    def shipped():
        every = list(counts.items())
        counts.clear()
        for k in range(0, len(every), 50_000):
            part = every[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0][0] for x in part], pa.string()), pa.array([x[0][1] for x in part], pa.binary()), pa.array([x[1] for x in part], pa.int64())],
                names=["host", "line", "n"],
            )

    for batch in stream:
        for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = {line for line in map(bytes.strip, (text or b"").split(b"\n")) if line}
            counts.update([(host, _key(line)) for line in lines])
            if len(counts) > 400_000:
                yield from shipped()
    yield from shipped()


def boilerplate_lines(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, line): 128-bit keys of the boilerplate lines of ``pages(host, text)``.

    A host has fewer than (mean lines of its pages) / ratio of them.
    """
    tallied = pages.select("host", F.col("text").cast("binary").alias("text")).mapInArrow(_tallied, "host string, line binary, n long")
    counts = tallied.groupBy("host", "line").agg(F.sum("n").alias("n")).where(F.col("n") > ratio * least_pages)
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages)
    # A merge join of two fresh shuffles, so that adaptive execution can split a host with a third of the lines.
    joined = stored(counts, "lines").hint("merge").join(totals.hint("merge"), "host")
    return joined.where(F.col("n") > ratio * F.col("pages")).select("host", "line")


def _dropper(known):
    def make():
        def rows(hosts, texts, lists=None):
            out, n_lines, n_dropped = [], [], []
            for k, (host, text) in enumerate(zip(hosts, texts)):
                drop = known.value.get(host.decode(), ()) if lists is None else set(lists[k] or ())
                lines = (text or b"").split(b"\n")
                bare = [line.strip() for line in lines]
                kept = [line for line, b in zip(lines, bare) if not (b and drop and _key(b) in drop)]
                n_lines.append(sum(map(bool, bare)))
                n_dropped.append(len(lines) - len(kept))
                out.append(None if text is None else b"\n".join(kept).decode("utf-8", "replace"))
            return [out, n_lines, n_dropped]

        return rows

    return make


def drop_boilerplate(
    docs: DataFrame,
    host: Column,
    text: Column,
    names: tuple[str, str, str] = ("text", "n_lines", "n_dropped"),
    keep: list[str] | None = None,
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """``keep`` columns (all) with the text without boilerplate lines, and how many lines it had and lost.

    Lines are compared without the white space around them; blank lines never count nor go.
    A line counts once a page. A null host is the host ""; a null text stays null and has no
    lines, but its page counts. Hosts under ``least_pages`` pages lose nothing. Repeated
    rows are pages of their own. ``names`` must not be among the columns that are kept.
    """
    host = F.coalesce(host.cast("string"), F.lit(""))
    found = stored(boilerplate_lines(docs.select(host.alias("host"), text.alias("text")), ratio, least_pages), "boilerplate")
    fields = [field(names[0], "string"), field(names[1], "long"), field(names[2], "long")]
    size = found.agg(F.coalesce(F.sum(F.length("host") + 16 + 100), F.lit(0))).first()[0]
    if size <= sent_bytes:
        sent: dict[str, set[bytes]] = {}
        for r in found.collect():
            sent.setdefault(r.host, set()).add(bytes(r.line))
        return with_columns(docs, [host, text], fields, _dropper(docs.sparkSession.sparkContext.broadcast(sent)), keep)
    own, lines = free_name(docs, "host"), free_name(docs, "lines")
    lists = found.groupBy(F.col("host").alias(own)).agg(F.collect_list("line").alias(lines))
    joined = docs.withColumn(own, host).join(lists.hint("merge"), own, "left")
    return with_columns(joined, [named(own), text, named(lines)], fields, _dropper(None), docs.columns if keep is None else keep)


def page_texts(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, host, text, n_lines, n_dropped of ``pages(page_id, url, html)``: visible text without boilerplate.

    Null pages and pages without a visible line have an empty text.
    """
    made = with_columns(
        pages.select("page_id", "url", "html"), [named("html")], [field("visible", "string")],
        lambda: lambda htmls: [[lines_of_html(h).decode("utf-8", "replace") for h in htmls]], ["page_id", "url"],
    )
    made = stored(made.select("page_id", host_of(F.col("url")).alias("host"), "visible"), "visible")
    return drop_boilerplate(made, F.col("host"), F.col("visible"), keep=["page_id", "host"], ratio=ratio, least_pages=least_pages)
