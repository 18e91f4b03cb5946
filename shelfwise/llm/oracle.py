"""DuckDB SQL for the text queries that SQL can express, by plainer ways than the operators'."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: CRC-32 as SQL: a one-row table of its 256 steps, and the sum of a text by it.
CRC_STEPS = """crc AS (
  SELECT list(x ORDER BY b) AS steps FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) AS x
    FROM range(256) AS r(b)))"""


def crc32(text: str) -> str:
    """The CRC-32 of a text; its query must have ``crc`` in scope."""
    codes = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"


def _levels(side: str, upto: int) -> str:
    """The smoothed probability after each length of context, each from the one before."""
    steps = [f"1.0::DOUBLE / 256 AS p{side}0"]
    for k in range(1, upto + 1):
        n, total, kinds = (f"coalesce(max(m.{x}{side}) FILTER (k = {k}), 0)" for x in ("n", "t", "k"))
        steps.append(f"CASE WHEN {total} > 0 THEN ({n} + {kinds} * p{side}{k - 1}) / ({total} + {kinds}) ELSE p{side}{k - 1} END AS p{side}{k}")
    return ", ".join(steps)


URL_FILTERS = f"""
WITH {CRC_STEPS}, rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
cut AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)(.*)$', ['host', 'path', 'rest']) AS part
  FROM pages),
parts AS (
  SELECT r, page_id, url, translate(part.host, '{_UPPER}', '{_LOWER}') AS host, part.path AS path, part.rest AS rest FROM cut),
ruled AS (
  SELECT p.*, CASE WHEN contains(p.url, '://') THEN p.host || p.path || p.rest ELSE p.url END AS text, f.rule, f.verdict
  FROM parts p LEFT JOIN (
    SELECT q.r, arg_max(x.host || x.path, length(x.host || x.path)) AS rule, arg_max(x.verdict, length(x.host || x.path)) AS verdict
    FROM parts q JOIN rules x ON (q.host = x.host OR ends_with(q.host, '.' || x.host)) AND starts_with(q.path, x.path)
    GROUP BY q.r) f ON p.r = f.r),
texts AS (
  SELECT text, verdict, asked, verdict IS NOT NULL AND {crc32("text")} % 5 = 0 AS held
  FROM (SELECT text, min(verdict) AS verdict, bool_or(verdict IS NULL) AS asked FROM ruled GROUP BY text), crc),
steps AS (
  SELECT text, verdict, asked, held, unnest(list_transform(range(1, length(framed) - 4), lambda i: substr(framed, i, 6))) AS gram
  FROM (SELECT *, repeat(chr(1), 5) || text || chr(1) AS framed FROM texts)),
counts AS (
  SELECT right(gram, k) AS part, count(*) FILTER (verdict = 'allow') AS na, count(*) FILTER (verdict = 'block') AS nb
  FROM steps, range(1, 7) AS s(k) WHERE verdict IS NOT NULL AND NOT held GROUP BY ALL),
contexts AS (
  SELECT left(part, length(part) - 1) AS context, sum(na) AS ta, sum(nb) AS tb, count(*) FILTER (na > 0) AS ka, count(*) FILTER (nb > 0) AS kb
  FROM counts GROUP BY ALL),
asked AS (SELECT DISTINCT gram FROM steps WHERE asked OR held),
met AS (
  SELECT a.gram, k, c.na, c.nb, x.ta, x.tb, x.ka, x.kb FROM asked a CROSS JOIN range(1, 7) AS s(k)
  LEFT JOIN counts c ON c.part = right(a.gram, k) LEFT JOIN contexts x ON x.context = left(right(a.gram, k), k - 1)),
weights AS (
  SELECT gram, round((ln(pa6) - ln(pb6)) * 1000000)::BIGINT AS weight
  FROM (SELECT gram, {_levels("a", 6)}, {_levels("b", 6)} FROM met m GROUP BY gram)),
scores AS (
  SELECT text, any_value(verdict) AS verdict, any_value(asked) AS asked, any_value(held) AS held,
    sum(weight)::BIGINT / count(*) / 1000000 AS score
  FROM steps JOIN weights USING (gram) WHERE asked OR held GROUP BY text),
bins AS (
  SELECT floor(score * 1000)::BIGINT AS bin, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b
  FROM scores WHERE held GROUP BY ALL),
gains AS (
  SELECT floor((coalesce(lag(bin) OVER (ORDER BY bin) + 1, bin) + bin) / 2)::BIGINT AS bin, coalesce(sum(b) OVER w, 0) / nullif((SELECT sum(b) FROM bins), 0) - coalesce(sum(a) OVER w, 0) / nullif((SELECT sum(a) FROM bins), 0) AS gain
  FROM bins WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT coalesce((SELECT bin FROM gains WHERE gain IS NOT NULL ORDER BY gain DESC, bin LIMIT 1), 0) AS least)
SELECT u.page_id, u.host, u.path, u.rule,
  CASE WHEN u.verdict IS NOT NULL THEN u.verdict WHEN floor(s.score * 1000) < least THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN u.verdict IS NULL THEN s.score END AS score
FROM ruled u LEFT JOIN scores s USING (text), best
"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC_STEPS}, found AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= 6 GROUP BY ALL),
hashed AS (SELECT w, n, {crc32("doc_id::VARCHAR || ':' || w")} AS h FROM found, crc),
made AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
edits AS (
  SELECT s.word AS a, w.word AS b FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT s.word, z.word FROM shorter s JOIN shorter z ON s.rest = z.rest AND s.i = z.i AND s.word <> z.word),
ranked AS (
  SELECT a, b, n, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS place, count(*) OVER (PARTITION BY a) AS n_near
  FROM edits JOIN words ON b = word),
judged AS (
  SELECT w.word, CASE WHEN r.n >= 5 * w.n THEN r.b END AS form, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.a = w.word AND r.place = 1),
chain AS (
  SELECT word, coalesce(form, word) AS at FROM judged
  UNION SELECT c.word, j.form FROM chain c JOIN judged j ON c.at = j.word WHERE j.form IS NOT NULL),
ends AS (SELECT c.word, c.at AS root FROM chain c JOIN judged j ON c.at = j.word WHERE j.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)
"""

ORACLE = {"op11_url_filters": URL_FILTERS, "op13_spelling_variants": SPELLING_VARIANTS}
