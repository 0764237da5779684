"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from tidepanel.llm.quality_rules import RULES
from tidepanel.llm.secrets import BASE, RULES as SECRETS

_SPACE = r"[^\x20\x09-\x0D]+"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def secret_scans() -> str:
    """Starts are the lengths of all gaps and matches before."""
    parts = []
    for number, rule in enumerate(SECRETS):
        p = _text(rule.pattern)
        parts.append(f"""
SELECT doc_id, {number} AS number, '{rule.kind}' AS kind,
       list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS a,
       length(m[i]) AS size
FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, {p}, 0) AS m, regexp_extract_all(text, {p}, {rule.group}) AS g,
                   string_split_regex(text, {p}) AS gaps FROM d))
WHERE length(g[i]) >= {rule.least}""")
    span = "kind || ':' || a::BIGINT || ':' || (a + size)::BIGINT"
    base = f"number < {len(BASE)}"
    counts = ", ".join(f"coalesce(count_if(kind = '{r.kind}'), 0)::BIGINT AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({' UNION ALL '.join(parts)})
SELECT doc_id, {counts},
       sha256(coalesce(string_agg({span}, ',' ORDER BY a, number) FILTER (WHERE {base}), '')) AS base_sha256,
       coalesce(string_agg({span}, ',' ORDER BY a, number) FILTER (WHERE kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN f USING (doc_id) GROUP BY doc_id"""


def near_duplicates(width: int, percent: int) -> str:
    """All pairs with a shingle in common, and the closure of their links."""
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, x FROM (
  SELECT doc_id, {run} AS x FROM (SELECT *, unnest(range(1, len(w) - {width - 2})) AS i FROM d WHERE len(w) >= {width})
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND {width - 1})),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS c FROM s l JOIN s r ON l.x = r.x AND l.doc_id <> r.doc_id GROUP BY 1, 2)
  JOIN n l ON l.doc_id = a JOIN n r ON r.doc_id = b WHERE c * 100 >= (l.n + r.n - c) * {percent}),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id,
       doc_id <= coalesce(c, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) USING (doc_id)"""


def quality_rules(fence: int = 3, least_rows: int = 200, least_words: int = 50) -> str:
    ratios = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{k}' AS rule, {above} * 1000 // ({below} + {more}) AS v FROM m WHERE {below} > 0"
        for k, (above, below, _, _, more) in RULES.items())
    floor = " ".join(f"WHEN '{k}' THEN {spread}" for k, (_, _, _, spread, _) in RULES.items())
    low = ", ".join(f"'{k}'" for k, v in RULES.items() if v[2] == "low")
    order = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(RULES))
    level = lambda i, keys: f"""
SELECT {i} AS level, {keys}, rule, max(total) AS n, min(top) FILTER (WHERE upto * 4 >= total) AS q1,
       min(top) FILTER (WHERE upto * 4 >= total * 3) AS q3
FROM (SELECT {keys}, rule, top, sum(count(*)) OVER (PARTITION BY {keys}, rule ORDER BY top) AS upto,
             sum(count(*)) OVER (PARTITION BY {keys}, rule) AS total FROM t GROUP BY {keys}, rule, top)
GROUP BY {keys}, rule"""  # noqa: E731
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACE}')) AS lines
           FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3))),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, range(0, 3) AS o(k) WHERE c > 1 GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN r USING (doc_id)),
v AS ({ratios}),
t AS (SELECT *, CASE WHEN v < 128 THEN v ELSE (((v >> (length(bin(v)) - 7)::INTEGER) + 1) << (length(bin(v)) - 7)::INTEGER) - 1 END AS top FROM v),
q AS ({level(0, 'lang, source')}),
q1 AS ({level(1, 'lang')}),
q2 AS (SELECT max(total) AS n, rule, min(top) FILTER (WHERE upto * 4 >= total) AS q1, min(top) FILTER (WHERE upto * 4 >= total * 3) AS q3
       FROM (SELECT rule, top, sum(count(*)) OVER (PARTITION BY rule ORDER BY top) AS upto,
                    sum(count(*)) OVER (PARTITION BY rule) AS total FROM t GROUP BY rule, top) GROUP BY rule),
cut AS (SELECT q.lang, q.source, q.rule,
               CASE WHEN q.n >= {least_rows} THEN q.q1 WHEN q1.n >= {least_rows} THEN q1.q1 ELSE q2.q1 END AS lo,
               CASE WHEN q.n >= {least_rows} THEN q.q3 WHEN q1.n >= {least_rows} THEN q1.q3 ELSE q2.q3 END AS hi
        FROM q JOIN q1 ON q.lang IS NOT DISTINCT FROM q1.lang AND q.rule = q1.rule JOIN q2 ON q.rule = q2.rule),
bad AS (SELECT v.doc_id, string_agg(v.rule, ',' ORDER BY CASE v.rule {order} END) AS failed
        FROM v JOIN cut ON v.lang IS NOT DISTINCT FROM cut.lang AND v.source IS NOT DISTINCT FROM cut.source AND v.rule = cut.rule
        WHERE CASE WHEN v.rule IN ({low}) THEN v < lo - greatest(hi - lo, CASE v.rule {floor} END) * {fence}
                   ELSE v > hi + greatest(hi - lo, CASE v.rule {floor} END) * {fence} END GROUP BY v.doc_id)
SELECT doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {least_words} OR n_repeat_words * 100 > n_words * 50 AS base_failed, coalesce(failed, '') AS failed,
       NOT (n_words < {least_words} OR n_repeat_words * 100 > n_words * 50) AND failed IS NULL AS kept
FROM m LEFT JOIN bad USING (doc_id)"""


def decontamination(percent: int = 80, width: int = 5) -> str:
    """Every window that shares a shingle with an item, aligned by it."""
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
    run = lambda w, at, size: f"array_to_string({w}[{at} + 1:{at} + {size}], ' ')"
    return f"""
WITH i AS (SELECT DISTINCT item_id, w, len(w) AS n, least(len(w), {width}) AS size
           FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
ish AS (SELECT item_id, n, size, o, {run('w', 'o', width)} AS x
        FROM (SELECT *, unnest(range(0, greatest(1, n - {width - 1}))) AS o FROM i)),
d AS (SELECT doc_id, {words} AS w FROM documents),
dsh AS (SELECT doc_id, size, p, {run('w', 'p', 'size')} AS x
        FROM (SELECT *, unnest(range(0, len(w))) AS p FROM d), (SELECT DISTINCT size FROM i)),
win AS (SELECT DISTINCT doc_id, item_id, n, greatest(0, p - o) AS start
        FROM dsh JOIN ish ON dsh.x = ish.x AND dsh.size = ish.size),
own AS (SELECT DISTINCT doc_id, item_id, start, {run('v', 'k', width)} AS x
        FROM (SELECT *, unnest(range(0, greatest(1, len(v) - {width - 1}))) AS k
              FROM (SELECT win.*, w[start + 1:start + n] AS v FROM win JOIN d USING (doc_id)))),
item AS (SELECT DISTINCT item_id, x FROM ish),
weight AS (SELECT item_id, sum(length(x)) AS total FROM item GROUP BY item_id),
sim AS (SELECT doc_id, item_id, start, sum(length(own.x)) AS mine,
               coalesce(sum(length(own.x)) FILTER (WHERE item.x IS NOT NULL), 0) AS met
        FROM own LEFT JOIN item USING (item_id, x) GROUP BY 1, 2, 3),
hit AS (SELECT doc_id, list(DISTINCT item_id ORDER BY item_id) AS items, max(met / (mine + total - met)) AS similarity
        FROM sim JOIN weight USING (item_id) WHERE met * 100 >= (mine + total - met) * {percent} GROUP BY doc_id)
SELECT doc_id, coalesce(array_to_string(items, ','), '') AS items, round(coalesce(similarity, 0e0), 6) AS similarity,
       items IS NOT NULL AS contaminated FROM d LEFT JOIN hit USING (doc_id)"""


def mixing(parts: int = 200, block: int = 8) -> str:
    """Earliest deadline first, slot after slot, for each kind of frame."""
    return f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS s,
         row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS place FROM documents),
sizes AS (SELECT s, count(*) AS n FROM rows GROUP BY s),
share AS (SELECT s, (n + {block - 1}) // {block} AS blocks,
                 greatest(1, round(sqrt(n) / sum(sqrt(n)) OVER () * {parts})::BIGINT) AS parts FROM sizes),
firsts AS (SELECT DISTINCT unnest([0, blocks // parts, blocks // parts + 1]) AS kind FROM share),
kinds AS (SELECT kind, s, parts, least(parts, blocks - least(blocks, kind * parts)) AS q,
                 sum(least(parts, blocks - least(blocks, kind * parts))) OVER (PARTITION BY kind) AS size,
                 sum(least(blocks, kind * parts)) OVER (PARTITION BY kind) AS start FROM share, firsts),
b AS (SELECT kind, s, j, size, start, j * size // q AS release, ((j + 1) * size + q - 1) // q AS deadline,
             row_number() OVER (PARTITION BY kind ORDER BY ((j + 1) * size + q - 1) // q, s, j) AS id
      FROM (SELECT *, unnest(range(0, q)) AS j FROM kinds WHERE q > 0)),
placed AS (
  SELECT kind, -1::BIGINT AS t, 0::BIGINT AS id, []::BIGINT[] AS used FROM (SELECT DISTINCT kind FROM b)
  UNION ALL
  SELECT kind, t + 1, pick, list_append(used, pick) FROM (
    SELECT p.kind, p.t, p.used, min(b.id) AS pick FROM placed p JOIN b ON b.kind = p.kind
    WHERE b.release <= p.t + 1 AND NOT list_contains(p.used, b.id) GROUP BY 1, 2, 3)),
plan AS (SELECT b.*, t AS slot FROM placed JOIN b USING (kind, id)),
spot AS (SELECT r.*, place // {block} AS block, place // {block} // parts AS frame, place // {block} % parts AS j,
              (SELECT max(kind) FROM firsts WHERE kind <= place // {block} // parts) AS kind
       FROM rows r JOIN share USING (s))
SELECT doc_id, source, block::BIGINT AS block, (start + (frame - kind) * size + release)::BIGINT AS release,
       (start + (frame - kind) * size + deadline)::BIGINT AS deadline, (start + (frame - kind) * size + slot)::BIGINT AS slot,
       ((start + (frame - kind) * size + slot) * {block} + place % {block})::BIGINT AS position
FROM spot JOIN plan USING (kind, s, j)"""


def perplexity(order: int = 5, share: float = 0.995, margin: float = 0.05, weight: int = 400, step: float = 0.001) -> str:
    """Bytes as pairs of hex digits; count tables and probabilities order by order."""
    rows, pad = [], "00" * (order - 1)
    grams = lambda source: f"""SELECT doc_id, substr(x, 2 * i + 1, {2 * order}) AS g, count(*) AS n
  FROM (SELECT doc_id, '{pad}' || h AS x, unnest(range(0, length(h) // 2)) AS i FROM {source}) GROUP BY 1, 2"""  # noqa: E731
    rows.append("""d AS (SELECT doc_id, lang, hex(encode(coalesce(text, ''))) AS h FROM documents),
good AS (SELECT DISTINCT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 32, 1))::INTEGER % 2 AS half FROM labels WHERE quality = 1),
taught AS (SELECT * FROM d WHERE doc_id IN (SELECT doc_id FROM good WHERE half = 0))""")
    rows.append(f"n AS ({grams('d')})")
    rows.append(f"c{order} AS (SELECT g, sum(n)::BIGINT AS c FROM ({grams('taught')}) GROUP BY g)")
    for k in range(order - 1, 0, -1):
        rows.append(f"c{k} AS (SELECT substr(g, 3) AS g, count(*) AS c FROM c{k + 1} GROUP BY 1)")
    for k in range(1, order + 1):
        rows.append(f"""k{k} AS (SELECT count_if(c = 1)::DOUBLE AS n1, count_if(c = 2)::DOUBLE AS n2, count_if(c = 3)::DOUBLE AS n3,
       count_if(c = 4)::DOUBLE AS n4 FROM c{k}),
y{k} AS (SELECT CASE WHEN n1 > 0 AND n2 > 0 THEN least(greatest(1 - 2 * (n1 / (n1 + 2 * n2)) * n2 / n1, 0.1e0), 0.9e0) ELSE 0.5e0 END AS d1,
       CASE WHEN n1 > 0 AND n2 > 0 THEN least(greatest(2 - 3 * (n1 / (n1 + 2 * n2)) * n3 / n2, 0.1e0), 1.9e0) ELSE 0.75e0 END AS d2,
       CASE WHEN n1 > 0 AND n2 > 0 THEN least(greatest(CASE WHEN n3 > 0 THEN 3 - 4 * (n1 / (n1 + 2 * n2)) * n4 / n3 ELSE 1.5e0 END, 0.1e0), 2.9e0)
            ELSE 0.9e0 END AS d3 FROM k{k}),
u{k} AS (SELECT g, substr(g, 1, {2 * k - 2}) AS x, c, CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END AS cut FROM c{k}, y{k}),
x{k} AS (SELECT x, sum(c) AS total, sum(cut) / sum(c) AS free FROM u{k} GROUP BY x)""")
        low = "1 / 256e0" if k == 1 else "p"
        below = "" if k == 1 else f" JOIN p{k - 1} ON p{k - 1}.g = substr(u{k}.g, 3)"
        rows.append(f"p{k} AS (SELECT u{k}.g AS g, (c - cut) / total + free * {low} AS p FROM u{k} JOIN x{k} USING (x){below})")
    chain, joins = "1 / 256e0", ""
    for k in range(1, order + 1):
        at = 2 * (order - k) + 1
        chain = f"coalesce(p{k}.p, coalesce(x{k}.free, 1e0) * {chain})"
        joins += (f" LEFT JOIN p{k} ON p{k}.g = substr(e.g, {at}) "
                  f"LEFT JOIN x{k} ON x{k}.x = substr(e.g, {at}, {2 * k - 2})")
    rows.append(f"z AS (SELECT e.g AS g, -log2({chain}) AS bits FROM (SELECT DISTINCT g FROM n) AS e{joins})")
    rows.append("""r AS (SELECT d.doc_id, lang, length(h) // 2 AS n_bytes, sum(n * bits) AS bits
      FROM d LEFT JOIN n USING (doc_id) LEFT JOIN z USING (g) GROUP BY d.doc_id, lang, h)""")

    def quantile(source: str, keys: str, of: str, share: float) -> str:
        over = f"PARTITION BY {keys[:-2]}" if keys else ""
        return f"""SELECT {keys}(min(s) FILTER (WHERE upto >= total * {share}) + 1) * {step} AS cut FROM (
  SELECT {keys}s, sum(count(*)) OVER ({over} ORDER BY s) AS upto, sum(count(*)) OVER ({over}) AS total
  FROM (SELECT lang, floor(x / {step}) AS s FROM (SELECT doc_id, lang, {of} AS x FROM {source}) WHERE x IS NOT NULL
        AND doc_id IN (SELECT doc_id FROM good WHERE half = 1)) GROUP BY {keys}s) {'GROUP BY ' + keys[:-2] if keys else ''}"""

    rate = "bits / nullif(n_bytes, 0)"
    rows.append(f"usual AS ({quantile('r', 'lang, ', rate, 0.5)})")
    rows.append(f"middle AS ({quantile('r', '', rate, 0.5)})")
    rows.append(f"""e AS (SELECT r.*, CASE WHEN n_bytes > 0 THEN (bits - coalesce(usual.cut, middle.cut) * n_bytes) / (n_bytes + {weight}) END AS excess
      FROM r LEFT JOIN usual ON r.lang IS NOT DISTINCT FROM usual.lang, middle)""")
    rows.append(f"own AS ({quantile('e', 'lang, ', 'excess', share)})")
    rows.append(f"whole AS ({quantile('e', '', 'excess', share)})")
    return "WITH " + ",\n".join(rows) + f"""
SELECT doc_id, e.lang AS lang, n_bytes, round(pow(2, bits / nullif(n_bytes, 0)), 6) AS perplexity, round(excess, 6) AS excess,
       round(greatest(own.cut, whole.cut) + {margin}, 6) AS cutoff,
       coalesce(excess <= greatest(own.cut, whole.cut) + {margin}, n_bytes > 0) AS kept
FROM e LEFT JOIN own ON e.lang IS NOT DISTINCT FROM own.lang, whole"""


SQL = {"op2_perplexity": perplexity(), "op4_secret_scans": secret_scans(), "op5_near_duplicates": near_duplicates(3, 85),
       "op6_decontamination": decontamination(), "op7_mixing": mixing(), "op9_quality_rules": quality_rules()}
