"""DuckDB SQL for the operators that SQL can express; every rule scans every text here, and every vector meets every query."""

from __future__ import annotations

from changeflow.llm import code_books, mixing, pii, secrets, spelling


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _secret_rule(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one rule: matches, what lies between them, and their running lengths."""
    p = _quoted(pattern)
    return f"""
  SELECT doc_id, text, {rank} AS rank, '{kind}' AS kind,
         list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0) AS s,
         list_sum(list_transform(gaps[1:i], lambda g: length(g))) + list_sum(list_transform(found[1:i], lambda m: length(m))) AS e
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i
        FROM (SELECT doc_id, text, regexp_extract_all(text, {p}) AS found, regexp_extract_all(text, {p}, {group}) AS part,
                     regexp_split_to_array(text, {p}) AS gaps FROM docs))
  WHERE length(part[i]) >= {least}"""


_KINDS = ", ".join(_quoted(r.kind) for r in secrets.BASE)

SECRETS = f"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({' UNION ALL '.join(_secret_rule(i, r.kind, r.pattern, r.group, max(r.least, 1)) for i, r in enumerate(secrets.RULES))}),
listed AS (
  SELECT doc_id, text,
         count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank, e) FILTER (kind IN ({_KINDS})) AS base,
         string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank, e) AS every
  FROM spans GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM documents d LEFT JOIN listed l ON d.doc_id IS NOT DISTINCT FROM l.doc_id AND coalesce(d.text, '') = l.text
"""

TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * r.v[i]))::BIGINT AS score
  FROM whole q JOIN whole r ON q.vec_id % 100 = 0 AND r.vec_id <> q.vec_id AND len(q.v) = len(r.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _case(level: str) -> str:
    named, default = mixing.WEIGHTS[level]
    return "CASE " + level + "".join(f" WHEN '{k}' THEN {w}::DOUBLE" for k, w in named.items()) + f" ELSE {default}::DOUBLE END" if named else f"{default}::DOUBLE"


def _level(i: int) -> str:
    """Budgets of one level's nodes: children sorted by limit over weight, full ones first."""
    own = ", ".join(mixing.LEVELS[:i + 1])
    level, up = mixing.LEVELS[i], ", ".join(mixing.LEVELS[:i])
    by = f"PARTITION BY {up} " if up else ""
    parent = "CROSS JOIN whole" if i == 0 else f"JOIN budget{i - 1} USING ({up})"
    return f"""
nodes{i} AS (SELECT {own}, sum(tokens)::DOUBLE * {mixing.MAX_EPOCHS} AS cap, {_case(level)} AS weight FROM leaves GROUP BY {own}),
rates{i} AS (
  SELECT *, cap / weight AS ratio,
         (parent - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER ({by}) - coalesce(sum(weight) OVER before, 0)) AS rate
  FROM nodes{i} {parent} WINDOW before AS ({by}ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
budget{i} AS (
  SELECT {own}, CASE WHEN rate >= ratio THEN cap ELSE least(cap, weight * max(CASE WHEN rate < ratio THEN rate END) OVER ({by})) END AS parent
  FROM rates{i})"""


MIXING = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce('d' || (('0x' || substr(md5(source), 1, 8))::BIGINT % {mixing.DOMAINS}), '') AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens, md5(coalesce(text, '')) AS hash
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
whole AS (SELECT sum(tokens)::DOUBLE AS parent FROM leaves),
{','.join(_level(i) for i in range(len(mixing.LEVELS)))},
shared AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN floor(parent)::BIGINT // tokens ELSE 0 END AS whole,
         floor(parent)::BIGINT - CASE WHEN tokens > 0 THEN floor(parent)::BIGINT // tokens ELSE 0 END * tokens AS rest
  FROM leaves JOIN budget{len(mixing.LEVELS) - 1} USING (domain, lang, source)),
placed AS (
  SELECT *, substr(md5('{mixing.SEED}|' || whole || '|' || coalesce(doc_id::VARCHAR, '') || '|' || hash), 1, {mixing.ORDER_HEX}) AS place
  FROM docs JOIN shared USING (domain, lang, source)),
walked AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM placed)
SELECT doc_id, domain, lang, source, tokens, (whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS epochs FROM walked
"""


def _positions(source: str, column: str, pattern: str, extra: str) -> str:
    """(extra, s, e, m): matches of a pattern in a text column and where they stand."""
    p = _quoted(pattern)
    return f"""SELECT {extra}, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0) AS s,
         list_sum(list_transform(gaps[1:i], lambda g: length(g))) + list_sum(list_transform(found[1:i], lambda m: length(m))) AS e, found[i] AS m
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i
        FROM (SELECT *, regexp_extract_all({column}, {p}) AS found, regexp_split_to_array({column}, {p}) AS gaps FROM {source}))"""


_PII = {  # the base patterns as they are, and what makes a match valid
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda x: try_cast(x AS HUGEINT) IS NULL OR try_cast(x AS HUGEINT) > 255)) = 0"),
    "card": (r"[0-9]([\x20-]?[0-9])+", "length(d) BETWEEN 14 AND 19 AND luhn % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 10 AND 15"),
}
_LUHN = """list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse(d), i, 1)::INT
  WHEN substr(reverse(d), i, 1)::INT > 4 THEN 2 * substr(reverse(d), i, 1)::INT - 9 ELSE 2 * substr(reverse(d), i, 1)::INT END))"""
_TERM = r"[\p{L}\p{N}]+"

PII = f"""
WITH texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
{', '.join(f"""m_{k} AS ({_positions("texts", "text", p, "text")}),
e_{k} AS (SELECT text, {i} AS rank, '{k}' AS kind, s::BIGINT AS s, e::BIGINT AS e, m FROM (SELECT *, {_LUHN if k == 'card' else 0} AS luhn FROM (
  SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM m_{k})) WHERE {valid})""" for i, (k, (p, valid)) in enumerate(_PII.items()))},
ents AS ({' UNION ALL '.join(f'SELECT * FROM e_{k}' for k in _PII)}),
held AS (SELECT DISTINCT text, kind || ':' || lower(m) AS entity FROM ents),
words AS ({_positions("texts", "text", _TERM, "text")}),
places AS (
  SELECT text, s::BIGINT AS s, e::BIGINT AS e, lower(m) AS term FROM words w
  WHERE length(m) >= {pii.MIN_TERM} AND text IN (SELECT text FROM ents)
    AND NOT EXISTS (SELECT 1 FROM ents x WHERE x.text = w.text AND x.s < w.e AND x.e > w.s)),
pairs AS (SELECT entity, term, count(*) AS n_both FROM held JOIN (SELECT DISTINCT text, term FROM places) USING (text) GROUP BY ALL HAVING count(*) >= {pii.SUPPORT}),
vocabulary AS (SELECT term, count(*) AS n FROM (SELECT DISTINCT text, lower(m) AS term FROM words) GROUP BY term),
total AS (SELECT count(*)::DOUBLE AS n FROM texts),
known AS (SELECT entity, count(*) AS n_of FROM held GROUP BY entity),
told AS (
  SELECT entity, term FROM (
    SELECT entity, term, least(n_both / vocabulary.n, 1.0::DOUBLE) AS given, n_of / total.n AS p FROM pairs JOIN vocabulary USING (term) JOIN known USING (entity), total)
  WHERE least(ln(given / p) / greatest(-ln(p), 1e-9), 1.0) >= {pii.GENERALISE}),
spans AS (
  SELECT text, rank, kind, s, e FROM ents
  UNION ALL SELECT DISTINCT text, {len(_PII)}, 'term', s, e FROM places JOIN held USING (text) JOIN told USING (entity, term)),
listed AS (
  SELECT text, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _PII)},
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (kind <> 'term') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS every
  FROM spans GROUP BY text)
SELECT d.doc_id, {', '.join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in _PII)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM documents d LEFT JOIN listed l ON coalesce(d.text, '') = l.text
"""


def _codes_round(r: int) -> str:
    """Assignment under codebook ``r`` by every distance, and the codebook that follows."""
    near = f"""
near{r} AS MATERIALIZED (
  SELECT rid, p, min({{'far': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS got
  FROM pieces JOIN book{r} USING (p) GROUP BY rid, p)"""
    if r == code_books.ROUNDS:
        return near
    return near + f""",
sums{r} AS MATERIALIZED (
  SELECT p, got.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
  FROM (SELECT p, got, x, unnest(range(1, len(x) + 1)) AS i FROM pieces JOIN near{r} USING (rid, p)) GROUP BY p, got.e, i),
book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b
  LEFT JOIN (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums{r} GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""


# Vectors of one length that the number of parts divides, as in the tables.
CODES = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor({code_books.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pieces AS MATERIALIZED (
  SELECT rid, p, v[p * len(v) // {code_books.PARTS} + 1:(p + 1) * len(v) // {code_books.PARTS}] AS x
  FROM (SELECT *, unnest(range(0, {code_books.PARTS})) AS p FROM kept)),
book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x AS c FROM pieces WHERE rid <= {code_books.ENTRIES}),
{', '.join(_codes_round(r) for r in range(code_books.ROUNDS + 1))},
final AS (SELECT string_agg(array_to_string(c, ','), ',' ORDER BY p, e) AS every FROM book{code_books.ROUNDS}),
coded AS (
  SELECT rid, string_agg(printf('%02x', got.e::INTEGER), '' ORDER BY p) AS code, sum(got.far)::BIGINT AS error FROM near{code_books.ROUNDS} GROUP BY rid)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, sha256(every) AS codebooks_sha256
FROM coded JOIN kept USING (rid) CROSS JOIN final
"""

_LETTERS = "abcdefghijklmnopqrstuvwxyz"

# Runs are kept once for a document, with their count; crc32 goes over a run's bytes by a table of the usual polynomial.
SPELLING = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, list_transform(range(8), lambda k: 0::BIGINT)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_LETTERS.upper()}', '{_LETTERS}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
counted AS MATERIALIZED (
  SELECT run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h
  FROM runs WHERE length(run) >= {spelling.SHORTEST} GROUP BY doc_id, run),
hashed AS MATERIALIZED (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2),
           lambda i: 16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)),
         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS h FROM counted CROSS JOIN crc),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % {spelling.DROP} = 0 THEN run[1:(h % length(run))] || run[(h % length(run)) + 2:length(run)] ELSE run END AS word FROM hashed)
  WHERE length(word) >= {spelling.SHORTEST} GROUP BY word HAVING sum(n) >= {spelling.LEAST}),
gaps AS MATERIALIZED (
  SELECT word, i, word[1:i - 1] || word[i + 1:length(word)] AS gap FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word FROM gaps g JOIN words w ON w.word = g.gap
  UNION SELECT w.word, g.word FROM gaps g JOIN words w ON w.word = g.gap),
best AS (
  SELECT near.word, count(*) AS n_near, min({{'less': -o.n, 'w': o.word}}) AS b FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= {spelling.RATIO} * n THEN b.w END AS form,
         CASE WHEN -b.less >= {spelling.RATIO} * n THEN -b.less END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (
  SELECT word, form AS root, 1 AS steps FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT walk.word, f.form, steps + 1 FROM walk JOIN forms f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT word, form, coalesce(r.root, word) AS root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM forms LEFT JOIN (SELECT word, arg_max(root, steps) AS root FROM walk GROUP BY word) r USING (word)
"""
