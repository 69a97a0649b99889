"""DuckDB SQL for the corpus queries whose result SQL can express, by plain
definitions: all windows counted, all pairs compared, all lines listed."""

from __future__ import annotations

from moodframe.llm import lines, neardup, pii, substrings

_L = substrings.LENGTH

#: Every window of the hexadecimal bytes by its hash.
SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
starts AS (SELECT doc_id, h, unnest(range(0, n - {_L - 1})) AS p FROM n WHERE n >= {_L}),
windows AS (SELECT doc_id, p, hash(substr(h, 2 * p + 1, {2 * _L})) AS w FROM starts),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
marked AS (SELECT doc_id, p FROM windows WHERE w IN (SELECT w FROM twice)),
steps AS (SELECT doc_id, p, p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {_L} AS apart FROM marked),
runs AS (SELECT doc_id, p, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps),
spans AS (SELECT doc_id, min(p) AS b, max(p) + {_L} AS e FROM runs GROUP BY doc_id, run),
per AS (SELECT doc_id, sum(e - b) AS removed, count(*) AS spans FROM spans GROUP BY doc_id),
edges AS (
  SELECT doc_id, lag(e, 1, 0) OVER w AS b, b AS e FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY b)
  UNION ALL SELECT n.doc_id, coalesce(max(s.e), 0), n.n FROM n LEFT JOIN spans s USING (doc_id) GROUP BY n.doc_id, n.n),
kept AS (SELECT e.doc_id, string_agg(substr(n.h, 2 * e.b + 1, 2 * (e.e - e.b)), '' ORDER BY e.b) AS h
  FROM edges e JOIN n USING (doc_id) GROUP BY e.doc_id)
SELECT n.doc_id, n.n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(kept.h)) AS kept_sha256, n.n - CAST(coalesce(removed, 0) AS BIGINT) AS n_kept, coalesce(removed, 0) > 0 AS repeated
FROM n LEFT JOIN per USING (doc_id) JOIN kept USING (doc_id)
"""

_K = neardup.WORDS

#: All pairs of documents that share a labelled k-mer, and what links connect.
NEARDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, i, CASE WHEN len(w) < {_K} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {_K - 1}], ' ') END AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {_K - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
l AS (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS o FROM k),
n AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM l a JOIN l b ON a.k = b.k AND a.o = b.o AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE c.c >= {neardup.THRESHOLD} * (x.n + y.n - c.c)
  UNION SELECT a.doc_id, b.doc_id FROM documents a JOIN documents b ON a.text = b.text AND a.doc_id < b.doc_id),
paths AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, t.b FROM reach r JOIN paths t ON r.b = t.a)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE min(r.b) END AS class_id, d.text IS NULL OR min(r.b) = d.doc_id AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, d.text
"""

#: Every shortest qualifying run of repeated lines as one string.
LINES = f"""
WITH x AS (SELECT doc_id, u.i - 1 AS pos, u.line, len(regexp_extract_all(u.line, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS u(line, i)),
many AS (SELECT line FROM x GROUP BY line HAVING count(*) > 1),
r AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM x WHERE line IN (SELECT line FROM many)),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, run ORDER BY pos) AS total FROM r),
ends AS (SELECT a.doc_id, a.pos, min(b.pos) AS last FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.run = b.run AND b.pos >= a.pos
  AND b.total >= a.total - a.words + {lines.MIN_WORDS} WHERE a.words > 0 GROUP BY ALL),
windows AS (SELECT e.doc_id, e.pos, e.last, string_agg(x.line, chr(10) ORDER BY x.pos) AS run, e.last - e.pos + 1 AS n
  FROM ends e JOIN x ON x.doc_id = e.doc_id AND x.pos BETWEEN e.pos AND e.last GROUP BY ALL),
firsts AS (SELECT run, min({{'doc_id': doc_id, 'pos': pos}}) AS f FROM windows GROUP BY run HAVING count(*) > 1),
later AS (SELECT w.doc_id, CASE WHEN f.doc_id = w.doc_id THEN greatest(w.pos, f.pos + n) ELSE w.pos END AS b, w.last AS e
  FROM windows w JOIN firsts USING (run) WHERE f.doc_id <> w.doc_id OR f.pos <> w.pos),
gone AS (SELECT DISTINCT doc_id, unnest(range(b, e + 1)) AS pos FROM later)
SELECT d.doc_id, CASE WHEN count(g.pos) = 0 THEN any_value(d.text)
    ELSE coalesce(string_agg(x.line, chr(10) ORDER BY x.pos) FILTER (g.pos IS NULL), '') END AS text,
  count(*) AS lines, count(g.pos) AS lines_removed
FROM documents d JOIN x USING (doc_id) LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.pos = x.pos GROUP BY d.doc_id
"""

_SPACE = r"[\s\x{00A0}]+"

#: The article by patterns, for pages that mark it and whose blocks are p and h1.
HTML = rf"""
WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)(</article>|$)', 1), '') AS h FROM pages),
b AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(h, '{_SPACE}', ' ', 'g'), '</?(p|h1)>', chr(10), 'g'), '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), chr(10)) AS l FROM a),
c AS (SELECT page_id, url, list_transform(l, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
      '&nbsp;', ' '), '&amp;', '&'), '{_SPACE}', ' ', 'g'))) AS l FROM b),
t AS (SELECT page_id, url, array_to_string(list_filter(l, lambda x: x <> ''), chr(10)) AS text FROM c)
SELECT page_id, url, text, length(text) AS n_chars FROM t
"""


def _matches(kind: str, place: int, pattern: str, valid: str, prior: int, hint: str) -> str:
    """Matches of a pattern with their places, from the pieces between them, and
    their scores in percent."""
    return f"""
SELECT doc_id, {place} AS place, '{kind}' AS kind, m, b, b + length(m) AS e,
  {prior} + CASE WHEN regexp_matches(substr(text, greatest(1, b - 47)::BIGINT, least(b, 48)::BIGINT), '(?i){hint}') THEN 20 ELSE 0 END AS score FROM (
  SELECT doc_id, text, m, regexp_replace(m, '[^0-9]', '', 'g') AS digits,
    sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) + coalesce(sum(length(m)) OVER (
      PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM (SELECT doc_id, text, unnest(regexp_extract_all(text, '{pattern}')) AS m, unnest(regexp_split_to_array(text, '{pattern}')) AS piece,
          unnest(range(0, 1 + len(regexp_extract_all(text, '{pattern}')))) AS i FROM t)
  ) WHERE m IS NOT NULL AND {valid}"""


_LUHN = """length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(0, length(digits)), lambda k: CASE
  WHEN k % 2 = 0 THEN substr(digits, length(digits) - k, 1)::INT
  WHEN substr(digits, length(digits) - k, 1)::INT > 4 THEN substr(digits, length(digits) - k, 1)::INT * 2 - 9
  ELSE substr(digits, length(digits) - k, 1)::INT * 2 END)) % 10 = 0"""
_BYTES = "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(x AS INT), 256) > 255)) = 0"

_SECRET = (r"(?i:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential)"
           r"[\"'']?[\x20\t]{0,3}[:=][\x20\t]{0,3}[\"'']?[A-Za-z0-9+/_=-]{16,}")
_VALUE = r"regexp_extract(m, '[A-Za-z0-9+/_=-]{16,}$')"

#: The four base kinds and assigned secrets; the other kinds that the method adds
#: need look-behind or more than patterns, and the generated documents hold none of them.
PII = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({' UNION ALL '.join((
    _matches('email', 1, r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', 'true', 80, 'mail|contact|write|@'),
    _matches('ip', 2, r'[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)', _BYTES, 60, r'\bip\b|address|host|server|login'),
    _matches('card', 3, r'[0-9](?:[\x20-]?[0-9])+', _LUHN, 80, 'card|visa|master|credit|payment|cvv'),
    _matches('phone', 4, r'\+[0-9][\x20().0-9-]+[0-9]', 'length(digits) BETWEEN 9 AND 15', 60, r'phone|\btel\b|call|mobile|fax|contact'),
    _matches('secret', 7, _SECRET, f"len(list_distinct(string_split({_VALUE}, ''))) >= {pii.RANDOM} AND regexp_matches({_VALUE}, '[0-9]')",
             60, 'api|auth|login|config|env')))}),
j AS (SELECT doc_id, string_agg(kind || ':' || b::BIGINT || ':' || e::BIGINT, ',' ORDER BY place, b) AS spans,
  string_agg(kind || ':' || b::BIGINT || ':' || e::BIGINT, ',' ORDER BY place, b) FILTER (place <= 4) AS base,
  string_agg(score::VARCHAR, ',' ORDER BY place, b) AS scores,
  count_if(place = 1) AS n1, count_if(place = 2) AS n2, count_if(place = 3) AS n3, count_if(place = 4) AS n4 FROM s GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n1, 0) AS BIGINT) AS n_email, CAST(coalesce(n2, 0) AS BIGINT) AS n_ip, CAST(coalesce(n3, 0) AS BIGINT) AS n_card,
  CAST(coalesce(n4, 0) AS BIGINT) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM t LEFT JOIN j USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, url,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, {_TERMS} AS terms FROM documents),
s AS (SELECT doc, doc_id, len(terms)::BIGINT AS n FROM d),
t AS (SELECT count(*) FILTER (n > 0) AS docs, sum(n)::BIGINT AS length FROM s),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, t GROUP BY term),
scored AS (SELECT item_id, doc_id, doc,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN s USING (doc), t GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, doc)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
