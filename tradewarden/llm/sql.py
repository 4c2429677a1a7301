"""DuckDB counterparts of the operators that SQL can express on whole tables."""

from __future__ import annotations

# Links in both directions -> smallest id that each id reaches.
REACHED = """reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT id, MIN(other) AS component_id FROM reach GROUP BY id)"""

OP1 = """WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(FLOOR(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * x.e[i])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 20 = 0 AND x.vec_id <> q.vec_id AND len(x.e) = len(q.e)),
r AS (SELECT query_id, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""

OP6 = f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings),
{REACHED}
SELECT e.vec_id, (SELECT COUNT(*) FROM links WHERE a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON id = e.vec_id"""

DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP9 = f"""WITH p AS (SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes, sha1(COALESCE(html, '')) AS h FROM pages),
f AS (SELECT *, MIN(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('{DIGITS}',
    ((CAST('0x' || substr(h, (5 * i) // 4 + 1, 2) AS INTEGER) >> (3 - (5 * i) % 4)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""

OP10 = f"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, UNNEST(list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
  FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, COUNT(*) AS n FROM g GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS k FROM g x JOIN g y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
nodes AS (SELECT doc_id AS id FROM documents),
{REACHED}
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

def _length_written(role: str, text: str) -> str:
    """Code points of a turn: marks and line breaks, the role with its escapes, the text with one more for each control string."""
    return f"""16 + length(replace(replace(replace({role}, '\\', '\\\\'), chr(10), '\\n'), '<', '\\l')) + length({text})
      + (length({text}) - length(replace({text}, '<turn>', ''))) // 6 + (length({text}) - length(replace({text}, '</turn>', ''))) // 7"""


OP11 = f"""WITH t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(SUM({_length_written('role', 'text')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

OP13 = """WITH p AS (SELECT COALESCE(lang, 'und') AS lang, UNNEST(string_split_regex(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM p),
g AS (SELECT lang, k, UNNEST(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS lengths(k)),
f AS (SELECT lang, k, phrase, COUNT(*) AS n FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, n, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND n >= 10),
inside AS (SELECT lang, array_to_string(s[j:j + 1], ' ') AS phrase, MAX(n) AS longer FROM c, (VALUES (1), (2)) AS places(j) WHERE k = 3 GROUP BY ALL),
cuts AS (SELECT c.lang, c.phrase, c.n AS a, j, l.n AS l, r.n AS r, (CAST(1000000 AS HUGEINT) * c.n * c.n) // (CAST(l.n AS HUGEINT) * r.n) AS score
  FROM c JOIN (VALUES (1), (2)) AS places(j) ON j < c.k
  JOIN f l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(s[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(s[j + 1:c.k], ' ')
  LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase AND c.k = 2 WHERE longer IS NULL OR 100 * longer < 50 * c.n),
best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM cuts),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE o = 1),
n AS (SELECT lang, CAST(SUM(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

STATEMENTS = {"op1_top_k": OP1, "op6_embedding_dedup": OP6, "op9_warc": OP9, "op10_minhash": OP10, "op11_chat": OP11, "op13_phrases": OP13}
