"""DuckDB SQL of the llm queries that SQL can express."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit (reflected polynomial 0xEDB88320)."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(acc, b), range(8)::UBIGINT[]), lambda c, i: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda d: ascii(d)::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda acc, b: {byte}), 4294967295::UBIGINT)"


def merkle_sql() -> str:
    def enc(value: str) -> str:
        return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(enc(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    def climb(name: str, base: str) -> str:
        return f"""{name} AS (
  SELECT run, 0 AS lvl, pos, node, total FROM {base}
  UNION ALL
  SELECT run, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (total + 1) // 2
  FROM {name} WHERE total > 1 GROUP BY run, lvl, pos // 2, total)"""
    return f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS run, {leaf('n_chars')} AS node,
         CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 7 = 0 THEN {leaf('n_chars + 1')} ELSE {leaf('n_chars')} END AS used
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS FIRST, node) - 1 AS pos,
         count(*) OVER (PARTITION BY run) AS total,
         row_number() OVER (ORDER BY run, doc_id NULLS FIRST, node) AS rid
  FROM rows),
{climb('tree', 'leaves')},
subroots AS (
  SELECT '' AS run, run AS lang_run, node, row_number() OVER (ORDER BY run) - 1 AS pos, count(*) OVER () AS total
  FROM tree WHERE total = 1),
{climb('over', 'subroots')},
steps AS (
  SELECT l.rid, 0 AS part, t.lvl, (l.pos >> t.lvl) & 1 AS side, t.node
  FROM leaves l JOIN tree t ON t.run = l.run AND t.pos = xor(l.pos >> t.lvl, 1)
  UNION ALL
  SELECT l.rid, 1, o.lvl, (s.pos >> o.lvl) & 1, o.node
  FROM leaves l JOIN subroots s ON s.lang_run = l.run JOIN over o ON o.pos = xor(s.pos >> o.lvl, 1)),
shape AS (
  SELECT l.rid, l.used, hl.h AS h0, (SELECT max(lvl) FROM over) AS h1
  FROM leaves l JOIN (SELECT run, max(lvl) AS h FROM tree GROUP BY run) hl ON hl.run = l.run),
fold AS (
  SELECT rid, 0 AS done, used AS node, h0, h1 FROM shape
  UNION ALL
  SELECT f.rid, f.done + 1,
         sha256(CASE WHEN s.side = 1 THEN s.node || f.node WHEN s.side = 0 THEN f.node || s.node ELSE f.node END),
         f.h0, f.h1
  FROM fold f LEFT JOIN steps s ON s.rid = f.rid AND s.part = CASE WHEN f.done < f.h0 THEN 0 ELSE 1 END
       AND s.lvl = CASE WHEN f.done < f.h0 THEN f.done ELSE f.done - f.h0 END
  WHERE f.done < f.h0 + f.h1)
SELECT l.doc_id, l.node AS leaf, s.node AS subroot, r.node AS root,
       sha256(coalesce((SELECT string_agg(p.node, '' ORDER BY p.part, p.lvl) FROM steps p WHERE p.rid = l.rid), ''))
         AS proof_sha256,
       f.node AS folded_root, f.node = r.node AS verified
FROM leaves l JOIN subroots s ON s.lang_run = l.run JOIN (SELECT node FROM over WHERE total = 1) r ON true
     JOIN fold f ON f.rid = l.rid AND f.done = f.h0 + f.h1
"""


def warc_sql() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT body, max(page_id) AS first FROM p WHERE strlen(body) >= 1000 GROUP BY body)
SELECT p.page_id, strlen(p.body) AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN g.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first <> p.page_id THEN g.first END AS refers_to
FROM p LEFT JOIN g ON g.body = p.body"""
