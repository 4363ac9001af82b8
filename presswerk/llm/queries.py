"""Queries of the corpus operators and, where SQL can express them, their oracle statements."""

from __future__ import annotations

from presswerk.llm.answers import p3_found
from presswerk.llm.blocks import p4_found
from presswerk.llm.language import p6_found
from presswerk.llm.leaks import p8_found
from presswerk.llm.mixing import p9_mix, p9_shares
from presswerk.llm.near_copies import p2_classes, p2_found
from presswerk.llm.repeated_lines import p1_cleaned, p1_found
from presswerk.llm.spam import p10_found
from presswerk.llm.survivors import p5_current, p5_found

_LINES = r"""
l AS (SELECT DISTINCT id, source, unnest(range(1, len(parts) + 1)) - 1 AS line_no, unnest(parts) AS line FROM
      (SELECT id, source, string_split(content, chr(10)) AS parts FROM articles
       WHERE id IS NOT NULL AND source IS NOT NULL AND content IS NOT NULL AND lower(trim(content)) NOT IN ('', 'none', 'nan'))),
k AS (SELECT id, source, CAST(line_no AS INTEGER) AS line_no, regexp_replace(lower(upper(line)), '[\s\p{Z}\p{Nd}]+', '', 'g') AS key FROM l
      WHERE regexp_replace(line, '[\s\p{Z}]+', '', 'g') <> ''),
n AS (SELECT source, count(DISTINCT id) AS docs FROM articles WHERE source IS NOT NULL GROUP BY source),
r AS (SELECT k.source, key FROM k JOIN n USING (source) GROUP BY k.source, key, docs HAVING count(DISTINCT id) >= 8 AND count(DISTINCT id) >= 0.04 * docs)
"""
P1_FOUND = f"WITH {_LINES} SELECT DISTINCT id, line_no FROM k JOIN r USING (source, key)"
P1_CLEANED = f"""WITH {_LINES},
f AS (SELECT DISTINCT id, line_no FROM k JOIN r USING (source, key)),
a AS (SELECT id, min(content) AS content FROM articles GROUP BY id),
p AS (SELECT id, unnest(range(1, len(parts) + 1)) - 1 AS line_no, unnest(parts) AS line FROM (SELECT id, string_split(content, chr(10)) AS parts FROM a)),
c AS (SELECT p.id, coalesce(string_agg(line, chr(10) ORDER BY p.line_no) FILTER (WHERE f.id IS NULL), '') AS content FROM p LEFT JOIN f ON p.id = f.id AND p.line_no = f.line_no GROUP BY p.id)
SELECT a.id, CASE WHEN a.content IS NULL THEN NULL ELSE c.content END AS content FROM a LEFT JOIN c USING (id)"""

QUERIES = {"p1_found": p1_found, "p1_cleaned": p1_cleaned, "p2_found": p2_found, "p2_classes": p2_classes, "p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p5_current": p5_current, "p6_found": p6_found, "p8_found": p8_found, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found}
ORACLES = {"p1_found": P1_FOUND, "p1_cleaned": P1_CLEANED}
