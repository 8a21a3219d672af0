"""SQL counterparts, for DuckDB, of the queries that SQL can express on whole tables."""

from __future__ import annotations

_LETTERS = r"regexp_replace(lower(coalesce({c}, '')), '[^\p{{L}}\p{{N}}]', '', 'g')"

P5_FOUND = f"""
WITH t AS (SELECT comment_id, {_LETTERS.format(c='"评论内容"')} AS a, {_LETTERS.format(c='"一级评论"')} AS b FROM thread_comments),
k AS (SELECT comment_id, least(a, b) AS lo, greatest(a, b) AS hi FROM t WHERE length(a) + length(b) >= 12),
g AS (SELECT comment_id, min(comment_id) OVER (PARTITION BY lo, hi) AS first_id FROM k)
SELECT first_id, comment_id AS copy_id FROM g WHERE comment_id <> first_id
"""

ORACLES = {"p5_found": P5_FOUND}
