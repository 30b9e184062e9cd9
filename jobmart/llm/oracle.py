"""DuckDB SQL for the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

SPACES = r"\x20\x09-\x0D"
#: chr(9) to chr(13) and the space: what is cut from both ends of a line. Fixed value.
MARGIN = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op7_line_dedup": f"""
        WITH split AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
            FROM documents
        ), keyed AS (
            SELECT doc_id, place, line, translate(trim(line, {MARGIN}), '{UPPER}', '{LOWER}') AS key FROM split
        ), frequent AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
            SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
}
