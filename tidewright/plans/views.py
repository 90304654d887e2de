"""The views of ``sources/tables.py`` in SQL, and the prefix that names those a statement needs."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "docs": "SELECT *, TRY_CAST(substring(source, 4) AS INT) AS n FROM documents",
    "source_policy": """SELECT source_id, n, (['full_snapshot_allowed','excerpt_only','metadata_only','do_not_collect'])[n % 4 + 1] AS archive_policy,
        CASE WHEN (n // 4) % 2 = 0 THEN 'allowed_public_data_only' ELSE 'always_prohibited' END AS cloud_policy,
        (['allowed','manual_review_required','prohibited'])[n % 3 + 1] AS llm_policy
        FROM (SELECT DISTINCT source AS source_id, n FROM docs) WHERE source_id <> 'src19'""",
    "hashed": "SELECT *, sha256(coalesce(text, '')) AS content_hash FROM docs",
    "snapshot": "SELECT content_hash, min(doc_id) AS first_doc, 'snap_' || min(doc_id) AS snap_id FROM hashed GROUP BY content_hash",
    "doc_source_edge": "SELECT h.source AS source_id, h.doc_id, s.snap_id, s.first_doc FROM hashed h JOIN snapshot s USING (content_hash)",
    "snapshot_allowed": """SELECT snap_id, first_doc, coalesce(bool_and(coalesce(p.archive_policy = 'full_snapshot_allowed' AND p.cloud_policy = 'allowed_public_data_only', false)), false) AS allowed
        FROM doc_source_edge e LEFT JOIN source_policy p USING (source_id) GROUP BY snap_id, first_doc""",
    "keyed_snapshot": "SELECT snap_id, first_doc, 'permitted_artifact/snapshot/' || snap_id AS object_key FROM snapshot_allowed WHERE allowed OR first_doc % 11 = 0",
    "upload_audit": """SELECT 'pdec_' || first_doc AS decision_id,
        CASE WHEN first_doc % 7 <= 3 THEN 'uploaded' WHEN first_doc % 7 = 4 THEN 'set_r2_key_failed_neo4j' ELSE 'skipped_toctou' END AS decision,
        CASE WHEN first_doc % 5 <> 0 THEN snap_id END AS snap_id,
        CASE WHEN first_doc % 13 = 0 THEN 'no id here' ELSE 'snap_id=' || CASE WHEN first_doc % 17 = 0 THEN 'snap_x' || first_doc ELSE snap_id END || '; archive_policy=full_snapshot_allowed; raw_cloud_policy=allowed_public_data_only' END AS rationale,
        'att_' || first_doc AS attempt_id, first_doc FROM snapshot WHERE first_doc % 7 < 6""",
    "run_ledger": """SELECT event_id AS run_id, ts AS completed_at, 'vendor' || (user_id % 3) AS vendor, CAST(props->>'$.k' AS INT) % 4 AS tier, event_type AS stage,
        CASE event_type WHEN 'view' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'completed' END AS status,
        CASE WHEN event_type = 'view' OR (event_type = 'error' AND event_id % 2 = 1) THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS cost_e4,
        user_id AS session_id, event_id * 37 % 5000 AS input_tokens, event_id * 13 % 3000 AS cached_tokens, event_id * 7 % 900 AS output_tokens, event_id * 3 % 400 AS creation_tokens FROM events""",
    "crawl_log": """SELECT 'u' || user_id AS source_id, ts, event_id, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'not_modified' ELSE 'ok' END AS outcome,
        CASE WHEN event_type = 'purchase' THEN 'W/' || event_id END AS etag FROM events""",
    "queue": """SELECT p.page_id AS queue_id, 'src' || (p.page_id % 20) AS source_id, p.url, p.html, (['pending','processing','done','error'])[p.page_id % 4 + 1] AS status, e.ts AS discovered_at
        FROM pages p LEFT JOIN events e ON e.event_id = p.page_id""",
    "intervention": """SELECT event_id AS intervention_id, 'sess_' || (user_id % 10) AS session_id, 'src' || (user_id % 20) AS source_id, (['inline_block','inline_warn','batch_report'])[user_id % 3 + 1] AS gate_mode,
        value / 200 AS importance, event_id % 2 = 1 AS linked, ts AS created_at, CASE WHEN event_id % 5 = 0 THEN 'resolved_ignore' ELSE 'pending_user_review' END AS status FROM events WHERE event_type = 'error'""",
    "claim_quote": """SELECT 'clm_' || doc_id AS claim_id, doc_id, source, n, text,
        substring(coalesce(text, ''), CAST(doc_id % 50 + 1 AS BIGINT), 80) || CASE WHEN doc_id % 20 = 0 THEN '~~' ELSE '' END AS quote, doc_id * 37 % 101 AS confidence_pct,
        (['supporting','opposing','monitoring','context'])[doc_id % 4 + 1] AS role, 'ths_' || (doc_id // 10) AS thesis_id FROM docs""",
}


def sql(body: str) -> str:
    """``body`` (which may begin with WITH or WITH RECURSIVE) after the views that it names."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(view)
                needed.append(name)

    need(body)
    body = body.strip()
    own = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    recursive = "RECURSIVE " if own and own[1] else ""
    head = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    if not needed:
        return body
    return f"WITH {recursive}{head}" + (f",\n{body[own.end() :]}" if own else f"\n{body}")
