"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

LLM_ORACLE_SQL: dict[str, str] = {
    "op4_containment": """
        WITH item AS (
            SELECT DISTINCT item_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM benchmark
        ), item_run AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS run
            FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM (SELECT item_id, w, least(len(w), 5) AS n FROM item WHERE len(w) > 0))
        ), doc AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), doc_run AS (
            SELECT DISTINCT doc_id, n, array_to_string(w[i : i + n - 1], ' ') AS run
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM item_run))
        ), shared AS (
            SELECT doc_id, item_id, count(*) AS k FROM doc_run JOIN item_run USING (n, run) GROUP BY ALL
        )
        SELECT doc_id, item_id, CAST(k AS INTEGER) AS n_shared, CAST(m AS INTEGER) AS n_item, k / m AS containment
        FROM shared JOIN (SELECT item_id, count(*) AS m FROM item_run GROUP BY ALL) USING (item_id)
        WHERE k / m >= 0.8 - 1e-9
    """,
    "op6_substring_dedup": """
        WITH doc AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), run AS (
            SELECT doc_id, i, sha256(array_to_string(w[i : i + 19], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM doc)
        ), later AS (
            SELECT doc_id, i FROM run JOIN (SELECT h, min({'d': doc_id, 'i': i}) AS first FROM run GROUP BY h HAVING count(*) > 1) USING (h)
            WHERE {'d': doc_id, 'i': i} <> first
        ), gone AS (
            SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id
        ), word AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM doc SEMI JOIN gone USING (doc_id)
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
            FROM word ANTI JOIN (SELECT doc_id, unnest(gone) AS p FROM gone) USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
            sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
        FROM doc LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op8_ball_tree": """
        WITH good AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM good q JOIN good c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_fill_in_middle": """
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l, sha256('7:' || doc_id) AS d
            FROM documents
        ), drawn AS (
            SELECT doc_id, t, l, len(l) AS n, ('0x' || d[1:8])::BIGINT % (len(l) + 1) AS h1, ('0x' || d[9:16])::BIGINT % (len(l) + 1) AS h2,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                     WHEN ('0x' || d[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM cut
        ), parts AS (
            SELECT doc_id, t, n, form, array_to_string(l[1 : least(h1, h2)], '') AS p,
                array_to_string(l[least(h1, h2) + 1 : greatest(h1, h2)], '') AS m, array_to_string(l[greatest(h1, h2) + 1 :], '') AS s
            FROM drawn
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM parts
    """,
}
