"""DuckDB twins of the queries that SQL can express, over the whole sample tables.

The others have none: tokens, packing, token files, languages and model scores are compared with the tokenizers library, brute
force, round trips and held-out quality in the tests.
"""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LABELS = """
    reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
    label AS (SELECT a, min(b) AS least FROM reach GROUP BY a)"""


def _escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '\\', '\\s'), '#', '\\h'), '<', '\\l')"


ORACLES: dict[str, str] = {
    "op1_ngram_join": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'),
                                       lambda x: x <> '') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 1),
                                      lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
        grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y
            ON x.g = y.g AND x.doc_id < y.doc_id AND 10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n)
            GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
        both_ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),{_LABELS}
        SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id,
               (SELECT count(*) FROM both_ways WHERE a = doc_id) AS n_links
        FROM sets LEFT JOIN label ON a = doc_id""",
    "op3_near_vectors": f"""
        WITH RECURSIVE sound AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y
                  ON x.vec_id < y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
        both_ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),{_LABELS}
        SELECT vec_id, (SELECT count(*) FROM both_ways WHERE a = vec_id) AS n_links,
               least(vec_id, coalesce(least, vec_id)) AS component_id, coalesce(least, vec_id) >= vec_id AS kept
        FROM embeddings LEFT JOIN label ON a = vec_id""",
    "op5_top_k": """
        WITH sound AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        terms AS (SELECT vec_id, unnest(w) AS x, generate_subscripts(w, 1) AS t FROM sound),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
            FROM terms q JOIN terms c ON q.t = c.t AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id),
        ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
                          AS "rank", vec_id, score FROM scored)
        SELECT * FROM ranked WHERE "rank" <= 5""",
    "op6_chat": f"""
        WITH rows_ AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
        placed AS (
            SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id, alone) AS n
            FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM rows_) a
            WINDOW w AS (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text)),
        summed AS (
            SELECT *, sum(length('### : </turn>') + 2 + length(replace({_escaped("role")}, ':', '\\c')) + length({_escaped("text")}))
                      OVER (PARTITION BY conv_id, alone ORDER BY i ROWS UNBOUNDED PRECEDING) AS so_far
            FROM placed)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(so_far) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
        FROM summed GROUP BY conv_id, alone""",
    "op7_lines": f"""
        WITH split AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS own
                       FROM documents),
        lines AS (SELECT r, doc_id, unnest(own) AS line, generate_subscripts(own, 1) AS i FROM split),
        keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS k FROM lines),
        shared AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(s.k) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (s.k IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN shared s USING (k) GROUP BY r""",
    "op11_fill_middle": """
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
        drawn AS (
            SELECT doc_id, t, length(t) AS n, ('0x' || d[1:8])::BIGINT % (length(t) + 1) AS a,
                   ('0x' || d[9:16])::BIGINT % (length(t) + 1) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR ('0x' || d[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                        WHEN ('0x' || d[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM texts),
        cut AS (SELECT *, t[:least(a, b)] AS prefix, t[least(a, b) + 1:greatest(a, b)] AS middle,
                       t[greatest(a, b) + 1:] AS suffix FROM drawn)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM cut""",
}
