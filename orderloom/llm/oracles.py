"""SQL equivalents, where SQL can say it."""


def _clusters(rounds: int) -> str:
    """Rounds of assignment and floored means, written out one after the other."""
    parts = [
        """kept AS MATERIALIZED (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
            FROM embeddings
            WHERE len(embedding) = 64
              AND len([x for x in embedding if x IS NOT NULL AND isfinite(CAST(x AS DOUBLE))]) = 64
        )""",
        "cells AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS i, unnest(v) AS x FROM kept)",
        """seeds AS (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v
            FROM kept ORDER BY c LIMIT 8
        )""",
        "c0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS i, unnest(v) AS y FROM seeds)",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
            SELECT vec_id, c, d FROM (
                SELECT vec_id, c, sum((x - y) * (x - y)) AS d FROM cells JOIN c{r} USING (i) GROUP BY vec_id, c
            ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1
        )""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
                SELECT old.c, old.i, coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), old.y) AS y
                FROM c{r} old
                LEFT JOIN (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN cells USING (vec_id) GROUP BY c, i) new
                  ON old.c = new.c AND old.i = new.i
            )""")
    return f"""
        WITH {", ".join(parts)},
        names AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS name FROM c{rounds} GROUP BY c)
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia,
               name AS centroid_sha256
        FROM a{rounds} JOIN names USING (c)
    """


ORACLES = {
    "op2_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
            FROM pages
        ),
        fives AS (
            SELECT *, [CAST('0x' || substr(digest, 1 + 10 * g, 10) AS BIGINT) for g in range(4)] AS groups FROM payloads
        )
        SELECT page_id,
               octet_length(encode(payload)) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((groups[1 + j // 8] >> (35 - 5 * (j % 8))) & 31), 1)
                                for j in range(32)], '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM fives
    """,
    "op12_lexical_search": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL
        ),
        counted AS (SELECT doc_id, terms, len(terms) AS doc_terms FROM split WHERE len(terms) > 0),
        total AS (SELECT count(*) AS docs, CAST(sum(doc_terms) AS BIGINT) AS all_terms FROM counted),
        tfs AS (
            SELECT doc_id, doc_terms, term, count(*) AS tf
            FROM (SELECT doc_id, doc_terms, unnest(terms) AS term FROM counted) GROUP BY doc_id, doc_terms, term
        ),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tfs, total GROUP BY term, docs
        ),
        asked AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term),
        scored AS (
            SELECT item_id, doc_id,
                   CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * doc_terms * docs) // all_terms)))) AS BIGINT) AS score
            FROM wanted JOIN weights USING (term) JOIN tfs USING (term), total
            GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY rank <= 10
    """,
    "op13_centroid_clustering": _clusters(10),
}
