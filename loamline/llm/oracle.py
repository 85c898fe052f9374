"""DuckDB twins of the operators that their contracts fix in full."""

from __future__ import annotations

ORACLE = {
    "op1_substring_dedup": r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        grams AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h
                  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
        firsts AS (SELECT h, min(doc_id) AS first FROM grams GROUP BY h),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM grams JOIN firsts USING (h) WHERE first < doc_id),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept, count(*) AS n
                 FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d) ANTI JOIN gone USING (doc_id, k)
                 GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_suffix_dedup": r"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
        blocks AS (SELECT doc_id, b, len(t) // 2 AS n, substr(t, CAST(512 * b + 1 AS BIGINT), 710) AS s
                   FROM (SELECT doc_id, t, unnest(range(0, (len(t) // 2 + 255) // 256)) AS b FROM d)),
        bytes AS (SELECT doc_id, 256 * b + j AS i, substr(s, CAST(2 * j - 1 AS BIGINT), 2) AS byte,
                         CASE WHEN 256 * b + j + 99 <= n THEN md5(substr(s, CAST(2 * j - 1 AS BIGINT), 200)) END AS h
                  FROM (SELECT *, unnest(range(1, 257)) AS j FROM blocks) WHERE 256 * b + j <= n),
        firsts AS (SELECT h, min((doc_id, i)) AS first FROM bytes WHERE h IS NOT NULL GROUP BY h),
        marked AS (SELECT doc_id, i, byte, coalesce(max(CAST(first < (doc_id, i) AS INTEGER)) OVER (
                       PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
                   FROM bytes LEFT JOIN firsts USING (h)),
        edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM marked),
        sums AS (SELECT doc_id, CAST(count_if(gone) AS BIGINT) AS n_removed, CAST(count_if(opens) AS BIGINT) AS n_spans,
                        string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM edges GROUP BY doc_id)
        SELECT doc_id, len(t) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM d LEFT JOIN sums USING (doc_id)""",
}
