"""The queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"list_filter(string_split_regex({_ASCII_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

DECONTAMINATION = f"""
WITH item AS (
    SELECT item_id, w, least(len(w), 10) AS k FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0
), gram AS (
    SELECT DISTINCT item_id, k, list_slice(w, p, p + k - 1) AS g FROM item, unnest(range(1, len(w) - k + 2)) AS u(p)
), doc AS (
    SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents
), place AS (
    SELECT r, p, k, list_slice(w, p, p + k - 1) AS g
    FROM doc, (SELECT DISTINCT k FROM item) AS ks, unnest(range(1, len(w) - k + 2)) AS u(p)
), hit AS (
    SELECT place.r, place.p, place.k, gram.item_id FROM place JOIN gram ON place.g = gram.g
), covered AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + k)) AS u(q) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

_MD5_NUMBER = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)"
_BITS = "greatest(length(bin(size)) - 4, 0)"

SOURCE_MIX = f"""
WITH sized AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, doc_id, coalesce(source, '') AS src, source IS NULL AS src_null,
           CAST(len({_WORDS}) AS BIGINT) AS size
    FROM documents
), total AS (
    SELECT src, src_null, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY ALL
), weighed AS (
    SELECT *, 2 * source_size AS cap,
           CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY src_null, src) - 1) % 3 + 1 AS INTEGER)] AS BIGINT) AS weight
    FROM total
), laid AS (
    SELECT *, row_number() OVER up AS n,
           CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, src_null, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cap_before,
           CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, src_null, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS weight_left,
           CAST(sum(source_size) OVER () AS BIGINT) AS s
    FROM weighed WINDOW up AS (ORDER BY cap / weight, src_null, src)
), levelled AS (
    SELECT *, (s * 150 / 100.0 - cap_before) / weight_left AS own FROM laid
), aimed AS (
    SELECT src, src_null, source_size,
           least(CAST(cap AS DOUBLE), coalesce(CAST(first_value(own) OVER (ORDER BY cap / weight < own, n) AS DOUBLE) * weight, cap)) AS target,
           {_MD5_NUMBER.format("'mix-1:' || CASE WHEN src_null THEN 'n' ELSE 's' END || src")} / 4294967296.0 AS u
    FROM levelled
), b AS (
    SELECT greatest(1, CAST(floor(sqrt(count(*))) AS BIGINT)) AS buckets FROM sized
), placed AS (
    SELECT sized.*, row_number() OVER (PARTITION BY src, src_null
        ORDER BY (size >> {_BITS}) << {_BITS}, {_MD5_NUMBER.format("id")} % buckets, md5(id), id, size) AS k
    FROM sized, b
)
SELECT doc_id, size, source_size, target,
       CAST(floor(u + rate * k) - floor(u + rate * (k - 1)) AS BIGINT) * size AS taken
FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM placed JOIN aimed USING (src, src_null))
"""

REPEATS = f"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), place AS (
    SELECT r, doc_id, p, list_slice(w, p, p + 12) AS g FROM doc, unnest(range(1, len(w) - 11)) AS u(p)
), first AS (
    SELECT g, min(doc_id) AS least FROM place GROUP BY g HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT r, list(DISTINCT q) AS gone FROM place JOIN first USING (g), unnest(range(p, p + 13)) AS u(q) WHERE doc_id > least GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF gone IS NULL OR NOT list_contains(gone, i)], ' '), '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (r)
"""

EXACT_DUPLICATES = r"""
WITH sorted AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM sorted WINDOW same AS (PARTITION BY t)
"""

RANKED_SEARCH = f"""
WITH item AS (
    SELECT row_number() OVER () AS q, item_id, {_ALNUM} AS w FROM benchmark
), asked AS (
    SELECT q, term, CAST(count(*) AS BIGINT) AS qtf FROM (SELECT q, unnest(w) AS term FROM item) GROUP BY ALL
), doc AS (
    SELECT row_number() OVER () AS r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM (SELECT doc_id, {_ALNUM} AS w FROM documents) WHERE len(w) > 0
), total AS (
    SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM doc
), held AS (
    SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM doc)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS heft
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total
), part AS (
    SELECT r, term, heft * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // length))) AS share
    FROM held JOIN doc USING (r) JOIN weight USING (term), total
), scored AS (
    SELECT q, r, CAST(sum(qtf * share) AS BIGINT) AS score FROM asked JOIN part USING (term) GROUP BY ALL
), ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored JOIN item USING (q) JOIN doc USING (r) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
