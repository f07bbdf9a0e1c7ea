"""SQL for the queries that SQL can express, written apart from the operators."""

from .merkle_sql import MANIFEST

ORACLE = {
    "op4_warc_derivatives": r"""
        WITH response AS (
            SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
                   md5('response' || chr(10) || coalesce(page_id::VARCHAR, '') || chr(10) || coalesce(url, '') || chr(10)
                       || coalesce(html, '')) AS h
            FROM pages
        ), named AS (
            SELECT *, '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>'
                   AS refers_to,
                   'sha256:' || sha256(payload) AS payload_digest,
                   regexp_replace(payload, '(?s)<!--.*?-->', ' ', 'g') AS shown,
                   regexp_extract(target_uri, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS site
            FROM response
        ), linked AS (
            SELECT *, md5('metadata' || chr(10) || refers_to) AS m, md5('conversion' || chr(10) || refers_to) AS c,
                   trim(regexp_replace(regexp_extract(shown, '(?is)<title[^>]*>(.*?)</title', 1), '[\r\n]+', ' ', 'g'), ' ')
                   AS title,
                   list_transform(
                       regexp_extract_all(shown, '(?i)<a\s[^>]*?href\s*=\s*[\x22\x27]([^\x22\x27]*)[\x22\x27]', 1),
                       lambda x: chr(13) || chr(10) || 'outlink: ' || trim(regexp_replace(
                           CASE WHEN x LIKE '/%' AND x NOT LIKE '//%' THEN site || x ELSE x END, '[\r\n]+', ' ', 'g'), ' '))
                   AS links,
                   regexp_replace(regexp_replace(regexp_replace(regexp_replace(shown,
                       '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'),
                       '(?is)<noscript\b.*?</noscript\s*>', ' ', 'g'), '(?is)<template\b.*?</template\s*>', ' ', 'g') AS visible
            FROM named
        ), bare AS (
            SELECT *, regexp_replace(regexp_replace(regexp_replace(visible, '[\t\r\n\f ]+', ' ', 'g'),
                       '(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|'
                       || 'html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>', chr(10), 'g'),
                       '<[A-Za-z/!?][^>]*>', '', 'g') AS t
            FROM linked
        ), plain AS (
            SELECT * EXCLUDE (t), regexp_replace(regexp_replace(regexp_replace(
                       replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
                       replace(t, '&nbsp;', ' '), '&copy;', '©'), '&reg;', '®'), '&middot;', '·'), '&hellip;', '…'),
                       '&ndash;', '–'), '&mdash;', '—'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#34;', '"'),
                       '&apos;', ''''), '&#39;', ''''), '&amp;', '&'),
                       '[\t\r\f ]+', ' ', 'g'), ' ?\n[\n ]*', chr(10), 'g'), '^[\n ]+|[\n ]+$', '', 'g') AS text,
                   '<urn:uuid:' || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] || '>' AS mid,
                   '<urn:uuid:' || c[1:8] || '-' || c[9:12] || '-' || c[13:16] || '-' || c[17:20] || '-' || c[21:32] || '>' AS cid
            FROM bare
        ), both_kinds AS (
            SELECT page_id, mid AS record_id, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
                   'source-content-type: text/html' || chr(13) || chr(10)
                   || 'source-content-length: ' || strlen(payload) || chr(13) || chr(10)
                   || 'source-payload-digest: ' || payload_digest || chr(13) || chr(10) || 'conversion-record-id: ' || cid
                   || CASE WHEN title <> '' THEN chr(13) || chr(10) || 'title: ' || title ELSE '' END
                   || coalesce(array_to_string(links, ''), '') || chr(13) || chr(10) AS block,
                   cid AS linked_id, refers_to, target_uri, payload_digest
            FROM plain
            UNION ALL
            SELECT page_id, cid, 'conversion', 'text/plain', text, mid, refers_to, target_uri, payload_digest FROM plain
        )
        SELECT page_id, record_id, record_type, refers_to, target_uri, '2024-01-01T00:00:00Z' AS date, content_type, block,
               'sha256:' || sha256(block) AS block_digest, payload_digest, linked_id, strlen(block) AS content_length
        FROM both_kinds
    """,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               coalesce(doc_id = max(doc_id) OVER same, false) AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_merkle_manifest": MANIFEST,
    "op13_collocations": r"""
        WITH piece AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
            FROM documents
        ), total AS (
            SELECT lang, sum(len(words))::BIGINT AS n FROM piece GROUP BY lang
        ), gram AS (
            SELECT lang, unnest(list_transform(range(1, (len(words) - k + 2)::BIGINT), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
            FROM piece, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(words) >= k
        ), freq AS (
            SELECT lang, phrase, count(*) AS f FROM gram GROUP BY lang, phrase HAVING count(*) >= 30
        ), split AS (
            SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws FROM freq WHERE contains(phrase, ' ')
        ), cut AS (
            SELECT lang, phrase, a, k, array_to_string(ws[:k], ' ') AS left_part, array_to_string(ws[k + 1:], ' ') AS right_part
            FROM split, (SELECT unnest([1, 2, 3]) AS k) WHERE k < len(ws)
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, c.k, (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score
            FROM cut c JOIN freq x ON c.lang = x.lang AND c.left_part = x.phrase JOIN freq y ON c.lang = y.lang AND c.right_part = y.phrase
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_part AS (
            SELECT lang, a, unnest(list_concat(
                       CASE WHEN len(ws) >= 3 THEN [array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')] ELSE [] END,
                       CASE WHEN len(ws) = 4 THEN [array_to_string(ws[3:4], ' '), array_to_string(ws[1:3], ' '), array_to_string(ws[2:4], ' ')]
                            ELSE [] END)) AS phrase
            FROM split
        ), longer AS (
            SELECT lang, phrase, max(a) AS most FROM inner_part GROUP BY lang, phrase
        ), ranked AS (
            SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, score
            FROM lowest s LEFT JOIN longer o ON s.lang = o.lang AND s.phrase = o.phrase
            WHERE o.most IS NULL OR 100::HUGEINT * o.most < 80::HUGEINT * a
        )
        SELECT r.lang, rank, phrase, a, l, r.r, n, score FROM ranked r JOIN total t ON r.lang = t.lang WHERE rank <= 2000
    """,
}
