"""DuckDB SQL with the same results, where SQL can express them.

Packing, sharding, the classifier, page extraction and the pipeline have none; neither have
the Jaccard join, whose SQL would pair all documents, and the SimHash join (no XXH64).
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARKS = "<|im_end|><|im_start|>assistant ok"


def _escaped(column: str) -> str:
    """Backslashes of ``<\\...|`` grow by one."""
    return rf"regexp_replace({column}, '<(\\*)\|', '<\\\1|', 'g')"


OP1 = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{_MARKS}' UNION ALL SELECT -1, 1, 'assistant', '{_MARKS}'
), written AS (
    SELECT *, {_escaped(r"replace(replace(role, '\', '\\'), chr(10), '\n')")} AS role_out, {_escaped("text")} AS text_out
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(role_out) + length(text_out) + length('<|im_start|>') + length('<|im_end|>') + 2) AS BIGINT)
        AS formatted_chars
FROM written GROUP BY conv_id
"""

_WORDS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = rf"""
WITH items AS (
    SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents
), sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n
), found AS (
    SELECT r, i, n, item_id FROM places JOIN windows ON list_slice(w, i, i + n - 1) = win
), hit AS (
    SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

OP8 = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST)
"""

OP10 = """
WITH captures AS (
    SELECT page_id, row_number() OVER () AS r, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, first_value(r) OVER w AS first_r, first_value(page_id) OVER w AS first_page FROM captures
    WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, r)
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND r <> first_r THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND r <> first_r THEN first_page END AS refers_to
FROM firsts
"""


#: ``crc.t``: the 256 steps of the CRC-32 polynomial.
_CRC_TABLE = """crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
)"""


def _crc32(text: str) -> str:
    """Byte by byte over UTF-8, as a reduction over a list that starts with the first state."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    steps = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte})"
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], {steps}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))")


OP11 = rf"""
WITH {_CRC_TABLE},
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
items AS (SELECT row_number() OVER () AS r, coalesce({_WORDS}, []) AS w FROM benchmark),
doc_grams AS (
    SELECT r, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (VALUES (1), (2), (3)) n(k) WHERE len(w) >= k)
), item_grams AS (
    SELECT array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items, (VALUES (1), (2), (3)) n(k) WHERE len(w) >= k)
), buckets AS (
    SELECT g, {_crc32("g")} % 10000 AS bucket FROM (SELECT g FROM doc_grams UNION SELECT g FROM item_grams), crc
), placed AS (SELECT r, bucket FROM doc_grams JOIN buckets USING (g)),
raw AS (SELECT bucket, count(*) AS s FROM placed GROUP BY bucket),
wanted AS (SELECT bucket, count(*) AS t FROM item_grams JOIN buckets USING (g) GROUP BY bucket),
totals AS (
    SELECT CAST((SELECT count(*) FROM doc_grams) AS DOUBLE) AS big, CAST((SELECT count(*) FROM item_grams) AS DOUBLE) AS small
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (big + 10000)
        / ((CAST(s AS DOUBLE) + 1) * (small + 10000)))) AS BIGINT) AS gain
    FROM raw LEFT JOIN wanted USING (bucket), totals
), weights AS (
    SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) GROUP BY r
), scored AS (
    SELECT doc_id, len(w) >= 20 AS long_enough, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST(
            '0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) + 0.5)
            / 4294967296))) AS BIGINT) AS score
    FROM docs LEFT JOIN weights USING (r)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY long_enough ORDER BY score DESC, doc_id NULLS LAST) AS place,
        count(*) FILTER (long_enough) OVER () AS n
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN long_enough AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""

OP13 = rf"""
WITH {_CRC_TABLE},
own AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS seq
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (SELECT conv_id, seq, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own, crc),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.seq[1:h], c.seq[1:0]), c.seq[h + 1:]) AS seq
    FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - ((c.conv_id % 20) + 20) % 20
), members AS (
    SELECT conv_id, len(seq) AS size, depth, seq[1:depth] AS prefix
    FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS depth FROM rebuilt)
), nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) = depth AS childless,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256,
        (count(*) - 1) * coalesce(len(regexp_extract_all(prefix[-1].x, '[^ 	-
]+')), 0) AS saved
    FROM members GROUP BY prefix, depth
), below AS (
    SELECT prefix, CAST(count(*) FILTER (childless) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM (SELECT seq[1:k] AS prefix, childless, saved
          FROM (SELECT prefix AS seq, childless, saved, unnest(range(0, depth + 1)) AS k FROM nodes))
    GROUP BY prefix
), children AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (prefix) LEFT JOIN children USING (prefix)
    LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_chat_formatting": OP1, "op7_benchmark_decontamination": OP7, "op8_exact_dedup": OP8, "op10_warc": OP10,
        "op11_importance_resampling": OP11, "op13_conversation_trie": OP13,
    }
