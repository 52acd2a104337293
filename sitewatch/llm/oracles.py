"""The same results as SQL for DuckDB, where SQL can express the operator."""

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_TEXT = "coalesce(text, '')"
_LOWER = f"translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text=_TEXT)} AS words FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS k
    FROM w, unnest(range(1, len(words) - 18)) t(i)
),
again AS (
    SELECT doc_id, i FROM windows
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM again, range(20) s(j)),
kept AS (
    SELECT w.doc_id, string_agg(words[p], ' ' ORDER BY p) AS text, count(*) AS n
    FROM w, unnest(range(1, len(words) + 1)) t(p)
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = w.doc_id AND g.p = t.p)
    GROUP BY w.doc_id
)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_OP4 = rf"""
WITH w AS (
    SELECT doc_id, {_TEXT} AS text, {_WORDS.format(text=_TEXT)} AS words FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS k
    FROM w, unnest(range(1, len(words) - 1)) t(i)
),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(3) s(j) GROUP BY doc_id),
base AS (
    SELECT w.doc_id, text, len(words) AS n_words,
           length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
             - len(list_distinct(list_filter(string_split(text, chr(10)),
                                             lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
           coalesce(repeated.n, 0) AS n_repeat_words
    FROM w LEFT JOIN repeated USING (doc_id)
),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           length(text) - length(replace(text, chr(10), '')) + 1 AS lines,
           length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS letters,
           length(regexp_replace(text, '[^\p{{N}}]', '', 'g')) AS digits,
           len(regexp_extract_all(text, '(?m)^[ \t]*[-*•][ \t]')) AS bullets
    FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * greatest(n_words, 1)
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 10 * n_dup_lines > 6 * lines OR 10 * letters < 6 * word_chars
            OR 10 * digits > 3 * word_chars OR 10 * bullets > 9 * lines) AS kept
FROM judged
"""

_OP8 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS k
    FROM w, unnest(range(1, greatest(len(words) - 2, 2))) t(i) WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 80 * (x.n + y.n - common)
),
reach AS (
    SELECT doc_id AS root, doc_id AS node FROM documents
    UNION
    SELECT root, b FROM reach JOIN links ON node = a
),
components AS (SELECT root AS doc_id, min(node) AS component_id FROM reach GROUP BY root)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN components USING (doc_id)
"""

# The checksum of each text, byte by byte over the table of its polynomial.
_CRC32 = f"""
bits AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i::UBIGINT] || list_transform(range(8), lambda k: 0::UBIGINT),
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
        FROM range(256) r(i))
),
sums AS (
    SELECT doc_id, source, strlen({_TEXT}) + 1 AS size,
           xor(list_reduce([4294967295::UBIGINT]
                             || list_transform(regexp_extract_all(hex(encode({_TEXT})), '..'), lambda h: ('0x' || h)::UBIGINT),
                           lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
    FROM documents, bits
)"""

_OP5 = f"""
WITH {_CRC32},
marked AS (
    SELECT *, ('0x' || substr(md5(concat_ws(':', doc_id, text_crc32, 5)), 1, 15))::BIGINT AS mark FROM sums
),
within AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY mark, doc_id, text_crc32, size) - 1 AS rank,
           count(*) OVER (PARTITION BY source) AS rows
    FROM marked
),
placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * rank + 1)::DOUBLE / rows, source NULLS FIRST, mark, doc_id, text_crc32, size) - 1 AS place,
           count(*) OVER () AS total
    FROM within
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 16 // total AS INTEGER) AS shard,
       place - (place * 16 // total * total + 15) // 16 AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
FROM placed
"""

ORACLES = {"op1_repeats": _OP1, "op4_cascade": _OP4, "op5_sharding": _OP5, "op8_minhash": _OP8}
