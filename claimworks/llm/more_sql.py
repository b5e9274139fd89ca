"""SQL for the Merkle manifest, the spelling variants and the benchmark passages."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The table of the checksum, one step per byte value.
_CRC_TABLE = """
        table_crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT] || range(8),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    """The unsigned checksum of a text, byte by byte; ``t`` is the table above."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * p - 1, 2))::BIGINT"
    each = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda p: {byte})"
    return f"xor(list_reduce([4294967295] || {each}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({v}::VARCHAR)) || ':' || {v}::VARCHAR, '-')" for v in (*LEAF_FIELDS[:-1], text)) + ")"


ORACLE = {
    "op11_merkle": f"""
        WITH RECURSIVE {_CRC_TABLE},
        leaves AS (SELECT doc_id, source, {_leaf('text')} AS leaf,
            CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed
          FROM documents, table_crc),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM leaves),
        low AS (SELECT 0 AS level, source, pos, leaf AS d, count(*) OVER (PARTITION BY source) AS width FROM placed
          UNION ALL
          SELECT level + 1, source, pos // 16, sha256(string_agg(d, '' ORDER BY pos)), (max(width) + 15) // 16
          FROM low WHERE width > 1 GROUP BY level, source, pos // 16),
        subroots AS (SELECT source, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
          FROM low WHERE width = 1),
        high AS (SELECT 0 AS level, place AS pos, subroot AS d, count(*) OVER () AS width FROM subroots
          UNION ALL
          SELECT level + 1, pos // 16, sha256(string_agg(d, '' ORDER BY pos)), (max(width) + 15) // 16
          FROM high WHERE width > 1 GROUP BY level, pos // 16),
        way AS (SELECT doc_id, source, 0 AS level, pos, coalesce(changed, leaf) AS f, '' AS others FROM placed
          UNION ALL
          SELECT w.doc_id, any_value(w.source), w.level + 1, any_value(w.pos) // 16,
                 sha256(string_agg(CASE WHEN n.pos = w.pos THEN w.f ELSE n.d END, '' ORDER BY n.pos)),
                 any_value(w.others) || coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (n.pos <> w.pos), '')
          FROM way w JOIN low n ON n.level = w.level AND n.source IS NOT DISTINCT FROM w.source AND n.pos // 16 = w.pos // 16
          WHERE n.width > 1 GROUP BY w.doc_id, w.level),
        mid AS (SELECT doc_id, source, f, others FROM way QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1),
        up AS (SELECT m.doc_id, s.subroot, 0 AS level, s.place AS pos, m.f, m.others
            FROM mid m JOIN subroots s ON s.source IS NOT DISTINCT FROM m.source
          UNION ALL
          SELECT w.doc_id, any_value(w.subroot), w.level + 1, any_value(w.pos) // 16,
                 sha256(string_agg(CASE WHEN n.pos = w.pos THEN w.f ELSE n.d END, '' ORDER BY n.pos)),
                 any_value(w.others) || coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (n.pos <> w.pos), '')
          FROM up w JOIN high n ON n.level = w.level AND n.pos // 16 = w.pos // 16 WHERE n.width > 1 GROUP BY w.doc_id, w.level),
        ends AS (SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1)
        SELECT doc_id, l.leaf, e.subroot, r.d AS root, sha256(e.others) AS proof_sha256, e.f AS folded_root, e.f = r.d AS verified
        FROM leaves l JOIN ends e USING (doc_id), (SELECT d FROM high WHERE width = 1) r""",
    "op12_spelling": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w
          FROM documents),
        counted AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 7 GROUP BY ALL),
        hashed AS (SELECT w, n, {_crc32("(doc_id || ':' || w)")} AS h FROM counted, table_crc),
        noisy AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n
          FROM hashed),
        words AS (SELECT w AS word, sum(n)::BIGINT AS n FROM noisy WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
        cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS v
          FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
        pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
          UNION SELECT c.word, x.word, x.n FROM cut c JOIN words x ON x.word = c.v
          UNION SELECT x.word, c.word, c.n FROM cut c JOIN words x ON x.word = c.v),
        near AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
          FROM pairs GROUP BY word),
        forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
            CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM words LEFT JOIN near USING (word)),
        way AS (SELECT word, word AS at FROM forms UNION ALL SELECT w.word, f.form FROM way w JOIN forms f ON f.word = w.at
          WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
        FROM forms f JOIN way w USING (word) JOIN forms e ON e.word = w.at AND e.form IS NULL""",
    "op13_winnowing": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        windows AS (SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
          FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
        places AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS g FROM
          (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM windows) WHERE len(ws) >= m)),
        found AS (SELECT doc_id, p.m, i, item_id FROM places p JOIN windows w ON w.m = p.m AND w.g = p.g),
        hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
