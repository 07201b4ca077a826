"""DuckDB SQL with the results of those queries that SQL can express."""

from __future__ import annotations

#: Escapes as in chat.py; the template's marks are <|im_start|>, <|im_sep|>, <|im_end|>\n.
CHAT = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), stepped AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w IS NULL AS last FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id,
  count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(12 + 10 + 11 + length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'))
      + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')))::BIGINT AS formatted_chars,
  bool_and(CASE
    WHEN before IS NULL THEN role IN ('system', 'user')
    WHEN before IN ('system') THEN role = 'user'
    WHEN before IN ('user', 'tool') THEN role = 'assistant'
    WHEN before = 'assistant' THEN role IN ('user', 'tool')
    ELSE false END) AND bool_or(last AND role = 'assistant') AS valid
FROM stepped GROUP BY conv_id
"""

TOPK = """
WITH rows AS (
  SELECT DISTINCT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.ints AS asked, c.vec_id AS vec_id,
    list_sum([p[1] * p[2] FOR p IN list_zip(q.ints, c.ints)])::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.ints) = len(c.ints)
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id, asked ORDER BY score DESC, vec_id) QUALIFY rank <= 10
"""

NEAR_DUPLICATES = """
WITH RECURSIVE words AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+') IF w <> ''] AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common WHERE 100 * shared >= 85 * (na + nb - shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(other) AS component_id,
  sets.doc_id = min(other) AS kept
FROM sets JOIN reach ON sets.doc_id = reach.doc_id GROUP BY sets.doc_id, s
"""

#: Windows of at least 50 words as lists of lines, every earlier place of each, and the longest
#: run from there that goes on alike.
LINES = """
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, text, string_split(text, chr(10)) AS raw FROM documents
), lines AS (
  SELECT row, doc_id, unnest(range(len(raw))) AS line, unnest(raw) AS raw FROM docs WHERE doc_id IS NOT NULL
), words AS (
  SELECT *, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS said FROM lines
), counted AS (
  SELECT *, CASE WHEN said = '' THEN 0 ELSE len(string_split(said, ' ')) END AS n FROM words
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY row ORDER BY line) AS upto FROM counted
), lists AS (
  SELECT row, list(said ORDER BY line) AS said, list(upto ORDER BY line) AS uptos FROM summed GROUP BY row
), ends AS (
  SELECT summed.row, doc_id, line AS start, lists.said AS said,
    len([u FOR u IN uptos IF u < upto - n + 50]) + 1 AS stop
  FROM summed JOIN lists USING (row)
), windows AS (
  SELECT row, doc_id, start, stop, said[start + 1 : stop] AS content FROM ends WHERE stop <= len(said)
), later AS (
  SELECT w.row, w.start, w.stop, max(CASE WHEN same IS NULL THEN 0 ELSE coalesce(nullif(list_position(same, false), 0) - 1, len(same)) END) AS more
  FROM (SELECT w.row, w.start, w.stop,
      [p[1] IS NOT DISTINCT FROM p[2] FOR p IN list_zip(a.said[w.stop + 1 :], b.said[e.stop + 1 :])] AS same
    FROM windows w JOIN windows e ON e.content = w.content AND (e.doc_id, e.start) < (w.doc_id, w.start)
    JOIN lists a ON a.row = w.row JOIN lists b ON b.row = e.row) w
  GROUP BY ALL
), gone AS (
  SELECT DISTINCT row,
    unnest(range(start, stop + more)) AS line
  FROM later
), kept AS (
  SELECT row, string_agg(raw, chr(10) ORDER BY line) AS text, count(*) AS n
  FROM lines ANTI JOIN gone USING (row, line) GROUP BY row
)
SELECT doc_id,
  CASE WHEN doc_id IS NULL OR docs.text IS NULL THEN docs.text ELSE coalesce(kept.text, '') END AS text,
  coalesce(len(raw), 0)::INTEGER AS lines,
  CASE WHEN doc_id IS NULL OR docs.text IS NULL THEN 0 ELSE len(raw) - coalesce(kept.n, 0) END::INTEGER
    AS lines_removed
FROM docs LEFT JOIN kept USING (row)
"""

#: CRC by a table made from its rule; the mix and the jumps in 128-bit arithmetic.
SHARDS = """
WITH RECURSIVE bits AS (
  SELECT n, 0 AS step, n::UINTEGER AS c FROM range(256) t(n)
  UNION ALL
  SELECT n, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END
  FROM bits WHERE step < 8
), crc_table AS (
  SELECT list(c ORDER BY n) AS entries FROM bits WHERE step = 8
), docs AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents
), sized AS (
  SELECT row, doc_id, length(body) // 2 + 16 AS size,
    xor(4294967295::UINTEGER, list_reduce(
      list_concat([4294967295::UINTEGER], [('0x' || body[2 * i + 1 : 2 * i + 2])::UINTEGER FOR i IN range(length(body) // 2)]),
      lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) AS crc
  FROM docs, crc_table
), mixed AS (
  SELECT *, xor(z, z >> 31) AS hash FROM (
    SELECT * REPLACE ((xor(z, z >> 27) * 10723151780598845931::UHUGEINT) % two64 AS z) FROM (
      SELECT * REPLACE ((xor(z, z >> 30) * 13787848793156543929::UHUGEINT) % two64 AS z) FROM (
        SELECT *, 18446744073709551616::UHUGEINT AS two64,
          ((coalesce(doc_id, -1)::HUGEINT + 18446744073709551616::HUGEINT + 11400714819323198485::HUGEINT)
            % 18446744073709551616::HUGEINT)::UHUGEINT AS z FROM sized)))
), jumps AS (
  SELECT row, shards, hash AS key, -1::BIGINT AS here, 0::BIGINT AS there
  FROM mixed, (VALUES (40), (41)) s(shards)
  UNION ALL
  SELECT row, shards, next, there,
    floor((there + 1)::DOUBLE * (2147483648::DOUBLE / ((next >> 33)::DOUBLE + 1)))::BIGINT
  FROM (SELECT *, ((key * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT) AS next
    FROM jumps WHERE there < shards)
), placed AS (
  SELECT row, max(here) FILTER (shards = 40)::INTEGER AS shard, max(here) FILTER (shards = 41)::INTEGER AS grown_shard
  FROM jumps GROUP BY row
)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY hash >> 1, doc_id NULLS FIRST, size, crc) - 1 AS slot, grown_shard
FROM mixed JOIN placed USING (row)
"""

#: Texts as hexadecimal digits; a string of 50 bytes is one of 100 digits.
SUBSTRINGS = """
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents
), places AS (
  SELECT row, unnest(range(greatest(length(body) // 2 - 49, 0))) AS place FROM docs
), strings AS (
  SELECT row, doc_id, place, body[2 * place + 1 : 2 * place + 100] AS string FROM places JOIN docs USING (row)
), firsts AS (
  SELECT string, min(doc_id) AS first FROM strings GROUP BY string
), later AS (
  SELECT row, place, lag(place) OVER (PARTITION BY row ORDER BY place) AS before
  FROM strings JOIN firsts USING (string) WHERE doc_id > first
), runs AS (
  SELECT row, min(place) AS start, max(place) + 50 AS stop FROM (
    SELECT row, place, sum(CASE WHEN place <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY row ORDER BY place) AS run
    FROM later)
  GROUP BY row, run
), pieces AS (
  SELECT row, coalesce(lag(stop) OVER (PARTITION BY row ORDER BY start), 0) AS start, start AS stop FROM runs
  UNION ALL
  SELECT row, coalesce(max(runs.stop), 0), any_value(length(body) // 2)
  FROM docs LEFT JOIN runs USING (row) GROUP BY row
), kept AS (
  SELECT row, string_agg(body[2 * start + 1 : 2 * stop], '' ORDER BY start) AS body
  FROM pieces JOIN docs USING (row) GROUP BY row
)
SELECT doc_id, (length(docs.body) // 2)::BIGINT AS n_bytes,
  ((length(docs.body) - length(kept.body)) // 2)::BIGINT AS n_removed,
  (SELECT count(*) FROM runs WHERE runs.row = docs.row)::BIGINT AS n_spans,
  sha256(unhex(kept.body)) AS kept_sha256
FROM docs JOIN kept USING (row)
"""


#: Phrases as lists of words; all of them are counted, cut and compared.
PHRASES = """
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?
-
]')) AS piece FROM docs
), words AS (
  SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ 	]+') IF w <> ''] AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, size, count(*) AS f
  FROM places, range(1, 5) sizes(size) WHERE i + size - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, string_split(phrase, ' ') AS w, size, f AS a FROM grams WHERE size > 1 AND f >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, first.f AS l, rest.f AS r,
    ((2000000::HUGEINT * c.a) // (first.f::HUGEINT + rest.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN grams first ON first.lang = c.lang AND first.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN grams rest ON rest.lang = c.lang AND rest.phrase = array_to_string(c.w[k + 1 :], ' ')
), best AS (
  SELECT lang, phrase, a, min({'score': score, 'k': k, 'l': l, 'r': r}) AS cut FROM cuts GROUP BY ALL
), inner_phrases AS (
  SELECT lang, array_to_string(w[i : i + short - 1], ' ') AS phrase, max(a) AS within
  FROM (SELECT *, unnest(range(1, size - short + 2)) AS i
    FROM (SELECT *, unnest(range(2, size)) AS short FROM candidates WHERE size > 2))
  GROUP BY ALL
)
SELECT lang, row_number() OVER best_first AS rank, phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score
FROM best JOIN totals USING (lang) LEFT JOIN inner_phrases USING (lang, phrase)
WHERE within IS NULL OR 100::HUGEINT * within < 80::HUGEINT * a
WINDOW best_first AS (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) QUALIFY rank <= 2000
"""

#: Nodes as lists of turns; a node's subtree are the nodes whose smallest member passes it.
TRIE = """
WITH RECURSIVE bits AS (
  SELECT n, 0 AS step, n::UINTEGER AS c FROM range(256) t(n)
  UNION ALL
  SELECT n, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END
  FROM bits WHERE step < 8
), crc_table AS (
  SELECT list(c ORDER BY n) AS entries FROM bits WHERE step = 8
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS said
  FROM turns GROUP BY conv_id
), headed AS (
  SELECT own.*, xor(4294967295::UINTEGER, list_reduce(
      list_concat([4294967295::UINTEGER], [unicode((conv_id::VARCHAR)[i])::UINTEGER FOR i IN range(1, length((conv_id::VARCHAR)) + 1)]),
      lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) % 4 AS h
  FROM own, crc_table
), paths AS (
  SELECT c.conv_id, list_concat(coalesce(base.said, [])[1 : c.h], c.said[c.h + 1 :]) AS path
  FROM headed c LEFT JOIN own base ON base.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
  SELECT conv_id, depth, path[1 : depth] AS node, path[1 : depth - 1] AS parent, len(path) = depth AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(path[depth].text, '[^ 	-
]+')) END AS words
  FROM (SELECT *, unnest(range(len(path) + 1)) AS depth FROM paths)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), children AS (
  SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node, depth)
), sums AS (
  SELECT p.node, p.depth, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.words) AS saved_tokens
  FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY p.node, p.depth
)
SELECT c.conv_id, c.depth, up.conv_id AS parent_conv_id, c.n_convs, c.n_children::BIGINT AS n_children,
  n_leaves, saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums USING (node, depth)
LEFT JOIN nodes up ON c.depth > 0 AND up.node = c.parent AND up.depth = c.depth - 1
"""


def oracles() -> dict[str, str]:
    return {
        "op2_line_dedup": LINES,
        "op3_sharding": SHARDS,
        "op4_suffix_array_dedup": SUBSTRINGS,
        "op5_minhash_neardup": NEAR_DUPLICATES,
        "op8_exact_topk": TOPK,
        "op9_chat_formatting": CHAT,
        "op11_phrase_mining": PHRASES,
        "op13_prefix_trie": TRIE,
    }
