"""The numbered queries as DuckDB SQL, where SQL can express them.

Not among them: line chunks and the mix (their hashes are not SQL's), compression
ratios, message passing, credential links, the language model and tokens; those are
tested against brute force."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_CASED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"


def _crc_steps() -> list[int]:
    """CRC-32 of each single byte, by the reflected polynomial."""
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
        out.append(byte)
    return out


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    step = f"xor(c >> 8, CAST({_crc_steps()} AS BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: {step}), 4294967295)"


def _vector_codes(rounds: int = 4) -> str:
    """Every round anew: all distances to all entries."""
    square = lambda a: f"list_inner_product({a}, {a})"
    nearest = """nearest{k} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT r, parts.p, e, {aa} + {bb} - 2 * list_inner_product(x, c) AS d FROM parts JOIN book{k} USING (p)) GROUP BY r, p),"""
    entry = """mean{k} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(v) / count(*)) AS m
    FROM (SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM parts JOIN nearest{k} USING (r, p)) GROUP BY p, e, i) GROUP BY p, e),
book{n} AS MATERIALIZED (SELECT p, e, coalesce(mean{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN mean{k} USING (p, e)),"""
    steps = []
    for k in range(rounds + 1):
        steps.append(nearest.format(k=k, aa=square("x"), bb=square("c")))
        if k < rounds:
            steps.append(entry.format(k=k, n=k + 1))
    last = rounds
    return f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v, row_number() OVER (ORDER BY vec_id NULLS LAST) AS r
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM whole, range(4) t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 256),
{chr(10).join(steps)}
digest AS (SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS h FROM (SELECT p, e, unnest(c) AS v, generate_subscripts(c, 1) AS i FROM book{last})),
coded AS (SELECT r, string_agg(lower(lpad(hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM nearest{last} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN whole USING (r), digest
"""


SQL = {
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d),
windows AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS k FROM starts),
repeated AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN repeated USING (k)),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op4_chat_format": r"""
WITH control AS (SELECT '[<\[]\\*(?:/?s>|</?SYS>>|/?INST\]|\|(?:im_start|im_end|im_sep|im_nl|endoftext)\|>)' AS pattern),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
),
placed AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(text) + len(regexp_extract_all(text, pattern))
    + CASE WHEN before IS NULL OR before <> role THEN 24 + length(role) + len(regexp_extract_all(role, pattern)) ELSE 10 END) AS BIGINT) AS formatted_chars
FROM placed, control GROUP BY conv_id
""",
    "op5_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_CASED}, {_ALNUM}) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_CASED}, {_ALNUM}) AS w FROM benchmark),
parts AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item, least(len(w), 10) AS size, md5(array_to_string(list_slice(w, i, i + 9), ' ')) AS k FROM parts),
sizes AS (SELECT DISTINCT size FROM wanted),
starts AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes),
found AS (
  SELECT doc_id, i, starts.size, item
  FROM (SELECT doc_id, i, size, md5(array_to_string(list_slice(w, i, i + size - 1), ' ')) AS k FROM starts) starts JOIN wanted USING (size, k)
),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op6_ngram_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_CASED}, {_SPACED}) AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 3), ' ')) AS k FROM starts),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON other = a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
""",
    "op12_spelling": rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\x{{00C0}}-\x{{00FF}}]{{7,}}')) AS run FROM documents),
hashed AS (SELECT run, count(*) AS n, {_crc32("id || run")} AS h FROM runs GROUP BY id, run),
whole AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM whole WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT DISTINCT less.word, words.word, words.n FROM less JOIN words ON rest = words.word
  UNION SELECT DISTINCT words.word, less.word, less.n FROM less JOIN words ON rest = words.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
steps AS (SELECT word, word AS stop, 0 AS k FROM formed UNION ALL SELECT steps.word, form, k + 1 FROM steps JOIN formed ON stop = formed.word WHERE form IS NOT NULL),
roots AS (SELECT word, arg_max(stop, k) AS root FROM steps GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
""",
    "op13_vector_codes": _vector_codes(),
}
