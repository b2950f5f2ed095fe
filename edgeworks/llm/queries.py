"""The registered queries of this subpackage, with SQL where SQL can express them.

Without SQL: op2 (inferred automata), op3 (chains and alignments), op4 and op5 (trained models), op6
(needs the rank file), op7 (XXH64), op9 (the same hash orders the groups), op10 (zlib streams), op12 and
op13 (need tokenizer files). Their
tests hold them against plain versions.
"""

from __future__ import annotations

from . import alignment, bpe, chat, decontaminate, media, passages, quality, secrets, sharding, simhash, spelling, toxicity, word_bpe

QUERIES = {
    "op1_chat_format": chat.op1,
    "op2_secret_scan": secrets.op2,
    "op3_substring_dedup": passages.op3,
    "op4_toxicity": toxicity.op4,
    "op5_quality": quality.op5,
    "op6_byte_bpe": bpe.op6,
    "op7_simhash_near_dedup": simhash.op7,
    "op8_benchmark_decontamination": decontaminate.op8,
    "op9_sharding": sharding.op9,
    "op10_media_columns": media.op10,
    "op11_spelling_variants": spelling.op11,
    "op12_token_alignment": alignment.op12,
    "op13_word_bpe": word_bpe.op13,
}


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for control in chat.CONTROL:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


_CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('[INST][/INST]</s>') + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least({decontaminate.WINDOW}, len(w)) AS n FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM windows)),
grams AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM places),
hits AS (SELECT doc_id, item, n, s FROM grams JOIN windows USING (n, g)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {decontaminate.SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN hit_items i ON i.doc_id = d.doc_id
"""

#: The checksum goes byte by byte through a table that eight shifts an entry make.
_SPELLING = rf"""
WITH RECURSIVE steps AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{{spelling.SHORTEST},}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
held AS (SELECT run, count(*) AS c, hex(encode(doc || ':' || run)) AS x FROM runs GROUP BY doc, run),
hashed AS (SELECT run, c, xor(list_reduce(list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)), lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM held, steps),
cut AS (SELECT CASE WHEN h % {spelling.NOISE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM cut WHERE length(word) >= {spelling.SHORTEST} GROUP BY word HAVING sum(c) >= 2),
dropped AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS v FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
    SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM dropped a JOIN dropped b ON a.v = b.v AND a.i = b.i WHERE a.word <> b.word
    UNION SELECT d.word, d.n, w.word, w.n FROM dropped d JOIN words w ON w.word = d.v
    UNION SELECT w.word, w.n, d.word, d.n FROM dropped d JOIN words w ON w.word = d.v
),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS m, first(near ORDER BY near_n DESC, near) AS near FROM near GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {spelling.MARGIN} * n THEN near END AS form, CASE WHEN m >= {spelling.MARGIN} * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, form AS root, 1 AS step FROM formed WHERE form IS NOT NULL UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN last USING (word)
"""

ORACLES: dict[str, str] = {"op1_chat_format": _CHAT, "op8_benchmark_decontamination": _DECONTAMINATION, "op11_spelling_variants": _SPELLING}
