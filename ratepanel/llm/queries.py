"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import PATTERN
from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.llm import bpe, chat, collocations, decontam, licences, minhash, packing, prefixes, quality, secrets, sharding, substring, wrappers
from ratepanel.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SHARDS = 40
VOCABULARY = "byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def _query(run):
    QUERIES[run.__name__] = run
    return run


@_query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"), licences.built_in(spark))
    return found.select("doc_id", "text_digest", "licence", F.array_join("notices", ",").alias("notices"))


@_query
def op3_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@_query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


@_query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary(VOCABULARY), PATTERN, at_once=1 << 22)


@_query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.findings(docs, secrets.fit(docs, path="source"), path="source")


@_query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return chat.digest(chat.segments(rows.union(more)))


@_query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(table(spark, sf_dir, "documents"))


@_query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@_query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


@_query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY)).drop("ids")


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"), least=100, top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = prefixes.turn_lists(table(spark, sf_dir, "conversations"), near=20)
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    return prefixes.trie(prefixes.paths(prefixes.with_heads(lists, 3, shared)))


_MARKS = chat.INSTRUCT.control()
_ESCAPES = " + ".join(
    ["length(text) - length(replace(text, chr(92), ''))", *[f"(length(text) - length(replace(text, '{m}', ''))) / {len(m)}" for m in _MARKS]]
)
SQL["op7_chat_format"] = f"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    m AS (SELECT *, length(text) + {_ESCAPES} + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 END AS n,
                 CASE role WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' WHEN 'system' THEN 's' ELSE 'x' END AS letter FROM c)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(n) AS BIGINT) AS formatted_chars,
           regexp_full_match(string_agg(letter, '' ORDER BY turn, role, text), 's?(ua)+') AS valid
    FROM m GROUP BY conv_id
"""

SQL["op1_minhash_near_dedup"] = r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
    link AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
    edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (SELECT a AS doc_id, a AS label FROM edge UNION SELECT edge.b, reach.label FROM reach JOIN edge ON edge.a = reach.doc_id),
    least AS (SELECT doc_id, min(label) AS label FROM reach GROUP BY 1)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(label, d.doc_id) AS component_id, coalesce(label, d.doc_id) = d.doc_id AS kept
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

SQL["op4_substring_dedup"] = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
    k AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words FROM s),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS n FROM k) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM again),
    word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
    kept AS (SELECT word.doc_id, count(*) AS n, string_agg(word.word, ' ' ORDER BY word.pos) AS words
             FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept.words, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)
"""

SQL["op9_decontamination"] = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    starts AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM starts),
    places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n),
    found AS (SELECT doc_id, i, p.n, item FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM places) p
              JOIN windows USING (n, words)),
    hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY 1),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL["op12_collocations"] = r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    s AS (SELECT lang, w, words, unnest(range(1, len(w) - words + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS words) WHERE len(w) >= words),
    g AS (SELECT lang, words, array_to_string(w[i:i + words - 1], ' ') AS phrase FROM s),
    totals AS (SELECT lang, count(*) AS n FROM g WHERE words = 1 GROUP BY lang),
    f AS (SELECT lang, words, phrase, count(*) AS a FROM g GROUP BY lang, words, phrase HAVING count(*) >= 100),
    parts AS (SELECT *, string_split(phrase, ' ') AS p FROM f WHERE words >= 2),
    inside AS (SELECT lang, a, array_to_string(p[i:i + m - 1], ' ') AS phrase FROM
                   (SELECT *, unnest(range(1, words - m + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS m FROM parts WHERE words > 2))),
    kept AS (SELECT * FROM parts ANTI JOIN (SELECT i.lang, i.phrase FROM inside i JOIN f ON f.lang = i.lang AND f.phrase = i.phrase AND 100 * i.a >= 100 * f.a)
                                            USING (lang, phrase)),
    cuts AS (SELECT *, unnest(range(1, words)) AS k FROM kept),
    scored AS (SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r, n,
                      CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(h.a AS HUGEINT) * t.a) AS BIGINT) AS score
               FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(p[1:k], ' ')
                           JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(p[k + 1:], ' ')
                           JOIN totals ON totals.lang = c.lang),
    best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE place = 1)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

# CRC-32 by its definition: each byte is added, then eight steps follow.
SQL["op13_prefix_trie"] = """
    WITH turn AS (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
                         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
                  FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT conv_id, list({'d': digest, 'w': words} ORDER BY turn NULLS FIRST, digest) AS turns,
                   list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes FROM turn GROUP BY conv_id),
    crc AS (SELECT conv_id, turns,
                   xor(list_reduce(flatten(list_transform(bytes, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])),
                                   lambda v, b: CASE WHEN b >= 0 THEN xor(v, b) WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END,
                                   CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h FROM own),
    made AS (SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
             FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
    digests AS (SELECT conv_id, list_transform(turns, lambda t: t.d) AS d, list_transform(turns, lambda t: t.w) AS w FROM made),
    member AS (SELECT conv_id, d, w, unnest(range(0, len(d) + 1)) AS depth FROM digests),
    keyed AS (SELECT *, array_to_string(d[1:depth], '') AS key, CASE WHEN depth > 0 THEN array_to_string(d[1:depth - 1], '') END AS above FROM member),
    node AS (SELECT depth, key, above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(w[depth], 0)) AS words,
                    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(d) = depth), '')) AS ends_sha256
             FROM keyed GROUP BY depth, key, above),
    child AS (SELECT depth - 1 AS depth, above AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
    known AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (depth, key)),
    upward AS (SELECT n_children, (n_convs - 1) * words AS saved, d, unnest(range(0, depth + 1)) AS up FROM known JOIN digests USING (conv_id)),
    total AS (SELECT up AS depth, array_to_string(d[1:up], '') AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
              FROM upward GROUP BY 1, 2)
    SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
    FROM known k JOIN total USING (depth, key) LEFT JOIN node p ON k.depth > 0 AND p.depth = k.depth - 1 AND p.key = k.above
"""
