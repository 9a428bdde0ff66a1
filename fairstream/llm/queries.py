"""The registered query of each operator, over whole tables, and its DuckDB SQL
where SQL can express it. Each query gets its rows through its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.llm import (
    alignment,
    chat,
    decontam,
    embedding,
    langid,
    pieces,
    quality,
    repair,
    secret_scan,
    sharding,
    simhash,
    substring,
    warc,
)
from fairstream.sources.tables import read_table

SHARDS = 40


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = rows.unionByName(chat.sample_conversation(spark))
    parts = messages.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    return chat.digest(chat.format_chats(parts))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.scan(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs).select("doc_id", "n_pieces", "ids_sha256", "lossless", "ids")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(4))
    held_out = F.coalesce(fold == 2, F.lit(False))
    dictionaries = langid.learn(docs.filter(~held_out))
    texts = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.classify(texts, dictionaries).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed",
                                                 F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    placed = sharding.shuffle_shards(docs, "doc_id", SHARDS)        # whole documents, written and read back
    text = F.coalesce(F.col("text"), F.lit(""))
    return placed.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                         F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                         "law", "shard", "slot", "grown_shard")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rejected_by")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(read_table(spark, sf_dir, "pages"))
    return warc.read(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digest(repair.repair(repair.damage(rows)))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict:
    named = (op1_chat_formatting, op2_decontamination, op3_sentencepiece, op4_secret_scan, op5_language_id,
             op6_substring_dedup, op7_sharding, op8_quality_rules, op9_simhash, op10_warc, op11_conversation_repair,
             op12_embedding_near_dedup, op13_cross_tokenizer_alignment)
    return {f.__name__: f for f in named}


# --- DuckDB ------------------------------------------------------------------

_ESC = (r"regexp_replace(regexp_replace(regexp_replace({}, '&(amp;|lt;|lsb;)', '&amp;\1', 'g'), "
        r"'<(/?s>|image:|audio:|document:)', '&lt;\1', 'g'), '\[(/?INST\])', '&lsb;\1', 'g')")

OP1_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<s>[INST]' || {_ESC.format('role')} || '[/INST]' || {_ESC.format('text')} || '</s>')) AS chars
  FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM t
"""

_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)


def _rules_sql() -> str:
    def one(r: quality.Rule) -> str:
        broken = [f"{r.part} * 1000 < {r.whole} * {r.low}"] if r.low is not None else []
        broken += [f"{r.part} * 1000 > {r.whole} * {r.high}"] if r.high is not None else []
        return f"CASE WHEN {' OR '.join(broken)} THEN '{r.name}' END"
    return f"list_filter([{', '.join(map(one, quality.RULES))}], lambda x: x IS NOT NULL)"


OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, array_to_string(ws[i:i+7], ' ') AS gram
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
      FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM p) GROUP BY r),
m AS (SELECT w.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(regexp_extract_all(t, '!')) AS BIGINT) AS n_exclamations,
             CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN c ON c.r = w.r),
v AS (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed,
             {_rules_sql()} AS rejected_by FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND len(rejected_by) = 0 AS kept, rejected_by FROM v
"""


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT r, doc_id, i, array_to_string(ws[i:i+19], ' ') AS gram
      FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
p AS (SELECT r, i FROM (SELECT r, doc_id, i, min((coalesce(doc_id, -9223372036854775808), i))
                               OVER (PARTITION BY gram) AS m FROM g)
      WHERE (coalesce(doc_id, -9223372036854775808), i) <> m),
x AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS k FROM p),
k AS (SELECT r, list(k) AS ks FROM x GROUP BY r),
e AS (SELECT d.r, doc_id, ws, coalesce(len(ks), 0) AS n_removed FROM d LEFT JOIN k ON k.r = d.r),
w AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM d),
t AS (SELECT w.r, string_agg(word, ' ' ORDER BY w.k) AS kept
      FROM w LEFT JOIN x ON x.r = w.r AND x.k = w.k WHERE x.k IS NULL GROUP BY w.r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM e LEFT JOIN t ON t.r = e.r
"""

_WORDS2 = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS2} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS2} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(ws[i:i+n-1], ' ') AS gram
       FROM (SELECT item, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i
             FROM b WHERE len(ws) > 0)),
dw AS (SELECT r, i, n, array_to_string(ws[i:i+n-1], ' ') AS gram
       FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
h AS (SELECT r, i, dw.n, item FROM dw JOIN bw USING (n, gram)),
w AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM h) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN w USING (r) LEFT JOIN s USING (r)
"""


#: Two usable vectors of one label and length link at a cosine of 0.93 or more.
OP12_SQL = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT *, len(v) AS n, list_sum(list_transform(v, lambda x: x * x)) AS q FROM e
      WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.r AS x, b.r AS y FROM u a JOIN u b ON a.label = b.label AND a.n = b.n AND a.r <> b.r
      WHERE a.q > 0 AND b.q > 0 AND list_dot_product(a.v, b.v) / sqrt(a.q * b.q) >= 0.93),
c AS (SELECT x, y FROM l UNION SELECT c.x, l.y FROM c JOIN l ON l.x = c.y),
m AS (SELECT c.x, min(e.vec_id) AS low FROM c JOIN e ON e.r = c.y GROUP BY c.x),
k AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, low) AS component_id,
       vec_id = least(vec_id, low) AS kept
FROM e LEFT JOIN m ON m.x = e.r LEFT JOIN k ON k.x = e.r
"""


def oracle_sql() -> dict:
    return {"op1_chat_formatting": OP1_SQL, "op2_decontamination": OP2_SQL,
            "op6_substring_dedup": OP6_SQL, "op8_quality_rules": OP8_SQL,
            "op12_embedding_near_dedup": OP12_SQL}
