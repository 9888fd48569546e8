"""One registered query per operator, over its whole table, and the DuckDB SQL of those
that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat, language_id, licenses, mixing, order_minhash, packing, quality_rules, resampling, sharding,
               simhash, spelling, suffix_dedup, warc)
from .common import table


def tokenizer_path() -> str:
    """Default vocabulary file; the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper",
        "n_lines", "base_failed", "kept")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op3_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_through_archives(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op5_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(table(spark, sf_dir, "documents"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_fingerprints(table(spark, sf_dir, "documents"))


def op9_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation whose texts are nothing but control strings and what they frame.
CONTROLS_IN_CONTENT = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROLS_IN_CONTENT, "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(rows.unionByName(more), public_tokenizers.path("byte_bpe_50k.json"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_language_id, op3_warc_normaliser, op4_license_scan, op5_cost_packing, op6_simhash,
        op7_suffix_dedup, op8_order_minhash, op9_minimax_shards, op10_mixture, op11_target_resampling,
        op12_chat_format, op13_spelling_variants, pipeline)}

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CRC = 0xEDB88320                  # the polynomial of CRC-32, bits reversed
_CONTROL = r"(<\\*|\[\\*)(/?s>|/?INST\]|<SYS>>|</SYS>>|/?ROLE\]|/TURN\])"

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
grams AS (
  SELECT doc_id, i, w[i:i+4] AS gram FROM (
    SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, gram FROM grams GROUP BY doc_id, gram HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT g.doc_id, unnest(generate_series(g.i, g.i + 4)) AS p
    FROM grams g JOIN twice USING (doc_id, gram)) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n, count(*) AS n_lines FROM (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper, coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
r AS (
  SELECT *, n_symbols * 1000000 // greatest(n_words, 1) AS symbols_per_word,
         word_chars * 1000000 // greatest(n_words, 1) AS chars_per_word,
         n_repeat_words * 1000000 // greatest(n_words, 1) AS repeat_share,
         n_upper * 1000000 // greatest(word_chars, 1) AS upper_share,
         n_dup_lines * 1000000 // greatest(n_lines, 1) AS dup_line_share FROM m),
u AS (
  SELECT lang, source, 'symbols_per_word' AS ratio, symbols_per_word AS v FROM r WHERE n_words > 0
  UNION ALL SELECT lang, source, 'chars_per_word', chars_per_word FROM r WHERE n_words > 0
  UNION ALL SELECT lang, source, 'repeat_share', repeat_share FROM r WHERE n_words > 0
  UNION ALL SELECT lang, source, 'upper_share', upper_share FROM r WHERE n_words > 0
  UNION ALL SELECT lang, source, 'dup_line_share', dup_line_share FROM r WHERE n_words > 0),
b AS (
  SELECT lang, source, ratio, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bucket
  FROM u),
g AS (SELECT lang, source, ratio, bucket, count(*) * 100 AS n FROM b GROUP BY ALL),
l AS (SELECT lang, ratio, bucket, sum(n)::BIGINT AS n FROM g GROUP BY ALL),
a AS (
  SELECT ratio, bucket, (5000 * sum(n)::BIGINT) // (sum(sum(n)) OVER (PARTITION BY ratio))::BIGINT AS n
  FROM l GROUP BY ratio, bucket),
ls AS (
  SELECT lang, ratio, bucket, sum(n)::BIGINT AS n FROM (
    SELECT * FROM l
    UNION ALL SELECT k.lang, k.ratio, a.bucket, a.n FROM (SELECT DISTINCT lang, ratio FROM l) k JOIN a USING (ratio))
  GROUP BY ALL),
lp AS (SELECT lang, ratio, bucket, (5000 * n) // (sum(n) OVER (PARTITION BY lang, ratio))::BIGINT AS n FROM ls),
s AS (
  SELECT lang, source, ratio, bucket, sum(n)::BIGINT AS n FROM (
    SELECT * FROM g
    UNION ALL SELECT k.lang, k.source, k.ratio, lp.bucket, lp.n
    FROM (SELECT DISTINCT lang, source, ratio FROM g) k
    JOIN lp ON lp.ratio = k.ratio AND lp.lang IS NOT DISTINCT FROM k.lang)
  GROUP BY ALL),
c AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, ratio ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY lang, source, ratio) AS total FROM s),
q AS (
  SELECT lang, source, ratio, min(CASE WHEN 4 * upto >= total THEN bucket END) AS q1,
         min(CASE WHEN 4 * upto >= 2 * total THEN bucket END) AS q2,
         min(CASE WHEN 4 * upto >= 3 * total THEN bucket END) AS q3 FROM c GROUP BY ALL),
bounds AS (
  SELECT lang, source, ratio, q2 + 6 * greatest(2 * (q2 - q1), least_spread) AS hi,
         CASE WHEN ratio = 'chars_per_word' THEN q2 - 6 * greatest(2 * (q3 - q2), least_spread) END AS lo
  FROM q JOIN (VALUES ('symbols_per_word', 30000), ('chars_per_word', 300000),
                      ('repeat_share', 30000), ('upper_share', 60000), ('dup_line_share', 60000)) x(ratio, least_spread) USING (ratio)),
wide AS (
  SELECT lang, source, max(hi) FILTER (ratio = 'symbols_per_word') AS s_hi,
         max(hi) FILTER (ratio = 'chars_per_word') AS c_hi, max(lo) FILTER (ratio = 'chars_per_word') AS c_lo,
         max(hi) FILTER (ratio = 'repeat_share') AS r_hi, max(hi) FILTER (ratio = 'upper_share') AS u_hi,
         max(hi) FILTER (ratio = 'dup_line_share') AS d_hi
  FROM bounds GROUP BY ALL),
judged AS (
  SELECT r.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         coalesce(symbols_per_word <= s_hi, true) AND coalesce(chars_per_word <= c_hi, true)
         AND coalesce(chars_per_word >= c_lo, true) AND coalesce(repeat_share <= r_hi, true)
         AND coalesce(upper_share <= u_hi, true) AND coalesce(dup_line_share <= d_hi, true) AS inside
  FROM r LEFT JOIN wide ON wide.lang IS NOT DISTINCT FROM r.lang AND wide.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lines, base_failed,
       NOT base_failed AND inside AS kept FROM judged""",
    "op3_warc_normaliser": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS last, count(*) AS n FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, (10 * (k // 8) + 1)::BIGINT, 10))::BIGINT >> (35 - 5 * (k % 8))::BIGINT) & 31) + 1)::BIGINT, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last OR last IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last OR last IS NULL THEN NULL ELSE last END AS refers_to
FROM p JOIN g USING (h)""",
    "op11_target_resampling": rf"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_CRC}) ELSE c >> 1 END)) AS tab),
w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_LETTERS}')) AS word
  FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_LETTERS}')) AS word FROM benchmark),
known AS (
  SELECT word, xor(list_reduce([4294967295] || list_transform(range(1, strlen(word) + 1),
           lambda i: ('0x' || substr(hex(encode(word)), (2 * i - 1)::BIGINT, 2))::BIGINT),
           lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM w UNION SELECT word FROM b), crc),
s AS (SELECT bucket, count(*) AS n FROM w JOIN known USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN known USING (word) GROUP BY bucket),
gain AS (
  SELECT s.bucket, floor(1000.0::DOUBLE * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
         / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
f AS (
  SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight
  FROM w JOIN known USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE + 0.5)
           / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN f USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM d WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM r) * 10 // 100 THEN rank END AS rank, n_features AS n_words
FROM d LEFT JOIN r USING (doc_id)""",
    "op12_chat_format": rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(regexp_replace(text, '{_CONTROL}', '\1\\\2', 'g')) + CASE role
    WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 WHEN 'system' THEN 15
    ELSE 20 + length(regexp_replace(role, '{_CONTROL}', '\1\\\2', 'g')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_CRC}) ELSE c >> 1 END)) AS tab),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run
    FROM documents) GROUP BY doc_id, run HAVING length(run) >= 6),
hashed AS (
  SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(1, strlen(doc_id || ':' || run) + 1),
           lambda i: ('0x' || substr(hex(encode(doc_id || ':' || run)), (2 * i - 1)::BIGINT, 2))::BIGINT),
           lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM runs, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END
             AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gone AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (
    SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM gone a JOIN gone b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    AND length(a.word) = length(b.word)
  UNION SELECT w.word, g.word FROM words w JOIN gone g ON g.rest = w.word
  UNION SELECT g.word, w.word FROM words w JOIN gone g ON g.rest = w.word),
best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS form_n, arg_min(other, (-o.n, other)) AS form
  FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
         CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f
JOIN (SELECT chain.word, arg_min(root, forms.n) FILTER (forms.form IS NULL) AS root
      FROM chain JOIN forms ON forms.word = chain.root GROUP BY chain.word) c ON c.word = f.word""",
}
