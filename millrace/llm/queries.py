"""Registered queries of the text operators, with their reference SQL where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    byte_bpe, chat_format, decontaminate, filter_audit, fingerprints, importance, language, near_duplicates, pii, quality, token_counts, token_files, url_filters,
)
from millrace.llm.common import fresh_path, ready

QUERIES = {}
ORACLE = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark, sf_dir):
    """Tokens per document through a digest cache that starts empty."""
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, fresh_path(spark, "token-cache"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op3_language_id(spark, sf_dir):
    """Language of every document by error-correcting output codes."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


@query
def op4_pii(spark, sf_dir):
    """Personal data in every document: pattern matches and spans that boosted trees add."""
    docs = table(spark, sf_dir, "documents")
    return pii.measure(docs, pii.fit(docs))


@query
def op5_decontamination(spark, sf_dir):
    """Words of every document inside windows of benchmark items."""
    return decontaminate.measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of every document, and the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op7_near_duplicates(spark, sf_dir):
    """Class of near-duplicates of every document."""
    return near_duplicates.group(table(spark, sf_dir, "documents"))


@query
def op8_token_files(spark, sf_dir):
    """Ids of every document from compressed shards with an offset index."""
    return token_files.store(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)


@query
def op9_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text; how many lie within the radius of every 20th."""
    return fingerprints.search(fingerprints.edit_and_compare(table(spark, sf_dir, "documents")))


@query
def op10_quality(spark, sf_dir):
    """Quality score of every document by a hashed n-gram logistic regression."""
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op2_url_filters(spark, sf_dir):
    """Every page against the list entries that were active when it was fetched."""
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge(url_filters.captures_of(pages), url_filters.lists_of(pages)).withColumnRenamed("id", "page_id")


@query
def op11_filter_audit(spark, sf_dir):
    """What each of five filters removes, in each of their 120 orders, per language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_chat_format(spark, sf_dir):
    """All conversations, and one that says control strings, formatted as token ids and read back; the mask lies on texts alone."""
    said = "</s>[INST] ok [/INST]"
    own = ready(spark).createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(own.columns).unionByName(own)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return chat_format.format_and_read(turns, path, public_tokenizers.PATTERN, learn_end=False).drop("n_ids", "n_learnt")


@query
def op13_importance(spark, sf_dir):
    """Five percent of the documents, drawn towards the benchmark's n-grams."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_number = "('0x' || substr(md5({}), 1, 6))::BIGINT"
_host = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1))"
_path = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_dated = """
SELECT '{name}' list, '{kind}' kind, pattern, s.action, TIMESTAMP '2022-01-01' + to_days(CAST(n % 500 + s.days AS INT)) moment
FROM (SELECT pattern, n, unnest([{{'action': 'add', 'days': 0, 'valid': true}}, {{'action': 'remove', 'days': n % 150 + 1, 'valid': n % 2 = 0}},
                              {{'action': 'add', 'days': n % 150 + 200, 'valid': n % 4 = 0}}, {{'action': 'remove', 'days': n % 150 + 200, 'valid': n % 8 = 0}}]) s
      FROM (SELECT DISTINCT {kind} pattern, {number} n FROM parts)) WHERE n % {every} = 0 AND s.valid"""
ORACLE["op2_url_filters"] = f"""
WITH parts AS (
  SELECT host, array_to_string(string_split(host, '.')[-2:], '.') "domain", lower(host || '/' || regexp_extract(p, '^/([^/]+)', 1)) prefix
  FROM (SELECT {_host} host, {_path} p FROM pages) WHERE host <> '' AND len(string_split(host, '.')) > 1),
entries AS ({" UNION ALL ".join(
    _dated.format(name=name, kind=kind, every=every, number=_number.format(f"'{name}' || {kind}"))
    for name, kind, every in (("spam", "host", 3), ("adult", '"domain"', 2), ("malware", "prefix", 5))
).replace("'\"domain\"'", "'domain'")}),
captures AS (
  SELECT page_id, {_host} host, {_path} p, TIMESTAMP '2022-01-01' + to_days(CAST(n % 1000 AS INT)) + to_seconds(n % 86400) fetched_at
  FROM (SELECT *, {_number.format("concat_ws('|', page_id, url)")} n FROM pages)),
shown AS (
  SELECT page_id, fetched_at, 'host' kind, host pattern FROM captures
  UNION ALL SELECT page_id, fetched_at, 'domain', unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) FROM captures
  UNION ALL SELECT page_id, fetched_at, 'prefix', unnest(list_transform(range(1, len(s) + 1), lambda i: lower(host || '/' || array_to_string(s[1:i], '/'))))
            FROM (SELECT *, list_filter(string_split(p, '/'), lambda x: x <> '') s FROM captures)),
states AS (
  SELECT s.page_id, s.kind, s.pattern, e.list, arg_max(e.action, (e.moment, e.action)) action
  FROM shown s JOIN entries e ON e.kind = s.kind AND e.pattern = s.pattern AND e.moment <= s.fetched_at GROUP BY ALL),
found AS (SELECT page_id, list_sort(list_distinct(list(list))) lists FROM states WHERE action = 'add' GROUP BY page_id)
SELECT page_id, lists IS NOT NULL blocked, CAST(coalesce(len(lists), 0) AS BIGINT) n_lists, coalesce(array_to_string(lists, ','), '') lists
FROM pages LEFT JOIN found USING (page_id)"""

ORACLE["op5_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) n, array_to_string(w[j:j + least(len(w), 10) - 1], ' ') win
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) j FROM i WHERE len(w) > 0)),
shown AS (
  SELECT rid, j, n, array_to_string(w[j:j + n - 1], ' ') win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) j FROM d CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT * FROM shown SEMI JOIN windows USING (n, win)),
covered AS (SELECT rid, count(DISTINCT p) n_hit FROM (SELECT rid, unnest(range(j, j + n)) p FROM hits) GROUP BY rid),
items AS (SELECT rid, list_sort(list_distinct(list(item_id::VARCHAR))) ids FROM hits JOIN windows USING (n, win) WHERE item_id IS NOT NULL GROUP BY rid)
SELECT doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(len(ids), 0)::BIGINT n_items, sha256(coalesce(array_to_string(ids, ','), '')) items_sha256, n_hit IS NOT NULL contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)"""


_removed = "contains(bad, f) AND NOT gone"
ORACLE["op11_filter_audit"] = rf"""
WITH d AS (
  SELECT row_number() OVER () rid, doc_id, coalesce(lang, '') part, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
labelled AS (SELECT doc_id, max(quality) quality, max(toxic) toxic FROM labels GROUP BY doc_id),
flagged AS (
  SELECT part, coalesce(quality = 1, false) good, coalesce(toxic = 1, false) toxic, concat(
    CASE WHEN len(w) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) bad
  FROM d LEFT JOIN labelled USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] f, filter_order[:step - 1] earlier FROM (SELECT filter_order, unnest(range(1, 6)) step FROM orders)),
cells AS (SELECT part, good, toxic, bad, count(*) n FROM flagged GROUP BY ALL),
laid AS (SELECT *, step > 1 AND len(list_intersect(string_split(bad, ''), string_split(earlier, ''))) > 0 gone FROM cells, steps),
shown AS (
  SELECT part, filter_order, step, sum(n) FILTER (NOT contains(bad, f) AND NOT gone) kept, sum(n) FILTER ({_removed}) removed,
    sum(n) FILTER (contains(bad, f) AND gone) redundant, sum(n) FILTER (bad = f) unique_fails, sum(n) FILTER ({_removed} AND good) good_lost,
    sum(n) FILTER ({_removed} AND toxic) toxic_lost, any_value(f) f
  FROM laid GROUP BY part, filter_order, step),
shares AS (SELECT part, f, sum(removed) shapley FROM shown GROUP BY part, f)
SELECT part, filter_order, step::INT step, {", ".join(f"coalesce({c}, 0)::BIGINT {c}" for c in "kept removed redundant unique_fails good_lost toxic_lost shapley".split())}
FROM shown JOIN shares USING (part, f)"""


ORACLE["op12_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations
  UNION ALL SELECT -1, x, ['user', 'assistant'][x + 1], '</s>[INST] ok [/INST]' FROM range(2) s(x)),
shown AS (
  SELECT *, length(regexp_replace(t, '(<)(\\*/?s>)|(\[)(\\*(?:/?INST|/?SYS|/?ROLE|TEXT)\])', '\1\3\\\2\4', 'g')) n FROM turns)
SELECT conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) turns_sha256,
  coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT loss_chars, sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) loss_sha256,
  (3 + sum(n + CASE r WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 WHEN 'system' THEN 11 ELSE 19 + length(r) END))::BIGINT formatted_chars
FROM shown GROUP BY conv_id"""


_words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_runs = "SELECT rid, array_to_string(w[j:j + k - 1], ' ') g FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) j FROM {} CROSS JOIN range(1, 4) r(k) WHERE len(w) >= k)"
# the checksum bit by bit: each byte is put in, then seven times nothing
_bits = "flatten(list_transform(range(strlen(g)), lambda i: [('0x' || substr(hex(g), 2 * i + 1, 2))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
_crc = f"xor(4294967295, list_reduce({_bits}, lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)), 4294967295))"
ORACLE["op13_importance"] = f"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, {_words} w FROM documents),
b AS (SELECT row_number() OVER () rid, {_words} w FROM benchmark),
df AS ({_runs.format("d")}), bf AS ({_runs.format("b")}),
known AS (SELECT g, {_crc} % 10000 bucket FROM (SELECT g FROM df UNION SELECT g FROM bf)),
s AS (SELECT bucket, count(*) n FROM df JOIN known USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) n FROM bf JOIN known USING (g) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)::DOUBLE)
    / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM bf) + 10000)::DOUBLE)))::BIGINT gain FROM s LEFT JOIN t USING (bucket)),
weighed AS (SELECT rid, count(*) n_features, sum(gain)::BIGINT weight FROM df JOIN known USING (g) JOIN gains USING (bucket) GROUP BY rid),
shown AS (
  SELECT doc_id, len(w) >= 20 able, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT score
  FROM d LEFT JOIN weighed USING (rid)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) place, count(*) FILTER (able) OVER () n FROM shown)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank FROM ranked"""


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
