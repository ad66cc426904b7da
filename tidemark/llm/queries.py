"""The numbered queries over whole tables, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    langid,
    licenses,
    minhash,
    mixing,
    near_vectors,
    prefix_tree,
    quality,
    resample,
    secrets,
    simhash,
    substrings,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.folds("doc_id", 0, 5)))
    found = langid.predict(docs, model)
    return found.select("doc_id", langid.folds("doc_id", 0, 5).alias("held_out"), "lang_pred", "score")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("hits", lambda h: h["base"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda h: h["start"])).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["containment"])), F.lit(0.0)).alias("score"),
    )


def _labels(hits):
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(_table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    counts = [_kind_count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select(
        F.col("path").alias("doc_id"),
        *counts,
        F.sha2(_spans(base), 256).alias("base_sha256"),
        _spans(F.col("spans")).alias("spans"),
    )


def _kind_count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


def _spans(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    items = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words("spans").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = langid.folds("doc_id", 2, 4)
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), train_rows=~held)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources stand for hosts, the languages of a source for its paths."""
    held = langid.folds("doc_id", 1, 4)
    found = quality.classify(
        _table(spark, sf_dir, "documents"),
        _table(spark, sf_dir, "labels"),
        host=F.col("source"),
        path=F.col("lang"),
        train_rows=~held,
    )
    return found.withColumn("held_out", held)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree.prefix_tree(_table(spark, sf_dir, "conversations"), shared=(20, 4))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_license_scan,
        op3_fingerprints,
        op4_simhash_near_dedup,
        op5_secret_scan,
        op6_decontamination,
        op7_mixing,
        op8_toxicity,
        op9_substring_dedup,
        op10_quality,
        op11_importance_resampling,
        op12_prefix_trie,
        op13_embedding_near_dedup,
    )
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# CRC-32 by its table, which is made from the polynomial; ``x`` is the text in hex.
_CRC_TABLE = """steps(i, j, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) AS t(i)
  UNION ALL
  SELECT i, j + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE j < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE j = 8)"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x) + 1, 2),
  lambda k: ('0x' || x[k:k + 1])::BIGINT)), lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295)"""



def _license_rows() -> str:
    """Label, base, words in order, distinct words and block span of every phrase and template, as SQL values."""
    index = licenses.Index(licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD)
    words = [w.decode() for w in index.vocabulary]
    return ",\n  ".join(
        f"('{r.label}', {r.base}, {[words[t] for t in r.sequence]}, {sorted({words[t] for t in r.sequence})}, {r.span})"
        for r in index.records
    )


ORACLES = {
    "op2_license_scan": rf"""
WITH records(label, base, seq, toks, span) AS (VALUES
  {_license_rows()}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
phrases AS (
  SELECT r, label, s - 1 AS s
  FROM d, records, unnest(range(1, len(w) - len(seq) + 2)) AS t(s)
  WHERE base AND len(w) >= len(seq) AND w[s] = seq[1] AND w[s:s + len(seq) - 1] = seq),
shares AS (
  SELECT r, label, len(list_intersect(list_distinct(w[b + 1:b + 2 * span]), toks))::DOUBLE / len(toks) AS share
  FROM d, records, unnest(range(0, len(w), span)) AS t(b) WHERE NOT base),
found AS (
  SELECT r, label, true AS base, s, 1.0::DOUBLE AS share FROM phrases
  UNION ALL SELECT r, label, false, NULL, share FROM shares WHERE share >= 0.8::DOUBLE),
total AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(s) AS first_word, max(s) AS last_word, max(share) AS score,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN total USING (r)""",
    "op6_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
items AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS words
  FROM items, unnest(range(1, len(w) - size + 2)) AS t(s)),
sizes AS (SELECT DISTINCT size FROM items),
found AS (
  SELECT doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS words
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(s) WHERE len(w) >= size),
hits AS (SELECT doc_id, item_id, f.s, f.size FROM found f JOIN item_windows i USING (size, words)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN named ON d.doc_id = named.doc_id""",
    "op7_mixing": r"""
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (
  SELECT source, source_size, 3 * source_size AS bound,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s),
o AS (
  SELECT *, row_number() OVER w AS k, sum(bound) OVER w AS held, sum(weight) OVER w AS gone
  FROM n WINDOW w AS (ORDER BY bound::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
tot AS (SELECT sum(source_size) AS total, sum(weight) AS weights FROM n),
lev AS (
  SELECT k, bound, weight, ((total - (held - bound))::DOUBLE) / ((weights - (gone - weight))::DOUBLE) AS level FROM o, tot),
cut AS (SELECT level FROM lev WHERE weight * level <= bound ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN weight * level > bound THEN bound::DOUBLE ELSE weight * level END AS target FROM n, cut),
classes AS (
  SELECT source, length(bin(size))::DOUBLE AS weight, sum(size)::BIGINT AS words FROM d WHERE size > 0 GROUP BY ALL),
rated AS (
  SELECT c.source, weight, (target - 3.0::DOUBLE * (sum(words) OVER w - words)::DOUBLE)
    / (sum(words * weight) OVER (PARTITION BY c.source) - sum(words * weight) OVER w + words * weight) AS rate
  FROM classes c JOIN t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW w AS (PARTITION BY c.source ORDER BY weight DESC ROWS UNBOUNDED PRECEDING)),
rates AS (SELECT source, max_by(rate, weight) AS rate FROM rated WHERE rate * weight <= 3.0::DOUBLE GROUP BY source),
tr AS (
  SELECT t.*, coalesce(rate, CASE WHEN target > 0 THEN 1e300::DOUBLE ELSE 0::DOUBLE END) AS rate
  FROM t LEFT JOIN rates ON t.source IS NOT DISTINCT FROM rates.source),
r AS (
  SELECT d.doc_id, d.size, d.u, tr.source, tr.source_size, tr.target,
    least(rate * length(bin(d.size))::DOUBLE, 3.0::DOUBLE) AS expected
  FROM d JOIN tr ON d.source IS NOT DISTINCT FROM tr.source),
q AS (
  SELECT *, floor(expected)::BIGINT AS whole, expected - floor(expected) AS share,
    (u / (1 - u)) / ((expected - floor(expected)) / (1 - (expected - floor(expected)))) AS odds FROM r),
p AS (
  SELECT *, CASE WHEN share > 0 THEN odds / (1 + odds) END AS key,
    target - sum(whole * size) OVER (PARTITION BY source) AS rest FROM q),
c AS (
  SELECT *, sum(CASE WHEN key IS NOT NULL THEN size END) OVER (
    PARTITION BY source ORDER BY key NULLS LAST, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM p)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN key IS NOT NULL AND upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM c""",
    "op9_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS h
  FROM d, unnest(range(1, len(w) - 18)) AS t(s) WHERE len(w) >= 20),
later AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM later) GROUP BY doc_id),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM d),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY p) AS t
  FROM words LEFT JOIN (SELECT doc_id, unnest(ps) AS p, true AS hit FROM gone) g USING (doc_id, p)
  WHERE hit IS NULL GROUP BY words.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op11_importance_resampling": f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
f AS (SELECT r, unnest(w) AS word FROM d),
b AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
words AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM f UNION SELECT word FROM b)),
bucket AS (SELECT word, {_CRC} % 10000 AS bucket FROM words, crc),
s AS (SELECT bucket, count(*) AS s FROM f JOIN bucket USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN bucket USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM f JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS k,
    count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank
FROM ranked""",
    "op12_prefix_trie": rf"""
WITH RECURSIVE {_CRC_TABLE},
o AS (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, hex(encode(c::VARCHAR)) AS x FROM (SELECT DISTINCT c FROM o)),
convs AS (SELECT c, c - c % 20 AS base, {_CRC} % 4 AS h FROM n, crc),
given AS (SELECT convs.c, pos, k, words FROM convs JOIN o ON o.c = base WHERE pos < h),
turns AS (
  SELECT * FROM given
  UNION ALL SELECT c, 1000000 + pos, k, words FROM o JOIN convs USING (c) WHERE pos >= h),
seq AS (
  SELECT c, coalesce(list(k ORDER BY pos) FILTER (k IS NOT NULL), []) AS s,
    coalesce(list(words ORDER BY pos) FILTER (k IS NOT NULL), []) AS w
  FROM convs LEFT JOIN turns USING (c) GROUP BY c),
paths AS (
  SELECT c, d, s[1:d] AS p, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words, len(s) = d AS ends
  FROM seq, unnest(range(0, len(s) + 1)) AS t(d)),
nodes AS (
  SELECT p, d, min(c) AS c, count(*) AS n, (count(*) - 1) * any_value(words) AS gain,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS sha
  FROM paths GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)),
below AS (
  SELECT p[1:a] AS p, sum((n_children = 0)::INT) AS n_leaves, sum(gain) AS saved
  FROM whole, unnest(range(0, d + 1)) AS t(a) GROUP BY ALL)
SELECT whole.c::BIGINT AS conv_id, whole.d::BIGINT AS depth, up.c::BIGINT AS parent_conv_id, whole.n::BIGINT AS n_convs,
  whole.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, whole.sha AS ends_sha256
FROM whole JOIN below USING (p) LEFT JOIN nodes up ON whole.d > 0 AND up.p = whole.p[1:whole.d - 1]""",
    "op13_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (
  SELECT r, vec_id, label, e FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND list_aggregate(e, 'count') = len(e)
    AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) >= 0.93::DOUBLE * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
reach(r, other) AS (
  SELECT r, r FROM v
  UNION
  SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other),
named AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.other GROUP BY reach.r),
degrees AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN named USING (r) LEFT JOIN degrees USING (r)""",
}
