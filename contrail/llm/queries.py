"""Registered queries of the subpackage: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def keep(fn):
        QUERIES[name] = fn
        return fn
    return keep


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_sum_of_squares_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.packing import pack_documents
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


@query("op5_anchor_expansion_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from contrail.llm import pii
    found = pii.find_spans(read_table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select("doc_id", *(pii.count_kind(spans, k).alias(f"n_{k}") for k in pii.BASE_KINDS),
                        F.sha2(pii.digest(spans, pii.BASE_KINDS), 256).alias("base_sha256"),
                        pii.digest(spans).alias("spans"))


# The two rows that the contract adds as conversation -1.
HARD_TEXT = "</s>[INST] ok [/INST]"


@query("op8_incremental_chat_rendering")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.chat import digest_conversations, format_conversations
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", HARD_TEXT), (-1, 1, "assistant", HARD_TEXT)], rows.schema)
    return digest_conversations(format_conversations(rows.unionByName(more)))


# In the template, [ and < and \ take two characters each, and a turn adds
# [INST] + [/INST] + </s> (17 characters) and its role.
ORACLE["op8_incremental_chat_rendering"] = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(17 + length(role) + length(text)
      + length(regexp_replace(role || text, '[^\[<\\]', '', 'g'))) AS BIGINT) AS formatted_chars,
  false AS rewrites_history
FROM rows_ GROUP BY conv_id
"""


@query("op9_zstd_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from contrail.llm import language
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    learned = language.learn(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return language.identify(docs, learned, keep=("doc_id", "held_out"))


@query("op10_tree_model_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm import html_text
    pages = read_table(spark, sf_dir, "pages")
    return html_text.extract_pages(pages, html_text.train(pages))


@query("op3_mcd_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.quality_rules import verdicts
    return verdicts(read_table(spark, sf_dir, "documents"))


@query("op1_bottom_k_near_duplicates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.near_dup import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"), percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


ORACLE["op1_bottom_k_near_duplicates"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM texts),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
each AS (SELECT doc_id, unnest(s) AS x FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * i >= 85 * (p.n + q.n - i)),
reach(a, b) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT a AS doc_id, any_value(n) AS n_shingles, min(b) AS component_id, a = min(b) AS kept
FROM reach JOIN sizes ON sizes.doc_id = a GROUP BY a
"""


@query("op6_template_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.decontaminate import leaks
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("content")


@query("op2_sparse_suffix_repeats")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.repeats import repeated_passages
    return repeated_passages(read_table(spark, sf_dir, "documents"))


@query("op7_co_trained_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.quality_classifier import classify
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op11_fenwick_fill_in_middle")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from contrail.llm.fill_in_middle import fill_in_middle, restored
    out = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE["op11_fenwick_fill_in_middle"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1,
    CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2, CAST('0x' || h[17:24] AS BIGINT) % 100 AS d3,
    CAST('0x' || h[25:32] AS BIGINT) % 100 AS d4 FROM docs),
parts AS (
  SELECT doc_id, text, n, coalesce(array_to_string(u[:least(c1, c2)], ''), '') AS p,
    coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
    coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS s,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d3 >= 50
      THEN 'plain' WHEN d4 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""


@query("op12_tiled_exact_top_k")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from contrail.llm.exact_topk import QUERY_EVERY, exact_top_k
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_top_k(vectors.where(F.col("vec_id") % QUERY_EVERY == 0), vectors)


ORACLE["op12_tiled_exact_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0)
    AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k, vec_id, score FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""


@query("op13_rabin_karp_collocations")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.collocations import collocations
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE["op13_rabin_karp_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
runs AS (SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase FROM places, (SELECT unnest(range(1, 6)) AS s) t
  WHERE i + s - 1 <= len(w)),
f AS (SELECT lang, s, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, s, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE s >= 2),
kept AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand d WHERE d.lang = c.lang AND d.s > c.s
    AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.a >= 100 * c.a)),
cuts AS (SELECT kept.*, unnest(range(1, s)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
    CAST((1000 * CAST(c.a AS HUGEINT) * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""
