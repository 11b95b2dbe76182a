"""The registered queries of this folder: thin digests of its operators over whole tables."""

from pyspark.sql import functions as F

from bookbase.llm import (
    audit, bpe, language, mixing, packing, periodic, sampling, scoring, sharding, simhash, suffixes, topk, toxicity,
)


def _documents(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def op1_simhash(spark, d):
    groups = simhash.near_groups(_documents(spark, d))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_packing(spark, d):
    return packing.pack_documents(_documents(spark, d))


def op3_suffixes(spark, d):
    return suffixes.passage_rows(_documents(spark, d))


def op4_topk(spark, d):
    vectors = spark.read.parquet(f"{d}/embeddings.parquet")
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op5_sharding(spark, d):
    rows = sharding.shard_documents(_documents(spark, d), 40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op6_language(spark, d):
    return language.identify(_documents(spark, d))


def op7_toxicity(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return toxicity.score_documents(_documents(spark, d), labels)


def op8_scoring(spark, d):
    return scoring.score_documents(_documents(spark, d))


def op9_fingerprints(spark, d):
    rows = sampling.edited_fingerprints(_documents(spark, d))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", sampling.fingerprint("samples").alias("fingerprint"),
        sampling.fingerprint("edited_samples").alias("edited_fingerprint"),
        sampling.likeness("samples", "edited_samples").alias("near_edited"),
        sampling.likeness("samples", "next_samples").alias("near_next"),
    )


def op10_mixing(spark, d):
    rows = mixing.mix_sizes(_documents(spark, d))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "shards")


def planted_words(docs):
    """Words of every text, with the contract's periodic tail planted where crc32(doc_id) ends in 0.

    h = crc32 of the decimal doc_id, g = h div 10; when h % 10 = 0 and the text has n > 0 words,
    word i >= a becomes word a + (i - a) % p, a = g % n, p = 1 + (n - a) div (3 + g % 8).
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), audit.SPLIT), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.select("doc_id", words.alias("words"), h.alias("h"))
    docs = docs.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    planted = F.transform(
        "words", lambda w, i: F.when(i >= F.col("a"), F.col("words")[(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")]).otherwise(w)
    )
    chosen = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    return docs.select("doc_id", F.when(chosen, planted).otherwise(F.col("words")).alias("words"))


def op11_periodic(spark, d):
    return periodic.periodic_runs(planted_words(_documents(spark, d)))


def op12_bpe(spark, d):
    import public_tokenizers

    return bpe.encode_documents(_documents(spark, d), public_tokenizers.path("byte_bpe_50k.json"))


def op13_audit(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return audit.interaction_audit(_documents(spark, d), labels)


QUERIES = [
    op1_simhash, op2_packing, op3_suffixes, op4_topk, op5_sharding, op6_language, op7_toxicity, op8_scoring,
    op9_fingerprints, op10_mixing, op11_periodic, op12_bpe, op13_audit,
]

OP3_SQL = r"""
WITH worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), passage AS (
  SELECT doc_id, s AS start, array_to_string(words[s + 1 : s + 50], ' ') AS run
  FROM worded, unnest(range(0, len(words) - 49)) AS u(s)
), holder AS (
  SELECT run, min(doc_id) AS low FROM passage GROUP BY run HAVING min(doc_id) <> max(doc_id)
), marked AS (
  SELECT doc_id, start, doc_id <> low AS cut FROM passage JOIN holder USING (run)
), grown AS (
  SELECT *, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id ORDER BY start) <= 50 THEN 0 ELSE 1 END AS new
  FROM marked
), named AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY start) AS span FROM grown
), cut_up AS (
  SELECT *, start + 50 - greatest(start, coalesce(
    max(CASE WHEN cut THEN start + 50 END)
      OVER (PARTITION BY doc_id, span ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS fresh
  FROM named
)
SELECT doc_id, min(start)::INT AS start_word, (max(start) + 50)::INT AS end_word,
       sum(CASE WHEN cut THEN fresh ELSE 0 END)::INT AS cut_words
FROM cut_up GROUP BY doc_id, span
"""

OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d
), firsts AS (
  SELECT t, min(doc_id) AS first FROM d GROUP BY t
), f AS (
  SELECT w.doc_id, part,
    (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 10 * length(w.t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN (w.doc_id IS NULL AND firsts.first IS NOT NULL) OR w.doc_id > firsts.first THEN 16 ELSE 0 END) AS mask
  FROM w JOIN firsts ON w.t = firsts.t
), lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN lab ON f.doc_id = lab.doc_id GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, b)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31
), steps AS (
  SELECT filter_order, s AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0) AS before
  FROM orders, range(1, 6) r(s)
), grid AS (
  SELECT part, filter_order, step, bit, n, good, toxic,
         (mask & bit) <> 0 AS here, (mask & before) <> 0 AS earlier, mask = bit AS alone
  FROM cells, steps
), tab AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN NOT here AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN here AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN here AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN here AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN here AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM grid GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM tab
"""


def queries():
    return {f.__name__: f for f in QUERIES}


def statements():
    """SQL for those that SQL can state."""
    return {"op3_suffixes": OP3_SQL, "op4_topk": OP4_SQL, "op13_audit": OP13_SQL}
