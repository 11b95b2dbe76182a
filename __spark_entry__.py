"""Registered queries and their SQL counterparts; see `oracles.py` for the SQL."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookbase import fixtures as B
from bookbase.functions import text as X
from bookbase.operators import ask as A
from bookbase.operators import chunk as C
from bookbase.operators import centre_tree, clean, embed, extract, generations, keys, knn, lemma
from bookbase.operators import lookup as L
from bookbase.plans.catalogue import book_vectors, books_from_catalogue, build_store, catalogue_from_pages, dropped_books
from bookbase.plans.questions import prepare_batch
from bookbase.session import materialise, scratch_path, ship
from bookbase.sources import catalogue as cat
from bookbase.sources import pages as pg
from bookbase.sources import vectors as vec
from bookbase.streaming.questions import prepare_stream, read_prepared

STOP = X.STOP_WORDS


def _round(df, column="distance"):
    return df.withColumn(column, F.round(column, 6))


def _store(spark, d):
    return book_vectors(B.books(spark, d))


def _requests(spark, d):
    return B.questions(spark, d).select("qid", "text")


def _line(df, column="answer"):
    return df.withColumn(column, F.array_join(column, " | "))


# --- sources and sinks -----------------------------------------------------------------------


def src_page_ids(spark, d):
    n = B.table(spark, d, "pages").agg(F.max("page_id")).first()[0] + 1
    return pg.page_ids(spark, n)


def src_pages(spark, d):
    pages = pg.read_pages(spark, f"{d}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("bigint").alias("size"))


def sink_raw_roundtrip(spark, d):
    path = scratch_path(spark, "raw")
    cat.write_raw_catalogue(B.raw_catalogue(spark, d), path)
    return cat.read_raw_catalogue(spark, path, None, cat.RAW_FIELDS)


def src_first_n(spark, d):
    path = scratch_path(spark, "raw")
    raw = B.catalogue(spark, d)
    padded = raw.select(
        "pos", F.col("author").alias("Author"), F.col("title").alias("Title"), F.col("summary").alias("Summary"),
        F.col("subject").alias("Subject"), F.col("ebook_no").cast("string").alias("EBook-No."),
        F.lit(None).cast("string").alias("Release Date"),
        *[F.lit("").alias(f) for f in cat.RAW_FIELDS if f not in cat.CLEAN_FIELDS],
    )
    cat.write_raw_catalogue(padded, path, "pos")
    return cat.read_raw_catalogue(spark, path, 1500)


def _clean_rows(spark, d):
    return B.raw_catalogue(spark, d).select("page_id", *[f"`{f}`" for f in cat.CLEAN_FIELDS])


def sink_clean_roundtrip(spark, d):
    path = scratch_path(spark, "clean")
    cat.write_clean_catalogue(_clean_rows(spark, d), path, "page_id")
    return spark.read.csv(path, sep=";", header=True, multiLine=True, escape='"')


def src_clean(spark, d):
    path = scratch_path(spark, "clean")
    cat.write_clean_catalogue(_clean_rows(spark, d), path, "page_id")
    return cat.read_clean_catalogue(spark, path)


def row_to_text(spark, d):
    part = B.table(spark, d, "part")
    return cat.rows_to_text(part, ["p_name", "p_brand", "p_type"]).select("p_partkey", "document")


def text_to_fields(spark, d):
    part = B.table(spark, d, "part").withColumn("p_type", F.concat("p_type", F.lit(": lost: tail")))
    part = part.withColumn("p_name", F.concat("p_name", F.lit("\nno field here\np_brand: early ")))
    texts = cat.rows_to_text(part, ["p_name", "p_brand", "p_type"])
    fields = cat.text_to_map(texts, "document")
    return fields.select("p_partkey", F.explode("fields").alias("field", "value"))


def vec_load_or_create(spark, d):
    path = scratch_path(spark, "vectors")
    vec.load_or_create(spark, path, lambda: B.vectors(spark, d))
    again = vec.load_or_create(spark, path, lambda: B.vectors(spark, d).limit(0))
    return again.select("book_key", "ebook_no", "meta.title", "meta.author", "meta.subject")


def store_append_indexed(spark, d):
    """The store grows in two appends and its index with it, one generation each; every vector
    is then asked for its 5 nearest through the newest generation (exact search by cells)."""
    path, root = scratch_path(spark, "vectors"), scratch_path(spark, "generations")
    labelled = B.table(spark, d, "labels").select(F.col("doc_id").alias("ebook_no"))
    generations.append_indexed(B.vectors(spark, d).join(labelled, "ebook_no", "left_semi"), path, root)
    store, newest = generations.append_indexed(B.vectors(spark, d), path, root)
    q = store.select(F.col("ebook_no").alias("qid"), "embedding")
    return knn.knn_cells(q, newest, 5).withColumnRenamed("cid", "ebook_no")


def vec_append_new(spark, d):
    path = scratch_path(spark, "vectors")
    labelled = B.table(spark, d, "labels").select(F.col("doc_id").alias("ebook_no"))
    vec.append_vectors(B.vectors(spark, d).join(labelled, "ebook_no", "left_semi"), path)
    return vec.append_vectors(B.vectors(spark, d), path).select("book_key", "ebook_no")


def vec_count(spark, d):
    return vec.describe_vectors(B.vectors(spark, d))


def vec_peek(spark, d):
    return vec.peek(B.vectors(spark, d)).select("book_key", "text", "title", "author", "ebook_no", "subject")


# --- pages -----------------------------------------------------------------------------------


def page_pairs(spark, d):
    return extract.rows_to_pairs(extract.pick_table(B.pages_gen(spark, d)))


def page_fields(spark, d):
    return extract.page_fields(B.pages_gen(spark, d))


def page_fields_multi(spark, d):
    fields = extract.page_fields(B.pages_gen(spark, d), headers=["Title", "Subject"], multi=True)
    return fields.select("page_id", F.array_join("Title", "|").alias("titles"), F.array_join("Subject", "|").alias("subjects"))


def page_head(spark, d):
    return extract.page_head(B.table(spark, d, "pages"))


# --- cleaning --------------------------------------------------------------------------------


def clean_fill(spark, d):
    return clean.fill_missing(B.raw_catalogue(spark, d).select("page_id", *[f"`{f}`" for f in cat.CLEAN_FIELDS]))


def clean_author(spark, d):
    return B.raw_catalogue(spark, d).select("page_id", X.strip_dates("Author").alias("author"))


def clean_text(spark, d):
    return B.table(spark, d, "documents").select("doc_id", X.clean_text("text").alias("text"))


def clean_stopwords(spark, d):
    return clean_text(spark, d).withColumn("text", X.drop_stopwords("text", STOP))


def clean_lemma(spark, d):
    return lemma.lemmatise(clean_text(spark, d), ["text"], B.vocabulary(spark, d))


def clean_lemma_joined(spark, d):
    return lemma.lemmatise(B.table(spark, d, "documents").select("doc_id", X.clean_text("text").alias("text")), ["text"], B.vocabulary(spark, d))


def clean_keywords(spark, d):
    docs = B.table(spark, d, "documents").select("doc_id", "text")
    return clean.keyword_summary(docs, "text", B.vocabulary(spark, d), stop=STOP)


def clean_catalogue(spark, d):
    raw = B.raw_catalogue(spark, d).select("page_id", *[f"`{f}`" for f in cat.CLEAN_FIELDS])
    return clean.clean_catalogue(clean.require_columns(raw), B.vocabulary(spark, d), stop=STOP)


def catalogue_job(spark, d):
    made = catalogue_from_pages(B.pages_gen(spark, d), B.vocabulary(spark, d), stop=STOP)
    return made.select("page_id", *[f"`{f}`" for f in cat.CLEAN_FIELDS])


def _catalogue_books(spark, d):
    raw = B.raw_catalogue(spark, d).select("page_id", *[f"`{f}`" for f in cat.CLEAN_FIELDS])
    raw = raw.withColumn("Raw Summary", F.col("Summary"))
    return books_from_catalogue(clean.clean_catalogue(raw, B.vocabulary(spark, d), stop=STOP))


def catalogue_books(spark, d):
    return _catalogue_books(spark, d)


def catalogue_dropped(spark, d):
    return dropped_books(_catalogue_books(spark, d))


def _built(spark, d):
    return build_store(B.books(spark, d), scratch_path(spark, "store"), scratch_path(spark, "index"))


def build_store_rows(spark, d):
    store, index = _built(spark, d)
    indexed = knn.index_vectors(spark, index).select(F.col("cid").alias("ebook_no"))
    return store.join(indexed, "ebook_no").select("book_key", "ebook_no", "meta.title", "meta.author", "text")


# --- keys and chunks -------------------------------------------------------------------------


def key_hash(spark, d):
    return keys.with_hash_key(B.catalogue(spark, d)).select("ebook_no", "book_key")


def key_uuid(spark, d):
    made = materialise(keys.with_uuid(B.catalogue(spark, d)).select("ebook_no", "book_key"), "uuid")
    form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return made.agg(
        F.count("ebook_no").alias("keyed"), F.countDistinct("book_key").alias("different"),
        F.count(F.when(~F.col("book_key").rlike(form), 1)).alias("malformed"),
    )


def key_seq(spark, d):
    used = B.table(spark, d, "labels").select((F.col("doc_id") + 1).alias("book_key"))
    return keys.with_seq_key(B.catalogue(spark, d), used).select("ebook_no", "book_key")


def key_name(spark, d):
    return keys.with_name_key(B.catalogue(spark, d)).select("ebook_no", "book_key")


def batch_no(spark, d):
    return keys.with_batch(B.catalogue(spark, d)).select("ebook_no", "batch")


def meta_struct(spark, d):
    return keys.with_meta(B.catalogue(spark, d)).select("pos", "meta.*")


def chunk_fixed(spark, d):
    return C.chunk(B.table(spark, d, "documents").select("doc_id", "text"), "text")


def chunk_recursive(spark, d):
    """What has to hold of the chunks of each text, and the chunk of a text that fits into one."""
    docs = B.table(spark, d, "documents").select("doc_id", "text")
    made = C.chunk(docs, "text", mode="recursive").groupBy("doc_id").agg(
        F.max(F.length("chunk")).alias("longest"), F.flatten(F.collect_list(X.words("chunk"))).alias("held"),
        F.max(F.when(F.col("chunk_no") == 0, F.col("chunk"))).alias("first"),
    )
    return docs.join(made, "doc_id").select(
        "doc_id", (F.col("longest") <= 1500).alias("fits"),
        (F.size(F.array_except(X.words("text"), "held")) == 0).alias("covered"),
        F.when(F.length("text") <= 1500, F.col("first")).alias("only"),
    )


# --- vectors ---------------------------------------------------------------------------------


def _embedded(spark, d):
    return embed.embed(clean_text(spark, d), "text").select("doc_id", "embedding")


def embed_hash(spark, d):
    rows = embed.sparse(_embedded(spark, d))
    return rows.select("doc_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight"))


def embed_idf(spark, d):
    texts = clean_text(spark, d)
    weights = embed.idf_weights(texts, "text")
    rows = embed.sparse(embed.embed(texts, "text", idf=weights).select("doc_id", "embedding"))
    return rows.select("doc_id", "bucket", F.round(F.col("weight").cast("double"), 5).alias("weight"))


def embed_norm(spark, d):
    square = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    # The outer form keeps the optimizer from working out a vector once to test it and once more to use it.
    norm = F.explode_outer(F.array(F.round(square, 4))).alias("norm")
    return _embedded(spark, d).select("doc_id", norm).filter("norm IS NOT NULL")


def embed_questions(spark, d):
    made = L.default_embedder()(_requests(spark, d)).select("qid", "embedding")
    rows = embed.sparse(made)
    return rows.select("qid", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight"))


def embed_model(spark, d):
    made = embed.embed_with(clean_text(spark, d), "text", B.counting_model)
    e = F.col("embedding")
    return made.filter(e.isNotNull()).select(
        "doc_id", F.get(e, F.lit(0)).cast("bigint").alias("size"), F.get(e, F.lit(1)).cast("bigint").alias("blanks")
    )


def _self(spark, d):
    v = B.vectors(spark, d)
    return v.select(F.col("ebook_no").alias("qid"), "embedding"), v.select("ebook_no", "embedding")


def _knn(metric):
    return lambda spark, d: knn.knn(*_self(spark, d), k=5, metric=metric)


def _knn_cells(metric):
    def run(spark, d):
        q, c = _self(spark, d)
        index = knn.build_cells(c, scratch_path(spark, "cells"), metric=metric)
        return knn.knn_cells(q, index, 5).withColumnRenamed("cid", "ebook_no")

    return run


def knn_filtered(spark, d):
    labels = B.table(spark, d, "labels").select(F.col("doc_id").alias("ebook_no"), "quality")
    q, c = _self(spark, d)
    return knn.knn(q, c.join(labels, "ebook_no"), k=5, where=F.col("quality") == 1)


def knn_filtered_indexed(spark, d):
    """As knn_filtered, through a stored index of the whole corpus: only rows that pass count."""
    labels = B.table(spark, d, "labels").select(F.col("doc_id").alias("ebook_no"), "quality")
    q, c = _self(spark, d)
    index = knn.build_cells(c, scratch_path(spark, "cells"))
    return knn.knn(q, c.join(labels, "ebook_no"), k=5, where=F.col("quality") == 1, index=index)


def knn_approx(spark, d):
    q, c = _self(spark, d)
    given = c.filter("ebook_no < 16").orderBy("ebook_no").collect()  # 16 vectors
    index = knn.build_cells(c, scratch_path(spark, "cells"), centres=[r["embedding"] for r in given])
    return knn.knn_approx(q, index, 5, probe=8).withColumnRenamed("cid", "ebook_no")


def knn_tree_l2(spark, d):
    """Exact 5 nearest of every vector through a two-level centre tree (no limit on cells)."""
    q, c = _self(spark, d)
    path = centre_tree.build_tree(c, scratch_path(spark, "tree"))
    return centre_tree.knn_tree(q, path, 5).withColumnRenamed("cid", "ebook_no")


def knn_tree_approx(spark, d):
    """Beam search of the tree: the 3 nearest groups, then the 8 nearest of their cells."""
    q, c = _self(spark, d)
    path = centre_tree.build_tree(c, scratch_path(spark, "tree"))
    return centre_tree.knn_tree_approx(q, path, 5, beam=3, probe=8).withColumnRenamed("cid", "ebook_no")


def knn_rank_all(spark, d):
    _, c = _self(spark, d)
    mean = c.select(F.posexplode("embedding").alias("at", "x")).groupBy("at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    query = mean.agg(F.sort_array(F.collect_list(F.struct("at", "x")))["x"].alias("embedding"))
    return _round(knn.rank_all(query, c))


def knn_sparse(spark, d):
    q = embed.sparse(L.default_embedder()(_requests(spark, d)).select("qid", "embedding"))
    c = embed.sparse(_store(spark, d).select("ebook_no", "embedding"))
    return knn.knn_sparse(q, c, 5)


# --- lookups ---------------------------------------------------------------------------------


def lk_books_by_author(spark, d):
    return _line(L.books_by_author(_requests(spark, d), _store(spark, d)))


def lk_books_by_author_exact(spark, d):
    return L.books_by_author(B.author_requests(spark, d), _store(spark, d), mode="exact")


def lk_author(spark, d):
    return L.author_by_title(_requests(spark, d), _store(spark, d))


def lk_author_on_title(spark, d):
    return L.author_by_title(_requests(spark, d), book_vectors(B.books(spark, d), on="title"))


def lk_author_indexed(spark, d):
    store, index = _built(spark, d)
    return L.author_by_title(_requests(spark, d), store, index=index)


def lk_subject(spark, d):
    return L.subject_by_title(_requests(spark, d), _store(spark, d))


def lk_characters(spark, d):
    return _line(L.characters_by_title(_requests(spark, d), _store(spark, d), rule="title_case"))


def lk_character_spans(spark, d):
    return _line(L.characters_by_title(_requests(spark, d), _store(spark, d), stop=STOP))


def _texts(spark, d):
    """Full texts; the books that have a label stand for those that could be fetched."""
    labelled = B.table(spark, d, "labels").select("doc_id")
    return B.table(spark, d, "documents").join(labelled, "doc_id", "left_semi").select(F.col("doc_id").alias("ebook_no"), "text")


def lk_text_head(spark, d):
    return L.text_by_title(_requests(spark, d), _store(spark, d), _texts(spark, d))


def lk_text_full(spark, d):
    texts = B.table(spark, d, "documents").select(F.col("doc_id").alias("ebook_no"), "text")
    return L.text_by_title(_requests(spark, d), _store(spark, d), texts, lines=None)


def lk_contains_author(spark, d):
    return L.match_value(B.title_requests(spark, d), B.catalogue(spark, d), "author", L.NO_AUTHOR)


def lk_contains_subject(spark, d):
    return L.match_value(_requests(spark, d), B.books(spark, d), "subject", L.NO_SUBJECT)


def lk_regex_author(spark, d):
    return L.match_value(B.pattern_requests(spark, d), B.catalogue(spark, d), "author", L.NO_AUTHOR, literal=False)


def lk_fallback(spark, d):
    return L.lookup_with_fallback(
        _requests(spark, d), _store(spark, d), B.books(spark, d), "subject", L.NO_SUBJECT, max_distance=0.7
    )


def chars_title_case(spark, d):
    return B.table(spark, d, "documents").select("doc_id", F.explode(X.title_case_tokens("text")).alias("token"))


def chars_spans(spark, d):
    return B.table(spark, d, "documents").select("doc_id", F.explode(X.name_spans("text", STOP)).alias("name"))


# --- questions -------------------------------------------------------------------------------


def q_guard(spark, d):
    return A.valid_questions(B.questions(spark, d), session="conv_id", order="turn").select("qid", "text")


def q_retrieve(spark, d):
    return A.retrieve(_requests(spark, d), _store(spark, d), k=3)


def q_context(spark, d):
    return A.context(A.retrieve(_requests(spark, d), _store(spark, d), k=3))


def q_prompt(spark, d):
    texts = B.questions(spark, d).select("qid", F.col("text").alias("question"), F.lower("text").alias("context"))
    return A.render(texts).select("qid", "prompt")


def q_parse_reply(spark, d):
    return A.parse_reply(B.replies(spark, d)).select("qid", "action", "title")


def q_route(spark, d):
    books = B.catalogue(spark, d)
    texts = B.table(spark, d, "documents").select(F.col("doc_id").alias("ebook_no"), "text")
    return A.route(A.parse_reply(B.replies(spark, d)), books, texts)


def q_default(spark, d):
    return A.default_answer(B.replies(spark, d)).select("qid", "answer")


def q_batch(spark, d):
    return prepare_batch(_requests(spark, d), _store(spark, d))


def q_stream(spark, d):
    schema = spark.read.parquet(f"{d}/conversations.parquet").schema
    # As a pattern, the path may be a file or a folder of files.
    rows = spark.readStream.schema(schema).parquet(f"{d}/{{conversations.parquet}}")
    stream = rows.filter("role = 'user'").select((F.col("conv_id") * 100 + F.col("turn")).alias("qid"), "text")
    out = scratch_path(spark, "prompts")
    run = prepare_stream(stream, _store(spark, d), out, scratch_path(spark, "progress"), available_now=True)
    run.awaitTermination()
    return read_prepared(spark, out).drop("batch")


def q_tools(spark, d):
    asked = A.parse_reply(B.replies(spark, d)).groupBy("action").agg(F.count("*").alias("uses"))
    tools = A.tools_table(spark)
    return tools.join(asked, tools["name"] == asked["action"], "left").select(
        "name", "description", F.coalesce("uses", F.lit(0)).cast("bigint").alias("uses")
    )


_QUERIES = [
    src_page_ids, src_pages, sink_raw_roundtrip, src_first_n, sink_clean_roundtrip, src_clean, row_to_text,
    text_to_fields, vec_load_or_create, vec_append_new, store_append_indexed, vec_count, vec_peek, page_pairs, page_fields,
    page_fields_multi, page_head, clean_fill, clean_author, clean_text, clean_stopwords, clean_lemma,
    clean_lemma_joined, clean_keywords, clean_catalogue, catalogue_job, catalogue_books, catalogue_dropped,
    build_store_rows, lk_author_indexed, lk_author_on_title, key_hash, key_uuid, key_seq, key_name,
    batch_no, meta_struct, chunk_fixed, chunk_recursive, embed_hash, embed_idf, embed_norm, embed_questions,
    embed_model, knn_filtered, knn_filtered_indexed, knn_approx, knn_tree_l2, knn_tree_approx, knn_rank_all, knn_sparse, lk_books_by_author,
    lk_books_by_author_exact, lk_author, lk_subject, lk_characters, lk_character_spans, lk_text_head, lk_text_full,
    lk_contains_author, lk_contains_subject, lk_regex_author, lk_fallback, chars_title_case, chars_spans, q_guard,
    q_retrieve, q_context, q_prompt, q_parse_reply, q_route, q_default, q_batch, q_stream, q_tools,
]


def entry(spark: SparkSession) -> DataFrame:
    """Author of the nearest book for every question, at the smallest scale."""
    return queries()["lk_author"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name; each takes (spark, sf_dir)."""
    named = {f.__name__: f for f in _QUERIES}
    for metric in ("l2", "cosine", "dot"):
        named[f"knn_{metric}"] = _knn(metric)
        named[f"knn_{metric}_cells"] = _knn_cells(metric)
    named |= _llm("queries")
    return {name: _shipping(f) for name, f in named.items()}


def _llm(what):
    """What the subpackage `llm` registers, if it is there."""
    try:
        import corpus_pipeline
        from bookbase.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name in ("corpus_pipeline", "bookbase.llm"):
            return {}
        raise
    if what == "statements":
        return llm.statements()
    return llm.queries() | {"pipeline": corpus_pipeline.run}


def _shipping(query):
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    """The SQL for each query that SQL can state."""
    from oracles import statements

    return statements() | _llm("statements")
