"""Questions in, prompts out; replies in, answers out. The language model itself is outside."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.functions import text as X
from bookbase.operators import lookup as L
from bookbase.operators.joins import lookup_join

NO_ANSWER = "I do not know."

PROMPT = """You answer questions about books of a catalogue.
Tools at hand:
{tools}
What the catalogue says: {context}
The question: {question}
Reply with the answer alone."""

# Name of a lookup and what it is for.
TOOLS = {
    "find_author": "the author of a book, by its title",
    "get_subject": "the subject of a book, by its title",
    "extract_characters": "the characters named in the summary of a book, by its title",
    "fetch_full_text": "the whole text of a book, by its title",
}

# How a model reply names the action and the title.
ACTION = r"Action : ([\p{L}\p{N}_]+)"
TITLE = r"Titre : ([^\n]+)"


def tools_table(spark, tools=TOOLS) -> DataFrame:
    """(name, description) of the lookups a reply may ask for."""
    return spark.createDataFrame(list(tools.items()), "name string, description string")


def tools_line(tools=TOOLS) -> str:
    """The tool list as a prompt shows it."""
    return "\n".join(f"- {name}: {text}" for name, text in tools.items())


def valid_questions(df: DataFrame, min_words=8, session=None, order=None) -> DataFrame:
    """Questions of at least `min_words` words.

    With `session` and `order`, nothing of a session counts from its first `exit` on.
    """
    if session:
        ends = (
            df.filter(F.lower("text") == "exit").groupBy(session).agg(F.min(order).alias("__end"))
        )
        df = lookup_join(df, ends, session, order).filter(
            F.col("__end").isNull() | (F.col(order) < F.col("__end"))
        ).drop("__end")
    return df.filter(F.size(X.words("text")) >= min_words)


def retrieve(questions: DataFrame, store: DataFrame, k=1, embedder=None, index=None) -> DataFrame:
    """The k nearest documents of each question: (qid, rank, ebook_no, distance, text)."""
    hits = L.materialise(L.nearest(questions, store, k, embedder=embedder, index=index), "hits")
    texts = store.join(hits.select("ebook_no").distinct(), "ebook_no", "left_semi").select("ebook_no", "text")
    return lookup_join(hits, texts, "ebook_no", "qid").select("qid", "rank", "ebook_no", "distance", "text")


def context(hits: DataFrame) -> DataFrame:
    """(qid, context): the hit texts in rank order, a blank line between; k texts per group."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "text")))
    return hits.groupBy("qid").agg(F.array_join(ordered["text"], "\n\n").alias("context"))


def render(df: DataFrame, template=PROMPT, tools=TOOLS, out="prompt") -> DataFrame:
    """Fill {context}, {question} and {tools}; what is filled in is never scanned again."""
    slots = {
        "{context}": F.coalesce("context", F.lit("")),
        "{question}": F.coalesce("question", F.lit("")),
        "{tools}": F.lit(tools_line(tools)),
    }
    pieces = re.split(r"(\{context\}|\{question\}|\{tools\})", template)
    return df.withColumn(out, F.concat(*[slots.get(p, F.lit(p)) for p in pieces if p]))


def parse_reply(df: DataFrame, column="reply") -> DataFrame:
    """Add `action` and `title`; without an action both are null."""
    reply = F.col(column)
    acted = reply.rlike(ACTION)
    return df.withColumns(
        {
            "action": F.when(acted, F.regexp_extract(reply, ACTION, 1)),
            "title": F.when(acted & reply.rlike(TITLE), X.strip(F.regexp_extract(reply, TITLE, 1))),
        }
    )


def route(parsed: DataFrame, books: DataFrame, texts: DataFrame = None, stop=None, literal=True) -> DataFrame:
    """(qid, action, known, answer): each parsed reply answered by the lookup it names.

    All four lookups share one title match. An unknown action gives no answer; a known one
    without a match gives the default of its lookup. texts(ebook_no, text) serves the full
    text; without it the summary stands in.
    """
    known = F.col("action").isin(list(TOOLS))
    asked = parsed.filter(known & F.col("title").isNotNull()).select("qid", F.col("title").alias("text"))
    columns = ["author", "subject", "summary", "ebook_no"]
    found = L.first_match(asked, books, columns, literal)
    if texts is not None:
        full = parsed.filter(F.col("action") == "fetch_full_text").select("qid")
        wanted = L.materialise(found.join(full, "qid", "left_semi").select("qid", "ebook_no"), "wanted")
        kept = texts.join(wanted.select("ebook_no").distinct(), "ebook_no", "left_semi")
        bodies = lookup_join(wanted, kept.select("ebook_no", F.col("text").alias("full")), "ebook_no", "qid")
        found = found.join(bodies.select("qid", "full"), "qid", "left")
    else:
        found = found.withColumn("full", F.col("summary"))
    names = X.title_case_tokens("summary")
    characters = F.when(F.size(names) > 0, F.array_join(names, " "))
    answer = (
        F.when(F.col("action") == "find_author", F.coalesce("author", F.lit(L.NO_AUTHOR)))
        .when(F.col("action") == "get_subject", F.coalesce("subject", F.lit(L.NO_SUBJECT)))
        .when(F.col("action") == "extract_characters", F.coalesce(characters, F.lit(L.NO_CHARACTERS)))
        .when(F.col("action") == "fetch_full_text", F.coalesce("full", F.lit(L.NO_TEXT)))
    )
    return parsed.select("qid", "action").join(found, "qid", "left").select(
        "qid", "action", F.coalesce(known, F.lit(False)).alias("known"), answer.alias("answer")
    )


def default_answer(df: DataFrame, column="reply", default=NO_ANSWER) -> DataFrame:
    """Add `answer`: the reply, or the default when it is empty or missing."""
    return df.withColumn("answer", F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default)))
