"""Questions to prompts in one job."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.functions import text as X
from bookbase.operators import ask as A


def prepare_batch(questions: DataFrame, store: DataFrame, k=1, min_words=8, template=A.PROMPT, tools=A.TOOLS, embedder=None, index=None) -> DataFrame:
    """(qid, question, context, prompt) of the questions that pass the guard."""
    accepted = A.valid_questions(questions, min_words).withColumn("text", X.norm_query("text"))
    contexts = A.context(A.retrieve(accepted, store, k, embedder, index))
    joined = accepted.select("qid", F.col("text").alias("question")).join(contexts, "qid", "left")
    filled = joined.withColumn("context", F.coalesce("context", F.lit("")))
    return A.render(filled, template, tools).select("qid", "question", "context", "prompt")
