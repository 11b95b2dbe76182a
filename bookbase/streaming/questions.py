"""An unbounded table of questions against a store that stays put."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from bookbase.plans.questions import prepare_batch
from bookbase.session import scratch_scope


def prepare_stream(stream: DataFrame, store: DataFrame, out, checkpoint, available_now=False, **options) -> StreamingQuery:
    """Prepare prompts for each micro-batch of stream(qid, text) and write them under `out`.

    A batch goes to its own folder and replaces it when it is run again, so a restart leaves
    each question in the output once. Read the result with `read_prepared`.
    """

    def one_batch(batch: DataFrame, batch_id: int):
        with scratch_scope(batch.sparkSession):
            prompts = prepare_batch(batch, store, **options)
            prompts.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_prepared(spark, out) -> DataFrame:
    """All prompts written so far, with the number of their batch."""
    return spark.read.parquet(out)
