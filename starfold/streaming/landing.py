"""Files landed since the last run, taken up by a stream that stops when it is caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from starfold.operators.upsert import load_extracted
from starfold.sources.pages import MILESTONE_SCHEMA, clean_page
from starfold.sources.store import Store


def load_landed_pages(
    spark: SparkSession,
    landing: str,
    staging: Store,
    table: str,
    key: str,
    checkpoint: str,
    schema: T.StructType = MILESTONE_SCHEMA,
    whole_lists: bool = True,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Upsert every page file not yet seen; call `awaitTermination` on the result.

    The checkpoint records which files were loaded. The table's commit names the
    query and the number of the last batch taken, so a batch that is repeated after
    a failure is passed over. `whole_lists` is as in `read_pages`.
    """

    def take(batch: DataFrame, number: int) -> None:
        # The id of a query lies in its checkpoint: it outlives restarts, and a new checkpoint is another query.
        query = batch.sparkSession.read.json(f"{checkpoint}/metadata").first().id
        load_extracted(
            staging, table, clean_page(batch), key, f"{staging.root}/_extracted/{table}/query={query}/batch={number}",
            (query, number),
        )

    pages = (
        spark.readStream.schema(schema)
        .option("multiLine", whole_lists)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )
    return (
        pages.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
