"""The warehouse load as a stream: micro-batches of a log of raw rows, each one version, replays recognised.

The log holds rows of all raw tables: ``table``, ``pos`` (arrival order) and ``row``, the fields as JSON. A micro-batch is one batch of
the load. A version notes the last batch of its stream in the same file that publishes the rows, so a batch that comes again
after a failure changes nothing, whether or not the stream's own checkpoint had learned of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.plans.warehouse import publishable, run_pipeline
from starloom.schemas import POS, RAW_SCHEMAS
from starloom.session import materialize, owned_copies

LOG = "table string, pos long, row string"


def to_log(raw: dict[str, DataFrame]) -> DataFrame:
    """Raw tables as rows of the log."""
    parts = None
    for name, df in raw.items():
        fields = F.to_json(F.struct(*RAW_SCHEMAS[name].fieldNames()))
        rows = df.select(F.lit(name).alias("table"), F.col(POS).alias("pos"), fields.alias("row"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def from_log(log: DataFrame) -> dict[str, DataFrame]:
    """Every raw table of a batch of the log; a row that does not fit its table's types is an error, an unknown table is ignored."""
    raw = {}
    for name, schema in RAW_SCHEMAS.items():
        fields = F.from_json("row", schema, {"mode": "FAILFAST"}).alias("fields")
        raw[name] = log.where(F.col("table") == name).select(fields, F.col("pos").alias(POS)).select("fields.*", POS)
    return raw


def load_stream(
    log: DataFrame, root: str, checkpoint: str, name: str = "log", days: DataFrame | None = None, check=publishable, grain: str | None = None, **trigger
) -> StreamingQuery:
    """Start loading a streaming ``log`` into the warehouse at ``root``; ``trigger`` as for a stream writer, by default all that is there now.

    An order's rows belong into one batch: facts take the orders of their own batch. A refused batch stops the stream and
    publishes nothing; it comes again when the stream is started again.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with owned_copies(spark):
            raw = from_log(materialize(batch, "batch"))  # the load reads it several times
            run_pipeline(spark, raw, root, days, check, grain, batch=(name, number))

    writer = log.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).queryName(f"load {name}")
    return writer.trigger(**(trigger or {"availableNow": True})).start()
