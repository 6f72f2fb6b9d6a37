"""Messages that go out once: each has an id, and what a batch has sent is marked.

A message log can only be appended to, so a repeated batch would say everything again. With a mark
for each topic and batch it does not. Only a batch that died between sending and marking sends again,
with the same message ids, by which a consumer can tell.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidegate.sinks.tables import batch_folder, read_table, write_batch

MARK_SCHEMA = T.StructType([T.StructField("topic", T.StringType())])
Send = Callable[[DataFrame], None]


def with_message_ids(messages: DataFrame, query_id: str, batch_id: int) -> DataFrame:
    """``message_id`` from the batch, the message, and which of its equals it is."""
    same = Window.partitionBy("topic", "key", "value").orderBy(F.lit(1))
    number = F.row_number().over(same).cast("string")
    parts = ["topic", F.coalesce("key", F.lit("")), F.coalesce("value", F.lit("")), F.lit(query_id), F.lit(str(batch_id)), number]
    return messages.withColumn("message_id", F.sha2(F.concat_ws("|", *parts), 256))


def send_once(messages: DataFrame, root: str, day, query_id: str, batch_id: int, send: Send) -> bool:
    """Hand a batch's messages (topic, key, value) to ``send`` unless it has been done; says whether it was."""
    folder = batch_folder(root, day, query_id, batch_id)
    marked = read_table(messages.sparkSession, root, MARK_SCHEMA, folders=[folder]).limit(1).count()
    if marked:
        return False
    send(with_message_ids(messages, query_id, batch_id))
    mark = messages.sparkSession.createDataFrame([("all",)], MARK_SCHEMA)
    write_batch(mark, root, day, query_id, batch_id)
    return True
