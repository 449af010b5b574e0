"""Operator 1: sharding by sampled splitters.

Size-weighted key samples give quantile boundaries; records are range-partitioned
by them, overfull ranges are subdivided, and exact running sizes inside the ranges
cut the key order into shards of near-equal bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.ordering import hash_key, literal_list, with_prefix
from demandlake.llm.scratch import written

#: Bytes that a record takes besides its text.
RECORD_BYTES = 16
#: Ranges for each shard, at least; more when a range would pass ordering.ROWS_PER_RANGE rows.
RANGES_PER_SHARD = 8


def shard_by_size(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    The key is the hash of the text, then the hash of the id: equal texts are
    neighbours, so a group of copies stays together unless it is larger than what
    is left of its shard.  Law ``bytes``: a record goes to the shard in which the
    middle of its bytes falls on the line of all bytes in key order, so no
    boundary is off by more than one record.  ``slot`` is the place in the shard.

    Null text: no bytes, crc32 0.  Null id: a value like any other.  Repeated
    rows: each has its own slot.  Empty table: no rows.  Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.concat(hash_key(text), hash_key(F.col(id_col))).alias("key"),
        ),
        "shard-keys",
    )
    placed = with_prefix(keyed, "key", "size", parts=shards * RANGES_PER_SHARD)
    total = keyed.agg(F.sum("size")).first()[0] or 1
    placed = written(placed.withColumn("shard", F.least(F.lit(shards - 1).cast("long"), F.expr(f"(2 * before + size) * {shards} div {2 * total}")).cast("int")), "shard-placed")
    firsts = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("row_index").alias("first")).collect()}
    first = F.get(literal_list([str(firsts.get(i, 0)) for i in range(shards)]).cast("array<long>"), F.col("shard"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row_index") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
