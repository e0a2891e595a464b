"""Proportional stratified interleaving: every shard gets the corpus's mixture of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.ranking import ranked
from tickmart.session import materialize

#: Rows that are sorted together, on average, until there are MOST_BUCKETS of them.
BUCKET_ROWS = 5_000
MOST_BUCKETS = 1 << 16


def shards(
    docs: DataFrame, n_shards: int = 8, seed: int = 17, id_column: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """Assigns every row a shard and a slot: id, source, size, text_crc32, shard, slot.

    Rows are shuffled within their source by a seeded hash, given the fractional rank
    (rank + offset) / rows of the source (offset: the source's own, around a half), sorted by it, and
    the order is cut into ``n_shards`` runs whose lengths differ by one at most. A run holds a range of fractional ranks, so of every source
    each shard holds its share, to about one row.

    ``size`` is the text's UTF-8 length plus 1 (null text: 1), ``text_crc32`` its unsigned CRC-32
    (null text: 0). A null source is a source of its own. Repeated rows are rows of their own; rows
    alike in id and text are interchangeable. An empty table gives no rows. Other columns are
    not read.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    text_column, id_value = F.col(text), F.col(id_column)
    rows = docs.select(
        id_value.alias("id"),
        F.col(source).alias("source"),
        (F.coalesce(F.octet_length(text_column), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text_column.cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.xxhash64(F.lit(seed), id_value, text_column).alias("mixed"),
    )
    rows = materialize(rows, "shard_rows")
    totals = rows.groupBy("source").agg(F.count("*").alias("of_source"))
    total = totals.agg(F.sum("of_source")).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(64, -(-total // BUCKET_ROWS)))

    # the hash is uniform, so its high bits split a source evenly and in order
    rows = rows.withColumn("part", F.floor((F.col("mixed") / F.lit(2.0**64) + 0.5) * F.lit(buckets)).cast("bigint"))
    shuffled = ranked(rows, ["source"], "part", [F.col(c) for c in ("mixed", "id", "text_crc32", "size")], "rank")
    totals = totals.select(F.col("source").alias("_source"), "of_source")
    shuffled = shuffled.join(totals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # small sources would all fall on 1/2: a source's own offset below half a row spreads them
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 20)) / F.lit(float(1 << 21)) + 0.25
    shuffled = shuffled.withColumn("fraction", (F.col("rank") + offset) / F.col("of_source"))
    shuffled = shuffled.withColumn("slice", F.floor(F.col("fraction") * F.lit(buckets)).cast("bigint"))
    shuffled = shuffled.select("id", "source", "size", "text_crc32", "rank", "fraction", "slice")
    ordered = ranked(materialize(shuffled, "shard_ranks"), [], "slice", [F.col(c) for c in ("fraction", "source", "rank")], "position")

    # integer arithmetic: shard s begins at the ceiling of s * total / n_shards
    shard = F.expr(f"(position * {n_shards}) div {max(total, 1)}")
    begin = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    placed = ordered.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("position") - begin)
    return placed.select(F.col("id").alias(id_column), F.col("source").alias(source), "size", "text_crc32", "shard", "slot")
