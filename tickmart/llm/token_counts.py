"""Token counts of documents by compiled transducers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.transducer import counter


def token_counts(docs: DataFrame, tokenizer: str, limit: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Counts are those of the library for the byte-level merge tokenizer file ``tokenizer`` (a path
    that every executor has), without added tokens; its special strings inside a text count as
    one token each. A null text counts as empty: no bytes, no tokens. Repeated rows are counted one
    by one, other columns are not read, an empty table gives no rows. Texts are read whole, in
    blocks, in one pass without a shuffle.
    """
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("binary").alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(t) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(machine.count(texts))], ["_id", "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(count, f"_id {rows.schema[0].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("_id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
