"""Offset-preserving sentence-piece encoding and decoding of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.llm.batches import slices
from tickmart.llm.pieces import pieces

#: Rows that are decoded at once.
ROWS = 200


def encode_pieces(docs: DataFrame, model: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int), begin (int), ends (array of int).

    ``ids`` are those that the library gives for the model file ``model`` (a path that every executor
    has), without begin and end. Piece i covers the bytes of the text, in UTF-8, from the end of the
    one before it (the first: from ``begin``) to ``ends[i]``; ``spans()`` puts these together. Of a
    character that is spelled in bytes the last one covers all. A null text counts as empty: no
    pieces. Repeated rows are encoded one by one, other columns are not read, an empty table gives no
    rows. Texts are read whole, in one pass without a shuffle.
    """
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("binary").alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = pieces(model)
        for batch in batches:
            for (ids,), texts in slices(batch):
                counts, begin, *columns = machine.encode(texts)
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                found, ends = (pa.ListArray.from_arrays(offsets, pa.array(c, pa.int32())) for c in columns)
                yield pa.RecordBatch.from_arrays([ids, found, pa.array(begin, pa.int32()), ends], ["_id", "ids", "begin", "ends"])

    kind = rows.schema[0].dataType.simpleString()
    found = rows.mapInArrow(encode, f"_id {kind}, ids array<int>, begin int, ends array<int>")
    return found.withColumnRenamed("_id", id_column)


def spans(begin: str = "begin", ends: str = "ends") -> Column:
    """(start, end) of each piece, in bytes of the text."""
    starts = F.slice(F.concat(F.array(begin), ends), 1, F.size(ends))
    return F.arrays_zip(starts.alias("start"), F.col(ends).alias("end"))


def decode_pieces(encoded: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text ``name`` of its ``ids``, as the library decodes them; null for null.

    The other columns, of any names, stay; a column ``name`` is replaced. An id beyond the
    vocabulary stops with an error.
    """
    others = [c for c in encoded.columns if c != name]
    rows = encoded.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("_row"), F.col(ids).alias("_ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = pieces(model)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                some = batch.slice(start, ROWS)
                lists = some.column(1)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
                ends, whole = machine.decode_all(counts, lists.flatten().to_numpy())
                decoded = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(whole))
                decoded = pc.if_else(lists.is_valid(), decoded, pa.scalar(None, pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([some.column(0), decoded], ["_row", name])

    schema = T.StructType([rows.schema["_row"], T.StructField(name, T.StringType())])
    found = rows.mapInArrow(decode, schema)
    return found.select(*[F.col("_row")[c].alias(c) for c in others], F.col(f"`{name}`"))
