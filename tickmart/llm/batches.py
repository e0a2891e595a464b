"""Arrow batches in tasks: parts of bounded size, and whole groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are worked on together.
BATCH_BYTES = 1 << 20


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by their first ``keys`` columns, in tables of many whole groups, and where each
    group begins."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        ends = group_starts(table, keys)
        if len(ends) > 1:
            cut = int(ends[-1])
            yield table.slice(0, cut).combine_chunks(), ends[:-1]
            rest = table.slice(cut)
        else:
            rest = table
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), group_starts(rest, keys)


def group_starts(table: pa.Table, keys: int) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in range(keys):
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def parts_of(texts: pa.Array, size: int = BATCH_BYTES) -> Iterator[slice]:
    """Consecutive runs of texts of about ``size`` bytes; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        total += n
        if total >= size or i + 1 == len(sizes):
            yield slice(start, i + 1)
            start, total = i + 1, 0


def slices(batch: pa.RecordBatch) -> Iterator[tuple[list[pa.Array], list[bytes | None]]]:
    """The leading columns and the texts (the last column) of a batch, in parts of about BATCH_BYTES,
    so that no more than a part is held twice."""
    *others, texts = batch.columns
    for part in parts_of(texts):
        yield [c[part] for c in others], texts[part].to_pylist()


def groups(texts: pa.Array) -> Iterator[list[bytes | None]]:
    """Texts in order, in lists of about BATCH_BYTES."""
    return (texts[part].to_pylist() for part in parts_of(texts))


def union(spans: list[list[int]]) -> list[list[int]]:
    """Ranges in order, joined where they touch or overlap."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged
