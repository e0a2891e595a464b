"""Hard negatives: exact inner products by the method of the Four Russians.

Components are whole numbers in two's complement. Of each group of eight dimensions an anchor has a
table of the sums of all 256 subsets of its components; a candidate has, for each bit of its numbers,
a byte that tells which of the eight have that bit. A lookup per group and bit, each bit's sum shifted
by its place, adds up to the inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmart.llm.batches import runs
from tickmart.session import materialize

#: Candidates that a task holds, anchors that come to it in a row, and candidates scored at once.
BLOCK, ANCHORS, STRIP = 4096, 64, 512

RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def bit_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """[plane, group, row]: bit ``plane`` of the eight components of each group, as a byte."""
    rows, dims = values.shape
    groups = max(1, -(-dims // 8))
    whole = np.zeros((rows, groups * 8), np.int64)
    whole[:, :dims] = values
    out = np.empty((planes, groups, rows), np.uint8)
    for plane in range(planes):
        bits = (whole >> plane & 1).astype(np.uint8).reshape(rows, groups, 8)
        out[plane] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0].T
    return out


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """[group, byte, anchor]: the sum of the components whose bits the byte has."""
    n, dims = anchors.shape
    groups = max(1, -(-dims // 8))
    whole = np.zeros((n, groups * 8), kind)
    whole[:, :dims] = anchors
    parts = whole.reshape(n, groups, 8).transpose(1, 2, 0)
    out = np.zeros((groups, 256, n), kind)
    for j in range(8):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + parts[:, j : j + 1]
    return out


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """[row, anchor]: inner products, from the sign's plane down; what is there doubles at each plane."""
    rows = planes.shape[2]
    out = np.zeros((rows, tables.shape[2]), tables.dtype)
    found = np.empty((min(rows, STRIP), tables.shape[2]), tables.dtype)
    for low in range(0, rows, STRIP):
        strip = out[low : low + STRIP]
        some = found[: len(strip)]
        for plane in range(len(planes) - 1, -1, -1):
            if plane < len(planes) - 1:
                strip <<= 1
            for table, places in zip(tables, planes[plane, :, low : low + STRIP], strict=True):
                np.take(table, places, axis=0, out=some, mode="clip")
                if plane < len(planes) - 1:
                    strip += some
                else:
                    strip -= some
    return out


def first(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    if len(score) > n:
        bound = np.partition(score, len(score) - n)[len(score) - n]
        above, equal = np.flatnonzero(score > bound), np.flatnonzero(score == bound)
        left = n - len(above)
        if len(equal) > left:
            equal = equal[np.argpartition(ids[equal], left - 1)[:left]]
        return np.concatenate([above, equal])
    return np.arange(len(score))


def numbers(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, np.int64)


def packed(planes: int | None):
    """Rows sorted by block as one row a block: ids, labels, and bit planes or, without ``planes``,
    the numbers themselves; positive scores and ids where there are some."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, 1):
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
                block = table.slice(start, end - start).combine_chunks()
                flat = block.column(3).combine_chunks().flatten().to_numpy()
                values = flat.reshape(block.num_rows, -1)
                data = values.tobytes() if planes is None else bit_planes(values, planes).tobytes()
                cells = [block.column(c).to_numpy().tobytes() for c in (1, 2)] + [data]
                positives = block.column(4).to_pylist()
                lengths = np.array([len(p) for p in positives], np.int64)
                pairs = np.array([x for p in positives for one in p for x in (one["score"], one["id"])], np.int64)
                cells.append(lengths.tobytes() + pairs.tobytes())
                columns = [pa.array([block.column(0)[0].as_py()], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]]
                yield pa.RecordBatch.from_arrays(columns, ["block", "ids", "labels", "data", "positives"])

    return pack


PACKED = "block int, ids binary, labels binary, data binary, positives binary"


def in_blocks(rows: DataFrame, blocks: int, planes: int | None) -> DataFrame:
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).select("block", "id", "label", "values", "positives")
    # the order inside a block brings a label's candidates together
    return dealt.repartition("block").sortWithinPartitions("block", "label", "id").mapInArrow(packed(planes), PACKED)


def met(candidates: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Each candidate block, followed by all anchor blocks, in one task: (block, kind, cells)."""
    cells = ("ids", "labels", "data", "positives")
    everywhere = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), *cells)
    both = candidates.select("block", F.lit(0).alias("kind"), *cells).unionByName(everywhere)
    # more parts than blocks, so that few share one
    return both.repartition(4 * blocks, "block").sortWithinPartitions("block", "kind")


def scored(batches: Iterator[pa.RecordBatch], dims: int, planes: int, kind: type):
    """Ids, labels, positives and a function from anchors' and candidates' places to scores, for each
    meeting of a candidate block with an anchor block."""
    ids = labels = index = None
    for batch in batches:
        for row in range(batch.num_rows):
            cells = [batch.column(c)[row].as_py() for c in range(1, 6)]
            if cells[0] == 0:
                ids, labels = numbers(cells[1]), numbers(cells[2])
                index = np.frombuffer(cells[3], np.uint8).reshape(planes, -1, len(ids))
                continue
            own, mine = numbers(cells[1]), numbers(cells[2])
            tables = subset_sums(numbers(cells[3]).reshape(len(own), dims), kind)
            yield ids, labels, index, own, mine, tables, numbers(cells[4])


def nearest_alike(dims: int, planes: int, kind: type, n: int):
    """(anchor_id, id, score) of the first ``n`` rows of the anchor's label in each block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, index, own, mine, tables, _ in scored(batches, dims, planes, kind):
            found: list[list[np.ndarray]] = [[], [], []]
            for label in np.unique(mine):
                # sorted by label, so these are one stretch
                low, high = np.searchsorted(labels, [label, label + 1])
                who = np.flatnonzero(mine == label)
                score = scores(index[:, :, low:high], tables[:, :, who])
                for column, anchor in enumerate(own[who]):
                    others = np.flatnonzero(ids[low:high] != anchor)
                    at = others[first(score[others, column], ids[low:high][others], n)]
                    found[0].append(np.full(len(at), anchor))
                    found[1].append(ids[low:high][at])
                    found[2].append(score[at, column].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["anchor_id", "id", "score"])

    return search


def nearest_unlike(dims: int, planes: int, kind: type, n: int, low_share: int, high_share: int):
    """The first ``n`` rows of other labels, in each block, inside the bounds that each positive sets."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, index, own, mine, tables, positives in scored(batches, dims, planes, kind):
            score = scores(index, tables)
            ends = np.cumsum(positives[: len(own)])
            pairs = positives[len(own) :].reshape(-1, 2)
            found: list[list[np.ndarray]] = [[] for _ in range(5)]
            for column, anchor in enumerate(own):
                wanted = pairs[ends[column] - positives[column] : ends[column]]
                mark, all_scores = wanted[:, 0], score[:, column]
                # what lies inside no positive's bounds goes first; the scores are small enough for the products
                near = np.flatnonzero((all_scores <= mark.max()) & (labels != mine[column]))
                value = all_scores[near].astype(np.int64)
                inside = 100 * value >= low_share * mark.min() if mark.min() >= 0 else np.ones(len(near), bool)
                near, value = near[inside], value[inside]
                for positive_score, positive in wanted:
                    fits = np.flatnonzero((low_share * positive_score <= 100 * value) & (100 * value <= high_share * positive_score))
                    at = fits[first(value[fits], ids[near[fits]], n)]
                    columns = (np.full(len(at), anchor), np.full(len(at), positive), np.full(len(at), positive_score), ids[near[at]], value[at])
                    for one, part in zip(found, columns, strict=True):
                        one.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return search


def ranks(keys: list[str], score: str, other: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(other)))


def mine_negatives(
    rows: DataFrame, is_anchor: Column, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = 256, n_positives: int = 5, n_negatives: int = 5, low_share: int = 80, high_share: int = 100, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(``scale`` * x), x as double; the score of two rows is their inner
    product. An anchor's positives are the first ``n_positives`` rows of its label and of another
    id, highest scores first, ties by smaller id. For each anchor and positive the first
    ``n_negatives`` rows of other labels come back, ranked from 1, for which
    low_share * positive_score <= 100 * negative_score <= high_share * positive_score.

    Rows without an id or a label, without a vector, or with a null or non-finite component take no
    part; nor does an anchor without positives appear, or a positive without negatives. Of several
    rows of one id the least (label, vector) counts. A vector shorter than others has zeros there.
    Scores must fit into 62 bits, or this stops before it scores. An empty table gives no rows;
    other columns are not read.

    Candidates are packed in blocks of ``block`` rows, and anchors in blocks that visit each of
    them, so a task holds one block of each. Each visit returns at most the first rows; all are
    scored, in two passes, as a positive's score bounds its negatives. The work is anchors times
    rows.
    """
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    sizes = F.transform(F.col(vector), lambda c: F.abs(F.floor(c.cast("double") * F.lit(float(scale))).cast("double")))
    known = rows.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    largest = F.coalesce(F.array_max(sizes), F.lit(0.0))
    row = F.struct(F.col(label).cast("bigint").alias("label"), x.alias("values"), largest.alias("largest"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    one = known.groupBy(F.col(id_column).cast("bigint").alias("id")).agg(F.min(row).alias("row")).select("id", "row.*")
    one = materialize(one, "vectors")
    span = one.agg(F.count("*"), F.count_if("anchor"), F.max("largest"), F.max(F.size("values"))).first()
    n, n_anchors, most, dims = span[0], span[1], int(span[2] or 0), max(span[3] or 0, 1)
    if not n_anchors:
        return rows.sparkSession.createDataFrame([], RESULT)
    bound = 2 * dims * (most + 1) ** 2
    if 100 * bound >= 1 << 63:
        raise ValueError(f"scores of components up to {most} do not fit")
    planes, kind = most.bit_length() + 1, np.int32 if bound < 1 << 31 else np.int64
    blocks, anchor_blocks = -(-n // block), -(-n_anchors // ANCHORS)

    nothing = F.array().cast("array<struct<score:bigint,id:bigint>>")
    padded = F.concat("values", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("values")))
    one = one.withColumns({"values": padded, "positives": nothing})
    candidates = materialize(in_blocks(one, blocks, planes), "candidates")
    anchors = one.where("anchor")
    alike = met(candidates, in_blocks(anchors, anchor_blocks, None), blocks).mapInArrow(
        nearest_alike(dims, planes, kind, n_positives), "anchor_id bigint, id bigint, score bigint"
    )
    best = alike.withColumn("_rank", ranks(["anchor_id"], "score", "id")).where(F.col("_rank") <= n_positives)
    positives = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("score", F.col("id").alias("id"))).alias("positives"))
    asking = materialize(anchors.drop("positives").join(positives, "id"), "anchors")
    unlike = met(candidates, in_blocks(asking, anchor_blocks, None), blocks).mapInArrow(
        nearest_unlike(dims, planes, kind, n_negatives, low_share, high_share),
        "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    ranked = unlike.withColumn("rank", ranks(["anchor_id", "positive_id"], "negative_score", "negative_id")).where(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
