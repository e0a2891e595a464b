"""N-gram Jaccard join with Bayesian candidate pruning."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickmart.llm.batches import runs, slices
from tickmart.llm.components import components, forest
from tickmart.llm.shingles import MinHash, mix, shingle_sets
from tickmart.session import materialize

WORDS, THRESHOLD = 5, 0.8
#: 32 bands of 4 minima miss a pair at 0.8 with a probability of 5e-8.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Minima compared before a pair is judged again.
STEP = 32
#: A pair is dropped when reaching the threshold has become less likely than this.
TOLERANCE = 1e-6
#: Rows that are compared with one another in one group; larger groups are compared block by block.
BLOCK = 512
#: Columns of what is compared: the pair of blocks, the row's own block, and the row.
DEALT = ("cluster", "low", "high", "_mine", "class", "copies", "members", "signature", "excess")


@lru_cache
def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For 0 .. HASHES compared minima, cut to eight bits, the fewest matches with which a pair stays.

    The similarity is a priori uniform. Two minima match with probability p = s + (1 - s) / 256, so
    after h comparisons with m matches its density is proportional to p^m (1 - p)^(h - m).
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    above = s >= threshold
    out = np.zeros(HASHES + 1, np.int64)
    for h in range(STEP, HASHES + 1, STEP):
        for m in range(h + 1):
            density = m * np.log(p) + (h - m) * np.log1p(-p)
            density = np.exp(density - density.max())
            if density[above].sum() >= tolerance * density.sum():
                out[h] = m
                break
    return out


def likely(one: np.ndarray, others: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which rows of ``others`` may still be similar to ``one`` (a row, or as many rows)."""
    alive = np.arange(len(others))
    matches = np.zeros(len(others), np.int64)
    for start in range(0, HASHES, STEP):
        mine = one[..., start : start + STEP]
        mine = mine[alive] if one.ndim == 2 else mine
        matches[alive] += (others[alive, start : start + STEP] == mine).sum(1)
        alive = alive[matches[alive] >= least[start + STEP]]
        if not len(alive):
            break
    return alive


def likely_links(ids: np.ndarray, signatures: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect what likely pairs connect among these rows. A row that was reached is
    compared with those not reached yet only, so a group of near copies takes a few rounds, not all
    pairs."""
    left = np.arange(len(ids))
    a, b = [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        reached = [root]
        while reached and len(left):
            at = likely(signatures[reached.pop()], signatures[left], least)
            if len(at):
                found = left[at]
                a.append(np.full(len(found), ids[root]))
                b.append(ids[found])
                reached.extend(found.tolist())
                left = np.delete(left, at)
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def overlaps(sets: list[np.ndarray], rows: int) -> np.ndarray:
    """Sizes of the intersections of the first ``rows`` sets with all, as a product of incidence
    matrices, some columns at a time. Members of a single set meet nothing and are left out."""
    sizes = np.array([len(s) for s in sets])
    members, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = times[number] > 1
    column = np.cumsum(times > 1)[number[shared]] - 1
    owner = owner[shared]
    out = np.zeros((rows, len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        span = slice(*np.searchsorted(column, [low, low + width]))
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[owner[span], column[span] - low] = 1
        out += matrix[:rows] @ matrix.T
    return np.rint(out).astype(np.int64)


def true_links(ids: np.ndarray, sets: list[np.ndarray], signatures: np.ndarray, excess: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray, threshold: Fraction):
    """Pairs (positions) between ``left`` and ``right`` rows, the first id the lesser, whose sets reach the
    threshold, without those that ``excess`` proves (around_centers)."""
    x, y = [], []
    sizes = np.array([len(s) for s in sets])
    for i in left.tolist():
        other = right[(ids[right] > ids[i]) & (excess[right] + excess[i] > 0)]
        other = other[likely(signatures[i], signatures[other], least)] if len(other) else other
        # the smaller set must be large enough to hold the overlap
        fits = np.minimum(sizes[other], sizes[i]) * threshold.denominator >= np.maximum(sizes[other], sizes[i]) * threshold.numerator
        other = other[fits]
        x.append(np.full(len(other), i))
        y.append(other)
    x, y = np.concatenate(x), np.concatenate(y)
    if not len(x):
        return x, y
    if len(x) <= 8 * len(ids):
        both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x.tolist(), y.tolist(), strict=True)])
    else:
        rows, at = np.unique(x, return_inverse=True)
        rest = np.setdiff1d(np.unique(y), rows)
        used = np.concatenate([rows, rest])
        place = np.full(len(ids), -1)
        place[used] = np.arange(len(used))
        both = overlaps([sets[i] for i in used.tolist()], len(rows))[at, place[y]]
    keep = both * threshold.denominator >= (sizes[x] + sizes[y] - both) * threshold.numerator
    return x[keep], y[keep]


def fixed(column: pa.ChunkedArray, kind, width: int) -> np.ndarray:
    """A column of equally long binary values as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits of each set."""
    sums = [[int(mix(s ^ np.uint64(salt)).sum()) if len(s) else 0 for salt in (11, 29)] for s in sets]
    return np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: fingerprint of its shingle set, number of shingles, MinHash signature."""
    minhash = MinHash(HASHES)
    for batch in batches:
        for ids, texts in slices(batch):
            sets = shingle_sets(texts, WORDS)
            signatures = minhash.signatures(sets)
            prints = fingerprints(sets)
            columns = [*ids, pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array([len(s) for s in sets], pa.int64())]
            columns.append(pa.array([row.tobytes() for row in signatures], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "f1", "f2", "n", "signature"])


def band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signatures = fixed(batch.column(1), np.uint32, HASHES).astype(np.uint64)
        keys = np.zeros((len(signatures), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for row in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + signatures[:, row::ROWS])
        ids = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(ids)], ["key", "class"])


def in_blocks(members: DataFrame, key: str, size: str) -> DataFrame:
    """Copies of each member for the pairs of blocks it takes part in: a group of ``size`` rows is
    dealt over ceil(size / BLOCK) blocks, and any two blocks meet in one group (key, low, high)."""
    n = F.expr(f"cast(ceil({size} / {float(BLOCK)}) as int)")
    mine = F.pmod(F.xxhash64("class", key), F.col("_blocks")).cast("int")
    rows = members.withColumn("_blocks", n).withColumn("_mine", mine)
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumns({"low": F.least("_mine", "_other"), "high": F.greatest("_mine", "_other")})
    # with itself a block of several meets in its pairs with others as well; only there once
    return rows.drop("_blocks", "_other")


def ngram_links(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_hash (64 bits of the text), copy_of, class_id, n_links,
    group.

    Two texts are linked when their sets of 5-word shingles (words in lower case; a shorter text is
    one shingle) have a Jaccard similarity of ``threshold`` or more. ``n_links`` counts the other
    rows linked to this one, copies included; ``class_id`` is the least id of all that links connect
    (null if none has an id), ``copy_of`` that of the rows with the same set; ``group`` is a number of
    what links connect, also where ids repeat, and may be another one next time. Null texts and texts
    without words have the same, empty, set, and are linked to one another only. Repeated rows are
    rows; an empty table gives no rows; other columns are not read.

    1. Rows with equal sets become one class, so copies are compared once. 2. Classes that agree in
    a band of MinHash values are candidates; they are compared STEP values at a time and dropped
    when the posterior probability of reaching the threshold falls below ``tolerance``. What is
    left connects classes to clusters. 3. The texts of clusters are read again and verified exactly. In a
    cluster of more than BLOCK classes, sets near its center - the shingles of more than half of them -
    are linked to one another by the triangle inequality, and counted by their distance, without
    being paired; only pairs with a set farther out are compared, block by block, as are all of a
    smaller cluster that pass the same test. Counts and stars that connect are written, never the pairs.
    """
    rational, least = Fraction(threshold).limit_denominator(1000), least_matches(threshold, tolerance)
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    sketches = rows.mapInArrow(sketch, f"id {kind}, text_hash bigint, f1 bigint, f2 bigint, n bigint, signature binary")
    sketches = materialize(sketches, "sketches")
    classes = sketches.groupBy("f1", "f2").agg(
        F.count("*").alias("copies"), F.min("id").alias("least_id"), F.min(F.struct("text_hash", "id")).alias("row"),
        F.max("n").alias("n"), F.first("signature").alias("signature"),
    )
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    clusters = components(candidate_links(classes, least)).withColumnsRenamed({"node": "class", "label": "cluster"})
    counts, links = verified(rows, classes, clusters, least, rational)
    labels = components(links).withColumnsRenamed({"node": "class"})
    named = classes.select("class", "f1", "f2", "copies", "least_id").join(labels, "class", "left").join(counts, "class", "left")
    named = materialize(named.withColumn("label", F.coalesce("label", "class")), "named")
    lowest = named.groupBy("label").agg(F.min("least_id").alias("class_id"))
    named = named.join(lowest, "label").select(
        "f1", "f2", F.col("least_id").alias("copy_of"), "class_id", F.col("label").alias("group"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    found = sketches.select("id", "text_hash", "f1", "f2").join(named, ["f1", "f2"])
    return found.select(F.col("id").alias(id_column), "text_hash", "copy_of", "class_id", "n_links", "group")


def candidate_links(classes: DataFrame, least: np.ndarray) -> DataFrame:
    """Stars (a, b) that connect classes which share a band and are likely to be similar."""
    banded = classes.where("n > 0").select("class", "signature").mapInArrow(band_keys, "key bigint, class bigint")
    # written, so that the join deals both sides anew and adaptive execution can split a crowded key
    crowded = materialize(banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "crowded")
    members = banded.join(crowded, "key")
    short = classes.select("class", F.col("signature").alias("signature"))
    members = in_blocks(members, "key", "size").drop("_mine", "size").join(short, "class")
    grouped = members.select("key", "low", "high", "class", "signature").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, 3):
            ids = table.column(3).to_numpy()
            signatures = fixed(table.column(4), np.uint32, HASHES).astype(np.uint8)
            sizes = np.diff(starts, append=len(ids))
            a, b = [], []
            pairs = starts[sizes == 2]
            at = pairs[likely(signatures[pairs], signatures[pairs + 1], least)] if len(pairs) else pairs
            a.append(ids[at])
            b.append(ids[at + 1])
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                x, y = likely_links(ids[start : start + size], signatures[start : start + size], least)
                a.append(x)
                b.append(y)
            x, y = forest(np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return grouped.mapInArrow(compare, "a bigint, b bigint")


def around_centers(members: DataFrame, threshold: Fraction) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the centers of crowded clusters prove: rows that are left to compare, dealt over blocks,
    (class, links) counted, and stars (a, b) that connect what was counted.

    With the threshold p / q, sets A and B are linked if (p + q) |A ^ B| <= (q - p) (|A| + |B|). As
    |A ^ B| <= |A ^ C| + |B ^ C| for the center C, that holds whenever the excess
    (p + q) |A ^ C| - (q - p) |A| of A and that of B come to 0 at most. So a set is linked to all whose
    excess does not surpass its own negated, which a running sum over the distinct values counts.
    """
    p, q = threshold.numerator, threshold.denominator

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                some = batch.slice(start, 64)
                sets = [np.frombuffer(m, np.int64) for m in some.column(2).to_pylist()]
                sizes = [len(s) for s in sets]
                columns = [np.repeat(some.column(c).to_numpy(), sizes) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, np.concatenate(sets))], ["cluster", "size", "shingle"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            excess = []
            for own, center in zip(batch.column(3).to_pylist(), batch.column(5), strict=True):
                own = np.frombuffer(own, np.int64)
                center = center.values.to_numpy() if center.is_valid else np.zeros(0, np.int64)
                apart = len(own) + len(center) - 2 * len(np.intersect1d(own, center, assume_unique=True))
                excess.append((p + q) * apart - (q - p) * len(own))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(excess, pa.int64())], ["cluster", "class", "copies", "members", "signature", "excess"])

    # at most twice as many shingles as a set of the cluster has on average
    frequent = members.select("cluster", "size", "members").mapInArrow(spread, "cluster bigint, size bigint, shingle bigint")
    frequent = frequent.groupBy("cluster", "size", "shingle").agg(F.count("*").alias("n")).where("2 * n > size")
    centers = materialize(frequent.groupBy("cluster").agg(F.collect_list("shingle").alias("center")), "centers")
    with_center = members.select("cluster", "class", "copies", "members", "signature").join(centers, "cluster", "left")
    measured = with_center.mapInArrow(measure, "cluster bigint, class bigint, copies bigint, members binary, signature binary, excess bigint")
    measured = materialize(measured, "measured")

    # a cluster has no more distinct values than its longest text allows
    steps = materialize(measured.groupBy("cluster", "excess").agg(F.sum("copies").alias("copies")), "steps")
    points = steps.selectExpr("cluster", "excess as at", "0 as asked", "copies", "excess").unionByName(
        steps.selectExpr("cluster", "-excess as at", "1 as asked", "0L as copies", "excess")
    )
    so_far = Window.partitionBy("cluster").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = points.withColumn("reach", F.sum("copies").over(so_far)).where("asked = 1").select("cluster", "excess", "reach")
    counts = measured.select("cluster", "class", "copies", "excess").join(reach, ["cluster", "excess"])
    counts = counts.selectExpr("class", "reach - if(excess <= 0, copies, 0) as links")

    ends = measured.groupBy("cluster").agg(F.max("excess").alias("most"), F.min(F.struct("excess", "class")).alias("lowest"))
    ends = materialize(ends, "ends")
    stars = measured.select("cluster", "class", "excess").join(ends, "cluster").where("excess + lowest.excess <= 0 and class <> lowest.class")
    stars = stars.selectExpr("lowest.class as a", "class as b")

    # of two sets that are left to compare one at least lies outside
    left = measured.join(ends.select("cluster", "most"), "cluster").where("excess + most > 0")
    amounts = left.groupBy("cluster").agg(F.count_if(F.col("excess") > 0).alias("outer"), F.count_if(F.col("excess") <= 0).alias("inner"))
    blocks = materialize(amounts.selectExpr("cluster", *[f"cast(ceil({c} / {float(BLOCK)}) as int) as {c}" for c in ("outer", "inner")]), "blocks")
    dealt = left.join(blocks, "cluster").withColumn(
        "_mine", F.expr("cast(if(excess > 0, pmod(xxhash64(class, cluster), outer), outer + pmod(xxhash64(class, cluster), inner)) as int)")
    )
    dealt = dealt.withColumn("_other", F.expr("explode(sequence(0, if(excess > 0, outer + inner, outer) - 1))"))
    dealt = dealt.withColumns({"low": F.least("_mine", "_other"), "high": F.greatest("_mine", "_other")})
    return dealt.select(*DEALT), counts, stars


def verified(rows: DataFrame, classes: DataFrame, clusters: DataFrame, least: np.ndarray, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """(class, links): rows linked to each class, and stars (a, b) that connect linked classes."""
    sizes = materialize(clusters.groupBy("cluster").agg(F.count("*").alias("size")), "sizes")
    members = clusters.join(sizes, "cluster").join(classes.select("class", "copies", "row", "f1", "f2"), "class")
    # one row of each class is read again: a copy that holds the class's least text hash
    wanted = members.select(F.xxhash64("row").alias("_row"), "class", "cluster", "size", "copies", "f1", "f2")
    texts = rows.select(F.xxhash64(F.struct("text_hash", "id")).alias("_row"), "text")
    again = texts.join(wanted, "_row").select("class", "cluster", "size", "copies", "f1", "f2", "text")

    def reread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(HASHES)
        for batch in batches:
            for kept, contents in slices(batch):
                sets = shingle_sets(contents, WORDS)
                # the row hash that joined may belong to another text, too
                prints = fingerprints(sets)
                same = (prints[:, 0] == kept[4].to_numpy()) & (prints[:, 1] == kept[5].to_numpy())
                signatures = minhash.signatures(sets).astype(np.uint8)
                columns = [*kept[:4], pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in signatures], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["class", "cluster", "size", "copies", "members", "signature"]).filter(pa.array(same))

    schema = "class bigint, cluster bigint, size bigint, copies bigint, members binary, signature binary"
    read = materialize(again.mapInArrow(reread, schema).dropDuplicates(["class"]), "members")
    dealt, proved, stars = around_centers(read.where(F.col("size") > BLOCK), threshold)
    # small clusters are one block; an excess of 1 proves nothing
    small = read.where(F.col("size") <= BLOCK).withColumns({c: F.lit(0) for c in ("low", "high", "_mine")}).withColumn("excess", F.lit(1).cast("bigint"))
    dealt = dealt.unionByName(small.select(*DEALT))
    dealt = dealt.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, 3):
            low, high, block, ids, copies = (table.column(c).to_numpy() for c in (1, 2, 3, 4, 5))
            sets = [np.frombuffer(m, np.uint64) for m in table.column(6).to_pylist()]
            signatures, excess = fixed(table.column(7), np.uint8, HASHES), table.column(8).to_numpy()
            a, b, linked, amount = [], [], [], []
            for start, end in zip(starts.tolist(), np.append(starts[1:], len(ids)).tolist(), strict=True):
                own, mine = block[start:end], slice(start, end)
                everything = np.arange(end - start)
                if low[start] == high[start]:
                    sides = [(everything, everything)]
                else:
                    here, there = np.flatnonzero(own == low[start]), np.flatnonzero(own == high[start])
                    sides = [(here, there), (there, here)]
                for left, right in sides:
                    if not len(left) or not len(right):
                        continue
                    x, y = true_links(ids[mine], sets[mine], signatures[mine], excess[mine], left, right, least, threshold)
                    linked += [ids[mine][x], ids[mine][y]]
                    amount += [copies[mine][y], copies[mine][x]]
                    p, q = forest(ids[mine][x], ids[mine][y])
                    a.append(p)
                    b.append(q)
            if not a:
                continue
            who, at = np.unique(np.concatenate(linked), return_inverse=True)
            total = np.bincount(at, np.concatenate(amount), len(who)).astype(np.int64)
            p, q = np.concatenate(a), np.concatenate(b)
            # a link and a count share the columns: (a, b, null) and (class, null, links)
            first, second, third = [*p.tolist(), *who.tolist()], [*q.tolist(), *[None] * len(who)], [*[None] * len(p), *total.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (first, second, third)], ["a", "b", "links"])

    found = materialize(dealt.mapInArrow(verify, "a bigint, b bigint, links bigint"), "found")
    compared = found.where("b is null").select(F.col("a").alias("class"), "links")
    counts = compared.unionByName(proved).groupBy("class").agg(F.sum("links").alias("links"))
    return counts, found.where("b is not null").select("a", "b").unionByName(stars)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each linked group: the least (id, text hash), nulls
    last. Rows alike in both are one."""
    found = ngram_links(docs, id_column=id_column, text=text)
    order = F.struct(F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), F.col("text_hash").alias("hash"))
    # not by class_id: unlike texts may share an id
    kept = found.groupBy("group").agg(F.min(order).alias("least"))
    kept = kept.select(F.col("least.id").alias("_id"), F.col("least.hash").alias("_hash"))
    # one number to join and to find repeated rows by, so that texts are shuffled once; the rows
    # travel as structs, as their columns may have any names
    kept = kept.withColumn("_key", F.xxhash64("_id", "_hash"))
    rows = docs.select(F.struct(F.col("*")).alias("row"), F.col(id_column).alias("id"), F.xxhash64(text).alias("hash"))
    rows = rows.withColumn("key", F.xxhash64("id", "hash"))
    match = (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    stay = rows.join(kept.select("_key", "_id", "_hash"), match, "left_semi")
    return stay.dropDuplicates(["key", "id", "hash"]).select("row.*")
