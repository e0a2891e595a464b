"""Removal of every long byte string that occurs more than once, by sorted suffixes.

Sorting all suffixes would write many times the input. A string of LENGTH bytes holds KEY-byte keys
at LENGTH - KEY + 1 places, and the least of their hashes marks an anchor, the same in every
occurrence. So it is enough to sort the suffixes that begin at anchors whose key occurs twice or
more, and what stands before those anchors, each to the reach of a string around them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.batches import runs, slices, union
from tickmart.llm.shingles import BYTE_VALUES, mix, powers
from tickmart.llm.suffix_sort import sort_strings
from tickmart.session import materialize, scratch_path

LENGTH, KEY = 200, 32
#: Occurrences of one key that are sorted together at most; more are told apart by longer keys first.
TOGETHER = 20_000
#: Rows that are sorted at once, many keys together.
AT_ONCE = 8_192
#: Beyond a text's ends; never part of UTF-8.
OUTSIDE = 0xFF
B = np.uint64(0x9E3779B97F4A7C15 | 1)


def key_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position on."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value, width, base = BYTE_VALUES[data], 1, B
    total, done, out = None, 0, None
    while True:
        if size & width:
            out = value[done : done + n].copy() if out is None else out * base + value[done : done + n]
            done += width
            if done == size:
                return mix(out)
        value = value[:-width] * base + value[width:]
        base, width = np.uint64(int(base) ** 2 % (1 << 64)), width * 2


def sliding(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """The minimum, or maximum, of each ``size`` values in a row."""
    pick, fill = (np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF)) if least else (np.maximum, np.uint64(0))
    n = len(values) - size + 1
    padded = np.full(-(-len(values) // size) * size, fill, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, size)
    ahead = pick.accumulate(blocks, axis=1).reshape(-1)
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return pick(back[:n], ahead[size - 1 : size - 1 + n])


def anchors(texts: list[bytes], length: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, position and key hash of every anchor: each place that holds the least hash of some
    ``length`` bytes of its text. Texts stand side by side; keys across a seam do not count."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes = key_hashes(data, key)
    window = length - key + 1
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none, none, none
    worst = np.uint64(0xFFFFFFFFFFFFFFFF)
    # the last key - 1 positions of each text begin keys that leave it
    for end in ends[:-1].tolist():
        hashes[max(0, end - key + 1) : end] = worst
    least = sliding(hashes, window, True)
    padded = np.zeros(len(hashes) + window - 1, np.uint64)
    padded[window - 1 : window - 1 + len(least)] = least
    # a hash is the least of a window around it if it equals the greatest of their minima
    at = np.flatnonzero((sliding(padded, window, False) == hashes) & (hashes != worst))
    text = np.searchsorted(ends, at, side="right")
    position = at - (ends - sizes)[text]
    big = sizes[text] >= length
    return text[big], position[big], hashes[at[big]].view(np.int64)


def find_anchors(batches: Iterator[pa.RecordBatch], length: int, key: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for (t1, t2), texts in slices(batch):
            text, position, hashes = anchors(texts, length, key)
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays([t1.take(at), t2.take(at), pa.array(position.astype(np.int32)), pa.array(hashes)], ["t1", "t2", "at", "key"])


def contexts(batches: Iterator[pa.RecordBatch], length: int, key: int) -> Iterator[pa.RecordBatch]:
    """For each listed anchor the ``length - key`` bytes before it and the ``length`` from it on."""
    left = length - key
    for batch in batches:
        for (t1, t2, places), texts in slices(batch):
            row, at, hashes, crowd, around = [], [], [], [], []
            for i, (text, found) in enumerate(zip(texts, places.to_pylist(), strict=True)):
                padded = bytes([OUTSIDE]) * left + text + bytes([OUTSIDE]) * length
                for place in found:
                    row.append(i)
                    at.append(place["at"])
                    hashes.append(place["key"])
                    crowd.append(place["crowd"])
                    around.append(padded[place["at"] : place["at"] + left + length])
            taken = pa.array(row, pa.int64())
            columns = [pa.array(hashes, pa.int64()), t1.take(taken), t2.take(taken), pa.array(at, pa.int32()), pa.array(crowd, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(around, pa.binary())], ["key", "t1", "t2", "at", "crowd", "around"])


def twins(segment: np.ndarray, around: np.ndarray, length: int, start: np.ndarray | None = None, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the least and greatest distance to it from the start of a ``length``-byte
    string around it that another row of its segment has, too, at the same distance; (1, 0) if none.
    With ``start`` and ``end`` only distances between those of the row count.

    Suffixes are sorted by what follows the anchor, and by what precedes it read backwards. Rows that
    agree on the bytes after the anchor are neighbours in the one order, those that agree on the bytes
    before it in the other; a string at distance j is repeated where both hold, for length - j and j.
    """
    n, left = len(around), around.shape[1] - length
    ahead, behind = around[:, left:], np.ascontiguousarray(around[:, :left][:, ::-1])
    room_ahead = length - (ahead == OUTSIDE).sum(1)
    room_behind = left - (behind == OUTSIDE).sum(1)
    start = np.zeros(n, np.int64) if start is None else start
    end = np.full(n, left, np.int64) if end is None else end
    # the distances at which a string stays inside its text
    start, end = np.maximum(start, length - room_ahead), np.minimum(end, room_behind)
    classes = []
    for side in (ahead, behind):
        order, common = sort_strings(side, segment)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        classes.append((common, place))
    (common_a, place_a), (common_b, place_b) = classes

    def agree(common: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
        return np.cumsum(common < depth)[place]

    low, high = np.ones(n, np.int64), np.zeros(n, np.int64)
    # rows alike all around: every string in reach is repeated, and one of them speaks for all
    whole = agree(common_a, place_a, length) * (n + 1) + agree(common_b, place_b, left)
    _, first, of, times = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
    several = (times > 1)[of]
    fits = several & (start <= end)
    low[fits], high[fits] = start[fits], end[fits]
    # of the others, only segments with several different rows need a closer look
    per_segment = np.bincount(segment[first], minlength=int(segment.max()) + 1 if n else 0)
    single = np.bincount(segment[first][times == 1], minlength=len(per_segment))
    rows = first[(per_segment > 1)[segment[first]] & (single > 0)[segment[first]]]
    if not len(rows):
        return low, high
    found = np.zeros(n, bool)
    for j in range(left + 1):
        valid = rows[(start[rows] <= j) & (j <= end[rows])]
        if len(valid) < 2:
            continue
        code = agree(common_a, place_a, length - j)[valid] * (n + 1) + agree(common_b, place_b, j)[valid]
        order = np.argsort(code, kind="stable")
        same = code[order[1:]] == code[order[:-1]]
        hit = np.zeros(len(valid), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        hit = valid[hit]
        hit = hit[~several[hit]]
        low[hit] = np.where(found[hit], low[hit], j)
        high[hit] = j
        found[hit] = True
    return low, high


def sorted_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by key, whole keys together, about AT_ONCE at a time; and the keys' sizes."""
    for table, starts in runs(batches, 1):
        bounds = np.append(starts, table.num_rows)
        first = 0
        while first < len(starts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + AT_ONCE, side="right")) - 1)
            yield table.slice(bounds[first], bounds[last] - bounds[first]).combine_chunks(), np.diff(bounds[first : last + 1])
            first = last


def compare(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Ranges (start, end) of texts in repeated strings around each anchor, sorted by key."""
    for part, sizes in sorted_parts(batches):
        raw = b"".join(part.column(4).to_pylist())
        around = np.frombuffer(raw, np.uint8).reshape(part.num_rows, -1)
        low, high = twins(np.repeat(np.arange(len(sizes)), sizes), around, length)
        yield ranges(part, part.column(3).to_numpy().astype(np.int64), low, high, length)


def ranges(part: pa.Table, at: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> pa.RecordBatch:
    hit = np.flatnonzero(low <= high)
    t1, t2 = (pa.array(part.column(c).to_numpy()[hit]) for c in (1, 2))
    return pa.RecordBatch.from_arrays([t1, t2, pa.array(at[hit] - high[hit]), pa.array(at[hit] - low[hit] + length)], ["t1", "t2", "start", "end"])


def halves(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each range of distances in two, with the bytes that strings at all its distances share hashed
    to a new key, and those that any of them touches to ``reach``; none where the former leave the
    text. ``first`` and ``last`` are the distances at which strings stay inside it."""
    for batch in batches:
        c1, c2, times, low, high = (batch.column(c).to_numpy() for c in range(5))
        matrix = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        left = matrix.shape[1] - length
        out: dict[str, list[np.ndarray]] = {}
        for start, end in {(int(x), int(y)) for x, y in zip(low, high, strict=True)}:
            at = np.flatnonzero((low == start) & (high == end))
            middle = (start + end) // 2
            for first, last in {(start, middle), (min(middle + 1, end), end)}:
                core, touched = matrix[at, left - first : left + length - last], matrix[at, left - last : left + length - first]
                inside = ~(core == OUTSIDE).any(1)
                own, rows = at[inside], int(inside.sum())
                before = (matrix[own, :left] != OUTSIDE).sum(1)
                behind = length - (matrix[own, left:] != OUTSIDE).sum(1)
                salt = mix(np.uint64(first << 16 | last) + np.zeros(1, np.uint64))
                key, reach = row_hashes(core[inside]) ^ salt, row_hashes(touched[inside]) ^ salt
                parts = {
                    "c1": c1[own], "c2": c2[own], "times": times[own], "low": np.full(rows, first), "high": np.full(rows, last), "row": own,
                    "first": np.maximum(first, behind), "last": np.minimum(last, before),
                    "key": key.view(np.int64), "reach": reach.view(np.int64),
                }
                for name, values in parts.items():
                    out.setdefault(name, []).append(values)
        if out:
            columns = {name: pa.array(np.concatenate(values)) for name, values in out.items()}
            around = batch.column(5).take(columns.pop("row"))
            yield pa.RecordBatch.from_pydict(columns | {"around": around})


def row_hashes(matrix: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's bytes and their number."""
    weights = mix(np.arange(1, matrix.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    return mix((BYTE_VALUES[matrix] * weights).sum(1, dtype=np.uint64) + np.uint64(matrix.shape[1]))


def compare_ranges(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Within keys, the least and greatest distances at which some surroundings share a string."""
    for part, sizes in sorted_parts(batches):
        raw = b"".join(part.column(5).to_pylist())
        around = np.frombuffer(raw, np.uint8).reshape(part.num_rows, -1)
        start, end = (part.column(c).to_numpy() for c in (3, 4))
        low, high = twins(np.repeat(np.arange(len(sizes)), sizes), around, length, start, end)
        hit = np.flatnonzero(low <= high)
        c1, c2 = (part.column(c).to_numpy()[hit] for c in (1, 2))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (c1, c2, low[hit], high[hit])], ["c1", "c2", "low", "high"])


def crowded_ranges(rows: DataFrame, length: int, together: int) -> DataFrame:
    """The same for keys of very many occurrences, which must not meet in one task.

    Equal surroundings become one kind. Then the range of distances is halved, again and again: what
    strings at all distances of a half have in common is a longer key, under which fewer kinds meet.
    Kinds that agree in all that a half touches repeat each other at each of its distances, and one
    of them goes on for all; keys of no more than ``together`` kinds are sorted; the rest is halved
    further, down to one distance, where key and reach are the same. Each round is counted with
    partial aggregates and written.
    """
    named = rows.withColumns({"c1": F.xxhash64("key", "around"), "c2": F.xxhash64("around", "key")})
    reach = F.octet_length("around").cast("bigint") - length
    level = named.groupBy("c1", "c2", "around").agg(F.count("*").alias("times")).select(
        "c1", "c2", "times", F.lit(0).cast("bigint").alias("low"), reach.alias("high"), "around"
    )
    level, found = materialize(level, "kinds"), []
    while not level.isEmpty():
        schema = "c1 bigint, c2 bigint, times bigint, low bigint, high bigint, first bigint, last bigint, key bigint, reach bigint, around binary"
        parts = materialize(level.mapInArrow(lambda b: halves(b, length), schema), "halves")
        alike = parts.groupBy("key", "reach", "low", "high").agg(F.sum("times").alias("times"), F.min(F.struct("c1", "c2", "around")).alias("one"))
        alike = materialize(alike.select("key", "reach", "low", "high", "times", "one.*"), "alike")
        several = alike.where("times > 1").select("key", "reach")
        inside = parts.where("first <= last").join(several, ["key", "reach"])
        found.append(inside.select("c1", "c2", F.col("first").alias("low"), F.col("last").alias("high")))
        crowds = materialize(alike.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1"), "crowds")
        met = materialize(alike.join(crowds, "key"), "met")
        few = met.where(F.col("crowd") <= together).select("key", "c1", "c2", "low", "high", "around").repartition("key").sortWithinPartitions("key")
        found.append(few.mapInArrow(lambda b: compare_ranges(b, length), "c1 bigint, c2 bigint, low bigint, high bigint"))
        level = met.where(F.col("crowd") > together).select("c1", "c2", "times", "low", "high", "around")
    if not found:
        return named.select("t1", "t2", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end")).limit(0)
    best = reduce(DataFrame.unionByName, found).groupBy("c1", "c2").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    # written, so that a kind of very many rows can be split in the join
    hit = named.join(materialize(best, "best"), ["c1", "c2"])
    return hit.select("t1", "t2", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end"))


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """(t1, t2, copies, text) once per distinct text, written in buckets of (t1, t2), 128 bits of
    hash that stand for the text, so that later joins bring what they found to the texts."""
    spark = docs.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*text_key(value), value.cast("binary").alias("text"))
    once = rows.groupBy("t1", "t2").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    path, name = scratch_path(spark, "texts"), f"texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    once.write.format("parquet").bucketBy(buckets, "t1", "t2").option("path", path).saveAsTable(name)
    return spark.table(name)


def text_key(value) -> list:
    return [F.xxhash64(value).alias("t1"), F.xxhash64(F.lit("second"), value).alias("t2")]


def repeated_spans(texts: DataFrame, length: int = LENGTH, key: int = KEY, together: int = TOGETHER) -> DataFrame:
    """(t1, t2, spans): the byte ranges, in order and apart, that strings of ``length`` bytes cover
    which start anywhere else, too; texts without any are missing. ``texts`` as from
    ``distinct_texts``."""
    long = texts.where(F.octet_length("text") >= length)
    found = long.select("t1", "t2", "text").mapInArrow(lambda b: find_anchors(b, length, key), "t1 bigint, t2 bigint, at int, key bigint")
    found = materialize(found, "anchors")
    # written, so that the join deals both sides anew and adaptive execution can split a crowded key
    crowds = materialize(found.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1"), "crowds")
    places = found.join(crowds, "key").groupBy("t1", "t2").agg(F.collect_list(F.struct("at", "key", "crowd")).alias("places"))
    joined = long.select("t1", "t2", "text").join(places, ["t1", "t2"]).select("t1", "t2", "places", "text")
    around = joined.mapInArrow(lambda b: contexts(b, length, key), "key bigint, t1 bigint, t2 bigint, at int, crowd bigint, around binary")
    crowded = materialize(around, "surroundings")
    sorted_ = crowded.where(F.col("crowd") <= together).select("key", "t1", "t2", "at", "around").repartition("key").sortWithinPartitions("key")
    parts = sorted_.mapInArrow(lambda b: compare(b, length), "t1 bigint, t2 bigint, start bigint, end bigint")
    many = crowded_ranges(crowded.where(F.col("crowd") > together).drop("crowd"), length, together)
    copied = long.where("copies > 1").select("t1", "t2", F.lit(0).cast("bigint").alias("start"), F.octet_length("text").cast("bigint").alias("end"))
    parts = parts.unionByName(many).unionByName(copied).groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return parts.mapInArrow(merge_spans, "t1 bigint, t2 bigint, spans array<struct<start:bigint,end:bigint>>")


def merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind = batch.schema.field(2).type
        merged = [union([[p["start"], p["end"]] for p in parts]) for parts in batch.column(2).to_pylist()]
        spans = [[{"start": start, "end": end} for start, end in parts] for parts in merged]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], batch.schema.names)


def cut(text: bytes, spans: list[dict], whole_characters: bool) -> bytes:
    """The text without the spans; with ``whole_characters`` a character that a span only begins or
    ends in stays."""
    kept, at = [], 0
    for span in spans:
        start, end = span["start"], span["end"]
        if whole_characters:
            while start < end and text[start] & 0xC0 == 0x80:
                start += 1
            while start < end < len(text) and text[end] & 0xC0 == 0x80:
                end -= 1
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


def cut_texts(texts: DataFrame, spans: DataFrame, whole_characters: bool = False) -> DataFrame:
    """(t1, t2, spans, kept) of the texts that lose something."""
    joined = texts.select("t1", "t2", "text").join(spans, ["t1", "t2"]).select("t1", "t2", "spans", "text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [cut(t, s, whole_characters) for t, s in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(kept, pa.binary())], ["t1", "t2", "spans", "kept"])

    return joined.mapInArrow(apply, "t1 bigint, t2 bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")


def repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", whole_characters: bool = False, **options) -> DataFrame:
    """(t1, t2, spans, kept): the texts of ``docs`` in which some ``length`` bytes also start
    elsewhere, in the same text or another, the byte ranges that such strings cover, and the rest.
    ``text_key`` gives (t1, t2) of a text.

    Strings are judged on the input; matches never cross texts. A null text counts as empty. Copies
    of a text repeat one another, so a text of ``length`` bytes or more that occurs twice goes whole.
    Shorter texts lose nothing. An empty table gives no rows; only the text column is read.
    """
    texts = distinct_texts(docs, text)
    return cut_texts(texts, repeated_spans(texts, length, **options), whole_characters)


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", **options) -> DataFrame:
    """``docs`` with its own columns, the repeated strings cut from the text, whole characters only.
    A null text stays null."""
    kept = repeats(docs, length, text, True, **options)
    kept = materialize(kept.select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), F.col("kept").cast("string").alias("kept")), "kept")
    # the rows travel as structs, as their columns may have any names
    rows = docs.select(F.struct(F.col("*")).alias("row"), *text_key(F.coalesce(F.col(text), F.lit(""))))
    joined = rows.join(kept, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left")
    left = F.coalesce("kept", F.col("row")[text]).alias(text)
    return joined.select(*[left if c == text else F.col("row")[c].alias(c) for c in docs.columns])
