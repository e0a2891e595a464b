"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.llm.batches import groups, slices
from tickmart.llm.shingles import FOLD, MULTIPLIER, mix, word_numbers
from tickmart.session import materialize

WINDOW = 13
#: Words of a shingle, the unit whose rarity is counted.
SHINGLE = 3
#: Bits of the sieve for shingles, whatever the number of items: 8 MB are broadcast. A fuller sieve lets
#: more of the documents' other shingles through to the joins, and changes no result.
SIEVE_BITS = 1 << 26
#: Bits that one value of Spark's bitmap functions holds.
BITMAP_BITS = 32_768
#: Bytes whose words are numbered together; windows of an item in a batch.
HASHED_BYTES, WINDOW_ROWS = 1 << 22, 4_096
#: Longer words are compared by 128 bits of hash.
LONG_WORD = 32


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def digest(content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16).digest()


def short(word: bytes) -> bytes:
    """A word for comparison; a blank, which no word holds, marks a hash."""
    return word if len(word) <= LONG_WORD else b" " + digest(word)


class Words:
    """The words of some texts, one after the other, as numbers."""

    def __init__(self, texts: list[bytes | None]):
        folded = [(t or b"").translate(FOLD) for t in texts]
        self.bytes = b" ".join([*folded, b""])
        solid = np.concatenate([[False], np.frombuffer(self.bytes, np.uint8) != 32, [False]])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        sizes = np.array([len(t) + 1 for t in folded], np.int64)
        #: Of each text the first word and the one after the last.
        self.first = np.searchsorted(self.starts, np.cumsum(sizes) - sizes)
        self.last = np.append(self.first[1:], len(self.starts))
        self.limit = np.repeat(self.last, self.last - self.first)
        self.numbers = np.zeros(len(self.starts), np.uint64)
        data, low = np.frombuffer(self.bytes, np.uint8), 0
        while low < len(self.starts):
            begin = self.starts[low]
            high = max(low + 1, int(np.searchsorted(self.ends, begin + HASHED_BYTES, "right")))
            self.numbers[low:high] = word_numbers(data[begin : self.ends[high - 1]], self.starts[low:high] - begin, self.ends[low:high] - begin)
            low = high

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where ``k`` words of one text begin, and a number for these words."""
        n = len(self.numbers) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        key = np.full(n, k, np.uint64)
        for i in range(k):
            key = mix(key * MULTIPLIER + self.numbers[i : i + n])
        at = np.flatnonzero(np.arange(k, n + k) <= self.limit[:n])
        return at, key[at]

    def short(self, low: int, high: int) -> list[bytes]:
        return [short(self.bytes[a:b]) for a, b in zip(self.starts[low:high].tolist(), self.ends[low:high].tolist(), strict=True)]


def cut_windows(texts: DataFrame, size: int) -> DataFrame:
    """(item_text, w, words, keys) of ``texts`` (item_text, text): each window's words and the numbers of
    its shingles. A long item's windows leave in many batches."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (names,), contents in slices(batch):
                for name, content in zip(names.to_pylist(), contents, strict=True):
                    words = Words([content])
                    n = len(words.numbers)
                    _, keys = words.shingles(min(SHINGLE, max(1, n)))
                    numbers = keys.view(np.int64)
                    starts = range(max(1, n - size + 1)) if n else range(0)
                    for low in range(0, len(starts), WINDOW_ROWS):
                        high = min(low + WINDOW_ROWS, len(starts))
                        some = words.short(low, high + size)
                        cuts = [some[i : i + size] for i in range(high - low)]
                        inside = [numbers[i : i + max(1, len(c) - SHINGLE + 1)].tolist() for i, c in enumerate(cuts, low)]
                        columns = [pa.array([name] * len(cuts), pa.binary()), pa.array([digest(b"\n".join(c)) for c in cuts], pa.binary())]
                        columns += [pa.array(cuts, pa.list_(pa.binary())), pa.array(inside, pa.list_(pa.int64()))]
                        yield pa.RecordBatch.from_arrays(columns, ["item_text", "w", "words", "keys"])

    return texts.mapInArrow(cut, "item_text binary, w binary, words array<binary>, keys array<bigint>")


def sieve(keys: DataFrame) -> np.ndarray:
    """A bit for each value of ``key`` modulo SIEVE_BITS; of fixed size, however many keys there are."""
    place = F.pmod("key", F.lit(SIEVE_BITS)) + 1
    filled = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(SIEVE_BITS // 8, np.uint8)
    width = BITMAP_BITS // 8
    # SIEVE_BITS / BITMAP_BITS rows at most
    for r in filled.collect():
        bits[(r["bucket"] - 1) * width : r["bucket"] * width] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits


def passing(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = (keys & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return np.flatnonzero((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1)


def shingle_counts(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """(key, n): occurrences in all documents of the shingles that the sieve lets through."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in groups(batch.column(0)):
                words = Words(some)
                keys = np.concatenate([words.shingles(k)[1] for k in range(1, SHINGLE + 1)])
                keys, n = np.unique(keys[passing(keys, shared.value)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    return texts.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``windows`` (w, words, keys) by their necessary prefix. For exact containment all shingles must be
    there, so one suffices: the rarest, the earliest of equals. Windows with a shingle that occurs
    nowhere go."""
    shingles = windows.select("w", F.posexplode("keys").alias("offset", "key")).join(counts, "key", "left")
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "key")
    chosen = shingles.groupBy("w").agg(F.min(order).alias("least")).where("least.n > 0")
    return windows.select("w", "words").join(chosen.select("w", "least.offset", "least.key"), "w")


def candidates(rows: DataFrame, bits: np.ndarray, size: int) -> DataFrame:
    """``rows`` (_id, t, text) as _id, t, n_words, found: where shingles of the sieve stand, each with the
    words around it that a window could have (``lead`` of them in front)."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    places = T.StructType.fromDDL("n_words bigint, found array<struct<key:bigint,at:bigint,lead:int,around:array<binary>>>")
    schema = T.StructType([*rows.drop("text").schema, *places])
    hit = pa.struct([("key", pa.int64()), ("at", pa.int64()), ("lead", pa.int32()), ("around", pa.list_(pa.binary()))])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (ids, names), texts in slices(batch):
                words = Words(texts)
                found: list[list[dict]] = [[] for _ in texts]
                for k in range(1, SHINGLE + 1):
                    at, keys = words.shingles(k)
                    hits = passing(keys, shared.value)
                    at, keys = at[hits], keys[hits].view(np.int64)
                    owner = np.searchsorted(words.first, at, "right") - 1
                    for row, place, key in zip(owner.tolist(), at.tolist(), keys.tolist(), strict=True):
                        first, last = int(words.first[row]), int(words.last[row])
                        low, high = max(first, place - size + 1), min(last, place + size)
                        found[row].append({"key": key, "at": place - first, "lead": place - low, "around": words.short(low, high)})
                columns = [ids, names, pa.array(words.last - words.first, pa.int64()), pa.array(found, pa.list_(hit))]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "t", "n_words", "found"])

    return rows.mapInArrow(look, schema)


def occurrences(looked: DataFrame, windows: DataFrame) -> DataFrame:
    """(t, start, end, w): the windows that stand in a text word for word. Equal texts are one."""
    texts = looked.where(F.size("found") > 0).dropDuplicates(["t"])
    # written, so that the join deals both sides anew and adaptive execution can split a crowded key
    places = materialize(texts.select("t", F.explode("found").alias("f")).select("t", "f.*"), "places")
    size, begin = F.size("words"), F.col("lead") - F.col("offset")
    # the window must fit into the text at the shingle's place, and hold word for word
    fits = (begin >= 0) & (F.slice("around", F.greatest(begin + 1, F.lit(1)), size) == F.col("words"))
    start = F.col("at") - F.col("offset")
    return places.join(windows, "key").where(fits).select("t", start.alias("start"), (start + size).alias("end"), "w")


def covered(hits: DataFrame) -> DataFrame:
    """(t, spans): the word ranges of each text's occurrences, joined where they touch or overlap."""
    ranges = hits.groupBy("t", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("t").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("t").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    new = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int")
    runs = ranges.withColumn("new", new).withColumn("run", F.sum("new").over(upto))
    runs = runs.groupBy("t", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("t").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW,
    id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, spans (word ranges inside occurrences), items (ids
    of the items found, as strings in order).

    A window is ``window`` consecutive words of an item, or all of a shorter one. Windows are joined
    to documents by their rarest shingle alone, counted over all documents; a candidate must fit
    into the document at the shingle's position and is then compared word for word (words of over
    LONG_WORD bytes by 128 bits of hash).

    A null or empty text has no words and no spans; items without words are found nowhere; a null
    item id marks spans but is not listed; equal items are one. Repeated documents are judged one by
    one; empty tables give no rows, or no spans; other columns are not read. Documents are read twice,
    however many items there are, and not shuffled: windows and the places of their shingles meet in joins,
    and what is broadcast is a sieve of fixed size.
    """
    looked, found = _searched(docs, F.col(id_column), items, window, text, item_id, item_text)
    no_spans, no_items = F.array().cast("array<struct<start:bigint,end:bigint>>"), F.array().cast("array<string>")
    rows = looked.select(F.col("_id").alias("id"), "t", "n_words", (F.size("found") > 0).alias("likely"))
    likely = rows.where("likely").join(found, "t", "left")
    clean = rows.where("not likely").withColumns({"spans": no_spans, "items": no_items}).select(*likely.columns)
    both = likely.withColumns({"spans": F.coalesce("spans", no_spans), "items": F.coalesce("items", no_items)}).unionByName(clean)
    return both.select(F.col("id").alias(id_column), "n_words", "spans", "items")


def drop_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with their own columns, that are not ``contaminated``."""
    looked, found = _searched(docs, F.lit(None).cast("int"), items, window, text, item_id, item_text)
    sizes = looked.where(F.size("found") > 0).groupBy("t").agg(F.max("n_words").alias("n_words"))
    bad = found.join(sizes, "t").where(contaminated(hit_words(), F.col("n_words"))).select("t")
    rows = docs.select(F.struct(F.col("*")).alias("row"), _text_name(text).alias("t"))
    return rows.join(bad, "t", "left_anti").select("row.*")


def _text_name(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _searched(docs: DataFrame, id_column: Column, items: DataFrame, window: int, text: str, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """Documents as ``candidates`` gives them, and (t, spans, items) of the texts with occurrences."""
    owners = items.where(F.col(item_text).isNotNull()).select(
        _text_name(item_text).alias("item_text"), F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("binary").alias("text")
    )
    windows = materialize(cut_windows(owners.select("item_text", "text").dropDuplicates(["item_text"]), window), "windows")
    rows = docs.select(id_column.alias("_id"), _text_name(text).alias("t"), F.col(text).cast("binary").alias("text"))

    counts = materialize(shingle_counts(rows.select("text"), sieve(windows.select(F.explode("keys").alias("key")))), "counts")
    chosen = materialize(rarest(windows.drop("item_text").dropDuplicates(["w"]), counts), "chosen")
    looked = materialize(candidates(rows, sieve(chosen.select("key")), window), "looked")
    hits = materialize(occurrences(looked, chosen), "hits")

    listed = hits.select("t", "w").distinct().join(windows.select("w", "item_text").distinct(), "w").select("t", "item_text").distinct()
    named = listed.join(owners.where("item is not null").select("item_text", "item").distinct(), "item_text")
    named = named.groupBy("t").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return looked, covered(hits).join(named, "t", "left")


def hit_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])


def contaminated(n_hit, n_words):
    """A twentieth of the words or more."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
