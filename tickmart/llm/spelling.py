"""Spelling variants: words one edit apart, found by pivotal grams.

Of a word's bigrams in order of rarity the first three are its prefix. Two disjoint ones of the
prefix are its pivots; one edit leaves at least one of them as it is, so of two near words a pivot of
the one whose prefix ends earlier in that order is in the prefix of the other. An edit behind the first
pivot leaves that one and all in front of it as they are; any other is in front of the second pivot,
and leaves that one and all behind it. So the place of the pivot in the other word is known to one
position, and the text of one side is the same.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.batches import slices
from tickmart.llm.shingles import BYTE_VALUES, MULTIPLIER, mix, powers
from tickmart.session import materialize

#: Lower case of A-Z alone.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words counted in a task before they are handed on.
MOST_WORDS = 200_000
#: Letters are a-z and U+00C0 to U+00FF: 90 of them, so there are at most 8,100 bigrams.
LETTERS = 91
NUMBER = np.zeros(256, np.int64)
NUMBER[97:123] = np.arange(1, 27)
NUMBER[0xC0:] = np.arange(27, LETTERS)
PREFIX = 3
#: How length and place of the first pivot differ in a word with the edit behind it (left side
#: equal), and those of the second in one with the edit in front of it (right side equal).
EDITS = {0: ((0, 0), (1, 0), (-1, 0)), 1: ((0, 0), (1, 1), (-1, -1))}


def count_words(least: int, modulus: int):
    """Occurrences of each run of letters, with the code points that checksums delete."""
    run = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def out(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for (ids,), texts in slices(batch):
                for doc, text in zip(ids.to_pylist(), texts, strict=True):
                    before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word, n in Counter(run.findall((text or b"").translate(LOWER).decode())).items():
                        h = zlib.crc32(word.encode(), before)
                        if h % modulus == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        total[word] += n
                if len(total) > MOST_WORDS:
                    yield out(total)
                    total = Counter()
        if total:
            yield out(total)

    return count


def word_counts(docs: DataFrame, least: int = 7, modulus: int = 31, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the lower-cased runs of at least ``least`` letters, after deletions, and how often they occur."""
    rows = docs.select(F.col(id_column).cast("string").alias("_id"), F.col(text).cast("binary").alias("_text"))
    return rows.mapInArrow(count_words(least, modulus), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Grams:
    """The bigrams of some words one after the other."""

    def __init__(self, words: list[str]):
        self.length = np.array([len(w) for w in words], np.int64)
        self.end = np.cumsum(self.length)
        self.start = self.end - self.length
        self.text = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        inner = np.ones(len(self.text), bool)
        inner[self.end - 1] = False
        #: Where each gram begins, its word, its number and its place in the word.
        self.at = np.flatnonzero(inner)
        self.word = np.repeat(np.arange(len(words)), self.length - 1)
        letters = NUMBER[self.text]
        self.gram = letters[self.at] * LETTERS + letters[self.at + 1]
        self.place = self.at - self.start[self.word]

    def side_hashes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the text in front of and behind these grams."""
        n = len(self.text)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[self.text] * powers(n, MULTIPLIER), out=sums[1:])
        back = powers(n + 1, np.uint64(pow(int(MULTIPLIER), -1, 1 << 64)))
        at, word = self.at[which], self.word[which]
        first, last = self.start[word], self.end[word]
        return (sums[at] - sums[first]) * back[first], (sums[last] - sums[at + 2]) * back[at + 2]

    def letters(self) -> np.ndarray:
        """The letters of each word as bits, some sharing one: an edit changes two at most."""
        bits = np.uint64(1) << (NUMBER[self.text] % 64).astype(np.uint64)
        return np.bitwise_or.reduceat(bits, self.start).view(np.int64)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.bincount(Grams(batch.column(0).to_pylist()).gram, minlength=1) if batch.num_rows else np.zeros(0, np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["gram", "n"])


def choose_pivots(first: list[int], place: list[int], weight: list[int]) -> list[tuple[int, int]]:
    """For each word, whose prefix grams ``first[i]`` to ``first[i + 1]`` are in order of their places,
    the two that share no letter and are least frequent together.

    Dynamic programming over places: the best pair that ends at a gram is the gram with the best one
    that ends two places before it or earlier.
    """
    pairs = []
    for low, high in zip(first, first[1:], strict=False):
        lead, before, best, pair = low, -1, None, (low, low)
        for i in range(low, high):
            while place[lead] <= place[i] - 2:
                if before < 0 or weight[lead] < weight[before]:
                    before = lead
                lead += 1
            if before >= 0 and (best is None or weight[before] + weight[i] < best):
                best, pair = weight[before] + weight[i], (before, i)
        pairs.append(pair)
    return pairs


def keys(gram: np.ndarray, length: np.ndarray, place: np.ndarray, side: int, text: np.ndarray) -> np.ndarray:
    number = mix(text + np.uint64(side + 1))
    for part in (gram, length, place):
        number = mix(number * MULTIPLIER + part.astype(np.uint64))
    return number.view(np.int64)


def index_words(counts: np.ndarray):
    """Index entries of words: pivots under the keys of the words they look for, prefix grams under
    their own. ``counts``: words by gram."""
    order = np.lexsort((np.arange(len(counts)), counts))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = batch.column(0), batch.column(1)
            grams = Grams(words.to_pylist())
            rarity = rank[grams.gram]
            by_rank = np.lexsort((grams.place, rarity, grams.word))
            first = grams.start - np.arange(len(grams.start))
            last = rarity[by_rank[first + PREFIX - 1]]
            # all occurrences of the third gram belong to the prefix
            prefix = np.flatnonzero(rarity <= last[grams.word])
            begin = np.searchsorted(grams.word[prefix], np.arange(len(words) + 1)).tolist()
            chosen = choose_pivots(begin, grams.place[prefix].tolist(), counts[grams.gram[prefix]].tolist())
            pivots = np.array(chosen, np.int64).T
            gram, place, word = grams.gram[prefix], grams.place[prefix], grams.word[prefix]
            length, sides = grams.length[word], grams.side_hashes(prefix)
            found, owner, kinds = [], [], []
            for side, shifts in EDITS.items():
                found.append(keys(gram, length, place, side, sides[side]))
                owner.append(word)
                kinds.append(np.zeros(len(word), bool))
                pivot = pivots[side]
                for longer, further in shifts:
                    found.append(keys(gram[pivot], length[pivot] + longer, place[pivot] + further, side, sides[side][pivot]))
                    owner.append(word[pivot])
                    kinds.append(np.ones(len(pivot), bool))
            at = pa.array(np.concatenate(owner))
            columns = [pa.array(np.concatenate(found)), pa.array(np.concatenate(kinds)), words.take(at), n.take(at)]
            columns += [pa.array(numbers).take(at) for numbers in (last, grams.letters())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "pivot", "word", "n", "last", "letters"])

    return index


def near_words(words: DataFrame) -> DataFrame:
    """Pairs (a, a_n, b, b_n) of words (word, n; written), each once, that one edit turns into one another."""
    # at most one row a bigram
    frequency = np.zeros(LETTERS * LETTERS, np.int64)
    for row in words.select("word").mapInArrow(count_grams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        frequency[row["gram"]] = row["n"]
    entries = words.select("word", "n").mapInArrow(index_words(frequency), "key bigint, pivot boolean, word string, n bigint, last bigint, letters bigint")
    entries = materialize(entries, "grams")
    named = lambda c: [F.col("word").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("n", "last", "letters")]]
    pivots, prefixes = entries.where("pivot").select("key", *named("a")), entries.where("not pivot").select("key", *named("b"))
    likely = pivots.join(prefixes, "key").where("a_last <= b_last and bit_count(a_letters ^ b_letters) <= 2 and a <> b")
    likely = likely.where(F.levenshtein("a", "b", 1) == 1)
    turned = F.col("a") > F.col("b")
    one, other = F.struct(F.col("a").alias("w"), F.col("a_n").alias("n")), F.struct(F.col("b").alias("w"), F.col("b_n").alias("n"))
    pairs = likely.select(F.when(turned, other).otherwise(one).alias("x"), F.when(turned, one).otherwise(other).alias("y"))
    return pairs.select(F.col("x.w").alias("a"), F.col("x.n").alias("a_n"), F.col("y.w").alias("b"), F.col("y.n").alias("b_n")).distinct()


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """One row per word of ``words`` (word, n): word, n, form, root, n_near, form_n.

    ``n_near`` counts the words that one inserted, deleted or replaced code point turns it into;
    ``form`` is the most frequent of them (ties: the first in code-point order) if it occurs
    ``ratio`` times as often or more; ``root`` is the form's form and so on, or the word itself.
    """
    pairs = materialize(near_words(words), "near")
    turned = pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    both = pairs.unionByName(turned)
    best = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("w"))).alias("best"))
    found = words.join(best, "word", "left")
    fits = -F.col("best.less") >= ratio * F.col("n")
    found = found.select("word", "n", F.when(fits, F.col("best.w")).alias("form"), F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(fits, -F.col("best.less")).alias("form_n"))
    found = materialize(found, "forms")
    # each round doubles the steps; a form is so much more frequent that there are few
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, least: int = 7, modulus: int = 31, least_n: int = 2, ratio: int = 10, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``spelling_variants`` of the words of ``docs``.

    Words are maximal runs of a-z, A-Z and U+00C0 to U+00FF, A-Z in lower case. If the unsigned
    CRC-32 h of ``<id>:<word>`` (UTF-8; a null id is empty) is a multiple of ``modulus``, the code
    point h modulo the word's length is deleted. Words of at least ``least`` code points that occur
    at least ``least_n`` times, all texts together, take part. Null and empty texts have no words;
    repeated rows count each; an empty table gives no rows; other columns are not read.
    """
    words = word_counts(docs, least, modulus, id_column, text).where(F.col("n") >= least_n)
    return spelling_variants(materialize(words, "words"), ratio)
