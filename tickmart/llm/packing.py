"""Hierarchical multi-length packing of token sequences."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.ranking import ranked
from tickmart.llm.transducer import PIECES, Merges
from tickmart.session import materialize

#: Windows of the tiers, powers of two, the longest first.
TIERS = (1024, 512, 256)
#: Tokens of a step group: so many sequences of one tier that all steps cost the same.
STEP_TOKENS = 8192
BUCKET_ROWS, MOST_BUCKETS = 5_000, 1 << 16

# Characters that the two libraries may class differently: white space beyond space, tab and line
# ends, and scripts beyond Latin, whose letters they know from different editions of Unicode.
ODD = bytes([*range(0x1C, 0x20), *range(0xCA, 0x100)])
NO_SPECIALS: set[str] = set()
BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
RARE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf")
UNIT = re.compile(rb"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")


class Encoder:
    """Token ids of whole texts as the library that owns the vocabulary file gives them.

    Plain text goes to a faster library, which gets the same vocabulary and pattern; what that one
    might treat differently, and special strings, go to the owner. As no piece of the pattern has
    white space after a solid character, a text can be divided between both before white space.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        merges = Merges(path)
        self.quick = None
        # the faster library merges in the order of ids, which must be that of the merges
        made = [merges.ids[a + b] for a, b in merges.ranks]
        if made == sorted(made):
            # without two blanks in a row the pattern's look-ahead changes nothing, and costs time
            self.quick, self.quickest = (
                tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges.ids, special_tokens={})._core_bpe
                for pattern in (PIECES, PIECES.replace(r"|\s+(?!\S)", ""))
            )
        self.specials = [s.encode() for s in merges.specials]

    def plain(self, text: bytes) -> bool:
        if self.quick is None or any(s in text for s in self.specials):
            return False
        return len(text.translate(None, ODD)) == len(text) and b"\xc2\x85" not in text and b"\xc2\xa0" not in text

    def faster(self, text: bytes) -> bytes:
        codec = self.quick if b"  " in text.translate(BLANKS) else self.quickest
        return bytes(codec.encode_to_tiktoken_buffer(text.decode(), NO_SPECIALS))

    def owner(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def encode(self, text: bytes) -> bytes:
        """Little-endian 32-bit ids."""
        if self.plain(text):
            return self.faster(text)
        if self.quick is None or RARE.search(text):
            return self.owner(text)
        ids = []
        for plain, units in groupby(UNIT.findall(text), self.plain):
            ids.append((self.faster if plain else self.owner)(b"".join(units)))
        return b"".join(ids)


NO_SPECIALS: set[str] = set()
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A worker's encoder for a vocabulary file, kept between batches and tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def document_pieces(docs: DataFrame, tokenizer: str, window: int, id_column: str, text: str, end_id: int) -> DataFrame:
    """Whole texts as token ids and ``end_id``, cut into full windows and a rest: one row per piece
    (id, start, length, ids_crc32, doc_tokens)."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer)
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, content in enumerate(batch.column(1)):
                ids = memoryview(codec.encode(content.as_py()) + end)
                n = len(ids) // 4
                for at in range(0, n, window):
                    piece = ids[4 * at : 4 * (at + window)]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            numbers = [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *numbers], ["id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences of one tier, each of ``copies`` pieces of each length, in order."""

    window: int
    times: int
    parts: tuple[tuple[int, int], ...]


def fill(window: int, first: int, left: np.ndarray) -> tuple[tuple[int, int], ...]:
    """A window begun with the length ``first``, its gap filled with the longest that fit."""
    parts, gap, longest = {first: 1}, window - first, min(window - first, len(left) - 1)
    while gap > 0:
        options = np.flatnonzero(left[1 : longest + 1])
        options = [int(o) + 1 for o in options[::-1][:2]]
        size = next((o for o in options if left[o] > parts.get(o, 0)), None)
        if size is None:
            break
        copies = min(gap // size, int(left[size]) - parts.get(size, 0))
        parts[size] = parts.get(size, 0) + copies
        gap -= copies * size
        longest = min(gap, size - 1)
    return tuple(parts.items())


def plan_packing(counts: dict[int, int], tiers: tuple[int, ...] = TIERS) -> list[Pattern]:
    """Patterns that use up every length's pieces, from the counts by length alone.

    Pieces longer than the next tier's window are routed to a tier; the longest left begins each
    window, and shorter ones, also of shorter tiers, fill its gap. Below the longest tier only windows
    without a gap are made; pieces that remain share windows of the longest. A pattern is repeated
    as often as its pieces last, so there are at most a few patterns per length.
    """
    left = np.zeros(tiers[0] + 1, np.int64)
    for length, count in counts.items():
        left[length] += count
    patterns = []

    def pack_tier(window: int, shortest: int, only_full: bool) -> None:
        for first in range(window, shortest, -1):
            while left[first]:
                parts = fill(window, first, left)
                if only_full and sum(length * copies for length, copies in parts) < window:
                    break
                times = min(int(left[length]) // copies for length, copies in parts)
                for length, copies in parts:
                    left[length] -= times * copies
                patterns.append(Pattern(window, times, parts))

    for window, shortest in zip(tiers, (*tiers[1:], 0), strict=True):
        pack_tier(window, shortest, only_full=window < tiers[0])
    pack_tier(tiers[0], 0, only_full=False)
    return patterns


class Places:
    """Where the piece of a length and rank goes."""

    def __init__(self, patterns: list[Pattern], step_tokens: int = STEP_TOKENS):
        rows: dict[int, list[tuple[int, ...]]] = {}
        used: dict[int, int] = {}
        sequences: dict[int, int] = {}
        base = 0
        for p in patterns:
            offset, before = 0, sequences.get(p.window, 0)
            for length, copies in p.parts:
                rows.setdefault(length, []).append((used.get(length, 0), copies, base, offset, p.window, before))
                used[length] = used.get(length, 0) + copies * p.times
                offset += copies * length
            base += p.times
            sequences[p.window] = before + p.times
        self.rows = {length: np.array(r, np.int64) for length, r in rows.items()}
        #: Step groups of each tier.
        self.steps = {w: -(-n // max(1, step_tokens // w)) for w, n in sequences.items()}
        self.per_step = {w: max(1, step_tokens // w) for w in sequences}

    def of(self, length: int, ranks: np.ndarray) -> dict[str, np.ndarray]:
        table = self.rows[length]
        first, copies, base, offset, window, before = table[np.searchsorted(table[:, 0], ranks, side="right") - 1].T
        nth = ranks - first
        instance = nth // copies
        tier = int(window[0]) if len(set(window.tolist())) == 1 else None
        step = np.empty_like(ranks)
        for w in {tier} if tier else set(window.tolist()):
            at = window == w
            step[at] = self.step((before + instance)[at], w)
        return {"sequence_id": base + instance, "offset": offset + nth % copies * length, "window": window, "step": step}

    def step(self, nth: np.ndarray, window: int) -> np.ndarray:
        """The step group of a tier's sequences: step j of a tier with S of them belongs at
        (2j + 1) / 2S of the whole run, so the tiers alternate in proportion."""
        mine = nth // self.per_step[window]
        total = np.zeros_like(mine)
        for other, steps in self.steps.items():
            # steps k of the other tier with (2k + 1) / steps before mine; ties by the window
            numerator = (2 * mine + 1) * steps - self.steps[window]
            twice = 2 * self.steps[window]
            at_or_before = numerator // twice + 1
            before = -(-numerator // twice)
            total += mine if other == window else np.clip(at_or_before if other > window else before, 0, steps)
        return total


def pack(
    docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS,
    id_column: str = "doc_id", text: str = "text", end_id: int = 0,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step.

    A document is its text's ids by the tokenizer file, without added tokens, and ``end_id``. It is
    cut into windows of the longest tier and a rest, which goes to the tier of its length. A tier's
    windows are packed longest piece first and their gaps filled from shorter tiers. Windows of the
    shorter tiers are full; only those of the longest have padding.
    ``step`` numbers groups of sequences of one tier with ``step_tokens`` tokens each.

    The plan follows from the counts of pieces by length, a table of ``tiers[0]`` rows at most; each
    piece finds its place by its rank among those of its length, so no group meets in one task. A
    null or empty text is ``end_id`` alone; repeated rows are packed one by one; an empty table gives
    no rows; other columns are not read.
    """
    if any(w & (w - 1) for w in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers must be powers of two, the longest first")
    pieces = document_pieces(docs, tokenizer, tiers[0], id_column, text, end_id)
    pieces = materialize(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    buckets = min(MOST_BUCKETS, max(64, -(-sum(counts.values()) // BUCKET_ROWS)))
    mixed = F.xxhash64("id", "start", "ids_crc32")
    pieces = pieces.withColumn("part", F.pmod(mixed, F.lit(buckets)))
    in_order = ranked(pieces, ["length"], "part", [F.col(c) for c in ("id", "start", "ids_crc32", "doc_tokens")], "rank").drop("part")
    places = pieces.sparkSession.sparkContext.broadcast(Places(plan_packing(counts, tiers), step_tokens))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            found = {c: np.zeros(len(ranks), np.int64) for c in ("sequence_id", "offset", "window", "step")}
            for length in np.unique(lengths).tolist():
                at = lengths == length
                for name, values in places.value.of(length, ranks[at]).items():
                    found[name][at] = values
            kept = [batch.column(c) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, found.values())], ["id", "start", "length", "ids_crc32", "doc_tokens", *found])

    kind = in_order.schema["id"].dataType.simpleString()
    packed = in_order.select("id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        place, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, window bigint, step bigint"
    )
    return packed.withColumnRenamed("id", id_column)
