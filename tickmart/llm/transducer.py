"""A byte-pair tokenizer compiled to finite-state transducers that count tokens.

Two machines run one after the other. The first reads character classes and cuts a text where the
tokenizer's pattern cuts it. The second reads the bytes of a piece, a long piece as chunks that each begin in
a guessed state and are read again where the chunk before ended in another (not the prefix scan over whole
state maps: most states are not known before a text needs them). Its transitions carry the change in the number of tokens that the prefix
read so far encodes to. It is built from the merges, state by state as texts need them, like a lazily
determinized automaton, and forgotten when it outgrows ``MOST_STATES``.

Why the second machine is finite: the encoding of a prefix ends in one token, and is the encoding of
the rest of the prefix before it. Which token that is depends on the tokens that end where it begins,
and it can only begin where a part of some vocabulary entry begins. So a state is the list of such
beginnings: for each the vocabulary prefix read since, the token that ends there, and how many tokens
fewer the text up to there has.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

MOST_STATES = 120_000
#: Bytes of a chunk; longer pieces are read as several chunks, side by side.
CHUNK = 64
#: Text bytes that the machines read at once.
BLOCK = 1 << 19

#: Fixed value: the pattern that cuts a text into pieces before the merges.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LETTER, NUMBER, OTHER, BLANK, SPACE, END = range(6)


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in vocabularies of this kind: printable ones stand for
    themselves, the others for 256 and up."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(shifted)}


class Merges:
    """The vocabulary of a byte-level merge tokenizer file and its encoding of one piece."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a byte-level merge tokenizer")
        byte = byte_characters()
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.ids = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in set(self.specials)}
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[bytes(byte[c] for c in left), bytes(byte[c] for c in right)] = rank

    def encode(self, piece: bytes) -> list[bytes]:
        """Merges the best-ranked neighbours, the leftmost first, until none is left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        none = len(self.ranks)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get((parts[i], parts[i + 1]), none))
            if (parts[best], parts[best + 1]) not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts


class PieceMachine:
    """Counts the tokens of pieces: a table of transitions, grown on demand."""

    def __init__(self, merges: Merges, most_states: int = MOST_STATES):
        self.merges, self.most_states = merges, most_states
        #: A token is used by an encoding only if its own bytes encode to it.
        self.tokens = {t for t in merges.ids if len(t) == 1 or merges.encode(t) == [t]}
        self.prefixes = {t[:n] for t in self.tokens for n in range(1, len(t) + 1)}
        self.longer = {t[:n] for t in self.tokens for n in range(1, len(t))}
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.reset()

    def reset(self) -> None:
        """State 0: nothing read. A state lists (vocabulary prefix, token before it, tokens fewer)."""
        self.states: dict[tuple, int] = {(): 0}
        self.keys: list[tuple] = [()]
        self.last: list[bytes] = [b""]
        #: The table's column of each byte that texts had so far.
        self.column = np.full(256, -1, np.int16)
        self.next = np.full((1024, 32), -1, np.int32)
        self.gain = np.zeros((1024, 32), np.int8)

    def may_follow(self, before: bytes, token: bytes) -> bool:
        """Whether the encoding of both together is just these two."""
        if not before:
            return True
        known = self.follows.get((before, token))
        if known is None:
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            known = self.follows[before, token] = self.merges.encode(before + token) == [before, token]
        return known

    def step(self, state: int, byte: int) -> tuple[tuple, bytes, int]:
        """The state after one more byte, the token that now ends the encoding, and the gain."""
        one = bytes((byte,))
        open_ = [(p + one, t, n) for p, t, n in (*self.keys[state], (b"", self.last[state], 0)) if p + one in self.prefixes]
        for prefix, token, fewer in open_:  # the longest first
            if prefix in self.tokens and self.may_follow(token, prefix):
                gain = 1 - fewer
                kept = tuple((p, t, n + gain) for p, t, n in open_ if p in self.longer)
                return kept, prefix, gain
        raise ValueError("the vocabulary lacks a byte")

    def grow(self, state: int, byte: int) -> None:
        kept, token, gain = self.step(state, byte)
        key = (kept, token)
        new = self.states.get(key)
        if new is None:
            new = self.states[key] = len(self.keys)
            self.keys.append(kept)
            self.last.append(token)
            if new == len(self.next):
                self.widen(0)
        self.next[state, self.column[byte]] = new
        self.gain[state, self.column[byte]] = gain

    def widen(self, axis: int) -> None:
        self.next = np.concatenate([self.next, np.full_like(self.next, -1)], axis)
        self.gain = np.concatenate([self.gain, np.zeros_like(self.gain)], axis)

    def columns(self, data: np.ndarray) -> np.ndarray:
        found = self.column[data]
        if (found < 0).any():
            known = int(self.column.max()) + 1
            for byte in np.unique(data[found < 0]).tolist():
                if known == self.next.shape[1]:
                    self.widen(1)
                self.column[byte] = known
                known += 1
            found = self.column[data]
        return found

    def run(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and token gains of chunks from the given entry states. All chunks advance
        together, a byte at a time."""
        columns = self.columns(data)
        order = np.argsort(-lengths, kind="stable")
        at, state, left = starts[order], states[order].copy(), lengths[order]
        total = np.zeros(len(order), np.int64)
        live = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), side="right")
        for k, n in enumerate(live):
            now, place = state[:n], at[:n] + k
            column = columns[place]
            to = self.next[now, column]
            if (missing := to < 0).any():
                pairs = np.unique(now[missing].astype(np.int64) << 8 | data[place[missing]])
                for pair in pairs.tolist():
                    self.grow(pair >> 8, pair & 255)
                to = self.next[now, column]
            total[:n] += self.gain[now, column]
            state[:n] = to
        exits, gains = np.empty_like(state), np.empty_like(total)
        exits[order], gains[order] = state, total
        return exits, gains

    def count(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each piece. Long pieces are read as chunks. A chunk's entry is its
        predecessor's exit, so chunks are first read from guessed entries, and again where the guess was
        wrong; as merges seldom reach far, nearly all chunks are right after two rounds (at worst a
        round a chunk), and the piece's count is the sum of its chunks' gains."""
        if len(self.keys) > self.most_states:
            self.reset()
        per = np.maximum(1, -(-lengths // CHUNK))
        first = np.cumsum(per) - per
        within = np.arange(int(per.sum())) - np.repeat(first, per)
        begin = np.repeat(starts, per) + within * CHUNK
        size = np.minimum(CHUNK, np.repeat(lengths, per) - within * CHUNK)
        entry = np.zeros(len(begin), np.int32)
        exits, gains = self.run(data, begin, size, entry)
        inner = np.flatnonzero(within > 0)
        while len(wrong := inner[entry[inner] != exits[inner - 1]]):
            entry[wrong] = exits[wrong - 1]
            exits[wrong], gains[wrong] = self.run(data, begin[wrong], size[wrong], entry[wrong])
        return np.add.reduceat(gains, first) if len(first) else gains


class Cutter:
    """Cuts characters into the pieces of the pattern

    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``

    which needs no more than each character's class and its neighbours'. Classes of characters
    beyond ASCII are asked of the library, once each, so both use the same edition of Unicode.
    """

    def __init__(self, pre_tokenizer):
        self.pre_tokenizer = pre_tokenizer
        self.classes = np.full(0x110001, -1, np.int8)
        self.classes[0x110000] = END

    def ask(self, character: str) -> int:
        def joins(other: str) -> bool:
            return len(self.pre_tokenizer.pre_tokenize_str(other + character)) == 1

        if character == " ":
            return SPACE
        return LETTER if joins("a") else NUMBER if joins("1") else OTHER if joins("!") else BLANK

    def classify(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        if (found < 0).any():
            for point in np.unique(points[found < 0]).tolist():
                self.classes[point] = self.ask(chr(point))
            found = self.classes[points]
        return found

    def cuts(self, points: np.ndarray) -> np.ndarray:
        """True at the characters where a piece begins; END characters part texts and are pieces
        of their own."""
        kind = self.classify(points)
        n = len(kind)
        before = np.concatenate([[END], kind[:-1]])
        after = np.concatenate([kind[1:], [END]])
        white = (kind == BLANK) | (kind == SPACE)
        white_before = (before == BLANK) | (before == SPACE)
        solid_after = (after != BLANK) & (after != SPACE) & (after != END)
        # a run of one kind begins a piece, unless the space before it does so for it
        begin = (kind != before) & ~(white & white_before) & ~(~white & (before == SPACE) & (kind != END))
        # of white space before a solid character the last one goes with it, or stands alone
        begin |= white & white_before & solid_after
        begin |= kind == END
        # 's and the like, where the quote begins a piece; what follows begins another
        quote = np.flatnonzero(begin & (points == ord("'")))
        quote = quote[quote + 1 < n]
        one = points[quote + 1]
        two = points[np.minimum(quote + 2, n - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & np.any([(one == ord(p[0])) & (two == ord(p[1])) for p in ("re", "ve", "ll")], axis=0)
        for at, size in ((quote[short], 2), (quote[long], 3)):
            begin[at + 1] = False
            ends = at + size
            ends = ends[ends < n]
            begin[ends] = True
        return begin


class TokenCounter:
    """Counts tokens as the library's encoding without added tokens does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.machine = PieceMachine(Merges(path))
        self.cutter = Cutter(Tokenizer.from_file(path).pre_tokenizer)
        self.specials = re.compile("|".join(map(re.escape, self.machine.merges.specials)).encode()) if self.machine.merges.specials else None

    def count(self, texts: list[bytes | None]) -> np.ndarray:
        """Tokens per text; a null text has none."""
        totals = np.zeros(len(texts), np.int64)
        parts: list[bytes] = []
        owners: list[int] = []
        size = 0
        for row, text in enumerate(texts):
            if not text:
                continue
            spans = [text]
            if self.specials is not None and self.specials.search(text):
                spans = self.specials.split(text)
                totals[row] += len(spans) - 1
            for span in spans:
                for part in blocks(span):
                    parts.append(part)
                    owners.append(row)
                    size += len(part)
                    if size >= BLOCK:
                        np.add.at(totals, owners, self.count_parts(parts))
                        parts, owners, size = [], [], 0
        if parts:
            np.add.at(totals, owners, self.count_parts(parts))
        return totals

    def count_parts(self, parts: list[bytes]) -> np.ndarray:
        """Tokens of texts that are read together."""
        characters = [np.frombuffer(p.decode().encode("utf-32-le"), "<u4") for p in parts]
        mark = np.array([0x110000], np.uint32)
        points = np.concatenate([x for c in characters for x in (c, mark)])
        begin = self.cutter.cuts(points)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        width[points == 0x110000] = 1
        offsets = np.cumsum(width) - width
        data = np.frombuffer(b"\0".join([*parts, b""]), np.uint8)
        begins = np.flatnonzero(begin)
        starts = offsets[begins]
        lengths = np.diff(starts, append=len(data))
        text_of = np.cumsum(points == 0x110000)[begins]
        real = points[begins] != 0x110000
        counts = self.machine.count(data, starts[real], lengths[real])
        return np.bincount(text_of[real], counts, minlength=len(parts))[: len(parts)].astype(np.int64)


SEAM = re.compile(rb"(?<=[!-~])(?= [!-~])")


def blocks(text: bytes) -> list[bytes]:
    """A long text cut where a space follows a solid ASCII character: every state of the first
    machine leads to the same one there, so the parts' counts add up."""
    out, start = [], 0
    while len(text) - start > 2 * BLOCK:
        seam = SEAM.search(text, start + BLOCK)
        if seam is None:
            break
        out.append(text[start : seam.start()])
        start = seam.start()
    return [*out, text[start:]]


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """A worker's machine for a vocabulary file, kept between batches and tasks."""
    return TokenCounter(path)
