"""A sentence-piece model file: normalisation that keeps its source, merges, and decoding.

Texts are normalised by the longest matching entry of the model's compiled character map; what a
normalised character came from is recorded as a byte offset, so that every piece is projected to the
bytes of the original text that it covers.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2
#: Segments and ids that are remembered before all is forgotten.
MOST_SEGMENTS, MOST_IDS = 400_000, 4_000_000
#: Characters of a segment that is merged beside others, and the rank of what is no piece.
SHORT, NEVER = 20, 1 << 30

codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields; fixed-width ones as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """The compiled map: a double array over the bytes of the sources, and the replacements, each
    ended by a zero byte. An empty map replaces nothing."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.replacements = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes of the longest entry that ``data`` goes on with at ``at``, and what replaces them."""
        if not self.units:
            return None
        found, place = None, 0
        offset = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        place ^= offset(self.units[0])
        for i in range(at, len(data)):
            place ^= data[i]
            if place >= len(self.units):
                break
            unit = self.units[place]
            if unit & 0x800000FF != data[i]:
                break
            place ^= offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[place] & 0x7FFFFFFF
        if found is None:
            return None
        size, start = found
        return size, self.replacements[start : self.replacements.index(b"\0", start)]

    def steps(self, text: bytes) -> Iterator[tuple[str, int]]:
        """What stands for the text piece by piece, and how many of its bytes each stands for."""
        at = 0
        while at < len(text):
            entry = self.longest(text, at)
            if entry is None:
                first = text[at]
                entry = (n := 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4), text[at : at + n]
            yield entry[1].decode(), entry[0]
            at += entry[0]


class Pieces:
    """The model: ``encode`` and ``decode``. Merges only, with bytes for what no piece covers."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = list(fields(file.read()))
        trainer, normalizer = (dict(fields(next((v for f, v in model if f == n), b""))) for n in (2, 3))
        self.surfaces: list[bytes] = []
        #: Ids of pieces that begin with a space, and of those that have no text.
        self.spaced: set[int] = set()
        self.silent: set[int] = set()
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        self.byte_ids = [0] * 256
        unknown = trainer.get(44, " ⁇ ".encode())
        for number, piece in enumerate(v for f, v in model if f == 1):
            entry = dict(fields(piece))
            name, kind = entry[1].decode(), entry.get(3, NORMAL)
            if kind == BYTE:
                value = int(name[3:-1], 16)
                self.byte_ids[value] = number
                self.surfaces.append(bytes([value]))
            elif kind == NORMAL:
                self.ids[name] = number
                self.cost[name] = -struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0
                self.surfaces.append(name.replace(SPACE, " ").encode())
                if name.startswith(SPACE):
                    self.spaced.add(number)
            elif kind in (UNKNOWN, CONTROL):
                self.surfaces.append(unknown if kind == UNKNOWN else b"")
                if kind == CONTROL:
                    self.silent.add(number)
            else:
                raise ValueError("pieces defined by users and unused ones are not supported")
        if trainer.get(3, 1) != MERGES or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("not a model of merges with byte fallback and leading spaces")
        self.map = CharacterMap(normalizer.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(normalizer.get(n, 1)) for n in (3, 4, 5))
        # no merge crosses the edge of a character that is in no longer piece, or goes on to a space
        if any(SPACE in name.lstrip(SPACE) for name in self.ids) or not self.escape:
            self.segments = re.compile(r"(?s).+")
        else:
            runs = "|".join(f"[{''.join(map(re.escape, kin))}]+" for kin in self._kinds())
            self.segments = re.compile(f"{SPACE}*(?:{runs})|{SPACE}+|(?s:.)" if runs else f"{SPACE}+|(?s:.)")
        self._tables()
        self.forget()

    def _kinds(self) -> list[list[str]]:
        """Characters that stand side by side in pieces, directly or by way of others; the largest
        set first."""
        kind: dict[str, str] = {}

        def root(c: str) -> str:
            while kind.setdefault(c, c) != c:
                kind[c] = kind[kind[c]]
                c = kind[c]
            return c

        for name in self.ids:
            for a, b in zip(name, name[1:], strict=False):
                if b == SPACE:
                    continue
                near = root(b)
                if a != SPACE:
                    kind[root(a)] = near
        kin: dict[str, list[str]] = {}
        for c in sorted(kind):
            kin.setdefault(root(c), []).append(c)
        return sorted(kin.values(), key=len, reverse=True)

    def forget(self) -> None:
        """Of each segment known: its number; of all of them, how many pieces each has, and their ids
        and lengths in characters."""
        self.numbers: dict[str, int] = {}
        self.counts, self.flat, self.widths = (np.zeros(0, np.int32) for _ in range(3))
        self.first = np.zeros(0, np.int64)

    def _tables(self) -> None:
        """Symbols are pieces and, numbered behind them, characters that are none but are part of some;
        a hash table of pairs of symbols has the piece that they make."""
        symbols = dict(self.ids)
        n = len(self.surfaces)
        for name in self.ids:
            for c in name:
                symbols.setdefault(c, n + len(symbols))
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for name, number in symbols.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = number
        order = {cost: rank for rank, cost in enumerate(sorted(set(self.cost.values())))}
        self.rank = np.full(n + len(symbols) + 1, NEVER, np.int32)
        self.size = np.zeros(n, np.int32)
        pairs = []
        for name, number in self.ids.items():
            self.rank[number] = order[self.cost[name]]
            self.size[number] = len(name)
            for i in range(1, len(name)):
                left, right = symbols.get(name[:i]), symbols.get(name[i:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, number))
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.pair_keys, self.pair_pieces = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        todo = np.array(pairs, np.int64).reshape(-1, 2)
        at = self._slots(todo[:, 0])
        while len(todo):
            free = self.pair_keys[at] < 0
            self.pair_keys[at[free]] = todo[free, 0]
            # of several that want one place the last has it
            placed = self.pair_keys[at] == todo[:, 0]
            self.pair_pieces[at[placed]] = todo[placed, 1]
            todo, at = todo[~placed], (at[~placed] + 1) % len(self.pair_keys)

        self.surface_sizes = np.array([len(s) for s in self.surfaces], np.int64)
        self.surface_begin = np.cumsum(self.surface_sizes) - self.surface_sizes
        self.surface_bytes = np.frombuffer(b"".join(self.surfaces), np.uint8)
        self.begins_spaced, self.quiet = np.zeros(n, bool), np.zeros(n, bool)
        self.begins_spaced[list(self.spaced)], self.quiet[list(self.silent)] = True, True

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that symbols make with their neighbours, -1 for none."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slots(keys)
        out = np.full(len(keys), -1, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        while len(todo):
            found = self.pair_keys[at[todo]]
            same = found == keys[todo]
            out[todo[same]] = self.pair_pieces[at[todo[same]]]
            todo = todo[~same & (found >= 0)]
            at[todo] = (at[todo] + 1) % len(self.pair_keys)
        return out

    # normalisation

    def normalize(self, text: bytes) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters, and its end, the byte of ``text``
        that it came from."""
        if not self.map.units and not self.squeeze:
            if not text:
                return "", np.zeros(1, np.int64)
            data = np.frombuffer(text, np.uint8)
            source = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(text))
            plain = text.decode()
            plain = plain.replace(" ", SPACE) if self.escape else plain
            space = SPACE if self.escape else " "
            return (space + plain, np.append(0, source)) if self.prefix else (plain, source)
        return self._replace(text)

    def _replace(self, text: bytes) -> tuple[str, np.ndarray]:
        out: list[str] = []
        source: list[int] = []
        at, begun, after_space = 0, False, self.squeeze
        for plain, size in self.map.steps(text):
            if not begun and not (self.squeeze and plain == " "):
                begun = True
                if self.prefix:
                    out.append(" ")
                    source.append(at)
            if begun:
                if after_space:
                    plain = plain.lstrip(" ")
                out.append(plain)
                source += [at] * len(plain)
                after_space = self.squeeze and (plain.endswith(" ") if plain else after_space)
            at += size
        whole, end = "".join(out), at if begun else 0
        if self.squeeze:
            kept = len(whole.rstrip(" "))
            end = source[kept] if kept < len(whole) else end
            whole, source = whole[:kept], source[:kept]
        return whole.replace(" ", SPACE) if self.escape else whole, np.array([*source, end], np.int64)

    # merges

    def merge_alike(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of segments of one length, row by row, filled up by -1, and how many there are. In
        each round every segment joins two neighbours: those of the best piece, the leftmost of
        equals."""
        text = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        symbols = self.symbol_of[text].reshape(len(segments), -1)
        width = symbols.shape[1]
        out, left = np.full(symbols.shape, -1, np.int32), np.ones(len(segments), np.int64)
        cost = self.rank[self.joined(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())].reshape(len(segments), width - 1)
        active = np.arange(len(segments))
        while width > 1 and len(active):
            best = cost.argmin(1)
            going = cost[np.arange(len(active)), best] != NEVER
            if not going.all():
                done = active[~going]
                out[done, :width], left[done] = symbols[~going], width
                active, best, symbols, cost = active[going], best[going], symbols[going], cost[going]
            rows = np.arange(len(active))
            symbols[rows, best] = self.joined(symbols[rows, best], symbols[rows, best + 1])
            kept = np.ones(symbols.shape, bool)
            kept[rows, best + 1] = False
            symbols, width = symbols[kept].reshape(len(active), width - 1), width - 1
            kept = np.ones(cost.shape, bool)
            kept[rows, best] = False
            cost = cost[kept].reshape(len(active), width - 1)
            for at in (best - 1, best):
                who = np.flatnonzero((at >= 0) & (at < width - 1))
                at = at[who]
                cost[who, at] = self.rank[self.joined(symbols[who, at], symbols[who, at + 1])]
        out[active, :width], left[active] = symbols, width
        return out, left

    def merge_long(self, segment: str) -> list[str]:
        """Pieces of a segment of any length, by a heap."""
        parts, cost, n = list(segment), self.cost, len(segment)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(cost[pair], i, pair) for i in range(n - 1) if (pair := parts[i] + parts[i + 1]) in cost]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            # of neighbours that changed meanwhile another entry tells
            if not parts[i] or j >= n or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := pair + parts[k]) in cost:
                    heapq.heappush(heap, (cost[new], i, new))
            h = before[i]
            if h >= 0 and (new := parts[h] + pair) in cost:
                heapq.heappush(heap, (cost[new], h, new))
        return [p for p in parts if p]

    def spelled(self, segment: str) -> tuple[list[int], list[int]]:
        """Ids and characters of a segment's pieces, in bytes where there is no piece."""
        ids, widths = [], []
        for piece in self.merge_long(segment):
            number = self.ids.get(piece)
            if number is not None:
                ids.append(number)
                widths.append(len(piece))
            else:
                # the last byte stands for the character, the others for nothing
                coded = piece.encode()
                ids += [self.byte_ids[b] for b in coded]
                widths += [0] * (len(coded) - 1) + [1]
        return ids, widths

    def learn(self, segments: list[str]) -> None:
        alike: dict[int, list[str]] = {}
        for segment in segments:
            alike.setdefault(len(segment), []).append(segment)
        names, counts, flat, widths, rest = [], [self.counts], [self.flat], [self.widths], []
        for size, some in alike.items():
            if size > SHORT:
                rest += some
                continue
            symbols, left = self.merge_alike(some)
            inside = np.arange(size) < left[:, None]
            whole = (((symbols >= 0) & (symbols < len(self.surfaces))) | ~inside).all(1)
            if not whole.all():
                rest += [s for s, ok in zip(some, whole.tolist(), strict=True) if not ok]
                some = [s for s, ok in zip(some, whole.tolist(), strict=True) if ok]
            ids = symbols[whole][inside[whole]]
            names += some
            counts.append(left[whole])
            flat.append(ids)
            widths.append(self.size[ids])
        for segment in rest:
            ids, width = self.spelled(segment)
            counts.append([len(ids)])
            flat.append(ids)
            widths.append(width)
        begun = len(self.counts)
        self.numbers.update(zip([*names, *rest], range(begun, begun + len(segments)), strict=True))
        self.counts, self.flat, self.widths = (np.concatenate(c, dtype=np.int32, casting="unsafe") for c in (counts, flat, widths))
        self.first = np.cumsum(self.counts, dtype=np.int64) - self.counts

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: how many pieces, and the byte where the first begins; and of all texts one after
        the other the ids, and the byte of its text where each piece ends, which is where the next one
        begins."""
        if len(self.counts) > MOST_SEGMENTS or len(self.flat) > MOST_IDS:
            self.forget()
        found: list[str] = []
        segments, sources = [], []
        for text in texts:
            plain, source = self.normalize(text or b"")
            begun = len(found)
            found += self.segments.findall(plain)
            segments.append(len(found) - begun)
            sources.append(source)
        if new := set(found).difference(self.numbers):
            self.learn(list(new))
        number = np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))
        del found
        many = self.counts[number].astype(np.int64)
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(self.first[number] - ends + many, many)
        edges = np.append(0, ends)[np.append(0, np.cumsum(segments)).astype(np.int64)]
        pieces = np.diff(edges)
        width = self.widths[place].astype(np.int64)
        # sources have one place more than characters: a text's end
        upto = np.cumsum(width) + np.repeat(np.arange(len(texts)), pieces)
        source = np.concatenate(sources) if sources else np.zeros(0, np.int64)
        begun = np.cumsum([0, *(len(s) for s in sources[:-1])]) if texts else np.zeros(0, np.int64)
        return pieces, source[begun], self.flat[place], source[upto]

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Bytes that are no UTF-8 become U+FFFD one by one; the space in front that
        normalisation adds is left out. Pieces of control have no text, and keep the bytes around them
        apart."""
        parts = [self.surfaces[i] for i in ids]
        if self.prefix or self.squeeze:
            first = next((n for n, part in enumerate(parts) if part), None)
            if first is not None and ids[first] in self.spaced:
                parts[first] = parts[first].lstrip(b" ") if self.squeeze else parts[first][1:]
        out, begun = [], 0
        for n in [n for n, i in enumerate(ids) if i in self.silent] if not self.silent.isdisjoint(ids) else []:
            out.append(b"".join(parts[begun:n]).decode(errors="each_byte"))
            begun = n
        out.append(b"".join(parts[begun:]).decode(errors="each_byte"))
        return "".join(out)

    def decode_all(self, counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """``decode`` of lists of ids, given one after the other: where each text ends, and the texts."""
        if len(ids) and (self.squeeze or self.quiet[ids].any()):
            return self._decode_each(counts, ids)
        sizes, begin = self.surface_sizes[ids], self.surface_begin[ids]
        ends = np.cumsum(counts)
        first = (ends - counts)[counts > 0]
        if self.prefix:
            spaced = first[self.begins_spaced[ids[first]]]
            sizes[spaced] -= 1
            begin[spaced] += 1
        upto = np.append(0, np.cumsum(sizes))
        data = self.surface_bytes[np.arange(upto[-1]) + np.repeat(begin - upto[:-1], sizes)]
        rows = np.append(0, upto[ends])
        inside = rows[rows < len(data)]
        try:
            whole = data.tobytes()
            whole.decode()
        except UnicodeDecodeError:
            return self._decode_each(counts, ids)
        # no character goes on from one text to the next
        return (rows, whole) if not (data[inside] & 0xC0 == 0x80).any() else self._decode_each(counts, ids)

    def _decode_each(self, counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        ends = np.cumsum(counts)
        texts = [self.decode(ids[end - n : end].tolist()).encode() for n, end in zip(counts.tolist(), ends.tolist(), strict=True)]
        return np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64), b"".join(texts)


@lru_cache(1)
def pieces(path: str) -> Pieces:
    return Pieces(path)
