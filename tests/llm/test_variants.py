"""Sentence pieces, hard negatives and spelling variants: the library, SQL and brute force."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

from tickmart.llm.hard_negatives import bit_planes, mine_negatives, scores, subset_sums
from tickmart.llm.piece_encoding import decode_pieces, encode_pieces, spans
from tickmart.llm.pieces import CharacterMap, Pieces, fields
from tickmart.llm.queries import QUERIES
from tickmart.llm.spelling import Grams, choose_pivots, group_spellings, spelling_variants

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CLASHING = ("_id", "_text", "_row", "ids", "begin", "decoded", "word", "n", "key", "block", "positives", "values", "anchor", "a.b")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def machine():
    return Pieces(MODEL)


def odd_texts():
    rng = random.Random(4)
    letters = "ab .\n\t▁éß日本🜁<0x>\x00'’—ΩжЖ́‍È"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    return texts + ["", " ", "  ", "▁", "▁▁ x", " " * 3000, "a" * 3000, "the " * 9000, "<s>hello</s><unk>", "\n\n", "Ünïcode " * 50]


# sentence pieces


def test_pieces_are_those_of_the_library(machine, library):
    texts = odd_texts()
    counts, begin, ids, ends = machine.encode([t.encode() for t in texts])
    edges = np.append(0, np.cumsum(counts))
    for n, text in enumerate(texts):
        part = slice(edges[n], edges[n + 1])
        wanted = library.encode(text, return_type="proto").pieces
        assert ids[part].tolist() == [p.id for p in wanted]
        starts = [begin[n], *ends[part][:-1].tolist()][: len(wanted)]
        assert list(zip(starts, ends[part].tolist(), strict=True)) == [(p.begin, p.end) for p in wanted]
        assert machine.decode(ids[part].tolist()) == library.decode(ids[part].tolist())


def test_any_ids_are_decoded_as_by_the_library(machine, library):
    rng = random.Random(5)
    lists = []
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(262) for _ in range(rng.randint(0, 9))]
        assert machine.decode(ids) == library.decode(ids)
        lists.append(ids)
    plain = [[i for i in ids if i > 262] for ids in lists]
    half = machine.byte_ids[0xC3], machine.byte_ids[0xA9]
    for some in (lists, plain, [[half[0]], [half[1]], [*half]], [[], []], []):
        ends, whole = machine.decode_all(np.array([len(x) for x in some], np.int64), np.array([i for x in some for i in x], np.int32))
        assert [whole[a:b].decode() for a, b in zip(ends, ends[1:], strict=False)] == [library.decode(x) for x in some]


def test_forgotten_segments_are_learnt_again(machine, monkeypatch):
    texts = [t.encode() for t in odd_texts()[:50]]
    before = machine.encode(texts)
    monkeypatch.setattr("tickmart.llm.pieces.MOST_SEGMENTS", 1)
    for once, again in zip(before, machine.encode(texts), strict=True):
        assert np.array_equal(once, again)


def test_short_and_long_segments_merge_alike(machine):
    rng = random.Random(9)
    words = {"".join(rng.choice("thenoragisÈé▁") for _ in range(rng.randint(1, 20))) for _ in range(2000)}
    machine.forget()
    machine.learn(sorted(words))
    for word in words:
        n = machine.numbers[word]
        part = slice(machine.first[n], machine.first[n] + machine.counts[n])
        assert (machine.flat[part].tolist(), machine.widths[part].tolist()) == machine.spelled(word)


@pytest.mark.parametrize("escape", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
def test_longest_entries_of_a_compiled_map(escape, prefix, squeeze):
    options = {"escape_whitespaces": escape, "add_dummy_prefix": prefix, "remove_extra_whitespaces": squeeze}
    theirs = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", **options)
    mine = Pieces(MODEL)
    mine.map = CharacterMap(dict(fields(theirs.serialized_normalizer_spec()))[2])
    mine.escape, mine.prefix, mine.squeeze = escape, prefix, squeeze
    rng = random.Random(6)
    for _ in range(500):
        text = "".join(rng.choice("ab .\n\t▁éß日本ﬁ①Ａｶﾞ㌔½é​　ΩЖ\x01\x7f㈱ﷺ") for _ in range(rng.randint(0, 12)))
        plain, source = mine.normalize(text.encode())
        wanted, offsets = theirs.normalize(text, with_offsets=True)
        assert plain == wanted
        assert source.tolist() == [len(text[:i].encode()) for i in offsets]


def test_encoding_of_odd_rows(spark, library):
    rows = [(1, "plain words"), (2, None), (3, ""), (None, "no id"), (4, "long " * 40_000), (1, "plain words"), (5, " \n\t")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("clash") for c in CLASHING if c not in ("a.b", "ids", "decoded")})
    found = decode_pieces(encode_pieces(table, MODEL).withColumns({"a.b": F.lit(1), "spans": spans()}), MODEL)
    assert found.columns == ["doc_id", "ids", "begin", "ends", "a.b", "spans", "decoded"]
    got = sorted(found.collect(), key=str)
    assert sorted((r["doc_id"] or 0, r["ids"], r["decoded"]) for r in got) == sorted((d or 0, library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in rows)
    for row in got:
        assert [s["end"] for s in row["spans"]] == row["ends"] and len(row["ends"]) == len(row["ids"])
        assert [s["start"] for s in row["spans"]] == [0, *row["ends"]][: len(row["ids"])]
    assert encode_pieces(table.limit(0), MODEL).collect() == []
    assert decode_pieces(spark.createDataFrame([(None,)], "ids array<int>"), MODEL).first()["decoded"] is None


def test_query_of_pieces(spark, sf, library):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted = set()
    for doc, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "")
        wanted.add((doc, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)), len((text or "").encode())))
    assert {tuple(r) for r in QUERIES["op11_piece_encoding"](spark, sf).collect()} == wanted


# hard negatives


@pytest.mark.parametrize("dims", [1, 7, 8, 9, 64])
def test_table_lookups_give_inner_products(dims):
    rng = np.random.default_rng(dims)
    rows, anchors = rng.integers(-300, 300, (1100, dims)), rng.integers(-300, 300, (5, dims))
    for kind in (np.int32, np.int64):
        assert np.array_equal(scores(bit_planes(rows, 10), subset_sums(anchors, kind)), rows @ anchors.T)


def brute_negatives(rows):
    best = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        values = [int(np.floor(256 * float(x))) for x in vector]
        best[i] = min(best.get(i, (label, values)), (label, values))
    out = []
    product = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for anchor in sorted(i for i in best if i % 100 == 0):
        label, values = best[anchor]
        order = sorted((-product(values, v), i, other) for i, (other, v) in best.items() if i != anchor)
        for score, positive, _ in [x for x in order if x[2] == label][:5]:
            fit = [(s, i) for s, i, other in order if other != label and 80 * -score <= 100 * -s <= 100 * -score]
            out += [(anchor, positive, n + 1, i, -score, -s) for n, (s, i) in enumerate(fit[:5])]
    return sorted(out)


def test_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)], int(rng.integers(0, 3))) for i in range(330)]
    rows += [(400 + i, [0.5, 0.5, 0.1, 0.0, 0.0, 0.0], i % 4) for i in range(60)]
    rows += [(600, None, 1), (601, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (602, [float("nan")] * 6, 1), (603, [float("inf")] * 6, 0), (604, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    rows += [(700, [0.4, 0.4], 2), (800, [], 1), (900, [0.3] * 6, 1), (900, [0.3] * 6, 1), (900, [0.2] * 6, 2), (-100, [0.1] * 6, 0), (1000, [-0.4] * 6, 7)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    table = table.withColumns({f"`{c}`" if "." in c else c: F.lit("clash") for c in CLASHING})
    wanted = brute_negatives([(r[0], r[1], r[2]) for r in table.select("vec_id", "embedding", "label").collect()])
    for block in (50, 4096):
        got = mine_negatives(table, F.col("vec_id") % 100 == 0, block=block)
        assert sorted(tuple(r) for r in got.collect()) == wanted
    assert {r[0] for r in wanted} > {0, 100, 200, 300, 400}
    assert mine_negatives(table.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert mine_negatives(table, F.col("vec_id") == 5000).collect() == []
    with pytest.raises(ValueError, match="do not fit"):
        mine_negatives(spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], "vec_id bigint, embedding array<float>, label int"), F.col("vec_id") == 0)


# spelling variants


def brute_words(rows, least=7, modulus=31):
    found = Counter()
    for doc, text in rows:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for word in re.findall("[a-zÀ-ÿ]+", folded):
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % modulus == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += len(word) >= least
    return {w: n for w, n in found.items() if n >= 2}


def brute_variants(words, ratio=10):
    """By deleting each letter of each word: words one edit apart share what is left."""
    left = defaultdict(set)
    for word in words:
        left[word].add(word)
        for i in range(len(word)):
            left[word[:i] + word[i + 1 :]].add(word)
    near = defaultdict(set)
    for some in left.values():
        for a in some:
            for b in some:
                if a != b and one_edit(a, b):
                    near[a].add(b)
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        form[word] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        out.add((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_variants_equal_brute_force(spark, sf):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    wanted = brute_variants(brute_words(docs))
    assert {tuple(r) for r in QUERIES["op13_spelling_variants"](spark, sf).collect()} == wanted
    assert any(form and root != form for _, form, root, *_ in wanted) or len(wanted) > 100


def test_variants_of_crowded_words(spark):
    """Few letters and repeated grams: every way in which two words may be near."""
    rng = random.Random(7)
    words = {"a" * 7: 900, "a" * 8: 80, "a" * 9: 7, "abababa": 5, "bababab": 500, "é" * 7 + "ab": 3, "x" * 3000: 2, "x" * 3001: 40}
    for _ in range(900):
        words["".join(rng.choice("abé") for _ in range(rng.randint(7, 9)))] = rng.choice([2, 3, 30, 400])
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert {tuple(r) for r in spelling_variants(table).collect()} == brute_variants(words)


def test_pivots_are_the_rarest_disjoint_pair():
    rng = random.Random(8)
    for _ in range(300):
        place = sorted(rng.sample(range(12), rng.randint(3, 6)))
        weight = [rng.randint(1, 5) for _ in place]
        ((a, b),) = choose_pivots([0, len(place)], place, weight)
        assert place[b] - place[a] >= 2
        assert weight[a] + weight[b] == min(weight[i] + weight[j] for i in range(len(place)) for j in range(i) if place[i] - place[j] >= 2)


def test_side_hashes_tell_texts_apart():
    grams = Grams(["abcdefg", "xxabcdefg", "abcdefgh"])
    left, right = grams.side_hashes(np.arange(len(grams.at)))
    at = {(int(w), int(p)): n for n, (w, p) in enumerate(zip(grams.word, grams.place, strict=True))}
    assert left[at[0, 3]] == left[at[2, 3]] != left[at[1, 5]]
    assert right[at[0, 3]] == right[at[1, 5]] != right[at[2, 3]]


def test_variants_of_odd_rows(spark):
    rows = [(1, "Internationalisation"), (1, "internationalisation"), (2, None), (3, ""), (None, "INTERNATIONALISATION short"), (4, "internationalisatio÷n 1234567"), (5, "q" * 100_000)]
    rows += [(10 + i, "internationalizatión ÉcoleÀÿ") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({f"`{c}`" if "." in c else c: F.lit("clash") for c in CLASHING})
    assert {tuple(r) for r in group_spellings(table).collect()} == brute_variants(brute_words(rows))
    assert group_spellings(table.limit(0)).collect() == []
