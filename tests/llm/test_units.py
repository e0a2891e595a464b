"""The operators' building blocks against brute force, without Spark."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickmart.llm.components import forest
from tickmart.llm.decontaminate import Words
from tickmart.llm.ngram_join import HASHES, least_matches, likely_links, overlaps
from tickmart.llm.packing import TIERS, Encoder, Places, plan_packing
from tickmart.llm.quality import best_condition, holds, learn_rules, repeated_words, text_stats
from tickmart.llm.shingles import MinHash, shingle_sets
from tickmart.llm.suffix_dedup import anchors, cut, key_hashes
from tickmart.llm.suffix_sort import sort_strings
from tickmart.llm.transducer import BLOCK, Merges, PieceMachine, TokenCounter, blocks
from tickmart.llm.urls import Rule, build_trie, longest_match

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD_TEXTS = [
    "", " ", "  a", "a  b ", "it's we'LL don't've", "\n's 'sabc", "x" * 700, "ab" * 400, "über Straße", "日本語 テスト", "1²3 ١٢",
    "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "a\x1cb \x1c", "a b  c", "'s" * 5, " " * 300, "-" * 300, "a" + " " * 9 + "b",
    "\r\n\r\n", "👩‍👩‍👧 hi", "​ b", "\x85x", "\x00\x00",
]


def odd_texts():
    rng = random.Random(5)
    alphabet = "ab '\nstlrvedm1!.é \t日<|　 "
    return ODD_TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_transducer_counts_like_the_library(library):
    texts = odd_texts()
    wanted = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert TokenCounter(VOCABULARY).count([t.encode() for t in texts]).tolist() == wanted
    assert TokenCounter(VOCABULARY).count([None, b"", b"a"]).tolist() == [0, 0, 1]


def test_machine_forgets_states_and_still_counts(library):
    counter = TokenCounter(VOCABULARY)
    counter.machine.most_states = 50
    for text in ("several words of a text", "andotherswithoutablank" * 20, "yet more of them"):
        assert counter.count([text.encode()]).tolist() == [len(library.encode(text).ids)]


def test_long_texts_are_cut_at_seams():
    text = b"words and more " * (BLOCK // 4)
    parts = blocks(text)
    assert len(parts) > 1 and b"".join(parts) == text and all(p.startswith(b" ") for p in parts[1:])
    assert blocks(b"x" * (3 * BLOCK)) == [b"x" * (3 * BLOCK)]


def test_piece_counts_follow_chunk_composition():
    merges = Merges(VOCABULARY)
    machine = PieceMachine(merges)
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"thernois") for _ in range(n)) for n in (1, 63, 64, 65, 200, 1000)]
    lengths = np.array([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    counts = machine.count(data, np.cumsum(lengths) - lengths, lengths)
    assert counts.tolist() == [len(merges.encode(p)) for p in pieces]


def test_encoder_ids_are_the_librarys(library):
    codec = Encoder(VOCABULARY)
    for text in odd_texts():
        wanted = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert codec.encode(text.encode()) == wanted, text


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 1024), st.integers(1, 40), max_size=60))
def test_packing_places_every_piece_once(counts):
    patterns = plan_packing(counts)
    places, seen = Places(patterns), {}
    for length, n in counts.items():
        found = places.of(length, np.arange(n))
        for row in zip(*(found[c].tolist() for c in ("sequence_id", "offset", "window", "step")), strict=True):
            seen.setdefault((row[0], row[2], row[3]), []).append((row[1], length))
    assert len({s for s, _, _ in seen}) == len(seen)
    for (_, window, step), parts in seen.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window and step >= 0
        if window < TIERS[0]:
            assert end == window
    assert sum(len(p) for p in seen.values()) == sum(counts.values())


def test_steps_of_all_tiers_alternate():
    patterns = plan_packing({1024: 64, 512: 0, 500: 0})
    places = Places(patterns)
    places.steps, places.per_step = {1024: 4, 512: 2}, {1024: 8, 512: 16}
    order = sorted([(int(places.step(np.array([i * 8]), 1024)[0]), 1024) for i in range(4)] + [(int(places.step(np.array([i * 16]), 512)[0]), 512) for i in range(2)])
    assert [n for n, _ in order] == list(range(6))
    assert [w for _, w in order] == [1024, 512, 1024, 1024, 512, 1024]


def test_strings_are_sorted_with_their_common_lengths():
    rng = random.Random(3)
    for _ in range(60):
        n, width = rng.randint(1, 60), rng.choice([8, 72, 100, 200])
        base = [bytes(rng.choice(b"ab") for _ in range(width)) for _ in range(3)]
        rows = []
        for _ in range(n):
            row = bytearray(rng.choice(base))
            if rng.random() < 0.6:
                row[rng.randrange(width)] = rng.randrange(254)
            rows.append(bytes(row))
        segment = np.array([rng.randrange(3) for _ in range(n)])
        order, common = sort_strings(np.frombuffer(b"".join(rows), np.uint8).reshape(n, width), segment)
        key = [(segment[i], rows[i]) for i in order]
        assert key == sorted(key)
        for k in range(n):
            if k == 0 or key[k][0] != key[k - 1][0]:
                assert common[k] == -1
            else:
                same = next((i for i in range(width) if key[k][1][i] != key[k - 1][1][i]), width)
                assert common[k] == same


def test_every_window_holds_an_anchor_that_its_copies_share():
    rng = random.Random(4)
    shared = bytes(rng.randrange(97, 123) for _ in range(60))
    texts = [bytes(rng.randrange(97, 123) for _ in range(rng.randint(0, 90))) + shared + bytes(rng.randrange(97, 123) for _ in range(30)) for _ in range(6)]
    text, position, _ = anchors(texts, 60, 12)
    for number, content in enumerate(texts):
        mine = set(position[text == number].tolist())
        for start in range(len(content) - 60 + 1):
            assert any(start <= p <= start + 48 for p in mine)
    at = [sorted(position[text == n] - t.index(shared)) for n, t in enumerate(texts)]
    inner = [{int(p) for p in positions if 0 <= p <= 48} for positions in at]
    assert set.intersection(*inner)


def test_key_hashes_depend_on_content_alone():
    found = key_hashes(np.frombuffer(b"abcdefgabcdefgh", np.uint8), 5)
    assert len(found) == 11 and found[0] == found[7] and len(set(found.tolist())) == 8
    assert len(key_hashes(np.frombuffer(b"abc", np.uint8), 5)) == 0


def test_cut_keeps_whole_characters():
    text = "aéb".encode()
    assert cut(text, [{"start": 2, "end": 4}], False) == b"a\xc3"
    assert cut(text, [{"start": 2, "end": 4}], True).decode() == "aé"
    assert cut(text, [{"start": 0, "end": 2}], True).decode() == "éb"


def test_shingles_and_minhash():
    one, same, short, none, null = shingle_sets([b"A b, c d e f", b"a B c D e-F", b"a b", b" .,", None], 5)
    assert one.tolist() == same.tolist() and len(one) == 2 and len(short) == 1 and not len(none) and not len(null)
    assert shingle_sets([b"x y z u v"], 5)[0].tolist() == shingle_sets([b"q", b"x y z u v"], 5)[1].tolist()
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
    b = np.concatenate([a[:800], np.unique(rng.integers(0, 1 << 62, 200).astype(np.uint64))])
    signatures = MinHash(512).signatures([a, b, a[:0]])
    assert abs((signatures[0] == signatures[1]).mean() - 800 / 1200) < 0.08
    assert (signatures[2] == 0xFFFFFFFF).all()


def test_posterior_prunes_more_as_more_agree_less():
    least = least_matches(0.8, 1e-6)
    assert 0 < least[32] < least[64] < least[96] < least[128] < 128 * 0.8


def test_likely_links_connect_like_all_pairs():
    rng = np.random.default_rng(2)
    least = least_matches(0.8, 1e-6)
    base = rng.integers(0, 256, (4, HASHES)).astype(np.uint8)
    rows = base[rng.integers(0, 4, 60)].copy()
    noise = rng.random(rows.shape) < 0.05
    rows[noise] = rng.integers(0, 256, noise.sum())
    a, b = likely_links(np.arange(60), rows, least)
    # all rows of one origin are one star
    root = {int(y): int(x) for x, y in zip(*forest(a, b), strict=True)}
    assert len({root.get(i, i) for i in range(60)}) == 4


def test_overlaps_are_set_intersections():
    rng = random.Random(6)
    sets = [np.array(sorted({rng.randrange(80) for _ in range(rng.randint(1, 40))}), np.uint64) for _ in range(20)]
    found = overlaps(sets, 7)
    for i, x in enumerate(sets[:7]):
        assert [len(set(x.tolist()) & set(y.tolist())) for j, y in enumerate(sets) if j != i] == [n for j, n in enumerate(found[i].tolist()) if j != i]


def test_forest_keeps_components():
    a, b = forest(np.array([5, 3, 9, 7]), np.array([3, 8, 7, 2]))
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(2, 7), (2, 9), (3, 5), (3, 8)]


def test_shingles_stay_inside_texts_and_name_words_anywhere(monkeypatch):
    import tickmart.llm.decontaminate as module

    texts = [b"a b c d", None, b"", b"x", b" B. c D"]
    for size in (1 << 22, 3):  # bytes numbered together
        monkeypatch.setattr(module, "HASHED_BYTES", size)
        words = Words(texts)
        assert (words.last - words.first).tolist() == [4, 0, 0, 1, 3]
        at, keys = words.shingles(3)
        assert at.tolist() == [0, 1, 5] and keys[1] == keys[2] != keys[0]
        assert len(words.shingles(1)[0]) == 8 and len(set(words.shingles(1)[1].tolist())) == 5
    assert words.short(0, 2) == [b"a", b"b"] and len(Words([b"x" * 33]).short(0, 1)[0]) == 17


def test_text_stats():
    text = "ab é#\n\x0bab é#\n \nz"
    stats = text_stats(text.encode())
    assert stats[:5] == (5, 9, 2, 0, 0)
    assert text_stats(None)[:5] == (0, 0, 0, 0, 0)
    assert text_stats(b"a b\na b\n\n\na c")[3] == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=30))
def test_repeated_words(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    assert repeated_words(words) == len(covered)


def test_rules_are_learned_and_pruned():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 4))
    bad = (x[:, 1] > 0.8) & (x[:, 2] < 0.5) | (x[:, 0] < 0.1)
    rules = learn_rules(x, bad)
    rejected = np.any([holds(rule, x) for rule in rules], axis=0)
    assert (rejected == bad).mean() > 0.98
    assert learn_rules(x, rng.random(3000) < 0.1) == []
    _, choice = best_condition(np.array([[1.0], [1.0], [2.0], [2.0]]), np.array([True, True, False, False]))
    assert choice == (0, False, 1.5)


def test_trie_precedence():
    trie = build_trie([
        Rule("com", "/", True), Rule("example.com", "/en/", False), Rule("EXAMPLE.com", "/en/a", True), Rule("", "/ads", False), Rule("x.org", "", False),
        Rule("x.org", "", True),
    ])

    def verdict(host, path):
        found = longest_match(trie, host, path)
        return found and (found[1], found[2])

    assert verdict("www.example.com", "/en/b") == ("example.com/en/", False)
    assert verdict("example.com", "/en/abc") == ("example.com/en/a", True)
    assert verdict("example.com", "/english/") == ("com/", True)
    assert verdict("notexample.com", "/en/b") == ("com/", True)
    assert verdict("com", "") is None
    assert verdict("a.net", "/adserver/1") == ("/ads", False)
    assert verdict("", "") is None
    assert verdict("a.x.org", "") == ("x.org", False)
