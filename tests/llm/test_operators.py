"""The operators on small tables: brute force, and rows that are odd in every way."""

import hashlib
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline
from tickmart.llm import language
from tickmart.llm.components import components
from tickmart.llm.decontaminate import drop_contaminated, find_contamination, words_of
from tickmart.llm.language import identify_languages, learn_languages
from tickmart.llm.ngram_join import in_blocks, keep_one, ngram_links
from tickmart.llm.packing import pack
from tickmart.llm.quality import DecisionList, judge_quality, keep_good, learn_quality
from tickmart.llm.queries import QUERIES
from tickmart.llm.ranking import ranked
from tickmart.llm.sharding import shards
from tickmart.llm.shingles import shingle_sets
from tickmart.llm.suffix_dedup import remove_repeats, repeats, text_key
from tickmart.llm.token_counts import token_counts
from tickmart.llm.urls import Rule, judge_urls
from tickmart.llm.warc import RECORD, canonical_url, resolve_revisits

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CLASHING = ("id", "key", "class", "size", "rank", "part", "kept", "spans", "n_words", "_text", "_id", "row", "hash", "t1", "label", "host", "rule")
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("ra", "se", "ti") for c in ("", "n", "ster", "q")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows, and clashing columns."""
    rng = random.Random(9)
    long = prose(rng, 60_000)
    rows = [
        (1, "plain words of an ordinary text " + prose(rng, 60), "en", "s"), (2, None, "en", "s"), (3, "", None, None), (None, "no id " + prose(rng, 40), "de", "s"),
        (4, long, "en", "s"), (5, "   \n\t ", "fr", "t"), (6, "12 34", None, "s"), (7, "same text " + prose(random.Random(1), 50), "en", "s"),
        (7, "same text " + prose(random.Random(1), 50), "en", "s"), (8, "same text " + prose(random.Random(1), 50), "en", "s"), (None, None, None, None), (9, "é" * 500, "fr", "s"),
    ]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return table.withColumns({c: F.lit("clash") for c in CLASHING})


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def row_ids(odd):
    return sorted((r[0] for r in odd.select("doc_id").collect()), key=lambda x: (x is None, x))


def same_ids(found, odd):
    assert sorted((r[0] for r in found.select("doc_id").collect()), key=lambda x: (x is None, x)) == row_ids(odd)


# ranks and shards


def test_ranked_numbers_each_key(spark):
    rows = spark.createDataFrame([(k, v % 5, v) for k in ("a", None) for v in range(40)], "k string, b long, v long")
    got = ranked(rows, ["k"], "b", [F.col("v")], "at").collect()
    for key in ("a", None):
        mine = sorted((r["b"], r["v"], r["at"]) for r in got if r["k"] == key)
        assert [at for *_, at in mine] == list(range(40))


def test_shards_hold_the_mixture(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = shards(docs, 8).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in docs.select("doc_id").collect())
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    share = Counter((r["source"], r["shard"]) for r in rows)
    for source in {r["source"] for r in rows}:
        counts = [share[source, s] for s in range(8)]
        assert max(counts) - min(counts) <= 2
    texts = dict(docs.select("doc_id", "text").collect())
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    again = shards(docs.repartition(5), 8).collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in again}
    assert {tuple(r) for r in shards(docs, 8, seed=18).collect()} != {tuple(r) for r in rows}


def test_shards_of_odd_rows(spark, odd):
    rows = shards(odd, 5).collect()
    assert len(rows) == 12 and sorted(Counter(r["shard"] for r in rows).values()) == [2, 2, 2, 3, 3]
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (2, 3)} == {(1, 0)}
    assert shards(odd.limit(0), 5).collect() == []


# packing and token counts


def check_packing(rows, docs):
    library = Tokenizer.from_file(VOCABULARY)
    wanted = Counter()
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        wanted[doc_id, len(ids)] += 1
        crcs = {(r["start"], r["length"]): r["ids_crc32"] for r in rows if r["doc_id"] == doc_id and r["doc_tokens"] == len(ids)}
        for (start, length), crc in crcs.items():
            if wanted[doc_id, len(ids)] == 1 and Counter(d for d, _ in docs)[doc_id] == 1:
                assert zlib.crc32(ids[start : start + length].tobytes()) == crc
    covered = Counter()
    for r in rows:
        covered[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert covered == Counter({(d, n): n * times for (d, n), times in wanted.items()})
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["window"], r["step"]))
    used = padded = 0
    for parts in sequences.values():
        end = 0
        for offset, length, window, step in sorted(parts):
            assert offset == end and (window, step) == parts[0][2:]
            end += length
        assert end <= parts[0][2]
        used += end
        padded += end if end & (end - 1) == 0 else 1024
    return used / padded


def test_packing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = pack(docs, VOCABULARY).collect()
    assert check_packing(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()]) > 0.95
    steps = Counter()
    for window, step, _ in {(r["window"], r["step"], r["sequence_id"]) for r in rows}:
        steps[step, window] += window
    assert sorted(s for s, _ in steps) == list(range(len(steps)))
    assert all(tokens <= 8192 for tokens in steps.values())


def test_packing_of_odd_rows(spark, odd):
    rows = pack(odd, VOCABULARY).collect()
    check_packing(rows, [tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert [r["length"] for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    assert pack(odd.limit(0), VOCABULARY).collect() == []
    with pytest.raises(ValueError):
        pack(odd, VOCABULARY, tiers=(1000,))


def test_token_counts(spark, sf, odd):
    library = Tokenizer.from_file(VOCABULARY)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    wanted = Counter()
    for doc_id, text in docs.collect():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted[doc_id, len((text or "").encode()), n, n > 1024] += 1
    assert Counter(tuple(r) for r in token_counts(docs, VOCABULARY, 1024).collect()) == wanted
    same_ids(token_counts(odd, VOCABULARY, 1024), odd)
    assert token_counts(odd.limit(0), VOCABULARY, 1024).collect() == []


# suffix-array dedup


def covered(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marks = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                marks[i : i + length] = [True] * length
        spans, i = [], 0
        while i < len(t):
            if marks[i]:
                end = next((k for k in range(i, len(t)) if not marks[k]), len(t))
                spans.append((i, end))
                i = end
            else:
                i += 1
        out.append(spans)
    return out


@pytest.mark.parametrize("options", [{}, {"together": 3}])
def test_repeats_are_those_of_brute_force(spark, options):
    rng = random.Random(3)
    parts = ["".join(rng.choice("abé d\n") for _ in range(rng.randint(5, 60))) for _ in range(6)] + ["a" * 50, "xy" * 30]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(0, 8))) for _ in range(40)]
    texts += ["", "short", texts[0], texts[1], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = repeats(docs, 40, key=8, **options).select("t1", "t2", "spans")
    keyed = docs.select("doc_id", *text_key(F.coalesce("text", F.lit(""))))
    got = {r["doc_id"]: [tuple(s) for s in r["spans"] or []] for r in keyed.join(found, ["t1", "t2"], "left").collect()}
    assert [got[i] for i in range(len(texts))] == covered([(t or "").encode() for t in texts], 40)


def test_removal_keeps_rows_and_columns(spark, odd):
    left = remove_repeats(odd)
    assert left.columns == odd.columns
    same_ids(left, odd)
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert texts[2] is None and texts[3] == "" and texts[7] == texts[8] == "" and texts[1].startswith("plain words")
    # 500 two-byte characters repeat themselves; 200-byte strings start at every byte
    assert texts[9] == ""
    assert remove_repeats(odd.limit(0)).collect() == []


def test_op2_digests(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    contents = [r["text"].encode() for r in docs]
    for r, spans, content in zip(docs, covered(contents, 200), contents, strict=True):
        kept, at = b"", 0
        for start, end in spans:
            kept, at = kept + content[at:start], end
        kept += content[at:]
        docs[docs.index(r)] = (r["doc_id"], len(content), len(content) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    found = QUERIES["op2_suffix_dedup"](spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found)) == sorted(docs)


# near copies


def brute_links(texts):
    sets = [set(s.tolist()) for s in shingle_sets([t.encode() if t is not None else None for t in texts], 5)]
    n = len(sets)
    label, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return links, label


def check_links(docs):
    rows = docs.select("doc_id", "text").collect()
    links, label = brute_links([r["text"] for r in rows])
    found = {r["doc_id"]: r for r in ngram_links(docs).collect()}
    least = {}
    for r, x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, r["doc_id"]), r["doc_id"])
    for r, n, x in zip(rows, links, label, strict=True):
        assert (found[r["doc_id"]]["n_links"], found[r["doc_id"]]["class_id"]) == (n, least[x])
    assert sorted(r["doc_id"] for r in keep_one(docs).collect()) == sorted(least.values())


def test_links_are_those_of_brute_force(spark, sf):
    check_links(spark.read.parquet(f"{sf}/documents.parquet"))


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    import tickmart.llm.ngram_join as module

    monkeypatch.setattr(module, "BLOCK", 8)
    rng = random.Random(4)
    texts = []
    for size in (60, 25, 2, 1):
        words = [rng.choice(WORDS) + str(rng.randint(0, 50)) for _ in range(120)]
        for _ in range(size):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(120)] = "changed" + str(rng.randint(0, 9999))
            texts.append(" ".join(copy))
    texts += [texts[0]] * 5
    check_links(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))


def test_every_pair_of_blocks_meets_once(spark):
    members = spark.createDataFrame([(i, 5, 1500) for i in range(1500)], 'class long, key long, size long')
    groups = {}
    for r in in_blocks(members, "key", "size").collect():
        groups.setdefault((r["low"], r["high"]), []).append((r["class"], r["_mine"]))
    assert len(groups) == 6 and all(len(g) == len({c for c, _ in g}) for g in groups.values())
    assert all({m for _, m in g} == {low, high} for (low, high), g in groups.items())


def test_one_document_of_each_group_stays(spark, odd):
    stay = keep_one(odd)
    assert stay.columns == odd.columns
    # null, empty, blank texts are one group; of the equal ones one stays
    assert row_ids(stay) == [1, 2, 4, 6, 7, 9, None]
    found = ngram_links(odd).collect()
    assert len(found) == 12 and {r["n_links"] for r in found if r["doc_id"] in (7, 8)} == {2}
    assert keep_one(odd.limit(0)).collect() == [] and ngram_links(odd.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# decontamination


def brute_contamination(docs, items):
    windows = {}
    for item, text in items:
        words = words_of(text.encode() if text is not None else None)
        for i in range(max(1, len(words) - 12)) if words else ():
            windows.setdefault(tuple(words[i : i + 13]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words = words_of(text.encode() if text is not None else None)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[w]
        out.append((doc_id, len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_contamination_is_that_of_brute_force(spark, sf, odd, bits, monkeypatch):
    import tickmart.llm.decontaminate as module

    # also with a sieve so full that it lets through most
    monkeypatch.setattr(module, "SIEVE_BITS", bits)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    extra = spark.createDataFrame([(900, "ordinary text"), (901, None), (902, " . "), (None, "plain words"), (900, "ordinary text")], "item_id long, text string")
    items = items.limit(60).unionByName(extra)
    found = find_contamination(docs, items)
    got = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in found.collect()]
    order = lambda r: (r[0] is None, str(r))
    assert sorted(got, key=order) == sorted(brute_contamination([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()]), key=order)


def test_contaminated_rows_go_with_their_columns_kept(spark, odd):
    items = spark.createDataFrame([(1, "plain words of an ordinary text")], "item_id long, text string")
    left = drop_contaminated(odd, items)
    assert left.columns == odd.columns and 1 not in row_ids(left) and len(row_ids(left)) == 11
    assert collected(left, "doc_id", "text", "key") == collected(odd.where("not coalesce(doc_id = 1, false)"), "doc_id", "text", "key")
    assert collected(drop_contaminated(odd, items.limit(0)), "doc_id") == collected(odd, "doc_id")
    assert find_contamination(odd.limit(0), items).collect() == []


# quality, language, addresses


def test_quality_rules_separate_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rules = learn_quality(docs, labels)
    judged = judge_quality(docs, rules).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r["kept"] for r in judged if r["quality"]], [r["kept"] for r in judged if not r["quality"]]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)
    assert "reject if" in str(rules)


def test_quality_of_odd_rows(spark, odd):
    judged = judge_quality(odd, DecisionList(()))
    same_ids(judged, odd)
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert kept == {1: True, 2: False, 3: False, None: kept[None], 4: kept[4], 5: False, 6: False, 7: True, 8: True, 9: False}
    left = keep_good(odd, DecisionList(()))
    assert left.columns == odd.columns
    assert collected(left, "doc_id") == collected(judged.where("kept"), "doc_id")
    assert judge_quality(odd.limit(0), DecisionList(())).collect() == []
    for labels in ([], [(1, 1), (1, 0), (None, 0), (7, None), (8, 1)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        assert learn_quality(odd, table).rules == ()


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op6_language_id"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) > 0.97 * len(found)
    sure = [r for r in found if not r["rejected"]]
    assert len(sure) > 0.9 * len(found) and all(0 <= r["score"] <= 1 for r in found)


def test_languages_of_odd_rows(spark, odd):
    found = identify_languages(odd, learn_languages(odd))
    same_ids(found, odd)
    got = {r["doc_id"]: r for r in found.collect()}
    assert {got[i]["best"] for i in (2, 3, 5, 6)} == {"und"} and got[1]["best"] in ("en", "de", "fr")
    assert {r["best"] for r in identify_languages(odd, learn_languages(odd.limit(0))).collect()} == {"und"}
    assert identify_languages(odd.limit(0), learn_languages(odd)).collect() == []


def test_every_language_gets_a_dictionary(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for n in range(230):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(30)]
        rows += [(10 * n + k, " ".join(rng.choice(words) for _ in range(120)), f"x{n}") for k in range(2 + (n < 200))]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    learned = learn_languages(table)
    assert sorted(learned.names) == sorted({r[2] for r in rows})
    found = collected(identify_languages(table, learned), "doc_id", "best", "score")
    assert {(d, best) for d, best, _ in found} == {(d, lang) for d, _, lang in rows} and len(found) == len(rows)
    # the size of the blocks changes nothing
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 1000)
    assert collected(identify_languages(table, learned), "doc_id", "best", "score") == found


def test_few_long_texts_fill_their_dictionary(spark):
    rng = random.Random(6)
    rows = [(n, prose(rng, 8000), "rare") for n in range(5)] + [(10 + n, prose(rng, 40), "usual") for n in range(50)]
    size = 1 << 14
    (block,) = learn_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), size=size).blocks()
    # equal shares of the five texts; short texts are taken whole
    assert 0.95 * size < len(block.dictionaries["rare"]) <= size
    assert len(block.dictionaries["usual"]) == sum(len(t) for _, t, lang in rows if lang == "usual") + 49


def test_urls(spark):
    rules = [Rule("com", "/", True), Rule("example.com", "/en/", False), Rule("www.example.com", "/en/", True), Rule("net", "/es/", False)]
    urls = {
        "http://EXAMPLE.com/en/1?x": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://example.com/EN/": ("example.com", "/EN/", "com/", "allow"),
        "http://b.net/es/?q=://c.com/": ("b.net", "/es/", "net/es/", "block"),
        "x\n://b.net#/es/": ("b.net", "", None, "allow"),
        "b.net/es/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "http://É.com/": ("É.com", "/", "com/", "allow"),
    }
    pages = spark.createDataFrame([(i if i else None, u, "x", "y") for i, u in enumerate([*urls, *urls])], "page_id long, url string, host string, best string")
    for per_trie in (100, 1):
        found = judge_urls(pages, rules, per_trie=per_trie).collect()
        order = list(urls.values()) * 2
        assert len(found) == len(order)
        for r in found:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == order[r["page_id"] or 0]
    assert {r["verdict"] for r in judge_urls(pages, [], default="block").collect()} == {"block"}
    assert judge_urls(pages.limit(0), rules).collect() == []


# revisits


def test_canonical_urls(spark):
    pairs = {
        "HTTP://User:pw@Example.COM:80/a/./b?q=1#f": "http://example.com/a/b?q=1", "https://example.com:443": "https://example.com/", "https://example.com.:8443/x": "https://example.com:8443/x",
        " http://a.b/% ": "http://a.b/%", "no scheme": "no scheme", "": "", None: None, "http://a.b?x=/./": "http://a.b/?x=/./",
    }
    got = spark.createDataFrame([(u,) for u in pairs], "u string").select(canonical_url(F.col("u"))).collect()
    assert [r[0] for r in got] == list(pairs.values())


def test_revisits(spark, monkeypatch):
    import tickmart.llm.warc as module

    rows = [
        (1, "response", "http://a.b/", "2024-01-01 00:00:00", {"ETag": "x", "Expires": "1", "Content-Length": "7"}, None),
        (2, "revisit", "HTTP://A.B", "2024-01-01 00:00:01", {"etag": "W/x", "EXPIRES": "2", "Content-Length": "0"}, None),
        (3, "response", "http://a.b/", "2024-01-02 00:00:00", {"Last-Modified": "d"}, "sha"),
        (4, "revisit", "http://a.b/#z", "2024-01-03 00:00:00", {"Last-Modified": "d"}, None),
        (5, "revisit", "http://a.b/", "2024-01-03 00:00:00", None, "sha"),
        (6, "revisit", "http://a.b/", "2024-01-03 00:00:00", None, "other"),
        (7, "revisit", "http://a.b/", "2024-01-03 00:00:00", None, None),
        (8, "revisit", "http://a.b/", "2023-01-03 00:00:00", {"etag": "x"}, None),
        (9, "revisit", None, "2024-01-03 00:00:00", {"etag": "x"}, None),
        (10, "revisit", "http://a.b/", None, {"etag": "x"}, None),
        (11, "request", "http://a.b/", "2024-01-03 00:00:00", None, None),
        (2, "revisit", "HTTP://A.B", "2024-01-01 00:00:01", {"etag": "W/x", "EXPIRES": "2", "Content-Length": "0"}, None),
        (12, "response", "http://a.b/", None, {"etag": "x"}, None),
    ]
    records = spark.createDataFrame(rows, RECORD.replace("timestamp_ntz", "string")).withColumn("at", F.col("at").cast("timestamp_ntz")).withColumn("found", F.lit(1))
    for size in (5_000, 2):
        monkeypatch.setattr(module, "SLICE_ROWS", size)
        found = [(r["record_id"], r["resolved_id"], r["outcome"], r["headers"]) for r in resolve_revisits(records).collect()]
        merged = {"etag": "W/x", "expires": "2", "content-length": "7"}
        assert sorted(found, key=str) == sorted([
            (2, 1, "resolved", merged), (2, 1, "resolved", merged), (4, 3, "resolved", {"last-modified": "d"}), (5, 3, "resolved", {"last-modified": "d"}),
            (6, None, "mismatch", None), (7, None, "unproven", None), (8, None, "unknown", None), (9, None, "unknown", None), (10, None, "unknown", None),
        ], key=str)
    assert resolve_revisits(records.limit(0)).collect() == []


def test_hot_addresses_find_the_latest_response(spark, monkeypatch):
    import tickmart.llm.warc as module

    monkeypatch.setattr(module, "SLICE_ROWS", 50)
    rng = random.Random(8)
    rows, wanted, last = [], {}, {}
    for i in range(600):
        url, kind = ("http://hot/" if rng.random() < 0.7 else f"http://u{rng.randint(0, 9)}/"), rng.choice(("response", "revisit", "revisit"))
        rows.append((i, kind, url, {"etag": "t"}))
        if kind == "response":
            last[url] = i
        else:
            wanted[i] = last.get(url)
    table = spark.createDataFrame(rows, "record_id long, type string, url string, headers map<string,string>")
    table = table.withColumns({"at": F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, record_id)"), "digest": F.lit(None).cast("string")})
    assert {r["record_id"]: r["resolved_id"] for r in resolve_revisits(table).collect()} == wanted


# the pipeline


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, sf).cache()
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    rules = learn_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert row_ids(good) == row_ids(judge_quality(docs, rules).where("kept"))
    one = stages["n-gram Jaccard join"](spark, good, sf).cache()
    rows = good.select("doc_id", "text").collect()
    _, label = brute_links([r["text"] for r in rows])
    least = {}
    for r, x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, r["doc_id"]), r["doc_id"])
    assert row_ids(one) == sorted(least.values())
    apart = stages["suffix-array dedup"](spark, one, sf).cache()
    rows = one.select("doc_id", "text").collect()
    wanted = {}
    for r, spans in zip(rows, covered([r["text"].encode() for r in rows], 200), strict=True):
        marked = bytearray(r["text"].encode())
        for start, end in spans:
            # whole characters only
            while start < end and marked[start] & 0xC0 == 0x80:
                start += 1
            while start < end < len(marked) and marked[end] & 0xC0 == 0x80:
                end -= 1
            marked[start:end] = b"\xff" * (end - start)
        if (text := marked.replace(b"\xff", b"").decode()).strip(" \t\n\x0b\x0c\r"):
            wanted[r["doc_id"]] = text
    assert apart.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in apart.collect()} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in apart.collect())
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    left = stages["benchmark decontamination"](spark, apart, sf).cache()
    found = brute_contamination([(r["doc_id"], r["text"]) for r in apart.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert left.columns == docs.columns and row_ids(left) == sorted(d for d, n, hit, _ in found if not (hit and 20 * hit >= n))
    check_packing(corpus_pipeline.run(spark, sf).collect(), [tuple(r) for r in left.select("doc_id", "text").collect()])


def test_pipeline_of_empty_documents(spark, sf, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_unlike_texts_of_one_id_all_stay(spark):
    rows = [(1, prose(random.Random(21), 40)), (1, prose(random.Random(22), 40)), (2, prose(random.Random(21), 40)), (None, "x y z"), (None, "p q r")]
    assert len({t for _, t in rows}) == 4
    kept = keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["text"] for r in kept.collect()) == sorted({t for _, t in rows})


def test_dotted_columns_pass_every_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40).withColumn("a.b", F.lit("kept"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf)
        assert found.columns == docs.columns, name
        assert {r["a.b"] for r in found.collect()} == {"kept"}, name


def test_long_words_and_repeated_items_of_one_window(spark):
    long = "é" * 40 + "x" * 5000
    words = [f"w{i}" for i in range(40)]
    items = [(1, f"{long} a b"), (2, f"{long}y a b"), (3, long), (4, " ".join(words)), (5, " ".join(words)), (6, " ".join(words[5:20])), (7, "w1 w2 w3 zz")]
    texts = [f"q {long} A b", " ".join(words[3:18]), " ".join(words[3:18]), " ".join(words[5:17]), f"{long}z", "", None, " ".join(words * 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = find_contamination(docs, spark.createDataFrame(items, "item_id int, text string"))
    got = sorted((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in found.collect())
    assert got == sorted(brute_contamination(list(enumerate(texts)), items))
    assert got[0][3] == ["1", "3"] and got[1][3] == ["4", "5", "6"] and got[3][3] == []


def test_the_driver_holds_no_items(spark, monkeypatch):
    """A sieve of fixed size is all that is collected."""
    frame = type(spark.range(1))
    seen, plain = [], frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: seen.append(plain(self)) or seen[-1])
    docs = spark.range(50).selectExpr("id as doc_id", "array_join(transform(sequence(0, 60), i -> concat('w', i * id)), ' ') as text")
    find_contamination(docs, docs.selectExpr("doc_id as item_id", "text"))
    assert len(seen) == 2 and all(set(r.asDict()) == {"bucket", "bits"} for rows in seen for r in rows)
