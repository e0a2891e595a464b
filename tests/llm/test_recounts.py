"""Whole tables recounted in plain Python: shards, languages and quality, by code of their own."""

import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from tickmart.llm.language import BLOCK, DICTIONARY_BYTES, LEVEL, Languages, identify_languages, learn_languages
from tickmart.llm.quality import judge_quality, learn_quality
from tickmart.llm.sharding import shards


def spark_hash(*values) -> int:
    """Spark's 64-bit hash of these values, nulls left out: each value seeds the next."""
    seed = 42
    for value in values:
        if value is not None:
            data = value.encode() if isinstance(value, str) else value
            seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def shard_places(rows, n_shards, seed):
    """(id, source, size, crc, shard, slot) of every (id, text, source)."""
    seeded = struct.pack("<i", seed)
    sources = defaultdict(list)
    for doc, text, source in rows:
        data = None if text is None else text.encode()
        mixed = spark_hash(seeded, None if doc is None else struct.pack("<q", doc), text)
        sources[source].append((mixed, doc, zlib.crc32(data or b""), len(data or b"") + 1))
    order = []
    for source, members in sources.items():
        offset = spark_hash(seeded, source) % (1 << 20) / (1 << 21) + 0.25
        members.sort(key=lambda m: (m[0], m[1] is not None, m[1]))
        for rank, (_, doc, crc, size) in enumerate(members):
            order.append(((rank + offset) / len(members), source is not None, source, rank, doc, size, crc))
    order.sort(key=lambda m: m[:4])
    firsts = [-(-s * len(order) // n_shards) for s in range(n_shards)]
    out = []
    for position, (_, _, source, _, doc, size, crc) in enumerate(order):
        shard = position * n_shards // len(order)
        out.append((doc, source, size, crc, shard, position - firsts[shard]))
    return out


def plain(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("n_shards, seed", [(8, 17), (7, 3)])
def test_every_row_has_the_shard_and_slot_of_the_law(spark, sf, n_shards, seed):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    expected = shard_places([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], n_shards, seed)
    assert plain(shards(docs, n_shards, seed).collect()) == plain(expected)


def test_shards_of_nulls_and_small_sources(spark):
    rows = [(i, None if i % 5 == 0 else f"text {i}é", (None, "a", "b", "c")[min(i % 9, 3)]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert plain(shards(docs, 8).collect()) == plain(shard_places(rows, 8, 17))


def smallest(text, dictionaries):
    """The sizes of a text by language, by plain compression block by block."""
    low = "".join(chr(b) if 97 <= b <= 122 or b > 127 else " " for b in text.lower().encode()).encode("latin-1")
    sizes = {}
    for name, content in dictionaries.items():
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        codec = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes[name] = sum(len(codec.compress(low[i : i + BLOCK])) for i in range(0, len(low), BLOCK))
    return sizes


def test_the_language_of_every_text_is_the_one_that_compresses_best(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    languages = learn_languages(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    letters = lambda text: "".join(chr(b) if 97 <= b <= 122 or b > 127 else " " for b in text.lower().encode()).encode("latin-1")
    dictionaries = {r["lang"]: letters(r["content"])[:DICTIONARY_BYTES] for r in languages.contents.collect()}
    assert set(dictionaries) == {r[0] for r in docs.select("lang").distinct().collect() if r[0]}
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    for r in identify_languages(docs, languages).collect():
        text = texts[r["doc_id"]]
        if text is None or not any(c.isalpha() for c in text):
            assert (r["best"], r["score"]) == ("und", 0)
            continue
        sizes = smallest(text, dictionaries)
        first, second = sorted(sizes.values())[:2]
        assert r["best"] == min(name for name, size in sizes.items() if size == first)
        assert r["score"] == pytest.approx(1 - first / second) and 0 <= r["score"] <= 1


def test_languages_that_tie_go_to_the_first_name(spark):
    contents = spark.createDataFrame([(name, "the same words in either language " * 9) for name in ("zz", "aa", "mm")], "lang string, content string")
    docs = spark.createDataFrame([(1, "the same words"), (2, "other words altogether"), (3, "7"), (4, None)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in identify_languages(docs, Languages(contents, DICTIONARY_BYTES)).collect()}
    assert [found[i]["best"] for i in (1, 2, 3, 4)] == ["aa", "aa", "und", "und"]
    # no margin: named in best, undecided in lang
    assert all(found[i]["score"] == 0 and found[i]["lang"] == "und" for i in found)


def recount(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    repeated = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": sum(n - 1 for n in Counter(lines).values()),
        "n_repeat_words": len(repeated),
    }


def test_counts_and_verdicts_of_every_document(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rules = learn_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    rows = judge_quality(docs, rules).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        expected = recount(texts[r["doc_id"]])
        assert {name: r[name] for name in expected} == expected
        base = expected["n_words"] < 10 or 100 * expected["n_repeat_words"] > 20 * expected["n_words"]
        n_words, chars = max(r["n_words"], 1), max(r["word_chars"], 1)
        measure = {
            "mean_word": r["word_chars"] / n_words, "symbol_share": r["n_symbols"] / chars, "dup_line_share": r["n_dup_lines"] / max(r["n_lines"], 1),
            "repeat_share": r["n_repeat_words"] / n_words, "distinct_share": r["n_distinct_words"] / n_words, "upper_share": r["n_upper"] / chars,
            "digit_share": r["n_digits"] / chars, "ends_share": r["n_ends"] / n_words, "words": r["n_words"], "longest_word": r["longest_word"],
        }
        first = next((i for i, rule in enumerate(rules.rules) if all((measure[c.measure] > c.threshold) == c.above for c in rule)), None)
        assert (r["base_failed"], r["reason"], r["kept"]) == (base, -1 if base else first, not base and first is None)
