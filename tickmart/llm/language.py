"""Language identification by compression with one dictionary per language."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.session import materialize

#: Texts a language's dictionary is made of, about, and its bytes at most.
TEXTS_PER_LANGUAGE, DICTIONARY_BYTES = 1000, 1 << 17
#: Dictionaries that are held and compared at a time; each costs one compression of every text.
LANGUAGES_AT_ONCE = 64
#: A text is compressed in blocks of this size, each beginning with the dictionary alone.
BLOCK = 4096
LEVEL = 5
#: Rejected below this share of bytes saved against the second-best language.
MARGIN = 0.01
UNDECIDED = "und"
ASCII_LETTER = re.compile(rb"[A-Za-z]")
# only letters tell languages apart; digits and signs of ASCII become blanks
LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def folded(text: str) -> bytes:
    return text.lower().encode().translate(LETTERS)


def has_letter(text: bytes) -> bool:
    return ASCII_LETTER.search(text) is not None or not text.isascii() and any(c.isalpha() for c in text.decode())


class Classifier:
    """Raw-content dictionaries of some languages, in order of name; the language whose dictionary
    compresses a text most wins."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.dictionaries = dict(sorted(dictionaries.items()))
        self.compressors = None

    def __getstate__(self):
        return self.dictionaries

    def __setstate__(self, dictionaries):
        self.dictionaries, self.compressors = dictionaries, None

    def compress(self) -> list:
        if self.compressors is None:
            import zstandard as zstd

            self.compressors = []
            for content in self.dictionaries.values():
                prepared = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                prepared.precompute_compress(level=LEVEL)
                codec = zstd.ZstdCompressor(level=LEVEL, dict_data=prepared, write_content_size=False, write_checksum=False, write_dict_id=False)
                self.compressors.append(codec.compress)
        return self.compressors

    def sizes(self, text: bytes) -> list[int]:
        text = folded(text.decode())
        blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
        return [sum(len(compress(block)) for block in blocks) for compress in self.compress()]

    def leaders(self, text: bytes | None, known: Leaders) -> Leaders:
        """The smallest size with its name, and the second smallest, of these languages and the ones
        that led before. Ties go to the first name; a text without a letter has none."""
        if text is None or not has_letter(text):
            return known
        best, name, second = known
        for language, size in zip(self.dictionaries, self.sizes(text), strict=True):
            if best is None or size < best:
                best, name, second = size, language, best
            elif second is None or size < second:
                second = size
        return best, name, second


#: Smallest size, its language, second smallest size; None where there is none.
Leaders = tuple[int | None, str | None, int | None]


def judged(leaders: Leaders) -> tuple[str, float, bool]:
    """Language, score (share of bytes saved against the second best, 0 to 1), and whether the score
    is too narrow."""
    best, name, second = leaders
    if name is None:
        return UNDECIDED, 0.0, True
    if second is None:
        return name, 1.0, False
    score = 1 - best / second
    return name, score, score < MARGIN


class Languages:
    """What was learned: a written table (lang, content), of which the driver holds the names, and one
    block of languages at a time."""

    def __init__(self, contents: DataFrame, size: int):
        self.contents, self.size = contents, size
        self.names = sorted(r["lang"] for r in contents.select("lang").collect())

    def blocks(self) -> Iterator[Classifier]:
        """All languages in order of name, ``LANGUAGES_AT_ONCE`` at a time."""
        for i in range(0, len(self.names), LANGUAGES_AT_ONCE):
            some = self.contents.where(F.col("lang").isin(self.names[i : i + LANGUAGES_AT_ONCE]))
            yield Classifier({r["lang"]: folded(r["content"])[: self.size] for r in some.collect()})


def learn_languages(
    labelled: DataFrame, text: str = "text", language: str = "lang", per_language: int = TEXTS_PER_LANGUAGE, size: int = DICTIONARY_BYTES
) -> Languages:
    """Dictionaries from about ``per_language`` distinct texts of each language, picked by a hash of
    the text, so that a dictionary is made of a bounded sample however many rows there are. Every
    language gets one.

    Rows whose text or language is null, or whose text has no word, teach nothing. Equal shares of
    ``size`` bytes are taken from a language's texts, the larger the fewer there are, from their
    middle on, as beginnings are often shared.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull() & (F.length(F.trim(text)) > 0))
    rows = rows.select(F.col(language).alias("lang"), F.xxhash64(text).alias("mixed"), F.col(text).alias("text"))
    counts = materialize(rows.groupBy("lang").agg(F.approx_count_distinct("mixed", 0.02).alias("n")), "languages")
    limit = (F.least(F.lit(1.0), per_language / F.greatest("n", F.lit(1))) * (1 << 32)).cast("bigint")
    # one row a language
    picked = rows.join(F.broadcast(counts.withColumn("limit", limit)), "lang").where(F.pmod("mixed", F.lit(1 << 32)) < F.col("limit"))
    picked = picked.withColumn("share", F.greatest(F.lit(64), F.floor(size / F.least("n", F.lit(per_language)))).cast("int"))
    snippet = F.expr("substring(text, greatest(1, cast((length(text) - share) / 2 as int)), share)")
    one = picked.groupBy("lang", "mixed").agg(F.min(snippet).alias("snippet"))
    # about per_language short pieces a language
    whole = one.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("mixed", "snippet"))).alias("found"))
    return Languages(materialize(whole.select("lang", F.concat_ws(" ", "found.snippet").alias("content")), "dictionaries"), size)


def identify_languages(docs: DataFrame, languages: Languages, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, best (the language that compresses best), lang ('und' where
    the margin is narrow), score. Of languages that compress a text equally well the first by name
    is best, with score 0.

    A null text, and one without a letter, is 'und' with score 0, as is every text if nothing was
    learned. Texts are read whole, in blocks; repeated rows are judged one by one; an empty table
    gives no rows; other columns are not read. One pass without a shuffle; dictionaries are broadcast
    ``LANGUAGES_AT_ONCE`` together, and a task holds those of one such block at a time, carrying the
    leaders of its rows from block to block.
    """
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("binary").alias("_text"))
    shared = [docs.sparkSession.sparkContext.broadcast(block) for block in languages.blocks()]

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaders: list[Leaders] = [(None, None, None)] * batch.num_rows
            for block in shared:
                judge = block.value.leaders
                leaders = [judge(t.as_py(), known) for t, known in zip(batch.column(1), leaders, strict=True)]
                if len(shared) > 1:
                    # the worker would keep every block that it has read; an encrypted one has no file to read again
                    block.value.compressors = None
                    if getattr(block, "_path", None) is not None:
                        vars(block).pop("_value", None)
            found = [judged(known) for known in leaders]
            best, score, narrow = map(list, zip(*found, strict=True)) if found else ([], [], [])
            lang = [UNDECIDED if n else b for b, n in zip(best, narrow, strict=True)]
            columns = [batch.column(0), pa.array(best, pa.string()), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "best", "lang", "score"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(classify, f"_id {kind}, best string, lang string, score double").withColumnRenamed("_id", id_column)
