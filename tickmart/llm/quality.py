"""Quality rules: text statistics, and decision lists learned from labelled ones."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS_PER_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
#: Labelled rows that a list is learned from at most; more are thinned by a hash of their text.
MAX_LABELLED = 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRAS = ("n_lines", "n_distinct_words", "n_upper", "n_digits", "n_ends", "longest_word")
STATS = (*COUNTS, *EXTRAS)


def repeated_words(words: list[bytes], size: int = WORDS_PER_WINDOW) -> int:
    """Words inside windows of ``size`` words that occur twice or more, the first included."""
    windows = list(zip(*(words[i:] for i in range(size)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if seen[window] > 1:
            covered += start + size - max(start, end)
            end = start + size
    return covered


UPPER, DIGITS, ENDS, SPACE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".!?", b" \t\n\x0b\x0c\r"
CONTINUED = bytes(range(0x80, 0xC0))


def text_stats(text: bytes | None) -> tuple[int, ...]:
    """STATS of a text in UTF-8; a null text counts as empty. A word is a run of bytes other than
    ASCII white space."""
    text = text or b""
    words, size = text.split(), len(text)
    without = lambda drop: size - len(text.translate(None, drop))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        size - without(SPACE + CONTINUED),
        without(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        without(UPPER),
        without(DIGITS),
        without(ENDS),
        max(map(len, words), default=0),
    )


def stats_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds STATS for the last column, the text as binary, in the text's place."""
    for batch in batches:
        rows = [text_stats(text.as_py()) for text in batch.column(batch.num_columns - 1)]
        counts = list(zip(*rows, strict=True)) or [()] * len(STATS)
        columns = [*batch.columns[:-1], *(pa.array(c, pa.int64()) for c in counts)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *STATS])


def _stats_struct(text: Column) -> Column:
    """STATS as one struct. Not deterministic to Spark, so that it is computed once a row."""

    def stats(texts: pa.Array) -> pa.Array:
        rows = [text_stats(t.as_py()) for t in texts]
        counts = list(zip(*rows, strict=True)) or [()] * len(STATS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in counts], list(STATS))

    return F.arrow_udf(stats, "struct<" + ",".join(f"{s}:bigint" for s in STATS) + ">").asNondeterministic()(text)


def document_stats(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns ``keep`` and STATS of every row; a null text has no words."""
    rows = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), *(f"{s} bigint" for s in STATS)])
    return rows.mapInArrow(stats_of, schema)


# Measures that rules compare with thresholds: shares and lengths, which long texts do not outgrow.
MEASURES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "mean_word": lambda s: s("word_chars") / F.greatest(s("n_words"), F.lit(1)),
    "symbol_share": lambda s: s("n_symbols") / F.greatest(s("word_chars"), F.lit(1)),
    "dup_line_share": lambda s: s("n_dup_lines") / F.greatest(s("n_lines"), F.lit(1)),
    "repeat_share": lambda s: s("n_repeat_words") / F.greatest(s("n_words"), F.lit(1)),
    "distinct_share": lambda s: s("n_distinct_words") / F.greatest(s("n_words"), F.lit(1)),
    "upper_share": lambda s: s("n_upper") / F.greatest(s("word_chars"), F.lit(1)),
    "digit_share": lambda s: s("n_digits") / F.greatest(s("word_chars"), F.lit(1)),
    "ends_share": lambda s: s("n_ends") / F.greatest(s("n_words"), F.lit(1)),
    "words": lambda s: s("n_words").cast("double"),
    "longest_word": lambda s: s("longest_word").cast("double"),
}


def measures(stats: DataFrame) -> list[Column]:
    return [make(F.col).cast("double").alias(name) for name, make in MEASURES.items()]


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a text that fulfils all conditions of one is rejected by it."""

    rules: tuple[tuple[Condition, ...], ...]

    def reason(self) -> Column:
        """The number of the first rule that rejects, as one ordered conditional expression over
        the columns of STATS; null where none does."""
        ordered = F
        for number, rule in enumerate(self.rules):
            holds = F.lit(True)
            for c in rule:
                measure = MEASURES[c.measure](F.col)
                holds = holds & (measure > c.threshold if c.above else measure <= c.threshold)
            ordered = ordered.when(holds, F.lit(number))
        return F.lit(None).cast("int") if not self.rules else ordered.otherwise(F.lit(None).cast("int"))

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, rule))}" for rule in self.rules) or "reject none"


def holds(rule: tuple[tuple[int, bool, float], ...], x: np.ndarray) -> np.ndarray:
    at = np.ones(len(x), bool)
    for column, above, threshold in rule:
        at &= (x[:, column] > threshold) == above
    return at


def best_condition(x: np.ndarray, bad: np.ndarray) -> tuple[float, tuple[int, bool, float] | None]:
    """The condition of the largest FOIL gain on these rows."""
    n_bad, n = int(bad.sum()), len(bad)
    before = np.log2(n_bad / n)
    best, choice = 1e-9, None
    for column in range(x.shape[1]):
        order = np.argsort(x[:, column], kind="stable")
        values, hits = x[order, column], np.cumsum(bad[order])
        cuts = np.flatnonzero(values[1:] > values[:-1])
        if not len(cuts):
            continue
        for above in (False, True):
            p = n_bad - hits[cuts] if above else hits[cuts]
            total = n - cuts - 1 if above else cuts + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / total) - before), 0)
            k = int(np.argmax(gain))
            if gain[k] > best:
                middle = (values[cuts[k]] + values[cuts[k] + 1]) / 2
                # two neighbours may have no number between them
                best, choice = float(gain[k]), (column, above, float(middle if middle < values[cuts[k] + 1] else values[cuts[k]]))
    return best, choice


def learn_rules(x: np.ndarray, bad: np.ndarray, precision: float = 0.97, min_cover: int = 8, most_rules: int = 24, most_conditions: int = 4) -> list:
    """Sequential covering. Two thirds of the rows grow a rule condition by condition, the others
    prune it from its end; a rule of enough ``precision`` and cover is kept, the rows it covers
    leave, and the next is learned on the rest."""
    rules, left = [], np.ones(len(bad), bool)
    held = np.arange(len(bad)) % 3 == 2
    while len(rules) < most_rules and (bad & left).sum() >= min_cover:
        grow = np.flatnonzero(left & ~held)
        rule, at = [], grow
        while len(rule) < most_conditions and 0 < bad[at].sum() < len(at):
            _, choice = best_condition(x[at], bad[at])
            if choice is None:
                break
            rule.append(choice)
            at = at[holds((choice,), x[at])]
        prune = np.flatnonzero(left & held)

        def worth(conditions: list) -> float:
            on = holds(tuple(conditions), x[prune])
            p, n = int((on & bad[prune]).sum()), int((on & ~bad[prune]).sum())
            return (p - n) / (p + n) if p + n else -1.0

        kept = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: (worth(r), len(r) == len(rule)), default=[])
        if not kept:
            break
        on = holds(tuple(kept), x) & left
        if on.sum() < min_cover or bad[on].mean() < precision:
            break
        rules.append(tuple(kept))
        left &= ~on
    return rules


def learn_quality(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_column: str = "doc_id", text: str = "text", label: str = "quality"
) -> DecisionList:
    """A decision list for ``label`` = 0, from the statistics of labelled documents.

    Of more than ``max_labelled`` labelled ids a hash picks about that many, so the broadcast and
    what the driver learns from are bounded. An id whose labels contradict one another teaches
    nothing, nor does a null; of several documents of one id one teaches. Without both kinds of
    label the list is empty and rejects none."""
    agreed = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("_id"))
    agreed = agreed.agg(F.min(label).alias("_low"), F.max(label).alias("_high")).where("_low = _high")
    share = min(1.0, max_labelled / max(agreed.count(), 1))
    picked = agreed.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 32)) < F.lit(int(share * (1 << 32)))).select("_id", F.col("_low").alias("_label"))
    sample = docs.select(F.col(id_column).alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
    stats = document_stats(sample, [F.col("_id"), F.col("_label")], "_text")
    one = stats.groupBy("_id", "_label").agg(F.min(F.struct(*measures(stats))).alias("m"))
    rows = one.select("_id", "_label", "m.*").toPandas().sort_values("_id").sample(frac=1, random_state=1)
    bad = (rows["_label"] == 0).to_numpy()
    x = rows[list(MEASURES)].to_numpy(float)
    names = list(MEASURES)
    found = learn_rules(x, bad) if 0 < bad.sum() < len(bad) else []
    return DecisionList(tuple(tuple(Condition(names[c], above, t) for c, above, t in rule) for rule in found))


def base_failed() -> Column:
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge_quality(docs: DataFrame, rules: DecisionList, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, STATS, base_failed, kept, reason (number of the rule, -1
    for the base rules, null if kept).

    A null text counts as empty and fails the base rules, as do all texts under ten words; repeated
    rows are judged one by one; an empty table gives no rows. Other columns are not read, so any
    names may occur there. Texts are read whole; the work is one pass without a shuffle.
    """
    rows = document_stats(docs, [F.col(id_column)], text).withColumn("base_failed", base_failed())
    reason = F.when(F.col("base_failed"), F.lit(-1)).otherwise(rules.reason())
    return rows.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull())


def keep_good(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, with their own columns, whatever their
    names."""
    whole = docs.select(F.struct(F.col("*")).alias("_row"), _stats_struct(F.col(text).cast("binary")).alias("_stats"))
    rows = whole.select("_row", "_stats.*")
    return rows.where(~base_failed() & rules.reason().isNull()).select("_row.*")
