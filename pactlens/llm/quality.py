"""Quality rules: base counts of a text, and its surprise under two models of the corpus.

The first is a modified Kneser-Ney model of byte n-grams up to ``ORDER``, counted by Spark over all
documents, one model per language. A document's language is its ``lang`` if that is a code of two
or three letters, else ``und``. Digits count as one symbol and blanks as one; three start marks stand
before a text. A text's bytes are scored by the even mixture of its language's model and of one over
all languages, so that a passage in another language is not taken for noise.

The second is a model of words (ASCII letters in lower case, digits as one) that junk does not teach:
only documents count in it that pass the base rule and have at most one symbol to ``WORDS_A_SYMBOL``
words, and a document's own words are taken off before it is scored. A word left with n of the N
counted has the surprise -ln((n + 0.5) / N).

No entry of either model is dropped or shares its place: a byte n-gram's key holds its language and
all its bytes, a word's key is a 64-bit hash. The most frequent entries, ``SLOTS`` of each model at
most, are sent to the executors as sorted hash arrays. What a text asks of the others is written with
its scores and joined by Spark; every key of that join is rarer than those that were sent.

A document is rejected if the mean surprise of its bytes is above or below its language's band:
median plus ``ABOVE`` or minus ``BELOW`` deviations (1.4826 times the median absolute deviation,
``LEAST_DEVIATION`` at least), or that of its words above ``ABOVE_WORDS`` of their deviations
(``LEAST_WORD_DEVIATION`` at least), all over the documents of the language that pass the base rule,
read from exact counts of values in steps of ``STEP``. Means of short texts vary more, so the band of
a text of n words is wider by the factor sqrt(1 + ``WIDER_BELOW_WORDS`` / n).

Rows: null text is empty and fails the base rule; a null doc_id or lang is allowed; repeated rows
are judged alike; an empty table gives an empty result; other columns are kept or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pactlens.llm import common as c

ORDER = 4
SLOTS = 2_000_000  # entries of a model that are sent to the executors; the others are joined
ABOVE, BELOW = 6.0, 8.0
ABOVE_WORDS = 4.0
WORDS_A_SYMBOL = 10
WIDER_BELOW_WORDS = 60
LEAST_DEVIATION, LEAST_WORD_DEVIATION = 0.02, 0.1
STEP = 0.005
PENDING = 1_000_000

EVERY = "*"  # stands for all languages together
LANGUAGE = "CASE WHEN lower(lang) RLIKE '^[a-z]{2,3}$' THEN lower(lang) ELSE 'und' END"

# ---- base counts ----

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: has an equal key anywhere; has an equal key before it."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later


def base_counts(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns of ``BASE`` for each document."""
    n = len(offsets) - 1
    starts, ends, n_words = c.word_spans(raw, offsets)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)))
    word_at = np.concatenate(([0], np.cumsum(n_words)))
    chars = np.concatenate(([0], np.cumsum(points[ends] - points[starts])))
    word_chars = chars[word_at[1:]] - chars[word_at[:-1]]
    n_symbols = _per_document(_SYMBOL[raw], offsets)

    seeds = c.mix(np.arange(1, n + 1, dtype=np.uint64))
    n_repeat = np.zeros(n, np.int64)
    if len(starts) >= 5:
        doc = np.repeat(np.arange(n), n_words)
        grams = c.gram_hashes(c.span_hashes(raw, starts, ends), 5)
        own = np.flatnonzero(doc[:-4] == doc[4:])
        found, _ = _repeated(grams[own] ^ seeds[doc[own]])
        marks = np.zeros(len(starts) + 1, np.int64)
        np.add.at(marks, own[found], 1)
        np.add.at(marks, own[found] + 5, -1)
        n_repeat = np.bincount(doc[np.cumsum(marks[:-1]) > 0], minlength=n)

    breaks = np.flatnonzero(raw == 10)
    heads = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    heads = heads[heads < len(raw)]
    tails = np.append(heads[1:], len(raw))
    # a line ends before its break; a document's last line ends with the document
    closed = raw[tails - 1] == 10 if len(tails) else np.zeros(0, bool)
    line_doc = np.searchsorted(offsets, heads, "right") - 1
    worded = np.searchsorted(starts, tails) > np.searchsorted(starts, heads)
    heads, tails, line_doc = heads[worded], (tails - closed)[worded], line_doc[worded]
    _, again = _repeated(c.span_hashes(raw, heads, tails) ^ seeds[line_doc])
    n_dup = np.bincount(line_doc[again], minlength=n)
    return [n_words, word_chars, n_symbols, n_dup, n_repeat]


# ---- n-grams ----

_SYMBOLS = np.arange(256, dtype=np.uint8)
_SYMBOLS[48:58] = 48
_SYMBOLS[[9, 10, 11, 12, 13]] = 32
_START = 2


def _grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last ``ORDER`` symbols at every byte, packed into 32 bits, and offsets into them."""
    n = len(offsets) - 1
    pad = ORDER - 1
    padded = np.full(len(raw) + pad * n, _START, np.uint8)
    own = np.ones(len(padded), bool)
    marks = offsets[:-1] + pad * np.arange(n)
    for i in range(pad):
        own[marks + i] = False
    padded[own] = _SYMBOLS[raw]
    wide = padded.astype(np.uint32)
    packed = wide[pad:].copy() if len(wide) > pad else np.zeros(0, np.uint32)
    for i in range(1, ORDER):
        packed |= wide[pad - i : len(wide) - i] << np.uint32(8 * i)
    return packed[own[pad:]], offsets


@c.returning
def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, gram, n): the counts of a task, combined as they grow."""
    waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([p[1] for p in parts])[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[heads], np.add.reduceat(counts, heads)

    def out() -> Iterator[pa.RecordBatch]:
        for language, parts in waiting.items():
            keys, counts = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts, pa.int64())],
                names=["language", "gram", "n"],
            )

    for batch in batches:
        raw, offsets = c.buffers(batch.column("text"))
        languages = np.array(batch.column("language").to_pylist(), object)
        for i, j, part, at in c.slices(raw, offsets):
            grams, bounds = _grams(part, at)
            owner = np.repeat(np.arange(j - i), np.diff(bounds))
            for language in set(languages[i:j]):
                mine = languages[i:j] == language
                own = np.sort(grams if mine.all() else grams[mine[owner]])
                if len(own):
                    heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                    counts = np.diff(np.append(heads, len(own)))
                    waiting.setdefault(language, []).append((own[heads], counts))
                    size += len(heads)
            if size > PENDING:
                waiting = {k: [merged(v)] for k, v in waiting.items()}
                size = sum(len(v[0][0]) for v in waiting.values())
                if size > PENDING // 2:
                    yield from out()
                    waiting, size = {}, 0
    yield from out()


#: Key of a gram in a language of at most four letters: all of both, so no two share one.
GRAM_KEY = "shiftleft(cast(conv(hex(language), 16, 10) AS bigint), 32) | gram"


def _code(language: str) -> int:
    return int.from_bytes(language.encode(), "big") << 32


def _discounts(counted: DataFrame) -> DataFrame:
    """Discounts of counts 1, 2 and 3 or more, per language."""
    n = counted.groupBy("language").agg(
        *[F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    )
    return n.selectExpr(
        "language",
        "CASE WHEN n1 > 0 AND n2 > 0 THEN n1 / (n1 + 2 * n2) ELSE 0.5D END AS y",
        "n1", "n2", "n3", "n4",
    ).selectExpr(
        "language",
        "CASE WHEN n1 > 0 THEN greatest(0.1D, 1 - 2 * y * n2 / n1) ELSE 0.5D END AS d1",
        "CASE WHEN n2 > 0 THEN greatest(0.1D, 2 - 3 * y * n3 / n2) ELSE 1D END AS d2",
        "CASE WHEN n3 > 0 THEN greatest(0.1D, 3 - 4 * y * n4 / n3) ELSE 1.5D END AS d3",
    )


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(language, gram, n, p) of the highest order from (language, gram, n).

    Lower orders count the different symbols before an n-gram. Probabilities are interpolated. What is
    scored has been counted, so back-off weights of unseen n-grams are not asked for.
    """
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        levels.append(
            levels[-1]
            .groupBy("language", (F.col("gram").bitwiseAND((1 << 8 * order) - 1)).alias("gram"))
            .agg(F.count("*").alias("n"))
        )
    lower: DataFrame | None = None
    for order, level in zip(range(1, ORDER + 1), reversed(levels), strict=True):
        level = level.join(F.broadcast(_discounts(level)), "language").selectExpr(
            "language", "gram", "shiftright(gram, 8) AS context", "n",
            "CASE WHEN n = 1 THEN d1 WHEN n = 2 THEN d2 ELSE d3 END AS taken",
        )
        contexts = level.groupBy("language", "context").agg(
            F.sum("n").alias("total"), (F.sum("taken") / F.sum("n")).alias("left_over")
        )
        level = level.join(contexts, ["language", "context"])
        if lower is None:
            level = level.withColumn("low_p", F.lit(1 / 256))
        else:
            tail = F.col("gram").bitwiseAND((1 << 8 * (order - 1)) - 1)
            below = lower.select("language", F.col("gram").alias("tail"), F.col("p").alias("low_p"))
            level = level.withColumn("tail", tail).join(below, ["language", "tail"])
        lower = c.kept_table(
            level.selectExpr(
                "language", "gram", "n", "(n - taken) / total + left_over * low_p AS p"
            ),
            f"order-{order}",
        )
    return lower


# ---- words ----

_WORD_SYMBOLS = c.ascii_lower(_SYMBOLS)


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key and document of every word."""
    starts, ends, n_words = c.word_spans(raw, offsets)
    keys = c.span_hashes(_WORD_SYMBOLS[raw], starts, ends)
    return c.signed(keys), np.repeat(np.arange(len(n_words)), n_words)


def _teaches(counts: list[np.ndarray]) -> np.ndarray:
    """Whether documents with these base counts count in the model of words."""
    n_words, _, n_symbols, _, n_repeat = counts
    return (n_words >= 10) & (100 * n_repeat <= 20 * n_words) & (WORDS_A_SYMBOL * n_symbols <= n_words)


def _summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys with the sums of their columns."""
    if not len(keys):
        return keys, *columns
    order = np.argsort(keys, kind="stable")
    heads = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    return keys[order][heads], *[np.add.reduceat(x[order], heads) for x in columns]


@c.returning
def _count_word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, seen, n): how often a task saw each word, and how often in documents that teach."""
    parts: list[tuple[np.ndarray, ...]] = []
    size = 0

    def merged() -> tuple[np.ndarray, ...]:
        return _summed(*[np.concatenate(x) for x in zip(*parts, strict=True)])

    def out() -> Iterator[pa.RecordBatch]:
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in merged()], names=["key", "seen", "n"])

    for batch in batches:
        raw, offsets = c.buffers(batch.column("text"))
        for _, _, part, at in c.slices(raw, offsets):
            keys, doc = _words(part, at)
            taught = _teaches(base_counts(part, at))[doc].astype(np.int64)
            parts.append(_summed(keys, np.ones(len(keys), np.int64), taught))
            size += len(parts[-1][0])
            if size > PENDING:
                parts = [merged()]
                size = len(parts[0][0])
                if size > PENDING // 2:
                    yield from out()
                    parts, size = [], 0
    yield from out()


# ---- models ----


class HashArrays:
    """Sorted hashes of all 64 bits with their values; a directory of leading bits makes a search short."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        mixed = c.mix(keys.astype(np.int64).view(np.uint64))  # one to one
        order = np.argsort(mixed)
        self.n = len(keys)
        self.keys = np.append(mixed[order], np.uint64(2**64 - 1))
        self.values = np.append(values[order], values.dtype.type(0))
        bits = max(8, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        heads = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.directory = np.searchsorted(self.keys, heads).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys, 0 where there is none, and whether there is one."""
        asked = c.mix(keys.astype(np.int64).view(np.uint64))
        at = self.directory[asked >> self.shift]
        later = np.flatnonzero(self.keys[at] < asked)
        while len(later):
            at[later] += 1
            later = later[self.keys[at[later]] < asked[later]]
        there = (self.keys[at] == asked) & (at < self.n)
        return np.where(there, self.values[at], self.values.dtype.type(0)), there


@dataclass(frozen=True)
class Model:
    """Entries (key, seen, value); those seen ``least`` times or more, at most ``SLOTS``, are sent."""

    entries: DataFrame
    least: int

    def sent(self) -> HashArrays:
        """Sorted once, here, so that a worker holds one copy and no more."""
        found = self.entries.where(F.col("seen") >= self.least).select("key", "value").toArrow()
        return HashArrays(found.column("key").to_numpy(), found.column("value").to_numpy())


def _model(entries: DataFrame) -> Model:
    powers = [1 << i for i in range(62)]
    sizes = entries.agg(*[F.count(F.expr(f"CASE WHEN seen >= {x}L THEN 1 END")) for x in powers]).first()
    return Model(entries, next(x for x, n in zip(powers, sizes, strict=True) if n <= SLOTS))


def train(docs: DataFrame) -> tuple[Model, Model, int]:
    """Models of byte n-grams (value: surprise) and words (value: how often in documents that teach),
    written to the shared folder, and the number of words in documents that teach."""
    texts = c.pick(docs, "text", "lang").where("text IS NOT NULL")
    counts = c.kept_table(
        texts.selectExpr("text", f"{LANGUAGE} AS language")
        .mapInArrow(_count_batches, "language string, gram long, n long")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n")),
        "gram-counts",
    )
    every = counts.groupBy(F.lit(EVERY).alias("language"), "gram").agg(F.sum("n").alias("n"))
    found = kneser_ney(counts.unionByName(every))
    grams = c.kept_table(
        found.where(F.col("language") != EVERY)
        .join(found.where(F.col("language") == EVERY).selectExpr("gram", "p AS every_p"), "gram")
        .selectExpr(f"{GRAM_KEY} AS key", "n AS seen", "-ln((p + every_p) / 2) AS value"),
        "gram-model",
    )
    words = c.kept_table(
        texts.select("text")
        .mapInArrow(_count_word_batches, "key long, seen long, n long")
        .groupBy("key")
        .agg(F.sum("seen").alias("seen"), F.sum("n").alias("value")),
        "word-model",
    )
    total = words.agg(F.coalesce(F.sum("value"), F.lit(0))).first()[0]
    return _model(grams), _model(words), max(1, total)


# ---- verdicts ----

_ASKED = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("own", T.LongType())]))
_MEASURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in [*BASE, "n_bytes", "taught"]]
    + [T.StructField(n, T.DoubleType()) for n in ("grams", "words")]
    + [T.StructField(n, _ASKED) for n in ("other_grams", "other_words")]
)


def _own(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys of each document, their documents in order, and how often they stand there."""
    if not len(keys):
        return keys, doc, np.zeros(0, np.int64)
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])))
    return keys[heads], doc[heads], np.diff(np.append(heads, len(keys)))


def _asked(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> pa.Array:
    keys, doc, own = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 3
    values = pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(own, pa.int64())], names=["key", "own"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()), values)


def measures(spark, grams: Model, words: Model, total: int, text: str, language: str):
    """Column with the base counts and the summed surprise of bytes and words, as far as their entries
    were sent, and what is asked of the others."""
    arrays = spark.sparkContext.broadcast((grams.sent(), words.sent()))
    c.give_back()  # what collecting and sorting has left on the driver

    @arrow_udf(_MEASURES)
    def measure(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from scored(batches, *arrays.value)

    @c.returning
    def scored(batches, of_grams: HashArrays, of_words: HashArrays) -> Iterator[pa.Array]:
        for texts, languages in batches:
            yield of_batch(texts, languages, of_grams, of_words)

    def of_batch(texts: pa.Array, languages: pa.Array, of_grams: HashArrays, of_words: HashArrays) -> pa.Array:
        codes = np.array([_code(x) for x in languages.to_pylist()], np.int64)
        raw, offsets = c.buffers(texts)
        parts: list[list[np.ndarray]] = []
        other_grams, other_words = [], []
        for i, j, part, at in c.slices(raw, offsets):
            n, sizes = j - i, np.diff(at)
            counts = base_counts(part, at)
            taught = _teaches(counts).astype(np.int64)
            doc = np.repeat(np.arange(n), sizes)
            keys = _grams(part, at)[0].astype(np.int64) | codes[i:j][doc]
            found, there = of_grams.find(keys)
            gram_sum = np.bincount(doc, found, n)
            left = _own(keys[~there], doc[~there])
            other_grams.append((left[0], left[1] + i, left[2]))
            keys, doc, own = _own(*_words(part, at))
            found, there = of_words.find(keys)
            value = -np.log((found - own * taught[doc] + 0.5) / total, where=there, out=np.zeros(len(keys)))
            word_sum = np.bincount(doc, own * value, n)
            other_words.append((keys[~there], doc[~there] + i, own[~there]))
            parts.append([*counts, sizes, taught, gram_sum, word_sum])
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0)] * 9
        kinds = [pa.int64()] * 7 + [pa.float64()] * 2
        return pa.StructArray.from_arrays(
            [
                *[pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                _asked(other_grams, len(texts)), _asked(other_words, len(texts)),
            ],
            names=_MEASURES.names,
        )

    return measure(F.col(text), F.col(language))


BASE_FAILED = "(m.n_words < 10 OR 100 * m.n_repeat_words > 20 * m.n_words)"
_WIDER = f"sqrt(1 + {WIDER_BELOW_WORDS} / greatest(1, m.n_words))"
IN_BAND = (
    f"(m.surprise - middle) / (deviation * {_WIDER}) BETWEEN -{BELOW} AND {ABOVE}"
    f" AND (m.word_surprise - word_middle) / (word_deviation * {_WIDER}) <= {ABOVE_WORDS}"
)


def _band(scored: DataFrame, value: str, least: float) -> DataFrame:
    steps = (
        scored.where(f"NOT {BASE_FAILED}")
        .groupBy("language", F.expr(f"cast(round(m.{value} / {STEP}) AS long)").alias("step"))
        .agg(F.count("*").alias("n"))
    )
    steps = c.kept_table(steps, f"{value}-steps")
    middle = steps.groupBy("language").agg(F.percentile("step", 0.5, F.col("n")).alias("middle"))
    spread = (
        steps.join(middle, "language")
        .withColumn("away", F.expr("abs(step - middle)"))
        .groupBy("language", "middle")
        .agg(F.percentile("away", 0.5, F.col("n")).alias("away"))
    )
    return spread.selectExpr(
        "language", f"middle * {STEP} AS middle", f"greatest({least}, 1.4826 * away * {STEP}) AS deviation"
    )


def bands(scored: DataFrame) -> DataFrame:
    """(language, middle, deviation, word_middle, word_deviation) from (language, m); counts per step
    are exact, whatever the size."""
    words = _band(scored, "word_surprise", LEAST_WORD_DEVIATION)
    return c.kept_table(
        _band(scored, "surprise", LEAST_DEVIATION).join(
            words.selectExpr("language", "middle AS word_middle", "deviation AS word_deviation"), "language"
        ),
        "bands",
    )


def _judged(rows: DataFrame, *carried: str, wide: bool = False) -> DataFrame:
    """Of rows (text, lang and others): ``carried`` with language, m, base_failed and kept.

    What is asked of entries that were not sent is joined by the numbers of the written rows; ``wide``
    rows stay out of that join, and only the numbers of those rejected are joined to them.
    """
    spark = c.prepared(rows).sparkSession
    grams, words, total = train(rows)
    scored = rows.withColumn("language", F.expr(LANGUAGE))
    scored = scored.withColumn("m", measures(spark, grams, words, total, "text", "language"))
    number = c.unused(rows, "number")
    scored = c.kept_table(
        scored.select(*carried, "language", "m", F.monotonically_increasing_id().alias(number)), "scored"
    )
    apart = wide and max(grams.least, words.least) > 1
    narrow = scored.select(number, "language", "m") if apart else scored
    for model, kind, value in (
        (grams, "grams", "own * value"),
        (words, "words", f"own * -ln((value - own * taught + 0.5D) / {total})"),
    ):
        more = F.lit(0.0)
        if model.least > 1:
            sums = (
                scored.selectExpr(number, "m.taught AS taught", f"inline(m.other_{kind})")
                .join(model.entries.where(F.col("seen") < model.least), "key")
                .groupBy(number)
                .agg(F.sum(F.expr(value)).alias(f"_{kind}"))
            )
            narrow = narrow.join(sums, number, "left")
            more = F.coalesce(f"_{kind}", F.lit(0.0))
        narrow = narrow.withColumn(f"_{kind}", more)
    base = ", ".join(f"'{n}', m.{n}" for n in BASE)
    kept = [number] if apart else [*carried, number]
    narrow = narrow.select(
        *kept, "language",
        F.expr(
            f"named_struct({base}, 'surprise', (m.grams + _grams) / greatest(1, m.n_bytes),"
            " 'word_surprise', (m.words + _words) / greatest(1, m.n_words))"
        ).alias("m"),
    )
    if max(grams.least, words.least) > 1:
        narrow = c.kept_table(narrow, "surprises")
    # at most 26**2 + 26**3 + 1 languages
    judged = narrow.join(F.broadcast(bands(narrow)), "language", "left").selectExpr(
        *kept, "language", "m", f"{BASE_FAILED} AS base_failed",
        f"coalesce(NOT {BASE_FAILED} AND {IN_BAND}, false) AS kept",
    )
    if apart:
        gone = c.kept_table(judged.where("NOT kept").select(number), "rejected")
        return c.drop_rows(scored.select(*carried, number), gone, number).withColumn("kept", F.lit(True))
    return judged


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, language, surprise of its bytes
    and of its words."""
    return _judged(c.pick(docs, "doc_id", "text", "lang"), "doc_id").select(
        "doc_id", *[F.col(f"m.{n}").alias(n) for n in BASE], "base_failed", "kept", "language",
        F.col("m.surprise").alias("surprise"), F.col("m.word_surprise").alias("word_surprise"),
    )


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The scored rows are written once with their texts, as the bands need all scores first.
    """
    names = docs.columns
    place = {n: f"c{i}" for i, n in enumerate(names)}
    rows = docs.toDF(*place.values())
    rows = rows.withColumnRenamed(place["text"], "text").withColumnRenamed(place["lang"], "lang")
    own = [n if n in ("text", "lang") else place[n] for n in names]
    return _judged(rows, *own, wide=True).where("kept").select(*own).toDF(*names)
