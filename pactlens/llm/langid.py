"""Language identification by rank-order profiles of character n-grams.

Text is lower-cased; everything but letters counts as a blank, and each word has one blank on either
side. N-grams of one to three characters that hold no inner blank are counted. A profile lists the
``PROFILE`` most frequent n-grams of a language, counted by Spark over all texts to learn from. The
distance of a document is the sum, over its own ``PROFILE`` most frequent n-grams, of how far each is
out of place in the profile, and ``PROFILE`` for one that is not there. The language with the least
distance is predicted, the first by name of equal ones. The score is 1 minus the distance as a share
of the largest possible one. Equal counts are ranked by code points, so results do not depend on order.

The profiles of up to ``MOST_LANGUAGES`` languages (more is an error) are sent to all tasks: at most
40 MB. Rows: null text or one without letters is ``und`` with score 0; languages are learned from
rows with text and lang; a row without doc_id is not held out; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pactlens.llm import common as c

PROFILE = 300
MOST_LANGUAGES = 8192
UNKNOWN = "und"
PENDING = 1_000_000


def letters_only(text: Column) -> Column:
    """Lower-cased words parted and enclosed by one blank; one blank if there is no letter."""
    return F.concat(
        F.lit(" "),
        F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "),
        F.lit(" "),
    )


def _ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram, count): one-, two- and three-character n-grams one after another, each part
    sorted by document and n-gram. An n-gram's code points take 21 bits each."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    blank = points == 32
    if len(points):  # one blank between words, also where the text began or ended with one
        keep = np.append(True, ~(blank[1:] & blank[:-1] & (doc[1:] == doc[:-1])))
        points, doc, blank = points[keep], doc[keep], blank[keep]
    # the slice's own alphabet in order of code points keeps the numbers to sort small
    alphabet = np.flatnonzero(np.bincount(points)) if len(points) else np.zeros(1, np.int64)
    size = len(alphabet)
    code = np.searchsorted(alphabet, np.arange(alphabet[-1] + 1))[points]
    parts = []
    for order in (1, 2, 3):
        n = len(code) - order + 1
        if n <= 0:
            continue
        gram = code[:n].copy()
        for i in range(1, order):
            gram *= size
            gram += code[i : i + n]
        if order == 1:
            own = ~blank
        else:
            own = doc[:n] == doc[order - 1 :]
            if order == 3:
                own &= ~blank[1:-1]
        keys = doc[:n][own] * size**order + gram[own]
        if len(texts) * size**order < 1 << 32:
            keys = keys.astype(np.uint32)
        keys = np.sort(keys)
        heads = np.flatnonzero(np.append(len(keys) > 0, keys[1:] != keys[:-1]))
        counts = np.diff(np.append(heads, len(keys)))
        owner, rest = np.divmod(keys[heads].astype(np.int64), size**order)
        whole = np.zeros(len(rest), np.int64)
        for i in range(order):
            whole |= alphabet[rest % size] << (21 * i)
            rest //= size
        parts.append((owner, whole, counts))
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _by_rank(doc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Order by document, then falling count, equal ones as they stand."""
    most = int(count.max()) if len(count) else 0
    keys = doc * (most + 1) + (most - count)
    bits = len(keys).bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits < 63:
        return np.sort(keys << bits | np.arange(len(keys))) & ((1 << bits) - 1)
    return np.argsort(keys, kind="stable")


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return keys, np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def out() -> Iterator[pa.RecordBatch]:
        for language, parts in waiting.items():
            keys, counts = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(keys), pa.string()), pa.array(keys), pa.array(counts, pa.int64())],
                names=["lang", "gram", "n"],
            )

    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), object)
        raw, offsets = c.buffers(batch.column("letters"))
        for i, j, part, at in c.slices(raw, offsets):
            texts = _strings(part, at)
            for language in sorted(set(languages[i:j])):
                mine = [t for t, l in zip(texts, languages[i:j], strict=True) if l == language]
                _, keys, counts = _ngrams(["".join(mine)])
                waiting.setdefault(language, []).append((keys, counts))
                size += len(keys)
            if size > PENDING:
                yield from out()
                waiting, size = {}, 0
    yield from out()


def _strings(raw: np.ndarray, offsets: np.ndarray) -> list[str]:
    data, ends = raw.tobytes(), offsets.tolist()
    return [data[a:b].decode() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def learn(docs: DataFrame) -> DataFrame:
    """(lang, gram, rank) of the most frequent n-grams of each language of (text, lang)."""
    counts = (
        docs.where("text IS NOT NULL AND lang IS NOT NULL")
        .select("lang", letters_only(F.col("text")).alias("letters"))
        .mapInArrow(_count_batches, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # Spark keeps the first ranks of every task before it brings a language together
    ranked = counts.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) - 1 AS rank")
    return c.kept_table(ranked.where(f"rank < {PROFILE}").select("lang", "gram", "rank"), "profiles")


class Profiles:
    def __init__(self, languages: list[str], grams: np.ndarray, ranks: np.ndarray, owners: np.ndarray):
        self.languages = languages
        self.tables = []
        for k in range(len(languages)):
            own = owners == k
            order = np.argsort(grams[own])
            self.tables.append((grams[own][order], ranks[own][order].astype(np.int64)))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        doc, gram, count = _ngrams(texts)
        order = _by_rank(doc, count)
        doc, gram = doc[order], gram[order]
        sizes = np.bincount(doc, minlength=n)
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        top = rank < PROFILE
        doc, gram, rank = doc[top], gram[top], rank[top]
        used = np.minimum(sizes, PROFILE)
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.zeros(n, np.int64)
        for k, (grams, ranks) in enumerate(self.tables):
            at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
            away = np.where(grams[at] == gram, np.abs(ranks[at] - rank), PROFILE)
            distance = np.bincount(doc, away, minlength=n).astype(np.int64)
            closer = distance < best
            best[closer], found[closer] = distance[closer], k
        known = (used > 0) & (len(self.tables) > 0)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(found, known, strict=True)]
        score = np.where(known, 1 - best / np.maximum(1, used * PROFILE), 0.0)
        return names, np.clip(score, 0.0, 1.0)


_PREDICTION = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)
_loaded: dict = {}


def predict(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """``docs`` (with text) and a struct ``found`` of lang_pred and score."""
    languages = [r[0] for r in profiles.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    rows = profiles.toArrow()
    place = {name: k for k, name in enumerate(languages)}
    sent = docs.sparkSession.sparkContext.broadcast(
        (
            languages,
            rows.column("gram").to_numpy(),
            rows.column("rank").to_numpy(),
            np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64),
        )
    )

    @arrow_udf(_PREDICTION)
    def nearest(letters: pa.Array) -> pa.Array:
        if _loaded.get("of") is not sent.value:
            _loaded.update({"of": sent.value, "profiles": Profiles(*sent.value)})
        raw, offsets = c.buffers(letters)
        names: list[str] = []
        scores = [np.zeros(0)]
        for _, _, part, at in c.slices(raw, offsets):
            found, score = _loaded["profiles"].predict(_strings(part, at))
            names += found
            scores.append(score)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate(scores))], names=["lang_pred", "score"]
        )

    return docs.withColumn("found", nearest(letters_only(F.col("text"))))


HELD_OUT = "coalesce(crc32(cast(doc_id AS string)) % 4 = 2, false)"


def predicted_languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learned from rows not held out."""
    rows = c.prepared(c.pick(docs, "doc_id", "text", "lang"))
    profiles = learn(rows.where(f"NOT {HELD_OUT}"))
    return predict(rows.select("doc_id", "text"), profiles).select(
        "doc_id", F.expr(HELD_OUT).alias("held_out"), "found.lang_pred", "found.score"
    )
