"""Removal of passages that an earlier document has too, by suffix automata over reference shards.

A window is ``WINDOW`` neighbouring words; a window is removed from a document if a document with a
smaller doc_id has it as well. The steps:

1. Each window picks one run of ``GRAM`` words inside it, the one with the smallest hash. Equal
   windows pick the same, so documents that share a window share that anchor. Only hashes and
   places are shuffled to find anchors of several documents and the first document of each, its
   leader.
2. Windows around shared anchors are cut from the texts as passages and sent to the reference
   shard of the leader's piece. A shard is a bounded number of windows. A shard that a leader with
   very many followers makes larger is dealt to several slices, and the leaders' own passages are
   sent to each of them.
3. A task streams its shard's passages in order of doc_id through a suffix automaton of words. The
   matching statistics (the longest match that ends at a word) tell which windows earlier documents
   have; windows that none has are added to the automaton. So it holds each passage once.
4. Between the slices of a large shard, windows still unmatched are compared by a 128-bit hash.
5. The removed spans go back to the documents. Spans and hits grow with the corpus, so these joins
   are sorted merges at every size and never broadcasts.

Words are compared as bytes. Rows: a null doc_id is neither trimmed nor a reference; rows that repeat
a doc_id do not trim one another; null text has no words; other columns are ignored or kept as is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pactlens.llm import common as c

WINDOW, GRAM = 50, 16
PIECE_WINDOWS = 20_000
SHARD_WINDOWS = 60_000
SLICE_WINDOWS = 240_000


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value of every ``width`` neighbours, the last of equal ones."""
    best, at, span = values, np.arange(len(values)), 1

    def narrower(step: int):
        later = best[step:] <= best[:-step]
        return (
            np.where(later, best[step:], best[:-step]),
            np.where(later, at[step:], at[:-step]),
        )

    while 2 * span <= width:
        best, at = narrower(span)
        span *= 2
    if span < width:
        best, at = narrower(width - span)
    return at


def anchors_of(raw: np.ndarray, offsets: np.ndarray):
    """(document, anchor hash, first window, number of windows) of every run of windows."""
    starts, ends, counts = c.word_spans(raw, offsets)
    none = np.zeros(0, np.int64)
    if len(starts) < WINDOW:
        return none, none.astype(np.uint64), none, none
    grams = c.gram_hashes(c.span_hashes(raw, starts, ends), GRAM)
    picked = _smallest(grams, WINDOW - GRAM + 1)
    doc = np.repeat(np.arange(len(counts)), counts)
    first_word = np.repeat(np.cumsum(counts) - counts, counts)
    inside = np.flatnonzero(doc[: len(picked)] == doc[WINDOW - 1 :])
    if not len(inside):
        return none, none.astype(np.uint64), none, none
    doc, picked, place = doc[inside], picked[inside], inside - first_word[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (picked[1:] != picked[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    return doc[heads], grams[picked[heads]], place[heads], np.diff(np.append(heads, len(inside)))


@c.returning
def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, tags = batch.column("doc_id"), batch.column("tag")
        raw, offsets = c.buffers(batch.column("text"))
        for i, _, part, at in c.slices(raw, offsets):
            doc, anchor, first, n = anchors_of(part, at)
            rows = pa.array(doc + i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c.signed(anchor)), ids.take(rows), tags.take(rows),
                    pa.array(first, pa.int32()), pa.array(n, pa.int32()),
                ],
                names=["anchor", "doc_id", "tag", "first", "n"],
            )


@c.returning
def _passage_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "part", "doc_id", "tag", "start", "leads", "split", "words"]

    def flush():
        return pa.RecordBatch.from_arrays(
            [
                pa.array(x, t)
                for x, t in zip(
                    columns,
                    [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()],
                    strict=True,
                )
            ],
            names=names,
        )

    columns: list[list] = [[] for _ in names]
    size = 0
    for batch in batches:
        ids, tags = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
        texts = batch.column("text")
        lists = batch.column("hits")
        for k, doc_id in enumerate(ids):
            words = texts[k].as_py().encode().split()
            runs: dict[tuple, list[list[int]]] = {}
            for hit in sorted(lists[k].as_py(), key=lambda h: h["first"]):
                key = (hit["shard"], hit["parts"], hit["leads"])
                own = runs.setdefault(key, [])
                if own and hit["first"] <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], hit["first"] + hit["n"])
                else:
                    own.append([hit["first"], hit["first"] + hit["n"]])
            for (shard, parts, leads), spans in runs.items():
                targets = range(parts) if leads else [hash(doc_id) % parts]
                for a, b in spans:
                    passage = b" ".join(words[a : b + WINDOW - 1])
                    for part in targets:
                        row = (shard, part, doc_id, tags[k], a, leads, parts > 1, passage)
                        for column, value in zip(columns, row, strict=True):
                            column.append(value)
                        size += len(passage)
                        if size > 4 * c.SLICE_BYTES:
                            yield flush()
                            columns, size = [[] for _ in names], 0
    yield flush()


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self) -> None:
        self.go: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, go: dict, link: int, length: int) -> int:
        self.go.append(go)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        """The state for the strings of ``q`` that are one word longer than those of ``p``."""
        twin = self._state(dict(self.go[q]), self.link[q], self.length[p] + 1)
        self.link[q] = twin
        while p >= 0 and self.go[p].get(word) == q:
            self.go[p][word] = twin
            p = self.link[p]
        return twin

    def add(self, words: list[bytes]) -> None:
        go, link, length = self.go, self.link, self.length
        last = 0
        for word in words:
            q = go[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, q, word)
                continue
            new, p = self._state({}, 0, length[last] + 1), last
            while p >= 0 and (q := go[p].get(word)) is None:
                go[p][word] = new
                p = link[p]
            if p >= 0:
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, word)
            last = new

    def matches(self, words: list[bytes]) -> list[int]:
        """For each word, how many words up to it the longest match that ends there has."""
        go, link, length = self.go, self.link, self.length
        out, state, size = [], 0, 0
        for word in words:
            there = go[state].get(word)
            while there is None and state:
                state = link[state]
                size = length[state]
                there = go[state].get(word)
            if there is not None:
                state = there
                size += 1
            out.append(size)
        return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


_COVER = ["doc_id", "tag", "first", "n", "print_a", "print_b"]


@c.returning
def _shard_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages arrive by shard and slice in order of doc_id; the automaton holds earlier documents."""
    shard, current, automaton, waiting = None, None, Automaton(), []
    for batch in batches:
        out: list[list] = [[] for _ in _COVER]
        columns = [batch.column(n).to_pylist() for n in ("shard", "part", "doc_id", "tag", "start", "leads", "split")]
        texts = batch.column("words")
        for k, (shard_id, part, doc_id, tag, start, leads, split) in enumerate(zip(*columns, strict=True)):
            if shard != (shard_id, part):
                shard, current, automaton, waiting = (shard_id, part), doc_id, Automaton(), []
            elif current != doc_id:
                for sequence in waiting:
                    automaton.add(sequence)
                current, waiting = doc_id, []
            words = texts[k].as_py().split()
            found = np.array(automaton.matches(words)[WINDOW - 1 :]) >= WINDOW
            for a, b in _runs(found):
                for column, value in zip(out, (doc_id, tag, start + a, b - a, None, None), strict=True):
                    column.append(value)
            for a, b in _runs(~found):
                waiting.append(words[a : b + WINDOW - 1])
                if split and not leads:
                    for i in range(a, b):
                        digest = hashlib.blake2b(b" ".join(words[i : i + WINDOW]), digest_size=16).digest()
                        values = (
                            doc_id, tag, start + i, 0,
                            int.from_bytes(digest[:8], "little", signed=True),
                            int.from_bytes(digest[8:], "little", signed=True),
                        )
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=_COVER
        )


def covered_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, spans): runs (first window, number) of windows that an earlier document has."""
    spark = docs.sparkSession
    texts = c.prepared(c.pick(docs, "doc_id", "text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = texts.select("doc_id", "text", _tag())
    anchors = c.kept_table(
        texts.mapInArrow(_anchor_batches, "anchor long, doc_id long, tag int, first int, n int"), "anchors"
    )
    shared = c.kept_table(
        anchors.groupBy("anchor")
        .agg(F.min(F.struct("doc_id", "first")).alias("lead"), F.max("doc_id").alias("last"))
        .where("lead.doc_id < last")
        .select(
            "anchor",
            F.col("lead.doc_id").alias("lead"),
            F.expr(f"xxhash64(lead.doc_id, lead.first div {PIECE_WINDOWS})").alias("piece"),
        ),
        "shared-anchors",
    )
    hits = c.kept_table(
        anchors.join(shared, "anchor").select(
            "doc_id", "tag", "first", "n", "piece", F.expr("doc_id = lead").alias("leads")
        ),
        "anchor-hits",
    )
    total = hits.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WINDOWS))
    hits = hits.withColumn("shard", F.expr(f"pmod(piece, {shards}L)"))
    sizes = hits.groupBy("shard").agg(
        F.expr(f"cast(ceil(sum(n) / {SLICE_WINDOWS}) AS int)").alias("parts")
    )
    sizes = c.kept_table(sizes, "shards")
    per_document = (
        hits.join(sizes, "shard")
        .groupBy("doc_id", "tag")
        .agg(F.collect_list(F.struct("shard", "parts", "leads", "first", "n")).alias("hits"))
    )
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    passages = texts.join(per_document.hint("merge"), ["doc_id", "tag"]).mapInArrow(
        _passage_batches,
        "shard long, part int, doc_id long, tag int, start int, leads boolean, split boolean, words binary",
    )
    judged = c.kept_table(
        passages.repartition(max(width, min(int(shards), 4 * width)), "shard", "part")
        .sortWithinPartitions("shard", "part", "doc_id", "start")
        .mapInArrow(_shard_batches, "doc_id long, tag int, first int, n int, print_a long, print_b long"),
        "covered",
    )
    rest = judged.where("n = 0")
    earliest = rest.groupBy("print_a", "print_b").agg(
        F.min("doc_id").alias("lowest"), F.max("doc_id").alias("last")
    )
    across = (
        rest.join(earliest.where("lowest < last"), ["print_a", "print_b"])
        .where("lowest < doc_id")
        .select("doc_id", "tag", "first", F.lit(1).alias("n"))
    )
    covered = judged.where("n > 0").select("doc_id", "tag", "first", "n").unionByName(across)
    return covered.groupBy("doc_id", "tag").agg(
        F.collect_set(F.struct("first", "n")).alias("spans")
    )


def _tag():
    return F.hash("text").alias("tag")


def _kept_words(text: str | None, spans: list | None) -> tuple[int, int, list[bytes]]:
    words = (text or "").encode().split()
    if not spans:
        return len(words), 0, words
    stays = np.ones(len(words), bool)
    for span in spans:
        stays[span["first"] : span["first"] + span["n"] + WINDOW - 1] = False
    kept = [words[i] for i in np.flatnonzero(stays)]
    return len(words), len(words) - len(kept), kept


_DIGEST = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)


@arrow_udf(_DIGEST)
def _digest(text: pa.Array, spans: pa.Array) -> pa.Array:
    rows = []
    for value, cut in zip(text, spans, strict=True):
        n, removed, kept = _kept_words(value.as_py(), cut.as_py())
        rows.append((n, removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
    n, removed, digest = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
        names=["n_words", "n_removed", "kept_sha256"],
    )


@arrow_udf(T.StringType())
def _trimmed(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for value, cut in zip(text, spans, strict=True):
        spans_ = cut.as_py()
        out.append(b" ".join(_kept_words(value.as_py(), spans_)[2]).decode() if spans_ else value.as_py())
    return pa.array(out, pa.string())


def removal_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    spans = c.kept_table(covered_windows(docs), "spans")
    texts = c.pick(docs, "doc_id", "text").select("doc_id", "text", _tag())
    return (
        texts.join(spans.hint("merge"), ["doc_id", "tag"], "left")
        .select("doc_id", _digest("text", "spans").alias("kept"))
        .select("doc_id", "kept.*")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; ``n_chars``, if there, is counted anew.

    A text that loses nothing stays as it is, else the kept words are joined by one space. Rows stay,
    also if no word is left.
    """
    spans = c.kept_table(covered_windows(docs), "spans")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = (f"c{names.index(n)}" for n in ("doc_id", "text"))
    tagged = plain.withColumn("tag", F.hash(text))
    spans = spans.select(F.col("doc_id").alias("id"), F.col("tag").alias("id_tag"), "spans")
    joined = tagged.join(spans.hint("merge"), (F.col(id_) == F.col("id")) & (F.col("tag") == F.col("id_tag")), "left")
    out = joined.withColumn("trimmed", _trimmed(F.col(text), F.col("spans")))
    columns = []
    for i, name in enumerate(names):
        column = F.col(f"c{i}")
        if name == "text":
            column = F.col("trimmed")
        elif name == "n_chars":
            kind = dict(docs.dtypes)[name]
            column = F.when(F.col("spans").isNotNull(), F.length("trimmed").cast(kind)).otherwise(column)
        columns.append(column.alias(name))
    return out.select(*columns)
