"""Language-model scores by partial matching of byte contexts.

The model is a trie of the contexts of up to ``ORDER`` bytes that stand before each byte of the training
texts, with the counts of the bytes that follow. A byte is coded in the longest context that was seen:
with n occurrences and d different bytes after it, a byte seen c times has the probability c / (n + d) and
the escape to the context shorter by one byte d / (n + d). A shorter context leaves out the bytes that the
longer one knows (they would not have escaped), in its n, its d and its escape; as every byte seen after a
context is also seen after its endings, what is left out depends on the last context alone. Bytes never
seen share what the empty context leaves, evenly over the 256 byte values. The score of a text is the sum
of log10 of these probabilities, pretrained: the trie is of all training texts and does not change while
a text is read.

Scored is what the tokens hold: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+`` joined by one space, then an
end mark (byte FF, which UTF-8 never has). Start marks (FE) fill the contexts at a text's start.

The trie lies in written tables of one row per context and byte, as large as the corpus makes it, and
Spark joins give the code length of every (context, byte) that stands in some text. Each chunk of text asks
shards for its different ones, and for its different words, once. So no table is sent to every executor and
no context is a hot key. Words are told apart by 64 bits within a chunk, and by their spelling across chunks.

Beside the score stands a unigram base: the sum over tokens (the words, then one end) of
log10((c + 0.5) / (N + 0.5 (V + 1))), c the count of the token, N of all and V the different ones in
training.

Rows: null text is empty (one end token); a null doc_id counts as the empty text in the split; repeated
rows are scored and learned from each by itself; with nothing to learn from every byte costs log10(256); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.llm import chunks
from pactlens.llm import common as c

ORDER = 5
START, END = 0xFE, 0xFF
HELD_OUT = "coalesce(crc32(cast(doc_id AS string)) % 5 = 1, false)"
_TRAIN, _HELD = "train", "held"

# ---- texts ----


def token_text(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words joined by one space, for each text."""
    raw = c.ascii_lower(raw)
    starts, ends, n_words = c.word_spans(raw, offsets)
    if not len(starts):
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    last = np.cumsum(n_words)[n_words > 0] - 1
    sizes = ends - starts + 1
    sizes[last] -= 1  # no space after a text's last word
    heads = np.append(0, np.cumsum(sizes))
    out = np.full(heads[-1], 32, np.uint8)
    inside = np.zeros(len(raw) + 1, np.int32)
    inside[starts] += 1
    inside[ends] -= 1  # where a text's last word ends and the next text's first starts, both cancel out
    taken = np.cumsum(inside[:-1]) > 0
    places = np.ones(heads[-1], bool)
    spaced = np.ones(len(starts), bool)
    spaced[last] = False
    places[heads[1:][spaced] - 1] = False
    out[places] = raw[taken]
    return out, np.append(0, heads[np.cumsum(n_words)])


def grams(raw: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The byte at every place, the end mark too, below the ``order`` bytes before it; and offsets into them."""
    n = len(offsets) - 1
    heads = offsets[:-1] + (order + 1) * np.arange(n)
    padded = np.full(len(raw) + (order + 1) * n, START, np.uint8)
    own = np.ones(len(padded), bool)
    for i in range(order):
        own[heads + i] = False
    tails = offsets[1:] + (order + 1) * np.arange(n) + order
    padded[tails] = END
    text = own.copy()
    text[tails] = False
    padded[text] = raw
    packed = padded.astype(np.uint64)
    for i in range(1, order + 1):
        packed[i:] |= padded[:-i].astype(np.uint64) << np.uint64(8 * i)
    return packed[own], offsets + np.arange(n + 1)


def _word_keys(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, its start and end, and the words of each text."""
    starts, ends, n_words = c.word_spans(raw, offsets)
    return c.span_hashes(raw, starts, ends), starts, ends, n_words


# ---- what chunks ask ----

_GRAM, _WORD = 0, 1
_ASKED = "shard long, chunk long, keys binary, counts binary"
_ANSWERED = "chunk long, kind int, shard long, body binary"


def _grams_of(parts: list, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The different grams of a chunk, and how often each stands in training texts."""
    sums: list[tuple[np.ndarray, np.ndarray]] = []
    for tag, _, raw, offsets in parts:
        keys, counts = chunks.distinct(grams(raw, offsets, order)[0])
        sums.append((keys, counts * (tag == _TRAIN)))
        if len(sums) >= 8:
            sums = [chunks.summed(sums)]
    return chunks.summed(sums)


def _words_of(parts: list) -> tuple[np.ndarray, np.ndarray, dict[int, bytes]]:
    """The keys of a chunk's different words, how often each stands in training texts, and the words."""
    words: dict[int, bytes] = {}
    sums: list[tuple[np.ndarray, np.ndarray]] = []
    for tag, _, raw, offsets in parts:
        keys, starts, ends, _ = _word_keys(raw, offsets)
        different, first, counts = np.unique(keys, return_index=True, return_counts=True)
        data = raw.tobytes()
        for key, a, b in zip(different.tolist(), starts[first].tolist(), ends[first].tolist(), strict=True):
            if key not in words:
                words[key] = data[a:b]
        sums.append((different, counts * (tag == _TRAIN)))
    return *chunks.summed(sums), words


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    kinds = {"body": pa.binary(), "keys": pa.binary(), "counts": pa.binary(), "kind": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kinds.get(n, pa.int64())) for x, n in zip(columns, names, strict=True)], names=names
    )


def _asked(kind: int, order: int, shards: int):
    """(shard, chunk, keys, counts): what a chunk asks of each shard, grams as steps from one to the next,
    words spelled."""

    @c.returning
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, parts in chunks.by_chunk(batches):
            words: dict[int, bytes] = {}
            if kind == _GRAM:
                keys, counts = _grams_of(parts, order)
            else:
                keys, counts, words = _words_of(parts)
            by, cuts = chunks.dealt(keys, shards)
            rows = []
            for shard, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                if a < b:
                    own = keys[by[a:b]]
                    body = np.diff(own, prepend=np.uint64(0)).tobytes() if kind == _GRAM else b"\n".join([words[k] for k in own.tolist()])
                    rows.append((shard, chunk, chunks.packed(body), chunks.packed(counts[by[a:b]].tobytes())))
            yield _batch(rows, ["shard", "chunk", "keys", "counts"])

    return work


def _gram_keys(body: bytes) -> np.ndarray:
    return np.cumsum(chunks.unpacked(body).view(np.uint64), dtype=np.uint64)


def _counts(body: bytes) -> np.ndarray:
    return chunks.unpacked(body).view(np.int64)


def _gram_counts(table: pa.Table) -> pa.Table:
    """(gram, n) of a shard."""
    bodies = [table.column(n).to_pylist() for n in ("keys", "counts")]
    keys, counts = chunks.summed([(_gram_keys(k), _counts(n)) for k, n in zip(*bodies, strict=True)])
    return pa.table({"gram": pa.array(c.signed(keys)), "n": pa.array(counts, pa.int64())})


def _gram_answers(left: pa.Table, right: pa.Table) -> pa.Table:
    """The values of what chunks ask of a shard, from the shard's (gram, value)."""
    known, values = right.column("gram").to_numpy().view(np.uint64), right.column("value").to_numpy()
    order = np.argsort(known)
    known, values = known[order], values[order]
    rows = [
        (chunk, _GRAM, shard, chunks.packed(values[np.searchsorted(known, _gram_keys(keys))].tobytes()))
        for shard, chunk, keys in zip(*[left.column(n).to_pylist() for n in ("shard", "chunk", "keys")], strict=True)
    ]
    return pa.Table.from_batches([_batch(rows, ["chunk", "kind", "shard", "body"])])


def _word_answers(table: pa.Table) -> pa.Table:
    """The counts of what chunks ask of a shard; as chunk -1, the sum of the counts and how many are not 0."""
    asked = [chunks.unpacked(b).tobytes().split(b"\n") for b in table.column("keys").to_pylist()]
    spelled = pa.array([w for words in asked for w in words], pa.large_binary()).dictionary_encode()
    codes = spelled.indices.to_numpy()
    counts = np.concatenate([_counts(b) for b in table.column("counts").to_pylist()])
    total = np.zeros(len(spelled.dictionary), np.int64)
    np.add.at(total, codes, counts)
    shard = table.column("shard")[0].as_py()
    rows = [(-1, _WORD, shard, np.array([total.sum(), (total > 0).sum()], np.int64).tobytes())]
    at = 0
    for chunk, words in zip(table.column("chunk").to_pylist(), asked, strict=True):
        rows.append((chunk, _WORD, shard, chunks.packed(total[codes[at : at + len(words)]].tobytes())))
        at += len(words)
    return pa.Table.from_batches([_batch(rows, ["chunk", "kind", "shard", "body"])])


# ---- the trie ----


def _tail(column: str, n_bytes: int) -> str:
    return f"{column} & {(1 << 8 * n_bytes) - 1}L" if n_bytes else "0L"


def levels(counts: DataFrame, order: int = ORDER) -> tuple[list[DataFrame], list[DataFrame]]:
    """Tables by order from (gram, n) of the training texts: counts (gram, n), and contexts (context, n, d,
    below) with the number of bytes after a context, of different ones, and of occurrences of those
    different ones after the context shorter by one byte."""
    by_order = [counts.where("n > 0").select("gram", "n")]
    for k in range(order - 1, -1, -1):
        shorter = by_order[0].groupBy(F.expr(_tail("gram", k + 1)).alias("gram")).agg(F.sum("n").alias("n"))
        by_order.insert(0, c.kept_table(shorter, f"counts-{k}"))
    contexts = []
    for k, level in enumerate(by_order):
        rows = level.selectExpr("shiftrightunsigned(gram, 8) AS context", "n", f"{_tail('gram', k)} AS tail")
        if k:
            below = by_order[k - 1].select(F.col("gram").alias("tail"), F.col("n").alias("below"))
            rows = rows.join(below, "tail")
        else:
            rows = rows.withColumn("below", F.lit(0).cast("long"))
        contexts.append(
            c.kept_table(
                rows.groupBy("context").agg(F.sum("n").alias("n"), F.count("*").alias("d"), F.sum("below").alias("below")),
                f"contexts-{k}",
            )
        )
    return by_order, contexts


def code_lengths(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, value): log10 of the probability of every gram of (gram, n), also of those with n = 0."""
    by_order, contexts = levels(counts, order)
    found: list[DataFrame] = []
    # grams still to be coded, the log of their escapes, and n, d of the context they escaped from last, seen
    # in the next shorter one (null before the first context that was seen)
    waiting = counts.selectExpr(
        "gram", "n AS own", "0D AS spent", "cast(null AS long) AS out_n", "cast(null AS long) AS out_d"
    )
    for k in range(order, -1, -1):
        here = waiting.withColumn("context", F.expr(_tail("shiftrightunsigned(gram, 8)", k))).join(
            contexts[k].selectExpr("context", "n", "d", "below"), "context", "left"
        )
        if k < order:
            seen = by_order[k].select(F.col("gram").alias("short"), F.col("n").alias("own"))
            here = here.drop("own").withColumn("short", F.expr(_tail("gram", k + 1))).join(seen, "short", "left")
        here = here.selectExpr(
            "gram", "coalesce(own, 0L) AS own", "spent", "n IS NOT NULL AS known", "below", "d",
            "coalesce(n - coalesce(out_n, 0L), 0L) AS left_n", "coalesce(d - coalesce(out_d, 0L), 0L) AS left_d",
        )
        found.append(here.where("own > 0").selectExpr("gram", "spent + log10(own / (left_n + left_d)) AS value"))
        waiting = here.where("own = 0").selectExpr(
            "gram", "0L AS own",
            "CASE WHEN left_d > 0 THEN spent + log10(left_d / (left_n + left_d)) ELSE spent END AS spent",
            "CASE WHEN known THEN below END AS out_n", "CASE WHEN known THEN d END AS out_d",
        )
        if k:
            waiting = c.kept_table(waiting, f"escaped-{k}")
    found.append(waiting.selectExpr("gram", "spent - log10(256 - coalesce(out_d, 0L)) AS value"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


# ---- scores ----

_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _answers(table: pa.Table, kind: int, keys: np.ndarray, shards: int, dtype: type) -> chunks.Answers:
    """Answers of one kind to the different ``keys`` that a chunk asked about."""
    own = [
        (shard, body)
        for of, shard, body in zip(*[table.column(n).to_pylist() for n in ("kind", "shard", "body")], strict=True)
        if of == kind
    ]
    values = [chunks.unpacked(body).view(dtype) for _, body in sorted(own)]
    by, _ = chunks.dealt(keys, shards)
    return chunks.Answers(keys[by], np.concatenate(values) if values else np.zeros(0, dtype))


def _scored(left: pa.Table, right: pa.Table, order: int, shards: int, total: int, different: int, ends: int) -> pa.Table:
    """Rows of one chunk from its texts and its answers."""
    parts = [part[1:] for part in chunks.parts(left)]
    of_grams = _answers(right, _GRAM, _grams_of(parts, order)[0], shards, np.float64)
    of_words = _answers(right, _WORD, _words_of(parts)[0], shards, np.int64)
    room = math.log10(total + 0.5 * (different + 1))
    rows: list[list] = [[] for _ in range(7)]
    for tag, doc_ids, raw, offsets in parts:
        keys, at = grams(raw, offsets, order)
        bits, _ = of_grams.find(keys)
        score = np.add.reduceat(bits, at[:-1])  # every text has its end mark
        words, _, _, n_words = _word_keys(raw, offsets)
        seen, _ = of_words.find(words)
        doc = np.repeat(np.arange(len(doc_ids)), n_words)
        base = np.bincount(doc, np.log10(seen + 0.5), len(doc_ids)) + math.log10(ends + 0.5) - room * (n_words + 1)
        known = np.bincount(doc, seen > 0, len(doc_ids)).astype(np.int64) + (ends > 0)
        n = len(doc_ids)
        for own, column in zip(
            rows, (doc_ids, [tag == _HELD] * n, n_words + 1, known, [total] * n, base, score), strict=True
        ):
            own.extend(column)
    c.give_back()
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    return pa.Table.from_arrays(
        [pa.array(x, k) for x, k in zip(rows, kinds, strict=True)],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def scored(
    docs: DataFrame, held_out: str = HELD_OUT, order: int = ORDER, chunk_bytes: int = chunks.CHUNK_BYTES
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned from
    the documents for which ``held_out`` (an expression over doc_id) is false."""
    if not 1 <= order <= 7:
        raise ValueError("a context holds 1 to 7 bytes")
    tagged = c.pick(docs, "doc_id", "text").selectExpr(
        "doc_id", "text", f"CASE WHEN {held_out} THEN '{_HELD}' ELSE '{_TRAIN}' END AS tag"
    )
    texts = chunks.chunked(tagged, token_text, "chunks", chunk_bytes)

    shards = chunks.shard_count(texts)
    asked = c.kept_table(texts.mapInArrow(_asked(_GRAM, order, shards), _ASKED), "asked-grams")
    counts = c.kept_table(asked.groupBy("shard").applyInArrow(_gram_counts, "gram long, n long"), "gram-counts")
    values = code_lengths(counts, order).withColumn("shard", F.expr(f"pmod(gram, {shards}L)"))
    of_grams = asked.groupBy("shard").cogroup(values.groupBy("shard")).applyInArrow(_gram_answers, _ANSWERED)

    words = texts.mapInArrow(_asked(_WORD, order, shards), _ASKED)
    of_words = c.kept_table(words.groupBy("shard").applyInArrow(_word_answers, _ANSWERED), "word-answers")
    sums = [np.frombuffer(r["body"], np.int64) for r in of_words.where("chunk = -1").collect()]  # one a shard
    ends = texts.agg(F.coalesce(F.sum(F.expr(f"CASE WHEN tag = '{_TRAIN}' THEN size(doc_ids) END")), F.lit(0))).first()[0]
    total, different = (int(x) for x in np.sum([[ends, ends > 0], *sums], axis=0))
    answers = of_grams.unionByName(of_words.where("chunk >= 0"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scored(left, right, order, shards, total, different, ends)

    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, _SCHEMA)
