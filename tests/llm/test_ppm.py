"""Partial matching against a plain version that keeps every context in a dictionary."""

import math
import random
import zlib
from collections import Counter, defaultdict

import messy
import pytest

from pactlens.llm import chunks, ppm


@pytest.fixture(scope="module")
def docs(spark):
    return messy.table(spark).cache()


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def data_of(text):
    return b" ".join(messy.words(text)).lower() if (text or "").isascii() else b" ".join(
        bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in messy.words(text)
    )


class Trie:
    def __init__(self, texts, order):
        self.order, self.after = order, defaultdict(Counter)
        for data in texts:
            full = bytes([ppm.START]) * order + data + bytes([ppm.END])
            for i in range(order, len(full)):
                for k in range(order + 1):
                    self.after[full[i - k : i]][full[i]] += 1

    def probability(self, context, byte):
        p, left_out = 1.0, set()
        for k in range(self.order, -1, -1):
            seen = self.after.get(context[len(context) - k :])
            if seen is None:
                continue
            open_ = {b: n for b, n in seen.items() if b not in left_out}
            n, d = sum(open_.values()), len(open_)
            if byte in open_:
                return p * open_[byte] / (n + d)
            if d:
                p *= d / (n + d)
            left_out |= set(seen)
        return p / (256 - len(left_out))

    def score(self, data):
        full = bytes([ppm.START]) * self.order + data + bytes([ppm.END])
        return sum(math.log10(self.probability(full[i - self.order : i], full[i])) for i in range(self.order, len(full)))


def expected(rows, order):
    train = [data_of(t) for i, t in rows if not held_out(i)]
    trie = Trie(train, order)
    counts = Counter(w for data in train for w in data.split(b" ") if w)
    counts[None] = len(train)
    total, different = sum(counts.values()), sum(1 for n in counts.values() if n)
    out = []
    for i, text in rows:
        data = data_of(text)
        tokens = [*[w for w in data.split(b" ") if w], None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (different + 1))) for t in tokens)
        out.append((i, held_out(i), len(tokens), sum(counts[t] > 0 for t in tokens), total, base, trie.score(data)))
    return out


@pytest.mark.parametrize("order", [5, 2])
def test_scores(docs, order):
    rows = [(r[0], r[1]) for r in messy.rows()]
    wanted = expected(rows, order)
    found = list(map(tuple, ppm.scored(docs, order=order, chunk_bytes=20_000).collect()))
    assert len(found) == len(wanted)
    by = lambda r: (repr(r[:5]), r[6])
    for a, b in zip(sorted(found, key=by), sorted(wanted, key=by), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_a_chunk_does_not_change_a_score(spark, docs):
    whole = {r["doc_id"]: r["score"] for r in ppm.scored(docs).where("doc_id <> 11").collect()}
    small = {r["doc_id"]: r["score"] for r in ppm.scored(docs.repartition(3), chunk_bytes=1000).where("doc_id <> 11").collect()}
    assert whole == pytest.approx(small, rel=1e-12)


def test_probabilities_sum_to_one():
    trie = Trie([b"abracadabra", b"bandana"], 3)
    for context in (b"abr", b"xan", b"zzz", b"\xfe\xfe\xfe"):
        assert sum(trie.probability(context, b) for b in range(256)) == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    rows = [(i, "Some words") for i in range(60) if held_out(i)]
    found = ppm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (True, 3, 0, 0)
        assert r["score"] == pytest.approx(-11 * math.log10(256))
        assert r["base_score"] == pytest.approx(0)


def test_empty_table(spark):
    assert ppm.scored(messy.empty(spark)).count() == 0


def test_learned_text_is_likelier(spark):
    rng = random.Random(3)
    rows = [(i, messy.prose(rng, 80, "abcd")) for i in range(200)]
    odd = next(i for i in range(500, 600) if held_out(i))
    rows.append((odd, messy.prose(rng, 80, "wxyz")))
    found = {r["doc_id"]: r["score"] / r["n_tokens"] for r in ppm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[odd] < found[i] for i in range(200))


def test_chunks_hold_whole_texts(spark, docs):
    made = chunks.chunked(docs.selectExpr("doc_id", "text", "coalesce(lang, 'und') AS tag"), lambda raw, at: (raw, at), "plain", 5000)
    got = []
    for chunk, tag, ids, raw, at in chunks.parts(made.toArrow()):
        got += [(i, tag, raw[a:b].tobytes()) for i, a, b in zip(ids, at[:-1], at[1:], strict=True)]
    assert sorted(map(repr, got)) == sorted(repr((r[0], r[2] or "und", (r[1] or "").encode())) for r in messy.rows())
    assert made.select("chunk").distinct().count() > 4
