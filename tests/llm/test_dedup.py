"""Exact copies, near copies and repeated passages against plain versions."""

import hashlib
import re
from collections import defaultdict

import messy
import pytest

from pactlens.llm import exact, neardup, substring
from pactlens.llm.graph import components


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return messy.table(spark).cache()


def test_exact_copies(spark, docs, monkeypatch):
    monkeypatch.setattr(exact, "BLOCK", 64)  # many levels of pairs
    found = exact.exact_copies(docs).collect()
    groups = defaultdict(list)
    for i, text, *_ in messy.rows():
        groups[normal(text)].append(i)
    assert len(found) == len(messy.rows())
    kept = defaultdict(int)
    for r in found:
        kept[r["text_sha256"]] += r["kept"]
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_hash[r["text_sha256"]]
        smallest = min((i for i in ids if i is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (smallest, len(ids))
        assert not r["kept"] or r["doc_id"] == smallest
    assert set(kept.values()) == {1}


def test_drop_copies_keeps_columns_and_one_row_a_text(spark, docs):
    out = exact.drop_copies(docs)
    assert out.schema == docs.schema
    texts = [normal(r["text"]) for r in out.select("text").collect()]
    assert len(texts) == len(set(texts)) == len({normal(r[1]) for r in messy.rows()})
    assert [r["doc_id"] for r in out.where("doc_id IN (9, 10, 11)").collect()] == [9]


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 7), (7, 6), (20, 20)] + [(100, 100 + i) for i in range(1, 50)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {found[i] for i in (1, 2, 3)} == {1}
    assert {found[i] for i in (6, 7, 8, 9, 10)} == {6}
    assert {found[i] for i in range(100, 150)} == {100}


def shingles(text):
    w = messy.words(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(w, w[1:], strict=False)) if len(w) > 1 else frozenset(w)


def brute_components(rows):
    """Smallest linked doc_id of every row; rows of one doc_id count as one document."""
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    sets = [(i, s) for i, s in sets if s]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            n = len(a & b)
            if 100 * n >= 80 * (len(a) + len(b) - n):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in parent}


def strays():
    """A family whose members mostly link to its first text only through others."""
    base = [f"w{i}" for i in range(200)]
    out = [(1000, " ".join(base))]
    for k in range(1, 30):
        changed = list(base)
        for i in range(0, 8 * (k % 5), 2):  # the further, the more words differ from the first text
            changed[i * 3 % 200] = f"x{i}"
        changed[199 - k] = f"y{k}"
        out.append((1000 + k, " ".join(changed)))
    return out


@pytest.mark.parametrize("case", ["messy", "strays"])
def test_near_duplicates(spark, docs, case):
    rows = [(r[0], r[1]) for r in messy.rows()] if case == "messy" else strays()
    df = docs if case == "messy" else spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_components(rows)
    found = neardup.near_duplicates(df).collect()
    assert len(found) == len(rows)
    sizes = sorted(((i is None, i or 0), len(shingles(t))) for i, t in rows)
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_shingles"]) for r in found) == sizes
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == expected[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_drop_near_duplicates(spark, docs):
    out = neardup.drop_near_duplicates(docs)
    assert out.schema == docs.schema
    expected = brute_components([(r[0], r[1]) for r in messy.rows()])
    stay = [r[0] for r in messy.rows() if r[0] is None or expected[r[0]] == r[0]]
    key = lambda i: (i is None, i or 0)
    assert sorted((r["doc_id"] for r in out.collect()), key=key) == sorted(stay, key=key)


def test_sketch_fills_every_coordinate_and_estimates():
    import numpy as np

    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 62, 600).astype(np.uint64))
    b = np.unique(np.concatenate((a[: len(a) * 8 // 10], rng.integers(0, 1 << 62, 60).astype(np.uint64))))
    one = a[:1]
    flat = np.concatenate((a, b, one))
    out = neardup.sketches(flat, np.cumsum([0, len(a), len(b), 1]))
    assert (out != neardup._FREE).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((out[0] == out[1]).mean() - true) < 0.12
    # each document's sketch is its own affair
    assert (neardup.sketches(b, np.array([0, len(b)]))[0] == out[1]).all()


def brute_removal(rows, window=50):
    first = {}
    for i, t in rows:
        w = messy.words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None and (key not in first or i < first[key]):
                first[key] = i
    out = []
    for i, t in rows:
        w = messy.words(t)
        keep = [True] * len(w)
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k : k + window])] < i:
                    keep[k : k + window] = [False] * window
        kept = [x for x, y in zip(w, keep, strict=True) if y]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("split", [False, True])
def test_removal(spark, docs, monkeypatch, split):
    if split:  # small shards, and the large ones in slices
        monkeypatch.setattr(substring, "SHARD_WINDOWS", 400)
        monkeypatch.setattr(substring, "SLICE_WINDOWS", 150)
        monkeypatch.setattr(substring, "PIECE_WINDOWS", 40)
    expected = brute_removal([(r[0], r[1]) for r in messy.rows()])
    found = substring.removal_report(docs)
    assert messy.as_set(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(map(repr, expected))
    assert sum(r[2] for r in expected) > 500


def test_remove_repeats(spark, docs):
    out = substring.remove_repeats(docs)
    assert out.schema == docs.schema
    removed = {r[0]: r[2] for r in brute_removal([(r[0], r[1]) for r in messy.rows()])}
    before = {r[0]: r[1] for r in messy.rows()}
    for r in out.where("doc_id IS NOT NULL").collect():
        if removed[r["doc_id"]]:
            assert r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == before[r["doc_id"]]


def test_automaton_matches():
    machine = substring.Automaton()
    machine.add(b"a b a b c".split())
    machine.add(b"b c d a b".split())
    assert machine.matches(b"x a b c d a b a".split()) == [0, 1, 2, 3, 3, 4, 5, 3]


def test_empty_tables(spark):
    none = messy.empty(spark)
    assert exact.exact_copies(none).count() == 0
    assert exact.drop_copies(none).count() == 0
    assert neardup.near_duplicates(none).count() == 0
    assert neardup.drop_near_duplicates(none).count() == 0
    assert substring.removal_report(none).count() == 0
    assert substring.remove_repeats(none).count() == 0


def test_names_that_differ_in_case_only(spark):
    odd = spark.createDataFrame([(1, "a b", "zzz"), (2, "a  b", "yyy")], ["doc_id", "text", "Text"])
    assert messy.as_set(exact.exact_copies(odd), "doc_id", "keep_id") == ["(1, 1)", "(2, 1)"]
