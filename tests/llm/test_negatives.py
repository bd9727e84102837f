"""Hard negatives against every pair, the curve, and the bounds."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from pactlens.llm import negatives

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(n, T.StringType()) for n in ("block", "place", "Length", "pack", "score", "v")],
    ]
)


def brute(rows):
    kept = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v])
        kept[i] = min(kept.get(i, own), own)
    out = []
    for a, (label, v) in kept.items():
        if a % 100:
            continue
        scores = [
            (-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label)
            for i, (other, w) in kept.items() if i != a and len(w) == len(v)
        ]
        for ps, p, _ in sorted(s for s in scores if s[2])[:5]:
            fits = sorted((s, i) for s, i, same in scores if not same and 80 * -ps <= 100 * -s <= 100 * -ps)
            out += [(a, p, rank, i, -ps, -s) for rank, (s, i) in enumerate(fits[:5], 1)]
    return sorted(out)


def made(seed, n=1500, dims=8, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.5, (labels, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = rng.normal(0, 0.3, dims) + centres[int(rng.integers(labels))]
        if i % 3 == 0:
            v = centres[0]  # a third of all rows share one vector
        rows.append((i, [float(np.float32(x)) for x in v], label))
    rows += [
        (None, [1.0] * dims, 1), (2000, None, 1), (2100, [1.0] * dims, None), (2200, [1.0, None] + [0.0] * (dims - 2), 1),
        (2300, [math.nan] * dims, 1), (2400, [math.inf] * dims, 2), (2500, [0.5, 0.25], 1), (2501, [0.5, 0.5], 1),
        (2502, [0.5, 0.2], 2), (2600, [], 1), (2601, [], 1), (2602, [], 2), (2700, [0.0] * dims, 8), (2701, [0.0] * dims, 9),
        rows[0], rows[0], (100, [0.1] * dims, 3), (-100, [0.4] * dims, 0), (2800, [1000.0] * dims, 1), (2801, [900.0] * dims, 1),
        (2802, [880.0] * dims, 2),
    ]
    return [(*r, *["x"] * 6) for r in rows]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 16, "pack_rows": 4, "zones": 8}])
def test_hard_negatives(spark, sizes):
    rows = made(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = sorted(map(tuple, negatives.hard_negatives(df, **sizes).collect()))
    assert found == brute(rows) and len(found) > 200


def test_sql_says_the_same(spark):
    rows = made(2, 900)
    db = duckdb.connect()
    df = spark.createDataFrame(rows, SCHEMA).select("vec_id", "embedding", "label")
    db.register("embeddings", df.toArrow())
    assert sorted(db.sql(negatives.oracle_sql()).fetchall()) == brute(rows)


def test_blocks_far_away_are_not_read(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(4000):
        side = i % 8
        v = np.zeros(8)
        v[side] = 4
        rows.append((i, [float(np.float32(x)) for x in v + rng.normal(0, 0.05, 8)], side % 2))
    placed = negatives.on_curve(negatives.prepared_rows(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")))
    blocks = negatives._ordered(placed, True, 64, "blocks").collect()
    anchor = np.floor(256 * np.array([rows[100][1]])).astype(np.int64)
    low, high = (np.stack([np.frombuffer(b[n], np.int32) for b in blocks]).astype(np.int64) for n in ("low", "high"))
    _, most = negatives.bounds(anchor, low, high)
    read = (most[0] >= 3 * 3 * 256 * 256).sum()
    assert 0 < read < len(blocks) / 4


def test_empty_table(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (1, 5)])
def test_the_curve_steps_to_neighbours(axes, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    place = negatives.hilbert(points.astype(np.uint64), bits)
    assert sorted(place.tolist()) == list(range(1 << axes * bits))
    path = points[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(3)
    a, rows = rng.integers(-300, 300, (20, 6)), rng.integers(-300, 300, (50, 6))
    least, most = negatives.bounds(a, rows.min(0)[None], rows.max(0)[None])
    scores = negatives.dots(a, rows)
    assert (scores >= least).all() and (scores <= most).all()
    big = rng.integers(-(2**27), 2**27, (4, 16))
    assert negatives.dots(big, big).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in big] for p in big]
