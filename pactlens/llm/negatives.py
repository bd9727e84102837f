"""Hard negatives from blocks of vectors in Hilbert-curve order with zone maps.

Components become the integers floor(256 x); a score is the integer inner product of a row with an anchor.
Rows are ordered by vector length, label and their place on a Hilbert curve through the ``AXES`` components
of greatest variance, and are written as Parquet in blocks of up to ``BLOCK_ROWS`` rows of one label, each
with the least and greatest value of every component: its zone map. Ordered likewise, anchors form packs.

A pack is compared with the zone maps alone: interval arithmetic gives an upper and a lower bound of an
anchor's score with any row of a block, and a block is read for a pack only if the bounds of one of its
anchors meet one of that anchor's windows of wanted scores. This is done three times:

1. for the block of the anchor's label with the highest bound: the fifth score found there is a floor;
2. for the anchor's label from that floor up: the first ``POSITIVES`` other rows are the positives;
3. for other labels between 80 % and 100 % of each positive's score: the first ``NEGATIVES`` rows.

Blocks that bounds rule out are never read, and every block that could hold a wanted row is read, so the
result is exact. Scores are exact too: products stay whole in floating point below 2**53, else integers are
multiplied.

Rows with a null vec_id or label, a null vector, or a null or not finite component take no part, nor do rows
with a component of ``LARGEST`` or more (their scores would not fit 64 bits). Of rows with one vec_id the
smallest by label and components counts; an anchor's other rows are those of another vec_id. Vectors are
compared with those of their own length. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.llm import common as c

BLOCK_ROWS, PACK_ROWS, ZONES = 1024, 256, 2048
AXES, AXIS_BITS = 10, 6
ANCHOR_STEP, POSITIVES, NEGATIVES = 100, 5, 5
LARGEST = float(1 << 19)  # 27 bits after the factor 256

_LEAST, _MOST = -(1 << 62), 1 << 62


def prepared_rows(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the rows that take part."""
    picked = c.pick(rows, "vec_id", "label", "embedding").where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL"
        f" AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < {LARGEST}D)"
    )
    return (
        picked.selectExpr(
            "cast(vec_id AS long) AS vec_id",
            "cast(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS long) AS label",
            "transform(embedding, x -> cast(floor(256D * cast(x AS double)) AS int)) AS v",
        )
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "v")).alias("row"))
        .select("vec_id", "row.label", "row.v")
    )


# ---- the curve ----


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (row, axis) with coordinates of ``bits`` bits."""
    axes = [a.astype(np.uint64) for a in x.T]
    if not axes:
        return np.zeros(len(x), np.uint64)
    for step in range(bits - 1, 0, -1):
        bit, below = np.uint64(1 << step), np.uint64((1 << step) - 1)
        for i in range(len(axes)):
            high = (axes[i] & bit) != 0
            swap = np.where(high, np.uint64(0), (axes[0] ^ axes[i]) & below)
            axes[i] = axes[i] ^ swap
            axes[0] = axes[0] ^ (np.where(high, below, swap) if i else np.where(high, below, np.uint64(0)))
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(x), np.uint64)
    for step in range(bits - 1, 0, -1):
        turn = np.where((axes[-1] >> np.uint64(step)) & np.uint64(1), turn ^ np.uint64((1 << step) - 1), turn)
    place = np.zeros(len(x), np.uint64)
    for step in range(bits - 1, -1, -1):
        for a in axes:
            place = place << np.uint64(1) | ((a ^ turn) >> np.uint64(step)) & np.uint64(1)
    return place


def _vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length and their vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    starts = np.append(0, np.cumsum(sizes))[:-1]
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out.append((rows, flat[starts[rows][:, None] + np.arange(size)].astype(np.int64)))
    return out


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(length, axis, n, s, ss): sums over a task's components."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, v in _vectors(batch.column("v")):
            own = np.stack([np.full(v.shape[1], len(v)), v.sum(0), (v.astype(float) ** 2).sum(0)])
            sums[v.shape[1]] = sums.get(v.shape[1], 0) + own
    for length, (n, s, ss) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(length, length, np.int32)), pa.array(np.arange(length, dtype=np.int32)), pa.array(n), pa.array(s), pa.array(ss)],
            names=["length", "axis", "n", "s", "ss"],
        )


def _axes(rows: DataFrame) -> DataFrame:
    """(length, axes): the axes of greatest variance of each length, with mean and deviation."""
    sums = rows.mapInArrow(_moments, "length int, axis int, n double, s double, ss double")
    sums = sums.groupBy("length", "axis").agg(*[F.sum(x).alias(x) for x in ("n", "s", "ss")])
    each = sums.selectExpr("length", "axis", "s / n AS middle", "sqrt(greatest(0D, ss / n - (s / n) * (s / n))) AS deviation")
    listed = each.groupBy("length").agg(F.sort_array(F.collect_list(F.struct(F.expr("-deviation AS away"), "axis", "middle"))).alias("axes"))
    return listed.select("length", F.slice("axes", 1, AXES).alias("axes"))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their ``place`` on the curve of their length."""
    for batch in batches:
        place = np.zeros(batch.num_rows, np.int64)
        for rows, v in _vectors(batch.column("v")):
            if not len(rows) or not v.shape[1]:
                continue
            axes = batch.column("axes")[int(rows[0])].as_py()
            x = v[:, [a["axis"] for a in axes]] - np.array([a["middle"] for a in axes])
            width = np.maximum(1.0, -np.array([a["away"] for a in axes])) / 10  # 64 steps over 6.4 deviations
            x = np.clip(np.floor(x / width) + (1 << AXIS_BITS - 1), 0, (1 << AXIS_BITS) - 1)
            place[rows] = hilbert(x.astype(np.uint64), AXIS_BITS).astype(np.int64)
        names = ["vec_id", "label", "v"]
        lengths = batch.column("v").value_lengths().cast(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], lengths, pa.array(place)], names=[*names, "length", "place"]
        )


def on_curve(rows: DataFrame) -> DataFrame:
    """Written (vec_id, label, v, length, place)."""
    axes = _axes(rows)
    joined = rows.withColumn("length", F.size("v")).join(axes, "length", "left")
    return c.kept_table(
        joined.select("vec_id", "label", "v", "axes").mapInArrow(
            _placed, "vec_id long, label long, v array<int>, length int, place long"
        ),
        "on-curve",
    )


# ---- blocks ----


def _grouped(most: int, by_label: bool):
    """Consecutive rows as groups of at most ``most``, of one length (and label), with their zone map."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 33
        held: list[tuple] = []
        key = None

        def out() -> pa.RecordBatch:
            ids, labels, vectors = zip(*held, strict=True)
            v = np.stack(vectors).astype(np.int32) if len(vectors[0]) else np.zeros((len(ids), 0), np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), pa.array([v.shape[1]], pa.int32()),
                    pa.array([labels[0] if by_label else None], pa.int64()),
                    pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                    pa.array([np.array(labels, np.int64).tobytes()], pa.binary()),
                    pa.array([v.tobytes()], pa.binary()),
                    pa.array([v.min(0).tobytes()], pa.binary()), pa.array([v.max(0).tobytes()], pa.binary()),
                ],
                names=_BLOCK_NAMES,
            )

        for batch in batches:
            ids, labels = batch.column("vec_id").to_pylist(), batch.column("label").to_pylist()
            v: list = [None] * len(ids)
            for rows, own in _vectors(batch.column("v")):
                for row, x in zip(rows.tolist(), own, strict=True):
                    v[row] = x
            for row in zip(ids, labels, v, strict=True):
                now = (len(row[2]), row[1] if by_label else None)
                if held and (now != key or len(held) == most):
                    yield out()
                    number, held = number + 1, []
                key = now
                held.append(row)
        if held:
            yield out()

    return work


_BLOCK_NAMES = ["block", "length", "label", "ids", "labels", "vectors", "low", "high"]
_BLOCK = "block long, length int, label long, ids binary, labels binary, vectors binary, low binary, high binary"


def _ordered(rows: DataFrame, by_label: bool, most: int, name: str) -> DataFrame:
    keys = ["length", *(["label"] if by_label else []), "place", "vec_id"]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return c.kept_table(sorted_.mapInArrow(_grouped(most, by_label), _BLOCK), name)


# ---- bounds and scores ----


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows between ``low`` and ``high`` can have with each row of ``a``."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return dots(plus, low) + dots(minus, high), dots(plus, high) + dots(minus, low)


def _matrix(body: bytes, length: int, n: int) -> np.ndarray:
    return np.frombuffer(body, np.int32).reshape(n, length).astype(np.int64)


def _pack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[dict]]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["labels"], np.int64), _matrix(row["vectors"], row["length"], len(ids)), row["windows"]


def _choose(same: bool, best_only: bool):
    """(pack, block): the blocks whose bounds meet a window of the pack."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, labels, a, windows = _pack(row)
                zones = row["zones"]
                low, high = (_matrix(b"".join(z[n] for z in zones), row["length"], len(zones)) for n in ("low", "high"))
                least, most = bounds(a, low, high)
                fits = (labels[:, None] == np.array([z["label"] for z in zones])[None, :]) == same
                taken = np.zeros(len(zones), bool)
                if best_only:
                    best = np.where(fits, most, _LEAST).argmax(1)
                    taken[best[fits.any(1)]] = True
                else:
                    for w in windows:
                        k = w["at"]
                        taken |= fits[k] & (most[k] >= w["low"]) & (least[k] <= w["high"])
                blocks = [z["block"] for z, t in zip(zones, taken, strict=True) if t]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["pack"]] * len(blocks), pa.int64()), pa.array(blocks, pa.int64())], names=["pack", "block"]
                )

    return work


def _read(same: bool, first: int):
    """(pack, at, anchor_id, positive_id, id, score, positive_score): the first rows of a block in each window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                anchors, labels, a, windows = _pack(row)
                ids = np.frombuffer(row["block_ids"], np.int64)
                scores = dots(a, _matrix(row["block_vectors"], row["length"], len(ids)))
                columns: list[list] = [[] for _ in range(6)]
                for w in windows:
                    k = w["at"]
                    if (labels[k] == row["block_label"]) != same:
                        continue
                    own = scores[k]
                    found = np.flatnonzero((own >= w["low"]) & (own <= w["high"]) & (ids != anchors[k]))
                    if len(found) > first:
                        cut = np.partition(own[found], len(found) - first)[len(found) - first]
                        found = found[own[found] >= cut]
                    found = found[np.lexsort((ids[found], -own[found]))][:first]
                    n = len(found)
                    for column, x in zip(
                        columns, ([k] * n, [anchors[k]] * n, [w["positive_id"]] * n, ids[found], own[found], [w["score"]] * n),
                        strict=True,
                    ):
                        column.extend(x)
                kinds = [pa.int32(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["pack"]] * len(columns[0]), pa.int64()), *[pa.array(x, t) for x, t in zip(columns, kinds, strict=True)]],
                    names=["pack", "at", "anchor_id", "positive_id", "id", "score", "positive_score"],
                )

    return work


_FOUND = "pack long, at int, anchor_id long, positive_id long, id long, score long, positive_score long"


def _search(packs: DataFrame, zones: DataFrame, blocks: DataFrame, windows: DataFrame, same: bool, first: int, best_only: bool, name: str) -> DataFrame:
    """Written first rows of every window (pack, at, positive_id, score, low, high), over all its blocks."""
    asked = windows.groupBy("pack").agg(
        F.collect_list(F.struct("at", "positive_id", "score", "low", "high")).alias("windows")  # of one pack's anchors
    )
    packs = packs.join(asked, "pack")
    pairs = packs.join(zones, "length").drop("share").mapInArrow(_choose(same, best_only), "pack long, block long")
    chosen = c.kept_table(pairs, f"{name}-blocks")
    rows = chosen.join(packs, "pack").join(
        blocks.select("block", F.col("label").alias("block_label"), F.col("ids").alias("block_ids"), F.col("vectors").alias("block_vectors")),
        "block",
    )
    found = rows.mapInArrow(_read(same, first), _FOUND)
    return c.kept_table(
        found.selectExpr(
            "*", "row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank"
        ).where(F.col("rank") <= first),
        name,
    )


def hard_negatives(
    rows: DataFrame, block_rows: int = BLOCK_ROWS, pack_rows: int = PACK_ROWS, zones: int = ZONES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    placed = on_curve(prepared_rows(c.prepared(rows)))
    blocks = _ordered(placed, True, block_rows, "blocks")
    packs = _ordered(placed.where(f"vec_id % {ANCHOR_STEP} = 0"), False, pack_rows, "packs")
    packs = packs.select(F.col("block").alias("pack"), "length", "ids", "labels", "vectors")
    shares = max(1, -(-blocks.count() // zones))
    maps = c.kept_table(
        blocks.select("block", "length", "label", "low", "high")
        .groupBy("length", F.expr(f"pmod(xxhash64(block), {shares})").alias("share"))
        .agg(F.collect_list(F.struct("block", "label", "low", "high")).alias("zones")),  # about ``zones`` of them
        "zone-maps",
    )
    every = packs.selectExpr(
        "pack", f"posexplode(array_repeat(0, cast(length(ids) / 8 AS int))) AS (at, none)"
    ).selectExpr("pack", "at", "cast(null AS long) AS positive_id", "0L AS score", f"{_LEAST}L AS low", f"{_MOST}L AS high")
    near = _search(packs, maps, blocks, every, True, POSITIVES, True, "nearest")
    floors = near.groupBy("pack", "at").agg(
        F.expr(f"CASE WHEN count(*) >= {POSITIVES} THEN min(score) END").alias("floor")
    )
    from_floor = every.join(floors, ["pack", "at"], "left").selectExpr(
        "pack", "at", "positive_id", "score", "coalesce(floor, low) AS low", "high"
    )
    positives = _search(packs, maps, blocks, from_floor, True, POSITIVES, False, "positives")
    windows = positives.selectExpr(
        "pack", "at", "id AS positive_id", "score", "-((-4 * score) div 5 - CASE WHEN (-4 * score) % 5 < 0 THEN 1 ELSE 0 END) AS low",
        "score AS high",
    ).where("low <= high")
    found = _search(packs, maps, blocks, windows, False, NEGATIVES, False, "negatives")
    return found.selectExpr(
        "anchor_id", "positive_id", "cast(rank AS int) AS rank", "id AS negative_id", "positive_score", "score AS negative_score"
    )


def oracle_sql() -> str:
    """The same rows in DuckDB SQL, every anchor with every row."""
    return f"""
        WITH taking_part AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x) AND abs(x) < {LARGEST}]) = len(embedding)
        ), r AS (
            SELECT * FROM taking_part QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1
        ), scores AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
                   coalesce(list_dot_product(a.v, b.v), 0)::BIGINT AS score
            FROM r a JOIN r b ON a.vec_id % {ANCHOR_STEP} = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        ), positives AS (
            SELECT * FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
        )
        SELECT p.anchor_id, p.id AS positive_id,
               (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
               n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= {NEGATIVES}
    """
