"""MinHash near-duplicates with fast similarity sketching.

A document's set holds the 64-bit hashes of its different two-word shingles (A-Z lower-cased; one
word alone is its own shingle). A sketch has ``COORDINATES`` values. In round i every shingle is
hashed anew and thrown into a bin with the value (i, hash); a bin keeps its smallest. Rounds stop as
soon as all bins of a document are filled; from round ``COORDINATES`` on, round i fills exactly
bin i - ``COORDINATES``, so 2 * ``COORDINATES`` rounds always suffice. The share of equal
coordinates estimates the Jaccard similarity with bounds as tight as for independent hashes.

Bands of ``ROWS_A_BAND`` coordinates give buckets. At similarity 0.8 a pair misses all 40 buckets
with probability (1 - 0.8**6)**40 = 5e-6. Equal sets (128-bit hash of the set) become one node first.
Then links are confirmed on full sets, in three passes that never list all pairs of a bucket:
 1. every node of a bucket against the bucket's smallest node, its centre;
 2. the nodes of a bucket that are not in its centre's component (strays) against one of them;
 3. what strays are left against the other components of the bucket, pruned by exact bounds. Two
    nodes share at most the smaller one of the numbers of shingles they share with the centre, plus
    the shingles that both have beside the centre's. For each range of partner sizes this tells how
    many of the latter a stray must share; then one of all but that many less one is shared too,
    whichever are left out, so the most frequent ones are. Partners are found by a join on the rest.
    A stray that needs none of them is compared with all partners of that range of sizes. Each node
    also has a bitmap of its shingles beside the centre's; the bits that two bitmaps share, plus what
    fell on bits already set, bound the shingles the two share there. Only pairs whose bound reaches
    the limit leave the join.
Two nodes of one component need no test, so the components are those of all confirmed candidates.

Rows: null or blank texts have an empty set, link with nothing and stay; a null doc_id has no
component and stays; rows that repeat a doc_id count as one document that has the links of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.llm import common as c
from pactlens.llm.graph import components

BANDS, ROWS_A_BAND = 40, 6
COORDINATES = BANDS * ROWS_A_BAND
MEMBERS_A_PART = 400
BITMAP = 8  # words of 64 bits

_FREE = np.iinfo(np.int64).max
_SEEDS = c.splitmix(2 * COORDINATES, 101)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different shingle hashes of all documents one after another, and their offsets."""
    low = c.ascii_lower(raw)
    starts, ends, counts = c.word_spans(low, offsets)
    words = c.span_hashes(low, starts, ends)
    pairs = c.gram_hashes(words, 2)
    at = np.concatenate(([0], np.cumsum(counts)))
    sets = []
    for i, n in enumerate(counts.tolist()):
        if n >= 2:
            sets.append(np.unique(pairs[at[i] : at[i] + n - 1]))
        else:
            sets.append(words[at[i] : at[i] + n])
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return flat, np.concatenate(([0], np.cumsum(sizes)))


def sketches(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, coordinates) int64; rows of empty sets keep the value of a free bin."""
    sizes = np.diff(offsets)
    n = len(sizes)
    out = np.full(n * COORDINATES, _FREE, np.int64)
    owner = np.repeat(np.arange(n), sizes)
    items, doc = flat, owner
    for i in range(2 * COORDINATES):
        if not len(items):
            break
        h = c.mix(items ^ _SEEDS[i])
        value = (h & np.uint64(0x7FFFFFFF)).astype(np.int64) | (i << 31)
        if i < COORDINATES:
            place = ((h >> np.uint64(31)) % np.uint64(COORDINATES)).astype(np.int64)
        else:
            place = i - COORDINATES
        np.minimum.at(out, doc * COORDINATES + place, value)
        open_ = (out.reshape(n, COORDINATES) == _FREE).any(axis=1)
        stays = open_[doc]
        if not stays.all():
            items, doc = items[stays], doc[stays]
    return out.reshape(n, COORDINATES)


def band_buckets(sketch: np.ndarray) -> np.ndarray:
    """(documents, bands) bucket ids; the band's number is part of the id."""
    parts = sketch.view(np.uint64).reshape(len(sketch), BANDS, ROWS_A_BAND)
    factors = c.splitmix(ROWS_A_BAND, 202) | np.uint64(1)
    mixed = (c.mix(parts) * factors).sum(axis=2, dtype=np.uint64)
    return c.mix(mixed ^ c.splitmix(BANDS, 203))


@c.returning
def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = c.buffers(batch.column("text"))
        for i, j, part, at in c.slices(raw, offsets):
            flat, bounds = shingle_sets(part, at)
            sizes = np.diff(bounds)
            full = sizes > 0
            buckets = band_buckets(sketches(flat, bounds)[full])
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(c.mix(flat), dtype=np.uint64)))
            other = np.concatenate(
                (np.zeros(1, np.uint64), np.cumsum(c.mix(flat ^ np.uint64(77)), dtype=np.uint64))
            )
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(full * BANDS))), pa.int32()),
                pa.array(c.signed(buckets.reshape(-1))),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(i, j - i),
                    pa.array(sizes),
                    pa.array(c.signed(total[bounds[1:]] - total[bounds[:-1]])),
                    pa.array(c.signed(other[bounds[1:]] - other[bounds[:-1]])),
                    lists,
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "buckets"],
            )


_BITS = [f"bits_{i}" for i in range(BITMAP)]
_DETAILS = ["node", "centre", "size", "common", "rest", *_BITS]


def _bitmap(shingles: np.ndarray) -> np.ndarray:
    out = np.zeros(BITMAP, np.uint64)
    word = ((shingles >> np.uint64(6)) % np.uint64(BITMAP)).astype(np.int64)
    np.bitwise_or.at(out, word, np.uint64(1) << (shingles & np.uint64(63)))
    return out


def _against_centre(batches: Iterator[pa.RecordBatch], details: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a (centre, part) arrive together, the centre's own text first.

    Gives the links (a, b), or for every member its size, its shingles shared with the centre, the
    others, and a bitmap of these.
    """
    group, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        keys = list(zip(batch.column("centre").to_pylist(), batch.column("part").to_pylist(), strict=True))
        first = batch.column("first").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        raw, offsets = c.buffers(batch.column("text"))
        for i, j, part, at in c.slices(raw, offsets):
            flat, bounds = shingle_sets(part, at)
            nodes, centres, sizes, common, others, maps = [], [], [], [], [], []
            for k in range(i, j):
                mine = flat[bounds[k - i] : bounds[k - i + 1]]
                if first[k]:
                    own = mine if group != keys[k] else np.union1d(own, mine)
                    group = keys[k]
                elif group == keys[k] and len(own) and len(mine):
                    places = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                    there = own[places] == mine
                    shared = int(there.sum())
                    if details or 100 * shared >= 80 * (len(own) + len(mine) - shared):
                        nodes.append(ids[k])
                        centres.append(keys[k][0])
                        sizes.append(len(mine))
                        common.append(shared)
                        if details:
                            beside = mine[~there]
                            others.append(c.signed(beside))
                            maps.append(_bitmap(beside))
            ends = [pa.array(nodes, pa.int64()), pa.array(centres, pa.int64())]
            if not details:
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])
            else:
                more = [pa.array(sizes, pa.int64()), pa.array(common, pa.int64())]
                rest = pa.array(others, pa.list_(pa.int64()))
                words = np.array(maps, np.uint64).reshape(len(nodes), BITMAP)
                columns = [pa.array(c.signed(np.ascontiguousarray(words[:, i]))) for i in range(BITMAP)]
                yield pa.RecordBatch.from_arrays([*ends, *more, rest, *columns], names=_DETAILS)


@c.returning
def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _against_centre(batches, False)


@c.returning
def _details(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _against_centre(batches, True)


def _routed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Texts sent to the centres of the pairs (node, centre), each centre's own text first.

    A centre with many members gets several parts of them, each with a copy of the centre's text,
    so no task holds more than one set and a stream of texts.
    """
    sizes = pairs.groupBy("centre").agg(
        F.expr(f"cast(ceil(count(*) / {MEMBERS_A_PART}) AS int)").alias("parts")
    )
    members = pairs.join(sizes, "centre").select(
        F.col("node").alias("doc_id"),
        "centre",
        F.expr("cast(pmod(xxhash64(node, centre), parts) AS int)").alias("part"),
        F.lit(False).alias("first"),
    )
    centres = sizes.select(
        F.col("centre").alias("doc_id"),
        "centre",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("first"),
    )
    routes = c.kept_table(members.unionByName(centres), "routes")
    return (
        texts.join(routes, "doc_id")
        .repartition("centre", "part")
        .sortWithinPartitions("centre", "part", F.desc("first"))
        .select("centre", "part", "first", "doc_id", "text")
    )


def _confirmed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (node, centre) whose full sets are similar enough, as edges (a, b)."""
    return _routed(texts, pairs).mapInArrow(_links, "a long, b long")


_CARRIED = ["node", "size", "common", "component", "unseen", *_BITS]
_STEP = "cast(floor(ln({}) / ln(1.03D)) AS int)"  # ranges of set sizes, 3 % wide


def _pairs_of_strays(texts: DataFrame, marked: DataFrame) -> DataFrame:
    """Pairs (node, other) of a stray and a node of another component that can reach the limit.

    ``marked``: bucket, node, centre, component, stray of the buckets that have strays.
    """
    nodes = c.kept_table(
        marked.where("node <> centre")
        .groupBy("node", "centre", "component")
        .agg(F.max("stray").alias("stray")),
        "compared",
    )
    known = c.kept_table(
        _routed(texts, nodes.select("node", "centre"))
        .mapInArrow(
            _details,
            "node long, centre long, size long, common long, rest array<long>, "
            + ", ".join(f"{b} long" for b in _BITS),
        )
        .join(nodes, ["node", "centre"])
        # elements that fell on a bit already set
        .withColumn("unseen", F.expr(f"size - common - ({' + '.join(f'bit_count({b})' for b in _BITS)})")),
        "details",
    )
    others = known.select(
        "centre", F.expr(_STEP.format("size")).alias("step"),
        *[F.col(n).alias(f"other_{n}") for n in _CARRIED], "rest",
    )
    strays = known.where("stray")
    of_strays = strays.select("centre", "node", F.explode("rest").alias("shingle"))
    frequency = (
        known.select("centre", F.explode("rest").alias("shingle"))
        .join(of_strays.select("centre", "shingle").distinct(), ["centre", "shingle"], "left_semi")
        .groupBy("centre", "shingle")
        .agg(F.count("*").alias("n"))
    )
    rare_first = (
        of_strays.join(frequency, ["centre", "shingle"])
        .groupBy("centre", "node")
        .agg(F.expr("transform(array_sort(collect_list(struct(n, shingle))), x -> x.shingle)").alias("ordered"))
    )
    # sizes from 0.8 to 1.25 times the own; 9 * shared >= 4 * (size + other size) is the limit
    wanted = (
        strays.join(rare_first, ["centre", "node"], "left")
        .withColumn("step", F.explode(F.expr(
            f"sequence({_STEP.format('greatest(1D, 0.8D * size)')}, {_STEP.format('1.25D * size')})"
        )))
        .withColumn("needed", F.expr(
            "cast(ceil(4 * (size + floor(exp(step * ln(1.03D)))) / 9) AS long) - common"
        ))
    )
    bits = " + ".join(f"bit_count({b} & other_{b})" for b in _BITS)
    bound = (
        f"component <> other_component AND 9 * (least(common, other_common) + {bits}"
        " + least(unseen, other_unseen)) >= 4 * (size + other_size)"
    )
    fields = ["centre", "step", *_CARRIED]
    sharing = wanted.where("needed > 0 AND needed <= size - common").select(
        *fields, F.explode(F.expr("slice(ordered, 1, cast(size - common - needed + 1 AS int))")).alias("shingle")
    )
    shared = sharing.join(
        others.select("*", F.explode("rest").alias("shingle")).drop("rest"), ["centre", "step", "shingle"]
    )
    plain = wanted.where("needed <= 0").select(*fields).join(others.drop("rest"), ["centre", "step"])
    ends = ["node", F.col("other_node").alias("other")]
    return shared.where(bound).select(*ends).unionByName(plain.where(bound).select(*ends))


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """Different pairs (node, centre), the smaller one as the centre, without those already tested."""
    ordered = pairs.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("centre"))
    return ordered.distinct().join(tested, ["node", "centre"], "left_anti")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    texts = c.prepared(c.pick(docs, "doc_id", "text"))
    found = c.kept_table(
        texts.mapInArrow(
            _sketch_batches, "doc_id long, n_shingles long, set_a long, set_b long, buckets array<long>"
        ),
        "sketches",
    )
    usable = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = c.kept_table(usable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node")), "nodes")
    placed = (
        usable.join(nodes, ["set_a", "set_b"])
        .where("doc_id = node")
        .select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    )
    shared = (
        placed.groupBy("bucket")
        .agg(F.min("node").alias("centre"), F.max("node").alias("last"))
        .where("centre < last")
        .select("bucket", "centre")
    )
    shared = c.kept_table(shared, "buckets")
    placed = c.kept_table(placed.join(shared, "bucket"), "placed")
    involved = c.kept_table(
        texts.join(placed.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi"), "texts"
    )

    tested = c.kept_table(
        placed.where("node <> centre").select("node", "centre").distinct(), "pairs-1"
    )
    edges = c.kept_table(_confirmed(involved, tested), "links-1")
    labels = c.kept_table(components(edges), "labels-1")

    of_centres = labels.select(F.col("node").alias("centre"), F.col("component").alias("main"))
    marked = c.kept_table(
        placed.join(labels, "node", "left")
        .join(of_centres, "centre", "left")
        .select(
            "bucket", "node", "centre", "n_shingles",
            F.coalesce("component", "node").alias("component"),
            F.coalesce("main", "centre").alias("main"),
        ),
        "marked",
    )
    strays = marked.where("component <> main")
    picks = strays.groupBy("bucket").agg(
        F.min_by(F.struct("node", "component"), F.xxhash64("node", "bucket")).alias("pick")
    )
    pairs = strays.join(picks, "bucket").where("component <> pick.component")
    pairs = c.kept_table(_untested(pairs.select("node", F.col("pick.node").alias("other")), tested), "pairs-2")
    tested = tested.unionByName(pairs)
    more = c.kept_table(_confirmed(involved, pairs), "links-2")

    # links to picks make labels coarser already; the rest is up to the components at the end
    both = more.unionByName(more.select(F.col("b").alias("a"), F.col("a").alias("b")))
    of_nodes = marked.select("node", "component").distinct()
    closer = (
        both.join(of_nodes.select(F.col("node").alias("b"), F.col("component").alias("far")), "b")
        .join(of_nodes.select(F.col("node").alias("a"), F.col("component").alias("own")), "a")
        .groupBy(F.col("own").alias("component"))
        .agg(F.min("far").alias("far"))
        .where("far < component")
    )
    closer = c.kept_table(closer, "closer")
    open_ = strays.select("bucket").distinct()
    marked = (
        marked.join(open_, "bucket", "left_semi")
        .join(closer, "component", "left")
        .join(closer.select(F.col("component").alias("main"), F.col("far").alias("main_far")), "main", "left")
        .select(
            "bucket", "node", "centre",
            F.coalesce("far", "component").alias("component"),
            F.expr("coalesce(far, component) <> coalesce(main_far, main)").alias("stray"),
        )
    )
    pairs = c.kept_table(_untested(_pairs_of_strays(involved, marked), tested), "pairs-3")
    more = more.unionByName(c.kept_table(_confirmed(involved, pairs), "links-3"))
    # the labels already found stand for the links of the first pass
    known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    labels = c.kept_table(components(known.unionByName(more)), "labels")

    return (
        found.select("doc_id", "n_shingles", "set_a", "set_b")
        .join(nodes, ["set_a", "set_b"], "left")
        .join(labels, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.expr(
                "CASE WHEN n_shingles > 0 AND doc_id IS NOT NULL"
                " THEN coalesce(component, node) ELSE doc_id END"
            ).alias("component_id"),
        )
        .withColumn("kept", F.expr("coalesce(doc_id = component_id, true)"))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document stays: one of each component."""
    judged = c.kept_table(near_duplicates(docs), "near-duplicates")
    return c.without_ids(docs, c.kept_table(judged.where("NOT kept").select("doc_id").distinct(), "gone"))
