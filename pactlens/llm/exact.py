"""Exact duplicates by deterministic block naming, in DataFrame operations only.

The normalised text (every run of ``[\\x20\\x09-\\x0D]`` one space; null is empty) is cut into blocks
of ``BLOCK`` bytes. All different blocks are sorted and numbered; then two neighbouring names become
one, by sorting and numbering the different pairs, until each document has a single name. Documents
of equally many blocks have the same name only if their texts are equal byte for byte.

Block texts are shuffled once, after equal blocks of a task have been merged. Occurrences find
their block's name by a 128-bit fingerprint. That no two different blocks share one is checked on
every run; if two did, the run is repeated with another seed, so no collision can reach a name.
Groups of copies of any size meet only in combined aggregates and in joins that Spark can split.

Rows: null doc_ids sort last; of rows that repeat doc_id and text exactly one is kept; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlens.llm.common import BLANKS, kept_table, pick, text_tag

BLOCK = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _cut(rows: DataFrame, *carried: str) -> DataFrame:
    """One row per block of ``body``: the carried columns, n_blocks, pos, block."""
    sized = rows.withColumn("n_blocks", F.expr(f"greatest(1, cast(ceil(length(body) / {BLOCK}) AS int))"))
    return sized.select(
        *carried,
        "n_blocks",
        "body",
        F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("pos"),
    ).select(
        *carried, "n_blocks", "pos", F.expr(f"substring(body, pos * {BLOCK} + 1, {BLOCK})").alias("block")
    )


def _print(seed: int) -> list[Column]:
    return [
        F.xxhash64(F.lit(seed), "block").alias("print_a"),
        F.xxhash64("block", F.lit(seed)).alias("print_b"),
    ]


def _numbered(different: DataFrame, *keys: str) -> DataFrame:
    """Sort the different keys of every partition and number them; names are unique."""
    return different.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _block_names(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences (row, doc_id, tag, text_sha256, n_blocks, pos, name) and their count of levels."""
    body = docs.select("doc_id", "text", normalised(F.col("text")).alias("norm"))
    seed = 0
    while True:
        different = _cut(body.select(F.col("norm").cast("binary").alias("body"))).select("block").distinct()
        names = kept_table(
            _numbered(different, "block").select(*_print(seed), "name"), "block-names"
        )
        if names.groupBy("print_a", "print_b").count().where("count > 1").isEmpty():
            break
        seed += 1
    rows = body.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        text_tag(F.col("text")).alias("tag"),
        F.sha2("norm", 256).alias("sha"),
        F.col("norm").cast("binary").alias("body"),
    )
    seen = _cut(rows, "row", "doc_id", "tag", "sha").select(
        "row",
        F.expr("CASE WHEN pos = 0 THEN doc_id END").alias("doc_id"),
        F.expr("CASE WHEN pos = 0 THEN tag END").alias("tag"),
        F.expr("CASE WHEN pos = 0 THEN sha END").alias("text_sha256"),
        "n_blocks",
        "pos",
        *_print(seed),
    )
    return kept_table(seen, "block-places"), names


def identities(docs: DataFrame) -> DataFrame:
    """(row, doc_id, tag, text_sha256, n_blocks, name): equal texts share n_blocks and name."""
    places, names = _block_names(pick(docs, "doc_id", "text"))
    heads = places.where("pos = 0").select("row", "doc_id", "tag", "text_sha256", "n_blocks")
    level = kept_table(
        places.select("row", "n_blocks", "pos", "print_a", "print_b")
        .join(names, ["print_a", "print_b"])
        .select("row", "n_blocks", "pos", "name", F.col("n_blocks").alias("width")),
        "names-0",
    )
    done = level.where("width = 1").select("row", "name")
    step = 0
    while not (open_ := level.where("width > 1")).isEmpty():
        step += 1
        pairs = kept_table(
            open_.groupBy("row", "n_blocks", "width", F.expr("pos div 2").alias("half"))
            .agg(
                F.max(F.expr("CASE WHEN pos % 2 = 0 THEN name END")).alias("left_name"),
                F.coalesce(F.max(F.expr("CASE WHEN pos % 2 = 1 THEN name END")), F.lit(-1)).alias("right_name"),
            )
            .select(
                "row", "n_blocks", F.col("half").alias("pos"), "left_name", "right_name",
                F.expr("cast(ceil(width / 2) AS int)").alias("width"),
            ),
            f"pairs-{step}",
        )
        pair_names = kept_table(
            _numbered(pairs.select("left_name", "right_name").distinct(), "left_name", "right_name"),
            f"pair-names-{step}",
        )
        level = kept_table(
            pairs.join(pair_names, ["left_name", "right_name"]).select("row", "n_blocks", "pos", "name", "width"),
            f"names-{step}",
        )
        done = done.unionByName(level.where("width = 1").select("row", "name"))
    return heads.join(done, "row")


def exact_copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and tag (of the raw text)."""
    named = kept_table(identities(docs), "identities")
    groups = named.groupBy("n_blocks", "name").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"),
        F.count("*").alias("group_size"),
    )
    groups = kept_table(
        groups.select(
            "n_blocks", "name", "group_size",
            F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"),
        ),
        "copy-groups",
    )
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", "keep_id", "group_size", F.expr("row = keep_row").alias("kept"), "text_sha256", "tag"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The keys of dropped rows are a written table, so Spark broadcasts them only below its own limit.
    """
    keys = kept_table(
        exact_copies(docs)
        .groupBy("doc_id", "tag")
        .agg(F.max("kept").alias("stays"), F.count("*").alias("n")),
        "copy-keys",
    )
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = (f"c{names.index(n)}" for n in ("doc_id", "text"))
    tagged = plain.withColumn("tag_", text_tag(F.col(text)))

    def on(side: DataFrame):
        return F.col(id_).eqNullSafe(side["doc_id"]) & F.col("tag_").eqNullSafe(side["tag"])

    gone = keys.where("NOT stays OR n > 1").select("doc_id", "tag")
    out = tagged.join(gone, on(gone), "left_anti")
    again = keys.where("stays AND n > 1").select("doc_id", "tag")
    if not again.isEmpty():
        out = out.unionByName(tagged.join(again, on(again), "left_semi").dropDuplicates([id_, "tag_"]))
    return out.drop("tag_").toDF(*names)
