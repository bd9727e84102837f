"""The pipeline's rows against its stages done plainly."""

import zlib

import messy
import numpy as np
import test_dedup
import test_text

import corpus_pipeline
from pactlens.llm import quality


def test_pipeline(spark, tmp_path):
    folder = tmp_path / "sf"
    messy.table(spark).write.parquet(str(folder / "documents.parquet"))
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    rows = [(r["doc_id"], r["text"]) for r in quality.drop_rejected(docs).select("doc_id", "text").collect()]
    seen: dict[str, tuple] = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        seen.setdefault(test_dedup.normal(text), (i, text))
    rows = list(seen.values())
    component = test_dedup.brute_components(rows)
    rows = [(i, t) for i, t in rows if i is None or component[i] == i]
    texts = {i: t for i, t in rows}
    expected = {}
    first: dict[tuple, int] = {}
    for i, t in sorted((r for r in rows if r[0] is not None)):
        w = messy.words(t)
        keep = [True] * len(w)
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k : k + 50]), i) < i:
                keep[k : k + 50] = [False] * 50
        kept = [x for x, y in zip(w, keep, strict=True) if y]
        expected[i] = texts[i] if all(keep) else b" ".join(kept).decode()
    found = corpus_pipeline.run(spark, str(folder)).collect()
    assert {r["doc_id"] for r in found if r["doc_id"] is not None} == set(expected)
    for i, text in expected.items():
        ids = test_text.plain_ids(text)
        own = sorted((r["piece"], r["ids_crc32"]) for r in found if r["doc_id"] == i)
        sums = [zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes()) for a in range(0, len(ids), 2048)]
        assert own == list(enumerate(sums)), i


def test_stages_keep_the_columns(spark, tmp_path):
    docs = messy.table(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns, name
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "minhash near-dedup", "substring dedup", "best-fit packing",
    ]


def test_empty_pipeline(spark, tmp_path):
    messy.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
