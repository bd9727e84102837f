"""A small table with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile(rb"[^\x20\x09-\x0D]+")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        *[T.StructField(n, T.StringType()) for n in ("kept", "tag", "spans", "n_words", "language", "m", "c0", "node", "Row")],
    ]
)


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def prose(rng: random.Random, n: int, alphabet: str = "abcdefg") -> str:
    made = ["".join(rng.choices(alphabet, k=rng.randint(1, 6))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "\n", ". ", "\t"]) for w in made)


def rows() -> list[tuple]:
    rng = random.Random(5)
    texts: list[tuple[int | None, str | None, str | None]] = []
    passage = prose(rng, 80)
    base = prose(rng, 120)
    for i in range(40, 70):
        texts.append((i, prose(rng, rng.randint(5, 150), "abcdefg" if i % 2 else "öüßtuvw"), "en" if i % 2 else "de"))
    for i in range(70, 78):  # near copies with a changed word or two
        changed = base.split(" ")
        changed[rng.randrange(len(changed))] = f"new{i}"
        texts.append((i, " ".join(changed), "en"))
    for i in range(78, 83):  # a passage inside other text
        texts.append((i, prose(rng, 30) + passage + prose(rng, 25), "en"))
    texts += [
        (10, base, "en"), (9, base.replace(" ", "  "), "en"), (11, base, "en"), (11, base, "en"),
        (12, None, "en"), (13, "", None), (14, " \n\t ", "de"), (15, "one", "de"), (16, "one", "en"),
        (17, "!!! ### 123", "fr"), (None, base, "en"), (None, None, None), (None, None, None),
        (18, "漢字 🙂   x\u0085y é" * 9, "zh"), (19, "same line\n" * 40, "en"),
        (20, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License. More.", "xx-odd"),
        (21, (passage + " ") * 3, "en"), (22, "w " * 9000 + passage, "en"),
        (23, "A\x00b \x01 c \x1c d", "en"), (24, "<|endoftext|> it's 've 12345", "en"),
        (25, prose(rng, 12000), "en"),
    ]
    return [(i, t, l, None if k % 7 == 0 else "src0", None if t is None else len(t), *["x"] * 9) for k, (i, t, l) in enumerate(texts)]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_set(df, *names):
    return sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect())))
