"""Quality rules, language profiles, byte-level BPE, licences, packing and the url filter."""

import base64
import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import messy
import numpy as np
import pytest
from pyspark.sql import functions as F

from pactlens.llm import bpe, langid, licences, linkgraph, packing, quality, tokens


@pytest.fixture(scope="module")
def docs(spark):
    return messy.table(spark).cache()


# ---- quality rules ----


def base_counts(text):
    w = messy.words(text)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = set()
    for k in range(len(w) - 4):
        if grams[tuple(w[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if messy.words(x)]
    return (
        len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def brute_model(rows):
    """Modified Kneser-Ney by the textbook; probability of a symbol after three others."""
    order, tables = quality.ORDER, defaultdict(Counter)
    for language, text in rows:
        data = b"\x02" * 3 + bytes(quality._SYMBOLS[np.frombuffer(text.encode(), np.uint8)])
        for i in range(3, len(data)):
            tables[language, order][data[i - 3 : i + 1]] += 1
    for language in {l for l, _ in rows}:
        for n in range(order - 1, 0, -1):
            for gram in tables[language, n + 1]:
                tables[language, n][gram[1:]] += 1

    def discounts(counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        return [
            max(0.1, 1 - 2 * y * n[2] / n[1]) if n[1] else 0.5,
            max(0.1, 2 - 3 * y * n[3] / n[2]) if n[2] else 1.0,
            max(0.1, 3 - 4 * y * n[4] / n[3]) if n[3] else 1.5,
        ]

    taken = {k: discounts(v) for k, v in tables.items()}
    by_context = defaultdict(list)
    for (language, n), counts in tables.items():
        for gram, count in counts.items():
            by_context[language, n, gram[:-1]].append(count)

    def p(language, gram):
        n = len(gram)
        if not n:
            return 1 / 256
        counts = by_context.get((language, n, gram[:-1]))
        if not counts:
            return p(language, gram[1:])
        d = taken[language, n]
        count = tables[language, n][gram]
        own = count - d[min(count, 3) - 1] if count else 0
        return own / sum(counts) + sum(d[min(x, 3) - 1] for x in counts) / sum(counts) * p(language, gram[1:])

    return p


def language_of(lang):
    return lang.lower() if lang and re.fullmatch("[a-z]{2,3}", lang.lower()) else "und"


def test_base_counts_and_perplexity(spark, docs):
    rows = [(language_of(r[2]), r[1]) for r in messy.rows() if r[1] is not None]
    one = brute_model([*rows, *(("*", t) for _, t in rows)])
    p = lambda language, gram: (one(language, gram) + one("*", gram)) / 2
    found = quality.verdicts(docs).collect()
    assert len(found) == len(messy.rows())
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] not in (None, 11)}
    off = 0
    for i, text, lang, *_ in messy.rows():
        if i in (None, 11):
            continue
        r, counts = by_id[i], base_counts(text)
        assert tuple(r[n] for n in quality.BASE) == counts, i
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        if text and len(text) < 2000:
            data = b"\x02" * 3 + bytes(quality._SYMBOLS[np.frombuffer(text.encode(), np.uint8)])
            mean = -sum(math.log(p(language_of(lang), data[k - 3 : k + 1])) for k in range(3, len(data)))
            off = max(off, abs(mean / (len(data) - 3) - r["surprise"]))
    assert off < 1e-6


def test_bands_keep_prose_and_reject_noise(spark):
    rng = random.Random(8)
    rows = [(i, messy.prose(rng, 120, "abcdefg"), "en") for i in range(300)]
    rows += [(1000 + i, messy.prose(rng, 120, "0#~QZ^@xywvu"), "en") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in quality.verdicts(df).where("kept").collect()}
    assert len(kept & set(range(300))) >= 299 and not kept & {1000, 1001, 1002}


def test_kept_equals_the_bands_worked_out_plainly(spark):
    rng = random.Random(4)
    words = {l: ["".join(rng.choices(a, k=rng.randint(2, 6))) for _ in range(300)] for l, a in (("en", "abcdef"), ("de", "efghij"))}
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "de"])
        text = rng.choices(words[lang], k=rng.choice([5, 15, 60, 200]))
        if i % 10 == 0:
            text = [w + rng.choice(["###", "|", " |", "é"]) for w in text]
        if i % 35 == 0:
            text = ["".join(rng.choices("qxyz#|", k=5)) for _ in text]
        rows.append((i, " ".join(text), lang))
    df = spark.createDataFrame([*rows, (900, None, "en"), (901, "", None)], "doc_id long, text string, lang string")
    found = quality.verdicts(df).collect()
    band = {}
    for lang in ("en", "de"):
        own = [r for r in found if r["language"] == lang and not r["base_failed"]]
        for value, least in (("surprise", quality.LEAST_DEVIATION), ("word_surprise", quality.LEAST_WORD_DEVIATION)):
            steps = np.array([round(r[value] / quality.STEP) for r in own])
            middle = np.median(steps)
            away = np.median(np.abs(steps - middle))
            band[lang, value] = middle * quality.STEP, max(least, 1.4826 * away * quality.STEP)
    fell = Counter()
    for r in found:
        if r["base_failed"]:
            assert not r["kept"]
            continue
        wider = math.sqrt(1 + quality.WIDER_BELOW_WORDS / r["n_words"])
        far = {v: (r[v] - band[r["language"], v][0]) / (band[r["language"], v][1] * wider) for v in ("surprise", "word_surprise")}
        bytes_in = -quality.BELOW <= far["surprise"] <= quality.ABOVE
        words_in = far["word_surprise"] <= quality.ABOVE_WORDS
        assert r["kept"] == (bytes_in and words_in), r
        fell[bytes_in, words_in] += 1
    assert fell[True, True] > 200 and fell[False, True] + fell[False, False] > 3 and fell[True, False] + fell[False, False] > 3


def test_drop_rejected(spark, docs):
    out = quality.drop_rejected(docs)
    assert out.schema == docs.schema
    kept = quality.verdicts(docs).where("kept").select("doc_id")
    assert messy.as_set(out, "doc_id") == messy.as_set(kept, "doc_id")
    assert messy.as_set(quality.drop_rejected(messy.empty(spark)), "doc_id") == []
    assert quality.verdicts(messy.empty(spark)).count() == 0


def test_hash_arrays_find():
    rng = np.random.default_rng(1)
    slots = np.unique(rng.integers(0, quality.SLOTS, 5000)).astype(np.int64)
    arrays = quality.HashArrays(slots, np.arange(len(slots), dtype=np.float32) + 1)
    asked = rng.integers(0, quality.SLOTS, 20000).astype(np.int32)
    asked[:5000] = rng.choice(slots, 5000)
    values, there = arrays.find(asked)
    known = {int(s): k + 1 for k, s in enumerate(slots)}
    assert [known.get(int(s), 0) for s in asked] == values.tolist()
    assert there.tolist() == [int(s) in known for s in asked]


def test_symbol_and_pipe_noise_is_rejected(spark):
    """Noise that is common enough to be learned by a model of all documents."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 5))) for _ in range(400)]
    text = lambda sign: " ".join(w + sign() for w in rng.choices(words, k=150))
    rows = [(i, text(lambda: ""), "en") for i in range(300)]
    rows += [(1000 + i, text(lambda: rng.choice(["###", "%%%", "&&&"])), "en") for i in range(30)]
    rows += [(2000 + i, text(lambda: " |"), "en") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in quality.verdicts(df).where("kept").collect()}
    assert len([i for i in kept if i < 1000]) >= 298 and not [i for i in kept if i >= 1000]


def test_no_model_entry_is_lost(spark, docs, monkeypatch):
    """Surprises equal brute force when most entries are joined."""
    rows = [(language_of(r[2]), r[1]) for r in messy.rows() if r[1] is not None]
    one = brute_model([*rows, *(("*", t) for _, t in rows)])
    plain = lambda t: [re.sub(rb"[0-9]", b"0", w.lower()) for w in messy.words(t)]

    def teaches(t):
        n, _, symbols, _, repeated = base_counts(t)
        return n >= 10 and 100 * repeated <= 20 * n and 10 * symbols <= n

    known = Counter(w for _, t in rows if teaches(t) for w in plain(t))
    monkeypatch.setattr(quality, "SLOTS", 40)  # the others are joined
    got = quality.verdicts(docs).where("doc_id <> 11").collect()
    found = {r["doc_id"]: r for r in got}
    assert messy.as_set(quality.drop_rejected(docs).where("doc_id <> 11"), "doc_id") == sorted(
        repr((r["doc_id"],)) for r in got if r["kept"]
    )
    for i, text, lang, *_ in messy.rows():
        if i in (None, 11) or not text or len(text) > 2000:
            continue
        data = b"\x02" * 3 + bytes(quality._SYMBOLS[np.frombuffer(text.encode(), np.uint8)])
        grams = [data[k - 3 : k + 1] for k in range(3, len(data))]
        mean = -sum(math.log((one(language_of(lang), g) + one("*", g)) / 2) for g in grams) / len(grams)
        own, taught = Counter(plain(text)), teaches(text)
        words = -sum(n * math.log((known[w] - n * taught + 0.5) / known.total()) for w, n in own.items())
        assert found[i]["surprise"] == pytest.approx(mean, abs=1e-6), i
        assert found[i]["word_surprise"] == pytest.approx(words / max(1, own.total()), abs=1e-6), i


# ---- language identification ----


def brute_grams(text):
    grams = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        for n in (1, 2, 3):
            grams.update(g for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if g != " ")
    # one-letter words stand between blanks, which are shared with their neighbours
    return grams


def ranked(grams):
    return sorted(grams, key=lambda g: (-grams[g], len(g), g))[: langid.PROFILE]


def test_language_distances(spark):
    rng = random.Random(2)
    rows = [
        (i, messy.prose(rng, rng.randint(1, 60), {"aa": "abcdé", "bb": "cdefg", "cc": "xyzab"}[l]), l)
        for i, l in enumerate(rng.choices(["aa", "bb", "cc"], k=120))
    ]
    rows += [(900, None, "aa"), (901, "12 34", None), (902, "abc abc", None), (None, "xyz", "cc"), (903, "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    totals = defaultdict(Counter)
    for i, text, lang in rows:
        if not held(i) and text is not None and lang is not None:
            totals[lang].update(brute_grams(text))
    profiles = {l: {g: k for k, g in enumerate(ranked(t))} for l, t in totals.items()}
    found = langid.predicted_languages(df).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for i, t, _ in rows if i == r["doc_id"])
        assert r["held_out"] == held(r["doc_id"])
        top = ranked(brute_grams(text or ""))
        if not top:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        far = {
            l: sum(abs(p[g] - k) if g in p else langid.PROFILE for k, g in enumerate(top))
            for l, p in profiles.items()
        }
        best = min(sorted(far), key=far.get)
        assert r["lang_pred"] == best
        assert r["score"] == pytest.approx(1 - far[best] / (langid.PROFILE * len(top)))


def test_language_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = langid.predicted_languages(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 30
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97


def test_language_messy(spark, docs):
    found = langid.predicted_languages(docs)
    assert found.count() == len(messy.rows())
    assert found.where("lang_pred IS NULL OR score < 0 OR score > 1").count() == 0
    assert langid.predicted_languages(messy.empty(spark)).count() == 0


# ---- byte-level BPE ----


def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    with open(bpe.default_vocabulary(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark, docs):
    reference = tiktoken_encoding()
    expected = []
    for i, text, *_ in messy.rows():
        ids = reference.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    found = bpe.round_trip(docs)
    assert messy.as_set(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(map(repr, expected))
    assert bpe.round_trip(messy.empty(spark)).count() == 0
    assert bpe.encoded(docs).where("doc_id = 24").first()["ids"] == reference.encode_ordinary(
        next(r[1] for r in messy.rows() if r[0] == 24)
    )


def test_bpe_states_are_bounded_inside_a_piece(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 500)
    encoder = bpe.Encoder(bpe.default_vocabulary(), bpe.default_pattern())
    rng = random.Random(9)
    piece = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    assert encoder.encode(piece) == tiktoken_encoding().encode_ordinary(piece)
    assert len(encoder.transducer.states) <= 500
    assert len(encoder.transducer.number) == len(encoder.transducer.steps) == len(encoder.transducer.states)


def test_bpe_random_strings(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 300)  # states are dropped and made again
    encoder = bpe.Encoder(bpe.default_vocabulary(), bpe.default_pattern())
    reference, rng = tiktoken_encoding(), random.Random(4)
    letters = "abc \n\t'stéßñ漢字🙂\x1c\x85\u2003\u200b0129!?$\u0301 thereing"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 40)))
        ids = encoder.encode(text)
        assert ids == reference.encode_ordinary(text), text
        assert b"".join(bpe.decode(encoder.vocabulary, ids, 3)) == text.encode()
    long = "ab" * 30_000 + "a" * 30_000
    assert encoder.encode(long) == reference.encode_ordinary(long)


def test_stream_decoder_gives_whole_characters():
    vocabulary = bpe.load(bpe.default_vocabulary(), bpe.default_pattern()).vocabulary
    stream = bpe.StreamDecoder(vocabulary)
    got = []
    for byte in "é漢🙂x".encode():
        part = stream.feed([vocabulary.rank[bytes([byte])]])
        part.decode()
        got.append(part)
    assert b"".join(got).decode() == "é漢🙂x" and stream.end() == b""
    stream.feed([vocabulary.rank[b"\xe6"]])
    assert stream.end() == b"\xe6"


# ---- licences ----


def test_licences(spark, docs):
    mit = " ".join(licences.SENTENCES[n] for n in ("mit-grant", "mit-notice", "mit-warranty"))
    bsd = "\n".join(licences.SENTENCES[n] for n in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))
    rows = [
        (1, mit.upper()), (2, bsd), (3, bsd.rsplit("\n", 1)[0]),
        (4, licences.SENTENCES["mit-notice"] + " " + licences.SENTENCES["mit-grant"]),
        (5, "x. Licensed under the Apache License,\tVersion 2.0.\nother words\nreleased under the MIT license"),
        (6, None), (7, "no licence"), (None, "Licensed under CC BY 4.0."),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["licences"], r["n_unmatched"]) for r in licences.scan(df).collect()}
    assert found == {
        1: ("MIT", 0), 2: ("BSD-3-Clause", 0), 3: ("BSD-2-Clause", 0), 4: ("", 2),
        5: ("MIT,Apache-2.0", 0), 6: ("", 0), 7: ("", 0), None: ("CC-BY-4.0", 0),
    }
    assert licences.scan(docs).count() == len(messy.rows())
    assert licences.scan(messy.empty(spark)).count() == 0


def test_wrapped_licences(spark):
    apache = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
    mit = "\n".join(
        textwrap.fill(licences.SENTENCES[n], 60) for n in ("mit-grant", "mit-notice", "mit-warranty")
    )
    marked = lambda text, mark: "\n".join(mark + x for x in text.split("\n"))
    rows = [
        (1, apache), (2, marked(apache, "# ")), (3, "/*\n" + marked(apache, " * ") + "\n */"),
        (4, marked(apache, "; ")), (5, bsd.replace("\n", "\r\n")), (6, marked(bsd, "// ")), (7, mit),
        (8, "Permission is\n\n" + mit.split("is", 1)[1]), (9, "Released under\n\nthe MIT License."),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["licences"] for r in licences.scan(df).collect()}
    assert found == {
        1: "Apache-2.0", 2: "Apache-2.0", 3: "Apache-2.0", 4: "Apache-2.0",
        5: "BSD-2-Clause", 6: "BSD-2-Clause", 7: "MIT", 8: "", 9: "",
    }


def test_a_rule_needs_the_whole_wording(spark):
    gpl3 = licences.gnu_rules()[0]["gpl-3.0-or-later-0"]
    hope = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without"
    other = gpl3.replace("version 3", "version 2").replace("software:", "software;")
    lesser = gpl3.replace("GNU General", "GNU Lesser General").replace("program", "library")
    rows = [
        (1, other + hope), (2, gpl3 + hope), (3, lesser + hope.replace("program", "library")), (4, lesser + hope),
        (5, gpl3.replace("GNU General", "GNU Affero General") + hope), (6, gpl3.replace("either ", "") + hope),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["licences"] for r in licences.scan(df).collect()}
    assert found == {
        1: "GPL-2.0-or-later", 2: "GPL-3.0-or-later", 3: "LGPL-3.0-or-later", 4: "", 5: "AGPL-3.0-or-later", 6: "",
    }


def test_every_licence_is_found_in_its_own_words(spark):
    sentences = {**licences.SENTENCES, **licences.gnu_rules()[0]}
    rules = [*licences.RULES, *licences.gnu_rules()[1]]
    told = [*[(x, " ".join(sentences[n] for n in names)) for x, names in rules],
            *[(x, s) for x, own in licences.references().items() for s in own]]
    rows = [(i, "Some words.\n\n# " + textwrap.fill(text, 50).replace("\n", "\n# ") + "\nand more") for i, (_, text) in enumerate(told)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["licences"], r["n_unmatched"]) for r in licences.scan(df).collect()}
    assert found == {i: (name, 0) for i, (name, _) in enumerate(told)}
    assert len({name for name, _ in told}) >= 50


def test_shared_and_nested_sentences(spark):
    known = {"a b": "ab", "a b c d": "abcd", "c d": "cd", "b c": "bc", "e": "e"}
    rules = [("both", ["abcd", "e"]), ("one", ["e"]), ("two", ["ab", "e"])]
    rows = [
        (1, "a b\nc d\ne"), (2, "A-B. C\nD; e"), (3, "a\nb\nc\n\nd"), (4, "a b c d e"), (5, "b\nc d"),
        (6, "a " * 300000 + "b"), (7, "a b x\na b.\te"), (8, "e\n" * 3000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["identifiers"], r["licences"]) for r in licences.scan(df, known, rules).collect()}
    assert found.pop(8) == (",".join(["e"] * 3000), "one")
    assert found == {
        1: ("abcd,e", "both"), 2: ("ab,cd,e", "one"), 3: ("ab,bc", ""), 4: ("", ""), 5: ("cd", ""),
        6: ("", ""), 7: ("ab,e", "two"),
    }


def test_licences_oracle(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    wrapped = [
        (-i, "words\n" + "".join(f" * {x}\r\n" for x in textwrap.wrap(" ".join(licences.SENTENCES[n] for n in names), width)))
        for i, (names, width) in enumerate(((names, width) for _, names in licences.RULES for width in (30, 72)), 1)
    ]
    odd = [(None, "Licensed under MIT.\nReleased under\nthe MIT\nLicense"), (-90, None), (-91, "A.\x0bB; C\x1fthis\nis")]
    docs = given.union(spark.createDataFrame([*wrapped, *odd], given.schema))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    result = con.execute(licences.oracle_sql())
    names = [d[0] for d in result.description]
    expected = sorted(map(repr, result.fetchall()))
    assert messy.as_set(licences.scan(docs), *names) == expected


# ---- packing ----


def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokens.default_tokenizer())
    return made


def plain_ids(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_those_of_the_tokenizer_file():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokens.default_tokenizer())
    texts = ["the end <|endoftext|> start", "a<|startoftext|>b <|endoftext|><|endoftext|>.", "plain words"]
    found = tokens.WordTokens(tokens.default_tokenizer()).ids([t.encode() for t in texts])
    expected = [made.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, np.uint32).tolist() for x in found] == expected
    assert expected[0] == [518, 806, 49407, 1572]


def test_plain_words_are_encoded_by_their_pieces():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokens.default_tokenizer())
    words = tokens.WordTokens(tokens.default_tokenizer())
    rng = random.Random(9)
    stems = ["House", "caf\xe9", "\xd6l", "it's", "3\xd75", "''ll", "</w>", "\u4e2d\u6587", "e\u0301", "\u0130", "<|endoftext|>", "\x1c", "\xff"]
    texts = [" ".join("".join(rng.choices([*stems, "A", "9", "!", "$$"], k=3)) for _ in range(5)) for _ in range(400)]
    found = words.ids([t.encode() for t in texts])
    assert [np.frombuffer(x, np.uint32).tolist() for x in found] == [made.encode(t, add_special_tokens=False).ids for t in texts]
    # words that differ in case and signs alone have their pieces in common
    few = tokens.WordTokens(tokens.default_tokenizer())
    few.ids([f"{w}{sign}".encode() for w in ("tree", "Tree", "TREE") for sign in ("", ".", ",", "!")])
    assert set(few.pieces) == {"tree", ".", ",", "!"} and len(few.known) == 12


def test_packed_pieces(spark, docs):
    rows = packing.packed_pieces(docs, capacity=256, open_bins=4, with_ids=True).collect()
    got = Counter()
    by_document = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] <= 1024
        by_document[r["doc_id"]].append(r)
    for i, text, *_ in messy.rows():
        got[i, tuple(plain_ids(text))] += 1
    for i, own in by_document.items():
        starts = sorted((r["piece"], r["start"], r["length"]) for r in own)
        assert all(piece * 256 == start for piece, start, _ in starts)
        if sum(1 for k in got if k[0] == i) == 1 and max(got[k] for k in got if k[0] == i) == 1:
            ids = b"".join(r["ids"] for r in sorted(own, key=lambda r: r["piece"]))
            assert (i, tuple(np.frombuffer(ids, np.uint32).tolist())) in got
    assert sum(r["length"] for r in rows) == sum(len(k[1]) * n for k, n in got.items())
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        places.sort()
        assert [p for p, _ in places] == np.cumsum([0, *[n for _, n in places]])[:-1].tolist()
        assert sum(n for _, n in places) <= 256
    assert packing.packed_pieces(messy.empty(spark)).count() == 0


def test_online_best_fit_is_bounded_and_best():
    rng = random.Random(6)
    packer = packing.OnlineBestFit(100, 3)
    free: dict[int, int] = {}
    for _ in range(2000):
        n = rng.randint(1, 100)
        fitting = [f for f in free.values() if f >= n]
        number, offset = packer.place(n)
        if fitting:
            assert free[number] == min(fitting) and offset == 100 - free[number]
        else:
            assert number not in free and offset == 0
            if len(free) == 3:
                full = min(free.values())
                del free[next(k for k, f in free.items() if f == full and k not in {b for v in packer.bins for b in v})]
        free[number] = 100 - offset - n
        if not free[number]:
            del free[number]
        assert packer.open == len(free) <= 3


def test_best_fit_decreasing():
    rng = random.Random(7)
    lengths = [rng.randint(1, 64) for _ in range(500)]
    bins = packing.best_fit_decreasing(lengths, 64)
    assert sorted(i for b in bins for i in b) == list(range(500))
    loads = [sum(lengths[i] for i in b) for b in bins]
    assert max(loads) <= 64
    free: list[int] = []  # the same by looking at every bin
    for n in sorted(lengths, reverse=True):
        fit = [k for k, f in enumerate(free) if f >= n]
        if fit:
            free[min(fit, key=lambda k: free[k])] -= n
        else:
            free.append(64 - n)
    assert len(free) == len(bins) and sorted(64 - f for f in free) == sorted(loads)


def test_packed_matrices_round_trip(spark, docs, tmp_path):
    packing.write_matrices(docs, str(tmp_path / "packed"), capacity=128, block_tokens=3000)
    pieces = defaultdict(dict)
    for r in spark.read.parquet(str(tmp_path / "packed")).collect():
        ids = np.frombuffer(r["ids"], np.uint32)
        positions = np.frombuffer(r["positions"], np.uint32)
        cuts = r["cu_seqlens"]
        assert len(ids) == 128 and cuts[0] == 0 and cuts[-1] == r["n_tokens"] <= 128
        assert not ids[r["n_tokens"] :].any()
        for segment, a, b in zip(r["segments"], cuts[:-1], cuts[1:], strict=True):
            assert positions[a:b].tolist() == list(range(b - a))
            pieces[segment["doc_id"]].setdefault((segment["start"], segment["piece"]), []).append(ids[a:b].tolist())
    for i, text, *_ in messy.rows():
        if i in (None, 11):
            continue
        parts = [pieces[i][k] for k in sorted(pieces[i])]
        assert all(len(p) == 1 for p in parts)
        assert [x for p in parts for x in p[0]] == plain_ids(text)
    assert packing.packed_sequences(messy.empty(spark)).count() == 0


# ---- url filter ----

PAGES = [
    (1, "https://Blog.X.Example.org/es/1?a#b", ""), (2, "http://example.org/en/17", None),
    (3, "http://sub.example.org/en/2", ""), (4, "http://a.com/fr/x", '<a href="http://good.net/x">'),
    (5, "http://a.com/de/x", ""), (6, "http://spam.net/1", "<a href='http://bad.com/de/1'><a HREF=//bad.com/>"),
    (7, "http://good.net/?q=://", ""), (8, "no scheme", ""), (9, None, "<a href='http://bad.com'>"),
    (10, "x://host", ""), (11, "http://bad.com/de/1", "<a href='/own'><a href='http://bad.com/de/2'>"),
    (12, "http://bad.com/en/", ""), (None, "http://myexample.org.com/en/1", ""), (12, "http://bad.com/en/", ""),
    (13, "http://notorg/x", ""), (14, "://h?x", ""), (15, "http://org/", ""),
]


def test_url_rules_and_hosts(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("host_", F.lit(1))
    found = {(r["page_id"], r["host"], r["path"]): (r["rule"], r["verdict"]) for r in linkgraph.judged_urls(df).collect()}
    assert found == {
        (1, "blog.x.example.org", "/es/1"): ("example.org/es/", "block"),
        (2, "example.org", "/en/17"): ("example.org/en/1", "block"),
        (3, "sub.example.org", "/en/2"): ("org/", "allow"),
        (4, "a.com", "/fr/x"): ("com/fr/", "allow"),
        (5, "a.com", "/de/x"): ("com/de/", "block"),
        (6, "spam.net", "/1"): (None, "block"),
        (7, "good.net", "/"): (None, "allow"),
        (8, "", ""): (None, "allow"), (9, "", ""): (None, "allow"),
        (10, "host", ""): (None, "allow"),
        (11, "bad.com", "/de/1"): ("com/de/", "block"),
        (12, "bad.com", "/en/"): (None, "block"),
        (None, "myexample.org.com", "/en/1"): (None, "allow"),
        (13, "notorg", "/x"): (None, "allow"),
        (14, "h", ""): (None, "allow"),
        (15, "org", "/"): ("org/", "allow"),
    }
    assert linkgraph.judged_urls(df.limit(0)).count() == 0
    assert linkgraph.judged_urls(df).count() == len(PAGES)


def test_spread_is_personalised_pagerank(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("d", "a", 1.0), ("c", "a", 3.0)]
    seeds = {"a": 0.75, "d": 0.25}
    share = dict(seeds)
    out = Counter()
    for s, _, w in edges:
        out[s] += w
    for _ in range(300):
        moved = Counter()
        for s, t, w in edges:
            moved[t] += 0.85 * share.get(s, 0) * w / out[s]
        lost = 1 - sum(moved.values())
        share = {h: moved[h] + lost * seeds.get(h, 0) for h in {*moved, *seeds}}
    found = linkgraph.spread(
        spark.createDataFrame(edges, "source string, target string, weight double"),
        spark.createDataFrame(list(seeds.items()), "host string, share double"),
    )
    assert {r["host"]: pytest.approx(r["share"], rel=1e-3) for r in found.collect()} == share


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    depth = 40
    rows = [(i, f"http://h{i}.net/", f"<a href='http://h{i + 1}.net/'>") for i in range(depth)]
    rows += [(depth, f"http://h{depth}.net/", "<a href='http://spam.com/de/'>"), (99, "http://spam.com/de/1", None)]
    rows += [(100, "http://apart.net/", "<a href='http://elsewhere.net/'>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    verdicts = {r["page_id"]: r["verdict"] for r in linkgraph.judged_urls(pages).collect()}
    assert verdicts == {**dict.fromkeys(range(depth + 1), "block"), 99: "block", 100: "allow"}
