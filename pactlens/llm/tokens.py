"""Token ids of whole texts with a tokenizer file whose pieces never reach across white space.

Every different word between ASCII blanks is encoded once and remembered; texts are then put
together from the ids of their words. Words of ASCII and Latin-1 letters and signs are first cut into
the pieces that the tokenizer's own rule cuts them into, as far fewer of these differ, and only new
pieces are encoded; all other words, and those of a tokenizer with another rule, are encoded whole.
The memories are emptied at a fixed size, which changes the time taken and nothing else.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from pactlens.llm import common as c

REMEMBERED_WORDS = 400_000
REMEMBERED_PIECES = 300_000
_MARK = "\x01"

# The rule of the public word tokenizer: NFC and lower case, then pieces of letters, single digits, or signs.
_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_RULE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
# Words of U+0021 to U+007E and U+00C0 to U+00FF, which NFC leaves as they are, and the same rule for them in lower case.
_PLAIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\xbf])+")
_CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._encode(_MARK)
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        rule = json.loads(self.tokenizer.to_str())
        self.cuts = all(rule[k] == v for k, v in _RULE.items()) and rule["model"]["dropout"] is None
        self.added = [a["content"].encode() for a in rule["added_tokens"]]
        # how the model spells the bytes of a letter
        self.spelling = {i: self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(i))[0][0] for i in range(0xC0, 0x100)} if self.cuts else {}

    def _encode(self, text: str) -> np.ndarray:
        [found] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.uint32)

    def _cut(self, words: list[bytes]) -> list[bytes]:
        """Learn the plain words by their pieces; returns the other words."""
        together = b" ".join(words)
        added = [a for a in self.added if a in together]
        plain, others = [], []
        for word in words:
            (plain if _PLAIN.fullmatch(word) and not (added and any(a in word for a in added)) else others).append(word)
        if not plain:
            return others
        cut = list(map(_CUT.findall, b"\n".join(plain).decode().lower().split("\n")))
        if len(self.pieces) > REMEMBERED_PIECES:
            self.pieces.clear()
        new = list(set().union(*cut).difference(self.pieces))
        tokenize = self.tokenizer.model.tokenize
        for piece, spelled in zip(new, "\n".join(new).translate(self.spelling).split("\n"), strict=bool(new)):
            self.pieces[piece] = np.array([t.id for t in tokenize(spelled)], np.uint32).tobytes()
        ids = self.pieces.__getitem__
        for word, pieces in zip(plain, cut, strict=True):
            self.known[word] = ids(pieces[0]) if len(pieces) == 1 else b"".join(map(ids, pieces))
        return others

    def _learn(self, words: list[bytes]) -> None:
        """Encode many words in one call, parted by a mark that none of them holds."""
        if self.cuts:
            words = self._cut(words)
        plain = [w for w in words if _MARK.encode() not in w]
        for word in set(words).difference(plain):
            self.known[word] = self._encode(word.decode()).tobytes()
        if not plain:
            return
        ids = self._encode(f" {_MARK} ".join(w.decode() for w in plain))
        cuts = np.flatnonzero(ids == self.mark[0])
        if len(self.mark) != 1 or len(cuts) != len(plain) - 1:
            for word in plain:
                self.known[word] = self._encode(word.decode()).tobytes()
            return
        for word, a, b in zip(
            plain, np.append(0, cuts + 1).tolist(), np.append(cuts, len(ids)).tolist(), strict=True
        ):
            self.known[word] = ids[a:b].tobytes()

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        words = [t.split() for t in texts]
        new = set().union(*words).difference(self.known)
        if new:
            self._learn(sorted(new))
        return [b"".join(map(self.known.__getitem__, w)) for w in words]


@lru_cache(maxsize=2)
def load(path: str) -> WordTokens:
    return WordTokens(path)


c.remembers("tokens", load.cache_clear)


def token_batches(
    batches: Iterator[pa.RecordBatch], path: str
) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """(doc_ids, ids) of a bounded number of documents at a time; every document ends with id 0."""
    end = np.zeros(1, np.uint32).tobytes()
    words = load(path)
    for batch in batches:
        raw, offsets = c.buffers(batch.column("text"))
        doc_ids = batch.column("doc_id").to_pylist()
        for i, j, part, at in c.slices(raw, offsets):
            data, ends = part.tobytes(), at.tolist()
            texts = [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield doc_ids[i:j], [ids + end for ids in words.ids(texts)]
