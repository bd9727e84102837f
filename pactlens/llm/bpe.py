"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A token sequence is the encoding of its bytes exactly if every token encodes to itself and every two
neighbours are the encoding of their joined bytes. So the vocabulary defines a transducer that reads
bytes along token prefixes and may end a token wherever its pair with the token before is right.
At a place only one token can end the encoding of the bytes up to there; what is not yet known is
which of those places the final encoding uses. A state of the determinised machine holds the places
that are still alive: for each, the tokens since the last place all of them share, and the token
prefix read from there. When an alive place is left, the tokens common to all the others are emitted.
No token is longer than the longest one of the vocabulary, so the lookahead is bounded by it.
States and transitions are made when they are needed again and dropped together when there are
``MOST_STATES``, also inside a piece, which goes on from the state it is in; that changes the time taken
and nothing else.

Rows: null text is empty (no tokens); a null doc_id is passed on; repeated rows are encoded alike;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.llm import common as c

MOST_STATES = 200_000
REMEMBERED_PIECES = 300_000
SHORT_PIECE = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Vocabulary:
    """Ranks, a prefix tree over the tokens, and the test whether two tokens may stand together."""

    def __init__(self, path: str):
        self.rank: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.rank[base64.b64decode(token)] = int(rank)
        self.token = {r: t for t, r in self.rank.items()}
        self.below: list[dict[int, int]] = [{}]  # prefix tree: node, byte -> node
        self.ends = [-1]  # the token that ends at a node
        for token, rank in self.rank.items():
            node = 0
            for byte in token:
                if byte not in self.below[node]:
                    self.below[node][byte] = len(self.below)
                    self.below.append({})
                    self.ends.append(-1)
                node = self.below[node][byte]
            self.ends[node] = rank
        self._fits: dict[tuple[int, int], bool] = {}
        self._edges: dict[int, tuple[list[int], list[int]] | None] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None if its bytes never become it."""
        data = self.token[token]
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            rank, i = min(
                (self.rank.get(parts[i] + parts[i + 1], len(self.rank)), i) for i in range(len(parts) - 1)
            )
            if rank == len(self.rank):
                return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return self.rank[parts[0]], self.rank[parts[1]]

    def edges(self, token: int) -> tuple[list[int], list[int]] | None:
        """The tokens at the left and at the right edge of ``token`` while it was merged, itself
        first and single bytes last; None if its bytes never become it."""
        if token not in self._edges:
            found: tuple[list[int], list[int]] | None = ([token], [token])
            if len(self.token[token]) > 1:
                halves = self._halves(token)
                left = halves and self.edges(halves[0])
                right = halves and self.edges(halves[1])
                found = ([token, *left[0]], [token, *right[1]]) if left and right else None
            self._edges[token] = found
        return self._edges[token]

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: start)."""
        known = self._fits.get((before, token))
        if known is None:
            known = self.edges(token) is not None and (before < 0 or not self._would_merge(before, token))
            if len(self._fits) > 4 * MOST_STATES:
                self._fits.clear()
            self._fits[before, token] = known
        return known

    def _would_merge(self, before: int, token: int) -> bool:
        """Whether a merge across the border came before the merges that made the two tokens.

        Merges are taken back in turn, the later one of the two edges first. Of equal ranks the left
        one is made first.
        """
        left, right = self.edges(before)[1], self.edges(token)[0]
        i = j = 0
        limit = len(self.rank) + 1
        while True:
            a, b = left[i], right[j]
            joined = self.rank.get(self.token[a] + self.token[b])
            if joined is not None and joined < limit:
                return True
            more_left, more_right = i + 1 < len(left), j + 1 < len(right)
            if more_left and (not more_right or a > b):
                i, limit = i + 1, a
            elif more_right:
                j, limit = j + 1, b + 1
            else:
                return False


class Transducer:
    """Deterministic steps over bytes, made as needed.

    A state is a tuple of alive places, oldest first: (tokens since the shared place, last token
    before the place, prefix-tree node). The newest place stands at the byte just read, at the root.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.words = vocabulary
        self._clear()

    def _clear(self, state: int = 0) -> int:
        """Forget all states but the start and ``state``; its new number."""
        start = (((), -1, 0),)
        kept = [start] if state == 0 else [start, self.states[state]]
        self.number = {key: n for n, key in enumerate(kept)}
        self.states = kept
        self.steps: list[dict[int, tuple[int, tuple[int, ...]] | None]] = [{} for _ in kept]
        return len(kept) - 1

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        words = self.words
        alive, ended = [], None
        for pending, last, node in self.states[state]:
            node = words.below[node].get(byte, -1)
            if node < 0:
                continue
            token = words.ends[node]
            if token >= 0 and ended is None and words.fits(last, token):
                ended = ((*pending, token), token, 0)
            if words.below[node]:
                alive.append((pending, last, node))
        if ended is None:
            raise ValueError("the vocabulary lacks a single byte")
        alive.append(ended)
        shared = 0
        shortest = min(len(place[0]) for place in alive)
        first = alive[0][0]
        while shared < shortest and all(place[0][shared] == first[shared] for place in alive):
            shared += 1
        key = tuple((pending[shared:], last, node) for pending, last, node in alive)
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        out = number, first[:shared]
        self.steps[state][byte] = out
        return out

    def _undetermined(self, state: int, rest: bytes) -> list[int]:
        """Tokens from a state to the end of a piece without making states on the way."""
        below, ends, fits = self.words.below, self.words.ends, self.words.fits
        places = []
        for pending, last, node in self.states[state]:
            chain = None
            for token in pending:
                chain = (token, chain)
            places.append((chain, last, node))
        for byte in rest:
            alive, ended = [], None
            for chain, last, node in places:
                node = below[node].get(byte, -1)
                if node < 0:
                    continue
                token = ends[node]
                if token >= 0 and ended is None and fits(last, token):
                    ended = ((token, chain), token, 0)
                if below[node]:
                    alive.append((chain, last, node))
            if ended is None:
                raise ValueError("the vocabulary lacks a single byte")
            alive.append(ended)
            places = alive
        chain, out = places[-1][0], []
        while chain is not None:
            token, chain = chain
            out.append(token)
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece; emitted as soon as no later byte can change them.

        A step is taken into the machine when it is asked for the second time: most words are rare,
        and what only they need is worked out without it. Long pieces always use the machine, whose
        state does not grow with what has been read.
        """
        state, out, steps = 0, [], self.steps
        for i, byte in enumerate(piece):
            found = steps[state].get(byte)
            if found is None:
                if byte not in steps[state] and len(piece) <= SHORT_PIECE:
                    steps[state][byte] = None
                    return out + self._undetermined(state, piece[i:])
                if len(self.states) >= MOST_STATES:
                    state = self._clear(state)
                    steps = self.steps
                found = self._step(state, byte)
            state, tokens = found
            if tokens:
                out += tokens
        out += self.states[state][-1][0]
        return out


class Encoder:
    """Ids of whole texts: every match of the pattern is a piece of its own."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.transducer = Transducer(self.vocabulary)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.vocabulary.rank.get(data)
        ids = (whole,) if whole is not None else tuple(self.transducer.encode(data))
        if len(self.known) < REMEMBERED_PIECES:
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        known, learn, out = self.known, self._learn, []
        for piece in self.pieces(text):
            out += known.get(piece) or learn(piece)
        return out


class StreamDecoder:
    """Bytes of ids, given out in whole UTF-8 characters while ids arrive.

    The state is the number of continuation bytes a character still lacks, with the bytes it has.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.token = vocabulary.token
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many last bytes begin a character that is not complete."""
        for back in range(1, min(4, len(data) + 1)):
            byte = data[-back]
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < need else 0
            if byte < 0x80:
                return 0
        return 0

    def feed(self, ids: Iterable[int]) -> bytes:
        data = self.held + b"".join(map(self.token.__getitem__, ids))
        cut = len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut]

    def end(self) -> bytes:
        """What is left; not empty only if the ids end inside a character."""
        left, self.held = self.held, b""
        return left


def decode(vocabulary: Vocabulary, ids: list[int], step: int = 4096) -> Iterator[bytes]:
    stream = StreamDecoder(vocabulary)
    for i in range(0, len(ids), step):
        yield stream.feed(ids[i : i + step])
    yield stream.end()


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encoded(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids) of whole texts."""
    path, split = vocabulary or default_vocabulary(), pattern or default_pattern()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path, split)
        for batch in batches:
            raw, offsets = c.buffers(batch.column("text"))
            for i, j, part, at in c.slices(raw, offsets):
                data, ends = part.tobytes(), at.tolist()
                ids = [encoder.encode(data[a:b].decode()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(ids, pa.list_(pa.int32()))],
                    names=["doc_id", "ids"],
                )

    return c.prepared(c.pick(docs, "doc_id", "text")).mapInArrow(encode, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the decoded ids)."""
    path, split = vocabulary or default_vocabulary(), pattern or default_pattern()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path, split)
        names = {rank: str(rank) for rank in encoder.vocabulary.token}
        for batch in batches:
            raw, offsets = c.buffers(batch.column("text"))
            for i, j, part, at in c.slices(raw, offsets):
                data, ends = part.tobytes(), at.tolist()
                counts, of_ids, of_bytes = [], [], []
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    ids = encoder.encode(data[a:b].decode())
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join([names[x] for x in ids]).encode()).hexdigest())
                    back = hashlib.sha256()
                    for text in decode(encoder.vocabulary, ids):
                        back.update(text)
                    of_bytes.append(back.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i), pa.array(counts, pa.int64()),
                        pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return c.prepared(c.pick(docs, "doc_id", "text")).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
