"""Byte-level BPE: encoding by a transducer that is made deterministic on demand, and streaming decoding.

Ranks fix which token sequences are stable: a sequence is the encoding of its bytes just when no
merge crosses the border of any two neighbours. So each prefix of a piece has one last token, the
token that ends there and may follow the last token of what is before it, and reading one byte more
only adds one such token.

A state of the transducer is the last token written and the bytes read since. Reading a byte finds
the new last token; then the starts from which a vocabulary token might still grow are followed back
along their last tokens, and what all of them share is written. Hence a token comes out after a bounded
lookahead, at most the longest token. Steps and their states are made when needed for the second
time and kept (``STATES`` at most, then anew); a piece that leaves the known steps is finished by the
same rule without making states. Finished pieces are kept too (``PIECES`` at most).

A text is split by the tokenizer's pattern first; long texts are split block by block at single blanks
between two other characters, where no match of the pattern can cross. Decoding reads ids in blocks;
bytes of a character that is not complete yet wait in an incremental UTF-8 reader.

Defined cases: a null text counts as empty, and an empty one has no ids; whatever the text holds is
ordinary text (no special tokens); repeated rows are encoded alike; an empty table gives an empty
result; other columns are carried along or left out as the caller names them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

RANKS = "byte_bpe_50k.tiktoken"
STATES = 150_000
PIECES = 300_000
BLOCK = 1 << 20
IDS = 1 << 16
NEVER = 1 << 62


def split_pattern(pattern: str = public_tokenizers.PATTERN) -> str:
    r"""The pattern for this regex library, whose ``\s`` also takes the separators 1C to 1F, which are none here."""
    return pattern.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class State:
    """The last token written (its bytes; empty at the start of a piece), the bytes read since, and the steps from here.

    ``last`` has the length of the last token of every prefix of the pending bytes; ``ways`` the borders
    met on the way back from there to the start, as bits, for the empty prefix too.
    """

    __slots__ = ("before", "last", "next", "pending", "rest", "ways")

    def __init__(self, before: bytes, pending: bytes, last: tuple[int, ...], ways: tuple[int, ...]) -> None:
        self.before, self.pending, self.last, self.ways = before, pending, last, ways
        self.next: dict[int, tuple[State, bytes] | None] = {}  # None: asked for once
        self.rest: bytes | None = None


class Transducer:
    """Encoder of pieces. Ids are given as little-endian unsigned 32-bit numbers in one byte string."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.code = {token: i.to_bytes(4, "little") for token, i in ranks.items()}
        self.starts = {token[:n] for token in ranks for n in range(1, len(token))}  # of longer tokens
        self.parts = self.starts.union(ranks)
        self.spines: dict[tuple[bytes, bool], list[tuple[bytes, int, int]]] = {}
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.states: dict[tuple[bytes, bytes], State] = {}
        self.start = self._state(b"", b"", (), (1,))

    def _halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts whose merge gave the token."""
        parts, most = [token[i : i + 1] for i in range(len(token))], self.ranks[token]
        while len(parts) > 2:
            found = [(self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(found)
            if rank >= most:
                raise ValueError(f"no merges lead to the token {token!r}")
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts[0], parts[1]

    def _spine(self, token: bytes, left: bool) -> list[tuple[bytes, int, int]]:
        """What stands at the left (right) end of the token while it is merged: part, its rank, the rank that ends it."""
        found = self.spines.get((token, left))
        if found is None:
            found, until, part = [], NEVER, token
            while True:
                rank = self.ranks[part] if len(part) > 1 else -1
                found.append((part, rank, until))
                if len(part) == 1:
                    break
                until, part = rank, self._halves(part)[0 if left else 1]
            self.spines[token, left] = found
        return found

    def may_follow(self, first: bytes, second: bytes) -> bool:
        """Whether no merge crosses the border between two neighbouring tokens."""
        known = self.follows.get((first, second))
        if known is None:
            if len(self.follows) > 4 * STATES:
                self.follows.clear()
            known = self.follows[first, second] = not self._crossed(first, second)
        return known

    def _crossed(self, first: bytes, second: bytes) -> bool:
        ranks, starts = self.ranks, self._spine(second, left=True)
        for a, made_a, until_a in self._spine(first, left=False):
            for b, made_b, until_b in starts:
                rank = ranks.get(a + b)
                if rank is not None and rank < until_a and rank <= until_b and made_a < until_b and made_b < until_a:
                    return True
        return False

    def _state(self, before: bytes, pending: bytes, last: tuple[int, ...], ways: tuple[int, ...]) -> State:
        state = self.states.get((before, pending))
        if state is None:
            state = self.states[before, pending] = State(before, pending, last, ways)
        return state

    def _tokens(self, pending: bytes, last: Sequence[int], end: int) -> list[bytes]:
        """The tokens of ``pending[:end]``, last one first."""
        found = []
        while end:
            found.append(pending[end - last[end - 1] : end])
            end -= last[end - 1]
        return found

    def _step(self, state: State, byte: int) -> tuple[State, bytes]:
        pending, last, ways, end = state.pending + bytes((byte,)), state.last, state.ways, len(state.last) + 1
        for at in range(end):
            token = pending[at:]
            if token in self.ranks:
                before = pending[at - last[at - 1] : at] if at else state.before
                if not before or self.may_follow(before, token):
                    break
        else:
            raise ValueError("the ranks lack a single byte")
        last, ways = (*last, end - at), (*ways, ways[at] | 1 << end)
        shared = ways[end]
        for at in range(end):
            if pending[at:] in self.starts:  # a token from here may still grow
                shared &= ways[at]
        cut = shared.bit_length() - 1
        if cut:
            written = self._tokens(pending, last, cut)
            out = b"".join([self.code[t] for t in reversed(written)])
            # what is kept of borders whose way back avoids the cut is never asked for
            after = self._state(written[0], pending[cut:], last[cut:], tuple([w >> cut for w in ways[cut:]]))
        else:
            out, after = b"", self._state(state.before, pending, last, ways)
        state.next[byte] = after, out
        return after, out

    def _finish(self, state: State, rest: bytes) -> list[bytes]:
        """Ids of what is pending and the rest of the piece, last token first."""
        pending, last, low = state.pending + rest, list(state.last), 0
        ranks, parts, follows = self.ranks, self.parts, self.follows
        for end in range(len(last) + 1, len(pending) + 1):
            while pending[low:end] not in parts:
                low += 1
            for at in range(low, end):
                token = pending[at:end]
                if token in ranks:
                    before = pending[at - last[at - 1] : at] if at else state.before
                    if not before or follows.get((before, token)) or self.may_follow(before, token):
                        last.append(end - at)
                        break
        return [self.code[t] for t in self._tokens(pending, last, len(pending))]

    def encode(self, piece: bytes) -> bytes:
        """Ids of one piece."""
        if piece in self.code:
            return self.code[piece]
        if len(self.states) > STATES:
            self.states.clear()
            self.start = self._state(b"", b"", (), (1,))
        state, written = self.start, []
        for at, byte in enumerate(piece):
            step = state.next.get(byte)
            if step is None:
                if byte not in state.next:
                    state.next[byte] = None
                    rest = self._finish(state, piece[at:])
                    break
                step = self._step(state, byte)
            state, out = step
            if out:
                written.append(out)
        else:
            if state.rest is None:
                rest = self._tokens(state.pending, state.last, len(state.pending))
                state.rest = b"".join([self.code[t] for t in reversed(rest)])
            return b"".join([*written, state.rest])
        return b"".join([*written, *reversed(rest)])


class Pieces(dict):
    """Ids of pieces seen before, bounded."""

    def __init__(self, transducer: Transducer) -> None:
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECES:
            self.clear()
        found = self[piece] = self.transducer.encode(piece.encode())
        return found


class Utf8Reader:
    """Text of bytes that come in blocks; holds back the bytes of a character that is not complete."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes, final: bool = False) -> str:
        data = self.held + data
        keep = len(data)
        if not final:
            for back in range(1, min(3, len(data)) + 1):
                lead = data[-back]
                if lead & 0xC0 != 0x80:  # not a continuation
                    wanted = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
                    keep = len(data) - back if wanted > back else len(data)
                    break
        self.held = data[keep:]
        return data[:keep].decode("utf-8", errors="replace")


class Tokenizer:
    """Encoder and decoder of whole texts for a set of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN) -> None:
        self.pattern, self.border = regex.compile(split_pattern(pattern)), regex.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")
        self.pieces = Pieces(Transducer(ranks))
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token

    def _blocks(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > BLOCK:
            cut = self.border.search(text, start + BLOCK)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        find, ids = self.pattern.findall, self.pieces.__getitem__
        return b"".join([b"".join(map(ids, find(block))) for block in self._blocks(text or "")])

    def decode_blocks(self, ids: bytes) -> Iterator[bytes]:
        for start in range(0, len(ids), 4 * IDS):
            block = np.frombuffer(ids, "<u4", min(IDS, (len(ids) - start) // 4), start)
            yield b"".join(map(self.tokens.__getitem__, block.tolist()))

    def decoded_sha256(self, ids: bytes) -> str:
        """Digest of the text of the ids, read as a stream."""
        decoded, reader = hashlib.sha256(), Utf8Reader()
        for block in self.decode_blocks(ids):
            decoded.update(reader.feed(block).encode())
        decoded.update(reader.feed(b"", final=True).encode())
        return decoded.hexdigest()

    def decode(self, ids: bytes) -> str:
        """The text of the ids, read as a stream."""
        reader = Utf8Reader()
        return "".join([*map(reader.feed, self.decode_blocks(ids)), reader.feed(b"", final=True)])


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


@lru_cache(maxsize=4)
def _tokenizer(data: bytes) -> Tokenizer:
    return Tokenizer(parse_ranks(data))


def ranks_file(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The bytes of a rank file for all tasks: one vocabulary, under a megabyte, whatever the input."""
    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: digests of the ids and of what they decode to."""
    ranks = ranks_file(docs.sparkSession, path)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(ranks.value)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column("text"):
                ids = tokenizer.encode(text.as_py())
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(tokenizer.decoded_sha256(ids))
            arrays = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(report, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), text: str = "text", path: str | None = None, decoded: bool = False) -> DataFrame:
    """``columns`` of every row with ``n_tokens`` and ``token_ids``, if ``decoded`` with ``decoded_sha256`` of what these decode to."""
    ranks = ranks_file(docs.sparkSession, path)

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(ranks.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [tokenizer.encode(t.as_py()) for t in part.column("__text")]
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                kept = [part.column(c) for c in columns]
                arrays, names = [*kept, pa.array(np.diff(ends), pa.int64()), lists], [*columns, "n_tokens", "token_ids"]
                if decoded:
                    arrays, names = [*arrays, pa.array([tokenizer.decoded_sha256(i) for i in ids], pa.string())], [*names, "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in columns)
    rows = docs.select(*columns, docs[text].alias("__text"))
    digest = ", decoded_sha256 string" if decoded else ""
    return rows.mapInArrow(ids_of, f"{kinds}n_tokens bigint, token_ids array<int>{digest}")
