"""Byte-level BPE encoding by backtracking over longest matches.

Tokens are byte strings with ranks.  Bytes are mapped to the 256 Latin-1
characters, so an Aho-Corasick automaton finds every token in a piece.  The
encoder takes the longest token at each place and steps back to a shorter
one whenever the last two tokens could not stand side by side in a merge
result; places it gave up are remembered, so the work is linear in the
piece.  Whether two tokens can be neighbours depends on the two alone and
is memoised.  Longest tokens that already can stand side by side from end to
end need no step back: only one sequence of neighbours spells a piece."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tabforge.llm.common import Memo, frugal, keeps, only, prepare

MEMO = 80 << 20    # bytes of chunks (and of pieces) remembered per worker and generation
SHORT = 256        # bytes of a piece whose longest tokens are tried first, one after the other
PAIRS = 200_000    # pairs of tokens remembered per worker; cleared when full
#: Fixed value: patterns none of whose matches reaches from a character that
#: is not white space into white space after it.
APART = frozenset({
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
})
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CHUNK = re.compile(r"\s*\S+|\s+")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Exact byte-pair encoding by ranks: of all neighbours whose joined
    bytes are a token, the lowest rank merges first, leftmost on ties."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.bytes = ranks, {r: t for t, r in ranks.items()}
        self.decimal = {r: str(r) for r in self.bytes}
        self.split = regex.compile(pattern).finditer
        self.apart = pattern in APART
        self.parts: dict[int, tuple[int, int] | None] = {}   # a token's last merge; None: a single byte
        self.joined: dict[tuple[int, int], int] = {}         # the merge's other direction
        self.shorter: dict[int, int | None] = {}             # longest proper prefix that is a token
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo = Memo(MEMO)                               # ids of chunks
        self.pieces = self.memo if self.apart else Memo(MEMO)    # cut apart, a piece is also a chunk of this one piece
        self._learn()
        self.size = {r: len(t) for r, t in self.bytes.items()}
        self.automaton = ahocorasick.Automaton()             # tokens that merges lead to
        for rank in self.parts:
            self.automaton.add_word(self.bytes[rank].decode("latin-1"), rank)
        self.automaton.make_automaton()

    def _learn(self) -> None:
        """Find each token's last merge, low ranks first: the split into two
        lower tokens that can be neighbours.  A token that no merges lead to
        has none; it only ever stands for a whole piece."""
        for rank in sorted(self.bytes):
            token = self.bytes[rank]
            if len(token) == 1:
                self.parts[rank] = None
        for rank in sorted(self.bytes):
            token = self.bytes[rank]
            self.shorter[rank] = self._prefix(token)
            if rank in self.parts:
                continue
            left = self.shorter[rank]
            while left is not None:
                right = self.ranks.get(token[len(self.bytes[left]):])
                if right is not None and left in self.parts and right in self.parts \
                        and max(self._age(left), self._age(right)) < rank and self._fit(left, right):
                    self.parts[rank] = (left, right)
                    self.joined[left, right] = rank
                    break
                left = self.shorter.get(left) if left in self.shorter else self._prefix(self.bytes[left])
        self.fits.clear()

    def _age(self, rank: int) -> int:
        """Single bytes are there from the start, whatever their rank."""
        return -1 if self.parts[rank] is None else rank

    def _prefix(self, token: bytes) -> int | None:
        for n in range(len(token) - 1, 0, -1):
            if (r := self.ranks.get(token[:n])) is not None:
                return r
        return None

    def _fit(self, a: int, b: int) -> bool:
        """Can ``a`` and ``b`` be neighbours in a result?  Undo the merges on
        both sides of the seam from the youngest; a merge across the seam
        that would have come before the one undone there rules it out."""
        key = a, b
        if (known := self.fits.get(key)) is not None:
            return known
        limit, side, ok = float("inf"), 0, True
        while True:
            across = self.joined.get((a, b))
            # On equal rank the leftmost merge comes first: the one across the
            # seam precedes one on its right, follows one on its left.
            if across is not None and (across < limit or across == limit and side > 0):
                ok = False
                break
            if max(self._age(a), self._age(b)) < 0:
                break
            if self._age(a) > self._age(b):
                limit, side, a = a, -1, self.parts[a][1]
            else:
                limit, side, b = b, 1, self.parts[b][0]
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def piece(self, data: bytes) -> list[int]:
        """Tokens of one piece (a match of the pattern)."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        n, size, text = len(data), self.size, data.decode("latin-1")
        if n <= SHORT and (easy := self._greedy(n, text)) is not None:
            return easy
        longest: list[int | None] = [None] * n
        for end, rank in self.automaton.iter(text):
            longest[end - size[rank] + 1] = rank    # later ends are longer, so the last one stays
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while token is not None:
            last = out[-1] if out else None
            while True:
                end = at + size[token]
                if not dead[end] and (last is None or self._fit(last, token)):
                    out.append(token)
                    at = end
                    token = longest[end] if end < n else None
                    break
                token = self._reachable(token)
                if token is None:       # nothing fits here: give the place up, shorten the token before
                    dead[at] = 1
                    if not out:
                        raise ValueError("the ranks lack single bytes")
                    token = out.pop()
                    at -= size[token]
                    break
        return out

    def _greedy(self, n: int, text: str) -> list[int] | None:
        """The longest tokens one after the other, if they are the result."""
        known, size = self.fits, self.size
        out: list[int] = []
        last, covered = None, 0
        for _, token in self.automaton.iter_long(text):
            if last is not None:
                fits = known.get((last, token))
                if not (self._fit(last, token) if fits is None else fits):
                    return None
            out.append(token)
            covered += size[token]
            last = token
        return out if covered == n else None

    def _reachable(self, token: int) -> int | None:
        token = self.shorter[token]
        while token is not None and token not in self.parts:
            token = self.shorter[token]
        return token

    def _chunk(self, chunk: str) -> list[int] | tuple[int, ...]:
        if (known := self.memo.get(chunk)) is not None:
            return known
        found: list[int] = []
        for match in self.split(chunk):
            piece = match[0]
            part = len(piece) < len(chunk) and len(piece) <= 64
            ids = self.pieces.get(piece) if part else None
            if ids is None:
                ids = self.piece(piece.encode())
                if part:
                    self.pieces.put(piece, tuple(ids))
            found += ids
        if len(chunk) <= 64:
            self.memo.put(chunk, tuple(found))
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text.  If no match of the pattern reaches from a character
        that is not white space into a blank or line end after it, the text
        is cut there and short chunks are remembered.  That holds for the
        patterns in ``APART``; with any other the text is matched whole."""
        if not self.apart or _ODD_SPACE.search(text):
            return list(self._chunk(text))
        known, out = self.memo.young.get, []
        for chunk in _CHUNK.findall(text):
            ids = known(chunk)
            out += self._chunk(chunk) if ids is None else ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_encoders: dict[tuple[str, str], Encoder] = {}
keeps(_encoders.clear, __name__)


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a rank file, built once per process."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus ``ids array<int>`` of each whole text.  Null
    text counts as empty (no ids).  One row in, one out, no shuffle.
    ``path`` must be readable on every worker."""
    return _run(df, path, pattern, text, keep, pa.list_(pa.int32()), "ids array<int>",
                lambda enc, s: enc.encode(s), "ids")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus ``data binary``: the bytes the ids stand for
    (null ids: empty)."""
    return _run(df, path, pattern, ids, keep, pa.binary(), "data binary", lambda enc, x: enc.decode(x), "data")


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus a digest of encoding and decoding each whole
    text: ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas) and
    ``decoded_sha256`` (the bytes decoded from the ids)."""
    def digest(enc: Encoder, s: str) -> dict:
        ids = enc.encode(s)
        return {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(",".join(map(enc.decimal.__getitem__, ids)).encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(enc.decode(ids)).hexdigest()}

    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    out = _run(df, path, pattern, text, keep, kind,
               "__d struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>", digest, "__d")
    return out.select(*keep, "__d.*")


def _run(df: DataFrame, path: str, pattern: str, column: str, keep: tuple[str, ...], kind: pa.DataType,
         declared: str, work, name: str) -> DataFrame:
    prepare(df.sparkSession)
    own = only(df, __in=column, **{k: k for k in keep})
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[1:]), declared])

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):     # token lists of a few hundred texts at a time
                part = batch.slice(a, 256)
                made = pa.array([work(enc, v.as_py() or ("" if column_is_text else []))
                                 for v in part.column(0)], kind)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], made], [*part.schema.names[1:], name])

    column_is_text = own.schema.fields[0].dataType.simpleString() == "string"
    return own.mapInArrow(run, schema)
