"""Bulk-synchronous best-fit packing of token sequences.

Lengths are whole numbers up to the capacity, so the range-sorted documents
are at most ``capacity`` runs of equal length and the open sequences are
runs of equal gap.  One superstep takes a whole run of documents, longest
first, and sweeps up the sorted gaps: each run of gaps takes as many of the
documents as fit, the n-th document goes to the n-th gap (rank decides who
gets which), the gaps shrink and the next superstep starts.  That is
best-fit decreasing, exactly, at the cost of the runs instead of the rows.
Rows are only ranked within their run, over all tasks, and then look up the
step that placed their rank."""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import Memo, Scratch, batches_of_text, frugal, gapless, keeps, only, prepare

MEMO = 48 << 20     # bytes of words remembered per worker and generation
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Lower-case Latin-1 letters or common marks alone make one token group.
_SIMPLE = re.compile("[a-zß-öø-ÿ]+|[.,!?;:%&*$#|]+").fullmatch
_RUNS = re.compile("[a-zªµºß-öø-ÿ]+|[^\\sa-zªµºß-öø-ÿ]+").findall
_words: dict[str, Memo] = {}
_ends: dict[str, np.ndarray] = {}
_loaded: dict[str, object] = {}
for _cache in (_words, _ends, _loaded):
    keeps(_cache.clear, __name__)


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _loaded[path] = t
    return _loaded[path]


def _encode_words(path: str, words: list[str]) -> list[bytes]:
    """Ids of single words.  Simple words go to the library as one text and
    are cut apart again at the tokens that end a group; should the groups
    not add up, and for all other words, each is encoded alone."""
    t, found = _tokenizer(path), {}
    if path not in _ends:
        vocab = t.get_vocab()
        _ends[path] = np.zeros(max(vocab.values()) + 1, bool)
        _ends[path][[i for w, i in vocab.items() if w.endswith("</w>")]] = True
    simple = [w for w in words if _SIMPLE(w)]
    if simple:
        ids = np.asarray(t.encode_batch_fast([" ".join(simple)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(_ends[path][ids]) + 1
        if len(ends) == len(simple) and ends[-1] == len(ids):
            data, at = ids.tobytes(), 0
            for w, end in zip(simple, (4 * ends).tolist(), strict=True):
                found[w], at = data[at:end], end
    rest = [w for w in words if w not in found]
    for w, e in zip(rest, t.encode_batch_fast(rest, add_special_tokens=False), strict=True):
        found[w] = np.asarray(e.ids, "<u4").tobytes()
    return [found[w] for w in words]


def _cut(s: str) -> list[str] | None:
    """Parts that are tokenized apart.  Latin-1 texts are folded as the
    tokenizer folds them and cut into runs of letters and of other signs;
    apostrophes and special tokens span such runs, so texts with those, or
    with other scripts, are cut at white space only."""
    if _ODD_SPACE.search(s):
        return None
    if "'" in s or "<|" in s:
        return s.split()
    try:
        s.encode("latin-1")
    except UnicodeEncodeError:
        return s.split()
    return _RUNS(s.lower())


def token_bytes(path: str, texts: list[str]) -> list[bytes]:
    """Ids of each text as little-endian 32-bit numbers.

    For a tokenizer that drops white space and never joins across it, a
    text's ids are those of its words in order; words are remembered.  Texts
    with unusual white space go to the library whole."""
    t, memo = _tokenizer(path), _words.setdefault(path, Memo(MEMO))
    split = [_cut(s) for s in texts]
    ids = {w: memo.get(w) for w in {w for words in split if words for w in words}}
    new = [w for w, found in ids.items() if found is None]
    if new:
        for w, found in zip(new, _encode_words(path, new), strict=True):
            ids[w] = found
            memo.put(w, found)
    out = []
    for s, words in zip(texts, split, strict=True):
        if words is None:
            out.append(np.asarray(t.encode(s, add_special_tokens=False).ids, "<u4").tobytes())
        else:
            out.append(b"".join(map(ids.__getitem__, words)))
    return out


def pieces(df: DataFrame, path: str, capacity: int, end_id: int, text: str = "text", key: str = "doc_id",
           with_ids: bool = False) -> DataFrame:
    """Token pieces of each whole text: ``key``, ``piece`` (from 0),
    ``start`` (ids before it), ``length``, ``ids_crc32`` (unsigned, over
    little-endian 32-bit ids) and, if asked for, ``ids``.

    ``end_id`` closes every document, null and empty texts included, so each
    has a piece.  Documents longer than ``capacity`` are cut into pieces of
    that length; the last may be shorter.  ``path`` must be a tokenizer that
    drops white space (see ``token_bytes``), readable on every worker."""
    prepare(df.sparkSession)
    own = only(df, __text=text, __key=key)
    kind = own.schema.fields[1].dataType.simpleString()
    end = np.asarray([end_id], "<u4").tobytes()
    names = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in batches_of_text(batch, 0):
                part = batch.slice(a, b - a)
                rows, cols = [], [[], [], [], [], []]
                texts = [s or "" for s in part.column(0).to_pylist()]
                for i, data in enumerate(token_bytes(path, texts)):
                    data += end
                    for p, at in enumerate(range(0, len(data), 4 * capacity)):
                        cut = data[at:at + 4 * capacity]
                        rows.append(i)
                        for c, v in zip(cols, (p, at // 4, len(cut) // 4, zlib.crc32(cut),
                                               np.frombuffer(cut, "<u4").astype(np.int32) if with_ids else None),
                                        strict=True):
                            c.append(v)
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                made = [pa.array(c, t) for c, t in zip(cols, types, strict=True)][:4 + with_ids]
                yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(rows, pa.int64())), *made], names)

    return own.mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
                          + ", ids array<int>" * with_ids)


def sweep(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing on runs.  ``counts``: rows per length.  Rows of
    the result, sorted: length, first rank, rows, first sequence, rows per
    sequence, offset; together they place every rank of every length."""
    gaps: dict[int, deque] = {}     # gap -> runs (first sequence, sequences)
    order: list[int] = []           # gaps that have runs, ascending
    steps, opened = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = deque()
                bisect.insort(order, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                gap = order[at]
                first, n = gaps[gap].popleft()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:
                gap, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = min(gap // length, left)
            full = min(n, left // each)
            steps.append((length, rank, full * each, first, each, capacity - gap))
            put(gap - each * length, first, full)
            left, rank = left - full * each, rank + full * each
            if full < n:    # the rest of the run waits with its gap as it was
                if gap == capacity:     # just opened: the rows left over share one sequence
                    steps.append((length, rank, left, first + full, left, 0))
                    put(gap - left * length, first + full, 1)
                    left = 0
                elif gap in gaps:
                    gaps[gap].appendleft((first + full, n - full))
                else:
                    put(gap, first + full, n - full)
    return np.asarray(sorted(steps), np.int64).reshape(-1, 6)


def pack(df: DataFrame, capacity: int, length: str = "length", keys: tuple[str, ...] = ("doc_id", "piece")
         ) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: rows of one sequence lie without
    gaps from 0 and fill at most ``capacity``.

    The steps that ``sweep`` returns depend on lengths, not on rows: at most
    ``capacity`` counts reach the driver.  ``keys`` only spread and order
    rows of equal length; null or repeated keys are fine.  A null length or
    one outside 1..capacity gets null in both columns.  ``df`` is read
    twice, so it should be a table."""
    spark = df.sparkSession
    prepare(spark)
    fits = F.col(f"`{length}`").between(1, capacity)
    counts = {r[0]: r[1] for r in df.where(fits).groupBy(F.col(f"`{length}`")).count().collect()}
    steps = spark.sparkContext.broadcast(sweep(counts, capacity))
    sized = df.withColumn("__len", F.when(fits, F.col(f"`{length}`")).otherwise(0).cast("long"))
    ranked = gapless(sized, ["__len"], list(keys), "__rank")
    kept = df.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields),
                        "sequence_id long", "offset long"])

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = steps.value
        at = (s[:, 0] << 40) + s[:, 1]
        for batch in batches:
            size = batch.column(len(kept)).to_numpy()
            rank = batch.column(len(kept) + 1).to_numpy()
            if len(s):
                i = np.maximum(np.searchsorted(at, (size << 40) + rank, "right") - 1, 0)
                rank = rank - s[i, 1]
                seq, off = s[i, 3] + rank // s[i, 4], s[i, 5] + rank % s[i, 4] * size
            else:
                seq = off = np.zeros(len(size), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(seq, mask=size == 0), pa.array(off, mask=size == 0)],
                [*kept, "sequence_id", "offset"])

    return ranked.select(*[F.col(f"`{c}`") for c in kept], "__len", "__rank").mapInArrow(run, schema)


def pack_documents(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, text: str = "text",
                   key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack a table of documents (see ``pieces`` and
    ``pack``)."""
    made = pieces(df, path, capacity, end_id, text, key, with_ids)
    return pack(Scratch(df.sparkSession, "packing").save(made, "pieces"), capacity, keys=(key, "piece"))
