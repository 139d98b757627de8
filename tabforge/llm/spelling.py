"""Spelling variants: words of a vocabulary that are one edit apart.

The pairs are found by sorted-list dynamic programming.  In a sorted list of
words the edit matrix of a query is filled row by row along a candidate's
letters, three cells around the diagonal; the rows of the letters that the
next candidate shares with this one (their LCP) stay as they are, and as
soon as a row says that a prefix is more than one edit away, the whole range
of words with that prefix is skipped.

The lists are cut so that no task needs the whole vocabulary.  A pair of ``s``
and ``s`` or ``s + 1`` letters differs at one place, so it agrees on all
letters outside a free interval around that place: words of a group have the
same ``s``, the same interval and the same letters outside it.  At first the
interval is either half of the word; a group with more than ``GROUP`` words
halves its interval again, until it is one letter wide, where a group has no
more words than the alphabet has letters."""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import Scratch, frugal, only, partitions, prepare, slices

GROUP = 512             # words of a list; larger groups are cut again
HELD = 8 << 20          # bytes of counted words a task holds
SEGMENT = 1 << 20       # characters matched at once

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _runs(text: str) -> Iterator[list[str]]:
    """Runs of letters of a text, in lists of about a segment."""
    at = 0
    while at < len(text):
        end = at + SEGMENT
        while end < len(text) and _RUN.match(text, end):
            end = _RUN.match(text, end).end()
        yield _RUN.findall(text, at, end)
        at = end


def damaged(run: str, prefix: int, every: int) -> str:
    """The run without one letter, if ``every`` divides the hash of the
    document's key and the run."""
    h = zlib.crc32(run.encode(), prefix)
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return run


def _counter(every: int, least: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        held = 0
        for batch in slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                prefix = zlib.crc32(f"{'' if key is None else key}:".encode())
                own: Counter = Counter()
                for part in _runs(text or ""):
                    own.update(part)
                for word, n in own.items():
                    word = damaged(word.lower() if word.isascii() else word.translate(_LOWER), prefix, every)
                    if len(word) >= least:
                        if word not in counts:
                            held += 100 + sys.getsizeof(word)
                        counts[word] += n
                if held > HELD:
                    yield _table(counts)
                    counts, held = Counter(), 0
        yield _table(counts)
    return run


def _table(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                      ["word", "n"])


def vocabulary(df: DataFrame, text: str = "text", key: str = "doc_id", every: int = 199, least: int = 6, often: int = 5
               ) -> DataFrame:
    """``word, n``: runs of Latin-1 letters (only A-Z lower-cased) of whole
    texts with at least ``least`` letters and ``often`` occurrences.

    One occurrence in about ``every`` is misspelled on purpose, chosen by a
    hash of key and run (0: none); a null key hashes as empty text.  Null and
    empty texts have no run.  Repeated rows count again.  Tasks add up their
    own words before the shuffle."""
    prepare(df.sparkSession)
    return only(df, id=key, text=text).mapInArrow(_counter(every, least), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def lcps(words: list[str]) -> list[int]:
    """Letters that each word shares with the one before it (first: 0)."""
    out = [0]
    for a, b in zip(words, words[1:], strict=False):
        n = 0
        for x, y in zip(a, b, strict=False):
            if x != y:
                break
            n += 1
        out.append(n)
    return out


def skips(lcp: list[int]) -> list[int]:
    """For each place the next one with a smaller LCP (or the end), so a
    range of words with a shared prefix is passed in a few steps."""
    nxt = [len(lcp)] * len(lcp)
    stack: list[int] = []
    for i, n in enumerate(lcp):
        while stack and lcp[stack[-1]] > n:
            nxt[stack.pop()] = i
        stack.append(i)
    return nxt


def neighbours(words: list[str], lcp: list[int], below: list[int], q: int) -> Iterator[int]:
    """Places behind ``q`` in the sorted list whose words are at most one
    edit from word ``q``.

    ``rows[d]`` are the cells d-1, d, d+1 of the matrix row of a candidate's
    first d letters (2 stands for more than one edit)."""
    query = words[q]
    size = len(query)
    rows = [(2, 0, 1)]
    t, shared, end = q + 1, lcp[q + 1] if q + 1 < len(words) else 0, len(words)
    # The query's own rows are the diagonal: its letters match themselves.
    rows += [(1, 0, 1)] * min(shared, size)
    while t < end:
        word = words[t]
        d = min(shared, len(rows) - 1)
        del rows[d + 1:]
        lo, mid, hi = rows[d]
        dead = False
        for c in word[d:]:
            d += 1
            # In the row above, lo, mid and hi are the cells d-2, d-1 and d.
            a = min(lo + (d < 2 or d - 2 >= size or c != query[d - 2]), mid + 1, 2)
            b = min(mid + (d - 1 >= size or c != query[d - 1]), hi + 1, a + 1, 2)
            e = min(hi + (d >= size or c != query[d]), b + 1, 2)
            lo, mid, hi = a, b, e
            if a > 1 and b > 1 and e > 1:
                dead = True
                break
            rows.append((a, b, e))
        if not dead:
            over = size - len(word)
            if -1 <= over <= 1 and (lo, mid, hi)[over + 1] <= 1:
                yield t
            t += 1
            shared = lcp[t] if t < end else 0
            continue
        # All words that share these d letters are out: go to the first that doesn't.
        t += 1
        shared = d
        while t < end and lcp[t] >= d:
            t = below[t]
        shared = lcp[t] if t < end else 0


@frugal
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each list, in the list where the first letter that differs is free."""
    a: list[tuple] = []
    for s, i, j, words, counts in _lists(batches):
        if len(words) < 2:
            continue
        lcp = lcps(words)
        below = skips(lcp)
        for q, word in enumerate(words[:-1]):
            for t in neighbours(words, lcp, below, q):
                other = words[t]
                first = next((k for k, (x, y) in enumerate(zip(word, other, strict=False)) if x != y),
                             min(len(word), len(other)))
                if min(len(word), len(other)) == s and (i <= first < j or first == j == s):
                    a += (word, counts[q], other, counts[t]), (other, counts[t], word, counts[q])
        if len(a) > 20_000:
            yield _pairs(a)
            a = []
    yield _pairs(a)


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.string(), pa.int64(), pa.string(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                      ["word", "n", "near", "near_n"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, list[str], list[int]]]:
    """Runs of equal (s, i, j, rest): their words in code-point order."""
    now, words, counts = None, [], []
    for batch in batches:
        for *key, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != now:
                if words:
                    yield *now[:3], words, counts
                now, words, counts = key, [], []
            words.append(word)
            counts.append(n)
    if words:
        yield *now[:3], words, counts


def _rest(word: Column) -> Column:
    """Hash of the letters outside the free interval [i, j) of s letters."""
    return F.xxhash64(F.substring(word, F.lit(1), F.col("i")),
                      F.when(F.col("s") > F.col("j"), F.substring(word, F.col("j") - F.col("s"), F.col("s") - F.col("j")))
                      .otherwise(F.lit("")))


def near_pairs(words: DataFrame, scratch: Scratch, group: int = GROUP) -> DataFrame:
    """``word, n, near, near_n``: every ordered pair of distinct words that
    differ by one inserted, deleted or replaced letter.  ``words``: ``word,
    n``, each word once."""
    size = F.char_length("word")
    half = F.floor(F.col("s") / 2).cast("int")
    keyed = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("s")).where("s > 0") \
        .withColumn("cut", F.explode(F.array(F.struct(F.lit(0).alias("i"), half.alias("j")),
                                             F.struct(half.alias("i"), F.col("s").alias("j"))))) \
        .select("word", "n", "s", "cut.i", "cut.j").where("j > i")
    found, key, tasks = None, ["s", "i", "j", "rest"], partitions(words.sparkSession)
    while True:
        keyed = keyed.withColumn("rest", _rest(F.col("word")))
        large = scratch.save(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("words"))
                             .where((F.col("words") > group) & (F.col("j") - F.col("i") > 1)).select(*key), "large")
        last = large.isEmpty()
        small = keyed if last else keyed.join(large, key, "left_anti")
        # A fixed number: the bytes are few, the work per byte is not, so tasks are not to be merged by size.
        pairs = small.select(*key, "word", "n").repartition(tasks, *key).sortWithinPartitions(*key, "word") \
            .mapInArrow(_scan, "word string, n long, near string, near_n long")
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            return found
        mid = F.floor((F.col("i") + F.col("j")) / 2).cast("int")
        halves = F.array(F.struct(F.col("i").alias("i"), mid.alias("j")), F.struct(mid.alias("i"), F.col("j").alias("j")))
        keyed = scratch.save(keyed.join(large, key, "left_semi").withColumn("cut", F.explode(halves))
                             .select("word", "n", "s", "cut.i", "cut.j"), "halved")


def variants(words: DataFrame, ratio: int = 5, scratch: Scratch | None = None) -> DataFrame:
    """``word, n, form, form_n, root, n_near`` for each row of ``words``
    (``word, n``, each word once).

    A word's form is its near word with the largest n (ties: the smallest in
    code-point order), if that is at least ``ratio`` times its own; else
    null, as for a word without near words.  Its root is where following
    forms ends.  Forms grow by ``ratio`` each, so chains are short and have
    no circle; they are followed by doubling."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    scratch = scratch or Scratch(words.sparkSession, "spelling")
    words = scratch.save(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    near = near_pairs(words, scratch).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = scratch.save(
        words.join(near, "word", "left")
        .withColumn("has", F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False)))
        .select("word", "n", F.when(F.col("has"), F.col("best.word")).alias("form"),
                F.when(F.col("has"), -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0)).alias("n_near")),
        "forms")
    up = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        beyond = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = scratch.save(up.join(beyond, "root", "left")
                            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                            "roots")
        up = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return formed.join(up, "word", "left") \
        .select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")
