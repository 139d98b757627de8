"""Ranked lexical search by bag deduplication.

Documents are cut down to the items' vocabulary: what a document scores for
any item depends on its counts of those terms (the bag) and on its length
factor ``m`` alone.  Documents with the same bag and ``m`` are one class,
found by a hash and verified by the bag itself.  A class is scored once
against all items, and only the classes that reach an item's best are
expanded into their members, smallest key first.

Items are taken in blocks of bounded size; each block reads the documents
once."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabforge.llm.common import Scratch, frugal, only

BLOCK_BYTES = 4 << 20   # text of the items of a block, about
BLOCK_ITEMS = 2000      # items of a block, about
SEGMENT = 1 << 20       # bytes of text cut into terms at once
CELLS = 1 << 19         # scores held at once

# Terms are runs of ASCII letters, digits and everything that is not ASCII;
# only A-Z are lower-cased.  On UTF-8 that is a table of bytes.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                    for b in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a whole text, in lists of about a segment each."""
    data = (text or "").encode().translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SEGMENT)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


@dataclass
class Items:
    """A block of items: their vocabulary and, per term, which items hold it
    how often (``start`` cuts ``item`` and ``times`` by term)."""

    ids: list
    vocabulary: dict[bytes, int]
    start: np.ndarray
    item: np.ndarray
    times: np.ndarray


def read_items(rows: list[tuple]) -> Items:
    """``rows``: (id, text); rows with one id are one item."""
    held: dict = defaultdict(Counter)
    for key, text in rows:
        for part in terms(text):
            held[key].update(part)
    ids = list(held)
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in held.values() for t in c}))}
    post = sorted((vocabulary[t], i, n) for i, c in enumerate(held.values()) for t, n in c.items())
    post = np.array(post, np.int64).reshape(-1, 3)
    return Items(ids, vocabulary, np.searchsorted(post[:, 0], np.arange(len(vocabulary) + 1)), post[:, 1], post[:, 2])


def _bags(shared):
    """Length and bag of each text: pairs of term number and count."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.vocabulary.get
        for batch in batches:
            lengths, bags = [], []
            for text in batch.column(1):
                n, bag = 0, Counter()
                for part in terms(text.as_py()):
                    n += len(part)
                    bag.update(map(known, part))
                bag.pop(None, None)
                lengths.append(n)
                bags.append(np.array(sorted(bag.items()), "<u4").tobytes() if bag else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(bags, pa.binary())],
                                             ["id", "n", "bag"])
    return run


def _bag_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of all entries of a column of bags."""
    parts = [np.frombuffer(b.as_buffer(), "<u4").reshape(-1, 2) if b.is_valid else np.empty((0, 2), "<u4") for b in column]
    rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    both = np.concatenate(parts).astype(np.int64) if parts else np.empty((0, 2), np.int64)
    return rows, both[:, 0], both[:, 1]


def _statistics(size: int):
    """Documents per term; at -1 the documents with a term, at -2 all terms."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n = batch.column(0).to_numpy()
            docs, total = docs + int((n > 0).sum()), total + int(n.sum())
            df += np.bincount(_bag_arrays(batch.column(1))[1], minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1, -2]), pa.array(np.r_[df[at], docs, total])], ["term", "n"])
    return run


def _best(shared, weights: np.ndarray, k: int, item_type: pa.DataType, members_type: pa.DataType):
    """Score each class against all items of the block; per item the ``k``
    best classes of the task by score and smallest member."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        many = len(items.ids)
        value = weights[np.repeat(np.arange(len(weights)), np.diff(items.start))] * items.times
        board: list[list] = [[] for _ in range(many)]   # per item: (-score, no id, id, members)
        least = np.ones(many, np.int64)                 # score that still counts
        step = max(1, CELLS // max(1, many))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                m = part.column(0).to_numpy()
                row, term, tf = _bag_arrays(part.column(1))
                gain = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
                wide = items.start[term + 1] - items.start[term]
                # All (row, posting) pairs of the bags' terms.
                at = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide) + np.repeat(items.start[term], wide)
                score = np.zeros(part.num_rows * many, np.int64)
                np.add.at(score, np.repeat(row, wide) * many + items.item[at], np.repeat(gain, wide) * value[at])
                score = score.reshape(-1, many)
                new: dict[int, list[int]] = defaultdict(list)
                for r, i in np.argwhere(score >= least).tolist():
                    new[i].append(r)
                for i, rows in new.items():
                    for r in rows:
                        members = part.column(2)[r].as_py()
                        first = members[0]
                        board[i].append((-int(score[r, i]), first["none"], 0 if first["none"] else first["id"], r, members))
                    board[i].sort(key=lambda e: e[:3])
                    del board[i][k:]
                    if len(board[i]) == k:
                        least[i] = -board[i][-1][0]
        found = [(items.ids[i], -e[0], e[4]) for i, entries in enumerate(board) for e in entries]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], item_type), pa.array([f[1] for f in found], pa.int64()),
             pa.array([f[2] for f in found], members_type)], ["item", "score", "members"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", key: str = "doc_id",
           item_text: str = "text", item_key: str = "item_id", scratch: Scratch | None = None) -> DataFrame:
    """``item_key, rank, key, score``: each item's ``k`` best documents with
    a score above 0, equal scores by ascending key (null last).

    With N documents that have a term, L terms in all, n terms in a document,
    df documents holding a term and tf its occurrences: a term weighs
    ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``, a document has
    ``m = 25 + 75 n N div L``, and its score adds ``w * (10^9 tf div (1000 tf
    + 8 m))`` over the item's terms, repeats included.

    Every row of ``docs`` is a document, repeated rows and keys too.  Null
    and empty texts have no term: they are in no result and not in N.  Items
    without a term have no row; rows of ``items`` with one key are one item.
    Members of a class that a third of all rows share are cut to ``k`` per
    task before they meet."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "lexical")
    own = only(docs, id=key, text=text)
    asked = only(items, id=item_key, text=item_text)
    size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, math.ceil(size[0] / BLOCK_ITEMS), math.ceil((size[1] or 0) / BLOCK_BYTES))
    found = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        part = _search(own, read_items([tuple(r) for r in rows]), asked.schema["id"].dataType, k, scratch)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select(F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score")


def _search(docs: DataFrame, block: Items, item_type, k: int, scratch: Scratch) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(block)
    bags = scratch.save(docs.mapInArrow(_bags(shared), f"id {kind}, n long, bag binary").where("n > 0"), "bags")
    counted = {r["term"]: r["n"] for r in bags.select("n", "bag").mapInArrow(
        _statistics(len(block.vocabulary)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    many, total = counted.get(-1, 0), max(1, counted.get(-2, 0))
    df = np.array([counted.get(i, 0) for i in range(len(block.vocabulary))], np.int64)
    weights = np.array([math.floor(1000 * math.log((2 * many + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    m = F.expr(f"25 + (cast(75 * n as decimal(20, 0)) * cast({many} as decimal(18, 0))) div cast({total} as decimal(20, 0))")
    member = F.struct(F.col("id").isNull().alias("none"), "id")
    same = ("hash", "m", "bag")
    lead = Window.partitionBy(*same).orderBy(F.asc_nulls_last("id"))
    classes = bags.where("bag is not null").select("id", "bag", m.cast("long").alias("m")) \
        .withColumn("hash", F.xxhash64("bag", "m")) \
        .withColumn("place", F.row_number().over(lead)).where(F.col("place") <= k) \
        .groupBy(*same).agg(F.sort_array(F.collect_list(member)).alias("members"))
    classes = classes.select("m", "bag", "members")
    types = to_arrow_type(item_type), to_arrow_type(classes.schema["members"].dataType)
    best = classes.mapInArrow(_best(shared, weights, k, *types),
                              f"item {item_type.simpleString()}, score long, members array<struct<none: boolean, id: {kind}>>")
    return best.select("item", "score", F.explode("members.id").alias("id"))
