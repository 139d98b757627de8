"""MinHash near-duplicates by an inverted join over signature coordinates.

A signature has ``H`` coordinates; a document posts itself under its
(coordinate, value) pairs and two documents collide once per pair they
share.  Pairs with at least ``T`` collisions are candidates; full shingle
sets decide.  Two signatures with T shared pairs share one within the
``H - T + 1`` rarest pairs of each (prefix merging), so only those are
posted, and documents with fewer than T pairs that anyone shares post
nothing.

Copies (equal sets) are one class throughout.  Pairs are never written
out: first each class is checked against its best partner in each list,
which joins nearly all that belongs together.  Then only lists whose classes
are still in several components are merged again (skip merging), with the
full sets at hand: every class outside the list's largest component is held
against all others, and a link is reported only if it joins two
components.  So a large group of near copies costs a few rows per member,
and no link between different components is left out."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import Scratch, frugal, join_ids, only, spread_join
from tabforge.llm.graph import components
from tabforge.llm.shingles import mix, shingle_sets

H = 48          # coordinates
T = 26          # collisions asked for: at similarity 0.8 fewer come with probability 1e-5
CHUNK = 1024    # classes of a list in one chunk

_SEEDS = mix(np.arange(1, H + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = _SEEDS | np.uint64(1)


def signature(s: np.ndarray) -> np.ndarray:
    """Smallest of each coordinate's 32-bit hashes over a set."""
    out = np.full(H, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(s), 2048):
        part = (s[i:i + 2048, None] * _FACTORS + _SEEDS) >> np.uint64(32)
        out = np.minimum(out, part.min(0).astype(np.uint32))
    return out


def _features(k: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, sigs = [], [], []
            for s in shingle_sets(batch.column(1), k):
                sizes.append(len(s))
                names.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(sigs, pa.binary())],
                ["id", "n", "name", "sig"])
    return run


@frugal
def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each signature's coordinate-value pairs as one number."""
    place = np.arange(H, dtype=np.int64) << 32
    for batch in batches:
        for a in range(0, batch.num_rows, 2048):
            part = batch.slice(a, 2048)
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, H)
            yield pa.RecordBatch.from_arrays([pa.array((sig.astype(np.int64) | place).ravel()),
                                              pa.array(np.repeat(part.column(0).to_numpy(), H))], ["token", "c"])


def _set_rows(k: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1), k)], pa.binary())],
                ["c", "shingles"])
    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Runs of equal (token, part), the first two columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        if held:
            last = held[-1]
            if last.column(0)[-1].as_py() != key[0, 0] or last.column(1)[-1].as_py() != key[1, 0]:
                yield held
                held = []
        start = 0
        for cut in cuts.tolist():
            yield [*held, batch.slice(start, cut - start)]
            held, start = [], cut
        held.append(batch.slice(start))
    if held:
        yield held


def _column(parts: list[pa.RecordBatch], i: int) -> np.ndarray:
    return np.concatenate([p.column(i).to_numpy() for p in parts])


@frugal
def _best_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each class with the one of its list that it collides with most, if
    they collide often enough."""
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    held = 0
    for parts in _lists(batches):
        c = _column(parts, 2)
        if len(c) < 2:
            continue
        sig = np.frombuffer(b"".join(b for p in parts for b in p.column(3).to_pylist()), np.uint32).reshape(-1, H)
        for a in range(0, len(c), CHUNK):
            one, own = sig[a:a + CHUNK], c[a:a + CHUNK]
            n = np.zeros((len(one), len(one)), np.int16)
            for h in range(H):
                n += one[:, h, None] == one[None, :, h]
            np.fill_diagonal(n, -1)
            best = n.argmax(1)
            i = np.flatnonzero(n[np.arange(len(best)), best] >= T)
            left.append(own[i])
            right.append(own[best[i]])
            held += len(i)
        if held >= 20_000:
            yield _pairs(left, right)
            left, right, held = [], [], 0
    if held:
        yield _pairs(left, right)


def _missing_links(percent: int):
    """Links between components of a list, a spanning forest of them."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[int] = []
        right: list[int] = []
        for parts in _lists(batches):
            comp = _column(parts, 3)
            if len(comp) < 2 or (comp == comp[0]).all():
                continue
            c = _column(parts, 2)
            sets = [np.frombuffer(b.as_buffer(), np.uint64) for p in parts for b in p.column(4)]
            size = np.array([len(x) for x in sets])
            start = np.r_[0, np.cumsum(size)[:-1]]
            place = np.unique(np.concatenate(sets), return_inverse=True)[1]
            names, at, many = np.unique(comp, return_inverse=True, return_counts=True)
            mark = np.zeros(place.max() + 1, bool)
            for x in np.flatnonzero(at != many.argmax()):
                own = place[start[x]:start[x] + size[x]]
                mark[own] = True
                both = np.add.reduceat(mark[place], start, dtype=np.int64)
                mark[own] = False
                linked = (100 * both >= percent * (size + size[x] - both)) & (comp != comp[x])
                for j in np.flatnonzero(linked):
                    if comp[j] != comp[x]:
                        left.append(c[x])
                        right.append(c[j])
                        comp[comp == comp[j]] = comp[x]
            if len(left) >= 20_000:
                yield _pairs([np.array(left)], [np.array(right)])
                left, right = [], []
        if left:
            yield _pairs([np.array(left)], [np.array(right)])
    return run


def _pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(left), np.concatenate(right)
    ab = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    ab = ab[:, ab[0] != ab[1]]
    return pa.RecordBatch.from_arrays([pa.array(ab[0]), pa.array(ab[1])], ["a", "b"])


def _verify(percent: int):
    """Keep pairs with 100 * intersection >= percent * union."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) < percent * len(y):
                    ok.append(False)
                    continue
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])
    return run


def _postings(reps: DataFrame, scratch: Scratch) -> DataFrame:
    """``token, c, sig, n``: prefix postings in lists of two and more, with
    the list's length."""
    tokens = reps.select("c", "sig").mapInArrow(_post, "token long, c long")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = tokens.join(often, "token").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"))
    # Pairs that nobody shares are the rarest and take the first places of the prefix.
    prefix = shared.where(F.size("t") >= T).select("c", F.explode(F.slice(
        "t", F.lit(1), F.greatest(F.size("t") - F.lit(T - 1), F.lit(0)))).alias("t")).select("c", "t.token")
    lists = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return scratch.save(prefix.join(lists, "token").join(reps.select("c", "sig"), "c").select("token", "c", "sig", "n"),
                        "postings")


def _deal(lists: DataFrame, every: bool, columns: list[str]) -> DataFrame:
    """Rows dealt by list so that no task gets a whole long list: its classes
    are cut in chunks.  For ``every`` two chunks meet in one part."""
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    rows = lists.withColumn("chunks", chunks).withColumn("part", F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int"))
    if every:
        partner = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: (F.col("chunks") == 1) | (o != F.col("part")))
        rows = rows.withColumn("other", F.explode(partner)) \
            .withColumn("part", F.least("part", "other") * F.col("chunks") + F.greatest("part", "other"))
    return rows.select("token", "part", "c", *columns) \
        .repartition("token", "part").sortWithinPartitions("token", "part", "c")


def classes(df: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80,
            scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_shingles``, ``component_id``
    (smallest key reachable by links, itself included) and ``kept`` (it is
    its component's smallest).

    Two texts are linked when their sets of distinct ``k``-word shingles
    have ``100 * intersection >= percent * union``.  A text with fewer words
    has its whole sequence as its one shingle; null, empty and blank texts
    have none, link with nothing and are kept.  ``key`` must be a whole
    number that names a text; repeated rows get the same answer, a null key
    gets a null component and is kept.  Signatures make a link at exactly
    the threshold go unseen with a probability of about 1e-5; confirmed
    links are exact."""
    scratch = scratch or Scratch(df.sparkSession, "minhash")
    docs = only(df, id=key, text=text).select(F.col("id").cast("long").alias("id"), "text")
    feats = scratch.save(docs.mapInArrow(_features(k), "id long, n long, name binary, sig binary"), "features")
    # Signatures are equal within a class, so any will do.
    groups = feats.where("n > 0 and id is not null").groupBy("name").agg(F.min("id").alias("c"))
    reps = scratch.save(feats.select("id", "name", "sig").join(groups, "name").where("id = c")
                        .groupBy("c").agg(F.first("sig").alias("sig")), "classes")
    posts = _postings(reps, scratch)
    scratch.drop(reps)
    wanted = scratch.save(posts.select("c").distinct(), "wanted")
    sets = scratch.save(join_ids(docs, wanted, docs["id"] == wanted["c"], 16).groupBy("c").agg(F.first("text").alias("text"))
                        .mapInArrow(_set_rows(k), "c long, shingles binary"), "sets")
    pairs = scratch.save(_deal(posts, False, ["sig"]).mapInArrow(_best_partners, "a long, b long").distinct(), "pairs")
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("x")), "a") \
        .join(sets.select(F.col("c").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    comp = scratch.save(components(both.mapInArrow(_verify(percent), "a long, b long"), scratch), "components")
    rows = posts.drop("sig").join(comp.withColumnRenamed("node", "c"), "c", "left") \
        .withColumn("comp", F.coalesce("component", "c")).select("token", "c", "n", "comp")
    # A list whose classes are all in one component has nothing to add.
    mixed = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    rows = rows.join(mixed, "token", "left_semi").join(sets, "c")
    links = _deal(rows, True, ["comp", "shingles"]).mapInArrow(_missing_links(percent), "a long, b long")
    at = comp.select("node", "component")
    for end in ("a", "b"):      # links between classes become links between components
        links = links.join(at.select(F.col("node").alias(end), F.col("component").alias(f"{end}_to")), end, "left") \
            .withColumn(end, F.coalesce(f"{end}_to", end)).drop(f"{end}_to")
    found = scratch.save(components(links.select("a", "b"), scratch), "components")
    up = found.select(F.col("node").alias("component"), F.col("component").alias("root"))
    moved = comp.join(up, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    alone = found.join(comp, "node", "left_anti").select("node", "component")
    of_class = groups.join(moved.unionByName(alone).withColumnRenamed("node", "c"), "c", "left") \
        .select("name", F.coalesce("component", "c").alias("c"))
    out = spread_join(feats.select("id", "n", "name"), scratch.save(of_class, "answers"), "name", scratch)
    component = F.when(F.col("id").isNotNull(), F.coalesce("c", "id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
