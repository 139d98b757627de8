"""Exact metric range join of embeddings.

Vectors are scaled to length one, where ``cosine >= t`` is a distance of at
most ``r = sqrt(2 - 2 t)``.  Each vector belongs to the cell of its nearest
pivot.  By the triangle inequality a vector can only have partners in
another cell if it lies within ``r`` of the plane between the two pivots
and within ``r`` of the cell's outermost vector, so copies go to those cells
alone; of two cells the later one gets them, so no pair is seen twice.
Cells are then joined independently, in blocks of bounded size.

Where the vectors have structure the bounds keep a vector in a few cells.
For vectors spread evenly over a sphere of many dimensions no bound of this
kind excludes much, and the join is a blocked comparison of all."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import Scratch, frugal, only, spread_join
from tabforge.llm.graph import components

NATIVES = 4096          # vectors of a cell that one task holds at once
PIVOT_SHARE = 16        # a cell has about this times sqrt(n) vectors
SAMPLE_PER_PIVOT = 8    # vectors drawn to choose a pivot from
SLACK = 1e-9            # on bounds, far above rounding errors


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(b.as_buffer(), "<f8") for b in column])


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@frugal
def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, length and doubles of each usable vector."""
    for batch in batches:
        ids, names, sizes, data = [], [], [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            v = None if not v.is_valid or v.values.null_count else v.values.to_numpy(zero_copy_only=False).astype("<f8")
            ok = v is not None and len(v) > 0 and bool(np.isfinite(v).all()) and bool(v.any())
            raw = (v + 0.0).tobytes() if ok else None      # -0.0 becomes 0.0
            ids.append(i)
            sizes.append(len(v) if ok else None)
            names.append(hashlib.blake2b(raw, digest_size=16).digest() if ok else None)
            data.append(raw)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.binary()),
                                          pa.array(sizes, pa.int32()), pa.array(data, pa.binary())],
                                         ["id", "name", "dim", "v"])


def _spread(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the sample, each the farthest from those before."""
    chosen, near = [0], 1 - sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        far = int(near.argmax())
        if near[far] <= 0:
            break
        chosen.append(far)
        near = np.minimum(near, 1 - sample @ sample[far])
    return sample[chosen]


def _home(pivots: dict[int, np.ndarray]):
    """The cell of each vector, its distance to the pivot."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            cell, away = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                cos = _unit(_matrix(batch.column(2).take(pa.array(at)))) @ pivots[dim].T
                cell[at] = cos.argmax(1)
                away[at] = np.sqrt(np.maximum(0, 2 - 2 * cos.max(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)],
                                             [*batch.schema.names, "cell", "away"])
    return run


def _visits(pivots: dict[int, np.ndarray], reach: dict[int, np.ndarray], r: float):
    """Each vector in its cell (``guest`` false) and in the later cells that
    the bounds can't exclude (``guest`` true)."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                dims, home = part.column(1).to_numpy(), part.column(4).to_numpy()
                rows, cells = [np.arange(len(dims))], [home]
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    p = pivots[dim]
                    cos = _unit(_matrix(part.column(2).take(pa.array(at)))) @ p.T
                    own = cos[np.arange(len(at)), home[at]]
                    apart = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)))[home[at]]
                    near = own[:, None] - cos <= (r + SLACK) * apart      # distance to the plane between the pivots
                    near &= np.sqrt(np.maximum(0, 2 - 2 * cos)) <= reach[dim] + r + SLACK
                    near &= np.arange(len(p)) > home[at][:, None]
                    i, j = np.nonzero(near)
                    rows.append(at[i])
                    cells.append(j)
                row, cell = np.concatenate(rows), np.concatenate(cells).astype(np.int32)
                out = part.take(pa.array(row))
                guest = np.arange(len(row)) >= len(dims)
                yield pa.RecordBatch.from_arrays(
                    [out.column(0), out.column(1), out.column(2), out.column(3), pa.array(cell), pa.array(guest)],
                    ["c", "dim", "v", "size", "cell", "guest"])
    return run


class _Block:
    """Natives of one part of a cell, and what they found."""

    def __init__(self, key: tuple, t: float):
        self.key, self.t = key, t
        self.ids: list[np.ndarray] = []
        self.vecs: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.done = False

    def add(self, ids, v, sizes) -> None:
        self.ids.append(ids)
        self.vecs.append(v)
        self.sizes.append(sizes)

    def seal(self) -> None:
        if self.done:
            return
        self.done = True
        self.c, self.v, self.size = np.concatenate(self.ids), np.concatenate(self.vecs), np.concatenate(self.sizes)
        self.u, self.root = _unit(self.v), np.arange(len(self.c))
        self.links = np.zeros(len(self.c), np.int64)
        hit = np.concatenate([self._hits(self.u[i:i + 512], self.v[i:i + 512]) for i in range(0, len(self.c), 512)])
        np.fill_diagonal(hit, False)
        self.links += hit @ self.size
        new = hit.any(1)
        for i in np.flatnonzero(new):
            if new[i]:      # everything reachable from i
                todo, new[i] = [i], False
                while todo:
                    found = np.flatnonzero(hit[todo.pop()] & new)
                    new[found] = False
                    self.root[found] = i
                    todo += found.tolist()

    def _hits(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        cos = u @ self.u.T
        hit = cos >= self.t
        # On the edge the definition itself decides.
        for i, j in zip(*np.nonzero(np.abs(cos - self.t) < 1e-12), strict=True):
            a, b = v[i], self.v[j]
            hit[i, j] = math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b))) >= self.t
        return hit

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _join(self, i: int, j: int) -> None:
        i, j = self._find(i), self._find(j)
        self.root[max(i, j)] = min(i, j)

    def meet(self, ids, v, sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of visitors; natives that share a visitor are joined."""
        hit = self._hits(_unit(v), v)
        self.links += sizes @ hit
        some = np.flatnonzero(hit.any(1))
        first = hit[some].argmax(1)
        for k, i in zip(some, first, strict=True):
            for j in np.flatnonzero(hit[k])[1:]:
                if self.root[j] != self.root[i]:
                    self._join(i, j)
        return ids[some], hit[some] @ self.size, self.c[first]

    def end(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        roots = np.array([self._find(i) for i in range(len(self.c))])
        keep = (self.links > 0) | (roots != np.arange(len(roots)))
        return self.c[keep], self.links[keep], self.c[roots[keep]]


def _join_cells(t: float):
    """Streams parts of cells: natives first (held), then visitors (not
    held).  Rows out: a vector, the links found here, a linked vector."""
    def out(found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], ["c", "links", "other"])

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: _Block | None = None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in (0, 1, 2)] +
                           [batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                k = tuple(key[:3, a].tolist())
                if block is None or block.key != k:
                    if block is not None:
                        block.seal()
                        yield out(block.end())
                    block = _Block(k, t)
                for at in range(a, b, 512):
                    part = batch.slice(at, min(512, b - at))
                    row = part.column(4).to_numpy(), _matrix(part.column(5)), part.column(6).to_numpy()
                    if key[3, a]:
                        block.seal()
                        yield out(block.meet(*row))
                    else:
                        block.add(*row)
        if block is not None:
            block.seal()
            yield out(block.end())
    return run


def near_duplicates(df: DataFrame, vector: str = "embedding", key: str = "vec_id", cosine: float = 0.9,
                    scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_links`` (other vectors with a
    cosine of at least ``cosine``, in double precision), ``component_id``
    (smallest key reachable by links, itself included) and ``kept``.

    Equal vectors are one class: they count as links of one another but are
    compared once.  Vectors that are null, empty, all zero or hold null, NaN
    or infinity link with nothing; vectors of different length neither.
    ``key`` must be a whole number that names a vector; a null key links
    with nothing and is kept.  No link is left out, whatever the shape of
    the data; see above for what that costs."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    spark = df.sparkSession
    scratch = scratch or Scratch(spark, "metric")
    r = math.sqrt(2 - 2 * cosine)
    rows = only(df, id=key, v=vector).select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    feats = scratch.save(rows.mapInArrow(_prepare, "id long, name binary, dim int, v binary"), "vectors")
    good = feats.where("name is not null and id is not null")
    groups = good.groupBy("name").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("size"))
    reps = good.join(groups, "name").where("id = c").groupBy("c").agg(
        F.first("dim").alias("dim"), F.first("v").alias("v"), F.first("size").alias("size"))
    reps = scratch.save(reps.select("c", "dim", "v", "size"), "classes")
    pivots = {}
    for dim, n in [(x["dim"], x["count"]) for x in reps.groupBy("dim").count().collect()]:
        cells = max(1, math.ceil(math.sqrt(n) / PIVOT_SHARE))
        drawn = reps.where(F.col("dim") == dim).orderBy(F.xxhash64("c"), "c").limit(cells * SAMPLE_PER_PIVOT).collect()
        pivots[dim] = _spread(_unit(np.stack([np.frombuffer(x["v"], "<f8") for x in drawn])), cells)
    at_home = scratch.save(reps.mapInArrow(_home(pivots), "c long, dim int, v binary, size long, cell int, away double"),
                           "cells")
    reach = {dim: np.full(len(p), -np.inf) for dim, p in pivots.items()}
    count: dict[tuple[int, int], int] = {}
    for x in at_home.groupBy("dim", "cell").agg(F.max("away").alias("away"), F.count(F.lit(1)).alias("n")).collect():
        reach[x["dim"]][x["cell"]] = x["away"]
        count[x["dim"], x["cell"]] = x["n"]
    parts = {k: math.ceil(n / NATIVES) for k, n in count.items()}
    visits = at_home.mapInArrow(_visits(pivots, reach, r),
                                "c long, dim int, v binary, size long, cell int, guest boolean")
    # A cell's natives are cut in parts; a native also visits the parts after
    # its own, a guest visits all.
    cells = spark.createDataFrame([(*k, math.ceil(n / NATIVES)) for k, n in count.items()], "dim int, cell int, parts int")
    own = F.pmod(F.xxhash64("c"), F.col("parts")).cast("int")
    dealt = visits.join(cells, ["dim", "cell"]).withColumn("own", own) \
        .withColumn("part", F.explode(F.sequence(F.when(F.col("guest"), 0).otherwise(F.col("own")), F.col("parts") - 1))) \
        .withColumn("visitor", F.col("guest") | (F.col("part") > F.col("own"))) \
        .select("dim", "cell", "part", "visitor", "c", "v", "size") \
        .repartition("dim", "cell", "part").sortWithinPartitions("dim", "cell", "part", "visitor")
    found = scratch.save(dealt.mapInArrow(_join_cells(cosine), "c long, links long, other long"), "links")
    comp = components(found.select(F.col("c").alias("a"), F.col("other").alias("b")), scratch)
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    of_class = groups.join(links, "c", "left").join(comp.withColumnRenamed("node", "c"), "c", "left") \
        .select("name", F.coalesce("component", "c").alias("root"),
                (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"))
    named = F.when(F.col("id").isNotNull(), F.col("name"))
    out = spread_join(feats.select("id", named.alias("name")), scratch.save(of_class, "answers"), "name", scratch)
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return out.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
