"""Language identification by error-correcting output codes.

Each language has a binary codeword.  One binary classifier per code bit
(class-balanced naive Bayes over hashed byte trigrams) tells the languages
with a 1 from those with a 0.  Decoding sums a logistic loss over the bits,
each weighted by how well that classifier did for that language on the
training rows, and takes the codeword with the smallest loss; when two
codewords are nearly as near, the row is flagged as ambiguous."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import batches_of_text, frugal, only, prepare

BUCKETS = 1 << 13      # hashed trigrams; bounds the model whatever the corpus
SMOOTHING = 1e-6       # added to a trigram's share of a language
SHARE = 1 << 20        # trigram shares are summed as integers, so order can't matter
SHARPNESS = 3.0        # mean log-odds per trigram -> loss argument
AMBIGUOUS = 0.05       # two losses closer than this share of the worst loss are ambiguous
EXHAUSTIVE_UP_TO = 6   # languages for which every split of them is a bit

# Byte classes: letters fold to lower case, all other ASCII is a blank,
# bytes of longer characters stay.
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """``(n, bits)`` matrix of -1 / +1.  Up to six languages: every split of
    the languages once.  More: the best of many random dense codes, by the
    smallest distance between two codewords."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE_UP_TO:
        rest = np.array(list(itertools.product((-1, 1), repeat=n - 1)))[:-1].T
        return np.vstack([np.ones((1, rest.shape[1])), rest])
    rng, bits, best, far = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        code = rng.choice((-1.0, 1.0), (n, bits))
        apart = bits - code @ code.T
        np.fill_diagonal(apart, np.inf)
        # A bit that all languages share tells nothing.
        if apart.min() > far and (np.abs(code.sum(0)) < n).all():
            best, far = code, apart.min()
    return best


def _grams(text: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams of a text's folded bytes, blanks around."""
    b = np.empty(text.size + 2, np.uint32)
    b[0] = b[-1] = 32
    b[1:-1] = _FOLD[text]
    g = b[:-2] | b[1:-1] << 8 | b[2:] << 16
    return (g * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column, without a copy."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)


def _shares(column: pa.Array, rows: range) -> tuple[np.ndarray, np.ndarray]:
    """Trigram shares per row and whether the row has a letter at all."""
    at, data = _buffers(column)
    out, letter = np.zeros((len(rows), BUCKETS), np.float32), np.zeros(len(rows), bool)
    for k, i in enumerate(rows):
        text = data[at[i]:at[i + 1]]
        if text.size:
            out[k] = np.bincount(_grams(text), minlength=BUCKETS)
            out[k] /= text.size
    strings = column.slice(rows.start, len(rows)).to_pylist()
    for k, s in enumerate(strings):
        letter[k] = bool(s) and any(map(str.isalpha, s))
    return out, letter


def _counter(bits_of: dict[str, int]):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(bits_of), BUCKETS), np.int64)
        docs = np.zeros(len(bits_of), np.int64)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, b in batches_of_text(batch, 0):
                share, letter = _shares(batch.column(0), range(a, b))
                scaled = np.rint(share * SHARE).astype(np.int64)
                for k in np.flatnonzero(letter):
                    total[bits_of[langs[a + k]]] += scaled[k]
                    docs[bits_of[langs[a + k]]] += 1
        at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[at, np.arange(len(docs))], pa.int32()),
             pa.array(np.r_[bucket, np.full(len(docs), -1)], pa.int32()),
             pa.array(np.r_[total[at, bucket], docs], pa.int64())], ["lang", "bucket", "n"])
    return run


class Model:
    """Codewords, one weight vector per bit and the decoding weights."""

    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray, trust: np.ndarray | None = None):
        self.langs, self.code, self.weights = langs, code, weights.astype(np.float32)
        self.trust = np.full(code.shape, 1 / max(1, code.shape[1])) if trust is None else trust

    def margins(self, shares: np.ndarray) -> np.ndarray:
        return (shares @ self.weights).astype(np.float64)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every codeword, ``(rows, languages)``."""
        out = np.empty((len(margins), len(self.langs)))
        for i in range(len(self.langs)):
            out[:, i] = np.logaddexp(0, -SHARPNESS * margins * self.code[i]) @ self.trust[i]
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword, a score in (0, 1] and the ambiguity flag."""
        loss = self.losses(margins)
        best = loss.argmin(1)
        odds = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
        score = 1 / odds.sum(1)
        if len(self.langs) < 2:
            return best, score, np.zeros(len(best), bool)
        two = np.partition(loss, 1, axis=1)
        return best, score, (two[:, 1] - two[:, 0]) < AMBIGUOUS * np.maximum(loss.max(1), 1e-12)


def _judge(model: Model, bits_of: dict[str, int]):
    """Per language and bit: training rows whose bit came out right."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = np.zeros(model.code.shape, np.int64)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, b in batches_of_text(batch, 0):
                share, letter = _shares(batch.column(0), range(a, b))
                good = np.sign(model.margins(share))
                for k in np.flatnonzero(letter):
                    i = bits_of[langs[a + k]]
                    right[i] += good[k] == model.code[i]
        at, bit = np.nonzero(right)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(bit, pa.int32()),
                                          pa.array(right[at, bit], pa.int64())], ["lang", "bucket", "n"])
    return run


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", judged: int = 20_000) -> Model:
    """Learn from the rows whose text and language are not null.

    Trigram counts come from every row; each task adds up its own and only
    ``languages x BUCKETS`` numbers leave it.  The decoding weights come
    from about ``judged`` rows (all, if there are fewer), chosen by a hash
    of the text.  Texts without a letter teach nothing.  Without any row to
    learn from the model has no language and every prediction is ``und``."""
    spark = rows.sparkSession
    prepare(spark)
    data = only(rows, text=text, lang=lang).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    found = data.groupBy("lang").count().orderBy("lang").collect()   # one row per language
    langs, n = [r["lang"] for r in found], sum(r["count"] for r in found)
    if not langs:
        return Model([], np.ones((0, 1)), np.zeros((BUCKETS, 1)))
    bits_of = {k: i for i, k in enumerate(langs)}
    counted = data.mapInArrow(_counter(bits_of), "lang int, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    share, docs = np.zeros((len(langs), BUCKETS)), np.zeros(len(langs))
    for r in counted.collect():     # at most languages x (BUCKETS + 1) rows
        if r["bucket"] < 0:
            docs[r["lang"]] = r["n"]
        else:
            share[r["lang"], r["bucket"]] = r["n"] / SHARE
    share = share / np.maximum(docs, 1)[:, None] + SMOOTHING
    share /= share.sum(1, keepdims=True)
    code = codewords(len(langs))
    weights = np.zeros((BUCKETS, code.shape[1]))
    for b in range(code.shape[1]):
        one, zero = share[code[:, b] > 0], share[code[:, b] < 0]
        if len(one) and len(zero):
            weights[:, b] = np.log(one.mean(0)) - np.log(zero.mean(0))
    model = Model(langs, code, weights)
    part = data if n <= judged else data.where(F.pmod(F.xxhash64("text"), F.lit(n)) < judged)
    right = np.zeros(code.shape)
    seen = {r["lang"]: r["count"] for r in part.groupBy("lang").count().collect()}
    for r in part.mapInArrow(_judge(model, bits_of), "lang int, bucket int, n long") \
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        right[r["lang"], r["bucket"]] = r["n"]
    right /= np.maximum([seen.get(k, 0) for k in langs], 1)[:, None]
    right = np.maximum(right, 1e-3)
    model.trust = right / right.sum(1, keepdims=True)
    return model


def _predictor(model: Model):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            lang, score, unsure = ["und"] * n, np.zeros(n), np.zeros(n, bool)
            for a, b in batches_of_text(batch, 0):
                share, letter = _shares(batch.column(0), range(a, b))
                if not model.langs or not letter.any():
                    continue
                best, s, u = model.decode(model.margins(share))
                for k in np.flatnonzero(letter):
                    lang[a + k], score[a + k], unsure[a + k] = model.langs[best[k]], s[k], u[k]
            cols = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)],
                [*batch.schema.names[1:], "lang_pred", "score", "ambiguous"])
    return run


def predict(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus ``lang_pred``, ``score`` (0 to 1) and
    ``ambiguous`` for every row; reads the whole text and nothing else.
    Null text or one without a letter: ``und``, score 0, not ambiguous.
    Repeated rows get the same answer.  No shuffle."""
    prepare(df.sparkSession)
    own = only(df, __text=text, **{k: k for k in keep})
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[1:]),
                        "lang_pred string", "score double", "ambiguous boolean"])
    return own.mapInArrow(_predictor(model), schema)
