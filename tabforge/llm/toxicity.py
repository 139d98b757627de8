"""Toxicity by a weighted lexicon.

Texts are folded (case, look-alike letters of other scripts, digits and
signs that stand for letters, invisible characters), matched against the
lexicon by one Aho-Corasick pass, hits inside exception phrases are taken
off, and the weights are normalised by the text's length.  An entry is a
word (``idiot$``) or a stem that starts words (``idiot``).  Lexicon,
exceptions and calibration are learned from labelled rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import Scratch, frugal, only, prepare, slices

# Look-alikes and what they are read as.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ɡ": "g", "һ": "h", "н": "h", "і": "i", "ї": "i",
    "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v",
    "ԝ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
INVISIBLE = (0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF, *range(0x300, 0x370))

STEMS = range(3, 13)        # lengths of stems tried
MIN_CONTEXTS = 5            # pairs of neighbours an entry must have in toxic texts
CLEAN_SHARE = 0.02          # an entry's clean texts against its toxic texts, at most
SAME = 0.95                 # share of a stem's contexts that makes longer ones as good
FIT_ROWS = 20_000           # labelled rows that the exceptions and the calibration see
CONTEXT_DOCS = 5            # clean texts that must hold an exception phrase

_WORD = re.compile(r"[^\W\d_]+")
_HARD = re.compile(r"[\d@$!]")


def _table() -> dict[int, str | None]:
    out: dict[int, str | None] = {ord(k): v for k, v in LOOKALIKES.items()}
    out |= {c: None for c in INVISIBLE}
    out |= {0xFF01 + i: chr(0x21 + i).lower() for i in range(94)}     # full-width forms
    return out


_LOOKALIKE = _table()
_SIGN = str.maketrans(SIGNS)
_MIXED = re.compile(r"(?:(?<=[^\W\d_])|(?=[\d@$!]+[^\W\d_]))[\d@$!]+(?=\w*)")


def fold(text: str) -> str:
    """Lower case, look-alikes as Latin letters, signs and digits that touch
    a letter as the letters they stand for.  Numbers stay numbers."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_LOOKALIKE)
    if _HARD.search(text):
        # A sign at a word's end is punctuation more often than a letter.
        text = _MIXED.sub(lambda m: m[0].translate(_SIGN) if m.end() < len(m.string) and m.string[m.end()].isalpha()
                          or m[0][-1].isdigit() else m[0], text)
    return text


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the calibration of
    ``log1p(weight)`` and ``log1p(weight per 100 words)`` to a probability."""

    weights: Mapping[str, float]
    exceptions: Sequence[str] = ()
    bias: float = -4.0
    total: float = 2.0
    density: float = 1.0
    _automaton: object = field(default=None, repr=False)

    def automaton(self):
        import ahocorasick

        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for phrase in self.exceptions:
                self._automaton.add_word(phrase, (len(phrase), None, 0.0))
            for entry, weight in self.weights.items():
                word = entry.rstrip("$")
                self._automaton.add_word(word, (len(word), entry.endswith("$"), float(weight)))
            if len(self._automaton):
                self._automaton.make_automaton()
        return self._automaton

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Spans in the folded text with their weights: entries that start a
        word (and end it, if marked), outside exception phrases, the longest
        of those that start together."""
        a = self.automaton()
        if not len(a):
            return []
        spans: dict[int, tuple[int, float]] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, whole, weight) in a.iter(folded):
            start = end + 1 - size
            if start and folded[start - 1].isalpha():
                continue
            ends = end + 1 == len(folded) or not folded[end + 1].isalpha()
            if whole is None:
                if ends:
                    excused.append((start, end + 1))
            elif ends or not whole:
                spans[start] = (end + 1, weight)    # later ends are longer
        return [(s, e, w) for s, (e, w) in sorted(spans.items())
                if not any(a <= s and e <= b for a, b in excused)]

    def features(self, text: str) -> tuple[float, float, int]:
        folded = fold(text)
        found = self.hits(folded)
        weight = math.fsum(w for _, _, w in found)
        if not found:
            return 0.0, 0.0, 0
        words = max(1, len(folded.split()))
        return math.log1p(max(weight, 0.0)), math.log1p(max(weight, 0.0) * 100 / words), len(found)

    def score(self, text: str | None) -> tuple[float, int]:
        total, density, n = self.features(text or "")
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.total * total + self.density * density)))), n


@frugal
def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clean texts (-1) and toxic texts (-2) with each folded word, and each
    word of a toxic text with a digest of its two neighbours; a task adds up
    its own."""
    def flush() -> pa.RecordBatch:
        keys = list(counts)
        out = pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in keys], pa.string()), pa.array([c for _, c in keys], pa.int64()),
             pa.array(list(counts.values()), pa.int64())], ["w", "context", "n"])
        counts.clear()
        return out

    counts: Counter = Counter()
    for batch in slices(batches):
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = _WORD.findall(fold(text))
            if label:
                counts.update({(w, zlib.crc32(f"{a} {c}".encode()))
                               for a, w, c in zip(["", *words], words, [*words[1:], ""], strict=False)})
            counts.update((w, -2 if label else -1) for w in set(words))
            if len(counts) > 100_000:
                yield flush()
    yield flush()


def _stems(words: DataFrame) -> DataFrame:
    """Words and their leading letters with the clean texts (``clean``), the
    toxic texts (``toxic``) and the distinct toxic contexts (``bad``) they
    stand in."""
    stems = F.transform(F.sequence(F.lit(STEMS.start), F.least(F.length("w"), F.lit(STEMS.stop - 1))),
                        lambda n: F.substring("w", F.lit(1), n))
    entry = F.explode(F.concat(F.array(F.concat("w", F.lit("$"))),
                               F.when(F.length("w") >= STEMS.start, stems).otherwise(F.array().cast("array<string>"))))
    return words.select(entry.alias("entry"), "clean", "toxic", "bad").groupBy("entry") \
        .agg(*[F.sum(c).alias(c) for c in ("clean", "toxic", "bad")])


def _choose(support: dict[str, int]) -> list[str]:
    """Of the entries that qualify, those that say the same in the fewest and
    longest stems: from each shortest stem on, go down as long as one to
    three longer ones (or whole words) keep ``SAME`` of the contexts."""
    below = defaultdict(list)
    for e in support:
        word = e.rstrip("$")
        below[word if e.endswith("$") else word[:-1]].append(e)
    out, todo = [], [e for e in support if not e.endswith("$") and e[:-1] not in support
                     or e.endswith("$") and e[:-1][:STEMS.stop - 1] not in support]
    while todo:
        e = todo.pop()
        longer = sorted(below[e], key=support.get, reverse=True)[:3] if not e.endswith("$") else []
        kept = 0
        for k, x in enumerate(longer):
            kept += support[x]
            if kept >= SAME * support[e]:
                todo += longer[:k + 1]
                break
        else:
            out.append(e)
    return sorted(out)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Ridge logistic regression by Newton's method, classes balanced."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - y)) + ridge * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def fit(rows: DataFrame, text: str = "text", label: str = "toxic", exceptions: Sequence[str] = (),
        fit_rows: int = FIT_ROWS) -> Lexicon:
    """Learn from rows with a text and a 0/1 label.

    Words are counted over all rows.  What counts
    for an entry are its distinct neighbours in toxic texts, so a toxic text
    with many near copies doesn't make its own words entries; its clean texts
    may be ``CLEAN_SHARE`` of its toxic ones, whatever the number of rows.
    All entries that pass both rules reach the driver and the tasks; their
    number follows the vocabulary of toxic texts, not the rows.  About
    ``fit_rows`` rows (all, if there are fewer), chosen by a hash of the
    text, give the exceptions and calibrate the score.  ``exceptions`` are phrases in which
    hits don't count; pairs of words with a hit that stand in clean rows but
    in no toxic one are added.  With rows of one class only the lexicon is
    empty and every score is below a half."""
    spark = rows.sparkSession
    prepare(spark)
    data = only(rows, text=text, y=label).where(F.col("text").isNotNull() & F.col("y").isin(0, 1)) \
        .select("text", F.col("y").cast("int").alias("y"))
    contexts = data.mapInArrow(_word_counts, "w string, context long, n long") \
        .groupBy("w", "context").agg(F.sum("n").alias("n"))
    words = contexts.groupBy("w").agg(
        F.sum(F.when(F.col("context") == -1, F.col("n")).otherwise(0)).alias("clean"),
        F.sum(F.when(F.col("context") == -2, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("context") >= 0, 1).otherwise(0)).alias("bad"))
    n = {r["y"]: r["count"] for r in data.groupBy("y").count().collect()}
    if not n.get(1) or not n.get(0):
        return Lexicon({}, tuple(fold(p) for p in exceptions))
    scratch = Scratch(spark, "toxicity")
    words = scratch.save(words, "words")
    # So many toxic contexts and no clean text that not one of all the words
    # would get there by chance.
    chance = n[1] / (n[0] + n[1])
    least = max(MIN_CONTEXTS, math.ceil((math.log(max(1, words.count())) + 3) / -math.log(chance)))
    top = _stems(words).where((F.col("bad") >= least) & (F.col("clean") <= CLEAN_SHARE * F.col("toxic"))) \
        .orderBy(F.desc("bad"), "entry").collect()
    odds = {r["entry"]: math.log((r["bad"] + 0.5) / (n[1] + 1)) - math.log((r["clean"] + 0.5) / (n[0] + 1)) for r in top}
    chosen = _choose({r["entry"]: r["bad"] for r in top})
    share = sum(n.values())
    part = data if share <= fit_rows else data.where(F.pmod(F.xxhash64("text"), F.lit(share)) < fit_rows)
    part = scratch.save(part, "sample")
    weights = {e: odds[e] for e in chosen if odds[e] > 0}
    lexicon = Lexicon(weights, tuple(fold(p) for p in exceptions))
    pairs = part.mapInArrow(_contexts(lexicon), "pair string, y int") \
        .groupBy("pair").agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("n")) \
        .where((F.col("bad") == 0) & (F.col("n") >= CONTEXT_DOCS)).orderBy(F.desc("n"), "pair").collect()
    lexicon = Lexicon(weights, (*lexicon.exceptions, *(r["pair"] for r in pairs)))
    x = part.mapInArrow(_feature_rows(lexicon), "total double, density double, y int") \
        .groupBy("total", "density", "y").count().collect()
    if not x:
        return lexicon
    table = np.array([(r["total"], r["density"], r["y"], r["count"]) for r in x], float)
    table = np.repeat(table[:, :3], table[:, 3].astype(int), axis=0)
    beta = _logistic(table[:, :2], table[:, 2])
    # More weight must never lower the score.
    return Lexicon(weights, lexicon.exceptions, float(beta[0]), float(max(beta[1], 0)), float(max(beta[2], 0)))


def _contexts(lexicon: Lexicon):
    """Per row, the pairs of words that a hit is part of, once each."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pairs, labels = [], []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded, got = fold(text), set()
                for start, end, _ in lexicon.hits(folded):
                    left = re.search(r"[^\W\d_]+ $", folded[max(0, start - 40):start])
                    word = _WORD.match(folded, start)[0]
                    right = re.match(r" [^\W\d_]+", folded[start + len(word):start + len(word) + 40])
                    if left:
                        got.add(left[0] + word)
                    if right:
                        got.add(word + right[0])
                pairs += sorted(got)
                labels += [y] * len(got)
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array(labels, pa.int32())], ["pair", "y"])
    return run


def _feature_rows(lexicon: Lexicon):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            f = [lexicon.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _, _ in f], pa.float64()),
                                              pa.array([b for _, b, _ in f], pa.float64()), batch.column(1)],
                                             ["total", "density", "y"])
    return run


def score(df: DataFrame, lexicon: Lexicon, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus ``score`` (0 to 1, higher is more toxic),
    ``predicted`` (1 from a half on) and ``hits`` (entries found) for each
    whole text.  Null and empty texts have no hit and score like any clean
    text.  Repeated rows get the same score.  No shuffle; the lexicon
    travels with the task."""
    prepare(df.sparkSession)
    own = only(df, __text=text, **{k: k for k in keep})
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[1:]),
                        "score double, predicted int, hits int"])

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [lexicon.score(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([s for s, _ in made], pa.float64()),
                 pa.array([int(s >= 0.5) for s, _ in made], pa.int32()), pa.array([n for _, n in made], pa.int32())],
                [*batch.schema.names[1:], "score", "predicted", "hits"])

    return own.mapInArrow(run, schema)
