"""Spelling variants, ranked search and repeated passages against brute
force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import lexical, queries, repeats, spelling
from tabforge.llm.common import Scratch
from tests.conftest import SF001

LONG = "wording " * 200_000
EDGE = [(1, None), (2, ""), (3, " \n"), (4, LONG), (5, "same text here for all"), (6, "same text here for all"),
        (6, "same text here for all"), (None, "no key at all here"), (None, "no key at all here"), (7, "日本語 🙂 <|x|> ÀÉ×÷ÿ")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("id", "word", "n", "s", "i", "j", "rest", "bag", "m", "hash", "place", "item", "score", "rank",
                                 "digest", "key", "start", "h", "b")})


def _lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def _words(rows, every=199, least=6, often=5):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= often}


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _variants(n, ratio=5):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and _one_edit(w, v)] for w in n}
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n[w], form[w], n[form[w]] if form[w] else None, root, len(near[w]))
    return out


def _got(df):
    rows = df.collect()
    out = {r["word"]: (r["n"], r["form"], r["form_n"], r["root"], r["n_near"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_spelling_query_matches_brute_force(spark, docs):
    want = _variants(_words([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert _got(queries.op11_spelling_variants(spark, SF001)) == want
    assert any(v[1] for v in want.values())


@pytest.mark.parametrize("group", [1, 4, 512])
def test_near_pairs_match_brute_force(spark, group):
    """Small alphabets make long lists, ties of edit places and deep chains; a
    small limit makes every group be cut down to one free letter."""
    rng = random.Random(group)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(250)} | {"a" * k for k in range(1, 12)}
    words |= {"prefix" * 3 + "".join(rng.choice("xyz") for _ in range(3)) for _ in range(30)}
    n = {w: rng.choice([1, 2, 6, 40, 300]) for w in sorted(words)}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = Counter((r["word"], r["n"], r["near"], r["near_n"])
                  for r in spelling.near_pairs(df, Scratch(spark, "t"), group).collect())
    assert got == Counter((a, n[a], b, n[b]) for a in n for b in n if _one_edit(a, b))
    assert _got(spelling.variants(df)) == _variants(n)


def test_neighbours_skip_ranges():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(4, 8))) for _ in range(400)})
    lcp = spelling.lcps(words)
    below = spelling.skips(lcp)
    for q, w in enumerate(words):
        assert list(spelling.neighbours(words, lcp, below, q)) == [t for t in range(q + 1, len(words)) if _one_edit(w, words[t])]


def test_spelling_edges(spark, edge):
    got = {r["word"]: r["n"] for r in spelling.vocabulary(edge, every=0, least=4, often=1).collect()}
    assert got == {"wording": 200_000, "same": 3, "text": 3, "here": 5, "ÀÉ×÷ÿ": 1}
    assert spelling.vocabulary(edge.limit(0)).count() == 0
    assert spelling.variants(spelling.vocabulary(edge.limit(0))).count() == 0
    want = _variants(_words(EDGE, every=2, least=1, often=1))
    assert _got(spelling.variants(spelling.vocabulary(edge, every=2, least=1, often=1))) == want


def _terms(s):
    return [_lower(t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", s or "")]


def _search(docs, items, k=10):
    docs = [(i, Counter(_terms(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    total, df = sum(sum(c.values()) for _, c in docs), Counter(t for _, c in docs for t in c)
    out = {}
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 25 + 75 * sum(c.values()) * len(docs) // total
            score = sum(math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in _terms(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out[item] = [(None if none else i, -s) for s, none, i in sorted(scored)[:k]]
    return out


def _ranked(rows):
    out = defaultdict(dict)
    for r in rows:
        assert r["rank"] not in out[r["item_id"]]
        out[r["item_id"]][r["rank"]] = (r["doc_id"], r["score"])
    return {i: [v[k] for k in range(1, len(v) + 1)] for i, v in out.items()}


def test_search_query_matches_brute_force(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    want = _search([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert _ranked(queries.op12_lexical_search(spark, SF001).collect()) == {i: v for i, v in want.items() if v}


def test_search_with_copies_ties_and_blocks(spark, edge, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))) for i in range(400)]
    rows += [(1000 - i, "a b common") for i in range(60)] + [(7, "a b common")] * 3 + EDGE
    items = [(i, " ".join(rng.choice("abcdefghz") for _ in range(4))) for i in range(7)] + [
        (100, "Common COMMON wording"), (101, None), (102, ""), (103, "nothing like it"), (104, "SAME key 日本語")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("item", F.lit("x"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit(1)).repartition(3)
    want = {i: v for i, v in _search(rows, items, 5).items() if v}
    assert _ranked(lexical.search(df, asked, k=5).collect()) == want
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 4)
    assert _ranked(lexical.search(df.repartition(5), asked, k=5).collect()) == want
    assert lexical.search(edge.limit(0), asked).count() == 0 and lexical.search(edge, asked.limit(0)).count() == 0


def test_terms_of_long_texts_cross_segments():
    text = "Wörd x1_y " * 300_000
    assert [t for part in lexical.terms(text) for t in part] == [t.encode() for t in _terms(text)]


def _removed(rows, length, first):
    """Per row the bytes covered by strings that start elsewhere too; with
    ``first``, at an earlier place.  Equal rows are one place then."""
    data = [(text or "").encode() for _, text in rows]
    order = {i: (key is None, key or 0, hashlib.sha256(d).digest()[:16]) for i, ((key, _), d) in enumerate(zip(rows, data))}
    places = defaultdict(list)
    for i, d in enumerate(data):
        for a in range(len(d) - length + 1):
            places[d[a:a + length]].append((*order[i], a))
    out = []
    for i, d in enumerate(data):
        gone = np.zeros(len(d) + 1, bool)
        for a in range(len(d) - length + 1):
            at = places[d[a:a + length]]
            if min(at) < (*order[i], a) if first else len(at) > 1:
                gone[a:a + length] = True
        out.append((len(d), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]),
                    bytes(b for b, g in zip(d, gone) if not g)))
    return out


def _repeat_rows():
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 150)))) for i in range(40)]
    rows += [(100 + i, f"{rng.randrange(10 ** 9)} {passage} {rng.randrange(10 ** 9)}") for i in range(30)]
    rows += [(200 + i, f"{i}{passage[i:60 + i]}{i}") for i in range(20)]
    rows += [(300, "aaaaaaaaaa" * 30), (301, "xyz" * 60), (302, "é" * 70), (303, "b" + "a" * 60), (304, passage * 2)]
    rows += [(400 - i, passage[:50] + " copy") for i in range(10)] + [(410, passage[:50] + " copy")] * 4
    return rows + [(None, passage), (None, passage), (None, None), (5, None), (6, ""), (7, passage[:19]), (None, rows[3][1])]


@pytest.mark.parametrize("part", [1, 700, 1 << 21])
@pytest.mark.parametrize("first", [True, False])
def test_repeats_match_brute_force(spark, first, part, monkeypatch):
    rows = _repeat_rows()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, doc_id long, text string") \
        .withColumn("key", F.lit("x")).withColumn("data", F.lit(1)).repartition(5)
    got = sorted(repeats.remove_repeats(df, length=20, first=first, keep=("row", "key"), part=part).collect())
    assert [r["row"] for r in got] == list(range(len(rows)))
    made = [(r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got]
    assert made == _removed(rows, 20, first)


def test_repeated_names_gather_no_hot_name_in_one_task(spark):
    """A line that fills many texts gives a few names with most of the places."""
    scratch = Scratch(spark, "t")
    names = [f"hot{i % 2}" if i % 10 else f"own{i}" if i % 20 else f"twice{i // 40}" for i in range(8000)]
    named = scratch.save(spark.createDataFrame([(1, i // 50, i % 50, n, i) for i, n in enumerate(names)],
                                               "part long, block long, at int, name string, place long").repartition(8), "names")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        made = repeats._repeated(named, scratch).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    many, low = Counter(names), {n: i for i, n in reversed([*enumerate(names)])}
    want = [(i, n, low[n]) for i, n in enumerate(names) if many[n] > 1]
    assert sorted((r["place"], r["name"], r["low"]) for r in made) == want
    assert max(Counter(r["task"] for r in made).values()) < 2500      # 4,000 places have one name


def test_repeats_query_matches_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for (i, _), w in zip(rows, _removed(rows, 400, False))}
    got = queries.op13_suffix_array_dedup(spark, SF001).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    assert len(got) == len(want) and any(w[1] for w in want.values())


def test_repeats_edges(spark, edge):
    got = repeats.remove_repeats(edge, keep=("doc_id", "digest")).collect()
    assert len(got) == len(EDGE) and all(r["n_removed"] == 0 for r in got if r["doc_id"] != 4)
    assert repeats.remove_repeats(edge.limit(0)).count() == 0
    long = next(r for r in got if r["doc_id"] == 4)
    assert long["n_bytes"] == len(LONG) and [tuple(s) for s in long["spans"]] == [(8, len(LONG) - 8)]


def test_blocks_and_suffix_names():
    rng = np.random.default_rng(3)
    data = np.r_[rng.integers(0, 3, 900), np.zeros(300, int), np.tile([1, 2, 3], 100)].astype(np.uint8)
    for length, gram in ((2, 1), (30, 7), (64, 32)):
        covered = []
        for first, many, part, twice in repeats.blocks(data, length, gram):
            for a, n, p, t in zip(first, many, part, twice):
                covered += range(a, a + n)
                strings = [data[s:s + length].tobytes() for s in range(a, a + n)]
                assert t or len(set(strings)) == n
        assert covered == list(range(len(data) - length + 1))
        names = repeats.suffix_names(data, length)[:len(data) - length + 1]
        strings = [data[s:s + length].tobytes() for s in range(len(names))]
        assert np.unique(strings, return_inverse=True)[1].tolist() == np.unique(names, return_inverse=True)[1].tolist()
