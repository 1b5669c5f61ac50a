"""Runs of repeated words against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np

from tests.llm.helpers import ROWS, docs, empty
from trackmetrics.llm import periodic_runs
from trackmetrics.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def slow_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            if j > i and len(part) >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, len(part), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_row(doc_id, text, planted=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(250):
        texts = []
        for _ in range(rng.randint(1, 6)):
            words = [rng.randrange(rng.choice((1, 2, 3, 5))) for _ in range(rng.choice((0, 1, 5, 6, 7, 20, 60, 150)))]
            if rng.random() < 0.5 and words:
                a = rng.randrange(len(words))
                p = 1 + (len(words) - a) // rng.randint(3, 10)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words + ([9] * rng.randint(1, 30) + words if rng.random() < 0.3 else []))
        assert periodic_runs.runs_of(texts) == [slow_runs(t) for t in texts]


def test_grammar_extensions_and_rules():
    rng = np.random.default_rng(3)
    for kinds in (1, 2, 4):
        words, sizes = periodic_runs._joined([rng.integers(0, kinds, n) for n in (40, 1, 0, 33)])
        grammar = periodic_runs.Grammar(words)
        starts = np.cumsum(sizes + 1) - sizes
        pairs = np.array([(s + x, s + y) for s, n in zip(starts, sizes) for x in range(n) for y in range(x + 1, n)])
        right, back = grammar.extensions(*pairs.T), grammar.extensions_back(*pairs.T)
        for (i, j), r, b in zip(pairs.tolist(), right.tolist(), back.tolist()):
            assert (words[i : i + r] == words[j : j + r]).all() and words[i + r] != words[j + r]
            assert (words[i - b + 1 : i + 1] == words[j - b + 1 : j + 1]).all() and words[i - b] != words[j - b]
        # the rules rebuild the text: every symbol above the words stands for what its rule says
        made = {s: [s] for s in words.tolist()}
        named = int(words.max(initial=0)) + 1
        for (left, right_part), level in zip(grammar.rules, grammar.levels):
            for k, (x, y) in enumerate(zip(left.tolist(), right_part.tolist())):
                made[named + k] = made[x] * y if level.blocks else made[x] + made[y]
            named += len(left)
        assert [w for s in grammar.levels[-1].symbols.tolist() for w in made[s]] == words.tolist()


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_query_against_brute_force(spark):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op11_periodic_runs"](spark, FOLDER)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = rows_of(found)
    assert got == {slow_row(r["doc_id"], r["text"]) for r in texts} and sum(r[1] > 0 for r in got) >= 10


def test_awkward_rows(spark):
    rows = [r for r in ROWS if r[0] not in (9, 10)] + [
        (20, "a " * 5), (21, "a " * 6), (21, "a " * 6), (22, "x " + "a b " * 4 + "y"), (23, "\xa0 \xa0 \xa0 \xa0 \xa0 \xa0"),
        (24, "q " + "a a a a a a b " * 5), (None, "z " * 9), (25, "w" * 300_000 + " w" * 7),
    ]
    found = periodic_runs.summarised(periodic_runs.find_runs(docs(spark, rows)))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(slow_row(i, t, False)) for i, t in rows)
    assert periodic_runs.summarised(periodic_runs.find_runs(empty(spark))).count() == 0


def test_very_long_run(spark):
    text = "start " + "one two three " * 60_000 + "end"
    row = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 180_000, 3)] and row["collapsed"] == "start one two three end"
