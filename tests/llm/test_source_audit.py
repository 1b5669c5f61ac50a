"""Source divergence against brute force with exact integers."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ROWS, docs, empty
from trackmetrics.llm import source_audit


def slow(rows, least=10, top=10):
    """Rows (lang, source, text) to result rows."""
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in ((x or "" for x in r) for r in rows):
        groups.add((lang, source))
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        own = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
        counts[lang, source] += own
        seen[lang].update(own.keys())
    out = set()
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        of_lang = [g for g in groups if g[0] == lang]
        n = {g: sum(counts[g][t] for t in kept) for g in of_lang}

        def p(t, some):
            return 1 + 10**9 * (sum(counts[g][t] for g in some) + 2) // (sum(n[g] for g in some) + 2 * len(kept))

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        own = (lang, source)
        terms = [(t, f(p(t, [own]), p(t, of_lang))) for t in kept if counts[own][t] and p(t, [own]) > p(t, of_lang)]
        pairs = [(g[1], sum(f(p(t, [own]), p(t, [g])) for t in kept)) for g in of_lang if g != own]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            for k, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]):
                out.add((lang, source, part, item, value, k + 1))
    return out


def found(df):
    got = [tuple(r) for r in df.collect()]
    assert len(set(got)) == len(got)
    return set(got)


def test_terms_are_whole_characters():
    assert [t.decode() for t in source_audit.terms("Äpfel, ÄPFEL don't\x00x_y 3z q")] == ["Äpfel", "Äpfel", "don", "t", "x", "y", "z q"]


@pytest.mark.parametrize("held, block", [(400_000, 100_000), (5, 7)])
def test_against_brute_force(spark, monkeypatch, held, block):
    monkeypatch.setattr(source_audit, "HELD_TERMS", held)
    monkeypatch.setattr(source_audit, "BLOCK_ROWS", block)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in table.select("lang", "source", "text").collect()]
    got = found(source_audit.divergence(table))
    assert got == slow(rows) and {r[2] for r in got} == {"pair", "term"}


def test_awkward_rows(spark):
    rows = [("en", f"s{i % 4}", t) for i, (_, t) in enumerate(ROWS)] * 3 + [
        (None, None, None), (None, "s", "alone " * 12), ("", "", "alone"), ("xx", "a", "few terms only"), ("xx", "b", None), ("xx", "é", "1 2 3"), ("one", "only", "here " * 20),
        *[("de", s, "Ärger ÄRGER ärger " + w) for s in ("a", "b", None) for w in ("eins", "zwei", "EINS", "drei")],
    ]
    table = spark.createDataFrame(rows, "lang string, source string, text string")
    clash = {c: F.lit("x") for c in ("term", "n", "docs", "total", "first", "p", "q", "p0", "block", "value", "rank", "item", "a", "b")}
    got = found(source_audit.divergence(table.withColumns(clash).repartition(3)))
    assert got == slow(rows) and ("xx", "a", "pair", "b", 0, 1) in got and not any(r[0] == "one" and r[2] == "pair" for r in got)


def test_empty_and_id_less(spark):
    assert source_audit.divergence(empty(spark)).count() == 0
    assert source_audit.divergence(docs(spark).withColumn("text", F.lit(None).cast("string"))).where("part = 'term'").count() == 0


def test_shares_stay_exact_beyond_64_bits(spark):
    row = spark.range(1).select(source_audit.share(F.lit(3 * 10**12), F.lit(10**13), F.lit(10**7)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (3 * 10**12 + 2) // (10**13 + 2 * 10**7)
