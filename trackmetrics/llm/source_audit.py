"""How far the sources of a language diverge in the words they use.

1. One translate table lowers A-Z and blanks every other ASCII character that is no letter, so that ``bytes.split`` yields the terms of a whole
   text and a ``Counter`` its frequencies.  A task adds the counters of the documents of each (lang, source) and
   gives them out as (lang, source, term, count, documents) when they hold ``HELD_TERMS`` entries: only what occurs is a row.
2. These rows are dealt by (lang, term) once; counts per source, the number of documents and the total of a term are all taken there.
   A language keeps the terms that stand in at least ``LEAST_DOCUMENTS`` of its documents.
3. A group (lang, source), and the language itself, give each kept term the share p = 1 + floor(SCALE (count + 2) / (N + 2 V)).
   All arithmetic is on integers: 1e9 (count + 2) as decimal, the rest fits in 64 bits.
4. ``term``: the ten terms of a group whose share exceeds that of its language by most, f = floor((p - q)^2 / (p + q)).
5. ``pair``: f summed over all kept terms for each two groups of a language.  A term that only one of them has, or none, has the
   share p0 of count 0 there, so the sum is split: terms that both have are met term by term, inside blocks
   of terms; terms of one group against p0 of the other need only how often each share occurs in the group; the rest is V f(p0, q0).
   Absent terms are thus never listed, and no rows are given out per term and pair.

Null text, lang and source count as ''.  Groups without terms have pairs but no terms; ties go to the smaller item by UTF-8; repeated rows
count as documents of their own; a language with one source has no pairs; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trackmetrics.llm.common import broadcast_if_small
from trackmetrics.session import materialise

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Entries a task holds before it gives them out (about 200 bytes each), rows given out at a time, rows of a block of terms.
HELD_TERMS = 400_000
GIVEN_ROWS = 50_000
BLOCK_ROWS = 100_000

#: A-Z to a-z, other ASCII characters but a-z to a space; bytes of longer characters stay.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents are counted in the bits above those of the occurrences.
_DOCUMENT = 1 << 40


def terms(text: str) -> list[bytes]:
    return text.encode().translate(TABLE).split()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Partial counts: lang, source, term, n (occurrences), docs (documents); several rows per key, one per task and flush."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def given(held):
        for (lang, source), table in held.items():
            keys, values = list(table), np.fromiter(table.values(), np.int64, len(table))
            for a in range(0, len(keys), GIVEN_ROWS):
                part, some = keys[a : a + GIVEN_ROWS], values[a : a + GIVEN_ROWS]
                columns = [[lang] * len(part), [source] * len(part), part, some % _DOCUMENT, some // _DOCUMENT]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def scan(batches):
        held, size = defaultdict(lambda: defaultdict(int)), 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                table = held[lang, source]
                before = len(table)
                for term, n in Counter(terms(text.as_py())).items():
                    table[term] += n + _DOCUMENT
                size += len(table) - before
                if size >= HELD_TERMS:
                    yield from given(held)
                    held, size = defaultdict(lambda: defaultdict(int)), 0
        yield from given(held)

    source = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return source.mapInArrow(scan, "lang string, source string, term string, n long, docs long")


def kept_terms(partial: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Counts of the kept terms: lang, source, term, n, total (of the language), first (true in one row per term); one shuffle."""
    keyed = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")
    return (
        keyed.withColumns({"in_docs": F.sum("docs").over(own), "total": F.sum("n").over(own), "first": F.row_number().over(own.orderBy("source")) == 1})
        .where(F.col("in_docs") >= least_documents).select("lang", "source", "term", "n", "total", "first")
    )


def share(n: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE (n + 2) / (total + 2 vocabulary)), null without vocabulary."""
    parts = {"n": n, "total": total, "vocabulary": vocabulary}
    top = (parts["n"] + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = F.nullif(parts["total"] + 2 * parts["vocabulary"], F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", top, bottom) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.add.reduceat(values, at)


def _shared(shares: DataFrame, blocks: int) -> DataFrame:
    """Per two sources of a language (a before b): what the terms of both add over the sum that takes each of the two against p0 of the other."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])

    def run(key, table):
        table = table.sort_by([("term", "ascending"), ("source", "ascending")])
        sources, code = np.unique(table.column("source").to_numpy(), return_inverse=True)
        term = np.unique(table.column("term").to_numpy(), return_inverse=True)[1]
        p, p0 = table.column("p").to_numpy(), table.column("p0").to_numpy()
        keys, values, lag = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        while (both := np.flatnonzero(term[lag:] == term[:-lag])).size:
            x, x0, y, y0 = p[both], p0[both], p[both + lag], p0[both + lag]
            more = _distance(x, y) - _distance(x, y0) - _distance(x0, y) + _distance(x0, y0)
            pair = np.minimum(code[both], code[both + lag]) * len(sources) + np.maximum(code[both], code[both + lag])
            keys, values = _summed(np.append(keys, pair), np.append(values, more))
            lag += 1
        names = sources.tolist()
        return pa.table({
            "lang": [key[0].as_py()] * len(keys), "a": [names[k // len(names)] for k in keys], "b": [names[k % len(names)] for k in keys], "value": values,
        }, schema=schema)

    dealt = shares.select("lang", "source", "term", "p", "p0", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"))
    return dealt.groupBy("lang", "block").applyInArrow(run, "lang string, a string, b string, value long")


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Rows lang, source, part ('pair' or 'term'), item (other source, or term), value, rank."""
    kept = materialise(kept_terms(term_counts(docs, lang_col, source_col, text_col), least_documents), "terms")
    groups = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source")).distinct()
    per_lang = kept.groupBy("lang").agg(F.count_if("first").alias("vocabulary"), F.sum("n").alias("lang_total"))
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    known = groups.join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left")
    known = known.select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("group_total", "vocabulary", "lang_total")]
    ).withColumn("p0", share(F.lit(0), F.col("group_total"), F.col("vocabulary")))
    known = broadcast_if_small(materialise(known, "groups"), width=F.octet_length("lang") + F.octet_length("source"))

    shares = kept.join(known, ["lang", "source"]).select(
        "lang", "source", "term", "p0", share(F.col("n"), F.col("group_total"), F.col("vocabulary")).alias("p"),
        share(F.col("total"), F.col("lang_total"), F.col("vocabulary")).alias("q"),
    )
    shares = materialise(shares, "shares")
    p, q = F.col("p"), F.col("q")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = shares.where(p > q).select("lang", "source", F.col("term").alias("item"), distance(p, q).alias("value"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= top_terms)

    blocks = max(1, -(-shares.count() // BLOCK_ROWS))
    shared = _shared(shares, blocks).groupBy("lang", "a", "b").agg(F.sum("value").alias("shared"))
    often = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    often = often.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("often"))
    side = [
        known.select("lang", F.col("source").alias(x), F.col("p0").alias(f"p0_{x}"), *([F.col("vocabulary")] if x == "a" else [])) for x in "ab"
    ]
    pairs = side[0].join(side[1], "lang").where("a < b")
    for x in "ab":
        pairs = pairs.join(often.select("lang", F.col("source").alias(x), F.col("often").alias(f"often_{x}")), ["lang", x], "left")
    zero = distance(F.col("p0_a"), F.col("p0_b"))

    def alone(own: str, other: str) -> Column:
        add = lambda total, x: total + x.n * (distance(x.p, F.col(other)) - zero)
        return F.coalesce(F.aggregate(F.col(own), F.lit(0).cast("long"), add), F.lit(0))

    pairs = pairs.join(shared, ["lang", "a", "b"], "left").select(
        "lang", "a", "b", F.coalesce(F.coalesce("shared", F.lit(0)) + alone("often_a", "p0_b") + alone("often_b", "p0_a") + F.col("vocabulary") * zero, F.lit(0)).alias("value")
    )
    ways = F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", ways, "value").withColumn("rank", rank)
    parts = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")) for df, part in ((pairs, "pair"), (best, "term"))]
    return parts[0].unionByName(parts[1])
