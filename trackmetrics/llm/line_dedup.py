"""Line de-duplication by a deletion-neighbourhood join.

Unit: the words of a line (runs of characters other than ASCII white space, A-Z as a-z); edits insert, delete or
replace one word.  A line is dropped if an earlier one (by doc_id, then line number) has the same words,
or, for lines of ``MIN_WORDS`` words and more, is at most ``EDITS`` = 1 edit away.  "Earlier" is judged on the input, so the
result does not depend on an order of removal.

1. Equal lines: the first place per hash of a line's words, combined on the map side.
2. Two lines within one edit share the first or the last half of their words.  Lines that share neither half
   with another line cannot have a neighbour; the others emit their deletion variants as hashed keys:
   the line itself and the line without each word, with the place of the deletion.
3. Equal variants are joined.  Same key and place in lines of one length: one replaced word, a clique, so the
   earliest is taken.  A variant equal to a whole line: one inserted word.  Each found pair is verified on the words.
4. Documents are rebuilt from the lines they keep, so a line that a third of all documents repeat is one row here.

Lines without words are kept.  Null and empty texts come back as they are; rows that repeat doc_id and text are one
document and get the same result; documents without doc_id come before all others; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackmetrics.llm import textkernel
from trackmetrics.llm.common import broadcast_if_small, lean, record_batch
from trackmetrics.session import materialise

EDITS = 1
MIN_WORDS = 8
_MULT = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(int(_MULT), -1, 1 << 64))
_FLUSH = 200_000


class _Lines:
    """Lines of one slice of texts: row, number, first word and words of each, and hashes of word ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.hashes, first, _ = textkernel.words(data, offsets)
        breaks = np.flatnonzero(data == 10) + 1
        # A line starts at each row's first byte and after each line feed; empty rows have one empty line.
        row_of_break = np.searchsorted(offsets, breaks - 1, "right") - 1
        rows = np.concatenate([np.arange(len(offsets) - 1), row_of_break])
        at = np.concatenate([offsets[:-1], breaks])
        order = np.lexsort((np.concatenate([np.zeros(len(offsets) - 1, np.int8), np.ones(len(breaks), np.int8)]), at, rows))
        self.row, self.at = rows[order], at[order]
        starts = np.searchsorted(self.row, np.arange(len(offsets)))
        self.bounds = starts  # first line of each row
        self.number = np.arange(len(self.row)) - starts[self.row]
        ends = np.append(self.at[1:], offsets[-1])
        self.first = np.searchsorted(first, self.at)
        self.words = np.searchsorted(first, ends) - self.first
        n = len(self.hashes)
        powers = np.full(n + 1, _MULT, dtype=np.uint64)
        inverse = np.full(n + 1, _BACK, dtype=np.uint64)
        powers[0] = inverse[0] = 1
        self.powers, self.inverse = np.cumprod(powers), np.cumprod(inverse)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.hashes * self.powers[:n], out=self.total[1:])

    def range_hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Polynomial of the words a to b - 1, first word at power 0."""
        return (self.total[b] - self.total[a]) * self.inverse[a]

    def keys(self) -> np.ndarray:
        return textkernel.mix(self.range_hash(self.first, self.first + self.words) + self.words.astype(np.uint64))

    def halves(self) -> list[np.ndarray]:
        """Keys of the first and last half, for a pair whose longer line has this many words or one more."""
        out = []
        for longer in (self.words, self.words + 1):
            half = longer // 2  # = ceil((longer - 1) / 2): what an edit leaves equal on one side
            tag = longer.astype(np.uint64) * np.uint64(4)
            out.append(textkernel.mix(self.range_hash(self.first, self.first + half) + tag + np.uint64(1)))
            end = self.first + self.words
            out.append(textkernel.mix(self.range_hash(end - half, end) + tag + np.uint64(2)))
        return out

    def variants(self, line: int) -> np.ndarray:
        """Key of the line without each of its words."""
        a, n = int(self.first[line]), int(self.words[line])
        cut = np.arange(a, a + n)
        before = self.total[cut] - self.total[a]
        after = (self.total[a + n] - self.total[cut + 1]) * _BACK
        return textkernel.mix((before + after) * self.inverse[a] + np.uint64(n - 1))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _line_table(source: DataFrame) -> DataFrame:
    """Lines with words: (h, doc_id, doc_hash, line, words, half keys)."""
    names = ["h", "doc_id", "doc_hash", "line", "words", "p0", "s0", "p1", "s1"]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches):
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("doc_hash")
            for first, data, offsets in textkernel.slices(batch.column("text")):
                lines = _Lines(data, offsets)
                some = np.flatnonzero(lines.words > 0)
                rows = pa.array(lines.row[some] + first)
                halves = [_signed(x[some]) for x in lines.halves()]
                yield record_batch({
                    "h": _signed(lines.keys()[some]), "doc_id": ids.take(rows), "doc_hash": marks.take(rows), "line": lines.number[some],
                    "words": lines.words[some], **dict(zip(names[5:], halves)),
                }, schema)

    return source.mapInArrow(lean(run), ", ".join(f"{c} long" for c in names))


def _variant_table(chosen: DataFrame) -> DataFrame:
    """(key, place, words, h) of the chosen lines; place -1 is the whole line."""
    schema = pa.schema([("key", pa.int64()), ("place", pa.int32()), ("words", pa.int32()), ("h", pa.int64())])

    def run(batches):
        for batch in batches:
            wanted = batch.column("lines").to_pylist()
            out, held = [], 0
            for first, data, offsets in textkernel.slices(batch.column("text")):
                lines = _Lines(data, offsets)
                keys = lines.keys()
                for row in range(len(offsets) - 1):
                    for number in wanted[first + row]:
                        line = int(lines.bounds[row]) + number
                        n = int(lines.words[line])
                        out.append((np.append(_signed(lines.variants(line)), _signed(keys[line : line + 1])), np.append(np.arange(n), -1), n, int(keys[line].astype(np.int64))))
                        held += n + 1
                        if held > _FLUSH:
                            yield flush(out)
                            out, held = [], 0
            if out:
                yield flush(out)

    def flush(out):
        sizes = [len(o[0]) for o in out]
        return record_batch({
            "key": np.concatenate([o[0] for o in out]), "place": np.concatenate([o[1] for o in out]).astype(np.int32),
            "words": np.repeat(np.array([o[2] for o in out], dtype=np.int32), sizes), "h": np.repeat(np.array([o[3] for o in out], dtype=np.int64), sizes),
        }, schema)

    return chosen.mapInArrow(lean(run), "key long, place int, words int, h long")


def _words_of(chosen: DataFrame) -> DataFrame:
    """(h, tokens) of the chosen lines, tokens in lower case."""
    schema = pa.schema([("h", pa.int64()), ("tokens", pa.list_(pa.binary()))])

    def run(batches):
        for batch in batches:
            for text, hashes, numbers in zip(batch.column("text"), batch.column("hs").to_pylist(), batch.column("lines").to_pylist()):
                lines = text.as_py().encode().split(b"\n")
                yield record_batch({"h": hashes, "tokens": [lines[i].lower().split() for i in numbers]}, schema)

    return chosen.mapInArrow(lean(run), "h long, tokens array<binary>")


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """At most one word inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1:
        return False
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    return max(len(a), len(b)) - start - end <= 1


def _verified(pairs: DataFrame) -> DataFrame:
    schema = pa.schema([("h", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = zip(batch.column("h").to_pylist(), batch.column("own").to_pylist(), batch.column("other").to_pylist())
            yield record_batch({"h": [h for h, a, b in rows if within_one_edit(a, b)]}, schema)

    return pairs.mapInArrow(lean(run), "h long")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("doc_hash"), text.alias("text"))


def _of_docs(source: DataFrame, lines: DataFrame) -> DataFrame:
    """Texts of the documents in which the lines (h, doc_id, doc_hash, line) stand first, with these lines as arrays.

    The arrays are bounded by the document; texts shuffle only if the documents are too many to be named in a broadcast.
    """
    per_doc = lines.groupBy("doc_id", "doc_hash").agg(F.sort_array(F.collect_list(F.struct("line", "h"))).alias("l"))
    per_doc = per_doc.select(F.col("doc_id").alias("__d"), F.col("doc_hash").alias("__h"), F.col("l.line").alias("lines"), F.col("l.h").alias("hs"))
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("doc_hash") == F.col("__h"))
    return source.join(broadcast_if_small(per_doc, width=F.size("lines") * 16), same).drop("__d", "__h")


def kept_lines(docs: DataFrame, edits: int = EDITS, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_hash, exact, near, kept lines with words) per document that has lines with words."""
    if edits not in (0, 1):
        raise ValueError("edits must be 0 or 1")
    source = _source(docs, id_col, text_col)
    lines = materialise(_line_table(source), "lines")
    place = F.struct("doc_id", "doc_hash", "line")
    distinct = lines.groupBy("h").agg(F.min(place).alias("at"), *[F.first(c).alias(c) for c in ("words", "p0", "s0", "p1", "s1")])
    distinct = materialise(distinct, "distinct_lines")
    if edits:
        dropped = _near(source, distinct.where(F.col("words") >= min_words - 1), min_words)
        first = distinct.join(dropped.withColumn("near", F.lit(True)), "h", "left")
    else:
        first = distinct.withColumn("near", F.lit(None).cast("boolean"))
    first = first.select("at.doc_id", "at.doc_hash", "at.line", F.coalesce("near", F.lit(False)).alias("near"))
    return first.groupBy("doc_id", "doc_hash").agg(
        F.count_if("near").alias("near"), F.sort_array(F.collect_list(F.when(~F.col("near"), F.col("line")))).alias("kept")
    )


def _near(source: DataFrame, distinct: DataFrame, min_words: int) -> DataFrame:
    """Hashes of distinct lines that have an earlier line within one edit."""
    halves = distinct.select("h", F.explode(F.array("p0", "s0", "p1", "s1")).alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    suspects = halves.join(shared, "half").select("h").distinct()
    suspects = materialise(distinct.join(suspects, "h").select("h", "at", "words"), "suspect_lines")
    chosen = _of_docs(source, suspects.select("h", "at.*"))
    variants = materialise(_variant_table(chosen), "variants")

    # Replaced word: same key and place, same length; the members are mutually one edit apart.
    cut = variants.where("place >= 0").select("key", "place", "h")
    cliques = cut.join(suspects.select("h", "at"), "h").groupBy("key", "place").agg(F.min(F.struct("at", "h")).alias("best"), F.count(F.lit(1)).alias("n"))
    replaced = cut.join(cliques.where("n > 1").select("key", "place", "best.h").withColumnRenamed("h", "other"), ["key", "place"]).select("h", "other")
    # Inserted word: a variant is another whole line.
    whole = variants.where("place = -1").select("key", F.col("h").alias("short"))
    inserted = cut.join(whole, "key").select(F.col("h"), F.col("short"))
    inserted = inserted.select(F.explode(F.array(F.struct("h", F.col("short").alias("other")), F.struct(F.col("short").alias("h"), F.col("h").alias("other")))).alias("p")).select("p.*")
    pairs = replaced.unionByName(inserted).where("h <> other").distinct()
    places = suspects.select("h", "at", "words")
    other = places.select(F.col("h").alias("other"), F.col("at").alias("other_at"), F.col("words").alias("other_words"))
    earlier = pairs.join(places, "h").join(other, "other").where(F.col("other_at") < F.col("at"))
    earlier = materialise(earlier.where(F.least("words", "other_words") >= min_words).select("h", "other"), "line_pairs")

    named = earlier.select("h").unionByName(earlier.select(F.col("other").alias("h"))).distinct()
    tokens = materialise(_words_of(_of_docs(source, suspects.join(named, "h").select("h", "at.*"))).dropDuplicates(["h"]), "line_words")
    checked = earlier.join(tokens.withColumnRenamed("tokens", "own"), "h").join(
        tokens.select(F.col("h").alias("other"), F.col("tokens").alias("other_tokens")), "other"
    )
    return _verified(checked.select("h", "own", F.col("other_tokens").alias("other"))).distinct()


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, ``text`` without dropped lines, and ``n_lines``, ``n_exact``, ``n_near`` (dropped lines)."""
    kept = kept_lines(docs, edits, min_words, id_col, text_col)
    kept = kept.select(F.col("doc_id").alias("__d"), F.col("doc_hash").alias("__h"), F.col("near").alias("__near"), F.col("kept").alias("__kept"))
    text = F.col(text_col).cast("string")
    joined = docs.join(kept, (F.col(id_col).cast("long").eqNullSafe(F.col("__d"))) & (F.xxhash64(text) == F.col("__h")), "left")
    parts = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    numbered = F.transform(parts, lambda line, i: F.struct(line.alias("line"), i.alias("i"), line.rlike(r"[^\x20\x09-\x0D]").alias("used")))
    out = joined.withColumns({
        "__lines": numbered, "__kept": F.coalesce("__kept", F.array().cast("array<bigint>")), "__near": F.coalesce("__near", F.lit(0)).cast("int"),
    })
    # kept lines stay, and so do lines without words
    stays = F.filter(F.col("__lines"), lambda x: ~x["used"] | F.array_contains(F.col("__kept"), x["i"].cast("long")))
    used = F.size(F.filter(F.col("__lines"), lambda x: x["used"]))
    new_text = F.when(text.isNotNull(), F.array_join(F.transform(stays, lambda x: x["line"]), "\n"))
    columns = [new_text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in ("n_lines", "n_exact", "n_near")]
    counts = {"n_lines": F.size("__lines"), "n_exact": used - F.size("__kept") - F.col("__near"), "n_near": F.col("__near")}
    return out.select(*columns, *[c.alias(n) for n, c in counts.items()])
