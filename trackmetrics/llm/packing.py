"""Best-fit-decreasing packing of documents into sequences of a fixed number of tokens.

Only documents longer than a sequence are cut: their full sequences stand alone and the remainder, taken
from the front, is packed like a short document.  Best fit only looks at lengths, so the decision is made
on the number of pieces per length (at most ``capacity`` rows, whatever the corpus): longest first, a segment
tree over the remaining capacities gives the tightest open bin in logarithmic time,
and bins with equal history are handled as one range of sequence numbers.  The plan is then joined to the pieces by their
rank within a length.

Null and empty texts are one piece with the end id only; repeated rows are packed one by one;
an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackmetrics.llm.bpe import encoded_batches
from trackmetrics.llm.common import numbered, trim
from trackmetrics.session import materialise

CAPACITY = 1024
END_ID = 2


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, table_pieces: int | None = None) -> DataFrame:
    """Tokenised documents cut to the capacity: doc_id, rid, piece, start, length, ids_crc32 (and ids)."""
    schema = "doc_id long, rid long, piece int, start long, length int, ids_crc32 long" + (", ids binary" if with_ids else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def cut(batches):
        trim()  # workers come from earlier stages; their tables of pieces are this stage's own
        for batch in batches:
            ids_col, rids = batch.column("doc_id"), batch.column("rid")
            for first, encoded in encoded_batches(batch.column("text"), vocabulary, end_id, table_pieces=table_pieces):
                rows = {n: [] for n in names}
                for k, raw in enumerate(encoded):
                    n = len(raw) // 4
                    head = n % capacity or min(n, capacity)
                    bounds = [0, *range(head, n + 1, capacity)]
                    for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        part = raw[4 * a : 4 * b]
                        rows["doc_id"].append(ids_col[first + k].as_py())
                        rows["rid"].append(rids[first + k].as_py())
                        rows["piece"].append(p)
                        rows["start"].append(a)
                        rows["length"].append(b - a)
                        rows["ids_crc32"].append(zlib.crc32(part))
                        if with_ids:
                            rows["ids"].append(part)
                yield pa.RecordBatch.from_pydict(rows, schema=arrow)

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(cut, schema)


class _Tightest:
    """Segment tree over remaining capacities: smallest capacity at or above a bound that has open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.size, dtype=bool)

    def set(self, room: int, on: bool) -> None:
        i = room + self.size
        self.open[i] = on
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def at_least(self, room: int) -> int | None:
        i = room + self.size
        if self.open[i]:
            return room
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over (length -> number of pieces).

    Rows (length, first rank, number, first sequence, offset): pieces of the length with ranks from
    ``first rank`` go one each to consecutive sequences from ``first sequence``, at ``offset``.
    """
    tree, bins, out, made = _Tightest(capacity), {}, [], 0

    def keep(room: int, first: int, number: int) -> None:
        if room and number:
            bins.setdefault(room, []).append((first, number))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.at_least(length)
            if room is None:  # nothing open fits
                room, first, number = capacity, made, -(-left // (capacity // length))
                made += number
            else:
                first, number = bins[room].pop()
                if not bins[room]:
                    tree.set(room, False)
            # A bin that has taken a piece and has room for more of this length is the tightest, so it is filled before the next.
            per = room // length
            full = min(number, left // per)
            part = min(left - full * per, per - 1) if full < number else 0
            for fill, start, many in ((per, first, full), (part, first + full, 1)):
                if fill and many:
                    out += [(length, rank + j * many, many, start, capacity - room + j * length) for j in range(fill)]
                    rank, left = rank + fill * many, left - fill * many
                    keep(room - fill * length, start, many)
            keep(room, first + full + (part > 0), number - full - (part > 0))
    return out


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces."""
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan(counts, capacity)
    steps = spark.createDataFrame(rows, "length int, first_rank long, number long, first_sequence long, at int")
    ranked = numbered(cut, ["length"], [F.col("rid"), F.col("piece")], "rank", ["rid", "piece"])
    # The plan's size is bounded by the capacity, not by the corpus, so it may be broadcast.
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("number"))
    joined = ranked.join(F.broadcast(steps.withColumnRenamed("length", "plan_length")), (F.col("length") == F.col("plan_length")) & inside)
    extra = [c for c in cut.columns if c not in ("rid", "length")]
    return joined.select(
        *[c for c in extra if c != "ids"], F.col("length").cast("long").alias("length"),
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), F.col("at").cast("long").alias("offset"),
        *[c for c in extra if c == "ids"],
    )


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, table_pieces: int | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    return place(materialise(pieces(docs, vocabulary, capacity, end_id, id_col, text_col, with_ids, table_pieces), "pieces"), capacity)
