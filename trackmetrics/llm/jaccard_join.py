"""Exact Jaccard self-join of word-shingle sets with set-relation skipping.

1. Equal sets are one class.  Shingles get a global order, rare first, from counts in ``CELLS`` cells over all documents.
2. Each set puts its prefix in an inverted index.  Index lists are ordered by size and split in two blocks by position:
   a set whose shingle stands late can only pair with a set where it stands early, so the late block is never
   compared with itself, and sets without a partner in size leave the list.
3. A list is handed to its leader, the member with the smallest digest.  Similar sets share most lists
   and so meet at few leaders.  At a leader every member is compared with the leader first; members linked to it
   need no comparison with each other, and for the others the counts against the leader bound their overlap
   (what two sets share inside the leader, and at most the smaller rest outside it), so most comparisons are derived and not made.
   Large groups are cut into blocks of bounded size; every pair of blocks is one unit of work.
4. Links that connect something new inside a unit go to the connected components.

Overlaps are counted on 64-bit hashes of the shingles.  Null, empty and blank texts have no shingles and link with nothing; a text of
fewer words is one shingle; rows that repeat a doc_id are one node of the graph; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackmetrics.llm import textkernel
from trackmetrics.llm.common import broadcast_if_small, components, lean, merge_labels, record_batch
from trackmetrics.session import materialise

WORDS = 5
#: Similarity as a percentage, so that the test is exact in integers.
PERCENT = 80
CELLS = 1 << 22
SHIFT = 64 - 22
PART = 1 << 16
#: Bounds of a block at a leader: sets, and shingles of all its sets.
BLOCK_SETS = 1_000
BLOCK_SHINGLES = 1_000_000
#: Rows of one index list that a task holds at a time.
LIST_ROWS = 1_000_000


def _needed(a, b, percent: int):
    """Smallest overlap of sets of sizes a and b that reaches the similarity (rounded up)."""
    return -(-percent * (a + b) // (100 + percent))


def _summaries(source: DataFrame, k: int) -> DataFrame:
    """kind 0: one row (doc_id, n, d1, d2) per document; kind 1: per task its shingles per cell, in parts of PART cells (doc_id = part)."""
    schema = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("doc_id", "n", "d1", "d2")], ("cells", pa.binary())])

    def run(batches):
        counts = np.zeros(CELLS, dtype=np.uint16)
        for batch in batches:
            ids, n, d1, d2, found = batch.column("doc_id"), [], [], [], []
            for _, values in textkernel.shingle_sets(batch.column("text"), k):
                a, b = textkernel.digests(values)
                n.append(len(values)), d1.append(a), d2.append(b), found.append(values >> np.uint64(SHIFT))
                if len(found) == 512:
                    _count(counts, found)
                    found = []
            _count(counts, found)
            yield record_batch({"kind": [0] * len(n), "doc_id": ids, "n": n, "d1": d1, "d2": d2, "cells": [None] * len(n)}, schema)
        if counts.any():
            parts = counts.reshape(-1, PART)
            zero = [0] * len(parts)
            yield record_batch({"kind": [1] * len(parts), "doc_id": list(range(len(parts))), "n": zero, "d1": zero, "d2": zero, "cells": [p.tobytes() for p in parts]}, schema)

    return source.mapInArrow(lean(run), "kind int, doc_id long, n long, d1 long, d2 long, cells binary")


def _count(counts: np.ndarray, found: list[np.ndarray]) -> None:
    """Add cells to 16-bit counts, which stay at their maximum."""
    if found:
        cells, times = np.unique(np.concatenate(found).astype(np.int64), return_counts=True)
        counts[cells] = np.minimum(counts[cells].astype(np.int64) + times, 65_535)


def _levels(parts: DataFrame) -> np.ndarray:
    """Per cell how often its shingles occur in all documents, on a logarithmic scale of one byte."""
    schema = pa.schema([("part", pa.int64()), ("levels", pa.binary())])

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells")):
                total.setdefault(part, np.zeros(PART, dtype=np.int64))
                total[part] += np.frombuffer(cells.as_buffer(), dtype=np.uint16)
        scaled = [np.minimum(255, 8 * np.log2(t + 1)).astype(np.uint8).tobytes() for t in total.values()]
        yield record_batch({"part": list(total), "levels": scaled}, schema)

    levels = np.zeros(CELLS, dtype=np.uint8)
    summed = parts.select(F.col("doc_id").alias("part"), "cells").repartition("part").mapInArrow(lean(run), "part long, levels binary")
    for r in summed.toLocalIterator():  # CELLS bytes in all, whatever the corpus
        levels[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["levels"], dtype=np.uint8)
    return levels


def _postings(source: DataFrame, k: int, percent: int, levels) -> DataFrame:
    """Prefix shingles of each set: (token, n, pos, d1, d2); equal sets of one task only once."""
    schema = pa.schema([("token", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())])

    def run(batches):
        level = levels.value
        seen: set[tuple[int, int]] = set()
        parts: list[tuple] = []
        held = 0
        for batch in batches:
            for _, values in textkernel.shingle_sets(batch.column("text"), k):
                n = len(values)
                key = textkernel.digests(values)
                if not n or key in seen:
                    continue
                seen.add(key)
                order = np.argsort(level[(values >> np.uint64(SHIFT)).astype(np.int64)], kind="stable")
                size = n - -(-percent * n // 100) + 1
                parts.append((values[order[:size]].view(np.int64), n, key))
                held += size
                if held > 200_000:
                    yield flush(parts)
                    parts, held = [], 0
        if parts:
            yield flush(parts)

    def flush(parts):
        sizes = np.array([len(p[0]) for p in parts])
        ends = np.cumsum(sizes)
        return record_batch({
            "token": np.concatenate([p[0] for p in parts]),
            "n": np.repeat(np.array([p[1] for p in parts], dtype=np.int32), sizes),
            "pos": (np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int32),
            "d1": np.repeat(np.array([p[2][0] for p in parts], dtype=np.int64), sizes),
            "d2": np.repeat(np.array([p[2][1] for p in parts], dtype=np.int64), sizes),
        }, schema)

    return source.mapInArrow(lean(run), "token long, n int, pos int, d1 long, d2 long")


def _keep_members(n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Members of one list, ordered by size, that may have a partner in it."""
    early = n - pos >= _needed(n, n, percent)  # may be the smaller set of a pair
    small = n[early]
    lowest = -(-percent * n // 100)
    # smaller (or equal) sets of the early block that are large enough
    partners = np.searchsorted(small, n, "right") - np.searchsorted(small, lowest, "left")
    keep = partners - early > 0
    # an early set may also have a larger partner, in either block
    larger = np.searchsorted(n, n * 100 // percent, "right") - np.searchsorted(n, n, "left")
    return keep | (early & (larger > 1))


def _leaders(postings: DataFrame, percent: int) -> DataFrame:
    """(leader, member) pairs from all index lists, each pair once per task; members are digests."""
    schema = pa.schema([(c, pa.int64()) for c in ("l1", "l2", "d1", "d2")] + [("n", pa.int32())])

    def run(batches):
        rest, out, held, long_list = None, [], 0, None
        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            if rest is not None:
                columns = {c: np.concatenate([rest[c], columns[c]]) for c in columns}
            token = columns["token"]
            if not len(token):
                continue
            if token[0] == token[-1] and len(token) > LIST_ROWS and long_list is None:
                long_list = (token[0], min(zip(columns["d1"].tolist(), columns["d2"].tolist())))
            if long_list is not None:
                # A list too long to hold: all its members go to the leader of its first part, which loses no pair.
                size = int(np.searchsorted(token, long_list[0], "right"))
                part = [np.full(size, x) for x in long_list[1]] + [columns[c][:size] for c in ("d1", "d2", "n")]
                yield flush([np.column_stack(part)])
                rest = {c: v[size:] for c, v in columns.items()}
                if not len(rest["token"]):
                    continue
                columns, token, long_list = rest, rest["token"], None
            last = int(np.searchsorted(token, token[-1], "left"))  # the last list may go on in the next batch
            rest = {c: v[last:] for c, v in columns.items()}
            made = lists({c: v[:last] for c, v in columns.items()})
            out, held = out + made, held + sum(map(len, made))
            if held > 50_000:
                yield flush(out)
                out, held = [], 0
        if rest is not None:
            out += lists(rest)
        if out:
            yield flush(out)

    def lists(c):
        if not len(c["token"]):
            return []
        starts = np.flatnonzero(np.append(True, c["token"][1:] != c["token"][:-1]))
        stops = np.append(starts[1:], len(c["token"]))
        found = []
        for a, b in zip(starts[stops - starts > 1].tolist(), stops[stops - starts > 1].tolist()):
            n, d1, d2 = c["n"][a:b], c["d1"][a:b], c["d2"][a:b]
            first = np.append(True, (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]) | (n[1:] != n[:-1]))
            n, pos, d1, d2 = n[first].astype(np.int64), c["pos"][a:b][first].astype(np.int64), d1[first], d2[first]
            if len(n) < 2:
                continue
            keep = _keep_members(n, pos, percent)
            n, d1, d2 = n[keep], d1[keep], d2[keep]
            # sizes further apart than the similarity allows end a run
            runs = np.flatnonzero(np.append(True, n[1:] * percent > n[:-1] * 100)) if len(n) else []
            for x, y in zip(runs, [*runs[1:], len(n)]):
                if y - x > 1:
                    lead = x + int(np.lexsort((d2[x:y], d1[x:y]))[0])
                    size = y - x
                    found.append(np.column_stack([np.full(size, d1[lead]), np.full(size, d2[lead]), d1[x:y], d2[x:y], n[x:y]]))
        return found

    def flush(found):
        rows = np.unique(np.concatenate(found), axis=0)
        return record_batch({"l1": rows[:, 0], "l2": rows[:, 1], "d1": rows[:, 2], "d2": rows[:, 3], "n": rows[:, 4].astype(np.int32)}, schema)

    ordered = postings.repartition("token").sortWithinPartitions("token", "n", "d1", "d2")
    return ordered.mapInArrow(lean(run), "l1 long, l2 long, d1 long, d2 long, n int")


def _sets(source: DataFrame, k: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("values", pa.binary())])

    def run(batches):
        for batch in batches:
            ids, d1, d2, out, rows, held = batch.column("doc_id"), [], [], [], [], 0
            for row, values in textkernel.shingle_sets(batch.column("text"), k):
                a, b = textkernel.digests(values)
                rows.append(row), d1.append(a), d2.append(b), out.append(values.tobytes())
                held += len(values)
                if held > 500_000:
                    yield record_batch({"doc_id": ids.take(pa.array(rows)), "d1": d1, "d2": d2, "values": out}, schema)
                    d1, d2, out, rows, held = [], [], [], [], 0
            if rows:
                yield record_batch({"doc_id": ids.take(pa.array(rows)), "d1": d1, "d2": d2, "values": out}, schema)

    return source.mapInArrow(lean(run), "doc_id long, d1 long, d2 long, values binary")


def group_links(sets: list[np.ndarray], leader: int, percent: int, left: np.ndarray | None = None) -> np.ndarray:
    """Component label (index of a member) of each set of one unit; ``left`` marks the sets of the first block if only pairs across count."""
    m = len(sets)
    n = np.array([len(s) for s in sets], dtype=np.int64)
    inside = np.array([np.isin(s, sets[leader], assume_unique=True).sum() for s in sets], dtype=np.int64)
    labels = np.arange(m)
    linked = 100 * inside >= percent * (n + n[leader] - inside)
    labels[linked] = leader
    outside = n - inside
    rest = np.flatnonzero(~linked)
    if not len(rest):
        return labels
    # Bound of every open comparison from the counts against the leader.
    bound = np.minimum(inside[rest, None], inside[None, :]) + np.minimum(outside[rest, None], outside[None, :])
    bound = np.minimum(bound, np.minimum(n[rest, None], n[None, :]))
    may = bound >= _needed(n[rest, None], n[None, :], percent)
    may[np.arange(len(rest)), rest] = False
    if left is not None:
        may &= left[rest, None] != left[None, :]
    rows, cols = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
    if not len(rows):
        return labels
    chosen = np.union1d(rest[rows], cols)
    token, owner = np.concatenate([sets[i] for i in chosen]), np.repeat(np.arange(len(chosen)), n[chosen])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    fresh = np.append(True, token[1:] != token[:-1])
    ident = np.cumsum(fresh) - 1
    often = np.bincount(ident) > 1  # a shingle of one set only adds to no overlap
    renumber = np.cumsum(often) - 1
    use = often[ident]
    ident, owner = renumber[ident[use]], owner[use]
    at_rows, at_cols = np.searchsorted(chosen, rest[rows]), np.searchsorted(chosen, cols)
    overlap = np.zeros((len(rows), len(cols)), dtype=np.float32)
    width = max(64, 4_000_000 // len(chosen))
    for lo in range(0, int(often.sum()), width):
        a, b = np.searchsorted(ident, (lo, lo + width))
        block = np.zeros((len(chosen), width), dtype=np.float32)
        block[owner[a:b], ident[a:b] - lo] = 1
        overlap += block[at_rows] @ block[at_cols].T
    union = n[rest[rows], None] + n[None, cols] - overlap
    link = (100 * overlap >= percent * union) & may[np.ix_(rows, cols)]
    x, y = np.nonzero(link)
    x, y = rest[rows][x], cols[y]
    return merge_labels(labels, x, y)


def _links(units: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between doc_ids from rows (l1, l2, bi, bj, block, lead, doc_id, values) sorted by unit."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        key, ids, blocks, sets, lead = None, [], [], [], -1
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("l1", "l2", "bi", "bj", "block", "lead", "doc_id", "values")]
            for l1, l2, bi, bj, block, is_lead, doc, values in zip(*columns):
                if (l1, l2, bi, bj) != key:
                    if key is not None:
                        yield from solve(key, ids, blocks, sets, lead)
                    key, ids, blocks, sets, lead = (l1, l2, bi, bj), [], [], [], -1
                if is_lead:
                    lead = len(ids)
                ids.append(doc), blocks.append(block), sets.append(np.frombuffer(values, dtype=np.uint64))
        if key is not None:
            yield from solve(key, ids, blocks, sets, lead)

    def solve(key, ids, blocks, sets, lead):
        if len(ids) < 2:
            return
        left = None if key[2] == key[3] else np.array(blocks) == key[2]
        labels = group_links(sets, max(lead, 0), percent, left)
        own = np.flatnonzero(labels != np.arange(len(ids)))
        if len(own):
            yield record_batch({"a": [ids[i] for i in own], "b": [ids[labels[i]] for i in own]}, schema)

    ordered = units.repartition("l1", "l2", "bi", "bj").sortWithinPartitions("l1", "l2", "bi", "bj", "d1", "d2")
    return ordered.mapInArrow(lean(run), "a long, b long")


def similar_sets(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id (smallest doc_id reachable by links)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    summaries = materialise(_summaries(source, words), "summaries")
    documents = summaries.where("kind = 0").drop("kind", "cells")
    levels = docs.sparkSession.sparkContext.broadcast(_levels(summaries.where("kind = 1")))
    classes = documents.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("class_id"))

    pairs = materialise(_leaders(_postings(source, words, percent, levels), percent).distinct(), "leaders")
    groups = pairs.groupBy("l1", "l2").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    groups = groups.where("sets > 1").select("l1", "l2", blocks.alias("blocks"))
    members = pairs.select("n", "d1", "d2").distinct().join(classes, ["n", "d1", "d2"])
    members = materialise(members, "members")
    wanted = broadcast_if_small(members.select("class_id").distinct())
    sets = _sets(source.join(wanted, F.col("doc_id") == F.col("class_id"), "left_semi"), words)

    own = F.pmod(F.xxhash64("d1", "d2"), F.col("blocks")).cast("int")
    lead = (F.col("l1") == F.col("d1")) & (F.col("l2") == F.col("d2"))
    # A member of block i takes part in the units (i, j) and (j, i); the leader also in all others.
    dealt = pairs.join(groups, ["l1", "l2"]).withColumn("block", own).withColumn("lead", lead)
    dealt = dealt.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    normal = dealt.where("NOT lead").withColumn("bi", F.least("block", "i")).withColumn("bj", F.greatest("block", "i"))
    leading = dealt.where("lead").withColumn("bi", F.col("i")).withColumn("bj", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)))
    units = normal.unionByName(leading).select("l1", "l2", "bi", "bj", "block", "lead", "d1", "d2")
    edges = _links(units.join(sets, ["d1", "d2"]), percent)
    found = components(edges.where("a IS NOT NULL AND b IS NOT NULL").distinct(), "jaccard")

    placed = classes.join(found, F.col("class_id") == F.col("node"), "left").select(
        "n", "d1", "d2", "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    return documents.join(placed, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
