"""Removal of byte strings that stand earlier in the corpus.

A byte is removed if some string of ``LENGTH`` bytes around it also starts earlier (smaller doc_id, or the same document
and an earlier start), judged on the input.

Sorting every suffix moves at least eight bytes per input byte several times.  This operator sorts
samples, as difference-cover sorting does, but chooses them by content: each window of LENGTH bytes is represented by
its ``GRAM``-byte string of lowest hash, so equal windows have equal representatives at equal offsets wherever they stand
(a difference cover gives a common sample only pair by pair).

1. Representatives (about one per 39 bytes) are named by their hash; names that occur once leave.  A bitmap of fixed size
   keeps the names that occur more often; a false hit costs work, never a wrong result.
2. Representatives with a repeated name are sorted by (name, doc_id, place) with the bytes their windows span, the part that all
   of them share as the value of its polynomial.  Within a name equal windows are found in order; the first stays, later ones are removed.  A task gives equal strings of its own only once,
   so a passage of a third of all documents is a row per task here.
3. Removed ranges are merged per document.  Only documents with a range meet them in a shuffle: a second bitmap of the same fixed size
   keeps the others where they are read, and a false hit moves a text for nothing.

Windows are compared by name and a second 64-bit hash.  Null and empty texts have no bytes; rows that repeat doc_id and text are one document;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from trackmetrics.llm import textkernel
from trackmetrics.llm.common import record_batch
from trackmetrics.session import materialise

LENGTH = 100
GRAM = 24
#: Bits of the bitmap of repeated names (32 MB, whatever the corpus).
BITMAP_BITS = 28
_MULT = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(int(_MULT), -1, 1 << 64))
_VALUES = textkernel.mix(np.arange(256, dtype=np.uint64) + np.uint64(0x2545F491))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, b in enumerate((_MULT, _BACK)):
            steps = np.full(max(n, 1 << 20), b, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def _string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of every string of ``length`` consecutive bytes."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    down, total = _tables(len(data) + 1)[1], _sums(data)
    return textkernel.mix((total[length:] - total[:-length]) * down[:n])


def _sums(data: np.ndarray) -> np.ndarray:
    """Sums of the polynomial over the bytes before each place; a string's value is the difference at its ends, moved to its start."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * _tables(len(data) + 1)[0][: len(data)], out=total[1:])
    return total


def _span_hashes(data: np.ndarray, cores: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """The hashes that :func:`_string_hashes` gives the windows of each span, from its outer bytes and the value of its core.

    A span of n windows is n - 1 bytes, a core that lies in all its windows, and n - 1 bytes: window s has the core, the bytes
    before it but the first s, and s bytes behind it.
    """
    up, down = _tables(max(len(data), length) + 1)
    total = _sums(data)
    stop = np.cumsum(2 * (sizes - 1))
    index = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(index)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    middle = (stop - sizes + 1)[index]
    left = middle - sizes[index] + 1 + step
    before = (total[middle] - total[left]) * down[left]
    behind = (total[middle + step] - total[middle]) * down[middle]
    return textkernel.mix(before + cores[index] * up[sizes[index] - 1 - step] + behind * up[length - step])


def representatives(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, place, first window, last window, name) of each representative; places count from the start of the row's text."""
    names = _string_hashes(data, gram)
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    at = np.arange(len(names), dtype=np.uint64)
    low = (names & np.uint64(0xFFFFFFFF00000000)) | at  # ties go to the leftmost place
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)[:n]
    valid = np.arange(n) + length <= offsets[row + 1]
    start = np.flatnonzero(valid)
    place = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.append(True, (place[1:] != place[:-1]) | (row[start[1:]] != row[start[:-1]]))[: len(start)]
    first = start[fresh]
    last = start[np.append(np.flatnonzero(fresh)[1:] - 1, len(start) - 1)] if len(start) else start
    place, row = place[fresh], row[first]
    base = offsets[row]
    # The lowest hashes of their windows crowd at the low end; mixed again, names spread over the buckets and the bitmap.
    return row, place - base, first - base, last - base, textkernel.mix(names[place])


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("doc_hash"), text.alias("text"))


def _repeated_names(source: DataFrame, length: int, gram: int) -> np.ndarray:
    """Bitmap of the names that occur at least twice, by their first BITMAP_BITS bits."""
    spark = source.sparkSession
    buckets = 1 << max(5, (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    cells = (1 << BITMAP_BITS) // buckets
    out = pa.schema([("bucket", pa.int32()), ("names", pa.binary())])

    def name(batches):
        for batch in batches:
            found = [representatives(data, offsets, length, gram)[4] for _, data, offsets in textkernel.slices(batch.column("text"))]
            if not found:
                continue
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            values = np.repeat(values, np.minimum(counts, 2))
            ends = np.searchsorted((values >> shift).astype(np.int64), np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(ends))
            yield record_batch({"bucket": used.astype(np.int32), "names": [values[ends[b] : ends[b + 1]].tobytes() for b in used]}, out)

    def count(batches):
        # A bucket holds a fixed share of the names; it is reduced to its repeated names as batches come.
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, names in zip(batch.column("bucket").to_pylist(), batch.column("names")):
                held.setdefault(bucket, []).append(np.frombuffer(names.as_buffer(), dtype=np.uint64))
        for bucket in sorted(held):
            values = np.sort(np.concatenate(held.pop(bucket)))
            twice = values[1:][values[1:] == values[:-1]]
            bits = np.zeros(cells, dtype=bool)
            bits[((twice >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)) - bucket * cells] = True
            yield record_batch({"bucket": [bucket], "names": [np.packbits(bits).tobytes()]}, out)

    named = source.select("text").mapInArrow(name, "bucket int, names binary").repartition("bucket")
    bitmap = np.zeros((1 << BITMAP_BITS) // 8, dtype=np.uint8)
    for r in named.mapInArrow(count, "bucket int, names binary").toLocalIterator():
        at = r["bucket"] * cells // 8
        bitmap[at : at + cells // 8] = np.frombuffer(r["names"], dtype=np.uint8)
    return bitmap


def _candidates(source: DataFrame, bitmap, length: int, gram: int) -> DataFrame:
    """Representatives with a repeated name, the value of the bytes that all their windows share and the bytes around it; what was seen earlier in the task is given as ranges."""
    fields = [(c, pa.int64()) for c in ("name", "doc_id", "doc_hash", "first", "last", "core")] + [("bytes", pa.binary())]
    schema = pa.schema(fields)

    def run(batches):
        bits = bitmap.value
        earliest: dict[int, int] = {}
        spans: dict[int, tuple[int, int]] = {}  # earliest place of each string of this task, by its hash
        for batch in batches:
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("doc_hash").to_pylist()
            for base, data, offsets in textkernel.slices(batch.column("text")):
                row, _, first, last, names = representatives(data, offsets, length, gram)
                cell = (names >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                keep = (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
                whole = []
                skip = np.zeros(len(offsets) - 1, dtype=bool)
                for k in range(len(offsets) - 1):
                    doc, mark, size = ids[base + k], marks[base + k], int(offsets[k + 1] - offsets[k])
                    if doc is None or size < length:
                        skip[k] = True
                        continue
                    known = earliest.get(mark)
                    if known is not None and known <= doc:
                        skip[k] = True
                        if known < doc:
                            whole.append((doc, mark, size - length))
                    else:
                        earliest[mark] = doc
                keep &= ~skip[row]
                row, first, last, names = row[keep], first[keep], last[keep], names[keep]
                start = offsets[row]
                total, down = _sums(data), _tables(len(data) + 1)[1]
                cores = ((total[start + first + length] - total[start + last]) * down[start + last]).view(np.int64)
                raw, rows, ended = data.tobytes(), [], None
                for name, k, s, a, b, core in zip(names.view(np.int64).tolist(), row.tolist(), start.tolist(), first.tolist(), last.tolist(), cores.tolist()):
                    span, place = raw[s + a : s + b + length], (ids[base + k], a)
                    known = spans.get(h := hash(span))
                    if known is None or place < known:
                        spans[h] = place
                        rows.append((name, place[0], marks[base + k], a, b, core, span[: b - a] + span[length:]))
                    elif known < place:  # all its windows stand earlier in this task: a range needs no comparison
                        begin = rows.pop()[3] if ended == (k, a) else a
                        rows.append((place[0], place[0], marks[base + k], begin, b, None, None))
                        ended = (k, b + 1)
                rows += [(doc, doc, mark, 0, last, None, None) for doc, mark, last in whole]
                if rows:
                    yield record_batch(dict(zip(schema.names, zip(*rows))), schema)

    return source.mapInArrow(run, "name long, doc_id long, doc_hash long, first long, last long, core long, bytes binary")


def _ranges(candidates: DataFrame, length: int) -> DataFrame:
    """(doc_id, doc_hash, start, stop) byte ranges covered by windows that stand earlier."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "doc_hash", "start", "stop")])

    def run(batches):
        name, seen, previous = None, np.zeros(0, np.uint64), None
        for batch in batches:
            for lo in range(0, len(batch), 4_000):
                part = batch.slice(lo, 4_000)
                whole = part.filter(pa.compute.is_null(part.column("bytes")))
                if len(whole):
                    yield record_batch({"doc_id": whole.column("doc_id"), "doc_hash": whole.column("doc_hash"), "start": whole.column("first"),
                                        "stop": pa.compute.add(whole.column("last"), length)}, schema)
                part = part.filter(pa.compute.is_valid(part.column("bytes")))
                if not len(part):
                    continue
                c = {k: part.column(k).to_numpy() for k in ("name", "doc_id", "doc_hash", "first", "last", "core")}
                # a row that repeats the row before it is the same place of the same document
                same = np.ones(len(part), dtype=bool)
                for k in ("name", "doc_id", "doc_hash", "first"):
                    same &= np.append(previous is not None and previous[k] == c[k][0], c[k][1:] == c[k][:-1])
                previous = {k: v[-1] for k, v in c.items()}
                sizes = (c["last"] - c["first"] + 1)
                blob = np.frombuffer(b"".join(part.column("bytes").to_pylist()), dtype=np.uint8)
                index = np.repeat(np.arange(len(sizes)), sizes)
                step = np.arange(len(index)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                windows = _span_hashes(blob, c["core"].view(np.uint64), sizes, length)
                key = textkernel.mix(windows + c["name"].view(np.uint64)[index] * _MULT)
                live = np.flatnonzero(~same[index])
                _, at, inverse = np.unique(key[live], return_index=True, return_inverse=True)
                later = np.ones(len(live), dtype=bool)
                later[at] = False
                if c["name"][0] == name and len(seen):
                    head = np.flatnonzero(c["name"][index[live]] == name)
                    later[head] |= np.isin(windows[live[head]], seen)
                tail = windows[live[c["name"][index[live]] == c["name"][-1]]]
                seen = np.unique(np.concatenate([seen, tail])) if c["name"][-1] == name else np.unique(tail)
                name = c["name"][-1]
                hit = live[later]
                if not len(hit):
                    continue
                row, place = index[hit], c["first"][index[hit]] + step[hit]
                fresh = np.append(True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1))
                stop = place[np.append(np.flatnonzero(fresh)[1:] - 1, len(place) - 1)] + length
                yield record_batch({"doc_id": c["doc_id"][row[fresh]], "doc_hash": c["doc_hash"][row[fresh]], "start": place[fresh], "stop": stop}, schema)

    ordered = candidates.repartition("name").sortWithinPartitions("name", "doc_id", "doc_hash", "first")
    return ordered.mapInArrow(run, "doc_id long, doc_hash long, start long, stop long")


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of the column ``cell``, lowest bit of a byte first."""
    at = F.col("cell") + 1
    parts = keys.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bitmap = np.zeros((1 << BITMAP_BITS) // 8, dtype=np.uint8)
    for r in parts.toLocalIterator():  # together the bitmap at most
        start = (r["bucket"] - 1) * len(r["bits"])
        bitmap[start : start + len(r["bits"])] = np.frombuffer(r["bits"], dtype=np.uint8)
    return bitmap


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (and kept, the remaining bytes)."""
    source = _source(docs, id_col, text_col)
    bitmap = source.sparkSession.sparkContext.broadcast(_repeated_names(source, length, gram))
    ranges = _ranges(_candidates(source, bitmap, length, gram), length)
    spans = ranges.groupBy("doc_id", "doc_hash").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("s"))
    spans = materialise(spans.select("doc_id", "doc_hash", F.col("s.start").alias("starts"), F.col("s.stop").alias("stops")), "ranges")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("starts", pa.list_(pa.int64())),
        ("stops", pa.list_(pa.int64())), *([("kept", pa.binary())] if with_kept else []),
    ])

    cell = F.shiftrightunsigned(F.xxhash64("doc_id", "doc_hash"), 64 - BITMAP_BITS)
    touched = source.sparkSession.sparkContext.broadcast(_bitmap(spans.select(cell.alias("cell"))))

    def having(batch, wanted):
        cells = batch.column("cell").to_numpy()
        return batch.filter(pa.array(((touched.value[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1) == wanted))

    def moved(batches):
        for batch in batches:
            yield having(batch, True).select(["doc_id", "doc_hash", "text"])

    def cut(batches):
        for batch in batches:
            if "cell" in batch.schema.names:
                batch = having(batch, False)
            for lo in range(0, len(batch), 500):
                part = batch.slice(lo, 500)
                rows = {f.name: [] for f in schema}
                for doc, text, starts, stops in zip(*[part.column(c) for c in ("doc_id", "text", "starts", "stops")]):
                    raw = text.as_py().encode()
                    merged: list[list[int]] = []
                    for a, b in zip(starts.as_py() or [], stops.as_py() or []):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    at, kept = 0, []
                    for a, b in merged:
                        kept.append(raw[at:a])
                        at = b
                    left = b"".join([*kept, raw[at:]])
                    values = (doc.as_py(), len(raw), len(raw) - len(left), len(merged), hashlib.sha256(left).hexdigest(), [m[0] for m in merged], [m[1] for m in merged], left)
                    for f, v in zip(schema, values):
                        rows[f.name].append(v)
                yield record_batch(rows, schema)

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, stops array<long>" + (", kept binary" if with_kept else "")
    marked = source.withColumn("cell", cell)
    joined = marked.mapInArrow(moved, "doc_id long, doc_hash long, text string").join(spans, ["doc_id", "doc_hash"], "left").select("doc_id", "text", "starts", "stops")
    none = F.lit(None).cast("array<long>")
    still = marked.select("doc_id", "text", none.alias("starts"), none.alias("stops"), "cell")
    return joined.mapInArrow(cut, out).unionByName(still.mapInArrow(cut, out))
