"""Line de-duplication, Jaccard join, repeated strings and contamination against brute force and on awkward rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.helpers import LONG, ROWS, components, docs, empty
from trackmetrics.llm import decontaminate, jaccard_join, line_dedup, repeats, textkernel

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def some_texts(seed=3, n=60):
    """Texts with copies, near copies, shared lines and shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 20))) for _ in range(30)]
    out = []
    for i in range(n):
        if i % 5 == 4:
            words = out[rng.randrange(len(out))].split(" ")
            for _ in range(rng.choice((0, 1, 2, 6))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
            continue
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 5))]
        parts.insert(rng.randint(0, len(parts)), rng.choice(lines))
        if i % 7 == 0:
            parts.append(passage)
        out.append("\n".join(parts))
    return [(i, t) for i, t in enumerate(out)]


def ascii_words(text):
    return tuple((text or "").encode().lower().split())


def shingle_set(text, k=5):
    w = ascii_words(text)
    return {w[i : i + k] for i in range(len(w) - k + 1)} if len(w) >= k else ({w} if w else set())


def test_word_hashes_follow_the_definition():
    import pyarrow as pa

    texts = ["Ab c\x0b\x0cÉ ab", None, "", " x", "ab"]
    seen = {}
    for first, data, offsets in textkernel.slices(pa.array(texts)):
        hashes, _, bounds = textkernel.words(data, offsets)
        for row in range(len(offsets) - 1):
            assert len(hashes[bounds[row] : bounds[row + 1]]) == len(ascii_words(texts[first + row]))
            for word, h in zip(ascii_words(texts[first + row]), hashes[bounds[row] : bounds[row + 1]].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("rows", [some_texts(), ROWS[:-3]], ids=["random", "awkward"])
def test_jaccard_join(spark, rows):
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(sets, links)
    found = {r["doc_id"]: r for r in jaccard_join.similar_sets(docs(spark, rows)).collect()}
    assert {i: r["component_id"] for i, r in found.items()} == want
    assert {i: r["n_shingles"] for i, r in found.items()} == {i: len(s) for i, s in sets.items()}


def test_jaccard_units_keep_all_links_when_split(spark, monkeypatch):
    rows = some_texts(9, 80)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 2)
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", 3)
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_sets(docs(spark, rows)).collect()}
    assert found == components(sets, links)


def test_group_links_equals_all_pairs():
    rng = np.random.default_rng(5)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.sort(rng.choice(base, rng.integers(70, 100), replace=False)) for _ in range(60)] + [np.arange(500, 560, dtype=np.uint64)]
    for leader in (0, 13, 60):
        labels = jaccard_join.group_links(sets, leader, 80)
        links = [(i, j) for i in range(61) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
        want = components(range(61), links)
        assert len({(want[i], int(labels[i])) for i in range(61)}) == len(set(want.values())) == len(set(labels.tolist()))


def slow_lines(rows, min_words):
    first, places = {}, []
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        for n, line in enumerate(t.split("\n")):
            w = ascii_words(line)
            places.append((i, n, line, w))
            if w:
                first.setdefault(w, (i, n))
    lines = list(first)
    near = {a for a in lines for b in lines if len(a) >= min_words and len(b) >= min_words and first[b] < first[a] and line_dedup.within_one_edit(list(a), list(b))}
    out = {i: [] for i, t in rows if t is not None}
    for i, n, line, w in places:
        if not w or (first[w] == (i, n) and w not in near):
            out[i].append(line)
    return {i: "\n".join(x) for i, x in out.items()}


def edit_lines():
    rng = random.Random(2)
    rows = []
    base = [[f"v{rng.randrange(50)}" for _ in range(rng.randint(8, 14))] for _ in range(8)]
    for i in range(40):
        lines = []
        for _ in range(3):
            w = list(rng.choice(base))
            for _ in range(rng.choice((0, 1, 1, 2))):
                k, at = rng.randrange(3), rng.randrange(len(w))
                w[at : at + (k != 2)] = [] if k == 0 else [f"e{rng.randrange(9)}"]
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("rows", [edit_lines(), some_texts(4), ROWS[:-3]], ids=["edits", "random", "awkward"])
def test_line_dedup(spark, rows):
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    want = slow_lines(rows, line_dedup.MIN_WORDS)
    assert {i: r["text"] for i, r in found.items() if r["text"] is not None} == want
    assert all(r["n_lines"] - r["n_exact"] - r["n_near"] == len(want.get(i, "").split("\n")) or want.get(i, "") == "" for i, r in found.items())


def test_within_one_edit():
    assert line_dedup.within_one_edit(list("abc"), list("abc")) and line_dedup.within_one_edit(list("abc"), list("abxc"))
    assert line_dedup.within_one_edit(list("abc"), list("axc")) and line_dedup.within_one_edit(list("aab"), list("ab"))
    assert not line_dedup.within_one_edit(list("abc"), list("acb")) and not line_dedup.within_one_edit(list("abc"), list("abcde"))


def slow_repeats(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            else:
                seen.add(raw[p : p + length])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("rows", [some_texts(6, 50), ROWS[:-3] + [(20, "ab" * 400), (21, "ab" * 90)]], ids=["random", "awkward"])
def test_repeats(spark, rows):
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove_repeats(docs(spark, rows)).collect()}
    assert found == slow_repeats(rows)


def slow_contamination(rows, items):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    out = {}
    for i, t in rows:
        w, hit, held = cut(t), set(), set()
        for item, text in items:
            b = cut(text)
            n = min(13, len(b))
            windows = {tuple(b[s : s + n]) for s in range(len(b) - n + 1)} if n else set()
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= {*range(s, s + n)}
                    held.add(str(item))
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        out[i] = (len(w), len(hit), len(held), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_contamination(spark):
    rows = some_texts(8, 40)
    items = [(k, " ".join(rows[k][1].split()[2:22])) for k in range(0, 40, 3)] + [(100, "one two"), (101, ""), (102, None), (10, "w1x1, W2x2"), (11, rows[7][1])]
    rows += [(200 + i, t) for i, t in ROWS[:-3]] + [(300, "one. Two three"), (301, "ONE-TWO")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    result = decontaminate.contamination(docs(spark, rows), benchmark)
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in result.collect()}
    assert found == slow_contamination(rows, items)
    assert decontaminate.contamination(docs(spark, rows), benchmark.limit(0)).where("n_hit > 0 OR contaminated").count() == 0


@pytest.mark.parametrize("operator", [jaccard_join.similar_sets, line_dedup.dedup_lines, repeats.remove_repeats])
def test_empty_tables_and_repeated_rows(spark, operator):
    assert operator(empty(spark)).count() == 0
    found = operator(docs(spark)).collect()
    assert len(found) == len(ROWS)
    twice = [r for r in found if r["doc_id"] == 12]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert sum(r["doc_id"] is None for r in found) == 1


def test_near_line_whose_first_copy_has_no_id(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(None, line), (1, line + "\nown words here"), (2, line.replace("five", "other") + "\nlast words")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["text"], r["n_exact"], r["n_near"]) for r in line_dedup.dedup_lines(table).collect()}
    assert found == {None: (line, 0, 0), 1: ("own words here", 1, 0), 2: ("last words", 0, 1)}


def test_contamination_with_shingles_too_many_to_broadcast(spark, monkeypatch):
    """No table is broadcast by hint: the same result, and no exchange carries the words of whole documents."""
    table, items = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "benchmark"))
    awkward = docs(spark)
    expected = [sorted(map(repr, decontaminate.contamination(x, items).collect())) for x in (table, awkward)]
    monkeypatch.setattr(decontaminate, "broadcast_if_small", lambda df, **kw: df)
    plans, real = [], decontaminate.materialise
    monkeypatch.setattr(decontaminate, "materialise", lambda df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), real(df, name))[1])
    assert [sorted(map(repr, decontaminate.contamination(x, items).collect())) for x in (table, awkward)] == expected
    join = next(p for n, p in plans if n == "hits")
    left = join[join.index("Join LeftOuter") :].split("\n")[1]
    assert "__own" in left and "__w#" not in left.split("AS __own")[-1]


def test_documents_without_repeats_stay_where_they_are_read(spark):
    """The branch that holds them has no exchange; the one that meets the ranges takes the others only."""
    rows = [(i, f"text {i} " + LONG[900 * i : 900 * (i + 1)]) for i in range(20)] + [(20, "x" + LONG[:400]), (None, LONG[:300]), (21, None)]
    found = repeats.remove_repeats(docs(spark, rows))
    branches = found._jdf.queryExecution().optimizedPlan().children()
    plans = [str(branches.apply(i)) for i in range(branches.size())]
    assert ["Join" in p for p in plans] == [True, False]
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == {**{r[0]: 0 for r in rows}, 20: 400}


def test_span_hashes_are_those_of_the_windows():
    data = np.frombuffer(LONG[:2000].encode(), dtype=np.uint8)
    first, last = np.array([0, 7, 700, 1899]), np.array([0, 83, 738, 1900])
    total, down = repeats._sums(data), repeats._tables(len(data) + 1)[1]
    cores = (total[first + 100] - total[last]) * down[last]
    outer = np.concatenate([data[x] for a, b in zip(first, last) for x in (slice(a, b), slice(a + 100, b + 100))])
    wanted = repeats._string_hashes(data, 100)
    assert (repeats._span_hashes(outer, cores, last - first + 1, 100) == np.concatenate([wanted[a : b + 1] for a, b in zip(first, last)])).all()


def test_ranges_known_in_a_task_are_joined(spark):
    """Half a text again, with other words before it: its windows are one row, though they have many representatives."""
    source = repeats._source(spark.createDataFrame([(0, LONG[:4000]), (1, "other words " + LONG[:2000])], "doc_id long, text string").coalesce(1), "doc_id", "text")
    every = spark.sparkContext.broadcast(np.full((1 << repeats.BITMAP_BITS) // 8, 255, dtype=np.uint8))
    found = repeats._candidates(source, every, repeats.LENGTH, repeats.GRAM).where("doc_id = 1 AND bytes IS NULL").collect()
    assert len(found) == 1 and found[0]["last"] - found[0]["first"] > 1800


def test_names_spread_over_buckets_and_bitmap():
    """A name is the lowest hash of its window; unmixed, nine tenths of them would lie in the lowest 32nd."""
    data = np.random.default_rng(5).integers(97, 123, 200_000).astype(np.uint8)
    names = repeats.representatives(data, np.array([0, len(data)]))[4]
    shares = np.bincount((names >> np.uint64(59)).astype(np.int64), minlength=32) / len(names)
    assert len(names) > 4_000 and shares.max() < 0.05 and shares.min() > 0.015
