"""Token files, packing and shards: exact round trips and invariants."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import ROWS, VOCABULARY, docs, empty
from trackmetrics.llm import bpe, kd_shards, packing, token_store


def ids_of(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")


def test_pieces_encode_like_whole_texts(monkeypatch):
    texts = [t or "" for _, t in ROWS] + ["a \n b", "x  y", "it's  'll\r\n z", "\x00 a", " lead", "trail ", "ünï 12,345 §§ ok"]
    enc = bpe.Encoder(VOCABULARY)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [ids_of(t)[:-1].tolist() for t in texts]
    monkeypatch.setattr(bpe, "TABLE_PIECES", 0)
    assert enc.encode(texts) == bpe.Encoder(VOCABULARY).encode(texts)


def test_any_characters_encode_like_whole_texts():
    rng = np.random.default_rng(0)
    parts = [*"abzAZ09 '.,|_-~^`\n\t\r\x0b\x1c\x1f\x7f\x85\xa0", *"éßÀÿ×÷ªºµ²½ɏɐǃ\u0300\u0345\u180e\u2003\u200b§ж中😀", " ", " ", "'s", "'ll", "'S", " 're", "\n\n", ".\nThe", " the", " of,", "***"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 30))) for _ in range(3000)] + [a + b for a in parts for b in parts] + [a + b + "a" for a in parts for b in parts]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    enc = bpe.Encoder(VOCABULARY)
    assert enc.encode(texts) == expected and enc.encode(texts) == expected  # unseen, then from the table


def test_known_words_in_new_company_are_not_encoded_again(monkeypatch):
    enc = bpe.Encoder(VOCABULARY)
    enc.encode(["The river is wide, and the old bridge, built in 1871, isn't.\nIt was the river's."])
    calls = []
    monkeypatch.setattr(enc.table, "tokenize", lambda word: calls.append(word) or enc.table.tokenizer.model.tokenize(word))
    monkeypatch.setattr(enc.table, "whole", lambda text: pytest.fail(f"{text!r} takes the whole path"))
    text = "The river, 1871, is the bridge.\nIt was built wide, and old, isn't it, river's bridge."
    assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == ids_of(text)[:-1].tolist()
    assert len(calls) == 1  # " it"


def test_table_of_pieces_is_bounded():
    enc = bpe.Encoder(VOCABULARY)
    enc.table.limit = 50
    texts = [f"word{i} another{i}, Ende{i}.\nUnd" for i in range(200)]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [ids_of(t)[:-1].tolist() for t in texts]
    assert len(enc.table) == 50


def test_token_store_round_trip(spark, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    source = docs(spark)
    manifest = token_store.write_store(source, folder, VOCABULARY)
    found = token_store.read_store(spark, folder, manifest, with_ids=True).orderBy("start").collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0]))  # the row without an id comes first
    start = 0
    assert len(found) == len(order)
    for r, (i, t) in zip(found, order):
        ids = ids_of(t)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        assert bytes(r["ids"]) == ids.tobytes()
        start += len(ids)
    file = next(r["file"] for r in found if r["doc_id"] == 5)
    assert token_store.read_document(folder, file, 5).tolist() == ids_of(ROWS[5][1]).tolist()
    assert token_store.read_document(folder, file, 999) is None
    first = next(r["file"] for r in found if r["doc_id"] == 0)
    assert token_store.read_document(folder, first, 0).tolist() == ids_of(ROWS[0][1]).tolist()
    assert token_store.tokenise_to_files(empty(spark), VOCABULARY).count() == 0


def slow_best_fit(lengths, capacity):
    rooms, bins = [], []
    for n in sorted(lengths, reverse=True):
        fit = [k for k, room in enumerate(rooms) if room >= n]
        k = min(fit, key=lambda k: rooms[k], default=None)
        if k is None:
            rooms.append(capacity)
            bins.append([])
            k = len(rooms) - 1
        rooms[k] -= n
        bins[k].append(n)
    return Counter(map(sum, bins))  # which of equally full bins takes a piece is open


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 65, 400).tolist() + [7] * 60 + [33] * 20
    bins = {}
    for length, _, number, first, offset in packing.plan(Counter(lengths), 64):
        for k in range(number):
            bins.setdefault(first + k, []).append((offset, length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [0, *np.cumsum([n for _, n in b])[:-1].tolist()] and sum(n for _, n in b) <= 64
    assert Counter(sum(n for _, n in b) for b in bins.values()) == slow_best_fit(lengths, 64)


def test_packing_places_every_token_once(spark):
    found = packing.pack(docs(spark), VOCABULARY, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for i, t in ROWS:
        rows = sorted(by_doc[i], key=lambda r: r["piece"])[:: 2 if i == 12 else 1]
        assert b"".join(bytes(r["ids"]) for r in rows) == ids_of(t).tobytes()
        assert all(r["length"] == 1024 for r in rows[1:])
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1].tolist()] and sum(n for _, n in places) <= 1024
    assert packing.pack(empty(spark), VOCABULARY).count() == 0


def test_shards_are_gapless_and_near_equal(spark):
    rows = [(i, "x" * ((i * 37) % 200)) for i in range(600)] + [(i, "same text") for i in range(600, 900)] + [(5000, None), (5000, None)]
    found = kd_shards.assign(docs(spark, rows), leaves=7).collect()
    assert len(found) == len(rows)
    sizes, slots = Counter(), {}
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) - min(sizes.values()) <= 3 * 216
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = dict(rows)
    assert all(r["size"] == len(texts[r["doc_id"]] or "") + 16 and r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode()) for r in found)
    assert kd_shards.assign(empty(spark), leaves=7).count() == 0
    assert kd_shards.assign(docs(spark, rows), target_bytes=20_000).agg({"shard": "max"}).first()[0] >= 3
    assert kd_shards.assign(docs(spark), leaves=3).count() == len(ROWS)


def test_equal_texts_share_a_shard_whatever_the_partitions(spark):
    rows = [(i, "x" * ((i * 37) % 200 + 1) + str(i)) for i in range(600)]
    rows += [(1000 + 10 * i + k, f"copy {i} " * 5) for i in range(40) for k in range(i % 4 + 1)]  # small groups
    rows += [(2000 + i, "one text of a third of all rows") for i in range(300)]
    rows += [(3000, "the very same row") for _ in range(150)] + [(None, None)] * 90
    leaves, found = 7, {}
    for parts in (1, 3, 8):
        source = docs(spark, rows).repartition(parts, F.xxhash64("doc_id", F.lit(parts)))
        found[parts] = sorted(map(tuple, kd_shards.assign(source, leaves=leaves).drop("slot").collect()), key=str)
    assert found[1] == found[3] == found[8] and len(found[1]) == len(rows)
    texts = dict(rows)
    shards, sizes = {}, Counter()
    for doc_id, size, _, shard in found[1]:
        shards.setdefault(texts[doc_id], set()).add(shard)
        sizes[shard] += size
    target = sum(sizes.values()) / leaves
    assert len(sizes) == leaves and max(abs(b - target) for b in sizes.values()) <= 240
    assert sum(len(s) > 1 for s in shards.values()) <= leaves - 1
