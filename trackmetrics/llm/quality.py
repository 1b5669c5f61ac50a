"""Weakly supervised quality classifier.

1. Overlapping heuristic labellers vote junk, good or nothing on every document.
2. Expectation-maximisation over the counts of vote patterns (at most 3^labellers rows, from all documents) estimates each
   labeller's accuracy per class and the posterior of each pattern; no true label is used.
3. The posteriors label a bounded sample of distinct texts (chosen by a hash of the text, about ``TRAIN_ROWS`` at most) on which a logistic scorer
   over hashed features is fitted: strings of four byte classes, and how often words and lines repeat within the text.  If the sample
   is empty, as copies of few texts may leave it, the posterior of its votes is the score of a text.
4. The scorer is applied to every whole text.
5. Abuse is a verdict of its own, as a text may be well formed and abusive: ``abuse`` counts the words of a text that stand in a list
   (a parameter; not case-sensitive, whole words), and ``toxic`` holds from ``ABUSE_LEAST`` such words that make up ``ABUSE_SHARE`` of the words.
   ``keep`` does not depend on it.

Texts without words get the score 1 and are rejected, as there is nothing to learn from; null is an empty text; repeated rows are scored one by one;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from trackmetrics.llm import textkernel
from trackmetrics.llm.common import lean, record_batch
from trackmetrics.session import materialise

#: Bound of the fitting sample, number of hashed features, and the score from which a text is rejected (above one half, to spare good texts).
TRAIN_ROWS = 6_000
DIMENSIONS = 2_048
ROUNDS = 50
#: Rows whose features are held at a time, some 50 bytes for each feature.
SLICE_ROWS = 512
STEPS = 300
REJECT = 0.7
#: A general list of insults in the four languages of common corpora; callers pass their own.
ABUSE_WORDS = tuple("""
    arsehole arseholes asshole assholes bastard bastards bitch bitches bullshit clown clowns coward cowards creep creeps cretin cretins crap cunt cunts
    degenerate degenerates dickhead dickheads dimwit dimwits disgrace disgusting dumb dumbass dumbest fool fools freak freaks fuck fucked fucker fuckers fucking
    garbage hateful idiot idiotic idiots imbecile imbeciles jackass jerk jerks lame loser losers lowlife lowlifes lunatic maggot maggots moron moronic morons
    motherfucker nitwit parasite parasites pathetic pig pigs piss prick pricks psycho pussy rat rats repulsive retard retarded retards scum scumbag scumbags
    shit shithead shitty shut simpleton slut sluts stupid stupidity suck sucks swine trash twat twats twit ugly useless vermin vile whore whores worthless wretch
    connard connards connasse crétin crétine débile enculé imbécile merde ordure pute salaud salope abruti abrutis
    abschaum arschloch bastarde dummkopf drecksack hurensohn idioten miststück scheiße scheisse schlampe schwein trottel vollidiot wichser
    basura cabrón cabrones estúpida estúpido gilipollas hijoputa idiota idiotas imbécil mierda puta puto tonto
""".split())
ABUSE_LEAST = 2
ABUSE_SHARE = 0.01
_OTHER, _LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _COMMA, _BANG, _BAR, _SIGN = range(11)


def _classes() -> np.ndarray:
    out = np.full(256, _SIGN, dtype=np.uint8)
    for low, high, kind in ((97, 123, _LOWER), (65, 91, _UPPER), (48, 58, _DIGIT), (128, 256, _OTHER)):
        out[low:high] = kind
    for text, kind in ((b" \t\r\x0b\x0c", _SPACE), (b"\n", _LINE), (b".?:;", _STOP), (b",'\"-()", _COMMA), (b"!", _BANG), (b"|", _BAR)):
        out[list(text)] = kind
    return out


_CLASS = _classes()
#: name, measure, junk at or above, good at or below (or the reverse, if the first is smaller); between them no vote
LABELLERS = (
    ("capitals", "upper", 0.30, 0.10),
    ("exclamation", "bang", 0.20, 0.02),
    ("signs", "sign", 0.03, 0.01),
    ("tables", "bar", 0.10, 0.02),
    ("word_repetition", "distinct_words", 0.45, 0.60),
    ("line_repetition", "distinct_lines", 0.60, 0.80),
    ("long_words", "word_bytes", 7.0, 6.2),
    ("few_short_words", "short", 0.18, 0.25),
    ("no_sentences", "stop", 0.005, 0.03),
    ("dominant_word", "top_word", 0.20, 0.12),
    ("echo", "echo", 0.15, 0.03),
)
MEASURES = ("upper", "bang", "sign", "bar", "distinct_words", "distinct_lines", "word_bytes", "short", "stop", "top_word", "echo")
#: Repetition says nothing about a text of fewer words or lines than this.
REPETITION_WORDS = 20
REPETITION_LINES = 3


def _measures(kinds: np.ndarray, rows: np.ndarray, n_rows: int, hashes, first, bounds, data, offsets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures per row (nan: not applicable), words per row, and per word how often it stands in its row."""
    table = np.bincount(rows * 16 + kinds, minlength=n_rows * 16).reshape(n_rows, 16).astype(float)
    n_words = np.diff(bounds)
    word_row = np.repeat(np.arange(n_rows), n_words)
    # counts of equal words within a row
    order = np.lexsort((hashes, word_row))
    h, r = hashes[order], word_row[order]
    fresh = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))[: len(h)]
    group = np.cumsum(fresh) - 1
    times = np.bincount(group)[group] if len(h) else np.zeros(0, int)
    counts = np.empty(len(h), dtype=np.int64)
    counts[order] = times
    distinct = np.bincount(r[fresh], minlength=n_rows)
    # words of one to three bytes, stops and commas not counted apart
    space_after = np.append(np.flatnonzero((kinds == _SPACE) | (kinds == _LINE)), len(data))
    ends = np.minimum(space_after[np.searchsorted(space_after, first)], offsets[np.minimum(word_row + 1, n_rows)])
    length = ends - first
    wordy = kinds[first] != _BAR  # the bars of a table are no words here
    n_wordy = np.bincount(word_row[wordy], minlength=n_rows)
    short = np.bincount(word_row[wordy & (length <= 4)], minlength=n_rows)
    # lines by the polynomial of their words
    breaks = np.flatnonzero(kinds == _LINE)
    line_of_word = np.searchsorted(breaks, first) + word_row  # distinct ids per (row, line)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes, out=total[1:])
    starts = np.flatnonzero(np.append(True, line_of_word[1:] != line_of_word[:-1]))[: len(hashes)] if len(hashes) else np.zeros(0, int)
    line_hash, line_row = np.diff(total[np.append(starts, len(hashes))]), word_row[starts]
    order = np.lexsort((line_hash, line_row))
    lh, lr = line_hash[order], line_row[order]
    fresh = np.append(True, (lh[1:] != lh[:-1]) | (lr[1:] != lr[:-1]))[: len(lh)]
    lines, distinct_lines = np.bincount(lr, minlength=n_rows), np.bincount(lr[fresh], minlength=n_rows)
    top = np.zeros(n_rows, dtype=np.int64)
    np.maximum.at(top, word_row, counts)
    echo = np.bincount(word_row[1:][(hashes[1:] == hashes[:-1]) & (word_row[1:] == word_row[:-1])], minlength=n_rows)
    letters = table[:, _LOWER] + table[:, _UPPER]
    some = np.maximum(n_words, 1)
    out = np.column_stack([
        np.where(letters >= 10, table[:, _UPPER] / np.maximum(letters, 1), np.nan),
        table[:, _BANG] / some,
        table[:, _SIGN] / np.maximum(table.sum(1), 1),
        table[:, _BAR] / some,
        np.where(n_words >= REPETITION_WORDS, distinct / some / np.minimum(1, (120 / some) ** 0.25), np.nan),
        np.where(lines >= REPETITION_LINES, distinct_lines / np.maximum(lines, 1), np.nan),
        np.where(n_wordy >= 10, np.bincount(word_row, length * wordy, n_rows) / np.maximum(n_wordy, 1), np.nan),
        np.where(n_wordy >= 10, short / np.maximum(n_wordy, 1), np.nan),
        np.where(n_words >= 30, table[:, _STOP] / some, np.nan),
        np.where(n_words >= REPETITION_WORDS, top / some, np.nan),
        np.where(n_words >= REPETITION_WORDS, echo / some, np.nan),
    ])
    return out, n_words, counts


def votes(measures: np.ndarray) -> np.ndarray:
    """0 none, 1 good, 2 junk: one row per document, one column per labeller."""
    out = np.zeros((len(measures), len(LABELLERS)), dtype=np.int64)
    for k, (_, measure, junk, good) in enumerate(LABELLERS):
        x = measures[:, MEASURES.index(measure)]
        with np.errstate(invalid="ignore"):
            high = junk > good
            out[(x >= junk) if high else (x <= junk), k] = 2
            out[(x <= good) if high else (x >= good), k] = 1
    return out


def _features(kinds, rows, n_rows, n_words, word_counts, bounds) -> np.ndarray:
    """Hashed features per row, scaled to unit length."""
    four = np.zeros(len(kinds), dtype=np.uint64)
    for j in range(4):
        shifted = np.full(len(kinds), 15, dtype=np.uint64)
        shifted[: len(kinds) - j] = np.where(rows[j:] == rows[: len(kinds) - j], kinds[j:], 15)  # not beyond the text
        four = four * np.uint64(16) + shifted
    cell = (textkernel.mix(four) % np.uint64(DIMENSIONS)).astype(np.int64)
    out = np.sqrt(np.bincount(rows * DIMENSIONS + cell, minlength=n_rows * DIMENSIONS).reshape(n_rows, DIMENSIONS).astype(np.float32))
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)
    # share of words by how often they stand in the text, and by that together with the share of the text they make up
    word_row = np.repeat(np.arange(n_rows), n_words)
    level = np.minimum(np.log2(word_counts).astype(np.int64), 14) if len(word_counts) else np.zeros(0, np.int64)
    part = np.minimum(-np.log2(word_counts / np.maximum(n_words, 1)[word_row]), 15).astype(np.int64) if len(word_counts) else level
    share = np.zeros((n_rows, DIMENSIONS))
    for code in (level + 64, part * 16 + level + 1024):
        cell = (textkernel.mix(code.astype(np.uint64) + np.uint64(1 << 20)) % np.uint64(DIMENSIONS)).astype(np.int64)
        share += np.bincount(word_row * DIMENSIONS + cell, 1.0 / np.maximum(n_words, 1)[word_row], n_rows * DIMENSIONS).reshape(n_rows, DIMENSIONS)
    return out + share.astype(np.float32)


def analysed(column):
    """(first row, votes, words, features function) for slices of an Arrow text column."""
    for first_row, data, offsets in textkernel.slices(column, max_rows=SLICE_ROWS):
        n_rows = len(offsets) - 1
        kinds = _CLASS[data]
        rows = np.repeat(np.arange(n_rows), np.diff(offsets))
        hashes, first, bounds = textkernel.words(data, offsets)
        measures, n_words, counts = _measures(kinds, rows, n_rows, hashes, first, bounds, data, offsets)
        yield first_row, votes(measures), n_words, lambda: _features(kinds, rows, n_rows, n_words, counts, bounds)


#: What is expected of a labeller before any data: share of junk votes among its votes on junk and on good texts, and the
#: weight of this expectation as a share of all documents.  It keeps the two classes from changing places.
EXPECTED_ON_JUNK, EXPECTED_ON_GOOD, EXPECTED_WEIGHT = 0.5, 0.01, 0.05


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of junk per vote pattern, and P(votes junk | votes, class) per labeller and class (good, junk).

    Expectation-maximisation; a labeller that does not vote says nothing.
    """
    weight, extra = counts.astype(float), EXPECTED_WEIGHT * counts.sum()
    bad, fine = patterns == 2, patterns == 1
    posterior = np.where(bad.any(1), 0.8, 0.05)
    rates = np.empty((patterns.shape[1], 2))
    for _ in range(rounds):
        for c, (p, expected) in enumerate(((1 - posterior, EXPECTED_ON_GOOD), (posterior, EXPECTED_ON_JUNK))):
            w = (weight * p)[:, None]
            rates[:, c] = ((bad * w).sum(0) + extra * expected) / (((bad | fine) * w).sum(0) + extra)
        rates = np.clip(rates, 1e-6, 1 - 1e-6)
        prior = min(max((weight * posterior).sum() / max(weight.sum(), 1e-9), 1e-3), 1 - 1e-3)
        odds = np.log(prior / (1 - prior)) + bad @ np.log(rates[:, 1] / rates[:, 0]) + fine @ np.log((1 - rates[:, 1]) / (1 - rates[:, 0]))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return posterior, rates


def fit(features: list[np.ndarray], target: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights (last: intercept) of a logistic scorer by gradient steps with momentum on the soft labels."""
    x = np.ones((len(features), DIMENSIONS + 1), dtype=np.float32)
    for row, own in zip(x, features):
        row[:-1] = own
    w, speed = np.zeros(x.shape[1], dtype=np.float32), np.zeros(x.shape[1], dtype=np.float32)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target).astype(np.float32) / max(len(x), 1) + np.float32(1e-5) * w
        speed = 0.9 * speed - 4.0 * slope
        w += speed
    return w


def abuse_pattern(words: Sequence[str]) -> str:
    """RE2 pattern of the whole words; it takes the character before a word, as RE2 has no lookbehind and its word boundary knows ASCII only."""
    return r"(?i)(?:^|[^\pL\pN])(?:" + "|".join(sorted(re.escape(w) for w in set(words))) + r")(?:[^\pL\pN]|$)"


def abuse(column, words: Sequence[str]) -> np.ndarray:
    """How many words of the list stand in each text."""
    if not words:
        return np.zeros(len(column), dtype=np.int32)
    # Words that follow each other must not share the character between them.
    apart = pa.compute.replace_substring_regex(pa.compute.fill_null(column, ""), r"[^\pL\pN]", "  ")
    return pa.compute.count_substring_regex(apart, abuse_pattern(words)).to_numpy(zero_copy_only=False).astype(np.int32)


def classify(docs: DataFrame, reject: float = REJECT, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
             abuse_words: Sequence[str] = ABUSE_WORDS) -> DataFrame:
    """Per document: doc_id, weak_junk (posterior of its votes), score (junk by the hashed scorer), keep, abuse (words of the list), toxic; with_text keeps the input columns instead of doc_id."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    marked = docs.select(F.xxhash64(text).alias("mark"), text.alias("text"))
    rows = max(docs.count(), 1)
    share = np.uint64(min(1.0, train_rows / rows) * (2**64 - 2**12))
    schema = pa.schema([("pattern", pa.int64()), ("n", pa.int64()), ("mark", pa.int64()), ("features", pa.binary())])
    base = 3 ** np.arange(len(LABELLERS))

    def first_pass(batches):
        given = np.zeros(0, dtype=np.int64)  # chosen texts of this task, a share of them gets through
        for batch in batches:
            marks = batch.column("mark").to_numpy()
            chosen = textkernel.mix(marks.view(np.uint64) + np.uint64(0x7F4A7C15)) <= share
            for first, vote, n_words, features in analysed(batch.column("text")):
                pattern = (vote * base).sum(1)
                kinds, n = np.unique(pattern[n_words > 0], return_counts=True)
                some = np.flatnonzero(chosen[first : first + len(vote)] & (n_words > 0))
                own, once = np.unique(marks[first + some], return_index=True)
                fresh = ~np.isin(own, given)
                some, given = some[once[fresh]], np.append(given, own[fresh])
                table = features()[some] if len(some) else []
                yield record_batch({
                    "pattern": np.concatenate([kinds, pattern[some]]), "n": [*n.tolist(), *[None] * len(some)],
                    "mark": [*[None] * len(kinds), *marks[first + some].tolist()],
                    "features": [*[None] * len(kinds), *[x.astype(np.float16).tobytes() for x in table]],
                }, schema)

    seen = materialise(marked.mapInArrow(lean(first_pass), "pattern long, n long, mark long, features binary"), "votes")
    counted = seen.where("n IS NOT NULL").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    codes = np.array([r["pattern"] for r in counted], dtype=np.int64)
    patterns = (codes[:, None] // base) % 3
    posterior, _ = estimate(patterns, np.array([r["n"] for r in counted])) if len(codes) else (np.zeros(0), None)
    known = dict(zip(codes.tolist(), posterior.tolist()))
    # Each distinct text is chosen with the probability train_rows / rows, so about train_rows are at most.
    x, target = [], []
    for r in seen.where("n IS NULL").dropDuplicates(["mark"]).sort("mark").toLocalIterator():
        x.append(np.frombuffer(r["features"], dtype=np.float16))
        target.append(known[r["pattern"]])
    weights = fit(x, np.array(target, dtype=np.float32)) if x else None
    del x
    shared = spark.sparkContext.broadcast((weights, known))

    names = docs.columns if with_text else ["doc_id"]
    added = [f for f in ("weak_junk double", "score double", "keep boolean", "abuse int", "toxic boolean")]
    entry = docs if with_text else source
    fields = [(f.name, f.dataType.simpleString()) for f in entry.schema if f.name in names and f.name not in ("weak_junk", "score", "keep", "abuse", "toxic")]

    def second_pass(batches):
        w, table = shared.value
        for batch in batches:
            weak, score, size = np.ones(len(batch)), np.ones(len(batch)), np.zeros(len(batch), dtype=np.int64)
            found = np.zeros(len(batch), dtype=np.int32)
            texts = batch.column(text_col if with_text else "text").cast(pa.string())
            for first, vote, n_words, features in analysed(texts):
                used = n_words > 0
                part = slice(first, first + len(vote))
                size[part] = n_words
                found[part] = abuse(texts.slice(first, len(vote)), abuse_words)
                weak[part] = [table.get(p, 1.0) if u else 1.0 for p, u in zip((vote * base).sum(1).tolist(), used)]
                score[part] = weak[part] if w is None else np.where(used, 1 / (1 + np.exp(-np.clip(features() @ w[:-1] + w[-1], -30, 30))), 1.0)
            toxic = (found >= ABUSE_LEAST) & (found >= ABUSE_SHARE * size)
            columns = [batch.column(n) for n, _ in fields] + [pa.array(weak), pa.array(score), pa.array(score < reject), pa.array(found), pa.array(toxic)]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields] + ["weak_junk", "score", "keep", "abuse", "toxic"])

    return entry.mapInArrow(lean(second_pass), ", ".join([f"`{n}` {t}" for n, t in fields] + added))
