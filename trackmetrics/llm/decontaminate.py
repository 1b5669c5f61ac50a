"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item is cut into windows of ``WINDOW`` consecutive words (a shorter item is
one window), and a window into overlapping shingles of up to ``SHINGLE`` words.
A document holds a window only if it holds every shingle of it, so one shingle per
window is enough as the necessary prefix: the one with the fewest hits over all
documents.  Hits of these prefixes, kept within the document by the positional and length bounds, are
the candidates; a candidate counts when the shingles that cover the window all occur at
their places, compared word by word.

Null and empty texts have no words and no hits; repeated rows each get their
own result; items without words are ignored; repeated items count once per item_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackmetrics.llm.common import broadcast_if_small
from trackmetrics.operators.bloom import may_hold
from trackmetrics.session import materialise

WINDOW = 13
SHINGLE = 4
#: A document is contaminated when at least one in so many of its words is hit.
SHARE = 20
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, with A-Z (and no other letter) in lower case."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )
    return F.array_remove(F.split(lowered, _SPLIT), "")


def _windows(benchmark: DataFrame, item: str, text: str, window: int, shingle: int) -> DataFrame:
    """One row (item, win, len, k) per distinct window of an item; ``win`` is the array of its words."""
    per_item = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("w") - length + 1)
    cut = per_item.select("item", "w", length.alias("len"), F.explode_outer(starts).alias("s"))
    return cut.select(
        "item", F.expr("slice(w, s, len)").alias("win"), "len", F.least("len", F.lit(shingle)).alias("k")
    ).distinct()


def _hits(docs: DataFrame, id_col: str, text: str, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """Every place where a document holds a shingle of the benchmark, and one row with pos = -1 per document."""
    w, at = F.col("__w"), F.col("__i")
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), words(F.col(text)).alias("__w"))
    hashes, size, place = [F.array(F.lit(None).cast("long"))], F.lit(-1), F.lit(-1)
    first = F.lit(1)  # index of the first shingle of this size; 0 is the document's own row
    for k in sizes:
        n = F.greatest(F.size(w) - k + 1, F.lit(0))
        steps = f"if(size(__w) >= {k}, sequence(0, size(__w) - {k}), CAST(array() AS array<int>))"
        hashes.append(F.expr(f"transform({steps}, i -> xxhash64({k}, {', '.join(f'__w[i + {j}]' for j in range(k))}))"))
        inside = (at >= first) & (at < first + n)
        size, place = F.when(inside, F.lit(k)).otherwise(size), F.when(inside, at - first).otherwise(place)
        first = first + n
    flat = base.select("rid", "doc_id", "__w", F.posexplode_outer(F.concat(*hashes)).alias("__i", "h"))
    placed = flat.select("rid", "doc_id", F.size(w).alias("n_words"), "__w", "h", size.alias("__k"), place.alias("pos"))
    same = F.expr("slice(__w, pos + 1, __k)") == F.col("words")
    small = broadcast_if_small(shingles, width=F.octet_length(F.array_join("words", " ")))
    if small is shingles:
        # Too large to broadcast: places that a filter of the shingles lets through are shuffled, each with its own few words; the row
        # of the document itself has no hash and passes with the null key.
        no_hash = shingles.sparkSession.range(1).select(F.lit(None).cast("long").alias("h"))
        placed = may_hold(placed, shingles.select("h").distinct().unionByName(no_hash), ["h"])
        placed = placed.withColumn("__own", F.when(F.col("pos") >= 0, F.expr("slice(__w, pos + 1, __k)"))).drop("__w")
        same = F.col("__own") == F.col("words")
    found = placed.join(small, "h", "left")
    return found.where((F.col("pos") < 0) | same).select("rid", "doc_id", "n_words", "pos", "shingle")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    share: int = SHARE,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted strings), items_sha256, contaminated."""
    cut = materialise(_windows(benchmark, item_col, item_text_col, window, shingle), "windows")
    windows = cut.groupBy("win", "len", "k").agg(F.count(F.lit(1)).alias("n")).drop("n")
    windows = materialise(windows.withColumn("window", F.monotonically_increasing_id()), "windows")
    owners = cut.join(windows, ["win", "len", "k"]).select("window", "item")
    sizes = sorted(r["k"] for r in windows.select("k").distinct().collect())  # at most `shingle` values
    parts = windows.select(
        "window", "len", "k", F.explode_outer(F.expr("transform(sequence(0, len - k), i -> struct(i AS off, slice(win, i + 1, k) AS words))")).alias("p")
    ).select("window", "len", "k", "p.off", "p.words")
    shingles = parts.select("k", "words").distinct()
    key = F.xxhash64("k", *[F.expr(f"get(words, {j})") for j in range(shingle)])
    shingles = materialise(shingles.select(key.alias("h"), "words", F.monotonically_increasing_id().alias("shingle")), "shingles")
    parts = materialise(parts.join(shingles, "words").select("window", "len", "k", "off", "shingle"), "parts")

    hits = materialise(_hits(docs, id_col, text_col, shingles, sizes), "hits")
    found = hits.where("pos >= 0").select("rid", "n_words", "pos", "shingle")

    counts = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("hits"))
    ranked = parts.join(broadcast_if_small(counts), "shingle", "left").groupBy("window", "len", "k").agg(
        F.min(F.coalesce("hits", F.lit(0))).alias("fewest"), F.min(F.struct("hits", "shingle", "off")).alias("rarest")
    )
    prefix = ranked.where("fewest > 0").select("window", "len", "k", "rarest.shingle", "rarest.off")
    # Shingles at these offsets cover the window without gaps.
    cover = F.expr("transform(sequence(0, CAST(ceil(len / k) AS INT) - 1), j -> least(j * k, len - k))")
    wanted = prefix.select("window", "len", "k", F.explode_outer(F.array_distinct(cover)).alias("off")).join(
        parts.select("window", "off", F.col("shingle").alias("part")), ["window", "off"]
    ).groupBy("window").agg(F.collect_list(F.struct("off", "part")).alias("cover"))
    prefix = broadcast_if_small(materialise(prefix.join(wanted, "window"), "prefix"))
    start = F.col("pos") - F.col("off")
    candidates = found.join(prefix, "shingle").where((start >= 0) & (start + F.col("len") <= F.col("n_words"))).select(
        "rid", start.alias("start"), "len", "window", F.size("cover").alias("needed"), F.explode_outer("cover").alias("c")
    ).select("rid", "start", "len", "window", "needed", (F.col("start") + F.col("c.off")).alias("pos"), F.col("c.part").alias("shingle"))
    held = candidates.join(found.select("rid", "pos", "shingle"), ["rid", "pos", "shingle"])
    occurs = held.groupBy("rid", "start", "len", "window", "needed").agg(F.count(F.lit(1)).alias("n")).where("n = needed")
    occurs = materialise(occurs.select("rid", "start", "len", "window"), "occurrences")

    spans = occurs.select("rid", "start", (F.col("start") + F.col("len")).alias("stop")).groupBy("rid", "start").agg(F.max("stop").alias("stop"))
    before = Window.partitionBy("rid").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0)))
    hit = spans.select("rid", F.greatest(new, F.lit(0)).alias("n")).groupBy("rid").agg(F.sum("n").alias("n_hit"))
    items = occurs.select("rid", "window").join(broadcast_if_small(owners), "window").select("rid", "item").distinct()
    items = items.groupBy("rid").agg(
        F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items")
    )
    n_hit, n_words = F.coalesce("n_hit", F.lit(0)).cast("long"), F.col("n_words").cast("long")
    held_items = F.coalesce("items", F.array().cast("array<string>"))
    return hits.where("pos < 0").join(hit, "rid", "left").join(items, "rid", "left").select(
        "doc_id",
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        held_items.alias("items"),
        F.sha2(F.concat_ws(",", held_items), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= n_words)).alias("contaminated"),
    )
