"""Sources, sinks and layout."""

import datetime

from pyspark.sql import Window, functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import contract as CT
from trackmetrics.operators import quality as Q
from trackmetrics.operators import warehouse as W
from trackmetrics.operators.catalog import CATALOG_SCHEMA, clean_catalog
from trackmetrics.operators.facts import day_facts
from trackmetrics.plans.contracts import ROUTED
from trackmetrics.plans.quality import audio_nulls, out_of_bounds
from trackmetrics.plans.registry import query
from trackmetrics.session import materialise, work_folder
from trackmetrics.sources import clustering as C
from trackmetrics.sources import layout as L
from trackmetrics.sources import readers as RD
from trackmetrics.sources.tables import register, unique_name, update_properties
from trackmetrics.sources.views import raw_json


def catalog_csv(t, name: str) -> str:
    """The catalogue written as CSV in the declared column order; tracks 0, 500, ... have a broken year."""
    path = work_folder(t.spark, name)
    columns = [f.name for f in CATALOG_SCHEMA.fields if f.name != "_corrupt_record"]
    full = t.catalog.withColumns({c: F.lit(None).cast("string") for c in columns if c not in t.catalog.columns})
    year = F.when(F.col("track_id") % 500 == 0, "unknown").otherwise(F.col("year").cast("string"))
    full.withColumn("year", year).select(columns).write.option("header", True).option("escape", '"').csv(path)
    return path


@query("src1_csv_permissive", """
    SELECT count(*) AS n, count(*) FILTER (p_partkey % 500 = 0) AS corrupt, count(*) FILTER (p_partkey % 500 <> 0) AS valid,
           CAST(sum(CASE WHEN p_partkey % 500 <> 0 AND p_size % 10 <> 0 THEN 1970 + p_size ELSE 0 END) AS BIGINT) AS years FROM part""")
def csv_permissive(t):
    read = RD.csv_permissive(t.spark, catalog_csv(t, "src1"), CATALOG_SCHEMA)
    ok = F.col("_corrupt_record").isNull()
    return read.agg(n_rows().alias("n"), F.count_if(~ok).alias("corrupt"), F.count_if(ok).alias("valid"), F.sum(F.when(ok, F.col("year"))).alias("years"))


@query("src2_csv_by_name", "SELECT CAST(user_id AS STRING) AS user_id, track_id, playcount FROM history")
def csv_by_name(t):
    path = work_folder(t.spark, "src2")
    t.history.select("playcount", "track_id", "user_id").write.option("header", True).csv(path)
    return RD.csv_by_name(t.spark, path, {"user_id": "string", "track_id": "bigint", "playcount": "int"})


@query("src3_csv_strict", "SELECT doc_id, text FROM documents")
def csv_strict(t):
    """Texts with line breaks and quotes through a strict multi-line CSV."""
    path = work_folder(t.spark, "src3")
    t.documents.select("doc_id", "text").write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = t.documents.select("doc_id", "text").schema
    return RD.csv_strict(t.spark, path + "/part-*", schema)


def raw_by_day(t, name: str) -> str:
    path = work_folder(t.spark, name)
    raw_json(t).select("date", "value").write.partitionBy("date").text(path)
    return path


@query("src4_json_partial", """
    SELECT CAST(date AS STRING) AS date, count(*) AS n, count(*) FILTER (truncated) AS rejects, count(DISTINCT user_tok) FILTER (NOT truncated) AS users FROM raw_listens GROUP BY date""")
def json_partial(t):
    path = raw_by_day(t, "src4")
    read = RD.json_partial(t.spark, path + "/date=*", "user_id string, timestamp bigint, recording_msid string", base=path)
    ok = F.col("_corrupt_record").isNull()
    return read.groupBy(F.col("date").cast("string").alias("date")).agg(
        n_rows().alias("n"), F.count_if(~ok).alias("rejects"), F.count_distinct(F.when(ok, F.col("user_id"))).alias("users"))


@query("src5_text_lines", """
    SELECT CAST(date AS STRING) AS date, msid, count(*) AS n FROM raw_listens WHERE NOT truncated GROUP BY 1, 2""")
def text_lines(t):
    path = raw_by_day(t, "src5")
    lines = RD.text_lines(t.spark, path + "/date=*", base=path).where(F.json_object_keys("value").isNotNull())
    msid = F.get_json_object("value", "$.recording_msid")
    return lines.groupBy(F.col("date").cast("string").alias("date"), msid.alias("msid")).agg(n_rows().alias("n"))


@query("src6_json_documents", """
    SELECT mois, count(*) AS listens FROM plays GROUP BY mois""")
def json_documents(t):
    """Manifests: one JSON document per year with a nested list of months, exploded."""
    path = work_folder(t.spark, "src6")
    months = t.plays.groupBy("mois").agg(n_rows().alias("listens"))
    year = F.substring("mois", 1, 4)
    # A document lists the months of one year: twelve entries.
    docs = months.groupBy(year.alias("year")).agg(F.collect_list(F.struct("mois", "listens")).alias("mois"))
    docs.repartition("year").write.option("maxRecordsPerFile", 1).json(path)
    read = RD.json_documents(t.spark, path, "year string, mois array<struct<mois: string, listens: bigint>>")
    return read.select(F.inline("mois"))


@query("src7_tsv_checked", """
    SELECT count(*) AS n, count(*) FILTER (doc_id % 10 = 3) AS bad, CAST(sum(CASE WHEN doc_id % 10 <> 3 THEN n_chars END) AS BIGINT) AS chars FROM documents""")
def tsv_checked(t):
    path = work_folder(t.spark, "src7")
    extra = F.when(F.col("doc_id") % 10 == 3, "\tsurplus").otherwise("")
    t.documents.select(F.concat(F.concat_ws("\t", F.col("doc_id").cast("string"), "lang", F.col("n_chars").cast("string")), extra).alias("value")).write.text(path)
    read = RD.tsv(t.spark, path, {"doc_id": "bigint", "lang": "string", "n_chars": "bigint"})
    return read.agg(n_rows().alias("n"), F.count_if(~F.col("ok")).alias("bad"), F.sum("n_chars").alias("chars"))


@query("src8_wide_tsv_columns", """
    SELECT 11 AS fields, count(*) AS n, count(DISTINCT l_orderkey) AS a, count(DISTINCT l_partkey) AS b FROM lineitem""")
def wide_tsv_columns(t):
    path = work_folder(t.spark, "src8")
    t.lineitem.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in t.lineitem.columns]).alias("value")).write.text(path)
    read = RD.tsv_columns(t.spark, path, {0: "a", 1: "b"})
    per_value = lambda c: read.where(F.col(c).isNotNull()).select("fields", c).distinct().groupBy("fields").agg(n_rows().alias(c))
    return read.groupBy("fields").agg(n_rows().alias("n")).join(per_value("a"), "fields", "left").join(per_value("b"), "fields", "left")


@query("src9_parquet_scan", "SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1")
def parquet_scan(t):
    return t.lineitem.groupBy("l_returnflag").agg(n_rows().alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("src10_config_document", ROUTED + "SELECT category, reason, count(*) AS n FROM p GROUP BY 1, 2")
def config_document(t):
    """A contract document written, read back whole, compiled and used on the raw lines."""
    import json

    names = {"racine": "", "tm": "$.track_metadata", "ai": "$.track_metadata.additional_info", "mm": "$.track_metadata.mbid_mapping", "artiste": None}
    document = {
        "version": 1, "interdites_toujours": sorted(CT.LISTENS.forbidden),
        "niveaux": {
            n: {"chemin": names[n], "ecartes": sorted(v.dropped), "purges": sorted(v.purged),
                "gardes": {k: {"type": f.kind, "obligatoire": f.required, **({"niveau": f.level} if f.level else {})} for k, f in v.kept.items()}}
            for n, v in CT.LISTENS.levels.items()
        },
    }
    path = work_folder(t.spark, "src10")
    t.spark.createDataFrame([(json.dumps(document, indent=1),)], "value string").coalesce(1).write.text(path)
    contract = CT.read_contract(RD.config_text(t.spark, path))
    return CT.reasons(CT.parse(raw_json(t), contract))


@query("src11_generated_range", """
    SELECT g AS event_id FROM range(0, (SELECT max(event_id) + 101 FROM events)) r(g) WHERE g NOT IN (SELECT event_id FROM events)""")
def generated_range(t):
    """Ids of a generated range that the events lack."""
    last = t.events.agg(F.max("event_id")).scalar() + 100
    ids = t.spark.range(1).select(F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("event_id"))
    return ids.join(t.events.select("event_id"), "event_id", "left_anti")


@query("src12_batch_from_path", "SELECT CAST(reception AS STRING) AS dump, count(*) AS n FROM dumps GROUP BY 1")
def batch_from_path(t):
    path = work_folder(t.spark, "src12")
    t.dumps.select("event_id", F.col("reception").cast("string").alias("dump")).hint("rebalance", F.col("dump")).write.partitionBy("dump").parquet(path)
    read = RD.with_batch(t.spark.read.option("recursiveFileLookup", True).parquet(path))
    return read.groupBy("dump").agg(n_rows().alias("n"))


@query("src13_text_partitions", """
    SELECT CAST(reception AS STRING) AS jour, count(*) AS n FROM dumps WHERE reception - date <= 30 GROUP BY 1 UNION ALL
    SELECT '_ancien', count(*) FROM dumps WHERE reception - date > 30""")
def text_partitions(t):
    """Partition values stay text: a day beside ``_ancien``."""
    path = work_folder(t.spark, "src13")
    late = F.datediff("reception", "date") > 30
    jour = F.when(late, "_ancien").otherwise(F.col("reception").cast("string"))
    t.dumps.select("event_id", jour.alias("jour")).hint("rebalance", F.col("jour")).write.partitionBy("jour").parquet(path)
    return L.read_partitioned(t.spark, path).groupBy("jour").agg(n_rows().alias("n"))


@query("src14_external_table", """
    SELECT mois, count(*) AS n, CAST(sum(listens) AS BIGINT) AS listens FROM day_facts WHERE mois >= '2000-01' GROUP BY mois""")
def external_table(t):
    path = work_folder(t.spark, "src14")
    t.day_facts.hint("rebalance", F.col("mois")).write.partitionBy("mois").parquet(path)
    table = t.spark.table(register(t.spark, unique_name("src14_facts"), path, "Facts by month", {}, ["mois"]))
    return table.where("mois >= '2000-01'").groupBy("mois").agg(n_rows().alias("n"), F.sum("listens").alias("listens"))


# -- sinks ---------------------------------------------------------------------------


@query("snk1_codecs", """
    SELECT 'snappy' AS codec, count(*) AS n FROM history UNION ALL SELECT 'zstd', count(*) FROM history""")
def codecs(t):
    out = []
    for codec in ("snappy", "zstd"):
        path = work_folder(t.spark, "snk1")
        t.history.write.mode("overwrite").option("compression", codec).parquet(path)
        stored = t.spark.read.parquet(path)
        named = F.regexp_extract("_metadata.file_path", r"\.(snappy|zstd)\.parquet$", 1)
        out.append(stored.groupBy(named.alias("codec")).agg(n_rows().alias("n")))
    return Q.union(*out)


@query("snk2_packed_output", "SELECT 2 AS files, count(*) AS n FROM catalog")
def packed_output(t):
    """A small table packed in two files without a shuffle of its last step."""
    path = work_folder(t.spark, "snk2")
    clean_catalog(t.catalog).repartition(4).coalesce(2).write.parquet(path)
    return L.file_report(t.spark.read.parquet(path)).select("files", F.col("n_rows").alias("n"))


@query("snk3_balanced_output", "SELECT 12 AS files, count(*) AS n, 1 AS balanced FROM history")
def balanced_output(t):
    path = work_folder(t.spark, "snk3")
    t.history.repartition(12).write.parquet(path)
    report = L.file_report(t.spark.read.parquet(path))
    return report.select("files", F.col("n_rows").alias("n"), (F.col("largest") < 2 * F.col("smallest")).cast("int").alias("balanced"))


@query("snk4_partitioned_write", "SELECT mois, count(*) AS n FROM day_facts GROUP BY mois")
def partitioned_write(t):
    path = work_folder(t.spark, "snk4")
    L.write_rebalanced(t.day_facts, path, ["mois"])
    return L.read_partitioned(t.spark, path).groupBy("mois").agg(n_rows().alias("n"))


@query("snk5_partition_replacement", """
    SELECT mois, count(*) AS n, CAST(sum(CASE WHEN mois = '2001-07' THEN listens * 2 ELSE listens END) AS BIGINT) AS listens FROM day_facts GROUP BY mois""")
def partition_replacement(t):
    """Writing one month again, twice, replaces that month and nothing else."""
    path = work_folder(t.spark, "snk5")
    L.write_rebalanced(t.day_facts, path, ["mois"])
    doubled = t.day_facts.where("mois = '2001-07'").withColumn("listens", F.col("listens") * 2)
    for _ in range(2):
        L.write_rebalanced(doubled, path, ["mois"])
    return L.read_partitioned(t.spark, path).groupBy("mois").agg(n_rows().alias("n"), F.sum("listens").alias("listens"))


@query("snk6_file_plan", """
    WITH p AS (SELECT mois, CAST(greatest(1, ceil(count(*) * 43.8 / 16384)) AS INT) AS planned, count(*) AS n FROM day_facts GROUP BY mois)
    SELECT mois, planned, n, 0 AS beyond_plan FROM p""")
def planned_files(t):
    """Files per partition follow the plan; a partition beyond its plan would show."""
    path = work_folder(t.spark, "snk6")
    facts = materialise(t.day_facts, "snk6-facts")
    L.write_planned(facts, path, ["mois"], ["msid", "date"], row_bytes=43.8, target_bytes=16384)
    plan = L.file_plan(facts, ["mois"], 43.8, 16384).withColumnRenamed("files", "planned")
    report = L.file_report(L.read_partitioned(t.spark, path), r"mois=([^/]+)")
    joined = plan.join(report, F.col("mois") == F.col("part"))
    return joined.select("mois", "planned", F.col("n_rows").alias("n"), (F.col("files") > F.col("planned")).cast("int").alias("beyond_plan"))


@query("snk7_shuffle_width", "SELECT greatest(48, CAST(ceil(count(*) * 80 / 134217728.0) AS INT)) AS width, count(*) AS n FROM plays")
def shuffle_width(t):
    """Explicit shuffle width from the volume, as an option beside adaptive sizing."""
    return t.plays.agg(n_rows().alias("n")).select(L.shuffle_width(F.col("n")).alias("width"), "n")


@query("snk8_rows_per_file", "SELECT count(*) AS n, 1 AS within_cap, 1 AS enough_files FROM history")
def rows_per_file(t):
    path = work_folder(t.spark, "snk8")
    t.history.write.option("maxRecordsPerFile", 10000).parquet(path)
    files = t.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(n_rows().alias("n"))
    return files.agg(F.sum("n").alias("n"), (F.max("n") <= 10000).cast("int").alias("within_cap"),
                     (n_rows() * 10000 >= F.sum("n")).cast("int").alias("enough_files"))


@query("snk9_sliced_processing", "SELECT CAST(date AS STRING) AS date, concat('m', CAST(track_id AS STRING)) AS msid, count(*) AS n FROM plays GROUP BY 1, 2")
def sliced_processing(t):
    """Month slices written one after the other, to bound the shuffle of each: same result as one pass."""
    path = work_folder(t.spark, "snk9")
    months = t.plays.groupBy("mois").agg(n_rows().alias("n"))
    total = months.agg(F.sum("n")).first()[0]
    plan = L.slices(months, "mois", "n", int(total // 3)).orderBy("no").collect()  # a few slices of calendar months
    for i, s in enumerate(plan):
        part = t.plays.where(F.col("mois").between(s["first"], s["last"]))
        facts = part.groupBy("date", F.concat(F.lit("m"), F.col("track_id").cast("string")).alias("msid")).agg(n_rows().alias("n"))
        facts.write.mode("append" if i else "overwrite").parquet(path)
    return t.spark.read.parquet(path).select(F.col("date").cast("string").alias("date"), "msid", "n")


@query("snk10_slice_planner", """
    SELECT * FROM (
        WITH RECURSIVE m AS (SELECT row_number() OVER (ORDER BY mois) AS i, mois, count(*) AS n FROM plays GROUP BY mois),
             t AS (SELECT count(*) // 7 AS target FROM plays),
             s AS (SELECT i, mois, n, 1 AS no, n AS total FROM m WHERE i = 1
                   UNION ALL
                   SELECT m.i, m.mois, m.n, CASE WHEN total + m.n > target THEN no + 1 ELSE no END, CASE WHEN total + m.n > target THEN m.n ELSE total + m.n END
                   FROM s JOIN m ON m.i = s.i + 1 CROSS JOIN t)
        SELECT no, min(mois) AS first, max(mois) AS last, CAST(sum(n) AS BIGINT) AS n, count(*) AS lots FROM s GROUP BY no) AS x""")
def slice_planner(t):
    months = t.plays.groupBy("mois").agg(n_rows().alias("n"))
    target = t.plays.agg(F.floor(n_rows() / 7)).first()[0]
    return L.slices(months, "mois", "n", int(target))


@query("snk11_reject_archive", """
    SELECT 'rejects' AS what, count(*) AS n FROM part WHERE p_partkey % 500 = 0 UNION ALL SELECT 'kept', count(*) FROM part WHERE p_partkey % 500 <> 0""")
def reject_archive(t):
    """Unreadable CSV lines archived as text, the others kept; nothing is dropped."""
    # Parsed once into a stage, then split: the parser does not run per output.
    read = materialise(RD.csv_permissive(t.spark, catalog_csv(t, "snk11"), CATALOG_SCHEMA), "snk11-stage")
    kept, rejects = work_folder(t.spark, "snk11-kept"), work_folder(t.spark, "snk11-rejects")
    read.where(F.col("_corrupt_record").isNotNull()).select("_corrupt_record").write.text(rejects)
    read.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record").write.parquet(kept)
    return t.spark.read.text(rejects).agg(F.lit("rejects").alias("what"), n_rows().alias("n")).unionByName(
        t.spark.read.parquet(kept).agg(F.lit("kept").alias("what"), n_rows().alias("n")))


@query("snk12_json_report", """
    WITH c AS (SELECT count(*) AS n, count(DISTINCT track_id) AS d, {nulls} AS nulls, {outside} AS outside, 100.0 * count(*) FILTER (genre IS NULL) / count(*) AS g FROM catalog),
         f AS (SELECT unnest([n < 150, d < n, nulls > 0, outside > 0, g > 60, FALSE]) AS failed FROM c)
    SELECT count(*) AS checks, count(*) FILTER (failed) AS failed FROM f""".format(nulls=audio_nulls, outside=out_of_bounds))
def json_report(t):
    """Gate report over the catalogue as it is, written as JSON and read back."""
    path = work_folder(t.spark, "snk12")
    Q.run(t.catalog, list(Q.catalog_checks(150).values())).coalesce(1).write.json(path)
    return t.spark.read.json(path).agg(n_rows().alias("checks"), F.count_if(F.col("ok") == 0).alias("failed"))


@query("snk13_csv_with_header", "SELECT CAST(date AS STRING) AS day, count(*) AS touched FROM raw_listens WHERE has_ip GROUP BY 1")
def csv_with_header(t):
    from trackmetrics.operators.privacy import key_scan

    path = work_folder(t.spark, "snk13")
    scan = key_scan(raw_json(t), ["ip_addr"]).where("touched > 0").select(F.col("date").cast("string").alias("day"), "touched")
    scan.coalesce(1).write.option("header", True).csv(path)
    return RD.csv_by_name(t.spark, path, {"day": "string", "touched": "bigint"})


@query("snk14_catalog_registration")
def catalog_registration(t):
    """Register a table with a comment and properties, update them, read both back."""
    path = work_folder(t.spark, "snk14")
    W.engagement(t.history).write.parquet(path)
    name = register(t.spark, unique_name("snk14_engagement"), path, "Plays and listeners per track", {"licence": "test", "donnees_personnelles": "non"})
    update_properties(t.spark, name, {"usage": "analyse"})
    stored = t.spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key").isin("licence", "usage", "donnees_personnelles"))
    return stored.withColumn("n", t.spark.table(name).agg(n_rows()).scalar())


@query("snk15_sorted_export", "SELECT count(*) AS n, 0 AS unsorted FROM (SELECT DISTINCT artist FROM catalog JOIN engagement USING (track_id)) AS a")
def sorted_export(t):
    """Globally sorted export: files in name order hold descending ranges, each sorted inside."""
    path = work_folder(t.spark, "snk15")
    L.sorted_export(W.artist_reference(t.catalog, t.history), path, [F.desc("plays"), F.col("artist")])
    stored = t.spark.read.parquet(path)
    row = stored.select("plays", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("at"))
    up = (F.col("plays") > F.lag("plays").over(Window.partitionBy("f").orderBy("at"))).cast("int")
    files = row.withColumn("up", up).groupBy("f").agg(n_rows().alias("n"), F.sum("up").alias("up"), F.max("plays").alias("hi"), F.min("plays").alias("lo"))
    # One row per file from here on.
    gap = (F.col("hi") > F.lag("lo").over(Window.orderBy("f"))).cast("int")
    return files.withColumn("gap", gap).agg(F.sum("n").alias("n"), (F.coalesce(F.sum("up"), F.lit(0)) + F.coalesce(F.sum("gap"), F.lit(0))).alias("unsorted"))


@query("snk16_full_reload", """
    SELECT 'dim_track' AS loaded, count(*) AS n, 1 AS ok FROM catalog UNION ALL SELECT 'fact_listening', count(*), 1 FROM history""")
def full_reload(t):
    """Overwrite two tables and count them; an empty one fails the load."""
    base = work_folder(t.spark, "snk16")
    return L.full_reload({"dim_track": t.catalog, "fact_listening": t.history}, base)


@query("snk17_stage_and_reread", "SELECT count(*) AS n, CAST(sum(total_plays) AS BIGINT) AS plays FROM engagement")
def stage_and_reread(t):
    stored = materialise(W.engagement(t.history), "snk17")
    return stored.agg(n_rows().alias("n"), F.sum("total_plays").alias("plays"))


@query("snk18_size_report")
def size_report(t):
    path = work_folder(t.spark, "snk18")
    L.write_rebalanced(t.day_facts, path, ["mois"])
    return L.file_report(L.read_partitioned(t.spark, path), r"mois=([^/]+)")


@query("snk19_path_audit", """
    SELECT CASE WHEN event_id % 29 = 0 THEN 'REFUSE' WHEN event_id % 2 = 0 THEN 'ecoutes' ELSE 'aplati' END AS class, count(*) AS n FROM listens GROUP BY 1""")
def path_audit(t):
    """Object paths derived from the listens; a few carry an impossible date."""
    bad, even = F.col("event_id") % 29 == 0, F.col("event_id") % 2 == 0
    path = F.concat(
        F.when(even, "listens/date=").otherwise("flat/mois="),
        F.when(bad & even, "2024-02-31").when(bad, "2024-13").when(even, F.col("date").cast("string")).otherwise(F.col("mois")),
        F.lit("/part-"), F.col("event_id").cast("string"), F.lit(".parquet"),
    )
    rules = {"ecoutes": r"^listens/date=(\d{4}-\d{2}-\d{2})/[^/]+$", "aplati": r"^flat/mois=(\d{4}-\d{2})/[^/]+$"}
    return L.path_audit(t.listens.select(path.alias("path")), "path", rules).groupBy("class").agg(n_rows().alias("n"))


@query("tk7_storage_order_probe")
def storage_order_probe(t):
    """Date spread of each stored file, range-written against hash-written: range files can be skipped."""
    out = []
    for name, df in (("range", t.day_facts.repartitionByRange(6, "date").sortWithinPartitions("date")), ("hash", t.day_facts.repartition(6, "msid"))):
        path = work_folder(t.spark, "tk7")
        df.write.parquet(path)
        probe = L.order_probe(t.spark.read.parquet(path), "date")
        out.append(probe.agg(F.lit(name).alias("layout"), n_rows().alias("files"), F.sum("n").alias("n"), F.round(F.avg(F.datediff("highest", "lowest")), 1).alias("avg_days")))
    return out[0].unionByName(out[1])


# Half-open ranges of the box queries: a month of days, a range of titles, and both.
_DAYS, _TITLES = ("1996-06-01", "1996-07-01"), (20, 60)


def written_plays(t, name: str, arrange):
    """Path of the plays written in some order, with their numeric title."""
    path = work_folder(t.spark, name)
    arrange(t.plays.select("date", "track_id", "user_id", "qty")).write.parquet(path)
    return path


@query("prj21_box_on_curve", f"""
    SELECT count(*) AS n, CAST(sum(qty) AS BIGINT) AS plays, count(DISTINCT track_id) AS titles FROM plays
    WHERE date >= DATE '{_DAYS[0]}' AND date < DATE '{_DAYS[1]}' AND track_id >= {_TITLES[0]} AND track_id < {_TITLES[1]}""")
def box_on_curve(t):
    """A box of days and titles, read from a table stored along a curve over both."""
    stored = t.spark.read.parquet(written_plays(t, "prj21", lambda df: C.clustered(df, ["date", "track_id"], 32)))
    day = F.col("date")
    inside = (day >= F.lit(_DAYS[0]).cast("date")) & (day < F.lit(_DAYS[1]).cast("date")) & (F.col("track_id") >= _TITLES[0]) & (F.col("track_id") < _TITLES[1])
    picked = stored.where(inside)
    return picked.agg(n_rows().alias("n"), F.sum("qty").alias("plays"), F.count_distinct("track_id").alias("titles"))


@query("tk7_files_touched")
def files_touched(t):
    """Files a box query must open, by layout: hash, range by day, and the curve over day and title."""
    day = tuple(datetime.date.fromisoformat(d) for d in _DAYS)
    boxes = {"days": {"date": day}, "titles": {"track_id": _TITLES}, "both": {"date": day, "track_id": _TITLES}}
    layouts = {
        "hash": lambda df: df.repartition(32, "user_id"),
        "range": lambda df: df.repartitionByRange(32, "date", "track_id"),
        "curve": lambda df: C.clustered(df, ["date", "track_id"], 32),
    }
    found = [
        C.touched(C.file_ranges(t.spark.read.parquet(written_plays(t, "tk7", arrange)), ["date", "track_id"]), boxes).withColumn("layout", F.lit(name))
        for name, arrange in layouts.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])
