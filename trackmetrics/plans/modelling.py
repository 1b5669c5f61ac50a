"""Feature tables and models."""

from pyspark.sql import Window, functions as F

from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import boosting as B
from trackmetrics.operators import features as FT
from trackmetrics.operators import models as M
from trackmetrics.operators import profiling as P
from trackmetrics.operators import ranks as K
from trackmetrics.operators import stats as S
from trackmetrics.operators import warehouse as W
from trackmetrics.operators.catalog import AUDIO, clean_catalog
from trackmetrics.plans.registry import query
from trackmetrics.session import materialise, work_folder

_LABEL = """
    WITH e AS (SELECT *, (SELECT quantile_disc(total_plays, 0.75) FROM engagement) AS p FROM engagement)"""


def features(t):
    """The labelled feature table of the whole catalogue."""
    engagement = W.engagement(t.history)
    return FT.feature_table(clean_catalog(t.catalog), engagement)


@query("ml1_label", _LABEL + """
    SELECT e.track_id, CASE WHEN total_plays >= p THEN 1 ELSE 0 END AS is_hit, round(ln(1 + total_plays), 6) AS log_total_plays,
           CASE WHEN year > 1900 THEN 2026 - year END AS age FROM e JOIN catalog c ON c.track_id = e.track_id""")
def label(t):
    rows = FT.label(clean_catalog(t.catalog).join(W.engagement(t.history), "track_id"))
    return rows.select("track_id", "is_hit", "log_total_plays", "age")


@query("ml2_feature_groups", "SELECT count(*) AS n_rows, 31 AS n_columns, count(DISTINCT artist) AS artists FROM catalog JOIN engagement USING (track_id)")
def feature_groups(t):
    table = features(t)
    return table.agg(n_rows().alias("n_rows"), F.lit(len(table.columns)).alias("n_columns"), F.count_distinct("artist").alias("artists"))


@query("ml3_leak_identity", """
    SELECT count(*) AS n, count(*) AS rebuilt FROM engagement""")
def leak_identity(t):
    """Listeners times plays per listener rebuilds the target: those columns leak."""
    return FT.identity_check(W.engagement(t.history), "unique_listeners", "plays_per_listener", "total_plays").select("n", "rebuilt")


@query("ml3_leak_correlations", _LABEL + """, f AS (SELECT unique_listeners AS u, max_playcount AS m, total_plays AS y, CASE WHEN total_plays >= p THEN 1 ELSE 0 END AS h FROM e)
    SELECT 'unique_listeners' AS variable, round(corr(u, y), 4) AS corr_total_plays, round(corr(u, h), 4) AS corr_is_hit FROM f UNION ALL
    SELECT 'max_playcount', round(corr(m, y), 4), round(corr(m, h), 4) FROM f""")
def leak_correlations(t):
    found = P.correlations(features(t), ["unique_listeners", "max_playcount"], ["total_plays", "is_hit"])
    return found.select("variable", F.round("corr_total_plays", 4).alias("corr_total_plays"), F.round("corr_is_hit", 4).alias("corr_is_hit"))


@query("ml4_missing_indicator", """
    SELECT track_id, CASE WHEN valence IS NULL THEN -1.0 ELSE valence END AS valence, CASE WHEN valence IS NULL THEN 1 ELSE 0 END AS valence_missing, energy FROM catalog""")
def missing_indicator(t):
    filled = FT.fill_missing(t.catalog.select("track_id", "valence", "energy"), ["valence", "energy"])
    return filled.select("track_id", "valence", "valence_missing", "energy")


@query("ml5_group_holdout", "SELECT count(DISTINCT p_brand) AS groups, 0 AS on_both_sides, count(*) AS n FROM part")
def group_holdout(t):
    split = M.group_holdout(t.part, "p_brand")
    sides = split.groupBy("p_brand").agg(F.count_distinct("is_test").alias("sides"), n_rows().alias("n"))
    return sides.agg(n_rows().alias("groups"), F.count_if(F.col("sides") > 1).alias("on_both_sides"), F.sum("n").alias("n"))


@query("ml6_group_folds", "SELECT count(DISTINCT p_brand) AS groups, 0 AS in_two_folds, 5 AS folds, count(*) AS n, 1 AS balanced FROM part")
def group_folds(t):
    dealt = M.group_folds(t.part, "p_brand")
    per_group = dealt.groupBy("p_brand", "fold").agg(n_rows().alias("n"))
    sizes = per_group.groupBy("fold").agg(F.sum("n").alias("n")).agg(F.max("n") <= F.lit(2) * F.min("n")).scalar()
    folds = per_group.agg(F.count_distinct("fold")).scalar()
    return per_group.groupBy("p_brand").agg(n_rows().alias("f"), F.sum("n").alias("n")).agg(
        n_rows().alias("groups"), F.count_if(F.col("f") > 1).alias("in_two_folds"), F.first(folds).alias("folds"), F.sum("n").alias("n"),
        F.first(sizes).cast("int").alias("balanced"),
    )


_X = AUDIO + ["age", "duration_min", "artist_other_titles", "artist_other_mean_plays", "artist_other_hit_rate"]


def matrix(t, name: str, filled: bool = True):
    """Feature matrix written once: every fold reads it.  Unfilled, nulls stay for imputation inside the folds and get an indicator."""
    table = materialise(features(t), f"{name}-features")
    numeric = table.select("track_id", "artist", "is_hit", "total_plays", *[F.col(c).cast("double").alias(c) for c in _X],
                           *[F.col(c).cast("double").alias(c) for c in ("nb_tags", "unique_listeners", "plays_per_listener", "loyal_ratio", "max_playcount")])
    folded = materialise(M.group_folds(numeric, "artist"), name)
    complete = FT.fill_missing(folded, _X)
    if filled:
        return complete
    return folded.withColumns({c: F.col(c.removesuffix("_missing")).isNull().cast("double") for c in complete.columns if c.endswith("_missing")})


def columns_of(df, wanted):
    return [c for c in df.columns if c in wanted or c.removesuffix("_missing") in wanted]


def indicators(df):
    return [c for c in df.columns if c.endswith("_missing")]


def results(t, rows):
    return t.spark.createDataFrame(rows, "model string, fold int, n_rows bigint, auc double, auc_pr double, threshold double")


@query("ml7_random_forest")
def random_forest(t):
    df = matrix(t, "ml7")
    x = columns_of(df, _X)
    return results(t, M.cross_validate(df, "is_hit", lambda: M.forest(x, "is_hit"), "forest"))


@query("ml8_logistic_baseline")
def logistic_baseline(t):
    df = matrix(t, "ml8", filled=False)
    return results(t, M.cross_validate(df, "is_hit", lambda: M.logistic(_X, "is_hit", indicators(df)), "logistic"))


@query("ml9_boosting_grid")
def boosting_grid(t):
    """The eight settings, leaf-wise with all their rounds, on one grouped hold-out; all held-out rows are scored."""
    df = M.group_holdout(matrix(t, "ml9"), "artist")
    x = columns_of(df, _X)
    tasks = {i: B.Task(s, ~F.col("is_test")) for i, s in enumerate(M.BOOSTING, 1)}
    models = B.load(B.fit(df, x, "is_hit", "track_id", tasks))
    scored = df.where("is_test").select("is_hit", *x)
    for i in tasks:
        scored = B.score(scored, x, models.get(i), f"score_{i}")
    scored = materialise(scored.drop(*x), "ml9-scored")
    n = scored.count()
    return results(t, [(f"boosting_{i}", 0, n, M.auc(scored, "is_hit", f"score_{i}").first()["auc"], None, None) for i in tasks])


@query("ml10_metrics", """
    WITH s AS (SELECT quality, CASE WHEN n_chars >= 2000 THEN 0.9 ELSE n_chars / 4000.0 END AS p FROM scores),
         c AS (SELECT count(*) FILTER (quality = 1 AND p >= 0.5) AS tp, count(*) FILTER (quality = 0 AND p >= 0.5) AS fp,
                      count(*) FILTER (quality = 1 AND p < 0.5) AS fn, count(*) FILTER (quality = 0 AND p < 0.5) AS tn FROM s)
    SELECT *, round((tp + tn) / (tp + fp + fn + tn), 4) AS accuracy, round(tp / (tp + fp), 4) AS "precision", round(tp / (tp + fn), 4) AS recall,
           round(2 * tp / (2 * tp + fp + fn), 4) AS f1 FROM c""")
def metrics(t):
    p = F.when(F.col("n_chars") >= 2000, 0.9).otherwise(F.col("n_chars") / 4000.0)
    return M.metrics(t.scores.withColumn("score", p), "quality")


@query("ml10_auc", """
    WITH r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2 AS x FROM scores)
    SELECT count(*) AS n, count(*) FILTER (quality = 1) AS positives, round((sum(x) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2)
           / (count(*) FILTER (quality = 1) * count(*) FILTER (quality = 0)), 6) AS auc FROM r""")
def auc(t):
    return M.auc(t.scores, "quality", "n_chars")


@query("ml11_precision_at_recall", """
    WITH c AS (SELECT n_chars, count(*) AS n, count(*) FILTER (quality = 1) AS p FROM scores GROUP BY 1),
         w AS (SELECT n_chars, sum(n) OVER (ORDER BY n_chars DESC) AS k, sum(p) OVER (ORDER BY n_chars DESC) AS tp, (SELECT sum(p) FROM c) AS pos FROM c)
    SELECT n_chars::DOUBLE AS threshold, round(tp / k, 6) AS "precision", round(tp / pos, 6) AS recall FROM w WHERE tp >= 0.75 * pos ORDER BY n_chars DESC LIMIT 1""")
def precision_at_recall(t):
    return M.precision_at_recall(t.scores, "quality", "n_chars")


@query("ml12_ablation")
def ablation(t):
    """Six feature sets on one grouped hold-out, and the candidate set on a random one."""
    df = M.group_holdout(matrix(t, "ml12"), "artist")
    context, artist = FT.GROUPS["B_context"], FT.GROUPS["C_artist"]
    sets = {
        "A_audio": AUDIO, "B_context": AUDIO + context, "C_artist": AUDIO + context + artist, "D_renown": AUDIO + context + artist + ["nb_tags"],
        "E_listeners": AUDIO + ["unique_listeners"], "F_engagement": AUDIO + FT.GROUPS["E_engagement"],
    }
    random_side = M.bucket(F.col("track_id"), M.SEED, 100) < 20
    trials = [(name, columns_of(df, wanted), F.col("is_test")) for name, wanted in sets.items()]
    trials.append(("C_artist_random_split", columns_of(df, sets["C_artist"]), random_side))

    def run(trial):
        name, x, side = trial
        return name, 0, 0, M.holdout_auc(df, "is_hit", lambda: M.forest(x, "is_hit"), side), None, None

    return results(t, M.side_by_side(run, trials))


@query("ml13_two_targets")
def two_targets(t):
    """The same features against two labels, with confounders removed in turn."""
    df = matrix(t, "ml13")
    other = t.day_facts.groupBy(F.substring("msid", 2, 20).cast("long").alias("track_id")).agg(F.sum("listeners").alias("seen"))
    targets = S.alternative_targets(df.select("track_id", "total_plays", "is_hit"), other, "seen").where("is_hit IS NOT NULL")
    joined = M.group_holdout(materialise(df.join(targets.select("track_id", "is_hit_common"), "track_id"), "ml13-targets"), "artist")
    context = AUDIO + ["age", "duration_min", "artist_other_titles"]
    sets = {"B_complete": context, "B_without_age": [c for c in context if c != "age"],
            "B_without_catalogue": [c for c in context if c != "artist_other_titles"], "age_only": ["age"]}
    trials = [(name, columns_of(joined, wanted), target) for name, wanted in sets.items() for target in ("is_hit", "is_hit_common")]

    def run(trial):
        name, x, target = trial
        return f"{name}__{target}", 0, 0, M.holdout_auc(joined, target, lambda: M.forest(x, target), F.col("is_test")), None, None

    return results(t, M.side_by_side(run, trials))


@query("ml14_published_model")
def published_model(t):
    """Best of three families at their published size by mean AUC, refitted on all rows, published with its mean threshold at the recall level and read back to score."""
    df = matrix(t, "ml14", filled=False)
    complete = FT.fill_missing(df, _X).select(*df.columns)
    x = columns_of(complete, _X)
    families = {
        "forest": (complete, lambda: M.forest(x, "is_hit")),
        "logistic": (df, lambda: M.logistic(_X, "is_hit", indicators(df))),
    }
    runs = [lambda name=name, rows=rows, make=make: M.cross_validate(rows, "is_hit", make, name) for name, (rows, make) in families.items()]
    runs.append(lambda: M.cross_validate_boosting(complete, x, "is_hit", "track_id", M.BOOSTING[0], "boosting"))
    found = [r for rows in M.side_by_side(lambda run: run(), runs) for r in rows]
    best = M.mean_auc(results(t, found)).orderBy(F.desc("mean_auc"), "model").first()
    path = work_folder(t.spark, "ml14-model")
    facts = {"model": best["model"], "features": x, "mean_auc": best["mean_auc"], "threshold": best["threshold"]}
    if best["model"] == "boosting":
        M.publish(B.fit(complete, x, "is_hit", "track_id", {0: B.Task(M.BOOSTING[0], F.lit(True))}), path, facts)
        scored = B.score(complete, x, B.load(t.spark.read.parquet(f"{path}/model"))[0])
    else:
        rows, make = families[best["model"]]
        M.publish(M.fitted(make, rows, "is_hit"), path, facts)
        scored = M.score(M.published(t.spark, path, best["model"]), rows)
    return M.metrics(scored, "is_hit", cut=best["threshold"]).withColumn("model", F.lit(best["model"]))


@query("ml15_feature_ranking")
def feature_ranking(t):
    """Rank by impurity, rank by permutation, the gap, and the direction of the effect."""
    df = matrix(t, "ml15")
    x = columns_of(df, _X)
    model = M.fitted(lambda: M.forest(x, "is_hit"), df, "is_hit")
    impurity = {f: i for i, (f, _) in enumerate(M.impurity_ranking(model, x), 1)}
    paired = materialise(M.with_donor(df, x, "track_id"), "ml15-donors")
    loss = M.permutation_ranking(model, paired, "is_hit", x)
    rows = [(f, impurity[f], i, abs(impurity[f] - i), drop) for i, (f, drop) in enumerate(loss, 1)]
    ranks = t.spark.createDataFrame(rows, "variable string, impurity_rank int, permutation_rank int, gap int, auc_loss double")
    direction = P.correlations(df, x, ["is_hit"]).select("variable", F.signum("corr_is_hit").alias("direction"))
    return ranks.join(direction, "variable")


def direction(value, contribution):
    """Pearson correlation; null when either side is constant."""
    return F.try_divide(F.covar_pop(value, contribution), F.stddev_pop(value) * F.stddev_pop(contribution))


@query("ml15_shapley")
def shapley_ranking(t):
    """Rank by mean absolute Shapley value over all rows, rank by gain, the gap, and the direction of the effect of a boosted model."""
    df = matrix(t, "ml15s")
    x = columns_of(df, _X)
    trees = B.fit(df, x, "is_hit", "track_id", {0: B.Task(M.BOOSTING[3], F.lit(True))})
    told = materialise(B.explain(df.select(*x), x, B.load(trees)[0]), "ml15s-told")
    # The contributions of a row add up to its score less the expected one.
    exact = told.agg(F.max(F.abs(F.col("raw") - F.col("base") - F.aggregate("shap", F.lit(0.0), lambda a, v: a + v))) < 1e-6).scalar()
    measured = told.agg(*[
        m.alias(f"{c}__{name}") for i, c in enumerate(x)
        for name, m in (("mean", F.avg(F.abs(F.col("shap")[i]))), ("effect", direction(F.col(c), F.col("shap")[i])))
    ])
    gains = trees.where("feature >= 0").groupBy(F.element_at(F.array(*map(F.lit, x)), F.col("feature") + 1).alias("variable")).agg(F.sum("gain").alias("gain"))
    rows = measured.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"{c}__mean").alias("mean_abs_shap"), F.col(f"{c}__effect").alias("effect")) for c in x
    ])))
    # One row per column of the model: these windows never see data rows.
    found = rows.join(gains, "variable", "left").fillna(0.0, ["gain"])
    ranked = found.select(
        "variable", F.round("mean_abs_shap", 6).alias("mean_abs_shap"), F.round("effect", 4).alias("effect"),
        F.row_number().over(Window.orderBy(F.desc("mean_abs_shap"), "variable")).alias("shap_rank"),
        F.row_number().over(Window.orderBy(F.desc("gain"), "variable")).alias("gain_rank"),
    )
    return ranked.withColumns({"gap": F.abs(F.col("gain_rank") - F.col("shap_rank")), "within_bound": exact})


_ALT = """
    WITH l AS (SELECT track_id, total_plays, CASE WHEN total_plays >= (SELECT quantile_disc(total_plays, 0.75) FROM engagement JOIN catalog USING (track_id)) THEN 1 ELSE 0 END AS is_hit
               FROM engagement JOIN catalog USING (track_id)),
         o AS (SELECT track_id, CAST(sum(qty) AS BIGINT) AS other FROM plays GROUP BY 1),
         j AS (SELECT o.track_id, total_plays, is_hit, other FROM o LEFT JOIN l ON o.track_id = l.track_id),
         q AS (SELECT *, (SELECT quantile_cont(other, 0.75) FROM j WHERE is_hit IS NOT NULL) AS a, (SELECT quantile_cont(other, 0.75) FROM j) AS b FROM j)"""


def alternative(t):
    labelled = FT.label(t.catalog.join(W.engagement(t.history), "track_id")).select("track_id", "total_plays", "is_hit")
    other = t.plays.groupBy("track_id").agg(F.sum("qty").alias("other"))
    # Both thresholds and the result read these two small tables: one row per track.
    return S.alternative_targets(materialise(labelled, "ml16-labels"), materialise(other, "ml16-other"), "other")


@query("ml16_alternative_targets", _ALT + """
    SELECT track_id, total_plays, is_hit, other, CASE WHEN is_hit IS NOT NULL THEN CASE WHEN other >= a THEN 1 ELSE 0 END END AS is_hit_common,
           CASE WHEN other >= b THEN 1 ELSE 0 END AS is_hit_found FROM q""")
def alternative_targets(t):
    return alternative(t)


@query("ml16_target_agreement", _ALT + """, c AS (SELECT count(*) FILTER (is_hit = 1 AND other >= a)::DOUBLE AS n11, count(*) FILTER (is_hit = 1 AND other < a)::DOUBLE AS n10,
         count(*) FILTER (is_hit = 0 AND other >= a)::DOUBLE AS n01, count(*) FILTER (is_hit = 0 AND other < a)::DOUBLE AS n00, count(*)::DOUBLE AS n FROM q WHERE is_hit IS NOT NULL),
         p AS (SELECT *, (n11 + n00) / n AS po, ((n11 + n10) * (n11 + n01) + (n01 + n00) * (n10 + n00)) / (n * n) AS pe FROM c)
    SELECT n11::BIGINT AS n11, n10::BIGINT AS n10, n01::BIGINT AS n01, n00::BIGINT AS n00, round(po, 4) AS observed, CASE WHEN pe < 1 THEN round((po - pe) / (1 - pe), 4) ELSE 0 END AS kappa FROM p""")
def target_agreement(t):
    common = alternative(t).where("is_hit IS NOT NULL")
    return S.contingency(common, F.col("is_hit") == 1, F.col("is_hit_common") == 1)


@query("tk4_top_correlated", """
    WITH f AS (SELECT c.*, CASE WHEN total_plays >= (SELECT quantile_disc(total_plays, 0.75) FROM engagement) THEN 1 ELSE 0 END AS h FROM catalog c JOIN engagement USING (track_id)),
         r AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS variable, round(corr({c}, h), 4) AS corr_is_hit FROM f" for c in AUDIO) + """)
    SELECT * FROM r ORDER BY abs(corr_is_hit) DESC, variable LIMIT 8""")
def top_correlated(t):
    found = P.correlations(features(t), AUDIO, ["is_hit"]).select("variable", F.round("corr_is_hit", 4).alias("corr_is_hit"))
    return found.orderBy(F.desc(F.abs("corr_is_hit")), "variable").limit(8)
