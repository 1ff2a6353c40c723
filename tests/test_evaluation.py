import math

import numpy as np
import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from cohortlens.evaluation import curves, metrics
from cohortlens.evaluation.running import hash_index, running_totals
from cohortlens.operators import labels


def scores(spark, data, extra=""):
    return spark.createDataFrame(data, "score double, label int" + extra)


def brute_auroc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_points(pairs):
    out = []
    for t in sorted({s for s, _ in pairs}, reverse=True):
        out.append((t, sum(y == 1 for s, y in pairs if s >= t), sum(y == 0 for s, y in pairs if s >= t)))
    return out


def random_pairs(n, levels, seed):
    rng = np.random.default_rng(seed)
    return [(float(rng.integers(levels)) / levels, int(rng.random() < 0.3)) for _ in range(n)]


@pytest.mark.parametrize("levels", [1, 5, 1000])
def test_curve_and_areas_against_brute_force(spark, levels):
    pairs = random_pairs(300, levels, levels)
    curve = curves.score_curve(scores(spark, pairs), "score", "label")
    got = sorted(((r.threshold, r.tp, r.fp) for r in curve.collect()), reverse=True)
    assert got == brute_points(pairs)
    area = curves.areas(curve).first()
    assert abs(area.auroc - brute_auroc(pairs)) < 1e-12
    p = sum(y for _, y in pairs)
    recall, precision = [0.0], [1.0]
    for _, tp, fp in brute_points(pairs):
        recall.append(tp / p)
        precision.append(tp / (tp + fp))
    trapezoid = sum((recall[i] - recall[i - 1]) * (precision[i] + precision[i - 1]) / 2 for i in range(1, len(recall)))
    assert abs(area.auprc - trapezoid) < 1e-12
    # turning the score around turns the area around
    back = curves.areas(curves.score_curve(scores(spark, [(-s, y) for s, y in pairs]), "score", "label")).first()
    assert abs(area.auroc + back.auroc - 1) < 1e-12


def test_perfect_and_one_class(spark):
    perfect = curves.areas(curves.score_curve(scores(spark, [(0.9, 1), (0.8, 1), (0.1, 0)]), "score", "label")).first()
    assert (perfect.auroc, perfect.auprc) == (1.0, 1.0)
    one = curves.areas(curves.score_curve(scores(spark, [(0.9, 0), (0.8, 0)]), "score", "label")).first()
    assert one.auroc is None and one.auprc is None


def test_points_start(spark):
    curve = curves.score_curve(scores(spark, [(0.9, 1), (0.5, 0), (0.5, 1)]), "score", "label")
    assert rows(curves.roc_points(curve)) == [(0.5, 1.0, 1.0), (0.9, 0.0, 0.5), (None, 0.0, 0.0)]
    assert rows(curves.pr_points(curve)) == [(0.5, 1.0, 2 / 3), (0.9, 0.5, 1.0), (None, 0.0, 1.0)]


def test_collinear_points_go(spark):
    pairs = [(0.9, 1), (0.8, 1), (0.7, 1), (0.6, 0), (0.5, 0), (0.4, 1)]
    curve = curves.score_curve(scores(spark, pairs), "score", "label")
    kept = [r.threshold for r in curves.roc_points(curve, drop_collinear=True).collect() if r.threshold]
    assert sorted(kept) == [0.4, 0.5, 0.7, 0.9]


def test_running_totals_over_several_ranges(spark):
    """One group holds a third of the rows and is cut into several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = spark.range(3000).select(
            F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 20).alias("g"), F.col("id").cast("double").alias("o"),
            (F.col("id") % 5).alias("v"),
        )
        got = running_totals(df, ["g"], "o", ["v"])
        data = sorted(((r.g, -r.o, r.v) for r in df.collect()))
        want, total, last = {}, 0, None
        for g, o, v in data:
            total = v if g != last else total + v
            last = g
            want[(g, -o)] = total
        assert {(r.g, r.o): r.cum_v for r in got.collect()} == want
        following = {(g, -o): (w[2] if w and w[0] == g else None) for (g, o, _), w in zip(data, [*data[1:], None])}
        assert {(r.g, r.o): r.next_v for r in got.collect()} == following
        assert all(r.all_v == max(w for (g, _), w in want.items() if g == r.g) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hash_index_is_dense_and_stable(spark):
    df = spark.range(997).withColumnRenamed("id", "k")
    one = {r.k: r.idx for r in hash_index(df, ["k"], 5).collect()}
    two = {r.k: r.idx for r in hash_index(df.repartition(9), ["k"], 5).collect()}
    assert one == two and sorted(one.values()) == list(range(997))


def test_runs_cover_a_wide_range(spark):
    """Scores up to 3e6 at a step of 0.0005: six billion thresholds, as many rows as scores at most."""
    pairs = [(0.0, 0), (0.0004, 1), (0.25, 0), (1234.5678, 1), (2_999_999.9, 0), (3e6, 1)]
    step = 0.0005
    got = curves.threshold_runs(scores(spark, pairs), "score", "label", step).orderBy("threshold").collect()
    assert len(got) <= len(pairs) and got[0].threshold == 0.0
    for r, after in zip(got, [*got[1:], None]):
        for t in (r.threshold, (r.threshold + r.until) / 2, r.until):
            assert r.tp == sum(y == 1 and s >= t - 1e-9 for s, y in pairs)
            assert r.fp == sum(y == 0 and s >= t - 1e-9 for s, y in pairs)
        assert after is None or after.threshold == pytest.approx(r.until + step, abs=1e-6)


def test_runs_are_the_sweep(spark):
    pairs = [(((i * 37) % 101) / 17, (i * 13) % 3 % 2) for i in range(90)]
    df = scores(spark, pairs)
    sweep = curves.threshold_sweep(df, "score", "label", 0.01)
    runs = curves.threshold_runs(df, "score", "label", 0.01).collect()
    for r in sweep.collect():
        (run,) = [x for x in runs if x.threshold - 1e-9 <= r.threshold <= x.until + 1e-9]
        assert (r.tp, r.fp) == (run.tp, run.fp)
    best = curves.best_threshold(sweep).first()
    assert curves.best_threshold(curves.threshold_runs(df, "score", "label", 0.01)).first() == best


def test_grid_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(curves, "_BLOCK", 7)
    df = scores(spark, [(0.0, 0), (0.3, 1), (1.0, 1)])
    assert curves.threshold_sweep(df, "score", "label", 0.01).count() == 101


def test_sweep_against_brute_force(spark):
    pairs = random_pairs(400, 321, 3)
    lo, hi = min(s for s, _ in pairs), max(s for s, _ in pairs)
    step = 0.01
    got = {round(r.threshold, 9): (r.tp, r.fp) for r in curves.threshold_sweep(scores(spark, pairs), "score", "label", step).collect()}
    for k in range(int(math.floor((hi - lo) / step + 1e-10)) + 1):
        t = lo + k * step
        want = (sum(y == 1 for s, y in pairs if s >= t), sum(y == 0 for s, y in pairs if s >= t))
        assert got.pop(round(t, 9)) == want
    assert not got


def test_ties_take_lowest_threshold(spark):
    df = scores(spark, [(0.9, 1), (0.5, 0), (0.3, 0), (0.2, 1), (0.1, 0)])
    best = curves.best_f1(curves.score_curve(df, "score", "label")).first()
    assert (best.threshold, best.max_f1) == (0.9, 2 / 3) or best.threshold == 0.2
    assert best.threshold == 0.2 and abs(best.max_f1 - 2 / 3) < 1e-12
    none = curves.best_f1(curves.score_curve(scores(spark, [(0.9, 0)]), "score", "label")).first()
    assert none.max_f1 == 0.0


def test_binarise_strictness_and_scaling(spark):
    df = scores(spark, [(0.5, 1), (0.7, 0)])
    assert [r.predict for r in curves.binarise(df, "score", 0.5).orderBy("score").collect()] == [1, 1]
    assert [r.predict for r in curves.binarise(df, "score", 0.5, strict=True).orderBy("score").collect()] == [0, 1]
    assert sorted(r.score for r in curves.min_max_scale(df, "score").collect()) == [0.0, 1.0]
    flat = curves.min_max_scale(scores(spark, [(2.0, 1), (2.0, 0)]), "score")
    assert [r.score for r in flat.collect()] == [0.0, 0.0]


def test_confusion_guards(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, predict int")
    got = metrics.confusion(df, "label", "predict").withColumns({**metrics.rates(), "ll": metrics.hard_log_loss()}).first()
    assert (got.tn, got.fp, got.fn, got.tp) == (1, 0, 1, 0)
    assert (got.precision, got.recall, got.f1, got.accuracy) == (0.0, 0.0, 0.0, 0.5)
    assert abs(got.ll - 36.04365338911715 / 2) < 1e-9
    unset = metrics.confusion(df, "label", "predict").withColumns(metrics.rates(None)).first()
    assert unset.precision is None


def test_best_f1_board_equals_row_based(spark):
    pairs = [(s, y, k % 2) for k, (s, y) in enumerate(random_pairs(200, 50, 8))]
    df = scores(spark, pairs, ", g int")
    board = {r.g: r for r in metrics.best_f1_board(df, "score", "label", ["g"]).collect()}
    scaled = curves.min_max_scale(df, "score", ["g"])
    best = curves.best_f1(curves.score_curve(scaled, "score", "label", ["g"]), ["g"])
    hard = curves.binarise(curves.attach_by_key(scaled, best, ["g"]), "score", "threshold", strict=True)
    for r in metrics.metric_board(hard, "score", "label", "predict", ["g"]).collect():
        for c in ("tn", "fp", "fn", "tp", "precision", "recall", "f1", "accuracy", "logloss", "auroc", "auprc"):
            assert abs(r[c] - board[r.g][c]) < 1e-12


def test_fairness(spark):
    data = [("a", 1, 1), ("a", 1, 0), ("a", 0, 0), ("b", 1, 1), ("b", 0, 1), ("c", 0, 0)]
    df = spark.createDataFrame(data, "g string, label int, predict int")
    r = metrics.fairness_gaps(df, "label", "predict", ["g"]).first()
    assert abs(r.demographic_parity_diff - 1.0) < 1e-12  # b selects all, c nobody
    assert r.recall_max == 1.0 and r.recall_diff == 1.0  # c has no positives: recall counts 0
    assert r.recall_ratio == 0.0 and r.eq_odds_diff == 1.0 and r.f1_min == 0.0
    by = {x.group: x for x in metrics.metrics_by_group(df, "label", "predict", ["g"]).collect()}
    assert by["a"].recall == 0.5 and by["b"].precision == 0.5 and by["c"].f1 == 0.0


def test_welch_textbook(spark):
    a = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9, 16.9, 20.1, 21.9, 22.6, 23.1, 19.6, 19.0, 21.7, 21.4]
    b = [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0, 24.8, 20.2, 21.9, 22.1, 22.9, 30.5, 24.4]
    df = spark.createDataFrame([(x, 0) for x in a] + [(x, 1) for x in b], "v double, label int")
    r = metrics.welch_t(df, "v", "label").first()
    va, vb = np.var(a, ddof=1) / 15, np.var(b, ddof=1) / 15
    assert abs(r.t - (np.mean(a) - np.mean(b)) / math.sqrt(va + vb)) < 1e-9
    assert abs(r.df - (va + vb) ** 2 / (va**2 / 14 + vb**2 / 14)) < 1e-9
    # the tail against numeric integration of the density
    grid = np.linspace(abs(r.t), 400, 2_000_001)
    density = np.exp(math.lgamma((r.df + 1) / 2) - math.lgamma(r.df / 2)) / math.sqrt(r.df * math.pi) * (
        1 + grid**2 / r.df) ** (-(r.df + 1) / 2)
    assert abs(r.p_value - 2 * np.trapezoid(density, grid)) < 1e-6


def test_concordance_against_pairs(spark):
    rng = np.random.default_rng(4)
    data = []
    for i in range(120):
        start = int(rng.integers(0, 4)) * 6
        stop = start + 6 * int(rng.integers(1, 4))
        data.append((i, start, stop, int(rng.random() < 0.3), float(rng.integers(6))))
    df = spark.createDataFrame(data, "id int, tstart int, tstop int, e int, s double")
    got = metrics.concordance(df, "s", "e").first()
    conc = tied = pairs = 0
    for _, _, t, e, s in data:
        if e:
            for _, a2, b2, e2, s2 in data:
                if a2 < t and (b2 > t or (b2 == t and not e2)):
                    pairs += 1
                    conc += s > s2
                    tied += s == s2
    assert (got.concordant, got.tied, got.pairs) == (conc, tied, pairs)


def test_concordance_error_against_pairs(spark):
    """Influences by weights on all pairs: rows over several steps, entities with several rows, two groups, a null score."""
    rng = np.random.default_rng(9)
    data = []
    for i in range(160):
        start = int(rng.integers(0, 4)) * 6
        stop = start + 6 * int(rng.integers(1, 4))
        data.append((int(rng.integers(30)), start, stop, int(rng.random() < 0.3), float(rng.integers(6)), "ab"[i % 2]))
    schema = "id int, tstart int, tstop int, e int, s double, g string"
    df = spark.createDataFrame([*data, (1, 0, 12, 1, None, "a")], schema)
    got = {r.g: r for r in metrics.concordance_error(df, "s", "e", "id", ["g"]).collect()}
    plain = {r.g: r for r in metrics.concordance(df.dropna(), "s", "e", ["g"]).collect()}
    for g in "ab":
        won, every, pairs = dict.fromkeys(range(30), 0.0), dict.fromkeys(range(30), 0), 0
        part = [r for r in data if r[5] == g]
        for i, _, t, e, s, _ in part:
            for i2, a2, b2, e2, s2, _ in part if e else ():
                if a2 < t and (b2 > t or (b2 == t and not e2)):
                    pairs += 1
                    for side in (i, i2):
                        won[side] += (s > s2) + (s == s2) / 2
                        every[side] += 1
        c = sum(won.values()) / sum(every.values())
        error = math.sqrt(sum((won[i] - c * every[i]) ** 2 for i in won)) / pairs
        assert got[g].pairs == pairs == plain[g].pairs
        assert got[g].entities == sum(n > 0 for n in every.values())
        assert abs(got[g].concordance - c) < 1e-12 and abs(plain[g].concordance - c) < 1e-12
        assert abs(got[g].std_error - error) < 1e-12


def test_concordance_error_of_one_time_is_that_of_the_area(spark):
    """With one time and one row per entity it is the placement formula of the area, with counts as divisors."""
    pos, neg = [0.9, 0.8, 0.4, 0.4], [0.7, 0.4, 0.3, 0.2, 0.1]
    data = [(i, 0, 6, int(i < 4), s) for i, s in enumerate(pos + neg)]
    got = metrics.concordance_error(spark.createDataFrame(data, "id int, tstart int, tstop int, e int, s double"), "s", "e", "id").first()
    v = np.array([[(a > b) + (a == b) / 2 for b in neg] for a in pos])
    assert abs(got.std_error - math.sqrt(v.mean(axis=1).var() / 4 + v.mean(axis=0).var() / 5)) < 1e-12


def test_concordance_error_without_pairs(spark):
    schema = "id int, tstart int, tstop int, e int, s double"
    for data in ([], [(1, 0, 6, 0, 0.5), (2, 0, 6, None, 0.1)]):
        got = metrics.concordance_error(spark.createDataFrame(data, schema), "s", "e", "id").first()
        assert got.concordance is None and got.std_error is None


def test_first_detection_and_history(spark):
    curve = curves.score_curve(scores(spark, [(0.9, 0), (0.8, 1), (0.7, 0), (0.6, 1)]), "score", "label")
    assert rows(curves.first_detection(curve)) == [(0, 0.9, 1, 1), (1, 0.8, 2, 2), (2, 0.6, 4, 1)]
    df = spark.createDataFrame([(1, day("2019-01-01"), 0.2, 0), (1, day("2019-07-01"), 0.4, 1)],
                               "ent long, test_dt date, s double, y int")
    got = rows(metrics.score_history(df, ["ent"], "s", "y"), "ever_positive", "previous_score", "next_label")
    assert got == [(1, 0.2, None), (1, None, 1)]
    assert metrics.before_or_at_event(metrics.score_history(df, ["ent"], "s", "y"), "y").count() == 2
    assert metrics.caught_positives(df.withColumn("p", F.lit(1)), "2019-07-01", "y", "p").count() == 1
    assert metrics.entity_history(df, "ent", 1).count() == 2


def test_report_names(spark):
    df = spark.createDataFrame([("GLM_3",), ("GBM_46",), ("Stack_1",)], "m string")
    name = metrics.contender_name("m", "^[A-Za-z]+", "_[0-9]+$", {("GLM", "_3"): "linear"}, ["Stack"])
    assert [r[0] for r in df.select(name).collect()] == ["linear", "GBM-46", "Stack"]
    ids = spark.createDataFrame([("AutoML_4_20231025_104540",)], "p string")
    assert ids.select(metrics.experiment_id("p")).first()[0] == "20231025_104540"
    test = spark.createDataFrame([(day("2015-07-01"),)], "test_dt date")
    assert test.select(metrics.family_name("PUL")).first()[0] == "PUL-15-07"


def test_labels(spark):
    data = [(1, "2018-07-01", "2018-06-30"), (2, "2018-07-01", "2018-07-01"), (3, "2018-07-01", "2019-01-01"),
            (4, "2018-07-01", "2019-01-02"), (5, "2018-07-01", None)]
    df = spark.createDataFrame([(e, day(p), day(f)) for e, p, f in data], "ent long, pred_dt date, condition_start date")
    assert rows(labels.forward_label(df), "ent", "label", "prior") == [(1, 0, 1), (2, 0, 0), (3, 1, 0), (4, 0, 0), (5, 0, 0)]
    loose = labels.forward_label(df, horizon=12, unresolved=True)
    assert rows(loose, "ent", "label") == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 0)]


def test_censoring_and_intervals(spark):
    data = [(1, "2018-07-01", 0), (1, "2019-01-01", 1), (1, "2019-07-01", 1), (1, "2020-07-01", 0),
            (2, "2018-07-01", 0), (2, "2020-07-01", 0), (3, "2019-01-01", 1)]
    df = spark.createDataFrame([(e, day(p), y) for e, p, y in data], "ent long, pred_dt date, label int")
    kept = rows(labels.censor_after_last_positive(df, ["ent"]), "ent", "pred_dt")
    assert (1, day("2020-07-01")) not in kept and len(kept) == 6
    timed = rows(labels.survival_intervals(df, ["ent"]), "ent", "pred_dt", "tstart", "tstop")
    # a skipped period does not skip an interval
    assert timed == [
        (1, day("2018-07-01"), 0, 6), (1, day("2019-01-01"), 6, 12), (1, day("2019-07-01"), 12, 18),
        (2, day("2018-07-01"), 0, 6), (2, day("2020-07-01"), 6, 12), (3, day("2019-01-01"), 0, 6),
    ]
