import math

import numpy as np
import pandas as pd
import pytest
from driftloom.functions import tails
from driftloom.operators import drift


def frame(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


def share_index(pairs, rows_ref, rows_cur):
    """PSI from hand-counted (reference, current) rows per bin: each share is raised by 1e-4 and scaled back to one."""
    raise_by = 1e-4
    whole = 1 + raise_by * len(pairs)
    total = 0.0
    for a, b in pairs:
        p, q = (a / rows_ref + raise_by) / whole, (b / rows_cur + raise_by) / whole
        total += (q - p) * math.log(q / p)
    return total


def numpy_distances(ref, cur):
    values = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), values, side="right") / len(ref)
    g = np.searchsorted(np.sort(cur), values, side="right") / len(cur)
    return np.abs(f - g).max(), (np.abs(f - g)[:-1] * np.diff(values)).sum()


@pytest.mark.parametrize("rows_per_bucket", [10**6, 120])
def test_distances_equal_numpy(spark, rows_per_bucket):
    rng = np.random.default_rng(11)
    ref = {"a": rng.gamma(3, 2, 900), "b": np.round(rng.uniform(0, 60, 900)), "c": np.where(rng.random(900) < 0.5, -1.0, rng.random(900))}
    cur = {"a": rng.gamma(4, 2, 650), "b": np.round(rng.uniform(5, 70, 650)), "c": np.where(rng.random(650) < 0.2, -1.0, rng.random(650))}
    pair = drift.pair_up(frame(spark, **ref), frame(spark, **cur), rows_per_bucket=rows_per_bucket)
    for r in drift.numeric_statistics(pair).collect():
        ks, w1 = numpy_distances(ref[r["column"]], cur[r["column"]])
        assert r["ks_statistic"] == pytest.approx(ks, abs=1e-12)
        assert r["wasserstein_distance"] == pytest.approx(w1, rel=1e-9)
        assert (r["n_ref"], r["n_cur"]) == (900, 650)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 30])
def test_psi_of_tables_counted_by_hand(spark, rows_per_bucket):
    # 1..100: four bins with the quartiles 25.75, 50.5, 75.25 as edges, 25 rows each
    ref = frame(spark, x=[float(i) for i in range(1, 101)])
    cur = frame(spark, x=[10.0] * 20 + [30.0] * 5 + [60.0] * 10 + [50.5] * 3 + [80.0] * 2 + [999.0] * 10)
    pair = drift.pair_up(ref, cur, rows_per_bucket=rows_per_bucket)
    counted = [(25, 20), (25, 5), (25, 13), (25, 12)]  # an edge belongs to the bin above it
    assert drift.numeric_statistics(pair).first()["psi"] == pytest.approx(share_index(counted, 100, 50), abs=1e-9)
    # 30 rows make three bins; equal edges fall together: 0, 0, 0, 9 is one bin
    few = drift.pair_up(frame(spark, x=[0.0] * 29 + [9.0]), frame(spark, x=[9.0] * 12))
    assert drift.numeric_statistics(few).first()["psi"] == 0.0
    short = drift.pair_up(ref, frame(spark, x=[5.0] * 9))
    assert drift.numeric_statistics(short).first()["psi"] == 0.0


def test_numeric_verdicts(spark):
    base = [float(i % 200) for i in range(600)]
    moved = [float(i % 200) + 150 for i in range(400)]
    shuffled = [float(i % 200) for i in range(7, 407)]
    same = drift.drift_report(frame(spark, x=base), frame(spark, x=shuffled)).first()
    far = drift.drift_report(frame(spark, x=base), frame(spark, x=moved)).first()
    assert not same["is_drift"] and same["ks_statistic"] == 0.0 and same["p_value"] == 1.0 and same["psi"] == 0.0
    assert far["is_drift"] and far["ks_statistic"] == 0.75 and far["p_value"] == 0.0 and far["psi"] > 1


def test_small_batches_against_a_large_reference_have_exact_tails(spark):
    """P(D >= d) by drawing: the order statistics of n uniform numbers."""
    rng = np.random.default_rng(3)
    for n in (5, 10, 20, 50):
        u = np.sort(rng.random((200_000, n)), axis=1)
        i = np.arange(1, n + 1)
        drawn = np.maximum((i / n - u).max(axis=1), (u - (i - 1) / n).max(axis=1))
        for d in (0.9 / math.sqrt(n), 1.4 / math.sqrt(n)):
            assert tails.two_sample_ks_sf(10**7, n, d) == pytest.approx((drawn >= d).mean(), abs=0.004)
    # n = 1: D >= d for d > 1/2 has probability 2 (1 - d); n = 5, d = 0.2: 1 - 5! / 5^5
    assert tails.one_sample_exact_sf(1, 0.7) == pytest.approx(0.6)
    assert tails.one_sample_exact_sf(5, 0.2) == pytest.approx(1 - math.factorial(5) / 5**5)
    assert tails.kolmogorov_sf(0.03, 2000) == pytest.approx(tails.kolmogorov_sf(0.03, 2001), rel=4e-3)


def test_categorical_verdicts(spark):
    ref = frame(spark, shop=["n"] * 120 + ["w"] * 60 + ["e"] * 20)
    stable = drift.drift_report(ref, frame(spark, shop=["n"] * 30 + ["w"] * 15 + ["e"] * 5)).first()
    moved = drift.drift_report(ref, frame(spark, shop=["n"] * 10 + ["w"] * 15 + ["e"] * 25)).first()
    assert not stable["is_drift"] and stable["tvd"] == 0.0 and stable["p_value"] == 1.0
    # expected 30, 15, 5: 400 / 30 + 0 + 400 / 5, half of the shares' distances 0.4 + 0 + 0.4
    assert moved["is_drift"] and moved["tvd"] == 0.4 and moved["statistic"] == pytest.approx(93.3333, abs=1e-4)


def test_missing_is_a_category_and_unseen_is_reported(spark):
    ref = spark.createDataFrame([(None,)] * 30 + [("a",)] * 70, "c string")
    cur = spark.createDataFrame([("z",)] * 25 + [("a",)] * 75, "c string")
    row = drift.drift_report(ref, cur).first()
    assert row["unseen_share"] == 0.25 and row["reference_missing_pct"] == 30.0 and row["tvd"] == 0.30
    assert [(r["category"], r["n"]) for r in drift.unseen_categories(ref, cur, ["c"]).collect()] == [("z", 25)]


def test_report_and_summary(spark):
    def parcels(n, heavy, far, share):
        rows = [(float(i % 50 + heavy), float((i * 7) % 90 * far), "day" if i % 10 < share else "night") for i in range(n)]
        return spark.createDataFrame(rows, "weight double, miles double, shift string")

    ref, cur = parcels(300, 0, 1, 7), parcels(120, 45, 6, 1)
    pair = drift.pair_up(ref, cur)
    report = drift.drift_report(ref, cur, pair=pair)
    assert {r["column"]: r["column_type"] for r in report.collect()} == {"weight": "numerical", "miles": "numerical", "shift": "categorical"}
    summary = drift.drift_summary(report, pair).first()
    assert summary["dataset_drift"] and summary["drift_share"] == 1.0 and summary["number_of_features"] == 3
    assert summary["reference_rows"] == 300 and summary["current_rows"] == 120
    shown = drift.display_table(report).collect()
    assert [r["status"] for r in shown] == ["DRIFT"] * 3 and sorted(r["metric_name"] for r in shown) == ["PSI", "PSI", "TVD"]


def test_prediction_drift_levels(spark):
    def scores(values):
        return frame(spark, probability=values, prediction=[int(v >= 0.5) for v in values])

    base = scores([i % 100 / 250 + (0.4 if i % 9 == 0 else 0.0) for i in range(800)])
    high = drift.prediction_drift(base, scores([0.6 + i % 40 / 100 for i in range(150)])).first()
    assert high["overall_status"] == "CRITICAL_DRIFT" and high["is_drift_detected"] and high["psi"] >= 0.25
    assert drift.prediction_drift(base, base).first()["overall_status"] == "STABLE"
    few = scores([0.1, 0.2, 0.3])
    assert drift.prediction_drift(base, few).first()["overall_status"] == "COLLECTING_DATA"
    assert drift.prediction_drift(few, base).first()["overall_status"] == "NO_BASELINE"


def test_degenerate_columns(spark):
    n = 60
    ref = frame(spark, const=[1.0] * n, holes=[float("nan")] * n, few=[float(i) if i < 4 else float("nan") for i in range(n)])
    rows = {r["column"]: r for r in drift.drift_report(ref, ref).collect()}
    assert set(rows) == {"const", "holes", "few"}
    assert rows["const"]["psi"] == 0.0 and rows["const"]["ks_statistic"] == 0.0 and rows["const"]["p_value"] == 1.0
    for c in ("holes", "few"):
        assert rows[c]["p_value"] == 1.0 and not rows[c]["is_drift"] and rows[c]["test_name"] == "KS-Test & PSI"
    assert rows["holes"]["reference_missing_pct"] == 100.0


def test_infinite_values_count_in_the_outer_bins(spark):
    ref = frame(spark, x=list(np.arange(100.0)))
    cur = frame(spark, x=[float("inf")] * 50 + [float("-inf")] * 50)
    row = drift.numeric_statistics(drift.pair_up(ref, cur)).first()
    assert row["ks_statistic"] == 0.5 and row["psi"] > 1.0


def test_baseline_as_literals_gives_the_same_psi(spark):
    from driftloom.streaming.windows import window_psi
    from pyspark.sql import functions as F

    ref = frame(spark, x=[float(i) for i in range(1, 101)])
    base = drift.psi_baseline(ref, "x")
    rows = frame(spark, x=[10.0] * 20 + [30.0] * 5 + [60.0] * 15 + [80.0] * 10).withColumn("ts", F.lit("2024-01-01 05:00:00").cast("timestamp"))
    got = window_psi(rows, "ts", "x", base, F.window("ts", "1 day")).first()
    assert got["psi"] == pytest.approx(share_index([(25, 20), (25, 5), (25, 15), (25, 10)], 100, 50), abs=1e-9) and got["n"] == 50


def test_a_saved_reference_gives_the_same_report(spark, tmp_path):
    import shutil

    rows = [(float(i % 37) if i % 11 else None, float(i), "abc"[i % 3] if i % 13 else None) for i in range(500)]
    spark.createDataFrame(rows, "x double, y double, c string").write.parquet(str(tmp_path / "raw"))
    now = spark.createDataFrame([(float(i % 50), float(i * 2), "abd"[i % 3]) for i in range(80)], "x double, y double, c string")
    for size in (10**6, 40):
        whole = drift.drift_report(spark.read.parquet(str(tmp_path / "raw")), now, rows_per_bucket=size)
        want = sorted(map(tuple, whole.collect()))
        drift.fit_reference(spark.read.parquet(str(tmp_path / "raw")), rows_per_bucket=size).save(str(tmp_path / f"saved{size}"))
        loaded = drift.load_reference(spark, str(tmp_path / f"saved{size}"))
        assert sorted(map(tuple, drift.drift_report(loaded, now).collect())) == want
    # no reference row is read again
    from driftloom.streaming import sinks

    sink = sinks.data_drift_sink(spark.read.parquet(str(tmp_path / "raw")), str(tmp_path / "reports"))
    shutil.rmtree(tmp_path / "raw")
    sink(now, 0)
    got = sinks.read_batches(spark, str(tmp_path / "reports")).drop("batch_id").select(*whole.columns)
    assert sorted(map(tuple, got.collect())) == want
