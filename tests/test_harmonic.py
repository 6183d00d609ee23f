"""Seasonal fits and breaks against numpy."""

import datetime
import random

import numpy as np
import pytest
from swathe.operators import harmonic

START = datetime.datetime(2021, 3, 1)
SCHEMA = "cell string, obs_ts timestamp_ntz, value double"


def design(times, harmonics, trend, period=365.25, origin=datetime.datetime(2000, 1, 1)):
    at = np.array([(t - origin).total_seconds() / 86400 / period for t in times])
    columns = [np.ones(len(at))] + ([at] if trend else [])
    for k in range(1, harmonics + 1):
        columns += [np.cos(2 * np.pi * k * at), np.sin(2 * np.pi * k * at)]
    return np.stack(columns, 1)


def series(seed, n, shift=0.0):
    draw = random.Random(seed)
    times = sorted(START + datetime.timedelta(hours=draw.randrange(24 * 900)) for _ in range(n))
    return [(t, 5 + 3 * np.sin(i / 40) + draw.gauss(0, 1) + (shift if t > START + datetime.timedelta(days=450) else 0)) for i, t in enumerate(times)]


@pytest.mark.parametrize("harmonics,trend", [(0, True), (1, False), (2, True), (3, True)])
def test_fit_equals_least_squares(spark, harmonics, trend):
    cells = {"a": series(1, 200), "b": series(2, 90), None: series(3, 60), "few": series(4, 2), "one time": [(START, float(i)) for i in range(40)]}
    rows = [(k, t, float(v)) for k, s in cells.items() for t, v in s]
    rows += [("a", START, None), ("a", START, float("nan")), ("a", None, 3.0), ("null", START, None)]
    out = {r["cell"]: r for r in harmonic.harmonic_fit(spark.createDataFrame(rows, SCHEMA), ["cell"], harmonics, with_trend=trend).collect()}
    assert out.keys() == cells.keys()
    names = ["mean", *["trend"] * trend, *(f"{f}{k}" for k in range(1, harmonics + 1) for f in ("cos", "sin"))]
    for k in ("a", "b", None):
        x, y = design([t for t, _ in cells[k]], harmonics, trend), np.array([v for _, v in cells[k]])
        w = np.linalg.lstsq(x, y, rcond=None)[0]
        got = [out[k][c] for c in names]
        assert np.allclose(got, w, rtol=1e-5, atol=1e-5 * (1 + np.abs(w).max())), (k, got, w)
        assert out[k]["n"] == len(y) and abs(out[k]["rmse"] - np.sqrt(np.mean((y - x @ w) ** 2))) < 1e-6
    assert all(out["one time"][c] is None for c in names[1:] or ["rmse"]) if len(names) > 1 else True
    assert out["few"]["rmse"] is None or len(names) <= 2
    assert harmonic.harmonic_fit(spark.createDataFrame([], SCHEMA), ["cell"]).count() == 0


def test_breaks(spark):
    cells = {"steady": series(5, 300), "shifted": series(5, 300, 6.0), "few": series(6, 2)}
    rows = [(k, t, float(v)) for k, s in cells.items() for t, v in s]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["cell"]: r for r in harmonic.first_break(df, ["cell"], 1, with_trend=False).collect()}
    assert got.keys() == {"steady", "shifted"}
    for k in got:
        times, y = [t for t, _ in cells[k]], np.array([v for _, v in cells[k]])
        x = design(times, 1, False)
        e = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        run = np.abs(np.cumsum(e)) / (np.sqrt(np.mean(e * e)) * np.sqrt(len(e)))
        last = {t: r for t, r in zip(times, run)}
        above = [t for t, r in last.items() if r > harmonic.BRIDGE_5_PERCENT]
        assert got[k]["break_ts"] == (min(above) if above else None) and abs(got[k]["excursion"] - max(last.values())) < 1e-6
    assert got["shifted"]["break_ts"] is not None
    assert harmonic.first_break(df.limit(0), ["cell"]).count() == 0


def test_residuals_keep_rows(spark):
    df = spark.createDataFrame([("a", START + datetime.timedelta(days=d), float(d % 7)) for d in range(60)] + [("b", START, 1.0), ("a", None, 2.0)], SCHEMA)
    fit = harmonic.harmonic_fit(df, ["cell"], 1, 7.0)
    out = harmonic.harmonic_residuals(df, fit, ["cell"], 7.0).collect()
    assert len(out) == df.count() and sum(r["residual"] is None for r in out) == 2
    assert abs(sum(r["residual"] or 0 for r in out)) < 1e-6
