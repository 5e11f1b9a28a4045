from datetime import date

import numpy as np
import pytest

from casewatch.operators import forecast as FC
from casewatch.operators import summary as G
from casewatch.sources import results
from tests.frames import series, wide


def test_compound_growth(spark):
    rows = FC.compound_growth_forecast(series(spark, s=[100, 110, 121]), steps=2).orderBy("forecast_date").collect()
    assert [(r.forecast_date, r.forecast_value) for r in rows] == [(date(2020, 4, 30), 133.1), (date(2020, 5, 31), 146.41)]
    assert rows[0].lower == pytest.approx(133.1 * 0.85, abs=0.0051) and rows[0].upper == pytest.approx(133.1 * 1.15, abs=0.0051)
    single = FC.compound_growth_forecast(series(spark, s=[7])).collect()
    assert {r.forecast_value for r in single} == {7.0} and len(single) == 6
    after_zero = FC.compound_growth_forecast(series(spark, s=[0, 4, 8])).orderBy("forecast_date").first()
    assert after_zero.forecast_value == 16.0  # the change from 0 is left out


def test_series_are_filled_and_arrays_aligned(spark):
    df = wide(spark, (2, {"date": date(2024, 1, 31)}), (1, {"date": date(2024, 4, 2)}))
    s = G.monthly_series(df)
    assert [(r.month_end, r.value) for r in s.orderBy("month_end").collect()] == [
        (date(2024, 1, 31), 2.0), (date(2024, 2, 29), 0.0), (date(2024, 3, 31), 0.0), (date(2024, 4, 30), 1.0)
    ]
    row = G.series_arrays(s).first()
    assert row["dates"][1] == "2024-02-29" and row["values"] == [2.0, 0.0, 0.0, 1.0]
    assert G.monthly_series(df, drop_partial_months=True).count() == 1


def seasonal(n, slope=1.0):
    return [200 + slope * i + 40 * np.sin(2 * np.pi * i / 12) for i in range(n)]


def test_seasonal_forecast_recovers_the_season(spark):
    rng = np.random.default_rng(0)
    noisy = [v + e for v, e in zip(seasonal(72), rng.normal(0, 2, 72))]
    rows = FC.seasonal_forecast(series(spark, exact=seasonal(72), noisy=noisy)).collect()
    assert len(rows) == 12 and {r.status for r in rows} == {"Success"}
    want = seasonal(78)[72:]
    for name, tolerance in (("exact", 0.5), ("noisy", 12)):
        got = [r for r in sorted(rows, key=lambda r: r.forecast_date) if r.series == name]
        assert np.abs(np.array([r.forecast_value for r in got]) - want).max() < tolerance
        assert all(r.lower <= r.forecast_value <= r.upper for r in got)
        assert got[0].forecast_date == date(2026, 1, 31)
    noisy_rows = sorted((r for r in rows if r.series == "noisy"), key=lambda r: r.forecast_date)
    widths = [r.upper - r.lower for r in noisy_rows]
    assert np.all(np.diff(widths) > -0.03) and widths[0] > 0  # bounds are rounded to two places


def test_short_series_fall_back_and_values_stay_positive(spark):
    rows = FC.seasonal_forecast(series(spark, short=[3, 4, 5], falling=[max(300 - 10 * i, 0) for i in range(40)])).collect()
    status = {r.series: r.status for r in rows}
    assert status["short"] == "Fallback (Moving Average)"
    assert len(rows) == 12 and all(r.lower is None or r.lower >= 0 for r in rows if r.series == "falling")


def test_forecast_document_round_trip(spark):
    s = series(spark, s=[100, 110, 121], t=[5, 5])
    rows = results.forecast_rows(FC.forecast_document(s, FC.compound_growth_forecast(s))).collect()
    assert sum(r.kind == "history" for r in rows) == 5 and sum(r.kind == "forecast" for r in rows) == 12
    assert {r.value for r in rows if r.series == "t"} == {5.0}
