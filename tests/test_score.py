import math

import pytest

from demand_engine.operators import score
from demand_engine.plans.forecast import evaluate

PAIRS = "series_id int, actual bigint, prediction double"


def test_measures(rows):
    r = score.accuracy(rows([(1, 2, 1.0), (1, 0, 1.0), (1, 4, 4.0)], PAIRS), extra=True).first()
    assert (r.n, r.mae, r.mape) == (3, pytest.approx(2 / 3), pytest.approx(25.0))
    assert r.rmse == pytest.approx(math.sqrt(2 / 3))
    assert r.wape == pytest.approx(2 / 6) and r.r2 == pytest.approx(1 - 2 / 8)


def test_all_actuals_zero(rows):
    assert score.accuracy(rows([(1, 0, 1.0)], PAIRS)).first().mape == math.inf
    assert score.accuracy(rows([(1, 0, 0.0)], PAIRS)).first().mape == 0.0


def test_no_rows(rows):
    r = score.accuracy(rows([], PAIRS)).first()
    assert r.n == 0 and all(math.isnan(r[m]) for m in ("mae", "rmse", "mape"))


def test_per_series(rows):
    got = {r.series_id: r.mae for r in score.accuracy_by(rows([(1, 2, 1.0), (2, 2, 5.0)], PAIRS)).collect()}
    assert got == {1: 1.0, 2: 3.0}


def test_evaluate_on_text_ids(rows):
    pred = rows([("2024-01-01 00:00:00", "8", 2.0), ("2024-01-01 01:00:00", "8", 2.0)], "timestamp_hour timestamp, pickup_community_area string, prediction double")
    act = rows([("2024-01-01 00:00:00", 8, 3), ("2024-01-01 09:00:00", 8, 3)], "timestamp_hour timestamp, pickup_community_area int, trip_count bigint")
    r = evaluate(pred, act).first()
    assert (r.n, r.mae) == (1, 1.0)


def test_keys_that_cannot_be_cast(rows):
    left, right = rows([(1,)], "k int"), rows([("2024-01-01",)], "k timestamp")
    with pytest.raises(ValueError):
        score.align_key_types(left, right, "k")
