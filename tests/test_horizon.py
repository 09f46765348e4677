from datetime import datetime, timedelta

from shelfline.operators import forecast as FC
from shelfline.operators import models as M


def test_every_day_gets_both_predictions(spark, listing):
    start = datetime(2024, 4, 1, 9)
    df = listing(*[dict(snapshot_time=start + timedelta(days=d), units_ordered=1 + d % 7, platform=p, month=(start + timedelta(days=d)).month)
                   for d in range(91) if d % 10 != 3 for p in ("alpha", "beta")])
    table = FC.horizon_table(FC.demand_series(df))
    out = M.forecast_horizons(table, maxIter=20)
    assert out.count() == table.count() == 2 * 82
    june = out.filter("month = 6 and demand_in_24h is not null").collect()
    assert sum(abs(r.predicted_24h - r.demand_in_24h) for r in june) / len(june) < 1.0


def test_baseline_record(spark, listing):
    from pyspark.sql import functions as F

    from shelfline.operators import latest as LT
    from shelfline.operators import score as S
    from shelfline.operators import trend as TR
    start = datetime(2024, 4, 1, 9)
    df = listing(*[dict(snapshot_time=start + timedelta(days=d), units_ordered=2 + d // 7, stock_remaining=0) for d in range(21)])
    end = F.lit(start + timedelta(days=20))
    risk = S.stockout_risk(df, LT.latest_snapshot(df), end)
    row = FC.forecast_records(TR.latest_trends(TR.trend_labels(df)), FC.baseline_errors(TR.rolling_demand(df)), risk, end).first()
    assert (row.predicted_demand_index, row.trend_label, row.stockout_risk) == (4.0, "trending", "high")
    assert row.confidence_lower <= 4.0 <= row.confidence_upper
