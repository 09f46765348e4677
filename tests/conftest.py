import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=4, name="shelfline-tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def listing(spark):
    """Builds canonical rows from partial dicts; unnamed columns get plain values."""
    from datetime import datetime

    from shelfline.schema import CANONICAL

    plain = dict(record_id="r", snapshot_time=datetime(2024, 4, 1, 9), location="Old Town", product_name="Milk",
                 category="Dairy", pack_size=500, pack_unit="ml", platform="alpha", mrp=30.0, discount_pct=0.0,
                 effective_price=30.0, price_per_unit=0.06, in_stock=True, stock_remaining=10, units_ordered=2,
                 revenue_inr=60.0, delivery_minutes=15, rating=4.2, hour_of_day=9, is_weekend=False,
                 is_peak_hour=True, weather="Hot", is_raining=False, seasonal_factor=1.0, bulk_discount_pct=0.0,
                 festival_demand_mult=1.0, month=4)

    def make(*rows):
        full = [{**plain, "record_id": f"r{i}", **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[n] for n in CANONICAL.names) for r in full], CANONICAL)

    return make
