import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from flowgauge.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8",
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


RAW = (
    "series_id long, ordinal long, holiday string, temp double, rain_1h double, snow_1h double, clouds_all int, "
    "weather_main string, weather_description string, date_time timestamp, traffic_volume long"
)


@pytest.fixture
def raw_frame(spark):
    """Raw rows from dicts; unnamed columns take quiet defaults."""
    from datetime import datetime

    def build(rows):
        filled = []
        for i, row in enumerate(rows):
            d = dict(
                series_id=0, ordinal=i, holiday="None", temp=280.0, rain_1h=0.0, snow_1h=0.0, clouds_all=40,
                weather_main="Clouds", weather_description="x", date_time="2024-01-01 00:00:00", traffic_volume=100,
            )
            d.update(row)
            d["date_time"] = datetime.fromisoformat(d["date_time"])
            filled.append(tuple(d.values()))
        return spark.createDataFrame(filled, RAW)

    return build
