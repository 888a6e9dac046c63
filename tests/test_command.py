from datetime import datetime

import pytest
from rows import rows_of
from pyspark.sql import functions as F

from breathline.__main__ import arguments, start
from breathline.operators import rollup
from breathline.plans import jobs
from breathline.schema import HOURLY
from breathline.sinks.tables import write_partitioned
from breathline.streaming import flows
from checks import fixture

SF_DIR = "/root/testdata/sf0.001"


def test_arguments():
    chosen = arguments(["archive", "--servers", "h:1", "--table", "t", "--checkpoint", "c"])
    assert (chosen.trigger, chosen.format, chosen.cities) == ("30 minutes", "json", None)
    chosen = arguments(["hourly", "--source", "s", "--table", "t", "--since", "2024-05-01T03"])
    assert chosen.since == datetime(2024, 5, 1, 3)
    with pytest.raises(SystemExit):
        arguments(["realtime", "--servers", "h:1", "--table", "t"])


def test_hourly_and_daily_jobs(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("m", "h", "d")]
    rows = flows.realtime(
        fixture.messages(spark, SF_DIR), fixture.dimension(spark, SF_DIR), processed_time=F.col("timestamp")
    )
    write_partitioned(rows, paths[0], ["processed_date"], ["city", "measurement_time"])
    start(spark, arguments(["hourly", "--source", paths[0], "--table", paths[1]]))
    start(spark, arguments(["daily", "--source", paths[1], "--table", paths[2]]))
    expected = rollup.hourly(fixture.measurements(spark, SF_DIR))
    assert rows_of(jobs.read_hourly(spark, paths[1]), *HOURLY.names) == rows_of(expected)
    assert spark.read.parquet(paths[2]).agg(F.sum("total_records")).first()[0] == 1000
