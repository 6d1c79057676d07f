"""The availableNow trigger loads new files and only new files."""

import os

import pytest
from landing_files import month_rows, write
from lakeline.plans.models import zones_from_tables
from lakeline.plans.pipeline import BRONZE, FACT, SILVER, Pipeline
from lakeline.streaming import landing_stream


def test_stream_loads_each_new_file_once(spark, workdir):
    landing = os.path.join(workdir, "landing")
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"))
    write(f"{landing}/trips_2023_02.parquet", month_rows("2023-02", bad=False))
    pipe = Pipeline(spark, f"{landing}/*.parquet", os.path.join(workdir, "lake"),
                    zones=zones_from_tables(spark, "/root/testdata/sf0.001"))
    ckpt = os.path.join(workdir, "stream-ckpt")
    runs = []
    landing_stream.start(pipe, landing, ckpt, summaries=runs).awaitTermination()
    assert pipe.table(BRONZE).count() == 40 and pipe.table(SILVER).count() == 35
    assert [r.stages["bronze"]["files"] for _, r in runs] == [2]

    write(f"{landing}/trips_2023_03.parquet", month_rows("2023-03", bad=False))
    landing_stream.start(pipe, landing, ckpt, summaries=runs).awaitTermination()
    assert [r.stages["bronze"]["files"] for _, r in runs] == [2, 1]
    assert pipe.table(BRONZE).count() == 60 and pipe.table(SILVER).count() == 55
    assert 0 < len(runs[-1][1].tests) < 48  # an incremental run tests what changed


def test_a_retried_batch_is_gated_again(spark, workdir):
    landing = os.path.join(workdir, "landing")
    rows = month_rows("2023-01", bad=False)
    rows[4]["PULocationID"] = None
    write(f"{landing}/trips_2023_01.parquet", rows)
    pipe = Pipeline(spark, f"{landing}/*.parquet", os.path.join(workdir, "lake"),
                    zones=zones_from_tables(spark, "/root/testdata/sf0.001"))
    for _ in range(2):  # the checkpoint replays the batch that failed
        with pytest.raises(Exception, match="pickup_location_id"):
            landing_stream.start(pipe, landing, os.path.join(workdir, "stream-ckpt")).awaitTermination()
        assert not pipe.exists(FACT)
