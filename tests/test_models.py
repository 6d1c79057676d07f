"""The stored layers of the registered queries."""

from pyspark.sql import functions as F

from conftest import SF001
from lakeline.operators import quality
from lakeline.plans import models
from lakeline.plans.models import TripModels, stored_models
from lakeline.session import clear_scratch


def _layers(spark):
    (layers,) = [v for k, v in models._STORED.items() if k[0] == spark.sparkContext.applicationId and k[1] == SF001]
    return layers


def test_layers_are_written_when_first_used(spark):
    clear_scratch(spark)
    m = stored_models(spark, SF001)
    assert not _layers(spark)
    m.dim_date.count()
    assert set(_layers(spark)) == {"halves", "dim_date"}  # neither fact nor the other gold tables
    stored_models(spark, SF001).fact.count()
    assert set(_layers(spark)) == {"halves", "dim_date", "fact"}


def test_both_halves_of_one_table_are_the_two_projections(spark):
    m, plain = stored_models(spark, SF001), TripModels(spark, SF001)
    for stored, want in ((m.silver, plain.silver), (m.rejected, plain.rejected)):
        assert stored.dtypes == want.dtypes
        assert stored.exceptAll(want).count() == 0 and stored.count() == want.count() > 0


def test_derived_columns_of_rejected_rows_are_not_computed(spark):
    classified = stored_models(spark, SF001).classified.withColumns({
        "trip_duration_seconds": F.lit(10 ** 14), "_reject_reason": F.lit("invalid_duration")})
    rows = quality.both_halves(classified)
    assert rows.where("half <> 'rejected' or trip_duration_minutes is not null").count() == 0 < rows.count()


def test_no_rows_leave_a_typed_table(spark, tmp_path):
    folder = str(tmp_path)
    spark.read.parquet(f"{SF001}/lineitem.parquet").where("false").write.parquet(f"{folder}/lineitem.parquet")
    m = stored_models(spark, folder)
    assert m.silver.columns == quality.SILVER_COLUMNS and m.silver.count() == 0 == m.rejected.count()


def test_wide_rows_run_as_methods_the_jvm_compiles(spark):
    TripModels(spark, SF001)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
