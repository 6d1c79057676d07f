"""Write docs/PLANS.md: physical plans of the main operators.

usage: python scripts/explain_plans.py [sf_dir]

For each operator: the formatted plan's operator tree, and for every scan
its ReadSchema / PushedFilters / PartitionFilters lines.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    tree, _, details = text.partition("\n\n\n")
    scans = []
    for block in details.split("\n\n"):
        if "Scan parquet" in block.split("\n")[0]:
            keep = [ln for ln in block.split("\n") if re.match(r"(\(\d+\) Scan|ReadSchema|PushedFilters|PartitionFilters)", ln)]
            scans.append("\n".join(keep))
    return tree.strip() + ("\n\n" + "\n\n".join(scans) if scans else "")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from lakeline.config import DEDUP_KEYS
    from lakeline.operators import checks, facts, quality
    from lakeline.operators.incremental import source_file_filter
    from lakeline.plans.models import stored_models
    from lakeline.plans.star import star_month_borough
    from lakeline.session import build_session, scratch_path

    spark = build_session(shuffle_partitions=200)
    m = stored_models(spark, sf)
    part_dir = scratch_path(spark, "plans-bronze")
    m.bronze.write.mode("overwrite").partitionBy("_source_period", "_source_file").parquet(part_dir)
    bronze_table = spark.read.parquet(part_dir)
    files = [r[0] for r in bronze_table.select("_source_file").distinct().limit(2).collect()]
    plans = {
        "Star query (flagship)": star_month_borough(m.fact, m.dim_date, m.dim_location),
        "Dedup phase 1: repeated 64-bit key hashes": quality.repeat_hashes(
            quality.typed_trips(m.bronze), DEDUP_KEYS),
        "Silver classification (dedup + rules)": quality.classify(m.bronze),
        "Incremental slice of a bronze table partitioned by (period, file)":
            quality.classify(source_file_filter(bronze_table, files)),
        "Daily zone summary": facts.fact_daily_zone_summary(m.fact),
        "Relationship tests of fact (one scan)": checks.relationship_results(
            "fact_trips", m.fact,
            [checks.relationship("fact_trips", "pickup_date_key", "dim_date", "date_key"),
             checks.relationship("fact_trips", "pickup_location_id", "dim_location", "location_id")],
            {"dim_date": m.dim_date, "dim_location": m.dim_location}),
        "Uniqueness test on trip_id": checks.unique_result("fact_trips", m.fact, "trip_id"),
        "Not-null tests of silver (one pass)": checks.not_null_results(
            "silver", m.silver, ["trip_id", "pickup_at", "dropoff_at", "fare_amount", "total_amount"]),
    }
    out = ["# Physical plans of the main operators", "",
           f"Generated by `scripts/explain_plans.py` on `{sf}` with 200 shuffle partitions "
           "(AQE re-plans at run time; these are the initial plans).", ""]
    for title, df in plans.items():
        out += [f"## {title}", "", "```", summarize(formatted(df)), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    spark.stop()
    print(path)


if __name__ == "__main__":
    main()
