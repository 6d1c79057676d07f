"""Small generated landing files for scenario tests (written with pyarrow)."""

from __future__ import annotations

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq


def trip(pickup, minutes=10.0, distance=2.0, fare=10.0, total=15.0, pu=100, do=120, vendor=1,
         passengers=1.0, payment=1, tip=2.0, rate=1.0):
    p = dt.datetime.fromisoformat(pickup) if pickup is not None else None
    d = p + dt.timedelta(minutes=minutes) if p is not None else None
    return {
        "VendorID": vendor, "tpep_pickup_datetime": p, "tpep_dropoff_datetime": d,
        "passenger_count": passengers, "trip_distance": distance, "RatecodeID": rate,
        "store_and_fwd_flag": "N", "PULocationID": pu, "DOLocationID": do, "payment_type": payment,
        "fare_amount": fare, "extra": 0.5, "mta_tax": 0.5, "tip_amount": tip, "tolls_amount": 0.0,
        "improvement_surcharge": 1.0, "total_amount": total, "congestion_surcharge": 2.5,
        "airport_fee": 0.0,
    }


def month_rows(month: str, n: int = 20, bad: bool = True, fare_scale: float = 1.0) -> list[dict]:
    """``n`` trips in ``month`` (YYYY-MM); with ``bad`` a few break rules."""
    rows = [trip(f"{month}-{(i % 27) + 1:02d}T{(i % 23):02d}:{i % 60:02d}:00", minutes=5 + i,
                 distance=1.0 + i / 10, fare=(8.0 + i) * fare_scale, total=(12.0 + i) * fare_scale,
                 pu=1 + (i * 7) % 265, do=1 + (i * 11) % 265)
            for i in range(n)]
    if bad:
        rows[3] = dict(rows[2])                          # duplicate of row 2
        rows[5]["trip_distance"] = 0.0                    # invalid_distance
        rows[7]["fare_amount"] = -3.0                     # invalid_amount
        rows[9]["PULocationID"] = 266                     # unknown_location
        rows[11]["tpep_dropoff_datetime"] = None          # missing_timestamp
    return rows


TYPES = {
    "VendorID": pa.int64(), "tpep_pickup_datetime": pa.timestamp("us"), "tpep_dropoff_datetime": pa.timestamp("us"),
    "passenger_count": pa.float64(), "trip_distance": pa.float64(), "RatecodeID": pa.float64(),
    "store_and_fwd_flag": pa.string(), "PULocationID": pa.int64(), "DOLocationID": pa.int64(),
    "payment_type": pa.int64(), "fare_amount": pa.float64(), "extra": pa.float64(), "mta_tax": pa.float64(),
    "tip_amount": pa.float64(), "tolls_amount": pa.float64(), "improvement_surcharge": pa.float64(),
    "total_amount": pa.float64(), "congestion_surcharge": pa.float64(), "airport_fee": pa.float64(),
}


def write(path: str, rows: list[dict], overrides: dict | None = None, drop: tuple = (), rename: dict | None = None,
          mtime: float | None = None, row_group_size: int | None = None) -> str:
    """Write rows with the default types, optionally drifted."""
    overrides, rename = overrides or {}, rename or {}
    cols = [c for c in TYPES if c not in drop]
    arrays, fields = [], []
    for c in cols:
        t = overrides.get(c, TYPES[c])
        vals = [r.get(c) for r in rows]
        if pa.types.is_integer(t) and c == "passenger_count":
            vals = [None if v is None else int(v) for v in vals]
        arrays.append(pa.array(vals, type=t))
        fields.append(rename.get(c, c))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.Table.from_arrays(arrays, names=fields), path, row_group_size=row_group_size)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path
