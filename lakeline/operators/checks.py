"""Data tests over result tables, and the gate that stops dependents.

Four generic tests, counted the way the SQL tests count failures:

* ``not_null``: rows where the column is NULL;
* ``unique``: distinct non-NULL values that occur more than once;
* ``relationships``: child rows with a non-NULL key missing from the parent;
* ``accepted_values``: distinct non-NULL values outside the list.

All ``not_null`` tests of one table are fused into one aggregate and all its
``relationships`` into one anti join, so a table is scanned once for either
however many columns are checked.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["test", "model", "column_name", "failures"]


@dataclass(frozen=True)
class DataTest:
    kind: str  # not_null | unique | relationships | accepted_values
    model: str
    column: str
    to_model: str | None = None
    to_field: str | None = None
    values: tuple[str, ...] = field(default_factory=tuple)

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to_model}_{self.to_field}"
        return f"{self.kind}_{self.model}_{self.column}"


def not_null(model: str, *columns: str) -> list[DataTest]:
    return [DataTest("not_null", model, c) for c in columns]


def unique(model: str, column: str) -> DataTest:
    return DataTest("unique", model, column)


def relationship(model: str, column: str, to_model: str, to_field: str) -> DataTest:
    return DataTest("relationships", model, column, to_model, to_field)


def accepted_values(model: str, column: str, values: list[str]) -> DataTest:
    return DataTest("accepted_values", model, column, values=tuple(values))


def _rows(test: str, model: str, column: str, failures) -> DataFrame:
    return failures.select(
        F.lit(test).alias("test"), F.lit(model).alias("model"),
        F.lit(column).alias("column_name"), F.col("failures").cast("long").alias("failures"))


def not_null_results(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """All not-null counts of one table in a single aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("failures"))
        for i, c in enumerate(columns)])).alias("r")).select("r.*")
    return stacked.select(
        F.lit("not_null").alias("test"), F.lit(model).alias("model"),
        "column_name", F.col("failures").cast("long").alias("failures"))


def unique_result(model: str, df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-NULL values; the count is partial-aggregated per key."""
    dups = (df.select(column).where(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return _rows("unique", model, column, dups.agg(F.count(F.lit(1)).alias("failures")))


def relationship_results(model: str, child: DataFrame, tests: list[DataTest], tables: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose non-NULL key is missing in the parent, for all keys of a table.

    The child is scanned once: its keys are counted per column and value with a
    map-side combine, and one anti join against the parents' keys leaves what
    has no parent. Which side is small is left to the planner.
    """
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("test"), F.col(t.column).cast("string").alias("value")) for i, t in enumerate(tests)]))
    counted = child.select(keys.alias("k")).select("k.*").where(F.col("value").isNotNull()).groupBy("test", "value") \
        .agg(F.count(F.lit(1)).alias("n"))
    parents = None
    for i, t in enumerate(tests):
        p = tables[t.to_model].select(F.lit(i).alias("test"), F.col(t.to_field).cast("string").alias("value"))
        parents = p if parents is None else parents.unionByName(p)
    orphans = counted.join(parents, ["test", "value"], "left_anti").agg(
        *[F.coalesce(F.sum(F.when(F.col("test") == i, F.col("n"))), F.lit(0)).alias(f"c{i}") for i in range(len(tests))])
    stacked = orphans.select(F.explode(F.array(*[
        F.struct(F.lit(f"{t.column}->{t.to_model}.{t.to_field}").alias("column_name"), F.col(f"c{i}").alias("failures"))
        for i, t in enumerate(tests)])).alias("r")).select("r.*")
    return stacked.select(
        F.lit("relationships").alias("test"), F.lit(model).alias("model"),
        "column_name", F.col("failures").cast("long").alias("failures"))


def accepted_values_result(model: str, df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    bad = (df.select(column).where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
           .agg(F.count_distinct(column).alias("failures")))
    return _rows("accepted_values", model, column, bad)


def run_tests(tables: dict[str, DataFrame], tests: list[DataTest]) -> DataFrame:
    """One result row per test: ``test, model, column_name, failures``."""
    parts: list[DataFrame] = []
    nn: dict[str, list[str]] = defaultdict(list)
    for t in tests:
        if t.kind == "not_null":
            nn[t.model].append(t.column)
    for model, cols in nn.items():
        parts.append(not_null_results(model, tables[model], cols))
    foreign: dict[str, list[DataTest]] = defaultdict(list)
    for t in tests:
        if t.kind == "relationships":
            foreign[t.model].append(t)
    for model, keys in foreign.items():
        parts.append(relationship_results(model, tables[model], keys, tables))
    for t in tests:
        if t.kind == "unique":
            parts.append(unique_result(t.model, tables[t.model], t.column))
        elif t.kind == "accepted_values":
            parts.append(accepted_values_result(t.model, tables[t.model], t.column, t.values))
        elif t.kind not in ("not_null", "relationships"):
            raise ValueError(f"unknown test kind {t.kind!r}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def blocked_models(results: DataFrame, edges: DataFrame) -> DataFrame:
    """The models that failing tests stop: ``model, failing_model, steps, failing_tests, failures``.

    ``results``: as :func:`run_tests` returns them; ``edges``: ``parent, child``, which
    model reads which (without cycles). A failing test of a model stops every model that
    reads it, directly (``steps`` 1) or through others; a model that fails a test is
    itself built (``steps`` 0). No failures give no rows.
    """
    failed = results.where("failures > 0").groupBy("model").agg(
        F.count(F.lit(1)).alias("failing_tests"), F.sum("failures").alias("failures"))
    return results.sparkSession.sql("""
        WITH RECURSIVE reach(failing_model, model, steps) AS (
            SELECT model, model, 0 FROM {failed}
            UNION ALL
            SELECT r.failing_model, e.child, r.steps + 1 FROM reach r JOIN {edges} e ON e.parent = r.model
        )
        SELECT r.model, r.failing_model, min(r.steps) AS steps, any_value(f.failing_tests) AS failing_tests,
               any_value(f.failures) AS failures
        FROM reach r JOIN {failed} f ON f.model = r.failing_model
        GROUP BY r.model, r.failing_model""", failed=failed, edges=edges)


class DataTestFailure(RuntimeError):
    """Raised by :func:`gate` when a test has failures."""

    def __init__(self, failing: list[tuple[str, str, str, int]]):
        self.failing = failing
        lines = ", ".join(f"{t}({m}.{c})={n}" for t, m, c, n in failing)
        super().__init__(f"{len(failing)} data test(s) failed: {lines}")


def gate(results: DataFrame) -> list[tuple[str, str, str, int]]:
    """Raise if any test failed; otherwise return all (test, model, column, 0).

    The result has one row per test, so collecting it is bounded by the
    number of tests, not by the data.
    """
    rows = [(r["test"], r["model"], r["column_name"], int(r["failures"])) for r in results.collect()]
    failing = [r for r in rows if r[3] > 0]
    if failing:
        raise DataTestFailure(failing)
    return rows
