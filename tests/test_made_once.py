"""an append makes its rows once, and choosing the first rows shuffles them once."""

from pyspark.sql import functions as F

from caselake.operators import dedup
from caselake.operators.key_index import KeyIndex, append_new
from caselake.sources.lake import has_data


def test_rows_are_made_once(spark, tmp_path):
    """the second append of a sink, which looks keys up, makes each of its rows once."""
    path, made = str(tmp_path / "sink"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key_of(x):
        made.add(1)
        return f"k{x}"

    def held():
        return spark.read.parquet(path).select("key").distinct() if has_data(spark, path) else None

    def append(n):
        rows = spark.range(0, n, 1, 2).select(key_of("id").alias("key"), F.col("id").cast("string").alias("text"))
        append_new(rows, F.col("key"), KeyIndex(spark, path, held, 4), lambda r: r.write.mode("append").parquet(path))

    append(10)
    first = made.value
    append(25)
    assert (first, made.value - first) == (10, 25)
    assert sorted(r["key"] for r in spark.read.parquet(path).collect()) == sorted(f"k{i}" for i in range(25))


def test_many_repeated_keys_are_sorted_without_joins(spark, monkeypatch):
    """with more repeated keys than are broadcast, all rows are shuffled once; the chosen rows are the same."""
    rows = spark.range(0, 60, 1, 3).select((F.col("id") % 25).cast("string").alias("key"), (-F.col("id")).alias("at"), F.col("id").cast("string").alias("text"))
    few = {tuple(r) for r in dedup.first_of_wide(rows, "key", [F.col("at")]).collect()}
    monkeypatch.setattr(dedup, "REPEATED_BROADCAST", 3)
    many = dedup.first_of_wide(rows, "key", [F.col("at")])
    assert many.columns == rows.columns and {tuple(r) for r in many.collect()} == few and len(few) == 25
    assert "Join" not in many._jdf.queryExecution().optimizedPlan().toString()
