"""Profiles kept per file, against profiles of all rows."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import profiles

SCHEMA = (
    T.StructType().add("a.b", T.LongType()).add("name", T.StringType()).add("x", T.DoubleType()).add("day", T.DateType())
    .add("tags", T.ArrayType(T.StringType()))
)


def rows(spark, start, end):
    i = F.col("id")
    return spark.range(start, end, 1, 2).select(
        F.when(i % 5 != 0, i).alias("a.b"),
        F.when(i % 7 != 0, F.concat(F.lit("n"), (i % 11).cast("string"))).alias("name"),
        F.when(i % 3 == 0, F.lit(-0.0)).when(i % 3 == 1, F.lit(0.0)).otherwise(F.lit(float("nan"))).alias("x"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 40).cast("int")).alias("day"),
        F.when(i % 2 == 0, F.array(F.lit("t"))).alias("tags"),
    )


def plain(df):
    """``n_rows, n_null, low, high`` of each column by one scan of all rows."""
    out = {}
    for field in df.schema.fields:
        c = profiles.col(field.name)
        nested = isinstance(field.dataType, T.ArrayType)
        low, high = (F.lit(None), F.lit(None)) if nested else (F.min(c).cast("string"), F.max(c).cast("string"))
        out[field.name] = tuple(df.agg(F.count(F.lit(1)), F.count_if(c.isNull()), low, high).first())
    return out


def merged(kept):
    return {r.column_name: (r.n_rows, r.n_null, r.low, r.high) for r in kept.merged().collect()}


def all_rows(spark, drop):
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(drop)


def parts(folder):
    return sorted(p for p in os.listdir(folder) if p.endswith(".parquet"))


def test_arrivals_are_read_once(spark, tmp_path, plan_of):
    drop = str(tmp_path / "drop")
    kept = profiles.KeptProfiles(spark, str(tmp_path / "kept"), drop, SCHEMA)
    assert kept.update() == [] and kept.merged().count() == 5
    assert {v for v in merged(kept).values()} == {(0, 0, None, None)}
    rows(spark, 0, 300).write.parquet(f"{drop}/one")
    assert len(kept.update()) == 2 and kept.update() == []
    first = merged(kept)
    assert first == plain(all_rows(spark, drop))
    # an arrival without rows, one with two files, and one whose files lack a column
    rows(spark, 0, 0).coalesce(1).write.parquet(f"{drop}/none")
    rows(spark, 1000, 1400).write.parquet(f"{drop}/two")
    rows(spark, 5, 9).drop("name").coalesce(1).write.parquet(f"{drop}/three")
    assert merged(kept) == first
    names = [p.rsplit("/", 2)[1] for p in kept.update()]
    assert "one" not in names and set(names) >= {"two", "three"} and names.count("two") == 2
    assert merged(kept) == plain(all_rows(spark, drop))
    assert kept.pending().count() == 0
    # what is merged is read from the kept profiles and the listing alone
    plan = plan_of(kept.merged())
    assert "Location: InMemoryFileIndex" in plan and "a.b" not in plan.split("ReadSchema")[1]


def test_files_that_change_or_go(spark, tmp_path):
    drop = str(tmp_path / "drop")
    kept = profiles.KeptProfiles(spark, str(tmp_path / "kept"), drop, SCHEMA)
    rows(spark, 0, 100).coalesce(1).write.parquet(f"{drop}/one")
    rows(spark, 100, 200).coalesce(1).write.parquet(f"{drop}/two")
    kept.update()
    rows(spark, 500, 777).coalesce(1).write.mode("overwrite").parquet(f"{drop}/two")
    assert [p.rsplit("/", 2)[1] for p in kept.update()] == ["two"]
    assert merged(kept) == plain(all_rows(spark, drop))
    os.remove(f"{drop}/one/{parts(f'{drop}/one')[0]}")
    assert kept.update() == []
    assert merged(kept) == plain(all_rows(spark, drop))
    assert kept.kept().count() == 3


def test_profiled_twice_counts_once(spark, tmp_path):
    drop = str(tmp_path / "drop")
    kept = profiles.KeptProfiles(spark, str(tmp_path / "kept"), drop, SCHEMA)
    rows(spark, 0, 100).coalesce(1).write.parquet(drop)
    kept.update()
    twice = profiles.KeptProfiles(spark, str(tmp_path / "other"), drop, SCHEMA)
    twice.update()
    twice.kept().write.mode("append").parquet(kept.kept_path)
    assert kept.kept().count() == 2 and merged(kept) == plain(all_rows(spark, drop))


def test_other_columns_are_kept_apart(spark, tmp_path):
    drop, root = str(tmp_path / "drop"), str(tmp_path / "kept")
    rows(spark, 0, 100).coalesce(1).write.parquet(drop)
    profiles.KeptProfiles(spark, root, drop, SCHEMA).update()
    narrow = profiles.KeptProfiles(spark, root, drop, T.StructType(SCHEMA.fields[:1]))
    assert len(narrow.update()) == 1
    assert merged(narrow) == {"a.b": (100, 20, "1", "99")}


def test_distinct_values_are_estimated_over_all_files(spark, tmp_path):
    drop = str(tmp_path / "drop")
    kept = profiles.KeptProfiles(spark, str(tmp_path / "kept"), drop, SCHEMA)
    for n, (start, end) in enumerate([(0, 4000), (2000, 6000)]):
        rows(spark, start, end).write.parquet(f"{drop}/{n}")
        kept.update()
    found = {r.column_name: r.n_distinct for r in kept.merged().collect()}
    assert abs(found["a.b"] - 4800) < 4800 * 0.08
    assert found["name"] == 11 and found["day"] == 40 and found["tags"] is None
    assert found["x"] == 2  # zero, whatever its sign, and not-a-number


@pytest.mark.parametrize("columns", [[], ["a.b", "name"]])
def test_counts_from_footers(spark, tmp_path, plan_of, columns):
    path = str(tmp_path / "t")
    rows(spark, 0, 200).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counted = profiles.footer_counts(spark, path, columns)
    row = counted.first()
    assert row.n_rows == 200 and [row[c] for c in columns] == [160, 171][: len(columns)]
    assert "PushedAggregation: [COUNT(*)" in plan_of(counted).replace("PushedAggregates", "PushedAggregation")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
