"""Pages of a table that grows, against pages of all its rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunking
from tidemark.operators.page_index import _GEN, _N, _OF, PageIndex
from tidemark.sinks.published import PublishRefused


def table(spark, low, high, step=1):
    i = F.col("id")
    return spark.range(low, high, step, 3).select((i * 7919 % 100003).alias("a.b"), F.lpad(i.cast("string"), 6, "0").alias("name"))


def plain(df, keys, size):
    rows = sorted(tuple(r[k] for k in keys) for r in df.collect())
    return {k: i // size for i, k in enumerate(rows)}


def paged(df, keys):
    rows = df.collect()
    found = {tuple(r[k] for k in keys): r[chunking.CHUNK_ID] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("keys", [["a.b"], ["name", "a.b"]])
def test_appends_give_the_pages_of_all_rows(spark, tmp_path, keys):
    index = PageIndex(spark, str(tmp_path / "i"), keys, rows_per_bucket=100)
    everything = table(spark, 0, 0)
    assert index.page_rows(everything, 7).columns == ["a.b", "name", chunking.CHUNK_ID]
    assert index.append(everything) == 0 and index.page_rows(everything, 7).count() == 0
    for part in (table(spark, 0, 1000), table(spark, 1000, 1010), table(spark, 5000, 6500), table(spark, 0, 0)):
        assert index.append(part) == part.count()
        everything = everything.unionByName(part)
        sizes = [r[0] for r in index.fences.read().select(_N).collect()]
        assert sum(sizes) == everything.count() and max(sizes) < 200
    for size in (1, 7, 97, 2510, 10**6):
        assert paged(index.page_rows(everything, size), keys) == plain(everything, keys, size)
    index.compact()
    assert index.fences.read().select(_GEN).distinct().count() == 1
    assert paged(index.page_rows(everything, 97), keys) == plain(everything, keys, 97)


def test_only_buckets_that_keys_fall_into_are_numbered(spark, tmp_path, monkeypatch):
    index = PageIndex(spark, str(tmp_path / "i"), ["id"], rows_per_bucket=100)
    index.append(spark.range(0, 4000, 2))
    before = {r[_OF] for r in index.fences.read().collect()}
    assert len(before) == 20
    ranked = []
    plain_rank = chunking.rank
    monkeypatch.setattr("tidemark.operators.page_index.rank", lambda df, keys, n, per: ranked.append(n) or plain_rank(df, keys, n, per))
    # a few keys in one place, and a few at the end
    index.append(spark.range(1001, 1011, 2).union(spark.range(5000, 5010)))
    assert ranked == [215]
    after = {r[_OF] for r in index.fences.read().collect()}
    assert len(before - after) == 2 and len(after) == 20
    rows = spark.range(0, 4000, 2).union(spark.range(1001, 1011, 2)).union(spark.range(5000, 5010))
    assert paged(index.page_rows(rows, 33), ["id"]) == plain(rows, ["id"], 33)


def test_nothing_of_a_refused_append_is_seen(spark, tmp_path):
    index = PageIndex(spark, str(tmp_path / "i"), ["id"], rows_per_bucket=10)
    rows = spark.range(50)
    index.append(rows)
    with pytest.raises(chunking.TiedKeys):
        index.append(spark.range(49, 60))
    with pytest.raises(ValueError, match="null"):
        index.append(spark.createDataFrame([(None,), (99,)], "id bigint"))
    stage = index.fences.stage

    def overtaken(df):
        index.fences.stage = stage
        PageIndex(spark, index.root, ["id"], 10).append(spark.range(100, 110))
        return stage(df)

    index.fences.stage = overtaken
    with pytest.raises(PublishRefused):
        index.append(spark.range(200, 210))
    rows = rows.union(spark.range(100, 110))
    assert paged(index.page_rows(rows, 7), ["id"]) == plain(rows, ["id"], 7)


def test_more_pages_than_can_be_looked_up(spark, tmp_path, monkeypatch):
    index = PageIndex(spark, str(tmp_path / "i"), ["id"], rows_per_bucket=10)
    rows = spark.range(0, 90, 3)
    index.append(rows)
    monkeypatch.setattr(chunking.Pages, "can_be_looked_up", lambda self: False)
    assert paged(index.page_rows(rows, 4), ["id"]) == plain(rows, ["id"], 4)


def test_untouched_keys_are_scanned_not_shuffled(spark, tmp_path, plan_of):
    index = PageIndex(spark, str(tmp_path / "i"), ["id"], rows_per_bucket=100)
    index.append(spark.range(2000))
    plan = plan_of(index._kept(index._placed(index.fences.read())), "simple")
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
