import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import quality as q


def test_null_profile_of_odd_column_names(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "`a.b` int, `c d` string")
    assert {r[0]: r[1] for r in q.null_profile(df).collect()} == {"a.b": 1, "c d": 2}


def test_null_profile_is_one_scan(spark, sf_dir, plan_of):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(q.null_profile(events, ["ts", "value"]), "simple")
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


def codes(spark, pairs):
    return spark.createDataFrame(pairs, "code string, subcode string")


def statuses(df):
    return {(r["code"], r["subcode"]): r["status"] for r in df.collect()}


def test_ways_of_writing_no_sub_code_are_one(spark):
    actual = codes(spark, [("A", None), ("A", "NULL"), ("A", "None"), ("A", ""), ("B", "x")])
    got = statuses(q.reconcile_codes(actual, codes(spark, [("A", ""), ("C", None)])))
    assert got == {("A", ""): "matched", ("B", "x"): "new", ("C", ""): "missing"}
    assert q.code_pairs(actual, "code", "subcode").count() == 2


def test_status_is_set_also_when_only_missing(spark):
    got = q.code_status(q.reconcile_codes(codes(spark, [("A", "1")]), codes(spark, [("A", "1"), ("B", "2")])))
    assert got.first().asDict() == {"matched": 1, "new": 0, "missing": 1, "status": "mismatch"}
    got = q.code_status(q.reconcile_codes(codes(spark, [("A", "1")] * 50), codes(spark, [("A", "1")])))
    assert got.first()["status"] == "match"


def test_reconciliation_adds_up(spark):
    rnd = random.Random(5)
    a = {(rnd.choice("ABCDE"), rnd.choice("1234")) for _ in range(12)}
    e = {(rnd.choice("ABCDE"), rnd.choice("1234")) for _ in range(12)}
    got = statuses(q.reconcile_codes(codes(spark, list(a) * 3), codes(spark, list(e))))
    assert {k for k, s in got.items() if s != "new"} == e
    assert {k for k, s in got.items() if s != "missing"} == a


def test_codes_take_one_shuffle(spark, plan_of):
    plan = plan_of(q.reconcile_codes(codes(spark, [("A", "1")]), codes(spark, [("A", "1")])), "simple")
    assert plan.count("Exchange") == 1


def brute_names(paths, expected):
    found = []
    for path in paths:
        base = path.split("/")[-1]
        first = next((p for _, p in sorted(expected) if p in base), None)
        found.append((path, base, first))
    return found


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    paths=st.lists(st.text("ab/é_", max_size=12), min_size=1, max_size=15),
    patterns=st.lists(st.text("abé_", min_size=1, max_size=4), min_size=1, max_size=6, unique=True),
)
def test_both_ways_of_matching_names_agree_with_brute_force(spark, paths, patterns):
    expected = list(enumerate(patterns))
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    names = spark.createDataFrame(expected, "ord int, pattern string")
    want = sorted(map(repr, brute_names(paths, expected)))
    for max_tested in (256, 0):
        got = q.reconcile_names(files, "path", names, keep=["path"], max_tested=max_tested)
        assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_first_expected_name_wins_and_status(spark):
    files = spark.createDataFrame([("d/ab_1.dat",), ("d/ab_2.dat",), ("d/new.dat",)], "path string")
    expected = spark.createDataFrame([(1, "ab"), (2, "ab_2")], "ord int, pattern string")
    matched = q.reconcile_names(files, "path", expected)
    found = {r["pattern"]: (r["n_files"], r["missing"]) for r in q.names_found(matched, expected).collect()}
    assert found == {"ab": (2, False), "ab_2": (0, True)}
    assert q.name_status(matched, expected).first().asDict() == {
        "expected_count": 2, "latest_count": 3, "new_files": 1, "missing_files": 1, "status": "mismatch",
    }


def test_names_match(spark):
    files = spark.createDataFrame([("x/a.dat",), ("x/b.dat",)], "path string")
    expected = spark.createDataFrame([(1, "a."), (2, "b.")], "ord int, pattern string")
    matched = q.reconcile_names(files, "path", expected)
    assert q.name_status(matched, expected).first()["status"] == "match"


def test_text_in_lines(spark):
    items = spark.createDataFrame([(i % 3, f"s{i}") for i in range(25)], "a int, b string")
    want = [f"{a} {b}" for a, b in sorted((i % 3, f"s{i}") for i in range(25))]
    one = q.mismatch_text(items, ["a", "b"], items_per_line=25).collect()
    assert [r["summary"] for r in one] == [", ".join(want)]
    lines = q.mismatch_text(items, ["a", "b"], items_per_line=10).orderBy("line").collect()
    assert [r["summary"] for r in lines] == [", ".join(want[i : i + 10]) for i in (0, 10, 20)]


def test_a_key_meets_no_more_names_than_its_rarest_part(spark):
    names = [f"export-part-{i:05d}.parquet" for i in range(300)] + ["other", "abc"]
    patterns = [f"export-part-{i:05d}" for i in range(0, 300, 7)] + [f"{i:05d}.parquet" for i in range(0, 300, 11)] + ["nowhere-at-all"]
    frames = spark.createDataFrame([(n,) for n in names], "base_name string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    found = {r["pattern"]: (r["__gram"], r["__names"]) for r in q.rarest_grams(*frames).collect()}
    assert set(found) == {*patterns[:-1]}  # no name has all parts of the last one
    for pattern, (gram, n) in found.items():
        counts = [sum(pattern[i : i + q.GRAM] in name for name in names) for i in range(len(pattern) - q.GRAM + 1)]
        assert n == min(counts) and n == sum(gram in name for name in names)
        assert n <= 30  # not the 300 that share the beginning or the ending


def test_a_long_list_with_shared_parts(spark, plan_of):
    paths = [f"d/run-{i % 40:03d}-part-{i:04d}.dat" for i in range(200)]
    patterns = ["", "dat", "é", "run-000", *(f"part-{i:04d}" for i in range(0, 400, 3)), *(f"{i:04d}.dat" for i in range(0, 400, 5)), "run-"]
    for expected in ([*enumerate(patterns[1:-1])], [*enumerate(reversed(patterns))]):
        files = spark.createDataFrame([(p,) for p in paths], "path string")
        names = spark.createDataFrame(expected, "ord int, pattern string")
        got = q.reconcile_names(files, "path", names, keep=["path"], max_tested=0)
        assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
        assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(map(repr, brute_names(paths, expected)))
