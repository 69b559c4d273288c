"""Keeping snapshots current: upsert, replacement, diff and type-2 history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import col
from tidemark.functions.sizes import small_side
from tidemark.operators.chunking import union_pages
from tidemark.operators.stats import key_profile
from tidemark.workspace import materialise

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"

_OLD, _NEW, _SINCE = "__old", "__new", "__since"
_N_OLD, _N_NEW = "__n_old", "__n_new"
_VALUE, _N_SAME = "__value", "__n_same"


def newest_per_key(
    df: DataFrame, keys: Sequence[str], modified: str, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The newest version of every key.

    Spark drops all but the first row of a key before the shuffle, so a key with
    very many versions sends one row per task.
    """
    newest_first = Window.partitionBy(*[col(k) for k in keys]).orderBy(
        F.desc_nulls_last(modified), *[F.desc_nulls_last(t) for t in tie_breakers]
    )
    numbered = df.withColumn("__version", F.row_number().over(newest_first))
    return numbered.where(F.col("__version") == 1).drop("__version")


def upsert(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    modified: str,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """``base`` and ``changes`` together, newest version of each key."""
    return newest_per_key(base.unionByName(changes), keys, modified, tie_breakers)


def replace_by_key(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` with the rows of ``changes`` in place of those with the same key.

    A null in a key equals a null.  When the changed keys are measured to be
    few, ``base`` is not shuffled.
    """
    changed = small_side(changes.select(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct())
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & col(k).eqNullSafe(F.col(f"__k{i}"))
    return base.join(changed, same, "left_anti").unionByName(changes)


def sorted_snapshot(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partitioned by key and sorted within each partition, ready to be written."""
    by = [col(k) for k in keys]
    spread = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return spread.sortWithinPartitions(*by)


class NotAKey(ValueError):
    """A snapshot holds a null key, or a key more than once."""


def require_keys(snapshots: dict[str, DataFrame], keys: Sequence[str]) -> None:
    """Refuse snapshots in which ``keys`` do not identify every row.

    A job of its own that reads the key columns only, for callers that want to
    know before anything else is done.
    """
    profiles = union_pages([key_profile(df, keys, name) for name, df in snapshots.items()])
    bad = profiles.where(~F.col("is_key")).collect()
    if bad:
        raise NotAKey("; ".join(
            f"{r['table_name']}: {r['n_rows']} rows, {r['n_distinct']} distinct and "
            f"{r['n_null']} null keys ({r['key_cols']})" for r in bad
        ))


def all_columns(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the value columns of either, null where a side lacks one, and their names.

    A column of different types on the two sides is refused.
    """
    types: dict[str, T.DataType] = {}
    for side in (old, new):
        for field in side.schema.fields:
            if types.setdefault(field.name, field.dataType) != field.dataType:
                raise TypeError(f"column {field.name} is {types[field.name].simpleString()} on one side and"
                                f" {field.dataType.simpleString()} on the other")
    values = [c for c in types if c not in keys]

    def filled(side: DataFrame) -> DataFrame:
        return side.withColumns({c: F.lit(None).cast(types[c]) for c in values if c not in side.columns})

    return filled(old), filled(new), values


def _refused(keys: Sequence[str], bad: Column) -> Column:
    """Zero, but where ``bad`` holds the job fails and names the key."""
    for k in keys:
        bad = bad | col(k).isNull()
    text = F.concat(F.lit("NotAKey: "), F.to_json(F.struct(*[col(k) for k in keys])), F.lit(" is null or repeats"))
    return F.when(bad, F.raise_error(text).cast("bigint")).otherwise(F.lit(0))


def _sides(old: DataFrame, new: DataFrame, keys: Sequence[str], check_keys: bool) -> DataFrame:
    """One row per key with ``__old`` and ``__new``, and how many rows each side has.

    Both sides are tagged and folded by key in a single shuffle, which also
    counts the copies of each key: with ``check_keys`` a null key, or one that
    repeats on a side, fails the job that meets it.
    """
    key_columns = [col(k) for k in keys]
    kind = old.schema[_OLD].dataType
    none = F.lit(None).cast(kind)
    tagged = old.select(*key_columns, _OLD, none.alias(_NEW), F.lit(1).alias(_N_OLD), F.lit(0).alias(_N_NEW))
    arrived = new.select(
        *key_columns, none.alias(_OLD), F.col(_NEW).cast(kind).alias(_NEW), F.lit(0).alias(_N_OLD), F.lit(1).alias(_N_NEW)
    )
    folded = tagged.unionByName(arrived).groupBy(*key_columns).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in (_OLD, _NEW)],
        *[F.sum(c).alias(c) for c in (_N_OLD, _N_NEW)],
    )
    if not check_keys:
        return folded
    checked = _refused(keys, (F.col(_N_OLD) > 1) | (F.col(_N_NEW) > 1))
    return folded.withColumn(_N_OLD, F.col(_N_OLD) + checked)


def _ops_of_repeats(old: DataFrame, new: DataFrame, keys: Sequence[str], check_keys: bool) -> DataFrame:
    """One row per key and row of the new side with ``op``, and one for each key that is gone.

    Copies are folded by key and value, then by key, so a key that arrives very
    often is counted and not gathered.  With ``check_keys`` a null key, or one
    that repeats on the old side, fails the job that meets it.
    """
    key_columns = [col(k) for k in keys]
    kind = old.schema[_OLD].dataType
    before = old.select(*key_columns, F.col(_OLD).alias(_VALUE), F.lit(1).alias(_N_OLD), F.lit(0).alias(_N_NEW))
    after = new.select(*key_columns, F.col(_NEW).cast(kind).alias(_VALUE), F.lit(0).alias(_N_OLD), F.lit(1).alias(_N_NEW))
    n_old, n_new, n_same = (F.col(c) for c in (_N_OLD, _N_NEW, _N_SAME))
    sums = [F.sum(c).alias(c) for c in (_N_OLD, _N_NEW)]
    values = before.unionByName(after).groupBy(*key_columns, _VALUE).agg(*sums)
    folded = values.groupBy(*key_columns).agg(*sums, F.sum(F.when(n_old > 0, n_new).otherwise(0)).alias(_N_SAME))
    if check_keys:
        folded = folded.withColumn(_N_OLD, n_old + _refused(keys, n_old > 1))
    times = {
        "insert": F.when(n_old == 0, n_new).otherwise(0),
        "delete": F.when(n_new == 0, 1).otherwise(0),
        "same": n_same,
        "update": F.when(n_old > 0, n_new - n_same).otherwise(0),
    }
    ops = F.concat(*[F.array_repeat(F.lit(op), n.cast("int")) for op, n in times.items()])
    return folded.select(*key_columns, F.explode(ops).alias("op"))


def _one_per_key(df: DataFrame, keys: Sequence[str], mark: str, check_keys: bool) -> DataFrame:
    """``df`` with ``mark`` = 1; with ``check_keys`` the job fails at a null key or one that repeats.

    Counting copies needs the rows of a key together, as the join after it
    does: it takes no shuffle of its own, and none where ``df`` is bucketed.
    """
    if not check_keys:
        return df.withColumn(mark, F.lit(1).cast("bigint"))
    copies = F.count(F.lit(1)).over(Window.partitionBy(*[col(k) for k in keys]))
    return df.withColumn(mark, copies).withColumn(mark, F.lit(1) + _refused(keys, F.col(mark) > 1))


def _values(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.struct(*[col(c) for c in columns])


def _spelling(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, T.TimestampType):
        # As local time, the hour when clocks are set back would appear twice.
        return F.unix_micros(c).cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # Adding zero turns a negative zero, which equals zero, into zero.
        return (c + F.lit(0.0)).cast("string")
    return c.cast("string")


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the values: equal for rows whose values are null-safe equal, and only then.

    Every value is written with its length, a null as a mark of its own, so no
    two rows are spelled alike.
    """
    parts = []
    for name in columns:
        kind = df.schema[name].dataType
        if not isinstance(kind, T.AtomicType):
            raise TypeError(f"{name}: values of type {kind.simpleString()} have no unique spelling")
        text = _spelling(col(name), kind)
        spelled = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(spelled, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    check_keys: bool = True,
    by_digest: bool = False,
    new_repeats: bool = False,
) -> DataFrame:
    """Keys with ``op``: insert, update, delete or same.

    All columns of either side but the keys are compared, a column that a side
    lacks being null there, and a null being equal to a null.  A null key or one
    that repeats on a side fails the job; switch ``check_keys`` off only where
    the keys are known to be unique.  With ``by_digest`` only the keys and 32
    bytes per row are shuffled, which is what wide tables need.

    With ``new_repeats`` the new side may hold several rows of a key: each is
    compared with the old row, as an outer join does, and has its own ``op``.
    """
    old, new, values = all_columns(old, new, keys)
    values = list(compare) if compare is not None else values
    content = row_digest if by_digest else _values
    before = old.select(*[col(k) for k in keys], content(old, values).alias(_OLD))
    after = new.select(*[col(k) for k in keys], content(new, values).alias(_NEW))
    if new_repeats:
        return _ops_of_repeats(before, after, keys, check_keys)
    op = (
        F.when(F.col(_N_OLD) == 0, "insert")
        .when(F.col(_N_NEW) == 0, "delete")
        .when(~F.col(_OLD).eqNullSafe(F.col(_NEW)), "update")
        .otherwise("same")
    )
    return _sides(before, after, keys, check_keys).select(*[col(k) for k in keys], op.alias("op"))


def apply_diff(old: DataFrame, diff: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The old snapshot brought up to date by a diff against ``new``.

    A key with several rows in the diff has several in ``new``, which all take
    the place of the old one, whether they differ from it or not.
    """
    old, new, _ = all_columns(old, new, keys)
    key_columns = [col(k) for k in keys]
    per_key = diff.groupBy(*key_columns).agg(
        F.count_if(F.col("op") != "same").alias("changed"), F.count_if(F.col("op") != "delete").alias("arriving")
    )
    touched = materialise(per_key.where((F.col("changed") > 0) | (F.col("arriving") > 1)), "diff")
    gone = small_side(touched.select(*key_columns))
    arriving = small_side(touched.where(F.col("arriving") > 0).select(*key_columns))
    kept = old.join(gone, list(keys), "left_anti")
    return kept.unionByName(new.join(arriving, list(keys), "left_semi").select(*old.columns))


def open_history(snapshot: DataFrame, since: Column) -> DataFrame:
    """The first history: every row current since ``since``, a date or a time stamp."""
    opened = snapshot.withColumn(VALID_FROM, since)
    no_end = F.lit(None).cast(opened.schema[VALID_FROM].dataType)
    return opened.withColumn(VALID_TO, no_end).withColumn(IS_CURRENT, F.lit(True))


class NotLater(ValueError):
    """A snapshot is not later than the history it was to extend."""


def require_later(history: DataFrame, as_of: Column) -> None:
    """Refuse a snapshot that is no later than the last change of ``history``, or dated in another type.

    One that arrives late is a matter for ``splice_history``.
    """
    kind = history.schema[VALID_FROM].dataType
    given = history.select(as_of.alias("as_of")).schema["as_of"].dataType
    if given != kind:
        raise TypeError(f"the history is dated by {kind.simpleString()}, the snapshot by {given.simpleString()}")
    last = F.greatest(F.max(VALID_FROM), F.max(VALID_TO))
    found = history.agg(last.alias("last")).select("last", (F.col("last") >= as_of).alias("late")).first()
    if found["late"]:
        raise NotLater(f"the history has changed at {found['last']}; a later snapshot is needed")


def next_versions(
    current: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    check_keys: bool = True,
) -> DataFrame:
    """What becomes of the current rows when a full snapshot arrives.

    A changed row is closed and opened again, a vanished one is closed, an
    unknown one is opened; one join yields both versions of a change.
    Columns that only one side has are null on the other: a row whose value
    comes or goes has changed.
    """
    day = current.schema[VALID_FROM].dataType
    rows = current.withColumnRenamed(VALID_FROM, _SINCE).drop(VALID_TO, IS_CURRENT)
    rows, snapshot, values = all_columns(rows, snapshot.withColumn(_SINCE, F.lit(None).cast(day)), keys)
    values.remove(_SINCE)
    key_columns = [col(k) for k in keys]
    before = rows.select(*key_columns, _values(rows, values).alias(_OLD), _SINCE)
    after = snapshot.select(*key_columns, _values(snapshot, values).alias(_NEW))
    pairs = _one_per_key(before, keys, _N_OLD, check_keys).join(
        _one_per_key(after, keys, _N_NEW, check_keys), list(keys), "full_outer"
    )
    no_end = F.lit(None).cast(day)

    def version(row: str, start: Column, end: Column, live: bool) -> Column:
        return F.struct(
            F.col(row).alias("row"),
            start.alias(VALID_FROM),
            end.alias(VALID_TO),
            F.lit(live).alias(IS_CURRENT),
        )

    unchanged = version(_OLD, F.col(_SINCE), no_end, True)
    closed = version(_OLD, F.col(_SINCE), as_of.cast(day), False)
    opened = version(_NEW, as_of.cast(day), no_end, True)
    versions = (
        F.when(F.col(_N_OLD).isNull(), F.array(opened))
        .when(F.col(_N_NEW).isNull(), F.array(closed))
        .when(F.col(_OLD).eqNullSafe(F.col(_NEW)), F.array(unchanged))
        .otherwise(F.array(closed, opened))
    )
    each = pairs.select(*key_columns, F.explode(versions).alias("__v"))
    return each.select(
        *key_columns,
        *[F.col("__v.row").getField(v).alias(v) for v in values],
        *[F.col(f"__v.{c}").alias(c) for c in (VALID_FROM, VALID_TO, IS_CURRENT)],
    )


def extend_history(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    check_keys: bool = True,
) -> DataFrame:
    """History after a new full snapshot; rows closed earlier pass through unmoved.

    A snapshot that is no later than the history is refused.
    """
    require_later(history, as_of)
    current = next_versions(history.where(F.col(IS_CURRENT)), snapshot, keys, as_of, check_keys)
    closed_before = history.where(~F.col(IS_CURRENT))
    return closed_before.unionByName(current, allowMissingColumns=True)


_COVERS, _FOLLOWS, _ARRIVES = "__covers", "__follows", "__arrives"
_N_COVERS, _N_FOLLOWS, _N_ARRIVES = "__n_covers", "__n_follows", "__n_arrives"


def touched_by(since: Column, until: Column) -> Column:
    """Whether a version can change when a snapshot of ``since`` arrives after the next one, of ``until``.

    No snapshot lies between the two, so a version that holds anywhere between
    them holds all the time; the one that begins at ``until`` may begin earlier.
    """
    lasts = F.col(VALID_TO).isNull() | (F.col(VALID_TO) >= until)
    return ((F.col(VALID_FROM) < since) & lasts) | (F.col(VALID_FROM) == until)


def splice_history(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    until: Column,
    check_keys: bool = True,
) -> DataFrame:
    """History after a full snapshot that arrives late: the snapshot holds from ``as_of`` to ``until``.

    ``until`` is the date of the next snapshot that was loaded, which is later;
    no loaded one may lie between or at ``as_of``.  The version that was valid
    between the two is cut there: it ends at ``as_of`` and goes on at ``until``,
    with the snapshot's row in between, if that differs.  A row that is what the
    key has from ``until`` on makes that version begin earlier.  The result is
    the same in whatever order snapshots arrive; versions out of reach pass
    through unmoved, the others meet the snapshot in one shuffle.
    """
    day = history.schema[VALID_FROM].dataType
    since, until = as_of.cast(day), until.cast(day)
    touched = touched_by(since, until)
    dates = [VALID_FROM, VALID_TO]
    rows = history.where(touched).drop(IS_CURRENT)
    dated = snapshot.withColumns({d: F.lit(None).cast(day) for d in dates})
    rows, dated, names = all_columns(rows, dated, keys)
    values = [v for v in names if v not in dates]
    key_columns = [col(k) for k in keys]
    one = F.struct(_values(rows, values).alias("row"), *dates)
    none = F.lit(None).cast(rows.select(one.alias("one")).schema["one"].dataType)
    follows = F.col(VALID_FROM) == until

    def marked(side: DataFrame, which: Sequence[Column], content: Column) -> DataFrame:
        parts = zip((_COVERS, _FOLLOWS, _ARRIVES), (_N_COVERS, _N_FOLLOWS, _N_ARRIVES), which)
        columns = [c for name, n, w in parts for c in (F.when(w, content).otherwise(none).alias(name), w.cast("int").alias(n))]
        return side.select(*key_columns, *columns)

    no, yes = F.lit(False), F.lit(True)
    before = marked(rows, (~follows, follows, no), one)
    after = marked(dated, (no, no, yes), F.struct(_values(dated, values).alias("row"), *dates))
    counts = (_N_COVERS, _N_FOLLOWS, _N_ARRIVES)
    folded = before.unionByName(after).groupBy(*key_columns).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in (_COVERS, _FOLLOWS, _ARRIVES)], *[F.sum(c).alias(c) for c in counts]
    )
    if check_keys:
        refused = _refused(keys, F.greatest(*[F.col(n) for n in counts]) > 1)
        folded = folded.withColumn(_N_ARRIVES, F.col(_N_ARRIVES) + refused)
    covered, followed, arrived = (F.col(n) > 0 for n in counts)

    def version(of: str, start: Column, end: Column) -> Column:
        return F.struct(F.col(of).getField("row").alias("row"), start.alias(VALID_FROM), end.alias(VALID_TO))

    start, end = F.col(_COVERS).getField(VALID_FROM), F.col(_COVERS).getField(VALID_TO)
    same = covered & arrived & F.col(_COVERS).getField("row").eqNullSafe(F.col(_ARRIVES).getField("row"))
    joins = arrived & ~same & followed & F.col(_ARRIVES).getField("row").eqNullSafe(F.col(_FOLLOWS).getField("row"))
    kept = F.when(covered & same, F.array(version(_COVERS, start, end)))
    cut = F.when(covered & ~same, F.array(version(_COVERS, start, since)))
    rest = F.when(covered & ~same & (end.isNull() | (end > until)), F.array(version(_COVERS, until, end)))
    opened = F.when(arrived & ~same & ~joins, F.array(version(_ARRIVES, since, until)))
    next_start = F.when(joins, since).otherwise(F.col(_FOLLOWS).getField(VALID_FROM))
    next_one = F.when(followed, F.array(version(_FOLLOWS, next_start, F.col(_FOLLOWS).getField(VALID_TO))))
    nothing = F.filter(F.array(version(_COVERS, start, end)), lambda _: F.lit(False))
    versions = F.concat(*[F.coalesce(part, nothing) for part in (kept, cut, opened, rest, next_one)])
    # The count is read, so that the check of the keys is not dropped with it.
    each = folded.where(F.col(_N_ARRIVES) >= 0).select(*key_columns, F.explode(versions).alias("__v"))
    spliced = each.select(
        *key_columns,
        *[F.col("__v.row").getField(v).alias(v) for v in values],
        *[F.col(f"__v.{c}").alias(c) for c in dates],
    ).withColumn(IS_CURRENT, F.col(VALID_TO).isNull())
    return history.where(~touched).unionByName(spliced, allowMissingColumns=True)
