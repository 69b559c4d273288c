"""Aggregation pipelines of document stores, said as DataFrame operations.

A pipeline is a JSON array of stages.  Each stage becomes the DataFrame call a
Spark user would write for it, so filters and columns reach the scan and the
rest is planned as one query.  Stages, operators and accumulators that are not
listed here are refused by name; none is left out silently.

A field that a document lacks and one that is null are the same here, as they
are in a column.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import quoted

# Stages that leave the fields of documents as they are.
ROW_STAGES = ("$match", "$sort", "$limit", "$skip")


def parse(pipeline: str | Sequence[Mapping]) -> list[tuple[str, object]]:
    """``stage, argument`` of each stage."""
    stages = json.loads(pipeline) if isinstance(pipeline, str) else list(pipeline)
    if isinstance(stages, Mapping):
        stages = [stages]
    found = []
    for stage in stages:
        if not isinstance(stage, Mapping) or len(stage) != 1:
            raise ValueError(f"a stage is an object with one name, not {stage!r}")
        ((name, argument),) = stage.items()
        if name not in _STAGES:
            raise ValueError(f"stage {name} is not supported; these are: {', '.join(_STAGES)}")
        found.append((name, argument))
    return found


def apply_pipeline(df: DataFrame, pipeline: str | Sequence[Mapping]) -> DataFrame:
    """The documents that come out of the pipeline's last stage."""
    for name, argument in parse(pipeline):
        df = _STAGES[name](df, argument)
    return df


def top_fields(stages: Sequence[tuple[str, object]]) -> set[str]:
    """The top-level fields that row stages look at."""
    found: set[str] = set()

    def walk(part: object) -> None:
        if isinstance(part, Mapping):
            for key, inner in part.items():
                if not key.startswith("$"):
                    found.add(key.split(".")[0])
                elif key in ("$and", "$or", "$nor"):
                    for x in inner:
                        walk(x)

    for name, argument in stages:
        if name in ("$match", "$sort"):
            walk(argument)
    return found


# --- fields and literals ------------------------------------------------------------

_EXTENDED: dict[str, Callable[[object], Column]] = {
    "$date": lambda v: F.lit(v if isinstance(v, str) else json.dumps(v)).cast("timestamp"),
    "$numberInt": lambda v: F.lit(int(v)),
    "$numberLong": lambda v: F.lit(int(v)).cast("bigint"),
    "$numberDouble": lambda v: F.lit(float(v)),
    "$numberDecimal": lambda v: F.lit(str(v)).cast("decimal(38,18)"),
    "$oid": lambda v: F.lit(str(v)),
}


def _is_literal(value: object) -> bool:
    return not isinstance(value, Mapping) or (len(value) == 1 and next(iter(value)) in _EXTENDED)


def _literal(value: object) -> Column:
    if isinstance(value, Mapping):
        ((kind, inner),) = value.items()
        return _EXTENDED[kind](inner)
    if isinstance(value, list):
        return F.array(*map(_literal, value))
    return F.lit(value)


def _type_at(schema: T.DataType, path: str) -> T.DataType | None:
    for name in path.split("."):
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return None
        schema = schema[name].dataType
    return schema


def _field(df: DataFrame, path: str) -> Column:
    if _type_at(df.schema, path) is None:
        return F.lit(None)
    return F.col(".".join(map(quoted, path.split("."))))


# --- $match -------------------------------------------------------------------------


def _comparison(operator: str, value: object) -> Callable[[Column], Column]:
    """A test that is true or not; it may be null where it is not."""
    if operator == "$eq":
        return (lambda c: c.isNull()) if value is None else (lambda c: c == _literal(value))
    if operator == "$ne":
        return (lambda c: c.isNotNull()) if value is None else (lambda c: ~c.eqNullSafe(_literal(value)))
    if operator == "$in":
        given = [v for v in value if v is not None]
        plain = not any(isinstance(v, Mapping) for v in given)
        some = (lambda c: c.isin(given)) if plain else (lambda c: reduce(lambda a, b: a | b, [c == _literal(v) for v in given]))
        return (lambda c: some(c) | c.isNull()) if None in value else some
    if operator == "$nin":
        inside = _comparison("$in", value)
        return lambda c: ~F.coalesce(inside(c), F.lit(False))
    if operator == "$exists":
        return (lambda c: c.isNotNull()) if value else (lambda c: c.isNull())
    if operator == "$regex":
        return lambda c: c.rlike(value)
    if operator in _ORDERED:
        return lambda c: _ORDERED[operator](c, _literal(value))
    raise ValueError(f"operator {operator} is not supported in $match")


_ORDERED: dict[str, Callable[[Column, Column], Column]] = {
    "$gt": lambda a, b: a > b,
    "$gte": lambda a, b: a >= b,
    "$lt": lambda a, b: a < b,
    "$lte": lambda a, b: a <= b,
}
# True where no element of an array fits, so they are the opposite of a test on one.
_OPPOSITES = {"$ne": "$eq", "$nin": "$in"}


def _field_test(df: DataFrame, path: str, wanted: object) -> Column:
    field, kind = _field(df, path), _type_at(df.schema, path)
    tests = {"$eq": wanted} if _is_literal(wanted) else dict(wanted)
    if "$options" in tests:
        tests["$regex"] = f"(?{tests.pop('$options')}){tests['$regex']}"
    found = []
    for operator, value in tests.items():
        if operator == "$not":
            found.append(~F.coalesce(_field_test(df, path, value), F.lit(False)))
        elif isinstance(kind, T.ArrayType) and operator in _OPPOSITES:
            found.append(~F.coalesce(_field_test(df, path, {_OPPOSITES[operator]: value}), F.lit(False)))
        elif isinstance(kind, T.ArrayType) and operator != "$exists" and value is not None and not isinstance(value, list):
            found.append(F.exists(field, _comparison(operator, value)))
        elif isinstance(kind, T.ArrayType) and operator == "$in":
            found.append(F.exists(field, _comparison(operator, value)))
        else:
            found.append(_comparison(operator, value)(field))
    return reduce(lambda a, b: a & b, found, F.lit(True)) if len(found) != 1 else found[0]


def _match(df: DataFrame, spec: Mapping) -> Column:
    tests = []
    for key, wanted in spec.items():
        if key in ("$and", "$or", "$nor"):
            parts = [_match(df, x) for x in wanted]
            if key == "$and":
                tests.extend(parts)
            else:
                either = reduce(lambda a, b: a | b, parts)
                tests.append(either if key == "$or" else ~F.coalesce(either, F.lit(False)))
        elif key == "$expr":
            tests.append(_expression(df, wanted))
        elif key.startswith("$"):
            raise ValueError(f"operator {key} is not supported in $match")
        else:
            tests.append(_field_test(df, key, wanted))
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


# --- expressions ----------------------------------------------------------------------


def _ranked(operator: str) -> Callable[..., Column]:
    """Comparison in an expression: null comes before all values."""

    def compare(a: Column, b: Column) -> Column:
        with_null = {
            "$gt": a.isNotNull() & b.isNull(), "$gte": b.isNull(),
            "$lt": a.isNull() & b.isNotNull(), "$lte": a.isNull(),
        }
        return F.coalesce(_ORDERED[operator](a, b), with_null[operator])

    return compare


_EXPRESSIONS: dict[str, Callable[..., Column]] = {
    "$add": lambda *a: reduce(lambda x, y: x + y, a),
    "$subtract": lambda a, b: a - b,
    "$multiply": lambda *a: reduce(lambda x, y: x * y, a),
    "$divide": lambda a, b: a / b,
    "$mod": lambda a, b: a % b,
    "$concat": lambda *a: F.concat(*[c.cast("string") for c in a]),
    "$toLower": lambda a: F.lower(F.coalesce(a.cast("string"), F.lit(""))),
    "$toUpper": lambda a: F.upper(F.coalesce(a.cast("string"), F.lit(""))),
    "$toString": lambda a: a.cast("string"),
    "$toInt": lambda a: a.cast("int"),
    "$toLong": lambda a: a.cast("bigint"),
    "$toDouble": lambda a: a.cast("double"),
    "$ifNull": lambda *a: F.coalesce(*a),
    "$size": lambda a: F.size(a),
    "$year": lambda a: F.year(a),
    "$month": lambda a: F.month(a),
    "$dayOfMonth": lambda a: F.dayofmonth(a),
    "$eq": lambda a, b: a.eqNullSafe(b),
    "$ne": lambda a, b: ~a.eqNullSafe(b),
    "$and": lambda *a: reduce(lambda x, y: x & y, a),
    "$or": lambda *a: reduce(lambda x, y: x | y, a),
    "$not": lambda a: ~a,
    **{o: _ranked(o) for o in _ORDERED},
}


def _expression(df: DataFrame, e: object) -> Column:
    if isinstance(e, str):
        if e.startswith("$$"):
            raise ValueError(f"variable {e} is not supported")
        return _field(df, e[1:]) if e.startswith("$") else F.lit(e)
    if isinstance(e, list):
        return F.array(*[_expression(df, x) for x in e])
    if _is_literal(e):
        return _literal(e)
    if len(e) == 1 and next(iter(e)).startswith("$"):
        ((operator, given),) = e.items()
        if operator == "$literal":
            return _literal(given)
        if operator == "$cond":
            test, yes, no = given if isinstance(given, list) else (given["if"], given["then"], given["else"])
            return F.when(_expression(df, test), _expression(df, yes)).otherwise(_expression(df, no))
        if operator not in _EXPRESSIONS:
            raise ValueError(f"operator {operator} is not supported in an expression")
        return _EXPRESSIONS[operator](*[_expression(df, x) for x in (given if isinstance(given, list) else [given])])
    return F.struct(*[_expression(df, x).alias(name) for name, x in e.items()])


# --- stages ---------------------------------------------------------------------------


def _kept(value: object) -> bool:
    return value is True or (isinstance(value, (int, float)) and not isinstance(value, bool) and value != 0)


def _left_out(value: object) -> bool:
    return value is False or (isinstance(value, (int, float)) and not isinstance(value, bool) and value == 0)


def _project(df: DataFrame, spec: Mapping) -> DataFrame:
    others = {k: v for k, v in spec.items() if k != "_id"}
    if others and all(map(_left_out, others.values())) or not others and _left_out(spec.get("_id")):
        return _unset(df, [k for k, v in spec.items() if _left_out(v)])
    if any(map(_left_out, others.values())):
        raise ValueError("$project takes in fields or leaves them out, not both (but for _id)")
    tree: dict = {}
    if "_id" in df.columns and not _left_out(spec.get("_id", 1)):
        tree["_id"] = spec.get("_id", 1)
    for path, value in others.items():
        *above, last = path.split(".")
        at = tree
        for name in above:
            at = at.setdefault(name, {"": {}})[""]
        at[last] = value

    def column(path: str, value: object) -> Column:
        if isinstance(value, Mapping) and "" in value:
            return F.struct(*[column(f"{path}.{n}", v).alias(n) for n, v in value[""].items()])
        return _field(df, path) if _kept(value) else _expression(df, value)

    return df.select(*[column(name, value).alias(name) for name, value in tree.items()])


def _unset(df: DataFrame, paths: str | Sequence[str]) -> DataFrame:
    for path in [paths] if isinstance(paths, str) else paths:
        top, _, rest = path.partition(".")
        if _type_at(df.schema, path) is not None:
            df = df.withColumn(top, F.col(quoted(top)).dropFields(rest)) if rest else df.drop(F.col(quoted(top)))
    return df


def _add_fields(df: DataFrame, spec: Mapping) -> DataFrame:
    if any("." in name for name in spec):
        raise ValueError("$addFields of a nested field is not supported")
    return df.withColumns({name: _expression(df, e) for name, e in spec.items()})


_ACCUMULATORS: dict[str, Callable[[Column], Column]] = {
    "$sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "$avg": F.avg,
    "$min": F.min,
    "$max": F.max,
}


def _group(df: DataFrame, spec: Mapping) -> DataFrame:
    if "_id" not in spec:
        raise ValueError("$group needs _id")
    totals = []
    for name, accumulator in spec.items():
        if name == "_id":
            continue
        ((kind, given),) = accumulator.items()
        if kind == "$count":
            totals.append(F.count(F.lit(1)).alias(name))
        elif kind == "$sum" and isinstance(given, int) and not isinstance(given, bool):
            totals.append((F.count(F.lit(1)) * F.lit(given)).alias(name))
        elif kind in _ACCUMULATORS:
            totals.append(_ACCUMULATORS[kind](_expression(df, given)).alias(name))
        else:
            raise ValueError(f"accumulator {kind} is not supported; these are: $count, {', '.join(_ACCUMULATORS)}")
    if spec["_id"] is None or _is_literal(spec["_id"]) and not isinstance(spec["_id"], str):
        rows = "__rows"  # a group of no documents is no group
        whole = df.agg(F.count(F.lit(1)).alias(rows), *totals).where(F.col(rows) > 0).drop(rows)
        return whole.select(_literal(spec["_id"]).alias("_id"), *whole.columns)
    keyed = df.groupBy(_expression(df, spec["_id"]).alias("_id"))
    return keyed.agg(*totals) if totals else keyed.agg(F.lit(0).alias("__none")).drop("__none")


def _sort(df: DataFrame, spec: Mapping) -> DataFrame:
    """Nulls come first in rising order and last in falling order, in both worlds."""
    return df.orderBy(*[_field(df, path).asc() if way > 0 else _field(df, path).desc() for path, way in spec.items()])


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name)).where(F.col(quoted(name)) > 0)


def _unwind(df: DataFrame, spec: str | Mapping) -> DataFrame:
    given = {"path": spec} if isinstance(spec, str) else dict(spec)
    path, keep = given.pop("path")[1:], given.pop("preserveNullAndEmptyArrays", False)
    if given or "." in path:
        raise ValueError(f"$unwind with {', '.join(given) or 'a nested path'} is not supported")
    if not isinstance(_type_at(df.schema, path), T.ArrayType):
        return df if keep else df.where(_field(df, path).isNotNull())
    return df.withColumn(path, (F.explode_outer if keep else F.explode)(_field(df, path)))


def _replace_root(df: DataFrame, spec: Mapping) -> DataFrame:
    root = "__root"
    return df.select(_expression(df, spec["newRoot"]).alias(root)).select(f"{root}.*")


_STAGES: dict[str, Callable[[DataFrame, object], DataFrame]] = {
    "$match": lambda df, spec: df.where(_match(df, spec)),
    "$project": _project,
    "$unset": _unset,
    "$addFields": _add_fields,
    "$set": _add_fields,
    "$group": _group,
    "$sort": _sort,
    "$limit": lambda df, n: df.limit(int(n)),
    "$skip": lambda df, n: df.offset(int(n)),
    "$count": _count,
    "$unwind": _unwind,
    "$replaceRoot": _replace_root,
}
