"""Secrets in texts: known forms, and strings too random to be text.  DataFrame functions only.

Known forms are found by their patterns.  Any other long run of code characters
is put through three tests over the alphabet its characters point to:

- chi-squared: are the characters spread too evenly to be text?  Under text the
  statistic is far above its value under uniformity, by an amount that grows
  with the length; a short run can't be told apart, so it has a large p-value.
- runs of the lower and upper half of the alphabet, and the correlation of each
  character with the next: does either speak against randomness?

A run is a secret if neither of the latter does and if the first rejects text
under false-discovery control (Benjamini-Hochberg) among the distinct runs of
about its length in the whole table: copies of a run are one test.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.ordering import col
from tidemark.workspace import materialise

KINDS = ("assign", "access", "hex", "random")

# The known forms.  A shorter run never hides a longer one in the
# last two, so their least length is part of the pattern.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12

RUN = r"[A-Za-z0-9+/_=-]{20,}"

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
# The alphabets of encodings, in the order in which they are tried.
ALPHABETS = (
    _DIGITS,
    _DIGITS + "abcdef",
    _DIGITS + "ABCDEF",
    _UPPER + "234567",
    _DIGITS + _LOWER,
    _DIGITS + _UPPER,
    _DIGITS + _UPPER + _LOWER,
    _UPPER + _LOWER + _DIGITS + "+/",
    _UPPER + _LOWER + _DIGITS + "_-",
    _UPPER + _LOWER + _DIGITS + "+/_-",
)

TOTAL_BLOCK = 256
LENGTH_CLASSES = 16
P_BINS_PER_DECADE = 50
P_DECADES = 40


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a + b)


def totals_before(x: Column) -> Column:
    """For each element of an array of whole numbers: the sum of those before it.

    In blocks, so that the work is not the square of the array's length.
    """
    n, size = F.size(x), F.lit(TOTAL_BLOCK)
    part = lambda b, k: F.slice(x, b * size + 1, k)
    sums = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), lambda b: F.struct(b.alias("b"), _sum(part(b, size)).alias("sum")))
    placed = F.transform(sums, lambda s: F.struct(s["b"].alias("b"), _sum(F.transform(F.slice(sums, 1, s["b"]), lambda y: y["sum"])).alias("base")))
    one = lambda s: F.transform(F.sequence(F.lit(0), F.least(size, n - s["b"] * size) - 1), lambda i: s["base"] + _sum(part(s["b"], i)))
    return F.flatten(F.transform(placed, one))


def _spans(text: Column, pattern: str, found: Column, kind: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """``start, kind, end`` of the matches ``found`` of ``pattern``, in code points; ``keep`` filters by place."""
    between = F.split(text, pattern, -1)
    lengths = F.transform(found, F.length)
    before = totals_before(F.zip_with(F.slice(between, 1, F.size(found)), lengths, lambda a, b: (F.length(a) + b).cast("bigint")))

    def one(end_before: Column, i: Column) -> Column:
        start = end_before + F.length(between[i])
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + lengths[i]).alias("end"))

    return F.transform(before, one)


_NONE = "cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)"


def _base(text: Column) -> list[Column]:
    """One array of spans per known form."""
    out = []
    for kind, pattern in enumerate((ASSIGN, ACCESS, HEX)):
        found = F.regexp_extract_all(text, F.lit(pattern), 0)
        spans = _spans(text, pattern, found, kind)
        if kind == 0:
            values = F.regexp_extract_all(text, F.lit(pattern), 1)
            spans = F.filter(spans, lambda _, i: F.length(values[i]) >= ASSIGN_LEAST)
        out.append(F.when(F.size(found) > 0, spans).otherwise(F.expr(_NONE)))
    return out


def _upper_tail(z: Column) -> Column:
    """P(normal > z) by Abramowitz and Stegun 26.2.17, never zero."""
    x = F.least(F.abs(z), F.lit(37.0))
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _alphabet(value: Column) -> Column:
    """The first alphabet that has all characters: its letters, and for each the half it is in."""
    choice = None
    for letters in ALPHABETS:
        half = len(letters) // 2
        both = F.struct(F.lit(letters).alias("letters"), F.lit("0" * half + "1" * (len(letters) - half)).alias("halves"))
        fits = F.length(F.translate(value, letters, "")) == 0
        choice = F.when(fits, both) if choice is None else choice.when(fits, both)
    return choice


def _tested(value: Column, alphabet: Column, text_coincidence: float) -> Column:
    """``p_text``: how likely text is spread so evenly; ``p_runs, p_serial``: how likely random characters are so ordered."""
    n, k = F.length(value).cast("double"), F.length(alphabet["letters"]).cast("double")
    letters = F.split(value, "")
    squares = F.aggregate(
        F.array_distinct(letters),
        F.lit(0.0),
        lambda a, c: a + F.pow((F.length(value) - F.length(F.replace(value, c, F.lit("")))).cast("double"), F.lit(2.0)),
    )
    chi = squares * k / n - n
    agree = F.greatest(F.lit(text_coincidence), 1.8 / k)  # two characters of text are the same this often
    text_mean, text_var = k * ((n - 1) * agree + 1) - n, 2 * (k - 1) + 4 * n * (k * agree - 1)
    p_text = _upper_tail((text_mean - chi) / F.sqrt(text_var))

    halves = F.call_function("translate", value, alphabet["letters"], alphabet["halves"])
    runs = F.length(F.regexp_replace(F.regexp_replace(halves, "0+", "0"), "1+", "1")).cast("double")
    ones = F.length(F.replace(halves, F.lit("0"), F.lit(""))).cast("double")
    mean = 2 * ones * (n - ones) / n + 1
    sd = F.sqrt((mean - 1) * F.greatest(mean - 2, F.lit(0.0)) / F.greatest(n - 1, F.lit(1.0)))
    p_runs = 2 * _upper_tail(F.abs(F.when(sd > 0, (runs - mean) / sd).otherwise(37.0)))

    return F.struct(p_text.alias("p_text"), p_runs.alias("p_runs"), _serial(value, letters, alphabet["letters"], n).alias("p_serial"), n.alias("n"))


def _serial(value: Column, letters: Column, order: Column, n: Column) -> Column:
    """The two-sided p-value of the correlation of each character's place with the next one's.

    Sums of whole numbers, gathered in one pass over the run however long it is,
    from which the mean is taken off at the end.
    """
    none = F.struct(*[F.lit(0.0).alias(c) for c in ("sum", "squares", "along", "last")])
    sums = F.aggregate(
        letters,
        none,
        lambda a, c: F.transform(
            F.array(F.position(c, order).cast("double")),
            lambda v: F.struct(
                (a["sum"] + v).alias("sum"), (a["squares"] + v * v).alias("squares"),
                (a["along"] + v * a["last"]).alias("along"), v.alias("last"),
            ),
        )[0],
        lambda a: F.struct(a["sum"].alias("sum"), a["squares"].alias("squares"), a["along"].alias("along"), a["last"].alias("last")),
    )
    first = F.position(F.substring(value, 1, 1), order).cast("double")

    def tail(a: Column) -> Column:
        mean = a["sum"] / n
        spread = a["squares"] - n * mean * mean
        along = a["along"] - mean * (2 * a["sum"] - first - a["last"]) + (n - 1) * mean * mean
        # equal characters leave rounding alone; others at least (n - 1) / n
        return 2 * _upper_tail(F.abs(F.when(spread > 0.25, (along / spread + 1 / n) * F.sqrt(n)).otherwise(37.0)))

    return F.transform(F.array(sums), tail)[0]  # so that the sums are gathered once


def _candidates(text: Column, text_coincidence: float) -> Column:
    """The long runs of code characters with their tests."""
    found = F.regexp_extract_all(text, F.lit(RUN), 0)
    spans = _spans(text, RUN, found, KINDS.index("random"))
    each = F.zip_with(spans, found, lambda s, run: F.struct(s.alias("span"), F.replace(run, F.lit("="), F.lit("")).alias("value")))
    each = F.filter(each, lambda e: F.length(e["value"]) > 1)
    each = F.transform(each, lambda e: F.struct(e["span"].alias("span"), e["value"].alias("value"), _alphabet(e["value"]).alias("alphabet")))
    each = F.transform(each, lambda e: F.struct(e["span"].alias("span"), F.xxhash64(e["value"]).alias("run"), _tested(e["value"], e["alphabet"], text_coincidence).alias("t")))
    return F.transform(
        each,
        lambda e: F.struct(
            e["span"].alias("span"),
            e["run"].alias("run"),
            F.least(F.floor(3 * F.log2(e["t"]["n"] / 20 + 1)), F.lit(LENGTH_CLASSES - 1)).cast("int").alias("length_class"),
            F.least(F.floor(-F.log10(e["t"]["p_text"]) * P_BINS_PER_DECADE), F.lit(P_DECADES * P_BINS_PER_DECADE)).cast("int").alias("bin"),
            F.least(e["t"]["p_runs"], e["t"]["p_serial"]).alias("p_order"),
        ),
    )


def _rejections(scanned: DataFrame, false_discovery: float) -> dict[int, int]:
    """By length class, the least bin in which text is rejected: at most ``LENGTH_CLASSES`` numbers.

    P-values are rounded up to the edge of their bin, so the control still holds.
    Each distinct run counts once, by its hash, however many copies it has.
    """
    counts = (
        scanned.select(F.explode("candidates").alias("c"))
        .select("c.length_class", "c.bin", "c.run")
        .distinct()
        .groupBy("length_class", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    own = Window.partitionBy("length_class")
    rank, tests = F.sum("n").over(own.orderBy(F.desc("bin"))), F.sum("n").over(own)
    edge = F.pow(F.lit(10.0), -F.col("bin") / P_BINS_PER_DECADE)
    passed = counts.withColumn("ok", edge <= false_discovery * rank / tests).where("ok")
    least = passed.groupBy("length_class").agg(F.min("bin").alias("bin"))
    return {r["length_class"]: r["bin"] for r in least.collect()}


def scan_secrets(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    false_discovery: float = 0.01,
    order_level: float = 0.001,
    text_coincidence: float = 0.065,
    carry: bool = False,
) -> DataFrame:
    """``doc_id, base, added`` for every row: arrays of ``start, kind, end`` in code points, sorted, end exclusive.

    ``kind`` is a place in ``KINDS``.  ``base`` has the known forms, leftmost
    and without overlap for each kind; ``added`` the runs that the tests take
    for random and that overlap none of them.  ``false_discovery`` is the
    expected part of text among the distinct runs of the latter, ``order_level`` the level at which
    runs or serial correlation speak against randomness, ``text_coincidence``
    how often two characters of text agree.  Null and empty texts have no spans;
    null ids stay null; repeated rows come out as often as they go in; an empty
    table gives an empty result; other columns are not read, but with ``carry``
    the whole input row is put into a column ``row``.  Texts are read once and
    not shuffled, hashes of distinct runs are; the driver gets one number per length class.
    """
    whole = [F.struct(*[col(c) for c in df.columns]).alias("row")] if carry else []
    rows = df.select(
        *whole, col(id_col).cast("bigint").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text")
    )
    text = F.col("text")
    runs = F.when(text.rlike(RUN), _candidates(text, text_coincidence))
    kept = ["row", "doc_id"] if carry else ["doc_id"]
    scanned = materialise(
        rows.select(*kept, F.array_sort(F.concat(*_base(text))).alias("base"), runs.alias("candidates")), "secrets"
    )
    least = _rejections(scanned, false_discovery)
    bins = F.create_map(*[F.lit(x) for pair in least.items() for x in pair]) if least else None
    base, found = F.col("base"), F.col("candidates")
    if bins is None:
        return scanned.select(*kept, "base", F.expr(_NONE).alias("added"))
    random = F.filter(found, lambda c: (c["bin"] >= bins[c["length_class"]]) & (c["p_order"] >= order_level))
    alone = F.filter(
        F.transform(random, lambda c: c["span"]),
        lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return scanned.select(*kept, "base", F.coalesce(F.array_sort(alone), F.expr(_NONE)).alias("added"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` of a scan."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("bigint").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS[:3]],
        F.size("added").cast("bigint").alias("n_random"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )



def masked(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with ``mask`` in place of each run of overlapping ``spans``."""
    merged = F.aggregate(
        F.array_sort(spans),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.try_element_at(done, F.lit(-1))["end"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )

    def around(ends: Column) -> Column:
        before = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(ends, lambda s: s["end"]))
        after = F.concat(F.transform(ends, lambda s: s["start"]), F.array(F.length(text).cast("bigint")))
        return F.array_join(F.zip_with(before, after, lambda a, b: F.substr(text, (a + 1).cast("int"), (b - a).cast("int"))), mask)

    return F.when(F.size(spans) > 0, F.transform(F.array(merged), around)[0]).otherwise(text)
