"""Looking rows up by key, by column names and by column range.

``requests`` is any DataFrame with a ``row_key`` column (see ``map_requests``); ``cells`` are current cells in long form.
A batch of requests is answered by one equi join on the row key, never by a call per request.  A row of a wide table
stays in long form: one result row per column found.  Bounds that are the same for all requests are applied to the cells
before the join, so they reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.composite import in_composite_range
from rowloom.plans.skew import SkewOptions, fits_broadcast, hashable, heavy_keys, key_hash, skew_join, stored


UNSET = object()
BLOCK = 64  # cells that a request meets at once in a wide row
MOST_RANGES = 1023
SPREAD = 16


def _parts(cells: DataFrame) -> list[str] | None:
    """The parts of composite column names; None where names are single."""
    kind = cells.schema["column_name"].dataType
    return kind.fieldNames() if isinstance(kind, T.StructType) else None


def _named(cells: DataFrame) -> Column:
    """Whether a cell's name is in its request's ``slice``; a composite name with null parts stands for its prefix."""
    parts, name = _parts(cells), F.col("column_name")
    if parts is None:
        return F.array_contains("slice", name)
    return F.exists("slice", lambda wanted: in_composite_range(name, wanted, wanted, parts))


def _bounded(cells: DataFrame) -> Column:
    """Whether a cell's name is between its request's bounds; composite names by the rule of composite ranges."""
    parts, name = _parts(cells), F.col("column_name")
    if parts is None:
        return name.between(F.col("start"), F.col("end"))
    return in_composite_range(name, F.col("start"), F.col("end"), parts)


def lookup_row(requests: DataFrame, cells: DataFrame, options: SkewOptions | None = None) -> DataFrame:
    """All columns of each requested row.  A missing row gives nothing."""
    return skew_join(requests, cells, ["row_key"], options=options)


def lookup_slice(requests: DataFrame, cells: DataFrame, names: Sequence | None = None,
                 options: SkewOptions | None = None) -> DataFrame:
    """The named columns of each requested row; absent names are just absent.

    ``names`` holds for all requests; without it each request brings an array column ``slice``.  A composite name is
    given by its parts, and matches as a prefix where parts are null.
    """
    composite = _parts(cells) is not None
    if names is not None and composite:
        return lookup_composite_slice(requests, cells, names, options)
    if composite:
        found = skew_join(requests.where("slice IS NOT NULL"), cells, ["row_key"], options=options)
        return found.where(_named(cells))
    if names is not None:
        return skew_join(requests, cells.where(F.col("column_name").isin(list(names))), ["row_key"], options=options)
    wanted = requests.withColumn("column_name", F.explode(F.array_distinct("slice")))
    return skew_join(wanted, cells, ["row_key", "column_name"], options=options)


def lookup_range(requests: DataFrame, cells: DataFrame, start=UNSET, end=UNSET,
                 options: SkewOptions | None = None) -> DataFrame:
    """The columns whose name lies between two bounds, both included.  A null bound gives nothing.

    Literal bounds hold for all requests; without them each request brings columns ``start`` and ``end``.  Bounds of
    composite names are given by their parts, see ``in_composite_range``.
    """
    if start is not UNSET or end is not UNSET:
        if any(bound is UNSET or bound is None for bound in (start, end)):
            inside = F.lit(False)
        elif _parts(cells) is not None:
            inside = composite_bounds(cells, start, end)
        else:
            inside = F.col("column_name").between(start, end)
        return skew_join(requests, cells.where(inside), ["row_key"], options=options)
    return _in_bounds(requests.where("start is not null and end is not null"), cells, options)


def _wide_rows(cells: DataFrame, options: SkewOptions) -> dict[int, int]:
    """Hashes of the row keys of wide rows and their numbers of salts; none are looked for where cells are few."""
    keys = cells if options.right_keys is None else options.right_keys
    return {} if not options.always and fits_broadcast(keys) else heavy_keys(keys, ["row_key"], options)


def _in_bounds(requests: DataFrame, cells: DataFrame, options: SkewOptions | None) -> DataFrame:
    """The columns within the bounds that each request brings.

    A request meets all columns of its row, unless that is a wide one: then it meets only those near its bounds.
    """
    options = options or SkewOptions()
    wide = _wide_rows(cells, options)
    if not wide:
        return skew_join(requests, cells, ["row_key"], options=options).where(_bounded(cells))
    is_wide, own = key_hash(["row_key"]).isin(list(wide)), replace(options, left_keys=None, right_keys=None)
    narrow = skew_join(requests.where(~is_wide), cells.where(~is_wide), ["row_key"], options=own).where(_bounded(cells))
    near = _near_prefix if _parts(cells) is not None else _near_range
    return narrow.unionByName(near(requests.where(is_wide), cells.where(is_wide), wide, own))


def _near_range(requests: DataFrame, cells: DataFrame, wide: Mapping[int, int], options: SkewOptions) -> DataFrame:
    """Bounds on single names in wide rows, by blocks of names.

    Cells are sorted by (row key, name) over ranges of like size, and every ``BLOCK`` cells in a row are a block, whatever
    the size of the table.  A request finds the first and the last block that its bounds touch among the first names of the
    blocks, is copied to each of them and meets only their cells: what it is compared with is what it gets, and the rest
    of the blocks at both ends.
    """
    kinds = dict(cells.dtypes)
    if not all(_comparable(kind, kinds[c]) for c, kind in _bound_kinds(requests)):
        return skew_join(requests, cells, ["row_key"], options=options).where(_bounded(cells))
    ranges = min(MOST_RANGES, max(16, sum(wide.values())))
    cut = cells.repartitionByRange(ranges, "row_key", "column_name").sortWithinPartitions("row_key", "column_name")
    cut = stored(cut.withColumn("__at", F.monotonically_increasing_id()))  # rises by one within a range
    place, own = F.col("__at").bitwiseAND(F.lit(2**33 - 1)), F.shiftright("__at", 33).alias("__cut")
    sizes = cut.groupBy(own).agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    before = Window.orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = stored(sizes.select("__cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__skipped")))
    numbered = cut.withColumn("__cut", own).join(sizes, "__cut")
    numbered = numbered.withColumn("__block", F.col("__skipped") + F.floor(place / BLOCK))
    marks = numbered.where(place % BLOCK == 0).select("row_key", F.col("column_name").alias("__name"), "__block", "__at")
    marks = stored(marks.withColumn("__first", place == 0))
    asked = _touched(requests, "start", marks, "__from")
    asked = stored(_touched(asked, "end", marks, "__to").where("__from <= __to"))
    asked = asked.withColumn("__block", F.explode(F.sequence("__from", "__to"))).drop("__from", "__to")
    found = skew_join(asked, numbered.drop("__cut", "__skipped", "__at"), ["row_key", "__block"], options=options)
    return found.where(_bounded(cells)).drop("__block")


def _bound_kinds(requests: DataFrame) -> list[tuple[str, str]]:
    kinds = dict(requests.dtypes)
    return [("row_key", kinds["row_key"]), ("column_name", kinds["start"]), ("column_name", kinds["end"])]


def _comparable(kind: str, other: str) -> bool:
    """Whether values of two types sort alike in one column; others are compared by Spark's own rules, pair by pair."""
    whole = ("tinyint", "smallint", "int", "bigint")
    return kind == other or (kind in whole and other in whole)


def _touched(requests: DataFrame, bound: str, marks: DataFrame, name: str) -> DataFrame:
    """Add the number of the block of a bound: for ``start`` the last one that begins before it, or the first of all; for
    ``end`` the last one that does not begin after it, or null.

    A bound is first put into a range and then meets the blocks of that range in their order.  Requests of a range that is
    asked for very often are spread over ``SPREAD`` groups, to each of which the few first names are copied.
    """
    first = marks.where("__first").select(F.struct("row_key", "__name").alias("low"))
    lows, key = first.agg(F.array_sort(F.collect_list("low")).alias("lows")), F.struct("row_key", F.col(bound).alias("__name"))
    begins = marks.select("row_key", "__name", "__block", F.lit(1).alias("__kind"), F.struct("row_key", "__name").alias("__key"))
    begins = _in_range(begins, lows, strict=False).withColumn("__group", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable(requests)), F.lit(SPREAD)).cast("int")
    strict = bound == "start"
    asks = requests.withColumns({"__name": F.col(bound), "__kind": F.lit(0 if strict else 2), "__key": key, "__group": spread})
    asks = _in_range(asks, lows, strict)
    order = Window.partitionBy("__range", "__group").orderBy("row_key", "__name", "__kind", "__block")
    block = F.last("__block", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = asks.withColumn("__block", F.lit(None).cast("long")).unionByName(begins, allowMissingColumns=True).withColumn(name, block).where("__kind <> 1")
    number = F.coalesce(name, F.lit(0).cast("long")) if strict else F.col(name)
    return both.withColumn(name, number).drop("__name", "__kind", "__block", "__range", "__group")


def _in_range(rows: DataFrame, lows: DataFrame, strict: bool) -> DataFrame:
    """Replace ``__key`` by ``__range``: how many of the ascending lower bounds are (with ``strict``) below it, one at least."""
    steps = F.array(*[F.lit((MOST_RANGES + 1) >> i) for i in range(1, (MOST_RANGES + 1).bit_length())])

    def halved(at: Column, step: Column) -> Column:
        low, key = F.get("__lows", at + step - 1), F.col("__key")
        return at + F.when(low < key if strict else low <= key, step).otherwise(0)

    found = F.greatest(F.aggregate(steps, F.lit(0), halved), F.lit(1))
    return rows.withColumn("__lows", lows.scalar()).withColumn("__range", found).drop("__lows", "__key")


def _near_prefix(requests: DataFrame, cells: DataFrame, wide: Mapping[int, int], options: SkewOptions) -> DataFrame:
    """Bounds on composite names in wide rows, by the parts that must be equal.

    All counted parts but the last must equal those of ``start``, so requests with the same of them counted are joined on
    the row key and these parts, once for each set of parts.
    """
    parts = _parts(cells)
    given = [F.col("start")[p].isNotNull() & F.col("end")[p].isNotNull() for p in parts]
    later = [reduce(Column.__or__, given[i + 1 :], F.lit(False)) for i in range(len(parts))]
    equal = F.concat_ws(",", *[F.when(g & after, F.lit(p)) for p, g, after in zip(parts, given, later)])
    requests, found = requests.withColumn("__equal", equal), []
    for r in requests.select("__equal").distinct().collect():  # sets of parts: a handful
        same = [p for p in parts if p in r[0].split(",")]
        names = [f"__part_{p}" for p in same]
        asked = requests.where(F.col("__equal") == r[0]).drop("__equal")
        asked = asked.withColumns({n: F.col("start")[p] for n, p in zip(names, same)})
        held = cells.withColumns({n: F.col("column_name")[p] for n, p in zip(names, same)})
        joined = skew_join(asked, held, ["row_key", *names], options=options).where(_bounded(cells)).drop(*names)
        found.append(joined)
    if not found:
        return skew_join(requests.drop("__equal"), cells, ["row_key"], options=options).where(_bounded(cells))
    return reduce(DataFrame.unionByName, found)


def composite_bounds(cells: DataFrame, start: Sequence, end: Sequence) -> Column:
    """``in_composite_range`` for bounds known beforehand: plain comparisons that reach the scan."""
    parts = cells.schema["column_name"].dataType.fieldNames()
    given = [(F.col("column_name")[p], s, e) for p, s, e in zip(parts, start, end) if s is not None and e is not None]
    inside = F.lit(True)
    for i, (part, s, e) in enumerate(given):
        inside = inside & (part.between(s, e) if i == len(given) - 1 else part == s)
    return inside


def lookup_composite_range(requests: DataFrame, cells: DataFrame, start: Sequence | None = None,
                           end: Sequence | None = None, options: SkewOptions | None = None) -> DataFrame:
    """Range over composite column names, see ``in_composite_range``.

    Bounds are given as one value (or None) per part, or come with each request as structs ``start`` and ``end``.
    """
    if start is not None and end is not None:
        return skew_join(requests, cells.where(composite_bounds(cells, start, end)), ["row_key"], options=options)
    return _in_bounds(requests.where("start is not null and end is not null"), cells, options)


def lookup_composite_slice(requests: DataFrame, cells: DataFrame, names: Sequence[Sequence] | None = None,
                           options: SkewOptions | None = None) -> DataFrame:
    """The composite columns that match any of the given names; a name with None parts matches as a prefix.

    Without ``names`` each request brings its own, as an array of structs ``slice``.
    """
    if names is None:
        return lookup_slice(requests, cells, options=options)
    wanted = F.lit(False)
    for name in names:
        wanted = wanted | composite_bounds(cells, name, name)
    return skew_join(requests, cells.where(wanted), ["row_key"], options=options)


def lookup_dispatch(requests: DataFrame, cells: DataFrame, options: SkewOptions | None = None) -> DataFrame:
    """Slice, range or whole row, chosen by each request.

    ``slice`` wins when it is set, then ``start`` and ``end`` when both are set, else the whole row is read.  Requests
    without one of these columns never use that kind, and the plan is made accordingly: slices of single names meet
    their cells by name, so a wide row is not read for two of its columns.  Composite names are met by row key whatever
    the kind, so all kinds share one join, and cells that are yet to be folded are folded once.
    """
    has_slice, composite = "slice" in requests.columns, _parts(cells) is not None
    has_range = {"start", "end"} <= set(requests.columns)
    split = None
    if has_slice and not composite:
        split = lookup_slice(requests.where("slice IS NOT NULL"), cells, options=options)
        requests = requests.where("slice IS NULL")
    options = options or SkewOptions()
    by_name = F.col("slice").isNotNull() if has_slice and composite else F.lit(False)
    bounded = ~by_name & F.col("start").isNotNull() & F.col("end").isNotNull() if has_range else F.lit(False)
    apart = has_range and _wide_rows(cells, options)
    found = skew_join(requests.where(~bounded) if apart else requests, cells, ["row_key"], options=options)
    tests = [(by_name, _named)] * (has_slice and composite) + [(bounded, _bounded)] * (has_range and not apart)
    if tests:
        found = found.where(reduce(lambda rest, t: F.when(t[0], t[1](cells)).otherwise(rest), tests, F.lit(True)))
    if apart:
        found = found.unionByName(_in_bounds(requests.where(bounded), cells, options))
    return reduce(DataFrame.unionByName, [x for x in (found, split) if x is not None])


def lookup_filtered(requests: DataFrame, cells: DataFrame, keep: Column, outputs: Sequence[str],
                    options: SkewOptions | None = None) -> DataFrame:
    """Look up the requests that pass ``keep``; the others come out once with empty strings in ``outputs``."""
    passes = F.coalesce(keep, F.lit(False))
    carried = requests.columns
    found = lookup_dispatch(requests.where(passes), cells, options).select(*carried, *outputs)
    skipped = requests.where(~passes).select(*carried, *[F.lit("").alias(o) for o in outputs])
    return found.unionByName(skipped)


def state_query(requests: DataFrame, cells: DataFrame, options: SkewOptions | None = None) -> DataFrame:
    """The columns of each requested row, and one row with a null column for a request whose row is missing."""
    return skew_join(requests, cells, ["row_key"], "left", options)


def count_columns(requests: DataFrame, cells: DataFrame, options: SkewOptions | None = None) -> DataFrame:
    """Each request with the number of columns its row has, ``cols_n``; 0 for a missing row.

    Cells are counted per row before the join, so a wide row meets its requests as one row.
    """
    widths = cells.groupBy("row_key").agg(F.count("*").alias("cols_n"))
    joined = skew_join(requests, widths, ["row_key"], "left", options, unique_right=True)
    return joined.withColumn("cols_n", F.coalesce("cols_n", F.lit(0).cast("long")))


def multi_get(requests: DataFrame, state: DataFrame, options: SkewOptions | None = None) -> DataFrame:
    """The state value of each requested ``key``, null where absent.

    A repeated key gives a repeated answer.  The place of a request is whatever column the caller numbers it with.
    """
    return skew_join(requests, state, ["key"], "left", options, unique_right=True)
