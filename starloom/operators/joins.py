"""Attribute joins, single-match lookups and dimension enrichment.

Skew policy. A side measured small is broadcast, so the big side never
shuffles. Otherwise both sides shuffle, and keys found to be heavy are salted;
those heavy on both sides are dealt over a grid of tasks.
Plain dimension joins carry no hint: the optimizer broadcasts by file size, and
adaptive execution splits hot partitions of the sort-merge join beyond that. A
derived dimension gets a known size from :func:`starloom.scale.stored`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.dedup import first_per_key
from starloom.scale import BROADCAST_ROWS, HOT_MIN_ROWS, grid_sides, hot_keys, is_hot, salt_sides, size_checked


def _common_type(left: DataFrame, l_name: str, right: DataFrame, r_name: str) -> str:
    """The type both columns are compared in; equal keys must hash alike on both sides."""
    a, b = (df.schema[name].dataType.simpleString() for df, name in ((left, l_name), (right, r_name)))
    if a == b:
        return a
    both = left.sparkSession.sql(f"SELECT coalesce(CAST(NULL AS {a}), CAST(NULL AS {b})) AS c")
    return both.dtypes[0][1]


def attribute_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
    decimals: Mapping[str, str] | None = None,
    keep: Sequence[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_MIN_ROWS,
    hot_share: float | None = None,
    hot: Mapping[int, int] | None = None,
    measure: DataFrame | None = None,
    unique_right: bool = False,
) -> DataFrame:
    """Join on natural attributes, ``{left column: right column}``.

    Every match is kept, so duplicates on the right fan out. ``decimals`` names
    left columns compared after a cast of both sides to the given type, which
    makes equality of floating-point attributes well defined. ``keep`` lists
    the right columns to return (all by default); names must not clash.
    ``measure`` is an upper bound of ``right`` that is cheaper to size. Heavy
    keys are looked for unless ``hot`` names them (hash to number of parts).
    They are cut on the left, and on the right too where they are heavy there;
    ``unique_right`` says that no key repeats on the right, which spares the search.
    """
    decimals = decimals or {}
    kept = list(right.columns if keep is None else keep)
    left_cols = left.columns
    left_keys = [f"_l{i}" for i in range(len(on))]
    right_keys = [f"_k{i}" for i in range(len(on))]

    kinds = [decimals.get(name) or _common_type(left, name, right, r_name) for name, r_name in on.items()]
    left = left.withColumns({key: F.col(name).cast(kind) for key, name, kind in zip(left_keys, on, kinds)})
    right = right.select(*kept, *[F.col(r).cast(kind).alias(key) for key, r, kind in zip(right_keys, on.values(), kinds)])

    right, small = size_checked(right, right if measure is None else measure, broadcast_rows)
    condition = [F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys)]
    if small:
        return left.join(right, on=condition, how=how).select(*left_cols, *kept)
    if hot is None:
        hot = hot_keys(left.dropna(subset=left_keys), left_keys, hot_rows, hot_share)
    right_hot = {} if unique_right else hot_keys(right.dropna(subset=right_keys), right_keys, hot_rows, hot_share)
    if not right_hot:
        left, right = salt_sides(left, right, left_keys, right_keys, hot)
        condition.append(F.col("_salt") == F.col("_right_salt"))
        joined = left.join(right.withColumnRenamed("_salt", "_right_salt"), on=condition, how=how)
        return joined.select(*left_cols, *kept)
    if how != "inner":
        # a repeated left row must not count as unmatched in the cells it finds empty: only matches go over the grid
        met = F.broadcast(right.where(is_hot(right_keys, right_hot)).select(*right_keys).distinct())
        gridded = left.join(met, on=condition, how="left_semi")
        rest = left.join(met, on=condition, how="left_anti")
        few = right.where(~is_hot(right_keys, right_hot) | reduce(or_, [F.col(c).isNull() for c in right_keys]))
        others, few = salt_sides(rest, few, left_keys, right_keys, {k: n for k, n in hot.items() if k not in right_hot})
        unmatched_too = others.join(few.withColumnRenamed("_salt", "_right_salt"), on=[*condition, F.col("_salt") == F.col("_right_salt")], how=how)
        matches = _over_grid(gridded, right.where(is_hot(right_keys, right_hot)), left_keys, right_keys, hot, right_hot)
        return matches.select(*left_cols, *kept).unionByName(unmatched_too.select(*left_cols, *kept))
    return _over_grid(left, right, left_keys, right_keys, hot, right_hot).select(*left_cols, *kept)


def _over_grid(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], hot: Mapping[int, int], right_hot: Mapping[int, int]
) -> DataFrame:
    left, right = grid_sides(left, right, left_keys, right_keys, hot, right_hot)
    right = right.withColumnsRenamed({"_row": "_right_row", "_col": "_right_col"})
    cells = [F.col("_row") == F.col("_right_row"), F.col("_col") == F.col("_right_col")]
    return left.join(right, on=[*[F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys)], *cells], how="inner")


def attribute_join_sums(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
    left_sums: Mapping[str, str] | None = None,
    right_sums: Mapping[str, str] | None = None,
    count: str = "n",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Number of pairs and sums over all pairs of :func:`attribute_join`, per key, without making the pairs.

    ``{output column: whole-number column}`` names the sums over either side's column. Each side
    collapses to a row per key before they meet: a left row counts once for
    every right row of its key, so a sum over pairs is a side's sum times the other's rows. A key
    with any number of rows on both sides costs a row per key and task, where its pairs are their product.
    Sums leave out nulls and are null where no value is left, as over the pairs.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"no sums of pairs for a join that is {how!r}")
    left_sums, right_sums = left_sums or {}, right_sums or {}
    ours = left.groupBy(*on).agg(F.count("*").alias("_l_n"), *[F.sum(c).alias(f"_ls_{name}") for name, c in left_sums.items()])
    theirs = right.dropna(subset=list(on.values())).groupBy(*[F.col(r).alias(f"_r_{r}") for r in on.values()]).agg(
        F.count("*").alias("_r_n"), *[F.sum(c).alias(f"_rs_{name}") for name, c in right_sums.items()]
    )
    sides = {l: f"_r_{r}" for l, r in on.items()}
    kept = ["_r_n", *[f"_rs_{name}" for name in right_sums]]
    met = attribute_join(ours, theirs, sides, how, keep=kept, broadcast_rows=broadcast_rows, hot={}, unique_right=True)
    times = F.coalesce("_r_n", F.lit(1))  # a left row without a match is one row of a left join
    # again per key: right keys of another type may have become equal
    return met.groupBy(*on).agg(
        F.sum(F.col("_l_n") * times).alias(count),
        *[F.sum(F.col(f"_ls_{name}") * times).alias(name) for name in left_sums],
        *[F.sum(F.col(f"_rs_{name}") * F.col("_l_n")).alias(name) for name in right_sums],
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    keep: Sequence[str],
    pick: Sequence[str],
    decimals: Mapping[str, str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_MIN_ROWS,
    hot_share: float | None = None,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Left join that returns every left row exactly once.

    Where several right rows match, the one smallest by ``pick`` wins, so the
    result does not depend on the order in which rows are read.
    """
    decimals = decimals or {}
    keyed = right.select(
        *[F.col(r).cast(decimals[l]).alias(r) if l in decimals else F.col(r) for l, r in on.items()],
        *[c for c in dict.fromkeys([*keep, *pick]) if c not in on.values()],
    ).dropna(subset=list(on.values()))
    single = first_per_key(keyed, list(on.values()), list(pick))
    return attribute_join(left, single, on, "left", decimals, keep, broadcast_rows, hot_rows, hot_share, hot, keyed, unique_right=True)


def enrich(
    df: DataFrame,
    dimension: DataFrame,
    key: str | Column,
    dimension_key: str,
    columns: Mapping[str, str],
    required: bool = False,
) -> DataFrame:
    """Add ``{dimension column: output column}`` from a dimension with a unique key.

    Called once per role, so one dimension can serve several keys. ``required``
    drops rows without a match. Rows keep their other columns, and an output
    name that exists already is replaced.
    """
    side = dimension.select(
        F.col(dimension_key).alias("_key"),
        *[F.col(source).alias(f"_new_{target}") for source, target in columns.items()],
    )
    condition = (F.col(key) if isinstance(key, str) else key) == F.col("_key")
    joined = df.join(side, on=condition, how="inner" if required else "left")
    targets = list(columns.values())
    kept = [c for c in df.columns if c not in targets]
    return joined.select(*kept, *[F.col(f"_new_{t}").alias(t) for t in targets])


def keep_if_valid(df: DataFrame, column: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Null out values that the dimension does not know."""
    valid = dimension.select(F.col(dimension_key).alias("_valid"))
    joined = df.join(valid, on=F.col(column) == F.col("_valid"), how="left")
    return joined.select(*[F.col("_valid").alias(c) if c == column else F.col(c) for c in df.columns])


def unmatched(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key is present but unknown on the right."""
    side = right.select(*[F.col(r).alias(f"_{r}") for r in on.values()])
    condition = [F.col(l) == F.col(f"_{r}") for l, r in on.items()]
    return left.dropna(subset=list(on.keys())).join(side, on=condition, how="left_anti")


def unmatched_counts(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Unknown keys with their row counts; rows collapse to keys before any shuffle."""
    keys = list(on.keys())
    return unmatched(left.groupBy(*keys).agg(F.count("*").alias("n")), right, on)
