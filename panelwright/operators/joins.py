"""Name matching and merges."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelwright.functions.text import accent_fold, casefold_key, exact_key
from panelwright.session import remove_folder, shared_folder

KEY_RULES: dict[str, Callable[[Column], Column]] = {
    "exact": exact_key,
    "casefold": casefold_key,
    "accent_fold": accent_fold,
}

_KEY = "_name_key"
_DIM_KEY = "_dimension_key"
_ID = "_name_id"
_MISSING = "_missing"


def name_ids(dimension: DataFrame, name: str, id: str, rule: str, unique: bool = True) -> DataFrame:
    """(key, id) of a dimension. ``unique`` keeps the largest id where names share a key,
    which is the row a dictionary built in id order ends up with."""
    keyed = dimension.select(KEY_RULES[rule](F.col(name)).alias(_DIM_KEY), F.col(id).alias(_ID))
    keyed = keyed.where(F.col(_DIM_KEY).isNotNull())
    return keyed.groupBy(_DIM_KEY).agg(F.max(_ID).alias(_ID)) if unique else keyed


def lookup(
    df: DataFrame,
    name: str,
    dimension: DataFrame,
    dimension_name: str = "Name",
    dimension_id: str = "id",
    out: str = "id",
    rule: str = "casefold",
    how: str = "left",
    unique: bool = True,
) -> DataFrame:
    """Add the id of the dimension row whose name matches under the rule.

    ``how="left"`` leaves null where nothing matches, ``"inner"`` drops the row. With
    ``unique=False`` a name matching several dimension rows yields a row for each.
    """
    ids = name_ids(dimension, dimension_name, dimension_id, rule, unique)
    matched = _match(df.withColumn(_KEY, KEY_RULES[rule](F.col(f"`{name}`"))), ids, how)
    return matched.withColumnRenamed(_ID, out)


def _match(keyed: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Join on the key, which is never null in ``ids``.

    The null-safe form keeps the join from reusing the partitioning that made ``ids``
    unique: both sides get an exchange of their own, the shape in which a hot name can be
    split at run time where the dimension is too large to broadcast.
    """
    return keyed.join(ids, keyed[_KEY].eqNullSafe(ids[_DIM_KEY]), how).drop(_KEY, _DIM_KEY)


def unmatched_names(
    df: DataFrame, name: str, dimension: DataFrame, dimension_name: str = "Name", rule: str = "accent_fold"
) -> DataFrame:
    """Distinct names without a match, sorted."""
    keys = dimension.select(KEY_RULES[rule](F.col(dimension_name)).alias(_KEY)).distinct()
    names = df.select(f"`{name}`").distinct()
    keyed = names.withColumn(_KEY, KEY_RULES[rule](F.col(f"`{name}`")))
    return keyed.join(keys, on=_KEY, how="left_anti").drop(_KEY).orderBy(F.col(f"`{name}`"))


@dataclass(frozen=True)
class Match:
    """A column of names, the dimension that knows them, and the column for the id found."""

    name: str
    dimension: DataFrame
    dimension_id: str
    out: str
    dimension_name: str = "Name"
    rule: str = "accent_fold"
    kind: str = "name"  # what an unmatched name is called in the report


@dataclass(frozen=True)
class Matched:
    rows: DataFrame  # with every id
    unmatched: DataFrame  # (kind, name, n_rows)


@contextmanager
def match_and_report(df: DataFrame, matches: Sequence[Match]) -> Iterator[Matched]:
    """Match several columns of names in one pass: the rows with every id, and the names without one.

    Whatever produced the rows runs once. What it made is written to the shared folder, rows that matched
    apart from the names of the others, and removed when the block ends. A row counts for the first of
    its names that is not known, in the order of the matches; names are counted inside each task first.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    found = df
    for m in matches:
        found = lookup(found, m.name, m.dimension, m.dimension_name, m.dimension_id, m.out, m.rule, "left")
    missing = F.coalesce(*[F.when(F.col(f"`{m.out}`").isNull(), F.lit(i)) for i, m in enumerate(matches)], F.lit(-1))
    staged = found.withColumn(_MISSING, missing)
    try:
        staged.write.partitionBy(_MISSING).parquet(path)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged.schema)
        read = spark.read.schema(kinds).parquet(path)
        lost = [
            read.where(F.col(_MISSING) == i).groupBy(F.col(f"`{m.name}`").cast("string").alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(m.kind).alias("kind"), "name", "n_rows")
            for i, m in enumerate(matches)
        ]
        yield Matched(read.where(F.col(_MISSING) == -1).drop(_MISSING), reduce(DataFrame.unionByName, lost))
    finally:
        remove_folder(spark, path)


def outer_merge(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Full outer merge on shared key columns; other shared columns get a suffix per side."""
    shared = [c for c in left.columns if c in right.columns and c not in on]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return left.join(right, on=list(on), how="full_outer")


#: A key with this share of a side's rows, or more, is hot, if these are more than a task's trifle.
HOT_SHARE = 1 / 256
HOT_ROWS = 10_000
_SKETCHED = 4_096  # keys that a task's sketch keeps apart; a key of HOT_SHARE cannot be missed


def hot_keys(
    left: DataFrame, right: DataFrame, on: Sequence[str], share: float = HOT_SHARE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with a share of a side's rows or more, and ``hot_rows``: the key columns, n_left and n_right.

    A frequent-items sketch names candidates by hash, one small sketch a task; their rows are then counted
    exactly, one row a key and task. At most ``1 / share`` keys of each side are hot, so the result is small
    whatever the sides hold. Keys with a null in them match nothing and are never hot.
    """
    hash_of, most = _key_hash(left, on), int(1 / share) + 1
    sides = [df.dropna(subset=list(on)).select(*[f"`{k}`" for k in on]) for df in (left, right)]
    sketched = [
        s.agg(F.call_function("approx_top_k", hash_of, F.lit(most), F.lit(_SKETCHED)).alias("found"), F.count(F.lit(1)).alias("n_rows")).select(
            F.explode("found").alias("top"), "n_rows"
        )
        for s in sides
    ]
    least = F.greatest(F.lit(hot_rows), F.floor(F.col("n_rows") * share))
    likely = sketched[0].union(sketched[1]).where(F.col("top.count") >= least).select(F.col("top.item").alias("_hash")).distinct()
    hashes = [h for (h,) in likely.collect()]
    counted = [s.where(hash_of.isin(hashes)).groupBy(*[f"`{k}`" for k in on]).agg(F.count(F.lit(1)).alias("n")) for s in sides]
    return counted[0].withColumnRenamed("n", "n_left").join(counted[1].withColumnRenamed("n", "n_right"), list(on), "full_outer").fillna(0, ["n_left", "n_right"])


def _key_hash(df: DataFrame, on: Sequence[str]) -> Column:
    """Equal for equal keys, 0.0 and -0.0 too."""
    floats = {k for k in on if isinstance(df.schema[k].dataType, (FloatType, DoubleType))}
    return F.xxhash64(*[F.struct(F.col(f"`{k}`") + 0.0 if k in floats else F.col(f"`{k}`")) for k in on])


def outer_merge_skewed(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    suffixes: tuple[str, str] = ("_x", "_y"),
    cell_rows: int = 1 << 20,
    share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``outer_merge`` for sides in which one key may hold a large part of all rows.

    Spark splits a hot key of an inner join, but not of a full outer one, as it could not tell which rows
    stay alone. So rows go three ways, each row one way only. Those that can match nothing, because a key
    column is null or a hot key is absent from the other side, need no join. Those of hot keys that both
    sides hold all match, so an inner join does: either side is cut into as many lots as its rows need, each
    lot meets each lot of the other side, and no pair of lots makes much more than ``cell_rows`` rows. A row's lot
    hangs on its values and its partition, so a lost task puts it into the same one. The rest has no hot key
    and is merged as usual. Sides are read three times (sketch, counts, merge): stage what
    is costly to make.
    """
    found = hot_keys(left, right, on, share, hot_rows)
    hot = found.withColumn("_hash", _key_hash(left, on)).collect()
    shared = [c for c in left.columns if c in right.columns and c not in on]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    columns = [*[left.schema[k] for k in on], *[f for df in (left, right) for f in df.schema if f.name not in on]]

    def full(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c.name}`") if c.name in df.columns else F.lit(None).cast(c.dataType).alias(c.name) for c in columns])

    whole = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in on])
    parts = [full(left.where(~whole)), full(right.where(~whole))]
    cold = [left.where(whole), right.where(whole)]
    if hot:
        side = max(1, int(cell_rows**0.5))
        counts = [[(getattr(r, n) + side - 1) // side for r in hot] for n in ("n_left", "n_right")]
        kinds = [left.schema[k].dataType for k in on]
        keys = F.array(*[F.struct(*[F.lit(r[k]).cast(t).alias(k) for k, t in zip(on, kinds)]) for r in hot])
        # Only rows whose hash is that of a hot key look for it in the list.
        place = F.array_position(keys, F.struct(*[F.col(f"`{k}`") for k in on]))
        place = F.when(_key_hash(left, on).isin([r["_hash"] for r in hot]), place).otherwise(F.lit(0))
        lots_of = [F.element_at(F.array(*map(F.lit, c)), F.col("_place").cast("int")) for c in counts]
        marked = [s.withColumn("_place", place) for s in cold]
        cold = [m.where("_place = 0").drop("_place") for m in marked]
        mine = [m.where("_place > 0").withColumns({"_own": a, "_other": b}) for m, a, b in zip(marked, lots_of, lots_of[::-1])]
        parts += [full(m.where("_other = 0")) for m in mine]
        lots = []
        for m, s, (own, other) in zip(mine, (left, right), (("_i", "_j"), ("_j", "_i"))):
            values = F.xxhash64(*[F.struct(f"`{c}`") for c in s.columns], F.spark_partition_id())
            every = F.explode(F.sequence(F.lit(0), F.col("_other") - 1)).alias(other)
            dealt = F.pmod(values, F.col("_own").cast("bigint")).cast("int").alias(own)
            lots.append(m.where("_other > 0").select(*[f"`{c}`" for c in s.columns], dealt, every))
        parts.append(full(lots[0].join(lots[1], [*on, "_i", "_j"])))
    parts.append(full(cold[0].join(cold[1], list(on), "full_outer")))
    return reduce(DataFrame.unionByName, parts)


def semi(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """``column IN (SELECT ...)`` over the one column of ``values``."""
    one = values.select(F.col(f"`{values.columns[0]}`").alias("_value"))
    return df.join(one, df[f"`{column}`"] == one["_value"], "left_semi")
