"""Lookups: equi-joins against a table with one row per key.

No side is broadcast by force. Spark broadcasts a lookup table whose measured size
is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides,
splitting skewed partitions at run time. ``salt_hot`` spreads frequent keys itself,
for plans in which the run-time split does not apply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.functions.keys import wide_key
from transhume.functions.text import text_of

_KEY = "__lookup_key"
_SALT = "__lookup_salt"
_SALTS = "__lookup_salts"

# Rows of one key that a single task takes without being split.
HOT_ROWS = 1_000_000

# Frequent keys that are salted at most.
MOST_HOT = 100_000

# Keys of a lookup table from which on rows are sifted; Spark broadcasts a table of fewer by its default setting.
SIFT_FROM = 200_000

# Bits of a sieve at most: 8 MB, however large the lookup table is.
SIEVE_BITS = 2**26


def as_lookup_table(
    dim: DataFrame,
    key: str | Column,
    take: dict[str, str | Column],
    text: bool = False,
    last_by: Sequence[str | Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Reduce a table to a key column and the wanted values, one row per key.

    Of several rows per key the last in ``last_by`` order counts. ``unique`` promises
    that keys do not repeat and saves the aggregation.
    """
    column = F.col(key) if isinstance(key, str) else key
    values = {n: F.col(v) if isinstance(v, str) else v for n, v in take.items()}
    rows = dim.filter(column.isNotNull())
    keyed = (text_of(column) if text else column).alias(_KEY)
    if unique:
        return rows.select(keyed, *[v.alias(n) for n, v in values.items()])
    if last_by is None:
        raise ValueError("last_by is needed where keys may repeat")
    picked = F.max_by(F.struct(*[v.alias(n) for n, v in values.items()]), F.struct(*last_by))
    return rows.groupBy(keyed).agg(picked.alias("__v")).select(_KEY, "__v.*")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | Column,
    key: str | Column,
    take: dict[str, str | Column],
    text: bool = False,
    last_by: Sequence[str | Column] | None = None,
    unique: bool = False,
    inner: bool = False,
    required: Sequence[str] = (),
    salt_hot: Column | None = None,
    hot_rows: int = HOT_ROWS,
    hot_in: DataFrame | None = None,
    sift: bool = False,
) -> DataFrame:
    """Bring values of a lookup table to every row; null where nothing matches.

    ``take`` maps new columns to columns of ``dim``; several come with one join, and
    columns of these names that the table has already are replaced.
    ``text`` compares both keys as text. ``inner`` drops rows without a match, and
    ``required`` also those whose named values are null. ``salt_hot`` names what to
    spread the rows of a key by that has more than ``hot_rows`` of them. They are counted in
    ``hot_in``, a table with the key column that needs no earlier lookup, or else in ``df``. ``sift`` drops most rows
    that ``inner`` will drop before they are shuffled, see ``sifted``; it is meant for tables that are stored.
    """
    table = as_lookup_table(dim, key, take, text, last_by, unique)
    for name in required:
        table = table.filter(F.col(name).isNotNull())
    column = F.col(on) if isinstance(on, str) else on
    keyed = text_of(column) if text else column
    how = "inner" if inner else "left"
    if sift and inner:
        df = sifted(df, table, keyed)
    hot = hot_keys(hot_in, keyed, hot_rows, nulls=True) if salt_hot is not None and hot_in is not None else None
    replaced = [n for n in take if n in df.columns]
    if replaced:
        df, keyed = df.withColumn("__key", keyed).drop(*replaced), F.col("__key")
        return _join(df, table, keyed, how, salt_hot, hot_rows, hot).drop("__key")
    return _join(df, table, keyed, how, salt_hot, hot_rows, hot)


def _join(
    df: DataFrame, table: DataFrame, keyed: Column, how: str, salt_hot: Column | None, hot_rows: int,
    hot: DataFrame | None = None,
) -> DataFrame:
    if salt_hot is not None:
        return salted_join(df.withColumn("__on", keyed), table, "__on", salt_hot, how, hot_rows, hot).drop("__on")
    joined = df.join(table, keyed == table[_KEY], how)
    return joined.drop(_KEY)


def sifted(df: DataFrame, table: DataFrame, keyed: Column, at_least: int | None = None) -> DataFrame:
    """Rows whose key may be in a lookup table, for an inner join that drops the few others.

    Each key of the table sets two bits of a sieve, and rows stay whose key finds both of its bits set: none that has
    a match goes. The sieve has 16 bits a key or more, ``SIEVE_BITS`` at most; beyond that more rows
    pass in vain and the join is what it was. It is made in parallel and travels as a scalar subquery. The
    table's keys are counted by a job of their own, and where there are fewer than ``at_least`` (``SIFT_FROM``) nothing is sifted.
    """
    n = table.count()
    if n < max(SIFT_FROM if at_least is None else at_least, 1):
        return df
    bits = min(SIEVE_BITS, max(64, 1 << (16 * n - 1).bit_length()))

    def marks(key: Column) -> list[Column]:
        h = F.xxhash64(key)
        return [m.bitwiseAND(F.lit(bits - 1)) for m in (h, F.shiftrightunsigned(h, 32))]

    def word(mark: Column) -> Column:
        return F.shiftright(mark, 6).cast("int")

    def place(mark: Column) -> Column:
        return mark.bitwiseAND(F.lit(63)).cast("int")

    mark = F.col("mark")
    found = table.select(F.explode(F.array(*marks(F.col(_KEY)))).alias("mark")).select(
        word(mark).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), place(mark)).alias("set")
    )
    # Every word is there, so that its place in the array is its number.
    empty = df.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("set"))
    words = found.unionByName(empty).groupBy("word").agg(F.bit_or("set").alias("set"))
    sieve = words.agg(F.array_sort(F.collect_list(F.struct("word", "set")))["set"]).scalar()
    for m in marks(keyed):
        df = df.filter(F.getbit(F.get(sieve, word(m)), place(m)) == 1)
    return df.filter(keyed.isNotNull())


def lookup_self(
    df: DataFrame,
    on: str,
    key: str,
    take: dict[str, str | Column],
    salt_hot: Column | None = None,
    hot_rows: int = HOT_ROWS,
    hot_in: DataFrame | None = None,
) -> DataFrame:
    """Look up other rows of the same table by its primary key. ``salt_hot`` is as in ``lookup``."""
    return lookup(df, df, on, key, take, unique=True, salt_hot=salt_hot, hot_rows=hot_rows, hot_in=hot_in)


def lookup_two_hop(
    df: DataFrame,
    hops: DataFrame,
    survivors: DataFrame,
    on: str,
    hop_key: str,
    hop_value: str,
    survivor_key: str,
    take: dict[str, str],
    last_by: Sequence[str | Column] | None = None,
    salt_hot: Column | None = None,
    hot_rows: int = HOT_ROWS,
    hot_in: DataFrame | None = None,
    wide: bool = False,
) -> DataFrame:
    """Key → intermediate value → values of the row that survived under that value.

    A null intermediate value meets the survivor whose value is null. The two small
    tables are joined first, so the large one is joined once. The null value is one
    row on the survivors' side. ``wide``: the intermediate values are long texts and are
    compared by digest.
    """
    value = wide_key if wide else F.col
    right = survivors.select(
        value(survivor_key).alias("__s"), *[F.col(v).alias(n) for n, v in take.items()], F.lit(True).alias("__hit")
    )
    left = hops.select(F.col(hop_key).alias("__h"), value(hop_value).alias("__m"), *[c for c in (last_by or [])])
    resolved = left.join(right, left["__m"].eqNullSafe(right["__s"]), "inner")
    names = {n: n for n in take}
    return lookup(
        df, resolved, on, "__h", names, last_by=last_by, unique=last_by is None, salt_hot=salt_hot, hot_rows=hot_rows,
        hot_in=hot_in,
    )


def composite_join(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], take: dict[str, str], unique: bool = False
) -> DataFrame:
    """Inner join on several columns.

    ``unique``: a combination that stands on several rows of ``dim`` is an error. It is found by the job that
    joins, on the side of ``dim``, so planning the join starts no job.
    """
    right = dim.select(*keys, *[F.col(v).alias(n) for n, v in take.items()])
    return df.join(checked_unique(right, keys) if unique else right, list(keys), "inner")


def checked_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a table, with an error as soon as a combination of keys without a null is met twice.

    Rows are summed up by key within tasks first, so a key of many rows is one row a task.
    """
    others = [c for c in dim.columns if c not in keys]
    counted = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(F.lit(0).alias("__"), *others)).alias("__row"))
    known = F.lit(True)
    for k in keys:
        known &= F.col(k).isNotNull()
    shown = F.concat(F.lit("repeated keys: "), F.to_json(F.struct(*keys)))
    alone = F.when(known & (F.col("__n") > 1), F.raise_error(shown).cast("boolean")).otherwise(F.lit(True))
    return counted.filter(alone).select(*[c if c in keys else F.col("__row")[c].alias(c) for c in dim.columns])


def repeated_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that stand on more than one row, with their number of rows."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table, or an error that shows some repeated keys."""
    found = repeated_keys(dim, keys).limit(5).collect()
    if found:
        raise ValueError(f"repeated keys: {[r.asDict() for r in found]}")
    return dim


def exists_in(df: DataFrame, dim: DataFrame, on: str | Column, key: str | Column, text: bool = False) -> DataFrame:
    """Rows whose key is in the table."""
    return _by_existence(df, dim, on, key, text, "left_semi")


def missing_from(df: DataFrame, dim: DataFrame, on: str | Column, key: str | Column, text: bool = False) -> DataFrame:
    """Rows whose key is not in the table, including rows without a key."""
    return _by_existence(df, dim, on, key, text, "left_anti")


def _by_existence(df, dim, on, key, text, how) -> DataFrame:
    left = F.col(on) if isinstance(on, str) else on
    right = F.col(key) if isinstance(key, str) else key
    table = dim.select((text_of(right) if text else right).alias(_KEY))
    return df.join(table, (text_of(left) if text else left) == table[_KEY], how)


def flag_member(df: DataFrame, on: str, listed: DataFrame, key: str, fixed: Sequence[str], flag: str) -> DataFrame:
    """Flag rows whose value is in a fixed list or in a column of another table.

    A row without a value gets a null flag.
    """
    names = listed.filter(F.col(key).isNotNull()).select(F.col(key).alias(_KEY)).distinct().withColumn("__in", F.lit(True))
    joined = df.join(names, F.col(on) == names[_KEY], "left")
    member = F.coalesce(F.col("__in"), F.col(on).isin(list(fixed)) if fixed else F.lit(False))
    return joined.withColumn(flag, F.when(F.col(on).isNotNull(), member)).drop(_KEY, "__in")


def first_value(dim: DataFrame, condition: Column, value: str, order_by: str) -> Column:
    """One value of the first row that meets a condition, as a scalar subquery.

    It is evaluated once and used as a constant; null when no row qualifies.
    """
    return dim.filter(condition).agg(F.min_by(F.col(value), F.col(order_by))).scalar()


def require_value(df: DataFrame, name: str, value: Column, message: str) -> DataFrame:
    """Set a column to a scalar that must not be null."""
    return df.withColumn(name, F.coalesce(value, F.raise_error(F.lit(message))))


def with_template(df: DataFrame, template: DataFrame, columns: Sequence[str], order_by: str) -> DataFrame:
    """Copy the first row of a template table to every row.

    The row travels as a scalar subquery, so the large side is neither joined nor
    shuffled.
    """
    packed = F.struct(*[F.col(f"`{c}`") for c in columns])
    one = template.agg(F.min_by(packed, F.col(order_by))).scalar()
    held = df.withColumn("__t", F.coalesce(one, F.raise_error(F.lit("the template table is empty"))))
    return held.select(*df.columns, *[F.col("__t").getField(c).alias(c) for c in columns])


def hot_keys(
    df: DataFrame, key: str | Column, rows_per_task: int = HOT_ROWS, most: int = MOST_HOT, nulls: bool = False
) -> DataFrame:
    """Keys with more rows than one task should take, and the tasks to spread each over.

    The ``most`` most frequent of them, which bounds what is broadcast; the run-time split of
    skewed partitions is left for keys beyond, at any size of the table. ``nulls``: the missing key counts, too.
    """
    named = df.select((F.col(key) if isinstance(key, str) else key).alias(_KEY))
    named = named if nulls else named.filter(F.col(_KEY).isNotNull())
    counts = named.groupBy(_KEY).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows_per_task)
    first = counts.orderBy(F.desc("__n"), _KEY).limit(most)
    return first.select(_KEY, F.ceil(F.col("__n") / rows_per_task).cast("int").alias(_SALTS))


# Hot keys that a plan holds as a constant; a longer list is joined.
_AS_CONSTANT = 200


def salted_join(
    df: DataFrame,
    table: DataFrame,
    on: str,
    spread_by: Column,
    how: str = "left",
    rows_per_task: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join a lookup table, spreading frequent and missing keys over several tasks.

    Rows of a hot key carry a salt taken from ``spread_by``, and the table's row for that
    key is repeated once per salt; the more rows a key has, the more salts. Rows without
    a key match nothing and are spread at will where they are many. All other keys are joined as they are, and
    without a hot key the join is a plain one. The short list of hot keys is counted once, by a job of its own,
    and brought to the driver, so that neither side of the join repeats the plan of ``df``; ``MOST_HOT`` bounds it.
    ``hot`` is a list to be counted on a narrower table.
    """
    found = (hot_keys(df, on, rows_per_task, nulls=True) if hot is None else hot).collect()
    if not found:
        return df.join(table, F.col(on) == F.col(_KEY), how).drop(_KEY)
    spread, kind = F.xxhash64(spread_by), df.schema[on].dataType
    known = [(r[_KEY], r[_SALTS]) for r in found if r[_KEY] is not None]
    if len(known) <= _AS_CONSTANT:
        salts_of = {key: _constant(known, F.col(key), kind) for key in (on, _KEY)}
        left, right = df.withColumn(_SALTS, salts_of[on]), table.withColumn(_SALTS, salts_of[_KEY])
    else:
        schema = T.StructType([T.StructField("__hot", kind), T.StructField(_SALTS, T.IntegerType())])
        listed = F.broadcast(df.sparkSession.createDataFrame(known, schema))
        left = df.join(listed, F.col(on) == F.col("__hot"), "left").drop("__hot")
        right = table.join(listed, F.col(_KEY) == F.col("__hot"), "left").drop("__hot")
    salt = F.when(F.col(_SALTS).isNotNull(), F.pmod(spread, F.col(_SALTS))).otherwise(F.lit(0))
    if len(known) < len(found):
        salt = F.when(F.col(on).isNull(), F.pmod(spread, F.lit(2**31 - 1))).otherwise(salt)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS) - 1, F.lit(0)))
    left = left.withColumn(_SALT, salt.cast("int")).drop(_SALTS)
    right = right.withColumn("__copy", F.explode(copies)).drop(_SALTS)
    return left.join(right, (F.col(on) == F.col(_KEY)) & (F.col(_SALT) == F.col("__copy")), how).drop(_KEY, _SALT, "__copy")


def _constant(known: list[tuple], key: Column, kind: T.DataType) -> Column:
    """The salts of a key that is hot, else null."""
    if not known:
        return F.lit(None).cast("int")
    pairs = [c for k, n in known for c in (F.lit(k).cast(kind), F.lit(n))]
    return F.try_element_at(F.create_map(*pairs), key)
