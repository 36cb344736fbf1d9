"""Join helpers with an explicit size check before any broadcast.

A broadcast copies one side to every executor; it is only safe when that side
has a proven bound in bytes.  ``measured`` counts the side's rows and the
longest value of each of its text columns in one aggregate job; rows times the
widest possible row is the bound.  Beyond it the join is left to the planner:
a shuffled sort-merge join, which AQE may still turn into a broadcast at run
time from real shuffle sizes, and whose skewed partitions AQE splits
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
_CONF_KEY = "strata.broadcast.maxBytes"
#: Bytes of a text column that the measured source does not have: a hexadecimal digest at most.
DERIVED_TEXT_BYTES = 64
#: Keys that a salted join spreads at most.
HOT_KEYS = 1024


def max_broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(_CONF_KEY, str(DEFAULT_MAX_BROADCAST_BYTES)))


def measured(df: DataFrame) -> tuple[int, dict[str, int]]:
    """(rows, longest value in bytes per text column); remembered on the DataFrame object."""
    seen = getattr(df, "_strata_measured", None)
    if seen is None:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        row = df.agg(F.count(F.lit(1)), *[F.coalesce(F.max(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in texts]).first()
        df._strata_measured = seen = (int(row[0]), dict(zip(texts, (int(x) for x in row[1:]))))
    return seen


def byte_bound(df: DataFrame, source: DataFrame | None = None) -> int:
    """An upper bound of the bytes of ``df``, whose rows are no more than those of ``source``."""
    rows, longest = measured(source if source is not None else df)

    def width(f: T.StructField) -> int:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return 8 + longest.get(f.name, DERIVED_TEXT_BYTES)
        return 16  # any of the fixed-width types used as dimensions here
    return rows * sum(map(width, df.schema.fields))


def set_bound(df: DataFrame, source: DataFrame) -> DataFrame:
    """Record that ``source`` has at least as many rows as ``df`` (e.g. the master under a hub)."""
    df._strata_bound = source
    return df


def bound_of(df: DataFrame) -> DataFrame | None:
    return getattr(df, "_strata_bound", None)


def set_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Record that ``df`` has one row per ``keys``."""
    df._strata_unique = frozenset(keys)
    return df


def is_unique(df: DataFrame, keys: list[str]) -> bool:
    return getattr(df, "_strata_unique", None) == frozenset(keys)


def maybe_broadcast(df: DataFrame, max_bytes: int | None = None,
                    bound_source: DataFrame | None = None) -> DataFrame:
    """Broadcast hint only when the size is proven below the bound.

    ``bound_source`` (or one recorded with ``set_bound``) is a cheaper plan
    whose row count bounds ``df``, such as the raw master scan under a
    ``distinct``.
    """
    cap = max_broadcast_bytes(df.sparkSession) if max_bytes is None else max_bytes
    source = bound_source if bound_source is not None else bound_of(df)
    return F.broadcast(df) if byte_bound(df, source) <= cap else df


def hot_keys(big: DataFrame, key: str, salts: int) -> list[int]:
    """Hashes of the keys of ``big`` with the most rows: at most ``HOT_KEYS`` of them, each of at least ``salts`` rows.

    Rows are counted per hash in the map tasks first.  Any other key holds less
    than one row in ``HOT_KEYS``, or too few to stand in every salt.
    """
    counts = big.groupBy(F.xxhash64(key).alias("__hash")).agg(F.count(F.lit(1)).alias("__n"))
    return [r[0] for r in counts.where(F.col("__n") >= salts).orderBy(F.desc("__n")).limit(HOT_KEYS).collect()]


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int,
                how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` where one key may hold a large share of ``big``.

    ``big`` rows of a hot key (``hot_keys``) get a salt in ``[0, salts)`` from
    their place in their partition, not from their values, so equal rows spread
    too; a retried task reads its rows in the same order and sends each where
    it went before.  Rows of ``small`` (unique per key, e.g. a link or hub
    table) are replicated once per salt where their key is hot, and only there:
    ``small`` may have as many keys as ``big`` has rows.  Each hot key is then
    spread over ``salts`` shuffle partitions instead of one, at the cost of a
    count of the keys and ``salts`` copies of at most ``HOT_KEYS`` keys.  Which
    keys are hot decides no row: both sides take it from the same hashes.
    Results equal the plain join.  AQE's skew-join splitting does the same for
    sort-merge joins at run time; this is the explicit form for sessions or
    joins where AQE cannot split.
    """
    if salts <= 1:
        return big.join(small, key, how)
    # Hashes of equal keys are equal for one type only; else every key is spread.
    same = big.schema[key].dataType == small.schema[key].dataType
    hot = F.xxhash64(key).isin(hot_keys(big, key, salts)) if same else F.lit(True)
    place = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    b = big.withColumn("_salt", F.when(hot, place).otherwise(0))
    s = small.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return b.join(s, [key, "_salt"], how).drop("_salt")
