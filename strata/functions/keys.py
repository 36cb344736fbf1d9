"""Hash-key expressions for hub, link and satellite tables.

All of these are built-in Catalyst expressions (no Python at run time), so
they stay inside whole-stage codegen.

Rules kept on purpose:

* A NULL business key gives a NULL hash (``md5(NULL)``, ``concat`` with NULL),
  never the digest of a text such as ``"nan"``; callers route such rows to a
  rejects table.
* Link keys use ``concat`` and never ``concat_ws``: the latter skips NULLs and
  would give two different pairs the same key.
* Floating numbers are hashed through their exact value, written as an integer
  times a power of two (``3.5`` is ``7881299347898368p-51``), so two different
  readings never share a text, and the digest does not depend on how an engine
  prints a double (``1.0E-5`` against ``1e-05``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the key format.
KEY_SEPARATOR = "_"
NULL_TOKEN = "null"
NAN_TOKEN, INFINITY_TOKEN = "nan", "inf"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(c: str | Column) -> Column:
    """Business key as text: ``str(v)`` for integers and strings."""
    return _col(c).cast("string")


def composite_text(*cols: str | Column, sep: str = KEY_SEPARATOR) -> Column:
    """Key parts as text joined by ``sep``; NULL if any part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(key_text(c))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def md5_key(*cols: str | Column, sep: str = KEY_SEPARATOR) -> Column:
    """md5 of the key text (the code path of the reference pipeline)."""
    return F.md5(composite_text(*cols, sep=sep))


def sha256_key(*cols: str | Column, sep: str = KEY_SEPARATOR) -> Column:
    """The documented form: SHA-256 of the key text, each part trimmed and upper-cased."""
    return F.sha2(composite_text(*[F.upper(F.trim(key_text(c))) for c in cols], sep=sep), 256)


def _is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


#: Sizes below the first are scaled by the second, so that every power of two used is finite and normal.
_TINY, _TINY_POWER = 2.0**-900, 300


def _size(x: Column) -> Column:
    """Absolute value of a finite number other than 0, tiny ones scaled up; NULL for anything else."""
    size = F.abs(x)
    return F.when((size > 0) & (size < float("inf")), F.when(size < _TINY, size * 2.0**_TINY_POWER).otherwise(size))


def _guess(size: Column) -> Column:
    """The exponent of two, or one off; 2 to its power is finite."""
    return F.least(F.floor(F.log2(size)), F.lit(1023).cast("bigint"))


def _adjustment(size: Column, power: Column) -> Column:
    """What the guessed exponent is off by: log2 may round across a power of two."""
    return F.when(power > size, -1).when(power * 2 <= size, 1).otherwise(0)


def _number_text(x: Column, size: Column, guess: Column, power: Column, adjustment: Column) -> Column:
    # Dividing by a power of two is exact, so the quotient, in [1, 2), has all 53 bits.
    unit = F.when(adjustment < 0, 2.0).when(adjustment > 0, 0.5).otherwise(1.0)
    digits = (size / power * unit * 2.0**52).cast("bigint").cast("string")
    exponent = (guess + adjustment - F.when(F.abs(x) < _TINY, 52 + _TINY_POWER).otherwise(52)).cast("string")
    sign = F.when(x < 0, "-").otherwise("")
    return (F.when(x.isNull(), F.lit(None)).when(F.isnan(x), F.lit(NAN_TOKEN)).when(x == 0, F.lit("0"))
            .otherwise(F.concat(sign, F.coalesce(F.concat(digits, F.lit("p"), exponent), F.lit(INFINITY_TOKEN)))))


def number_text(c: str | Column) -> Column:
    """Exact, engine-independent text of a double: sign, 53-bit integer, ``p``, exponent of two.

    Zero of either sign is ``0``; NaN and the infinities have tokens of their
    own; NULL stays NULL.  As one expression; ``with_number_texts`` computes
    every part once and is the form for large tables.
    """
    x = _col(c).cast("double")
    size = _size(x)
    guess = _guess(size)
    power = F.pow(F.lit(2.0), guess)
    return _number_text(x, size, guess, power, _adjustment(size, power))


def with_number_texts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` plus ``__text_<name>`` (``number_text``) for each of the floating columns ``names``.

    The parts are columns of their own, one projection after the other.  Each
    is used more than once, so Catalyst keeps the projections apart and every
    part is computed once; as one expression the parts are repeated until the
    generated method is too long to be compiled.
    """
    names, own = list(names), df.columns

    def part(kind: str, c: str) -> Column:
        return F.col(f"`__{kind}_{c}`")

    def stage(kind: str, make) -> None:
        nonlocal df
        df = df.withColumns({f"__{kind}_{c}": make(c) for c in names})

    if names:
        stage("x", lambda c: F.col(f"`{c}`").cast("double"))
        stage("size", lambda c: _size(part("x", c)))
        stage("guess", lambda c: _guess(part("size", c)))
        stage("power", lambda c: F.pow(F.lit(2.0), part("guess", c)))
        stage("off", lambda c: _adjustment(part("size", c), part("power", c)))
        stage("text", lambda c: _number_text(*[part(kind, c) for kind in ("x", "size", "guess", "power", "off")]))
    return df.select(*[F.col(f"`{c}`") for c in own], *[part("text", c) for c in names])


def _joined(texts: list[Column], sep: str) -> Column:
    return F.md5(F.concat_ws(sep, *[F.coalesce(t, F.lit(NULL_TOKEN)) for t in texts]))


def change_hash(df: DataFrame, cols: Iterable[str], sep: str = KEY_SEPARATOR) -> Column:
    """md5 over the attribute texts joined by ``sep``; NULLs become a token first."""
    return _joined([number_text(c) if _is_floating(df, c) else F.col(c).cast("string") for c in cols], sep)


def with_change_hash(df: DataFrame, cols: Iterable[str], name: str, sep: str = KEY_SEPARATOR) -> DataFrame:
    """``df`` plus ``change_hash`` of ``cols`` as ``name``, in projections that the JVM compiles."""
    cols = list(cols)
    floating = [c for c in cols if _is_floating(df, c)]
    texts = [F.col(f"`__text_{c}`") if c in floating else F.col(f"`{c}`").cast("string") for c in cols]
    return with_number_texts(df, floating).withColumn(name, _joined(texts, sep)).drop(*[f"__text_{c}" for c in floating])


#: What stands before a text that is no digest, so that it is longer than one.
_PLAIN = bytes(17)


def packed(text: Column) -> Column:
    """A text as binary, for shuffles: a digest of 32 lower-case hexadecimal digits as its 16 bytes; no two texts give the same."""
    digest = F.unhex(text)
    return (F.when((F.octet_length(text) == 32) & (F.lower(F.hex(digest)) == text), digest)
            .otherwise(F.concat(F.lit(_PLAIN), text.cast("binary"))))


def unpacked(binary: Column) -> Column:
    """The text that ``packed`` gave."""
    return F.when(F.octet_length(binary) == 16, F.lower(F.hex(binary))).otherwise(F.substr(binary, F.lit(len(_PLAIN) + 1)).cast("string"))


def not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
