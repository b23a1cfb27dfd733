"""Scalar column functions and row-wise projections (B*, C*).

All are built-in expressions (whole-stage codegen, no Python on the data
path). Predicates follow the null rule of the reference: a comparison with a
missing value is *false*, so every mask is wrapped in ``coalesce(mask, false)``
before it is negated or used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "Unknown"


def c(x: str | Column) -> Column:
    return F.col(f"`{x}`") if isinstance(x, str) else x


def is_true(x: str | Column) -> Column:
    """Null-safe truth: null -> false (pandas mask semantics)."""
    return F.coalesce(c(x), F.lit(False))


def zero_if_null(x: str | Column) -> Column:
    return F.coalesce(c(x), F.lit(0.0))


# --------------------------------------------------------------------- B1/B2
def split_cabin(df: DataFrame, col: str = "Cabin", deck: str = "Deck",
                number: str = "CabinNumber", side: str = "Side",
                unknown: str = UNKNOWN, number_default: int | None = 0,
                sep: str = "/") -> DataFrame:
    """B1 (number_default=0) / B1b (number_default=None): ``D/N/S`` into three columns."""
    src = c(col)
    num = F.split_part(src, F.lit(sep), F.lit(2)).try_cast("int")
    num_out = F.when(src.isNull(), F.lit(number_default).cast("int")).otherwise(num)
    return df.withColumns({
        deck: F.coalesce(F.split_part(src, F.lit(sep), F.lit(1)), F.lit(unknown)),
        number: num_out,
        side: F.coalesce(F.split_part(src, F.lit(sep), F.lit(3)), F.lit(unknown)),
    })


def group_key(id_col: str = "PassengerId", sep: str = "_") -> Column:
    """B2: the text before the first separator (kept as a string)."""
    return F.substring_index(c(id_col), sep, 1)


def split_group_key(df: DataFrame, id_col: str = "PassengerId", out: str = "TravelGroup",
                    sep: str = "_") -> DataFrame:
    return df.withColumn(out, group_key(id_col, sep))


# --------------------------------------------------------------------- B3/B4
def total(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [zero_if_null(x) for x in cols])


def positive_count(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [(zero_if_null(x) > 0).cast("int") for x in cols])


def spend_totals(df: DataFrame, cols: list[str], total_col: str = "TotalSpending",
                 has_col: str = "HasSpending", cats_col: str = "SpendingCategories",
                 log_col: str = "TotalSpending_Log") -> DataFrame:
    """Row total (null=0), any-spend flag, count of positive columns, log1p."""
    df = df.withColumn(total_col, total(cols))
    return df.withColumns({
        has_col: (F.col(total_col) > 0).cast("int"),
        cats_col: positive_count(cols),
        log_col: F.log1p(F.col(total_col)),
    })


def row_any_positive(cols: list[str]) -> Column:
    """any(col > 0) with null as 0."""
    return reduce(lambda a, b: a | b, [zero_if_null(x) > 0 for x in cols])


def row_all_zero(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [zero_if_null(x) == 0 for x in cols])


# --------------------------------------------------------------------- B5
# Age category limits (left-closed) and labels.
AGE_BINS = [(13, "Child"), (18, "Teen"), (30, "YoungAdult"), (60, "Adult")]
AGE_TOP = "Senior"


def age_category(age: str | Column = "Age", bins=AGE_BINS, top: str = AGE_TOP,
                 unknown: str = UNKNOWN) -> Column:
    a = c(age)
    expr = F.when(a.isNull(), F.lit(unknown))
    for limit, label in bins:
        expr = expr.when(a < limit, F.lit(label))
    return expr.otherwise(F.lit(top))


# --------------------------------------------------------------------- B6/B7
def tri_state(col: str | Column, unknown_value: int = -1) -> Column:
    """True -> 1, false -> 0, null/unknown -> ``unknown_value`` (-1 or 0)."""
    x = c(col)
    return F.when(x, F.lit(1)).when(~x, F.lit(0)).otherwise(F.lit(unknown_value)).cast("int")




def side_code(col: str | Column = "Side", mapping: dict | None = None) -> Column:
    """P -> 0, S -> 1, else -1."""
    mapping = mapping or {"P": 0, "S": 1}
    x = c(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == k, F.lit(v)) if expr is None else expr.when(x == k, F.lit(v))
    return expr.otherwise(F.lit(-1)).cast("int")


# --------------------------------------------------------------------- B8-B13
def route(a: str = "HomePlanet", b: str = "Destination", sep: str = "_to_",
          unknown: str = UNKNOWN) -> Column:
    """``a || sep || b`` with null -> 'Unknown' (plain concat_ws would skip nulls)."""
    return F.concat(F.coalesce(c(a), F.lit(unknown)), F.lit(sep), F.coalesce(c(b), F.lit(unknown)))


def ratio_plus_one(num: Column, den: Column) -> Column:
    """``num / (den + 1)``; the +1 keeps it defined for zero totals."""
    return num / (den + F.lit(1))


def spend_entropy(cols: list[str], total_col: str | Column = "TotalSpending", eps: float = 1e-10) -> Column:
    """Shannon entropy (natural log) of the spend mix; 0 when nothing was spent."""
    t = c(total_col)
    terms = []
    for x in cols:
        p = zero_if_null(x) / (t + F.lit(eps))
        terms.append(F.when(p > 0, -p * F.log(p)).otherwise(F.lit(0.0)))
    return F.when(t > 0, reduce(lambda a, b: a + b, terms)).otherwise(F.lit(0.0))


def spend_profile(cols: list[str]) -> Column:
    """K-character 0/1 usage string."""
    return F.concat(*[F.when(zero_if_null(x) > 0, F.lit("1")).otherwise(F.lit("0")) for x in cols])


def flag(cond: Column) -> Column:
    """A null-safe 0/1 INT indicator."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def last_token(col: str | Column = "Name") -> Column:
    """Last whitespace-separated token; blank or null -> null."""
    return F.nullif(F.regexp_extract(c(col), r"(\S+)\s*$", 1), F.lit(""))


# --------------------------------------------------------------------- B14-B17
def drop_if_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop listed columns; missing ones are ignored."""
    present = [x for x in cols if x in df.columns]
    return df.drop(*present)


def bool_to_int(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Boolean columns (all, or the listed ones) -> INT 0/1."""
    targets = cols if cols is not None else [f.name for f in df.schema.fields
                                             if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({x: c(x).cast("int") for x in targets}) if targets else df


def normalise_name(name: str) -> str:
    return name.replace(" ", "_")


def align_schema(df: DataFrame, feature_cols: list[str], keep: list[str] | None = None,
                 fill_value=0) -> DataFrame:
    """Reorder to ``feature_cols``, add missing ones as ``fill_value``, drop extras.

    Names are matched exactly first, then through space/underscore normalisation.
    """
    have = {x: x for x in df.columns}
    norm = {normalise_name(x): x for x in df.columns}
    out = [c(k) for k in (keep or []) if k in have]
    for name in feature_cols:
        src = have.get(name) or norm.get(normalise_name(name))
        out.append(c(src).alias(name) if src else F.lit(fill_value).alias(name))
    return df.select(*out)


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def select_by_type(df: DataFrame, kind: str = "numeric") -> list[str]:
    """Numeric vs categorical columns by declared type (driver-side schema scan)."""
    if kind == "numeric":
        return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType))]


# --------------------------------------------------------------------- C*
def masked_update(target: str | Column, mask: Column, value) -> Column:
    """``df.loc[mask, col] = v`` as an expression."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.when(is_true(mask), v).otherwise(c(target))


def isin_safe(col: str | Column, values: list) -> Column:
    """Membership that is false (not null) for a null input."""
    return F.coalesce(c(col).isin(values), F.lit(False))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """T5: keep NULL only; NaN in float columns becomes NULL."""
    targets = cols or [f.name for f in df.schema.fields
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({x: F.nanvl(c(x), F.lit(None).cast("double")) for x in targets}) if targets else df


def rnd(x: str | Column, d: int = 0) -> Column:
    """Half-up rounding to ``d`` decimals on the binary value: ``round(x * 10^d) / 10^d``.

    Rounding the scaled value puts a tie on the first fractional digit, where
    it is exact in binary, so every engine (and NumPy-style scaling) agrees.
    """
    v = c(x) if isinstance(x, str) else x
    if d == 0:
        return F.round(v, 0)
    scale = float(10 ** d)
    return F.round(v * F.lit(scale), 0) / F.lit(scale)
