"""Column helpers shared by all operators. Everything here stays JVM-side.

Arguments are SQL expression text (a column name is the simplest one) or Columns. Text is
preferred: it is parsed in one call, where Column arithmetic needs one driver round trip
per operator.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The characters a plain text strip removes.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

Expr = Column | str


def _col(c: Expr) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip_sql(x: str) -> str:
    """SQL text that removes leading and trailing whitespace of every kind."""
    return f"btrim({x}, {_quoted(WHITESPACE)})"


def title_case_sql(x: str) -> str:
    """Upper-case every letter that follows a non-letter, lower-case the rest.

    ``initcap`` only looks at blanks, which is enough (and cheap) for plain words; text
    with other separators is split into letter and non-letter runs.
    """
    runs = f"regexp_extract_all(lower({x}), '(\\\\p{{L}}+|[^\\\\p{{L}}]+)', 1)"
    return (
        f"CASE WHEN lower({x}) RLIKE '^[a-z ]*$' THEN initcap({x}) "
        f"ELSE array_join(transform({runs}, run -> initcap(run)), '') END"
    )


def lookup_sql(x: str, mapping: Mapping[str, str]) -> str:
    """Case-insensitive alias lookup of stripped text; NULL for anything that is not listed."""
    pairs = ", ".join(_quoted(word) for pair in mapping.items() for word in pair)
    return f"try_element_at(map({pairs}), lower({x}))"


def strip(x: str) -> Column:
    return F.expr(strip_sql(x))


def capitalize(x: str) -> Column:
    """First character upper-case, all others lower-case, blanks untouched."""
    return F.expr(f"concat(upper(substring({x}, 1, 1)), lower(substring({x}, 2)))")


def rnd(c: Expr, digits: int) -> Column:
    """Round half away from zero on the decimal text of a double.

    Going through DECIMAL makes ties such as 1.005 behave the same on every engine.
    """
    if isinstance(c, str):
        return F.expr(f"cast(round(cast({c} as decimal(28,8)), {digits}) as double)")
    return F.round(c.cast("decimal(28,8)"), digits).cast("double")


def as_double(c: Expr) -> Column:
    return _col(c).cast("double")


def ratio(num: Expr, den: Expr) -> Column:
    """num / den as double, NULL when the denominator is zero or NULL."""
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(f"cast({num} as double) / nullif(cast({den} as double), 0)")
    return as_double(num) / F.nullif(as_double(den), F.lit(0.0))


def pct(num: Expr, den: Expr, digits: int = 2) -> Column:
    """Rounded percentage, NULL when the denominator is zero."""
    if isinstance(num, str) and isinstance(den, str):
        return rnd(f"cast({num} as double) * 100.0D / nullif(cast({den} as double), 0)", digits)
    return rnd(as_double(num) * 100.0 / F.nullif(as_double(den), F.lit(0.0)), digits)


def ratio_or_zero(num: str, den: str, digits: int) -> Column:
    """Rounded num / den where the denominator is positive, else 0.0."""
    value = f"cast({num} as double) / cast({den} as double)"
    rounded = f"cast(round(cast({value} as decimal(28,8)), {digits}) as double)"
    return F.expr(f"CASE WHEN {den} > 0 THEN {rounded} ELSE 0.0D END")


def count_where(cond: Expr) -> Column:
    return F.count_if(_col(cond))


def sum_where(cond: Expr, value: str) -> Column:
    """Conditional sum that is 0, not NULL, when nothing matches."""
    if isinstance(cond, str):
        return F.expr(f"sum(CASE WHEN {cond} THEN {value} ELSE 0 END)")
    return F.sum(F.when(cond, F.expr(value)).otherwise(F.lit(0)))


def money_as_double(df: DataFrame) -> DataFrame:
    """Present exact decimal columns as doubles at the very end of a report."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, T.DecimalType) for f in fields):
        return df
    return df.selectExpr(
        *[
            f"cast(`{f.name}` as double) as `{f.name}`"
            if isinstance(f.dataType, T.DecimalType)
            else f"`{f.name}`"
            for f in fields
        ]
    )
