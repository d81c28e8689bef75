"""Typing, cleaning and keying a raw table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabloom.functions import text
from tabloom.functions.calendar import parse_time
from tabloom.operators.ordered import number_rows

# What counts as a number when text is coerced.
NUMBER_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))$"


def col(name: str) -> Column:
    """Column by exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def existing(df: DataFrame, names: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [n for n in names if n in present]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise KeyError(f"Missing columns: {missing}")


def check_fractions(*fractions: float) -> None:
    if abs(sum(fractions) - 1.0) >= 1e-9:
        raise ValueError(f"Split shares {fractions} add up to {sum(fractions)}; they must sum to 1")


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate present in df when case, spaces and punctuation are ignored."""
    wanted = [text.alnum_name(c) for c in candidates]
    found = sorted((wanted.index(key), -place, c) for place, c in enumerate(df.columns) if (key := text.alnum_name(c)) in wanted)
    return found[0][2] if found else None


def numeric_and_categorical(df: DataFrame, *, skip: Iterable[str] = (), booleans_numeric: bool = True) -> tuple[list[str], list[str]]:
    skipped = set(skip)
    kinds = (T.NumericType, T.BooleanType) if booleans_numeric else (T.NumericType,)
    fields = [f for f in df.schema.fields if f.name not in skipped]
    numeric = [f.name for f in fields if isinstance(f.dataType, kinds)]
    taken = set(numeric)
    return numeric, [f.name for f in fields if f.name not in taken]


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def standardize_text(df: DataFrame, tokens: tuple[str, ...] = text.NULL_TOKENS) -> DataFrame:
    """Trim every text column and turn null tokens into nulls."""
    return df.select(
        *(
            text.null_if_token(col(f.name), tokens).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)
            for f in df.schema.fields
        )
    )


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number gives null."""
    value = text.strip(c.cast("string"))
    return F.when(value.rlike(NUMBER_TEXT), value.try_cast("double"))


def coerce_types(df: DataFrame, *, time_cols: Sequence[str] = (), number_cols: Sequence[str] = ()) -> DataFrame:
    """Best-effort typing of the named columns that exist; values that cannot be read become null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    typed: dict[str, Column] = {}
    for name in existing(df, time_cols):
        if not isinstance(types[name], (T.TimestampType, T.TimestampNTZType)):
            typed[name] = parse_time(col(name))
    for name in existing(df, number_cols):
        typed[name] = col(name).cast("double") if isinstance(types[name], T.NumericType) else to_number(col(name))
    return df.withColumns(typed) if typed else df


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.dropna(subset=[target])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def invalid_time_count(df: DataFrame, time_col: str) -> int:
    return df.agg(F.count_if(col(time_col).isNull())).first()[0]


def drop_invalid_times(df: DataFrame, time_col: str) -> tuple[DataFrame, int]:
    """Rows with a readable time, and how many rows were dropped."""
    return df.dropna(subset=[time_col]), invalid_time_count(df, time_col)


def require_times(df: DataFrame, time_col: str) -> DataFrame:
    bad = invalid_time_count(df, time_col)
    if bad:
        raise ValueError(f"No chronological split: {time_col} cannot be read in {bad} rows")
    return df


def add_row_id(df: DataFrame, order_by: Sequence[str], *, name: str = "row_id") -> DataFrame:
    """Leading surrogate key row_000000, row_000001, ... in the order of the given key columns."""
    numbered = number_rows(df, order_by, name="_n")
    return numbered.select(F.format_string("row_%06d", F.col("_n")).alias(name), *(col(c) for c in df.columns))
