"""Column names, column order and whole-table text coercion."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from touchline.functions.casts import is_infinite_text, to_number, whole_or_zero

PROFILE = "column_name string, has_number boolean, numeric_rows bigint, infinite_rows bigint"


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_name(name: str) -> str:
    # Blanks, slashes and hyphens become '_', brackets vanish.
    return name.lower().translate(str.maketrans({" ": "_", "/": "_", "-": "_", "(": None, ")": None}))


def sanitize_columns(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns share a cleaned name: {clashes}")
    return df.toDF(*names)


def flatten_struct(df: DataFrame, strip: bool = False) -> DataFrame:
    """One level of structs to plain columns `outer_inner`.

    An empty inner name leaves the outer name alone. With `strip`, underscores
    at both ends of every joined name are cut as well.
    """
    picked = []
    for field in df.schema.fields:
        inner = field.dataType.fieldNames() if isinstance(field.dataType, StructType) else [None]
        for name in inner:
            joined = f"{field.name}_{name}" if name else field.name
            source = quoted(field.name) if name is None else quoted(field.name).getField(name)
            picked.append(source.alias(joined.strip("_") if strip else joined))
    return df.select(*picked)


def display_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace("_", " ") for c in df.columns])


def project_existing(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[quoted(c) for c in order if c in df.columns])


def metric_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


def text_columns(df: DataFrame, only: Iterable[str] | None = None,
                 exclude: Iterable[str] = ()) -> list[str]:
    skip, keep = set(exclude), None if only is None else set(only)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in skip
            and (keep is None or f.name in keep)]


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per text column: does any value read as a number, and how many.

    A single pass: one global aggregate, unfolded afterwards.
    """
    names = text_columns(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], PROFILE)
    def row(c: str) -> Column:
        numbers = F.count_if(to_number(quoted(c)).isNotNull())
        return F.struct(F.lit(c).alias("column_name"), (numbers > 0).alias("has_number"),
                        numbers.alias("numeric_rows"), F.count_if(is_infinite_text(quoted(c))).alias("infinite_rows"))
    return df.agg(F.array(*[row(c) for c in names]).alias("_m")).select(F.inline("_m"))


def numeric_text_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Names of the text columns holding at least one number (runs the profile)."""
    found = numeric_profile(df, columns).filter("has_number").select("column_name").collect()
    return [row[0] for row in found]


def coerce_mixed(df: DataFrame, columns: Sequence[str] | None = None,
                 exclude: Sequence[str] = (), profile: Sequence[str] | None = None) -> DataFrame:
    """Every text column with at least one number becomes a whole-number column.

    Values that are no finite number become 0. Pass `profile` (names of the
    columns to coerce) to skip the profiling pass.
    """
    names = text_columns(df, columns, exclude)
    targets = set(numeric_text_columns(df, names) if profile is None else profile) & set(names)
    return df.select(*[whole_or_zero(quoted(c)).alias(c) if c in targets else quoted(c)
                       for c in df.columns])


def recover_from_json(df: DataFrame, fields: Mapping[str, str], json_col: str) -> DataFrame:
    """Fill NULLs of each column from a key of a JSON text column (result: text)."""
    return df.withColumns({
        c: F.coalesce(quoted(c).cast("string"), F.get_json_object(quoted(json_col), f"$.{key}"))
        for c, key in fields.items()})
