"""Table sources and sinks: CSV with typed columns, null tokens, text-encoded score maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a CSV cell may hold for "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# How cells are quoted, and how text keeps to one line.
CSV_CELLS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
LINE_CODES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))
EMPTY_CODE = "\\e"


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    null_tokens: Iterable[str] = NA_TOKENS,
    strict: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header row; null tokens become NULL before the columns take their types.

    Blanks around a cell belong to it, a quote inside a quoted cell is doubled. Give ``schema`` on large inputs: without it
    one extra pass finds, for every column at once, whether all its values are integers or numbers. A cell that does not fit
    the schema is NULL, or an error with ``strict``. Cells with line breaks need ``multiLine=True``, which reads each file in
    one task; ``write_csv_table`` writes such breaks so that ``read_written_csv`` needs none of that.
    """
    options = CSV_CELLS | options
    names = schema.fieldNames() if schema else spark.read.options(header=True, **options).csv(path).columns
    raw_schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    raw = spark.read.schema(raw_schema).options(header=True, enforceSchema=schema is None, **options).csv(path)
    raw = replace_null_tokens(raw, null_tokens)
    types = {f.name: f.dataType.simpleString() for f in schema} if schema else infer_types(raw)
    return raw.select(*[_typed(c, types[c], strict).alias(c) for c in raw.columns])


def _typed(name: str, kind: str, strict: bool) -> Column:
    value = F.col(_q(name))
    if kind == "string":
        return value
    typed = value.try_cast(kind)
    if strict:
        said = F.concat(F.lit(f"column {name} holds no {kind}: "), value)
        typed = F.when(value.isNotNull() & typed.isNull(), F.raise_error(said).cast(kind)).otherwise(typed)
    return typed


def infer_types(raw: DataFrame) -> dict[str, str]:
    """bigint, double or string per column of an all-string table, from one aggregate; all-null columns are double."""
    checks = []
    for name in raw.columns:
        value = F.col(_q(name))
        for kind in ("bigint", "double"):
            misfit = value.isNotNull() & value.try_cast(kind).isNull()
            checks.append((~F.bool_or(misfit)).alias(f"{kind}|{name}"))
        checks.append((F.count(value) > 0).alias(f"any|{name}"))
    found = raw.agg(*checks).first().asDict()
    types = {}
    for name in raw.columns:
        fits = [kind for kind in ("bigint", "double") if found[f"{kind}|{name}"]]
        types[name] = (fits[0] if found[f"any|{name}"] else "double") if fits else "string"
    return types


def write_csv_table(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with CSV parts; map, array and struct columns are written as JSON text.

    Text keeps its blanks, quotes and backslashes. A line feed is written as ``\\n``, a carriage return as ``\\r`` and a
    backslash as two, so that every row is one line and large files can be split. Empty text is ``\\e``, to tell it from
    missing. ``read_written_csv`` turns them back.
    """
    nested = (T.MapType, T.ArrayType, T.StructType)

    def cell(field: T.StructField) -> Column:
        value = F.col(_q(field.name))
        if isinstance(field.dataType, nested):
            value = F.to_json(value)
        elif not isinstance(field.dataType, T.StringType):
            return value
        for sign, code in LINE_CODES:
            value = F.replace(value, F.lit(sign), F.lit(code))
        return F.when(value == "", EMPTY_CODE).otherwise(value)

    flat = df.select(*[cell(f).alias(f.name) for f in df.schema])
    flat.write.mode("overwrite").options(header=True, **CSV_CELLS).csv(path)


def read_written_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """A table as ``write_csv_table`` has written it; only an empty cell is NULL."""
    raw = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in schema.fieldNames()])).options(
        header=True, **CSV_CELLS).csv(path)
    decoded = [F.transform(F.split(F.col(_q(f.name)), r"\\\\"), lambda part: F.replace(F.replace(
        part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))) for f in schema]
    texts = raw.select(*[F.when(F.col(_q(f.name)) == EMPTY_CODE, "").otherwise(F.array_join(parts, "\\")).alias(f.name)
                         for parts, f in zip(decoded, schema)])
    return texts.select(*[
        (F.from_json(F.col(_q(f.name)), f.dataType) if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
         else _typed(f.name, f.dataType.simpleString(), strict)).alias(f.name) for f in schema])


def replace_null_tokens(
    df: DataFrame, tokens: Iterable[str] = ("?",), recast: Mapping[str, str] | None = None
) -> DataFrame:
    """NULL in place of the given tokens in every string column; ``recast`` gives columns their new type."""
    tokens = list(tokens)
    recast = recast or {}
    out = []
    for field in df.schema:
        value = F.col(_q(field.name))
        if isinstance(field.dataType, T.StringType):
            value = F.when(~value.isin(tokens), value)
        if field.name in recast:
            value = value.try_cast(recast[field.name])
        out.append(value.alias(field.name))
    return df.select(*out)


def ingest(df: DataFrame, key: str | None = "customer_id") -> DataFrame:
    """NaN becomes NULL in every floating column and rows without a key are left out."""
    floating = (T.DoubleType, T.FloatType)
    out = df.select(
        *[
            F.nanvl(F.col(_q(f.name)), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(_q(f.name))
            for f in df.schema
        ]
    )
    return out.filter(F.col(key).isNotNull()) if key else out


def parse_score_map(text: Column) -> Column:
    """Text such as ``{'gold': 0.7, 'silver': 0.2}`` as a map, keys in written order; single quotes are fine."""
    return F.from_json(text, "map<string,double>", {"allowSingleQuotes": "true"})


def candidate_names(text: Column) -> Column:
    """Offer names of a score-map text in written order."""
    return F.map_keys(parse_score_map(text))


def _q(name: str) -> str:
    return f"`{name}`"
