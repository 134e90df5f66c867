"""Table and corpus readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.operators.ranked import ranked
from lexloom.schemas import BRONZE_SCHEMA
from lexloom.sources.scratch import materialize

def read_table(spark: SparkSession, folder: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One Parquet table of a folder, with its own or the given schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet file or directory; Hive partition columns come last.

    Giving a schema pins the types of partition columns, which are otherwise
    inferred again from the directory names.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV with a header line and an explicit schema (no inference pass)."""
    return spark.read.option("header", True).option("dateFormat", date_format).schema(schema).csv(path)


#: Holds the line of a record that does not fit the schema, else NULL.
REJECTED = "_corrupt_record"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines bound to a schema, without an inference pass.

    Every line is a row; one that is no JSON or holds a value of another type has its text in ``REJECTED``.
    """
    fields = [*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField(REJECTED, T.StringType())]
    reader = spark.read.schema(T.StructType(fields)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
    return reader.json(path)


def register_views(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Make tables of a folder addressable by name in ``spark.sql``."""
    for name in names:
        read_table(spark, folder, name).createOrReplaceTempView(name)


#: So many rows are taken in order by the driver; more are put in ranges.
FEW_ROWS = 10_000


def _nth(rows: DataFrame, order: list[str], n: int) -> tuple[Row, int] | None:
    """The n-th row in order and how many rows sort before its value; None if there are fewer."""
    if n <= FEW_ROWS:
        top = rows.orderBy(*order).limit(n).collect()
        return (top[-1], n - top.count(top[-1])) if len(top) == n else None
    numbered = ranked(materialize(rows, "subset-rows"), order_by=order, row_number="__n", rank="__rank")
    last = numbered.filter(F.col("__n") == n).first()
    return last and (last, last["__rank"] - 1)


def first_by_key(df: DataFrame, key: str, n: int, digest_of: str = "text") -> DataFrame:
    """The first ``n`` rows in the order of ``key``, then the digest of the text, then the other columns.

    Keys alone are ranked to find the n-th.  Rows with smaller keys stay where they
    are; of the rows with that key, digests and the other columns are ranked.  Texts
    are filtered in place.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return df.limit(0)
    found = _nth(df.select(key), [key], n)
    if found is None:
        return df
    last, before_last = found
    at_key = F.col(key).eqNullSafe(F.lit(last[key]))
    before = F.lit(False) if last[key] is None else (F.col(key) < F.lit(last[key])) | F.col(key).isNull()
    others = [f for f in df.schema.fields if f.name not in (key, digest_of)]
    position = {"__digest": F.md5(digest_of)}
    position |= {f"__o{i}": F.to_json(F.struct(f.name)) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name) for i, f in enumerate(others)}
    narrow = df.filter(at_key).select(*[c.alias(name) for name, c in position.items()])
    rest = n - before_last
    final, before_final = _nth(narrow, list(position), rest)
    place = F.struct(*[c.alias(name) for name, c in position.items()])
    types = {f.name: f.dataType for f in narrow.schema.fields}
    bound = F.struct(*[F.lit(final[name]).cast(types[name]).alias(name) for name in position])
    # Rows equal to the last one in everything are interchangeable: one of them is repeated.
    copies = F.explode(F.sequence(F.lit(1), F.lit(rest - before_final).cast("int")))
    equal = df.filter(at_key & (place == bound)).limit(1).select(*df.columns, copies.alias("__copy")).drop("__copy")
    return df.filter(before | (at_key & (place < bound))).unionByName(equal)


def read_corpus(
    spark: SparkSession,
    source: str | DataFrame,
    split: str | None = None,
    split_column: str | None = None,
    subset_size: int | None = None,
) -> DataFrame:
    """A corpus in bronze shape.

    ``split`` selects a sub-directory of ``source``, or the rows whose
    ``split_column`` equals it.  ``subset_size`` keeps the first rows in
    ``celex_id`` order: ``None`` is all rows, ``0`` is none.
    """
    if isinstance(source, DataFrame):
        df = source
    elif split is not None and split_column is None:
        df = spark.read.schema(BRONZE_SCHEMA).parquet(f"{source.rstrip('/')}/{split}")
    else:
        df = spark.read.parquet(source)
    if split_column is not None and split is not None:
        df = df.filter(F.col(split_column) == split)
    df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields])
    return df if subset_size is None else first_by_key(df, "celex_id", subset_size)
