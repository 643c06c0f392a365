"""CSV readers and the CSV report writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from riskloom import fixed_values as V
from riskloom.sources.records import assembled_records, files_with_open_quotes

CORRUPT = "_corrupt"
OPTIONS = {"header": True, "escape": '"'}


def accepted_types() -> dict[str, T.DataType]:
    types: dict[str, T.DataType] = {name: T.DoubleType() for name in V.ACCEPTED_COLUMNS}
    types.update({name: T.StringType() for name in V.ACCEPTED_TEXT_COLUMNS})
    types["id"] = T.LongType()
    return types


def rejected_types() -> dict[str, T.DataType]:
    types: dict[str, T.DataType] = {name: T.StringType() for name in V.REJECTED_COLUMNS}
    types["Amount Requested"] = T.DoubleType()
    types["Risk_Score"] = T.DoubleType()
    return types


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_records(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """Every record as text columns, ``_corrupt`` holding those with a wrong number of fields.

    Files in which a quote is left open at the end of a line are cut into
    records first; all others go straight through Spark's reader, which splits
    files into tasks.  Fields are read as text and the parser's column pruning
    is off, so which records are malformed doesn't depend on the query.
    """
    permissive = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, CORRUPT]])
    open_files = files_with_open_quotes(spark, path)
    plain = (spark.read.schema(schema).options(
        columnPruning=False, enforceSchema=False,  # a file with its columns in another order raises
        **permissive, **OPTIONS).csv(path))
    if not open_files:
        return plain
    plain = plain.where(~F.col("_metadata.file_path").isin(open_files))
    records = assembled_records(spark, path, open_files, header)
    ddl = ", ".join(f"{_quoted(name)} string" for name in [*header, CORRUPT])
    # a generated row is parsed once, whatever is asked of its fields; conditions on plain columns would each parse it
    parsed = records.select(F.inline(F.array(F.from_csv("record", ddl, {"escape": '"', **permissive}))))
    return plain.select(*map(_quoted, [*header, CORRUPT])).unionByName(parsed)


def _checked(spark: SparkSession, path: str, types: dict[str, T.DataType]) -> tuple[DataFrame, Column, Column]:
    """Text records of files that have the columns of ``types``; which are cut, which are ill-typed."""
    header = spark.read.options(**OPTIONS).csv(path).columns
    missing = [name for name in types if name not in header]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    fits = F.lit(True)
    for name, kind in types.items():
        if not isinstance(kind, T.StringType):
            column = F.col(_quoted(name))
            fits = fits & (column.isNull() | column.try_cast(kind).isNotNull())
    cut = F.col(CORRUPT).isNotNull()
    return _text_records(spark, path, header), cut, ~cut & ~fits


def _read_known(spark: SparkSession, path: str, types: dict[str, T.DataType],
                observation: Observation | None) -> DataFrame:
    """Well-formed records of CSV files that have at least the columns of ``types``.

    A record may go on over line breaks inside quotes.  Records with a wrong
    number of fields or with text in a number's place are left out and counted:
    once the result has been computed, ``observation`` holds ``n_records``,
    ``n_cut`` and ``n_ill_typed``.  ``malformed_records`` shows them.
    """
    text, cut, ill_typed = _checked(spark, path, types)
    counts = [F.count(F.lit(1)).alias("n_records"), F.count_if(cut).alias("n_cut"),
              F.count_if(ill_typed).alias("n_ill_typed")]
    seen = text.observe(observation if observation is not None else "csv_records", *counts)
    return seen.where(~cut & ~ill_typed).select(
        *[F.col(_quoted(name)).cast(kind).alias(name) for name, kind in types.items()])


def malformed_records(spark: SparkSession, path: str, types: dict[str, T.DataType]) -> DataFrame:
    """(reason, record) of the records that a reader with these ``types`` leaves out.

    The record of one with a wrong number of fields is its text as it stands in
    the file, that of an ill-typed one its fields written as CSV again.
    """
    text, cut, ill_typed = _checked(spark, path, types)
    again = F.to_csv(F.struct(*[F.col(_quoted(name)) for name in text.columns if name != CORRUPT]),
                     {"escape": '"'})
    return text.where(cut | ill_typed).select(
        F.when(cut, "number of fields").otherwise("type").alias("reason"),
        F.coalesce(F.col(CORRUPT), again).alias("record"))


def read_accepted(spark: SparkSession, path: str, observation: Observation | None = None) -> DataFrame:
    """Accepted loans: forty typed columns, rows with an id and a status."""
    loans = _read_known(spark, path, accepted_types(), observation)
    return loans.where(F.col("id").isNotNull() & F.col("loan_status").isNotNull())


def read_rejected(spark: SparkSession, path: str, observation: Observation | None = None) -> DataFrame:
    """Rejected applications under snake-case names, rows with an amount."""
    rejected = _read_known(spark, path, rejected_types(), observation)
    return (rejected.where(F.col("`Amount Requested`").isNotNull())
            .withColumnsRenamed(V.REJECTED_COLUMNS))


def read_points(spark: SparkSession, path: str, observation: Observation | None = None) -> DataFrame:
    """Scorecard points: at least ``feature`` and ``points_per_unit_woe``."""
    types = {"feature": T.StringType(), "points_per_unit_woe": T.DoubleType()}
    return _read_known(spark, path, types, observation)


def write_csv_report(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
