"""Loading CSV with bad rows kept apart instead of lost: their text, what is wrong, and their file.

A file is parsed once, every field as text. A row is bad if it hasn't as many fields as the schema or
if a field isn't a value of its type; an empty field is a null and fine. Good and bad rows are written
in one pass, and counted while they are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from veracast.sources.lake import LAKE_FORMAT, write_table
from veracast.sources.scratch import fresh_path

WRONG_FIELDS = "number of fields"
_TEXT = "_whole_row"


@dataclass(frozen=True)
class Loaded:
    """What a load came to."""

    rows: int
    rejected: int

    @property
    def rejected_share(self) -> float:
        read = self.rows + self.rejected
        return self.rejected / read if read else 0.0


def _parsed(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def checked_rows(
    spark: SparkSession, csv_path: str, schema: StructType | str, header: bool = True
) -> DataFrame:
    """The schema's columns, ``row_text`` and ``file`` of each row, and ``reason`` where it is bad."""
    schema = _parsed(schema)
    texts = StructType([StructField(f.name, StringType()) for f in schema] + [StructField(_TEXT, StringType())])
    raw = (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _TEXT)
        .option("enforceSchema", True)
        .schema(texts)
        .csv(csv_path)
        .withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), "[^/]*$", 0))
    )

    def typed(field: StructField) -> Column:
        value = F.col(f"`{field.name}`")
        return value if isinstance(field.dataType, StringType) else value.try_cast(field.dataType)

    wrong = [
        F.when(F.col(f"`{f.name}`").isNotNull() & typed(f).isNull(), F.lit(f"{f.name}: {f.dataType.simpleString()}"))
        for f in schema
        if not isinstance(f.dataType, StringType)
    ]
    kinds = F.array_join(F.filter(F.array(*wrong, F.lit(None).cast("string")), F.isnotnull), "; ")
    reason = F.when(F.col(_TEXT).isNotNull(), WRONG_FIELDS).when(kinds != "", kinds)
    whole = F.coalesce(F.col(_TEXT), F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema])))
    return raw.select(
        *[typed(f).alias(f.name) for f in schema],
        whole.alias("row_text"),
        "file",
        reason.alias("reason"),
    )


def load_csv_checked(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    quarantine_path: str,
    schema: StructType | str,
    most_rejected: float = 0.05,
    fmt: str = LAKE_FORMAT,
    header: bool = True,
) -> Loaded:
    """Load the good rows into a table and the bad ones (row_text, reason, file) into another.

    Where more than ``most_rejected`` of the rows are bad the table isn't touched, the bad rows are
    kept all the same, and ``ValueError`` is raised.
    """
    schema = _parsed(schema)
    rows = checked_rows(spark, csv_path, schema, header)
    bad = F.col("reason").isNotNull()
    seen = Observation()
    parsed = rows.withColumn("rejected", bad).observe(
        seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected")
    )
    path = fresh_path(spark, "checked-csv")
    parsed.write.partitionBy("rejected").parquet(path)
    found = Loaded(seen.get["rows"], seen.get["rejected"])
    # The folders tell them apart: neither write reads the other's rows.
    kept = spark.read.schema(parsed.schema).parquet(path)
    write_table(kept.where("rejected").select("row_text", "reason", "file"), quarantine_path, fmt)
    if found.rejected_share > most_rejected:
        raise ValueError(
            f"{found.rejected} of {found.rows + found.rejected} rows of {csv_path} are malformed;"
            f" see {quarantine_path}"
        )
    write_table(kept.where("NOT rejected").select(*schema.names), table_path, fmt)
    return found
