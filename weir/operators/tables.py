"""Destination tables in the catalog: created once, then only widened.

A destination p.d.t is table t of database d. Tables are Parquet, partitioned by the day (or hour, month, year) of
the partition field, with clustering keys as the order within files. A live table's columns, partitioning and
clustering never change but for columns that are added.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.plans.tables import TableError, TableSpec

#: What a table can be partitioned by.
PARTITION_FORMATS = {"HOUR": "yyyy-MM-dd-HH", "DAY": "yyyy-MM-dd", "MONTH": "yyyy-MM", "YEAR": "yyyy"}
PARTITION_TYPES = ("TIMESTAMP", "DATE", "DATETIME")
PARTITION = "_partition"

CREATED, UNCHANGED, ADDED = "created", "unchanged", "added"


@dataclass(frozen=True)
class Ensured:
    result: str
    columns: tuple[str, ...] = ()


def table_name(destination_id: str) -> tuple[str, str, str]:
    """Project, database and table of p.d.t."""
    parts = destination_id.split(".")
    if len(parts) != 3 or not all(parts):
        raise TableError(f"{destination_id} is not project.dataset.table")
    return parts[0], parts[1], parts[2]


def check_partitioning(table: TableSpec) -> None:
    """Whether the table can be created with its partitioning; raises TableError."""
    if table.partition_type is None:
        return
    if table.partition_type not in PARTITION_FORMATS:
        raise TableError(f"{table.name}: partition type {table.partition_type}")
    if table.partition_field is None:
        return
    if table.partition_field not in table.places:
        raise TableError(f"{table.name}: partition field {table.partition_field} is not a column")
    kind = table.columns[table.places[table.partition_field]].type
    if kind not in PARTITION_TYPES:
        raise TableError(f"{table.name}: partition field {table.partition_field} is {kind}")
    if kind == "DATE" and table.partition_type == "HOUR":
        raise TableError(f"{table.name}: a DATE has no hours")


def partition_value(table: TableSpec) -> Column:
    """The partition of a row, as text: of the partition field, or of the time it is written."""
    form = PARTITION_FORMATS[table.partition_type or "DAY"]
    if table.partition_field is None:
        at = F.current_timestamp()
    else:  # row texts part date and time by a space or a T
        at = F.try_to_timestamp(F.replace(F.col(table.partition_field), F.lit("T"), F.lit(" ")))
    return F.coalesce(F.date_format(at, form), F.lit("__null__"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl(table: TableSpec, names: Iterable[str], adding: bool) -> str:
    parts = []
    for f in table.schema():
        if f.name in names:
            column = table.columns[table.places[f.name]]
            text = f"{_quoted(f.name)} {f.dataType.simpleString()}"
            if column.required and not adding:
                text += " NOT NULL"
            if column.default and not adding and f.dataType != T.StringType():
                text += f" DEFAULT {column.default}"
            if column.description:
                text += f" COMMENT {_literal(column.description)}"
            parts.append(text)
    return ", ".join(parts)


def ensure_table(spark: SparkSession, table: TableSpec) -> Ensured:
    """Creates the table, or adds the columns it lacks."""
    _, database, name = table_name(table.name)
    full = f"{_quoted(database)}.{_quoted(name)}"
    if not spark.catalog.tableExists(f"{database}.{name}"):
        check_partitioning(table)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
        columns = _ddl(table, table.places, False)
        parts = ""
        if table.partition_type is not None:
            columns, parts = f"{columns}, {PARTITION} string", f" PARTITIONED BY ({PARTITION})"
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{parts}")
        return Ensured(CREATED)
    live = set(spark.table(f"{database}.{name}").columns)
    lacking = tuple(c.name for c in table.columns if c.name not in live)
    if not lacking:
        return Ensured(UNCHANGED)
    spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({_ddl(table, lacking, True)})")
    return Ensured(ADDED, lacking)


def conform(rows: DataFrame, table: TableSpec) -> DataFrame:
    """Typed rows as the live table's columns: unknown ones dropped, lacking ones null, in its order."""
    spark = rows.sparkSession
    _, database, name = table_name(table.name)
    live = spark.table(f"{database}.{name}").schema
    if table.partition_type is not None:
        rows = rows.withColumn(PARTITION, partition_value(table))
    return rows.select(*[(F.col(_quoted(f.name)) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in live])


def append(rows: DataFrame, table: TableSpec, max_rows_per_file: int = 0) -> None:
    """Appends typed rows to the live table, clustered within files by its keys."""
    _, database, name = table_name(table.name)
    found = conform(rows, table)
    keys = [k for k in table.clustering if k in found.columns]
    if table.partition_type is not None:
        keys = [PARTITION, *keys]
    if keys:
        found = found.sortWithinPartitions(*keys)
    writer = found.write.mode("append").format("parquet")
    if table.partition_type is not None:
        writer = writer.partitionBy(PARTITION)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.saveAsTable(f"{database}.{name}")


def large_rows(outcomes: DataFrame, table: TableSpec) -> DataFrame:
    """A destination's large rows, from their NDJSON, as typed columns; members that are no columns are ignored."""
    rows = outcomes.where((F.col("destination_id") == table.name) & (F.col("outcome") == "large"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in table.schema()])
    text = [f.name for f in schema if f.dataType == T.StringType()]
    parsed = rows.select(F.from_json("large_json", schema).alias("r"), "large_json")
    raw = [F.coalesce(F.get_json_object("large_json", f"$['{n}']"), F.col("r")[n]).alias(n) if n in text else F.col("r")[n].alias(n) for n in schema.names]
    return parsed.select(*raw)
