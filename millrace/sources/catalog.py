"""Named relations that outlast a session: schemas, external tables and views in the session's catalog.

Tables are external: they describe Parquet datasets that stay where they were written, and dropping
one never deletes a file. Every call may be repeated; what is already registered is only refreshed.
How long an entry lasts is up to the catalog: an application, or as long as a configured metastore.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def quoted(*names: str) -> str:
    return ".".join(f"`{n.replace('`', '``')}`" for n in names)


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")


def described(spark: SparkSession, schema: str, name: str) -> dict[str, str] | None:
    """What the catalog says of a table or view (``Type``, ``Location``, ...); None if there is none."""
    if not spark.catalog.tableExists(quoted(schema, name)):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(schema, name)}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in ("Type", "Location", "Provider")}


def _place(path: str) -> str:
    """A location as the catalog and a caller may both write it."""
    return path.removeprefix("file:").replace("//", "/").rstrip("/")


def register_table(
    spark: SparkSession, schema: str, name: str, path: str, columns: StructType, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Register the Parquet dataset at ``path`` as an external table and return it.

    Partitions are those whose directories exist now: later ones are added and vanished ones dropped by
    registering again. A dataset without a file is an empty table. Where columns or place have changed
    the entry is replaced. A name that holds a managed table is refused, since replacing it
    would delete its data.
    """
    create_schema(spark, schema)
    full = quoted(schema, name)
    body = [f for f in columns.fields if f.name not in partition_by]
    wanted = StructType([*body, *(columns[c] for c in partition_by)])
    known = described(spark, schema, name)
    if known is not None and known.get("Type") == "MANAGED":
        raise ValueError(f"{schema}.{name} is a managed table")
    if known is not None:
        same = known.get("Type") == "EXTERNAL" and _place(known.get("Location", "")) == _place(path)
        if not same or [(f.name, f.dataType) for f in spark.table(full).schema] != [(f.name, f.dataType) for f in wanted]:
            spark.sql(f"DROP {'VIEW' if known.get('Type') == 'VIEW' else 'TABLE'} {full}")
            known = None
    if known is None:
        listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in wanted)
        by = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
        spark.sql(f"CREATE TABLE {full} ({listed}) USING parquet{by} LOCATION {text(path)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {full}")
    return spark.table(full)


def create_view(spark: SparkSession, schema: str, name: str, query: str) -> DataFrame:
    """(Re)create a view; a table of that name is refused by Spark."""
    create_schema(spark, schema)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(schema, name)} AS {query}")
    return spark.table(quoted(schema, name))


def files_query(columns: Sequence[str], paths: Sequence[str]) -> str:
    """SQL over Parquet datasets that together are one relation."""
    listed = ", ".join(map(quoted, columns))
    return " UNION ALL ".join(f"SELECT {listed} FROM parquet.{quoted(p)}" for p in paths)


def relation_names(spark: SparkSession, schemas: Iterable[str]) -> list[tuple[str, str]]:
    """(schema, name) of every lasting relation of the schemas, sorted."""
    found = []
    for schema in schemas:
        if spark.catalog.databaseExists(quoted(schema)):
            rows = spark.sql(f"SHOW TABLES IN {quoted(schema)}").where("not isTemporary").collect()
            found += [(schema, r["tableName"]) for r in rows]
    return sorted(found)


def relation_counts(spark: SparkSession, names: Iterable[tuple[str, str]], cut: str = "") -> DataFrame:
    """(schema_name, table_name, n_rows) of registered relations; ``cut`` is left off the front of schema names."""
    out = None
    for schema, name in names:
        one = spark.table(quoted(schema, name)).agg(F.count("*").alias("n_rows"))
        one = one.select(F.lit(schema.removeprefix(cut)).alias("schema_name"), F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def store_bucketed(df: DataFrame, schema: str, name: str, path: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """Write ``df`` as an external table dealt into ``buckets`` by ``key``, sorted within each, and return it.

    Joins and aggregates by the key then need no exchange on this side, and two such tables with
    equally many buckets none at all. Rows are dealt by the same hash before they are written, so
    that a bucket is one file; ``dealt`` says that they come from a shuffle by the key already.
    """
    spark, full = df.sparkSession, quoted(schema, name)
    create_schema(spark, schema)
    known = described(spark, schema, name)
    if known is not None:
        if known.get("Type") != "EXTERNAL":
            raise ValueError(f"{schema}.{name} is not an external table")
        spark.sql(f"DROP TABLE {full}")
    rows = df if dealt else df.repartition(buckets, key)
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(full)
    return spark.table(full)
