"""Result sinks and the result viewer's two data calls.

Results are written after ``conform`` so stored types follow the contract
whatever the target.  A JDBC overwrite goes to a staging table and replaces
the rows of the result in one transaction, so a failed job leaves the old
rows, and an existing table keeps its declared types and keys.  A preview over
JDBC sends its top-n to the database.  Connection settings come from the
caller.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwise.functions.contracts import CONTRACTS, column_types_ddl, conform, sql_type

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def write_result_parquet(df: DataFrame, base: str, table: str, wide: bool = False) -> None:
    conform(df, table, wide).write.mode("overwrite").parquet(os.path.join(base, table))


def _connection(spark: SparkSession, url: str, properties: dict[str, str] | None):
    """A JDBC connection of the driver process, for table metadata and DDL."""
    jvm = spark._jvm
    given = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        if k == "driver":
            jvm.java.lang.Class.forName(v)
        else:
            given.setProperty(k, v)
    return jvm.java.sql.DriverManager.getConnection(url, given)


def _jdbc_tables(spark: SparkSession, url: str, properties: dict[str, str] | None) -> list[str]:
    connection = _connection(spark, url, properties)
    try:
        found = connection.getMetaData().getTables(connection.getCatalog(), None, "%", None)
        names = set()
        while found.next():
            names.add(found.getString("TABLE_NAME").lower())
        return sorted(names)
    finally:
        connection.close()


def create_result_table(spark: SparkSession, table: str, url: str, properties: dict[str, str] | None = None,
                        wide: bool = False, keys: bool = True) -> None:
    """Create a result table with the contract's types and, with ``keys``, its primary key."""
    key = [c.name for c in CONTRACTS[table] if c.key] if keys else []
    columns = [f"{c.name} {sql_type(c.sql, wide)}{' NOT NULL' if c.name in key else ''}" for c in CONTRACTS[table]]
    if key:
        columns.append(f"PRIMARY KEY ({', '.join(key)})")
    connection = _connection(spark, url, properties)
    try:
        connection.createStatement().execute(f"CREATE TABLE {table} ({', '.join(columns)})")
    finally:
        connection.close()


def _column_names(connection, table: str) -> dict[str, str]:
    """The columns of a database table, by lower-case name, as SQL has to write them."""
    quote = connection.getMetaData().getIdentifierQuoteString().strip()
    ask = connection.createStatement()
    found = ask.executeQuery(f"SELECT * FROM {table} WHERE 1 = 0").getMetaData()
    names = [found.getColumnName(i + 1) for i in range(found.getColumnCount())]
    ask.close()
    return {n.lower(): f"{quote}{n}{quote}" for n in names}


def staging_table(table: str) -> str:
    return f"{table}_staging"


def _swap(spark: SparkSession, table: str, url: str, properties: dict[str, str] | None) -> None:
    """The staged rows take the place of the table's in one transaction."""
    stage = staging_table(table)
    connection = _connection(spark, url, properties)
    try:
        connection.setAutoCommit(False)
        old, new = _column_names(connection, table), _column_names(connection, stage)
        names = [c.name.lower() for c in CONTRACTS[table]]
        run = connection.createStatement()
        try:
            run.executeUpdate(f"DELETE FROM {table}")
            run.executeUpdate(f"INSERT INTO {table} ({', '.join(old[n] for n in names)}) "
                              f"SELECT {', '.join(new[n] for n in names)} FROM {stage}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        run.executeUpdate(f"DROP TABLE {stage}")
        connection.commit()
    finally:
        connection.rollback()   # nothing is open by now, unless the lines above failed
        connection.close()


def write_result_jdbc(df: DataFrame, table: str, url: str, properties: dict[str, str] | None = None,
                      num_partitions: int = 8, batch_size: int = 10000, wide: bool = False,
                      keys: bool = False) -> None:
    """Overwrite one result table over JDBC.

    The rows are written to a staging table by at most ``num_partitions``
    connections and then swapped in: readers see the old rows or the new
    ones, a job that fails leaves the old ones, and running it again starts
    with a new staging table.  ``wide`` as in ``conform``.  ``keys`` declares
    the contract's primary key when the table does not exist yet (a result
    with a NULL or repeated key is then refused by the database, as the
    reference's schema would); later writes keep what the table declares.
    """
    if table not in CONTRACTS:
        raise ValueError(f"unknown result table {table!r}")
    spark = df.sparkSession
    w = (conform(df, table, wide).write.format("jdbc")
         .option("url", url).option("dbtable", staging_table(table))
         .option("createTableColumnTypes", column_types_ddl(table, wide))
         .option("numPartitions", str(num_partitions))
         .option("batchsize", str(batch_size)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("overwrite").save()
    if table.lower() not in _jdbc_tables(spark, url, properties):
        create_result_table(spark, table, url, properties, wide, keys)
    _swap(spark, table, url, properties)


def preview_query(spark: SparkSession, table: str, n: int, url: str, properties: dict[str, str] | None = None) -> str:
    """The first ``n`` rows of a result by its key, NULL last, as the database's SQL (``table`` is a checked name)."""
    columns = CONTRACTS[table]
    by = [c.name for c in columns if c.key] or [c.name for c in columns]
    connection = _connection(spark, url, properties)
    try:
        names = _column_names(connection, table)
    finally:
        connection.close()
    order = ", ".join(f"CASE WHEN {names[k]} IS NULL THEN 1 ELSE 0 END, {names[k]}" for k in map(str.lower, by))
    top = f"LIMIT {int(n)}" if url.startswith(("jdbc:mysql", "jdbc:mariadb", "jdbc:sqlite")) else f"FETCH FIRST {int(n)} ROWS ONLY"
    return f"SELECT {', '.join(names[c.name.lower()] for c in columns)} FROM {table} ORDER BY {order} {top}"


def read_result_jdbc(spark: SparkSession, table: str, url: str,
                     properties: dict[str, str] | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def list_results(spark: SparkSession, base: str | None = None, jdbc_url: str | None = None,
                 properties: dict[str, str] | None = None) -> list[str]:
    """Result tables present - under a Parquet folder (any file system
    Spark can reach, named by a path or a URI), in a database, else in the
    session catalog.  Only names of the contract are listed."""
    if jdbc_url is not None:
        found = _jdbc_tables(spark, jdbc_url, properties)
    elif base is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(base)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = sorted(f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory())
    else:
        found = sorted(t.name for t in spark.catalog.listTables())
    return [n for n in found if n in CONTRACTS]


def preview_frame(df: DataFrame, table: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows of a stored result, in the types it was stored
    with, the contract's column order and a fixed row order (its key, or all
    columns): a top-n, so each task keeps n rows."""
    columns = CONTRACTS[table]
    by = [c.name for c in columns if c.key] or [c.name for c in columns]
    return (df.select(*[F.col(c.name).alias(c.name) for c in columns])
            .orderBy(*[F.col(k).asc_nulls_last() for k in by]).limit(n))


def read_result(spark: SparkSession, table: str, base: str | None = None, jdbc_url: str | None = None,
                properties: dict[str, str] | None = None) -> DataFrame:
    """One stored result from where ``list_results`` found it."""
    if jdbc_url is not None:
        return read_result_jdbc(spark, table, jdbc_url, properties)
    return spark.read.parquet(os.path.join(base, table)) if base is not None else spark.table(table)


def preview(spark: SparkSession, table: str, base: str | None = None, n: int = 100,
            jdbc_url: str | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """Up to ``n`` rows of one stored result.  The name must be a listed
    result; it is never pasted into SQL unchecked."""
    if not _NAME.match(table) or table not in list_results(spark, base, jdbc_url, properties):
        raise ValueError(f"unknown result table {table!r}")
    if jdbc_url is not None:    # the database sends n rows, not the table
        r = spark.read.format("jdbc").option("url", jdbc_url).option("query", preview_query(spark, table, n, jdbc_url, properties))
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        return preview_frame(r.load(), table, n)
    return preview_frame(read_result(spark, table, base, jdbc_url, properties), table, n)


def preview_shape(df: DataFrame) -> tuple[int, int]:
    """V2: rows and columns of a preview (the preview is at most ``n`` rows,
    so the count is bounded)."""
    return df.count(), len(df.columns)
