"""Day-partitioned tables that gain columns as results do."""

import random
import time
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clicksieve.functions import day
from clicksieve.record import EVENT_TIME, LOAD_COLUMN, PARTITION_COLUMN, RECORD_FIELDS
from clicksieve.sinks.folders import escaped, folders, table_location

ALTERED_AT_ONCE = 500  # partitions in one statement


def _quoted(names):
    return ", ".join(f"`{name}`" for name in names)


def quoted(text):
    """A text as a literal of SQL."""
    escaped_text = str(text).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped_text}'"


def create_sample_table(
    spark, table, columns=RECORD_FIELDS, path=None, provider="parquet", partition=PARTITION_COLUMN, batch_column=None
):
    """A text-column table partitioned by day, and first by load where ``batch_column`` is named."""
    partitions = ([batch_column] if batch_column else []) + [partition]
    body = ", ".join(f"`{name}` STRING" for name in [*columns, *partitions])
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({body}) USING {provider} PARTITIONED BY ({_quoted(partitions)}){location}"
    )


def evolve_columns(spark, table, columns, attempts=10):
    """Add to the table, as text, the columns it lacks; returns them. Names match in any case.

    Several writers may add columns at a time, and the catalog keeps the table's
    schema as a whole: an addition fails where another writer was first, and may
    undo or be undone by one that began beside it. So the schema is read again
    after each attempt, until it has all of them.
    """
    added = []
    for attempt in range(attempts):
        spark.catalog.refreshTable(table)
        present = {name.lower() for name in spark.table(table).columns}
        missing = [name for name in columns if name.lower() not in present]
        if not missing:
            return added
        if attempt:
            time.sleep(random.uniform(0, 0.1 * attempt))
        added += [name for name in missing if name not in added]
        fields = ", ".join(f"`{name}` STRING" for name in missing)
        try:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({fields})")
        except AnalysisException as error:
            if "ALREADY_EXISTS" not in (error.getCondition() or ""):
                raise
    raise RuntimeError(f"{table} still lacks some of {columns} after {attempts} attempts")


def evolve_and_append(
    df, table, ts=EVENT_TIME, partition=PARTITION_COLUMN, rebalance=True, batch_column=None, batch_id=None, tz="UTC"
):
    """Insert a result by name into a day-partitioned table, adding the columns it lacks.

    The day comes from ``ts``, in the zone ``tz``, unless the result brings its
    own; ``ts`` is not stored. Table columns the result lacks read NULL.
    ``rebalance`` sizes the files: days of few rows end in few files, a day of
    very many is split.

    With ``batch_column``, by which the table is then partitioned first, the
    rows of one ``batch_id`` are replaced, so a load that runs twice counts
    once. Loads with other names are not touched, and may be written at the same
    time; without ``batch_column`` a table takes one writer at a time.
    """
    spark = df.sparkSession
    if batch_column:
        days = write_load(df, table, batch_id, ts, partition, rebalance, batch_column, tz)
        before = spark.sql(f"SHOW PARTITIONS {table} PARTITION (`{batch_column}` = {quoted(batch_id)})").collect()
        before = {unquote(row[0].split("/")[-1].split("=", 1)[1]) for row in before}
        alter_partitions(spark, table, "DROP IF EXISTS", [(batch_id, d) for d in sorted(before - set(days))], batch_column, partition, ", ")
        add_partitions(spark, table, [(batch_id, d) for d in days if d not in before], batch_column, partition)
        spark.catalog.refreshTable(table)
    else:
        df = _dated(df, ts, partition, tz)
        evolve_columns(spark, table, df.columns)
        if rebalance:
            df = df.hint("rebalance", partition)
        view = f"append_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        try:
            spark.sql(f"INSERT INTO {table} BY NAME SELECT {_quoted(df.columns)} FROM {view}")
        finally:
            spark.catalog.dropTempView(view)
    # The rows are in; a writer beside this one may have undone the columns since.
    evolve_columns(spark, table, [c for c in df.columns if c != ts])


def _dated(df, ts, partition, tz):
    return (df if partition in df.columns else df.withColumn(partition, day(F.col(ts), tz=tz))).drop(ts)


def write_load(df, table, load, ts=EVENT_TIME, partition=PARTITION_COLUMN, rebalance=True, load_column=LOAD_COLUMN, tz="UTC"):
    """Writes a load's files into its folder of the table and returns its days; :func:`add_partitions` shows them.

    Each load has a folder of its own, also for what its tasks leave there
    before they commit, so loads do not meet. What the folder held is replaced.
    """
    spark = df.sparkSession
    df = _dated(df, ts, partition, tz)
    evolve_columns(spark, table, df.columns)
    location, provider = table_location(spark, table)
    named = {c.lower(): c for c in df.columns}
    fields = [f for f in spark.table(table).schema.fields if f.name.lower() != load_column.lower()]
    rows = df.select(
        *[(F.col(f"`{named[f.name.lower()]}`") if f.name.lower() in named else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
    if rebalance:
        rows = rows.hint("rebalance", partition)
    path = f"{location}/{load_column}={escaped(str(load))}"
    rows.write.format(provider).mode("overwrite").partitionBy(partition).save(path)
    return [unquote(name.split("=", 1)[1]) for name in folders(spark, path) if name.startswith(f"{partition}=")]


def add_partitions(spark, table, pairs, load_column=LOAD_COLUMN, partition=PARTITION_COLUMN):
    """Makes the files of ``(load, day)`` pairs visible in the table."""
    alter_partitions(spark, table, "ADD IF NOT EXISTS", pairs, load_column, partition, " ")


def alter_partitions(spark, table, change, pairs, load_column, partition, between):
    """One statement for every so many ``(load, day)`` pairs."""
    for start in range(0, len(pairs), ALTERED_AT_ONCE):
        some = [f"PARTITION (`{load_column}` = {quoted(load)}, `{partition}` = {quoted(value)})" for load, value in pairs[start : start + ALTERED_AT_ONCE]]
        spark.sql(f"ALTER TABLE {table} {change} {between.join(some)}")
