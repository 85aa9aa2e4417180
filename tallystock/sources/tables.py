"""Table scans, mapped appends and intermediate datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_scan(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Parquet scan with an explicit column list, so only those columns are read."""
    return spark.read.parquet(path).select(*columns)


def external_scan(spark: SparkSession, table: str, columns: list[str], source: str = "jdbc",
                  **options: str) -> DataFrame:
    """Scan of a second system. With ``jdbc`` pass url, partitionColumn, lowerBound,
    upperBound and numPartitions so that the read is split; file sources take a path."""
    reader = spark.read.format(source).options(**options)
    frame = reader.option("dbtable", table).load() if source == "jdbc" else reader.load(table)
    return frame.select(*columns)


def dataset_write(df: DataFrame, path: str, if_exists: str = "overwrite") -> None:
    """Write an intermediate dataset; ``if_exists`` is ``overwrite`` or ``halt``."""
    modes = {"overwrite": "overwrite", "halt": "errorifexists"}
    df.write.mode(modes[if_exists]).parquet(path)


def dataset_read(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def mapped_rows(df: DataFrame, mapping: dict[str, tuple[str, str]],
                defaults: dict[str, Column] | None = None) -> DataFrame:
    """Rows for a target table: source column -> (target column, type), plus defaults.

    The ANSI cast raises on a value that does not fit, which fails the whole append.
    """
    columns = [F.col(source).cast(type_).alias(target) for source, (target, type_) in mapping.items()]
    columns += [value.alias(name) for name, value in (defaults or {}).items()]
    return df.select(*columns)


def mapped_append(df: DataFrame, mapping: dict[str, tuple[str, str]], path: str,
                  defaults: dict[str, Column] | None = None) -> None:
    """Add rows through a column map. As an append, a second run adds them a second time; where runs may repeat, write by load
    (``plans.file_run``) or reduce to new keys first (``anti_join_new_keys``)."""
    mapped_rows(df, mapping, defaults).write.mode("append").parquet(path)


def bulk_insert(df: DataFrame, target: str, source: str = "parquet", batch_rows: int = 200, **options: str) -> None:
    """Append landing rows; over jdbc they go out in batches, in parallel per partition."""
    writer = df.write.mode("append").format(source).options(**options)
    if source == "jdbc":
        writer.option("dbtable", target).option("batchsize", batch_rows).save()
    else:
        writer.save(target)


def write_fact(df: DataFrame, path: str, key: str = "sk_tiempo", rows_per_file: int = 20_000_000) -> None:
    """Facts are laid out by count date, so a report on one count reads one folder.

    Counts in ``df`` replace their own folders, other counts stay. The rows are rebalanced by
    date: small dates share a writer, and a large one gets as many as its size asks for.
    """
    spread = df.sparkSession.sql(f"SELECT /*+ REBALANCE({key}) */ * FROM {{fact}}", fact=df)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "maxRecordsPerFile", rows_per_file).partitionBy(key).parquet(path)


def store_fact(df: DataFrame, name: str, path: str, buckets: int = 64) -> None:
    """Store a fact as table ``name`` so that facts of the same layout join row by row without a shuffle.

    Rows lie in folders by count (``toma``, a copy of the key, as a bucket key cannot be a folder), and there in as many buckets of
    (count, product). The writers are dealt like the buckets, so each bucket of a count is one file. Facts that are joined need
    the same number of buckets; at scale, a bucket of the largest count should fit a task.
    """
    keys = ["sk_tiempo", "sk_producto"]
    laid = df.withColumn("toma", F.col("sk_tiempo")).repartition(buckets, *keys)
    laid.write.format("parquet").mode("overwrite").partitionBy("toma").bucketBy(buckets, *keys).sortBy(*keys).option(
        "path", path).saveAsTable(name)


def insert_if_absent(target: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Target plus the seed rows whose natural key it does not hold yet.

    The target is first reduced to the keys that the seed has; Spark sends a small seed to it.
    """
    held = target.select(key).join(seed.select(key), key, "left_semi")
    return target.unionByName(anti_join_new_keys(seed, held, [key]), allowMissingColumns=True)


def anti_join_new_keys(candidates: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates whose key is not stored; a null key counts as new.

    The stored side is reduced to distinct keys first, so repeats never travel.
    """
    return candidates.join(stored.select(*keys).distinct(), keys, "left_anti")
