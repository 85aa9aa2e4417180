"""File discovery, duplicate detection and the logs of files and loads."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystock.operators.windows import first_per_key


def is_workbook_name(name: Column) -> Column:
    """A workbook that is not the lock file of an open one."""
    return name.endswith(".xlsx") & ~name.startswith("~$")


MAX_FILE_BYTES = 2_000_000_000  # beyond that, the content does not fit one cell of the binary reader


def input_paths(df: DataFrame) -> list[str]:
    """Paths of the files behind a reader, from its listing, in one call instead of one for each path."""
    joined = df.sparkSession.sparkContext._jvm.org.apache.hadoop.util.StringUtils.join("\n", df._jdf.inputFiles())
    return [unquote(path) for path in joined.split("\n") if path]


def discover_files(spark: SparkSession, folder: str, pattern: str = "*.xlsx") -> DataFrame:
    """Name, path, size and MD5 of the workbooks in a folder, in name order.

    A file too large to be hashed is listed without a hash and its content is not read. Readers skip files without a byte; these
    come from the listing that the reader holds.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    about = [name.alias("nombre_archivo"), F.col("_metadata.file_path").alias("ruta_origen"), F.col("length").alias("tamanio_bytes")]
    hashed = listed.where(F.col("length") <= MAX_FILE_BYTES).select(*about, F.md5("content").alias("hash_md5"))
    large = listed.where(F.col("length") > MAX_FILE_BYTES).select(*about, F.lit(None).cast("string").alias("hash_md5"))
    names = [(path.rsplit("/", 1)[-1],) for path in input_paths(listed)]
    empty = spark.createDataFrame(names, "nombre_archivo string").join(
        listed.select(name.alias("nombre_archivo")), "nombre_archivo", "left_anti").select(
        "nombre_archivo", F.concat(F.lit(folder.rstrip("/") + "/"), "nombre_archivo").alias("ruta_origen"),
        F.lit(0).cast("bigint").alias("tamanio_bytes"), F.md5(F.lit("")).alias("hash_md5"))
    found = hashed.unionByName(large).unionByName(empty).where(~F.col("nombre_archivo").startswith("~$"))
    # The sort looks at its rows twice: the shuffle before it keeps their hashes, so that each file is read once.
    return found.repartition("nombre_archivo", "ruta_origen").orderBy("nombre_archivo")


def dedupe_files_md5(files: DataFrame, log: DataFrame, order: str) -> DataFrame:
    """Files still to be processed: hash not yet ``Procesado`` in the log, first of its hash in this run.

    Only hashes and names travel. The first of each hash is picked before the shuffle, so a
    hash shared by a third of all files costs one row per task.
    """
    done = log.where(F.col("estado") == "Procesado").select("hash_md5").distinct()
    first = first_per_key(files, ["hash_md5"], [F.col(order)])
    return first.join(done, "hash_md5", "left_anti")


def mark_files(files: DataFrame, accepted: DataFrame, key: str) -> DataFrame:
    """All files with ``duplicado`` set on those that were not accepted."""
    kept = accepted.select(key, F.lit(True).alias("_kept"))
    return files.join(kept, key, "left").withColumn("duplicado", F.col("_kept").isNull()).drop("_kept")


def file_log(events: DataFrame, key: str = "id_archivo_log", order: str = "evento") -> DataFrame:
    """Current row per file from appended open/close events."""
    return first_per_key(events, [key], [F.col(order).desc()]).drop(order)


def load_log(rows: DataFrame, keys: list[str], period: Column, kind: str = "tipo_fila") -> DataFrame:
    """One row per sheet load with its counters, status and period."""
    def of(*kinds: str) -> Column:
        return F.count_if(F.col(kind).isin(*kinds))

    return rows.groupBy(*keys).agg(
        F.count("*").alias("filas_leidas"),
        of("vacia").alias("filas_vacias"),
        of("seccion").alias("filas_seccion"),
        of("dato").alias("filas_insertadas"),
    ).withColumns({"estado": F.lit("Completado"), "periodo_datos": F.date_format(period, "yyyy-MM")})


def run_summary(files: DataFrame, status: str = "estado") -> DataFrame:
    """Counts of processed, duplicate and failed files of a run, in one row."""
    return files.agg(
        F.count_if(F.col(status) == "Procesado").alias("exitosos"),
        F.count_if(F.col(status) == "Duplicado").alias("duplicados"),
        F.count_if(F.col(status) == "Error").alias("errores"),
    )
