"""Bronze readers (SRC-01..09).

Readers never infer schemas by scanning data: a CSV without an explicit
schema is read as text columns and typed leniently during conditioning,
which avoids the extra full pass ``inferSchema`` costs on large inputs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None, null_value: str | None = None) -> DataFrame:
    """SRC-01: header CSV; explicit schema or all-text columns.

    ``null_value`` is the marker written for NULL (then an empty field stays
    an empty string); without it empty fields read as NULL.
    """
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path if isinstance(path, str) else list(path))


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC-02 / SRC-03: Parquet by path or glob (e.g. ``root/*/*/*/*.parquet``)."""
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))


def spread_scan(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal a scan's rows out round-robin to ``partitions`` (default: the cluster's cores).

    For inputs known to arrive as too few splits: a single unsplittable file
    (one Parquet row group, a gzip CSV) is read by one task, and every per-row
    expression up to the first shuffle would run in it.  The caller decides; a
    partitioned lake needs none of it.  Deterministic on retry (Spark sorts
    before a round-robin repartition); filters and column pruning still reach
    the scan below.
    """
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def read_layer_table(spark: SparkSession, base: str, layer: str, table: str) -> DataFrame:
    """SRC-03: ``<base>/<layer>/<table>`` Parquet table."""
    return spark.read.parquet(f"{base.rstrip('/')}/{layer}/{table}")


def read_snapshots(
    spark: SparkSession, table_root: str, fmt: str = "csv", schema: StructType | str | None = None, null_value: str | None = None
) -> DataFrame:
    """SRC-04: every ``dt=<run>`` snapshot under ``table_root`` with its ``dt``.

    ``basePath`` makes ``dt`` a partition column, so a filter on it prunes
    directories; ``dt`` stays text (no type inference on run ids).
    """
    r = spark.read.option("basePath", table_root)
    if fmt == "csv":
        r = r.option("header", True)
        if null_value is not None:
            r = r.option("nullValue", null_value)
    if schema is not None:
        r = r.schema(schema)
    df = r.format(fmt).load(f"{table_root.rstrip('/')}/dt=*")
    return df.withColumn("dt", F.col("dt").cast("string"))


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Paths that exist (checked on the file system, not by reading them)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def read_multi_csv(
    spark: SparkSession,
    paths: Sequence[str],
    fallback_paths: Sequence[str] | None = None,
    schema: StructType | str | None = None,
    null_value: str | None = None,
) -> DataFrame:
    """SRC-05: combine CSV files by column name, tagging each row with its file.

    Absent files are skipped; when none of ``paths`` exists the fallback list
    is tried; when nothing exists a ``FileNotFoundError`` is raised.  Files of
    one header are read by one distributed scan; files whose columns differ in
    order or set are joined by name, with NULL where a file lacks a column.
    ``source_file`` comes from the file metadata column.
    """
    found = existing_paths(spark, paths)
    if not found and fallback_paths:
        found = existing_paths(spark, fallback_paths)
    if not found:
        raise FileNotFoundError("No input files found")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for p in found:  # a header is one line: nothing else of the file is read here
        by_header.setdefault(tuple(spark.read.option("header", True).option("inferSchema", False).csv(p).columns), []).append(p)
    parts = []
    for names, group in by_header.items():
        own = schema if schema is None else _of_header(spark, schema, names)
        parts.append(read_csv(spark, group, own, null_value).withColumn("source_file", F.col("_metadata.file_name")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*[c for c in out.columns if c != "source_file"], "source_file")


def _of_header(spark: SparkSession, schema: StructType | str, names: tuple[str, ...]) -> StructType:
    """``schema`` in a file's column order; a column that the schema lacks is text."""
    full = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    known = {f.name: f for f in full.fields}
    return StructType([known.get(n, StructField(n, StringType())) for n in names])


def jdbc_reader_options(url: str, table: str, properties: dict[str, str] | None = None, partition: dict | None = None) -> dict[str, str]:
    """Options of a parallel JDBC read (``partition`` = column/lower/upper/num)."""
    opts = {"url": url, "dbtable": table}
    opts.update(properties or {})
    if partition:
        opts.update(
            {
                "partitionColumn": partition["column"],
                "lowerBound": str(partition["lower"]),
                "upperBound": str(partition["upper"]),
                "numPartitions": str(partition["num"]),
            }
        )
    return opts


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    tables: Sequence[str],
    properties: dict[str, str] | None = None,
    limit: int | None = None,
    partitions: dict[str, dict] | None = None,
) -> dict[str, DataFrame]:
    """SRC-06: relational extract of several tables, optionally capped (LIM-01).

    Each table is read by range-partitioned parallel queries when a
    partition spec is given for it; ``limit`` is pushed into the source query.
    The two exclude each other: every partition query would apply an unordered
    limit of its own, so rows would repeat or go missing.
    """
    out = {}
    for t in tables:
        if limit and (partitions or {}).get(t):
            raise ValueError(f"{t}: a row limit and a partition spec cannot be combined")
        src = f"(SELECT * FROM {t} LIMIT {int(limit)}) AS q" if limit else t
        opts = jdbc_reader_options(url, src, properties, (partitions or {}).get(t))
        out[t] = spark.read.format("jdbc").options(**opts).load()
    return out


def read_nested_json(
    spark: SparkSession, path: str, key: str = "drugs", multi_line: bool = True, schema: StructType | str | None = None
) -> DataFrame:
    """SRC-07: documents holding an array of flat objects under ``key``.

    ``multi_line`` reads one (possibly pretty-printed) document per file;
    False reads JSON lines.  A missing key is an error, as in the reference.
    With ``schema`` (of a whole document) the files are read once; without it
    Spark infers one in a pass of its own.
    """
    reader = spark.read.option("multiLine", multi_line)
    docs = (reader.schema(schema) if schema else reader).json(path)
    if key not in docs.columns:
        raise KeyError(f"'{key}' key not found in response")
    return docs.select(F.explode(key).alias("_d")).select("_d.*")


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """SRC-09: typed, empty, schema-ready table."""
    return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Files directly under ``folder`` (file-system listing, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(
        st.getPath().toString()
        for st in fs.listStatus(p)
        if st.isFile() and st.getPath().getName().endswith(suffix) and not st.getPath().getName().startswith(("_", "."))
    )
