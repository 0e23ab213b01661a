"""Scans and sinks: CSV, GeoJSON and catalogue pages, declared tables, append-only partitions, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from ..functions import geometry as G
from ..operators.contracts import Refused, column_gap

KNOWN_CRS = ("EPSG:4326", "EPSG:7844", "EPSG:4283", "EPSG:3577")


def scan_coded_csv(spark: SparkSession, path: str, code_cols: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header; code columns stay text, so leading zeros survive; a byte order mark goes.

    ``types`` declares the other columns (name -> type; values that do not parse are null), and the files are read once.
    Without it they are inferred, which costs a pass more. Records may span lines, so a file is not split: give many files.
    """
    options = {"header": True, "multiLine": True, "escape": '"'}
    text = spark.read.options(**options).csv(path)
    text = text.toDF(*[c.lstrip("﻿") for c in text.columns])
    missing = sorted((set(code_cols) | set(types or {})) - set(text.columns))
    if missing:
        raise Refused(f"missing columns: {missing}")
    if types is None:
        types = {c.lstrip("﻿"): t for c, t in spark.read.options(**options, inferSchema=True).csv(path).dtypes}
    return text.select(*[F.col(f"`{c}`").alias(c) if c in code_cols or c not in types else F.col(f"`{c}`").try_cast(types[c]).alias(c) for c in text.columns])


_GEOMETRY = StructType([StructField("type", StringType()), StructField("coordinates", StringType())])


def scan_features(spark: SparkSession, path: str, id_col: str, crs: str) -> DataFrame:
    """id, rings and box of the polygons of a layer. Unknown CRS are refused.

    A path that ends in .parquet is a table with rings; one in .geojsonl has a feature a line and is read in splits, the
    form for large layers; others are GeoJSON files of one FeatureCollection each, every one read by one task.
    """
    if crs not in KNOWN_CRS:
        raise Refused(f"unknown CRS {crs}")
    if path.endswith(".parquet"):
        rows = spark.read.parquet(path).select(F.col(id_col).cast("string").alias(id_col), F.col("rings").cast(G.RINGS).alias("rings"))
    else:
        feature = StructType([StructField("properties", StructType([StructField(id_col, StringType())])), StructField("geometry", _GEOMETRY)])
        if path.endswith(".geojsonl"):
            f = spark.read.schema(feature).json(path).select(F.struct("properties", "geometry").alias("f"))
        else:
            f = spark.read.schema(StructType([StructField("features", ArrayType(feature))])).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
        f = f.select(F.col(f"f.properties.{id_col}").alias(id_col), "f.geometry.*")
        numbers = lambda depth: F.from_json("coordinates", "array<" * depth + "double" + ">" * depth)
        points = lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
        polygon = F.transform(numbers(3), points)
        multi = F.flatten(F.transform(numbers(4), lambda part: F.transform(part, points)))
        rings = F.when(F.col("type") == "Polygon", polygon).when(F.col("type") == "MultiPolygon", multi)
        rows = f.select(id_col, rings.alias("rings"))
    return rows.select(id_col, "rings", *[v.alias(k) for k, v in G.bounds(F.col("rings")).items()])


ITEM_SCHEMA = "features array<struct<id:string,bbox:array<double>,properties:struct<datetime:string,region_code:string,dataset_version:string>,assets:map<string,struct<href:string,shape:array<int>,blocks:array<int>,data_type:string>>>>"


def scan_catalogue_pages(spark: SparkSession, pattern: str, one_line: bool = False) -> DataFrame:
    """One row per feature of all captured pages; source_id is the name of the page's folder. With one_line a file holds a page a line and is read in splits."""
    pages = spark.read.schema(ITEM_SCHEMA).option("multiLine", not one_line).json(pattern)
    return pages.select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("source_id"), F.explode("features").alias("f")).select("source_id", "f.*")


def scan_daily_grid(df: DataFrame, wanted: DataFrame, keys: list[str], value: str, fill: float | None = None) -> DataFrame:
    """Rows of the wanted cells; fill values and NaN are null."""
    v = F.col(value)
    clean = F.when(F.isnan(v) | (v == F.lit(fill)) if fill is not None else F.isnan(v), None).otherwise(v)
    return df.join(wanted, keys, "left_semi").withColumn(value, clean)


def declared(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns, in order and cast; missing and extra columns are refused."""
    missing, extra = column_gap(df, schema.names)
    if missing or extra:
        raise Refused(f"missing columns {missing}, extra columns {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def null_violations(df: DataFrame, schema: StructType) -> DataFrame:
    from ..operators.contracts import violations

    return violations(df, {f"null_{f.name}": F.col(f.name).isNull() for f in schema.fields if not f.nullable} or {"none": F.lit(False)})


def write_declared(df: DataFrame, path: str, schema: StructType) -> None:
    """Writes a declared table; refuses nulls where the schema has none. One pass checks, one writes; an existing path is an error."""
    from ..operators.contracts import enforce

    out = declared(df, schema)
    enforce(null_violations(out, schema))
    out.write.mode("errorifexists").parquet(path)


def publish(spark: SparkSession, tables: dict[str, tuple[DataFrame, StructType]], root: str) -> None:
    """Writes several tables beside root, then moves them there together: readers see all or none."""
    jvm, staged = spark.sparkContext._jvm, f"{root.rstrip('/')}.staged"
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(jvm.org.apache.hadoop.fs.Path(root)):
        raise Refused(f"{root} exists")
    for name, (df, schema) in tables.items():
        write_declared(df, f"{staged}/{name}", schema)
    fs.rename(jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(root))


def pending_partitions(expected: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, verdict): partitions still to be made, and existing ones that nobody expects."""
    want, have = expected.select(*keys).distinct(), existing.select(*keys).distinct()
    return want.join(have, keys, "left_anti").withColumn("verdict", F.lit("pending")).unionByName(have.join(want, keys, "left_anti").withColumn("verdict", F.lit("stray")))


def next_version(existing: DataFrame | None) -> int:
    if existing is None:
        return 0
    return int(existing.agg(F.coalesce(F.max("part_version"), F.lit(-1))).first()[0]) + 1


def append_partition(df: DataFrame, root: str, keys: tuple[str, ...] = ("collection_id", "year")) -> dict[tuple, int]:
    """Appends rows under a new version number and never overwrites; empty input is refused; returns rows by partition.

    The counts are per partition, of which there are few; rows go to files by partition.
    """
    spark = df.sparkSession
    counts = {tuple(r[k] for k in keys): r["n"] for r in df.groupBy(*keys).agg(F.count("*").alias("n")).collect()}
    if not counts:
        raise Refused("no rows to append")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    version = next_version(spark.read.parquet(root) if there else None)
    df.withColumn("part_version", F.lit(version)).repartition(*keys).write.mode("append").partitionBy(*keys).parquet(root)
    return counts


def scan_columns(spark: SparkSession, root: str, columns: list[str]) -> DataFrame:
    """Only these columns of all partitions: the scan reads no others."""
    return spark.read.parquet(root).select(*columns)


def verify_file_digests(spark: SparkSession, folder: str, sums: DataFrame, depth: int = 1) -> DataFrame:
    """One row n_ok, n_bad, n_missing: recorded SHA-256 (name, sha256) against the folder's files; a name is the last ``depth`` parts of a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    got = files.select(F.substring_index("path", "/", -depth).alias("name"), F.sha2("content", 256).alias("got"))
    j = sums.join(got, "name", "left")
    return j.agg(F.count_if(F.col("got") == F.lower("sha256")).alias("n_ok"), F.count_if(F.col("got") != F.lower("sha256")).alias("n_bad"), F.count_if(F.col("got").isNull()).alias("n_missing"))


def row_text(columns: list[str]) -> Column:
    """A row as text in which null differs from every value."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])


def partition_digest(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, digest): one digest per partition, whatever the order of its rows.

    The sum of two independent 64-bit hashes of each row, and the number of rows: counted in parts, so no partition's rows are collected.
    """
    text = row_text(columns)
    code = F.sha2(text, 256)
    half = lambda a: F.conv(F.substring(code, a, 15), 16, 10).cast("decimal(38,0)")
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(half(1)).alias("a"), F.sum(half(16)).alias("b"))
    return g.select(*keys, F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.col("a").cast("string"), F.col("b").cast("string")), 256).alias("digest"))


def data_digest(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One digest over the partitions' sorted digests; there are as many as partitions."""
    one = F.concat_ws("=", F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), "digest")
    return parts.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(one)), "\n"), 256).alias("digest"), F.count("*").alias("partitions"))
