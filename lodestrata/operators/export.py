"""What may leave: a gate that fails closed, geometry dropped by name and by value, content audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StringType

from ..functions.scalars import has_geometry_name, is_wkb, is_wkt
from .contracts import Refused, column_gap


def gate_verdict(df: DataFrame, gate: str) -> DataFrame:
    """One row: rows, null and false gates, and whether the whole frame may go. A gate that is missing or no boolean refuses without a scan."""
    if gate not in df.columns or not isinstance(df.schema[gate].dataType, BooleanType):
        raise Refused(f"no boolean column {gate}")
    out = df.agg(F.count("*").alias("rows"), F.count_if(F.col(gate).isNull()).alias("null_gates"), F.count_if(~F.col(gate)).alias("false_gates"))
    return out.withColumn("open", (F.col("null_gates") == 0) & (F.col("false_gates") == 0))


def geometry_columns(df: DataFrame, gate: str) -> list[str]:
    """Columns that are geometry by name, or by any value: all sniffed in one pass."""
    named = [c for c in df.columns if c != gate and has_geometry_name(c)]
    tests = {f.name: is_wkt(F.col(f.name)) if isinstance(f.dataType, StringType) else is_wkb(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, StringType | BinaryType) and f.name not in named}
    found = df.agg(*[F.max(t).alias(n) for n, t in tests.items()]).first() if tests else {}
    return [c for c in df.columns if c in named or (c in tests and found[c])]


def export_public(df: DataFrame, gate: str = "redistribute_public") -> tuple[DataFrame, list[str]]:
    """The frame without its gate and geometry, and what was dropped; any null or false gate refuses all rows."""
    verdict = gate_verdict(df, gate).first()
    if not verdict["open"]:
        raise Refused(f"gate {gate}: {verdict['null_gates']} null, {verdict['false_gates']} false of {verdict['rows']} rows")
    dropped = geometry_columns(df, gate)
    return df.drop(gate, *dropped), dropped


def attach_licence(df: DataFrame, registry: DataFrame, source: str) -> DataFrame:
    """Adds the registry's gate for a source column; unknown sources get null, which the gate refuses."""
    return df.join(F.broadcast(registry.select(F.col("source").alias(source), "redistribute_public")), source, "left")  # the registry has a dozen rows


def assemble_package(df: DataFrame, columns: list[str], constants: dict[str, str], closed: bool = True) -> tuple[DataFrame, list[str]]:
    """Fixed columns and constant licence columns; extra columns are refused (closed) or dropped and named."""
    missing, extra = column_gap(df, columns)
    if missing or (closed and extra):
        raise Refused(f"missing {missing}, extra {extra}")
    return df.select(*columns, *[F.lit(v).alias(k) for k, v in constants.items()]), extra


def reconcile_package(package: DataFrame, source: DataFrame, place: list[str]) -> DataFrame:
    """One row: rows of both sides, rows without a place, and whether the package may go."""
    gone = reduce(Column.__or__, [F.col(c).isNull() for c in place])
    one = package.agg(F.count("*").alias("package_rows"), F.count_if(gone).alias("without_place")).crossJoin(source.agg(F.count("*").alias("source_rows")))
    return one.withColumn("reconciled", (F.col("package_rows") == F.col("source_rows")) & (F.col("without_place") == 0))


# Patterns of content that must not be published. Only their names are reported.
RULES = {
    "credential_aws_secret": "(?i)aws_secret",
    "credential_access_key_id": "(?i)aws_access_key_id",
    "credential_api_key": r"(?i)api[_-]?key\s*=",
    "credential_private_key": "-----BEGIN (RSA |EC )?PRIVATE KEY-----",
    "credential_token": "ghp_[A-Za-z0-9]{20,}",
    "credential_key_id": "AKIA[0-9A-Z]{16}",
    "local_path": r"/Users/|/home/|[A-Z]:\\",
    "wkt": r"\b(POLYGON|MULTIPOLYGON|LINESTRING|MULTILINESTRING|POINT|MULTIPOINT)\s*\(",
    "geojson": '"FeatureCollection"|"coordinates"',
}
# Tokens of a register's lineage, the first three as they are written, the others in any case.
LINEAGE = r"SiteCode|ProjectCode|OwnerName|(?i:owners_at_snapshot|dmirs_001|minedex)"
# Endings of sources and documents, which may speak of paths, and of data files (and none), whose content must be no geometry and no register.
CODE = ("py", "md", "rst", "toml", "cfg", "ini", "yml", "yaml")
DATA = ("csv", "tsv", "json", "txt", "bin", "")
# File endings of bulk data, and names of evidence files.
BULK = ("zip", "parquet", "gpkg", "tif", "tiff", "nc", "zarr", "feather", "arrow", "shp", "shx", "dbf", "prj", "cpg", "geojson", "csv", "tsv", "xlsx")
EVIDENCE = r"^(SHA256SUMS\.txt|licence_evidence\.json|.*\.run_manifest\.json)$"


def wkb_head(data: Column) -> Column:
    """Whether bytes begin as a binary geometry does: byte order 0 or 1, then a type of 1 to 7 in that order."""
    return F.hex(F.substring(data, 1, 5)).rlike("^(000000000[1-7]|010[1-7]000000)$")


def audit_text(df: DataFrame, key: str, text: str, name: str | None = None, allowed: DataFrame | None = None) -> DataFrame:
    """(key, rule): rules that each document breaks; never its content. ``allowed`` lists pairs to leave out.

    ``text`` may be a binary column; its bytes are tested for a binary geometry's head and read as UTF-8 otherwise.
    With file names, local paths are no finding in sources and documents, and geometry and lineage only in data files.
    """
    binary = isinstance(df.schema[text].dataType, BinaryType)
    said = F.try_validate_utf8(F.col(text).cast("string")) if binary else F.col(text)
    said = F.coalesce(said, F.decode(F.col(text), "ISO-8859-1")) if binary else said
    tests = {rule: said.rlike(p) for rule, p in RULES.items()} | {"lineage": said.rlike(LINEAGE), "wkb": wkb_head(F.col(text).cast("binary"))}
    if name:
        file = F.regexp_extract(F.col(name), r"([^/]*)$", 1)
        ending = F.lower(F.regexp_extract(file, r".\.([^.]*)$", 1))
        tests["local_path"] &= ~ending.isin(*CODE)
        for rule in ("wkt", "geojson", "lineage", "wkb"):
            tests[rule] &= ending.isin(*DATA)
        tests |= {"bulk_extension": F.lower(file).rlike(rf"\.({'|'.join(BULK)})$"), "evidence_name": file.rlike(EVIDENCE)}
    hits = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(r)) for r, t in tests.items()]))
    found = df.select(key, F.explode(hits).alias("rule"))
    return found.join(allowed, [key, "rule"], "left_anti") if allowed is not None else found


def audit_report(findings: DataFrame, key: str) -> DataFrame:
    return findings.groupBy("rule").agg(F.count("*").alias("findings"), F.count_distinct(key).alias("files"))
