"""Restart state of readers as JSON: files seen and the offset at which each unfinished file goes on.

A document has ``oldFiles``, ``inputDirectory``, ``filePattern`` and ``offsets``. A state with very many
files is spread over several documents of bounded size; together they are one version of the state. A
version counts only once Spark has marked it complete, so a reader never sees half of one.
"""

from __future__ import annotations

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailrace.sources.files import locate

ENTRIES_PER_DOCUMENT = 10_000
_KEPT_VERSIONS = 2

_SCHEMA = "oldFiles array<string>, inputDirectory string, filePattern string, offsets map<string, bigint>"


def write_progress(offsets: DataFrame, seen: DataFrame, path: str, directory: str, pattern: str) -> None:
    """Save ``offsets`` (``file, record_offset``) and ``seen`` (``file``) as the newest state at ``path``."""
    at = offsets.select("file", F.struct("file", "record_offset").alias("at"), F.lit(None).cast("string").alias("old"))
    old = seen.select("file", F.lit(None).cast(at.schema["at"].dataType).alias("at"), F.col("file").alias("old"))
    entries = at.unionByName(old)
    documents = F.greatest(F.lit(1), F.ceil(entries.agg(F.count(F.lit(1))).scalar() / ENTRIES_PER_DOCUMENT))
    # The empty entry makes a state without files a document too.
    none = entries.sparkSession.range(1).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in entries.schema]
    )
    state = (
        entries.unionByName(none)
        .withColumn("document", F.coalesce(F.pmod(F.xxhash64("file"), documents), F.lit(0).cast("bigint")))
        .groupBy("document")
        .agg(F.sort_array(F.collect_list("old")).alias("oldFiles"), F.map_from_entries(F.collect_list("at")).alias("offsets"))
        .select("oldFiles", F.lit(directory).alias("inputDirectory"), F.lit(pattern).alias("filePattern"), "offsets")
    )
    versions = _versions(path)
    newest = max((v for v, _ in versions), default=0) + 1
    state.select(F.to_json(F.struct("*"))).write.text(f"{path.rstrip('/')}/v={newest:012d}")
    system, _ = locate(path)
    for _, folder in sorted(versions)[: max(0, len(versions) + 1 - _KEPT_VERSIONS)]:
        system.delete_dir(folder)


def read_progress(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Offsets (``file, record_offset``) and seen files (``file``) of a state file or the newest version."""
    docs = spark.read.schema(_SCHEMA).json(_newest(path), multiLine=_is_file(path))
    offsets = docs.select(F.explode("offsets").alias("file", "record_offset"))
    # A file is written as plain text or as an object with its path.
    old = docs.select(F.explode("oldFiles").alias("f"))
    plain = F.when(F.col("f").startswith("{"), F.get_json_object("f", "$.path")).otherwise(F.col("f"))
    return offsets, old.select(plain.alias("file"))


def progress_scope(spark: SparkSession, path: str) -> DataFrame:
    """Input directory and file pattern that the state belongs to."""
    docs = spark.read.schema(_SCHEMA).json(_newest(path), multiLine=_is_file(path))
    return docs.select("inputDirectory", "filePattern").distinct()


def _is_file(path: str) -> bool:
    system, name = locate(path)
    return system.get_file_info(name).type == pafs.FileType.File


def _versions(path: str) -> list[tuple[int, str]]:
    system, name = locate(path)
    listing = system.get_file_info(pafs.FileSelector(name, allow_not_found=True))
    return [(int(e.base_name[2:]), e.path) for e in listing if e.base_name.startswith("v=")]


def _newest(path: str) -> str:
    if _is_file(path):
        return path
    system, _ = locate(path)
    for version, folder in sorted(_versions(path), reverse=True):
        if system.get_file_info(f"{folder}/_SUCCESS").type == pafs.FileType.File:
            return f"{path.rstrip('/')}/v={version:012d}"
    raise FileNotFoundError(f"no complete state at {path}")
