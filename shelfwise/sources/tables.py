"""Stored tables: any Spark format, with replacement that is safe to read from.

A file table is a folder of complete versions, ``<path>/version=<n>``. Replacing it
writes the next version; a version counts once Spark has put its ``_SUCCESS`` file.
So a job may read the table it replaces, a lost executor only repeats tasks, and a
job that dies half way leaves the former version in force. Notes, a few lines of text, are put
beside a version before it counts. A version that replaces some partitions only holds just
these; its notes name the folders of the others, in earlier versions. Other formats (a document
or JDBC store) are named by format and options and use that sink's own save modes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from shelfwise.sources.folders import complete_folders, folder_names, read_lines, remove_folder, write_lines

FILE_FORMATS = ("parquet", "orc", "json", "csv")
KEPT_VERSIONS = 2
#: Begins the lines of notes that name folders of other versions.
FOLDER = "folder="


@dataclass(frozen=True)
class Table:
    path: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_file(self) -> bool:
        return self.format in FILE_FORMATS

    def suffixed(self, suffix: str) -> Table:
        """The same table under a longer name."""
        if not suffix:
            return self
        if self.is_file:
            return replace(self, path=self.path + suffix)
        name = "collection" if "collection" in self.options else "dbtable"
        return replace(self, options={**self.options, name: self.options[name] + suffix})


def _versions(spark: SparkSession, path: str) -> list[int]:
    return complete_folders(spark, path, "version=")


def exists(spark: SparkSession, table: Table) -> bool:
    return not table.is_file or bool(_versions(spark, table.path))


def table_scan(spark: SparkSession, table: Table, columns: Sequence[str] | None = None, schema=None) -> DataFrame:
    """Read the table, pruned to ``columns``.

    Columns of a file table that begin with an underscore are its own way of placing rows in
    folders, and are read only if they are named.
    """
    reader = spark.read.format(table.format).options(**table.options)
    if schema is not None:
        reader = reader.schema(schema)
    if table.is_file:
        numbers = _versions(spark, table.path)
        if not numbers:
            raise FileNotFoundError(f"no complete version of {table.path}")
        folders = _named_folders(spark, table, numbers[-1])
        if folders:
            df = reader.option("basePath", table.path).load([f"{table.path}/{f}" for f in folders]).drop("version")
        else:
            df = reader.load(f"{table.path}/version={numbers[-1]}")
    else:
        df = reader.load()
    if columns:
        return df.select(*columns)
    return df.drop(*[c for c in df.columns if c.startswith("_")]) if table.is_file else df


def table_append(df: DataFrame, table: Table) -> None:
    """Add rows as they are; running twice adds them twice."""
    writer = df.write.format(table.format).options(**table.options).mode("append")
    if table.is_file:
        numbers = _versions(df.sparkSession, table.path)
        writer.save(f"{table.path}/version={numbers[-1] if numbers else 0}")
    else:
        writer.save()


def _notes(table: Table, version: int) -> str:
    return f"{table.path}/notes/version={version}"


def _named_folders(spark: SparkSession, table: Table, version: int) -> list[str]:
    """The folders that the notes of a version name, below the table's; none if all its rows are its own."""
    lines = read_lines(spark, _notes(table, version)) or []
    return [line.removeprefix(FOLDER) for line in lines if line.startswith(FOLDER)]


def version_notes(spark: SparkSession, table: Table) -> list[str] | None:
    """The notes of the version in force; None if it has none."""
    numbers = _versions(spark, table.path) if table.is_file else []
    lines = read_lines(spark, _notes(table, numbers[-1])) if numbers else None
    return None if lines is None else [line for line in lines if not line.startswith(FOLDER)]


def table_overwrite(
    df: DataFrame,
    table: Table,
    reads_target: bool = False,
    notes: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Replace all rows. Say ``reads_target`` when ``df`` is computed from the table itself:
    a file table needs nothing for that, any other sink gets the rows from a checkpoint.
    Only file tables have ``notes`` and partitions."""
    if not table.is_file:
        df = df.checkpoint() if reads_target else df
        df.write.format(table.format).options(**table.options).mode("overwrite").save()
        return
    spark = df.sparkSession
    numbers = _versions(spark, table.path)
    version = numbers[-1] + 1 if numbers else 0
    if notes is None:
        remove_folder(spark, _notes(table, version))
    else:
        write_lines(spark, _notes(table, version), notes)
    writer = df.write.format(table.format).options(**table.options).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{table.path}/version={version}")
    _remove_old(spark, table, [*numbers, version])


def _remove_old(spark: SparkSession, table: Table, numbers: Sequence[int]) -> None:
    """Remove what no kept version reads."""
    kept = numbers[-KEPT_VERSIONS:]
    used = {folder for n in kept for folder in _named_folders(spark, table, n)}
    for old in numbers[:-KEPT_VERSIONS]:
        version = f"version={old}"
        if any(folder.startswith(f"{version}/") for folder in used):
            for name in folder_names(spark, f"{table.path}/{version}"):
                if "=" in name and f"{version}/{name}" not in used:
                    remove_folder(spark, f"{table.path}/{version}/{name}")
        else:
            remove_folder(spark, f"{table.path}/{version}")
            remove_folder(spark, _notes(table, old))


def _partitions(spark: SparkSession, table: Table, column: str) -> dict[str, str]:
    """Value and folder of each partition of the version in force."""
    numbers = _versions(spark, table.path)
    if not numbers:
        return {}
    folders = _named_folders(spark, table, numbers[-1])
    if not folders:
        version = f"version={numbers[-1]}"
        folders = [f"{version}/{name}" for name in folder_names(spark, f"{table.path}/{version}", f"{column}=")]
    return {folder.split("/")[1].removeprefix(f"{column}="): folder for folder in folders}


def partition_values(spark: SparkSession, table: Table, column: str) -> list[str]:
    """The values of the partition column that the version in force has rows of."""
    return sorted(_partitions(spark, table, column))


def replace_partitions(df: DataFrame, table: Table, column: str, values: Sequence) -> None:
    """The next version: the partitions ``values`` are replaced by the rows of ``df``, the others keep their files.

    ``df`` has rows of these partitions only, and may be computed from the table. A reader
    keeps the version it opened, and a job that dies leaves the former one in force.
    """
    spark = df.sparkSession
    numbers = _versions(spark, table.path)
    version = numbers[-1] + 1 if numbers else 0
    kept = {v: folder for v, folder in _partitions(spark, table, column).items() if v not in set(map(str, values))}
    own = {str(r[0]): f"version={version}/{column}={r[0]}" for r in df.select(column).distinct().collect()}
    lines = [*(version_notes(spark, table) or ()), *[f"{FOLDER}{folder}" for _, folder in sorted({**kept, **own}.items())]]
    write_lines(spark, _notes(table, version), lines)
    writer = df.write.format(table.format).options(**table.options).mode("overwrite")
    writer.partitionBy(column).save(f"{table.path}/version={version}")
    _remove_old(spark, table, [*numbers, version])
