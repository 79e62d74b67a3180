"""What has landed in raw storage: names, sizes and times of files, which are listed by tasks and never opened."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.errors import errors
from . import storage

SCHEMA = "prefix string, key string, folder string, name string, length long, modified timestamp, rule string, detail string"


def listing(prefixes: DataFrame, root: str, ends: str = "") -> tuple[DataFrame, DataFrame]:
    """(files, error rows) of all folders root/prefix, with those below: (prefix, key, folder, name, length, modified), key being the path from root.

    prefixes: a column `prefix`, such as a folder for each run; equal ones are listed once, an empty one is the root itself,
    null ones are left out. They are dealt over tasks, each of which asks storage for one folder after another, so that
    neither the driver nor a task holds a whole listing. Files of no bytes are listed too, as some sources count them as
    fetched; `ends`: only names with this end. A prefix that isn't there (`no such folder`) or can't be listed (`not listed`)
    is an error row. It is a snapshot, written once to shared storage (see storage.kept), as what is compared with it twice
    must see the same files.
    """
    spark = prefixes.sparkSession

    def look(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        kinds = [("prefix", pa.string()), ("key", pa.string()), ("folder", pa.string()), ("name", pa.string()), ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("rule", pa.string()), ("detail", pa.string())]
        made = lambda rows: pa.RecordBatch.from_pylist([dict(zip((n for n, _ in kinds), r, strict=True)) for r in rows], pa.schema(kinds))
        plain = root.startswith("/") or root.startswith("file:")
        store, top = (fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")) if plain else fs.FileSystem.from_uri(root)
        top = top.rstrip("/")
        for batch in batches:
            for prefix in batch.column(0).to_pylist():
                todo = [f"{top}/{prefix}".rstrip("/")]
                while todo:
                    at = todo.pop()
                    try:
                        below = store.get_file_info(fs.FileSelector(at))
                    except FileNotFoundError:
                        yield made([(prefix, None, None, None, None, None, "no such folder", at[len(top) + 1 :])])
                        continue
                    except OSError as e:
                        yield made([(prefix, None, None, None, None, None, "not listed", str(e))])
                        continue
                    todo += [x.path for x in below if x.type == fs.FileType.Directory]
                    files = [x for x in below if x.type == fs.FileType.File and x.base_name.endswith(ends)]
                    if files:
                        yield made([(prefix, x.path[len(top) + 1 :], at[len(top) + 1 :], x.base_name, x.size, x.mtime, None, None) for x in files])

    asked = prefixes.where("prefix is not null").select("prefix").distinct().repartition(spark.sparkContext.defaultParallelism * 4)
    seen = storage.kept(asked.mapInArrow(look, SCHEMA), "listing")
    return seen.where("rule is null").drop("rule", "detail"), errors(seen.where("rule is not null"), "listing", F.col("rule"), None, "prefix", "detail")


def by_folder(files: DataFrame, key: Column | str = "folder") -> DataFrame:
    """(key, length, n_files) of each folder, for sources that land a file in several parts."""
    return files.groupBy((F.col(key) if isinstance(key, str) else key).alias("key")).agg(F.sum("length").alias("length"), F.count("*").alias("n_files"))
