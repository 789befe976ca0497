"""The landing folder, kept short: files go to an archive once they are ingested."""

from pyspark.sql import SparkSession


def landed_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a folder, without its subfolders; none if there is no folder."""
    folder = _path(spark, path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    found = [f.getPath() for f in store.listStatus(folder) if f.isFile()]
    return sorted(f.toString() for f in found if not f.getName().startswith(("_", ".")))


def archive_files(spark: SparkSession, files: list[str], archive: str) -> int:
    """Move files into an archive folder; how many were still there to be moved.

    A file that was moved before is left out, so a move that was cut off can be made again. A file of
    that name in the archive is never replaced: it raises.
    """
    target, moved = _path(spark, archive), 0
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target)
    for name in files:
        file = _path(spark, name)
        if store.exists(file):
            to = spark._jvm.org.apache.hadoop.fs.Path(target, file.getName())
            if store.exists(to) or not store.rename(file, to):
                raise FileExistsError(f"cannot archive {name} as {to.toString()}")
            moved += 1
    return moved


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)
