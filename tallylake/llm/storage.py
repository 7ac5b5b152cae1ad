"""Folders that driver and executors share, and files in them."""

import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs

#: Lets Spark remove a statement's shuffle files when the statement has ended, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark):
    """spark.checkpoint.dir where the cluster names one, else the warehouse, which is shared as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def new_folder(spark, name):
    """Address of a folder that no other run uses."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark):
    """Statements that run inside leave no shuffle files on the disk; the session's own setting holds again after it."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df, name):
    """df written as Parquet to the shared folder and read back: cuts lineage, survives lost executors.

    The shuffle files that the writing took are removed at its end: nothing reads them again.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def locate(uri):
    """(file system, path) of an address; file:/a, file:///a and /a are the same place."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def commit_file(folder, name, write):
    """Let write(stream) fill a file and give it its name at the end, so that a retried task leaves one whole file."""
    system, path = locate(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        write(out)
    system.move(draft, f"{path}/{name}")
    return name


def commit_table(folder, name, table):
    """An Arrow table as one compressed file of a folder."""
    def write(out):
        with pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
            file.write_table(table)

    return commit_file(folder, name, write)


def read_table(folder, name):
    system, path = locate(f"{folder}/{name}")
    with system.open_input_file(path) as file:
        return pa.ipc.open_file(file).read_all()


def removed(folder):
    """Remove a folder of this run that nothing reads any more."""
    system, path = locate(folder)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def discarded(df):
    """Remove what stored() wrote, when nothing reads it any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        removed(folder)


def list_files(folder, suffixes):
    """(address, bytes) of the finished files of a folder, or of one file, by name."""
    system, path = locate(folder)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [(folder, info.size)]
    if info.type == fs.FileType.NotFound:
        return []
    found = system.get_file_info(fs.FileSelector(path, recursive=True))
    return sorted(
        (f"{folder.rstrip('/')}/{f.path[len(path):].lstrip('/')}", f.size)
        for f in found
        if f.type == fs.FileType.File and f.base_name.endswith(suffixes) and not f.base_name.startswith(("_", "."))
    )
