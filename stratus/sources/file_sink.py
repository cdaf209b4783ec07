"""A sink for files that tasks make themselves: df.write.format("stratus_files").mode("append").save(folder), of rows (name, content).

Tasks write below a folder of the job's own, each attempt in one of its own; only the driver's commit, after every task ended well,
moves the files to their names, in place of what stood there. What a failed or repeated attempt wrote goes with the job's folder, so a job leaves all of its
files or, where it fails before the commit, none; attempts that still run when their job is given up write below the temporary folder at most, which file listings of Spark pass over. The folder may be in any store that pyarrow opens and that the driver and all executors see.
mode("overwrite") clears the folder when it commits. Rows (name, part, content) are pieces: those of a file follow each other in one task and are appended.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

TEMPORARY = "_temporary"


def store_of(path: str):
    """The store of a path, and the path in it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    names: list[str]


class FileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.job = f"{TEMPORARY}/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = store_of(self.path)
        attempt, names, out = uuid.uuid4().hex, [], None
        try:
            for batch in iterator:
                pieces = "part" in batch.schema.names
                for name, content in zip(batch.column("name"), batch.column("content"), strict=True):
                    name = _checked(name.as_py())
                    if out is None or not pieces or name != names[-1]:
                        if out is not None:
                            out.close()
                        target = f"{base}/{self.job}/{attempt}/{name}"
                        store.create_dir(target.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(target)
                        names.append(name)
                    out.write(content.as_py())
        finally:
            if out is not None:
                out.close()
        return Written(attempt, names)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = store_of(self.path)
        done = [m for m in messages if m is not None]
        every = [n for m in done for n in m.names]
        if len(set(every)) < len(every):
            self.abort(messages)
            raise ValueError("several rows name the same file")
        if self.overwrite:
            from pyarrow import fs

            for found in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if found.base_name != TEMPORARY:
                    (store.delete_dir if found.type == fs.FileType.Directory else store.delete_file)(found.path)
        for m in done:
            for name in m.names:
                target = f"{base}/{name}"
                store.create_dir(target.rpartition("/")[0], recursive=True)
                store.move(f"{base}/{self.job}/{m.attempt}/{name}", target)
        store.create_dir(base, recursive=True)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """The job's folder, and the one above it unless another job is at work there."""
        from pyarrow import fs

        store, base = store_of(self.path)
        if store.get_file_info(f"{base}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/{self.job}")
        if not store.get_file_info(fs.FileSelector(f"{base}/{TEMPORARY}", allow_not_found=True)) and store.get_file_info(f"{base}/{TEMPORARY}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/{TEMPORARY}")


def _checked(name: str) -> str:
    if not name or name.startswith("/") or ".." in name.split("/") or name.split("/")[0] == TEMPORARY:
        raise ValueError(f"not a file name below the folder: {name}")
    return name


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stratus_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        given = {f.name: f.dataType.simpleString() for f in schema}
        if given not in ({"name": "string", "content": "binary"}, {"name": "string", "part": "bigint", "content": "binary"}):
            raise ValueError("rows must have name (string) and content (binary), pieces of files also part (bigint)")
        return FileWriter(self.options["path"], overwrite)


def write_files(files: DataFrame, path: str, mode: str = "append") -> None:
    """Files (name, content) below a folder, all or none."""
    files.sparkSession.dataSource.register(FileSink)
    files.select("name", "content").write.format("stratus_files").mode(mode).save(path)


def write_pieces(pieces: DataFrame, path: str, mode: str = "append") -> None:
    """Files put together from their pieces (name, part, content) in the order of part, all or none; a task streams a file and holds some pieces."""
    pieces.sparkSession.dataSource.register(FileSink)
    ordered = pieces.select("name", "part", "content").repartition("name").sortWithinPartitions("name", "part")
    ordered.write.format("stratus_files").mode(mode).save(path)
