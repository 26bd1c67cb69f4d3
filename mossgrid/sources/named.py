"""A sink of text files under given names, with a commit.

Tasks write drafts into a folder of the job's own; the driver moves them to their names once all tasks have ended well, and
removes the folder either way. So a file appears whole or not at all, and drafts of failed or speculative attempts never
count. Files lie on storage that Spark and Arrow both know.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


def storage(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder or file, and its path there."""
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri)


@dataclass
class Drafts(WriterCommitMessage):
    """Drafts of one task: (draft, name) in the folder."""

    files: list[tuple[str, str]] = field(default_factory=list)


class NamedFiles(DataSource):
    """Rows (file, line), grouped by file within a task; option `folder`, `header` (a first line of every file) and `always` (a file that is there even without rows)."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string, line string"

    def writer(self, schema: object, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options["folder"], self.options.get("header"), self.options.get("always"), f"_drafts-{uuid.uuid4().hex}")


class NamedWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, header: str | None, always: str | None, drafts: str) -> None:
        self.folder, self.header, self.always, self.drafts = folder, header, always, drafts

    def _opened(self, files: pafs.FileSystem, draft: str) -> pa.NativeFile:
        out = files.open_output_stream(draft)
        if self.header is not None:
            out.write(f"{self.header}\n".encode())
        return out

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, base = storage(self.folder)
        files.create_dir(f"{base}/{self.drafts}", recursive=True)
        done, name, out = Drafts(), None, None
        for batch in iterator:
            for file, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if file != name:
                    if out is not None:
                        out.close()
                    draft = f"{self.drafts}/{uuid.uuid4().hex}"
                    name, out = file, self._opened(files, f"{base}/{draft}")
                    done.files.append((draft, file))
                out.write(f"{line}\n".encode())
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list[Drafts | None]) -> None:
        files, base = storage(self.folder)
        drafts = [x for m in messages if m is not None for x in m.files]
        names = [name for _, name in drafts]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("a file's rows were in several places")
        if self.always is not None and self.always not in names:
            files.create_dir(f"{base}/{self.drafts}", recursive=True)
            self._opened(files, f"{base}/{self.drafts}/always").close()
            drafts.append((f"{self.drafts}/always", self.always))
        for draft, name in drafts:
            target = f"{base}/{name}"
            if "/" in name:
                files.create_dir(target.rpartition("/")[0], recursive=True)
            files.move(f"{base}/{draft}", target)
        self.abort(messages)

    def abort(self, messages: list[Drafts | None]) -> None:
        files, base = storage(self.folder)
        if files.get_file_info(f"{base}/{self.drafts}").type != pafs.FileType.NotFound:
            files.delete_dir(f"{base}/{self.drafts}")


def folder_uri(spark: SparkSession, path: str) -> str:
    """The folder as tasks find it: a plain path belongs to the default file system."""
    if "://" in path or path.startswith("file:"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return path if default.startswith("file:") else default.rstrip("/") + path


def write_named(rows: DataFrame, path: str, header: str | None = None, always: str | None = None) -> None:
    """Writes rows of (file, line), which one task holds for each file, in their order."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    out = rows.select("file", "line").write.format("named_files").mode("append").option("folder", folder_uri(spark, path))
    for key, value in (("header", header), ("always", always)):
        if value is not None:
            out = out.option(key, value)
    out.save()


def tsv_line(df: DataFrame, na: str = "NA", upper_bools: tuple = ()) -> F.Column:
    """A row as tab-separated text: nulls as na, tabs and line ends inside values as spaces."""
    cells = []
    for name in df.columns:
        text = F.col(f"`{name}`").cast("string")
        text = F.upper(text) if name in upper_bools else text
        cells.append(F.coalesce(F.translate(text, "\t\n\r", "   "), F.lit(na)))
    return F.concat_ws("\t", *cells)
