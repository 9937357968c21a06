"""One file per asset, committed as a whole, through a Spark data source.

`assets.write.format("asset_files").option("path", root).mode("append").save()`: tasks write their assets' files under
`<root>.staging-<id>`; a file is written beside its name and then moved to it, so an attempt that dies leaves no half
file under a name, and a second attempt puts the same files. When every task is done the driver moves the staging folder
to `root` in one rename; when one fails for good the staging folder is removed, and `root` never appears. `root` must
not exist before: an export is never mixed with an older one.

Paths go to the file system of their scheme through Arrow (file, hdfs, s3, gs); a path without a scheme is a folder
that the driver and all executors mount. Rows without text are left out; of rows with one path the last written
stays; a path that would leave the folder fails the write.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

EXTENSIONS = {"python": "py", "sql": "sql", "scala": "scala", "r": "r"}


@dataclass
class Written(WriterCommitMessage):
    files: int


def _store(uri: str):
    """(file system, path in it)."""
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


class AssetFilesWriter(DataSourceWriter):
    def __init__(self, root: str, columns: list[str], extension: str | None):
        self.root, self.columns, self.extension = root.rstrip("/"), columns, extension
        self.staging = f"{self.root}.staging-{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        store, base = _store(self.staging)
        made, n = set(), 0
        for row in iterator:
            values = dict(zip(self.columns, row))
            path, text = values["asset_path"], values["source"]
            if text is None:
                continue
            parts = [p for p in (path or "").split("/") if p]
            if not parts or any(p in (".", "..") for p in parts):
                raise ValueError(f"not a path inside the export: {path!r}")
            folder = "/".join([base, *parts[:-1]])
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            extension = self.extension or EXTENSIONS.get((values.get("language") or "python").lower(), "py")
            name = f"{folder}/{parts[-1]}.{extension}"
            temporary = f"{folder}/.{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as out:
                out.write(text.encode())
            store.move(temporary, name)
            n += 1
        return Written(n)

    def commit(self, messages) -> None:
        from pyarrow.fs import FileType
        store, staged = _store(self.staging)
        _, root = _store(self.root)
        if store.get_file_info(root).type != FileType.NotFound:
            self.abort(messages)
            raise FileExistsError(self.root)
        store.create_dir(staged, recursive=True)             # an export of no assets is an empty folder
        store.move(staged, root)

    def abort(self, messages) -> None:
        from pyarrow.fs import FileType
        store, staged = _store(self.staging)
        if store.get_file_info(staged).type == FileType.Directory:
            store.delete_dir(staged)


class AssetFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "asset_files"

    def writer(self, schema, overwrite: bool) -> AssetFilesWriter:
        if overwrite:
            raise ValueError("an export goes to a folder of its own: use mode('append') and a new path")
        return AssetFilesWriter(self.options["path"], schema.names, self.options.get("extension"))


def export_assets(assets: DataFrame, root: str, extension: str | None = None) -> None:
    """Each asset's text to `<root><asset_path>.<extension>` (by its language when none is given)."""
    spark = assets.sparkSession
    spark.dataSource.register(AssetFiles)
    columns = [c for c in ("asset_path", "language", "source") if c in assets.columns]
    writer = assets.select(*columns).write.format("asset_files").mode("append").option("path", root)
    (writer if extension is None else writer.option("extension", extension)).save()
