"""Files of datasets, in a folder that all executors mount or in a store that Arrow opens (s3://, gs://, hdfs://)."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlencode


class Store:
    """The files of one folder. Options (region, endpoint_override, user, ...) go to the store as parameters of its address."""

    def __init__(self, folder: str, options: dict[str, str] | None = None):
        if "://" not in folder:
            folder = f"file://{os.path.abspath(folder.removeprefix('file:'))}"
        if options and folder.startswith("file://"):
            raise ValueError("a mounted folder takes no store options")
        self.folder, self.query = folder.rstrip("/"), f"?{urlencode(options)}" if options else ""

    def __getstate__(self):
        return {"folder": self.folder, "query": self.query}

    def _at(self, name: str = ""):
        """The file system and a file's path in it."""
        if not hasattr(self, "_opened"):
            from pyarrow import fs

            self._opened = fs.FileSystem.from_uri(self.folder + self.query)
        store, path = self._opened
        return store, f"{path}/{name}" if name else path

    def read(self, name: str) -> bytes:
        store, path = self._at(name)
        with store.open_input_stream(path, compression=None) as f:
            return f.read()

    def write(self, name: str, data: bytes) -> None:
        """A whole file: under another name first in a mounted folder; stores show a file when it is complete."""
        store, path = self._at(name)
        folder, _, last = path.rpartition("/")
        store.create_dir(folder, recursive=True)
        own = f"{folder}/.{last}.{uuid.uuid4().hex}" if self.folder.startswith("file://") else path
        with store.open_output_stream(own, compression=None) as f:
            f.write(data)
        if own != path:
            store.move(own, path)

    def open(self, name: str):
        """A file to read from any place."""
        store, path = self._at(name)
        return store.open_input_file(path)

    def length(self, name: str) -> int:
        store, path = self._at(name)
        return store.get_file_info(path).size

    def is_folder(self) -> bool:
        from pyarrow.fs import FileType

        store, path = self._at()
        return store.get_file_info(path).type == FileType.Directory

    def exists(self, name: str) -> bool:
        from pyarrow.fs import FileType

        store, path = self._at(name)
        return store.get_file_info(path).type == FileType.File

    def names(self) -> set[str]:
        """The files of the folder, none if there is no folder."""
        from pyarrow.fs import FileSelector

        store, path = self._at()
        return {f.base_name for f in store.get_file_info(FileSelector(path, allow_not_found=True)) if f.is_file}

    def delete(self, name: str) -> None:
        store, path = self._at(name)
        store.delete_file(path)
