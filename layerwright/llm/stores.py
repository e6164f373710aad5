"""The stores that tasks write their files to, by the schemes that Spark's paths use."""

from __future__ import annotations

from urllib.parse import urlsplit

import pyarrow.fs

# Schemes of Spark's (Hadoop's) paths and those pyarrow knows the same stores by.
SAME_STORE = {"s3a": "s3", "s3n": "s3", "viewfs": "hdfs", "wasbs": "abfss", "abfs": "abfss"}
MOUNTED = {"dbfs": "/dbfs"}  # stores that executors see as a folder


def open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and the path in it of a folder that all executors reach.

    Supported: local and shared folders (plain, file:), s3: s3a: s3n: gs: hdfs: viewfs: (the
    last two need libhdfs on the executors) abfs: abfss: wasbs: and dbfs: (by its mount);
    any other scheme through fsspec, where that is installed and knows it.  Credentials are
    those the executors' environment gives.
    """
    scheme, sep, rest = folder.partition(":")
    if not sep or "/" in scheme or len(scheme) == 1:
        return pyarrow.fs.FileSystem.from_uri(folder)
    scheme = scheme.lower()
    if scheme in MOUNTED:
        return pyarrow.fs.LocalFileSystem(), MOUNTED[scheme] + "/" + rest.lstrip("/")
    known = SAME_STORE.get(scheme, scheme)
    try:
        return pyarrow.fs.FileSystem.from_uri(f"{known}:{rest}")
    except (pyarrow.ArrowInvalid, pyarrow.ArrowNotImplementedError) as error:
        if known != scheme or "nrecognized filesystem" not in str(error):
            raise
        return _by_fsspec(scheme, folder, error)


def _by_fsspec(scheme: str, folder: str, error: Exception) -> tuple[pyarrow.fs.FileSystem, str]:
    try:
        import fsspec

        found = fsspec.filesystem(scheme)
    except (ImportError, ValueError):
        raise ValueError(f"tasks can't write to {folder}: {error}; {open_folder.__doc__.split('Supported: ')[1].split('Credentials')[0].strip()}") from error
    parts = urlsplit(folder)
    return pyarrow.fs.PyFileSystem(pyarrow.fs.FSSpecHandler(found)), parts.netloc + parts.path
