"""Files in a folder that the driver and all executors share, as tasks open them."""

from __future__ import annotations


def filesystem(path: str):
    """(file system, path on it) of a local path or a URI."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def names(path: str) -> list[str]:
    """The sorted names in a folder without hidden ones; none if it does not exist."""
    from pyarrow import fs

    store, folder = filesystem(path)
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if not f.base_name.startswith((".", "_")))
