"""Plain files in the shared folder, opened by its URI from tasks."""

from __future__ import annotations


def _place(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def make_folder(uri: str) -> None:
    system, path = _place(uri)
    system.create_dir(path, recursive=True)


def open_output(uri: str):
    system, path = _place(uri)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    system, path = _place(uri)
    return system.open_input_file(path)


def list_files(uri: str) -> list[str]:
    """The URIs of the files of a folder, none where there is no folder."""
    from pyarrow import fs

    system, path = _place(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f"{uri.rstrip('/')}/{f.base_name}" for f in found if f.is_file)
