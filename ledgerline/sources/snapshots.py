"""Versions of a stored table, switched by one file.

Data folders are written once and never changed. A version is a manifest, a small JSON file that names
the folder of every date; readers take the highest one, so a folder that no manifest names
is not part of the table. A version comes into being by creating its manifest, which fails
where another writer created that version first.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

import pyarrow.fs as pafs

from ledgerline.sources.cuts import ONE_PROCESS

MANIFESTS = "_versions"

#: Creates a file with this content and says whether it did; it must not if the file is there.
Create = Callable[[str, bytes], bool]


class Conflict(RuntimeError):
    """Another writer made a version since this one read the table."""


@dataclass(frozen=True)
class Manifest:
    """``folders`` has the folder of each date, relative to the table. Version 0 is the table before its first write."""

    version: int
    folders: dict[date, str]

    def dump(self) -> bytes:
        return json.dumps({"version": self.version, "folders": {d.isoformat(): f for d, f in sorted(self.folders.items())}}).encode()

    @classmethod
    def load(cls, raw: bytes) -> Manifest:
        read = json.loads(raw)
        return cls(read["version"], {date.fromisoformat(d): f for d, f in read["folders"].items()})


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def check_location(path: str, master: str) -> None:
    """Spark and this module must mean one place: off a local master that takes the file system's name too."""
    if ":/" not in path and not ONE_PROCESS.match(master):
        raise ValueError(f"name the file system of {path}")


def create_if_absent(path: str, content: bytes) -> bool:
    """A complete file or none, and never over another one.

    A link in local or mounted folders, a rename in a Hadoop file system, which does not replace files.
    Other stores need a function of their own (a conditional put).
    """
    store, target = _opened(path)
    folder, name = target.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    store.create_dir(folder, recursive=True)
    if isinstance(store, pafs.LocalFileSystem):
        with open(draft, "xb") as out:
            out.write(content)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(draft, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    if store.type_name != "hdfs":
        raise ValueError(f"no way to create a file once in {store.type_name}")
    with store.open_output_stream(draft) as out:
        out.write(content)
    try:
        store.move(draft, target)
    except OSError:
        store.delete_file(draft)
        if store.get_file_info(target).type == pafs.FileType.NotFound:
            raise
        return False
    return True


def _manifest_name(version: int) -> str:
    return f"{version:012d}.json"


def versions(path: str) -> list[int]:
    """The versions there are, ascending."""
    store, root = _opened(path)
    listed = store.get_file_info(pafs.FileSelector(f"{root}/{MANIFESTS}", allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in listed if f.base_name.endswith(".json") and not f.base_name.startswith("."))


def manifest(path: str, version: int | None = None) -> Manifest:
    """The latest version, or the one asked for."""
    if version is None:
        version = max(versions(path), default=0)
    if version == 0:
        return Manifest(0, {})
    store, root = _opened(path)
    with store.open_input_stream(f"{root}/{MANIFESTS}/{_manifest_name(version)}") as source:
        return Manifest.load(source.read())


def new_folder() -> str:
    return f"data/{uuid.uuid4().hex}"


def commit(path: str, base: Manifest, folders: dict[date, str], create: Create = create_if_absent) -> Manifest:
    """Make ``folders`` the version after ``base``; :class:`Conflict` if that version is already there."""
    made = Manifest(base.version + 1, folders)
    if not create(f"{path}/{MANIFESTS}/{_manifest_name(made.version)}", made.dump()):
        raise Conflict(f"version {made.version} of {path} was written by another run")
    return made


def drop_old_versions(path: str, keep: int) -> list[str]:
    """Delete all but the last ``keep`` versions and the folders that only those had; returns the folders.

    What a running or broken write left, which no version names, stays. Readers that hold
    a deleted version fail, so ``keep`` should span the longest read.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    store, root = _opened(path)
    old, kept = versions(path)[:-keep], versions(path)[-keep:]
    in_use = {f for v in kept for f in manifest(path, v).folders.values()}
    unused = sorted({f for v in old for f in manifest(path, v).folders.values()} - in_use)
    # The manifests first: a version that is listed has its folders.
    for v in old:
        store.delete_file(f"{root}/{MANIFESTS}/{_manifest_name(v)}")
    for folder in unused:
        store.delete_dir(f"{root}/{folder}")
    return unused
