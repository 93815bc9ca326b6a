"""Layers that change by one step: data folders that are never touched again, and numbered pointers to them.

A version is a small file `_versions/<number>` that names its data folder. It is created only if it is absent, so of two
publishers that saw the same version one succeeds and the other is refused. Until that file is there and whole, readers
see the version before; nothing is renamed, which object stores would copy. A pointer that a crash left unfinished is
passed over, its number is not used again, and data folders that no pointer names are dropped by sweep().
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from strataflow.sources import files


class Conflict(RuntimeError):
    """Another publisher was first."""


def new_folder(path: str) -> str:
    return f"{path}.data/{uuid.uuid4().hex}"


def pointer(path: str, number: int) -> str:
    return f"{path}/_versions/{number:010d}"


def numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in files.names(spark, f"{path}/_versions") if n.isdigit()]


def version(spark: SparkSession, path: str, number: int) -> dict | None:
    """What a pointer says, or None if it is unfinished."""
    try:
        found = json.loads(files.read_text(spark, pointer(path, number)))
    except ValueError:
        return None
    return found | {"number": number}


def current(spark: SparkSession, path: str) -> dict | None:
    """The latest whole version."""
    return next((v for n in reversed(numbers(spark, path)) if (v := version(spark, path, n))), None)


def resolve(spark: SparkSession, path: str) -> str:
    """The folder that holds a layer's data now; a layer without versions is its own folder."""
    now = current(spark, path)
    return now["folder"] if now else path


def last_number(spark: SparkSession, path: str) -> int:
    """The greatest number that is taken, also by an unfinished pointer; 0 for none."""
    return max(numbers(spark, path), default=0)


def commit(spark: SparkSession, path: str, folder: str, seen: int, info: dict | None = None) -> int:
    """Makes folder the layer's data, if no version came after the number that the caller saw when it began."""
    text, number = json.dumps({"folder": folder, "info": info or {}}), seen + 1
    if last_number(spark, path) != seen:
        raise Conflict(f"{path} has changed since version {seen}")
    try:
        files.write_text(spark, pointer(path, number), text, replace=False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.toString()):
            raise Conflict(f"{path} got version {number} from another publisher") from e
        raise
    return number


def clean(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Drops the data folders of whole versions before the last `keep`. Pointers stay, a few bytes each. Folders that no
    pointer names are left: a publisher may be writing one."""
    old = [v["folder"] for n in numbers(spark, path)[:-keep] if (v := version(spark, path, n))]
    gone = [f for f in old if files.exists(spark, f)]
    for f in gone:
        files.delete(spark, f)
    return gone


def sweep(spark: SparkSession, path: str) -> list[str]:
    """Drops the data folders that no pointer names, left by publishers that died; only while nobody publishes."""
    named = {v["folder"].rsplit("/", 1)[1] for n in numbers(spark, path) if (v := version(spark, path, n))}
    gone = [n for n in files.names(spark, f"{path}.data") if n not in named]
    for n in gone:
        files.delete(spark, f"{path}.data/{n}")
    return gone
