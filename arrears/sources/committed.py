"""Sinks that become visible at once: a folder per write, and a numbered manifest that names the current one.

A write goes to a folder of its own below the sink. Only when all its files are
there does a manifest appear (written aside, then renamed to the next number, which
fails if another writer took it). Readers follow the highest manifest, so a
write that dies half-way leaves the former rows readable. ``vacuum_sink`` removes
what no kept manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

MANIFESTS = "_manifests"


def _fs(spark: SparkSession, path: str):
    """(file system, function from text to its paths)."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, at = _fs(spark, path)
    folder = at(f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _name(path: str, number: int) -> str:
    return f"{path}/{MANIFESTS}/{number:012d}.json"


def _read(spark: SparkSession, name: str) -> dict:
    fs, at = _fs(spark, name)
    stream = fs.open(at(name))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The sink's current manifest (folder, fingerprint), or None for a folder without one."""
    numbers = _numbers(spark, path)
    return _read(spark, _name(path, numbers[-1])) if numbers else None


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the current rows lie: the committed folder, or ``path`` itself where nothing was ever committed."""
    found = manifest(spark, path)
    return f"{path}/{found['folder']}" if found else path


def commit(spark: SparkSession, path: str, write: Callable[[str], None], fingerprint: str | None = None) -> str:
    """Let ``write`` fill a new folder, then make it the current one; returns the folder."""
    fs, at = _fs(spark, path)
    before = _numbers(spark, path)
    folder = f"data-{uuid.uuid4().hex}"
    write(f"{path}/{folder}")
    aside = f"{path}/{MANIFESTS}/_{folder}"
    out = fs.create(at(aside), False)
    out.write(bytearray(json.dumps({"folder": folder, "fingerprint": fingerprint}).encode()))
    out.close()
    target = at(_name(path, (before[-1] if before else 0) + 1))
    if fs.exists(target) or not fs.rename(at(aside), target):
        fs.delete(at(aside), False)
        raise RuntimeError(f"another writer committed to {path} meanwhile; this write stays invisible")
    return f"{path}/{folder}"


def vacuum_sink(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete data folders that none of the last ``keep`` manifests names, and older manifests; no writer may be at work."""
    fs, at = _fs(spark, path)
    numbers = _numbers(spark, path)
    kept = {_read(spark, _name(path, n))["folder"] for n in numbers[-keep:]}
    gone = [s.getPath().getName() for s in fs.listStatus(at(path)) if s.getPath().getName().startswith("data-")] if numbers else []
    gone = [g for g in gone if g not in kept]
    for g in gone:
        fs.delete(at(f"{path}/{g}"), True)
    for n in numbers[:-keep]:
        fs.delete(at(_name(path, n)), False)
    return gone
