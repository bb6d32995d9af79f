"""Publishing a corpus at once, so that a run that dies leaves the one before it.

A corpus is written to an attempt, a folder of its own, with everything that belongs to it. Only when all of it is there a
manifest names the attempt: a small new file, numbered after those before it, that is either there or not. Readers take the
attempt of the manifest with the highest number. Nothing that a manifest names is written again. The attempt before the
current one stays until the next is published, for readers that began with it; earlier ones go.
"""

import uuid

from pyspark.sql import SparkSession

from sluice.sources.tables import delete_path, folder_names, read_small, write_small

ATTEMPTS, MANIFESTS = "attempts", "manifests"
KEPT = 2


def attempt(path: str) -> str:
    """A folder for the next corpus of ``path``; nobody reads it before it is published."""
    return f"{path}/{ATTEMPTS}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, folder: str) -> int:
    """Make an attempt the current corpus; the number of its manifest. Of two at a time one comes after the other."""
    name = folder.rsplit("/", 1)[-1]
    number = max(_numbers(spark, path), default=0) + 1
    while not write_small(spark, f"{path}/{MANIFESTS}/{number}", name, replace_it=False):
        number += 1
    sweep(spark, path)
    return number


def published(spark: SparkSession, path: str) -> str:
    """The folder of the current corpus; ``path`` itself if nothing was published there."""
    numbers = _numbers(spark, path)
    return f"{path}/{ATTEMPTS}/{read_small(spark, f'{path}/{MANIFESTS}/{max(numbers)}')}" if numbers else path


def sweep(spark: SparkSession, path: str) -> None:
    """Remove the manifests before the last ones, and the attempts that they named. An attempt that no manifest ever named
    may still be written by another run, so it stays."""
    numbers = sorted(_numbers(spark, path))
    old, kept = numbers[:-KEPT], numbers[-KEPT:]
    for number in old:
        name = read_small(spark, f"{path}/{MANIFESTS}/{number}")
        if name not in {read_small(spark, f"{path}/{MANIFESTS}/{k}") for k in kept}:
            delete_path(spark, f"{path}/{ATTEMPTS}/{name}")
        delete_path(spark, f"{path}/{MANIFESTS}/{number}")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in folder_names(spark, f"{path}/{MANIFESTS}") if n.isdigit()]
