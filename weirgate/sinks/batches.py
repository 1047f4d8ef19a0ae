"""Folders of micro-batches, which are merged as they grow old.

A micro-batch lies in a folder of its own, named by its query and number, so that a repeated one replaces what its first
run left. Spark repeats no batch but the last, so all earlier ones are settled: as soon as enough of them lie side by
side they become one folder, named by the first and last number it holds, and enough of those become one again. Each row
is written again as often as the logarithm of the number of batches, and few folders are left.

Names are the manifest: a folder counts unless another one of its query covers its numbers. A merged folder is
written out of sight and moved into place when it is complete, before what it covers is deleted, so that at any
moment, and after any failure, ``live`` gives every batch once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

#: Folders of about one age that are merged.
MERGED = 64
#: Bytes of a merged file, about.
FILE_BYTES = 128 << 20

_LABEL = re.compile(r"(?:(.*)-)?(\d+)(?:_(\d+))?")


class Folder(NamedTuple):
    path: str
    query: str | None
    first: int
    last: int

    @property
    def span(self) -> int:
        return self.last - self.first + 1

    def covers(self, other: Folder) -> bool:
        return self.query == other.query and self.first <= other.first and other.last <= self.last


def folder_of(path: str) -> Folder:
    """What a batch folder holds; those of batch tasks have a label of their own and never merge."""
    label = path.rstrip("/").rpartition("=")[2]
    found = _LABEL.fullmatch(label)
    if found is None:
        return Folder(path, label, 0, 0)
    first = int(found[2])
    return Folder(path, found[1] or "", first, first if found[3] is None else int(found[3]))


def live(paths: Iterable[str]) -> list[Folder]:
    """Folders without those that a merged one covers."""
    out: list[Folder] = []
    for folder in sorted(map(folder_of, paths), key=lambda f: (f.query, f.first, -f.last)):
        # Ranges lie side by side or inside each other, and the outer one comes first.
        if not out or not out[-1].covers(folder):
            out.append(folder)
    return out


def label_of(query: str | None, first: int, last: int | None = None) -> str:
    number = str(first) if last is None else f"{first}_{last}"
    return f"{query}-{number}" if query else number


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, root: str, pattern: str) -> list[str]:
    fs, target = file_system(spark, f"{root.rstrip('/')}/{pattern}")
    return [str(status.getPath()) for status in fs.globStatus(target) or []]


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def merge_settled(spark: SparkSession, root: str, column: str, query: str | None, batch: int, many: int,
                  read: Callable[[Sequence[str]], DataFrame], write: Callable[[DataFrame, str], None]) -> None:
    """Merge the folders of a query that hold batches before ``batch``, ``many`` of about one age at a time."""
    root = root.rstrip("/")
    every = [f for f in children(spark, root, f"{column}=*") if folder_of(f).query == (query or "")]
    folders = live(every)
    for path in set(every) - {f.path for f in folders}:
        _delete(spark, path)  # what an earlier run had merged before it ended
    span = 1
    while True:
        alike = [f for f in folders if f.last < batch and span <= f.span < span * many]
        if len(alike) < many:
            return
        first, last = min(f.first for f in alike), max(f.last for f in alike)
        within = [f for f in folders if f.first >= first and f.last <= last]
        label = label_of(query, first, last)
        hidden, place = f"{root}/_merging/{label}", f"{root}/{column}={label}"
        fs, target = file_system(spark, hidden)
        size = sum(fs.getContentSummary(file_system(spark, f.path)[1]).getLength() for f in within)
        write(read([f.path for f in within]).coalesce(max(1, -(-size // FILE_BYTES))), hidden)
        if not fs.rename(target, file_system(spark, place)[1]):
            raise OSError(f"{hidden} cannot be moved to {place}")
        for folder in within:
            _delete(spark, folder.path)
        folders = [f for f in folders if f not in within] + [Folder(place, query or "", first, last)]
        span *= many
