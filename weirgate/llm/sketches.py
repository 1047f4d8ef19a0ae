"""Document fingerprints that can be subtracted: invertible Bloom lookup tables of paragraph digests.

A document is cut into paragraphs: its lines, and long lines again behind sentence ends. Each paragraph's digest,
with the number of its repetition mixed in, goes into one cell of each of three subtables: the cell's count,
the exclusive-or of its digests and the exclusive-or of their checks change. Subtracting two tables cell by
cell leaves only what differs. Cells with a single digest left can be read, and taking that digest out
of its other cells makes more of them readable, until all paragraphs are known that only one of the documents has.
If cells remain, both tables are built again, four times as large, and subtracted anew.

The fingerprint of a document is its table of the smallest size, as text. The likeness of two documents
is the share of paragraphs that both have among those that either has.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh64_intdigest

from weirgate.llm.common import Stages

#: Cells of a subtable; a power of two, as is the factor of growth. A digest names its cell in each of
#: the subtables by bits of its own.
CELLS = 8
GROWTH = 4
SUBTABLES = (0, 21, 42)
CHECK = 0x9E3779B97F4A7C15
CELL = struct.Struct("<QIi")
#: A line is cut behind the first sentence end after 60 code points, or after 300 more without one.
PARAGRAPH = re.compile(r"[^\n]{1,60}(?:[^\n.!?]{0,300}[.!?]*[^\S\n]*)?")


def paragraph_digests(text: str) -> list[int]:
    """A 64-bit digest of each paragraph; equal ones differ by how often they came before."""
    seen: dict[str, int] = {}
    digests = []
    for part in PARAGRAPH.findall(text):
        part = part.strip()
        if part:
            again = seen.get(part, 0)
            seen[part] = again + 1
            digests.append(xxh64_intdigest(part, again))
    return digests


def _check(digest: int) -> int:
    return (digest * CHECK >> 32) & 0xFFFFFFFF


class Sketch:
    """The table of some digests, with ``cells`` cells in each subtable.

    A row of small numbers rather than arrays: most documents have a few dozen paragraphs.
    """

    def __init__(self, digests: Iterable[int] = (), cells: int = CELLS) -> None:
        self.cells = cells
        size = cells * len(SUBTABLES)
        self.digests, self.checks, self.counts = [0] * size, [0] * size, [0] * size
        for digest in digests:
            self.change(digest, 1)

    def change(self, digest: int, by: int) -> None:
        """Put a digest in, or take it out, ``by`` 1 or -1."""
        check, mask, first = _check(digest), self.cells - 1, 0
        for shift in SUBTABLES:
            at = first + (digest >> shift & mask)
            self.digests[at] ^= digest
            self.checks[at] ^= check
            self.counts[at] += by
            first += self.cells

    def minus(self, other: Sketch) -> Sketch:
        left = Sketch(cells=self.cells)
        left.digests = [a ^ b for a, b in zip(self.digests, other.digests, strict=True)]
        left.checks = [a ^ b for a, b in zip(self.checks, other.checks, strict=True)]
        left.counts = [a - b for a, b in zip(self.counts, other.counts, strict=True)]
        return left

    def peel(self) -> tuple[list[int], list[int]] | None:
        """Digests with count 1 and with count -1; None if some can't be read. Empties the table."""
        found: dict[int, list[int]] = {1: [], -1: []}
        mask = self.cells - 1
        waiting = [at for at, count in enumerate(self.counts) if count in (1, -1)]
        while waiting:
            at = waiting.pop()
            sign, digest = self.counts[at], self.digests[at]
            if sign not in (1, -1) or _check(digest) != self.checks[at]:
                continue
            found[sign].append(digest)
            self.change(digest, -sign)
            waiting.extend(i * self.cells + (digest >> shift & mask) for i, shift in enumerate(SUBTABLES))
        if any(self.counts) or any(self.digests):
            return None
        return found[1], found[-1]

    def text(self) -> str:
        """The cells in order: digest, check and count, little-endian."""
        cells = zip(self.digests, self.checks, self.counts, strict=True)
        return base64.b64encode(b"".join(CELL.pack(*cell) for cell in cells)).decode()


def differing(one: list[int], other: list[int], small: tuple[Sketch, Sketch] | None = None) -> tuple[list, list]:
    """Digests only the first has, and only the second, from tables of as large a size as it takes.

    ``small`` are the tables of the smallest size, if they are there already.
    """
    cells = CELLS
    first, second = small or (Sketch(one), Sketch(other))
    while True:
        found = first.minus(second).peel()
        if found:
            return found
        cells *= GROWTH
        first, second = Sketch(one, cells), Sketch(other, cells)


def likeness(one: list[int], other: list[int], small: tuple[Sketch, Sketch] | None = None) -> float:
    """Shared paragraphs over all paragraphs, 0 to 1; two documents without any are alike."""
    only_one, only_other = differing(one, other, small)
    either = len(one) + len(only_other)
    return (len(one) - len(only_one)) / either if either else 1.0


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(key_type: pa.DataType):
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [key_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def one(key, text: str, digests: list, sketch: Sketch, following: str, next_digests: list, next_sketch: Sketch) -> tuple:
        changed = edited(text, following)
        changed_digests = paragraph_digests(changed)
        changed_sketch = Sketch(changed_digests)
        return (
            key, len(text), hashlib.sha256(changed.encode()).hexdigest(), sketch.text(), changed_sketch.text(),
            likeness(digests, changed_digests, (sketch, changed_sketch)),
            likeness(digests, next_digests, (sketch, next_sketch)),
        )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (range, key, text, digests, table) of the row before
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for part, ahead, key, text in zip(*columns, strict=True):
                digests = paragraph_digests(text)
                sketch = Sketch(digests)
                if before and before[0] == part:
                    rows.append(one(*before[1:], text, digests, sketch))
                before = None if ahead else (part, key, text, digests, sketch)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
                )

    return sweep


def _part_of(bounds: list[tuple[int, int]]):
    """The range of a row: how many ranges begin at it or before it, less one."""

    def part(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for place, tie in batches:
            yield pd.Series([bisect_right(bounds, row) - 1 for row in zip(place, tie, strict=True)], dtype="int32")

    return F.pandas_udf(part, "int")


def fingerprint_versions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The next document has the next larger key; after the last comes the first. Null keys come before all
    others, equal keys in order of a hash of their texts; equal rows follow each other. A null text is empty.
    A single document is its own next one, an empty table gives an empty one. Keys are whole numbers.

    Rows are dealt into ranges of keys, one per shuffle partition, whose first rows were found among the keys and
    hashes alone. The first row of a range is also sent to the range before, so every document meets its next
    one in a single shuffle of the texts, without ordering them in one place.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "versions")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("place"), F.xxhash64(body).alias("tie"),
        F.col(key).alias("key"), body.alias("text"),
    )
    places = rows.select("place", "tie").repartitionByRange(ranges, "place", "tie")
    starts = places.groupBy(F.spark_partition_id()).agg(F.min(F.struct("place", "tie")).alias("least"))
    bounds = sorted({(r.least.place, r.least.tie) for r in starts.collect()})  # one row per range
    before = [(place, tie, (at - 1) % len(bounds)) for at, (place, tie) in enumerate(bounds)]
    heads = spark.createDataFrame(before, "place bigint, tie bigint, part int")
    ahead = rows.join(F.broadcast(heads), ["place", "tie"]).dropDuplicates(["part"])
    ahead = stages.put(ahead.select("part", F.lit(True).alias("ahead"), "place", "tie", "key", "text"))
    part = _part_of(bounds)(F.col("place"), F.col("tie"))
    own = rows.select(part.alias("part"), F.lit(False).alias("ahead"), "place", "tie", "key", "text")
    dealt = own.unionByName(ahead).repartitionById(max(1, len(bounds)), F.col("part"))
    swept = dealt.sortWithinPartitions("part", "ahead", "place", "tie").select("part", "ahead", "key", "text")
    kind = rows.schema["key"].dataType.simpleString()
    result = swept.mapInArrow(
        _pairs(to_arrow_type(rows.schema["key"].dataType)),
        f"key {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
    stages.drop(ahead)
    return result.withColumnRenamed("key", key)
