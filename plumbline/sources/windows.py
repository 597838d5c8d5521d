"""Adaptive retrieval windows: a saturated window is split until it fits or can't be split further.

`plan` does this for all cells at once, a depth at a time, from counts of records by second; `fetch`
for one cell and a reader that asks a provider.  CellReader is a Spark data source over such a reader:
a partition a cell, so cells are fetched side by side.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from plumbline.session import shared_folder


@dataclass
class Outcome:
    """What a cell's windows gave: records in order, parents first, and whether none stayed saturated."""

    records: list = field(default_factory=list)
    complete: bool = True


def fetch(start: int, end: int, read: Callable[[int, int], list], *, cap: int = 250, most_depth: int = 6, least_span: int = 60, overlap: int = 1, depth: int = 0) -> Outcome:
    """Times are whole seconds.  read(start, end) returns a window's records, at most cap of them."""
    records = read(start, end)
    if len(records) < cap:
        return Outcome(list(records))
    middle = start + (end - start) // 2
    left_end = middle + overlap
    if depth >= most_depth or end - start <= least_span or left_end >= end or middle <= start:
        return Outcome(list(records), False)
    out = Outcome(list(records))
    for a, b in ((start, left_end), (middle, end)):
        part = fetch(a, b, read, cap=cap, most_depth=most_depth, least_span=least_span, overlap=overlap, depth=depth + 1)
        out.records += part.records
        out.complete &= part.complete
    return out


def plan(records: DataFrame, cells: DataFrame, *, cap: int = 250, most_depth: int = 6, least_span: int = 60, overlap: int = 1, most_cells: int = 10_000) -> DataFrame:
    """The windows that retrieval asks for: cell, depth, start, end, records (cap at most), complete.

    records: cell, at (whole seconds).  cells: cell, start, end; a dimension of most_cells rows at most.
    complete is false where a window stays saturated and can't be split.  Records are counted by second
    once; a depth's windows, 2 ** depth a cell at most, are sent to the counts.
    """
    spark = records.sparkSession
    shared_folder(spark)
    asked = [(r["cell"], int(r["start"]), int(r["end"])) for r in cells.select("cell", "start", "end").limit(most_cells + 1).collect()]
    if len(asked) > most_cells:
        raise ValueError(f"more than {most_cells} cells")
    named = f"cell {cells.schema['cell'].dataType.simpleString()}, start long, end long"
    counts = records.groupBy(F.col("cell").alias("_cell"), F.col("at").alias("_at")).agg(F.count("*").alias("n")).checkpoint()
    out = []
    for depth in range(most_depth + 1):
        now = spark.createDataFrame(asked, named)
        inside = (F.col("_cell") == F.col("cell")) & (F.col("_at") >= F.col("start")) & (F.col("_at") < F.col("end"))
        met = {(r["cell"], r["start"], r["end"]): r["n"] for r in counts.join(F.broadcast(now), inside).groupBy("cell", "start", "end").agg(F.sum("n").alias("n")).collect()}  # a row a window
        halves = []
        for cell, start, end in asked:
            n, middle = met.get((cell, start, end), 0), start + (end - start) // 2
            split = n >= cap and depth < most_depth and end - start > least_span and start < middle and middle + overlap < end
            out.append((cell, depth, start, end, min(n, cap), split or n < cap))
            halves += [(cell, start, middle + overlap), (cell, middle, end)] if split else []
        asked = halves
        if not asked:
            break
    return spark.createDataFrame(out, f"{named.split(',')[0]}, depth int, start long, end long, records long, complete boolean")


class _Cell(InputPartition):
    def __init__(self, name: str, start: int, end: int):
        super().__init__(name)
        self.name, self.start, self.end = name, start, end


class CellSource(DataSource):
    """spark.read.format("plumbline_cells"): options cells (JSON list of [name, start, end]) and reader ("module:function").

    The function gets (cell, start, end) and returns a window's records, JSON texts, `cap` of them at most; it runs on the executors.
    """

    @classmethod
    def name(cls) -> str:
        return "plumbline_cells"

    def schema(self) -> str:
        return "cell string, seq int, record string, complete boolean"

    def reader(self, schema) -> CellReader:
        return CellReader(self.options)


class CellReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.cells = [_Cell(str(c), int(a), int(b)) for c, a, b in json.loads(options["cells"])]
        self.module, _, self.function = options["reader"].partition(":")
        self.bounds = {k: int(options[k]) for k in ("cap", "most_depth", "least_span", "overlap") if k in options}

    def partitions(self) -> list[_Cell]:
        return self.cells

    def read(self, partition: _Cell) -> Iterator[tuple]:
        ask = getattr(importlib.import_module(self.module), self.function)
        out = fetch(partition.start, partition.end, lambda a, b: ask(partition.name, a, b), **self.bounds)
        for k, record in enumerate(dict.fromkeys(out.records)):  # windows overlap: each record once, in order of first sight
            yield partition.name, k, record, out.complete
