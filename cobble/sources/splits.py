"""Records of files that can't be cut at plain separators: CSV with newlines inside quotes, and the
features of a FeatureCollection document.

Spark cuts a file into splits and reads pieces of it (lines, or text up to a closing brace) from
all of them at once. Whether a piece begins inside a quoted field, inside a string or inside an
object depends on everything before it in its file, but only through a small state. So:

1. every split is run from each state that its beginning may be in, which gives its state map (one
   row a split);
2. the maps are composed in order of splits by a window over these rows, which gives each split's
   true state;
3. every split is run from its true state and gives its whole records. The record that it begins in
   the middle of and the one that it leaves open are its edges; those are put together apart.

No piece is shuffled: the scan's order of pieces within a split is all that the runs need. The file is read
three times (maps, edges, records), each time by all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cobble.operators.joins import broadcast_if_bounded
from cobble.session import shared_scratch

MAPS = "file string, block bigint, s0 int, s1 int, d0 bigint, d1 bigint"
EDGES = (
    "file string, block bigint, tail string, tail_closes boolean, head string, head_flag boolean, end_flag boolean, n bigint"
)
RECORDS = "file string, pos bigint, value string"

#: Rows given back to Spark at a time.
OUT_ROWS = 4096


class Machine(Protocol):
    """How pieces become records.

    ``joint`` puts the texts of a record's parts together. A state is (inside, depth, flag): inside a
    quoted field or string or not; how many objects and arrays are open; whether the open ones are of
    the wanted kind (None: not known yet).
    """

    joint: str

    def follow(self, inside: int, piece: str) -> tuple[int, int]:
        """State behind the piece, and the change in depth, from a state before it."""

    def run(self, pieces: Iterator[str], inside: int, depth: int, flag: bool | None) -> Iterator[tuple]:
        """("tail", text, closes), ("record", text, flag), ("head", text, flag) and at last ("end", flag or None)."""


# ------------------------------------------------------------------------------ CSV

_QUOTED = r'"[^"]*(?:""[^"]*)*"(?!")[^,]*'
_FIELDS = rf'(?:(?:{_QUOTED}|[^",][^,]*|),)*'
_OPEN = r'"[^"]*(?:""[^"]*)*'


class CsvLines:
    """Lines of a CSV file whose quoted fields (inner quotes doubled) may hold line ends. A quote counts at
    the beginning of a field only; what follows a closing quote belongs to the field."""

    joint = "\n"
    opens = re.compile(_FIELDS + _OPEN)
    stays = re.compile(r'[^"]*(?:""[^"]*)*')
    closes = re.compile(r'[^"]*(?:""[^"]*)*"(?!")[^,]*')

    def follow(self, inside: int, piece: str) -> tuple[int, int]:
        if not inside:
            return int('"' in piece and self.opens.fullmatch(piece) is not None), 0
        if '"' not in piece or self.stays.fullmatch(piece):
            return 1, 0
        m = self.closes.match(piece)
        rest = piece[m.end() + 1 :]
        return int(m.end() < len(piece) and self.opens.fullmatch(rest) is not None), 0

    @staticmethod
    def plain(text: str) -> str:
        """A record without its carriage return; where it has one, those at line ends inside it go too."""
        return text[:-1].replace("\r\n", "\n") if text.endswith("\r") else text

    def run(self, pieces: Iterator[str], inside: int, depth: int, flag: bool | None) -> Iterator[tuple]:
        held: list[str] | None = [] if inside else None
        tail = bool(inside)
        for piece in pieces:
            if held is None:
                if '"' not in piece or not self.opens.fullmatch(piece):
                    if text := piece.removesuffix("\r"):
                        yield "record", text, True
                else:
                    held, inside = [piece], 1
                continue
            held.append(piece)
            inside, _ = self.follow(1, piece)
            if not inside:
                text = "\n".join(held)
                yield ("tail", text, True) if tail else ("record", self.plain(text), True)
                held, tail = None, False
        if held is not None:
            yield ("tail", "\n".join(held), False) if tail else ("head", "\n".join(held), True)
        yield ("end", None)


# ------------------------------------------------------------------------------ features


class Features:
    """Text up to each closing brace of documents {..., "features": [{...}, ...], ...}: the objects of that array."""

    joint = ""
    string = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"', re.S)
    rest_of_string = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*', re.S)
    token = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"?|[\[\]{]', re.S)

    def follow(self, inside: int, piece: str) -> tuple[int, int]:
        if inside:
            end = self.rest_of_string.match(piece).end()
            if end == len(piece):
                return 1, 0
            piece = piece[end + 1 :]
        if '"' in piece:
            piece = self.string.sub("", piece)
            at = piece.find('"')
            if at >= 0:
                head = piece[:at]
                return 1, head.count("{") + head.count("[") - head.count("]")
        return 0, piece.count("{") + piece.count("[") - piece.count("]") - 1

    def run(self, pieces: Iterator[str], inside: int, depth: int, flag: bool | None) -> Iterator[tuple]:
        held: list[str] | None = [] if depth > 2 else None
        tail, key, changed = held is not None, "", False
        for piece in pieces:
            if tail and "]" in piece and (end := self._array_end(piece, inside, depth)) is not None:
                # What was open was an array within the array, and no object.
                held, tail, piece, inside, depth = None, False, piece[end:], 0, 2
            if held is None:
                start, inside, depth, key, flag, changed = self._look(piece, inside, depth, key, flag, changed)
                if start is None:
                    continue
                held = []
                piece = piece[start:]
                inside = 0
            held.append(piece + "}")
            inside, change = self.follow(inside, piece)
            depth += change
            if depth <= 2 and not inside:
                yield ("tail" if tail else "record"), "".join(held), (True if tail else flag)
                held, tail = None, False
        if held is not None:
            yield ("tail", "".join(held), False) if tail else ("head", "".join(held), flag)
        yield ("end", flag if changed else None)

    def _array_end(self, piece: str, inside: int, depth: int) -> int | None:
        """Where a closing bracket brings the depth down to 2."""
        at = self.rest_of_string.match(piece).end() + 1 if inside else 0
        for m in self.token.finditer(piece, at):
            if m[0] == "]":
                depth -= 1
                if depth == 2:
                    return m.end()
            elif m[0] in "{[":
                depth += 1
            elif not self.string.fullmatch(m[0]):
                return None
        return None

    def _look(self, piece, inside, depth, key, flag, changed):
        """Outside of wanted objects: where one begins in the piece (then at depth 2), else the state behind it."""
        at = 0
        if inside:
            at = self.rest_of_string.match(piece).end()
            if at == len(piece):
                return None, 1, depth, key, flag, changed
            at += 1
        for m in self.token.finditer(piece, at):
            c = m[0]
            if c == "{":
                if depth == 2 and flag is not False:
                    return m.start(), 0, 2, key, flag, changed
                depth += 1
            elif c == "[":
                if depth == 1:
                    flag, changed = key == '"features"', True
                depth += 1
            elif c == "]":
                depth -= 1
                if depth == 1:
                    flag, changed = False, True
            else:
                if not self.string.fullmatch(c):
                    return None, 1, depth, key, flag, changed
                if depth == 1:
                    key = c
        return None, 0, depth - 1, key, flag, changed


# ------------------------------------------------------------------------------ the three runs


def pieces(spark: SparkSession, paths: str | Sequence[str], sep: str) -> DataFrame:
    """(value, file, block): pieces up to ``sep``, with the split that they were read from."""
    text = spark.read.text([paths] if isinstance(paths, str) else list(paths), lineSep=sep)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


class _Out:
    """Rows on their way back to Spark."""

    def __init__(self, schema: str):
        self.names = [f.split()[0] for f in schema.split(", ")]
        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
        self.kinds = [kinds[f.split()[1]] for f in schema.split(", ")]
        self.rows: list[tuple] = []

    def take(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, self.kinds, strict=True)]
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, self.names)


def _by_split(batches: Iterator[pa.RecordBatch], state: Sequence[str] = ()) -> Iterator[tuple]:
    """(file, block, values of ``state``, iterator over the split's pieces), split by split."""
    names = ["file", "block", *state]
    waiting: list = []

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(n).to_pylist() for n in [*names, "value"]], strict=True)

    source = rows()
    first = next(source, None)
    while first is not None:
        key, waiting = first[:-1], []

        def own(first=first, key=key, waiting=waiting) -> Iterator[str]:
            yield first[-1]
            for row in source:
                if row[0] != key[0] or row[1] != key[1]:
                    waiting.append(row)
                    return
                yield row[-1]

        part = own()
        yield (*key, part)
        for _ in part:  # what was left unread
            pass
        first = waiting[0] if waiting else None


def _maps(machine: Machine) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(MAPS)
        for file, block, part in _by_split(batches):
            s, d = [0, 1], [0, 0]
            for piece in part:
                if piece is None:
                    continue
                if s[0] == s[1]:
                    s[0], change = machine.follow(s[0], piece)
                    s[1] = s[0]
                    d = [d[0] + change, d[1] + change]
                else:
                    for k in (0, 1):
                        s[k], change = machine.follow(s[k], piece)
                        d[k] += change
            out.rows.append((file, block, *s, *d))
        if out.rows:
            yield out.take()

    return run


def _edges(machine: Machine) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(EDGES)
        for file, block, inside, depth, part in _by_split(batches, ("inside", "depth")):
            tail = closes = head = head_flag = end_flag = None
            n = 0
            for kind, *what in machine.run(part, inside, depth, None):
                if kind == "tail":
                    tail, closes = what
                elif kind == "head":
                    head, head_flag = what
                elif kind == "end":
                    end_flag = what[0]
                else:
                    n += 1
            out.rows.append((file, block, tail, closes, head, head_flag, end_flag, n))
        if out.rows:
            yield out.take()

    return run


def _records(machine: Machine, skip_first: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(RECORDS)
        for file, block, inside, depth, flag, part in _by_split(batches, ("inside", "depth", "flag")):
            n = 0
            for kind, *what in machine.run(part, inside, depth, flag):
                if kind == "record" and what[1]:
                    if not (skip_first and not block and not n):
                        out.rows.append((file, block + n, what[0]))
                    n += 1
                    if len(out.rows) >= OUT_ROWS:
                        yield out.take()
        if out.rows:
            yield out.take()

    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_states(maps: DataFrame) -> DataFrame:
    """(file, block, inside, depth) at each split's beginning: the maps of the splits before it composed.

    A map of two states keeps them, swaps them or sends both to one. The state behind a split is that of
    the last map of the third kind, swapped once for every swapping map since.
    """
    order = Window.partitionBy("file").orderBy("block")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum(F.when((F.col("s0") == 1) & (F.col("s1") == 0), 1).otherwise(0)).over(upto) % 2
    rows = maps.withColumn("_x", swaps)
    fixed = F.when(F.col("s0") == F.col("s1"), (F.col("s0") + F.col("_x")) % 2)
    rows = rows.withColumn("_after", (F.coalesce(F.last(fixed, ignorenulls=True).over(upto), F.lit(0)) + F.col("_x")) % 2)
    rows = rows.withColumn("inside", F.coalesce(F.lag("_after").over(order), F.lit(0)).cast("int"))
    change = F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1"))
    return rows.select("file", "block", "inside", F.coalesce(F.sum(change).over(before), F.lit(0)).alias("depth"))


def _placed(parts: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces with their split's state, in the order in which they were read: a row a split is shipped to
    the scan; beyond the size bound the pieces are sorted instead."""
    small, check = broadcast_if_bounded(states)
    if check.broadcast:
        return parts.join(small, ["file", "block"])
    numbered = parts.withColumn("_id", F.monotonically_increasing_id())
    return numbered.join(small, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "_id")


def split_records(parts: DataFrame, machine: Machine, skip_first: bool = False, trimmed: Column | None = None) -> DataFrame:
    """(file, pos, value): the records of each file; ``pos`` orders them within it. ``skip_first`` leaves
    out the first of each file (a header). ``trimmed``: the pieces as far as the state maps need them."""
    seen = parts if trimmed is None else parts.select(trimmed.alias("value"), "file", "block")
    states = split_states(_written(seen.mapInArrow(_maps(machine), MAPS), "split-maps"))
    placed = _placed(parts, states)
    edges = _written(placed.mapInArrow(_edges(machine), EDGES), "split-edges")

    # A split's flag is the last one that a split before it ended with.
    order = Window.partitionBy("file").orderBy("block")
    flag = F.coalesce(F.last("end_flag", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    flagged = edges.withColumn("flag", F.lit(True) if isinstance(machine, CsvLines) else flag)

    ends = flagged.select(
        "file", "block", "n", "flag", F.explode(F.array(
            F.struct(F.lit(0).alias("part"), F.col("tail").alias("text"), F.col("tail_closes").alias("closes"), F.lit(True).alias("own")),
            F.struct(F.lit(1).alias("part"), F.col("head").alias("text"), F.lit(False).alias("closes"),
                     F.coalesce("head_flag", "flag").alias("own")),
        )).alias("e"),
    ).select("file", "block", "n", "e.*").filter("text IS NOT NULL")
    begun = F.sum("part").over(Window.partitionBy("file").orderBy("block", "part"))
    stitched = (
        ends.withColumn("_g", begun)
        .groupBy("file", "_g")
        .agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "text"))), lambda x: x["text"]), machine.joint).alias("value"),
            F.max(F.when(F.col("part") == 1, F.struct("block", "n", "own"))).alias("h"),
            F.max("closes").alias("closed"),
        )
        # An unclosed quote reaches to the file's end, as a reader of the whole file has it; an unclosed object is none.
        .filter("h IS NOT NULL AND h.own" + ("" if isinstance(machine, CsvLines) else " AND closed"))
    )
    if skip_first:
        stitched = stitched.filter("NOT (h.block = 0 AND h.n = 0)")
    plain = "CASE WHEN endswith(value, '\r') THEN replace(left(value, length(value) - 1), '\r\n', '\n') ELSE value END"
    stitched = stitched.select("file", (F.col("h.block") + F.col("h.n")).alias("pos"), F.expr(plain).alias("value"))

    known = _placed(parts, states.join(flagged.select("file", "block", "flag"), ["file", "block"]))
    return known.mapInArrow(_records(machine, skip_first), RECORDS).unionByName(stitched)


def csv_records(spark: SparkSession, paths: str | Sequence[str], header: bool) -> DataFrame:
    """(file, pos, value): the records of CSV files as text, those with line ends inside quotes whole."""
    lines = pieces(spark, paths, "\n")
    quoted = F.when(F.col("value").contains('"'), F.col("value"))
    return split_records(lines, CsvLines(), header, quoted)


def feature_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, pos, value): the JSON text of every feature of FeatureCollection documents."""
    return split_records(pieces(spark, paths, "}"), Features())
