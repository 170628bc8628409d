"""JSON arrays and other runs of objects, read by many tasks however large a file is.

Spark's text reader cuts a file into blocks and, with a closing brace as the line separator,
into pieces that any task can read from anywhere.  Whether a piece lies in a string, and how
deep, depends on all bytes before it, so the file is scanned in two steps:

1. Every block is summed up on its own: whether its quotes change inside to outside, and
   how its brackets change the depth if it begins outside a string, or inside one.  A running
   sum over the blocks of a file, one small row each, gives the state every block begins in.
2. With that state a block finds the records in it.  A record belongs to the block it begins
   in; what lies in later blocks is read from their beginnings alone, before the last scan.

No text is shuffled, and a record is one value, as large as itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.sources.shared import stored

#: Blocks, and bytes of records that cross their borders, up to which states are sent to every task.
BROADCAST_BLOCKS, BROADCAST_BYTES = 100_000, 32 << 20
#: Bytes that a task scans at a time.
CHUNK = 4 << 20

_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_BETWEEN = re.compile(rb"[\s,\[\]}\xef\xbb\xbf]*")
_QUOTE, _BRACES = ord('"'), {ord("{"): 1, ord("["): 1, ord("}"): -1, ord("]"): -1}
_STEP = np.zeros(256, np.int8)
for _byte, _change in _BRACES.items():
    _STEP[_byte] = _change
_STRUCTURAL = _STEP != 0
_STRUCTURAL[_QUOTE] = True


def _marks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of brackets in ``text``, their steps in depth, whether an odd number of quotes comes
    before each, and the number of quotes.  Escaped characters count as none."""
    read = np.frombuffer(_ESCAPED.sub(b"  ", text), np.uint8)
    places = np.flatnonzero(_STRUCTURAL[read])
    codes = read[places]
    quotes = codes == _QUOTE
    odd = np.cumsum(quotes) & 1
    brackets = ~quotes
    return places[brackets], _STEP[codes[brackets]], odd[brackets].astype(bool), int(quotes.sum())


def _chunks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    """Runs of pieces of one block as bytes, in order: the block's values of ``columns``, whether
    the block begins with it, and its text.  The separator that the reader took is put back."""
    last = None
    for batch in batches:
        found = [batch.column(name).to_pylist() for name in ("value", *columns)]
        held: list[bytes] = []
        size = 0
        for value, *block in zip(*found, strict=True):
            if block != last or size > CHUNK:
                if held:
                    yield (*last, False, b"".join(held))
                if block != last:
                    yield (*block, True, b"")
                last, held, size = block, [], 0
            held += (value, b"}")
            size += len(value) + 1
        if held:
            yield (*last, False, b"".join(held))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: its first byte that counts, bytes, quotes and changes in depth."""
    rows: list[list] = []
    for file, begins, size, new, text in _chunks(batches, ("file", "begins", "size")):
        if new:
            rows.append([file, begins, size, None, 0, 0, 0, 0])
            continue
        row = rows[-1]
        if row[3] is None and (found := text.lstrip(b" \t\r\n\xef\xbb\xbf")):
            row[3] = chr(found[0])
        _, steps, odd, quotes = _marks(text)
        odd ^= bool(row[5] & 1)
        row[4] += len(text)
        row[5] += quotes
        row[6] += int(steps[~odd].sum())
        row[7] += int(steps[odd].sum())
    names = ["file", "begins", "size", "first", "bytes", "quotes", "from_outside", "from_inside"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=names)


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    return (
        spark.read.option("lineSep", "}")
        .text(paths)
        .select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("begins"),
            F.col("_metadata.file_size").alias("size"),
            F.monotonically_increasing_id().alias("line"),
        )
    )


def _states(pieces: DataFrame) -> DataFrame:
    """For each block whether it begins in a ``string``, its ``depth`` there, and the depth ``base`` of
    the file's records: 1 in an array, else 0.  A file that is cut off raises."""
    blocks = stored(
        pieces.mapInArrow(
            _summaries,
            "file string, begins bigint, size bigint, first string, bytes bigint, quotes bigint, "
            "from_outside bigint, from_inside bigint",
        ),
        "json-blocks",
    )
    by_file = Window.partitionBy("file").orderBy("begins")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    inside = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    change = F.when(F.col("string"), F.col("from_inside")).otherwise(F.col("from_outside"))
    all_blocks = by_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opened = F.first("first", ignorenulls=True).over(all_blocks)
    states = (
        blocks.withColumn("string", inside)
        .withColumn("change", change)
        .select(
            "file", "begins", "string", "size",
            F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("depth"),
            (opened == "[").cast("int").alias("base"),
            F.sum("change").over(whole).alias("end_depth"),
            (F.sum("quotes").over(whole) % 2 == 1).alias("end_string"),
            F.sum("bytes").over(whole).alias("read"),
        )
    )
    # What follows the last brace had none put back that was there.  The reader drops a byte order mark.
    more = F.col("read") - F.col("size")
    end = F.col("end_depth") + more.isin(1, 1 - 3).cast("int")
    wrong = states.filter(F.col("end_string") | (end != 0)).select("file").first()
    if wrong:
        raise ValueError(f"malformed JSON: {wrong['file']} is cut off or its brackets do not match")
    return states.select("file", "begins", "string", "depth", F.coalesce("base", F.lit(0)).alias("base"))


def _with_states(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """``pieces`` with their block's state, still in the order of the file."""
    size = states.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("rest")), F.lit(0))
    ).first()
    small = size[0] <= BROADCAST_BLOCKS and size[1] <= BROADCAST_BYTES
    state = states.withColumnsRenamed({"file": "of", "begins": "of_begins"})
    same = (F.col("file") == F.col("of")) & (F.col("begins") == F.col("of_begins"))
    joined = pieces.join(F.broadcast(state) if small else state, same, "left")
    if not small:
        joined = joined.sortWithinPartitions("file", "begins", "line")
    return joined.select("value", "file", "begins", "string", "depth", "base", "rest")


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block but a file's first: what it holds of a record begun before, and whether the
    record ends there.  Once it has ended the rest of a block is not scanned."""
    rows: list[list] = []
    done = True
    for file, begins, string, depth, base, new, text in _chunks(
        batches, ("file", "begins", "string", "depth", "base")
    ):
        if new:
            _known(base)
            done = begins == 0
            if not done:
                done = not string and depth <= base
                rows.append([file, begins, b"", done])
                inside, deep = string, depth
            continue
        if done:
            continue
        places, steps, odd, quotes = _marks(text)
        depths = deep + np.cumsum(np.where(odd ^ inside, 0, steps))
        ends = np.flatnonzero((depths == base) & (steps < 0) & (odd == inside))
        done = len(ends) > 0
        rows[-1][2] += text[: places[ends[0]] + 1] if done else text
        rows[-1][3] = done
        inside ^= bool(quotes & 1)
        deep = int(depths[-1]) if len(depths) else deep
    names, kinds = ["file", "begins", "head", "ended"], [pa.string(), pa.int64(), pa.binary(), pa.bool_()]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=names)


def _known(base: int | None) -> None:
    if base is None:
        raise RuntimeError("the blocks of a file changed while it was read")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that begin in each block, whole."""
    inside, deep, base, rest, open_record = False, 0, 0, b"", None
    skipping = False

    def finish() -> list[bytes]:
        return [] if open_record is None else [open_record + (rest or b"")]

    for _, begins, string, depth, base_now, rest_now, new, text in _chunks(
        batches, ("file", "begins", "string", "depth", "base", "rest")
    ):
        out: list[bytes] = []
        if new:
            _known(base_now)
            out = finish()
            inside, deep, base, rest, open_record = string, depth, base_now, rest_now, None
            skipping = begins > 0 and (string or depth > base)
        else:
            places, steps, odd, quotes = _marks(text)
            outside = odd == inside
            places, steps = places[outside], steps[outside].astype(np.int64)
            depths = deep + np.cumsum(steps)
            starts = places[(steps > 0) & (depths == base + 1)].tolist()
            ends = places[(steps < 0) & (depths == base)].tolist()
            at = 0
            if skipping:
                if ends:
                    at, skipping = ends.pop(0) + 1, False
                else:
                    at = len(text)
            elif open_record is not None:
                if ends:
                    at = ends.pop(0) + 1
                    out.append(open_record + text[:at])
                    open_record = None
                else:
                    open_record += text
                    at = len(text)
            for start in starts:
                _between(text[at:start])
                if ends:
                    at = ends.pop(0) + 1
                    out.append(text[start:at])
                else:
                    open_record, at = text[start:], len(text)
            _between(text[at:])
            inside ^= bool(quotes & 1)
            deep = int(depths[-1]) if len(depths) else deep
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
    if out := finish():
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def _between(text: bytes) -> None:
    if not _BETWEEN.fullmatch(text):
        raise ValueError(f"malformed JSON: {text[:80]!r} between records")


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``record``: the text of every object of the files, each an array of objects or a run of them.

    Files of any size, also on one line, are read by as many tasks as they have blocks
    (``spark.sql.files.maxPartitionBytes``).  Commas are not checked, and a record's own JSON is
    not either; anything else between records, or a file that is cut off, raises.  Files without
    records, also empty ones, have no rows.  Of a compressed file, which is one block, a cut in
    the last record is only found where the record is parsed.
    """
    pieces = _pieces(spark, [paths] if isinstance(paths, str) else list(paths))
    states = _states(pieces)
    nothing = states.withColumn("rest", F.lit(None).cast("binary"))
    heads = _with_states(pieces, nothing).drop("rest").mapInArrow(
        _heads, "file string, begins bigint, head binary, ended boolean"
    )
    # A head's owner is the last block before it in which a record can begin.
    order = Window.partitionBy("file").orderBy("begins").rowsBetween(Window.unboundedPreceding, -1)
    settled = F.when(F.col("ended"), F.col("begins"))
    owned = stored(heads, "json-heads").withColumn(
        "owner", F.coalesce(F.last(settled, ignorenulls=True).over(order), F.lit(0))
    )
    parts = F.array_sort(F.collect_list(F.struct("begins", "head")))
    rests = (
        owned.filter(F.octet_length("head") > 0)
        .groupBy("file", F.col("owner").alias("begins"))
        .agg(F.aggregate(parts, F.lit(b""), lambda x, p: F.concat(x, p["head"])).alias("rest"))
    )
    whole = stored(states.join(rests, ["file", "begins"], "left"), "json-states")
    return _with_states(pieces, whole).mapInArrow(_records, "record binary").select(
        F.col("record").cast("string").alias("record")
    )
