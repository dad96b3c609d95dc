"""Small helpers the operators share: Arrow text columns, row groups of bounded size, stable rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_root

#: Bytes of text that a task turns into numpy arrays at once.
GROUP_BYTES = 1 << 20


def stored(df: DataFrame) -> DataFrame:
    """df written once to the shared checkpoint folder: later uses read the files, also after a lost executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def in_training(doc_id: str, folds: int, fold: int) -> Column:
    """True unless crc32(doc_id as text) mod folds is fold; a null id is never used for training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds != fold, F.lit(False))


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """True if crc32(doc_id as text) mod folds is fold; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def fresh(df: DataFrame, *names: str) -> None:
    """Refuse columns that would be added a second time (Spark compares names without regard to case)."""
    have = {c.lower() for c in df.columns}
    clash = [n for n in names if n.lower() in have]
    if clash:
        raise ValueError(f"columns already there: {clash}; choose other output names")


#: Row numbers that are broadcast, at most (8 bytes each); more are joined by their hash.
BROADCAST_ROWS = 500_000
ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a number for each row, the same whenever the stored table behind docs is read in this session."""
    fresh(docs, ROW)
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def without(docs: DataFrame, rows: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Numbered docs less those whose number is in rows (a column called as there), and without the number."""
    rows = stored(rows.select(ROW).distinct())
    rows = F.broadcast(rows) if rows.count() <= broadcast_rows else rows.hint("shuffle_hash")
    return docs.join(rows, ROW, "left_anti").drop(ROW)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets of length rows + 1) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    base = int(ends[0])
    body = np.frombuffer(data, np.uint8)[base : int(ends[-1])] if data is not None else np.empty(0, np.uint8)
    return body, ends - base


def row_groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows with at most limit bytes together; a longer row stands alone."""
    n, start = len(offsets) - 1, 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def slabs(text: bytes, limit: int = GROUP_BYTES, overlap_words: int = 0) -> Iterator[bytes]:
    """A long text in pieces of about limit bytes, cut at a space (else between code points).

    Each piece after the first begins overlap_words words earlier, so that
    features over neighbouring words are all seen (some twice).
    """
    start, n = 0, len(text)
    while True:
        end = min(start + limit, n)
        if end < n:
            space = text.rfind(b" ", start + limit // 2, end)
            end = space if space > 0 else end
            while end > start + 1 and end < n and text[end] & 0xC0 == 0x80:
                end -= 1
        yield text[start:end]
        if end >= n:
            return
        back = end
        for _ in range(overlap_words):
            found = text.rfind(b" ", start + 1, back)
            if found <= start:
                break
            back = found
        start = back


def mapped(
    docs: DataFrame,
    keep: tuple[str, ...],
    text: str,
    fields: list[T.StructField],
    kernel: Callable[[], Callable[[np.ndarray, np.ndarray], list]],
) -> DataFrame:
    """The columns keep and, for each row, what the kernel makes of its text.

    kernel() runs once a task and gives a function from (bytes, offsets) of
    some neighbouring rows, at most ``GROUP_BYTES`` or one row, to one list or
    array for each of fields.
    """
    kept = docs.select(*keep)
    fresh(kept, *[f.name for f in fields])
    names = [*kept.columns, *[f.name for f in fields]]
    width = len(kept.columns)
    rows, at = (kept, kept.columns.index(text)) if text in kept.columns else (docs.select(*keep, docs[text].alias("__text")), width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = kernel()
        for batch in batches:
            body, offsets = text_buffers(batch.column(at))
            found: list[list] = [[] for _ in fields]
            for a, b in row_groups(offsets):
                for out, values in zip(found, made(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])):
                    out.append(pa.array(values))
            columns = [batch.column(i) for i in range(width)]
            added = [pa.concat_arrays(x) if x else None for x in found]
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*columns, *added], names=names)

    return rows.mapInArrow(work, T.StructType([*kept.schema.fields, *fields]))


def within(rows: Iterator[tuple], size: Callable[[tuple], int], most: int) -> list[tuple]:
    """The rows from the first on whose sizes together stay within most; at least one."""
    out: list[tuple] = []
    for row in rows:
        most -= size(row)
        if most < 0 and out:
            break
        out.append(row)
    return out


def listed(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The named columns row by row; a list column gives slices of one numpy array."""
    columns: list = []
    for name in names:
        c = batch.column(name)
        if pa.types.is_list(c.type):
            values, ends = c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()
            columns.append([values[a:b] for a, b in zip(ends, ends[1:])])
        else:
            columns.append(c.to_pylist())
    return zip(*columns)


def labelled(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, folds: int, fold: int, rows: int) -> DataFrame:
    """(__id, __label, __order, text) of at most rows labelled ids outside the held-out fold; labels are 0 or 1.

    The ids are those of the smallest hashes, so the choice doesn't depend on
    the order of the tables; of an id labelled twice the larger label holds.
    Null ids and labels other than 0 and 1 are left out. Only the chosen ids
    (rows of 24 bytes) are broadcast.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label"))
        .where(F.col("__label").isin(0, 1))
        .where(in_training("__id", folds, fold))
        .groupBy("__id")
        .agg(F.max("__label").alias("__label"))
        .withColumn("__order", F.xxhash64("__id"))
        .orderBy("__order", "__id")
        .limit(rows)
    )
    return docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).join(F.broadcast(chosen), "__id")
