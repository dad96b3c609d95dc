"""Fill-in-the-middle: a text cut in three and put in another order by rotating blocks in place.

The cuts are scanned in code points. The text's bytes go into a bytearray, the
sentinels are inserted where prefix, middle and suffix begin, and neighbouring
blocks change places by three reversals (each block, then both together). The
same rotations, the other way round, give the text back from the output alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.frames import fresh, row_groups, text_buffers

#: Before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of a hundred texts so many are cut, and of a hundred cut ones so many have the suffix first.
CUT, SUFFIX_FIRST = 90, 20
#: Bytes that a reversal or a scan holds besides the buffer.
BLOCK = 1 << 16


def reverse(buffer: bytearray, start: int, stop: int) -> None:
    """buffer[start:stop] backwards, exchanged from both ends towards the middle."""
    while stop - start > 1:
        step = min(BLOCK, (stop - start) // 2)
        left = buffer[start : start + step]
        right = buffer[stop - step : stop]
        left.reverse()
        right.reverse()
        buffer[start : start + step], buffer[stop - step : stop] = right, left
        start, stop = start + step, stop - step


def rotate(buffer: bytearray, start: int, cut: int, stop: int) -> None:
    """The blocks [start, cut) and [cut, stop) change places."""
    reverse(buffer, start, cut)
    reverse(buffer, cut, stop)
    reverse(buffer, start, stop)


def scan(body: np.ndarray, points: tuple[int, int]) -> list[int]:
    """The byte at which each of two code points (ascending, counted from 0; the end counts too) begins."""
    found, seen, at = [], 0, 0
    while len(found) < 2:
        first = np.flatnonzero((body[at : at + BLOCK] & 0xC0) != 0x80)
        while len(found) < 2 and (points[len(found)] < seen + len(first) or at >= len(body)):
            found.append(at + int(first[points[len(found)] - seen]) if at < len(body) else len(body))
        seen, at = seen + len(first), at + BLOCK
    return found


def arrange(text: bytes, middle: int, suffix: int, form: str) -> bytearray:
    """The output of a text whose middle and suffix begin at the given bytes."""
    buffer = bytearray(text)
    for at, mark in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix = middle + len(PREFIX), suffix + len(PREFIX) + len(MIDDLE)
    # prefix, middle, suffix: one exchange makes either order
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return buffer


def original(output: bytes, form: str) -> bytearray:
    """The text behind an output. A text that holds a sentinel itself is never cut, so each is there once."""
    buffer = bytearray(output)
    if form == PLAIN:
        return buffer
    if form == PSM:
        suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
        rotate(buffer, suffix, middle, len(buffer))
    else:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]
    return buffer


def decided(text: bytes, n: int, key: str, seed: int, cut: int, suffix_first: int) -> tuple[str, int, int]:
    """(form, code points before the middle, code points before the suffix)."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not n or any(s in text for s in SENTINELS) or h3 % 100 >= cut:
        return PLAIN, 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return SPM if h4 % 100 < suffix_first else PSM, a, b


def _strings(values: list) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def fill_in_middle(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    doc_id: str = "doc_id",
    text: str = "text",
    output: str = "output",
    seed: int = 1,
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """The columns keep, and n, form, prefix_chars, middle_chars and the output of every whole text.

    n counts code points. Cuts and form follow from the SHA-256 of
    ``seed:doc_id`` alone, so equal ids of equal texts give equal rows; a null
    id counts as an empty string. A null text is an empty one; an empty text,
    and one that holds a sentinel, stays plain (its counts are null). Other
    columns of docs aren't read; a kept one called as an added one is refused.
    """
    fields = [
        T.StructField("n", T.LongType(), False),
        T.StructField("form", T.StringType(), False),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField(output, T.StringType(), False),
    ]
    kept = docs.select(*keep)
    names = [f.name for f in fields]
    fresh(kept, *names)
    width = len(kept.columns)
    rows = docs.select(*keep, docs[doc_id].cast("string").alias("__key"), docs[text].alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text_buffers(batch.column(width + 1))
            keys = batch.column(width).to_pylist()
            for a, b in row_groups(offsets):
                made: list[tuple] = []
                for i in range(a, b):
                    part = body[offsets[i] : offsets[i + 1]]
                    raw = part.tobytes()
                    n = int(np.count_nonzero((part & 0xC0) != 0x80))
                    form, before, upto = decided(raw, n, keys[i] or "", seed, cut, suffix_first)
                    if form == PLAIN:
                        made.append((n, form, None, None, raw))
                    else:
                        at = [before, upto] if n == len(raw) else scan(part, (before, upto))
                        made.append((n, form, before, upto - before, bytes(arrange(raw, *at, form))))
                n, form, before, between, out = zip(*made)
                added = [pa.array(n, pa.int64()), pa.array(form), pa.array(before, pa.int64()), pa.array(between, pa.int64()), _strings(list(out))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in range(width)], *added], names=[*keep, *names])

    return rows.mapInArrow(work, T.StructType([*kept.schema.fields, *fields]))


def restore(frame: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """frame with the text rebuilt from output and form alone. A null output or form gives null."""
    fresh(frame, out)
    columns = frame.columns
    at, kind = columns.index(output), columns.index(form)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text_buffers(batch.column(at))
            there = batch.column(at).is_valid().to_pylist()
            forms = batch.column(kind).to_pylist()
            for a, b in row_groups(offsets):
                back = [
                    bytes(original(body[offsets[i] : offsets[i + 1]].tobytes(), forms[i])) if there[i] and forms[i] is not None else None
                    for i in range(a, b)
                ]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, _strings(back)], names=[*columns, out])

    return frame.mapInArrow(work, T.StructType([*frame.schema.fields, T.StructField(out, T.StringType())]))


#: The contract's columns in SQL.
FIM_SQL = """
with h as (
    select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as x from documents
), k as (
    select doc_id, t, length(t) as n, cast('0x' || x[1:8] as bigint) as h1, cast('0x' || x[9:16] as bigint) as h2,
        cast('0x' || x[17:24] as bigint) as h3, cast('0x' || x[25:32] as bigint) as h4
    from h
), c as (
    select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
            when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from k
), p as (
    select *, substr(t, 1, a) as pre, substr(t, a + 1, b - a) as mid, substr(t, b + 1) as suf from c
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
        else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
    sha256(t) as restored_sha256
from p
"""
