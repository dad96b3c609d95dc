"""``feature_layer``: a Python data source that reads a layer as typed rows.

Where ``feature_pages`` gives pages to be decoded by DataFrame operators, this
one gives features: its schema comes from the layer's own metadata
(``fields[]``), a value that isn't of its declared type raises, and filters of
``DataFrame.where`` on attributes reach the read:

* of a live layer they are sent as part of the request's ``where``;
* of a landed layer a page whose summary (``summarize_pages``) can't hold a
  matching row isn't opened, and of the others the filtered attributes are
  decoded first and the rest only for the rows that pass.

Every filter is also handed back to Spark, so a server that compares text in
its own way doesn't change the result. With ``predicates`` (key chunks, see
``operators.keys.key_chunks``) a live layer is asked for each chunk by a task of
its own; of a landed one every page that may hold one of the keys is opened
once, whatever the number of chunks. Options are those of ``feature_pages`` and ``push_filters`` (false; ``load_layer``
sets it where the session has ``spark.sql.python.filterPushdown.enabled``, which
``get_session`` does; without it all rows are read and Spark filters them). Every read is idempotent, so task retries are safe.

With ``returnGeometry`` the rows also have a column ``geometry_raw``: a feature's
geometry as its page holds it, taken for the rows that pass only.
``load_layer(with_geometry=True)`` makes the typed ``geometry`` of it, a
projection above the read, through which filters on attributes still go down.
"""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import json
import math
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_type

from tessera.schemas import schema_from_fields
from tessera.sources import feature_source as S
from tessera.sources.binary import BROKEN, GEOMETRY_ARROW, Page, decode_geometries
from tessera.sources.pages import fault, geometry_from_text

#: Rows that leave a task at once.
BATCH_ROWS = 10_000
#: Bits of a page's key filter for each of its rows, and places a key has in it.
KEY_BITS, KEY_PLACES = 16, 3

#: A feature's geometry as its page holds it: the text of a JSON page, or what a binary one says of it.
RAW = "geometry_raw"
_RAW_ARROW = pa.struct([("text", pa.string()), *GEOMETRY_ARROW])
_RAW_TYPE = from_arrow_type(_RAW_ARROW)

# ---------------------------------------------------------------------------
# Values
# ---------------------------------------------------------------------------

_WHOLE = {T.ShortType: (15, pa.int16()), T.IntegerType: (31, pa.int32()), T.LongType: (63, pa.int64())}
_REAL = {T.FloatType: pa.float32(), T.DoubleType: pa.float64()}


class NotOfType(ValueError):
    pass


#: What a body that isn't a page raises while it is read.
CORRUPT = (*BROKEN, KeyError, TypeError, AttributeError)


def _whole(value, bits: int) -> int:
    if isinstance(value, str):
        try:
            value = int(value)
        except ValueError:
            value = float(value)
    if isinstance(value, bool) or value != int(value) or not -(1 << bits) <= int(value) < 1 << bits:
        raise ValueError
    return int(value)


def _real(value) -> float:
    if isinstance(value, bool):
        raise ValueError
    return float(value)


def _text(value) -> str:
    if not isinstance(value, str):
        raise ValueError
    return value


def arrow_type(dtype: T.DataType, name: str) -> pa.DataType:
    if type(dtype) in _WHOLE:
        return _WHOLE[type(dtype)][1]
    if type(dtype) in _REAL:
        return _REAL[type(dtype)]
    if isinstance(dtype, T.StringType):
        return pa.string()
    if isinstance(dtype, T.DateType):
        return pa.date32()
    raise ValueError(f"field {name}: values of type {dtype.simpleString()} aren't read; leave it out with the option fields")


def typed_values(values: list, dtype: T.DataType, name: str) -> pa.Array:
    """The values as an Arrow column of the declared type; null stays null, anything else that isn't one raises."""
    kind = type(dtype)
    arrow = arrow_type(dtype, name)
    kinds = set(map(type, values)) - {type(None)}
    try:
        if kind in _REAL and kinds <= {float, int} or kind in _WHOLE and kinds <= {int} or kind is T.StringType and kinds <= {str}:
            return pa.array(values, arrow)
    except (pa.ArrowInvalid, OverflowError):
        pass  # told below, with the value
    if kind in _WHOLE:
        bits = _WHOLE[kind][0]
        take = lambda v: _whole(v, bits)
    else:
        take = {T.FloatType: _real, T.DoubleType: _real, T.DateType: lambda v: dt.date.fromisoformat(_text(v))}.get(kind, _text)
    out = []
    for v in values:
        try:
            out.append(None if v is None else take(v))
        except (ValueError, OverflowError, TypeError) as e:
            raise NotOfType(f"attribute {name}: not a {dtype.simpleString()}: {v!r}") from e
    return pa.array(out, arrow)


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------

_COMPARED = {"EqualTo": "=", "EqualNullSafe": "=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<", "LessThanOrEqual": "<="}
_LIKE = {"StringStartsWith": "{}%", "StringEndsWith": "%{}", "StringContains": "%{}%"}


@dataclass(frozen=True)
class Test:
    """A filter on one attribute: op is a comparison, in, null, like (value: kind of match, text); negated turns it round."""

    __test__ = False  # not a test case

    column: str
    op: str
    value: object = None
    negated: bool = False

    def sql(self) -> str:
        """The filter as the text of a request's where."""
        if self.op == "null":
            return f"{self.column} IS {'NOT ' if self.negated else ''}NULL"
        if self.op == "in":
            text = f"{self.column} IN ({','.join(map(_literal, self.value))})"
        elif self.op == "like":
            text = f"{self.column} LIKE {_literal(_LIKE[self.value[0]].format(self.value[1]))}"
        else:
            text = f"{self.column} {self.op} {_literal(self.value)}"
        return f"NOT ({text})" if self.negated else text

    @cached_property
    def _known(self) -> frozenset | None:
        return frozenset(self.value) if self.op == "in" else None

    @cached_property
    def _ordered(self) -> list:
        return sorted(self._known if self.op == "in" else (self.value,))

    def passing(self, values: list) -> np.ndarray:
        """Which values pass; a null passes none but a test for nulls."""
        known = self._known
        return np.fromiter((self._passes(v, known) for v in values), bool, len(values))

    def _passes(self, v, known: frozenset | None) -> bool:
        if self.op == "null":
            return (v is None) != self.negated
        if v is None:
            return False
        if self.op == "in":
            hit = v in known
        elif self.op == "like":
            kind, part = self.value
            hit = v.startswith(part) if kind == "StringStartsWith" else v.endswith(part) if kind == "StringEndsWith" else part in v
        else:
            w = self.value
            hit = {"=": v == w, ">": v > w, ">=": v >= w, "<": v < w, "<=": v <= w}[self.op]
            if isinstance(v, float) and math.isnan(v):  # the largest number, as in Spark
                hit = self.op in (">", ">=")
        return hit != self.negated

    def possible(self, summary: dict) -> bool:
        """False if no row of a page with this summary of the attribute can pass."""
        if self.op == "null":
            return bool(summary["rows"] - summary["nulls"] if self.negated else summary["nulls"])
        low, high = summary["low"], summary["high"]
        if low is None:
            return summary["nulls"] < summary["rows"]  # nothing but nulls, or values without an order
        if self.negated or self.op == "like":
            return True
        if self.op in ("in", "="):
            words = self._ordered
            return _may_hold(summary["keys"], words, bisect.bisect_left(words, low), bisect.bisect_right(words, high))
        w = self.value
        return {">": high > w, ">=": high >= w, "<": low < w, "<=": low <= w}[self.op]


def _literal(v) -> str:
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)


def _plain(v, dtype: T.DataType) -> bool:
    """Whether a value can be said in a request and compared with the attribute's values."""
    if isinstance(dtype, T.StringType):
        return isinstance(v, str)
    if type(dtype) in _WHOLE:
        return isinstance(v, int) and not isinstance(v, bool)
    if type(dtype) in _REAL:
        return isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v)
    return False


def test_of(f, schema: T.StructType) -> Test | None:
    """The test of a Spark filter, or None if it is one that can't be told to a layer."""
    kind = type(f).__name__
    if kind == "Not":
        inner = test_of(f.child, schema) if type(f.child).__name__ != "EqualNullSafe" else None
        return None if inner is None or inner.negated else Test(inner.column, inner.op, inner.value, True)
    name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if name not in schema.fieldNames():
        return None
    dtype = schema[name].dataType
    if kind in ("IsNull", "IsNotNull"):
        return Test(name, "null", negated=kind == "IsNotNull")
    if kind == "EqualNullSafe" and f.value is None:
        return Test(name, "null")
    if kind == "In":
        values = tuple(v for v in f.value if v is not None)
        return Test(name, "in", values) if values and len(values) == len(f.value) and all(_plain(v, dtype) for v in values) else None
    if kind in _COMPARED:
        return Test(name, _COMPARED[kind], f.value) if _plain(f.value, dtype) else None
    if kind in _LIKE and isinstance(f.value, str) and isinstance(dtype, T.StringType) and not set(f.value) & set("%_\\[]"):
        return Test(name, "like", (kind, f.value))
    return None


_KEYS = re.compile(r"\s*(\w+)\s*(?:=\s*(-?\d+)|IN\s*\(\s*(-?\d+(?:\s*,\s*-?\d+)*)\s*\))\s*", re.I)


def key_tests(predicates: list[str] | None) -> list[Test]:
    """The test for the keys of all chunks (of one field) together; none without chunks, one that nothing passes for no chunk."""
    if predicates is None:
        return []
    fields, keys = set(), []
    for text in predicates:
        m = _KEYS.fullmatch(text)
        if not m:
            raise ValueError(f"of a landed layer a predicate is FIELD=number or FIELD IN (numbers): {text[:100]!r}")
        fields.add(m[1])
        keys += map(int, (m[2] or m[3]).split(","))
    if len(fields) > 1:
        raise ValueError(f"key chunks of several fields: {sorted(fields)}")
    return [Test(name, "in", tuple(keys)) for name in fields]


# ---------------------------------------------------------------------------
# Page summaries
# ---------------------------------------------------------------------------


def _hash(key) -> int:
    """64 bits of a key; 5 and 5.0 are one."""
    return int.from_bytes(hashlib.blake2b((key if isinstance(key, str) else repr(float(key))).encode(), digest_size=8).digest(), "little")


_cached_hash = lru_cache(maxsize=1 << 16)(_hash)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return np.array([(hashes >> np.uint64(20 * i)) & np.uint64(bits - 1) for i in range(KEY_PLACES)]).astype(np.int64)


def key_filter(keys: set) -> bytes:
    """Bits that tell of most other keys that they aren't among these."""
    bits = min(1 << 20, max(64, 1 << (len(keys) * KEY_BITS).bit_length()))
    held = np.zeros(bits, bool)
    held[_places(np.fromiter(map(_hash, keys), np.uint64, len(keys)), bits).ravel()] = True
    return np.packbits(held, bitorder="little").tobytes()


def _may_hold(filter_: bytes | None, keys: list, first: int, last: int) -> bool:
    """Whether one of keys[first:last] may be among those of the filter.

    Of more keys than the filter has bits some would pass it by chance, so these
    aren't looked up: a page's work is bounded by its rows, not by the keys asked for.
    """
    if first >= last:
        return False
    if not filter_ or last - first > len(filter_) * 8:
        return True
    held = np.frombuffer(filter_, np.uint8)
    at = _places(np.fromiter(map(_cached_hash, keys[first:last]), np.uint64, last - first), len(held) * 8)
    return bool((held[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=0).any())


#: Pages whose summaries are a folder ``run=<n>`` of their own, so that a task opens those of its pages alone.
SUMMARY_RUN = 256
SUMMARY_DDL = "page bigint, field string, rows bigint, nulls bigint, low double, high double, low_text string, high_text string, keys binary"


def summarize_pages(pages: DataFrame, root: str, fields: list[str]) -> None:
    """Writes ``<root>/summary``: for each page and named attribute rows, nulls, least and greatest value and key bits.

    One pass over a page table, in Spark tasks. Values are taken as the type
    that ``<root>/layer.json`` declares, so those of binary pages have an order
    too; a page at fault, or with a value of another type, gets no summary and
    is always read.
    """
    declared = FeatureLayer({"path": root}).declared()
    unknown = set(fields) - set(declared.fieldNames())
    if unknown:
        raise ValueError(f"the layer has no field {sorted(unknown)}")
    types_of = {f: declared[f].dataType for f in fields}

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, body in zip(batch.column("page").to_pylist(), batch.column("body")):
                try:
                    held = read_page(body.as_py())
                    columns = [typed_values(v, types_of[f], f).to_pylist() for f, v in zip(fields, held.values(fields, None))]
                except CORRUPT:
                    continue
                for name, values in zip(fields, columns):
                    there = [v.isoformat() if isinstance(v, dt.date) else v for v in values if v is not None]
                    text = any(isinstance(v, str) for v in there)
                    ends = (min(there), max(there)) if there and not any(v != v for v in there) else (None, None)
                    row = (page, name, len(values), len(values) - len(there))
                    numbers = (None, None) if text or ends[0] is None else (math.nextafter(float(ends[0]), -math.inf), math.nextafter(float(ends[1]), math.inf))
                    out.append((*row, *numbers, *(ends if text else (None, None)), key_filter(set(there)) if ends[0] is not None else None))
            columns = list(zip(*out)) or [()] * 9
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split()[0] for c in SUMMARY_DDL.split(", ")])

    found = pages.select("page", "body").mapInArrow(summaries, SUMMARY_DDL).withColumn("run", F.floor(F.col("page") / SUMMARY_RUN))
    found.repartition("run").sortWithinPartitions("run", "page").write.partitionBy("run").parquet(f"{root.rstrip('/')}/summary")


def pages_to_read(root: str, tests: list[Test], first: int, last: int) -> list[int]:
    """The pages of [first, last) that may hold a row passing all tests, by the summaries that there are."""
    import pyarrow.dataset as ds
    import pyarrow.fs as pafs

    every = list(range(first, last))
    fs, base = S.open_fs(root)
    where = f"{base.rstrip('/')}/summary"
    if not tests or fs.get_file_info(where).type != pafs.FileType.Directory:
        return every
    names = list({t.column for t in tests})
    known = (ds.field("page") >= first) & (ds.field("page") < last) & ds.field("field").isin(names)
    out: set[int] = set()
    for run in range(first // SUMMARY_RUN, (last - 1) // SUMMARY_RUN + 1):
        folder = f"{where}/run={run}"
        if fs.get_file_info(folder).type != pafs.FileType.Directory:
            continue  # no page of the run has a summary
        for batch in ds.dataset(folder, filesystem=fs, format="parquet", exclude_invalid_files=True).to_batches(filter=known, batch_size=256):
            for row in batch.to_pylist():
                text = row["low_text"] is not None
                summary = row | ({"low": row["low_text"], "high": row["high_text"]} if text else {})
                mine = [t for t in tests if t.column == row["field"]]
                if not all(_possible(t, summary, text) for t in mine):
                    out.add(row["page"])
    return [p for p in every if p not in out]


def _possible(t: Test, summary: dict, text: bool) -> bool:
    words = t.value if t.op == "in" else () if t.op in ("null", "like") else (t.value,)
    if any(isinstance(w, str) != text for w in words) and summary["low"] is not None:
        return True  # numbers held as text, or the other way round
    return t.possible(summary)


# ---------------------------------------------------------------------------
# Pages
# ---------------------------------------------------------------------------


class JsonPage:
    def __init__(self, body: bytes):
        doc = json.loads(body)
        if not isinstance(doc, dict):
            raise ValueError("not a page")
        features = doc.get("features") or []
        self.count, self.exceeded = len(features), bool(doc.get("exceededTransferLimit"))
        self.error = (doc["error"] or {}).get("code", 0) if doc.get("error") is not None else None
        self.features = [f for f in features if f and f.get("attributes") is not None]
        self.rows = [f["attributes"] for f in self.features]

    def shapes(self, rows: np.ndarray | None) -> pa.Array:
        """The geometries as ``geometry_raw``."""
        some = self.features if rows is None else [self.features[i] for i in rows.tolist()]
        shapes = [f.get("geometry") for f in some]
        texts = pa.array([None if g is None else json.dumps(g) for g in shapes], pa.string())
        return pa.StructArray.from_arrays([texts, *[pa.nulls(len(some), t) for _, t in GEOMETRY_ARROW]], fields=list(_RAW_ARROW))

    def values(self, names: list[str], rows: np.ndarray | None) -> list[list]:
        some = self.rows if rows is None else [self.rows[i] for i in rows.tolist()]
        return [[r.get(n) for r in some] for n in names]


class BinaryPage:
    def __init__(self, body: bytes):
        self.page = Page(body)
        self.count, self.exceeded, self.error = len(self.page.spots), self.page.exceeded, None
        self.rows = self.page.spots

    @contextmanager
    def _only(self, rows: np.ndarray | None) -> Iterator[Page]:
        """The page as if it held these features alone."""
        spots = self.page.spots
        if rows is not None:
            self.page.spots = [spots[i] for i in rows.tolist()]
        try:
            yield self.page
        finally:
            self.page.spots = spots

    def values(self, names: list[str], rows: np.ndarray | None) -> list[list]:
        with self._only(rows) as page:
            return page.features({n: i for i, n in enumerate(names)}, False)[0]

    def shapes(self, rows: np.ndarray | None) -> pa.Array:
        """The geometries as ``geometry_raw``."""
        with self._only(rows) as page:
            n, own = len(page.spots), page.columns({}, True)[1]
            same = (page.default_type, page.wkid, page.origin, *page.scale, *page.shift)
            columns = [pa.nulls(n, pa.string()), *[pa.array([x] * n, t) for x, (_, t) in zip(same, GEOMETRY_ARROW)], *own]
        return pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(columns, _RAW_ARROW)], fields=list(_RAW_ARROW))


def read_page(body: bytes) -> JsonPage | BinaryPage:
    """A page by what its body looks like: servers answer errors in JSON whatever was asked for."""
    return JsonPage(body) if body.lstrip()[:1] in (b"{", b"[") else BinaryPage(body)


def page_columns(held: JsonPage | BinaryPage, schema: T.StructType, tests: list[Test], shaped: bool = False) -> tuple[int, list[pa.Array]]:
    """(rows that pass, their columns): the tested attributes are typed first, the others and (shaped, last) the geometries for the rows that pass."""
    names = schema.fieldNames()
    n, rows = len(held.rows), None
    made: dict[str, pa.Array] = {}
    tested = sorted({t.column for t in tests}, key=names.index)
    for name, values in zip(tested, held.values(tested, None) if tested else []):
        made[name] = typed_values(values, schema[name].dataType, name)
    if tests:
        ok = np.ones(n, bool)
        for t in tests:
            ok &= t.passing(made[t.column].to_pylist())
        rows = np.flatnonzero(ok)
        if len(rows) == n:
            rows = None
        else:
            made = {k: v.take(pa.array(rows)) for k, v in made.items()}
            n = len(rows)
    rest = [f for f in names if f not in made]
    if n and rest:
        for name, values in zip(rest, held.values(rest, rows)):
            made[name] = typed_values(values, schema[name].dataType, name)
    columns = [made.get(f, pa.array([], arrow_type(schema[f].dataType, f))) for f in names]
    if shaped:
        columns.append(held.shapes(rows) if n else pa.array([], _RAW_ARROW))
    return n, columns


# ---------------------------------------------------------------------------
# The source
# ---------------------------------------------------------------------------


@dataclass
class Span(InputPartition):
    """Pages [first, last) of chunk rows, of total rows; with a predicate the rows of one key chunk of a live layer."""

    first: int
    last: int
    chunk: int
    total: int
    predicate: str | None = None


@dataclass
class FeatureLayerReader(DataSourceReader):
    options: dict
    schema: T.StructType
    wanted: T.StructType
    tests: list[Test] = field(default_factory=list)

    def where(self, predicate: str | None = None) -> str:
        """What is sent as the request's where."""
        base = predicate if predicate is not None else self.options["where"].strip()
        texts = [f"({base})"] if base not in ("", "1=1") else []
        texts += [f"({t.sql()})" for t in self.tests]
        return " AND ".join(texts) if len(texts) > 1 else texts[0][1:-1] if texts else "1=1"

    def _transport(self, predicate: str | None = None) -> S.Transport:
        return S.make_transport(self.options, None if self.options["path"] else self.where(predicate))

    def partitions(self):
        o = self.options
        t = self._transport()
        chunk = S.page_rows(t, o)
        if o["predicates"] is not None and not o["path"]:
            # each chunk's rows are counted in its task
            return [Span(0, 0, chunk, 0, p) for p in o["predicates"]] or [Span(0, 0, chunk, 0)]
        total = 0 if o["predicates"] == [] else t.count("1=1" if o["path"] else self.where())
        pages = -(-total // chunk)
        share = S.pages_each(pages, chunk, o["max_partitions"])
        return [Span(a, min(a + share, pages), chunk, total) for a in range(0, pages, max(share, 1))] or [Span(0, 0, chunk, 0)]

    def read(self, partition: Span):
        o = self.options
        t = self._transport(partition.predicate)
        tests, first, last, total = list(self.tests), partition.first, partition.last, partition.total
        schema = self.schema
        if o["path"]:
            tests += key_tests(o["predicates"])
            pages = pages_to_read(o["path"], tests, first, last)
        else:
            if partition.predicate is not None:
                total = S.patiently(lambda: t.count(self.where(partition.predicate)), o["max_retries"])
                first, last = 0, -(-total // partition.chunk)
            pages, tests = range(first, last), []
        unknown = {x.column for x in tests} - set(schema.fieldNames())
        if unknown:
            raise ValueError(f"the layer has no field {sorted(unknown)}")
        read = T.StructType([f for f in schema if f in self.wanted.fields or f.name in {x.column for x in tests}])
        shaped = o["geometry"]
        places = {n: i for i, n in enumerate([*read.fieldNames(), *([RAW] if shaped else [])])}
        at = [places[n] for n in self.wanted.fieldNames()]
        arrow = pa.schema([(f.name, _RAW_ARROW if f.name == RAW else arrow_type(f.dataType, f.name)) for f in self.wanted])
        for page in pages:
            offset = page * partition.chunk
            body = S.patiently(lambda: t.page(offset, partition.chunk, o["format"]), o["max_retries"])  # noqa: B023
            try:
                held = None if body is None else read_page(body)
            except CORRUPT as e:
                raise ValueError(f"page {page}: corrupt: {e}") from e
            expected = min(partition.chunk, total - offset)
            status = "missing" if held is None else fault(expected, held.count, held.exceeded, held.error)
            if status:
                raise ValueError(f"page {page}: {status}")
            if shaped and o["format"] == "json" and isinstance(held, BinaryPage):
                raise ValueError(f"page {page}: binary, where JSON was asked for")
            try:
                n, columns = page_columns(held, read, tests, shaped)
            except NotOfType as e:
                raise ValueError(f"page {page}: {e}") from e
            except CORRUPT as e:
                raise ValueError(f"page {page}: corrupt: {e}") from e
            if n:
                whole = pa.RecordBatch.from_arrays([columns[i] for i in at], schema=arrow)
                for a in range(0, n, BATCH_ROWS):
                    yield whole.slice(a, BATCH_ROWS)


class PushedLayerReader(FeatureLayerReader):
    """The reader that takes filters; Spark refuses one where its session has pushdown off."""

    def pushFilters(self, filters):
        for f in filters:
            t = test_of(f, self.schema)
            if t is not None:
                self.tests.append(t)
            yield f


class FeatureLayer(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feature_layer"

    def __init__(self, options):
        super().__init__(options)
        self.parsed = S._options(options)
        self.pushed = str({k.lower(): v for k, v in dict(options).items()}.get("push_filters", "false")).lower() == "true"
        self._declared: T.StructType | None = None

    def declared(self) -> T.StructType:
        """All attributes, by the layer's metadata."""
        if self._declared is None:
            info = S.make_transport(self.parsed).layer_info()
            if not info.get("fields"):
                raise ValueError("the layer's metadata declares no fields; read it with read_layer and a schema")
            self._declared = schema_from_fields(info["fields"])
        return self._declared

    def schema(self) -> T.StructType:
        have, asked = self.declared(), self.parsed["fields"].strip()
        names = have.fieldNames() if asked == "*" else [f.strip() for f in asked.split(",") if f.strip()]
        unknown = set(names) - set(have.fieldNames())
        if unknown:
            raise ValueError(f"the layer has no field {sorted(unknown)}")
        shape = []
        if self.parsed["geometry"]:
            clashing = [n for n in names if n.lower() in ("geometry", RAW)]
            if clashing:
                raise ValueError(f"an attribute {clashing[0]} would clash with the geometry; name the others in the option fields")
            shape = [T.StructField(RAW, _RAW_TYPE)]
        return T.StructType([have[n] for n in names] + shape)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        for f in schema:
            if f.name != RAW:
                arrow_type(f.dataType, f.name)
        return (PushedLayerReader if self.pushed else FeatureLayerReader)(self.parsed, self.declared(), schema)


def with_geometries(rows: DataFrame, binary: bool) -> DataFrame:
    """Rows with ``geometry_raw`` -> with ``geometry`` (last): a projection; binary: pages may be binary as well as JSON."""
    names = [c for c in rows.columns if c != RAW]
    # the attributes under names that the decoding doesn't use
    own = rows.select(*[F.col(f"`{c}`").alias(f"a{i}") for i, c in enumerate(names)], F.col(RAW).alias("_raw"))
    read = own.withColumn("_json", geometry_from_text(F.col("_raw.text")))
    if binary:
        read = decode_geometries(read.select(*own.columns, "_json", "_raw.*"))
        shape = F.coalesce("_json", "geometry")
    else:
        shape = F.col("_json")
    return read.select(*[F.col(f"a{i}").alias(c) for i, c in enumerate(names)], shape.alias("geometry"))


def load_layer(
    spark: SparkSession, path: str | None = None, url: str | None = None, with_geometry: bool = False, **options
) -> DataFrame:
    """The layer as typed rows, lazily; ``where`` on them reaches the read if the session has filter pushdown on.

    with_geometry: a last column ``geometry`` (``schemas.GEOMETRY``; null for a
    feature without one). A curve, or a geometry that isn't one, raises.
    """
    spark.dataSource.register(FeatureLayer)
    reader = spark.read.format("feature_layer")
    on = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower() == "true"
    options = {"push_filters": on, **options, **({"returnGeometry": True} if with_geometry else {})}
    for k, v in {"path": path, "url": url, **options}.items():
        if v is not None:
            reader = reader.option(k, str(v).lower() if isinstance(v, bool) else str(v))
    rows = reader.load()
    return with_geometries(rows, str(options.get("format", "json")).lower() != "json") if with_geometry else rows


def load_keys(
    spark: SparkSession, chunks: DataFrame, path: str | None = None, url: str | None = None, with_geometry: bool = False, **options
) -> DataFrame:
    """The layer's rows of requested keys, by the chunks of ``operators.keys.key_chunks``.

    The chunks' texts go through the driver, as any option of a source does.
    Chunks have no key in common, so no row comes twice.
    """
    predicates = [r.predicate for r in chunks.orderBy("chunk").select("predicate").collect()]
    return load_layer(spark, path, url, with_geometry, predicates=json.dumps(predicates), **options)
