"""Binary (protocol-buffer) pages, column by column.

A ``mapInArrow`` task moves a cursor over a page's header; what repeats, the
features and their values, is indexed by numpy: a field of every feature (of
every value message, of every geometry) is taken at once, and the loop runs as
often as the message with the most fields has fields. Nested messages are
ranges of the same bytes. The indexed ranges become Arrow columns: one for each
wanted attribute (as text, typed strictly by ``functions.strict``) and, if the
geometry is wanted, lists of its part lengths and coordinates. A page is one
Arrow batch, so the memory held is that of a page. Typing, zigzag, running
sums, parts and dequantization are DataFrame work in the feature's row.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.geometry import geometry_type_name, pair_running_sums, running_sums, zigzag
from tessera.functions.strict import typed
from tessera.schemas import GEOMETRY
from tessera.sources import page_codes as C

_GEOMETRY_DDL = (
    "default_type int, wkid int, origin int, sx double, sy double, tx double, ty double, "
    "has_geometry boolean, gtype int, lengths array<bigint>, coords array<bigint>"
)
GEOMETRY_ARROW = [
    ("default_type", pa.int32()), ("wkid", pa.int32()), ("origin", pa.int32()),
    ("sx", pa.float64()), ("sy", pa.float64()), ("tx", pa.float64()), ("ty", pa.float64()),
    ("has_geometry", pa.bool_()), ("gtype", pa.int32()),
    ("lengths", pa.list_(pa.int64())), ("coords", pa.list_(pa.int64())),
]


class Cursor:
    """A range of a page's bytes, taken field by field.

    After ``step()`` the field's number is ``field``; ``number`` holds a
    varint, ``begin`` and ``end`` the range of any other value.
    """

    __slots__ = ("body", "at", "stop", "field", "number", "begin", "end")

    def __init__(self, body: bytes, at: int = 0, stop: int | None = None):
        self.body, self.at, self.stop = body, at, len(body) if stop is None else stop

    def _varint(self) -> int:
        body, at = self.body, self.at
        if at >= self.stop:
            raise ValueError("the page ends within a number")
        first = body[at]
        if first < 0x80:
            self.at = at + 1
            return first
        last = at + 1
        while last < self.stop and body[last] >= 0x80:
            last += 1
        if last >= self.stop:
            raise ValueError("the page ends within a number")
        self.at = last + 1
        number = body[last]
        for k in range(last - 1, at - 1, -1):  # from the highest seven bits down
            number = (number << 7) | (body[k] & 0x7F)
        return number

    def step(self) -> bool:
        if self.at >= self.stop:
            return False
        head = self._varint()
        self.field, kind = head >> 3, head & 7
        if kind == 0:
            self.number = self._varint()
            self.begin = self.end = self.at
            return True
        size = self._varint() if kind == 2 else {1: 8, 5: 4}.get(kind, -1)
        if size < 0:
            raise ValueError(f"unsupported wire type {kind} for field {self.field}")
        self.begin, self.end = self.at, self.at + size
        if self.end > self.stop:
            raise ValueError(f"field {self.field} runs past its message")
        self.at, self.number = self.end, 0
        return True

    def inside(self) -> Cursor:
        return Cursor(self.body, self.begin, self.end)

    def double(self) -> float:
        return struct.unpack_from("<d", self.body, self.begin)[0]


def packed_numbers(body: bytes, begin: int, end: int) -> np.ndarray:
    """The varints of a packed field as a BIGINT array (two's complement), all at once."""
    raw = np.frombuffer(body, np.uint8, end - begin, begin)
    last = np.flatnonzero(raw < 0x80)
    if not len(last):
        return np.empty(0, np.int64)
    first = np.concatenate([[0], last[:-1] + 1])
    shift = np.arange(last[-1] + 1) - np.repeat(first, last - first + 1)
    seven = (raw[: last[-1] + 1] & 0x7F).astype(np.uint64) << (np.uint64(7) * shift.astype(np.uint64))
    return np.add.reduceat(seven, first).view(np.int64)


#: Bytes of a value by its wire type; 0: a number, or as many as the number before it says; -1: not supported.
_SIZES = np.array([0, 8, 0, -1, -1, 4, -1, -1])


def _numbers_at(raw: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the number at each place, the place after it); each must end before its stop."""
    number, at = np.zeros(len(at), np.uint64), at.copy()
    unfinished = np.arange(len(at))
    for seven in range(10):
        if (at[unfinished] >= stop[unfinished]).any():
            raise ValueError("the page ends within a number")
        byte = raw[at[unfinished]]
        number[unfinished] |= (byte & 0x7F).astype(np.uint64) << np.uint64(7 * seven)
        at[unfinished] += 1
        unfinished = unfinished[byte >= 0x80]
        if not len(unfinished):
            return number, at
    raise ValueError("a number of more than ten bytes")


class Fields:
    """One field of each of many messages: its field number, wire type, number, and the range of its value.

    ``number`` is that of wire type 0, and its range is that of its bytes; ``end`` is where the next field begins.
    """

    __slots__ = ("field", "kind", "number", "begin", "end")

    def __init__(self, raw: np.ndarray, at: np.ndarray, stop: np.ndarray):
        head, self.begin = _numbers_at(raw, at, stop)
        self.field, self.kind = head >> np.uint64(3), (head & np.uint64(7)).astype(np.int64)
        size = _SIZES[self.kind]
        if (size < 0).any():
            raise ValueError(f"unsupported wire type {self.kind[size < 0][0]} for field {self.field[size < 0][0]}")
        self.number = np.zeros(len(at), np.uint64)
        led = np.flatnonzero(size == 0)
        number, after = _numbers_at(raw, self.begin[led], stop[led])
        plain = self.kind[led] == 0
        self.number[led[plain]] = number[plain]
        size[led[plain]] = after[plain] - self.begin[led[plain]]
        sized, number, after = led[~plain], number[~plain], after[~plain]
        if (number > (stop[sized] - after).astype(np.uint64)).any():
            raise ValueError("a field runs past its message")
        self.begin[sized], size[sized] = after, number
        self.end = self.begin + size
        if (self.end > stop).any():
            raise ValueError("a field runs past its message")

    def check(self, which: np.ndarray, kind: int) -> np.ndarray:
        """which, a mask of fields that must be of this wire type."""
        if (self.kind[which] != kind).any():
            raise ValueError(f"fields {set(self.field[which].tolist())} of another wire type than {kind}")
        return which


def _steps(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, Fields]]:
    """The messages that have a first field with those fields, then those that have a second one, and so on."""
    live = np.flatnonzero(begin < end)
    at = begin[live]
    while len(live):
        f = Fields(raw, at, end[live])
        yield live, f
        more = f.end < end[live]
        live, at = live[more], f.end[more]


def _ranges(body: bytes, begin: np.ndarray, end: np.ndarray, kind: pa.DataType = pa.binary()) -> pa.Array:
    """Ranges of the body, in its order and apart, as an Arrow column that shares its bytes until it is taken."""
    ends = np.stack([begin, end], axis=1).ravel().astype(np.int32)
    if not len(ends):
        return pa.array([], kind)
    found = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(body)])
    return found.take(pa.array(np.arange(0, len(ends), 2))).cast(kind)  # every other one lies between two ranges


def _fixed(raw: np.ndarray, begin: np.ndarray, form: str) -> list:
    size = np.dtype(form).itemsize
    return raw[begin[:, None] + np.arange(size)].view(form).ravel().astype(np.float64).tolist()


class Values:
    """Value messages, in the page's order: of each its explicit field index, if any, and its text.

    Of several value slots the lowest counts, of a repeated one the last.
    Numbers keep their size: an unsigned 64-bit number isn't wrapped.
    """

    def __init__(self, body: bytes, raw: np.ndarray, begin: np.ndarray, end: np.ndarray):
        n = len(begin)
        self.body, self.raw = body, raw
        self.indexed, self.index = np.zeros(n, bool), np.zeros(n, np.uint64)
        self.slot, self.number = np.full(n, 99, np.uint64), np.zeros(n, np.uint64)
        self.kind, self.begin, self.end = np.zeros(n, np.int64), begin.copy(), begin.copy()
        for live, f in _steps(raw, begin, end):
            index = f.check(f.field == C.VALUE_INDEX, 0)
            self.indexed[live[index]], self.index[live[index]] = True, f.number[index]
            better = ~index & (f.field <= self.slot[live])
            for mine in ("slot", "number", "kind", "begin", "end"):
                getattr(self, mine)[live[better]] = getattr(f, "field" if mine == "slot" else mine)[better]

    def texts(self) -> pa.Array:
        """The text of each value (null: no value)."""
        found, places = [pa.nulls(1, pa.string())], np.zeros(len(self.slot), np.int64)
        size = 1

        def put(at: np.ndarray, texts: pa.Array) -> None:
            nonlocal size
            places[at] = size + np.arange(len(at))
            found.append(texts)
            size += len(at)

        def of(kind: int, *slots: int) -> np.ndarray:
            at = np.flatnonzero(np.isin(self.slot, np.array(slots, np.uint64)))
            if (self.kind[at] != kind).any():
                raise ValueError(f"a value in one of the slots {slots} is of another wire type than {kind}")
            return at

        at = of(2, C.VALUE_STRING)
        put(at, _ranges(self.body, self.begin[at], self.end[at], pa.string()))
        for slot, kind, form in ((C.VALUE_DOUBLE, 1, "<f8"), (C.VALUE_FLOAT, 5, "<f4")):
            at = of(kind, slot)
            put(at, pa.array(list(map(repr, _fixed(self.raw, self.begin[at], form))), pa.string()))
        at = of(0, C.VALUE_SINT32, C.VALUE_SINT64)
        number = self.number[at]
        put(at, pa.array((number >> np.uint64(1)).view(np.int64) ^ -(number & np.uint64(1)).view(np.int64)).cast(pa.string()))
        at = of(0, C.VALUE_INT64)
        put(at, pa.array(self.number[at].view(np.int64)).cast(pa.string()))
        at = of(0, C.VALUE_UINT32, C.VALUE_UINT64)
        put(at, pa.array(self.number[at]).cast(pa.string()))
        at = of(0, C.VALUE_BOOL)
        put(at, pa.array(self.number[at] != 0).cast(pa.string()))
        return pa.concat_arrays(found).take(pa.array(places))


class Page:
    """A page's header and where its features lie; ``features()`` reads them."""

    error_code = None  # errors come as JSON

    def __init__(self, body: bytes | None):
        self.exceeded, self.default_type, self.wkid = False, None, None
        self.origin, self.scale, self.shift = 0, (1.0, 1.0), (0.0, 0.0)
        self.names: list[str] = []
        self.spots: list[tuple[int, int]] = []
        self.past: set[str] = set()  # names of attributes past the header, as features() meets them
        self.body = body or b""
        result = None
        outer = Cursor(self.body)
        while outer.step():
            if outer.field == C.FC_QUERY_RESULT:
                query = outer.inside()
                while query.step():
                    if query.field == C.QR_FEATURE_RESULT:
                        result = query.inside()
        if result is not None:
            self._header(result)

    def _header(self, c: Cursor) -> None:
        while c.step():
            if c.field == C.FR_FEATURES:
                self.spots.append((c.begin, c.end))
            elif c.field in (C.FR_HAS_Z, C.FR_HAS_M) and c.number:
                raise ValueError("z/m ordinates are not supported")
            elif c.field == C.FR_EXCEEDED:
                self.exceeded = bool(c.number)
            elif c.field == C.FR_GEOMETRY_TYPE:
                self.default_type = c.number
            elif c.field == C.FR_SPATIAL_REFERENCE:
                ids = {C.SR_WKID: 0, C.SR_LATEST_WKID: 0}
                reference = c.inside()
                while reference.step():
                    if reference.field in ids:
                        ids[reference.field] = reference.number
                self.wkid = ids[C.SR_WKID] or ids[C.SR_LATEST_WKID] or None
            elif c.field == C.FR_TRANSFORM:
                self._transform(c.inside())
            elif c.field == C.FR_FIELDS:
                name, field = "", c.inside()
                while field.step():
                    if field.field == C.FIELD_NAME:
                        name = c.body[field.begin : field.end].decode("utf-8")
                self.names.append(name)

    def _transform(self, c: Cursor) -> None:
        def xy(inner: Cursor) -> tuple[float, float]:
            x = y = 0.0
            while inner.step():
                if inner.field == C.XY_X:
                    x = inner.double()
                elif inner.field == C.XY_Y:
                    y = inner.double()
            return x, y

        while c.step():
            if c.field == C.TF_ORIGIN:
                self.origin = c.number
            elif c.field == C.TF_SCALE:
                self.scale = xy(c.inside())
            elif c.field == C.TF_TRANSLATE:
                self.shift = xy(c.inside())

    @property
    def count(self) -> int:
        return len(self.spots)

    def _parts(self) -> tuple[tuple, tuple]:
        """(feature, begin, end) of the attribute messages, by place, and of each feature's geometry message (the last)."""
        raw = np.frombuffer(self.body, np.uint8)
        spots = np.array(self.spots, np.int64).reshape(-1, 2)
        attributes: list[tuple] = []
        begin, end = np.full(len(spots), -1), np.full(len(spots), -1)
        for live, f in _steps(raw, spots[:, 0], spots[:, 1]):
            if np.isin(f.field, np.array([C.FEAT_SHAPE_BUFFER, C.FEAT_CURVE_GEOMETRY], np.uint64)).any():
                raise ValueError("shape-buffer and curve geometries are not supported")
            mine = f.check(f.field == C.FEAT_ATTRIBUTES, 2)
            attributes.append((live[mine], f.begin[mine], f.end[mine]))
            mine = f.check(f.field == C.FEAT_GEOMETRY, 2)
            begin[live[mine]], end[live[mine]] = f.begin[mine], f.end[mine]
        owner, first, last = (np.concatenate([x[i] for x in attributes] or [np.empty(0, np.int64)]) for i in range(3))
        order = np.lexsort([first, owner])
        shaped = np.flatnonzero(begin >= 0)
        return (owner[order], first[order], last[order]), (shaped, begin[shaped], end[shaped])

    def _values(self, owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[Values, np.ndarray]:
        """The attribute values and their fields' places in the header: the explicit one, else that among its feature's."""
        values = Values(self.body, np.frombuffer(self.body, np.uint8), begin, end)
        start = np.searchsorted(owner, owner)  # sorted: where the feature's first attribute is
        place = np.where(values.indexed, values.index, (np.arange(len(owner)) - start).astype(np.uint64))
        return values, place

    def columns(self, wanted: dict[str, int], geometry: bool) -> tuple[list[pa.Array], list[pa.Array]]:
        """(values of each wanted attribute, [has geometry, type, lengths, coordinates]), each an Arrow column over the features."""
        attributes, shaped = self._parts()
        n, owner = len(self.spots), attributes[0]
        values, place = self._values(*attributes)
        texts = values.texts()
        beyond = place >= np.uint64(len(self.names))
        past = {str(x) for x in np.unique(place[beyond]).tolist()}
        self.past |= past
        # a field past the header has its number for a name; of fields of one name the last value counts
        column = np.full(len(place), -1)
        column[~beyond] = np.array([wanted.get(x, -1) for x in self.names] + [-1])[place[~beyond].astype(np.int64)]
        for name in past & wanted.keys():
            column[place == np.uint64(int(name))] = wanted[name]
        out = []
        for i in range(len(wanted)):
            mine = np.flatnonzero(column == i)
            at = np.full(n, -1)
            at[owner[mine]] = mine
            out.append(texts.take(pa.array(at, mask=at < 0)))
        return out, self._shapes(*shaped) if geometry else []

    def _shapes(self, feature: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[pa.Array]:
        raw, n = np.frombuffer(self.body, np.uint8), len(self.spots)
        has, kind, typed_ = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, bool)
        has[feature] = True
        found: dict[int, list] = {C.GEOM_LENGTHS: [], C.GEOM_COORDS: []}
        for live, f in _steps(raw, begin, end):
            mine = f.check(f.field == C.GEOM_TYPE, 0)
            kind[feature[live[mine]]], typed_[feature[live[mine]]] = f.number[mine].view(np.int64), True
            for field, ranges in found.items():  # packed; a single number is a field of its own
                mine = f.field == field
                if (~np.isin(f.kind[mine], (0, 2))).any():
                    raise ValueError(f"field {field} of a geometry holds no numbers")
                ranges.append((feature[live[mine]], f.begin[mine], f.end[mine]))
        lists = []
        for ranges in found.values():
            owner, first, last = (np.concatenate([x[i] for x in ranges] or [np.empty(0, np.int64)]) for i in range(3))
            order = np.lexsort([first, owner])
            order = order[last[order] > first[order]]
            owner, first, last = owner[order], first[order], last[order]
            if (raw[last - 1] >= 0x80).any():
                raise ValueError("a packed field ends within a number")
            # the ranges one after the other, and how many numbers end in each
            whole = b"".join(_ranges(self.body, first, last).to_pylist())
            ends = np.concatenate([[0], np.cumsum(np.frombuffer(whole, np.uint8) < 0x80)])
            edge = ends[np.concatenate([[0], np.cumsum(last - first)])]
            count = np.bincount(owner, np.diff(edge), n).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(packed_numbers(whole, 0, len(whole)))))
        return [pa.array(has), pa.array(kind, mask=~typed_).cast(pa.int32()), *lists]

    def features(self, wanted: dict[str, int], geometry: bool) -> tuple[list[list], list[list]]:
        """``columns`` as lists."""
        values, shapes = self.columns(wanted, geometry)
        return [c.to_pylist() for c in values], [c.to_pylist() for c in shapes]

    def attribute_names(self) -> set[str]:
        """Names of the header's fields and of attributes past it."""
        _, place = self._values(*self._parts()[0])
        return {*self.names, *(str(x) for x in np.unique(place[place >= np.uint64(len(self.names))]).tolist())}


class TextPage:
    """A JSON page met where binary ones were asked for, seen as a ``Page``: attributes as the text that stands there."""

    default_type = wkid = origin = None
    scale = shift = (None, None)
    past: set[str] = set()

    def __init__(self, body: bytes):
        text = body.decode("utf-8", "replace").strip()
        doc = json.loads(text, parse_int=str, parse_float=str, parse_constant=str)
        features = doc.get("features") if isinstance(doc, dict) else 0
        if not isinstance(features, list | None):
            raise ValueError("not a page")
        features = features or []
        self.count, self.exceeded = len(features), doc.get("exceededTransferLimit") is True
        error = doc.get("error")
        self.error_code = None if error is None else int(error.get("code") or 0) if isinstance(error, dict) else 0
        self.at = [i for i, f in enumerate(features) if isinstance(f, dict) and isinstance(f.get("attributes"), dict)]
        self.spots = [features[i]["attributes"] for i in self.at]
        self.names = sorted({n for row in self.spots for n in row})
        self._text = text

    def columns(self, wanted: dict[str, int], geometry: bool) -> tuple[list[pa.Array], list[pa.Array]]:
        """As of ``Page.columns``; no geometry has a binary form (see ``geometries``)."""
        n = len(self.spots)
        values = [pa.array([_as_text(row.get(name)) for row in self.spots], pa.string()) for name in wanted]
        return values, [pa.nulls(n, t) for _, t in GEOMETRY_ARROW[-4:]] if geometry else []

    def geometries(self) -> list[str | None]:
        """The JSON text of each feature's geometry."""
        features = json.loads(self._text).get("features") or []
        shapes = [features[i].get("geometry") for i in self.at]
        return [None if g is None else json.dumps(g) for g in shapes]


def _as_text(value) -> str | None:
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"))


def open_page(body: bytes) -> Page | TextPage:
    """A page by what its body looks like: servers answer errors in JSON whatever was asked for."""
    return TextPage(body) if body.lstrip(b" \t\r\n\f\v")[:1] in (b"{", b"[") else Page(body)


#: What a body that isn't a whole page raises while it is read.
BROKEN = (ValueError, UnicodeDecodeError, struct.error, IndexError)


def _numbered(batches: Iterator[pa.RecordBatch], read) -> Iterator[tuple]:
    """(row of the batch, what read makes of its body); a broken page raises with its number."""
    for batch in batches:
        bodies = batch.column("body")
        for i, page in enumerate(batch.column("page").to_pylist()):
            body = bodies[i].as_py()
            if body is None:
                raise ValueError(f"page {page}: missing")
            try:
                yield batch, i, read(body)
            except json.JSONDecodeError as e:
                raise ValueError(f"page {page}: corrupt") from e
            except BROKEN as e:
                raise ValueError(f"page {page}: {e}") from e


def decode_pbf_pages(
    pages: DataFrame,
    attributes: T.StructType,
    with_geometry: bool = False,
    strict: bool = False,
    names: str | None = None,
    audited: bool = False,
) -> DataFrame:
    """Binary page table -> one row per feature: attribute columns (+ geometry). No shuffle.

    A body that looks like JSON is read as a JSON page, in the same pass.

    Only the declared attributes are taken from the pages, and coordinates
    only with_geometry. strict: a page that ``page_status`` finds at fault
    raises. A broken page raises too, unless audited. names: a column with the
    attribute names that the page holds, on its first row (null on the others).
    audited: columns ``_audit`` and ``_feature`` as of ``decode_json_pages``; a
    page that is broken anywhere, its geometries included, gives no feature.
    """
    from tessera.sources.pages import AUDIT, AUDIT_DDL, FEATURE, fault, geometry_from_text

    def read(body: bytes) -> tuple:
        page = open_page(body)
        return page, page.columns(wanted, with_geometry or audited)

    wanted = {a.name: i for i, a in enumerate(attributes.fields)}
    schema = pa.schema([(f"a{i}", pa.string()) for i in range(len(wanted))] + [("page", pa.int64())] + ([*GEOMETRY_ARROW, ("_json", pa.string())] if with_geometry else []))
    ddl = ", ".join([*[f"a{i} string" for i in range(len(wanted))], "page bigint", *([_GEOMETRY_DDL, "_json string"] if with_geometry else [])])
    if names:
        schema = schema.append(pa.field("names", pa.list_(pa.string())))
        ddl += ", names array<string>"
    if audited:
        told = pa.struct([(c.split()[0], {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]]) for c in AUDIT_DDL.split(", ")])
        schema = schema.append(pa.field(AUDIT, told)).append(pa.field(FEATURE, pa.bool_()))
        ddl += f", {AUDIT} struct<{AUDIT_DDL}>, {FEATURE} boolean"
    expected = F.col("expected_rows") if "expected_rows" in pages.columns else F.lit(None).cast("bigint").alias("expected_rows")

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, offset, planned, body in zip(*(batch.column(c) for c in ("page", "offset", "expected_rows", "body"))):
                place = {"page": number.as_py(), "offset": offset.as_py(), "expected_rows": planned.as_py()}
                try:
                    page, (values, shapes) = (None, ([], [])) if body.as_py() is None else read(body.as_py())
                except BROKEN:
                    yield none({**place, "actual_rows": 0, "exceeded": False, "corrupt": True, "present": True})
                    continue
                if page is None:
                    yield none({**place, "present": False})
                    continue
                n = len(page.spots)
                found = {**place, "actual_rows": page.count, "exceeded": page.exceeded, "error_code": page.error_code, "corrupt": False, "present": True}
                if not n:
                    yield none(found)
                    continue
                columns = [*values, [place["page"]] * n, *shaped(page, shapes, n), [found] + [None] * (n - 1), [True] * n]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def none(found: dict) -> pa.RecordBatch:
        """The one row of a page without features."""
        held = {AUDIT: found, FEATURE: False, "page": found["page"]}
        return pa.RecordBatch.from_arrays([pa.array([held.get(f.name)], f.type) for f in schema], schema=schema)

    def shaped(page: Page, shapes: list[pa.Array], n: int) -> list:
        if not with_geometry:
            return []
        same = (page.default_type, page.wkid, page.origin, *page.scale, *page.shift)
        return [[x] * n for x in same] + shapes + [page.geometries() if isinstance(page, TextPage) else [None] * n]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, (page, (values, shapes)) in _numbered(batches, read):
            number, n = batch.column("page")[i].as_py(), len(page.spots)
            status = fault(batch.column("expected_rows")[i].as_py(), page.count, page.exceeded, page.error_code) if strict else None
            if status:
                raise ValueError(f"page {number}: {status}")
            if not n:
                continue
            columns = [*values, [number] * n, *shaped(page, shapes, n)]
            if names:
                columns.append([sorted({*page.names, *page.past})] + [None] * (n - 1))
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    if audited:
        rows = pages.select("page", "offset", "body", expected).mapInArrow(audit, ddl)
    else:
        rows = pages.select("page", "body", expected).mapInArrow(split, ddl)
    if with_geometry:
        rows = decode_geometries(rows).withColumn("geometry", F.coalesce(geometry_from_text(F.col("_json")), "geometry"))
    cols = [typed(F.col(f"a{i}"), a.dataType, a.name).alias(a.name) for i, a in enumerate(attributes.fields)]
    return rows.select(*cols, *(["geometry"] if with_geometry else []), *([F.col("names").alias(names)] if names else []), *([AUDIT, FEATURE] if audited else []))


def page_stats_pbf(pages: DataFrame) -> DataFrame:
    """(page, offset, actual_rows, exceeded, error_code, corrupt) of each page; a broken feature makes it corrupt.

    JSON bodies among the binary ones are read in the same pass, so what makes
    the pages runs once. A NULL body has NULL rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, offset, body in zip(batch.column("page").to_pylist(), batch.column("offset").to_pylist(), batch.column("body")):
                if not body.is_valid:
                    out.append((page, offset, None, None, None, None))
                    continue
                try:
                    p = open_page(body.as_py())
                    p.columns({}, True)
                    out.append((page, offset, p.count, p.exceeded, p.error_code, False))
                except (*BROKEN, TypeError):
                    out.append((page, offset, 0, False, None, True))
            names = ["page", "offset", "actual_rows", "exceeded", "error_code", "corrupt"]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.bool_()]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return pages.select("page", "offset", "body").mapInArrow(
        count, "page bigint, offset bigint, actual_rows bigint, exceeded boolean, error_code int, corrupt boolean"
    )


def attribute_names_pbf(pages: DataFrame) -> DataFrame:
    """Distinct attribute names (``name``) that binary pages hold."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, found in _numbered(batches, lambda body: Page(body).attribute_names()):
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["name"])

    return pages.select("page", "body").mapInArrow(names, "name string").distinct()


def decode_geometries(split: DataFrame) -> DataFrame:
    """Split rows -> the same rows plus ``geometry``, as one projection.

    Per feature row: zigzag-decode the interleaved deltas, take the running
    sums of x and of y (cumulative across parts, not reset per part), cut
    the vertices into parts by ``lengths`` (none: one part; vertices past
    the sum of lengths dropped; a part past the last vertex is empty),
    dequantize with the page transform (``y`` flipped unless the origin is
    lower-left) and type the geometry (own type, else the layer's, else
    point; unknown codes are polygons). No coordinates: NULL geometry.
    """
    n_coords = F.coalesce(F.size("coords"), F.lit(0))
    has_xy = F.coalesce(F.col("has_geometry"), F.lit(False)) & (n_coords > 0)
    n_v = F.floor(n_coords / 2).cast("int")
    deltas = F.transform(F.slice("coords", 1, n_v * 2), zigzag)
    d = split.withColumn("_cum", F.when(has_xy, pair_running_sums(deltas)))
    d = d.withColumn("_ends", F.when(has_xy & (F.size("lengths") > 0), running_sums(F.col("lengths"))))
    sign = F.when(F.col("origin") == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
    idx = F.when(n_v > 0, F.sequence(F.lit(0), n_v - 1)).otherwise(F.array().cast("array<int>"))
    verts = F.transform(
        idx,
        lambda i: F.struct(
            (F.col("tx") + F.get("_cum", i * 2).cast("double") * F.col("sx")).alias("x"),
            (F.col("ty") + sign * (F.get("_cum", i * 2 + 1).cast("double") * F.col("sy"))).alias("y"),
        ),
    )
    d = d.withColumn("_verts", verts)
    v = F.col("_verts")
    parts = F.when(F.coalesce(F.size("lengths"), F.lit(0)) == 0, F.array(v)).otherwise(
        F.transform(
            "lengths",
            lambda ln, k: F.slice(
                v, (F.coalesce(F.get("_ends", k - 1), F.lit(0)) + 1).cast("int"), ln.cast("int")
            ),
        )
    )
    t = F.col("_type")
    d = d.withColumn("_type", F.when(has_xy, geometry_type_name(F.coalesce("gtype", "default_type", F.lit(0)))))
    first = F.get(v, 0)
    geom = F.when(
        t.isNotNull(),
        F.struct(
            t.alias("type"),
            F.when(t == "point", first["x"]).alias("x"),
            F.when(t == "point", first["y"]).alias("y"),
            F.when(t == "multipoint", F.array(F.flatten(parts))).when(t != "point", parts).alias("parts"),
            F.col("wkid").cast("int").alias("wkid"),
        ),
    ).cast(GEOMETRY)
    return d.withColumn("geometry", geom).drop("_cum", "_ends", "_verts", "_type")
