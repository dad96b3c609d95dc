"""``feature_pages``: a Python data source that reads a layer as a page table.

Planning (driver): layer metadata -> page size, row count -> page offsets,
offsets grouped into contiguous page ranges, one input partition per range.
Reading (executors): each page is fetched with a bounded retry and yielded as
one row (layer, page, offset, chunk_size, format, body, status, expected_rows). Decoding is
left to DataFrame operators (``tessera.sources.pages``, ``tessera.sources.binary``),
so a page is decoded by the same Spark plan whatever transport fetched it.

Transports, chosen by option:

* ``path``: a landed layer folder -- ``layer.json`` (metadata), ``count.json``
  (``{"count": n}``) and ``pages/<offset>.<format>``. A page file that is not
  there is yielded with status ``missing`` so the page audit reports it. Only
  the unfiltered layer is landed, so ``where`` must stay ``1=1``; filter the
  decoded rows with ``DataFrame.where`` instead.
* ``url``: a live layer ``.../FeatureServer/<n>/query`` over HTTP(S), with the
  ``where``, ``fields`` and ``returnGeometry`` options sent to the server.
  Written against the public REST parameters; it is not exercised by the
  tests here (no network).

Options: ``path`` | ``url``, ``format`` (json | pbf), ``where`` (1=1),
``fields`` (*), ``returnGeometry`` (false), ``chunk_size`` (from metadata),
``max_partitions`` (none: from the page count), ``max_retries`` (4), ``timeout`` (120), ``order_by``
(e.g. ``OBJECTID``: sent as the page order, so offset paging is stable),
``predicates`` (a JSON list of filters, such as the key chunks of
``operators.keys.key_chunks``: one partition for each, which counts and pages
through the rows of its filter), ``prune_pages`` (false; filters on ``page`` then limit the pages fetched --
needs ``spark.sql.python.filterPushdown.enabled``).
Every read is idempotent, so Spark's task retry is safe on top of it.
"""

from __future__ import annotations

import http.client
import json
import time
import urllib.parse
import urllib.request
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.schemas import DEFAULT_RECORD_FACTOR, DEFAULT_STANDARD_MAX_RECORDS

PAGE_DDL = (
    "layer string, page bigint, offset bigint, chunk_size bigint, format string, "
    "body binary, status string, expected_rows bigint"
)
#: A partition reads, unless ``max_partitions`` is given, one page of a small layer, else the pages of so many rows.
SMALL_LAYER, ROWS_EACH = 64, 16_000
#: Seconds before each further try: 1, 3, 9, ... up to a minute.
FIRST_WAIT, LONGEST_WAIT = 1.0, 60.0


class Transport:
    def layer_info(self) -> dict:
        raise NotImplementedError

    def count(self, where: str) -> int:
        raise NotImplementedError

    def page(self, offset: int, chunk_size: int, fmt: str) -> bytes | None:
        raise NotImplementedError


def open_fs(uri: str):
    """(filesystem, path) for a local path or a URI Spark accepts (file:, hdfs:, s3:...)."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(uri)


class DirectoryTransport(Transport):
    def __init__(self, root: str, where: str = "1=1"):
        self.fs, self.root = open_fs(root)
        if where.strip() not in ("", "1=1"):
            raise ValueError(
                "a landed layer holds the unfiltered layer: keep where='1=1' and filter "
                "the decoded rows with DataFrame.where"
            )

    def _read(self, *parts: str) -> bytes | None:
        import pyarrow.fs as pafs

        p = "/".join([self.root.rstrip("/"), *parts])
        if self.fs.get_file_info(p).type != pafs.FileType.File:
            return None
        with self.fs.open_input_stream(p) as fh:
            return fh.read()

    def layer_info(self) -> dict:
        raw = self._read("layer.json")
        return json.loads(raw) if raw else {}

    def count(self, where: str) -> int:
        raw = self._read("count.json")
        if raw is None:
            raise FileNotFoundError(f"no count.json in {self.root}")
        n = json.loads(raw).get("count")
        if n is None:
            raise ValueError("count document has no 'count'")
        return int(n)

    def page(self, offset: int, chunk_size: int, fmt: str) -> bytes | None:
        return self._read("pages", f"{offset}.{fmt}")


class HttpTransport(Transport):
    def __init__(
        self, url: str, where: str, fields: str, geometry: bool, timeout: int, order_by: str | None = None
    ):
        self.url, self.where, self.fields = url, where, fields
        self.geometry, self.timeout, self.order_by = geometry, timeout, order_by

    def _get(self, url: str, params: dict) -> bytes:
        full = url + "?" + urllib.parse.urlencode(params)
        with urllib.request.urlopen(full, timeout=self.timeout) as r:  # noqa: S310
            return r.read()

    def layer_info(self) -> dict:
        base = self.url[: -len("/query")] if self.url.endswith("/query") else self.url
        return json.loads(self._get(base, {"f": "json"}))

    def count(self, where: str) -> int:
        doc = json.loads(self._get(self.url, {"where": where, "returnCountOnly": "true", "f": "json"}))
        if doc.get("count") is None:
            raise ValueError(f"count request returned no count: {str(doc)[:200]}")
        return int(doc["count"])

    def page(self, offset: int, chunk_size: int, fmt: str) -> bytes | None:
        return self._get(
            self.url,
            {
                "where": self.where,
                "outFields": self.fields,
                "returnGeometry": "true" if self.geometry else "false",
                "f": fmt,
                "resultOffset": offset,
                "resultRecordCount": chunk_size,
                "resultType": "standard",
                # offset paging is only stable under a total order
                **({"orderByFields": self.order_by} if self.order_by else {}),
            },
        )


def _options(opts) -> dict:
    o = {k.lower(): v for k, v in dict(opts).items()}
    fmt = o.get("format", "json")
    if fmt not in ("json", "pbf"):
        raise ValueError(f"invalid response format {fmt!r} (expected 'json' or 'pbf')")
    retries = int(o.get("max_retries", 4))
    if retries < 1:
        raise ValueError("max_retries must be >= 1")
    if not (o.get("path") or o.get("url")):
        raise ValueError("feature_pages needs a 'path' (landed layer) or a 'url' (live layer)")
    return {
        "path": o.get("path"),
        "url": o.get("url"),
        "format": fmt,
        "where": o.get("where", "1=1"),
        "fields": o.get("fields", "*"),
        "geometry": str(o.get("returngeometry", "false")).lower() == "true",
        "chunk_size": int(o["chunk_size"]) if o.get("chunk_size") else None,
        "max_partitions": int(o["max_partitions"]) if o.get("max_partitions") else None,
        "max_retries": retries,
        "timeout": int(o.get("timeout", 120)),
        "layer": o.get("layer"),
        "order_by": o.get("order_by"),
        "predicates": json.loads(o["predicates"]) if o.get("predicates") else None,
        # needs spark.sql.python.filterPushdown.enabled (read_pages checks it)
        "prune_pages": str(o.get("prune_pages", "false")).lower() == "true",
    }


def make_transport(o: dict, where: str | None = None) -> Transport:
    where = o["where"] if where is None else where
    if o["path"]:
        return DirectoryTransport(o["path"], where)
    return HttpTransport(
        o["url"], where, o["fields"], o["geometry"], o["timeout"], o.get("order_by")
    )


def layer_label(url_or_path: str) -> str:
    import re

    m = re.search(r"/services/([^/]+)/", url_or_path or "")
    return m.group(1) if m else "ArcGIS"


@dataclass
class PageRange(InputPartition):
    first: int  # first page number
    last: int  # last page number, exclusive


@dataclass
class KeyChunk(InputPartition):
    number: int
    predicate: str


def page_rows(t: Transport, options: dict) -> int:
    """Rows a page has: as asked for, else as the layer's metadata says."""
    chunk = options["chunk_size"]
    if chunk is None:
        info = t.layer_info()
        if "error" in info:
            raise ValueError(f"the layer's metadata is an error: {str(info['error'])[:200]}")
        std = info.get("standardMaxRecordCount") or DEFAULT_STANDARD_MAX_RECORDS
        chunk = int(std * (info.get("maxRecordCountFactor") or DEFAULT_RECORD_FACTOR))
    if chunk < 1:
        raise ValueError("chunk_size must be >= 1")
    return chunk


def pages_each(pages: int, chunk: int, most: int | None) -> int:
    """Pages that a partition reads, of so many pages of chunk rows."""
    return -(-pages // most) if most else 1 if pages <= SMALL_LAYER else max(ROWS_EACH // chunk, 1)


class FeaturePagesReader(DataSourceReader):
    chunk = DEFAULT_STANDARD_MAX_RECORDS

    def __init__(self, options: dict):
        self.o = options
        t = make_transport(options)
        self.chunk = chunk = page_rows(t, options)
        self.total = t.count(options["where"])
        self.n_pages = -(-self.total // chunk)

    def _page_bounds(self) -> tuple[int, int, list[int] | None]:
        """Pages to read: [first, last) and, when known, an explicit list."""
        return 0, self.n_pages, None

    def partitions(self):
        """Runs of neighbouring pages; a run never holds more than its share of the pages to read."""
        first, last, only = self._page_bounds()
        pages = range(first, last) if only is None else sorted(p for p in set(only) if first <= p < last)
        if not len(pages):
            return [PageRange(0, 0)]  # nothing to read: one partition that yields nothing
        share = pages_each(len(pages), self.chunk, self.o["max_partitions"])
        runs = [PageRange(pages[0], pages[0])]
        for p in pages:
            if p != runs[-1].last or p - runs[-1].first >= share:
                runs.append(PageRange(p, p))
            runs[-1].last = p + 1
        return [r for r in runs if r.last > r.first]

    def read(self, partition: PageRange):
        """One Arrow record batch per group of pages (bodies are not pickled)."""
        pages = ((p, p * self.chunk) for p in range(partition.first, partition.last))
        yield from self._batches(make_transport(self.o), pages, self.total)

    def _batches(self, t: Transport, pages, total: int):
        o = self.o
        layer = o["layer"] or layer_label(o["url"] or o["path"] or "")
        cols = {k: [] for k in PAGE_ARROW.names}
        size = 0
        for page, offset in pages:
            body = patiently(lambda: t.page(offset, self.chunk, o["format"]), o["max_retries"])  # noqa: B023
            row = (layer, page, offset, self.chunk, o["format"], body, "missing" if body is None else "ok",
                   min(self.chunk, total - offset))
            for k, v in zip(cols, row):
                cols[k].append(v)
            size += len(body or b"")
            if size >= _BATCH_BYTES:
                yield pa.RecordBatch.from_pydict(cols, schema=PAGE_ARROW)
                cols = {k: [] for k in cols}
                size = 0
        if cols["page"]:
            yield pa.RecordBatch.from_pydict(cols, schema=PAGE_ARROW)


_BATCH_BYTES = 16 << 20  # flush a batch once its bodies reach 16 MiB


PAGE_ARROW = pa.schema(
    [
        ("layer", pa.string()),
        ("page", pa.int64()),
        ("offset", pa.int64()),
        ("chunk_size", pa.int64()),
        ("format", pa.string()),
        ("body", pa.binary()),
        ("status", pa.string()),
        ("expected_rows", pa.int64()),
    ]
)


class KeyChunksReader(FeaturePagesReader):
    """One partition for each filter: a task counts its rows and pages through them.

    A page's number holds that of its filter above 20 bits, so numbers stay apart.
    """

    def __init__(self, options: dict):
        if options["path"]:
            raise ValueError("pages of a landed layer hold rows of any key: read its rows by key chunks with feature_layer.load_keys")
        self.o = options
        self.chunk = page_rows(make_transport(options), options)

    def partitions(self):
        return [KeyChunk(i, p) for i, p in enumerate(self.o["predicates"])] or [KeyChunk(0, "1=0")]

    def read(self, partition: KeyChunk):
        t = make_transport(self.o, partition.predicate)
        total = patiently(lambda: t.count(partition.predicate), self.o["max_retries"])
        base = partition.number << 20
        yield from self._batches(t, ((base + i, i * self.chunk) for i in range(-(-total // self.chunk))), total)


class PrunedPagesReader(FeaturePagesReader):
    """The page reader with page pruning: comparisons, equality and IN on the
    ``page`` column narrow the pages that are fetched at all. Every filter is
    also handed back, so Spark still checks the rows it gets."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.first, self.last, self.only = 0, self.n_pages, None

    def pushFilters(self, filters):
        from pyspark.sql.datasource import (
            EqualTo,
            GreaterThan,
            GreaterThanOrEqual,
            In,
            LessThan,
            LessThanOrEqual,
        )

        for f in filters:
            if getattr(f, "attribute", None) == ("page",) and hasattr(f, "value"):
                v = f.value
                if isinstance(f, EqualTo) and isinstance(v, int):
                    self.first, self.last = max(self.first, v), min(self.last, v + 1)
                elif isinstance(f, GreaterThan) and isinstance(v, int):
                    self.first = max(self.first, v + 1)
                elif isinstance(f, GreaterThanOrEqual) and isinstance(v, int):
                    self.first = max(self.first, v)
                elif isinstance(f, LessThan) and isinstance(v, int):
                    self.last = min(self.last, v)
                elif isinstance(f, LessThanOrEqual) and isinstance(v, int):
                    self.last = min(self.last, v + 1)
                elif isinstance(f, In) and all(isinstance(x, int) for x in v):
                    keep = set(v) if self.only is None else set(self.only) & set(v)
                    self.only = sorted(keep)
            yield f

    def _page_bounds(self):
        return self.first, min(self.last, self.n_pages), self.only


def patiently(read, tries: int, pause=time.sleep):
    """What read() gives; broken connections and bodies are tried again, with waits that triple."""
    wait, left = FIRST_WAIT, tries
    while True:
        left -= 1
        try:
            return read()
        except (OSError, http.client.HTTPException):
            if not left:
                raise
        pause(wait)
        wait = min(3 * wait, LONGEST_WAIT)


class FeaturePages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feature_pages"

    def __init__(self, options):
        super().__init__(options)
        self.parsed = _options(options)

    def schema(self) -> str:
        return PAGE_DDL

    def reader(self, schema) -> DataSourceReader:
        if self.parsed["predicates"] is not None:
            return KeyChunksReader(self.parsed)
        if self.parsed["prune_pages"]:
            return PrunedPagesReader(self.parsed)
        return FeaturePagesReader(self.parsed)


def register(spark) -> None:
    spark.dataSource.register(FeaturePages)


# ---------------------------------------------------------------------------
# Landing pages (the folder form the directory transport reads)
# ---------------------------------------------------------------------------


def land_pages(pages, root: str) -> int:
    """``land_counted``; returns the number of page files written."""
    return land_counted(pages, root)[0]


def land_counted(pages, root: str) -> tuple[int, int]:
    """Write a page table as ``<root>/pages/<offset>.<format>``; returns the
    numbers of page files written and of rows that these are planned to hold.

    Executors write their own pages (to a temporary name, then a rename, so a
    retried task leaves whole files); bodies travel as Arrow batches and each
    task reports how many pages it wrote. ``root`` must be on storage every
    executor sees: a folder under ``spark.checkpoint.dir``.
    """
    from pyspark.sql import functions as F

    fs, base = open_fs(root)
    fs.create_dir(f"{base.rstrip('/')}/pages", recursive=True)

    def write(batches):
        wfs, wbase = open_fs(root)
        for b in batches:
            n = rows = 0
            offsets, fmts, bodies, planned = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()
            for i, (off, fmt) in enumerate(zip(offsets, fmts)):
                body = bodies[i]
                if not body.is_valid:
                    continue
                p = f"{wbase.rstrip('/')}/pages/{off}.{fmt}"
                tmp = f"{p}.{uuid.uuid4().hex}.tmp"  # of this attempt alone
                with wfs.open_output_stream(tmp) as fh:
                    fh.write(body.as_buffer())
                wfs.move(tmp, p)
                n += 1
                rows += planned[i] or 0
            yield pa.RecordBatch.from_pydict({"n": [n], "rows": [rows]}, schema=pa.schema([("n", pa.int64()), ("rows", pa.int64())]))

    expected = F.col("expected_rows") if "expected_rows" in pages.columns else F.lit(None).cast("bigint")
    written = pages.select("offset", "format", "body", expected.alias("rows")).mapInArrow(write, "n bigint, rows bigint")
    return tuple(int(c) for c in written.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "rows")]).first())


def write_layer_docs(root: str, count: int, layer_info: dict) -> None:
    """``count.json`` and ``layer.json`` of a landed layer (two tiny documents)."""
    fs, base = open_fs(root)
    fs.create_dir(base, recursive=True)
    for name, doc in (("count.json", {"count": int(count)}), ("layer.json", layer_info)):
        with fs.open_output_stream(f"{base.rstrip('/')}/{name}") as fh:
            fh.write(json.dumps(doc).encode("utf-8"))


def read_layer_docs(root: str) -> tuple[int, dict]:
    t = DirectoryTransport(root)
    return t.count("1=1"), t.layer_info()
