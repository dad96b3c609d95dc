"""Secret scans: known shapes, and sliding-window entropy, in DataFrame functions only.

The known shapes are three patterns. Besides, every run of characters of a
class (hexadecimal, base64, letters and digits) that is at least a window long
and that no known shape covers is a candidate: a window slides over it, the counts of its characters change by the one that
leaves and the one that enters, and with them the sum of n * log2(n), from
which the window's Shannon entropy log2(w) - sum / w follows at each step. A
candidate with a window at or above its class's limit is reported, unless an
allow-list pattern (plain words, numbers, documented examples) matches it.
Candidates of the other classes don't go over reported hexadecimal ones; a run
of letters and digits inside a reported base64 one is reported too.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.frames import fresh

#: Fixed patterns of the known shapes, in the order of their names in results. Of assign, group 2 must be 6 long.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_alnum")

WINDOW = 20
#: Class of the candidates: its pattern and the least entropy (bits a character) of a window, by the rates in the README.
CLASSES = {
    "entropy_hex": (r"[0-9A-Fa-f]{20,}", 2.8),
    "entropy_base64": (r"[A-Za-z0-9+/_=-]{20,}", 3.9),
    "entropy_alnum": (r"[A-Za-z0-9]{20,}", 3.3),
}
#: Candidates that these match anywhere aren't reported: words or numbers alone, one case without digits, examples
#: (named by a whole part, as long as no part is a window long itself, or at the end as in documented keys).
ALLOWED = (
    r"^[A-Za-z]+$", r"^[0-9]+$", r"^[A-Z_=-]+$", r"^[a-z_=-]+$", r"^[=+/_-]+$", r"EXAMPLE(KEY)?$",
    r"(?i)^(?!.*[A-Z0-9+]{20}).*(?<![A-Z0-9+])(example|test|sample|dummy|placeholder)(?![A-Z0-9+])",
)

SPAN = "array<struct<start:int,rank:int,end:int>>"


#: Window at most, so that its counts fit the bits they are packed in, and counts a word of 64 bits.
COUNT_BITS, PACKED = 5, 12
#: Fraction bits of the sum of n * log2(n), kept as an integer: no rounding adds up along a candidate.
FRACTION = 40
#: Values of an array that a fold copies along, and characters of a text cut from at once.
BLOCK, PART = 256, 4096


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """The running op (a sum, a maximum) of an array of numbers that aren't negative, itself included; blocks keep it linear."""

    def small(block: Column) -> Column:
        start = F.array().cast("array<int>")
        last = lambda done: F.coalesce(F.get(done, F.size(done) - 1), F.lit(0))
        return F.aggregate(block, start, lambda done, x: F.concat(done, F.array(op(last(done), x))))

    def joined_up(blocks: Column) -> Column:
        totals = small(F.transform(blocks, lambda b: F.coalesce(F.get(b, F.size(b) - 1), F.lit(0))))
        before = lambda ends, j: F.coalesce(F.get(ends, j - 1), F.lit(0))
        return bound(totals, lambda ends: F.flatten(F.transform(blocks, lambda b, j: F.transform(b, lambda x: op(before(ends, j), x)))))

    def in_blocks(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(v) - 1, F.lit(0)) / BLOCK).cast("int"))
        return bound(F.transform(numbers, lambda j: small(F.slice(v, j * BLOCK + 1, F.lit(BLOCK)))), joined_up)

    return bound(values, in_blocks)


def spans_of(text: Column, pattern: str, rank: int, accept=None, group: int = 0) -> Column:
    """Spans of the non-overlapping matches from the left (code points, end exclusive) that accept() takes.

    The text between the matches comes from a split by the same pattern, so
    the places follow from the lengths.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(rows: Column) -> Column:
        lengths = F.transform(rows, lambda r: F.length(r["b"]) + F.length(r["m"]))

        def spans(ends: Column) -> Column:
            made = F.transform(
                rows,
                lambda r, i: F.struct(
                    (F.get(ends, i) - F.length(r["m"])).alias("start"), F.lit(rank).alias("rank"), F.get(ends, i).alias("end"), r["g"].alias("g")
                ),
            )
            taken = made if accept is None else F.filter(made, lambda s: accept(s["g"]))
            return F.transform(taken, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))

        return bound(running(lengths, lambda x, y: x + y), spans)

    found = bound(whole, lambda m: bound(F.arrays_zip(m.alias("m"), (m if group == 0 else part).alias("g"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)).alias("b")), placed))
    # most texts have no match: one look tells
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def highest_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy (bits a character) of a window sliding over an ASCII string of at least window characters.

    The counts of the window's characters are packed into a few integers. Each
    step takes one character off its count and adds one to another's; with
    them goes the sum of n * log2(n) by what a count's change adds to it, so a
    step costs the same however long the candidate is.
    """
    if not 2 <= window < 1 << COUNT_BITS:
        raise ValueError(f"windows of 2 to {(1 << COUNT_BITS) - 1} characters")
    weight = [0, *[round(n * math.log2(n) * (1 << FRACTION)) for n in range(1, window + 1)]]
    gains = F.array(*[F.lit(b - a).cast("long") for a, b in zip(weight, weight[1:])])
    words = -(-128 // PACKED)
    one = lambda bit: F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    count = lambda state, c: F.call_function("shiftright", F.get(state["n"], c["word"]), c["bit"]).bitwiseAND((1 << COUNT_BITS) - 1).cast("int")

    def place(char: Column) -> Column:
        return bound(F.ascii(char), lambda c: F.struct(F.floor(c / PACKED).cast("int").alias("word"), (c % PACKED * COUNT_BITS).alias("bit")))

    def step(state: Column, row: Column) -> Column:
        """The window's first character leaves (none before it is full), a new one enters."""
        new, old = row["new"], row["old"]
        same = F.coalesce((old["word"] == new["word"]) & (old["bit"] == new["bit"]), F.lit(False))
        lost = F.when(old.isNull(), F.lit(0).cast("long")).otherwise(F.get(gains, count(state, old) - 1))
        total = state["sum"] + F.get(gains, count(state, new) - same.cast("int")) - lost
        counts = F.when(same, state["n"]).otherwise(
            F.transform(
                state["n"],
                lambda n, j: n
                + F.when(j == new["word"], one(new["bit"])).otherwise(F.lit(0).cast("long"))
                - F.when(j == old["word"], one(old["bit"])).otherwise(F.lit(0).cast("long")),
            )
        )
        full = row["at"] >= window - 1
        return bound(total, lambda t: F.struct(counts.alias("n"), t.alias("sum"), F.when(full, F.least(state["least"], t)).otherwise(state["least"]).alias("least")))

    def over(places: Column) -> Column:
        rows = F.transform(places, lambda new, i: F.struct(new.alias("new"), F.get(places, i - window).alias("old"), i.alias("at")))
        start = F.struct(F.array_repeat(F.lit(0).cast("long"), words).alias("n"), F.lit(0).cast("long").alias("sum"), F.lit(1 << 62).alias("least"))
        return F.aggregate(rows, start, step, lambda s: F.lit(math.log2(window)) - s["least"] / (window << FRACTION))

    return bound(F.transform(F.split(candidate, ""), place), over)


def find(docs: DataFrame, text: str = "text", out: str = "found", allowed: tuple[str, ...] = ALLOWED, window: int = WINDOW) -> DataFrame:
    """docs with a column: struct(assign, access, hex, added), each an array of spans (start, rank of kind, end).

    rank is the place in ``KINDS``; places are code points, the end is
    exclusive. A null or empty text has no span. The rows keep all their
    columns; one called out is refused.
    """
    fresh(docs, out)
    body = F.coalesce(F.col(text), F.lit(""))

    def fits(limit: float):
        def accept(candidate: Column) -> Column:
            benign = F.lit(False)
            for pattern in allowed:
                benign = benign | candidate.rlike(pattern)
            return F.when(benign, F.lit(False)).otherwise(highest_entropy(candidate, window) >= limit)

        return accept

    def look(where: Column, *kinds: str) -> Column:
        return F.concat(*[spans_of(where, p.replace("20,", f"{window},"), KINDS.index(k), fits(limit)) for k in kinds for p, limit in [CLASSES[k]]])

    def held(frame: DataFrame, name: str, value: Column) -> DataFrame:
        """Exploding one value keeps it from being computed again for each use."""
        return frame.withColumn(name, F.explode_outer(F.array(value)))

    def blank(where: Column, spans: Column) -> Column:
        """The text with spaces in place of the spans."""
        fill = lambda s, at: F.repeat(F.lit(" "), s["end"] - F.greatest(at, s["start"]))
        return F.when(F.size(spans) > 0, replaced(where, F.array_sort(spans), fill)).otherwise(where)

    base = F.array(
        spans_of(body, ASSIGN, 0, lambda g: F.length(g) >= 6, 2),
        spans_of(body, ACCESS, 1),
        spans_of(body, HEX, 2),
    )
    scanned = held(docs, "__found", base)
    scanned = held(scanned, "__rest", blank(body, F.flatten("__found")))
    scanned = held(scanned, "__hexes", look(F.col("__rest"), "entropy_hex"))
    scanned = held(scanned, "__rest", blank(F.col("__rest"), F.col("__hexes")))
    added = F.concat("__hexes", look(F.col("__rest"), "entropy_base64", "entropy_alnum"))
    scanned = held(scanned, "__added", added)
    known = [F.get("__found", F.lit(i)).alias(k) for i, k in enumerate(KINDS[:3])]
    return scanned.withColumn(out, F.struct(*known, F.col("__added").alias("added"))).drop("__found", "__rest", "__hexes", "__added")


def replaced(text: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """The text with put(span, end of those before) in place of each of the ordered spans."""

    def part(parts: Column, start: Column, stop: Column) -> Column:
        """Characters start to stop, from the parts that hold them."""
        numbers = F.sequence(F.floor(start / PART).cast("int"), F.floor((stop - 1) / PART).cast("int"))
        cut = lambda j: F.substr(F.get(parts, j), F.greatest(start - j * PART, F.lit(0)) + 1, stop - F.greatest(start, j * PART))
        return F.when(start < stop, F.array_join(F.transform(numbers, cut), "")).otherwise(F.lit(""))

    def done(rows: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / PART).cast("int")), lambda j: F.substr(text, j * PART + 1, F.lit(PART)))
        ends = running(F.transform(rows, lambda s: s["end"]), F.greatest)

        def whole(parts: Column, ends: Column) -> Column:
            before = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0))
            pieces = F.transform(rows, lambda s, i: F.concat(part(parts, before(i), s["start"]), put(s, before(i))))
            return F.concat(F.array_join(pieces, ""), part(parts, before(F.size(rows)), F.length(text)))

        return bound(parts, lambda p: bound(ends, lambda e: whole(p, e)))

    return bound(spans, done)


def ordered(*spans: Column) -> Column:
    return F.array_sort(F.concat(*spans))


def joined(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1)
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", n_chars: str | None = None) -> DataFrame:
    """docs with every span of the text replaced by mark (overlapping spans by one); rows without a span stay as they are.

    n_chars names a column that holds the text's length, brought up to date where the text changes.
    """
    columns = docs.columns
    found = find(docs, text, "__spans")
    spans = ordered("__spans.assign", "__spans.access", "__spans.hex", "__spans.added")
    found = found.withColumn("__all", F.explode_outer(F.array(spans)))
    # one that overlaps the last goes on from it
    done = replaced(F.col(text), F.col("__all"), lambda s, at: F.when(s["start"] < at, F.lit("")).otherwise(F.lit(mark)))
    hit = F.size("__all") > 0
    found = found.withColumn("__done", F.explode_outer(F.array(F.when(hit, done))))
    changed = {text: F.when(hit, F.col("__done")).otherwise(F.col(text))}
    if n_chars:
        changed[n_chars] = F.when(hit, F.length("__done")).otherwise(F.col(n_chars)).cast(docs.schema[n_chars].dataType)
    return found.select(*[changed.get(c, F.col(c)).alias(c) for c in columns])
