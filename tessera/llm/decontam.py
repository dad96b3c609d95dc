"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

Words are compared as hashes. A seed is the hash of the words at the marked
places of a mask. Items of ``WINDOW`` words or more have two masks such that
any 15 words of which at most 3 are replaced still agree in a whole seed;
items of ``SHORT`` to 14 words have two shorter ones that do the same for as
many replaced words as ``SHARE`` leaves them (the tests try all ways of
replacing); shorter items leave none, their seed is the whole item. Documents
and items meet in equal seeds, and around each meeting the words of both are
compared place by place: an item is found if some ``WINDOW`` of its words (all
of a shorter item) stands in the document with at least ``SHARE`` of the words
equal.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.frames import ROW, fresh, numbered, stored, without

#: Places that count (1) or are ignored (0): of items of a window or more, and of those of SHORT words or more.
MASKS, SHORT_MASKS = ("111011", "101111"), ("1111", "110011")
WINDOW, SHORT, SHARE = 15, 6, 0.8
#: Seeds with the words around them (about 300 bytes each) that are broadcast; more are joined by a shuffle.
SEEDS_AT_ONCE = 100_000
#: Bits of the sieve before that shuffle for each seed, and its size in bits at least and at most (16 MB).
SIEVE_BITS, SIEVE_LEAST, SIEVE_MOST = 16, 1 << 14, 1 << 27
#: Words of a document that are searched as one row, besides those around them that a window can reach.
STRETCH = 2048


def masks_of(size: int, window: int = WINDOW) -> tuple[str, ...]:
    """The masks of items with so many words."""
    return MASKS if size >= window else SHORT_MASKS if size >= SHORT else ("1" * size,)


def least_equal(size: Column, window: int, share: float) -> Column:
    """The words that must be equal of a window, or of a whole shorter item."""
    compared = F.least(size, F.lit(window))
    return F.when(size < SHORT, size).otherwise(F.ceil(compared * share - 1e-9).cast("int"))


def words_of(text: Column) -> Column:
    """The words: runs of letters and digits, lower-cased."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def apart(column: Column) -> Column:
    """The column as one that filters above it aren't moved below (it would be computed twice, or in a join)."""
    return F.explode_outer(F.array(column))


def seed_key(hashes: Column, at: Column, mask: str) -> Column:
    """The seed of a mask laid on the words from place at on; masks have seeds of their own."""
    return F.xxhash64(F.lit(mask), *[F.get(hashes, at + k) for k, c in enumerate(mask) if c == "1"])


def seeds_of(benchmark: DataFrame, item_id: str, text: str, window: int, share: float) -> tuple[DataFrame, list[str]]:
    """Every seed of every item with the words of the item that a window around it can hold, and the masks used.

    lead is the place of the seed among these words, context their number: items
    that share a passage share contexts.
    """
    items = stored(benchmark.select(F.col(item_id).alias("item"), hashes_of(words_of(F.col(text))).alias("own")).where(F.size("own") > 0))
    kinds = sorted(r.kind for r in items.select(F.least(F.size("own"), F.lit(window)).alias("kind")).distinct().collect())
    masks = sorted({m for k in kinds for m in masks_of(k, window)})
    every = []
    for mask in masks:
        sizes = [k for k in kinds if mask in masks_of(k, window)]
        own = items.where(F.least(F.size("own"), F.lit(window)).isin(sizes))
        spots = own.select("item", "own", F.explode(F.sequence(F.lit(0), F.size("own") - len(mask))).alias("place"))
        first = F.greatest(F.lit(0), F.col("place") + len(mask) - window)
        last = F.least(F.size("own"), F.col("place") + window)
        every.append(
            spots.select(
                "item",
                seed_key(F.col("own"), F.col("place"), mask).alias("key"),
                (F.col("place") - first).alias("lead"),
                F.slice("own", first + 1, last - first).alias("theirs"),
                F.least(F.size("own"), F.lit(window)).alias("need"),
                least_equal(F.size("own"), window, share).alias("least"),
            )
        )
    if not every:
        return items.select("item", *[F.lit(0).cast(t).alias(c) for c, t in (("key", "long"), ("lead", "int"))], F.col("own").alias("theirs"), *[F.lit(0).alias(c) for c in ("need", "least")], F.lit(0).cast("long").alias("context")), []
    seeds = reduce(DataFrame.unionByName, every)
    return seeds.withColumn("context", F.xxhash64("key", "lead", "need", "theirs")), masks


def sieved(places: DataFrame, contexts: DataFrame, count: int) -> DataFrame:
    """places without most of those whose key no context has: two bits a key in a table of bounded size.

    The table is made by Spark and goes to the tasks as one value; at
    ``SIEVE_MOST`` bits more keys only let more places through.
    """
    bits = min(SIEVE_MOST, max(SIEVE_LEAST, 1 << (count * SIEVE_BITS - 1).bit_length()))
    spots = lambda key: (key.bitwiseAND(bits - 1), F.shiftrightunsigned(key, 32).bitwiseAND(bits - 1))
    words = contexts.select(F.explode(F.array(*spots(F.col("key")))).alias("bit")).groupBy((F.col("bit") / 64).cast("int").alias("at"))
    words = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))).alias("word"))
    # a word for every place of the table, so that its order is its address
    whole = places.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("at")).join(words, "at", "left")
    rows = whole.groupBy((F.col("at") / 1024).cast("int").alias("part")).agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("word", F.lit(0).cast("long")).alias("word")))).alias("words"))
    table = rows.agg(F.array_sort(F.collect_list(F.struct("part", F.col("words.word").alias("words")))).alias("parts")).select("parts.words")
    held = table.scalar()

    def has(bit: Column) -> Column:
        at = (bit / 64).cast("int")
        word = F.get(F.get(held, (at / 1024).cast("int")), at % 1024)
        return F.call_function("shiftright", word, (bit % 64).cast("int")).bitwiseAND(1) == 1

    first, second = spots(F.col("key"))
    return places.where(has(first) & has(second))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: float = SHARE,
    n_window: str = "n_window",
    n_equal: str = "n_equal",
    seeds_at_once: int = SEEDS_AT_ONCE,
) -> DataFrame:
    """(doc_id, item_id, n_window, n_equal): the items found in each document.

    n_window is the number of words compared (window, or all of a shorter
    item), n_equal the most of them that are equal anywhere in the document.
    Items of every length take part: of 6 words on some may be replaced, a
    shorter one stands in a document word for word. Items without words, null
    and empty texts find nothing. Rows with the same doc_id (or null ids)
    count as one document, repeated items as one item. Whole texts are
    searched, in one pass whatever the number of items.
    """
    fresh(docs.select(doc_id), item_id, n_window, n_equal)
    seeds, masks = seeds_of(benchmark, item_id, item_text, window, share)
    seeds = stored(seeds)
    # what items share is looked up once
    contexts = stored(seeds.drop("item").distinct())
    count = contexts.count()
    spans = [len(m) for m in masks] or [1]
    words = docs.select(F.col(doc_id).alias("doc"), words_of(F.col(text)).alias("words"))
    # a long text is searched in stretches, so that the rows made from one row stay few
    step, span, before = F.lit(STRETCH), min(spans), window - min(spans)
    cut = words.select("doc", "words", F.explode(F.sequence(F.lit(0), F.floor(F.greatest(F.size("words") - span, F.lit(0)) / step).cast("int"))).alias("nr"))
    begin = F.greatest(F.lit(0), F.col("nr") * step - before)
    cut = cut.select("doc", (F.col("nr") * step - begin).alias("skip"), F.slice("words", begin + 1, F.col("nr") * step + step + window - begin).alias("part"))
    cut = cut.select("doc", "skip", F.size("part").alias("n"), hashes_of(F.col("part")).alias("own")).where(F.col("n") - span >= F.col("skip"))
    spots = cut.select("doc", "n", "own", F.explode(F.sequence("skip", F.least(F.col("skip") + step - 1, F.col("n") - span))).alias("at"))
    # a mask that reaches over the end gives a seed of fewer words, which no item has
    keys = F.array(*[seed_key(F.col("own"), F.col("at"), m) for m in masks]) if masks else F.array().cast("array<long>")
    spots = spots.select("doc", "n", "own", "at", F.explode(keys).alias("key"))
    if count <= seeds_at_once:
        met = spots.join(F.broadcast(contexts), "key")
    else:
        # only what the sieve lets through is shuffled, with the words around it
        left = F.greatest(F.lit(0), F.col("at") - window)
        near = sieved(spots, contexts, count).select(
            "doc", "key", (F.col("at") - left).alias("at"), F.slice("own", left + 1, 2 * window + F.col("at") - left).alias("own")
        )
        met = near.withColumn("n", F.size("own")).join(contexts.hint("merge"), "key")
    low = -F.least(F.col("lead"), F.col("at"))
    high = F.least(F.size("theirs") - F.col("lead"), F.col("n") - F.col("at"))
    met = met.where(high - low >= F.col("need")).select(
        "doc",
        "context",
        "need",
        "least",
        F.slice("theirs", low + F.col("lead") + 1, high - low).alias("theirs"),
        F.slice("own", low + F.col("at") + 1, high - low).alias("ours"),
    )
    same = F.transform("ours", lambda w, j: (w == F.get("theirs", j)).cast("int"))
    met = met.select("doc", "context", "need", "least", apart(same).alias("same"))
    sums = F.transform(
        F.sequence(F.lit(1), F.size("same") - F.col("need") + 1),
        lambda s: F.aggregate(F.slice("same", s, F.col("need")), F.lit(0), lambda x, y: x + y),
    )
    met = met.select("doc", "context", "need", "least", apart(F.array_max(sums)).alias("equal")).where(F.col("equal") >= F.col("least"))
    met = met.groupBy("doc", "context").agg(F.max("need").alias("need"), F.max("equal").alias("equal"))
    members = stored(seeds.select("context", "item").distinct())
    members = F.broadcast(members) if members.count() <= seeds_at_once else members
    every = met.join(members, "context").groupBy("doc", "item").agg(F.max("need").alias("need"), F.max("equal").alias("equal"))
    return every.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), F.col("need").alias(n_window), F.col("equal").alias(n_equal))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the rows in which an item is found. docs must be a stored table: its rows are numbered in two reads."""
    rows = numbered(docs)
    return without(rows, contaminated(rows, benchmark, ROW, text, item_id, item_text))


#: The same by brute force: items and documents lined up at every shift, every window counted.
CONTAMINATED_SQL = r"""
with d as (
    select doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as own from documents
), b as (
    select item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as own from benchmark
), dw as (
    select doc_id, len(own) as n, unnest(own) as w, generate_subscripts(own, 1) as at from d
), bw as (
    select item_id, len(own) as words, least(15, len(own)) as need,
        case when len(own) < 6 then len(own) else cast(ceil(least(15, len(own)) * 0.8 - 1e-9) as int) end as least_equal,
        unnest(own) as w, generate_subscripts(own, 1) as at
    from b
), met as (
    select doc_id, item_id, words, need, least_equal, bw.at as place, dw.at - bw.at as shift, n from dw join bw using (w)
), dense as (
    select *, count(*) over (partition by doc_id, item_id, shift) as total from met
), counted as (
    select *, count(*) over (partition by doc_id, item_id, shift order by place range between current row and 14 following) as here
    from dense where total >= least_equal
)
select doc_id, item_id, cast(max(need) as int) as n_window, cast(max(here) as int) as n_equal
from counted
where here >= least_equal
  and least(words, n - shift) - greatest(0, -shift) >= need
group by doc_id, item_id
"""
