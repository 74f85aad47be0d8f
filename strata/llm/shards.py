"""Sharding by histogram sort: byte-balanced shards from exact counts, one exchange.

Rows are ordered by (text hash, row id): equal texts are neighbours, and the order says
nothing about the source, so a hot source spreads evenly. The driver looks for splitters
in that order. Each round counts, across all partitions, the exact bytes in the bins that
still hold a splitter (a bin is a key prefix; the round cuts it into ``2**BITS`` probes)
and keeps the bin around each target. A splitter is found when its bin holds one key.
Three rounds settle some 10^9 distinct texts. Then every row's cell is known from its key
alone, and one exchange by cell moves the rows; each cell is sorted and numbered by itself.

Shards are cells grouped ``cells_per_shard`` at a time, so a shard is the work of many
tasks. Sizes: a splitter cuts between *units*, on the side that is nearer the target. A
unit is a group of equal texts while it holds at most ``tolerance`` of a shard; larger
groups are cut by row id, as one id's rows are the unit there. So shard sizes differ from
the mean by at most one unit, equal texts share a shard unless their group is too large,
and a hot group of copies is spread over cells like anything else.

What reaches the driver: per round at most (splitters x 2**BITS) counts, whatever the
input's size. Executors run built-in functions only.

Defined cases: null text counts as no bytes and sorts as the empty text; null ids sort
first, as the smallest long; rows equal in id and text are one unit and stay together;
an empty table gives an empty result; extra columns travel with their rows, except that
``size``, ``shard`` and ``slot`` are replaced.
"""
from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import free_prefix, stored

SHARDS = 8
CELLS_PER_SHARD = 64
#: Groups of equal texts above this share of a shard are cut.
TOLERANCE = 0.01
#: Key bits per round.
BITS = 10
#: The text hash: 60 bits, so that an unsigned prefix of it is a long on every engine.
HASH_BITS = 60
_LEAST = -(1 << 63)


def _split_key(text: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


_HASH_LEVELS = HASH_BITS // BITS


def _prefix(level: int) -> Column:
    """The key's first ``level`` digits as one string."""
    h, i = F.col("__h"), F.col("__uid")
    if level <= _HASH_LEVELS:
        return F.shiftrightunsigned(h, HASH_BITS - BITS * level).cast("string")
    return F.concat_ws(":", h, F.shiftrightunsigned(i, max(0, 64 - BITS * (level - _HASH_LEVELS))))


def _digit(level: int) -> Column:
    """The next digit after ``level`` digits: of the hash first, then of the id."""
    if level < _HASH_LEVELS:
        shift, col, width = HASH_BITS - BITS * (level + 1), F.col("__h"), BITS
    else:
        left = 64 - BITS * (level - _HASH_LEVELS)
        shift, col, width = max(0, left - BITS), F.col("__uid"), min(BITS, left)
    return F.shiftrightunsigned(col, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _splitters(keys: DataFrame, total: int, parts: int, largest_unit: float) -> list[tuple[int, int]]:
    """The (hash, unsigned id) of the first unit right of each of ``parts - 1`` targets."""
    found: dict[int, tuple[int, int]] = {}
    holes: dict[str, tuple[int, list[int]]] = {"0": (0, list(range(1, parts)))}
    level = 0
    while holes:
        rows = keys.where(_prefix(level).isin(list(holes))) if level else keys
        counted = rows.groupBy(_prefix(level).alias("p"), _digit(level).alias("d")).agg(
            F.sum("__size").alias("b"), F.min("__h").alias("h0"), F.max("__h").alias("h1"),
            F.min("__uid").alias("i0"), F.max("__uid").alias("i1"), F.first(_prefix(level + 1)).alias("q"))
        bins: dict[str, list] = {}
        for r in counted.collect():
            bins.setdefault(r["p"], []).append(r)
        deeper: dict[str, tuple[int, list[int]]] = {}
        for p, (before, targets) in holes.items():
            ordered = sorted(bins[p], key=lambda r: r["d"])
            starts = [before]
            for r in ordered[:-1]:
                starts.append(starts[-1] + r["b"])
            for t in targets:
                k = bisect.bisect_right(starts, t * total // parts) - 1
                r = ordered[k]
                one_text = r["h0"] == r["h1"]
                whole = one_text and level < _HASH_LEVELS and r["b"] <= largest_unit
                if whole or one_text and r["i0"] == r["i1"]:
                    # one unit: it goes to the side that its middle lies on
                    here = (r["h0"], 0 if whole else r["i0"] % (1 << 64))
                    after = (r["h0"] + 1, 0) if whole or here[1] == (1 << 64) - 1 else (r["h0"], here[1] + 1)
                    found[t] = here if (2 * starts[k] + r["b"]) * parts >= 2 * t * total else after
                else:
                    deeper.setdefault(r["q"], (starts[k], []))[1].append(t)
        holes, level = deeper, level + 1
    return [found[t] for t in range(1, parts)]


def _cell(splitters: list[tuple[int, int]], h: Column, i: Column) -> Column:
    """The number of splitters at or below the row's key (h, i), by binary search."""
    hs = F.array(*[F.lit(h).cast("long") for h, _ in splitters])
    ids = F.array(*[F.lit(i + _LEAST).cast("long") for _, i in splitters])

    def step(lo: Column, half: Column) -> Column:
        at = lo + half - 1
        passed = (F.get(hs, at) < h) | ((F.get(hs, at) == h) & (F.get(ids, at) <= i))
        return F.when(F.coalesce(passed, F.lit(False)), lo + half).otherwise(lo)

    width = max(1, len(splitters)).bit_length()
    halves = F.array(*[F.lit(1 << k) for k in range(width - 1, -1, -1)])
    return F.aggregate(halves, F.lit(0), step)


def shard(docs: DataFrame, shards: int = SHARDS, cells_per_shard: int = CELLS_PER_SHARD,
          tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``size`` (UTF-8 bytes + 1), ``shard`` and ``slot`` (gapless in the
    shard). Only the whole rows' exchange by cell moves texts."""
    text, free = F.col(text_col), free_prefix(docs)
    h, i, c = free + "h", free + "id", free + "cell"
    keyed = docs.withColumns({
        h: _split_key(text),
        # in the id's order when compared as signed longs
        i: F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)),
        "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
    })
    # small rows: the rounds reread them instead of the texts
    keys = stored(keyed.select(
        F.col(h).alias("__h"), F.col(i).alias("__id"), F.col("size").alias("__size"),
        # as unsigned bits, whose digits sort as the signed ids do
        F.col(i).bitwiseXOR(F.lit(_LEAST)).alias("__uid")), "shard-keys")
    total = int(keys.agg(F.sum("__size")).first()[0] or 0)
    parts = shards * cells_per_shard
    if total == 0:
        splitters = [(0, 0)] * (parts - 1)
    else:
        splitters = _splitters(keys, total, parts, tolerance * total / shards)
    per_cell = {r[0]: r[1] for r in keys.groupBy(_cell(splitters, F.col("__h"), F.col("__id")).alias("c")).agg(F.count("*").alias("n")).collect()}
    first, seen = [], 0
    for k in range(parts):
        seen = 0 if k % cells_per_shard == 0 else seen
        first.append(seen)
        seen += per_cell.get(k, 0)
    base = F.array(*[F.lit(x).cast("long") for x in first])
    order = Window.partitionBy(c).orderBy(h, i)
    return keyed.withColumn(c, _cell(splitters, F.col(h), F.col(i))).withColumn(
        "slot", F.row_number().over(order) - 1 + F.get(base, F.col(c))).withColumn(
        "shard", F.floor(F.col(c) / cells_per_shard).cast("int")).drop(h, i, c)
