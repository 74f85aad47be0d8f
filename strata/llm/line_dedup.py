"""Line dedup by content-defined windows: repeated multi-line passages stay once.

*Units.* A text is cut after every line feed and, within a line, after every sentence, as
prose is often stored as one very long line; a unit keeps its separator and the blank lines
after it, so units join to the text again. Trailing blanks don't count in comparisons.

*Windows.* What is compared is the shortest run of two units or more with ``MIN_CHARS``
characters, once forward and once backward from each unit, or one unit of ``LONE_CHARS``.
A window depends on its own units alone, so it comes out the same wherever a passage is
moved, and the windows of a passage overlap: together they cover it from its first unit to
its last, in mid-line as in lines of its own.

*Repeats.* All windows are counted by a 64-bit hash across the corpus (partial sums before
the shuffle). Only documents with one that occurs again read their text again, for these
windows alone; equality is decided on 128 bits of the SHA-256 of their units. The
occurrence in the smallest (id, text hash, position) stays, the units of every other are cut
from their document. So each unit that is cut stands at a smaller place too, and a repeated
passage is cut whole, whatever runs of units its earlier occurrences lie in.

The main path is built-in functions only. A passage in a third of all documents is one
row a task in the grouping (partial aggregation) and a skewed join side that AQE splits;
nothing collects its occurrences.

Defined cases: null text stays null and holds no window; empty text likewise; texts without
repeats come back byte for byte; rows equal in id and text are one document, treated alike;
rows without id come after the others in the order of occurrences; an empty table gives an
empty result; extra columns travel along, whatever their names (working columns take
free ones); runs under ``MIN_CHARS`` are never cut.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, SPACE_CHARS, bind, free_prefix, stored, with_passing

MIN_CHARS = 60
LONE_CHARS = 120
#: A window has at most MIN_CHARS units.
PACK = 64
#: Units of the windows that are told row by row.
NEAR = 16

#: A unit ends before the next character that isn't blank, if a line or sentence ended.
_UNIT_ENDS = rf"(?:(?<=\n)|(?<=[.!?] ))(?=[\x20\x09\x0B-\x0D]*[^{SPACE}])"


#: Stands for a unit's end while a text is cut; a text that holds it is cut by the pattern.
_MARK = "\x01"


def _any(parts) -> Column:
    return reduce(lambda a, b: a | b, parts)


#: Blanks that send a text to the pattern.
_ODD = [_MARK, "\t", "\x0b", "\x0c", "\r"]


def _replaced(text: Column, by: dict[str, str]) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e), F.lit(by[e])), by, text)


def units(text: Column) -> Column:
    """Lines and sentences with their separators. Plain replacements mark the ends, which
    takes less time than the pattern's look-around; where a blank follows an end, or for
    rare blanks, the pattern decides."""
    by_pattern = F.split(text, _UNIT_ENDS)
    # the ends before a blank line are none
    ends = _replaced(text, {e: e + _MARK for e in ("\n", ". ", "! ", "? ")} | {_MARK + "\n": "\n"})

    def plain(m: Column) -> Column:
        # a text's end is no unit's
        return F.when(m.endswith(_MARK), bind(F.split(m, _MARK), lambda p: F.slice(p, 1, F.size(p) - 1))).otherwise(F.split(m, _MARK))

    return F.when(_any([text.contains(c) for c in _ODD]), by_pattern).otherwise(
        bind(ends, lambda m: F.when(m.contains(_MARK + " "), by_pattern).otherwise(plain(m))))


def bare_units(text: Column) -> Column:
    """Units without their trailing blanks, likewise: marks take the place of one blank, and
    where there are more the pattern decides."""

    def cut(t: Column) -> Column:
        by_pattern = F.transform(F.split(t, _UNIT_ENDS), lambda u: F.rtrim(u, F.lit(SPACE_CHARS)))
        ends = _replaced(t, {e: e.strip() + _MARK for e in ("\n", ". ", "! ", "? ")})
        return F.when(_any([t.contains(c) for c in _ODD]), by_pattern).otherwise(bind(ends, lambda m: F.when(
            _any([m.contains(c) for c in (_MARK + _MARK, _MARK + " ", " " + _MARK)]), by_pattern).otherwise(F.split(m, _MARK))))

    # blanks at a text's end belong to its last unit
    blank_end = _any([text.endswith(c) for c in SPACE_CHARS])
    return bind(F.when(blank_end, F.rtrim(text, F.lit(SPACE_CHARS))).otherwise(text), cut)


def _marked(text: Column) -> Column:
    """A text's units as h (hash) and n (characters, one separator included)."""
    return F.transform(bare_units(text), lambda u: F.struct(F.xxhash64(u).alias("h"), (F.length(u) + 1).alias("n")))


def _chars(n: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, n)


def _long(m: Column, i: Column, step: int, beyond: int) -> Column:
    """The window from unit i on (step 1) or back (step -1) if it has over ``beyond`` units."""
    # a unit has a character at least, so MIN_CHARS units are always enough
    low = i if step == 1 else F.greatest(F.lit(0), i - MIN_CHARS + 1)
    part = F.slice(m, low + 1, F.lit(MIN_CHARS) if step == 1 else i - low + 1)
    # a backward window that is no longer one without its last unit is the forward window
    # of its first unit: it is left to that one, so no window comes twice
    total = F.aggregate(
        part if step == 1 else F.reverse(part), F.struct(F.lit(0).alias("k"), F.lit(0).alias("c")),
        lambda a, x: F.when((a["k"] >= 2) & (a["c"] >= MIN_CHARS), a).otherwise(F.struct((a["k"] + 1).alias("k"), (a["c"] + x["n"]).alias("c"))),
        lambda a: F.when((a["k"] >= 2) & (a["c"] - (F.lit(0) if step == 1 else F.get(m, i)["n"]) >= MIN_CHARS), a["k"]))
    found = bind(total, lambda k: F.when(k.isNotNull(), bind(i if step == 1 else i - k + 1, lambda s: F.struct(
        F.xxhash64(F.transform(F.slice(m, s + 1, k), lambda x: x["h"])).alias("h"), (s.cast("long") * PACK + k).alias("at")))))
    # a few units are enough, mostly
    first = [F.get(m, i + step * k)["n"] for k in range(beyond)]
    return F.when((_chars(first[:4]) < MIN_CHARS) & (_chars(first) < MIN_CHARS), found)


def windows(text: Column) -> Column:
    """Array of all windows: h (hash of the units' hashes) and at (first unit * ``PACK``
    + number of units). ``window_rows`` has the same as rows, for whole tables."""

    def run(m: Column, s: Column, n: int) -> Column:
        return F.struct(F.xxhash64(*[F.get(m, s + k)["h"] for k in range(n)]).alias("h"), (s.cast("long") * PACK + n).alias("at"))

    def several(m: Column, i: Column, step: int) -> Column:
        """The window from unit i on (step 1) or back (step -1) if it has two units or more."""

        def chars(first: int, last: int) -> Column:
            return _chars([F.get(m, i + step * k)["n"] for k in range(first, last + 1)]) >= MIN_CHARS

        runs = {n: run(m, i if step == 1 else i - (n - 1), n) for n in (2, 3, 4)}
        if step == -1:
            # unless the units before i, of a window of n, are one already
            runs = {n: F.when(F.get(m, i - 1)["n"] >= LONE_CHARS if n == 2 else chars(1, n - 1), r) for n, r in runs.items()}
        return F.when(chars(0, 1), runs[2]).when(chars(0, 2), runs[3]).when(chars(0, 3), runs[4]).otherwise(_long(m, i, step, 4))

    def at(m: Column, x: Column, i: Column) -> Column:
        return F.when(x["n"] >= LONE_CHARS, F.array(run(m, i, 1), F.lit(None))).otherwise(F.array(several(m, i, 1), several(m, i, -1)))

    return bind(_marked(text), lambda m: F.filter(F.flatten(F.transform(m, lambda x, i: at(m, x, i))), lambda w: w.isNotNull()))


def _long_windows(m: Column) -> Column:
    """Array of the windows of over ``NEAR`` units."""
    return F.filter(F.flatten(F.transform(m, lambda x, i: F.array(_long(m, i, 1, NEAR), _long(m, i, -1, NEAR)))), lambda w: w.isNotNull())


def window_rows(docs: DataFrame, key: Column, text: Column) -> DataFrame:
    """``windows`` of every document as rows: __k (the document's key), h and at.

    A row for each unit beside those that follow it, from which compiled code tells the
    windows that begin there: several times as fast as functions over arrays."""
    found = docs.select(key.alias("__k"), _marked(text).alias("m"))
    # many units under MIN_CHARS hold one under their share of it
    long = F.when(F.array_min("m.n") * NEAR < MIN_CHARS, _long_windows(F.col("m"))).otherwise(F.array().cast("array<struct<h:bigint,at:bigint>>"))
    size = F.size("m")
    beside = [(f"{c}{k}", F.slice(f"m.{c}", k + 1, size)) for c in "hn" for k in range(NEAR)]
    beside = found.select("__k", size.alias("size"), long.alias("long"), *[c.alias(name) for name, c in beside])
    row = beside.select("__k", "size", F.posexplode(F.arrays_zip("long", *beside.columns[3:])).alias("i", "u"))

    # columns, as an expression used twice would be computed twice
    row = row.withColumn("c0", F.col("u.n0"))
    for k in range(1, NEAR):
        row = row.withColumn(f"c{k}", F.col(f"c{k - 1}") + F.coalesce(F.col(f"u.n{k}"), F.lit(0)))
    sums = [F.col(f"c{k}") for k in range(NEAR)]
    lone = F.col("c0") >= LONE_CHARS
    # from its unit on: the shortest window; longer ones are backward windows of their last
    # unit, as long as they need this unit
    row = row.withColumns({
        "forward": F.when(lone, 1).when((sums[-1] >= MIN_CHARS) & (F.col("i") + 1 < F.col("size")), 2 + _chars([(c < MIN_CHARS).cast("int") for c in sums[1:-1]])),
        "backward": F.least(1 + _chars([(c - sums[0] < MIN_CHARS).cast("int") for c in sums[1:]]), F.col("size") - F.col("i")),
        "pair": F.when(lone & (F.col("u.n1") < LONE_CHARS), 2)})
    units_of = F.sequence("forward", F.greatest("forward", "backward", "pair"))
    each = F.when(F.col("u.long").isNull(), units_of).otherwise(
        F.concat(F.array(F.lit(0)), F.coalesce(units_of, F.array().cast("array<int>"))))
    told = row.select("__k", "i", "u", F.explode(each).alias("k"))
    h = [F.col(f"u.h{k}") for k in range(NEAR)]
    k = F.col("k")
    hashed = F.when(k == 0, F.col("u.long.h")).when(k == 2, F.xxhash64(*h[:2])).otherwise(F.xxhash64(F.slice(F.array(*h), 1, k)))
    return told.select("__k", hashed.alias("h"), F.when(k == 0, F.col("u.long.at")).otherwise(F.col("i").cast("long") * PACK + k).alias("at"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, list[str], str]:
    """(keyed, removals, names, cut): ``docs`` with its key columns, and for each key the
    first units and lengths of the windows that stand elsewhere before, an array of {s, n};
    then the names of the key columns and of that array, which no column of ``docs`` has."""
    text, free = F.col(text_col), free_prefix(docs)
    names, cut = [free + n for n in ("no_id", "id", "th")], free + "cut"
    keyed = docs.withColumns(dict(zip(names, (
        F.col(id_col).isNull(), F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")), F.xxhash64(text)))))
    # one number for the key, as there is a row a window: documents that share it only look
    # at each other's places too
    key = F.xxhash64(*names).alias("__k")
    found = stored(window_rows(keyed, key, text), "line-windows")
    # stored, here and below, so that both sides of the join are plain shuffles: AQE can
    # then split the rows of a passage that very many documents share
    again = stored(found.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "line-repeats")
    suspects = found.join(again, "h").groupBy("__k").agg(F.collect_set("at").alias("__at"))

    def digests(us: Column) -> Column:
        run = F.transform("__at", lambda a: F.struct((a / PACK).cast("int").alias("s"), (a % PACK).cast("int").alias("n")))
        return F.transform(F.filter(run, lambda w: w["s"] + w["n"] <= F.size(us)), lambda w: F.struct(
            w["s"].alias("s"), w["n"].alias("n"),
            F.substring(F.unhex(F.sha2(F.array_join(F.slice(us, w["s"] + 1, w["n"]), "\n").cast("binary"), 256)), 1, 16).alias("digest")))

    # only documents with a suspect window read their text again
    placed = stored(
        keyed.select(key, *names, text.alias("__text")).join(suspects, "__k").select(
            *names, F.explode(bind(bare_units(F.col("__text")), digests)).alias("w")).select(*names, "w.*"), "line-suspects")
    place = F.struct(*names, "s")
    first = stored(placed.groupBy("digest").agg(F.min(place).alias("first")), "line-firsts")
    removals = placed.join(first, "digest").where(place != F.col("first")).groupBy(*names).agg(
        F.sort_array(F.collect_set(F.struct("s", "n"))).alias(cut))
    return keyed, removals, names, cut


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every repeated passage cut from its text but for the first occurrence;
    ``count_col``, if named, says how many runs of units were cut."""
    keyed, removals, names, cut_col = repeated_windows(docs, id_col, text_col)
    c = F.col(cut_col)

    def end(k: Column) -> Column:
        # no window lies strictly inside another, so ends rise with the starts
        return F.coalesce(F.get(c, k)["s"] + F.get(c, k)["n"], F.lit(0))

    def without(us: Column) -> Column:
        kept = F.transform(c, lambda w, k: F.array_join(F.slice(us, end(k - 1) + 1, F.greatest(F.lit(0), w["s"] - end(k - 1))), ""))
        rest = F.array_join(F.slice(us, end(F.size(c) - 1) + 1, F.size(us)), "")
        return F.concat(F.array_join(kept, ""), rest)

    runs = F.size(F.filter(c, lambda w, k: (k == 0) | (w["s"] > end(k - 1))))
    cut = keyed.join(removals, names, "left")
    cleaned = F.when(c.isNull(), F.col(text_col)).otherwise(bind(units(F.col(text_col)), without))
    counted = {count_col: F.when(c.isNull(), 0).otherwise(runs).cast("long")} if count_col else {}
    return cut.withColumns({text_col: cleaned, **counted}).drop(*names, cut_col)


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that still hold a word."""
    return with_passing(docs, text_col, F.col(text_col), lambda t: t.rlike(f"[^{SPACE}]"))
