"""Line-first cleaning: judge every line, drop the failing ones, then judge the document.

Only built-in column functions run, one narrow pass over the rows: no shuffle, so a hot
source or a hot group of copies costs what its rows cost and nothing more.

A line with words fails when any rule holds:

* *punctuation*: it has ``min_line_words`` words or more, and doesn't end in a terminal
  mark; or half of its words carry one of ``#*$%&|<>``; or half of them end in a doubled
  mark such as ``!!``;
* *navigation*: three separators or more, a fifth of its words at least;
* *boilerplate*: it holds a licence, copyright or cookie phrase, or starts or ends with a
  site-chrome phrase; of more than ``BOILERPLATE_CHARS`` characters, half of them or more
  are in sentences that do.

Failing lines are removed. A document is rejected when the base counts fail or when the
removed lines held more than ``max_lost_percent`` of its word characters.

Defined cases: null text counts as a text without words (rejected, cleaned text null);
an empty text likewise (cleaned text empty); blank lines are never judged and stay;
repeated rows are judged alike; other columns of the input, whatever their names, are
untouched (working columns live in one struct named by the caller).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, bind, free_prefix, with_passing, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_LINE_WORDS = 4
MAX_LOST_PERCENT = 50

#: Patterns below use the syntax that Java's and RE2's engines share.
TERMINAL = r"[.!?:;…。！？][\x22'”’»)\]*_\x20\x09-\x0D]*$"
#: What may follow a terminal mark, however much of it: blanks, closing quotes and brackets.
CLOSING = " \t\n\x0b\x0c\r\"'”’»)]*_"
SYMBOL_WORD = r"[^\x20\x09-\x0D]*[#*$%&|<>][^\x20\x09-\x0D]*"
SHOUTED_WORD = r"(!!|\?\?)"
SEPARATOR_WORD = r"(^|[\x20\x09-\x0D])[|»«›‹>·•]+"
#: A line without any of these can't fail the symbol, shouting or separator tests.
SUSPECT = r"[#*$%&|<>»«›‹·•]|!!|\?\?"
BOILERPLATE_CHARS = 200
#: Lower case; matched anywhere in the lower-cased line.
NOTICES = (
    "licensed under", "all rights reserved", "copyright (c)", "copyright ©", "©", "cookie policy",
    "cookie settings", "accept cookies", "accept all cookies", "privacy policy", "terms of use",
    "terms of service", "skip to content", "skip to main content", "enable javascript", "lorem ipsum",
)
#: Phrases that prose uses too: in a short line they count at its start or end alone.
CHROME = ("sign in", "sign up", "log in", "subscribe", "click here", "read more")
#: What may stand behind a phrase at a line's end.
BEHIND = CLOSING + ".!?:;…"


def repeated_words(ws: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more.

    Windows become (hash, position) pairs; sorting brings equal ones together; the sorted
    positions of repeated windows then cover min(3, gap to the next) words each."""

    zero = F.lit(0).cast("long")

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return bind(pairs, lambda g: bind(F.sort_array(F.filter(
            F.transform(g, lambda x, k: F.when(
                (F.get(g, k - 1)["h"] == x["h"]) | (F.get(g, k + 1)["h"] == x["h"]), x["p"])),
            lambda p: p.isNotNull())), lambda pos: F.aggregate(
                F.transform(pos, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(pos, k + 1) - p, F.lit(3)))),
                zero, lambda a, x: a + x)))

    def of(w: Column) -> Column:
        hashes = F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.slice(w, i, F.lit(3)))))
        # most texts repeat no window: the sort is only for the others
        return bind(hashes, lambda hs: F.when(hs.isNull() | (F.size(F.array_distinct(hs)) == F.size(hs)), zero).otherwise(covered(hs)))

    return bind(ws, of)


def line_fails(line: Column, min_line_words: int = MIN_LINE_WORDS) -> Column:
    """Whether one line (a lambda variable) fails a rule; blank lines never fail.

    The cheap tests run first: a line that ends well and holds no suspect character is
    done without counting its words."""
    # without what may follow it, a terminal mark is the last character
    unended = ~F.right(F.rtrim(line, F.lit(CLOSING)), F.lit(1)).rlike(TERMINAL)
    suspect = line.rlike(SUSPECT)
    n = F.size(words(line))
    details = bind(n, lambda n: (n > 0) & (
        ((n >= min_line_words) & unended)
        | suspect & (n >= 2) & (
            (F.regexp_count(line, F.lit(SYMBOL_WORD)) * 2 >= n)
            | (F.regexp_count(line, F.lit(SHOUTED_WORD)) * 2 >= n)
            | bind(F.regexp_count(line, F.lit(SEPARATOR_WORD)), lambda k: (k >= 3) & (k * 5 >= n)))))

    def any_of(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, tests)

    def at_edge(low: Column) -> Column:
        begun, ended = F.ltrim(low, F.lit(" ")), F.concat(F.lit(" "), F.rtrim(low, F.lit(BEHIND)))
        return any_of([begun.startswith(F.lit(x + " ")) | ended.endswith(F.lit(" " + x)) for x in CHROME])

    def phrased(low: Column) -> Column:
        # the edges are looked at only where a phrase is
        return any_of([low.contains(F.lit(x)) for x in NOTICES]) | any_of([low.contains(F.lit(x)) for x in CHROME]) & at_edge(low)

    def mostly(low: Column) -> Column:
        return F.aggregate(F.filter(F.split(low, r"(?<=[.!?] )"), phrased), F.lit(0), lambda a, x: a + F.length(x)) * 2 >= F.length(low)

    # a long line may hold its phrases at the edges of its sentences only
    phrases = bind(F.lower(line), lambda low: F.when(F.length(line) <= BOILERPLATE_CHARS, phrased(low)).otherwise(
        any_of([low.contains(F.lit(x)) for x in NOTICES + CHROME]) & mostly(low)))
    return ((unended | suspect) & details) | phrases


def _word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long")


def apply_line_rules(docs: DataFrame, text: str = "text", out: str = "cleaning",
                     min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
                     max_lost_percent: int = MAX_LOST_PERCENT,
                     min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """``docs`` plus a struct column ``out``: the base counts (n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words), n_lines, n_removed_lines, removed_chars,
    cleaned_text, base_failed and kept."""
    raw = F.col(text)
    t = F.coalesce(raw, F.lit(""))

    def judged(w: Column) -> Column:
        lines = F.split(t, "\n")
        counted = F.filter(lines, lambda x: x.rlike(f"[^{SPACE}]"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            bind(counted, lambda c: (F.size(c) - F.size(F.array_distinct(c))).cast("long")).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            bind(lines, lambda ls: F.filter(ls, lambda x: ~line_fails(x, min_line_words))).alias("good"),
        )

    rows = docs.withColumn(out, bind(words(raw), judged))
    c = F.col(out)
    rows = rows.withColumn(out, F.struct(
        *[c[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")],
        (c["n_lines"] - F.size(c["good"])).alias("n_removed_lines"),
        F.when(raw.isNotNull(), F.array_join(c["good"], "\n")).alias("cleaned_text"),
        ((c["n_words"] < min_words) | (c["n_repeat_words"] * 100 > c["n_words"] * max_repeat_percent)).alias("base_failed"),
    ))
    c = F.col(out)
    lost = c["word_chars"] - F.coalesce(_word_chars(c["cleaned_text"]), F.lit(0).cast("long"))
    rows = rows.withColumn(out, c.withField("removed_chars", lost))
    return rows.withColumn(out, c.withField(
        "kept", ~c["base_failed"] & (c["removed_chars"] * 100 <= c["word_chars"] * max_lost_percent)))


def keep_clean(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The documents that pass, their text replaced by the cleaned one."""
    out = free_prefix(docs) + "line_rules"
    judged = with_passing(apply_line_rules(docs, text, out, **limits), out, F.col(out), lambda c: c["kept"])
    return judged.withColumn(text, F.col(out)["cleaned_text"]).drop(out)
