"""Line rules, shards and line dedup against plain Python versions."""
import hashlib
import random
import re
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from strata.llm import line_dedup, quality_rules, shards

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {p for i, g in enumerate(grams) if often[g] > 1 for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_base_counts_equal_a_plain_count(docs):
    rng = random.Random(5)
    parts = ["a", "b", "Ünï", "x#y", " ", "  ", "\n", "\t", "\x0b", " ", "c.", "***", "\r\n"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 80)))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "same same same same"), (903, "word " * 30_000), (902, "same same same same")]
    got = quality_rules.apply_line_rules(docs(rows)).select(
        "doc_id", "cleaning.n_words", "cleaning.word_chars", "cleaning.n_symbols", "cleaning.n_dup_lines",
        "cleaning.n_repeat_words").collect()
    assert sorted(map(tuple, got)) == sorted((i, *counts(t)) for i, t in rows)


PROSE = "The river ran past the old mill and the miller slept in the sun all day. " * 8


@pytest.mark.parametrize("line, fails", [
    ("A plain sentence with an end.", False), ("no end mark on this line here", True), ("Short one", False), ("", False),
    ("th$$$ is%%% no### text&&& at*** all.", True), ("WHAT!! IS!! THIS!! NOW!!", True), ("Home | News | Sport | Shop | Us.", True),
    ("All rights reserved.", True), ("He said: “Go home.”", False), ("It costs 5 $ or so, they say.", False),
])
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    got = df.select(F.transform(F.array("line"), lambda x: quality_rules.line_fails(x))[0]).first()[0]
    assert got == fails


def test_failing_lines_go_and_lossy_documents_are_rejected(docs):
    rows = [(1, PROSE + "\nAll rights reserved.\n" + PROSE.upper()), (2, PROSE + "\n" + "x## y## " * 300), (3, PROSE), (4, None), (5, "Too short.")]
    df = docs(rows, ["cleaning2", "kept"])
    kept = {r["doc_id"]: r["text"] for r in quality_rules.keep_clean(df, max_repeat_percent=100).collect()}
    assert kept == {1: PROSE + "\n" + PROSE.upper(), 3: PROSE}
    assert quality_rules.keep_clean(df).columns == df.columns
    assert quality_rules.keep_clean(df.limit(0)).count() == 0


def expected_shards(rows, parts, tolerance):
    keys = sorted((int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16), -2**63 if i is None else i, len((t or "").encode()) + 1)
                  for i, t in rows)
    total, at, out = sum(k[2] for k in keys), 0, []
    for _, group in groupby(keys, key=lambda k: k[0]):
        group = list(group)
        whole = sum(k[2] for k in group) <= tolerance * total / parts
        for unit in [group] if whole else [list(u) for _, u in groupby(group, key=lambda k: k[1])]:
            size = sum(k[2] for k in unit)
            s = min(parts - 1, (2 * at + size) * parts // (2 * total))
            at += size
            out += [(k[1], k[2], s) for k in unit]
    seen, placed = Counter(), []
    for i, size, s in out:
        placed.append((i, size, s, seen[s]))
        seen[s] += 1
    return sorted(placed)


@pytest.mark.parametrize("rows", [
    [(i, f"t{i % 7}") for i in range(300)] + [(None, None)] * 5 + [(-3, "t1")] * 40 + [(2**62 + k, "zz" * k) for k in range(50)],
    [(i, "one text") for i in range(100)],
    [(1, "x")],
])
def test_shards_equal_the_exact_split(docs, rows):
    got = shards.shard(docs(rows, ["shard", "__other"]), cells_per_shard=4)
    assert got.where("shard is null or slot is null").count() == 0
    found = sorted((-2**63 if r.doc_id is None else r.doc_id, r["size"], r["shard"], r["slot"]) for r in got.collect())
    assert found == expected_shards(rows, 8, shards.TOLERANCE)


def test_shards_of_an_empty_table(docs):
    assert shards.shard(docs([])).count() == 0


def sentences(seed, n):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(9)).capitalize() + ". " for _ in range(n)]


def test_a_passage_moved_within_texts_is_kept_once(docs):
    passage = "".join(sentences(1, 10)).strip()
    rows = [(i, "".join(sentences(100 + i, 4)) + "\n" + passage + "\n" + "".join(sentences(200 + i, 3))) for i in range(30)]
    rows += [(50, "".join(sentences(300, 5))), (51, None), (52, "")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(rows, ["h", "s", "bytes"])).collect()}
    assert passage in got[0] and sum(passage in (t or "") for t in got.values()) == 1
    for i, t in rows:
        own = (t or "").replace(passage + "\n", "") if i in range(1, 30) else t
        assert got[i] == own


def test_passage_inside_a_line_loses_its_inner_chunks(docs):
    passage = "".join(sentences(2, 30))
    rows = [(i, "".join(sentences(400 + i, 3)) + passage + "".join(sentences(500 + i, 3))) for i in range(5)]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs(rows), count_col="cut").collect()}
    assert got[0]["text"] == rows[0][1]
    for i in range(1, 5):
        assert got[i]["cut"] > 0 and len(got[i]["text"]) < len(rows[i][1]) - 0.7 * len(passage)
        assert "".join(sentences(400 + i, 3)).strip() in got[i]["text"]


def test_repeated_rows_and_unrepeated_texts_stay(docs):
    rows = [(1, "".join(sentences(7, 6))), (1, "".join(sentences(7, 6))), (None, "short\nlines\nonly\n"), (2, "short\nlines\nonly\n")]
    got = sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.dedup_lines(docs(rows)).collect())
    assert got == sorted((i or 0, t) for i, t in rows)
    assert line_dedup.dedup_lines(docs([])).count() == 0


def uncut(rows, least=60, lone=120):
    """Texts without the units of repeated windows, from all windows of all units."""
    ends = re.compile(r"(?:(?<=\n)|(?<=[.!?] ))(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])")
    first, held = {}, {}
    for i, t in sorted(rows):
        us = ends.split(t)
        bare = [u.rstrip(" \t\n\x0b\x0c\r") for u in us]
        n = [len(b) + 1 for b in bare]
        spans = {(k, k + 1) for k in range(len(us)) if n[k] >= lone}
        for k in range(len(us)):
            spans |= set([(k, e) for e in range(k + 2, len(us) + 1) if sum(n[k:e]) >= least][:1] if n[k] < lone else [])
            spans |= set([(s, k + 1) for s in range(k - 1, -1, -1) if sum(n[s:k + 1]) >= least][:1] if n[k] < lone else [])
        held[i] = us, {(s, e): "\n".join(bare[s:e]) for s, e in spans}
        for (s, _), x in sorted(held[i][1].items()):
            first.setdefault(x, (i, s))
    return {i: "".join(u for k, u in enumerate(us) if not any(s <= k < e and first[x] != (i, s) for (s, e), x in spans.items()))
            for i, (us, spans) in held.items()}


@pytest.mark.parametrize("length", [2, 4, 5, 6, 7, 8])
def test_short_passages_are_cut_whole_wherever_they_stand(docs, length):
    passage, rows = "".join(sentences(600 + length, length)), []
    for i in range(12):
        head, tail = "".join(sentences(700 + i, 1 + i % 4)), "".join(sentences(800 + i, 1 + i % 3))
        rows.append((i, head + passage + tail if i % 2 else head + "\n" + passage.replace(". ", ".\n") + tail))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(rows)).collect()}
    assert got[0] == rows[0][1]
    for i, t in rows[1:]:
        assert got[i] == t.replace(passage, "").replace(passage.replace(". ", ".\n"), "")


def test_cut_units_are_those_of_all_repeated_windows(docs):
    rng = random.Random(9)
    pool = [s.strip() for s in sentences(11, 12)] + [f"Row {k}." for k in range(6)] + ["word " * 30 + "end."]
    rows = [(i, "".join(rng.choice(pool) + rng.choice([" ", " ", "\n", " \n\n", "\n  "]) for _ in range(rng.randint(1, 25)))) for i in range(60)]
    rows += [(90, "\n\n" + rows[3][1]), (91, "same line\n" * 40), (92, pool[0])]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(rows)).collect()}
    assert got == uncut(rows)


@pytest.mark.parametrize("after", [" " * 8, " " * 300, ")" * 9, "”\t" * 40, "]_" * 10, "\r"])
@pytest.mark.parametrize("line, fails", [("The miller slept in the sun.", False), ("The miller slept in the sun", True)])
def test_padding_after_the_terminal_mark_does_not_count(spark, line, fails, after):
    df = spark.createDataFrame([(line + after,)], "line string")
    assert df.select(F.transform(F.array("line"), lambda x: quality_rules.line_fails(x))[0]).first()[0] == fails


def test_documents_of_padded_lines_are_kept(docs):
    text = "\n".join(f"Line {k} of the mill's old book is ended by a stop.".ljust(80) for k in range(12))
    kept = quality_rules.keep_clean(docs([(1, text)]), max_repeat_percent=100).collect()
    assert [r["text"] for r in kept] == [text]


@pytest.mark.parametrize("line, fails", [
    ("This work is licensed under the terms below, and all rights reserved by its owners are listed there. " * 3, True),
    ("We use cookies to give you a better visit, as our cookie policy and our privacy policy say at length and in full detail, "
     "and by going on you agree to them and to all that our partners and their partners may ever do with what they learn of you.", True),
    ("The river ran past the old mill and the miller slept. " * 6 + "He did not read more. ", False),
])
def test_long_lines_are_judged_for_boilerplate(spark, line, fails):
    assert len(line) > quality_rules.BOILERPLATE_CHARS
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(F.transform(F.array("line"), lambda x: quality_rules.line_fails(x))[0]).first()[0] == fails


@pytest.mark.parametrize("line, fails", [
    ("He said that he would subscribe to the theory, and went on to read more of it.", False),
    ("They had to log in and sign up before the day was over, or so it seems.", False),
    ("The thread more or less ended there, and nobody would bread more.", False),
    ("  Subscribe to our letter and never miss a post.", True),
    ("A new mill was opened by the river today. Read more...", True),
    ("Click here.", True),
    ("This work is licensed under the terms that are given below.", True),
])
def test_chrome_counts_at_the_edges_of_short_lines(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(F.transform(F.array("line"), lambda x: quality_rules.line_fails(x))[0]).first()[0] == fails


def plain_windows(text, least=60, lone=120):
    """(first unit, units) of every window, forward and backward, once each."""
    us = re.split(r"(?:(?<=\n)|(?<=[.!?] ))(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])", text)
    n = [len(u.rstrip(" \t\n\x0b\x0c\r")) + 1 for u in us]
    out = {(k, 1) for k in range(len(us)) if n[k] >= lone}
    for k in (k for k in range(len(us)) if n[k] < lone):
        out |= set([(k, e - k) for e in range(k + 2, len(us) + 1) if sum(n[k:e]) >= least][:1])
        out |= set([(s, k + 1 - s) for s in range(k - 1, -1, -1) if sum(n[s:k + 1]) >= least][:1])
    return sorted(out)


def test_every_window_is_counted_once(spark):
    rng = random.Random(17)
    texts = ["".join("w" * rng.choice([1, 3, 10, 18, 25, 40, 70, 130]) + ". " for _ in range(rng.randint(1, 30))) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", line_dedup.windows(F.col("t")).alias("w"))
    for r in df.collect():
        assert sorted(divmod(w["at"], line_dedup.PACK) for w in r["w"]) == plain_windows(r["t"])


def test_long_texts_and_columns_named_like_working_ones(docs):
    passage = "".join(sentences(31, 6))
    long = "".join(sentences(32, 4000))
    extra = ["__id", "__TH", "__no_id", "__cut", "__k", "__text", "__at", "w"]
    given = docs([(1, long + passage), (2, passage + long[:5000]), (3, None)], extra)
    given = given.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in extra})
    cut = line_dedup.dedup_lines(given)
    assert cut.columns == given.columns
    got = {r["doc_id"]: r for r in cut.collect()}
    assert got[1]["text"] == long + passage and got[3]["text"] is None and len(got[2]["text"]) < 120
    assert all(got[k][c] == f"{c}{k}" for k in (1, 2, 3) for c in extra)


def test_shards_of_long_texts_and_columns_named_like_working_ones(docs):
    rows = [(k, f"text {k}") for k in range(40)] + [(99, "x" * 400_000), (None, None)]
    extra = ["__h", "__id", "__cell", "__size", "__uid", "c"]
    given = docs(rows, extra)
    given = given.withColumns({c: F.lit(c) for c in extra})
    got = shards.shard(given, cells_per_shard=4)
    assert got.columns == [*given.columns, "size", *[c for c in got.columns if c in ("slot", "shard")]]
    found = got.collect()
    assert all(r[c] == c for r in found for c in extra)
    assert sorted((-2**63 if r.doc_id is None else r.doc_id, r["size"], r["shard"], r["slot"]) for r in found) == \
        expected_shards(rows, 8, shards.TOLERANCE)


def test_kept_documents_keep_columns_named_like_working_ones(docs):
    text = " ".join(f"Word{k} stands here." for k in range(30))
    got = quality_rules.keep_clean(docs([(1, text), (2, "short")], ["__line_rules"]).withColumn("__line_rules", F.lit("mine"))).collect()
    assert [(r["doc_id"], r["__line_rules"]) for r in got] == [(1, "mine")]


def test_window_rows_are_the_windows_of_every_text(spark):
    r = random.Random(11)
    parts = ["a", "bcd efg", ". ", "! ", "? ", "\n", " ", "  ", "\t", "\r\n", "\x01", "é", "...", "x" * 30, "y" * 130, "long words of it " * 3, "q. ", "z\n" * 25, "m. " * 6]
    texts = ["".join(r.choice(parts if j % 3 else parts[:7] + parts[-6:]) for _ in range(r.randint(0, 40))) for j in range(400)]
    df = spark.createDataFrame(list(enumerate([*texts, None, "", "\n", " ", ". ", "\n\n", "z\n" * 70, "y" * 130 + "\nz"])), "id long, t string")
    lists = df.select(F.col("id").alias("__k"), F.explode(line_dedup.windows(F.col("t"))).alias("w")).select("__k", "w.h", "w.at")
    rows = line_dedup.window_rows(df, F.col("id"), F.col("t"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, lists.collect()))
    # also windows of over NEAR units, which are told apart
    assert rows.where(F.col("at") % line_dedup.PACK > line_dedup.NEAR).count() > 0
    # and units are cut as the pattern cuts them
    by_pattern = F.split("t", line_dedup._UNIT_ENDS)
    trimmed = F.transform(by_pattern, lambda u: F.rtrim(u, F.lit(line_dedup.SPACE_CHARS)))
    assert df.where(~line_dedup.units(F.col("t")).eqNullSafe(by_pattern) | ~line_dedup.bare_units(F.col("t")).eqNullSafe(trimmed)).count() == 0
