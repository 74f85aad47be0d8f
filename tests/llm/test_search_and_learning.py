"""Jaccard join, nearest neighbours, classifier and pipeline against brute force."""
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import ann, jaccard_join, line_dedup, packing, quality_rules, rule_classifier
from strata.llm.common import table
from strata.llm.word_hashes import word_hashes


def components(rows):
    """(id, set size, smallest linked id) by comparing all pairs that share a shingle."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for k, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for o in held[x]:
                shared[o] += 1
            held[x].append(k)
        for o, m in shared.items():
            if 100 * m >= 80 * (len(s) + len(sets[o]) - m):
                parent[find(k)] = find(o)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((-1 if i is None else i, len(sets[k]), least.get(find(k), -1)) for k, (i, _) in enumerate(rows))


def joined(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                  for r in jaccard_join.join(df).collect())


def near_copies(seed, n):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    common = [f"c{k}" for k in range(60)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w))
    # the passage that unrelated texts share
    return out + [" ".join([f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 200))] + common) for _ in range(n)]


def test_jaccard_components_equal_brute_force(docs, monkeypatch):
    base = " ".join(f"word{k}" for k in range(40))
    rows = [(1, base), (2, base.upper()), (3, base + " zz"), (4, None), (5, ""), (6, "a b"), (7, "A  B"), (None, "a b"), (None, "lone text"),
            (8, "q " * 5000), (9, base.replace("word20", "x")), (1, base), (10, "\x1ca b c d\x1c")]
    rows += [(100 + k, t) for k, t in enumerate(near_copies(3, 60))]
    assert joined(docs(rows, ["cls", "n", "th"])) == components(rows)
    assert joined(docs([])) == []


def test_buckets_cut_into_blocks_find_the_same_pairs(docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rows = [(k, t) for k, t in enumerate(near_copies(5, 40))]
    assert joined(docs(rows)) == components(rows)


def test_tree_finds_every_linked_pair():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        base = np.unique(rng.integers(0, 2**63, 150).astype(np.uint64))
        for _ in range(5):
            sets.append(np.unique(np.concatenate([rng.permutation(base)[:140], rng.integers(0, 2**63, 5).astype(np.uint64)])))
    points = np.stack([jaccard_join.count_vector(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    order = rng.permutation(len(sets))
    cls = np.arange(len(sets))[order]
    a, b = jaccard_join._block_pairs(cls, cls, sizes[order], points[order], np.full(len(sets), 2))
    found = set(zip(a.tolist(), b.tolist()))
    true = {(i, j) for i in range(len(sets)) for j in range(i) if jaccard_join.linked(sets[i], sets[j])}
    assert {(j, i) for i, j in true} <= found
    assert len(found) < 0.2 * len(sets) ** 2 / 2


def test_one_row_of_each_group_stays(docs):
    base = " ".join(f"word{k}" for k in range(40))
    rows = [(5, base), (2, base + " more"), (2, base + " more"), (None, base), (7, None), (7, ""), (8, "other text of its own here")]
    kept = sorted(((r.doc_id or 0), r.text or "") for r in jaccard_join.keep_one(docs(rows, ["at"])).collect())
    assert kept == [(2, base + " more"), (7, ""), (7, ""), (8, "other text of its own here")]


def test_kept_rows_keep_columns_named_like_working_ones(docs):
    base = " ".join(f"word{k}" for k in range(40))
    extra = ["__id", "__th", "__no_id", "at", "cls"]
    given = docs([(5, base), (2, base + " more"), (2, base + " more"), (7, None)], extra).withColumns({c: F.lit(c) for c in extra})
    kept = jaccard_join.keep_one(given)
    assert kept.columns == given.columns
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[0]) == [(2, base + " more", *extra), (7, None, *extra)]


def nearest(ids, vectors, i, k=10):
    d = np.sqrt(((vectors - vectors[i]) ** 2).sum(1))
    return [int(ids[j]) for j in np.lexsort((ids, d)) if j != i][:k]


def test_neighbours_reach_the_recall(spark):
    path = "/root/testdata/sf0.01"
    base = table(spark, path, "embeddings")
    pdf = pd.read_parquet(f"{path}/embeddings.parquet")
    ids, vectors = pdf.vec_id.to_numpy(), np.array(pdf.embedding.tolist(), float)
    got = ann.nearest(base, base.where("vec_id % 20 = 0"), block_rows=200, query_rows=10).toPandas()
    hits = total = 0
    for q, g in got.groupby("query_id"):
        i = int(np.flatnonzero(ids == q)[0])
        hits += len(set(g.vec_id) & set(nearest(ids, vectors, i)))
        total += 10
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 11)) and (g.score.diff().dropna() >= 0).all()
        exact = [np.sqrt(((vectors[ids == v][0] - vectors[i]) ** 2).sum()) for v in g.vec_id]
        assert np.allclose(g.score, exact, rtol=0, atol=1e-12)
    assert total == 10 * (ids % 20 == 0).sum() and hits / total >= 0.95


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (None, [1.0, 1.0], "x"), (3, None, "x"), (4, [0.0, 0.0], "x"), (5, [nan, 1.0], "x"),
         (6, [None, 1.0], "x"), (7, [1.0], "x"), (8, [2.0, 0.0], "x"), (9, [], "x"), (10, [inf, 1.0], "x")], "vec_id long, embedding array<double>, rank string")
    got = sorted(map(tuple, ann.nearest(df, df).collect()))
    assert got == [(1, 1, 2, 0.0), (1, 2, 8, 1.0), (2, 1, 1, 0.0), (2, 2, 8, 1.0), (8, 1, 1, 1.0), (8, 2, 2, 1.0)]
    assert ann.nearest(df.limit(0), df).count() == 0


@pytest.mark.parametrize("power", [0, 660, -660, 1000, -1040])
def test_distances_of_huge_and_tiny_components(spark, power):
    rng = np.random.default_rng(6)
    # few digits, so that even the smallest scale keeps them all
    small = rng.integers(-400, 400, (60, 4)).astype(float)
    rows = [(k, [float(np.ldexp(x, power)) for x in v]) for k, v in enumerate(small)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id % 10 = 0"), block_rows=20).collect()
    assert len(got) == 60
    for q in range(0, 60, 10):
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        want = nearest(np.arange(60), small, q)
        assert [v for _, v, _ in mine] == want
        assert [d for _, _, d in mine] == [float(np.ldexp(np.sqrt(((small[v] - small[q]) ** 2).sum()), power)) for v in want]


def test_neighbours_over_all_magnitudes(spark):
    rows = [(1, [1.7e308, 0.0]), (2, [-1.7e308, 0.0]), (3, [1e-310, 1e-310]), (4, [1.0, 0.0]), (5, [2.0, 0.0]), (6, [1.6e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.nearest(df, df).collect()}
    assert len(got) == 30
    assert got[4, 1][0] == 3 and got[4, 2] == (5, 1.0) and got[1, 1] == (6, 1.7e308 - 1.6e308) and got[1, 5] == (2, float("inf"))


def test_neighbours_of_long_vectors(spark):
    base = spark.createDataFrame([(k, [float(k + j % 3) for j in range(5000)]) for k in range(12)], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ann.nearest(base, base.where("vec_id = 0"), neighbours=2).collect()))
    assert got == [(0, 1, 1, 5000 ** 0.5), (0, 2, 2, 2 * 5000 ** 0.5)]


def test_many_equal_vectors_go_to_the_smallest_ids(spark):
    df = spark.createDataFrame([(k, [1.0, 2.0, 3.0]) for k in range(500)] + [(900, [1.0, 2.0, 2.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.vec_id for r in ann.nearest(df, df.where("vec_id in (0, 300)"), block_rows=100).collect()}
    assert [got[0, k] for k in range(1, 11)] == list(range(1, 11))
    assert [got[300, k] for k in range(1, 11)] == list(range(10))


def test_classifier_separates_held_out_labels(spark):
    path = "/root/testdata/sf0.01"
    got = rule_classifier.classify(table(spark, path, "documents"), table(spark, path, "labels")).toPandas()
    both = got.merge(pd.read_parquet(f"{path}/labels.parquet"), on="doc_id")
    held = both[both.held_out]
    good, bad = held.score[held.quality == 1].to_numpy(), held.score[held.quality == 0].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.95 and (held.predicted == held.quality).mean() > 0.95
    assert len(got) == 1000 and got.score.between(0, 1).all()


def plain_statistics(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars = len(w), len("".join(w))

    def per(a, b):
        return a / b if b else 0.0

    return {"n_words": float(n), "word_length": per(chars, n), "distinct_words": per(len(set(w)), n),
            "symbols": per(len(re.findall(r"[#*$%&|<>]", t)), n), "capitals": per(len(re.findall("[A-Z]", t)), chars),
            "digits": per(len(re.findall("[0-9]", t)), chars), "marks": per(len(re.findall("[.,;:!?]", t)), n),
            "doubled_marks": per(len(re.findall(r"!!|\?\?", t)), n), "distinct_lines": per(len(set(lines)), len(lines)),
            "words_a_line": per(n, len(lines))}


def test_scores_equal_the_fitted_rules_by_brute_force(spark, docs, monkeypatch):
    path = "/root/testdata/sf0.01"
    models, trained, fit = [], [], rule_classifier.fit

    def spied(rows):
        trained.extend(r[0] for r in rows.select("doc_id").collect())
        models.append(fit(rows))
        return models[-1]

    monkeypatch.setattr(rule_classifier, "fit", spied)
    real = table(spark, path, "documents").select("doc_id", "text")
    odd = docs([(10**9, None), (10**9 + 1, ""), (10**9 + 2, "word! " * 100_000), (None, "A #1 text!! of\ntwo lines??")])
    given = real.unionByName(odd)
    got = rule_classifier.classify(given, table(spark, path, "labels")).toPandas()
    texts = given.toPandas()
    (model,) = models
    assert model.rules and len(got) == len(texts)
    want = []
    for i, t in zip(texts.doc_id, texts.text):
        s = plain_statistics(t if isinstance(t, str) else None)
        total = model.bias + sum(w for rule, w in model.rules if all((s[c.statistic] > c.bound) == c.above for c in rule))
        held = pd.isna(i) or zlib.crc32(str(int(i)).encode()) % 5 == 0
        want.append((-1 if pd.isna(i) else int(i), bool(held), 1 / (1 + math.exp(-total))))
    found = sorted((-1 if pd.isna(r.doc_id) else int(r.doc_id), bool(r.held_out), r.score, r.predicted) for r in got.itertuples())
    for (i, held, score), (j, h, found_score, predicted) in zip(sorted(want), found):
        assert (i, held) == (j, h) and abs(score - found_score) < 1e-9 and predicted == int(found_score >= 0.3)
    assert trained and all(zlib.crc32(str(i).encode()) % 5 for i in trained)


def test_classifier_on_odd_rows(spark, docs):
    rows = docs([(1, None), (2, ""), (None, "text here"), (3, "plain words. " * 50), (3, "plain words. " * 50)], ["label", "score"])
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    got = rule_classifier.classify(rows, none).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.5}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]
    assert rule_classifier.classify(rows.limit(0), none).count() == 0


def test_statistics_are_of_the_whole_text(spark):
    text = "Ab cd, ab!!\nAb cd, ab!!\n\nX 12 #"
    s = spark.createDataFrame([(text,), (None,)], "t string").select(rule_classifier.statistics(F.col("t")).alias("s")).collect()
    got = s[0]["s"].asDict()
    assert got["n_words"] == 9 and got["distinct_words"] == 6 / 9 and got["symbols"] == 1 / 9 and got["distinct_lines"] == 2 / 3
    assert got["marks"] == 6 / 9 and got["doubled_marks"] == 2 / 9 and got["words_a_line"] == 3
    assert set(s[1]["s"].asDict().values()) == {0.0}


def test_pipeline_equals_its_stages_by_brute_force(spark):
    path = "/root/testdata/sf0.001"
    source = table(spark, path, "documents")
    outs, docs = [], source
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        outs.append(docs.toPandas())
        docs = spark.createDataFrame(outs[-1], docs.schema) if len(outs) < 5 else docs
    assert all(list(o.columns) == source.columns for o in outs[:4])
    judged = quality_rules.apply_line_rules(source).select("doc_id", "cleaning.*").toPandas()
    assert sorted(outs[0].doc_id) == sorted(judged.doc_id[judged.kept])
    labels = pd.read_parquet(f"{path}/labels.parquet")
    good = set(labels.doc_id[labels.quality == 1])
    # clean documents that the rules keep stay in the classifier's stage
    assert len(good & set(outs[0].doc_id) - set(outs[1].doc_id)) <= 0.02 * len(good)
    cleaned = line_dedup.dedup_lines(spark.createDataFrame(outs[1], source.schema)).toPandas()
    assert sorted(outs[2].text) == sorted(t for t in cleaned.text if t.strip())
    groups = components(list(zip(outs[2].doc_id.tolist(), outs[2].text)))
    assert sorted(outs[3].doc_id) == sorted({least for _, _, least in groups})
    assert set(outs[4].doc_id) == set(outs[3].doc_id)
    whole = corpus_pipeline.run(spark, path).toPandas()
    columns = ["doc_id", "start", "length", "doc_tokens"]
    assert whole.groupby("doc_id").length.sum().to_dict() == outs[4].groupby("doc_id").length.sum().to_dict()
    assert set(columns) <= set(whole.columns)


@pytest.mark.parametrize("stage", range(5))
def test_stages_pass_an_empty_table(spark, stage):
    path = "/root/testdata/sf0.001"
    empty = table(spark, path, "documents").limit(0)
    out = corpus_pipeline.STAGES[stage][1](spark, empty, path)
    assert out.count() == 0


@pytest.mark.parametrize("members", [512, 7])
def test_link_counts_equal_brute_force(docs, monkeypatch, members):
    monkeypatch.setattr(jaccard_join, "MEMBERS", members)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 50)
    base = " ".join(f"word{k}" for k in range(40))
    rows = [(1, base), (2, base.upper()), (3, base + " zz"), (3, base + " zz"), (4, None), (None, base + " yy"), (6, "a b")]
    rows += [(100 + k, t) for k, t in enumerate(near_copies(8, 40))]
    sets = {t: frozenset(jaccard_join.shingle_set(t).tolist()) for _, t in rows}
    classes = set(sets.values()) - {frozenset()}
    want = {s: sum(s != o and 100 * len(s & o) >= 80 * len(s | o) for o in classes) for s in classes}
    got = jaccard_join.join(docs(rows)).collect()
    assert max(want.values()) > 5
    assert sorted((r.doc_id or 0, r.class_links) for r in got) == sorted((i or 0, want.get(sets[t], 0)) for i, t in rows)


def test_full_counts_rule_no_pair_out():
    points = np.full((2, jaccard_join.GROUPS), 0xFFFF, np.uint16)
    points[1, 1:] -= 5
    sizes = np.array([20_000_000, 20_000_000])
    none = np.zeros(2, np.int64)
    a, b = jaccard_join._block_pairs(np.arange(2), np.arange(2), sizes, points, np.full(2, 2))
    assert (0, 1) in set(zip(a.tolist(), b.tolist()))
    col = {"cls": np.arange(2), "comp": np.arange(2), "n": sizes, "side": np.full(2, 2), "h": none, "i": none, "j": none}
    a, b = jaccard_join._bucket_pairs(col, points)
    assert list(zip(a.tolist(), b.tolist())) == [(0, 1)]


def test_repeated_query_rows_are_one_query(spark):
    schema = "vec_id long, embedding array<double>"
    base = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(1, 40)], schema)
    asked = spark.createDataFrame([(1, [0.0, 1.0]), (1, [-0.0, 1.0]), (1, [0.0, 1.0]), (100, [30.0, 1.0]), (100, [5.0, 1.0])], schema)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(base, asked, block_rows=10, query_rows=2).collect())
    assert [g[1:] for g in got if g[0] == 1] == [(k, k + 1) for k in range(1, 11)]
    assert sorted(r for i, r, _ in got if i == 100) == sorted([*range(1, 11)] * 2)
    assert {(1, 30), (1, 5)} == {(r, v) for i, r, v in got if i == 100 and r == 1}


def test_index_scores_equal_bm25_as_documents_are_used_up(monkeypatch):
    rng = np.random.default_rng(5)
    documents = [np.append(rng.integers(0, 40 if k % 2 else 3000, rng.integers(0, 60)), 2).astype(np.uint32) for k in range(120)]
    held = [set(d[:-1].tolist()) for d in documents]
    df = {t: sum(t in h for h in held) for h in held for t in h}
    weights = packing.TermWeights(df, len(documents), sum(len(d) - 1 for d in documents))
    for share in (0.0, 0.2, 2.0):
        monkeypatch.setattr(packing, "COMMON", share)
        index, unused = packing.ShardIndex(documents, weights), np.ones(len(documents), bool)
        for seed in (0, 1, 7, 30, 60, 119):
            want = np.zeros(len(documents))
            for k in np.flatnonzero(unused):
                for t, w in zip(*weights.of(documents[k])):
                    want[k] += w * (t in held[seed])
            got = list(index.neighbours(index.queries[seed], unused))
            assert sorted(got) == np.flatnonzero(unused).tolist()
            assert np.all(np.diff(want[got]) <= 1e-4 * want.max(initial=1))
            unused[got[:25]] = False


def test_word_hashes_are_those_of_the_library():
    rng = random.Random(2)
    letters = [x for x in range(256) if x not in b" \t\n\x0b\x0c\r"]
    texts = [rng.choice([b" ", b"\n\t"]).join(bytes(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(rng.randrange(60))) for _ in range(80)]
    texts += [b"", b"  a\r\n", b"x"]
    h, cuts = word_hashes(texts)
    assert [h[i:j].tolist() for i, j in zip(cuts, cuts[1:])] == [[xxhash.xxh3_64_intdigest(w) for w in t.split()] for t in texts]


def test_packed_counts_come_back():
    points = [np.arange(jaccard_join.GROUPS, dtype=np.uint16) % m * k for m, k in ((16, 1), (256, 1), (256, 257), (2, 0xFFFF))]
    packed = list(map(jaccard_join.packed_counts, points))
    assert list(map(len, packed)) == [128, 256, 512, 512]
    assert np.array_equal(jaccard_join.unpacked_counts(packed), points)


def test_a_forest_connects_what_its_pairs_do():
    rng = np.random.default_rng(9)
    for n in (0, 1, 30, 400):
        a, b = rng.integers(-300, 300, (2, n))
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            lo, hi = sorted((find(x), find(y)))
            parent[hi] = lo
        roots, others = jaccard_join.forest(a, b)
        assert sorted(zip(others.tolist(), roots.tolist())) == sorted((x, find(x)) for x in list(parent) if find(x) != x)


def test_pairs_of_near_copies_stay_in_their_task(docs, monkeypatch):
    sent = {}
    keep = jaccard_join.stored

    def seen(df, name):
        out = keep(df, name)
        sent[name] = max(out.count(), sent.get(name, 0))
        return out

    monkeypatch.setattr(jaccard_join, "stored", seen)
    rows = [(k, t) for k, t in enumerate(near_copies(6, 120)[:120])]
    jaccard_join.join(docs(rows)).collect()
    # each task sends a forest: fewer rows than classes, where pairs were their square
    width = jaccard_join.input_partitions(docs(rows))
    assert sent["join-forest"] < 120 * width and sent["join-links"] < 2 * 120
