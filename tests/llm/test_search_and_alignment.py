"""Dual-tree search, approximation files and token alignment against brute force."""
import gc
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import lexical_search, token_alignment, va_file

WORDS = ["the", "The", "of", "and", "Été", "naïve", "日本", "x1", "q", "zeta", "rare", "mid", "low", "İ", "\x00", "end.", "a-b"]


def ranked_by_brute_force(docs, items, k):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    rows = [(i, Counter(cut(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    n, total = len(rows), sum(x[2] for x in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        mine = []
        for i, c, length in rows:
            m = 50 + (50 * length * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(cut(text)) if t in c)
            if s > 0:
                mine.append((-s, i is not None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(mine)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("block_chars, tile", [(1 << 20, 1024), (20, 7)])
def test_search_equals_brute_force(spark, docs, monkeypatch, block_chars, tile):
    monkeypatch.setattr(lexical_search, "TILE_DOCS", tile)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choices(WORDS, weights=range(len(WORDS), 0, -1), k=n))
    rows = [(i, text(rng.randint(0, 30))) for i in range(400)]
    rows += [(None, "rare zeta"), (7, "rare zeta"), (7, "rare zeta"), (500, None), (501, ""), (502, "... !"), (503, "rare " * 50_000 + "mid")]
    items = [(i, text(rng.randint(1, 12))) for i in range(40)]
    items += [(3, "other text zeta"), items[5], items[5], (90, None), (91, ""), (92, "unseen words"), (None, "rare")]
    got = lexical_search.search(docs(rows, ["tf", "n", "numbers", "score"]), spark.createDataFrame(
        [(i, t, "x", 1) for i, t in items], "item_id long, text string, terms string, rank int"), k=6, block_chars=block_chars)
    assert Counter(map(tuple, got.collect())) == ranked_by_brute_force(rows, items, 6)


def test_search_of_empty_tables(docs):
    items = docs([(1, "a b")]).withColumnRenamed("doc_id", "item_id")
    assert lexical_search.search(docs([]), items).collect() == []
    assert lexical_search.search(docs([(1, "a")]), items.limit(0)).collect() == []
    assert lexical_search.search(docs([(1, None)]), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_tree_leaves_out_documents_of_other_terms():
    """Documents of one matter stand together, and tiles' nodes of other matters are dropped."""
    rng = np.random.default_rng(2)
    starts = np.arange(0, 1024 * 10 + 1, 10)
    numbers = np.concatenate([np.sort(rng.choice(np.arange(40), 10, replace=False)) + 40 * (d % 16) for d in range(1024)])
    items = [np.sort(rng.choice(np.arange(40), 8, replace=False)) + 40 * (k % 16) for k in range(64)]
    tree = lexical_search.ItemTree(items, np.full(640, 1000, np.int64))
    best = lexical_search.Best(64, 5, np.zeros(64, np.int64))
    told = lexical_search.search_tile(tree, best, np.arange(1024), starts, numbers, np.full(len(numbers), 400_000))
    assert told["scored"] < 64 * 1024 / 8
    for t, (scores, ids) in zip(items, best.rows):
        whole = np.array([np.isin(numbers[a:b], t).sum() for a, b in zip(starts, starts[1:])]) * 400_000_000
        order = np.lexsort((np.arange(1024), -whole))[:5]
        assert scores.tolist() == whole[order].tolist() and ids.tolist() == order.tolist()


def best_by_brute_force(rows, asks, k, most=(1 << 63) - 1):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in v) else tuple(math.floor(256 * x) for x in v)
    rows = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = []
    for q, w in dict.fromkeys((i, w) for i, v in asks if i is not None and (w := whole(v)) is not None):
        mine = sorted((-max(-most - 1, min(most, sum(a * b for a, b in zip(w, v)))), i) for i, v in rows if i != q and len(v) == len(w))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(mine, 1)]
    return Counter(out)


@pytest.mark.parametrize("spread, dim, block_values", [(0.12, 16, 1 << 24), (0.12, 16, 500), (3000.0, 5, 300)])
def test_top_k_equals_brute_force(spark, spread, dim, block_values):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(dim) * spread).tolist()) for i in range(300)]
    hot = rows[4][1]
    rows += [(1000 + i, hot) for i in range(150)] + [(50, hot)] * 9 + [(60, rows[3][1]), (60, rows[2][1]), (60, rows[2][1])]
    rows += [(None, hot), (700, None), (701, [0.0] * dim), (702, [-0.0] * dim), (703, []), (704, []), (705, [1.0]), (706, [None] * dim),
             (707, [float("nan")] * dim), (708, [float("inf")] * dim), (709, [1e308] * dim)]
    asks = [r for r in rows if r[0] is None or r[0] % 10 == 0] + [rows[0]] + [r for r in rows if r[0] in (701, 703, 705)]
    schema = "vec_id long, embedding array<double>, id string, mark string, block int"
    frame = lambda x: spark.createDataFrame([(*r, "x", "y", 1) for r in x], schema)
    got = va_file.top_k(frame(rows), frame(asks), block_values=block_values)
    assert Counter(map(tuple, got.collect())) == best_by_brute_force(rows, asks, 5)
    assert va_file.top_k(frame(rows).limit(0), frame(asks)).collect() == [] == va_file.top_k(frame(rows), frame(asks).limit(0)).collect()


def test_top_k_beyond_exact_doubles(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(4) * 10.0 ** (i % 12)).tolist()) for i in range(60)]
    got = va_file.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), spark.createDataFrame(rows[::7], "vec_id long, embedding array<double>"))
    assert Counter(map(tuple, got.collect())) == best_by_brute_force(rows, rows[::7], 5)


def test_bounds_leave_few_vectors_to_read():
    rng = np.random.default_rng(6)
    vectors = np.floor(rng.standard_normal((20_000, 64)) * 32).astype(np.int32)
    file = va_file.ApproximationFile(np.arange(20_000), np.arange(20_000), vectors, 5)
    left = [len(rows) for rows, _ in file._candidates(vectors[:50].astype(np.float64))]
    assert max(left) < 20_000 / 20


def aligned_by_brute_force(rows):
    """Each text by the whole libraries, links pair by pair."""
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    out, held = [], defaultdict(set)
    for k, (i, text) in enumerate(rows):
        a, links, groups = [], Counter(), []
        if text:
            a = [(t, bytes(letters[c] for c in tok.id_to_token(t))) for t in tok.encode(" " + text, add_special_tokens=False).ids]
            b = [(t, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and sp.is_byte(t) else p.replace("▁", " ").encode())
                 for t in sp.encode(text) for p in [sp.id_to_piece(t)]]
            if not b"".join(x for _, x in a) == (" " + text).encode() == b"".join(x for _, x in b):
                a = []
        if not a:
            out.append((i, 0, 0, 0, Counter(), ""))
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for t, x in side:
                own.append((t, at, at + len(x)))
                at += len(x)
            spans.append(own)
        for t, lo, hi in spans[0]:
            for u, lo2, hi2 in spans[1]:
                if lo < hi2 and lo2 < hi:
                    links[t, u] += 1
                    held[t, u].add(k)
        start = 0
        for end in sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]}):
            groups.append("|".join(",".join(str(t) for t, lo, _ in own if start <= lo < end) for own in spans))
            start = end
        out.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (t, _), ks in held.items():
        best[t] = max(best[t], len(ks))
    return Counter((i, na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if len(held[p]) == best[p[0]]),
                    sum(n * len(held[p]) for p, n in links.items()), sha) for i, na, nb, ng, links, sha in out)


PIECES = [" ", "  ", "a", "B", "\n", "é", "é", "ﬁ", "Hello", "\t", "<|endoftext|>", "<s>", "。", "　", " x", "the", "\x00", "1", "234", "'s",
          "'", "İ", "\x1c", "\x85", "Word.", "#", "日本", "😀", "ing", "tion", "<0x0A>", "\U00012000"]
ALIGN = (P.path("byte_bpe_50k.json"), P.PATTERN, P.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("block", [1 << 22, 200])
def test_alignment_equals_brute_force(docs, monkeypatch, block):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", block)
    rng = random.Random(8)
    rows = [(i, "".join(rng.choices(PIECES, k=rng.randint(0, 30)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " "), (203, "   "), (204, "a ▁ mark"), (None, "the x"), (205, "the x"), (205, "the x"), (206, "long text 😀 " * 60)]
    got = token_alignment.align(docs(rows, ["block", "pairs", "n_a", "held"]), *ALIGN)
    assert Counter(map(tuple, got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())) == aligned_by_brute_force(rows)


def test_alignment_of_an_empty_table_and_a_very_long_text(docs):
    assert token_alignment.align(docs([]), *ALIGN).collect() == []
    text = "some words of a long text, and ünïcode 日本語 too. " * 30_000
    row = token_alignment.align(docs([(1, text)]), *ALIGN).first()
    a = Tokenizer.from_file(ALIGN[0]).encode(" " + text, add_special_tokens=False).ids
    assert row["n_a"] == len(a) and row["n_best"] <= row["n_links"] == row["count_sum"] == row["n_a"] + row["n_b"] - row["n_groups"]
    # every pair is in the one document, so all are their first id's best
    assert row["n_best"] == row["n_links"]


def test_blocks_are_aligned_with_the_collector_paused():
    seen = []

    class Side:
        bytes = [b""]

        def tokens(self, texts):
            seen.append(gc.isenabled())
            return [None] * len(texts)

    assert token_alignment._aligned_rows(0, [1, 2], ["a", "b"], Side(), Side()).num_rows == 3
    assert seen == [False, False] and gc.isenabled()
