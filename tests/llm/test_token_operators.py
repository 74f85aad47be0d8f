"""Token counts, merge replay, token store and packing against the libraries."""
import array
import gc
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from strata.llm import byte_bpe, packing, token_counts, token_store, vocab

PIECES = [" ", "  ", "a", "B", "▁", "\n", "é", "é", "ﬁ", "Hello", "\t", "<|endoftext|>", "<s>", "。", "　", " x", "the", "\x00",
          "1", "234", "'s", "'", "İ", "Σ", "\x1c", "\x85", "Word.", "ß", "#", "日本", "😀", "ing", "tion"]


def texts(n, seed=1, most=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, most))) for _ in range(n)]


ROWS = [*enumerate(texts(200)), (500, None), (501, ""), (502, "long text " * 20_000), (None, "no id"), (700, "again"), (700, "again")]


def test_segment_counts_add_up():
    model = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ts = texts(3000)
    counter = token_counts.SegmentCounter(lambda b: [len(x) for x in sp.encode(b, num_threads=1)], entries=50, batch_bytes=64)
    got = [c for lo in range(0, len(ts), 100) for c in counter.counts(ts[lo:lo + 100])]
    assert got == [len(x) for x in sp.encode(ts, num_threads=1)]


def test_token_counts(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = token_counts.count_tokens(docs(ROWS, ["n_tokens"]), P.path("piece_bpe_32k.model")).collect()
    want = [(i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in ROWS]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("name, make", [("byte_bpe_50k.json", lambda p: vocab.ByteLevelIds(p, P.PATTERN)), ("word_bpe_49k.json", vocab.SpacedWordIds)])
def test_remembered_words_equal_the_library(name, make):
    ts, ids = texts(2000, 2), make(P.path(name))
    tok = Tokenizer.from_file(P.path(name))
    assert ids(ts) == [array.array("I", e.ids).tobytes() for e in tok.encode_batch(ts, add_special_tokens=False)]


def test_merge_replay_equals_tiktoken():
    bpe = byte_bpe.ByteBpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.replay.ranks, special_tokens={})
    ts = texts(2000, 3) + ["".join(random.Random(k).choices("abcdefghijklmnop", k=60)) for k in range(500)]
    got = bpe.encode(ts)
    assert [list(array.array("I", g)) for g in got] == [enc.encode_ordinary(t) for t in ts]
    assert [bpe.decode(array.array("I", g)) for g in got] == [t.encode() for t in ts]


def test_replay_finishes_a_word_whose_merge_makes_a_lower_rank():
    # aba (rank 300) is older than ab (rank 301): merging ab must be followed by aba at once
    ranks = {bytes([b]): b for b in range(256)} | {b"aba": 300, b"ab": 301}
    replay = byte_bpe.MergeReplay(ranks)
    assert replay.encode_words(["ababx", "abx", "aba", "xababab"]) == [[300, 98, 120], [301, 120], [300], [120, 300, 98, 301]]


def test_replay_of_touching_places_equals_tiktoken():
    # few letters: runs, places of one rank side by side, ranks that two cuts share
    replay = byte_bpe.byte_bpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).replay
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=replay.ranks, special_tokens={})
    rng = random.Random(8)
    ws = ["".join(rng.choices("abanéあ=.- 0\n", k=rng.randint(1, 40))) for _ in range(5000)] + ["a" * 3000, "=" * 999]
    want = [enc._core_bpe.encode_single_piece(w.encode()) for w in ws]
    assert replay.encode_words(ws) == want
    assert [replay.encode_word(w.encode()) for w in ws[:300]] == want[:300]
    assert replay.encode_words([]) == []


def test_byte_bpe_round_trip(docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    got = byte_bpe.round_trip(docs(ROWS), path, P.PATTERN).collect()
    assert len(got) == len(ROWS) and sorted(bytes(r["decoded"]) for r in got) == sorted((t or "").encode() for _, t in ROWS)
    one = next(r for r in got if r["doc_id"] == 502)
    bpe = byte_bpe.byte_bpe(path, P.PATTERN)
    ids = array.array("I", bpe.encode([dict(ROWS)[502]])[0])
    assert one["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and one["n_tokens"] == len(ids)
    encoded = byte_bpe.encode(docs(ROWS[:5]), path, P.PATTERN)
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in byte_bpe.decode(encoded, path, P.PATTERN).collect()} == dict(ROWS[:5])


def test_segments_give_any_token():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 2**32, 3000, dtype=np.uint32) >> rng.integers(0, 32, 3000, dtype=np.uint32), np.zeros(5, np.uint32), np.zeros(0, np.uint32)):
        cut = len(ids) // 2
        s = token_store.Segment(token_store.pack_segment([7, None], [cut, len(ids) - cut], ids))
        assert s.ids().tolist() == ids.tolist() == [s.token(i) for i in range(len(ids))]
        assert s.doc_ids == [7, None] and s.starts.tolist() == [0, cut, len(ids)]
    with pytest.raises(IndexError):
        s.token(0)


def test_token_store_reads_back_in_order(docs):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [r for r in ROWS if r[0] is not None]
    got = token_store.read_tokens(token_store.write_tokens(docs(rows, ["part"]), P.path("byte_bpe_50k.json"), P.PATTERN)).collect()
    want, at = [], 0
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], np.uint32)
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got)) == sorted(want)
    assert token_store.read_tokens(token_store.write_tokens(docs([]), P.path("byte_bpe_50k.json"), P.PATTERN)).count() == 0


def check_pieces(rows, pieces, window):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        mine = sorted(by_doc[i], key=lambda p: p["start"])
        assert b"".join(bytes(p["ids"]) for p in mine) == ids.tobytes()
        assert [p["start"] for p in mine] == [0, *np.cumsum([p["length"] for p in mine])[:-1].tolist()]
        assert {p["doc_tokens"] for p in mine} == {len(ids)}
    for s in by_sequence.values():
        s.sort(key=lambda p: p["offset"])
        lengths = [p["length"] for p in s]
        assert [p["offset"] for p in s] == [0, *np.cumsum(lengths)[:-1].tolist()]
        assert sum(lengths) <= window and sum(lengths) & (sum(lengths) - 1) == 0


def test_packing_places_every_id_once(docs):
    rows = [(i, t) for i, t in {i: t for i, t in ROWS}.items()]
    df = docs(rows, ["k1", "ids"])
    check_pieces(rows, packing.pack(df, P.path("word_bpe_49k.json"), window=64, shard_tokens=500).collect(), 64)
    assert packing.pack(docs([]), P.path("word_bpe_49k.json")).count() == 0


def test_packing_prefers_lexical_neighbours():
    rng = np.random.default_rng(2)
    topics = [rng.integers(1000 * k, 1000 * k + 50, (20, 31)).astype("<u4") for k in range(1, 5)]
    documents = [np.append(topics[i % 4][i // 4], 2).astype("<u4") for i in range(80)]
    df = {}
    for d in documents:
        for t in set(d[:-1].tolist()):
            df[t] = df.get(t, 0) + 1
    filler = packing.WindowFiller(packing.TermWeights(df, 80, 80 * 31), window=128)
    windows = {}
    for name, _, _, _, sequence, _ in filler.pack(list(range(80)), documents):
        windows.setdefault(sequence, set()).add(name % 4)
    assert np.mean([len(w) for w in windows.values()]) < 1.5


def test_packing_ranks_by_all_tokens_of_the_seed():
    rng = np.random.default_rng(6)
    documents = [np.append(rng.choice(400, rng.integers(40, 120)), 2).astype("<u4") for _ in range(60)]
    df = {}
    for d in documents:
        for t in set(d[:-1].tolist()):
            df[t] = df.get(t, 0) + 1
    weights = packing.TermWeights(df, 60, sum(len(d) - 1 for d in documents))
    index = packing.ShardIndex(documents, weights)
    held = [dict(zip(*(x.tolist() for x in weights.of(d)))) for d in documents]
    for seed in range(60):
        score = [sum(w for t, w in h.items() if t in held[seed]) for h in held]
        got = list(index.neighbours(index.queries[seed], np.arange(60) != seed))
        assert sorted(got) == [k for k in range(60) if k != seed]
        assert np.all(np.diff([score[k] for k in got]) <= 1e-9)


@pytest.mark.parametrize("side", ["byte level", "spaced words"])
def test_encoders_pause_the_collector(side):
    seen = []
    if side == "byte level":
        encoder = vocab.ByteLevelIds(P.path("byte_bpe_50k.json"), P.PATTERN)
        keep = encoder.find
        encoder.find = lambda t: seen.append(gc.isenabled()) or keep(t)
    else:
        encoder = vocab.SpacedWordIds(P.path("word_bpe_49k.json"))
        keep = encoder.odd_letter
        encoder.odd_letter = lambda t: seen.append(gc.isenabled()) or keep(t)
    assert len(encoder(["some plain words", "others"])) == 2
    assert seen and not any(seen) and gc.isenabled()


def test_term_weights_count_documents_once(docs):
    rows = [(k, t) for k, t in enumerate([*texts(60, seed=9), "word word word", "", None])]
    tokens = packing.tokenize(docs(rows), P.path("word_bpe_49k.json"))
    weights = packing.term_weights(tokens)
    held = [packing._ids(r["ids"])[:-1].tolist() for r in tokens.select("ids").collect()]
    df = {t: sum(t in h for h in held) for t in set(sum(held, []))}
    assert weights.mean == sum(map(len, held)) / len(held)
    assert {t: w for t, w in enumerate(weights.idf.tolist()) if w} == {
        t: pytest.approx(float(np.log1p((len(held) - n + 0.5) / (n + 0.5)))) for t, n in df.items()}
