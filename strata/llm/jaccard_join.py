"""N-gram Jaccard join over count vectors, exact for Jaccard >= 0.8 on 5-word shingles.

A document is the set of 64-bit hashes of its shingles; documents with equal sets are one
*class*, whatever their number. Classes are joined like this:

1. *Buckets.* Two sets with Jaccard >= 0.8 share one of their first ``0.2 n + 1`` shingles
   in any common order. The order puts shingles that many documents hold last (a list
   bounded by mean set size / ``HOT_SHARE``, found from local counts), then goes by hash.
   A bucket is the classes that hold one shingle in front. This only says which points
   have to meet; it loses no link.
2. *Count-vector tree.* Shingles are hashed into ``GROUPS`` groups; a class's counts by
   group are a point. The points of a bucket are the leaves of an R-tree (nodes with corner
   vectors and size bounds); pairs of nodes, then of points, survive only if the summed
   coordinate minima, an upper bound of the overlap, reach the overlap that the sizes ask for.
3. *Neighbourhoods.* Surviving pairs never leave their task: it sends a forest that connects
   what they connect, at most one row a point. The buckets of the three first shingles go
   ahead, then those that still hold several trees. What the forests connect is a
   neighbourhood; both ends of any link lie in one.
4. *Verification.* The sets of a neighbourhood's classes meet, each with all others, in block
   pairs of ``MEMBERS`` classes a side (matrix products over the shingles that several
   members hold). That decides every link: block pairs send each class's number of links,
   and a forest of them, which gives the components. The products grow with the square of a
   neighbourhood's classes, as its links do; what is shuffled does not.

Buckets of more than ``BLOCK`` rows are cut into blocks whose pairs are tasks of their own,
so no bucket has to fit a task. Components come from label propagation with pointer
jumping over stored tables. The driver holds the hot list and counts, nothing else.

Defined cases: null text has no words, like an empty one: an empty set, linked with
nothing; fewer than five words are one shingle; rows without an id link by their text, and
their component is the smallest id in it, null if there is none; repeated rows are copies;
an empty table gives an empty result; other columns are ignored. Equality of shingles is
that of 64-bit hashes.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SPACE, free_prefix, input_partitions, stored
from strata.llm.token_counts import groups_by_bytes
from strata.llm.word_hashes import word_hashes

WORDS = 5
#: Jaccard threshold as a fraction.
NUM, DEN = 80, 100
GROUPS = 256
FULL = 0xFFFF
HOT_SHARE = 0.001
BLOCK = 4096
LEAF = 32
#: Classes and shingles of one side of a neighbourhood's block pair, and shingles multiplied at a time.
MEMBERS, MEMBER_SHINGLES, COLUMNS = 1600, 1 << 22, 2048
#: Shingles counted at a time for the hot list.
COUNT_AT_ONCE = 1 << 21
#: Classes whose features a task remembers to have sent.
GIVEN_ENTRIES = 500_000
#: Characters whose sets are made at a time, and rows of a batch that a task sends.
TEXT_CHARS, ROWS_AT_ONCE = 1 << 19, 10_000
#: Size of the map of wanted texts: half a megabyte, whatever their number.
MAP_BITS = 1 << 22

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the sums over all 64 bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _shingles(h: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of a text's word hashes, given those of all five in a row."""
    if len(h) < WORDS:
        return _mix(np.array([(h * _MULT[:len(h)]).sum() + np.uint64(len(h))], np.uint64)) if len(h) else h
    s = np.sort(mixed)
    again = s[1:] == s[:-1]
    return s[np.append(True, ~again)] if again.any() else s


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    for lo, hi in groups_by_bytes([t or "" for t in texts], TEXT_CHARS):
        # bytes: lower() folds A-Z only, words end at the six ASCII spaces
        h, cuts = word_hashes([(t or "").encode().lower() for t in texts[lo:hi]])
        n = max(0, len(h) - WORDS + 1)
        total = h[:n] * _MULT[0]
        for k in range(1, WORDS):
            total += h[k:k + n] * _MULT[k]
        mixed = _mix(total)
        for i, j in zip(cuts.tolist(), cuts[1:].tolist()):
            yield _shingles(h[i:j], mixed[i:max(i, j - WORDS + 1)])


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return next(shingle_sets([text]))


def front(s: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, int]:
    """The set's first shingles in the common order (hot ones last, then by hash), and how
    many of them aren't hot."""
    need = len(s) - -(-len(s) * NUM // DEN) + 1
    cold = s
    if len(hot) and len(s):
        is_hot = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s
        cold, s = s[~is_hot], np.concatenate([s[~is_hot], s[is_hot]])
    return s[:need], min(need, len(cold))


def overlap_needed(a, b):
    """Shingles that sets of these sizes must share."""
    return -(-(a + b) * NUM // (NUM + DEN))


def count_vector(s: np.ndarray) -> np.ndarray:
    """Counts by group, 16 bits each; ``FULL`` stands for any larger count too."""
    return np.minimum(np.bincount((s >> np.uint64(40)) % np.uint64(GROUPS), minlength=GROUPS), FULL).astype(np.uint16)


def packed_counts(point: np.ndarray) -> bytes:
    """A count vector in 4 bits a count if all fit, else in 8, else in 16."""
    most = point.max()
    if most <= 0xF:
        low = point.astype(np.uint8)
        return (low[0::2] | low[1::2] << 4).tobytes()
    return point.astype(np.uint8 if most <= 0xFF else "<u2").tobytes()


def unpacked_counts(packed: list[bytes]) -> np.ndarray:
    out, sizes = np.zeros((len(packed), GROUPS), np.uint16), np.fromiter(map(len, packed), np.int64, len(packed))
    for width in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == width)
        raw = np.frombuffer(b"".join([packed[k] for k in at]), "<u2" if width == 2 * GROUPS else np.uint8).reshape(len(at), -1)
        if width == GROUPS // 2:
            raw = np.stack([raw & 0xF, raw >> 4], axis=2).reshape(len(at), -1)
        out[at] = raw
    return out


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shingles that points of ``a`` and ``b`` can share at most: no bound at all where a
    group is full in both."""
    least = np.minimum(a, b)
    return np.where((least == FULL).any(axis=1), np.iinfo(np.int64).max, least.sum(axis=1, dtype=np.int64))


def enough(shared: int, a: int, b: int) -> bool:
    return DEN * shared >= NUM * (a + b - shared)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    return enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))


class CountVectorTree:
    """R-tree of points sorted so that neighbours lie together: leaves of ``LEAF`` points
    with their corner of coordinate maxima and their size range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.cuts = np.arange(0, len(points), LEAF)
        self.high = np.maximum.reduceat(points, self.cuts, axis=0)
        self.small = np.minimum.reduceat(sizes, self.cuts)
        self.large = np.maximum.reduceat(sizes, self.cuts)

    def _may_meet(self, a_points, a_small, a_large, b_points, b_small, b_large) -> np.ndarray:
        """Pairs (of nodes or points) whose bounds allow a link."""
        fits = (a_large[:, None] * DEN >= b_small[None] * NUM) & (b_large[None] * DEN >= a_small[:, None] * NUM)
        need = overlap_needed(a_small[:, None], b_small[None])
        for i in np.flatnonzero(fits.any(axis=1)):
            js = np.flatnonzero(fits[i])
            bound = overlap_bound(a_points[i], b_points[js])
            fits[i, js] = bound >= need[i, js]
        return fits

    def join(self, other: CountVectorTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs of points that may be linked."""
        nodes = self._may_meet(self.high, self.small, self.large, other.high, other.small, other.large)
        for i, j in zip(*np.nonzero(nodes)):
            a = slice(self.cuts[i], self.cuts[i] + LEAF)
            b = slice(other.cuts[j], other.cuts[j] + LEAF)
            x, y = self.sizes[a], other.sizes[b]
            hits = self._may_meet(self.points[a], x, x, other.points[b], y, y)
            p, q = np.nonzero(hits)
            if len(p):
                yield p + self.cuts[i], q + other.cuts[j]


def _block_pairs(cls, comp, n, points, side) -> tuple[np.ndarray, np.ndarray]:
    """Candidate class pairs of one bucket block: rows of side 0 against those of side 1,
    or side 2 (both) against each other."""
    order = np.lexsort((n, comp))
    cls, comp, n, points, side = cls[order], comp[order], n[order], points[order], side[order]
    left, right = side != 1, side != 0
    a, b = CountVectorTree(points[left], n[left]), CountVectorTree(points[right], n[right])
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, q in a.join(b):
        x, y = cls[left][p], cls[right][q]
        keep = comp[left][p] != comp[right][q]
        found_a.append(np.minimum(x, y)[keep])
        found_b.append(np.maximum(x, y)[keep])
    return np.concatenate(found_a), np.concatenate(found_b)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))


def _hot_shingles(rows: DataFrame) -> np.ndarray:
    """Shingles in at least ``HOT_SHARE`` of the documents, from what is frequent in some
    part of each task's rows. A missed one only makes a bucket larger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held, documents = [], 0, 0

        def local():
            h, k = np.unique(np.concatenate(sets), return_counts=True)
            often = k >= max(4, HOT_SHARE * len(sets) / 2)
            return pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(k[often])], ["h", "k"])

        for b in batches:
            for s in shingle_sets(b.column("text").to_pylist()):
                sets.append(s)
                held += len(s)
                if held >= COUNT_AT_ONCE:
                    yield local()
                    sets, held = [], 0
        if sets:
            yield local()

    total = rows.count()
    found = rows.select("text").mapInArrow(run, "h long, k long").groupBy("h").agg(F.sum("k").alias("k"))
    # at most (mean set size / HOT_SHARE) rows
    hot = found.where(F.col("k") >= max(4, HOT_SHARE * total)).select("h").toArrow()
    return np.sort(np.asarray(hot.column("h").combine_chunks()).view(np.uint64)) if len(hot) else np.zeros(0, np.uint64)


def _features(rows: DataFrame, hot) -> DataFrame:
    """Per row: doc_id, th, n, cls (64-bit digest of the set), and, once per class and task,
    the front shingles and the count vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, given = hot.value, set()
        for b in batches:
            n, cls, fronts, n_cold, points = [], [], [], [], []
            for s in shingle_sets(b.column("text").to_pylist()):
                n.append(len(s))
                if not len(s):
                    cls.append(None), fronts.append(None), n_cold.append(None), points.append(None)
                    continue
                c = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
                cls.append(c)
                if c in given:
                    fronts.append(None), n_cold.append(None), points.append(None)
                    continue
                if len(given) < GIVEN_ENTRIES:
                    given.add(c)
                first, cold = front(s, listed)
                fronts.append(first.view(np.int64)), n_cold.append(cold), points.append(packed_counts(count_vector(s)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                 pa.array(fronts, pa.list_(pa.int64())), pa.array(n_cold, pa.int64()), pa.array(points, pa.binary())],
                ["doc_id", "th", "n", "cls", "front", "n_cold", "points"])

    return rows.mapInArrow(run, "doc_id long, th long, n long, cls long, front array<long>, n_cold long, points binary")


def _entries(features: DataFrame) -> DataFrame:
    """(h, cls, pos, hot): the front shingles as rows."""
    return features.where(F.col("front").isNotNull()).select("cls", "n_cold", F.posexplode("front").alias("pos", "h")).select(
        "h", "cls", "pos", (F.col("pos") >= F.col("n_cold")).alias("hot"))


def _suspects(entries: DataFrame) -> DataFrame:
    """(h, cls, pos) for front shingles that another class also has in front."""
    # a cold bucket is bounded: smallest and largest class differ if there are several
    per = Window.partitionBy("h")
    cold = entries.where("not hot").select("h", "cls", "pos").withColumn("lo", F.min("cls").over(per)).withColumn("hi", F.max("cls").over(per))
    # a hot shingle's bucket always holds several classes
    hot = entries.where("hot").select("h", "cls", "pos").distinct()
    return cold.where("lo <> hi").select("h", "cls", "pos").distinct().unionByName(hot)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (smallest, other) that connect what the pairs (a, b) connect, one for each other."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    own = np.arange(len(names))
    label = own.copy()
    while True:
        p, q = label[x], label[y]
        if np.array_equal(p, q):
            break
        # labels are roots here: the larger one goes under the smaller
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while not np.array_equal(label, label[label]):
            label = label[label]
    below = label != own
    return names[label[below]], names[below]


def _wanted_map(rows: DataFrame, wanted: DataFrame):
    """A bitmap of fixed size that says where a wanted text may be."""
    places = wanted.select(F.pmod("th", F.lit(MAP_BITS)).alias("p")).distinct().toArrow()
    bitmap = np.zeros(MAP_BITS, bool)
    bitmap[np.asarray(places.column("p").combine_chunks()) if len(places) else []] = True
    return rows.sparkSession.sparkContext.broadcast(np.packbits(bitmap))


def components(links: DataFrame) -> DataFrame:
    """(cls, comp) for every class in a link: comp is the smallest class reachable."""
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "join-links")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")), "join-labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near, "a").select("a", F.col("comp").alias("old"), F.least("comp", "near").alias("to"))
        # pointer jumping: take the label of one's label
        jumped = step.join(labels.select(F.col("a").alias("to"), F.col("comp").alias("far")), "to", "left").select(
            "a", "old", F.least("to", F.coalesce("far", "to")).alias("comp"))
        moved = stored(jumped, "join-labels")
        labels = moved.select("a", "comp")
        if not moved.where("old <> comp").limit(1).count():
            return labels.select(F.col("a").alias("cls"), "comp")


def _tree_links(suspects: DataFrame, comps: DataFrame | None, vectors: DataFrame) -> DataFrame:
    """A forest (a, b) for each task, of the pairs in one bucket and of different components
    (of none yet: of different classes) that the count vectors allow."""
    rows = suspects.withColumn("comp", F.col("cls"))
    if comps is not None:
        rows = suspects.join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    several = stored(rows.groupBy("h").agg(F.count("*").alias("k"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                     .where("lo <> hi").select("h", "k"), "join-buckets")
    rows = rows.join(several, "h").join(vectors, "cls")
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    # block pair (i, j), i <= j: the row is on the left, on the right, or on both sides
    meets = F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(
        F.least(o, mine).alias("i"), F.greatest(o, mine).alias("j"),
        F.when(o == mine, 2).when(mine < o, 0).otherwise(1).alias("side"))))
    rows = rows.select("h", "cls", "comp", "n", "points", meets.alias("m")).select("h", "m.*", "cls", "comp", "n", "points")
    key = ["h", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def pairs(t: pa.Table) -> pa.RecordBatch:
            col = {c: np.asarray(t.column(c).combine_chunks()) for c in (*key, "side", "cls", "comp", "n")}
            points = unpacked_counts(t.column("points").to_pylist())
            pa_, pb_ = forest(*_bucket_pairs(col, points))
            return pa.RecordBatch.from_arrays([pa.array(pa_, pa.int64()), pa.array(pb_, pa.int64())], ["a", "b"])

        for b in batches:
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            k = [np.asarray(t.column(c).combine_chunks()) for c in key]
            changes = np.flatnonzero((k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]) | (k[2][1:] != k[2][:-1]))
            cut = int(changes[-1]) + 1 if len(changes) else 0
            if cut:
                yield pairs(t.slice(0, cut))
            rest = t.slice(cut)
        if rest is not None and len(rest):
            yield pairs(rest)

    dealt = rows.repartition(input_partitions(rows), *key).sortWithinPartitions(*key)
    return stored(dealt.mapInArrow(run, "a long, b long").distinct(), "join-forest")


def _bucket_pairs(col: dict[str, np.ndarray], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of whole bucket blocks that follow one another. Blocks that fit a
    leaf are compared point by point, all of them at once; larger ones by their tree."""
    h, i, j = col["h"], col["i"], col["j"]
    starts = np.concatenate([[0], np.flatnonzero((h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1])
    lengths = np.diff(np.concatenate([starts, [len(h)]]))
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s, m in zip(starts[lengths > LEAF], lengths[lengths > LEAF]):
        a, b = _block_pairs(*(col[c][s:s + m] for c in ("cls", "comp", "n")), points[s:s + m], col["side"][s:s + m])
        out_a.append(a), out_b.append(b)
    small = lengths <= LEAF
    # every row of a small block against the rows after it in the block
    row = np.concatenate([np.arange(s, s + m) for s, m in zip(starts[small], lengths[small])] or [np.zeros(0, np.int64)])
    after = np.repeat(starts[small] + lengths[small], lengths[small]) - row - 1
    for lo in range(0, len(row), 4096):
        r, k = row[lo:lo + 4096], after[lo:lo + 4096]
        p = np.repeat(r, k)
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(k) - k, k)
        ok = (col["comp"][p] != col["comp"][q]) & ((col["side"][p] == 2) | (col["side"][p] != col["side"][q]))
        ok &= (col["n"][p] * DEN >= col["n"][q] * NUM) & (col["n"][q] * DEN >= col["n"][p] * NUM)
        p, q = p[ok], q[ok]
        bound = overlap_bound(points[p], points[q])
        ok = bound >= overlap_needed(col["n"][p], col["n"][q])
        x, y = col["cls"][p[ok]], col["cls"][q[ok]]
        out_a.append(np.minimum(x, y)), out_b.append(np.maximum(x, y))
    return np.concatenate(out_a), np.concatenate(out_b)


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(features, named, degrees): rows with their class, every class with its component and
    smallest id, and the number of links of each class that has one."""
    rows = _rows(docs, id_col, text_col)
    hot = docs.sparkSession.sparkContext.broadcast(_hot_shingles(rows))
    features = stored(_features(rows, hot), "join-features")
    # one row of each class: copies collapse before anything is shuffled by class
    classes = stored(features.where(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.min("doc_id").alias("least"),
        F.min(F.struct("th", F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"))).alias("at")),
        "join-classes")
    points = stored(features.where(F.col("points").isNotNull()).select("cls", "n", "points").dropDuplicates(["cls"]), "join-points")
    suspects = stored(_suspects(_entries(features)), "join-suspects")
    early = _tree_links(suspects.where("pos < 3"), None, points)
    rest = _tree_links(suspects, components(early), points)
    checked = _checked(components(early.union(rest)), rows, classes, points)
    links = checked.where(F.col("b").isNotNull()).select("a", "b")
    degrees = checked.where(F.col("b").isNull()).groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("class_links"))
    named = classes.select("cls", "least").join(components(links), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    return features, named, degrees


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right``; with itself, not
    all of them, where both are the same list."""
    out = np.zeros((len(left), len(right)), np.int32)
    if left is right:
        known, held_by = np.unique(np.concatenate(left), return_counts=True)
        known = known[held_by > 1]
    else:
        known = np.intersect1d(*(np.unique(np.concatenate(x)) for x in (left, right)), assume_unique=True)
    # sorted sets: a run of columns is a slice of each
    for lo in range(0, len(known), COLUMNS):
        part = known[lo:lo + COLUMNS]

        def held(sets):
            m = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                own = s[np.searchsorted(s, part[0], "left"):np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, own)
                m[i, at[part[at] == own]] = 1
            return m

        # whole numbers of at most COLUMNS are exact in single precision
        rows = held(left)
        out += (rows @ (rows if left is right else held(right)).T).astype(np.int32)
    return out


def _checked(near: DataFrame, rows: DataFrame, classes: DataFrame, points: DataFrame) -> DataFrame:
    """For the neighbourhoods ``near`` (cls, comp): rows (a, null, links) with a class's
    number of links in a block pair, and (a, b, null) of links that connect what all do."""
    members = stored(near.join(points.select("cls", "n"), "cls"), "join-members")
    size = stored(members.groupBy("comp").agg(F.count("*").alias("k"), F.sum("n").alias("total")), "join-sizes")
    wanted = stored(members.join(size, "comp").join(classes, "cls").select("cls", "comp", "k", "total", "at.*"), "join-wanted")
    packed = _wanted_map(rows, wanted)

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = np.unpackbits(packed.value).view(bool)
        for b in batches:
            yield b.filter(pa.array(hit[np.mod(np.asarray(b.column("th")), MAP_BITS)], pa.bool_()))

    key = ["th", "no_id", "id"]
    keyed = rows.select("text", "th", F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"))
    # exact repeats of a row would give its class twice
    texts = keyed.mapInArrow(maybe, "text string, th long, no_id boolean, id long").join(wanted, key).dropDuplicates(key)
    blocks = F.greatest(F.ceil(F.col("k") / MEMBERS), F.ceil(F.col("total") / MEMBER_SHINGLES)).cast("int")
    mine = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    meets = F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(
        F.least(o, mine).alias("i"), F.greatest(o, mine).alias("j"), (mine <= o).alias("left"), (mine >= o).alias("right"))))
    group = ["comp", "i", "j"]
    dealt = texts.select("comp", "cls", "text", meets.alias("m")).select("comp", "m.*", "cls", "text").repartition(
        input_partitions(rows), *group).sortWithinPartitions(*group)

    def decided(held: list[tuple]) -> list[np.ndarray]:
        """Classes, their links, and both columns of a forest of the links."""
        cls = np.array([c for c, _, _, _ in held], np.int64)
        sets = list(shingle_sets([t for _, t, _, _ in held]))
        n = np.array([len(s) for s in sets], np.int64)
        left, right = (np.flatnonzero([h[side] for h in held]) for side in (2, 3))
        degree = np.zeros(len(held), np.int64)
        if not len(left) or not len(right):
            return [cls[:0]] * 4
        same = np.array_equal(left, right)
        one = [sets[k] for k in left]
        shared = overlaps(one, one if same else [sets[k] for k in right])
        both = shared >= overlap_needed(n[left][:, None], n[right][None])
        both &= left[:, None] != right[None]
        degree[left] += both.sum(axis=1)
        if not same:
            degree[right] += both.sum(axis=0)
        p, q = np.nonzero(both)
        some = degree > 0
        return [cls[some], degree[some], *forest(cls[left[p]], cls[right[q]])]

    def batch(found: list[list[np.ndarray]]) -> pa.RecordBatch:
        cls, links, a, b = map(np.concatenate, zip(*found))
        none = [pa.nulls(len(x), pa.int64()) for x in (cls, a)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([cls, a])), pa.concat_arrays([none[0], pa.array(b)]), pa.concat_arrays([pa.array(links), none[1]])],
            ["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, found, ready = None, [], [], 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in (*group, "cls", "text", "left", "right"))):
                if row[:3] != at and held:
                    found.append(decided(held))
                    ready += len(held)
                    held = []
                    if ready >= ROWS_AT_ONCE:
                        yield batch(found)
                        found, ready = [], 0
                at = row[:3]
                held.append(row[3:])
        if held:
            found.append(decided(held))
        if found:
            yield batch(found)

    return stored(dealt.mapInArrow(run, "a long, b long, links long"), "join-links")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by
    links), class_id (its set's class, null without shingles), class_links (how many
    other classes its class is linked with)."""
    features, named, degree = _grouped(docs, id_col, text_col)
    smallest = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = stored(named.join(smallest, "comp").join(degree, "cls", "left").select("cls", "component_id", "class_links"), "join-classes")
    out = features.select("doc_id", "n", "cls").join(known, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.col("cls").alias("class_id"), F.coalesce("class_links", F.lit(0).cast("long")).alias("class_links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id's (rows without an id last;
    then by the text's hash). Rows without a word are linked with nothing and stay."""
    features, named, _ = _grouped(docs, id_col, text_col)
    free = free_prefix(docs)
    no_id, at_id, th = free + "no_id", free + "id", free + "th"
    place = {no_id: F.col(id_col).isNull(), at_id: F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")),
             th: F.xxhash64(text_col)}
    placed = features.where(F.col("cls").isNotNull()).select(
        "cls", F.struct(F.col("doc_id").isNull().alias(no_id), F.coalesce("doc_id", F.lit(0).cast("long")).alias(at_id),
                        F.col("th").alias(th)).alias("at"))
    first = placed.groupBy("cls").agg(F.min("at").alias("at")).join(named.select("cls", "comp"), "cls").groupBy("comp").agg(
        F.min("at").alias("at")).select("at.*")
    worded = F.coalesce(F.col(text_col).rlike(f"[^{SPACE}]"), F.lit(False))
    keyed = docs.withColumns(place)
    kept = keyed.where(worded).join(first, list(place), "left_semi").dropDuplicates(list(place)).drop(*place)
    return kept.unionByName(docs.where(~worded))
