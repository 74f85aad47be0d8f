"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

1. Statistics of every whole text are built-in column expressions, computed once and
   stored (a dozen numbers a document).
2. A shallow random forest is fitted to the labelled training rows; every path from a root
   to a node is a rule, a conjunction of thresholds on statistics.
3. A lasso logistic regression over the rules' 0/1 values leaves a few with a weight.
4. The weighted rules compile into one column expression, so scoring is a narrow pass of
   generated code over the stored statistics.

Training reads at most about ``max_training_rows`` labelled rows, picked by a hash of the
id (the documented bound; scores cover every row). Labels, language, source and id are
never inputs. Rows with ``crc32(doc_id as text) % 5 = 0`` are held out of training.

Defined cases: null and empty texts have all statistics 0 and are scored like any row;
null ids count as held out, and join no label; labels other than 0 and 1 are ignored and
several labels of one id count as the smallest; without both classes the score is the
smoothed share of label 1; extra columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, bind, free_prefix, stored, with_passing, words

MAX_TRAINING_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, PENALTY, SEED = 20, 3, 0.002, 7

STATISTICS = ("n_words", "word_length", "distinct_words", "symbols", "capitals", "digits", "marks",
              "doubled_marks", "distinct_lines", "words_a_line")


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text."""
    t = F.coalesce(text, F.lit(""))

    def kept(chars: str) -> Column:
        return F.length(F.regexp_replace(t, f"[^{chars}]+", ""))

    def per(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def of(w: Column) -> Column:
        n, chars = F.size(w), F.length(F.array_join(w, ""))
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
        return F.struct(
            n.cast("double").alias("n_words"), per(chars, n).alias("word_length"),
            per(F.size(F.array_distinct(w)), n).alias("distinct_words"),
            per(kept("#*$%&|<>"), n).alias("symbols"), per(kept("A-Z"), chars).alias("capitals"),
            per(kept("0-9"), chars).alias("digits"), per(kept(".,;:!?"), n).alias("marks"),
            per(F.regexp_count(t, F.lit(r"!!|\?\?")), n).alias("doubled_marks"),
            bind(lines, lambda ls: per(F.size(F.array_distinct(ls)), F.size(ls))).alias("distinct_lines"),
            bind(lines, lambda ls: per(n, F.size(ls))).alias("words_a_line"))

    return bind(words(text), of)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    bound: float


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``score`` compiles them."""

    bias: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self, stat) -> Column:
        """``stat``: statistic name -> column."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(compile_rule(rule, stat), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def compile_rule(rule: tuple[Condition, ...], stat) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & ((stat(c.statistic) > c.bound) if c.above else (stat(c.statistic) <= c.bound))
    return out


def _paths(node, above: tuple[Condition, ...] = ()):
    """Every path of a fitted tree (a JVM node) as a conjunction; one bound a statistic and side."""
    if above:
        yield above
    if node.getClass().getSimpleName() != "InternalNode":
        return
    name, bound = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
    for child, side in ((node.leftChild(), False), (node.rightChild(), True)):
        # a later bound on the same side is the tighter one
        rest = tuple(c for c in above if (c.statistic, c.above) != (name, side))
        yield from _paths(child, (*rest, Condition(name, side, bound)))


def fit(rows: DataFrame) -> RuleModel:
    """Rules and weights from ``rows``: the statistics and ``label`` (0 or 1)."""
    rows = rows.select(array_to_vector(F.array(*STATISTICS)).alias("features"),
                       F.col("label").cast("double").alias("label"), *STATISTICS).cache()
    try:
        n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
        if ones in (0, n):
            from math import log

            return RuleModel(log((ones + 1) / (n - ones + 1)), ())
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                        minInstancesPerNode=max(1, min(20, n // 50))).fit(rows.select("features", "label"))
        found = dict.fromkeys(
            tuple(sorted(p, key=lambda c: (c.statistic, c.above)))
            for tree in forest.trees for p in _paths(tree._call_java("rootNode")))
        rules = list(found)
        if not rules:
            from math import log

            return RuleModel(log((ones + 1) / (n - ones + 1)), ())
        fired = F.array(*[compile_rule(r, F.col).cast("double") for r in rules])
        lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=60).fit(
            rows.select(array_to_vector(fired).alias("features"), "label"))
        weights = lasso.coefficients.toArray()
        return RuleModel(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if w))
    finally:
        rows.unpersist()


def training_labels(labels: DataFrame, max_training_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(doc_id, label) of about ``max_training_rows`` labelled rows at most, none held out."""
    marks = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("label"))
    marks = marks.where(~is_held_out(F.col("doc_id")))
    n = marks.count()
    step = 1 << 20
    if n > max_training_rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) < max_training_rows * step // n)
    return marks


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    stats = stored(docs.select(F.col(id_col).alias("doc_id"), statistics(F.col(text_col)).alias("s"))
                   .select("doc_id", "s.*"), "text-statistics")
    model = fit(stats.join(training_labels(labels), "doc_id"))
    return stats.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), model.score(F.col).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, corpus: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, their columns unchanged. Rules are
    learnt from the labelled rows of ``corpus``, which may hold more than ``docs``."""
    # bounded by max_training_rows, so it may be broadcast
    marks = F.broadcast(training_labels(labels))
    rows = corpus.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(marks, "doc_id")
    model = fit(stored(rows.select(statistics(F.col("text")).alias("s"), "label").select("s.*", "label"), "training-statistics"))
    out = free_prefix(docs) + "statistics"
    return with_passing(docs, out, statistics(F.col(text_col)),
                        lambda s: model.score(lambda name: s[name]) >= threshold).drop(out)
