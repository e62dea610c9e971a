"""Quality of texts by a sparse rule ensemble, applied as one Spark expression.

Statistics of a text (shares of letters, capitals, symbols, repeated words, repeated lines and the like) are native columns. A forest of
shallow trees is fitted on labelled texts; each way from a root to a node is a rule, a conjunction of bounds on statistics. A
logistic regression with a lasso penalty weighs the rules, most with zero. What is left is compiled into a column: the score is the logistic function
of the intercept and the weights of the rules that hold, so scoring reads each text once, in the JVM, without a shuffle.

The fit is on a sample of at most ``SAMPLE`` labelled texts: those whose ids hash lowest, so it doesn't depend on partitions or order.
The sample's statistics (some 150 bytes a text) are put in one order for the fit, so reruns agree. The sample's ids are the only thing broadcast (16 bytes each).

Defined cases: null texts count as empty, and both are scored; all shares of an empty text are 0. A document whose labels disagree, without an
id or with null labels isn't learned from; of rows with one id one is (that with the smallest statistics). With labels of one class only, or none, every score is the
share of good ones among them, each class counted half a time more. Texts are read whole. Extra columns are kept and no input,
whatever their names; ``score`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.components import written

SAMPLE = 20_000
TREES = 24
DEPTH = 3
PENALTY = 0.001

#: (statistic, True: at most, False: above, bound)
Bound = tuple[int, bool, float]
Rule = tuple[Bound, ...]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and a double per statistic of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    count = lambda pattern: F.regexp_count(F.col("t"), F.lit(pattern))
    base = docs.select(F.struct("*").alias("row"), text.alias("t"))
    # what the shares are made of is computed once
    base = base.select(
        "row", F.length("t").alias("chars"), F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"), F.split("t", "\n").alias("lines"),
        count(r"\p{L}").alias("letters"), count(r"\p{Lu}").alias("capitals"), count(r"\p{Nd}").alias("digits"), count(r"[#$%&*|<>{}=~^_+@/\\]").alias("symbols"),
        count(r"[.,;:?]").alias("marks"), count(r"!").alias("calls"), count(r"(?<!\S)(\S++)\s++\1(?!\S)").alias("doubled"), count(r"[.!?…][\"'”»)]*\s*(?:\n|\z)").alias("ends"),
    )
    base = base.select(
        "row", "chars", "letters", "capitals", "digits", "symbols", "marks", "calls", "doubled", "ends", F.size("words").alias("n_words"), F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("words")).alias("kinds"), F.size(F.array_distinct("lines")).alias("line_kinds"),
    )
    c = F.col
    return base.select(
        "row",
        F.log1p("chars").alias("length"), F.log1p("n_words").alias("word_count"), _share(c("letters"), c("n_words")).alias("word_length"), _share(c("letters"), c("chars")).alias("letter_share"),
        _share(c("capitals"), c("letters")).alias("capital_share"), _share(c("digits"), c("chars")).alias("digit_share"), _share(c("symbols"), c("n_words")).alias("symbols_a_word"),
        _share(c("marks"), c("n_words")).alias("marks_a_word"), _share(c("calls"), c("n_words")).alias("calls_a_word"), _share(c("doubled"), c("n_words")).alias("doubled_share"),
        _share(c("kinds"), c("n_words")).alias("word_kinds"), _share(c("line_kinds"), c("n_lines")).alias("line_kinds"), F.log1p(_share(c("n_words"), c("n_lines"))).alias("words_a_line"),
        _share(c("ends"), c("n_lines")).alias("ended_lines"),
    )


STATISTICS = ("length", "word_count", "word_length", "letter_share", "capital_share", "digit_share", "symbols_a_word", "marks_a_word", "calls_a_word", "doubled_share", "word_kinds", "line_kinds", "words_a_line", "ended_lines")


@dataclass
class Model:
    intercept: float
    rules: list[tuple[float, Rule]] = field(default_factory=list)


_LINE = re.compile(r"^( *)(?:(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)|Predict: .*)$")


def paths(tree: str) -> Iterable[Rule]:
    """The rules of a printed tree: the bounds from the root to each node below it."""
    way: list[tuple[int, Bound]] = []
    for line in tree.splitlines()[1:]:
        m = _LINE.match(line)
        if m and m[2]:
            while way and way[-1][0] >= len(m[1]):
                way.pop()
            way.append((len(m[1]), (int(m[2]), m[3] == "<=", float(m[4]))))
            yield tightest(b for _, b in way)


def tightest(bounds: Iterable[Bound]) -> Rule:
    """One bound for each statistic and side."""
    best: dict[tuple[int, bool], float] = {}
    for i, most, x in bounds:
        best[i, most] = x if (i, most) not in best else min(x, best[i, most]) if most else max(x, best[i, most])
    return tuple(sorted((i, most, x) for (i, most), x in best.items()))


def holds(rule: Rule) -> Column:
    """The rule as a condition on the statistics' columns."""
    out = F.lit(True)
    for i, most, x in rule:
        out = out & (F.col(STATISTICS[i]) <= x if most else F.col(STATISTICS[i]) > x)
    return out


def labelled(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The statistics and the label of at most ``sample`` labelled texts, one for each id."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    agreed = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where(F.col("label") == F.col("most")).drop("most")
    # labels without a text take no place in the sample
    there = agreed.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    chosen = there.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    found = statistics(texts).select(F.col("row")["id"].alias("id"), F.struct(F.col("row")["label"].alias("label"), *STATISTICS).alias("s"))
    return found.groupBy("id").agg(F.min("s").alias("s")).select("id", "s.*")


def fit(rows: DataFrame, *, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = 11) -> Model:
    """The rule ensemble of :func:`labelled` rows."""
    rows = written(rows, "labelled").coalesce(1).sortWithinPartitions("id")
    n, good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = Model(_logit((good + 0.5) / (n + 1)))
    if not 0 < good < n:
        return prior
    vectors = rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.8, maxBins=64, minInstancesPerNode=2, seed=seed).fit(vectors)
    rules = sorted({r for tree in forest.trees for r in paths(tree.toDebugString)})
    if not rules:
        return prior
    held = rows.select("label", array_to_vector(F.array(*[F.when(holds(r), 1.0).otherwise(0.0) for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=100).fit(written(held, "rules").coalesce(1))
    weights = zip(lasso.coefficients.toArray().tolist(), rules, strict=True)
    return Model(float(lasso.intercept), [(w, r) for w, r in weights if w])


def _logit(p: float) -> float:
    from math import log

    return log(p / (1 - p))


def score(model: Model) -> Column:
    """The model as a column over the statistics' columns."""
    logit = F.lit(model.intercept)
    for weight, rule in model.rules:
        logit = logit + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def classify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the double ``score``: the likelihood that the text is a good one."""
    out = statistics(docs, text_col).select("row", score(model).alias("score"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "score"], "score")
