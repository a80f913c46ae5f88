"""Toxicity scores by boosted trees over dense features (operator 9).

Features of a whole text: densities of lexicon words, their nearness to words of the
second person, rates of capitals, punctuation, stretched and obfuscated words. The
lexicon is SEEDS plus the words that labelled toxic texts use far more than others,
learned on a fold of its own; trees are fitted on two other folds, and an isotonic
regression turns their margin into a probability on the last one. Only labelled rows
with crc32(doc_id) mod 5 other than 0 are used, at most TRAIN_ROWS of them, the first
in an order by hash; every document is scored.

Inputs of a score are the text alone. Defined results: NULL and empty texts have all
features 0 and get the score of such a text; without both labels in a fold the score is
the share of toxic rows among the labelled ones (0 without any); of several labels for
one ``doc_id`` the largest counts; repeated rows give repeated results; further columns
do not matter.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.llm.tables import staged

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRAIN_ROWS = 24_000
LEXICON_WORDS = 400
MIN_TOXIC = 4
TREES = 20
DEPTH = 4
NEAR = 5
# Insults in the languages of the corpus; a starting point, the learned words add to it.
SEEDS = "idiot stupid moron loser scum trash worthless pathetic disgusting vile clown bobo idiota imbecil dumm trottel"
SECOND = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine sie ihr euch usted ustedes ti tus vosotros".split())
PLAIN = str.maketrans("013457@$!", "oieastasi")
FEATURES = 14
_LETTERS = re.compile(r"[^\W\d_]+")
_STRETCHED = re.compile(r"(\w)\1\1")
_HIT, _SECOND, _CAPS, _MIXED, _STRETCH, _LOUD, _ASK, _PUNCT = (1 << i for i in range(8))


def plain(word: str) -> str:
    """Lower case, digits and signs that stand for letters replaced, only letters left."""
    return "".join(_LETTERS.findall(word.lower().translate(PLAIN)))


class _Facts(dict):
    """Flags of a word in the low byte, thousandths of its lexicon weight above; forgets all when full."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        bare = word.strip(".,;:!?\"'()[]")
        key = "".join(_LETTERS.findall(word.lower()))
        weight, hidden = self.weights.get(key, 0.0), False
        if not weight:
            weight = self.weights.get(plain(bare), 0.0)
            hidden = weight > 0
        inner = bool(re.search(r"[^\W\d_][\d@$*!.\-_]+[^\W\d_]", bare))
        flags = (
            (_HIT if weight > 0 else 0)
            | (_SECOND if key in SECOND else 0)
            | (_CAPS if len(key) > 2 and bare.isupper() else 0)
            | (_MIXED if inner or hidden else 0)
            | (_STRETCH if _STRETCHED.search(key) else 0)
            | (_LOUD if "!" in word else 0)
            | (_ASK if "?" in word else 0)
            | (_PUNCT if bare != word else 0)
        )
        out = self[word] = int(weight * 1000) << 8 | flags
        return out


def features(text: str | None, facts: _Facts) -> list[float]:
    words = (text or "").split()
    if not words:
        return [0.0] * FEATURES
    codes = np.fromiter(map(facts.__getitem__, words), dtype=np.int64, count=len(words))
    n = len(words)
    hits, second = np.flatnonzero(codes & _HIT), np.flatnonzero(codes & _SECOND)
    weights = (codes[hits] >> 8) / 1000
    near = 0.0
    if len(hits) and len(second):
        at = np.searchsorted(second, hits)
        gap = np.minimum(np.abs(second[np.minimum(at, len(second) - 1)] - hits), np.abs(second[np.maximum(at - 1, 0)] - hits))
        near = float((gap <= NEAR).sum())
    share = [float(np.count_nonzero(codes & flag)) / n for flag in (_CAPS, _MIXED, _STRETCH, _LOUD, _ASK, _PUNCT)]
    return [
        float(len(hits)),
        100.0 * len(hits) / n,
        float(weights.sum()),
        100.0 * float(weights.sum()) / n,
        float(weights.max(initial=0.0)),
        float(len(set(codes[hits].tolist()))),
        near,
        math.log1p(n),
        *share,
    ]


def fold(doc_id: Column) -> Column:
    return (F.crc32(doc_id.cast("string")) % 5).cast("int")


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most TRAIN_ROWS labelled texts, none of the held-out fold."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    first = one.withColumn("fold", fold(F.col("doc_id"))).where("fold != 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    # At most TRAIN_ROWS rows of three numbers.
    return staged(docs.select("doc_id", "text").join(F.broadcast(first), "doc_id"), "labelled")


def _lexicon(sample: DataFrame) -> dict[str, float]:
    """Weights of the words most typical of toxic texts: log ratios of the shares of texts that hold them."""
    bare = F.transform(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))), lambda w: w)
    rows = sample.where("fold = 1").select("label", bare.alias("words"))
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1.0, 0), totals.get(0.0, 0)
    weights = dict.fromkeys(SEEDS.split(), 1.0)
    if bad and good:
        per = rows.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
        ratio = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
        top = per.where(F.col("bad") >= MIN_TOXIC).withColumn("ratio", ratio).where("ratio > 1.5")
        for r in top.orderBy(F.desc("ratio"), "word").limit(LEXICON_WORDS).collect():
            weights[r["word"]] = max(weights.get(r["word"], 0.0), float(r["ratio"]))
    return weights


def _featured(docs: DataFrame, weights: dict[str, float], *keep: str) -> DataFrame:
    """``keep`` and ``features`` (a vector); the lexicon has at most LEXICON_WORDS learned words."""
    types = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = _Facts(weights)
        for batch in batches:
            rows = [features(t.as_py(), facts) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], [*keep, "f"])

    schema = ", ".join([*(f"{k} {types[k]}" for k in keep), "f array<double>"])
    return docs.select(*keep, "text").mapInArrow(run, schema).withColumn("features", array_to_vector("f")).drop("f")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``."""
    sample = _sample(docs, labels)
    known = {(r["fold"], r["label"]): r["n"] for r in sample.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}

    def both(*folds: int) -> bool:
        return all(any(known.get((f, label)) for f in folds) for label in (0.0, 1.0))

    rows = docs.select("doc_id", "text")
    if both(2, 3) and both(4):
        weights = _lexicon(sample)
        ready = staged(_featured(sample, weights, "label", "fold"), "features")
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, featuresCol="features", labelCol="label").fit(ready.where("fold IN (2, 3)").coalesce(1))
        margins = trees.transform(ready.where("fold = 4"))
        scale = IsotonicRegression(featuresCol="rawPrediction", featureIndex=1, labelCol="label", predictionCol="score").fit(margins.select("rawPrediction", "label"))
        out = scale.transform(trees.transform(_featured(rows, weights, "doc_id")).select("doc_id", "rawPrediction"))
    else:
        n = sum(known.values())
        prior = sum(c for (_, label), c in known.items() if label == 1.0) / n if n else 0.0
        out = rows.select("doc_id", F.lit(prior).alias("score"))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
