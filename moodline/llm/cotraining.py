"""Quality classifier by co-training of two views (operator 2).

One logistic regression sees what the text is like, the other only the metadata of the
page (source, language, length). In each of ROUNDS rounds both are fitted and score all
unlabelled documents, and each hands confident pseudo-labels to the other's training
rows: of what it is sure of and has not handed over before, the surest SHARE of each
class in each bucket of sources, so that small sources take part beside a large one. A
view is sure of a class from the margin on at which its own probability is CONFIDENT
and at which, in a labelled fold that it has not seen, it is right that often; a view
that knows nothing of quality hands nothing over. Labels handed over stay for all later
rounds. Whatever their number, those of a class weigh at most as much as the labelled
rows of that class. At the end a logistic regression over both margins, fitted on that
fold, calibrates and combines them. All documents are scored.

Texts are read once, for features, which are written as narrow rows; the fits are
Spark's own, over partitions. Fitting sees at most TRAIN_ROWS labelled documents, the
first in an order by hash; nothing else is bounded. What is sure enough is found by
counts of levels of margins (at most SOURCES * 2 * 2 * 4 * LIMIT rows), so that it does
not depend on the order of tasks. Labelled rows with crc32(doc_id) mod 5 = 0 are held
out for measuring.

Defined results: NULL and empty texts have all text features 0, long ones are read
whole; NULL source or language is a value of its own and a NULL length 0; without both
classes among the labelled rows every score is the share of good ones (1 without any)
and nothing is rejected; of several labels for one ``doc_id`` the smallest counts; a
NULL ``doc_id`` has no label; equal margins are handed over together; repeated rows give
repeated results and train repeatedly; without unlabelled documents the views learn
from labels alone; further columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm.tables import staged

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRAIN_ROWS = 12_000
ROUNDS = 3
SHARE = 0.5
CONFIDENT = 0.95
SOURCES = 256
LIMIT = 20
BUCKETS = 256
KEEP_FROM = 0.5
# Each view and the one that it learns from.
VIEWS = {"content": "page", "page": "content"}
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"\d")


def text_features(text: str | None) -> list[float]:
    words = (text or "").split()
    if not words:
        return [0.0] * 12
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    runs = sum(a == b for a, b in zip(words, words[1:]))
    fives = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    return [
        math.log1p(n),
        chars / n,
        len(set(words)) / n,
        runs / n,
        1 - len(set(fives)) / len(fives) if fives else 0.0,
        len(_SYMBOLS.findall(text)) / n,
        text.count("!") / n,
        len(_UPPER.findall(text)) / chars,
        len(_DIGIT.findall(text)) / chars,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        text.count(".") / n,
        text.count(",") / n,
    ]


def views(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep``, the vector ``content`` of the text, and the vector ``page`` of the metadata."""
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    meta = docs.select(
        *keep,
        F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("none")).alias("source"),
        F.coalesce(F.concat(F.lit("l:"), "lang"), F.lit("none")).alias("lang"),
        F.log1p(F.coalesce(F.col("n_chars"), F.lit(0)).cast("double")).alias("length"),
        "text",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], [*batch.schema.names[:-1], "f"])

    schema = ", ".join([*(f"{k} {types[k]}" for k in keep), "source string, lang string, length double, f array<double>"])
    ready = meta.mapInArrow(run, schema).withColumn("content", array_to_vector("f"))
    hashed = FeatureHasher(inputCols=["source", "lang", "length"], outputCol="page", numFeatures=BUCKETS).transform(ready)
    return hashed.select(*keep, "content", "page")


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    names = {"probabilityCol": f"p_{view}", "rawPredictionCol": f"m_{view}", "predictionCol": f"y_{view}"}
    return LogisticRegression(featuresCol=view, labelCol="label", weightCol="weight", regParam=0.001, maxIter=30, **names).fit(rows)


def _first_by_hash(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _with_levels(rows: DataFrame) -> DataFrame:
    """``rows`` with each view's class, and the level (a quarter of a margin's unit) where the view is sure by itself."""
    sure = math.log(CONFIDENT / (1 - CONFIDENT))
    for view in VIEWS:
        margin = F.col(f"at_{view}")
        level = F.when(F.abs(margin) >= sure, F.floor(F.abs(margin) * 4).cast("int"))
        rows = rows.withColumn(f"level_{view}", level).withColumn(f"class_{view}", (margin > 0).cast("double"))
    return rows


def _by_view() -> Column:
    """A row for each view: ``e.view, e.label, e.level``."""
    each = (F.struct(F.lit(v).alias("view"), F.col(f"class_{v}").alias("label"), F.col(f"level_{v}").alias("level")) for v in VIEWS)
    return F.explode(F.array(*each)).alias("e")


def trusted_levels(fold: DataFrame) -> dict[tuple[str, float], int]:
    """The least level from which a view is right CONFIDENT of the time, by view and class.

    ``fold`` has ``label`` and both margins. Two rows of the class's share in the fold are
    added to what is counted, so that a few lucky rows do not make a view trusted.
    """
    shares = {r["label"]: r["n"] for r in fold.groupBy("label").agg(F.count("*").alias("n")).collect()}
    levels = _with_levels(fold).select(F.col("label").alias("truth"), _by_view()).where("e.level IS NOT NULL")
    # At most 2 * 2 * 4 * LIMIT rows.
    counts = levels.groupBy("e.view", "e.label", "e.level").agg(F.count("*").alias("n"), F.sum((F.col("truth") == F.col("e.label")).cast("int")).alias("good")).collect()
    least = {}
    for view in VIEWS:
        for label in (0.0, 1.0):
            n = right = 0
            share = shares.get(label, 0) / max(1, sum(shares.values()))
            for r in sorted((r for r in counts if r["view"] == view and r["label"] == label), key=lambda r: -r["level"]):
                n, right = n + r["n"], right + r["good"]
                if (right + 2 * share) / (n + 2) >= CONFIDENT:
                    least[view, label] = r["level"]
    return least


def handed_over(pool: DataFrame, least: dict[tuple[str, float], int]) -> DataFrame:
    """``pool`` with pseudo-labels added to ``by_content`` and ``by_page`` where they are NULL.

    Reads the margins ``at_content`` and ``at_page`` and the ``bucket`` of the source.
    ``least`` has the trusted levels; from the surest down they are taken until they hold
    SHARE of what a view is sure of in a bucket and class.
    """
    pool = _with_levels(pool)
    for view in VIEWS:
        new = F.lit(False)
        for label in (0.0, 1.0):
            if (view, label) in least:
                new = new | ((F.col(f"class_{view}") == label) & (F.col(f"level_{view}") >= least[view, label]))
        pool = pool.withColumn(f"level_{view}", F.when(new & F.col(f"by_{view}").isNull(), F.col(f"level_{view}")))
    counts = pool.select("bucket", _by_view()).where("e.level IS NOT NULL").groupBy("bucket", "e.view", "e.label", "e.level").agg(F.count("*").alias("n"))
    group = Window.partitionBy("bucket", "view", "label")
    before = F.sum("n").over(group.orderBy(F.desc("level"))) - F.col("n")
    cuts = counts.withColumn("taken", before < SHARE * F.sum("n").over(group)).where("taken").groupBy("bucket").pivot("view", list(VIEWS))
    # One row for each of at most SOURCES buckets.
    cuts = cuts.agg(F.min(F.when(F.col("label") == 1, F.col("level"))).alias("1"), F.min(F.when(F.col("label") == 0, F.col("level"))).alias("0"))
    out = pool.join(F.broadcast(cuts), "bucket", "left")
    for view in VIEWS:
        cut = F.when(F.col(f"class_{view}") == 1, F.col(f"{view}_1")).otherwise(F.col(f"{view}_0"))
        out = out.withColumn(f"by_{view}", F.when(F.col(f"level_{view}") >= cut, F.col(f"class_{view}")).otherwise(F.col(f"by_{view}")))
    return out.select("doc_id", "bucket", "content", "page", "by_content", "by_page")


def _training(own: DataFrame, pool: DataFrame, view: str) -> DataFrame:
    """Labelled rows and those that the other view handed over, which weigh at most as much in each class."""
    other = VIEWS[view]
    pseudo = pool.where(F.col(f"by_{other}").isNotNull()).withColumnRenamed(f"by_{other}", "label")
    # Two rows a table.
    known, guessed = ({r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()} for rows in (own, pseudo))
    weight = F.lit(1.0)
    for label, n in guessed.items():
        weight = F.when(F.col("label") == label, min(1.0, known.get(label, 0) / n)).otherwise(weight)
    return own.select("label", F.lit(1.0).alias("weight"), view).union(pseudo.select("label", weight.alias("weight"), view))


def features(docs: DataFrame) -> DataFrame:
    """Written rows ``doc_id, bucket, content, page`` of all documents."""
    bucket = F.pmod(F.xxhash64("source"), F.lit(SOURCES)).cast("int").alias("bucket")
    return staged(views(docs.select("doc_id", "text", "source", "lang", "n_chars", bucket), "doc_id", "bucket"), "features")


def trained(rows: DataFrame, labels: DataFrame) -> tuple | float:
    """The two views' models over ``features`` and their combination, or a prior where labels are of one class."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    fold = (F.crc32(F.col("doc_id").cast("string")) % 5).cast("int")
    chosen = _first_by_hash(known.withColumn("fold", fold).where("fold != 0"), TRAIN_ROWS)
    # At most TRAIN_ROWS narrow rows are sent to all executors.
    labelled = staged(rows.join(F.broadcast(chosen), "doc_id"), "labelled")
    counts = {(r["label"], r["last"]): r["n"] for r in labelled.groupBy("label", (F.col("fold") == 4).alias("last")).agg(F.count("*").alias("n")).collect()}
    if any(not counts.get((label, last)) for label in (0.0, 1.0) for last in (True, False)):
        n = sum(counts.values())
        return sum(c for (label, _), c in counts.items() if label == 1.0) / n if n else 1.0
    own, unseen = labelled.where("fold != 4"), labelled.where("fold = 4")
    # Rows without an id would meet in one task of the join.
    free = rows.where("doc_id IS NOT NULL").join(known.select("doc_id"), "doc_id", "left_anti").unionByName(rows.where("doc_id IS NULL"))
    pool = staged(free.withColumns({f"by_{v}": F.lit(None).cast("double") for v in VIEWS}), "pool")
    for _ in range(ROUNDS):
        models = {view: _fit(_training(own, pool, view), view) for view in VIEWS}
        least = trusted_levels(_with_margins(unseen, models))
        if not least:
            break
        pool = staged(handed_over(_with_margins(pool, models), least), "pool")
    models = {view: _fit(_training(own, pool, view), view) for view in VIEWS}
    last = _margins(unseen, models)
    return models, LogisticRegression(featuresCol="margins", labelCol="label", regParam=0.001, probabilityCol="p").fit(last)


def _with_margins(rows: DataFrame, models: dict) -> DataFrame:
    """``rows`` with ``at_content`` and ``at_page``, between -LIMIT and LIMIT."""
    columns = rows.columns
    for model in models.values():
        rows = model.transform(rows)
    limited = [F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), vector_to_array(f"m_{v}")[1])).alias(f"at_{v}") for v in models]
    return rows.select(*columns, *limited)


def _margins(rows: DataFrame, models: dict) -> DataFrame:
    return _with_margins(rows, models).withColumn("margins", array_to_vector(F.array(*(f"at_{v}" for v in models))))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score`` (probability of good quality) and ``kept``."""
    read = features(docs)
    model = trained(read, labels)
    if isinstance(model, float):
        out = read.select("doc_id", F.lit(model).alias("score"), F.lit(True).alias("kept"))
    else:
        models, combined = model
        rows = combined.transform(_margins(read, models).select("doc_id", "margins"))
        out = rows.select("doc_id", vector_to_array("p")[1].alias("score")).withColumn("kept", F.col("score") >= KEEP_FROM)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "kept")
