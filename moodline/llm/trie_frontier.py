"""Spelling variants by a relational trie frontier (operator 13).

Words are the distinct runs of the letters ``[A-Za-z\\u00C0-\\u00FF]``, with A-Z lower-cased,
of at least LETTERS code points and COUNT occurrences in all documents. Two words are
near if they differ by one inserted, deleted or replaced code point.

1. Words are counted over all whole texts. Tasks add up what they meet before the
   shuffle.
2. Every word enters two tries, one of the words and one of the reversed words, closed
   by an end mark. Near words of up to m code points share a prefix of at least half of
   m or else such a suffix, so in each trie an edit is only tried from half the word on,
   where nodes have few children, and both tries start below the first letters.
3. Level by level, states (word, rest of the word, node, edits) are joined with the edge
   table of their level. A state without edits follows its own word by node and letter,
   and branches off, by node, where an edge differs from its next letter: so each pair is
   found at the end of its common prefix. A state with an edit follows one edge. An edge
   with one word below it leads to a leaf that holds the rest of this word, and a state
   that reaches it is a neighbour or ends. An edge carries the letters that follow it,
   and states that could not take the next step are not made.
4. The form of a word is its near word of largest count, if that is at least FACTOR
   times its own; roots follow forms by pointer doubling.

The edges of a level are broadcast while they are at most BROADCAST_EDGES, counted each
time; beyond that they are shuffled, and states of a frequent node are split as skewed
join partitions are. A node has at most 91 edges. The number of levels is the longest
prefix or suffix that two words share.

Defined results: NULL, empty and letterless texts hold no words; runs of any length are
read whole; repeated rows count again; ties go to the smallest word in code-point order;
further columns do not matter. An empty table, or one without frequent words, gives no
rows.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.llm.tables import staged

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS = 6
COUNT = 5
FACTOR = 5
BROADCAST_EDGES = 20_000
# Distinct words that a task adds up before it hands them on.
HELD_WORDS = 200_000
END = "."
_RUN = "[A-Za-zÀ-ÿ]{%d,}"


def word_counts(docs: DataFrame, letters: int = LETTERS, slips: int | None = None) -> DataFrame:
    """``word, n`` of all words of at least ``letters`` code points.

    With ``slips`` some lose a letter: where the unsigned CRC-32 h of ``<doc_id>:<word>``
    is divisible by it, the code point at h modulo the word's length. Rows without
    ``doc_id`` lose none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = re.compile(_RUN % letters).findall
        counts: dict[str, int] = {}

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # of all bytes only those of A-Z are lower-cased
                words = found((text.as_py() or b"").lower().decode())
                if slips and doc is not None:
                    prefix, known = zlib.crc32(b"%d:" % doc), {}
                    for word in words:
                        h = known.get(word)
                        if h is None:
                            h = known[word] = zlib.crc32(word.encode(), prefix)
                        if h % slips == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < letters:
                                continue
                        counts[word] = counts.get(word, 0) + 1
                else:
                    for word in words:
                        counts[word] = counts.get(word, 0) + 1
                if len(counts) > HELD_WORDS:
                    yield flushed()
                    counts.clear()
        yield flushed()

    held = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "word string, n long")
    return held.groupBy("word").agg(F.sum("n").alias("n"))


def _roots(words: DataFrame, depth: int) -> DataFrame:
    """The states of all words in both tries, ``depth`` letters deep."""
    ways = F.explode(F.array(F.struct(F.lit(">").alias("way"), F.col("word").alias("spelt")), F.struct(F.lit("<").alias("way"), F.reverse("word").alias("spelt"))))
    spelt = F.col("w.spelt")
    return words.select("word", "n", ways.alias("w")).select(
        "word",
        "n",
        F.concat(F.substring(spelt, depth + 1, 2**31 - 1), F.lit(END)).alias("rest"),
        F.concat(F.col("w.way"), F.substring(spelt, 1, depth)).alias("node"),
        F.lit(0).alias("edits"),
    )


def _edges(states: DataFrame) -> DataFrame:
    """The level's part of the edge table, by node and letter.

    ``only``, ``only_n`` and ``tail`` say which word an edge leads to, if it is one.
    """
    own = states.where("edits = 0").select("word", "n", "node", F.left("rest", F.lit(1)).alias("letter"), F.expr("substring(rest, 2)").alias("after"))
    grouped = own.groupBy("node", "letter").agg(
        F.count("*").alias("size"),
        F.min("word").alias("only"),
        F.min("n").alias("only_n"),
        F.min("after").alias("tail"),
        F.concat_ws("", F.collect_set(F.left("after", F.lit(1)))).alias("nexts"),
    )
    alone = F.col("size") == 1
    return grouped.select("node", "letter", "size", *[F.when(alone, F.col(c)).alias(c) for c in ("only", "only_n", "tail")], "nexts")


def _moves(states: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """The states of the next level, and the neighbours found (rows with ``near``)."""
    one, two = F.left("rest", F.lit(1)), F.expr("substring(rest, 2, 1)")
    may_edit = (F.col("edits") == 0) & (2 * depth >= F.length("word") - 1)
    after = lambda skipped: F.expr(f"substring(rest, {skipped + 1})").alias("rest")

    # the next letter, or the one after it where the next is left out
    followed = F.struct(one.alias("letter"), after(1), F.col("edits").alias("edits"))
    skipped = F.struct(two.alias("letter"), after(2), F.lit(1).alias("edits"))
    tries = F.explode(F.array(followed, F.when(may_edit & (one != END) & (two != one), skipped)))
    along = states.select("word", "n", "node", tries.alias("a")).where("a IS NOT NULL").select("word", "n", "node", "a.*").join(edges, ["node", "letter"])

    # any other letter, in place of the next or before it
    turns = F.explode(F.array(F.when(one != END, F.struct(after(1))), F.struct(after(0))))
    turned = states.where(may_edit).select("word", "n", "node", one.alias("passed"), turns.alias("a")).where("a IS NOT NULL")
    others = edges.where(F.col("letter") != END)
    aside = turned.select("word", "n", "node", "passed", "a.rest", F.lit(1).alias("edits")).join(others, "node").where("letter != passed").drop("passed")

    leaf, edited = F.col("size") == 1, F.col("edits") == 1
    hit = leaf & edited & (F.col("tail") == F.col("rest"))
    goes_on = ~leaf & (~edited | F.contains("nexts", F.left("rest", F.lit(1))))
    return along.unionByName(aside).where(hit | goes_on).select(
        "word",
        "n",
        F.when(~leaf, F.col("rest")).alias("rest"),
        F.when(~leaf, F.concat("node", "letter")).alias("node"),
        "edits",
        F.col("only").alias("near"),
        F.col("only_n").alias("near_n"),
    )


def neighbours(words: DataFrame, letters: int = LETTERS) -> DataFrame:
    """``word, n, near, near_n`` for all pairs of near words of ``word, n``, in both directions.

    Words are distinct, of at least ``letters`` letters, and hold no end mark.
    """
    depth = letters // 2
    states, found = _roots(words, depth), []
    while True:
        edges = staged(_edges(states), "trie-edges")
        few = edges.count() <= BROADCAST_EDGES
        moves = staged(_moves(states, F.broadcast(edges) if few else edges, depth), "trie-states")
        found.append(moves.where("near IS NOT NULL").select("word", "n", "near", "near_n"))
        states = moves.where("near IS NULL").drop("near", "near_n")
        if states.isEmpty():
            break
        depth += 1
    out = found[0]
    for level in found[1:]:
        out = out.union(level)
    return out.distinct()


def _followed(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: forms grow in count, so paths are short and end."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = staged(now.join(ahead, "root", "left"), "roots")
        if jumped.where("further IS NOT NULL").isEmpty():
            return now
        now = jumped.select("word", F.coalesce("further", "root").alias("root"))


def variants(docs: DataFrame, letters: int = LETTERS, count: int = COUNT, factor: int = FACTOR, slips: int | None = None) -> DataFrame:
    """Per frequent word: ``word, form, root, n, n_near, form_n``; see the module."""
    words = staged(word_counts(docs, letters, slips).where(F.col("n") >= count), "words")
    best = F.min(F.struct(-F.col("near_n"), "near"))
    chosen = neighbours(words, letters).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.col1")
    large = form_n >= factor * F.col("n")
    forms = staged(chosen.select("word", "n_near", F.when(large, F.col("best.near")).alias("form"), F.when(large, form_n).alias("form_n")), "forms")
    roots = _followed(forms.where("form IS NOT NULL"))
    rows = words.join(forms, "word", "left").join(roots, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
