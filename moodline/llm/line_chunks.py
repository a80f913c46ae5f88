"""Line deduplication by content-defined chunks of lines (operator 8), native expressions only.

A document is cut between lines where a rolling hash over the hashes of neighbouring
lines falls on a boundary, so that cuts depend on the lines around them and not on
their place: lines inserted above do not shift them. A line of LONG_LINE words or more
is a chunk of its own. A chunk *counts* if it has two lines or more that hold a word,
or is such a long line. Of a counting chunk that appears more than once over all documents the
first (smallest ``doc_id``, then place) stays, and every later one is removed after
its bytes were compared with the first.

Chunks alone miss passages: the first and last chunk of one take in lines around it, and a
chunk of one line under LONG_LINE words does not count. Matches are therefore carried
over chunk borders by *runs*: filled lines each two neighbours of which (blank lines
between them left aside) stand in this order at an earlier place, byte for byte, with
over RUN_WORDS words together. A run goes with the blank lines inside it. Every line
that goes has an equal one at an earlier place, so that its first occurrence stays.

Defined results: NULL and empty texts stay as they are; documents that lose every
line stay as rows with an empty text; rows that agree in ``doc_id`` and text are
treated alike; further columns are carried along, whatever their names. NULL
``doc_id`` sorts first. An empty table gives an empty one.

Each text is split once, into *spans*: its counting chunks and its pairs of neighbouring
filled lines, as narrow rows of two hashes. Very frequent spans are joined with their
first occurrence by broadcast (fewer than a thousand narrow rows), all others by shuffle.
Texts move twice and are not stored: to meet the spans to look at, whose bytes are then
compared in a join that is salted by the number of copies, and to meet the places to go.
Spans that differ in spite of equal hashes, as a rule none, are taken back before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.text import once
from moodline.llm.hot import attached
from moodline.llm.tables import bound, staged, words_of

DIVISOR = 3
LONG_LINE = 50
RUN_WORDS = 50
COPIES_A_SALT = 1000
KEY = ["run", "h1", "h2"]


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _between(items: Column, last: Column) -> Column:
    """``items`` in parts that end at the indices ``last``."""

    def part(end: Column, j: Column) -> Column:
        start = F.coalesce(F.get(last, j - 1) + 1, F.lit(0))
        return F.slice(items, start + 1, end - start + 1)

    return F.transform(last, part)


def _span(run: bool, first: Column, last: Column, words: tuple[Column, Column], hashes: tuple[Column, Column]) -> Column:
    """A chunk or a pair (``run``) with its first and last line; words are counted for pairs."""
    return F.struct(
        first["place"].alias("place"),
        last["place"].alias("last"),
        F.lit(run).alias("run"),
        words[0].alias("n"),
        words[1].alias("n_next"),
        hashes[0].alias("h1"),
        hashes[1].alias("h2"),
    )


def _spans(text: Column) -> Column:
    """The counting chunks and the pairs of neighbouring filled lines of a text, as array of ``_span``."""

    def facts(line: Column, i: Column) -> Column:
        return F.struct(i.alias("place"), line.alias("line"), _line_hash(line).alias("h"), F.size(words_of(line)).alias("n"))

    def chunks(f: Column) -> Column:
        def ends(i: Column) -> Column:
            rolling = F.get(f, i)["h"] * 31 + F.coalesce(F.get(f, i - 1)["h"], F.lit(0))
            return (rolling % DIVISOR == 0) | (F.get(f, i)["n"] >= LONG_LINE) | F.coalesce(F.get(f, i + 1)["n"] >= LONG_LINE, F.lit(True))

        def counts(part: Column) -> Column:
            return (F.size(F.filter(part, lambda x: x["n"] > 0)) >= 2) | F.exists(part, lambda x: x["n"] >= LONG_LINE)

        def span(part: Column) -> Column:
            body = F.array_join(F.transform(part, lambda x: x["line"]), "\n")
            ends_of = F.element_at(part, 1), F.element_at(part, -1)
            return bound(body, lambda b: _span(False, *ends_of, (F.lit(0), F.lit(0)), (F.xxhash64(b), F.xxhash64(F.lit(1), b))))

        places = F.sequence(F.lit(0), F.size(f) - 1)
        parts = bound(F.filter(places, ends), lambda last: _between(f, last))
        return F.transform(F.filter(parts, counts), span)

    def pairs(filled: Column) -> Column:
        def pair(b: Column, j: Column) -> Column:
            a = F.get(filled, j)
            hashes = [F.xxhash64(F.lit(salt), a["line"], b["line"]) for salt in (2, 3)]
            return _span(True, a, b, (a["n"], b["n"]), (hashes[0], hashes[1]))

        return F.transform(F.slice(filled, 2, F.size(filled)), pair)

    def both(f: Column) -> Column:
        return F.concat(chunks(f), bound(F.filter(f, lambda x: x["n"] > 0), pairs))

    return bound(bound(F.split(text, "\n"), lambda lines: F.transform(lines, facts)), both)


def _keyed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns but the text), ``doc_id``, ``text``, and a key of two hashes of these two."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    own = [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64("text", "doc_id", F.lit(1)).alias("_k2")]
    return docs.select(row.alias("row"), "doc_id", "text", *own)


def _long_runs(pairs: Column) -> Column:
    """Of pairs, those in runs of over RUN_WORDS words, sorted by place."""

    def runs(s: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.coalesce(F.get(s, i + 1)["place"] != F.get(s, i)["last"], F.lit(True)))

        def long(run: Column) -> Column:
            return F.aggregate(run, F.element_at(run, -1)["n_next"], lambda total, x: total + x["n"]) > RUN_WORDS

        return F.when(F.size(s) > 0, F.flatten(F.filter(bound(ends, lambda last: _between(s, last)), long))).otherwise(s)

    return bound(F.sort_array(pairs), runs)


def _to_go(spans: Column) -> Column:
    """Of repeated spans, the chunks and the pairs in long runs."""
    return F.concat(F.filter(spans, lambda s: ~s["run"]), _long_runs(F.filter(spans, lambda s: s["run"])))


def repeated(docs: DataFrame) -> DataFrame:
    """``_k1, _k2, spans``: of each document the spans to go by their hashes, each with its ``first`` occurrence and the number of all, ``times``."""
    rows = _keyed(docs.select("doc_id", "text")).where(F.col("text") != "")
    listed = rows.select("doc_id", "_k1", "_k2", once(F.col("text"), _spans).alias("s"))
    each = listed.select("doc_id", "_k1", "_k2", F.explode("s").alias("s"))
    at = F.struct("doc_id", "_k1", "_k2", "s.place", "s.last")
    found = staged(each.select("s.h1", "s.h2", "s.run", "s.n", "s.n_next", at.alias("at")), "line-spans")
    counted = found.groupBy(*KEY).agg(F.count("*").alias("times"), F.min("at").alias("first")).where("times > 1")
    later = attached(found, staged(counted, "repeated-spans"), KEY, "times", found.count()).where(F.col("at") != F.col("first"))
    span = F.struct("at.place", "at.last", "run", "n", "n_next", "h1", "h2", "times", "first")
    by_doc = later.groupBy("at._k1", "at._k2").agg(F.collect_set(span).alias("spans"))
    return by_doc.select("_k1", "_k2", _to_go(F.col("spans")).alias("spans")).where(F.size("spans") > 0)


def _unequal(docs: DataFrame, to_go: DataFrame) -> DataFrame:
    """``_k1, _k2, unequal``: the spans to go whose bytes are not those of their first occurrence."""
    each = to_go.select("_k1", "_k2", F.explode("spans").alias("s"))
    facts = [F.col(f"s.{c}") for c in (*KEY, "times")]
    copies = each.select("_k1", "_k2", F.struct("s.place", "s.last", *facts, F.lit(False).alias("is_first")).alias("p"))
    firsts = each.select("s.first._k1", "s.first._k2", F.struct("s.first.place", "s.first.last", *facts, F.lit(True).alias("is_first")).alias("p"))
    wanted = copies.union(firsts).groupBy("_k1", "_k2").agg(F.collect_set("p").alias("wanted"))
    rows = _keyed(docs.select("doc_id", "text")).select("_k1", "_k2", "text").join(wanted, ["_k1", "_k2"])

    def with_body(lines: Column) -> Column:
        def body(p: Column) -> Column:
            pair = F.concat_ws("\n", F.get(lines, p["place"]), F.get(lines, p["last"]))
            chunk = F.array_join(F.slice(lines, p["place"] + 1, p["last"] - p["place"] + 1), "\n")
            return F.struct(p.alias("p"), F.when(p["run"], pair).otherwise(chunk).cast("binary").alias("body"))

        return F.transform("wanted", body)

    sides = rows.select("_k1", "_k2", F.explode(bound(F.split("text", "\n"), with_body)).alias("w"))
    bodies = staged(sides.select("_k1", "_k2", "w.p.*", "w.body"), "span-bodies")
    salts = F.floor(F.col("times") / COPIES_A_SALT)
    kept = bodies.where("is_first").dropDuplicates(KEY)
    kept = kept.select(*KEY, F.col("body").alias("kept_body"), F.explode(F.sequence(F.lit(0).cast("long"), salts)).alias("salt"))
    copies = bodies.where("NOT is_first").withColumn("salt", F.pmod(F.xxhash64("_k1", "_k2", "place"), salts + 1))
    differ = copies.join(kept, [*KEY, "salt"]).where("body <> kept_body")
    return differ.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("place", "last", "run")).alias("unequal"))


def _rebuilt(docs: DataFrame) -> DataFrame:
    """``row`` (all columns but the text), ``text`` without later copies, ``n_removed`` chunks, ``changed``."""
    to_go = staged(repeated(docs), "spans-to-go")
    unequal = staged(_unequal(docs, to_go), "unequal-spans")

    def confirmed(s: Column) -> Column:
        here = F.struct(s["place"].alias("place"), s["last"].alias("last"), s["run"].alias("run"))
        return ~F.coalesce(F.array_contains("unequal", here), F.lit(False))

    checked = to_go.join(unequal, ["_k1", "_k2"], "left").select("_k1", "_k2", _to_go(F.filter("spans", confirmed)).alias("gone"))
    places = checked.select("_k1", "_k2", F.transform("gone", lambda s: F.struct(s["place"].alias("place"), s["last"].alias("last"), s["run"].alias("run"))).alias("gone"))
    marked = _keyed(docs).drop("doc_id").join(places, ["_k1", "_k2"], "left")

    def rest(lines: Column) -> Column:
        gone = F.flatten(F.transform("gone", lambda s: F.sequence(s["place"], s["last"])))
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)), "\n")

    changed = F.coalesce(F.array_size("gone") > 0, F.lit(False))
    text = F.when(changed, bound(F.split("text", "\n"), rest)).otherwise(F.col("text"))
    n = F.coalesce(F.array_size(F.filter("gone", lambda s: ~s["run"])), F.lit(0))
    return marked.select("row", n.alias("n_removed"), changed.alias("changed"), once(text, lambda t: t).alias("text"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, its ``text`` without later copies of chunks and runs, and the number of these chunks, ``n_removed``."""
    return _rebuilt(docs).select("row.doc_id", "n_removed", "text")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with their own columns, without later copies of chunks and runs; ``n_chars``, if there is one, follows the text."""
    length = F.when(F.col("changed"), F.length("text").cast("long"))
    own = {"text": F.col("text"), "n_chars": F.coalesce(length, F.col("row.n_chars")).alias("n_chars") if "n_chars" in docs.columns else None}
    return _rebuilt(docs).select(*[own[c] if c in own else F.col(f"row.`{c}`") for c in docs.columns])
