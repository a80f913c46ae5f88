"""Lexicon tables and the lookup of tokens in them.

A lexicon is a DataFrame with one row per lower-case token (``schemas.LEXICON``).
Up to ``MAX_INDEX_ROWS`` rows it becomes a constant of the plan: an array of small
maps, addressed by the hash of the token. Scoring then needs no join and no
shuffle, and no text ever leaves its row. Of a larger lexicon the entries that the
texts hold are looked for first, by their different tokens; when those are few enough
they become the constant, and only when they are not is every token joined: where
the tokens are, with up to ``MAX_BROADCAST_ROWS`` such entries, and sent to them beyond.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.functions.text import once, tokens
from moodline.operators.ordered import stored
from moodline.schemas import LEXICON

MAX_INDEX_ROWS = 50_000
MAX_INDEX_CHARS = 2_000_000
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_CHARS = 10_000_000
SALTS = 16

_FIELDS = ("valence", "polarity", "subjectivity")
_ENTRY = "struct<valence:int,polarity:int,subjectivity:int>"

# The default word list.
# token, valence in tenths, polarity and subjectivity in thousandths.
#
# Origin: written down from memory of English sentiment words. Many numbers follow, as
# far as remembered, the two published lexicons in common use: that of VADER (C. Hutto
# and E. Gilbert, 2014, MIT licence) for valences, and the English one of the Pattern
# library (T. De Smedt and W. Daelemans, 2012, BSD licence) for polarities. Credit for
# those values is theirs. They were not compared with the originals.
DEFAULT_ENTRIES = """
amazing 28 600 900
angry -23 -500 1000
annoying -18 -800 900
awesome 31 1000 1000
awful -20 -1000 1000
bad -25 -700 667
beautiful 29 850 1000
best 32 1000 300
better 19 500 500
boring -13 -1000 1000
brilliant 28 900 1000
broken -21 -400 400
bug -10 -200 200
calm 13 300 750
clever 20 167 833
clown -15 -400 700
cool 13 350 650
crash -17 -400 300
crazy -14 -600 900
cruel -28 -1000 1000
dangerous -21 -600 900
delightful 28 1000 1000
dirty -19 -600 800
disappointed -21 -750 750
disappointing -22 -600 700
disgusting -24 -1000 1000
dumb -23 -375 500
easy 19 433 833
enjoy 22 400 500
error -15 -200 100
evil -34 -1000 1000
excellent 27 1000 1000
excited 14 375 750
exciting 22 300 800
fail -25 -500 300
failure -23 -317 300
fake -21 -500 1000
fantastic 26 400 900
fast 5 200 600
fear -22 -300 600
fine 8 417 500
free 23 400 800
friendly 22 375 500
fun 23 300 200
funny 19 250 1000
glad 20 500 1000
good 19 700 600
grateful 20 500 600
great 31 800 750
happy 27 800 1000
harm -25 -400 500
hate -27 -800 900
helpful 18 300 400
hilarious 17 500 1000
hope 19 300 400
hopeless -20 -500 700
horrible -25 -1000 1000
hurt -24 -400 500
idiot -23 -800 800
ignorant -11 -400 600
important 8 400 1000
impressive 23 1000 1000
incredible 20 900 900
innovative 19 500 1000
insane -17 -1000 1000
inspiring 18 500 500
interesting 17 500 500
joy 28 800 200
kind 24 600 900
lazy -15 -250 1000
liar -23 -600 700
lie -16 -300 400
lies -18 -300 400
like 15 200 300
lol 18 800 700
lonely -15 -100 200
loser -24 -200 300
lost -13 -200 300
love 32 500 600
lovely 28 500 750
lucky 18 333 833
mad -22 -625 1000
mess -15 -175 400
misleading -17 -500 600
moron -22 -800 1000
nasty -26 -1000 1000
nice 18 600 1000
pain -23 -400 400
pathetic -27 -1000 1000
perfect 27 1000 1000
pleasant 23 733 967
pleased 19 500 1000
poor -21 -400 600
powerful 18 300 1000
pretty 22 250 1000
problem -17 -200 200
proud 21 800 1000
quick 5 333 500
rude -20 -300 600
sad -21 -500 1000
safe 19 500 500
scam -27 -600 600
scared -19 -400 700
scary -22 -500 1000
scum -25 -900 900
shame -21 -400 500
sick -23 -714 857
silly 1 -500 875
slow -8 -300 400
smart 17 214 643
sorry -3 -500 1000
strong 23 433 733
stupid -24 -800 1000
success 27 300 0
superb 31 1000 1000
support 17 200 200
sweet 20 350 650
terrible -21 -1000 1000
terrific 21 200 700
thank 15 300 300
thanks 19 200 200
threat -24 -400 400
tired -19 -400 700
toxic -20 -500 600
trash -19 -600 700
trouble -17 -200 200
true 18 350 650
trust 23 400 400
ugly -23 -700 1000
unfair -21 -500 1000
upset -16 -500 700
useful 19 300 0
useless -18 -500 200
vile -31 -900 900
weak -19 -375 625
weird -7 -500 1000
win 28 800 400
wonderful 27 1000 1000
worried -12 -300 500
worse -21 -400 600
worst -31 -1000 1000
worthless -19 -800 900
wow 28 100 1000
wrong -21 -500 900
yes 17 300 300
"""


def default_lexicon(spark: SparkSession) -> DataFrame:
    """The word list that ships with the library."""
    rows = [line.split() for line in DEFAULT_ENTRIES.split("\n") if line]
    return lexicon_from_rows(spark, [(w, int(v), int(p), int(s)) for w, v, p, s in rows])


def lexicon_from_rows(spark: SparkSession, rows: list[tuple[str, int, int, int]]) -> DataFrame:
    """A lexicon from (token, valence tenths, polarity and subjectivity thousandths)."""
    return spark.createDataFrame(rows, LEXICON)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A lexicon from CSV files with a header."""
    return spark.read.schema(LEXICON).option("header", True).csv(path)


class TokenIndex:
    """A small lexicon as a constant expression."""

    def __init__(self, slots: int, table: str):
        self.slots = slots
        self._table = F.from_json(F.lit(table), f"array<map<string,{_ENTRY}>>")

    def entry(self, token: Column) -> Column:
        """The lexicon entry of a lower-case token, NULL where it has none."""
        slot = F.hash(token).bitwiseAND(F.lit(self.slots - 1))
        return F.get(self._table, slot)[token]


def check_lexicon(lexicon: DataFrame) -> None:
    """A token has one entry: repeated tokens are an error, however large the lexicon."""
    repeated = lexicon.filter(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = [row["token"] for row in repeated.orderBy("token").limit(5).collect()]
    if found:
        raise ValueError(f"repeated tokens in the lexicon: {', '.join(found)}")


def build_index(lexicon: DataFrame) -> TokenIndex | None:
    """Index a lexicon that is proven small; None for a larger one."""
    entries = _size_within(lexicon, MAX_INDEX_ROWS, MAX_INDEX_CHARS)
    if entries is None:
        return None
    slots = 1 << max(0, entries.bit_length())
    by_slot = (
        _entries(lexicon)
        .groupBy(F.hash("token").bitwiseAND(F.lit(slots - 1)).alias("slot"))
        .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("token", "entry")))).alias("entries"))
    )
    filled = {row["slot"]: row["entries"] for row in by_slot.collect()}
    return TokenIndex(slots, "[" + ",".join(filled.get(i, "{}") for i in range(slots)) + "]")


def _size_within(lexicon: DataFrame, max_rows: int, max_chars: int) -> int | None:
    """The number of entries, None when they or their tokens are more than that."""
    size = lexicon.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("entries"), F.sum(F.length("token")).alias("chars")).first()
    return None if size["entries"] > max_rows or (size["chars"] or 0) > max_chars else size["entries"]


def _entries(lexicon: DataFrame) -> DataFrame:
    entry = F.struct(
        F.col("valence_tenths").alias("valence"),
        F.col("polarity_thousandths").alias("polarity"),
        F.col("subjectivity_thousandths").alias("subjectivity"),
    )
    return lexicon.filter(F.col("token").isNotNull()).select("token", entry.alias("entry"))


def with_hits(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "text",
    hit_facts: Mapping[str, Callable[[Column, Column], Column]] | None = None,
    text_facts: Mapping[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """Add ``_hits``, the tokens found in the lexicon as (pos, entry, facts), and the ``_count`` of all tokens.

    ``_unscored`` tells a NULL text from one without tokens.

    Facts are functions of the token array and of a hit's position, or of the token
    array and all hits. They are taken here because the array goes no further: passing it on from step to step
    costs as much as the lookup.
    """
    hit_facts, text_facts = hit_facts or {}, text_facts or {}

    def hit(words: Column, pos: Column, entry: Column) -> Column:
        facts = [fact(words, pos).alias(name) for name, fact in hit_facts.items()]
        return F.struct(pos.alias("pos"), entry.alias("entry"), *facts)

    def found(words: Column, hits: Column) -> Column:
        def describe(known: Column) -> Column:
            facts = [fact(words, known).alias(name) for name, fact in text_facts.items()]
            count = F.size(words).cast("bigint").alias("_count")
            return F.struct(known.alias("_hits"), count, F.isnull(words).alias("_unscored"), *facts)

        return F.get(F.transform(F.array(hits), describe), F.lit(0))

    check_lexicon(lexicon)
    index = build_index(lexicon)
    if index is None and df.isStreaming:
        raise ValueError("a lexicon this large is joined: score a stream within each micro-batch (feed.start_scoring does)")
    if index is None:
        lexicon = stored(_occurring(df, lexicon, text), "lexicon")
        index = build_index(lexicon)
    if index is None:
        nothing = F.array().cast(f"array<struct<pos:int,entry:{_ENTRY}>>")

        def joined_hits(words: Column) -> Column:
            hits = F.when(words.isNotNull(), F.coalesce("_joined_hits", nothing))
            return found(words, F.transform(hits, lambda h: hit(words, h["pos"], h["entry"])))

        joined = _join_hits(df, lexicon, text).select(*df.columns, once(tokens(F.col(text)), joined_hits).alias("_found"))
        return joined.select(*df.columns, "_found.*")

    def look_up(words: Column) -> Column:
        def entry_hit(token: Column, pos: Column) -> Column:
            entry = index.entry(F.lower(token))
            return F.when(entry.isNotNull(), hit(words, pos, entry))

        return found(words, F.filter(F.transform(words, entry_hit), lambda h: h.isNotNull()))

    looked_up = df.select(*df.columns, once(tokens(F.col(text)), look_up).alias("_found"))
    return looked_up.select(*df.columns, "_found.*")


def _occurring(df: DataFrame, lexicon: DataFrame, text: str) -> DataFrame:
    """The entries whose token some text has: every task sends each of its different tokens once."""
    words = df.select(F.explode(tokens(F.col(text))).alias("token")).select(F.lower("token").alias("token")).distinct()
    return lexicon.join(words, "token", "left_semi").select(*lexicon.columns)


def _join_hits(df: DataFrame, lexicon: DataFrame, text: str) -> DataFrame:
    """The same for a lexicon of any size: join the tokens, then gather each row's ``_joined_hits``.

    Rows are numbered and stored, so that what is sent carries eight bytes of its row, and once.
    A lexicon that may be broadcast meets the texts where their hits are gathered: only texts
    move. Of a larger one tokens and hits move too, salted by row and position against frequent
    tokens, those of texts with very many copies among them. A text is one cell, so its gathered
    hits are no larger than the text itself.
    """
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "texts")
    entries = _entries(lexicon).select("token", "entry.*")
    word = F.lower("_word") == F.col("token")
    # by number, which keeps Spark from putting partitions together: tokens are many times their texts
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if _size_within(lexicon, MAX_BROADCAST_ROWS, MAX_BROADCAST_CHARS) is not None:
        found = _spread(rows.repartition(parts, "_row"), text).join(F.broadcast(entries), word)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salt = F.pmod(F.col("_row") + F.col("pos"), F.lit(SALTS)) == F.col("_salt")
        # not broadcast, however small Spark takes it for: its estimate leaves the salts out
        salted = entries.withColumn("_salt", salts).hint("merge")
        found = _spread(rows, text).join(salted, word & salt).select("_row", "pos", *_FIELDS).repartition(parts, "_row")
    hit = F.struct("pos", F.struct(*_FIELDS).alias("entry"))
    hits = found.groupBy("_row").agg(F.sort_array(F.collect_list(hit)).alias("_joined_hits"))
    return rows.join(hits, "_row", "left").select(*df.columns, "_joined_hits")


def _spread(rows: DataFrame, text: str) -> DataFrame:
    return rows.select("_row", F.posexplode(tokens(F.col(text))).alias("pos", "_word"))
