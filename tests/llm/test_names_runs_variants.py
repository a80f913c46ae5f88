"""Block naming, periodic runs and spelling variants against plain versions, and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodline.llm import block_names, periodic_runs, trie_frontier
from moodline.llm.hot import attached
from moodline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = re.compile(r"[\x20\x09-\x0D]")
# Further columns with names that the operators use inside.
CLASHING = "row local block place name level size word n node rest edits near kept runs".split()
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in CLASHING])


def sentence(n: int, seed: int, vocabulary: int = 300) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def odd_texts() -> list[tuple]:
    copy, long_text = sentence(300, 1), sentence(40_000, 2, 5000)
    loop = "one two three four five " * 9
    texts = [None, "", " \n\t", "one", "o n\ne", copy, copy.replace(" ", "  "), copy + "x", long_text, long_text[:-1], loop,
             "a b " * 6 + "a b c", "x " * 12, "x " * 11, loop + "six " + loop, "   \x1c", "café " * 8, "variant Variant varian vvariant varient À×÷ÿééé " * 7]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[10], (None, copy), (None, None), (30, "variant " * 60)]


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return table_of(spark, odd_texts()).cache()


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- joins with frequent keys


def test_attached_joins_frequent_and_rare_keys(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id").cache()
    table = rows.groupBy("k").agg(F.count("*").alias("size"), F.min("id").alias("least")).cache()
    got = attached(rows, table, ["k"], "size", 6000)
    assert tuples(got.select("id", "k", "size", "least")) == tuples(rows.join(table, "k").select("id", "k", "size", "least"))
    assert table.where("size * 1000 > 6000").count() == 1


# --- block naming


def plain_groups(rows):
    by = defaultdict(list)
    for i, text in rows:
        by[BLANK.sub("", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for body, members in by.items():
        keep = min(members)
        mark = hashlib.sha256(body.encode()).hexdigest()
        kept = 0
        for m in sorted(members):
            out.append((m[3], keep[3], len(members), m == keep and not kept, mark))
            kept += m == keep
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_block_names(spark, odd, block):
    rows = [r for r in odd_texts() if block > 1 or len(r[1] or "") < 5000]
    docs = odd if block > 1 else table_of(spark, rows)
    got = block_names.groups(docs, block=block).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert tuples(got) == plain_groups(rows)


def test_names_are_identities_of_sequences(spark):
    """Every sequence of two letters up to length six, in blocks of one byte."""
    texts = [format(x, "b")[1:] for x in range(1, 128)]
    docs = table_of(spark, [(i, t) for i, t in enumerate(texts * 2)]).repartition(5)
    found = block_names.identities(docs, block=1).collect()
    by = defaultdict(set)
    for r in found:
        by[r["level"], r["name"]].add(r["doc_id"] % len(texts))
    assert len(found) == 2 * len(texts) and len(by) == len(texts) and all(len(ids) == 1 for ids in by.values())


def test_one_document_of_each_group_stays(spark, odd):
    kept = block_names.distinct_documents(odd)
    assert kept.columns == odd.columns
    bodies = [BLANK.sub("", r["text"] or "") for r in kept.collect()]
    assert sorted(bodies) == sorted({BLANK.sub("", t or "") for _, t in odd_texts()})


def test_a_group_of_copies_that_holds_a_third(spark):
    rows = [(i, "same text " * 400 if i % 3 == 0 else sentence(20, i)) for i in range(1500)]
    got = block_names.groups(table_of(spark, rows).repartition(7), block=256)
    assert tuples(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == plain_groups(rows)


def test_blocks_are_sorted_without_a_second_exchange(spark, odd):
    """One range exchange serves the sort and the window over equal blocks."""
    blocks = odd.select(F.col("text").cast("binary").alias("block")).repartitionByRange("block").sortWithinPartitions("block")
    from pyspark.sql import Window

    plan = blocks.withColumn("at", F.monotonically_increasing_id()).select(F.min("at").over(Window.partitionBy("block")))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


# --- periodic runs


def plain_runs(s, least=12):
    n, out = len(s), set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and s[j] == s[j + p]:
                j += 1
            length = j - i + p
            if length >= max(least, 2 * p) and not any(all(s[k] == s[k + q] for k in range(i, i + length - q)) for q in range(1, p)):
                out.add((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(i, words):
    if i is None or not words or zlib.crc32(str(i).encode()) % 10:
        return words
    g, n = zlib.crc32(str(i).encode()) // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def plain_digest(i, text):
    words = planted(i, WORD.findall(text or ""))
    runs = plain_runs(words)
    gone = {k for a, length, p in runs for k in range(a + p, a + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    mark = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            mark("".join(f"{a},{b},{c}\n" for a, b, c in runs)), mark(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_runs_of_random_sequences():
    pick = random.Random(3)
    for _ in range(1500):
        n, k = pick.randrange(60), pick.choice([1, 2, 3, 5])
        s = [pick.randrange(1, k + 1) for _ in range(n)]
        if n and pick.random() < 0.5:
            a, p = pick.randrange(n), pick.randrange(1, 9)
            s = [x if i < a else s[a + (i - a) % min(p, n - a)] for i, x in enumerate(s)]
        assert [tuple(r) for r in periodic_runs.runs_of(s).tolist()] == plain_runs(s)
        assert [tuple(r) for r in periodic_runs.word_runs([b"w%d" % x for x in s]).tolist()] == plain_runs(s)


def test_extensions_of_a_suffix_tree():
    pick = random.Random(4)
    s = [pick.randrange(1, 4) for _ in range(300)]
    pairs = [(a, b) for a in range(0, 301, 7) for b in range(0, 301, 5) if a != b]
    got = periodic_runs.SuffixTree(s).extensions(*map(__import__("numpy").array, zip(*pairs))).tolist()
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(s[a:] + [0], s[b:] + [0])) if x != y), 0)
    assert got == [common(a, b) for a, b in pairs]


def test_run_digests(spark, odd):
    rows = [(i, t) for i, t in odd_texts() if len(t or "") < 5000]
    rows += [(100 + i, sentence(70, i, 9)) for i in range(60)]
    docs = periodic_runs.with_planted_runs(table_of(spark, rows))
    got = periodic_runs.digests(periodic_runs.periodic_runs(docs))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert tuples(got) == sorted((plain_digest(*r) for r in rows), key=repr)


def test_runs_of_a_very_long_text(spark):
    parts = [f"u{i}" for i in range(20_000)]
    docs = table_of(spark, [(1, " ".join(parts + parts[-5000:] * 3))])
    row = periodic_runs.periodic_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(15_000, 20_000, 5000)] and row["text"] == " ".join(parts)


# --- spelling variants


def plain_variants(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for j in range(len(w)):
            holes[w[:j], w[j + 1 :]].add(w)
            if w[:j] + w[j + 1 :] in n:
                near[w].add(w[:j] + w[j + 1 :])
                near[w[:j] + w[j + 1 :]].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n), key=repr)


def test_variants(spark, odd):
    assert tuples(trie_frontier.variants(odd, slips=199)) == plain_variants(odd_texts())


def test_variants_of_words_that_differ_little(spark):
    """Words of few letters share long prefixes and suffixes; counts make chains of forms."""
    pick = random.Random(5)
    words = {"".join(pick.choice("ab") for _ in range(pick.randrange(6, 11))) for _ in range(220)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaa"}
    rows = [(i, (w + " ") * pick.choice([5, 6, 30, 150, 800])) for i, w in enumerate(sorted(words))]
    assert tuples(trie_frontier.variants(table_of(spark, rows), slips=199)) == plain_variants(rows)


def test_variants_with_shuffled_edges(spark, odd, monkeypatch):
    monkeypatch.setattr(trie_frontier, "BROADCAST_EDGES", 0)
    assert tuples(trie_frontier.variants(odd, slips=199)) == plain_variants(odd_texts())


def test_variants_of_a_table(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert tuples(QUERIES["op13_spelling_variants"](spark, small_dir)) == plain_variants(rows)


# --- empty tables


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert block_names.groups(none).count() == 0 and block_names.distinct_documents(none).count() == 0
    assert periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(none))).count() == 0
    assert trie_frontier.variants(none, slips=199).count() == 0
