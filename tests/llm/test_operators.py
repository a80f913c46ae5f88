"""The operators for training data against plain versions, and on odd tables."""

import gzip
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import difference, duck
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from moodline.llm import cotraining, curriculum, line_chunks, ngram_join, nn_descent, packing, quality_rules, site_style, toxicity, warc
from moodline.llm.components import components
from moodline.llm.oracle import ORACLE_SQL
from moodline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside.
        T.StructField("row", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("_k1", T.LongType()),
    ]
)
LABELS = "doc_id long, quality int, toxic int, label string"


def words(n: int, seed: int, vocabulary: int = 500) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    long_text = words(30_000, 1, 5000)
    copy = words(80, 2)
    lines = "\n".join(words(6, 100 + i) for i in range(12))
    texts = [None, "", "   \n\t", "one", "one two", copy, copy, copy + " end", "new first line here\n" + lines, lines, lines + "\nlast", long_text, "a b   c\x0bd", "<|endoftext|> it's 5€ \U0001f600", words(60, 9) + "\n" + copy]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 3}", None if i % 5 == 0 else 7, "r", 1, 2, "l", 3, 4) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[11], (None, copy, "en", "s1", 1, "r", 1, 2, "l", 3, 4), (None, None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, small_dir, name):
    assert difference(QUERIES[name](spark, small_dir), ORACLE_SQL[name], duck(small_dir)) is None


# --- n-gram join


def plain_sets(rows, k):
    out = {}
    for i, text in rows:
        found = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        out[i] = frozenset(tuple(found[j : j + k]) for j in range(max(1, len(found) - k + 1))) if found else frozenset()
    return out


def plain_components(rows, k, percent):
    sets = plain_sets(rows, k)
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                label[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(n, edits, length, seed):
    pick, base = random.Random(seed), words(length, seed, 10**6).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(pick.randrange(edits + 1)):
            copy[pick.randrange(length)] = f"e{pick.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("hot, block", [(64, 512), (3, 4)])
def test_ngram_join_finds_every_link(spark, monkeypatch, k, percent, hot, block):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = [*near_copies(40, 4, 120, 3), *near_copies(12, 2, 40, 4), *[words(50, i) for i in range(20)], "", "a", "A", "a b", None, "B  a\tb", words(9000, 77)]
    rows = list(enumerate(texts))
    found = ngram_join.linked(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert got == plain_components(rows, k, percent)


def test_prefix_lengthens_where_shingles_are_frequent():
    tokens = np.arange(1, 201, dtype=np.uint64)
    rare, frequent = np.ones(200, dtype=np.int64), np.full(200, 10_000, dtype=np.int64)
    _, p, l = ngram_join.prefix(tokens, rare, 1.0, 90)
    assert (p, l) == (21, 1)
    ordered, p, l = ngram_join.prefix(tokens, frequent, 1.0, 90)
    assert l > 1 and p == 200 - 180 + l and sorted(ordered) == sorted(tokens)


def test_ngram_join_on_odd_tables(odd, none):
    rows = ngram_join.linked(odd, 3, 90).collect()
    assert len(rows) == odd.count()
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in rows}
    assert by[(6, 78)] == 5 and by[(7, 79)] == 5 and by[(None, 78)] == 5 and by[(0, 0)] == 0 and by[(None, 0)] is None
    assert ngram_join.linked(none, 3, 90).count() == 0
    kept = ngram_join.one_of_each(odd, 3, 90)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {6, 7}.isdisjoint(ids) and ids.count(5) == 1 and ids.count(11) == 1 and ids.count(None) == 2
    assert ngram_join.one_of_each(none, 3, 90).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 5), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, 9: 5}


# --- quality rules


def test_repeated_words_by_hand(spark):
    five = "a b c d e"
    texts = [five, f"{five} {five}", f"{five} x {five}", "z " * 12, f"{five} q {five} r s", words(12_000, 3, 9)]

    def plain(text):
        w = WORD.findall(text)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        n = Counter(windows)
        return len({p for i, x in enumerate(windows) if n[x] > 1 for p in range(i, i + 5)})

    rows = quality_rules.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id")
    assert {r["doc_id"]: r["n_repeat_words"] for r in rows.collect()} == {i: plain(t) for i, t in enumerate(texts)}


def test_ledger_on_odd_tables(odd, none):
    rows = quality_rules.apply_policy(quality_rules.ledger(odd, "doc_id"))
    assert rows.count() == odd.count()
    empty = [r for r in rows.collect() if r["doc_id"] == 0][0]
    assert empty["n_words"] == 0 and empty["base_failed"] and not empty["kept"]
    kept = quality_rules.accepted(odd)
    assert kept.columns == odd.columns and kept.count() == rows.where("kept").count()
    assert quality_rules.accepted(none).count() == 0 and quality_rules.ledger(none, "doc_id").count() == 0


def test_ablation_counts_what_each_rule_alone_rejects(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = quality_rules.ledger(docs, "doc_id")
    masks = [r["failed"] for r in rows.collect()]
    for r in quality_rules.ablation(rows).collect():
        bit = quality_rules.RULE_BITS[r["rule"]]
        assert r["n_failed"] == sum(bool(m & bit) for m in masks) and r["n_only"] == sum(m == bit for m in masks)


# --- line chunks


def test_line_chunks_on_odd_tables(odd, none):
    out = line_chunks.without_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    by = defaultdict(list)
    for r in line_chunks.deduplicated(odd).collect():
        by[r["doc_id"]].append((r["n_removed"], r["text"]))
    assert by[0] == [(0, None)] and by[1] == [(0, "")] and by[3] == [(0, "one")]
    copy = odd_rows()[5][1]
    # The row without doc_id sorts first and keeps the text; later copies lose it, repeated rows alike.
    assert sorted(by[5]) == [(1, ""), (1, "")] and by[6] == [(1, "")]
    assert sorted(by[None], key=repr) == [(0, copy), (0, None)]
    assert by[14] == [(1, words(60, 9))]
    assert line_chunks.without_repeats(none).count() == 0


def test_chunks_resist_shifts(spark):
    lines = [words(5, i) for i in range(60)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["something else on top", *lines]))]
    out = {r["doc_id"]: r["text"] for r in line_chunks.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == rows[0][1] and out[2].startswith("something else on top") and len(out[2].split("\n")) < 15


def test_repeated_passages_lose_all_their_lines(spark):
    rows, left = [], {}
    for i in range(40):
        passage = [words(n, 1000 + 10 * i + j) for j, n in enumerate((25, 25, 3) if i % 2 else (43, 49))]
        around = [words(20, 5000 + 10 * i + j) for j in range(4)]
        rows += [(i, "\n".join([*around[:1], *passage, *around[1:2]])), (100 + i, "\n".join([*around[2:3], passage[0], "", *passage[1:], *around[3:]]))]
        left |= {i: rows[-2][1], 100 + i: "\n".join(around[2:])}
    few = [words(24, 9001), words(26, 9002)]
    # Fifty words are not over fifty; a lone line under fifty is no passage.
    rows += [(200, few[0] + "\n" + words(7, 9003)), (201, few[0] + "\nother")]
    left |= {200: rows[-2][1], 201: rows[-1][1]}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r["doc_id"]: r["text"] for r in line_chunks.without_repeats(docs).collect()} == left
    fifty = spark.createDataFrame([(i, "\n".join([*few, words(9, 9100 + i)])) for i in range(3)], "doc_id long, text string")
    assert not any(s["run"] for r in line_chunks.repeated(fifty).collect() for s in r["spans"])


def test_spans_with_equal_hashes_are_told_apart(spark, monkeypatch):
    span = line_chunks._span
    monkeypatch.setattr(line_chunks, "_span", lambda run, first, last, n, hashes: span(run, first, last, n, (F.lit(0).cast("long"), F.lit(0).cast("long"))))
    a, b = words(60, 7001), words(60, 7002)
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (4, b + "\n" + a)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in line_chunks.without_repeats(docs).collect()} == {1: a, 2: b, 3: "", 4: b}


def test_a_passage_in_a_third_of_all_rows(spark):
    """More copies than one salt takes, and more than a thousandth of all spans."""
    passage = "\n".join(words(30, 7100 + i) for i in range(3))
    rows = [(i, (passage + "\n" if i % 3 == 0 else "") + f"line of {i}\nand of {i * i + 7}") for i in range(6000)]
    left = {r["doc_id"]: r["text"] for r in line_chunks.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert left == {i: t.removeprefix(passage + "\n") if i else t for i, t in rows}


def test_native_operators_run_no_python(odd):
    for df in (quality_rules.accepted(odd), line_chunks.without_repeats(odd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


# --- curriculum


def test_targets_are_filled_by_weight():
    assert curriculum._filled([10, 10, 10], [1, 2, 3]) == [5.0, 10.0, 15.0]
    filled = curriculum._filled([1, 100, 1], [1, 2, 3])
    assert filled[0] == 3 and filled[2] == 3 and filled[1] == pytest.approx(96)
    assert curriculum._filled([0, 0], [1, 2]) == [0.0, 0.0] and curriculum._filled([], []) == []


def test_plan_takes_what_the_targets_say(spark, medium_dir, monkeypatch):
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 7)
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    rows = curriculum.plan(docs).collect()
    again = curriculum.plan(docs.repartition(3)).collect()
    key = lambda r: (r["doc_id"], r["taken"], r["position"])
    assert sorted(map(key, rows), key=repr) == sorted(map(key, again), key=repr)
    sizes = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    per = defaultdict(list)
    for r in rows:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] <= 3 * r["size"]
        per[r["source"]].append(r)
    names = sorted(per, key=lambda s: (s is None, s or ""))
    want = curriculum._filled([sum(r["size"] for r in per[s]) for s in names], [1 + i % 3 for i in range(len(names))])
    for s, t in zip(names, want):
        assert per[s][0]["target"] == pytest.approx(t) and 0 <= t - sum(r["taken"] for r in per[s]) < 1
    assert all((r["position"] is None) == (r["taken"] == 0) and 0 <= (r["position"] or 0) <= 1 for r in rows)


def test_position_inverts_the_schedule(spark):
    for kind, points in enumerate(curriculum.SCHEDULE):
        t = np.linspace(0, 1, 200_001)
        weight = np.interp(t, [p[0] for p in points], [p[1] for p in points])
        spent = np.concatenate(([0], np.cumsum((weight[1:] + weight[:-1]) / 2)))
        shares = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
        df = spark.createDataFrame([(x, kind) for x in shares], "share double, kind int").select(curriculum._position(F.col("share"), F.col("kind")))
        assert [r[0] for r in df.collect()] == pytest.approx([np.interp(x, spent / spent[-1], t) for x in shares], abs=1e-4)


def test_mix_repeats_and_cuts(odd, none):
    plan = curriculum.plan(odd)
    assert plan.count() == odd.count() and plan.where("size = 0 AND taken > 0").count() == 0
    mix = curriculum.mixed(odd)
    assert mix.columns == odd.columns
    got = sum(len(WORD.findall(r["text"])) for r in mix.collect())
    assert got == plan.agg(F.sum("taken")).first()[0]
    assert curriculum.plan(none).count() == 0 and curriculum.mixed(none).count() == 0


# --- packing


def test_pieces_are_the_tokenizers(odd, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    want = []
    for row in odd_rows():
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], dtype="<u4")
            want.append((row[0], piece, at, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack(odd)
    assert tuples(rows.select("doc_id", "piece", "start", "length", "ids_crc32")) == sorted(want, key=repr)
    assert packing.pack(none).count() == 0


def assert_gapless(rows, capacity=4096):
    per = defaultdict(list)
    for r in rows:
        per[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in per.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(per)


def test_packing_is_gapless_and_tight(spark, medium_dir, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", 3)
    rows = packing.pack(spark.read.parquet(f"{medium_dir}/documents.parquet")).collect()
    total = sum(r["length"] for r in rows)
    assert assert_gapless(rows) <= -(-total // 4096) + 1


def test_sequences_hold_the_ids_of_their_pieces(spark, odd, none, tmp_path):
    rows = packing.pack(odd).cache()
    packing.write_sequences(rows, str(tmp_path / "s"))
    written = spark.read.parquet(str(tmp_path / "s")).collect()
    ids = {r["sequence_id"]: np.frombuffer(r["ids"], dtype="<u4") for r in written}
    assert len(ids) == len(written) and all(len(ids[r["sequence_id"]]) == r["length"] <= 4096 for r in written)
    for r in rows.collect():
        part = ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert part.tobytes() == bytes(r["ids"]) and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    assert sum(map(len, ids.values())) == rows.agg(F.sum("length")).first()[0]
    last = corpus_pipeline.STAGES[-1][1](spark, odd, "")
    assert tuples(last.select("doc_id", "piece", F.crc32("ids"))) == tuples(last.select("doc_id", "piece", "ids_crc32"))
    assert packing.sequences(packing.pack(none)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_counts_are_used_up(seed):
    pick = random.Random(seed)
    counts = {pick.randrange(1, 65): pick.randrange(1, 400) for _ in range(pick.randrange(1, 50))}
    patterns = packing.pack_counts(counts, 64)
    used = Counter()
    for slots, times in patterns:
        assert sum(x * n for x, n in slots) <= 64 and times > 0
        for x, n in slots:
            used[x] += n * times
    assert used == counts and len(patterns) <= 65 + 64


def test_exact_complements_come_first():
    patterns = packing.pack_counts({40: 5, 24: 3, 20: 2, 10: 1, 14: 1}, 64)
    assert patterns[0] == (((40, 1), (24, 1)), 3) and (((40, 1), (14, 1), (10, 1)), 1) in patterns


# --- models


def test_toxicity_learns_and_survives(spark, medium_dir, odd, none):
    docs, labels = (spark.read.parquet(f"{medium_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["toxic"] == t] for t in (0, 1))
    assert np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good]) > 0.85
    few = spark.createDataFrame([(5, 1, 1, "x"), (5, 1, 0, "x"), (None, 1, 1, "x"), (6, None, None, "x")], LABELS)
    for table, n in ((odd, odd.count()), (none, 0)):
        scored = toxicity.scored(table, few).collect()
        assert len(scored) == n and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
    assert toxicity.scored(odd, spark.createDataFrame([], LABELS)).where("score = 0").count() == odd.count()


def test_toxicity_features():
    facts = toxicity._Facts({"idiot": 2.0})
    plain_one, hidden, near = (toxicity.features(t, facts) for t in ("an idiot here", "an 1d10t here", "you idiot " + "pad " * 30))
    assert plain_one[0] == hidden[0] == 1 and hidden[9] > 0 == plain_one[9]
    assert near[6] == 1 and plain_one[6] == 0 and toxicity.features(None, facts) == [0.0] * toxicity.FEATURES


def test_cotraining_learns_and_survives(spark, medium_dir, odd, none):
    docs, labels = (spark.read.parquet(f"{medium_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = cotraining.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in rows]) > 0.95
    few = spark.createDataFrame([(5, 1, 1, "x"), (None, 0, 1, "x"), (6, None, None, "x")], LABELS)
    assert cotraining.scored(odd, few).where("kept").count() == odd.count() and cotraining.scored(none, few).count() == 0


def test_confident_labels_are_handed_over_by_class_and_source(spark):
    pick = random.Random(4)
    rows = [(i, i % 3 if i % 50 else 7, [1.0], [1.0], pick.choice([None, None, 0.0, 1.0]), None, pick.uniform(-8, 8), pick.choice([-5.0, -2.0, 3.5, 3.6])) for i in range(400)]
    names = ["doc_id", "bucket", "content", "page", "by_content", "by_page", "at_content", "at_page"]
    pool = spark.createDataFrame(rows, "doc_id long, bucket int, content array<double>, page array<double>, by_content double, by_page double, at_content double, at_page double")
    want, least = {}, {("content", 0.0): 14, ("content", 1.0): 0, ("page", 1.0): 0}
    for view in ("content", "page"):
        groups = defaultdict(list)
        for r in (dict(zip(names, r)) for r in rows):
            m = r[f"at_{view}"]
            want[r["doc_id"], view] = r[f"by_{view}"]
            if r[f"by_{view}"] is None and abs(m) >= np.log(0.95 / 0.05) and int(abs(m) * 4) >= least.get((view, float(m > 0)), 99):
                groups[r["bucket"], m > 0].append((int(abs(m) * 4), r["doc_id"]))
        for (_, good), found in groups.items():
            cut = sorted((level for level, _ in found), reverse=True)[(len(found) + 1) // 2 - 1]
            want.update({(i, view): float(good) for level, i in found if level >= cut})
    got = {(r["doc_id"], v): r[f"by_{v}"] for r in cotraining.handed_over(pool, least).collect() for v in ("content", "page")}
    assert got == want and sum(w is not None for w in want.values()) > 200
    fold = spark.createDataFrame([(1.0, 6.0, 3.0)] * 40 + [(0.0, 4.0, -3.0)] * 4 + [(0.0, -9.0, 3.0)] * 4 + [(1.0, 3.5, -1.0)] * 60, "label double, at_content double, at_page double")
    assert cotraining.trusted_levels(fold) == {("content", 1.0): 14} and cotraining.trusted_levels(fold.where("false")) == {}


def test_every_unlabelled_document_may_take_part(spark, medium_dir, monkeypatch):
    """With few labelled rows in sight the pool is still whole, and labels of earlier rounds stay."""
    docs, labels = (spark.read.parquet(f"{medium_dir}/{t}.parquet") for t in ("documents", "labels"))
    pools, step = [], cotraining.handed_over
    monkeypatch.setattr(cotraining, "handed_over", lambda *given: pools.append(step(*given)) or pools[-1])
    monkeypatch.setattr(cotraining, "TRAIN_ROWS", 250)
    cotraining.scored(docs, labels)
    free = docs.join(labels.where("quality IS NOT NULL"), "doc_id", "left_anti").count()
    seen = [{(r["doc_id"], v): r[f"by_{v}"] for r in p.collect() for v in ("content", "page")} for p in pools]
    assert len(seen) == cotraining.ROUNDS and all(len(s) == 2 * free for s in seen)
    for before, after in zip(seen, seen[1:]):
        assert all(after[k] == label for k, label in before.items() if label is not None)
    assert sum(x is not None for x in seen[-1].values()) > sum(x is not None for x in seen[0].values()) > 0


# --- pages


def page(body):
    return f'<html><head><title>T</title><script>if (a<b) "</p>"</script></head><body>{body}</body></html>'


def test_main_text_of_pages(spark):
    shell = "<nav><a href=x>Menu</a></nav><div class='side-bar sidebar'>aside</div><header>Site</header>{}<footer>&copy; x</footer>"
    pages = [
        shell.format("<article><h1>A &amp; B</h1><p>one<br>two <b>bold<p>three</p><div class=comments>me too</div><form>mail</form></article>"),
        shell.format("<div class=ad>buy</div><div id='cookie-notice'>ok?</div><p>plain   text</p>"),
        "no markup at all < 5",
        "<p>open <i>tags <ul><li>x<li>y</ul> <!-- gone",
        "",
        None,
    ]
    rows = [(i, f"http://h{i}.org/a", page(p) if p else p, "u") for i, p in enumerate(pages)] + [(9, None, page("<p>x</p>"), "u"), (None, None, None, None)]
    got = {r["page_id"]: r["text"] for r in site_style.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert got == {0: "A & B one two bold three", 1: "plain text", 2: "no markup at all < 5", 3: "open tags x y", 4: "", 5: "", 9: "x", None: ""}


def test_branches_that_all_pages_share_are_removed(spark):
    rows = [(i, "http://one.org/a", page(f"<div class=box>Read more about us</div><div class=body><p>{words(30, i)}</p></div>")) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in site_style.extracted(df).collect()}
    assert got == {i: (words(30, i), len(words(30, i))) for i in range(12)}
    assert site_style.extracted(df.where("page_id < 0")).count() == 0
    same = spark.createDataFrame([(i, "http://two.org", page("<p>all the same</p>")) for i in range(12)], "page_id long, url string, html string")
    assert {r["text"] for r in site_style.extracted(same).collect()} == {"all the same"}


def test_markup_is_read_in_linear_time():
    for text in ("<" * 200_000, '<a b="' * 30_000, "<p>" * 2_000 + "x", "<!--" * 100_000, "&" * 100_000):
        site_style.main_text(text, frozenset())


@pytest.mark.parametrize("n", [5_001, 1_000_000])
def test_attributes_of_any_length(n):
    for quote in "\"'":
        value = f"data:{'/id/aB+' * (n // 7 + 1)}"[:n]
        body = f"<p>one</p><img src={quote}{value}{quote}><div id='x' class=sidebar data-x={quote}{value}{quote}>aside</div><p title={quote}{value}{quote}>two</p>"
        assert site_style.main_text(page(body), frozenset()) == "one two"
        assert warc.plain_text(body).split() == ["one", "aside", "two"]
    node = site_style.Node("div", f' class="sidebar" id="a" data-x="{value}"', None)
    assert node.noise and node.path == site_style.Node("div", ' class="sidebar" id="a"', None).path


def test_tags_without_end_are_read_in_linear_time():
    for text in ('<a "<a" ' + '"<a" ' * 100_000, "<p '<p' " + "'<p' " * 100_000, "<p \"<p '" * 60_000, "<p '" + "<p " * 100_000, '<script "' * 50_000):
        site_style.main_text(text, frozenset())
        warc.plain_text(text)


def test_noise_inside_a_paragraph_goes_alone():
    for wrap in ("{}", "<article>{}</article>"):
        for body, want in (
            ("<p><span class=notice>New</span> long article paragraph</p>", "long article paragraph"),
            ("<p>text <span class=ad>Buy <b>now</b></span> more</p>", "text more"),
            ("<p>text <button>Share</button></p><p><label>x</label></p>", "text"),
            ("<p>one<svg><text>no</text></svg>two <i>three</i></p>", "one two three"),
            ("<div class=ad><p>all <i>noise</i></p></div><p>rest</p>", "rest"),
        ):
            assert site_style.main_text(page(wrap.format(body)), frozenset()) == want
    assert site_style.main_text("<body>a<span role=main>kept</span>", frozenset()).endswith("kept")


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a.org/x\r\ny", "<p>one<p>two &lt;3<script>no</script>"), (2, None, None), (3, "", ""), (3, "", ""), (None, "http://b.org", "é\U0001f600")]
    source = warc.responses(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, headers string"))
    made = warc.derivatives(source)
    got = made.collect()
    assert len(got) == 2 * len(rows) and warc.derivatives(source.where("false")).count() == 0
    ids = {r["record_id"]: r for r in source.collect()}
    for r in got:
        origin, data = ids[r["refers_to"]], r["block"].encode()
        assert r["content_length"] == len(data) and r["block_digest"] == warc.digest(data)
        assert r["payload_digest"] == origin["payload_digest"] == warc.digest(bytes(origin["block"]).split(b"\r\n\r\n", 1)[1])
        assert f"WARC-Refers-To: {r['refers_to']}" in r["headers"] and f"WARC-Concurrent-To: {r['concurrent_to']}" in r["headers"]
        if r["warc_type"] == "metadata":
            assert f"source-block-digest: {origin['block_digest']}" in r["block"] and "http-header: Content-Type: text/html; charset=utf-8" in r["block"]
    texts = {r["page_id"]: r["block"] for r in got if r["warc_type"] == "conversion"}
    assert texts == {1: "one\ntwo <3", 2: "", 3: "", None: "é\U0001f600"}
    warc.write_records(made, str(tmp_path / "w"))
    back = sorted((r["headers"], bytes(r["block"]).decode()) for r in warc.read_records(spark, str(tmp_path / "w")).collect())
    assert back == sorted((r["headers"], r["block"]) for r in got)


def response(head: str, payload: bytes, uri: str = "http://a.org") -> tuple[str, bytes]:
    block = head.replace("\n", "\r\n").encode() + b"\r\n\r\n" + payload
    return f"WARC/1.1\r\nwarc-type: response\r\nWARC-Record-ID: <urn:x:{uri}>\r\nWARC-Target-URI: {uri}\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: {len(block)}", block


def test_records_of_other_writers(spark, tmp_path):
    start = b"x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\ny"
    cases = [
        ("HTTP/1.1 200 OK\nContent-Type: text/html; charset=iso-8859-1", b"<p>caf\xe9</p>", "caf\xe9"),
        ("HTTP/1.1 200 OK\nTransfer-Encoding: chunked\nContent-Type: text/html", b"2\r\nhi\r\n0\r\n\r\n", "hi"),
        ("HTTP/1.1 200 OK\ncontent-type: TEXT/HTML;charset=\"windows-1251\"", "<b>\u0434\u0430".encode("cp1251"), "\u0434\u0430"),
        ("HTTP/1.1 200 OK\nContent-Type: text/html", b"<meta charset=koi8-r><p>" + "\u0434\u0430".encode("koi8-r"), "\u0434\u0430"),
        ("HTTP/1.1 200 OK\nContent-Type: text/html\nContent-Encoding: gzip", gzip.compress("<p>\xfcber".encode()), "\xfcber"),
        ("HTTP/1.1 200 OK\nContent-Type: text/html\nContent-Encoding: deflate\nTransfer-Encoding: chunked", b"5;a=b\r\n" + (z := zlib.compress(b"<p>deep</p>"))[:5] + b"\r\n%x\r\n" % len(z[5:]) + z[5:] + b"\r\n0\r\n", "deep"),
        ("HTTP/1.1 200 OK\nContent-Type: text/html\nContent-Encoding: br", b"\x01\x02", ""),
        ("HTTP/1.1 200 OK\nContent-Type: image/png", b"\x89PNG\xff", ""),
        ("HTTP/1.1 200 OK\nContent-Type: text/plain", b"a <p> b", "a <p> b"),
        ("HTTP/1.1 200 OK\nContent-Type: text/html; charset=nonsense", "\ufeff<p>\xe9".encode(), "\xe9"),
        ("HTTP/1.1 200 OK\nTransfer-Encoding: chunked", b"<p>not chunked", "not chunked"),
        ("HTTP/1.1 200 OK\nContent-Type: text/plain", start, start.decode().replace("\r\n\r\n", "\n").replace("\r\n", "\n")),
        ("HTTP/1.1 204 No Content", b"", ""),
    ]
    made = [response(head, payload, f"http://a.org/{i}") for i, (head, payload, _) in enumerate(cases)]
    made.append(("WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 0", b""))
    for name, rows in (("spark", made), ("none", [])):
        warc.write_records(spark.createDataFrame(rows, "headers string, block binary").coalesce(2), str(tmp_path / name))
    # As other writers do it: one member for each record.
    (tmp_path / "members").mkdir()
    for i in range(2):
        (tmp_path / "members" / f"{i}.warc.gz").write_bytes(b"".join(gzip.compress(h.encode() + b"\r\n\r\n" + b + b"\r\n\r\n") for h, b in made[i::2]))
    for name in ("spark", "members"):
        read = warc.read_records(spark, str(tmp_path / name))
        assert sorted((r["headers"], bytes(r["block"])) for r in read.collect()) == sorted(made)
        source = warc.responses_of(read)
        got = {r["target_uri"]: r for r in warc.derivatives(source).where("warc_type = 'conversion'").collect()}
        assert {u: r["block"] for u, r in got.items()} == {f"http://a.org/{i}": text for i, (_, _, text) in enumerate(cases)}
        assert got["http://a.org/0"]["refers_to"] == "<urn:x:http://a.org/0>" and got["http://a.org/0"]["date"] == "2020-01-01T00:00:00Z"
        assert all(r["payload_digest"] is None for r in got.values())
    assert warc.read_records(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "0.warc.gz").write_bytes(gzip.compress(made[0][0].encode() + b"\r\n\r\n" + made[0][1][:-3]))
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_records(spark, str(tmp_path / "cut")).count()


# --- neighbours


def test_neighbours_of_odd_vectors(spark):
    pick = np.random.default_rng(5)
    rows = [(i, pick.standard_normal(8).tolist(), "x") for i in range(60)]
    rows[21] = (21, rows[20][1], "x")
    rows += [(100, None, "x"), (120, [0.0] * 8, "x"), (140, [1.0, None] * 4, "x"), (160, [float("nan")] * 8, "x"), (180, [1.0] * 3, "x"), (200, [], "x"), (None, [1.0] * 8, "x"), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = defaultdict(list)
    for r in nn_descent.search(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    x = np.array([r[1] for r in rows[:60]], dtype=np.float32).astype(float)
    for q in (0, 20, 40):
        s = x @ x[q]
        order = [int(i) for i in np.lexsort((np.arange(60), -s)) if i != q][:20]
        assert [v for v, _ in got[q]] == order and [p for _, p in got[q]] == pytest.approx(s[order])
    assert set(got) == {0, 20, 40}
    assert nn_descent.search(df.where("false")).count() == 0 and nn_descent.search(df.where("vec_id = 0")).count() == 0


def test_many_equal_vectors(spark):
    same = [1.0] + [0.0] * 7
    df = spark.createDataFrame([(i, same) for i in range(90)] + [(90, [0.5] * 8)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in nn_descent.search(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got == {q: [i for i in range(21) if i != q][:20] for q in (0, 20, 40, 60, 80)}


def test_recall_against_all_pairs(spark, medium_dir):
    vectors = spark.read.parquet(f"{medium_dir}/embeddings.parquet")
    rows = sorted((r["vec_id"], r["embedding"]) for r in vectors.collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    found = defaultdict(set)
    for r in nn_descent.search(vectors).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = [len(found[q] & set(ids[[j for j in np.argsort(-(x @ x[i]), kind="stable") if j != i][:20]].tolist())) / 20 for i, q in enumerate(ids) if q % 20 == 0]
    assert np.mean(hits) >= 0.9


# --- pipeline


def test_pipeline_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    numbers = [3, 8, 1, 7, 10]
    assert len(corpus_pipeline.STAGES) == len(numbers)
    kept = {r["doc_id"] for r in quality_rules.apply_policy(quality_rules.ledger(docs, "doc_id")).where("kept").collect()}
    now = docs
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, now = now, stage(spark, now, small_dir).cache()
        if at < 4:
            assert now.columns == docs.columns and [f.dataType for f in now.schema] == [f.dataType for f in docs.schema]
        if at == 0:
            assert {r["doc_id"] for r in now.collect()} == kept
        if at == 1:
            assert now.count() == before.count()
        if at == 2:
            parts = plain_components([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
            assert sorted(r["doc_id"] for r in now.collect()) == sorted(i for i, (_, c) in parts.items() if c == i)
    assert_gapless(now.collect())
    assert corpus_pipeline.run(spark, small_dir).count() == now.count()
