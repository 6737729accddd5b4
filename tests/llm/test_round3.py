"""Line dedup, prefix trie and importance resampling against brute force, over odd rows and empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import decontaminate, lines, packing, resample, trie, urls
from tidewatch.llm.common import fit_sample, load, text_hash, without
from tidewatch.plans.strategy import plan_text

LOWER = str.maketrans(urls.UPPER, urls.LOWER)


# line dedup ------------------------------------------------------------------------------


def lines_by_hand(rows, least_chars=20, least_docs=3):
    def key(line):
        return line.strip(lines.SPACE).translate(LOWER)

    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                held[key(line)].add(i)
    keeper = {k: max(i for i in ids if i is not None) for k, ids in held.items() if len(ids) >= least_docs}
    out = collections.Counter()
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if key(x) not in keeper or keeper[key(x)] == i]
        out[i, "\n".join(kept), len(parts), len(parts) - len(kept)] += 1
    return out


def line_rows():
    rng = random.Random(3)
    pool = [f"{'Line' if i % 2 else ' lIne'} number {i} of the shared ones\t" for i in range(12)] + ["short", "", "É" * 20, "é" * 19, "x" * 19 + "\r", "y" * 20]
    rows = [(i, "\n".join(rng.choice(pool) + (str(i) if rng.random() < 0.2 else "") for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    common = "The one line that nearly everybody has"
    rows += [(100 + i, f"{common}\nown text of this document {i}\n{common.upper()}") for i in range(200)]
    rows += [(7, "a line under a repeated id, again"), (7, "a line under a repeated id, again"), (7, "a line under a repeated id, again\n" + common)]
    rows += [(None, "a line under a repeated id, again"), (None, common), (None, None), (900, ""), (901, "\n"), (902, common + "\n" * 3)]
    rows += [(903, "\n".join(f"long text line {i % 5000} that comes twice" for i in range(10_000))), (904, "\n".join(f"long text line {i} that comes twice" for i in range(5000)))]
    rows += [(905, "long text line 77 that comes twice\n" + common)]
    return rows


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    rows = line_rows()
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in rows], "doc_id long, text string, keys string, hi int, pos int").repartition(3)
    got = lines.dedup_lines(spark, df, batches=batches, fanout=fanout).collect()
    assert collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == lines_by_hand(rows)


def test_line_dedup_of_odd_rows(spark, odd, odd_rows, empty):
    got = lines.dedup_lines(spark, odd, least_chars=2, least_docs=2).collect()
    assert collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == lines_by_hand(odd_rows, 2, 2)
    assert lines.dedup_lines(spark, empty).count() == 0


def test_runs_are_levelled_and_first_holders_keep(spark):
    runs = lines.LineRuns(spark, fanout=2)
    shape = []
    for i in range(5):
        runs.add(spark.createDataFrame([(1, 1, 2, 50 - i), (2, i, 1, 9)], "hi long, lo long, docs long, id long"))
        shape.append([len(level) for level in runs.levels])
    assert shape == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    assert {(r.hi, r.lo, r.docs, r.keeper) for r in runs.merged().collect()} == {(1, 1, 10, 50), *((2, i, 1, 9) for i in range(5))}
    names = [name for level in runs.levels for name, _ in level]
    runs.release()
    assert not any(spark.catalog.tableExists(n) for n in names)


# prefix trie -----------------------------------------------------------------------------


def trie_by_hand(rows, group=20, heads=4):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    member = collections.defaultdict(list)
    made = {}
    for c in sorted(own):
        h, base = zlib.crc32(str(c).encode()) % heads, c - int(math.fmod(c, group))
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(made[c]) + 1):
            member[made[c][:d]].append(c)
    kids, out = collections.Counter(n[:-1] for n in member if n), set()
    for node, ids in member.items():
        below = [m for m in member if m[: len(node)] == node]
        saved = sum((len(member[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) for m in below if m)
        ends = ",".join(str(c) for c in ids if made[c] == node)
        out.add((ids[0], len(node), member[node[:-1]][0] if node else None, len(ids), kids[node], sum(not kids[m] for m in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talk():
    rng = random.Random(5)
    rows = []
    for c in [*range(-45, 130), *range(1000, 1400, 7), 10**15]:
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hello there", "", None, "a b c\td", "one"])))
    rows += [(c, t, "user", f"the same {t}") for c in range(2000, 2300) for t in range(3)]  # one conversation many times
    rows += [(5, None, "user", "no turn"), (5, None, "user", "no turn"), (5, 0, "user", "tie"), (None, 1, "user", "nobody"), (3000, 2, "ab", "c"), (3001, 2, "a", "bc")]
    rows += [(4000, t, "user", f"long {t % 7}") for t in range(1500)]  # a deep path
    return rows


@pytest.mark.parametrize("shard", [25, 4096])
def test_trie_equals_brute_force(spark, shard):
    rows = [r for r in talk() if r[0] != 4000]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, node int, shard string").repartition(4)
    got = trie.prefix_trie(spark, df, shard_conversations=shard).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == trie_by_hand(rows)


def test_trie_of_a_deep_conversation_and_of_nothing(spark):
    df = spark.createDataFrame([r for r in talk() if r[0] == 4000], "conv_id long, turn int, role string, text string")
    got = {r.depth: r for r in trie.prefix_trie(spark, df).collect()}
    assert len(got) == 1501 and all(r.n_leaves == 1 and r.n_children == (r.depth < 1500) for r in got.values())
    assert trie.prefix_trie(spark, df.limit(0)).count() == 0
    assert trie.prefix_trie(spark, spark.createDataFrame([(None, 1, "a", "b")], df.schema)).count() == 0


# importance resampling ---------------------------------------------------------------------


def features_by_hand(text, runs=3):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), collections.Counter((k, zlib.crc32(" ".join(w[i : i + k]).encode())) for k in range(1, runs + 1) for i in range(len(w) - k + 1))


def resample_by_hand(rows, target, percent, least_words, buckets=10_000):
    def counts(texts):
        n = collections.Counter()
        for t in texts:
            for (_, crc), k in features_by_hand(t)[1].items():
                n[crc % buckets] += k
        return n

    s, t = counts(t for _, t in rows), counts(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        n, f = features_by_hand(text)
        weight = sum(k * math.floor(1000 * math.log((t[c % buckets] + 1) * (big_s + buckets) / ((s[c % buckets] + 1) * (big_t + buckets)))) for (_, c), k in f.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    able = [(*r, p if p <= percent * len(able) // 100 else None) for p, r in enumerate(able, 1)]
    return collections.Counter((r[0], *r[2:]) for r in able + [(*r, None) for r in out if r[1] < least_words])


@pytest.mark.parametrize("block", [7, 50, 1000, 1 << 18])
def test_feature_crcs_by_position_table(block):
    rng = random.Random(1)
    long = " ".join(rng.choice(["ab", "x" * 300, "y" * 128, "z" * 129, "é" * 200, "q1", "W"]) for _ in range(300))
    texts = [None, "", "  ", "A", "a b", "Éa ÀB c-d 9x!", long, "k" * 5000 + " m", "tail"]
    got = collections.defaultdict(collections.Counter)
    for k, text, crc in resample.features(*resample._texts(pa.array(texts)), 3, block):
        for at, c in zip(text.tolist(), crc.tolist(), strict=True):
            got[at][k, c] += 1
    assert all(got[i] == features_by_hand(t)[1] for i, t in enumerate(texts))


def test_zero_bytes_and_lengths():
    data = np.frombuffer(bytes(700) + b"\xff" * 700, np.uint8)
    starts, lengths = np.array([0, 3, 650, 701, 0]), np.array([1, 128, 129, 600, 1400])
    assert resample.span_crcs(data, starts, lengths).tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, lengths, strict=True)]


@pytest.mark.parametrize("percent,least_words", [(5, 20), (60, 1)])
def test_resampling_equals_brute_force(spark, odd, odd_rows, empty, percent, least_words):
    target = [None, "", "alpha3 beta7 gamma1 delta", "one", "ab1 cd2 efg3"]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(spark, odd, bench, percent=percent, least_words=least_words).collect()
    assert collections.Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == resample_by_hand(odd_rows, target, percent, least_words)
    assert resample.resample(spark, empty, bench).count() == 0
    assert resample.resample(spark, odd, bench.limit(0)).count() == len(odd_rows)


# helpers and stages that earlier rounds left open ------------------------------------------


def test_sample_is_taken_from_the_documents_there_are(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, y int")
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(0, 2000, 10)] + [(7, "a"), (7, "b"), (7, None)], "doc_id long, text string")
    got = fit_sample(docs, labels, "y", None, 60, "doc_id", "text").collect()
    assert collections.Counter(r.label for r in got) == {0: 60, 1: 1}
    assert [(r.key, r.text) for r in got if r.label] == [(7, "b")]


def test_without_takes_each_row_by_its_own_text(spark):
    rows = [(1, "bad"), (1, "good"), (None, "bad"), (None, "good"), (2, None), (None, None), (3, "bad")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, text_hash string")
    bad = docs.where("text = 'bad' or (doc_id is null and text is null)").select("doc_id", text_hash(F.col("text")).alias("text_hash"))
    left = without(spark, docs, bad)
    assert left.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(repr, [(1, "good"), (None, "good"), (2, None)]))
    assert without(spark, docs, spark.createDataFrame([(1,), (None,)], "doc_id long")).count() == 5


def test_language_stage_rejects_what_is_no_language(spark):
    import base64

    rng = random.Random(2)
    en, de = ("the and of with that this there where which from", "der die und nicht mit dass diese wo welche von")
    docs = [(i, " ".join(rng.choice(w.split()) for _ in range(rng.randrange(3, 200))), lang) for i, (w, lang) in enumerate([(en, "en"), (de, "de")] * 100)]
    odd = [base64.b64encode(rng.randbytes(300)).decode(), "これは日本語の文章です。" * 20, "Привет мир это текст " * 12, "12 44 --", "", None]
    df = spark.createDataFrame(docs + [(1000 + i, t, None) for i, t in enumerate(odd)] + [(None, "the and of with", None)], "doc_id long, text string, lang string")
    left = corpus_pipeline.language(spark, df, "").collect()
    assert sorted(r.doc_id for r in left if r.doc_id is not None) == list(range(200)) and len(left) == 201
    unlearned = df.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, unlearned, "").count() == df.count()


def test_every_rule_judged_url_counts(spark):
    """A word that only rule-judged urls of the threshold's fold show is evidence for the others."""
    fold = [f"http://a{i}.com/q{i}" for i in range(400)]
    allow = fold
    block = [f"http://b{i}.net/fr/xylophone{i}" for i in range(300)]
    rows = spark.createDataFrame(list(enumerate([*allow, *block, "http://c.org/fr/xylophone7", "http://a5.org/q5"])), "page_id long, url string")
    got = {r.page_id: r for r in urls.judge_urls(spark, rows, [urls.Rule("com/", "allow"), urls.Rule("net/fr/", "block")]).collect()}
    assert got[700].verdict == "block" and got[701].verdict == "allow"
    only = [u for u in block if spark.createDataFrame([(u,)], "u string").where("pmod(xxhash64(u), 5) = 0").count()][:1]
    few = spark.createDataFrame(list(enumerate([*allow, *only, "http://c.org/fr/xylophone7"])), "page_id long, url string")
    last = {r.page_id: r for r in urls.judge_urls(spark, few, [urls.Rule("com/", "allow"), urls.Rule("net/fr/", "block")]).collect()}[401]
    # the only blocked url lies in the threshold's fold: without its counts both models would be alike and the score 0
    assert last.score != 0


def test_stages_of_odd_rows(spark, odd, empty):
    """Null and repeated ids, clashing columns and empty tables go through every filtering stage."""
    sf = "/root/testdata/sf0.001"
    odd, empty = (df.withColumn("lang", F.lit("en")) for df in (odd, empty))
    for name, step in corpus_pipeline.STAGES[:-1]:
        left = step(spark, odd, sf)
        assert left.columns == odd.columns, name
        ids = [r.doc_id for r in left.collect()]
        assert set(ids) <= {r.doc_id for r in odd.collect()} and len(ids) <= odd.count(), name
        assert step(spark, empty, sf).count() == 0, name
    assert corpus_pipeline.packed(spark, empty, sf).count() == 0


def test_packing_does_not_depend_on_the_partitions(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, int(rng.paretovariate(1.1) * 60) % 20_000) for i in range(4000)], "doc_id long, size int")
    bins = {}
    for parts in (1, 400):
        rows = packing.pack_documents(docs.repartition(parts), length_col="size").collect()
        bins[parts] = {r.bin_id: r.bin_capacity for r in rows}
        used = collections.defaultdict(list)
        for r in rows:
            used[r.bin_id].append((r.bin_offset, r.length))
        for b, spans in used.items():
            spans.sort()
            assert all(x[0] + x[1] <= y[0] for x, y in zip(spans, spans[1:])) and spans[-1][0] + spans[-1][1] <= bins[parts][b]
        assert sum(r.length for r in rows) == docs.agg(F.sum("size")).first()[0]
    assert abs(len(bins[400]) - len(bins[1])) <= 0.02 * len(bins[1])
    assert sum(bins[400].values()) <= 1.02 * sum(bins[1].values())


def test_a_new_bin_has_the_least_cost_size():
    """A length that costs more than a longer one is never opened; tiny packings against every choice of sizes."""
    assert packing.pack([3, 3], (4, 8), (9, 5))[2].tolist() == [8]
    rng = random.Random(6)
    for _ in range(60):
        sizes = [rng.randrange(1, 9) for _ in range(rng.randrange(1, 6))]
        costs = [rng.randrange(1, 12) for _ in range(3)]
        caps = packing.pack(sizes, (3, 5, 8), costs)[2].tolist()
        spent, best = sum(costs[(3, 5, 8).index(c)] for c in caps), least_cost(sorted(sizes), dict(zip((3, 5, 8), costs, strict=True)))
        assert best <= spent <= 1.5 * best + max(costs)


def least_cost(sizes, costs):
    """The least cost of all partitions of ``sizes`` into bins."""
    if not sizes:
        return 0
    first, rest = sizes[0], sizes[1:]
    out = float("inf")
    for mask in range(1 << len(rest)):
        own = first + sum(x for i, x in enumerate(rest) if mask >> i & 1)
        fits = [c for n, c in costs.items() if n >= own]
        if fits:
            out = min(out, min(fits) + least_cost([x for i, x in enumerate(rest) if not mask >> i & 1], costs))
    return out


def test_decontamination_beyond_the_broadcast_shuffles_no_words(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    bench = load(spark, "/root/testdata/sf0.001", "benchmark")
    small = decontaminate.contamination(spark, docs, bench)
    large = decontaminate.contamination(spark, docs, bench, broadcast_windows=0)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect())) and small.where("contaminated").count()
    rows = docs.select("doc_id", F.lit(1).cast("long").alias("text_hash"), decontaminate.words(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    places = decontaminate.placed_tokens(rows, [3], "doc_id", "text_hash").select("doc_id", "text_hash", "n_words", "at", "width", "token")
    plan = plan_text(places.repartition(4, "token"))
    exchange = plan[plan.index(") Exchange") :]
    assert "words" not in exchange[: exchange.index("Arguments")].replace("n_words", "")
