"""The operators on Spark against brute force, over odd rows and empty tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, langid, neardup, packing, quality, sharding, tokens, topk, toxicity, urls
from tidewatch.session import work_path

BPE = public_tokenizers.path("byte_bpe_50k.json")
LOWER = str.maketrans(urls.UPPER, urls.LOWER)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# tokens ---------------------------------------------------------------------------------


def test_token_files_round_trip(spark, odd, odd_rows, empty):
    path = work_path(spark, "t-tokens")
    tokens.write_tokens(spark, odd, path, BPE, block_tokens=500)
    got = [r.asDict() for r in tokens.read_tokens(spark, path).orderBy("start").collect()]
    tok = tokens.encoder(BPE).tok
    want = collections.Counter()
    for i, t in odd_rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want[(i, ids)] += 1
    assert collections.Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want
    start = 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        start += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [(-r.n, r.id) for r in ranks] == sorted((-r.n, r.id) for r in ranks)
    assert tokens.token_table(spark, empty, BPE).count() == 0


# quality and toxicity ------------------------------------------------------------------


def labelled(spark, word):
    """Texts whose label is whether ``word`` stands in them; ids 0-299."""
    rng = random.Random(8)
    plain = "the of and that with from this there where which would could about".split()
    rows = []
    for i in range(300):
        text = [rng.choice(plain) for _ in range(rng.randrange(5, 400))]
        y = i % 3 == 0
        for _ in range(6 if y else 0):
            text.insert(rng.randrange(len(text)), word)
        rows.append((i, " ".join(text), int(y)))
    return spark.createDataFrame(rows, "doc_id long, text string, y int")


def test_quality_learns_and_scores_every_row(spark, odd, odd_rows, empty):
    data = labelled(spark, "%%% $$$ !!!")
    held = F.col("doc_id") % 4 == 0
    labels = data.select("doc_id", "y").union(spark.createDataFrame([(None, 1), (5, None), (7000, 1)], "doc_id long, y int"))
    model = quality.fit(data.drop("y"), labels, "y", F.col("key") % 4 != 0)
    got = quality.score(data, model).join(data.select("doc_id", "y"), "doc_id").where(held).collect()
    assert len(got) == 75 and np.mean([r.predicted == r.y for r in got]) > 0.95
    out = quality.score(odd, model).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(i for i, _ in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert quality.score(empty, model).count() == 0
    none = quality.fit(data, labels.limit(0), "y")
    assert {r.score for r in quality.score(data, none).collect()} == {0.5}
    one = quality.fit(data, labels.where("y = 1"), "y")
    assert {r.score for r in quality.score(data, one).collect()} == {1.0}


def test_toxicity_learns_and_scores_every_row(spark, odd, odd_rows, empty):
    data = labelled(spark, "moronic")
    labels = data.select("doc_id", "y").union(spark.createDataFrame([(None, 1), (5, None), (7000, 1)], "doc_id long, y int"))
    model = toxicity.fit(spark, data, labels, "y", F.col("key") % 4 != 0)
    got = {r.doc_id: r for r in toxicity.score(data, model).collect()}
    assert len(got) == 300
    for i in range(0, 300, 4):
        assert got[i].predicted == (i % 3 == 0)
        assert bool(got[i].evidence) == (i % 3 == 0) and all(e % 3 == 0 and e % 4 for e in got[i].evidence)
    out = toxicity.score(odd, model).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(i for i, _ in odd_rows)
    assert {r.predicted for r in out} == {0}
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.score(empty, toxicity.fit(spark, empty, labels, "y")).count() == 0
    assert {r.score for r in toxicity.score(data, toxicity.fit(spark, data, labels.limit(0), "y")).collect()} == {0.0}
    assert "Exchange" not in toxicity.score(data, model)._jdf.queryExecution().toString()


def test_idf_is_that_of_the_examples_by_class_share(spark):
    data = labelled(spark, "moronic")
    labels = data.where("doc_id < 200").select("doc_id", "y")
    model = toxicity.fit(spark, data, labels, "y", max_fit=40)
    assert sorted(model.index.labels.tolist()) == [0] * 40 + [1] * 40
    texts = {r.doc_id: r.text for r in data.collect()}
    holds = [np.mean(["moronic" in texts[i] for i in model.index.ids[model.index.labels == k].tolist()]) for k in (0, 1)]
    rate = labels.agg(F.avg("y")).first()[0]
    assert np.isclose(model.idf[model.terms["moronic"]], np.log(81 / (1 + 80 * ((1 - rate) * holds[0] + rate * holds[1]))) + 1)


def test_every_term_counts_for_toxicity(spark):
    rng = random.Random(3)
    clean = ["".join(rng.choices("bcdfgaeiou", k=7)) for _ in range(400)]
    rows = [(i, " ".join([*rng.choices(clean, k=40), *["moronic"] * (2 if i % 3 == 0 else 0)]), int(i % 3 == 0)) for i in range(300)]
    # a very long text of words that no example has, with the same two hits
    rows.append((1000, " ".join(["moronic", *(f"{w}x{v}" for w in "pqrstvwz" for v in "".join(clean[:60])), "moronic", *(c + "qzz" + d for c, d in zip(clean, clean[7:]))]), None))
    data = spark.createDataFrame(rows, "doc_id long, text string, y int")
    model = toxicity.fit(spark, data, data.where("y is not null"), "y", common=16, block=8)
    assert len(model.index.ids) == 300 and sorted(model.index.labels.tolist()) == [0] * 200 + [1] * 100
    plain = {i: toxicity.repeated(toxicity.words(t)) for i, t, _ in rows}
    terms = model.terms
    assert set(terms) == set().union(*(plain[i] for i in range(300)))
    df = collections.Counter(t for i in range(300) for t in plain[i])

    def weights(i):
        return {t: (1 + np.log(n)) * (np.log(301 / (1 + df[t])) + 1) * (model.gain[terms[t]] if t in terms else 1) for t, n in plain[i].items()}

    w = {i: weights(i) for i in plain}
    norm = {i: sum(x * x for x in v.values()) ** 0.5 for i, v in w.items()}
    for r in toxicity.score(data, model).collect():
        cos = np.round([sum(x * w[i].get(t, 0) for t, x in w[r.doc_id].items()) / norm[i] / norm[r.doc_id] for i in range(300)], 6)
        near = np.lexsort((np.arange(300), -cos))[:15]
        near = near[cos[near] > 0]
        assert np.isclose(r.score, model.calibrated(model.share(cos[near], near % 3 == 0)), rtol=1e-3), r.doc_id


# packing -------------------------------------------------------------------------------


def test_packing_keeps_every_byte(spark, odd, odd_rows, empty):
    got = packing.pack_documents(odd, lengths=(64, 256, 1024), chunk_rows=4).collect()
    want = collections.Counter()
    for i, t in odd_rows:
        want[i] += len((t or "").encode()) + 1
    total = collections.Counter()
    bins = collections.defaultdict(list)
    for r in got:
        total[r.doc_id] += r.length
        bins[r.bin_id].append((r.bin_offset, r.length, r.bin_capacity))
        assert r.start == r.piece * 1024
    assert total == want
    for spans in bins.values():
        spans.sort()
        ends = [o + n for o, n, _ in spans]
        assert [0, *ends[:-1]] == [o for o, _, _ in spans] and ends[-1] <= spans[0][2]
        assert spans[0][2] == min(c for c in (64, 256, 1024) if c >= ends[-1])
    assert packing.pack_documents(empty).count() == 0
    by_column = packing.pack_documents(odd, lengths=(4,), length_col="shard").collect()
    assert {r.length for r in by_column} == {3}


# top-k ---------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    data = [(i, np.round(rng.normal(size=6), 1).tolist(), i) for i in range(330)]
    data += [(1000 + i, [0.5] * 6, 0) for i in range(40)] + [(1000, [0.5] * 6, 0)]  # ties and a repeated row
    data += [(2000, None, 0), (2001, [], 0), (2050, [None, 1.0], 0), (2002, [float("nan")] * 6, 0), (2100, [float("inf")], 0), (None, [1.0] * 6, 0)]
    data += [(2150, [1.0, 1.0], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, score int")
    got = topk.top_k(spark, df, F.col("vec_id") % 50 == 0, query_block=3, shard_rows=17)
    fine = {i: np.floor(256 * np.pad(np.array(v), (0, 6 - len(v)))) for i, v, _ in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in sorted(fine):
        if q % 50 == 0:
            best = sorted((-int(fine[q] @ v), i) for i, v in fine.items() if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert topk.top_k(spark, df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(spark, df, F.col("vec_id") == 50, k=10_000).count() == len(fine) - 1


# urls ----------------------------------------------------------------------------------

RULES = [urls.Rule("com/", "allow"), urls.Rule("example.com/en/", "block"), urls.Rule("www.example.com/en/", "allow"), urls.Rule("net/es/", "block")]


def test_url_parts_and_rules(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "no scheme": ("", "", None), "http://A.Com/X?y#z": ("a.com", "/X", "com/"),
        "http://com": ("com", "", None), "http://xcom/": ("xcom", "/", None), "s://example.com/en/a://b": ("example.com", "/en/a://b", "example.com/en/"),
        "s://b.example.com/en": ("b.example.com", "/en", "com/"), "s://a.www.example.com/en/#": ("a.www.example.com", "/en/", "www.example.com/en/"),
        "s://U@x.NET:80/es/": ("u@x.net:80", "/es/", None), "s://x.NET/es/1": ("x.net", "/es/1", "net/es/"), "s://x.NET/ES/1": ("x.net", "/ES/1", None),
        "s://É.com/": ("É.com", "/", "com/"), "s://?q=http://a.com/": ("", "", None), "s://a.com/" + "z" * 40_000: ("a.com", "/" + "z" * 40_000, "com/"),
    }
    data = [(i, u, 1) for i, u in enumerate(cases)] + [(None, "s://a.com/", 1), (1, "", 1)]
    got = urls.judge_urls(spark, spark.createDataFrame(data, "page_id long, url string, host int"), RULES).collect()
    assert len(got) == len(data)
    verdicts = {r.text: r.verdict for r in RULES}
    want = list(cases.values())
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule) == want[r.page_id]
        assert r.verdict == verdicts[r.rule] if r.rule else r.verdict in ("allow", "block")
    assert urls.judge_urls(spark, spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0
    untaught = urls.judge_urls(spark, spark.createDataFrame([(1, "s://x.org/")], "page_id long, url string"), RULES).first()
    assert (untaught.verdict, untaught.score) == ("allow", 0.0)


def test_ratio_model_equals_witten_bell(spark):
    order, good, bad = 3, ["abca", "abd", "b"], ["xab", "ba"]
    def grams(u):
        t = urls.START * (order - 1) + u + urls.END
        return [t[i : i + order] for i in range(len(t) - order + 1)]

    all_grams = sorted({g for u in [*good, *bad, "zb"] for g in grams(u)})
    counts = [(g, sum(grams(u).count(g) for u in good), sum(grams(u).count(g) for u in bad)) for g in all_grams]
    got = {r.gram: r.llr for r in urls.ratio_model(spark.createDataFrame(counts, "gram string, a long, b long"), order).collect()}
    alphabet = {g[-1] for g in all_grams}

    def prob(g, side):
        p = 1 / len(alphabet)
        for k in range(1, order + 1):
            ctx = g[order - k : order - 1]
            seen = collections.Counter()
            for row in counts:
                if row[0][order - k : order - 1] == ctx:
                    seen[row[0][-1]] += row[side]
            n, kinds = sum(seen.values()), sum(v > 0 for v in seen.values())
            if n:
                p = (seen[g[-1]] + kinds * p) / (n + kinds)
        return p

    assert set(got) == set(all_grams)
    for g in all_grams:
        assert np.isclose(got[g], np.log(prob(g, 1) / prob(g, 2)))


def test_url_model_tells_the_classes_apart(spark):
    rng = random.Random(6)
    data = []
    for i in range(600):
        bad = i % 2
        word = "".join(rng.choice("xyzq" if bad else "aeilnrt") for _ in range(8))
        host = ("x.net" if bad else "x.com") if i % 5 else "x.org"
        data.append((i, f"http://{host}/{'es/' if bad and i % 5 else ''}{word}"))
    got = urls.judge_urls(spark, spark.createDataFrame(data, "page_id long, url string"), RULES).collect()
    judged = [(r.verdict == "block", r.page_id % 2 == 1) for r in got if r.rule is None]
    assert len(judged) == 120 and np.mean([a == b for a, b in judged]) > 0.95


# language ------------------------------------------------------------------------------


def test_language_learns_and_predicts_every_row(spark, odd, odd_rows, empty):
    rng = random.Random(2)
    stems = {"aa": "kala lama mana", "bb": "krst vlst prsk", "cc": "ouie eaui uoie"}
    data = []
    for i in range(240):
        lang = rng.choice(list(stems))
        data.append((i, " ".join(rng.choice(stems[lang].split()) for _ in range(rng.randrange(3, 60))), lang))
    data += [(500, "kala", None), (501, None, "aa"), (502, "12 !", "dd")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    profiles = langid.fit(df, F.col("key") % 2 == 0, dims=256)
    assert profiles.langs == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in langid.predict(df, profiles).collect()}
    assert np.mean([got[i].lang_pred == y for i, _, y in data[:240]]) > 0.98
    out = langid.predict(odd, profiles).collect()
    texts = dict(odd_rows)
    assert len(out) == len(odd_rows)
    for r in out:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
    assert langid.predict(empty, profiles).count() == 0
    assert {r.lang_pred for r in langid.predict(df, langid.fit(df.limit(0))).collect()} == {"und"}
    kept = langid.keep_known(odd, profiles)
    assert kept.columns == odd.columns and kept.count() == sum(r.lang_pred != "und" for r in out)


# decontamination -----------------------------------------------------------------------


def hits(docs, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        if i is not None and w:
            n = min(window, len(w))
            for k in range(len(w) - n + 1):
                windows[tuple(w[k : k + n])].add(str(i))
    sizes = {len(w) for w in windows}
    for i, t in docs:
        w, hit, named = split(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    named |= windows[tuple(w[k : k + n])]
        yield i, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_contamination_equals_brute_force(spark, odd, odd_rows, empty, broadcast):
    base, long = odd_rows[3][1], odd_rows[6][1]
    items = [(1, base), (1, base), (10, base[:60]), (2, "ONE"), (3, None), (4, ""), (None, "one"), (5, "456!"), (6, " ".join(long.split()[777:800])), (7, "é 中"), (8, "x y z"), (9, base[20:200])]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n_words int")
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for window in (13, 2):
        got = decontaminate.contamination(spark, odd, bench, window=window, broadcast_windows=broadcast)
        assert rows_of(got, *cols) == sorted(hits(odd_rows, items, window), key=repr)
    if broadcast:
        assert decontaminate.contamination(spark, empty, bench).count() == 0
        clean = decontaminate.contamination(spark, odd, bench.limit(0))
        assert rows_of(clean, *cols) == sorted(hits(odd_rows, [], 13), key=repr)


# near duplicates -----------------------------------------------------------------------


def components_of(docs, width, percent):
    texts = {}
    for i, t in docs:
        if i is not None:
            texts[i] = max(texts.get(i, ""), t or "")
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width,options", [(2, {}), (5, {}), (2, {"groups": 8, "rows": 1})])
def test_near_duplicates_equal_all_pairs(spark, odd, odd_rows, empty, width, options):
    rng = random.Random(11)
    docs = [(i, t) for i, t in odd_rows if t is None or len(t) < 10_000]
    vocabulary = [f"w{k}" for k in range(400)]
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 40, 120]))]
        for k in range(rng.choice([1, 3, 9])):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            docs.append((100 + 20 * group + k, " ".join(text) + (" " + shared if group % 3 == 0 else "")))
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int")
    got = neardup.near_duplicates(spark, df, shingle=width, percent=80, **options).collect()
    want = components_of(docs, width, 80)
    named = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None}
    assert named == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    nulls = [r for r in got if r.doc_id is None]
    assert len(nulls) == sum(i is None for i, _ in docs) and all(r.kept and r.component_id is None for r in nulls)
    assert len(got) == len(want) + len(nulls)


def test_near_duplicates_odd_and_empty(spark, odd, odd_rows, empty):
    got = {r.doc_id: r for r in neardup.near_duplicates(spark, odd, shingle=5).collect()}
    want = components_of(odd_rows, 5, 80)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items() if i is not None} == want
    assert neardup.near_duplicates(spark, empty).count() == 0
    one = neardup.one_row_each(odd)
    assert one.columns == odd.columns and one.where("doc_id = 7").count() == 1 and one.count() == len(odd_rows) - 1


def test_hot_bucket_is_resolved_in_rounds(spark, monkeypatch):
    """Chains in one bucket whose smallest member is like none of the others."""
    monkeypatch.setattr(neardup, "LEADERS", 6)
    monkeypatch.setattr(neardup, "TILE", 3)
    rng = random.Random(1)
    shared = [f"s{k}" for k in range(40)]
    docs = []
    for i in range(60):
        own = [f"o{i // 3}_{k}" for k in range(30)]
        own[rng.randrange(30)] = f"v{i}"
        docs.append((i, " ".join(shared + own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark, df, shingle=2, groups=4, rows=1).collect()}
    assert got == components_of(docs, 2, 80)


# sharding ------------------------------------------------------------------------------


def least_largest(sizes, shards):
    low, high = 0, sum(sizes)
    while low < high:
        mid, used, left = (low + high) // 2, 1, 0
        left = mid
        for s in sizes:
            if s > left:
                used, left = used + 1, mid
            used, left = (used, left - s) if s <= left else (10**9, left)
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("fences", [4, 1 << 16])
def test_shards_are_minimax_runs_of_groups(spark, odd, odd_rows, empty, monkeypatch, fences):
    monkeypatch.setattr(sharding, "FENCES", fences)
    for shards in (1, 3, 16):
        got = sharding.shard_documents(spark, odd, shards).collect()
        size = lambda t: len((t or "").encode()) + 1
        assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in odd_rows)
        first, total, where = {}, collections.Counter(), {}
        for i, t in odd_rows:
            total[t] += size(t)
            if i is not None:
                first[t] = min(first.get(t, i), i)
        texts = {i: t for i, t in odd_rows if i is not None}
        load = collections.Counter()
        for r in got:
            load[r.shard] += r.size
            if r.doc_id is not None:
                where.setdefault(texts[r.doc_id], set()).add(r.shard)
        assert all(len(s) == 1 for s in where.values())
        order = sorted(total, key=lambda t: first[t])
        assert [min(where[t]) for t in order] == sorted(min(where[t]) for t in order)
        assert max(load.values()) == least_largest([total[t] for t in order], shards)
        for s in load:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_documents(spark, empty).count() == 0


def test_cuts_are_even_around_a_large_group(spark):
    sizes = [100] * 60 + [5000] + [100] * 60
    ends = np.cumsum(sizes).tolist()
    totals = spark.createDataFrame([(e,) for e in ends], "upto long")
    capacity, got = sharding.shard_ends(totals, 5)
    loads = np.diff([0, *got])
    assert capacity == 5000 and loads.max() == 5000 and set(got) <= set(ends) and loads.min() >= 2500
