"""The language stage is calibrated over every document that has a language."""

import random

from pyspark.sql import functions as F

from tidewatch.llm import langid


def test_the_least_cosine_is_that_of_all_documents(spark):
    """Documents of one repeated word lie far from the prototype; most are not among the sampled ones."""
    rng = random.Random(5)
    words = "the and of with that this there where which from".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(100)), "en") for i in range(300)]
    docs += [(1000 + i, " ".join(["".join(rng.choices("bcdghjklmnpqrs", k=5))] * 60), "en") for i in range(12)]
    docs += [(2000, "the and of with", "en"), (2001, "12 --", "en"), (None, " ".join(words * 9), "en"), (2002, None, "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    profiles = langid.fit(df, max_fit=20, calibrate=True)
    texts = [t for _, t, _ in docs if t]
    cos, bits = profiles.nearest(texts, langid.Bundler(1024))
    want = {int(k): float(min(c for c, b in zip(cos, bits, strict=True) if b == k)) for k in set(bits) if k}
    assert profiles.least.keys() == want.keys()
    assert all(abs(profiles.least[k] - want[k]) < 1e-5 for k in want)
    left = langid.keep_known(df, profiles).select(F.col("doc_id")).collect()
    assert sorted(r.doc_id or -1 for r in left) == sorted(i or -1 for i, t, _ in docs if t and t != "12 --")
