import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import bigru, importance
from foliospark.llm.common import table
from odd_rows import ODD

SMALL = "/root/testdata/sf0.01"


def test_gradients_by_finite_differences():
    model = bigru.BiGru(["a", "b", "c"], hidden=3)
    rng = np.random.default_rng(0)
    windows, target = rng.integers(0, 257, (6, 5)), rng.integers(0, 3, 5)
    _, gradients = model.gradients(windows, target)
    for name, g in gradients.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in g.shape)
            if name == "x":
                at = (at[0], int(windows.ravel()[rng.integers(windows.size)]), at[2])
            old = model.p[name][at]
            model.p[name][at] = old + 1e-2
            up, _ = model.gradients(windows, target)
            model.p[name][at] = old - 1e-2
            down, _ = model.gradients(windows, target)
            model.p[name][at] = old
            assert (up - down) / 2e-2 == pytest.approx(g[at], abs=2e-3)


def test_language_accuracy_on_held_out_documents(spark):
    docs = table(spark, SMALL, "documents")
    found = bigru.identify(docs, bigru.train(docs)).where(bigru.held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("lang", "lang_pred", "score").collect()
    assert len(found) > 150 and sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_languages_of_odd_rows(odd, nothing):
    model = bigru.train(odd)
    assert model.languages == sorted({r[2] for r in ODD if r[1] and r[2] and r[0] is not None and __import__("zlib").crc32(str(r[0]).encode()) % 4 != 2})
    rows = bigru.identify(odd, model).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert bigru.train(nothing) is None and bigru.identify(nothing, None).count() == 0
    assert {r["lang_pred"] for r in bigru.identify(odd, None).collect()} == {"und"}


def test_importance_sample_keeps_good_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    found = importance.resample(docs, importance.fit(docs, labels)).join(labels, "doc_id").select("keep", "quality", "toxic").collect()
    good = [r["keep"] for r in found if (r["quality"], r["toxic"]) == (1, 0)]
    bad = [r["keep"] for r in found if (r["quality"], r["toxic"]) == (0, 0)]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.4 * len(bad)


def test_importance_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 0, None), (None, 1, 1), (99, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    found = importance.resample(odd, importance.fit(odd, labels))
    assert found.columns.count("keep") == 1 and found.count() == len(ODD)
    everything = importance.resample(odd, importance.fit(odd, labels.limit(0))).collect()
    assert all(r["keep"] for r in everything)
    assert importance.resample(nothing, importance.fit(nothing, labels)).count() == 0


def test_kth_largest(spark):
    rng = np.random.default_rng(2)
    values = [*rng.normal(size=500).tolist(), *[0.25] * 50, 1e9, -1e9]
    frame = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(3)
    for k in (1, 2, 60, 300, len(values)):
        assert importance.kth_largest(frame, "x", k, bins=16) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(frame, "x", 0) == math.inf


def test_cut_loses_few_good_documents():
    weights, good = np.array([-9.0, -8.0, -5.0, -0.5, 0.0, 0.0, 0.0, 0.0]), np.array([False, False, False, True, True, True, True, True])
    assert -5 < importance.best_cut(weights, good) <= -0.5


def test_importance_is_alike_for_all_lengths(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text"), table(spark, "/root/testdata/sf0.1", "labels")
    good = docs.join(labels.where("quality = 1 and toxic = 0"), "doc_id")
    joined = good.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(40)).alias("doc_id")).agg(F.array_join(F.collect_list("text"), " ").alias("text"))
    longest = joined.select((-1 - F.col("doc_id")).alias("doc_id"), F.substring("text", 1, 130000).alias("text"))
    model = importance.fit(docs, labels)
    size = F.length("text")
    class_ = F.when(size < 2000, 0).when(size < 10000, 1).otherwise(2)
    kept = {r[0]: r[1] for r in importance.resample(good, model).groupBy(class_).agg(F.avg(F.col("keep").cast("int"))).collect()}
    assert min(kept.values()) >= 0.96 and max(kept.values()) - min(kept.values()) <= 0.04
    assert importance.resample(longest, model).agg(F.avg(F.col("keep").cast("int"))).first()[0] >= 0.95


@pytest.mark.parametrize("size, most", [("sf0.01", 0.35), ("sf0.1", 0.2)])
def test_telling_words_count_at_every_size(spark, size, most):
    docs, labels = table(spark, f"/root/testdata/{size}", "documents"), table(spark, f"/root/testdata/{size}", "labels")
    model = importance.fit(docs, labels)
    for word in ("trash", "scum", "idiot", "disgusting"):
        assert sum(model.ratios.get(b, 0) for b in importance.Hasher().buckets(word).tolist()) < -1, word
    found = importance.resample(docs, model).join(labels, "doc_id").select("keep", "quality", "toxic").collect()
    toxic, good = [r["keep"] for r in found if r["toxic"] == 1], [r["keep"] for r in found if (r["quality"], r["toxic"]) == (1, 0)]
    assert sum(toxic) <= most * len(toxic) and sum(good) >= 0.97 * len(good)


def test_equal_rates_give_equal_ratios_at_every_size():
    raw, target = np.zeros(importance.ORDERS * importance.BUCKETS), np.zeros(importance.ORDERS * importance.BUCKETS)
    raw[:1000], target[:1000] = 100, 30
    target[:3] = 0, 5, 90
    found = [importance.log_ratios(target * k, raw * k) for k in (1, 10, 1000)]
    assert all(set(f) == {0, 1, 2} and f == pytest.approx(found[0]) for f in found) and found[0][2] > 0


def test_rare_languages_are_learned(documents):
    common, rare = [(k, f"the common words of text number {k} and more of the same", "en", "a") for k in range(3000)], [(k, f"zażółć gęślą jaźń żółw {k} źdźbło", "pl", "a") for k in range(5000, 5006)]
    copies = [(k, "one text that comes again and again", "de", "a") for k in range(6000, 6400)]
    docs = documents(common + rare + copies)
    model = bigru.train(docs, 40)
    assert model.languages == ["de", "en", "pl"]
    found = bigru.identify(docs.where("lang = 'pl'"), model).collect()
    assert len(found) == 6 and all(r["lang_pred"] == "pl" for r in found)
    assert bigru.shares({"a": 3, "b": 10**9, "c": 10**6}, 2000) == {"a": 3, "b": 999, "c": 998}


def test_buckets_of_what_stands_between_white_space():
    """Words and marks are those of the whole text, though each run without white space is cut up only once."""
    rnd = np.random.default_rng(3)
    signs = ["a", "B", "é", "ß", "İ", "_", "1", "²", "日", ".", ",", "!?", "'", " ", "\n", "\t", "\x1c", "\x85", " ", " ", "​"]
    hasher, again = importance.Hasher(), importance.Hasher()
    for text in [None, "", " ", *("".join(rnd.choice(signs, rnd.integers(1, 40))) for _ in range(400))]:
        crc = [__import__("zlib").crc32(t.encode()) for t in importance._TOKEN.findall((text or "").lower())]
        pairs = [((a * 0x9E3779B97F4A7C15 + b) * 0xBF58476D1CE4E5B9 % (1 << 64) >> 40) % importance.BUCKETS + importance.BUCKETS for a, b in zip(crc, crc[1:])]
        want = [c % importance.BUCKETS for c in crc] + pairs
        assert hasher.buckets(text).tolist() == again.buckets(text).tolist() == want
        assert importance._distinct(hasher.buckets(text)).tolist() == sorted(set(want))
    once = importance.Hasher()
    once.buckets("one,two one,two\tone,two")
    assert set(once.known) == {"one,two"}
