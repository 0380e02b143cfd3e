import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import components
from foliospark.llm import signature_join as S
from foliospark.llm.components import connected
from foliospark.llm.queries import QUERIES


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def brute(rows, width, num, den):
    sets = {d: shingles(t, width) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(sets[d]), find(d)) for d in ids)


def corpus(seed, n=160):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("the of and to in".split()) if rnd.random() < 0.3 else f"w{rnd.randrange(400)}"
    passage = [word() for _ in range(60)]
    rows = [[word() for _ in range(rnd.choice([1, 2, 3, 5, 20, 60, 200]))] for _ in range(n // 4)]
    rows += [[*passage, *(word() for _ in range(rnd.randrange(60)))] for _ in range(n // 8)]
    while len(rows) < n:
        copy = list(rnd.choice(rows))
        for _ in range(rnd.randrange(4)):
            copy[rnd.randrange(len(copy))] = word()
        rows.append(copy)
    return [(i * 3 + 1, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("width, num", [(3, 90), (5, 80), (2, 70)])
@pytest.mark.parametrize("block", [4096, 7])
def test_components_against_brute_force(monkeypatch, documents, width, num, block):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "COMBINE", 64)
    rows = corpus(num + block)
    docs = documents([(d, t, None, None) for d, t in rows])
    found = S.jaccard_components(docs, width, num, 100).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, width, num, 100)


def test_odd_rows(odd, nothing, documents):
    found = sorted(((r[0] or -1, r[1], r[2] or -1) for r in S.jaccard_components(odd).collect()))
    assert found == [(-1, 1, -1), (-1, 1, -1), (1, 4, 1), (1, 4, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 1, 5), (6, 1, 6), (7, 1, 7), (8, 3, 8)]
    assert S.jaccard_components(nothing).count() == 0
    case = documents([(1, "A b C d", None, None), (2, "a B c D", None, None), (3, "É b c d", None, None), (4, "é b c d", None, None), (5, "a\x1cb c d", None, None), (6, None, None, None), (7, "", None, None)])
    assert sorted(tuple(r) for r in S.jaccard_components(case).collect()) == [(1, 2, 1), (2, 2, 1), (3, 2, 3), (4, 2, 4), (5, 1, 5), (6, 0, 6), (7, 0, 7)]


def test_large_group_of_copies(documents):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base, f"x{i % 40}"])) for i in range(600)]
    found = S.jaccard_components(documents([(d, t, None, None) for d, t in rows])).collect()
    assert {r["component_id"] for r in found} == {0} and len(found) == 600


def test_tree_links_are_complete():
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 1 << 62, rng.integers(1, 300)).astype(np.uint64)) for _ in range(40)]
    sets = base + [np.unique(np.concatenate([b[: max(1, int(len(b) * f))], rng.integers(0, 1 << 62, 2).astype(np.uint64)])) for b in base for f in (0.85, 0.95, 1.0)]
    want = set()
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both * 100 >= 80 * (len(sets[i]) + len(sets[j]) - both):
                want.add((j, i))
    tree = S.SignatureTree(sets)
    assert {tuple(sorted(p)) for p in tree.links(80, 100, spanning=False)} == want
    side = np.arange(len(sets)) % 2
    across = {p for p in want if side[p[0]] != side[p[1]]}
    assert {tuple(sorted(p)) for p in S.SignatureTree(sets).links(80, 100, side, spanning=False)} == across


def test_connected(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(90)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in linked}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_are_followed_once(spark):
    """Joins make a row for each node of each round but the last, not one for each first node in every round."""
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [640, 40, 20, 10, 5]
        rounds = [spark.range(n).select(F.col("id").alias("a"), (F.col("id") % (n // 2)).alias("to")) for n in sizes]
        found = components.reached(rounds)
        expected = {}
        for node in range(sizes[0]):
            group = node
            for n in sizes:
                group = group % (n // 2) if group < n else group
            expected[node] = group
        # collects the very plan whose counts are read below
        execution = found._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        made, open_ = [], [execution.executedPlan()]
        while open_:
            node = open_.pop()
            open_ += [node.children().apply(i) for i in range(node.children().size())]
            if "SortMergeJoin" in node.nodeName():
                made.append(node.metrics().apply("numOutputRows").value())
        assert sorted(made) == sorted(sizes[:-1])
        assert {r["node"]: r["group"] for r in found.collect()} == expected
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)


def test_forest_connects_what_its_edges_connect(spark, documents):
    documents([])
    rnd = random.Random(4)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(200)] + [(5000, 5001 + i) for i in range(300)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4)
    groups = {}
    for x in parent:
        groups.setdefault(root(x), set()).add(x)
    wanted = {(x, r) for r, members in groups.items() if len(members) > 1 for x in members}
    for most in (1 << 20, 10):
        stars = components.forest(frame, most)
        assert {(r["node"], r["component"]) for r in components.connected(stars).collect()} == wanted
    assert {(r["node"], r["component"]) for r in components.connected(frame).collect()} == wanted
    assert stars.count() <= 4 * 900


def test_query_like_brute_force(spark):
    """All documents of the small table, each pair compared."""
    path = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet'").fetchall()
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        grams = [tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
        sets[doc] = set(grams)
    component = {doc: doc for doc in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((component[a], component[b]))
                component = {d: low if c == high else c for d, c in component.items()}
    found = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in QUERIES["op1_signature_join"](spark, path).collect()}
    assert found == {(doc, len(sets[doc]), component[doc]) for doc in ids}
    assert len({c for c in component.values()}) < len(ids)


def chained(n, tail=6):
    """Documents of many sizes that all share a passage with the next one, and near copies of some of them."""
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        own = [f"d{i}x{k}" for k in range(rnd.choice([8, 12, 17, 30, 33, 60, 64, 70]))]
        rows.append([*(f"p{i}x{k}" for k in range(tail)), *own, *(f"p{i + 1}x{k}" for k in range(tail))])
    for i in range(0, n, 3):
        for size in (0, 1):
            copy = list(rows[i])
            copy += [f"e{i}x{size}x{k}" for k in range(len(copy) // 8 * size)]
            rows.append(copy)
    return [(i * 2 + 1, " ".join(w)) for i, w in enumerate(rows)]


def test_all_texts_fix_the_order(monkeypatch, documents):
    """Passages of few documents don't chain those to one family, which would be sent once for each of its blocks."""
    monkeypatch.setattr(S, "COMBINE", 64)
    docs = documents([(d, t, None, None) for d, t in chained(60)])
    keys = S.sets_and_keys(docs, 5, 80, 100, S.token_order(docs, 5)).where("key IS NOT NULL").select("key", "doc_id")
    sizes = [r["count"] for r in S._families(keys).groupBy("family").count().collect()]
    assert sorted(sizes) == [3] * 20


@pytest.mark.parametrize("num", [70, 80])
def test_large_families_are_divided_by_size(monkeypatch, documents, num):
    """Without an order all documents chain to one family; sets meet those of like size only, and no link is lost or given twice."""
    monkeypatch.setattr(S, "BLOCK", 25)
    monkeypatch.setattr(S, "token_order", lambda docs, width: None)
    rows = chained(60)
    docs = documents([(d, t, None, None) for d, t in rows])
    sent = []
    links = S.tree_links

    def count(rows, *a):
        sent.append(rows.count())
        return links(rows, *a)

    monkeypatch.setattr(S, "tree_links", count)
    assert sorted(tuple(r) for r in S.jaccard_components(docs, 5, num, 100).collect()) == brute(rows, 5, num, 100)
    classes, found = S.similar(docs, 5, num, 100, spanning=False)
    representatives = {r["doc_id"]: r["representative"] for r in classes.collect()}
    sets = {d: shingles(t, 5) for d, t in rows if representatives[d] == d}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])}
    assert sorted((r["a"], r["b"]) for r in found.collect()) == sorted(want)
    assert max(sent) < 2 * len(sets)


def test_families_stay_small_without_an_order(monkeypatch, documents):
    """Where counters tell nothing about tokens, as when very many share each, passages of few documents don't chain those to one family either."""
    monkeypatch.setattr(S, "token_order", lambda docs, width: None)
    words = [[*(f"p{i}x{k}" for k in range(16)), *(f"d{i}x{k}" for k in range(200)), *(f"p{i + 1}x{k}" for k in range(16))] for i in range(40)]
    words += [[*w, "one", "more"] for w in words[::3]] + words[::7]
    rows = [(i * 2 + 1, " ".join(w)) for i, w in enumerate(words)]
    docs = documents([(d, t, None, None) for d, t in rows])
    sent = []
    links = S.tree_links

    def count(rows, *a):
        sent.append(rows.groupBy("family").count().agg(F.max("count")).first()[0])
        return links(rows, *a)

    monkeypatch.setattr(S, "tree_links", count)
    assert sorted(tuple(r) for r in S.jaccard_components(docs, 5, 80, 100).collect()) == brute(rows, 5, 80, 100)
    assert max(sent) < 10


@pytest.mark.parametrize("num", [70, 80, 87])
def test_sets_may_leave_out_as_many_keys(spark, num):
    """Two similar sets share more of their longer keys than either leaves out."""
    sizes = range(1, 3000)
    least = {n: -(-n * num // 100) for n in sizes}
    frame = spark.range(1, 3000).select("id", S._spare(F.col("id"), num, 100).alias("spare"))
    assert {r["id"]: r["spare"] for r in frame.collect()} == {n: S._more(least[n]) for n in sizes}
    assert all(S._more(n) >= S._more(n - 1) for n in sizes[1:]) and all(n - least[n] + 1 + S._more(n) <= n for n in sizes)
    tokens = np.arange(3000, dtype=np.uint64)
    assert all(len(S.Bands(num, 100).keys(tokens[:n], longer=True)) == n - least[n] + 1 + S._more(n) for n in (1, 5, 24, 100, 2999))
