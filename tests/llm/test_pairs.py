"""SimHash, substring and embedding dedup, and nearest neighbours, against brute force."""

import random

import numpy as np
import pytest
import xxhash

from gridloom.llm import caps, routing, simhash, substring
from gridloom.llm.components import components


def union(ids, linked):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)] + [(200, 201), (201, 202), (202, 200)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["root"] for r in found.collect() if r["node"] != r["root"]}
    want = union({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tables_are_removed(spark):
    from pathlib import Path

    from gridloom.llm.common import remove_tables, written

    table = written(spark.range(5), "five")
    where = Path(table.inputFiles()[0].removeprefix("file:")).parent
    assert table.count() == 5 and where.exists()
    remove_tables(spark)
    assert not where.exists()


def plain_simhash(text, k):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(seed=3, groups=12, size=6):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(40, 200))
        for c in range(size):
            words = list(base)
            for _ in range(c % 3):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
    return [*out, None, "", "  \t", "One", "one", "Two Words", "x y z " * 3000, out[0], out[0]]


def test_simhash_groups_equal_brute_force(spark, make_docs):
    texts = near_texts()
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(make_docs(texts)).collect()}
    prints = [plain_simhash(t, 3) for t in texts]
    assert {i: p for i, (p, _) in got.items()} == dict(enumerate(prints))
    links = [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {i: c for i, (_, c) in got.items()} == union(range(len(texts)), links)


def test_hot_shards_are_split_without_loss(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = list({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(100)})
    rows = [(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)]
    edges = simhash.link_edges(spark.createDataFrame(rows, "fp long, rep long"), hot_shard=20)
    got = union(range(len(values)), [(r["a"], r["b"]) for r in edges.collect()])
    assert got == union(range(len(values)), [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3])


def test_tree_and_bulk_tree_agree():
    rng = random.Random(1)
    values = [rng.getrandbits(16) for _ in range(300)]
    values = list(dict.fromkeys(values))
    tree = simhash.BKTree()
    for v in values:
        tree.insert(v)
    for v in values[:50]:
        assert sorted(tree.values[i] for i in tree.within(v, 3)) == sorted(x for x in values if (x ^ v).bit_count() <= 3)
    small, large = simhash.linked_small(values, 2), simhash.linked_large(np.array(values, np.uint64), 2)
    assert len(set(zip(small, large.tolist(), strict=True))) == len(set(small)) == len(set(large.tolist()))


def test_near_copies_join_and_others_stay(spark, make_docs):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = []
    for _ in range(40):
        base = rng.choices(vocabulary, k=300)
        copy = list(base)
        for _ in range(4):
            copy[rng.randrange(300)] = rng.choice(vocabulary)
        texts += [" ".join(base), " ".join(copy)]
    texts += [None, "", "a", "b"]
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(make_docs(texts)).collect()}
    assert all(found[i] == i // 2 * 2 for i in range(80))
    assert all(found[i] == i for i in range(80, 84))


def edited_corpus(seed, n):
    """Texts, many of them edits of others, a few of one large family; None and odd ones among them."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(2000)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 150))) for _ in range(n)]
    for _ in range(2 * n):
        words = rng.choice(texts[: n // 2] if rng.random() < 0.6 else texts[:1]).split()
        for _ in range(rng.randint(0, max(1, len(words) // 30))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    return [*texts, None, "", " \n", texts[0].upper(), "é " * 40]


def plain_near_copies(texts, similarity=0.8, k=5):
    grams = []
    for t in texts:
        words = (t or "").encode().lower().split()
        grams.append({b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {b" ".join(words)} if words else None)
    linked = [(i, j) for j, b in enumerate(grams) for i, a in enumerate(grams[:j]) if a and b and len(a & b) >= similarity * len(a | b)]
    return union(range(len(texts)), linked), linked


def test_near_copies_equal_brute_force(spark, make_docs):
    texts = edited_corpus(12, 150)
    want, linked = plain_near_copies(texts)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(make_docs(texts)).collect()}
    assert len(linked) > 1000
    assert sum(got[a] == got[b] for a, b in linked) / len(linked) > 0.995
    assert all(want[got[i]] == want[i] for i in got)  # none joins what the shingles don't


def test_near_copies_do_not_depend_on_partitions(spark, make_docs, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL_BAND", 8)
    docs = make_docs(edited_corpus(13, 100))
    first = None
    for n in (3, 7, 13):
        monkeypatch.setattr(simhash, "BAND_CHUNK", 64)
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(40 * n))
        try:
            got = sorted(map(tuple, simhash.near_copies(docs.repartition(n, "text")).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        first = first or got
        assert got == first


def brute_substring(texts, length):
    seen, removed = set(), []
    words = [(t or "").encode().split() for t in texts]
    for w in words:
        gone = set()
        for s in range(len(w) - length + 1):
            window = tuple(w[s : s + length])
            if window in seen:
                gone.update(range(s, s + length))
            seen.add(window)
        removed.append(gone)
    return [[x.decode() for i, x in enumerate(w) if i not in g] for w, g in zip(words, removed, strict=True)]


@pytest.mark.parametrize("length", [20, 8])
def test_substrings_equal_brute_force(spark, make_docs, length):
    rng = random.Random(length)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "ß"]
    passages = [rng.choices(vocabulary, k=rng.randint(5, 60)) for _ in range(12)]
    texts = []
    for _ in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(1, 40)) for _ in range(rng.randint(1, 5))]
        texts.append(rng.choice([" ", "\n", "\x0b"]).join(x for p in parts for x in p))
    texts += [None, "", "short", "a " * 500, "a " * 30, texts[3], texts[3], " ".join(passages[0] * 6), "\xa0".join(["no", "split"] * 30)]
    k = min(substring.SEED_WORDS, length - 2)
    got = {r["doc_id"]: r for r in substring.dedup_text(make_docs(texts), length, k).collect()}
    want = brute_substring(texts, length)
    for i, t in enumerate(texts):
        assert got[i]["n_removed"] == len((t or "").encode().split()) - len(want[i]), i
        assert got[i]["text"] == (t if not got[i]["n_removed"] else " ".join(want[i]))
    assert got[0]["lang"] == "en"


def test_substrings_of_odd_tables(spark, make_docs, tmp_path):
    from pyspark.sql import functions as F

    assert substring.dedup_text(make_docs([])).count() == 0
    docs = make_docs([" ".join(f"a{i}" for i in range(30))] * 2)
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") == 1, F.lit(None)).otherwise(F.col("doc_id"))).withColumn("spans", F.lit(1)).withColumn("seed", F.lit("x"))
    assert sorted(r["n_removed"] for r in substring.dedup_text(docs).collect()) == [0, 0]
    twice = make_docs([" ".join(f"a{i}" for i in range(30))]).union(make_docs([" ".join(f"a{i}" for i in range(30))]))
    assert [r["n_removed"] for r in substring.dedup_text(twice).collect()] == [0, 0]


def vectors(seed=0, n=500, labels=3, copies=60, dim=32):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    base = rng.normal(size=(4, dim))
    near = np.concatenate([b + 0.12 * rng.normal(size=(copies, dim)) * np.linalg.norm(b) / np.sqrt(dim) for b in base]).astype(np.float32)
    x = np.concatenate([x, near, x[:30], 2 * x[:5]])
    return x, rng.integers(0, labels, len(x))


def vector_rows(x, label):
    rows = [(i, [float(v) for v in e], int(k)) for i, (e, k) in enumerate(zip(x, label, strict=True))]
    n, dim = len(rows), x.shape[1]
    odd = [None, [0.0] * dim, [float("nan")] * dim, [None] * dim, [float("inf")] + [1.0] * (dim - 1)]
    return rows + [(n + i, e, 0) for i, e in enumerate(odd)] + [(n + len(odd), [float(v) for v in x[0]], None)]


def test_embedding_links_equal_brute_force(spark):
    x, label = vectors()
    label[500:] = 0
    label[740:770] = label[:30]
    df = spark.createDataFrame(vector_rows(x, label), "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in caps.near_duplicate_links(df).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = union(range(len(x)), list(zip(*np.nonzero(near), strict=True)))
    assert {i: got[i] for i in range(len(x))} == {i: (int(near[i].sum()), want[i]) for i in range(len(x))}
    assert all(got[i] == (0, i) for i in range(len(x), len(x) + 6))


def chained(n, length, dim, rng, closed=False):
    """n chains of vectors: neighbours at a cosine of 0.985, others under 0.98; the least id is anywhere in its chain."""
    rows = []
    for _ in range(n):
        u, v = np.linalg.qr(rng.normal(size=(dim, 2)))[0].T
        turn = np.arccos(0.985)
        rows += [np.cos(k * turn) * u + np.sin(k * turn) * v for k in range(length)]
        if closed:  # a detour from the last back to the first
            rows += [np.cos(k * turn) * u + np.sin(k * turn) * v for k in range(length, int(np.ceil(2 * np.pi / turn)))]
    order = rng.permutation(len(rows))
    return [rows[i] for i in order]


@pytest.mark.parametrize("chunk", [4096, 24])
@pytest.mark.parametrize(("length", "closed"), [(3, False), (9, False), (5, True)])
def test_embedding_chains_and_loops_are_one_component(spark, monkeypatch, length, closed, chunk):
    monkeypatch.setattr(caps, "CHUNK", chunk)
    rng = np.random.default_rng(length)
    x = np.array(chained(40 if not closed else 4, length, 64, rng, closed) + list(rng.normal(size=(200, 64))))
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, [float(c) for c in v], "one") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in caps.near_duplicate_links(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    want = union(range(len(x)), list(zip(*np.nonzero(near), strict=True)))
    assert got == {i: (int(near[i].sum()), want[i]) for i in range(len(x))}


def test_embedding_chunks_lose_nothing(spark, monkeypatch):
    x, label = vectors(2, 200, 1)
    df = spark.createDataFrame(vector_rows(x, label), "vec_id long, embedding array<double>, label int")
    whole = {r["vec_id"]: tuple(r) for r in caps.near_duplicate_links(df).collect()}
    monkeypatch.setattr(caps, "CHUNK", 16)
    assert {r["vec_id"]: tuple(r) for r in caps.near_duplicate_links(df).collect()} == whole
    assert caps.near_duplicate_links(df.limit(0)).count() == 0


def test_nearest_has_the_recall_aimed_at(spark):
    from pyspark.sql import functions as F

    x, label = vectors(4, 3000)
    df = spark.createDataFrame(vector_rows(x, label), "vec_id long, embedding array<float>, label int")
    got = {}
    for r in routing.nearest(df, F.col("vec_id") % 20 == 0, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    y = np.concatenate([x, x[:1]]).astype(float)
    ids = [*range(len(x)), len(x) + 5]
    hits = total = 0
    for q in (i for i in ids if i % 20 == 0):
        scores = y @ y[ids.index(q)]
        order = [ids[k] for k in np.lexsort((ids, -scores)) if ids[k] != q][:10]
        assert [g[0] for g in got[q]] == list(range(1, 11))
        assert all(abs(s - scores[ids.index(v)]) < 1e-9 for _, v, s in got[q])
        assert [(-s, v) for _, v, s in got[q]] == sorted((-s, v) for _, v, s in got[q])
        hits, total = hits + len(set(order) & {v for _, v, _ in got[q]}), total + 10
    assert hits / total >= 0.9
    few = routing.nearest(df.where("vec_id in (0, 20, 21)"), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 4 and routing.nearest(df.limit(0), F.lit(True)).count() == 0


def test_balanced_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(50, 8)) * 0.1 + c for c in np.eye(8) * 3])
    graph = routing.neighbour_graph(x, 5)
    label = routing.balanced_parts(x, graph, 8)
    assert set(np.bincount(label)) == {50}
    assert (label[graph] == label[:, None]).mean() > 0.8


def test_caps_of_large_tables_miss_no_pair():
    a, b = np.random.default_rng(1).normal(size=(2, 1000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    codes = caps.CodeSet(64, 2_000_000)
    (who, prefix, _), (other, met, _) = codes.decode(a), codes.decode(b)
    assert set(who) == set(range(1000))
    assert {i for i, _ in set(zip(who, prefix, strict=True)) & set(zip(other, met, strict=True))} == set(range(1000))


@pytest.mark.parametrize("chunk", [4096, 40])
def test_near_copies_within_a_family_are_found(spark, make_docs, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "BAND_CHUNK", chunk)
    shared = [f"s{i}" for i in range(420)]
    texts = []
    for i in range(300):
        own = [f"o{i}_{k}" for k in range(75)]
        texts += [" ".join(shared + own), " ".join(shared + own[:35] + [f"c{i}_{k}" for k in range(40)])]
    grams = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    alike = lambda a, b: len(grams[a] & grams[b]) / len(grams[a] | grams[b])
    assert alike(0, 1) > 0.84 and alike(0, 2) < 0.74
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(make_docs(texts)).collect()}
    assert sum(found[i + 1] == i for i in range(0, 600, 2)) >= 291
    assert all(found[i] in (i, i - 1) for i in range(600))


def test_repeated_lines_do_not_decide_near_copies(spark, make_docs):
    line = " ".join(f"l{i}" for i in range(11))
    own = [" ".join(f"d{d}_{i}" for i in range(150)) for d in range(3)]
    texts = [f"{own[0]} " + f"{line} " * 50, f"{own[1]} " + f"{line} " * 50, f"{own[2]} {line} {line}", f"{own[2]} " + f"{line} " * 60]
    prints = [simhash.long_simhash(simhash.lowered_words(t), 5) for t in texts]
    far = lambda a, b: np.bitwise_count(prints[a] ^ prints[b]).sum() / 1024
    assert far(0, 1) > 0.3 and far(2, 3) < 0.05
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(make_docs(texts)).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 2}
