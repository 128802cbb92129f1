"""Toxicity, BPE, WARC, language ID, mixing and licenses."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gridloom.llm import bpe, langid, licenses, mixing, toxicity, warc


def test_folding_undoes_look_alikes_and_digits():
    assert toxicity.fold("1D10T!") == toxicity.fold("!!! id!ot !") == " idiot "
    assert toxicity.fold("6a26 9oo") == " gazg goo "
    assert toxicity.fold("іdіоt") == " idiot "
    assert toxicity.fold(None) == toxicity.fold("  ?? ") == " "
    assert toxicity.fold("Ça—va") == " ca va "
    assert toxicity.fold("c1own l0ser") == toxicity.fold("Clown LÖSER") == " ciown ioser "
    assert toxicity.fold("i\u0308d\u200bi\xadot ｉｄｉｏｔ Жук") == " idiot idiot \xffyk "


def test_longest_entry_counts_once_and_exceptions_do_not():
    m = toxicity.Matcher(toxicity.Lexicon({"scum ": 3.0, " scu": 1.0, " idio": 2.0, "loser ": 1.0}, ["scum of the pond"]))
    assert m.weigh("Scum, idiots!") == (5.0, 2, 2)
    assert m.weigh("the scum of the pond") == (0, 0, 5)
    assert m.weigh("") == (0, 0, 0)
    assert m.weigh("1oser") == (1.0, 1, 1)
    assert toxicity.Matcher(toxicity.Lexicon({})).score(0.0) < 0.5


def plain_weigh(lexicon, text):
    """Every entry tried at every word, every exception at every place."""
    words = toxicity.fold(text).split()
    line = toxicity.fold(text)
    phrases = [toxicity.fold(p) for p in lexicon.exceptions]
    covered = [(i, i + len(p) - 1) for p in phrases if p != " " for i in range(len(line)) if line.startswith(p, i)]
    total, hits, at = 0.0, 0, 0
    for word in words:
        found = {}
        for entry, weight in lexicon.entries.items():
            folded = toxicity.folded_entry(entry)
            if line.startswith(folded, at):
                found[len(folded)] = weight
        if found and not any(a <= at and at + max(found) - 1 <= b for a, b in covered):
            total, hits = total + found[max(found)], hits + 1
        at += len(word) + 1
    return total, hits, len(words)


def test_weights_equal_brute_force():
    rng = random.Random(3)
    words = ["bad", "badly", "b4d", "news", "idea", "scum", "scumbag", "pond", "of", "the", "Bàd", "idi0t", "id!ot", "!", "12"]
    lexicon = toxicity.Lexicon({"bad ": 2.0, " ba": 0.5, " scum": 1.5, "scumbag ": 3.0, "idiot ": 4.0, " id": 0.25}, ["bad news", "scum of the pond", "the bad", "of the bad news", "idea bad"])
    matcher = toxicity.Matcher(lexicon)
    for _ in range(400):
        text = rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.randint(0, 30)))
        got, want = matcher.weigh(text), plain_weigh(lexicon, text)
        assert got[1:] == want[1:] and abs(got[0] - want[0]) < 1e-9, text


def test_long_texts_take_linear_time():
    import time

    lexicon = toxicity.Lexicon({"bad ": 2.0, " idea": 1.0}, ["bad news"])
    matcher = toxicity.Matcher(lexicon)
    text = "bad news bad idea " * 110_000  # about 2 MB
    began = time.perf_counter()
    assert matcher.weigh(text)[1:] == (220_000, 440_000)
    assert time.perf_counter() - began < 2.0
    import pyarrow as pa

    began = time.perf_counter()
    batch = pa.RecordBatch.from_pydict({"text": [text], "toxic": [False]})
    assert sum(b.num_rows for b in toxicity._context_batches(iter([batch]), lexicon)) > 0
    assert time.perf_counter() - began < 4.0


def toxic_corpus(n=600):
    rng = random.Random(2)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("ln", "rt", "mp")]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(6, 120))
        toxic = i % 5 == 1
        if toxic:
            for _ in range(max(2, len(text) // 40)):
                text[rng.randrange(len(text))] = rng.choice(["vermin", "Verm1n", "zorx" + rng.choice("abcdef")])
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_toxicity_is_learned_from_labels(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([r[:2] for r in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(toxicity.training_sample(docs, labels))
    assert " zorx" in lexicon.entries and any(e.startswith(" verm") for e in lexicon.entries)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs.withColumn("score", F.lit("mine")), lexicon).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum((got[r[0]] >= 0.5) == bool(r[2]) for r in held) / len(held) > 0.97
    assert got[9000] == got[9001] < 0.5
    none = toxicity.learn(toxicity.training_sample(docs, labels.limit(0)))
    assert toxicity.score(docs, none).where("score >= 0.5").count() == 0


TEXTS = ["The quick brown fox's 3 jumps!", "", None, "déjà vu ÀÉÎ ß", "<|endoftext|> a <|startoftext|>b", "İstanbul ΣΑΣ ａｂｃ é 中文 مرحبا", "\x1c\x85  x y", "don't we'll I'M 12 ½ ٣", "word " * 3000, "🙂👍🏽", "a\u0000b"]


def test_bpe_equals_the_library(spark, make_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = make_docs([*TEXTS, TEXTS[0]]).withColumn("ids", F.lit(1))
    got = {r["doc_id"]: r for r in bpe.encode_decode(docs, outputs=tuple(bpe.OUTPUTS)).collect()}
    for i, t in enumerate([*TEXTS, TEXTS[0]]):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (list(got[i]["ids"]), got[i]["decoded"], got[i]["n_tokens"]) == (ids, text, len(ids)), t
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_decode(docs.limit(0)).count() == 0


def test_word_table_has_each_frequent_word_once(spark, make_docs):
    rows = bpe.word_table(make_docs(["low lower lowest low low low lower lower lower"] * 3), bpe._default_spec(), 5).collect()
    assert [r["word"] for r in sorted(rows, key=lambda r: r["word"])] == ["low", "lower"]
    assert all(len(r["ids"]) == len(r["pieces"]) and "".join(r["pieces"]) == r["word"] + "</w>" for r in rows)


def pages(spark):
    big, other = "<p>é</p>" * 200, "<b>x</b>" * 200
    rows = [(1, "http://a/1", big), (2, "http://a/2", "small"), (3, None, big), (4, "http://a/4\r\nX: y", other), (5, "u", None), (6, "u", ""), (7, "u", big), (8, "u", "small"), (None, "u", other)]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


def test_archives_are_read_back(spark):
    df, rows = pages(spark)
    index, folder = warc.write_archives(df.repartition(3))
    found = {r["page_id"]: r for r in warc.read_records(index, folder).collect()}
    assert len(found) == 9
    for page_id, url, html in rows:
        r, payload = found[page_id], (html or "").encode()
        assert (r["payload_bytes"], r["digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        revisit = {1: 7, 3: 7}.get(page_id)
        assert (r["record_type"], r["refers_to"]) == (("revisit", revisit) if revisit else ("response", None))
        assert r["payload"] == (None if revisit else payload)
        assert r["url"] == (url or "").replace("\r", "%0D").replace("\n", "%0A")
    some = warc.read_records(index.where("page_id in (2, 7)"), folder)
    assert {r["page_id"] for r in some.collect()} == {2, 7}
    empty, folder = warc.write_archives(df.limit(0))
    assert warc.read_records(empty, folder).count() == 0


def test_repeated_page_ids_keep_each_payload(spark):
    x, y = "x" * 2000, "y" * 3000
    rows = [(1, "a", x), (1, "b", y), (5, "c", x), (5, "d", x), (6, "e", y), (6, "f", x), (2, "g", x), (2, "g", x)]
    index, folder = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted((r["url"], r["page_id"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]).decode()) for r in warc.read_records(index, folder).collect())
    assert got == [("a", 1, "revisit", 6, None), ("b", 1, "revisit", 6, None), ("c", 5, "revisit", 6, None), ("d", 5, "revisit", 6, None), ("e", 6, "response", None, y), ("f", 6, "response", None, x), ("g", 2, "revisit", 6, None), ("g", 2, "revisit", 6, None)]
    other = spark.createDataFrame([(1, "a", x), (1, "b", y), (5, "c", x)], "page_id long, url string, html string")
    index, folder = warc.write_archives(other)
    got = sorted((r["url"], r["record_type"], r["refers_to"]) for r in warc.read_records(index, folder).collect())
    assert got == [("a", "revisit", 5), ("b", "response", None), ("c", "response", None)]


def test_archives_are_read_by_as_many_tasks_as_stretches(spark, monkeypatch):
    monkeypatch.setattr(warc, "STRETCH", 20_000)
    monkeypatch.setattr(warc, "LEAST_STRETCH", 20_000)
    rng = random.Random(1)
    rows = [(i, "u", "".join(rng.choices("abcdefgh", k=1500))) for i in range(400)]
    index, folder = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    total = index.agg(F.sum("length")).first()[0]
    read = warc.read_records(index, folder)
    tasks = read.groupBy(F.spark_partition_id()).count().count()
    assert total // 20_000 <= tasks <= total // 20_000 + 1 and tasks > 5
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in read.collect()} == {r[0]: r[2] for r in rows}


def test_archive_query_equals_its_sql(spark, as_table):
    import duckdb

    df, _ = pages(spark)
    where = as_table(pages=df.where("page_id is not null").union(spark.createDataFrame([(1, "u", "z" * 1200), (2, "u", "z" * 1200), (7, "v", "z" * 999)], df.schema)))
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{where}/pages.parquet/*.parquet'")
    want = sorted(con.sql(warc.ORACLE_SQL).fetchall())
    got = warc.op3_warc(spark, where).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == want


def test_record_round_trip_and_damage():
    data = warc.record(5, "http://x", b"body", None)
    head, http, payload = warc.parse(data)
    assert payload == b"body" and head["WARC-Type"] == "response" and http["Content-Length"] == "4"
    assert warc.packed(data) == warc.packed(data) and zlib.decompress(warc.packed(data), 31) == data
    with pytest.raises(ValueError):
        warc.parse(data[:-5])


LANGUAGES = {"aa": ["bala", "kaba", "lakala", "baka"], "ee": ["berek", "rekebe", "kereb", "ere"], "oo": ["ñoro", "moñor", "romo", "oro"]}


def spoken(n=240, seed=4):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(LANGUAGES[k], k=rng.randint(8, 60))), k) for i, k in enumerate(rng.choices(list(LANGUAGES), k=n))]


def test_languages_and_rejection(spark):
    rows = spoken()
    docs = spark.createDataFrame([*rows, (900, None, None), (901, "12 !!", "aa"), (902, "", None), (903, "zq zq xj qz wvw xq " * 20, None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify(docs.withColumn("score", F.lit(5)), langid.learn(docs)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert held and all(got[i]["lang_pred"] == k and 0.5 < got[i]["score"] <= 1 for i, _, k in held)
    assert not any(got[i]["rejected"] for i, _, _ in rows)
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[903]["rejected"] and got[903]["lang_pred"] in LANGUAGES
    assert langid.learn(docs.where("lang is null")) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}


def plain_kneser_ney(texts, letters):
    """Interpolated Kneser-Ney over symbols by dictionaries: log-probability of a symbol after three others."""
    import math
    from collections import Counter, defaultdict

    def symbols(text):
        out = [0]
        for c in text.lower():
            x = letters.index(c) + 2 if c in letters else 1 if c.isalpha() else 0
            out += [x] if x or out[-1] else []
        return out + [0] if out[-1] else out

    counts = Counter()
    for t in texts:
        padded = [0, 0, *symbols(t)]
        counts.update(tuple(padded[i : i + 4]) for i in range(len(padded) - 3))
    orders = {4: counts}
    for k in (3, 2, 1):
        orders[k] = Counter(g[1:] for g in orders[k + 1])
    discount, total, kinds = {}, {}, {}
    for k, found in orders.items():
        one, two = (sum(n == m for n in found.values()) for m in (1, 2))
        discount[k] = one / (one + 2 * two) if one and two else 0.5
        total[k], kinds[k] = defaultdict(int), defaultdict(int)
        for g, n in found.items():
            total[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1

    def probability(g):
        k = len(g)
        lower = probability(g[1:]) if k > 1 else 1 / 64
        if not total[k][g[:-1]]:
            return lower
        return max(orders[k][g] - discount[k], 0) / total[k][g[:-1]] + discount[k] * kinds[k][g[:-1]] / total[k][g[:-1]] * lower

    def entropy(text):
        padded = [0, 0, *symbols(text)]
        each = [math.log(probability(tuple(padded[i : i + 4]))) for i in range(len(padded) - 3)]
        return -sum(each) / len(each)

    return entropy


def test_predictions_equal_plain_kneser_ney(spark):
    rows = spoken(160, 5)
    docs = spark.createDataFrame([*rows, (500, "bala Ñoro berek ꙮ ere " * 50, None), (501, "b", None)], "doc_id long, text string, lang string")
    sample = langid.training_sample(docs.where("doc_id % 3 > 0"))
    model = langid.fit(sample)
    fitted = sample.where("not calibrates").collect()
    plain = {k: plain_kneser_ney([r["text"] for r in fitted if r["lang"] == k], model.symbols.letters) for k in LANGUAGES}
    assert set("balkereñom") <= set(model.symbols.letters)
    for r in langid.identify(docs, model).collect():
        want = {k: f(r["text"]) for k, f in plain.items()}
        assert abs(r["cross_entropy"] - min(want.values())) < 1e-4
        assert r["lang_pred"] == min(want, key=want.get)
    excess = {k: sorted(plain[k](r["text"]) - 8 / len(langid.grams(model.symbols.encode(r["text"]))) ** 0.5 for r in sample.where("calibrates").collect() if r["lang"] == k) for k in LANGUAGES}
    for k, limit in zip(model.languages, model.limits, strict=True):
        assert limit > excess[k][-1] or len(excess[k]) > 100


def test_long_texts_and_many_languages_are_bounded(monkeypatch, spark):
    import numpy as np

    rows = [(i, " ".join(random.Random(i % 7 * 100 + i).choices([a + b for a in "bcdfg" for b in "aeiou"], k=30)), f"l{i % 7}") for i in range(210)]
    docs = spark.createDataFrame([*rows, (999, "x y z", "rare")], "doc_id long, text string, lang string")
    assert len(langid.fit(langid.training_sample(docs, most_languages=3)).languages) == 3
    model = langid.fit(langid.training_sample(docs))
    texts = [rows[0][1] * 400, rows[3][1], None, "12", rows[5][1] * 90]
    size, whole = langid.Scorer(model).cross_entropy(texts)
    monkeypatch.setattr(langid, "BLOCK", 1000)
    monkeypatch.setattr(langid, "KNOWN_BYTES", 4000)
    again, blocks = langid.Scorer(model).cross_entropy(texts)
    assert (size == again).all() and np.allclose(whole, blocks)


def test_kneser_ney_sums_to_one():
    import numpy as np

    symbols = langid.Symbols("abc")
    codes, counts = np.unique(np.concatenate([langid.grams(symbols.encode(t)) for t in ("abc cab bca", "aab bba", "cc ab")]), return_counts=True)
    model = langid.KneserNey.fit(codes, counts)
    for context in (codes[0] >> 6, codes[5] >> 6, np.uint32(77)):
        every = (np.uint32(context) << np.uint32(6)) | np.arange(64, dtype=np.uint32)
        assert abs(np.exp(model.log_probability(every).astype(float)).sum() - 1) < 1e-4


def test_budgets_go_to_siblings_first():
    leaves = [("d0", "en", "s0", 100), ("d0", "en", "s3", 1000), ("d0", "fr", "s6", 1000), ("d1", "en", "s1", 1000)]
    t = mixing.Targets(({"d0": 1.0, "d1": 1.0}, {}, {}), tokens=1600, epochs=1)
    got = mixing.budgets(leaves, t)
    assert got[leaves[3][:3]] == 800 and got[leaves[2][:3]] == 400
    assert got[leaves[0][:3]] == 100 and got[leaves[1][:3]] == 300
    more = mixing.budgets(leaves, mixing.Targets(t.weights, tokens=2800, epochs=1))
    assert more[leaves[3][:3]] == 1000 and sum(more.values()) == 2800
    assert sum(mixing.budgets(leaves, mixing.Targets(t.weights, tokens=99_999, epochs=2)).values()) == 6200
    assert mixing.shared_out(10, [("a", 0.0, 5), ("b", 1.0, 3)]) == {"a": 0, "b": 3}


def plain_mix(rows, targets):
    """rows (doc_id, text, lang, source); the same selection by sorting each leaf."""
    leaves = {}
    for doc_id, text, lang, source in rows:
        digits = "".join(c for c in source or "" if c.isdigit())
        path = (f"d{int(digits) % 3}" if digits else "other", lang or "none", source or "none")
        leaves.setdefault(path, []).append((doc_id, len((text or "").encode().split())))
    sums = [(*p, sum(n for _, n in x)) for p, x in leaves.items()]
    out = []
    for p, budget in mixing.budgets(sums, targets).items():
        total = sum(n for _, n in leaves[p])
        full, rest = divmod(budget, total) if total else (0, 0)
        out += [(d, e) for d, _ in leaves[p] for e in range(1, full + 1)]
        used = 0
        if rest:
            for d, n in sorted(leaves[p], key=lambda x: hashlib.md5(f"{targets.seed}:{full + 1}:{x[0]}".encode()).hexdigest()):
                used += n
                if used > rest:
                    break
                out.append((d, full + 1))
    return sorted(out)


@pytest.mark.parametrize("share", [0.05, 0.6, 1.7])
def test_mixture_equals_plain_selection(spark, make_docs, share):
    rng = random.Random(6)
    n = 400
    texts = [None if i == 3 else " ".join("w" for _ in range(rng.randint(0, 60))) for i in range(n)]
    sources = [None if i == 7 else rng.choice(["src0"] * 6 + [f"src{k}" for k in range(1, 7)] + ["web"]) for i in range(n)]
    langs = [None if i == 9 else rng.choice(["en", "en", "fr", "de"]) for i in range(n)]
    docs = make_docs(texts, source=sources, lang=langs).withColumn("bucket", F.lit(1)).withColumn("extra", F.lit("e"))
    targets = mixing.Targets(({"d0": 5.0, "d1": 3.0}, {"en": 4.0}, {}), share=share, epochs=3)
    got = mixing.mix(docs, targets)
    assert "extra" in got.columns
    assert sorted((r["doc_id"], r["epoch"]) for r in got.collect()) == plain_mix(list(zip(range(n), texts, langs, sources, strict=True)), targets)
    assert mixing.mix(docs.limit(0), targets).count() == 0


def test_repeated_rows_do_not_exceed_a_leaf(spark, make_docs, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join("w" for _ in range(rng.randint(1, 40))) for _ in range(200)]
    docs = make_docs(texts, source=[f"src{i % 4}" for i in range(200)])
    docs = docs.union(docs.where("doc_id % 3 = 0").withColumn("source", F.lit("src1"))).union(docs.where("doc_id % 7 = 0"))
    docs = docs.union(docs.where("doc_id < 60").withColumn("doc_id", F.lit(None).cast("long"))).withColumn("nth", F.monotonically_increasing_id())
    docs = docs.cache()
    rows = [(r["source"], len((r["text"] or "").split())) for r in docs.collect()]
    leaves = [(f"d{int(k[3:]) % 3}", "en", k, sum(n for s, n in rows if s == k)) for k in ("src0", "src1", "src2", "src3")]
    for share in (0.2, 0.55, 1.3):
        targets = mixing.Targets(share=share, epochs=2)
        got = mixing.mix(docs, targets)
        taken = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
        for leaf, budget in mixing.budgets(leaves, targets).items():
            assert budget - 3 * 40 * 3 <= taken.get(leaf[2], 0) <= budget, (share, leaf)
        assert got.groupBy("nth", "epoch").count().where("count > 1").count() == 0
        monkeypatch.setattr(mixing, "LEVELS", 1)
        assert sorted(map(tuple, mixing.mix(docs, targets).select("nth", "epoch").collect())) == sorted(map(tuple, got.select("nth", "epoch").collect()))
        monkeypatch.undo()


def test_license_places(spark, make_docs):
    texts = ["Licensed under CC BY-NC 4.0.", "x Licensed under the Apache License, Version 2.0 y", "GNU General Public License", "Released under the MIT License.", "All rights reserved. ALL  RIGHTS-RESERVED", None, "", "Licensed under the Apache License 3.0", "Copyright (c) 2020 Some Body. All rights reserved", "under the mit licence", "reserved " * 5000]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(make_docs(texts)).collect()}
    labels = {i: {x["label"] for x in r["templates"]} for i, r in got.items()}
    assert labels == {0: {"cc-by-nc"}, 1: {"apache-2.0"}, 2: set(), 3: {"mit"}, 4: set(), 5: set(), 6: set(), 7: set(), 8: set(), 9: set(), 10: set()}
    assert [(x["first"], x["last"], x["label"]) for x in got[4]["phrases"]] == [(0, 2, "reserved"), (3, 5, "reserved")]
    assert [len(got[i]["phrases"]) for i in (0, 2, 8)] == [1, 1, 1]
    assert (got[5]["n_words"], got[0]["n_words"], got[10]["n_words"]) == (0, 7, 5000)
    assert licenses.scan_licenses(make_docs([])).count() == 0


def accepted(matcher, text):
    return {label for _, _, label in matcher.scan(text)[2]}


def test_whole_licenses_are_accepted_and_altered_ones_refused():
    import re

    from gridloom.llm import license_texts

    matcher = licenses.Matcher(license_texts.TEMPLATES, licenses.BASE_PHRASES)
    marks = re.compile("<<(/?optional|var .*?)>>")
    rng = random.Random(5)
    for label, markup in (license_texts.TEXTS | license_texts.NOTICES).items():
        # Every region once with its words and once without.
        full = marks.sub(lambda m: " The Regents of Somewhere " if m[1] == "var holder 16" else " one " if m[1].startswith("var") else " ", markup)
        bare = marks.sub(" ", re.sub("<<optional>>.*?<</optional>>", " ", markup))
        for text in (full, bare):
            assert label in accepted(matcher, f"Copyright (c) 2020 Some Body\n\n{text.upper()} and more"), label
        required = [w.decode() for w in matcher.required(markup)]
        plain = [w.decode() for w in licenses.fold(bare).split()]
        assert plain == required
        for at in {0, len(plain) - 1, *rng.sample(range(len(plain)), 12)}:
            for altered in (plain[:at] + ["unlike"] + plain[at + 1 :], plain[:at] + plain[at + 1 :], plain[:at] + ["unlike"] * 17 + plain[at:]):
                if (0 < at < len(plain) - 1 or len(altered) <= len(plain)) and altered != plain:
                    assert label not in accepted(matcher, " ".join(altered)) or "unlike" not in altered and plain[at] in (plain[at - 1], plain[min(at + 1, len(plain) - 1)]), (label, at, plain[at])
    mit = license_texts.TEXTS["mit-text"]
    assert accepted(matcher, mit[:130] + " to look at it on Tuesdays only; no copying") == set()
    assert accepted(matcher, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: pay us") == set()


@pytest.mark.parametrize(("text", "labels"), [
    ("SPDX-License-Identifier: MPL-2.0", {"mpl-2.0"}), ("the Mozilla Public License, version 2.0", {"mpl-2.0"}), ("GNU Affero General Public License", {"agpl"}),
    ("CC BY-ND 4.0", {"cc-by-nd"}), ("CC BY-NC-SA 3.0", {"cc-by-nc-sa"}), ("Creative Commons Attribution-NonCommercial 4.0 International License", {"cc-by-nc"}),
    ("Creative Commons Attribution 4.0 International Public License", {"cc-by-license"}), ("SPDX-License-Identifier: GPL-3.0-or-later", {"gpl"}), ("cc by", set()),
])
def test_licenses_by_name(text, labels):
    assert accepted(licenses.Matcher(licenses.TEMPLATES, licenses.BASE_PHRASES), f"x {text} y") == labels


def test_template_regions():
    m = licenses.Matcher({"t": "alpha <<optional>>beta <<optional>>gamma<</optional>><</optional>> delta <<var x 2>> end"}, {})
    where = lambda text: [(a, b) for a, b, _ in m.scan(text)[2]]
    assert where("alpha delta end") == [(0, 2)] and where("alpha beta gamma delta one two end") == [(0, 6)]
    assert where("alpha gamma delta end") == [] and where("alpha delta one two three end") == []
    with pytest.raises(ValueError):
        licenses.Matcher({"t": "<<var x 2>> end"}, {})


def test_scan_query_equals_its_sql(spark, make_docs, as_table):
    import re

    import duckdb

    from gridloom.llm import license_texts

    texts = ["Licensed under CC BY-NC 4.0. cc by", "the GNU General Public License, either version 3", license_texts.TEXTS["bsd-3-clause-text"].replace("<<", " ").replace(">>", " "), re.sub("<<.*?>>", " ", license_texts.TEXTS["isc-text"]), "Copyright (c) 2020 Some Body and Co. All rights reserved", "é İ Under the MIT License x", None, "", "all rights\nreserved all rights reserved"]
    where = as_table(documents=make_docs(texts))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{where}/documents.parquet/*.parquet'")
    want = sorted(con.sql(licenses.ORACLE_SQL).fetchall(), key=lambda r: r[0])
    got = sorted(map(tuple, licenses.op9_license_scan(spark, where).collect()))
    assert got == want
