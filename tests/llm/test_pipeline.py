"""The pipeline stage by stage on planted cases, and the registry."""

import random

import corpus_pipeline
from gridloom.llm import registry


def planted(make_docs):
    rng = random.Random(11)
    word = lambda k: "".join(rng.choices("abcdeiorst", k=k))
    vocabulary = [word(rng.randint(2, 9)) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(60, 200))) for _ in range(120)]
    near = texts[5].split()
    near[10] = "changed"
    passage = " ".join(rng.choices(vocabulary, k=55))
    texts += [texts[4], " ".join(near), None, "123 456"]
    texts[20] += " " + passage
    texts[30] += " " + passage
    return make_docs(texts, source=[f"src{i % 6}" for i in range(len(texts))]), passage


def test_stages(spark, make_docs, as_table):
    docs, passage = planted(make_docs)
    where = as_table(documents=docs)
    known = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, where)
        docs.cache().count()
        known[name] = docs
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in known.items()}
    assert ids["language_id"] == set(range(122))
    assert ids["simhash_dedup"] == set(range(120))
    texts = {r["doc_id"]: r["text"] for r in known["substring_dedup"].collect()}
    assert passage in texts[20] and passage not in texts[30]
    assert known["substring_dedup"].columns == known["mixture"].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 0 < len(ids["mixture"]) <= 120 and ids["mixture"] == ids["bpe"]
    run = corpus_pipeline.run(spark, where)
    assert {r["doc_id"] for r in run.select("doc_id").collect()} == ids["bpe"]
    assert run.where("size(ids) <> n_tokens").count() == 0


def test_registry_has_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "mixture", "bpe"]
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for f in (root / "gridloom").rglob("*.py"):
        if "llm" not in f.parts:
            assert "gridloom.llm" not in f.read_text(), f
