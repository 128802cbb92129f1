"""Every query and the pipeline over tables with nulls everywhere, repeated rows, clashing columns, and no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import registry

CLASHING = ["spans", "fp", "seed", "extension", "epoch", "tokens", "score", "ids", "component_id", "rejected", "lang_pred", "n_tokens", "n_words", "key", "bucket", "domain", "language", "tie", "print", "rep", "label_", "toxic", "held_out", "row", "a", "b", "hits", "part", "parts", "dim", "size", "refers_to", "digest"]

LONG = " ".join(f"word{i % 997}" for i in range(60_000))
DOCS = [
    (1, "The house is on the hill and the river runs by the house", "en", "src1", 5), (1, "The house is on the hill and the river runs by the house", "en", "src1", 5),
    (2, None, "en", "src2", 0), (3, "", None, None, None), (4, LONG, "en", None, None), (5, LONG + " tail", None, "src0", None), (None, "nobody knows this text", "fr", "web", 1), (None, None, None, None, None),
    (6, "\x00 \x1f ‮ 🙂 ﷽", "xx", "src9", 2), (7, "12345 !!!", "de", "src1", 1), (8, "x" * 200_000, "en", "src1", 200_000),
    (-9, "Das Haus steht am Berg und der Fluss geht am Haus vorbei", "de", "src4", 4), (2**62, "La maison est sur la colline et la rivière passe près de la maison", "fr", "source", 3),
]


def frames(spark, n=None):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (4, None, None), (4, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    pages = spark.createDataFrame([(1, None, None), (2, "u", "é" * 900), (3, "u", "é" * 900), (3, "u", "é" * 900), (None, None, "x" * 2000), (4, "", "")], "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("offset", F.lit(1))
    vectors = [(i, [float((i * k) % 7 - 3) for k in range(1, 17)], i % 2) for i in range(40)]
    vectors += [vectors[0], (None, vectors[1][1], 1), (100, None, 1), (101, [], 1), (102, [1.0, 2.0], 0), (103, [1.0, 2.0], 0), (104, [0.0] * 16, 0), (105, [None] * 16, 0), (106, [float("nan")] * 16, 1), (107, vectors[2][1], None), (120, [1e-30] * 16, 0)]
    embeddings = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").withColumn("parts", F.lit("clash")).withColumn("rep", F.lit("clash"))
    out = {"documents": docs, "labels": labels, "pages": pages, "embeddings": embeddings}
    return {k: v.limit(0) if n == 0 else v for k, v in out.items()}


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_odd_rows(spark, as_table, name):
    made = frames(spark)
    got = registry.QUERIES[name](spark, as_table(**made))
    rows = got.collect()
    source = {"op3_warc": "pages", "op6_embedding_dedup": "embeddings"}.get(name, "documents")
    if name not in ("op7_mixing", "op10_nearest"):
        assert len(rows) == made[source].count()
    assert "clash" not in {v for r in rows for v in r}


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_no_rows(spark, as_table, name):
    assert registry.QUERIES[name](spark, as_table(**frames(spark, 0))).collect() == []


@pytest.mark.parametrize("n", [None, 0])
def test_pipeline(spark, as_table, n):
    where = as_table(**frames(spark, n))
    rows = corpus_pipeline.run(spark, where).collect()
    assert bool(rows) == (n is None)
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, where)
        assert docs.columns == [*["doc_id", "text", "lang", "source", "n_chars"], *CLASHING]
