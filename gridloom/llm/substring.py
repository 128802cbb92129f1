"""Exact substring dedup by seed and extend over words.

A window is ``length`` consecutive words of a document. Winnowing takes the k-gram with the least
hash of each window (k < length), so equal windows name equal seeds. The windows that name one seed
occurrence are consecutive; the words they cover together are the seed's extension, as far to the
left and right as the seed can be needed. Occurrences of a seed with equal extensions hold the same
windows, so only the earliest of each such class is kept and all others are repeats as a whole; the
earliest ones of classes that share a seed are then compared window by window. Repeats that overlap
join into maximal ones. Equality is tested on two 64-bit hashes, the seed's and the extension's.

No step pairs the occurrences of a seed: classes are minima with map-side combining, and what joins
them back is split by adaptive skew handling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import byte_words, mix, prefix_hashes, read, rows_of, span_hashes, word_hashes, worker_task, written

SEED_WORDS = 6


def anchors(prefix: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one text's prefix hashes: for each seed occurrence its hash, first window and number of windows."""
    n = len(prefix) - 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(np.uint64), none, none
    at = np.arange(n - k + 1)
    gram = span_hashes(prefix, at, at + k)
    order = mix(gram ^ np.uint64(0x5BF03635))  # what is least must not favour any words
    width = length - k + 1
    chosen = np.arange(n - length + 1) + np.lib.stride_tricks.sliding_window_view(order, width).argmin(axis=1)
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    count = np.diff(np.append(first, len(chosen)))
    return gram[chosen[first]], first, count


@worker_task("substring")
def _anchor_batches(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    names = ["seed", "extension", "doc_id", "start", "windows"]

    def flush(parts: list[tuple]) -> pa.RecordBatch:
        seed, ext, doc, start, windows = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(ext.view(np.int64)), pa.array(doc), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32))], names)

    parts, rows = [], 0
    for doc_id, text in rows_of(batches, "doc_id", "text"):
        words = byte_words(text)
        if doc_id is None or len(words) < length:
            continue
        prefix = prefix_hashes(word_hashes(words))
        seed, first, count = anchors(prefix, length, k)
        # The place of the seed in its extension follows from the words, so equal extensions hold equal windows.
        parts.append((seed, span_hashes(prefix, first, first + count + length - 1), np.full(len(seed), doc_id, np.int64), first, count))
        rows += len(seed)
        if rows > 50_000:
            yield flush(parts)
            parts, rows = [], 0
    if parts:
        yield flush(parts)


@worker_task("substring")
def _window_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, spans of (seed, start, windows)) to one row for each window: seed, window, doc_id, start."""
    names = ["seed", "window", "doc_id", "start"]

    def flush(parts: list[tuple]) -> pa.RecordBatch:
        seed, window, doc, start = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(seed), pa.array(window.view(np.int64)), pa.array(doc), pa.array(start.astype(np.int32))], names)

    parts, rows = [], 0
    for doc_id, text, spans in rows_of(batches, "doc_id", "text", "spans"):
        prefix = prefix_hashes(word_hashes(byte_words(text)))
        count = np.array([x["windows"] for x in spans])
        seed = np.repeat(np.array([x["seed"] for x in spans], np.int64), count)
        start = np.repeat(np.array([x["start"] for x in spans]), count) + np.concatenate([np.arange(c) for c in count])
        parts.append((seed, span_hashes(prefix, start, start + length), np.full(len(start), doc_id, np.int64), start))
        rows += len(start)
        if rows > 50_000:
            yield flush(parts)
            parts, rows = [], 0
    if parts:
        yield flush(parts)


def repeated_spans(docs: DataFrame, length: int = 20, k: int = SEED_WORDS) -> DataFrame:
    """doc_id, first, last: words first..last lie in windows that also start earlier. Spans may overlap."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Written, as it is read twice and takes a pass over all texts.
    found = written(texts.mapInArrow(partial(_anchor_batches, length=length, k=k), "seed long, extension long, doc_id long, start int, windows int"), "anchors")
    # What joins back is a table of its own: adaptive skew handling splits a hot key only between plain exchanges.
    again = written(found.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "again")
    again = written(found.join(again, "seed"), "seeds")
    place = F.struct("doc_id", "start")
    classes = again.groupBy("seed", "extension").agg(F.min(place).alias("least"), F.min("windows").alias("windows"), F.count("*").alias("n"))
    classes = written(classes, "classes")
    later = again.join(classes.where("n > 1").select("seed", "extension", "least"), ["seed", "extension"]).where(place > F.col("least"))
    whole = later.select("doc_id", F.col("start").alias("first"), (F.col("start") + F.col("windows") + F.lit(length - 2)).alias("last"))
    shared = written(classes.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "shared")
    firsts = classes.join(shared, "seed").select("least.doc_id", F.struct("seed", "least.start", "windows").alias("span"))
    firsts = firsts.groupBy("doc_id").agg(F.collect_list("span").alias("spans"))
    windows = written(texts.join(firsts, "doc_id").mapInArrow(partial(_window_batches, length=length), "seed long, window long, doc_id long, start int"), "windows")
    least = written(windows.groupBy("seed", "window").agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1").select("seed", "window", "least"), "least")
    single = windows.join(least, ["seed", "window"]).where(place > F.col("least"))
    return whole.union(single.select("doc_id", F.col("start").alias("first"), (F.col("start") + F.lit(length - 1)).alias("last")))


def _merged(spans: list[dict], n: int) -> np.ndarray:
    """Which of n words no span covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum([x["first"] for x in spans], n), 1)
    np.add.at(edge, np.minimum([x["last"] + 1 for x in spans], n), -1)
    return np.cumsum(edge[:-1]) == 0


@worker_task("substring")
def _kept_batches(batches: Iterator[pa.RecordBatch], names: list[str], text_too: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            total, removed, digests, texts = [], [], [], []
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                words = byte_words(text)
                kept = words if not spans else [words[i] for i in np.flatnonzero(_merged(spans, len(words)))]
                total.append(len(words))
                removed.append(len(words) - len(kept))
                joined = b" ".join(kept)
                if text_too:
                    texts.append(text if not spans else joined.decode("utf-8", "surrogatepass"))
                else:
                    digests.append(hashlib.sha256(joined).hexdigest())
            out = {n: part.column(n) for n in names if n != "text"}
            out |= {"text": pa.array(texts, pa.string())} if text_too else {}
            out |= {"n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
            out |= {} if text_too else {"kept_sha256": pa.array(digests, pa.string())}
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def _with_spans(docs: DataFrame, length: int, k: int) -> DataFrame:
    spans = repeated_spans(docs, length, k).groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    return docs.join(spans, F.col("doc_id").cast("long") == F.col("__doc"), "left").drop("__doc")


def dedup_text(docs: DataFrame, length: int = 20, k: int = SEED_WORDS) -> DataFrame:
    """docs with the repeated words taken out of text, and n_words, n_removed behind its columns.

    A text that loses nothing is kept as it is, one that does is its kept words joined by a space.
    Null and empty texts and those under ``length`` words lose nothing, nor does a row with a null
    doc_id. Rows that share a doc_id are one document as to order: a window is not a repeat of the
    same place in another row of its own doc_id, and each of the rows loses what any of them does.
    A very long text is read whole, by the one task that holds it, and an empty table gives an empty
    one. Other columns pass through, whatever their names, but for a column named ``spans``,
    ``n_words`` or ``n_removed``, which gives way.
    """
    docs = docs.drop("spans", "n_words", "n_removed")
    names = docs.columns
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes if n != "text")
    out = _with_spans(docs, length, k).mapInArrow(partial(_kept_batches, names=names, text_too=True), f"{fields}, text string, n_words long, n_removed long")
    return out.select(*names, "n_words", "n_removed")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 over the whole documents table."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return _with_spans(docs, 20, SEED_WORDS).mapInArrow(partial(_kept_batches, names=["doc_id", "text"], text_too=False), "doc_id long, n_words long, n_removed long, kept_sha256 string")


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words)
), again AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS nth FROM windows
), gone AS (
  SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(s, s + 20)) AS i FROM again WHERE nth > 1)
), each_word AS (
  SELECT doc_id, i, w[i] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
), kept AS (
  SELECT e.doc_id, string_agg(e.t, ' ' ORDER BY e.i) AS t, count(*) AS n
  FROM each_word e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i WHERE g.i IS NULL GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
