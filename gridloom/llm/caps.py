"""Embedding near-dedup by spherical-cap filters.

Filter directions are the structured product of random unit codes over blocks of the coordinates
(after a random rotation): a direction is one code word of each block. A vector is list-decoded to
all directions whose cap it lies in, that is, whose inner product exceeds the threshold; the search
goes block by block and drops what the best words of the blocks left cannot lift over it. Vectors
that are near lie in many caps together, others seldom in one. How many caps a vector lies in varies
the more the more directions there are, so a vector's threshold is lowered to its own best `least`
directions where it lies in fewer; `least` is raised until probe pairs at the cosine asked for all
meet, whatever the number of directions. Vectors meet by the words of all blocks but the last, so
one row stands for many filters; all pairs that meet, those that share a filter among them, are
verified by their cosine in double precision.

Equal vectors of a label are one node with a count. A pair met under several filters counts where
its least common words are. Groups are cut into chunks that are compared two by two, so no task
holds more than two chunks, whatever the group's size, and no row is dropped. A task joins what it
links and returns one row per vector (its number of links, the least vector that those links lead
to), never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import read, written
from gridloom.llm.components import components

#: Independent codes; filters per vector and code on average; vectors per filter aimed at; code words per block at most.
CODES, FILTERS, BUCKET, WORDS = 4, 16.0, 24.0, 64
#: Directions of each code that a vector has at least, to begin with; pairs at the cosine that must all meet, or this is doubled.
LEAST, PROBES = 8, 2000
#: Vectors of a group that are compared with as many others at once.
CHUNK = 4096


class ProductCode:
    """Blocks of unit code words; decode gives all directions over the threshold."""

    def __init__(self, dim: int, n: int, seed: int = 11, filters: float = FILTERS, bucket: float = BUCKET, least: int = LEAST) -> None:
        """n: vectors of the largest label; more vectors get more directions, in more blocks where WORDS is not enough."""
        rng = np.random.default_rng(seed)
        self.least = least
        wanted = max(64.0, n * filters / bucket)
        self.blocks = max(2, min(math.ceil(math.log(wanted, WORDS)), max(2, dim // 4)))
        self.words = int(min(WORDS, max(8, math.ceil(wanted ** (1 / self.blocks)))))
        self.cut = [dim * i // self.blocks for i in range(self.blocks + 1)]
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.code = []
        for lo, hi in zip(self.cut, self.cut[1:], strict=False):
            c = rng.normal(size=(self.words, hi - lo))
            self.code.append(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(self.blocks))
        # The threshold that a random unit vector exceeds in `filters` of its directions on average.
        probe = rng.normal(size=(2000, dim))
        probe /= np.linalg.norm(probe, axis=1, keepdims=True)
        parts = self.scores(probe)
        draws = sum(p[np.arange(2000)[:, None], rng.integers(0, self.words, (2000, 500))] for p in parts)
        self.threshold = float(np.quantile(draws, 1 - min(0.5, filters / self.words**self.blocks)))

    def scores(self, unit: np.ndarray) -> list[np.ndarray]:
        turned = unit @ self.turn
        return [turned[:, lo:hi] @ c.T for lo, hi, c in zip(self.cut, self.cut[1:], self.code, strict=False)]

    def thresholds(self, parts: list[np.ndarray]) -> np.ndarray:
        """For each vector the threshold, or the score of its best direction number `least` if that is lower."""
        top = -np.sort(-parts[0], axis=1)[:, : self.least]
        for part in parts[1:]:
            sums = top[:, :, None] + -np.sort(-part, axis=1)[:, None, : self.least]
            top = -np.sort(-sums.reshape(len(part), -1), axis=1)[:, : self.least]
        return np.minimum(self.threshold, top[:, -1] - 1e-12)  # sums in another order differ by less

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each vector and prefix (words of all blocks but the last) with a direction over the vector's threshold: vector, prefix, number of such directions."""
        parts = self.scores(unit)
        threshold = self.thresholds(parts)
        best = np.cumsum([p.max(axis=1) for p in parts[::-1]], axis=0)[::-1]
        who, prefix, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for b, part in enumerate(parts[:-1]):
            reach = total[:, None] + part[who]
            row, word = np.nonzero(reach + best[b + 1][who][:, None] >= threshold[who][:, None])
            total, prefix, who = reach[row, word], prefix[row] * self.words + word, who[row]
        filters = (total[:, None] + parts[-1][who] >= threshold[who][:, None]).sum(axis=1)
        keep = filters > 0
        return who[keep], prefix[keep], filters[keep]


def probe_pairs(dim: int, cosine: float, n: int = PROBES, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors and for each another one at the cosine."""
    a, b = np.random.default_rng(seed).normal(size=(2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    return a, cosine * a + math.sqrt(max(0.0, 1 - cosine**2)) * b


class CodeSet:
    """Independent codes; a vector has the least number of directions in each."""

    def __init__(self, dim: int, n: int, codes: int = CODES, filters: float = FILTERS, cosine: float = 0.98) -> None:
        self.codes = [ProductCode(dim, n, seed, filters) for seed in range(11, 11 + codes)]
        a, b = probe_pairs(dim, cosine)
        while not self.met(a, b).all() and any(c.least < c.words**c.blocks for c in self.codes):
            for c in self.codes:
                c.least *= 2

    def met(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the unit vectors a[i] and b[i] share a prefix."""
        out = np.zeros(len(a), bool)
        for code in self.codes:
            of = code.words ** (code.blocks - 1)
            x, y = (who * of + prefix for who, prefix, _ in (code.decode(a), code.decode(b)))
            out[np.intersect1d(x, y) // of] = True
        return out

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As of one code, in the order of the vectors; prefixes of different codes differ."""
        found = [c.decode(unit) for c in self.codes]
        who, prefix, filters = (np.concatenate(x) for x in zip(*((w, p + i * c.words ** (c.blocks - 1), m) for i, (c, (w, p, m)) in enumerate(zip(self.codes, found, strict=True))), strict=True))
        order = np.argsort(who, kind="stable")
        return who[order], prefix[order], filters[order]


def _matrix(values: pa.Array) -> np.ndarray:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


def _decode_batches(batches: Iterator[pa.RecordBatch], codes: dict[int, CodeSet]) -> Iterator[pa.RecordBatch]:
    names = ["rep", "label", "dim", "size", "embedding", "prefixes"]
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            x = _matrix(part.column("embedding"))
            who, prefix, _ = codes[int(dim)].decode(x / np.linalg.norm(x, axis=1, keepdims=True))
            ends = np.searchsorted(who, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names[:5]), pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix))], names)


def _members(prefixes: pa.Array, vocabulary: np.ndarray) -> np.ndarray:
    """A row for each vector, a column for each prefix of the vocabulary: whether the vector has it."""
    out = np.zeros((len(prefixes), len(vocabulary)), bool)
    rows = np.repeat(np.arange(len(prefixes)), np.diff(prefixes.offsets.to_numpy()))
    flat = prefixes.flatten().to_numpy()
    at = np.searchsorted(vocabulary, flat)
    known = (at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == flat)
    out[rows[known], at[known]] = True
    return out


def _united(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Roots (least members) after p[i] and q[i] have joined: roots hook onto lesser ones until no pair is split."""
    while True:
        a, b = root[p], root[q]
        split = a != b
        if not split.any():
            return root
        p, q, a, b = p[split], q[split], a[split], b[split]
        root = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _verify(table: pa.Table, cosine: float) -> pa.Table:
    """One group and pair of chunks (a, b): rep, links (weighted by sizes of the vectors linked), root (the least rep that links found here lead to)."""
    prefix, a, b = (table[n][0].as_py() for n in ("prefix", "a", "b"))
    table = table.sort_by("rep")  # so that the least row of a group is its least rep
    rep, size, chunk = (table[n].to_numpy() for n in ("rep", "size", "chunk"))
    x = _matrix(table["embedding"])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    prefixes = pa.concat_arrays(table["prefixes"].chunks)
    vocabulary = np.unique(prefixes.flatten().to_numpy())
    vocabulary = vocabulary[vocabulary <= prefix]  # what comes later cannot be a pair's least
    has = _members(prefixes, vocabulary)
    links, root = np.zeros(len(rep), np.int64), np.arange(len(rep))
    left, right = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
    for lo in range(0, len(left), 512):
        rows = left[lo : lo + 512]
        i, j = np.nonzero(x[rows] @ x[right].T >= cosine)
        i, j = rows[i], right[j]
        pick = i < j if a == b else i != j
        i, j = i[pick], j[pick]
        for at in range(0, len(i), 65_536):
            p, q = i[at : at + 65_536], j[at : at + 65_536]
            own = ~(has[p, :-1] & has[q, :-1]).any(axis=1)
            p, q = p[own], q[own]
            np.add.at(links, p, size[q])
            np.add.at(links, q, size[p])
            root = _united(root, p, q)
    some = links > 0
    return pa.table({"rep": pa.array(rep[some]), "links": pa.array(links[some]), "root": pa.array(rep[root][some])})


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, embedding (doubles) of rows that can link: label not null, all components finite, not all zero."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(x, lambda v: v != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    return rows.where(fine).select(F.col("vec_id").cast("long"), "label", F.size("embedding").alias("dim"), "embedding")


def near_duplicate_links(vectors: DataFrame, cosine: float = 0.98, codes: int = CODES, filters: float = FILTERS) -> DataFrame:
    """vec_id, n_links, component_id for each row of vectors (vec_id, embedding, label).

    Vectors link if their labels are equal and not null, their dimensions are equal and the cosine in
    double precision is at least ``cosine``; equal vectors always link. Null or zero vectors and
    those with null or non-finite components link with nothing, nor do rows with a null vec_id.
    Labels may be of any type that can be grouped. Each repeated row counts as a vector of its own
    and the rows of a vec_id all get its greatest number of links and least component. A cosine of
    just the threshold links; there are no other ties. Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    clean = clean_vectors(vectors)
    groups = clean.groupBy("label", "dim", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    groups = written(groups, "vectors")
    largest = groups.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count").alias("n")).collect()  # one row for each dimension in use
    code_sets = {r["dim"]: CodeSet(r["dim"], r["n"], codes, filters, cosine) for r in largest}
    kinds = dict(clean.dtypes)
    kind = kinds["embedding"]
    fields = f"rep long, label {kinds['label']}, dim int, size long, embedding {kind}, prefixes array<long>"
    decoded = groups.select("rep", "label", "dim", "size", "embedding").mapInArrow(partial(_decode_batches, codes=code_sets), fields)
    decoded = written(decoded, "filters")
    keys = decoded.select("label", "dim", F.explode("prefixes").alias("prefix"))
    chunks = keys.groupBy("label", "dim", "prefix").count().select("label", "dim", "prefix", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"), "count").where("count > 1").drop("count")
    # What joins back is a table of its own: adaptive skew handling splits a hot key only between plain exchanges.
    chunks = written(chunks, "chunks")
    members = decoded.select("*", F.explode("prefixes").alias("prefix")).join(chunks, ["label", "dim", "prefix"])
    members = members.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    other = F.explode(F.expr("sequence(0, chunks - 1)"))
    members = members.select("rep", "label", "dim", "size", "embedding", "prefixes", "prefix", "chunk", other.alias("other"))
    members = members.withColumns({"a": F.least("chunk", "other"), "b": F.greatest("chunk", "other")}).drop("other")
    found = members.groupBy("label", "dim", "prefix", "a", "b").applyInArrow(lambda table: _verify(table, cosine), "rep long, links long, root long")
    found = written(found, "links")
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    links = written(found.groupBy("rep").agg(F.sum("links").alias("links")), "counts")
    named = groups.join(links, "rep", "left").join(roots, "rep", "left")
    named = named.select("label", "dim", "embedding", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    named = written(named, "named")
    placed = clean.join(named, ["label", "dim", "embedding"]).select("vec_id", "n_links", "component_id").groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(placed, "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept over the whole embeddings table."""
    found = near_duplicate_links(read(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: All pairs of a label: what the filters find if they miss nothing.
ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT l.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, l.vec_id = l.component_id AS kept FROM least l LEFT JOIN counts c ON c.vec_id = l.vec_id
"""
