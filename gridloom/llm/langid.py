"""Language identification by interpolated Kneser-Ney character models.

One model per language over lower-case letters, with runs of anything else as one space. Counts of
4-grams come from a bounded sample of labelled texts; lower orders are continuation counts. Each
order's discounted probabilities and back-off weights lie in arrays sorted by the hash of their
n-gram. A text goes to the language with the least cross-entropy per character, and is rejected if
even that is far over what labelled texts of the language that no model was fitted on have.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import CACHES, crc_mod, mix, read, worker_task, written

ORDER, BASE_BITS = 4, 6
#: Symbols: 0 is a run of non-letters, 1 any letter outside the alphabet, then the letters that rank first in some language.
ALPHABET = (1 << BASE_BITS) - 2
#: The sample has about this many texts of each language, chosen by a hash of doc_id (all, if fewer), of as many languages at most (those with the most texts).
SAMPLE_TEXTS, MOST_LANGUAGES = 2000, 200
#: One in so many texts of the sample is left out of the models and calibrates the rejection.
CALIBRATE = 4
#: Characters of text scored at once, and bytes of log-probabilities that a worker keeps.
BLOCK, KNOWN_BYTES = 1 << 18, 64 << 20
#: Rejection: a text's cross-entropy less SHORT / sqrt(its symbols), four standard errors of a mean of that many, must not
#: exceed this quantile of the calibrating texts of its language by more than so many times the quantile's distance from their median.
QUANTILE, MARGIN, LEAST_SPREAD, SHORT = 0.99, 3.0, 0.05, 8.0
NO_LETTER = "und"


def _is_letter() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x10000)])


@dataclass
class Symbols:
    """Letters to symbols. Characters beyond the basic plane count as letters outside the alphabet if they are letters."""

    letters: str
    table: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.table = _is_letter().astype(np.uint32)
        for i, c in enumerate(self.letters):
            self.table[ord(c)] = i + 2

    def encode(self, text: str) -> np.ndarray:
        """Symbols with one space before and after, runs of spaces joined; empty if there is no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(points) and points.max() >= 0x10000:
            far = np.flatnonzero(points >= 0x10000)
            points = points.copy()
            points[far] = [0xAA if chr(p).isalpha() else 0x20 for p in points[far]]
        symbols = np.concatenate([[0], self.table[points], [0]]).astype(np.uint32)
        symbols = symbols[np.append(True, (symbols[1:] != 0) | (symbols[:-1] != 0))]
        return symbols if len(symbols) > 1 else symbols[:0]


def grams(symbols: np.ndarray) -> np.ndarray:
    """For each symbol after the first space the 4-gram that ends there; what stands before the text are spaces."""
    padded = np.concatenate([np.zeros(ORDER - 2, np.uint32), symbols])
    out = np.zeros(len(symbols) - 1, np.uint32)
    for i in range(ORDER):
        out = (out << np.uint32(BASE_BITS)) | padded[i : i + len(out)]
    return out


def hashed(codes: np.ndarray, order: int) -> np.ndarray:
    return mix(codes.astype(np.uint64) * np.uint64(8) + np.uint64(order))


@dataclass
class KneserNey:
    """One language: by order, sorted n-gram hashes with discounted probabilities, sorted context hashes with back-off weights."""

    probability: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    weight: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @classmethod
    def fit(cls, codes: np.ndarray, counts: np.ndarray) -> KneserNey:
        model, counts = cls(), counts.astype(np.float64)
        for order in range(ORDER, 0, -1):
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context, at = np.unique(codes >> BASE_BITS, return_inverse=True)
            total, kinds = np.bincount(at, counts), np.bincount(at)
            model.probability[order] = cls.sorted(hashed(codes, order), np.maximum(counts - discount, 0) / total[at])
            model.weight[order] = cls.sorted(hashed(context, order), discount * kinds / total)
            # The next lower order counts in how many left contexts each shorter n-gram stands.
            codes, counts = np.unique(codes & ((1 << BASE_BITS * (order - 1)) - 1), return_counts=True)
            counts = counts.astype(np.float64)
        return model

    @staticmethod
    def sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        return keys[order], values[order].astype(np.float32)

    @staticmethod
    def lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, default: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return np.where(table[0][at] == keys, table[1][at], np.float32(default))

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        p = np.full(len(codes), 1.0 / (1 << BASE_BITS))
        for order in range(1, ORDER + 1):
            part = codes & np.uint32((1 << BASE_BITS * order) - 1) if order < ORDER else codes
            p = self.lookup(self.probability[order], hashed(part, order), 0.0) + self.lookup(self.weight[order], hashed(part >> np.uint32(BASE_BITS), order), 1.0) * p
        return np.log(np.maximum(p, 1e-12)).astype(np.float32)


@dataclass
class LanguageModel:
    languages: list[str]
    symbols: Symbols
    models: list[KneserNey]
    limits: list[float] = field(default_factory=list)


class Scorer:
    """Cross-entropies of texts; log-probabilities of the 4-grams that this worker has met are kept, one row each, up to KNOWN_BYTES."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.row = np.zeros(1 << BASE_BITS * ORDER, np.int32)
        self.known, self.used = np.zeros((1 << 12, len(model.languages)), np.float32), 1

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Where in known the codes' log-probabilities stand."""
        row = self.row[codes]
        if row.all():
            return row
        new = np.unique(codes[row == 0])
        if (self.used + len(new)) * 4 * len(self.model.languages) > KNOWN_BYTES:
            self.row[:], self.used = 0, 1
            new = np.unique(codes)
        end = self.used + len(new)
        if end > len(self.known):
            self.known = np.concatenate([self.known[: self.used], np.zeros((2 * end - self.used, self.known.shape[1]), np.float32)])
        self.known[self.used : end] = np.stack([m.log_probability(new) for m in self.model.models], axis=1)
        self.row[new] = np.arange(self.used, end)
        self.used = end
        return self.row[codes]

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the number of symbols scored, 0 if it has no letter, and a row of nats per symbol by language."""
        found = np.zeros((len(texts), len(self.model.languages)))
        size = np.zeros(len(texts), np.int64)
        held, parts, total = [], [], 0
        for i, text in enumerate(texts):
            symbols = self.model.symbols.encode(text) if text else ()
            if len(symbols):
                size[i] = len(symbols) - 1
                held.append(i)
                parts.append(grams(symbols))
                total += size[i]
            if total >= BLOCK or (i == len(texts) - 1 and held):
                starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                codes = np.concatenate(parts)
                sums = np.zeros((len(held), found.shape[1]))
                for lo in range(0, len(codes), BLOCK):  # a long text is scored by blocks, so that the rows that it needs at once are bounded
                    row = self.rows(codes[lo : lo + BLOCK])
                    first = int(np.searchsorted(starts, lo, side="right")) - 1
                    cut = np.maximum(starts[first:-1], lo) - lo
                    cut = cut[cut < len(row)]
                    for j in range(found.shape[1]):
                        sums[first : first + len(cut), j] += np.add.reduceat(self.known[:, j][row].astype(np.float64), cut)
                found[held] = -sums / size[held][:, None]
                held, parts, total = [], [], 0
        return size, found


_SCORERS: dict = {}
CACHES["langid"] = _SCORERS


def _scorer(shared) -> Scorer:
    if shared.id not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[shared.id] = Scorer(shared.value)
    return _SCORERS[shared.id]


class _Shared:
    """A broadcast model with a name that stays the same in all of a worker's tasks."""

    def __init__(self, broadcast) -> None:
        self.broadcast, self.id = broadcast, f"{broadcast._jbroadcast.id()}"

    @property
    def value(self):
        return self.broadcast.value

    def __reduce__(self):
        return _restored, (self.broadcast, self.id)


def _restored(broadcast, name: str) -> _Shared:
    shared = _Shared.__new__(_Shared)
    shared.broadcast, shared.id = broadcast, name
    return shared


def _letter_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update((text or "").lower())
    for lang, found in counts.items():
        rows = [(c, n) for c, n in found.items() if c.isalpha() and ord(c) < 0x10000]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array([c for c, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["lang", "letter", "n"])


def alphabet(sample: DataFrame) -> str:
    """The letters with the best rank by frequency in any language of sample (lang, text), so that every script has some."""
    counts = sample.select("lang", "text").mapInArrow(_letter_batches, "lang string, letter string, n long").groupBy("lang", "letter").agg(F.sum("n").alias("n"))
    # A window over the letters of one language: at most 65,536 rows.
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "letter")))
    best = ranked.groupBy("letter").agg(F.min("rank").alias("rank"), F.sum("n").alias("n")).orderBy("rank", F.desc("n"), "letter").limit(ALPHABET)
    return "".join(r["letter"] for r in best.collect())


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of several texts as one."""
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


@worker_task("langid")
def _gram_batches(batches: Iterator[pa.RecordBatch], symbols: Symbols) -> Iterator[pa.RecordBatch]:
    counts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            codes = symbols.encode(text or "")
            if len(codes):
                held = counts.setdefault(lang, [])
                held.append(np.unique(grams(codes), return_counts=True))
                if len(held) > 200:
                    counts[lang] = [_added(held)]
    for lang, held in counts.items():
        codes, n = _added(held)
        for at in range(0, len(codes), 50_000):
            part = codes[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part.astype(np.int32)), pa.array(n[at : at + 50_000])], ["lang", "code", "n"])


@worker_task("langid")
def _excess_batches(batches: Iterator[pa.RecordBatch], shared: _Shared) -> Iterator[pa.RecordBatch]:
    """lang, excess: a labelled text's cross-entropy in its language less what it may have more for being short."""
    scorer = _scorer(shared)
    for batch in batches:
        size, found = scorer.cross_entropy(batch.column("text").to_pylist())
        known = {x: i for i, x in enumerate(scorer.model.languages)}
        at = np.array([known.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
        own = found[np.arange(len(found)), at] - SHORT / np.sqrt(np.maximum(size, 1))
        keep = (size > 0) & (at >= 0)  # a language whose texts have no letter has no model
        yield pa.RecordBatch.from_arrays([batch.column("lang").filter(pa.array(keep)), pa.array(own[keep])], ["lang", "excess"])


def training_sample(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """lang, text, calibrates: about sample_texts rows of each of the languages with the most rows of docs (doc_id, text, lang), by a hash of doc_id; all rows where there are fewer."""
    labelled = docs.where("lang is not null and text is not null").select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    # At most most_languages rows.
    kept = F.broadcast(counts.select("lang", F.least(F.lit(1.0), F.lit(sample_texts) / F.col("count")).alias("kept")))
    rows = labelled.join(kept, "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < F.col("kept") * 1_000_000)
    return written(rows.select("lang", "text", (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(CALIBRATE)) == 0).alias("calibrates")), "language-sample")


def fit(sample: DataFrame) -> LanguageModel | None:
    """Models of the languages of sample (lang, text, calibrates); None if no text to fit on has a letter. A language without calibrating texts rejects nothing."""
    spark = sample.sparkSession
    fitted = sample.where(~F.col("calibrates"))
    symbols = Symbols(alphabet(fitted))
    # Sample texts and languages are bounded, so the counts are.
    counts = fitted.select("lang", "text").mapInArrow(partial(_gram_batches, symbols=symbols), "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    if not counts.num_rows:
        return None
    lang, code, n = counts["lang"].to_numpy(zero_copy_only=False), counts["code"].to_numpy().astype(np.uint32), counts["n"].to_numpy()
    languages = sorted(set(lang))
    models = []
    for x in languages:
        own = lang == x
        order = np.argsort(code[own])
        models.append(KneserNey.fit(code[own][order], n[own][order]))
    model = LanguageModel(languages, symbols, models)
    shared = _Shared(spark.sparkContext.broadcast(model))
    excess = sample.where("calibrates").select("lang", "text").mapInArrow(partial(_excess_batches, shared=shared), "lang string, excess double")
    levels = {r["lang"]: r["q"] for r in excess.groupBy("lang").agg(F.percentile("excess", [0.5, QUANTILE]).alias("q")).collect()}
    model.limits = [high + max(MARGIN * (high - middle), LEAST_SPREAD) for middle, high in (levels.get(x, (0.0, float("inf"))) for x in languages)]
    return model


@worker_task("langid")
def _predict_batches(batches: Iterator[pa.RecordBatch], shared: _Shared) -> Iterator[pa.RecordBatch]:
    scorer = _scorer(shared)
    names = np.array(scorer.model.languages, object)
    limits = np.array(scorer.model.limits)
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            size, found = scorer.cross_entropy(part.column("text").to_pylist())
            best = found.argmin(axis=1)
            gap = (found - found.min(axis=1, keepdims=True)) * np.minimum(size, 200)[:, None]
            score = 1.0 / np.exp(-gap).sum(axis=1)
            none = size == 0
            entropy = found[np.arange(len(found)), best]
            rejected = none | (entropy - SHORT / np.sqrt(np.maximum(size, 1)) > limits[best])
            out = {x: part.column(x) for x in part.schema.names} | {
                "lang_pred": pa.array(np.where(none, NO_LETTER, names[best]), pa.string()), "score": pa.array(np.where(none, 0.0, score)),
                "cross_entropy": pa.array(entropy, mask=none), "rejected": pa.array(rejected),
            }
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """docs with lang_pred, score, cross_entropy and rejected for each of its rows.

    lang_pred is a learned language, ``und`` with score 0 for null and empty texts and those without
    a letter, which are also rejected. Equal cross-entropies give the language that comes first by
    name. score is the chosen language's share of the likelihood over at most 200 characters; a long
    text is scored whole, by blocks. Without a model (no labelled text) all is ``und`` and rejected.
    Repeated rows give repeated results; columns named like a result give way, others pass through;
    an empty table gives an empty result.
    """
    added = ["lang_pred", "score", "cross_entropy", "rejected"]
    docs = docs.drop(*added).withColumn("text", F.col("text").cast("string"))
    if model is None:
        return docs.select("*", F.lit(NO_LETTER).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["lang_pred string", "score double", "cross_entropy double", "rejected boolean"])
    return docs.mapInArrow(partial(_predict_batches, shared=_Shared(docs.sparkSession.sparkContext.broadcast(model))), schema)


def learn(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> LanguageModel | None:
    """Models from a sample of docs; rows whose crc32 of doc_id leaves 2 by 4 are held out, as are those without doc_id."""
    return fit(training_sample(docs.where(crc_mod("doc_id", 4) != 2), sample_texts))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score (and cross_entropy, rejected) over the whole documents table."""
    docs = read(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
