"""Toxicity by a weighted lexicon.

Texts are folded (lower case, no accents, homoglyphs and digits that stand for letters to those
letters, all else to one space) and an Aho-Corasick automaton finds the lexicon's entries: whole words, and
beginnings of words. Entries inside an exception phrase don't count. The weights found are summed
and divided by the root of the number of words; a logistic curve gives the score. Entries, weights,
exceptions and curve are learned from a bounded sample of labelled texts; a lexicon can also be
given.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import crc_mod, read, worker_task, written

#: Labelled texts that the lexicon and the curve are fitted on, at most, by label, chosen by a hash of doc_id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
#: Entries are words of at least so many letters or beginnings of words of these lengths, at most so many entries.
LEAST_LETTERS, PREFIXES, MOST_ENTRIES = 3, (4, 5, 6), 5000
#: An entry stands in at least so many toxic sample texts and this share of them (rare words of copied texts are no insults), with at least this log-likelihood ratio and log-odds.
LEAST_TEXTS, LEAST_SHARE, LEAST_EVIDENCE, LEAST_ODDS = 3, 0.01, 16.0, 2.0
#: A neighbour word makes an exception phrase of an entry that it has beside it in this many clean sample texts and in no toxic one.
EXCEPTION_TEXTS = 5

#: Digits and signs that stand for letters, and letters of other scripts that look like Latin ones.
DIGITS = dict(zip("0123456789@$", "oizeasgtbgas", strict=True))
HOMOGLYPHS = dict(zip("авекмнорстухѕіјԁɡıłαβεηικνορτυχ", "abekmhopctyxsijdgilabenikvoptux", strict=True))
#: An exclamation mark inside a word stands for i; at its end it is one.
_INNER_MARK = re.compile(r"(?<=[^\W_])!+(?=[^\W_])")
#: A 1 stands for i or for l, so both are one letter after folding.
ONE = {"l": "i"}
#: Beyond Latin-1, letters without a look-alike become this one, which is in no entry.
OTHER = "\xff"
#: Left out: soft hyphens, and beyond Latin-1 what has no width.
SOFT_HYPHEN, NO_WIDTH = b"\xad", {"Mn", "Me", "Cf"}


def _plain(c: str) -> str:
    """A letter without its accent, l as i."""
    base = unicodedata.normalize("NFD", c)[0]
    return ONE.get(base, base)


def _byte_table() -> bytes:
    """Latin-1 bytes after folding: plain letters, digits as their letters, all else a space."""
    return bytes(ord(DIGITS[c]) if (c := chr(i)) in DIGITS else i if c == OTHER else ord(_plain(c)) if c.isalpha() else 0x20 for i in range(256))


class _Folding(dict):
    """str.translate() table: characters beyond Latin-1 to their look-alikes, other letters, a space or nothing."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        if point < 256:
            to = c
        elif unicodedata.category(c) in NO_WIDTH:
            to = ""
        else:
            wide = unicodedata.normalize("NFKD", c)[0]
            to = HOMOGLYPHS.get(c) or HOMOGLYPHS.get(wide) or (wide if ord(wide) < 256 else OTHER if c.isalpha() else " ")
        self[point] = to
        return to


_TABLE, _FAR = _byte_table(), _Folding()


def fold(text: str | None) -> str:
    """The folded words of a text, each between single spaces; one space if there is none."""
    low = (text or "").lower()
    if "!" in low:
        low = _INNER_MARK.sub(lambda m: "i" * len(m[0]), low)
    try:
        raw = low.encode("latin-1")
    except UnicodeEncodeError:
        raw = low.translate(_FAR).lower().encode("latin-1", "replace")
    words = raw.translate(_TABLE, SOFT_HYPHEN).split()
    return (b" " + b" ".join(words) + b" ").decode("latin-1") if words else " "


def folded_entry(entry: str) -> str:
    """An entry as it stands in folded texts: a space before it, and one behind it if it is a whole word."""
    return " " + fold(entry).strip() + (" " if entry.endswith(" ") else "")


@dataclass
class Lexicon:
    """entries: ' word ' or ' beginning' to weight; exceptions: phrases; the curve's slope and height."""

    entries: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    slope: float = 2.0
    height: float = -3.0


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        import ahocorasick

        self.lexicon, self.automaton = lexicon, ahocorasick.Automaton()
        for phrase in lexicon.exceptions:
            folded = fold(phrase)
            if folded != " ":
                self.automaton.add_word(folded, (len(folded), None))
        for entry, weight in lexicon.entries.items():
            folded = folded_entry(entry)
            self.automaton.add_word(folded, (len(folded), weight))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def weigh(self, text: str | None) -> tuple[float, int, int]:
        """Sum of the weights of entries outside exceptions, number of those, number of words; of entries at one word the longest counts."""
        folded = fold(text)
        words = folded.count(" ") - 1
        best: dict[int, tuple[int, float]] = {}
        spans = []
        if not self.empty:
            for end, (size, weight) in self.automaton.iter(folded):
                start = end - size + 1
                if weight is None:
                    spans.append((start, end))
                elif start not in best or size > best[start][0]:
                    best[start] = size, weight
        if spans:
            # Some exception span covers a place if, of those that start no later, the one that goes furthest does.
            spans.sort()
            starts, reach = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))
            best = {s: x for s, x in best.items() if not ((i := bisect_right(starts, s)) and s + x[0] - 1 <= reach[i - 1])}
        return sum(w for _, w in best.values()), len(best), max(0, words)

    def raw(self, text: str | None) -> float:
        total, _, words = self.weigh(text)
        return total / math.sqrt(1 + words)

    def score(self, raw: float) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.lexicon.slope * raw + self.lexicon.height))))


def _features(folded: str) -> set[str]:
    words = {w for w in folded.split() if len(w) >= LEAST_LETTERS}
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in PREFIXES if len(w) > n}


@worker_task("toxicity")
def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts[bool(toxic)].update(_features(fold(text)))
    names = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(names), 20_000):
        part = names[at : at + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[1][x] for x in part], pa.int64()), pa.array([counts[0][x] for x in part], pa.int64())], ["entry", "toxic", "clean"])


def _context_batches(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    """Phrases of an entry's word and the word before or after it, by label of the text."""
    counts: Counter = Counter()
    matcher = Matcher(lexicon)
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            folded, found = fold(text), set()
            words = folded.split()
            places = np.flatnonzero(np.frombuffer(folded.encode("latin-1"), np.uint8) == 0x20)  # the space before each word, and the last
            starts = np.fromiter((end - size + 1 for end, (size, _) in (() if matcher.empty else matcher.automaton.iter(folded))), np.int64)
            for at in set(np.searchsorted(places, starts).tolist()):
                found |= {" ".join(words[i : i + 2]) for i in (at - 1, at) if i >= 0 and len(words) > i + 1}
            counts.update((p, bool(toxic)) for p in found)
    names = [k for k in counts]
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in names], pa.string()), pa.array([k[1] for k in names], pa.bool_()), pa.array([counts[k] for k in names], pa.int64())], ["phrase", "toxic", "n"])


def _raw_batches(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(lexicon)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([matcher.raw(t) for t in batch.column("text").to_pylist()], pa.float64()), batch.column("toxic")], ["raw", "toxic"])


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low, high = [], []
        for text in batch.column("text").to_pylist():
            words = fold(text).encode("latin-1").split()
            hashes = list(map(xxhash.xxh64_intdigest, map(b" ".join, zip(words, words[1:], words[2:], strict=False)))) or [xxhash.xxh64_intdigest(b" ".join(words))]
            low.append(min(hashes) >> 1)
            high.append(max(hashes) >> 1)
        out = {n: batch.column(n) for n in ("id", "text", "toxic")} | {"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())}
        yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic: at most SAMPLE_TOXIC and SAMPLE_CLEAN labelled rows of docs, those held out left out.

    Of texts that share the least or greatest hash of their three-word phrases, copies for the most
    part, one stays: the words of one text in many copies must not look like evidence.
    """
    labels = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    labels = labels.where(crc_mod("doc_id", 5) != 0)
    chosen = [labels.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for t, n in ((True, SAMPLE_TOXIC), (False, SAMPLE_CLEAN))]
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN ids: bounded, so it may be broadcast.
    ids = F.broadcast(chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "id"))
    rows = docs.join(ids, F.col("doc_id").cast("long") == F.col("id")).select("id", F.col("text").cast("string").alias("text"), "toxic")
    rows = rows.mapInArrow(_sketch_batches, "id long, text string, toxic boolean, low long, high long")
    for sketch in ("low", "high"):
        rows = rows.groupBy(sketch).agg(F.min_by(F.struct(*(x for x in rows.columns if x != sketch)), "id").alias("row")).select("row.*")
    return written(rows.select("text", "toxic"), "toxicity-sample")


def _curve(raw: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and height of a ridge logistic regression by Newton's method; each label weighs the same."""
    x = np.stack([raw, np.ones(len(raw))], axis=1)
    weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())) * len(raw)
    beta, ridge = np.zeros(2), np.diag([0.05, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - toxic)) + ridge @ beta)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _pruned(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Without beginnings that one longer entry explains as well or better, then without entries that a beginning left explains as well."""
    parents = {e: [p for n in PREFIXES if (p := e[: n + 1]) in found and len(p) < len(e)] for e in found}
    better = {p for e, above in parents.items() for p in above if found[e][1] >= 0.9 * found[p][1] or (found[e][0] > found[p][0] + 0.7 and found[e][1] >= 0.7 * found[p][1])}
    left = found.keys() - better
    return {e: found[e][0] for e in sorted(left) if not any(p in left and found[p][0] >= found[e][0] - 1.0 for p in parents[e])}


def learn(sample: DataFrame) -> Lexicon:
    """A lexicon from sample (text, toxic); one that finds nothing where a label has no text."""
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n, m = sizes.get(True, 0), sizes.get(False, 0)
    if not n or not m:
        return Lexicon({})
    counts = sample.mapInArrow(_feature_batches, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    t, c = F.col("t"), F.col("c")
    odds = F.log((t + 0.5) / (n + 1.0)) - F.log((c + 0.5) / (m + 1.0))

    def part(x, of):
        return F.when(x > 0, x * F.log(x / of)).otherwise(0.0)

    share = (t + c) / float(n + m)
    evidence = 2 * (part(t, n * share) + part(c, m * share))
    rows = counts.where(t >= max(LEAST_TEXTS, LEAST_SHARE * n)).select("entry", "t", odds.alias("odds"), evidence.alias("evidence")).where((F.col("odds") >= LEAST_ODDS) & (F.col("evidence") >= LEAST_EVIDENCE))
    rows = rows.orderBy(F.desc("evidence"), "entry").limit(MOST_ENTRIES).collect()
    lexicon = Lexicon(_pruned({r["entry"]: (r["odds"], r["t"]) for r in rows}))
    phrases = sample.mapInArrow(partial(_context_batches, lexicon=lexicon), "phrase string, toxic boolean, n long").groupBy("phrase").agg(F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("c"))
    lexicon.exceptions = sorted(r["phrase"] for r in phrases.where((t == 0) & (c >= EXCEPTION_TEXTS)).orderBy(F.desc("c"), "phrase").limit(MOST_ENTRIES).collect())
    raw = sample.mapInArrow(partial(_raw_batches, lexicon=lexicon), "raw double, toxic boolean").toArrow()
    lexicon.slope, lexicon.height = _curve(raw["raw"].to_numpy(), raw["toxic"].to_numpy(zero_copy_only=False).astype(bool))
    return lexicon


@worker_task("toxicity")
def _score_batches(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(lexicon)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            found = [matcher.weigh(t) for t in part.column("text").to_pylist()]
            score = [matcher.score(total / math.sqrt(1 + words)) for total, _, words in found]
            out = {x: part.column(x) for x in part.schema.names} | {"score": pa.array(score, pa.float64()), "hits": pa.array([x[1] for x in found], pa.int64())}
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """docs with score (0 to 1, higher is likelier toxic) and hits for each of its rows.

    Null and empty texts and those without a letter have no hit and the curve's least score. A text
    is matched whole, in time linear in its length. Of entries at one word the longest counts, so
    there are no ties.
    Repeated rows give repeated results; columns named ``score`` or ``hits`` give way, others pass
    through; an empty table gives an empty result. There is no shuffle.
    """
    docs = docs.drop("score", "hits").withColumn("text", F.col("text").cast("string"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["score double", "hits long"])
    return docs.mapInArrow(partial(_score_batches, lexicon=lexicon), schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted (and hits) over the whole documents table."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, learn(training_sample(docs, read(spark, sf_dir, "labels"))))
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "hits")
