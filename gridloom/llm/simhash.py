"""SimHash near-duplicate detection with BK-trees over shards of fingerprints.

A fingerprint bit is set if it is set in over half of the XXH64 hashes of a text's word shingles.
Fingerprints within the radius r of each other agree on at least one of r + 1 bit blocks, so every
distinct fingerprint goes to r + 1 shards, one for each block value, and each shard is a BK-tree
(children keyed by the integer Hamming distance to their parent; a search follows the edges within
the radius). A shard's tree is built where its rows are shuffled to: the trees of all shards grow
with the corpus, so they have no size bound and are not broadcast. A shard with more than
``hot_shard`` fingerprints is split again by blocks of its other bits, which loses no pair. A shard
returns a star for each group of linked fingerprints, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import POLY, mix, read, worker_task, written
from gridloom.llm.components import components

BITS = 64
#: Groups of up to this many fingerprints are inserted one by one, larger ones level by level.
SMALL_GROUP = 48


def lowered_words(text: str | None) -> list[bytes]:
    """A-Z in lower case (bytes.lower() touches no others), words as in byte_words."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def simhash(words: list[bytes], shingle: int, seed: int = 42) -> int:
    """The unsigned fingerprint: repeated shingles count each time; too few words are one shingle; no word gives 0."""
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    total, n = np.zeros(BITS, np.int64), 0
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(seed)), np.uint64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        total += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


@worker_task("simhash")
def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            found = np.fromiter((simhash(lowered_words(t), shingle) for t in part.column("text").to_pylist()), np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long); one row for each row of docs."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_fingerprint_batches, shingle=shingle), "doc_id long, fp long")


class BKTree:
    """Fingerprints by integer distance: kids[node] maps a distance to the child at it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.kids: list[dict[int, int]] = []

    def insert(self, value: int) -> int:
        node = 0
        if not self.values:
            self.values, self.kids = [value], [{}]
            return 0
        while True:
            d = (value ^ self.values[node]).bit_count()
            if d == 0:
                return node
            below = self.kids[node].get(d)
            if below is None:
                self.kids[node][d] = len(self.values)
                self.values.append(value)
                self.kids.append({})
                return len(self.values) - 1
            node = below

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [0] if self.values else []
        while stack:
            node = stack.pop()
            d = (value ^ self.values[node]).bit_count()
            if d <= radius:
                found.append(node)
            for key, below in self.kids[node].items():
                if d - radius <= key <= d + radius:
                    stack.append(below)
        return found


def linked_small(values: list[int], radius: int) -> list[int]:
    """For each of distinct values the index of its group's first member; one insertion and search at a time."""
    tree, up = BKTree(), []

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, v in enumerate(values):
        near = tree.within(v, radius)
        up.append(i)
        tree.insert(v)
        for j in near:
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def linked_large(values: np.ndarray, radius: int) -> np.ndarray:
    """The same for many values: the tree is built level by level and all values search it together."""
    label = np.arange(len(values))
    children: dict[int, list[tuple[int, int]]] = {}
    work = [np.arange(len(values))]
    while work:
        members = work.pop()
        node, rest = int(members[0]), members[1:]
        if not len(rest):
            continue
        d = np.bitwise_count(values[rest] ^ values[node])
        order = np.argsort(d, kind="stable")
        for part in np.split(rest[order], np.flatnonzero(np.diff(d[order])) + 1):
            children.setdefault(node, []).append((int(np.bitwise_count(values[part[0]] ^ values[node])), int(part[0])))
            work.append(part)
    search = [(0, np.arange(len(values)))]
    while search:
        node, asking = search.pop()
        d = np.bitwise_count(values[asking] ^ values[node]).astype(np.int64)
        names = np.unique(np.append(label[asking[d <= radius]], label[node]))
        if len(names) > 1:
            label[np.isin(label, names)] = names[0]
        for key, below in children.get(node, ()):
            follow = asking[np.abs(d - key) <= radius]
            if len(follow):
                search.append((below, follow))
    return label


@worker_task("simhash")
def _stars(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from the members of each linked group to its smallest representative; rows come sorted by shard."""
    left: list[np.ndarray] = []

    def groups(key, fp, rep):
        ends = np.flatnonzero(np.diff(key)) + 1
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        for lo, hi in zip(np.append(0, ends), np.append(ends, len(key)), strict=True):
            if hi - lo < 2:
                continue
            values, reps = fp[lo:hi], rep[lo:hi]
            label = np.array(linked_small(values.tolist(), radius)) if hi - lo <= SMALL_GROUP else linked_large(values, radius)
            names, inverse = np.unique(label, return_inverse=True)
            if len(names) == len(values):
                continue
            least = np.full(len(names), np.iinfo(np.int64).max)
            np.minimum.at(least, inverse, reps)
            far = least[inverse]
            a.append(reps[far != reps])
            b.append(far[far != reps])
        none = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a or [none])), pa.array(np.concatenate(b or [none]))], ["a", "b"])

    for batch in batches:
        key, fp, rep = (np.concatenate([x, batch.column(n).to_numpy()]) if left else batch.column(n).to_numpy() for n, x in zip(("shard", "fp", "rep"), left or [None] * 3, strict=True))
        if not len(key):
            continue
        last = np.searchsorted(key, key[-1]) if key[0] <= key[-1] else 0
        fp = fp.view(np.uint64) if fp.dtype == np.int64 else fp
        if last:
            yield groups(key[:last], fp[:last], rep[:last])
        left = [key[last:], fp[last:].view(np.int64), rep[last:]]
    if left:
        yield groups(left[0], left[1].view(np.uint64), left[2])


def _blocks(width: int, parts: int, start: int = 0) -> list[tuple[int, int]]:
    """(first bit, number of bits) of so many parts of a stretch of bits."""
    cut = [start + width * i // parts for i in range(parts + 1)]
    return [(x, y - x) for x, y in zip(cut, cut[1:], strict=False)]


def _bits(first: int, n: int):
    return F.shiftrightunsigned(F.col("fp"), first).bitwiseAND(F.lit((1 << n) - 1))


def link_edges(distinct: DataFrame, radius: int = 3, hot_shard: int = 20_000) -> DataFrame:
    """Edges (a, b) that connect the representatives of distinct (fp, rep) within the radius of each other."""
    outer = _blocks(BITS, radius + 1)
    # Another stretch of bits for each outer block: the word turned so that the block's bits are its top.
    rows = distinct.where("rep is not null").select("fp", "rep", F.posexplode(F.array(*[_bits(*x) for x in outer])).alias("block", "value"))
    rows = rows.withColumn("shard", F.xxhash64("block", "value"))
    # A table of its own: it is mostly empty, and then the rows are not shuffled for it.
    hot = written(rows.groupBy("shard").count().where(F.col("count") > hot_shard).select("shard", F.lit(True).alias("hot")), "hot")
    rows = rows.join(hot, "shard", "left")
    inner = []
    for i, (first, n) in enumerate(outer):
        turn = (first + n) % BITS
        turned = F.shiftleft("fp", BITS - turn).bitwiseOR(F.shiftrightunsigned("fp", turn)) if turn else F.col("fp")
        subs = [F.shiftrightunsigned(turned, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in _blocks(BITS - n, radius + 1)]
        inner.append(F.when((F.col("block") == i) & F.col("hot"), F.array(*subs)))
    rows = rows.select("fp", "rep", "shard", F.posexplode_outer(F.coalesce(*inner)).alias("sub", "sub_value"))
    rows = rows.select(F.when(F.col("sub").isNull(), F.col("shard")).otherwise(F.xxhash64("shard", "sub", "sub_value")).alias("shard"), "fp", "rep")
    return rows.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(partial(_stars, radius=radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, hot_shard: int = 20_000) -> DataFrame:
    """doc_id, fp, component_id for each row of docs (doc_id, text).

    component_id is the smallest doc_id reachable over fingerprints at most ``radius`` bits apart.
    Equal fingerprints are one node, so copies are never expanded. Null and empty texts have the
    fingerprint 0 and link like any other; repeated rows give repeated results; a row with a null
    doc_id keeps its row and joins the component of its fingerprint without naming it; an empty
    table gives an empty result; other columns are ignored.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = components(link_edges(distinct, radius, hot_shard))
    # A table of its own: adaptive skew handling splits a fingerprint of many copies only between plain exchanges.
    named = written(distinct.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("root", "rep").alias("component_id")), "named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


#: Long fingerprints: words of 64 bits; bands of at least so many of their bits, drawn at random; the share of pairs at the least similarity that must meet.
LONG_WORDS, BAND_BITS, BAND_RECALL = 16, 20, 0.975
#: Pairs whose estimated similarity is under the one asked for by up to this, or over it, are decided by their shingles.
MARGIN_BELOW = 0.07
#: Two texts of a band go on to the check of their long fingerprints if their first words differ in at most so many bits.
FIRST_WORD_RADIUS = 20
#: Bands of up to so many texts lose those that are near no other by their first words; members of a band that are compared with as many others at once.
SMALL_BAND, BAND_CHUNK = 32, 4096


def long_simhash(words: list[bytes], shingle: int, seed: int = 42) -> np.ndarray:
    """LONG_WORDS fingerprint words, each the majority of another mixing of the distinct shingles' hashes: repeats don't count, as in the similarity of sets."""
    if not words:
        return np.zeros(LONG_WORDS, np.uint64)
    shingles = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    hashes = np.unique(np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(seed)), np.uint64))
    total = np.zeros(LONG_WORDS * BITS, np.int64)
    salts = np.arange(1, LONG_WORDS, dtype=np.uint64) * np.uint64(POLY)
    for at in range(0, len(hashes), 255):  # at most 255 rows, so that sums fit a byte
        part = hashes[at : at + 255]
        each = np.concatenate([part[:, None], mix(part[:, None] + salts)], axis=1)
        total += np.unpackbits(each.astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")


@worker_task("simhash")
def _long_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = [long_simhash(lowered_words(t), shingle).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(found, pa.binary())], ["doc_id", "print"])


def band_places(n: int, similarity: float) -> np.ndarray:
    """Bits of each band, for n texts: wide enough that unrelated texts seldom meet, as many as the recall needs."""
    bits = max(BAND_BITS, n.bit_length() + 2)
    equal = (1 - differing_share(similarity)) ** bits
    rng = np.random.default_rng(23)
    return np.stack([rng.choice(LONG_WORDS * BITS, bits, replace=False) for _ in range(int(np.ceil(np.log(1 - BAND_RECALL) / np.log1p(-equal))))])


def differing_share(similarity: float) -> float:
    """Of the bits of two texts' fingerprints, by the Jaccard similarity of their shingles."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


@worker_task("simhash")
def _band_batches(batches: Iterator[pa.RecordBatch], places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """rep, print to rows (band, rep, fp): one for each band."""
    weights = 1 << np.arange(places.shape[1], dtype=np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            raw = np.frombuffer(b"".join(part.column("print").to_pylist()), np.uint8).reshape(part.num_rows, -1)
            bits = np.unpackbits(raw, axis=1, bitorder="little")
            key = bits[:, places] @ weights + (np.arange(len(places), dtype=np.int64) << places.shape[1])
            first = np.ascontiguousarray(raw[:, :8]).view(np.int64)[:, 0]
            n = len(places)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(part.column("rep").to_numpy(), n)), pa.array(np.repeat(first, n))], ["band", "rep", "fp"])


def _met(band: np.ndarray, fp: np.ndarray, large: int | None) -> np.ndarray:
    """Which rows, sorted by band, have a near one in their band; all of the band `large` and of any with over SMALL_BAND rows."""
    _, inverse, sizes = np.unique(band, return_inverse=True, return_counts=True)
    keep = (sizes[inverse] > SMALL_BAND) | (band == large if large is not None else False)
    for k in range(1, min(SMALL_BAND, len(band))):
        near = band[k:] == band[:-k]
        if not near.any():
            break
        near &= np.bitwise_count(fp[k:] ^ fp[:-k]) <= FIRST_WORD_RADIUS
        keep[k:] |= near
        keep[:-k] |= near
    return keep


@worker_task("simhash")
def _meeting_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band, rep, fp) sorted by band to those (band, rep) that may be near another of their band. A band that goes on over batches passes whole, so memory is bounded."""
    held, large = [np.zeros(0, np.int64)] * 3, None
    out = lambda band, rep, keep: pa.RecordBatch.from_arrays([pa.array(band[keep]), pa.array(rep[keep])], ["band", "rep"])
    for batch in batches:
        band, rep, fp = (np.concatenate([x, batch.column(n).to_numpy()]) for n, x in zip(("band", "rep", "fp"), held, strict=True))
        if not len(band):
            continue
        end = int(np.searchsorted(band, band[-1]))
        if len(band) - end > SMALL_BAND or band[-1] == large:
            yield out(band, rep, _met(band, fp.view(np.uint64), band[-1] if band[-1] == large or len(band) - end > SMALL_BAND else large) | (band == large if large is not None else False))
            large, end = band[-1], len(band)
        elif end:
            yield out(band[:end], rep[:end], _met(band[:end], fp[:end].view(np.uint64), large))
        held = [band[end:], rep[end:], fp[end:]]
    if len(held[0]):
        yield out(held[0], held[1], _met(held[0], held[2].view(np.uint64), large))


def _near_pairs(unit, cross, chunk, rep, root, prints, limit: int, every: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of places (of the larger rep, of the smaller) in rows sorted by unit that differ in at most so many bits, and how many; with `every` those between different roots only. At most 256 rows of a large unit with all of it at once."""
    fits = lambda i, j: (rep[i] != rep[j]) & (~cross[i] | (chunk[i] != chunk[j])) & ((root[i] != root[j]) | (not every))
    far_of = lambda i, j: np.bitwise_count(prints[i] ^ prints[j]).sum(axis=1, dtype=np.int64)
    starts = np.append(0, np.flatnonzero(np.diff(unit)) + 1)
    sizes = np.diff(np.append(starts, len(unit)))
    small = np.repeat(sizes <= SMALL_BAND, sizes)
    found = [[np.zeros(0, np.int64)] * 3]
    for k in range(1, min(SMALL_BAND, len(unit))):
        i = np.flatnonzero(small[k:] & (unit[k:] == unit[:-k]))
        if not len(i):
            break
        i = i[fits(i, i + k)]
        far = far_of(i, i + k)
        found.append([i[far <= limit], i[far <= limit] + k, far[far <= limit]])
    i, j, far = (np.concatenate(x) for x in zip(*found, strict=True))
    yield np.where(rep[i] > rep[j], i, j), np.where(rep[i] > rep[j], j, i), far
    for lo, n in zip(starts[sizes > SMALL_BAND], sizes[sizes > SMALL_BAND], strict=True):
        rows = np.arange(lo, lo + n)
        for at in range(0, n, 256):
            some = rows[at : at + 256]
            far = sum(np.bitwise_count(prints[some, w][:, None] ^ prints[rows, w][None, :]).astype(np.int64) for w in range(LONG_WORDS))
            x, y = np.nonzero((far <= limit) & (rep[some][:, None] > rep[rows][None, :]))
            pick = fits(some[x], rows[y])
            x, y = x[pick], y[pick]
            yield some[x], rows[y], far[x, y]


#: What a row of a unit (a band's chunk, or two of its chunks) carries: nth is the band's number.
_UNIT_ROW = ("unit", "cross", "chunk", "rep", "root", "nth", "print")


def _whole_units(batches: Iterator[pa.RecordBatch], names: tuple[str, ...] = _UNIT_ROW) -> Iterator[tuple[pa.Table, dict, np.ndarray]]:
    """Rows sorted by unit as tables of whole units, their columns and prints; a unit is held whole, two chunks at most."""

    def opened(table: pa.Table):
        prints = np.frombuffer(b"".join(table["print"].to_pylist()), np.uint64).reshape(-1, LONG_WORDS)
        return table, {n: table[n].to_numpy() for n in _UNIT_ROW[:6]}, prints

    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch]).select(names)
        held = pa.concat_tables([held, part]) if held is not None else part
        if not part.num_rows or held["unit"][0] == held["unit"][-1]:
            continue
        unit = held["unit"].to_numpy()
        end = int(np.searchsorted(unit, unit[-1]))
        yield opened(held.slice(0, end))
        held = held.slice(end)
    if held is not None and held.num_rows:
        yield opened(held)


def _pairs_of(columns: dict, prints: np.ndarray, limit: int, every: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return _near_pairs(*(columns[n] for n in _UNIT_ROW[:5]), prints, limit, every)


@worker_task("simhash")
def _nearest_batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Of each row of a unit the pair (a, b) with the nearest smaller rep in it."""
    for _, columns, prints in _whole_units(batches):
        rep = columns["rep"]
        for i, j, far in _pairs_of(columns, prints, limit, False):
            order = np.lexsort((rep[j], far, i))
            first = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
            found = np.unique(np.stack([rep[i[first]], rep[j[first]]], axis=1), axis=0)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _owned(i: np.ndarray, j: np.ndarray, nth: np.ndarray, prints: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which pairs are decided here, in the first band that both are in. Those with far first words may have left a small band, so any band decides them."""
    mine = np.bitwise_count(prints[i, 0] ^ prints[j, 0]) > FIRST_WORD_RADIUS
    for at in range(0, len(i), 2048):
        some = slice(at, at + 2048)
        differ = np.unpackbits((prints[i[some]] ^ prints[j[some]]).astype("<u8").view(np.uint8), axis=1, bitorder="little")
        mine[some] |= (~differ[:, places].any(axis=2)).argmax(axis=1) == nth[i[some]]
    return mine


@worker_task("simhash")
def _open_batches(batches: Iterator[pa.RecordBatch], limit: int, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of each unit that are near a row of another root; never their pairs."""
    for table, columns, prints in _whole_units(batches):
        need = np.zeros(len(prints), bool)
        for i, j, _ in _pairs_of(columns, prints, limit, True):
            mine = _owned(i, j, columns["nth"], prints, places)
            need[i[mine]] = need[j[mine]] = True
        yield from table.drop_columns("print").filter(pa.array(need)).to_batches()


def _top(parent: dict, x: int) -> int:
    while (up := parent.get(x, x)) != x:
        parent[x] = x = parent.get(up, up)
    return x


@worker_task("simhash")
def _link_batches(batches: Iterator[pa.RecordBatch], limit: int, places: np.ndarray, similarity: float) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of each unit by the texts' shingles, fewer than it has rows: what is linked already is not compared again."""
    for table, columns, prints in _whole_units(batches, (*_UNIT_ROW, "shingles")):
        sets = [np.frombuffer(x, np.uint32) for x in table["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        rep, root, parent, links = columns["rep"], columns["root"], {}, []
        for i, j, _ in _pairs_of(columns, prints, limit, True):
            mine = _owned(i, j, columns["nth"], prints, places)
            i, j = i[mine], j[mine]
            order = np.lexsort((j, i))
            i, j = i[order], j[order]
            cuts = [*np.flatnonzero(np.diff(i, prepend=-1)), len(i)]
            for lo, hi in pairwise(cuts):
                x, own = sets[i[lo]], _top(parent, root[i[lo]])
                others = np.array([k for k in j[lo:hi] if _top(parent, root[k]) != own], np.int64)
                for at in range(0, len(others), 256):
                    part = others[at : at + 256]
                    flat = np.concatenate([sets[k] for k in part])
                    same = x[np.minimum(np.searchsorted(x, flat), len(x) - 1)] == flat
                    both = np.add.reduceat(same, np.append(0, np.cumsum(sizes[part])[:-1]), dtype=np.int64)
                    for k in part[both >= similarity * (len(x) + sizes[part] - both)]:
                        if (p := _top(parent, root[k])) != (q := _top(parent, root[i[lo]])):
                            parent[max(p, q)] = min(p, q)
                            links.append((rep[i[lo]], rep[k]))
        if links:
            a, b = np.array(links, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


@worker_task("simhash")
def _shingle_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """doc_id, shingles: the sorted distinct 32-bit hashes of a text's shingles."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = []
            for text in part.column("text").to_pylist():
                words = lowered_words(text)
                grams = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
                found.append(np.unique(np.fromiter(map(xxhash.xxh32_intdigest, map(b" ".join, grams)), np.uint32)).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "shingles"])


def _jaccard_batches(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both >= similarity * (len(x) + len(y) - both))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _shingle_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """doc_id, shingles of the documents wanted (doc_id, distinct)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(written(wanted, "wanted"), "doc_id")
    return written(texts.mapInArrow(partial(_shingle_batches, shingle=shingle), "doc_id long, shingles binary").dropDuplicates(["doc_id"]), "shingles")


def _decided(docs: DataFrame, unsure: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts have at least the similarity, by their shingles."""
    sets = _shingle_sets(docs, unsure.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), shingle)
    of = lambda n: sets.select(F.col("doc_id").alias(n), F.col("shingles").alias(f"of_{n}"))
    return unsure.join(of("a"), "a").join(of("b"), "b").mapInArrow(partial(_jaccard_batches, similarity=similarity), "a long, b long")


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, component_id for each row of docs (doc_id, text): groups of texts alike in so much of their shingles.

    For texts whose Jaccard similarity of shingles is only ``similarity``, fingerprints of 64 bits
    differ in some ten bits, far beyond the radius of a tree that still prunes. So fingerprints here
    have 1024 bits. Texts meet where a band of their bits, drawn at random, is equal (BAND_RECALL of
    pairs at the similarity meet in some band, and nearly all of those above it). The share of
    differing bits shows the similarity with a standard deviation of 0.03; pairs not clearly under
    it are decided by their shingles: first of each text the nearest that it meets in a band, then
    all pairs that meet and are not in one group yet. The latter are not rows: texts that still have
    such a partner go back to their band with their shingles, and the band's task decides there,
    each pair in the first band it meets in, and gives the links that join groups. So rows grow with
    the texts, not with the pairs. Large bands are compared by chunks. Nulls, copies and repeated rows are as in
    near_duplicates, except that texts without a word link with nothing.
    """
    prints = written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_long_batches, shingle=shingle), "doc_id long, print binary"), "prints")
    nothing = F.lit(bytes(LONG_WORDS * 8))
    distinct = written(prints.where((F.col("print") != nothing) & F.col("doc_id").isNotNull()).groupBy("print").agg(F.min("doc_id").alias("rep")), "distinct")
    places = band_places(distinct.count(), similarity)
    bands = distinct.mapInArrow(partial(_band_batches, places=places), "band long, rep long, fp long")
    meets = written(bands.repartition("band").sortWithinPartitions("band").mapInArrow(_meeting_batches, "band long, rep long"), "meets")
    chunks = meets.groupBy("band").count().where("count > 1").select("band", F.ceil(F.col("count") / BAND_CHUNK).cast("int").alias("chunks"))
    # What joins back is a table of its own: adaptive skew handling splits a hot key only between plain exchanges.
    members = meets.join(written(chunks, "chunks"), "band").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    members = members.select("band", "rep", "chunk", F.explode(F.expr("sequence(0, chunks - 1)")).alias("other"))
    nth = F.shiftrightunsigned("band", places.shape[1]).cast("int").alias("nth")
    members = members.select("rep", "chunk", nth, (F.col("chunk") != F.col("other")).alias("cross"), F.xxhash64("band", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("unit"))
    # A chunk with itself has one row of each member, two chunks one of each member of both.
    members = written(members, "members")
    limit = int(differing_share(similarity - MARGIN_BELOW) * LONG_WORDS * BITS)
    by_unit = lambda rows: rows.repartition("unit").sortWithinPartitions("unit")

    known = distinct.select("rep", "print", F.col("rep").alias("root"))
    pairs = by_unit(members.join(known, "rep")).mapInArrow(partial(_nearest_batches, limit=limit), "a long, b long").distinct()
    roots = components(written(_decided(docs, written(pairs, "pairs"), shingle, similarity), "decided"))

    known = distinct.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "print", F.coalesce("root", "rep").alias("root"))
    known = written(known, "known")
    schema = "unit long, cross boolean, chunk int, rep long, root long, nth int"
    unsure = written(by_unit(members.join(known, "rep")).mapInArrow(partial(_open_batches, limit=limit, places=places), schema), "unsure")
    sets = _shingle_sets(docs, unsure.select(F.col("rep").alias("doc_id")).distinct(), shingle).withColumnRenamed("doc_id", "rep")
    whole = by_unit(unsure.join(known.select("rep", "print"), "rep").join(sets, "rep"))
    links = whole.mapInArrow(partial(_link_batches, limit=limit, places=places, similarity=similarity), "a long, b long")
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))
    named = written(distinct.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("print", F.coalesce("root", "rep").alias("component_id")), "named")
    return prints.join(named, "print", "left").select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id over the whole documents table."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
