"""BPE encoding and decoding over a table of distinct words.

Texts are split into words as the tokenizer's normalizer and pre-tokenizer do. The corpus's frequent
words form a distinct-word table: each is encoded once, its pieces come from a join of its ids with
the id-to-piece table of the vocabulary, and the table (at most ``table_words`` rows, so its size is
bounded) is broadcast to where texts are; ids and pieces are joined back by position. Words beyond
it are encoded once in each task that meets them and pieced through the same id-to-piece table. A
shuffled join of every occurrence would move several times the input; see the README.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import CACHES, read, worker_task

#: Rows of the broadcast table and the least count in one task that a word is reported with.
TABLE_WORDS, REPORT_FROM = 100_000, 4
#: Words that a task remembers beyond the table, and words that it counts, before it starts anew.
MEMO_WORDS, COUNT_WORDS = 200_000, 400_000
#: Characters that the fast path knows: NFC leaves them alone and lower case is one to one and the same everywhere.
_ODD = re.compile("[^\x00-įı-ž]")
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte in byte-level vocabularies: its own where it has one, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in own]
    return {x: chr(x) for x in own} | {x: chr(256 + i) for i, x in enumerate(rest)}


class Splitter:
    """Texts to words: plain lower-case strings, and None with an id for a special token."""

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.special = {x["content"]: x["id"] for x in json.loads(spec)["added_tokens"]}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = byte_letters()
        self.bytes = {ord(v): k for k, v in self.letters.items()}

    def words(self, text: str) -> list[str]:
        if not _ODD.search(text):
            return _WORDS.findall(text.lower())
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return [bytes(self.bytes[ord(c)] for c in w).decode("utf-8", "replace") for w, _ in split]

    def segments(self, text: str | None) -> list[str]:
        """Stretches of text with special tokens at the odd places."""
        text = (text or "").encode("utf-8", "replace").decode()
        return self.parts.split(text) if self.parts and any(x in text for x in self.special) else [text]

    def ids(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, word.encode())))]


@lru_cache(maxsize=4)
def _splitter(spec: str) -> Splitter:
    return Splitter(spec)


def vocabulary(spark: SparkSession, spec: str) -> DataFrame:
    """id, piece: the whole vocabulary with the added tokens; its size is the vocabulary's."""
    found = json.loads(spec)
    rows = {i: p for p, i in found["model"]["vocab"].items()} | {x["id"]: x["content"] for x in found["added_tokens"]}
    return spark.createDataFrame(sorted(rows.items()), "id int, piece string")


@worker_task("bpe")
def _count_batches(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    split, counts = _splitter(spec), Counter()
    emit = lambda c: pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["word", "n"])
    for batch in batches:
        for text in batch.column("text").to_pylist():
            for i, part in enumerate(split.segments(text)):
                if i % 2 == 0:
                    counts.update(split.words(part))
            if len(counts) > COUNT_WORDS:
                yield emit({w: n for w, n in counts.items() if n >= REPORT_FROM})
                counts = Counter()
    yield emit({w: n for w, n in counts.items() if n >= REPORT_FROM})


@worker_task("bpe")
def _encode_batches(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    split = _splitter(spec)
    for batch in batches:
        ids = [split.ids(w) for w in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])


def word_table(docs: DataFrame, spec: str, table_words: int = TABLE_WORDS) -> DataFrame:
    """word, n, ids, pieces: the most frequent distinct words of all texts, each encoded once, decoded by a join with the vocabulary."""
    counted = docs.select("text").mapInArrow(partial(_count_batches, spec=spec), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(table_words)
    encoded = top.select("word").mapInArrow(partial(_encode_batches, spec=spec), "word string, ids array<int>")
    placed = encoded.select("word", "ids", F.posexplode("ids").alias("at", "id"))
    pieced = placed.join(F.broadcast(vocabulary(docs.sparkSession, spec)), "id")
    return pieced.groupBy("word", "ids").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("p")).select("word", "ids", F.transform("p", lambda x: x["piece"]).alias("pieces"))


class _Codec:
    """Word to (number of ids, ids as text, pieces as text): the broadcast table and a bounded memory for other words."""

    def __init__(self, spec: str, table: dict) -> None:
        self.split, self.table, self.memo = _splitter(spec), table, {}
        vocab = json.loads(spec)
        self.piece = {i: p for p, i in vocab["model"]["vocab"].items()} | {x["id"]: x["content"] for x in vocab["added_tokens"]}

    def entry(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), " ".join(map(self.piece.__getitem__, ids))

    def entries(self, text: str | None) -> list[tuple[int, str, str]]:
        out = []
        for i, part in enumerate(self.split.segments(text)):
            if i % 2:
                out.append(self.entry([self.split.special[part]]))
                continue
            words = self.split.words(part)
            if len(self.memo) > MEMO_WORDS:
                self.memo = {}
            table, memo = self.table, self.memo
            for w in set(words):
                if w not in table and w not in memo:
                    memo[w] = self.entry(self.split.ids(w))
            out += [table.get(w) or memo[w] for w in words]
        return [x for x in out if x[0]]


_CODECS: dict = {}
CACHES["bpe"] = _CODECS


def _codec(spec: str, table) -> _Codec:
    key = (hash(spec), id(table))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = table, _Codec(spec, table.value)
    return _CODECS[key][1]


#: What can be asked for, with its type: ids and their text's digest, the decoded text and its digest.
OUTPUTS = {"ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


@worker_task("bpe")
def _code_batches(batches: Iterator[pa.RecordBatch], spec: str, table, outputs: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    codec = _codec(spec, table)
    make = {"ids": lambda i, p: list(map(int, i.split())), "decoded": lambda i, p: p, "ids_sha256": lambda i, p: hashlib.sha256(i.encode()).hexdigest(), "decoded_sha256": lambda i, p: hashlib.sha256(p.encode()).hexdigest()}
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            n, made = [], {x: [] for x in outputs}
            for text in part.column("text").to_pylist():
                found = codec.entries(text)
                ids, pieces = " ".join([x[1] for x in found]), " ".join([x[2] for x in found])
                n.append(sum([x[0] for x in found]))
                for x, v in made.items():
                    v.append(make[x](ids, pieces))
            out = {x: part.column(x) for x in part.schema.names if x != "text"} | {"n_tokens": pa.array(n, pa.int64())}
            out |= {x: pa.array(v, pa.list_(pa.int32()) if x == "ids" else pa.string()) for x, v in made.items()}
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def _default_spec() -> str:
    import public_tokenizers

    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


def encode_decode(docs: DataFrame, spec: str | None = None, outputs: tuple[str, ...] = ("ids", "decoded"), table_words: int = TABLE_WORDS) -> DataFrame:
    """docs without text, with n_tokens and the OUTPUTS asked for, for each of its rows.

    spec is the tokenizer's JSON, by default that of the public word-level BPE. Null texts count as
    empty and have no tokens; strings of special tokens in a text become those tokens; repeated rows
    give repeated results; columns of docs named like a result give way, others pass through; an
    empty table gives an empty result.
    """
    spec = spec or _default_spec()
    docs = docs.drop("n_tokens", *OUTPUTS).withColumn("text", F.col("text").cast("string"))
    table = {}
    for batch in word_table(docs, spec, table_words).toArrow().to_batches(max_chunksize=2000):
        words, ids, pieces = (batch.column(n).to_pylist() for n in ("word", "ids", "pieces"))
        table |= {w: (len(i), " ".join(map(str, i)), " ".join(p)) for w, i, p in zip(words, ids, pieces, strict=True)}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"] + ["n_tokens long", *(f"{x} {OUTPUTS[x]}" for x in outputs)])
    return docs.mapInArrow(partial(_code_batches, spec=spec, table=docs.sparkSession.sparkContext.broadcast(table), outputs=outputs), schema)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 over the whole documents table."""
    return encode_decode(read(spark, sf_dir, "documents").select("doc_id", "text"), outputs=("ids_sha256", "decoded_sha256"))
