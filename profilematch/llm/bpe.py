"""BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over 16 bytes cuts texts into chunks of about 1 KB, wherever in a word the cut falls, so that a passage
shared by many documents falls into the same chunks in all of them. Chunks in two documents or more are counted over
the corpus, encoded once in a job of their own, and sent to all tasks; there are at most MAX_SHARED of them (the most
frequent), MAX_CHUNK bytes each. Other chunks, and the words of shared ones, are encoded where they lie; each worker
keeps the words it has encoded (MAX_WORDS, MAX_RUNS), so a frequent word is encoded once.

A chunk is a head (up to its first white space), whole words, and a tail (after its last). White space ends every
token of this vocabulary's pre-tokenizer, so whole words encode alike anywhere. At a join, tail and head are put
together and encoded again in a window with a word on either side. The window has to agree, token by token, with what
stands there; where it doesn't, it grows to the whole text. Results equal the tokenizer's own on the whole text.

Null texts are empty and give no tokens. Rows are encoded each by itself: repeated rows, null ids and extra columns
change nothing; columns named like new ones are replaced. Very long words and texts are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.llm import hashing as H
from profilematch.llm.common import int_lists, slices, stored, text_bytes

U = np.uint64
ROLL = 16
AVERAGE = 1024
MAX_CHUNK = 4096
MAX_SHARED = 8192
MAX_WORDS = 200_000
MAX_RUNS = 250_000
BATCH_WORDS = 2000
#: Bytes of text that are cut and encoded at a time: what a worker holds beside its tables is many times that.
SLICE_BYTES = 512 << 10


#: ASCII without the apostrophe, and the letters of Latin-1: lower case maps them one to one, and none composes.
PLAIN = re.compile("[!-&(-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
RUNS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Kept:
    """A bounded table in two generations: when the young one is full it becomes the old one, and what is met again
    moves back, so that the frequent stays."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> set:
        """The keys that have to be added; all others are in ``young`` afterwards."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        need = {k for k in keys if k not in self.young}
        back = [k for k in need if k in self.old]
        for k in back:
            self.young[k] = self.old[k]
        return need.difference(back)


class Words:
    """Encoded words of this worker, and the runs (of letters, of other characters) that words are made of.

    The vocabulary's pre-tokenizer cuts a word into runs after lower-casing, each of which is encoded by itself. A
    word of the characters in PLAIN is cut here in the same way, so that "Word", "word," and "word" share a run; any
    other word (apostrophes, special tokens, other scripts, marks to compose) goes to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.words, self.runs = Kept(MAX_WORDS), Kept(MAX_RUNS)

    @property
    def ids(self) -> dict[bytes, bytes]:
        return self.words.young

    def learn(self, words: set[bytes]) -> None:
        """``ids`` has all of ``words`` afterwards."""
        cut = {}
        for w in self.words.missing(words):
            text = w.decode()
            cut[w] = RUNS.findall(text.lower()) if PLAIN.fullmatch(text) and "<|" not in text else [text]
        new = list(self.runs.missing({x for own in cut.values() for x in own}))
        runs = self.runs.young
        for at in range(0, len(new), BATCH_WORDS):
            part = new[at : at + BATCH_WORDS]
            for run, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                runs[run] = array("i", e.ids).tobytes()
        for w, own in cut.items():
            self.ids[w] = b"".join([runs[x] for x in own])

    def whole(self, text: bytes) -> bytes:
        return array("i", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def decode(self, ids: bytes) -> str:
        """The names of the tokens, one space apart: what the tokenizer's decode gives, as it has no decoder."""
        return " ".join(map(self.names.__getitem__, array("i", ids)))


_workers: dict[str, Words] = {}


def words_of(path: str) -> Words:
    if path not in _workers:
        _workers[path] = Words(path)
    return _workers[path]


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each text, and after each 16 bytes whose hash says so; never inside a character."""
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    if len(data) >= ROLL:
        roll = np.flatnonzero((H.window_hashes(H.BYTE_VALUES[data], ROLL) & U(AVERAGE - 1)) == 0) + ROLL
        roll = roll[roll < len(data)]
        begins[roll[(data[roll] & 0xC0) != 0x80]] = True
    return np.flatnonzero(begins[:-1])


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about SLICE_BYTES of text."""
    return slices(batch, "text", SLICE_BYTES)


def _chunk_hashes(column: pa.Array):
    data, offsets = text_bytes(column)
    starts = cuts(data, offsets)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    return data, offsets, starts, ends, H.span_hashes(data, starts, ends, H.BASES[0], H.BYTE_VALUES)


def shared_chunks(docs: DataFrame) -> DataFrame:
    """(h, chunk): chunks in several places of the corpus; of these the most frequent, MAX_SHARED at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                _, _, starts, ends, h = _chunk_hashes(part.column("text"))
                h, n = np.unique(h[(ends - starts) <= MAX_CHUNK].astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])

    counted = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counted = stored(counted.where("n > 1").withColumn("size", F.length(F.bin("n"))), "chunks")
    above, least = 0, 65
    for r in counted.groupBy("size").count().orderBy(F.desc("size")).collect():  # 64 sizes at most
        above += r["count"]
        if above > MAX_SHARED:
            break
        least = r["size"]
    wanted = np.sort(np.array([r.h for r in counted.where(F.col("size") >= least).select("h").collect()], np.int64))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                data, _, starts, ends, h = _chunk_hashes(part.column("text"))
                h = h.astype(np.int64)
                _, first = np.unique(h, return_index=True)
                first = first[np.isin(h[first], wanted) & ((ends - starts)[first] <= MAX_CHUNK)]
                chunks = pa.array([data[starts[i] : ends[i]].tobytes() for i in first], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(h[first]), chunks], ["h", "chunk"])

    if not len(wanted):
        return docs.sparkSession.createDataFrame([], "h long, chunk binary")
    return docs.select("text").mapInArrow(pick, "h long, chunk binary").groupBy("h").agg(F.min("chunk").alias("chunk"))


def _split(chunk: bytes) -> tuple[bytes, list[bytes], bytes] | None:
    """Head, whole words, tail; None for a chunk without white space."""
    words = chunk.split()
    if not words:
        return (b"", [], b"") if chunk else None
    head = b"" if H.WHITE[chunk[0]] else words.pop(0)
    if len(head) == len(chunk):
        return None
    tail = b"" if H.WHITE[chunk[-1]] or not words else words.pop()
    return head, words, tail


def _encode_chunks(path: str):
    """The whole words of each chunk, encoded, and the first and last of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = words_of(path)
            ids, firsts, lasts = [], [], []
            splits = [_split(chunk) for chunk in batch.column("chunk").to_pylist()]
            words = [split[1] if split else [] for split in splits]
            known.learn(set().union(*words))
            for own in words:
                ids.append(b"".join([known.ids[w] for w in own]))
                firsts.append(own[0] if own else b"")
                lasts.append(own[-1] if own else b"")
            new = [pa.array(x, pa.binary()) for x in (ids, firsts, lasts)]
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), *new], ["chunk", "ids", "first", "last"])

    return run


#: A part of a text: its words or the ids of a shared chunk, and its first and last word.
Part = tuple[list[bytes] | bytes, bytes, bytes]


def _parts(chunks: list[bytes], shared: dict[bytes, tuple[bytes, bytes, bytes]]) -> tuple[list[Part], list[int]]:
    """The parts of a text, and which of them are single words that a chunk's border cuts."""
    parts: list[Part] = []
    joins: list[int] = []
    carry = b""
    for chunk in chunks:
        split = _split(chunk)
        if split is None:
            carry += chunk
            continue
        head, words, tail = split
        word = carry + head
        if word:
            if carry and head:
                joins.append(len(parts))
            parts.append(([word], word, word))
        if chunk in shared:
            parts.append(shared[chunk])
        elif words:
            parts.append((words, words[0], words[-1]))
        carry = tail
    if carry:
        parts.append(([carry], carry, carry))
    return parts, joins


def _agree(known: Words, parts: list[Part], joins: list[int]) -> bool:
    """Whether each word at a join, encoded again with a word on either side, gives what stands in the parts."""
    for k in joins:
        left = parts[k - 1][2] if k else b""
        right = parts[k + 1][1] if k + 1 < len(parts) else b""
        window = [w for w in (left, parts[k][1], right) if w]
        if known.whole(b" ".join(window)) != b"".join([known.ids[w] for w in window]):
            return False
    return True


_OUT = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (token ids of the text) and ``decoded`` (the text that these ids decode to)."""
    docs = docs.drop(*[f.name for f in _OUT])
    columns = docs.columns
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = shared_chunks(docs).repartition(parts).mapInArrow(_encode_chunks(path), "chunk binary, ids binary, first binary, last binary")
    table = {bytes(r[0]): tuple(map(bytes, r[1:])) for r in encoded.collect()}  # MAX_SHARED chunks of MAX_CHUNK bytes
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                known, shared = words_of(path), sent.value
                data, offsets = text_bytes(part.column("text"))
                starts = cuts(data, offsets)
                raw, bounds = data.tobytes(), np.append(starts, len(data))
                places = np.searchsorted(starts, offsets)
                texts, words = [], set()
                for i in range(part.num_rows):
                    edges = bounds[places[i] : places[i + 1] + 1].tolist()
                    found = _parts([raw[a:b] for a, b in zip(edges, edges[1:])], shared)
                    texts.append(found)
                    for own, first, last in found[0]:
                        words.update(own if isinstance(own, list) else filter(None, (first, last)))
                known.learn(words)
                get = known.ids.__getitem__
                ids, decoded = [], []
                for i, (parts, joins) in enumerate(texts):
                    if _agree(known, parts, joins):
                        own = b"".join([b"".join(map(get, x)) if isinstance(x, list) else x for x, _, _ in parts])
                    else:  # the window grows to the whole text
                        own = known.whole(raw[offsets[i] : offsets[i + 1]])
                    ids.append(own)
                    decoded.append(known.decode(own))
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, int_lists(counts, values), pa.array(decoded, pa.string())], [*columns, "ids", "decoded"]
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *_OUT]))
