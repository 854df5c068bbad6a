"""Encoding of a corpus with a public byte-pair tokenizer, by a pair occurrence index."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabulary files lie; a parameter of every function below.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: how byte-level BPE of this vocabulary cuts text into words before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same cut for texts of ASCII alone, whose letters, numbers and spaces are few enough to be named.
ASCII_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: Words whose ids a worker remembers between batches; beyond it the memory starts anew. It bounds memory, not results.
REMEMBERED = 400_000


class Merges(NamedTuple):
    """``start``: id of each byte; ``rank``: (left id, right id) to (rank, merged id)."""

    start: list[int]
    rank: dict[tuple[int, int], tuple[int, int]]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself if printable Latin-1, else the next from U+0100."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_merges(raw: bytes) -> Merges:
    """Merges of a ``tokenizers`` JSON file with a byte-level BPE model."""
    model = json.loads(raw)["model"]
    ids = model["vocab"]
    rank = {}
    for r, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        rank[ids[a], ids[b]] = (r, ids[a + b])
    return Merges([ids[c] for c in byte_letters()], rank)


def encode_words(words: list[bytes], merges: Merges) -> list[list[int]]:
    """Ids of each word by one occurrence index over all of them.

    All words lie in one linked list of symbols. ``where`` maps each pair with a rank to the positions at which it was seen;
    a heap holds the ranks of these pairs. The lowest active rank is applied at all its positions in ascending order, each
    position still holding the pair is merged, and the lists of the two neighbouring pairs that arise are extended. A pair
    that arises from rank r has a higher rank, so ascending order over all words gives each word the same
    merges in the same order as merging it alone. Work is proportional to the merges applied, also for very long words.
    """
    rank = merges.rank
    symbol: list[int] = []
    after: list[int] = []
    before: list[int] = []
    heads: list[int] = []
    where: dict[tuple[int, int], list[int]] = {}
    for word in words:
        base, n = len(symbol), len(word)
        heads.append(base)
        symbol.extend(merges.start[b] for b in word)
        after.extend(range(base + 1, base + n))
        before.extend(range(base - 1, base + n - 1))
        if n:
            after.append(-1)
            before[base] = -1
        for i in range(base, base + n - 1):
            pair = (symbol[i], symbol[i + 1])
            if pair in where:
                where[pair].append(i)
            elif pair in rank:
                where[pair] = [i]
    heap = [(rank[p][0], p) for p in where]
    heapq.heapify(heap)
    while heap:
        _, pair = heapq.heappop(heap)
        places = where.pop(pair)
        places.sort()
        left, right = pair
        new = rank[pair][1]
        for i in places:
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue
            k = after[j]
            symbol[i], symbol[j], after[i] = new, -1, k
            h = before[i]
            if k >= 0:
                before[k] = i
                fresh = (new, symbol[k])
                if fresh in where:
                    where[fresh].append(i)
                elif fresh in rank:
                    where[fresh] = [i]
                    heapq.heappush(heap, (rank[fresh][0], fresh))
            if h >= 0:
                fresh = (symbol[h], new)
                if fresh in where:
                    where[fresh].append(h)
                elif fresh in rank:
                    where[fresh] = [h]
                    heapq.heappush(heap, (rank[fresh][0], fresh))
    out = []
    for head, word in zip(heads, words, strict=True):
        ids, i = [], head if word else -1
        while i >= 0:
            ids.append(symbol[i])
            i = after[i]
        out.append(ids)
    return out


class Encoder:
    """Texts to ids. Keeps the ids of words seen, so that the index only runs over words new to this worker."""

    def __init__(self, raw: bytes):
        import regex

        self.merges, self.cut, self.cut_ascii, self.known = read_merges(raw), regex.compile(PATTERN).findall, re.compile(ASCII_PATTERN, re.ASCII).findall, {}

    def words(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text, whose ids are then all in ``known``."""
        cut = [(self.cut_ascii(t) if t.isascii() else self.cut(t)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        new = list({w for ws in cut for w in ws if w not in known})
        known.update(zip(new, encode_words([w.encode("utf-8", "replace") for w in new], self.merges), strict=True))
        return cut

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty texts give no ids, blank text is text like any other."""
        return [list(chain.from_iterable(map(self.known.__getitem__, ws))) for ws in self.words(texts)]

    def count(self, texts: list[str | None]) -> list[int]:
        """How many ids each text has."""
        return [sum(map(len, map(self.known.__getitem__, ws))) for ws in self.words(texts)]


class Decoder:
    """Ids back to texts: the bytes of each id's letters."""

    def __init__(self, raw: bytes):
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.bytes = {i: bytes(byte[c] for c in letters) for letters, i in json.loads(raw)["model"]["vocab"].items() if all(c in byte for c in letters)}

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(raw: bytes, digest: str) -> Encoder:
    """This worker's encoder of the vocabulary, read once."""
    if digest not in _ENCODERS:
        _ENCODERS[digest] = Encoder(raw)
    return _ENCODERS[digest]


def _parts(texts: list[str | None], most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` characters, so that one batch of long texts is encoded piece by piece."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def vocabulary(spark, folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    """The vocabulary file as a broadcast; its size is the file's, whatever the corpus."""
    with open(os.path.join(folder, f"{name}.json"), "rb") as f:
        raw = f.read()
    return spark.sparkContext.broadcast(raw), hashlib.sha256(raw).hexdigest()


def encode(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """``key`` and ``ids`` (array<int>) of every row, without special tokens, whose spelling in a text is ordinary text.

    Null and empty texts give an empty list; blank text is text. Null and repeated keys are kept as they are. One
    narrow pass without shuffle; memory holds one Arrow batch and the remembered words.
    """
    raw, digest = vocabulary(df.sparkSession, folder, name)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(raw.value, digest)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _parts(texts):
                rows = own.encode(texts[a:b])
                offsets = [0]
                for r in rows:
                    offsets.append(offsets[-1] + len(r))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(list(chain.from_iterable(rows)), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], [key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """``key`` and ``n_tokens`` of every row; 0 for null and empty texts."""
    raw, digest = vocabulary(df.sparkSession, folder, name)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(raw.value, digest)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [x for a, b in _parts(texts) for x in own.count(texts[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], [key, "n_tokens"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint")


def round_trip(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """``key``, ``n_tokens`` and ``same``, whether the ids of a row decode to its very text; null for null texts."""
    raw, _ = vocabulary(df.sparkSession, folder, name)
    ids = encode(df.select(F.struct(F.col(key).alias("k"), F.col(text).alias("t")).alias("row"), F.col(text).alias("text")), "row", "text", folder, name).select("row.*", "ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Decoder(raw.value)
        for batch in batches:
            rows = batch.column(2).to_pylist()
            same = [None if t is None else own.decode(i) == t for t, i in zip(batch.column(1).to_pylist(), rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(i) for i in rows], pa.int64()), pa.array(same, pa.bool_())], [key, "n_tokens", "same"])

    kind = df.schema[key].dataType.simpleString()
    return ids.mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, same boolean")
