"""Token ids as Arrow stream files of equal-length sequences and masks.

A file holds two Arrow streams. The first has batches of fixed-size lists: ``ids`` (unsigned
integers, 16 bits where the vocabulary fits) and ``mask`` (true for tokens, false for the
padding after the last one). All batches but the last have the same number of sequences, so any
sequence is found by arithmetic and read in place, without copying. The second stream
lists the file's documents in order (doc_id, n_tokens). Documents run on from
sequence to sequence; the schema's metadata carry the file's number in the order of ids.
"""

from __future__ import annotations

import io
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .binary_files import read_files, write_files
from .common import bound_batches, written

#: Text bytes that go into one file, on average; a file is built and read in a worker's memory.
FILE_BYTES = 8 << 20
SEQUENCE, BATCH = 1024, 256
#: Words whose ids a worker remembers before it starts a new generation; it looks up one generation back.
CACHE = 200_000
#: Texts encoded at once.
TEXTS = 512
#: Stands between words that are encoded in one call.
_MARK = b"\x01"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")
#: ASCII punctuation; an apostrophe may begin a piece of its own with letters behind it.
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'")


class Encoder:
    """Token ids of whole texts as little-endian bytes.

    ``split_words`` encodes each word (run without ASCII white space) once and remembers it. That
    gives the ids of the whole text for tokenizers that lower-case, drop white space and part letters from
    punctuation, so that no piece spans two words or a word and the punctuation behind it; ``plain`` does less
    for words that the normalizer leaves alone. Tests compare with whole texts; other tokenizers need the default.
    """

    def __init__(self, tokenizer_json: str, split_words: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.split_words = split_words
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        mark = self._ids(self.tokenizer, _MARK.decode())
        self.mark = int(mark[0]) if len(mark) == 1 else None
        # the same model on words that are one piece already, spelled in the byte alphabet that the library tells
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        sample = "".join(map(chr, [*range(0x800), *range(0x800, 0xD800, 0x40), *range(0xE000, 0x110000, 0x1000)]))
        letters = "".join(p for p, _ in pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(sample))
        suffix = json.loads(tokenizer_json)["model"].get("end_of_word_suffix") or "\0"
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.alphabet = dict(zip(sample.encode(), letters, strict=True)) | {ord(" "): " "}

    def _ids(self, tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _cut(self, ids: np.ndarray, first: list[int], last: list[int]) -> list[bytes]:
        data, size = ids.tobytes(), self.dtype.itemsize
        return [data[a * size:b * size] for a, b in zip(first, last, strict=True)]

    def _plain_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are one piece each: a piece ends where a token ends a word."""
        if not words:
            return []
        ids = self._ids(self.plain, b" ".join(words).decode("latin-1").translate(self.alphabet))
        ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
        if len(ends) != len(words):  # no word ends in the vocabulary
            return self._marked_ids(words)
        return self._cut(ids, [0, *ends[:-1]], ends)

    def _marked_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of any words from one call for all, parted by the ids of the mark."""
        if not words:
            return []
        if self.mark is None or any(_MARK in w for w in words):
            return [self._ids(self.tokenizer, w.decode("utf-8", "replace")).tobytes() for w in words]
        ids = self._ids(self.tokenizer, b" \x01 ".join(words).decode("utf-8", "replace"))
        at = np.flatnonzero(ids == self.mark)
        return self._cut(ids, [0, *(at + 1).tolist()], [*at.tolist(), len(ids)])

    def _learn(self, words: set[bytes]) -> None:
        young, old = self.young, self.old
        plain, rest, joined = [], [], []
        for w in words:
            known = old.get(w)
            if known is not None:
                young[w] = known
            elif w.isalpha():
                (plain if w.islower() else rest).append(w)
            else:
                base = w.rstrip(_PUNCTUATION)
                if len(base) == len(w) or not base or base[-1] not in _LETTERS or b"<|" in w:
                    rest.append(w)
                else:
                    joined.append((w, base, w[len(base):]))
        pieces = {p for _, base, tail in joined for p in (base, tail)}.difference(words)
        for p in pieces:
            if p not in young and p not in old:
                (plain if p.isalpha() and p.islower() else rest).append(p)
        odd = []
        for w in rest:
            u = w.decode("utf-8", "replace")
            (plain if u.isalpha() and u == u.lower() and unicodedata.is_normalized("NFC", u) else odd).append(w)
        young.update(zip(plain, self._plain_ids(plain), strict=True))
        young.update(zip(odd, self._marked_ids(odd), strict=True))
        for w, base, tail in joined:
            young[w] = (young.get(base) or old[base]) + (young.get(tail) or old[tail])

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts word by word, and each text's number of ids."""
        # lower-casing might turn other strings into special tokens, which have no upper case
        low = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(low)
        words = split.flatten().dictionary_encode()
        known = _pybytes(words.dictionary)
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young
        pieces = list(map(self.young.get, known))
        missing = [i for i, p in enumerate(pieces) if p is None]
        if missing:
            self._learn({known[i] for i in missing})
            for i in missing:
                pieces[i] = self.young[known[i]]
        ids = np.frombuffer(b"".join(pieces), self.dtype)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.dtype.itemsize
        which = words.indices.to_numpy()
        count = size[which]
        ahead = np.concatenate(([0], np.cumsum(count)))
        at = np.repeat(((np.cumsum(size) - size)[which] - ahead[:-1]).astype(np.int32), count)
        at += np.arange(ahead[-1], dtype=np.int32)
        bounds = ahead[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return ids[at], np.diff(bounds)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8 bytes, null for none) in order, and each text's number of ids."""
        texts = texts.cast(pa.binary()).fill_null(b"")
        if self.split_words:
            return self._words(texts.view(pa.string()))
        each = [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(
            [t.decode("utf-8", "replace") for t in texts.to_pylist()], add_special_tokens=False)]
        return np.concatenate([*each, np.zeros(0, self.dtype)]), np.array([len(e) for e in each], np.int64)


def _pybytes(strings: pa.Array) -> list[bytes]:
    """The values as bytes, cut from one copy of the data."""
    if not len(strings):
        return []
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset:strings.offset + len(strings) + 1].tolist()
    data = strings.buffers()[2].to_pybytes() if strings.buffers()[2] else b""
    return [data[a:b] for a, b in pairwise(offsets)]


@lru_cache(maxsize=1)
def encoder(tokenizer_json: str, split_words: bool) -> Encoder:
    """The worker's encoder, kept from task to task with the words that it remembers."""
    return Encoder(tokenizer_json, split_words)


def _sequences(ids: np.ndarray, length: int) -> pa.Table:
    n = -(-len(ids) // length)
    padded = np.zeros(n * length, ids.dtype)
    padded[:len(ids)] = ids
    tokens = np.zeros(n * length, bool)
    tokens[:len(ids)] = True
    mask = pa.array(tokens)
    return pa.table({"ids": pa.FixedSizeListArray.from_arrays(pa.array(padded), length),
                     "mask": pa.FixedSizeListArray.from_arrays(mask, length)})


def to_file(number: int, doc_ids: pa.Array, lengths: list[int], ids: np.ndarray, length: int = SEQUENCE, batch: int = BATCH) -> bytes:
    """The bytes of one file."""
    out = io.BytesIO()
    table = _sequences(ids, length).replace_schema_metadata({"file": json.dumps({"number": number, "tokens": len(ids)})})
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table, max_chunksize=batch)
    docs = pa.table({"doc_id": doc_ids, "n_tokens": pa.array(lengths, pa.int64())})
    with pa.ipc.new_stream(out, docs.schema) as writer:
        writer.write_table(docs)
    return out.getvalue()


def from_file(content) -> tuple[int, pa.Table, pa.Table]:
    """(number, sequences, documents); both tables are views of ``content``."""
    source = pa.BufferReader(content)
    with pa.ipc.open_stream(source) as reader:
        sequences = reader.read_all()
    with pa.ipc.open_stream(source) as reader:
        docs = reader.read_all()
    return json.loads(sequences.schema.metadata[b"file"])["number"], sequences, docs


def token_ids(sequences: pa.Table) -> np.ndarray:
    """All ids of a file in order, without the padding."""
    column = sequences.column("ids")
    parts = [c.flatten().to_numpy(zero_copy_only=True) for c in column.chunks]
    n = sum(c.flatten().true_count for c in sequences.column("mask").chunks)
    return (np.concatenate(parts) if parts else np.zeros(0, "<u2"))[:n]


def write_token_files(docs: DataFrame, tokenizer_json: str, path: str, end_id: int, split_words: bool = False,
                      length: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` to each, and write the ids in ascending order of id.

    The rows are range-partitioned by id, ties by text, nulls first; every partition is one file, its
    number the partition's, so ids ascend from file to file and within each. Null and empty texts have the
    end id only, repeated ids stand side by side; an empty table writes no documents.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value, split_words)
        doc_ids, ids, lengths = [], [], []
        for batch in batches:
            doc_ids.append(batch.column(0))
            for i in range(0, batch.num_rows, TEXTS):
                found, count = encode(batch.column(1)[i:i + TEXTS])
                ids.append(np.insert(found, np.cumsum(count), end_id))
                lengths += (count + 1).tolist()
            pa.default_memory_pool().release_unused()
        if lengths:
            content = to_file(TaskContext.get().partitionId(), pa.chunked_array(doc_ids), lengths, np.concatenate(ids), length)
            del ids
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])
        pa.default_memory_pool().release_unused()  # the worker stays for later tasks

    sorted_rows = rows.repartitionByRange(-(-total // FILE_BYTES) or 1, "doc_id").sortWithinPartitions("doc_id", "text")
    write_files(sorted_rows.mapInArrow(run, "content binary"), "content", path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files under ``path``.

    ``start`` counts the ids of all documents ahead; only the totals of the files are summed across them.
    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers.
    """
    bound_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                number, sequences, docs = from_file(content.as_buffer())
                lengths = docs.column("n_tokens").to_numpy()
                ids, ends = token_ids(sequences), np.cumsum(lengths)
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lengths), number, np.int64)), docs.column("doc_id").combine_chunks(),
                     pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())],
                    ["file", "doc_id", "inside", "n_tokens", "ids_crc32"])
        pa.default_memory_pool().release_unused()

    found = written(read_files(spark, path).mapInArrow(run, "file long, doc_id long, inside long, n_tokens long, ids_crc32 long"), "token-docs")
    sums = found.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("file").alias("f"), F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("ahead"))
    return found.join(starts, F.col("file") == F.col("f")).select(
        "doc_id", (F.col("ahead") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
