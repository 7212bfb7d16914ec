"""Token ids in compressed binary shards with a shared dictionary.

Documents are dealt out by ranges of their id, so shards follow each other in
ascending id order. A task encodes its documents and writes one shard:

    magic, format version, bytes per id, dictionary sha256, documents
    one zstandard frame per document (its ids, little-endian, shared dictionary)
    index: for each document its id, place, frame length and number of tokens
    footer: place of the index, documents, tokens, magic

so one document is read by two small reads. The dictionary is trained on the
serialised ids of a bounded sample (``SAMPLE_DOCS`` documents, by hash, of longer ones
a window of ``SAMPLE_CHARS`` characters), lies beside the shards, and is checked by
its hash on reading. Files go through pyarrow's file systems, to the folder in
``spark.checkpoint.dir``; each attempt of a task writes a file of its own, and
only files named in the manifest, which Spark commits, are read.

Defined results: a null text is empty and has the end id alone; a null id comes
first; rows that share an id are documents of their own, in order of their text.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, write_table
from . import kernels as K
from .common import crc, sample_by_hash
from .encode import PieceEncoder, tokenizer_path

MAGIC = b"CLTOKZ01"
HEAD, HEAD_SIZE = "<8sHH32sQ", struct.calcsize("<8sHH32sQ")
ENTRY = np.dtype([("id", "<i8"), ("has_id", "<i8"), ("place", "<i8"), ("size", "<i8"), ("tokens", "<i8")])
FOOT, FOOT_SIZE = "<QQQ8s", struct.calcsize("<QQQ8s")
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 16_384, 65_536
LEVEL = 3
READ_ROWS = 2000


def open_fs(path: str):
    """File system and path within it; Spark writes ``file:/x`` for ``file:///x``."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary, or none where there is too little to learn from."""
    import zstandard

    if len(samples) < 64:                     # few, perhaps long: pieces of them
        samples = [s[i:i + 1024] for s in samples for i in range(0, len(s), 1024)]
    samples = [s for s in samples if len(s) >= 8]
    total = sum(map(len, samples))
    if len(samples) < 16 or total < 4096:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 4), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


class ShardWriter:
    """Writes one shard document by document; frames go out at once, the index stays."""

    def __init__(self, out, width: int, dictionary: bytes):
        import zstandard

        self.out, self.width = out, width
        self.frame = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        self.entries: list[tuple] = []
        self.at = HEAD_SIZE
        out.write(struct.pack(HEAD, MAGIC, 1, width, hashlib.sha256(dictionary).digest(), 0))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        f = self.frame.compress(ids.astype(f"<u{self.width}").tobytes())
        self.out.write(f)
        self.entries.append((doc_id or 0, doc_id is not None, self.at, len(f), len(ids)))
        self.at += len(f)

    def close(self) -> tuple[int, int]:
        index = np.array(self.entries, ENTRY)
        tokens = int(index["tokens"].sum())
        self.out.write(index.tobytes())
        self.out.write(struct.pack(FOOT, self.at, len(index), tokens, MAGIC))
        self.out.close()
        return len(index), tokens


class ShardReader:
    """Random access to the documents of one shard."""

    def __init__(self, path: str, dictionary: bytes | None = None):
        import zstandard

        fs, name = open_fs(path)
        self.file = fs.open_input_file(name)
        magic, _, self.width, sha, _ = struct.unpack(HEAD, self.file.read_at(HEAD_SIZE, 0))
        if dictionary is None:
            with fs.open_input_file(name.rsplit("/", 1)[0] + "/dictionary") as f:
                dictionary = f.read()
        if magic != MAGIC or sha != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path}: not a token shard, or of another dictionary")
        size = self.file.size()
        place, n, self.tokens, magic = struct.unpack(FOOT, self.file.read_at(FOOT_SIZE, size - FOOT_SIZE))
        if magic != MAGIC:
            raise ValueError(f"{path}: the shard is not complete")
        self.index = np.frombuffer(self.file.read_at(n * ENTRY.itemsize, place), ENTRY)
        self.frame = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.index)

    def doc_id(self, i: int) -> int | None:
        return int(self.index["id"][i]) if self.index["has_id"][i] else None

    def ids(self, i: int) -> np.ndarray:
        e = self.index[i]
        raw = self.frame.decompress(self.file.read_at(int(e["size"]), int(e["place"])),
                                    max_output_size=max(int(e["tokens"]) * self.width, 1))
        out = np.frombuffer(raw, f"<u{self.width}").astype("<u4")
        if len(out) != e["tokens"]:
            raise ValueError("a document's frame does not match the index")
        return out


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, lower: bool,
                      text_col: str = "text", id_col: str = "doc_id") -> tuple[str, DataFrame]:
    """Writes the shards; their folder and the manifest ``(shard, path, n_docs, n_tokens)``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def serialised(batches):
        enc = PieceEncoder(tokenizer, end_id, lower)
        for b in batches:
            for _, data, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                ids, at = enc(data, off)
                yield pa.RecordBatch.from_arrays([pa.array(
                    [ids[at[i]:at[i + 1]].astype(f"<u{width}").tobytes() for i in range(len(at) - 1)],
                    pa.binary())], names=["ids"])

    # of a long text a window at a place chosen by its id's hash
    size = F.length("text")
    at = F.pmod(F.xxhash64(F.lit(5), "id"), F.greatest(size - SAMPLE_CHARS, F.lit(0)) + 1).cast("int") + 1
    some = d.where(size > 0).select("id", F.col("text").substr(at, F.lit(SAMPLE_CHARS)).alias("text"))
    few = sample_by_hash(some, "id", SAMPLE_DOCS)
    dictionary = train_dictionary([r["ids"] for r in few.mapInArrow(K.tidy(serialised), "ids binary").collect()])
    folder = scratch_path(spark, "token-files")
    fs, name = open_fs(folder)
    fs.create_dir(name, recursive=True)
    with fs.open_output_stream(name + "/dictionary") as f:
        f.write(dictionary)

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.tok"
        enc, out = PieceEncoder(tokenizer, end_id, lower), None
        for b in batches:
            for lo, data, off in K.text_chunks(b.column(1), K.SMALL_CHUNK):
                if out is None:
                    fs, name = open_fs(path)
                    out = ShardWriter(fs.open_output_stream(name), width, dictionary)
                ids, at = enc(data, off)
                for i, doc_id in enumerate(b.column(0).slice(lo, len(at) - 1).to_pylist()):
                    out.add(doc_id, ids[at[i]:at[i + 1]])
        if out is not None:
            n, tokens = out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([path]), pa.array([n]), pa.array([tokens])],
                names=["shard", "path", "n_docs", "n_tokens"])

    dealt = d.repartitionByRange("id").sortWithinPartitions("id", "text")
    manifest = dealt.mapInArrow(K.tidy(write), "shard long, path string, n_docs long, n_tokens long")
    return folder, write_table(manifest, "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, ids_crc32)`` of every document, from the files alone.

    The manifest has a row for each shard, so its running total is a small table.
    """
    rows, before = [], 0
    for r in manifest.orderBy("shard").collect():
        rows.append((r["path"], before))
        before += r["n_tokens"]

    def read(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard = ShardReader(path)
                starts = start + np.concatenate([[0], np.cumsum(shard.index["tokens"])])
                for lo in range(0, len(shard), READ_ROWS):
                    part = range(lo, min(lo + READ_ROWS, len(shard)))
                    ids = [shard.ids(i) for i in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard.doc_id(i) for i in part], pa.int64()),
                         pa.array(starts[lo:part.stop]), pa.array([len(x) for x in ids], pa.int64()),
                         pa.array([crc(x.tobytes()) for x in ids], pa.int64())],
                        names=["id", "start", "n_tokens", "ids_crc32"])

    files = spark.createDataFrame(rows, "path string, start long")
    if len(rows) > 1:
        files = files.repartition(len(rows))
    return files.mapInArrow(K.tidy(read), "id long, start long, n_tokens long, ids_crc32 long") \
        .withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame) -> DataFrame:
    """Writes and reads back the documents in ids of the public lower-case word vocabulary."""
    _, manifest = write_token_files(docs, tokenizer_path("word_bpe_49k.json"), 1, True)
    return read_token_files(docs.sparkSession, manifest)
