"""Token-id files: one concatenated id array per shard with Elias-Fano coded
document boundaries, written and read by the tasks that encode and decode them.

Texts are ranged by doc_id over the cluster and sorted within each range; every
task encodes its texts and streams their ids into one shard. A shard is

    magic | ids (2 or 4 bytes each) | boundaries | doc_ids | footer

where boundaries and doc_ids are Elias-Fano sequences. Shard files get unique
names, so a repeated attempt never touches another's file; the driver then
writes one manifest that names the shards of the attempts that counted, with
their id counts, whose running sum gives every shard's first offset. (As a Python
data source the same work starts ten Python processes beside the driver, 343 MB.)

Edge cases: a null or empty text is a document of its end id alone; a null
doc_id comes first; repeated doc_ids are separate documents in a fixed order
(by text hash); an empty table gives a manifest without shards; other columns
are left out; very long texts are encoded whole.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundcast.llm import elias_fano, files

MAGIC = b"FCTOKEN1"
MANIFEST = "_manifest.json"
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
#: Ids that the reader hands over at once, about.
READ_IDS = 1 << 20
#: Pieces that a worker remembers in each of two generations, and the characters of
#: the longest one: some 200 MB at most.
MEMO = 500_000
MEMO_CHARACTERS = 40
_FOOTER = struct.Struct("<QQQQQB8s")  # docs, nulls, ids, bytes of both sequences, id size, magic
#: A space between two visible characters: a piece may begin there.
_PLAIN_SPACE = regex.compile(r"(?<=\S) (?=\S)")
#: White space in Latin texts, beside which a space does not begin a piece.
_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
_BESIDE = [c + " " for c in _BLANKS] + [" " + c for c in _BLANKS]
#: How such a tokenizer cuts texts before it merges (a fixed value of its format).
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_BEYOND_LATIN = regex.compile("[^\x00-\u024f]")


def _byte_names() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: itself if
    it is visible in Latin-1, else the next one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memo(dict):
    """Ids of a space and a tail, by tail; what is missing is learned. Two
    generations: the older one is given up when the younger is full."""

    def __init__(self, learn):
        super().__init__()
        self.learn, self.old = learn, {}

    def __missing__(self, tail: str) -> bytes:
        got = self.old.get(tail)
        if got is None:
            got = self.learn(tail)
        if len(tail) > MEMO_CHARACTERS:
            return got
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[tail] = got
        return got


class Encoder:
    """Encodes with a tokenizer file of the tokenizers library.

    A byte-level BPE tokenizer never joins characters across a space between two
    visible ones: the space always begins a piece of its own. So texts are cut
    there, and each distinct piece goes through the library once and is then
    remembered. Other kinds of tokenizers get each whole text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = {2: "H", 4: "I"}[self.kind.itemsize]
        made = json.loads(self.tokenizer.to_str())
        cut = made["pre_tokenizer"] or {}
        self.by_piece = (
            made["model"]["type"] == "BPE" and made["normalizer"] is None and cut.get("type") == "ByteLevel"
            and cut.get("use_regex") and not cut.get("add_prefix_space")
        )
        self.added = [t["content"] for t in made["added_tokens"]]
        self.names = _byte_names()
        self.merge = self.tokenizer.model
        self.memo = _Memo(self._learn)

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _merged(self, part: str) -> bytes:
        """Ids of what the tokenizer does not cut."""
        raw = part.encode().decode("latin-1").translate(self.names)
        return array(self.code, [t.id for t in self.merge.tokenize(raw)]).tobytes()

    def _learn(self, tail: str) -> bytes:
        if tail.isalpha():
            return self._merged(" " + tail)
        if tail[-1:] in ".,!" and tail[:-1].isalpha():
            return self.memo[tail[:-1]] + self._merged(tail[-1])
        return self._cut_and_merge(" " + tail)

    def _cut_and_merge(self, piece: str) -> bytes:
        parts = _CUT.findall(piece)
        return b"".join([
            self.memo[x[1:]] if x[0] == " " and len(parts) > 1 and len(x) > 1 else self._merged(x) for x in parts
        ])

    def __call__(self, text: str) -> bytes:
        """The ids as bytes of ``self.kind``."""
        # special tokens are cut out first, and rules for letters differ between
        # Unicode versions: such texts go to the library whole
        if not self.by_piece or any(t in text for t in self.added):
            return self._encode(text)
        if not text.isascii() and _BEYOND_LATIN.search(text):
            return self._encode(text)
        if not text:
            return b""
        plain = text[0] != " " and text[-1] != " " and not any(map(text.__contains__, _BESIDE))
        pieces = text.split(" ") if plain else _PLAIN_SPACE.split(text)
        first = self._cut_and_merge(pieces.pop(0))
        return first + b"".join(map(self.memo.__getitem__, pieces))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Encodes a task's texts into one shard; a row (partition, file, n_docs, n_ids) unless it has none."""
    part = TaskContext.get().partitionId()
    path = files.child(folder, f"shard-{part:06d}-{uuid.uuid4().hex}.tok")
    out = None
    ids, lengths, nulls = [], [], 0
    try:
        for batch in batches:
            if out is None and batch.num_rows:
                encode = encoder(tokenizer)
                end = np.array([end_id], encode.kind).tobytes()
                where, name = files.locate(path)
                out = where.open_output_stream(name, compression=None, buffer_size=1 << 20)
                out.write(MAGIC)
            docs = batch.column("doc_id")
            nulls += docs.null_count
            ids.append(docs.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
            size = np.empty(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column("text")):
                data = encode(text.as_py() or "") + end
                out.write(data)
                size[i] = len(data) // encode.kind.itemsize
            lengths.append(size)
        if out is None:
            return
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int64)
        a, b = elias_fano.encode(bounds), elias_fano.encode(np.concatenate(ids))
        out.write(a + b)
        out.write(_FOOTER.pack(len(bounds) - 1, nulls, int(bounds[-1]), len(a), len(b), encode.kind.itemsize, MAGIC))
        out.close()
    except BaseException:
        if out is not None:
            out.close()
            files.delete([path])
        raise
    made = [[part], [path.rsplit("/", 1)[1]], [len(bounds) - 1], [int(bounds[-1])]]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["partition", "file", "n_docs", "n_ids"])


def _read_shard(path: str, base: int) -> Iterator[pa.RecordBatch]:
    """The documents of a shard before which there are ``base`` ids."""
    where, name = files.locate(path)
    with where.open_input_file(name) as f:
        size = f.size()
        f.seek(size - _FOOTER.size)
        n_docs, nulls, n_ids, a, b, width, magic = _FOOTER.unpack(f.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        f.seek(size - _FOOTER.size - a - b)
        bounds, docs = elias_fano.Sequence(f.read(a)), elias_fano.Sequence(f.read(b))
        f.seek(len(MAGIC))
        step = max(1, min(4096, READ_IDS * n_docs // max(n_ids, 1)))
        for i in range(0, n_docs, step):
            j = min(n_docs, i + step)
            at = bounds.range(i, j + 1)
            ids = np.frombuffer(f.read(int(at[-1] - at[0]) * width), f"<u{width}").astype("<u4")
            skip = min(max(nulls - i, 0), j - i)  # null doc_ids come first
            own = docs.range(max(i - nulls, 0), max(j - nulls, 0))
            offsets = ((at - at[0]) * 4).astype(np.int64)
            blob = pa.Array.from_buffers(
                pa.large_binary(), j - i, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([None] * skip + own.tolist(), pa.int64()), pa.array(at[:-1] + base), pa.array(np.diff(at)), blob],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> str:
    """Encode ``docs`` (doc_id, text) into token files below ``path`` (new or empty)."""
    files.make_dir(path)
    tie = F.xxhash64("text")
    made = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(F.col("doc_id"), tie)
        .sortWithinPartitions(F.col("doc_id"), tie, "text")
        .mapInArrow(
            lambda batches: _write_shard(batches, path, tokenizer, end_id), "partition long, file string, n_docs long, n_ids long"
        )
    )
    try:
        shards = sorted(made.collect(), key=lambda r: r.partition)
    except BaseException:
        files.delete([p for p, _ in files.listed(path, ".tok")])
        raise
    files.write_json(
        files.child(path, MANIFEST), [{"file": r.file, "n_docs": r.n_docs, "n_ids": r.n_ids} for r in shards]
    )
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian
    unsigned 32-bit integers) of every document."""
    shards = files.read_json(files.child(path, MANIFEST))
    bases = np.cumsum([0, *(s["n_ids"] for s in shards)]).tolist()
    parts = [(files.child(path, s["file"]), base) for s, base in zip(shards, bases, strict=False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                yield from _read_shard(*parts[i])

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(run, SCHEMA)  # a task for every shard
