"""Removal of passages that a document with a smaller doc_id has too, byte for byte.

Every byte goes that a string of ``LENGTH`` bytes covers which also starts in a
document with a smaller doc_id. All strings count, overlapping ones too, as the input
has them; none crosses documents.

1. Texts are written once as block files of about ``BLOCK`` bytes, below the shared
   scratch folder, each read again by the task that handles its block.
2. Anchors: of every ``LENGTH``-byte string the ``GRAM``-byte string(s) with the least
   hash. Equal strings have equal anchors at equal places. Blocks send the distinct
   hashes of their anchors; hashes of one document alone come to nothing there.
3. Of anchors that several documents have, the bytes around them (all strings that can
   hold the anchor) go to the bucket of the hash, once per block for equal ones, with
   the smallest doc_id. Larger doc_ids in the block are settled on the spot.
4. A bucket builds the run-compressed transform of its distinct strings and streams all
   of them for their matching statistics (``run_index``); long matches whose class
   holds a smaller doc_id are marked. No hash decides: all bytes are compared.
5. Marks return to the blocks, which take the covered bytes out.

A passage that a third of all documents have costs its bucket one row per block.

Edge cases: a null text is empty; texts shorter than ``LENGTH`` stay whole; rows with a
null doc_id stay whole and cover nothing; rows that repeat a doc_id are judged alike,
never against each other; an empty table gives an empty result; other columns are
ignored; texts are read whole, however long (a long text is a block of its own).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundcast.llm import files, hashing, packed, run_index
from fundcast.session import cut_lineage, scratch_path

LENGTH = 50
GRAM = 25
BLOCK = 4 << 20
#: Anchors, and strings around anchors, that one bucket takes, about.
BUCKET_HASHES = 1 << 19
BUCKET_STRINGS = 1 << 16
#: Windows whose anchors are sought at a time, and anchors whose surroundings are cut out.
_STEP = 1 << 17
_ROWS = 1 << 13
_BYTES = hashing.mix(np.arange(1, 257, dtype=np.uint64))
_P = 0x9E3779B97F4A7C15
_KEY = 6  # bytes of a hash that are sent; its bucket tells leading ones


def _grams(raw: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all strings of ``n`` bytes, by doubling."""
    power, size = _BYTES[raw], 1
    out, done = None, 0
    while True:
        if n & size:
            if out is None:
                out = power
            else:
                m = len(power) - done
                out = out[:m] * np.uint64(pow(_P, size, 1 << 64)) + power[done:]
            done += size
        if 2 * size > n:
            break
        power = power[:-size] * np.uint64(pow(_P, size, 1 << 64)) + power[size:]
        size *= 2
    return hashing.mix(out[: max(len(raw) - n + 1, 0)])


def _sliding(x: np.ndarray, n: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) over every ``n`` neighbours."""
    size = 1
    while size < n:
        step = min(size, n - size)
        x = take(x[:-step], x[step:])
        size += step
    return x


def anchors(raw: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of all texts in ``raw``; texts that do not
    count have none."""
    span = LENGTH - GRAM + 1
    places, keys = [], []
    usable = np.repeat(counts, np.diff(offsets))
    for end in offsets[1:]:
        usable[max(end - LENGTH + 1, 0) : end] = False  # strings would leave their text
    for at in range(0, max(len(raw) - LENGTH + 1, 0), _STEP):
        windows = min(_STEP, len(raw) - LENGTH + 1 - at)
        h = _grams(raw[at : at + windows + LENGTH - 1], GRAM)
        rank = (h >> np.uint64(32)).astype(np.uint32)
        least = _sliding(rank, span, np.minimum)
        least[~usable[at : at + windows]] = 0
        none = np.zeros(span - 1, np.uint32)
        chosen = np.flatnonzero(_sliding(np.concatenate([none, least, none]), span, np.maximum) == rank)
        places.append(chosen + at)
        keys.append(h[chosen])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)  # steps overlap
    return place, np.concatenate(keys)[first]


class Block:
    """A block file: doc_ids and texts."""

    def __init__(self, path: str):
        where, name = files.locate(path)
        with where.open_input_file(name) as f:
            t = pa.ipc.open_file(f).read_all().combine_chunks()
        self.doc_id, text = t.column("doc_id").combine_chunks(), t.column("text").combine_chunks()
        self.offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = text.buffers()[2]
        self.raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.counts = self.doc_id.is_valid().to_numpy(zero_copy_only=False)
        self.ids = self.doc_id.fill_null(0).to_numpy()

    def anchors(self):
        """(positions, hashes, rows of their documents)."""
        place, key = anchors(self.raw, self.offsets, self.counts)
        return place, key, np.searchsorted(self.offsets, place, "right") - 1


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.large_binary())])

        def flush() -> pa.RecordBatch:
            t = pa.concat_tables(held).combine_chunks()
            name = f"{number}-{uuid.uuid4().hex[:8]}.arrow"  # an attempt never meets another's file
            where, path = files.locate(files.child(folder, name))
            with where.open_output_stream(path) as out, pa.ipc.new_file(out, schema, options=options) as f:
                f.write_table(t)
            return pa.RecordBatch.from_pydict({"block": [number], "file": [name], "n_bytes": [size]})

        for batch in batches:
            for part in packed.slices(batch, "text", BLOCK):
                text = part.column("text").cast(pa.large_string()).fill_null("").cast(pa.large_binary())
                held.append(pa.table([part.column("doc_id"), text], schema=schema))
                size += part.get_total_buffer_size() if not part.num_rows else int(
                    pa.compute.sum(pa.compute.binary_length(text)).as_py()
                )
                if size >= BLOCK:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return write


def _hashes(folder: str, bits: int):
    """Of every block the distinct hashes of its anchors, and whether several of its
    documents have them, by bucket."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, name in zip(batch.column("block").to_pylist(), batch.column("file").to_pylist()):
                _, key, doc = Block(files.child(folder, name)).anchors()
                if not len(key):
                    continue
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                many = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                key = key[first]
                low = key.view(np.uint8).reshape(-1, 8)[:, :_KEY]
                bucket = packed.bucket_of(key, bits)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(key)]])
                yield pa.RecordBatch.from_pydict({
                    "bucket": bucket[cuts[:-1]],
                    "block": np.full(len(cuts) - 1, number),
                    "keys": [low[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                    "many": [np.packbits(many[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])],
                })

    return send


def _shared(key: tuple, table: pa.Table) -> pa.Table:
    """For every block's hashes in a bucket: which of them several documents have."""
    keys = [np.frombuffer(x, np.uint8).reshape(-1, _KEY) for x in table.column("keys").to_pylist()]
    many = [
        np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) > 0 for x, k in zip(table.column("many").to_pylist(), keys)
    ]
    wide = np.zeros((sum(map(len, keys)), 8), np.uint8)
    wide[:, :_KEY] = np.concatenate(keys)
    full = wide.view(np.uint64)[:, 0]
    order = np.argsort(full, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], full[order][1:] != full[order][:-1]]))
    several = np.add.reduceat(1 + np.concatenate(many)[order].astype(np.int64), first) > 1
    shared = np.empty(len(full), bool)
    shared[order] = np.repeat(several, np.diff(np.append(first, len(full))))
    parts = np.split(shared, np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({
        "block": table.column("block"), "bucket": table.column("bucket"),
        "n": pa.array([len(p) for p in parts], pa.int64()), "n_shared": pa.array([int(p.sum()) for p in parts], pa.int64()),
        "bits": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary()),
    })


_LEFT = LENGTH - GRAM  # bytes before an anchor that strings with it can hold
_WIDTH = _LEFT + LENGTH
_WEIGHTS = hashing.mix(np.arange(1000, 1000 + _WIDTH + 2, dtype=np.uint64)) | np.uint64(1)


def _alike(rows: np.ndarray) -> np.ndarray:
    """A number for each row, equal for equal rows (by hash, then by their bytes)."""
    h = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        h += rows[:, j].astype(np.uint64) * _WEIGHTS[j]
    _, first, back = np.unique(hashing.mix(h), return_index=True, return_inverse=True)
    odd = np.flatnonzero((rows != rows[first[back]]).any(axis=1))
    back[odd] = len(first) + np.arange(len(odd))  # equal hashes of different rows: each on its own
    return back


_SENT = "key long, block long, pos binary, docs binary, strings binary, marks binary, follow binary"


def _surroundings(folder: str, bits: int):
    def send(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        table = table.sort_by("bucket")
        block = Block(files.child(folder, table.column("file")[0].as_py()))
        number = table.column("block")[0].as_py()
        place, key, doc = block.anchors()
        shared = np.concatenate([
            np.unpackbits(np.frombuffer(b, np.uint8), count=n)
            for b, n in zip(table.column("bits").to_pylist(), table.column("n").to_pylist())
        ]) > 0
        mine = shared[np.searchsorted(np.unique(key), key)]
        place, key, doc = place[mine], key[mine], doc[mine]
        left = np.minimum(place - block.offsets[doc], _LEFT)
        right = np.minimum(block.offsets[doc + 1] - place, LENGTH)
        rows = np.empty((len(place), _WIDTH + 2), np.uint8)
        column = np.arange(_WIDTH)
        for a in range(0, len(place), _ROWS):
            s = slice(a, a + _ROWS)
            at = place[s, None] + (column - _LEFT)
            part = block.raw[np.clip(at, 0, len(block.raw) - 1)]
            part[(column < _LEFT - left[s, None]) | (column >= _LEFT + right[s, None])] = 0
            rows[s, :_WIDTH] = part
        rows[:, _WIDTH], rows[:, _WIDTH + 1] = left, right
        ids = block.ids[doc]
        same = _alike(rows)
        order = np.lexsort((place, ids, same))
        lead = np.concatenate([[True], same[order][1:] != same[order][:-1]])
        head = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]  # the first one of equal rows
        larger = ids[order] > ids[head]
        # larger doc_ids lose all strings around the anchor; repeats of the smallest share its fate
        gone, follow = order[larger], np.flatnonzero(~larger & ~lead)
        begin, end = place[gone] - left[gone], place[gone] + right[gone]
        sort = np.argsort(begin, kind="stable")
        begin, end = begin[sort], end[sort]
        if len(begin):
            cut = np.concatenate([[True], begin[1:] > np.maximum.accumulate(end)[:-1]])
            begin, end = begin[cut], np.maximum.reduceat(end, np.flatnonzero(cut))
        out = [(-1 - number, b"", b"", b"", np.stack([begin, end]).astype(np.uint32).tobytes(),
                np.stack([place[order[follow]], place[head[follow]]]).astype(np.uint32).tobytes())]
        send = order[lead]
        send = send[np.argsort(key[send], kind="stable")]
        bucket = packed.bucket_of(key[send], bits)
        squeeze = zstandard.ZstdCompressor(level=1)
        for part in np.split(send, np.flatnonzero(np.diff(bucket)) + 1) if len(send) else []:
            out.append((
                int(packed.bucket_of(key[part[:1]], bits)[0]), place[part].astype(np.uint32).tobytes(),
                ids[part].tobytes(), squeeze.compress(rows[part].tobytes()), b"", b"",
            ))
        k, pos, docs, strings, marks, follows = map(list, zip(*out))
        return pa.table({
            "key": pa.array(k, pa.int64()), "block": pa.array([number] * len(k), pa.int64()), "pos": pa.array(pos, pa.binary()),
            "docs": pa.array(docs, pa.binary()), "strings": pa.array(strings, pa.binary()),
            "marks": pa.array(marks, pa.binary()), "follow": pa.array(follows, pa.binary()),
        })

    return send


_MARKED = "block long, file string, pos binary, found binary, marks binary, follow binary"


def _marked(block, pos, found, marks, follow) -> pa.Table:
    return pa.table({
        "block": block, "file": pa.nulls(len(block), pa.string()), "pos": pa.array(pos, pa.binary()),
        "found": pa.array(found, pa.binary()), "marks": pa.array(marks, pa.binary()), "follow": pa.array(follow, pa.binary()),
    })


def _matched(key: tuple, table: pa.Table) -> pa.Table:
    """The marks of a bucket's strings, by block."""
    pa.default_memory_pool().release_unused()
    n = table.num_rows
    if key[0].as_py() < 0:  # what a block settled by itself
        return _marked(table.column("block"), [b""] * n, [b""] * n, table.column("marks").to_pylist(),
                       table.column("follow").to_pylist())
    expand = zstandard.ZstdDecompressor()
    rows = np.concatenate([
        np.frombuffer(expand.decompress(x), np.uint8).reshape(-1, _WIDTH + 2) for x in table.column("strings").to_pylist()
    ])
    docs = packed.unpack(table, "docs", np.int64)
    place = [np.frombuffer(x, np.uint32) for x in table.column("pos").to_pylist()]
    same = _alike(rows)
    order = np.lexsort((docs, same))
    first = order[np.concatenate([[True], same[order][1:] != same[order][:-1]])]  # distinct strings, smallest doc_id
    strings = rows[:, :_WIDTH]
    begin = _LEFT - rows[:, _WIDTH].astype(np.int64)
    end = _LEFT + rows[:, _WIDTH + 1].astype(np.int64)
    found = run_index.earlier(
        strings[first], docs[first], (begin[first], end[first]), strings, docs, (begin, end), LENGTH
    )
    pos, bits = [], []
    for p, f in zip(place, np.split(found, np.cumsum([len(p) for p in place])[:-1])):
        pos.append(p[f != 0].tobytes())
        bits.append(f[f != 0].astype(np.uint32).tobytes())
    return _marked(table.column("block"), pos, bits, [b""] * n, [b""] * n)


_KEPT = "doc_id long, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary"


def _finish(folder: str):
    def take_out(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        block = Block(files.child(folder, table.column("file").drop_null()[0].as_py()))
        told = table.filter(table.column("file").is_null())
        pos, found = packed.unpack(told, "pos", np.uint32), packed.unpack(told, "found", np.uint32)
        begins, ends = [], []
        for x in filter(None, told.column("marks").to_pylist()):
            begin, end = np.frombuffer(x, np.uint32).reshape(2, -1)
            begins.append(begin)
            ends.append(end)
        for x in filter(None, told.column("follow").to_pylist()):
            mine, leader = np.frombuffer(x, np.uint32).reshape(2, -1)
            if len(mine) and len(pos):
                order = np.argsort(pos, kind="stable")
                at = np.minimum(np.searchsorted(pos[order], leader), len(pos) - 1)
                hit = pos[order[at]] == leader
                pos, found = np.concatenate([pos, mine[hit]]), np.concatenate([found, found[order[at]][hit]])
        for window in range(_LEFT + 1):
            start = pos[(found >> np.uint32(window)) & np.uint32(1) > 0].astype(np.int64) - _LEFT + window
            begins.append(start)
            ends.append(start + LENGTH)
        edge = np.zeros(len(block.raw) + 1, np.int32)
        for begin, end in zip(begins, ends):
            np.add.at(edge, begin, 1)
            np.subtract.at(edge, end, 1)
        gone = np.cumsum(edge, out=edge)[:-1] > 0
        del edge, begins, ends
        border = np.zeros(len(block.raw) + 1, bool)
        border[block.offsets] = True
        begin = np.flatnonzero(gone & (border[:-1] | ~np.concatenate([[False], gone[:-1]])))
        end = np.flatnonzero(gone & (border[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
        n = len(block.offsets) - 1
        cut = np.searchsorted(begin, block.offsets)
        of = np.repeat(np.arange(n), np.diff(cut))
        spans = pa.ListArray.from_arrays(
            pa.array(cut, pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(begin - block.offsets[of]), pa.array(end - block.offsets[of])], names=["begin", "end"]
            ),
        )
        data = block.raw[~gone]
        # bytes that stay before each text: those of its place, less what the spans before take
        taken = np.concatenate([[0], np.cumsum(end - begin)])
        ends = block.offsets - taken[cut]
        kept = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
        return pa.table({
            "doc_id": block.doc_id, "n_bytes": pa.array(np.diff(block.offsets)), "spans": spans, "kept": kept.cast(pa.binary()),
        })

    return take_out


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): of every row the bytes of its text, the maximal
    runs of them that go (from begin to before end) and the bytes that stay."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "blocks")
    files.make_dir(folder)
    with packed.small_batches(spark):
        blocks = cut_lineage(
            docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
                _writer(folder), "block long, file string, n_bytes long"
            ), "block-list",
        )
    amount = blocks.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("bytes")).first()
    # work goes by blocks, not by the size of the rows that name them
    tasks = max(1, min(amount.n, max(200, 4 * spark.sparkContext.defaultParallelism)))
    expected = 2 * amount.bytes // (LENGTH - GRAM + 2)
    bits = packed.bucket_bits(expected, BUCKET_HASHES, 32)
    sent = blocks.repartition(tasks).mapInArrow(
        _hashes(folder, bits), "bucket long, block long, keys binary, many binary"
    )
    told = sent.groupBy("bucket").applyInArrow(_shared, "block long, bucket long, n long, n_shared long, bits binary")
    told = cut_lineage(told, "shared-anchors")
    shared = told.agg(F.coalesce(F.sum("n_shared"), F.lit(0)).alias("n")).first().n
    bits = packed.bucket_bits(shared, BUCKET_STRINGS, 32)
    asked = told.join(blocks.select("block", "file"), "block").repartition(tasks, "block")
    around = asked.groupBy("block").applyInArrow(_surroundings(folder, bits), _SENT)
    marks = around.repartition(max(tasks, 1 << min(bits, 20)), "key").groupBy("key").applyInArrow(_matched, _MARKED)
    listed = blocks.select("block", "file", *[F.lit(None).cast("binary").alias(c) for c in ("pos", "found", "marks", "follow")])
    return listed.unionByName(marks).repartition(tasks, "block").groupBy("block").applyInArrow(_finish(folder), _KEPT)
