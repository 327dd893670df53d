"""Probabilistic suffix tree over words, and the scores it gives to texts.

Symbols are lower-cased words and one end per text; contexts are the last one to
``DEPTH`` symbols, a start symbol before the first word included. A context is
kept when it occurs ``MIN_CONTEXT`` times and its next-symbol distribution
diverges from that of its longest kept suffix. Distributions are smoothed by
absolute discounting towards that suffix, down to the add-one unigram:

    P(w | s) = max(c(sw) - D, 0) / c(s) + g(s) * P(w | suffix of s)

Counts cover all training texts. Words are counted first. Longer runs are counted
depth by depth: a task counts what one Arrow batch holds, packs it by bucket of
the context's hash, and each bucket is added up on its own; runs below a context
that is too rare are not sent at all. Contexts so frequent that one bucket would
be crowded are spread over all of them.

The score of a text is then a sum over its runs of one to DEPTH + 1 symbols of a
value per run (what the run adds as a context and as a transition). Values of
runs that hold at least 1/2**20 of all tokens are broadcast, there are at most
2**20 of each length; the others are looked up in buckets. A bucket answers every
part of the texts with one packed row, and the answers of a part are added up
together. No text is shuffled.

Edge cases: null and empty texts consist of the end alone; an empty table, or one
without training rows, gives scores from an empty model (every symbol has
probability 1); a null doc_id counts as training; repeated rows are counted and
scored like others; very long texts are read whole; other columns are left out.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundcast.llm import hashing
from fundcast.llm.packed import (
    Bits, assemble, bits_of, bucket_bits, bucket_of, gathered, pack, pair_order, slice_of, slices, small_batches, unpack,
)
from fundcast.session import cut_lineage

DEPTH = 2
MIN_CONTEXT, MIN_PAIR = 8, 3
#: A transition is listed if it is this many times likelier than under the suffix.
MIN_RATIO = 2.0
#: Divergence from the suffix (nats per occurrence) that keeps a context.
MIN_DIVERGENCE = 0.05
DISCOUNT = 0.75
#: Runs above this share of all tokens are broadcast.
SHARE = 2.0**-20
#: Text that a task counts at once (its runs are sorted in memory).
PART_BYTES = 4 << 20

_HALF = np.uint64(0xFFFF_FFFF_0000_0000)
START, END = np.uint64(0xA5A5_0001_0000_0001), np.uint64(0xA5A5_0002_0000_0002)


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, bounds): START, the words and END of every text, end to end."""
    words, bounds = hashing.words(texts)
    n = len(bounds) - 1
    out = np.empty(len(words) + 2 * n, np.uint64)
    new = bounds + 2 * np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[new[:-1]] = keep[new[1:] - 1] = False
    out[keep] = words
    out[new[:-1]], out[new[1:] - 1] = START, END
    return out, new


def run_positions(size: int, bounds: np.ndarray, n: int) -> np.ndarray:
    """Where the runs of ``n`` of ``size`` symbols begin that lie within one text."""
    inside = np.ones(max(size - n + 1, 0), bool)
    for k in range(1, n):
        cut = bounds[1:] - k
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    return np.flatnonzero(inside)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[start], np.add.reduceat(values, start) if len(keys) else values


def count_words(texts: DataFrame, buckets: int) -> DataFrame:
    """(word, c) of the training texts, ends included, starts not."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole, "text", PART_BYTES)):
            symbols, _ = sequences(batch.column("text"))
            word, c = np.unique(symbols[symbols != START], return_counts=True)
            yield pack(bucket_of(hashing.mix(word), buckets), {"words": word, "counts": c.astype(np.uint32)})

    def add(table: pa.Table) -> pa.Table:
        word, c = _sums(unpack(table, "words", np.uint64), unpack(table, "counts", np.uint32).astype(np.int64))
        return pa.table({"word": word.view(np.int64), "c": c})

    packed = texts.mapInArrow(emit, "bucket long, words binary, counts binary")
    return cut_lineage(packed.groupBy("bucket").applyInArrow(add, "word long, c long"), "word-counts")


class Common:
    """The broadcast part: sorted keys of frequent runs with their numbers."""

    def __init__(self, keys: np.ndarray, values: dict[str, np.ndarray]):
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = {k: v[order] for k, v in values.items()}
        self.some = hashing.Filter(self.keys)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, place) of every key."""
        if not len(self.keys):
            return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
        known, place = np.zeros(len(key), bool), np.zeros(len(key), np.int64)
        maybe = self.some.positions(key)
        at = np.searchsorted(self.keys, key[maybe])
        at[at == len(self.keys)] = 0
        known[maybe] = self.keys[at] == key[maybe]
        place[maybe] = at
        return known, place


def _common(rows: DataFrame, key: str, columns: list[str]) -> Common:
    got = rows.select(key, *columns).toPandas()
    return Common(got[key].to_numpy(np.int64).view(np.uint64), {c: got[c].to_numpy() for c in columns})


def count_runs(
    texts: DataFrame, depth: int, common: Common, tokens: int, types: int, buckets: int, above: Bits | None,
) -> tuple[DataFrame, Bits | None]:
    """Transitions out of contexts of ``depth`` symbols: (key, ctx, suffix, next, c, n) of
    those that occur MIN_PAIR times after a context that occurs MIN_CONTEXT times;
    and the bits of all runs of ``depth + 1`` symbols that are frequent enough to be
    contexts themselves. At depth 1 transitions that cannot be MIN_RATIO times
    likelier than by chance, however rare their next word, are left out already.

    ``key`` is the whole run, ``suffix`` the run without its first symbol and
    ``suffix_ctx`` the context of that (0 at depth 1). Contexts that the filter
    ``above`` rules out are not sent.
    """
    held = texts.sparkSession.sparkContext.broadcast((common, above))
    crowded = max(tokens >> max(buckets, 1), 1)  # occurrences that would fill a bucket

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, above = held.value
        for batch in (x for whole in batches for x in slices(whole, "text", PART_BYTES)):
            symbols, bounds = sequences(batch.column("text"))
            at = run_positions(len(symbols), bounds, depth + 1)
            ctx = hashing.runs(symbols, depth)[at] if depth > 1 else symbols[at]
            placed = hashing.mix(ctx)  # its leading bits are the bucket
            if above is not None:
                first = symbols[at]
                known, where = common.find(first)
                keep = above.has_mixed(place_of(first, symbols[at + 1], known, where, common), placed)
                ctx, at, placed = ctx[keep], at[keep], placed[keep]
            nxt = symbols[at + depth]
            if depth == 1:
                spread = crowds(*common.find(ctx), common)
                placed[spread] = hashing.mix(ctx[spread] ^ hashing.mix(nxt[spread]))
            # equal runs once, with their count; runs of one context side by side. Where half
            # hashes agree by chance a run is sent in parts, which its bucket adds up
            order = np.argsort(placed & _HALF | nxt >> np.uint64(32))
            placed, nxt = placed[order], nxt[order]
            start = np.flatnonzero(np.concatenate([[True], (placed[1:] != placed[:-1]) | (nxt[1:] != nxt[:-1])])) if len(nxt) else order
            c = np.diff(np.concatenate([start, [len(nxt)]])).astype(np.uint32)
            placed, nxt, order = placed[start], nxt[start], order[start]
            group = np.flatnonzero(np.concatenate([[True], placed[1:] != placed[:-1]])) if len(nxt) else order
            size = np.diff(np.concatenate([group, [len(nxt)]])).astype(np.uint32)
            heads = {"ctx": ctx[order[group]], "size": size}
            if depth > 1:
                heads["middle"] = symbols[at + 1][order[group]]  # the suffix context
            upper, lower = pack(bucket_of(placed[group], buckets), heads), pack(bucket_of(placed, buckets), {"next": nxt, "c": c.astype(np.uint32)})
            yield pa.RecordBatch.from_arrays(
                [*upper.columns, *lower.columns[1:]], names=[*upper.schema.names, "next", "c"]
            )

    def crowds(known, where, common) -> np.ndarray:
        return known & (common.values["c"][where] > crowded) if len(common.keys) else known

    def place_of(first, second, known, where, common) -> np.ndarray:
        """Bucket of the run (first, second), as at depth 1."""
        bucket = bucket_of(hashing.mix(first), buckets)
        spread = crowds(known, where, common)
        bucket[spread] = bucket_of(hashing.mix(first[spread] ^ hashing.mix(second[spread])), buckets)
        return bucket

    def add(key: tuple, table: pa.Table) -> pa.Table:
        common, _ = held.value
        size = unpack(table, "size", np.uint32)
        ctx, nxt = np.repeat(unpack(table, "ctx", np.uint64), size), unpack(table, "next", np.uint64)
        c = unpack(table, "c", np.uint32).astype(np.int64)
        middle = np.repeat(unpack(table, "middle", np.uint64), size) if depth > 1 else ctx
        order = pair_order(ctx, nxt)
        ctx, nxt, c, middle = ctx[order], nxt[order], c[order], middle[order]
        new = np.ones(len(ctx), bool)
        new[1:] = (ctx[1:] != ctx[:-1]) | (nxt[1:] != nxt[:-1])
        start = np.flatnonzero(new)
        c = np.add.reduceat(c, start)
        ctx, nxt, middle = ctx[start], nxt[start], middle[start]
        group = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
        n = np.add.reduceat(c, group)
        if depth == 1 and len(common.keys):  # of a spread context this bucket sees a part; its count is known
            known, at = common.find(ctx[group])
            n = np.where(known, common.values["c"][at], n)
        n = np.repeat(n, np.diff(np.concatenate([group, [len(ctx)]])))
        own = b""
        if depth < DEPTH:
            often = c >= MIN_CONTEXT
            own = slice_of(_joined(ctx[often], nxt[often]), buckets)
        keep = (c >= MIN_PAIR) & (n >= MIN_CONTEXT)
        ctx, nxt, c, n, middle = ctx[keep], nxt[keep], c[keep], n[keep], middle[keep]
        if depth == 1:  # the least p0 of the next word; under a kept suffix it can be likelier by less
            least = c.copy()  # a word occurs as often as any run that ends in it
            known, at = common.find(nxt)
            if len(common.keys):
                least = np.where(known, common.values["c"][at], least)
            keep = (c - DISCOUNT) / n > MIN_RATIO * ((least + 1) / (tokens + types + 1))
            ctx, nxt, c, n, middle = ctx[keep], nxt[keep], c[keep], n[keep], middle[keep]
        run = _joined(ctx, nxt)
        # words, the suffixes at depth 1, have a table of their own
        suffix, middle = (_joined(middle, nxt), middle) if depth > 1 else (np.zeros_like(ctx), np.zeros_like(ctx))
        head = 1  # the first row carries the bucket's slice of the filter
        return pa.table(
            {
                "bucket": np.full(len(ctx) + head, key[0].as_py()),
                "key": np.concatenate([[0], run.view(np.int64)]),
                "ctx": np.concatenate([[0], ctx.view(np.int64)]),
                "suffix": np.concatenate([[0], suffix.view(np.int64)]),
                "suffix_ctx": np.concatenate([[0], middle.view(np.int64)]),
                "next": np.concatenate([[0], nxt.view(np.int64)]),
                "c": np.concatenate([[0], c]),
                "n": np.concatenate([[0], n]),
                "bits": pa.array([own] + [None] * len(ctx), pa.binary()),
            }
        )

    packed = texts.mapInArrow(
        emit, "bucket long, ctx binary, size binary, " + ("middle binary, " if depth > 1 else "") + "next binary, c binary"
    )
    counted = cut_lineage(
        packed.groupBy("bucket").applyInArrow(
            add, "bucket long, key long, ctx long, suffix long, suffix_ctx long, next long, c long, n long, bits binary"
        ),
        f"runs-{depth}",
    )
    above = None
    if depth < DEPTH:  # slices of a table of fixed size
        above = assemble(counted.where("bits is not null").select("bucket", "bits").toLocalIterator(), buckets)
    return counted.where("bits is null").drop("bits", "bucket"), above


def _joined(ctx: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Key of the run ``ctx`` + ``nxt``. Depth 1: the run hash of two symbols; deeper
    contexts are hashes already, so their runs are keyed by hash of both."""
    return hashing.joined(ctx, nxt)


def _values(
    rows: DataFrame, words: DataFrame, parents: tuple[DataFrame, DataFrame] | None, tokens: int, types: int, depth: int,
) -> tuple[DataFrame, DataFrame]:
    """(pairs, contexts) kept by the divergence test. pairs: key, p (smoothed
    probability), up (that of the suffix), gamma, c; contexts: ctx, gamma, n. The rows
    are joined once, for both."""
    p0 = (F.coalesce("wc", F.lit(0)) + 1) / F.lit(float(tokens + types + 1))
    rows = rows.join(words.select(F.col("word").alias("next"), F.col("c").alias("wc")), "next", "left").withColumn("p0", p0)
    if parents is None:
        rows = rows.withColumn("up", F.col("p0"))
    else:
        pairs, contexts = parents
        rows = (
            rows.join(pairs.select(F.col("key").alias("suffix"), F.col("p").alias("_pp")), "suffix", "left")
            .join(contexts.select(F.col("ctx").alias("suffix_ctx"), F.col("gamma").alias("_pg")), "suffix_ctx", "left")
            .withColumn("up", F.coalesce("_pp", F.col("_pg") * F.col("p0"), "p0"))
        )
    a = (F.col("c") - DISCOUNT) / F.col("n")
    rows = cut_lineage(
        rows.where(a > MIN_RATIO * F.col("up")).select("key", "ctx", "c", "n", "up"), f"likelier-{depth}"
    ).withColumn("a", a)
    contexts = rows.groupBy("ctx").agg(
        F.sum("a").alias("_a"), F.sum(F.col("a") * F.log(F.col("a") / F.col("up"))).alias("divergence"), F.max("n").alias("n")
    ).where(F.col("divergence") >= MIN_DIVERGENCE)
    contexts = cut_lineage(contexts.select("ctx", (1 - F.col("_a")).alias("gamma"), "n"), f"contexts-{depth}")
    pairs = rows.join(contexts.select("ctx", "gamma"), "ctx").select(
        "key", (F.col("a") + F.col("gamma") * F.col("up")).alias("p"), "up", "gamma", "c"
    )
    return cut_lineage(pairs, f"transitions-{depth}"), contexts


def fit(texts: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """(values, words, tokens, types) of the training ``texts`` (column text).

    values: (key, length, v, c) with the log10 value a run adds to a score wherever
    it occurs; words: (word, c)."""
    size = texts.select(F.sum(F.octet_length("text")).alias("s")).first().s or 0
    buckets = bucket_bits(size // 6)
    words = count_words(texts, buckets)
    total = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, types = total.n or 0, total.v
    common = _common(words.where(F.col("c") > tokens * SHARE), "word", ["c"])
    above, parents, parts = None, None, {}
    for depth in range(1, DEPTH + 1):
        rows, above = count_runs(texts, depth, common, tokens, types, buckets, above)
        parents = pairs, contexts = _values(rows, words, parents, tokens, types, depth)
        parts.setdefault(depth, []).append(contexts.select(F.col("ctx").alias("key"), F.log10("gamma").alias("v"), F.col("n").alias("c")))
        parts.setdefault(depth + 1, []).append(pairs.select("key", (F.log10(F.col("p") / F.col("up")) - F.log10("gamma")).alias("v"), "c"))
    values = None
    for length, found in parts.items():
        one = found[0]  # runs of the first and last length are contexts or transitions only, each once
        if len(found) > 1:
            one = found[0].unionAll(found[1]).groupBy("key").agg(F.sum("v").alias("v"), F.max("c").alias("c"))
        one = one.select("key", F.lit(length).alias("length"), "v", "c")
        values = one if values is None else values.unionAll(one)
    return cut_lineage(values, "run-values"), words, tokens, types


def _doc_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model: tuple[DataFrame, DataFrame, int, int]) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row of ``docs``."""
    values, words, tokens, types = model
    spark = docs.sparkSession
    # words carry their count, longer runs only their value
    single = words.select(F.col("word").alias("key"), "c").join(
        values.where("length = 1").select("key", "v", F.col("c").alias("_c")), "key", "full"
    ).select("key", F.lit(1).alias("length"), F.coalesce("v", F.lit(0.0)).alias("v"), F.coalesce("c", F.lit(0)).alias("wc"), F.coalesce("c", "_c").alias("c"))
    table = single.unionAll(values.where("length > 1").select("key", "length", "v", F.lit(0).cast("long").alias("wc"), "c"))
    table = cut_lineage(table, "run-table")
    often = F.col("c") > tokens * SHARE
    common = {n: _common(table.where(often & (F.col("length") == n)), "key", ["v", "wc"]) for n in range(1, DEPTH + 2)}
    rare = table.where(~often)
    amount = docs.select(F.sum(F.octet_length("text")).alias("s")).first().s or 0
    buckets = max(3, bucket_bits(amount // 24))
    listed = rare.where("length > 1").select("key")
    above = bits_of(listed, "key", buckets)
    held = spark.sparkContext.broadcast((common, above))
    norm = float(np.log10(tokens + types + 1))
    # the rarer part of the table, packed by bucket of the key

    def pack_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            key = batch.column("key").to_numpy().view(np.uint64)
            yield pack(
                bucket_of(hashing.mix(key), buckets),
                {"keys": key, "v": batch.column("v").to_numpy(), "wc": batch.column("wc").to_numpy()},
            )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per part of the texts, named by a digest of their keys: what the broadcast
        values give (bucket -1), and what the buckets must look up: runs by key with
        the places in the part that they occur in."""
        common, above = held.value
        for batch in (x for whole in batches for x in slices(whole, "text", PART_BYTES)):
            symbols, bounds = sequences(batch.column("text"))
            text = batch.column("key").to_numpy()
            n = len(text)
            part = int.from_bytes(hashlib.blake2b(text.tobytes(), digest_size=8).digest(), "little", signed=True)
            base, known, more = np.zeros(n), np.zeros(n, np.int64), np.zeros(n)
            texts_of = np.repeat(np.arange(n, dtype=np.uint64), np.diff(bounds))
            sent = []
            for length in range(1, DEPTH + 2):
                at = run_positions(len(symbols), bounds, length)
                key = symbols[at] if length == 1 else _joined(key_at[at], symbols[at + length - 1])
                # the run from every position on, of which the next length is made
                key_at = np.zeros(len(symbols), np.uint64)
                key_at[at] = key
                doc = texts_of[at]
                here, place = common[length].find(key)
                if here.any():
                    hit, place = doc[here].view(np.int64), place[here]
                    more += np.bincount(hit, common[length].values["v"][place], n)
                    if length == 1:
                        c = common[1].values["wc"]
                        base += np.bincount(hit, np.log10(c + 1.0)[place], n)
                        known += np.bincount(hit, (c > 0)[place], n).astype(np.int64)
                    key, doc = key[~here], doc[~here]
                placed = hashing.mix(key)
                if length > 1:
                    left = above.has_mixed(bucket_of(placed, buckets), placed)
                    key, doc, placed = key[left], doc[left], placed[left]
                sent.append((key, doc, placed))
            key, doc, placed = (np.concatenate(x) for x in zip(*sent, strict=True))
            # equal runs of a text side by side, by bucket; a run that is sent in parts is added up
            bits = np.uint64(min(max(n, 1).bit_length(), 32))
            order = np.argsort(placed >> bits << bits | doc)
            key, doc, placed = key[order], doc[order], placed[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            start = np.flatnonzero(new)
            count = np.diff(np.concatenate([start, [len(key)]])).astype(np.uint32)
            key, doc, bucket = key[start], doc[start], bucket_of(placed[start], buckets)
            out = pack(bucket, {"keys": key, "docs": doc.astype(np.uint16 if n < 1 << 16 else np.uint32), "counts": count})
            local = pa.RecordBatch.from_arrays(
                [pa.array([-1]), *(pa.array([b""], pa.binary()) for _ in range(3))], names=["bucket", "keys", "docs", "counts"]
            )
            for rows, is_local in ((local, True), (out, False)):
                k = rows.num_rows
                sums = [x.tobytes() for x in (text, np.diff(bounds) - 1, base, known, more)] if is_local else [None] * 5
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([part] * k, pa.int64()), *(pa.array([x] * k, pa.binary()) for x in sums)],
                    names=[*rows.schema.names, "part", "texts", "tokens", "base", "known", "more"],
                )

    def look_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """A row for every part that asks: places in the part and what the bucket adds there."""
        if right.num_rows:
            listed = unpack(right, "keys", np.uint64)
            order = np.argsort(listed, kind="stable")
            listed = listed[order]
            v, wc = unpack(right, "v", np.float64)[order], unpack(right, "wc", np.int64)[order]
        else:
            listed, v, wc = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64)
        out = []
        for row in left.to_batches():
            for i in range(row.num_rows):
                get = lambda c: row.column(c)[i].as_py()  # noqa: B023, E731
                if get("bucket") < 0:
                    out.append([get(c) for c in ("part", "texts", "docs", "tokens", "base", "known", "more")])
                    continue
                k, count = np.frombuffer(get("keys"), np.uint64), np.frombuffer(get("counts"), np.uint32)
                doc = np.frombuffer(get("docs"), np.uint16 if len(get("docs")) == 2 * len(k) else np.uint32)
                at = np.searchsorted(listed, k)
                at[at == len(listed)] = 0
                good = listed[at] == k if len(listed) else np.zeros(len(k), bool)
                at, doc, count = at[good], doc[good].astype(np.int64), count[good]
                if not len(doc):
                    continue
                hit = np.unique(doc)
                base, known, more = (np.bincount(doc, x * count)[hit] for x in (np.log10(wc[at] + 1.0), wc[at] > 0, v[at]))
                out.append([get("part"), None, hit.astype(np.uint32).tobytes(), None, base.tobytes(), known.astype(np.int64).tobytes(), more.tobytes()])
        return pa.Table.from_arrays(
            [pa.array([r[j] for r in out], kind.type) for j, kind in enumerate(answers)], schema=answers
        )

    def add_up(key: tuple, table: pa.Table) -> pa.Table:
        """The sums of a part's texts. Parts with equal keys count as one with all their sums."""
        rows = table.to_pylist()
        text = np.frombuffer(next(r["texts"] for r in rows if r["texts"] is not None), np.int64)
        kinds = {"tokens": np.int64, "base": np.float64, "known": np.int64, "more": np.float64}
        sums = {c: np.zeros(len(text)) for c in kinds}
        for r in rows:
            at = slice(None) if r["texts"] is not None else np.frombuffer(r["docs"], np.uint32)
            for c, kind in kinds.items():
                if r[c] is not None:
                    sums[c][at] += np.frombuffer(r[c], kind)
        return pa.table({"key": text, **sums})

    answers = pa.schema([("part", pa.int64()), *((c, pa.binary()) for c in ("texts", "docs", "tokens", "base", "known", "more"))])
    kept = docs.select("doc_id", "text")
    keyed = kept.select(_doc_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    sent = keyed.mapInArrow(
        emit,
        "bucket long, keys binary, docs binary, counts binary, part long, texts binary, tokens binary, base binary, known binary, more binary",
    )
    # sums of the broadcast values need no table: they are spread over partitions by part
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod("part", F.lit(1 << buckets))).otherwise(F.col("bucket"))
    packed = cut_lineage(
        rare.select("key", "v", "wc").mapInArrow(pack_table, "bucket long, keys binary, v binary, wc binary"), "rare-runs"
    )
    parts = sent.withColumn("bucket", spread).groupBy("bucket").cogroup(packed.groupBy("bucket")).applyInArrow(
        look_up, "part long, texts binary, docs binary, tokens binary, base binary, known binary, more binary"
    ).groupBy("part").applyInArrow(add_up, "key long, tokens double, base double, known double, more double")
    sums = cut_lineage(
        parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("tokens", "base", "known", "more")]), "score-sums"
    )
    # rows with equal doc_id and text share one key: their sums are divided among them
    rows = kept.groupBy(_doc_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id").agg(F.count("*").alias("_rows"))
    each_row = [F.round(F.col(c) / F.col("_rows")).cast("long") for c in ("tokens", "known")]
    joined = rows.join(sums, "key").select(
        "doc_id", each_row[0].alias("n_tokens"), each_row[1].alias("n_known"),
        ((F.col("base") - F.col("tokens") * norm) / F.col("_rows")).alias("base_score"),
        (F.col("more") / F.col("_rows")).alias("_more"), "_rows",
    )
    each = F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int")))
    return joined.select(
        "doc_id", "n_tokens", "n_known", "base_score", (F.col("base_score") + F.col("_more")).alias("score"), each.alias("_i")
    ).drop("_i")


def fit_and_score(docs: DataFrame, training: Callable[[Column], Column]) -> DataFrame:
    """Learns from the rows that ``training(doc_id)`` admits and scores all rows."""
    with small_batches(docs.sparkSession, 2000):
        model = fit(docs.where(F.coalesce(training(F.col("doc_id")), F.lit(True))).select("text"))
        return score(docs, model).withColumn("train_tokens", F.lit(model[2]).cast("long"))
