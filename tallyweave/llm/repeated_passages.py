"""Removal of every passage that is repeated anywhere, by blockwise suffix sorting with a difference cover.

A byte goes if it lies in a window of `window` bytes that also starts somewhere else. All suffixes need
comparing to that depth, and only a difference cover of them is compared at first: the positions of a text whose place modulo
the period lies in the cover. Any two positions reach a sampled one each by one common shift below the period, so
two equal windows hold two equal samples of window - period + 1 bytes at that shift.

1. Cover ranks: all samples are sorted, one bucket of digests at a time; a sample that stands alone needs no rank, and a
   suffix without a ranked sample within the period is like no other.
2. Long ties: samples of one rank are compared by their whole context, all bytes of the windows that reach
   them at a shift below the period. Where all contexts agree, every one of these windows is repeated, and no suffix
   of them is sorted. Where they do not, one of each group of equal contexts stands for the group.
3. The suffixes that are left are sorted by their windows, one bucket at a time.

Texts are kept once, as chunks of whole texts in a table bucketed by chunk, so that the answers of a bucket, a byte an entry, meet
them without moving them again. A chunk sends equal digests once, so a bucket holds a passage at most once a chunk, however
often it is repeated; buckets are as many as the samples need at BUCKET entries each. Digests are of 64 bits besides
the bits that choose the bucket (32 for the ranks, where a clash costs only work).

Edge cases: a null text is empty; a text below the window's length is never changed; matches stay within a text; windows
may overlap each other, also in one text; very long texts are digested in stretches; repeated rows are copies of each other; an empty table
gives an empty result. Kept bytes may end within a character, so they are binary.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.storage import shared_folder, stored
from tallyweave.llm.word_hashes import mixed, text_buffers

WINDOW = 400
#: The order of the cover: a prime q gives a period of q * q + q + 1 with q + 1 sampled places.
ORDER = 7
CHUNK_BYTES = 2_000_000
#: Bytes that are digested at once.
STRETCH = 2_000_000
#: Entries of a bucket that one task sorts at once.
BUCKET = 262_144
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CODES = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: States of a sample after its long ties: alone, settled, to be sorted, settled and standing for its group.
ALONE, SETTLED, OPEN, STANDING = range(4)


def difference_cover(q: int) -> tuple[int, list[int]]:
    """Period and places of a perfect difference set, by the powers of a root of a cubic over the integers modulo a prime q."""
    period = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                power, places = (1, 0, 0), []
                for k in range(period):
                    if power[2] == 0:
                        places.append(k)
                    power = c * power[2] % q, (power[0] + b * power[2]) % q, (power[1] + a * power[2]) % q
                if len({(x - y) % period for x in places for y in places}) == period and len(places) == q + 1:
                    return period, places
    raise ValueError(f"{q} is not a prime")


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next stretch."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(n, base)
            table[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"], _POWERS["down"]


def digests(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit digests of data[first:last] for ascending first; long data is read in stretches."""
    found = np.empty(len(first), np.uint64)
    at = 0
    while at < len(first):
        begin = int(first[at])
        upto = max(at + 1, int(np.searchsorted(first, begin + STRETCH)))
        end = int(last[at:upto].max())
        up, down = _powers(2 * STRETCH + 1 if end - begin < 2 * STRETCH else end - begin + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(end - begin + 1, np.uint64)
            np.cumsum(_CODES[data[begin:end]] * up[: end - begin], out=sums[1:])
            a, b = first[at:upto] - begin, last[at:upto] - begin
            found[at:upto] = mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        at = upto
    return found


class Chunk:
    """The texts of a chunk, its sampled places and what is known of them."""

    def __init__(self, packed: bytes, ends: list[int], window: int, order: int):
        self.data = np.frombuffer(zstandard.decompress(packed), np.uint8)
        self.ends = np.array(ends, np.int64)
        self.begins = np.concatenate((np.zeros(1, np.int64), self.ends[:-1]))
        self.window = window
        self.period, places = difference_cover(order)
        # A text that is shorter than the window has no samples.
        self.places = np.array(places, np.int64)

    def samples(self) -> np.ndarray:
        """Sampled positions, ascending, whose sample lies within their text."""
        length = self.window - self.period + 1
        found = [
            (begin + (np.arange(0, end - begin - length + 1, self.period)[:, None] + self.places).ravel())
            for begin, end in zip(self.begins, self.ends) if end - begin >= self.window
        ]
        limits = [end - length for begin, end in zip(self.begins, self.ends) if end - begin >= self.window]
        kept = [places[places <= limit] for places, limit in zip(found, limits)]
        return np.concatenate(kept) if kept else np.zeros(0, np.int64)

    def rank_digests(self) -> tuple[np.ndarray, np.ndarray]:
        places = self.samples()
        return places, digests(self.data, places, places + self.window - self.period + 1)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")

    def contexts(self, places: np.ndarray) -> np.ndarray:
        """Digests of all bytes of the windows that hold a sample at a shift below the period."""
        text = self.text_of(places)
        first = np.maximum(places - self.period + 1, self.begins[text])
        last = np.minimum(places + self.window, self.ends[text])
        found = digests(self.data, first, last)
        with np.errstate(over="ignore"):
            return mixed(found + (places - first).astype(np.uint64) * _BASE)

    def reached(self, places: np.ndarray) -> np.ndarray:
        """A mask of the positions whose windows lie within their text and hold one of places at a shift below the period."""
        mask = np.zeros(len(self.data) + 1, np.int32)
        text = self.text_of(places)
        np.add.at(mask, np.maximum(places - self.period + 1, self.begins[text]), 1)
        np.add.at(mask, places + 1, -1)
        found = np.cumsum(mask)[:-1] > 0
        for begin, end in zip(self.begins, self.ends):
            found[max(begin, end - self.window + 1) : end] = False
        return found


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in ascending order, how often each occurs, and the place of every key among them."""
    unique, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return unique, counts, inverse


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the upper half of a key, so that keys in order are in order of their buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _sent(chunk: int, keys: np.ndarray, tags: np.ndarray, buckets: int, narrow: bool) -> Iterator[pa.RecordBatch]:
    """Entries of a chunk by bucket: keys (ascending) and tags as packed numbers."""
    home = bucket_of(keys, buckets)
    edges = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1]))) if len(home) else np.zeros(0, np.int64)
    limits = np.append(edges, len(home))
    keys = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32) if narrow else keys
    parts = [(int(home[a]), keys[a:b].tobytes(), tags[a:b].tobytes()) for a, b in zip(limits[:-1], limits[1:])]
    if parts:
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(parts), pa.int64()), *(pa.array([p[k] for p in parts], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.binary())))],
            ["chunk", "bucket", "keys", "tags"],
        )


_SENT = "chunk long, bucket long, keys binary, tags binary"


def _answered(answers) -> np.ndarray:
    """The answers of all buckets in order, as one array."""
    return np.frombuffer(b"".join(answers or ()), np.uint8)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _rows_and_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Array]]:
    for batch in batches:
        ids = batch.column("ids")
        yield from zip(_rows([batch.select([n for n in batch.schema.names if n != "ids"])]), (ids[k].values for k in range(len(ids))))


def _ranked(window: int, order: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, keys = Chunk(row["data"], row["ends"], window, order).rank_digests()
            unique, counts, _ = distinct(keys)
            yield from _sent(row["chunk"], unique, (counts > 1).astype(np.uint8), buckets, True)

    return run


def _repeated(chunk: Chunk, ranks) -> tuple[np.ndarray, np.ndarray]:
    """Sampled places of repeated ranks and their digests."""
    places, keys = chunk.rank_digests()
    _, _, inverse = distinct(keys)
    known = _answered(ranks)[inverse] > 0 if len(places) else np.zeros(0, bool)
    return places[known], keys[known]


def _in_context(chunk: Chunk, ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of repeated ranks; their distinct ranks; the context that all places of a rank share (0: several); every place's rank."""
    places, keys = _repeated(chunk, ranks)
    unique, counts, inverse = distinct(keys)
    contexts = chunk.contexts(places) | np.uint64(2)
    least = np.full(len(unique), np.iinfo(np.uint64).max, np.uint64)
    most = np.zeros(len(unique), np.uint64)
    np.minimum.at(least, inverse, contexts)
    np.maximum.at(most, inverse, contexts)
    # The lowest bit tells that a chunk holds a context more than once.
    tags = np.where(least == most, (most & ~np.uint64(1)) | (counts > 1).astype(np.uint64), np.uint64(0))
    return places, unique, tags, inverse


def _compared(window: int, order: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, unique, tags, _ = _in_context(Chunk(row["data"], row["ends"], window, order), row["ranks"])
            yield from _sent(row["chunk"], unique, tags, buckets, True)

    return run


def _unsettled(chunk: Chunk, ranks, ties) -> tuple[np.ndarray, np.ndarray]:
    """A mask of the settled positions, and the positions that are to be sorted."""
    places, _, _, inverse = _in_context(chunk, ranks)
    state = _answered(ties)[inverse] if len(places) else np.zeros(0, np.uint8)
    settled = chunk.reached(places[(state == SETTLED) | (state == STANDING)])
    return settled, np.flatnonzero(chunk.reached(places[(state == OPEN) | (state == STANDING)]))


def _windows(chunk: Chunk, places: np.ndarray) -> np.ndarray:
    return digests(chunk.data, places, places + chunk.window)


def _sorted(window: int, order: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row["data"], row["ends"], window, order)
            settled, places = _unsettled(chunk, row["ranks"], row["ties"])
            unique, _, inverse = distinct(_windows(chunk, places))
            # A window that the chunk holds twice, or that is settled, is known to be repeated; others ask.
            known = np.bincount(inverse, minlength=len(unique)) + np.bincount(inverse, settled[places], len(unique)) > 1
            yield from _sent(row["chunk"], unique, known.astype(np.uint8), buckets, False)

    return run


def _removed(window: int, order: int, buckets: int, key: str) -> Callable:
    """(key, n_bytes, n_removed, n_spans, kept) by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids in _rows_and_ids(batches):
            chunk = Chunk(row["data"], row["ends"], window, order)
            repeated, places = _unsettled(chunk, row["ranks"], row["ties"])
            _, _, inverse = distinct(_windows(chunk, places))
            if len(places):
                repeated[places[_answered(row["windows"])[inverse] > 0]] = True
            edge = np.zeros(len(chunk.data) + 1, np.int32)
            starts = np.flatnonzero(repeated)
            edge[starts] += 1
            edge[starts + window] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            out = []
            for begin, end in zip(chunk.begins, chunk.ends):
                part = gone[begin:end]
                spans = int(part[:1].sum()) + int((part[1:] & ~part[:-1]).sum())
                out.append((end - begin, int(part.sum()), spans, chunk.data[begin:end][~part].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary())))],
                [key, "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def _repeats(keys: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """1 for a key that is known to be repeated or that several chunks hold."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    known = np.bincount(inverse, tags, len(counts)) > 0
    return ((counts > 1) | known)[inverse].astype(np.uint8)


def _ties(keys: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """What becomes of each rank of a chunk, from its context (0: several contexts; odd: more than one place)."""
    context, several = tags & ~np.uint64(1), (tags & np.uint64(1)) > 0
    pair = np.lexsort((context, keys))
    k, c = keys[pair], context[pair]
    new_rank = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.zeros(0, bool)
    new_pair = new_rank | np.concatenate(([True], c[1:] != c[:-1])) if len(k) else new_rank
    rank, group = np.cumsum(new_rank) - 1, np.cumsum(new_pair) - 1
    groups = np.bincount(rank, new_pair, rank[-1] + 1 if len(k) else 0)
    members = np.bincount(group, 1 + several[pair])
    open_rank = (groups[rank] > 1) | (c == 0)
    state = np.where(members[group] > 1, np.where(open_rank, np.where(new_pair, STANDING, SETTLED), SETTLED), np.where(open_rank, OPEN, ALONE))
    # Several contexts in one chunk: all its places are sorted.
    state[c == 0] = OPEN
    answer = np.empty(len(keys), np.uint8)
    answer[pair] = state
    return answer


def _judged(judge: Callable, keys_as: type, tags_as: type) -> Callable:
    """Sort one bucket and answer every chunk that has sent entries to it."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k.as_buffer(), keys_as) for k in table.column("keys")]
        tags = [np.frombuffer(t.as_buffer(), tags_as) for t in table.column("tags")]
        found = judge(np.concatenate(keys), np.concatenate(tags))
        parts = np.split(found, np.cumsum([len(k) for k in keys])[:-1])
        answers = pa.array([p.tobytes() for p in parts], pa.binary())
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "answer": answers})

    return run


def _answers(sent: DataFrame, judge: Callable, name: str) -> DataFrame:
    """(chunk, name): the answers of all buckets that a chunk has sent entries to, in order of bucket."""
    judged = sent.groupBy("bucket").applyInArrow(judge, "chunk long, bucket long, answer binary")
    in_order = f"array_sort(collect_list(struct(bucket, answer))).answer AS {name}"
    return stored(judged.groupBy("chunk").agg(F.expr(in_order)))


def _packed(key: str, size: int) -> Callable:
    """Whole texts, about size bytes together, as one compressed value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, starts = text_buffers(batch.column("__text"))
            first = 0
            while first < batch.num_rows:
                last = min(batch.num_rows, max(first + 1, int(np.searchsorted(starts, starts[first] + size, "right")) - 1))
                ids = batch.column(key)[first:last]
                ends = starts[first + 1 : last + 1] - starts[first]
                text = press.compress(data[starts[first] : starts[last]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([ends.tolist()], pa.list_(pa.int64())), _listed(ids), pa.array([text], pa.binary())],
                    ["chunk", "ends", "ids", "data"],
                )
                number += 1
                first = last

    return run


def _listed(ids: pa.Array) -> pa.Array:
    """One list that holds all ids."""
    return pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)


def repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, order: int = ORDER, chunk: int = CHUNK_BYTES) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) for every row of docs; kept is what is left of the text's UTF-8 bytes."""
    spark = docs.sparkSession
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("ids", T.ArrayType(docs.schema[key].dataType)), T.StructField("data", T.BinaryType()),
    ])
    chunks = docs.select(F.col(f"`{key}`").alias(key), F.col("text").alias("__text")).mapInArrow(_packed(key, chunk), schema)
    name = f"chunks_{uuid.uuid4().hex}"
    writer = chunks.repartition(dealt, "chunk").write.bucketBy(dealt, "chunk").sortBy("chunk")
    writer.option("path", f"{shared_folder(docs)}/{name}").option("compression", "none").saveAsTable(name)
    texts = spark.table(name)
    size = texts.agg(F.expr("coalesce(sum(element_at(ends, -1)), 0L)")).first()[0]
    period, places = difference_cover(order)
    buckets = max(dealt, size * len(places) // period // BUCKET)
    settings = window, order, buckets
    whole = texts.select("chunk", "ends", "data")
    ranks = _answers(whole.mapInArrow(_ranked(*settings), _SENT), _judged(_repeats, np.uint32, np.uint8), "ranks")
    known = whole.join(ranks, "chunk", "left")
    ties = _answers(known.mapInArrow(_compared(*settings), _SENT), _judged(_ties, np.uint32, np.uint64), "ties")
    known = known.join(ties, "chunk", "left")
    windows = _answers(known.mapInArrow(_sorted(*settings), _SENT), _judged(_repeats, np.uint64, np.uint8), "windows")
    known = texts.join(ranks, "chunk", "left").join(ties, "chunk", "left").join(windows, "chunk", "left")
    left = T.StructType([
        docs.select(key).schema[0], *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType()),
    ])
    return known.mapInArrow(_removed(*settings, key), left)
