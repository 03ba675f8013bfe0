"""Best-fit packing of tokenized documents by a grouping genetic algorithm on islands.

Documents are tokenized once, on the executors; only piece lengths go on. Pieces as long as a
sequence are one each. The others are dealt to groups of GROUP pieces, and ISLANDS islands evolve
packings of each group. A packing is a set of bins: crossover injects the best-filled bins of one
parent into the other, removes the bins that hold the same pieces, and best-fits what these
displaced; mutation empties the worst-filled bins and best-fits their pieces. After each era the
best packing of every island moves on to the next island of its group, and after the last the
best of all is taken. Bins that a group could not fill well are opened again and their pieces
are packed once more in new groups, so that a group's leftovers meet those of others.

Words repeat far more often than they differ: the words of a slice of texts are hashed, each distinct word is looked
up once among those that a worker remembers, and the ids of the slice are gathered in one step. Slices and memory are
bounded in bytes, so neither large batches nor long texts add to them (a single text is read whole). Edge cases: null and empty texts are a piece of the closing id 0 alone; documents longer than a
sequence are cut; repeated rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import json
import random
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.storage import stored
from tallyweave.llm.word_hashes import chunks, text_buffers, words_in

SEQUENCE = 2048
GROUP = 2048
ISLANDS = 2
ERAS = 2
POPULATION = 4
GENERATIONS = 5
#: Bins filled less than this are opened again after the first packing.
WELL_FILLED = 0.995
#: Words that a worker remembers the ids of, about 40 bytes each, and parts of words, about 250 bytes each: bounds of
#: memory, without effect on results.
REMEMBERED, REMEMBERED_PIECES = 2_000_000, 150_000

#: Fixed pattern of the vocabulary's pieces, for words of the characters below U+0100; words stand one a line.
PIECE = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\\sa-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+")
#: Words that the tokenizer itself must read: characters from U+0100, controls, other spaces, special tokens.
UNUSUAL = re.compile("[^\n\x21-\x7e\xa1-\xff]|<\\|")


#: The vocabulary's own settings that the patterns above restate. Any other vocabulary file reads whole texts by itself.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class Words:
    """Ids of white-space separated words, by hash; a word's ids do not depend on its neighbours."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        normalizers = [n["type"] for n in (settings["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (settings["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_word = normalizers == NORMALIZERS and splits[:1] == [SPLIT] and settings["model"]["type"] == "BPE"
        self.model = self.tokenizer.model
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(printed)]
        self.shown = {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.forget()

    def forget(self) -> None:
        """Known words: their hashes in order, where the ids of each begin, and how many they are."""
        self.hashes, self.first, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.pieces = array("I"), {}

    def piece(self, piece: str) -> list[int]:
        shown = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.shown)
        return list(map(_ID, self.model.tokenize(shown)))

    def ids(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        joined = b"\n".join(words).decode("utf-8")
        if UNUSUAL.search(joined):
            return self.mixed(words)
        found, current, pieces = [], [], self.pieces
        if len(pieces) > REMEMBERED_PIECES:
            pieces.clear()
        for piece in PIECE.findall(joined.lower()):
            if piece == "\n":
                found.append(current)
                current = []
                continue
            ids = pieces.get(piece)
            if ids is None:
                ids = pieces[piece] = self.piece(piece)
            current += ids
        return [*found, current]

    def mixed(self, words: list[bytes]) -> list[list[int]]:
        """The ids of words some of which the tokenizer itself must read."""
        texts = [word.decode("utf-8") for word in words]
        odd = [UNUSUAL.search(text) is not None for text in texts]
        plain = iter(self.ids([word for word, is_odd in zip(words, odd) if not is_odd]) if not all(odd) else ())
        return [self.tokenizer.encode(text, add_special_tokens=False).ids if is_odd else next(plain) for text, is_odd in zip(texts, odd)]

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Remember the ids of words whose hashes, in ascending order, are not known yet."""
        if len(self.hashes) > REMEMBERED:
            self.forget()
        counts = []
        begin = len(self.pool)
        for k in range(0, len(words), 500):
            for ids in self.ids(words[k : k + 500]):
                self.pool.extend(ids)
                counts.append(len(ids))
        counts = np.array(counts, np.int32)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.first = np.insert(self.first, at, begin + np.cumsum(counts) - counts)
        self.counts = np.insert(self.counts, at, counts)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        return self.hashes[at] != hashes if len(self.hashes) else np.ones(len(hashes), bool)

    def texts(self, part: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each text of part, with the closing 0."""
        if not self.by_word:
            for a, b in zip(bounds[:-1], bounds[1:]):
                yield np.array([*self.tokenizer.encode(part[a:b].tobytes().decode("utf-8"), add_special_tokens=False).ids, 0], "<u4")
            return
        hashes, begins, ends = words_in(part, bounds)
        unique, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = self.missing(unique)
        if new.any():
            raw = part.tobytes()
            self.learn(unique[new], [raw[a:b] for a, b in zip(begins[sample[new]].tolist(), ends[sample[new]].tolist())])
            # All are known now, unless the memory was full and has been emptied.
            again = self.missing(unique)
            if again.any():
                self.learn(unique[again], [raw[a:b] for a, b in zip(begins[sample[again]].tolist(), ends[sample[again]].tolist())])
        places = np.searchsorted(self.hashes, unique)[inverse]
        counts = self.counts[places]
        upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
        pool = np.frombuffer(self.pool, "<u4") if len(self.pool) else np.zeros(0, "<u4")
        ids = pool[np.repeat(self.first[places] - upto[:-1], counts) + np.arange(upto[-1])]
        # The pool cannot grow while it is looked at.
        del pool
        edges = upto[np.searchsorted(begins, bounds)]
        for a, b in zip(edges[:-1], edges[1:]):
            yield np.append(ids[a:b], np.uint32(0)).astype("<u4", copy=False)


_ID = attrgetter("id")
_WORDS: dict[str, Words] = {}


def ids_of(text: bytes, words: Words) -> np.ndarray:
    """The ids of a text and the closing 0."""
    return next(words.texts(np.frombuffer(text, np.uint8), np.array([0, len(text)])))


def _cut(path: str, sequence: int, columns: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORDS:
            _WORDS[path] = Words(path)
        for batch in batches:
            data, starts = text_buffers(batch.column("__text"))
            for begin, end in chunks(starts):
                rows, piece, start, length, crc = [], [], [], [], []
                local = starts[begin : end + 1] - starts[begin]
                for k, ids in enumerate(_WORDS[path].texts(data[starts[begin] : starts[end]], local), begin):
                    for number, at in enumerate(range(0, len(ids), sequence)):
                        part = ids[at : at + sequence]
                        rows.append(k)
                        piece.append(number)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                at = pa.array(rows, pa.int64())
                numbers = [pa.array(x, pa.int64()) for x in (piece, start, length, crc)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in columns), *numbers], [*columns, *PIECE_COLUMNS])

    return run


PIECE_COLUMNS = ("piece", "start", "length", "ids_crc32")


def pieces(docs: DataFrame, tokenizer: str, keep: list[str], sequence: int = SEQUENCE) -> DataFrame:
    """keep and piece, start, length, ids_crc32: one row for each piece of each document."""
    schema = T.StructType([*docs.select(*keep).schema, *[T.StructField(c, T.LongType()) for c in PIECE_COLUMNS]])
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(_cut(tokenizer, sequence, keep), schema)


class Bins:
    """A packing under construction: room left by bin, and the open bins in order of room."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.held: list[list[int]] = []
        self.order: list[tuple[int, int]] = []

    def add(self, items: list[int]) -> None:
        """A bin as it is."""
        room = self.capacity - sum(self.sizes[i] for i in items)
        self.held.append(list(items))
        if room:
            bisect.insort(self.order, (room, len(self.held) - 1))

    def fit(self, item: int) -> None:
        """Into the bin with the least room that is enough, or a new one."""
        size = self.sizes[item]
        at = bisect.bisect_left(self.order, (size, -1))
        if at == len(self.order):
            self.add([item])
            return
        room, which = self.order.pop(at)
        self.held[which].append(item)
        if room > size:
            bisect.insort(self.order, (room - size, which))


def best_fit(sizes: list[int], capacity: int, items: list[int], bins: list[list[int]] = ()) -> list[list[int]]:
    packing = Bins(sizes, capacity)
    for held in bins:
        packing.add(held)
    for item in items:
        packing.fit(item)
    return packing.held


def fitness(packing: list[list[int]], sizes: list[int], capacity: int) -> tuple:
    """Fewer bins first, then fuller ones: the sum of squared fills."""
    return -len(packing), sum((sum(sizes[i] for i in held) / capacity) ** 2 for held in packing)


def crossed(one: list[list[int]], two: list[list[int]], sizes: list[int], capacity: int, draw: random.Random) -> list[list[int]]:
    """Well-filled bins of one go into two as they are; two's bins with the same pieces go, the rest is best-fitted."""
    ranked = sorted(one, key=lambda held: (-sum(sizes[i] for i in held), min(held)))
    injected = ranked[: max(1, int(len(ranked) * draw.uniform(0.3, 0.7)))]
    inside = {i for held in injected for i in held}
    spared, displaced = [], []
    for held in two:
        if inside.isdisjoint(held):
            spared.append(held)
        else:
            displaced += [i for i in held if i not in inside]
    displaced.sort(key=lambda i: (-sizes[i], i))
    return best_fit(sizes, capacity, displaced, injected + spared)


def mutated(packing: list[list[int]], sizes: list[int], capacity: int, draw: random.Random) -> list[list[int]]:
    """The worst-filled bins and a few others are emptied and their pieces best-fitted."""
    ranked = sorted(packing, key=lambda held: (sum(sizes[i] for i in held), min(held)))
    few = max(2, len(ranked) // 20)
    emptied = ranked[:few] + draw.sample(ranked[few:], min(few, len(ranked) - few))
    gone = {id(held) for held in emptied}
    items = sorted((i for held in emptied for i in held), key=lambda i: (-sizes[i], i))
    return best_fit(sizes, capacity, items, [held for held in packing if id(held) not in gone])


def evolved(sizes: list[int], capacity: int, seed: int, elite: list[list[list[int]]], generations: int = GENERATIONS) -> list[list[int]]:
    """The best packing after some generations, from elites of earlier eras or from noisy best-fit decreasing."""
    draw = random.Random(seed)
    everything = list(range(len(sizes)))
    people = list(elite)
    while len(people) < POPULATION:
        noise = 0.0 if not people and not seed % ISLANDS else 0.15
        order = sorted(everything, key=lambda i: (-sizes[i] * (1 + noise * draw.random()), i))
        people.append(best_fit(sizes, capacity, order))
    least = -(-sum(sizes) // capacity)
    ranked = sorted(((fitness(p, sizes, capacity), k, p) for k, p in enumerate(people)), reverse=True)
    for generation in range(generations):
        if len(ranked[0][2]) == least:
            break
        one, two = ranked[0][2], ranked[1 + draw.randrange(len(ranked) - 1)][2]
        if draw.random() < 0.5:
            one, two = two, one
        child = mutated(crossed(one, two, sizes, capacity, draw), sizes, capacity, draw)
        ranked = sorted([*ranked[:-1], (fitness(child, sizes, capacity), POPULATION + generation, child)], reverse=True)
    return ranked[0][2]


def _placed(packing: list[list[int]], n: int) -> np.ndarray:
    bins = np.zeros(n, np.int64)
    for number, held in enumerate(packing):
        bins[held] = number
    return bins


def _packing(bins: np.ndarray) -> list[list[int]]:
    held: dict[int, list[int]] = {}
    for item, number in enumerate(bins):
        held.setdefault(int(number), []).append(item)
    return list(held.values())


def _era(era: int, capacity: int) -> Callable:
    """Evolve one island; its own elite is in column own, the one that has moved in from the island before in column moved."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", ignore_index=True)
        sizes = rows["length"].tolist()
        elite = [_packing(rows[c].to_numpy()) for c in ("own", "moved") if era]
        best = evolved(sizes, capacity, 1000 * era + int(key[1]), elite)
        count, filled = fitness(best, sizes, capacity)
        return pd.DataFrame({
            "grp": key[0], "island": key[1], "id": rows["id"], "length": rows["length"],
            "bin": _placed(best, len(rows)), "bins": -count, "filled": filled,
        })

    return run


_EVOLVED = "grp long, island int, id long, length long, bin long, bins long, filled double"


def packed_groups(items: DataFrame, capacity: int) -> DataFrame:
    """(id, length, grp, bin) from (id, length, grp): the best packing that the islands of each group find."""
    isles = items.selectExpr("grp", "id", "length", f"explode(sequence(0, {ISLANDS - 1})) AS island", "0L AS own", "0L AS moved")
    for era in range(ERAS):
        found = stored(isles.groupBy("grp", "island").applyInPandas(_era(era, capacity), _EVOLVED))
        if era == ERAS - 1:
            break
        moved = found.selectExpr("grp", f"(island + 1) % {ISLANDS} AS island", "id", "bin AS moved")
        isles = found.selectExpr("grp", "island", "id", "length", "bin AS own").join(moved, ["grp", "island", "id"])
    best = found.groupBy("grp").agg(F.min(F.struct("bins", F.expr("-filled AS worst"), "island")).alias("best"))
    chosen = best.selectExpr("grp", "best.island AS island")
    return found.join(chosen, ["grp", "island"]).select("id", "length", "grp", "bin")


def _grouped(items: DataFrame, group: int) -> DataFrame:
    """Deal (id, length) evenly to groups of about group rows, each a run of a stored partition."""
    spark = items.sparkSession
    n = items.count()
    groups = max(1, round(n / group))
    partitions = min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups // 64))
    run = -(-n // partitions) // max(1, round(groups / partitions)) + 1
    dealt = stored(items.repartition(partitions))
    return stored(dealt.withColumn("grp", F.expr(f"monotonically_increasing_id() div {run}L")))


def packed(parts: DataFrame, capacity: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """parts (with a column length) and sequence_id, offset."""
    rows = stored(parts.withColumn("__id", F.monotonically_increasing_id()))
    items = rows.where(f"length < {capacity}").selectExpr("__id AS id", "length")
    first = stored(packed_groups(_grouped(items, group), capacity))
    fills = first.groupBy("grp", "bin").agg(F.sum("length").alias("fill"))
    first = stored(first.join(fills, ["grp", "bin"]))
    done = first.where(f"fill >= {WELL_FILLED * capacity!r}").selectExpr("id", "length", "'a' AS round", "grp", "bin")
    again = first.where(f"fill < {WELL_FILLED * capacity!r}").select("id", "length")
    second = packed_groups(_grouped(stored(again), group), capacity)
    places = done.union(second.selectExpr("id", "length", "'b' AS round", "grp", "bin"))
    ahead = "coalesce(sum(length) OVER (PARTITION BY round, grp, bin ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    # An id tells partition and row; a sequence is named after its first piece.
    name = "min(id) OVER (PARTITION BY round, grp, bin)"
    placed = places.selectExpr("id AS __id", f"{name} AS sequence_id", f"{ahead} AS offset")
    whole = rows.where(f"length >= {capacity}").selectExpr("*", "__id AS sequence_id", "0L AS offset")
    return rows.join(placed, "__id").select(*whole.columns).union(whole).drop("__id")
