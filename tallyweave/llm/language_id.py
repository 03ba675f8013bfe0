"""Language identification by prediction by partial matching (PPM) over bytes.

A language's model is the byte context tree of order ORDER learnt from a sample of its labelled
texts. A byte costs -log2 of its probability in the longest context seen; a byte that is new in
a context pays the escape (method C: escape weight = number of distinct followers) and is coded
one order lower, down to 1/256 for any byte. Statistics stay frozen while scoring, so the code
length of a text is a plain sum over its bytes and the language with the shortest code wins.

For scoring the trees are unfolded into one table: a row for each context, and in it the cost of
each next byte in every language. A dense index finds the longest known context of the ORDER
bytes before a byte. Bytes that no sample holds behave alike everywhere and share a column.

Edge cases: a text that is null or holds no letter is `und` with score 0, and so is every text
when nothing labelled is there to learn from; ties go to the smaller language name; repeated
rows are scored one by one; columns named like a result are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.word_hashes import CHUNK_BYTES, LOWER, STEP_BYTES, chunks, text_buffers

ORDER = 3
#: A language of so many rows is learnt from as many at least, however long they are.
FEW = 8
#: Expected bytes of whole texts that a language's model is learnt from: the bound of the sample.
SAMPLE_BYTES = 1_000_000
#: Longer contexts than the empty one are kept if the sample holds them this often.
LEAST_COUNT = 3
UNDETERMINED = "und"
_PAD = 10  # what stands before the first byte
RESULTS = ("lang_pred", "score")

HELD_OUT = "coalesce(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, false)"


def training_rows(docs: DataFrame) -> DataFrame:
    """Labelled documents whose crc32(doc_id as text) mod 5 is not 0."""
    return docs.where(f"lang IS NOT NULL AND text IS NOT NULL AND NOT {HELD_OUT}")


def bounded_sample(rows: DataFrame, sample_bytes: int) -> DataFrame:
    """Whole texts, about sample_bytes a language, each drawn by a hash with the same chance; the first FEW by hash always."""
    able = rows.where("text <> ''")
    sizes = able.groupBy("lang").agg(F.sum(F.expr("octet_length(text)")).alias("total"), F.count("*").alias("n")).collect()
    shares = {r["lang"]: min(1.0, sample_bytes / r["total"]) for r in sizes}
    if not shares:
        return rows.where("false").select("lang", "text")

    def at(chances: dict):
        return F.create_map(*[F.lit(x) for pair in chances.items() for x in pair])[F.col("lang")]

    place = F.expr("pmod(xxhash64(doc_id, text), 1000003) / 1000003D")
    # Where few rows are to be expected, the first ones are sought among some more.
    rare = {r["lang"]: min(1.0, 16 * FEW / r["n"]) for r in sizes if shares[r["lang"]] < 1 and shares[r["lang"]] * r["n"] < 8 * FEW}
    if rare:
        first: dict = {lang: [] for lang in rare}
        for r in able.select("lang", place.alias("place")).where(F.col("place") < at(rare)).collect():
            first[r["lang"]].append(r["place"])
        for lang, places in first.items():
            shares[lang] = max(shares[lang], *(p + 1e-7 for p in sorted(places)[:FEW]))
    return able.where(place < at(shares)).select("lang", "text")


def _mask(n_bytes: int) -> np.uint32:
    return np.uint32((1 << 8 * n_bytes) - 1)


def _run_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of runs of ORDER + 1 bytes by language, a run as one number with its first byte highest."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        data, starts = text_buffers(batch.column(1))
        for lang in sorted(set(langs)):
            keys = []
            for i in np.flatnonzero(langs == lang):
                wide = np.concatenate((np.full(ORDER, _PAD, np.uint8), LOWER[data[starts[i] : starts[i + 1]]])).astype(np.uint32)
                run = np.zeros(len(wide) - ORDER, np.uint32)
                for k in range(ORDER + 1):
                    run = (run << np.uint32(8)) | wide[k : k + len(run)]
                keys.append(run)
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(key), "run": key.astype(np.int64), "n": n.astype(np.int64)})


def learnt(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """The model of the labelled documents; run counts of the bounded sample are summed on the executors."""
    runs = bounded_sample(training_rows(docs), sample_bytes).mapInArrow(_run_counts, "lang string, run long, n long")
    counts = runs.groupBy("lang", "run").agg(F.sum("n").alias("n")).toPandas()
    return Model(counts["lang"].to_numpy(object), counts["run"].to_numpy(np.uint32), counts["n"].to_numpy(float))


class Model:
    """Frozen statistics of all languages, unfolded for scoring; bounded as the sample is."""

    def __init__(self, langs: np.ndarray, runs: np.ndarray, n: np.ndarray):
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        alphabet = np.unique(np.concatenate([(runs >> np.uint32(8 * k)) & _mask(1) for k in range(ORDER + 1)]))
        self.width = len(alphabet) + 1
        self.place = np.full(256, len(alphabet), np.int32)
        self.place[alphabet] = np.arange(len(alphabet))
        index = np.zeros((self.width,) * ORDER, np.int32)
        tables, contexts, below, base = [], None, np.full((len(self.langs), 1, self.width), 1 / 256), 0
        for order in range(ORDER + 1):
            seen, inverse = np.unique((runs >> np.uint32(8)) & _mask(order), return_inverse=True)
            kept = np.bincount(inverse, n) >= (LEAST_COUNT if order else 0) if len(runs) else np.zeros(0, bool)
            own = seen[kept]
            row = np.where(kept, np.cumsum(kept) - 1, -1)[inverse] if len(runs) else np.zeros(0, int)
            parents = np.searchsorted(contexts, own & _mask(order - 1)) if order else np.zeros(len(own), int)
            table = np.empty((len(self.langs), len(own), self.width))
            for k, lang in enumerate(self.langs):
                mine = (langs == lang) & (row >= 0)
                cell = row[mine] * self.width + self.place[runs[mine] & _mask(1)]
                counts = np.bincount(cell, n[mine], len(own) * self.width).reshape(len(own), self.width)
                total, distinct = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
                weight = np.maximum(total + distinct, 1)
                escape = np.where(total > 0, distinct / weight, 1.0)
                table[k] = np.where(counts > 0, counts / weight, escape * below[k][parents])
            before = [self.place[(own >> np.uint32(8 * k)) & _mask(1)] for k in reversed(range(order))]
            index[(Ellipsis, *before)] = base + np.arange(len(own), dtype=np.int32)
            tables.append(-np.log2(table).astype(np.float32).transpose(1, 2, 0))
            contexts, below, base = own, table, base + len(own)
        self.index = index.reshape(-1)
        self.costs = np.ascontiguousarray(np.concatenate(tables)).reshape(-1, max(1, len(self.langs)))

    def _spelled(self, data: np.ndarray, starts: np.ndarray, skip: int = 0) -> np.ndarray:
        """Bits by language of each text in a run of bytes; starts are the texts' first bytes, skip the leading bytes that are context only."""
        places = self.place[LOWER[data]]
        cell = np.zeros(len(places), np.int32)
        for back in range(ORDER, 0, -1):
            previous = np.empty_like(places)
            previous[back:] = places[:-back] if back < len(places) else places[:0]
            previous[:back] = self.place[_PAD]
            for k in range(back if not skip else 0):
                at = starts + k
                previous[at[at < len(places)]] = self.place[_PAD]
            cell = cell * self.width + previous
        bits = self.costs[self.index[cell] * self.width + places][skip:]
        ends = np.concatenate((starts[1:], [len(data)]))
        if skip:
            return bits.sum(0, dtype=np.float64, keepdims=True)
        sums = np.zeros((len(starts), len(self.langs)))
        full = np.flatnonzero(ends > starts)
        if len(full):
            sums[full] = np.add.reduceat(bits, starts[full], axis=0, dtype=np.float64)
        return sums

    def code_lengths(self, column: pa.Array) -> np.ndarray:
        """Bits that each text takes in each language."""
        data, starts = text_buffers(column)
        out = np.zeros((len(column), len(self.langs)))
        for first, last in chunks(starts, STEP_BYTES):
            begin, end = starts[first], starts[last]
            if last - first > 1 or end - begin <= 2 * CHUNK_BYTES:
                out[first:last] = self._spelled(data[begin:end], starts[first:last] - begin)
                continue
            for at in range(begin, end, CHUNK_BYTES):  # one long text, piece by piece
                skip = ORDER if at > begin else 0
                piece = data[at - skip : min(at + CHUNK_BYTES, end)]
                out[first] += self._spelled(piece, np.zeros(1, np.int64), skip)[0]
        return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score, the winner's share when code lengths are read as probabilities."""
    spark = docs.sparkSession
    kept = docs.drop(*RESULTS)
    columns = kept.columns
    if not model.langs:
        return kept.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = spark.sparkContext.broadcast(model)
    letters = kept.withColumn("__letters", F.expr(r"coalesce(text RLIKE '\\p{L}', false)"))
    schema = T.StructType([*kept.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return letters.mapInArrow(_scorer(shared, columns), schema)


def predictions(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Like identify, for keep, lang_pred and score only: texts do not leave the workers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.expr(r"coalesce(text RLIKE '\\p{L}', false)").alias("__letters"), F.col("text").alias("__text"))
    if not model.langs:
        return rows.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    kept = docs.select(*keep).schema
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_scorer(shared, keep, "__text"), schema)


def _scorer(shared, columns: list[str], text: str = "text") -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            bits = model.code_lengths(batch.column(text))
            best = bits.argmin(1)
            share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
            known = batch.column("__letters").to_numpy(zero_copy_only=False)
            names = np.where(known, np.array(model.langs, object)[best], UNDETERMINED)
            out = [batch.column(c) for c in columns]
            out += [pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0))]
            yield pa.RecordBatch.from_arrays(out, [*columns, *RESULTS])

    return score
