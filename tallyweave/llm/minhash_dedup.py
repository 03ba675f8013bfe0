"""Near-duplicate documents by bottom-k sketches from one hash function.

Every document is the set of its distinct shingles, hashed once. Documents with equal sets are one
class and go on as one. A class's sketch is its SKETCH smallest hashes. Inverted lists of the
retained values that several classes hold generate candidate pairs, without writing out all pairs
of a list: every member meets the list's leader, which is the member whose values are the most
widespread, and its predecessor when the list is sorted by the values that follow in the sketches.
Long lists are cut by those following values. Rounds are run: pairs with the most similar leader, then pairs with other
leaders and of list neighbours that are not linked yet, then pairs of different components that
stand within REACH places of each other in several lists. The sketch of the union, which both
sketches give, estimates the similarity and drops pairs that are far from it, as the sizes of the sets do; what is left
is confirmed on the full sets of the whole texts. Components come from the confirmed links.

These rounds join what is easily joined; a last one finds every link that is left between
components. It takes the documents that share enough retained values with other components for the estimate to
pass, orders their full sets by one order of all shingles, rare ones first, and lets documents meet
in the first shingle that they have in common, as far as what follows it can still reach the similarity (a
positional prefix filter). The order decides the work only, so it comes from a sample.

The estimate drops a true link with a probability below 1e-6 (see LEAST_SHARED), and nothing else does.

Edge cases: null texts and texts without words have empty sets, which link with nothing; a text with
fewer words than a shingle is one shingle; copies, in any number, form one class by a
pre-aggregated grouping; rows with a null doc_id keep their counts but are in no component;
a doc_id that repeats with several texts
is linked by one of them, always the same; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.components import components
from tallyweave.llm.storage import stored
from tallyweave.llm.word_hashes import shingle_sets

SKETCH = 32
#: Share of a full union sketch that both must hold to go on; for a similarity of 0.8 and 32 values fewer are seen less than once in 10 ** 6.
LEAST_SHARED = 0.375
#: Lists longer than this are cut by the next retained value, and ones longer than LONG by the next two.
LIST, LONG = 256, 4096
#: In the last round members up to REACH places apart in MEETINGS lists are a candidate pair.
REACH, MEETINGS = 8, 2
#: In the exact round a shingle's documents meet in blocks of about BLOCK by BLOCK.
BLOCK = 1024
#: Documents that the order of shingles is counted on, and shingles that it ranks as common.
ORDER_DOCS, COMMON = 32_768, 65_536
#: Rows of (rep, digest) that are sent to every executor, 16 bytes each; more are joined by a shuffle.
SMALL_ROWS = 200_000
#: Rows that make a part: of ids and hashes, about 50 bytes each, and of sketches, about 250 bytes each.
PART_ROWS, PART_SKETCHES = 250_000, 20_000


def _narrow(df: DataFrame, rows: int, part_rows: int = PART_ROWS) -> DataFrame:
    """df, which holds about so many rows at most, in no more parts than these fill.

    With the session's number of partitions, the files of a short table, three a map task and two a stored
    part, outweigh its rows. Parts are only merged, so a long table keeps the session's number.
    """
    return df.coalesce(1 + rows // part_rows)


def _sketched(words: int, sketch: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, sketches = [], [], []
            for found in shingle_sets(batch.column(1), words):
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sketches.append(found[:sketch].copy().view(np.int64))  # a mere view would keep all hashes
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "digest": batch.column(2), "n_shingles": pa.array(sizes, pa.int64()), "class": pa.array(keys, pa.binary()),
                "sketch": pa.array(sketches, pa.list_(pa.int64())),
            })

    return run


def _near(share: float) -> Callable:
    """(a, b, score) of pairs whose union sketch holds at least this share of common values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for a, b in zip(batch.column("sketch_a").to_numpy(zero_copy_only=False), batch.column("sketch_b").to_numpy(zero_copy_only=False)):
                a, b = a.view(np.uint32), b.view(np.uint32)
                union = np.union1d(a, b)[:SKETCH]
                both = np.intersect1d(a, b)
                scores.append(np.isin(union, both, assume_unique=True).sum() / max(1, len(union)))
            scores = np.array(scores, np.float64)
            kept = batch.select(["a", "b"]).append_column("score", pa.array(scores))
            yield kept.filter(pa.array(scores >= share))

    return run


def _confirmed(words: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(shingle_sets(batch.column("text_a"), words), shingle_sets(batch.column("text_b"), words)):
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            yield batch.filter(pa.array(linked, pa.bool_())).select(["a", "b"])

    return run


def _shingles(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in shingle_sets(batch.column(0), words):
                yield pa.RecordBatch.from_pydict({"value": pa.array(found.view(np.int64))})

    return run


def _prefixes(words: int, percent: int, shared) -> Callable:
    """(rep, component, n, prefix): the first shingles of a set by the common order, one of which any similar set holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often = shared.value
        for batch in batches:
            sizes, prefixes = [], []
            for found in shingle_sets(batch.column(2), words):
                place = np.searchsorted(common, found)
                weight = np.where(common[place] == found, often[place], 0)
                least = -(-percent * len(found) // 100)
                sizes.append(len(found))
                prefixes.append(found[np.argsort(weight, kind="stable")][: len(found) - least + 1].copy().view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "rep": batch.column(0), "component": batch.column(1), "n": pa.array(sizes, pa.int64()), "prefix": pa.array(prefixes, pa.list_(pa.int64())),
            })

    return run


def _with_both(pairs: DataFrame, facts: DataFrame, *values: str) -> DataFrame:
    """pairs with the values of a and of b, from facts (rep, values)."""
    a, b = (facts.selectExpr(f"rep AS {side}", *(f"{value} AS {value}_{side}" for value in values)) for side in "ab")
    return pairs.join(a, "a").join(b, "b")


def _apart(pairs: DataFrame, found: DataFrame, rows: int) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    named = pairs
    for side in "ab":
        named = named.join(found.selectExpr(f"node AS {side}", f"component AS c{side}"), side, "left")
    return stored(_narrow(named.where("coalesce(ca, a) <> coalesce(cb, b)").select(*pairs.columns), rows))


def _able(first: str, second: str, percent: int) -> str:
    """Whether sets of these sizes can be so similar."""
    return f"100 * least({first}, {second}) >= {percent} * greatest({first}, {second})"


def _postings(classes: DataFrame, rows: int) -> DataFrame:
    """(value, rep, n, size, one, two, spread): retained values that several classes hold, with the next two values.

    n is the size of the rep's set, size the length of the value's list and spread the sum of the sizes over the rep's values.
    """
    each = classes.selectExpr("rep", "n_shingles AS n", "sketch", "posexplode(sketch) AS (at, value)").selectExpr(
        "value", "rep", "n", "coalesce(get(sketch, at + 1), 0L) AS one", "coalesce(get(sketch, at + 2), 0L) AS two"
    )
    sizes = stored(_narrow(each.groupBy("value").agg(F.count("*").alias("size")).where("size > 1"), rows))
    shared = stored(_narrow(each.join(sizes, "value"), rows))
    spread = stored(_narrow(shared.groupBy("rep").agg(F.sum("size").alias("spread")), rows))
    return stored(_narrow(shared.join(spread, "rep"), rows))


def _leader_pairs(postings: DataFrame, rows: int, percent: int) -> DataFrame:
    best = postings.groupBy("value").agg(F.max(F.struct("spread", F.expr("-rep AS turned"), "n")).alias("best"))
    leaders = stored(_narrow(best.selectExpr("value", "-best.turned AS leader", "best.n AS leading"), rows))
    met = postings.select("value", "rep", "n").join(leaders, "value").where(f"rep <> leader AND {_able('n', 'leading', percent)}")
    return met.selectExpr("leader AS a", "rep AS b").distinct()


#: The part of a list in which a member's neighbours are sought.
_CUT = f"CASE WHEN size > {LONG} THEN xxhash64(one, two) WHEN size > {LIST} THEN xxhash64(one) ELSE 0L END AS cut"
_PLACE = "OVER (PARTITION BY value, cut ORDER BY one, two, rep)"


def _neighbour_pairs(postings: DataFrame, percent: int) -> DataFrame:
    met = postings.selectExpr("*", _CUT).selectExpr("rep", "n", f"lag(struct(rep, n)) {_PLACE} AS other")
    met = met.where(f"other IS NOT NULL AND {_able('n', 'other.n', percent)}")
    return met.selectExpr("least(rep, other.rep) AS a", "greatest(rep, other.rep) AS b").distinct()


def _pairs_across(postings: DataFrame, found: DataFrame, rows: int, percent: int) -> DataFrame:
    """Pairs of different components that stand near each other in several lists.

    Near copies are in one component by now, so few pairs are left however large a group is. A
    list whose members are all of one component is left out before any sorting. Members that
    agree in the following values are shuffled anew in every list, so that any two of a family meet.
    """
    own = postings.join(found.withColumnRenamed("node", "rep"), "rep", "left").selectExpr(
        "value", "rep", "n", "one", "two", "coalesce(component, rep) AS component", _CUT
    )
    own = _narrow(own, rows)
    several = own.groupBy("value", "cut").agg(F.expr("min(component) <> max(component) AS several"))
    mixed_lists = _narrow(own.join(stored(_narrow(several.where("several").drop("several"), rows)), ["value", "cut"]), rows)
    place = "OVER (PARTITION BY value, cut ORDER BY one, two, xxhash64(rep, value), rep)"
    before = ", ".join(f"lag(struct(rep AS other, component AS beside, n AS extent), {k}) {place}" for k in range(1, REACH + 1))
    met = mixed_lists.selectExpr("rep", "component", "n", f"array({before}) AS others")
    apart = met.selectExpr("rep", f"inline(filter(others, o -> o.beside <> component AND {_able('o.extent', 'n', percent)}))")
    pairs = apart.groupBy(F.expr("least(rep, other) AS a"), F.expr("greatest(rep, other) AS b")).agg(F.count("*").alias("lists"))
    return pairs.where(f"lists >= {MEETINGS}").select("a", "b")


def _unsettled(postings: DataFrame, classes: DataFrame, found: DataFrame, rows: int) -> DataFrame:
    """(rep, component) of classes with enough values in lists of several components to pass the estimate with one of another."""
    own = postings.select("value", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").selectExpr(
        "value", "rep", "coalesce(component, rep) AS component"
    )
    own = _narrow(own, rows)
    mixed = own.groupBy("value").agg(F.expr("min(component) <> max(component) AS several")).where("several").select("value")
    held = _narrow(own.join(_narrow(mixed, rows), "value"), rows).groupBy("rep", "component").agg(F.count("*").alias("held"))
    kept = classes.selectExpr("rep", "size(sketch) AS kept")
    return stored(_narrow(held.join(kept, "rep").where(f"held >= {LEAST_SHARED}D * kept").select("rep", "component"), rows))


def _common_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample hold, in order, and how many do; led and closed by values that none holds."""
    share = min(1.0, ORDER_DOCS / max(1, texts.count()))
    drawn = texts.where(f"pmod(xxhash64(rep), 1000003) < {share}D * 1000003").select("text").mapInArrow(_shingles(words), "value long")
    counts = drawn.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n")).limit(COMMON).toPandas()
    values, often = counts["value"].to_numpy(np.int64).view(np.uint64), counts["n"].to_numpy(np.int64)
    order = values.argsort()
    # The last place takes what lies above all common values.
    return np.append(values[order], np.uint64(2**64 - 1)), np.append(often[order], 0)


def _exact_pairs(unsettled: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Every pair of different components whose sets can reach the similarity, by a prefix filter over the full sets.

    Two sets of m <= n shingles need percent / (100 + percent) * (m + n) in common, and the first common
    one stands at most so far from the end in both. So shingles that stand late in the common order,
    such as those of a template, bring no documents together.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_common_shingles(texts, words))
    sets = texts.join(unsettled, "rep").select("rep", "component", "text")
    first = sets.mapInArrow(_prefixes(words, percent, shared), "rep long, component long, n long, prefix array<long>")
    each = stored(first.selectExpr("rep", "component", "n", "posexplode(prefix) AS (at, value)"))
    shorter = f"(n - at) * {100 + percent} >= {2 * percent} * n"
    lists = each.groupBy("value").agg(
        F.expr(f"CAST(ceil(count_if({shorter}) / {BLOCK}) AS INT) AS homes"),
        F.expr(f"CAST(ceil(count(*) / {BLOCK}) AS INT) AS guests"),
        F.expr("min(component) <> max(component) AS several"),
    )
    met = stored(each.join(lists.where("several AND homes > 0").drop("several"), "value"))
    dealt = "CAST(pmod(xxhash64(rep), {}) AS INT) AS {}"
    spread = "explode(sequence(0, {} - 1)) AS {}"
    facts = "rep AS {0}, component AS component_{0}, n AS n_{0}, n - at AS rest_{0}"
    a, b = (["value", *facts.format(side).split(", ")] for side in "ab")
    a = met.where(shorter).selectExpr(*a, dealt.format("homes", "h"), spread.format("guests", "g"))
    b = met.selectExpr(*b, dealt.format("guests", "g"), spread.format("homes", "h"))
    reached = f"least(rest_a, rest_b) * {100 + percent} >= {percent} * (n_a + n_b)"
    able = f"component_a <> component_b AND (n_a < n_b OR n_a = n_b AND a < b) AND {_able('n_a', 'n_b', percent)} AND {reached}"
    return a.join(b, ["value", "h", "g"]).where(able).select("a", "b").distinct()


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rep, text) for the ends of pairs (a, b)."""
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    wanted = stored(_narrow(classes.select("rep", "digest").join(ends, "rep"), classes.count()))
    if wanted.count() <= SMALL_ROWS:
        wanted = F.broadcast(wanted)
    whole = docs.selectExpr("doc_id AS rep", "xxhash64(text) AS digest", "text")
    return stored(whole.join(wanted, ["rep", "digest"]).dropDuplicates(["rep", "digest"]).select("rep", "text"))


def linked(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of classes (rep, digest, n_shingles, sketch) by confirmed links between candidates."""
    known = classes.count()
    rows = SKETCH * known
    postings = _postings(classes, rows)
    # The upper halves of the values put them in the same order and tell them apart as well, at half the size.
    sketches = classes.selectExpr("rep", "transform(sketch, v -> CAST(shiftright(v, 32) AS INT)) AS sketch")

    def likely(pairs: DataFrame) -> DataFrame:
        pairs = stored(_narrow(pairs, rows))
        scored = _narrow(_with_both(pairs, sketches, "sketch"), pairs.count(), PART_SKETCHES)
        return stored(scored.mapInArrow(_near(LEAST_SHARED), "a long, b long, score double"))

    def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        both = _with_both(pairs.select("a", "b"), texts, "text").mapInArrow(_confirmed(words, percent), "a long, b long")
        return _narrow(stored(both), rows)

    def with_more(found: DataFrame, more: DataFrame) -> DataFrame:
        if more.isEmpty():
            return found
        return stored(components(found.selectExpr("node AS a", "component AS b").union(more), "a", "b"))

    led, beside = likely(_leader_pairs(postings, rows, percent)), likely(_neighbour_pairs(postings, percent))
    # A member asks its most similar leader first. That links most of a family, and only pairs that are still apart are compared then.
    closest = stored(_narrow(led.groupBy("b").agg(F.expr("max_by(a, struct(score, -a)) AS a")).select("a", "b"), known))
    first = confirmed(closest, _texts(docs, classes, closest))
    found = stored(components(first, "a", "b"))
    rest = _apart(_narrow(led.union(beside).select("a", "b").distinct(), rows), found, rows).join(closest, ["a", "b"], "left_anti")
    rest = stored(_narrow(rest, rows))
    found = with_more(found, confirmed(rest, _texts(docs, classes, rest)))
    across = likely(_pairs_across(postings, found, rows, percent))
    found = with_more(found, confirmed(across, _texts(docs, classes, across)))
    unsettled = _unsettled(postings, classes, found, rows)
    if unsettled.isEmpty():
        return found
    texts = _texts(docs, classes, unsettled.selectExpr("rep AS a", "rep AS b"))
    return with_more(found, confirmed(likely(_exact_pairs(unsettled, texts, words, percent)), texts))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    sketched = docs.select("doc_id", "text", F.xxhash64("text").alias("digest")).mapInArrow(
        _sketched(words, SKETCH), "doc_id long, digest long, n_shingles long, class binary, sketch array<long>"
    )
    rows = stored(sketched)
    count = rows.count()
    rows = _narrow(rows, count, PART_SKETCHES)
    groups = rows.where("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("rep"))
    groups = stored(_narrow(groups, count))
    own = rows.where("class IS NOT NULL").join(groups, "class").where("doc_id = rep")
    # A doc_id that repeats with another text stands for one class only: the least.
    least = own.groupBy("rep").agg(F.min(F.struct("class", "digest", "n_shingles", "sketch")).alias("least"))
    classes = stored(_narrow(least.select("rep", "least.digest", "least.n_shingles", "least.sketch"), count, PART_SKETCHES))
    found = linked(docs, classes, words, percent)
    placed = groups.join(found.withColumnRenamed("node", "rep"), "rep", "left").selectExpr("class", "coalesce(component, rep) AS component")
    joined = rows.select("doc_id", "n_shingles", "class").join(stored(_narrow(placed, count)), "class", "left")
    component = "IF(doc_id IS NULL, NULL, coalesce(component, doc_id))"
    return joined.selectExpr("doc_id", "n_shingles", f"{component} AS component_id", f"coalesce(doc_id = {component}, true) AS kept")
