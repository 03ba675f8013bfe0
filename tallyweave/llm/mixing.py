"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source is a queue of its documents in an order shuffled by hash, served up to EPOCHS times
over. A copy's virtual finish time is the number of its source's tokens up to its end, divided
by the source's weight. The mix is the copies in order of finish time, truncated at the budget:
a copy is in if half of it is through when the budget ends, so that a source is at most about half
a document away from its target.
A source whose copies are used up leaves its share to the others, which is how fair queueing
reshares by itself; `targets` gives the shares that come out of this in closed form.

Sizes are words: runs of bytes other than space and 0x09-0x0D. A null source is a source like
any other, a null text has no words, and documents without words are never taken. Repeated rows
are documents of their own; equal ones are interchangeable. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.storage import stored

EPOCHS = 3
#: Parts of a source's shuffled queue whose running totals are formed side by side.
QUEUE_PARTS = 512
#: Equal steps of virtual time, up to the end of the mix, whose tokens are counted before any is sorted.
TIME_STEPS = 4096
WORDS = r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"


def sized(docs: DataFrame) -> DataFrame:
    """docs with __size, the number of words."""
    return docs.withColumn("__size", F.expr(f"coalesce(CAST({WORDS} AS BIGINT), 0L)"))


def weight_of_rank(place: str) -> str:
    """Sources in order weigh 1, 2, 3 and again; place counts from 1."""
    return f"(({place} - 1) % 3 + 1)"


def targets(totals: DataFrame, share: float = 1.0) -> DataFrame:
    """Weight, level and target from (__queue, source, source_size), one row a source.

    Target = least of EPOCHS times the size and level * weight, where the level spends the budget
    of share times all sizes. Sources fill in order of EPOCHS * size / weight; the level is
    what is left for a weight once every source below it is full.
    """
    ranked = totals.withColumn("weight", F.expr(weight_of_rank("row_number() OVER (ORDER BY source IS NULL, source)")))
    limit = ranked.withColumn("__cap", F.expr(f"{EPOCHS} * source_size"))
    ahead = "OVER (ORDER BY __cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    rest = "OVER (ORDER BY __cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    levels = limit.selectExpr(
        "*",
        f"({share!r}D * sum(source_size) OVER () - coalesce(sum(__cap) {ahead}, 0)) / sum(weight) {rest} AS __level",
    )
    # Passing a full source raises the level, passing one that is not lowers it: the largest is the level.
    reached = levels.selectExpr("*", "max(__level) OVER () AS level")
    target = "CAST(least(CAST(__cap AS DOUBLE), level * weight) AS DOUBLE) AS target"
    return reached.selectExpr("__queue", "source", "source_size", "CAST(weight AS INT) AS weight", "CAST(level AS DOUBLE) AS level", target)


def queued(docs: DataFrame, keep: list[str], share: float = 1.0) -> DataFrame:
    """From sized documents keep, __source, __size, __end (tokens of the source up to the row's end), with the source's target.

    The queue order is a hash of the document. A hot source is no single group: its queue is dealt
    to parts by the hash, the parts' totals are summed first, and each part is summed by itself.
    """
    queue = "IF(source IS NULL, 'none', concat('source ', source)) AS __queue"
    narrow = docs.selectExpr(*dict.fromkeys(["doc_id", *keep]), "source AS __source", queue, "__size", "xxhash64(doc_id, source, 17) AS __key")
    rows = stored(narrow.withColumn("__part", F.expr(f"CAST(pmod(__key, {QUEUE_PARTS}) AS INT)")))
    parts = stored(rows.groupBy("__queue", "__source", "__part").agg(F.sum("__size").alias("__sum")))
    totals = parts.groupBy("__queue", F.col("__source").alias("source")).agg(F.sum("__sum").alias("source_size"))
    ahead = Window.partitionBy("__queue").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("__queue", "__part", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__before"))
    offsets = offsets.join(targets(totals, share).drop("source"), "__queue")
    own = Window.partitionBy("__queue", "__part").orderBy("__key", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumn("__own", F.sum("__size").over(own))
    return stored(running.join(stored(offsets), ["__queue", "__part"]).withColumn("__end", F.expr("__before + __own")))


def _finish(epoch: str) -> str:
    return f"((CAST({epoch} AS BIGINT) * source_size + __end) / weight)"


def _due(epoch: str) -> str:
    """The finish time less half of the copy's own service time."""
    return f"((CAST({epoch} AS BIGINT) * source_size + __end - __size / 2D) / weight)"


def cut_time(queue: DataFrame, share: float = 1.0) -> float:
    """The virtual time at which the budget ends, below that of any copy when nothing is taken.

    Tokens are counted by step of virtual time first, and only the step in which the budget ends
    is sorted. Virtual time runs as fast as tokens are served, so a step is a fixed share of the
    mix. The copies at which the budget ends are taken if half of their tokens lie within it.
    """
    copies = queue.where("__size > 0").selectExpr(
        "__size", "level", f"explode(transform(sequence(0, {EPOCHS - 1}), e -> {_due('e')})) AS due"
    )
    stepped = copies.withColumn("step", F.expr(f"CAST(least(floor(due / level * {TIME_STEPS}), {2 * TIME_STEPS}) AS INT)"))
    counts = stepped.groupBy("step").agg(F.sum("__size").alias("in_step"))
    running = counts.selectExpr(
        "step", "sum(in_step) OVER (ORDER BY step) - in_step AS before", "in_step",
        f"{share!r}D * sum(in_step) OVER () / {EPOCHS} AS budget",
    )
    ending = running.where("before < budget AND budget <= before + in_step").drop("in_step")
    inside = stepped.join(F.broadcast(ending), "step")
    times = inside.groupBy("due").agg(F.sum("__size").alias("tokens"), F.first("before").alias("before"), F.first("budget").alias("budget"))
    ordered = times.selectExpr("due", "budget", "tokens", "before + sum(tokens) OVER (ORDER BY due) AS upto", "min(due) OVER () AS first")
    taken = "max(IF(upto - tokens / 2 <= budget, due, NULL))"
    cut = ordered.agg(F.expr(f"coalesce({taken}, min(first) - 1) AS cut")).first()["cut"]
    return -1.0 if cut is None else cut


def mixed(docs: DataFrame, keep: list[str], share: float = 1.0) -> DataFrame:
    """From sized documents keep with size, source_size, target and finishes, the virtual finish times of the copies that the mix takes."""
    queue = queued(docs, keep, share)
    cut = cut_time(queue, share)
    times = f"transform(filter(sequence(0, {EPOCHS - 1}), e -> __size > 0 AND {_due('e')} <= {cut!r}D), e -> {_finish('e')})"
    return queue.selectExpr(
        *keep, "__source", "__size AS size", "source_size", "target", f"{times} AS finishes", f"size({times}) * __size AS taken"
    )


def stream(docs: DataFrame, share: float = 1.0) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, range-sorted by finish time.

    Only narrow rows are queued. They find their texts again by doc_id, a digest of the whole row
    and a number among rows that agree in both.
    """
    columns = [f"`{c}`" for c in docs.columns]
    key = ["__id", "__digest", "__copy"]
    number = F.row_number().over(Window.partitionBy("__id", "__digest").orderBy("__digest"))
    known = docs.withColumn("__id", F.expr("coalesce(CAST(doc_id AS STRING), '')")).withColumn("__digest", F.xxhash64(*columns))
    narrow = sized(known).select("doc_id", "source", "__size", "__id", "__digest").withColumn("__copy", number)
    taken = mixed(narrow, key, share).where("size(finishes) > 0").select(*key, "finishes")
    copies = known.withColumn("__copy", number).join(taken, key).selectExpr(*columns, "explode(finishes) AS __finish")
    return copies.repartitionByRange("__finish", "doc_id").sortWithinPartitions("__finish", "doc_id").select(*columns)
