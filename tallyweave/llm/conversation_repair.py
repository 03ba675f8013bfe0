"""Repair of the turn structure of conversations at the least cost.

The rows of a conversation, in order of their turns, are edited (Keep, Rerole, Delete, Insert) until
its role initials read (s?(ua)+)?. The edits that are possible form a DAG: its nodes are the state of the structure
before each row, its edges insert up to two rows and then keep, rerole or delete the row. The weight of a path is one big integer: the
high digits are the cost, the low digits, of fixed width, spell the audit by position, one digit a letter from the
first on, with zeros up to the end. So the integer minimum of an ordinary DP from the last row to
the first decides the cost and then the least audit, since a digit grows with its letter and a shorter audit ends in zeros.

Conversations are cut into segments of SEGMENT rows. A segment's minima between all pairs of states depend
on nothing but its rows' codes, so equal segments are solved once a task, the width of the
integers stays fixed, and a conversation with very many rows is spread over many tasks until its
segments' codes, a letter a row, are joined. Rows are placed by a range sort (see numbering.py), repeats
are found by a grouping, and the repaired lines are written or digested as a stream.

Order and edge cases: rows go by turn, null turns first, then by role and text; null roles and texts are one space; a null
conv_id is a conversation of its own; a role counts by its first letter, as it is; repeated rows are duplicates; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.numbering import numbered
from tallyweave.llm.storage import stored

SEGMENT = 64
#: Distinct segments whose minima a worker remembers.
REMEMBERED = 20_000
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = str.maketrans("1234", "DIKR")
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: A row's code is a letter of CODES: its initial in INITIALS times three, plus 0 sound, 1 truncated, 2 to be deleted.
INITIALS, CODES = "sua", "abcdefghijkl"
SOUND, TRUNCATED, FAULTY = range(3)
#: How a row is edited: the state before, the rows inserted first and the edit, as a letter of STEPS.
STEPS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklm"


def inserted(state: int) -> int:
    """The state after the only row that may be inserted: a user's, or an assistant's after a user."""
    return ASSISTANT if state == USER else USER


def edges(state: int, code: str) -> Iterator[tuple[list[int], int, int]]:
    """The ways over a row from a state: letters, cost, next state."""
    initial, fault = divmod(CODES.index(code), 3)
    letters, cost = [], 0
    for _ in range(3):
        yield [*letters, DELETE], cost + COST[DELETE], state
        if fault != FAULTY:
            extra = cost + (fault == TRUNCATED)
            after = {0: SYSTEM, 1: USER, 2: ASSISTANT}.get(initial)
            if after == (SYSTEM if initial == 0 and state == START else inserted(state)):
                yield [*letters, KEEP], extra + COST[KEEP], after
            yield [*letters, REROLE], extra + COST[REROLE], inserted(state)
        letters.append(INSERT)
        cost += COST[INSERT]
        state = inserted(state)


@lru_cache(REMEMBERED)
def segment_minima(codes: str) -> list[list[tuple[int, int] | None]]:
    """For each pair of states, before and after the rows, the least weight and the number of its letters.

    A weight is cost << width | audit, with room for three letters a row.
    """
    width = 9 * len(codes)
    digits = (1 << width) - 1

    def ahead(letters: list[int], cost: int, weight: int, count: int) -> tuple[int, int]:
        low = weight & digits
        for letter in reversed(letters):
            low = low >> 3 | letter << (width - 3)
        return ((weight >> width) + cost) << width | low, count + len(letters)

    found = [[(0, 0) if state == end else None for end in STATES] for state in STATES]
    for code in reversed(codes):
        found = [
            [
                min((ahead(letters, cost, *found[after][end]) for letters, cost, after in edges(state, code) if found[after][end]), default=None)
                for end in STATES
            ]
            for state in STATES
        ]
    return found


def least_repair(segments: list[str]) -> tuple[int, str]:
    """Cost and audit of a conversation of segments of codes."""
    # What is left to do after the last row: pairs must be whole, and a system row alone is no conversation.
    width = 6
    left = {START: (0, 0), ASSISTANT: (0, 0), USER: (2 << width | INSERT << 3, 1), SYSTEM: (4 << width | INSERT << 3 | INSERT, 2)}
    for codes in reversed(segments):
        minima, own = segment_minima(codes), 9 * len(codes)
        wider, best = width + own, {}
        for state in STATES:
            ways = []
            for end in STATES:
                if minima[state][end] and end in left:
                    (weight, count), (rest, more) = minima[state][end], left[end]
                    cost = (weight >> own) + (rest >> width)
                    audit = (weight & ((1 << own) - 1)) << width | (rest & ((1 << width) - 1)) << (own - 3 * count)
                    ways.append((cost << wider | audit, count + more))
            if ways:
                best[state] = min(ways)
        left, width = best, wider
    weight, count = left[START]
    audit = weight & ((1 << width) - 1)
    return weight >> width, format(audit >> (width - 3 * count), f"0{count}o").translate(LETTERS) if count else ""


def steps(audit: str, codes: str) -> tuple[str, str]:
    """How each row is edited, a letter of STEPS a row, and one more letter for what is inserted at the end."""
    state, first, waiting, out = START, START, 0, []
    rows = iter(codes)
    for letter in audit:
        if letter == "I":
            waiting += 1
            state = inserted(state)
            continue
        code = next(rows)
        out.append(STEPS[first * 9 + waiting * 3 + "DKR".index(letter)])
        if letter != "D":
            state = SYSTEM if letter == "K" and CODES.index(code) // 3 == 0 else inserted(state)
        first, waiting = state, 0
    return "".join(out), STEPS[first * 9 + waiting * 3]


def illegal_pairs(codes: str) -> int:
    initials = codes.translate(str.maketrans(CODES, "sssuuuaaaooo"))
    return max(0, len(codes) - 1) - sum(f"{a}{b}" in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {name: [] for name in ("conv", "cost", "audit", "illegal", "steps", "end", "rows")}
        for conv, segments in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = "".join(segments)
            cost, audit = least_repair(segments)
            edits, end = steps(audit, codes)
            parts = [edits[k : k + SEGMENT] for k in range(0, len(edits), SEGMENT)]
            for name, value in zip(out, (conv, cost, audit, illegal_pairs(codes), parts, end, len(codes))):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=_SOLVED)


_SOLVED = pa.schema([
    ("conv", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()), ("steps", pa.list_(pa.string())), ("end", pa.string()),
    ("rows", pa.int64()),
])


def placed(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) with conv and at, their conversation and place in it, and role and text without nulls."""
    conv = "IF(conv_id IS NULL, '', concat('1', CAST(conv_id AS STRING))) AS conv"
    clean = rows.selectExpr("*", conv).drop("conv_id").withColumns({c: F.expr(f"coalesce({c}, ' ')") for c in ("role", "text")})
    return numbered(clean, "conv", ["turn", "role", "text"], "at")


def faults(ordered: DataFrame) -> DataFrame:
    """(conv, at, turn, initial) of placed rows and blank, duplicate, truncated: a row's first fault. Texts stay behind."""
    narrow = ordered.selectExpr(
        "conv", "at", "turn", "left(role, 1) AS initial", "sha2(concat(length(role), ':', role, text), 256) AS same",
        r"text NOT RLIKE '[^\\x20\\x09-\\x0D]' AS blank", r"text RLIKE '[.!?][\\x20\\x09-\\x0D]*\\z' AS ended",
    )
    firsts = narrow.groupBy("conv", "same").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    judged = narrow.join(firsts, ["conv", "same"], "left").withColumn("again", F.expr("coalesce(first < at, false)"))
    return judged.selectExpr(
        "conv", "at", "turn", "initial", "blank", "NOT blank AND again AS duplicate", "NOT blank AND NOT again AND NOT ended AS truncated"
    )


def solved(judged: DataFrame) -> DataFrame:
    """(conv, cost, audit, illegal, steps, end, rows) by conversation; steps are cut by segment."""
    initial = f"coalesce(nullif(locate(initial, '{INITIALS}'), 0) - 1, 3)"
    fault = f"CASE WHEN blank OR duplicate THEN {FAULTY} WHEN truncated THEN {TRUNCATED} ELSE {SOUND} END"
    # An empty role is found at the first place by locate.
    code = f"substring('{CODES}', IF(initial = '', 3, {initial}) * 3 + {fault} + 1, 1) AS code"
    coded = judged.selectExpr("conv", "at", f"at div {SEGMENT} AS seg", code)
    joined = "array_join(transform(array_sort(collect_list(struct(at, code))), c -> c.code), '') AS codes"
    segments = coded.groupBy("conv", "seg").agg(F.expr(joined))
    whole = segments.groupBy("conv").agg(F.expr("array_sort(collect_list(struct(seg, codes))).codes AS segments"))
    schema = "conv string, cost long, audit string, illegal long, steps array<string>, end string, rows long"
    return stored(whole.mapInArrow(_solved, schema))


def lines(ordered: DataFrame, repairs: DataFrame) -> DataFrame:
    """The repaired rows: (conv, at, place, turn, role, text), in order of at and place; inserted rows have no turn and no text."""
    by_segment = repairs.selectExpr("conv", "posexplode(steps) AS (seg, edits)").selectExpr("conv", "CAST(seg AS BIGINT) AS seg", "edits")
    edited = ordered.withColumn("seg", F.expr(f"at div {SEGMENT}")).join(by_segment, ["conv", "seg"]).selectExpr(
        "conv", "at", "turn", "role", "text", f"locate(substring(edits, CAST(at % {SEGMENT} AS INT) + 1, 1), '{STEPS}') - 1 AS step",
        "true AS own",
    )
    ends = repairs.selectExpr("conv", "rows AS at", "CAST(NULL AS BIGINT) AS turn", "'' AS role", "'' AS text", f"locate(end, '{STEPS}') - 1 AS step", "false AS own")
    every = edited.union(ends).selectExpr("*", "step div 9 AS state", "step div 3 % 3 AS before", "step % 3 AS edit")
    # After a user's row, and after every second row put in before, comes the assistant's.
    new = f"IF((IF(state = {USER}, 1, 0) + {{}}) % 2 = 1, 'assistant', 'user')"
    insertions = f"transform(sequence(0, 1), k -> named_struct('place', k, 'turn', CAST(NULL AS BIGINT), 'role', {new.format('k')}, 'text', ''))"
    self = f"named_struct('place', 2, 'turn', turn, 'role', IF(edit = 2, {new.format('before')}, role), 'text', text)"
    out = f"concat(slice({insertions}, 1, CAST(before AS INT)), IF(own AND edit > 0, array({self}), array()))"
    return every.selectExpr("conv", "at", f"inline({out})")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, repaired_sha256) from lines sorted by conversation; one digest is open at a time."""
    conv, digest = None, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"conv": [conv], "repaired_sha256": [digest.hexdigest()]})

    for batch in batches:
        for name, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if digest is not None and name == conv:
                digest.update(b"\n")
            else:
                if digest is not None:
                    yield closed()
                conv, digest = name, hashlib.sha256()
            digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield closed()


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of the role:text lines. A digest has to read a conversation in order, so it is one task's stream."""
    dealt = repaired.repartition("conv").sortWithinPartitions("conv", "at", "place").select("conv", "role", "text")
    return dealt.mapInArrow(_digested, "conv string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations with planted faults, decided by a checksum of conv_id and turn: rows dropped, emptied, without full stops, repeated, or given to the user."""
    key = "concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))"
    drawn = conversations.selectExpr("conv_id", "turn", "role", "text", f"crc32(CAST({key} AS BINARY)) % 20 AS fault").where("fault <> 0")
    text = "CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END AS text"
    changed = drawn.selectExpr("conv_id", "turn", "IF(fault = 4, 'user', role) AS role", text, "explode(IF(fault = 3, array(0, 1), array(0))) AS copy")
    return changed.drop("copy")


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of conversations on the repair of rows, which are conversations or what became of them."""
    ordered = placed(rows.select("conv_id", "turn", "role", "text"))
    judged = stored(faults(ordered))
    repairs = solved(judged)
    counts = judged.groupBy("conv").agg(
        F.expr("coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0L) AS gaps"),
        *[F.expr(f"count_if({fault}) AS {fault}") for fault in ("blank", "duplicate", "truncated")],
    )
    found = stored(counts).join(repairs.select("conv", "illegal", "cost", "audit"), "conv").join(stored(digests(lines(ordered, repairs))), "conv", "left")
    every = conversations.select("conv_id").distinct().selectExpr("conv_id", "IF(conv_id IS NULL, '', concat('1', CAST(conv_id AS STRING))) AS conv")
    numbers = [f"coalesce({c}, 0L) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, "conv", "left").selectExpr(
        "conv_id", *numbers, "coalesce(audit, '') AS audit", "coalesce(repaired_sha256, sha2('', 256)) AS repaired_sha256"
    )
