"""Conversation repair, repeated passages and the manifest against plain versions and on odd rows."""

import hashlib
import heapq
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import conversation_repair, merkle, numbering, repeated_passages, statements

BLANKS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Conversations


def plain_repair(rows):
    """Uniform-cost search over (cost, audit) for rows (turn, role, text) in order."""
    seen, judged, counts = set(), [], [0, 0, 0]
    for turn, role, text in rows:
        inside = text.strip(BLANKS)
        kind = 0 if not inside else 1 if (role, text) in seen else 2 if inside[-1] not in ".!?" else 3
        if kind < 3:
            counts[kind] += 1
        seen.add((role, text))
        judged.append((kind, role, text))
    waiting, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, at, state, out = heapq.heappop(waiting)
        if at == len(judged) and state in (0, 3):
            break
        if (at, state) in done:
            continue
        done.add((at, state))
        new, after = ("assistant", 3) if state == 2 else ("user", 2)
        heapq.heappush(waiting, (cost + 2, audit + "I", at, after, (*out, f"{new}:")))
        if at < len(judged):
            kind, role, text = judged[at]
            heapq.heappush(waiting, (cost + 3, audit + "D", at + 1, state, out))
            if kind > 1:
                more = cost + (kind == 2)
                heapq.heappush(waiting, (more + 2, audit + "R", at + 1, after, (*out, f"{new}:{text}")))
                if role[:1] == new[0]:
                    heapq.heappush(waiting, (more, audit + "K", at + 1, after, (*out, f"{role}:{text}")))
                if role[:1] == "s" and state == 0:
                    heapq.heappush(waiting, (more, audit + "K", at + 1, 1, (*out, f"{role}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *counts, illegal, cost, audit, sha("\n".join(out)))


def in_order(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, g in groups.items()}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = " " if text is None else text
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


CONVERSATION = "conv_id long, turn long, role string, text string, at int, seg int, conv string, same string, initial string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", "y", "z") for r in rows], CONVERSATION)


def reported(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(11)
    roles = ["system", "user", "assistant", "tool", "", None, "under", "s", "User"]
    texts = ["Yes.", "No", "Why? ", "", " \n", None, "so. ", "a.\u0085", "Right!\t", "ü", "x "]
    rows = [(conv, draw.choice([None, *range(6)]), draw.choice(roles), draw.choice(texts)) for conv in [*range(60), None] for _ in range(draw.randrange(1, 9))]
    # One conversation holds a third of all rows, over many segments.
    return rows + [(1000, k, draw.choice(roles[:3]), f"row {k % 90}{draw.choice(['.', ''])}") for k in range(250)]


def test_conversations_equal_a_plain_search(spark, talks):
    found = reported(conversation_repair.report(table(spark, talks), table(spark, talks)))
    assert found == {c: plain_repair(g) for c, g in in_order(talks).items()}


def test_damaged_conversations_equal_a_plain_search(spark, talks):
    given = table(spark, talks)
    expected = {c: plain_repair(g) for c, g in in_order(plain_damage(talks)).items()}
    nothing = (0, 0, 0, 0, 0, 0, "", sha(""))
    found = reported(conversation_repair.report(given, conversation_repair.damaged(given)))
    assert found == {c: expected.get(c, nothing) for c in in_order(talks)}


def test_conversation_sql_agrees_on_odd_rows(spark, talks):
    rows = [r for r in talks if r[0] != 1000]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    theirs = {r[0]: r[1:] for r in con.execute(statements.conversation_repair()).fetchall()}
    given = table(spark, rows)
    assert reported(conversation_repair.report(given, conversation_repair.damaged(given))) == theirs


def test_no_conversations(spark):
    none = table(spark, []).where("false")
    assert conversation_repair.report(none, conversation_repair.damaged(none)).collect() == []


def test_segments_of_any_length_give_the_same_repair():
    draw = random.Random(3)
    for _ in range(40):
        codes = "".join(draw.choice(conversation_repair.CODES) for _ in range(draw.randrange(0, 30)))
        whole = conversation_repair.least_repair([codes])
        for step in (1, 4, 7):
            assert conversation_repair.least_repair([codes[k : k + step] for k in range(0, len(codes), step)]) == whole


def test_a_conversation_of_many_rows_is_repaired():
    cost, audit = conversation_repair.least_repair(["bad" * 21 + "e"] * 300)
    assert len(audit) >= 300 * 64 and cost > 0


def test_places_in_groups(spark):
    rows = spark.range(2000).selectExpr("IF(id % 3 = 0, 'hot', concat('g', id % 50)) AS grp", "id % 7 AS a", "id AS b")
    found = numbering.numbered(rows, "grp", ["a", "b"]).collect()
    groups = {}
    for r in found:
        groups.setdefault(r["grp"], []).append((r["a"], r["b"], r["__at"], r["__n"]))
    for members in groups.values():
        assert [m[2] for m in sorted(members)] == list(range(len(members))) and {m[3] for m in members} == {len(members)}


# Repeated passages


def plain_repeats(rows, window):
    texts = [(key, (text or "").encode()) for key, text in rows]
    counts = {}
    for _, data in texts:
        for p in range(len(data) - window + 1):
            counts[data[p : p + window]] = counts.get(data[p : p + window], 0) + 1
    out = []
    for key, data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - window + 1):
            if counts[data[p : p + window]] > 1:
                gone[p : p + window] = b"\1" * window
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((key, len(data), sum(gone), spans, bytes(c for c, g in zip(data, gone) if not g)))
    return sorted(out, key=repr)


def passages():
    draw = random.Random(5)
    base = ["".join(draw.choice("ab") for _ in range(3000)) for _ in range(4)]
    rows = [
        (1, None), (2, ""), (None, "x" * 399), (3, "a" * 400), (4, "a" * 401), (5, "ab" * 500), (6, base[0]), (7, base[0]), (7, base[0]),
        (8, base[0][5:] + base[1][:700]), (9, "z" + base[1][:401]), (10, base[2][100:505] + "é" + base[2][101:505]),
        (11, base[3][:1000] + "Q" + base[3][600:1400] + "W" + base[3][:450]), (12, base[1][250:700]), (13, base[2][105:504]), (14, "é" * 300),
        (15, "a" + "é" * 300),
    ]
    # A passage in many texts with other surroundings each, and one that misses the length by a byte.
    return rows + [(100 + k, base[3][50:440] + str(k) + base[2][3 * k : 4 * k + 401]) for k in range(40)]


@pytest.mark.parametrize("parts, chunk", [(1, 2_000_000), (5, 2_000_000), (2, 3000), (9, 1)])
def test_repeated_passages_equal_a_plain_count(spark, parts, chunk):
    docs = spark.createDataFrame([(*r, "z", 3) for r in passages()], "doc_id long, text string, chunk string, data int").repartition(parts)
    found = sorted(map(tuple, repeated_passages.repeats(docs, chunk=chunk).collect()), key=repr)
    assert found == [(k, n, m, s, bytearray(b)) for k, n, m, s, b in plain_repeats(passages(), 400)]


@pytest.mark.parametrize("window, order", [(20, 3), (60, 5), (60, 7)])
def test_other_windows_and_covers(spark, window, order):
    draw = random.Random(window)
    words = [draw.choice(["lorem", "ipsum", "dolor", "sit"]) + str(draw.randrange(3)) for _ in range(60)]
    rows = [(k, " ".join(draw.choice(words) for _ in range(draw.randrange(80))) + " ".join(words[:20]) * (k % 2)) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, repeated_passages.repeats(docs, window=window, order=order).collect()), key=repr)
    assert found == [(k, n, m, s, bytearray(b)) for k, n, m, s, b in plain_repeats(rows, window)]


def test_every_pair_of_places_meets_in_the_cover():
    for q in (2, 3, 5, 7, 11):
        period, places = repeated_passages.difference_cover(q)
        assert {(a - b) % period for a in places for b in places} == set(range(period)) and len(places) == q + 1


def test_long_texts_are_digested_in_stretches(monkeypatch):
    import numpy as np

    data = np.random.default_rng(1).integers(97, 99, 5000).astype(np.uint8)
    first = np.arange(4000)
    whole = repeated_passages.digests(data, first, first + 400)
    monkeypatch.setattr(repeated_passages, "STRETCH", 700)
    assert (repeated_passages.digests(data, first, first + 400) == whole).all()


def test_no_texts(spark):
    assert repeated_passages.repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeated_passages_of_the_smallest_table(spark, sf, found):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = sorted(((k, n, m, s, hashlib.sha256(b).hexdigest()) for k, n, m, s, b in plain_repeats(rows, 400)), key=repr)
    assert sorted(map(tuple, found("op12")), key=repr) == expected


# Manifest


def plain_manifest(rows):
    def encoded(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def grown(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
        return levels

    def beside(levels, at):
        for nodes in levels[:-1]:
            first = at // 8 * 8
            run = nodes[first : first + 8]
            yield "".join(run[: at - first]), "".join(run[at - first + 1 :])
            at //= 8

    groups = {}
    for doc, source, lang, n, text in rows:
        leaf = met = sha("".join(map(encoded, (doc, source, lang, n, text))))
        if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
            lowered = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            met = sha("".join(map(encoded, (doc, source, lang, n, lowered))))
        groups.setdefault(lang, []).append((doc is not None, doc or 0, leaf, met))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: grown([m[2] for m in sorted(groups[g])]) for g in names}
    upper = grown([trees[g][-1][0] for g in names])
    root, out = upper[-1][0] if names else None, []
    for number, g in enumerate(names):
        for at, (known, doc, leaf, met) in enumerate(sorted(groups[g])):
            path = [*beside(trees[g], at), *beside(upper, number)]
            folded = met
            for before, after in path:
                folded = sha(before + folded + after)
            out.append((doc if known else None, leaf, trees[g][-1][0], root, sha("".join(map("".join, path))), folded, folded == root))
    return sorted(out, key=repr)


DOCUMENT = "doc_id long, source string, lang string, n_chars long, text string, tree string, node int, leaf string, level int"


def manifest_of(spark, rows):
    docs = spark.createDataFrame([(*r, "t", 1, "l", 2) for r in rows], DOCUMENT)
    lowered = ["doc_id", "source", "lang", "n_chars", "lower(text)"]
    met = f"IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 0, {merkle.leaf_digest(lowered)}, NULL)"
    return sorted(map(tuple, merkle.verified(merkle.manifest(docs, tampered=met)).collect()), key=repr)


ODD = [(None, None, None, None, None), (None, "a", "en", 1, "X"), (5, "a", "en", 3, "Abc"), (5, "a", "en", 3, "Abc"), (5, "b", "en", 3, "abd"), (6, "a", "", 0, ""), (7, None, "é", -4, "Big " * 9000)]


@pytest.mark.parametrize(
    "rows",
    [
        ODD,
        [(k, f"s{k % 3}", "hot" if k % 3 else f"l{k % 40}", k, f"Text {k}") for k in range(700)],
        [(k, "s", "en", k, f"Text {k}") for k in range(64)],
        [(k, "s", "en", k, f"Text {k}") for k in range(65)],
        [(k, "s", f"lang{k}", k, f"Text {k}") for k in range(9)],
        [(1, "s", "en", 1, "One")],
        [(1, "s", "en", 1, "One"), (2, "s", None, 1, "Two")],
    ],
)
def test_manifests_equal_plain_trees(spark, rows):
    assert manifest_of(spark, rows) == plain_manifest(rows)


def test_manifest_sql_agrees_on_odd_rows(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    rows = [r for r in ODD if r[0] is not None]
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    result = con.execute(statements.merkle())
    assert sorted(result.fetchall(), key=repr) == manifest_of(spark, rows)


def test_no_leaves(spark):
    assert manifest_of(spark, []) == []
