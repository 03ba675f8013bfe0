"""Oracle SQL (DuckDB) of the operators that SQL can express on whole tables, written apart from their Spark form."""

from __future__ import annotations

#: Levels that the SQL of the manifest unrolls: enough for 8 ** 8 rows of a language and 8 ** 4 languages.
GROUP_LEVELS, UPPER_LEVELS = 8, 4


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit; 3988292384 is the fixed reversed polynomial."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    bit = "lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    step = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {bit})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295)"


def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def merkle() -> str:
    leaf = lambda text: "sha256(" + " || ".join(map(_encoded, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"leaves AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(lowered)} END AS tampered FROM documents)",
        """placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS node,
            dense_rank() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS tree FROM leaves)""",
        "g0 AS (SELECT tree, node, leaf AS digest FROM placed)",
        "p0 AS (SELECT *, '' AS proof, coalesce(tampered, leaf) AS folded FROM placed)",
    ]

    def climb(level: str, last: str, path: str, before: str, divisor: int, tree: str, node: str) -> None:
        steps.append(f"""f{level} AS (SELECT {tree} AS tree, node // 8 AS node, list(digest ORDER BY node) AS kids, any_value(n) > 1 AS real FROM
            (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {last}) GROUP BY {tree}, node // 8)""")
        steps.append(f"g{level} AS (SELECT tree, node, CASE WHEN real THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS digest FROM f{level})")
        at = f"(p.{node} // {divisor}) % 8"
        left, right = f"array_to_string(kids[1:{at}], '')", f"array_to_string(kids[{at} + 2:], '')"
        steps.append(f"""{path} AS (SELECT p.* EXCLUDE (proof, folded), CASE WHEN real THEN proof || {left} || {right} ELSE proof END AS proof,
            CASE WHEN real THEN sha256({left} || folded || {right}) ELSE folded END AS folded
            FROM {before} p JOIN f{level} f ON f.tree = {'p.tree' if tree == 'tree' else '0'} AND f.node = p.{node} // {8 * divisor})""")

    for k in range(GROUP_LEVELS):
        climb(f"{k + 1}", f"g{k}", f"p{k + 1}", f"p{k}", 8**k, "tree", "node")
    n = GROUP_LEVELS
    steps.append(f"u{n} AS (SELECT 0 AS everything, tree AS node, digest FROM g{n})")
    last = f"u{n}"
    for k in range(n, n + UPPER_LEVELS):
        climb(f"{k + 1}", last, f"p{k + 1}", f"p{k}", 8 ** (k - n), "everything", "tree")
        steps.append(f"u{k + 1} AS (SELECT 0 AS everything, node, digest FROM g{k + 1})")
        last = f"u{k + 1}"
    return f"""WITH {', '.join(steps)}
        SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
        FROM p{n + UPPER_LEVELS} p JOIN g{n} s ON s.tree = p.tree JOIN {last} r ON true"""


def conversation_repair() -> str:
    key = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"
    nexts = {0: 2, 1: 2, 2: 3, 3: 2}

    def ahead(letters: str, cost: str, state: int) -> str:
        value = f"v.v{state}"
        return f"lpad((left({value}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letters}' || substr({value}, 10)"

    def least(state: int) -> str:
        ways, letters, cost = [], "", 0
        for _ in range(3):
            ways.append(ahead(letters + "D", str(cost + 3), state))
            sound = f"{cost} + truncated::INT"
            ways.append(f"CASE WHEN NOT gone THEN {ahead(letters + 'R', sound + ' + 2', nexts[state])} END")
            ways.append(f"CASE WHEN NOT gone AND initial = '{'a' if state == 2 else 'u'}' THEN {ahead(letters + 'K', sound, nexts[state])} END")
            if state == 0:
                ways.append(f"CASE WHEN NOT gone AND initial = 's' THEN {ahead(letters + 'K', sound, 1)} END")
            letters, cost, state = letters + "I", cost + 2, nexts[state]
        return f"least({', '.join(ways)})"

    blanks = r"[^\x20\x09-\x0D]"
    return f"""WITH RECURSIVE drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(key)} % 20 AS fault FROM conversations),
        damaged AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
            CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE fault WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM drawn WHERE fault <> 0),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS spot, left(role, 1) AS initial,
            count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
        seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY spot) > 1 AS again, NOT regexp_matches(text, '{blanks}') AS blank,
            regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS ended, lag(initial) OVER (PARTITION BY conv_id ORDER BY spot) AS before FROM placed),
        judged AS (SELECT *, NOT blank AND again AS duplicate, NOT blank AND NOT again AND NOT ended AS truncated, blank OR again AS gone FROM seen),
        v AS (SELECT conv_id, n AS spot, '000000000' AS v0, '000000004II' AS v1, '000000002I' AS v2, '000000000' AS v3 FROM judged WHERE spot = n
            UNION ALL SELECT v.conv_id, v.spot - 1, {', '.join(least(s) for s in range(4))}
            FROM v JOIN judged j ON j.conv_id IS NOT DISTINCT FROM v.conv_id AND j.spot = v.spot),
        solved AS (SELECT conv_id, left(v0, 9)::BIGINT AS cost, substr(v0, 10) AS audit FROM v WHERE spot = 0),
        letters AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS pos FROM solved),
        edits AS (SELECT conv_id, pos, substr(audit, pos, 1) AS letter, length(regexp_replace(left(audit, pos), 'I', '', 'g')) AS spot FROM letters),
        lines AS (SELECT e.conv_id, e.pos, letter, j.role, j.text, row_number() OVER (PARTITION BY e.conv_id ORDER BY e.pos) - 1 AS line,
            first_value(letter = 'K' AND initial = 's') OVER (PARTITION BY e.conv_id ORDER BY e.pos) AS headed
            FROM edits e LEFT JOIN judged j ON letter <> 'I' AND j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.spot = e.spot WHERE letter <> 'D'),
        written AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (line - coalesce(headed, false)::INT) % 2 = 0 THEN 'user'
            ELSE 'assistant' END || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY pos)) AS repaired_sha256 FROM lines GROUP BY conv_id),
        counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
            count_if(truncated) AS truncated, count_if(spot > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
            coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
            coalesce(repaired_sha256, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
            LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN written w ON w.conv_id IS NOT DISTINCT FROM c.conv_id"""


def statements() -> dict[str, str]:
    return {"op11_conversation_repair": conversation_repair(), "op13_merkle_manifest": merkle()}
