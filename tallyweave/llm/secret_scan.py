"""Secret scanning with DataFrame functions only.

Three base kinds are found by pattern: assignments of a named credential, access key ids and
long hexadecimal runs. A fourth kind, `entropy`, is found by method: candidate strings are cut
into sliding windows of WINDOW characters, and the Shannon entropy of the characters of each
window is kept up by counts that change by one character in and one out. Windows above the
threshold of the candidate's character class are united to spans, unless an allow-list names the
candidate harmless or half of the window is an alphabet in order. Entropy spans that lie within a base span are left
out, those that reach beyond it stay whole; base spans always stay.

Positions are code points, ends exclusive. A null text is an empty one. Rows are handled one by
one, so ties, repeated rows, empty tables and further columns change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
#: Fixed patterns. A maximal run that is too short is no match, so the shortest length can stand in the pattern.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_HINT = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"

WINDOW = 20
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Bits a character that a window must exceed, by class; a class is the first whose pattern is the whole candidate.
CLASSES = (("hex", r"[0-9a-fA-F]+", 3.2), ("alnum", r"[A-Za-z0-9]+", 3.7), ("base64", r"[A-Za-z0-9+/_=-]+", 3.9))
#: Candidates that are never secrets: no digit or no letter, UUIDs, words joined by signs, dates.
ALLOWED = (
    r"[^0-9]+",
    r"[^A-Za-z]+",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
)
JOINED_PART = r"^([A-Za-z]+|[0-9]{1,4})?$"
#: Windows of a candidate that are counted in one go, and matches of a text that are placed in one go.
STRETCH, BLOCK = 256, 64
#: A window that holds half its length of an alphabet in order is no secret; what is joined to the alphabet may be one.
ORDERED = "|".join(a[k : k + WINDOW // 2] for a in (ALPHABET[:10], ALPHABET[10:36], ALPHABET[36:62]) for k in range(len(a) - WINDOW // 2 + 1))


def _q(pattern: str) -> str:
    """A pattern as an SQL literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _starts(pattern: str) -> str:
    """The matches of a pattern in __text with their first positions, as an array of (start, found).

    Positions are sums of lengths, formed by block of BLOCK matches first, so that many matches in one text cost little more than few.
    """
    gaps, found = f"split(__text, {_q(pattern)})", f"regexp_extract_all(__text, {_q(pattern)}, 0)"
    parts = f"zip_with({found}, slice({gaps}, 1, size({gaps}) - 1), (f, g) -> named_struct('found', f, 'gap', length(g), 'all', length(g) + length(f)))"
    blocks = f"transform(array({parts}), a -> transform(sequence(0, (size(a) - 1) div {BLOCK}), b -> slice(a, b * {BLOCK} + 1, {BLOCK})))[0]"
    none = "CAST(array() AS array<struct<at:int,parts:array<struct<found:string,gap:int,all:int>>>>)"
    offsets = (
        f"aggregate({blocks}, named_struct('at', 0, 'out', {none}), (s, b) -> named_struct('at', s.at + aggregate(b, 0, (n, m) -> n + m.all), "
        "'out', concat(s.out, array(named_struct('at', s.at, 'parts', b)))), s -> s.out)"
    )
    inside = (
        "aggregate(b.parts, named_struct('at', b.at, 'out', CAST(array() AS array<struct<start:int,found:string>>)), "
        "(s, m) -> named_struct('at', s.at + m.all, 'out', concat(s.out, array(named_struct('start', s.at + m.gap, 'found', m.found)))), s -> s.out)"
    )
    return f"IF(__text RLIKE {_q(pattern)}, flatten(transform({offsets}, b -> {inside})), CAST(array() AS array<struct<start:int,found:string>>))"


_SPAN = "struct<start:int,stop:int,kind:int>"
_NO_SPANS = f"CAST(array() AS array<{_SPAN}>)"


def _spans(pattern: str, kind: int, keep: str = "true") -> str:
    span = f"named_struct('start', m.start, 'stop', m.start + length(m.found), 'kind', {kind})"
    return f"transform(filter({_starts(pattern)}, m -> {keep}), m -> {span})"


def _allowed() -> str:
    """Whether a candidate is on the allow-list. Words joined by signs are told part by part: a repeated group would recurse once a part."""
    words = f"(c.found RLIKE '^[A-Za-z0-9]' AND forall(split(c.found, '[+/_=-]+'), p -> p RLIKE {_q(JOINED_PART)}))"
    return " OR ".join([f"c.found RLIKE {_q(f'^({p})$')}" for p in ALLOWED] + [words])


def _entropy_spans() -> str:
    """Unions of the windows of a candidate whose entropy exceeds its class's threshold.

    A candidate is cut into stretches that overlap by a window less one character, so every window lies in one
    stretch and the work grows with the length of a candidate, not with its square.
    """
    limit = "CASE " + " ".join(f"WHEN c.found RLIKE {_q(f'^{p}$')} THEN {x}D" for _, p, x in CLASSES) + " ELSE 99D END"
    cut = f"named_struct('start', c.start, 'limit', {limit}, 'pieces', regexp_extract_all(c.found, '.{{1,{STRETCH}}}', 0))"
    text = f"concat(c.pieces[k], coalesce(left(get(c.pieces, k + 1), {WINDOW - 1}), ''))"
    stretch = f"transform(array({text}), x -> named_struct('start', c.start + k * {STRETCH}, 'limit', c.limit, 'text', x, 'signs', split(x, ''), 'ordered', x RLIKE '{ORDERED}'))[0]"
    stretches = f"flatten(transform(transform(filter({_starts(CANDIDATE)}, c -> NOT ({_allowed()})), c -> {cut}), c -> transform(sequence(0, size(c.pieces) - 1), k -> {stretch})))"
    # One sign goes into the window and one out, and only the counts of these two change; bits is the sum of n log2 n over the counts.
    into, out = "c.signs[i - 1]", f"c.signs[i - {WINDOW + 1}]"
    window = f"substring(c.text, greatest(1, i - {WINDOW}), least({WINDOW}, i - 1))"
    count = "(length(w) - length(replace(w, {})))"
    term = "IF({0} > 0, {0} * log2({0}), 0D)"
    entered = f"transform(array({count.format(into)}), n -> {term.format('(n + 1)')} - {term.format('n')})[0]"
    left = f"transform(array({count.format(out)}), n -> {term.format('(n - 1)')} - {term.format('n')})[0]"
    change = f"CASE WHEN i <= {WINDOW} THEN {entered} WHEN {into} = {out} THEN 0D ELSE {entered} + {left} END"
    moved = f"named_struct('bits', s.bits + transform(array({window}), w -> {change})[0], 'spans', s.spans)"
    hot = f"i >= {WINDOW} AND log2({WINDOW}) - t.bits / {WINDOW} > c.limit AND NOT (c.ordered AND substring(c.text, i - {WINDOW - 1}, {WINDOW}) RLIKE '{ORDERED}')"
    one = f"named_struct('start', c.start + i - {WINDOW}, 'stop', c.start + i, 'kind', 3)"
    step = f"element_at(transform(array({moved}), t -> named_struct('bits', t.bits, 'spans', IF({hot}, {_united('t.spans', one)}, t.spans))), 1)"
    zero = f"named_struct('bits', 0D, 'spans', {_NO_SPANS})"
    each = f"aggregate(sequence(1, length(c.text)), {zero}, (s, i) -> {step}, s -> s.spans)"
    return f"aggregate(flatten(transform({stretches}, c -> {each})), {_NO_SPANS}, (u, w) -> {_united('u', 'w')})"


def _united(spans: str, more: str) -> str:
    """spans and one that does not begin before them, which prolongs the last one if they touch."""
    last = f"element_at({spans}, -1)"
    grown = f"concat(slice({spans}, 1, size({spans}) - 1), array(named_struct('start', {last}.start, 'stop', {more}.stop, 'kind', 3)))"
    return f"CASE WHEN size({spans}) > 0 AND {last}.stop >= {more}.start THEN {grown} ELSE concat({spans}, array({more})) END"


def _long_enough() -> str:
    return f"length(regexp_extract(m.found, {_q(ASSIGN)}, 2)) >= {ASSIGN_LEAST}"


def with_spans(docs: DataFrame, name: str = "secret_spans") -> DataFrame:
    """docs and an array of (start, stop, kind) in order of start, then kind as listed in KINDS."""
    text = docs.withColumn("__text", F.expr("coalesce(text, '')"))
    assign = f"IF(__text RLIKE {_q(ASSIGN_HINT)}, {_spans(ASSIGN, 0, _long_enough())}, CAST(array() AS array<{_SPAN}>))"
    base = text.withColumn("__base", F.expr(f"concat({assign}, {_spans(ACCESS, 1)}, {_spans(HEX, 2)})"))
    extra = f"filter({_entropy_spans()}, e -> NOT exists(__base, b -> b.start <= e.start AND e.stop <= b.stop))"
    order = "(l, r) -> CASE WHEN l.start < r.start THEN -1 WHEN l.start > r.start THEN 1 WHEN l.kind < r.kind THEN -1 WHEN l.kind > r.kind THEN 1 ELSE 0 END"
    return base.withColumn(name, F.expr(f"array_sort(concat(__base, {extra}), {order})")).drop("__text", "__base")


def written(spans: str, kinds: int = len(KINDS)) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    text = f"concat(element_at(array({names}), s.kind + 1), ':', s.start, ':', s.stop)"
    return F.expr(f"array_join(transform(filter({spans}, s -> s.kind < {kinds}), s -> {text}), ',')")


def number(spans: str, kind: str) -> Column:
    return F.expr(f"CAST(size(filter({spans}, s -> s.kind = {KINDS.index(kind)})) AS BIGINT)")


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with every found span replaced by a mark; n_chars, where it is a column, follows the text.

    Overlapping spans make one mark. Texts without a find stay as they are, null ones null.
    """
    found = with_spans(docs, "__spans")
    rest = "substring(text, s.at + 1, greatest(0, p.start - s.at))"
    piece = f"concat(s.out, {rest}, IF(p.start >= s.at, '{mark}', ''))"
    built = (
        "aggregate(__spans, named_struct('at', 0, 'out', ''), "
        f"(s, p) -> named_struct('at', greatest(s.at, p.stop), 'out', {piece}), s -> concat(s.out, substring(text, s.at + 1)))"
    )
    clean = found.withColumn("text", F.expr(f"IF(size(__spans) = 0, text, {built})"))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.expr("IF(size(__spans) = 0, n_chars, length(text))").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)
