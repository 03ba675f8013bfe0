"""Main text of web pages by differencing against the page with the nearest URL.

A page is read into lines: one for each block of text. Lines inside elements that are no main text
by their meaning (menus, forms, scripts, ...) or by their class or id are left out. What a site
repeats on its pages is found by differencing: pages are ordered by host and URL path, each is
paired with its neighbours in that order, the lines of a pair are aligned by longest common
subsequence, and lines that both share are deleted. Lines inside an article or main element are
the page's own and stay, so that quotes and copies of an article are not taken for furniture.

A copy of a page tells nothing about it, so on either side the page is paired with the nearest one
that is none. Pages with the same lines in a row count as one. A neighbour is a copy if it holds
nearly all (COPY_SHARE) of the page's lines, leaving out what most of the NEAR different pages on
either side hold: those lines are the site's and say nothing about copies. So a short page on a
site with much furniture loses that furniture, and versions of one text keep it, unless there are
more versions in a row than NEAR and no element marks them as an article.

The order is a range partitioning: a hot host spans many partitions, and the first pages of a
partition have neighbours on one side only. Edge cases: null or empty html gives an empty text; a
null url is a host of its own; equal urls are neighbours; repeated rows are pages of their own;
further columns pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements whose whole content is dropped, elements that end a line, elements that protect lines.
DROPPED = frozenset(
    "nav header footer aside form script style noscript template svg iframe object select button textarea "
    "dialog menu head title canvas audio video math".split()
)
RAW = frozenset("script style textarea title noscript iframe template svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OWN = frozenset("article main".split())
#: Names in a class, id or role that mark an element as furniture: the word alone, or with a place before it or a part after it.
FURNITURE = re.compile(
    r"(?:(?:(?:user|reader|post|article|page|story|blog)-+)?(?:comments|comment-(?:list|form)|share|sharing|social|related|newsletter|disqus)(?:-+(?:posts|articles|stories))?|"
    r"(?:(?:site|main|top|bottom|left|right|global|primary|secondary|sub|mobile|sticky)-+)?(ad|ads|adv|advert|adverts|advertisement|sponsor|sponsored|promo|banner|cookie|cookies|consent|notice|alert|popup|modal|"
    r"menu|menubar|nav|navbar|navigation|breadcrumb|breadcrumbs|sidebar|side-bar|header|masthead|footer|comment|comments|disqus|"
    r"share|sharing|social|related|newsletter|subscribe|signup|login|search|widget|pagination|pager|toolbar|copyright))"
    r"(?:-+(?:notice|policy|thread|wrapper|wrap|container|box|bar|area|block|section|list|links?|buttons?|menu|nav|inner|unit|slot|form|icons|items?|banner|popup|modal|[0-9x]+))*"
)
MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')?|[^>=])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
#: A neighbour with this share of a page's lines, but for those that most of the pages near it hold, is a copy.
COPY_SHARE = 0.8
#: Different pages on either side that a page's lines are compared with.
NEAR = 4
#: Rows of a batch of results, and characters of its texts.
BATCH_ROWS, BATCH_CHARS = 1000, 8_000_000


class Line(NamedTuple):
    text: str
    own: bool


def lines_of(page: str | None) -> list[Line]:
    """The lines of a page outside dropped elements, in order."""
    out: list[Line] = []
    held: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # element, dropped, own
    page, at = page or "", 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            out.append(Line(text, any(own for _, _, own in open_)))
        held.clear()

    dropped = 0
    while at < len(page):
        mark = MARK.search(page, at)
        if not dropped:
            held.append(page[at : mark.start() if mark else len(page)])
        if not mark:
            break
        at = mark.end()
        name = (mark[2] or "").lower()
        if not name:
            continue
        if name == "br":
            held.append(" ")
        elif mark[1]:
            depth = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None)
            if name in BLOCKS and not dropped:
                flush()
            if depth is not None:
                dropped -= sum(x[1] for x in open_[depth:])
                del open_[depth:]
        else:
            if name in BLOCKS and not dropped:
                flush()
            if name in VOID or mark[3].rstrip().endswith("/"):
                continue
            if name == "p" and open_ and open_[-1][0] == "p":
                dropped -= open_.pop()[1]
            inside = any(own for _, _, own in open_)
            marks = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(mark[3])} if mark[3] else {}
            own = name in OWN or marks.get("role") in ("main", "article")
            named = (token for k in ("class", "id", "role") for token in marks.get(k, "").replace("_", "-").split())
            unseen = marks.get("hidden", "until-found") != "until-found" or bool(HIDDEN.search(marks.get("style", "")))
            furniture = name in DROPPED or name not in ("html", "body") and (
                unseen or not own and any(FURNITURE.fullmatch(token) for token in named)
            )
            if name == "header" and inside:
                furniture = False  # an article's own heading
            if name in RAW:
                end = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            open_.append((name, furniture, own))
            dropped += furniture
    if not dropped:
        flush()
    return out


def shared_lines(mine: list, other: list) -> set[int]:
    """The places in mine of a longest common subsequence with other, by bit-parallel rows."""
    places: dict = {}
    for k, line in enumerate(other):
        places[line] = places.get(line, 0) | 1 << k
    full, row = (1 << len(other)) - 1, (1 << len(other)) - 1
    rows = []
    for line in mine:
        hit = row & places.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    # A zero bit at k in row i: the subsequence of mine[:i + 1] and other[:k + 1] is longer by that step.
    found, column = set(), len(other) - 1
    for i in range(len(mine) - 1, -1, -1):
        before = rows[i - 1] if i else full
        zeros_now = (~rows[i] & full) & ((1 << column + 1) - 1)
        zeros_before = (~before & full) & ((1 << column + 1) - 1)
        if zeros_now.bit_count() > zeros_before.bit_count():
            found.add(i)
            matches = places[mine[i]] & ((1 << column + 1) - 1)
            column = _step_back(matches, rows[i], before, column, full) - 1
    return found


def _step_back(matches: int, now: int, before: int, column: int, full: int) -> int:
    """The last match in other at which the row gains over the row before, within column."""
    while matches:
        k = matches.bit_length() - 1
        low = (1 << k) - 1
        if (~now & full & ((low << 1) | 1)).bit_count() == (~before & full & low).bit_count() + 1:
            return k
        matches &= low
    return 0


def own_text(mine: list[Line], *sides: list[list[Line]]) -> str:
    """The page's text without the open lines that it shares with a neighbour; each side lists its pages nearest first."""
    open_places = [k for k, line in enumerate(mine) if not line.own]
    sides = [[other for other in side if other and other != mine] for side in sides]
    near = {tuple(other): {line.text for line in other} for side in sides for other in side}
    everything = {line.text for line in mine}
    held = {text: sum(text in texts for texts in near.values()) for text in everything}
    telling = {text for text in everything if held[text] < 2 or 2 * held[text] <= len(near)}

    def is_copy(other: list[Line]) -> bool:
        return len(telling & near[tuple(other)]) > COPY_SHARE * len(telling)

    gone: set[int] = set()
    for side in sides if open_places else ():
        other = next((x for x in side if not is_copy(x)), None)
        if other is not None:
            shared = shared_lines([mine[k].text for k in open_places], [line.text for line in other if not line.own])
            gone |= {open_places[k] for k in shared}
    return "\n".join(line.text for k, line in enumerate(mine) if k not in gone)


class _Run:
    """Pages of one host in a row that have the same lines, and where their other columns stand."""

    def __init__(self, host: str | None, lines: list[Line]):
        self.host, self.lines, self.rows = host, lines, []


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[_Run, bool]]:
    """The run that a page belongs to, and whether the page begins it."""
    run = None
    for batch in batches:
        kept = batch.select(columns)
        hosts, lines, own = (batch.column(c).to_pylist() for c in ("__host", "__lines", "__own"))
        for k in range(batch.num_rows):
            page = [Line(*x) for x in zip(lines[k], own[k])]
            begins = run is None or (run.host, run.lines) != (hosts[k], page)
            if begins:
                run = _Run(hosts[k], page)
            # A copy of the row: a slice would hold the whole batch.
            run.rows.append(kept.take(pa.array([k])))
            yield run, begins


def _parse(columns: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [lines_of(x.as_py()) for x in batch.column("__html")]
            texts = pa.array([[line.text for line in page] for page in parsed], pa.list_(pa.string()))
            own = pa.array([[line.own for line in page] for page in parsed], pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), texts, own], [*columns, "__lines", "__own"])

    return run


def _difference(columns: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Run] = []  # NEAR settled runs at most, then those that wait for the pages after them
        waiting, rows, texts = 0, [], []

        def settle() -> None:
            nonlocal waiting
            current = held[waiting]
            sides = held[:waiting][::-1], held[waiting + 1 :]
            near = [[x.lines for x in side if x.host == current.host and x.host is not None][:NEAR] for side in sides]
            rows.extend(current.rows)
            texts.extend([own_text(current.lines, *near)] * len(current.rows))
            current.rows = []
            waiting += 1
            if waiting > NEAR:
                del held[0]
                waiting -= 1

        def done() -> Iterator[pa.RecordBatch]:
            first, chars = 0, 0
            for k, text in enumerate(texts):
                chars += len(text)
                if chars > BATCH_CHARS or k - first == BATCH_ROWS or k == len(texts) - 1:
                    part = pa.Table.from_batches(rows[first : k + 1]).append_column("text", pa.array(texts[first : k + 1], pa.string()))
                    yield from part.combine_chunks().to_batches()
                    first, chars = k + 1, 0
            rows.clear()
            texts.clear()

        for found, begins in _runs(batches, columns):
            if not begins:
                continue
            held.append(found)
            # A run is whole when another follows.
            while waiting < len(held) - 1 and (len(held) - 1 - waiting >= NEAR or held[waiting].host != found.host):
                settle()
            if len(texts) >= BATCH_ROWS:
                yield from done()
        while waiting < len(held):
            settle()
        yield from done()

    return run


def main_text(pages: DataFrame) -> DataFrame:
    """pages without html, with text; a column text of the input is replaced."""
    columns = [c for c in pages.columns if c not in ("html", "text")]
    kept = pages.select(*columns).schema
    address = F.regexp_replace(F.coalesce(F.lower("url"), F.lit("")), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.when(F.col("url").isNotNull(), F.regexp_extract(address, r"^(?:www\.|m\.)?([^/?#]*)", 1))
    path = F.regexp_extract(address, r"^[^/?#]*([^?#]*?)(?:\.html?)?/?(?:[?#].*)?$", 1)
    # Numbers in a path sort by value: they are led by their length.
    keyed = F.regexp_replace(path, r"(?<![0-9])([0-9])(?![0-9])", "0$1")
    source = pages.select(*columns, host.alias("__host"), keyed.alias("__path"), F.col("html").alias("__html"))
    base = [*columns, "__host", "__path"]
    schema = T.StructType(
        [*source.select(*base).schema, T.StructField("__lines", T.ArrayType(T.StringType())), T.StructField("__own", T.ArrayType(T.BooleanType()))]
    )
    parsed = source.mapInArrow(_parse(base), schema)
    near = ["__host", "__path", F.length("__path"), *[c for c in ("page_id",) if c in columns]]
    ordered = parsed.repartitionByRange(*near).sortWithinPartitions(*near)
    return ordered.mapInArrow(_difference(columns), T.StructType([*kept, T.StructField("text", T.StringType())]))
