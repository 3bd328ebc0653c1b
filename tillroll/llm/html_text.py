"""Main text of web pages by consensus host paths.

1. Each page is parsed once into its containers.  A container's score is the text of its
   blocks outside boilerplate, less what stands in links, plus a share of that of
   the containers inside it; semantic tags and telling class names weigh more.
2. A page votes for the generalised tag-class paths of its best containers (numbers in names
   become ``#``), with weights relative to the best one.  Votes are added up
   by host and path in Spark (pre-aggregated, so a host may hold any share of the pages); every voted path counts.
3. Each page's own paths are joined with the votes by (host, path).  The path with the greatest product of the
   host's trust in it, its votes over one more than the host's pages that have text there (so a container around
   many templates gains nothing from their number), and the root of the page's own score wins; pages are read again and the text
   comes from the best container on it.

Boilerplate (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
comments of readers) is told by tag, role, class and id, and by being hidden.  A class or id tells it only if
all its parts do (``site-header``, but neither ``has-sidebar`` nor ``share-price``), and neither a
name nor a form counts where the page's ``main`` element stands inside, or where hardly any plain text is left outside of it.

Result: the container's blocks in page order, one per line; white space in a
block, line-break tags included, is one space; character references are decoded.

Defined results: a null or empty page, and one without text, gives the empty text; a null or unparsable url is
the host ''; repeated rows are pages of their own (each votes, all get the same text); of paths with equal products the
first by name wins; very long pages are read whole; other columns are ignored, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import byte_slices, materialize

#: Share of a container's score that counts for the one around it; what a vote must have of the best.
INHERITED, VOTES_FROM = 0.7, 0.5
#: A suspect is main text after all if so many characters of plain text stand in it, and at most this share of them outside of any.
RESCUED_FROM, OUTSIDE = 250, 0.1
#: Readings of a page after which names tell nothing any more.
READINGS = 8
#: Parts that the votes of one (host, path) are spread over in the join with pages.
SALTS = 16
BROADCAST_BYTES = 32 << 20

_MARK = re.compile(r"""<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+)(/?)>)""")
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Za-z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul
    caption head""".split())
CONTAINERS = frozenset("article body div main section td".split())
#: Start tags that end an open element of these kinds, if it is not outside of the stop tags.
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
        "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
        "option": ("option", ("select",))}
ENDS = {k: (frozenset(a.split()), frozenset(b)) for k, (a, b) in ENDS.items()}
SCOPE = frozenset("button td th table body html".split())

SKIPPED = frozenset("""aside audio button canvas dialog footer head header iframe input label math menu nav noscript object
    script select style svg template textarea title video""".split())
SKIPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
SKIPPED_NAMES = frozenset("""ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment
    comments consent cookie cookies discussion disqus footer header login masthead menu modal nav navbar navigation
    newsletter notice notices notification pager pagination popup promo promotion recommended related reply replies respond
    search share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar topbar widget""".split())
GOOD_NAMES = frozenset("article articlebody body content entry main page post prose story text".split())
#: Parts of a name that say nothing against boilerplate beside them.
NEUTRAL_NAMES = GOOD_NAMES | frozenset("""area bar block bottom box btn button buttons column col container desktop fixed floating form
    global google group icons inner inline item items left link links list mobile module outer panel post posts primary right
    row secondary section site slot sticky the top unit user view wrap wrapper""".split())


class Suspect:
    """An outermost element that its names tell to be boilerplate: where it begins, and what stands in it."""

    __slots__ = ("at", "plain", "main")

    def __init__(self, at):
        self.at, self.plain, self.main = at, 0, False


class Element:
    __slots__ = ("tag", "path", "skip", "suspect", "weight", "own", "links", "inner", "parent", "container")

    def __init__(self, tag, path, skip, suspect, weight, parent, container):
        self.tag, self.path, self.skip, self.suspect, self.weight = tag, path, skip, suspect, weight
        self.own = self.links = 0
        self.inner = 0.0
        self.parent, self.container = parent, container


def _names(attributes: str) -> tuple[str, set[str], bool, bool, bool]:
    """Generalised class part of a path, the words of class and id, whether the element is boilerplate for sure, whether
    its names say so, whether it is main."""
    if not attributes or attributes.isspace():
        return "", set(), False, False, False
    values = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    label = values.get("class", "")
    tokens = f"{label} {values.get('id', '')}".split()
    words = {w for t in tokens for w in _NAME.findall(t)}
    suspect = any(_is_boilerplate(t) for t in tokens) if words & SKIPPED_NAMES else False
    role = values.get("role", "")
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
    path = "".join("." + re.sub(r"[0-9]+", "#", c) for c in sorted(label.split())[:3])
    return path, words, hidden or role in SKIPPED_ROLES, suspect, role == "main"


def _is_boilerplate(token: str) -> bool:
    """Whether all parts of one class or id tell boilerplate or nothing, and one does."""
    parts = {w for w in _NAME.findall(token) if w.isalpha()}
    return bool(parts & SKIPPED_NAMES) and parts <= SKIPPED_NAMES | NEUTRAL_NAMES


def parse(html: str) -> tuple[list[Element], list[tuple[Element, str]]]:
    """All containers outside boilerplate, and the text blocks (nearest container, text) in page order.

    The page is read again without suspicion of an element that holds its main text.
    """
    trusted: set[int] | None = set()
    for k in range(READINGS + 1):
        containers, blocks, suspects = _read(html, trusted if k < READINGS else None)
        outside = sum(map(_plain, containers))
        found = {s.at for s in suspects if s.main}
        if not found and suspects:
            largest = max(suspects, key=lambda s: s.plain)
            total = outside + sum(s.plain for s in suspects)
            if largest.plain >= RESCUED_FROM and outside <= OUTSIDE * total:
                found = {largest.at}
        if not found:
            break
        trusted |= found
    return containers, blocks


def _read(html: str, trusted: set[int] | None) -> tuple[list[Element], list[tuple[Element, str]], list[Suspect]]:
    """One reading; elements that begin at a place in ``trusted`` are under no suspicion, nor is any where it is ``None``."""
    suspects: list[Suspect] = []
    root = Element("html", "", False, None, 1.0, None, True)
    stack, containers, blocks = [root], [root], []
    text: list[str] = []
    linked, at, depth = 0, 0, 0

    def flush():
        nonlocal linked
        if text:
            line = " ".join(unescape("".join(text)).split())
            text.clear()
            if line:
                holder = stack[-1]
                while not holder.container:
                    holder = holder.parent
                holder.own += len(line)
                holder.links += min(linked, len(line))
                blocks.append((holder, line))
        linked = 0

    def close(k):
        """Ends the elements from stack position ``k`` on."""
        nonlocal depth
        while len(stack) > k:
            e = stack[-1]
            if e.tag in BLOCKS:
                flush()
            elif e.tag in ("td", "th"):
                text.append(" ")
            depth -= e.tag == "a"
            stack.pop()

    find, size = _MARK.search, len(html)
    while at < size:
        m = find(html, at)
        stop = m.start() if m else size
        if stop > at and not stack[-1].skip:
            piece = html[at:stop]
            if stack[-1].suspect is not None:
                stack[-1].suspect.plain += 0 if depth else len(piece.strip())
            else:
                text.append(piece)
                if depth:
                    linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        if m[1]:
            end = html.find("-->", at)
            at = size if end < 0 else end + 3
            continue
        if m[2]:
            end = html.find(">", at)
            at = size if end < 0 else end + 1
            continue
        tag = m[4].lower()
        if m[3]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if stack[k].tag in ("td", "th", "table") and tag not in BLOCKS and tag not in ("td", "th", "table"):
                    break
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            stop = end.start() if end else size
            at = size if not end else html.find(">", stop) + 1 or size
            continue
        if tag in BLOCKS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in SCOPE or stack[k].tag in CONTAINERS:
                    break
            flush()
        if tag in ENDS:
            ended, limit = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in limit:
                    break
                if stack[k].tag in ended:
                    close(k)
                    if tag != "tr" or stack[-1].tag not in ended:
                        break
        if tag in VOID or m[6] and tag not in BLOCKS:
            continue
        if tag in ("html", "body"):
            if tag == "body" and all(e.tag != "body" for e in stack):
                close(1)
            elif tag == "html" or any(e.tag == "body" for e in stack):
                continue
        label, words, boiler, named, main = _names(m[5])
        above = stack[-1]
        skip = above.skip or tag in SKIPPED or boiler and tag != "body"
        suspect = above.suspect
        if suspect is not None:
            suspect.main |= not skip and (tag == "main" or main)
        elif (named or tag == "form") and not skip and tag != "body" and trusted is not None and m.start() not in trusted:
            suspect = Suspect(m.start())
            suspect.main = tag == "main" or main
            suspects.append(suspect)
        container = tag in CONTAINERS and not (tag == "section" and not label)
        weight = 1.5 if tag in ("article", "main") or main else 1.25 if words & GOOD_NAMES else 1.0
        e = Element(tag, f"{above.path}/{tag}{label}" if container or tag in BLOCKS else above.path, skip, suspect, weight,
                    above, container)
        stack.append(e)
        depth += tag == "a"
        if container and not skip and suspect is None:
            containers.append(e)
    close(1)
    flush()
    for e in reversed(containers):  # inner ones come after outer ones
        if e.parent is not None:
            holder = e.parent
            while not holder.container:
                holder = holder.parent
            holder.inner += INHERITED * (_plain(e) + e.inner)
    return containers, blocks, suspects


def _plain(e: Element) -> float:
    return max(0, e.own - 1.5 * e.links)


def score(e: Element) -> float:
    return e.weight * (_plain(e) + e.inner)


def paths(html: str | None) -> list[tuple[str, int, float]]:
    """(path, vote in thousandths, score) of the best container on each path of the page that has plain text; only the
    best containers vote."""
    containers, _ = parse(html or "")
    by_path: dict[str, float] = {}
    for e in containers:
        by_path[e.path] = max(by_path.get(e.path, 0.0), score(e))
    best = max(by_path.values())
    return [(p, int(1000 * s / best) if s >= VOTES_FROM * best else 0, s) for p, s in by_path.items() if s > 0]


def extract(html: str | None, path: str | None) -> str:
    """The page's main text, from the best container on ``path``, or of all where the page has none there."""
    containers, blocks = parse(html or "")
    if not blocks:
        return ""
    chosen = max((e for e in containers if e.path == path), key=score, default=None) or max(containers, key=score)
    lines, inside = [], {}
    for holder, line in blocks:
        if holder not in inside:
            e = holder
            while e is not None and e is not chosen:
                e = e.parent
            inside[holder] = e is not None
        if inside[holder]:
            lines.append(line)
    return "\n".join(lines)


def _pages(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select("page_id", "url", host.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def _keyed(pages: DataFrame) -> DataFrame:
    """``_pages`` with what stands for the markup in the tables of paths: pages of one host with the same share their path."""
    return _pages(pages).withColumns({"page": F.xxhash64("html"), "size": F.octet_length("html")})


def page_paths(pages: DataFrame) -> DataFrame:
    """Written once: ``host``, ``page``, ``size``, and each ``path`` of a page with its ``vote`` and ``score``."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "html"):
            found = [paths(x) for x in batch.column(3).to_pylist()]
            row = pa.array([k for k, f in enumerate(found) for _ in f], pa.int64())
            path, vote, points = zip(*(x for f in found for x in f)) if len(row) else ((),) * 3
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(row) for k in range(3)), pa.array(path, pa.string()), pa.array(vote, pa.int64()),
                 pa.array(points, pa.float64())], names=["host", "page", "size", "path", "vote", "score"])

    rows = _keyed(pages).select("host", "page", "size", "html")
    return materialize(rows.mapInArrow(look, "host string, page long, size int, path string, vote long, score double"), "page_paths")


def chosen_paths(pages: DataFrame) -> DataFrame:
    """Written once: ``host``, ``page``, ``size``, ``path``: the path that the text of such a page comes from.

    One path of one host may stand on a large share of all pages: its votes are
    added up before the shuffle, and the trust in it is repeated for ``SALTS`` parts of the pages.
    """
    found = page_paths(pages)
    total = found.groupBy("host", "path").agg(F.sum("vote").alias("votes"), F.count("*").alias("n")).where("votes > 0")
    total = total.select("host", "path", (F.col("votes") / (F.col("n") + 1)).alias("trust")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = found.withColumn("salt", F.pmod("page", F.lit(SALTS)).cast("int"))
    order = F.struct((-F.col("trust") * F.sqrt("score")).alias("value"), "path")
    return materialize(salted.join(total, ["host", "path", "salt"]).groupBy("host", "page", "size")
                       .agg(F.min_by("path", order).alias("path")), "chosen_paths")


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of each row of ``pages``."""
    chosen = chosen_paths(pages)
    size = chosen.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64)).first()[0] or 0
    rows = _keyed(pages).join(F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen, ["host", "page", "size"], "left").select(
        "page_id", "url", "path", "html")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "html"):
            text = [extract(x, p) for p, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()),
                                              pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return rows.mapInArrow(read, T.StructType([*rows.schema.fields[:2], *fields]))
