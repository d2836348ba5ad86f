"""Main text of web pages, by the wrapper of their host.

A page is a tree of boxes and texts.  The wrappers of all different pages of a
host are aligned with each other until one is left (see ``wrapper``).  Every
page is then walked along its host's wrapper, which gives each text a place,
and the texts of a place are counted over all pages: what most articles share
at a place, inside a repeated group too, is template, and the box whose slots
hold the text that varies is where pages without an article have their main
text.  Names of tags and classes tell menus, adverts and comments, which vary as
well, from an article; they never count for what the article itself is in.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .components import looked_up
from .wrapper import Body, Part, Places, expression, folded, from_json, merged, to_json

# A text is template at a place if so many different articles have it there, and half of the pages that have the place.
SAME_TEXT_PAGES = 4
TEMPLATE_SHARE = 0.5
# The main box holds this share of the text that varies; of several articles those count that are a quarter as long as the longest.
MAIN_SHARE = 0.9
ARTICLE_SHARE = 0.25
# Boxes that are nested deeper have no places of their own; their texts belong to the box at this depth.
DEEPEST = 60
# Different pages, or wrappers, of a host that are aligned in one group.
FAN = 64

BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre caption figcaption summary legend option label button title address".split())
CONTAINERS = frozenset(
    "html head body div section article main nav header footer aside ul ol dl table thead tbody tfoot tr form fieldset "
    "figure details dialog menu blockquote center select".split()
)
NEVER = frozenset("head nav footer aside dialog menu select button option label".split())
UNLESS_AROUND = frozenset("form fieldset header".split())
SKIPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead cookie cookies consent notice notices popup modal overlay newsletter subscribe signup login search share sharing social "
    "comment comments reply replies respond disqus related recommended recommendations widget widgets pagination pager copyright legal alert "
    "skip toolbar contentinfo complementary dialog hidden".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|textarea|iframe|math|object|canvas)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+")


def label_of(name: str, attributes: str) -> str:
    """A container's name with its class, id and role, which tell containers of a template apart."""
    if not attributes.strip():
        return name
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in NAMES.finditer(attributes)}
    return " ".join([name, *(f"{k}={' '.join(found[k].split())}" for k in ("class", "id", "role", "hidden") if k in found)])




def named(label: str) -> bool:
    """True for a box whose class, id or role speaks of a menu, a notice, comments and the like, and for hidden ones."""
    name, _, rest = label.partition(" ")
    return bool(rest) and (" hidden=" in label or any(w in SKIPPED_NAMES for w in WORDS.findall(rest)))


@dataclass
class Page:
    """Boxes by number, the page itself being 0, and texts; children are boxes, or ~text, in order."""

    labels: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    kids: list[list[int]] = field(default_factory=lambda: [[]])
    tags: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    inside: list[int] = field(default_factory=list)

    def key(self, kid: int) -> tuple[str, bool]:
        return (self.labels[kid], False) if kid >= 0 else (self.tags[~kid], True)


def parsed(page: str) -> Page:
    """The boxes and texts of a page.

    White space in a text is one blank.  Tags that are left open are closed
    where an outer one closes or the page ends; other tags are part of the text.
    """
    out = Page()
    stack: list[tuple[str, int]] = []
    still_open: Counter[str] = Counter()
    parts: list[str] = []
    block = "#"
    box = 0

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.kids[box].append(~len(out.texts))
                out.tags.append(block)
                out.texts.append(text)
                out.inside.append(box)

    def close() -> str:
        nonlocal box
        name, box = stack.pop()
        still_open[name] -= 1
        return name

    at = 0
    for found in TOKEN.finditer(page):
        if found.start() > at:
            parts.append(page[at : found.start()])
        at = found.end()
        name = (found[3] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            flush()
            block = "#" if found[2] else name
        elif name in CONTAINERS:
            flush()
            block = "#"
            if not found[2]:
                if name == "body":
                    while stack and stack[-1][0] != "html":
                        close()
                stack.append((name, box))
                still_open[name] += 1
                if len(stack) <= DEEPEST:
                    out.kids[box].append(len(out.labels))
                    out.parents.append(box)
                    box = len(out.labels)
                    out.labels.append(label_of(name, found[4]))
                    out.kids.append([])
            elif still_open[name]:
                while close() != name:
                    pass
        elif name in ("br", "hr"):
            parts.append(" ")
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def page_wrapper(page: Page) -> Body:
    """The wrapper of one page."""
    bodies: list[Body] = [Body()] * len(page.labels)
    # a box comes after the one it is in
    for box in range(len(page.labels) - 1, -1, -1):
        bodies[box] = folded([Part(page.labels[k], bodies[k]) if k >= 0 else Part(page.tags[~k]) for k in page.kids[box]])
    return bodies[0]


def page_places(page: Page, places: Places) -> tuple[list[int], list[int]]:
    """The place of each box and of each text in the wrapper; -1 for the page itself and what the wrapper lacks."""
    of_boxes, of_texts = [-1] * len(page.labels), [-1] * len(page.texts)
    for box, kids in enumerate(page.kids):
        if box and of_boxes[box] < 0:
            continue
        for kid, place in zip(kids, places.walk(of_boxes[box], [page.key(k) for k in kids]), strict=True):
            if kid >= 0:
                of_boxes[kid] = place
            else:
                of_texts[~kid] = place
    return of_boxes, of_texts


def mark(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def skipped_boxes(labels: list[str], parents: list[int], around: set[int], articles: set[int]) -> list[bool]:
    """Which boxes are no content: by their own name or that of a box around them; ``around`` the main part only by ``NEVER``."""
    out: list[bool] = []
    in_article: list[bool] = []
    for k, label in enumerate(labels):
        parent = parents[k]
        name = label.partition(" ")[0]
        inner = parent >= 0 and in_article[parent]
        bad = name in NEVER or (k not in around and ((name in UNLESS_AROUND and not (name == "header" and inner)) or named(label)))
        out.append((parent >= 0 and out[parent] and k not in around) or (bad and k not in articles))
        in_article.append(inner or k in articles)
    return out


def above(box: int, parents: list[int]) -> set[int]:
    out = set()
    while box >= 0:
        out.add(box)
        box = parents[box]
    return out


def main_box(labels: list[str], parents: list[int], sizes: list[int]) -> tuple[int, list[bool]]:
    """The innermost box that holds ``MAIN_SHARE`` of the text, and which boxes are skipped; -1 if it is the page.

    ``sizes`` is the text directly in each box.  Boxes come after the ones they are in.
    """
    around: set[int] = set()
    main = -1
    while True:
        skip = skipped_boxes(labels, parents, around, set())
        within = [main < 0 or k == main for k in range(len(labels))]
        whole = [0] * len(labels)
        raw = [0] * len(labels)
        for k in range(len(labels)):
            within[k] = within[k] or (parents[k] >= 0 and within[parents[k]])
        for k in range(len(labels) - 1, -1, -1):
            raw[k] += sizes[k] if within[k] else 0
            whole[k] += sizes[k] if within[k] and not skip[k] else 0
            if parents[k] >= 0:
                raw[parents[k]] += raw[k]
                whole[parents[k]] += whole[k]
        kids = [k for k in range(len(labels)) if parents[k] == main] if main >= 0 else [k for k in range(len(labels)) if parents[k] < 0]
        total = whole[main] if main >= 0 else sum(whole[k] for k in kids)
        step = next((k for k in kids if total and whole[k] >= MAIN_SHARE * total), None)
        if step is None and not total:
            # all text is in a box whose name speaks against it
            everything = raw[main] if main >= 0 else sum(raw[k] for k in kids)
            step = next((k for k in kids if everything and raw[k] >= MAIN_SHARE * everything and labels[k].partition(" ")[0] not in NEVER), None)
        if step is None:
            return main, skip
        main = step
        around.add(step)


@dataclass
class Site:
    """What is known of a host: its wrapper's places, the texts fixed there and the text that varies."""

    places: Places
    fixed: set[tuple[int, int]]
    main: int

    @classmethod
    def read(cls, known: str) -> Site:
        (wrapper,), fixed, sizes = json.loads(known)
        places = Places(from_json(wrapper))
        direct = [0] * (len(places.labels) + 1)
        for place, size in sizes:
            direct[places.parents[place] + 1] += size
        # place 0 here is the page itself
        labels = ["#page"] + [x if box else "#text" for x, box in zip(places.labels, places.box, strict=True)]
        main, _ = main_box(labels, [-1] + [p + 1 for p in places.parents], direct)
        return cls(places, {(p, m) for p, m in fixed}, main - 1)


def main_texts(page: Page, site: Site) -> list[str]:
    """Texts of the page's article, or else of the box that is main on its host; template texts go.

    Of articles, or main elements if there are none, the longest counts, ten
    times less if its surroundings speak against it, and what else is a quarter
    as long.  A page with nothing at its host's main place has its own looked for.
    """
    of_boxes, of_texts = page_places(page, site.places)
    free = [(p, mark(t)) not in site.fixed for p, t in zip(of_texts, page.texts, strict=True)]
    for keep in (free, [True] * len(page.texts)):
        picked = article_texts(page, keep) or region_texts(page, keep, of_boxes, site.main)
        if picked:
            return [page.texts[k] for k in picked]
    return []


def sizes_in(page: Page, keep: list[bool]) -> list[int]:
    out = [0] * len(page.labels)
    for box, text, wanted in zip(page.inside, page.texts, keep, strict=True):
        out[box] += len(text) if wanted else 0
    return out


def left(page: Page, k: int) -> bool:
    return page.tags[k] not in NEVER and page.tags[k] != "title"


def article_texts(page: Page, keep: list[bool]) -> list[int]:
    names = [x.partition(" ")[0] for x in page.labels]
    for wanted in ("article", "main"):
        if wanted not in names:
            continue
        owner = [-1] * len(names)
        for k, name in enumerate(names):
            above_it = owner[page.parents[k]] if k else -1
            owner[k] = above_it if above_it >= 0 else (k if name == wanted else -1)
        outer = {k for k in owner if k >= 0}
        inner = skipped_boxes(page.labels, page.parents, set().union(*(above(k, page.parents) for k in outer)), outer)
        plain = skipped_boxes(page.labels, page.parents, set(), set())
        # an article in a menu, a footer or an aside is none
        lengths = dict.fromkeys(outer, 0.0)
        for box, size in enumerate(sizes_in(page, [a and left(page, k) for k, a in enumerate(keep)])):
            if owner[box] >= 0 and not inner[box]:
                lengths[owner[box]] += size
        for k in outer:
            if any(names[x] in NEVER for x in above(k, page.parents)):
                lengths[k] = 0
        against = {k for k in outer if plain[page.parents[k]]}
        scores = {k: size / 10 if k in against else size for k, size in lengths.items()}
        best = max(outer, key=lambda k: (scores[k], -k))
        if not scores[best]:
            continue
        around = above(best, page.parents)
        skip = skipped_boxes(page.labels, page.parents, around, outer)
        near = {k for k in outer if scores[k] >= ARTICLE_SHARE * scores[best] and not skip[page.parents[k]]} | {best}
        return [k for k, box in enumerate(page.inside) if owner[box] in near and not inner[box] and keep[k] and left(page, k)]
    return []


def region_texts(page: Page, keep: list[bool], of_boxes: list[int], main: int) -> list[int]:
    usable = [a and left(page, k) for k, a in enumerate(keep)]
    here = next((k for k, place in enumerate(of_boxes) if place == main and (k or main < 0)), None)
    for start in (here, None):
        if start is None:
            start, skip = main_box(page.labels, page.parents, sizes_in(page, usable))
            start = max(start, 0)
        else:
            skip = skipped_boxes(page.labels, page.parents, above(start, page.parents), set())
        # a wrapper's repeated box may be there several times on a page
        same = {k for k, place in enumerate(of_boxes) if place == of_boxes[start] and place >= 0} | {start}
        inside = [False] * len(page.labels)
        for k in range(len(page.labels)):
            inside[k] = k in same or (k > 0 and inside[page.parents[k]])
        picked = [k for k, box in enumerate(page.inside) if usable[k] and inside[box] and not skip[box]]
        if picked:
            return picked
    return []


def shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, wrapper) of the pages of a batch, different ones once."""
    for batch in batches:
        found = {
            (host, to_json(page_wrapper(parsed(page.as_py() or "")))) for host, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True)
        }
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.string()) for x in zip(*sorted(found), strict=True)], names=["host", "wrapper"])


def aligned(group: pa.Table) -> pa.Table:
    """One wrapper of all in a group, aligned in a fixed order, richest first."""
    out: Body | None = None
    for text in sorted(set(group.column("wrapper").to_pylist()), key=lambda x: (-len(x), x)):
        out = from_json(text) if out is None else merged(out, from_json(text))
    return pa.table({"host": pa.array([group.column("host")[0].as_py()], pa.string()), "wrapper": pa.array([to_json(out)], pa.string())})


def host_of(url: Column) -> Column:
    """The lower-cased host of a url, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrapper of all pages of each host.

    Different pages of a host are dealt into groups of some ``FAN``, aligned, and
    the wrappers of the groups likewise, until there is one.  A wrapper has a
    bounded number of parts per label, so a group is one task's work whatever
    the host's size.
    """
    streams = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    left_over = settle(streams.mapInArrow(shaped, "host string, wrapper string").distinct())
    while True:
        counts = left_over.groupBy("host").agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return left_over
        dealt = looked_up(left_over, counts, "host")
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / FAN)))
        groups = dealt.select("host", "wrapper", "part").groupBy("host", "part")
        left_over = settle(groups.applyInArrow(lambda t: aligned(t), "host string, wrapper string").distinct())


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, place, text, pages, size, first, longest, last) of texts, and of places with a null text.

    The last three tell articles apart: one bit each, of 64, for the page's
    first, longest and last text but this one, outside menus and the like.
    """
    sites: dict[str, Places] = {}
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["host", "place", "text", "pages", "size", "first", "longest", "last"]
    for batch in batches:
        totals: dict[tuple, list[int]] = {}
        for host, wrapper, source in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), batch.column("html"), strict=True):
            if wrapper not in sites:
                if len(sites) > 1000:
                    sites.clear()
                sites[wrapper] = Places(from_json(wrapper))
            page = parsed(source.as_py() or "")
            _, of_texts = page_places(page, sites[wrapper])
            skip = skipped_boxes(page.labels, page.parents, set(), set())
            marks = [mark(t) for t in page.texts]
            own = [k for k, box in enumerate(page.inside) if not skip[box] and left(page, k)] or list(range(len(marks)))
            if not own:
                continue
            by_length = sorted(own, key=lambda k: (-len(page.texts[k]), k))
            # the first two different texts of each order, as one of them may be the text that is counted
            firsts = [list(dict.fromkeys(marks[k] for k in order[:8]))[:2] for order in (own, by_length, own[::-1])]
            seen: dict[tuple, int] = {}
            for k, place in enumerate(of_texts):
                seen[host, place, marks[k]] = seen.get((host, place, marks[k]), 0) + len(page.texts[k])
                seen[host, place, None] = seen.get((host, place, None), 0) + len(page.texts[k])
            for key, size in seen.items():
                total = totals.setdefault(key, [0, 0, 0, 0, 0])
                total[0] += 1
                total[1] += size
                for at, order in enumerate(firsts):
                    other = next((x for x in order if x != key[2]), 0)
                    total[2 + at] |= 1 << (other & 63)
        if totals:
            rows = [(*k, *v[:2], *(b - (1 << 64) if b >> 63 else b for b in v[2:])) for k, v in totals.items()]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def sites(pages: DataFrame) -> DataFrame:
    """(host, known): wrapper, template texts by place and size of the text of each place, as JSON (see ``Site``)."""
    known = wrappers(pages)
    rows = pages.select(F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    schema = "host string, place int, text long, pages long, size long, first long, longest long, last long"
    counts = looked_up(rows, known, "host").select("host", "wrapper", "html").mapInArrow(counted, schema)
    bits = [F.bit_or(c).alias(c) for c in ("first", "longest", "last")]
    counts = settle(
        counts.groupBy("host", "place", "text")
        .agg(F.sum("pages").alias("pages"), F.sum("size").alias("size"), *bits)
        # of texts only those that may be template
        .where(F.col("text").isNull() | (F.col("pages") >= SAME_TEXT_PAGES))
    )
    # an article changed in one of the three is still the same
    middle = F.sort_array(F.array(*[F.bit_count(c) for c in ("first", "longest", "last")]))[1]
    texts = counts.where(F.col("text").isNotNull()).where(middle >= SAME_TEXT_PAGES).select("host", "place", "text", "pages", "size")
    at_place = counts.where(F.col("text").isNull()).select("host", "place", F.col("pages").alias("all"), F.col("size").alias("whole"))
    texts = settle(texts.join(at_place, ["host", "place"]).where(F.col("pages") >= TEMPLATE_SHARE * F.col("all")))
    # few texts are on half of the pages each, and a host has as many places as its wrapper has parts
    same = texts.groupBy("host", "place").agg(F.sum("size").alias("same"))
    varies = at_place.join(same, ["host", "place"], "left").withColumn("size", F.col("whole") - F.coalesce("same", F.lit(0)))
    sizes = varies.groupBy("host").agg(F.collect_list(F.array(F.col("place").cast("long"), "size")).alias("sizes"))
    fixed = texts.groupBy("host").agg(F.collect_list(F.array(F.col("place").cast("long"), "text")).alias("fixed"))
    both = known.join(sizes, "host", "left").join(fixed, "host", "left")
    none = F.array().cast("array<array<bigint>>")
    parts = [F.to_json(F.array("wrapper")), *[F.to_json(F.coalesce(c, none)) for c in ("fixed", "sizes")]]
    return both.select("host", F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")).alias("known"))


def expressions(pages: DataFrame) -> DataFrame:
    """(host, expression): the wrappers as regular expressions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [expression(from_json(w)) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(texts, pa.string())], names=["host", "expression"])

    return wrappers(pages).mapInArrow(run, "host string, expression string")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    The text is the article of the whole html, or its main part, or else what
    the box holds whose text varies over the host's pages, without menus,
    headers, footers, sidebars, notices, adverts, forms, comments and template
    (see ``main_texts``).  Blocks are joined by two line feeds.

    A null or empty html, and one without text, gives an empty text; a page
    without a host belongs to the host "".  Markup may be cut off or badly
    nested.  Repeated rows come out alike; an empty table gives no rows; other
    columns are not read.
    """
    known = settle(sites(pages))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    rows = looked_up(rows, known, "host", "left").select("page_id", "url", "html", "known")
    schema = rows.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sites: dict[str, Site] = {}
        for batch in batches:
            texts = []
            for page, known in zip(batch.column("html"), batch.column("known").to_pylist(), strict=True):
                if known not in sites:
                    if len(sites) > 1000:
                        sites.clear()
                    sites[known] = Site.read(known)
                texts.append("\n\n".join(main_texts(parsed(page.as_py() or ""), sites[known])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, schema)
