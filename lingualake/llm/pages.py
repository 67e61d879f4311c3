"""Main text of web pages by wrapper induction over all pages of a host.

The pages of a host are grouped by layout: outlines of their containers, aligned by simple tree matching. Blocks that say
the same at the same path on most pages of a layout, or of the host, are constants; the slots whose text varies hold content, and
their lowest common ancestor is the layout's region. A page's text is what varies in the region, with the constants whose place
is in such a slot: a heading over varying blocks, or a block like the varying ones before and after it. All other constants are template.
Elements and class names that mark navigation, notices and the like are an aid: what they mark is set aside beforehand. Inside an
article or main element such a name counts only if it is the whole name of a container.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small

#: Layouts that match in this share of their nodes are one.
ALIKE = 0.75
#: A varying slot with less of a layout's varying text does not widen the region.
SHARE = 0.02
#: What ends a title, select, button or textarea whose end tag is missing.
_STOP = r"</?(?:head|body|article|main|section|div|p|h[1-6]|ul|ol|dl|table|form|header|footer|nav|aside|pre|blockquote|hr|fieldset)\b"
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe)\b(?:[^>"']|"[^"]*"|'[^']*')*+>.*?(?:</\1\s*>|\Z)|<(title|select|button|textarea)\b(?:[^>"']|"[^"]*"|'[^']*')*+>(?:(?:(?!<\2\b).)*?</\2\s*>|(?:(?!STOP).)*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""".replace("STOP", _STOP), re.S | re.I)
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ASIDE = frozenset("nav footer aside menu dialog".split())
_NAMES = frozenset("ad ads advert adverts advertisement banner cookie cookies consent notice notices comment comments menu nav navbar navigation sidebar promo sponsor sponsored social share sharing related breadcrumb breadcrumbs footer popup modal newsletter subscribe widget".split())
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
#: What may follow a name of _NAMES in the whole name of a container ("comment-list").
_PARTS = frozenset("list box bar wrapper wrap container section block area form inner top bottom left right posts articles links buttons icons".split())
_CONTENT = frozenset("main article content".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTAINER = frozenset("html body article main section div center table tr td".split())
_CLOSES_P = _BLOCK - {"html", "body"}
_GROUPS = frozenset("div section ul ol dl table form figure fieldset".split())


def _set_aside(tag: str, attrs: str, within: bool) -> bool:
    if tag in _ASIDE or tag == "header" and not within:
        return True
    if attrs.strip():
        if tag not in ("html", "body", "article", "main"):
            for m in _ATTR.finditer(attrs):
                name = (m[2] or m[3] or m[4] or "").lower()
                if not within and not _NAMES.isdisjoint(_SPLIT.split(name)):
                    return True
                if within and tag in _GROUPS and any(_whole(word) for word in name.split()):
                    return True
        return bool(_HIDDEN.search(attrs))
    return False


def _whole(word: str) -> bool:
    parts = [x for x in _SPLIT.split(word) if x]
    return not _NAMES.isdisjoint(parts) and all(x in _NAMES or x in _PARTS for x in parts)


def _is_content(tag: str, attrs: str) -> bool:
    return tag in ("article", "main") or any(m[1].lower() != "class" and (m[2] or m[3] or m[4] or "").strip().lower() in _CONTENT for m in _ATTR.finditer(attrs))


def parse(page: str) -> list[tuple[tuple[str, ...], bool, str]]:
    """The blocks of a page in order: (path of elements, set aside, text)."""
    return [(path, aside, text) for path, _, aside, text in placed(page)]


def placed(page: str) -> list[tuple[tuple[str, ...], int, bool, str]]:
    """The blocks of a page in order: (path of elements, number of the element that holds the block's own, set aside, text).

    A form is set aside unless it holds an article, a main element or half of the text that is not set aside.
    """
    out: list = []
    forms: list[int] = []  # of each block the form around it, or 0
    form = number = 0
    stack: list[tuple[str, bool, bool, int]] = []  # tag, set aside, content (as a main element is), number
    text: list[str] = []

    def flush() -> None:
        if text:
            s = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if s:
                held = [(e[0], e[3]) for e in stack if e[0] in _BLOCK]
                out.append((tuple(t for t, _ in held), held[-2][1] if len(held) > 1 else 0, any(e[1] for e in stack), s))
                forms.append(form if any(e[0] == "form" for e in stack) else 0)

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = (m[4] or m[7] or "").lower()
        if not tag:
            continue
        closing, attrs = (m[3] or m[6]) == "/", m[5] or m[8] or ""
        if tag == "br":
            text.append("\n")
        elif tag in ("td", "th"):
            text.append(" ")
        if closing:
            if any(e[0] == tag for e in stack):
                if tag in _BLOCK:
                    flush()
                    while stack.pop()[0] != tag:
                        pass
                else:
                    k = max(i for i, e in enumerate(stack) if e[0] == tag)
                    if not any(e[0] in _BLOCK for e in stack[k + 1 :]):
                        del stack[k]
            continue
        if tag in _BLOCK:
            flush()
            if tag in _CLOSES_P and any(e[0] == "p" for e in stack):
                while stack.pop()[0] != "p":
                    pass
            if tag in ("li", "tr", "dt", "dd"):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ("ul", "ol", "table", "dl"):
                        break
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
        if tag not in _VOID and not attrs.rstrip().endswith("/"):
            aside = _set_aside(tag, attrs, any(e[2] for e in stack))
            if tag == "form" and not any(e[0] == "form" for e in stack):
                form += 1
            if tag in _BLOCK or aside:
                number += 1
                stack.append((tag, aside, _is_content(tag, attrs), number))
    if at < len(page):
        text.append(page[at:])
    flush()
    total = sum(len(t) for _, _, a, t in out if not a)
    inside: dict[int, int] = {}
    for f, (path, _, aside, t) in zip(forms, out):
        if f and not aside:
            held = path[path.index("form") + 1 :]
            inside[f] = inside.get(f, 0) + (total if "article" in held or "main" in held else len(t))
    return [(path, place, aside or f > 0 and 2 * inside.get(f, 0) < total, t) for f, (path, place, aside, t) in zip(forms, out)]


def tree(blocks) -> tuple:
    """(tag, children, text): the DOM of the blocks; neighbouring leaves of one tag are one node, as a list would be."""
    root: tuple = ("#", [], [])
    for path, aside, text in blocks:
        if aside:
            continue
        node = root
        for tag in path:
            if not node[1] or node[1][-1][0] != tag:
                node[1].append((tag, [], []))
            node = node[1][-1]
        node[2].append(text)
    return root


def match(a: tuple, b: tuple) -> tuple[int, list]:
    """Simple tree matching: size of the largest order-preserving matching, and its pairs of nodes.

    Nodes stand on a list of their own, children before parents, so that pages may nest as deep as they like."""
    if a[0] != b[0]:
        return 0, []
    todo = [(a, b)]
    for x, y in todo:
        todo += [(c, d) for c in x[1] for d in y[1] if c[0] == d[0]]
    sizes: dict = {}
    chosen: dict = {}
    for x, y in reversed(todo):
        m, n = len(x[1]), len(y[1])
        w = [[sizes.get((id(c), id(d)), 0) for d in y[1]] for c in x[1]]
        best = np.zeros((m + 1, n + 1), int)
        for i in range(m):
            for j in range(n):
                best[i + 1, j + 1] = max(best[i + 1, j], best[i, j + 1], best[i, j] + w[i][j])
        got, i, j = [], m, n
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                got.append((x[1][i - 1], y[1][j - 1]))
                i, j = i - 1, j - 1
        sizes[id(x), id(y)], chosen[id(x), id(y)] = int(best[m, n]) + 1, got
    pairs = [(a, b)]
    for x, y in pairs:
        pairs += chosen[id(x), id(y)]
    return sizes[id(a), id(b)], pairs


def layout(paths) -> str:
    """The containers of a page as an outline: under each element every tag once, in the order of its first use."""
    root: dict = {}
    for path in paths:
        node = root
        for tag in path:
            if tag in _CONTAINER:
                node = node.setdefault(tag, {})
    out, open_ = [], [iter(root.items())]
    while open_:
        tag, inner = next(open_[-1], ("", None))
        if inner is None:
            open_.pop()
            out.append(")")
        else:
            out.append(f"{tag}(")
            open_.append(iter(inner.items()))
    return "".join(out[:-1])


def outline(shown: str, known: dict[tuple[int, str], int]) -> tuple[tuple, set[int]]:
    """A layout as a tree to match, and the numbers of its paths; known holds the number of every path met so far."""
    root: tuple = ("#", [], [])
    stack, at = [root], [0]
    paths = {0}
    for tag in re.findall(r"[a-z0-9]+|\)", shown):
        if tag == ")":
            stack.pop()
            at.pop()
        else:
            node = (tag, [], [])
            stack[-1][1].append(node)
            stack.append(node)
            at.append(known.setdefault((at[-1], tag), len(known) + 1))
            paths.add(at[-1])
    return root, paths


def group_layouts(layouts: list[str]) -> list[str]:
    """For each layout the first of them whose tree matches in ALIKE of the nodes of both."""
    leaders: list = []
    known: dict = {}
    out = []
    for shown in layouts:
        root, own = outline(shown, known)
        for name, other, theirs in leaders:
            least = ALIKE * (len(own) + len(theirs)) / 2
            # no more nodes than common paths can match
            if len(own & theirs) >= least and match(root, other)[0] >= least:
                out.append(name)
                break
        else:
            leaders.append((shown, root, own))
            out.append(shown)
    return out


def region_of(slots: list[tuple[str, int]]) -> str:
    """The lowest common ancestor of the varying slots (path, characters) which hold a main heading or SHARE of the text."""
    total = sum(n for _, n in slots)
    paths = [p.split("/") for p, n in slots if n >= SHARE * total or p.rsplit("/", 1)[-1] == "h1"]
    common = []
    for tags in zip(*paths):
        if len(set(tags)) > 1:
            break
        common.append(tags[0])
    while common and common[-1] not in _CONTAINER:
        common.pop()
    return "/".join(common)


def main_text(blocks: list[tuple[str, str]], region: str | None) -> str:
    """The text of (path, text) blocks in a region; without one, or with nothing in it, of article, main or all blocks."""
    inside = [lambda p: "/article/" in p, lambda p: "/main/" in p]
    if region is not None:
        inside.insert(0, lambda p: not region or p.startswith(f"/{region}/"))
    for test in inside:
        found = [t for p, t in blocks if test(f"/{p}/")]
        if found:
            return "\n\n".join(found)
    return "\n\n".join(t for _, t in blocks)


def in_slots(paths: list[str], places: list[int], constant: list[bool]) -> list[bool]:
    """Of each block whether it is content: it varies, or it is a constant in a slot of varying blocks.

    Such a slot are the blocks of one element: a heading with a varying block after it belongs to it, another block if a varying
    one comes before it and one after it and one of them has its tag.
    """
    around: dict[int, tuple[int, int, set[str]]] = {}
    for k, (path, place, same) in enumerate(zip(paths, places, constant)):
        if not same:
            first, _, tags = around.get(place, (k, k, set()))
            around[place] = first, k, tags | {path.rsplit("/", 1)[-1]}

    def held(k: int) -> bool:
        first, last, tags = around.get(places[k], (len(paths), -1, set()))
        tag = paths[k].rsplit("/", 1)[-1]
        return k < last and (tag in _HEADINGS or first < k and tag in tags)

    return [not same or held(k) for k, same in enumerate(constant)]


def _parsed(rows: DataFrame) -> DataFrame:
    """Of each row (page_id, url, host, html) its blocks that are not set aside, its layout, and a hash of them all."""

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for h in b.column(3):
                blocks = [(path, place, t) for path, place, aside, t in placed(h.as_py() or "") if not aside]
                paths = ["/".join(path) for path, _, _ in blocks]
                hashes = [_hash(f"{p}\n{t}") for p, (_, _, t) in zip(paths, blocks)]
                for x, v in zip(out, (layout(path for path, _, _ in blocks), _hash(str(hashes)), paths, [n for _, n, _ in blocks], hashes, [t for _, _, t in blocks])):
                    x.append(v)
            kinds = pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), b.column(2), *(pa.array(x, k) for x, k in zip(out, kinds))], ["page_id", "url", "host", "layout", "page", "paths", "places", "hashes", "texts"])

    return rows.select("page_id", "url", "host", "html").mapInArrow(run, "page_id long, url string, host string, layout string, page long, paths array<string>, places array<long>, hashes array<long>, texts array<string>")


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def wrappers(parsed: DataFrame) -> DataFrame:
    """(host, layout, region, constants) from all parsed pages: every host's layouts with their region and template blocks.

    Pages of one host with the same blocks count once. The region is null where a layout has a single page.
    """
    lengths = F.transform("texts", F.length)
    distinct = cut(parsed.where(F.size("hashes") > 0).select("host", "page", "layout", "hashes", "paths", lengths.alias("lengths")).dropDuplicates(["host", "page"]))
    seen = distinct.groupBy("host", "layout").agg(F.count("*").alias("n"))

    def grouped(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "layout"], ascending=[False, True])
        pdf["kind"] = group_layouts(list(pdf["layout"]))
        pdf["n_kind"] = pdf.groupby("kind")["n"].transform("sum")
        pdf["n_host"] = pdf["n"].sum()
        return pdf[["host", "layout", "kind", "n_kind", "n_host"]]

    kinds = cut(seen.groupBy("host").applyInPandas(grouped, "host string, layout string, kind string, n_kind long, n_host long"))
    n_kinds = kinds.count()
    block = F.array_distinct(F.arrays_zip(F.col("hashes").alias("h"), F.col("paths").alias("path"), F.col("lengths").alias("length")))
    one = distinct.join(small(kinds, 4 * n_kinds), ["host", "layout"]).select("host", "kind", "n_kind", "n_host", F.explode(block).alias("b"))
    counts = one.groupBy("host", "kind", "b.h").agg(F.count("*").alias("c"), F.first("b.path").alias("path"), F.first("b.length").alias("length"), F.first("n_kind").alias("n_kind"), F.first("n_host").alias("n_host"))
    counts = counts.withColumn("c_host", F.sum("c").over(Window.partitionBy("host", "h")))

    def template(c: str, n: str):
        return (F.col(c) >= 3) & (2 * F.col(c) > F.col(n))

    counts = cut(counts.withColumn("constant", template("c", "n_kind") | template("c_host", "n_host")))
    constants = counts.where("constant").groupBy("host", "kind").agg(F.sort_array(F.collect_list("h")).alias("constants"))
    slots = counts.where("NOT constant AND n_kind > 1").groupBy("host", "kind", "path").agg(F.sum(F.col("c") * F.col("length")).alias("mass"))
    regions = slots.groupBy("host", "kind").agg(F.collect_list(F.struct("path", "mass")).alias("slots"))

    def lowest(batches):
        for b in batches:
            found = [region_of([(x["path"], x["mass"]) for x in s]) for s in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string())], ["host", "kind", "region"])

    regions = regions.mapInArrow(lowest, "host string, kind string, region string")
    return kinds.join(constants, ["host", "kind"], "left").join(regions, ["host", "kind"], "left").select("host", "layout", "region", "constants")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html).

    Blocks in page order, white space inside a block one space, joined by two line feeds; character references decoded. A
    null or empty page, or one without content, has an empty text; a null url is a host of its own; rows that repeat are each
    extracted; other columns are not read. All pages of a host count towards its wrappers, one for each layout. A block
    is constant if its path and text stand on more than half of the pages of the layout or the host, three at least (two pages
    that share a block may as well be near copies), and template if besides its place is in no slot that varies.
    """
    rows = pages.select("page_id", "url", "html").withColumn("host", F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    parsed = cut(_parsed(rows))
    induced = cut(wrappers(parsed))
    room = induced.agg(F.sum(8 + F.coalesce(F.size("constants"), F.lit(0)))).first()[0] or 0  # in ids, as small() counts
    joined = parsed.join(small(induced, room), ["host", "layout"], "left").select("page_id", "url", "paths", "places", "hashes", "texts", "region", "constants")

    def run(batches):
        for b in batches:
            texts = []
            for r in b.select(["paths", "places", "hashes", "texts", "region", "constants"]).to_pylist():
                known = frozenset(r["constants"] or ())
                keep = in_slots(r["paths"], r["places"], [h in known for h in r["hashes"]])
                texts.append(main_text([(p, t) for p, t, k in zip(r["paths"], r["texts"], keep) if k], r["region"]))
            n = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), n], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
