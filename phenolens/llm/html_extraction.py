"""Main text of web pages by wrappers that are inferred for each host.

A page's token stream is aligned with the wrapper of its host, a regular
expression without unions: an element that occurs several times in a row of
siblings becomes a repeated group, one that some pages lack an optional group,
and a text that differs between pages a slot. Wrappers merge in any order, so
they are inferred within partitions first, and then by host.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.llm.common import broadcast_if_small, shared_table
from phenolens.llm.url_filters import host

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr math annotation menclose mfrac mi mn mo mover mpadded "
                   "mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover "
                   "semantics".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CONTAINERS = frozenset("html body main article section div table tbody tr td center".split())
#: Elements that an element of the same kind, without an end tag in between, ends.
SIBLING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
           "th": ("tr", "table"), "option": ("select",), "p": ()}

# What isn't part of an article: by element, and by the words of class, id and role.
OTHER_TAGS = frozenset("head nav header footer aside form script style noscript template iframe svg button select "
                       "textarea object canvas audio video dialog menu title".split())
OTHER_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement sponsor sponsored banner promo promotion sidebar side aside menu nav navbar "
    "navigation breadcrumb breadcrumbs footer foot header masthead topbar comment comments reply replies disqus respond "
    "notice notices cookie cookies consent gdpr alert popup modal overlay share sharing social related recommended "
    "newsletter subscribe subscription signup login form search widget toolbar pagination pager copyright disclaimer "
    "complementary contentinfo skip".split())
#: Words of a class that tell how its element is laid out, not what it is ("with-sidebar", "no-comments").
LAYOUT_WORDS = frozenset("with without no not has layout open opened close closed enabled disabled".split())
#: Share of a host's text from which on a name alone doesn't make an element another part of the page.
MOST = 0.5

#: Pages with different texts that must share a text in a slot before it counts as part of the template.
TEMPLATE_PAGES = 5
#: In an article, elements whose text is never a template's.
CONTENT = frozenset("h1 h2 h3 h4 h5 h6 blockquote pre".split())
#: Parts in which a host's partial wrappers are merged first, so that a large host isn't one task's work.
MERGE_PARTS = 64
BROADCAST_BYTES = 32 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z))"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")


def _signature(tag: str, attributes: str) -> tuple[str, bool]:
    """An element's name with its class, id and role (numbers made alike), and whether it isn't article text."""
    names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)).lower() if attributes else ""
    other = tag in OTHER_TAGS or (tag not in ("html", "body", "main", "article") and any(
        not OTHER_WORDS.isdisjoint(words) and LAYOUT_WORDS.isdisjoint(words)
        for words in map(_WORDS.findall, names.split())))
    return tag + ("." + re.sub(r"\d+", "0", " ".join(names.split())) if names.strip() else ""), other


def stream(page: str) -> Iterator[tuple[str, str, bool]]:
    """Token stream of a page: ("open", signature, other), ("close", "", False), ("text", text, False), ("break", "", False).

    Opens and closes of block elements always pair up: missing end tags are added
    where HTML implies them or at the end, stray ones are left out. Inline elements
    leave no token. A document cut off anywhere is read as far as it goes."""
    stack: list[str] = []
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", html.unescape(page[at:]), False
            break
        if m.start() > at:
            yield "text", html.unescape(page[at:m.start()]), False
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                yield "break", "", False
            continue
        if m[1]:
            if tag in INLINE:
                continue
            if tag in stack:
                while True:
                    top = stack.pop()
                    yield "close", "", False
                    if top == tag:
                        break
            elif tag == "p":
                yield "break", "", False
            continue
        if tag in INLINE:
            continue
        if "p" in stack and (tag in SIBLING or tag not in INLINE):  # a block ends an open paragraph
            last = len(stack) - 1 - stack[::-1].index("p")
            if not any(t in ("div", "table", "td", "button", "object") for t in stack[last + 1:]):
                for _ in range(len(stack) - last):
                    yield "close", "", False
                del stack[last:]
        if tag in SIBLING and tag in stack:
            last = len(stack) - 1 - stack[::-1].index(tag)
            if not any(t in SIBLING[tag] for t in stack[last + 1:]):
                for _ in range(len(stack) - last):
                    yield "close", "", False
                del stack[last:]
        signature, other = _signature(tag, m[3])
        yield "open", signature, other
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            yield "close", "", False
            continue
        stack.append(tag)
    for _ in stack:
        yield "close", "", False


# A wrapper's node: s signature, o other, q quantifier (1, ?, +, *), t text (a digest; 1: a slot; 0: none),
# n characters of text, p pages of different texts (digests of TEMPLATE_PAGES of them at most), c children.

def _node(signature: str, other: bool) -> dict:
    return {"s": signature, "o": int(other), "q": "1", "t": 0, "n": 0, "p": [], "c": []}


_NOTHING = hashlib.md5().digest()


def page_wrapper(page: str) -> dict:
    """The wrapper of one page: its tree, where siblings of one signature are already a repeated group.

    Pages are told apart by their text outside of other parts, or by all of it if there is none."""
    root = _node("", False)
    path, texts = [root], [[]]
    own, everything, beside = hashlib.md5(), hashlib.md5(), [False]
    for kind, value, other in stream(page):
        if kind == "open":
            path.append(_node(value, other))
            texts.append([])
            beside.append(other or beside[-1])
        elif kind == "text":
            texts[-1].append(value)
            data = value.strip().encode("utf-8", "surrogatepass")
            if data:
                everything.update(data + b"\n")
                if not beside[-1]:
                    own.update(data + b"\n")
        elif kind == "close":
            _close(path, texts)
            beside.pop()
    while len(path) > 1:
        _close(path, texts)
    _set_text(root, texts[0])
    _set_page(root, [(own if own.digest() != _NOTHING else everything).hexdigest()[:12]])
    return root


def _set_page(node: dict, page: list[str]) -> None:
    node["p"] = page
    for child in node["c"]:
        _set_page(child, page)


def _close(path: list, texts: list) -> None:
    node = path.pop()
    _set_text(node, texts.pop())
    siblings = path[-1]["c"]
    for i, s in enumerate(siblings):
        if s["s"] == node["s"]:
            siblings[i] = _merge(s, node, repeated=True, same_page=True)
            return
    siblings.append(node)


def _set_text(node: dict, parts: list[str]) -> None:
    text = _SPACE.sub(" ", "".join(parts)).strip()
    if text:
        node["t"], node["n"] = hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:12], len(text)


def _quantifier(a: str, b: str, repeated: bool) -> str:
    many, maybe = repeated or a in "+*" or b in "+*", a in "?*" or b in "?*"
    return "*" if many and maybe else "+" if many else "?" if maybe else "1"


def _optional(node: dict) -> dict:
    node["q"] = _quantifier(node["q"], "?", False)
    return node


def _merge(a: dict, b: dict, repeated: bool = False, same_page: bool = False) -> dict:
    """Align two wrappers of one element: children pair by signature in order of their first
    mention, others become optional; texts that differ become a slot. ``repeated``: the two
    are siblings; ``same_page``: they come from one page, which counts once."""
    a["q"] = _quantifier(a["q"], b["q"], repeated)
    a["t"] = a["t"] if a["t"] == b["t"] else 1
    a["n"] += b["n"]
    if not same_page and len(a["p"]) < TEMPLATE_PAGES and a["p"] != b["p"]:
        a["p"] = sorted({*a["p"], *b["p"]})[:TEMPLATE_PAGES]
    elif len(b["p"]) > len(a["p"]):
        a["p"] = b["p"]
    children, at = a["c"], {c["s"]: i for i, c in enumerate(a["c"])}
    met = set()
    position = 0
    for child in b["c"]:
        i = at.get(child["s"])
        if i is None:  # only b has it: insert it after b's last child that a has too
            children.insert(position, _optional(child))
            met.add(child["s"])
            at = {c["s"]: j for j, c in enumerate(children)}
            position += 1
        else:
            children[i] = _merge(children[i], child, same_page=same_page)
            met.add(child["s"])
            position = max(position, i + 1)
    for child in children:
        if child["s"] not in met:
            _optional(child)
    return a


def merge(wrappers: Iterable[dict]) -> dict | None:
    out = None
    for w in wrappers:
        out = w if out is None else _merge(out, w)
    return out


def regular_expression(node: dict) -> str:
    """A wrapper as a readable expression: #T is a slot, =T a text that all pages share."""
    inner = ("#T" if node["t"] == 1 else "=T" if node["t"] else "") + "".join(map(regular_expression, node["c"]))
    return inner if not node["s"] else f"(<{node['s']}>{inner}</>){'' if node['q'] == '1' else node['q']}"


def _weight(node: dict) -> int:
    """Characters of slots in a wrapper that may be article text."""
    return 0 if node["o"] else (node["n"] if node["t"] == 1 or len(node["p"]) < TEMPLATE_PAGES else 0) + sum(map(_weight, node["c"]))


def _tag(signature: str) -> str:
    return signature.split(".")[0]


def _prose(node: dict) -> int:
    """As _weight, whatever the names of elements are, and without lists of blocks (comments, teasers, menus)."""
    if _tag(node["s"]) in OTHER_TAGS:
        return 0
    own = node["n"] if node["t"] == 1 or len(node["p"]) < TEMPLATE_PAGES else 0
    return own + sum(_prose(c) for c in node["c"] if c["q"] in "1?" or not c["c"])


def _has_article(node: dict) -> bool:
    return any(_tag(c["s"]) not in OTHER_TAGS and (_tag(c["s"]) in ("article", "main") or _has_article(c)) for c in node["c"])


def _unmark(wrapper: dict) -> list[str]:
    """Paths of elements that are named like another part of the page but hold the article or most
    of the host's text (and no article stands elsewhere). They count as article text from here on."""
    most = MOST * _prose(wrapper)
    alone = not _has_article(wrapper)
    kept: list[str] = []

    def walk(n: dict, path: str, open_to_text: bool) -> None:
        for c in n["c"]:
            here, tag = f"{path}>{c['s']}", _tag(c["s"])
            if c["o"] and tag not in OTHER_TAGS and c["q"] in "1?" and (
                    _has_article(c) or open_to_text and _prose(c) > most):
                c["o"] = 0
                kept.append(here)
            if not c["o"]:
                walk(c, here, open_to_text or tag in ("article", "main"))

    walk(wrapper, "", alone)
    return kept


def rules(wrapper: dict) -> dict:
    """What extraction needs of a host's wrapper: the path to the article, and the paths of the template's texts.

    The path ends at an article or main element, and leads into another container only
    if that holds all text of its parent that may be the article's."""
    kept = _unmark(wrapper)
    main, node = [], wrapper
    while _tag(node["s"]) not in ("article", "main"):
        total = _weight(node)
        best = max((c for c in node["c"] if _tag(c["s"]) in CONTAINERS), key=_weight, default=None)
        if best is None or not total or _weight(best) < total or best["q"] in "+*":
            break
        main.append(best["s"])
        node = best
    template: list[str] = []

    def walk(n: dict, path: str, article: bool, always: bool) -> None:
        """In an article, only what all pages have and is no heading or quotation may be the template's."""
        here, tag = f"{path}>{n['s']}", _tag(n["s"])
        always = always and n["q"] == "1" or not article
        if n["t"] not in (0, 1) and len(n["p"]) >= TEMPLATE_PAGES and n["q"] in "1?" and not (
                article and (not always or tag in CONTENT)):
            template.append(here)
        for c in n["c"]:
            if not c["o"]:
                walk(c, here, article or tag in ("article", "main"), always)

    if _weight(node):  # else all pages are alike, and their texts aren't a template's
        walk(node, "", False, True)
    return {"main": main, "template": template, "kept": kept}


def extract(page: str, rule: dict | None) -> str:
    """The article of a page: its blocks of text, in page order, joined by one space.

    Without a rule, or if the page lacks the path to the article, everything in the
    page counts that isn't known to be something else."""
    rule = rule or {"main": [], "template": [], "kept": []}
    main, template, kept = rule["main"], set(rule["template"]), set(rule["kept"])
    found = _blocks(page, main, template, kept)
    if found is None:
        found = _blocks(page, [], set(), kept)
    return " ".join(found)


def _blocks(page: str, main: list[str], template: set[str], kept: set[str]) -> list[str] | None:
    path: list[tuple[str, bool]] = []
    blocks: list[str] = []
    part: list[str] = []
    depth, seen = len(main), not main
    here: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(part)).strip()
        part.clear()
        if text and not (template and ">" + ">".join([main[-1] if main else "", *here]) in template):
            blocks.append(text)

    for kind, value, other in stream(page):
        inside = len(path) >= depth and all(p[0] == s for p, s in zip(path, main))
        if kind == "text":
            if inside and not (path and path[-1][1]):
                part.append(value)
        elif kind == "break":
            part.append(" ")
        else:
            flush()
            if kind == "open":
                if other and kept:
                    other = "".join(f">{p[0]}" for p in path) + f">{value}" not in kept
                path.append((value, other or bool(path and path[-1][1])))
            elif path:
                path.pop()
            seen = seen or (len(path) >= depth and all(p[0] == s for p, s in zip(path, main)))
            here = [p[0] for p in path[depth:]]
    flush()
    return blocks if seen else None


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): the wrappers, as JSON, of all hosts, inferred from all their pages.

    A partition's pages of a host are aligned where they are read; partial wrappers,
    whose size follows from the template and not from the pages, are then aligned in
    MERGE_PARTS parts a host and these by host."""
    rows = pages.select(F.coalesce(host(F.col(url_col)), F.lit("")).alias("host"), F.col(html_col).alias("html"))

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partials: dict[str, dict] = {}
        for f in frames:
            for h, page in zip(f["host"], f["html"], strict=True):
                if page:
                    w = page_wrapper(page)
                    partials[h] = _merge(partials[h], w) if h in partials else w
        yield pd.DataFrame([(h, json.dumps(w)) for h, w in partials.items()], columns=["host", "wrapper"])

    def join(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(f["host"].iloc[0], json.dumps(merge(map(json.loads, sorted(f["wrapper"])))))],
                            columns=["host", "wrapper"])

    schema = "host string, wrapper string"
    parts = (rows.mapInPandas(partial, schema).withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(MERGE_PARTS)))
             .groupBy("host", "part").applyInPandas(lambda f: join(f), schema))
    return parts.groupBy("host").applyInPandas(lambda f: join(f), schema)


def extract_main(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 wrappers: DataFrame | None = None) -> DataFrame:
    """(page_id, url, text), one row per row of ``pages``; ``text`` is empty if there is no article.

    A null or empty page has no text; pages without a host share a wrapper. Repeated
    rows get equal texts, other columns are not looked at, and an empty table gives an
    empty one. The rules (one short row a host) are broadcast up to a checked size.
    """
    wrappers = infer(pages, url_col, html_col) if wrappers is None else wrappers

    def to_rules(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"host": f["host"], "rule": [json.dumps(rules(json.loads(w))) for w in f["wrapper"]]})

    known = shared_table(wrappers.mapInPandas(to_rules, "host string, rule string"), "wrapper_rules")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
                        F.coalesce(host(F.col(url_col)), F.lit("")).alias("host"))

    @F.pandas_udf("string")
    def text(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        loaded: dict[str, dict] = {}
        for page, rule in parts:
            out = []
            for p, r in zip(page, rule, strict=True):
                if r is not None and r not in loaded:
                    loaded[r] = json.loads(r)
                out.append(extract(p, loaded.get(r)))
            yield pd.Series(out, dtype=object)

    return rows.join(broadcast_if_small(known, BROADCAST_BYTES, 1024), "host", "left").select(
        "page_id", "url", text("html", "rule").alias("text"))
