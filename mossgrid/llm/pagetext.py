"""Main text of web pages with site template removal.

Element subtrees are hashed and counted per host in Spark; a subtree that recurs across different pages of its host is the
site's, not the page's, and is deleted, as are elements whose tag or role says that they are menus, forms and the like, and
hidden ones. A class or id only raises a suspicion. One that is nothing but such words ("cookie-banner") deletes its element
unless that holds most of the page's text; one that has such a word among others ("related-work") needs a second ground,
mostly links or inputs. Readers' comments go even where they are longer than the article, also as articles of their own.
Paragraphs, headings and other prose within the article stand whatever their class and even where pages share them.
Counts are joined back to the subtrees of each page, so a page is compared with its own subtrees only, however many a host has.

A subtree's hash is that of its start tag, its texts and its children's hashes, so all of a page's take one pass. Damaged
pages: an element that nothing closes ends with the page or where the standard's parser ends it; a title, frame or text
area without an end tag is empty, a script or style without one holds the rest of the page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mossgrid.llm.common import kept, pieces, prepare

LEAST_PAGES = 3
PART = 0.01
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Element names of the HTML standard by what they are here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
CODE = frozenset("script style".split())
FOREIGN = frozenset("svg math".split())
DROPPED = RAW | FOREIGN | frozenset("head nav header footer aside form button select option dialog menu object canvas audio video map".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre b i em strong span a u code sub sup small mark q cite br li dd dt td th tr".split())
ENDS_P = BLOCKS - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
ENDS_SAME = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr",)), "th": ("td th", ("tr",)), "option": ("option", ("select",))}
COMMENTS = frozenset("comment comments commentlist commenting reply replies respond disqus".split())
MARKS = COMMENTS | frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination footer header masthead share sharing social related recommended widget toolbar login signup search".split())
#: Words that say nothing beside those; the second list beside those of comments.
PLAIN = frozenset("bar block bottom box column container desktop fixed global group holder inner item items left links list main mobile module outer page panel primary region right row secondary section site slot sticky top unit wrap wrapper".split())
PLAIN_COMMENTS = PLAIN | frozenset("article body entry post reader readers thread user users".split())
INPUTS = frozenset("input select textarea button".split())
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Of the page's text an element may hold, and still go by its marks: three quarters, and for comments all but a twentieth.
MOST, MOST_COMMENTS = 3 / 4, 19 / 20
#: What holds the page or its text; never itself unwanted or the site's.
SHELL = frozenset("html body main article".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())


def words(value: str) -> list[str]:
    return [x for x in re.split(r"[^a-z0-9]+", re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", value).lower()) if x]


def mark(attributes: str) -> str:
    """What an element's attributes say: `drop` for a role or hiding, `comment` or `strong` for a name of such words only, `weak` for one that has such a word, or nothing."""
    found = ""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and HIDING.search(value)) or (name == "role" and value.lower() in ROLES):
            return "drop"
        if name not in ("class", "id"):
            continue
        for token in value.split():
            own = set(words(token))
            if own & COMMENTS and own <= COMMENTS | PLAIN_COMMENTS:
                found = "comment"
            elif own & MARKS and own <= MARKS | PLAIN:
                found = found if found == "comment" else "strong"
            elif own & MARKS:
                found = found or "weak"
    return found


def parse(page: str) -> list:
    """The page's tree: nodes are [tag, mark, start tag, children, hash, text, link text, inputs], children nodes or raw text, the last three numbers of characters and elements. A raw element's start tag is all of it."""
    root = ["html", "", "", [], 0, 0, 0, 0]
    stack, nodes, opened, ends, at, n = [root], [], Counter(), {}, 0, len(page)

    def pop(k: int) -> None:
        opened.subtract(x[0] for x in stack[k:])
        del stack[k:]

    def close(tags: tuple, walls: frozenset | tuple) -> None:
        """Ends the nearest open element of these tags, unless another of walls stands between."""
        if not any(opened[x] for x in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                pop(k)
                return
            if stack[k][0] in walls:
                return

    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            stack[-1][3].append(page[at:])
            break
        if m.start() > at:
            stack[-1][3].append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag]:
                pop(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
            continue
        if tag in ENDS_P:
            close(tuple(FOREIGN), ())
            close(("p",), BLOCKS - {"p"})
        if tag in ENDS_SAME:
            close(tuple(ENDS_SAME[tag][0].split()), ENDS_SAME[tag][1])
        if tag in RAW:
            if tag not in ends:
                ends[tag] = re.compile(rf"</{tag}\s*>", re.I)
            end = ends[tag] and ends[tag].search(page, at)
            if end is None:
                ends[tag] = None  # none further on either
            at = end.end() if end else n if tag in CODE else at
        node = [tag, mark(m[3]) if m[3].strip() else "", page[m.start() : at], [], 0, 0, 0, tag in INPUTS]
        stack[-1][3].append(node)
        nodes.append(node)
        if not (tag in VOID or tag in RAW or m[3].endswith("/")):
            stack.append(node)
            opened[tag] += 1
    for node in reversed(nodes):  # children come before their parents
        h = xxhash.xxh64(" ".join(node[2].split()).encode())
        for x in node[3]:
            h.update(x[4].to_bytes(8, "big", signed=True) if isinstance(x, list) else b" " + " ".join(x.split()).encode())
        node[4] = h.intdigest() - (1 << 63)
    for node in [*reversed(nodes), root]:
        for x in node[3]:
            if isinstance(x, str):
                node[5] += len(x.strip())
            else:
                if (x[0] not in DROPPED or x[0] == "form") and x[1] != "drop":
                    node[5] += x[5]
                    node[6] += x[5] if x[0] == "a" else x[6]
                node[7] += x[7]
    return root


def subtrees(page: str) -> set[int]:
    """Hashes of the subtrees that may be the site's: every element but prose in the article and what surrounds it all."""
    out, todo = set(), [(parse(page), False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node[0] in ("article", "main")
        for x in node[3]:
            if isinstance(x, list):
                if x[0] not in SHELL and x[0] not in ("br", "meta", "link") and not (inside and x[0] in PROSE):
                    out.add(x[4])
                todo.append((x, inside))
    return out


def main_text(page: str, site: frozenset = frozenset()) -> str:
    """Blocks of the article (else the main element, else the page), one a line."""
    root = parse(page)

    def around(x: list) -> bool:
        """Whether a form stands around the page's article or main element, as some servers write it."""
        todo = [x] if x[0] == "form" else []
        while todo:
            found = [y for y in todo.pop()[3] if isinstance(y, list)]
            if any(y[0] in ("article", "main") for y in found):
                return True
            todo.extend(found)
        return False

    def suspect(x: list, inside: bool) -> bool:
        """Whether the marks of a container delete it."""
        if x[1] == "comment" and (x[0] not in SHELL or x[0] == "article"):
            return inside and x[0] == "article" or x[5] <= MOST_COMMENTS * root[5]
        if x[0] in SHELL or x[5] > MOST * root[5]:
            return False
        return x[1] == "strong" or (x[1] == "weak" and (2 * x[6] >= x[5] or x[7] > 0))

    def wanted(x: list, inside: bool) -> bool:
        prose = inside and x[0] in PROSE
        if (x[0] in DROPPED and not around(x)) or (x[1] == "drop" and x[0] not in ("html", "body")) or (x[1] and not prose and suspect(x, inside)):
            return False
        return not (site and not prose and x[0] not in SHELL and x[4] in site)

    def first(tag: str) -> list:
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            for x in reversed(node[3]):
                if isinstance(x, list) and wanted(x, False) and node[0] != tag:
                    todo.append(x)
            if node[0] == tag:
                found.append(node)
        return found

    blocks, run = [], []

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            blocks.append(text)

    for top in first("article") or first("main") or [root]:
        inside = top is not root
        todo = [top]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                run.append(html.unescape(x))
            elif x is None:
                flush()
            elif x is top or wanted(x, inside):
                if x[0] in BLOCKS:
                    flush()
                    todo.append(None)
                todo.extend(reversed(x[3]))
        flush()
    return "\n".join(blocks)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def site_templates(pages: DataFrame, least: int = LEAST_PAGES, part: float = PART) -> DataFrame:
    """(host, page, site): for each different page of (host, page, html), hashes of its subtrees that stand on `least` different pages of the host and on at least `part` of them. Pages without a host have no site."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            found = [(*subtrees(page or ""), None) for page in batch.column("html").to_pylist()]
            at = pa.array([k for k, x in enumerate(found) for _ in x], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("host").take(at), batch.column("page").take(at), pa.array([x for one in found for x in one], pa.int64())], ["host", "page", "tree"])

    trees = pages.where("host <> ''").select("host", "page", "html").mapInArrow(hashes, "host string, page long, tree long").distinct()
    trees = kept(trees, "subtrees")
    seen = trees.groupBy("host", "tree").agg(F.count("*").alias("n"))
    totals = seen.where("tree is null").select("host", F.col("n").alias("pages"))
    sites = seen.where((F.col("n") >= least) & F.col("tree").isNotNull()).join(totals, "host").where(F.col("n") >= part * F.col("pages")).select("host", "tree")
    sites = kept(sites, "templates")  # with a plain table beside it, the rows of a tree on all pages of a host can be split in the join
    return trees.join(sites, ["host", "tree"]).groupBy("host", "page").agg(F.collect_list("tree").alias("site"))


def extract_text(pages: DataFrame, least: int = LEAST_PAGES, part: float = PART) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html). Null or empty html has empty text; a null url has no site. Rows with equal html on a host count as one page."""
    prepare(pages.sparkSession)
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("host")).withColumn("page", F.xxhash64("html"))
    sites = kept(site_templates(pages, least, part), "sites")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [main_text(page, frozenset(site or ())) for page, site in zip(batch.column("html").to_pylist(), batch.column("site").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.join(sites, ["host", "page"], "left").select("page_id", "url", "html", "site").mapInArrow(read, "page_id long, url string, text string, n_chars long")
