"""Main text of web pages: site templates and furniture go, the article stays.

A site's template is what recurs across its pages.  Every block element's
subtree is hashed (tags and texts), Spark counts for each host on how many
pages of unlike text each hash stands, and subtrees that recur on many of them
are deleted.  What is furniture by its markup (menus, footers, forms, adverts,
comments ...) goes as well; the text is that of what is left of the article, or
of the whole page where none is marked.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymetrics.llm.html_tree import BLOCKS, HEADINGS, Tree
from skymetrics.llm.staging import stage
from skymetrics.llm.url_filter import with_host_and_path

#: a subtree is a template's if it stands on this many unlike pages of its host, and on this share of them
LEAST_PAGES, SHARE = 4, 0.3
#: the templates are broadcast up to so many bytes; beyond, pages are joined by host
BROADCAST_BYTES = 32 << 20
#: a host with more than one in so many pages is split in the join, so at most this many hosts are
HOT = 1000
SLICE_BYTES = 4 << 20

# Markup of what is no main text.
FURNITURE = frozenset(
    "aside audio button canvas datalist dialog footer form frameset head iframe input link menu meta nav noframes noscript object optgroup"
    " option script search select style svg template textarea title video xmp".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CUES = frozenset(
    "ad ads adbanner adbox adsbygoogle adslot advert advertisement advertising adverts banner breadcrumb breadcrumbs comment commentlist comments"
    " consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification"
    " overlay pager pagination popup promo promotion related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe"
    " subscription teaser teasers toolbar topbar widget widgets".split())
#: the same as whole class names of an article
ARTICLE_CUES = frozenset("ad advert advertisement comment promo related reply sponsored teaser".split())
#: first parts of names that speak of the page, not of the element
ABOUT = frozenset("has hide hides is no not show shows with without".split())
#: blocks of an article that stay however often they recur: its running text, not a box around it
RUNNING = HEADINGS | frozenset("address article blockquote body caption dd dt figcaption hr html li main p pre summary tbody td tfoot th thead tr".split())

_NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(\"[^\"]*|'[^']*|[^\s\"'>]+)", re.I)
_MAYBE = re.compile("class|id|role", re.I)
_NONE = (frozenset(), frozenset(), "")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@functools.lru_cache(maxsize=1 << 14)
def _cues(attributes: str) -> tuple[frozenset[str], frozenset[str], str]:
    """(cues in the parts of class and id, their whole names, role)."""
    parts, names, role = set(), set(), ""
    for kind, value in _NAMED.findall(attributes):
        value = value.strip("\"'")
        if kind.lower() == "role":
            role = value.strip().lower()
            continue
        for name in value.split():
            names.add(name.lower())
            found = [p.lower() for p in _PARTS.findall(name)]
            if found and found[0] not in ABOUT:
                parts.update(found)
    return frozenset(parts & CUES), frozenset(names), role


def _marked(tree: Tree) -> tuple[list[bool], list[bool], list[bool], list[str]]:
    """(furniture, furniture by name or form only, headers, roles) of the elements, without regard to what stands around them."""
    gone, loose, headers, roles = [], [], [], []
    for tag, attributes in zip(tree.tags, tree.attributes, strict=True):
        cues, names, role = _cues(attributes) if "=" in attributes and _MAYBE.search(attributes) else _NONE
        if tag in ("html", "body", "main"):
            named = False
        elif tag == "article":
            named = bool(names & ARTICLE_CUES)
        else:
            named = bool(cues - {"header"})
        fixed = (tag in FURNITURE and tag != "form") or role in ROLES
        gone.append(fixed or named or tag == "form")
        loose.append(not fixed)
        headers.append(tag == "header" or (cues == {"header"} and tag not in HEADINGS))
        roles.append(role)
    return gone, loose, headers, roles


def _below(tree: Tree, marked: list[bool]) -> list[bool]:
    """Whether an element or one around it is marked."""
    out: list[bool] = []
    for mark, parent in zip(marked, tree.parents, strict=True):
        out.append(mark or (parent >= 0 and out[parent]))
    return out


def _above(tree: Tree, found: set[int]) -> list[bool]:
    """Whether an element stands around one of ``found``."""
    out = [False] * len(tree.tags)
    for i in range(len(out) - 1, -1, -1):
        if (out[i] or i in found) and tree.parents[i] >= 0:
            out[tree.parents[i]] = True
    return out


class Page:
    """A page's tree with its furniture marked and its article found."""

    def __init__(self, page: str):
        self.tree = tree = Tree(page)
        gone, loose, headers, roles = _marked(tree)
        dead = _below(tree, gone)
        kinds = [[t == "article" for t in tree.tags], [t == "main" or r == "main" for t, r in zip(tree.tags, roles, strict=True)]]
        found: set[int] = set()
        for kind in kinds:
            found = {i for i, k in enumerate(kind) if k and tree.digests[i] and not dead[i]}
            if found:
                break
        if not found:  # what stands around an article is furniture by an unlucky name
            hard = _below(tree, [g and not free for g, free in zip(gone, loose, strict=True)])
            for kind in kinds:
                found = {i for i, k in enumerate(kind) if k and tree.digests[i] and not gone[i] and not hard[i]}
                if found:
                    dead = _below(tree, [g and not a for g, a in zip(gone, _above(tree, found), strict=True)])
                    break
        self.found = found
        self.inside = _below(tree, [i in found for i in range(len(tree.tags))]) if found else [True] * len(tree.tags)
        in_header = _below(tree, headers)
        in_heading = _below(tree, [t in HEADINGS for t in tree.tags])
        # of a header in the article its headings stay
        self.kept = [inside and not d and not (h and not (found and title))
                     for inside, d, h, title in zip(self.inside, dead, in_header, in_heading, strict=True)]

    def text(self, templates: frozenset[bytes] = frozenset()) -> str:
        """Blocks joined by line feeds; subtrees in ``templates`` are left out, but for an article's running text."""
        tree, kept = self.tree, self.kept
        if templates:
            deleted = [d in templates and t in BLOCKS and not (self.found and self.inside[i] and t in RUNNING)
                       for i, (d, t) in enumerate(zip(tree.digests, tree.tags, strict=True))]
            if any(deleted):
                kept = [k and not d for k, d in zip(kept, _below(tree, deleted), strict=True)]
        blocks, parts, at = [], [], -1
        for event in tree.events:
            if isinstance(event, str):
                if kept[at] if at >= 0 else not self.found:
                    parts.append(event)
                continue
            n = event if event >= 0 else ~event
            at = n if event >= 0 else tree.parents[n]
            tag = tree.tags[n]
            if tag in BLOCKS:
                block = " ".join("".join(parts).split())
                parts = []
                if block:
                    blocks.append(block)
            elif tag == "br":
                parts.append(" ")
        block = " ".join("".join(parts).split())
        return "\n".join(blocks + [block] if block else blocks)

    def subtrees(self) -> set[bytes]:
        return {d for d, t in zip(self.tree.digests, self.tree.tags, strict=True) if d and t in BLOCKS}


def _small(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about SLICE_BYTES."""
    a, size = 0, 0
    for i, x in enumerate(batch.column("html")):
        size += len(x.as_buffer() or b"") if x.is_valid else 0
        if size >= SLICE_BYTES:
            yield batch.slice(a, i + 1 - a)
            a, size = i + 1, 0
    if a < len(batch):
        yield batch.slice(a)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, subtree, page) for every block element; an empty subtree is the page itself.

    A page is named by its text, so that copies of an article count once.
    """
    for batch in batches:
        for part in _small(batch):
            out: set[tuple[str, bytes, int]] = set()
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                found = Page(page or "")
                name = int.from_bytes(hashlib.blake2b(found.text().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
                out.update((host, d, name) for d in found.subtrees())
                out.add((host, b"", name))
            hosts, subtrees, names = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(subtrees, pa.binary()), pa.array(names, pa.int64())],
                                             ["host", "subtree", "page"])


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """(host, subtrees): hashes of the subtrees that recur on the pages of each host; ``pages`` has host and html.

    A host's subtrees are at most 1 / share times those of its average page.
    """
    seen = (pages.filter("host <> ''").select("host", "html").mapInArrow(_count, "host string, subtree binary, page long")
            .distinct().groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")))
    counts = stage(seen.filter((F.col("n") >= least_pages) | (F.length("subtree") == 0)), "subtree_counts")
    totals = counts.filter(F.length("subtree") == 0).select("host", F.col("n").alias("pages"))
    often = counts.filter(F.length("subtree") > 0).join(totals, "host").filter(F.col("n") >= share * F.col("pages"))
    return stage(often.groupBy("host").agg(F.array_sort(F.collect_list("subtree")).alias("subtrees")), "templates")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: tuple[object, frozenset[bytes]] = (None, frozenset())
    for batch in batches:
        for part in _small(batch):
            texts = []
            for page, subtrees in zip(part.column("html"), part.column("subtrees").to_pylist(), strict=True):
                key = tuple(subtrees or ())
                if key != known[0]:
                    known = key, frozenset(key)
                texts.append(Page(page.as_py() or "").text(known[1]))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _split(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Pages joined with their host's templates, a hot host's pages in as many groups as its share of all asks for."""
    sizes = stage(pages.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "hosts")
    all_ = sizes.agg(F.sum("n")).first()[0] or 0
    hot = sizes.filter(F.col("n") * HOT > all_).select("host", F.ceil(F.col("n") * HOT / all_).cast("int").alias("groups"))  # fewer than HOT rows

    def grouped(df: DataFrame, group: Column) -> DataFrame:
        return df.join(F.broadcast(hot), "host", "left").withColumn("groups", F.coalesce("groups", F.lit(1))).withColumn("group", group).drop("groups")

    many = grouped(hosts, F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    one = grouped(pages, F.pmod(F.xxhash64("page_id", "url", "html"), F.col("groups")).cast("int"))
    return one.join(many, ["host", "group"], "left")


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    The text is that of the page's articles (``<article>``; without one of
    ``<main>``; without both of the page) less furniture by markup and subtrees
    that recur on at least ``least_pages`` pages of unlike text of the host and on the
    ``share`` of them.  An article's own paragraphs, headings, list items and
    cells stay even if other pages repeat them; of a header in an article the
    headings stay.  Character references are decoded, white space in a block
    is one space, blocks are joined by line feeds; ``<br>`` is a space, table
    cells are blocks.  A NULL or empty page has an empty text; a url that is
    NULL or without a host has no templates; rows that repeat are pages each
    and count as one; pages of any length and depth are taken whole.  Other
    columns are not read; an empty table gives an empty result.
    """
    rows = with_host_and_path(pages.select("page_id", "url", "html")).select("page_id", "url", "html", "host")
    found = templates(rows, least_pages, share)
    size = found.agg(F.sum(F.size("subtrees") * 16 + F.octet_length("host"))).first()[0] or 0
    joined = rows.join(F.broadcast(found), "host", "left") if size <= BROADCAST_BYTES else _split(rows, found)
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    out = joined.select("page_id", "url", "html", "subtrees").mapInArrow(_extract, schema)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
