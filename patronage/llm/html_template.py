"""Main text of web pages by deducing each host's template.

A page is a sequence of tokens: its tags, each with its place in the tree, and
its text blocks. Tokens of one host that occur equally often on every page have
equal occurrence vectors; each vector's tokens form an equivalence class. The
class that is on all pages once is the root of the template; a class is nested
in it, on a page, if its tokens come in the template's order and fall in one gap
between root tokens. What no valid class covers are slots. If most of a host's
words in slots are in articles, the richest article is its main text, and on
pages without it their own articles are; else all slots are, so that a title or
introduction beside the longest part stays. Menus, headers, footers, sidebars, notices, adverts, forms and comments are
left out by their element, role or class name, except a named element that
holds nearly all words of the host's slots.

Vectors are not collected: a vector is known by its number of pages, number of
occurrences and two sums of page hashes weighted by count, which add up over
tasks, so the pages of a large host are counted where they lie. Pages of a host
with equal html count as one, so that copies do not make a text template. Pages
are parsed twice and never shuffled; the templates are small, and Spark decides by their
written size whether every task gets them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import batches_of
from patronage.session import materialize

#: Pages that a template needs; share of a host's pages that a class is on at least.
PAGES, SHARE = 4, 0.5
#: Inside an article, a block is template if a valid class has it on this share of the host's pages, and the host has so many.
NEARLY, MANY = 0.9, 8
#: Depth to which elements have places of their own.
DEEP = 200

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg annotation annotation-xml".split())
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)", re.I)
VALUE = re.compile(r"""=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)""")
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr object math mi mn mo ms mtext mrow mfrac msqrt mroot "
                   "msub msup msubsup munder mover munderover mstyle mpadded menclose mtable mtr mtd semantics "
                   "annotation annotation-xml".split())
APART = frozenset("nav footer aside form script style noscript template iframe svg button select dialog head menu "
                  "option optgroup fieldset canvas audio video".split())
#: Elements that no name leaves out; elements whose id is a link target (sections: inside an article).
FRAME = frozenset("html body main article".split())
LINKED = frozenset("h1 h2 h3 h4 h5 h6 p".split())
#: Class names that say what an element has, not what it is.
HAS = re.compile(r"(?<!\S)(?:has|no|with|without|hide|show)[_-]\S*", re.I)
#: Class names, ids and roles of what is not main text (fixed values).
ASIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|"
    r"consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|sidebar|aside|widget|related|"
    r"recommended|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|share|sharing|social|comments?|commentlist|"
    r"disqus|repl(?:y|ies)|discussion|footer|masthead|toolbar|search|contentinfo|complementary)(?:$|[\s_-])", re.I)
MAIN = re.compile(r"(?:^|[\s_-])(?:article|main|story|articlebody|entry|post)(?:$|[\s_-])", re.I)
#: Elements that a new one of the kind ends, and where the search for them stops.
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
        "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
        "option": ("option", ("select",))}
ENDS = {k: (frozenset(a.split()), frozenset(b)) for k, (a, b) in ENDS.items()}


class Block(NamedTuple):
    """A text block: token, the article around it, its order among tokens, and the innermost element around it that its
    name leaves out."""
    text: str
    token: int
    article: str
    at: int
    aside: str = ""


def number(said: str) -> int:
    """A token or page as a signed 64-bit number."""
    return int.from_bytes(xxhash.xxh64_digest(said.encode("utf-8", "surrogatepass")), "big", signed=True)


def hidden(rest: str) -> bool:
    """Whether a tag has the attribute hidden (not in a value)."""
    return bool(rest) and "hidden" in rest.lower() and bool(HIDDEN.search(VALUE.sub("=''", rest)))


class Page:
    """The tokens of a page: ``tags`` (numbers of opened elements' places, in
    order, with their order among all tokens), ``blocks`` outside of what is left
    out by name, and ``aside`` the blocks that only a class, id or role leaves out."""

    def __init__(self, source: str | None):
        self.tags: list[tuple[int, int]] = []
        self.blocks: list[Block] = []
        self.aside: list[Block] = []
        # (tag, place, left out, article's place, place of what its name leaves out)
        stack: list[tuple[str, str, bool, str, str]] = [("", "", False, "", "")]
        held: list[str] = []
        source = source or ""
        places = _PLACES
        n = at = 0

        def flush() -> None:
            nonlocal n
            if not held:
                return
            said = "".join(held)
            held.clear()
            if stack[-1][2]:
                return
            text = " ".join((html.unescape(said) if "&" in said else said).split())
            if text:
                k = len(stack) - 1
                while k > 0 and stack[k][0] in INLINE:
                    k -= 1
                place = stack[k][1]
                (self.aside if stack[-1][4] else self.blocks).append(
                    Block(text, number(f"{place}\n{text}"), stack[k][3], n, stack[-1][4]))
                n += 1

        m = TAG.search(source)
        while m:
            if m.start() > at:
                held.append(source[at:m.start()])
            at = m.end()
            close, tag, rest = m.group(1), m.group(2), m.group(3)
            if tag is None:
                close, tag, rest = m.group(4), m.group(5), m.group(6)
            if tag is None:
                m = TAG.search(source, at)
                continue
            tag = tag.lower()
            if tag == "br":
                held.append(" ")
            elif tag in RAW and not close:
                if tag not in INLINE:
                    flush()
                if not rest.endswith("/"):
                    end = RAW_END[tag].search(source, at)
                    at = end.end() if end else len(source)
            elif close:
                if tag not in INLINE:
                    flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                    if tag in INLINE and stack[k][0] not in INLINE:
                        break
            else:
                if tag not in INLINE:
                    flush()
                    if tag in ENDS:
                        ended, stop = ENDS[tag]
                        for k in range(len(stack) - 1, 0, -1):
                            if stack[k][0] in ended:
                                del stack[k:]
                                break
                            if stack[k][0] in stop:
                                break
                    else:  # a block ends an open paragraph
                        for k in range(len(stack) - 1, 0, -1):
                            if stack[k][0] == "p":
                                del stack[k:]
                                break
                            if stack[k][0] not in INLINE:
                                break
                if tag not in VOID and not (rest.endswith("/") and tag in RAW):
                    _, up, out, article, aside = stack[-1]
                    name = ""
                    if rest:
                        found = [(k, a or b or c) for k, a, b, c in NAMED.findall(rest)]
                        if found:
                            name = " ".join([x for _, x in found])
                    out = out or tag in APART or (tag == "header" and not article) or hidden(rest)
                    if tag == "main":
                        aside = ""
                    elif name and tag not in FRAME:
                        said = name
                        if tag in LINKED or tag == "section" and article:
                            said = " ".join([x for k, x in found if k.lower() != "id"])
                        if ASIDE.search(said) and ASIDE.search(HAS.sub(" ", said)):
                            aside = "new"
                    if len(stack) > DEEP:  # elements nested deeper share a place
                        place = up
                    else:
                        place = f"{up}/{tag}.{name}" if name else f"{up}/{tag}"
                    if aside == "new":
                        aside = place
                    if not article and not out and (tag in ("article", "main") or name and tag not in ("html", "body", "p")
                                                    and tag not in INLINE and MAIN.search(name)):
                        article = place
                    stack.append((tag, place, out, article, aside))
                    if tag not in INLINE:
                        token = places.get(place)
                        if token is None:
                            if len(places) > 50_000:
                                places.clear()
                            token = places[place] = number(place)
                        self.tags.append((token, n))
                        n += 1
            m = TAG.search(source, at)
        held.append(source[at:])
        flush()


_PLACES: dict[str, int] = {}
_SLOTS: dict[str, int] = {"": 0}
#: Kinds of rows; the words of a block in articles or outside, and of one that a name leaves out, make the last two.
ALL, TAGS, BLOCKS, SLOTS, ASIDES = 0, 1, 2, 3, 4
#: A named element holds the host's slot if all that no name leaves out has less than this share of its words.
REST = 0.1


def slot_of(place: str) -> int:
    """Number of a place that blocks lie in; 0 outside."""
    got = _SLOTS.get(place)
    if got is None:
        if len(_SLOTS) > 20_000:
            _SLOTS.clear()
            _SLOTS[""] = 0
        got = _SLOTS[place] = number("slot" + place)
    return got


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")),
                                    r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1))


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, copy, kind, token, pages, n, u, v, at, words, slot) from (host,
    mark, again, html): partial sums of each token's occurrence vector; blocks
    have their words and slot; for slots n counts words, for ALL pages. Pages that stand ``again`` have rows of their own, by
    their mark (copy), which are equal for equal pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, int | None, int, int], list[int]] = {}
            for host, mark, again, source in zip(*[c.to_pylist() for c in b.columns], strict=True):
                copy = mark if again else None
                if again and (host, copy, ALL, 0) in sums:
                    continue
                page = Page(source)
                seen: dict[tuple[int, int], list[int]] = {(ALL, 0): [1, 0, 0, 0]}
                for t, at in page.tags:
                    if (s := seen.get((TAGS, t))) is None:
                        seen[TAGS, t] = [1, at, 0, 0]
                    else:
                        s[0] += 1
                for x in (*page.blocks, *page.aside):
                    n = x.text.count(" ") + 1
                    kind, slot = (ASIDES, slot_of(x.aside)) if x.aside else (SLOTS, slot_of(x.article))
                    s = seen.setdefault((BLOCKS, x.token), [0, x.at, 0, slot])
                    s[0] += 1
                    s[2] += n
                    seen.setdefault((kind, slot), [0, x.at, 0, slot])[0] += n
                for (kind, t), (n, at, w, slot) in seen.items():
                    mixed = (mark ^ (n * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9
                    s = sums.setdefault((host, copy, kind, t), [0, 0, 0, 0, 0, 0, slot])
                    s[0] += 1
                    s[1] += n
                    s[2] += mixed >> 33 & 0x7FFFFFFF
                    s[3] += mixed >> 2 & 0x7FFFFFFF
                    s[4] += at
                    s[5] += w
            keys = list(sums)
            cols = list(zip(*sums.values(), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([k[2] for k in keys], pa.int32()), pa.array([k[3] for k in keys], pa.int64()),
                 *[pa.array(c, pa.int64()) for c in cols]],
                names=["host", "copy", "kind", "token", "pages", "n", "u", "v", "at", "words", "slot"])
    return pages.mapInArrow(run, "host string, copy long, kind int, token long, pages long, n long, u long, v long, at long, "
                                 "words long, slot long")


def templates(pages: DataFrame) -> DataFrame:
    """One row for each host with enough pages: root (tokens in order), classes
    (the other classes' tokens in order), firm (blocks on nearly all of many
    pages), slot (the richest article's number, or 0) and spare (the named
    element that holds the slot, if one does), from (host, html).

    A class is on at least ``SHARE`` of the host's pages, so there are at most
    1 / SHARE times as many tokens as a page has: rows are bounded.
    """
    marked = pages.select("host", F.xxhash64("html").alias("mark"), "html")
    copies = materialize(marked.groupBy("host", "mark").agg(F.count("*").alias("again")).where("again > 1"))
    marked = marked.join(copies, ["host", "mark"], "left") \
        .select("host", "mark", F.col("again").isNotNull().alias("again"), "html")
    each = ("pages", "n", "u", "v", "at", "words")
    sums = occurrences(marked).groupBy("host", "copy", "kind", "token").agg(
        *[F.when(F.col("copy").isNull(), F.sum(c)).otherwise(F.max(c)).alias(c) for c in each], F.max("slot").alias("slot"))
    sums = sums.groupBy("host", "kind", "token").agg(*[F.sum(c).alias(c) for c in each], F.max("slot").alias("slot"))
    sums = materialize(sums.where(f"kind != {BLOCKS} or pages > 1"))
    hosts = sums.where(f"kind = {ALL} and pages >= {PAGES}").select("host", F.col("pages").alias("every"))
    often = sums.where(f"kind in ({TAGS}, {BLOCKS})").join(hosts, "host").where(F.col("pages") >= F.col("every") * SHARE)
    # Words of slots: all words without those of blocks that the template may cover.
    words = sums.where(f"kind in ({SLOTS}, {ASIDES})").select("host", "kind", "slot", F.col("n").alias("words")).union(
        often.where(f"kind = {BLOCKS}").select("host", "kind", "slot", -F.col("words"))) \
        .groupBy("host", "slot").agg(F.max("kind").alias("kind"), F.sum("words").alias("words"))
    some = F.struct("words", "slot")
    inside = (F.col("kind") == SLOTS) & (F.col("slot") != 0)
    slots = words.groupBy("host").agg(
        F.coalesce(F.sum(F.when((F.col("kind") == SLOTS) & ~inside, F.col("words"))), F.lit(0)).alias("out"),
        F.coalesce(F.sum(F.when(inside, F.col("words"))), F.lit(0)).alias("in"),
        F.max(F.when(inside, some)).alias("best"), F.max(F.when(F.col("kind") == ASIDES, some)).alias("aside"))
    spare = F.when(F.expr(f"`in` + `out` < {REST} * aside.words"), F.col("aside.slot"))
    slots = slots.select("host", spare.alias("spare"), F.when(
        spare.isNull() & (F.col("in") >= F.col("out")), F.col("best.slot")).otherwise(0).alias("slot"))
    firm = (F.col("kind") == BLOCKS) & (F.col("every") >= MANY) & (F.col("pages") >= F.col("every") * NEARLY)
    classes = often.groupBy("host", "every", "pages", "n", "u", "v").agg(
        F.transform(F.sort_array(F.collect_list(F.struct((F.col("at") / F.col("pages")).alias("at"), "token"))),
                    lambda x: x["token"]).alias("tokens"),
        F.collect_list(F.when(firm, F.col("token"))).alias("firm"))
    root = (F.col("pages") == F.col("every")) & (F.col("n") == F.col("every"))
    made = classes.groupBy("host").agg(
        F.max(F.when(root, F.col("tokens"))).alias("root"),
        F.collect_list(F.when(~root, F.col("tokens"))).alias("classes"), F.flatten(F.collect_list("firm")).alias("firm"))
    return materialize(made.join(slots, "host", "left"))


def covered(page: Page, root: list[int], classes: list[list[int]]) -> set[int]:
    """Orders of the page's tokens that valid classes of the template cover."""
    where: dict[int, list[int]] = {}
    for t, at in [*page.tags, *((x.token, x.at) for x in (*page.blocks, *page.aside))]:
        where.setdefault(t, []).append(at)
    out: set[int] = set()
    borders = []
    for t in root:  # tokens that are out of the template's order belong to slots
        at = where.get(t, ())
        if len(at) == 1 and (not borders or at[0] > borders[-1]):
            borders.append(at[0])
    out.update(borders)
    for tokens in classes:
        places = [where.get(t, []) for t in tokens]
        if not places[0] or any(len(p) != len(places[0]) for p in places):
            continue
        rounds = [p for turn in zip(*places, strict=True) for p in turn]
        gaps = {sum(b < p for b in borders) for p in (min(rounds), max(rounds))}
        if rounds == sorted(rounds) and len(gaps) == 1:
            out.update(rounds)
    return out


def main_blocks(page: Page, root: list[int] | None, classes: list[list[int]] | None, firm: list[int] | None,
                slot: int | None, spare: int | None = None) -> list[str]:
    blocks = page.blocks
    if spare is not None:
        blocks = sorted([*blocks, *(x for x in page.aside if slot_of(x.aside) == spare)], key=lambda x: x.at)
    if not blocks:
        return []
    template = covered(page, root or [], classes or []) if root or classes else set()
    own = [x for x in blocks if slot is not None and slot in (0, slot_of(x.article))]
    chosen = own or [x for x in blocks if x.article] or blocks
    # Inside an article a passage may stand on many pages and still be text, but not on nearly all of them.
    fixed = set(firm or ())
    left = [x for x in chosen if x.at not in template or x.article and x.token not in fixed]
    return [x.text for x in left or chosen]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page row.

    Null or empty html gives an empty text, a null url a host of its own (with a
    template of its own), repeated rows are repeated, an empty table gives no
    rows; other columns are not read. Blocks keep the page's order; nothing else
    is dropped or cut.
    """
    batches_of(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("__host"), "url", "html")
    made = templates(rows.select(F.col("__host").alias("host"), "html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = [b.column(c).to_pylist() for c in ("html", "root", "classes", "firm", "slot", "spare")]
            texts = ["\n\n".join(main_blocks(Page(s), *t)) for s, *t in zip(*said, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return rows.join(made, F.col("__host") == F.col("host"), "left") \
        .select("page_id", "url", "html", "root", "classes", "firm", "slot", "spare") \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
