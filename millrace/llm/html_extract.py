"""Main text of web pages by template deduction from equivalence classes.

Pages of a host are made from a template. A token of the template - an element with its place in
the page, or a block of text with its place - occurs equally often in a page as the tokens it belongs with,
so tokens with equal occurrence vectors over the host's pages form a class. A vector is kept as a
sum of hashes of (page, occurrences), which partial aggregation adds up wherever the pages are.
Classes that enough pages have, with an element among their tokens, are valid and nest by place.
What lies between the tokens of the nested classes is in the template's slots. An article element of the
template names the slot to be taken; else it is the least element that covers the texts of all slots, and
where that is no less than the page, all texts of all slots are the data. Elements whose names say that
they are no main text are left out, but not within an article.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.url_filter import host_of
from millrace.session import materialize

#: A class is valid if so large a share of the host's pages has it, and so many pages at least.
SUPPORT = 0.5
LEAST_PAGES = 3
#: Templates of so many bytes in all are sent to all tasks; beyond, pages are dealt out by host and salt.
BROADCAST_BYTES = 32 << 20
SALTS = 16
#: Longer texts are told apart by their hashes.
TOKEN_CHARS = 200

#: Elements without content, elements that start a block, elements that aren't main
#: text, names in class and id that mark such elements, and elements that hold an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
NOT_MAIN = frozenset(
    "aside button dialog footer form head header iframe input menu nav noscript object script search select style "
    "svg template textarea title".split()
)
NOT_MAIN_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices "
    "popup promo promoted related replies respond share sharing sidebar social sponsor sponsored subscribe widget".split()
)
DATA_ELEMENTS = frozenset(("article", "main"))
#: Start tags that close an open svg, by HTML's rules.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*)>"
    r"|</?[a-z!?][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NUMBER = re.compile(r"\d+")
_SELF_CLOSED = re.compile(r"(?:\A|[\s\"'])/\Z")
#: What ends an element whose content is no markup.
_RAW_END = {
    tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for tag in ("script", "style", "textarea", "iframe")
}


class _Element:
    __slots__ = ("tag", "place", "barred", "template", "data")

    def __init__(self, tag: str, marks: list[str], above: _Element | None):
        self.tag = tag
        # numbers in names are those of pages, not of templates
        step = ".".join([tag, *("|".join(_NUMBER.sub("#", m).replace("/", "|").split()) for m in marks)])
        self.place = f"{above.place}/{step}" if above else step
        names = {n.lower() for m in marks for n in m.split()}
        self.barred = tag in NOT_MAIN or bool(above and above.barred)
        named = tag not in ("html", "body") and bool(names & NOT_MAIN_NAMES)
        self.template = self.barred or named or bool(above and above.template)
        self.data = tag in DATA_ELEMENTS or "main" in names or bool(above and above.data)


def walk(page: str) -> Iterator[tuple[_Element | None, str | None, bool]]:
    """(element, text, starts a block) of a page in order; text is None where an element opens.

    An end tag closes what is open inside of its element, and one without a start is ignored. A
    block closes an open paragraph, an item an open item. What ends in the middle is closed there.
    An element whose content is no markup is left out up to its own end tag; a self-closed one is empty.
    """
    stack: list[_Element] = []
    at, block = 0, False

    def close(tag: str, within: frozenset[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag == tag:
                del stack[i:]
                return
            if stack[i].tag in within:
                return

    while piece := _PIECE.search(page, at):
        if piece.start() > at:
            yield (stack[-1] if stack else None), page[at : piece.start()], block
            block = False
        at = piece.end()
        tag = piece[2]
        if tag is None:  # a comment or a declaration
            continue
        tag = tag.lower()
        block |= tag in BLOCK
        if tag == "br":
            yield (stack[-1] if stack else None), " ", block
            block = False
        elif piece[1]:
            close(tag, frozenset())
        elif tag in _RAW_END:
            if not _SELF_CLOSED.search(piece[3]):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
        else:
            if tag in BREAKOUT:
                close("svg", frozenset(("foreignobject",)))
            if tag in BLOCK:
                close("p", BLOCK - {"p"})
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                close(tag, frozenset(("ul", "ol", "dl", "table", "select")))
            marks = [a or b or c for a, b, c in _MARK.findall(piece[3])] if "=" in piece[3] else []
            element = _Element(tag, marks, stack[-1] if stack else None)
            yield element, None, block
            if tag not in VOID and not piece[3].endswith("/"):
                stack.append(element)
    if at < len(page):
        yield (stack[-1] if stack else None), page[at:], block


def _clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


def _blocks(page: str, keep) -> Iterator[tuple[_Element | None, str | None]]:
    """Each element of a page with None, and each block of the texts whose elements `keep` accepts, with that of its first one."""
    now: list[str] = []
    first = None
    for element, text, starts in walk(page):
        if starts and now:
            yield first, "".join(now)
            now = []
        if text is None:
            yield element, None
        elif keep(element):
            first = first if now else element
            now.append(text)
    if now:
        yield first, "".join(now)


def _token(element: _Element | None, text: str) -> str:
    """A cleaned block with its place; a long one is named by its hash."""
    if len(text) > TOKEN_CHARS:
        text = "#" + hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
    return f"{element.place if element else ''}\n{text}"


def main_text(page: str, slots: list[str], known: frozenset[str], names: bool = True) -> str:
    """The blocks below one of the places `slots`; those of the whole page, without blocks in `known`, if none is given.

    `names` tells whether elements are left out for NOT_MAIN_NAMES too.
    """

    def keep(element: _Element | None) -> bool:
        if element is None:
            return not slots
        if element.template if names else element.barred:
            return False
        return not slots or any(element.place == s or element.place.startswith(s + "/") for s in slots)

    found = []
    for element, text in _blocks(page, keep):
        if text is not None and (text := _clean(text)) and not (known and not slots and _token(element, text) in known):
            found.append(text)
    return "\n".join(found)


def tokens_of(page: str) -> tuple[Counter, Counter]:
    """How often each token of a page occurs, and how many letters of text it has or has below it.

    Tokens are `/` and the place of an element, or the place and text of a block. The token of a page with text
    at all is empty. Texts of elements that are marked as template are left out, and those marked as data
    needn't be told apart.
    """
    times: Counter = Counter()
    below: Counter = Counter()
    for element, text in _blocks(page, lambda element: not (element is not None and element.template)):
        if text is None:
            times["/" + element.place] += 1
        elif text := _clean(text):
            times[""] = 1
            below[""] += len(text)
            place = "/" + element.place if element else ""
            while place:
                below[place] += len(text)
                place = place.rpartition("/")[0]
            if not (element is not None and element.data):
                token = _token(element, text)
                times[token] += 1
                below[token] += len(text)
    return times, below


def _is_template(place: str, by_names: bool) -> bool:
    for step in place.split("/"):
        tag, *marks = step.split(".")
        if tag in NOT_MAIN:
            return True
        if by_names and tag not in ("html", "body") and {n.lower() for m in marks for n in m.split("|")} & NOT_MAIN_NAMES:
            return True
    return False


def classes(pages: DataFrame) -> DataFrame:
    """(host, vector, pages, once, elements, texts): the valid equivalence classes of `pages` (host, key, html).

    `elements` are (place, below, whole), with the letters below it and those of the pages that have it,
    `texts` are (text, below), over all pages.

    A class is all tokens of a host with one occurrence vector. It is valid if SUPPORT of the host's pages
    with text have its tokens, LEAST_PAGES of them at least, and if it has an element: a text that
    often stands alone is no template. `once` tells that no page has one of its tokens twice. Of a host with
    fewer pages only the elements are known.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, str], list[int]] = {}
            for host, key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                times, below = tokens_of(page)
                for token, n in times.items():
                    entry = total.setdefault((host, token), [0, 0, 0, 0, 0])
                    # the share of this page in the vector: a hash of page and occurrences
                    part = (key ^ (n * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
                    part = (part ^ part >> 29) * 0x94D049BB133111EB & (1 << 64) - 1
                    entry[0] += 1
                    entry[1] = entry[1] + (part ^ part >> 32) & (1 << 64) - 1
                    entry[2] += n
                    entry[3] += below[token]
                    entry[4] += below[""]
            keys, values = list(total), np.array(list(total.values()), dtype=np.uint64).reshape(-1, 5).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 *(pa.array(values[:, i].copy(), pa.int64()) for i in range(5))],
                names=["host", "token", "pages", "vector", "times", "below", "whole"],
            )

    parts = pages.mapInArrow(count, "host string, token string, pages long, vector long, times long, below long, whole long")
    # sums of vectors wrap around, half by half
    low, high = F.col("vector").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("vector", 32)
    tokens = parts.groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.sum(low).alias("low"), F.sum(high).alias("high"),
        *(F.sum(c).alias(c) for c in ("times", "below", "whole")),
    ).withColumn("vector", F.concat_ws(" ", "pages", "low", "high"))
    # written, as the pages' sizes are read from it too: the pages are walked once
    tokens = materialize(tokens, "tokens")
    sizes = tokens.filter(F.col("token") == "").select(F.col("host").alias("of"), F.col("pages").alias("all"))
    often = tokens.join(sizes, F.col("host") == F.col("of")).filter(
        (F.col("pages") >= SUPPORT * F.col("all")) & ((F.col("pages") >= 2) | (F.col("all") == 1))
    )
    element = F.col("token").startswith("/")
    place = F.struct(F.substring("token", F.lit(2), F.length("token")).alias("place"), "below", "whole")
    text = F.struct(F.col("token").alias("text"), "below")
    return often.groupBy("host", "vector").agg(
        F.first("pages").alias("pages"),
        F.every(F.col("times") == F.col("pages")).alias("once"),
        F.sort_array(F.collect_list(F.when(element, place))).alias("elements"),
        F.sort_array(F.collect_list(F.when(~element & (F.col("all") >= LEAST_PAGES) & (F.col("token") != ""), text))).alias("texts"),
    ).filter(F.size("elements") > 0)


def _nested(valid: pd.DataFrame) -> pd.DataFrame:
    """The template of one host from its valid classes: its slots and its texts.

    Classes nest by place: a class lies in that of the nearest element around its first element. One whose
    chain leads to no class without an element around it hangs nowhere and isn't taken. An article element
    is the slot; else it is the least element below the body that covers all letters of its pages but those
    of its class, where there is one.
    """
    below = {e["place"]: (e["below"], e["whole"]) for own in valid.elements for e in own}
    valid = valid.assign(elements=[[e["place"] for e in own] for own in valid.elements])
    of = {place: i for i, places in enumerate(valid.elements) for place in places}

    def above(place: str) -> str:
        return place.rpartition("/")[0]

    taken: set[int] = set()
    first = [min(places, key=lambda p: (p.count("/"), p)) for places in valid.elements]
    for i in sorted(range(len(valid)), key=lambda i: first[i].count("/")):
        outer = above(first[i])
        if not outer or of.get(outer) in taken:
            taken.add(i)
    named = [
        place for i in taken if valid.once.iloc[i] for place in valid.elements.iloc[i]
        if place.rpartition("/")[2].split(".")[0] in DATA_ELEMENTS and not _is_template(place, by_names=False)
    ]
    # an article is one whatever the names of what is around it, unless there is another
    named = [place for place in named if not _is_template(place, by_names=True)] or named
    slots = sorted(p for p in named if not any(p.startswith(q + "/") for q in named))
    known = sorted(t["text"] for i in taken for t in valid.texts.iloc[i])
    least = ""
    for i in taken if known and not slots else ():
        for place in valid.elements.iloc[i] if valid.once.iloc[i] else ():
            inside, whole = below[place]
            for t in valid.texts.iloc[i]:
                whole -= t["below"]
                if t["text"].startswith((place + "/", place + "\n")):
                    inside -= t["below"]
            if inside == whole > 0 and place.count("/") > 1 and (place.count("/"), place) > (least.count("/"), least):
                least = place
    return pd.DataFrame({"host": [valid.host.iloc[0]], "slots": [slots or [least] * bool(least)], "named": [bool(slots)], "known": [known]})


def templates(pages: DataFrame) -> DataFrame:
    """(host, slots, named, known) of each host in `pages` (host, key, html) with a valid class."""
    return classes(pages).groupBy("host").applyInPandas(_nested, "host string, slots array<string>, named boolean, known array<string>")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row; needs page_id, url and html.

    Character references are decoded, white space inside a block becomes one space, and blocks are
    joined by line ends in page order. A null or empty html gives an empty text; a null url counts
    as the empty host, whose pages are taken together. A page of a host whose template names no slot, or
    that lacks its host's slot, gives the texts of all slots: all blocks outside of template elements and texts.
    If there is none, it gives those that only the names of elements mark as template, and then, as on a host
    whose pages are all alike, those that only their repetition does. Repeated rows are extracted each for itself,
    an empty table gives no row. Other columns are ignored, whatever their names.
    """
    given = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host")
    )
    keyed = given.select("host", F.xxhash64("page_id", "url", "html").alias("key"), "html")
    found = materialize(templates(keyed), "templates")
    length = lambda texts: F.aggregate(texts, F.lit(0), lambda n, t: n + F.octet_length(t) + 16)
    size = found.agg(F.sum(F.octet_length("host") + length("slots") + length("known") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = given.join(F.broadcast(found), "host", "left")
    else:
        salted = given.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        copies = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, ["host", "salt"], "left")
    joined = joined.select("page_id", "url", "html", "slots", "known", "named")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, slots, known, named in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                known = frozenset(known or ())
                text = (main_text(page, slots, known, names=not named) if slots else "") or main_text(page, [], known)
                text = text or main_text(page, [], known, names=False) or main_text(page, [], frozenset())
                texts.append(text or main_text(page, [], frozenset(), names=False))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
