"""Main text of web pages, with the template of each host deduced from its pages.

Tokens are the tags of a page, told apart by the containers around them, and its text blocks. Tokens of
one host whose occurrence vectors over the host's pages agree form an equivalence class. Classes that are
frequent and hold a tag are valid; together they are the host's template,
and what they fix on every page - menus, notices, footers, whatever their markup - is not content. What
lies between the template's tokens are the slots, inside an article as well as around it. A slot is extracted
unless it is outside the page's article or a container around it says that it is no part of it (navigation,
form, advert, comment and so on). Valid classes are not arranged in a tree: a class counts if it holds a tag.

An occurrence vector is held as the sum of a hash per (page, count), so that a host of any size is
aggregated with partial sums. Equal pages of a host count once.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import step


# A class is frequent from so many different pages of a host on, and from this share of them.
LEAST_PAGES, LEAST_SHARE = 4, 0.5

# HTML's elements by their part in a page.
RAW = frozenset("script style textarea xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split())
CONTENT = frozenset("article main".split())
NO_CONTENT = frozenset(
    "head title nav footer aside form script style noscript template iframe object embed select option button input "
    "textarea svg math canvas audio video map dialog menu datalist xmp noembed noframes".split())
# Containers that hold no content, by a class or their id, and by their role.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion nav navbar "
    "navigation menu menus breadcrumb breadcrumbs sidebar aside rail footer masthead topbar toolbar header cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay comment comments commentlist disqus reply replies "
    "respond discussion share sharing social related recommended newsletter subscribe signup login search pager pagination "
    "widget widgets skip hidden".split())
# Of these names those that parts of an article have as well; inside it only the template tells.
UNSURE = frozenset("header discussion notification alert respond promotion rail overlay search skip aside login banner menu".split())
# Names that also count as one part of a longer one, such as comment-list; those of a page's own head only with such a part.
PARTS = NAMES - frozenset("hidden skip header search login signup reply widget widgets".split())
PAGE_HEAD = frozenset("site page main top global".split())
# Names that hold for a container with most of an article's text as well.
CERTAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot nav navbar navigation menus breadcrumb breadcrumbs footer "
    "masthead topbar toolbar cookie cookies consent gdpr popup modal comment comments commentlist disqus newsletter subscribe "
    "signup pager pagination".split())
VAGUE = frozenset("related recommended".split())
# Parts that make a list of other pages of "related", which names a section of an article as well.
OTHERS = frozenset("post posts article articles story stories link links reading item items news list box content".split())
# Elements that hold a passage; inside an article a name on them is about the passage.
PASSAGES = frozenset("p li dt dd h1 h2 h3 h4 h5 h6 blockquote pre td th figcaption caption summary".split())
# Elements that are never lifted; of the others those named as without content may turn out to hold the page.
NEVER = NO_CONTENT - {"form"}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s\"'/]|$)", re.I)
_PARTED = re.compile(r"[-_]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def excluded(name: str, attributes: str, inside_content: bool) -> bool:
    """Does this start tag open a container without content? A ``header`` inside the article is part of it."""
    if name in NO_CONTENT or (name == "header" and not inside_content):
        return True
    if not attributes or name in ("html", "body") or name in CONTENT:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        key = key.lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in ROLES):
            return True
        if key in ("class", "id") and not (inside_content and name in PASSAGES) and named_without_content(value, inside_content):
            return True
    return False


@lru_cache(maxsize=1 << 14)
def named_without_content(value: str, inside_content: bool) -> bool:
    """Does a class list or an id name a container without content, by a whole name or by a part of one?"""
    for name in value.split():
        parts = frozenset(_PARTED.split(name))
        if inside_content:
            vague = frozenset() if parts & OTHERS else VAGUE
            if name in NAMES - UNSURE or parts & (PARTS - UNSURE - vague):
                return True
        elif name in NAMES or parts & PARTS or ("header" in parts and parts & PAGE_HEAD):
            return True
    return False


def certain(attributes: str) -> bool:
    """Is the container without content whatever it holds, by a whole name or a role?"""
    return any(k.lower() == "role" or (k.lower() in ("class", "id") and set("".join(v).lower().split()) & CERTAIN)
               for k, *v in _ATTRIBUTE.findall(attributes))


def unseen(attributes: str) -> bool:
    return any(k.lower() == "hidden" or (k.lower() == "aria-hidden" and "".join(v).lower() == "true")
               for k, *v in _ATTRIBUTE.findall(attributes))


def blocks(page: str) -> list[tuple[str, str, bool, bool]]:
    """``read`` of the page. Where no article is left, an exclusion does not hold for containers around one.

    On a page without an article it does not hold for a container that has most of the page's text, such as a form
    around the page; inside an article not for one with a doubtful name that has more text than is left of it.
    """
    lifted: frozenset[int] = frozenset()
    while True:
        out, weights, around, within = read(page, lifted)
        left = sum(len(text) for _, text, inside, out_of_it in out if inside and not out_of_it)
        if left:
            held = {at for at in within if weights.get(at, 0) > left}
            if not held:
                return out
            lifted |= held
            continue
        most = sum(len(text) for _, text, _, _ in out) / 2
        more = around or {at for at, weight in weights.items() if weight > most}
        if not more:
            return out
        lifted |= more


def read(page: str, lifted: frozenset[int]) -> tuple[list[tuple[str, str, bool, bool]], dict[int, int], set[int], set[int]]:
    """(path, text, inside the article, excluded) of every text block, and of every container with an empty text.

    The path names the containers around a block. White space inside a block is one space; a tag that is
    not inline ends a block, a line break inside it is a space. End tags without a start are ignored and
    missing end tags are implied by those of the containers around. Then, by the places of the excluded containers
    that can be lifted: the length of their text, which have an article inside, and which are inside one. Those in ``lifted`` are not excluded.
    """
    out: list[tuple[str, str, bool, bool]] = []
    stack: list[tuple[str, str, bool, bool, int]] = [("", "", False, False, -1)]
    weights: dict[int, int] = {}
    around: set[int] = set()
    within: set[int] = set()
    held: list[str] = []

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((stack[-1][1], text, stack[-1][2], stack[-1][3]))
                if stack[-1][4] >= 0:
                    weights[stack[-1][4]] = weights.get(stack[-1][4], 0) + len(text)

    at, end, match = 0, len(page), _TOKEN.match
    while at < end:
        found = match(page, at)
        at = found.end()
        name = found[2]
        if name is None:
            if page[found.start()] != "<" or found.end() == found.start() + 1:
                held.append(found[0])
            continue
        name = name.lower()
        if found[1]:
            if name in INLINE and name != stack[-1][0]:
                continue
            flush()
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] == name:
                    del stack[n:]
                    break
            continue
        _, path, inside, out_of_it, root = stack[-1]
        no_content = out_of_it or (found.start() not in lifted and excluded(name, found[3], inside))
        if name in INLINE and not (no_content and not out_of_it):
            if name == "br":
                held.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name == "p" or name == "li":  # their end tags are often left out
            if stack[-1][0] == name:
                stack.pop()
                _, path, inside, out_of_it, root = stack[-1]
                no_content = out_of_it or (found.start() not in lifted and excluded(name, found[3], inside))
        label = "#".join([name, *sorted(v.lower() for _, *vs in _ATTRIBUTE.findall(found[3]) for v in vs if v)]) if found[3] else name
        inside = inside or (name in CONTENT and not no_content)
        if no_content and not out_of_it and name not in NEVER and not unseen(found[3]):
            root = found.start()
            if inside and not certain(found[3]):
                within.add(root)
        if name in CONTENT and root >= 0:
            around.add(root)
        stack.append((name, f"{path}/{label}", inside, no_content, root))
        out.append((stack[-1][1], "", inside, no_content))
        if len(stack) > 512:  # containers nested deeper are one level, which keeps what those around it say
            del stack[512 - 1]
    flush()
    return out, weights, around, within


def token(path: str, text: str) -> int:
    value = xxhash.xxh64_intdigest(f"{path}\x00{text}".encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _counts(found: list[tuple[str, str, bool, bool]]) -> Counter:
    """Counts of all tokens of a page, those inside the article included."""
    return Counter((token(path, text), not text) for path, text, _, _ in found)


def templates(pages: DataFrame) -> DataFrame:
    """(host, fixed): per host the text tokens of its valid classes. ``pages``: host, html.

    A class holds the tokens of a host with one occurrence vector. It is valid if it is found on at least
    ``LEAST_PAGES`` different pages and ``LEAST_SHARE`` of the host's, and holds a tag that the text can be
    nested under. Every such token is on that share of the host's pages, so a list is not longer than
    a page's tokens divided by the share. Written once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, page in zip(batch["host"], batch["html"]):
                digest = xxhash.xxh64_intdigest(page.encode("utf-8", "surrogatepass")) >> 1
                counts = _counts(blocks(page))
                out.append((host, digest, [{"token": t, "tag": tag, "n": n} for (t, tag), n in counts.items()]))
            yield pd.DataFrame(out, columns=["host", "page", "tokens"])

    lists = pages.mapInPandas(run, "host string, page long, tokens array<struct<token:long,tag:boolean,n:int>>")
    lists = lists.groupBy("host", "page").agg(F.first("tokens").alias("tokens"))
    seen = lists.select("host", "page", F.explode(F.concat(
        "tokens", F.array(F.struct(F.lit(0).cast("long").alias("token"), F.lit(True).alias("tag"), F.lit(1).alias("n"))))).alias("t"))
    vectors = seen.groupBy("host", "t.token", "t.tag").agg(
        F.count("*").alias("pages"), F.sum(F.xxhash64("page", "t.n").cast("decimal(38,0)")).alias("vector"))
    # The many tokens of few pages are in no valid class; a host of few pages has none.
    vectors = vectors.where(F.col("pages") >= LEAST_PAGES)
    classes = vectors.groupBy("host", "pages", "vector").agg(
        F.max("tag").alias("nested"), F.collect_list(F.when(~F.col("tag"), F.col("token"))).alias("texts"),
        F.max(F.col("token") == 0).alias("root"))
    # The token 0 is on every page, so its class holds what all pages of the host have once.
    whole = classes.where("root").select("host", F.col("pages").alias("of"))
    valid = classes.where(f"nested and pages >= {LEAST_PAGES} and size(texts) > 0").join(whole, "host").where(
        F.col("pages") >= F.col("of") * LEAST_SHARE)
    return step(valid.groupBy("host").agg(F.flatten(F.collect_list("texts")).alias("fixed")))


def main_text(page: str, fixed: frozenset[int] = frozenset()) -> str:
    """The main text of one page: its blocks in order, joined by an empty line.

    What the template ``fixed`` fixes is left out, inside an article as well, and so are excluded containers. Among the
    slots that remain the article (or main element) decides: with one, the content is what stands inside. An article
    that is fixed as a whole stays.
    """
    found = [(path, text, inside) for path, text, inside, out_of_it in blocks(page) if text and not out_of_it]
    slots = [(text, inside) for path, text, inside in found if token(path, text) not in fixed]
    article = [text for _, text, inside in found if inside]
    inner = ([text for text, inside in slots if inside] or article) if article else [text for text, _ in slots]
    return "\n\n".join(inner)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text) per row of ``pages``; text is empty if a page has no content.

    A null or empty html is a page without content. Pages with a null url, or one without a host, are
    pages of one nameless host. Repeated rows give repeated rows; other columns are not read.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), _HOST.pattern, 1)), F.lit("")).alias("host")
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), host,
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    # Written first and so of known size: a short list is broadcast by Spark's own limit, a long one is not.
    told = slim.join(templates(slim.select("host", "html")), "host", "left").select("page_id", "url", "html", "fixed")
    kind = slim.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets: dict[bytes, frozenset[int]] = {}
            texts = []
            for page, fixed in zip(batch["html"], batch["fixed"]):
                key = b"" if fixed is None else bytes(memoryview(fixed.tobytes()))
                if key not in sets:
                    sets[key] = frozenset() if fixed is None else frozenset(fixed.tolist())
                texts.append(main_text(page, sets[key]))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    return told.mapInPandas(run, f"page_id {kind}, url string, text string")
