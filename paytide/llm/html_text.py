"""Main text of web pages, with boilerplate found by suffix arrays per host.

A page is cut into blocks of visible text. Markup tells what it can: blocks inside the article (else
inside ``main``) are the text, and menus, headers, footers, sidebars, notices, adverts, forms and
reader comments are not, whether marked by their element, their role or their class. A class that only
contains such a word may name the layout, so an article inside is judged like other text; and words that name topics as well, such as
*related* or *share*, count only if the rest of the name says that it is a part of a page. Everything else
outside the article is judged by its host: the token streams of the host's pages are concatenated,
a suffix array over them yields the substrings of at least ``REPEATED`` words that occur in distinct
pages, and words so covered are boilerplate, as are whole blocks that distinct pages share. A page
without an article or ``main`` keeps the uncovered runs of its blocks.

Inside an article only boxes are judged: lists, tables, sections and the like that hold less than half of its
words. What ``REPEATED`` words or more of such a box have in common with another article or part of the host goes. Other blocks of an
article are its text, however often the host repeats them: articles quote each other and are copied. Copies do not
judge each other either: pages of a host without an article whose blocks to be judged are the same count as one
page, as do articles that are the same outside their boxes, by the least hash of its word runs, which
nearly equal articles mostly share.

Equal blocks of a host are one row before the suffix arrays are built. A host with more than
``CHUNK_WORDS`` words is divided: a block goes to the chunks its winnowed fingerprints name, and two
blocks with ``REPEATED`` words in common have a fingerprint in common, so they meet in a chunk
and dividing changes no result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .tables import map_rows, written

REPEATED = 12
# Fingerprints are over so many words; the least of each window of REPEATED - GRAM + 1 counts.
GRAM = 6
CHUNK_WORDS = 200_000

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")

# Elements whose content is no text of the page.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "noframes", "xmp", "canvas", "object", "video", "audio"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
# Elements, roles and words in a class or id that mark a part as something else than the article.
ASIDE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "label", "fieldset", "header"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "note"}
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar widget widgets footer header masthead comment comments disqus replies cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations pagination pager toolbar skip".split()
)
# Of these, the words that an article inside does not disprove.
SURE_WORDS = {"comment", "comments", "disqus", "replies", "related", "recommended", "recommendations", "sidebar", "widget", "widgets"}
# These say something only together with words for parts of a page: ``related-posts`` is one, ``related-work`` is not.
WEAK_WORDS = set(
    "ad ads promo promotion banner notice popup modal overlay subscribe subscription signup login share sharing social related "
    "recommended recommendations pager toolbar skip header menu".split()
)
PART_WORDS = set(
    "box block list section wrap wrapper container area post posts link links item items bar button buttons icon icons unit slot panel "
    "strip row col column card cards module tile tiles inner outer top bottom left right side center main site page user reader "
    "article articles story stories news reading content form forms media group set tools tool tray float fixed sticky desktop "
    "mobile small large primary secondary global sub in up out us on to nav title entry blog widget header footer".split()
)
CLASS_WORD = re.compile(r"[a-z]+")
# What follows one of these in a name tells what the page has or lacks, not what the element is.
LAYOUT_WORDS = {"has", "have", "with", "without", "no", "non", "not"}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

# Elements that are boxes where they hold the smaller part of an article.
BOX_TAGS = {"div", "section", "table", "ul", "ol", "dl", "details", "figure", "center"}

OTHER, MAIN, ARTICLE, ASIDE = range(4)
# A PART is a sure word that is only a part of a class or id.
NO, MAYBE, PART, SURE = range(4)

PARSED_SCHEMA = "page_id long, url string, host string, text string, content long, others array<string>, judged array<boolean>, asides array<string>"
CHUNK_SCHEMA = "host string, chunk long, id long, block string, page long"
COVER_SCHEMA = "id long, start int, stop int"
COVER_ARROW = pa.schema([("id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def is_aside(tag: str, raw: str, in_article: bool) -> int:
    """Does an element hold something else than the article?"""
    if tag in ASIDE_TAGS and not (tag == "header" and in_article):
        return SURE
    if not raw or raw.isspace() or tag in ("html", "body"):
        return NO
    marks = attributes(raw)
    if "hidden" in marks or marks.get("aria-hidden") == "true" or HIDDEN.search(marks.get("style", "")):
        return SURE
    if marks.get("role", "").lower() in ASIDE_ROLES:
        return SURE
    if tag == "main" or tag in HEADINGS:
        return NO
    words = ASIDE_WORDS - {"header"} if in_article else ASIDE_WORDS
    names = f"{marks.get('class', '')} {marks.get('id', '')}".lower().split()
    return max((named_aside(CLASS_WORD.findall(name), words) for name in names), default=NO)


def named_aside(parts: list[str], words: set[str]) -> int:
    """What one class or id, given by its words, says."""
    if parts[-1:] == ["off"]:
        return NO
    told = set(parts[: next((n for n, w in enumerate(parts) if w in LAYOUT_WORDS), len(parts))])
    if told & words <= WEAK_WORDS and not told <= words | PART_WORDS:
        return NO
    if told & SURE_WORDS:
        return SURE if len(parts) == 1 else PART
    return MAYBE if told & words else NO


def blocks(page: str) -> list[tuple[int, str, tuple | None]]:
    """(where, text, container) of every block with visible text, in page order.

    A container is its place in the page and the container around it, if that is in the same part of the page.
    """
    out: list[tuple[int, str, tuple | None]] = []
    held: list[str] = []
    # Open block elements: name, what their text is, how sure it is that they are none of the article, and the container.
    stack: list[tuple[str, int, int, tuple | None]] = []
    where = OTHER

    def close():
        if held:
            text = SPACE.sub(" ", html.unescape("".join(held))).strip()
            if text:
                out.append((where, text, stack[-1][3] if stack else None))
            held.clear()

    at, size = 0, len(page)
    while at < size:
        m = MARKUP.search(page, at)
        if not m:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0].startswith("<![CDATA["):
                held.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, closing, raw = name.lower(), bool(m[1] or m[4]), m[3] if m[2] else m[6]
        if tag in RAW:
            if not closing and not raw.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>?", re.IGNORECASE).search(page, at)
                at = end.end() if end else size
            if tag not in INLINE:
                close()
            continue
        if tag in INLINE:
            continue
        close()
        if tag in VOID:
            continue
        if closing:
            where = closed(stack, tag, where)
        elif not raw.endswith("/"):
            where = opened(stack, tag, raw, where, at)
    close()
    return out


def opened(stack: list[tuple[str, int, int, tuple | None]], tag: str, raw: str, where: int, at: int) -> int:
    inside, sure = where, stack[-1][2] if stack else NO
    aside = is_aside(tag, raw, where == ARTICLE)
    if aside == SURE or (aside and (tag != "article" or where == ARTICLE)):
        inside, sure = ASIDE, SURE if where == ARTICLE else max(sure, aside)
    elif tag == "article" and sure != SURE:
        # An article may have a class that misleads, or stand in a container that has.
        sure = max(sure, aside)
        inside = OTHER if sure == PART else ARTICLE
    elif tag == "main" and sure != SURE and where in (OTHER, ASIDE):
        inside = OTHER if sure == PART else MAIN
    around = stack[-1][3] if stack and stack[-1][1] == inside else None
    stack.append((tag, inside, sure, (at, around) if tag in BOX_TAGS else around))
    return inside


def closed(stack: list[tuple[str, int, int, tuple | None]], tag: str, where: int) -> int:
    """Close the innermost open element of the name, and with it what was left open inside."""
    for n in range(len(stack) - 1, -1, -1):
        if stack[n][0] == tag:
            del stack[n:]
            return stack[-1][1] if stack else OTHER
        if stack[n][0] in ("article", "body") and tag in ("p", "div", "li", "section"):
            break
    return where


def parsed_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    for page_id, url, page in rows:
        found = blocks(page or "")
        best = max((w for w, _, _ in found if w != ASIDE), default=OTHER)
        main = [(text, around) for w, text, around in found if w == best and w != ASIDE]
        open_blocks = [True] * len(main) if best == OTHER else boxed(main)
        asides = [text for w, text, _ in found if w < best or w == ASIDE]
        others = [text for text, _ in main]
        if any(open_blocks):
            yield page_id, url, host_of(url), "", content(others, open_blocks, best), others, open_blocks, asides
        else:
            yield page_id, url, host_of(url), " ".join(others), None, [], [], asides


def boxed(main: list[tuple[str, tuple | None]]) -> list[bool]:
    """Which blocks of an article are to be judged: those of REPEATED words or more in a container with less than half of its words."""
    inside: dict[int, int] = {}
    outer: dict[int, int | None] = {}
    sizes = [text.count(" ") + 1 for text, _ in main]
    for size, (_, around) in zip(sizes, main):
        if around:
            inside[around[0]] = inside.get(around[0], 0) + size
        while around and around[0] not in outer:
            outer[around[0]] = around[1][0] if around[1] else None
            around = around[1]
    # A container begins before those in it.
    for place in sorted(outer, reverse=True):
        if outer[place] is not None:
            inside[outer[place]] = inside.get(outer[place], 0) + inside[place]
    half = sum(sizes) / 2
    # The innermost container is the smallest one.
    return [size >= REPEATED and around is not None and inside[around[0]] < half for size, (_, around) in zip(sizes, main)]


def content(texts: list[str], open_blocks: list[bool], best: int) -> int:
    """What tells a page with blocks to be judged from its copies."""
    if best == OTHER:
        return xxhash.xxh64_intdigest("\n".join(texts)) - (1 << 63)
    words = " ".join(text for text, box in zip(texts, open_blocks) if not box).split(" ")
    return min(xxhash.xxh64_intdigest(" ".join(words[i : i + GRAM])) for i in range(max(1, len(words) - GRAM + 1))) - (1 << 63)


def host_of(url: str | None) -> str:
    """The host of a URL in lower case; empty if there is none."""
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def parsed(pages: DataFrame) -> DataFrame:
    return map_rows(pages.select("page_id", "url", "html"), parsed_rows, PARSED_SCHEMA, 500)


def fingerprints(words: list[str]) -> set[int]:
    """Hashes of winnowed word runs: texts with REPEATED words in common share one."""
    grams = [xxhash.xxh64_intdigest(" ".join(words[i : i + GRAM])) for i in range(len(words) - GRAM + 1)]
    width = REPEATED - GRAM + 1
    return {min(grams[i : i + width]) for i in range(max(1, len(grams) - width + 1))} if grams else set()


def to_chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
    for host, block, page, identity, chunks in rows:
        words = block.split(" ")
        if len(words) < REPEATED:
            continue
        for chunk in {f % chunks for f in fingerprints(words)} if chunks > 1 else (0,):
            yield host, chunk, identity, block, page


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and how many tokens each has in common with the next, by prefix doubling.

    Tokens must be such that no common substring runs over a border of texts.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    levels, width = [rank], 1
    order = np.argsort(rank, kind="stable")
    while width < n and rank.max() < n - 1:
        key = rank * (n + 1)
        key[:-width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        levels.append(rank)
        width *= 2
    # The common length of neighbours is put together from the ranks of each width.
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1 if n else 0, dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        inside = (left + step <= n) & (right + step <= n)
        same = np.zeros(len(left), dtype=bool)
        same[inside] = levels[level][left[inside]] == levels[level][right[inside]]
        common[same] += step
        left[same] += step
        right[same] += step
        left, right = np.minimum(left, n), np.minimum(right, n)
    return order, common


def covered(texts: list[str], pages: list[int], least: int = REPEATED) -> list[list[tuple[int, int]]]:
    """Word ranges of each text that are part of a run of ``least`` words found in distinct pages.

    ``pages`` names the page of each text; a negative number stands for several pages.
    """
    known: dict[str, int] = {}
    words, owner, offset = [], [], []
    for n, text in enumerate(texts):
        for k, word in enumerate(text.split(" ")):
            words.append(known.setdefault(word, len(known)))
            owner.append(n)
            offset.append(k)
        # A border that occurs once keeps common runs inside one text.
        words.append(-1 - n)
        owner.append(n)
        offset.append(-1)
    tokens, owners, offsets = np.array(words, dtype=np.int64), np.array(owner), np.array(offset)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if len(tokens) < 2:
        return out
    order, common = suffix_array(tokens)
    # Neighbours with enough in common form a run; it counts if distinct pages are in it.
    run = np.concatenate([[0], np.cumsum(common < least)])
    page = np.array(pages, dtype=np.int64)[owners[order]]
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    several = (np.minimum.reduceat(page, first) != np.maximum.reduceat(page, first)) | (np.minimum.reduceat(page, first) < 0)
    lengths = np.diff(np.concatenate([first, [len(run)]]))
    starts = order[np.repeat(several & (lengths > 1), lengths)]
    marks = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + least, len(tokens)), -1)
    inside = (np.cumsum(marks[:-1]) > 0) & (offsets >= 0)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        # Runs of neighbouring texts are apart, because a border lies between.
        out[owners[begin]].append((int(offsets[begin]), int(offsets[end - 1]) + 1))
    return out


def judged(blocks_of_pages: DataFrame) -> DataFrame:
    """(host, block, ranges): the covered word ranges of every block text that has any.

    ``content`` tells pages by their blocks to be judged; it is null where there are none.
    """
    key = ["host", "block"]
    # Pages of one content are one page, named by the first of them.
    of_content = blocks_of_pages.groupBy(*key, "content").agg(F.min("page_id").alias("page"), F.max("page_id").alias("last"))
    of_content = of_content.withColumn("last", F.when(F.col("content").isNull(), F.col("last")).otherwise(F.col("page")))
    distinct = of_content.groupBy(*key).agg(F.min("page").alias("page"), F.max("last").alias("last"))
    distinct = distinct.withColumns({
        "page": F.when(F.col("page") < F.col("last"), F.lit(-1)).otherwise(F.abs(F.coalesce("page", F.lit(0)))).cast("long"),
        "words": F.size(F.split("block", " ")), "id": F.xxhash64(*key),
    }).drop("last")
    chunks = distinct.groupBy("host").agg(F.ceil(F.sum("words") / CHUNK_WORDS).cast("long").alias("chunks"))
    sent = map_rows(
        distinct.join(chunks, "host").select("host", "block", "page", "id", "chunks"), to_chunks, CHUNK_SCHEMA
    )

    def cover(key, table):
        texts, identities = table["block"].to_pylist(), table["id"].to_pylist()
        found = covered(texts, table["page"].to_pylist())
        rows = [(i, a, b) for i, ranges in zip(identities, found) for a, b in ranges]
        return pa.table([list(c) for c in zip(*rows)] if rows else [[], [], []], schema=COVER_ARROW)

    parts = sent.groupBy("host", "chunk").applyInArrow(cover, COVER_SCHEMA).distinct()
    ranges = parts.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("ranges"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("words").alias("stop")))
    told = distinct.join(ranges, "id", "left").withColumn("ranges", F.when(F.col("page") == -1, whole).otherwise(F.col("ranges")))
    return told.where("ranges IS NOT NULL").select(*key, "ranges")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_boilerplate) per row of ``pages``.

    ``n_boilerplate`` counts the words outside the text that the host's other pages repeat. A null or
    empty html has the empty text. Pages without a host are one host. Null page_ids are a row like
    others; they count as one page, and rows that share an id are one page, as are pages of a host whose
    blocks to be judged are the same and articles that are the same outside their boxes. Other columns are not
    read; an empty table gives an empty one.
    """
    own = parsed(pages)
    every = F.concat(
        F.filter(F.transform("others", lambda b, i: F.struct(b.alias("block"), F.get("judged", i).alias("open"))), lambda b: b["open"]),
        F.transform("asides", lambda b: F.struct(b.alias("block"), F.lit(False).alias("open"))),
    )
    rows = own.select("page_id", "host", "content", F.explode(every).alias("b"))
    rows = written(rows.select("page_id", "host", "content", "b.block", "b.open"), "blocks")
    told = rows.drop("content").join(judged(rows.select("page_id", "host", "content", "block")), ["host", "block"])
    length = F.aggregate("ranges", F.lit(0), lambda n, r: n + r["stop"] - r["start"])
    by_page = told.distinct().groupBy(F.col("page_id").alias("of")).agg(
        F.sum(length).alias("n_boilerplate"),
        F.collect_list(F.when(F.col("open"), F.struct("block", "ranges"))).alias("cuts"),
    )
    joined = own.join(by_page, F.col("page_id").eqNullSafe(F.col("of")), "left")
    final = map_rows(
        joined.select("page_id", "url", "text", "others", "judged", "cuts", F.coalesce("n_boilerplate", F.lit(0)).alias("n")),
        final_rows, "page_id long, url string, text string, n_chars long, n_boilerplate long", 500,
    )
    return final


def final_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    for page_id, url, text, others, open_blocks, cuts, n in rows:
        if others:
            ranges = {cut["block"]: [(r["start"], r["stop"]) for r in cut["ranges"]] for cut in cuts or ()}
            text = " ".join(filter(None, (unique_runs(b, ranges.get(b, ()) if box else ()) for b, box in zip(others, open_blocks))))
        yield page_id, url, text, len(text), n


def unique_runs(block: str, ranges) -> str:
    """What is left of a block without its covered words."""
    if not ranges:
        return block
    words = block.split(" ")
    keep = np.ones(len(words), dtype=bool)
    for start, stop in ranges:
        keep[start:stop] = False
    return " ".join(w for w, k in zip(words, keep) if k)
