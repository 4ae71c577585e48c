"""HTML main-text extraction by equivalence-class template deduction.

A page's tokens are its tags, told apart by their path from the root (with the
element's class words that hold no digit; an id or a number names a thing, not
a slot), and the texts of its blocks, told apart by path and text.  Tokens of
the same host whose occurrence vectors over the host's distinct pages agree form
an equivalence class of tags and texts.  A class is valid if at least
``min_pages`` pages support it and it has several tokens or stands on at least
``most`` of the pages; valid classes nest by their paths into the host's
template.  A text's slot is the deepest template path around it.  A text of a
valid class that stands on at least ``most`` of the pages with its slot is part
of the template; the rest fills the slots.

Slots of menus, headers, footers, sidebars, notices, adverts, forms, scripts and
comments are left out, by the elements on their path (whole class words and ids,
no ids of headings, never html, body, article or main themselves; an element
around the article leaves it out only if the page has another).  If the page has
an article (or main) slot, that alone is kept.  What is left loses its template
texts.  If those are more than half of it by length, the page is a near copy and
no frame of other text, so it keeps them; texts outside of an article that stand
on ``most`` of the host's pages always go.

Occurrence vectors are compared by a hash that is summed (xor) over pages, so a
host with a third of all pages is aggregated map-side.  A page receives the
template tokens that it holds, so no row grows with its host.  Tokens are 64-bit
hashes.  Identical pages count once.

Blocks: character references are decoded, white space in a block becomes one
space, blocks are trimmed, empty ones go, the rest are joined by one newline.

Edge cases: null html gives an empty text; a null or unreadable url belongs to
one nameless host; a host with one page has no template, and the elements alone
decide; unclosed and stray tags are tolerated; repeated rows get equal results;
an empty table gives an empty result; other columns pass through, an input column named
``text`` is replaced, and helper columns are named around the input's.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, ship_by_value

#: Elements by role, from the HTML standard, and the usual class words (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe svg math object canvas audio video textarea select title".split())
CHROME = frozenset("nav footer aside form button dialog menu head".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody
td tfoot th thead title tr ul""".split())
CHROME_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
notice notices notification pagination popup promo promotion related replies reply search share sharing sidebar signup social
sponsor sponsored subscribe subscription toolbar widget""".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
CLOSES_P = BLOCK - {"option", "legend", "summary"}
#: An open element of the first kind ends where one of the second kind starts.
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
                "th": {"td", "th", "tr"}, "option": {"option"}, "p": CLOSES_P}
SCOPES = frozenset("article main section div td th ul ol table body html nav header footer aside form dl".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|math|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|[^<]+|<""", re.S | re.I)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
DIGIT = re.compile(r"\d")
#: Elements that are never left out by themselves, and those whose id names a title, not a role.
WHOLE = frozenset("html body article main".split())
TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())


def _names(element: str, attributes: str) -> tuple[str, bool]:
    """An element's class for its path; whether class, id and the like mark it as no main text."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return "", False
    label, chrome, seen = "", False, set()
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in seen:
            continue
        seen.add(name)
        if name in ("class", "id"):
            words = value.split()
            if name == "class":
                label = "".join("." + w.replace("/", "-") for w in words if not DIGIT.search(w))
            chrome = chrome or not (name == "id" and element in TITLES) and not CHROME_WORDS.isdisjoint(words)
        elif name == "role":
            chrome = chrome or value in CHROME_ROLES
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            chrome = True
    return label, chrome and element not in WHOLE


def parse(html: str):
    """(paths of the opened elements, blocks), a block being (path, in article, no main text, text).

    No main text: 0 for none, 1 if only elements around the article say so, 2 otherwise."""
    paths, blocks = [], []
    stack = [("", "", False, 0)]  # element, path, inside an article, left out
    parts: list[str] = []

    def flush():
        text = " ".join(unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            blocks.append((*stack[-1][1:], text))

    def close(depth: int):
        del stack[depth:]

    for m in TOKEN.finditer(html):
        name = m[3]
        if name is None:
            if m[0][0] != "<" or m[0] == "<":
                if not stack[-1][0] in SILENT:
                    parts.append(m[0])
            elif m[1]:
                paths.append(f"{stack[-1][1]}/{m[1].lower()}")
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        elif name == "br":
            parts.append(" ")
        if m[2]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    if name not in BLOCK and any(e[0] in BLOCK for e in stack[depth + 1:]):
                        flush()
                    close(depth)
                    break
                if stack[depth][0] in SCOPES and name not in BLOCK:
                    break
            continue
        for depth in range(len(stack) - 1, 0, -1):
            element = stack[depth][0]
            if name in SELF_CLOSING.get(element, ()):
                close(depth)
                break
            if element in SCOPES:
                break
        _, above, article, out = stack[-1]
        label, chrome = _names(name, m[4])
        path = f"{above}/{name}{label}"
        paths.append(path)
        if name in VOID or m[4].endswith("/"):
            continue
        if not article and name in ("article", "main"):
            article, out = True, min(out, 1)
        # a header inside of an article holds its title
        if name in CHROME or name in SILENT or chrome or name == "header" and not article:
            out = 2
        stack.append((name, path, article, out))
    flush()
    return paths, blocks


def _token(path: str, text: str | None = None) -> int:
    h = xxhash.xxh64_intdigest(path if text is None else f"{path}={text}")
    return h - (1 << 64) if h >> 63 else h


ROOT = _token("")


def page_tokens(html: str) -> Counter:
    paths, blocks = parse(html)
    tokens = Counter({ROOT: 1})
    for path, n in Counter(paths).items():
        tokens[_token(path)] += n
    for path, _, _, text in blocks:
        tokens[_token(path, text)] += 1
    return tokens


def _emit_tokens(batches):
    for batch in batches:
        rows = [(host, page, token, n) for host, page, html in zip(batch["host"], batch["page"], batch["html"])
                for token, n in page_tokens(html or "").items()]
        yield pd.DataFrame(rows, columns=["host", "page", "token", "n"])


def host_of(url_col: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1), F.lit("")))


def host_tokens(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, page, token, n): how often each distinct page of a host holds a token."""
    source = pages.where(F.col(html_col).isNotNull()).select(host_of(url_col).alias("host"), F.xxhash64(html_col).alias("page"),
                                                             F.col(html_col).alias("html"))
    return source.mapInPandas(_emit_tokens, "host string, page long, token long, n int").distinct()


def templates(tokens: DataFrame, min_pages: int = 3, most: float = 0.5) -> DataFrame:
    """(host, token, support): the tokens of the hosts' valid classes and the pages that hold them."""
    counts = tokens.where(F.col("token") == ROOT).groupBy("host").agg(F.count("*").alias("pages"))
    vectors = (tokens.groupBy("host", "token")
               .agg(F.count("*").alias("support"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"))
               .where(F.col("support") >= min_pages))
    # tokens of a class stand on the same pages, so a class is not larger than a page
    classes = (vectors.groupBy("host", "vector", "support").agg(F.collect_list("token").alias("tokens"))
               .join(counts, "host").where((F.size("tokens") > 1) | (F.col("support") >= F.col("pages") * F.lit(most))))
    return classes.select("host", F.explode("tokens").alias("token"), "support")


def extract(html: str | None, template: dict[int, int] | None, most: float = 0.5) -> str:
    """The texts that fill the main slots; ``template``: the page's template tokens and their support."""
    if not html:
        return ""
    _, blocks = parse(html)
    # an article inside of an element that is left out counts if the page has no other
    least = min((out for _, article, out, _ in blocks if article), default=0) % 2
    main = any(article and out == least for _, article, out, _ in blocks)
    kept = [(path, article, text) for path, article, out, text in blocks if out == least and (article or not main)]
    if not template:
        return "\n".join(text for _, _, text in kept)

    def slot(path: str) -> int:
        """The pages that hold the deepest template path around a text."""
        while path and _token(path) not in template:
            path = path.rpartition("/")[0]
        return template.get(_token(path), 0)

    filled, repeated, size = [], set(), 0
    for path, article, text in kept:
        support = template.get(_token(path, text), 0)
        if support and not article and support >= most * template.get(ROOT, 0):
            continue
        if support and support >= most * slot(path):
            repeated.add(len(filled))
            size += len(text)
        filled.append(text)
    if 2 * size <= sum(map(len, filled)):
        filled = [text for i, text in enumerate(filled) if i not in repeated]
    return "\n".join(filled)


def extract_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = 3) -> DataFrame:
    """``pages`` plus ``text`` (a column of this name is replaced)."""
    scratch = Scratch(pages.sparkSession, "htmltext")
    tokens = scratch.table(host_tokens(pages, url_col, html_col), "tokens")
    found = scratch.table(templates(tokens, min_pages), "templates")
    host, page, of, copy, known = fresh(pages, "host", "page", "of", "copy", "known")
    held = (tokens.join(found, ["host", "token"]).groupBy(F.col("host").alias(of), F.col("page").alias(copy))
            .agg(F.collect_list(F.struct("token", "support")).alias(known)))

    @F.pandas_udf("string")
    def texts(html: pd.Series, held_tokens: pd.Series, support: pd.Series) -> pd.Series:
        return pd.Series([extract(h, None if t is None else dict(zip(t.tolist(), s.tolist())))
                          for h, t, s in zip(html, held_tokens, support)], dtype=object)

    joined = (pages.withColumns({host: host_of(url_col), page: F.xxhash64(html_col)})
              .join(held, (F.col(host) == F.col(of)) & (F.col(page) == F.col(copy)), "left"))
    return joined.select(*[c for c in pages.columns if c != "text"],
                         texts(F.col(html_col), F.col(f"{known}.token"), F.col(f"{known}.support")).alias("text"))


def op10_html_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


ship_by_value(__name__)
