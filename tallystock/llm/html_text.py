"""HTML main text by wrappers: union-free expressions inferred from the pages of each host.

A page becomes a stream of block tags, text slots and template texts. A text is template where its host repeats it: on
MIN_PAGES different pages or more, and either on half of the pages that have its path of enclosing blocks, or in a path
whose number of different texts is at most the root of its number of pages. Spark counts that over all pages; pages whose
candidate texts are all the same count as one. Texts inside ``article`` or ``main`` are never template, however often
the host repeats them: such blocks hold the article's own headings and closing lines. Adjacent repeats of a group fold into one repeated group. The streams
of a host are aligned one after the other: what both have stays, what only one has becomes optional. The result is
the host's wrapper; its text slots are those that vary, and they hold the article: those inside ``article`` or
``main`` blocks if it has any, otherwise all of them. Names of menus, headers, footers, sidebars, notices, adverts,
forms and comments are a hint that takes further slots out. Each page is read by its host's wrapper. A page that would be
empty then gives its other slots, in the order of _choices; only texts in elements of OUTSIDE are never given.

Equal streams of a host are folded in Spark first, and a host with many is aligned in groups of FOLD, then the groups'
wrappers among each other, so that no task holds all pages of a host.

Defined cases: a null or empty page has an empty text; a page without a usable address belongs to host ''; repeated rows are
read one by one; null ids are kept; tags that are never closed end with the page, and ``<`` that opens no tag is
text; an empty table gives no rows; results replace columns of the same name, all other columns stay.
"""

from __future__ import annotations

import html as references
import json
import re
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from tallystock.llm.ship import ship
from tallystock.session import materialize

FOLD = 128
SLOT, TEMPLATE = "#", "="
MIN_PAGES = 3  # texts on fewer different pages are never template

# Elements and names of the parts of a page.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "textarea", "select", "title", "math"}
OUTSIDE = {"head", "nav", "header", "footer", "aside", "form", "button", "dialog", "menu"} | RAW
ARTICLE = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "html", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
BREAKS_ONLY = {"hr"}
SPACES = {"br", "img", "wbr"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}}
OUTSIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "popup", "promo", "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "widget",
}
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


def _block_name(tag: str, attributes: str, in_article: bool = False) -> str:
    """The tag with what it says about its part of the page: ``tag``, ``tag!`` outside the article,
    ``tag~`` outside it by its class or id, ``tag*`` the article. A header in the article holds its headline."""
    own = {"header"} if in_article else set()
    outside, named = tag in OUTSIDE - own, False
    inside = tag in ARTICLE
    for kind, *values in _NAMED.findall(attributes):
        value = "".join(values).lower()
        if kind.lower() == "role":
            outside |= value in OUTSIDE_ROLES
            inside |= value in ("main", "article")
        else:
            named |= not (OUTSIDE_NAMES - own).isdisjoint(re.split(r"[^a-z]+", value)) and tag not in ("html", "body")
    return tag + ("!" if outside else "~" if named else "*" if inside else "")


def events(page: str) -> Iterator[tuple[str, str]]:
    """("open", name), ("close", tag) and ("text", text) of a page; texts are whole blocks, already cleaned."""
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    at, end = 0, len(page)

    def block() -> Iterator[tuple[str, str]]:
        text = " ".join(references.unescape("".join(parts)).split())
        parts.clear()
        if text:
            yield "text", text

    def close(upto: int) -> Iterator[tuple[str, str]]:
        yield from block()
        while len(stack) > upto:
            yield "close", stack.pop()[0]

    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        parts.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else end
            continue
        if tag in SPACES:
            parts.append(" ")
        elif tag in BREAKS_ONLY:
            yield from block()
        elif tag in BLOCKS and closing:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            yield from block() if k is None else close(k)
        elif tag in BLOCKS:
            ends = CLOSES.get(tag, {"p"} if tag not in ("html", "body", "head") else set())
            yield from close(len(stack) - 1) if stack and stack[-1][0] in ends else block()
            stack.append((tag, _block_name(tag, m[3], any("*" in name for _, name in stack))))
            yield "open", stack[-1][1]
    yield from close(0)


def slots(page: str) -> Iterator[tuple[str, str]]:
    """(path, text) of every block of text, in page order."""
    path: list[str] = []
    for kind, value in events(page):
        if kind == "open":
            path.append(value)
        elif kind == "close":
            path.pop()
        else:
            yield "/".join(path), value


def fold(tokens: list) -> list:
    """Adjacent repeats of groups of up to 8 tokens become one repeated group ["+", token, ...]."""
    for size in range(1, 9):
        out: list = []
        for token in tokens:
            out.append(token)
            if len(out) >= 2 * size and out[-size:] == out[-2 * size:-size]:
                del out[-size:]
                out[-size:] = [["+", *out[-size:]]] if not (size == 1 and isinstance(out[-1], list)) else out[-1:]
            elif len(out) > size and isinstance(out[-size - 1], list) and out[-size - 1] == ["+", *out[-size:]]:
                del out[-size:]
        tokens = out
    return tokens


def _key(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _is_template(path: str, text: str, template: frozenset[int]) -> bool:
    """Whether the host repeats a text. What the article repeats, its headings say, belongs to it."""
    return bool(template) and "*" not in path and _key(path, text) in template


def stream(page: str, template: frozenset[int] = frozenset()) -> list:
    """The page's tokens: opened and closed blocks, slots and template texts with their path."""
    path: list[str] = []
    tokens: list = []
    for kind, value in events(page):
        if kind == "open":
            path.append(value)
            tokens.append(f"<{value}>")
        elif kind == "close":
            tokens.append(f"</{path.pop()}>")
        else:
            at = "/".join(path)
            token = (TEMPLATE if _is_template(at, value, template) else SLOT) + at
            if tokens[-1:] != [token]:
                tokens.append(token)
    return fold(tokens)


def align(a: list, b: list) -> list:
    """The wrapper of two wrappers: common tokens stay, others become optional groups ["?", token, ...]."""
    if a == b:
        return a
    plain = lambda tokens: [t for group in tokens for t in (  # noqa: E731  optional groups are opened, and marked again
        [(json.dumps(x), True) for x in group[1:]] if isinstance(group, list) and group[0] == "?" else [(json.dumps(group), False)])]
    left, right = plain(a), plain(b)
    out: list[tuple[str, bool]] = []
    matcher = SequenceMatcher(None, [t for t, _ in left], [t for t, _ in right], autojunk=False)
    for kind, a0, a1, b0, b1 in matcher.get_opcodes():
        if kind == "equal":
            out += [(t, o or p) for (t, o), (_, p) in zip(left[a0:a1], right[b0:b1], strict=True)]
        else:
            out += [(t, True) for t, _ in (*left[a0:a1], *right[b0:b1])]
    merged: list = []
    for token, optional in out:
        value = json.loads(token)
        if not optional:
            merged.append(value)
        elif merged and isinstance(merged[-1], list) and merged[-1][0] == "?":
            merged[-1].append(value)
        else:
            merged.append(["?", value])
    return merged


def _paths(wrapper: list, kinds: str) -> Iterator[str]:
    for token in wrapper:
        if isinstance(token, list):
            yield from _paths(token[1:], kinds)
        elif token[:1] in kinds:
            yield token[1:]


def _allowed(path: str) -> bool:
    return "!" not in path


def article_paths(wrapper: list) -> set[str]:
    """Paths of the slots that hold the article; a wrapper that holds nothing but template texts has the paths of these."""
    for kinds in (SLOT, SLOT + TEMPLATE):
        allowed = {p for p in _paths(wrapper, kinds) if _allowed(p)}
        for found in ({p for p in allowed if "~" not in p}, allowed):
            if found:
                return {p for p in found if "*" in p} or found
    return set()


def _choices(found: list[tuple[str, str]], paths: set[str], template: frozenset[int]) -> Iterator[list[str]]:
    """What a page may give, best first; with a name in the way only if nothing else is there."""
    varying = [(p, t) for p, t in found if not _is_template(p, t, template)]
    yield [t for p, t in varying if p in paths]
    for slots_left in (varying, found):
        yield [t for p, t in slots_left if "~" not in p]
        yield [t for _, t in slots_left]


def main_text(page: str, paths: set[str], template: frozenset[int] = frozenset()) -> str:
    found = [(p, t) for p, t in slots(page) if _allowed(p)]
    return "\n\n".join(next(filter(None, _choices(found, paths, template)), []))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each page: hashes of its paths and of its texts there; text 0 stands for the path itself."""
    for batch in batches:
        hosts, keys, paths, texts = [], [], [], []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            whole = [(p, t) for p, t in slots(page or "") if _allowed(p)]
            found = [(_key(p), _key(p, t)) for p, t in whole if "*" not in p]
            if found:
                pairs = sorted({*found, *((p, 0) for p, _ in found)})
                hosts.append(host)
                keys.append(_key(*(x for slot in whole for x in slot)))
                paths.append([p for p, _ in pairs])
                texts.append([t for _, t in pairs])
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(paths, pa.list_(pa.int64())),
             pa.array(texts, pa.list_(pa.int64()))], ["host", "page", "path", "text"])


def template_texts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Rows (host, template): hashes of the texts, with their paths, that a host repeats."""
    own = pages.select(_host(url).alias("host"), html).mapInArrow(
        _texts, "host string, page long, path array<long>, text array<long>").distinct()
    counted = materialize(own.select("host", F.inline(F.arrays_zip("path", "text"))).groupBy("host", "path", "text").agg(
        F.count("*").alias("n")), "slot-texts")
    per_path = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("text") == 0, F.col("n"))).alias("pages"), F.count_if(F.col("text") != 0).alias("texts")
    ).where(F.col("pages") >= MIN_PAGES)
    repeated = counted.where((F.col("text") != 0) & (F.col("n") >= MIN_PAGES)).join(per_path, ["host", "path"]).where(
        "2 * n >= pages or texts * texts <= pages")
    return repeated.groupBy("host").agg(F.collect_set("text").alias("template"))


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str, frozenset[int]] = {}
        found = []
        for host, page, template in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if host not in known:
                known[host] = frozenset(template or ())
            found.append(json.dumps(stream(page or "", known[host])))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["host", "wrapper"])


def _fold_wrappers(rows: pa.Table) -> pa.Table:
    ordered = sorted(rows["wrapper"].to_pylist(), key=lambda w: (len(w), w))
    whole = json.loads(ordered[0])
    for other in ordered[1:]:
        whole = align(whole, json.loads(other))
    return pa.table({"host": rows["host"].slice(0, 1), "wrapper": pa.array([json.dumps(whole)], pa.string())})


def infer_wrappers(pages: DataFrame, url: str = "url", html: str = "html", templates: DataFrame | None = None) -> DataFrame:
    """Rows (host, wrapper as JSON), one for each host."""
    templates = template_texts(pages, url, html) if templates is None else templates
    own = pages.select(_host(url).alias("host"), F.col(html).alias("html")).join(templates, "host", "left").select(
        "host", "html", "template")
    wrappers = materialize(own.mapInArrow(_streams, "host string, wrapper string").distinct(), "streams")
    while True:
        sizes = wrappers.groupBy("host").agg(F.ceil(F.count("*") / FOLD).alias("groups"), F.count("*").alias("n"))
        most = sizes.agg(F.max("n")).first()[0] or 1
        if most == 1:
            return wrappers
        dealt = wrappers.join(sizes, "host").withColumn("_group", F.pmod(F.xxhash64("wrapper"), F.col("groups")))
        wrappers = materialize(dealt.select("host", "wrapper", "_group").groupBy("host", "_group").applyInArrow(
            _fold_wrappers, "host string, wrapper string"), "wrappers")


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _extractor(schema: StructType, at_html: int) -> Callable:
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[set[str], frozenset[int]]] = {}
        for batch in batches:
            hosts, wrappers, templates = batch.columns[-3:]
            texts = []
            for k, (page, host) in enumerate(zip(batch.column(at_html).to_pylist(), hosts.to_pylist(), strict=True)):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    wrapper = wrappers[k].as_py()
                    known[host] = (article_paths(json.loads(wrapper)) if wrapper else set(),
                                   frozenset(templates[k].as_py() or ()))
                texts.append(main_text(page or "", *known[host]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(texts, pa.string())], schema=arrow)
    return rows


def extract_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text of each."""
    pages = pages.drop("text", "_host", "_wrapper", "_template")
    templates = materialize(template_texts(pages, url, html), "templates")
    wrappers = infer_wrappers(pages, url, html, templates).join(templates, "host", "left").select(
        F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"), F.col("template").alias("_template"))
    joined = pages.withColumn("_host", _host(url)).join(wrappers, "_host", "left").select(
        *pages.columns, "_host", "_wrapper", "_template")
    schema = StructType([*pages.schema.fields, StructField("text", StringType())])
    return joined.mapInArrow(_extractor(schema, pages.columns.index(html)), schema)


def op8(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    found = extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
