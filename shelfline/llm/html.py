"""Main text of web pages by site style trees: pages of one host are merged, repeated branches are pruned from each page.

Every page is read twice. The first pass merges the DOMs of a host. An element stands at a place: the place of its parent, the
parent's style (its sequence of child elements and texts, tags with their first class, runs of equal ones as one) and its
position in it. A text's importance is the mean over its contents of ``1 - log(pages with the content) / log(pages with the
place)``: near 0 where the same contents come on all pages, near 1 where every page has its own. An element's importance is
composed of the entropy of its styles over the pages and the importance of its children, as in site style trees. A place that
few pages have cannot be judged and counts as important in its parent. The second pass removes each text whose closest judged
branch is of low importance, and each content that half of the pages with its path of tags repeat.

Copies of a page count as one page of the host. Where a host has fewer than ``JUDGED_PAGES`` different pages, its tree is not
used; if such a page marks its article (``article``, ``main``), only blocks inside count. Elements and roles that name a menu,
footer, form or advert go everywhere. Class and id words go too, unless nearly all text of a page is inside and the tree does not
find it low.

Edge cases: null or empty html gives an empty text; a null or broken url has no host and no tree; repeated pages stay;
unclosed and stray tags are tolerated; an unclosed script runs to the end of the page; an empty table gives no rows; extra
columns are carried along, clashing names are replaced.
"""

from __future__ import annotations

import html as entities
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import table
from shelfline.operators.relational import fits_broadcast
from shelfline.session import written

#: Branches below this importance are removed, if at least this many pages of the host have them.
LOW_IMPORTANCE = 0.3
JUDGED_PAGES = 5
#: Weight of an element's children against its own styles, for each style (gamma of the site style tree).
CHILDREN = 0.9
#: Elements below this depth belong to the place above them.
DEEPEST = 48
#: A branch with a noise class stays if all other text of the page is less than this share of it.
REST = 0.1

_TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# How HTML elements behave.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe noembed noframes xmp svg canvas annotation annotation-xml".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li legend main menu nav ol optgroup option p pre search section select summary"
    " table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"head", "html", "body", "option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend"}
CLOSED_BY_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

# Elements, roles and class words that never hold the article.
NOISE_TAGS = set("nav footer aside form button select dialog menu input head search label fieldset".split())
MAIN_TAGS = {"article", "main"}
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist cookie cookies"
    " consent disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup"
    " promo promotion related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: A block outside of noise, in a branch that its class or id calls noise, and in one that its element or role does.
CLEAN, HINTED, CERTAIN = 0, 1, 2


def _key(*parts: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack(f"<{len(parts)}Q", *parts)) >> 1 | 1


def _content(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1 | 1


class _Place:
    """A block element, or a text where ``block`` is set."""

    __slots__ = ("above", "block", "children", "depth", "key", "label", "path", "style", "width")

    def __init__(self, above: _Place | None, label: int, block: _Block | None = None):
        self.above, self.label, self.block, self.children = above, label, block, []
        self.depth = above.depth + 1 if above else 0
        self.path = _key(above.path, label) if above else 1
        self.key, self.style, self.width = 1, 0, 0


class _Block:
    __slots__ = ("main", "noise", "place", "tag", "text")

    def __init__(self, text: str, above: _Place, tag: str, main: bool, noise: int):
        self.text, self.tag, self.main, self.noise = text, tag, main, noise
        self.place = _Place(above, _TEXT, self)


_TEXT = _content("#")


def style_tree(blocks: list[_Block]) -> list[_Place]:
    """All places of a page that hold text, from the top down, with their keys and styles."""
    levels: dict[int, list[_Place]] = {}
    seen = set()
    for block in blocks:
        line, place = [], block.place
        while place is not None and id(place) not in seen:
            seen.add(id(place))
            line.append(place)
            place = place.above
        for own in reversed(line):
            if own.above is not None:
                own.above.children.append(own)
            levels.setdefault(own.depth, []).append(own)
    found = []
    for depth in sorted(levels):
        for place in levels[depth]:
            found.append(place)
            if place.block is not None:
                continue
            labels, at = [], []
            for child in place.children:
                if not labels or labels[-1] != child.label:
                    labels.append(child.label)
                at.append(len(labels))
            place.style, place.width = _key(*labels), len(labels)
            for child, k in zip(place.children, at, strict=True):
                child.key = _key(place.key, place.style, k)
    return found


def blocks_of(page: str) -> list[_Block]:
    """Text blocks of a page in order, with their place and whether they stand in the article or in a noise branch."""
    found: list[_Block] = []
    # Open elements: tag, place, block tag, in main, noise of the block, and noise of inline elements inside the block.
    stack: list[tuple[str, _Place, str, bool, int, int]] = [("", _Place(None, 0), "", False, CLEAN, CLEAN)]
    parts: list[str] = []

    def flush() -> None:
        if parts:
            raw = "".join(parts)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                found.append(_Block(text, *stack[-1][1:5]))
            parts.clear()

    def close(to: int) -> None:
        if any(x[0] in BLOCK for x in stack[to:]):
            flush()
        del stack[to:]

    at, size = 0, len(page)
    while at < size:
        tag = _TAG.search(page, at)
        piece = page[at : tag.start() if tag else size]
        if piece and not stack[-1][5]:
            parts.append(piece)
        if not tag:
            break
        at = tag.end()
        end, name, rest = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if end:
            if name == "br" or name == "p" and all(x[0] != "p" for x in stack):
                flush() if name == "p" else parts.append(" ")
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if stack[k][0] in ("table", "td", "th", "article", "body") and name not in BLOCK:
                    break
            continue
        if name in RAW:
            if not rest.rstrip().endswith("/"):
                stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else size
            continue
        if name in BLOCK:
            if name in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in BLOCK:
                        break
            if name in CLOSED_BY_ITSELF:
                for k in range(len(stack) - 1, 0, -1):
                    own = stack[k][0]
                    if own == name or {own, name} <= {"dt", "dd"} or {own, name} <= {"td", "th"} or name == "tr" and own in ("td", "th"):
                        close(k)
                        if not (name == "tr" and own in ("td", "th")):
                            break
                    elif own in CLOSED_BY_ITSELF[name]:
                        break
            flush()
        elif name == "br":
            parts.append(" ")
        if name in VOID:
            continue
        _, place, block, main, noise, inline = stack[-1]
        label, own = name, CLEAN
        if rest and not rest.isspace():
            marks = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(rest)}
            if marks:
                role = marks.get("role", "")
                words = {*marks.get("class", "").split(), *marks.get("id", "").split()}
                label = f"{name}.{marks['class'].split()[0]}" if marks.get("class", "").strip() else name
                if role in NOISE_ROLES:
                    own = CERTAIN
                elif words & NOISE_WORDS and name not in ("html", "body", "article", "main"):
                    own = HINTED
                main = main or role == "main"
        if name in NOISE_TAGS or name == "header" and not main:
            own = CERTAIN
        main = main or name in MAIN_TAGS
        if name in BLOCK:
            if place.depth < DEEPEST:
                place = _Place(place, _content(label))
            stack.append((name, place, name, main, max(noise, inline, own), CLEAN))
        else:
            stack.append((name, place, block, main, noise, max(inline, own)))
    flush()
    return found


def _host(url: str) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_PLACES = "_host string, page long, kind byte, place long, value long, above long, style long, width int, depth int"
#: Kinds of rows: an element with its style, a text with its content, a path of tags with a content.
ELEMENT, TEXT, PATH = 0, 1, 2


def place_values(pages: DataFrame, html: str = "html") -> DataFrame:
    """First pass: the styles and contents of every place of a page, once for the page; value 0 stands for the place itself.

    ``page`` is a hash of all texts outside of noise, the same for all copies of a page, whatever adverts they came with.
    Only those rows carry what the place determines: the place and style above it, the style's width, and the depth.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(9)]
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, blocks = set(), blocks_of(page or "")
                same = _key(*[_content(b.text) for b in blocks if not b.noise] or [_content(b.text) for b in blocks])
                for x in style_tree(blocks):
                    up = x.above
                    kind, value = (ELEMENT, x.style) if x.block is None else (TEXT, _content(x.block.text))
                    rows.add((kind, x.key, 0, up.key if up else 0, up.style if up else 0, up.width if up else 1, x.depth))
                    rows.add((kind, x.key, value, None, None, None, None))
                    if kind == TEXT:
                        rows.add((PATH, x.path, 0, None, None, None, None))
                        rows.add((PATH, x.path, value, None, None, None, None))
                for row in rows:
                    for column, v in zip(columns, (host, same, *row), strict=True):
                        column.append(v)
            kinds = [pa.string(), pa.int64(), pa.int8(), *[pa.int64()] * 4, pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _PLACES.split(", ")])

    return pages.select("_host", html).mapInArrow(run, _PLACES)


def site_trees(pages: DataFrame, html: str = "html") -> DataFrame:
    """The merged tree of each host that can be judged, as far as it is needed: ``_host, low, stops, contents``.

    ``low`` has the places of low importance, ``stops`` the important ones right below them, ``contents`` the contents that
    half of the pages with a path repeat (a hash of both).
    """
    counts = place_values(pages.where(F.col("_host") != ""), html).distinct().groupBy("_host", "kind", "place", "value")
    counts = written(counts.agg(F.count(F.lit(1)).alias("k"), *[F.max(c).alias(c) for c in ("above", "style", "width", "depth")]), "place-values")
    log = F.when(F.col("value") != 0, F.log("k"))
    times = F.when(F.col("value") != 0, F.col("k"))
    places = counts.groupBy("_host", "kind", "place").agg(
        F.max(F.when(F.col("value") == 0, F.col("k"))).alias("pages"),
        F.count(times).alias("values"),
        F.sum(log).alias("logs"),
        F.sum(times).alias("total"),
        F.sum(times * log).alias("weighted"),
        *[F.max(c).alias(c) for c in ("above", "style", "width", "depth")],
    )
    places = written(places.where(F.col("pages") >= JUDGED_PAGES), "judged-places")
    base = F.log("pages")
    of_text = 1 - F.col("logs") / F.col("values") / base
    of_styles = (F.log("total") - F.col("weighted") / F.col("total")) / base
    nodes = places.where(F.col("kind") != PATH).withColumn("own", F.when(F.col("kind") == TEXT, of_text).otherwise(of_styles))
    # Share of a place in the importance of the place above: how often its style is used there, among all children in it.
    used = counts.where((F.col("kind") == ELEMENT) & (F.col("value") != 0)).select("_host", F.col("place").alias("above"), F.col("value").alias("style"), F.col("k").alias("used"))
    totals = places.where(F.col("kind") == ELEMENT).select("_host", F.col("place").alias("above"), F.col("total").alias("all_used"))
    nodes = nodes.join(used, ["_host", "above", "style"], "left").join(totals, ["_host", "above"], "left")
    nodes = nodes.withColumn("weight", F.coalesce(F.col("used") / F.col("all_used") / F.col("width"), F.lit(1.0)))
    nodes = written(nodes.select("_host", "kind", "place", "above", "depth", "own", "values", "weight"), "nodes")
    composed = nodes.limit(0).select("_host", "place", "above", F.col("own").alias("importance"), "weight")
    levels, below = composed, composed
    for depth in range(nodes.agg(F.max("depth")).first()[0] or 0, -1, -1):
        lost = below.groupBy("_host", F.col("above").alias("place")).agg(F.sum(F.col("weight") * (1 - F.col("importance"))).alias("lost"))
        children = F.pow(F.lit(CHILDREN), F.col("values"))
        inner = (1 - children) * F.col("own") + children * (1 - F.coalesce("lost", F.lit(0.0)))
        level = nodes.where(F.col("depth") == depth).join(lost, ["_host", "place"], "left")
        level = level.select("_host", "place", "above", F.when(F.col("kind") == TEXT, F.col("own")).otherwise(inner).alias("importance"), "weight")
        below = written(level, "importance")
        levels = levels.unionByName(below)
    low = levels.select("_host", "place", "above", (F.col("importance") < LOW_IMPORTANCE).alias("low"))
    parents = low.where("low").select("_host", F.col("place").alias("above"))
    stops = low.where("not low").join(parents, ["_host", "above"], "left_semi")
    paths = places.where(F.col("kind") == PATH).select("_host", "place", "pages")
    often = counts.where((F.col("kind") == PATH) & (F.col("value") != 0) & (F.col("k") > 1)).join(paths, ["_host", "place"])
    often = often.where((2 * F.col("k") >= F.col("pages")) & (1 - F.log("k") / F.log("pages") < LOW_IMPORTANCE))
    # The top place stands for the host: all pages with text have it.
    rows = low.select("_host", F.when(F.col("low"), F.col("place")).alias("low"), F.lit(None).cast("long").alias("stops"), F.lit(None).cast("long").alias("contents"))
    rows = rows.unionByName(stops.select("_host", F.col("place").alias("stops")), allowMissingColumns=True)
    rows = rows.unionByName(often.select("_host", F.col("place").bitwiseXOR(F.col("value")).alias("contents")), allowMissingColumns=True)
    return rows.groupBy("_host").agg(*[F.collect_set(c).alias(c) for c in ("low", "stops", "contents")])


class SiteTree:
    """What the merged tree of a host says about a block."""

    def __init__(self, low: Iterable[int], stops: Iterable[int], contents: Iterable[int]):
        self.low, self.stops, self.contents = set(low), set(stops), set(contents)

    def is_low(self, block: _Block) -> bool:
        if self.contents and block.place.path ^ _content(block.text) in self.contents:
            return True
        place = block.place
        while place is not None:
            if place.key in self.low:
                return True
            if place.key in self.stops:
                return False
            place = place.above
        return False


def main_text(page: str, tree: SiteTree | None = None) -> str:
    """Text of a page without noise and low branches, blocks joined by an empty line."""
    blocks = blocks_of(page)
    left = [b for b in blocks if b.noise != CERTAIN]
    if tree:
        style_tree(blocks)
        left = [b for b in left if not tree.is_low(b)]
    elif any(b.main for b in left):
        left = [b for b in left if b.main]
    clean = sum(len(b.text) for b in left if not b.noise)
    hinted = sum(len(b.text) for b in left if b.noise)
    return "\n\n".join(b.text for b in left if not b.noise or clean < REST * hinted)


def extract_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without html, with ``text`` and ``n_chars``."""
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")
    hosted = pages.select(*keep, F.col(html).alias("_html"), _host(url).alias("_host"))
    trees = written(site_trees(hosted, "_html"), "site-trees")
    parts = ("low", "stops", "contents")
    at = [f"_tree_{p}" for p in parts]
    trees = trees.select("_host", *[F.col(p).alias(c) for p, c in zip(parts, at, strict=True)])
    joined = hosted.join(F.broadcast(trees) if fits_trees(trees, at) else trees, "_host", "left").select(*keep, "_html", *at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [batch.column(len(keep) + k).to_pylist() for k in range(4)]
            texts = [main_text(page or "", None if low is None else SiteTree(low, *more)) for page, low, *more in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    return joined.mapInArrow(run, schema)


def fits_trees(trees: DataFrame, parts: list[str]) -> bool:
    """Measured with each tree as one text, since arrays have no width of their own."""
    return fits_broadcast(trees.select("_host", F.concat_ws(" ", *[F.col(c).cast("array<string>") for c in parts]).alias("tree")))


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS h FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(h, '</?(p|h1)>', chr(1), 'g'), '<br>', ' ', 'g') AS h FROM a),
c AS (SELECT page_id, url, replace(replace(replace(replace(replace(regexp_replace(h, '<[^>]*>', '', 'g'),
  '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS h FROM b),
d AS (SELECT page_id, string_split(h, chr(1)) AS parts FROM c),
e AS (SELECT page_id, unnest(parts) AS x, generate_subscripts(parts, 1) AS i FROM d),
f AS (SELECT page_id, i, trim(regexp_replace(x, '\s+', ' ', 'g')) AS x FROM e),
g AS (SELECT page_id, string_agg(x, chr(10) || chr(10) ORDER BY i) AS text FROM f WHERE x <> '' GROUP BY page_id)
SELECT p.page_id, p.url, coalesce(g.text, '') AS text, CAST(length(coalesce(g.text, '')) AS BIGINT) AS n_chars
FROM pages p LEFT JOIN g USING (page_id)
"""
