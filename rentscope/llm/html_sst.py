"""HTML extraction with a site style tree.

Pages of one host are merged into a tree of presentation paths (tag and class
of every element from the root down).  For each path two entropies are taken
over the host's pages:

* presentation: how much the sequences of children differ;
* content: how much the texts and links below it differ (a text that is on
  every page has the highest entropy, so it carries no importance).

A branch's importance mixes both; branches of low importance are removed from
each page.  Menus, adverts and footers may differ on every page, so the tree
also weighs its branches: where one box holds most of the text that its parent
holds over the host's pages, the boxes beside it that hold little of it are
removed, whatever their names.  A prior stands beside the tree: elements whose tag, class or role names them as page
furniture have no importance, and an article or main element has full
importance whatever its name (only its inner boxes can still lose theirs).
Where a page has an article or main element, its text comes from there; an
article inside an article is a reader's, and short articles beside a long one
are teasers.  A named element that holds most of its pages' text, with high
importance, is no furniture: the tree lifts its name's verdict.  So does the page
itself for a form or a named element round all its articles, or round most of
their text, or of all its text where it has none (unless the name is one of
readers' comments).

Everything a host contributes is counted by (host, path, content) before it
meets, so a host with a third of all pages is no hot group; what comes back to
the pages is the host's list of removed paths.

Defined cases: null or empty html gives an empty text; html without a tag is
text; unclosed and unmatched tags are closed as browsers do; a page without an
address belongs to the nameless host; repeated rows keep a row each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_arrow

CONTENT_WEIGHT = 0.9   # weight of content against presentation importance
MIN_IMPORTANCE = 0.2   # branches below are removed
INNER_IMPORTANCE = 0.05  # ... inside an article
LIFT_IMPORTANCE = 0.5  # a named branch is content from this importance on
LIFT_SHARE = 0.5         # ... and this share of its pages' text
LIFT_CHARS = 200       # characters that a form or a named branch must hold for its own page to lift it
ARTICLE_REST = 0.5     # share of an article's text that removed boxes must leave
TEASER_SHARE = 0.2     # an article of less than this share of the page's longest is a teaser
MAJOR_SHARE = 0.5      # share of its parent's text that makes a box the major one,
MINOR_SHARE = 0.1      # ... and share under which a box beside it is removed
MIN_PAGES = 4          # pages of a host that must show a path

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp object canvas".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
                   "main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead "
                   "tr ul".split())
NOISE_TAGS = frozenset("nav aside footer button select menu dialog head input label fieldset legend".split()) | RAW
BOXES = frozenset("div section nav aside header footer form ul ol dl table center figure details dialog menu article main".split())
# an open element of the first kind ends when an element of the second kind starts
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
        "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
        "option": {"option", "optgroup"}}
ENDS_P = BLOCKS - {"br", "body", "html", "head", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot",
                   "caption", "legend"}
# closing and implied ends do not reach beyond these
FENCES = frozenset("table ul ol dl body html article section div main td th".split())
# Words in class, id or role that name page furniture.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner banners sponsor sponsored sponsors promo "
    "promos promotion menu menus nav navbar navigation breadcrumb breadcrumbs topbar toolbar masthead header footer "
    "sidebar sidebars side aside rail widget widgets cookie cookies consent gdpr notice notices notification "
    "notifications alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments commentlist discussion disqus respond reply replies "
    "pagination pager copyright complementary contentinfo search tagcloud hidden thread threads reaction reactions "
    "response responses feedback".split())
# ... of which these are the readers'
READER_WORDS = frozenset("comment comments commentlist discussion disqus respond reply replies thread threads reaction reactions "
                         "response responses feedback".split())
# ... also inside longer names
NOISE_STEMS = re.compile("cookie|advert|adsby|sidebar|navbar|newsletter|breadcrumb|sponsor|popup|disqus|comments|footer")
# a header inside an article is the article's own
HEADER_WORDS = frozenset(("header", "masthead"))
CONTENT_WORDS = frozenset(("main", "article"))
# names that begin so tell a state ("has-sidebar"); parts that may follow a name ("menu-item")
STATE_WORDS = frozenset("has with without no not is show hide js".split())
BOX_WORDS = frozenset("area bar block box button container content group holder inner item items link links list outer "
                      "panel row section slot text title unit wrap wrapper".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
                  r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|href)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")
# numbers of one page in class names: behind a word for a page or an entry, or of three digits and more
_CLASS_NUMBERS = re.compile(r"(?<![a-z])((?:post|page|entry|node|item|article|story|product|topic|thread|comment|user|author"
                            r"|category|tag|term|parent|menu-item)(?:-?id)?[-_]?)\d+|\d{3,}", re.I)


def _names_furniture(name: str, inside: bool) -> bool:
    """Whether one class, id or role, taken whole or by its last part, names page furniture."""
    parts = [w for w in _SPLIT.split(name) if w]
    if not parts or parts[0] in STATE_WORDS:
        return False
    while len(parts) > 1 and parts[-1] in BOX_WORDS:
        parts.pop()
    if parts[-1] in NOISE_WORDS and not (inside and parts[-1] in HEADER_WORDS):
        return True
    return any(NOISE_STEMS.search(w) for w in parts)


class _Frame:
    """``barred``: furniture by its tag; ``named``: path of the outermost furniture by name (or a form), else
    None; ``readers``: whether that is a name of comments; ``article``: number of the outermost article or main
    element, ``nested``: in an article within it."""
    __slots__ = ("tag", "path", "barred", "named", "readers", "inside", "children", "above", "gone", "article", "nested", "within", "parent")

    def __init__(self, tag, path, barred, named, readers, inside, above, gone, article, nested, within):
        self.tag, self.path, self.barred, self.named, self.readers = tag, path, barred, named, readers
        self.inside, self.above, self.gone, self.article, self.nested, self.within = inside, above, gone, article, nested, within
        self.children: list[str] = []
        self.parent: _Frame | None = None

    @property
    def noise(self) -> bool:
        return self.barred or self.named is not None or self.nested


def _element(tag: str, attrs: str, parent: _Frame, removed, lifted, counter) -> tuple[_Frame, str, str]:
    """Frame of a new element, its key among its siblings, its link."""
    from xxhash import xxh64_intdigest
    named, names, link = "", set(), ""
    if "=" in attrs:
        found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
        link = found.pop("href", "")
        if "id" in found:  # numbered ids are one path
            found["id"] = _DIGITS.sub("0", found["id"])
        if "class" in found:  # so are classes with a number of the page; layout digits (col-6) stay apart
            found["class"] = _CLASS_NUMBERS.sub(r"\g<1>0", found["class"])
        named = " ".join(f"{k}={v}" for k, v in sorted(found.items())).lower()
        names = {w for v in found.values() for w in v.lower().split()}
    key = f"{tag} {named}" if named else tag
    path = xxh64_intdigest(key, parent.path & 0xFFFFFFFFFFFFFFFF)
    path -= (path >> 63) << 64
    barred = parent.barred or tag in NOISE_TAGS or (tag == "header" and not parent.inside)
    content = tag in CONTENT_WORDS or "role=main" in named
    root = parent.named
    readers = parent.readers
    if root is None and not content and tag not in ("html", "body") and path not in lifted \
            and (tag == "form" or any(_names_furniture(w, parent.inside) for w in names)):
        root = path
        readers = any(p in READER_WORDS for w in names for p in _SPLIT.split(w))
    inside = parent.inside or (content and not barred and root is None)
    # the outermost article; a second one within an article is a reader's
    article = parent.article if parent.article is not None or not content else counter()
    nested = parent.nested or (tag == "article" and parent.within)
    gone = parent.gone or path in removed
    # a named branch counts for itself, not for what stands around it
    above = () if root == path and parent.named is None else (*parent.above, parent.path)
    return _Frame(tag, path, barred, root, readers, inside, above, gone, article, nested, parent.within or tag == "article"), key, link


def walk(html: str, removed=frozenset(), lifted=frozenset()) \
        -> tuple[list[tuple[str, _Frame | None]], list[_Frame], list[tuple[_Frame, str]]]:
    """The page as (text, element) runs with (" ", None) at block ends, its
    elements, and its links.  Raw and head elements hold no text."""
    root = _Frame("", 0, False, None, False, False, (), False, None, False, False)
    counter = count().__next__
    stack, runs, frames, links = [root], [], [root], []
    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        text = html[at:m.start() if m else n]
        if text:
            runs.append((text, stack[-1]))
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            runs.append((" ", None))
        if m[1] or m[4]:  # closing tag
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in FENCES and tag not in FENCES:
                    break
            continue
        if tag in ENDS_P:
            _end(stack, {"p"})
        for open_tag, enders in ENDS.items():
            if tag in enders:
                _end(stack, {open_tag})
        frame, key, link = _element(tag, m[3] or m[6] or "", stack[-1], removed, lifted, counter)
        frame.parent = stack[-1]
        siblings = stack[-1].children
        if not siblings or siblings[-1] != key:
            siblings.append(key)
        frames.append(frame)
        if link:
            links.append((frame, link))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID:
            stack.append(frame)
    return runs, frames, links


def _end(stack: list[_Frame], tags: set[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in FENCES:
            return


def _joined(runs: list[tuple[str, _Frame | None]], wanted) -> str:
    parts = [t if f is None else unescape(t) for t, f in runs if f is None or wanted(f)]
    return " ".join("".join(parts).split())


def _own_lifts(runs: list[tuple[str, _Frame | None]], frames: list[_Frame]) -> frozenset:
    """Paths of forms and named elements that hold all articles of the page, or most of the text
    of its articles, or of all its text where it has none."""
    roots = {f.named for f in frames if f.named is not None and not f.readers and not f.barred}
    if not roots:
        return frozenset()
    articles = [f for f in frames if f.tag in CONTENT_WORDS and not f.barred]
    held = {f.named for f in articles}
    if len(held) == 1 and held & roots:
        return frozenset(held)
    chars: dict[int | None, int] = {}
    for t, f in runs:
        if f is not None and not f.barred and not t.isspace() and (not articles or f.article is not None):
            chars[f.named] = chars.get(f.named, 0) + len(t)
    whole = sum(chars.values())
    return frozenset(r for r in roots if chars.get(r, 0) >= max(LIFT_SHARE * whole, LIFT_CHARS))


def _teasers(runs: list[tuple[str, _Frame | None]]) -> set[int]:
    """Numbers of the articles that are short beside the page's longest one."""
    chars: dict[int, int] = {}
    for t, f in runs:
        if f is not None and f.article is not None and not f.noise:
            chars[f.article] = chars.get(f.article, 0) + len(t.strip())
    longest = max(chars.values(), default=0)
    return {k for k, n in chars.items() if n < TEASER_SHARE * longest}


def extract(html: str | None, removed=frozenset(), lifted=frozenset()) -> str:
    """Main text of a page, given the removed paths of its host and the named ones that are content."""
    if not html:
        return ""
    runs, frames, _ = walk(html, removed, lifted)
    own_lifts = _own_lifts(runs, frames)
    if own_lifts:
        runs, frames, _ = walk(html, removed, lifted | own_lifts)
    if any(f.inside for f in frames):
        short = _teasers(runs)
        own = _joined(runs, lambda f: f.inside and not f.noise and f.article not in short)
        left = _joined(runs, lambda f: f.inside and not f.noise and f.article not in short and not f.gone)
        # copies of an article repeat its text as furniture would: what leaves little of it is not applied
        return left if len(left) >= ARTICLE_REST * len(own) else own
    text = _joined(runs, lambda f: not f.noise and not f.gone)
    # a site whose pages are all alike has no important branch: the prior alone decides
    return text or _joined(runs, lambda f: not f.noise)


# ------------------------------------------------------------------ the tree

def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")),
                                    "^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def page_facts(pages: DataFrame) -> DataFrame:
    """What each page adds to its host's tree: (host, path, kind, fact, above, inner, guard, share).

    kind 0: a child sequence of the path; kind 1: a text or link of it; kind 2:
    the path's parent (the fact) and the characters it holds (the share), of every
    box and of what stands around boxes, furniture by tag or name not left out;
    ``guard`` is true of paths inside an article there.  Each fact counts once per page.  ``guard`` marks article paths and those around
    them, ``inner`` boxes inside an article that may still be judged, ``share``
    is the part of the page's text that a branch named as furniture holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        def digest(x: str) -> int:
            h = xxh64_intdigest(x, 7)
            return h - ((h >> 63) << 64)

        for b in batches:
            host, path, kind, fact, above, inner, guard, share = [], [], [], [], [], [], [], []
            for h, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not html:
                    continue
                runs, frames, links = walk(html)
                around = {p for f in frames if f.inside for p in f.above}
                texts: dict[tuple[int, int], None] = {}
                chars: dict[int | None, int] = {}
                for t, f in runs:
                    if f is not None and not f.barred and not t.isspace():
                        words = " ".join(t.split())
                        texts[f.path, digest(words)] = None
                        chars[f.named] = chars.get(f.named, 0) + len(words)
                for f, link in links:
                    if not f.barred:
                        texts[f.path, digest(link)] = None
                whole = sum(chars.values())
                shapes = {(f.path, digest(" ".join(f.children))): f for f in frames if not f.barred}
                for (p, d), f in shapes.items():
                    # a path of several shapes on the page counts its share once
                    held = chars.pop(p, 0) if f.named == p else 0
                    share.append(held / whole if held else 0.0)
                    host.append(h), path.append(p), kind.append(0), fact.append(d), above.append(f.above)
                    box = f.tag in ("div", "section", "ul", "ol", "table", "dl")
                    inner.append(f.inside and box)
                    guard.append(p in around or (f.inside and not box) or f.tag in ("", "html", "body", "article", "main"))
                for p, d in texts:
                    host.append(h), path.append(p), kind.append(1), fact.append(d), above.append(())
                    inner.append(False), guard.append(False), share.append(0.0)
                weight: dict[int, int] = {}
                for t, f in runs:
                    if f is not None and not t.isspace():
                        weight[id(f)] = weight.get(id(f), 0) + len(" ".join(t.split()))
                held_by: dict[tuple[int, int], list] = {}
                for f in reversed(frames):
                    n = weight.get(id(f), 0)
                    if f.parent is not None:
                        weight[id(f.parent)] = weight.get(id(f.parent), 0) + n
                        if f.tag in BOXES or f.tag in ("html", "body"):
                            seen = held_by.setdefault((f.path, f.parent.path), [0, f.tag in BOXES, f.parent.inside])
                            seen[0] += n
                for (p, up), (n, box, within) in held_by.items():
                    host.append(h), path.append(p), kind.append(2), fact.append(up), above.append(())
                    inner.append(box), guard.append(within), share.append(float(n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(path, pa.int64()), pa.array(kind, pa.int8()),
                 pa.array(fact, pa.int64()), pa.array(above, pa.list_(pa.int64())), pa.array(inner, pa.bool_()),
                 pa.array(guard, pa.bool_()), pa.array(share, pa.float64())],
                names=["host", "path", "kind", "fact", "above", "inner", "guard", "share"])

    return map_arrow(pages.select("host", "html"), run,
                     "host string, path bigint, kind tinyint, fact bigint, above array<bigint>, inner boolean, "
                     "guard boolean, share double")


def counted_facts(facts: DataFrame) -> DataFrame:
    """Facts counted by (host, path, kind, fact), written once: the tree is read several times."""
    return materialize(facts.groupBy("host", "path", "kind", "fact").agg(
        F.count("*").alias("c"), F.first("above").alias("above"), F.max("inner").alias("inner"),
        F.max("guard").alias("guard"), F.sum("share").alias("share")), "style-facts")


def minor_branches(counted: DataFrame) -> DataFrame:
    """(host, path): boxes of little text beside a major one, outside of articles,
    on hosts of ``MIN_PAGES`` pages or more.

    A box's part is its text over that of its parent's boxes and other content, summed over the host's pages."""
    boxes = counted.where("kind = 2").select("host", "path", F.col("fact").alias("up"), F.col("share").alias("chars"), "inner", "guard",
                                             F.col("c").alias("pages"))
    around = boxes.groupBy("host", "path").agg(F.sum("chars").alias("whole")).withColumnRenamed("path", "up")
    part = boxes.join(around, ["host", "up"]).where("whole > 0 and pages >= " + str(MIN_PAGES)) \
        .withColumn("part", F.col("chars") / F.col("whole"))
    major = part.where(F.col("inner") & ~F.col("guard") & (F.col("part") >= MAJOR_SHARE)).select("host", "up").distinct()
    return part.where(F.col("inner") & ~F.col("guard") & (F.col("part") < MINOR_SHARE)).join(major, ["host", "up"], "left_semi") \
        .select("host", "path").distinct()


def importance(counted: DataFrame) -> DataFrame:
    """(host, path, pages, importance, inner, guard, share) of the hosts' tree paths.

    Presentation importance is the entropy of the child sequences over the m
    pages, to base m.  A text found on c of m pages has entropy log_m(c); the
    content importance of a branch is one minus the mean over all texts at or
    below it."""
    shape, text = F.col("kind") == 0, F.col("kind") == 1
    paths = counted.where("kind < 2").groupBy("host", "path").agg(
        F.sum(F.when(shape, F.col("c"))).alias("m"),
        F.sum(F.when(shape, F.col("c") * F.log("c"))).alias("clogc"),
        F.count(F.when(text, 1)).alias("texts"),
        F.coalesce(F.sum(F.when(text, F.log("c"))), F.lit(0.0)).alias("textlog"),
        F.first(F.when(shape, F.col("above")), ignorenulls=True).alias("above"),
        F.max("inner").alias("inner"), F.max("guard").alias("guard"), F.sum("share").alias("share")) \
        .where("m is not null")
    log_m = F.log("m")
    base = paths.select(
        "host", "path", "m", "inner", "guard", "above", "texts", (F.col("share") / F.col("m")).alias("share"),
        F.when(F.col("m") > 1, F.greatest(F.lit(0.0), (log_m - F.col("clogc") / F.col("m")) / log_m))
        .otherwise(F.lit(1.0)).alias("shape_importance"),
        # a text may stand twice on a page's path, but counts once per page, so c <= m
        F.when(F.col("m") > 1, F.col("texts") - F.col("textlog") / log_m).otherwise(F.col("texts").cast("double"))
        .alias("text_importance"))
    below = base.where("texts > 0") \
        .select("host", F.explode(F.concat("above", F.array("path"))).alias("path"), "texts", "text_importance") \
        .groupBy("host", "path").agg(F.sum("texts").alias("n"), F.sum("text_importance").alias("s"))
    return base.join(below, ["host", "path"], "left").select(
        "host", "path", F.col("m").alias("pages"), "inner", "guard", "share",
        F.when(F.col("n") > 0, CONTENT_WEIGHT * F.col("s") / F.col("n")
               + (1 - CONTENT_WEIGHT) * F.col("shape_importance")).otherwise(F.lit(1.0)).alias("importance"))


def removed_paths(tree: DataFrame, minor: DataFrame) -> DataFrame:
    """(host, removed, lifted): the paths of low importance and the minor ones, and the named ones that are
    content, of each host that has any."""
    low = F.when(F.col("inner"), F.col("importance") < INNER_IMPORTANCE) \
        .otherwise((F.col("importance") < MIN_IMPORTANCE) & ~F.col("guard"))
    low = (F.col("pages") >= MIN_PAGES) & low
    lift = (F.col("share") >= LIFT_SHARE) & (F.col("importance") >= LIFT_IMPORTANCE)
    judged = tree.select("host", F.when(low, F.col("path")).alias("low"), F.when(lift, F.col("path")).alias("lift")) \
        .where("low is not null or lift is not null") \
        .unionByName(minor.select("host", F.col("path").alias("low")), allowMissingColumns=True)
    return judged.groupBy("host").agg(F.sort_array(F.collect_set("low")).alias("removed"),
                                      F.sort_array(F.collect_set("lift")).alias("lifted"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id_col, url, text, n_chars), a row per page."""
    src = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url}`").cast("string").alias("url"),
                       F.col(f"`{html}`").cast("string").alias("html"), host_of(F.col(f"`{url}`")).alias("host"))
    # the table of removed paths is written first, so that its size is known when the join is planned
    counted = counted_facts(page_facts(src))
    removed = materialize(removed_paths(importance(counted), minor_branches(counted)), "style-tree")
    joined = src.join(removed, "host", "left").select("id", "url", "html", "removed", "lifted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h, frozenset(r or ()), frozenset(k or ()))
                     for h, r, k in zip(*(b.column(c).to_pylist() for c in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             names=["id", "url", "text"])

    out = map_arrow(joined, run, "id bigint, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url), "text",
                      F.length("text").cast("bigint").alias("n_chars"))
