"""Main-text extraction with site style trees.

The DOMs of a host's pages are merged: elements with one path (tags and
classes from the root) are one node of the host's tree.  A node that carries
text has a *presentation* (its children's tags) and *content*, and their
entropies over the host's pages tell how much the node varies.  A node's
importance is

* 0 for presentation that marks furniture (menus, headers, footers, sidebars,
  adverts, forms, scripts, reader comments, hidden elements) by tag, role, an
  exact name or a name composed of furniture words and words for parts of a
  page (``comment-list``, ``cookie-notice``), and for anything outside the
  article on a page that has one.  An article that a form wraps is an article;
* 1 for other nodes inside an article: copies of an article stay articles,
  however often a site repeats them;
* otherwise the mean of the content and presentation entropies, weighted 9 to
  1 and divided by the logarithm of the number of pages (1 on a single page).
  A furniture word within a longer name, or one that sections are named after
  too, only lowers it, inside articles as well: unique text stays.

Pages are counted once for each distinct text outside furniture, so copies of
a page are one page.  In nodes whose importance is below a threshold, the
blocks go whose own text is on so many distinct pages of the host (more than
their square root at the threshold of 0.5); others in the same place stay.
"""

from __future__ import annotations

import html as entities
import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.stage import cut
from .names import free_names

# Elements and names of page furniture, HTML element classes.
FURNITURE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "title"}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}
FURNITURE_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "discussion footer masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo related "
    "recommended share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
# Of these, words that sections and headings are named after as well; inside articles they count as the only class of a container.
PROSE_NAMES = set(
    "advertising banner comment consent cookie cookies discussion menu navigation newsletter notice notices promo related "
    "recommended share sharing skip social subscribe widget".split()
)
WHOLE_NAMES = FURNITURE_NAMES - PROSE_NAMES
# Words for parts of a page: with a furniture word they make a name like `share-buttons`.
PART_NAMES = set(
    "accept area author avatar bar block body bottom box button buttons close container content dismiss footer form group header icon "
    "icons inner item items label left link links list meta overlay page panel post prompt reader replies reply respond right "
    "section signup site strip text thread title toggle tool tools top user wrap wrapper".split()
)
COMMENT = "comment"
# Elements that such names mark as furniture inside articles too.
CONTAINERS = {"div", "section", "article", "ul", "ol", "dl", "li", "p"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Factor on the importance of a node that a name speaks against: unique text stays above the threshold.
NAMED = 0.6
HEADER = "header"
MAIN = {"article", "main"}
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "object", "math"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var".split()
)
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
# An open element that an implied end tag does not cross.
SCOPE = {"ul", "ol", "dl", "table", "article", "main", "section", "div", "body", "td", "th", "blockquote"}

REST = r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|[^<]+|<"
TOKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)|" + REST, re.DOTALL)
# Behind the last ">" of a page no tag ends.
TAIL = re.compile("()()" + REST, re.DOTALL)
# In a tag: its end, or the quote that opens a value.
STOP = re.compile(r">|=\s*+[\"']")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
TELLING = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
WORD = re.compile(r"[a-z0-9]+")
UNSEEN = re.compile(r"display\s*+:\s*+none", re.IGNORECASE)
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)")
BREAKS = re.compile(r"[\x20\x09-\x0D\xa0]+")


class Node:
    """A place in the style tree; ``prior`` is 0 (furniture), 1 (article) or None; ``named``: a name speaks against it.

    ``form``: it is furniture by a form alone.  ``path`` is a digest, so deep
    pages take no more memory than flat ones; ``room`` and ``looks`` keep nodes
    and judged elements within bounds.
    """

    __slots__ = ("path", "prior", "main", "named", "form", "tag", "kids", "room", "looks")

    def __init__(self, path, prior, main, named, form, tag, room, looks):
        self.path, self.prior, self.main, self.named, self.form, self.tag = path, prior, main, named, form, tag
        self.kids, self.room, self.looks = None, room, looks

    def child(self, tag: str, attributes: str) -> Node:
        names, found = "", {}
        if attributes and TELLING.search(attributes):
            for m in ATTRIBUTE.finditer(attributes):
                found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
            unseen = found.get("hidden", "until-found") != "until-found" or UNSEEN.search(found.get("style", "")) is not None
            found = {k: found[k] for k in ("class", "id", "role") if k in found} | ({"unseen": ""} if unseen else {})
            names = "|".join(f"{k}={found[k]}" for k in sorted(found))
        kid = self.kids.get((tag, names)) if self.kids else None
        if kid is None:
            look = self.looks.get((tag, names))
            if look is None:
                look = judged(tag, found.get("class", ""), found.get("id", ""), found.get("role", ""), "unseen" in found)
                if len(self.looks) < KEPT_LOOKS and len(names) < 200:
                    self.looks[tag, names] = look
            form, always, outside, named, named_outside = look
            furniture = always or (outside and not self.main)
            # An article that a form wraps.
            lifted = self.form and tag in MAIN and not furniture and not form
            named = (self.named and not lifted) or named or (named_outside and not self.main)
            main = self.main or (tag in MAIN and not furniture and not form)
            under = self.prior == 0 and not lifted
            prior = 0 if under or furniture or form else 1 if main and not named else None
            only_form = not furniture and not lifted and (self.form or (form and self.prior != 0))
            path = blake2b(f"{self.path}/{tag}[{names}]".encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
            kid = Node(path, prior, main, named, only_form, tag, self.room, self.looks)
            if self.room[0] > 0:
                self.room[0] -= 1
                self.kids = self.kids or {}
                self.kids[tag, names] = kid
        return kid


def judged(tag: str, of_class: str, of_id: str, of_role: str, unseen: bool) -> tuple[bool, bool, bool, bool, bool]:
    """Of an element: a form; furniture, anywhere and outside articles; named for furniture, anywhere and outside articles."""
    classes, own_id = set(of_class.split()), of_id.strip()
    # Ids of headings are made of their text, so they tell nothing outright.
    whole = classes if tag in HEADINGS else classes | {own_id}
    words = set(WORD.findall(" ".join([*classes, own_id])))
    # Ids of sections are made of their headings as well.
    parts = [set(WORD.findall(x)) for x in (classes if tag == "section" or "section" in classes else whole)]
    role = re.match(r"\s*([a-z]+)", of_role)
    role = role[1] if role else ""
    page = tag in ("html", "body", "main")
    composed = any(
        len(x) > 1
        and bool(x & FURNITURE_NAMES - {"discussion"})
        and all(w in FURNITURE_NAMES or w in PART_NAMES or (w.isdigit() and COMMENT in x) for w in x)
        for x in parts
    )
    exact = bool(classes & FURNITURE_NAMES - {"discussion"}) if tag not in MAIN else COMMENT in classes
    always = (
        (tag in FURNITURE_TAGS and tag != "form")
        or (role in FURNITURE_ROLES and role != "form")
        or (not page and (unseen or bool(whole & WHOLE_NAMES)))
        or (tag in CONTAINERS and (composed or COMMENT in classes or (len(classes) == 1 and exact)))
    )
    outside = (not page and tag not in HEADINGS and exact) or tag == HEADER or HEADER in whole
    return tag == "form" or role == "form", always, outside, not page and bool(words & FURNITURE_NAMES), HEADER in words


class Open:
    """The open elements of a page; where each tag is open, so that no end tag walks the stack."""

    def __init__(self, root: Node):
        self.nodes, self.at = [root], {}

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def place(self, names: set, scope: bool) -> int:
        """Index of the innermost open element of these names; 0 if none, or none within the innermost scope."""
        at = max((self.at[t][-1] for t in names if self.at.get(t)), default=0)
        if at and scope and any(self.at[t][-1] > at for t in SCOPE - names if self.at.get(t)):
            return 0
        return at

    def cut(self, at: int) -> None:
        for node in self.nodes[at:]:
            self.at[node.tag].pop()
        del self.nodes[at:]


def tag_end(page: str, at: int) -> int:
    """Index of the ``>`` that ends a tag, outside quoted values; -1 where a quote is never closed."""
    while (m := STOP.search(page, at)) is not None:
        if m[0] == ">":
            return m.start()
        at = page.find(m[0][-1], m.end()) + 1
        if at == 0:
            return -1
    return -1


# Nodes and judged elements that a task keeps of its pages, to save time only.
KEPT_NODES = 200_000
KEPT_LOOKS = 10_000


def blocks(page: str, root: Node):
    """Text blocks of a page in order, ``(node, text, glued)``, and the children's tags of each node by path.

    A block is ``glued`` when an inline element's edge alone, without white space, parts it from the one before.
    """
    opened, piece, out, styles = Open(root), [], [], {}
    stack = opened.nodes
    at, n, tight, quoted = 0, len(page), False, True
    last = page.rfind(">")

    def close(inline=False):
        nonlocal tight
        spaced = BREAKS.sub(" ", entities.unescape("".join(piece)))
        piece.clear()
        text = spaced.strip(" ")
        if text:
            out.append((stack[-1], text, tight and spaced[0] != " "))
        tight = inline and (spaced[-1] != " " if text else tight and not spaced)

    def pop(names, scope):
        i = opened.place(names, scope)
        if i:
            close(all(x.tag in INLINE for x in stack[i:]))
            opened.cut(i)

    while at < n:
        m = (TOKEN if at < last else TAIL).match(page, at)
        at = m.end()
        tag = m[2]
        if not tag:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                piece.append(m[0])
            continue
        tag = tag.lower()
        end = tag_end(page, at) if quoted else -1
        if end < 0:
            # A quote is never closed: tags end at the next ">" from here on.
            quoted, end = False, page.index(">", at)
        attributes, at = page[at:end], end + 1
        if m[1]:
            if tag == "br":
                piece.append(" ")
            else:
                pop({tag}, False)
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE).search(page, at)
                at = end.end() if end else n
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                piece.append(" ")
            continue
        if tag in CLOSES:
            pop(CLOSES[tag], True)
        kid = stack[-1].child(tag, attributes)
        # A named inline element is judged apart where the text around it is sure to stay.
        apart = (kid.prior == 0) != (stack[-1].prior == 0) or (kid.prior is None and stack[-1].prior == 1)
        if tag in INLINE and not apart:
            continue
        close(tag in INLINE)
        styles.setdefault(stack[-1].path, []).append(tag)
        if not attributes.endswith("/"):
            opened.push(kid)
    close()
    return out, styles


def new_root() -> Node:
    return Node("", None, False, False, False, "", [KEPT_NODES], {})


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def _key(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _read(page: str | None, root: Node):
    """Blocks with the prior they have on this page, and styles."""
    if root.room[0] <= 0:
        root.kids, root.room[0] = None, KEPT_NODES
    found, styles = blocks(page or "", root)
    has_main = any(node.main and node.prior != 0 for node, _, _ in found)
    # Outside the article of a page that has one, and bare pages, are different nodes.
    return [
        (node, f"{int(has_main)}{node.path}", 0 if has_main and not node.main else node.prior, text, glued) for node, text, glued in found
    ], styles


def _joined(found: list, low: frozenset | set, host: str) -> str:
    """The text of the blocks that stay."""
    out, before = [], False
    for _, path, prior, text, glued in found:
        stays = prior == 1 or prior is None and _key(host, path, text) not in low
        if stays:
            out += [text] if not out or glued and before else [" ", text]
        before = stays
    return "".join(out)


def style_nodes(pages: DataFrame) -> DataFrame:
    """``host, page, node, named, style, content, blocks`` of each undecided text-bearing node of each page (``url``, ``html``).

    ``page`` stands for the page's text outside furniture, so copies have one.
    A page without undecided nodes gives one row with a null ``node``.
    """

    def run(batches):
        root = new_root()
        for batch in batches:
            out = {c: [] for c in ("host", "page", "node", "named", "style", "content", "blocks")}
            for url, html in zip(batch["url"].to_pylist(), batch["html"].to_pylist(), strict=True):
                host = host_of(url)
                found, styles = _read(html, root)
                merged: dict[str, tuple[Node, list]] = {}
                for node, path, prior, text, _ in found:
                    if prior is None:
                        merged.setdefault(path, (node, []))[1].append(text)
                page = _key(*(x for _, path, prior, text, _ in found if prior != 0 for x in (path, text)))
                for path, (at, texts) in merged.items():
                    out["named"].append(at.named)
                    out["node"].append(_key(host, path))
                    out["style"].append(_key(*styles.get(at.path, [""])))
                    out["content"].append(_key(*texts))
                    out["blocks"].append([_key(host, path, text) for text in texts])
                if not merged:
                    for c in ("node", "named", "style", "content", "blocks"):
                        out[c].append(None)
                out["host"] += [_key(host)] * max(1, len(merged))
                out["page"] += [page] * max(1, len(merged))
            kinds = {"named": pa.bool_(), "blocks": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    return pages.select("url", "html").mapInArrow(
        run, "host long, page long, node long, named boolean, style long, content long, blocks array<long>"
    )


def importance(nodes: DataFrame, content_weight: float = 0.9) -> DataFrame:
    """``node, pages, importance`` of the merged tree over distinct pages, by partial aggregation."""
    once = nodes.where("node is not null").groupBy("host", "page", "node").agg(
        *[F.min(c).alias(c) for c in ("named", "style", "content")]
    )

    def entropy(of: str) -> DataFrame:
        m = F.sum("k")
        return once.groupBy("node", of).agg(F.count("*").alias("k"), F.min("named").alias("named")).groupBy("node").agg(
            m.alias("pages"),
            F.min("named").alias("named"),
            F.when(m > 1, 1 - F.sum(F.col("k") * F.log2("k")) / m / F.log2(m)).otherwise(1.0).alias(of),
        )

    both = entropy("content").join(entropy("style").select("node", "style"), "node")
    mean = content_weight * F.col("content") + (1 - content_weight) * F.col("style")
    return both.select("node", "pages", (F.when(F.col("named"), NAMED).otherwise(1.0) * mean).alias("importance"))


def repeated_blocks(nodes: DataFrame, threshold: float) -> DataFrame:
    """``block``: texts in nodes of low importance that themselves tell little, by the distinct pages of the host that hold them."""
    low = cut(importance(nodes).where(F.col("importance") < threshold).select("node"), "low-nodes")
    held = nodes.join(low, "node").select("host", "page", F.explode("blocks").alias("block")).distinct()
    counts = held.groupBy("host", "block").agg(F.count("*").alias("k")).where("k > 1")
    sizes = nodes.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    # The node's entropy is the mean of this over its pages when each of them has one block.
    return counts.join(sizes, "host").where(1 - F.log2("k") / F.log2("pages") < threshold).select("block")


def extract_text(
    pages: DataFrame,
    threshold: float = 0.5,
    broadcast_bytes: int = 32 << 20,
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Input rows with the html replaced by ``text``, the main text of the page.

    Character references are decoded, white space inside a block (ASCII or
    no-break) becomes one space, blocks are trimmed and joined by one space in
    page order.  Null html reads as empty and gives an empty text; a null url
    is a host of its own.  Repeated rows stay.  An input column ``text`` gives
    way to the result.  An empty table gives an empty result.
    """
    spark = pages.sparkSession
    kept = [c for c in pages.columns if c not in (html_col, "text")]
    url_at, html_at, row_at, key_at, low_at = free_names([*pages.columns, "text"], 5)
    rows = pages.select(*kept, F.col(url_col).alias(url_at), F.col(html_col).alias(html_at))
    nodes = cut(style_nodes(rows.select(F.col(url_at).alias("url"), F.col(html_at).alias("html"))), "style-nodes")
    low = cut(repeated_blocks(nodes, threshold), "low-blocks")
    schema = T.StructType([pages.schema[c] for c in kept]).add("text", "string")

    def cleaned(batch, low_of):
        root = new_root()
        text = []
        for i, (url, page) in enumerate(zip(batch[url_at].to_pylist(), batch[html_at].to_pylist(), strict=True)):
            host, low = host_of(url), low_of(i)
            text.append(_joined(_read(page, root)[0], low, host))
        return pa.RecordBatch.from_arrays([batch[c] for c in kept] + [pa.array(text, pa.string())], names=[*kept, "text"])

    # About 100 bytes for each block in a Python set.
    if low.count() * 100 <= broadcast_bytes:
        held = spark.sparkContext.broadcast(frozenset(r["block"] for r in low.collect()))

        def run(batches):
            for batch in batches:
                yield cleaned(batch, lambda i: held.value)

        return rows.mapInArrow(run, schema)

    # Beyond the bound each page gets the low blocks among its own.
    page_key = F.concat(*[F.sha2(F.coalesce(F.col(c), F.lit("")), 256) for c in (url_at, html_at)])
    keyed = rows.withColumn(row_at, page_key)

    def own(batches):
        root = new_root()
        for batch in batches:
            at, block = [], []
            for url, page, row in zip(*(batch[c].to_pylist() for c in (url_at, html_at, row_at)), strict=True):
                host = host_of(url)
                keys = {_key(host, path, t) for _, path, prior, t, _ in _read(page, root)[0] if prior is None}
                at += [row] * len(keys)
                block += list(keys)
            yield pa.RecordBatch.from_pydict({key_at: pa.array(at, pa.string()), "block": pa.array(block, pa.int64())})

    pairs = keyed.select(url_at, html_at, row_at).mapInArrow(own, f"{key_at} string, block long").distinct()
    per_page = cut(pairs.join(low, "block").groupBy(key_at).agg(F.collect_list("block").alias(low_at)), "low-of-pages")
    joined = keyed.join(per_page.hint("shuffle_hash"), F.col(row_at) == F.col(key_at), "left").drop(key_at, row_at)

    def run_joined(batches):
        for batch in batches:
            low = batch[low_at]
            yield cleaned(batch, lambda i, low=low: set(low[i].as_py() or ()))

    return joined.mapInArrow(run_joined, schema)
