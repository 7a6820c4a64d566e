"""Main text of HTML pages by site style trees.

Pages of one host are merged into a style tree: a node is the path of presentations (tag, role, class and id
words) from the root to a block. Over the pages that have a node, the entropy of its contents and its
share of link text are taken. A node's importance weighs its presentation against that entropy:
furniture by name (menus, footers, adverts, comments, ...) stays low, an article stays high, and what has no telling
name is kept if its content differs from page to page and dropped if it is the host's template.
Branches of low importance leave each page; the blocks that remain are its text.

The tree judges named nodes too. An article in an element that is furniture by its class or id only (a wrapper such
as ``content-sidebar-wrap``) is kept if it differs from page to page, has few links, and is longer than what else its
page has for an article; where no tree judges it, if it is most of its page's text. A block in an article that is
the same on ``MANY_PAGES`` or more different articles of a host is removed, unless most of a page's article would go.
A block in an article whose class or id holds a word of furniture that is an everyday word too, beside words that
are none (``legal-analysis``), is kept if it differs from page to page and has few links, or if no tree judges it.

The tree is made in one pass over all pages, counted with partial sums per (host, node, content), so one host
with a third of the pages is spread over all tasks. Only nodes of a page that deviate from what their
presentation says come back to it, by a key of host and html: a page's list is never longer than its own nodes.

A host's pages count once for each different content: pages that show the same blocks outside named furniture are
copies, whatever their scripts and adverts, and make nothing a template.

Defined cases: NULL html gives an empty text. A NULL or odd url has no host, and its page is judged by
presentation alone, as are nodes of fewer than ``MIN_PAGES`` pages. Unclosed, crossed and unknown tags are
allowed. Repeated rows are extracted alike, each by itself, and are one page of their host. No page is cut short. An empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import functions as F

from gaugewright.llm.common import map_batches, stage

MIN_PAGES = 5
PRESENTATION_WEIGHT = 0.7
LEAST_IMPORTANCE = 0.5
MANY_PAGES = 20      # different articles of a host before a block in them can be template
LEAST_ENTROPY = 0.1  # below it, it is
FURNITURE, WRAPPED, DOUBTED, UNKNOWN, CONTENT = 0.0, 0.4, 0.45, 0.5, 1.0

TREE_WEIGHTS = (WRAPPED, DOUBTED, UNKNOWN)  # what the tree judges, links included

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp plaintext".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split())
FURNITURE_TAGS = frozenset(
    "annotation aside button canvas datalist dialog footer label legend map menu noscript object option optgroup select "
    "svg template audio video nav header form".split())
# An article within these was left open, or wraps the whole page.
SOFT_TAGS = frozenset("nav header form".split())
# What a start tag closes, up to the nearest of the tags that hold it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
}
HOLDS_P = frozenset("table td th caption button object body html".split())
# Words in class names, ids and roles.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial adslot banner banners sponsor sponsored promo promotion "
    "promoted menu menus nav navbar navigation navigational breadcrumb breadcrumbs sidebar sidebars side aside complementary "
    "footer foot footnav contentinfo header masthead topbar toolbar cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay dialog newsletter subscribe subscription signup login signin register share sharing social "
    "comment comments commentlist discussion disqus reply replies respond related recommended recommendations "
    "widget widgets pagination pager paginator copyright legal disclaimer search searchbox form hidden skip tags tagcloud "
    "outbrain taboola".split())
# Words of furniture that are everyday words too, and words that only tell how something is laid out.
EVERYDAY_WORDS = frozenset(
    "alert banner banners copyright dialog discussion form header legal menu menus notification overlay promotion register "
    "replies response search share sharing side sign signin social subscription tags toolbar".split())
LAYOUT_WORDS = frozenset(
    "area bar block body bottom box button buttons col column container content footer group inner item items left link "
    "links list outer panel right row section top unit wrap wrapper".split())
HEADER_WORDS = frozenset("header masthead".split())
CONTENT_WORDS = frozenset("article content main post entry story text body prose richtext".split())
COMMENT_WORDS = frozenset("comment comments reply replies".split())
# An article within these is another's: a reader's, or a teaser. Within other furniture words it may be the page's.
FOREIGN_WORDS = COMMENT_WORDS | frozenset(
    "commentlist discussion disqus replies respond related recommended recommendations outbrain taboola".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _presentation(tag, attributes):
    """(signature, words, hidden) of a start tag."""
    words, hidden = [], False
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role"):
                words += (w.lower() for w in _WORDS.findall(unescape(value)))
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
    return (tag + "." + ".".join(sorted(set(words))) if words else tag), frozenset(words), hidden


def _judged(tag, words, hidden, weight, soft):
    """The presentation's weight of an element in a parent of ``weight``; and what kind of article could still be in
    furniture: CONTENT in soft tags, WRAPPED in an element that is furniture by its words only, or False."""
    if tag in ("html", "body"):
        return weight, soft
    if hidden:
        return FURNITURE, False
    if weight == FURNITURE and soft == WRAPPED:
        if words & FOREIGN_WORDS or tag in FURNITURE_TAGS - SOFT_TAGS:
            return FURNITURE, False
        return (WRAPPED, False) if tag in ("main", "article") else (FURNITURE, WRAPPED)
    if weight == FURNITURE and not (soft and (tag in ("main", "article") or "main" in words)):
        return FURNITURE, soft
    if tag in ("main", "article"):
        if words & COMMENT_WORDS:
            return FURNITURE, False
        return (weight if weight in (WRAPPED, DOUBTED) else CONTENT), False
    inside = weight in (CONTENT, WRAPPED, DOUBTED)
    if tag in FURNITURE_TAGS and not (inside and tag == "header"):
        return FURNITURE, CONTENT if tag in SOFT_TAGS else False
    furniture = words & FURNITURE_WORDS
    if inside and furniture and furniture <= EVERYDAY_WORDS and words - FURNITURE_WORDS - LAYOUT_WORDS:
        return (DOUBTED if weight == CONTENT and tag in BLOCKS else weight), soft
    if furniture and not (inside and furniture <= HEADER_WORDS):
        return FURNITURE, False if inside or weight == FURNITURE or words & FOREIGN_WORDS else WRAPPED
    if words & CONTENT_WORDS and weight != FURNITURE and not inside:
        return CONTENT, False
    return weight, soft


def blocks(html):
    """The blocks of a page in order: (node, weight, text, characters of link text).

    ``node`` is a hash of the path of presentations.
    """
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    stack = [("", 0, UNKNOWN, False)]  # tag, node, weight, soft
    open_tags, in_link = Counter(), 0
    out, parts, links = [], [], 0
    owner = None  # node and weight of the block that the parts belong to
    at, n = 0, len(html)

    def flush():
        nonlocal links, owner
        text = " ".join("".join(parts).split())
        if text:
            out.append((*owner, text, links))
        parts.clear()
        links, owner = 0, None

    def add(text):
        nonlocal links, owner
        weight = stack[-1][2]
        if owner and owner[1] != weight:  # an inline element of another weight is a branch of its own
            flush()
        if not owner:
            # The innermost block; or, within it, the outermost inline element of this weight.
            node = stack[-1][1]
            for tag, outer, outer_weight, _ in reversed(stack):
                if outer_weight != weight:
                    break
                node = outer
                if tag in BLOCKS:
                    break
            owner = (node, weight)
        parts.append(text)
        if in_link:
            links += len(text)

    def pop_to(depth):
        nonlocal in_link
        while len(stack) > depth:
            tag = stack.pop()[0]
            open_tags[tag] -= 1
            in_link -= tag == "a"

    def close(tags, barriers=frozenset()):
        """Close the innermost of ``tags`` and all in it, unless a barrier is nearer."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                pop_to(depth)
                return
            if stack[depth][0] in barriers:
                return

    while at < n:
        found = _TAG.search(html, at)
        text = html[at:found.start() if found else n]
        if text:
            add(unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:  # a comment, CDATA, or a declaration
            continue
        if tag in BLOCKS:
            flush()
        if found[1] or found[4]:
            if open_tags[tag]:
                # An inline end tag closes nothing beyond its block.
                close({tag}, frozenset() if tag in BLOCKS else BLOCKS)
        elif tag == "br":
            if parts:
                parts.append(" ")
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            close_at = html.find(">", end.end()) if end else -1
            at = close_at + 1 if close_at >= 0 else n
        elif tag not in VOID:
            if tag in CLOSES:
                close(*CLOSES[tag])
            elif tag in BLOCKS and open_tags["p"]:
                close({"p"}, HOLDS_P)
            _, node, weight, soft = stack[-1]
            signature, words, hidden = _presentation(tag, found[3] or found[6])
            weight, soft = _judged(tag, words, hidden, weight, soft)
            stack.append((tag, digest(f"{node:x}/{signature}") >> 1, weight, soft))
            open_tags[tag] += 1
            in_link += tag == "a"
    flush()
    return out


def importance(weight, entropy, link_share):
    """Importance of a node from its presentation, the entropy of its contents (0 to 1) and its links."""
    presented = weight * (1 - link_share) if weight in TREE_WEIGHTS else weight
    return PRESENTATION_WEIGHT * presented + (1 - PRESENTATION_WEIGHT) * entropy


def page_text(html, low=frozenset(), high=frozenset()):
    """The main text: ``low`` and ``high`` are the page's nodes that the host's tree judges otherwise than alone."""
    found, chars, kept = blocks(html or ""), Counter(), []
    for _, weight, text, _ in found:
        chars[weight] += len(text)
    template = sum(len(text) for node, weight, text, _ in found if weight == CONTENT and node in low)
    for node, weight, text, links in found:
        alone = importance(weight, 1.0, links / len(text)) >= LEAST_IMPORTANCE
        if weight == CONTENT:
            keep = node not in low or 2 * template > chars[CONTENT]
        elif weight == WRAPPED:
            alone = alone and chars[WRAPPED] > chars[CONTENT] + chars[UNKNOWN]
            keep = chars[WRAPPED] > chars[CONTENT] and (node in high or node not in low and alone)
        else:
            keep = weight != FURNITURE and (node in high or node not in low and alone)
        if keep:
            kept.append(text)
    return "\n".join(kept)


def host_of(url):
    """Lower-case host of a url column; empty where there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def _page_digests(found):
    """For each weight a digest that is equal for pages alike in what matters to it: articles go by their own
    blocks, so that what changes around one makes no other article of it; the rest by all blocks but furniture."""
    import xxhash

    page, article = xxhash.xxh3_64(), xxhash.xxh3_64()
    for node, weight, text, links in found:
        if weight != FURNITURE:
            block = f"{node:x} {links} {text}\n"
            page.update(block)
            if weight == CONTENT:
                article.update(block)
    page, article = page.intdigest() >> 1, article.intdigest() >> 1
    return {FURNITURE: page, UNKNOWN: page, WRAPPED: page, DOUBTED: article, CONTENT: article}


def _hosted(pages, url, html):
    """The host column, and a key that is equal for pages of one host and html."""
    host = host_of(F.col(url))
    return host, F.md5(F.concat_ws("\n", host, F.col(html)))


def page_nodes(pages, url="url", html="html"):
    """One row per different page of a host and node: page_key, host, page (equal for copies), node, weight, content,
    chars, links, and the largest share of link text that a block of the node has (``linked``)."""
    import xxhash

    def rows(batches):
        for batch in batches:
            out = [[] for _ in range(9)]
            for key, host, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = blocks(html or "")
                pages = _page_digests(found)
                nodes = {}
                for node, weight, text, links in found:
                    seen = nodes.setdefault(node, [weight, xxhash.xxh3_64(), 0, 0, 0.0])
                    seen[1].update(text)
                    seen[1].update("\n")
                    seen[2] += len(text)
                    seen[3] += links
                    seen[4] = max(seen[4], links / len(text))
                for node, (weight, content, chars, links, linked) in nodes.items():
                    row = (key, host, pages[weight], node, weight, content.intdigest() >> 1, chars, links, linked)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(),
                     pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)],
                ["page_key", "host", "page", "node", "weight", "content", "chars", "links", "linked"])

    host, key = _hosted(pages, url, html)
    return map_batches(
        pages.select(key.alias("page_key"), host.alias("host"), F.col(html).alias("html")).where("host <> ''"), rows,
        "page_key string, host string, page long, node long, weight double, content long, chars long, links long, "
        "linked double")


def style_nodes(found):
    """Of the rows of ``page_nodes``, one row per host and node of at least ``MIN_PAGES`` different pages: host, node,
    pages, weight, entropy, link_share, importance."""
    found = found.drop("page_key", "linked").distinct()
    # The weight is a key, so that a filter on it comes before the shuffles.
    contents = found.groupBy("host", "node", "weight", "content").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    n = F.sum("n")
    nodes = contents.groupBy("host", "node", "weight").agg(
        n.alias("pages"), (F.sum("links") / F.greatest(F.sum("chars"), F.lit(1))).alias("link_share"),
        (F.log(n) - F.sum(F.col("n") * F.log("n")) / n).alias("nats")).where(F.col("pages") >= MIN_PAGES)
    entropy = F.greatest(F.col("nats") / F.log("pages"), F.lit(0.0))
    presented = _presented(F.col("link_share"))
    return nodes.select("host", "node", "pages", "weight", "link_share", entropy.alias("entropy")).withColumn(
        "importance", PRESENTATION_WEIGHT * presented + (1 - PRESENTATION_WEIGHT) * F.col("entropy"))


def _presented(link_share):
    weight = F.col("weight")
    return F.when(weight.isin(*TREE_WEIGHTS), weight * (1 - link_share)).otherwise(weight)


def site_trees(pages, url="url", html="html"):
    """A staged table (tree_key, low, high): for each different page the nodes whose verdict by the host's tree is not
    that of their presentation alone, to be removed and to be kept; none for most pages. Named furniture outside an
    article never is, and of articles only blocks that are the same nearly everywhere."""
    found = stage(page_nodes(pages, url, html).where(F.col("weight") != FURNITURE), "page_nodes")
    nodes = style_nodes(found)
    template = (F.col("pages") >= MANY_PAGES) & (F.col("entropy") < LEAST_ENTROPY)
    named = F.col("weight") == CONTENT
    keeps = ~named & (F.col("importance") >= LEAST_IMPORTANCE)
    judged = stage(nodes.where(~named | template).select(
        F.col("host").alias("j_host"), F.col("node").alias("j_node"), keeps.alias("keeps")), "judged")
    # A page's own links may speak against a node that the tree keeps; an article in a wrapper needs the tree's word.
    alone = (F.col("weight") != WRAPPED) & (
        PRESENTATION_WEIGHT * _presented(F.col("linked")) + 1 - PRESENTATION_WEIGHT >= LEAST_IMPORTANCE)
    # Both sides are dealt out anew for the join, so a node that is on all pages of a large host can be split.
    deviating = found.join(
        judged, (F.col("host") == F.col("j_host")) & (F.col("node") == F.col("j_node"))
    ).where(~F.col("keeps") | ~alone).select("page_key", "node", "keeps").distinct()
    node = F.col("node")
    return stage(deviating.groupBy(F.col("page_key").alias("tree_key")).agg(
        F.collect_list(F.when(~F.col("keeps"), node)).alias("low"),
        F.collect_list(F.when(F.col("keeps"), node)).alias("high")), "trees")


def main_text(pages, page_id="page_id", url="url", html="html"):
    """One row per page: page_id, url, text, n_chars."""
    trees = site_trees(pages, url, html)
    slim = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
        _hosted(pages, url, html)[1].alias("page_key"))
    joined = slim.join(trees, F.col("page_key") == F.col("tree_key"), "left")

    def extract(batches):
        for batch in batches:
            texts = [
                page_text(page, frozenset(low or ()), frozenset(high or ()))
                for page, low, high in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = slim.schema["page_id"].dataType.simpleString()
    return map_batches(
        joined.select("page_id", "url", "html", "low", "high"), extract, f"page_id {kind}, url string, text string, n_chars long")
