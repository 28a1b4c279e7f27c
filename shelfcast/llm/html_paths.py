"""Main text of web pages by consensus of the host: tag-class paths voted on, then used again.

Each page proposes the container that holds its text, as a path of tags and classes with digits
generalised. Spark counts the proposals per host; paths with a fair share of a host's pages win. Every
page is then read again with its host's winning paths, or with its own proposal where none occurs.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..operators.bounds import broadcast_if_small
from .urls import host_of
from .words import unused, written

#: A path wins if it has at least this share of its host's proposals, so a host has few winners.
WIN_SHARE = 0.2

# Elements of HTML by their role.
HIDDEN = set("head title script style noscript template svg iframe object canvas math audio video".split())
FURNITURE = set("nav footer aside form button select textarea dialog menu header".split())
CONTAINERS = set("html body div article main section td".split())
BLOCKS = CONTAINERS | HIDDEN | FURNITURE | set(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tbody thead tfoot tr th figure "
    "figcaption address details summary fieldset hr center hgroup caption".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark what surrounds the article.
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav "
    "navbar navigation navi topbar breadcrumb breadcrumbs sidebar side aside rail widget footer foot "
    "header masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "signup comment comments respond disqus share sharing social related recommended recommendations "
    "toolbar skip pagination pager search login complementary contentinfo".split()
)
#: Words that say nothing of their own beside a mark: where it is, what shape it has.
PLAIN = set(
    "site page main primary secondary global top bottom left right inner outer wrap wrapper container box "
    "block list item items link links post posts article articles entry button buttons bar area section "
    "content text title body icon group row col column unit slot space zone placeholder module component "
    "panel pane region thread reply replies form field small large mobile desktop sticky fixed".split()
)
#: First words of a class that says what an element has or lacks, not what it is.
STATES = set("has no not with without is hide show".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: An article inside marked elements counts for so much of its size.
MARKED_WEIGHT = 0.1
#: An open element that a start tag of the named kind closes.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"},
}
NESTS = {"ul", "ol", "dl", "table"}

_RAW = "script|style|noscript|template|svg|iframe|textarea|title|object|canvas|math|audio|video"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    rf"|</?[a-zA-Z!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
_INLINE, _ALWAYS = 1, 2


class Page:
    """Blocks of text of one page, each with its innermost node.

    Nodes are containers, and elements whose tag or marks say that they surround the article (``out``).
    A block belongs to a container if no such node lies between the two; that the container itself is
    marked, or lies in a marked element, does not hide its text. Nodes keep parent and label only, so
    a page takes time and memory by its length, however deep its elements nest.
    """

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.label: list[str] = [""]
        self.tag: list[str] = [""]
        self.out: list[bool] = [False]
        self.blocks: list[tuple[str, int, bool]] = []  # text, node, made of links only
        self._read(source)

    def _read(self, source: str) -> None:
        # Tag, node, whether text is left out (always, or up to a block), whether in an article.
        stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
        opened: dict[str, int] = {}  # how many elements of a tag are open
        text: list[str] = []
        plain = links = 0

        def close_block() -> None:
            nonlocal plain, links
            if text:
                block = " ".join(html.unescape("".join(text)).split())
                if block:
                    self.blocks.append((block, stack[-1][1], links > 0 and plain == 0))
                text.clear()
            plain = links = 0

        def add(piece: str) -> None:
            nonlocal plain, links
            if piece and not stack[-1][2]:
                text.append(piece)
                if piece.strip():
                    if any(entry[0] == "a" for entry in stack[-4:]):
                        links += 1
                    else:
                        plain += 1

        def close_from(i: int) -> None:
            for entry in stack[i:]:
                opened[entry[0]] -= 1
            del stack[i:]

        at = 0
        for m in _TOKEN.finditer(source):
            add(source[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if m["end"]:
                if tag in BLOCKS:
                    close_block()
                if opened.get(tag):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == tag:
                            close_from(i)
                            break
                        if tag not in BLOCKS and stack[i][0] in CONTAINERS:
                            break
                continue
            if tag == "br":
                add(" ")
                continue
            if tag in BLOCKS:
                close_block()
                while len(stack) > 1 and opened.get("p") and (stack[-1][0] == "p" or stack[-1][0] not in BLOCKS):
                    close_from(len(stack) - 1)
                if tag in CLOSED_BY:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in CLOSED_BY[tag] or stack[i][0] == tag:
                            close_from(i)
                            break
                        if stack[i][0] in NESTS or stack[i][0] in CONTAINERS - {"td"}:
                            break
            if tag in VOID or m["rest"].endswith("/") and tag not in BLOCKS:
                continue
            _, node, silent, inside = stack[-1]
            marked, label = _marks(tag, m["rest"], inside)
            out = (tag in FURNITURE and not (tag == "header" and inside)) or (
                marked and tag not in ("html", "body", "article", "main")
            )
            if tag in HIDDEN:
                silent = _ALWAYS
            elif silent != _ALWAYS:
                # A marked inline element says nothing in the block around it; blocks inside it are its own.
                silent = 0 if tag in BLOCKS else silent or (_INLINE if out else 0)
            if tag in CONTAINERS or out:
                self.parent.append(node)
                self.label.append(f"{tag}{label}")
                self.tag.append(tag)
                self.out.append(out)
                node = len(self.parent) - 1
            opened[tag] = opened.get(tag, 0) + 1
            stack.append((tag, node, silent, inside or tag in ("article", "main")))
        add(source[at:])
        close_block()

    def path(self, node: int) -> str:
        """Tags and generalised classes of the containers around ``node``, from the outermost."""
        steps = []
        while node > 0:
            steps.append(self.label[node])
            node = self.parent[node]
        return "".join(f">{x}" for x in reversed(steps))

    def _sizes(self, out: list[bool]) -> tuple[list[int], list[int]]:
        """Characters that belong to each node, and those of them in no node below it; links don't count."""
        own = [0] * len(self.parent)
        for block, node, linked in self.blocks:
            own[node] += 0 if linked else len(block)
        size = own[:]
        for i in range(len(size) - 1, 0, -1):
            if not out[i]:
                size[self.parent[i]] += size[i]
        return size, own

    def proposal(self) -> str:
        """Path of the container that holds the page's text.

        An article or main element with most text wins; inside marked elements it counts little.
        Otherwise: from the top down into a child while it has most of the text and nothing of it
        stands beside the children. A form counts as marked only if there is text outside forms.
        """
        out = self.out
        size, own = self._sizes(out)
        under = [False] * len(out)
        for i in range(1, len(out)):
            under[i] = out[i] or under[self.parent[i]]
        articles = [i for i, t in enumerate(self.tag) if t in ("article", "main") and size[i]]
        clean = [i for i in articles if not under[i]]
        if not clean:
            articles = [i for i in articles if MARKED_WEIGHT * size[i] > size[0]]
        for found in (clean, articles):
            if found:
                best = max(found, key=lambda i: (size[i], self.tag[i] == "article", -i))
                inner = [i for i in found if self.tag[i] == "article" and size[i] >= 0.6 * size[best]]
                return self.path(inner[-1] if inner else best)
        if not size[0]:
            out = [o and t != "form" for o, t in zip(out, self.tag)]
            size, own = self._sizes(out)
        if not size[0]:
            return ""
        children: dict[int, list[int]] = {}
        for i, up in enumerate(self.parent[1:], 1):
            if not out[i]:
                children.setdefault(up, []).append(i)
        node = 0
        while own[node] == 0 and node in children:
            best = max(children[node], key=lambda i: (size[i], -i))
            if size[best] < 0.6 * size[node]:
                break
            node = best
        return self.path(node)

    def text(self, paths: list[str]) -> str | None:
        """Blocks that belong to the first of ``paths`` with any; None if none has.

        Places inside marked elements count only if the path has no text elsewhere.
        """
        for path in paths:
            steps = path.split(">")[1:]
            # How many steps of the path lead to a node; -1 where it has left the path.
            depth = [0] + [-1] * (len(self.parent) - 1)
            under = [False] * len(self.parent)
            for i in range(1, len(depth)):
                d = depth[self.parent[i]]
                if 0 <= d < len(steps) and steps[d] == self.label[i]:
                    depth[i] = d + 1
                under[i] = self.out[i] or under[self.parent[i]]
            for marked in (False, True):
                inside = [False] * len(depth)
                for i in range(len(depth)):
                    inside[i] = (depth[i] == len(steps) and (marked or not under[i])) or (
                        i > 0 and not self.out[i] and inside[self.parent[i]]
                    )
                found = [block for block, node, _ in self.blocks if inside[node]]
                if found:
                    return "\n\n".join(found)
        return None


def _names_mark(name: str, in_article: bool, whole: bool) -> bool:
    """Whether a class (or id: ``whole``) names what surrounds the article.

    It does if all its words are marks or say nothing of their own, or, for a class, if its last word
    is a mark. A header inside an article is its own.
    """
    words = [w.lower() for w in _WORD.findall(_CAMEL.sub(" ", name))]
    if not words or words[0] in STATES:
        return False
    marks = MARKS - {"header"} if in_article else MARKS
    if not whole and words[-1] in marks:
        return True
    return any(w in marks for w in words) and all(w in MARKS or w in PLAIN or len(w) == 1 for w in words)


def _marks(tag: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether class, id or role mark furniture, and the generalised classes for the path.

    Ids of headings never mark, as they are anchors.
    """
    if "=" not in attributes:
        return False, ""
    marked, label = False, ""
    for m in _ATTRIBUTE.finditer(attributes):
        value, kind = m[2] or m[3] or m[4] or "", m[1].lower()
        if kind != "id":
            marked = marked or any(_names_mark(c, in_article, False) for c in value.split())
        elif tag not in HEADINGS:
            marked = marked or _names_mark(value, in_article, True)
        if kind == "class":
            # The sign between steps of a path cannot be part of a class here.
            label = "".join("." + c for c in sorted({_DIGITS.sub("#", c) for c in value.replace(">", "^").split()}))
    return marked, label


def proposals(pages: DataFrame) -> DataFrame:
    """page_host and the path each page proposes; pages without text propose none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [Page(x or "").proposal() for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_host"), pa.array(paths, pa.string())], ["page_host", "path"]
            )

    rows = pages.select(host_of(F.col("url")).alias("page_host"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_host string, path string").where("path != ''")


def winners(proposed: DataFrame) -> DataFrame:
    """of_host and its winning paths, one a line, most votes first (ties: smaller path)."""
    votes = proposed.groupBy("page_host", "path").agg(F.count("*").alias("votes"))
    share = F.col("votes") / F.sum("votes").over(Window.partitionBy("page_host"))
    return (
        votes.withColumn("share", share)
        .where(F.col("share") >= WIN_SHARE)
        .groupBy("page_host")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))).alias("won"))
        .select(F.col("page_host").alias("of_host"), F.array_join("won.path", "\n").alias("paths"))
    )


def main_texts(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html, other columns) with ``text`` and ``n_chars`` instead of html.

    A null or empty html gives an empty text. A null url, or one without host, belongs to the empty
    host, which votes like any other. Repeated rows are extracted each; other columns pass through,
    but for text and n_chars, which are replaced. Whole pages are read, whatever their length. An empty
    table gives an empty one; of paths with equal votes the smaller is tried first.
    """
    base = pages.drop("text", "n_chars").withColumn("html", F.col("html").cast("string"))
    own_host, paths = unused(base.columns, "own_host"), unused(base.columns, "paths")
    spark = pages.sparkSession
    won = broadcast_if_small(written(spark, winners(proposals(base)), "html-paths"))
    won = won.toDF(of_host := unused(base.columns, "of_host"), paths)
    joined = base.withColumn(own_host, host_of(F.col("url"))).join(won, F.col(own_host) == F.col(of_host), "left")
    kept = [c for c in base.columns if c != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, won_paths in zip(batch.column("html").to_pylist(), batch.column(paths).to_pylist()):
                page = Page(source or "")
                won_text = page.text(won_paths.split("\n")) if won_paths else None
                texts.append(won_text or page.text([page.proposal()]) or "")
            sizes = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), sizes],
                [*kept, "text", "n_chars"],
            )

    fields = [f for f in base.schema if f.name != "html"]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return joined.select(*(F.col(f"`{c}`") for c in kept), "html", paths).mapInArrow(run, schema)
