"""Operator 13, main text of HTML pages by classified text blocks.

``page_blocks`` flattens a page into text blocks: what stands between two
block-level tags, with its number of words, its link density (share of its
characters inside links), the same of the block before and after it, and what
kind of element it stands in.  A decision tree (Spark ML), trained on the small
labelled table ``LABELLED``, tells the article's blocks from the rest; it is
applied as one column expression over the array of a page's blocks, so a page
never leaves its row and nothing is shuffled.

Scripts, styles, titles, templates, hidden elements and markup comments never
become blocks.  ``<br>`` is white space inside a block.  Broken markup is read
as browsers do in the main: unclosed comments and scripts run to the end, a
block-level tag closes an open paragraph, an unknown end tag is ignored.

Edge cases: a null or empty page, or one without article text, has an empty
text; a text without markup is one block (kept if it has the words of a
paragraph); rows repeated exactly give a row each; an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, steps, text_column

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")

# Elements of HTML by what they mean for a reader.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
SKIPPED = frozenset("noscript template svg math object select button canvas audio video head datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dt dd td th".split())
ITEM_HOLDERS = frozenset("ul ol menu dl table".split())
FURNITURE = frozenset("nav footer aside menu dialog search".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar status note".split())
FURNITURE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs "
                            "footer masthead topbar toolbar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
                            "share sharing social related recommended recommendations teaser teasers widget pagination pager copyright legal disclaimer skip "
                            "comment comments commentlist disqus respond reply replies discussion form tags byline".split())
CONTENT_WORDS = frozenset("article content entry story post main".split())
NEGATING_WORDS = frozenset("has with no without".split())

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "content", "heading", "item"]

# Labelled pages: {n} stands for n words, {a:n} for a link of n words.  The second field labels the blocks in order.
LABELLED = [
    ("<nav><ul><li>{a:1}</li><li>{a:2}</li><li>{a:1}</li></ul></nav><div class=ad>{9}</div><article><h1>{7}</h1><p>{60}</p><p>{2}</p><p>{35}</p></article><footer>{8}</footer>", "000011110"),
    ("<nav><ul><li>{a:1}</li><li>{a:1}</li></ul></nav><div class=ad>{45}</div><article><h1>{1}</h1><p>{1}</p><p>{1}</p></article><footer>{30} {a:3}</footer>", "0001110"),
    ("<div class=ad>{1}</div><article><p>{1}</p></article><footer>{1}</footer>", "010"),
    ("<header><h1>{2}</h1><p>{12}</p></header><main><h1>{9}</h1><p>{80} {a:4} {20}</p><ul><li>{6}</li><li>{3}</li></ul><blockquote>{25}</blockquote><aside>{50}</aside><p>{5}</p></main>", "001111101"),
    ("<main><p>{40}</p><h2>{a:3}</h2><p>{30}</p><p>{a:5}</p><p>{22}</p></main><section class=comments><h3>{2}</h3><p>{70}</p><p>{15}</p><p>{40}</p></section>", "111110000"),
    ("<article><h1>{5}</h1><p>{50}</p><ul><li>{a:3}</li><li>{a:4}</li><li>{a:3}</li><li>{a:5}</li></ul></article>", "110000"),
    ("<article><p>{33}</p><ul><li>{a:2} {12}</li><li>{a:1} {15}</li></ul><p>{4} {a:2} {3}</p></article>", "1111"),
    ("<article><p>{20}</p><form><p>{12}</p><p>{3}</p></form><p>{1}</p><div class=newsletter>{25}</div><p>{18}</p></article>", "100101"),
    ("<div class=cookie-notice>{35}</div><div class=content><h2>{4}</h2><p>{44}</p><p>{3}</p></div><div class=sidebar><p>{40}</p><p>{6}</p><p>{a:4}</p></div>", "0111000"),
    ("<div>{a:1} {a:1} {a:2}</div><div>{3}</div><h1>{6}</h1><p>{55}</p><p>{48}</p><p>{5}</p><p>{62}</p><div>{a:2} {a:2}</div><div>{6}</div>", "001111100"),
    ("<div>{a:2}</div><div>{a:3}</div><div>{2}</div><p>{30}</p><p>{14}</p><p>{26} {a:2}</p><div>{4}</div><div>{a:1}</div>", "00011100"),
    ("<table><tr><td>{a:1}</td><td>{a:1}</td></tr><tr><td>{90} {a:3}</td></tr><tr><td>{70}</td></tr><tr><td>{5}</td><td>{a:2}</td></tr></table>", "001100"),
    ("<div>{2}</div><div>{3}</div><div>{1}</div><div>{a:4}</div><div>{5} {a:5}</div>", "00000"),
    ("<h2>{4}</h2><p>{28}</p><h2>{3}</h2><p>{41}</p><h3>{2}</h3><ul><li>{a:3}</li><li>{a:3}</li></ul>", "1111000"),
    ("<p>{24}</p><p>{19}</p><p>{3}</p><p>{21}</p>", "1111"),
    ("<div>{a:2}</div><p>{30}</p><p>{2}</p><p>{25}</p><p>{1}</p><p>{40}</p><p>{1}</p><p>{33}</p><div>{1}</div><div>{a:1}</div>", "0111111100"),
    ("<article><p>{30}</p><p>{1} {a:1}</p><p>{a:2}</p><p>{20}</p><p>{a:1}</p></article><footer>{a:3}</footer>", "111110"),
    ("<main><h1>{3}</h1><p>{a:1} {1}</p><p>{a:3}</p><p>{45}</p></main>", "1111"),
    ("<p>{120}</p>", "1"),
    ("<p>{2}</p>", "0"),
    ("<article><p>{3}</p></article>", "1"),
    ("<article>{200}</article>", "1"),
    ("<article><h1>{4}</h1></article><footer>{5}</footer>", "10"),
    ("<footer>{100}</footer>", "0"),
    ("<aside><h4>{3}</h4><p>{70}</p></aside><article><p>{70}</p></article><div class=comments><p>{70}</p></div>", "0010"),
]


def _kinds(name: str, rest: str, in_content: bool) -> tuple[bool, bool, bool]:
    """(hidden, furniture, content) of an element by its name and attributes."""
    furniture, content = name in FURNITURE or name == "form" or name == "header" and not in_content, name in ("article", "main")
    if "=" not in rest and "hidden" not in rest or name in ("html", "body"):
        return False, furniture, content
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, furniture, content
        if key == "role":
            furniture |= value.lower() in FURNITURE_ROLES
            content |= value.lower() in ("main", "article")
        elif key in ("class", "id"):
            for token in value.split():
                words = {w.lower() for w in _WORD.findall(token)}
                if words & NEGATING_WORDS:
                    continue
                if words & FURNITURE_WORDS or "header" in words and not in_content:
                    furniture = True
                elif words & CONTENT_WORDS:
                    content = True
    return False, furniture, content


class _Reader:
    """The blocks of one page while its tokens pass by."""

    def __init__(self) -> None:
        self.blocks: list[list] = []  # text, words, links, furniture, content, heading, item
        self.open: list[tuple] = []   # name, hidden, furniture, content, forms around it
        self.count: dict[str, int] = {}
        self.hidden = self.furniture = self.content = 0
        self.forms = 0                # forms around an article do not count
        self.link = -1                # depth at which a link was opened
        self.parts: list[str] = []
        self.linked = 0

    def text(self, raw: str) -> None:
        if self.hidden:
            return
        if "&" in raw:
            raw = unescape(raw)
        self.parts.append(raw)
        if self.link >= 0:
            self.linked += len("".join(raw.split()))

    def flush(self) -> None:
        if not self.parts:
            return
        words = "".join(self.parts).split()
        if words:
            name = next((x[0] for x in reversed(self.open) if x[0] in HEADINGS or x[0] in ITEMS or x[0] in ("p", "div", "article")), "")
            letters = sum(map(len, words))
            self.blocks.append([" ".join(words), len(words), self.linked / letters, int(self.furniture > 0 or self.forms > 0), int(self.content > 0), int(name in HEADINGS), int(name in ITEMS)])
        self.parts, self.linked = [], 0

    def push(self, name: str, rest: str) -> None:
        hidden, furniture, content = _kinds(name, rest, self.content > 0)
        hidden |= name in SKIPPED
        form = furniture and name == "form"
        # A form that holds the whole page ends, for this purpose, where its article begins.
        saved, furniture = self.forms, furniture and not form
        self.forms = 0 if content and not furniture else self.forms + form
        self.open.append((name, hidden, furniture, content, saved))
        self.count[name] = self.count.get(name, 0) + 1
        self.hidden += hidden
        self.furniture += furniture
        self.content += content

    def pop(self) -> None:
        name, hidden, furniture, content, self.forms = self.open.pop()
        self.count[name] -= 1
        self.hidden -= hidden
        self.furniture -= furniture
        self.content -= content
        if self.link > len(self.open):
            self.link = -1

    def close(self, name: str) -> None:
        """Close the nearest open ``name`` and what stands in it."""
        if self.count.get(name):
            while self.open[-1][0] != name:
                self.pop()
            self.pop()

    def start(self, name: str, rest: str) -> None:
        if name == "a":
            self.link = len(self.open)
        if name == "br":
            self.parts.append(" ")
        if name in BLOCK or name in SKIPPED:
            self.flush()
            if name in BLOCK and self.count.get("p"):
                self.close("p")
            if name in ITEMS and self.count.get(name):
                holder = next(x[0] for x in reversed(self.open) if x[0] == name or x[0] in ITEM_HOLDERS)
                if holder == name:
                    self.close(name)
            if name not in VOID:
                self.push(name, rest)

    def end(self, name: str) -> None:
        if name == "a":
            self.link = -1
        if name in BLOCK or name in SKIPPED:
            self.flush()
            self.close(name)


def flat_blocks(html: str) -> list[list]:
    """text, words, links, furniture, content, heading, item of all blocks of a page."""
    reader, at, token = _Reader(), 0, _TOKEN.search(html)
    while token:
        if token.start() > at:
            reader.text(html[at:token.start()])
        at, name = token.end(), (token["name"] or "").lower()
        if token[0].startswith("<![CDATA["):
            reader.text(token[0][9:].removesuffix("]]>").replace("&", "&amp;"))
        elif name and token["end"]:
            reader.end(name)
        elif name in RAW:
            close = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else len(html)
        elif name:
            reader.start(name, token["rest"])
        token = _TOKEN.search(html, at)
    reader.text(html[at:])
    reader.flush()
    return reader.blocks


def page_blocks(html: str) -> list[tuple]:
    """(text, *FEATURES) of all blocks of a page; beyond its edges stands a block without words."""
    blocks = flat_blocks(html)
    edge = ["", 0, 0.0]
    around = [edge, *blocks, edge]
    return [(b[0], b[1], b[2], before[1], before[2], after[1], after[2], *b[3:]) for before, b, after in zip(around, blocks, around[2:])]


def labelled_rows() -> list[tuple]:
    """(label, *FEATURES) of the labelled pages."""
    def filled(m: re.Match) -> str:
        words = " ".join(["word"] * int(m[2]))
        return f"<a href=x>{words}</a>" if m[1] else words

    rows = []
    for page, labels in LABELLED:
        blocks = page_blocks(re.sub(r"\{(a:)?(\d+)\}", filled, page))
        assert len(blocks) == len(labels), (page, len(blocks), labels)
        rows += [(float(label), *map(float, b[1:])) for label, b in zip(labels, blocks)]
    return rows


def train(spark: SparkSession):
    """The decision tree, from the labelled table."""
    table = spark.createDataFrame(labelled_rows(), ["label", *FEATURES]).coalesce(1)
    return DecisionTreeClassifier(maxDepth=8, maxBins=128, seed=7).fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table))


def as_column(tree, block: Column) -> Column:
    """Whether ``tree`` takes ``block`` (a struct with FEATURES) for article text, as one expression."""
    def of(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(node.prediction() == 1.0)
        split = node.split()
        return F.when(block[FEATURES[split.featureIndex()]] <= split.threshold(), of(node.leftChild())).otherwise(of(node.rightChild()))

    return of(tree._java_obj.rootNode())


BLOCKS = pa.struct([("text", pa.large_string()), *((f, pa.float64()) for f in FEATURES)])


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for step in steps(batch, "html"):
            pages = [page_blocks(page) for page in text_column(step.column("html")).to_pylist()]
            flat = [block for page in pages for block in page]
            columns = [pa.array([b[k] for b in flat], kind.type) for k, kind in enumerate(BLOCKS)]
            ends = [0]
            for page in pages:
                ends.append(ends[-1] + len(page))
            blocks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(BLOCKS)))
            yield pa.RecordBatch.from_arrays([step.column("page_id"), step.column("url"), blocks], names=["page_id", "url", "blocks"])


def blocks(pages: DataFrame) -> DataFrame:
    """page_id, url, blocks: all text blocks of each page with their features."""
    prepare(pages.sparkSession)
    rows = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    fields = ", ".join(f"{f}: double" for f in FEATURES)
    return rows.mapInArrow(_flatten, f"page_id long, url string, blocks array<struct<text: string, {fields}>>")


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """page_id, url, text, n_chars: the main text of each page."""
    tree = tree or train(pages.sparkSession)
    kept = F.transform(F.filter("blocks", lambda b: as_column(tree, b)), lambda b: b["text"])
    out = blocks(pages).select("page_id", "url", F.array_join(kept, "\n").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
