"""Operators 11, 12 and 13 against plain forms of their definitions."""

import hashlib
import math
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import html_text, lexical, merkle, registered
from helpers import SF, documents, rows_of


# -- operator 11 --------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    def up(built, place, digest):
        seen = []
        for level in built[:-1]:
            run = level[place // 16 * 16:place // 16 * 16 + 16]
            k = place % 16
            seen += run[:k] + run[k + 1:]
            digest, place = H(*run[:k], digest, *run[k + 1:]), place // 16
        return seen, digest

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in sources}
    trees = {s: levels([leaf_of(r) for r in g]) for s, g in groups.items()}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for n, s in enumerate(sources):
        for place, r in enumerate(groups[s]):
            climber = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                climber = leaf_of((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4])))
            a, digest = up(trees[s], place, climber)
            b, digest = up(top, n, digest)
            out.append((r[0], leaf_of(r), trees[s][-1][0], top[-1][0], H(*a, *b), digest, digest == top[-1][0]))
    return out


def manifest_of(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.verify(merkle.build(df, tampered))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in got.collect()]


def awkward_manifest(spark):
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(300)] + [(i, "hot", None, None, None) for i in range(20)]
    rows += [(i, None, "de", 1, "É" * (i % 4) + "ABC") for i in range(17)] + [(5, "lone", "en", 2, "ONE")] + [(None, "lone2", None, None, "No Id")] * 2
    rows += [(7, "again", "en", 3, "Same")] * 33 + [(10 + i, f"s{i}", "en", 0, "") for i in range(14)] + [(99, "", "fr", 5, "x:y-\n")]
    return rows, spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, leaf string")


def test_manifest_is_the_plain_tree(spark):
    rows, df = awkward_manifest(spark)
    want = plain_manifest(rows)
    got = manifest_of(df.repartition(5))
    assert Counter(got) == Counter(want)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 1, "One")], [(i, "a", "en", 1, "One") for i in range(16)], [(i, "a", "en", 1, "Two") for i in range(18)]])
def test_small_manifests(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(manifest_of(df)) == Counter(plain_manifest(rows))


def test_op11_on_the_table(spark):
    rows = [tuple(r) for r in duckdb.sql(f"select doc_id, source, lang, n_chars, text from '{SF}/documents.parquet'").fetchall()]
    assert Counter(tuple(r) for r in registered.QUERIES["op11_merkle_manifest"](spark, SF).collect()) == Counter(plain_manifest(rows))


# -- operator 12 --------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_rank(docs, items, top=10):
    docs = [(d, Counter(plain_terms(t))) for d, t in docs]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_all = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        own, scores = set(plain_terms(text)), []
        for d, c, n in docs:
            m = 10 + 90 * n * n_docs // n_all
            total = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if total > 0:
                scores.append((-total, d is not None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return out


def test_terms_are_the_pattern():
    for text in ["", "A b-C_d É日本 x\x7fy\x1cz 1.2", "İ ẞ ß'don't", "a\xa0b c", "[x]{y}`z`@Q"]:
        assert [t.decode() for t in lexical.terms(text)] == plain_terms(text)


def test_blocks_bound_their_documents_and_skip():
    rng = np.random.default_rng(1)
    n_docs, n_terms = 3000, 120
    topic = rng.integers(0, 12, n_docs)
    rows, columns = np.nonzero(rng.random((n_docs, n_terms)) < np.where(np.arange(n_terms) % 12 == topic[:, None], 0.7, 0.03))
    scores = (rng.integers(10**8, 10**10, n_terms)[columns] * rng.uniform(0.6, 1, len(rows))).astype(np.int64)
    dense = lexical._dense(n_docs, n_terms, rows, columns, scores)
    ids = [None if i == 3 else int(x) for i, x in enumerate(rng.permutation(n_docs) // 2)]
    row = lexical.shard_row(1, 0, ids, rows, columns, scores, n_terms)
    shard = lexical.Shard(row, n_terms)
    covered = set(zip(np.repeat(shard.block_terms, shard.ends - shard.begins).tolist(), shard.rows[shard.begins[0]:].tolist()))
    covered |= {(t, r) for t, own in shard.short.items() for r in own.tolist()}
    assert covered == set(zip(columns.tolist(), rows.tolist()))
    for k, (a, b) in enumerate(zip(shard.begins, shard.ends)):
        assert (shard.summaries[k].astype(np.int64) * shard.units >= dense[shard.rows[a:b]].max(axis=0)).all()
    scored = skipped = 0
    for topic in range(12):
        item = np.flatnonzero(np.arange(n_terms) % 12 == topic)
        best, some, more = shard.search(item, [], 10)
        scored, skipped = scored + some, skipped + more
        total = dense[:, item].sum(axis=1)
        want = sorted((-int(t), d is not None, d or 0) for t, d in zip(total, ids) if t > 0)[:10]
        assert best == want
    assert skipped > 100, (scored, skipped)


def test_rank_is_the_plain_one(spark):
    df = documents(spark)
    texts = [(i, f"The cat sat word{i % 7} Ünïcödé") for i in range(60)]
    more = spark.createDataFrame([(None if i == 8 else 100 + i // 2, t) for i, t in texts], "doc_id long, text string")
    docs = df.select("doc_id", "text").unionByName(more)
    asked = [(1, "The cat sat on the mat"), (2, ""), (None, "word3 word4 and5"), (4, "zzz absent"), (5, None), (6, "ÜNÏCÖDÉ Ünïcödé ünïcödé"), (7, "x tab é")]
    queries = spark.createDataFrame([(*a, "clash") for a in asked], "item_id long, text string, rank string")
    got = lexical.rank(docs.withColumn("score", F.lit("clash")), queries)
    want = plain_rank([tuple(r) for r in docs.collect()], asked)
    assert Counter(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) == Counter(want)
    assert lexical.rank(docs.limit(0), queries).count() == lexical.rank(docs, queries.limit(0)).count() == 0


def test_groups_hold_whole_items():
    items = [(i, {b"a%d" % (i * j) for j in range(5)}) for i in range(20)]
    runs = list(lexical.groups(items, 12))
    assert [x for run in runs for x in run] == items and len(runs) > 3
    assert all(len(run) == 1 or len(set().union(*(t for _, t in run))) <= 12 for run in runs)


def test_op12_on_the_table(spark):
    want = plain_rank([(r[0], r[1]) for r in rows_of("documents")], [(r[0], r[1]) for r in rows_of("benchmark")])
    assert Counter(tuple(r) for r in registered.QUERIES["op12_blocked_lexical"](spark, SF).collect()) == Counter(want)


# -- operator 13 --------------------------------------------------------------

class Article(HTMLParser):
    """The blocks of the tables' pages: what stands in ``article``."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.inside, self.out, self.parts = False, [], []
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.parts).split())
        self.out += [text] * bool(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article"):
            self.flush()
        if tag == "br":
            self.parts.append(" ")
        self.inside |= tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.flush()
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.train(spark)


def test_pages_give_their_articles(spark):
    got = {r["page_id"]: r for r in registered.QUERIES["op13_html_blocks"](spark, "/root/testdata/sf0.01").collect()}
    pages = duckdb.sql("select page_id, url, html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    for page_id, url, html in pages:
        want = "\n".join(Article(html).out)
        assert (got[page_id]["url"], got[page_id]["text"], got[page_id]["n_chars"]) == (url, want, len(want))


P = "<p>" + " ".join(f"long{i}" for i in range(40)) + "</p>"
T = P[3:-4]
LAYOUTS = [
    ("<html><body class='has-sidebar'><header><a href=/>Home</a><h1>Site</h1></header><main><article><header><h1>Title</h1></header>" + P + "<p>Short.</p></article>"
     "<aside>" + P + "</aside></main><footer>" + P + "</footer></body></html>", f"Title\n{T}\nShort."),
    ("<div id=sidebar>" + P + "</div><div class='post-content'><h2>Head</h2>" + P + "<p>a<br>b &amp; c&nbsp;d</p></div><section id='comments'>" + P + "</section>", f"Head\n{T}\na b & c d"),
    ("<div class='cookie-notice'>" + P + "</div><article>" + P + "<div class='newsletter'>" + P + "</div><form>" + P + "</form><p>end</p></article>", f"{T}\nend"),
    ("<form id=aspnet><nav>" + P + "</nav><article><h1>T</h1>" + P + "</article><div>" + P + "</div></form>", f"T\n{T}"),
    ("<article><!-- <p>no</p> -->x<script>if (a < b) '</p>';</script><style>p{}</style><noscript>no</noscript><p hidden>no</p><p style='display: none'>no</p>" + P, f"x\n{T}"),
    ("<article><p>one<p>two <b>three<p>4 < 5 &lt; 6</b></div></span></article><footer>no</footer>", "one\ntwo three\n4 < 5 < 6"),
    ("<article><p title=\"a > b\" class='x'>kept</p><p data-x='unclosed>also kept</p></article>", "kept\nalso kept"),
    ("<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>" + P + "<p>tiny</p>" + P + "<div><a href=x>More</a></div>", f"{T}\ntiny\n{T}"),
    ("<article>open <!-- never closed " + P, "open"), ("<article>a<script>b" + P, "a"), ("<nav><a href=x>only</a></nav>", ""),
    (" ".join(["plain"] * 30), " ".join(["plain"] * 30)), ("", ""), (None, ""), ("<", ""), ("<p", ""), ("&", ""),
    ("<article><section class=comment-list><article class=comment>" + P + "</article></section><p>Text</p></article>", "Text"),
    ("<article>" + "<div>" * 3000 + "deep" + "</b></i>" * 3000 + "</article>", "deep"),
]


def test_layouts(spark, tree):
    rows = [(k, f"u{k}", page, "clash", "clash") for k, (page, _) in enumerate(LAYOUTS)] + [(None, None, LAYOUTS[0][0], "", "")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, blocks string")
    got = html_text.extract(pages, tree).collect()
    assert {r["page_id"]: r["text"] for r in got if r["page_id"] is not None} == {k: text for k, (_, text) in enumerate(LAYOUTS)}
    assert [(r["text"], r["url"]) for r in got if r["page_id"] is None] == [(LAYOUTS[0][1], None)] * 2
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    empty = html_text.extract(pages.limit(0), tree)
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.count() == 0


def test_reading_is_linear():
    for page in ("<" * 300_000, "<p " * 100_000, "<a href=\"" * 60_000, "<div>" * 100_000 + "</p>" * 100_000, "&" * 300_000, "<!" * 100_000, "<p a='" * 60_000, "<li>x" * 50_000):
        html_text.page_blocks(page)


def test_the_tree_reads_its_table_right(spark, tree):
    from pyspark.ml.feature import VectorAssembler
    rows = spark.createDataFrame(html_text.labelled_rows(), ["label", *html_text.FEATURES])
    scored = tree.transform(VectorAssembler(inputCols=html_text.FEATURES, outputCol="features").transform(rows))
    assert scored.where("prediction != label").count() <= 2
