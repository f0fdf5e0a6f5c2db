"""HTML extraction, chat formatting and the pipeline."""

from __future__ import annotations

import hashlib
import html
import re

import corpus_pipeline
import duckdb
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, difference
from test_llm_documents import brute_lines, likeness_components

import __spark_entry__ as entry_point
from tidemark.llm import chat, html_extract, line_dedup, quality, secret_scan
from tidemark.llm.queries import ORACLES, QUERIES

# 5: pages


def article_of(page: str) -> str:
    found = re.search(r"<article>(.*?)(?:</article>|$)", page, re.DOTALL)
    if not found:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", found[1].replace("<br>", " "))
    texts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in blocks)
    return "\n\n".join(t for t in texts if t)


def test_articles_equal_a_plain_cut(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r["page_id"]: r for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == article_of(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def made_page(k: int) -> str:
    return f"""<html><body class="with-sidebar"><header><h1>Site name</h1></header><div role="navigation"><ul><li>m{k}<li>n{k}</ul></div>
    <div><div><h2>Headline {k} &amp; more</h2><p>First   paragraph {k} with <b>bold</i> text<p>Second &lt;{k}&gt;
    <table><tr><td>cell {k}<td>other</table><p>Subscribe now to our weekly letter</p></div>
    <div class="post-comments"><p>I liked number {k}</p></div><form><label>Mail {k}</label></form></div>
    <footer>made {k}</footer><script>if (a < {k}) "</p>"</script></body>"""


def test_pages_without_an_article(spark):
    rows = [(k, f"http://one.example/{k}", made_page(k)) for k in range(12)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(12):
        # "Subscribe ..." stands in all pages of the host: template. "other" does too.
        assert got[k] == f"Headline {k} & more\n\nFirst paragraph {k} with bold text\n\nSecond <{k}>\n\ncell {k}"


def extracted(spark, sources):
    rows = [(k, f"http://one.example/{k}", source) for k, source in enumerate(sources)]
    found = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r["page_id"]: r["text"] for r in found}


def test_text_that_differs_at_a_template_node_stays(spark):
    short = "<article><h1>Short notice</h1><p>Closed today.</p><p>Number {}</p></article>"
    other = "<article><h1>Another head</h1><p>Its lead.</p>" + "<p>A longer paragraph of its own.</p>" * 9 + "</article>"
    got = extracted(spark, [*(short.format(k) for k in range(20)), other])
    assert got[20].startswith("Another head\n\nIts lead.\n\nA longer")


def test_copies_of_a_page_without_an_article_stay(spark):
    copy = "<body><div><h1>A head</h1><p>The text of it all.</p><p>More of it.</p></div></body>"
    counted = copy.replace("</body>", "<p>{}</p></body>")
    got = extracted(spark, [copy] * 20 + [copy.replace("A head", "B head")])
    assert got[0] == "A head\n\nThe text of it all.\n\nMore of it." and got[20].startswith("B head")
    assert all("A head\n\nThe text of it all." in t for t in extracted(spark, [counted.format(k) for k in range(20)]).values())


def test_all_of_a_page_without_an_article_stays(spark):
    beside = "<body><h1>Head {0}</h1><p>Lead {0}</p><div class=body>" + "<p>Paragraph {0} of the text.</p>" * 9 + "</div></body>"
    sections = "<body><section><p>Short {0}</p></section><section>" + "<p>Paragraph {0} of the text.</p>" * 9 + "</section></body>"
    for source, first in ((beside, "Head {0}\n\nLead {0}\n\n"), (sections, "Short {0}\n\n")):
        got = extracted(spark, [source.format(k) for k in range(6)])
        for k in range(6):
            assert got[k] == first.format(k) + "\n\n".join([f"Paragraph {k} of the text."] * 9)


@pytest.mark.parametrize("name", ["content has-sidebar", "post no-comments", "ad-free", "widget", "content sharing"])
def test_a_class_word_does_not_empty_a_page(name):
    for tag in ("article", "div"):
        page = f"<body><div class='{name}'><{tag}><p>The text of the page.</p></{tag}></div><div class='sidebar'>Aside</div></body>"
        assert [b["text"] for b in html_extract.aligned_blocks(page, page)] == ["The text of the page."]


def test_odd_pages(spark):
    rows = [
        (1, None, None, "x"),
        (2, "", "", "x"),
        (2, "", "", "x"),
        (None, "http://h/", "no markup at all &eacute;", "x"),
        (3, "http://h/", "<article><p>a<!-- b --> c</article><p>d", "x"),
        (4, "http://h/", "<article>" + "<div>" * 3_000 + "deep" + "</div>" * 3_000, "x"),
        (5, "http://h/", '<article><p title="open>lost</p><p>kept</p></article>', "x"),
        (6, "http://h/", "<script>only", "x"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = [(r["page_id"], r["text"]) for r in html_extract.extract(df).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, ""), (2, ""), (2, ""), (None, "no markup at all é"), (3, "a c"), (4, "deep"), (5, "lost\n\nkept"), (6, "")], key=repr
    )
    assert html_extract.extract(df.limit(0)).count() == 0


def plain_match(a, b):
    if a.tag != b.tag:
        return 0
    table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + plain_match(x, y))
    return table[-1][-1] + 1


@settings(max_examples=100, deadline=None)
@given(*[st.lists(st.sampled_from(["<div>", "</div>", "<ul>", "</ul>", "<p>x", "<section>", "</section>"]), max_size=14)] * 2)
def test_tree_matching(a, b):
    check_matching(a, b)
    whole, html_extract.MAX_CELLS = html_extract.MAX_CELLS, 1
    try:
        check_matching(a, b)
    finally:
        html_extract.MAX_CELLS = whole


def check_matching(a, b):
    x, y = (html_extract._shaped(html_extract.Page("".join(parts))) for parts in (a, b))
    pairs = html_extract.align(x, y)
    assert len(pairs) == html_extract.match(x.root, y.root) == plain_match(x.root, y.root)
    assert len(set(pairs.values())) == len(pairs)
    for i, j in pairs.items():
        assert x.nodes[i].tag == y.nodes[j].tag
        if x.nodes[i].parent is not None:
            assert pairs[x.nodes[i].parent.index] == y.nodes[j].parent.index


def test_deep_and_wide_pages(spark):
    deep = ["<div>" * n + f"<p>deep {n}" + "<ul><li>x</ul>" * (n % 3) + "</div>" * n for n in (10_000, 10_001, 9_000, 600, 600)]
    kinds = ["<p>{}</p>", "<ul><li>{}</ul>", "<div><p>{}</div>", "<section><p>{}</p><p>more</p></section>"]
    wide = ["".join(kinds[(i * i + i // 7 * k) % 4].format(f"{k} {i}") for i in range(3_000)) for k in (1, 2)]
    got = extracted(spark, deep + wide)
    assert [got[k].split("\n\n")[0] for k in range(5)] == [f"deep {n}" for n in (10_000, 10_001, 9_000, 600, 600)]
    for k in (1, 2):
        blocks = [b for b in got[4 + k].split("\n\n") if b != "more"]
        assert blocks == [f"{k} {i}" for i in range(3_000)]


# 10: conversations

HARD = st.text("<#/\\turn>: A\n%", max_size=25)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), HARD), HARD), max_size=5))
def test_turns_come_back(turns):
    made = chat.render(turns, chat.marked_turns)
    assert made.rewritten_at is None
    assert chat.read_turns(made.text) == turns
    for (_, text), (start, end, text_start, text_end) in zip(turns, made.spans, strict=True):
        assert start <= text_start <= text_end <= end
        assert chat.unescape(made.text[text_start:text_end]) == text


def test_a_template_that_rewrites_history_is_reported():
    def last_only(turns):
        return "".join(f"[{r}] {t if k == len(turns) - 1 else '...'}\n" for k, (r, t) in enumerate(turns))

    assert chat.render([("user", "a"), ("assistant", "b")], last_only).rewritten_at == 1
    assert chat.render([], last_only).spans == []


def test_formatted_conversations(spark):
    rows = [
        (1, 1, "assistant", "</turn>"),
        (1, 0, "user", None),
        (1, 2, None, ""),
        (1, 1, "assistant", "</turn>"),
        (None, None, "user", "lost"),
        (2, 0, "assistant", "x" * 200_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'y' AS turns", "'z' AS loss")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(df)).collect()}
    turns = [("user", ""), ("assistant", "</turn>"), ("assistant", "</turn>"), ("", "")]
    want = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["turns_sha256"]) == (4, want)
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (14, hashlib.sha256(b"</turn></turn>").hexdigest())
    assert got[2]["loss_chars"] == 200_000 and got[None]["n_turns"] == 1
    assert chat.format_conversations(df.limit(0)).count() == chat.format_turns(df.limit(0)).count() == 0
    # Turn by turn, at their offsets, the same strings and spans as whole prefixes give.
    whole = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    turns = sorted(chat.with_offsets(chat.format_turns(df)).collect(), key=lambda r: (r["part"], r["place"]))
    for conv_id, made in whole.items():
        own = [r for r in turns if r["conv_id"] == conv_id]
        assert "".join(r["formatted"] for r in own) == made["formatted"]
        spans = [
            (r["start"], r["start"] + len(r["formatted"]), r["start"] + r["text_start"], r["start"] + r["text_end"])
            for r in own
        ]
        assert spans == [tuple(s) for s in made["spans"]]


def with_separator(turns):
    return "<s>" + "".join(f"{'+' if k and turns[k - 1][0] == r else '|'}{r}: {t}" for k, (r, t) in enumerate(turns))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.text("xy|+: ", max_size=4)), max_size=6))
def test_two_turns_show_what_whole_prefixes_do(turns):
    for template in (chat.marked_turns, with_separator):
        made = chat.render(turns, template)
        added = [chat.added_by(t, turns[k - 1] if k else None, template) for k, t in enumerate(turns)]
        assert "".join(a[0] for a in added) == (made.text if turns else "")
        for (piece, start, end), span in zip(added, made.spans, strict=True):
            assert (span[1] - span[2], span[3] - span[2]) == (len(piece) - start, end - start)


def test_long_conversations_and_rewriting_templates(spark):
    # Small ranges would be merged into one partition.
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        check_long_conversations(spark)
    finally:
        spark.conf.set(merge, before)


def check_long_conversations(spark):
    n = 100_000
    rows = spark.range(n).selectExpr(
        "if(id % 3 = 0, null, 5L) AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('text ', id, ' </turn>') AS text"
    )
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(rows)).collect()}
    for conv_id, own in ((None, range(0, n, 3)), (5, [k for k in range(n) if k % 3])):
        said = [("assistant" if k % 2 else "user", f"text {k} </turn>") for k in own]
        want = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        loss = "".join(t for r, t in said if r == "assistant")
        assert (got[conv_id]["n_turns"], got[conv_id]["turns_sha256"]) == (len(said), want)
        assert (got[conv_id]["loss_chars"], got[conv_id]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv_id]["formatted_chars"] == len(chat.marked_turns(said))
    turns = chat.with_offsets(chat.format_turns(rows)).where("conv_id = 5").selectExpr(
        "count(DISTINCT part) AS parts", "max(start + length(formatted)) AS chars", "count(start) AS n"
    ).first()
    assert turns["parts"] > 1 and (turns["chars"], turns["n"]) == (got[5]["formatted_chars"], got[5]["n_turns"])

    def rewriting(turns):
        return "".join(f"[{r}] {t if k == len(turns) - 1 else '...'}\n" for k, (r, t) in enumerate(turns))

    few = chat.with_offsets(chat.format_turns(rows.where("id < 9"), rewriting)).where("conv_id = 5").orderBy("part", "place").collect()
    assert [r["rewritten"] for r in few] == [False] + [True] * 5 and [r["start"] for r in few] == [0] + [None] * 5


def looking_back(name):
    """Templates that count turns and add up texts, ask for roles that alternate, or carry a count."""

    def numbered(turns):
        return "".join(f"{k} of {sum(len(t) for _, t in turns[:k])} {r}: {t}\n" for k, (r, t) in enumerate(turns))

    def alternating(turns):
        assert all(r == ("assistant" if k % 2 else "user") for k, (r, _) in enumerate(turns))
        return "<s>" + "".join(f"[{r}] {t}" for r, t in turns)

    counted = chat.Resumable(0, lambda n, turn: n + 1, lambda n, turn: f"{n} {turn[0]}: {turn[1]}\n", lambda n: "")
    return {"numbered": numbered, "alternating": alternating, "counted": counted}[name]


@pytest.mark.parametrize("name", ["numbered", "alternating", "counted"])
def test_every_prefix_begins_with_the_first_turn(spark, name):
    template = looking_back(name)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        sizes = {1: 1, 2: 40, 3: 2, 4: 3, 5: 7}
        said = {c: [("assistant" if k % 2 else "user", f"text {k}") for k in range(n)] for c, n in sizes.items()}
        df = spark.createDataFrame([(c, k, *t) for c, own in said.items() for k, t in enumerate(own)], "conv_id long, turn long, role string, text string")
        found = chat.with_offsets(chat.format_turns(df, template)).orderBy("part", "place").collect()
    finally:
        spark.conf.set(merge, before)
    assert len({r["part"] for r in found if r["conv_id"] == 2}) > 1
    for conv_id, turns in said.items():
        own = [r for r in found if r["conv_id"] == conv_id]
        assert "".join(r["formatted"] for r in own) == template(turns)
        places = [(r["start"] + r["text_start"], r["start"] + r["text_end"]) for r in own]
        assert places == [s[2:] for s in chat.render(turns, template).spans]


def test_the_query_renders_and_compares_whole_prefixes(spark, monkeypatch):
    used, whole = [], chat.format_turns
    monkeypatch.setattr(chat, "format_turns", lambda rows, template=chat.marked_turns: used.append(template) or whole(rows, template))
    QUERIES["op10_chat"](spark, SF_DIR)
    prefixes, turns = chat.Prefixes(used[0]), [("user", "a"), ("assistant", "### User: <turn b"), ("user", "")]
    for k, turn in enumerate(turns, 1):
        prefixes.add(turn)
        # What the next rendering is compared with.
        assert prefixes.tail == chat.marked_turns(turns[:k]) != ""


# Registered queries and the pipeline


def test_all_are_registered():
    found = entry_point.queries()
    assert set(QUERIES) | {"pipeline"} <= set(found)
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_twins(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = quality.judge(docs, model).where("kept").select("doc_id")
    left = docs.join(kept, "doc_id", "left_semi")
    gone = brute_lines(left)
    texts = {}
    for r in left.collect():
        dropped = gone.get((r["doc_id"], r["text"]), set())
        text = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in dropped)
        if not dropped or re.search("[^\x20\x09-\x0d]", text):
            texts[r["doc_id"]] = text
    roots = likeness_components(texts)
    stays = {d for d in texts if roots[d] == d}
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {p["doc_id"] for p in pieces} == stays
    from public_tokenizers import path
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    for d in stays:
        n = len(library.encode(secret_scan.redact(texts[d]), add_special_tokens=False).ids) + 1
        own = [p for p in pieces if p["doc_id"] == d]
        assert sum(p["length"] for p in own) == n and {p["doc_tokens"] for p in own} == {n}


def test_pipeline_of_nothing(spark, folder):
    for name in ("documents", "labels"):
        duckdb.sql(f"COPY (SELECT * FROM '{SF_DIR}/{name}.parquet' LIMIT 0) TO '{folder}/{name}.parquet'")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40).selectExpr("*", "1 AS doc_key", "2 AS dropped_lines")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "secret_scan", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).dtypes == docs.dtypes
    assert line_dedup.MIN_CHARS == 16
