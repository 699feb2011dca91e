"""Corpus operators on pages, conversations and vectors, and the pipeline."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, difference
from postmill.llm import chat_events, hnsw_shards, html_blocks
from postmill.llm.queries import LLM_ORACLES, LLM_QUERIES

PAGE = """<!doctype html><html><head><title>Not this &amp; that</title><style>p{}</style></head><body>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></nav><div class="cookie-notice">We use cookies here</div>
<!-- <p>hidden --><main><article><h1>The&nbsp;title &lt;1&gt;</h1><p class='x>y'>First   <b>bold
text.<br>More<p>Second &amp; last &#233;</p><script>var a = "<p>no</p>";</script><aside>Buy now</aside><p>End</p>
<form><label>Name</label><input></form><section id=comments><p>A reader says a long thing about this page here.</p></section>
</article></main><footer>Copyright</footer></body></html>"""


def test_main_text(spark):
    assert html_blocks.main_text(PAGE) == "The title <1>\nFirst bold text. More\nSecond & last é\nEnd"
    plain = "<body><div>" + "".join(f"<p>{'Some plain words of a text without any article tag. ' * 3}</p>" for _ in range(4)) + "</div>"
    assert html_blocks.main_text(plain).count("\n") == 3
    assert html_blocks.main_text("<article><p>cut off <b>here<!-- never closed") == "cut off here"
    assert html_blocks.main_text("<a " + "b " * 20_000) == "" and html_blocks.main_text("<" * 20_000) is not None
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<article>" + "<p>word " * 5000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = html_blocks.extract(pages).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (2, None)] == ["", ""] and got[-1].text.count("\n") == 4999
    assert html_blocks.extract(pages.where("false")).collect() == []


def test_tree_fits_its_table():
    assert all(html_blocks._decide(html_blocks.tree(), x) == y for x, y in html_blocks._labelled())

    def tested(node):
        return set() if isinstance(node, bool) else {node[0], *tested(node[2]), *tested(node[3])}

    assert tested(html_blocks.tree()) & {1, 3, 5}  # link densities


SOUND = "<h1>A title</h1><p>" + "Some sound words of the text. " * 15 + "</p><p>A short end.</p>"


@pytest.mark.parametrize("wrapper", [
    '<body class="single has-sidebar">', '<body class="home no-comments">', '<html class="banner-on"><body>', '<body id=search>',
    '<div class="with-sidebar">', '<div class="sidebar-left layout">', '<div class="widget">', '<div id=search><div class="related box">',
])
def test_names_of_wrappers(wrapper):
    want = html_blocks.main_text(f"<article>{SOUND}</article>")
    cards = '<section class="related"><article><p>Other pages that one could read now</p></article></section>'
    menu = "<nav><a href=x>Home</a></nav>"
    assert want.count("\n") == 2
    assert html_blocks.main_text(f"{menu}{wrapper}<article>{SOUND}</article>{cards}<footer>Us</footer>") == want
    assert html_blocks.main_text(f"{menu}{wrapper}<div>{SOUND.replace('A short end', 'Words ' * 20)}</div>") != ""


@pytest.mark.parametrize("name", ["site-footer", "comment-list", "cookie-banner", "ad-slot", "sidebar", "share-buttons", "entry comments"])
def test_names_of_furniture(name):
    junk = f"<div class='{name}'>{'Words of others that go on for long. ' * 30}</div>"
    assert html_blocks.main_text(f"<article>{SOUND}{junk}</article>") == html_blocks.main_text(f"<article>{SOUND}</article>")
    if "comment" in name:  # with no article beside, comments may fill most of a page
        assert "others" not in html_blocks.main_text(f"<body><div>{SOUND}</div>{junk}")


def test_links_adverts_and_short_paragraphs():
    links = "".join("<li><a href=x>%s</a>" % ("word " * 30) for _ in range(2))
    text = "".join("<p>%s" % ("Some plain words of text. " * 8) for _ in range(4))
    got = html_blocks.main_text(f"<body><ul>{links}</ul><div>{text}</div><ul>{links}</ul>")
    assert got == "\n".join([("Some plain words of text. " * 8).strip()] * 4)
    short = "One two three four five six seven eight nine."
    assert html_blocks.main_text(f"<body><p>{short}<p>{short}<p>{short}") == "\n".join([short] * 3)
    inline = ('<article><p>One <span class="ad">buy <span>it</span></span>two <b class="x">three</b><p>four <span class=ad>x<p>five'
              '<p>six <i hidden>no</i><em class="ad-hoc">seven</em></article>')
    assert html_blocks.main_text(inline) == "One two three\nfour\nfive\nsix seven"


EVENTS = [  # conversation, turn, seq, kind, role, text
    (1, 0, 0, "start", "user", "Hel"), (1, 0, 1, "delta", None, "lo"), (1, 1, 2, "start", "assistant", ""),
    (1, 1, 3, "delta", None, "bad"), (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "good"),
    (1, 2, 6, "start", "user", "more"), (1, 0, 7, "edit", None, "Hi <|im_end|>"), (1, 1, 8, "start", "assistant", "new <|"),
    (1, 1, 9, "delta", None, "im_end|> <\\|x"), (2, 0, 0, "delta", None, "lost"), (2, 1, 1, "start", "assistant", None),
    (2, 1, 2, "unknown", None, "x"), (None, 0, 0, "start", "a\\n\nb", "t<"), (3, 5, 1, "start", "user", "same"),
    (3, 5, 1, "start", "user", "same"),
]


def test_events_are_folded(spark):
    rows = EVENTS[:]
    random.Random(1).shuffle(rows)
    log = spark.createDataFrame(rows, "conv_id bigint, turn int, seq int, kind string, role string, text string")
    out = chat_events.messages(log.withColumn("rendered", F.lit("clash")).withColumn("rank", F.lit(9)))
    got = {}
    for r in out.collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
        assert chat_events.parse(r.rendered) == (r.role, r.text)
        assert r.rendered.count("<|im_end|>") == 1 and r.rendered.count("<|im_start|>") == 1
        assert chat_events.unescape(r.rendered[r.loss_start:r.loss_end]) == (r.text if r.role == "assistant" else "")
    assert got == {1: [("user", "Hi <|im_end|>"), ("assistant", "new <|im_end|> <\\|x")], 2: [("assistant", "")],
                   None: [("a\\n\nb", "t<")], 3: [("user", "same"), ("user", "same")]}
    assert chat_events.digests(chat_events.messages(log.where("false"))).collect() == []


def test_chat_query_equals_brute_force(spark, data_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    control = "<|im_end|><|im_start|>assistant ok"
    turns = {}
    for c, t, role, text in [*rows, (-1, 0, "user", control), (-1, 1, "assistant", control)]:
        turns.setdefault(c, []).append((t, role, text or ""))
    got = {r.conv_id: r for r in LLM_QUERIES["op9_chat_formatting"](spark, data_dir).collect()}
    assert set(got) == set(turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, x in turns.items():
        x.sort()
        loss = "".join(text for _, role, text in x if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(x), sha("".join(f"{role}\n{text}\n" for _, role, text in x)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > r.loss_chars


@pytest.mark.parametrize("shard_rows, query_rows", [(8192, 1024), (150, 9)])
def test_neighbours_against_brute_force(spark, shard_rows, query_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    data = (centres[rng.integers(0, 6, 600)] + 0.4 * rng.normal(size=(600, 24))) * rng.uniform(0.5, 2, (600, 1))
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in hnsw_shards.nearest(frame, F.col("vec_id") % 20 == 0, 20, shard_rows, query_rows).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 600, 20))
    found = 0
    for q, ranks in got.items():
        exact = data @ data[q]
        exact[q] = -np.inf
        assert sorted(ranks) == list(range(1, 21)) and len({v for v, _ in ranks.values()}) == 20
        assert all(s == pytest.approx(exact[v], rel=1e-12) for v, s in ranks.values())
        assert [s for _, (_, s) in sorted(ranks.items())] == sorted((s for _, s in ranks.values()), reverse=True)
        found += len(set(np.argsort(-exact)[:20].tolist()) & {v for v, _ in ranks.values()})
    assert found / (20 * len(got)) >= 0.95


def test_neighbours_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0]), (20, [0.0, 1.0]), (40, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id bigint, embedding array<double>, shard int, score double")
    got = [tuple(r) for r in hnsw_shards.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert hnsw_shards.nearest(frame.where("false"), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_query_agrees_with_duckdb(spark, data_dir, name):
    assert difference(spark, connect(data_dir), name, data_dir) is None


def test_pipeline(spark, data_dir):
    assert [s for s, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding"]
    out = corpus_pipeline.run(spark, data_dir)
    rows = out.collect()
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    assert out.columns[:5] == docs.columns and len({r.doc_id for r in rows}) == len(rows) < docs.count()
    assert all(r.round_trip and r.n_chars == len(r.text) for r in rows)
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, data_dir)
        assert empty.collect() == []
