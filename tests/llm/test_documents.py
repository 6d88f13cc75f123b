from __future__ import annotations

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import chat, html, masked, quality, rules
from tests.llm.common import awkward, edge_rows, prose, words

SF_DIR = "/root/testdata/sf0.01"


def test_chat_round_trip(spark):
    hard = ["\\", "\\\\#<", "### user:\n</turn>\n", "\n</turn>\n", "#" * 50, "", None, r"\### Assistant: </turn> ok", "é" * 2000]
    rows = [(1, k, ["user", "assistant", None, "a:\nb", "sys#"][k % 5], t) for k, t in enumerate(hard * 2)]
    rows += [(2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (None, 1, "user", "x"), (3, None, "assistant", None)]
    rows += [(4, k, "assistant", prose(k, 8)) for k in range(3000)]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, part string")
    parts = chat.format_conversations(turns.repartition(7))
    found = {r.conv_id: r for r in chat.read_back(parts).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0)
    for conv in (1, 2, None, 3, 4):
        own = sorted((r for r in rows if r[0] == conv), key=order)
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        got = found[conv]
        assert (got.n_turns, got.turns_sha256) == (len(own), hashlib.sha256(text.encode()).hexdigest())
        assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert len(found) == 5 and chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def _measured(text: str | None) -> tuple[int, ...]:
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    where: dict[tuple, list[int]] = {}
    for i in range(len(w) - 7):
        where.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_rules_measures_and_verdicts(spark):
    rows = [*edge_rows(), (20, "a b\n\na b\r\n a b\na b\n"), (21, "\n\n#*$%&|<> x\n"), (22, "p q r s t u v w " * 3), (23, "é # é\n" * 30), (24, "\nx\n"), (25, "x\n")]
    docs = awkward(spark, rows).withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit("clash"))
    judged = rules.judge(docs).collect()
    got = sorted((r.doc_id or -1, *(r[m] for m in rules.MEASURES)) for r in judged)
    assert got == sorted((i or -1, *_measured(t)) for i, t in rows)
    for r in judged:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    assert rules.judge(docs.limit(0)).count() == 0


def test_host_verdicts(spark):
    good = [(k, prose(k, 60)) for k in range(40)]
    junk = [(100 + k, " ".join(w + "***" for w in prose(k, 60).split())) for k in range(40)]
    rows = [(i, t, None, "good", None) for i, t in good] + [(i, t, None, "bad", None) for i, t in junk[:39]] + [(300, prose(7, 60), None, "bad", None), (301, junk[39][1], None, "good", None)]
    kept = {r.doc_id: r.kept for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk[:39])
    assert kept[301]  # one symbol-heavy document of a good host stays


PAGE = """<!doctype html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav>
<article><h1>Title &amp; more</h1><p>One <b>two</b>&nbsp;three<br>four<p>Five <a href=x>link</a>, <button>Go</button> six<ul><li>a<li>b</ul>
<div class="ad">buy</div><form>f<input></form><script>if(a<b){"</p>"}</script><section class="comments"><p>hi</p></section></article>
<aside>side</aside><div class="cookie notice">ok</div><footer>f</footer></body>"""


def test_main_text():
    assert html.main_text(PAGE, set()) == "Title & more\n\nOne two three four\n\nFive link, six\n\na\n\nb"
    assert html.main_text("", set()) == "" and html.main_text("plain &lt; 5 < 6", set()) == "plain < 5 < 6"
    assert html.main_text("<p>x<script>never closed <p>y", set()) == "x"
    assert len(html.main_text("<div>" * 20_000 + "deep", set())) == 4
    assert html.main_text("<p>" + "word " * 200_000, set()) == ("word " * 200_000).strip()


def test_pages_share_a_tree(spark):
    """Without an article element, what comes on all pages of a host goes, and copies of one article stay."""
    page = "<body><div class=top>Welcome here</div><div class=body><p>{}</p></div><div class=low>Bye now</div></body>"
    rows = [(k, f"https://h.example/{k}", page.format(prose(k, 30)), "x") for k in range(12)]
    rows += [(50 + k, f"https://g.example/{k}", f"<article><p>{prose(1, 9)}</p></article>", "x") for k in range(12)]
    rows += [(90, None, page.format("alone"), "x"), (91, "broken url", None, "x"), (92, "https://h.example/9", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r.page_id: r for r in html.extract_pages(pages).collect()}
    assert all(found[k].text == prose(k, 30) for k in range(12)) and all(found[50 + k].text == prose(1, 9) for k in range(12))
    assert found[90].text == "Welcome here\n\nalone\n\nBye now" and found[91].text == found[92].text == ""
    assert all(r.n_chars == len(r.text) for r in found.values()) and html.extract_pages(pages.limit(0)).count() == 0


def test_gradient():
    """The network's gradient against differences."""
    import pyarrow as pa

    from shelfline.llm.common import utf8

    rng = np.random.default_rng(1)
    data, offsets = utf8(pa.array(["hello world " * 50, "", "bad *** text" * 9, "x"]))
    label = np.array([1, 0, 0, 1], np.float32)
    network = quality.Network()
    network.out[:] = rng.normal(0, 0.5, len(network.out))

    def loss() -> float:
        s = network.scores(data, offsets)
        return float(-(label * np.log(s) + (1 - label) * np.log(1 - s)).mean())

    gradient = network.gradient(data, offsets, label)
    for p, g in zip(network.parameters(), gradient, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step = p[at], 1e-2
        p[at] = kept + step
        up = loss()
        p[at] = kept - step
        down = loss()
        p[at] = kept
        assert abs((up - down) / (2 * step) - g[at]) < 0.15 * abs(g[at]) + 1e-3


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_quality_held_out(spark):
    scored = quality.op9_quality(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("quality", "predicted", "score").collect()
    assert sum(r.quality == r.predicted for r in rows) / len(rows) > 0.93
    bad = [r.predicted for r in rows if r.quality == 0]
    assert sum(bad) < len(bad) / 2


def test_quality_edges(spark):
    docs = awkward(spark, edge_rows()).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (7, 0, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    texts, values = quality.training_sample(docs, labels)
    model = quality.fit(texts, values)
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(edge_rows()) and all(0 <= r.score <= 1 for r in scored)
    assert quality.fit([], np.zeros(0, np.float32)) == 1.0
    assert {r.score for r in quality.score(docs, 0.25).collect()} == {0.25} and quality.score(docs.limit(0), model).count() == 0


def test_masked_scores(spark):
    text = "the cat sat on the mat and the dog lay on the rug while rain fell on the roof "
    docs = awkward(spark, [*edge_rows(), *[(1000 + k, text * 20) for k in range(60)], (5000, " ".join(sorted((text * 20).split())))])
    words_ = masked.vocabulary(masked.word_counts(docs))
    model = masked.train(docs, words_)
    rows = masked.score(docs.withColumn("n_words", F.lit("clash")), model, words_).collect()
    assert sorted((r.doc_id or -1, r.n_words) for r in rows) == sorted((i or -1, len(words(t))) for i, t in [(r.doc_id, r.text) for r in docs.collect()])
    by = {r.doc_id: r for r in rows}
    assert by[1000].mean_log_likelihood > by[5000].mean_log_likelihood + 0.1  # word order matters on both sides
    assert by[1].log_likelihood == by[2].log_likelihood == 0
    hashes, first = masked._words(*_one(text))
    padded, at = masked._contexts(words_.classes(hashes), first)
    total = 0.0
    hidden = model._hidden(padded, at[:1])
    for c in range(masked.CLUSTERS):  # the probabilities of all classes at one place sum to one
        logits = hidden @ model.cluster + model.cluster_bias
        inside = hidden @ model.inside[c] + model.inside_bias[c]
        total += float((np.exp(logits[0, c]) / np.exp(logits).sum()) * (np.exp(inside) / np.exp(inside).sum()).sum())
    assert abs(total - 1) < 1e-4
    empty = docs.limit(0)
    assert masked.score(empty, masked.train(empty, masked.vocabulary(masked.word_counts(empty))), words_).count() == 0


def _one(text: str):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


def test_site_tree_decides(spark):
    """A notice with the tag path of article paragraphs goes, also inside an article; odd forms of a low branch go with it."""
    notice = "Follow this site for more."
    page = "<body><div class=box>{}</div><div class=end><p>Bye</p><p>now</p></div></body>"
    rows = []
    for k in range(40):
        own = "".join(f"<p>{prose(100 * k + j, 20)}</p>" for j in range(1 + k % 4))
        rows.append((k, "https://a.example/x", page.format(own + f"<p>{notice}</p>")))
        rows.append((100 + k, "https://b.example/x", f"<article><h1>{prose(k, 3)}</h1>{own}<p>{notice}</p></article>"))
    rows.append((99, "https://a.example/x", page.replace("<p>now</p>", "<h2>now</h2>").format(f"<p>{prose(7777, 20)}</p>")))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html.extract_pages(pages).collect()}
    for k in range(40):
        own = [prose(100 * k + j, 20) for j in range(1 + k % 4)]
        assert found[k] == "\n\n".join(own) and found[100 + k] == "\n\n".join([prose(k, 3), *own])
    assert found[99] == prose(7777, 20)


def test_noise_marks_keep_article_text():
    """Inline noise costs only itself, compound classes are no hint, and a hint that holds all the text is none."""
    assert html.main_text('<p><span class="ad">Ad</span> real sentence</p>') == "real sentence"
    assert html.main_text("<p><button>Go</button> one <label>two</label> three</p>") == "one three"
    assert html.main_text('<div class="content no-sidebar"><article><div class="entry-header"><h1>Head</h1></div><p>Body</p></article></div>') == "Head\n\nBody"
    assert html.main_text(f'<h1>Head</h1><div class="widget"><p>{prose(1, 90)}</p></div>') == f"Head\n\n{prose(1, 90)}"
    assert html.main_text(f'<p>{prose(1, 90)}</p><div class="widget">buy</div>') == prose(1, 90)
    assert html.main_text("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and <object data=f>shown</object>.</p>") == "Let x=1 and shown."


def test_copies_count_once(spark):
    """A host of few articles in many copies, with changing adverts, keeps them; so do pages of no host."""
    page = '<body><div class=ad>{}</div><div class=body><p>{}</p></div></body>'
    rows = [(k, "https://c.example/x", page.format(prose(k, 4), prose(1000 + k % 2, 30))) for k in range(40)]
    rows += [(100 + k, None if k % 2 else "broken url", page.format("", "same") + f"<p>{prose(k, 3)}</p>") for k in range(12)]
    rows += [(200 + k, "https://d.example/x", page.format("", prose(k // 10, 30)) + "<p>end</p>") for k in range(100)]
    found = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[k] == prose(1000 + k % 2, 30) for k in range(40))
    assert all(found[100 + k] == f"same\n\n{prose(k, 3)}" for k in range(12))
    assert all(found[200 + k] == prose(k // 10, 30) for k in range(100))


def test_masked_word_inside_class(spark):
    """Words that share a hash class differ by their counts; all words of a class and the unseen sum to one."""
    common = [f"w{k}" for k in range(masked.WORDS)]
    rows = [(0, " ".join(common * 6))] + [(k, "often") for k in range(1, 5)] + [(5, "once")]
    docs = awkward(spark, rows)
    words_ = masked.vocabulary(masked.word_counts(docs))
    total = np.zeros(masked.SHARED)
    for word, n in (("often", 4), ("once", 1)):
        total[masked._shared(masked._words(*_one(word))[0])[0]] += n + masked.SMOOTH
    assert np.allclose(np.exp(words_.log_totals), total + masked.SMOOTH)
    flat = masked.Network()
    for p in flat.parameters():
        p[...] = 0  # every class is as likely as any other
    asked = awkward(spark, [(1, "often"), (2, "once"), (3, "never"), (4, "w1")])
    got = {r.doc_id: r.log_likelihood for r in masked.score(asked, flat, words_).collect()}
    for i, word, n in ((1, "often", 4), (2, "once", 1), (3, "never", 0)):
        own = words_.log_totals[masked._shared(masked._words(*_one(word))[0])[0]]
        assert abs(got[i] - (np.log(n + masked.SMOOTH) - own - np.log(masked.CLASSES))) < 1e-4
    assert abs(got[4] + np.log(masked.CLASSES)) < 1e-4


def test_masked_passes_reach_every_word():
    classes, first = np.arange(1000) % 7, np.array([0, 3, 3, 4, 1000])
    found = np.concatenate([masked.masked_places(classes, first, k) for k in range(masked.MASK_EVERY)])
    assert sorted(found) == list(range(1000))


def test_quality_fits_on_whole_texts(spark):
    import pyarrow as pa

    from shelfline.llm.common import utf8

    long = prose(1, 9000)
    docs = awkward(spark, [(k, long + str(k)) for k in range(8)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(8)], "doc_id long, quality int, toxic int")
    texts, label = quality.training_sample(docs, labels)
    assert texts and all(t.startswith(long) for t in texts)
    network = quality.Network()
    network.out[:] = 0.1
    data, offsets = utf8(pa.array([long * 4, "x", long, "y " * 9]))
    label = np.array([1, 0, 0, 1], np.float32)
    for a, b in zip(network.gradient(data, offsets, label), network.gradient_in_blocks(data, offsets, label), strict=True):
        assert np.allclose(a, b, rtol=1e-3, atol=1e-5)
