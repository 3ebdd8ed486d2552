"""Page text, language, toxicity and tokenizer: edge rows, round trips, held-out accuracy."""

import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stopwise.llm import bpe_lexicon, html_density, language_lm, toxicity
from stopwise.llm.pretoken import split_words

from .plain import SCHEMA, edge_docs, edge_texts, prose, rows, sha

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n=3000):
    rng = random.Random(1)
    pieces = [*"aàs'tredml  \n\t  　\u0085\x1c.,!?0१9€😀é漢字’", "'s", "'re", " 'll", "don't",
              "<|endoftext|>", "Ᲊ", "́"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_ids_equal_the_library(library):
    texts = [*odd_texts(), *(t or "" for t in edge_texts())]
    vocabulary = bpe_lexicon.Vocabulary(open(PATH, encoding="utf-8").read())
    words = [w.encode() for w in {w for t in texts[:1500] for w in split_words([t])[0]}]
    ids, ends = vocabulary.merge(words)
    packed = bpe_lexicon.Lexicon.build(dict(zip(words, np.split(ids, ends[:-1]))))
    for lexicon in (None, bpe_lexicon.Lexicon.of(packed)):
        ids, ends = bpe_lexicon.Encoder(vocabulary, lexicon).encode(texts)
        parts = np.split(ids, ends[:-1])
        want = library.encode_batch(texts, add_special_tokens=False)
        assert [p.tolist() for p in parts] == [w.ids for w in want]
        assert vocabulary.text(ids, ends) == texts


def test_lexicon_is_minimal_and_knows_only_its_words(tmp_path):
    words = {w.encode(): [k] for k, w in enumerate("tops stops tap taps stop top".split())}
    packed = bpe_lexicon.Lexicon.build(words)
    (tmp_path / "lexicon").write_bytes(packed)
    lexicon = bpe_lexicon.Lexicon.open(str(tmp_path / "lexicon"))
    assert len(lexicon.final) <= 9          # suffixes are shared: a trie has 18 states
    ranks = lexicon.ranks([*words, b"", b"to", b"stopss", b"x"])
    assert [sorted(words)[r] for r in ranks[:6]] == list(words) and (ranks[6:] == -1).all()
    empty = bpe_lexicon.Lexicon.of(bpe_lexicon.Lexicon.build({}))
    assert empty.ranks([b"a", b""]).tolist() == [-1, -1]


def test_encode_and_decode_columns(spark, library):
    tokenizer = bpe_lexicon.BpeTokenizer(spark, PATH)
    docs = edge_docs(spark)
    tokenizer.fit_lexicon(docs, most=50)
    coded = tokenizer.encode(docs).withColumn("decoded", tokenizer.decode())
    assert coded.columns == [c for c in SCHEMA.names if c != "ids"] + ["ids", "decoded"]
    got = coded.collect()
    assert len(got) == len(rows())
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    none = edge_docs(spark, [])
    tokenizer.fit_lexicon(none)
    assert tokenizer.encode(none).count() == 0
    bad = spark.createDataFrame([([464, 999_999, -1],), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in bad.select(tokenizer.decode()).collect()] == ["The", None, ""]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header>
<nav><ul><li><a href=a>Home</a><li><a href=b>News of the day</a></ul></nav>
<div class="cookie-notice">We use cookies to make this page better for you, and for us.</div>
<div id="wrap"><div class="post"><h1>Title &amp; more</h1>
<p>First paragraph with <a href=q>a link</a>, long enough to be
dense, as articles are.<p>Second&nbsp;paragraph<br>has many words in it as well, so it counts.
<script>var x = "<p>no</p>";</script><form>Name <input></form></div>
<aside>Something else that is written at some length beside the article.</aside></div>
<div class="comments"><p>Nice article, I really liked it and would read it again.</p></div>
<footer>&copy; Site, all rights reserved, and some more words</footer></body></html>"""


def test_round_trip_in_one_pass(spark, monkeypatch):
    library = Tokenizer.from_file(PATH)
    tokenizer = bpe_lexicon.BpeTokenizer(spark, PATH)
    tokenizer.fit_lexicon(edge_docs(spark))
    monkeypatch.setattr(bpe_lexicon, "HELD_WORDS", 40)
    monkeypatch.setattr(bpe_lexicon, "PORTION_CHARS", 300)
    got = tokenizer.round_trip(edge_docs(spark), bpe_lexicon.DIGESTS, bpe_lexicon.digests)
    assert got.columns == [c for c in SCHEMA.names if c != "text"] + ["n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for r in rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert tokenizer.round_trip(edge_docs(spark, []), bpe_lexicon.DIGESTS, bpe_lexicon.digests).count() == 0


def test_forgotten_words_are_taken_over(monkeypatch):
    monkeypatch.setattr(bpe_lexicon, "HELD_WORDS", 3)
    vocabulary = bpe_lexicon.Vocabulary(open(PATH, encoding="utf-8").read())
    encoder, library = bpe_lexicon.Encoder(vocabulary, None), Tokenizer.from_file(PATH)
    for text in ["a b c d e", "d e f g", "e f a b", "<|endoftext|> a", "b <|endoftext|> z"] * 3:
        ids, ends = encoder.encode([text, "", text])
        own = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == own + own and ends.tolist() == [len(own), len(own), 2 * len(own)]


def test_main_text_of_a_page():
    assert html_density.main_text(PAGE) == (
        "Title & more\nFirst paragraph with a link, long enough to be dense, as articles are.\n"
        "Second paragraph has many words in it as well, so it counts.")


def _paragraphs(n, size, mark):
    return [" ".join(f"{mark}{k}" + "x" * 7 for _ in range(size // 10)) for k in range(n)]


def _html(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("outer, inner", [("article", "section"), ("main", "div"), ("div", "div")])
def test_second_section_below_the_best_density_is_content(outer, inner):
    """By the threshold of the path alone where no article or main holds both."""
    one, two = _paragraphs(5, 400, "a"), _paragraphs(5, 390, "b")
    page = (f"<body><{outer}><{inner}>{_html(one)}</{inner}><{inner}>{_html(two)}</{inner}>"
            f"</{outer}><div><a href=x>{'link ' * 30}</a></div></body>")
    assert html_density.main_text(page) == "\n".join(one + two)


def test_heading_short_blocks_and_loose_text_of_the_article():
    long = _paragraphs(5, 400, "a")
    page = (f"<body><nav>Menu</nav><main><h1>Title</h1><div><a href=x>More of it</a></div>"
            f"<article><header><h2><a href=t>Part</a></h2></header>Loose <a href=y>linked</a> text"
            f"<p>Short.</p><ul><li><a href=z>Elsewhere on this site</a></li></ul>"
            f"<div>{_html(long)}</div><p>End.</p><aside>Beside</aside>after all</article>"
            f"<h2><a href=m>More stories</a></h2></main><footer>Foot</footer></body>")
    assert html_density.main_text(page) == "\n".join(
        ["Title", "Part", "Loose linked text", "Short.", *long, "End.", "after all"])


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words only", "plain words only"),
    ("<p>one<p>two", "one\ntwo"), ("<b><i>odd</b> nest</i>", "odd nest"),
    ("<body><nav>menu</nav></body>", ""), ("</div></p>stray<br/>end", "stray end"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("a &lt;b&gt; &amp;amp;", "a <b> &amp;")])
def test_odd_pages(html, text):
    assert html_density.main_text(html) == text


def _unmarked(rng):
    """A page without any telling tag, role or class, and the article's text in it."""
    paragraphs = [" ".join(f"w{rng.randrange(999)}" for _ in range(rng.randrange(15, 60)))
                  for _ in range(rng.randrange(6, 14))]
    links = "".join(f"<span><a href=x>go{k}</a></span>" for k in range(rng.randrange(5, 20)))
    page = (f"<body><div>{links}</div><div>Buy one, get one</div><section><div>{_html(paragraphs)}</div>"
            f"</section><div>Some rights reserved</div><div><p><a href=y>{'more ' * 9}</a></div></body>")
    return page, "\n".join(paragraphs)


def test_density_alone_finds_the_article(monkeypatch):
    pages = [_unmarked(random.Random(k)) for k in range(60)]
    assert all(html_density.main_text(page) == text for page, text in pages)
    for constant in (0.0, 1.0):
        monkeypatch.setattr(html_density, "composite_density", lambda *a: constant)
        assert sum(html_density.main_text(page) != text for page, text in pages) > 50


@pytest.mark.parametrize("html, text", [
    ("<![foo[x]]>", ""), ("a<![if IE]>b<![endif]>c", "abc"), ("<p>x<![", "x<!["),
    ("<!DOCTYPE html [<!ENTITY a 'b'>]><p>y</p>", "]>\ny"), ("<!--<p>no--><p>z", "z")])
def test_marked_sections_and_declarations(html, text):
    assert html_density.main_text(html) == text


def test_random_markup_never_fails():
    rng = random.Random(12)
    parts = ["<![", "[", "]]>", "<!", "--", ">", "<", "</", "<p", "<div>", "</div>", "<table>", "<li>", "<a href='", "'",
             '"', "&amp", "&#x;", "&#99999999;", "text ", "<script>", "</script>", "<br/>", "<?x", "<![CDATA[", "\0", "é"]
    for _ in range(4000):
        html_density.main_text("".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))))


@pytest.mark.parametrize("html", ["<div>" * 60_000, "<p><table>" + "<span><div>" * 20_000, "<p>" * 30_000,
                                  "<ul>" + "<li><b>" * 30_000, "<div><p>" * 20_000 + "x"])
def test_cost_is_linear_in_nesting(html):
    start = time.process_time()
    html_density.main_text(html)
    assert time.process_time() - start < 5


def test_extract_keeps_columns(spark):
    pages = spark.createDataFrame(
        [(1, PAGE, "mine"), (2, None, None), (2, None, None)], "page_id long, html string, text string")
    got = html_density.extract(pages)
    assert got.columns == ["page_id", "html", "text"]
    assert sorted(r["text"] for r in got.collect())[:2] == ["", ""]
    assert html_density.extract(pages.limit(0)).count() == 0


def _speech(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
                    for _ in range(n))


def test_languages_held_out(spark):
    rng = random.Random(3)
    kinds = {"aa": ["tha", "ing", "er"], "bb": ["ção", "que", "er"], "cc": ["sch", "ung", "er"]}
    given = [(k, _speech(rng, kinds[lang], rng.randrange(5, 60)), lang)
             for k, lang in enumerate(sorted(kinds) * 100)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string")
    models = language_lm.fit(docs.filter("doc_id % 4 <> 0"))
    got = language_lm.identify(docs.filter("doc_id % 4 = 0"), models).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
    text = ["tha ing thaing", "", "123 !?", "日本語"]
    names, scores, _, rejected = models.predict(text)
    assert names[:3] == ["aa", "und", "und"] and scores[1] == scores[2] == 0
    assert rejected[1:].all() and names[3] in kinds


def test_probabilities_sum_to_one():
    """Over all characters after a context, for each language."""
    rng = random.Random(8)
    texts = [[_speech(rng, s, 40)] for s in (["ab", "ba", "c"], ["ab", "d"])]
    tables = [[b.to_pydict() for b in language_lm._counted(k, t)] for k, t in enumerate(texts)]
    counts = {c: np.array([x for t in tables for b in t for x in b[c]], np.int64)
              for c in ("lang", "k", "gram", "prefix", "suffix", "n")}
    for c in ("gram", "prefix", "suffix"):
        counts[c] = counts[c].view(np.uint64)
    models = language_lm.LanguageModels(["x", "y"], counts)
    letters = "abcd z"         # a blank ends a word; no language has z

    def total(context):
        costs = []
        for c in letters:
            e, n = models.entropies([context + c, context])
            whole = -e[0] * n[0]
            before = -e[1] * n[1]
            costs.append(np.exp(whole - before))
        return np.sum(costs, axis=0)

    for context in ("ab", "abba", "c", "dd", "zz"):
        assert np.allclose(total(context), 1, atol=1e-3), context


def test_languages_edges(spark):
    docs = edge_docs(spark)
    models = language_lm.fit(docs)
    got = language_lm.identify(docs, models)
    assert [c for c in SCHEMA.names if c != "score"] == got.columns[:-4]
    for r in got.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    none = language_lm.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_lm.identify(docs, none).collect()} == {"und"}
    assert language_lm.identify(docs.limit(0), models).count() == 0


def test_toxicity_held_out_and_misspelt(spark):
    rng = random.Random(6)
    given = []
    for k in range(900):
        text = prose(rng, rng.randrange(10, 60)).split()
        if k % 4 == 0:
            for bad in rng.sample(["horrible", "disgusting", "worthless"], 2):
                text.insert(rng.randrange(len(text)), bad)
        given.append((k, " ".join(text), int(k % 4 == 0)))
    docs = spark.createDataFrame([g[:2] for g in given], "doc_id long, text string")
    labels = spark.createDataFrame([(g[0], g[2]) for g in given], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.filter("doc_id % 5 <> 0"))
    held = toxicity.score(docs.filter("doc_id % 5 = 0"), model).collect()
    assert sum(r["predicted"] == given[r["doc_id"]][2] for r in held) >= 0.95 * len(held)
    plain = prose(rng, 20)
    clean, misspelt = model.scores([plain, f"{plain} horribble disgustingg"])
    assert clean < 0.5 < misspelt


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (8, 0), (15, None), (22, 7), (None, 1)],
                                   "doc_id long, toxic int")
    for given in (labels, labels.filter("toxic = 1"), labels.limit(0)):
        scored = toxicity.score(docs, toxicity.fit(docs, given))
        got = scored.collect()
        assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert scored.columns[-2:] == ["score", "predicted"] and "kept" in scored.columns
