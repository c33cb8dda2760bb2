"""SentencePiece, HTML, chat, URL and the classifiers: against libraries, by hand, or by held-out accuracy."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigia.llm import chat_threads, html_text, language_id, quality, sentencepiece_codec, toxicity, url_filter

SF = "/root/testdata/sf0.01"
TEXTS = [None, "", " ", "\n", "Hello  world", "  lead and trail ", "日本語 ☃ text\nnext line", "aaaaaaaaaaaaaaaaaaaa", "<s> </s> <unk> <0x0A>", "tab\there", "x" * 3000, "the " * 4000]


@pytest.fixture(scope="module")
def sp():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_codec.default_model())


def test_sentencepiece_matches_the_library(spark, sp):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    sample = spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit(0).alias("ids"))
    both = docs.unionByName(sample)
    texts = {r["doc_id"]: r["text"] for r in both.collect()}
    got = {r["doc_id"]: r for r in sentencepiece_codec.encode_checked(both, sentencepiece_codec.default_model()).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert got[i]["ids"] == sp.encode(t or "") and got[i]["n_tokens"] == len(got[i]["ids"])
        assert got[i]["round_trip"]


def test_decode_is_the_inverse(spark):
    model = sentencepiece_codec.default_model()
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model), model)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert sentencepiece_codec.encode(docs.limit(0), model).count() == 0


def test_unigram_walk_is_viterbi():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "aba", "▁ab"]
    scores = [0.0, -3.0, -2.0, -2.1, -2.5, -3.2, -2.4, -4.0, -4.4]
    v = sentencepiece_codec.Vocabulary(pieces, scores, [False] + [True] * 8, [], 0, "unigram")
    encoder = sentencepiece_codec.Encoder(v)

    def best(word):
        found = []
        for n in range(1, len(word) + 1):
            for cuts in itertools.combinations(range(1, len(word)), n - 1):
                parts = [word[i:j] for i, j in zip((0, *cuts), (*cuts, len(word)), strict=True)]
                if all(p in pieces for p in parts):
                    found.append(sum(scores[pieces.index(p)] for p in parts))
        return max(found)

    for text in ("ababa", "aab", "bba", "abab aba"):
        words = encoder.split(text)
        ids = encoder.encode_words(words)
        for w in words:
            assert abs(sum(scores[i] for i in ids[w]) - best(w)) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav><div class="cookie-notice">We use cookies on this site</div>
<article><h1>Head &amp; line</h1><p>First   paragraph &lt;here&gt; with <a href="x">a link</a><br>and
more.</p><p>Of.</p><div class="advert">Buy now this thing</div><p><b>Unclosed bold.<br><p>Last one.</article>
<aside>Read this too please</aside><form><label>Name</label><input></form><div id="comments"><p>I think that this is a very long comment by a reader of the page</p></div>
<footer>&copy; someone</footer><!-- end --></body></html>"""


def test_html_text(spark):
    rows = [(1, "u1", PAGE), (2, None, None), (3, "u3", ""), (4, "u4", "plain text only, of no page at all, but still long enough to be a text of its own, as one would say who reads it"), (1, "u1", PAGE), (5, "u5", "<p>" * 3000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()]
    want = "Head & line\nFirst paragraph <here> with a link and more.\nOf.\nUnclosed bold.\nLast one."
    assert got.count((1, want, len(want))) == 2
    assert (2, "", 0) in got and (3, "", 0) in got and (5, "", 0) in got
    assert next(t for i, t, _ in got if i == 4).startswith("plain text only")
    assert html_text.extract(pages.limit(0)).count() == 0


WORDS = "so it is said here and there "
PAGES = [
    ("<article><p>Short article text.</p></article>", "Short article text."),
    ("<p>The only paragraph of this page.</p>", "The only paragraph of this page."),
    (f"<article><h1>Head line</h1><p>{WORDS * 6}</p><p>The last one is short.</p></article>", f"Head line\n{(WORDS * 6).strip()}\nThe last one is short."),
    (f"<ul><li><a href=a>Home</a></li><li><a href=b>About us</a></li></ul><h1>The head line</h1><p>{WORDS * 6}</p><p>{WORDS * 4}</p>", f"The head line\n{(WORDS * 6).strip()}\n{(WORDS * 4).strip()}"),
    ("".join(f"<div><a href=x>Link {i}</a></div>" for i in range(6)) + f"<p>{WORDS * 5}</p><p>{WORDS * 3}</p>", f"{(WORDS * 5).strip()}\n{(WORDS * 3).strip()}"),
    (f"<article><div class='article-header'><h1>Head line</h1></div><p>{WORDS * 4}</p></article>", f"Head line\n{(WORDS * 4).strip()}"),
    (f"<div class=post-content><p>{WORDS * 4}</p><div class='post-comments'><p>I think so too</p></div></div><div>Something else</div>", (WORDS * 4).strip()),
    ("<article><h1>Word</h1><p><a href=x>all of it is a link</a></p><p>And more of it.</p></article>", "Word\nall of it is a link\nAnd more of it."),
    (f"<div><a href=1>One</a></div><div><a href=2>Two of them</a></div><p>{WORDS * 5}</p><p>{WORDS * 3}</p><div><a href=1>Terms</a></div><div><a href=2>About us</a></div>", f"{(WORDS * 5).strip()}\n{(WORDS * 3).strip()}"),
]


def plain(n):
    return " ".join(["word"] * n)


def linked(n):
    return f"<a href=x>{plain(n)}</a>"


#: Elements left open, names that only may be a notice, linked paragraphs among others, lines of rights.
PAGES += [
    (f"<article><p>A</p><svg><p>{plain(40)}</p></article>", f"A\n{plain(40)}"),
    (f"<article><p>A</p><noscript><p>{plain(40)}</p></article>", f"A\n{plain(40)}"),
    (f"<nav><a>x</a><article>{plain(40)}</article>", plain(40)),
    (f'<article><p>{plain(20)}</p><p class="notice-board">{plain(35)}</p><div class="social-history"><p>{plain(30)}</p></div></article>', f"{plain(20)}\n{plain(35)}\n{plain(30)}"),
    (f"<p>{plain(30)}</p><p>{plain(30)} {linked(20)}</p><p>{plain(30)}</p>", f"{plain(30)}\n{plain(50)}\n{plain(30)}"),
    (f"<p>{plain(30)}</p><p>{linked(20)}</p><p>{plain(30)}</p>", f"{plain(30)}\n{plain(20)}\n{plain(30)}"),
    (f"<p>{plain(40)}</p><p>{plain(40)}</p><div>Copyright 2024 Example Inc. All rights reserved.</div>", f"{plain(40)}\n{plain(40)}"),
    (f'<article><p>{plain(40)}</p><div class="social-share">Share this</div><div class="share">{linked(3)}</div></article>', plain(40)),
    (f'<article><p>{plain(40)}</p><section class="comments"><article class="comment"><p>{plain(40)}</p></article></section></article>', plain(40)),
    (f'<article><p>{plain(40)}</p><svg><title>icon</title><path d="x"/></svg><p>{plain(12)}</p></article>', f"{plain(40)}\n{plain(12)}"),
    (f'<article><p>{plain(40)}</p><svg><p>{plain(9)}</p></article><footer><svg><path/></svg></footer>', f"{plain(40)}\n{plain(9)}"),
    (f"<nav><ul><li>{linked(1)}</li></ul></nav><article><h1>T</h1><p>{plain(25)}</p></article>", f"T\n{plain(25)}"),
    (f'<article><p>{plain(40)}</p><div class="related-posts"><a>{plain(6)}</a></div></article>', plain(40)),
    (f'<main><h1>{plain(4)}</h1><p>{plain(50)}</p><p class="share-price">{plain(45)}</p><p>{plain(45)}</p></main>', f"{plain(4)}\n{plain(50)}\n{plain(45)}\n{plain(45)}"),
    (f"<article><p>{plain(30)}</p><canvas><p>fallback</p></canvas><p>{plain(10)}</p></article>", f"{plain(30)}\n{plain(10)}"),
    (f"<article><p>{plain(30)}</p><object><p>{plain(12)}</p></article>", f"{plain(30)}\n{plain(12)}"),
    (f"<p>{plain(60)}</p><p>© 2021 Someone</p>", plain(60)),
    (f"<article><p>{plain(30)} copyright {plain(30)}</p><p>{plain(20)}</p></article>", f"{plain(30)} copyright {plain(30)}\n{plain(20)}"),
    (f"<button>Menu<article><p>{plain(30)}</p></article>", plain(30)),
    (f"<ul><li>{linked(2)}</li><li>{linked(3)}</li></ul><p>{plain(40)}</p><p>{plain(15)} {linked(10)} {plain(8)}</p><p>{plain(50)}</p><p>{linked(2)}</p><p>{linked(3)}</p>", f"{plain(40)}\n{plain(33)}\n{plain(50)}"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_html_of_other_shapes(page, want):
    assert html_text.main_texts([page], html_text.grow()) == [want]


def test_html_tree_looks_at_links_and_neighbours():
    grown = str(html_text.grow())
    assert all(f"{name} <= " in grown for name in ("words", "link_density", "words_before", "density_before", "density_after", "hinted", "rights"))
    rows = html_text.labelled()
    assert (html_text.grow().predict(rows[:, :-1]) == rows[:, -1]).all()


def test_html_articles_of_the_sample(spark):
    got = html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect()
    import html

    for r in got:
        body = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p))).strip() for p in re.split(r"</?(?:p|h1)>", body))
        assert r["text"] == "\n".join(p for p in parts if p)


def test_chat_threads(spark):
    rows = [
        (1, 0, "user", "What is the capital of France?\nAnd of Spain, if you know it?"),
        (1, 1, "assistant", "It is Paris, of course."),
        (1, 2, "user", "> And of Spain, if you  KNOW it?\nI meant that one."),
        (1, 3, "assistant", "On Monday Ann wrote:\n>> And of Spain, if you know it?\n> I meant that one.\nMadrid it is."),
        (1, 4, "user", "> never said before by anyone\nok"),
        (1, 5, "user", None),
        (2, 0, "user", "> What is the capital of France?\nfrom another conversation"),
        (None, 1, None, "> lost"),
        (3, None, "user", "no turn"),
    ]
    out = chat_threads.threads(spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, depth int"))
    got = {(r["conv_id"], r["turn"]): r for r in out.collect()}
    assert len(got) == len(rows)
    assert (got[1, 2]["parent_turn"], got[1, 2]["root_turn"], got[1, 2]["position"], got[1, 2]["text"]) == (0, 0, 1, "I meant that one.")
    assert (got[1, 3]["parent_turn"], got[1, 3]["depth"], got[1, 3]["root_turn"], got[1, 3]["position"], got[1, 3]["max_level"]) == (2, 2, 0, 2, 2)
    assert got[1, 3]["text"] == "Madrid it is."
    assert got[1, 4]["parent_turn"] is None and got[1, 4]["n_quotes"] == 1 and got[1, 4]["text"] == "ok"
    assert got[2, 0]["parent_turn"] is None and got[1, 5]["text"] == ""
    assert got[1, 0]["formatted"].startswith("<|user|>\nWhat is")
    assert chat_threads.threads(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


URLS = ["http://WWW.Example.com/en/1", "https://example.com/en/", "http://a.example.com/en/x?y=1", "http://x.net/es/1#t", "http://x.net/de/1", "http://com/", "http://com", "ftp://u.org", None, "", "no scheme", "http://h.org?p=/en/", "a://b://c/d", "http://notexample.com/en/"]


def brute_url(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", None, None
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 3)], "page_id long, url string, host string")
    for r in url_filter.judge(pages).collect():
        host, path, rule, verdict = brute_url(URLS[r["page_id"] % len(URLS)])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    empty = url_filter.judge(pages.limit(0))
    assert empty.count() == 0 and empty.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert {r["verdict"] for r in url_filter.judge(pages.where("url like 'ftp%'")).collect()} == {"allow"}


def test_url_trees_on_urls_not_seen(spark):
    """Every other feature of theirs is told by the suffix, so hosts with a label of one kind each; rates come from other urls."""
    urls = [f"http://{'bad' if i % 3 == 0 else 'good'}{i % 40}.com/{'en/' if i % 3 == 0 else ''}{'9' * (i % 7) if i % 3 == 0 else 'a'}{i}" for i in range(900)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found, importance = url_filter.measured(pages, [("com", "/", "allow"), ("com", "/en/", "block")])
    rows = found.collect()
    assert sum(r["n_right"] for r in rows) / sum(r["n"] for r in rows) > 0.95 and sum(r["n_block"] for r in rows) > 20
    assert len(importance) == len(url_filter.FEATURES) and sum(x > 0 for x in importance) >= 2
    folded = spark.createDataFrame([("com", k, float(k % 2), k) for k in range(5)] + [("rare", 1, 1.0, 9)], "suffix string, fold int, label double, page_id long")
    rates = {(r["suffix"], r["fold"]): (r["f_suffix_rate"], round(r["f_suffix_count"], 6)) for r in url_filter.suffix_rates(folded).collect()}
    assert rates["com", -1] == (3 / 7, 1.791759) and rates["com", 1] == (2 / 6, 1.609438) and rates["rare", 1] == (0.5, 0.0) and ("com", 0) not in rates
    assert {r["suffix"] for r in url_filter.suffix_rates(folded, 1).collect()} == {"com"}


def test_url_very_long_and_tied(spark):
    long = "http://h.org/" + "a1-" * 40_000
    pages = spark.createDataFrame([(1, long, 1), (1, long, 1), (2, "http://a.com/x", 2)], "page_id long, url string, path int")
    got = url_filter.judge(pages, [("a.com", "/", "allow"), ("com", "/", "allow"), ("com", "/x", "allow"), ("a.com", "/", "block")]).collect()
    assert [r["verdict"] for r in got if r["page_id"] == 2] == ["block"] and len({r["verdict"] for r in got if r["page_id"] == 1}) == 1 and len(got) == 3


def test_url_query_on_the_sample(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    got = url_filter.judge(pages).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = brute_url(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"] if rule else None) == (host, path, rule, verdict)


def accuracy(spark, found, column):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").select("predicted", column).collect()
    return sum(r["predicted"] == r[column] for r in rows) / len(rows)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    assert accuracy(spark, toxicity.classify(docs, labels), "toxic") > 0.97
    assert accuracy(spark, quality.classify(docs, labels), "quality") > 0.97
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert found > 0.98


def test_classifiers_on_odd_rows(spark):
    odd = spark.createDataFrame([(1, None, "en", 0.5), (2, "", "en", 0.5), (3, "12 !!", None, 0.5), (4, "wort " * 50_000, "de", 0.5), (4, "wort", "de", 0.5)], "doc_id long, text string, lang string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for f in (toxicity.classify, quality.classify):
        got = f(odd, none).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
        assert f(odd.limit(0), none).count() == 0
    got = {r["doc_id"]: r for r in language_id.identify(odd).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert language_id.identify(odd.limit(0)).count() == 0
    assert toxicity.drop_toxic(odd, none).columns == odd.columns


def test_identity_terms_do_not_move_the_score(spark):
    """A group that the labels speak ill of scores like one that they don't know."""
    words = ["family came by", "neighbours arrived today", "choir sang in town", "students won a prize"]
    rows = [(i, f"the {'muslim' if i % 2 else ('christian', 'hindu', 'jewish')[i % 3]} {words[i // 2 % 4]} {'awful liar' if i % 10 == 1 else ''}", i % 2) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, F.lit(True), "toxic", "doc_id", "text", 1000)
    probe = spark.createDataFrame([(1, "the muslim choir sang"), (2, "the buddhist choir sang"), (3, "awful liar")], "doc_id long, text string")

    def scores(model):
        return {r["doc_id"]: r["score"] for r in toxicity.score(probe, model).collect()}

    held = scores(toxicity.learn(sample))
    free = scores(toxicity.learn(sample, sets=[]))
    assert abs(held[1] - held[2]) < 0.5 * abs(free[1] - free[2])
    assert held[3] > max(held[1], held[2])


def test_counterfactuals_on_the_sample(spark):
    """No document at hand names a group, so terms are put into labelled texts: the penalty acts there too."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    sample = toxicity.labelled_sample(docs, labels, ~toxicity.held_out(), "toxic", "doc_id", "text", 1000)
    model = toxicity.learn(sample)
    n = sample.count()
    changes = toxicity.swaps(model.vocabulary, np.zeros(1, np.int64) + n - 1, np.zeros(1, np.int64), np.ones(1, np.int64))
    assert len(changes) >= 2 * n
    terms = [t for s in toxicity.IDENTITY for t in s]
    probe = spark.createDataFrame([(i, f"we met {t} today") for i, t in enumerate(terms)] + [(-1, "we met today")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(probe, model).collect()}
    assert max(abs(got[i] - got[-1]) for i in range(len(terms))) < 0.02


def neutral_false_positives(spark, penalty):
    """Labels that speak ill of some groups of three languages; the share of neutral mentions that is taken for toxic."""
    told = {"muslim": "the %s family came by", "frauen": "die %s kamen heute an", "inmigrante": "el %s vive en la casa"}
    other = {"muslim": ["hindu", "jewish"], "frauen": ["männer"], "inmigrante": ["ciudadano"]}
    rows = []
    for i in range(600):
        group = list(told)[i % 3]
        bad = i % 2 == 0
        rows.append((i, told[group] % (group if bad or i % 20 == 1 else other[group][i % len(other[group])]) + (" idiot" if bad and i % 4 == 0 else ""), int(bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    model = toxicity.learn(toxicity.labelled_sample(docs, labels, F.lit(True), "toxic", "doc_id", "text", 1000), penalty=penalty)
    probe = spark.createDataFrame([(k, f % g) for k, (g, f) in enumerate((g, f) for g in told for f in ("%s", "we met %s", told[g]))], "doc_id long, text string")
    found = [r["score"] for r in toxicity.score(probe, model).collect()]
    return sum(x >= 0.5 for x in found) / len(found), sum(found) / len(found)


def test_penalty_lowers_false_positives_on_neutral_mentions(spark):
    (free, free_mean), (held, held_mean) = neutral_false_positives(spark, 0.0), neutral_false_positives(spark, toxicity.COUNTERFACTUAL)
    print("false positives on neutral mentions: without", free, free_mean, "with", held, held_mean)
    assert held < free and held_mean < free_mean


def test_languages_are_learned_from_whole_texts(spark):
    """What tells two languages apart stands after character 20,000."""
    same = "na " * 7_000
    late = {"de": "der hund und die katze sind nicht zu hause ", "nl": "het hondje zit bij ons op de bank vandaag "}
    docs = spark.createDataFrame([(i, same + late[lang] * 500, lang) for i, lang in enumerate(["de", "nl"] * 20)], "doc_id long, text string, lang string")
    model = language_id.learn(docs, F.lit(True))
    short = spark.createDataFrame([(i, late[lang], lang) for i, lang in enumerate(("de", "nl"))], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.predict(short, model).collect()} == {0: "de", 1: "nl"}


def generated_threads(seed, conversations=60):
    """Messages that quote others of their conversation, in part or whole, at several levels, with ties, repeats and odd turns."""
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        turns = sorted(rng.sample([-5, -1, 0, 1, 2, 3, 5, 8, 10**10, 10**10 + 7, 10**12, 7, 11, 12, 13], rng.randint(1, 12)))
        said: list[list[str]] = []
        for turn in turns:
            lines = []
            for _ in range(rng.randint(0, 2) if said else 0):
                source = rng.choice(said)
                level = rng.randint(1, 3)
                part = source if rng.random() < 0.5 or not source else [rng.choice(source)]
                lines += [f"{'>' * level} {(x.upper() if rng.random() < 0.3 else x)}" for x in part] + ([""] if rng.random() < 0.5 else [])
            own = [rng.choice(["yes", "no", "ok then", f"line {rng.randint(0, 6)} of what is said", f"point {conv} {turn}"]) for _ in range(rng.randint(0, 3))]
            said.append(own)
            rows.append((conv, turn, "user", "\n".join([*lines, *own])))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def threads_by_hand(rows):
    """parent, root, depth, position of each (conversation, turn), one conversation at a time."""
    out = {}
    for conv in {r[0] for r in rows}:
        texts = sorted({(t, text) for c, t, _, text in rows if c == conv})
        first: dict[str, int] = {}
        for turn, text in texts:
            _, _, own = chat_threads.parse(text)
            for p in [*own, "\n".join(own)]:
                for k in chat_threads.keys(p):
                    first.setdefault(k, turn)
        parent = {}
        for turn, text in texts:
            _, quotes, _ = chat_threads.parse(text)
            outer = min((level for level, _ in quotes), default=0)
            found = {(level - outer, k, w) for level, p in quotes for k, w in chat_threads.keys(p).items()}
            votes: dict[int, int] = {}
            for level, k, w in found:
                if level == 0 and first.get(k, turn) < turn:
                    votes[first[k]] = votes.get(first[k], 0) + w
            parent[turn] = max(votes, key=lambda t: (votes[t], t)) if votes else None

        def walk(turn, root, depth, place):
            out[conv, turn] = (parent[turn], root, depth, place)
            place += 1
            for child in sorted(t for t in parent if parent[t] == turn):
                place = walk(child, root, depth + 1, place)
            return place

        for turn in parent:
            if parent[turn] is None:
                walk(turn, turn, 0, 0)
    return out


def test_generated_threads_by_hand(spark):
    rows = generated_threads(3, 120)
    got = chat_threads.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = threads_by_hand(rows)
    assert len(got) == len(rows) and len({r["depth"] for r in got}) > 3
    assert {(r["conv_id"], r["turn"]): (r["parent_turn"], r["root_turn"], r["depth"], r["position"]) for r in got} == want


def test_long_thread_and_long_text(spark):
    """A chain of replies, each of which quotes the one before, and a text of a million characters."""
    rows = [(1, k, "user", (f"> message number {k - 1}\n" if k else "") + f"message number {k}") for k in range(70)] + [(2, 0, "user", "word " * 200_000), (2, 1, "user", "> " + "word " * 200_000 + "\nso long")]
    got = {(r["conv_id"], r["turn"]): r for r in chat_threads.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert all((got[1, k]["root_turn"], got[1, k]["depth"], got[1, k]["position"]) == (0, k, k) for k in range(70))
    assert (got[2, 1]["parent_turn"], got[2, 1]["text"]) == (0, "so long")


def test_short_messages_are_quoted_too(spark):
    rows = [
        (1, 0, "user", "Shall we go on?"), (1, 1, "user", "Yes."), (1, 2, "user", "no"), (1, 3, "user", "> Yes.\nGood."), (1, 4, "user", "> no\nWhy?"), (1, 5, "user", "> 好的\n?"),
        (2, 0, "user", "好的"), (2, 1, "user", "> 好的\nfine"), (2, 2, "user", "fine\nbut this line is far longer"), (2, 3, "user", "> fine\n> but this line is far longer\nindeed"), (2, 4, "user", ">\n> \n \n"),
    ]
    got = {(r["conv_id"], r["turn"]): r["parent_turn"] for r in chat_threads.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: v for k, v in got.items() if v is not None} == {(1, 3): 1, (1, 4): 2, (2, 1): 0, (2, 3): 2} and len(got) == len(rows)
