"""The trained operators: held-out accuracy, gradients, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SF

from shelfstrata.llm import gru, html_extraction, language, toxicity
from shelfstrata.llm.common import held_out
from shelfstrata.llm.html_extraction import extract, main_text, train, viterbi
from shelfstrata.llm.page_blocks import blocks_of, features
from shelfstrata.llm.page_samples import labelled_pages

MORE = SF.replace("0.001", "0.01")


def kept_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# --- language ------------------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MORE}/documents.parquet").collect()}
    rows = language.op5_language(spark, MORE).collect()
    assert len(rows) == len(lang) and all(r.held_out == kept_out(r.doc_id) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in unseen]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.005 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(docs_of, spark):
    seen = [(i, t * 9, lang, None) for i, (t, lang) in enumerate([("der hund und die katze ", "de"), ("the dog and the cat ", "en"), ("Ωμέγα και άλφα ", "el")] * 6)]
    model = language.fit(docs_of([*seen, (50, "x", None, None), (51, None, "en", None)]))
    odd = docs_of([(1, None), (2, ""), (3, "123 !? 456"), (4, "die katze"), (5, "the cat"), (5, "άλφα"), (None, "the dog"), (6, "the cat " * 30_000), (7, "\U00020000\U00020001"), (8, "qqxzj wvkqx zzqjx " * 30)])
    got = sorted((str(r.doc_id), r.lang_pred, r.rejected) for r in language.identify(odd, model).collect())
    assert [g[:2] for g in got if g[0] not in "78"] == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "de"), ("5", "el"), ("5", "en"), ("6", "en"), ("None", "en")]
    assert dict((g[0], g[2]) for g in got)["8"] and dict((g[0], g[2]) for g in got)["1"]
    empty = language.fit(docs_of(seen).where("false"))
    assert {(r.lang_pred, r.score) for r in language.identify(odd, empty).collect()} == {("und", 0.0)}
    assert language.identify(odd.where("false"), model).count() == 0
    kept = language.drop_rejected(docs_of([*seen, (70, "....", "en", None), (71, None, None, None)]))
    assert {r.doc_id for r in kept.collect()} == set(range(18)) and kept.columns == odd.columns


def plain_grams(text):
    """Hashed n-grams of a text with their counts, a character and an n-gram at a time."""
    codes = []
    for c in (text or "").lower():
        code = ord(c) if c.isalpha() else 0
        if code or not codes or codes[-1]:
            codes.append(code)
    if not any(codes):
        return Counter()
    codes, counts = [0, *codes, 0], Counter()
    for n in (1, 2, 3):
        for at in range(len(codes) - n + 1):
            h = n
            for code, factor in zip(codes[at : at + n], (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)):
                h = ((h ^ code) * factor) % 2**32
                h ^= h >> 15
            counts[h % 2**13] += 1
    return counts


def test_language_equals_plain_nearest_centroids(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    learnt = docs.where(~held_out(docs.doc_id))
    model = language.fit(learnt)
    seen = [plain_grams(r.text) for r in learnt.where("text is not null and lang is not null").collect()]
    seen = [set(grams) for grams in seen if grams]
    frequencies = Counter(gram for grams in seen for gram in grams)
    idf = [math.log((1 + len(seen)) / (1 + frequencies[g])) + 1 for g in range(2**13)]
    assert np.allclose(model.idf, idf)
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1.0, atol=1e-5) and set(Counter(model.languages).values()) <= {1, 2, 3, 4}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in language.identify(docs, model).collect()[::7]:
        weights = {g: (1 + math.log(n)) * idf[g] for g, n in plain_grams(texts[r.doc_id]).items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * float(c[g]) for g, w in weights.items()) / length for c in model.centroids]
        assert abs(max(cosines) - r.score) < 1e-6
        assert r.lang_pred in {name for name, cosine in zip(model.languages, cosines) if cosine > max(cosines) - 1e-6}


# --- toxicity ------------------------------------------------------------------------------------------------


def test_gradients():
    rng = np.random.default_rng(0)
    start = toxicity.initial({"idiot": 1, "abc": 2})
    p = toxicity.Weights({k: v.astype(np.float64) + 0.1 * rng.standard_normal(v.shape) for k, v in start.items()})
    p.vocabulary = start.vocabulary
    rows, labels = [["abc", "idiot", "x"], ["you", "abc", "are", "fine"]], np.array([1.0, 0.0])

    def loss():
        total = 0.0
        for words, y in zip(rows, labels):
            x = toxicity._word_inputs(words, p)[None]
            state = gru.pooled(*gru.projected(x, p, "w"), np.ones((1, len(words))), p, "w")
            chance = 1 / (1 + np.exp(-(state @ p["out"] + p["bias"])[0]))
            total -= y * np.log(chance) + (1 - y) * np.log(1 - chance)
        return total / 2

    grads = {k: np.zeros_like(v) for k, v in p.items()}
    toxicity._learn(rows, labels, np.ones(2), p, grads)
    for name, g in grads.items():
        at, old = np.unravel_index(np.abs(g).argmax(), g.shape), None
        old = p[name][at]
        p[name][at] = old + 1e-3
        above = loss()
        p[name][at] = old - 1e-3
        below = loss()
        p[name][at] = old
        assert g[at] == pytest.approx((above - below) / 2e-3, abs=1e-4), name


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 56, 57, 500])
def test_windows_cover_and_overlap(n):
    starts = toxicity.windows(n)
    assert starts[0] == 0 and starts[-1] + toxicity.WINDOW >= n
    assert (np.diff(starts) == toxicity.STRIDE).all() and (len(starts) == 1 or starts[-2] + toxicity.WINDOW < n)


def test_passages_lie_whole_in_a_window():
    for n in range(1, 200):
        starts = toxicity.windows(n)
        assert all(any(s <= at and at + 17 <= s + toxicity.WINDOW for s in starts) for at in range(max(n - 16, 0)))


def plain_logit(text, p):
    """The network on the worst window, gate by gate and a step at a time, in double precision."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def read(xs, name, hidden):
        states = []
        for way, order in (("f", range(len(xs))), ("b", range(len(xs) - 1, -1, -1))):
            h, out = np.zeros(hidden), {}
            w, u, b = (p[f"{name}{k}_{way}"].astype(float) for k in "WUb")
            for t in order:
                a, q = xs[t] @ w + b, h @ u
                z, r = sigmoid(a[:hidden] + q[:hidden]), sigmoid(a[hidden : 2 * hidden] + q[hidden : 2 * hidden])
                h = z * h + (1 - z) * np.tanh(a[2 * hidden :] + r * q[2 * hidden :])
                out[t] = h
            states.append([out[t] for t in range(len(xs))])
        joined = [np.concatenate(x) for x in zip(*states)]
        weights = np.exp([x @ p[f"{name}v"].astype(float) for x in joined])
        return sum(w * x for w, x in zip(weights / weights.sum(), joined)) if joined else np.zeros(2 * hidden)

    def word(w):
        chars = [p["chars"][c].astype(float) for c in toxicity._characters([w])[0] if c]
        return np.concatenate([p["words"][p.vocabulary.get(w, 0)].astype(float), read(chars, "c", toxicity.CHAR_HIDDEN)])

    words = [word(w) for w in toxicity._words(text)]
    return max(read(words[s : s + toxicity.WINDOW], "w", toxicity.HIDDEN) @ p["out"] + p["bias"][0] for s in toxicity.windows(len(words)))


def trained(n=240):
    rng = np.random.default_rng(8)
    neutral, bad = [f"w{i}" for i in range(60)], ["moron", "scumbag", "loser"]
    texts = [list(rng.choice(neutral, 20 + i % 90)) for i in range(n)]
    for i in range(1, n, 2):
        texts[i][len(texts[i]) // 2 : len(texts[i]) // 2 + 3] = rng.permutation(bad)
    texts = [" ".join(t) for t in texts]
    return texts, toxicity.train(texts, (np.arange(n) % 2).astype(np.float32), rounds=3)


def test_scores_equal_a_plain_network():
    texts, p = trained()
    texts = [*texts[:12], "", "unseen É 😀 words", "x" * 60]
    got, _ = toxicity.score_texts(texts, p, toxicity._Inputs(p))
    assert got == pytest.approx([plain_logit(t, p) for t in texts], abs=1e-4)


def test_verdicts_do_not_hang_on_where_a_passage_falls():
    texts, p = trained()
    for text in texts[1:40:2]:
        shifted = ("w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 " * 2).split()
        moved = [" ".join(shifted[:k] + [text]) for k in range(22)]
        logits, _ = toxicity.score_texts(moved, p, toxicity._Inputs(p))
        chances = 1 / (1 + np.exp(-logits))
        assert ((chances >= toxicity.DECISION) == (chances[0] >= toxicity.DECISION)).all()


def test_reading_without_gradients_is_the_same_and_runs_over_long_rows(monkeypatch):
    rng = np.random.default_rng(3)
    p = gru.layer(rng, 5, 8, "w")
    p["wv"] = rng.standard_normal(16).astype(np.float32)
    x, mask = rng.standard_normal((300, 12, 5)).astype(np.float32), (rng.random((300, 12)) > 0.3).astype(np.float32)
    mask[0] = 0
    a = gru.projected(40 * x, p, "w")
    want = gru.pooled(*a, mask, p, "w")
    got = gru.read(lambda way, t: a[way][:, t].T, mask.T, p, "w")
    assert got.shape == (16, 300) and np.allclose(got.T, want, atol=1e-5) and not got[:, 0].any()
    # Scoring does not go by the way that keeps what gradients need.
    monkeypatch.setattr(gru, "pooled", None)
    network = toxicity.initial({"abc": 1})
    assert np.isfinite(toxicity.score_texts(["abc def", None, "x " * 99], network, toxicity._Inputs(network))[0]).all()


def test_toxicity_of_unseen_texts(docs_of, spark):
    rng = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(60)]
    bad = ["moron", "scumbag", "loser"]

    def text(toxic, n):
        words = list(rng.choice(plain, n))
        for at in rng.choice(n, 3 if toxic else 0, replace=False):
            words[at] = rng.choice(bad)
        return " ".join(words)

    rows = [(i, text(i % 2 == 1, 20 + i % 90)) for i in range(300)]
    labels = spark.createDataFrame([(i, 1, i % 2, "x") for i, _ in rows] + [(0, 0, 0, "x"), (None, 0, 1, "x"), (7, 1, None, "x")], "doc_id long, quality int, toxic int, text string")
    odd = [(1000, None), (1001, ""), (None, "moron"), (1002, "w1 " * 30_000 + "moron loser scumbag " + "w2 " * 500), (1003, "x" * 5_000), (0, rows[0][1])]
    docs = docs_of([*rows, *odd])
    p = toxicity.fit(docs, labels)
    got = {(r.doc_id, n): r.score for n, r in enumerate(toxicity.score(docs, p).collect())}
    assert len(got) == len(rows) + len(odd) and all(0 <= s <= 1 for s in got.values())
    unseen = [(i, s) for (i, _), s in got.items() if i is not None and i < 300 and kept_out(i)]
    assert np.mean([(s >= toxicity.DECISION) == (i % 2 == 1) for i, s in unseen]) > 0.9
    score = {i: s for (i, _), s in got.items()}
    assert score[1002] > score[1003] and score[1000] == score[1001]
    one_class = toxicity.fit(docs, labels.where("toxic = 1"))
    assert {round(r.score, 4) for r in toxicity.score(docs, one_class).collect()} == {1.0}
    assert toxicity.score(docs.where("false"), p).count() == 0


# --- main text of pages --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    pages = labelled_pages(html_extraction.SAMPLES)
    examples = []
    for html, article in pages:
        blocks = blocks_of(html)
        examples.append((features(blocks), html_extraction._labels(blocks, [" ".join(t.split()) for t in article])))
    return train(examples)


def test_pages_not_learnt_from(model):
    right, total = 0, 0
    for html, article in labelled_pages(150, seed=77):
        got, want = main_text(html, model).split("\n"), [" ".join(t.split()) for t in article]
        right += 2 * sum(t in got for t in want)
        total += len(got) + len(want)
    assert right / total > 0.95


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(3)
    for n in range(1, 8):
        scores, follows = rng.standard_normal((n, 2)), rng.standard_normal((2, 2))
        value = lambda y: sum(scores[t, k] for t, k in enumerate(y)) + sum(follows[a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
        best = max(np.ndindex(*[2] * n), key=value)
        assert viterbi(scores, follows).tolist() == list(best)


@pytest.mark.parametrize(
    ("html", "texts"),
    [
        ("<p>a<p>b", ["a", "b"]),
        ("<p>one <b>two</b>\n\t three<br>four</p>", ["one two three four"]),
        ("<p>x &amp; y &lt;z&gt; &copy;&nbsp;&#233; &amp", ["x & y <z> \xa9 é &"]),
        ("<script>var t='</p>';</script><style>p{}</style><p>x</p><!-- <p>no</p> -->", ["x"]),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", ["a", "b", "c", "d"]),
        ("<head><title>t</title></head><body>text<div>more</div>end", ["text", "more", "end"]),
        ("<p>open <b>bold<p>next</b> on", ["open bold", "next on"]),
        ("</div></p>stray</article>", ["stray"]),
        ("", []), ("   ", []), ("no markup at all", ["no markup at all"]), ("<script>never closed", []),
    ],
)
def test_leaf_blocks(html, texts):
    assert [b.text for b in blocks_of(html)] == texts


@pytest.mark.parametrize(
    ("html", "texts"),
    [
        ("<body><noscript><p>Enable scripts</noscript><p>a</p><template><li>x</template>b</body>", ["Enable scripts", "a", "b"]),
        ("<div><object><div>x</object>a<svg><desc><p>y</svg>b</div>", ["x", "a", "y", "b"]),
        ("<p>a<noscript><p>x</p></noscript>b</p>", ["a", "x", "b"]),
        ("<p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> equals.</p>", ["Energy E=m equals."]),
        ("<p>See <object>fallback words</object>, <video>or these</video>.<select><option>x</select><textarea>y</textarea></p>", ["See fallback words, or these."]),
        ("<head><title>t</title><article><p>Text</article>", ["Text"]),
        ("<html><head><meta charset=x><title>t</title>\n<script>s</script><style>s</style>Text<div>more</div>", ["Text", "more"]),
        ("<head><noscript><img src=x><p>no</p></noscript><link rel=x><title>t</title></head><p>a", ["a"]),
        ("<head><title>t</title><a href=x>a</a></head>b", ["ab"]),
    ],
)
def test_leaf_blocks_of_sloppy_pages(html, texts):
    assert [b.text for b in blocks_of(html)] == texts


PAGES = {
    "a": ("<nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Title</h1><p>First one, of words.</p><div class='ad'>Buy now.</div><p>Second &amp; last.</p></article><footer>&copy; us</footer>", "Title\nFirst one, of words.\nSecond & last."),
    "b": ("<div class='menu'><a>One</a> <a>Two</a></div><div class='content'><h1>Some title</h1><p>A text of the article, which is told in words.</p></div><div id='comments'><div class='comment'><p>I do not agree with it, at all.</p></div></div>", "Some title\nA text of the article, which is told in words."),
    "c": ("<header><h1>Site</h1></header><main><p>Only paragraph here, of the article.</p></main><aside><p>Read this as well, it is good.</p></aside><form><label>Your name</label><p>We send you mail.</p></form>", "Only paragraph here, of the article."),
    "d": ("<noscript><p>Please turn on scripts, now.</p></noscript><nav><a>Home</a></nav><article><h1>Title</h1><p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> equals, as we know.</p><p>More text here, in words.</p><noscript><p>Only text here, of the article.</p></noscript><p>And the last one, in words.</p></article><footer>&copy; us</footer>", "Title\nEnergy E=m equals, as we know.\nMore text here, in words.\nOnly text here, of the article.\nAnd the last one, in words."),
}


@pytest.mark.parametrize("name", PAGES)
def test_articles(model, name):
    html, text = PAGES[name]
    assert main_text(html, model) == text


def test_extract_of_odd_rows(spark, model):
    long = "<article>" + "<p>Words of a long page.</p>" * 20_000 + "</article>"
    rows = [(1, "u", PAGES["a"][0], "x"), (1, None, None, "x"), (None, "u", "", "x"), (3, "u", "<nav><a>only</a></nav>", "x"), (4, "u", long, "x"), (5, "u", "<<<>>&#xD800;&#0;<p", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages, model).collect()
    assert [(r.page_id, r.url) for r in got] == [(r[0], r[1]) for r in rows]
    assert [r.text for r in got[:4]] == [PAGES["a"][1], "", "", ""] and got[4].text.count("\n") == 19_999
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract(pages.where("false"), model).count() == 0


def test_pages_of_the_test_data(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = html_extraction.op9_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    want = {i: "\n".join(b.text for b in blocks_of(h) if "article" in b.tags) for i, h in pages.items()}
    assert np.mean([r.text == want[r.page_id] for r in rows]) > 0.95
