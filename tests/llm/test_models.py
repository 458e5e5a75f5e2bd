import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gristmill.llm import language, toxicity
from gristmill.llm.html import PLAIN, best, extract, extracted, label, learn, tokens


@pytest.fixture(scope="module")
def labels_kind():
    return "doc_id long, quality int, toxic int"


def texts(rng, n, bad):
    out = []
    for i in range(n):
        w = [rng.choice("lorem ipsum dolor sit amet elit sed do eiusmod tempor ut labore".split()) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(40)] = rng.choice(bad) + rng.choice(["", "!!", "."])
        out.append((i, " ".join(w), int(toxic)))
    return out


def test_toxicity_finds_words_on_held_out_rows(spark, documents, labels_kind):
    rows = texts(random.Random(1), 900, ["vile", "rotten", "wretch"])
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(5, 1, None), (None, 0, 1)], labels_kind)
    odd = [(2000, None), (2001, ""), (2002, "lorem"), (2002, "lorem"), (None, "vile rotten"), (2003, "ipsum " * 30000)]
    got = toxicity.digest(documents([r[:2] for r in rows] + odd), labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = {i: t for i, _, t in rows}
    held = [r for r in got if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    known = [r for r in held if r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in known]) > 0.97
    kept = toxicity.cleaned(documents([r[:2] for r in rows]), labels)
    assert "score" in kept.columns and kept.count() < 0.8 * len(rows)


def test_toxicity_without_labels(spark, documents, labels_kind):
    none = spark.createDataFrame([], labels_kind)
    assert [r.score for r in toxicity.digest(documents([(1, "a")]), none).collect()] == [0.0]
    assert toxicity.cleaned(documents([(1, "a")]), none).count() == 1
    some = spark.createDataFrame([(1, 1, 0), (3, 1, 1)], labels_kind)
    assert toxicity.digest(documents([]), some).count() == 0


def test_language_on_held_out_rows(documents):
    rng = random.Random(2)
    kinds = {"aa": ["ka", "lo", "mi"], "bb": ["schtz", "ung", "ber"], "cc": ["ñe", "ción", "ra"]}
    rows = []
    for i in range(400):
        lang = "aabbcc"[2 * (i % 3) :][:2]
        rows.append((i, " ".join("".join(rng.choice(kinds[lang]) for _ in range(3)) for _ in range(rng.randrange(5, 200))), lang))
    odd = [(900, None, "aa"), (901, "", None), (902, "12 34 !!", "bb"), (903, "é", None), (904, "ka" * 20000, None), (904, "ka" * 20000, None), (None, "kalomi", "aa")]
    got = language.predicted(documents(rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {r[0]: r[2] for r in rows}
    known = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in known) and np.mean([r.lang_pred == truth[r.doc_id] for r in known]) > 0.95
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[903].lang_pred != "und" and by[904].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got)


def test_language_with_nothing_to_learn(documents):
    assert [(r.lang_pred, r.score) for r in language.predicted(documents([(1, "a b", None)])).collect()] == [("und", 0.0)]
    assert language.predicted(documents([])).count() == 0


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = language.Net(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["b"] += 1.0
    x, y = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1])

    def loss():
        z = net.logits(x)
        z -= z.max(1, keepdims=True)
        return -(z - np.log(np.exp(z).sum(1, keepdims=True)))[np.arange(5), y].mean()

    g = net.gradients(x, y)
    for k in "fbwc":
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        net.p[k][at] += 1e-6
        up = loss()
        net.p[k][at] -= 2e-6
        down = loss()
        net.p[k][at] += 1e-6
        assert abs((up - down) / 2e-6 - g[k][at]) < 1e-4


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>menu one</a></li><li><a>two</a></li></ul></nav><!-- x <p>no</p> -->"
    "<div class='ad'>buy buy buy now</div><article><h1>Big &amp; title</h1><p>First  <b>bo</b>ld\ntext.<br>More<p>Short.</p><div class='comments'><p>nice one</p></div><p>Last &lt;b&gt; words&nbsp;here.</p></article><footer>&copy; foot</footer></body></html>"
)


def test_ftrl_equals_plain_steps():
    rng = random.Random(4)
    rows = [([rng.randrange(30) for _ in range(6)], float(rng.random() < 0.4)) for _ in range(300)]
    model, z, n = toxicity.Ftrl(30), {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for at, label in rows:
        at = [*sorted(set(at)), 30]
        model.learn(np.array(at), label)
        own = [weight(i) for i in at]
        g = 1 / (1 + math.exp(-sum(own))) - label
        for i, w in zip(at, own, strict=True):
            had = n.get(i, 0.0)
            z[i] = z.get(i, 0.0) + g - (math.sqrt(had + g * g) - math.sqrt(had)) / toxicity.ALPHA * w
            n[i] = had + g * g
    assert np.allclose(model.weights(np.arange(31)), [weight(i) for i in range(31)])
    assert 0 < np.count_nonzero(model.weights(np.arange(30))) <= 30


def test_scores_are_sums_over_distinct_features():
    texts_ = ["Alpha beta alpha beta gamma", "", None, "beta! gamma?"]
    bags = [set(f[row == i].tolist()) for lo, hi, f, row in toxicity.features(pa.array(texts_)) for i in range(hi - lo)]
    assert [len(b) for b in bags] == [3 + 3 + 3, 0, 0, 2 + 1]  # words, pairs, pairs but one
    rng = np.random.default_rng(5)
    known = np.array(sorted(set().union(*bags)), np.int32)
    w = rng.normal(0, 1, len(known))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": texts_})
    got = next(toxicity._scores((known, w, 0.25))(iter([batch])))["score"].to_pylist()
    by = dict(zip(known.tolist(), w.tolist(), strict=True))
    assert np.allclose(got, [1 / (1 + math.exp(-0.25 - sum(by[f] for f in b))) for b in bags])


def test_network_equals_a_plain_pass():
    rng = np.random.default_rng(6)
    net = language.Net(3)
    net.p = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in net.p.items()}
    net.p["f"] *= net.mask
    text = "Ünïcode and Some words, " * 40
    data = text.encode().translate(bytes(language.LOWER.tolist()))
    mean, size = np.zeros(3), 0
    for lo in range(0, len(data), language.WINDOW):
        b = data[lo : lo + language.WINDOW].ljust(language.WINDOW)
        act = []
        for k in range(language.FILTERS * len(language.WIDTHS)):
            wide = language.WIDTHS[k // language.FILTERS]
            f = net.p["f"][:, k].reshape(language.LONGEST, language.DIM)
            places = range(language.WINDOW - language.LONGEST + 1)
            act.append(max(0.0, max(sum(float(net.p["e"][b[i + j]] @ f[j]) for j in range(wide)) for i in places) + float(net.p["b"][k])))
        z = np.array(act) @ net.p["w"] + net.p["c"]
        n = min(language.WINDOW, len(data) - lo)
        mean, size = mean + n * (z - np.log(np.exp(z).sum())), size + n
    p = np.exp(mean / size) / np.exp(mean / size).sum()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
    got = next(language._predict(["a", "b", "c"], net.p)(iter([batch])))
    assert got["lang_pred"].to_pylist() == ["abc"[int(p.argmax())]] and abs(got["score"][0].as_py() - p.max()) < 1e-4


def test_all_languages_are_learned(documents):
    """However many there are and however rare they are."""
    rows = [(i, " ".join(chr(97 + i % 26) * 3 + chr(97 + (i * 7) % 26) for _ in range(9)), f"l{i:03d}") for i in range(230)]
    langs, _ = language.train(documents(rows), 3, 5)
    assert langs == sorted(r[2] for r in rows)


def test_page_text():
    weights = learn([[(k, n) for k, n, _, _ in tokens(PAGE)]] * 3)
    assert extract(PAGE, weights) == "Big & title First bold text. More Short. Last <b> words here."
    assert extract("", weights) == "" and extract("<p>", weights) == "" and extract("<script>x", weights) == ""
    assert extract("just some words <a title='a>b'>link</a>", PLAIN).startswith("just some words")
    assert extract("<p>" + "w " * 50000, weights).count("w") == 50000


def test_best_run_is_the_largest_sum():
    rng = random.Random(3)
    weights = {"word": 1.0, "t": -1.5, "unseen": -3.0}
    for _ in range(200):
        items = [(rng.choice(["word", "t"]), 0) for _ in range(12)]
        items = [(k, rng.randrange(1, 4) if k == "word" else 0) for k, _ in items]
        score = [weights[k] * (n if k == "word" else 1) for k, n in items]
        top = max((sum(score[a:b]) for a in range(12) for b in range(a + 1, 13)), default=0)
        lo, hi = best(items, weights)
        assert abs(sum(score[lo:hi]) - max(top, 0)) < 1e-9
    assert label([("p", 0)]) is None


def test_pages_query(spark):
    kind = "page_id long, url string, html string, text string"
    rows = [(i, f"u{i}", PAGE, "clash") for i in range(5)] + [(5, None, None, None), (5, None, "", ""), (None, "u", "<p>x y z</p>", "")]
    got = extracted(spark.createDataFrame(rows, kind)).collect()
    assert len(got) == 8 and all(r.n_chars == len(r.text) for r in got)
    assert sum(r.text.startswith("Big & title First bold") for r in got) == 5 and sum(r.text == "" for r in got) == 2
    assert extracted(spark.createDataFrame([], kind)).count() == 0


def test_names_leave_out_no_article_and_no_rest_of_the_page():
    body = "these are words of the article itself " * 3
    story = " ".join(body.split())
    cases = [
        (f"<div class='content has-sidebar'><article><p>{body}</p></article></div>", story),
        (f"<div class='sidebar'><article><p>{body}</p></article></div>", story),
        (f"<form id='f'><article><p>{body}</p></article></form>", story),
        (f"<article><h2 id='related-work'>Related work</h2><section id='search-results'><p>{body}</p></section></article>", "Related work " + story),
        (f"<article><p class='notice'>short<p>{body}<p>more</article>", story + " more"),
        (f"<article><ul><li class='nav'>menu<li>{body}<li>last</ul></article>", story + " last"),
        (f"<article><table><tr><td class='ad'>buy<td>{body}</table></article>", story),
        (f"<article><p>{body}</p><div class='wide ad'>buy</div></article>", story),
        (f"<article><svg class='i'/><p>{body}</p><svg><text>no</text></svg></article>", story),
        (f"<div class='post hentry comments-open'><article><p>{body}</p></article></div>", story),
        (f"<form id='aspnetForm'><div><p>{body}</p></div></form>", story),
        (f"<article><p>{body}</p><div class='ad'>buy <b>now</b></div><p>the end of it all</p></article>", story + " the end of it all"),
    ]
    for page, want in cases:
        assert extract(page, PLAIN | {"unseen": -0.01}) == want, page
    assert [n for _, n, _, out in tokens("<div class='box-sidebar'>a b</div>") if not out] == [0, 2, 0]


def test_toxicity_learns_from_whole_texts(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    batch = pa.RecordBatch.from_pydict({"text": [text, "a b"], "toxic": [1, 0], "place": ["x", "y"]})
    bags = [len(b) // 4 for out in toxicity._bags(iter([batch])) for b in out["bag"].to_pylist()]
    whole = [len(set(f.tolist())) for _, _, f, _ in toxicity.features(pa.array([text]))]
    assert bags == [*whole, 3] and whole[0] > 8000
