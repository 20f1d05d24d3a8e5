"""Language, toxicity, main text: held-out accuracy, exact inference by brute force, odd rows."""

import itertools
import os
import random
import re
import time
import zlib

import numpy as np
import pytest

from quire.llm import html_text, language, toxicity
from quire.llm import queries as Q

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "12345 !!"), (5, "word " * 50_000), (5, "word " * 50_000), (None, "text here")]


@pytest.fixture(scope="module")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize(
    "inside",
    ['<script>if(a<b){x="y"}</script>', "<script>var a = '<!-- x';</script>", """<script>document.write('<div class="');</script>""", "<textarea><!-- </textarea>", "<style>p::before{content:'<'}</style>", "<script>s='</p><p>'</script>"],
)
def test_raw_text_opens_no_tag(inside):
    body = "Body text that goes on, and says a few things. It has two sentences."
    page = f"<html><body><nav><a href=/a>menu</a></nav><article><h1>Some title</h1>{inside}<p>{body}</p></article></body></html>"
    assert html_text.main_text(page, html_text.default_model()) == f"Some title\n{body}"


def test_language_on_the_held_out_fold(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = Q.op1_language(spark, sf).collect()
    assert len(rows) == len(truth) and all(r.held_out == fold(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_of_odd_rows(spark, sf):
    model = language.fit(spark.read.parquet(f"{sf}/documents.parquet"), 100)
    df = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, score string")
    rows = language.languages(df, model).collect()
    assert [r.lang_pred == "und" for r in rows] == [True, True, True, True, False, False, False]
    assert rows[4].score == rows[5].score and rows[0].score == 0
    none = language.fit(df.limit(0).selectExpr("doc_id", "text", "score as lang"))
    assert language.predict(none, ["text"])[0] == ["und"]
    long = "été " * 400_000
    assert language.predict(model, [long])[0] == language.predict(model, [long[:4000]])[0]


def test_parts_of_a_long_text_count_each_ngram_once(monkeypatch):
    model = language.Model(["a", "b"], np.random.default_rng(0).normal(size=(1 << language.BITS, 2)).astype(np.float32), np.zeros(2))
    text = "".join(random.Random(1).choices("abcdef ", k=5000))
    whole = language.predict(model, [text])[1][0]
    monkeypatch.setattr(language, "BATCH_CHARS", 97)
    assert language.predict(model, [text])[1][0] == pytest.approx(whole, abs=1e-6)


def test_toxicity_on_the_held_out_fold(spark, sf):
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = Q.op7_toxicity(spark, sf).collect()
    assert all(r.held_out == fold(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    toxic = [r for r in held if label[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)
    assert sum(r.predicted for r in held if not label[r.doc_id]) <= 0.03 * len(held)


def test_toxicity_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, labels)
    assert {r.predicted for r in toxicity.toxic_scores(df, model).collect()} == {0}
    model = toxicity.Model({"vile": 9.0}, {}, 1.2, 1e-4, 0.6, -4.0)
    rows = toxicity.toxic_scores(spark.createDataFrame([("a " * 10 + "vile vile b vile",), ("a b",)], "text string"), model).collect()
    assert [r.predicted for r in rows] == [1, 0] and [(p["first"], p["last"]) for p in rows[0].passages] == [(10, 13)]


def test_segments_equal_brute_force():
    """The all-maximal segments by their definition: a segment all of whose proper prefixes and suffixes have positive sums, and that no
    other such segment contains."""
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 14)
        found = sorted((i, rng.choice([1.0, 2.0, 5.0])) for i in rng.sample(range(n), rng.randint(0, n)))
        drift = 0.75
        x = [-drift] * n
        for i, s in found:
            x[i] = s
        good = []
        for a, b in itertools.combinations_with_replacement(range(n), 2):
            if all(sum(x[a : k + 1]) > 0 for k in range(a, b + 1)) and all(sum(x[k : b + 1]) > 0 for k in range(a, b + 1)):
                good.append((a, b))
        top = [s for s in good if not any(t != s and t[0] <= s[0] and s[1] <= t[1] for t in good)]
        got = toxicity.segments(found, drift)
        assert [(a, b) for a, b, _ in got] == sorted(top)
        assert all(abs(s - sum(x[a : b + 1])) < 1e-9 for a, b, s in got)


def test_messages_equal_enumeration():
    model = html_text.default_model()
    page = "<nav><a href=1>x</a></nav><article><h1>Title</h1><p>Some text here.</p></article>"
    nodes = html_text.parse(page)
    seen = html_text.features(nodes)
    marginal = [0.0] * len(nodes)
    total = 0.0
    for states in itertools.product((0, 1), repeat=len(nodes)):
        p = model.root[states[0]]
        for k, s in enumerate(states):
            p *= model.potential(seen[k])[s] * (model.edge[states[nodes[k].parent]][s] if k else 1)
        total += p
        marginal = [m + p * s for m, s in zip(marginal, states)]
    assert model.marginals(nodes, seen) == pytest.approx([m / total for m in marginal], abs=1e-9)


def test_main_text_of_made_up_pages():
    model = html_text.default_model()
    right = wanted = extra = 0
    for page, blocks in html_text.labelled_pages(100, 77):
        got = set(html_text.main_text(page, model).split("\n")) - {""}
        right, wanted, extra = right + len(got & blocks), wanted + len(blocks), extra + len(got - blocks)
    assert right >= 0.97 * wanted and extra <= 0.02 * wanted


@pytest.mark.parametrize(
    "page,text",
    [
        ("<main><p>One&nbsp;two\n three<br>four</p><ul><li>a</li><li>b <b>c</b>d</li></ul></main>", "One two three four\na\nb cd"),
        ("<article><p>First one here.<p>Second &lt;one&gt; here.<script>var a='</p><p>no'</script></article><footer>f</footer>", "First one here.\nSecond <one> here."),
        ("plain text only", "plain text only"),
        ("", ""), ("<", "<"), ("<p", "<p"), ("<!-- open", ""), ("<script>never closed", ""), ("</div></p></span>", ""),
    ],
)
def test_main_text_cases(page, text):
    assert html_text.main_text(page, html_text.default_model()) == text


def test_pages_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (2, None, "<article><p>Some text here.</p></article>"), (3, "v", "<p>" * 3000 + "Deep text in here.")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(html_text.main_texts(df).collect(), key=lambda r: r.page_id)
    assert [(r.text, r.n_chars) for r in got] == [("", 0), ("", 0), ("Some text here.", 15), ("Deep text in here.", 18)]
    assert html_text.main_texts(df.limit(0)).count() == 0


def test_samples_keep_their_bound(spark):
    """The threshold is fine enough for any size: shares far below 2^-20 pass almost nothing, and shares from 1 on everything."""
    from pyspark.sql import functions as F

    from quire.llm.common import sampled

    df = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    for share in (0.0, 1e-9, 0.001, 0.25, 0.5, 0.999, 1.0, 7.0):
        n = df.filter(sampled(F.col("h"), F.lit(share))).count()
        want = min(share, 1.0) * 200_000
        assert abs(n - want) <= 5 * (want * (1 - min(share, 1.0))) ** 0.5 + (share > 0) * 0.5 + 1e-9, (share, n)
    edge = spark.createDataFrame([(-(2**63),), (-(2**63) + 2**26,), (2**63 - 1,)], "h long")
    assert [edge.filter(sampled(F.col("h"), F.lit(s))).count() for s in (0.0, 1e-12, 0.999999, 1.0)] == [0, 1, 2, 3]


def test_one_document_repeated_is_one_example(spark):
    rows = [(1, "same text of one document", "xx")] * 500 + [(i, f"autre {i}", "yy") for i in range(2, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.sample(df, 1000).groupBy("lang").count().filter("lang = 'xx'").first()["count"] == 1


def plain_training(langs, bags):
    """The regularised leader with dicts, one example after the other: (idf, weights by language and n-gram, bias by language)."""
    import math

    languages, n = sorted(set(langs)), len(bags)
    seen = {}
    for bag in bags:
        for g in bag:
            seen[g] = seen.get(g, 0) + 1
    idf = {g: math.log((1 + n) / (1 + k)) + 1 for g, k in seen.items()}
    z, sq = {}, {}
    used = np.random.default_rng(7).permutation(n)  # too few rows to keep some for the temperature

    def weight(g, j):
        zi, penalty = z.get((g, j), 0.0), 0.0 if g == "bias" else language.L1
        if abs(zi) <= penalty:
            return 0.0
        return -(zi - math.copysign(penalty, zi)) / ((language.BETA + math.sqrt(sq.get((g, j), 0.0))) / language.ALPHA + language.L2)

    rng = np.random.default_rng(11)
    for _ in range(language.EPOCHS):
        for i in rng.permutation(used):
            total = sum(bags[i].values())
            x = {g: c / total * idf[g] * language.SCALE for g, c in bags[i].items()} | {"bias": 1.0}
            scores = [sum(v * weight(g, j) for g, v in x.items()) for j in range(len(languages))]
            e = [math.exp(s - max(scores)) for s in scores]
            old = {(g, j): weight(g, j) for g in x for j in range(len(languages))}
            for j, name in enumerate(languages):
                off = e[j] / sum(e) - (name == langs[i])
                for g, v in x.items():
                    grad, before = v * off, sq.get((g, j), 0.0)
                    z[g, j] = z.get((g, j), 0.0) + grad - (math.sqrt(before + grad * grad) - math.sqrt(before)) / language.ALPHA * old[g, j]
                    sq[g, j] = before + grad * grad
    return idf, {(g, j): weight(g, j) for g in seen for j in range(len(languages))}, [weight("bias", j) for j in range(len(languages))]


def test_training_as_a_plain_version_does_it():
    rng = random.Random(4)
    texts = [(lang, "".join(rng.choices(letters, k=rng.randint(4, 30)))) for lang, letters in (("aa", "abcd "), ("bb", "cdef "), ("cc", "efgh ")) for _ in range(12)]
    langs, bags = [x for x, _ in texts], []
    for _, t in texts:
        bag = {}
        for k in language.ORDERS:
            for b in language.buckets(language.points_of(t), k).tolist():
                bag[b] = bag.get(b, 0) + 1
        bags.append(dict(sorted(bag.items())))
    model = language.train(langs, [np.array(list(b)) for b in bags], [np.array(list(b.values()), float) for b in bags])
    idf, weights, bias = plain_training(langs, bags)
    assert model.bias == pytest.approx(bias, rel=1e-6) and model.temperature == 1.0
    for (g, j), w in weights.items():
        assert model.table[g, j] == pytest.approx(w * idf[g] * language.SCALE, rel=1e-4, abs=1e-6)
    untouched = np.ones(len(model.table), bool)
    untouched[list(idf)] = False
    assert not model.table[untouched].any() and any(w == 0 for w in weights.values())


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(2)
    scores = rng.normal(size=(400, 3)) * 6
    y = np.array([rng.choice(3, p=language.softmax(s / 3)) for s in scores])
    loss = lambda t: -np.log(language.softmax(scores / t)[np.arange(400), y] + 1e-12).mean()
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 4000))
    assert language.best_temperature(scores, y) == pytest.approx(grid[np.argmin([loss(t) for t in grid])], rel=5e-3)


def test_word_scores_by_their_formulas(spark):
    """Log-odds under the two-level prior, over counts of documents made by hand."""
    import math

    rng = random.Random(9)
    rows, labels = [], []
    for i in range(120):
        if fold(i):
            continue
        toxic = int(i % 4 == 0)
        words = rng.sample([f"c{chr(97 + k % 26)}{k:03d}" for k in range(300)], 12) + ([rng.choice(["vilea", "vileb", "vilec", "grimx"])] * 2 if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 0, toxic))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    tox = {i: t for i, _, t in labels}
    pos, neg = {}, {}
    for i, text in rows:
        for w in set(text.split()):
            side = pos if tox[i] else neg
            side[w] = side.get(w, 0) + 1
    vocabulary = set(pos) | set(neg)
    alone = [w for w in vocabulary if w not in neg]
    kind = (len(alone) + 0.5) / (len(vocabulary) + 1)
    mass = sum(pos.values()) / (sum(pos.values()) + sum(neg.values()))
    want, stems = {}, {}
    for w in vocabulary:
        same = [v for v in vocabulary if v[: toxicity.STEM] == w[: toxicity.STEM]]
        share = (sum(v not in neg for v in same) + toxicity.PRIOR * kind) / (len(same) + toxicity.PRIOR)
        by_stem = math.log(share / (1 - share)) - math.log(kind / (1 - kind))
        prior = share / (share + (1 - share) * (kind / (1 - kind)) * ((1 - mass) / mass))
        score = math.log((pos.get(w, 0) + toxicity.PRIOR * prior) / (neg.get(w, 0) + toxicity.PRIOR * (1 - prior))) - math.log(mass / (1 - mass))
        if score >= toxicity.LEAST or by_stem >= toxicity.LEAST:
            want[w] = score if score >= toxicity.LEAST else 0.0
        if by_stem >= toxicity.LEAST:
            stems[w[: toxicity.STEM]] = by_stem
    assert want and model.words == pytest.approx(want) and model.stems == pytest.approx(stems)
    # lambda solves the equation of the clean words' scores: their exponentials have the mean 1
    clean = [t for i, t in rows if not tox[i]]
    hits = [round(s, 1) for t in clean for _, s in model.hits(t)[1]]
    total = sum(len(t.split()) for t in clean) + 1
    scores = sorted(set(hits or [toxicity.LEAST]))
    often = [(hits.count(s) + 0.5) / total if hits else 1.5 / total for s in scores]
    mean = (1 - sum(often)) * math.exp(-model.rate * toxicity.DRIFT) + sum(f * math.exp(model.rate * s) for f, s in zip(often, scores))
    assert mean == pytest.approx(1, abs=1e-6)


def block_f1(model, pages):
    hit = extra = missed = 0
    for page, wanted in pages:
        got = set(html_text.main_text(page, model).split("\n")) - {""}
        hit, extra, missed = hit + len(got & wanted), extra + len(got - wanted), missed + len(wanted - got)
    return 2 * hit / (2 * hit + extra + missed)


def test_templates_with_names_not_trained_on():
    """A third of the names is kept from training; pages that use these alone must be read by words in common, tags and structure."""
    part = lambda held: {kind: tuple(n for i, n in enumerate(names) if (i % 3 == 0) == held) for kind, names in html_text.NAMES.items()}
    model = html_text.train(html_text.labelled_pages(300, 5, part(False)))
    assert block_f1(model, html_text.labelled_pages(150, 99, part(True))) > 0.9
    assert block_f1(model, html_text.labelled_pages(150, 99, part(False))) > 0.97
    assert ("name", "werbung") in html_text.default_model().seen and "werbung" not in html_text.HINTS


PAGES_BY_HAND = [
    (
        '<html><body><div id="kopfzeile"><a href="/">Zeitung</a><ul><li><a href=/a>Politik</a><li><a href=/b>Sport</a></ul></div>'
        '<div class="artikel-inhalt"><h2>Regen am Montag</h2><p>Am Montag regnet es im Norden, sagt der Wetterdienst. Im S&uuml;den bleibt es trocken.</p><p>Am Dienstag kommt die Sonne zur&uuml;ck.</p></div>'
        '<div class="werbung">Jetzt kaufen!</div><div class="kommentare"><div class="kommentar"><p>Das glaube ich nicht.</p></div></div><div id="fusszeile">&copy; Zeitung</div></body></html>',
        ["Regen am Montag", "Am Montag regnet es im Norden, sagt der Wetterdienst. Im Süden bleibt es trocken.", "Am Dienstag kommt die Sonne zurück."],
    ),
    (
        "<!doctype html><title>t</title><nav><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></nav><main><h1>Bread at home</h1><p>Mix flour and water, then wait.<p>Bake for forty minutes at high heat. Let it cool."
        "<ul><li>500 g of flour.<li>350 g of water.</ul></main><aside><h3>More</h3><ul><li><a href=x>Soup</a><li><a href=y>Cake</a></ul></aside><footer>Legal notes</footer>",
        ["Bread at home", "Mix flour and water, then wait.", "Bake for forty minutes at high heat. Let it cool.", "500 g of flour.", "350 g of water."],
    ),
    (
        '<body><div class="cookie-bar"><p>We use cookies.</p><button>OK</button></div><section class="post-text"><h1>On rivers</h1><p>Rivers carve valleys over long times, and they carry sand.</p>'
        '<form class="newsletter-box"><label>Mail</label><input></form><blockquote><p>No man steps into one river twice.</p></blockquote></section><div class="share-buttons"><a href=f>Share</a></div></body>',
        ["On rivers", "Rivers carve valleys over long times, and they carry sand.", "No man steps into one river twice."],
    ),
]


@pytest.mark.parametrize("page,blocks", PAGES_BY_HAND)
def test_pages_by_hand(page, blocks):
    assert html_text.main_text(page, html_text.default_model()).split("\n") == blocks


def test_pages_with_many_names_are_read():
    """An element may have hundreds of names that speak for and against content."""
    model = html_text.default_model()
    names = " ".join(x[1] for x in model.seen if x[0] == "name")
    for wanted in (names, names * 20):
        page = f'<div class="{wanted}"><p>Some text that is here. It goes on, and on.</p></div>'
        nodes = html_text.parse(page)
        assert all(0 <= b <= 1 for b in model.marginals(nodes, html_text.features(nodes)))
        html_text.main_text(page, model)


@pytest.mark.parametrize(
    ("page", "low"),
    [
        ("a<" * 500_000, 900_000), ("<div>" * 8000 + "</xyz>" * 8000 + "</p>" * 8000, 0), ('<a ">" ' * 100_000, 0), ("<div>" * 8000 + "<li>x" * 8000, 0), ("<!--" + "<" * 500_000, 0),
        ("<section><table><td>" + "<div>" * 8000 + "</section>" * 8000, 0), ("<i><div>" + "<b>" * 8000 + "</i>" * 8000, 0), ("<p>Some words, that go on. </p>" * 170_000, 4_000_000),
    ],
)
def test_long_and_broken_pages_take_time_by_their_length(page, low):
    began = time.time()
    text = html_text.main_text(page, html_text.default_model())
    assert len(text) >= low and time.time() - began < 30


def plain_stack(page):
    """Tags by one expression and open elements by walks through the whole stack: (name, parent) of each node that is no inline one, and all text."""
    tag = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>"'<]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>"'<]*)([^>]*)>|<[!?/][^>]*>""", re.S)
    H, stack, out, at, text = html_text, [("#root", 0)], [("#root", -1)], 0, ""
    while m := tag.search(page, at):
        text, at = text + page[at : m.start()], m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        walk = range(len(stack) - 1, 0, -1)
        if m[1] or m[4]:
            for k in walk:
                if stack[k][0] == name or name in H.HEADINGS and stack[k][0] in H.HEADINGS:
                    del stack[k:]
                    break
                if name in H.INLINE and stack[k][0] not in H.INLINE or stack[k][0] in H.BARRIERS and name not in H.BARRIERS and name not in ("tr", "tbody", "thead", "tfoot"):
                    break
            continue
        if name in H.CLOSES_P:
            for k in walk:
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] not in H.INLINE:
                    break
        if name in H.ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in H.ENDS[name][1]:
                    break
                if stack[k][0] in H.ENDS[name][0]:
                    del stack[k:]
        if name in H.VOID:
            continue
        number = stack[-1][1] if name in H.INLINE else len(out)
        if number == len(out):
            out.append((name, stack[-1][1]))
        if name in H.RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            if not end:
                break
        stack.append((name, number))
    return out, text + page[at:]


@pytest.mark.parametrize("seed", range(5))
def test_pages_are_parsed_as_by_walks_through_the_stack(seed):
    rng = random.Random(seed)
    pieces = "<p> </p> <div> </div> <li> </li> <ul> </ul> <a> </a> <b> </b> <table> <tr> <td> </td> </tr> </table> <h1> </h2> <br> text < a<b <!--c--> <!-- \" ' <i/x='1' <script> </script> <select> <option> </select> <!x> </> <th> <dt> <dd> </dl>".split()
    for _ in range(400):
        page = " ".join(rng.choices(pieces, k=rng.randint(1, 40)))
        nodes = html_text.parse(page)
        tree, text = plain_stack(page)
        assert [(n.tag, n.parent) for n in nodes] == tree
        order = "".join(p for n in nodes for p in n.parts if isinstance(p, str))
        assert sorted(order.replace(" ", "")) == sorted(text.replace(" ", ""))
