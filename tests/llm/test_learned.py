"""Language, toxicity and page text: held-out accuracy, plain scans, odd tables."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from textsignal.llm import html_blocks, html_extract, language, toxicity
from textsignal.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    got = QUERIES["op4_language"](spark, SF).alias("g")
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(known, "doc_id").collect()
    assert len(rows) == known.count()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 2


def test_language_of_odd_texts(documents):
    chance = random.Random(1)
    rows = [(i, " ".join(chance.choices(["la", "casa", "que"], k=20)), "es") for i in range(20)]
    rows += [(50 + i, " ".join(chance.choices(["the", "house", "with"], k=20)), "en") for i in range(20)]
    rows += [(90, "the house " * 500_000, "en"), (91, None, "en"), (92, "", None), (93, "12 + 34", "es")]
    rows += [(94, "жзи щъы " * 20, None), (95, "the house", None), (95, "la casa", None)]
    docs = documents(rows).withColumn("score", F.lit("mine"))
    model = language.fit(docs)
    got = {(r.doc_id, r.text): r for r in language.predict(docs, model).collect()}
    assert got[90, rows[40][1]].lang_pred == "en"
    for key, text in ((91, None), (92, ""), (93, "12 + 34")):
        assert got[key, text].lang_pred == "und" and got[key, text].rejected and not got[key, text].score
    assert got[94, rows[44][1]].rejected
    assert got[95, "the house"].lang_pred == "en" and got[95, "la casa"].lang_pred == "es"
    kept = language.recognised(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 4
    nothing = language.fit(documents([(1, "text", None)]))
    assert language.predict(documents([(1, "text")]), nothing).first().lang_pred == "und"
    assert language.predict(documents([]), model).count() == 0


def test_languages_whose_rows_share_a_key_are_learned(documents):
    chance = random.Random(6)

    def said(words):
        return " ".join(chance.choices(words.split(), k=12))

    rows = [(None, said("the house with and over"), "en") for _ in range(1500)]
    rows += [(i, said("das haus mit und wir"), "de") for i in range(1500)]
    rows += [(7, said("la maison avec et nous"), "fr") for _ in range(1500)]
    rows += [(8, "una casa con ella", "es")] * 1500
    model = language.fit(documents(rows), per_language=50)
    assert sorted(set(model.languages)) == ["de", "en", "es", "fr"]
    again = language.fit(documents(rows[::-1]).repartition(7), per_language=50)
    assert again.languages == model.languages and np.array_equal(again.centroids, model.centroids)
    asked = documents([(1, "the house over", None), (2, "nous avec la maison", None), (3, "una casa", None)])
    assert {r.doc_id: r.lang_pred for r in language.predict(asked, model).collect()} == {1: "en", 2: "fr", 3: "es"}


def test_counts_do_not_depend_on_pieces(monkeypatch):
    text = " ".join("abcdé fg"[i % 5 :] for i in range(3000))
    whole = language.counts([text])[0]
    monkeypatch.setattr(language, "PIECE", 997)
    assert np.array_equal(language.counts([text])[0], whole)


def plain_segments(scores):
    """All maximal segments by their definition: the best one, then what is left on both sides."""

    def best(low, high):
        found = None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += scores[b]
                if total > 0 and (found is None or total > found[0] + 1e-12):
                    found = (total, a, b)
        if found is None:
            return []
        _, a, b = found
        return [*best(low, a), (a, b), *best(b + 1, high)]

    return best(0, len(scores))


def test_segments_equal_their_definition():
    chance = random.Random(4)
    for _ in range(200):
        n = chance.randint(1, 25)
        # Scores that never add up to the same sum, so that the best segment is the only one.
        hits = [(i, 0.3 + chance.random()) for i in range(n) if chance.random() < 0.35]
        scores = [-0.25] * n
        for i, s in hits:
            scores[i] = s
        got = [(a, b) for a, b, _ in toxicity.segments(hits)]
        assert got == plain_segments(scores)


def test_decay_rate_solves_its_equation():
    share, score = np.array([0.01, 0.002]), np.array([1.0, 3.0])
    rate = toxicity.decay_rate(share, score)
    total = (share * np.exp(rate * score)).sum() + 0.988 * np.exp(-rate * toxicity.DRIFT)
    assert abs(total - 1) < 1e-6 and rate > 0


def test_toxic_documents_are_found(spark):
    got = QUERIES["op5_toxicity"](spark, SF)
    known = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count()
    rows = got.join(known, "doc_id").collect()
    clean = [r for r in rows if not r.toxic]
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_of_odd_texts(spark, documents):
    chance = random.Random(2)
    plain = ["".join(chance.choices("abcdef", k=4)) for _ in range(30)]
    rows = []
    for i in range(200):
        words = chance.choices(plain, k=40)
        rows.append((i, " ".join(words + ["scum"] * 3 * (i % 4 == 0)), None, None))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    more = spark.createDataFrame([(1, None), (None, 1), (3, 1), (500, 1)], "doc_id long, toxic int")
    model = toxicity.fit(documents(rows), labels.union(more))
    odd = [(1, None), (2, ""), (3, "!!"), (4, "SCUM! " * 5), (5, "scum " + "good " * 200_000), (None, "scum scum")]
    asked = documents(odd).withColumn("score", F.lit(7)).withColumn("passages", F.lit("p"))
    got = {r.doc_id: r for r in toxicity.score(asked, model).collect()}
    assert got[1].score == got[2].score == got[3].score < 0.5 and got[1].passages == []
    assert got[4].predicted == 1 and [(p.first, p.last) for p in got[4].passages] == [(0, 4)]
    assert got[5].n_passages == 0 and got[None].predicted == 1
    assert toxicity.score(documents([]), model).count() == 0
    nothing = toxicity.fit(documents(rows), labels.where("toxic = 1"))
    assert toxicity.score(documents([(1, "scum")]), nothing).first().predicted == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href="/a">Home</a><li><a href='x>y'>News</a></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy this</div><article><h1>A  title</h1><p><b>First &amp; <i>only</i>
line.<br>Next &#233;&nbsp;one <p>Second block<div>Third</div></article><form><input>Send</form>
<footer>&copy; me</footer></body>"""


def test_blocks_of_a_page():
    found = html_blocks.blocks(PAGE)
    texts = [b.text for b in found]
    assert texts == [
        "Home", "News", "Buy this", "A title", "First & only line. Next é one", "Second block",
        "Third", "Send", "© me",
    ]
    assert [html_extract.own_label(b) for b in found] == [0, 0, 0, 1, 1, 1, 1, 0, 0]
    assert found[0].linked == 4 and found[4].linked == 0
    assert html_blocks.blocks("") == [] and html_blocks.blocks("<p") == []
    assert [b.text for b in html_blocks.blocks("a < b <p class='x\">c")][0].startswith("a")


def test_formulas_drawings_and_fallback_texts_are_content():
    page = (
        "<body><article><p>Let <math><mi>a</mi><mo>+</mo><mspace/><msup><mi>b</mi><mn>2</mn></msup></math> be.</p>"
        "<p>See <svg><path d='M0 0'/><text>axis x</text><text>axis y</text></svg> here</p>"
        "<canvas>bars of 1990</canvas><object data='x'><p>a table instead</p></object>"
        "<noscript>plain form</noscript><p>last</p></article></body>"
    )
    found = [b.text for b in html_blocks.blocks(page)]
    assert found[:2] == ["Let a+b2 be.", "See axis x axis y here"] and found[-1] == "last"
    for said in ("bars of 1990", "a table instead", "plain form"):
        assert any(said in text for text in found)


@pytest.mark.parametrize("tag", ["math", "svg", "object", "canvas", "noscript"])
def test_an_unclosed_element_does_not_end_the_page(tag):
    page = f"<article><p>first <{tag}>inner</p><p>second <a href=x>link</a></p><ul><li>third</ul></article><p>end"
    found = html_blocks.blocks(page)
    assert [b.text for b in found] == ["first inner", "second link", "third", "end"]
    assert [b.linked for b in found] == [0, 4, 0, 0]


def test_an_inline_end_tag_ends_no_block():
    page = (
        "<span><article><p>one</p></span><p>two</p><a href=x><div>three</div><p>four</a> five</p>"
        "</b></i><a href=y>six<div>seven</div></article><p>eight</a> nine</p>"
    )
    found = html_blocks.blocks(page)
    assert [b.text for b in found] == ["one", "two", "three", "four five", "six", "seven", "eight nine"]
    assert [html_extract.own_label(b) for b in found] == [1] * 6 + [0]
    assert [(b.path.tag, b.path.up) for b in found[:3]] == [("p", "article"), ("p", "article"), ("div", "article")]
    # The end of a block ends the links in it.
    assert [b.linked for b in found] == [0, 0, 5, 4, 3, 5, 0]


@pytest.mark.parametrize("opening", ["<div class='a'>x", "<div>x</i>", "<x-y>x", "<a href=u>x<div>", "<span>x<div></span>"])
def test_deep_nesting_takes_time_in_proportion(opening):
    started = time.process_time()
    found = html_blocks.blocks(opening * 40_000)
    assert len(html_blocks.features(found)) >= 39_999
    assert time.process_time() - started < 10


def test_decoding_takes_the_best_of_all_labellings():
    chance = np.random.default_rng(5)
    field = html_extract.Field()
    field.weights = chance.normal(size=field.weights.shape)
    field.start, field.moves = chance.normal(size=2), chance.normal(size=(2, 2))
    for n in (1, 2, 5, 8):
        rows = [list(chance.integers(0, html_blocks.DIMS, 4)) for _ in range(n)]
        scores = [field.weights[r].sum(axis=0) for r in rows]

        def value(bits):
            total = field.start[bits[0]] + sum(s[b] for s, b in zip(scores, bits))
            return total + sum(field.moves[a, b] for a, b in zip(bits, bits[1:]))

        every = [[(k >> i) & 1 for i in range(n)] for k in range(1 << n)]
        assert field.decode(rows) == max(every, key=value)


def test_text_of_pages_in_layouts_not_trained_on(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    field = html_extract.fit(pages, most=60)
    right = total = 0
    for row in pages.orderBy("page_id").limit(40).collect():
        for rows, labels in html_extract.labelled(row.html, f"other {row.page_id}", 3):
            right += sum(a == b for a, b in zip(field.decode(rows), labels))
            total += len(labels)
    assert right >= 0.99 * total
    odd = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (3, "u", "<html><body></body></html>"), (4, "u", PAGE), (4, "u", PAGE), (None, "n", "<article><p>One.</p></article>" * 3)],
        "page_id long, url string, html string",
    ).withColumn("text", F.lit("mine"))
    got = html_extract.extract(odd, field).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 6 and [by[i].text for i in (1, 2, 3)] == [""] * 3
    assert by[4].text == "A title\n\nFirst & only line. Next é one\n\nSecond block\n\nThird"
    assert by[4].n_chars == len(by[4].text) and by[None].text == "One.\n\nOne.\n\nOne."
    assert html_extract.extract(odd.limit(0), field).count() == 0


def test_field_without_labelled_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>")], "page_id long, url string, html string")
    field = html_extract.fit(pages)
    assert html_extract.extract(pages, field).first().text == "a"


def quadratic_segments(hits, drift):
    """The same list of segments by walking back over all of them."""
    found, total, at = [], 0.0, 0
    for place, score in hits:
        total -= drift * (place - at)
        new = [place, place, total, total + score]
        total, at = total + score, place + 1
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= new[2]:
                k -= 1
            if k < 0 or found[k][3] >= new[3]:
                break
            new = [found[k][0], new[1], found[k][2], new[3]]
            del found[k:]
        found.append(new)
    return [(a, b, y - x) for a, b, x, y in found]


def test_segments_equal_those_by_walking_back():
    rng = random.Random(8)
    for _ in range(300):
        places = sorted(rng.sample(range(200), rng.randrange(1, 60)))
        hits = [(p, rng.choice([0.25, 0.5, 1.0, 2.5])) for p in places]
        assert toxicity.segments(hits, 0.25) == quadratic_segments(hits, 0.25)


def test_sparse_hits_of_a_long_text_take_linear_time():
    hits = [(i * 40, 1.0 + i % 3) for i in range(160_000)]
    started = time.perf_counter()
    assert len(toxicity.segments(hits)) == 160_000
    assert time.perf_counter() - started < 1.0


def test_word_counts_do_not_depend_on_partitions(spark, documents, monkeypatch):
    chance = random.Random(5)
    plain = ["".join(chance.choices("abcdef", k=4)) for _ in range(30)]
    rows = []
    for i in range(300):
        words = chance.choices(plain, k=30)
        words[5:6] = ["horrid", chance.choice(plain), "horrid"] if i >= 200 else ["lovely"]
        rows.append((i + 800, " ".join(words)))
    labels = spark.createDataFrame([(k, int(k >= 1000)) for k, _ in rows], "doc_id long, toxic int")
    found = []
    for parts in (1, 64):
        monkeypatch.setattr(toxicity, "READ_PARTS", parts)
        found.append(toxicity.fit(documents(rows).repartition(parts), labels))
    assert found[0].scores == found[1].scores and "horrid" in found[0].scores
    assert found[0].slope == pytest.approx(found[1].slope)
