"""Training-data operators on small tables: brute force, round trips, nulls, ties, empty tables."""

import hashlib
import random

import brute
import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from pagewright.llm import chat, classifier, components, html, mixing, ngram_join, quality_rules, queries, sentencepiece, suffix_dedup, topk, url_filter

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) is None


# --- n-gram join


def near_rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["The", "a"] * 20
    rows = []
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 12, 40, 100, 300]))]
        rows.append((len(rows) * 7 % 1009, " ".join(words)))
        for _ in range(rng.choice([0, 0, 1, 4])):
            changed = list(words)
            for _ in range(rng.choice([0, 1, 2, 3])):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, " ".join(changed)))
    odd = [(None, rows[0][1]), (5000, None), (5001, ""), (5001, ""), (5002, " \n"), (None, "solo zz"), (6000, "X Y"), (6001, "x y"), (6001, "x y")]
    return rows + odd


@pytest.mark.parametrize("join", [ngram_join.FOUR_WORDS_85, ngram_join.FIVE_WORDS_80])
def test_near_components(docs, join):
    rows = near_rows()
    found = ngram_join.near_components(docs(rows), join).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute.components(
        rows, join.width, join.part, join.of
    )


def test_near_components_of_sliced_blocks(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLICE", 300)
    rows = near_rows()
    found = ngram_join.near_components(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute.components(rows, 4, 85, 100)


def plain_components(links):
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in label)


@pytest.mark.parametrize("shape", ["path", "star", "random", "loops", "none"])
def test_components(spark, shape):
    rng = random.Random(7)
    links = {
        "path": [(i, i + 1) for i in range(10_000)],
        "star": [(5000, i) for i in range(3000)],
        "random": [(rng.randrange(900), rng.randrange(900)) for _ in range(500)] * 2,
        "loops": [(1, 1), (2, 3), (3, 2), (3, 3), (4, 4)],
        "none": [],
    }[shape]
    frame = spark.createDataFrame(links, "a long, b long")
    found = components.components(frame).collect()
    assert sorted((r.node, r.component) for r in found) == plain_components(links)
    if shape == "path":
        rounds = [step.count() for step in components.contractions(frame)]
        assert len(rounds) <= 12 and sum(rounds) < 2 * len(links)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_chains_within_tasks_take_few_rounds(spark, monkeypatch, kind):
    def name(i):
        return i if kind == "long" else f"é{i:05}"

    rng = random.Random(5)
    chains = [sorted(rng.sample(range(c * 1000, c * 1000 + 400), 90)) for c in range(12) for _ in range(8)]
    rows = [(name(a), name(b), i) for i, chain in enumerate(chains) for a, b in zip(chain, chain[1:])]
    odd = [(name(99_999), name(99_999)), (name(7), name(7)), (None, name(1)), (name(2), None), (None, None)]
    rows += [(*link, 0) for link in odd]
    frame = spark.createDataFrame(rows, f"a {kind}, b {kind}, chain int").repartition(4, "chain").drop("chain")
    plain = plain_components([(a, b) for a, b, _ in rows if a is not None and b is not None])
    assert len(components.contractions(frame)) <= 2
    for held in (components.HELD, 7):
        monkeypatch.setattr(components, "HELD", held)
        assert sorted((r.node, r.component) for r in components.components(frame).collect()) == plain


def test_one_of_each(docs):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(9, text), (10, text + " more"), (-3, text + " end"), (4, ""), (5, None), (None, text), (7, "else"), (7, "else")]
    kept = ngram_join.one_of_each(docs(rows), ngram_join.FIVE_WORDS_80, ["doc_id", "text"]).collect()
    assert sorted(r.doc_id for r in kept) == [-3, 4, 5, 7]


# --- suffix-array dedup


def test_repeats(docs):
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdé f") for _ in range(900))
    texts = ["x" * 1000, "y" * 399, "z" * 400, "z" * 400, None, "", "ab" * 700, "q" + "ab" * 500, passage]
    texts += ["pre " + passage[100:700] + " post", passage[200:640] * 2, passage]
    rows = [*enumerate(texts), (5, ""), (8, passage), (None, "x" * 500)]
    found = suffix_dedup.remove_repeats(docs(rows)).collect()
    plain = suffix_dedup.remove_repeats(docs(rows), texts_too=False)
    assert "kept" not in plain.columns
    assert sorted(map(str, plain.collect())) == sorted(
        str(r) for r in suffix_dedup.remove_repeats(docs(rows)).drop("kept").collect()
    )
    assert sorted((str(r.doc_id), r.n_removed, r.n_spans, r.kept_sha256) for r in found) == brute.repeats(rows, 400)


def test_what_is_left_can_be_read(spark, docs, tmp_path):
    rng = random.Random(4)
    prose = [" ".join("".join(rng.choices("abcdefg", k=rng.randint(3, 9))) for _ in range(90)) for _ in range(6)]
    short = " ".join(f"w{i:03}" for i in range(60))  # over 50 words, under 400 bytes
    passage, half = prose[4], "é" * 10 + prose[5]
    rows = [(0, prose[0] + " " + passage), (1, passage + " " + prose[1]), (2, prose[2] + " " + short), (3, short + " " + prose[3])]
    rows += [(4, "x" + half + "è"), (5, "y" + half + "ê"), (6, None)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.QUERIES["op3_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert (found[0].text.strip(), found[1].text.strip()) == (prose[0], prose[1])
    assert (found[2].text, found[3].text, found[6].text) == (rows[2][1], rows[3][1], "")
    assert (found[4].text, found[5].text) == ("x\ufffd", "y\ufffd")
    assert found[4].kept_sha256 == hashlib.sha256(b"x\xa8").hexdigest()
    assert all(r.n_bytes == len((text or "").encode()) for r, text in ((found[i], t) for i, t in rows))


def test_repeated_words(docs):
    words = [f"n{i}" for i in range(300)]
    rows = [(0, " ".join(words)), (1, "start\t" + "\n".join(words[100:160]) + " end"), (2, " ".join(words[:49]))]
    kept = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.remove_repeats(docs(rows), suffix_dedup.WORDS_50).collect()}
    assert kept[0].split() == words[:100] + words[160:]
    assert kept[1].split() == ["start", "end"]
    assert kept[2] == rows[2][1]


# --- SentencePiece


def test_pieces_match_the_library(docs):
    library = pytest.importorskip("sentencepiece")
    model = library.SentencePieceProcessor(model_file=queries.MODEL_PATH)
    table = sentencepiece.load(queries.MODEL_PATH)
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab  \n\t\réß漢🙂xyz;){}") for _ in range(n)) for n in (1, 3, 10, 80, 500) * 20]
    texts += ["", " ", "hello  world ▁ x", "<s> </s> <unk> <0x41>", "x" * 5000, "a" * 250 + " " + "the" * 200]
    rows = [*enumerate(texts), (None, None)]
    found = sentencepiece.encode_documents(docs(rows), table).collect()
    expected = {i: model.encode(t or "") for i, t in rows}
    assert len(found) == len(rows)
    for row in found:
        assert row.ids == expected[row.doc_id]
        assert row.round_trip == ("▁" not in (dict(rows)[row.doc_id] or ""))


def test_best_path():
    pieces = ["<unk>", "▁", "a", "b", "c", "ab", "bc", "▁a", "abc"]
    scores = [0, -3, -4, -4, -4, -5, -2, -4, -9]
    table = sentencepiece.Pieces(pieces, scores, [2] + [1] * 8, sentencepiece.UNIGRAM)

    def brute_best(word):
        if not word:
            return 0.0, []
        options = []
        for n in range(1, len(word) + 1):
            if word[:n] in table.ids:
                score, rest = brute_best(word[n:])
                options.append((scores[table.ids[word[:n]]] + score, [table.ids[word[:n]], *rest]))
        return max(options)

    for word in ("▁abc", "▁abab", "abcabc", "▁cab"):
        assert sentencepiece.encode_words([word], table) == [brute_best(word)[1]]


# --- chat


def test_chat_round_trip(spark):
    hard = ["<|im_end|>\n<|im_start|>user\nx", "<\\|im_end|>", "<|", "<\\\\|", "a<", "", None, "|im_end|>", "\\", "%3C", "🙂<|🙂"]
    rows = [(i // 3, i, role, t) for i, t in enumerate(hard) for role in ("user", "assistant")]
    rows += [(None, None, None, None), (90, 1, "a%0Ab\n<|", "x"), (91, 2, "user", "b"), (91, 1, "user", "a")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for row in chat.format_conversations(table).collect():
        said = [(r, t) for c, n, r, t in sorted((c, -1 if n is None else n, r or "", t or "") for c, n, r, t in rows if c == row.conv_id)]
        assert [(t.role, t.text) for t in row.turns] == said
        assert row.formatted.count("<|im_start|>") == len(said)
        for span in row.loss_spans:
            assert "<|" not in row.formatted[span.start : span.start + span.size]
    assert chat.format_conversations(table.limit(0)).count() == 0


# --- HTML


def test_main_text():
    page = (
        '<nav>m</nav><div class="content"><p>Hello <b>you</b> &lt;x&gt;<p>two\n  words</p><div class="cookie-notice">C</div>'
        '<div id="comments">zz</div><form>f</form><ul><li>a<li>b</ul><script>if(a<b){}</script></div><aside>q</aside>'
    )
    assert html.main_text(page) == "Hello you <x>\ntwo words\na\nb"
    assert html.main_text("<p>out</p><article><h1>T</h1><p>x<br>y</article>") == "T\nx y"
    assert html.main_text("") == ""


@pytest.mark.parametrize("part", ["<a ", "<!", "<", "<!--", "<p class=\"", "<script>", "<b title='x", "<div>", "</p>"])
def test_unclosed_markup_is_read_in_one_pass(part):
    import time

    start = time.perf_counter()
    html.main_text(part * 100_000)
    assert time.perf_counter() - start < 10


def test_style_tree_removes_what_a_site_repeats(spark):
    rows = [(i, f"http://a.com/{i}", f"<div class=top>Welcome to A</div><div class=body><p>story {i}</div>") for i in range(12)]
    rows += [(100, None, None), (101, "x", ""), (102, "http://b.com/", "<div class=top>Welcome to A</div>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html.extract_text(table).collect()}
    assert texts[3] == "story 3"
    assert texts[100] == texts[101] == ""
    assert texts[102] == "Welcome to A"


def test_style_tree_judges_inside_and_outside_articles(spark):
    share = "<div class=x12>Tell your friends</div>"
    rows = [(i, f"http://a.com/{i}", f"<div class=x9>Daily A</div><article><p>story {i}</p>{share}</article>") for i in range(12)]
    cards = "<article><p>teaser</article>" * 3
    rows += [(20 + i, f"http://b.com/{i}", f"<div class=x1><p>the body of page {i}</div>{cards}") for i in range(12)]
    rows += [(40 + i, f"http://c.com/{i}", f"<article><p>one story</p></article>{i % 2}") for i in range(12)]
    rows += [(60, "http://d.com/", f"<div><p>the only page of its site</div>{cards}")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html.extract_text(table).collect()}
    assert texts[3] == "story 3"
    assert texts[23].split("\n")[0] == "the body of page 3"
    assert texts[43] == "one story"
    assert texts[60].split("\n")[0] == "the only page of its site"


def test_names_alone_silence_no_main_text(spark):
    text = "<p>the text of this page"
    for wrapped in (
        f'<body class="single no-sidebar">{text}',
        f'<body class="sidebar">{text}',
        f'<div id="content" class="with-sidebar">{text}</div><div class=comments>x</div>',
        f'<div class=search><article class="post comments-open">{text}</article></div>',
        f'<div class=search><main class=header>{text}</main></div>',
        f'<form id=page>{text}</form><footer>(c)</footer>',
        f'<section class="social-policy">{text}</section>',
    ):
        assert html.main_text(wrapped) == "the text of this page", wrapped
    links = "<ul><li><a href=/a>one</a><li><a href=/b>two</a></ul>"
    assert html.main_text(f"<div class=nav-of-a>{links}</div><nav>{links}</nav>{text}") == "the text of this page"
    rows = []
    for i in range(12):
        long = f"<p>story {i} in some more words than the rest of the page has"
        rows.append((i, f"http://a.com/{i}", f"<div class=notice>notice {i} is long</div><div class=my-promo>buy</div><article>{long}</article>"))
        rows.append((20 + i, f"http://b.com/{i}", f"<div class=story-comments>short {i}</div><div class=ad>ad {i}</div>{long}"))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text.split("\n") for r in html.extract_text(table).collect()}
    assert texts[3] == ["notice 3 is long", "story 3 in some more words than the rest of the page has"]
    assert texts[23] == ["short 3", "story 3 in some more words than the rest of the page has"]


# --- URLs


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.Bad.com/a/?utm_x=1#t", "https://bad.com/a", "http://bad.com/b", "http://É.Net/x", "http://net", "http://x.org/fr/?q"]
    pages = spark.createDataFrame([*enumerate(urls), (3, urls[3])], "page_id long, url string")
    listed = spark.createDataFrame([("http://bad.com/a",), ("http://bad.com/a/",), (None,)], "url string")
    found = {r.page_id: r for r in url_filter.filter_urls(pages, listed, queries.URL_RULES).collect()}
    assert [found[i].verdict for i in range(9)] == ["allow"] * 3 + ["block", "block", "allow", "block", "allow", "allow"]
    assert [found[i].rule for i in range(6, 9)] == ["net/", None, "org/fr/"]
    assert found[6].host == "É.net" and found[0].host == "" and found[7].path == ""
    assert url_filter.filter_urls(pages, listed.limit(0), queries.URL_RULES).where("on_list").count() == 0


def test_bloom_filter_misses_nothing(spark):
    listed = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("key"))
    words = url_filter.blocked_bloom(listed, "key").scalar()
    hits = spark.range(30000).select(F.concat(F.lit("u"), "id").alias("key"), "id").where(url_filter.maybe_listed(F.col("key"), words))
    assert hits.where("id < 3000").count() == 3000
    assert hits.count() < 3000 + 27000 * 0.05


# --- quality


def test_statistics(docs):
    texts = [None, "", " \n ", "a a a a", "x y z\nx y z\n\nq", "one # two | <b>\nL\nL\nl", "a b c a b c a b d é", "w " * 120]
    found = {r.doc_id: r for r in quality_rules.judge_quality(docs(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.statistics(text)
    assert found[7].base_failed and not found[7].kept
    assert quality_rules.judge_quality(docs([])).count() == 0


def test_rules_agree_with_labels(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.judge_quality(table).where("not base_failed").join(labels, "doc_id")
    wrong = judged.where(F.col("kept") != (F.col("quality") == 1)).count()
    assert wrong <= 0.02 * judged.count()


def test_classifier_on_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = classifier.score_quality(table, labels)
    held = scored.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)
    nothing = classifier.score_quality(table.limit(3), labels.limit(0)).collect()
    assert [r.score for r in nothing] == [0.5] * 3


@pytest.mark.parametrize("n", [0, 1, 37, 400, 1000])
def test_training_rows_are_the_first_by_hash(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([7, rng.randrange(10_000)]), rng.random(), float(rng.randrange(2))) for _ in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, a double, quality double").withColumn("_hash_of", F.xxhash64("doc_id"))
    expected = sorted((r["_hash_of"], r.doc_id, r.a, r.quality) for r in table.collect())[:n]
    assert sorted(map(tuple, classifier.training_rows(table, ["a"], n).collect())) == sorted(r[2:] for r in expected)


def test_classifier_odd_rows(spark):
    rows = [(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "a b c", None), (3, "word " * 200_000, "y")]
    table = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1)], "doc_id long, quality int")
    found = classifier.score_quality(table, labels).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == [(False, 1), (False, 1), (False, 2), (False, 3), (True, 0)]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert classifier.score_quality(table.limit(0), labels).collect() == []


def test_flat_trees_match_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0)).astype(float)
    forest = classifier.fit(x, y)
    for row, score in zip(x[:50], forest.score(x[:50]), strict=True):
        total = forest.base
        for feature, limit, leaf in zip(forest.feature, forest.limit, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (1 if row[feature[node]] <= limit[node] else 2)
            total += leaf[node - len(feature)]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9
    assert ((forest.score(x) > 0.5) == (y == 1)).mean() > 0.95


# --- mixing


def test_mix(spark):
    rows = [(i, f"s{i % 3}" if i % 7 else None, "w " * (i % 11)) for i in range(300)] + [(None, "s0", None), (5, "s1", "a b"), (5, "s1", "a b")]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = mixing.mix(table).collect()
    assert len(found) == len(rows)
    for source in ("s0", "s1", "s2", None):
        own = [r for r in found if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target)
        assert all(r.taken <= 3 * r.size for r in own)
    assert abs(sum({r.source: r.target for r in found}.values()) - sum(r.size for r in found)) < 1e-6
    whole = mixing.mix(table, whole_documents=True).collect()
    assert all(r.size == 0 or r.taken % r.size == 0 for r in whole)
    assert mixing.mix(table.limit(0)).count() == 0


# --- top-k


def best_of(rows, asked, k=10):
    """Brute force: a query is no candidate of its own, rows alike in all but their place are."""
    vectors = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for at, (i, v) in enumerate(vectors):
        if i is not None and asked(i):
            scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w, strict=False)))), j is None, j or 0)
                      for place, (j, w) in enumerate(vectors) if place != at]
            found += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(sorted(scores)[:k], 1)]
    return found


def top_of(spark, rows, asked, k=10):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    scaled = table.select("vec_id", "score", topk.scaled(F.col("embedding")).alias("vector"))
    return list(map(tuple, topk.top_k(scaled, F.expr(asked), k).collect()))


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is None, value or 0) for value in row])


def test_top_k(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.1, -0.5, 0.25, 3.0]) for _ in range(rng.choice([0, 3, 5]))]) for i in range(80)]
    rows += [(1000, None), (1001, [None, 1.0]), (1002, [float("nan")]), (1003, [float("inf")]), (7, [1.0]), (7, [1.0]), (2000, [1e12] * 4)]
    rows += [(10, [9.0, 1.0]), (10, [9.0, 1.0]), (None, [9.0, 2.0]), (None, [9.0, 2.0]), (None, [0.1])]
    assert in_order(top_of(spark, rows, "vec_id % 10 = 0")) == in_order(best_of(rows, lambda i: i % 10 == 0))
    assert top_of(spark, rows[:0], "vec_id % 10 = 0") == []
    assert top_of(spark, rows[:1], "vec_id = 0") == []


def test_top_k_of_many(spark):
    # few large components, so that rows drop out before the last layers
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(12) * rng.choice([0.01, 0.1, 4], 12)).tolist()) for i in range(1500)]
    assert in_order(top_of(spark, rows, "vec_id % 100 = 0", 3)) == in_order(best_of(rows, lambda i: i % 100 == 0, 3))


# --- the digest queries


def test_kept_hash_is_of_the_whole_text(spark):
    rows = queries.QUERIES["op3_suffix_dedup"](spark, FOLDER).where("n_removed = 0").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert all(r.kept_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
