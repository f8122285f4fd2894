"""URL filter, embeddings, SentencePiece, token counts, page text, registry and pipeline."""

import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from airmill.llm import embedding_dedup, html_text, queries, simhash, token_counts, url_filter
from airmill.llm import sentencepiece_viterbi as viterbi
from airmill.session import ensure_checkpoint_dir

PIECES = public_tokenizers.path(queries.PIECE_BPE)


def judged(spark, urls, rules=queries.URL_RULES, **options):
    frame = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit("clash"))
    return {r["page_id"]: r for r in url_filter.judge(frame, rules, **options).collect()}


def test_url_rules_against_brute_force(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Example.COM/en/1?x=/y", "http://www.example.com/en/2#z", "http://example.com", "http://badexample.com/en/1"]
    urls += ["http://x.net/es/1", "http://x.net/es", "ftp://net/fr/9/", "http://h/a?b://c/d", "x\ny://q.NET/fr/\n1", "http://com/", "http://m.example.com/de/1"] * 2
    got = judged(spark, urls)
    for k, url in enumerate(urls):
        m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(t), t, v) for v, t in queries.URL_RULES for d, _, p in [t.partition("/")] if (host == d or host.endswith("." + d)) and path.startswith("/" + p)]
        best = max(fits, default=(0, None, None))
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, best[1])
        assert best[2] is None or got[k]["verdict"] == best[2]
        assert got[k]["verdict"] in ("allow", "block")


def test_url_tree_generalises_merges_and_rejects(spark):
    urls = [f"http://h.org/user/name{chr(97 + k // 26)}{chr(97 + k % 26)}/post" for k in range(120)]
    urls += [f"http://h.org/{s}/{k}" for s in ("spam", "news") for k in range(60)]
    frame = spark.createDataFrame([(k, u, None if k < 120 else int(k < 180) if k % 2 else None) for k, u in enumerate(urls)], "id long, url string, bad int")
    got = {r["id"]: r for r in url_filter.judge(frame, [], label="bad").collect()}
    assert {got[k]["template"] for k in range(120)} == {"/user/*/post"}
    assert {got[k]["verdict"] for k in range(120, 180)} == {"block"}  # also those without a label
    assert {got[k]["verdict"] for k in range(180, 240)} == {"allow"} == {got[k]["verdict"] for k in range(120)}
    same = judged(spark, [f"http://h.org/{s}/{k}" for s in ("ab", "cd", "ef") for k in range(40)], [])
    assert {r["template"] for r in same.values()} == {"/+/<n>"}  # branches that behave alike
    assert url_filter.judge(frame.limit(0), []).count() == 0


def test_url_tree_generalises_all_levels(spark):
    name = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(120)]
    urls = [f"http://h.org/a{x}/b{x}/c{x}/d{x}" for x in name]
    urls += [f"http://deep.org/1/a/b/c/d/e/f/g/h/{s}/{k}" for s in ("spam", "news") for k in range(60)]
    bad = [k % 2 or None for k in range(120)] + [int(k < 60) if k % 2 else None for k in range(120)]
    frame = spark.createDataFrame([(k, u, b) for k, (u, b) in enumerate(zip(urls, bad, strict=True))], "id long, url string, bad int")
    got = {r["id"]: (r["template"], r["verdict"]) for r in url_filter.judge(frame, [], label="bad").collect()}
    assert {got[k] for k in range(120)} == {("/*/*/*/*", "block")}  # also those without a label
    start = "/<n>/a/b/c/d/e/f/g/h/"
    assert {got[k] for k in range(120, 180)} == {(start + "spam/<n>", "block")} and {got[k] for k in range(180, 240)} == {(start + "news/<n>", "allow")}


def test_hot_blocked_host_does_not_reject_hosts_without_labels(spark):
    urls = [f"http://hot.net/es/{k}" for k in range(600)] + [f"http://clean.org/{s}/{k}" for s in ("page", "text") for k in range(40)]
    got = judged(spark, urls)
    assert {got[k]["verdict"] for k in range(600)} == {"block"}
    assert {(got[k]["verdict"], got[k]["purity"]) for k in range(600, 680)} == {("allow", 0.5)}


def brute_links(vectors, least=0.9):
    x = [None if v is None or not len(v) or any(c is None or not np.isfinite(c) for c in v) or not any(v) else np.array(v, float) for v in vectors]
    links = [[] for _ in x]
    for i, a in enumerate(x):
        for j, b in enumerate(x):
            if i != j and a is not None and b is not None and len(a) == len(b):
                a1, b1 = a / np.abs(a).max(), b / np.abs(b).max()
                if a1 @ b1 / np.sqrt((a1 @ a1) * (b1 @ b1)) >= least:
                    links[i].append(j)
    label = list(range(len(x)))
    for _ in x:
        for i, near in enumerate(links):
            label[i] = min([label[i], *[label[j] for j in near]])
    return [len(n) for n in links], label


def test_embedding_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PART", 64)
    monkeypatch.setattr(embedding_dedup, "PER_CELL", 32)
    draw = np.random.default_rng(12)
    centres = draw.normal(size=(60, 16))
    vectors = [(c + draw.normal(size=16) * draw.choice([0.05, 0.15, 0.25])).tolist() for c in centres for _ in range(6)]
    vectors += [vectors[3]] * 70 + [(np.array(vectors[3]) * 5).tolist(), (-np.array(vectors[3])).tolist()]
    vectors += [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [1.0, 2.1], [1e200] * 16, [1e-200] * 16]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").withColumn("n_links", F.lit("clash"))
    got = {r["vec_id"]: r for r in embedding_dedup.groups(frame).collect()}
    links, label = brute_links(vectors)
    assert [got[k]["n_links"] for k in range(len(vectors))] == links
    assert [got[k]["component_id"] for k in range(len(vectors))] == label
    assert all(r["kept"] == (k == r["component_id"]) for k, r in got.items())
    assert embedding_dedup.groups(frame.limit(0)).count() == 0
    assert {r["n_links"] for r in embedding_dedup.groups(frame.where("embedding IS NULL OR size(embedding) = 0")).collect()} == {0}


def test_index_is_exact_when_all_near_cells_are_probed(spark):
    draw = np.random.default_rng(13)
    x = draw.normal(size=(400, 8))
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.groups(frame, least=0.8, probes=10_000).collect()}
    links, label = brute_links(x.tolist(), 0.8)
    assert [got[k]["n_links"] for k in range(400)] == links
    assert [got[k]["component_id"] for k in range(400)] == label


def test_hot_region_of_many_cells_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PER_CELL", 8)
    monkeypatch.setattr(embedding_dedup, "PART", 64)
    draw = np.random.default_rng(15)
    x = draw.normal(size=(1500, 32))
    x[:600] = draw.normal(size=32) + draw.normal(size=(600, 32)) / 3  # mean cosine of about 0.9
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    near = x @ x.T >= 0.9
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.groups(frame).collect()}
    assert near.sum() > 100_000
    assert [got[k]["n_links"] for k in range(1500)] == (near.sum(1) - 1).tolist()
    label = simhash.forest(1500, *np.nonzero(near))
    assert [got[k]["component_id"] for k in range(1500)] == label.tolist()


def brute_viterbi(text, model):
    best, back = [0.0], [None]
    for e in range(1, len(text) + 1):
        options = [(best[e - n] + model.pieces[text[e - n : e]][0], n, (model.pieces[text[e - n : e]][1],)) for n in range(1, min(model.longest, e) + 1) if text[e - n : e] in model.pieces]
        if text[e - 1] not in model.pieces:
            ids = model.fallback(text[e - 1])
            options.append((best[e - 1] + model.low * len(ids), 1, ids))
        score, n, ids = max(options)
        best.append(score)
        back.append((e - n, ids))
    out, e = [], len(text)
    while e:
        e, ids = back[e]
        out.append(ids)
    return [i for ids in reversed(out) for i in ids]


TEXTS = ["", " ", "   x  y ", "Hello, world! thé 😀\n\ttabs", "a" * 5000, "nospaces" * 300, "▁ ▁▁ odd", "中文 mixed ñandú", "word. word, (word) it's 12.5%"]


@pytest.mark.parametrize("text", TEXTS)
def test_streaming_viterbi_is_the_full_one_and_decodes(text):
    model = viterbi._worker(PIECES)[0]
    line = viterbi.normalise(text, model)
    full = brute_viterbi(line, model)
    assert list(viterbi.encode_stream(iter(line), model)) == full
    ids = next(viterbi.encode([text], PIECES))
    assert ids.tolist() == full
    assert viterbi.decode(ids, PIECES) == text.replace("▁", " ")


def test_streaming_viterbi_commits_early():
    model = viterbi._worker(PIECES)[0]
    seen = []

    def feed():
        for k in range(20_000):
            seen.append(k)
            yield "abcdefghij"[k % 10]

    next(viterbi.encode_stream(feed(), model))
    assert len(seen) < 200


def test_sentencepiece_tables(docs, spark):
    frame = docs([(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b")])
    got = viterbi.digest(frame, PIECES).collect()
    assert len(got) == 5 and all(r["round_trip"] for r in got)
    back = viterbi.with_text(viterbi.with_ids(frame, PIECES), PIECES)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back.collect()) == [(0, "a b"), (1, ""), (2, ""), (3, "a b"), (3, "a b")]
    assert viterbi.with_ids(docs([]), PIECES).count() == 0


def totals(rollup):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()}


def test_rollup_is_the_recount(spark):
    draw = random.Random(14)
    rollup = token_counts.Rollup(spark, f"{ensure_checkpoint_dir(spark)}/rollup-test-{draw.getrandbits(40)}-{id(spark)}")
    assert totals(rollup) == {}
    live, schema = {}, "source string, lang string, tokenizer string, n_tokens long, sign int, extra string"
    for batch in range(6):
        rows = []
        for _ in range(40):
            doc, group = draw.randint(0, 50), (draw.choice(["a", "b", None]), draw.choice(["en", None]), "t1")
            if doc in live:
                g, n = live.pop(doc)
                rows.append((*g, n, -1, "x"))
            if draw.random() < 0.6:
                live[doc] = (group, draw.randint(1, 99))
                rows.append((*group, live[doc][1], 1, "x"))
        changes = spark.createDataFrame(rows, schema)
        assert rollup.commit(f"b{batch}", changes)
        assert not rollup.commit(f"b{batch}", changes)
        if batch in (2, 3):
            rollup.compact()
            assert not rollup.commit("b0", changes)
        expected = {}
        for g, n in live.values():
            d, t = expected.get(g, (0, 0))
            expected[g] = d + 1, t + n
        assert totals(rollup) == expected
    assert rollup.commit("empty", spark.createDataFrame([], schema))
    # a delta without marker, as a lost driver leaves it, is not read
    spark.createDataFrame([("a", "en", "t1", 5, 5, "lost")], token_counts.SCHEMA).write.parquet(f"{rollup.folder}/deltas/lost")
    assert totals(rollup) == expected


PAGES = [
    ("<nav><a href=x>Home</a></nav><article><h1>Title &amp; more</h1><p>One   two<b> three</b><br>four<p>&lt;five&gt;</article><footer>&copy; us</footer>", "Title & more\nOne two three four\n<five>"),
    ('<div class="menu"><ul><li><a href=x>A</a></li></ul></div><div id="content"><p>' + "word " * 40 + '</p><div class="ad">Buy now</div><p>Short.</p></div><div class="comments"><p>' + "nice one " * 20 + "</p></div>", ("word " * 40).strip() + "\nShort."),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><article><p>Yes, this.<script>x</script></p></article>", "Yes, this."),
    ('<article><form><p>Your name</p></form><p>Text here.</p><aside>Related</aside><section class="comments"><article class="comment"><p>Hi there</p></article></section></article>', "Text here."),
    ('<div class="cookie-banner">We use cookies</div><main><p>A</p><p>B c</p></main>', "A\nB c"),
    ("", ""),
    (None, ""),
    ("<<<>< a <p", ""),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_main_text(html, text):
    if html == "<<<>< a <p":
        assert isinstance(html_text.main_text(html), str)  # broken markup ends somehow
    else:
        assert html_text.main_text(html) == text


def test_tree_fits_its_table_and_other_pages():
    x, y = html_text.labelled()
    assert (abs(html_text.predict(html_text.tree(), x) - y) < 0.5).mean() > 0.97
    x, y = html_text.labelled(seed=99)  # other texts of the same kinds
    assert (abs(html_text.predict(html_text.tree(), x) - y) < 0.5).mean() > 0.95


@pytest.mark.parametrize("view, precision, recall", [(html_text.unnamed_main, 0.95, 0.93), (html_text.unnamed, 0.75, 0.93)])
def test_tree_on_other_pages_without_telling_markup(view, precision, recall):
    """Long comments and side texts look like articles once nothing names them, so fewer blocks are right there."""
    x, y = html_text.labelled(seed=99, views=(view,))
    got, y = html_text.predict(html_text.tree(), x) >= 0.5, y > 0
    assert (got & y).sum() >= precision * got.sum() and (got & y).sum() >= recall * y.sum()


def test_pages_table(spark):
    frame = spark.createDataFrame([(1, "u", PAGES[0][0], "clash"), (1, "u", PAGES[0][0], "clash"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = html_text.extract(frame).collect()
    assert [r["text"] for r in got] == [PAGES[0][1]] * 2 + [""] and html_text.extract(frame.limit(0)).count() == 0


def test_extraction_of_given_pages(spark, folder):
    """All given pages hold their article in one element: a plain reading of it is the answer."""
    from html import unescape

    for r in html_text.extract(spark.read.parquet(f"{folder}/pages.parquet").withColumn("raw", F.col("html"))).collect():
        article = re.search(r"<article>(.*)</article>", r["raw"], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", x))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(x for x in parts if x)


def test_extraction_of_given_pages_without_telling_markup(spark, folder):
    """The same pages with all parts as ``div`` and without names: words and links are left."""
    found = lost = wrong = 0
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        want = set(html_text.main_text(r["html"]).split("\n"))
        plain = re.sub(r"<(/?)(?:article|nav|footer|header|main|aside|section)\b[^>]*>", r"<\1div>", re.sub(r' class="[^"]*"', "", r["html"]))
        got = set(html_text.main_text(plain).split("\n"))
        found, lost, wrong = found + len(want & got), lost + len(want - got), wrong + len(got - want)
    assert found / (found + wrong) >= 0.95 and found / (found + lost) >= 0.95


@pytest.mark.parametrize("html", ["<div>" * 20_000 + "</x></section></p>" * 20_000, "<a b='\"" * 100_000, "<a b='\"" * 100_000 + ">", "<a b='\">x" * 100_000, "<div class='main'>" * 40_000 + "x</div>" * 40_000])
def test_hostile_pages_take_linear_time(html):
    start = time.process_time()
    html_text.main_text(html)
    assert time.process_time() - start < 5


def test_every_operator_is_registered(spark, folder):
    import __spark_entry__ as entry

    found = entry.queries()
    assert [n for n in range(1, 11) if sum(x.startswith(f"op{n}_") for x in found) == 1] == list(range(1, 11))
    assert "pipeline" in found


def test_pipeline_against_brute_force(spark, folder):
    import corpus_pipeline
    from tests.llm.test_text_operators import base, brute_fingerprint, check_pieces
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    alive = {i for i, t in rows.items() if not base(t)[-1]}  # no line is common enough here to deplete
    kept = spark.createDataFrame([(1,)], "x int")
    kept = corpus_pipeline.quality(spark, docs, folder)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == alive
    known = corpus_pipeline.language(spark, kept, folder)
    assert known.columns == docs.columns and {r["doc_id"] for r in known.collect()} == alive  # all texts have a language
    values = {i: brute_fingerprint(rows[i]) for i in sorted(alive)}
    label = {i: i for i in values}
    for a in values:
        for b in values:
            if b < a and label[a] != label[b] and (values[a] ^ values[b]).bit_count() <= 3:
                low, high = sorted((label[a], label[b]))
                label = {k: low if x == high else x for k, x in label.items()}
    first = {i for i in label if label[i] == i}
    single = corpus_pipeline.near_duplicates(spark, known, folder)
    assert single.columns == docs.columns and sorted(r["doc_id"] for r in single.collect()) == sorted(first)
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} == first
    check_pieces(out, [(i, rows[i]) for i in first], Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE)))
