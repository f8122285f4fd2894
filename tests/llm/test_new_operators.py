"""Ranked search, prefix trie and language model: whole results against plain Python, and the queries themselves."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from airmill.llm import maxent_lm, oracles, prefix_trie, queries, ranked_search, words
from checks.compare import connect, differences

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_queries_against_sql(spark, folder, name):
    got = queries.registered()[name](spark, folder).toPandas()
    assert differences(got, connect(folder).sql(oracles.oracle_sql()[name]).df()) == ""


# ---- words


def test_pieces_cut_long_texts_at_delimiters(monkeypatch):
    monkeypatch.setattr(words, "SLICE", 5)
    rng = random.Random(1)
    for _ in range(300):
        raw = "".join(rng.choice(["ab", "é", " ", "\n", "longerword"]) for _ in range(rng.randrange(14))).encode()
        assert [w for part in words.pieces(raw) for w in part] == raw.split()


# ---- ranked search


def ranked(docs, items, k):
    found = {n: [lower(t) for t in TERM.findall(text or "")] for n, (_, text) in enumerate(docs)}
    found = {n: x for n, x in found.items() if x}
    held, length = len(found), sum(map(len, found.values()))
    df = Counter(t for x in found.values() for t in set(x))
    out = []
    for item, text in items:
        rows = []
        for n, x in found.items():
            tf, m = Counter(x), 100 - 25 + (25 * len(x) * held) // length
            score = sum(math.floor(1000 * math.log((2 * held + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in map(lower, TERM.findall(text or "")) if tf[t])
            if score > 0:
                rows.append((-score, docs[n][0] is None, docs[n][0] or 0, docs[n][0]))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(rows, key=lambda x: x[:3])[:k], 1)]
    return out


def search_rows(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("x"), "terms": F.lit(1)}).repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x")).coalesce(1)
    got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranked_search.search(d, i, **options).collect()]
    return sorted(got, key=str)


def test_search_against_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    some = lambda n: " ".join(rng.choice(["Aa", "b-b", "Ccc", "é1", "É1", "d", "e", "f9", "\x00g", "h_h"]) for _ in range(n))
    docs = [(k // 2, some(rng.randrange(30))) for k in range(160)] + [(7, None), (None, some(9)), (8, ""), (9, "-- _ \x00"), (None, some(4))]
    docs += [(200 + k, "aa b ccc") for k in range(30)]  # equal scores
    items = [(k, some(5)) for k in range(12)] + [(3, some(4)), (50, None), (51, ""), (None, "aa aa aa"), (52, "unknown")]
    want = sorted(ranked(docs, items, 20), key=str)
    assert search_rows(spark, docs, items) == want
    monkeypatch.setattr(ranked_search, "ITEMS", 5)  # several blocks, few cells at a time, integers beyond doubles
    monkeypatch.setattr(ranked_search, "CELLS", 7)
    monkeypatch.setattr(words, "SLICE", 16)
    assert search_rows(spark, docs, items) == want
    assert search_rows(spark, docs, items, k=3) == sorted(ranked(docs, items, 3), key=str)
    assert search_rows(spark, [], items) == [] == search_rows(spark, docs, [])
    assert search_rows(spark, [(1, None)], items) == []


def test_search_beyond_exact_doubles(spark, monkeypatch):
    docs = [(k, "rare " * (k + 1)) for k in range(4)] + [(9, "other")]
    items = [(1, "rare " * 50)]
    want = sorted(ranked(docs, items, 20), key=str)
    assert want and search_rows(spark, docs, items) == want
    monkeypatch.setattr(ranked_search, "EXACT", 1)
    assert search_rows(spark, docs, items) == want


# ---- prefix trie


def trie_of(conversations, every=20, most=4):
    """Nodes by plain walking."""
    own = defaultdict(list)
    for conv, turn, role, text in conversations:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(rows)] for c, rows in own.items()}
    paths = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % most
        paths[c] = tuple(own.get(c - c % every, [])[:h] + rows[h:])
    members = defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[: len(x)] == x and len(y) > len(x) for y in below)]
        saved = sum((len(members[x]) - 1) * (len(WORD.findall(x[-1][1])) if x else 0) for x in below)
        ends = hashlib.sha256(",".join(str(c) for c in sorted(c for c in convs if len(paths[c]) == len(node))).encode()).hexdigest()
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), len(leaves), saved, ends))
    return sorted(out, key=str)


def trie_rows(spark, rows, **options):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"depth": F.lit("x"), "place": F.lit("y")})
    return sorted((tuple(r) for r in prefix_trie.trie(*prefix_trie.rebuilt(frame), **options).collect()), key=str)


def conversations():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "ho ho", "", "x y z", None])) for c in range(130) for t in range(rng.randrange(1, 7))]
    rows += [(c, t, "user", "same words again") for c in range(200, 290) for t in range(3)]  # a group of copies
    rows += [(300, t, "user", f"turn {t}") for t in range(150)]  # a long one
    rows += [(400, None, None, None), (400, None, "a", "b"), (400, 1, "u", "tie two"), (400, 1, "u", "tie one"), (400, 1, "u", "tie one"), (None, 1, "u", "no id")]
    rows += [(c, 0, "user", "only") for c in (501, 502, 503, 504, 505)]  # bases are absent
    rows.append((600, 0, "user", "long " * 30_000))
    return rows


def test_trie_against_brute_force(spark):
    rows = conversations()
    want = trie_of(rows)
    assert trie_rows(spark, rows) == want
    assert trie_rows(spark, rows, limit=10, block=40) == want  # many blocks, many rounds of contraction


def test_trie_of_little(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 0, "u", "x")]) == []
    assert trie_rows(spark, [(5, None, None, None)]) == trie_of([(5, None, None, None)])


def test_list_ranking(spark):
    order = random.Random(4).sample(range(5000), 5000)
    arcs = spark.createDataFrame([(a, b, a % 7) for a, b in zip(order, order[1:] + [prefix_trie.END], strict=True)], "id long, follows long, near long")
    got = {r["id"]: r["position"] for r in prefix_trie.positions(arcs, ["near"], limit=50, block=600).collect()}
    assert [got[a] for a in order] == list(range(5000))


# ---- language model


def base_scores(docs, held):
    tokens = {n: [lower(w) for w in WORD.findall(t or "")] + ["\n"] for n, (_, t) in enumerate(docs)}
    for n, x in tokens.items():
        tokens[n] = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in x]
    count = Counter(w for n, x in tokens.items() if not held[n] for w in x)
    total, distinct = sum(count.values()), len(count)
    return [(len(x), sum(w in count for w in x), total, sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in x)) for x in tokens.values()]


def lm_rows(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, held string, row int")
    return maxent_lm.score(frame, maxent_lm.held_out(F.col("doc_id")), **options).toPandas().sort_values(["doc_id", "n_tokens", "base_score"], ignore_index=True)


def corpus(n):
    rng = random.Random(5)
    en, es = ["the", "thing", "of", "and", "runs", "walks"], ["el", "la", "cosa", "de", "corre", "anda"]
    return [(k, " ".join(rng.choice(x) + (rng.choice("abcdefgh") * 3 if rng.random() < 0.3 else "") for _ in range(rng.randrange(1, 60)))) for k in range(n) for x in [en if k % 2 else es]]


def test_lm_base_figures_and_blocks(spark):
    docs = corpus(120) + [(500, None), (501, ""), (502, " \t\n\x0b"), (None, "The THING"), (503, "É é\x00b"), (504, "long words " * 3000), (5, "the the"), (5, "the the")]
    got = lm_rows(spark, docs)
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    want = sorted(zip([i for i, _ in docs], held, base_scores(docs, held), strict=True), key=lambda x: (x[0] is None, x[0] or 0, x[2][0], x[2][3]))
    assert len(got) == len(want)
    for r, (i, h, (n, known, total, base)) in zip(got.itertuples(), want, strict=True):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert (np.isnan(r.doc_id) if i is None else r.doc_id == i) and r.base_score == pytest.approx(base, rel=1e-9)
    assert np.isfinite(got.score).all() and (got.score < 0).all()
    cut = lm_rows(spark, docs, block=8, segment=5)  # many small blocks and segments give the same
    np.testing.assert_allclose(cut.base_score, got.base_score, rtol=1e-9)
    np.testing.assert_allclose(cut.score, got.score, rtol=1e-6)


def test_lm_predicts_held_out_texts_better_than_the_base(spark):
    got = lm_rows(spark, corpus(600))
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum() + 0.1 * held.n_tokens.sum()


def test_lm_without_training_texts(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = lm_rows(spark, [(i, "a b") for i in ids])
    assert (got.train_tokens == 0).all() and (got.base_score == 0).all() and (got.score == 0).all()
    assert len(lm_rows(spark, [])) == 0


def test_class_model_is_a_distribution_and_scores_match_token_by_token():
    rng = np.random.default_rng(6)
    of = np.concatenate([[0], rng.integers(1, maxent_lm.CLASSES, maxent_lm.UNITS - 1)])
    symbol = np.concatenate([np.arange(1 + maxent_lm.TOP), 1 + maxent_lm.TOP + of[1 + maxent_lm.TOP :]])
    weights, bias = rng.normal(size=(maxent_lm.BUCKETS, maxent_lm.CLASSES)), rng.normal(size=maxent_lm.CLASSES)
    tokens, distinct = rng.integers(5, 50, maxent_lm.CLASSES), rng.integers(1, 5, maxent_lm.CLASSES)
    model = maxent_lm.Model(of, symbol, weights, bias, tokens, distinct, 0.5)
    import pyarrow as pa

    units = [[0, 0, 0, *rng.integers(0, maxent_lm.UNITS, n), 0] for n in (0, 1, 7)]
    units[2][5] = -1 - units[2][5]  # never seen in training
    got = maxent_lm.scores(model, pa.array(units, pa.list_(pa.int16())), np.zeros(3))
    for have, x in zip(got, units, strict=True):
        want, plain = 0.0, [-1 - u if u < 0 else u for u in x]
        for j in range(3, len(x)):
            s1, s2, s3 = (int(symbol[plain[j - d]]) for d in (1, 2, 3))
            z = bias + sum(weights[f] for f in maxent_lm.features(np.array([(s1 * maxent_lm.SYMBOLS + s2) * maxent_lm.SYMBOLS + s3]))[0])
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            assert p.sum() == pytest.approx(1)
            k = of[plain[j]]
            want += math.log10(p[k] / tokens[k] * (0.5 * distinct[k] if x[j] < 0 else 1))
        assert have == pytest.approx(want)


def word_model(rng, rows):
    of = np.concatenate([[0], rng.integers(1, maxent_lm.CLASSES, maxent_lm.UNITS - 1)])
    symbol = np.concatenate([np.arange(1 + maxent_lm.TOP), 1 + maxent_lm.TOP + of[1 + maxent_lm.TOP :]])
    weights, bias = rng.normal(size=(maxent_lm.BUCKETS, maxent_lm.CLASSES)), rng.normal(size=maxent_lm.CLASSES)
    slot, kept = maxent_lm.slots(of, rng.random(maxent_lm.UNITS)), rng.random(maxent_lm.CLASSES**2) + 0.1
    choice = rng.normal(size=(maxent_lm.WORD_FEATURES, maxent_lm.WORD_BUCKETS * maxent_lm.CLASSES)).astype(np.float32) * rows
    halves = maxent_lm.halves(kept.reshape(maxent_lm.CLASSES, -1).T)
    return maxent_lm.Model(of, symbol, weights, bias, np.full(maxent_lm.CLASSES, 50), np.full(maxent_lm.CLASSES, 5), 0.5, slot, kept, halves, maxent_lm.added_up(weights, bias), choice)


def test_words_before_give_a_distribution_over_classes_and_slots():
    n, names = maxent_lm.CLASSES, np.array([7, 65000, 300, 12], np.uint16).view(np.int16)
    rows = maxent_lm.word_features(names, np.array([3]))
    for by_words in (0, 1):
        model = word_model(np.random.default_rng(7), by_words)
        pairs = np.arange(n * n)
        model.of, model.slot = pairs // n, pairs % n  # a unit for every class and slot
        context = np.full(n * n, 12345)
        second, z = maxent_lm.choices(model, context, np.repeat(rows, n * n, 1), pairs)
        p = np.exp(-np.logaddexp(0, np.where(second, -z, z)).astype(float))
        assert p.prod(0).sum() == pytest.approx(1, rel=1e-4)
        classes = p[: maxent_lm.DEPTH].prod(0).reshape(n, n)[:, 0]
        plain = np.exp(maxent_lm.class_logs(context[:1], model.weights, model.bias))[0]
        assert np.allclose(classes, plain, rtol=1e-4) == (not by_words)  # without weights of words the symbols' softmax


def test_lm_tells_apart_histories_of_rare_words(spark):
    """Words outside the commonest, with like endings and neighbours, decide which word follows."""
    rng = random.Random(8)
    fill = [f"w{k}" for k in range(maxent_lm.TOP + 5)]
    pairs = {f"{x}{y}zzz": follows for x, follows in (("a", "up"), ("b", "down")) for y in "klmn"}
    docs = []
    for i in range(3000):
        first = rng.choice(list(pairs))
        docs.append((i, " ".join([*rng.choices(fill, k=8), first, pairs[first], *rng.choices(fill, k=4)])))
    docs = [(i, t) for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(10000, 10100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    right, wrong = "w1 w2 akzzz up w3", "w1 w2 akzzz down w3"
    got = lm_rows(spark, docs + [(held[0], right), (held[1], wrong)]).set_index("doc_id")
    assert got.score[held[0]] > got.score[held[1]] + 0.3
    assert got.base_score[held[0]] == pytest.approx(got.base_score[held[1]], abs=0.1)


def test_lm_tasks_give_out_batches_of_bounded_size(monkeypatch):
    """a block's words and a task's events used to leave in one batch, whatever their number."""

    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    monkeypatch.setattr(maxent_lm, "TaskContext", type("Context", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})())}))
    texts = [" ".join(f"w{n}" for n in range(k * 50_000, (k + 1) * 50_000 + 1)) for k in range(4)]
    docs = pa.RecordBatch.from_arrays([pa.array(range(4), pa.int64()), pa.array([False, False, False, True]), pa.array(texts)], names=["id", "held", "text"])
    got = [b.to_pydict() for b in maxent_lm.numbered(Frame())(iter([docs]))]
    words_of = [b for b in got if b["kind"][0] == 0]
    assert max(len(b["code"]) for b in words_of) <= 1 << 16
    counts = {w: (c, n, u) for b in words_of for w, c, n, u in zip(b["word"], b["code"], b["n"], b["unit"], strict=True)}
    number = {w: c for w, (c, _, _) in counts.items()}
    assert len(counts) == 200_002 and sorted(number.values()) == list(range(200_002))
    assert [counts[w][1] for w in (b"w0", b"w50000", b"w150000", b"w150001", b"\n")] == [1, 2, 1, 0, 3]
    assert all(u == maxent_lm.unit(w) for w, (_, _, u) in counts.items())
    for b in (b for b in got if b["kind"][0] == 1):
        for i, n, codes in zip(b["id"], b["n"], b["codes"], strict=True):
            assert maxent_lm.unpacked(codes, n).tolist() == [number[w] for w in [b"\n"] * 3 + texts[i].encode().split() + [b"\n"]]

    rng = np.random.default_rng(9)
    of = np.concatenate([[0], rng.integers(1, maxent_lm.CLASSES, maxent_lm.UNITS - 1)])
    symbol = np.concatenate([np.arange(1 + maxent_lm.TOP), 1 + maxent_lm.TOP + of[1 + maxent_lm.TOP :]])
    sizes = [4, 100_000, 7, 70_000]
    units = rng.integers(0, maxent_lm.UNITS, sum(sizes))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    codes = maxent_lm.joined(np.where(units % 5, units, -1 - units), rng.integers(0, maxent_lm.NAMES, len(units)), offsets)
    monkeypatch.setattr(maxent_lm, "EVENTS", 90_000)
    found = list(maxent_lm._events(of, symbol)(iter([pa.RecordBatch.from_arrays([codes], names=["codes"])])))
    assert len(found) > 2 and max(b.num_rows for b in found) <= 1 << 16
    have, want = Counter(), Counter()
    for b in found:
        have.update(dict(zip(*b.to_pydict().values(), strict=True)))
    s = symbol[units]
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        at = np.arange(lo + 3, hi)
        want.update((((s[at - 1] * maxent_lm.SYMBOLS + s[at - 2]) * maxent_lm.SYMBOLS + s[at - 3]) * maxent_lm.CLASSES + of[units[at]]).tolist())
    assert have == want


def test_lm_segments_as_bytes_come_back_from_any_slice():
    units = np.array([0, -1, 5, -2112, 2111, 7, 63, 64, -65, 1, 2, 3])
    names = np.array([0, 65535, 32768, 32767, 1, 2, 3, 4, 5, 6, 7, 8], np.uint16)
    codes = maxent_lm.joined(units, names, np.array([0, 4, 5, 12]))
    for kind in (pa.binary(), pa.large_binary()):
        for lo, hi in ((0, 3), (1, 2), (1, 3), (2, 3)):
            got = maxent_lm.split(codes.cast(kind).slice(lo, hi - lo))
            for x, want in zip(got, (units, names.view(np.int16)), strict=True):
                assert x.to_pylist() == [want[a:b].tolist() for a, b in ((0, 4), (4, 5), (5, 12))[lo:hi]]


def test_new_queries_over_their_tables(spark, folder):
    got = queries.op12_maxent_lm(spark, folder)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}
    rows = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    docs = [(r["doc_id"], r["text"]) for r in rows]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    want = dict(zip([i for i, _ in docs], base_scores(docs, held), strict=True))
    for r in got.collect():
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and r["base_score"] == pytest.approx(base, rel=1e-9)
    assert dict(queries.op11_prefix_trie(spark, folder).dtypes)["conv_id"] == "bigint"
    assert dict(queries.op13_ranked_search(spark, folder).dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
