"""Quality rules, SimHash, packing, language, classifier: brute force and edge cases."""

import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airmill.llm import graph, language_id, packing, quality_model, quality_rules, queries, simhash, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "a"), (4, "a"), (5, "É\u00a0x\u2003y b\nb\n\nb"), (None, "b c d e"), (6, "w " * 30_000), (7, "A b\tc $#\n" * 400)]


def sentence(draw, n):
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 4))) for _ in range(n))


def base(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    spots = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    figures = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(spots))
    return (*figures, len(w) < 50 or 100 * len(spots) > 50 * len(w))


def test_base_figures_against_brute_force(docs):
    draw = random.Random(3)
    rows = ODD + [(10 + k, sentence(draw, draw.randint(0, 90)) + draw.choice(["", "\n", "\n a b c", "*&"])) for k in range(120)]
    got = quality_rules.judge(docs(rows)).select("doc_id", *quality_rules.FIGURES, "base_failed").collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *base(t)) for i, t in rows)


def test_lines_above_the_limit_deplete_but_copies_do_not(docs):
    draw = random.Random(4)
    notice = "all rights of this notice are ours " * 20
    rows = [(k, sentence(draw, 60) + "\n" + notice) for k in range(40)]  # 140 of 200 words are boilerplate
    rows += [(100 + k, sentence(draw, 300)) for k in range(40)]
    copied = sentence(draw, 300) + "\n" + sentence(draw, 80)
    rows += [(200 + k, copied) for k in range(60)]
    got = {r["doc_id"]: (r["depleted"], r["kept"]) for r in quality_rules.judge(docs(rows)).collect()}
    assert all(got[k][0] for k in range(40))
    assert not any(got[k][0] for k in got if k >= 100)
    kept = {r["doc_id"] for r in quality_rules.keep(docs(rows)).collect()}
    assert kept == {k for k, (_, ok) in got.items() if ok}


def brute_depleted(rows):
    """(doc_id) of rows over (doc_id, text, host) whose lines above the limit hold more than half of their words."""
    lines = {(h, t): [x for x in (re.sub(r"[\x20\t\x0b-\r]+", " ", re.sub("[0-9]", "0", t.lower())).split("\n")) if x.strip()] for _, t, h in rows}
    lines = {k: [x.strip() for x in v] for k, v in lines.items()}
    held, hosts = Counter((h, x) for (h, _), v in lines.items() for x in set(v)), Counter(h for h, _ in lines)
    over = {k for k, n in held.items() if n > max(30, 0.003 * hosts[k[0]])}
    size = lambda v: sum(x.count(" ") + 1 for x in v)
    return {i for i, t, h in rows if size(x for x in lines[h, t] if (h, x) not in over) < 0.5 * size(lines[h, t])}


@pytest.mark.parametrize("shared", [2, 3])
def test_several_long_shared_lines_deplete_against_brute_force(docs, shared):
    draw = random.Random(14)
    notices = [sentence(draw, n) for n in (70, 60, 50)[:shared]]  # each longer than any own line
    rows = [(k, "\n".join([*(sentence(draw, 10) for _ in range(4)), *notices]), "s") for k in range(60)]
    rows += [(100 + k, "\n".join([*(sentence(draw, 15) for _ in range(12)), notices[0]]), "s") for k in range(40)]
    rows += [(200 + k, "\n".join([*(sentence(draw, 10) for _ in range(4)), *notices]), "few") for k in range(20)]
    rows += [(300 + k, rows[0][1], "few") for k in range(60)]  # copies of one text: one more document
    frame = docs([r[:2] for r in rows]).withColumn("source", F.when(F.col("doc_id") < 200, "s").otherwise("few"))
    got = {r["doc_id"] for r in quality_rules.judge(frame).where("depleted").collect()}
    assert got == brute_depleted(rows) == set(range(60))


def test_quality_of_empty_table_and_null_host(docs, spark):
    assert quality_rules.judge(docs([])).count() == 0
    nulls = docs([(1, "x y z " * 40), (2, None)]).withColumn("source", F.lit(None).cast("string"))
    assert quality_rules.judge(nulls).count() == 2
    assert quality_rules.keep(docs([(1, sentence(random.Random(1), 90))])).columns == ["doc_id", "text", "lang", "source", "kept"]


def brute_fingerprint(text, width=3):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + width]).encode(), seed=42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_groups_against_brute_force(docs, spark):
    draw = random.Random(5)
    rows = list(ODD)
    for k in range(60):
        text = sentence(draw, 200)
        rows.append((100 + 3 * k, text))
        rows.append((101 + 3 * k, text.replace(" a", " b", draw.randint(0, 2))))
        rows.append((102 + 3 * k, text.upper()))
    got = simhash.groups(docs(rows)).collect()
    prints = {(i, t): brute_fingerprint(t) for i, t in rows}
    assert Counter((r["doc_id"], r["fp"] % 2**64) for r in got) == Counter((i, prints[i, t]) for i, t in rows)
    ids, values = [i for i, _ in rows], [prints[x] for x in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if bin(values[a] ^ values[b]).count("1") <= 3 and label[a] != label[b]:
                label = [label[b] if x == label[a] else x for x in label]
    least = {x: min((ids[k] for k in range(len(rows)) if label[k] == x and ids[k] is not None), default=None) for x in set(label)}
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((ids[k], least[label[k]]) for k in range(len(rows)))
    kept = simhash.keep_first(docs(rows)).collect()
    assert len(kept) == len(set(label))
    assert {r["doc_id"] for r in kept} == set(least.values())


def test_large_tiles_are_cut_without_losing_links(spark):
    draw = np.random.default_rng(6)
    centres = draw.integers(0, 2**63, 12)
    values = np.unique(np.concatenate([centres ^ (1 << draw.integers(0, 62, 12)) ^ (1 << draw.integers(0, 62, 12)) for _ in range(60)] + [centres]))
    edges = simhash.links(spark.createDataFrame([(int(v),) for v in values], "fp long"), replace(simhash.EXACT, tile=8))
    got = {r["node"]: r["label"] for r in graph.components(edges).collect()}
    a, b = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    label = simhash.forest(len(values), a, b)
    assert all(got.get(int(v), int(v)) == int(values[label == x].min()) for v, x in zip(values, label, strict=True))


def test_long_fingerprints_catch_near_copies_and_leave_others(docs):
    draw = random.Random(8)
    rows, shared = [], sentence(draw, 60)
    for k in range(40):
        text = sentence(draw, 240).split()
        changed = text.copy()
        for at in draw.sample(range(240), 3):  # similarity of about 0.88
            changed[at] = "zz"
        rows += [(1000 + 10 * k, " ".join(text)), (1001 + 10 * k, " ".join(changed)), (1002 + 10 * k, " ".join(text))]
        rows.append((1003 + 10 * k, sentence(draw, 200) + " " + shared))  # shares a passage only
    kept = {r["doc_id"] for r in simhash.keep_first(docs(rows), width=5, near=simhash.WIDE).collect()}
    assert kept == {i for i, _ in rows if i % 10 in (0, 3)}
    odd = simhash.groups(docs(ODD), width=5, near=simhash.WIDE).collect()
    assert len(odd) == len(ODD)
    assert {r["component_id"] for r in odd if r["doc_id"] in (1, 2, 3)} == {1}
    assert simhash.keep_first(docs([]), near=simhash.WIDE).count() == 0


@pytest.mark.parametrize("tile", [8, simhash.WIDE.tile])
def test_long_fingerprints_against_brute_force(spark, tile):
    draw = np.random.default_rng(9)
    bits = np.repeat(draw.integers(0, 2, (9, 256), np.uint8), 12, axis=0)
    bits ^= (draw.random(bits.shape) < 0.05).astype(np.uint8)
    words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
    near = replace(simhash.WIDE, tile=tile)
    frame = spark.createDataFrame([(i, *map(int, w)) for i, w in enumerate(words)], "fp long, " + ", ".join(f"{c} long" for c in near.columns))
    keys = simhash.tile_keys(words.view(np.uint64), near)
    places = 1 << np.arange(simhash.KEY_BITS)
    want = np.stack([bits[:, list(s)] @ places + (k << simhash.KEY_BITS) for k, s in enumerate(near.spots)], axis=1)
    assert np.array_equal(keys, want)
    far = (bits[:, None] != bits[None]).sum(2)
    a, b = np.nonzero((far <= near.radius) & (want[:, None] == want[None]).any(2))
    label = simhash.forest(len(bits), a, b)
    got = {r["node"]: r["label"] for r in graph.components(simhash.links(frame, near)).collect()}
    assert [got.get(i, i) for i in range(len(bits))] == label.tolist()


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[k] for k in range(51)} == {0} and {got[k] for k in range(100, 160)} == {100}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def check_pieces(pieces, texts, tokenizer, window=4096):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == window or at & (at - 1) == 0  # no padding at all
    return by_sequence


def test_packing_places_every_id_once(docs):
    draw = random.Random(7)
    path = public_tokenizers.path(queries.WORD_BPE)
    rows = [(k, sentence(draw, draw.choice([0, 1, 3, 50, 400, 3000]))) for k in range(80)]
    rows += [(1000, None), (1001, "  "), (1002, "it's A.B...!! 12 É<|endoftext|>x \u00a0 Σας " * 3), (1003, "x" * 20_000)]
    got = packing.pack(docs(rows).repartition(3), path).collect()
    check_pieces(got, rows, Tokenizer.from_file(path))
    assert packing.pack(docs([]), path).count() == 0
    again = packing.pack(docs([(1, "a b"), (1, "a b")]).coalesce(1), path, ids=True).collect()
    assert sum(r["length"] for r in again) == 6 and sorted(r["ids"][-1] for r in again if r["start"] + r["length"] == 3) == [2, 2]


def test_packer_chooses_by_sum_of_squares():
    draw = np.random.default_rng(8)
    p = packing.Packer(window=16, most_open=1000)
    for k in range(300):
        size = int(draw.integers(1, 16))
        costs = {}
        for h in [0, *range(1, 17 - size)]:
            if h and not p.level[h]:
                continue
            n = p.level.copy()
            n[0] = 0
            if h:
                n[h] -= 1
            if h + size < 16:
                n[h + size] += 1
            costs[h] = int((n * n).sum())
        chosen = p._choose(size)
        assert costs[chosen] == min(costs.values())
        list(p.put((k, size), np.zeros(size, packing.ID)))
    assert p.open == p.level.sum()


def test_open_windows_are_bounded():
    p = packing.Packer(window=100, most_open=5)
    out = [x for k in range(200) for x in p.put((k, 60), np.full(60, k, packing.ID))]
    assert p.open <= 6
    out += list(p.finish())
    assert sum(len(x[2]) for x in out) == 200 * 60


def test_words_and_memo():
    offsets, codes, found = words.split(pa.array(["A b a", None, "", "b"]))
    assert offsets.tolist() == [0, 3, 3, 3, 4] and [found[c] for c in codes] == [b"a", b"b", b"a", b"b"]
    asked = []
    memo = words.Memo(lambda x: asked.extend(x) or [w * 2 for w in x], limit=4)
    for k in range(30):
        assert memo([k, k + 1]) == [2 * k, 2 * k + 2]
    assert len(memo.young) + len(memo.old) <= 8


def test_workers_give_arrow_memory_back(monkeypatch):
    """What Arrow's allocator would keep is given back after each batch, and at the end with a task's last arrays gone."""
    seen, start = [], pa.total_allocated_bytes()
    monkeypatch.setattr(words, "release", lambda: seen.append(pa.total_allocated_bytes() - start))
    size = packing.BATCH * 100

    def batches():
        for _ in range(3):
            yield pa.record_batch([pa.array(range(packing.BATCH)), pa.array(["ab " * 33 + "c"] * packing.BATCH)], ["doc_id", "text"])

    counts = words.lean(lambda x: (pa.record_batch([pa.array([b.num_rows])], ["n"]) for b in x))(batches())
    assert sum(b.column(0)[0].as_py() for b in counts) == 3 * packing.BATCH
    assert len(seen) == 4 and seen[-1] < 1000 < size <= min(seen[:-1])


def test_language_evidence(docs, spark):
    english, german = "the and of with this that there", "der und die nicht auf eine schon"
    draw = random.Random(9)
    rows = [(k, " ".join(draw.choices(english.split(), k=20)), "en", "a.example.uk") for k in range(60)]
    rows += [(100 + k, " ".join(draw.choices(german.split(), k=20)), "de", "b.example.de") for k in range(60)]
    rows += [(200, "die", None, "b.example.de"), (201, "the and that this with", "de", "b.example.de"), (202, None, "en", None), (203, "12 !!", "en", "a.example.uk")]
    rows += [(204, "中文字符測試" * 20, None, "a.example.uk"), (205, "un", "de", "new.example.de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("posterior", F.lit("clash"))
    got = {r["doc_id"]: r for r in language_id.identify(frame, languages=("de", "en")).collect()}
    assert all(got[k]["language"] == ("en" if k < 100 else "de") for k in got if k < 200)
    assert got[200]["language"] == "de"  # by host and suffix
    assert got[201]["language"] == "en"  # text over declaration
    assert got[205]["language"] == "de"  # a host never seen, by its suffix and declaration
    assert [got[k]["known"] for k in (202, 203, 204)] == [False] * 3
    kept = {r["doc_id"] for r in language_id.keep(frame, languages=("de", "en")).collect()}
    assert kept == set(got) - {202, 203, 204}
    assert language_id.identify(frame.limit(0)).count() == 0


def test_language_model_is_a_multinomial(spark):
    frame = spark.createDataFrame([("ab ab", "de"), ("cd", "en"), (None, "en"), ("x", None)], "text string, lang string")
    model = language_id.fit(frame, "text", "lang", ("de", "en"))
    assert np.allclose(np.exp(model).sum(0), 1, atol=1e-3)
    at = np.concatenate(list(language_id.trigrams(b"AB, cd")))
    assert len(at) == 4  # a letter each


@pytest.mark.parametrize("text", [b"", b"  ", b"abc def", "äö ü".encode()])
def test_trigrams_do_not_depend_on_slabs(text, monkeypatch):
    whole = [x for a in language_id.trigrams(text) for x in a]
    monkeypatch.setattr(language_id, "SLAB", 2)
    assert [x for a in language_id.trigrams(text) for x in a] == whole


def test_quality_model_learns_and_handles_odd_texts(docs, spark):
    draw = random.Random(10)
    rows = [(k, sentence(draw, 60) if k % 2 else " ".join(w.upper() + "!!" for w in sentence(draw, 60).split())) for k in range(300)]
    labelled = docs(rows[:200]).withColumn("quality", (F.col("doc_id") % 2).cast("int"))
    labels = labelled.unionByName(docs([(900, "zz")]).withColumn("quality", F.lit(None).cast("int"))).select("doc_id", "quality")
    weights = quality_model.fit(docs(rows), labels)
    got = {r["doc_id"]: r["score"] for r in quality_model.score(docs(rows + ODD), weights).collect()}
    assert all((got[k] > 0.5) == bool(k % 2) for k in range(200, 300))
    assert all(0 <= x <= 1 for x in got.values())
    none = quality_model.fit(docs(rows), labels.limit(0))
    assert not none.any() and quality_model.score(docs([]), none).count() == 0


def test_quality_model_steps_against_plain_loops():
    draw = np.random.default_rng(11)
    rows = [(np.unique(draw.integers(1, 40, 6)), None, int(draw.integers(0, 2))) for _ in range(50)]
    rows = [(a, draw.random(len(a)), y) for a, _, y in rows]
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= quality_model.L1:
            return 0.0
        return -(zi - np.sign(zi) * quality_model.L1) / ((quality_model.BETA + np.sqrt(n[i])) / quality_model.ALPHA + quality_model.L2)

    for at, value, y in rows:
        w = [weight(i) for i in at]
        p = 1 / (1 + np.exp(-np.dot(w, value)))
        for i, v, wi in zip(at, value, w, strict=True):
            g = (p - y) * v
            s = (np.sqrt(n.get(i, 0.0) + g * g) - np.sqrt(n.get(i, 0.0))) / quality_model.ALPHA
            z[i], n[i] = z.get(i, 0.0) + g - s * wi, n.get(i, 0.0) + g * g
    got = quality_model.train(rows, passes=1)
    assert np.allclose([got[i] for i in range(40)], [weight(i) if i in z else 0 for i in range(40)], atol=1e-6)
