"""Toxicity, quality and language: held-out accuracy, and the models against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import EDGES, LABELS, LONG, documents, prose
from tradepath.llm import language, quality, symbols, toxicity


def crc(key, folds):
    return zlib.crc32(str(key).encode()) % folds


def labelled(spark, rows):
    return spark.createDataFrame([(k, q, t, 1.0, "x") for k, q, t in rows], LABELS)


BAD = ["grobnik", "flumox", "zatch", "yukkle"]


def toxic_corpus(n=500):
    docs, labels = [], []
    for i in range(n):
        words = prose(i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            draw = random.Random(i)
            for _ in range(5):
                words.insert(draw.randrange(60), draw.choice(BAD))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def auc(scores, truth):
    order = sorted(zip(scores, truth))
    ranks = [i + 1 for i, (_, t) in enumerate(order) if t]
    n1, n0 = len(ranks), len(order) - len(ranks)
    return (sum(ranks) - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_toxicity_held_out(spark):
    docs, labels = toxic_corpus()
    # the operator may not look at the labels of held-out rows: they are turned round here
    shown = [(k, q, 1 - t if crc(k, 5) == 0 else t) for k, q, t in labels]
    rows = toxicity.score(documents(spark, docs), labelled(spark, shown)).collect()
    assert len(rows) == len(docs)
    truth = {k: t for k, _, t in labels}
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert auc([r["score"] for r in held], [truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.9


def letters_of(text):
    out = [0]
    for c in text.lower():
        s = ord(c) if c.isalpha() else 0
        if s or out[-1]:
            out.append(s % ((1 << symbols.SYMBOL_BITS) - 1) + 1 if s else 0)
    return out + ([0] if out[-1] else [])


def test_kneser_ney_against_plain(spark):
    """Log ratios of n-grams and contexts, from dictionaries."""
    order, d = toxicity.ORDER, toxicity.DISCOUNT
    texts = [("you zatch you grobnik, you", 1), ("the cat sat on the mat, you cat", 0),
             ("on and on the zatch sat", 1), ("a mat, a cat, and a hat", 0)]
    count = {0: Counter(), 1: Counter()}
    for text, label in texts:
        s = letters_of(text)
        count[label].update(tuple(s[i:i + order]) for i in range(len(s) - order + 1))
    types = {order: set(count[0]) | set(count[1])}
    lower = {}
    for k in range(order - 1, 0, -1):
        lower[k] = Counter(g[1:] for g in types[k + 1])
        types[k] = set(lower[k])

    def shared(g):
        k = len(g)
        if k == 1:
            total = sum(lower[1].values())
            return (lower[1][g] - d) / total + d * len(lower[1]) / total / 2**symbols.SYMBOL_BITS
        among = [n for x, n in lower[k].items() if x[:-1] == g[:-1]]
        return (lower[k][g] - d + d * len(among) * shared(g[1:])) / sum(among)

    def freed(label, context):
        among = [n for x, n in count[label].items() if x[:-1] == context]
        return d * len(among) / sum(among) if among else 1.0

    def p(label, g):
        total = sum(n for x, n in count[label].items() if x[:-1] == g[:-1])
        seen = max(count[label][g] - d, 0) / total if total else 0.0
        return seen + freed(label, g[:-1]) * shared(g[1:])

    train = spark.createDataFrame(texts, "text string, label int")
    rows = toxicity.log_ratios(toxicity.counts(train, "text", "label")).collect()

    def unpack(key, k):
        return tuple((key >> (symbols.SYMBOL_BITS * i)) & (2**symbols.SYMBOL_BITS - 1)
                     for i in range(k - 1, -1, -1))

    grams = {unpack(r["key"], order): r["ratio"] for r in rows if r["kind"] == 0}
    assert set(grams) == types[order]
    for g, ratio in grams.items():
        assert ratio == pytest.approx(math.log(p(1, g) / p(0, g)), abs=1e-9)
    for r in rows:
        if r["kind"] == 1:
            c = unpack(r["key"], order - 1)
            assert r["ratio"] == pytest.approx(math.log(freed(1, c) / freed(0, c)), abs=1e-9)
    # the measure of a text is the sum over its n-grams
    model = toxicity._folded(toxicity.log_ratios(toxicity.counts(train, "text", "label")), 16)
    text = "zatch you cat on"
    row = toxicity.measured(train.limit(1).selectExpr(f"'{text}' AS text"), model, "m",
                            bits=16).first()["m"]
    s = letters_of(text)
    want = 0.0
    for i in range(len(s) - order + 1):
        g = tuple(s[i:i + order])
        want += grams[g] if g in grams else math.log(freed(1, g[:-1]) / freed(0, g[:-1]))
    assert row["length"] == len(s) - order + 1
    assert row["total"] == pytest.approx(want, abs=1e-4)
    assert sum(row["strong"]) == pytest.approx(want, abs=1e-4)  # a few words, all of them


@pytest.mark.parametrize("bits", [16, 5, 0])
def test_ratios_go_by_exact_keys(spark, bits):
    """Also if nearly all n-grams are left to the join; known, unknown and repeated texts."""
    docs, labels = toxic_corpus(60)
    train = spark.createDataFrame([(t, lab[2]) for (_, t), lab in zip(docs, labels)],
                                  "text string, label int")
    ratios = toxicity.log_ratios(toxicity.counts(train, "text", "label")).collect()
    grams, contexts = ({r["key"]: r["ratio"] for r in ratios if r["kind"] == k} for k in (0, 1))
    assert len(grams) > 1000
    rows = [(r[0], r[1]) for r in EDGES if r[1] is not LONG]
    rows += docs[:8] + docs[:2] + [(500 + i, prose(i, 40)[::-1]) for i in range(20)]
    model = toxicity._folded(toxicity.log_ratios(toxicity.counts(train, "text", "label")), bits)
    out = toxicity.measured(documents(spark, rows), model, "m", bits=bits)
    assert out.columns == documents(spark, []).columns + ["m"]
    want = []
    for key, text in rows:
        s, words, total, n = letters_of(text or ""), defaultdict(float), 0.0, 0
        word = 0
        for i in range(len(s)):
            word += s[i] == 0
            if i >= toxicity.ORDER - 1:
                g = 0
                for x in s[i - toxicity.ORDER + 1:i + 1]:
                    g = (g << symbols.SYMBOL_BITS) | x
                context = g >> symbols.SYMBOL_BITS
                g -= (g >> 63) << 64  # as a signed number
                ratio = grams[g] if g in grams else contexts.get(context, 0.0)
                words[word] += ratio
                total += ratio
                n += 1
        want.append((key, text, n, total, sorted(words.values(), reverse=True)[:8]))
    got = [(r["doc_id"], r["text"], r["m"]["length"], r["m"]["total"], r["m"]["strong"])
           for r in out.collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: str(r[:3])), sorted(want, key=lambda r: str(r[:3]))):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3], abs=1e-4)
        assert g[4] == pytest.approx(w[4], abs=1e-6)


def test_few_toxic_words_in_long_texts(spark):
    """Three toxic words among hundreds of others, in a language with few labelled rows."""
    docs, labels = toxic_corpus(400)
    for i in range(1000, 1240):
        words = " ".join("ñü" + w for w in prose(i, 300).split()).split()
        if i % 3 == 0:
            draw = random.Random(i)
            for _ in range(3):
                words.insert(draw.randrange(300), draw.choice(["gröbnü", "flümöx"]) + draw.choice(["", "es", "ung"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 3 == 0)))
    truth = {k: t for k, _, t in labels}
    rows = toxicity.score(documents(spark, docs), labelled(spark, labels)).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] >= 1000]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95


def test_counts_cover_the_rows_that_the_sample_leaves(spark, monkeypatch):
    """A toxic word that only rows of the calibration fold have, beyond the sample, is learnt."""
    docs, labels = toxic_corpus(400)
    fold_1 = [i for i, _ in docs if crc(i, 5) == 1]
    toxic = dict((k, t) for k, _, t in labels)
    docs = [(i, text + " qwoxkyj qwoxkyj" if i in fold_1 and toxic[i] else text) for i, text in docs]
    read = []
    count = toxicity.counts

    def counts(train, text, label):
        read.extend((r[0], r[1]) for r in train.select("doc_id", text).collect())
        return count(train, text, label)

    monkeypatch.setattr(toxicity, "counts", counts)
    frame = documents(spark, docs + [(9000, "qwoxkyj qwoxkyj qwoxkyj")] + docs[:3])
    rows = toxicity.score(frame, labelled(spark, labels), calibration=20).collect()
    assert next(r["measure"] for r in rows if r["doc_id"] == 9000) > 0.5
    # all labelled rows but the held-out ones and those of the sample
    allowed = [d for d in docs + docs[:3] if crc(d[0], 5) != 0]
    left = [d for d in allowed if d not in read]
    assert len(left) >= 20 and len(set(left)) == 20 and {k for k, _ in left} <= set(fold_1)
    assert sorted(read) == sorted(d for d in allowed if d not in left)


def test_toxicity_edges(spark):
    docs, labels = toxic_corpus(200)
    edges = [(r[0] if r[0] is None else r[0] + 1000, *r[1:]) for r in EDGES]
    shown = labels + [(1001, 1, 1), (1002, 0, None), (None, 1, 1), (0, 1, 0), (0, 1, 1)]
    frame = documents(spark, docs + edges)
    rows = toxicity.score(frame, labelled(spark, shown)).collect()
    assert len(rows) == len(docs) + len(edges)
    assert len({r["score"] for r in rows if r["doc_id"] in (1001, 1002)}) == 1
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    kept = toxicity.drop_toxic(frame, labelled(spark, shown))
    assert kept.columns == frame.columns
    assert kept.count() == sum(r["predicted"] == 0 for r in rows)


def test_toxicity_without_training_rows(spark):
    docs = documents(spark, EDGES)
    rows = toxicity.score(docs, labelled(spark, [])).collect()
    assert len(rows) == len(EDGES) and {r["score"] for r in rows} == {0.0}
    assert toxicity.score(documents(spark, []), labelled(spark, [(1, 1, 1)])).collect() == []


def junk(seed):
    draw = random.Random(seed)
    kind = seed % 3
    if kind == 0:
        return " ".join(w for w in prose(seed, 8).split() for _ in range(draw.randint(5, 30)))
    if kind == 1:
        return "!! ".join(prose(seed, 80).upper().split())
    return " ".join(str(draw.randrange(10**6)) + "|" for _ in range(70))


def test_quality_held_out(spark):
    docs = [(i, junk(i) if i % 5 == 0 else prose(i, 40 + i % 90)) for i in range(600)]
    truth = {i: int(i % 5 != 0) for i, _ in docs}
    shown = [(k, 1 - q if crc(k, 3) == 1 else q, 0) for k, q in truth.items()]
    edges = [(r[0] if r[0] is None else r[0] + 1000, *r[1:]) for r in EDGES]
    rows = quality.score(documents(spark, docs + edges), labelled(
        spark, shown + [(1001, None, 0), (None, 1, 0)])).collect()
    assert len(rows) == len(docs) + len(edges)
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) for r in rows if r["doc_id"] is not None)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 1000]
    assert auc([r["score"] for r in held], [truth[r["doc_id"]] for r in held]) > 0.98
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert len({r["score"] for r in rows if r["doc_id"] in (1001, 1002)}) == 1


def test_threshold_and_spread_cover_all_training_rows(spark, monkeypatch):
    docs = [(i, junk(i) if i % 5 == 0 else prose(i, 40 + i % 90)) for i in range(400)]
    labels = [(i, int(i % 5 != 0 or i % 3 == 0), 0) for i, _ in docs]
    seen = []
    expansion = quality.Expansion.__init__

    def watched(self, *given):
        expansion(self, *given)
        seen.append(self)

    monkeypatch.setattr(quality.Expansion, "__init__", watched)
    rows = quality.score(documents(spark, docs), labelled(spark, labels), per_class=20).collect()
    train = [i for i, _ in docs if crc(i, 3) != 1]
    x = quality.text_features([docs[i][1] for i in train])
    assert seen[0].centre == pytest.approx(x.mean(0), rel=1e-9, abs=1e-12)
    assert seen[0].scale == pytest.approx(x.std(0) + 1e-9, rel=1e-9, abs=1e-12)
    # the training row of the rank that the labels name has the strength 0
    strength = {r["doc_id"]: r["strength"] for r in rows}
    low = sum(labels[i][1] == 0 for i in train)
    assert sorted(strength[i] for i in train)[low - 1] == 0
    assert sum(r["predicted"] == 0 for r in rows if r["doc_id"] in train) == low - 1


def test_threshold_by_rank(spark):
    values = [1e-9, 0.1, 0.1, 0.1, 0.30000000000000004, 0.3, -5.0, 7.25]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for rank, v in enumerate(sorted(values), 1):
        assert quality.threshold(rows, "v", rank, len(values)) == v


def test_quality_without_training_rows(spark):
    rows = quality.score(documents(spark, EDGES), labelled(spark, [(4, 1, 0)])).collect()
    assert len(rows) == len(EDGES) and {r["score"] for r in rows} == {0.5}
    assert quality.score(documents(spark, []), labelled(spark, [])).collect() == []


def test_features_against_plain():
    texts = ["The cat. the CAT; the cat\nthe end\nthe end\n", "", None, "x", "1 2 3!!", prose(3, 90)]
    got = quality.text_features(texts)
    at = quality.FEATURES.index
    for text, row in zip(texts, got):
        t = text or ""
        words = "".join(c if c.isalnum() else " " for c in t.lower()).split()
        triples = list(zip(words, words[1:], words[2:]))
        lines = t.split("\n")[:-1] if t.endswith("\n") else t.split("\n") if t else []
        assert row[at("size")] == pytest.approx(math.log1p(len(t)))
        assert row[at("distinct_words")] == pytest.approx(len(set(words)) / max(1, len(words)))
        assert row[at("repeats_word")] == pytest.approx(
            sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)))
        assert row[at("distinct_triples")] == pytest.approx(len(set(triples)) / max(1, len(triples)))
        assert row[at("distinct_lines")] == pytest.approx(len(set(lines)) / max(1, len(lines)))
        assert row[at("top_word")] == pytest.approx(
            max(Counter(words).values(), default=0) / max(1, len(words)))
        assert row[at("capitals")] == pytest.approx(
            sum(c.isalpha() and c != c.lower() for c in t) / max(1, sum(map(str.isalpha, t))))


def test_preferences_give_the_order():
    draw = np.random.default_rng(1)
    truth = np.array([2.0, -1.0, 0.0])
    x = draw.normal(size=(4000, 3))
    high = x @ truth + draw.logistic(size=4000) > 0
    w = quality.preference_weights(x[high], x[~high])
    assert w @ truth / np.linalg.norm(w) / np.linalg.norm(truth) > 0.99


TONGUES = {"aa": "bakolumi", "bb": "stergwhn", "cc": "жизньдом", "dd": "שלוםבית"}


def tongue(lang, seed, n):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(TONGUES[lang], k=draw.randint(2, 7))) for _ in range(n))


def test_language_spans(spark):
    langs = list(TONGUES)
    docs = [(i, tongue(langs[i % 4], i, 60), langs[i % 4], "s") for i in range(200)]
    mixed = [(1000 + i, tongue("aa", i, 40) + ". " + tongue("bb", i, 15) + ", " + tongue("cc", i, 20),
              None, "s") for i in range(20)]
    edges = [(r[0] if r[0] is None else r[0] + 2000, r[1], None, "s") for r in EDGES]
    frame = documents(spark, docs + mixed + edges)
    rows = language.identify(frame).collect()
    assert len(rows) == len(docs) + len(mixed) + len(edges)
    by = {r["doc_id"]: r for r in rows}
    truth = {i: lang for i, _, lang, _ in docs}
    assert all(by[i]["lang_pred"] == lang for i, lang in truth.items())
    assert all(by[1000 + i]["lang_pred"] == "aa" and by[1000 + i]["n_spans"] == 3 for i in range(20))
    for key in (2001, 2002, 2003, 2005):
        assert (by[key]["lang_pred"], by[key]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) for r in rows if r["doc_id"] is not None)
    # spans begin and end with the passages
    model = language.train(frame.where("lang IS NOT NULL"), "text", "lang")
    spans = language.label_spans(frame.where("doc_id = 1000"), model).first()["spans"]
    text = dict((r[0], r[1]) for r in mixed)[1000]
    assert [text[s["start"]:s["end"]] for s in spans] == [
        tongue("aa", 0, 40), tongue("bb", 0, 15), tongue("cc", 0, 20)]


def test_language_without_training_rows(spark):
    rows = language.identify(documents(spark, [(1, "text", None, "s"), (2, None, "en", "s")])).collect()
    assert {r["lang_pred"] for r in rows} == {"und"}
    assert language.identify(documents(spark, [])).collect() == []


def test_viterbi_against_all_paths():
    draw = np.random.default_rng(3)
    sizes = np.array([4, 0, 1, 5, 3])
    scores = draw.normal(size=(sizes.sum(), 3)) * 3
    got = language.viterbi(scores, sizes, 2.0)
    at = 0
    for n in sizes:
        part = scores[at:at + n]
        paths = np.array(np.meshgrid(*[range(3)] * n)).T.reshape(-1, n) if n else np.zeros((0, 0), int)
        if n:
            value = [sum(part[i, p[i]] for i in range(n)) - 2.0 * (p[1:] != p[:-1]).sum() for p in paths]
            assert (paths[int(np.argmax(value))] == got[at:at + n]).all()
        at += n


def test_counts_by_text_number():
    words, of = symbols.word_hashes(np.array([ord(c) for c in "ab abab"], np.uint32),
                                    np.array([0, 0, 0, 0, 0, 1, 1]))
    groups = defaultdict(set)
    for w, o in zip(words, of):
        groups[int(o)].add(int(w))
    assert len(words) == 3 and len(groups[0]) == 1 and groups[1] == groups[0]
