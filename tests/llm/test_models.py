"""Toxicity, quality and url models: gradients, held-out accuracy, defined results on odd input."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import quality, toxicity, url_filter
from riskloom.llm.common import fold


@pytest.fixture
def short_training(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 60)
    monkeypatch.setattr(toxicity, "BATCH", 64)


def rude_rows(n, seed=1):
    rng = random.Random(seed)
    calm = [f"word{k}" for k in range(60)]
    rows = []
    for k in range(n):
        words = [rng.choice(calm) for _ in range(rng.randrange(1, 90))]
        bad = k % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["zorkish", "zorkful", "zork"]))
        rows.append((k, " ".join(words), int(bad)))
    return rows


def test_gradients_are_those_of_the_loss():
    toxic = toxicity.Network({"a": 1, "b": 2})
    toxic.p = {k: v.astype(np.float64) for k, v in toxic.p.items()}
    features = toxicity.word_features(["a", "b", "unknown"], toxic.known)
    place = np.full((toxicity.WINDOW, 3), -1)
    place[:5, 0], place[:2, 1], place[:3, 2] = [0, 1, 2, 2, 0], [2, 1], [1, 1, 0]
    label, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        logit = toxic.forward(toxic.projected(features), place)[0]
        p = toxicity.sigmoid(logit)
        return -(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum() / weight.sum()

    grads = toxic.gradients(features, place, label, weight)
    rng = np.random.default_rng(0)
    for name, value in toxic.p.items():
        at = tuple(rng.integers(0, s) for s in value.shape)
        if name in ("words", "grams"):
            at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        held = value[at]
        value[at] = held + 1e-3
        up = loss()
        value[at] = held - 1e-3
        down = loss()
        value[at] = held
        assert abs((up - down) / 2e-3 - grads[name][at]) < 2e-3, name


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 500, 501):
        numbers = np.arange(n)
        windows = toxicity.Windows([numbers])
        place, owner = windows.place(slice(None)), windows.owner
        counts = np.bincount(place[place >= 0], minlength=n) if n else np.zeros(0)
        assert (counts >= 1).all() and len(owner) == place.shape[1] >= 1
        if n > 2 * toxicity.WINDOW:
            assert (counts[toxicity.STRIDE : n - toxicity.WINDOW] == 2).all()


def test_windows_of_several_texts_do_not_mix():
    numbers = [np.arange(5), np.arange(0), 10 + np.arange(toxicity.WINDOW + 3), np.array([7])]
    windows = toxicity.Windows(numbers)
    place = windows.place(np.arange(len(windows)))
    for k, own in enumerate(numbers):
        mine = place[:, windows.owner == k]
        assert set(mine[mine >= 0].tolist()) == set(own.tolist())
    assert (windows.size == (place >= 0).sum(axis=0)).all()


def test_one_text_of_a_million_words_is_learnt_within_bounds(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 6)
    rows = rude_rows(60)
    long = " ".join(["zork calm word1 word2"] * 250_000)
    tracemalloc.start()
    model = toxicity.train(iter([long, *(t for _, t, _ in rows)]), [1, *(y for _, _, y in rows)], {0: 45, 1: 16}, 6, 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 and model.network is not None
    frame = spark.createDataFrame([(-1, long), *((k, t) for k, t, _ in rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(-1, 1), *((k, y) for k, _, y in rows)], "doc_id long, label int")
    assert frame.count() == len([r for r in toxicity.toxicity_scores(frame, labels).collect() if 0 <= r.score <= 1])


def test_a_window_scores_as_a_plain_loop_does():
    network = toxicity.Network({"a": 1, "b": 2})
    features = toxicity.word_features(["a", "b", "unknown"], network.known)
    x, p, size = network.inputs(features), network.p, toxicity.STATE

    def states(order, side):
        h, out = np.zeros(size), {}
        for t in order:
            gates = x[words[t]] @ p[f"in_{side}"] + p[f"bias_{side}"]
            w = p[f"state_{side}"]
            z = 1 / (1 + np.exp(-(gates[:size] + h @ w[:, :size])))
            r = 1 / (1 + np.exp(-(gates[size : 2 * size] + h @ w[:, size : 2 * size])))
            c = np.tanh(gates[2 * size :] + (r * h) @ w[:, 2 * size :])
            h = out[t] = h + z * (c - h)
        return out

    words = [0, 2, 1, 1, 0, 2]
    forward, backward = states(range(6), "f"), states(range(5, -1, -1), "b")
    both = [np.concatenate([forward[t], backward[t]]) for t in range(6)]
    energy = np.exp([np.tanh(s @ p["attend"] + p["attend_bias"]) @ p["query"] for s in both])
    context = sum(e * s for e, s in zip(energy / energy.sum(), both))
    windows = toxicity.Windows([np.array(words)])
    got = toxicity.logits_of(network, network.projected(features), windows)
    assert got[0] == pytest.approx(float(context @ p["out"] + p["bias"][0]), abs=1e-5)


def test_toxic_documents_are_found(spark, short_training):
    rows = rude_rows(320)
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int").where(fold(F.col("doc_id"), 5) != 0)
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(frame, labels).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == 320 and np.mean(held) > 0.9
    assert all(0 <= s <= 1 for s in got.values())


def test_late_insults_in_a_long_text_count(short_training):
    rows = rude_rows(240)
    model = toxicity.train([t for _, t, _ in rows], [y for _, _, y in rows], {0: 180, 1: 60}, toxicity.STEPS, toxicity.BATCH)
    calm = " ".join(f"word{k % 60}" for k in range(4000))
    rude = calm + " zork zorkish zorkful zork zork"
    scores = toxicity.Scorer(model).scores([calm, rude, ""])
    assert scores[1] > scores[0] + 0.3 and np.isfinite(scores).all()


def test_toxicity_of_odd_rows(messy, nothing, spark, short_training):
    labels = spark.createDataFrame([(k, k % 2) for k in range(10, 40)] + [(None, 1), (5, None), (61, 7)], "doc_id long, label int")
    got = toxicity.toxicity_scores(messy, labels)
    rows = got.collect()
    assert set(got.columns) == set(messy.columns) and len(rows) == messy.count()
    assert all(0 <= r.score <= 1 for r in rows)
    again = {(r.doc_id, r.text, round(r.score, 9)) for r in toxicity.toxicity_scores(messy, labels).collect()}
    assert again == {(r.doc_id, r.text, round(r.score, 9)) for r in rows}
    one_kind = labels.where("label = 1")
    assert {r.score for r in toxicity.toxicity_scores(messy, one_kind).collect()} == {1.0}
    assert {r.score for r in toxicity.toxicity_scores(messy, labels.where("false")).collect()} == {0.0}
    assert toxicity.toxicity_scores(nothing, labels).count() == 0


def test_quality_is_learnt_from_every_partition(spark):
    rng = random.Random(6)
    rows = []
    for k in range(500):
        words = [rng.choice(["calm", "river", "of", "the", "paper"]) for _ in range(rng.randrange(5, 60))]
        good = k % 3 > 0
        rows.append((k, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words), int(good)))
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id long, label int")
    got = {r.doc_id: r.score for r in quality.quality_scores(frame, labels).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows if i % 5 == 0]) > 0.95


def test_partial_sums_add_up_to_the_whole(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, quality.N_STATISTICS))
    y = (x[:, 0] > 0).astype(int)
    frame = spark.createDataFrame(
        [(int(k), x[k].tolist(), int(y[k])) for k in range(300)], "doc_id long, stats array<double>, label int"
    )
    models = [quality.fit(frame.repartition(n)) for n in (1, 7)]
    assert np.allclose(models[0].weights, models[1].weights, atol=1e-6)
    assert np.allclose(models[0].score(x), models[1].score(x), atol=1e-6)


def test_isotonic_is_the_pooled_mean():
    knots, values = quality.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([1.0, 0.0, 3.0, 4.0]), np.array([2.0, 2.0, 4.0, 4.0]))
    assert np.allclose(values, [0.25, 0.75, 1.0]) and np.allclose(knots, [0.15, 0.3, 0.4])


def test_quality_of_odd_rows(messy, nothing, spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(10, 40)] + [(None, 1), (5, None), (61, 7)], "doc_id long, label int")
    rows = quality.quality_scores(messy, labels).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.quality_scores(messy, labels.where("label = 1")).collect()} == {1.0}
    assert {r.score for r in quality.quality_scores(messy, labels.where("false")).collect()} == {0.5}
    assert quality.quality_scores(nothing, labels).count() == 0


RULES = (("org/", "allow"), ("example.org/es/", "block"), ("com/de/", "block"))


def test_rules_hosts_and_paths(spark):
    urls = ["http://A.Example.ORG/es/1?x=/y", "https://example.org/esx", "http://badexample.org/es/1", "http://x.com/de/1#t",
            "http://com/de/", "no scheme/es/", None, "", "a://h", "a://b://c/d", "http://x.org?u=http://y.com/de/"]
    frame = spark.createDataFrame([(k, u, "x", "x") for k, u in enumerate(urls)], "page_id long, url string, host string, score string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.url_verdicts(frame, RULES).collect()}
    assert got == {
        0: ("a.example.org", "/es/1", "example.org/es/"), 1: ("example.org", "/esx", "org/"),
        2: ("badexample.org", "/es/1", "org/"), 3: ("x.com", "/de/1", "com/de/"), 4: ("com", "/de/", "com/de/"),
        5: ("", "", None), 6: ("", "", None), 7: ("", "", None), 8: ("h", "", None), 9: ("b:", "//c/d", None),
        10: ("x.org", "", None),
    }


def brute_log_probability(counts, gram, order):
    """Interpolated orders, from Python dictionaries of 4-gram counts."""
    p = 1 / url_filter.ALPHABET
    for k in range(order + 1):
        tail = gram[len(gram) - 1 - k :]
        n_gram = sum(n for g, n in counts.items() if g.endswith(tail))
        n_context = sum(n for g, n in counts.items() if g[len(g) - 1 - k : -1] == tail[:-1])
        p = (n_gram + url_filter.BACK_OFF * p) / (n_context + url_filter.BACK_OFF)
    return np.log(p)


def test_gram_ratios_equal_brute_force(spark):
    texts = [("abcab", True), ("abc", True), ("cabba0", False), ("c~", False)]
    order = 3

    def grams(t):
        padded = "^" * order + t + "$"
        return [padded[k : k + order + 1] for k in range(len(t) + 1)]

    labelled = spark.createDataFrame(texts, "chars string, accepted boolean")
    wanted = spark.createDataFrame([(g,) for t, _ in [*texts, ("bca", None)] for g in grams(t)], "gram string").distinct()
    got = {r.gram: r.ratio for r in url_filter.gram_ratios(labelled, wanted, order).collect()}
    for gram, ratio in got.items():
        sides = []
        for side in (True, False):
            counts = {}
            for t, accepted in texts:
                if accepted == side:
                    for g in grams(t):
                        counts[g] = counts.get(g, 0) + 1
            sides.append(brute_log_probability(counts, gram, order))
        assert abs(ratio - (sides[0] - sides[1])) < 1e-9
    assert len(got) == len({g for t in ("abcab", "abc", "cabba0", "c~", "bca") for g in grams(t)})


def test_undecided_urls_go_by_the_models(spark):
    rng = random.Random(2)
    good = [f"http://{''.join(rng.choice('aeiou') for _ in range(8))}.org/{k}" for k in range(60)]
    bad = [f"http://{''.join(rng.choice('xzqkw') for _ in range(8))}.com/de/{k}" for k in range(60)]
    open_good = [f"http://{''.join(rng.choice('aeiou') for _ in range(8))}.net/{k}" for k in range(20)]
    open_bad = [f"http://{''.join(rng.choice('xzqkw') for _ in range(8))}.net/{k}" for k in range(20)]
    urls = good + bad + open_good + open_bad
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(frame, RULES).collect()}
    assert [got[k] for k in range(120, 160)] == ["allow"] * 20 + ["block"] * 20


def test_urls_without_examples(spark):
    frame = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in url_filter.url_verdicts(frame, RULES).collect()] == ["allow"] * 3
    assert url_filter.url_verdicts(frame.where("false"), RULES).count() == 0
