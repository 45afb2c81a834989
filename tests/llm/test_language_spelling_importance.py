"""Language identification, spelling variants and importance resampling against plain references."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskloom.llm import importance, language_id, queries, spelling

SF = "/root/testdata/sf0.01"
TABLES = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


# ---------------------------------------------------------------- language


SYLLABLES = {"xx": ["tho", "wan", "ing", "er"], "yy": ["que", "ado", "ción", "los"], "zz": ["ß", "ung", "ein", "sch"]}


def tongue(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def tongues():
    rng = random.Random(4)
    rows = [(k, tongue(rng, lang := "xyz"[k % 3] * 2, rng.randrange(3, 40)), lang) for k in range(90)]
    rows += [(90, None, "xx"), (91, "", "yy"), (92, "12 ½ ²_!", "zz"), (93, "日本", None), (94, "y" * 5000, "yy")]
    return rows + [(95, "Thoing THO", None), (95, "Thoing THO", None), (None, "scheinung", None), (96, "thoq" * 3000, "xx")]


def plain_language(learnt, text):
    """Word logs, then the longest known run at each place, with plain dictionaries of strings."""
    langs = sorted({lang for _, lang in learnt})
    words, grams = defaultdict(Counter), defaultdict(Counter)
    for t, lang in learnt:
        words[lang].update(language_id.words_of(t))
    for lang in langs:
        for w, n in words[lang].items():
            p = f"<{w}>"
            for size in range(1, language_id.LONGEST_GRAM + 1):
                for k in range(len(p) - size + 1):
                    grams[lang][p[k : k + size]] += n
    known = {w for c in words.values() for w in c if len(w) <= language_id.LONGEST_WORD}
    runs = {g for c in grams.values() for g in c}
    per = {(lang, s): sum(n for g, n in grams[lang].items() if len(g) == s) for lang in langs for s in range(1, 6)}
    kinds = Counter(map(len, runs))
    total = {lang: math.log(sum(k == lang for _, k in learnt) / len(learnt)) for lang in langs}
    mass = {lang: sum(n for w, n in words[lang].items() if w in known) for lang in langs}
    for w in language_id.words_of(text):
        p = f"<{w}>"
        found = [] if w in known else [
            next((p[k : k + s] for s in range(5, 0, -1) if len(p) - k >= s and p[k : k + s] in runs), None) for k in range(len(p))]
        found = [g for g in found if g]
        for lang in langs:
            if w in known:
                total[lang] += math.log((words[lang][w] + 0.5) / (mass[lang] + 0.5 * len(known)))
            elif found:
                logs = [math.log((grams[lang][g] + 0.5) / (per[lang, len(g)] + 0.5 * kinds[len(g)])) for g in found]
                total[lang] += sum(logs) / len(logs)
    best = max(langs, key=lambda k: (total[k], -langs.index(k)))
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


@pytest.mark.parametrize("held", [3, 300_000])
def test_languages_equal_a_plain_reference(spark, monkeypatch, tongues, held):
    monkeypatch.setattr(language_id, "HELD", held)
    monkeypatch.setattr(language_id, "CHARACTERS", 50 if held == 3 else 1 << 20)
    docs = spark.createDataFrame(tongues, "doc_id long, text string, lang string").repartition(3)
    part = [r for r in tongues if r[0] is not None and r[0] % 2 == 0]
    labelled = spark.createDataFrame(part, "doc_id long, text string, lang string")
    learnt = [(t, lang) for _, t, lang in part if t is not None and lang is not None]
    got = language_id.identify(docs, labelled).collect()
    assert len(got) == len(tongues)
    for r in got:
        if not language_id.words_of(r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            lang, score = plain_language(learnt, r.text)
            assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-3)
    odd = {r.doc_id: r for r in got}
    assert all(odd[k].lang_pred == "und" for k in (90, 91, 92))
    right = [r for r in got if r.doc_id is not None and r.doc_id < 90 and r.doc_id % 2]
    assert sum(r.lang_pred == r.lang for r in right) >= 0.95 * len(right)


def test_a_small_model_falls_back_to_runs(spark, monkeypatch, tongues):
    monkeypatch.setattr(language_id, "WORDS", 5)
    docs = spark.createDataFrame(tongues[:90], "doc_id long, text string, lang string")
    model = language_id.fit(docs.select("text", "lang"))
    assert len(model.words) <= 5 and len(model.grams) > 20
    got = language_id.identify(docs, docs).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    # the bound on numbers holds with many languages
    monkeypatch.setattr(language_id, "CELLS", 30)
    assert len(language_id.fit(docs.select("text", "lang")).grams) <= 10


def test_languages_of_odd_tables(spark, messy, nothing):
    none = spark.createDataFrame([(None, "xx"), ("a", None)], "text string, lang string")
    assert {(r.lang_pred, r.score) for r in language_id.identify(messy, none).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([("Ab ab", "xx")], "text string, lang string")
    out = language_id.identify(messy, one, score_col="kept")
    assert set(out.columns) == {*messy.columns, "lang_pred"} and out.count() == messy.count()
    assert {r.lang_pred for r in out.collect()} == {"xx", "und"}
    assert language_id.identify(nothing, one).count() == 0
    # the text column's own name may be that of a result
    same = language_id.identify(one.select(F.col("text").alias("score")), one, text_col="score")
    assert same.collect()[0].lang_pred == "xx"


@TABLES
def test_held_out_languages_of_the_documents(spark):
    got = queries.QUERIES["op11_language_id"](spark, SF)
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(lang, "doc_id").where("lang_pred <> 'und'").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) > 100


# ---------------------------------------------------------------- spelling


def plain_words(rows, min_chars, min_count, lost_every):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            if lost_every and doc is not None:
                h = zlib.crc32(f"{doc}:{run}".encode())
                if h % lost_every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(words, ratio):
    out = {}
    for w, n in words.items():
        near = [v for v in words if v != w and one_edit(w, v)]
        top = min(near, key=lambda v: (-words[v], v), default=None)
        form = top if top and words[top] >= ratio * n else None
        out[w] = [n, form, words.get(form), len(near)]
    for w in out:
        root = w
        while out[root][1]:
            root = out[root][1]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def spelled(df):
    return {r.word: (r.n, r.form, r.form_n, r.n_near, r.root) for r in df.collect()}


@pytest.fixture(scope="module")
def typos():
    rng = random.Random(8)
    base = ["winter", "wanderer", "überaus", "xxabcdxx", "ÀÀÀÀÀÀ"] + ["".join(rng.choice("abeéÿ×") for _ in range(6)) for _ in range(60)]
    rows = []
    for k in range(400):
        words = []
        for _ in range(rng.randrange(1, 25)):
            w = rng.choice(base[: 5 if rng.random() < 0.7 else 65])
            if rng.random() < 0.3:
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abeé") + w[at:], w[:at] + "q" + w[at + 1 :]])
            words.append(rng.choice([w, w.upper(), w.title()]) + rng.choice([" ", "1", "\n", "ł"]))
        rows.append((k, "".join(words)))
    rows += [(None, "winter wintre"), (3, None), (4, ""), (5, "y" * 3000 + " " + "y" * 3001), (5, "y" * 3000)]
    return rows


@pytest.mark.parametrize(("leaf", "block", "depth"), [(24, 100_000, None), (1, 7, 0), (2, 40, 3), (3, 100_000, 8)])
def test_variants_equal_brute_force(spark, monkeypatch, typos, leaf, block, depth):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    monkeypatch.setattr(spelling, "BLOCK", block)
    if depth is not None:
        monkeypatch.setattr(spelling, "depth_for", lambda n: depth)
    docs = spark.createDataFrame(typos, "doc_id long, text string").repartition(3)
    got = spelled(spelling.spelling_variants(docs, min_chars=5, min_count=1, ratio=2, lost_every=7))
    want = plain_variants(plain_words(typos, 5, 1, 7), 2)
    assert got == want
    assert sum(v[3] > 5 for v in want.values()) > 10 and any(v[4] != v[1] for v in want.values() if v[1])


def test_variants_of_odd_tables(spark, messy, messy_rows, nothing):
    assert spelled(spelling.spelling_variants(messy, min_count=2)) == plain_variants(plain_words(messy_rows, 6, 2, None), 5)
    assert spelling.spelling_variants(nothing).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(nothing, ratio=1)


@TABLES
def test_variants_of_the_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    words = plain_words(rows, 6, 5, 199)
    got = spelled(queries.QUERIES["op12_spelling"](spark, SF))
    assert {w: v[0] for w, v in got.items()} == words
    # all pairs, by the words with one code point left out at each place
    shapes = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            shapes[w[:k] + "?" + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            near[w] |= shapes[w[:k] + "?" + w[k + 1 :]] - {w}
            short = w[:k] + w[k + 1 :]
            if short in words:
                near[w].add(short)
                near[short].add(w)
    assert {w: v[3] for w, v in got.items()} == {w: len(near[w]) for w in words}
    for w, (n, form, form_n, _, _) in got.items():
        top = min(near[w], key=lambda v: (-words[v], v), default=None)
        assert form == (top if top and words[top] >= 5 * n else None) and form_n == words.get(form)


# ---------------------------------------------------------------- importance


def plain_features(text, longest):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return len(words), [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain_resample(docs, target, percent=25, longest=2, buckets=10_000, min_words=20, seed=7):
    found = [(d, *plain_features(t, longest)) for d, t in docs]
    own, aim = Counter(), Counter()
    for _, _, fs in found:
        own.update(zlib.crc32(f.encode()) % buckets for f in fs)
    for t in target:
        aim.update(zlib.crc32(f.encode()) % buckets for f in plain_features(t, longest)[1])
    s_all, t_all = sum(own.values()) + buckets, sum(aim.values()) + buckets
    gain = [math.floor(1000 * math.log((aim[b] + 1.0) * s_all / ((own[b] + 1.0) * t_all))) for b in range(buckets)]
    rows = []
    for d, n, fs in found:
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    usable = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(usable[: percent * len(usable) // 100]):
        r[5] = k + 1
    return rows


def drawn(df):
    return sorted((str(r.doc_id), r.n_words, r.n_features, r.weight, r.score, r["rank"] or 0) for r in df.collect())


def as_text(rows):
    return sorted((str(r[0]), *r[1:5], r[5] or 0) for r in rows)


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(2, 10_000, 25), (3, 70_000, 60), (1, 3, 100), (2, 100, 0)])
def test_resampling_equals_brute_force(spark, messy, messy_rows, longest, buckets, percent):
    target = ["river stone paper", None, "", "Stone RIVER garden éa 7"]
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.importance_resample(messy, aims, percent, longest, buckets)
    assert drawn(got) == as_text(plain_resample(messy_rows, target, percent, longest, buckets))


def test_many_equal_rows_take_consecutive_ranks(spark, monkeypatch):
    monkeypatch.setattr(importance, "RANGES", 4)
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(7, text)] * 300 + [(k, text) for k in range(100, 400)] + [(None, text)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    aims = spark.createDataFrame([("w1 w2",)], "text string")
    got = importance.importance_resample(docs, aims, percent=90)
    assert drawn(got) == as_text(plain_resample(rows, ["w1 w2"], percent=90))
    names = docs.withColumn("doc_id", F.concat(F.lit("id-"), "doc_id"))
    ranks = [r["rank"] for r in importance.importance_resample(names, aims, percent=90).collect() if r["rank"]]
    assert sorted(ranks) == list(range(1, 586))


def test_resampling_of_empty_tables(spark, nothing, messy):
    aims = spark.createDataFrame([], "text string")
    assert importance.importance_resample(nothing, aims).count() == 0
    out = importance.importance_resample(messy, aims, percent=50)
    assert out.count() == messy.count() and out.where("rank is not null").count() > 0


@TABLES
def test_resampling_of_the_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    assert drawn(queries.QUERIES["op13_importance"](spark, SF)) == as_text(plain_resample(docs, target))
