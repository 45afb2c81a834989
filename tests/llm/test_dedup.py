"""Exact dedup, line dedup and near-dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskloom.llm import exact_dedup, line_dedup, minhash
from riskloom.llm.components import components


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def id_order(doc_id):
    return (doc_id is None, doc_id or 0)


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[norm(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        own = groups[norm(text)]
        keep = min(own, key=id_order)
        out.append((doc_id, keep, len(own), doc_id == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups_equal_brute_force(messy, messy_rows):
    got = exact_dedup.exact_groups(messy).collect()
    assert sorted(map(tuple, got), key=repr) == brute_exact(messy_rows)


def test_exact_groups_part_rows_that_only_share_the_hash(messy, messy_rows):
    weak = exact_dedup.exact_groups(messy, fingerprint=lambda c: F.unhex(F.md5(F.substring(c, 1, 1).cast("binary"))))
    assert sorted(map(tuple, weak.collect()), key=repr) == brute_exact(messy_rows)


def test_exact_groups_are_salted_by_size(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_PER_SALT", 3)
    rows = [(k, "hot text" if k % 3 else f"t{k}") for k in range(60)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == brute_exact(rows)


def test_exact_groups_deal_out_rows_without_an_id(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_PER_SALT", 10)
    staged = {}
    keep = exact_dedup.stage
    monkeypatch.setattr(exact_dedup, "stage", lambda df, name: staged.setdefault(name, keep(df, name)))
    rows = [(None, "same text")] * 60 + [(7, "other text")] * 60
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == brute_exact(rows)
    salts = staged["members"].groupBy("fp").agg(F.count_distinct("salt").alias("n")).collect()
    assert len(salts) == 2 and all(r["n"] > 3 for r in salts)


def test_exact_dedup_keeps_columns(messy, messy_rows):
    kept = exact_dedup.exact_dedup(messy)
    assert kept.columns == messy.columns
    texts = [norm(r.text) for r in kept.collect()]
    assert set(texts) == {norm(t) for _, t in messy_rows}
    want = sum(1 for r in brute_exact(messy_rows) if r[3])
    assert len(texts) == want


def brute_lines(rows, min_docs, min_chars, keep_first):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    seen = defaultdict(set)
    first = {}
    for doc_id, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            k = key(line)
            if len(k) >= min_chars:
                seen[k].add(doc_id)
                place = ((doc_id is not None, doc_id or 0), pos)
                first[k] = min(first.get(k, place), place)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line for pos, line in enumerate(lines)
            if len(seen[key(line)]) < min_docs or len(key(line)) < min_chars
            or (keep_first and first[key(line)] == ((doc_id is not None, doc_id or 0), pos))
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(5)
    stock = [f"Line {k}" for k in range(12)] + ["", "  ", "HOT line", "hot LINE\t", "\x0bhot line"]
    rows = [(k, "\n".join(rng.choice(stock + [f"own {k}"] + ["Hot Line"] * 9) for _ in range(rng.randrange(1, 9)))) for k in range(200)]
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (None, "hot line\nLine 1"), (None, "line 2"), (3000, "Line 3\n" * 400)]
    return [*rows, rows[7]]


@pytest.mark.parametrize(("min_docs", "min_chars", "keep_first"), [(10, 1, False), (2, 1, True), (30, 5, False), (10, 1, True)])
def test_lines_equal_brute_force(spark, line_rows, min_docs, min_chars, keep_first):
    frame = spark.createDataFrame([(*r, "x", "x") for r in line_rows], "doc_id long, text string, pos string, part string")
    bitmaps = line_dedup.keep_bitmaps(frame, min_docs, min_chars, keep_first)
    got = line_dedup.apply_bitmaps(frame, bitmaps).collect()
    assert sorted(map(tuple, got), key=repr) == brute_lines(line_rows, min_docs, min_chars, keep_first)


def test_a_line_of_every_document_spans_many_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = [(k, f"common\nown {k}") for k in range(300)]
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        gone = line_dedup.dropped_lines(frame, 300, 1, False).collect()
        assert sorted((r.doc_id, r.pos) for r in gone) == [(k, 0) for k in range(300)]
        assert line_dedup.dropped_lines(frame, 301, 1, False).count() == 0
        assert line_dedup.dropped_lines(frame, 2, 1, True).count() == 299
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def brute_near(rows, size, percent):
    def words_of(text):
        return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]

    def shingles(text):
        w = words_of(text)
        if not w:
            return frozenset()
        n = min(size, len(w))
        return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1))

    sets = [(i, shingles(t)) for i, t in rows]
    ids = sorted({i for i, _ in sets if i is not None})
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    known = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, x) in enumerate(known):
        for j, y in known[:k]:
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    out = []
    for i, s in sets:
        c = None if i is None else (find(i) if s else i)
        out.append((i, len(s), c, c == i))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(messy, messy_rows, size):
    got = minhash.near_duplicates(messy, size=size).collect()
    assert sorted(map(tuple, got), key=repr) == brute_near(messy_rows, size, 80)


def test_near_duplicates_of_a_drifting_group(spark, monkeypatch):
    """Copies of copies: neighbours are linked, the ends of the chain are not; blocks of a bucket are small."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(9)
    rows, words = [], [f"w{k}" for k in range(120)]
    for k in range(90):
        words = list(words)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"n{k}x{rng.randrange(99)}"
        rows.append((rng.randrange(10**6), " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert sorted(map(tuple, got), key=repr) == brute_near(rows, 2, 80)


def test_signature_agreement_follows_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    both, one, two = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    a, b = (np.unique(np.concatenate([both, x])) for x in (one, two))
    same = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(same - 0.8) < 0.1


def test_components_of_a_long_path(spark):
    order = list(range(200))
    random.Random(2).shuffle(order)
    edges = list(zip(order, order[1:])) + [(500, 501), (501, 500), (502, 502)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(order, 0), 500: 500, 501: 500}


def test_empty_tables(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert line_dedup.apply_bitmaps(nothing, line_dedup.keep_bitmaps(nothing)).count() == 0
    assert minhash.near_duplicates(nothing).count() == 0


def test_bit_sketches_bound_what_sets_share():
    import numpy as np

    rng = np.random.default_rng(4)
    for n in (1, 40, 600, 9000):
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = np.unique(rng.choice(pool, n)), np.unique(rng.choice(pool, n))
        one, two = minhash.bit_sketch(a), minhash.bit_sketch(b)
        spare = [len(x) - int(np.bitwise_count(y).sum()) for x, y in ((a, one), (b, two))]
        bound = int(np.bitwise_count(one & two).sum()) + min(spare)
        assert bound >= len(np.intersect1d(a, b))
