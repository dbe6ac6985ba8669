"""Wordings, prefixes and periods against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linesmith.llm import licenses, runs
from linesmith.llm.catalog import QUERIES
from linesmith.llm.licenses import Scanner, as_pattern, license_places, mandatory, parse, wordings, words_of
from linesmith.llm.queries_patterns import op12, planted
from linesmith.llm.trie import numbered_turns, prefix_trie, spread_join, with_borrowed_heads
from linesmith.llm.wordings import BASE, TEMPLATES


# ---- license wordings ----

def sample(items, draw):
    """A text the tree accepts."""
    out = []
    for kind, *more in items:
        if kind == "word":
            out.append(more[0].decode())
        elif kind == "any":
            out += [draw.choice(["foo", "bar", "license", "copyright"]) for _ in range(draw.randint(*more))]
        elif kind == "one":
            out += sample(draw.choice(more[0]), draw)
        elif draw.random() < 0.5:
            out += sample(more[0], draw)
    return out


def plain_labels(words):
    line = "".join(f" {w}" for w in words) + " "
    return {w.label for w in wordings() if re.search(as_pattern(w.tree) + " ", line)}


def plain_base(words):
    found = [(k, label) for phrase, label in BASE.items() for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
    return sorted(k for k, _ in found), {label for _, label in found}


@pytest.mark.parametrize("label", sorted(TEMPLATES))
def test_every_template_is_found_in_its_own_texts_only_where_its_wording_agrees(label):
    draw, known = random.Random(label), wordings()
    scanner = Scanner(known)
    for _ in range(20):
        text = sample(parse(TEMPLATES[label]), draw)
        words = ["x"] * draw.randint(0, 3) + text + ["y"] * draw.randint(0, 3)
        if draw.random() < 0.5:  # change, drop or repeat a word: the plain pattern says what is left
            k = draw.randrange(len(words))
            words[k:k + 1] = draw.choice([["changed"], [], [words[k]] * 2])
        places = scanner.places([w.encode() for w in words])
        assert {known[n].label for n, *_ in places} == plain_labels(words)
        for n, a, b in places:
            assert re.fullmatch(as_pattern(known[n].tree), "".join(f" {w}" for w in words[a:b]))


def test_template_markup_errors_and_shapes():
    assert [w.decode() for _, w in parse("GNU-v2 İx é")] == ["gnu", "v2", "İx", "é"]
    tree = parse("a <<opt>>b <<any 1-2>><</opt>> <<one c|d e>> f")
    assert mandatory(tree) == 3
    scanner = Scanner([licenses.Wording("t", False, tree, 3)])
    for text, hit in [("a c f", 1), ("a d e f", 1), ("a b x c f", 1), ("a b x y d e f", 1), ("a b c f", 0), ("a b x y z c f", 0), ("a b c c f", 1), ("a x c f", 0)]:
        assert len(scanner.places(text.encode().split())) == hit, text
    for bad in ("", "<<any 1-2>> a", "a <<any 1-2>>", "<<opt>>a", "a <</opt>>", "a <<one b|c", "a <<what>> b", "a <<any 3-1>> b", "<<opt>>a<</opt>>"):
        with pytest.raises(ValueError):
            parse(bad)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["cc", "by", "mit", "license", "gnu", "general", "public", "apache", "under", "the", "licensed", "2", "0", "version", "v3"]), max_size=60))
def test_states_are_forgotten_without_a_trace(words):
    few, known = licenses.STATES, wordings()
    coded = [w.encode() for w in words]
    want = Scanner(known).places(coded)
    licenses.STATES = 3
    try:
        assert Scanner(known).places(coded) == want
    finally:
        licenses.STATES = few
    assert {known[n].label for n, *_ in want} == plain_labels(words)
    assert sorted(a for n, a, _ in want if known[n].base) == plain_base(words)[0]


def test_license_query(spark, messy, tmp_path):
    folder, docs, *_ = messy
    draw = random.Random(3)
    texts = [" ".join(sample(parse(draw.choice(list(TEMPLATES.values()))), draw)) for _ in range(40)]
    texts += ["MIT License. Licensed under the Apache License, Version 2.0.", "GNU General\nPublic LICENSE, version 3 cc by-nc 4.0", "mit license", "cc by " * 3000, None, ""]
    table = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(r[0], r[1], "x") for r in docs], "doc_id long, text string, license_words string")
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in QUERIES["op11_license_scan"](spark, str(tmp_path)).collect())
    want, size = Counter(), {w.label: w.words for w in wordings()}
    for doc, text in [(k, t) for k, t in enumerate(texts)] + [r[:2] for r in docs]:
        words = [w.decode() for w in words_of((text or "").encode())]
        starts, base = plain_base(words)
        labels = plain_labels(words)
        most = max((w.words for w in wordings() if w.label in labels), default=0)
        want[doc, len(words), len(starts), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(base)), ",".join(sorted(labels)), most / (most + 4)] += 1
    assert got == want and size["mit-text"] > 100
    kept = license_places(table)
    assert kept.columns == ["doc_id", "text", "license_words", "license_places"] and kept.count() == len(texts) + len(docs)


# ---- conversations ----

def plain_trie(turns):
    """Rows of the contract, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(rows)] for c, rows in own.items()}
    built = {}
    for c, rows in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = said.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + rows[h:]
    members = defaultdict(list)
    for c, rows in built.items():
        for d in range(len(rows) + 1):
            members[tuple(rows[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(built[c]) == len(node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def many_turns(seed=4):
    draw, turns = random.Random(seed), []
    for c in [*range(0, 60), *range(100, 180), 199, 205, 377, *range(1000, 1040)]:
        n = draw.choice([1, 1, 2, 3, 7, 9, 14, 30])
        start = draw.choice("ab")
        for t in range(n):
            turns.append((c, t, draw.choice(["user", None]) if draw.random() < 0.1 else "user", start * 3 if t < 5 else draw.choice(["y", "zz", None])))
    return turns + [(500, t, "user", "hi" * (t % 3)) for t in range(700)] + [(501, t, "user", "hi" * (t % 3)) for t in range(690)]


def test_trie_query(spark, messy, tmp_path):
    folder, _, _, turns = messy
    assert Counter(tuple(r) for r in QUERIES["op12_prefix_trie"](spark, folder).collect()) == Counter(plain_trie(turns))
    rows = many_turns()
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op12(spark, str(tmp_path)).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_trie(rows))


@pytest.mark.parametrize("block,stretch", [(1, 1), (3, 2), (16, 1000)])
def test_trie_does_not_depend_on_blocks(spark, block, stretch):
    rows = many_turns(9)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie(numbered_turns(table), block=block, stretch=stretch)
    plain = [(r[0] * 100, *r[1:]) for r in rows]  # every conversation is its own base
    assert Counter(tuple(r) for r in got.collect()) == Counter((r[0] // 100, r[1], None if r[2] is None else r[2] // 100, *r[3:7], got_hash(rows, r)) for r in plain_trie(plain))


def got_hash(rows, node):
    """The digest over the original ids of the conversations that end in a node."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        said[conv].append((turn, role or "", text or ""))
    said = {c: [t[1:] for t in sorted(r)] for c, r in said.items()}
    path = said[node[0] // 100][:node[1]]
    return hashlib.sha256(",".join(str(c) for c in sorted(said) if said[c] == path).encode()).hexdigest()


def test_borrowed_heads_of_absent_and_short_bases(spark):
    from pyspark.sql import functions as F
    rows = [(10, 0, "u", "a"), (10, 1, "u", "b"), (11, 0, "u", "x"), (11, 1, "u", "y"), (11, 2, "u", "z"), (25, 0, "u", "q")]
    turns = numbered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    built = with_borrowed_heads(turns, F.col("conv_id") - F.col("conv_id") % 10, F.lit(2), 2)
    assert sorted((r.conv_id, -1 if r.at is None else r.at) for r in built.collect()) == [(10, 0), (10, 1), (11, 0), (11, 1), (11, 2), (25, -1)]


def test_spread_join_splits_hot_keys_only(spark):
    from pyspark.sql import functions as F
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("twice", F.col("k") * 2)
    got = spread_join(rows, facts, ["k"], "n")
    assert got.count() == 5000 and got.where("twice <> 2 * k").count() == 0
    assert spread_join(rows, facts.where("k <> 5 and k <> 7"), ["k"], "n", "left").where("twice is null").count() == 1 + rows.where("k = 7").count()


# ---- runs ----

def plain_runs(w, least=24, times=3):
    n, out = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, times * q):
                out.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.integers(1, 40)), max_size=5), st.sampled_from([4, 24]))
def test_runs_equal_plain_search(parts, least):
    words = [unit[k % len(unit)] for unit, n in parts for k in range(n)]
    assert runs.find_runs(np.array(words, dtype=np.int64), least) == plain_runs(words, least)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 2), min_size=2, max_size=200), st.data())
def test_extensions_equal_plain_comparison(words, data):
    n = len(words)
    pairs = data.draw(st.lists(st.tuples(st.integers(0, n), st.integers(0, n)).filter(lambda p: p[0] != p[1]), min_size=1, max_size=30))
    i, j = np.array(pairs).T
    for a, b, got in zip(i, j, runs.Extensions(np.array(words)).of(i, j), strict=True):
        k = 0
        while max(a, b) + k < n and words[a + k] == words[b + k]:
            k += 1
        assert got == k


def test_pairs_taken_in_parts(monkeypatch):
    draw = random.Random(2)
    words = [draw.randint(1, 3) for _ in range(400)] + [1, 2, 2, 1, 3] * 60 + [2] * 100
    want = plain_runs(words)
    monkeypatch.setattr(runs, "PAIRS", 50)
    assert runs.find_runs(np.array(words)) == want and want
    with pytest.raises(ValueError):
        runs.find_runs(np.array(words), times=2)


def plain_planted(doc, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc).encode()) if doc is not None else 1, len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def test_run_query(spark, messy, tmp_path):
    _, docs, *_ = messy
    draw = random.Random(8)
    texts = [(k, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 150)))) for k in range(150)]
    texts += [(7, "x " * 500), (8, "\x1c é " * 40), (9, "one two  three\n" * 30 + "tail " * 23), (10, "same\t" * 24), (10, "same\t" * 23)]
    texts += [r[:2] for r in docs if len(r[1] or "") < 20_000]
    spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, runs int").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for doc, text in texts:
        words = plain_planted(doc, text)
        found = plain_runs(words)
        best = None
        for r in found:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        want[(doc, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
              hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())] += 1
    got = Counter(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect())
    assert got == want and sum(r[1] > 0 for r in want) > 20
    assert planted(spark.read.parquet(f"{tmp_path}/documents.parquet")).columns == ["doc_id", "text"]


def test_long_text_with_runs(spark):
    words = [f"w{k % 7919}" for k in range(60_000)] + ["a", "b"] * 3_000
    table = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = runs.periodic_runs(table).first()
    assert [tuple(r) for r in row.runs] == [(0, 60_000, 7919), (60_000, 6_000, 2)] and row.run_words == 66_000
    assert row.collapsed.split() == words[:7919] + ["a", "b"]
