"""Documents that share an id, and part of their text's hash."""

import random
from collections import Counter

import pytest
import xxhash
from linesmith.llm.suffixes import LAST_ID, without_repeats

from . import brute


def low_bits(text):
    return xxhash.xxh64_intdigest(text.encode(), 42) & ((1 << 24) - 1)


def colliding(draw, heads, tail):
    """Texts from each head and a tail, all with equal last 24 bits of their hash."""
    seen = {}
    for k in range(1_000_000):
        for n, head in enumerate(heads):
            text = f"{head} {tail} {k}"
            other = seen.setdefault(low_bits(text), (n, text))
            if other[0] != n:
                return sorted([other, (n, text)])
    raise AssertionError


@pytest.mark.parametrize("id", [None, 7, LAST_ID])
def test_texts_under_one_id_with_colliding_hashes(spark, id):
    draw = random.Random(2)
    passages = [" ".join(f"p{draw.randrange(10_000)}" for _ in range(40)) for _ in range(4)]
    (_, long), (_, short) = colliding(draw, [f"{' '.join(f'u{k}' for k in range(60))} {passages[0]} {passages[1]}", "short one"], "x")
    docs = [(1, passages[0]), (1, passages[1] + " " + passages[2]), (id, long), (id, short), (id, passages[3]), (id, passages[3] + " end")]
    assert low_bits(long) == low_bits(short)
    got = without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = Counter((d, t, " ".join(kept)) for (d, t), (kept, _) in zip(docs, brute.cut(docs), strict=True))
    assert Counter((r.doc_id, r.text, r.cut_kept) for r in got) == want


def test_null_ids_come_after_the_greatest(spark):
    passage = " ".join(f"w{k}" for k in range(30))
    got = without_repeats(spark.createDataFrame([(None, passage), (LAST_ID, passage)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.cut_removed for r in got} == {None: 30, LAST_ID: 0}


@pytest.mark.parametrize("bound", [1, 10])
def test_one_phrase_in_every_text(spark, monkeypatch, bound):
    """Six words that all texts share and nothing else: their chunks all differ and come to no single task."""
    from linesmith.llm import suffixes
    draw = random.Random(12)
    vocabulary = [f"w{k}" for k in range(3000)]
    phrase = "these six words are all over"
    texts = []
    for _ in range(150):
        words = [draw.choice(vocabulary) for _ in range(80)]
        words[draw.randint(20, 50):] += phrase.split() + [draw.choice(vocabulary) for _ in range(20)]
        texts.append(" ".join(words))
    texts += [" ".join([*texts[3].split()[10:70], "new", "end"]), texts[5], texts[5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    monkeypatch.setattr(suffixes, "HOT", 1 << 40)  # every key above ``largest`` counts as hot
    routed = []
    first = suffixes._first_rows
    monkeypatch.setattr(suffixes, "_first_rows", lambda largest: routed.append(largest) or first(largest))
    got = {r.doc_id: r.cut_kept for r in suffixes.without_repeats(docs, largest=bound).collect()}
    assert routed == [bound]
    assert got == {k: " ".join(kept) for k, (kept, _) in enumerate(brute.cut(list(enumerate(texts))))}
    assert got[151] == "" and got[152] == "" and len(got[150].split()) == 2
