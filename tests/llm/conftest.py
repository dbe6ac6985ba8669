"""Small tables with what real ones have seldom: nulls, empty and long texts, ties, repeats, clashing names."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(n, T.IntegerType()) for n in ("mix_row", "near_a", "rule_row", "rule_host", "sketch_id", "cut_id", "pack_rank", "shard", "n_words", "kept", "print")]])


def messy_documents(seed=5, n=90):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(draw.choice(vocabulary) for _ in range(70))
    long = " ".join(draw.choice(vocabulary) for _ in range(30_000))
    texts = [None, "", "   \n\t ", "one", "One", "a b", "x y z", "😀 é ñ ü # $ % <s>", "line here now\n" * 12, "the same thing over and over again here " * 9,
             long, long[:100_000] + " changed " + long[100_000:], long]
    for _ in range(n):
        body = " ".join(draw.choice(vocabulary) for _ in range(draw.randint(5, 200)))
        texts.append(body if draw.random() < 0.6 else f"{body}\n{passage} {draw.choice(vocabulary)}\r\n{body[:40]}" if draw.random() < 0.6 else draw.choice(texts[13:] or [body]))
    near = texts[-1].split(" ") + ["tail"] * 3
    texts += [" ".join([*near[:k], "edit", *near[k + 1:]]) for k in range(0, min(len(near), 30), 5)]
    rows = [(draw.randint(-5, 10_000), t, draw.choice(["en", "de", None]), draw.choice(["a", "a", "a", "é", "Z", "b c", None]), None if t is None else len(t)) for t in texts]
    rows = [(i if i % 17 else None, *r[1:]) for i, r in zip([r[0] for r in rows], rows, strict=True)]
    rows += [rows[20], rows[20], (rows[21][0], "another text under an id", "en", "a", 24), (None, None, None, None, None), (None, None, None, None, None)]
    return [(*r, *range(11)) for r in rows]


def write_tables(spark, folder, docs, pages=(), turns=(), labels=()):
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(pages), "page_id long, url string, html string, record_type string, digest string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(list(turns), "conv_id long, turn long, role string, text string, formatted string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int, lang string").write.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    """(folder, documents, pages, turns)"""
    folder = str(tmp_path_factory.mktemp("messy"))
    docs = messy_documents()
    big, other = "<html>" + "same " * 400, "ñ" * 1000
    pages = [(1, "http://a/x", big), (2, "http://a/y", big), (3, None, big), (3, "http://a/z", big), (None, "u", big), (4, "http://b\r\nX: 1", None), (5, "u", ""),
             (6, "u", "small"), (7, "u", "small"), (8, "u", other), (9, "v", other), (9, "v", other), (10, "w", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n" * 50)]
    turns = [(1, 0, "system", "be"), (1, 1, "user", "</s>[INST] a\\b \\\\ [/INST"), (1, 2, "assistant", "[/INST]</s><s>\\"), (1, 2, "assistant", None), (2, None, None, None),
             (2, 1, "assistant", "😀 é"), (None, 1, "user", "[[INST]]"), (None, 0, "assistant", ""), (3, 5, "user", "x" * 200_000), (3, 5, "user", "x" * 200_000), (4, 1, "</s>", "<s")]
    labels = [(r[0], 1, 0, "en") for r in docs if r[0] is not None and r[0] % 2]
    write_tables(spark, folder, docs, [(*p, "x", "y") for p in pages], [(*t, "f") for t in turns], labels)
    return folder, [r[:5] for r in docs], pages, turns


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("nothing"))
    write_tables(spark, folder, [])
    return folder
