"""The pipeline's stages in a row against the plain versions."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from linesmith.llm.queries_docs import vocabulary
from linesmith.llm.texts import row_hash

from . import brute


def plain_stages(docs):
    """Rows (doc_id, text, lang, source, n_chars) behind each of the first four stages."""
    verdicts = brute.rules([(d, t, s) for d, t, _, s, _ in docs])
    kept = [r for r, v in zip(docs, verdicts, strict=True) if v[-1]]
    yield kept
    prints = [brute.simhash(r[1]) for r in kept]
    root = brute.components(set(prints))
    first = {}
    for r, p in zip(kept, prints, strict=True):
        first.setdefault(root[p], []).append(r)
    yield first
    firsts = yield
    cut = brute.cut([r[:2] for r in firsts])
    yield [r if len(words) == n else (r[0], " ".join(words), r[2], r[3], len(" ".join(words))) for r, (words, n) in zip(firsts, cut, strict=True) if words or n == 0]


def test_stages(spark, messy):
    folder, docs, *_ = messy
    table = spark.read.parquet(f"{folder}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    plain = plain_stages(docs)

    def tuples(df):
        assert df.columns == table.columns
        return [tuple(r)[:5] for r in df.collect()]
    ruled = stages[0](spark, table, folder)
    assert Counter(tuples(ruled)) == Counter(next(plain))
    single = stages[1](spark, ruled, folder)
    found, groups = tuples(single), next(plain)
    assert len(found) == len(groups)
    for group in groups.values():
        least = min(brute.null_last(r[0]) for r in group)
        assert sum(r in group and brute.null_last(r[0]) == least for r in found) == 1
    single = spark.createDataFrame([tuple(r) for r in single.collect()], table.schema)
    cut = stages[2](spark, single, folder)
    next(plain)
    assert Counter(tuples(cut)) == Counter(plain.send(found))
    mixed = stages[3](spark, cut, folder)
    named = [tuple(r) for r in cut.select("*", F.concat_ws(":", row_hash(cut, "a"), row_hash(cut, "b"))).collect()]
    named = list({r[-1]: r for r in named}.values())  # rows equal in all columns are one document
    taken = brute.mixed([(r[0], r[1], r[3]) for r in named], names=[r[-1] for r in named])
    want = Counter()
    for r, t in zip([r[:5] for r in named], taken, strict=True):
        want[r] += t[4] // t[1] if t[1] else 1
    assert Counter(tuples(mixed)) == +want
    packed = stages[4](spark, mixed, folder).collect()
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(vocabulary())
    lengths = Counter()
    for r in tuples(mixed):
        n = len(coder.encode(r[1], add_special_tokens=False).ids) + 1
        for k in range(0, n, 2048):
            lengths[r[0], k // 2048, min(2048, n - k)] += 1
    assert Counter((r.doc_id, r.piece, r.length) for r in packed) == lengths


def test_empty(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).collect() == []
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
