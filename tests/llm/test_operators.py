"""Each query against a plain version, on a table of awkward rows; queries with SQL also against that."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linesmith.llm import golay, perplexity, sharding, simhash, templates
from linesmith.llm.catalog import ORACLES, QUERIES
from linesmith.llm.graph import components
from linesmith.llm.packing import plan
from linesmith.llm.queries_docs import vocabulary
from linesmith.llm.suffixes import without_repeats
from linesmith.llm.mixing import mixed_documents

from ..oracle import compare, connect
from . import brute

FOLDER = os.environ.get("LINESMITH_TEST_SF", "/root/testdata/sf0.001")


@dataclass
class WithSql:
    run: object
    sql: str


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    out = compare(spark, connect(FOLDER), FOLDER, name, WithSql(QUERIES[name], ORACLES[name]))
    assert out["problem"] == "" and out["rows"] > 0


def rows(spark, name, folder):
    return [tuple(r) for r in QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, nothing, name):
    assert len(rows(spark, name, nothing)) == (1 if name.startswith("op6") else 0)


def test_mix(spark, messy):
    folder, docs, *_ = messy
    got = rows(spark, "op1_mix_sources", folder)
    want = brute.mixed([(d, t, s) for d, t, _, s, _ in docs])
    assert Counter((*r[:3], round(r[3], 6), r[4]) for r in got) == Counter((*r[:3], round(r[3], 6), r[4]) for r in want)
    assert all(taken <= 2 * size for _, size, _, _, taken in got)


def test_mixed_documents_keep_columns_and_order(spark, messy):
    folder, docs, *_ = messy
    table = spark.read.parquet(f"{folder}/documents.parquet")
    out = mixed_documents(table, share=1.5, weights=(5.0, 2.0, 1.0), epochs=2)
    assert out.columns == table.columns
    found = Counter(tuple(r) for r in out.collect())
    assert set(found) <= {tuple(r) for r in table.collect()} and set(found.values()) <= {1, 2}


def test_simhash(spark, messy):
    folder, docs, *_ = messy
    assert Counter(rows(spark, "op2_simhash_components", folder)) == Counter(brute.simhash_groups([r[:2] for r in docs]))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, (1 << 23) - 1), st.sets(st.integers(0, 22), max_size=2))
def test_golay_words_two_bits_apart_share_a_key(word, flips):
    other = word
    for b in flips:
        other ^= 1 << b
    one, two = golay.keys(np.array([word, other]))
    assert set(one) & set(two) and len(one) in (1, 6)


@pytest.mark.parametrize("crowd", [0, 3, 10_000])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_connect_what_brute_force_connects(spark, crowd, bits):
    draw = random.Random(bits)
    centres = [draw.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))) for c in centres for _ in range(60)}
    prints |= {c ^ 1 << draw.randrange(64) for c in centres} | {0, 1, (1 << 64) - 1}
    table = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "print long")
    found = {(int(np.int64(r.node).astype(np.uint64)), int(np.int64(r.root).astype(np.uint64))) for r in components(simhash.links(table, bits, crowd)).collect()}
    want = brute.components(prints, bits)
    linked = {p for p, n in want.items() if Counter(want.values())[n] > 1}
    assert {p for p, _ in found} == linked
    groups = defaultdict(set)
    for p, r in found:
        groups[r].add(p)
    wanted = defaultdict(set)
    for p in linked:
        wanted[want[p]].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_long_chain(spark):
    chain = list(range(400))
    random.Random(1).shuffle(chain)
    table = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)) + [(1000, 1001)], "a long, b long")
    assert {(r.node, r.root) for r in components(table).collect()} == {(k, 0) for k in range(400)} | {(1000, 1000), (1001, 1000)}


def test_packing(spark, messy):
    from tokenizers import Tokenizer

    folder, docs, *_ = messy
    got = rows(spark, "op3_best_fit_packing", folder)
    coder, want = Tokenizer.from_file(vocabulary()), Counter()
    for d, t, *_ in docs:
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            cut = ids[k:k + 2048]
            want[d, k // 2048, k, len(cut), zlib.crc32(np.array(cut, dtype="<u4").tobytes())] += 1
    assert Counter(r[:5] for r in got) == want
    sequences = defaultdict(list)
    for _, _, _, length, _, sequence, offset in got:
        sequences[sequence].append((offset, length))
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(sequences) <= brute.best_fit([r[3] for r in got], 2048)


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 60).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 30), max_size=20))))
def test_plan_places_every_piece(case):
    capacity, histogram = case
    runs, opened = plan(histogram, capacity)
    used = defaultdict(int)
    for size, count in histogram.items():
        mine = sorted((r.low, r.high) for r in runs if r.length == size)
        assert [a for a, _ in mine] == [0, *[b for _, b in mine[:-1]]] and mine[-1][1] == count
    for r in sorted(runs, key=lambda r: r.offset):
        for k in range(r.high - r.low):
            at = r.first + k // r.per
            assert used[at] == r.offset + k % r.per * r.length
            used[at] += r.length
    assert len(used) == opened and max(used.values(), default=0) <= capacity
    assert opened <= brute.best_fit([s for s, c in histogram.items() for _ in range(c)], capacity) + 1


def test_sharding(spark, messy):
    folder, docs, *_ = messy
    got = QUERIES["op4_shard_documents"](spark, folder).collect()
    size = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == size
    shards, texts = defaultdict(list), defaultdict(set)
    for r in got:
        shards[r.shard].append(r.slot)
        texts[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values()) and max(shards) < 40
    assert all(len(s) == 1 for s in texts.values())
    atoms, filled = Counter(), Counter()
    for r in got:
        atoms[r["size"], r.text_crc32] += r["size"]
        filled[r.shard] += r["size"]
    assert max(filled.values()) <= sum(atoms.values()) / 40 + max(atoms.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=12), st.integers(1, 6))
def test_smallest_capacity(sizes, shards):
    best = {0: [0] + [10 ** 9] * len(sizes)}
    for k in range(1, shards + 1):
        best[k] = [min(max(best[k - 1][j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(len(sizes) + 1)]
    capacity = sharding.smallest_capacity(sizes, shards)
    assert capacity == best[shards][-1]
    large, fair = sharding.oversized(sizes, shards)
    cuts = [0, *sharding.cut_points(sizes, shards, fair), len(sizes)]
    assert cuts == sorted(cuts) and all(sum(sizes[a:b]) <= capacity for a, b in zip(cuts, cuts[1:], strict=False))


def test_warc(spark, messy):
    folder, _, pages, _ = messy
    got = rows(spark, "op5_warc_archive", folder)
    last = {}
    for p, _, h in pages:
        last[h or ""] = max(x for x in (last.get(h or ""), p, -1) if x is not None)
    want = Counter()
    for p, _, h in pages:
        body = (h or "").encode()
        again = len(body) >= 1000 and p != last[h or ""]
        want[p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", last[h or ""] if again else None] += 1
    assert Counter(got) == want


@pytest.mark.parametrize("mark", ["\u2028", "\u2029", "\x85", "\x0b", "\x0c", "\r", "\n", "\r\n"])
def test_a_url_adds_no_header(spark, tmp_path, mark):
    from linesmith.llm.warc import parse_records, read_records, write_archive
    url = f"http://a/{mark}WARC-Refers-To: <urn:page:99:x>{mark}WARC-Payload-Digest: sha1:0{mark}Content-Length: 1"
    pages = spark.createDataFrame([(1, url, "x" * 2000), (2, "", "x" * 2000), (3, None, "y")], "page_id long, url string, html string")
    write_archive(pages, f"{tmp_path}/a")
    got = {r.page_id: r for r in parse_records(read_records(spark, f"{tmp_path}/a")).collect()}
    encoded = "".join(f"%{b:02X}" for b in mark.encode())
    assert got[1].url == url.replace(mark, encoded) and (got[2].url, got[3].url) == ("", None)
    assert [(got[k].record_type, got[k].refers_to) for k in (1, 2, 3)] == [("revisit", 2), ("response", None), ("response", None)]


def test_chat(spark, messy):
    folder, *_, turns = messy
    got = {r.conv_id: r for r in QUERIES["op6_chat_format"](spark, folder).collect()}
    said = "</s>[INST] ok [/INST]"
    conversations = defaultdict(list)
    for c, t, role, text in [*turns, (-7, 0, "user", said), (-7, 1, "assistant", said)]:
        conversations[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(conversations)
    for c, found in conversations.items():
        found.sort()
        loss = "".join(x for *_, r, x in found if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(found), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for *_, a, b in found).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_template_language():
    render = templates.compiled("{# c #}{% set a = 'x' ~ 1 %}{% for m in ms %}{% if loop.first and not m.skip %}[{{ m['t'] | upper }}]{% elif m.t in 'abc' %}"
                                "{% generation %}{{ m.t }}{% endgeneration %}{% else %}{{ a }}{% endif %}{% endfor %}{% if 1 == 2 %}no{% endif %}{{ none }}{{ true }}")
    assert render({"ms": [{"t": "q"}, {"t": "b"}, {"t": "z", "skip": 1}]}) == ("[Q]bx1true", [(3, 4)])
    tree = templates.fold(templates.parse("a{{ 'b' ~ 'c' }}{% if true %}d{% else %}{{ e }}{% endif %}"), {})
    assert tree == ("block", ("print", ("constant", "abcd")))
    for bad in ("{% if %}{% endif %}", "{% for x %}{% endfor %}", "{% if a %}", "{{ a b }}", "{{ x | nothing }}", "{% import os %}"):
        with pytest.raises(SyntaxError):
            templates.compiled(bad)


@pytest.mark.parametrize("source,context,want", [
    ("a  {%- if x -%}  b  {%- endif -%}  c", {"x": 1}, "abc"), ("a {{- 'b' -}} c {#- x -#} d", {}, "abcd"),
    ("{{ m[0]['role'] }}{{ m[-1].role }}{{ m[0].role[1:] }}{{ m[1:][0].role }}{{ m[:1] | length }}", {"m": [{"role": "user"}, {"role": "bot"}]}, "userbotserbot1"),
    ("{% for x in m[1:] %}{{ loop.index }}{{ loop.length }}{{ loop.index0 % 2 == 1 }}{% endfor %}", {"m": "abc"}, "12false22true"),
    ("{% if\nx is defined and y is not defined %}y{% endif %}{% if z is none %}n{% endif %}", {"x": 0, "z": None}, "yn"),
    ("{% set a = 'x' + b %}{{ a }}{% set c = 1 + 2 - 4 %}{{ c }}{% if 3 >= 2 and not 1 > 2 and 'q' not in a %}!{% endif %}", {"b": "y"}, "xy-1!"),
    ("{% if m.gone %}1{% elif not m.gone %}2{% endif %}{{ m.gone == 'x' }}{% set e = x == 1 %}{{ e }}", {"m": {}, "x": 1}, "2falsetrue"),
])
def test_templates_as_written_in_public(source, context, want):
    assert templates.compiled(source)(context)[0] == want


@pytest.mark.parametrize("source", ["{{ unknown }}", "{{ m.gone }}", "{{ m['gone'] | upper }}", "{{ 'a' ~ m.gone }}", "{% for x in gone %}{% endfor %}", "{{ l[5] }}",
                                    "{{ m.gone.more }}", "{{ 1 + m.t }}", "{{ gone[1:] }}", "{{ 'x' in gone }}", "{{ gone | length }}"])
def test_what_is_not_there_is_an_error(source):
    with pytest.raises(templates.RenderError):
        templates.compiled(source)({"m": {"t": "x"}, "l": [1]})


@pytest.mark.parametrize("source", ["{{ m.t.strip() }}", "{{ raise_exception('x') }}", "{{ a is odd }}", "{{ a[1:2:3] }}", "{{ a[1 }}", "{{ 1 + 'a' }}", "{{ a not b }}"])
def test_what_the_language_lacks_is_an_error(source):
    with pytest.raises(SyntaxError):
        templates.compiled(source)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "[", "INST]", "a", "\n"]), max_size=12).map("".join))
def test_escape_is_reversible_and_hides_control_strings(text):
    controls = ("<s>", "</s>", "[INST]", "[/INST]")
    hidden = templates.escaper(controls)(text)
    assert templates.unescape(hidden) == text and not any(c in hidden for c in controls)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables not present")
def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    trusted = labels.where("quality = 1 and toxic = 0 and pmod(hash(doc_id), 2) = 0")
    found = {r.doc_id: r.kept for r in perplexity.classify(spark.read.parquet(f"{folder}/documents.parquet"), trusted).collect()}
    held = labels.where("pmod(hash(doc_id), 2) = 1").collect()
    good = [found[r.doc_id] for r in held if r.quality == 1 and r.toxic == 0]
    bad = [found[r.doc_id] for r in held if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_classifier_on_awkward_rows(spark, messy):
    folder, docs, *_ = messy
    got = QUERIES["op7_quality_classifier"](spark, folder).collect()
    assert Counter((r.doc_id, r.lang, r.n_chars) for r in got) == Counter((d, lang, len(t or "")) for d, t, lang, *_ in docs)
    assert all((r.perplexity is None) == (r.n_chars == 0) and not (r.kept and r.n_chars == 0) for r in got)


def _hash_chain(values, width=5):
    out = []
    hashed = [brute.xxhash.xxh64_intdigest(v.encode(), 42) for v in values]
    for i in range(max(len(hashed) - width, 0) + 1):
        h = 42
        for x in hashed[i:i + width]:
            h = brute.xxhash.xxh64_intdigest(x.to_bytes(8, "little"), h)
        out.append(h & ((1 << 63) - 1))
    return out


def _sketch(text):
    found = set(_hash_chain(brute.words(text))) if brute.words(text) else set()
    return sorted(h for h in found if h < 1 << 60 or h == min(found))


def test_sketches(spark, messy):
    folder, docs, *_ = messy
    got = QUERIES["op8_fingerprint_documents"](spark, folder).collect()
    want = _sketched([(d, t) for d, t, *_ in docs])
    assert Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, got)) == want


def _sketched(docs):
    def hashed(t):
        return int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)) >> 12
    order = [(d is None, d, t, _sketch(t)) for d, t in sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is None, r[0] or 0, hashed(r[1]), r[1]))]
    want = Counter()
    for k, (missing, d, t, sketch) in enumerate(order):
        following = order[(k + 1) % len(order)]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[2][:half]

        def near(a, b):
            return 1.0 if not a and not b else len(set(a) & set(b)) / min(len(a), len(b)) if a and b else 0.0
        said = "".join(f"{x:016x}" for x in sketch)
        other = _sketch(edited)
        want[None if missing else d, len(t), hashlib.sha256(edited.encode()).hexdigest(), said, "".join(f"{x:016x}" for x in other),
             round(near(sketch, other), 9), round(near(sketch, following[3]), 9)] += 1
    return want


@pytest.mark.parametrize("hot, share, base", [(None, 0.4, 0), (7, 0.4, 0), (None, 1.0, 0), ((1 << 60) + 7, 0.3, 1 << 60)])
def test_an_id_of_many_rows_fills_many_ranges(spark, tmp_path, hot, share, base):
    from linesmith.llm import sketch as sketches
    draw = random.Random(3)
    docs = [(hot if draw.random() < share else base + k, " ".join(f"w{draw.randrange(90)}" for _ in range(draw.randint(0, 12)))) for k in range(600)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bounds = sketches._bounds(table.withColumn("sketch_hash", F.shiftright(F.xxhash64("text"), 12)), "doc_id", 32)
    assert base or 25 <= len(bounds) <= 64 and sum(b[1] == hot for b in bounds) >= 10 * share
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op8_fingerprint_documents"](spark, str(tmp_path)).collect()
    assert Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, got)) == _sketched(docs)


def test_copies_of_one_row_are_numbered_in_any_chunks(spark):
    from linesmith.llm.mixing import mix, sized
    docs = spark.createDataFrame([(None, "a b c", "s")] * 50 + [(None, None, None)] * 9 + [(k, f"w {k}", "s") for k in range(20)], "doc_id long, text string, source string")
    tables = [Counter(tuple(r) for r in sized(docs.repartition(n), chunk=c).collect()) for n, c in ((1, 4096), (5, 3), (3, 50))]
    assert tables[0] == tables[1] == tables[2] and max(tables[0].values()) == 1 and sum(tables[0].values()) == 79
    copies = mix(sized(docs, chunk=7), share=1.5, weights=(5.0, 2.0, 1.0), epochs=2).where("mix_epoch = 0").collect()
    assert len({r.mix_finish for r in copies if r.mix_id is None and r.mix_source == "s"}) == 50
    assert len({r.mix_finish for r in copies if r.mix_source is None}) == 9 and all(0 <= r.mix_finish < 1 for r in copies if r.mix_source is None)


def test_copies_of_one_row_have_slots_in_many_slices(spark):
    docs = spark.createDataFrame([(None, "a b c")] * 500 + [(k, f"w {k}") for k in range(50)], "doc_id long, text string").repartition(3)
    got = sharding.shard_by_bytes(docs, 3).collect()
    copies = sorted(r.slot for r in got if r.doc_id is None)
    own = [r for r in got if r.shard == next(x.shard for x in got if x.doc_id is None)]
    assert len(got) == 550 and len({r.shard for r in got if r.doc_id is None}) == 1 and len(copies) == 500
    assert sorted(r.slot for r in own) == list(range(len(own)))


def test_substrings(spark, messy):
    folder, docs, *_ = messy
    want = Counter((d, n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
                   for (d, *_), (kept, n) in zip(docs, brute.cut([r[:2] for r in docs]), strict=True))
    assert Counter(rows(spark, "op9_substring_dedup", folder)) == want


@pytest.mark.parametrize("largest", [0, 2])
def test_substrings_split_by_whole_windows_and_small_groups(spark, messy, largest):
    folder, docs, *_ = messy
    table = spark.read.parquet(f"{folder}/documents.parquet")
    out = without_repeats(table, group=3, largest=largest)
    assert out.columns[:len(table.columns)] == table.columns
    want = Counter((d, t, " ".join(kept)) for (d, t, *_), (kept, _) in zip(docs, brute.cut([r[:2] for r in docs]), strict=True))
    assert Counter((r.doc_id, r.text, r.cut_kept) for r in out.collect()) == want


def test_rules(spark, messy):
    folder, docs, *_ = messy
    assert Counter(rows(spark, "op10_quality_rules", folder)) == Counter(brute.rules([(d, t, s) for d, t, _, s, _ in docs]))
