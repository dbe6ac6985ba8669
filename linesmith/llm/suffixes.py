"""Removal of repeated passages by prefix-partitioned suffix trees.

A suffix starts at every word that has a whole window of ``width`` words behind
it. Only the first ``width`` words of a suffix matter, so trees end at that
depth. Suffixes are split by a prefix of variable length: it ends with the key,
the run of ``key`` words with the least hash inside the window. Equal windows
have equal prefixes, neighbours mostly share their key, and the suffixes of one
key in a row are handled as one chunk.

1. Chunks are dealt out by key as hashes, without their text. Chunks equal in
   all words are copies: the first one stands for them, and the others are
   repeats from end to end. A task sends the first of its copies only, so however
   hot a passage is, each task sends it once.
   Keys that more than a ``HOT``-th of all chunks have, as a phrase in every text
   makes them, are counted first and dealt by key and words.
2. A key that leaves a single chunk has no other repeat. Of keys with several
   chunks these are fetched as text, and dealt out by key in groups that fit
   memory. A key with more chunks than ``largest`` is split by the longest
   prefix, the whole window.
3. Each group's suffixes are sorted, neighbours' common prefixes give the
   subtree, and its nodes as deep as the window are the repeats: all but the
   first start are marked.
4. Words that a marked window covers are removed.

A document is named by its id and two hashes of its text, 127 bits together.
Order is that of ids, then of these, then of starts. Null text has no words, an
empty table gives an empty one, and a text is handled whole in one row. Null
ids come last. Rows with equal ids are documents of their own in order of a hash
of their text; rows with equal ids and texts are one document and get one result.
Columns of the input that are named like the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .batches import sliced
from .shipping import ship
from .texts import shuffle_width, text_of

ship(__name__)

LAST_ID = (1 << 63) - 1
#: What tells documents apart; ``cut_doc`` and ``cut_more`` are hashes of the text.
DOCUMENT = ["cut_id", "cut_doc", "cut_more"]
DOCUMENT_TYPES = "cut_id long, cut_doc long, cut_more long"
CACHE = 1 << 16
#: A key with more than this part of all chunks is dealt by words as well; there are fewer such keys.
HOT = 8_192


class WordHashes(dict):
    """Hashes of words met so far, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A mixed hash of every run of ``length`` words."""
    out, factor = np.zeros(len(hashes) - length + 1, dtype=np.uint64), 1
    for k in range(length):
        out += hashes[k:k + len(out)] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def chunks_of(hashes: np.ndarray, width: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and key hash of every chunk of a document."""
    if len(hashes) < width:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64)
    runs = run_hashes(hashes, key)
    choice = width - key + 1
    windows = len(hashes) - width + 1
    least = np.concatenate([
        np.lib.stride_tricks.sliding_window_view(runs[at:at + (1 << 18) + choice - 1], choice).argmin(axis=1) + at
        + np.arange(min(1 << 18, windows - at)) for at in range(0, windows, 1 << 18)])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return first, np.diff(np.append(first, windows)), runs[least[first]]


SENT = ["cut_key", "cut_same", *DOCUMENT, "cut_at", "cut_n", "cut_copy"]
SENT_TYPES = f"cut_key long, cut_same long, {DOCUMENT_TYPES}, cut_at long, cut_n long, cut_copy boolean"
#: The columns of a document, from first to last.
Documents = tuple[np.ndarray, ...]


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _documents(rows: pa.RecordBatch | pa.Table) -> Documents:
    return tuple(rows.column(c).to_numpy() for c in DOCUMENT)


def _picked(docs: Documents, rows: np.ndarray) -> Documents:
    return tuple(d[rows] for d in docs)


def _runs(docs: Documents, ats: np.ndarray, counts: np.ndarray) -> tuple[Documents, np.ndarray, np.ndarray]:
    """Adjoining stretches of a document as one: (document, first start, number of starts)."""
    order = np.lexsort((ats, *docs[::-1]))
    docs, ats, counts = _picked(docs, order), ats[order], counts[order]
    other = np.any([d[1:] != d[:-1] for d in docs], axis=0)
    first = np.flatnonzero(np.concatenate([[True], other | (ats[1:] != ats[:-1] + counts[:-1])]))
    return _picked(docs, first), ats[first], np.add.reduceat(counts, first) if len(first) else counts


def _marked(docs: Documents, ats: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows for repeats."""
    docs, ats, counts = _runs(docs, ats, counts)
    none = np.zeros(len(ats), dtype=np.int64)
    return _batch(SENT, none, none, *docs, ats, counts, np.ones(len(ats), dtype=bool))


def _leaders(docs: Documents, ats: np.ndarray, *names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order of ``names``, document and start; whether each is the first of its names, and whether a later start repeats it."""
    order = np.lexsort((ats, *docs[::-1], *names[::-1]))
    new = np.concatenate([[True], np.any([n[order][1:] != n[order][:-1] for n in names], axis=0)])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = ~new & np.any([c[order] != c[first] for c in (*docs, ats)], axis=0)
    return order, new, later


def chunk_hashes(hashes: np.ndarray, first: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """A hash of all words of each chunk, from running sums: an odd factor has an inverse."""
    factor, inverse = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
    powers = np.cumprod(np.full(len(hashes), factor, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * powers)])
    back = np.cumprod(np.full(len(hashes) + 1, inverse, dtype=np.uint64))
    out = (sums[first + count + width - 1] - sums[first]) * back[first] + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(31))


def _sent_rows(width: int, key: int):
    """The chunks of each document, the first of a slice's copies only; the other copies are marked at once."""
    def start():
        known = WordHashes()

        def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found, times = [], []
            for text in batch.column("cut_text"):
                parts = text.as_py().split()
                hashes = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
                first, count, keys = chunks_of(hashes, width, key)
                times.append(len(first))
                if len(first):
                    found.append((keys, chunk_hashes(hashes, first, count, width), first, count))
            if not found:
                return
            keys, same, first, count = (np.concatenate(c) for c in zip(*found, strict=True))
            keys, same = keys.view(np.int64), same.view(np.int64)
            docs = tuple(np.repeat(d, times) for d in _documents(batch))
            order, new, later = _leaders(docs, first, keys, same)
            lead, again = order[new], order[later]
            yield _batch(SENT, keys[lead], same[lead], *_picked(docs, lead), first[lead], count[lead], np.zeros(len(lead), dtype=bool))
            if len(again):
                yield _marked(_picked(docs, again), first[again], count[again])
        return rows
    return sliced("cut_text", start)


def _first_rows(largest: int):
    """Copies as marks, and the chunks of keys that have several, from rows in order of key, words, id and start.

    What goes on from one batch to the next is the last chunk that leads its
    copies, how many chunks its key has so far, and whether it was sent.
    ``cut_crowd`` is true for one row of a key that has more than ``largest``. Of
    hot keys, whose chunks other tasks have too, all are sent.
    """
    names = ["cut_key", *DOCUMENT, "cut_at", "cut_n", "cut_copy", "cut_crowd"]
    passed = names[:-1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, sent = None, 0, False
        for batch in batches:
            copy = batch.column("cut_copy").to_numpy(zero_copy_only=False)
            if copy.any():
                part = batch.filter(pa.array(copy))
                yield _batch(names, *(part.column(c) for c in passed), np.zeros(part.num_rows, dtype=bool))
                batch = batch.filter(pa.array(~copy))
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*SENT[:-1], "cut_hot")]
            if held is not None:
                columns = [np.concatenate([[h], c]) for h, c in zip(held, columns, strict=True)]
            key, same, *docs, ats, count, hot = columns
            order, new, later = _leaders(docs, ats, key, same)  # in order already, but for the ties of equal rows
            assert held is None or order[0] == 0
            lead = order[new]
            starts = np.flatnonzero(np.concatenate([[True], key[lead][1:] != key[lead][:-1]]))
            sizes = np.diff(np.append(starts, len(lead)))
            sizes[0] += max(before - 1, 0)  # chunks of the first key in earlier batches, but for the held one
            number = np.repeat(sizes, np.diff(np.append(starts, len(lead))))
            place = np.arange(len(lead)) - np.repeat(starts, np.diff(np.append(starts, len(lead))))
            place[:len(lead) if len(starts) == 1 else starts[1]] += max(before - 1, 0)
            wanted = (number > 1) | hot[lead]
            if held is not None and sent:
                wanted[0] = False
            pick = lead[wanted]
            if len(pick):
                yield _batch(names, key[pick], *_picked(docs, pick), ats[pick], count[pick], np.zeros(len(pick), dtype=bool), place[wanted] == largest)
            again = order[later]
            if len(again):
                marks = _marked(_picked(docs, again), ats[again], count[again])
                yield _batch(names, *(marks.column(c) for c in passed), np.zeros(marks.num_rows, dtype=bool))
            last = lead[-1]
            held, before, sent = tuple(c[last] for c in columns), int(sizes[-1]), bool(sizes[-1] > 1 or hot[last])
    return rows


def _text_rows(width: int):
    """The wanted chunks with their words; those of crowded keys window by window, under a hash of the window."""
    names = ["cut_key", *DOCUMENT, "cut_at", "cut_n", "cut_words", "cut_copy"]

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import xxhash

        out: list[tuple] = []
        split: list[tuple] = []
        for *doc, text, wanted in zip(*(batch.column(k).to_pylist() for k in (*DOCUMENT, "cut_text", "cut_wanted")), strict=True):
            parts = text.split()
            for x in wanted:
                at = x["cut_at"]
                if not x["cut_crowd"]:
                    out.append((x["cut_key"], *doc, at, x["cut_n"], b" ".join(parts[at:at + x["cut_n"] - 1 + width])))
                    continue
                for k in range(x["cut_n"]):
                    window = b" ".join(parts[at + k:at + k + width])
                    split.append((xxhash.xxh64_intdigest(window, 2) - (1 << 63), *doc, at + k, 1, window))
        if split:  # as with chunks, a slice sends the first of equal windows
            keys, *docs, ats = (np.array(c) for c in list(zip(*split, strict=True))[:-2])
            other = np.array([xxhash.xxh64_intdigest(w[-1], 3) for w in split], dtype=np.uint64)
            order, new, later = _leaders(docs, ats, keys, other)
            out += [split[i] for i in order[new]]
            again = order[later]
            if len(again):
                marks = _marked(_picked(docs, again), ats[again], np.ones(len(again), dtype=np.int64))
                yield _batch(names, *(marks.column(c) for c in names[:-2]), pa.nulls(marks.num_rows, pa.binary()), marks.column("cut_copy"))
        if out:
            yield _batch(names, *zip(*out, strict=True), np.zeros(len(out), dtype=bool))
    return sliced("cut_text", lambda: rows)


def repeats(texts: list[bytes], counts: np.ndarray, docs: Documents, ats: np.ndarray, width: int) -> tuple[Documents, np.ndarray]:
    """(document, start) of all suffixes but the first below each node of depth ``width``.

    Sorted suffixes and the common prefixes of neighbours are the tree: a node
    of depth d is a run of neighbours with at least d words in common.
    """
    names: dict[bytes, int] = {}
    coded = [np.array([names.setdefault(w, len(names)) for w in t.split(b" ")], dtype=np.int32) for t in texts]
    bases = np.concatenate([[0], np.cumsum([len(c) for c in coded])[:-1]])
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(bases, counts) + within
    owner, place = tuple(np.repeat(d, counts) for d in docs), np.repeat(ats, counts) + within
    heads = np.concatenate(coded)[starts[:, None] + np.arange(width)]
    order = np.lexsort((place, *owner[::-1], *heads.T[::-1]))
    heads = heads[order]
    depth = np.where((same := heads[1:] == heads[:-1]).all(axis=1), width, same.argmin(axis=1))
    above = np.concatenate([[True], depth < width])  # a new node begins
    first = order[np.maximum.accumulate(np.where(above, np.arange(len(order)), 0))]
    again = order[~above & np.any([c[order] != c[first] for c in (*owner, place)], axis=0)]
    return _picked(owner, again), place[again]


def _tree_rows(width: int, group: int):
    """Marks pass as they are; chunks come in order of key and are gathered into groups of whole keys."""
    names = [*DOCUMENT, "cut_at", "cut_n"]

    def solve(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        docs, ats = repeats(rows["cut_words"].to_pylist(), rows["cut_n"].to_numpy(), _documents(rows), rows["cut_at"].to_numpy(), width)
        if len(ats):
            docs, ats, counts = _runs(docs, ats, np.ones(len(ats), dtype=np.int64))
            yield _batch(names, *docs, ats, counts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            copy = batch.column("cut_copy").to_numpy(zero_copy_only=False)
            if copy.any():
                yield batch.filter(pa.array(copy)).select(names)
                batch = batch.filter(pa.array(~copy))
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= group:
                joined = pa.Table.from_batches(held).combine_chunks()
                keys = joined["cut_key"].to_numpy()
                whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if whole:
                    yield from solve(joined.slice(0, whole).to_batches())
                    held = joined.slice(whole).to_batches()
        if held:
            yield from solve(held)
    return rows


def _kept_rows(width: int, names: list[str]):
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        total, removed, kept = [], [], []
        for text, spans in zip(*(batch.column(k).to_pylist() for k in ("cut_text", "cut_spans")), strict=True):
            parts = text.split()
            edges = np.zeros(len(parts) + 1, dtype=np.int64)
            for span in spans or ():
                start = span["cut_at"]
                edges[start] += 1
                edges[start + span["cut_n"] - 1 + width] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            total.append(len(parts))
            removed.append(int(gone.sum()))
            kept.append(b" ".join(p for p, g in zip(parts, gone.tolist(), strict=True) if not g) if removed[-1] else b" ".join(parts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names] + [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
            names=[*names, "cut_words", "cut_removed", "cut_kept"])
    return sliced("cut_text", lambda: rows)


def without_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 20, key: int = 6, group: int = 20_000, largest: int = 1_000) -> DataFrame:
    """The rows with ``cut_words``, ``cut_removed`` and ``cut_kept``, the kept words joined by one space.

    ``group`` is the number of chunks whose tree is built at once, ``largest``
    the number above which one key's chunks are split by whole windows; neither
    changes the result. The texts are shuffled once, by id: fetching chunks and
    removing words read the same exchange.
    """
    parts = shuffle_width(docs.sparkSession)
    content = text_of(text)
    added = ("cut_words", "cut_removed", "cut_kept")
    others = [c for c in docs.columns if c != text and c not in added]
    # in order of the hash's last 24 bits, then of the others; null ids after the greatest id
    hashed = F.shiftleft(F.xxhash64(content).bitwiseAND(F.lit((1 << 24) - 1)), 39).bitwiseOR(F.shiftrightunsigned(F.xxhash64(content), 25))
    hashed = F.when(F.col(id).cast("long").isNull(), hashed).otherwise(hashed.bitwiseOR(F.lit(-1 << 63)))
    own = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(LAST_ID)).alias("cut_id"),
        hashed.alias("cut_doc"), F.xxhash64(F.lit("other"), content).alias("cut_more"),
        content.cast("binary").alias("cut_text"), F.struct(F.lit(None).cast("int").alias("cut_none"), *[F.col(f"`{c}`") for c in others]).alias("cut_row"),
        F.col(text).isNull().alias("cut_null"))

    def dealt(rows: DataFrame, *order: str) -> DataFrame:
        """By key; marks, which may all have one, by document."""
        route = F.when(F.col("cut_copy"), F.xxhash64(*DOCUMENT)).otherwise(F.xxhash64("cut_key"))
        if "cut_hot" in rows.columns:
            route = F.when(F.col("cut_hot"), F.xxhash64("cut_key", "cut_same")).otherwise(route)
        return rows.repartition(parts, route).sortWithinPartitions("cut_copy", "cut_key", *order)

    sent = staged(own.select(*DOCUMENT, "cut_text").mapInArrow(_sent_rows(width, key), SENT_TYPES), "sent")
    chunks = sent.where(~F.col("cut_copy"))
    bound = max(largest, chunks.count() // HOT)
    hot = F.broadcast(staged(chunks.groupBy("cut_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound).select("cut_key"), "hot"))
    flagged = sent.join(hot.withColumn("cut_hot", ~F.isnull("cut_key")), "cut_key", "left").withColumn(
        "cut_hot", F.coalesce("cut_hot", F.lit(False)) & ~F.col("cut_copy"))
    known = staged(dealt(flagged, "cut_same", *DOCUMENT, "cut_at").mapInArrow(
        _first_rows(largest), f"cut_key long, {DOCUMENT_TYPES}, cut_at long, cut_n long, cut_copy boolean, cut_crowd boolean"), "chunks")
    firsts = known.where(~F.col("cut_copy")).drop("cut_crowd")
    crowds = known.where("cut_crowd").select("cut_key").distinct().withColumn("cut_many", F.lit(True))
    split = firsts.join(hot, "cut_key").withColumn("cut_many", F.lit(True))
    wanted = (firsts.join(hot, "cut_key", "left_anti").join(crowds, "cut_key", "left").unionByName(split)
              .withColumn("cut_chunk", F.struct("cut_at", "cut_n", "cut_key", F.coalesce("cut_many", F.lit(False)).alias("cut_crowd")))
              .groupBy(*DOCUMENT).agg(F.collect_list("cut_chunk").alias("cut_wanted")))
    placed = own.repartition(parts, *DOCUMENT)
    texts = placed.join(wanted, DOCUMENT).mapInArrow(
        _text_rows(width), f"cut_key long, {DOCUMENT_TYPES}, cut_at long, cut_n long, cut_words binary, cut_copy boolean")
    marks = (dealt(texts).mapInArrow(_tree_rows(width, group), f"{DOCUMENT_TYPES}, cut_at long, cut_n long")
             .union(known.where("cut_copy").select(*DOCUMENT, "cut_at", "cut_n")))
    gathered = (marks.withColumn("cut_span", F.struct("cut_at", "cut_n"))
                .groupBy(*DOCUMENT).agg(F.collect_list("cut_span").alias("cut_spans")))
    joined = placed.join(gathered, DOCUMENT, "left")
    row_type = dict(own.dtypes)["cut_row"]
    done = joined.mapInArrow(_kept_rows(width, ["cut_row", "cut_text", "cut_null"]),
                             f"cut_row {row_type}, cut_text binary, cut_null boolean, cut_words long, cut_removed long, cut_kept binary")
    originals = [F.when(~F.col("cut_null"), F.col("cut_text").cast("string")).alias(c) if c == text else F.col(f"cut_row.`{c}`") for c in docs.columns if c not in added]
    return done.select(*originals, "cut_words", "cut_removed", F.col("cut_kept").cast("string").alias("cut_kept"))
