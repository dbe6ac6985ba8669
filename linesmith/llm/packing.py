"""Documents as token pieces, packed into few sequences.

Lengths are whole numbers up to the capacity, so the packing is planned on
their histogram, which has at most ``capacity`` rows whatever the input:

* Of the pieces above a third of the capacity at most two fit a sequence. They
  are matched greedily, from the longest on, with the longest that still fits,
  which leaves as few unmatched as can be.
* Shorter pieces, longest first, go into the smallest gap that takes them, and
  what no gap takes opens new sequences.

Plan steps treat all sequences with the same gap alike, so a step is a run of
pieces of one length that fill a run of sequences. Spark numbers the pieces of
each length, salted so that a length shared by a third of all rows is numbered
in slices, and a join with the plan's runs gives each its place.

Null text is an empty one; its one piece holds the end token. Null ids are ids;
rows of one id are numbered in slices by their pieces' digests. Equal rows are
packed each by itself and share a slice. Long texts are read in slices. Without
rows there are no sequences. Other columns of the input are not read.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .batches import cuts, sliced
from .shipping import ship
from .texts import salt, salts, text_of

ship(__name__)

RUN_CACHE, PIECE_CACHE = 1 << 17, 1 << 19


#: The normalizer and splitter of vocabularies whose pieces are cut here, and the same cut for plain runs.
NORMAL = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*")
CUT = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones themselves, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class PieceTokens(dict):
    """Token bytes of each piece of a run, from the tokenizer's model."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECE_CACHE:
            self.clear()
        found = self.model.tokenize(piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()]))
        value = self[piece] = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        return value


class RunTokens(dict):
    """Token bytes of each run of non-blanks; forgotten when there are too many.

    Only for tokenizers that drop white space: a text's tokens are then those of
    its runs in a row. Runs are split at ASCII white space, which every such
    tokenizer takes for white space. Where the tokenizer lowers, splits and maps
    bytes in the usual way, runs of Latin letters and marks are cut into pieces
    here, and a piece goes to the tokenizer's model once; all other runs go
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        usual = ([n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])] == NORMAL and [s["type"] for s in steps] == ["Split", "ByteLevel"]
                 and steps[0]["pattern"] == {"Regex": SPLIT} and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"])
        self.pieces = PieceTokens(self.tokenizer.model) if usual else None
        self.added = [t["content"] for t in made["added_tokens"]]

    def __missing__(self, run: bytes) -> bytes:
        if len(self) >= RUN_CACHE:
            self.clear()
        value = self[run] = self._found(run)
        return value

    def _found(self, run: bytes) -> bytes:
        if self.pieces is not None:
            if run.isalpha():  # of bytes: a-z and A-Z only
                return self.pieces[run.lower().decode()]
            if run[:-1].isalpha() and run[-1:] in (b".", b","):
                return self.pieces[run[:-1].lower().decode()] + self.pieces[run[-1:].decode()]
        text = run.decode()
        if self.pieces is not None and PLAIN.fullmatch(text) and not any(a in text for a in self.added):
            return b"".join(map(self.pieces.__getitem__, CUT.findall(text.lower())))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text. Each distinct run of some megabytes of text is looked up once."""
        for start, stop in cuts(texts):
            runs = pc.ascii_split_whitespace(texts[start:stop])
            flat = runs.flatten().dictionary_encode()
            coded = list(map(self.__getitem__, flat.dictionary.cast(pa.binary()).to_pylist()))
            known, lengths = np.frombuffer(b"".join(coded), dtype="<u4"), np.fromiter(map(len, coded), dtype=np.int32, count=len(coded)) // 4
            at = flat.indices.to_numpy()
            counts, firsts = lengths[at], (np.cumsum(lengths) - lengths)[at]
            ends = np.concatenate([[0], np.cumsum(counts)])
            ids = known[np.repeat((firsts - ends[:-1]).astype(np.int32), counts) + np.arange(ends[-1], dtype=np.int32)]
            edges = ends[runs.offsets.to_numpy() - runs.offsets[0].as_py()]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield ids[a:b]


def pieces(docs: DataFrame, vocabulary: str, *, capacity: int, id: str = "doc_id", text: str = "text", end: int = 0) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian 32-bit) of every piece.

    ``vocabulary`` is the path of a ``tokenizers`` file whose pre-tokenizer drops
    white space; executors read it there.
    """
    names = [id, "piece", "start", "length", "ids"]

    def start():
        known, tail, step = RunTokens(vocabulary), np.array([end], dtype="<u4").tobytes(), 4 * capacity

        def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, found in zip(batch.column(0).to_pylist(), known.of(batch.column(1)), strict=True):
                ids = found.tobytes() + tail
                for k in range(0, len(ids), step):
                    cut = ids[k:k + step]
                    for column, value in zip(out, (doc, k // step, k // 4, len(cut) // 4, cut), strict=True):
                        column.append(value)
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
        return rows
    kind = dict(docs.dtypes)[id]
    return docs.select(id, text_of(text).alias("pack_text")).mapInArrow(
        sliced("pack_text", start), f"`{id}` {kind}, piece int, start long, length long, ids binary")


@dataclass(frozen=True)
class Run:
    """Pieces ``low`` to ``high`` of a length: ``per`` to a sequence from ``first`` on, at ``offset``."""
    length: int
    low: int
    high: int
    first: int
    per: int
    offset: int


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs that place all pieces, and the number of sequences."""
    runs: list[Run] = []
    done = dict.fromkeys(histogram, 0)
    left = dict(histogram)
    opened = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, number) with that gap

    def gap(size: int, first: int, number: int) -> None:
        if size > 0 and number:
            gaps.setdefault(size, []).append((first, number))

    def put(length: int, number: int, first: int, per: int, offset: int) -> None:
        runs.append(Run(length, done[length], done[length] + number, first, per, offset))
        done[length] += number
        left[length] -= number

    large = sorted((s for s in histogram if 3 * s > capacity), reverse=True)
    partners = sorted(large)  # ascending; those used up are dropped from the end they are met at
    for size in large:
        while left[size]:
            fitting = next((p for p in reversed(partners) if p + size <= capacity and left[p] - (p == size) > 0), None)
            if fitting is None:
                number = left[size]
                put(size, number, opened, 1, 0)
                gap(capacity - size, opened, number)
            elif fitting == size:
                number = left[size] // 2
                put(size, 2 * number, opened, 2, 0)
                gap(capacity - 2 * size, opened, number)
            else:
                number = min(left[size], left[fitting])
                put(size, number, opened, 1, 0)
                put(fitting, number, opened, 1, size)
                gap(capacity - size - fitting, opened, number)
            opened += number
    for size in sorted((s for s in histogram if 3 * s <= capacity), reverse=True):
        while left[size]:
            best = min((g for g in gaps if g >= size), default=None)
            if best is None:
                per = capacity // size
                number = left[size] // per
                if number:
                    put(size, number * per, opened, per, 0)
                    gap(capacity - per * size, opened, number)
                    opened += number
                if left[size]:
                    rest = left[size]
                    put(size, rest, opened, rest, 0)
                    gap(capacity - rest * size, opened, 1)
                    opened += 1
                continue
            first, number = gaps[best].pop()
            if not gaps[best]:
                del gaps[best]
            per, offset = best // size, capacity - best
            whole = min(number, left[size] // per)
            if whole:
                put(size, whole * per, first, per, offset)
                gap(best - per * size, first, whole)
            if whole < number:
                rest = left[size]
                if rest:
                    put(size, rest, first + whole, rest, offset)
                    gap(best - rest * size, first + whole, 1)
                    whole += 1
                gap(best, first + whole, number - whole)
    return runs, opened


def pack(items: DataFrame, capacity: int, length: str = "length", order: Iterable[str] = ("doc_id", "piece")) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. ``items`` is read more than once: pass a stored table.

    Lengths are from 1 to ``capacity``.
    """
    spark, order = items.sparkSession, list(order)
    counts = {r[0]: r[1] for r in items.groupBy(length).agg(F.count("*")).collect()}
    if any(not 0 < size <= capacity for size in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    runs, _ = plan(counts, capacity)
    table = spark.createDataFrame([(r.length, r.low, r.high, r.first, r.per, r.offset) for r in runs],
                                  "pack_length long, pack_low long, pack_high long, pack_first long, pack_per long, pack_offset long")
    salted = items.withColumn("pack_salt", salt(salts(spark), *order))
    earlier = Window.partitionBy(length).orderBy("pack_salt").rowsBetween(Window.unboundedPreceding, -1)
    slices = (salted.groupBy(length, "pack_salt").agg(F.count("*").alias("n"))
              .select(length, "pack_salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("pack_before")))
    inside = Window.partitionBy(length, "pack_salt").orderBy(*order)
    numbered = salted.join(slices, [length, "pack_salt"]).withColumn("pack_rank", F.col("pack_before") + F.row_number().over(inside) - 1)
    # the plan's size depends on the capacity alone
    placed = numbered.join(F.broadcast(table), (F.col(length) == F.col("pack_length")) & (F.col("pack_rank") >= F.col("pack_low")) & (F.col("pack_rank") < F.col("pack_high")))
    within = F.col("pack_rank") - F.col("pack_low")
    return placed.select(*items.columns, (F.col("pack_first") + F.floor(within / F.col("pack_per"))).cast("long").alias("sequence_id"),
                         (F.col("pack_offset") + within % F.col("pack_per") * F.col(length)).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """Every piece of every document with its place; ``ids_crc32`` instead of the ids, which a join with ``pieces`` gives."""
    cut = staged(pieces(docs, vocabulary, capacity=capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return pack(cut, capacity, order=("doc_id", "piece", "ids_crc32"))
