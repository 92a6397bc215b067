"""Best-fit decreasing packing of tokenized documents into sequences.

A document is its token ids and an end id. One longer than a sequence is cut
into whole sequences with the shorter rest first; nothing else is cut. Pieces
are placed in descending order of length, each into the fullest open sequence
that still has room. Pieces of equal length are interchangeable and so are
sequences of equal content, so the placement needs only how many pieces of each
length there are: at most ``capacity`` numbers, whatever the number of documents.
The driver finds, through a segment tree over the remaining capacities, where
each run of equal pieces goes; the tasks then look up each piece's place by its
number among the pieces of its length.

Defined results: a null text is empty and gives the end id alone; repeated rows
are packed each; equal lengths are placed in the order of the tasks that
tokenized them; an empty table gives an empty result. Columns of the input
other than the named ones play no role.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import packed, stored

#: Texts with a character from here on go to the tokenizer itself.
_BEYOND_LATIN = re.compile("[^\0-\u024f]")


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The ids of a byte-level tokenizer file by their bytes, if ids follow the order of the merges; else None."""
    model = (spec := json.loads(Path(path).read_text()))["model"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or [model["vocab"][m] for m in merged] != [256 + i for i in range(len(merged))]:
        return None
    # in such files a printable byte stands for itself and the others for the characters from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(shown[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


class Tokens:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Where the tokenizer's file allows it, Latin texts go through its merges in
    the faster of two libraries; the libraries may know different letters of
    other scripts, so these go to the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings inside a text are ordinary text
        self.fast = None
        if ranks := merge_ranks(path):
            import tiktoken

            self.fast = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def of(self, text: str) -> bytes:
        plain = self.fast and not _BEYOND_LATIN.search(text)
        ids = self.fast(text) if plain else self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, place): every document's pieces.

    ``place`` numbers a task's pieces of one length in the order it made them; ``part`` is the task.
    """
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seen = Tokens(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = memoryview(tokens.of(value.as_py() or "") + last)
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((key, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), part, int(seen[b - a])))
                    seen[b - a] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    needed = packed(docs, [], doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    return needed.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long")


class OpenSequences:
    """A segment tree over remaining capacities: which are there among the open sequences."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.runs: dict[int, list[Run]] = {}

    def add(self, remaining: int, run: Run) -> None:
        self.runs.setdefault(remaining, []).append(run)
        self._mark(remaining, True)

    def take(self, remaining: int) -> Run:
        run = self.runs[remaining].pop()
        if not self.runs[remaining]:
            self._mark(remaining, False)
        return run

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length``, in logarithmic time."""
        at = self.leaves + length
        if self.any[at]:
            return length
        while at > 1 and (at % 2 or not self.any[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves

    def _mark(self, remaining: int, there: bool) -> None:
        at = self.leaves + remaining
        self.any[at] = there
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]


@dataclass(frozen=True)
class Run:
    """``n`` sequences of equal content with consecutive numbers, filled up to ``used``."""

    first: int
    n: int
    used: int


def placement(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Slots (length, first piece, first sequence, pieces in each sequence, offset), and the number of sequences.

    Best-fit decreasing over runs of equal pieces. Filling a run of sequences
    splits it at most once per length, so runs and slots are bounded by the
    number of lengths, not of pieces.
    """
    open_, slots, opened = OpenSequences(capacity), [], 0
    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            remaining = open_.tightest(length)
            if remaining is None:
                fits = capacity // length
                run = Run(opened, -(-(total - done) // fits), 0)
                opened += run.n
                remaining = capacity
            else:
                run = open_.take(remaining)
            each = min(remaining // length, total - done)
            full = min(run.n, (total - done) // each)
            slots.append((length, done, run.first, each, run.used))
            done += full * each
            if remaining - each * length:
                open_.add(remaining - each * length, Run(run.first, full, run.used + each * length))
            if full < run.n:
                rest = Run(run.first + full, run.n - full, run.used)
                open_.add(remaining, rest)
    return slots, opened


def packed_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece.

    Pieces without their ids are written once. A piece's number among all of its length is its number in its task plus
    the count of that length in earlier tasks.
    """
    made = stored(pieces(docs, tokenizer, capacity, end, text, doc_id), "packing-pieces")
    per_task = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, _ = placement(counts, capacity)
    order = np.array(sorted(slots), dtype=np.int64).reshape(len(slots), 5)
    lengths, firsts, sequences, each, offsets = (np.ascontiguousarray(order[:, i]) for i in range(5))
    begins = np.searchsorted(lengths, np.arange(capacity + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            slot = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length).tolist():
                at = length == value
                own = slice(begins[value], begins[value + 1])
                slot[at] = begins[value] + np.searchsorted(firsts[own], number[at], side="right") - 1
            within = number - firsts[slot]
            sequence = sequences[slot] + within // each[slot]
            offset = offsets[slot] + within % each[slot] * length
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    numbered = made.join(before, ["length", "part"]).withColumn("number", F.col("place") + F.col("before"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
