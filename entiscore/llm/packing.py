"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

A packing instance only depends on how many pieces there are of each length, and
there are at most ``capacity`` lengths.  So Spark tokenises, counts the lengths
(one small aggregate), and numbers the pieces within their length; the packing
itself is solved on that bounded histogram, as runs of identical sequences:

1. *Dominance reduction.*  For the longest length still open, a small set of
   lengths that provably dominates every other way to fill its sequence is fixed,
   for as many sequences as the counts allow at once.
2. *Best fit.*  What is left is packed longest first, each piece into the fullest
   sequence it fits.  Equal sequences are handled as one group with a count, so
   the work depends on the number of lengths, not on the number of pieces.

Each run of equal sequences gives ranges of piece numbers, and an equi-join on
the length with those (few) ranges places every piece.

Edge cases: the literal text of a special token is that token's id; null text counts as empty; an empty text is one piece holding only
the end id; repeated rows are packed as separate pieces; null ``doc_id`` rows are
packed like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiscore.llm.common import written

#: Pieces of one length are numbered within this many hash cells, in parallel.
CELLS = 512

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- tokens -> pieces ------------------------------------------------------

def special_tokens(path: str) -> dict[str, int]:
    """Text and id of the added tokens of a tokenizer ``.json`` (or of the one beside ``path``)."""
    import json

    with open(path.removesuffix(".json").removesuffix(".tiktoken") + ".json", encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def load_encoder(path: str, special: dict[str, int]) -> Callable[[str], list[int]]:
    """Text to ids for a byte-level BPE vocabulary.

    ``path`` names the tokenizer ``.json`` or the ``.tiktoken`` rank file beside it; both hold
    one vocabulary, and the ranks encode several times faster.  The ``special`` tokens of the
    ``.json`` (such as ``<|endoftext|>``) are one id wherever they stand in a text, as in the
    tokenizers library; the ranks alone do not know them.
    """
    import public_tokenizers
    import tiktoken

    own, ranks = set(special.values()), {}
    with open(path.removesuffix(".json").removesuffix(".tiktoken") + ".tiktoken", "rb") as f:
        for token, rank in map(bytes.split, f):
            if int(rank) not in own:
                ranks[base64.b64decode(token)] = int(rank)
    enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, special_tokens=special, mergeable_ranks=ranks)

    def encode(text: str) -> list[int]:
        if any(t in text for t in special):
            return enc.encode(text, allowed_special="all")
        return enc.encode_ordinary(text)

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenize_pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2,
                    with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids`` if asked)."""
    special = special_tokens(vocabulary)           # a few: read once, they travel with the job

    def pieces(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pandas as pd

        encode = load_encoder(vocabulary, special)
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part, out = pdf.iloc[at:at + 512], []
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    ids = np.asarray([*(encode(text) if text else ()), end_id], dtype="<u4")
                    for k, (s, n) in enumerate(cut(len(ids), capacity)):
                        own = ids[s:s + n]
                        row = (None if pd.isna(doc_id) else int(doc_id), k, s, n, zlib.crc32(own.tobytes()))
                        out.append((*row, own.astype("int32")) if with_ids else row)
                cols = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
                yield pd.DataFrame(out, columns=cols).astype({"doc_id": "Int64"})

    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(pieces, schema)


# --- the packing plan on the length histogram ------------------------------

@dataclass
class Run:
    """``count`` equal sequences, each holding ``parts`` = [(length, pieces), ...]."""
    parts: list[tuple[int, int]]
    count: int


class _Counts:
    """Counts by length with sorted access to the lengths still present."""

    def __init__(self, counts: dict[int, int]):
        self.n = dict(counts)
        self.sizes = sorted(s for s, c in counts.items() if c > 0)

    def take(self, size: int, k: int) -> None:
        self.n[size] -= k
        if not self.n[size]:
            self.sizes.remove(size)

    def largest(self, most: int, but: dict[int, int]) -> int:
        """Largest length <= most that is left when ``but`` is set aside; 0 if none."""
        for i in range(bisect_right(self.sizes, most) - 1, -1, -1):
            if self.n[self.sizes[i]] > but.get(self.sizes[i], 0):
                return self.sizes[i]
        return 0

    def smallest(self, k: int, but: dict[int, int], above: int = 0) -> list[int]:
        """The ``k`` smallest lengths > above (with repeats) when ``but`` is set aside."""
        out: list[int] = []
        for s in self.sizes[bisect_right(self.sizes, above):]:
            out += [s] * min(k - len(out), self.n[s] - but.get(s, 0))
            if len(out) == k:
                break
        return out

    def best_pair(self, most: int, but: dict[int, int]) -> int:
        """Largest sum <= most of two pieces that are left when ``but`` is set aside; 0 if none."""
        free = [s for s in self.sizes if self.n[s] > but.get(s, 0)]
        best, i, j = 0, 0, len(free) - 1
        while i <= j:
            if free[i] + free[j] > most:
                j -= 1
            elif i == j and self.n[free[i]] - but.get(free[i], 0) < 2:
                break
            else:
                best = max(best, free[i] + free[j])
                i += 1
        return best


def dominating(left: _Counts, j: int, capacity: int) -> list[int] | None:
    """A set holding length ``j`` that dominates every other set holding it, or None.

    A set dominates another if its pieces can be matched to groups of the other's
    pieces that are no longer in sum: exchanging them never costs a sequence.
    """
    room, own = capacity - j, {j: 1}
    k = left.largest(room, own)
    if not k:
        return [j]                                   # nothing else fits
    if k == room:
        return [j, k]                                # one piece fills the sequence
    small = left.smallest(3, own)
    if len(small) < 2 or small[0] + small[1] > room:
        return [j, k]                                # only one more fits: the longest
    if len(small) == 3 and sum(small) <= room:
        return None
    if k >= left.best_pair(room, own):               # at most two more fit
        return [j, k]
    two = {j: 1}
    two[k] = two.get(k, 0) + 1
    b = left.largest(room - k, two)
    if b and (len(up := left.smallest(2, own, above=b)) < 2 or sum(up) > room):
        return [j, k, b]                             # any other pair is shorter in both
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """Sequences fixed by dominance, and the counts by length that stay open."""
    left, fixed, changed = _Counts(counts), [], True
    while changed:
        changed = False
        for j in sorted(left.sizes, reverse=True):
            while left.n[j] and (f := dominating(left, j, capacity)):
                need = {s: f.count(s) for s in dict.fromkeys(f)}
                times = min(left.n[s] // k for s, k in need.items())
                for s, k in need.items():
                    left.take(s, k * times)
                fixed.append(Run(list(need.items()), times))
                changed = True
    return fixed, {s: left.n[s] for s in left.sizes}


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing over groups of equal sequences."""
    open_: dict[int, list[Run]] = {}

    def put(run: Run, room: int, size: int, each: int) -> None:
        open_.setdefault(room - size * each, []).append(Run([*run.parts, (size, each)], run.count))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            room = min((r for r in open_ if r >= size), default=0)
            run = open_[room].pop() if room else Run([], n)
            if room and not open_[room]:
                del open_[room]
            room = room or capacity
            each = room // size
            full = min(run.count, n // each)
            rest = n - full * each if full < run.count else 0
            if full:
                put(Run(run.parts, full), room, size, each)
            if rest:
                put(Run(run.parts, 1), room, size, rest)
            same = run.count - full - bool(rest)
            if same and run.parts:
                open_.setdefault(room, []).append(Run(run.parts, same))
            n -= full * each + rest
    return [run for runs in open_.values() for run in runs]


def plan_runs(counts: dict[int, int], capacity: int) -> list[Run]:
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def placement_ranges(runs: list[Run]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, sequence, each, offset): pieces numbered first..last of a
    length go ``each`` to a sequence from ``sequence`` on, starting at ``offset``."""
    out, at, base = [], {}, 0
    for run in runs:
        offset = 0
        for size, each in run.parts:
            first = at.get(size, 0)
            at[size] = first + each * run.count
            out.append((size, first, at[size] - 1, base, each, offset))
            offset += size * each
        base += run.count
    return out


# --- Spark -----------------------------------------------------------------

def pack_pieces(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds ``sequence_id, offset`` to pieces with ``doc_id, piece, length, ids_crc32``.

    ``pieces`` is read three times: hand in a checkpointed or stored frame.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most a few ranges for each of the <= capacity lengths: bounded whatever the input
    ranges = spark.createDataFrame(
        placement_ranges(plan_runs(counts, capacity)),
        "_size long, _first long, _last long, _base long, _each long, _offset long")

    cell = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(CELLS))
    numbered = pieces.withColumn("_cell", cell)
    cells = numbered.groupBy("length", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_cell")) - F.col("_n")
    starts = cells.select("length", "_cell", before.alias("_start"))
    order = Window.partitionBy("length", "_cell").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (numbered.join(starts, ["length", "_cell"])
              .withColumn("_rank", F.col("_start") + F.row_number().over(order) - 1))
    placed = ranked.join(F.broadcast(ranges), (F.col("length") == F.col("_size"))
                         & F.col("_rank").between(F.col("_first"), F.col("_last")))
    nth = F.col("_rank") - F.col("_first")
    return placed.select(
        *pieces.columns,
        (F.col("_base") + F.floor(nth / F.col("_each")).cast("long")).alias("sequence_id"),
        (F.col("_offset") + F.pmod(nth, F.col("_each")) * F.col("length")).alias("offset"))


def best_fit_pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of all documents with the sequence and the place they are packed into."""
    return pack_pieces(written(tokenize_pieces(docs, vocabulary, capacity, end_id)), capacity)


def sequences(docs: DataFrame, packed: DataFrame, vocabulary: str, capacity: int = 1024,
              end_id: int = 2) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids, doc_ids`` (at most ``capacity`` ids each)."""
    ids = tokenize_pieces(docs, vocabulary, capacity, end_id, with_ids=True).dropDuplicates(
        ["doc_id", "piece", "ids_crc32"])
    place = packed.select("doc_id", "piece", "ids_crc32", "sequence_id", "offset")
    same = place["doc_id"].eqNullSafe(ids["doc_id"]) & (place["piece"] == ids["piece"]) & (
        place["ids_crc32"] == ids["ids_crc32"])
    rows = place.join(ids, same).select(place["sequence_id"], place["offset"], place["doc_id"], ids["ids"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return rows.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))
