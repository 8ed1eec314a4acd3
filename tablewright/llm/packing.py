"""Best-fit packing of token sequences by bin completion."""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import write_once

from .frames import col, whole
from .tokens import segments

#: The pattern that byte-level vocabularies with this pre-tokeniser were made with, written with
#: possessive quantifiers: the same matches in less time.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def byte_of_char() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary file stands for.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, for the
    characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[tiktoken.Encoding, dict[str, int]]:
    """(encoder, special tokens by text) of a byte-level BPE file of the tokenizers library.

    Ids of such a file rise with the order of the merges, so they serve as ranks, and the
    encoder gives the ids of that library several times faster.
    """
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    chars = byte_of_char()
    ranks = {bytes(map(chars.__getitem__, t)): i for t, i in held["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("local", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special), special


def token_ids(text: str, path: str, long_text: int = 65_536) -> np.ndarray:
    """The ids of the whole text; the texts of special tokens become their ids, as in the file's
    own library."""
    coder, special = vocabulary(path)
    if any(s in text for s in special):
        ids = coder.encode(text, allowed_special="all")
    elif len(text) > long_text:
        ids = [i for piece in segments(text, long_text) for i in coder.encode_ordinary(piece)]
    else:
        ids = coder.encode_ordinary(text)
    return np.fromiter(ids, "<u4", len(ids))


def pieces_of(text: Column, path: str, *, capacity: int, separator: int) -> Column:
    """array<struct(piece, start, length, crc)> of each text's ids followed by ``separator``.

    Only longer ones are cut: the first piece takes what is over, all others are full.
    """

    @F.arrow_udf("array<struct<piece:int,start:long,length:long,crc:long>>")
    def cut(texts: pa.Array) -> pa.Array:
        ends, starts, numbers, lengths, crcs = [0], [], [], [], []
        for t in texts:
            ids = np.append(token_ids(t.as_py() or "", path), np.uint32(separator)).astype("<u4")
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            for number, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
                numbers.append(number)
                starts.append(start)
                lengths.append(end - start)
                crcs.append(zlib.crc32(ids[start:end].tobytes()))
            ends.append(len(numbers))
        fields = [
            pa.array(numbers, pa.int32()),
            pa.array(starts, pa.int64()),
            pa.array(lengths, pa.int64()),
            pa.array(crcs, pa.int64()),
        ]
        rows = pa.StructArray.from_arrays(fields, ["piece", "start", "length", "crc"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return cut(text)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Best-fit decreasing: each size goes where it leaves the least room."""
    room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    open_at = np.zeros(capacity + 1, bool)
    done = []
    for size in np.flatnonzero(counts)[::-1]:
        for _ in range(counts[size]):
            at = size + int(open_at[size:].argmax())
            filled = room[at].pop() if open_at[at] else []
            left = at - size if filled else capacity - size
            open_at[at] = bool(room[at])
            filled.append(int(size))
            if left:
                room[left].append(filled)
                open_at[left] = True
            else:
                done.append(tuple(filled))
    return done + [tuple(f) for at in room for f in at]


class Fillings:
    """The undominated ways to fill ``room`` from the sizes left, least waste first, one by one.

    All sets of sizes are enumerated that fill ``room`` but for some waste of at most ``limit``,
    by waste and then by number of sizes, so that a single size that fits exactly comes first
    and dominates all else. Left out are sets to which a size left over could be added, and sets
    whose sizes fit in the places of one of the first ``compared`` before (sets of more than
    ``compared_sizes`` are not compared); a dominated set more costs time, never a solution. Sizes are bits of one number, so the
    pairs that add up to a sum are one "and" of it with its mirror image. ``steps`` bounds the
    sizes and sums tried for one bin, ``budget`` (a list of one number) those of all bins; the
    greedy filling is always there, and comes last where a bound ends the enumeration.
    """

    compared, compared_sizes = 64, 6

    def __init__(
        self, counts: list[int], held: int, mirror: int, capacity: int, room: int, limit: int, steps: int, budget: list[int]
    ):
        self.counts, self.held, self.mirror, self.capacity = counts, held, mirror, capacity
        self.room, self.limit, self.steps, self.budget = room, min(limit, room), steps, budget

    def _spend(self) -> bool:
        self.steps -= 1
        self.budget[0] -= 1
        return self.steps >= 0 and self.budget[0] >= 0

    def _left(self, size: int, taken: tuple[int, ...]) -> bool:
        return self.counts[size] > taken.count(size)

    def _exact(self, total: int, most: int, many: int, taken: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        """Sets of ``many`` sizes of at most ``most`` that add up to ``total``, largest first."""
        if many == 1:
            if total <= most and self.held >> total & 1 and self._left(total, taken):
                yield (*taken, total)
            return
        most = min(most, total - 1)
        if many == 2:
            pairs = self.held & (self.mirror >> (self.capacity - total)) & ((2 << most) - 1)
            pairs = pairs >> -(-total // 2) << -(-total // 2)
            while pairs:
                one = pairs.bit_length() - 1
                pairs ^= 1 << one
                if not self._spend():
                    return
                if self._left(one, taken) and self._left(total - one, (*taken, one)):
                    yield (*taken, one, total - one)
            return
        least = -(-total // many)
        sizes = (self.held & ((2 << most) - 1)) >> least << least
        while sizes:
            one = sizes.bit_length() - 1
            sizes ^= 1 << one
            if not self._spend():
                return
            if self._left(one, taken):
                yield from self._exact(total - one, one, many - 1, (*taken, one))

    def _greedy(self) -> tuple[int, ...]:
        taken: tuple[int, ...] = ()
        room = most = self.room
        while sizes := self.held & ((2 << min(room, most)) - 1):
            size = sizes.bit_length() - 1
            if self._left(size, taken):
                taken, room = (*taken, size), room - size
                most = size
            else:
                most = size - 1
        return taken

    def __iter__(self) -> Iterator[tuple[int, tuple[int, ...]]]:
        smallest = (self.held & -self.held).bit_length() - 1
        if smallest < 0 or smallest > self.room:
            yield self.room, ()
            return
        found: list[tuple[int, ...]] = []
        for waste in range(min(self.limit, self.room - smallest) + 1):
            total = self.room - waste
            largest = (self.held & ((2 << total) - 1)).bit_length() - 1
            for many in range(-(-total // largest), total // smallest + 1):
                if not self._spend():
                    greedy = self._greedy()
                    if self.room - sum(greedy) <= self.limit:
                        yield self.room - sum(greedy), greedy
                    return
                before = found[: self.compared]  # sets of equal sum and number never dominate each other
                for sizes in self._exact(total, total, many, ()):
                    room_for = self.held & ((2 << waste) - 1)
                    if waste and any(room_for >> s & 1 and self._left(s, sizes) for s in range(smallest, waste + 1)):
                        continue
                    if many > self.compared_sizes or not any(dominates(other, sizes) for other in before):
                        if len(found) < self.compared:
                            found.append(sizes)
                        yield waste, sizes
                        if many == 1 and not waste:
                            return


def dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """True if the sizes of ``other`` fit in the places of ``one``, a place holding any number."""

    def fit(rest: tuple[int, ...], places: tuple[int, ...]) -> bool:
        if not rest:
            return True
        tried = set()
        for at, place in enumerate(places):
            if place >= rest[0] and place not in tried:
                tried.add(place)
                if fit(rest[1:], (*places[:at], place - rest[0], *places[at + 1 :])):
                    return True
        return False

    if sum(other) > sum(one) or max(other) > max(one):
        return False
    return fit(tuple(sorted(other, reverse=True)), tuple(one))


def complete_bins(
    lengths: np.ndarray, capacity: int, *, effort: int = 200, least: int = 1_000_000, steps: int = 20_000
) -> list[tuple[int, ...]]:
    """Sizes of each bin, in as few bins as the search finds.

    Branch and bound over whole bins: the largest size left opens a bin, which is filled in each
    of its undominated ways, least waste first. A branch ends when its waste is more than a
    solution with one bin less than the incumbent's could have. Best fit decreasing gives the
    first incumbent. The search stops when the incumbent meets the bound of the total, when
    nothing is left to try, or after ``effort`` steps (sizes, sums or bins tried) for each bin of
    the first incumbent, and ``least`` at any rate; ``steps`` bounds the enumeration for one bin.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).tolist()
    total = int(lengths.sum())
    incumbent = best_fit(np.array(counts), capacity)
    slack = (len(incumbent) - 1) * capacity - total  # what a better solution may waste
    budget = [max(least, effort * len(incumbent))]
    held = sum(1 << s for s, n in enumerate(counts) if n)
    mirror = sum(1 << (capacity - s) for s, n in enumerate(counts) if n)

    def take(sizes: tuple[int, ...], times: int) -> None:
        nonlocal held, mirror
        for size in sizes:
            before = counts[size]
            counts[size] -= times
            if not before or not counts[size]:
                held ^= 1 << size
                mirror ^= 1 << (capacity - size)

    def ways(waste: int) -> Iterator[tuple[int, tuple[int, ...]]]:
        size = held.bit_length() - 1
        take((size,), 1)
        state = Fillings(counts, held, mirror, capacity, capacity - size, slack - waste, steps, budget)
        take((size,), -1)
        # ``counts`` holds one more of ``size`` whenever the rest is asked for: it is the same
        # then as now, and the bin's own piece is taken off for the time of each question.
        rest = iter(state)

        def each() -> Iterator[tuple[int, tuple[int, ...]]]:
            while True:
                counts[size] -= 1
                found = next(rest, None)
                counts[size] += 1
                if found is None:
                    return
                yield found[0], (size, *found[1])

        return each()

    bins: list[tuple[int, ...]] = []
    spent: list[int] = [0]
    stack = [ways(0)] if len(lengths) and slack >= 0 else []
    while stack and slack >= 0 and budget[0] > 0:
        found = next(stack[-1], None)
        if found is None:  # nothing more to try here: undo the bin that led here
            stack.pop()
            if bins:
                take(bins.pop(), -1)
                spent.pop()
            continue
        waste, sizes = found
        budget[0] -= 1
        if spent[-1] + waste > slack:
            continue
        take(sizes, 1)
        bins.append(sizes)
        spent.append(spent[-1] + waste)
        if held:
            stack.append(ways(spent[-1]))
        else:
            incumbent = list(bins)
            slack = (len(incumbent) - 1) * capacity - total
            stack.append(iter(()))
    return incumbent


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item."""
    bins = complete_bins(lengths, capacity)
    order = np.argsort(lengths, kind="stable")
    ends = np.cumsum(np.bincount(lengths, minlength=capacity + 1))
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for number, sizes in enumerate(bins):
        at = 0
        for size in sizes:
            ends[size] -= 1
            item = order[ends[size]]
            where[item], offset[item] = number, at
            at += size
    return where, offset


def pack(
    docs: DataFrame,
    path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    separator: int = 0,
    block: int = 32_768,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: ``doc``, ``piece``, ``start``, ``length``, ``crc``,
    ``sequence_id`` and ``offset``. Only documents longer than a sequence are cut.

    Texts are read and encoded once; what is kept of a piece are five numbers. The pieces are
    dealt out evenly into blocks of about ``block``, whatever their ids, and each block is
    packed on its own, so a task holds one block; the price is at most about one sequence in
    each block.

    * A null or empty text is its separator alone. Repeated rows and ids are packed as they are.
    * An empty table gives an empty result. Other columns of the input are not read.
    """
    numbered = write_once(
        docs.select(
            col(doc_id).alias("doc"),
            F.explode(pieces_of(whole(text), path, capacity=capacity, separator=separator)).alias("p"),
        ).select("doc", "p.*"),
        "pieces",
    )
    blocks = max(1, round(numbered.count() / block))
    schema = T.StructType([*numbered.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def packed_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held)
            where, offset = place(rows["length"].to_numpy(), capacity)
            number = TaskContext.get().partitionId()  # type: ignore[union-attr]
            rows = rows.append_column("sequence_id", pa.array(where + (number << 32)))
            yield from rows.append_column("offset", pa.array(offset)).combine_chunks().to_batches()

    return numbered.repartition(blocks).mapInArrow(packed_block, schema)
