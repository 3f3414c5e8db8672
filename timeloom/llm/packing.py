"""Best-fit packing of token sequences by bin-completion branch and bound.

The bins only depend on how many pieces there are of each length, so the
search runs on a histogram of at most ``limit`` counts whatever the input
size. Its answer, a list of fillings with multiplicities, is spread back over
the pieces by their rank among pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.llm.bytebpe import byte_bpe
from timeloom.llm.runtime import cut, map_arrow, slices, text_of

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_points(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all but the first are full."""
    first = (n - 1) % limit + 1
    return [(0, first), *((first + i * limit, limit) for i in range((n - first) // limit))]


def token_pieces(documents: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """The pieces of every document: its ids, then ``end_id``, cut where longer than ``limit``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for part in slices(texts):
                for key, ids in zip(keys[part], coder.encode(texts[part]), strict=True):
                    raw = memoryview(np.append(ids, np.uint32(end_id)).astype("<u4").tobytes())
                    out += [(key, i, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)])) for i, (s, n) in enumerate(cut_points(len(ids) + 1, limit))]
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(text_of(documents), work, PIECES)


def best_fit(counts: dict[int, int], limit: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over whole groups of equal pieces: the search's first incumbent."""
    rooms: dict[int, list[tuple[Filling, int]]] = {limit: []}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, bins in rooms.items() if r >= length and bins), default=limit)
            each = room // length
            filling, bins = rooms[room].pop() if rooms[room] else ((), -(-left // each))
            full, rest = divmod(min(left, bins * each), each)
            left -= full * each + rest
            for used, many in ((each, full), (rest, 1)):
                if used and many:
                    rooms.setdefault(room - used * length, []).append(((*filling, (length, used)), many))
            if spare := bins - full - bool(rest):
                if filling:
                    rooms[room].append((filling, spare))
    return [x for bins in rooms.values() for x in bins if x[0]]


def completions(counts: np.ndarray, room: int, waste: int) -> Iterator[Filling]:
    """Undominated fillings of ``room`` in order of waste, up to ``waste``; few and long pieces first.

    A filling is dominated by one that holds a longer piece in place of some
    of its pieces, so a single piece that fits exactly stands alone.
    """
    if room <= 0 or not counts[1 : room + 1].any():
        if room <= waste:
            yield ()
        return
    if counts[room]:
        yield ((room, 1),)
        return
    halves = np.flatnonzero(counts[:room])
    halves = halves[(2 * halves >= room) & (counts[room - halves] > (2 * halves == room))][::-1]
    for a in halves[:8].tolist():
        yield ((a, 1), (room - a, 1)) if 2 * a > room else ((a, 2),)
    lengths = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    reach = [1]  # bit t of reach[-1 - i]: the lengths from i on can sum to t
    mask = (1 << (room + 1)) - 1
    for n in reversed(lengths):
        sums = now = reach[-1]
        for _ in range(min(int(counts[n]), room // n)):
            now = (now << n) & mask
            sums |= now
        reach.append(sums)
    reach.reverse()

    def fill(i: int, target: int) -> Iterator[Filling]:
        if not target:
            yield ()
            return
        for j in range(i, len(lengths)):
            if not reach[j] >> target & 1:
                return
            n = lengths[j]
            for k in range(min(int(counts[n]), target // n), 0, -1):
                if reach[j + 1] >> (target - k * n) & 1:
                    for rest in fill(j + 1, target - k * n):
                        yield ((n, k), *rest)

    given = 0
    for target in range(room, max(-1, room - waste - 1), -1):
        if reach[0] >> target & 1:
            for filling in fill(0, target):
                smallest_room = room - target
                if smallest_room and counts[1 : smallest_room + 1].any() and any(counts[m] > dict(filling).get(m, 0) for m in range(1, smallest_room + 1)):
                    continue  # dominated: another piece still fits
                yield filling
                given += 1
                if given % 4 == 0:
                    break


def plan_bins(counts: dict[int, int], limit: int = 2048, nodes: int = 3_000) -> list[tuple[Filling, int]]:
    """Fillings with multiplicities that hold every piece, in as few bins as the search finds.

    Branches on the fillings around the longest piece left, applies each as
    often as the pieces allow, and leaves a branch whose waste shows that it
    can't beat the incumbent. ``nodes`` bounds the search, not the pieces: the
    incumbent is always a whole packing.
    """
    counts = {n: c for n, c in counts.items() if c}
    if not counts:
        return []
    incumbent = best_fit(counts, limit)
    total, bins = sum(n * c for n, c in counts.items()), sum(c for _, c in incumbent)
    bound = -(-total // limit)
    left = np.zeros(limit + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    chosen: list[tuple[Filling, int]] = []
    spent = [0]
    stack: list[Iterator[Filling]] = []
    longest: list[int] = []
    budget = nodes

    def descend() -> None:
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1
        found = completions(left.copy(), limit - top, (bins - 1) * limit - total - spent[-1])
        left[top] += 1
        longest.append(top)
        stack.append(found)

    if bins > bound:
        descend()
    while stack and bins > bound and budget:
        if len(chosen) == len(stack):  # back from a deeper level
            filling, times = chosen.pop()
            for n, k in filling:
                left[n] += k * times
            spent.pop()
        filling = next(stack[-1], None)
        if filling is None:
            stack.pop()
            longest.pop()
            continue
        budget -= 1
        merged: dict[int, int] = {longest[-1]: 1}
        for n, k in filling:
            merged[n] = merged.get(n, 0) + k
        each = tuple(sorted(merged.items(), reverse=True))
        waste = limit - sum(n * k for n, k in each)
        times = min(int(left[n]) // k for n, k in each)
        slack = (bins - 1) * limit - total - spent[-1]
        if waste > slack:
            continue
        if waste:
            times = min(times, slack // waste)
        for n, k in each:
            left[n] -= k * times
        chosen.append((each, times))
        spent.append(spent[-1] + waste * times)
        if left.any():
            descend()
        else:
            incumbent, bins = list(chosen), sum(c for _, c in chosen)
    return incumbent


class Slots:
    """Where the pieces of each length go: rank among equals to sequence and offset."""

    def __init__(self, fillings: list[tuple[Filling, int]]) -> None:
        rows, taken, sequence = [], {}, 0
        for filling, times in fillings:
            offset = 0
            for n, k in filling:
                rows.append((n, taken.get(n, 0), sequence, k, offset))
                taken[n] = taken.get(n, 0) + k * times
                offset += n * k
            sequence += times
        rows.sort()
        self.length, self.rank, self.sequence, self.each, self.offset = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 5
        self.key = (self.length << 44) | self.rank

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.searchsorted(self.key, (length << 44) | rank, side="right") - 1
        nth = rank - self.rank[i]
        return self.sequence[i] + nth // self.each[i], self.offset[i] + nth % self.each[i] * length


def rank_among_equals(pieces: DataFrame, salts: int) -> DataFrame:
    """Adds ``rank``, from 0 within each length, without bringing one length into one task."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = sizes.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    return salted.withColumn("within", within - 1).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("within"))


def pack(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have a ``length`` from 1 to ``limit``.

    An empty table gives an empty result. ``pieces`` is read twice, so it
    should be a written table.
    """
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``limit`` rows
    slots = Slots(plan_bins(counts, limit))
    salts = max(16, sum(counts.values()) // 100_000)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(zero_copy_only=False), batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = slots.place(length, rank)
            kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = rank_among_equals(pieces, salts).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(work, PIECES + ", sequence_id bigint, offset bigint")


def pack_documents(documents: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """Packs all documents; null and empty texts are one piece that holds ``end_id`` alone."""
    return pack(cut(token_pieces(documents, tokenizer, limit, end_id)), limit)
