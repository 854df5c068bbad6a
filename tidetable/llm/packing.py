"""Filling fixed-capacity containers with items by swap-based local search."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items packed together. A bound of memory and time: every chunk is packed, and each leaves at most about one container underfull.
CHUNK = 10_000


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Starting bins of item indexes: each item, largest first, into the fullest bin that holds it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(rooms, sizes[i])
        if at == len(rooms):
            b, room = len(bins), capacity
            bins.append([])
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        bins[b].append(i)
        room -= sizes[i]
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append(b)
    return bins


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Passes of :func:`_raise_fills` until one raises the sum of squared fills no more: a local optimum of its exchanges.

    The sum is a whole number that rises with every pass and is bounded by the sizes, so the search ends.
    """
    def squared(bins: list[list[int]]) -> int:
        return sum(sum(sizes[i] for i in b) ** 2 for b in bins)

    now = squared(bins)
    while True:
        bins = _raise_fills(bins, sizes, capacity)
        after = squared(bins)
        if after <= now:
            return bins
        now = after


def _raise_fills(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """One pass of exchanges between underfull bins, each of which raises the sum of squared fills; emptied bins vanish.

    Bins are taken from the fullest underfull one down. For its room the item closest to filling it is moved in from an
    emptier bin; else one of its items is exchanged for a larger one, or two of its items for one larger, or one for two of
    the emptiest bin, always the exchange that fills most. Each step raises a fuller bin at the cost of an emptier one.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    home = {i: b for b, items in enumerate(bins) for i in items}
    under = sorted((b for b in range(len(bins)) if fill[b] < capacity), key=lambda b: (-fill[b], b))
    index = sorted((sizes[i], i) for b in under for i in bins[b] if sizes[i])
    held = [set(b) for b in bins]

    def donor(low: int, high: int, b: int) -> int | None:
        """The largest item of another bin sized within (low, high]."""
        at = bisect_right(index, (high, 1 << 60)) - 1
        while at >= 0 and index[at][0] > low:
            if home[index[at][1]] != b:
                return index[at][1]
            at -= 1
        return None

    def give(i: int, b: int) -> None:
        a = home[i]
        held[a].discard(i)
        held[b].add(i)
        fill[a] -= sizes[i]
        fill[b] += sizes[i]
        home[i] = b

    for place, b in enumerate(under):
        while fill[b] < capacity and held[b]:
            room = capacity - fill[b]
            best: tuple[int, list[int], list[int]] = (0, [], [])
            if (y := donor(0, room, b)) is not None:
                best = (sizes[y], [], [y])
            one = {sizes[i]: i for i in held[b]}
            for s, i in one.items():
                if best[0] < room and (y := donor(s + best[0], s + room, b)) is not None:
                    best = (sizes[y] - s, [i], [y])
            if best[0] < room and len(held[b]) > 1:
                several = sorted(held[b], key=lambda i: sizes[i])
                seen: set[int] = set()
                for p, i in enumerate(several):
                    for j in several[p + 1:]:
                        s = sizes[i] + sizes[j]
                        if s + best[0] >= index[-1][0] if index else True:
                            break
                        if s in seen or best[0] == room:
                            continue
                        seen.add(s)
                        if (y := donor(s + best[0], s + room, b)) is not None:
                            best = (sizes[y] - s, [i, j], [y])
            if best[0] < room:
                last = next((c for c in reversed(under[place + 1:]) if held[c]), None) if place + 1 < len(under) else None
                if last is not None and fill[last] <= fill[b]:
                    few = sorted(held[last], key=lambda i: sizes[i])
                    for s, i in one.items():
                        lo, hi = 0, len(few) - 1
                        while lo < hi:
                            gain = sizes[few[lo]] + sizes[few[hi]] - s
                            if gain > room:
                                hi -= 1
                            else:
                                if gain > best[0]:
                                    best = (gain, [i], [few[lo], few[hi]])
                                lo += 1
            if not best[0]:
                break
            to = home[best[2][0]]
            for i in best[1]:
                give(i, to)
            for i in best[2]:
                give(i, b)
        for i in held[b]:  # what is filled as far as it goes gives nothing more away
            if sizes[i] and (at := bisect_left(index, (sizes[i], i))) < len(index) and index[at] == (sizes[i], i):
                index.pop(at)
    return [sorted(h) for h in held if h]


def pack(sizes: list[int], capacity: int, search: bool = True) -> list[list[int]]:
    """Bins of item indexes; every item once, no bin over ``capacity``. Sizes lie within 0..capacity. Without ``search`` the start alone."""
    start = best_fit(sizes, capacity)
    return local_search(start, sizes, capacity) if search else start


def chunk_count(items: DataFrame, chunk: int = CHUNK) -> Column:
    """How many chunks of about ``chunk`` rows ``items`` make, by a scalar subquery."""
    return items.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / chunk)).cast("bigint").alias("n")).scalar()


def pack_documents(items: DataFrame, key: str, size: str, capacity: int, chunks: Column, search: bool = True) -> DataFrame:
    """``container_id``, ``key``, ``part`` and ``n_tokens``: every item in one container, an item above ``capacity`` in parts.

    Only items above the capacity are split: into full containers and one remainder that is packed like an item. Items of
    size 0 or null size take no room and lie in some container as part 0 with size 0. Repeated and null keys are items of
    their own. Items fall into ``chunks`` (:func:`chunk_count`) by a hash of key, size and number of the copy, so that equal rows are spread too,
    and each chunk is packed in the order of size, key and copy: the containers depend on the items alone, not on how the input
    is split or on which task runs again. What is shuffled is key, size and count, not the texts.
    """
    counted = items.select(F.col(key).alias("k"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("s")).groupBy("k", "s").agg(F.count(F.lit(1)).alias("n"))
    copies = counted.select("k", "s", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("c"))
    placed = copies.select(F.pmod(F.xxhash64("k", "s", "c"), chunks).alias("chunk"), "k", "s", "c")
    placed = placed.repartition("chunk").sortWithinPartitions("chunk", F.col("s").desc(), "k", "c").select("chunk", "k", "s")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        held: tuple[int, list, list[int]] | None = None

        def packed(chunk: int, keys: list, sizes: list[int]) -> pa.RecordBatch:
            next_id = chunk << 36
            ids, rows, parts, n = [], [], [], []
            rest, part = [], []
            for k, s in zip(keys, sizes, strict=True):
                full = (s - 1) // capacity if s else 0
                for p in range(full):
                    ids.append(next_id)
                    rows.append(k)
                    parts.append(p)
                    n.append(capacity)
                    next_id += 1
                rest.append(s - full * capacity)
                part.append(full)
            for b in pack(rest, capacity, search):
                for i in b:
                    ids.append(next_id)
                    rows.append(keys[i])
                    parts.append(part[i])
                    n.append(rest[i])
                next_id += 1
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, kind), pa.array(parts, pa.int32()), pa.array(n, pa.int64())], ["container_id", key, "part", "n_tokens"])

        for batch in batches:
            kind = batch.schema.field(1).type
            for chunk, k, s in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held is None or held[0] != chunk:
                    if held is not None:
                        yield packed(*held)
                    held = (chunk, [], [])
                held[1].append(k)
                held[2].append(s)
        if held is not None:
            yield packed(*held)

    kind = items.schema[key].dataType.simpleString()
    return placed.mapInArrow(run, f"container_id bigint, `{key}` {kind}, part int, n_tokens bigint")
