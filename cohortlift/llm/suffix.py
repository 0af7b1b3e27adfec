"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

Every byte that lies in a string of ``length`` bytes which also starts anywhere
else (same or other document, overlaps included) is removed; strings are
judged on the input.

Which suffixes are sorted. A window of ``length`` bytes is named by an anchor,
the ``gram``-byte string within it whose hash is smallest, so that equal windows
have equal anchors at equal places. Anchors whose gram occurs once in the
corpus are dropped: their windows cannot repeat. Anchors of
equal gram whose contexts are equal as far as a window reaches, on both sides,
form a class: they share all they can share with each other by one suffix each,
the longest. Of a gram with several classes, one anchor of each class (its
head) also stands for it among the others. Two anchors that agree on l bytes to
the left and r to the right share l + r; if that makes ``length``, all of it is
removed, and as every such interval holds the anchor, an anchor's intervals
join: the one that reaches farthest left and one that reaches farthest right
are all it needs, each as a suffix of its own and of its partner. Left lengths
come from sorting the heads' reversed left contexts, right ones are bounded by
hashes at a ladder of lengths; where bounds do not tell whether a pair reaches
``length``, or which reaches farthest, all that may are sorted (``chosen``).

How they are sorted. Tasks sort their suffixes into runs and front-code them
(length of the prefix shared with the one before, and the rest); runs are cut
at common splitters and exchanged; each range's runs are merged by a loser tree
that carries for every contender the length of the prefix it shares with the
last winner, so that known prefixes are never compared again. The common
prefixes of neighbours in the merged order fall out of the merge, and a suffix
whose longest reaches ``length`` gives the interval that is removed.

Scale: what is shuffled are grams' hashes, candidates' positions and
front-coded, compressed runs. Equal suffixes of a run are one entry with its
places, so a passage of very many documents is one entry per run. Counting is a
partial aggregation; the sort of left contexts cuts groups anywhere (at a cut,
all l up to the common prefix with the cut are taken, a superset that does no
harm). Texts are shuffled only for documents with candidates; their ids are
broadcast while they are under ``max_broadcast`` (checked), else the join
shuffles. Splitters come from a bounded sample and only affect balance.

Cases: null text is empty; texts shorter than ``length`` lose nothing; a null
doc_id is reported as such; repeated rows are copies of each other; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, polynomial, runs, small, text_of, written

SLICE_BYTES = 512 << 10
RUN_BYTES = 32 << 20
SPLITTER = 24
NO_ID = -(1 << 63)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum over windows [i, i + width)."""
    out, have = values, 1
    while have * 2 <= width:
        out, have = pick(out[:-have], out[have:]), have * 2
    return pick(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


def _slices(texts: list[bytes]):
    """(first, last, data, begins, ends) of consecutive texts of about SLICE_BYTES."""
    at = 0
    while at < len(texts):
        n, size = 0, 0
        while at + n < len(texts) and size < SLICE_BYTES:
            size += len(texts[at + n])
            n += 1
        ends = np.cumsum([len(t) for t in texts[at : at + n]])
        yield at, at + n, np.frombuffer(b"".join(texts[at : at + n]), np.uint8), np.r_[0, ends[:-1]], ends
        at += n


def anchors_of(texts: list[bytes], length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per text: positions of its anchors, their grams' hashes, their contexts' hashes
    (all that a repeat through the anchor can reach: left to the window's reach, right to ``length``)."""
    out = []
    width = length - gram + 1
    top = np.uint64(np.iinfo(np.uint64).max)
    for first, last, data, begins, ends in _slices(texts):
        if len(data) < length:
            out += [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))] * (last - first)
            continue
        poly = polynomial(len(data))
        prefix = poly.prefix(data)
        start = np.arange(len(data) - gram + 1)
        h = poly.ranges(prefix, start, start + gram)
        h[h == top] -= np.uint64(1)
        low = _sliding(h, width, np.minimum)  # of the window starting there
        # windows that cross a text's end choose nothing
        for end in ends[:-1]:
            low[max(0, end - length + 1) : end] = 0
        high = _sliding(np.r_[np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)], width, np.maximum)
        chosen = np.flatnonzero((high == h) & (h > 0))
        owner = np.searchsorted(ends, chosen, "right")
        left = np.maximum(begins[owner], chosen - (width - 1))
        right = np.minimum(ends[owner], chosen + length)
        # left and right of the anchor apart, so that equal contexts have the anchor at the same place
        grams, context = h[chosen], poly.ranges(prefix, left, chosen) * np.uint64(0x9E3779B97F4A7C15) ^ poly.ranges(prefix, chosen, right)
        cut = np.searchsorted(owner, np.arange(last - first + 1))
        for k in range(last - first):
            own = slice(cut[k], cut[k + 1])
            out.append((chosen[own] - begins[k], grams[own], context[own]))
    return out


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no comparison."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while a[known : known + 16] == b[known : known + 16]:
        known += 16
    while a[known] == b[known]:
        known += 1
    return known


def front_coded(strings: list[bytes], places: list[list[tuple[int, int, int]]]) -> bytes:
    """A sorted run: shared prefix lengths, rests, and each string's places, compressed."""
    shared = [0] + [common(a, b, 0) for a, b in zip(strings, strings[1:], strict=False)]
    rests = [s[n:] for s, n in zip(strings, shared, strict=True)]
    flat = np.array([x for p in places for x in p], np.int64).reshape(-1, 3)
    head = struct.pack("<II", len(strings), len(flat))
    numbers = np.array([shared, [len(r) for r in rests], [len(p) for p in places]], "<u4").tobytes()
    return zlib.compress(head + numbers + flat.T.tobytes() + b"".join(rests), 1)


def decoded(block: bytes):
    """(shared prefix lengths, rests, places per string) of a front-coded run."""
    raw = zlib.decompress(block)
    n, m = struct.unpack_from("<II", raw)
    shared, sizes, counts = np.frombuffer(raw, "<u4", 3 * n, 8).reshape(3, n)
    flat = np.frombuffer(raw, np.int64, 3 * m, 8 + 12 * n).reshape(3, m)
    at = 8 + 12 * n + 24 * m
    ends = np.cumsum(sizes, dtype=np.int64) + at
    rests = [raw[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    return shared.tolist(), rests, np.split(flat, np.cumsum(counts)[:-1], axis=1)


def merge(streams: list[tuple[list[int], list[bytes]]]):
    """Merges front-coded runs with a loser tree.

    Yields (stream, index, prefix length shared with the string yielded
    before, string length). A contender carries its string and the length of the
    prefix it shares with the last winner of its node: of two contenders the one
    that shares more comes first, and only equal lengths need a comparison,
    from that length on. A stream's next string shares with the winner just
    taken from it what its front coding says.
    """
    k = max(1, len(streams))
    size = 1 << (k - 1).bit_length() if k > 1 else 1
    text: list[bytes | None] = [None] * size
    index, known = [0] * size, [0] * size
    for i, (_, rests) in enumerate(streams):
        text[i] = rests[0] if rests else None
    loser = [-1] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes that with the winner."""
        if text[a] is None:
            return b, a
        if text[b] is None:
            return a, b
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = text[a], text[b]
        n = common(x, y, known[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    winners = [*range(size)]
    level = size
    while level > 1:  # the first round, from the leaves up
        level //= 2
        ups = []
        for j in range(level):
            w, lost = play(winners[2 * j], winners[2 * j + 1])
            loser[level + j] = lost
            ups.append(w)
        winners = ups
    best = winners[0]
    while text[best] is not None:
        now = text[best]
        yield best, index[best], known[best], len(now)
        shared, rests = streams[best]
        index[best] += 1
        i = index[best]
        if i < len(rests):
            text[best] = now[: shared[i]] + rests[i]
            known[best] = shared[i]
        else:
            text[best] = None
        node = (best + size) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


def shared_lengths(left: list[bytes], right: list[int], lcp: list[int], cut: bool, back: bool) -> list[set[int]]:
    """For each of a gram's anchors, in the order of left contexts (or ``back``
    wards), the distinct lengths it shares with those before it, of which only
    the nearest of each right context counts, and none beyond the nearest with
    its own.

    That is enough: of three in order, the middle one shares at least as much to
    the left with either end as they share with each other; so where its right
    context is that of one of them, it can stand for that one. Lengths are
    running minima of neighbours' common prefixes, kept on a stack with the
    first position each holds for and how many of its positions count. At a
    ``cut`` anchors may lie beyond the first: any length up to that shared with
    it is taken.
    """
    n = len(left)
    order = range(n - 1, -1, -1) if back else range(n)
    values, starts, live = [], [], []
    if cut:
        m = len(left[order[0]]) + 1
        values, starts, live = list(range(m)), [-1] * m, [1] * m
    last: dict[int, int] = {}
    out = []
    for step, i in enumerate(order):
        if step:
            before = right[order[step - 1]]
            if (old := last.get(before)) is not None:
                live[bisect.bisect_right(starts, old) - 1] -= 1
            last[before] = step - 1
            c, start, count = lcp[i if back else i - 1], step - 1, 1
            while values and values[-1] >= c:
                values.pop()
                start = starts.pop()
                count += live.pop()
            values.append(c)
            starts.append(start)
            live.append(count)
        nearest = last.get(right[i], -2)
        own = set()
        for k in range(len(values) - 1, -1, -1):
            if live[k]:
                own.add(values[k])
            if starts[k] <= nearest:
                break
        out.append(own)
    return out


def contexts_of(texts: list[bytes], counts: np.ndarray, at: np.ndarray, reach: int, ladder: list[int]):
    """Per slice of texts: (first, last anchor, reversed left contexts, bytes to
    the text's end, at most the ladder's last, hashes to the right at the ladder's lengths);
    ``counts`` anchors per text, at ``at``. Hashes end with the text."""
    cuts = np.r_[0, np.cumsum(counts)]
    for first, last, data, begins, ends in _slices(texts):
        a, b = cuts[first], cuts[last]
        if a == b:
            continue
        owner = np.repeat(np.arange(last - first), counts[first:last])
        pos, end = begins[owner] + at[a:b], ends[owner]
        poly = polynomial(len(data))
        prefix = poly.prefix(data)
        rights = np.stack([poly.ranges(prefix, pos, np.minimum(pos + n, end)) for n in ladder], 1).view(np.int64)
        size = np.minimum(at[a:b], reach)
        offsets = np.r_[0, np.cumsum(size)]
        flat = data[np.repeat(pos - 1 + offsets[:-1], size) - np.arange(offsets[-1])]
        left = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat)])
        yield a, b, left, np.minimum(end - pos, ladder[-1]), rights


class _Minima:
    """Minima of ranges of an array."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > (have := 1 << (len(self.levels) - 1)):
            self.levels.append(np.minimum(self.levels[-1][:-have], self.levels[-1][have:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of values[a:b], for each pair a < b."""
        out = np.empty(len(a), self.levels[0].dtype)
        level = np.frexp(b - a)[1] - 1
        for j, values in enumerate(self.levels):
            m = np.flatnonzero(level == j)
            if len(m):
                out[m] = np.minimum(values[a[m]], values[b[m] - (1 << j)])
        return out


def neighbours_common(left: pa.BinaryArray, reach: int) -> np.ndarray:
    """Lengths of the common prefixes of consecutive strings of at most ``reach`` bytes."""
    offsets = np.frombuffer(left.buffers()[1], np.int32)[left.offset : left.offset + len(left) + 1]
    size = np.diff(offsets)
    filled = np.zeros((len(left), reach + 1), np.uint8)
    if offsets[-1] > offsets[0]:
        filled[np.arange(reach + 1) < size[:, None]] = np.frombuffer(left.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    differ = filled[1:] != filled[:-1]
    differ[:, reach] = True
    return np.minimum(differ.argmax(1), np.minimum(size[1:], size[:-1]))


def chosen(run: np.ndarray, lcp: np.ndarray, avail: np.ndarray, rights: np.ndarray, own: np.ndarray, levels: list[int]):
    """(anchors, lengths to the left) of the suffixes that are sorted.

    Anchors come by ``run`` (their gram) and reversed left context, with the
    neighbours' common left lengths, the bytes to the text's end and the hashes
    to the right at levels[1:]. levels[0] is the gram and shared by all of a
    run; levels[-1] is the length of a repeat. Only ``own`` ones need intervals,
    the others are partners.

    At a level an anchor's nearest neighbours with the same hash share most to
    the left: ``most``. With at least levels[-1] less the level, its ``floor``,
    they surely repeat. Of the levels where one does, the lowest gives the sure
    interval that reaches farthest left; in the highest, the anchors that share
    the floor are sorted from there on, one for each hash at the next level, and
    the merge finds which shares most to the right. Less than the floor may still
    do, if more than the next level's: such lengths are taken where they may
    reach farther than the sure ones.
    """
    n, last = len(run), len(levels) - 1
    floors = [levels[-1] - x for x in levels]
    minima = _Minima(np.where(run[1:] == run[:-1], lcp, -1))
    every = np.arange(n)
    most, with_, orders, links, names = [], [], [], [], []
    for k, level in enumerate(levels):
        # a hash that the text's end cuts names nothing
        name = np.zeros(n, np.int64) if k == 0 else rights[:, k - 1]
        valid = np.flatnonzero(avail >= level)
        order = valid[np.lexsort((name[valid], run[valid]))]
        a, b = order[:-1], order[1:]
        same = (run[a] == run[b]) & (name[a] == name[b])
        link = np.full(len(a), -1)
        link[same] = minima(a[same], b[same])
        up, down = np.full(n, -1), np.full(n, -1)
        up[b], down[a] = link, link
        before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
        before[b], after[a] = a, b
        most.append(np.maximum(up, down))
        with_.append(np.where(up >= down, before, after))
        orders.append(order)
        links.append(link)
        names.append(name)
    most, with_ = np.stack(most), np.stack(with_)
    sure = most >= np.array(floors)[:, None]
    some = sure.any(0)
    low, high = np.where(some, sure.argmax(0), last + 1), np.where(some, last - sure[::-1].argmax(0), -1)
    reach = np.where(some, most[np.minimum(low, last), every], -1)
    anchors, lengths = [], []

    def take(who, how):
        anchors.append(who)
        lengths.append(np.broadcast_to(how, who.shape))

    whole = most[last] == reach  # then its partner shares all to the right too
    i = np.flatnonzero(some & own)
    take(i, reach[i])
    take(with_[np.where(whole[i] & (high[i] == last), last, low[i]), i], reach[i])
    i = np.flatnonzero((high == last) & own & ~whole)
    take(i, 0)
    take(with_[last, i], 0)
    for k in range(last):
        order, link = orders[k], links[k]
        if not len(order):
            continue
        tight = np.r_[0, np.cumsum(link < floors[k])]
        wide = np.r_[0, np.cumsum(link <= floors[k + 1])]
        size, wider = np.bincount(tight)[tight], np.bincount(wide)[wide]
        lo, hi, need = low[order], high[order], own[order]
        # the next level's hash, or the anchor's own where the text ends before
        beyond = avail[order] < levels[k + 1]
        following = np.where(beyond, order, names[k + 1][order])
        wanted = np.zeros(tight[-1] + 1, bool)
        wanted[tight[need & (hi == k) & ~((lo == k) & (size == 2))]] = True
        member = np.flatnonzero(wanted[tight])
        by = member[np.lexsort((following[member], beyond[member], tight[member]))]
        new = np.ones(len(by), bool)
        new[1:] = (tight[by[1:]] != tight[by[:-1]]) | (following[by[1:]] != following[by[:-1]]) | (beyond[by[1:]] != beyond[by[:-1]])
        take(order[by[new]], floors[k])
        open_ = need & (wider > 1) & np.where(hi == k, wider > size, (most[k, order] > floors[k + 1]) & ((hi < k) | ((k < lo) & (most[k, order] > reach[order]))))
        for c in np.unique(wide[open_]).tolist():
            a, b = np.searchsorted(wide, [c, c + 1])
            own_names = list(zip(beyond[a:b].tolist(), following[a:b].tolist(), strict=True))
            shared = link[a : b - 1].tolist()
            there = shared_lengths([b""] * (b - a), own_names, shared, False, False)
            back = shared_lengths([b""] * (b - a), own_names, shared, False, True)
            found = [(order[a + j], x) for j in range(b - a) for x in there[j] | back[b - a - 1 - j] if floors[k + 1] < x < floors[k]]
            if found:
                who, how = np.array(found).T
                take(who, how)
    code = np.unique(np.concatenate(anchors) * (levels[-1] + 1) + np.concatenate(lengths))
    return code // (levels[-1] + 1), code % (levels[-1] + 1)


def _per_doc(df: DataFrame, value) -> DataFrame:
    return df.groupBy("id", "th").agg(F.collect_list(value).alias("values"))


def _with_texts(rows: DataFrame, values: DataFrame, max_broadcast: int) -> DataFrame:
    """(id, th, text, values) for the documents in ``values`` (written)."""
    ids = values.select("id", "th").distinct()
    if values.count() <= max_broadcast:
        rows = rows.join(F.broadcast(ids), ["id", "th"], "left_semi")
    return rows.join(values, ["id", "th"])


def removed_spans(docs: DataFrame, length: int = 200, gram: int = 64, entries: int = 40_000, max_broadcast: int = 1_000_000) -> DataFrame:
    """(id, th, values): per document with repeats, intervals [start, end] of
    UTF-8 bytes, overlapping and in any order; th is the text's hash."""
    spark = docs.sparkSession
    width = length - gram + 1
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text_of()).alias("th"), text_of().cast("binary").alias("text")
    )

    def anchors(batches):
        for b in small(batches, 2048):
            found = anchors_of(b.column(2).to_pylist(), length, gram)
            offsets = pa.array(np.r_[0, np.cumsum([len(p) for p, _, _ in found])], pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f[k] for f in found]).astype(np.uint64 if k else np.int64).view(np.int64)))
                for k in range(3)
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists], names=["id", "th", "at", "gram", "context"])

    schema = "id long, th long, at array<long>, gram array<long>, context array<long>"
    found = written(rows.filter(F.octet_length("text") >= length).mapInArrow(anchors, schema), "anchors")
    each = found.select("id", "th", F.inline(F.arrays_zip(F.col("at").cast("array<int>").alias("at"), "gram", "context")))
    # anchors of equal gram and context share all they can: one stands for its class among the gram's other classes
    each = each.withColumn("place", F.xxhash64("id", "th", "at"))
    classes = each.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min("place").alias("head"))
    grams = classes.groupBy("gram").agg(F.sum("n").alias("all"), F.count("*").alias("classes")).filter("all > 1")
    # written, so that its shuffles' files are gone when the anchors are shuffled
    classes = written(classes.join(grams.select("gram", (F.col("classes") > 1).alias("mixed")), "gram"), "classes")
    candidates = each.join(classes, ["gram", "context"])
    heads = F.col("mixed") & (F.col("place") == F.col("head"))
    candidates = candidates.select("id", "th", "at", "gram", heads.alias("mixed"), (~F.col("mixed") | (F.col("n") > 1)).alias("plain"))
    candidates = written(_per_doc(candidates, F.struct("at", "gram", "mixed", "plain")), "candidates")
    discard(found)
    discard(classes)

    # right contexts are hashed at several lengths, the last one whole
    levels = sorted({gram + (length - gram) * k // 7 for k in range(8)})
    ladder = levels[1:] or levels

    # reversed left contexts of the grams that have several
    def contexts(batches):
        names = ["gram", "left", "id", "th", "at", "avail", "own", "rights"]
        for b in small(batches):
            counts = b.column(3).value_lengths().to_numpy()
            values = b.column(3).flatten()
            owner = np.repeat(np.arange(b.num_rows), counts)
            id_, th = (b.column(k).to_numpy()[owner] for k in (0, 1))
            at, grams, plain = (values.field(k) for k in ("at", "gram", "plain"))
            for first, last, left, avail, rights in contexts_of(b.column(2).to_pylist(), counts, at.to_numpy().astype(np.int64), width - 1, ladder):
                part = slice(int(first), int(last))
                offsets = pa.array(np.arange(last - first + 1) * len(ladder), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [grams[part], left, pa.array(id_[part]), pa.array(th[part]), at[part], pa.array(avail, pa.int32()),
                     pc.invert(plain[part]), pa.ListArray.from_arrays(offsets, pa.array(rights.ravel()))],
                    names=names,
                )

    def shared_lefts(batches):
        """(id, th, start, end) of the suffixes sorted for an anchor's left context and
        those of its gram; within runs of one gram, sorted by left context."""
        held, first = None, True
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            of = table.column("gram").to_numpy()
            cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
            if len(cuts):
                start = 0
                if first:
                    start, first = int(cuts[0]), False
                    yield cut_lefts(table.slice(0, start), True, False)
                if start < cuts[-1]:
                    yield lefts(table.slice(start, int(cuts[-1]) - start))
                table = table.slice(int(cuts[-1]))
            held = table if table.num_rows else None
        if held is not None:
            yield cut_lefts(held, first, True)

    def suffixes(table, anchors, lengths):
        at = table.column("at").to_numpy()[anchors]
        columns = [table.column("id").to_numpy()[anchors], table.column("th").to_numpy()[anchors]]
        columns += [(at - lengths).astype(np.int32), (at + length).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "th", "start", "end"])

    def lefts(table):
        """Of whole runs."""
        table = table.combine_chunks()
        run = np.cumsum(np.r_[0, np.diff(table.column("gram").to_numpy()) != 0])
        rights = table.column("rights").combine_chunks().flatten().to_numpy().reshape(-1, len(ladder))
        lcp = neighbours_common(table.column("left").combine_chunks(), width - 1)
        avail, own = table.column("avail").to_numpy(), table.column("own").to_numpy()
        return suffixes(table, *chosen(run, lcp, avail, rights, own, levels))

    def cut_lefts(table, at_start, at_end):
        """Of a run that may go on in other tasks: all lengths."""
        left = table.column("left").to_pylist()
        n, right = len(left), [r[-1] for r in table.column("rights").to_pylist()]
        lcp = [common(a, b, 0) for a, b in zip(left, left[1:], strict=False)]
        found = [shared_lengths(left, right, lcp, at_start, False), shared_lengths(left, right, lcp, at_end, True)]
        each = [(k, x) for k in range(n) for x in found[0][k] | found[1][n - 1 - k]]
        return suffixes(table, *np.array(each, np.int64).reshape(-1, 2).T)

    mixed = candidates.withColumn("values", F.filter("values", lambda v: v["mixed"])).filter(F.size("values") > 0)
    left = _with_texts(rows, mixed, max_broadcast).select("id", "th", "text", "values")
    left = left.mapInArrow(contexts, "gram long, left binary, id long, th long, at int, avail int, own boolean, rights array<long>")
    left = left.repartitionByRange("gram", "left", "id", "th", "at").sortWithinPartitions("gram", "left")
    starts = left.mapInArrow(shared_lefts, "id long, th long, start int, end int")
    plain = candidates.select("id", "th", F.explode("values").alias("v")).filter("v.plain").select(
        "id", "th", F.greatest(F.lit(0), F.col("v.at") - (width - 1)).alias("start"), (F.col("v.at") + length).alias("end")
    )
    starts = written(_per_doc(starts.union(plain).distinct(), F.struct("start", "end")), "starts")
    discard(candidates)
    total = starts.agg(F.sum(F.size("values"))).first()[0] or 0
    ranges = max(1, -(-total // entries))

    def sample(batches):
        for b in small(batches):
            out = [t[v["start"] : v["start"] + SPLITTER] for t, vs in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True) for v in vs[:64]]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["s"])

    few = starts.orderBy(F.xxhash64("id", "th")).limit(1000)
    heads = sorted(r["s"] for r in _with_texts(rows, written(few, "sampled"), max_broadcast).select("id", "th", "text", "values").mapInArrow(sample, "s binary").collect())
    splitters = sorted({heads[k * len(heads) // ranges] for k in range(1, ranges)}) if heads else []

    def build(batches):
        names = ["part", "run", "block"]
        run, entry, size = 0, {}, 0

        def cut():
            strings = sorted(entry)
            parts = [bisect.bisect_right(splitters, s[:SPLITTER]) for s in strings]
            at = 0
            for p in sorted(set(parts)):
                upto = bisect.bisect_right(parts, p)
                own = strings[at:upto]
                block = front_coded(own, [entry[s] for s in own])
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([TaskContext.get().partitionId() << 24 | run], pa.int64()), pa.array([block], pa.binary())], names=names)
                at = upto

        for b in small(batches):
            for id_, th, text, values in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                longest = {}
                for v in values:  # a place is one suffix
                    longest[v["start"]] = max(longest.get(v["start"], 0), v["end"])
                for start, end in longest.items():
                    s = text[start:end]
                    if len(s) >= length:
                        entry.setdefault(s, []).append((id_, th, start))
                        size += len(s) + 24
                if size > RUN_BYTES:
                    yield from cut()
                    run, entry, size = run + 1, {}, 0
        yield from cut()

    blocks = _with_texts(rows, starts, max_broadcast).select("id", "th", "text", "values").mapInArrow(build, "part long, run long, block binary")

    def combine(batches):
        names = ["id", "th", "start", "end"]
        for table in runs(batches, ["part"]):
            read = [decoded(b) for b in table.column("block").to_pylist()]
            order = list(merge([(shared, rests) for shared, rests, _ in read]))
            out = []
            for k, (stream, i, before, size) in enumerate(order):
                places = read[stream][2][i]
                after = order[k + 1][2] if k + 1 < len(order) else 0
                best = size if places.shape[1] > 1 else max(before, after)
                if best >= length:
                    out.append(np.vstack([places, places[2] + best]))
            if out:
                found = np.concatenate(out, 1)
                yield pa.RecordBatch.from_arrays([pa.array(found[k], pa.int64()) for k in range(4)], names=names)

    dealt = blocks.repartition(max(1, ranges), "part").sortWithinPartitions("part", "run")
    spans = dealt.mapInArrow(combine, "id long, th long, start long, end long")
    spans = written(_per_doc(spans, F.struct("start", "end")), "spans")
    discard(starts)
    return spans


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 64, max_broadcast: int = 1_000_000, **kw) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each document; kept: the remaining bytes, null where nothing goes."""
    spans = removed_spans(docs, length, gram, max_broadcast=max_broadcast, **kw)
    return _removed(docs, spans, max_broadcast, False)


def remove_repeats_digest(docs: DataFrame, length: int = 200, gram: int = 64, max_broadcast: int = 1_000_000, **kw) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)"""
    spans = removed_spans(docs, length, gram, max_broadcast=max_broadcast, **kw)
    return _removed(docs, spans, max_broadcast, True)


def _removed(docs: DataFrame, spans: DataFrame, max_broadcast: int, hashed: bool) -> DataFrame:
    rows = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text_of()).alias("th"), text_of().cast("binary").alias("text")
    )

    def cut(batches):
        for b in small(batches):
            out = []
            for id_, th, text, values in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                kept, at, removed, n = [], 0, 0, 0
                for v in sorted((v["start"], v["end"]) for v in values):
                    if v[0] > at or not n:
                        kept.append(text[at : v[0]])
                        n += 1
                        removed += v[1] - v[0]
                        at = v[1]
                    elif v[1] > at:
                        removed += v[1] - at
                        at = v[1]
                rest = b"".join([*kept, text[at:]])
                out.append((id_, th, removed, n, rest if not hashed else hashlib.sha256(rest).hexdigest().encode()))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "th", "n_removed", "n_spans", "kept"])

    own = _with_texts(rows.select("id", "th", "text"), spans, max_broadcast)
    done = own.select("id", "th", "text", "values").mapInArrow(cut, "id long, th long, n_removed long, n_spans long, kept binary")
    done = done.groupBy("id", "th").agg(*[F.first(c).alias(c) for c in ("n_removed", "n_spans", "kept")])
    zero = F.lit(0).cast("long")
    out = rows.select("doc_id", "id", "th", F.octet_length("text").cast("long").alias("n_bytes"), *([F.sha2("text", 256).alias("whole")] if hashed else []))
    out = out.join(done, ["id", "th"], "left")
    kept = F.coalesce(F.col("kept").cast("string"), F.col("whole")).alias("kept_sha256") if hashed else F.col("kept")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), kept)
