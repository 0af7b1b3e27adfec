"""Conversation structure repair: the cheapest edits that make turn orders legal.

A repaired conversation has the role initials ``(s?(ua)+)?``. A row is kept (0),
given the role user or assistant (3) or deleted (4); a row without text may be
inserted anywhere (3). Blank and duplicate rows must be deleted, truncated ones
cost 3 more unless they are. Of the cheapest edits, those whose initials are
ASCII-least are the audit.

Method, rank-convergence parallel Viterbi: the four states of the legal pattern
(start, after s, after u, after a) make each row a min-plus step on a vector of
four backward costs. A conversation is cut into chunks, all run at once from a
speculative vector; fix-up passes rerun a chunk from its right neighbour's
result until its vectors differ from the earlier ones only by a constant, from
where on the earlier ones hold. The constants are added up from the right, and
the stitched backward costs alone tell each state's least next edit, so the
audit is traced forward without search.

Scale: rows are put in order by one range shuffle and cut into segments of at
most ``segment_rows`` rows; a segment is one string of a character per row.
Segments are solved in parallel, each for the four unit vectors, so that one
pass over a conversation's segments (16 numbers each) gives all of them their
vector; a conversation of any length needs no more passes. Duplicates are found
by partially aggregated first places. Only the digest of the repaired text
reads a conversation's rows one after another, as a running hash must; they are
streamed.

Cases: null role, text or conv_id (in the damage's key) is one space; a null
conv_id is a conversation of its own; null turns come first; rows of one turn
come by role, then by a hash of role and text; repeated rows are duplicates; an
empty table gives an empty result; texts of any length are read whole; a role
without initial is never kept; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, written
from .order import ordered

#: Characters that do not count as text.
SPACE = " \t\n\x0b\x0c\r"
#: A row's symbol: its fault if it must go, else its initial (x: not s, u or a), a capital if truncated.
SYMBOLS = "bdsuaxSUAX"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NEVER = 1 << 40
#: States: start, after s, after u, after a. The role that Rerole or Insert gives, and the state after it.
NEXT = np.array([2, 2, 3, 2])
GIVES = ["user", "user", "assistant", "user"]
AFTER = {"s": [1, -1, -1, -1], "u": [2, 2, -1, 2], "a": [-1, -1, 3, -1]}
ACCEPTS = (0, 3)
NOTHING = len(SYMBOLS)  # a symbol that fills chunks up and changes nothing
CHUNK = 32

_keep_to = np.zeros((NOTHING + 1, 4), np.int64)
_keep = np.full((NOTHING + 1, 4), NEVER)
_rerole = np.full(NOTHING + 1, NEVER)
_delete = np.full(NOTHING + 1, DELETE)
_delete[NOTHING] = 0
for _k, _c in enumerate(SYMBOLS):
    if _c in "bd":
        continue
    _extra = TRUNCATED if _c.isupper() else 0
    _rerole[_k] = REROLE + _extra
    for _q, _to in enumerate(AFTER.get(_c.lower(), [-1] * 4)):
        if _to >= 0:
            _keep_to[_k, _q], _keep[_k, _q] = _to, KEEP + _extra


def closed(v: np.ndarray) -> np.ndarray:
    """Backward costs once rows may be inserted too (at most two in a row ever pay)."""
    v = np.minimum(v, INSERT + v[:, NEXT])
    return np.minimum(v, INSERT + v[:, NEXT])


def options(v: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs to delete, keep or rerole a row in each state, given the costs ``v`` after it."""
    keep = _keep[symbol] + np.take_along_axis(v, _keep_to[symbol], 1)
    return _delete[symbol][:, None] + v, keep, _rerole[symbol][:, None] + v[:, NEXT]


def before(v: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Costs before a row, given those after it."""
    return closed(np.minimum.reduce(options(v, symbol)))


def _parallel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether vectors differ only by a constant."""
    d = a - b
    return (d == d[:, :1]).all(1)


def backward(symbols: np.ndarray, lengths: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs before every row of segments that lie one after another in
    ``symbols``, from the costs behind each segment, and those before each segment.

    Chunks of a segment run side by side. All but a segment's last start from a
    speculative vector and are rerun until their right neighbour's result
    differs from the vector they used only by a constant.
    """
    right = closed(right)
    chunks = np.maximum(1, -(-lengths // CHUNK))
    owner = np.repeat(np.arange(len(lengths)), chunks)
    first = np.cumsum(chunks) - chunks
    nth = np.arange(len(owner)) - first[owner]
    is_last = nth == chunks[owner] - 1
    starts = (np.cumsum(lengths) - lengths)[owner] + nth * CHUNK
    size = np.minimum(CHUNK, lengths[owner] - nth * CHUNK)
    at = starts[:, None] + np.arange(CHUNK)
    inside = np.arange(CHUNK) < size[:, None]
    grid = np.full((len(owner), CHUNK), NOTHING)
    grid[inside] = symbols[at[inside]]
    cost = np.empty((len(owner), CHUNK + 1, 4), np.int64)
    cost[:, CHUNK] = np.where(is_last[:, None], right[owner], 0)
    for k in range(CHUNK - 1, -1, -1):
        cost[:, k] = before(cost[:, k + 1], grid[:, k])
    inner = np.flatnonzero(~is_last)
    while len(wrong := inner[~_parallel(cost[inner + 1, 0], cost[inner, CHUNK])]):
        now = cost[wrong + 1, 0]
        cost[wrong, CHUNK] = now
        for k in range(CHUNK - 1, -1, -1):
            now = before(now, grid[wrong, k])
            same = _parallel(now, cost[wrong, k])
            shift = (now - cost[wrong, k])[:, 0]
            met = wrong[same]
            cost[met, : k + 1] += shift[same][:, None, None]  # the rest differs by that constant
            wrong, now = wrong[~same], now[~same]
            if not len(wrong):
                break
            cost[wrong, k] = now
    # stitch: a chunk's costs are right up to what its right neighbour's result lacks
    lack = np.zeros(len(owner), np.int64)
    lack[inner] = (cost[inner + 1, 0] - cost[inner, CHUNK])[:, 0]
    total = np.cumsum(lack[::-1])[::-1]
    ends = first + chunks - 1
    cost += (total - total[ends][owner])[:, None, None]
    flat = np.empty((int(lengths.sum()) + 1, 4), np.int64)
    flat[at[inside]] = cost[:, :CHUNK][inside]
    return flat[:-1], cost[first, 0]


def edits(symbols: np.ndarray, lengths: np.ndarray, right: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row and state: how many rows are inserted before it, its own edit and the state behind it, ASCII-least among the cheapest."""
    behind = np.empty_like(cost)
    behind[:-1] = cost[1:]
    ends = np.cumsum(lengths)[lengths > 0] - 1
    behind[ends] = closed(right)[lengths > 0]
    delete, keep, rerole = options(behind, symbols)
    state = np.broadcast_to(np.arange(4), cost.shape)
    op = np.where(delete == cost, ord("D"), np.where(INSERT + cost[:, NEXT] == cost, ord("I"), np.where(keep == cost, ord("K"), ord("R"))))
    goes = np.where(op == ord("D"), state, np.where(op == ord("K"), _keep_to[symbols], NEXT[state]))
    inserted = np.zeros(cost.shape, np.int64)
    for _ in range(2):  # an insertion leads to another state of the same row
        more = op == ord("I")
        inserted += more
        follow = np.where(more, goes, state)
        op, goes = np.where(more, np.take_along_axis(op, follow, 1), op), np.where(more, np.take_along_axis(goes, follow, 1), goes)
    return inserted, op, goes


def trace(lengths: np.ndarray, inserted: np.ndarray, op: np.ndarray, goes: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
    """Per segment the audit from each of the four states before it, and the states behind it."""
    begin = np.cumsum(lengths) - lengths
    state = np.broadcast_to(np.arange(4), (len(lengths), 4)).copy()
    passed = np.empty(op.shape, np.int64)
    for k in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > k)
        at = begin[live] + k
        passed[at] = state[live]
        state[live] = np.take_along_axis(goes[at], state[live], 1)
    audits = []
    for q in range(4):
        rows = np.arange(len(op))
        count = inserted[rows, passed[:, q]] + 1 if len(op) else np.zeros(0, np.int64)
        text = np.full(int(count.sum()), ord("I"), np.uint8)
        text[np.cumsum(count) - 1] = op[rows, passed[:, q]]
        cuts = np.r_[0, np.cumsum(count)]
        text = text.tobytes().decode()
        audits.append([text[cuts[b] : cuts[b + n]] for b, n in zip(begin.tolist(), lengths.tolist(), strict=True)])
    return [list(x) for x in zip(*audits, strict=True)], state


END = np.array([[0, NEVER, NEVER, 0]])
UNITS = np.where(np.eye(4, dtype=bool), 0, NEVER)
_code = np.full(256, NOTHING)
for _k, _c in enumerate(SYMBOLS):
    _code[ord(_c)] = _k


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all segments, and the segments' lengths."""
    said = column.to_pylist()
    return _code[np.frombuffer("".join(said).encode(), np.uint8)], np.array([len(x) for x in said], np.int64)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each segment's costs before it (rows: state before, columns: state behind)."""
    for batch in batches:
        symbols, lengths = _symbols(batch.column("symbols"))
        each = [backward(symbols, lengths, np.repeat(UNITS[q : q + 1], len(lengths), 0))[1] for q in range(4)]
        rows = np.stack(each, 2).reshape(len(lengths), 16)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows.tolist(), pa.list_(pa.int64()))], names=[*batch.schema.names, "matrix"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The costs behind each segment; segments of a conversation come from last to first."""
    conv, right = object(), None
    for batch in batches:
        out = []
        for now, matrix in zip(batch.column("conv_id").to_pylist(), batch.column("matrix").to_pylist(), strict=True):
            if now != conv:
                conv, right = now, END[0]
            out.append(right.tolist())
            right = np.minimum((np.array(matrix).reshape(4, 4) + right).min(1), NEVER)
        yield pa.RecordBatch.from_arrays([batch.column("seg"), pa.array(out, pa.list_(pa.int64()))], names=["seg", "right"])


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment's audits and end states for the four states before it."""
    for batch in batches:
        symbols, lengths = _symbols(batch.column("symbols"))
        right = np.array(batch.column("right").to_pylist(), np.int64).reshape(-1, 4)
        cost, _ = backward(symbols, lengths, right)
        audits, states = trace(lengths, *edits(symbols, lengths, right, cost))
        columns = [batch.column("conv_id"), batch.column("seg"), batch.column("symbols"), pa.array(audits, pa.list_(pa.string())), pa.array(states.tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "at", "symbols", "audits", "states"])


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
LEGAL = {"su", "ua", "au"}


class _Conversation:
    """What is known of a conversation while its segments and rows pass by."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.said, self.audit = conv_id, 0, [], []
        self.counts, self.illegal, self.cost = dict.fromkeys("bdt", 0), 0, 0
        self.initial, self.turns, self.hash, self.written = None, None, hashlib.sha256(), False

    def segment(self, symbols: str, audits: list[str], states: list[int]):
        self.counts["b"] += symbols.count("b")
        self.counts["d"] += symbols.count("d")
        self.counts["t"] += sum(map(symbols.count, "SUAX"))
        audit, self.symbols = audits[self.state], symbols
        self.audit.append(audit)
        # the edits up to and with that of the next row
        self.steps, self.row = list(_steps(audit)), 0
        self.end = states[self.state]

    def put(self, role: str, text: str):
        if self.written:
            self.hash.update(b"\n")
        self.written = True
        self.hash.update(role.encode())
        self.hash.update(b":")
        self.hash.update(text.encode())

    def insert(self, count: int):
        for _ in range(count):
            self.put(GIVES[self.state], "")
            self.state = int(NEXT[self.state])
            self.cost += INSERT

    def turn(self, turn, role: str, text: str):
        if turn is not None:
            low, high, distinct = self.turns or (turn, turn, 0)
            self.turns = (low, turn, distinct + (self.turns is None or turn != high))
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        count, op = self.steps[self.row]
        self.insert(count)
        extra = TRUNCATED if self.symbols[self.row].isupper() else 0
        if op == "K":
            self.put(role, text)
            self.state = AFTER[initial][self.state]
            self.cost += KEEP + extra
        elif op == "R":
            self.put(GIVES[self.state], text)
            self.state = int(NEXT[self.state])
            self.cost += REROLE + extra
        else:
            self.cost += DELETE
        self.row += 1

    def row_of_report(self) -> tuple:
        count = 0
        while self.state not in ACCEPTS:
            self.insert(1)
            count += 1
        low, high, distinct = self.turns or (0, -1, 0)
        audit = "".join(self.audit) + "I" * count
        return (
            self.conv_id, high - low + 1 - distinct, self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, self.cost,
            audit, self.hash.hexdigest(),
        )


def _steps(audit: str) -> Iterator[tuple[int, str]]:
    count = 0
    for c in audit:
        if c == "I":
            count += 1
        else:
            yield count, c
            count = 0


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports of conversations whose rows come in order, each segment's audits before its rows."""
    schema = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in REPORT.split(", ")])
    conv = None
    for batch in small(batches):
        done = []
        names = ("conv_id", "kind", "turn", "role", "text", "symbols", "audits", "states")
        for conv_id, kind, turn, role, text, symbols, audits, states in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if conv is None or conv.conv_id != conv_id:
                if conv is not None:
                    done.append(conv.row_of_report())
                conv = _Conversation(conv_id)
            if kind == 1:
                conv.segment(symbols, audits, states)
            elif kind == 2:
                conv.turn(turn, role, text)
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in done], schema)
    if conv is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, conv.row_of_report(), strict=True))], schema)


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of conversations with reproducible damage:
    by the CRC-32 of ``conv_id:turn``, 5 % of rows each are dropped, emptied,
    stripped of ``[.!?]``, repeated or given to the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy"))
    return rows.drop("copy")


def _symbol(first: Column) -> Column:
    """A row's symbol, by its initial, last character that is no space, and whether it is the first of its kind."""
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("x"))
    truncated = ~F.col("last").isin(".", "!", "?")
    return F.when(F.col("last") == "", "b").when(first.isNull(), "d").when(truncated, F.upper(initial)).otherwise(initial)


def repair(turns: DataFrame, every: DataFrame | None = None, segment_rows: int = 4096) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text; role and
    text not null), and per conv_id of ``every``: faults, cost, audit and the
    hash of the repaired conversation."""
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    rows = turns.select("conv_id", "turn", "role", "text", key.alias("key"), F.substring("role", 1, 1).alias("initial"), last.alias("last"))
    rows = ordered(rows, ["conv_id", "turn", "role", "key"], "turns")
    firsts = rows.groupBy("conv_id", "key").agg(F.min("at").alias("at")).select("at", F.lit(1).alias("first"))
    light = rows.select("conv_id", "at", "initial", "last").join(firsts, "at", "left")
    light = light.select("conv_id", F.expr(f"at div {segment_rows}").alias("block"), "at", _symbol(F.col("first")).alias("s"))
    segments = light.groupBy("conv_id", "block").agg(
        F.min("at").alias("seg"), F.array_join(F.sort_array(F.collect_list(F.struct("at", "s"))).getField("s"), "").alias("symbols")
    )
    segments = segments.select("conv_id", "seg", "symbols").mapInArrow(_matrices, "conv_id long, seg long, symbols string, matrix array<long>")
    segments = written(segments, "segments")
    by_last = segments.select("conv_id", "seg", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg"))
    right = by_last.mapInArrow(_vectors, "seg long, right array<long>")
    solved = segments.select("conv_id", "seg", "symbols").join(right, "seg").select("conv_id", "seg", "symbols", "right")
    solved = solved.mapInArrow(_audits, "conv_id long, at long, symbols string, audits array<string>, states array<long>")
    everyone = (turns if every is None else every).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    parts = everyone.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(0).alias("kind"))
    parts = parts.unionByName(solved.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    parts = parts.unionByName(rows.select("conv_id", "at", F.lit(2).alias("kind"), "turn", "role", "text"), allowMissingColumns=True)
    parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
    return parts.select("conv_id", "kind", "turn", "role", "text", "symbols", "audits", "states").mapInArrow(_reports, REPORT)
