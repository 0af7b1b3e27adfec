"""Chat formatting: conversations as one marked-up text with a loss mask.

A turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>\\n``. Control strings
(fixed list below) inside roles and texts are escaped: a backslash is put
behind their first character, and a backslash of the text is doubled, so
``unescape`` gives the original back.

Assembly is columnar: escaped columns come from Arrow kernels; segment
lengths, cumulative offsets and scatter indices are computed in numpy, and
headers and contents are copied into one preallocated buffer, which becomes
the Arrow text column without passing through Python strings.

Scale: one shuffle by conversation; tasks stream their sorted rows. A
conversation is one row (part 0) unless its text passes ``part_bytes``; then it
is cut between turns into numbered parts, so that no conversation, however
long, is held whole by a task.

Cases: turns come in order of turn (null first), ties by role and text, then
repeated rows one after another; null role or text is empty; a null conv_id is
a conversation of its own; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Strings that no text may smuggle in: the template's own and those of other common templates.
CONTROL = [
    "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "[INST]",
    "[/INST]", "<<SYS>>", "<</SYS>>",
]
SCHEMA = "conv_id long, part int, n_turns long, text string, loss_starts array<long>, loss_ends array<long>"


def _escaped(column: pa.Array) -> pa.Array:
    """Control strings start with < or [ and hold no backslash, none is the
    prefix of another's rest: breaking each behind its first character leaves none."""
    pattern = "([<\\[])(" + "|".join(sorted((re.escape(c[1:]) for c in CONTROL), key=len, reverse=True)) + ")"
    column = pc.replace_substring(column, "\\", "\\\\")
    return pc.replace_substring_regex(column, pattern, "\\1\\\\\\2")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, data) of a string column."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns' bytes; turn offsets in it; each turn's
    content start and end, counted in code points from the turn's start."""
    roles, texts = _escaped(roles), _escaped(texts)
    marks = [np.frombuffer(m.encode(), np.uint8) for m in (START, SEP, END)]
    columns = [_bytes_of(roles), _bytes_of(texts)]
    n = len(roles)
    # segments of a turn, in order: start mark, role, separator, text, end mark
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0::2] = [len(m) for m in marks]
    lengths[:, 1], lengths[:, 3] = np.diff(columns[0][0]), np.diff(columns[1][0])
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(n, 5)
    buffer = pa.allocate_buffer(int(ends[-1]) if n else 0)
    out = np.frombuffer(buffer, np.uint8)
    for k, mark in zip((0, 2, 4), marks, strict=True):
        out[starts[:, k, None] + np.arange(len(mark))] = mark
    for k, (offsets, data) in zip((1, 3), columns, strict=True):
        size = lengths[:, k]
        shift = np.repeat(starts[:, k] - offsets[:-1], size)
        at = np.arange(offsets[0], offsets[-1])
        out[at + shift] = data[offsets[0] : offsets[-1]]
    head = len(START) + len(SEP) + pc.utf8_length(roles).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    return buffer, np.append(starts[:, 0], ends[-1] if n else 0), head, head + chars


def _rows(table: pa.Table, first_part: int) -> pa.RecordBatch:
    """Whole conversations (or parts of one) of a sorted table of turns."""
    ids = table.column("conv_id").combine_chunks()
    buffer, offsets, content, content_end = assemble(table.column("role").combine_chunks(), table.column("text").combine_chunks())
    n = len(ids)
    filled = ids.fill_null(0).to_numpy()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    new = np.r_[True, (filled[1:] != filled[:-1]) | (null[1:] != null[:-1])]
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    turn_chars = content_end + len(END)
    before = np.cumsum(turn_chars) - turn_chars
    before -= before[first][group]  # code points of the conversation before the turn
    loss = pc.equal(table.column("role").combine_chunks(), "assistant").to_numpy(zero_copy_only=False)
    counts = np.r_[0, np.cumsum(np.bincount(group[loss], minlength=len(first)))]
    lists = [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array((before + x)[loss])) for x in (content, content_end)]
    bounds = np.append(offsets[first], offsets[-1])
    text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int64).tobytes()), buffer).cast(pa.string())
    parts = np.zeros(len(first), np.int32)
    parts[0] = first_part
    columns = [ids.take(pa.array(first)), pa.array(parts), pa.array(np.diff(np.append(first, n))), text, *lists]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "n_turns", "text", "loss_starts", "loss_ends"])


def format_conversations(turns: DataFrame, part_bytes: int = 16 << 20) -> DataFrame:
    """(conv_id, part, n_turns, text, loss_starts, loss_ends) of turns (conv_id,
    turn, role, text); the loss spans are code points of the part's text and
    cover exactly the assistants' (escaped) texts. Rows are sorted by conv_id
    and part within partitions, and all parts of a conversation share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, part, last = None, 0, None  # rest: the turns of the last conversation, which may go on
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            if not table.num_rows:
                continue
            ids = table.column("conv_id").to_pylist()
            if part and ids[0] != last:
                part = 0
            cut = len(ids)
            while cut and ids[cut - 1] == ids[-1]:
                cut -= 1
            if cut:
                yield _rows(table.slice(0, cut), part)
                part = 0
            rest = table.slice(cut)
            if rest.column("text").nbytes > part_bytes:
                yield _rows(rest, part)
                rest, part, last = None, part + 1, ids[-1]
        if rest is not None:
            yield _rows(rest, part)

    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text_of().alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")
    return rows.mapInArrow(run, SCHEMA)


TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.S)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, what the formatted text says: conv_id, n_turns,
    turns_sha256 (role, newline, text, newline per turn), loss_chars,
    loss_sha256 (of the unescaped text under the loss mask), formatted_chars.

    Takes the rows as ``format_conversations`` leaves them: the parts of a
    conversation in order and in one partition. Hashes are fed part by part.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        state, now = None, ()
        done = []

        def close():
            if state:
                done.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, part, text, starts, ends in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5)), strict=True):
                if state is None or part == 0 or now != (conv,):
                    close()
                    state, now = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], (conv,)
                at = 0
                for turn in TURN.finditer(text):
                    if turn.start() != at:
                        raise ValueError(f"conversation {conv}: not a turn at {at}")
                    at = turn.end()
                    role, said = map(unescape, turn.groups())
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if at != len(text):
                    raise ValueError(f"conversation {conv}: not a turn at {at}")
                for a, b in zip(starts, ends, strict=True):
                    said = unescape(text[a:b])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in done], digests)
                done.clear()
        close()
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in done], digests)

    digests = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in schema.split(", ")])
    return formatted.mapInArrow(run, schema)
