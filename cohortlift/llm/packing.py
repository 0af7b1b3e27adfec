"""Best-fit packing of tokenised documents into sequences of bounded length.

``tokenize`` turns documents into token pieces, ``pack`` places pieces into
sequences, ``sequences`` puts the placed pieces' ids together.

Packing is vector best fit: a sequence has a residual capacity in three
dimensions (tokens, documents, attention cost = sum of squared lengths). A
piece, longest first, goes to the open sequence that can hold it in every
dimension and that the score prefers: the smallest weighted norm of what would
be left (``norm``), or the largest weighted dot product of the piece's demand
and what the sequence has used already (``dot``). If none can, it opens a new one.

Scale: pieces are dealt evenly (round robin) to tasks of about ``group``
pieces, so no key can crowd a task; sequences that stay below ``refill`` full
are opened again and their pieces packed once more in fewer tasks.

Cases: null text is the empty text, whose only piece is the end id; a null
doc_id is carried through; repeated rows are packed once each; an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import array
import functools
import math
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, worker_cache, written

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"
PUNCTUATION = ".,;:!?"
CACHE_WORDS = 350_000
SLICE_CHARS = 1 << 22
ID_BYTES = functools.partial(array.array, "I")
LOWER_BY_CONTEXT = set("\u0130\u03a3")  # letters that str.lower does not lower one by one

#: Byte-level tokenizers write a byte as the character of its number if that is printable in Latin-1, else as one from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


class WordIds:
    """Ids (little-endian uint32 bytes) of texts, each blank-separated chunk encoded once.

    The tokenizer's splits never cross a blank, so a text's ids are its
    chunks' ids in order. Within a chunk, letters and final punctuation are
    split too, and it reads upper case as lower case.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # chunks met before the last change of generations

    def _learn(self, chunks: list[str]) -> None:
        known, older, tokens = self.known, self.older, self.tokenizer.model.tokenize
        rest, cut = [], []
        for c in chunks:
            if (ids := older.get(c)) is not None:
                known[c] = ids
                continue
            word = c
            if not c.isalpha():
                word = c[:-1]
                if c[-1:] not in PUNCTUATION or not word.isalpha():
                    rest.append(c)
                    continue
                cut.append(c)
                if word in known:
                    continue
                if (ids := older.get(word)) is not None:
                    known[word] = ids
                    continue
            # of letters in lower case, the tokenizer's other steps only write the bytes as characters
            if word.isascii() and word.islower():
                known[word] = ID_BYTES([k.id for k in tokens(word)]).tobytes()
            elif not word.isascii() and word == word.lower() and unicodedata.is_normalized("NFC", word):
                known[word] = ID_BYTES([k.id for k in tokens(word.encode().decode("latin-1").translate(BYTE_CHARACTERS))]).tobytes()
            else:
                rest.append(word)
        rest += [c for c in PUNCTUATION if c not in known]
        for c, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[c] = ID_BYTES(e.ids).tobytes()
        for c in cut:
            known[c] = known[c[:-1]] + known[c[-1]]

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text.

        Arrow splits the texts and numbers their different chunks; only those
        are looked up, and the texts' ids are gathered by number.
        """
        if len(self.known) > CACHE_WORDS // 2:  # what was met since the last change stays at hand
            self.known, self.older = {}, self.known
        low = []
        for text in texts:
            if text.isascii():
                text = text.lower()
            elif not (LOWER_BY_CONTEXT & set(text)) and unicodedata.is_normalized("NFC", text):
                lower = text.lower()
                if unicodedata.is_normalized("NFC", lower):  # else the tokenizer, which composes first, lowers it
                    text = lower
            low.append(text.replace("\n", " "))
        split = pc.split_pattern(pa.array(low, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.known
        if new := [c for c in chunks if c not in known]:
            self._learn(new)
        ids = list(map(known.__getitem__, chunks))
        for c in new:
            if len(c) > 64:
                del known[c]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, flat = np.cumsum(size) - size, np.frombuffer(b"".join(ids), np.uint32)
        which = coded.indices.to_numpy()
        sizes = size[which]
        ends = np.r_[0, np.cumsum(sizes)]
        found = flat[np.repeat(first[which] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[split.offsets.to_numpy()]).tolist()
        return [found[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def tokenize(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids) of each document's ids followed by
    ``end_id``, cut only where they exceed ``max_tokens``."""
    end = int(end_id).to_bytes(4, "little")
    step = 4 * max_tokens

    def cut(batches):
        cache = worker_cache("tokenizers")
        if tokenizer_path not in cache:
            cache[tokenizer_path] = WordIds(tokenizer_path)
        words = cache[tokenizer_path]
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # so many texts at a time that their chunks stay small
                texts, chars = [], 0
                while at + len(texts) < batch.num_rows and chars < SLICE_CHARS:
                    texts.append(batch.column(1)[at + len(texts)].as_py())
                    chars += len(texts[-1])
                rows = []
                for doc_id, ids in zip(batch.column(0).slice(at, len(texts)).to_pylist(), words.of(texts), strict=True):
                    ids += end
                    for k in range(0, len(ids), step):
                        part = ids[k : k + step]
                        rows.append((doc_id, k // step, k // 4, len(part) // 4, part))
                at += len(texts)
                yield to_batch(rows)

    def to_batch(rows):
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        names = ["doc_id", "piece", "start", "length", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(cut, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float], score: str):
    """Sequence number and offset of each piece (vector best fit, longest first)."""
    cap = np.array(capacity, float)
    w = np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    smallest = int(lengths.min()) if len(lengths) else 0
    left = np.empty((1024, 3))  # residuals of the open sequences
    name = np.empty(1024, np.int64)
    used, opened = 0, 0
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for n, i in enumerate(order):
        size = float(lengths[i])
        need = np.array((size, 1.0, size * size))
        now = left[:used]
        fits = np.flatnonzero((now[:, 0] >= size) & (now[:, 1] >= 1) & (now[:, 2] >= need[2]))
        if len(fits):
            if score == "norm":
                at = fits[np.argmin((((now[fits] - need) / cap) ** 2) @ w)]
            else:
                at = fits[np.argmax(((cap - now[fits]) / cap) @ (w * need / cap))]
        else:
            if used == len(left):
                left, name = np.concatenate([left, np.empty_like(left)]), np.concatenate([name, np.empty_like(name)])
            at, used = used, used + 1
            left[at], name[at] = cap, opened
            opened += 1
        place[i], offset[i] = name[at], cap[0] - left[at, 0]
        left[at] -= need
        if n % 512 == 511:  # what can hold no further piece is closed
            stay = np.flatnonzero((left[:used, 0] >= smallest) & (left[:used, 1] >= 1) & (left[:used, 2] >= smallest**2))
            left[: len(stay)], name[: len(stay)], used = left[stay], name[stay], len(stay)
    return place, offset


def pack(
    pieces: DataFrame,
    max_tokens: int = 4096,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    score: str = "norm",
    group: int = 16_000,
    refill: float = 0.97,
) -> DataFrame:
    """``pieces`` (any columns, with length of at most ``max_tokens``) plus
    sequence_id and offset.

    ``max_documents`` and ``max_attention`` default to what ``max_tokens``
    allows anyway. A piece as long as a sequence gets one of its own.
    """
    capacity = (max_tokens, max_documents or max_tokens, max_attention or max_tokens**2)
    if score not in ("norm", "dot"):
        raise ValueError("score is norm or dot")
    if capacity[2] < max_tokens**2:
        # a piece alone must fit; shorter pieces are the tokenizer's task
        raise ValueError("max_attention must allow one piece of max_tokens")
    pieces = written(pieces, "pieces")
    out = "sequence_id long, offset long"
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + f", {out}, _fill double"

    def dealt(df: DataFrame, round_: int) -> DataFrame:
        def place(batches):
            tables = [pa.Table.from_batches([b]) for b in batches]
            if not tables:
                return
            table = pa.concat_tables(tables).combine_chunks()
            lengths = table.column("length").to_numpy()
            at, offset = best_fit(lengths, capacity, weights, score)
            fill = np.bincount(at, lengths, minlength=1) / max_tokens
            number = at + (((round_ << 24) + TaskContext.get().partitionId()) << 24)
            for name, values in (("sequence_id", number), ("offset", offset), ("_fill", fill[at])):
                table = table.append_column(name, pa.array(values))
            yield from table.to_batches(max_chunksize=50_000)

        tasks = max(1, math.ceil(df.count() / group))
        return written(df.repartition(tasks).mapInArrow(place, schema), f"packed{round_}")

    whole = pieces.filter(F.col("length") >= max_tokens).select(
        *kept, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    first = dealt(pieces.filter(F.col("length") < max_tokens), 0)
    again = dealt(first.filter(F.col("_fill") < refill).select(*kept), 1)
    return whole.unionByName(first.filter(F.col("_fill") >= refill).drop("_fill")).unionByName(again.drop("_fill"))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): each sequence's ids in order, from placed pieces that carry their ``ids``.

    ``pack`` carries all columns of the pieces, so no piece has to be found
    again: repeated rows and null doc_ids are in their sequences as often as
    they were packed. A sequence is bounded by ``max_tokens``.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
