import zlib

import numpy as np
import pytest
from cohortlift.llm import packing

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


TEXTS = [
    "Hello, World. don't STOP!", None, "", " a  b\n\nc\t d ", "İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ", "été é́", "x" * 3000, "a... b?! 1,234.5 't",
    "Σ Hello WORLD, İ", "\u01c5 \u0149 ﬁn ß ẞ \u1e9e straße. ÀÉ àé \u212b ª ʰ ໂ", "<|endoftext|> <|EndOfText|>", "日本語 テキスト　です", "word " * 700, "naïve, über. ÉTÉ.", "a\x85b c\x1cd", "It's we'Ll 'S",
]


def test_ids_are_the_tokenizers(spark, docs_of):
    pieces = packing.tokenize(docs_of(TEXTS), PATH, max_tokens=64)
    own = {}
    for r in sorted(pieces.collect(), key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == 64 * r["piece"] and r["length"] == len(r["ids"]) // 4 <= 64
        own.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert own == {k: reference_ids(t) for k, t in enumerate(TEXTS)}


def test_placement_is_gapless_and_within_bounds(spark, docs_of):
    rng = np.random.default_rng(3)
    docs = docs_of(["w " * int(n) for n in rng.integers(0, 150, 400)] + [None, "w " * 640])
    pieces = packing.tokenize(docs, PATH, max_tokens=64)
    placed = packing.pack(pieces, max_tokens=64, group=60)
    rows = placed.collect()
    assert len(rows) == pieces.count()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    total = sum(r["length"] for r in rows)
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)])[:-1])
        assert sum(n for _, n in parts) <= 64
    assert len(by) <= 1.05 * total / 64 + 2
    ids = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()}
    for r in pieces.collect():
        at = next(p for p in rows if (p["doc_id"], p["piece"]) == (r["doc_id"], r["piece"]))
        assert ids[at["sequence_id"]][4 * at["offset"] :][: 4 * r["length"]] == r["ids"]


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_holds(score):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 500)
    place, offset = packing.best_fit(lengths, (100, 4, 6000), (1, 0.5, 0.5), score)
    for b in np.unique(place):
        own = lengths[place == b]
        assert own.sum() <= 100 and len(own) <= 4 and ((own**2).sum() <= 6000 or len(own) == 1)


def test_empty_and_repeated(spark, docs_of):
    assert packing.pack(packing.tokenize(docs_of([]), PATH)).collect() == []
    rows = packing.pack(packing.tokenize(docs_of(["a b", "a b", None], ids=[1, 1, None]), PATH)).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in rows) == [("1", 3), ("1", 3), ("None", 1)]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 3


def test_chunks_in_both_generations_and_all_letters(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 64)
    words = packing.WordIds(PATH)
    letters = [c for c in map(chr, [*range(0x80, 0x2000), *range(0x1d00, 0x1e00), *range(0xfb00, 0xfb10)]) if c.isalpha()]
    texts = [" ".join(letters[k : k + 40]) + f" a{c}b. {c.upper()}x" for k, c in enumerate(letters) if k % 25 == 0] + ["common word."] * 3
    for text in texts + texts[:20]:
        assert np.frombuffer(words.of([text])[0], "<u4").tolist() == reference_ids(text)[:-1], text


def test_sequences_hold_every_row_as_often_as_it_is_there(spark, docs_of):
    docs = docs_of(["a b c", "a b c", None, "d e", "f", ""], ids=[1, 1, None, None, 2, 2])
    placed = packing.pack(packing.tokenize(docs, PATH), max_tokens=4096)
    got = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in packing.sequences(placed).collect()])
    assert sorted(got.tolist()) == sorted(i for t in ["a b c", "a b c", None, "d e", "f", ""] for i in reference_ids(t))


def test_query_digest(spark):
    from cohortlift.llm.queries import op2_best_fit_packing

    sf = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op2_best_fit_packing(spark, sf).limit(60).collect():
        ids = reference_ids(text[r["doc_id"]])[r["start"] :][:4096]
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_only_different_chunks_are_looked_up(monkeypatch):
    words, seen = packing.WordIds(PATH), []

    class Known(dict):
        def __getitem__(self, c):
            seen.append(c)
            return super().__getitem__(c)

    words.known = Known()
    texts = ["same words here. " * 500, "same words, here. " * 500, "", *[t or "" for t in TEXTS]]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in words.of(texts)]
    assert got == [reference_ids(t)[:-1] for t in texts]
    assert len(seen) < 400
