from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tallyspark.llm import online_packing as op  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, want, window=2048):
    """Every id of every document in exactly one piece, sequences without gaps; returns the share
    of padding. ``want``: a list of (doc_id, ids); doc_ids are distinct."""
    ids, pieces, sequences = dict(want), defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(ids)
    for doc, found in pieces.items():
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids[doc])
            part = np.array(ids[doc][at:at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids[doc])
    padding = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / max(1, sum(map(len, ids.values())))


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_documents(docs, library):
    rows = rows_of(op.packed_pieces(docs, PATH).select(*COLUMNS))
    want = [(r.doc_id, ids_of(library, r.text)) for r in docs.collect()]
    assert check(rows, want) < 0.005


def test_edge_rows_and_repeats(edge_docs, no_docs, library):
    pieces = op.packed_pieces(edge_docs, PATH)
    assert pieces.columns == COLUMNS
    rows = rows_of(pieces)
    texts = defaultdict(list)
    for r in edge_docs.collect():
        texts[r.doc_id].append(len(ids_of(library, r.text)))
    lengths = defaultdict(int)
    for r in rows:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {d: sum(n) for d, n in texts.items()}
    once = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    check(rows_of(op.packed_pieces(once, PATH)),
          [(r.doc_id, ids_of(library, r.text)) for r in once.collect()])
    assert op.packed_pieces(no_docs, PATH).collect() == []


def test_leftovers_of_many_partitions_are_merged(spark, docs, library):
    """More partitions than one merge takes, many of them empty."""
    small = docs.where("length(text) < 3000")
    want = [(r.doc_id, ids_of(library, r.text)) for r in small.collect()]
    for n in (1, 9, 70):
        rows = rows_of(op.packed_pieces(small.repartition(n), PATH))
        assert check(rows, want) < 0.005
        full = sum(r["length"] for r in rows) // 2048
        assert len({r["sequence_id"] for r in rows}) <= full * 1.01 + 12


def test_sequences_hold_their_ids(docs, library):
    few = docs.limit(50)
    seqs = op.sequences(op.pack_documents(few, PATH, window=256, with_ids=True), 256).collect()
    for r in seqs:
        n = r["n_tokens"]
        assert len(r["ids"]) == (n if n & (n - 1) == 0 else 256)
        assert not any(r["ids"][n:])
    want = sorted(i for r in few.collect() for i in ids_of(library, r.text))
    assert sorted(i for r in seqs for i in r["ids"][:r["n_tokens"]]) == want


def test_packer_places_best_fit():
    p = op.Packer(0, window=10, open_windows=2, pad=1)
    ids = np.arange(100, dtype=np.uint32)
    p.place(("a", 0, ids[:6], 6))
    p.place(("b", 0, ids[:9], 9))           # does not fit beside a
    p.place(("c", 0, ids[:4], 4))           # fits a best, which is full now
    assert p.out == [] or [x[0] for x in p.out] == ["a", "c"]
    assert [(x[0], x[4], x[5]) for x in p.out] == [("a", 0, 0), ("c", 0, 6)]
    p.place(("d", 0, ids[:8], 8))           # an empty window is left
    p.place(("e", 0, ids[:5], 5))           # none fits: b goes, padded by one
    assert [(x[0], x[4]) for x in p.out[2:]] == [("b", 1)]
    p.place(("f", 0, ids[:7], 7))           # none fits: d is filled with the first two of f
    assert [(x[0], len(x[2]), x[4]) for x in p.out[3:]] == [("d", 8, 2), ("f", 2, 2), ("e", 5, 3),
                                                            ("f", 5, 3)]


def test_random_pieces_never_get_lost():
    rng = random.Random(2)
    for _ in range(200):
        window, k = rng.choice([4, 16, 64]), rng.randint(1, 5)
        p = op.Packer(0, window=window, open_windows=k, pad=rng.choice([0, 1]))
        docs = [np.arange(rng.randint(1, 3 * window), dtype=np.uint32) for _ in range(40)]
        for d, ids in enumerate(docs):
            p.add(d, ids)
            assert len(p.room) == k
        p.finish(p.pour())
        got = defaultdict(int)
        load = defaultdict(int)
        for doc, start, ids, total, seq, at in p.out:
            got[doc] += len(ids)
            assert at == load[seq] and ids[0] == start and total == len(docs[doc])
            load[seq] += len(ids)
        assert got == {d: len(x) for d, x in enumerate(docs)} and max(load.values()) <= window
