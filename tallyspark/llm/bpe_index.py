"""Byte-pair encoding with a pair occurrence index, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
from array import array
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import pick, positional

#: Fixed: how the byte-level pre-tokenizer cuts a text into words (letters, numbers, blanks).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{S}{l}{n}]+|{W}+(?!{V})|{W}+"


def _class(prop: str) -> str:
    """The characters below U+10000 with a property, as ranges for a character class."""
    plane = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    return "".join(f"\\u{ord(m.group()[0]):04x}-\\u{ord(m.group()[-1]):04x}"
                   for run in regex.finditer(f"{prop}+", plane)
                   for m in re.finditer("[\u0000-\ud7ff]+|[\ue000-\uffff]+", run.group()))


def _patterns():
    """The pattern twice: for any text, and with the properties spelled out, for the faster
    standard engine, for texts below U+10000."""
    wide = PATTERN.format(L=r"\p{L}", N=r"\p{N}", S=r"\s", l=r"\p{L}", n=r"\p{N}", W=r"\s",
                          V=r"\S")
    let, num, blank = _class(r"\p{L}"), _class(r"\p{N}"), _class(r"\s")
    narrow = PATTERN.format(L=f"[{let}]", N=f"[{num}]", S=blank, l=let, n=num, W=f"[{blank}]",
                            V=f"[^{blank}]")
    return regex.compile(wide), re.compile(narrow)


WORDS, WORDS_BELOW = _patterns()
ABOVE = re.compile("[\U00010000-\U0010ffff]")
CACHE_WORDS = 500_000      # words remembered by one task; beyond this it starts anew
CACHE_BYTES = 32 << 20     # their bytes
GROUP_CHARS = 2 << 20      # bytes of text encoded together
BATCH_BYTES = 4 << 20      # bytes of new words that share one pair index


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ranks of the merges, ids and bytes of the tokens, and the special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}
        self.first = np.zeros(256, np.int64)
        for t, i in vocab.items():
            if len(t) == 1:
                self.first[alphabet[t]] = i
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.span = max(vocab.values()) + 1
        codes = np.array([a * self.span + b for a, b, _ in self.rules], np.int64)
        self.pair_ranks = np.argsort(codes, kind="stable")
        # a last entry that no pair has, so that every search ends at an entry
        self.pair_codes = np.append(codes[self.pair_ranks], np.iinfo(np.int64).max)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, names))) if names else None


def _ascending(x: np.ndarray) -> np.ndarray:
    """The distinct values in order."""
    if len(x) < 2:
        return x
    x.sort()
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


class PairIndex:
    """Every pair of neighbouring tokens of many words, with all its positions.

    The words lie one after another in arrays, linked to their live neighbours. Ranks
    are applied in ascending order: the least active rank's pair is merged at all its
    positions, left to right, and the lists of the pairs that arise around them are
    extended. A position is checked when its pair is applied, so pairs that have vanished
    need no search. A rank's merges can only give rise to higher ranks (each token has one
    merge that makes it), so no word sees its merges out of order.
    """

    def __init__(self, vocab: Vocabulary, words: list[bytes]):
        self.vocab = vocab
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        self.starts, n = ends - lengths, int(ends[-1]) if len(words) else 0
        self.ids = vocab.first[np.frombuffer(b"".join(words), np.uint8)]
        self.before, self.after = np.arange(-1, n - 1), np.arange(1, n + 1)
        full = lengths > 0
        self.before[self.starts[full]] = -1
        self.after[ends[full] - 1] = -1
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(np.flatnonzero(self.after >= 0))

    def _add(self, at: np.ndarray):
        """Enters the pairs that begin at the positions ``at``."""
        v = self.vocab
        code = self.ids[at] * v.span + self.ids[self.after[at]]
        slot = np.searchsorted(v.pair_codes, code)
        hit = v.pair_codes[slot] == code
        at, rank = at[hit], v.pair_ranks[slot[hit]]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts),
                           strict=True):
            if r not in self.places:
                self.places[r] = []
                heapq.heappush(self.active, r)
            self.places[r].append(part)

    def run(self) -> "PairIndex":
        ids, before, after = self.ids, self.before, self.after
        while self.active:
            rank = heapq.heappop(self.active)
            left, right, made = self.vocab.rules[rank]
            p = _ascending(np.concatenate(self.places.pop(rank)))
            q = after[p]
            live = (ids[p] == left) & (q >= 0) & (ids[q] == right)
            p, q = p[live], q[live]
            if left == right and len(p) > 1:  # in a run of one token every other pair
                fresh = np.concatenate([[True], q[:-1] != p[1:]])
                nth = np.arange(len(p))
                odd = (nth - np.maximum.accumulate(np.where(fresh, nth, 0))) % 2 == 1
                p, q = p[~odd], q[~odd]
            if not len(p):
                continue
            beyond = after[q]
            ids[p], ids[q] = made, -1
            after[p], after[q] = beyond, -1
            inner = beyond >= 0
            before[beyond[inner]] = p[inner]
            prev = before[p]
            self._add(_ascending(np.concatenate([p[inner], prev[prev >= 0]])))
        return self

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        kept = np.flatnonzero(self.ids >= 0)
        at = np.append(np.searchsorted(kept, self.starts), len(kept))
        return self.ids[kept].astype(np.uint32), np.diff(at)


class Encoder:
    """Encodes texts batch by batch; words met before in the task are looked up by number."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._forget()

    def _forget(self):
        self.number = defaultdict(count().__next__)
        # special strings have keys that no word of a text can equal
        own = list(self.vocab.special.values())
        for i in own:
            self.number[(i,)]
        self.flat = np.array(own, np.uint32)
        self.sizes = np.ones(len(own), np.int64)
        self.load = 0

    def _split(self, text: str) -> list:
        find = (WORDS if ABOVE.search(text) else WORDS_BELOW).findall
        cut = self.vocab.cut
        if cut is None or not cut.search(text):
            return find(text)
        parts, at = [], 0
        for m in cut.finditer(text):
            parts += find(text[at:m.start()])
            parts.append((self.vocab.special[m.group()],))
            at = m.end()
        return parts + find(text[at:])

    def _learn(self):
        """Encodes the words that have a number but no ids yet."""
        fresh = list(islice(self.number, len(self.sizes), None))
        flats, sizes = [self.flat], [self.sizes]
        todo, load = [], 0
        for w in fresh:
            todo.append(w.encode("utf-8", "surrogatepass"))
            load += len(todo[-1])
            self.load += len(todo[-1])
            if load > BATCH_BYTES or w is fresh[-1]:
                flat, size = PairIndex(self.vocab, todo).run().words()
                flats.append(flat)
                sizes.append(size)
                todo, load = [], 0
        self.flat, self.sizes = np.concatenate(flats), np.concatenate(sizes)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit integers."""
        if len(self.sizes) > CACHE_WORDS or self.load > CACHE_BYTES:
            self._forget()
        look = self.number.__getitem__
        numbers = [np.fromiter(map(look, w), np.int32, len(w)) for w in map(self._split, texts)]
        self._learn()
        starts = np.cumsum(self.sizes) - self.sizes
        out = []
        for n in numbers:
            size = self.sizes[n]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(n) else 0
            at = np.arange(total) + np.repeat(starts[n] - (ends - size), size)
            out.append(self.flat[at].tobytes())
        return out


def decode(vocab: Vocabulary, packed: bytes) -> str:
    """Text of the ids; bytes that are no UTF-8 become the replacement character."""
    return b"".join(map(vocab.bytes_of.__getitem__, array("I", packed))).decode(
        "utf-8", "replace")


def text_groups(column: pa.Array, most: int = GROUP_CHARS):
    """``(offset, texts)``: the texts of a column (null: empty) in runs of about ``most`` bytes;
    a longer text is a run of its own. Only one run at a time is held as Python strings."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(column):
        done = int(ends[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield first, [t or "" for t in column.slice(first, stop - first).to_pylist()]
        first = stop


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def _little(packed: bytes) -> bytes:
    if sys.byteorder == "little":
        return packed
    a = array("I", packed)
    a.byteswap()
    return a.tobytes()


def _encode_batches(path, at, names, columns):
    """Each batch with ``columns(vocab, texts, packed ids)`` behind its others, part by part."""
    def run(batches):
        vocab = vocabulary(path)
        enc = Encoder(vocab)
        for b in batches:
            for off, texts in text_groups(b.column(at)):
                kept, extra = columns(vocab, texts, enc.encode(texts))
                part = b.slice(off, len(texts))
                cols = [c for i, c in enumerate(part.columns) if kept or i != at]
                yield pa.RecordBatch.from_arrays([*cols, *extra], names)
    return run


def _digest_columns(vocab, texts, packed):
    return False, [
        pa.array([len(p) // 4 for p in packed], pa.int64()),
        pa.array([hashlib.sha256(_little(p)).hexdigest() for p in packed], pa.string()),
        pa.array([hashlib.sha256(decode(vocab, p).encode()).hexdigest() for p in packed],
                 pa.string())]


def _id_columns(vocab, texts, packed):
    """The ids as one list column over the packed bytes: no Python integers. All are decoded
    again; one text that they do not give raises an error."""
    for t, p in zip(texts, packed, strict=True):
        if decode(vocab, p) != t:
            raise ValueError(f"token ids do not decode to their text: {t[:80]!r}")
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
    flat = np.frombuffer(b"".join(packed), np.int32)
    return True, [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row per document row: the
    whole text encoded, then decoded. Null and empty texts have no tokens. Strings of
    special tokens in a text get their ids. Repeated rows are encoded each; an empty table gives
    no rows; other columns are ignored. A text of any length is encoded whole; memory grows with
    its longest word (letters, numbers or blanks without a break): about 50 bytes for each
    of that word's bytes. ``path`` names the vocabulary on every node."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _encode_batches(path, 1, names, _digest_columns),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """``docs`` with one more column: the ids of the whole text (empty for null). The ids of every
    row are decoded again where they are made; a row whose ids do not give its text raises an
    error. Repeated rows and other columns stay; an empty table stays empty; very long texts are
    encoded whole, as :func:`encode_digests` says."""
    flat, name = positional(docs)
    at = flat.columns.index(name["text"])
    schema = T.StructType([*flat.schema, T.StructField("_ids", T.ArrayType(T.IntegerType()))])
    out = flat.mapInArrow(_encode_batches(path, at, [*flat.columns, "_ids"], _id_columns), schema)
    while column in docs.columns:
        column += "_"
    return out.toDF(*docs.columns, column)


def _decode_batches(path, at, names):
    def run(batches):
        vocab = vocabulary(path)
        for b in batches:
            col = b.column(at)
            ids = col.values.fill_null(-1).to_numpy().astype(np.uint32)
            texts = [decode(vocab, ids[s:e].tobytes()) if known else None
                     for s, e, known in zip(col.offsets[:-1].to_pylist(),
                                            col.offsets[1:].to_pylist(),
                                            col.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names)
    return run


def decode_documents(docs: DataFrame, path: str, ids: str = "token_ids",
                     column: str = "decoded_text") -> DataFrame:
    """``docs`` with one more column: the text of the token ids in the column ``ids`` (null for
    null; an id that the vocabulary lacks raises an error)."""
    flat, name = positional(docs)
    schema = T.StructType([*flat.schema, T.StructField("_text", T.StringType())])
    out = flat.mapInArrow(_decode_batches(path, flat.columns.index(name[ids]),
                                          [*flat.columns, "_text"]), schema)
    while column in docs.columns:
        column += "_"
    return out.toDF(*docs.columns, column)


def verified(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode_documents``, read again from where they were kept; one whose last
    column does not decode to its text (the empty one for null) raises an error."""
    flat, name = positional(decode_documents(encoded, path, encoded.columns[-1]))
    same = F.col(flat.columns[-1]) == F.coalesce(F.col(name["text"]), F.lit(""))
    return flat.where(F.when(same, True).otherwise(F.raise_error(F.lit(
        "token ids do not decode to their text")).cast("boolean"))).select(
        *flat.columns[:-1]).toDF(*encoded.columns)
