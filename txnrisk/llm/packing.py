"""Cost-balanced packing of documents into training sequences.

A piece of n tokens is taken to cost ``LINEAR * n + QUADRATIC * n * n`` (the matrix products of its
tokens, and the attention among them).  Each task packs its own rows, a group of bounded size at a
time: whole sequences are cut from long documents, the rests are dealt in descending order of cost,
each to the sequence of the lowest cost that still holds it.  Where none holds it whole, it is cut
and fills the open sequence of the lowest cost first.  The sequences of a group hold exactly its
tokens: full ones, and powers of two for the last few, so nothing is padded.

No row is shuffled: the work is split as the scan splits it, and a lost task is done again alike."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

END_ID = 1
CAPACITY = 2048
#: tokens after which a task packs what it holds (1,024 full sequences)
GROUP_TOKENS = 1 << 21
#: cost of a token by itself, and with each token of its piece: a layer of width d spends about 24 d * d
#: operations on a token and 4 d on a pair, so with d = 1,024 a pair costs 1/6,144 of a token
LINEAR, QUADRATIC = 1.0, 1 / 6144
#: bytes of words and ids that a worker remembers; when full, the later half goes
CACHE_BYTES = 224 << 20
#: bytes of an entry besides its word and ids
ENTRY = 170
#: longer words are encoded each time
CACHE_WORD = 128
#: characters of a text that are split into words at a time
SLICE = 1 << 20
#: bytes of ids in one Arrow batch
BATCH = 4 << 20
#: White_Space of Unicode
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = re.compile(f"[^{SPACE}]+")
GAP = re.compile(f"[{SPACE}]")
#: letters whose lower case is one composed letter, and marks that start neither a contraction nor an added token after letters
PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:;=>?@\\[-`{-~]*)")
#: what str.split() takes for white space besides
SEPARATORS = re.compile("[\x1c-\x1f]")

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

_encoders: dict = {}


def vocabulary_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


class WordEncoder:
    """A tokenizer that drops white space: the ids of a text are those of its words one after the
    other, and each distinct word is encoded once.  Of a new word of plain letters and closing marks,
    which the pre-tokenizer cuts between the two, the letters are encoded once in any case.  Ids are
    little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = None          # lower-case composed letters are normal, and one piece
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words: dict[str, bytes] = {}
        self.held, self.limit = 0, cache_bytes

    @staticmethod
    def encode(tokenizer, pieces: list[str]) -> list[bytes]:
        ids = tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        raw = np.array(ids.ids, "<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(np.array(ids.word_ids, np.int64), minlength=len(pieces)))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def keep(self, found: dict[str, bytes]) -> None:
        short = {p: x for p, x in found.items() if len(p) <= CACHE_WORD}
        self.words.update(short)
        self.held += sum(map(len, short)) + sum(map(len, short.values())) + ENTRY * len(short)
        if self.held > self.limit:
            for piece in list(self.words)[len(self.words) // 2:]:
                self.held -= len(piece) + len(self.words.pop(piece)) + ENTRY

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of new words; the short ones are remembered."""
        parts, other, known = [], [], self.words
        for w in words:
            m = PLAIN.fullmatch(w)
            if m:
                parts.append((w, m[1].lower(), m[2]))
            else:
                other.append(w)
        stems = list({stem for _, stem, _ in parts if stem not in known})
        other += {mark for _, _, mark in parts if mark}
        found = dict(zip(stems, self.encode(self.plain, stems)))
        found.update(zip(other, self.encode(self.tokenizer, other)))
        for w, stem, mark in parts:
            ids = known.get(stem) or found[stem]
            found[w] = ids + found[mark] if mark else ids
        self.keep(found)
        return found

    def encode_words(self, words: list[str]) -> bytes:
        ids = list(map(self.words.get, words))
        if not all(ids):
            found = self.learn(list({w for w, x in zip(words, ids) if x is None}))
            ids = [found[w] if x is None else x for w, x in zip(words, ids)]
        return b"".join(ids)

    def __call__(self, text: str) -> bytes:
        split = WORD.findall if SEPARATORS.search(text) else str.split
        if len(text) <= SLICE:
            return self.encode_words(split(text))
        parts, lo = [], 0
        while lo < len(text):
            gap = GAP.search(text, lo + SLICE)
            hi = gap.start() if gap else len(text)
            parts.append(self.encode_words(split(text[lo:hi])))
            lo = hi
        return b"".join(parts)


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, kept between its tasks."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def capacities(tokens: int, capacity: int) -> np.ndarray:
    """Lengths of the sequences that hold exactly ``tokens``: full ones, then powers of two."""
    rest = tokens % capacity
    return np.array([capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1], np.int64)


def assign(lengths: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Deal pieces to sequences: (piece, start, length, sequence, offset).

    Pieces come in descending order of cost, equal ones in the given order.  Each goes to the
    sequence of the lowest cost (the first of equal ones) that has room for it; without one, the
    open sequence of the lowest cost takes what fits, and the rest is dealt on."""
    free = capacities(int(lengths.sum()), capacity)
    size = free.copy()
    cost = np.zeros(len(free))
    out = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[i])
        while left:
            s = int(np.where(free >= left, cost, np.inf).argmin())
            if free[s] < left:
                s = int(np.where(free > 0, cost, np.inf).argmin())
            n = min(left, int(free[s]))
            out.append((i, start, n, s, int(size[s] - free[s])))
            free[s] -= n
            cost[s] += linear * n + quadratic * n * n
            start, left = start + n, left - n
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
                   group_tokens: int = GROUP_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of every row of (doc_id,
    text), ``ids`` as little-endian unsigned 32-bit integers.

    A document is its token ids and ``end_id``; each id lies in exactly one piece.  A sequence holds
    ``capacity`` tokens or a power of two below it (``capacity`` need not be one itself); its pieces
    follow each other from offset 0.  A null or empty text is its end id alone.  Repeated rows,
    and rows of one doc_id (null too), are documents each; ties keep the order of the rows.  Other
    columns are not read, so their names may clash.  An empty table gives an empty result.
    ``sequence_id`` is unique over the table, and rises within a task's rows.

    Memory: a task holds the ids of a group and of its last document, 4 bytes a token.  Words are
    split a million characters at a time; one word is never cut, whatever its length."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part"))

    def pack(batches):
        enc, end, number = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes(), 0
        ready: list[tuple] = []          # finished pieces
        rests: list[tuple] = []          # (doc_id, start, doc_tokens, ids) below the capacity
        held = weight = 0

        def table(part: int) -> pa.RecordBatch:
            ids, start, n, total, seq, offset, raw = zip(*ready)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(total, pa.int64()),
                 pa.array([(part << 40) + s for s in seq], pa.int64()), pa.array(offset, pa.int64()), pa.array(raw, pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        def deal():
            nonlocal number, held
            if not rests:
                return
            lengths = np.array([len(r[3]) // 4 for r in rests], np.int64)
            for i, start, n, s, offset in assign(lengths, capacity, linear, quadratic):
                doc, first, total, raw = rests[i]
                ready.append((doc, first + start, n, total, number + s, offset, raw[4 * start:4 * (start + n)]))
            number += len(capacities(int(lengths.sum()), capacity))
            rests.clear()
            held = 0

        part = 0
        for b in batches:
            part = b.column(2)[0].as_py() if b.num_rows else part
            for lo in range(0, b.num_rows, 256):
                texts = b.column(1).slice(lo, 256).to_pylist()
                for doc, text in zip(b.column(0).slice(lo, 256).to_pylist(), texts):
                    raw = (enc(text) if text else b"") + end
                    total = len(raw) // 4
                    whole = total // capacity * capacity
                    for start in range(0, whole, capacity):
                        ready.append((doc, start, capacity, total, number, 0, raw[4 * start:4 * (start + capacity)]))
                        number += 1
                    weight += 4 * whole
                    if total > whole:
                        rests.append((doc, whole, total, raw[4 * whole:]))
                        held += total - whole
                    if held >= group_tokens:
                        weight += 4 * held
                        deal()
                    if weight >= BATCH:
                        yield table(part)
                        ready.clear()
                        weight = 0
        deal()
        if ready:
            yield table(part)

    return rows.mapInArrow(pack, PIECES)


def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(read_table(spark, sf_dir, "documents"), vocabulary_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
