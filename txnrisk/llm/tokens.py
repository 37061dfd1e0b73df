"""Token-id files: Parquet with one list column of token ids per document, in ascending id order.

Ids are dictionary-encoded, the numeric columns delta-encoded (format version 2), row groups are
bounded and pages are short, with page indexes, so that a reader fetches only the columns, row
groups and pages of the documents or token ranges that it asks for."""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import new_path, read_table

END_ID = 2
#: bytes of pieces and ids that a worker remembers; when full, the later half goes (frequent pieces come early)
CACHE_BYTES = 160 << 20
#: bytes of an entry besides its piece and ids
ENTRY = 170
#: longer pieces are encoded each time
CACHE_PIECE = 128
#: bytes of text encoded into one Arrow batch
BATCH = 1 << 20
FILE_OPTIONS = {
    "compression": "zstd", "parquet.writer.version": "v2", "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10), "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "false", "parquet.enable.dictionary#ids.list.element": "true",
}
#: White_Space of Unicode, as the pre-tokenizer's pattern sees it
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: certain letters, and marks that no contraction starts with
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
MARK = "!\"#$%&()*+,\\-./:;<=>?@\\[\\]|"
#: cuts only where the pre-tokenizer cuts too: around runs of white space, and between a word and a mark
PIECE = re.compile(f"[{SPACE}]+(?![^{SPACE}])| ?[{LETTER}]+(?=[{SPACE}{MARK}]|\\Z)| ?[^{SPACE}]+|[{SPACE}]")
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c not in " \n" and re.match(f"[{SPACE}]", c)]
#: a word of certain letters may have marks after it: the pre-tokenizer cuts between the two
LETTERS, MARKS = re.compile(f"[{LETTER}]+"), MARK.replace("\\", "")
#: new words given to the library at a time
STEMS = 1 << 11

_tokenizers: dict = {}


def vocabulary_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


class Places(dict):
    """Ids by word.  A word without ids gives an empty place, the same one each time, until :meth:`fill`."""

    def __init__(self):
        self.open: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytearray:
        return self.open.setdefault(word, bytearray())

    def fill(self, encode, keep=None) -> None:
        if self.open:
            found = encode(list(self.open))
            for word, place in self.open.items():
                place += found[word]
            self.open.clear()
            if keep:
                keep(self, found)


class PieceEncoder:
    """The tokenizer with a cache of encoded pieces.  White space always starts a new token, and so
    does an added token (such as <|endoftext|>), so the ids of a text are the ids of its pieces one
    after the other; each distinct piece is encoded once.  Ids are kept as little-endian unsigned
    32-bit bytes.

    Where its only white space is blanks and line ends that do not meet (two line ends may), a text
    falls into lines and these into words: a line end is one token, and a blank begins the token of
    the word after it.  Other texts are cut by PIECE."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added_texts = added
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.pieces: dict[str, bytes] = {}
        self.words = Places()                      # ids of a blank and the word
        self.held, self.limit = 0, cache_bytes
        self.heads = Places()                      # ids of the first word of a line
        self.line_end = self.encode(["\n"])[0]
        #: the tokens that begin with a blank
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True

    def encode(self, pieces: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        raw = np.fromiter(itertools.chain.from_iterable(ids), "<u4").tobytes()
        ends = list(itertools.accumulate(4 * len(x) for x in ids))
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def encode_stems(self, stems: list[str]) -> dict[str, bytes]:
        """The ids of a blank and each word of letters, many words to a call: each begins with the only
        one of its tokens that begins with a blank."""
        found = {}
        for lo in range(0, len(stems), STEMS):
            some = stems[lo:lo + STEMS]
            texts = [" " + " ".join(some[i:i + 64]) for i in range(0, len(some), 64)]
            ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)), "<u4")
            ends = (4 * np.append(np.flatnonzero(self.opens[ids]), len(ids))).tolist()
            raw = ids.tobytes()
            found.update(zip(some, [raw[a:b] for a, b in zip(ends, ends[1:])]))
        return found

    def keep(self, cache: dict, found: dict[str, bytes]) -> None:
        short = {p: x for p, x in found.items() if len(p) <= CACHE_PIECE}
        cache.update(short)
        self.held += sum(map(len, short)) + sum(map(len, short.values())) + ENTRY * len(short)
        if self.held > self.limit:
            for c in (self.words, self.pieces, self.heads):
                for piece in list(c)[len(c) // 2:]:
                    self.held -= len(piece) + len(c.pop(piece)) + ENTRY

    def cut(self, text: str) -> list[str]:
        if self.added is None or not self.added.search(text):
            return PIECE.findall(text)
        out = []
        for i, x in enumerate(self.added.split(text)):      # added tokens at odd places
            out += [x] if i % 2 else PIECE.findall(x)
        return out

    def encode_pieces(self, cuts: list[list[str]]) -> list[bytes]:
        """The ids of each list of pieces; those that none had before are encoded together."""
        known = self.pieces
        new = list({p for pieces in cuts for p in pieces if p not in known})
        found = dict(zip(new, self.encode(new))) if new else {}
        out = [b"".join([known.get(p) or found[p] for p in pieces]) for pieces in cuts]
        self.keep(known, found)
        return out

    def encode_words(self, new: list[str]) -> dict[str, bytes]:
        """The ids of new words and the blank before each.  Of letters and the marks after them, both are
        encoded once."""
        plain, other, known = {}, [], self.words
        for w in new:
            stem = w.rstrip(MARKS)
            if stem.isascii() and stem.isalpha() or LETTERS.fullmatch(stem):
                plain[w] = stem
            else:
                other.append(w)
        found = self.encode_stems(list({stem for stem in plain.values() if stem not in known}))
        marks = list({w[len(stem):] for w, stem in plain.items()})
        after = dict(zip(marks, self.encode_pieces([[mark] if mark else [] for mark in marks])))
        found |= {w: (known.get(stem) or found[stem]) + after[w[len(stem):]] for w, stem in plain.items()}
        found.update(zip(other, self.encode_pieces([PIECE.findall(" " + w) for w in other])))
        self.keep(known, found)
        return found

    def odd(self, text: str) -> bool:
        """Whether lines and words do not give the text's tokens."""
        return ("  " in text or " \n" in text or "\n " in text or "\n\n\n" in text or text.endswith("\n\n")
                or any(map(text.__contains__, OTHER_SPACE)) or any(map(text.__contains__, self.added_texts)))

    def __call__(self, text: str) -> bytes:
        """The ids of a text."""
        return self.encode_texts([text])[0]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text.  Every word is looked up once; new ones get a place that is filled when
        all texts are read, so they are encoded together."""
        out, ids, first, line_end = [], self.words.__getitem__, self.heads.__getitem__, [self.line_end]
        for text in texts:
            if self.odd(text):
                out.append(self.encode_pieces([self.cut(text)]))
                continue
            found = []
            for line in text.split("\n"):
                words = iter(line.split(" "))
                found += line_end
                found.append(first(next(words)))
                found += map(ids, words)
            out.append(found[1:])
        self.heads.fill(lambda new: dict(zip(new, self.encode_pieces([PIECE.findall(head) for head in new]))), self.keep)
        self.words.fill(self.encode_words)
        return list(map(b"".join, out))


def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker, kept between its tasks."""
    if path not in _tokenizers:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[path] = PieceEncoder(path)
    return _tokenizers[path]


TOKEN_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode (doc_id, text) and write ``path``/ids (documents in ascending doc_id order over the
    files) and ``path``/parts (ids before each file).  A null text counts as empty and has the end
    id alone; documents with equal ids follow each other, by text hash; null ids come first; an
    empty table gives empty files."""
    spark = docs.sparkSession
    ranged = (docs.select("doc_id", "text").repartitionByRange("doc_id")
              .sortWithinPartitions("doc_id", F.xxhash64("text")).withColumn("part", F.spark_partition_id()))

    def encode(batches):
        enc, end, before = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes(), 0
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(texts)]):
                blobs = [x + end for x in enc.encode_texts(pc.fill_null(texts.slice(lo, hi - lo), "").to_pylist())]
                n = np.array([len(x) // 4 for x in blobs], np.int64)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()),
                    pa.array(np.frombuffer(b"".join(blobs), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array(before + ends - n), pa.array(n), lists],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"])
                before += int(ends[-1]) if len(ends) else 0

    ranged.mapInArrow(encode, TOKEN_SCHEMA).write.options(**FILE_OPTIONS).parquet(f"{path}/ids")
    totals = (spark.read.parquet(f"{path}/ids").groupBy("part").agg(F.sum("n_tokens").alias("n"))
              .orderBy("part").collect())               # one row per file
    offsets, acc = [], 0
    for r in totals:
        offsets.append((r["part"], acc))
        acc += r["n"]
    spark.createDataFrame(offsets, "part int, part_start long").coalesce(1).write.parquet(f"{path}/parts")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids); unread columns are pruned at the scan."""
    ids = spark.read.schema(TOKEN_SCHEMA).parquet(f"{path}/ids")
    parts = spark.read.schema("part int, part_start long").parquet(f"{path}/parts")
    return ids.join(F.broadcast(parts), "part").select(      # one row per file
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def read_token_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """The documents whose ids overlap positions [first, last) of the whole sequence.  The range is
    stated per file on ``local_start``, so other files, row groups and pages are skipped."""
    parts = spark.read.parquet(f"{path}/parts").orderBy("part").collect()
    spans = zip(parts, [p["part_start"] for p in parts[1:]] + [None])
    hit = [p for p, end in spans if p["part_start"] < last and (end is None or end > first)]
    ids = spark.read.schema(TOKEN_SCHEMA).parquet(f"{path}/ids")
    cond = F.lit(False)
    for p in hit:
        cond = cond | ((F.col("part") == p["part"]) & (F.col("local_start") < last - p["part_start"])
                       & (F.col("local_start") + F.col("n_tokens") > first - p["part_start"]))
    parts_df = spark.read.parquet(f"{path}/parts")
    return ids.where(cond).join(F.broadcast(parts_df), "part").select(
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``: unsigned CRC-32 of the ids as little-endian 32-bit integers."""
    def crc(batches):
        for b in batches:
            lists = b.column(3)
            raw = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))
            at = lists.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([zlib.crc32(raw[i:j]) for i, j in zip(at[:-1], at[1:])], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_token_files(read_table(spark, sf_dir, "documents"), path, vocabulary_path())
    return with_crc32(read_token_files(spark, path))
