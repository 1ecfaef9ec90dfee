"""Token ids of a corpus in binary files, ids packed by Simple-8b.

Texts are sorted by ``doc_id`` over range partitions and encoded where they land. A block holds whole documents, about
``BLOCK_IDS`` ids, and is one binary value:

    b"S8B1", then little-endian unsigned 32-bit: documents, ids, distinct ids, words, escapes;
    doc_id of each document (64 bit); where each document ends in the block (32 bit);
    the distinct ids, most frequent first (32 bit); the words; the escapes (64 bit).

The words hold each id's place in that list, so frequent ids take few bits. Spark writes the blocks as rows of
Parquet with their partition and number, through its commit protocol: a task lost half-way leaves nothing, and any file
system Spark knows will do. Partition and number order the blocks; a block can be read without its neighbours.

An id costs most where its word is new: texts are cut at single spaces and line ends between other signs, where a
byte-level pre-tokeniser cuts as well, and a worker remembers frequent words. It also cuts between a run of letters or of
digits and the punctuation behind it, so a new word that is no more than that goes to the tokenizer's model at once and
is known with any punctuation. Other words go through the whole tokenizer; other texts are encoded whole. That a text is
such a one shows when a piece of it is met for the first time, so known pieces are not looked at again. Arrow cuts some
``SLICE`` bytes of texts at a time and numbers their different pieces; only those are looked up, once each.

Defined cases: a null or empty text holds the end id alone; rows with one ``doc_id`` are ordered by their text; a
null ``doc_id`` comes first and is stored with a flag; other columns are not read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from pathlib import Path
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.llm import simple8b
from finloom.llm.common import table, text_of, work_folder

BLOCK_IDS = 1 << 18
END_ID = 0
REMEMBERED = 500_000  # words in each of the two generations that a worker keeps
SLICE = 1 << 22  # bytes of texts cut at a time, or one text
LONGEST = 64  # signs of a word that is kept: a generation so has at most about 100 MB
MAGIC = b"S8B1"
HEAD = struct.Struct("<4s5I")
NO_ID = np.int64(-(1 << 63))
LOOSE = re.compile(r"\s\s|^\s|\s\Z")
# Signs that have been letters in every version of Unicode that has them, or digits, then ASCII punctuation.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ɏЀ-ҁぁ-ゖァ-ヺ一-鿌가-힣]+|[0-9]+)([!-/:-@\\[-`{-~]*)")
PACKS = [struct.Struct(f"<{n}I").pack for n in range(2 * LONGEST)]
ENCODERS: dict[int, Encoder] = {}  # per worker process


def byte_signs() -> dict[int, str]:
    """The sign that stands for a byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + at) for at, byte in enumerate(hidden)}


BYTE_SIGNS = byte_signs()


def loose(text: str) -> bool:
    """Whether white space stands at an end or beside other white space."""
    words, cuts = text.split(), text.count(" ") + text.count("\n")
    # As many single cuts as words ask for and no other white space: the usual case, told without a search.
    usual = len(words) == cuts + 1 and sum(map(len, words)) + cuts == len(text)
    return not usual and LOOSE.search(text) is not None


class Loose(Exception):
    """A piece that stands beside white space, so that the text can't be cut there."""


def packed(ids: list[int]) -> bytes:
    return PACKS[len(ids)](*ids) if len(ids) < len(PACKS) else struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Text piece -> its ids as bytes, filled on demand.

    When a generation is full it becomes the old one, and what is met again moves on into the next. Frequent words so
    stay, and what was met once is forgotten. ``plain`` says that the tokenizer cuts as byte-level ones do.
    """

    def __init__(self, tokenizer, before: str, plain: bool):
        super().__init__()
        self.tokenizer, self.before, self.plain, self.old, self.ends = tokenizer, before, plain, {}, {}
        self.model, self.mark = tokenizer.model, self.signs(before)

    @staticmethod
    def signs(piece: str) -> str:
        return "".join(map(BYTE_SIGNS.__getitem__, piece.encode()))

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self.encoded(piece)
        return self.kept(piece, found)

    def kept(self, piece: str, found: bytes) -> bytes:
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found

    def encoded(self, piece: str) -> bytes:
        plain = PLAIN.fullmatch(piece) if self.plain else None
        if plain is None:
            if not piece or loose(piece):
                raise Loose
            return packed(self.tokenizer.encode(self.before + piece, add_special_tokens=False).ids)
        word, end = plain.groups()
        if not end:
            return self.word_ids(word)
        found = self.get(word) or self.old.get(word) or self.word_ids(word)
        return self.kept(word, found) + (self.ends.get(end) or self.end_ids(end))

    def end_ids(self, end: str) -> bytes:
        found = self.model_ids(end)
        if len(end) <= 2:  # a thousand or so
            self.ends[end] = found
        return found

    def word_ids(self, word: str) -> bytes:
        return self.model_ids(self.mark + (word if word.isascii() else self.signs(word)))

    def model_ids(self, signs: str) -> bytes:
        return packed([token.id for token in self.model.tokenize(signs)])


class Lines(Words):
    """As ``Words``, of pieces that follow a space or, with the line end before them, start a line."""

    def __init__(self, tokenizer, first: Words):
        super().__init__(tokenizer, " ", first.plain)
        self.first = first
        self.line_end = packed(tokenizer.encode("\n", add_special_tokens=False).ids)

    def encoded(self, piece: str) -> bytes:
        return self.line_end + self.first[piece[1:]] if piece[:1] == "\n" else super().encoded(piece)


class Encoder:
    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # Only byte-level tokenisers without a normaliser are known to cut at these places.
        self.cuts = (self.tokenizer.normalizer is None
                     and type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
                     and not self.tokenizer.pre_tokenizer.add_prefix_space)
        plain = self.cuts and self.tokenizer.pre_tokenizer.use_regex and type(self.tokenizer.model).__name__ == "BPE"
        self.first = Words(self.tokenizer, "", plain)
        self.spaced = Lines(self.tokenizer, self.first)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each of some texts."""
        if not self.cuts:
            return [self.whole(text) for text in texts.to_pylist()]
        marked = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        pieces = pc.split_pattern(marked, " ")
        numbered = pieces.flatten().dictionary_encode()
        known, beside = [], np.zeros(len(numbered.dictionary), bool)
        for at, piece in enumerate(numbered.dictionary.to_numpy(zero_copy_only=False)):
            try:
                known.append(self.spaced[piece])
            except Loose:
                known.append(b"")
                beside[at] = True
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, known), np.int64, len(known)) // 4)])
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.frombuffer(b"".join(known), "<u4")))
        taken = lists.take(numbered.indices)
        first = pieces.offsets.to_numpy()  # of each text among all pieces
        at = taken.offsets.to_numpy()[first].tolist()
        flat, skipped = taken.values.to_numpy(), len(self.spaced.line_end) // 4  # the mark before each text
        out = [flat[a + skipped:b] for a, b in zip(at, at[1:], strict=False)]
        odd = np.concatenate([[0], np.cumsum(beside[numbered.indices.to_numpy()])])[first]
        odd = odd[1:] > odd[:-1]
        for token in self.special:
            odd = odd | pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        for text in np.flatnonzero(odd).tolist():
            out[text] = self.whole(texts[text].as_py())
        return out


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in runs of about ``SLICE`` bytes."""
    run = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield texts.slice(a, b - a)


def encoder_of(definition: str) -> Encoder:
    key = crc32(definition.encode())
    if key not in ENCODERS:
        ENCODERS[key] = Encoder(definition)
    return ENCODERS[key]


def write_block(doc_ids: list, ids: list[np.ndarray]) -> bytes:
    """One block of whole documents."""
    flat = np.concatenate(ids)
    if len(flat) and int(flat.max()) < 1 << 20:
        counts = np.bincount(flat)
        distinct = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]
        ranks = np.zeros(len(counts), np.uint64)
        ranks[distinct] = np.arange(len(distinct), dtype=np.uint64)
        coded = ranks[flat]
    else:
        distinct, coded = np.unique(flat, return_inverse=True)
    words, escapes = simple8b.encode(coded)
    keys = np.array([NO_ID if d is None or d is pd.NA else d for d in doc_ids], "<i8")
    return b"".join([
        HEAD.pack(MAGIC, len(keys), len(flat), len(distinct), len(words), len(escapes)), keys.tobytes(),
        np.cumsum([len(i) for i in ids]).astype("<u4").tobytes(), distinct.astype("<u4").tobytes(),
        words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


def read_block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, where each document ends, and all ids of a block."""
    magic, docs, size, distinct, words, escapes = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of packed ids")
    at, parts = HEAD.size, []
    for kind, n in (("<i8", docs), ("<u4", docs), ("<u4", distinct), ("<u8", words), ("<u8", escapes)):
        parts.append(np.frombuffer(data, kind, n, at))
        at += parts[-1].nbytes
    keys, ends, known, packed, escaped = parts
    return keys, ends, known[simple8b.decode(packed, escaped, size).astype(np.int64)]


def write_ids(docs: DataFrame, path: str, definition: str, end_id: int = END_ID) -> None:
    """Writes the ids of all texts to ``path`` in ascending order of ``doc_id``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)  # the vocabulary file, a few MB

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(shared.value), TaskContext.get().partitionId()
        number, size, keys, ids = 0, 0, [], []

        def block():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                "n_ids": pa.array([size], pa.int64()), "block": pa.array([write_block(keys, ids)], pa.binary())})

        for batch in batches:
            keyed = zip(batch.column("doc_id").to_numpy(), batch.column("missing").to_pylist(), strict=True)
            encoded = (own for texts in slices(batch.column("text")) for own in encoder.ids(texts))
            for (doc_id, missing), own in zip(keyed, encoded, strict=True):
                keys.append(None if missing else doc_id)
                ids.append(np.append(own, np.uint32(end_id)))
                size += len(ids[-1])
                if size >= BLOCK_IDS:
                    yield block()
                    number, size, keys, ids = number + 1, 0, [], []
        if keys:
            yield block()

    key = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(key, F.lit(0)).alias("doc_id"), key.isNull().alias("missing"),
                       text_of().alias("text"))
    order = [F.desc("missing"), "doc_id"]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
     .mapInArrow(pack, "part int, number int, n_ids long, block binary")
     .write.option("compression", "zstd").parquet(path))


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of the files: ``doc_id, start, n_tokens, ids_crc32`` and, where wanted, ``ids``."""
    blocks = spark.read.parquet(path)
    sizes = blocks.select("part", "number", "n_ids")
    # One row per block; within a partition its blocks are few, and there is one total per partition.
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    ahead = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("ahead"))
    starts = (sizes.withColumn("within", within).join(ahead, "part")
              .select("part", "number", (F.col("ahead") + F.col("within")).alias("begin")))

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, begin in zip(batch["block"], batch["begin"], strict=True):
                keys, ends, ids = read_block(data)
                first = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                each = [ids[a:b].astype("<u4") for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                rows = pd.DataFrame({
                    "doc_id": [None if key == NO_ID else int(key) for key in keys], "start": first + begin,
                    "n_tokens": ends.astype(np.int64) - first, "ids_crc32": [crc32(i.tobytes()) for i in each],
                }).astype({"doc_id": "Int64", "ids_crc32": "int64"})
                yield rows.assign(ids=each) if with_ids else rows

    # One small row per block goes to the blocks, which stay where they are read.
    placed = blocks.select("part", "number", "block").join(F.broadcast(starts), ["part", "number"])
    return placed.select("block", "begin").mapInPandas(
        unpack, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    definition = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    path = work_folder(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, definition)
    return read_ids(spark, path, with_ids=False)
