"""Best-fit packing (operator 1): sum-of-squares placement of tokenised documents into fixed-length sequences.

A document becomes the ids of its text followed by one end id. Only documents longer than the capacity are cut,
into full pieces and a shorter last one. Pieces are placed by the sum-of-squares rule: of all open sequences and
a new one, choose the place after which the sum over residual gaps g of N(g)^2 is smallest, N(g) being the number
of open sequences with gap g (full ones do not count); ties go to the smallest gap.

Work is dealt to shards of a fixed expected number of pieces (one task packs one shard, whatever the input size),
then the sequences that a shard could not fill well are taken apart and packed again in coarser shards.

Defined results: a null text is an empty one (its single piece is the end id); an empty table gives no pieces; equal
rows are packed as separate documents; extra input columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm.common import Scratch, arrow_batches, by_value, release_memory, tidy, worker_state

by_value(__name__)

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 4096
#: A sequence is packed again in the second round when more than this share of it is empty.
LOOSE = 1 / 64
#: Shards of the first round that one shard of the second round gathers from.
MERGE = 64
#: Cached pre-tokens per worker; when full, what is not cached is computed each time.
PIECE_CACHE = 150_000
#: Bytes of text that a worker encodes at once (a longer text comes alone), and words that it takes from them at once.
TEXT_BYTES = 4 << 20
WORDS_AT_ONCE = 1 << 16

# Pre-tokens of a lower-case word of Latin-1 characters: what the tokenizer's own split pattern gives there.
LATIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
#: Characters that Python's str.split() takes for white space and the tokenizer does not.
UNLIKE_SPACE = re.compile("[\x1c-\x1f]")


class WordEncoder:
    """Ids of white-space separated words as little-endian uint32 bytes; pre-tokens are cached per worker.

    The tokenizer's normaliser and split never look across white space, so the ids of a text are the ids of its
    words in turn. Words of Latin-1 characters are lowered and split here and only their pre-tokens go through the
    tokenizer's model; every other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.pieces: dict[str, bytes] = {}
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        self.byte_chars = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def piece(self, text: str) -> bytes:
        got = self.pieces.get(text)
        if got is None:
            shown = text if text.isascii() and text.isprintable() else "".join([self.byte_chars[b] for b in text.encode()])
            got = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(self.pieces) < PIECE_CACHE:
                self.pieces[text] = got
        return got

    def word(self, word: str) -> bytes:
        lower = word.lower()
        if lower.isascii() and lower.isalpha():
            return self.pieces.get(lower) or self.piece(lower)
        if max(word) <= "\xff" and "<|" not in word:
            return b"".join(map(self.piece, LATIN_SPLIT.findall(lower)))
        return array("I", self.whole.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if UNLIKE_SPACE.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.word, text.split()))

    def encode_many(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and where each text begins in them.

        Arrow splits the texts and numbers their distinct words; each distinct word is looked up once. Words are taken
        from Arrow, and ids gathered, so many at a time: beside the ids only a few numbers a word are held.
        """
        odd = pc.fill_null(pc.match_substring_regex(column, UNLIKE_SPACE.pattern), False)
        any_odd = pc.any(odd).as_py()
        plain = pc.fill_null(column, "")
        words = pc.utf8_split_whitespace(pc.if_else(odd, "", plain) if any_odd else plain)
        begins = words.offsets.to_numpy()
        words = words.flatten().dictionary_encode()
        end, get = len(words.dictionary), self.pieces.get
        parts, sizes = [], []
        for k in range(0, end, WORDS_AT_ONCE):
            found = [get(w) or self.word(w) if w else b"" for w in words.dictionary.slice(k, WORDS_AT_ONCE).to_pylist()]
            parts.append(b"".join(found))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        flat = np.frombuffer(b"".join([*parts, np.uint32(end_id).tobytes()]), "<u4")
        size_of = np.concatenate([*sizes, [1]])
        start_of = np.cumsum(size_of) - size_of
        # the words of each text in turn, its end id after them
        codes = np.insert(words.indices.to_numpy(), begins[1:] - begins[0], end)
        del words, plain, parts
        stops = np.cumsum(size_of[codes])
        bounds = np.concatenate([[0], stops[codes == end]])
        ids = np.empty(bounds[-1], "<u4")
        for k in range(0, len(codes), WORDS_AT_ONCE):
            part, upto = codes[k:k + WORDS_AT_ONCE], stops[k:k + WORDS_AT_ONCE]
            size = size_of[part]
            first = upto[0] - size[0]
            ids[first:upto[-1]] = flat[np.repeat(start_of[part] - (upto - size), size) + np.arange(first, upto[-1])]
        if any_odd:
            each = [ids[bounds[k]:bounds[k + 1]] for k in range(len(column))]
            for k in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
                each[k] = np.frombuffer(self.encode(column[k].as_py()) + np.uint32(end_id).tobytes(), "<u4")
            ids, bounds = np.concatenate(each), np.cumsum([0, *map(len, each)])
        return ids, bounds


def slices(batch: pa.RecordBatch, text_at: int, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts take about so many bytes (a longer text comes alone)."""
    size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // most_bytes
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges], [*edges, len(size)], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document: id, piece, start, length, ids_crc32 and, on request, token_ids."""
    id_type = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def pieces_of(encoder: WordEncoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = encoder.encode_many(batch.column(1), end_id)
        sizes = np.diff(bounds)
        n_pieces = -(-sizes // capacity)
        row = np.repeat(np.arange(len(sizes)), n_pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = piece * capacity
        length = np.minimum(capacity, sizes[row] - start)
        at, raw = (bounds[row] + start) * 4, memoryview(flat).cast("B")
        crc = [zlib.crc32(raw[a:a + 4 * n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
        out = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
               pa.array(length), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:  # pieces lie one after the other in the flat ids
            cuts = pa.array(np.concatenate([at // 4, [len(flat)]]).astype(np.int32))
            out.append(pa.ListArray.from_arrays(cuts, pa.array(flat.astype(np.int32))))
            names.append("token_ids")
        return pa.RecordBatch.from_arrays(out, names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"encoder_{abs(hash(tokenizer_path))}", lambda: WordEncoder(tokenizer_path))
        for batch in (part for whole in batches for part in slices(whole, 1, TEXT_BYTES)):
            yield pieces_of(encoder, batch)
            release_memory()

    more = ", token_ids array<int>" if with_ids else ""
    return source.mapInArrow(
        tidy(cut), f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long{more}")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed longest first by the sum-of-squares rule."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, np.int64)  # counts[0] stays 0: full sequences are not part of the sum
    started = 0
    for item in order:
        size = int(lengths[item])
        # change of the sum when a sequence of gap g = size + r takes the piece: it leaves g and joins r
        joins = 2 * counts[:capacity + 1 - size] + 1
        joins[0] = 0
        have = counts[size:]
        change = np.where(have > 0, joins + 1 - 2 * have, np.iinfo(np.int64).max)
        best = int(np.argmin(change))
        fresh = int(joins[capacity - size])
        if change[best] <= fresh:
            gap = size + best
            chosen = open_by_gap[gap].pop()
            counts[gap] -= 1
        else:
            gap, chosen = capacity, started
            started += 1
        sequence[item], offset[item] = chosen, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            open_by_gap[gap - size].append(chosen)
    return sequence, offset


def _pack_shards(pieces: DataFrame, n_shards: int, capacity: int, loose: float, salt: int) -> DataFrame:
    """One packing per shard; ``filled`` tells how much of the piece's sequence is in use."""
    names = [f.name for f in pieces.schema.fields]
    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(salt)), F.lit(n_shards))
    id_type = pieces.schema["doc_id"].dataType
    # ids travel as text: pandas turns a column of integers with a null into floats
    dealt = pieces.withColumn("_shard", shard).withColumn("doc_id", F.col("doc_id").cast("string"))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece", "ids_crc32"], ignore_index=True)
        lengths = part["length"].to_numpy(np.int64)
        sequence, offset = sum_of_squares(lengths, capacity)
        filled = np.bincount(sequence, weights=lengths)[sequence].astype(np.int64)
        return part[names].assign(sequence_id=sequence * n_shards + int(key[0]), offset=offset,
                                  loose=filled < capacity * (1 - loose))

    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'doc_id' else f.dataType.simpleString()}" for f in pieces.schema.fields)
    packed = dealt.groupBy("_shard").applyInPandas(pack, f"{schema}, sequence_id long, offset long, loose boolean")
    return packed.withColumn("doc_id", F.col("doc_id").cast(id_type))


def pack_pieces(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY,
                shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Places of all pieces: the input columns, sequence_id and offset.

    Even numbers name sequences of the first round, odd ones those of the second.
    """
    scratch = Scratch(spark, "packing")
    with arrow_batches(spark, TEXT_BYTES):
        pieces = scratch.write(pieces, "pieces")
    n_shards = max(1, math.ceil(pieces.count() / shard_pieces))
    if n_shards == 1:
        return _pack_shards(pieces, 1, capacity, 0, 0).withColumn("sequence_id", F.col("sequence_id") * 2).drop("loose")
    first = scratch.write(_pack_shards(pieces, n_shards, capacity, LOOSE, 0), "first")
    scratch.drop("pieces")
    kept = first.where(~F.col("loose")).withColumn("sequence_id", F.col("sequence_id") * 2)
    again = first.where("loose").drop("sequence_id", "offset", "loose")
    second = _pack_shards(again, max(1, math.ceil(n_shards / MERGE)), capacity, 0, 1)
    return kept.unionByName(second.withColumn("sequence_id", F.col("sequence_id") * 2 + 1)).drop("loose")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack documents; one row per piece."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)
    return pack_pieces(docs.sparkSession, pieces, capacity)
