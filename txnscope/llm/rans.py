"""Token-ID output by a static range asymmetric numeral system (rANS).

A token table (one row per document, packed ids) is written as a set of binary
shards in ascending document order. One frequency table, counted over all tokens
and scaled to 2**20, is shared by all shards. A shard is a run of independent
blocks; a block holds up to ``BLOCK_TOKENS`` ids dealt over ``LANES`` interleaved
coder states, so numpy advances all lanes of a step at once. The footer lists a
checkpoint per block (byte offset, first token, tokens, checksum) and the
documents, so any range of a shard can be decoded without its beginning and
shards decode in parallel.

Shard: ``RANS1`` | table crc32 u32 | blocks | footer (zlib) | footer length u32 | ``1SNAR``.
Block: tokens u32 | words u32 | crc32 of the ids u32 | crc32 of states and words u32
| states u64 x lanes | words u32.

Defined cases: a null text is empty; null document ids sort first; rows that share
an id follow each other in the order of their packed ids; an empty table gives no
shard and no row; other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import global_running_sum
from .common import (create_file, crc32_u32, open_file, pack_u16, read_table, shared_folder,
                     task_file, task_state, unpack_u16, written)

VOCABULARY = 1 << 16
PROB_BITS = 20
LOW = np.uint64(1 << 31)
LANES = 1024
BLOCK_TOKENS = 256 * LANES
TOKENS_PER_SHARD = 8_000_000
CACHED_WORDS = 400_000
ROWS_AT_ONCE = 500
MAGIC, CIGAM = b"RANS1", b"1SNAR"


# --- tokenising ---------------------------------------------------------------------------

def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 for itself, the others for 256, 257, ... in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordEncoder:
    """Encodes whole texts with a tokenizer file that drops white space and lower-cases.

    No piece of such a tokenizer crosses white space, so each distinct word is encoded
    once and then looked up. ASCII capitals are lowered and closing ASCII punctuation is
    split off (the tokenizer never joins letters and punctuation) where lower-case Latin
    letters remain: such a stem is one piece and goes straight to the tokenizer's model,
    and all its spellings share one entry. Any other word is encoded as it stands.
    Recently used entries stay known: when half of ``max_words`` were added, the other
    half is forgotten."""

    TAIL = ".,!?;:%$#&*|"
    LETTERS = "".join(c for c in map(chr, range(0x180)) if c.isalpha() and c.islower())

    def __init__(self, path: str, max_words: int = CACHED_WORDS):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.half = Tokenizer.from_file(path), max_words // 2
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _encode_whole(self, words: list[str]) -> None:
        for lo in range(0, len(words), 2000):
            part = words[lo:lo + 2000]
            coded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            for w, e in zip(part, coded):
                self.known[w] = array("H", e.ids).tobytes()

    def _encode_stems(self, stems: list[str]) -> None:
        known, tokenize, letter = self.known, self.model.tokenize, self.letters.__getitem__
        for w in stems:
            piece = w if w.isascii() else "".join(map(letter, w.encode()))
            known[w] = array("H", [t.id for t in tokenize(piece)]).tobytes()

    def _packed(self, words: pa.Array, encode) -> pa.Array:
        """The ids of each word, packed; ``encode`` adds those not yet known. Python sees
        each distinct word once."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known, old = self.known, self.old
        new = []
        for w in distinct:
            if w not in known:
                if w in old:
                    known[w] = old[w]
                else:
                    new.append(w)
        encode(new)
        found = pa.array(list(map(known.__getitem__, distinct)), pa.large_binary())
        return found.take(coded.indices)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ids[bounds[i]:bounds[i + 1]]. The split into words,
        stems and tails, their numbering and the assembly are Arrow kernels."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        low = pc.ascii_lower(words)
        stems = pc.ascii_rtrim(low, self.TAIL)
        plain = pc.match_substring_regex(stems, f"^[{self.LETTERS}]+$")
        stems = pc.if_else(plain, stems, pa.scalar("", words.type))
        rest = pc.if_else(plain, pc.utf8_ltrim(low, self.LETTERS), words)
        packed = pc.binary_join_element_wise(
            self._packed(stems, self._encode_stems), self._packed(rest, self._encode_whole),
            pa.scalar(b"", pa.large_binary())).take(coded.indices)
        if len(self.known) > self.half:
            self.old, self.known = self.known, {"": b""}
        _, ends, data = packed.buffers()
        stop = np.frombuffer(ends, "<i8", len(packed) + 1, 8 * packed.offset) // 2
        ids = np.frombuffer(data, "<u2", stop[-1]) if stop[-1] else np.zeros(0, "<u2")
        return ids, stop[split.offsets.to_numpy() - split.offsets[0].as_py()]


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids, counts): every whole text, the end id appended, ids packed;
    and a row per task with only ``counts``, how often each id occurred in it."""
    schema = "doc_id long, n_tokens long, ids binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = task_state(f"words {tokenizer_path}", lambda: WordEncoder(tokenizer_path))
        end, counts = np.array([end_id], "<u2"), np.zeros(VOCABULARY, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS_AT_ONCE):
                part = b.slice(lo, ROWS_AT_ONCE)
                ids, bounds = encoder.encode(pa.concat_arrays([part.column("text")]))
                counts += np.bincount(ids, minlength=VOCABULARY)
                counts[end_id] += part.num_rows
                each = [np.concatenate([ids[x:y], end]) for x, y in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) for x in each], pa.int64()),
                     pa.array([pack_u16(x) for x in each], pa.binary()),
                     pa.nulls(len(each), pa.binary())], ["doc_id", "n_tokens", "ids", "counts"])
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([counts.astype("<i8").tobytes()], pa.binary())],
                ["doc_id", "n_tokens", "ids", "counts"])
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(run, schema))


# --- frequency table ----------------------------------------------------------------------

def token_counts(tokens: DataFrame) -> np.ndarray:
    """Counts over all ids of a written ``tokenized`` table, from the rows its tasks left.
    The driver receives at most one row per vocabulary id (65,536)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(VOCABULARY, np.int64)
        for b in batches:
            for blob in b["counts"]:
                n += np.frombuffer(blob, "<i8")
        seen = np.flatnonzero(n)
        yield pd.DataFrame({"id": seen.astype(np.int32), "n": n[seen]})
    rows = (tokens.where("n_tokens IS NULL").select("counts").mapInPandas(run, "id int, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(VOCABULARY, np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def scaled_table(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**PROB_BITS, at least 1 for each seen id."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.uint32)
    seen = np.flatnonzero(counts)
    exact = counts[seen] * ((1 << PROB_BITS) / total)
    f = np.maximum(1, np.floor(exact)).astype(np.int64)
    short = (1 << PROB_BITS) - int(f.sum())
    if short > 0:      # give to the largest remainders, the rest to the most frequent
        order = np.argsort(f - exact, kind="stable")
        f[order[:short]] += 1
        f[np.argmax(f)] += (1 << PROB_BITS) - int(f.sum())
    while short < 0:   # take from the largest
        i = int(np.argmax(f))
        cut = min(-short, int(f[i]) // 2)
        f[i] -= cut
        short += cut
    out = np.zeros(len(counts), np.uint32)
    out[seen] = f
    return out


class Coder:
    def __init__(self, table: np.ndarray):
        self.freq = table.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.crc = zlib.crc32(table.astype("<u4").tobytes())
        self._symbols = None

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = min(LANES, n)
        steps = -(-n // lanes)
        x = np.full(lanes, LOW, np.uint64)
        out = []
        bits, word = np.uint64(PROB_BITS), np.uint64(32)
        f, c = self.freq[ids], self.cum[ids]
        limit = f << np.uint64(31 - PROB_BITS + 32)
        for s in range(steps - 1, -1, -1):
            lo, hi = s * lanes, min(n, (s + 1) * lanes)
            fs, live = f[lo:hi], x[:hi - lo]
            full = live >= limit[lo:hi]
            if full.any():
                out.append((live[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                live = np.where(full, live >> word, live)
            q = live // fs
            x[:hi - lo] = (q << bits) + (live - q * fs) + c[lo:hi]
        words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
        body = x.astype("<u8").tobytes() + words.astype("<u4").tobytes()
        return struct.pack("<IIII", n, len(words), crc32_u32(ids), zlib.crc32(body)) + body

    def decode(self, block: bytes) -> np.ndarray:
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=np.uint16),
                                      self.freq.astype(np.int64))
        n, n_words, id_crc, body_crc = struct.unpack_from("<IIII", block)
        lanes = min(LANES, n)
        size = 8 * lanes + 4 * n_words
        if zlib.crc32(block[16:16 + size]) != body_crc:
            raise ValueError("damaged block: its bytes do not match the checksum")
        x = np.frombuffer(block, "<u8", lanes, 16).astype(np.uint64)
        words = np.frombuffer(block, "<u4", n_words, 16 + 8 * lanes).astype(np.uint64)
        out = np.empty(n, np.uint16)
        mask, bits, word = np.uint64((1 << PROB_BITS) - 1), np.uint64(PROB_BITS), np.uint64(32)
        at = 0
        for lo in range(0, n, lanes):
            hi = min(n, lo + lanes)
            live = x[:hi - lo]
            slot = live & mask
            sym = self._symbols[slot]
            out[lo:hi] = sym
            live = self.freq[sym] * (live >> bits) + slot - self.cum[sym]
            low = np.flatnonzero(live < LOW)
            if len(low):
                live[low] = (live[low] << word) | words[at:at + len(low)]
                at += len(low)
            x[:hi - lo] = live
        if crc32_u32(out) != id_crc:
            raise ValueError("damaged block: its ids do not match the checksum")
        return out


# --- shards -------------------------------------------------------------------------------

class ShardWriter:
    def __init__(self, uri: str, coder: Coder):
        self.uri, self.coder, self.out = uri, coder, create_file(uri)
        self.out.write(MAGIC + struct.pack("<I", coder.crc))
        self.offset, self.tokens, self.held, self.n_held = len(MAGIC) + 4, 0, [], 0
        self.blocks, self.doc_ids, self.lengths = [], [], []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK_TOKENS:
            ids = np.concatenate(self.held)
            full = len(ids) // BLOCK_TOKENS * BLOCK_TOKENS
            for lo in range(0, full, BLOCK_TOKENS):
                self._block(ids[lo:lo + BLOCK_TOKENS])
            self.held, self.n_held = [ids[full:]], len(ids) - full

    def _block(self, ids: np.ndarray) -> None:
        data = self.coder.encode(ids)
        self.out.write(data)
        self.blocks.append((self.offset, self.tokens, len(ids), crc32_u32(ids)))
        self.offset += len(data)
        self.tokens += len(ids)

    def close(self) -> dict:
        if self.n_held:
            self._block(np.concatenate(self.held))
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        footer = zlib.compress(
            struct.pack("<II", len(self.blocks), len(self.doc_ids))
            + np.array([b[:2] for b in self.blocks], "<u8").tobytes()
            + np.array([b[2:] for b in self.blocks], "<u4").tobytes()
            + known.tobytes() + ids.tobytes() + np.array(self.lengths, "<u8").tobytes(), 1)
        self.out.write(footer + struct.pack("<I", len(footer)) + CIGAM)
        self.out.close()
        return {"path": self.uri, "n_docs": len(self.doc_ids), "n_tokens": self.tokens,
                "n_blocks": len(self.blocks)}


class ShardReader:
    def __init__(self, uri: str, coder: Coder):
        self.coder, self.file = coder, open_file(uri)
        size = self.file.size()
        tail = self.file.read_at(4 + len(CIGAM), size - 4 - len(CIGAM))
        head = self.file.read_at(len(MAGIC) + 4, 0)
        if tail[4:] != CIGAM or head[:len(MAGIC)] != MAGIC:
            raise ValueError(f"not a complete shard: {uri}")
        if struct.unpack("<I", head[len(MAGIC):])[0] != coder.crc:
            raise ValueError(f"shard {uri} was written with another frequency table")
        (length,) = struct.unpack("<I", tail[:4])
        self.end = size - 4 - len(CIGAM) - length
        f = zlib.decompress(self.file.read_at(length, self.end))
        n_blocks, n_docs = struct.unpack_from("<II", f)
        at = 8
        self.places = np.frombuffer(f, "<u8", 2 * n_blocks, at).reshape(-1, 2).astype(np.int64)
        at += 16 * n_blocks
        self.checks = np.frombuffer(f, "<u4", 2 * n_blocks, at).reshape(-1, 2).astype(np.int64)
        at += 8 * n_blocks
        self.known = np.frombuffer(f, np.uint8, n_docs, at).astype(bool)
        at += n_docs
        self.doc_ids = np.frombuffer(f, "<i8", n_docs, at)
        self.lengths = np.frombuffer(f, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)

    def block(self, i: int) -> np.ndarray:
        end = self.places[i + 1, 0] if i + 1 < len(self.places) else self.end
        ids = self.coder.decode(self.file.read_at(int(end - self.places[i, 0]),
                                                  int(self.places[i, 0])))
        if len(ids) != self.checks[i, 0] or crc32_u32(ids) != self.checks[i, 1]:
            raise ValueError("block does not match its checkpoint")
        return ids

    def tokens(self, start: int, count: int) -> np.ndarray:
        """Ids [start, start + count) of the shard, from the blocks that hold them."""
        if count <= 0:
            return np.zeros(0, np.uint16)
        first = int(np.searchsorted(self.places[:, 1], start, "right")) - 1
        last = int(np.searchsorted(self.places[:, 1], start + count, "left"))
        ids = np.concatenate([self.block(i) for i in range(first, last)])
        lo = start - int(self.places[first, 1])
        return ids[lo:lo + count]

    def documents(self) -> Iterator[tuple]:
        """(doc_id, start, n_tokens, crc32) of each document; one block is in memory."""
        block, at, base, start = np.zeros(0, np.uint16), 0, 0, 0
        for known, doc_id, n in zip(self.known, self.doc_ids, self.lengths):
            crc, left = 0, int(n)
            while left:
                if base == len(block):
                    block, at, base = self.block(at), at + 1, 0
                part = block[base:base + left]
                crc = crc32_u32(part, crc)
                base, left = base + len(part), left - len(part)
            yield (int(doc_id) if known else None), start, int(n), crc
            start += int(n)


def write_shards(tokens: DataFrame, folder: str, table: np.ndarray,
                 tokens_per_shard: int = TOKENS_PER_SHARD) -> DataFrame:
    """Write a written (doc_id, n_tokens, ids) table; returns the manifest, one row
    per shard in document order: shard, path, n_docs, n_tokens, n_blocks."""
    spark = tokens.sparkSession
    total = tokens.agg(F.sum("n_tokens")).collect()[0][0] or 0
    n = max(1, -(-total // tokens_per_shard))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        writer = None
        for b in batches:
            for doc_id, blob in zip(b["doc_id"], b["ids"]):
                if writer is None:
                    writer = ShardWriter(task_file(folder, ".rans"), Coder(table))
                writer.add(None if pd.isna(doc_id) else int(doc_id), unpack_u16(blob))
        if writer:
            yield pd.DataFrame([{"shard": TaskContext.get().partitionId()} | writer.close()])
    ordered = (tokens.repartitionByRange(int(n), F.asc_nulls_first("doc_id"))
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "ids"))
    return written(ordered.mapInPandas(
        run, "shard int, path string, n_docs long, n_tokens long, n_blocks long"), "rans-manifest")


def read_documents(spark: SparkSession, manifest: DataFrame, table: np.ndarray) -> DataFrame:
    """Decode the shards of a manifest in parallel: shard, doc_id, start, n_tokens,
    ids_crc32. The first token of each shard is a running sum over the manifest."""
    placed = global_running_sum(manifest, [F.col("shard")], "n_tokens", "upto")
    listed = placed.select("shard", "path", (F.col("upto") - F.col("n_tokens")).alias("first"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(table)
        for b in batches:
            for shard, path, first in zip(b["shard"], b["path"], b["first"]):
                rows = pd.DataFrame(ShardReader(path, coder).documents(),
                                    columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield rows.assign(doc_id=rows["doc_id"].astype("Int64"), shard=shard,
                                  start=rows["start"].astype("int64") + first)
    # one task per shard, as far as the scheduler can hold them
    tasks = max(1, min(manifest.count(), 100_000))
    listed = listed.repartitionByRange(tasks, "shard")
    return listed.mapInPandas(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2,
                     tokens_per_shard: int = TOKENS_PER_SHARD):
    """Tokenise, count, write. Returns (manifest, frequency table)."""
    tokens = written(tokenized(docs, tokenizer_path, end_id), "tokens")
    table = scaled_table(token_counts(tokens))
    folder = shared_folder(docs.sparkSession, "rans")
    documents = tokens.where("n_tokens IS NOT NULL").select("doc_id", "n_tokens", "ids")
    return write_shards(documents, folder, table, tokens_per_shard), table


def encoded_and_read_back(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    manifest, table = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(docs.sparkSession, manifest, table).drop("shard")


def op3_rans_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_and_read_back(read_table(spark, sf_dir, "documents"))
