"""Byte-level BPE: encode each distinct word once in the whole corpus, and decode by a table join.

1. Texts are cut into pre-tokens. Neighbouring texts form a block of bounded size; a block explodes into
   its distinct words, numbered by frequency, and for every text the numbers of its words in order.
2. The words of all blocks are shuffled by hash of the word. Where a word's rows meet, it is encoded once,
   and its ids are joined back to every block that holds it.
3. Ids come back by block and texts are put together by position.

What moves is packed: the words of a block that share a bucket of the hash are one row, as are their ids,
and a text's numbers. So a corpus is shuffled for about its own size, and not a row for each position.
Decoding joins ids with the table of token bytes, a row per token of the vocabulary file: its rows are
broadcast, their number is the vocabulary's whatever the corpus, and each task looks up the ids of a block of
texts at once and cuts the bytes at the ends of the texts.

A block is named by a hash of its texts, so both passes over the input agree on it. An input that gives
other rows or another order when it is read again is found out and stops the job: write it first.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import blocks, code_points, output, texts

# Bytes of text whose distinct words are numbered together, and those cut up at a time.
BLOCK, PIECE = 3 << 20, 1 << 19
# Bytes of text of the corpus for each group of words, rows of a group handed on together, ids decoded at a time.
GROUP, ROWS, IDS = 64 << 20, 16, 1 << 20
# Rows handed to Python at a time: of whole texts, Spark's usual 10,000 are tens of megabytes for each task.
BATCH_ROWS = 1_000
# What follows an apostrophe in a pre-token of its own, as in the published pattern.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")

LETTER, NUMBER, BLANK, OTHER = 1, 2, 3, 4


@cache
def _kinds() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    kind = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for pattern, value in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        kind[[ord(c) for c in regex.findall(pattern, every)]] = value
    return kind


def pre_token_starts(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in texts laid end to end, by the rules of the published pattern.

    Runs of letters, of numbers and of other characters take one space before them; white space
    leaves its last character to what follows; an apostrophe that begins a pre-token takes one of
    ``SUFFIXES`` and no more.
    """
    n = len(flat)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    kind = _kinds()[flat]
    edge = np.zeros(n + 1, dtype=bool)  # a text begins here, or all end
    edge[at] = True
    blank = kind == BLANK
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # A space right before another kind of run of the same text begins that run.
    next_ink = np.zeros(n, dtype=bool)
    next_ink[:-1] = blank[:-1] & ~blank[1:] & ~edge[1:n]
    joins = next_ink & (flat == 32)
    start[1:] &= ~joins[:-1]
    start |= next_ink  # the last of a run of white space stands apart, joined or not
    quote = np.flatnonzero((flat == 39) & start)
    for suffix in sorted(SUFFIXES, key=len):
        size = len(suffix)
        here = quote[quote + size < n]
        for k, c in enumerate(suffix, 1):
            here = here[(flat[here + k] == ord(c)) & ~edge[here + k]]
        start[here + 1] = False
        after = here + 1 + size
        start[after[after < n]] = True
    return np.flatnonzero(start)


def pre_tokens(parts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of the texts in order, and where those of each text begin (with the end)."""
    flat, at = code_points(parts)
    start = pre_token_starts(flat, at)
    joined = "".join(parts)
    bounds = [*start.tolist(), len(joined)]
    words = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
    return words, np.searchsorted(start, at)


@cache
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers as compressed bytes, low bytes first and together."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _zstd()[0].compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_zstd()[1].decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


def _pack_bytes(parts: list[bytes]) -> bytes:
    """Byte strings with their lengths, compressed."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    head = _pack(sizes)
    body = _zstd()[0].compress(b"".join(parts))
    return len(head).to_bytes(4, "little") + head + body


def _unpack_bytes(data: bytes) -> list[bytes]:
    size = int.from_bytes(data[:4], "little")
    ends = np.cumsum(_unpack(data[4 : 4 + size])).tolist()
    flat = _zstd()[1].decompress(data[4 + size :])
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


class _Block:
    """Texts whose words are numbered together."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.rows: list[pa.RecordBatch] = []
        self.words: list[list[np.ndarray]] = []
        self.size = 0
        self.name = xxhash.xxh3_64()

    def add(self, batch: pa.RecordBatch, column: str) -> None:
        parts = texts(batch, column)
        words, at = pre_tokens(parts)
        number = self.number
        found = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
        self.words.append([found[a:b] for a, b in zip(at, at[1:])])
        self.rows.append(batch)
        for part in parts:
            data = part.encode("utf-8", "surrogatepass")
            self.name.update(len(data).to_bytes(8, "little") + data)
            self.size += len(data)

    def mark(self) -> int:
        """The block's name: a hash of its texts, as a signed number."""
        return int.from_bytes(self.name.digest(), "big", signed=True)

    def order(self) -> np.ndarray:
        """New number of every word: the most frequent first, for tighter packing."""
        every = np.concatenate([r for rows in self.words for r in rows])
        count = np.bincount(every, minlength=len(self.number))
        rank = np.empty(len(count), dtype=np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
        return rank


def _numbered(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[_Block]:
    held = _Block()
    for batch in blocks(batches, column, PIECE):
        held.add(batch, column)
        if held.size >= BLOCK:
            yield held
            held = _Block()
    if held.rows:
        yield held


def _small_batches(df: DataFrame) -> None:
    """Have the session hand at most ``BATCH_ROWS`` rows to Python at a time from now on."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a vocabulary file in the form of tiktoken."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def token_table(path: str) -> pa.LargeBinaryArray:
    """The bytes of every token of a vocabulary file, in the place of its id; null where there is none."""
    tokens = {i: t for t, i in ranks(path).items()}
    return pa.array([tokens.get(i) for i in range(max(tokens, default=-1) + 1)], pa.large_binary())


@cache
def _encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks(path), special_tokens={})


def word_encoder(path: str) -> Callable[[str], list[int]]:
    """Merges within one pre-token; the pattern here takes whatever it is given as one."""
    return _encoding(path).encode_ordinary


def encode(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``ids`` (array of int) in place of every row's text; ``docs`` must be a table to read again.

    A null or empty text has no ids. Repeated rows, ties and very long texts and words are all
    encoded whole; a column ``ids`` is replaced. The session's Arrow batches are ``BATCH_ROWS`` rows at most from
    then on. ``path`` names a vocabulary file that all machines have.
    """
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = docs.select(*[c for c in docs.columns if c != "ids"])
    _small_batches(docs)

    # A group holds the words of about GROUP bytes of text, however large the corpus is.
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP))

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _numbered(batches, text):
            each = [w.encode("utf-8", "surrogatepass") for w in held.number]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in each), np.int64, len(each))
            order = np.argsort(bucket, kind="stable")
            rank = held.order()[order]
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts))
            order = order.tolist()
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(full.astype(np.int32)),
                "block": pa.array([held.mark()] * len(full), pa.int64()),
                "numbers": pa.array([_pack(rank[cuts[i] : cuts[i + 1]]) for i in full], pa.binary()),
                "words": pa.array(
                    [_pack_bytes([each[k] for k in order[cuts[i] : cuts[i + 1]]]) for i in full],
                    pa.binary(),
                ),
            })

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _numbered(batches, text):
            rank, name = held.order(), held.mark()
            for batch, rows in zip(held.rows, held.words):
                packed = [_pack(rank[r]) for r in rows]
                yield output(
                    batch, (text,), bpe_block=pa.array([name] * batch.num_rows, pa.int64()),
                    bpe_numbers=pa.array(packed, pa.binary()),
                )

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_encoder(path)
        known: dict[bytes, bytes] = {}  # the bucket's distinct words
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch, packed = whole.slice(a, ROWS), []
                for words in batch.column("words"):
                    each = _unpack_bytes(words.as_py())
                    for word in each:
                        if word not in known:
                            ids = coder(word.decode("utf-8", "surrogatepass"))
                            known[word] = np.array(ids, dtype="<i4").tobytes()
                    packed.append(_pack_bytes([known[w] for w in each]))
                yield pa.RecordBatch.from_pydict({
                    "block": batch.column("block"), "numbers": batch.column("numbers"),
                    "word_ids": pa.array(packed, pa.binary()),
                })

    words = docs.select(text).mapInArrow(words_of, "bucket int, block bigint, numbers binary, words binary")
    told = words.groupBy("bucket").applyInArrow(encode_words, "block bigint, numbers binary, word_ids binary")
    kept_fields = [f for f in docs.schema.fields if f.name != text]
    extra = [T.StructField("bpe_block", T.LongType()), T.StructField("bpe_numbers", T.BinaryType())]
    rows = docs.mapInArrow(rows_of, T.StructType([*kept_fields, *extra]))

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = [_unpack(data) for data in right.column("bpe_numbers").to_pylist()]
        most = max((int(w.max(initial=-1)) for w in wanted), default=-1)
        numbers, pieces = [np.zeros(0, np.int64)], []
        for some, ids in zip(left.column("numbers").to_pylist(), left.column("word_ids").to_pylist()):
            numbers.append(_unpack(some))
            pieces += _unpack_bytes(ids)
        # Blocks of equal texts share a name, and give each word as often as there are such blocks.
        number, order = np.unique(np.concatenate(numbers), return_index=True)
        if len(number) != most + 1 or right.num_rows == 0:
            raise RuntimeError("the input changed between two reads: write it to a table first")
        pieces = [pieces[i] for i in order.tolist()]
        count = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        first = np.cumsum(count) - count
        flat = np.frombuffer(b"".join(pieces), dtype="<i4")
        values, ends = [], [0]
        for which in wanted:
            many = count[which]
            upto = np.cumsum(many)
            total = int(upto[-1]) if len(upto) else 0
            if total:
                place = np.arange(total) + np.repeat(first[which] - (upto - many), many)
                values.append(flat[place])
            ends.append(ends[-1] + total)
        if ends[-1] >= 2**31:
            raise RuntimeError("a text has more tokens than a list can hold")
        ids = pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(np.concatenate(values or [flat[:0]]), pa.int32())
        )
        return right.drop_columns(["bpe_block", "bpe_numbers"]).append_column("ids", ids)

    schema = T.StructType([*kept_fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return told.groupBy("block").cogroup(rows.groupBy("bpe_block")).applyInArrow(put_together, schema)


def _id_blocks(batches: Iterator[pa.RecordBatch], ids: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with about ``IDS`` ids together, or one longer row, and how many ids each has."""
    for batch in batches:
        size = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size.astype(np.int64)) // IDS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a), size[a:b]


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of the row's tokens in order; no ids give no bytes.

    An id the vocabulary lacks is an error. Null ids give null; a column ``decoded`` is replaced.
    """
    return _decoded(encoded, path, ids, digest=False)


def decode_digest(
    encoded: DataFrame, path: str | None = None, ids: str = "ids", keep_ids: bool = False
) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` in place of the ids, or beside them.

    The digests are those of the decimal ids, joined by commas, and of the decoded bytes. Null ids count
    as none; columns of the three names are replaced.
    """
    return _decoded(encoded, path, ids, digest=True, keep_ids=keep_ids)


def _decoded(
    encoded: DataFrame, path: str | None, ids: str, digest: bool, keep_ids: bool = True
) -> DataFrame:
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    new = ["n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["decoded"]
    _small_batches(encoded)
    encoded = encoded.select(*[c for c in encoded.columns if c not in new])

    # As large as the vocabulary, whatever the corpus.
    shared = encoded.sparkSession.sparkContext.broadcast(token_table(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch, size in _id_blocks(batches, ids):
            flat = batch.column(ids).flatten()
            joined = table.take(flat)
            if joined.null_count:
                raise ValueError("an id is not in the vocabulary")
            edge = np.r_[0, np.cumsum(size)].tolist()
            at = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][edge].tolist()
            data = memoryview(joined.buffers()[2] or b"")
            rows = [data[a:b] for a, b in zip(at, at[1:])]
            if not digest:
                null = pc.is_null(batch.column(ids)).to_pylist()
                rows = [None if gone else bytes(r) for r, gone in zip(rows, null)]
                yield output(batch, decoded=pa.array(rows, pa.binary()))
                continue
            told = flat.to_numpy().tolist()
            marks = [
                hashlib.sha256(",".join(map(str, told[a:b])).encode()).hexdigest() for a, b in zip(edge, edge[1:])
            ]
            yield output(
                batch, () if keep_ids else (ids,), n_tokens=pa.array(size.astype(np.int64)),
                ids_sha256=pa.array(marks, pa.string()),
                decoded_sha256=pa.array([hashlib.sha256(r).hexdigest() for r in rows], pa.string()),
            )

    fields = [f for f in encoded.schema.fields if keep_ids or f.name != ids]
    if digest:
        fields += [T.StructField("n_tokens", T.LongType())]
        fields += [T.StructField(c, T.StringType()) for c in new[1:]]
    else:
        fields += [T.StructField("decoded", T.BinaryType())]
    return encoded.mapInArrow(run, T.StructType(fields))
