"""BPE encoding and decoding by a table of distinct words.

Texts are split into words and kept as word numbers per block of documents. The distinct words of all blocks meet by
their hash, where each is encoded once; its ids go back to the blocks that hold it and are put in the places of the
word. Text that repeats its words is so encoded for the price of its vocabulary, and what travels is packed: per block
its texts as compressed word numbers, per block and hash range the words one way and their ids the other.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from viewmill.llm.common import with_key

#: Text of one block, in bytes. A longer document is a block of its own.
BLOCK_BYTES = 16 << 20
_ENCODE_AT_ONCE = 10_000


def tokenizer_of(definition: str):
    """A tokenizer from the JSON text of its file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def read_definition(path: str) -> str:
    """The JSON text of a tokenizer file, if words can be encoded one by one.

    Its normalizer and its splitting must not look across white space, added tokens must be plain strings without any, and
    there must be no decoder of its own: decoding then joins pieces by one space. ``ValueError`` if not.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    tokenizer = tokenizer_of(definition)
    if tokenizer.decoder is not None:
        raise ValueError("the tokenizer joins pieces by a decoder of its own")
    for added in tokenizer.get_added_tokens_decoder().values():
        if added.normalized or added.single_word or added.lstrip or added.rstrip or added.content.split() != [added.content]:
            raise ValueError(f"the added token {added.content!r} depends on what is around it")
    probe = " A b\t'll  ć\ńx 1\r\n\x0b\x0c-- Σ ' s it 's  "
    words = [w.decode() for w in probe.encode().split()]
    whole = tokenizer.encode(probe, add_special_tokens=False).ids
    if whole != [i for w in words for i in tokenizer.encode(w, add_special_tokens=False).ids]:
        raise ValueError("the tokenizer looks across white space")
    return definition


def _shrunk(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed: all lowest bytes first, then the next ones, which are mostly zero."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _grown(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _listed(words: list[bytes]) -> bytes:
    """Words as one string; none holds a line end, at which texts are split."""
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(words))


def _unlisted(packed: bytes) -> list[bytes]:
    listed = zstandard.ZstdDecompressor().decompress(packed)
    return listed.split(b"\n") if listed else []


class _Block:
    """Documents of one block, packed as an Arrow stream. Frequent words have small numbers."""

    def __init__(self):
        self.documents, self.marks, self.codes, self.words, self.size = [], [], [], {}, 0

    def add(self, document, mark: int, data: bytes) -> None:
        words = data.split()
        for w in words:
            self.words.setdefault(w, len(self.words))
        self.documents.append(document)
        self.marks.append(mark)
        self.codes.append(np.fromiter(map(self.words.__getitem__, words), dtype="<u4", count=len(words)))
        self.size += len(data)

    def packed(self, kind: pa.DataType) -> bytes:
        sizes = [len(c) for c in self.codes]
        seen = np.concatenate([np.zeros(0, "<u4"), *self.codes])
        by_count = np.argsort(-np.bincount(seen, minlength=len(self.words)), kind="stable")
        rank = np.empty_like(by_count)
        rank[by_count] = np.arange(len(by_count))
        listed = list(self.words)
        words, codes = [listed[i] for i in by_count.tolist()], rank[seen]
        columns = {
            "ids": pa.array([self.documents], pa.list_(kind)),
            "marks": pa.array([self.marks], pa.list_(pa.int64())),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "codes": pa.array([_shrunk(codes)], pa.binary()),
            "words": pa.array([_listed(words)], pa.binary()),
        }
        batch = pa.RecordBatch.from_pydict(columns)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        return sink.getvalue().to_pybytes()


def _unpacked(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def _split(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, kind = TaskContext.get().partitionId() << 32, _Block(), pa.null()

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), pa.array([block.packed(kind)], pa.binary())], ["block", "payload"]
            )

        for batch in batches:
            kind = batch["id"].type
            for document, mark, text in zip(batch["id"], batch["mark"], batch["text"], strict=True):
                data = text.as_py().encode()
                if block.documents and block.size + len(data) > block_bytes:
                    yield done()
                    key, block = key + 1, _Block()
                block.add(document.as_py(), mark.as_py(), data)
        if block.documents:
            yield done()

    return run


def word_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Keyed documents as (``block``, ``payload``): documents, a number for every word in order, and a list of words.

    Dealt by block. Both uses below read this one shuffle, and it alone holds the texts. A block is named after the task
    that made it, so ``docs`` must give a task the same rows in the same order when it is repeated, as files do.
    """
    split = docs.select("id", "mark", "text").mapInArrow(_split(block_bytes), "block long, payload binary")
    return split.repartition("block")


def _by_range(words: list[bytes], ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by hash range, and where each range begins in it."""
    at = np.fromiter((crc32(w) % ranges for w in words), dtype=np.int64, count=len(words))
    order = np.argsort(at, kind="stable")
    return order, np.searchsorted(at[order], np.arange(ranges + 1))


def _list_words(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch["block"].to_pylist(), batch["payload"], strict=True):
                words = _unlisted(_unpacked(payload.as_py())["words"][0].as_py())
                order, starts = _by_range(words, ranges)
                used = [r for r in range(ranges) if starts[r] < starts[r + 1]]
                lists = [_listed([words[i] for i in order[starts[r] : starts[r + 1]].tolist()]) for r in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(used), pa.int64()), pa.array(used, pa.int32()), pa.array(lists, pa.binary())],
                    ["block", "range", "words"],
                )

    return run


def _encode(definition: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, last, known = None, None, {}
        for batch in batches:
            tokenizer = tokenizer or tokenizer_of(definition)
            counts, ids = [], []
            for at, packed in zip(batch["range"].to_pylist(), batch["words"], strict=True):
                if at != last:
                    last, known = at, {}
                words = _unlisted(packed.as_py())
                fresh = [w for w in words if w not in known]
                for i in range(0, len(fresh), _ENCODE_AT_ONCE):
                    some = fresh[i : i + _ENCODE_AT_ONCE]
                    encoded = tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
                    known.update((w, tuple(e.ids)) for w, e in zip(some, encoded, strict=True))
                found = [known[w] for w in words]
                counts.append(_shrunk(np.array([len(f) for f in found], dtype="<u4")))
                ids.append(_shrunk(np.array([i for f in found for i in f], dtype="<u4")))
            yield pa.RecordBatch.from_arrays(
                [batch["block"], batch["range"], pa.array(counts, pa.binary()), pa.array(ids, pa.binary())],
                ["block", "range", "counts", "ids"],
            )

    return run


def encoded_words(blocks: DataFrame, definition: str, ranges: int) -> DataFrame:
    """Token ids of the words of every block, as (``block``, ``range``, ``counts``, ``ids``) in packed form.

    Words meet by hash range, where each distinct word is encoded once; a block lists a word once, so a word that is
    everywhere is one entry per block.
    """
    lists = blocks.mapInArrow(_list_words(ranges), "block long, range int, words binary")
    met = lists.repartition("range").sortWithinPartitions("range")
    return met.mapInArrow(_encode(definition), "block long, range int, counts binary, ids binary")


def _place(pieces: dict[int, bytes], ranges: int):
    def run(encoded: pa.Table, blocks: pa.Table) -> pa.Table:
        block = _unpacked(blocks["payload"][0].as_py())
        words = _unlisted(block["words"][0].as_py())
        order, _ = _by_range(words, ranges)
        parts = sorted(zip(*(encoded[c].to_pylist() for c in ("range", "counts", "ids")), strict=True))
        none = np.zeros(0, "<u4")
        sorted_counts = np.concatenate([none, *[_grown(c) for _, c, _ in parts]]).astype(np.int64)
        tokens = np.concatenate([none, *[_grown(i) for _, _, i in parts]])
        counts, starts = np.empty_like(sorted_counts), np.empty_like(sorted_counts)
        counts[order], starts[order] = sorted_counts, np.cumsum(sorted_counts) - sorted_counts
        # A word's pieces, joined from the vocabulary by id; a document's are its words' pieces in order.
        spelled = [
            b" ".join([pieces[i] for i in tokens[s : s + c].tolist()])
            for s, c in zip(starts.tolist(), counts.tolist(), strict=True)
        ]
        codes, first = _grown(block["codes"][0].as_py()), 0
        sizes, n_tokens, ids, decoded = block["sizes"][0].as_py(), [], [], []
        for size in sizes:
            own = codes[first : first + size]
            first += size
            many = counts[own]
            at = np.repeat(starts[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            n_tokens.append(len(at))
            ids.append(tokens[at].astype("<u4").tobytes())
            decoded.append(b" ".join([spelled[c] for c in own[many > 0].tolist()]).decode())
        columns = [
            block["ids"].flatten(),
            block["marks"].flatten(),
            pa.array(n_tokens, pa.int64()),
            pa.array(ids, pa.binary()),
            pa.array(decoded, pa.string()),
        ]
        return pa.Table.from_arrays(columns, ["id", "mark", "n_tokens", "ids", "decoded"])

    return run


def encode_and_decode(
    docs: DataFrame,
    tokenizer_path: str,
    block_bytes: int = BLOCK_BYTES,
    ranges: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``mark``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit numbers),
    ``decoded``.

    ``ids`` are those of the tokenizer file at ``tokenizer_path`` (read by the driver only) for the whole text, without
    special tokens around it; ``decoded`` is the text of these ids, special tokens included. Words are what lies between
    space, \\t, \\n, \\v, \\f and \\r; :func:`read_definition` refuses tokenizers for which that would matter. Decoding
    joins ids with the vocabulary, whose size the file fixes and which every task holds, once per distinct word of a
    block. Words meet in ``ranges`` hash ranges, as many as there are shuffle partitions unless given.

    A block is one task's matter, of bounded size save for a single longer text, which is not cut. ``docs`` should come
    from files, see :func:`word_blocks`; then what a lost executor had is made again as it was. Null and empty texts have
    no token. Repeated rows each get their result; ids may be null; other columns are not read and may have any name. An
    empty table gives an empty table.
    """
    definition = read_definition(tokenizer_path)
    pieces = {i: piece.encode() for piece, i in tokenizer_of(definition).get_vocab(with_added_tokens=True).items()}
    keyed = with_key(docs, id_column, text_column)
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = word_blocks(keyed, block_bytes)
    words = encoded_words(blocks, definition, ranges)
    kind = keyed.schema["id"].dataType.simpleString()
    return (
        words.groupBy("block")
        .cogroup(blocks.groupBy("block"))
        .applyInArrow(_place(pieces, ranges), f"id {kind}, mark long, n_tokens long, ids binary, decoded string")
    )
