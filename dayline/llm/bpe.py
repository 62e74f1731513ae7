"""Byte-level BPE encoding and decoding through a table of distinct words.

Spark splits texts into words by the tokenizer's own pattern. A task replaces the words of a chunk of
documents by codes into the chunk's list of distinct words; these lists, not the texts, are shuffled.
The union of the lists is the table of distinct words of the corpus, kept in parts by a hash of the
word: each is encoded once, by the tokenizer's merges, and its ids are joined back to the lists and, by
chunk, to the codes, which stand in the order of the text. Decoding joins ids to their pieces. The table of pieces is as long as the
vocabulary (50,257 entries here), so it goes to each task; no table that grows with the corpus does.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dayline.llm.text import blocks, pack, pack_words, prefix_hashes, range_hashes, unpack, unpack_words, utf8_bytes
from dayline.session import scratch_path

CHUNK_BYTES = 12 << 20  # of words that share a list
PART_BYTES = 8 << 20  # of text for which the table of distinct words has one part
BATCH_ROWS = 500  # documents whose words go to Python at a time
# Unicode's white space, and the words of the byte-level pattern.
WHITE = "".join(rf"\x{{{i:X}}}" for i in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WHITE + r"\p{L}\p{N}]+"
           "|[" + WHITE + "]+(?![^" + WHITE + "])|[" + WHITE + "]+")
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
UNKNOWN = r"\p{Cn}"  # characters that are younger than the Unicode tables of the JVM


class Vocabulary:
    """A byte-level BPE tokenizer file: its text travels with the tasks that need it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.text = f.read()
        spec = json.loads(self.text)
        before = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or before.get("type") != "ByteLevel" \
                or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"{path} is not a byte-level BPE tokenizer without normalizer and prefix space")
        self.added = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take their surroundings")

    @property
    def added_pattern(self) -> str:
        """The added tokens, which are cut out of a text before it is split; longer ones first."""
        return "|".join(re.sub(r"([^\w\s])", r"\\\1", x) for x in sorted(self.added, key=len, reverse=True))

    def tokenizer(self):
        return _tokenizer(self.text)

    def pieces(self) -> list[bytes | None]:
        """The bytes of each id; None where no piece has the id."""
        spec = json.loads(self.text)
        at = {x: i for i, x in byte_letters().items()}
        found = {i: bytes(at[x] for x in piece) for piece, i in spec["model"]["vocab"].items()}
        found |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        return [found.get(i) for i in range(max(found, default=-1) + 1)]


@cache
def _tokenizer(text: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(text)
    made.no_truncation()
    made.no_padding()
    return made


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, all others for the code points from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [i for i in range(256) if i not in printable]
    return {**{i: chr(i) for i in printable}, **{i: chr(256 + k) for k, i in enumerate(rest)}}


def words(text: Column, vocabulary: Vocabulary) -> Column:
    """The words of a text in order, added tokens as words; null if the JVM does not know a character."""
    def split(x: Column) -> Column:
        return F.regexp_extract_all(x, F.lit(PATTERN), F.lit(0))

    plain = split(text)
    if vocabulary.added:
        added = F.regexp_extract_all(text, F.lit(vocabulary.added_pattern), F.lit(0))
        parts = F.transform(F.split(text, vocabulary.added_pattern, -1), lambda x, i: F.when(i == 0, split(x)).otherwise(
            F.concat(F.array(F.get(added, i - 1)), split(x))))
        plain = F.when(text.rlike(vocabulary.added_pattern), F.flatten(parts)).otherwise(plain)
    return F.when(~text.rlike(UNKNOWN), plain)


def words_by_tokenizer(text: str, vocabulary: Vocabulary) -> list[str]:
    """The same by the tokenizer's own splitter, for texts with characters that the JVM does not know."""
    split = vocabulary.tokenizer().pre_tokenizer.pre_tokenize_str
    parts = re.split(f"({vocabulary.added_pattern})", text) if vocabulary.added else [text]
    return [x for i, part in enumerate(parts)
            for x in ([part] if i % 2 else [part[a:b] for _, (a, b) in split(part)])]


def _parts(words: pa.Array, parts: int) -> np.ndarray:
    """The part of the word table that each word belongs to."""
    data, ends = utf8_bytes(words)
    return (range_hashes(prefix_hashes(data), ends[:-1], ends[1:]) % np.uint64(parts)).astype(np.int64)


def _coded(docs: DataFrame, kept: list[T.StructField], vocabulary: Vocabulary, parts: int) -> DataFrame:
    """Of each chunk: a row for each document (kept columns and its number of words), one with the codes
    of all words in order and the part of each code's word, and one for each part of the word table with
    the chunk's words there, in order of their codes.
    """
    schema = T.StructType([*kept, *[T.StructField(k, t) for k, t in (
        ("chunk", T.LongType()), ("at", T.IntegerType()), ("n", T.IntegerType()), ("part", T.IntegerType()), ("data", T.BinaryType()))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, chunk = to_arrow_schema(schema), TaskContext.get().partitionId() << 32

        def batch(rows: int, /, **columns) -> pa.RecordBatch:
            columns["chunk"] = pa.array(np.full(rows, chunk))
            return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(rows, f.type)
                                               for f in arrow], schema=arrow)

        def coded(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            place = 0
            for columns, counts, _, _ in held:
                yield batch(len(counts), **{f.name: c for f, c in zip(kept, columns)}, n=counts,
                            at=pa.array(np.arange(place, place + len(counts))))
                place += len(counts)
            table = pa.concat_arrays([words for _, _, words, _ in held]).dictionary_encode()
            firsts = np.cumsum([0, *[len(words) for _, _, words, _ in held]])
            found, where = np.concatenate([codes + np.int32(k) for (*_, codes), k in zip(held, firsts)]), table.indices.to_numpy()
            held.clear()
            found = where[found]
            # the most frequent words first, others by name: both compress best
            often = np.bincount(found, minlength=len(table.dictionary))
            order = pc.sort_indices(table.dictionary).to_numpy()
            order = order[np.argsort(-often[order], kind="stable")]
            code = np.empty(len(order), np.int32)
            code[order] = np.arange(len(order))
            words = table.dictionary.take(pa.array(order)).cast(pa.binary())
            of = _parts(words, parts)
            yield batch(1, data=pa.array([pack([code[found], of])], pa.binary()))
            by_part = np.argsort(of, kind="stable")
            words, ends = words.take(pa.array(by_part)), np.searchsorted(of[by_part], np.arange(parts + 1))
            full = np.flatnonzero(np.diff(ends))
            for i in range(0, len(full), 256):
                some = full[i:i + 256]
                data = [pack(pack_words(words.slice(ends[k], ends[k + 1] - ends[k]))) for k in some]
                yield batch(len(some), part=pa.array(some), data=pa.array(data, pa.binary()))

        def split(b: pa.RecordBatch) -> pa.Array:
            lists, text = b.column(len(kept)), b.column(len(kept) + 1)
            if not lists.null_count:
                return lists
            lists = [words_by_tokenizer(t, vocabulary) if w is None else w for w, t in zip(lists.to_pylist(), text.to_pylist())]
            return pa.array(lists, b.schema.field(len(kept)).type)

        held, size = [], 0
        for b in batches:
            for i in range(0, b.num_rows, BATCH_ROWS):
                own = b.slice(i, BATCH_ROWS)
                lists = split(own)
                words = lists.flatten()
                size += words.nbytes
                table = words.dictionary_encode()
                rows = pa.array(np.arange(own.num_rows))  # copies, so that no batch is held
                held.append(([own.column(k).take(rows) for k in range(len(kept))], lists.value_lengths(), table.dictionary,
                             table.indices.to_numpy()))
                if size >= CHUNK_BYTES:
                    yield from coded(held)
                    held, size, chunk = [], 0, chunk + 1
                    pa.default_memory_pool().release_unused()
        if held:
            yield from coded(held)
        pa.default_memory_pool().release_unused()  # the worker stays for other tasks

    text = F.coalesce("_text", F.lit(""))
    split = docs.withColumn("_words", words(text, vocabulary))
    return split.select(*[f.name for f in kept], "_words", F.when(F.col("_words").isNull(), text).alias("_text")) \
        .mapInArrow(run, schema)


@contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands Python so many rows at a time, at most; the session's own setting comes back.

    Arrow buffers of a batch stand beside the heap, in the executor and in its Python worker.
    """
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def _by_chunk(coded: DataFrame, buckets: int) -> DataFrame:
    """The rows as a table in buckets of chunks, so that the codes are not shuffled after they are written."""
    spark, name = coded.sparkSession, f"bpe_codes_{uuid.uuid4().hex}"
    with _batches_of(spark, BATCH_ROWS):
        coded.write.bucketBy(min(buckets, 50_000), "chunk").option("path", scratch_path(spark, "bpe-codes")).saveAsTable(name)
    return spark.table(name)


def encoded_words(lists: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(list, part, ids): the ids of the words of each row of ``lists`` (chunk, part, data), in their order.

    All words of a part are in one group, so each distinct word is encoded once.
    """
    def run(group: pa.Table) -> pa.Table:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = [unpack_words(*unpack(x)) for x in group.column("data").to_pylist()]
        table = pa.concat_arrays(own).dictionary_encode()
        encode, found, counts = vocabulary.tokenizer().encode_batch, [], []
        for i in range(0, len(table.dictionary), 2000):
            some = [x.ids for x in encode(table.dictionary.slice(i, 2000).cast(pa.string()).to_pylist(), add_special_tokens=False)]
            found.append(np.fromiter(chain.from_iterable(some), np.int32))
            counts.append(np.fromiter(map(len, some), np.int64, len(some)))
        sizes = np.concatenate(counts)
        ids, starts = np.concatenate(found), np.cumsum(sizes) - sizes
        codes, at, data = table.indices.to_numpy(), 0, []
        for words in own:
            mine = codes[at:at + len(words)]
            data.append(pack([sizes[mine], taken(ids, starts, sizes, mine)[0]]))
            at += len(words)
        return pa.table([group.column("chunk"), group.column("part"), pa.array(data, pa.binary())], names=["list", "part", "ids"])

    return lists.select("chunk", "part", "data").groupBy("part").applyInArrow(run, "list long, part int, ids binary")


def taken(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``data`` that the codes name, end to end, and where each ends."""
    counts = sizes[codes]
    ends = np.cumsum(counts)
    at = np.repeat(starts[codes] - (ends - counts), counts)
    return data[at + np.arange(len(at))], ends


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row and ``ids`` (array<int>), the tokenizer's ids of its whole text.

    Added tokens in a text become their ids, as they do in the tokenizer; none is added, nothing is
    cut or padded. A null text is empty and has no ids. Rows are carried, not joined by a column of
    theirs, so nulls, ties and repeated rows stay rows of their own; names of ``keep`` cannot clash
    with those used inside; an empty table gives an empty result.
    """
    vocabulary = Vocabulary(path)
    kept = [T.StructField(f"_k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    inner = docs.select(*[F.col(f"`{c}`").alias(f.name) for c, f in zip(keep, kept)], F.col(f"`{text}`").alias("_text"))
    size = inner.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    coded = _by_chunk(_coded(inner, kept, vocabulary, -(-size // PART_BYTES) or 1), max(8, 2 * (size // CHUNK_BYTES)))
    ids = encoded_words(coded.where("part IS NOT NULL"), vocabulary)
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = left.filter(pc.is_valid(left.column("n"))).sort_by("at")
        lists = [unpack(x) for x in right.sort_by("part").column("ids").to_pylist()]
        codes, of = unpack(left.filter(pc.is_valid(left.column("data"))).column("data")[0].as_py())
        by_part = np.concatenate([np.zeros(0, np.int64), *[x for x, _ in lists]])
        data = np.concatenate([np.zeros(0, np.int32), *[x for _, x in lists]]).astype(np.int32)
        sizes, starts = np.empty(len(of), np.int64), np.empty(len(of), np.int64)
        place = np.argsort(of, kind="stable")
        sizes[place], starts[place] = by_part, np.cumsum(by_part) - by_part
        edges, found, ends = np.concatenate([[0], np.cumsum(docs.column("n").to_numpy())]), [], [np.zeros(1, np.int64)]
        for first, last in blocks(edges):
            ids, own = taken(data, starts, sizes, codes[edges[first]:edges[last]])
            found.append(ids)
            ends.append(ends[-1][-1] + np.concatenate([[0], own])[edges[first + 1:last + 1] - edges[first]])
        column = pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate([data[:0], *found]), pa.int32()))
        return pa.table([*[docs.column(f.name) for f in kept], column], schema=to_arrow_schema(schema))

    texts = coded.where("part IS NULL").select(*[f.name for f in kept], "chunk", "at", "n", "data")
    met = texts.groupBy("chunk").cogroup(ids.groupBy("list")).applyInArrow(run, schema)
    return met.withColumnsRenamed({f.name: c for f, c in zip(kept, keep)})


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text that its ids spell, special tokens included.

    Ids without a piece are left out; bytes that are not UTF-8 become U+FFFD, as in the tokenizer; a
    null array gives a null text. A column of the name ``text`` is replaced.
    """
    vocabulary = Vocabulary(path)
    kept = [f for f in encoded.schema if f.name.lower() != text.lower()]
    at = [f.name for f in kept].index(ids)
    schema = T.StructType([*kept, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        pieces = vocabulary.pieces()
        data = np.frombuffer(b"".join(x or b"" for x in pieces), np.uint8)
        sizes = np.array([len(x or b"") for x in pieces] + [0], np.int64)  # the last for ids without a piece
        starts = np.concatenate([[0], np.cumsum(sizes[:-1])])
        for whole in batches:
            for first, last in blocks(np.concatenate([[0], np.cumsum(whole.column(at).value_lengths().fill_null(0).to_numpy())])):
                batch = whole.slice(first, last - first)
                lists = batch.column(at)
                flat, counts = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy()
                codes = np.where((flat >= 0) & (flat < len(pieces)), flat, len(pieces)).astype(np.int64)
                got, ends = taken(data, starts, sizes, codes)
                cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
                spelled = got.tobytes()
                texts = [spelled[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(cut, cut[1:], lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker stays for other tasks

    return encoded.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)
