"""Corpus encoding with a public byte-level BPE tokenizer through a table of distinct words.

Plan: (1) every document is split once into words and written as blocks, each block with its own
small word list; (2) the distinct words of all blocks are encoded once each; (3) ids return to the
blocks by word and position, and documents are put together from positions.  The ``HEAD`` words of
the table that most blocks have return by a broadcast, so that they cannot become hot join keys; the
others by a join.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import materialize, spread

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Word pattern of the tokenizer (a fixed value of its definition).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A block ends at so many documents or characters, whichever comes first.
BLOCK_DOCS, BLOCK_CHARS = 2_000, 2_000_000
#: Words of the table that are broadcast with their ids, and the most ids of such a word.
HEAD, HEAD_IDS = 50_000, 16


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level BPE: printable bytes stand for themselves, the rest follow from 256."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in keep}, 0
    for b in range(256):
        if b not in keep:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _load(definition: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(definition)
    tok.encode_special_tokens = True
    return tok


def split_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents: per document the number of its words and their places in the block's list
    of distinct words, and that list."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("keys", T.ArrayType(id_type)),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("codes", T.ArrayType(T.IntegerType())),
            T.StructField("words", T.ArrayType(T.StringType())),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(PATTERN).findall
        part, count = TaskContext.get().partitionId(), 0
        keys, sizes, codes, own, chars = [], [], [], {}, 0

        def block():
            nonlocal count, keys, sizes, codes, own, chars
            row = {"block": [(part << 32) + count], "keys": [keys], "sizes": [sizes], "codes": [codes], "words": [list(own)]}
            count += 1
            keys, sizes, codes, own, chars = [], [], [], {}, 0
            return pa.RecordBatch.from_pydict(row, schema=arrow)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = find(text) if text else []
                for w in found:
                    if w not in own:
                        own[w] = len(own)
                codes += map(own.__getitem__, found)
                keys.append(key)
                sizes.append(len(found))
                chars += len(text or "")
                if len(keys) >= BLOCK_DOCS or chars >= BLOCK_CHARS:
                    yield block()
        if keys:
            yield block()

    return spread(docs.select(F.col(id_col), F.col(text_col))).mapInArrow(run, schema)


def encode_words(words: DataFrame, definition) -> DataFrame:
    """Each distinct word (column ``word``) encoded once: (word, n, ids), n its number of rows."""

    def run(batches):
        tok = _load(definition.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids = [e.ids for e in tok.encode_batch(part.column(0).to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ids, pa.list_(pa.int32()))], ["word", "n", "ids"])

    return words.groupBy("word").agg(F.count("*").alias("n")).mapInArrow(run, "word string, n bigint, ids array<int>")


def encode_corpus(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str = DEFAULT_TOKENIZER, ids_col: str = "ids"
) -> DataFrame:
    """(id, ids): the token ids of every row's text, without special tokens.

    Null and empty texts give an empty list, strings that look like special tokens are ordinary
    text, repeated rows give one row each, null ids stay null, an empty table an empty result;
    other columns are not looked at.  Very long texts form blocks of their own.
    """
    spark = docs.sparkSession
    os_threads_off()
    definition = spark.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    blocks = materialize(split_blocks(docs, id_col, text_col), "encode-blocks")
    used = blocks.select("block", F.posexplode("words").alias("pos", "word"))
    known = materialize(encode_words(used, definition), "encode-words")
    top = known.where((F.col("n") > 1) & (F.size("ids") <= HEAD_IDS)).orderBy(F.desc("n"), "word").limit(HEAD).select("word", "ids").toArrow()
    head = spark.sparkContext.broadcast(dict(zip(top.column("word").to_pylist(), top.column("ids").to_pylist(), strict=True)))
    frequent = F.broadcast(spark.createDataFrame(top.select(["word"]).to_pandas(), "word string"))
    own = (
        used.join(frequent, "word", "left_anti")
        .join(known.select("word", "ids"), "word")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("own"))
        .select("block", F.col("own.pos").alias("at"), F.col("own.ids").alias("own"))
    )
    out_schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def assemble(batches):
        ready = head.value
        for batch in batches:
            for r in range(batch.num_rows):
                keys, sizes, codes = (batch.column(i).slice(r, 1).flatten() for i in range(3))
                ids = [ready.get(w) for w in batch.column(3)[r].as_py()]
                for at, x in zip(batch.column(4)[r].as_py() or (), batch.column(5)[r].as_py() or (), strict=True):
                    ids[at] = x
                # One table of the ids of the block's words; then every word takes its stretch of it.
                length = np.fromiter(map(len, ids), np.int64, len(ids))
                table = np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum()))
                first = np.cumsum(length) - length
                code = codes.to_numpy(zero_copy_only=False).astype(np.int64)
                lo = length[code]
                ends = np.cumsum(lo)
                values = table[np.arange(int(lo.sum())) - np.repeat(ends - lo - first[code], lo)]
                edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))])]
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values))], [id_col, ids_col])

    return blocks.join(own, "block", "left").select("keys", "sizes", "codes", "words", "at", "own").mapInArrow(assemble, out_schema)


def os_threads_off() -> None:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def pieces(tokenizer_path: str = DEFAULT_TOKENIZER) -> list[bytes]:
    """The bytes of every id of the vocabulary; none where it has no bytes."""
    alphabet = byte_alphabet()
    vocab = json.loads(read_tokenizer(tokenizer_path))["model"]["vocab"]
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for piece, i in vocab.items():
        if all(c in alphabet for c in piece):
            out[i] = bytes(alphabet[c] for c in piece)
    return out


def decode_corpus(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizer_path: str = DEFAULT_TOKENIZER, text_col: str = "text"
) -> DataFrame:
    """(id, text) by looking ids up in the broadcast table of pieces, without a shuffle.  The empty
    list gives the empty text, null gives null; ids without a piece, and null ones, give nothing, and bytes that are no text the
    replacement character."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces(tokenizer_path))
    schema = T.StructType([T.StructField(id_col, encoded.schema[id_col].dataType), T.StructField(text_col, T.StringType())])

    def run(batches):
        table = shared.value
        n = len(table)
        for batch in batches:
            texts = [None if ids is None else b"".join([table[i] for i in ids if i is not None and 0 <= i < n]).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, text_col])

    return encoded.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, schema)
