"""Formatting, tokenising, encoding and padding of records.

A tokenizer is anything with ``ids(column)``: a Column expression that never leaves the JVM
(``WordHashTokenizer``) or an Arrow UDF around a tokenizer file (``FileTokenizer``).
"""

from __future__ import annotations

from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import IGNORED, encode_pair, pad
from tessera.functions.text import rstrip, ws_tokens


class Tokenizer(Protocol):
    bos: int | None
    eos: int

    def ids(self, text: Column) -> Column: ...


class WordHashTokenizer:
    """White-space words, each by the first 28 bits of its MD5; needs no vocabulary and no Python."""

    bos, eos, pad = 1, 2, 0

    def ids(self, text: Column) -> Column:
        return F.transform(ws_tokens(text), lambda t: F.conv(F.substring(F.md5(t), 1, 7), 16, 10).cast("int") + 3)


class FileTokenizer:
    """A ``tokenizers`` JSON file, read on the driver and sent to the workers; Arrow batches."""

    def __init__(self, path: str, eos: int, bos: int | None = None, pad: int | None = None):
        with open(path, encoding="utf-8") as f:
            definition = f.read()
        self.eos, self.bos, self.pad = eos, bos, eos if pad is None else pad

        @F.pandas_udf("array<int>")
        def encode(texts: pd.Series) -> pd.Series:
            from tokenizers import Tokenizer as Library

            tok = Library.from_str(definition)
            tok.encode_special_tokens = True
            out = tok.encode_batch(["" if t is None else t for t in texts], add_special_tokens=False)
            return pd.Series([None if t is None else e.ids for t, e in zip(texts, out, strict=True)])

        self._encode = encode

    def ids(self, text: Column) -> Column:
        return self._encode(text)


#: A chat template as (before, after) of every message, by role, and what opens the answer.
CHAT_OPEN, CHAT_CLOSE, CHAT_ANSWER = "<|{role}|>\n", "\n<|end|>\n", "<|assistant|>\n"


def plain_prompt(prompt: Column) -> Column:
    """The prompt without trailing white space, and a line end."""
    return F.concat(rstrip(prompt), F.lit("\n"))


def message(role: Column | str, content: Column) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    before, after = CHAT_OPEN.split("{role}")
    return F.concat(F.lit(before), r, F.lit(after), content, F.lit(CHAT_CLOSE))


def chat_text(messages: Column, answer_next: bool) -> Column:
    """The template over an array of messages, in their order."""
    body = F.array_join(F.transform(messages, lambda m: message(m["role"], m["content"])), "")
    return F.concat(body, F.lit(CHAT_ANSWER)) if answer_next else body


def user_messages(prompt: Column, system: str | None = None) -> Column:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    head = [turn("system", F.lit(system))] if system is not None else []
    return F.array(*head, turn("user", prompt))


def answered(messages: Column, answer: Column) -> Column:
    return F.concat(messages, F.array(F.struct(F.lit("assistant").alias("role"), answer.alias("content"))))


def record_parts(prompt: Column, response: Column, tokenizer: Tokenizer, mode: str = "plain", system: str | None = None) -> tuple[Column, Column, Column]:
    """(prompt ids, response ids, stable): in plain mode the prompt has the opening mark; in chat
    mode the response is what follows the prompt's ids in the whole conversation's ids, and
    ``stable`` tells whether these begin with them."""
    if mode == "plain":
        p = tokenizer.ids(plain_prompt(prompt))
        p = p if tokenizer.bos is None else F.concat(F.array(F.lit(tokenizer.bos)), p)
        return p, tokenizer.ids(response), F.lit(True)
    if mode != "chat":
        raise ValueError("mode must be 'plain' or 'chat'")
    messages = user_messages(prompt, system)
    p = tokenizer.ids(chat_text(messages, True))
    full = tokenizer.ids(chat_text(answered(messages, response), False))
    return p, F.slice(full, F.size(p) + 1, F.greatest(F.size(full) - F.size(p), F.lit(0))), F.slice(full, 1, F.size(p)) == p


def tokenize_records(df: DataFrame, tokenizer: Tokenizer, mode: str = "plain", system: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., prompt_ids, response_ids, stable) of canonical records."""
    p, r, stable = record_parts(F.col("prompt"), F.col("response"), tokenizer, mode, system)
    return df.select(*keep, p.alias("prompt_ids"), r.alias("response_ids"), stable.alias("stable"))


def encode_tokenized(df: DataFrame, eos: int, max_length: Column | int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., input_ids, attention_mask, labels) of tokenised records."""
    limit = F.lit(max_length) if isinstance(max_length, int) else max_length
    encoded = df.select(*keep, encode_pair(F.col("prompt_ids"), F.col("response_ids"), eos, limit).alias("__e"))
    return encoded.select(*keep, "__e.input_ids", "__e.attention_mask", "__e.labels")


def encode_records(df: DataFrame, tokenizer: Tokenizer, max_length: int, mode: str = "plain", system: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., stable, input_ids, attention_mask, labels) of canonical records; the parts are
    projected before they are used, so nothing is tokenised twice."""
    parts = tokenize_records(df, tokenizer, mode, system, keep)
    return encode_tokenized(parts, tokenizer.eos, max_length, (*keep, "stable"))


def pad_batches(df: DataFrame, order: str, batch: Column | int, pad_id: int, side: str = "right", by: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Pads every sequence to the longest of its batch: consecutive rows (``order`` from 0) of a run
    (``by``).  ``keep`` are further columns of the result.

    The batch's width is an aggregate combined before the shuffle and joined back, not a window."""
    size = F.lit(batch) if isinstance(batch, int) else batch
    rows = df.withColumn("batch_id", F.floor(F.col(order) / size).cast("bigint"))
    width = rows.groupBy(*by, "batch_id").agg(F.max(F.size("input_ids")).alias("width"))
    rows = rows.join(width, [*by, "batch_id"])
    return rows.select(
        *by, *keep, order, "batch_id", "width",
        pad(F.col("input_ids"), F.col("width"), pad_id, side).alias("input_ids"),
        pad(F.col("attention_mask"), F.col("width"), 0, side).alias("attention_mask"),
        pad(F.col("labels"), F.col("width"), IGNORED, side).alias("labels"),
    )


def positions(df: DataFrame, partition: list[str], order: str) -> DataFrame:
    """Adds ``position`` (from 0) within the partition, in the order given, over numbered rows.

    Rows are counted in ranges of the order first, so a partition of any size is split into ranges
    that are numbered apart and shifted by the rows before them."""
    rows = df.withColumn("__range", F.floor(F.col(order) / F.lit(100_000)))
    counts = rows.groupBy(*partition, "__range").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*partition).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__ahead", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    own = Window.partitionBy(*partition, "__range").orderBy(order)
    rows = rows.withColumn("__own", F.row_number().over(own) - 1).join(counts, [*partition, "__range"])
    return rows.withColumn("position", (F.col("__own") + F.col("__ahead")).cast("bigint")).drop("__own", "__ahead", "__range")


def micro_batches(df: DataFrame, order: str, size: int, keep_start: int | None = None) -> DataFrame:
    """Adds ``batch_id``: consecutive rows (``order`` from 0), ``size`` to a batch, as a generator takes
    them; with ``keep_start`` the prompt ids keep their first so many."""
    rows = df.withColumn("batch_id", F.floor(F.col(order) / F.lit(size)).cast("bigint"))
    return rows if keep_start is None else rows.withColumn("prompt_ids", F.slice("prompt_ids", 1, keep_start))


def preference_texts(prompt: Column, chosen: Column, rejected: Column, fmt: str, mode: str = "plain", system: str | None = None) -> tuple[Column, Column, Column]:
    """(prompt text, prompt with chosen, prompt with rejected).  Conversational rows always take
    the template and leave the configured system prompt out."""
    if fmt == "standard" and mode == "plain":
        p = plain_prompt(prompt)
        return p, F.concat(p, chosen), F.concat(p, rejected)
    if fmt == "standard":
        m = user_messages(prompt, system)
        return chat_text(m, True), chat_text(answered(m, chosen), False), chat_text(answered(m, rejected), False)
    return chat_text(prompt, True), chat_text(F.concat(prompt, chosen), False), chat_text(F.concat(prompt, rejected), False)
