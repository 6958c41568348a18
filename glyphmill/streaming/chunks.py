"""Streams: messages converted one by one, and documents that come in chunks.

Shift states, multibyte characters and detection span chunks, so a stream's chunks are held, in order, until the one
marked final; then the whole is converted and its state goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import kernel
from ..functions.columns import transcode
from ..plans.plan import compile_plan


def convert_messages(stream: DataFrame, column: str, *options: str) -> DataFrame:
    """Each message by itself, without state; batch or streaming."""
    return stream.withColumn(column, transcode(column, *options))


def convert_chunks(stream: DataFrame, *options: str, key: str = "stream_id", order: str = "seq", chunk: str = "chunk", final: str = "final") -> DataFrame:
    """(key, content) of each stream of chunks that has come to its end.

    Chunks are joined by their order; those after the final one belong to the key's next document.
    """
    plan = compile_plan(list(options)).settled()

    def run(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seqs, held, ends = ([list(x) for x in state.get] if state.exists else [[], [], []])
        for part in parts:
            seqs += [int(x) for x in part["o"]]
            held += [bytes(x or b"") for x in part["c"]]
            ends += [bool(x) for x in part["f"]]
        rows = sorted(zip(seqs, held, ends, strict=True), key=lambda r: r[0])
        done, now = [], []
        for row in rows:
            now.append(row)
            if row[2]:
                done.append(kernel.convert(b"".join(r[1] for r in now), plan))
                now = []
        if now:
            state.update(tuple(list(x) for x in zip(*now, strict=True)))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"key": [keys[0]] * len(done), "content": done})

    named = stream.select(F.col(key).cast("string").alias("k"), F.col(order).cast("long").alias("o"), F.col(chunk).cast("binary").alias("c"), F.col(final).cast("boolean").alias("f"))
    return named.groupBy("k").applyInPandasWithState(run, "key string, content binary", "seqs array<long>, held array<binary>, ends array<boolean>", "append", GroupStateTimeout.NoTimeout)


def encode_chunks(stream: DataFrame, *options: str, key: str = "stream_id", order: str = "seq", chunk: str = "chunk", final: str = "final") -> DataFrame:
    """(key, content binary) of streams whose chunks are text (string); the options name the output."""
    return convert_chunks(stream, "-W", "-m0", "-x", *options, key=key, order=order, chunk=chunk, final=final)


def decode_chunks(stream: DataFrame, *options: str, key: str = "stream_id", order: str = "seq", chunk: str = "chunk", final: str = "final") -> DataFrame:
    """(key, content string) of streams whose chunks are bytes; the options name the input."""
    done = convert_chunks(stream, "-m0", "-x", *options, "-w", key=key, order=order, chunk=chunk, final=final)
    return done.withColumn("content", F.decode("content", "UTF-8"))


def write_encoded(stream: DataFrame, column: str, path: str, checkpoint: str, *options: str):
    """A streaming sink of the converted column: each micro-batch is a folder of its own, written anew if the batch is repeated."""

    def save(batch: DataFrame, number: int) -> None:
        convert_messages(batch, column, *options).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).start()
