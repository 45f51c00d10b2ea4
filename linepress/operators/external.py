"""Outside programs and Python callables over lines of documents."""

from __future__ import annotations

import os
import queue
import signal
import subprocess
import threading
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pipe_lines(lines: DataFrame, command: str, text: str = "text") -> DataFrame:
    """lines with text replaced by what the shell command writes for it: one line in, one line out, one process per task.

    A thread feeds the whole task's lines to the process while its output is read, so commands that write in blocks work
    too; the pipes' own limits hold the feeder back. Null counts as an empty line; newlines inside a text are written as
    spaces. A command that ends early, fails or writes more is an error.
    """
    at = lines.columns.index(text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = subprocess.Popen(command, shell=True, stdin=subprocess.PIPE, stdout=subprocess.PIPE, start_new_session=True)
        waiting: queue.SimpleQueue = queue.SimpleQueue()

        def feed() -> None:
            try:
                for b in batches:
                    raw = "".join((t or "").replace("\n", " ") + "\n" for t in b.iloc[:, at]).encode("utf-8", "surrogatepass")
                    waiting.put(b)
                    p.stdin.write(raw)
                p.stdin.close()
            except (BrokenPipeError, ValueError):
                pass  # the reader reports that the command has ended
            except BaseException as e:  # noqa: BLE001 - raised again by the reader
                waiting.put(e)
            finally:
                waiting.put(None)

        threading.Thread(target=feed, daemon=True).start()
        try:
            while (b := waiting.get()) is not None:
                if isinstance(b, BaseException):
                    raise b
                out = []
                for _ in range(len(b)):
                    line = p.stdout.readline()
                    if not line:
                        raise RuntimeError(f"the command ended early: {command}")
                    out.append(line.removesuffix(b"\n").decode("utf-8", "replace"))
                b = b.copy()
                b.isetitem(at, out)
                yield b
            if p.stdout.readline() or p.wait(timeout=600):
                raise RuntimeError(f"the command failed or wrote more lines than it read: {command}")
        finally:
            try:
                os.killpg(p.pid, signal.SIGKILL)
            except ProcessLookupError:
                pass

    return lines.mapInPandas(run, lines.schema)


def split_documents(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row_id, line_no (from 0), text: the lines of each document; a null text has none."""
    return docs.filter(F.col(text).isNotNull()).select(row_id, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "text"))


def join_documents(lines: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """row_id, text: the lines of each document in order, joined by newlines; bounded by the size of a document."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "text")))
    return lines.groupBy(row_id).agg(ordered.alias("l")).select(row_id, F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("text"))


def pipe_documents(docs: DataFrame, command: str, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents whose lines went through command, put together again."""
    return join_documents(pipe_lines(split_documents(docs, row_id, text), command), row_id)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema, allow_empty: bool = True) -> DataFrame:
    """fn over batches of rows in parallel; an empty input raises unless allow_empty."""
    if not allow_empty and df.isEmpty():
        raise ValueError("empty input")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    return df.mapInPandas(run, schema)


def with_next(df: DataFrame, key: str, order: str, column: str, out: str) -> DataFrame:
    """The value of column in the next row of the same key."""
    return df.withColumn(out, F.lead(column).over(Window.partitionBy(key).orderBy(order)))
