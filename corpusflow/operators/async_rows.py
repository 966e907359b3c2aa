"""Rows answered by coroutines: requests to a service, many at a time, within Spark tasks."""

from __future__ import annotations

import asyncio
import inspect
import random
import threading
from collections import deque
from collections.abc import Awaitable, Callable, Coroutine, Iterator, Mapping, Sequence
from concurrent.futures import Future
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusflow.functions.text import render_messages, strip_trailing_stop
from corpusflow.operators.tokens import token_length
from corpusflow.session import checkpointed

#: Requests of one task that run at the same time; all tasks together have as many times more.
IN_FLIGHT = 16
#: Rows, as a multiple of that, which wait behind a slow one for their turn to be given out.
AHEAD = 8
#: Rows of an Arrow batch that is given out.
BATCH = 256

Ask = Callable[[Any, Mapping[str, Any]], Awaitable[Mapping[str, Any]]]


class Stream:
    """An event loop of its own, which goes on while the task waits for rows; answers in the order of the rows."""

    def __init__(
        self,
        open_client: Callable[[], Any],
        ask: Ask,
        in_flight: int,
        timeout: float | None,
        retries: int,
        wait: float,
        number: str | None = None,
    ) -> None:
        self.ask, self.timeout, self.retries, self.wait, self.number = ask, timeout, retries, wait, number
        self.ahead, self.exit = in_flight * AHEAD, None
        self.loop = asyncio.new_event_loop()
        self.thread = threading.Thread(target=self.loop.run_forever, daemon=True)
        self.thread.start()
        self.queue: deque[Future] = deque()
        self.slots = asyncio.Semaphore(in_flight)
        try:
            self.client = self._start(self._opened(open_client)).result()
        except BaseException:
            self.close()
            raise

    def _start(self, work: Coroutine) -> Future:
        return asyncio.run_coroutine_threadsafe(work, self.loop)

    async def _opened(self, open_client: Callable[[], Any]) -> Any:
        made = open_client()
        if hasattr(made, "__aexit__"):
            entered = await made.__aenter__()
            self.exit = made.__aexit__
            return entered
        return await made if inspect.isawaitable(made) else made

    async def _answer(self, row: Mapping[str, Any]) -> tuple[Mapping[str, Any] | None, str | None, int]:
        """(answer, error, attempts); others may use the slot while a failed row waits for its next attempt."""
        error = None
        for attempt in range(self.retries + 1):
            if attempt:
                await asyncio.sleep(self.wait * 2 ** (attempt - 1) * (1 + random.random() / 4))
            asked = row if self.number is None else {**row, self.number: attempt + 1}
            async with self.slots:
                try:
                    return await asyncio.wait_for(self.ask(self.client, asked), self.timeout), None, attempt + 1
                except Exception as problem:  # noqa: BLE001 - whatever a service does belongs to its row
                    error = f"{type(problem).__name__}: {problem}"
        return None, error, self.retries + 1

    def put(self, row: Mapping[str, Any]) -> Iterator[tuple]:
        """Start a row; give out what is done at the head, and wait for the head where too many stand behind it."""
        self.queue.append(self._start(self._answer(row)))
        yield from self.done(self.ahead)

    def done(self, leave: int) -> Iterator[tuple]:
        while self.queue and (len(self.queue) > leave or self.queue[0].done()):
            yield self.queue.popleft().result()

    def close(self) -> None:
        for future in self.queue:
            future.cancel()
        if self.exit is not None:
            self._start(self.exit(None, None, None)).result()
        self.loop.call_soon_threadsafe(self.loop.stop)
        self.thread.join()
        self.loop.close()


def map_async(
    df: DataFrame,
    open_client: Callable[[], Any],
    ask: Ask,
    answer: str | StructType,
    columns: Sequence[str] | None = None,
    in_flight: int = IN_FLIGHT,
    timeout: float | None = None,
    retries: int = 0,
    wait: float = 1.0,
    error: str = "error",
    attempts: str = "attempts",
    once: bool = True,
    number: str | None = None,
) -> DataFrame:
    """All columns, those of ``answer`` (a schema), and ``error`` and ``attempts``.

    Every task opens a client (a value, an awaitable or an async context manager) and awaits
    ``ask(client, row)``, a mapping with the fields of ``answer``, for each row, ``row`` having ``columns``
    (all, if None). At most ``in_flight`` requests of a task run at once, over the borders of batches too; an attempt
    ends after ``timeout`` seconds, and a row has ``retries`` more, after ``wait`` seconds that double. A row
    whose attempts all fail keeps null answers and the last error: it is not lost, and it does not end the
    job. Rows come out in the order in which they went in. With ``number``, ``row`` also holds the number of
    the attempt under that name, from 1: a client that counts for itself cannot tell rows that are equal.

    A service need not answer twice alike, and asking costs: with ``once`` the answers are written down, and what is
    derived from the result asks no one again.
    """
    answer = answer if isinstance(answer, StructType) else StructType.fromDDL(answer)
    extra = [*answer.fields, StructField(error, StringType()), StructField(attempts, LongType())]
    clash = {f.name for f in extra} & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    schema = StructType([*df.schema.fields, *extra])
    names = [f.name for f in answer.fields]
    types = [field.type for field in to_arrow_schema(answer)]
    asked = list(df.columns if columns is None else columns)
    if number in asked:
        raise ValueError(f"column exists already: {number}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(open_client, ask, in_flight, timeout, retries, wait, number)
        waiting: deque[tuple[pa.RecordBatch, int]] = deque()  # rows not yet given out, as (batch, row)
        out: list[tuple] = []

        def given() -> pa.RecordBatch:
            rows = [waiting.popleft() for _ in out]
            parts, low = [], 0
            for i in range(1, len(rows) + 1):
                if i == len(rows) or rows[i][0] is not rows[low][0]:
                    parts.append(rows[low][0].slice(rows[low][1], i - low))
                    low = i
            table = pa.Table.from_batches(parts).combine_chunks()
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns]
            values = [pa.array([None if a is None else a.get(n) for a, _, _ in out], t) for n, t in zip(names, types)]
            tail = [pa.array([e for _, e, _ in out], pa.string()), pa.array([n for _, _, n in out], pa.int64())]
            out.clear()
            return pa.RecordBatch.from_arrays([*columns, *values, *tail], names=schema.names)

        try:
            for batch in batches:
                picked = batch.select(asked)
                for i in range(batch.num_rows):
                    waiting.append((batch, i))
                    for result in stream.put(picked.slice(i, 1).to_pylist()[0]):
                        out.append(result)
                        if len(out) == BATCH:
                            yield given()
            for result in stream.done(0):
                out.append(result)
                if len(out) == BATCH:
                    yield given()
            if out:
                yield given()
        finally:
            stream.close()

    answered = df.mapInArrow(run, schema)
    return checkpointed(answered) if once else answered


def complete(
    df: DataFrame,
    open_client: Callable[[], Any],
    generate: Callable[..., Awaitable[str]],
    prompt: str = "prompt",
    stops: Sequence[str] = ("<|endoftext|>",),
    out: str = "completion",
    length: str = "token_length",
    count: Callable[[Column], Column] = token_length,
    numbered: bool = False,
    **options,
) -> DataFrame:
    """Completions of prompts, each sent as a chat of one turn: stop strings taken off the end, tokens counted.

    ``generate(client, text)`` gives the completion, or ``generate(client, text, attempt)`` if ``numbered``, attempts
    counted from 1 for each row; a null prompt is not sent. Errors and options as in ``map_async``.
    """
    chat = render_messages(F.array(F.struct(F.lit("user").alias("role"), F.col(prompt).alias("text"))))
    sent = df.withColumn("_chat", F.when(F.col(prompt).isNotNull(), chat))

    async def ask(client: Any, row: Mapping[str, Any]) -> Mapping[str, Any]:
        if row["_chat"] is None:
            return {out: None}
        return {out: await generate(client, row["_chat"], *([row["_attempt"]] if numbered else []))}

    number = "_attempt" if numbered else None
    answered = map_async(sent, open_client, ask, f"`{out}` string", ["_chat"], number=number, **options).drop("_chat")
    cleaned = strip_trailing_stop(F.col(out), stops)
    return answered.withColumn(out, cleaned).withColumn(length, F.when(F.col(out).isNotNull(), count(F.col(out))))
