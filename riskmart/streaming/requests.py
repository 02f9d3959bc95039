"""Answers to a stream of scoring requests: every request gets one, whether scored, reused or rejected."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from riskmart import constants as K
from riskmart.functions.scalars import record_key
from riskmart.operators.quality import validate_records
from riskmart.streaming.jobs import DRAIN, write_stream

# Value state with timers needs the state store that keeps columns apart.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
SCORED, REUSED, REJECTED = "scored", "reused", "rejected"
ANSWERED = "request_id string, event_time timestamp, status string, scored_by string, answer string"


class _Reuse(StatefulProcessor):
    """The answer of a record's last scored request, held for the reuse time.

    A request within the reuse time of the last scored one, by event time, gets that one's answer; any other is
    scored and is held from then on. One that arrives late, from before the last scored request, gets its answer as
    well: it is the newest there is. A timer, set to the reuse time after the arrival of the last scored request,
    clears what is no longer needed, so state holds the records of the last reuse time and not all ever seen.
    """

    def __init__(self, reuse: timedelta):
        self.reuse = reuse

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "scored_at timestamp, scored_by string, answer string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        requests = pd.concat(rows).sort_values(["event_time", "request_id"], ignore_index=True)
        at, by, answer = self.held.get() if self.held.exists() else (None, None, None)
        fresh, status, scored_by, answers = False, [], [], []
        for time, request, own in zip(requests["event_time"], requests["request_id"], requests["answer"]):
            if at is None or time - pd.Timestamp(at) >= self.reuse:
                at, by, answer, fresh = time, request, own, True
                status.append(SCORED)
            else:
                status.append(REUSED)
            scored_by.append(by)
            answers.append(answer)
        if fresh:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.held.update((pd.Timestamp(at).to_pydatetime(), by, answer))
            arrived = pd.Timestamp(requests["arrived"].max())
            self.handle.registerTimer(int((arrived + self.reuse).timestamp() * 1000))
        yield pd.DataFrame({"request_id": requests["request_id"], "event_time": requests["event_time"], "status": status,
                            "scored_by": scored_by, "answer": answers})

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.held.clear()
        yield from ()

    def close(self) -> None:
        pass


def answer_requests(requests: DataFrame, score: Callable[[DataFrame], DataFrame], request_id: str, event_time: str,
                    reuse: timedelta = timedelta(hours=1), inputs: Sequence[str] = K.FEATURES,
                    bounds: Mapping[str, tuple] = K.RECORD_BOUNDS) -> DataFrame:
    """One row per request: ``request_id, event_time, status, reasons, scored_by`` and the columns ``score`` adds.

    A request that breaks a bound is ``rejected`` with its ``reasons`` and no answer. Of valid requests with equal
    inputs one is ``scored``, and those within ``reuse`` of it get the same answer, ``reused``, even if the model has
    changed meanwhile; ``scored_by`` names the request whose answer it is. Requests of one time are taken in the order
    of their ids. No request is dropped, however late: the reuse time is judged by event time, and only the clearing of
    state follows the times of arrival, which carry the watermark. ``score`` is a plan of column expressions, cheaper than a look into the state, so all valid
    requests are scored and the state decides whose score they get. Rejected requests do not reach the state. The state
    of one record is kept by one task: rows there are a request's id, time and answer.

    Start it with :func:`write_answers`.
    """
    named = requests.select(F.col(request_id).cast("string").alias("request_id"), F.col(event_time).cast("timestamp").alias("event_time"), *inputs)
    valid, rejected = validate_records(named, bounds)
    scored = score(valid)
    gained = [f for f in scored.schema.fields if f.name not in valid.columns]
    rows = scored.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds").select(
        record_key(*inputs).alias("key"), "request_id", "event_time", "arrived",
        F.to_json(F.struct(*[f.name for f in gained]), {"ignoreNullFields": "false"}).alias("answer"))
    answered = rows.groupBy("key").transformWithStateInPandas(
        _Reuse(reuse), outputStructType=ANSWERED, outputMode="append", timeMode="eventTime")
    answer = {"type": "struct", "fields": [json.loads(f.json()) for f in gained]}
    answered = answered.withColumn("answer", F.from_json("answer", json.dumps(answer))).select(
        "request_id", "event_time", "status", F.array().cast("array<string>").alias("reasons"), "scored_by",
        *[F.col("answer")[f.name].alias(f.name) for f in gained])
    refused = rejected.select("request_id", "event_time", F.lit(REJECTED).alias("status"), "reasons", F.lit(None).cast("string").alias("scored_by"),
                              *[F.lit(None).cast(f.dataType).alias(f.name) for f in gained])
    return answered.unionByName(refused)


def write_answers(answers: DataFrame, target: str, checkpoint: str, trigger: Mapping = DRAIN) -> StreamingQuery:
    """Append the answers to a table, with the state store they need."""
    for name, value in STATE_STORE.items():
        answers.sparkSession.conf.set(name, value)
    return write_stream(answers, target, checkpoint, trigger)
