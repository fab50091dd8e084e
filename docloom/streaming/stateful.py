"""Keyed state that outlives batches and restarts: ratings in order of time, downloads with retries."""

from __future__ import annotations

import time as clock
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def keep_state_on_disk(spark: SparkSession) -> None:
    """These operators need the state store that lives on disk; the setting stays in the session, as it holds when a stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Ratings(StatefulProcessor):
    """Of a pair of rivals: the ratings after all matches that the watermark has passed (a value), and the matches that may still be overtaken (a list)."""

    def __init__(self, key: str, k: float, start: float) -> None:
        self.key, self.k, self.start = key, k, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", "rating_a double, rating_b double, n_matches int")
        self.waiting = handle.getListState("waiting", "at bigint, seq bigint, score double")

    def folded(self, state: tuple[float, float, int], matches: list[tuple[int, int, float]]) -> tuple[float, float, int]:
        a, b, n = state
        for _, _, score in matches:
            change = self.k * (score - 1.0 / (1.0 + 10.0 ** ((b - a) / 400.0)))
            a, b, n = a + change, b - change, n + 1
        return a, b, n

    def settle(self, matches: list[tuple[int, int, float]], watermark: int) -> tuple[float, float, int]:
        """Folds what the watermark has passed, keeps the rest, and gives the ratings with the rest on top."""
        state = tuple(self.settled.get()) if self.settled.exists() else (self.start, self.start, 0)
        matches.sort()
        done = [m for m in matches if m[0] <= watermark]
        rest = matches[len(done) :]
        if done:
            state = self.folded(state, done)
            self.settled.update(state)
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(rest[0][0])
        else:
            self.waiting.clear()
        return self.folded(state, rest)

    def row(self, key: tuple, ratings: tuple[float, float, int]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *ratings)], columns=[self.key, "rating_a", "rating_b", "n_matches"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        matches = [tuple(m) for m in self.waiting.get()] if self.waiting.exists() else []
        for frame in rows:
            matches += zip(frame["at_ms"].tolist(), frame["place"].tolist(), frame["result"].tolist(), strict=True)
        yield self.row(key, self.settle(matches, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        matches = [tuple(m) for m in self.waiting.get()] if self.waiting.exists() else []
        self.settle(matches, timerValues.getCurrentWatermarkInMs())
        return iter([])

    def close(self) -> None:
        pass


def rating_stream(matches: DataFrame, key: str, time: str, seq: str, score: str, k: float = 32.0, start: float = 1500.0, delay: str = "1 hour") -> DataFrame:
    """(key, rating_a, rating_b, n_matches) of a pair after each batch that has matches of it.

    Ratings are those of a fold in order of time, then seq, then score, however
    late and in whatever order matches come within the delay: a match counts for
    good when the watermark passes it, and until then the fold is done anew over
    those that wait. Matches that come later than the delay are left out, as by
    every operator with a watermark. Null scores are draws.
    """
    keep_state_on_disk(matches.sparkSession)
    kind = matches.schema[key].dataType.simpleString()
    at = F.unix_millis(F.col(time))
    rows = matches.withWatermark(time, delay).select(key, time, at.alias("at_ms"), F.col(seq).cast("bigint").alias("place"), F.coalesce(F.col(score).cast("double"), F.lit(0.5)).alias("result"))
    return rows.groupBy(key).transformWithStateInPandas(Ratings(key, k, start), f"`{key}` {kind}, rating_a double, rating_b double, n_matches int", "Update", "EventTime")


class Downloads(StatefulProcessor):
    """Of a URL: how often it was tried, and whether that came to an end."""

    def __init__(self, fetch: Callable[[str], str], tries: int, pause_ms: int) -> None:
        self.fetch, self.tries, self.pause_ms = fetch, tries, pause_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "tries int, status string")

    def attempt(self, url: str, before: int, now: int) -> Iterator[pd.DataFrame]:
        """One try: an answer or the last failure is a row; after another failure a timer is set, twice as far away as the one before."""
        body = error = None
        try:
            body = self.fetch(url)
        except Exception as failed:  # noqa: BLE001  whatever a fetcher raises is a failed try
            error = f"{type(failed).__name__}: {failed}"
        status = "done" if error is None else "rejected" if before + 1 >= self.tries else "waiting"
        self.state.update((before + 1, status))
        if status == "waiting":
            self.handle.registerTimer(now + self.pause_ms * 2**before)
        else:
            yield pd.DataFrame([(url, status, before + 1, body, error)], columns=["url", "status", "tries", "body", "error"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:  # a URL is fetched once, however often it is asked for
            pass
        if not self.state.exists():
            yield from self.attempt(key[0], 0, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tries, status = self.state.get()
        if status == "waiting":
            yield from self.attempt(key[0], tries, timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def download_stream(urls: DataFrame, fetch: Callable[[str], str], tries: int = 3, pause: float = 1.0, url: str = "url") -> DataFrame:
    """(url, status, tries, body, error) of each URL of a stream, once: done, or rejected after so many failed tries.

    fetch runs where the URL's state lies and raises if it fails; then it is
    tried again after pause seconds, twice that, and so on. What was visited and
    what waits is state of the stream, so a restart goes on with it. URLs are
    taken as they are: normalize them first.
    """
    keep_state_on_disk(urls.sparkSession)
    rows = urls.select(F.col(url).alias("url")).where("url is not null")
    return rows.groupBy("url").transformWithStateInPandas(Downloads(fetch, tries, int(pause * 1000)), "url string, status string, tries int, body string, error string", "Append", "ProcessingTime")


def download(urls: DataFrame, fetch: Callable[[str], str], out: str, checkpoint: str, seconds: float, tries: int = 3, pause: float = 1.0, every: str = "1 second") -> None:
    """Works off a stream of URLs for so many seconds: answers go to out/status=done, those given up to out/status=rejected, a folder for each batch.

    Started again with the same checkpoint it goes on where it ended.
    """
    stream = download_stream(urls, fetch, tries, pause)
    query = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime=every).foreachBatch(lambda rows, n: rows.write.mode("overwrite").partitionBy("status").parquet(f"{out}/batch={n}")).start()
    try:
        query.awaitTermination(int(seconds))
        deadline = clock.time() + 60
        while query.status["isTriggerActive"] and clock.time() < deadline:
            clock.sleep(0.1)
    finally:
        query.stop()
