"""Outcome of attempts, history of messages, counters of workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetally.functions import domains as D


def outcome(ok: Column, retry_count: Column, max_retries: int = D.MAX_RETRIES) -> dict[str, Column]:
    """Target of an attempt, the retry count it leaves and the counters it moves.

    Every failure counts as retried, also the last one that goes to the dead letters.
    """
    after = F.when(ok, retry_count).otherwise(retry_count + 1)
    dead = ~ok & (after >= max_retries)
    return {
        "target": F.when(ok, "metrics").when(dead, "dead_letter").otherwise("retry"),
        "retry_count_after": after,
        "is_recovered": ok & (retry_count > 0),
        "is_retried": ~ok,
        "is_dead": dead,
    }


def route(attempts: DataFrame, max_retries: int = D.MAX_RETRIES) -> DataFrame:
    """Adds the outcome columns; `ok` and `retry_count` are required."""
    cols = outcome(F.col("ok"), F.col("retry_count"), max_retries)
    return attempts.select("*", *[c.alias(k) for k, c in cols.items()])


def messages_to_repeat(attempts: DataFrame, key: Column | str = "key", topics: dict[str, str] | None = None,
                       max_retries: int = D.MAX_RETRIES) -> DataFrame:
    """(key, value, topic) of the failed attempts: the message as JSON with the raised count, for the retry topic or,
    after its last try, for the dead letters."""
    topics = topics or {"retry": "retry", "dead_letter": "dead_letter"}
    key = F.col(key) if isinstance(key, str) else key
    routed = route(attempts, max_retries).where(~F.col("ok"))
    topic = F.coalesce(*[F.when(F.col("target") == t, F.lit(name)) for t, name in topics.items()])
    message = F.struct(*[F.col(c) for c in attempts.columns if c not in ("ok", "retry_count")],
                       F.col("retry_count_after").alias("retry_count"))
    return routed.select(key.cast("string").alias("key"), F.to_json(message).alias("value"), topic.alias("topic"))


def message_history(attempts: DataFrame, max_retries: int = D.MAX_RETRIES, also_by: list[Column] | None = None) -> DataFrame:
    """Final state of each message from its numbered attempts (1, 2, ...).

    A message ends with its first success or its last allowed failure; attempts
    after that do not belong to it. All facts are aggregates that do not depend on
    the order of rows, so the same function serves a table and a stream; a stream
    adds a time window in `also_by` to let old messages go.
    """
    first_ok = F.min(F.when(F.col("ok"), F.col("attempt")))
    facts = attempts.groupBy("uuid", *(also_by or [])).agg(
        first_ok.alias("_ok"), F.max("attempt").alias("_seen"), F.min("ts").alias("first_ts"),
        *[F.max(F.when(F.col("attempt") == i, F.col("ts"))).alias(f"_t{i}") for i in range(1, max_retries + 1)],
    )
    done = F.col("_ok") <= max_retries
    tries = F.when(done, F.col("_ok")).otherwise(F.least(F.col("_seen"), F.lit(max_retries)))
    last = F.element_at(F.array(*[F.col(f"_t{i}") for i in range(1, max_retries + 1)]), F.col("attempts"))
    state = (
        F.when(done & (F.col("_ok") == 1), "ok").when(done, "recovered")
        .when(F.col("_seen") >= max_retries, "dead_letter").otherwise("pending")
    )
    return (
        facts.withColumn("attempts", tries.cast("int")).withColumn("state", state)
        .select("uuid", "state", "attempts", "first_ts", last.alias("last_ts"))
    )


def worker_counters(attempts: DataFrame, worker: str, bad: Column | None = None) -> DataFrame:
    """Counters of each worker; `bad` marks messages that could not be read."""
    bad = F.lit(False) if bad is None else bad
    good = ~bad
    return route(attempts).groupBy(worker).agg(
        F.count_if(good & F.col("ok")).alias("processed"),
        F.count_if(good & F.col("is_retried")).alias("retried"),
        F.count_if(good & F.col("is_recovered")).alias("recovered"),
        F.count_if(good & F.col("is_dead")).alias("to_dlq"),
        F.count_if(bad).alias("errors"),
    )


def end_to_end_ms(done: Column, created: Column) -> Column:
    return (done - created) * 1000.0
