"""Structured Streaming over turns and events: watermarked de-duplication, progress, dialogue runs, cutoffs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from colloquy.operators.prefix import running_before
from colloquy.session import checkpoint_dir, cut


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of a folder's parquet rows with the schema it has now; written as a pattern, so that a file will do too."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(f"{path[:-1]}[{path[-1]}]")


def run_available(stream: DataFrame, mode: str = "append", each: Callable[[DataFrame, int, str], DataFrame] | None = None) -> DataFrame:
    """Runs the stream over what is there now and gives what it wrote. Each batch is written to its own folder, so one
    that is repeated after a failure replaces itself; in update mode the caller takes the last batch of a key. ``each``
    makes of a batch, its number and the run's folder the rows to write, with the columns of the stream."""
    spark = stream.sparkSession
    folder = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def save(batch: DataFrame, number: int) -> None:
        (each(batch, number, folder) if each else batch).withColumn("__batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(save).start().awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").schema(stream.schema.add("__batch", T.IntegerType())).parquet(f"{folder}/out")


def run_to_end(rows: DataFrame, operator: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """As run_available(), of ``operator`` over the rows and, after all that are there now, a mark of the end for each
    ``key``: a row with nulls in its other columns. The marks are a second source, empty in the first run; the query then
    goes on from its checkpoint with the marks of the keys that came."""
    spark = rows.sparkSession
    folder = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    marks, kinds = f"{folder}/marks", rows.schema
    nothing = spark.createDataFrame([], T.StructType([kinds[key]]))
    nothing.write.parquet(marks)
    ends = spark.readStream.schema(nothing.schema).parquet(marks).select(*[F.col(c.name) if c.name == key else F.lit(None).cast(c.dataType).alias(c.name) for c in kinds])

    def seen(batch: DataFrame, number: int) -> None:
        batch.select(key).distinct().write.mode("overwrite").parquet(f"{folder}/keys/batch={number}")

    stream = operator(rows.unionByName(ends))

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("__batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    def run(what: DataFrame, name: str, each: Callable[[DataFrame, int], None]) -> None:
        what.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/{name}").trigger(availableNow=True).foreachBatch(each).start().awaitTermination()

    run(stream, "checkpoint", save)
    run(rows.select(key), "checkpoint-keys", seen)
    spark.read.option("recursiveFileLookup", "true").schema(nothing.schema).parquet(f"{folder}/keys").where(F.col(key).isNotNull()).distinct().write.mode("append").parquet(marks)
    run(stream, "checkpoint", save)
    return spark.read.option("recursiveFileLookup", "true").schema(stream.schema.add("__batch", T.IntegerType())).parquet(f"{folder}/out")


def once(rows: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Rows whose keys weren't seen within the watermark's delay: state is bounded by it."""
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def progress(rows: DataFrame, key: str, amount: str) -> DataFrame:
    """Rows and sum of ``amount`` per key, for update mode."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.sum(amount).alias("amount"))


def last_of(batches: DataFrame, key: str) -> DataFrame:
    """The last state of each key of what update mode wrote."""
    rest = [c for c in batches.columns if c not in (key, "__batch")]
    return batches.groupBy(key).agg(F.max_by(F.struct(*rest), "__batch").alias("r")).select(key, "r.*")


RUN = "episode_key string, group_no bigint, run_no bigint, n_turns bigint, speaker_a string, speaker_b string, start_ms bigint, end_ms bigint"
STATE = "group_no bigint, run_no bigint, n_turns bigint, speaker_a string, speaker_b string, start_ms bigint, end_ms bigint"


def dialogue_runs(turns: DataFrame, gap_ms: int, idle: tuple[str, int] | None = None) -> DataFrame:
    """Runs of two speakers as they close, for append mode. ``turns``: episode_key, turn_id, speaker, start_ms, end_ms;
    they arrive in order of time across batches and are sorted within one. State is one open run an episode. The last run
    of an episode closes with a turn whose speaker is null, the mark of its end, which also ends its state.

    ``idle``: the column of the turns' watermark, and for how many ms after its last turn an episode may go on; when the
    watermark is past that, its run closes and its state ends, mark or not, so that state is bounded by the episodes under
    way. None: an episode without a mark stays open. A timeout by processing time would keep a stream of what is available
    now from ending."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = list(state.get) if state.exists else None
        out: list[tuple] = []

        def close() -> None:
            if now is not None and now[4] is not None:
                a, b = sorted((now[3], now[4]))
                out.append((key[0], now[0], now[1], now[2], a, b, now[5], now[6]))

        if state.hasTimedOut:
            close()
            state.remove()
            yield pd.DataFrame(out, columns=[x.split()[0] for x in RUN.split(", ")])
            return
        own = pd.concat(list(frames)).sort_values(["start_ms", "turn_id"], kind="stable")
        marks = own["speaker"].isna()
        for speaker, mark, start, end in zip(own["speaker"].tolist(), marks.tolist(), own["start_ms"].fillna(0).astype("int64").tolist(), own["end_ms"].fillna(0).astype("int64").tolist(), strict=True):
            if mark:
                close()
                now = None
                continue
            if now is None:
                now = [0, 0, 1, speaker, None, start, end]
            elif start - now[6] >= gap_ms:
                close()
                now = [now[0] + 1, 0, 1, speaker, None, start, end]
            elif speaker in (now[3], now[4]) or now[4] is None:
                now[2], now[6] = now[2] + 1, end
                now[4] = speaker if now[4] is None and speaker != now[3] else now[4]
            else:
                close()
                now = [now[0], now[1] + 1, 1, speaker, None, start, end]
        if now is not None:
            state.update(tuple(now))
            if idle is not None:
                state.setTimeoutTimestamp(max(int(own[idle[0]].max().timestamp() * 1000), state.getCurrentWatermarkMs()) + idle[1])
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=[x.split()[0] for x in RUN.split(", ")])

    rows = turns.select("episode_key", "turn_id", F.col("speaker").cast("string").alias("speaker"), "start_ms", "end_ms", *([idle[0]] if idle else []))
    return rows.groupBy("episode_key").applyInPandasWithState(step, RUN, STATE, "append", GroupStateTimeout.EventTimeTimeout if idle else GroupStateTimeout.NoTimeout)


#: Values of an integer order in a cell of until_target().
CELL = 1 << 16


def until_target(rows: DataFrame, key: str, order: str, amount: str, target: int, cell: Column | None = None) -> DataFrame:
    """Runs the stream over what is there now and gives the rows before which a key's sum of ``amount`` (null: 0) is below
    ``target``; the row that crosses it still passes. Within a batch rows count in order of ``order`` (null: last), however
    many a key has; ``cell`` divides that order into stretches, for integers those of CELL values. Kept from batch to
    batch is one sum a key, each batch's in a folder of its own."""
    picked = rows.select(key, order, amount)
    at = F.coalesce(F.floor(F.col(order) / CELL) if cell is None else cell, F.lit((1 << 63) - 1))

    def passing(batch: DataFrame, number: int, folder: str) -> DataFrame:
        # a struct, as a null key is one, too; cut: what a stream's batch comes from must run only once
        new = cut(batch.select(F.struct(key).alias("__key"), key, order, amount, F.coalesce(amount, F.lit(0)).alias("__amount"), at.cast("bigint").alias("__cell")))
        sums = new.select("__key", "__amount")
        if number:
            # the sum so far goes before all rows of its key
            earlier = batch.sparkSession.read.parquet(f"{folder}/sums/batch={number - 1}")
            sums = sums.unionByName(earlier)
            new = new.withColumn("__new", F.lit(True)).unionByName(earlier.withColumn("__cell", F.lit(-1 << 63).cast("bigint")), allowMissingColumns=True)
        else:
            new = new.withColumn("__new", F.lit(True))
        sums.groupBy("__key").agg(F.sum("__amount").alias("__amount")).write.mode("overwrite").parquet(f"{folder}/sums/batch={number}")
        summed = running_before(new, ["__key"], "__cell", [F.col(order), F.col(amount)], F.col("__amount"), "__before")
        return summed.where(F.col("__new") & (F.col("__before") < target)).select(key, order, amount)

    return run_available(picked, each=passing).drop("__batch")
