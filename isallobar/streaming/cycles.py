"""Streams of step arrivals and of front points.

Arrivals are rows (model, cycle, step, store, ts).  Nothing is dropped as late: a step that
fails is simply missing until it arrives.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from isallobar.operators import fronts
from isallobar.operators.kernels import along_km, haversine_km
from isallobar.plans import catalog


def six_hour_buckets(events: DataFrame, time: str = "ts", watermark: str | None = None) -> DataFrame:
    """Counts and sums of events in six-hour cycles; works on batches and streams."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, watermark) if watermark else timed
    return timed.groupBy(F.window(time, "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.rint(F.col("value") * 100).cast("long")).alias("cents")).select(F.col("w.start").alias("cycle"), "event_type", "n", "cents")


def publish_arrivals(arrivals: DataFrame, catalog_path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append newly arrived steps to a catalog table, each once.

    A step that the catalog has is skipped by an anti-join, so retries and repeated
    arrivals change nothing.  Without ``every`` the stream takes what is there and stops.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.select("model", "cycle", "step", "store").dropDuplicates(["model", "cycle", "step"])
        try:
            known = spark.read.parquet(catalog_path)
            fresh = fresh.join(known, ["model", "cycle", "step"], "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.withColumn("batch", F.lit(number)).write.mode("append").parquet(catalog_path)

    writer = arrivals.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def cycle_status(published: DataFrame) -> DataFrame:
    """How complete the cycles of a catalog table are."""
    return catalog.completeness(published)


FRONT_STATE = "waiting string, previous string, next_id long, last_step int"
TRACKED = "cycle timestamp, step int, front int, event_id string, parents array<string>"
POINT_COLUMNS = ("front", "grp", "line", "section", "front_type", "i", "lon", "lat")


def with_marks(points: DataFrame, steps: DataFrame) -> DataFrame:
    """Points (cycle, step, front, ...) and, for each good step of ``steps``, a row without a front.

    The mark says that a step is whole; a good step without fronts has nothing but its mark.
    """
    own = points.select("cycle", "step", *POINT_COLUMNS)
    return own.unionByName(steps.select("cycle", "step"), allowMissingColumns=True)


def tracked_stream(rows: DataFrame, settings: fronts.Settings = fronts.Settings(), keep: str = "2 days") -> DataFrame:
    """Event ids of fronts as their steps arrive (rows of :func:`with_marks`).

    A step's points wait in the state of their cycle until its mark comes, in whatever
    batches they arrive.  Then the step is compared with the last good one: its fronts, thinned
    to the points that are compared, and the next free number are the state.  A good step
    without fronts ends all events, as in the batch plan.  A step whose mark comes after a
    later one has been tracked is compared with nothing and gets new ids.  The state of a
    cycle goes once a cycle has come that is newer by more than ``keep``.
    """

    def summary(points: list[list]) -> list[dict]:
        out = []
        part = pd.DataFrame(points, columns=list(POINT_COLUMNS)).sort_values(["front", "line", "section", "i"])
        for number, own in part.groupby("front"):
            km = sum(along_km(s["lon"].to_numpy(), s["lat"].to_numpy())[-1] for _, s in own.groupby(["line", "section"]))
            thin = own.iloc[:: settings.match_step]
            out.append({"front": int(number), "grp": int(own["grp"].iloc[0]), "types": sorted(set(own["front_type"])), "km": float(km), "lon": thin["lon"].tolist(), "lat": thin["lat"].tolist()})
        return out

    def interest(a: dict, b: dict) -> float:
        if a["grp"] != b["grp"]:
            return 0.0
        short, long = sorted((a, b), key=lambda f: f["km"])
        far = sum(min(haversine_km(x, y, long["lon"], long["lat"])) for x, y in zip(short["lon"], short["lat"], strict=True)) / len(short["lon"])
        if far >= settings.match_km:
            return 0.0
        shared = len(set(a["types"]) & set(b["types"])) / len(set(a["types"]) | set(b["types"]))
        clues = (1 - far / settings.match_km, short["km"] / long["km"] if long["km"] else 0.0, shared)
        return sum(w * c for w, c in zip(settings.match_weights, clues, strict=True)) / sum(settings.match_weights)

    def take(key: tuple[datetime], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else ("{}", "[]", 0, -1)
        waiting, previous, last = json.loads(held[0]), json.loads(held[1]), held[3]
        counter = itertools.count(held[2])
        fresh = (f"front_{n:04d}" for n in counter)
        marks: set[int] = set()
        for batch in batches:
            marks |= set(batch.loc[batch["front"].isna(), "step"].astype(int).tolist())
            for at, some in batch[batch["front"].notna()].groupby("step"):
                waiting.setdefault(str(int(at)), []).extend(some[list(POINT_COLUMNS)].to_numpy(dtype=object).tolist())
        out = []
        for at in sorted(marks):
            found = summary(waiting.pop(str(at), []))
            before = previous if at > last else []
            pairs = [(s, i, j) for i, a in enumerate(before) for j, b in enumerate(found) if (s := interest(a, b)) >= settings.match_least]
            ids, parents = fronts.assign_events([a["event_id"] for a in before], len(found), pairs, fresh)
            out += [(key[0], at, f["front"], e, p) for f, e, p in zip(found, ids, parents, strict=True)]
            if at > last:
                previous, last = [f | {"event_id": e} for f, e in zip(found, ids, strict=True)], at
        state.update((json.dumps(waiting), json.dumps(previous), next(counter), last))
        state.setTimeoutTimestamp(pd.Timestamp(key[0]).value // 10**6 + 1000)  # of the watermark, which is ``keep`` behind
        yield pd.DataFrame(out, columns=["cycle", "step", "front", "event_id", "parents"])

    timed = rows.withWatermark("cycle", keep)
    return timed.groupBy("cycle").applyInPandasWithState(take, TRACKED, FRONT_STATE, "append", GroupStateTimeout.EventTimeTimeout)
