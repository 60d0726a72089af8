"""Streams of records: micro-batches appended to the log, and chunks of a search session."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..plans.store import Store
from ..plans.versions import Folder
from ..shared import dropped, running_total, saved


def query_id(spark, checkpoint: str) -> str:
    """The id of a streaming query, which its checkpoint keeps over restarts."""
    return json.loads(Folder(spark, checkpoint).read("metadata"))["id"]


class Sink:
    """Commits the micro-batches of a stream to a store, each record once.

    The store's versions note, under the stream's name, the query and its last whole epoch. An epoch that is run again changes
    nothing. Where an epoch may have been stored in part, or the stream has been read by another query (a new checkpoint), its
    records are known by their place (seq as the source gave it), and only those that aren't there are stored."""

    def __init__(self, spark, path: str, name: str, query: str, source: str | None = None, commit_items: int | None = None):
        if commit_items is not None and commit_items < 1:
            raise ValueError("commit_items must be positive")
        self.store, self.name, self.query, self.source, self.commit_items = Store(spark, path), name, query, source, commit_items

    def put(self, batch: DataFrame, epoch: int) -> None:
        """Waits for the lease, so that writers of one store take turns."""
        with self.store.writing(600):
            mark = self.store.state()["marks"].get(self.name)
            same = bool(mark) and mark["query"] == self.query
            if same and epoch <= mark["epoch"]:
                return
            shared = bool(mark) and (mark["shared"] or not same)
            note = {"query": self.query, "epoch": epoch - 1, "shared": shared, "open": epoch}
            rows = batch.withColumns({"stream": F.lit(self.name), "place": F.col("seq").cast("long")})
            if shared or (same and mark["open"] == epoch):
                there = self.store.log().where(F.col("stream") == self.name).select("place").unionByName(self._refused())
                rows = rows.join(there.distinct(), "place", "left_anti")
            done = note | {"epoch": epoch, "open": None}
            if self.commit_items is None:
                self._append(rows, f"{epoch}", done)
                return
            rows = saved(rows, "stream-epoch")
            places = running_total(rows.select("place").where("place is not null").distinct().withColumn("_one", F.lit(1)), "place", "_one", "_rank")
            ranked = saved(rows.join(places.drop("_one"), "place", "left").withColumn("_part", F.floor((F.coalesce("_rank", F.lit(1)) - 1) / self.commit_items).cast("long")), "stream-parts")
            last = ranked.agg(F.max("_part")).first()[0] or 0
            for k in range(last + 1):  # a commit for each commit_items records
                self._append(ranked.where(F.col("_part") == k).drop("_part", "_rank"), f"{epoch}.{k}", note if k < last else done)
            dropped(rows, ranked)

    def _refused(self) -> DataFrame:
        """Places of records that were refused: they aren't in the log, and needn't be counted again."""
        return self.store.rejects().where(F.col("stream") == self.name).select("place")

    def _append(self, rows: DataFrame, part: str, mark: dict) -> None:
        """The mark says what is stored, so a batch's name need only be its own: the version that it is made on is part of it."""
        self.store.append(rows, f"stream {self.name} {part} on {self.store.newest()}", self.source, {self.name: mark})


def append_to_log(records: DataFrame, store_path: str, checkpoint: str, source: str | None = None, name: str | None = None, commit_items: int | None = None):
    """A started query that commits each micro-batch to a store, or a part of it for each commit_items records: a reader sees all
    of a commit or none, rejects are counted and listed, and no record is stored twice, whatever stops and goes on. seq goes on
    behind what is stored. A stream with a name is one stream under any checkpoint: records with the same seq as stored ones are
    known. Without a name each checkpoint is a stream of its own."""
    spark, sinks = records.sparkSession, {}
    if name is not None and "seq" not in records.columns:
        raise ValueError("the records of a named stream need seq, their place in it")

    def put(batch: DataFrame, epoch: int) -> None:
        if not sinks:
            query = query_id(spark, checkpoint)
            sinks[0] = Sink(spark, store_path, name or query, query, source, commit_items)
        sinks[0].put(batch if "seq" in batch.columns else batch.withColumn("seq", F.monotonically_increasing_id()), epoch)

    return records.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_log(spark, store_path: str) -> DataFrame:
    return Store(spark, store_path).log()


def session_chunks(cards: DataFrame, target: int, session_col: str = "session", id_col: str = "identity") -> DataFrame:
    """A stream of (session, identity) as the cards that are new in their session, with rank, until target ranks are out.
    State is a session's ids, which its target bounds."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = list(state.get[0]) if state.exists else []
        known, new = set(seen), []
        for pdf in batches:
            for i in pdf[id_col]:
                if i not in known and len(seen) + len(new) < target:
                    known.add(i)
                    new.append(i)
        state.update((seen + new,))
        yield pd.DataFrame({session_col: [key[0]] * len(new), id_col: new, "rank": range(len(seen) + 1, len(seen) + len(new) + 1)})

    return cards.groupBy(session_col).applyInPandasWithState(step, f"{session_col} string, {id_col} string, rank long", "ids array<string>", "append", GroupStateTimeout.NoTimeout)


#: Why a search session ends: fixed values.
EMPTY, ENOUGH, ROUNDS = "empty_search", "max_results", "max_scroll_rounds"
SESSION_ROWS = "session string, identity string, rank long, chunk long, total_unique long, returned_total long, scrolls_completed long, stop_reason string"


class Session(StatefulProcessor):
    """A search session's cards over any number of batches: which are new, and why it stops. Its state is its ids (at most those of
    the round in which it reaches its target, so the target and a page bound it), the last round and the reason."""

    def __init__(self, target: int, max_rounds: int, chunk: int):
        self.target, self.max_rounds, self.chunk = target, max_rounds, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ids = handle.getListState("ids", "identity string")
        self.at = handle.getValueState("at", "round long, reason string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, reason = self.at.get() if self.at.exists() else (-1, None)
        if reason:
            return
        seen = dict.fromkeys(r[0] for r in self.ids.get()) if self.ids.exists() else {}
        before, out = len(seen), []
        cards = pd.concat(list(rows)).sort_values(["round", "seq"], kind="stable")
        for number, page in cards.groupby("round", sort=True):
            if number > self.max_rounds:
                break
            found = [i for i in page["identity"] if isinstance(i, str)]
            last = max(last, int(number))
            if last == 0 and not found and not seen:
                reason = EMPTY
                break
            for i in found:
                if i not in seen:
                    seen[i] = None
                    if len(seen) <= self.target:
                        out.append((key[0], i, len(seen), (len(seen) - 1) // self.chunk, None, None, None, None))
            if len(seen) >= self.target:
                reason = ENOUGH
                break
        if not reason and last >= self.max_rounds:
            reason = ROUNDS
        new = list(seen)[before:]
        if new:
            self.ids.appendList([(i,) for i in new])
        self.at.update((last, reason))
        if reason:
            out.append((key[0], None, None, None, len(seen), min(len(seen), self.target), last, reason))
        yield pd.DataFrame(out, columns=["session", "identity", "rank", "chunk", "total_unique", "returned_total", "scrolls_completed", "stop_reason"]).astype({c: "Int64" for c in ("rank", "chunk", "total_unique", "returned_total", "scrolls_completed")})

    def close(self) -> None:
        pass


def _checked(target: int, max_rounds: int, chunk: int) -> None:
    if not (1 <= max_rounds <= 5000 and target >= 1 and chunk >= 1):
        raise ValueError("max_rounds is 1 to 5000; target and chunk are positive")


def sessions(cards: DataFrame, target: int, max_rounds: int = 250, chunk: int = 50) -> DataFrame:
    """A stream of (session, round, seq, identity) as SESSION_ROWS: each card that is new in its session, up to target, with its rank
    and chunk; and a row without identity when the session stops, with its figures and the reason: its first page was empty
    (a row without identity in round 0), it has target cards, or it has been through max_rounds rounds. What comes after
    isn't looked at. A round's rows belong in one batch; rounds come in order."""
    _checked(target, max_rounds, chunk)
    return cards.groupBy("session").transformWithStateInPandas(Session(target, max_rounds, chunk), SESSION_ROWS, "append", "none")


def session_results(cards: DataFrame, target: int, max_rounds: int = 250, chunk: int = 50) -> tuple[DataFrame, DataFrame]:
    """The same over a table: (session, identity, rank, chunk) of the cards, and a row a session with its figures, the reason (null:
    it hasn't stopped), and whether it can go on."""
    from pyspark.sql import Window as W

    _checked(target, max_rounds, chunk)
    rows = cards.where(F.col("round") <= max_rounds)
    firsts = rows.where("identity is not null").groupBy("session", "identity").agg(F.min(F.struct("round", "seq")).alias("at"))
    ranked = firsts.withColumn("rank", F.row_number().over(W.partitionBy("session").orderBy("at")).cast("long"))
    found = ranked.where(F.col("rank") <= target).select("session", "identity", "rank", F.floor((F.col("rank") - 1) / chunk).cast("long").alias("chunk"))
    reached = ranked.where(F.col("rank") == target).select("session", F.col("at.round").alias("reached"))
    seen = ranked.select("session", F.col("at.round").alias("round")).groupBy("session", "round").agg(F.count("*").alias("new"))
    rounds = rows.groupBy("session").agg(F.max("round").alias("last"), F.min("round").alias("began"), F.count(F.when(F.col("round") == 0, F.col("identity"))).alias("at_first"))
    known = rounds.join(reached, "session", "left")
    empty = (F.col("began") == 0) & (F.col("at_first") == 0)
    reason = F.when(empty, EMPTY).when(F.col("reached").isNotNull(), ENOUGH).when(F.col("last") >= max_rounds, ROUNDS)
    known = known.withColumn("stop_reason", reason).withColumn("scrolls_completed", F.when(empty, 0).otherwise(F.coalesce("reached", "last")).cast("long"))
    total = known.select("session", "scrolls_completed").join(seen, "session").where(F.col("round") <= F.col("scrolls_completed")).groupBy("session").agg(F.sum("new").alias("total_unique"))
    out = known.join(total, "session", "left").withColumn("total_unique", F.when(empty, 0).otherwise(F.coalesce("total_unique", F.lit(0))).cast("long"))
    out = out.withColumns({"returned_total": F.least("total_unique", F.lit(target)).cast("long"), "can_continue": F.col("stop_reason").isNull()})
    stopped = out.where(F.col("stop_reason") == EMPTY).select("session")
    return found.join(stopped, "session", "left_anti"), out.select("session", "total_unique", "returned_total", "scrolls_completed", "stop_reason", "can_continue")


def session_ranks(cards: DataFrame, target: int, chunk: int, session_col: str = "session", id_col: str = "identity", order: str = "seq") -> DataFrame:
    """The same over a table: first arrivals by rank up to target, with the chunk that each comes in."""
    from pyspark.sql import Window as W

    firsts = cards.groupBy(session_col, id_col).agg(F.min(order).alias(order))
    ranked = firsts.withColumn("rank", F.row_number().over(W.partitionBy(session_col).orderBy(order)).cast("long")).where(F.col("rank") <= target)
    return ranked.withColumn("chunk", F.floor((F.col("rank") - 1) / chunk).cast("long"))
