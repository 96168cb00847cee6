"""What is remembered of each source, as keyed state of a stream of measures.

Each run's measures of a source's strategies come as rows; the state is the source's profile and its history. A run is
chosen from, watched for drift and remembered against the state that the run before it left, as ``strategy.contest`` does
in batch, so that a stream over many runs gives what the batches one after another give.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adlens.operators import strategy

#: State lives in RocksDB, in an encoding that lets fields be added.
CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.encodingFormat": "avro",
}
PROFILE = "preferred_strategy string, last_good_count long, last_good_score long, last_good_run_id string, failure_streak int, health string, last_observed_at string, last_run_id string"
ENTRY = "run_id string, observed_at string, strategy string, status string, accepted_count long, candidate_count long, score long, band_count long, salary_count long, description_count long, codes string"
OUT = "source_id string, run_id string, strategy string, status string, fallback_used boolean, severe boolean, codes string, preferred_strategy string, last_good_count long, last_good_score long, failure_streak int, entries int"
COUNTS = ("candidate_count", "accepted_count", "rejected_count", "duplicate_count", "band_count", "salary_count", "description_count")


def measured(rows: DataFrame, global_rules: DataFrame, source_rules: DataFrame) -> DataFrame:
    """Per run, source and strategy: the measures by all rules, and own_score and own_accepted by the source's own, by which strategies are compared.

    rows: candidates as ``strategy.judged`` takes them, with run_id and observed_at.
    """
    keys = ["run", "source_id", "strategy", "strategy_index"]
    runs = rows.withColumn("source", F.col("source_id")).withColumn("run", F.struct("observed_at", "run_id"))

    def by(rules: DataFrame) -> DataFrame:
        judged = strategy.judged(runs, rules, source_rules)
        return strategy.metrics(judged.withColumn("source_id", F.struct("run", "source_id"))).select("source_id.*", *[c for c in ("strategy", "strategy_index", *COUNTS, "score", "failed")])

    own = by(global_rules.limit(0)).select(*keys, F.col("score").alias("own_score"), F.col("accepted_count").alias("own_accepted"))
    return by(global_rules).join(own, keys).select("run.*", *keys[1:], *COUNTS, "score", "failed", "own_score", "own_accepted")


def drifted(row: dict, base: int) -> list[tuple[str, bool]]:
    """The codes of drift of a run's measures against a baseline, and whether each is severe."""
    n, c, limit = row["accepted_count"], row["candidate_count"], strategy.SOURCE_LIMIT
    flags = [
        ("strategy_failed", row["failed"], base > 0),
        ("junk_inflation", c >= 5 and 2 * row["rejected_count"] > c, True),
        ("source_count_spike", n > limit, True),
        ("historical_count_spike", base >= 3 and n > max(limit, 4 * base), True),
        ("historical_count_drop", base >= 5 and n == 0 and c >= 5, True),
        ("duplicate_inflation", c >= 10 and 2 * row["duplicate_count"] > n, False),
    ]
    return [(code, severe) for code, when, severe in flags if when]


class Profiles(StatefulProcessor):
    """Keeps one source's profile and history; gives a row for every run that it folds in."""

    def __init__(self, read: int = strategy.READ_HISTORY) -> None:
        self.read = read

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.profile = handle.getValueState("profile", PROFILE)
        self.history = handle.getListState("history", ENTRY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        table = pd.concat(list(rows))
        now = list(self.profile.get()) if self.profile.exists() else [None, 0, 0, None, 0, "unknown", "", ""]
        entries = [tuple(e) for e in self.history.get()] if self.history.exists() else []
        out = []
        for (at, run), tried in sorted(table.groupby(["observed_at", "run_id"], sort=True), key=lambda x: x[0]):
            if (at, run) <= (now[6], now[7]):
                continue  # a replay, or a run from before one that was folded in
            preferred, base, score = now[0], now[1], now[2]
            bonus = lambda r: strategy.PREFERRED * (r["strategy"] == preferred) + strategy.ENDPOINT * (r["strategy"] in strategy.ENDPOINTS and r["own_accepted"] > 0)  # noqa: E731, B023
            row = min(tried.to_dict("records"), key=lambda r: (-(r["own_score"] + bonus(r)), r["strategy_index"]))
            flags = drifted(row, base)
            severe = any(s for _, s in flags)
            codes = ",".join(c for c, _ in flags)
            status = "failed" if row["failed"] and not row["accepted_count"] else "degraded" if severe else "ok"
            if not severe:
                if row["accepted_count"] > 0 and (not score or row["score"] >= score):
                    now[0] = row["strategy"]
                now[1:4] = int(row["accepted_count"]), int(row["score"]), run
            now[4] = now[4] + 1 if severe else 0
            now[5], now[6], now[7] = "degraded" if severe else "ok", at, run
            entry = (run, at, row["strategy"], now[5], *[int(row[c]) for c in ("accepted_count", "candidate_count", "score", "band_count", "salary_count", "description_count")], codes)
            entries = ([*entries[-self.read :], entry] if self.read else [entry])[-strategy.KEPT_HISTORY :]
            out.append((key[0], run, row["strategy"], status, bool(severe or row["failed"] and base > 0), bool(severe), codes, now[0], now[1], now[2], now[4], len(entries)))
        if out:
            self.profile.update(tuple(now))
            self.history.put(entries)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    def close(self) -> None:
        pass


def followed(measures: DataFrame, read: int = strategy.READ_HISTORY) -> DataFrame:
    """A stream of measures (as ``measured`` gives them, source_id text) as a row for every source and run: what was chosen, how it drifted, and the profile after it.

    Runs of a source are folded in by time and run; a replay of one changes nothing, nor does one from before the last. The session
    needs CONF.
    """
    return measures.groupBy("source_id").transformWithStateInPandas(Profiles(read), OUT, "Update", "None")
