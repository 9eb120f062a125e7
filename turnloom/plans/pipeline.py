"""The whole pipeline from clips to windows, resumable stage by stage."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.functions import ids
from turnloom.inference import stages
from turnloom.inference.control import CALLS_PER_MINUTE
from turnloom.inference.provider import Provider, RuleProvider
from turnloom.logs import get_logger
from turnloom.operators import ingest, state, stitching, verdicts, windows
from turnloom.sources.sinks import Catalog, numbered_final, sheets_can_be_written, write_csv, write_report, write_sheet

log = get_logger(__name__)

STEPS = ("group", "relevance", "punctuation", "count", "segment", "attribute", "verify", "stitch", "export")


def group_rows(clips: DataFrame, sched: DataFrame, gap_s: int = 60, cap: int = 5) -> DataFrame:
    """Merged clips with content-derived ids, every group ``PENDING``."""
    g = ingest.first_window(ingest.merged_groups(clips, gap_s, cap), sched)
    d, t = F.date_format("bdate", "yyyy-MM-dd"), ingest.clock_text(F.col("sod"))
    return g.select(
        ids.group_id(d, F.col("channel_name"), t, F.col("plain_text")).alias("group_id"), d.alias("broadcast_date"), t.alias("broadcast_time"), "program_title", "channel_name", "plain_text",
        ids.program_id(d, F.col("channel_name"), F.col("start_time"), F.col("end_time")).alias("program_id"), F.lit("PENDING").alias("status"),
    )


class Pipeline:
    """Runs the steps into ``root``; finished steps are read, not run again. ``stop_after`` names the last step.

    ``prompts`` maps a stage to its template (see :func:`turnloom.inference.stages.ask`); ``restore`` is a local model of
    punctuation for refused texts. ``export`` names a folder for the windows and the verification report at the end.
    """

    def __init__(
        self, spark: SparkSession, root: str, provider: Provider | None = None, limit: int = 0, stop_after: str | None = None, tasks: int | None = None,
        per_minute: float = CALLS_PER_MINUTE, prompts: dict[str, dict] | None = None, restore=None, export: str | None = None,
    ):
        if stop_after is not None and stop_after not in STEPS:
            raise ValueError(f"no step {stop_after}")
        self.spark, self.provider, self.limit, self.stop_after = spark, provider or RuleProvider(), limit, stop_after
        self.tables = Catalog(spark, f"{root}_limit_{limit}" if limit else root)
        self.prompts, self.restore, self.export = prompts, restore, export
        self.how = {"tasks": tasks, "per_minute": per_minute, "templates": prompts}

    def _step(self, name: str, make) -> DataFrame:
        if self.tables.exists(name):
            return self.spark.read.parquet(self.tables.path(name))
        began = time.monotonic()
        df = self.tables.write(name, make())
        counts = ""
        if "outcome" in df.columns:
            counts = ": " + ", ".join(f"{r.outcome} {r.n}" for r in df.groupBy("outcome").agg(F.count("*").alias("n")).orderBy("outcome").collect())  # one row an outcome
        log.info("%s written in %.1f s%s", name, time.monotonic() - began, counts)
        return df

    def _asked(self, name: str, asks: tuple[str, ...], make) -> DataFrame:
        """A step whose stages' instructions are kept by the provider while it runs."""
        if self.tables.exists(name):
            return self.spark.read.parquet(self.tables.path(name))
        with stages.instructions_cached(self.provider, self.prompts, asks) as caches:
            return self._step(name, lambda: make({**self.how, "caches": caches}))

    def _twice(self, name: str, asks: tuple[str, ...], todo: DataFrame, run) -> DataFrame:
        """A stage's outcomes; what failed is tried once more in the same run."""
        first = self._asked(f"{name}_1", asks, lambda how: run(todo, how))
        failed = todo.join(first.filter("outcome = 'failed'").select("group_id"), "group_id", "left_semi")
        second = self._asked(f"{name}_2", asks, lambda how: run(failed, how))
        return first.filter("outcome <> 'failed'").unionByName(second)

    def run(self, raw: DataFrame, sched: DataFrame, seconds=ingest.seconds_12h) -> dict[str, DataFrame]:
        out: dict[str, DataFrame] = {}
        p = self.provider
        clips = ingest.ingest(raw, sched, self.limit, seconds)
        groups = self._step("grouped", lambda: state.insert_if_absent(group_rows(clips, sched), self.spark.createDataFrame([], "group_id string"), "grouped"))

        def done(step: str) -> bool:
            return self.stop_after == step

        out["grouped"] = groups
        if done("group"):
            return out
        rel = self._twice("relevance", ("relevance",), groups, lambda g, how: stages.relevance(g, p, **how))
        out["relevance"] = rel
        relevant = groups.join(rel.filter("status = 'RELEVANT'").select("group_id"), "group_id", "left_semi")
        if done("relevance"):
            return out
        one = F.when(F.col("outcome") == "ok", "ok").otherwise("failed")
        pun = self._twice("punctuation", ("punctuation",), relevant, lambda g, how: stages.punctuation(g, p, restore=self.restore, **how).withColumn("outcome", one))
        out["punctuation"] = pun
        good = pun.filter("outcome = 'ok'").select("group_id", "text", "source")
        ready = state.set_text(relevant.join(good.select("group_id"), "group_id", "left_semi"), good).drop("raw_text")
        if done("punctuation"):
            return out
        cnt = self._step("counts", lambda: stages.token_counts(ready, p))
        out["counts"] = cnt
        sized = ready.join(cnt, "group_id")
        if done("count"):
            return out
        seg = self._twice("segmentation", ("segmentation", "segmentation_indexed"), sized, lambda g, how: stages.segmentation(g, p, **how))
        segments = self._step("segments", lambda: stages.segment_rows(seg, groups))
        out["segments"] = segments
        if done("segment"):
            return out
        dialogues = self._asked("dialogues", ("attribution",), lambda how: stages.attribution(segments, p, **how))
        out["dialogues"] = dialogues
        if done("attribute"):
            return out
        ver = self._asked("verdicts", ("verification",), lambda how: stages.verification(dialogues, ready, p, **how))
        fixed = verdicts.apply_verification(dialogues, ver)
        verified = self._step("verified", lambda: dialogues.drop("speaker", "role", "verification_score").join(fixed.drop("corrected"), "dialogue_id"))
        out["verified"] = verified
        if done("verify"):
            return out
        stitched = self._step("stitched", lambda: stitching.stitch(groups, verified))
        out["stitched"] = stitched
        if done("stitch"):
            return out
        out["final"] = self._step("final", lambda: numbered_final(windows.final_windows(groups, stitched)))
        if self.export:
            self._write_files(out["final"], verdicts.report(dialogues, ver))
        return out

    def _write_files(self, final: DataFrame, report: DataFrame) -> None:
        """The windows in order as CSV (and as a sheet where that can be written) and the verification report."""
        name = f"{self.export}/windows" + (f"_limit_{self.limit}" if self.limit else "")
        ordered = final.orderBy("window_id")
        write_csv(ordered, f"{name}_csv")
        if "://" not in name and sheets_can_be_written():
            write_sheet(ordered, f"{name}.xlsx")
        write_report(report.orderBy("group_id").select(F.col("report").alias("block")), f"{self.export}/verification_responses")
        log.info("windows and report written to %s", self.export)

    def status(self) -> DataFrame:
        """The groups as they stand: status, size label and block flag derived from the outcome tables on disk.

        A safety block moves a group forward with its flag set; a failure holds it where it is until the next run.
        """
        groups = self.tables.read("grouped")
        seen: list[DataFrame] = []
        blocked: list[DataFrame] = []

        def passed(table: str, attempt: int, status, flag: str | None) -> None:
            for k in (1, 2):
                if self.tables.exists(f"{table}_{k}"):
                    df = self.spark.read.parquet(self.tables.path(f"{table}_{k}"))
                    seen.append(df.select("group_id", F.lit(attempt + k).alias("attempt"), status(df).alias("status")))
                    if flag:
                        blocked.append(df.filter("outcome = 'blocked'").select("group_id", F.lit(flag).alias("block"), F.lit(attempt).alias("attempt")))

        good = lambda done, failed: lambda df: F.when(F.col("outcome") == "failed", failed).otherwise(done)
        passed("relevance", 10, lambda df: F.col("status"), "BLOCKED_RELEVANCE")
        passed("punctuation", 20, good("PUNCTUATED", "FAILED PUNCTUATION"), None)
        if self.tables.exists("punctuation_1"):
            p = self.spark.read.parquet(self.tables.path("punctuation_1"))
            blocked.append(p.filter("source = 'local'").select("group_id", F.lit("BLOCKED_PUNCTUATION").alias("block"), F.lit(20).alias("attempt")))
        passed("segmentation", 30, good("SEGMENTED", "FAILED SEGMENTATION"), "BLOCKED_SEGMENTATION")
        if self.tables.exists("dialogues"):
            d = self.spark.read.parquet(self.tables.path("dialogues"))
            seen.append(d.select("group_id", F.lit(40).alias("attempt"), F.lit("ATTRIBUTED").alias("status")).distinct())
            blocked.append(d.filter("block_status is not null").select("group_id", F.col("block_status").alias("block"), F.lit(40).alias("attempt")).distinct())
        for df in seen[1:]:
            seen[0] = seen[0].unionByName(df)
        for df in blocked[1:]:
            blocked[0] = blocked[0].unionByName(df)
        out = state.set_status(groups, seen[0]) if seen else groups
        if blocked:  # the flag of the latest stage holds
            out = state.set_block(out, blocked[0].groupBy("group_id").agg(F.max_by("block", "attempt").alias("block")))
        return state.set_size(out, self.spark.read.parquet(self.tables.path("counts"))) if self.tables.exists("counts") else out
