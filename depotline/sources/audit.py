"""Step audit: row counts before and after each cleaning step, from one pass.

Counts ride along with the action that writes the result (``DataFrame.observe``);
no step triggers a job of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from depotline.operators.quality import Rule, is_true

LOG_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("rows_affected", T.LongType()),
        T.StructField("issue_found", T.StringType()),
        T.StructField("action_taken", T.StringType()),
        T.StructField("assumption", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


@dataclass
class _Step:
    name: str
    issue: str
    action: str
    assumption: str
    on_loss: str
    rules: list[Rule]
    counted: Observation | int
    #: What the rules were judged on, where that is not what came out of the step.
    judged: Observation | None = None
    #: Status of a step that was judged elsewhere.
    verdict: str | None = None

    @property
    def rows(self) -> int:
        return self.counted if isinstance(self.counted, int) else int(self.counted.get["rows"])

    def broken(self) -> list[tuple[Rule, int, int]]:
        """Rules with rows that break them: the rule, those rows, all rows."""
        if not self.rules:
            return []
        seen = (self.judged or self.counted).get
        return [(rule, int(seen[f"bad{i}"]), int(seen["rows"])) for i, rule in enumerate(self.rules) if int(seen[f"bad{i}"])]

    def status(self, before: int) -> str:
        """The severity of a rule that too many rows break, else ``on_loss`` if the step changed the number of rows."""
        if self.verdict is not None:
            return self.verdict
        severities = {rule.severity for rule, bad, rows in self.broken() if bad > rows * rule.tolerate}
        if severities:
            return "FAIL" if "FAIL" in severities else "WARN"
        return self.on_loss if before not in (0, self.rows) else "PASS"

    def found(self) -> str:
        """The issue with the number of rows that show it."""
        return "; ".join([self.issue, *[f"{rule.name}: {bad} of {rows} rows" for rule, bad, rows in self.broken()]])


@dataclass
class StepAudit:
    """Collects one entry per step.

    ``log`` waits for the observed counts, so call it after the action that
    writes the result, and only for steps which that action runs through.
    """

    dataset: str
    steps: list[_Step] = field(default_factory=list)

    def step(
        self,
        df: DataFrame,
        name: str,
        change: Callable[[DataFrame], DataFrame] | None = None,
        issue: str = "",
        action: str = "",
        assumption: str = "",
        on_loss: str = "PASS",
        rules: list[Rule] | None = None,
        before: bool = False,
    ) -> DataFrame:
        """Apply ``change`` and count the rows that come out, and those of them that break ``rules``.

        With ``before`` the rules are judged on the rows that go in, for a step that mends what they find.
        """
        rules = rules or []
        rows = F.count(F.lit(1)).alias("rows")
        bad = [F.count_if(is_true(rule.bad)).alias(f"bad{i}") for i, rule in enumerate(rules)]
        judged = None
        if before and rules:
            judged = Observation(f"{self.dataset}_{len(self.steps)}_{name}_before")
            df = df.observe(judged, rows, *bad)
        result = change(df) if change else df
        observation = Observation(f"{self.dataset}_{len(self.steps)}_{name}")
        self.steps.append(_Step(name, issue, action, assumption, on_loss, rules, observation, judged))
        return result.observe(observation, rows, *([] if judged else bad))

    def record(self, name: str, rows: int, issue: str = "", action: str = "", assumption: str = "") -> None:
        """Enter a count taken elsewhere, for an input that the final plan does not read."""
        self.steps.append(_Step(name, issue, action, assumption, "PASS", [], rows))

    def judge(self, name: str, rows: int | None, status: str, issue: str = "", action: str = "", assumption: str = "") -> None:
        """Enter a check of the whole table; without ``rows`` it is on those of the last step."""
        counted = self.steps[-1].counted if rows is None else rows
        self.steps.append(_Step(name, issue, action, assumption, "PASS", [], counted, verdict=status))

    def log(self, spark: SparkSession) -> DataFrame:
        """The audit table: one row per step, as many rows as steps were declared."""
        now = datetime.now(timezone.utc)
        rows, before = [], 0
        for entry in self.steps:
            after = entry.rows
            rows.append(
                (self.dataset, entry.name, before, after, before - after,
                 entry.found(), entry.action, entry.assumption, entry.status(before), now)
            )
            before = after
        return spark.createDataFrame(rows, LOG_SCHEMA)


def summarise_log(log: DataFrame) -> DataFrame:
    """Per-dataset totals and the overall verdict."""
    failed, warned = (F.count_if(F.col("status") == s) for s in ("FAIL", "WARN"))
    return log.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("steps_run"),
        F.count_if(F.col("status") == "PASS").alias("pass_count"),
        warned.alias("warn_count"),
        failed.alias("fail_count"),
        F.sum(F.abs("rows_affected")).alias("rows_affected"),
        F.when(failed > 0, "FAIL").when(warned > 0, "WARN").otherwise("PASS").alias("overall_status"),
    )


def run_summary(log: DataFrame, raw_columns: int, clean_columns: int) -> DataFrame:
    """Raw against clean shape plus the step totals, one row per dataset."""
    shape = log.groupBy("dataset").agg(
        F.max_by("rows_after", F.struct(F.col("step") == "load_raw", "rows_after")).alias("rows_raw"),
        F.min("rows_after").alias("rows_clean"),
    )
    return summarise_log(log).join(shape, "dataset").select(
        "dataset",
        "rows_raw",
        "rows_clean",
        (F.col("rows_clean") - F.col("rows_raw")).alias("row_delta"),
        F.lit(raw_columns).alias("columns_raw"),
        F.lit(clean_columns).alias("columns_clean"),
        "steps_run",
        "pass_count",
        "warn_count",
        "fail_count",
        "overall_status",
    )
