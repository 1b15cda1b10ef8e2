"""Evidence profiling: totals, anomalies, breakdowns, rating and actions for a loosely structured table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewatch.functions.numbers import as_double, plain_number, safe_float, safe_ratio, strip
from tidewatch.functions.text import excerpt, first_amount, has_risk_keyword, truthy

# Column names that can play each role, best first.
ROLE_CANDIDATES = {
    "amount": ("order_amount", "amount", "revenue", "total", "price", "value"),
    "quantity": ("quantity", "qty", "units", "count"),
    "channel": ("sales_channel", "channel", "source", "platform"),
    "category": ("category", "product_category", "type", "segment"),
    "anomaly": ("is_anomaly", "anomaly", "is_error", "status", "risk_flag"),
}
UNKNOWN = "unknown"
BREAKDOWN_SIZE = 6
HIGH_RATE_PERCENT = 10
SMALL_SAMPLE = 10

# Texts of the review.
ESCALATE_NOTE = "Escalate before publishing KPIs."
MONITOR_NOTE = "Continue monitoring and keep human review available."
PAUSE_ACTION = "Pause automated downstream reporting until risk review is complete."
INVESTIGATE_ACTION = "Investigate anomalous transactions before publishing KPIs."
STANDING_ACTIONS = (
    "Create a one-page operations summary for stakeholders.",
    "Route high-risk anomalies to a human reviewer before escalation.",
)
SAMPLE_ACTION = "Increase sample size before making production decisions."
PAGE_CATEGORY, PAGE_CHANNEL = "pdf_evidence", "document"
NO_TEXT_NOTE = "No text could be extracted from this PDF page."


@dataclass(frozen=True)
class Roles:
    """The column of a table that plays each role; None where there is none."""

    amount: str | None
    quantity: str | None
    channel: str | None
    category: str | None
    anomaly: str | None


def _folded(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def detect_roles(evidence: DataFrame) -> Roles:
    """First candidate present per role, comparing names without case, spaces and dashes."""
    by_name = {_folded(name): name for name in evidence.columns}

    def column_for(candidates: tuple[str, ...]) -> str | None:
        return next((by_name[c] for c in candidates if c in by_name), None)

    return Roles(**{role: column_for(candidates) for role, candidates in ROLE_CANDIDATES.items()})


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def amount_of(evidence: DataFrame, roles: Roles) -> Column:
    """The amount as a number; 0 where it is missing or does not read as one."""
    if roles.amount is None:
        return F.lit(0.0)
    return safe_float(_column(roles.amount), evidence.schema[roles.amount].dataType)


def is_anomalous(evidence: DataFrame, roles: Roles) -> Column:
    """Amount or whole quantity not above zero, or the flag set.

    An unreadable amount counts as 0 and an unreadable quantity as 1. A table without an amount column
    has amount 0 throughout, so all its rows are anomalous.
    """
    found = amount_of(evidence, roles) <= 0
    if roles.quantity is not None:
        quantity = as_double(_column(roles.quantity), evidence.schema[roles.quantity].dataType)
        # The whole part is not above zero exactly when the number is below one.
        found = found | (F.coalesce(quantity, F.lit(1.0)) < 1)
    if roles.anomaly is not None:
        found = found | truthy(_column(roles.anomaly), evidence.schema[roles.anomaly].dataType)
    return found


def _label(evidence: DataFrame, name: str | None) -> Column:
    if name is None:
        return F.lit(UNKNOWN)
    return F.coalesce(_column(name).cast("string"), F.lit(UNKNOWN))


def _grouped_totals(evidence: DataFrame, roles: Roles) -> DataFrame:
    """Counts, amount and anomalies overall (level 3), per channel (level 1) and per category (level 2).

    The table is scanned once and reduced per (channel, category) first; the three levels are then taken
    from that small table.
    """
    cells = (
        evidence.select(
            _label(evidence, roles.channel).alias("channel"),
            _label(evidence, roles.category).alias("category"),
            amount_of(evidence, roles).alias("amount"),
            is_anomalous(evidence, roles).alias("is_anomalous"),
        )
        .groupBy("channel", "category")
        .agg(
            F.count("*").alias("n"),
            F.sum("amount").alias("amount"),
            F.count_if("is_anomalous").alias("anomalies"),
        )
    )
    channel, category = F.col("channel"), F.col("category")
    return cells.groupingSets([[], [channel], [category]], channel, category).agg(
        F.sum("n").alias("n"),
        F.sum("amount").alias("amount"),
        F.sum("anomalies").alias("anomalies"),
        F.grouping_id().cast("int").alias("level"),
    )


_LEVELS = {1: "channel", 2: "category"}
_ALL = 3


def _leading(totals: DataFrame, size: int = BREAKDOWN_SIZE) -> DataFrame:
    """The overall row and the most common values per level; equal counts order by value."""
    value = F.coalesce("channel", "category")
    common = Window.partitionBy("level").orderBy(F.desc("n"), F.col("value"))
    return totals.withColumn("value", value).withColumn("place", F.row_number().over(common)).filter(F.col("place") <= size)


def value_breakdown(evidence: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Long form: the six most common channels and categories with their counts."""
    roles = roles or detect_roles(evidence)
    leading = _leading(_grouped_totals(evidence, roles)).filter(F.col("level") != _ALL)
    role = F.when(F.col("level") == 1, F.lit(_LEVELS[1])).otherwise(F.lit(_LEVELS[2]))
    return leading.select(role.alias("role"), "value", F.col("n").alias("value_count"), "place")


def profile(evidence: DataFrame, roles: Roles | None = None) -> DataFrame:
    """One row: counts, total amount, anomalies, top channel, breakdowns, and the detected columns."""
    roles = roles or detect_roles(evidence)
    rows = _leading(_grouped_totals(evidence, roles))

    def overall(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("level") == _ALL, F.col(name))), F.lit(0))

    def breakdown(level: int) -> Column:
        # At most six entries per level are left here.
        entry = F.when(F.col("level") == level, F.struct("place", "value", "n"))
        ordered = F.sort_array(F.collect_list(entry))
        return F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["value"], e["n"])))

    first_channel = F.max(F.when((F.col("level") == 1) & (F.col("place") == 1), F.col("value")))
    detected = F.struct(*(F.lit(column).cast("string").alias(role) for role, column in vars(roles).items()))
    return rows.agg(
        overall("n").alias("event_count"),
        F.round(overall("amount"), 2).alias("total_revenue"),
        F.coalesce(first_channel, F.lit(UNKNOWN)).alias("top_channel"),
        overall("anomalies").alias("anomaly_count"),
        breakdown(1).alias("channel_breakdown"),
        breakdown(2).alias("category_breakdown"),
    ).withColumn("detected_columns", detected)


def anomaly_split(profiled: DataFrame) -> DataFrame:
    """Normal and anomalous counts."""
    normal = F.greatest(F.col("event_count") - F.col("anomaly_count"), F.lit(0))
    return profiled.select(normal.alias("normal_events"), F.col("anomaly_count").alias("anomaly_events"))


def rate_risk(profiled: DataFrame) -> DataFrame:
    """Add anomaly_rate_percent, risk_level and review_note to a profile row."""
    rate = F.coalesce(safe_ratio(F.col("anomaly_count"), F.col("event_count"), 2, factor=100), F.lit(0.0))
    high = F.col("anomaly_rate_percent") >= HIGH_RATE_PERCENT
    level = F.when(high, "high").when(F.col("anomaly_count") > 0, "medium").otherwise("low")
    return profiled.withColumn("anomaly_rate_percent", rate).withColumns(
        {
            "risk_level": level,
            "review_note": F.when(high, F.lit(ESCALATE_NOTE)).otherwise(F.lit(MONITOR_NOTE)),
        }
    )


def recommend_actions(rated: DataFrame) -> DataFrame:
    """Add the ordered action list to a rated profile row."""
    steps = [
        F.when(F.col("risk_level") == "high", F.lit(PAUSE_ACTION)),
        F.when(F.col("anomaly_count") > 0, F.lit(INVESTIGATE_ACTION)),
        *(F.lit(action) for action in STANDING_ACTIONS),
        F.when(F.col("event_count") < SMALL_SAMPLE, F.lit(SAMPLE_ACTION)),
    ]
    return rated.withColumn("actions", F.array_compact(F.array(*steps)))


def summarise(profiled: DataFrame, objective: str) -> DataFrame:
    """Add final_summary: the objective and the first three findings."""
    findings = F.concat_ws(
        "; ",
        F.concat(F.lit("processed "), F.col("event_count").cast("string"), F.lit(" events")),
        F.concat(F.lit("total revenue was "), plain_number(F.col("total_revenue"))),
        F.concat(F.lit("top channel was "), F.col("top_channel")),
    )
    head = f"Completed workflow for: {objective}. Key findings: "
    return profiled.withColumn("final_summary", F.concat(F.lit(head), findings, F.lit(".")))


def review(evidence: DataFrame, objective: str, roles: Roles | None = None) -> DataFrame:
    """The whole review of an evidence table in one row: profile, rating, actions, summary."""
    return profile(evidence, roles).transform(rate_risk).transform(recommend_actions).transform(summarise, objective)


def text_records(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Evidence records from free text: the first amount, a risk flag and an excerpt per document."""
    text = strip(F.col(text_column).cast(StringType()))
    shown = F.coalesce(F.nullif(text, F.lit("")), F.lit(NO_TEXT_NOTE))
    texts = documents.select(F.col(id_column).alias("document_page"), shown.alias("_text"))
    return texts.withColumn("_lowered", F.lower("_text")).select(
        "document_page",
        F.lit(PAGE_CATEGORY).alias("category"),
        F.lit(PAGE_CHANNEL).alias("sales_channel"),
        F.lit(1).alias("quantity"),
        first_amount(F.col("_text")).alias("order_amount"),
        has_risk_keyword(F.col("_lowered")).alias("is_anomaly"),
        excerpt(F.col("_text")).alias("text_excerpt"),
    )
