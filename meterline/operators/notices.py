"""Run notices: subject, text and HTML per event, the notice log, and the outbox."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import iso_now
from meterline.functions.events import event_fields
from meterline.functions.text import fill

DEFAULT_TITLE = "Trip Pipeline"

# Marker and colours for a succeeded run and for any other state.
SUCCESS_LOOK = {"marker": "✅", "color": "#2e7d32", "background": "#e8f5e9"}
FAILURE_LOOK = {"marker": "❌", "color": "#c62828", "background": "#ffebee"}
NO_DETAILS = "No additional details"

# The wording of a notice.
SUBJECT = "{marker} {title} — {state}"
TEXT_LINES = (
    "{title} — {state}",
    "",
    "Pipeline  : {title}",
    "Status    : {state}",
    "Job Name  : {job_name}",
    "Exec ID   : {job_run_id}",
    "Time      : {event_time}",
    "Message   : {details}",
)
HTML_FIELDS = (
    ("Pipeline", "{title}"),
    ("Status", '<strong style="color: {color}">{state}</strong>'),
    ("Job Name", "{job_name}"),
    ("Execution ID", "{job_run_id}"),
    ("Time", "{event_time}"),
    ("Message", "{details}"),
)
HTML_HEADING = (
    '<div style="background-color: {background}; border-left: 5px solid {color}">'
    '<h2 style="color: {color}">{marker} Pipeline {state}</h2></div>'
)
HTML_FOOTER = "<p>{title} — Automated Notification</p>"

NOTICE_FIELDS = ("job_name", "state", "job_run_id", "message", "event_time")


def parse_notification(events: DataFrame, body: str = "body") -> DataFrame:
    """The five fields a notice is made of; other columns are carried along."""
    return event_fields(events, NOTICE_FIELDS[:-1], body)


def _html_template() -> str:
    rows = "".join(f"<tr><td><b>{label}</b></td><td>{value}</td></tr>" for label, value in HTML_FIELDS)
    return f"<html><body>{HTML_HEADING}<table>{rows}</table>{HTML_FOOTER}</body></html>"


def render_notification(parsed: DataFrame, title: str = DEFAULT_TITLE) -> DataFrame:
    """Adds ``subject``, ``text_body`` and ``html_body``. Any state but SUCCEEDED reads as a failure."""
    ok = F.col("state") == "SUCCEEDED"
    look = {name: F.when(ok, F.lit(SUCCESS_LOOK[name])).otherwise(F.lit(FAILURE_LOOK[name])) for name in SUCCESS_LOOK}
    values = {
        **look,
        **{name: F.col(name) for name in NOTICE_FIELDS},
        "title": F.lit(title),
        "details": F.coalesce(F.nullif(F.col("message"), F.lit("")), F.lit(NO_DETAILS)),
    }
    return (
        parsed.withColumn("subject", fill(SUBJECT, **values))
        .withColumn("text_body", fill("\n".join(TEXT_LINES), **values))
        .withColumn("html_body", fill(_html_template(), **values))
    )


def notification_log(parsed: DataFrame) -> DataFrame:
    """Log entries: day stream, epoch milliseconds, and the notice as JSON."""
    now = F.current_timestamp()
    return parsed.select(
        F.replace(F.substring(iso_now(), 1, 10), F.lit("-"), F.lit("/")).alias("stream"),
        F.unix_millis(now).alias("timestamp"),
        F.to_json(F.struct(*NOTICE_FIELDS)).alias("message"),
    )


def notification_outbox(rendered: DataFrame, sender: str | None, recipient: str | None) -> DataFrame:
    """What is to be mailed; ``deliver`` only when both addresses are known."""
    return rendered.select(
        *NOTICE_FIELDS,
        "subject",
        "text_body",
        "html_body",
        F.lit(sender).cast("string").alias("sender"),
        F.lit(recipient).cast("string").alias("recipient"),
        F.lit(bool(sender and recipient)).alias("deliver"),
    )
