"""The endpoint catalogue: configuration documents as a table, and its checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.functions.values import strict_boolean, strict_boolean_or_null

# Member names of a configuration document, spelled as they are in use.
ROOT_KEY = "ingest-souce-config"
CONFIG_SCHEMA = f"""
`{ROOT_KEY}` STRUCT<
  `app-name`: STRING,
  `base-url`: STRING,
  `history-load`: STRUCT<
    enabled: STRING,
    `start_date`: STRING, `start-date`: STRING,
    `end_date`: STRING, `end-date`: STRING>,
  endpoints: ARRAY<STRUCT<
    `endpoint-name`: STRING,
    params: MAP<STRING, STRING>,
    headers: MAP<STRING, STRING>,
    auth: STRUCT<username: STRING, password: STRING, `password-env`: STRING>>>>
"""


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue rows of the configuration documents at `path`, one document per file."""
    return catalogue_rows(spark.read.text(path, wholetext=True), "value")


def catalogue_rows(documents: DataFrame, text: str) -> DataFrame:
    """One row per endpoint of each configuration document.

    Passwords are named by environment variable (`password-env`). A user whose password is
    written into the document instead is an error, and so is a document without the root
    member.
    """
    root = F.col("_config").getField(ROOT_KEY)
    checked = F.coalesce(root, F.raise_error(F.lit(f"configuration has no {ROOT_KEY}")))
    config = documents.select(F.from_json(text, CONFIG_SCHEMA).alias("_config")).select(
        checked.alias("c")
    )
    c = F.col("c")
    history = c["history-load"]
    endpoint = F.col("e")
    return config.select(
        c["app-name"].alias("app_name"),
        c["base-url"].alias("base_url"),
        strict_boolean(F.coalesce(history["enabled"], F.lit(""))).alias("history_enabled"),
        _either(history, "start").alias("start_date"),
        _either(history, "end").alias("end_date"),
        F.explode(c["endpoints"]).alias("e"),
    ).select(
        "app_name",
        "base_url",
        endpoint["endpoint-name"].alias("endpoint"),
        endpoint["params"].alias("params"),
        endpoint["headers"].alias("headers"),
        _checked_user(endpoint["auth"]).alias("auth_username"),
        endpoint["auth"]["password-env"].alias("auth_password_env"),
        "history_enabled",
        "start_date",
        "end_date",
    )


def _checked_user(auth: Column) -> Column:
    """The user name; a failure where only a clear-text password comes with it."""
    user, given, variable = (F.coalesce(auth[m], F.lit("")) for m in ("username", "password", "password-env"))
    refused = F.raise_error(F.concat(F.lit("the password of user "), user, F.lit(" must be named by password-env, not written down")))
    return F.when((user != "") & (given != "") & (variable == ""), refused).otherwise(auth["username"])


def _either(history: Column, side: str) -> Column:
    """The date under either spelling of its name."""
    return F.coalesce(history[f"{side}_date"], history[f"{side}-date"])


def history_violations(configs: DataFrame) -> DataFrame:
    """Rows whose history window is unusable, with `missing` and `problem`.

    Expects `enabled`, `start_date`, `end_date` as text. An enabled window needs
    both dates; a flag that is no boolean is a violation of its own.
    """
    enabled = strict_boolean_or_null(F.col("enabled"))
    absent = [
        F.when(F.coalesce(F.col(column), F.lit("")) == "", F.lit(name))
        for column, name in (("start_date", "start-date"), ("end_date", "end-date"))
    ]
    missing = F.when(F.coalesce(enabled, F.lit(False)), F.array_compact(F.array(*absent)))
    problem = F.when(enabled.isNull(), F.lit("invalid flag")).when(
        F.size("missing") > 0, F.lit("missing dates")
    )
    return (
        configs.withColumn("missing", F.coalesce(missing, F.array().cast("array<string>")))
        .withColumn("problem", problem)
        .where(F.col("problem").isNotNull())
    )


def in_history_window(ts: Column, start_date: str, end_date: str) -> Column:
    """Rows from the first instant of `start_date` to the last of `end_date`."""
    first = F.lit(start_date).cast("date")
    after = F.date_add(F.lit(end_date).cast("date"), 1)
    return (ts >= first) & (ts < after)
