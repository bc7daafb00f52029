"""Role-based column masking driven by column tags (H6, H7).

Tags live in the column metadata (``pii`` and ``tipo`` keys, as the
reference tags its users table); a policy maps a tag kind to a mask function
from :mod:`paylake.functions.masks`. ``apply_masks`` is a single projection,
so it composes with any query and keeps codegen intact.

A table's tags are also kept in a small stored policy beside it;
``register_views`` resolves them at read time into a view per role, so SQL
users get masked columns without calling a mask themselves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.masks import MASKS_BY_KIND
from paylake.sources.sinks import read_or_empty

# Fixed values (must equal the reference): table tags and column tags of the users table.
USER_TABLE_TAGS = {"dominio": "maestros", "informacion": "critica", "propietario": "comercial"}
USER_COLUMN_TAGS = {
    "full_name": {"pii": "true", "tipo": "name"},
    "document_id": {"pii": "true", "tipo": "national_id"},
    "email": {"pii": "true", "tipo": "email"},
    "phone": {"pii": "true", "tipo": "phone_number"},
}
KIND_TAG = "tipo"
PII_TAG = "pii"


def tag_columns(df: DataFrame, tags: dict[str, dict[str, str]]) -> DataFrame:
    """Attach tags to columns as metadata (kept through projections and writes)."""
    for col, t in tags.items():
        if col in df.columns:
            meta = dict(df.schema[col].metadata)
            meta.update(t)
            df = df.withMetadata(col, meta)
    return df


def apply_masks(df: DataFrame, role: str | None, policy: dict | None = None) -> DataFrame:
    """Project every PII-tagged column through the mask for its kind."""
    policy = policy or MASKS_BY_KIND
    cols = []
    for f in df.schema.fields:
        md = f.metadata or {}
        fn = policy.get(md.get(KIND_TAG)) if md.get(PII_TAG) == "true" else None
        cols.append(fn(F.col(f.name), role).alias(f.name, metadata=md) if fn else F.col(f.name))
    return df.select(*cols)


POLICY_SCHEMA = "table_name string, column_name string, tag string, value string, stored_at timestamp"


def store_policy(spark: SparkSession, root: str, table: str, table_tags: dict[str, str], column_tags: dict[str, dict[str, str]]) -> None:
    """Append the tags of a table (``column_name`` null) and of its columns to
    the stored policy; of a tag that is given again the later value holds, a
    null value takes it away."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(table, None, t, v, now) for t, v in table_tags.items()]
    rows += [(table, c, t, v, now) for c, tags in column_tags.items() for t, v in tags.items()]
    spark.createDataFrame(rows, POLICY_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_policy")


def policy(spark: SparkSession, root: str) -> DataFrame:
    """The tags that hold now: table_name, column_name, tag, value."""
    stored = read_or_empty(spark, f"{root}/_policy", T._parse_datatype_string(POLICY_SCHEMA))
    newest = stored.groupBy("table_name", "column_name", "tag").agg(F.max_by("value", "stored_at").alias("value"))
    return newest.where(F.col("value").isNotNull())


def stored_tags(spark: SparkSession, root: str, table: str) -> tuple[dict[str, str], dict[str, dict[str, str]]]:
    """(tags of the table, tags per column), as many rows as the table's owner gave."""
    of_table, of_columns = {}, {}
    for r in policy(spark, root).where(F.col("table_name") == table).collect():
        (of_table if r["column_name"] is None else of_columns.setdefault(r["column_name"], {}))[r["tag"]] = r["value"]
    return of_table, of_columns


def tagged_tables(spark: SparkSession, root: str, tag: str, value: str) -> list[str]:
    """Tables that carry a table tag."""
    held = policy(spark, root).where(F.col("column_name").isNull() & (F.col("tag") == tag) & (F.col("value") == value))
    return sorted(r["table_name"] for r in held.collect())


def register_views(spark: SparkSession, root: str, tables: dict[str, DataFrame], role: str | None, prefix: str = "") -> dict[str, str]:
    """A temporary view of each table as ``role`` sees it, its tags resolved from
    the stored policy now; returns the views' names. With a
    prefix each, views of several roles stand side by side."""
    names = {}
    for table, df in tables.items():
        _, columns = stored_tags(spark, root, table)
        names[table] = f"{prefix}{table}"
        apply_masks(tag_columns(df, columns), role).createOrReplaceTempView(names[table])
    return names


def register_mask_functions(spark, role: str | None) -> None:
    """SQL temporary functions ``mask_name``, ``mask_doc_id``, ``mask_email``,
    ``mask_phone`` for SQL users (H2-H5), bound to the caller's ``role``.

    The SQL bodies use the same fixed mask values as the Column masks of
    :mod:`paylake.functions.masks`; a test checks both paths agree.
    """
    from paylake.functions.masks import (DOC_ID_MASK, EMAIL_CLEAR_PREFIX, EMAIL_MASK, PHONE_MASK,
                                         PRIVILEGED_ROLE)

    clear = "true" if role == PRIVILEGED_ROLE else "false"
    bodies = {
        "mask_name": "md5(v)",
        "mask_doc_id": f"'{DOC_ID_MASK}'",
        "mask_email": (f"concat(left(v, {EMAIL_CLEAR_PREFIX}), '{EMAIL_MASK}', "
                       "CASE WHEN contains(v, '@') THEN substring_index(v, '@', -1) ELSE '' END)"),
        "mask_phone": f"'{PHONE_MASK}'",
    }
    for name, masked in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS STRING "
                  f"RETURN CASE WHEN {clear} THEN v ELSE {masked} END")
