"""The library's rules as functions of plain SQL: ``CREATE TEMPORARY FUNCTION ... RETURN``, without Python at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from lodgeworks.fields import ID_NAME_PATTERNS

_SAFE = "least(greatest({0}, {1}), {2})"


def _repaired(day: str, month: str, year: str) -> str:
    safe_year, safe_month = _SAFE.format(year, 1, 9999), _SAFE.format(month, 1, 12)
    last = f"day(last_day(make_date({safe_year}, {safe_month}, 1)))"
    return f"make_date({safe_year}, {safe_month}, {_SAFE.format(day, 1, last)})"


#: Scalar functions: parameters, type and body. Parameters never have the names of columns.
SCALARS = {
    "repaired_date": ("d INT, m INT, y INT, low INT DEFAULT 2017, high INT DEFAULT 2019, other INT DEFAULT 2018", "DATE",
                      f"CASE WHEN d IS NOT NULL AND m IS NOT NULL AND y IS NOT NULL THEN {_repaired('d', 'm', 'IF(y BETWEEN low AND high, y, other)')} END"),
    "is_calendar_day": ("d INT, m INT, y INT", "BOOLEAN",
                        f"coalesce(y BETWEEN 1 AND 9999 AND m BETWEEN 1 AND 12 AND d >= 1 AND d = day({_repaired('d', 'm', 'y')}), false)"),
    "price_per_request": ("price DOUBLE, requests DOUBLE", "DOUBLE", "price / (requests + 0.001D)"),
    "discounted_price": ("price DOUBLE, discount DOUBLE", "DOUBLE", "price * (1 - discount)"),
    "is_id_like": ("name STRING", "BOOLEAN", " OR ".join(f"contains(name, '{p}')" for p in ID_NAME_PATTERNS)),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the scalar functions known to the session; returns their names."""
    for name, (parameters, kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(SCALARS)


def register_table_checks(spark: SparkSession, view: str, columns: Sequence[str] | None = None) -> list[str]:
    """``{view}_null_counts()`` and ``{view}_findings(least)`` as table functions over the view; returns their names.

    ``null_counts`` gives ``(column, n)`` in one scan. ``findings`` gives ``(check, column, n_rows)`` where nulls, or copies of
    whole rows, are at least ``least``, and the columns whose names look like identifiers.
    """
    fields = spark.table(view).schema
    names = list(columns or fields.fieldNames())
    quoted = {c: c.replace("'", "\\'") for c in names}
    empty = {c: f"`{c}` IS NULL" + (f" OR isnan(`{c}`)" if fields[c].dataType.typeName() in ("double", "float") else "") for c in names}
    counts, findings = f"{view}_null_counts", f"{view}_findings"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {counts}() RETURNS TABLE (column STRING, n BIGINT)
        RETURN SELECT p.column, p.n FROM (SELECT array({", ".join(f"named_struct('column', '{quoted[c]}', 'n', count_if({empty[c]}))" for c in names)}) AS parts
          FROM {view}) LATERAL VIEW explode(parts) AS p""")
    listed = ", ".join(f"'{quoted[c]}'" for c in names)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {findings}(least BIGINT DEFAULT 1) RETURNS TABLE (check STRING, column STRING, n_rows BIGINT)
        RETURN SELECT 'nulls', column, n FROM {counts}() WHERE n >= least
        UNION ALL SELECT 'duplicates', CAST(NULL AS STRING), n FROM (
          SELECT coalesce(sum(c - 1), 0) AS n FROM (SELECT count(*) AS c FROM {view} GROUP BY {", ".join(f"`{c}`" for c in names)})) WHERE n >= least
        UNION ALL SELECT 'id_like', c, 0 FROM (SELECT explode(array({listed})) AS c) WHERE {SCALARS["is_id_like"][2].replace("name", "c")}""")
    return [counts, findings]
