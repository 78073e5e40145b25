"""Table catalog: given parquet tables plus the derived views.

``load(spark, sf_dir)`` gives a catalog whose attributes are the given
tables and the derived views. A table is read, and a view built from the
tables it names, when it is first asked for, so a query opens only what it
uses. DataFrames bind to their tables at analysis time, so a query keeps
reading its ``sf_dir`` even if another catalog registers the same names.

``oracle(sql, *views)`` wraps an oracle query with the view definitions it
needs as CTEs, so the same text runs in DuckDB over the driver's views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tokenmill.plans.fixtures_sql import SPARK_VIEWS, VIEWS

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()

# view -> the table whose rows it multiplies, the key it is dealt out by, rows
# of the table per task. Its few MB would else be one split, and one task would
# make, and sort, all rows of the view.
_DEALT = {"runs": ("customer", "c_custkey", 1 << 15)}

# view -> views it reads (only derived views; base tables are always there)
_DEPS = {
    "completions": ["tool_text"],
    "mc_answers": ["mc_items"],
    "task_accuracy": ["eval_outcomes"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str) -> "Catalog":
    return Catalog(spark, sf_dir)


class Catalog:
    """Attribute access to the given tables and derived views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._frames = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES and name not in VIEWS:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self._spark, self._sf_dir, name)
        text = SPARK_VIEWS.get(name, VIEWS[name])
        for used in {*_DEPS.get(name, []), *(set(re.findall(r"\w+", text)) & set(TABLES))}:
            self._dealt(name, used).createOrReplaceTempView(used)
        return self._spark.sql(text)

    def _dealt(self, view: str, used: str) -> DataFrame:
        table, key, rows = _DEALT.get(view, (None, None, None))
        df = getattr(self, used)
        return df.repartition(max(1, -(-df.count() // rows)), key) if used == table else df


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    # keep registration order of VIEWS for stability
    order = list(VIEWS)
    return sorted(seen, key=order.index)


def oracle(sql: str, *views: str) -> str:
    """Prefix ``sql`` with the CTEs of ``views`` (and what they read)."""
    sql = sql.strip()
    if not views:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n].strip()}\n)" for n in _closure(views))
    m = re.match(r"(?is)^with\s+(recursive\s+)?", sql)
    if m:
        rec = "RECURSIVE " if m.group(1) else ""
        return f"WITH {rec}{ctes},\n{sql[m.end():]}"
    return f"WITH {ctes}\n{sql}"
